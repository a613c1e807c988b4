"""Documents with everything that may be odd about them, and brute-force versions of the operators."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = r"[^\x20\x09-\x0D]+"

# Extra columns carry names that the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, key string, fp long, row string,"
    " size string, part int, body string, spans string, words string, copies int, block int, kept boolean, _sha string"
)
EXTRA = (7, "k", 1, "r", "s", 2, "b", "sp", "w", 3, 4, True, "x")
PROSE = "It was a plain day in the town and nobody there had much to say about it at all"


def odd_rows():
    long_text = " ".join(f"word{i % 997} runs{i}" for i in range(9000))
    rows = [
        (1, PROSE, "src1"),
        (2, PROSE.replace(" ", "\n\t "), "src1"),
        (2, PROSE.replace(" ", "\n\t "), "src1"),
        (3, None, "src2"),
        (4, "", None),
        (5, " \t\x0b\n ", "src2"),
        (6, long_text, "src0"),
        (7, long_text, "src0"),
        (None, PROSE, "src1"),
        (None, "no id here but words enough for a line of text to be kept by rules", "src1"),
        (8, "İstanbul ÉCOLE 日本語 😀  x", "Src"),
        (9, "one", ""),
        (10, "one two", ""),
        (11, "mail a.b@c.de or c_d@e.f@g.h, call +1 (555) 123-4567, card 4111 1111 1111 1111, host 10.0.0.255 256.1.1.1", "src1"),
        (12, "token = \"abcdefghijkl\" AKIA0123456789ABCD deadbeefdeadbeef01", "src1"),
        (13, "same line of five words\nsame line of five words\nsame line of six words", "src2"),
    ]
    return [(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def of(docs, *columns):
    return [tuple(r) for r in docs.select(*columns).collect()]


def words(text):
    return re.findall(WORD, text or "")


def rule_measures(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    n = len(w)
    return (
        n,
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, close):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if close(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v // 10 + v % 10
    return total % 10 == 0


def _digits(x):
    return re.sub("[^0-9]", "", x)


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(_digits(m.group())) <= 19 and _luhn(_digits(m.group()))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m.group())) <= 15),
)
_NAMES = "password|passwd|secret|token|api_?key"
_ANY_CASE = re.sub("[a-z]", lambda m: f"[{m.group()}{m.group().upper()}]", _NAMES)
SECRET = (
    ("assign", rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 12),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
    ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16),
)


def base_spans(text, kinds, by_start):
    found = []
    for rank, (name, pattern, holds) in enumerate(kinds):
        for m in re.finditer(pattern, text or ""):
            if holds(m):
                found.append(((m.start(), rank) if by_start else (rank, m.start()), name, f"{name}:{m.start()}:{m.end()}"))
    found.sort()
    counts = tuple(sum(x[1] == name for x in found) for name, _, _ in kinds)
    joined = ",".join(x[2] for x in found)
    return (*counts, hashlib.sha256(joined.encode()).hexdigest()), joined


def one_word_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def dropped_lines(docs, min_words=5, min_chars=20):
    """By words, or by the characters of lines with fewer words; shorter ones only if equal."""
    occurrences = []
    for i, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            w = tuple(words(line))
            if w:
                occurrences.append(((-1 if i is None else i, k), w))
    first = {}
    for place, w in sorted(occurrences):
        first.setdefault(w, place)
    earliest = dict(first)
    # Lines one edit apart agree in one half of the shorter one.
    for by_words in (True, False):
        tokens = {w: w if by_words else tuple(" ".join(w)) for w in first if (len(w) >= min_words) == by_words}
        tokens = {w: t for w, t in tokens.items() if by_words or len(t) >= min_chars}
        by_ends = defaultdict(list)
        for w, t in tokens.items():
            for end in (("first", t[:2]), ("last", t[-2:])):
                by_ends[end].append(w)
        for w, t in tokens.items():
            near = by_ends["first", t[:2]] + by_ends["last", t[-2:]]
            earliest[w] = min([first[w], *(first[x] for x in near if one_word_apart(tokens[x], t))])
    out = defaultdict(set)
    for place, w in occurrences:
        if earliest[w] < place:
            out[place[0]].add(place[1])
    return out
