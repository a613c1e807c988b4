"""Secrets: base spans, and tokens that a battery of randomness tests tells from prose."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bind, text_or_empty, written
from tidemark.llm.spans import SPAN, Kind, count_of, digest, kind_spans, matches

_ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)

KINDS = (
    Kind(
        "assign",
        _ASSIGN,
        test=lambda m: F.length(F.regexp_extract(m, _ASSIGN, 1)) >= 12,
        needs=r"(?i:password|passwd|secret|token|api_?key)",
    ),
    # Shorter runs never hold, so they need not be found.
    Kind("access", "AKIA[A-Z0-9]{14,}+", needs="AKIA"),
    Kind("hex", "(?<![0-9a-f])[0-9a-f]{16,}+", needs="[0-9a-f]{16}"),
)

# Tokens that may be a random string: a run of the widest alphabet with a digit in it.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}(?![A-Za-z0-9+/_=-])"
# Lengths at which a length class begins: tests of few symbols tell little, so classes are judged
# apart. Prose is tested at these lengths, too.
CLASS_LENGTHS = (16, 20, 25, 32, 46, 64)
# Words of prose: of five letters or more, as short ones seldom make names. What has a digit is left out
# whole, so that tokens do not pass for prose.
DIGITED = r"(?:^|\s)[^\s0-9]*+[0-9]\S*+"
PROSE = "[A-Za-z]{5,}+"
TOKENS_PER_TASK = 20_000

# Alphabets from narrow to wide; a token is held to the first that has all its symbols.
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("any", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"),
)

SYMBOLS = dict(ALPHABETS)
# Alphabets that prose is written in to be the null of tokens, and what joins its words there. A
# token has a digit, and a run of hexadecimal digits is a base span, so the others hold no token.
NULL_ALPHABETS = {"HEX": "", "base32": "", "base36": "", "base62": "", "base64": "/", "base64url": "-", "any": "-"}
NULL_OF = {"hex": "HEX", "lower": "base36", "letters": "base62"}


# Prose is read in blocks, each of a run for every alphabet, with digits for a share of its length. Stretches
# hold a block of each share, begun with another one from stretch to stretch.
DIGIT_SHARES = (0.5, 0.4, 0.3, 0.2)


def _block(share: float, more: int) -> list[tuple[int, int]]:
    """(length, letters) of the runs of a block: one of each class, and one more."""
    return [(n, n - int(n * share)) for n in (*CLASS_LENGTHS, more)]


BLOCKS = [_block(share, n) for share, n in zip(DIGIT_SHARES, CLASS_LENGTHS, strict=False)]
# Letters of a stretch: its runs lie end to end, so no word is left out.
STRETCH = sum(letters for block in BLOCKS for _, letters in block)
# A run may need more of the text than letters: the spaces between its words.
ROOM = 2 * max(CLASS_LENGTHS)


def _normal_tail(z: Column) -> Column:
    """P(Z > z), by the usual five-term polynomial; accurate to about 1e-7."""

    def tail(x: Column, t: Column) -> Column:
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        upper = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
        return F.when(x >= 0, upper).otherwise(1 - upper)

    # Bound, as are all values below that are used more than once: a column used twice is computed twice.
    return bind(z, lambda x: bind(1 / (1 + 0.2316419 * F.abs(x)), lambda t: tail(x, t)))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _normal_tail(F.abs(z)), F.lit(1.0))


def _alphabet(token: Column) -> Column:
    """The name of the inferred encoding; padding is no symbol."""
    out = None
    for name, symbols in ALPHABETS:
        fits = token.rlike("^[" + symbols.replace("-", r"\-") + "]+$")
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def _looked_up(name: Column, names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), name)


def _prose_in(prose: Column, encoding: str) -> Column:
    """Letters and digits written in an alphabet; in one that lacks some, by their number modulo its size."""
    lower, symbols = SYMBOLS["lower"], SYMBOLS[encoding]
    if encoding == "HEX":
        return F.translate(F.lower(prose), lower, "".join(symbols[i % len(symbols)] for i in range(len(lower))))
    if encoding == "base32":
        return F.translate(F.upper(prose), "0189", "2367")
    return F.lower(prose) if encoding == "base36" else prose


def _spread(h: Column, nth: Column) -> Column:
    """A hash for each run whose remainder by the number of alphabets rises by one from run to run."""
    kinds = len(NULL_ALPHABETS)
    other = F.pmod(F.xxhash64(h, nth), F.lit(1 << 60))
    return other - other % kinds + F.pmod(h + nth, F.lit(kinds))


def _digits_of(seed: Column) -> Column:
    parts = (F.pmod(F.xxhash64(F.lit(k), seed), F.lit(10**12)).cast("string") for k in (0, 1, 2))
    return F.concat(*(F.lpad(x, 12, "0") for x in parts))


def _layouts(blocks: int) -> Column:
    """For each block that a stretch may begin with, its runs (``start``, ``n``, ``letters``, ``nth``)."""

    def layout(turn: int) -> Column:
        runs, start = [], 0
        for block in [BLOCKS[(turn + k) % len(BLOCKS)] for k in range(blocks)]:
            for n, letters in block:
                run = {"start": start, "n": n, "letters": letters, "nth": len(runs)}
                runs.append(F.struct(*(F.lit(v).alias(k) for k, v in run.items())))
                start += letters
        return F.array(*runs)

    return F.array(*map(layout, range(len(BLOCKS))))


def prose_runs(body: Column, stretch: int = 512, blocks: int = 1) -> Column:
    """Array of (``encoding``, ``token``): names with a number from each stretch of a text's words of prose.

    Ordinary tokens are words, joined or not, with a number. So a run of words of prose of five letters
    or more gets digits for two to five tenths of its length at some place. Blocks of runs, one per null
    alphabet, are cut off the beginning of each stretch; ``STRETCH`` letters with all the ``BLOCKS`` leave
    nothing out. Which block comes first, the alphabets, numbers and places are set by a hash of the stretch.
    The last run of a text goes on at its beginning; a text of fewer letters than a run does not give that one.
    """

    def named(run: Column, part: Column, h: Column) -> Column:
        digits = run["n"] - run["letters"]
        chosen = F.element_at(F.array(*map(F.lit, NULL_ALPHABETS)), F.pmod(h, F.lit(len(NULL_ALPHABETS))).cast("int") + 1)
        # One space at most after five letters, and one ahead.
        some = F.ltrim(F.substring(part, run["start"] + 1, F.floor(run["letters"] * 1.2).cast("int") + 2).cast("string"))

        def written_in(encoding: Column, ahead: Column) -> Column:
            joined = F.substring(F.replace(some, F.lit(" "), _looked_up(encoding, NULL_ALPHABETS)), F.lit(1), run["letters"])

            def token(letters: Column) -> Column:
                prose = F.concat(
                    F.substring(letters, F.lit(1), ahead),
                    F.substring(_digits_of(h), F.lit(1), digits),
                    F.substring(letters, ahead + 1, run["letters"]),
                )
                own = None
                for name in NULL_ALPHABETS:
                    fits = encoding == name
                    own = F.when(fits, _prose_in(prose, name)) if own is None else own.when(fits, _prose_in(prose, name))
                # Prose of too few letters is short of n.
                return F.struct(encoding.alias("encoding"), F.when(F.length(letters) == run["letters"], own).alias("token"))

            return bind(joined, token)

        ahead = F.pmod(F.shiftright(h, 20), run["letters"] + 1).cast("int")
        return bind(chosen, lambda encoding: bind(ahead, lambda at: written_in(encoding, at)))

    def cut(words: Column, size: Column) -> Column:
        parts = F.regexp_extract_all(
            # Room for the last run to go on.
            F.concat(words, F.lit(" "), F.substring(words, 1, ROOM)),
            F.lit(f"(?=(.{{1,{stretch + ROOM}}})).{{1,{stretch}}}"),
            F.lit(1),
        )

        def tokens(part: Column, i: Column) -> Column:
            def of(h: Column) -> Column:
                runs = F.get(_layouts(blocks), F.pmod(h, F.lit(len(BLOCKS))).cast("int"))
                runs = F.filter(runs, lambda r: (r["start"] + i * stretch < size) & (r["letters"] <= size))
                # Neighbours in a block are written in different alphabets.
                turn = F.shiftright(h, 2)
                # Letters and spaces are bytes, which are found without counting from the beginning.
                return bind(
                    part.cast("binary"),
                    lambda octets: F.transform(
                        runs,
                        lambda r: bind(_spread(turn, r["nth"]), lambda x: named(r, octets, x)),
                    ),
                )

            return bind(F.xxhash64(part), of)

        return F.filter(F.flatten(F.transform(parts, tokens)), lambda x: x["token"].isNotNull())

    bare = F.when(body.rlike("[0-9]"), F.regexp_replace(body, DIGITED, " ")).otherwise(body)
    found = F.regexp_extract_all(bare, F.lit(PROSE), F.lit(0))
    return bind(F.array_join(found, " "), lambda words: bind(F.length(words), lambda size: cut(words, size)))


def uniformity(chars: Column, size: Column, n: Column) -> Column:
    """p-value of the chi-squared statistic of symbol counts (Wilson-Hilferty approximation)."""
    # Sorted, equal symbols stand together: one pass instead of one for each symbol.
    alike = F.regexp_extract_all(F.array_join(F.sort_array(chars), ""), F.lit(r"(?s)(.)\1*+"), F.lit(0))
    squares = F.aggregate(alike, F.lit(0.0), lambda s, c: s + F.length(c) * F.length(c))
    freedom = (size - 1).cast("double")
    chi = squares * size / n - n
    spread = 2 / (9 * freedom)
    return _normal_tail((F.pow(F.greatest(chi, F.lit(0.0)) / freedom, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def _in_halves(bare: Column, name: Column) -> Column:
    """The symbols as 0 and 1: below and from the middle of the alphabet."""
    out = None
    for encoding, symbols in ALPHABETS:
        halves = F.translate(bare, symbols, "".join(str(int(2 * i >= len(symbols))) for i in range(len(symbols))))
        out = F.when(name == encoding, halves) if out is None else out.when(name == encoding, halves)
    return out


def runs(halves: Column, n: Column) -> Column:
    """Two-sided p-value of the number of runs of 0 and of 1."""

    def without(part: str) -> Column:
        return F.length(F.replace(halves, F.lit(part), F.lit("")))

    changes = (2 * n - without("01") - without("10")) / 2

    def against(mean: Column) -> Column:
        variance = (mean - 1) * (mean - 2) / (n - 1)
        return bind(variance, lambda v: F.when(v > 0, _two_sided((changes + 1 - mean) / F.sqrt(v))).otherwise(0.0))

    return bind(without("1").cast("double"), lambda zeros: bind(2 * (n - zeros) * zeros / n + 1, against))


def serial_correlation(codes: Column, n: Column) -> Column:
    """Two-sided p-value of the correlation of neighbouring symbols."""
    products = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * b)
    # Sums of whole numbers first: exact, and fewer passes than over distances from the mean.
    zero = F.lit(0).cast("long")
    sums = F.struct(
        F.aggregate(codes, zero, lambda s, c: s + c).alias("total"),
        F.aggregate(codes, zero, lambda s, c: s + c * c).alias("squares"),
        F.aggregate(products, zero, lambda s, x: s + x).alias("products"),
        (F.element_at(codes, 1) + F.element_at(codes, -1)).alias("ends"),
    )

    def test(of: Column, mean: Column) -> Column:
        square = of["squares"] - of["total"] * mean
        lagged = of["products"] - mean * (2 * of["total"] - of["ends"]) + (n - 1) * mean * mean
        varied = n * of["squares"] > of["total"] * of["total"]
        return F.when(varied, _two_sided((lagged / square + 1 / n) * F.sqrt(n))).otherwise(0.0)

    return bind(sums, lambda of: bind(of["total"] / n, lambda mean: test(of, mean)))


def _tested(bare: Column, known: Column, body: Callable[..., Column]) -> Column:
    """``body`` of the encoding of a token without padding and its p-values: uniformity, runs, serial correlation."""

    def tests(chars: Column, name: Column, bare: Column, symbols: Column, size: Column, n: Column) -> Column:
        codes = F.transform(chars, lambda ch: F.instr(symbols, ch) - 1)
        return body(
            name,
            uniformity(chars, size, n),
            bind(_in_halves(bare, name), lambda halves: runs(halves, n)),
            bind(codes, lambda c: serial_correlation(c, n)),
        )

    def coded(bare: Column, name: Column, symbols: Column) -> Column:
        sizes = F.struct(F.length(symbols).alias("size"), F.length(bare).cast("double").alias("n"))
        return bind(
            F.split(bare, ""),
            lambda chars: bind(sizes, lambda of: tests(chars, name, bare, symbols, of["size"], of["n"])),
        )

    return bind(known, lambda name: bind(_looked_up(name, SYMBOLS), lambda symbols: coded(bare, name, symbols)))


def battery(token: Column) -> Column:
    """The inferred encoding of a token and the three p-values of its symbols being random and independent."""

    def every(name: Column, uniform: Column, of_runs: Column, serial: Column) -> Column:
        return F.struct(
            name.alias("encoding"), uniform.alias("p_uniform"), of_runs.alias("p_runs"), serial.alias("p_serial")
        )

    return bind(F.regexp_replace(token, "=+$", ""), lambda bare: _tested(bare, _alphabet(bare), every))


def _score(p: Column) -> Column:
    """The score of a token whose least p-value is ``p``."""
    return F.least(3 * p, F.lit(1.0))


def _step(score: Column) -> Column:
    """Scores in a fixed number of steps keep the tables of counts at a bounded size."""
    return F.floor(score * 200).cast("int")


def least_step(*p_values: Column) -> Column:
    """The step of the least of some p-values. None is computed behind one in the lowest step, as it could not lower that."""

    def least(p: Column, rest: tuple[Column, ...]) -> Column:
        if not rest:
            return _step(_score(p))
        return F.when(_step(_score(p)) == 0, 0).otherwise(bind(rest[0], lambda q: least(F.least(p, q), rest[1:])))

    return bind(p_values[0], lambda p: least(p, p_values[1:]))


# Null alphabets in which letters and digits lie in different halves, so that a number between words shows in the runs.
_SPLIT = ("base62", "any")


def step_of(token: Column, encoding: Column) -> Column:
    """The step of the score of a token of known encoding, without padding.

    The test that most often fails in its alphabet comes first.
    """

    def ordered(name: Column, uniform: Column, of_runs: Column, serial: Column) -> Column:
        split = name.isin(*_SPLIT)
        return F.when(split, least_step(of_runs, uniform, serial)).otherwise(least_step(uniform, of_runs, serial))

    return _tested(token, encoding, ordered)


def _null_alphabet(encoding: Column) -> Column:
    return F.coalesce(_looked_up(encoding, NULL_OF), encoding)


def _length_class(token: Column) -> Column:
    return sum(((F.length(token) >= n).cast("int") for n in CLASS_LENGTHS), F.lit(0))


def _scored(tokens: DataFrame) -> DataFrame:
    """The ``token`` with ``encoding``, ``null_alphabet``, ``score``, ``length_class`` and ``step``."""
    scored = tokens.withColumn("t", battery(F.col("token"))).select(
        "token",
        F.col("t.encoding").alias("encoding"),
        _null_alphabet(F.col("t.encoding")).alias("null_alphabet"),
        _score(F.least("t.p_uniform", "t.p_runs", "t.p_serial")).alias("score"),
        _length_class(F.col("token")).alias("length_class"),
    )
    return scored.withColumn("step", _step(F.col("score")))


def prose_scores(bodies: DataFrame) -> DataFrame:
    """The null: how many different runs of prose (``prose``) of all texts, by ``length_class``, ``null_alphabet``, ``step``.

    Runs are scored where they are cut, and leave their task as a hash and a step.
    """
    names = bodies.select(F.explode(prose_runs(F.col("body"), STRETCH, len(BLOCKS))).alias("p"))
    cell = ("length_class", "null_alphabet", "step")
    scored = names.select(
        F.xxhash64("p.token", "p.encoding").alias("key"),
        _length_class(F.col("p.token")).alias("length_class"),
        _null_alphabet(F.col("p.encoding")).alias("null_alphabet"),
        step_of(F.col("p.token"), F.col("p.encoding")).alias("step"),
    )
    different = scored.distinct()
    return written(different.groupBy(*cell).agg(F.count("*").alias("prose")), "secret-null")


def judged(tokens: DataFrame, null: DataFrame, rate: float, min_p: float, parts: int) -> DataFrame:
    """The distinct tokens with ``encoding``, ``score``, ``q`` and ``secret``.

    ``tokens`` has ``token``, ``null`` the counts of ``prose_scores``. A token's score is the least
    of its p-values times three, so near or above 1 for a random string. Words of prose with a number, of
    its length class and in its alphabet, are the null: the share that scores at least as high is the token's chance of
    being ordinary. ``q`` is the share of false discoveries among tokens of its length class and alphabet
    with as small a chance (Benjamini and Hochberg); the number of ordinary tokens is estimated from
    those with a chance above one half (Storey).
    """
    asked = tokens.select("token").distinct()
    # Tokens are few bytes but much work: their tasks are cut by number, not by bytes.
    scored = written(_scored(asked.repartition(parts, "token")), "secret-scores")
    counts = scored.groupBy("length_class", "null_alphabet", "step").agg(F.count("*").alias("tokens"))
    counts = counts.join(null, ["length_class", "null_alphabet", "step"], "full").na.fill(0, ["tokens", "prose"])
    cell = Window.partitionBy("length_class", "null_alphabet")
    # One more run than seen: no cell is free of false discoveries.
    chance = (F.sum("prose").over(cell.orderBy(F.desc("step"))) + 1) / (F.sum("prose").over(cell) + 1)
    found = F.sum("tokens").over(cell.orderBy("chance"))
    likely = 2 * (F.sum(F.when(F.col("chance") > 0.5, F.col("tokens")).otherwise(0)).over(cell) + 1)
    ordinary = F.least(F.sum("tokens").over(cell), likely)
    levels = counts.withColumn("chance", chance)
    levels = levels.withColumn("raw", F.when(found > 0, F.col("chance") * ordinary / found).otherwise(1.0))
    q = F.least(F.min("raw").over(cell.orderBy(F.desc("chance"))), F.lit(1.0))
    levels = levels.select("length_class", "null_alphabet", "step", q.alias("q"))
    kept = scored.join(levels, ["length_class", "null_alphabet", "step"])
    return kept.select("token", "encoding", "score", "q", ((F.col("q") <= rate) & (F.col("score") >= min_p)).alias("secret"))


def base_spans(body: Column) -> Column:
    """Array of (start, rank, kind, stop) by start, then kind as listed."""

    def named(rank: int, kind: Kind) -> Column:
        return F.transform(
            kind_spans(body, kind),
            lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), s["stop"].alias("stop")),
        )

    return F.sort_array(F.concat(*(named(i, k) for i, k in enumerate(KINDS))))


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.05, min_p: float = 0.01
) -> DataFrame:
    """One row per document: ``id``, ``spans`` (base spans) and ``random`` (spans of random tokens).

    Base spans are assignments to a secret's name, access keys and hexadecimal runs. Random tokens
    hold letters and a digit, number 16 symbols or more, overlap no base span, and pass a battery
    of tests for their inferred encoding: chi-squared uniformity, runs, and serial correlation.
    They are held to a false-discovery rate of ``rate`` within their length class and alphabet, estimated
    from all words of prose of the whole table, in runs with a number in that alphabet,
    and to a least p-value of ``min_p``. A table without prose has no null, and no random tokens.

    Null texts are empty and have no spans. Null ids and repeated rows are handled like others.
    Other columns are not read; no rows give no rows.
    """
    bodies = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body"))
    row = F.struct("id", F.xxhash64("body").alias("text_key"))
    spans = bodies.select(row.alias("row"), "body", base_spans(F.col("body")).alias("spans"))
    tokens = F.when(F.col("body").rlike(TOKEN), matches(F.col("body"), TOKEN)).otherwise(F.array().cast(SPAN))
    lettered = F.filter(tokens, lambda t: t["value"].rlike("[A-Za-z]"))
    free = F.filter(
        lettered, lambda t: ~F.exists("spans", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"]))
    )
    found = written(spans.select("row", "spans", free.alias("tokens")), "secret-spans")
    asked = found.select(F.explode("tokens.value").alias("token"))
    total = found.agg(F.sum(F.size("tokens"))).first()[0] or 0
    null = prose_scores(bodies)
    secret = judged(asked, null, rate, min_p, 1 + total // TOKENS_PER_TASK).where("secret").select("token")
    random = (
        found.select("row", F.explode("tokens").alias("t"))
        .select("row", "t.start", "t.stop", F.col("t.value").alias("token"))
        .join(secret, "token")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("random"))
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")
    joined = found.select("row", "spans").join(random, "row", "left")
    return joined.select("row", F.col("row.id").alias("id"), "spans", F.coalesce("random", none).alias("random"))


def span_digest(found: DataFrame) -> DataFrame:
    extra = F.transform(
        "random",
        lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit("random").alias("kind"), t["stop"].alias("stop")),
    )
    everything = F.sort_array(F.concat("spans", extra))
    counts = [count_of(F.col("spans"), k.name) for k in KINDS]
    return found.select("id", *counts, F.sha2(digest(F.col("spans")), 256).alias("base_sha256"), digest(everything).alias("spans"))
