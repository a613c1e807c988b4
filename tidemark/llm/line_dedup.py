"""Near-duplicate lines: a deletion-neighbourhood join over lines, one word or one character apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bind, maybe_among, running, text_or_empty, unique_name, written
from tidemark.operators.ranking import ranked


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


# White space that is not one space already; newlines bound lines.
_UNEVEN = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``at``, ``line`` (its words, one space apart) and ``key`` (a hash) of each line with a word."""
    body = text_or_empty(text_col)
    even = F.split(F.regexp_replace(body, _UNEVEN, " "), "\n")
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(body).alias("text_key"))
    return (
        docs.select(row.alias("row"), F.posexplode(even).alias("at", "line"))
        # The words' own hash is behind the filter, which repeats no more than the trimming.
        .withColumn("line", F.trim("line"))
        .where(F.col("line") != "")
        .withColumn("key", F.xxhash64("line"))
    )


def _spaces(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))


def _by_words(line: Column, min_words: int) -> Column:
    """Whether a line is compared by words; one of fewer words is by characters."""
    return _spaces(line) >= min_words - 1


def _tokens(line: Column, worded: Column) -> Column:
    return F.when(worded, F.split(line, " ")).otherwise(F.split(line, ""))


def _half_keys(line: Column, worded: Column, n: Column) -> Column:
    """(``ahead``, ``half``): hashes of the first and last halves of ``n`` words, as lines a word apart agree in one.

    A half has as many words as half of the shorter line, so each line has those for being
    the shorter and for being the longer one. Halves are cut out of the line as they are; the
    arguments are columns of their own, as functions of arrays would leave generated code.
    """

    def halves(n: Column) -> list[Column]:
        def part(m: Column, chars: Column) -> Column:
            return F.when(worded, F.call_function("substring_index", line, F.lit(" "), m)).otherwise(chars)

        first = F.xxhash64(F.lit(0), worded, n, part(n, F.left(line, n)))
        last = F.xxhash64(F.lit(1), worded, n, part(-n, F.right(line, n)))
        return [
            F.struct(F.lit(True).alias("ahead"), first.alias("half")),
            F.struct(F.lit(False).alias("ahead"), last.alias("half")),
        ]

    longer = F.floor(n / 2).cast("int")
    # For an odd number of words the two are the same.
    both = F.array(*halves(longer), *halves(longer - 1))
    return F.when((n % 2 == 0) & (n > 2), both).otherwise(F.array(*halves(longer)))


def _places(low: Column, middle: Column, high: Column, ahead: Column, behind: Column) -> Column:
    """The numbers from ``low`` below ``middle`` if ``behind``, and from there below ``high`` if ``ahead``."""
    none = F.array().cast("array<int>")
    return F.concat(
        F.when(behind & (low < middle), F.sequence(low, middle - 1)).otherwise(none),
        F.when(ahead & (middle < high), F.sequence(middle, high - 1)).otherwise(none),
    )


def _variants(words: Column, worded: Column, ahead: Column, behind: Column) -> Column:
    """Hashed keys (``a``, ``b``) of the line with one word left out, and of the line as what is left of a longer one.

    Equal keys mean that all words before and all after a place agree: ``swap`` keys join lines of
    one length that differ at that place, ``gap`` keys a line and one with a word more there.
    Words are hashed with their distance from the start, and from the end, so that all parts
    come from running totals, in time linear in the line. If only the first half is shared with
    another line (``ahead``) the places in it need no keys, nor if only the last is (``behind``).
    """
    n = F.size(words)
    zero = F.array(F.lit(0).cast("long"))
    from_start = F.transform(words, lambda w, i: F.xxhash64(w, i))
    from_end = F.transform(words, lambda w, i: F.xxhash64(w, i - n))

    def body(p: Column, s: Column) -> Column:
        # p[i]: words before i. s[n] ^ s[i]: words from i on.
        def keys(name: str, size: Column, high: Column, skipped: int) -> Column:
            def key(i: Column) -> Column:
                a = F.get(p, i).bitwiseXOR(F.xxhash64(F.lit(name), worded, size, i))
                return F.struct(a.alias("a"), F.get(s, n).bitwiseXOR(F.get(s, i + skipped)).alias("b"))

            return F.transform(_places(F.lit(0), F.floor(size / 2).cast("int"), high, ahead, behind), key)

        return F.concat(keys("swap", n, n, 1), keys("gap", n - 1, n, 1), keys("gap", n, n + 1, 0))

    return bind(
        F.concat(zero, running(from_start, "long", _xor)),
        lambda p: bind(F.concat(zero, running(from_end, "long", _xor)), lambda s: body(p, s)),
    )


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words or characters are equal but for one inserted, left out or replaced."""

    def tails(first: Column) -> Column:
        after_a = F.when(F.size(a) >= F.size(b), first + 1).otherwise(first)
        after_b = F.when(F.size(b) >= F.size(a), first + 1).otherwise(first)
        return F.slice(a, after_a, F.size(a) + 1) == F.slice(b, after_b, F.size(b) + 1)

    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, F.lit(False)).cast("int")
    return (F.abs(F.size(a) - F.size(b)) <= 1) & bind(first, lambda f: F.when(f == 0, True).otherwise(tails(f)))


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5, min_chars: int = 20
) -> DataFrame:
    """One row per document: ``row``, ``id``, ``n_lines``, ``n_dropped``, ``dropped`` (line numbers from 0).

    Lines are what newlines bound; their words are compared, not the white space between. An
    occurrence of a line with a word is dropped if an earlier one has the same words, or if any line
    with an earlier occurrence is one edit away: a word inserted, left out or replaced among lines
    of at least ``min_words`` words, a character among lines of fewer words (the case of scripts
    without spaces) that have at least ``min_chars`` characters. Lines shorter than both have only
    exact repeats, as one edit makes another line of them. Earlier means a smaller id, then a smaller line
    number; null ids come first. Dropped lines count as earlier ones too. Lines without a word stay.

    Only lines that share a half with another go into the neighbourhood join; there each group of
    equal variants is linked to its earliest line, never pair by pair, and links are verified on
    the words. Null and empty texts have one empty line. Rows that repeat id and text do not count
    as earlier than each other and get the same result. Other columns are not read; no rows give
    no rows.
    """
    if min_words < 2 or min_chars < 2:
        raise ValueError("lines of one word or character have no halves")
    worded = _by_words(F.col("line"), min_words)
    lines = _lines(docs, id_col, text_col).withColumn("spaces", _spaces(F.col("line")))
    lines = lines.withColumn("worded", F.col("spaces") >= min_words - 1)
    lines = lines.withColumn("size", F.when(F.col("worded"), F.col("spaces") + 1).otherwise(F.length("line")))
    eligible = F.col("worded") | (F.col("size") >= min_chars)
    halves_of = _half_keys(F.col("line"), F.col("worded"), F.col("size"))
    place = F.struct(F.col("row.id").alias("id"), "at")
    keyed = written(
        lines.select(
            "row",
            "at",
            "line",
            "key",
            F.xxhash64(F.lit(1), "line").alias("key2"),
            F.when(eligible, halves_of).alias("halves"),
        ),
        "lines",
    )
    firsts = written(
        keyed.groupBy("key", "key2").agg(F.min(place).alias("first"), F.count("*").alias("n")), "line-firsts"
    )
    halves = keyed.select("key", F.explode("halves").alias("h")).select("key", "h.ahead", "h.half")
    shared = halves.groupBy("half").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    shared = written(shared.select("half"), "line-halves")
    close = written(
        maybe_among(halves, shared, "half")
        .join(shared, "half")
        .groupBy("key")
        .agg(F.max("ahead").alias("ahead"), F.max(~F.col("ahead")).alias("behind")),
        "line-candidates",
    )
    # The text of each candidate once; the bitmap keeps the others out of the exchange.
    texts = (
        maybe_among(keyed.select("row", "at", "line", "key"), close)
        .groupBy("line")
        .agg(F.min("key").alias("key"), F.min(place).alias("first"))
        .join(close, "key")
        .withColumn("key2", F.xxhash64(F.lit(1), "line"))
    )
    # Numbered in the order of their first occurrence, so the least number is the earliest.
    texts = ranked(written(texts, "line-texts"), "nth", 0, "first", "key", "key2")
    both = (F.col("ahead"), F.col("behind"))
    keys = bind(worded, lambda w: bind(_tokens(F.col("line"), w), lambda t: _variants(t, w, *both)))
    variants = texts.select("nth", F.explode(keys).alias("v"))
    variants = written(variants.select("nth", "v.a", "v.b"), "line-variants")
    earliest = written(
        variants.groupBy("a", "b").agg(F.min("nth").alias("e_nth"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "line-neighbours",
    )
    linked = maybe_among(variants, earliest, "a").join(earliest, ["a", "b"]).where("e_nth < nth")
    linked = linked.select("nth", "e_nth").distinct()
    other = texts.select(F.col("nth").alias("e_nth"), F.col("line").alias("e_line"), F.col("first").alias("e_first"))
    def tokens(name: str) -> Column:
        return _tokens(F.col(name), _by_words(F.col(name), min_words))

    close_by = bind(tokens("line"), lambda a: bind(tokens("e_line"), lambda b: within_one_edit(a, b)))
    proven = (
        linked.join(other, "e_nth")
        .join(texts.select("nth", "key", "key2", "line"), "nth")
        .where(close_by)
        .groupBy("key", "key2")
        .agg(F.min("e_first").alias("near"))
    )
    # Only lines that may be dropped somewhere: those met twice, or with an earlier neighbour.
    known = written(
        firsts.join(proven, ["key", "key2"], "left")
        .where("n > 1 OR near < first")
        .select("key", "key2", F.least(F.col("first"), F.coalesce("near", "first")).alias("earliest")),
        "line-earliest",
    )
    dropped = (
        maybe_among(keyed.select("row", "at", "key", "key2"), known)
        .join(known, ["key", "key2"])
        .where(F.col("earliest") < place)
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("at")).alias("dropped"))
    )
    body = text_or_empty(text_col)
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(body).alias("text_key")).alias("row"),
        F.size(F.split(body, "\n")).cast("long").alias("n_lines"),
    )
    none = F.array().cast("array<int>")
    return rows.join(dropped, "row", "left").select(
        "row",
        F.col("row.id").alias("id"),
        "n_lines",
        F.size(F.coalesce("dropped", none)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", none).alias("dropped"),
    )


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with dropped lines cut out of the text; all columns stay, null texts stay null."""
    row, gone = unique_name(docs, "_row"), unique_name(docs, "_gone")
    found = repeated_lines(docs, id_col, text_col, **options).where("n_dropped > 0")
    found = found.select(F.col("row").alias(row), F.col("dropped").alias(gone)).dropDuplicates([row])
    body = text_or_empty(text_col)
    keyed = docs.withColumn(row, F.struct(F.col(id_col).alias("id"), F.xxhash64(body).alias("text_key")))
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(F.col(gone), i))
    changed = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return keyed.join(found, row, "left").withColumn(text_col, changed).select(*docs.columns)
