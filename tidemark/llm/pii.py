"""Personal data: base spans, and terms that disclose what the spans protect wherever they stand."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bind, text_or_empty, unique_name, written
from tidemark.llm.spans import Kind, count_of, digest, kind_spans, matches


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    def weighed(d: Column, i: Column) -> Column:
        return F.substring(d, -i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)

    def total(d: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.length(d)),
            F.lit(0),
            lambda s, i: bind(weighed(d, i), lambda v: s + F.floor(v / 10).cast("int") + v % 10),
        )

    return bind(_digits(m), lambda d: F.when(F.length(d).between(13, 19), total(d) % 10 == 0).otherwise(False))


_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

KINDS = (
    Kind(
        "email",
        # A match starts where a run of its characters starts, or where the match before it ended.
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        needs="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        test=lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        needs=r"[0-9]\.[0-9]",
    ),
    # Runs of fewer than 13 digits never hold, so they need not be found.
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12,}+", test=_luhn, needs="[0-9]"),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        test=lambda m: F.length(_digits(m)).between(9, 15),
        needs=r"\+[0-9]",
    ),
)
# Letters that stand alone, and so are no part of an address.
TERM = r"(?<![\p{L}0-9._%+@-])\p{L}{3,}+(?![0-9_%+@-]|\.[A-Za-z0-9])"
KINDS_AND_TERM = (*(k.name for k in KINDS), "term")


def base_spans(body: Column) -> Column:
    """Array of (kind, start, stop, entity) by kind as listed, then start."""

    def named(kind: Kind) -> Column:
        value = (lambda m: F.lower(m)) if kind.name in ("email", "ip") else _digits
        return F.transform(
            kind_spans(body, kind),
            lambda s: F.struct(
                F.lit(kind.name).alias("kind"),
                s["start"].alias("start"),
                s["stop"].alias("stop"),
                F.concat(F.lit(kind.name + ":"), value(s["value"])).alias("entity"),
            ),
        )

    return F.concat(*(named(k) for k in KINDS))


def terms_of(body: Column) -> Column:
    """The distinct terms of a text, lower-cased."""
    found = F.array_distinct(F.regexp_extract_all(body, F.lit(TERM), F.lit(0)))
    return F.array_distinct(F.transform(found, F.lower))


def disclosures(
    based: DataFrame, rows: int, min_bits: float, alpha: float, generalise_at: float, remove_at: float
) -> DataFrame:
    """``term``, ``disclosure``, ``action`` of the terms that tell too much of an entity.

    ``based`` has ``row``, ``entities`` and ``terms``. The disclosure of an entity by a term is their
    pointwise mutual information over whole documents as a share of the entity's own information: 1
    if each document with the term has the entity. A pair counts if it is met in two different texts
    or more and, at the level ``alpha`` divided by the number of pairs, oftener than two independent
    things would be (Chernoff's bound of the Poisson tail; copies of one text are one meeting).
    """
    bits = F.log2(F.lit(float(max(rows, 1))) / F.col("n_entity"))
    held = based.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    # The most documents a term can be in and still disclose the entity so much.
    held = held.withColumn("bits", bits).withColumn("most", F.col("n_entity") * F.pow(F.lit(2.0), (1 - generalise_at) * F.col("bits")))
    held = written(held.where((F.col("bits") >= min_bits) & (F.col("n_entity") >= 2)), "pii-entities")
    most = held.agg(F.max("most")).first()[0] or 0.0
    known = based.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    known = known.where((F.col("n_term") >= 2) & (F.col("n_term") <= most))
    carried = (
        based.select("row.text_key", F.explode("entities").alias("entity"))
        .join(held, "entity")
        .groupBy("text_key", "entity", "n_entity", "bits", "most")
        .agg(F.count("*").alias("copies"))
    )
    said = based.where(F.size("entities") > 0).select("row.text_key", F.explode("terms").alias("term")).distinct()
    pairs = written(
        said.join(known, "term")
        .join(carried, "text_key")
        .where("n_term <= most")
        .groupBy("entity", "term", "n_entity", "n_term", "bits")
        .agg(F.sum("copies").alias("n_pair"), F.count("*").alias("n_texts")),
        "pii-pairs",
    )
    by_chance = F.col("n_entity") * F.col("n_term") / float(max(rows, 1))
    log_tail = F.col("n_texts") - by_chance + F.col("n_texts") * F.log(by_chance / F.col("n_texts"))
    level = math.log(alpha) - math.log(max(pairs.count(), 1))
    real = (F.col("n_texts") >= 2) & (F.col("n_texts") > by_chance) & (log_tail <= level)
    shared = F.least(F.col("n_pair") / F.col("n_term"), F.lit(1.0))
    told = pairs.where(real).select("term", (1 + F.log2(shared) / F.col("bits")).alias("disclosure"))
    told = told.groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= generalise_at)
    return told.withColumn("action", F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise"))


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bits: float = 6.0,
    alpha: float = 0.01,
    generalise_at: float = 0.8,
    remove_at: float = 0.95,
) -> DataFrame:
    """One row per document: ``row``, ``id``, ``spans`` (its base spans), ``terms`` (its term spans).

    Base spans are mail addresses, IP addresses, card and phone numbers. Terms are words of three
    letters or more whose co-occurrence with one such value over whole documents discloses at least
    ``generalise_at`` of it, significantly so at the level ``alpha`` (``disclosures``); each of their
    occurrences is marked, in documents without the value as well. Values that carry fewer than
    ``min_bits`` (found in a large share of the documents) are public and disclosed by nothing.
    Counts cover the whole table.

    Null texts are empty and have no spans. Null ids and repeated rows are handled like others:
    rows that repeat id and text get the same spans. Other columns are not read; no rows give no
    rows.
    """
    bodies = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body"))
    row = F.struct("id", F.xxhash64("body").alias("text_key"))
    found = bodies.select(row.alias("row"), base_spans(F.col("body")).alias("spans"), terms_of(F.col("body")).alias("terms"))
    entities = F.array_distinct(F.transform("spans", lambda s: s["entity"]))
    based = written(found.withColumn("entities", entities), "pii-base")
    telling = written(disclosures(based, based.count(), min_bits, alpha, generalise_at, remove_at), "pii-terms")
    marked = (
        based.select("row", F.explode("terms").alias("term"))
        .join(telling, "term")
        # Repeated rows only, and after the join: few words of a text disclose anything.
        .select("row", "term", "action")
        .distinct()
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions"))
    )
    placed = F.transform(
        matches(F.col("body"), TERM),
        lambda m: F.struct(
            m["start"].alias("start"), m["stop"].alias("stop"), F.element_at("actions", F.lower(m["value"])).alias("action")
        ),
    )
    terms = (
        bodies.withColumn("row", row)
        .join(marked, "row")
        .select("row", F.filter(placed, lambda t: t["action"].isNotNull()).alias("terms"))
        .dropDuplicates(["row"])
    )
    none = F.array().cast("array<struct<start:int,stop:int,action:string>>")
    return (
        based.select("row", "spans")
        .join(terms, "row", "left")
        .select("row", F.col("row.id").alias("id"), "spans", F.coalesce("terms", none).alias("terms"))
    )


def all_spans() -> Column:
    """The base spans, then the term spans, as (kind, start, stop)."""
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    term = F.transform("terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["stop"].alias("stop")))
    return F.concat(base, term)


def span_digest(found: DataFrame) -> DataFrame:
    counts = [count_of(F.col("spans"), k.name) for k in KINDS]
    return found.select(
        "id", *counts, F.sha2(digest(F.col("spans")), 256).alias("base_sha256"), digest(all_spans()).alias("spans")
    )


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with base spans and generalised terms replaced by their kind, other terms removed.

    Where spans overlap, the first counts. All columns stay; null texts stay null.
    """
    row, marks = unique_name(docs, "_row"), unique_name(docs, "_marks")
    label = F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("label"))
    )
    term = F.transform(
        "terms", lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), F.when(t["action"] == "remove", "").otherwise("[TERM]").alias("label"))
    )
    found = personal_data(docs, id_col, text_col, **options).where("size(spans) + size(terms) > 0")
    found = found.select(F.col("row").alias(row), F.sort_array(F.concat(label, term)).alias(marks)).dropDuplicates([row])
    body = text_or_empty(text_col)

    def apply(m: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            pieces = F.concat(acc["out"], F.array(F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), s["label"]))
            return F.when(s["start"] >= acc["at"], F.struct(s["stop"].alias("at"), pieces.alias("out"))).otherwise(acc)

        return F.aggregate(m, empty, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(body, acc["at"] + 1, F.length(body))))

    keyed = docs.withColumn(row, F.struct(F.col(id_col).alias("id"), F.xxhash64(body).alias("text_key")))
    joined = keyed.join(found, row, "left")
    changed = F.when(F.col(marks).isNull(), F.col(text_col)).otherwise(apply(F.col(marks)))
    return joined.withColumn(text_col, changed).select(*docs.columns)
