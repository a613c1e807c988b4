"""Quality rules as a short-circuit cascade in the order of rejections per cost."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, bind, text_or_empty, unique_name, words_of, written


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL over the metrics and ``body``, the text (never null)."""

    name: str
    rejects: str


# The expressions of the cascade hold for prose in any of the corpus languages.
DEFAULT_RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.3 * size(split(body, '\\n'))"),
    Rule("capitals", r"regexp_count(body, '\\p{Lu}') > 0.4 * word_chars"),
    Rule("exclamation", "regexp_count(body, '[!?]') > 0.2 * n_words"),
    Rule("no_letters", r"5 * regexp_count(body, '(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D\\p{L}]++(?![^\\x20\\x09-\\x0D])') > n_words"),
    Rule("ellipses", r"regexp_count(body, '(?:\\.\\.\\.|…)[\\x20\\x09\\x0B-\\x0D]*(?:\\n|$)') > 0.3 * size(split(body, '\\n'))"),
)

SYMBOL_COMPLEMENT = r"[^#*$%&|<>]+"
WINDOW = 5


def repeated_words(words: Column) -> Column:
    """Words covered by the five-word windows found twice or more.

    Hashes show whether any window repeats at all; only then are windows compared as text.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    grams = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("gram"), i.alias("at")))
    )

    def covered(ordered: Column) -> Column:
        def again(x: Column, j: Column) -> Column:
            before, after = F.get(ordered, j - 1), F.get(ordered, j + 1)
            return F.coalesce(before["gram"] == x["gram"], F.lit(False)) | F.coalesce(after["gram"] == x["gram"], F.lit(False))

        places = F.transform(F.filter(ordered, again), lambda x: F.sequence(x["at"], x["at"] + WINDOW - 1))
        return F.size(F.array_distinct(F.flatten(places)))

    repeats = bind(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= WINDOW, 0).when(repeats, bind(grams, covered)).otherwise(0).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_metrics(body: str) -> Column:
    """A struct of the five measures of the text in column ``body``."""
    text = F.col(body)
    return bind(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, SYMBOL_COMPLEMENT, "")).cast("long").alias("n_symbols"),
            repeated_lines(text).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )


def measured(docs: DataFrame, text_col: str, *kept: Column) -> DataFrame:
    """The kept columns, the text as ``body``, the measures and ``base_failed``."""
    return (
        docs.select(*kept, text_or_empty(text_col).alias("body"))
        .withColumn("measures", base_metrics("body"))
        .select("*", "measures.*")
        .drop("measures")
        .withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
    )


def cascade_order(sample: DataFrame, rules: Sequence[Rule]) -> list[tuple[Rule, float, float]]:
    """The rules by falling rejections per second, each with its share and seconds on the sample.

    A rule is run twice and timed warm; what a job costs by itself is taken off.
    """

    def run(rejects: str) -> tuple[float, int, int]:
        start = time.perf_counter()
        n, hits = sample.agg(F.count("*"), F.count_if(F.expr(rejects))).first()
        return time.perf_counter() - start, n, hits

    def warm(rejects: str) -> tuple[float, int, int]:
        run(rejects)
        return run(rejects)

    idle = warm("body IS NULL")[0]
    found = []
    for rule in rules:
        seconds, n, hits = warm(rule.rejects)
        found.append((rule, hits / max(n, 1), max(seconds - idle, 1e-4)))
    return sorted(found, key=lambda x: (-x[1] / x[2], x[2], x[0].name))


def cascade(order: Sequence[Rule]) -> Column:
    """The first rule that rejects; later ones are not evaluated then. Null: none does."""
    verdict = F.when(F.col("base_failed"), "base")
    for rule in order:
        verdict = verdict.when(F.expr(rule.rejects), rule.name)
    return verdict


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Sequence[Rule] = DEFAULT_RULES,
    sample_rows: int = 1000,
    seed: int = 7,
) -> DataFrame:
    """One row per document: ``id``, the measures, ``base_failed``, ``rejected_by``, ``kept``.

    Costs and selectivities come from about ``sample_rows`` rows drawn over the whole table; they
    set the order in which rules are tried, never a verdict. ``rejected_by`` is the first rule in
    that order. Null, empty and blank texts have no words and fail the base rule. Repeated rows
    are judged alike; other columns are not read; an empty table gives no rows.
    """
    rows = docs.count()
    sample = docs.sample(fraction=min(1.0, sample_rows / max(rows, 1)), seed=seed)
    tried = written(measured(sample, text_col), "rule-sample")
    order = [rule for rule, _, _ in cascade_order(tried, rules)]
    found = measured(docs, text_col, F.col(id_col).alias("id")).withColumn("rejected_by", cascade(order))
    return found.drop("body").withColumn("kept", F.col("rejected_by").isNull())


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents no rule rejects, with all their columns."""
    good_id = unique_name(docs, "_good_id")
    kept = quality_rules(docs, id_col, text_col, **options).where("kept").select(F.col("id").alias(good_id)).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col(good_id)), "left_semi")
