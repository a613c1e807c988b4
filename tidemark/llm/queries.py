"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    exact_dedup,
    importance,
    language,
    line_dedup,
    mixing,
    packing,
    phrases,
    pii,
    prefix_trie,
    quality_rules,
    secrets,
    sharding,
    simhash,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(_documents(spark, sf_dir))
    return found.drop("rejected_by").withColumnRenamed("id", "doc_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_documents(spark, sf_dir))
    return pii.span_digest(found).withColumnRenamed("id", "doc_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_fingerprint().alias("fingerprint"), "component_id"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(_documents(spark, sf_dir), shards=8)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixture(_documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_documents(spark, sf_dir))
    return secrets.span_digest(found).withColumnRenamed("id", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_lines(_documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.array_join("dropped", ",").alias("dropped")
    )


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = importance.importance_resampling(_documents(spark, sf_dir), labels)
    return found.withColumnRenamed("id", "doc_id")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_personal_data": op3_personal_data,
    "op4_simhash": op4_simhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_line_dedup": op9_line_dedup,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_language_id": op11_language_id,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op1_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        w AS (
            SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, string_split(body, chr(10)) AS lines
            FROM d),
        windows AS (
            SELECT doc_id, spot, array_to_string(list_slice(words, spot, spot + 4), ' ') AS gram
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS spot FROM w WHERE len(words) >= 5)),
        again AS (SELECT doc_id, spot, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows),
        repeats AS (
            SELECT doc_id, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(spot, spot + 5)) AS place FROM again WHERE n > 1) GROUP BY doc_id),
        measured AS (
            SELECT doc_id, body, words, lines, len(words)::BIGINT AS n_words,
                   length(array_to_string(words, ''))::BIGINT AS word_chars,
                   length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                   list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
            FROM w LEFT JOIN repeats USING (doc_id)),
        counted AS (
            SELECT *, (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
                   n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
            FROM measured)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed
                    OR 10 * n_symbols > n_words
                    OR word_chars < 2 * n_words
                    OR word_chars > 20 * n_words
                    OR n_dup_lines > 0.3 * len(lines)
                    OR len(regexp_extract_all(body, '\p{Lu}')) > 0.4 * word_chars
                    OR len(regexp_extract_all(body, '[!?]')) > 0.2 * n_words
                    OR 5 * len(list_filter(words, lambda x: NOT regexp_matches(x, '\p{L}'))) > n_words
                    OR len(regexp_extract_all(body, '(?:\.\.\.|…)[\x20\x09\x0B-\x0D]*(?:\n|$)')) > 0.3 * len(lines)
               ) AS kept
        FROM counted""",
    "op5_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY body)""",
    "op7_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS bound,
                   [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source),
        levels AS (
            SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
                       - coalesce(sum(bound) OVER below, 0)::BIGINT) / (sum(weight) OVER above)::BIGINT AS level
            FROM sources
            WINDOW below AS (ORDER BY bound::DOUBLE / weight, source NULLS LAST
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   above AS (ORDER BY bound::DOUBLE / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        wanted AS (
            SELECT source, source_size, least(bound::DOUBLE, max(level) OVER () * weight) AS target,
                   ('0x' || substr(md5('11:' || coalesce('=' || source, 'null')), 1, 5))::BIGINT
                       / 1048576::DOUBLE AS start
            FROM levels),
        ranked AS (
            SELECT doc_id, source, size,
                   row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS place
            FROM sized),
        placed AS (
            SELECT r.*, w.source_size, w.target, w.start,
                   CASE WHEN w.source_size > 0 THEN w.target / w.source_size ELSE 0 END AS rate
            FROM ranked r JOIN wanted w ON r.source IS NOT DISTINCT FROM w.source),
        taken AS (
            SELECT *, (floor(start + place * rate) - floor(start + (place - 1) * rate))::BIGINT AS copies
            FROM placed)
        SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        runs AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM split) WHERE len(w) >= k)),
        counts AS (SELECT lang, phrase, k, count(*) AS f FROM runs GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
        candidates AS (
            SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 100),
        inner_ AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer
            FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
                  FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates)) GROUP BY ALL),
        cuts AS (
            SELECT lang, phrase, f AS a, w, k, unnest(range(1, k)) AS cut
            FROM candidates c LEFT JOIN inner_ i USING (lang, phrase) WHERE longer IS NULL OR longer < f),
        scored AS (
            SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n,
                   ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c JOIN totals USING (lang)
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op13_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        crc AS (
            SELECT i, list_reduce(list_prepend(i, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS word
            FROM range(256) AS t(i)),
        table_ AS (SELECT list(word ORDER BY i) AS words FROM crc),
        ids AS (SELECT DISTINCT conv_id FROM turns),
        hashed AS (
            SELECT conv_id, conv_id - conv_id % 20 AS base,
                   (xor(list_reduce(list_prepend(4294967295,
                        list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                        lambda c, b: xor(c >> 8, words[xor(c & 255, b) + 1])), 4294967295)) % 4 AS h
            FROM ids, table_),
        heads AS (
            SELECT h.conv_id, t.pos AS depth, role, text
            FROM hashed h JOIN turns t ON t.conv_id = h.base AND t.pos <= h.h),
        begun AS (
            SELECT conv_id, h, (SELECT count(*) FROM heads x WHERE x.conv_id = hashed.conv_id) AS n FROM hashed),
        rebuilt AS (
            SELECT * FROM heads
            UNION ALL
            SELECT t.conv_id, b.n + t.pos - b.h, role, text FROM turns t JOIN begun b USING (conv_id) WHERE t.pos > b.h),
        sequences AS (
            SELECT i.conv_id,
                   coalesce(list(r.role || chr(0) || r.text ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS s,
                   coalesce(list(len(regexp_extract_all(r.text, '[^\x20\x09-\x0D]+')) ORDER BY depth)
                            FILTER (WHERE depth IS NOT NULL), []) AS w
            FROM ids i LEFT JOIN rebuilt r USING (conv_id) GROUP BY i.conv_id),
        prefixes AS (
            SELECT conv_id, len(s) AS size, d, s[1:d] AS p, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words
            FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM sequences)),
        nodes AS (
            SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends
            FROM prefixes GROUP BY p, d),
        counted AS (
            SELECT n.*, parent.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.p[1:n.d] = n.p) AS n_children
            FROM nodes n LEFT JOIN nodes parent ON parent.d = n.d - 1 AND parent.p = n.p[1:n.d - 1]),
        below AS (
            SELECT p[1:a] AS top, a, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
                   sum((n_convs - 1) * words) AS saved
            FROM (SELECT *, unnest(range(d + 1)) AS a FROM counted) GROUP BY ALL)
        SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves,
               saved::BIGINT AS saved_tokens, ends AS ends_sha256
        FROM counted JOIN below ON p = top AND d = a""",
}
