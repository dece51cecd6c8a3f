"""Queries op1 to op13: each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import (
    divergence, exact_dedup, fingerprints, html_text, language_model, line_dedup, mixing, near_dedup, nearest, packing, prefix_trie, quality, substring_dedup,
)
from lendscope.llm.tables import table

VOCABULARY = "byte_bpe_50k"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


LINE_DEDUP_SQL = r"""
WITH pages AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
each AS (SELECT source, line, count(*) AS n FROM (
    SELECT DISTINCT doc_id, source, unnest(list_transform(parts, lambda x: trim(x, ' ' || chr(9) || chr(13)))) AS line FROM pages)
  WHERE line <> '' GROUP BY ALL),
total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
found AS (SELECT each.source, list(line) AS lines FROM each JOIN total ON each.source IS NOT DISTINCT FROM total.source
  WHERE n >= 5 AND n > 0.08 * total.pages GROUP BY each.source),
kept AS (SELECT doc_id, parts,
    list_filter(parts, lambda x: NOT coalesce(list_contains(lines, trim(x, ' ' || chr(9) || chr(13))), false)) AS stays
  FROM pages LEFT JOIN found ON pages.source IS NOT DISTINCT FROM found.source)
SELECT doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(parts) - len(stays), 0) AS BIGINT) AS n_dropped, array_to_string(stays, chr(10)) AS text FROM kept
"""


@_query("op1_line_dedup", LINE_DEDUP_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs).select("doc_id", "n_lines", "n_dropped", "text")


MIXING_SQL = r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS key FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
    CAST(3 * source_size AS DOUBLE) AS cap FROM sums),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER before, 0)) / sum(weight) OVER on_ AS level
  FROM weighted WINDOW before AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    on_ AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
shared AS (SELECT min_by(level, cap / weight) AS level FROM levels WHERE level <= cap / weight),
targets AS (SELECT source, source_size, least(cap, coalesce(weight * shared.level, cap)) AS target FROM levels, shared),
runs AS (SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS budget,
    CAST(coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) END AS BIGINT) AS taken
FROM runs
"""


@_query("op10_mixing", MIXING_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@_query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.quality_scores(documents, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def vocabulary(kind: str = "tiktoken") -> str:
    """Path of the byte-level vocabulary. The ranks give the same ids as the .json file, several times faster."""
    import public_tokenizers

    return public_tokenizers.path(f"{VOCABULARY}.{kind}")


@_query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary())


@_query("op6_language_model")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@_query("op4_html_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


@_query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


@_query("op8_nearest")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)


TRIE_SQL = r"""
WITH turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (SELECT c, turn, strlen(text) AS size, sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS content FROM turns),
placed AS (SELECT c, content, size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, content) AS place FROM hashed),
convs AS (SELECT c, count(*) AS own, c - c % 5 AS base, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x >> 1, (x & 1) * CAST(3988292384 AS BIGINT))))) % 9 AS h FROM placed GROUP BY c),
plans AS (SELECT convs.c, convs.base, convs.h, convs.own, least(convs.h, coalesce(b.own, 0)) AS k
  FROM convs LEFT JOIN convs AS b ON b.c = convs.base),
rebuilt AS (SELECT plans.c, place AS d, content, size FROM plans JOIN placed ON placed.c = plans.base AND place <= k
  UNION ALL SELECT plans.c, place - h + k, content, size FROM plans JOIN placed ON placed.c = plans.c AND place > h),
prefix AS (SELECT c, d, size, string_agg(content, '') OVER (PARTITION BY c ORDER BY d) AS key FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM plans),
nodes AS (SELECT d, key, min(c) AS node, count(*) AS n, max(size) AS size FROM prefix GROUP BY d, key),
member AS (SELECT prefix.c, prefix.d, nodes.node FROM prefix JOIN nodes ON nodes.d = prefix.d AND nodes.key = prefix.key),
linked AS (SELECT nodes.*, member.node AS parent FROM nodes LEFT JOIN member ON member.c = nodes.node AND member.d = nodes.d - 1),
children AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN children ON children.parent = linked.node AND children.d = linked.d),
totals AS (SELECT member.node, member.d, sum(CASE WHEN full_.n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((full_.n - 1) * full_.size) AS saved
  FROM full_ JOIN member ON member.c = full_.node AND member.d <= full_.d GROUP BY ALL),
ends AS (SELECT member.node, member.d, string_agg(CAST(member.c AS VARCHAR), ',' ORDER BY member.c) AS ids
  FROM member JOIN plans ON plans.c = member.c AND member.d = k + greatest(0, own - h) GROUP BY ALL)
SELECT full_.node AS conv_id, CAST(full_.d AS BIGINT) AS depth, full_.parent AS parent_conv_id, full_.n AS n_convs, CAST(full_.n_children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_ JOIN totals ON totals.node = full_.node AND totals.d = full_.d LEFT JOIN ends ON ends.node = full_.node AND ends.d = full_.d
"""


@_query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


EXACT_SQL = r"""
WITH bodies AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
numbered AS (SELECT doc_id, body, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) AS place FROM bodies WINDOW same AS (PARTITION BY body))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM numbered
"""


@_query("op12_exact_dedup", EXACT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


DIVERGENCE_SQL = r"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occurrences AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
counts AS (SELECT lang, source, term, n FROM occurrences SEMI JOIN kept USING (lang, term)),
groups_ AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
shares AS (SELECT groups_.lang, groups_.source, kept.term, coalesce(n, 0) AS n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5)) // (coalesce(total, 0) + 5 * v) AS BIGINT) AS p
  FROM groups_ JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN counts USING (lang, source, term) LEFT JOIN totals USING (lang, source)),
langs AS (SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (sum(n) + 5)) // (total + 5 * v) AS BIGINT) AS q
  FROM shares JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) GROUP BY lang, term, total, v),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value FROM shares x
    JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
  ON d.lang = a.lang AND d.source = a.source AND d.other = b.source),
rows_ AS (SELECT * FROM pairs UNION ALL
  SELECT shares.lang, source, 'term', term, p - q FROM shares JOIN langs USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM rows_)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@_query("op13_source_divergence", DIVERGENCE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))
