"""The operators of this package over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.alignment import aligned_counts
from panelforge.llm.decontamination import find_items
from panelforge.llm.fingerprints import fingerprint_edits
from panelforge.llm.html import extract
from panelforge.llm.language import predict_language
from panelforge.llm.lines import remove_repeated_blocks
from panelforge.llm.neardup import near_duplicates
from panelforge.llm.packing import pack
from panelforge.llm.sharding import interleave
from panelforge.llm.simhash import near_copies
from panelforge.llm.substrings import remove_repeats
from panelforge.llm.tables import table
from panelforge.llm.tokens import count_with_edits
from panelforge.llm.trie import prefix_trie


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"), shards=40)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits a document: a twentieth is cut from the middle, eight code points are replaced by the
    last eight, and the first twenty are added at the end."""
    docs = table(spark, sf_dir, "documents")
    edits = F.expr("""
        transform(array(char_length(coalesce(text, ''))), n -> array(
            struct(n div 4 AS start, least(n div 4 + 8, n div 2) AS end, right(text, 8) AS insert),
            struct(n div 2 AS start, n div 2 + n div 20 AS end, '' AS insert),
            struct(n AS start, n AS end, left(text, 20) AS insert)
        ))[0]
    """)
    return count_with_edits(docs, edits)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "keep")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_lines", F.size(F.split("text", "\n")))
    return remove_repeated_blocks(docs).select(
        F.col("row.doc_id"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.col("row._lines")).alias("n_lines"),
        "n_removed",
        F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_counts(table(spark, sf_dir, "documents"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_sharding,
        op3_best_fit_packing,
        op4_substring_dedup,
        op5_token_counts,
        op6_benchmark_decontamination,
        op7_minhash_near_dedup,
        op8_line_dedup,
        op9_html_extraction,
        op10_document_fingerprints,
        op11_cross_tokenizer_alignment,
        op12_conversation_prefix_trie,
        op13_simhash_near_dedup,
    )
}

ORACLES = {
    "op4_substring_dedup": r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i, list_slice(w, i, i + 12) AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)
), owners AS (
    SELECT win, min(doc_id) AS owner FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
    FROM windows JOIN owners USING (win) WHERE doc_id > owner
), gone_list AS (
    SELECT doc_id, list(pos) AS ats FROM gone GROUP BY doc_id
), numbered AS (
    SELECT doc_id, w, coalesce(ats, []) AS ats FROM words LEFT JOIN gone_list USING (doc_id)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(ats) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, k: NOT list_contains(ats, k)), ' '), '')) AS kept_sha256
FROM numbered
""",
    "op12_conversation_prefix_trie": r"""
WITH turns AS (
    SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
           row_number() OVER (
               PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
           ) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(t ORDER BY pos) AS l,
           xor(list_reduce(
               list_prepend(4294967295, flatten(list_transform(
                   string_split(CAST(conv_id AS VARCHAR), ''),
                   lambda ch: list_transform(range(8), lambda k: (ascii(ch) >> CAST(k AS INTEGER)) & 1)
               ))),
               lambda c, b: xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)
           ), 4294967295) % 4 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.l[1:c.h], []), c.l[c.h + 1:]) AS r
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
    SELECT conv_id, d, r[1:d] AS p, len(r) AS n FROM (SELECT conv_id, r, unnest(range(0, len(r) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d) AS ends,
           (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE
               len(list_filter(regexp_split_to_array(p[d].text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS saved
    FROM prefixes GROUP BY p, d
), kids AS (
    SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), weighed AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p, d)
), below AS (
    SELECT p[1:a] AS p, a AS d, CAST(sum(saved) AS BIGINT) AS saved_tokens,
           CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves
    FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM weighed) GROUP BY ALL
)
SELECT w.conv_id, w.d AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens,
       sha256(coalesce(w.ends, '')) AS ends_sha256
FROM weighed w JOIN below USING (p, d)
LEFT JOIN nodes up ON w.d > 0 AND up.d = w.d - 1 AND up.p = w.p[1:w.d - 1]
""",
}
