"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.llm import (fingerprints, jaccard_join, language_id, line_quality, minhash_join, mixing,
                            packing, page_templates, periodic_runs, secrets, token_alignment,
                            token_counts)
from fairstream.llm.common import held_out, table
from fairstream.llm.metric_tree import top_inner_products

#: Files of the vocabulary that packing, secret scans and token counts use.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: The other tokenizer of the alignment.
PIECES = "piece_bpe_32k.model"


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER),
                        public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = language_id.train(docs, ~held_out(F.col("doc_id")))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return language_id.identify(rows, network, ["doc_id", "held_out"])


def op3_page_templates(spark: SparkSession, folder: str) -> DataFrame:
    return page_templates.extract(table(spark, folder, "pages"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")) \
        .select("row.doc_id", "size", "source_size", "target", "taken", "copies")


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op7_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, folder, "documents"), public_tokenizers.path(RANKS),
                                public_tokenizers.PATTERN, ["doc_id"]).drop("redacted")


def op8_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = line_quality.train(docs, table(spark, folder, "labels"))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return line_quality.score(rows, field, ["doc_id", "held_out"])


def op9_metric_tree(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(table(spark, folder, "embeddings"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.read_pieces(public_tokenizers.path(RANKS))
    return token_counts.token_counts(table(spark, folder, "documents"), pieces)


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.aligned(
        table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER),
        public_tokenizers.path(PIECES), digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, folder, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where, with h the crc32 of the decimal doc_id, n words and h % 10 = 0, the
    words from a = g % n on repeat the first 1 + (n - a) div (3 + g % 8) of them; g is h div 10."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"), h.alias("h")).select(
        "doc_id", "text", F.expr("h div 10").alias("g"),
        F.when(F.col("h") % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(
            F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " "))
                       .otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_periods(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language_id": op2_language_id,
    "op3_page_templates": op3_page_templates,
    "op4_mixing": op4_mixing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_fingerprints": op6_fingerprints,
    "op7_secret_scans": op7_secret_scans,
    "op8_line_quality": op8_line_quality,
    "op9_metric_tree": op9_metric_tree,
    "op10_token_counts": op10_token_counts,
    "op11_token_alignment": op11_token_alignment,
    "op12_minhash_join": op12_minhash_join,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op5_jaccard_join": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, list_filter(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS words
            FROM documents
        ), listed AS (
            SELECT doc_id, CASE
                WHEN len(words) = 0 THEN []
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 3),
                         lambda i: array_to_string(words[i:i + 4], ' '))) END AS s
            FROM docs
        ), shingles AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM listed
        ), pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM shingles a JOIN shingles b USING (shingle)
            WHERE a.doc_id < b.doc_id
              AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), both_ways AS (
            SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM docs
            UNION
            SELECT r.doc_id, e.y FROM reached r JOIN both_ways e ON r.other = e.x
        )
        SELECT l.doc_id, CAST(len(l.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
        FROM listed l JOIN reached r USING (doc_id)
        GROUP BY l.doc_id, l.s""",
    "op12_minhash_join": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, list_filter(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS words
            FROM documents
        ), listed AS (
            SELECT doc_id, CASE
                WHEN len(words) = 0 THEN []
                WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 1),
                         lambda i: array_to_string(words[i:i + 2], ' '))) END AS s
            FROM docs
        ), shingles AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM listed
        ), pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM shingles a JOIN shingles b USING (shingle)
            WHERE a.doc_id < b.doc_id
              AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), both_ways AS (
            SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM docs
            UNION
            SELECT r.doc_id, e.y FROM reached r JOIN both_ways e ON r.other = e.x
        )
        SELECT l.doc_id, CAST(len(l.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id,
               l.doc_id = min(r.other) AS kept
        FROM listed l JOIN reached r USING (doc_id)
        GROUP BY l.doc_id, l.s""",
    "op9_metric_tree": """
        WITH valid AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE))
                                                                    AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM valid q JOIN valid c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                           AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
