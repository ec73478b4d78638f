"""From raw documents to packed sequences: five stages, each a table for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairstream.llm import jaccard_join, language_id, mixing, packing, secrets
from fairstream.llm.common import held_out, stored
from fairstream.llm.queries import RANKS, TOKENIZER

#: A document stays if its language is known with this probability.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of a recognised language, or with letters if there is none to learn from."""
    network = language_id.train(docs, ~held_out(F.col("doc_id")))
    if network is None:
        return docs.where(F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
    found = language_id.identify(docs, network, docs.columns)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN)
                       & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, once.

    Documents without an id stay unless all of them are near duplicates of one with an id.
    """
    found = jaccard_join.near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .select(F.col("doc_id").alias("kept")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("key"),
                       F.xxhash64("text").alias("of_text"))
    return rows.join(kept, rows["key"].eqNullSafe(kept["kept"]), "left_semi") \
        .dropDuplicates(["key", "of_text"]).select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and lengths counted anew."""
    scanned = secrets.scan_secrets(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN,
                                   [c for c in docs.columns if c != "text"])
    replaced = {"text": F.col("redacted")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(F.col("spans") == "", F.col("n_chars")).otherwise(
            F.length("redacted").cast(docs.schema["n_chars"].dataType))
    return scanned.select(*(replaced.get(c, F.col(c)).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS),
                        public_tokenizers.PATTERN)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)


#: Language, secrets and token ids are nothing that SQL can express.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
