"""The training-data pipeline: stages over documents, each written before the next one reads it.

A stage takes (spark, docs, sf_dir). All but the last return the columns of documents, less
the rows they drop; the last one encodes what is left. A row is judged by its own id and text: rows with a
null id, or with the id of another text, go only for what they themselves are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.llm import bpe, decontaminate, exact, jaccard, quality
from lineweft.llm.tables import table
from lineweft.session import cut_lineage, drop_tables, written_tables


def _row() -> Column:
    """Text that is equal for rows with the same id, null or not, and the same text."""
    id = F.col("doc_id").cast("string")
    return F.concat_ws("/", id.isNull().cast("string"), F.coalesce(id, F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are none of ``rows``."""
    return docs.withColumn("_row", _row()).join(rows, "_row", "left_anti").select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more."""
    score = quality.quality_scorer(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return docs.where(score(F.col("text")) >= 0.3)


def one_per_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.keep_one(docs)


def one_per_component(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similarity, the one with the smallest id; none of the others is left.

    Ids come before null ids, and rows with one id go by their texts. Near copies share 0.8 or more of their five-word shingles; the contract of op10 (three words, 0.9) binds that query alone.
    """
    keys = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", _row().alias("_row"))
    keyed = docs.select(keys.alias("key"), "text")
    found = jaccard.similar_documents(keyed, id="key", shingle_words=5, percent=80)
    return _without(docs, found.where("component_id < doc_id").select("doc_id._row").distinct())


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth is hit by benchmark windows."""
    keyed = docs.select(_row().alias("doc_id"), "text")
    judged = decontaminate.contaminated_words(keyed, table(spark, sf_dir, "benchmark"))
    return _without(docs, judged.where("n_hit > 0 AND 20 * n_hit >= n_words").select(F.col("doc_id").alias("_row")).distinct())


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    vocabulary = bpe.RankVocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return bpe.token_digests(bpe.encode(docs, vocabulary), vocabulary)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", one_per_text),
    ("n-gram Jaccard join", one_per_component),
    ("benchmark decontamination", uncontaminated),
    ("byte-level BPE", encoded),
]

#: The classifier and the similarity join cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has read and written on its way goes when its own rows are written."""
    docs, begun = table(spark, sf_dir, "documents"), written_tables()
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = cut_lineage(docs)
            drop_tables(spark, begun, but_last=1)
    return docs
