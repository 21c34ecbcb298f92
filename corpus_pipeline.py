"""The corpus pipeline: toxic and low-quality documents go, near copies go, sources are mixed, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as a table in shared storage and reads
it again as the next stage's documents. Near-duplicates are linked on five-word shingles at a similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm import minhash, mixing, packing, repetition, toxicity
from lapwise.llm.shipping import ship
from lapwise.operators.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the FTRL model does not predict toxic."""
    ship(spark)
    return toxicity.keep(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on length and repetition."""
    ship(spark)
    return repetition.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id (null last).

    Every row is judged by its own text, whatever its doc_id; rows without words are linked with nothing and stay.
    """
    ship(spark)
    numbered = stage(docs.select(F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")))
    found = minhash.near_duplicates(numbered.select("_row", F.col("_doc.text").alias("text")), key="_row")
    ids = numbered.select("_row", F.col("_doc.doc_id").alias("_id"))
    place = F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    first = found.join(ids.hint("merge"), "_row").groupBy("component_id").agg(F.min(place)["row"].alias("_row"))
    # As many rows as stay, so never broadcast.
    return numbered.join(first.select("_row").hint("merge"), "_row", "left_semi").select("_doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares of sources, languages and topics follow the raked weights."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_repetitive),
    ("near-duplicates", drop_near_copies),
    ("source mixture", mix_sources),
    ("packing", pack_sequences),
]

# Models, sketches and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
