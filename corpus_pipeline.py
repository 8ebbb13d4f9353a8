"""From raw documents to training shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``:

1. toxicity: documents that score ``toxicity.THRESHOLD`` or more go;
2. near_dedup: of the documents linked by SimHash (4-word shingles, 4 bits) the one with the least doc_id stays;
3. decontaminate: documents that hold a benchmark item go;
4. mix: documents come as often as the mix to target weights takes them, not taken ones go;
5. shard: every row gets one of 16 shards of near-equal bytes and a slot in it.

All stages but the last return the columns of documents, further ones of the
input included. Null texts pass stages 1 and 3, are near duplicates of other
wordless texts in stage 2, and hold no words to mix in stage 4. An empty table
goes through all stages and stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import curriculum, decontam, kdshards, simhash, toxicity
from shelfwatch.llm.common import read
from shelfwatch.session import scratch_path

SHARDS = 16


def restored(df: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' own columns again, which operators return as ``keep_<name>``."""
    return df.select(*[F.col(f"keep_{c}").alias(c) if f"keep_{c}" in df.columns else F.col(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, *toxicity.train(docs, read(spark, sf_dir, "labels")), keep=docs.columns)
    return restored(scored.where(scored["score"] < toxicity.THRESHOLD), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = curriculum.curriculum(docs, keep=docs.columns)
    return restored(curriculum.training_order(mixed), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = kdshards.kd_shards(docs, shards=SHARDS, keep=docs.columns)
    own = [c for c in docs.columns if c not in ("shard", "slot")]  # new shards take the place of old ones
    return placed.select(*[F.col(f"keep_{c}").alias(c) for c in own], "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: trained scores, XXH64 fingerprints and edit distances aren't SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written under the checkpoint folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
