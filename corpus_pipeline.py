"""A corpus pipeline: toxic documents go, repeated passages of lines go, one document of each group of near copies
stays, sources are mixed to their weights, and the rest is packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import toxicity
from dayledger.llm.jaccard import keep_one
from dayledger.llm.lines import dedup_lines
from dayledger.llm.mixing import mix
from dayledger.llm.packing import pack
from dayledger.llm.queries import tokenizer
from dayledger.session import materialize, prepare, table

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC_FROM; the classifier learns from the labels of the folder."""
    prepare(spark)
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), name="_toxicity")
    return scored.filter(F.col("_toxicity") < TOXIC_FROM).drop("_toxicity")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of three-line passages cut out of the texts; n_chars follows the text."""
    prepare(spark)
    cut = dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is connected by a similarity of 0.8 or more on five-word shingles."""
    prepare(spark)
    return keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at the square root of their sizes, as many documents in all as before; some go, some repeat."""
    prepare(spark)
    return mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    prepare(spark)
    return pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; what a stage returns is written and read again for the next one."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
