"""A corpus from documents to an ordered mixture, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.llm import op1_ngram_jaccard_join as near
from clipsieve.llm import op4_source_mixing as mixing
from clipsieve.llm import op5_suffix_array_dedup as passages
from clipsieve.llm import op7_toxicity as toxicity
from clipsieve.llm import op9_benchmark_decontamination as benchmark
from clipsieve.llm.common import durable, table

#: Training, procedural scheduling and suffix sorting have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more as toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="__toxic").where(F.col("__toxic") < 0.5).drop("__toxic")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document of least id stays."""
    return near.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier in the corpus are cut out; a document of which nothing is left goes."""
    return passages.cut_texts(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return benchmark.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their place (slot, seq) in the mixture."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark),
    ("source_mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
