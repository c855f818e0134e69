"""Pipeline over `documents`: each stage applies one operator to all that the stage before it kept.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet in the shared folder and read
again as the next one's docs, so that a lost executor never costs more than the running stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstream.llm import decontaminate, jaccard, language, lines, pieces
from millstream.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if its likeliest language has less than this share of its windows' probability.
LEAST_LANGUAGE = 0.3


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter go, and those of which no language explains a fair part.

    The network learns from a bounded sample of the documents that name their language.
    """
    net = language.fit(docs, F.lit(True))
    found = language.predict(docs.select(*COLUMNS), net, lang_pred="_lang", score="_score")
    told = F.col("_score") >= LEAST_LANGUAGE if net.languages else F.col("text").rlike(r"\p{L}")
    return found.filter(told).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats, however short; a document of which nothing is left goes."""
    made = lines.dedup(docs.select(*COLUMNS), least_words=1)
    left = made.filter((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    size = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 0.8 of their 5-word shingles."""
    return jaccard.keep_one(docs.select(*COLUMNS), 5, 80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor a passage of one, nor either with its values exchanged."""
    found = decontaminate.leaks(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), run=decontaminate.RUN)
    return decontaminate.clean(docs.select(*COLUMNS), stored(found, "pipeline-leaks"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with `ids`, the ids of the whole text, and `decoded`, the text that they stand for."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.decode(pieces.encode(docs.select(*COLUMNS), model), model).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", keep_languages),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode_pieces),
]

#: SQL can't express the language network, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
