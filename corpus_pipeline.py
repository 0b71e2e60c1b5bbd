"""A training corpus from raw documents: clean, without near copies and test items, packed.

Each stage takes the session, the documents that the stage before it kept, and the folder of the given
tables, and returns a DataFrame; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import contamination, jaccard, packing, stages, substrings, toxicity

TOKENIZER, END_ID, SEQUENCE_SIZE = "byte_bpe_50k.json", 0, 2048

# Text scores and token ids are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _small_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of a few megabytes, also in the jobs that read a stage's result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is more likely not toxic. Documents without text stay.

    Repeated rows have one score and stay or go together; an empty table gives an empty one. All columns but the text are
    carried in a struct, so their names may clash with anything.
    """
    _small_batches(spark)
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"]).alias("others")
    scored = toxicity.score(docs.select("text", others), model, keep=["text", "others"])
    clean = scored.filter((F.col("score") < 0.5) | (F.coalesce(F.length("text"), F.lit(0)) == 0))
    return clean.select(*[F.col("text") if name == "text" else F.col(f"others.`{name}`") for name in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard.one_of_each_group(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word windows that an earlier one has.

    The words that stay are joined by single blanks and ``n_chars`` follows the text; a document that loses
    nothing keeps its text unchanged, and one that loses all of it goes.
    """
    _small_batches(spark)
    columns = docs.columns
    kept = substrings.remove_repeated(docs, keep=[name for name in columns if name != "text"])
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("extra.n_chars"))
    changed = {"text": text, "n_chars": n_chars}
    rows = kept.filter((F.col("n_words") == 0) | (F.col("n_removed") < F.col("n_words")))
    return rows.select(*[changed.get(name, F.col(f"extra.`{name}`")).alias(name) for name in columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return contamination.without_items(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the training sequences."""
    _small_batches(spark)
    packed = packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID, SEQUENCE_SIZE)
    return packed.select(F.col("key").alias("doc_id"), "piece", "start", "length", "sequence_id", "offset", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The result of each is a table that the next one reads."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stages.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
