"""Vector points: from a dataset by an embedder, or from Word2Vec."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.blocked_word2vec import BlockedModel, BlockedSettings
from clickloom.functions.blocked_word2vec import fit as fit_blocked
from clickloom.functions.embedders import Embedder, HashingEmbedder
from clickloom.functions.scalars import combined_attributes, utc_label
from clickloom.functions.text import filtered_tokens, non_blank
from clickloom.functions.vectors import DIMENSION, float_array
from clickloom.operators.rows import distinct_rows, persisted
from clickloom.operators.saved import Scratch, remove, shuffles_freed
from clickloom.plans.enrichment import enrich_events
from clickloom.schemas import DATASET

# The columns of the training extract, in this order.
TRAINING_COLUMNS = [
    "user_id",
    "product_id",
    "name",
    "vector",
    "brand",
    "category_code",
    "price",
    "event_type",
    "event_time",
    "user_session",
]


def once_per_text(
    df: DataFrame, text: str, vector: str, embed: Callable[[DataFrame, str, str], DataFrame]
) -> DataFrame:
    """Add the vector of ``text``, embedding each distinct text once; null counts as empty.

    ``embed(frame, text, vector)`` adds the vectors to a frame of texts. Equal texts collapse before
    the shuffle. The vectors are joined back by a digest of the text: that shuffles both sides for the
    join, which is what the adaptive skew join needs to split the rows of a hot text.
    """
    column, digest = f"_{vector}_distinct", f"_{vector}_digest"
    filled = F.coalesce(F.col(text), F.lit(""))
    texts = df.select(filled.alias(column)).distinct()
    vectors = embed(texts, column, vector).select(F.sha2(column, 256).alias(digest), vector)
    return df.withColumn(digest, F.sha2(filled, 256)).join(vectors, digest).drop(digest)


def embed_names(
    df: DataFrame,
    embedder: Embedder | None = None,
    name: str = "name",
    vector: str = "vector",
    distinct: bool | None = None,
) -> DataFrame:
    """Add the vector of the name's tokens without stop words.

    ``distinct`` says whether each distinct name is embedded once, or each row; by default a costly
    embedder gets distinct names.
    """
    embedder = embedder or HashingEmbedder()

    def embed(rows: DataFrame, text: str, out: str) -> DataFrame:
        words = f"_{out}_words"
        return embedder.embed(filtered_tokens(rows, text, words), words, out).drop(words)

    if embedder.costly if distinct is None else distinct:
        return once_per_text(df, name, vector, embed)
    return embed(df, name, vector)


def name_points(dataset: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Points of the dataset load: the nine text columns and the name vector, no duplicates.

    A vector depends on its row alone, so duplicates are dropped before embedding: fewer rows to
    embed, and vectors stay out of the shuffle.
    """
    rows = distinct_rows(dataset.select(*DATASET.fieldNames()))
    return embed_names(rows, embedder).select(*DATASET.fieldNames(), "vector")


def retrain_points(training: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Points for the trainer from the training extract, with the event time as UTC label."""
    timed = training.withColumn("event_time", F.col("event_time").try_cast("timestamp"))
    labelled = embed_names(timed, embedder).withColumn("event_time", utc_label("event_time"))
    return labelled.select(*TRAINING_COLUMNS)


# Spark's Word2Vec holds the vocabulary on the driver, in arrays of at most 2^31 - 1 numbers.
MAX_NUMBERS = 2**31 - 1


@dataclass(frozen=True)
class Word2VecSettings:
    """As Spark's Word2Vec takes them.

    The number of training tasks changes the model, so it is ``num_partitions`` for any corpus.
    """

    min_count: int = 0
    num_partitions: int = 1
    vector_size: int = DIMENSION
    seed: int = 42
    max_iterations: int = 1


# The settings of the three Word2Vec jobs.
BEHAVIOR_SETTINGS = Word2VecSettings(min_count=0)
TRAINING_SETTINGS = Word2VecSettings(min_count=10, num_partitions=32)
# The attributes hold ids and times, so this vocabulary grows with the data and is kept in blocks.
COMBINED_SETTINGS = BlockedSettings(min_count=10, block_words=100_000, cell_pairs=1_000_000)


def word_tokens(df: DataFrame, text: str, words: str = "_words") -> DataFrame:
    """Tokens without stop words and blanks, as Word2Vec is fed."""
    return filtered_tokens(df, text, words).withColumn(words, non_blank(words))


def word_counts(tokens: DataFrame, words: str = "_words") -> DataFrame:
    """``word, n`` of all words."""
    return tokens.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(tokens: DataFrame, words: str = "_words", min_count: int = 0) -> DataFrame:
    """``word, n`` of the words that occur at least ``min_count`` times."""
    return word_counts(tokens, words).filter(F.col("n") >= min_count)


def fit_word2vec(tokens: DataFrame, settings: Word2VecSettings, words: str = "_words") -> Word2VecModel:
    """Word2Vec trained on every row.

    The words are counted first. A vocabulary that is empty or too large for the driver fails before
    the training, with advice; for such a corpus give the plans an embedder, which needs none.
    """
    frequent = F.col("n") >= settings.min_count
    size = word_counts(tokens, words).agg(F.count_if(frequent).alias("vocabulary")).first()
    limit = MAX_NUMBERS // settings.vector_size
    if not size["vocabulary"]:
        raise ValueError(f"no word occurs {settings.min_count} times; lower min_count")
    if size["vocabulary"] > limit:
        raise ValueError(f"more than {limit} words occur {settings.min_count} times; raise min_count")
    return Word2Vec(
        vectorSize=settings.vector_size,
        minCount=settings.min_count,
        numPartitions=settings.num_partitions,
        maxIter=settings.max_iterations,
        seed=settings.seed,
        inputCol=words,
        outputCol="_word2vec",
    ).fit(tokens)


def word2vec_vectors(
    df: DataFrame,
    text: str,
    settings: Word2VecSettings | BlockedSettings,
    model: Word2VecModel | BlockedModel | None = None,
    vector: str = "vector",
    distinct: bool = True,
    columns: list[str] | None = None,
) -> DataFrame:
    """Add the mean word vector of a text; a text without words has the zero vector.

    The model is fitted on ``df`` unless one is given. Fitting reads the tokens three times, so that
    column alone is kept meanwhile. With blocked settings the model is a table, and each distinct text
    gets its vector once, or with ``distinct=False`` each row. Of such rows only ``columns`` are kept, if they are given.
    """
    if isinstance(settings, BlockedSettings) and not distinct:
        # The result reads these rows, so they stay.
        own = Scratch(df, "word-tokens")
        try:
            with shuffles_freed(df.sparkSession):
                tokens = own.saved(word_tokens(df, text).select(*(columns or df.columns), "_words"), codec="zstd")
            fitted = model or fit_blocked(tokens.select("_words"), settings, "_words")
            return fitted.transform(tokens, "_words", vector).drop("_words")
        except BaseException:
            remove(own.folder)
            raise
    if isinstance(settings, BlockedSettings):
        fitted = model or fit_blocked(word_tokens(df, text).select("_words"), settings, "_words")

        def embed(rows: DataFrame, column: str, out: str) -> DataFrame:
            return fitted.transform(word_tokens(rows, column), "_words", out).drop("_words")

        return once_per_text(df, text, vector, embed)
    tokens = word_tokens(df, text)
    if model is None:
        with persisted(tokens.select("_words")) as kept:
            model = fit_word2vec(kept, settings)
    return model.transform(tokens).withColumn(vector, float_array("_word2vec")).drop("_words", "_word2vec")


def _text_vectors(
    df: DataFrame,
    text: str,
    settings: Word2VecSettings | BlockedSettings,
    embedder: Embedder | None,
    distinct: bool = True,
    columns: list[str] | None = None,
) -> DataFrame:
    """By Word2Vec, on the driver or in blocks, or by an embedder, which has no vocabulary."""
    if embedder is None:
        return word2vec_vectors(df, text, settings, distinct=distinct, columns=columns)
    return embed_names(df, embedder, text)


def behavior_vectors(
    events: DataFrame, settings: Word2VecSettings | BlockedSettings = BEHAVIOR_SETTINGS, embedder: Embedder | None = None
) -> DataFrame:
    """``user_id, product_id, name, vector`` of every event."""
    rows = events.select("user_id", "product_id", "name")
    return _text_vectors(rows, "name", settings, embedder)


def training_vectors(
    events: DataFrame,
    products: DataFrame,
    settings: Word2VecSettings | BlockedSettings = TRAINING_SETTINGS,
    embedder: Embedder | None = None,
) -> DataFrame:
    """The training extract: enriched events with name vector and UTC time label."""
    vectors = _text_vectors(enrich_events(events, products), "name", settings, embedder)
    return vectors.withColumn("event_time", utc_label("event_time")).select(*TRAINING_COLUMNS)


def combined_vectors(
    dataset: DataFrame, settings: Word2VecSettings | BlockedSettings = COMBINED_SETTINGS, embedder: Embedder | None = None
) -> DataFrame:
    """``product_id, vector`` of every record, the vector made from all nine attributes.

    The attributes hold ids and times, so the vocabulary grows with the data, and hardly two records are equal:
    each gets its vector by itself. Spark's Word2Vec keeps such a model on the driver.
    """
    texts = dataset.select("product_id", combined_attributes().alias("_text"))
    return _text_vectors(texts, "_text", settings, embedder, False, ["product_id"]).select("product_id", "vector")
