"""From source tables to a vector collection: the batch loads, each in one call.

Every load returns the number of points it wrote. A load with ``recreate`` replaces the collection,
the others add to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from clickloom.functions.embedders import Embedder
from clickloom.functions.scalars import point_id
from clickloom.functions.vectors import DIMENSION
from clickloom.operators.aggregates import EVENT_TYPES
from clickloom.plans import vectors
from clickloom.plans.retrain import as_topic_value, retrain_event
from clickloom.plans.scoring import interaction_scores
from clickloom.schemas import DATASET
from clickloom.sources.files import read_csv_checked, read_csv_text, split_corrupt
from clickloom.sources.tables import unless_empty
from clickloom.sources.vector_sink import write_points


@dataclass(frozen=True)
class Collection:
    """A vector collection: a connector's format and options.

    ``with_ids`` adds a ``point_id`` made from the payload, for stores that do not give out ids of
    their own. Points with the same payload then become one.
    """

    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    dimension: int = DIMENSION
    with_ids: bool = False

    def load(self, points: DataFrame, recreate: bool) -> int:
        mode = "overwrite" if recreate else "append"
        if self.with_ids:
            payload = [name for name in points.columns if name != "vector"]
            points = points.withColumn("point_id", point_id(*payload))
        return write_points(points, self.fmt, self.options, mode, dimension=self.dimension)


def read_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The dataset file's good rows, and its quarantined rows."""
    return split_corrupt(read_csv_checked(spark, path, DATASET))


def load_names(dataset: DataFrame, target: Collection, embedder: Embedder | None = None) -> int:
    """Recreate the collection from the dataset: one point per distinct record, by its name."""
    return target.load(vectors.name_points(dataset, embedder), recreate=True)


def load_combined(
    dataset: DataFrame,
    target: Collection,
    settings: vectors.Word2VecSettings | vectors.BlockedSettings = vectors.COMBINED_SETTINGS,
    embedder: Embedder | None = None,
) -> int:
    """Recreate the collection with a vector of all attributes of each record."""
    return target.load(vectors.combined_vectors(dataset, settings, embedder), recreate=True)


def load_training(
    events: DataFrame,
    products: DataFrame,
    target: Collection,
    settings: vectors.Word2VecSettings | vectors.BlockedSettings = vectors.TRAINING_SETTINGS,
    embedder: Embedder | None = None,
) -> int:
    """Recreate the collection with the training extract."""
    return target.load(vectors.training_vectors(events, products, settings, embedder), recreate=True)


def load_retrain(
    spark: SparkSession, path: str, target: Collection, embedder: Embedder | None = None
) -> DataFrame:
    """Add the points of the training extract, and return the message for the trainer's topic."""
    n_points = target.load(vectors.retrain_points(read_csv_text(spark, path), embedder), recreate=False)
    return as_topic_value(retrain_event(spark, n_points))


def load_behaviors(
    events: DataFrame,
    target: Collection,
    settings: vectors.Word2VecSettings | vectors.BlockedSettings = vectors.BEHAVIOR_SETTINGS,
    event_types: Mapping[str, str] = EVENT_TYPES,
    tie_breakers: Sequence[str] = (),
    embedder: Embedder | None = None,
) -> DataFrame | None:
    """Recreate the collection with a vector per event, and return the interaction scores.

    Without events nothing is written and there are no scores.
    """
    if unless_empty(events, "the behaviours") is None:
        return None
    target.load(vectors.behavior_vectors(events, settings, embedder), recreate=True)
    return interaction_scores(events, event_types=event_types, tie_breakers=tie_breakers)
