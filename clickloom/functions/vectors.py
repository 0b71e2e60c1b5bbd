"""Vectors as ``array<float>``: length, contract, conversion."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of every vector collection.
DIMENSION = 128
METRIC = "Cosine"


def float_array(ml_vector: str) -> Column:
    """An ML vector as ``array<float>``, converted inside the JVM."""
    return vector_to_array(F.col(ml_vector), "float32")


def truncate(vector: str, dimension: int = DIMENSION) -> Column:
    """The first ``dimension`` elements as ``array<float>``."""
    return F.slice(F.col(vector), 1, dimension).cast("array<float>")


def violation(vector: str, dimension: int = DIMENSION) -> Column:
    """Why a vector may not enter a collection; null where it may."""
    value = F.col(vector)
    infinite = F.lit(float("inf"))
    usable = F.forall(
        value,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != infinite),
    )
    return (
        F.when(value.isNull(), "missing")
        .when(F.size(value) != dimension, "dimension")
        .when(~usable, "element")
    )


def split_by_contract(
    df: DataFrame, vector: str = "vector", dimension: int = DIMENSION
) -> tuple[DataFrame, DataFrame]:
    """Rows with a valid vector, and the others with their ``violation``."""
    checked = df.withColumn("violation", violation(vector, dimension))
    good = checked.filter(F.col("violation").isNull()).drop("violation")
    return good, checked.filter(F.col("violation").isNotNull())


def enforce_contract(df: DataFrame, vector: str = "vector", dimension: int = DIMENSION) -> DataFrame:
    """The frame itself; the job fails at the first vector that breaks the contract."""
    reason = violation(vector, dimension)
    message = F.concat(F.lit(f"bad vector (want {dimension} finite floats): "), reason)
    checked = F.when(reason.isNull(), F.col(vector)).otherwise(
        F.raise_error(message).cast(df.schema[vector].dataType)
    )
    return df.withColumn(vector, checked)


def unit_length(vector: str) -> Column:
    """The vector scaled to length 1, as cosine stores keep it; a zero vector stays."""
    value = F.col(vector)
    norm = F.sqrt(F.aggregate(value, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(value, lambda x: F.when(norm > 0, x / norm).otherwise(x).cast("float"))
