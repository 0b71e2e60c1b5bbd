"""Profiles that can be merged: states of parts, such as days, from which the profile of any set of parts follows.

A state never needs its rows again. Distinct whole numbers are words of 64 neighbouring values, so they are
exact however states overlap; quantiles are KLL sketches. Words and sketches are rows of their own: there are many
words, which hash aggregation holds in little memory, and few sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import quoted

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BROKEN = (T.FloatType, T.DoubleType)
_STATE = ("part", "column_name", "bucket", "n_rows", "n_nulls", "low", "high", "bits", "sketch")


def states(df: DataFrame, part: Column, columns: Sequence[str]) -> DataFrame:
    """The state of each part and column: ``part, column_name, bucket, n_rows, n_nulls, low, high, bits, sketch``.

    One row without ``bucket`` and ``bits`` holds the counts, ``low`` and ``high`` as doubles, and the sketch; the others
    tell by 64 bits which of the whole numbers of a bucket there are. Columns must be numbers. Reads ``df`` once for each
    kind; rows of a part are combined on the map side.
    """
    for name in columns:
        if not isinstance(df.schema[name].dataType, (*_WHOLE, *_BROKEN)):
            raise TypeError(f"{name} is no number")
    whole = [name for name in columns if isinstance(df.schema[name].dataType, _WHOLE)]
    measures = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f"x{n}").isNull()).alias("n_nulls"),
            F.min(f"x{n}").alias("low"),
            F.max(f"x{n}").alias("high"),
            F.kll_sketch_agg_double(f"x{n}").alias("sketch"),
        )
        for n, name in enumerate(columns)
    ]
    values = df.select(part.alias("part"), *[quoted(name).cast("double").alias(f"x{n}") for n, name in enumerate(columns)])
    counted = values.groupBy("part").agg(F.array(*measures).alias("all")).select("part", F.inline("all"))
    if not whole:
        return _both(counted, None)
    cells = F.array(*[F.struct(F.lit(name).alias("column_name"), quoted(name).cast("long").alias("number")) for name in whole])
    numbers = df.select(part.alias("part"), F.inline(cells)).filter("number IS NOT NULL")
    bit = F.expr("shiftleft(1L, int(number & 63L))")
    return _both(counted, _words(numbers.select("part", "column_name", F.shiftright("number", 6).alias("bucket"), bit.alias("bits"))))


def _words(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part", "column_name", "bucket").agg(F.bit_or("bits").alias("bits"))


def _both(counted: DataFrame, words: DataFrame | None) -> DataFrame:
    """The two kinds of rows in one table."""
    none = F.lit(None).cast("long")
    counted = counted.withColumns({"bucket": none, "bits": none}).select(*_STATE)
    return counted if words is None else counted.unionByName(words, allowMissingColumns=True)


def merged_states(parts: DataFrame, into: Column) -> DataFrame:
    """States of larger parts, ``into`` being an expression over ``part``, such as the month of a day."""
    own = parts.withColumn("part", into)
    counted = own.filter("bucket IS NULL").groupBy("part", "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    return _both(counted, _words(own.filter("bucket IS NOT NULL")))


def profile_of(parts: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column_name, n_rows, n_nulls, low, high, n_distinct, quantiles`` of all parts together.

    ``n_distinct`` is exact, and null for columns that are no whole numbers.
    """
    whole = merged_states(parts, F.lit(0))
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    distinct = whole.filter("bucket IS NOT NULL").groupBy("column_name").agg(F.sum(F.bit_count("bits")).alias("n_distinct"))
    return whole.filter("bucket IS NULL").join(distinct, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", "low", "high", "n_distinct", F.kll_sketch_get_quantile_double("sketch", wanted).alias("quantiles")
    )
