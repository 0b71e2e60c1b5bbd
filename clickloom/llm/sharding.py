"""Shards that all match the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from clickloom.llm import stages

ROWS_PER_BUCKET = 2_000


def shuffle_key(seed: int, column: str) -> Column:
    """A seeded order that any SQL engine can repeat: the MD5 of seed and value."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(column).cast("string"), F.lit(""))))


def orderable(value: Column, kind: DataType) -> Column:
    """The value in a form that Spark can order: maps as their sorted entries, variants as JSON."""
    if isinstance(kind, MapType):
        pair = lambda entry: F.struct(orderable(entry["key"], kind.keyType), orderable(entry["value"], kind.valueType))
        return F.sort_array(F.transform(F.map_entries(value), pair))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda element: orderable(element, kind.elementType))
    if isinstance(kind, StructType):
        fields = [orderable(value.getField(field.name), field.dataType).alias(f"f{n}") for n, field in enumerate(kind.fields)]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.to_json(value) if isinstance(kind, VariantType) else value


def _has_maps(kind: DataType) -> bool:
    return any(name in kind.simpleString() for name in ("map<", "variant"))


def _numbered(df: DataFrame, bucket: Column, order: list[Column], within: list[str], name: str) -> DataFrame:
    """``df`` with the place of each row, from 0, among the rows with equal ``within``, in the given order.

    ``bucket`` ascends with that order. A row is numbered within its bucket, and the sizes of the buckets
    before it are added, so no task sorts more than a bucket of a source.
    """
    inner = df.withColumn("bucket", bucket)
    sizes = inner.groupBy(*within, "bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    before = Window.partitionBy(*within) if within else Window.partitionBy()
    running = F.sum("in_bucket").over(before.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("before", F.coalesce(running, F.lit(0)))
    if within:
        sizes = sizes.withColumn("in_all", F.sum("in_bucket").over(before))
    own = Window.partitionBy(*within, "bucket").orderBy(*order)
    ranked = inner.withColumn("place", F.row_number().over(own))
    same = [F.col(f"r.{column}").eqNullSafe(F.col(f"s.{column}")) for column in [*within, "bucket"]]
    joined = ranked.alias("r").join(sizes.alias("s"), same)
    extra = [F.col("s.in_all")] if within else []
    place = (F.col("s.before") + F.col("r.place") - 1).alias(name)
    return joined.select(*[F.col(f"r.{column}") for column in df.columns], place, *extra)


def interleave(df: DataFrame, shards: int, key: str = "doc_id", source: str = "source", seed: int = 0) -> DataFrame:
    """``df`` with the columns ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Within each source rows are ranked in a seeded order. Row ``r`` of ``n`` gets the fractional rank
    ``(r + 0.5) / n``; all rows are sorted by it and cut into shards whose sizes differ by one row at most, so
    every stretch of the order, and every shard, has the sources in their proportions.

    Nulls: a null source is a source of its own, a null key is ordered like an empty text. Equal fractional
    ranks are ordered by source, rows of one source and key by their other columns (maps by their sorted entries);
    rows alike in all columns are interchangeable. A ``shard`` or ``slot`` column of ``df`` is replaced; other names cannot clash. An
    empty table gives an empty one.
    """
    total = df.count()
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    keyed = df.select(stages.wrapped(df), F.col(f"`{source}`").alias("source"), shuffle_key(seed, key).alias("shuffled"))
    # The leading 28 bits of the digest, cut into equal ranges that ascend with it.
    number = F.conv(F.substring("shuffled", 1, 7), 16, 10).cast("long")
    bucket = F.floor(number * buckets / F.lit(1 << 28))
    kind = keyed.schema["row"].dataType
    row = orderable(F.col("row"), kind) if _has_maps(kind) else F.col("row")
    ranked = _numbered(keyed, bucket, [F.col("shuffled"), row], ["source"], "rank")
    fraction = ((F.col("rank") + 0.5) / F.col("in_all")).alias("fraction")
    ranked, _ = stages.written(ranked.select("row", "source", fraction), "ranked")
    order = [F.col("fraction"), F.col("source"), row]
    placed = _numbered(ranked, F.floor(F.col("fraction") * buckets), order, [], "position")
    size, larger = divmod(total, shards)
    # The first ``larger`` shards have one row more.
    edge = larger * (size + 1)
    position = F.col("position")
    shard = F.when(position < edge, F.floor(position / (size + 1))).otherwise(
        larger + F.floor((position - edge) / max(size, 1))
    )
    start = F.col("shard") * size + F.least(F.col("shard"), F.lit(larger))
    kept = [F.col(f"row.`{name}`") for name in df.columns if name not in ("shard", "slot")]
    return placed.withColumn("shard", shard.cast("int")).select(
        *kept, "shard", (position - start).cast("long").alias("slot")
    )


def write_shards(df: DataFrame, folder: str) -> None:
    """Write interleaved rows, one folder ``shard=N`` with one file for each shard, in slot order."""
    rows = df.repartition("shard").sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").mode("overwrite").parquet(folder)
