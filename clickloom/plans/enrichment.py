"""Events with their product, the merged dataset, and the cleaned catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.scalars import category_code, plain_base64
from clickloom.operators.rows import pick, rename, stack
from clickloom.operators.skew import HOT_ROWS, hot_keys, is_hot
from clickloom.schemas import CATALOGUE_COLUMNS, DATASET

# A catalogue is broadcast up to these sizes; both are measured.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to be sent to every executor: its rows and bytes are counted."""
    size = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        text = F.octet_length(F.col(f"`{field.name}`").cast("string"))
        size = size + F.coalesce(text, F.lit(0)) + 8
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return row["n"] <= max_rows and row["bytes"] <= max_bytes


def product_dimension(products: DataFrame) -> DataFrame:
    """``product_id, name, brand, price, category_code``: only what an event needs."""
    pruned = products.select("product_id", "name", "brand", "category", "type", "price")
    return pruned.withColumn("category_code", category_code()).drop("category", "type")


_KEY = "_product_key"


def _with_key(events: DataFrame, wanted: T.DataType) -> DataFrame:
    """Add the product key in the catalogue's type; null where the event's key does not fit it."""
    key = F.col("product_id")
    same = events.schema["product_id"].dataType == wanted
    return events.withColumn(_KEY, key if same else key.try_cast(wanted))


def enrich_events(
    events: DataFrame,
    products: DataFrame,
    broadcast: bool | None = None,
    hot_rows: int | None = HOT_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Events inner joined with their product, nine columns; the product's name wins.

    Keys of different types are compared in the catalogue's type. An event whose key does not fit it
    has no product, and is left out like any other event without one.

    ``broadcast=None`` leaves the strategy to Spark, whose adaptive skew join splits the events of a
    hot product. ``True`` sends the catalogue to every executor if its measured size allows. Beyond
    that size, or with ``False``, products of ``hot_rows`` events and more are found first; only
    their catalogue rows are broadcast, and only the other events are shuffled. ``hot_rows=None``
    skips that search. ``fits`` tells whether the catalogue may be broadcast, if that is known.
    """
    dimension = product_dimension(products)
    events = _with_key(events, dimension.schema["product_id"].dataType)
    if broadcast is None:
        return _with_product(events, dimension)
    if broadcast and (fits_broadcast(dimension) if fits is None else fits):
        return _with_product(events, F.broadcast(dimension))
    events = events.filter(F.col(_KEY).isNotNull())
    hashes = hot_keys(events, _KEY, hot_rows)
    if not hashes:
        return _with_product(events, dimension.hint("merge"))
    hot, hot_product = is_hot(_KEY, hashes), is_hot("product_id", hashes)
    hot_dimension = dimension.filter(hot_product)
    if fits_broadcast(hot_dimension):
        hot_dimension = F.broadcast(hot_dimension)
    cold = _with_product(events.filter(~hot), dimension.filter(~hot_product).hint("merge"))
    return cold.unionByName(_with_product(events.filter(hot), hot_dimension))


def _with_product(events: DataFrame, dimension: DataFrame) -> DataFrame:
    e, p = events.alias("e"), dimension.alias("p")
    return e.join(p, F.col(f"e.{_KEY}") == F.col("p.product_id"), "inner").select(
        "e.user_id",
        "e.product_id",
        "e.event_type",
        "e.event_time",
        "e.user_session",
        "p.name",
        "p.brand",
        "p.category_code",
        "p.price",
    )


def merge_catalogue(behaviors: DataFrame, products: DataFrame, legacy: DataFrame) -> DataFrame:
    """Older behaviour records joined with their products, plus the legacy dataset.

    Behaviours hold ``sessionId, behavior, event_time, user_id, product_name, product_id``;
    products are keyed by ``productID``; a behaviour whose key does not fit that type has no product.
    The legacy dataset may hold a ``category_id``, which is dropped. Both sides are brought to the
    dataset schema before the union.
    """
    b = _with_key(behaviors, products.schema["productID"].dataType).alias("b")
    p = products.withColumn("category_code", category_code()).drop("category", "type").alias("p")
    merged = b.join(p, F.col(f"b.{_KEY}") == F.col("p.productID"), "inner").select(
        "b.event_time",
        F.col("b.behavior").alias("event_type"),
        "p.brand",
        F.col("b.sessionId").alias("user_session"),
        "p.category_code",
        "p.price",
        "b.user_id",
        F.col("b.product_name").alias("name"),
        "b.product_id",
    )
    return stack(DATASET, merged, legacy.drop("category_id"))


def clean_catalogue(catalogue: DataFrame) -> DataFrame:
    """The nine catalogue columns, ``image[0]`` as ``MainImage``, the description in Base64."""
    cleaned = rename(pick(catalogue, CATALOGUE_COLUMNS), {"image[0]": "MainImage"})
    return cleaned.withColumn("new_description", plain_base64("new_description"))
