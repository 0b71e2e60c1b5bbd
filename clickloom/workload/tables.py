"""The engine's logical tables, made from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A click plays the part of putting a product into the cart.
CLICK_TYPES = {"views": "view", "carts": "click", "purchases": "purchase"}

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros_text(time: str) -> Column:
    """A time as text down to the microsecond."""
    return F.date_format(F.col(time), MICROS)


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events; a session is one user's day."""
    time = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws("-", F.col("user_id"), F.date_format(time, "yyyy-MM-dd")).alias("user_session"),
        "user_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("product_id"),
        "event_type",
        time.alias("event_time"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the product catalogue."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("type"),
        F.col("p_retailprice").alias("price"),
    )


def named_behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the name of their product."""
    names = products(spark, sf_dir).select("product_id", "name")
    return behaviors(spark, sf_dir).join(names, "product_id")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic records: JSON text in ``value``, a position, some tombstones and bad records.

    Each tenth record comes twice, each hundredth has no value, each hundredth after that is cut.
    """
    events = named_behaviors(spark, sf_dir)
    fields = F.struct(
        "user_session",
        "user_id",
        F.col("product_id").cast("string").alias("product_id"),
        "name",
        "event_type",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
    )
    json = F.to_json(fields)
    kind = F.col("event_id") % 100
    copies = F.when(F.col("event_id") % 10 == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.select(
        F.when(kind == 0, None).when(kind == 1, F.substring(json, 1, 20)).otherwise(json).alias("value"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset file: enriched events, every column as text."""
    from clickloom.plans.enrichment import enrich_events

    enriched = enrich_events(behaviors(spark, sf_dir), products(spark, sf_dir))
    return enriched.select(
        micros_text("event_time").alias("event_time"),
        "event_type",
        F.col("product_id").cast("string"),
        "category_code",
        "brand",
        F.col("price").cast("string"),
        F.col("user_id").cast("string"),
        "user_session",
        "name",
    )
