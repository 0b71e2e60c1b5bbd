"""One query per operator, over whole test tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas, session
from clickloom.functions import scalars, text, vectors
from clickloom.functions.embedders import HashingEmbedder, ModelEmbedder
from clickloom.operators import aggregates, profiles, rows, sessions
from clickloom.operators.saved import saved
from clickloom.plans import buyers, distinct_load, enrichment, loads, retrain, scoring
from clickloom.plans import vectors as vector_plans
from clickloom.sources import collection, drift, files, record_log, tables, topics, vector_sink
from clickloom.streaming import ingest, point_table, sinks, upsert
from clickloom.workload.tables import (
    CLICK_TYPES,
    behaviors,
    dataset,
    messages,
    micros_text,
    named_behaviors,
    products,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name; it runs with the session zone at UTC."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(session.pin_utc(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def _weights(df: DataFrame, keys: list[str], vector: str = "vector") -> DataFrame:
    """A vector as rows ``bucket, weight``, without zeros; a zero vector as one row with bucket -1."""
    cells = F.filter(
        F.transform(F.col(vector), lambda x, i: F.struct(i.alias("bucket"), x.cast("double").alias("weight"))),
        lambda cell: cell["weight"] != 0,
    )
    return df.select(*keys, F.explode_outer(cells).alias("cell")).select(
        *keys,
        F.coalesce(F.col("cell.bucket").cast("bigint"), F.lit(-1)).alias("bucket"),
        F.coalesce(F.col("cell.weight"), F.lit(0.0)).alias("weight"),
    )


# --- scoring ------------------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.interaction_features(named_behaviors(spark, sf_dir), CLICK_TYPES, ["event_id"])


@query
def interaction_scores(spark, sf_dir):
    events = named_behaviors(spark, sf_dir)
    return scoring.interaction_scores(events, event_types=CLICK_TYPES, tie_breakers=["event_id"], with_session=True)


@query
def interaction_scores_hot_sessions(spark, sf_dir):
    """The same with sessions of six events and more going the way of hot ones."""
    events = named_behaviors(spark, sf_dir)
    return scoring.interaction_scores(
        events, event_types=CLICK_TYPES, tie_breakers=["event_id"], with_session=True, hot_rows=6
    )


@query
def interaction_shares(spark, sf_dir):
    shares = scoring.interaction_shares(named_behaviors(spark, sf_dir), CLICK_TYPES, ["event_id"])
    return shares.select(
        "user_session", "product_id", "user_id", "name", *[F.col(f).alias(f.lower()) for f in ("F1", "F2", "F3", "F4")]
    )


@query
def event_indicators(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        *[scalars.indicator("event_type", kind).cast("bigint").alias(name) for name, kind in CLICK_TYPES.items()],
    )


@query
def session_totals(spark, sf_dir):
    return aggregates.session_totals(behaviors(spark, sf_dir), event_types=CLICK_TYPES)


@query
def session_product_counts(spark, sf_dir):
    return aggregates.session_product_counts(named_behaviors(spark, sf_dir), event_types=CLICK_TYPES)


@query
def time_spent(spark, sf_dir):
    return sessions.time_spent(behaviors(spark, sf_dir), "event_id").select(
        "event_id", micros_text("prev_event_time").alias("prev_event_time"), "time_spent"
    )


@query
def time_spent_hot_sessions(spark, sf_dir):
    """The same with sessions of six events and more going the way of hot ones."""
    return sessions.time_spent(behaviors(spark, sf_dir), "event_id", hot_rows=6).select(
        "event_id", micros_text("prev_event_time").alias("prev_event_time"), "time_spent"
    )


@query
def product_time(spark, sf_dir):
    return scoring.product_time(_features(spark, sf_dir))


@query
def session_time(spark, sf_dir):
    return scoring.session_time(_features(spark, sf_dir))


# --- enrichment and catalogue -------------------------------------------------------------------


def _readable(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("event_time", micros_text("event_time"))


@query
def enriched_events(spark, sf_dir):
    return _readable(enrichment.enrich_events(behaviors(spark, sf_dir), products(spark, sf_dir)))


@query
def enriched_events_broadcast(spark, sf_dir):
    return _readable(enrichment.enrich_events(behaviors(spark, sf_dir), products(spark, sf_dir), broadcast=True))


@query
def enriched_events_hot_products(spark, sf_dir):
    """Shuffled, with products of a hundred events and more broadcast as hot ones."""
    enriched = enrichment.enrich_events(behaviors(spark, sf_dir), products(spark, sf_dir), False, hot_rows=100)
    return _readable(enriched)


@query
def enriched_events_mixed_keys(spark, sf_dir):
    """Event keys as text, every hundredth dirty, against the catalogue's numbers."""
    dirty = F.when(F.col("event_id") % 100 == 0, F.concat(F.lit("x"), "product_id"))
    events = behaviors(spark, sf_dir).withColumn("product_id", F.coalesce(dirty, F.col("product_id").cast("string")))
    return _readable(enrichment.enrich_events(events, products(spark, sf_dir), broadcast=True))


@query
def category_codes(spark, sf_dir):
    return enrichment.product_dimension(products(spark, sf_dir)).select("product_id", "category_code")


@query
def catalogue_merge(spark, sf_dir):
    older = named_behaviors(spark, sf_dir).select(
        F.col("user_session").alias("sessionId"),
        F.col("event_type").alias("behavior"),
        micros_text("event_time").alias("event_time"),
        "user_id",
        F.col("name").alias("product_name"),
        "product_id",
    )
    catalogue = products(spark, sf_dir).withColumnRenamed("product_id", "productID").drop("name")
    legacy = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.lit(None).cast("string").alias("category_code"),
        F.col("l_returnflag").alias("brand"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_orderkey").alias("user_session"),
        F.lit("legacy").alias("name"),
        F.col("l_linenumber").alias("category_id"),
    )
    merged = enrichment.merge_catalogue(older, catalogue, legacy)
    return merged.withColumn("price", F.col("price").cast("double"))


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select(
        F.col("p_partkey").alias("productID"),
        F.col("p_name").alias("name"),
        (F.col("p_size") % 5).alias("rating"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.col("p_retailprice").alias("price"),
        F.concat(F.lit("img/"), "p_partkey").alias("image[0]"),
        F.concat(F.lit("img/b/"), "p_partkey").alias("image[1]"),
        F.concat_ws(" ", F.lit("A so-called \"product\", made for every home and every day:"), "p_name", "p_brand", "p_type").alias(
            "new_description"
        ),
    )


@query
def catalogue_clean(spark, sf_dir):
    return enrichment.clean_catalogue(_catalogue(spark, sf_dir))


# --- exploring ----------------------------------------------------------------------------------


@query
def top_buyers(spark, sf_dir):
    return buyers.top_buyers(table(spark, sf_dir, "events"))


@query
def top_buyer_rows(spark, sf_dir):
    return buyers.top_buyer_rows(behaviors(spark, sf_dir)).select("event_id", "user_id", "product_id", "event_type")


@query
def purchases(spark, sf_dir):
    return rows.of_type(table(spark, sf_dir, "events"), "purchase").select("event_id", "user_id")


@query
def events_per_user(spark, sf_dir):
    return aggregates.count_per(table(spark, sf_dir, "events"), ["user_id"], "n_events")


@query
def distinct_counts(spark, sf_dir):
    return aggregates.distinct_counts(behaviors(spark, sf_dir), ["user_id", "product_id"])


@query
def profile_events(spark, sf_dir):
    return aggregates.profile(table(spark, sf_dir, "events"))


@query
def distinct_documents(spark, sf_dir):
    return rows.distinct_rows(table(spark, sf_dir, "documents").select("text", "lang", "source"))


class _Stopped(Exception):
    """A load that is stopped on purpose."""


@query
def resumable_distinct_load(spark, sf_dir):
    """The distinct documents in five chunks, by a load that is stopped in its third chunk and started again."""
    documents = table(spark, sf_dir, "documents")
    chunks = [documents.filter(F.col("doc_id") % 5 == n).select("text", "lang", "source") for n in range(5)]
    out = session.shared_dir(spark, "distinct")
    write = sinks.batch_folder(f"{out}/rows")

    def stopped(rows: DataFrame, chunk: int) -> None:
        write(rows, chunk)
        if chunk == 2:
            raise _Stopped

    try:
        distinct_load.DistinctLoad(spark, f"{out}/load", 16).load(chunks, stopped)
    except _Stopped:
        distinct_load.DistinctLoad(spark, f"{out}/load", 16).load(chunks, write)
    return sinks.read_batches(spark, f"{out}/rows", chunks[0].schema).drop(sinks.BATCH)


@query
def merged_profiles(spark, sf_dir):
    """States of line items by day, merged to months, and from these the profile of all; half of them within 1 %."""
    items = table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]
    days = profiles.states(items, F.col("l_shipdate").cast("date"), columns)
    months = profiles.merged_states(days, F.trunc("part", "month"))
    found = profiles.profile_of(months, [0.5])
    middle = items.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])))
    below = middle.join(F.broadcast(found.select("column_name", F.col("quantiles")[0].alias("half"))), "column_name").groupBy("column_name").agg(
        (F.avg((F.col("x") < F.col("half")).cast("double")) <= 0.52).alias("low_enough"), (F.avg((F.col("x") <= F.col("half")).cast("double")) >= 0.48).alias("high_enough")
    )
    return found.join(below, "column_name").select(
        "column_name", "n_rows", "n_nulls", "low", "high", "n_distinct", (F.col("low_enough") & F.col("high_enough")).alias("half_is_half")
    )


def _drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a producer that changes: a new field in each seventh, a number as text in each eleventh."""
    events = named_behaviors(spark, sf_dir)
    user = F.when(F.col("event_id") % 11 == 0, F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), "name"))).otherwise(
        F.to_json(F.struct("user_id", "name"))
    )
    extra = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit(',"device":{"kind":"phone","n":'), F.col("event_id"), F.lit("}}"))).otherwise(F.lit("}"))
    return events.withColumns({"j": user, "extra": extra}).select("event_id", F.concat(F.expr("left(j, length(j) - 1)"), "extra").alias("value"))


_USER = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("name", T.StringType())])


@query
def message_drift(spark, sf_dir):
    """How often each field came as which type."""
    return drift.drift(_drifting(spark, sf_dir), _USER)


@query
def message_unknown_fields(spark, sf_dir):
    """Declared fields, and what the messages hold beyond them."""
    found = drift.with_unknown(_drifting(spark, sf_dir), _USER)
    return found.groupBy("user_id").agg(F.count("*").alias("n"), F.count("unknown").alias("with_unknown"), F.count("misfits").alias("with_misfits"),
        F.min("unknown").alias("first_unknown"))


@query
def collection_scan(spark, sf_dir):
    """Documents of a collection by a key that a third of them share: rows, splits, and whether these are even."""
    folder = session.shared_dir(spark, "collection")
    events = behaviors(spark, sf_dir)
    skewed = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("product_id") * F.col("product_id"))
    events.select(F.col("event_id").alias("_id"), skewed.alias("product_key"), "event_type", "user_id").write.parquet(folder)
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        documents = collection.read_collection(spark, {"path": folder}, ["_id", "product_key", "event_type"], "product_key", 8)
        found = documents.filter("product_key >= 4").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("product_key").alias("total"))
        sizes = documents.groupBy(F.spark_partition_id().alias("split")).count()
        even = sizes.agg(F.count("*").alias("splits"), (F.max("count") < 1.5 * F.avg("count")).alias("even"))
        return saved(found.join(F.broadcast(even), F.lit(True)), f"{folder}-found")
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


@query
def stored_layout_join(spark, sf_dir):
    """Events and products in tables of buckets by product, joined where they lie."""
    folder = session.shared_dir(spark, "layout")
    tag = folder.rsplit("-", 1)[-1]
    events = behaviors(spark, sf_dir).withColumn("product_id", F.col("product_id"))
    stored = tables.store_layout(events, f"events_{tag}", f"{folder}/events", ["product_id"], 8)
    catalogue = tables.store_layout(products(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("bigint")), f"products_{tag}", f"{folder}/products", ["product_id"], 8)
    return _readable(enrichment.enrich_events(stored, catalogue))


@query
def except_rows(spark, sf_dir):
    """Parts and suppliers of all line items that are not those of equal line numbers and quantities."""
    lines = table(spark, sf_dir, "lineitem")
    ordered = lines.select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("number"))
    quantities = lines.select(F.col("l_partkey").alias("part"), F.col("l_quantity").cast("bigint").alias("number"))
    return rows.rows_except(ordered, quantities)


_PARTY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.LongType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("segment", T.StringType()),
    ]
)


@query
def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("balance"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return rows.stack(_PARTY, customers, suppliers)


@query
def ordered_limit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return aggregates.first_rows(orders, ["o_custkey", "o_orderkey"], 1000)


@query
def filled_measures(spark, sf_dir):
    orders = aggregates.count_per(table(spark, sf_dir, "orders"), ["o_custkey"], "n_orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    return rows.fill_measures(joined, ["n_orders"])


@query
def laid_out_by_user(spark, sf_dir):
    """Parts of the layout that hold a user's events: one, though the events come spread over many."""
    events = rows.evenly(table(spark, sf_dir, "events").select("event_id", "user_id"), 7)
    placed = rows.by_hash(events, ["user_id"], 5).withColumn("part", F.spark_partition_id())
    return placed.groupBy("user_id").agg(F.count_distinct("part").alias("parts"), F.count("*").alias("n_events"))


@query
def laid_out_evenly(spark, sf_dir):
    """Seven parts that differ little, from events laid out by their type, of which there are five."""
    events = rows.by_hash(table(spark, sf_dir, "events").select("event_id", "event_type"), ["event_type"], 7)
    placed = rows.evenly(events, 7).groupBy(F.spark_partition_id().alias("part")).count()
    return placed.agg(
        F.count("*").alias("parts"), F.sum("count").alias("n_events"), (F.max("count") - F.min("count") < 200).alias("even")
    )


# --- scalar functions ---------------------------------------------------------------------------


@query
def combined_attributes(spark, sf_dir):
    return dataset(spark, sf_dir).select("user_session", "event_time", scalars.combined_attributes().alias("combined_attributes"))


@query
def event_time_utc_label(spark, sf_dir):
    """Labelled in a session of another zone, which is put back."""
    labels = behaviors(spark, sf_dir).select("event_id", scalars.utc_label("event_time").alias("label"))
    return _elsewhere(spark, labels)


@query
def parse_event_time(spark, sf_dir):
    millis = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    texts = behaviors(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 7 == 0, F.lit("not a time")).otherwise(millis).alias("time_text")
    )
    texts = texts.select("event_id", "time_text")
    folder = session.shared_dir(spark, "times")
    texts.write.parquet(folder)
    parsed = spark.read.parquet(folder).withColumn("parsed", scalars.parse_event_time("time_text")).drop("time_text")
    parsed = _elsewhere(spark, parsed)
    return parsed.select("event_id", micros_text("parsed").alias("parsed"), F.coalesce(F.unix_timestamp("parsed"), F.lit(-1)).alias("seconds"))


def _elsewhere(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` as a session with another zone computes it."""
    folder = session.shared_dir(spark, "elsewhere")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.parquet(folder)


@query
def parse_events_json(spark, sf_dir):
    good, _ = topics.parse_records(messages(spark, sf_dir), keep=["partition", "offset"])
    return good.select(
        "partition",
        "offset",
        "user_session",
        F.col("user_id").cast("bigint"),
        "product_id",
        "name",
        "event_type",
        micros_text("event_time").alias("event_time"),
    )


@query
def dead_letters(spark, sf_dir):
    _, dead = topics.parse_records(messages(spark, sf_dir), keep=["partition", "offset"])
    return dead


@query
def encode_events_json(spark, sf_dir):
    encoded = topics.encode_records(table(spark, sf_dir, "events"))
    fields = T.StructType([T.StructField(name, T.StringType()) for name in table(spark, sf_dir, "events").columns])
    one = encoded.select(F.from_json("value", fields).alias("e"))
    return one.select(
        F.col("e.event_id").cast("bigint").alias("event_id"),
        F.date_format(F.col("e.ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"),
        F.col("e.user_id").cast("bigint").alias("user_id"),
        F.col("e.event_type").alias("event_type"),
        F.col("e.value").cast("double").alias("amount"),
        F.col("e.props").alias("props"),
    )


@query
def point_ids(spark, sf_dir):
    events = behaviors(spark, sf_dir).withColumn("event_time", micros_text("event_time"))
    return events.select("event_id", scalars.point_id(*upsert.POINT_KEY).alias("point_id"))


@query
def embed_text(spark, sf_dir):
    unnamed = F.when(F.col("category") != "ECONOMY", F.col("name")).alias("name")
    names = products(spark, sf_dir).select("product_id", unnamed)
    events = behaviors(spark, sf_dir).join(names, "product_id", "left")
    return events.select("event_id", scalars.event_text().alias("embed_text"))


@query
def topic_message_count(spark, sf_dir):
    return topics.message_count(_positions(spark, sf_dir))


@query
def topic_partition_counts(spark, sf_dir):
    return topics.partition_counts(_positions(spark, sf_dir))


@query
def topic_counts(spark, sf_dir):
    """Two topics, their partitions numbered alike."""
    topic = F.when(F.col("offset") % 3 == 0, "orders").otherwise("events").alias("topic")
    return topics.topic_counts(_positions(spark, sf_dir).select("*", topic))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") % 4).alias("partition"), F.expr("event_id div 4").alias("offset")
    )


# --- text and vectors ---------------------------------------------------------------------------


@query
def tokens(spark, sf_dir):
    words = text.tokenize(table(spark, sf_dir, "documents"), "text")
    return words.select("doc_id", text.joined_tokens("words").alias("tokens"))


@query
def filtered_tokens(spark, sf_dir):
    words = text.filtered_tokens(table(spark, sf_dir, "documents"), "text")
    return words.select("doc_id", text.joined_tokens("filtered_words").alias("tokens"))


@query
def hash_embedding(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _weights(vector_plans.embed_names(documents, name="text"), ["doc_id"])


@query
def hash_embedding_distinct(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _weights(vector_plans.embed_names(documents, name="text", distinct=True), ["doc_id"])


def _letter_model():
    """A stand-in for a sentence model: 130 numbers per text, its letters counted by code.

    The functions are nested, so that they travel to the executors by value.
    """

    def counts(one):
        numbers = [0.0] * 130
        for letter in one:
            numbers[ord(letter) % 130] += 1.0
        return numbers

    return lambda: lambda texts: [counts(one) for one in texts]


@query
def model_embedding(spark, sf_dir):
    embedder = ModelEmbedder(_letter_model())
    names = products(spark, sf_dir).select("product_id", "name")
    return _weights(vector_plans.embed_names(names, embedder), ["product_id"])


@query
def name_vectors(spark, sf_dir):
    points = vector_plans.name_points(dataset(spark, sf_dir))
    return _weights(points, schemas.DATASET.fieldNames())


@query
def retrain_vectors(spark, sf_dir):
    points = vector_plans.retrain_points(dataset(spark, sf_dir))
    return _weights(points, [name for name in vector_plans.TRAINING_COLUMNS if name != "vector"])


@query
def truncate_vectors(spark, sf_dir):
    cut = table(spark, sf_dir, "embeddings").withColumn("vector", vectors.truncate("embedding", 48))
    return _weights(cut, ["vec_id"])


def _mixed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings, some of them cut, missing or with a null element."""
    value = F.col("embedding")
    with_null = F.transform(value, lambda x, i: F.when(i > 0, x))
    broken = (
        F.when(F.col("vec_id") % 10 == 1, F.slice(value, 1, 63))
        .when(F.col("vec_id") % 10 == 2, F.lit(None))
        .when(F.col("vec_id") % 10 == 3, with_null)
        .otherwise(value)
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", broken.alias("vector"))


@query
def vector_contract(spark, sf_dir):
    good, bad = vectors.split_by_contract(_mixed_vectors(spark, sf_dir), dimension=64)
    return good.select("vec_id", F.lit("good").alias("verdict")).unionByName(
        bad.select("vec_id", F.col("violation").alias("verdict"))
    )


@query
def unit_vectors(spark, sf_dir):
    unit = table(spark, sf_dir, "embeddings").withColumn("vector", vectors.unit_length("embedding"))
    length = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return unit.select("vec_id", F.size("vector").alias("dimension"), F.round(length, 5).alias("squared_length"))


@query
def vocabulary(spark, sf_dir):
    words = vector_plans.word_tokens(named_behaviors(spark, sf_dir).select("name"), "name")
    return vector_plans.vocabulary(words, min_count=10)


@query
def word2vec_training(spark, sf_dir):
    extract = vector_plans.training_vectors(behaviors(spark, sf_dir), products(spark, sf_dir))
    return extract


@query
def word2vec_combined(spark, sf_dir):
    return vector_plans.combined_vectors(dataset(spark, sf_dir))


@query
def word2vec_behavior(spark, sf_dir):
    return vector_plans.behavior_vectors(named_behaviors(spark, sf_dir))


def _shape(df: DataFrame, keys: list[str]) -> DataFrame:
    """What is certain about a Word2Vec vector: its length, and whether the text has a known word."""
    return df.select(
        *keys, F.size("vector").alias("dimension"), F.exists("vector", lambda x: x != 0).alias("has_words")
    )


@query
def word2vec_training_shape(spark, sf_dir):
    keys = ["user_session", "event_time", "product_id", "name", "brand", "category_code", "price", "event_type"]
    return _shape(word2vec_training(spark, sf_dir), keys)


@query
def word2vec_combined_shape(spark, sf_dir):
    return _shape(word2vec_combined(spark, sf_dir), ["product_id"])


@query
def word2vec_behavior_shape(spark, sf_dir):
    return _shape(word2vec_behavior(spark, sf_dir), ["user_id", "product_id", "name"])


def _means(words: DataFrame, text: str, settings) -> DataFrame:
    """Whether each vector is the mean of its words' vectors, an unknown word counting as zero."""
    tokens = vector_plans.word_tokens(words, text)
    if isinstance(settings, vector_plans.BlockedSettings):
        model = vector_plans.fit_blocked(tokens.select("_words"), settings, "_words")
        known = model.vectors().withColumnRenamed("vector", "known")
    else:
        model = vector_plans.fit_word2vec(tokens, settings)
        known = model.getVectors().select("word", vectors.float_array("vector").alias("known"))
    found = vector_plans.word2vec_vectors(words.select(text), text, settings, model).distinct()
    exploded = tokens.select(text, "_words").distinct().select(text, F.size("_words").alias("n"), F.explode_outer("_words").alias("word"))
    each = exploded.join(known, "word", "left").select(text, "n", F.posexplode_outer("known").alias("place", "x"))
    sums = each.filter("place IS NOT NULL").groupBy(text, "place").agg((F.sum(F.col("x").cast("double")) / F.first("n")).alias("mean"))
    cells = found.select(text, F.posexplode("vector").alias("place", "got"))
    off = F.abs(F.col("got") - F.coalesce("mean", F.lit(0.0)))
    return cells.join(sums, [text, "place"], "left").groupBy(text).agg(F.count("*").alias("dimension"), (F.max(off) < 1e-5).alias("is_mean"))


@query
def word2vec_means(spark, sf_dir):
    """The vectors of all product names that occur, against the mean over all words, known or not."""
    settings = vector_plans.Word2VecSettings(min_count=10)
    return _means(named_behaviors(spark, sf_dir).select("name"), "name", settings)


# Small blocks, so that the small vocabulary of the test tables needs several.
BLOCKED = vector_plans.BlockedSettings(min_count=10, block_words=20)


@query
def word2vec_blocked_means(spark, sf_dir):
    """The same of a model that is a table of blocks."""
    return _means(named_behaviors(spark, sf_dir).select("name"), "name", BLOCKED)


@query
def word2vec_blocked_training_shape(spark, sf_dir):
    keys = ["user_session", "event_time", "product_id", "name", "brand", "category_code", "price", "event_type"]
    return _shape(vector_plans.training_vectors(behaviors(spark, sf_dir), products(spark, sf_dir), BLOCKED), keys)


@query
def behavior_vectors_hashed(spark, sf_dir):
    """Every event's vector by value, one row for each event and bucket."""
    found = vector_plans.behavior_vectors(named_behaviors(spark, sf_dir), embedder=HashingEmbedder())
    return _weights(found, ["user_id", "product_id", "name"])


@query
def training_vectors_hashed(spark, sf_dir):
    """The training extract by value."""
    found = vector_plans.training_vectors(behaviors(spark, sf_dir), products(spark, sf_dir), embedder=HashingEmbedder())
    return _weights(found.withColumn("price", F.col("price").cast("string")), [name for name in vector_plans.TRAINING_COLUMNS if name != "vector"])


@query
def combined_vectors_hashed(spark, sf_dir):
    return _weights(vector_plans.combined_vectors(dataset(spark, sf_dir).distinct(), embedder=HashingEmbedder()), ["product_id"])


# --- files, sinks and streams -------------------------------------------------------------------


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


@query
def csv_roundtrip(spark, sf_dir):
    path = session.shared_dir(spark, "csv")
    parts = _part(spark, sf_dir)
    files.write_csv(parts, path)
    return schemas.conform(files.read_csv_text(spark, path), parts.schema)


@query
def csv_inferred(spark, sf_dir):
    path = session.shared_dir(spark, "csv-inferred")
    files.write_csv(_part(spark, sf_dir).withColumn("p_retailprice", F.col("p_retailprice") + 0.25), path)
    return files.read_csv_inferred(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query
def csv_quoted(spark, sf_dir):
    path = session.shared_dir(spark, "csv-quoted")
    catalogue = _catalogue(spark, sf_dir).select("productID", "new_description")
    files.write_csv(catalogue, path, quoted=True)
    return files.read_csv_quoted(spark, path, catalogue.schema)


@query
def csv_quarantine(spark, sf_dir):
    """Parts as lines: each fifth misses a column, each fifth after that has one too many."""
    path = session.shared_dir(spark, "csv-lines")
    kind = F.col("p_partkey") % 5
    line = F.concat_ws(",", "p_partkey", "p_name", "p_brand")
    lines = _part(spark, sf_dir).select(
        F.when(kind == 0, F.concat_ws(",", "p_partkey", "p_name"))
        .when(kind == 1, F.concat(line, F.lit(",extra")))
        .otherwise(line)
        .alias("value")
    )
    lines.write.text(path)
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_brand", T.StringType()),
        ]
    )
    checked = files.read_csv_checked(spark, path, schema, header=False)
    good, bad = files.split_corrupt(checked)
    marked = good.withColumn(schemas.CORRUPT, F.lit(None).cast("string")).unionByName(bad)
    return marked.withColumnRenamed(schemas.CORRUPT, "line")


@query
def csv_times(spark, sf_dir):
    """Event times down to the microsecond, written and read back."""
    path = session.shared_dir(spark, "csv-times")
    events = behaviors(spark, sf_dir).select("event_id", "event_time")
    files.write_csv(events, path)
    return _readable(schemas.conform(files.read_csv_text(spark, path), events.schema))


@query
def csv_reordered(spark, sf_dir):
    """Parts in files with another order of columns and one more, some lines broken."""
    path = session.shared_dir(spark, "csv-reordered")
    key = F.col("p_partkey")
    line = F.when(key % 5 == 0, F.concat_ws(",", "p_name", "p_brand")).otherwise(F.concat_ws(",", "p_name", F.lit("more"), "p_partkey", "p_brand"))
    lines = _part(spark, sf_dir).select(F.lit(1).alias("place"), line.alias("value"), (key % 3).alias("file"))
    header = spark.range(1).select(F.lit(0).alias("place"), F.lit("p_name,other,p_partkey,p_brand").alias("value"))
    for number in range(3):
        own = header.union(lines.filter(F.col("file") == number).drop("file"))
        own.repartition(1).sortWithinPartitions("place").select("value").write.text(f"{path}/file-{number}")
    schema = T.StructType([T.StructField(n, t) for n, t in (("p_partkey", T.LongType()), ("p_brand", T.StringType()), ("p_name", T.StringType()))])
    good, bad = files.split_corrupt(files.read_csv_checked(spark, f"{path}/file-*", schema))
    marked = good.withColumn(schemas.CORRUPT, F.lit(None).cast("string"))
    broken = bad.select(*[F.lit(None).cast(good.schema[n].dataType).alias(n) for n in good.columns], schemas.CORRUPT)
    return marked.unionByName(broken).withColumnRenamed(schemas.CORRUPT, "line")


@query
def csv_single_file(spark, sf_dir):
    """All orders in one file."""
    path = session.shared_dir(spark, "csv-single")
    files.write_csv(rows.evenly(table(spark, sf_dir, "orders").select("o_orderkey"), 5), path, single_file=True)
    read = spark.read.csv(path, header=True).select(F.input_file_name().alias("file"))
    return read.agg(F.count_distinct("file").alias("files"), F.count("*").alias("n_rows"))


@query
def topic_read(spark, sf_dir):
    """The topic's records written and read in batch, by the format of files."""
    path = {"path": session.shared_dir(spark, "topic-batch")}
    topics.write_topic(messages(spark, sf_dir), path, "parquet")
    return topics.read_topic(spark, path, "parquet")


@query
def topic_stream(spark, sf_dir):
    """The topic's records as an endless stream of files, one file a batch, drained into a table."""
    out, checkpoint = session.shared_dir(spark, "drained"), session.shared_dir(spark, "checkpoint")
    records = topics.stream_topic(spark, {"path": _arrive(spark, sf_dir), "maxFilesPerTrigger": "1"}, "text")
    writer = records.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start(out).awaitTermination()
    return spark.read.parquet(out).select(F.get_json_object("value", "$.user_session").alias("user_session"), F.length("value").alias("length"))


@query
def retrain_message(spark, sf_dir):
    """The retrain event sent to a topic as JSON and read back."""
    points = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    n = vector_sink.write_points(points, "parquet", {"path": session.shared_dir(spark, "points")}, dimension=64)
    topic = {"path": session.shared_dir(spark, "retrain-topic")}
    topics.write_topic(retrain.as_topic_value(retrain.retrain_event(spark, n, f"{n} points")), topic, "text")
    return topics.read_topic(spark, topic, "text").select(
        F.get_json_object("value", "$.event").alias("event"),
        F.get_json_object("value", "$.message").alias("message"),
        (F.get_json_object("value", "$.timestamp").cast("bigint") > 0).alias("has_timestamp"),
    )


@query
def parquet_roundtrip(spark, sf_dir):
    path = session.shared_dir(spark, "parquet")
    files.write_parquet(_part(spark, sf_dir), path)
    return tables.read_table(spark, "parquet", {"path": path}, ["p_partkey", "p_name", "p_retailprice"])


@query
def table_append(spark, sf_dir):
    path = session.shared_dir(spark, "table")
    parties = union_by_name(spark, sf_dir)
    tables.write_table(parties, "parquet", {"path": path}, "append")
    tables.write_table(parties, "parquet", {"path": path}, "append")
    return tables.read_table(spark, "parquet", {"path": path}).groupBy("name", "nation").agg(F.count("*").alias("n"))


@query
def vector_sink_points(spark, sf_dir):
    path = session.shared_dir(spark, "points")
    points = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    vector_sink.write_points(points, "parquet", {"path": path}, "overwrite", dimension=64)
    return _weights(spark.read.parquet(path), ["vec_id", "label"])


@query
def load_names(spark, sf_dir):
    """The dataset as a CSV file, checked, loaded twice into one collection, and read back."""
    path, target = session.shared_dir(spark, "dataset"), session.shared_dir(spark, "points")
    files.write_csv(dataset(spark, sf_dir), path)
    good, _ = loads.read_dataset(spark, path)
    collection = loads.Collection(options={"path": target})
    loads.load_names(good, collection)
    loads.load_names(good, collection)
    return _weights(spark.read.parquet(target), schemas.DATASET.fieldNames())


@query
def load_retrain(spark, sf_dir):
    """The training extract as a CSV file, loaded, and read back."""
    path, target = session.shared_dir(spark, "extract"), session.shared_dir(spark, "points")
    files.write_csv(dataset(spark, sf_dir), path)
    loads.load_retrain(spark, path, loads.Collection(options={"path": target}))
    return _weights(spark.read.parquet(target), [name for name in vector_plans.TRAINING_COLUMNS if name != "vector"])


@query
def retrain_event(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    target = {"path": session.shared_dir(spark, "points")}
    event = retrain.retrain_event(spark, vector_sink.write_points(points, "parquet", target, dimension=64))
    return event.select("event", "message", "n_points", (F.col("timestamp") > 0).alias("has_timestamp"))


def _arrive(spark: SparkSession, sf_dir: str) -> str:
    """The topic records as a folder of lines."""
    path = session.shared_dir(spark, "topic")
    rows.without_tombstones(messages(spark, sf_dir)).select("value").write.text(path)
    return path


def _string_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("string"))


@query
def stream_ingest(spark, sf_dir):
    out, checkpoint = session.shared_dir(spark, "ingest"), session.shared_dir(spark, "checkpoint")
    lines = topics.stream_lines(spark, _arrive(spark, sf_dir), 4)
    catalogue = _string_products(spark, sf_dir)
    ingest.ingest_stream(lines, catalogue, ingest.folder_sinks(out), checkpoint).awaitTermination()
    written = enrichment.enrich_events(spark.createDataFrame([], schemas.BEHAVIOR), catalogue).schema
    enriched = sinks.read_batches(spark, f"{out}/enriched", written, "csv", {"header": "true"})
    return enriched.drop(sinks.BATCH).select(
        F.col("user_id").cast("bigint"),
        "product_id",
        "event_type",
        micros_text("event_time").alias("event_time"),
        "user_session",
        "name",
        "brand",
        "category_code",
        "price",
    )


@query
def stream_ingest_raw(spark, sf_dir):
    out, checkpoint = session.shared_dir(spark, "ingest"), session.shared_dir(spark, "checkpoint")
    lines = topics.stream_lines(spark, _arrive(spark, sf_dir), 4)
    ingest.ingest_stream(lines, _string_products(spark, sf_dir), ingest.folder_sinks(out), checkpoint).awaitTermination()
    raw = sinks.read_batches(spark, f"{out}/behaviors", schemas.BEHAVIOR).drop(sinks.BATCH)
    return raw.select(
        "user_session", F.col("user_id").cast("bigint"), "product_id", "name", "event_type", micros_text("event_time").alias("event_time")
    )


@query
def stream_restart(spark, sf_dir):
    """The same stream stopped and started again when more records have come; each record counts once."""
    out, checkpoint = session.shared_dir(spark, "ingest"), session.shared_dir(spark, "checkpoint")
    path = session.shared_dir(spark, "topic")
    records = rows.without_tombstones(messages(spark, sf_dir))
    for part in (0, 1):
        records.filter(F.col("offset") % 2 == part).select("value").write.mode("append").text(path)
        lines = topics.stream_lines(spark, path, 2)
        ingest.ingest_stream(lines, _string_products(spark, sf_dir), ingest.folder_sinks(out), checkpoint).awaitTermination()
    raw = sinks.read_batches(spark, f"{out}/behaviors", schemas.BEHAVIOR)
    return raw.groupBy("product_id").agg(F.count("*").alias("n"))


@query
def stream_bounded_batches(spark, sf_dir):
    """One file a batch: the batches' own counts of records, good and bad, add up."""
    out, checkpoint = session.shared_dir(spark, "ingest"), session.shared_dir(spark, "checkpoint")
    path = session.shared_dir(spark, "topic")
    rows.without_tombstones(messages(spark, sf_dir)).select("value").repartition(3).write.text(path)
    lines = topics.stream_lines(spark, path, 1)
    ingest.ingest_stream(lines, _string_products(spark, sf_dir), ingest.folder_sinks(out), checkpoint).awaitTermination()
    good = sinks.read_batches(spark, f"{out}/behaviors", schemas.BEHAVIOR).select(sinks.BATCH)
    dead = sinks.read_batches(spark, f"{out}/dead_letters", T.StructType([T.StructField("value", T.StringType())])).select(sinks.BATCH)
    both = good.select("*", F.lit(1).alias("good")).unionByName(dead.select("*", F.lit(0).alias("good")))
    return both.agg(F.count_distinct(sinks.BATCH).alias("batches"), F.sum("good").alias("good"), F.count_if(F.col("good") == 0).alias("dead"))


@query
def stream_vector_upsert(spark, sf_dir):
    out, checkpoint = session.shared_dir(spark, "upsert"), session.shared_dir(spark, "checkpoint")
    lines = topics.stream_lines(spark, _arrive(spark, sf_dir), 4)
    points, dead = sinks.batch_folder(f"{out}/points"), sinks.batch_folder(f"{out}/dead_letters")
    upsert.upsert_stream(lines, points, dead, checkpoint, until_now=True).awaitTermination()
    return _point_weights(sinks.read_points(spark, f"{out}/points", upsert.POINT))


def _point_weights(points: DataFrame) -> DataFrame:
    return _weights(points, ["point_id", *upsert.PAYLOAD.fieldNames()])


@query
def stream_vector_upsert_once(spark, sf_dir):
    """All records twice, the second time in later batches: how often each product's points were written."""
    out, checkpoint = session.shared_dir(spark, "upsert"), session.shared_dir(spark, "checkpoint")
    path = session.shared_dir(spark, "topic")
    points, dead = sinks.batch_folder(f"{out}/points"), sinks.batch_folder(f"{out}/dead_letters")
    for _ in range(2):
        rows.without_tombstones(messages(spark, sf_dir)).select("value").coalesce(2).write.mode("append").text(path)
        lines = topics.stream_lines(spark, path, 1)
        upsert.upsert_stream(lines, points, dead, checkpoint, until_now=True, horizon="1 day").awaitTermination()
    written = sinks.read_batches(spark, f"{out}/points", upsert.POINT)
    return written.groupBy("product_id").agg(F.count("*").alias("written"), F.count_distinct("point_id").alias("points"))


@query
def stream_point_table(spark, sf_dir):
    """Points in a table of buckets, compacted between two runs of the stream and read by its newest version."""
    out, checkpoint = session.shared_dir(spark, "points"), session.shared_dir(spark, "checkpoint")
    path = session.shared_dir(spark, "topic")
    points, dead = point_table.PointTable(spark, out, upsert.POINT, buckets=8), sinks.batch_folder(f"{out}-dead")
    records = rows.without_tombstones(messages(spark, sf_dir))
    for part in (0, 1):
        records.filter(F.col("offset") % 2 == part).select("value").repartition(2).write.mode("append").text(path)
        upsert.upsert_stream(topics.stream_lines(spark, path, 1), points.write, dead, checkpoint, until_now=True).awaitTermination()
        if not part:
            points.compact()
            points.vacuum()
    return _point_weights(points.read())


def _log(spark: SparkSession, sf_dir: str, parts: int = 1) -> str:
    """The topic records as a log of four partitions, written in so many steps, beside an empty topic."""
    path = session.shared_dir(spark, "log")
    record_log.create_topic(path, "behaviors", 4)
    record_log.create_topic(path, "empty", 2)
    records = messages(spark, sf_dir).select("value", "partition", "offset")
    for part in range(parts):
        record_log.append(records.filter(F.col("offset") % parts == part), path, "behaviors")
    return path


@query
def log_read(spark, sf_dir):
    """The records of a log in batch, with the offsets that it gave them."""
    options = record_log.log_options(_log(spark, sf_dir), ["behaviors", "empty"])
    records = topics.read_topic(spark, options, record_log.FORMAT)
    good, dead = topics.split_records(topics.tag_records(records), keep=["topic", "partition", "offset"])
    both = good.select("partition", "offset", F.lit(1).alias("good")).union(dead.select("partition", "offset", F.lit(0)))
    each = both.groupBy("partition").agg(F.sum("good").alias("good"), F.count("*").alias("records"), F.count_distinct("offset").alias("offsets"))
    return each


@query
def log_stream(spark, sf_dir):
    """The log as a stream of bounded batches, stopped and started again when more has come."""
    out, checkpoint, path = session.shared_dir(spark, "ingest"), session.shared_dir(spark, "checkpoint"), session.shared_dir(spark, "log")
    record_log.create_topic(path, "behaviors", 4)
    record_log.register(spark)
    records = messages(spark, sf_dir).select("value", "partition", "offset")
    total = records.count()
    for part in (0, 1):
        record_log.append(records.filter(F.col("offset") % 2 == part), path, "behaviors")
        stream = topics.stream_topic(spark, record_log.log_options(path, ["behaviors"], -(-total // 5)), record_log.FORMAT)
        query = ingest.ingest_stream(stream, _string_products(spark, sf_dir), ingest.folder_sinks(out), checkpoint, until_now=False)
        query.processAllAvailable()
        query.stop()
    raw = sinks.read_batches(spark, f"{out}/behaviors", schemas.BEHAVIOR)
    sizes = raw.groupBy(sinks.BATCH).count()
    bounded = sizes.agg(F.max("count") <= -(-total // 5), F.count("*") >= 5).first()
    return raw.groupBy("product_id").agg(F.count("*").alias("n")).withColumn("bounded", F.lit(all(bounded)))


@query
def log_counts(spark, sf_dir):
    """Messages by topic from the offsets: an empty topic has 0, an unknown one -1."""
    partitions = record_log.offsets(spark, _log(spark, sf_dir, 2))
    names = ["behaviors", "empty", "unknown"]
    counts = [record_log.count_messages(partitions, name).select(F.lit(name).alias("topic"), "messages") for name in names]
    return counts[0].union(counts[1]).union(counts[2])


@query
def stream_vector_upsert_compacted(spark, sf_dir):
    """The same with the batches compacted between two runs of the stream."""
    out, checkpoint = session.shared_dir(spark, "upsert"), session.shared_dir(spark, "checkpoint")
    path = session.shared_dir(spark, "topic")
    points, dead = sinks.batch_folder(f"{out}/points"), sinks.batch_folder(f"{out}/dead_letters")
    records = rows.without_tombstones(messages(spark, sf_dir))
    for part in (0, 1):
        records.filter(F.col("offset") % 2 == part).select("value").repartition(4).write.mode("append").text(path)
        upsert.upsert_stream(topics.stream_lines(spark, path, 2), points, dead, checkpoint, until_now=True).awaitTermination()
        sinks.compact_points(spark, f"{out}/points", upsert.POINT)
    return _point_weights(sinks.read_points(spark, f"{out}/points", upsert.POINT))
