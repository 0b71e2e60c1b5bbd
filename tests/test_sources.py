from __future__ import annotations

import json
from glob import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.sources import files, tables, topics, vector_sink
from tests.conftest import rows_of

PAIR = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def lines(path, *text):
    path.write_text("\n".join(text) + "\n")
    return str(path)


def test_csv_as_text_and_inferred(spark, tmp_path):
    path = lines(tmp_path / "x.csv", "a,b", "1,x", "2,")
    assert rows_of(files.read_csv_text(spark, path)) == [("1", "x"), ("2", None)]
    assert rows_of(files.read_csv_inferred(spark, path)) == [(1, "x"), (2, None)]


def test_csv_quarantine(spark, tmp_path):
    path = lines(tmp_path / "x.csv", "a,b", "1,x", "3", "2,y,EXTRA", "no,z")
    good, bad = files.split_corrupt(files.read_csv_checked(spark, path, PAIR))
    assert rows_of(good) == [(1, "x")]
    assert sorted(r[schemas.CORRUPT] for r in bad.collect()) == ["2,y,EXTRA", "3", "no,z"]
    assert good.count() == 1 and bad.count() == 3
    assert bad.select(schemas.CORRUPT).count() == 3


def test_csv_quarantine_sees_the_whole_line_when_columns_are_pruned(spark, tmp_path):
    path = lines(tmp_path / "x.csv", "a,b", "1,x", "2,y,EXTRA", "no,z")
    good, _ = files.split_corrupt(files.read_csv_checked(spark, path, PAIR))
    assert [r.b for r in good.select("b").collect()] == ["x"]


def test_checked_csv_goes_by_the_header(spark, tmp_path):
    path = lines(tmp_path / "x.csv", "c.d,b,a", "q,x,1", "q,y", "q,z,no")
    good, bad = files.split_corrupt(files.read_csv_checked(spark, path, PAIR))
    assert good.columns == ["a", "b"] and rows_of(good) == [(1, "x")]
    assert sorted(r[schemas.CORRUPT] for r in bad.collect()) == ["q,y", "q,z,no"]
    with pytest.raises(ValueError, match="no columns"):
        files.read_csv_checked(spark, lines(tmp_path / "y.csv", "a,c", "1,x"), PAIR)


def test_checked_csv_refuses_files_with_different_headers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines(tmp_path / "in" / "1.csv", "a,b", "1,x")
    lines(tmp_path / "in" / "2.csv", "b,a", "y,2")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv_checked(spark, str(tmp_path / "in"), PAIR).collect()


def test_csv_keeps_microseconds(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-01 03:04:05.123456' AS t, timestamp_ntz'2024-01-01 03:04:05.000001' AS n")
    files.write_csv(df, str(tmp_path / "t"))
    assert rows_of(spark.read.schema(df.schema).csv(str(tmp_path / "t"), header=True)) == rows_of(df)


def test_csv_quotes_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, "two\nlines"), (3, None)], PAIR)
    files.write_csv(df, str(tmp_path / "q"), quoted=True)
    assert rows_of(files.read_csv_quoted(spark, str(tmp_path / "q"), PAIR, multi_line=True)) == rows_of(df)
    files.write_csv(df.filter("a = 1"), str(tmp_path / "i"), quoted=True)
    assert rows_of(files.read_csv_quoted(spark, str(tmp_path / "i"))) == [(1, 'say "hi", twice')]


def test_csv_overwrites_and_writes_one_file_on_demand(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10, numPartitions=4)
    files.write_csv(df, path)
    files.write_csv(df, path, single_file=True)
    assert len(glob(path + "/part-*")) == 1 and files.read_csv_text(spark, path).count() == 10


def test_parquet_in_bounded_files(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(spark.range(10, numPartitions=1), path, max_records_per_file=3)
    assert len(glob(path + "/part-*")) == 4 and spark.read.parquet(path).count() == 10


def test_tables_by_connector(spark, tmp_path, caplog):
    options = {"path": str(tmp_path / "t")}
    tables.write_table(spark.createDataFrame([(1, "x")], PAIR), "json", options)
    tables.write_table(spark.createDataFrame([(2, "y")], PAIR), "json", options)
    assert rows_of(tables.read_table(spark, "json", options, ["b", "a"])) == [("x", 1), ("y", 2)]
    df = spark.range(3)
    assert tables.unless_empty(df, "numbers") is df
    assert tables.unless_empty(df.limit(0), "numbers") is None and "numbers is empty" in caplog.text


def test_connector_options():
    assert tables.collection_options("u", "d", "c") == {"uri": "u", "database": "d", "collection": "c"}
    full = tables.collection_options("u", "d", "c", "Sample", "product_id", True)
    assert (full["partitioner"], full["partitionKey"], full["inferSchema"]) == ("Sample", "product_id", "true")
    options = topics.topic_options("h:1", "t", max_per_trigger=100)
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "100",
    }


def test_reading_records_splits_off_dead_letters_and_tombstones(spark):
    good_json = json.dumps(
        {"user_session": "s", "user_id": 1, "product_id": "p", "event_type": "view", "event_time": "2024-01-01T00:00:00.000Z"}
    )
    bad_type = json.dumps({"user_id": "not a number"})
    values = [good_json, "{bad", None, bad_type, "[1]", '"text"', "{}"]
    records = spark.createDataFrame([(i, v.encode() if v else None) for i, v in enumerate(values)], "offset long, value binary")
    good, dead = topics.parse_records(records, keep=["offset"])
    assert good.columns == [*schemas.BEHAVIOR.fieldNames(), "offset"]
    found = {r.offset: r for r in good.collect()}
    assert set(found) == {0, 6} and found[0].user_id == 1 and found[0].name is None
    assert {r.offset: r.value for r in dead.collect()} == {1: "{bad", 3: bad_type, 4: "[1]", 5: '"text"'}


def test_records_round_trip_as_json(spark):
    df = spark.createDataFrame([("s", 1, None, "n", "view", None)], schemas.BEHAVIOR)
    encoded = topics.encode_records(df)
    assert json.loads(encoded.first().value) == {"user_session": "s", "user_id": 1, "name": "n", "event_type": "view"}
    good, dead = topics.parse_records(encoded)
    assert rows_of(good) == rows_of(df) and dead.count() == 0


def test_message_counts(spark):
    records = spark.createDataFrame([(0, 5), (0, 9), (1, 0)], "partition int, offset long")
    assert rows_of(topics.partition_counts(records)) == [(0, 5, 10, 5), (1, 0, 1, 1)]
    assert topics.message_count(records).first().messages == 6
    assert topics.message_count(records.limit(0)).first().messages == -1


def test_message_counts_by_topic(spark):
    rows = [("a", 0, 0), ("a", 0, 1), ("b", 0, 100), ("b", 0, 101)]
    records = spark.createDataFrame(rows, "topic string, partition int, offset long")
    assert rows_of(topics.topic_counts(records)) == [("a", 2), ("b", 2)]
    assert topics.message_count(records).first().messages == 4
    assert topics.message_count(records, "b").first().messages == 2
    assert topics.message_count(records, "c").first().messages == -1


def test_batch_read_and_write_of_a_topic_by_another_format(spark, tmp_path):
    path = {"path": str(tmp_path / "topic")}
    topics.write_topic(spark.createDataFrame([("x",)], "value string"), path, "text")
    assert topics.read_topic(spark, path, "text").first().value == "x"


def test_a_stream_by_another_format(spark, tmp_path):
    lines(tmp_path / "1.txt", "x", "y")
    records = topics.stream_topic(spark, {"path": str(tmp_path), "maxFilesPerTrigger": "1"}, "text")
    assert records.isStreaming and records.columns == ["value"]
    seen = []
    query = records.writeStream.foreachBatch(lambda batch, _: seen.extend(r.value for r in batch.collect()))
    query.trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == ["x", "y"]


def points(spark, n, dimension=4):
    return spark.range(0, n, 1, 3).select(
        F.concat(F.lit("id"), "id").alias("point_id"),
        F.array_repeat(F.col("id").cast("float"), dimension).alias("vector"),
        F.lit("n").alias("name"),
    )


def test_points_to_parquet_keep_the_contract(spark, tmp_path):
    path = {"path": str(tmp_path / "v")}
    vector_sink.write_points(points(spark, 5), options=path, dimension=4)
    vector_sink.write_points(points(spark, 2), options=path, mode="overwrite", dimension=4)
    assert spark.read.parquet(path["path"]).count() == 2
    with pytest.raises(PySparkException, match="bad vector"):
        vector_sink.write_points(points(spark, 5), options=path)


def test_points_through_a_client_in_batches(spark, tmp_path):
    vector_sink.register(spark)
    df = points(spark, 20)
    options = {
        **vector_sink.point_options(df, str(tmp_path), "col", batch_size=3),
        "client": "file_store:connect",
        "dimension": "4",
    }
    vector_sink.write_points(df, "client_points", options, "overwrite", dimension=4)
    assert json.loads((tmp_path / "col" / "config").read_text()) == {"size": 4, "distance": "Cosine"}
    requests = [json.load(open(name)) for name in glob(str(tmp_path / "col" / "*.json"))]
    assert max(len(request) for request in requests) == 3
    sent = {point[0]: point for request in requests for point in request}
    assert len(sent) == 20 and sent["id7"] == ["id7", [7.0] * 4, {"name": "n"}]
    with pytest.raises(PySparkException, match="store is down"):
        vector_sink.write_points(df, "client_points", {**options, "broken": "yes"}, dimension=4)


def test_a_request_may_be_larger_than_an_arrow_batch(spark, tmp_path):
    vector_sink.register(spark)
    df = points(spark, 50).coalesce(1)
    options = {**vector_sink.point_options(df, str(tmp_path), "col", batch_size=40), "client": "file_store:connect"}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        vector_sink.write_points(df, "client_points", options, dimension=4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(len(json.load(open(name))) for name in glob(str(tmp_path / "col" / "*.json"))) == [10, 40]


def test_a_failing_load_keeps_the_old_collection(spark, tmp_path):
    vector_sink.register(spark)
    df = points(spark, 5).coalesce(1)
    options = {**vector_sink.point_options(df, str(tmp_path), "col"), "client": "file_store:connect", "dimension": "4"}
    vector_sink.write_points(df, "client_points", options, "overwrite", dimension=4)
    before = sorted(glob(str(tmp_path / "*" / "*")))
    bad = df.withColumn("point_id", F.concat(F.lit("fails"), "point_id"))
    with pytest.raises(PySparkException, match="request refused"):
        vector_sink.write_points(bad, "client_points", options, "overwrite", dimension=4)
    assert sorted(glob(str(tmp_path / "*" / "*"))) == before


def test_point_options_carry_the_schema(spark):
    df = points(spark, 1)
    options = vector_sink.point_options(df, "u", "c", batch_size=vector_sink.BATCH_SIZE)
    assert T.StructType.fromJson(json.loads(options["schema"])) == df.schema
    assert options["embedding_field"] == "vector" and options["batch.size"] == "10000"
