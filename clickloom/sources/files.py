"""CSV and Parquet files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import CORRUPT, quoted, with_corrupt


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text."""
    return spark.read.csv(path, header=True)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, types inferred by a first pass over the data."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_quoted(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV whose quotes are escaped by doubling; types inferred unless a schema is given.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    if schema is None:
        return spark.read.csv(path, inferSchema=True, **options)
    return spark.read.csv(path, schema=schema, **options)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """CSV by schema, plus ``_corrupt_record`` with the whole line where it does not fit.

    With a header, columns are found by their names, in whatever order the file has them; columns that
    the schema does not name are left out, and a missing one is an error. All files below ``path`` must
    have one header, else reading fails. Without a header the order is the schema's.

    A line is judged as a whole, whatever is selected later: pruning is switched off.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    found = schema
    if header:
        names = spark.read.csv(path, header=True).columns
        missing = [name for name in schema.fieldNames() if name not in names]
        if missing and names:
            raise ValueError(f"{path} has no columns {missing}, only {names}")
        wanted = {one.name: one for one in schema.fields}
        found = T.StructType([wanted.get(name, T.StructField(name, T.StringType())) for name in names]) if names else schema
        # The header of every file is compared with the schema made from the first one's.
        reader = reader.option("enforceSchema", False)
    df = reader.schema(with_corrupt(found)).csv(path)
    # Spark refuses queries that read nothing but the corrupt lines, so the marker also names a column.
    first = quoted(schema.fieldNames()[0])
    marker = F.when(first.isNotNull() | F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).alias(CORRUPT)
    return df.select(*[quoted(name) for name in schema.fieldNames()], marker)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the marker column, and the quarantined rows with it."""
    corrupt = F.col(CORRUPT).isNotNull()
    return df.filter(~corrupt).drop(CORRUPT), df.filter(corrupt)


# Times in CSV keep their microseconds; Spark's own default cuts them to milliseconds.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str, quoted: bool = False, single_file: bool = False) -> None:
    """Replace ``path`` by CSV with a header; times are written down to the microsecond.

    ``quoted`` doubles quotes inside values. ``single_file`` sends all rows through one task; it is
    for small reports.
    """
    frame = df.coalesce(1) if single_file else df
    options = {**CSV_TIMES, **({"quote": '"', "escape": '"'} if quoted else {})}
    frame.write.mode("overwrite").options(header=True, **options).csv(path)


def write_parquet(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Replace ``path`` by Parquet; files hold at most the given number of rows, 0 for any."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)
