"""Table schemas, and conforming a frame to one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# The fields of a behaviour message.
BEHAVIOR = T.StructType(
    [
        T.StructField("user_session", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)

# The columns of the dataset file; every one is text, the price too.
DATASET = _strings(
    "event_time",
    "event_type",
    "product_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "name",
)

# Points loaded from the dataset file.
POINT = T.StructType([*DATASET.fields, T.StructField("vector", T.ArrayType(T.FloatType()))])

# The columns of the catalogue file.
CATALOGUE_COLUMNS = [
    "productID",
    "name",
    "rating",
    "category",
    "brand",
    "type",
    "price",
    "image[0]",
    "new_description",
]


def quoted(name: str) -> Column:
    """A column by its literal name, which may hold dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the text column that receives unparsable records."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give ``df`` the columns, order and types of ``schema``.

    A missing column becomes null, and so does a value that does not fit its type.
    """
    present = set(df.columns)
    return df.select(
        *[
            (
                quoted(field.name).try_cast(field.dataType)
                if field.name in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema.fields
        ]
    )
