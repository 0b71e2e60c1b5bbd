"""Column expressions on scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of event times in the behaviour messages; the Z stands for UTC.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Fixed value: the nine attributes of one record, in this order.
COMBINED_ATTRIBUTES = [
    "user_id",
    "product_id",
    "name",
    "brand",
    "category_code",
    "price",
    "event_type",
    "event_time",
    "user_session",
]


def category_code(category: str = "category", kind: str = "type") -> Column:
    """``category.type``; a null part is left out, two null parts give ''."""
    return F.concat_ws(".", F.col(category), F.col(kind))


def combined_attributes(columns: list[str] = COMBINED_ATTRIBUTES) -> Column:
    """All attributes of a record as one blank-separated text; nulls are left out."""
    return F.concat_ws(" ", *[F.col(name) for name in columns])


def utc_label(time: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss UTC`` in any session zone; a null time leaves just ``UTC``."""
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.concat_ws(" ", F.timestamp_add("SECOND", seconds, epoch).cast("string"), F.lit("UTC"))


def parse_event_time(text: str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """The event time of a text; null where the text is malformed.

    A format that ends with a literal Z is read as UTC in any session zone, others in the session's.
    """
    if fmt.endswith("'Z'"):
        return F.try_to_timestamp(F.concat(F.col(text), F.lit(" UTC")), F.lit(f"{fmt} VV"))
    return F.try_to_timestamp(F.col(text), F.lit(fmt))


def indicator(event_type: str, wanted: str) -> Column:
    """1 where the event is of the wanted type, else 0."""
    return F.when(F.col(event_type) == wanted, 1).otherwise(0)


def share(part: str | Column, total: str | Column) -> Column:
    """``part / total``, or 0 where the total is not positive."""
    part = F.col(part) if isinstance(part, str) else part
    total = F.col(total) if isinstance(total, str) else total
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def plain_base64(column: str) -> Column:
    """Base64 in one line (Spark breaks it every 76 characters)."""
    return F.regexp_replace(F.base64(F.col(column)), "\r\n", "")


def point_id(*columns: str) -> Column:
    """A repeatable id from the business key: the same event always has the same id.

    The parts are separated by a control character and null has a mark of its own, so
    that shifted or missing parts give another id.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("\u0000")) for name in columns]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def event_text(name: str = "name", event_type: str = "event_type") -> Column:
    """``name event_type`` as the text to embed; a missing part is empty, the blank stays."""
    empty = F.lit("")
    return F.concat(F.coalesce(F.col(name), empty), F.lit(" "), F.coalesce(F.col(event_type), empty))
