"""Test items that documents contain: size-partitioned MinHash containment search, exactly verified.

Items are partitioned by size. Those of a class, from 2 ** n up to twice as many shingles, have MinHash sketches
of one length: so many of their smallest shingle hashes. A sketch is looked up among all shingle hashes of a
document, however long that is (the containment form of MinHash: a long document's own sketch would hold nothing
of a short item). An item may lack only so many shingles, so of its sketch at least a known number must be found;
the sketch of each class is long enough for that number to be ``matches`` or more, for items of a single shingle
all. The search therefore loses no pair, and one short item changes nothing for the others.

Documents keep only hashes whose leading bits a sketch has, looked up in a bitmap; these meet the sketches in a
join, and for pairs with enough matches the shingles themselves are compared. Everything is built from functions
of Spark SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import stages

# What parts words: ASCII that is neither letter nor digit; texts are put in lower case first.
BETWEEN = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


@dataclass(frozen=True)
class Settings:
    """Words in a shingle, the share of an item's shingles that counts as containment, and sizes.

    ``matches`` is how many hashes of its sketch must be found at least for the largest items of a class; smaller
    ones need more. The bitmap has ``slots`` bits for a sketch hash, but no more than ``most_slots`` (beyond which it
    lets more hashes through). Tables of more than ``broadcast_rows`` rows of two numbers are not broadcast.
    """

    size: int = 5
    containment: float = 0.8
    matches: int = 2
    slots: int = 32
    most_slots: int = 1 << 18
    broadcast_rows: int = 500_000


def words(text: str) -> Column:
    """The words of a lower-cased text."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), BETWEEN), lambda word: word != "")


def _starts(size: int) -> Column:
    """Where shingles start; nowhere in a text without words.

    A filter on the words would be pushed below them and split each text a second time.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    return F.when(F.size("words") > 0, starts).otherwise(F.array().cast("array<int>"))


def _hashes(size: int) -> Column:
    """A hash of each shingle; words beyond the end are null and do not count."""
    return F.transform(_starts(size), lambda place: F.xxhash64(*[F.get("words", place + n) for n in range(size)]))


def _shingles(size: int) -> Column:
    """The distinct shingles as texts."""
    return F.array_distinct(F.transform(_starts(size), lambda place: F.concat_ws(" ", F.slice("words", place + 1, size))))


def _needed(shingles: Column, settings: Settings) -> Column:
    """How many of so many shingles a document must have."""
    return F.ceil(shingles * settings.containment - 1e-9)


def sketches(items: DataFrame, settings: Settings) -> DataFrame:
    """A row for each hash of each item's sketch: number, needed, enough, hash.

    ``items`` has number, words, shingles and needed. ``enough`` is how many hashes of the sketch a document has at least
    that contains the item: all but those that the item may lack.
    """
    shingles = F.size("shingles")
    largest = F.call_function("shiftleft", F.lit(2), F.floor(F.log2(shingles)).cast("int")) - 1
    length = F.least(shingles, largest - _needed(largest, settings) + settings.matches).cast("int")
    smallest = F.slice(F.array_sort(F.array_distinct(_hashes(settings.size))), 1, length)
    kept = items.select("number", "needed", (shingles - F.col("needed")).alias("spare"), smallest.alias("sketch"))
    enough = F.greatest(F.lit(1), F.size("sketch") - F.col("spare")).alias("enough")
    return kept.select("number", "needed", enough, F.explode("sketch").alias("hash"))


def _marked(tokens: DataFrame, settings: Settings):
    """A condition on a hash: whether the bitmap of the tokens has its leading bits.

    The bitmap is a literal of at most ``most_slots`` bits, so what is sent does not grow beyond that.
    """
    bits = max(10, min(tokens.count() * settings.slots, settings.most_slots).bit_length() - 1)
    slot = F.shiftrightunsigned("hash", 64 - bits)
    masks = tokens.groupBy(F.shiftright(slot, 6).alias("place")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("mask")
    )
    found = {row.place: row.mask for row in masks.collect()}
    bitmap = F.split(F.lit(",".join(str(found.get(place, 0)) for place in range(1 << (bits - 6)))), ",").cast("array<bigint>")

    def condition(hash_: Column) -> Column:
        mask = F.get(bitmap, F.shiftrightunsigned(hash_, 64 - bits + 6).cast("int"))
        return F.getbit(mask, F.shiftrightunsigned(hash_, 64 - bits).bitwiseAND(F.lit(63)).cast("int")) == 1

    return condition


def _small(df: DataFrame, settings: Settings) -> DataFrame:
    return F.broadcast(df) if df.count() <= settings.broadcast_rows else df


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Pairs of a document and an item that it contains: key, row, item, shared, total, containment.

    ``row`` is the hash of the document's text, by which rows without key or with a shared key can be told
    apart. A document contains an item if it has at least ``settings.containment`` of the item's shingles.

    Nulls: a null text has no words; items without words are contained nowhere. A null key or item id stays
    null in the result. An item of fewer words than a shingle is one shingle of all of them, which only a
    document of just these words has. Repeated documents are found each; items that share an id are items of
    their own and give a row each. A share of exactly ``containment`` counts. Texts are searched whole, however long. Empty
    tables give an empty result. Other columns of both tables play no part, whatever their names.
    """
    size = settings.size
    wanted = items.select(F.col(item).alias("item"), words(item_text).alias("words"))
    wanted = wanted.withColumn("shingles", _shingles(size)).filter(F.size("shingles") > 0)
    wanted = wanted.withColumn("needed", _needed(F.size("shingles"), settings))
    wanted = wanted.withColumn("number", F.xxhash64("item", "shingles")).dropDuplicates(["number"])
    wanted, _ = stages.written(wanted.select("number", "item", "words", "shingles", "needed"), "benchmark", rows=items.count())
    tokens = sketches(wanted, settings)

    hashed = documents.select(F.xxhash64(text).alias("row"), words(text).alias("words"))
    hashed = hashed.select("row", F.greatest(F.size("words") - size + 1, F.lit(1)).alias("places"), _hashes(size).alias("hashes"))
    marked = F.array_distinct(F.filter("hashes", _marked(tokens, settings)))
    exploded = hashed.select("row", "places", F.explode(marked).alias("hash"))
    # A document of fewer places than an item needs has no part in its class.
    matches = exploded.join(_small(tokens, settings), "hash").filter("places >= needed")
    counted = matches.groupBy("row", "number").agg(F.count(F.lit(1)).alias("matches"), F.first("enough").alias("enough"))
    candidates, _ = stages.written(counted.filter("matches >= enough").select("row", "number"), "candidates")

    texts = documents.select(F.col(key).alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    found = texts.join(_small(candidates.groupBy("row").agg(F.collect_set("number").alias("numbers")), settings), "row")
    found = found.select("key", "row", words("text").alias("words"), "numbers").select(
        "key", "row", _shingles(size).alias("own"), F.explode("numbers").alias("number")
    )
    checked = found.join(_small(wanted.select("number", "item", "shingles", "needed"), settings), "number")
    shared = F.size(F.array_intersect("shingles", "own"))
    result = checked.withColumn("shared", shared).filter("shared >= needed")
    total = F.size("shingles")
    return result.select("key", "row", "item", "shared", total.alias("total"), (F.col("shared") / total).alias("containment"))


def without_items(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings(), **names: str
) -> DataFrame:
    """The documents that contain none of the items; all their columns, whatever their names."""
    found = contained_items(documents, items, key, text, settings=settings, **names)
    gone, _ = stages.written(found.select(F.col("row").alias("hash")).distinct(), "contaminated")
    rows = documents.select(stages.wrapped(documents), F.xxhash64(text).alias("hash"))
    return rows.join(_small(gone, settings), "hash", "left_anti").select("row.*")
