"""Loading distinct rows chunk by chunk, so that a load that was stopped goes on where it ended.

Every row has a digest. The digests of all chunks so far are an index in ranges, and each range of each chunk has a
bitmap with a few bits a digest. A row of a new chunk whose bits are not all there is new; only the others are
compared with the index, and only with the ranges they fall into. A chunk counts when the ledger lists it, which is the
last thing written, so whatever a stopped load left behind is written over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.rows import persisted
from clickloom.operators.saved import remove, store_of

Sink = Callable[[DataFrame, int], None]

# Bits of a bitmap, and how many of them each digest sets.
_BITS, _HASHES = 32_768, 4
INDEX = "chunk int, range int, digest binary"
BLOOM = "chunk int, range int, bits binary"


def digest(df: DataFrame) -> Column:
    """A digest of all columns; null differs from any value, and the two zeros of a float are one."""

    def value(name: str) -> Column:
        column = F.col(f"`{name}`")
        return column + F.lit(0) if df.schema[name].dataType.typeName() in ("float", "double") else column

    parts = [F.coalesce(F.to_json(F.struct(value(name).alias("v"))), F.lit("")) for name in sorted(df.columns)]
    return F.unhex(F.sha2(F.to_json(F.array(*parts)), 256))


def _positions() -> Column:
    """The bits of a digest, as numbers from 1 on."""
    return F.array(*[F.pmod(F.xxhash64("digest", F.lit(n)), F.lit(_BITS)) + 1 for n in range(_HASHES)])


def _has_bit(position: Column) -> Column:
    """Whether a bit of ``bits`` is set, counted as by :func:`_positions`."""
    place = position - 1
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


class DistinctLoad:
    """A load into ``sink`` with its index and ledger below ``path``.

    With ``ranges`` ranges a bitmap is precise for some 3,000 digests a range and chunk; beyond that more rows are compared
    with the index, with the same result.
    """

    def __init__(self, spark: SparkSession, path: str, ranges: int = 256) -> None:
        self.spark, self.path, self.ranges = spark, path.rstrip("/"), ranges

    def committed(self) -> list[int]:
        """The chunks that are whole."""
        store, path = store_of(f"{self.path}/ledger")
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(int(info.base_name) for info in found if info.base_name.isdigit())

    def _commit(self, chunk: int) -> None:
        store, path = store_of(f"{self.path}/ledger")
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/.{chunk}.tmp") as out:
            out.write(b"")
        store.move(f"{path}/.{chunk}.tmp", f"{path}/{chunk}")

    def _read(self, what: str, schema: str, chunks: list[int]) -> DataFrame:
        if not chunks:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{what}/chunk={chunk}" for chunk in chunks]
        return self.spark.read.option("basePath", f"{self.path}/{what}").schema(schema).parquet(*paths)

    def new_rows(self, rows: DataFrame, chunks: list[int]) -> DataFrame:
        """Rows, each with ``digest`` and ``range``, that none of these chunks has."""
        bloom = self._read("bloom", BLOOM, chunks).groupBy("range").agg(F.bitmap_or_agg("bits").alias("bits"))
        # One bitmap of 4 KB for each range.
        marked = rows.join(F.broadcast(bloom), "range", "left")
        every = F.forall(_positions(), _has_bit)
        marked = marked.withColumn("_maybe", F.coalesce(every, F.lit(False))).drop("bits")
        with_index = marked.filter("_maybe")
        touched = [row["range"] for row in with_index.select("range").distinct().collect()]
        fresh = marked.filter("NOT _maybe")
        if not touched:
            return fresh.drop("_maybe")
        known = self._read("index", INDEX, chunks).filter(F.col("range").isin(touched)).select("range", "digest")
        return fresh.union(with_index.join(known, ["range", "digest"], "left_anti").select(*fresh.columns)).drop("_maybe")

    def load_chunk(self, rows: DataFrame, chunk: int, sink: Sink) -> bool:
        """Load what is new of a chunk; false if the chunk was in already."""
        chunks = self.committed()
        if chunk in chunks:
            return False
        own = rows.withColumn("digest", digest(rows)).dropDuplicates(["digest"])
        own = own.withColumn("range", F.pmod(F.xxhash64("digest"), F.lit(self.ranges)).cast("int"))
        with persisted(own) as kept, persisted(self.new_rows(kept, chunks)) as fresh:
            sink(fresh.drop("digest", "range"), chunk)
            for what in ("index", "bloom"):
                remove(f"{self.path}/{what}/chunk={chunk}")
            marks = fresh.select("range", "digest")
            marks.repartition("range").sortWithinPartitions("range", "digest").write.partitionBy("range").parquet(f"{self.path}/index/chunk={chunk}")
            bits = marks.select("range", F.explode(_positions()).alias("place"))
            bloom = bits.groupBy("range").agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
            bloom.coalesce(1).write.parquet(f"{self.path}/bloom/chunk={chunk}")
        self._commit(chunk)
        return True

    def load(self, chunks: Iterable[DataFrame], sink: Sink) -> int:
        """Load chunks, which must come in the same order each time; how many were loaded now."""
        return sum(self.load_chunk(rows, n, sink) for n, rows in enumerate(chunks))
