"""Topic records to a raw copy, an enriched extract and dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.rows import persisted
from clickloom.operators.saved import store_of
from clickloom.plans import enrichment
from clickloom.plans.enrichment import enrich_events, product_dimension
from clickloom.sources.files import CSV_TIMES
from clickloom.sources.topics import split_records, tag_records
from clickloom.streaming.sinks import BatchSink, batch_folder

# A stream sends the catalogue anew with every batch, and all of it through the driver each time, so what a
# single join may broadcast is too much here.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 8 << 20


def fits_broadcast(catalogue: DataFrame) -> bool:
    """Whether the catalogue is small enough to be sent with every batch."""
    return enrichment.fits_broadcast(catalogue, BROADCAST_ROWS, BROADCAST_BYTES)


@dataclass(frozen=True)
class IngestSinks:
    """Where the behaviours, the enriched events and the dead letters of a batch go."""

    raw: BatchSink
    enriched: BatchSink
    dead: BatchSink


def folder_sinks(root: str) -> IngestSinks:
    """Raw copy and dead letters as Parquet, the enriched extract as CSV, below ``root``."""
    return IngestSinks(
        raw=batch_folder(f"{root}/behaviors"),
        enriched=batch_folder(f"{root}/enriched", "csv", {"header": "true", **CSV_TIMES}),
        dead=batch_folder(f"{root}/dead_letters"),
    )


class Catalogue:
    """The catalogue of a stream, and whether it may be broadcast now.

    A catalogue in files is measured again when the sizes of its files change, which a listing tells; any other one is
    measured with every batch, since nothing else says how it has grown.
    """

    def __init__(self, products: DataFrame) -> None:
        self.products = products
        self.sizes: tuple[int, ...] | None = None
        self.fits = False

    def _file_sizes(self) -> tuple[int, ...] | None:
        sizes = []
        for file in sorted(self.products.inputFiles()):
            store, path = store_of(file)
            sizes.append(store.get_file_info(path).size or -1)
        return tuple(sizes) or None

    def may_broadcast(self) -> bool:
        sizes = self._file_sizes()
        if sizes is None or sizes != self.sizes:
            self.fits, self.sizes = fits_broadcast(product_dimension(self.products)), sizes
        return self.fits


def ingest_batch(
    records: DataFrame, products: DataFrame, sinks: IngestSinks, batch_id: int = 0, fits: bool | None = None
) -> None:
    """Ingest one bounded set of records. All sinks see the same records.

    ``fits`` tells whether the catalogue may be broadcast, if that has been measured.
    """
    with persisted(tag_records(records)) as tagged:
        good, dead = split_records(tagged)
        sinks.raw(good, batch_id)
        sinks.enriched(enrich_events(good, products, broadcast=True, fits=fits), batch_id)
        sinks.dead(dead, batch_id)


def ingest_stream(
    records: DataFrame,
    products: DataFrame,
    sinks: IngestSinks,
    checkpoint: str,
    until_now: bool = True,
) -> StreamingQuery:
    """Ingest a record stream; with ``until_now`` the query ends when it has caught up.

    The checkpoint keeps the progress: the next start goes on where this one ended. Whether the
    catalogue may be broadcast is known for every batch: see :class:`Catalogue`.
    """
    catalogue = Catalogue(products)

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, products, sinks, batch_id, catalogue.may_broadcast())

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if until_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
