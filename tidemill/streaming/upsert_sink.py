"""Keyed upsert as a ``foreachBatch`` sink.

Each micro-batch is reduced to one row per key (the latest by ``order_by``,
a partial aggregate, so a hot key is combined map-side), compared with the
stored rows of the keys it touches (the latest wins across batches too, in
whatever order the files arrive), then applied with
:func:`tidemill.sinks.upsert.upsert`. The upsert is idempotent — re-applying a
batch after a restart classifies its rows as ignored — so replays from the
streaming checkpoint do not change the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.sinks.upsert import UpsertReport, upsert


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the largest ``order_by``."""
    cols = [c for c in df.columns]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    latest = F.max_by(F.struct(*cols), order).alias("_tm_row")
    return df.groupBy(key).agg(latest).select("_tm_row.*")


def upsert_stream(stream: DataFrame, table: str, key: str, order_by: Sequence[str | Column],
                  checkpoint_location: str, partition_by: list[str] | None = None,
                  on_report: Callable[[int, UpsertReport], None] | None = None,
                  available_now: bool = False, buckets: int | None = None) -> StreamingQuery:
    """Start a streaming query that upserts every micro-batch into ``table``.

    ``checkpoint_location`` must be the same at every start: it holds what has been read.
    ``buckets`` buckets the table by key when the first batch creates it, so
    every later batch shuffles only its own rows.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        incoming = latest_per_key(batch, key, order_by)
        if spark.catalog.tableExists(table):
            # batches follow file discovery, not event time: compare with the
            # stored rows of the touched keys so an older row never wins
            stored = spark.table(table)
            touched = stored.join(incoming.select(key), stored[key].eqNullSafe(incoming[key]), "left_semi")
            incoming = latest_per_key(touched.unionByName(incoming), key, order_by)
        first = not spark.catalog.tableExists(table)
        rep = upsert(incoming, table, key, partition_by=partition_by, buckets=buckets if first else None)
        if on_report:
            on_report(epoch, rep)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
