"""Occurrence numbering whose groups may be of any size.

``row_number() over (partition by k order by o)`` sends every row of a key to one
task, so a key holding a third of the table would make one task do a third of
the work. Here one plan serves all sizes:

1. Rows are range-partitioned on ``(k, o)``: the bounds are sampled on the full
   sort key, so a hot key spans many partitions. They are stored once with
   ``checkpoint()``, because range bounds are sampled anew each time a plan runs.
2. Partitions are sorted before they are stored, so a row's place in its partition is known.
3. One aggregate gives the first place and the size of each partition's piece of a key, and a running sum over
   a key's pieces (one for each partition it spans) how many rows come before. A join adds that to the places.

The stored rows aren't shuffled again where the table of pieces, which is stored too, is under Spark's limit
for broadcasts (a few keys, whatever their size): they then keep contiguous ranges of ``(k, o)``, sorted
inside each partition. With very many keys it is joined by key and partition, and no key gathers more
than a partition's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import stage, work_dir

_PID, _KEY, _PLACE, _PIECE = "_tm_pid", "_tm_key", "_tm_place", "_tm_piece"


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in cols]


def _pieces(ranged: DataFrame) -> DataFrame:
    """``(pid, key, ahead)``: for each partition's piece of a key, what its rows' places in the partition are to be raised by."""
    pieces = ranged.groupBy(_PID, _KEY).agg(F.min(_PLACE).alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(_KEY).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return pieces.select(_PID, _KEY, (before - F.col("first") + 1).alias("ahead"))


def occurrence_number(df: DataFrame, by: Sequence[str | Column], order_by: Sequence[str | Column],
                      name: str, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of the row among rows with equal ``by``.

    ``order_by`` must be a total order within each group (add a unique
    tie-break). Null ``by`` values form one group of their own. With ``by``
    empty, ``name`` is the global position. Unless there are very many groups, rows come out in
    ranges of ``(by, order_by)``, sorted inside each partition.
    """
    work_dir(df.sparkSession)  # make sure a shared checkpoint folder is set
    keys, order = _as_cols(by), _as_cols(order_by)
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    width = [partitions] if partitions else []
    # the id holds the partition's number above bit 33, and below it the row's place
    # sorted by the keys themselves, which have a sort prefix, unlike a struct of them; the struct is made again, not stored
    sort = [*keys, *order] or [F.lit(0)]
    ranged = (df.repartitionByRange(*width, *sort).sortWithinPartitions(*sort)
              .withColumn(_PLACE, F.monotonically_increasing_id()).checkpoint(eager=True))
    ranged = ranged.withColumn(_KEY, key).withColumn(_PID, F.shiftright(_PLACE, 33)).withColumn(
        _PLACE, F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)))
    pieces = stage(_pieces(ranged).withColumnRenamed(_KEY, _PIECE), "pieces")  # stored, so that its size is known
    out = ranged.join(pieces, [F.col(_KEY).eqNullSafe(F.col(_PIECE)), ranged[_PID] == pieces[_PID]])
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name],
                      (F.col(_PLACE) + F.col("ahead")).cast("long").alias(name))
