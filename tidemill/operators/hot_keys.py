"""FULL joins whose keys may be hot on either side.

Spark's adaptive execution splits a hot key of INNER and LEFT joins, never one of a FULL join, as no part of a split
can tell alone that a row has no partner. Counts by key tell it beforehand:

* a hot key that both sides hold has no row without a partner: its rows meet in an INNER join, those of the larger
  side dealt over salts by their content, those of the smaller side repeated for each salt;
* a hot key of one side alone has no partner at all: its rows go to the result unjoined;
* all other rows meet in the ordinary FULL join.

No row is dropped or counted twice, whatever is called hot. The list of hot keys is bounded: a key is hot only beyond a
``MOST_HOT``-th of all rows, so it can be broadcast at any size of the tables.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators._checks import ref
from tidemill.session import discard, staged

log = logging.getLogger(__name__)

#: So many keys at most can hold more than this part of the rows of both sides.
MOST_HOT = 1000
HOT_ROWS = 1_000_000
_NOT_HASHED = ("map<", "variant")


def key_counts(key: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """``key, n_left, n_right`` for each key of either side (nulls are one key); counted before the shuffle."""
    def side(df: DataFrame, l: int, r: int) -> DataFrame:
        return df.select(ref(key).alias("key"), F.lit(l).cast("long").alias("l"), F.lit(r).cast("long").alias("r"))

    return side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy("key").agg(
        F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def hot_keys(key: str, left: DataFrame, right: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key, n_left, n_right, pairs, salts`` of the hot keys: those with more than ``hot_rows`` rows on both sides
    together, and more than a ``MOST_HOT``-th of all rows. ``pairs`` is what the join makes of the key.

    Each side is read once, for its key column alone. At most ``MOST_HOT`` rows; none for two empty frames.
    """
    counts, place = staged(key_counts(key, left, right), "key-counts")
    try:
        total = counts.agg(F.coalesce(F.sum(F.col("n_left") + F.col("n_right")), F.lit(0))).first()[0]
        least = max(int(hot_rows), total // MOST_HOT, 1)
        found = counts.where(F.col("n_left") + F.col("n_right") > least).select(
            "key", "n_left", "n_right", (F.col("n_left") * F.col("n_right")).alias("pairs"),
            F.ceil(F.greatest("n_left", "n_right") / least).cast("int").alias("salts"))
        rows = found.collect()  # at most MOST_HOT
        return left.sparkSession.createDataFrame(rows, found.schema)
    finally:
        discard(left.sparkSession, place)


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's content: a task that runs again deals its rows as before."""
    names = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in _NOT_HASHED)]
    return F.xxhash64(*[ref(n) for n in names])


def full_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: DataFrame,
              null_safe: bool = True) -> DataFrame:
    """All columns of both frames, whose names are distinct, joined FULL on their keys; same rows as the plain join.

    ``hot`` comes from :func:`hot_keys`. Null keys match each other if ``null_safe``; otherwise they are without partners,
    hot or not. How many pairs two hot null keys make is logged before the join runs.
    """
    rows = hot.collect()
    if not null_safe:  # a null key has no partner: each side's nulls stand alone
        hot = hot.select("key", *[F.when(F.col("key").isNotNull(), F.col(c)).otherwise(F.lit(0).cast("long")).alias(c)
                                  for c in ("n_left", "n_right")], "salts")
    for r in rows:
        if r["key"] is None and null_safe and r["pairs"]:
            log.warning("full join: %d x %d rows with a null key make %d pairs", r["n_left"], r["n_right"], r["pairs"])

    def equal(a: str, b: str) -> Column:
        return F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) if null_safe else F.col(f"`{a}`") == F.col(f"`{b}`")

    if not rows:
        return left.join(right, equal(left_key, right_key), "full")

    marks = F.broadcast(hot.select(F.col("key").alias("_hk_key"), F.col("n_left").alias("_hk_left"),
                                   F.col("n_right").alias("_hk_right"), F.col("salts").alias("_hk_salts")))
    names = left.columns + right.columns

    def marked(df: DataFrame, key: str) -> DataFrame:
        return df.join(marks, ref(key).eqNullSafe(F.col("_hk_key")), "left").drop("_hk_key")

    l, r = marked(left, left_key), marked(right, right_key)
    common = F.col("_hk_salts").isNull()
    out = l.where(common).select(*[ref(c) for c in left.columns]).join(
        r.where(common).select(*[ref(c) for c in right.columns]), equal(left_key, right_key), "full")

    met = (F.col("_hk_left") > 0) & (F.col("_hk_right") > 0)
    alone = ~common & ~met
    if any(x["n_left"] == 0 or x["n_right"] == 0 or (x["key"] is None and not null_safe) for x in rows):
        def nulls(df: DataFrame) -> list[Column]:
            return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]

        out = out.unionByName(l.where(alone).select(*[ref(c) for c in left.columns], *nulls(right)))
        out = out.unionByName(r.where(alone).select(*nulls(left), *[ref(c) for c in right.columns]))
    if any(x["pairs"] and (null_safe or x["key"] is not None) for x in rows):
        larger = F.col("_hk_left") >= F.col("_hk_right")  # the left side is dealt, the right one repeated

        def salted(df: DataFrame, own: DataFrame, dealt: Column, name: str) -> DataFrame:
            one = F.array(F.pmod(_row_hash(own), F.col("_hk_salts")).cast("int"))
            every = F.sequence(F.lit(0), F.col("_hk_salts") - 1)
            return df.where(met).select(*[ref(c) for c in own.columns],
                                        F.explode(F.when(dealt, one).otherwise(every)).alias(name))

        pairs = salted(l, left, larger, "_hk_a").join(
            salted(r, right, ~larger, "_hk_b"), equal(left_key, right_key) & (F.col("_hk_a") == F.col("_hk_b")))
        out = out.unionByName(pairs.select(*[ref(c) for c in names]))
    return out
