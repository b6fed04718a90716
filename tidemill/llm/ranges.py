"""Running values inside a key whose rows may fill many partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import stage


def running(df: DataFrame, key: list[str], order: list[str], sums: dict[str, Column] | None = None,
            lasts: dict[str, Column] | None = None) -> DataFrame:
    """Add running sums, and last values that aren't null, of rows up to each row of its key.

    Rows are range-partitioned by key and order and stored, so a hot key spans many tasks;
    each partition's piece of a key is run through by itself and takes over what the earlier
    pieces end with (one row for each piece). ``order`` should be total within a key. The names
    ``part``, ``piece`` and ``from_*`` are used on the way.
    """
    sums, lasts = sums or {}, lasts or {}
    values = {**sums, **lasts}
    rows = df.select("*", *[c.alias(f"from_{n}") for n, c in values.items()])
    rows = stage(rows.repartitionByRange(*key, *order).withColumn("part", F.spark_partition_id()), "ranges")
    rows = rows.withColumn("piece", F.struct(*key))
    local = Window.partitionBy("part", "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at_end = rows.groupBy("part", "piece").agg(
        *[F.sum(f"from_{n}").alias(n) for n in sums],
        *[F.max_by(f"from_{n}", F.when(F.col(f"from_{n}").isNotNull(), F.struct(*order))).alias(n) for n in lasts])
    earlier = Window.partitionBy("piece").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = at_end.select(
        "part", "piece", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"ahead_{n}") for n in sums],
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"ahead_{n}") for n in lasts])
    out = rows.join(ahead, ["part", "piece"])
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.sum(f"from_{n}").over(local) + F.col(f"ahead_{n}")).alias(n) for n in sums],
        *[F.coalesce(F.last(f"from_{n}", ignorenulls=True).over(local), f"ahead_{n}").alias(n) for n in lasts])
