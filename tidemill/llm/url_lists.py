"""URL filtering by dated lists: every capture is judged by the entries in force when it was fetched.

Dated entries (list, host or parent domain, listed or not) become validity intervals: an entry
holds from its date until the next entry of the same list and domain. A capture asks for all
domains that end its host. An as-of join gives each question the entry in force at its time:
questions and entries are range-partitioned together by list, domain and time, and every
question takes the last entry before it, from its own partition or an earlier one. So a hot
host spans many tasks, and no pair of a capture with all entries of its host is ever made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.ranges import running
from tidemill.llm.words import col
from tidemill.session import stage


def host_of(url: Column) -> Column:
    """The lower-cased host; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, domain, listed, valid_from, valid_to`` from ``list, domain, listed, date`` (``valid_to`` null: still valid).

    Entries of one list, domain and date are one; it lists the domain if any of them does.
    Entries without a list, domain or date say nothing.
    """
    one = entries.where("list is not null and domain is not null and date is not null").groupBy(
        "list", F.lower("domain").alias("domain"), "date").agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
    following = Window.partitionBy("list", "domain").orderBy("date")
    return one.select("list", "domain", "listed", F.col("date").alias("valid_from"),
                      F.lead("date").over(following).alias("valid_to"))


def judged(captures: DataFrame, entries: DataFrame, id: str, url: str, time: str) -> DataFrame:
    """``id, host, n_entries, lists, blocked`` for each row of ``captures``.

    ``n_entries``: entries in force for the host or a domain above it at ``time``; ``lists``:
    the lists that hold one of them just then, sorted; ``blocked``: whether there is any. A
    capture without a host or time meets no entry; repeated rows get equal results; empty
    tables give no rows, or captures that no entry meets.
    """
    rows = stage(captures.select(F.monotonically_increasing_id().alias("row"), col(id).alias("id"),
                                 host_of(col(url)).alias("host"), col(time).alias("time")), "url-captures")
    valid = stage(entries.where("list is not null and domain is not null and date is not null").groupBy(
        "list", F.lower("domain").alias("domain"), "date").agg(
        F.max(F.coalesce("listed", F.lit(False))).alias("listed")), "url-entries")
    listed = valid.select("list", "domain").distinct()
    asked = rows.where("host is not null and time is not null").select(
        "row", "time", F.explode(domains_of(F.col("host"))).alias("domain")).join(listed, "domain")
    events = valid.select("list", "domain", F.col("date").alias("time"), F.lit(-1).cast("long").alias("row"),
                          F.struct("listed").alias("entry"))
    events = events.unionByName(asked.select("list", "domain", "time", "row", F.lit(None).cast(
        events.schema["entry"].dataType).alias("entry")))
    found = running(events, ["list", "domain"], ["time", "row"], lasts={"in_force": F.col("entry")})
    found = found.where("row >= 0 and in_force is not null").groupBy("row").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.sort_array(F.collect_set(F.when(F.col("in_force.listed"), F.col("list")))).alias("lists"))
    out = rows.join(found, "row", "left")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return out.select(F.col("id").alias(id), "host", F.coalesce("n_entries", F.lit(0).cast("long")).alias("n_entries"),
                      F.array_join(lists, ",").alias("lists"), (F.size(lists) > 0).alias("blocked"))


def _captures(spark, sf_dir: str) -> DataFrame:
    """The pages with a fetch time in 2020 (seconds), derived from their numbers: the table has none."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.withColumn("fetched", 1577836800 + F.col("page_id") * 7919 % 31536000)


def _entries(captures: DataFrame) -> DataFrame:
    """Dated lists derived from the captures: what a URL looks like puts its host on a list, or takes it off."""
    host, day = host_of(F.col("url")), F.floor(F.col("fetched") / 86400) * 86400
    parent = F.regexp_replace(host, r"^[^.]+\.", "")
    rules = [("tracking", host, True, "utm_source="), ("tracking", host, False, ".html"),
             ("paging", host, True, "page="), ("paging", host, False, "#top"),
             ("spam", parent, True, "/fr/"), ("spam", parent, False, "/de/")]
    made = F.array(*[F.when(F.contains("url", F.lit(sign)), F.struct(
        F.lit(name).alias("list"), domain.alias("domain"), F.lit(on).alias("listed"), day.alias("date")))
        for name, domain, on, sign in rules])
    return captures.select(F.explode(F.array_compact(made)).alias("e")).select("e.*")


def op6_temporal_lists(spark, sf_dir: str) -> DataFrame:
    captures = _captures(spark, sf_dir)
    return judged(captures, _entries(captures), "page_id", "url", "fetched")


OP6_SQL = r"""
WITH c AS (
  SELECT page_id, url, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host,
         1577836800 + page_id * 7919 % 31536000 AS fetched, row_number() OVER () AS r FROM pages),
h AS (SELECT *, regexp_replace(host, '^[^.]+\.', '') AS parent, fetched // 86400 * 86400 AS day FROM c),
e AS (
  SELECT 'tracking' AS list, host AS domain, true AS listed, day AS date FROM h WHERE contains(url, 'utm_source=')
  UNION ALL SELECT 'tracking', host, false, day FROM h WHERE contains(url, '.html')
  UNION ALL SELECT 'paging', host, true, day FROM h WHERE contains(url, 'page=')
  UNION ALL SELECT 'paging', host, false, day FROM h WHERE contains(url, '#top')
  UNION ALL SELECT 'spam', parent, true, day FROM h WHERE contains(url, '/fr/')
  UNION ALL SELECT 'spam', parent, false, day FROM h WHERE contains(url, '/de/')),
v AS (SELECT list, domain, date, bool_or(listed) AS listed FROM e WHERE domain IS NOT NULL GROUP BY ALL),
i AS (SELECT *, lead(date) OVER (PARTITION BY list, domain ORDER BY date) AS until FROM v),
m AS (
  SELECT h.r, i.list, i.listed FROM h JOIN i
  ON (h.host = i.domain OR ends_with(h.host, '.' || i.domain)) AND h.fetched >= i.date AND (i.until IS NULL OR h.fetched < i.until)),
g AS (SELECT r, count(*) AS n, coalesce(string_agg(DISTINCT list, ',' ORDER BY list) FILTER (WHERE listed), '') AS lists FROM m GROUP BY r)
SELECT page_id, host, coalesce(n, 0) AS n_entries, coalesce(lists, '') AS lists, coalesce(lists, '') <> '' AS blocked
FROM h LEFT JOIN g USING (r)
"""
