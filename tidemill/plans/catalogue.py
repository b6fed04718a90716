"""Registered queries: each runs one operator (or flow) over whole driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` is the same
result written as DuckDB SQL over the driver's tables. Queries that write do so
under the session's shared work folder, in a fresh location per call.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import LIST_SEPARATOR
from tidemill.operators import columns as C
from tidemill.operators import hot_keys as HK
from tidemill.operators import quality as Q
from tidemill.operators import relational as R
from tidemill.operators import sort as S
from tidemill.operators.holidays import in_day_order, merge_holidays
from tidemill.plans import flows
from tidemill.plans import runner as RN
from tidemill.plans import settings as ST
from tidemill.session import fresh_path, spread, work_dir
from tidemill.sinks import dictionary as DC
from tidemill.sinks import keyed as KT
from tidemill.sinks import summary as SM
from tidemill.sinks import tables as TB
from tidemill.sinks import upsert as UP
from tidemill.sinks.json import write_json
from tidemill.sinks.views import create_views
from tidemill.sources.calendar import create_calendar
from tidemill.sources.csv import extract_csv, with_row_order, write_csv
from tidemill.sources.html import holiday_rows
from tidemill.sources.json import extract_json
from tidemill.sources.json_variant import extract_json_variant
from tidemill.streaming import latest_per_key, upsert_stream

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
AS_OF = dt.date(2025, 6, 30)  # fixed load date for the metadata queries


def query(name: str, sql: str | None = None):
    def reg(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return reg


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_database(spark: SparkSession) -> str:
    db = f"tm_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work_dir(spark)}/db/{db}'")
    return db


def ymd(c) -> F.Column:
    return F.date_format(c, "yyyyMMdd")


# ============================================================ sources
@query("extract_csv", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def q_extract_csv(spark, sf):
    path = fresh_path(spark, "csv")
    write_csv(table(spark, sf, "customer"), path)
    return extract_csv(spark, path, ";")


@query("extract_json", """
SELECT event_id, user_id, event_type, value FROM events""")
def q_extract_json(spark, sf):
    path = fresh_path(spark, "json")
    write_json(table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path)
    return extract_json(spark, path, {"event_id": "int", "user_id": "int", "event_type": "str",
                                      "value": "float"}, multi_line=False)


@query("json_flatten", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events""")
def q_json_flatten(spark, sf):
    path = fresh_path(spark, "json")
    ev = table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").alias("props"))
    write_json(ev, path)
    return extract_json(spark, path, {"event_id": "int", "props.k": "int"}, multi_line=False)


@query("json_list_join", f"""
SELECT user_id, array_to_string(list_sort(list_distinct(list(event_type))), '{LIST_SEPARATOR}') AS types
FROM events GROUP BY user_id""")
def q_json_list_join(spark, sf):
    path = fresh_path(spark, "json")
    per_user = (table(spark, sf, "events").groupBy("user_id")
                .agg(F.array_sort(F.collect_set("event_type")).alias("types")))
    write_json(per_user, path)
    return extract_json(spark, path, {"user_id": "int", "types": "str"}, multi_line=False)


@query("json_variant_flatten", f"""
SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'O{LIST_SEPARATOR}open' END AS "info.status",
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS "info.price.total",
       CASE WHEN o_orderstatus = 'O' THEN 'EUR' END AS "info.price.currency",
       CASE WHEN o_orderstatus = 'P' THEN true END AS pending FROM orders""")
def q_json_variant_flatten(spark, sf):
    """Records of three nested shapes: a field that is text, a list or null, an object that some lack, numbers as text."""
    path = fresh_path(spark, "json")
    o, key, total = table(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_totalprice")
    done = F.struct(key.alias("id"), F.struct(F.lit("F").alias("status"), F.struct(total.alias("total")).alias("price")).alias("info"))
    price = F.struct(total.cast("string").alias("total"), F.lit("EUR").alias("currency"))
    open_ = F.struct(key.cast("string").alias("id"), F.struct(
        F.array(F.lit("O"), F.lit("open")).alias("status"), price.alias("price")).alias("info"))
    pending = F.struct(key.alias("id"), F.struct(F.lit(None).cast("string").alias("status")).alias("info"), F.lit(True).alias("pending"))
    keep = {"ignoreNullFields": "false"}
    status = F.col("o_orderstatus")
    o.select(F.when(status == "F", F.to_json(done, keep)).when(status == "O", F.to_json(open_, keep)).otherwise(
        F.to_json(pending, keep)).alias("value")).write.text(path)
    return extract_json_variant(spark, path, {"id": "int", "info.status": "str", "info.price.total": "float",
                                              "info.price.currency": "str", "pending": "bool"})


@query("json_digits_date", """
SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y') AS day FROM orders""")
def q_json_digits_date(spark, sf):
    path = fresh_path(spark, "json")
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("day"))
    write_json(o, path)
    return extract_json(spark, path, {"o_orderkey": "int", "day": "date"}, multi_line=False)


@query("csv_ragged_rows", """
SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment
FROM customer""")
def q_csv_ragged_rows(spark, sf):
    """Rows that end early: two segments' customers lack one or two of the four fields; names are quoted and hold the delimiter."""
    path = fresh_path(spark, "csv")
    c = table(spark, sf, "customer")
    row = F.concat_ws(";", "c_custkey", F.concat(F.lit('"'), "c_name", F.lit('"')),
                      F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")),
                      F.when(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")))
    (c.select(row.alias("c_custkey;c_name;c_acctbal;c_mktsegment")).write.option("header", True)
     .option("sep", "\u0001").option("quote", "").csv(path))
    return extract_csv(spark, path, ";")


@query("csv_declared_schema", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
FROM customer""")
def q_csv_declared_schema(spark, sf):
    """Declared schema (no inference pass); a missing-value token becomes null."""
    path = fresh_path(spark, "csv")
    c = table(spark, sf, "customer")
    write_csv(c.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("NA"))
                           .otherwise(F.col("c_mktsegment"))), path)
    return extract_csv(spark, path, ";", schema=c.schema)


@query("cat_to_num_file_order", """
WITH f AS (SELECT c_mktsegment, min(c_custkey) AS k FROM customer GROUP BY c_mktsegment),
r AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY k) AS BIGINT) AS code FROM f)
SELECT c.c_custkey, c.c_mktsegment, r.code AS c_mktsegment_num
FROM customer c JOIN r USING (c_mktsegment)""")
def q_cat_to_num_file_order(spark, sf):
    """Codes by first appearance in file order: the file is written in key
    order and read back with the file row order attached after the scan."""
    path = fresh_path(spark, "csv")
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_mktsegment").orderBy("c_custkey"), path)
    df = with_row_order(extract_csv(spark, path, ";"))
    return C.category_codes(df, "c_mktsegment", order_by=["_row"]).drop("_row")


def _order_pages(spark, sf) -> DataFrame:
    """One stored page per order: a holiday table built from the order's fields.

    Row 0 has three cells (skipped), row 1 is the holiday: its type comes from
    the priority (urgent = public, high = regional, else an observance, which
    is dropped) and finished orders carry a fifth comment cell.
    """
    o = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"))
    htype = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Public Holiday"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Regional Holiday"))
             .otherwise(F.lit("Observance")))
    comment = F.when(F.col("o_orderstatus") == "F",
                     F.concat(F.lit("<td><span>Status&nbsp;"), F.col("o_orderstatus"), F.lit("</span></td>")))
    html = F.concat(
        F.lit('<html><body><h1>Holidays</h1><table class="country-table wide"><thead><tr><th>Day</th>'
              '<th>Date</th><th>Name</th><th>Type</th></tr></thead><tbody>'),
        F.lit("<tr><td>x</td><td>y</td><td>z</td></tr>"),
        F.lit('<tr class="row"><td>Day</td><td><time>'), F.date_format("o_orderdate", "MMM dd"),
        F.lit("</time></td><td><a href='#'>Order "), F.col("o_orderkey").cast("string"),
        F.lit(" &amp; Jos&eacute; &#243; D&#xED;a</a></td><td>"), htype, F.lit("</td>"), F.coalesce(comment, F.lit("")),
        F.lit("</tr></tbody></table></body></html>"))
    return o.select(F.col("o_custkey").cast("string").alias("region"),
                    F.year("o_orderdate").alias("year"), html.alias("html"))


@query("html_holiday_rows", """
SELECT strftime(o_orderdate, '%d-%m-%Y') AS "Day",
       'Order ' || CAST(o_orderkey AS VARCHAR) || ' & José ó Día' AS "Name",
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Nacional' ELSE 'Regional' END AS "Type",
       CAST(o_custkey AS VARCHAR) AS "Region",
       CASE WHEN o_orderstatus = 'F' THEN 'Status ' || o_orderstatus ELSE '' END AS "Comments",
       1 AS row_pos
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_html_holiday_rows(spark, sf):
    return holiday_rows(_order_pages(spark, sf)).withColumn("row_pos", F.col("row_pos").cast("int"))


@query("html_loose_rows", """
SELECT strftime(o_orderdate, '%d-%m-%Y') AS "Day",
       'Order ' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderstatus = 'F' THEN ' (' || o_clerk || ' 1)' ELSE '' END AS "Name",
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Nacional' ELSE 'Regional' END AS "Type",
       CAST(o_custkey AS VARCHAR) AS "Region", CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE '' END AS "Comments",
       1 AS row_pos
FROM (SELECT *, 'c' || o_orderpriority AS o_clerk FROM orders) WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_html_loose_rows(spark, sf):
    """Pages without end tags of cells and rows, with a table inside a cell, a comment and a second table."""
    o = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"))
    kind = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Public Holiday"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Regional Holiday")).otherwise(F.lit("Observance")))
    inner = F.when(F.col("o_orderstatus") == "F", F.concat(
        F.lit("<table><tbody><tr><td> (c"), F.col("o_orderpriority"), F.lit("<td> 1)</table>")))
    html = F.concat(
        F.lit("<TABLE class='wide country-table'><thead><tr><th>Day<th>Date<tbody><!-- <tr><td>1<td>2<td>3<td>4 -->"
              "<tr><td>x<td>y<td>z\n<TR class=row><TD>Day<TD>"), F.date_format("o_orderdate", "MMM dd"),
        F.lit("<td>Order "), F.col("o_orderkey").cast("string"), F.coalesce(inner, F.lit("")),
        F.lit("<td><b>"), kind, F.lit("</b>"), F.when(F.col("o_orderstatus") == "O", F.lit("<td>open")).otherwise(F.lit("")),
        F.lit("</tbody><tfoot><tr><td>1<td>2<td>3<td>Public Holiday</table><table><tr><td>1<td>2<td>3<td>Public Holiday"))
    pages = o.select(F.col("o_custkey").cast("string").alias("region"), F.year("o_orderdate").alias("year"), html.alias("html"))
    return holiday_rows(pages).withColumn("row_pos", F.col("row_pos").cast("int"))


def _date_range(df: DataFrame, col: str) -> tuple[str, str]:
    r = df.agg(F.min(col).alias("a"), F.max(col).alias("b")).first()
    return r["a"].strftime("%d-%m-%Y"), r["b"].strftime("%d-%m-%Y")


CALENDAR_SQL = """
SELECT CAST(d AS DATE) AS "Day", CAST(isodow(d) AS BIGINT) AS "Week_day",
  CASE isodow(d) WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes' WHEN 3 THEN 'Miércoles' WHEN 4 THEN 'Jueves'
    WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sábado' ELSE 'Domingo' END AS "Week_day_name",
  CAST(month(d) AS BIGINT) AS "Month",
  CASE month(d) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril'
    WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto'
    WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END
    AS "Month_name",
  CAST(year(d) AS BIGINT) AS "Year"
FROM (SELECT unnest(generate_series(CAST({lo} AS DATE), CAST({hi} AS DATE), INTERVAL 1 DAY)) AS d
      FROM {src})"""


@query("create_calendar", CALENDAR_SQL.format(lo="min(o_orderdate)", hi="max(o_orderdate)", src="orders"))
def q_create_calendar(spark, sf):
    start, end = _date_range(table(spark, sf, "orders"), "o_orderdate")
    return create_calendar(spark, start, end)


# ============================================================ column operators
@query("rename_col", """
SELECT p_partkey AS part_id, p_name AS name, p_brand, p_type AS kind, p_size, p_retailprice AS price
FROM part""")
def q_rename_col(spark, sf):
    return C.rename_columns(table(spark, sf, "part"),
                            {"p_partkey": "part_id", "p_name": "name", "p_type": "kind",
                             "p_retailprice": "price"})


@query("cat_to_num_auto", """
WITH p AS (SELECT p_partkey, nullif(p_type, 'STANDARD') AS p_type FROM part),
f AS (SELECT p_type, min(p_partkey) AS k FROM p WHERE p_type IS NOT NULL GROUP BY p_type),
r AS (SELECT p_type, CAST(row_number() OVER (ORDER BY k) AS BIGINT) AS code FROM f)
SELECT p.p_partkey, p.p_type, coalesce(r.code, 0) AS p_type_num FROM p LEFT JOIN r USING (p_type)""")
def q_cat_to_num_auto(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("STANDARD")).alias("p_type"))
    return C.category_codes(p, "p_type", order_by=["p_partkey"])


@query("category_mapping", """
WITH f AS (SELECT p_type, min(p_partkey) AS k FROM part GROUP BY p_type)
SELECT p_type AS value, CAST(row_number() OVER (ORDER BY k) AS BIGINT) AS code FROM f""")
def q_category_mapping(spark, sf):
    return C.category_mapping(table(spark, sf, "part"), "p_type", ["p_partkey"])


@query("cat_to_num_grows", """
WITH f AS (SELECT p_type, min(p_partkey) AS k FROM part GROUP BY p_type),
r AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type <= 'M', k) AS BIGINT) AS code FROM f)
SELECT p.p_partkey, p.p_type, r.code AS p_type_num FROM part p JOIN r USING (p_type)""")
def q_cat_to_num_grows(spark, sf):
    """Two loads with one dictionary: the first brings the types beyond M, the second all of them."""
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    codes = f"{fresh_database(spark)}.part_types"
    DC.grow(p.where(F.col("p_type") > "M"), "p_type", codes, ["p_partkey"])
    return DC.coded(p, "p_type", codes, ["p_partkey"])


@query("cat_unknown_values", """
SELECT p_type AS value, count(*) AS rows FROM part WHERE p_type <= 'M' GROUP BY p_type""")
def q_cat_unknown_values(spark, sf):
    """What a dictionary of an earlier load lacks."""
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    codes = DC.grow(p.where(F.col("p_type") > "M"), "p_type", f"{fresh_database(spark)}.part_types", ["p_partkey"])
    return DC.unknown_values(p, "p_type", codes)


PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}


@query("cat_to_num_map", """
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
       WHEN '5-LOW' THEN 5 ELSE 0 END AS BIGINT) AS o_orderpriority_num
FROM orders""")
def q_cat_to_num_map(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"))
    return C.category_codes(o, "o_orderpriority", cat_map=PRIORITY_CODES)


@query("fill_nulls", """
SELECT c_custkey,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_nationkey = 24 THEN 0 ELSE c_nationkey END AS c_nationkey,
  coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 0) AS c_acctbal
FROM customer""")
def q_fill_nulls(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    c = C.fill_nulls(c, "c_mktsegment", ["BUILDING"])
    c = C.fill_nulls(c, "c_nationkey", [24])
    return C.fill_nulls(c, "c_acctbal")


@query("fill_count", """
SELECT count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment IN ('BUILDING', 'MACHINERY')) AS replaced
FROM customer""")
def q_fill_count(spark, sf):
    return C.fill_count(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("parse_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def q_parse_date(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", ymd("o_orderdate").alias("o_orderdate"))
    return C.parse_date(o, "o_orderdate", "YYYYMMDD")


@query("parse_date_2digit", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def q_parse_date_2digit(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit(" "), F.date_format("o_orderdate", "yyMMdd")).alias("o_orderdate"))
    return C.parse_date(o, "o_orderdate", "YYMMDD")


def _broken_dates(spark, sf) -> DataFrame:
    """Order dates as YYYYMMDD text, damaged by business rule: low priority loses
    a digit, pending orders get a letter O for 0, urgent finished orders day 32."""
    o = table(spark, sf, "orders")
    t = ymd("o_orderdate")
    bad = (F.when(F.col("o_orderpriority") == "5-LOW", F.substring(t, 1, 7))
           .when(F.col("o_orderstatus") == "P", F.regexp_replace(t, "0", "O"))
           .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"),
                 F.concat(F.substring(t, 1, 6), F.lit("32")))
           .otherwise(t))
    return o.select("o_orderkey", bad.alias("day"))


@query("date_violations", """
WITH t AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN substr(strftime(o_orderdate, '%Y%m%d'), 1, 7)
                       WHEN o_orderstatus = 'P' THEN replace(strftime(o_orderdate, '%Y%m%d'), '0', 'O')
                       WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
                         THEN substr(strftime(o_orderdate, '%Y%m%d'), 1, 6) || '32'
                       ELSE strftime(o_orderdate, '%Y%m%d') END AS v FROM orders),
c AS (SELECT v, length(v) <> 8 AS l, regexp_matches(v, '\\D') AS d,
             try_strptime(v, '%Y%m%d') IS NULL AS p FROM t)
SELECT count(*) FILTER (WHERE l) AS bad_length, min(v) FILTER (WHERE l) AS bad_length_sample,
       count(*) FILTER (WHERE NOT l AND d) AS non_digit, min(v) FILTER (WHERE NOT l AND d) AS non_digit_sample,
       count(*) FILTER (WHERE NOT l AND NOT d AND p) AS unparseable,
       min(v) FILTER (WHERE NOT l AND NOT d AND p) AS unparseable_sample
FROM c""")
def q_date_violations(spark, sf):
    return C.date_violation_counts(_broken_dates(spark, sf), "day", "YYYYMMDD")


def _text_orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished"),
        F.col("o_custkey").cast("int").alias("o_custkey"))


CONFORM_TYPES = {"o_orderkey": "int", "o_custkey": "int", "o_orderdate": "datetime",
                 "o_totalprice": "float", "priority": "int", "o_orderpriority": "int",
                 "finished": "bool"}


@query("conform_types", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_totalprice,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
       CAST(NULL AS BIGINT) AS o_orderpriority, o_orderstatus = 'F' AS finished
FROM orders""")
def q_conform_types(spark, sf):
    return Q.conform_types(_text_orders(spark, sf), CONFORM_TYPES)


@query("conform_report", """
SELECT * FROM (VALUES
  ('o_orderkey', 'string', 'bigint', 0),
  ('o_custkey', 'int', 'bigint', 0),
  ('o_orderdate', 'string', 'timestamp_ntz', 0),
  ('o_totalprice', 'string', 'double', 0),
  ('priority', 'string', 'bigint', 0),
  ('finished', 'int', 'boolean', 0)) AS v("column", from_type, to_type, nulled)
UNION ALL
SELECT 'o_orderpriority', 'string', 'bigint', count(*) FROM orders""")
def q_conform_report(spark, sf):
    return Q.conform_report(_text_orders(spark, sf), CONFORM_TYPES)


@query("surrogate_key", """
SELECT strftime(o_orderdate, '%Y%m%d')
         || CAST(row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS VARCHAR) AS "Index",
       o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day
FROM orders""")
def q_surrogate_key(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", ymd("o_orderdate").alias("day"))
    return C.surrogate_key(o, "day", ["o_orderkey"])


@query("surrogate_key_invalid", """
WITH t AS (SELECT CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                       ELSE o_orderpriority END AS v FROM orders)
SELECT v AS value, count(*) AS rows FROM t
WHERE NOT regexp_full_match(v, '[0-9-]*[0-9][0-9-]*') GROUP BY v""")
def q_surrogate_key_invalid(spark, sf):
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.col("o_orderpriority")).alias("v"))
    return C.key_violations(o, "v")


@query("unique_suffix", """
SELECT p_partkey,
  CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1 THEN p_name
       ELSE p_name || ' - ' || CAST(row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS VARCHAR)
  END AS p_name
FROM part""")
def q_unique_suffix(spark, sf):
    return C.unique_suffix(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"])


# ============================================================ joins
def _join_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Customers × nations on nation key. Customers of nation 24 carry an unknown
    (null) key; nation 0 is listed under an unknown (null) key. So nation-0
    customers find no nation, unknown-key customers match the unknown nation
    (null = null), nation 24 finds no customer, and ``name`` clashes."""
    left = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("name"),
        F.nullif("c_nationkey", F.lit(24)).alias("nationkey"), "c_acctbal")
    right = table(spark, sf, "nation").select(
        F.nullif("n_nationkey", F.lit(0)).alias("nationkey"), F.col("n_name").alias("name"), "n_regionkey")
    return left, right


JOIN_SQL = """
WITH l AS (SELECT c_custkey, c_name AS name, nullif(c_nationkey, 24) AS nationkey, c_acctbal FROM customer),
r AS (SELECT nullif(n_nationkey, 0) AS nationkey, n_name AS name, n_regionkey FROM nation)
SELECT {key} AS nationkey, l.c_custkey, l.name AS name_x, l.c_acctbal, r.name AS name_y, r.n_regionkey
FROM l {how} JOIN r ON l.nationkey IS NOT DISTINCT FROM r.nationkey"""


@query("join_inner", JOIN_SQL.format(key="l.nationkey", how="INNER"))
def q_join_inner(spark, sf):
    return R.join_tables("nationkey", "INNER", *_join_sides(spark, sf))


@query("join_left", JOIN_SQL.format(key="l.nationkey", how="LEFT"))
def q_join_left(spark, sf):
    return R.join_tables("nationkey", "LEFT", *_join_sides(spark, sf))


@query("join_full", JOIN_SQL.format(key="coalesce(l.nationkey, r.nationkey)", how="FULL"))
def q_join_full(spark, sf):
    return R.join_tables("nationkey", "FULL", *_join_sides(spark, sf))


def _unknown_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders by customer, where finished orders (about half) lost theirs, and customers with one more row for unknown ones.

    So one null key holds about half of the orders and has one partner; many customers have no order left.
    """
    left = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("custkey"), "o_orderkey", "o_totalprice")
    right = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey")
    unknown = right.agg(F.max("c_name")).select(F.lit(None).cast("long").alias("custkey"), F.lit("unknown").alias("c_name"),
                                                F.lit(None).cast(right.schema["c_nationkey"].dataType).alias("c_nationkey"))
    return left, right.unionByName(unknown)


UNKNOWN_SQL = """
WITH l AS (SELECT CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS custkey, o_orderkey, o_totalprice FROM orders),
r AS (SELECT c_custkey AS custkey, c_name, c_nationkey FROM customer UNION ALL SELECT NULL, 'unknown', NULL)"""


@query("join_full_hot", UNKNOWN_SQL + """
SELECT coalesce(l.custkey, r.custkey) AS custkey, o_orderkey, o_totalprice, c_name, c_nationkey
FROM l FULL JOIN r ON l.custkey IS NOT DISTINCT FROM r.custkey""")
def q_join_full_hot(spark, sf):
    return R.join_tables("custkey", "FULL", *_unknown_sides(spark, sf), hot_rows=500)


@query("join_full_hot_lonely", UNKNOWN_SQL + """
SELECT coalesce(l.custkey, r.custkey) AS custkey, o_orderkey, o_totalprice, c_name, c_nationkey
FROM l FULL JOIN (SELECT * FROM r WHERE custkey IS NOT NULL) r ON l.custkey = r.custkey""")
def q_join_full_hot_lonely(spark, sf):
    """The hot key has no partner."""
    left, right = _unknown_sides(spark, sf)
    return R.join_tables("custkey", "FULL", left, right.where("custkey is not null"), hot_rows=500)


@query("join_hot_keys", UNKNOWN_SQL + """,
k AS (SELECT custkey, 1 AS a, 0 AS b FROM l UNION ALL SELECT custkey, 0, 1 FROM r),
c AS (SELECT custkey, CAST(sum(a) AS BIGINT) AS n_left, CAST(sum(b) AS BIGINT) AS n_right FROM k GROUP BY custkey),
t AS (SELECT greatest(500, CAST(sum(n_left + n_right) AS BIGINT) // 1000) AS least FROM c)
SELECT custkey AS key, n_left, n_right, n_left * n_right AS pairs,
       CAST(ceil(greatest(n_left, n_right) / least) AS INTEGER) AS salts FROM c, t WHERE n_left + n_right > least""")
def q_join_hot_keys(spark, sf):
    """What a FULL join makes of its hot keys, known before it runs."""
    return HK.hot_keys("custkey", *_unknown_sides(spark, sf), hot_rows=500)


# ============================================================ aggregation
@query("group_by_all", """
WITH o AS (SELECT o_custkey, o_totalprice, o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS o_year,
                  o_orderkey AS key_avg,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS urgent_price FROM orders)
SELECT o_custkey, round(coalesce(sum(o_totalprice), 0), 2) AS o_totalprice, max(o_orderkey) AS o_orderkey,
       min(o_year) AS o_year, round(avg(key_avg), 4) AS key_avg,
       round(coalesce(sum(urgent_price), 0), 2) AS urgent_price
FROM o GROUP BY o_custkey""")
def q_group_by_all(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_custkey", "o_totalprice", "o_orderkey", F.year("o_orderdate").cast("long").alias("o_year"),
        F.col("o_orderkey").alias("key_avg"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).alias("urgent_price"))
    g = R.group_by(o, "o_custkey", {"o_totalprice": "SUM", "o_orderkey": "MAX", "o_year": "MIN",
                                    "key_avg": "AVG", "urgent_price": "sum"})
    return g.select("o_custkey", *[F.round(c, 2).alias(c) for c in ("o_totalprice", "urgent_price")],
                    F.round("key_avg", 4).alias("key_avg"), "o_orderkey", "o_year")


@query("group_by_first_last", """
WITH o AS (SELECT o_custkey, o_orderkey,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END AS s FROM orders)
SELECT o_custkey, arg_min(s, o_orderkey) FILTER (WHERE s IS NOT NULL) AS first_status,
       arg_max(s, o_orderkey) FILTER (WHERE s IS NOT NULL) AS last_status
FROM o GROUP BY o_custkey""")
def q_group_by_first_last(spark, sf):
    s = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus"))
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", s.alias("first_status"),
                                          s.alias("last_status"))
    return R.group_by(o, "o_custkey", {"first_status": "FIRST", "last_status": "LAST"}, order_by=["o_orderkey"])


def _holiday_entries(spark, sf) -> DataFrame:
    """Events read as holiday entries: the day, the event type as the name, the
    event's ``k`` property as the region; a large error is national; signups
    carry a comment. Names (5), regions and comments (100 each) come from small
    domains, so each merged day stays small at any scale."""
    e = table(spark, sf, "events")
    return e.select(
        F.date_format("ts", "dd-MM-yyyy").alias("Day"),
        F.col("event_type").alias("Name"),
        F.when((F.col("event_type") == "error") & (F.col("value") >= 300), F.lit("Nacional"))
        .otherwise(F.lit("Regional")).alias("Type"),
        F.concat(F.lit("R"), F.get_json_object("props", "$.k")).alias("Region"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("k"), F.get_json_object("props", "$.k")))
        .otherwise(F.lit("")).alias("Comments"),
        "ts", "event_id")


HOLIDAY_SQL = """
WITH e AS (
  SELECT strftime(ts, '%d-%m-%Y') AS d, event_type AS n,
         CASE WHEN event_type = 'error' AND value >= 300 THEN 'Nacional' ELSE 'Regional' END AS t,
         'R' || CAST(json_extract(props, '$.k') AS VARCHAR) AS r,
         CASE WHEN event_type = 'signup' THEN 'k' || CAST(json_extract(props, '$.k') AS VARCHAR) ELSE '' END AS c,
         row_number() OVER (ORDER BY ts, event_id) AS o
  FROM events),
names AS (SELECT d, n, min(o) AS o FROM e WHERE n <> '' GROUP BY d, n),
coms AS (SELECT d, c, min(o) AS o FROM e WHERE c <> '' GROUP BY d, c),
days AS (SELECT d, bool_or(t = 'Nacional') AS national, list_sort(list(DISTINCT r)) AS regions FROM e GROUP BY d),
nl AS (SELECT d, list(n ORDER BY o) AS names FROM names GROUP BY d),
cl AS (SELECT d, list(c ORDER BY o) AS coms FROM coms GROUP BY d),
merged AS (
SELECT days.d AS "Day", coalesce(nl.names[1], '') AS "Name",
  CASE WHEN national THEN 'Nacional' ELSE 'Regional' END AS "Type",
  CASE WHEN national THEN 'Todas' ELSE array_to_string(regions, ' , ') END AS "Region",
  CASE WHEN national THEN array_to_string(coalesce(cl.coms, []), '; ')
       ELSE array_to_string(list_concat(coalesce(nl.names[2:], []), coalesce(cl.coms, [])), '; ')
  END AS "Comments"
FROM days LEFT JOIN nl USING (d) LEFT JOIN cl USING (d))"""


@query("holiday_merge", HOLIDAY_SQL + "\nSELECT * FROM merged")
def q_holiday_merge(spark, sf):
    m = merge_holidays(_holiday_entries(spark, sf), order_by=["ts", "event_id"])
    return m.withColumn("Region", F.array_join("Region", LIST_SEPARATOR))


@query("holiday_json_roundtrip", HOLIDAY_SQL + "\nSELECT * FROM merged")
def q_holiday_json_roundtrip(spark, sf):
    path = fresh_path(spark, "holidays")
    write_json(in_day_order(merge_holidays(_holiday_entries(spark, sf), order_by=["ts", "event_id"])), path)
    return extract_json(spark, path, {"Day": "str", "Name": "str", "Type": "str", "Region": "str",
                                      "Comments": "str"}, multi_line=False)


# ============================================================ sorting
SORT_SQL = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS o_orderdate
           FROM orders)
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate {dir} NULLS LAST, o_orderkey) AS position
FROM o"""


def _sort_input(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("o_orderdate"))


@query("sort_dates_asc", SORT_SQL.format(dir="ASC"))
def q_sort_dates_asc(spark, sf):
    return S.with_position(_sort_input(spark, sf), "o_orderdate", "ASC", then_by=["o_orderkey"])


@query("sort_dates_desc", SORT_SQL.format(dir="DESC"))
def q_sort_dates_desc(spark, sf):
    return S.with_position(_sort_input(spark, sf), "o_orderdate", "DES", then_by=["o_orderkey"])


# ============================================================ quality reports
_NR_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "o_orderkey", "o_custkey",
            "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("null_report", """
WITH j AS (SELECT * FROM customer c LEFT JOIN
           (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o
           ON c.c_custkey = o.o_custkey),
u AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM j" for c in _NR_COLS) + """)
SELECT * FROM u WHERE nulls > 0""")
def q_null_report(spark, sf):
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return Q.null_report(c.join(o, c["c_custkey"] == o["o_custkey"], "left"))


@query("duplicate_report", """
SELECT p_name AS value, count(*) AS copies FROM part WHERE p_name IS NOT NULL
GROUP BY p_name HAVING count(*) > 1""")
def q_duplicate_report(spark, sf):
    return Q.duplicate_report(table(spark, sf, "part"), "p_name")


# ============================================================ keyed upsert
def _upsert_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Target: customers outside the AUTOMOBILE segment. Source: AUTOMOBILE
    (new) and BUILDING customers, the latter with +100 balance below nation 12."""
    c = table(spark, sf, "customer")
    target = c.where(F.col("c_mktsegment") != "AUTOMOBILE")
    source = c.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).withColumn(
        "c_acctbal", F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") < 12),
                            F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")))
    return target, source


UPSERT_CLASS_SQL = """
WITH k AS (SELECT c_custkey,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'inserted'
       WHEN c_mktsegment = 'BUILDING' AND c_nationkey < 12 THEN 'updated'
       WHEN c_mktsegment = 'BUILDING' THEN 'ignored' ELSE 'retained' END AS change FROM customer)"""


@query("upsert_rows", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey < 12 THEN c_acctbal + 100 ELSE c_acctbal END
         AS c_acctbal, c_mktsegment
FROM customer""")
def q_upsert_rows(spark, sf):
    target, source = _upsert_sides(spark, sf)
    name = f"{fresh_database(spark)}.customer"
    # bucketed by the key: the second load shuffles only the incoming rows
    UP.upsert(target, name, "c_custkey", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    UP.upsert(source, name, "c_custkey")
    return spark.table(name)


@query("upsert_report", UPSERT_CLASS_SQL + """
SELECT count(*) FILTER (WHERE change = 'inserted') AS inserted, count(*) FILTER (WHERE change = 'updated') AS updated,
       count(*) FILTER (WHERE change = 'ignored') AS ignored, count(*) FILTER (WHERE change = 'retained') AS retained
FROM k""")
def q_upsert_report(spark, sf):
    return UP.change_counts(UP.merge_plan(*_upsert_sides(spark, sf), "c_custkey"))


@query("changed_keys", UPSERT_CLASS_SQL + "\nSELECT c_custkey FROM k WHERE change = 'updated'")
def q_changed_keys(spark, sf):
    plan = UP.merge_plan(*_upsert_sides(spark, sf), "c_custkey")
    return plan.where(F.col(UP.CHANGE) == "updated").select("c_custkey")


@query("new_keys", UPSERT_CLASS_SQL + "\nSELECT c_custkey FROM k WHERE change = 'inserted'")
def q_new_keys(spark, sf):
    plan = UP.merge_plan(*_upsert_sides(spark, sf), "c_custkey")
    return plan.where(F.col(UP.CHANGE) == "inserted").select("c_custkey")


@query("upsert_keyed", ORACLE["upsert_rows"])
def q_upsert_keyed(spark, sf):
    """A keyed table: the second load compares digests and rewrites the buckets that change."""
    target, source = _upsert_sides(spark, sf)
    name = f"{fresh_database(spark)}.customer"
    UP.upsert(target, name, "c_custkey", key_buckets=8)
    UP.upsert(source, name, "c_custkey")
    return KT.read(spark, name)


@query("upsert_keyed_report", ORACLE["upsert_report"])
def q_upsert_keyed_report(spark, sf):
    target, source = _upsert_sides(spark, sf)
    name = f"{fresh_database(spark)}.customer"
    UP.upsert(target, name, "c_custkey", key_buckets=8)
    report = UP.upsert(source, name, "c_custkey")
    return spark.createDataFrame([report.as_row()[1:]], "inserted long, updated long, ignored long, retained long")


@query("changed_keys_digest", ORACLE["changed_keys"])
def q_changed_keys_digest(spark, sf):
    """Changed rows from keys and digests alone."""
    target, source = (KT.prepared(x, "c_custkey", 8) for x in _upsert_sides(spark, sf))
    return KT.changes(target, source, "c_custkey").where(F.col(KT.CHANGE) == "updated").select("c_custkey")


@query("upsert_dup_keys", """
SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def q_upsert_dup_keys(spark, sf):
    return UP.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query("upsert_first_load", "SELECT * FROM part")
def q_upsert_first_load(spark, sf):
    name = f"{fresh_database(spark)}.part"
    UP.upsert(table(spark, sf, "part"), name, "p_partkey")
    return spark.table(name)


@query("upsert_partitioned", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END
         AS o_orderstatus,
       o_totalprice, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_month
FROM orders""")
def q_upsert_partitioned(spark, sf):
    """Facts partitioned by month: the second load touches only the months of
    the orders it carries (urgent open orders, now finished)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                          "o_orderpriority", F.trunc("o_orderdate", "month").alias("o_month"))
    name = f"{fresh_database(spark)}.orders_by_month"
    UP.upsert(o, name, "o_orderkey", partition_by=["o_month"])
    changes = (o.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
               .withColumn("o_orderstatus", F.lit("F")))
    UP.upsert(changes, name, "o_orderkey", partition_by=["o_month"])
    return spark.table(name)


# ============================================================ tables and metadata
@query("create_table", "SELECT * FROM customer")
def q_create_table(spark, sf):
    name = f"{fresh_database(spark)}.customer"
    TB.create_table(table(spark, sf, "customer"), name)
    return spark.table(name)


@query("replace_table", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_replace_table(spark, sf):
    name = f"{fresh_database(spark)}.customer"
    c = table(spark, sf, "customer")
    TB.create_table(c, name)
    return TB.replace_table(spark.table(name).where(F.col("c_mktsegment") == "BUILDING"), name)


# The driver tables described by the metadata queries, their ids and column counts.
META_TABLES = [("region", 1, 2), ("nation", 2, 3), ("customer", 3, 5), ("supplier", 4, 4),
               ("part", 5, 6), ("orders", 6, 6), ("lineitem", 7, 11), ("events", 8, 6), ("documents", 9, 5),
               ("embeddings", 10, 3), ("pages", 11, 3), ("benchmark", 12, 2), ("labels", 13, 3),
               ("conversations", 14, 4)]
FLOW_TIME = dt.datetime(2025, 6, 30, 12, 0, 0)


def _register_driver_tables(spark, sf) -> str:
    db = fresh_database(spark)
    for name, _, _ in META_TABLES:
        spark.catalog.createTable(f"{db}.{name}", path=f"{sf}/{name}.parquet", source="parquet")
    return db


@query("summary_tables", "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS table_id, '{n}' AS table_name, count(*) AS rows, "
    f"CAST({k} AS INTEGER) AS columns, DATE '{AS_OF.isoformat()}' AS last_updated FROM {n}"
    for n, i, k in META_TABLES))
def q_summary_tables(spark, sf):
    db = _register_driver_tables(spark, sf)
    control = f"{db}.summary_tables"
    for name, tid, _ in META_TABLES:
        SM.record_table_summary(spark, control, tid, f"{db}.{name}", AS_OF)
    return spark.table(control)


@query("tables_summary", "\nUNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS table_id, '{n}' AS table_name, count(*) AS rows, "
    f"'{n}_flow' AS flow_name, TIMESTAMP '{FLOW_TIME.isoformat(sep=' ')}' AS last_update FROM {n}"
    for n, i, _ in META_TABLES))
def q_tables_summary(spark, sf):
    db = _register_driver_tables(spark, sf)
    control = f"{db}.tables_summary"
    for name, tid, _ in META_TABLES:
        SM.record_flow(spark, control, tid, f"{db}.{name}", f"{name}_flow", FLOW_TIME)
    return spark.table(control)


@query("summary_loads", UPSERT_CLASS_SQL + f"""
SELECT '{AS_OF:%Y%m%d}-1' AS load_id, CAST(3 AS INTEGER) AS table_id,
       count(*) FILTER (WHERE change <> 'inserted') AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
       CAST(0 AS BIGINT) AS rows_ignored, DATE '{AS_OF.isoformat()}' AS updated_at FROM k
UNION ALL
SELECT '{AS_OF:%Y%m%d}-2', 3, count(*) FILTER (WHERE change = 'inserted'), count(*) FILTER (WHERE change = 'updated'),
       count(*) FILTER (WHERE change = 'ignored'), DATE '{AS_OF.isoformat()}' FROM k""")
def q_summary_loads(spark, sf):
    target, source = _upsert_sides(spark, sf)
    db = fresh_database(spark)
    for batch in (target, source):
        rep = UP.upsert(batch, f"{db}.customer", "c_custkey")
        SM.record_load(spark, f"{db}.summary_loads", 3, rep, AS_OF)
    return spark.table(f"{db}.summary_loads")


VIEW_SQL = ("SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total "
            "FROM {src} GROUP BY o_orderstatus")


@query("create_views", VIEW_SQL.format(src="orders"))
def q_create_views(spark, sf):
    name = f"v_order_totals_{uuid.uuid4().hex[:12]}"
    create_views(spark, {name: VIEW_SQL.format(src=f"parquet.`{sf}/orders.parquet`")})
    return spark.table(name)


# ============================================================ flows
# Balance bands used as outlet sizes and their codes.
SIZE_CODES = {"<0": 1, "0-5000": 2, ">5000": 3}
OUTLET_TYPES = {"Affiliated_Code": "str", "Affiliated_Name": "str", "Location": "str", "Location_num": "int",
                "Tam_m2": "str", "Tam_m2_num": "int", "cp": "str", "poblacion": "str",
                "provinciaid": "int", "provincia": "str"}


def _outlet_sources(spark, sf) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf, "customer")
    band = (F.when(F.col("c_acctbal") < 0, F.lit("<0")).when(F.col("c_acctbal") < 5000, F.lit("0-5000"))
            .otherwise(F.lit(">5000")))
    outlets = c.select(F.col("c_custkey").alias("Affiliated_Code"), F.col("c_name").alias("Affiliated_NAME"),
                       F.col("c_nationkey").alias("POSTALCODE"), F.col("c_mktsegment").alias("Location"),
                       band.alias("Tam_m2"))
    s = table(spark, sf, "supplier")
    postcodes = s.select(F.col("s_nationkey").alias("cp"),
                         F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("poblacion"),
                         F.col("s_suppkey").alias("provinciaid"),
                         F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("provincia"))
    return outlets, postcodes


def outlets_flow(spark, sf) -> DataFrame:
    outlets, postcodes = _outlet_sources(spark, sf)
    return flows.outlets_dimension(
        outlets, postcodes, rename={"Affiliated_NAME": "Affiliated_Name", "POSTALCODE": "cp"},
        postcode_key="cp", postcode_aggs={"poblacion": "FIRST", "provinciaid": "FIRST", "provincia": "FIRST"},
        outlet_order=["Affiliated_Code"], postcode_order=["provinciaid"], location_col="Location",
        size_col="Tam_m2", size_codes=SIZE_CODES, key="Affiliated_Code", expected_types=OUTLET_TYPES)


ORACLE_OUTLETS = """
WITH o AS (SELECT c_custkey, c_name, c_nationkey AS cp, c_mktsegment AS "Location",
                  CASE WHEN c_acctbal < 0 THEN '<0' WHEN c_acctbal < 5000 THEN '0-5000' ELSE '>5000' END AS "Tam_m2"
           FROM customer),
pc AS (SELECT s_nationkey AS cp,
              arg_min(s_name, s_suppkey) FILTER (WHERE s_acctbal >= 0) AS poblacion,
              min(s_suppkey) AS provinciaid,
              arg_min('P' || CAST(s_nationkey AS VARCHAR), s_suppkey) AS provincia
       FROM supplier GROUP BY s_nationkey),
loc AS (SELECT "Location", row_number() OVER (ORDER BY min(c_custkey)) AS code FROM o GROUP BY "Location")
SELECT CAST(o.c_custkey AS VARCHAR) AS "Affiliated_Code", o.c_name AS "Affiliated_Name", o."Location",
       CAST(loc.code AS BIGINT) AS "Location_num", o."Tam_m2",
       CAST(CASE o."Tam_m2" WHEN '<0' THEN 1 WHEN '0-5000' THEN 2 ELSE 3 END AS BIGINT) AS "Tam_m2_num",
       CAST(o.cp AS VARCHAR) AS cp, pc.poblacion, CAST(pc.provinciaid AS BIGINT) AS provinciaid, pc.provincia
FROM o LEFT JOIN pc ON o.cp = pc.cp JOIN loc USING ("Location")"""


@query("flow_outlets", ORACLE_OUTLETS)
def q_flow_outlets(spark, sf):
    return outlets_flow(spark, sf)


ORACLE_PRODUCTS = """
SELECT CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1 THEN p_name
            ELSE p_name || ' - ' || CAST(row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS VARCHAR)
       END AS "Product_Code",
       CAST(p_size AS BIGINT) AS "SIZE", p_brand AS "Format", p_partkey
FROM part"""


def _product_source(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_name").alias("Product_Code"), F.col("p_size").alias("SIZE"),
                                           F.col("p_brand").alias("Format"), "p_partkey")


@query("flow_products", ORACLE_PRODUCTS)
def q_flow_products(spark, sf):
    return flows.products_dimension(_product_source(spark, sf), key="Product_Code", order_by=["p_partkey"],
                                    expected_types={"Product_Code": "str", "SIZE": "int", "Format": "str",
                                                    "p_partkey": "int"})


FACT_SQL = """
SELECT strftime({ts}, '%Y%m%d')
         || CAST(row_number() OVER (PARTITION BY CAST({ts} AS DATE) ORDER BY {order}) - 1 AS VARCHAR) AS "{key}",
       CAST({ts} AS DATE) AS "{day}", {cols}
FROM {src}"""


@query("flow_sales", FACT_SQL.format(ts="o_orderdate", order="o_orderkey", key="sales_ID", day="Sales_DAY",
                                     cols="o_orderkey, o_custkey, o_totalprice", src="orders"))
def q_flow_sales(spark, sf):
    o = table(spark, sf, "orders").select(ymd("o_orderdate").cast("long").alias("Sales_DAY"),
                                          "o_orderkey", "o_custkey", "o_totalprice")
    return flows.daily_facts(o, day_col="Sales_DAY", key="sales_ID", order_by=["o_orderkey"])


_LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("flow_deliveries", FACT_SQL.format(ts="l_shipdate", order=", ".join(_LI_ORDER), key="delivery_ID",
                                          day="Delivery_DAY", cols=", ".join(_LI_ORDER), src="lineitem"))
def q_flow_deliveries(spark, sf):
    li = table(spark, sf, "lineitem").select(ymd("l_shipdate").cast("long").alias("Delivery_DAY"), *_LI_ORDER)
    return flows.daily_facts(li, day_col="Delivery_DAY", key="delivery_ID", order_by=_LI_ORDER)


@query("flow_out_of_stock", FACT_SQL.format(ts="ts", order="event_id", key="oos_ID", day="OoS_DAY",
                                            cols="event_id, user_id, event_type", src="events"))
def q_flow_out_of_stock(spark, sf):
    e = table(spark, sf, "events").select(ymd("ts").cast("long").alias("OoS_DAY"),
                                          "event_id", "user_id", "event_type")
    return flows.daily_facts(e, day_col="OoS_DAY", key="oos_ID", order_by=["event_id"])


CALENDAR_TYPES = {"Day": "datetime", "Week_day": "int", "Week_day_name": "str", "Month": "int",
                  "Month_name": "str", "Year": "int", "Name": "str", "Type": "str", "Region": "str",
                  "Comments": "str"}
HOLIDAY_JSON_TYPES = {"Day": "date", "Name": "str", "Type": "str", "Region": "str", "Comments": "str"}


@query("flow_calendar", HOLIDAY_SQL + ",\ncal AS (" + CALENDAR_SQL.format(
    lo="make_date(CAST(min(year(ts)) AS INTEGER), 1, 1)", hi="make_date(CAST(max(year(ts)) AS INTEGER), 12, 31)",
    src="events") + """)
SELECT CAST(coalesce(cal."Day", strptime(m."Day", '%d-%m-%Y')) AS TIMESTAMP) AS "Day",
       cal."Week_day", cal."Week_day_name", cal."Month", cal."Month_name", cal."Year",
       m."Name", m."Type", m."Region", m."Comments"
FROM cal FULL JOIN merged m ON cal."Day" = CAST(strptime(m."Day", '%d-%m-%Y') AS DATE)""")
def q_flow_calendar(spark, sf):
    start, end = _event_years(spark, sf)
    return flows.calendar_dimension(_holiday_source(spark, sf), start=start, end=end, expected_types=CALENDAR_TYPES)


def _holiday_source(spark, sf) -> DataFrame:
    """The holiday file, which has one object per line and day."""
    path = fresh_path(spark, "holidays")
    write_json(in_day_order(merge_holidays(_holiday_entries(spark, sf), order_by=["ts", "event_id"])), path)
    return extract_json(spark, path, HOLIDAY_JSON_TYPES, multi_line=False)


def _event_years(spark, sf) -> tuple[str, str]:
    years = table(spark, sf, "events").agg(F.min(F.year("ts")).alias("a"), F.max(F.year("ts")).alias("b")).first()
    return f"01-01-{years['a']}", f"31-12-{years['b']}"



@query("latest_per_key", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id""")
def q_latest_per_key(spark, sf):
    """The micro-batch reduction of the streaming upsert: latest event per user."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(e, "user_id", ["ts", "event_id"])



# ============================================================ flows from files
@query("flow_sales_csv", FACT_SQL.format(ts="o_orderdate", order="o_orderkey", key="sales_ID", day="Sales_DAY",
                                         cols="o_orderkey, o_custkey, o_totalprice", src="orders"))
def q_flow_sales_csv(spark, sf):
    """The sales flow as it runs on a daily export: a ``;`` CSV whose rows are in
    order-key order; the occurrence counter follows the file's row order."""
    path = fresh_path(spark, "csv")
    o = table(spark, sf, "orders").select(ymd("o_orderdate").cast("long").alias("Sales_DAY"),
                                          "o_orderkey", "o_custkey", "o_totalprice")
    write_csv(o.orderBy("o_orderkey"), path)
    facts = with_row_order(extract_csv(spark, path, ";"))
    return flows.daily_facts(facts, day_col="Sales_DAY", key="sales_ID", order_by=["_row"]).drop("_row")


@query("flow_outlets_csv", ORACLE_OUTLETS)
def q_flow_outlets_csv(spark, sf):
    """The outlets flow from two ``;`` CSV exports (outlets in customer-key
    order, postcodes in supplier-key order); first appearance and FIRST follow
    the files' row order."""
    out_path, pc_path = fresh_path(spark, "csv"), fresh_path(spark, "csv")
    c = table(spark, sf, "customer")
    band = (F.when(F.col("c_acctbal") < 0, F.lit("<0")).when(F.col("c_acctbal") < 5000, F.lit("0-5000"))
            .otherwise(F.lit(">5000")))
    write_csv(c.select(F.col("c_custkey").alias("Affiliated_Code"), F.col("c_name").alias("Affiliated_NAME"),
                       F.col("c_nationkey").alias("POSTALCODE"), F.col("c_mktsegment").alias("Location"),
                       band.alias("Tam_m2")).orderBy("Affiliated_Code"), out_path)
    s = table(spark, sf, "supplier")
    write_csv(s.select(F.col("s_nationkey").alias("cp"),
                       F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("poblacion"),
                       F.col("s_suppkey").alias("provinciaid"),
                       F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("provincia"))
              .orderBy("provinciaid"), pc_path)
    outlets = with_row_order(extract_csv(spark, out_path, ";"), "_row")
    postcodes = with_row_order(extract_csv(spark, pc_path, ";"), "_pc_row")
    df = flows.outlets_dimension(
        outlets, postcodes, rename={"Affiliated_NAME": "Affiliated_Name", "POSTALCODE": "cp"},
        postcode_key="cp", postcode_aggs={"poblacion": "FIRST", "provinciaid": "FIRST", "provincia": "FIRST"},
        outlet_order=["_row"], postcode_order=["_pc_row"], location_col="Location",
        size_col="Tam_m2", size_codes=SIZE_CODES, key="Affiliated_Code")
    return Q.conform_types(df.drop("_row"), OUTLET_TYPES)



@query("flow_products_csv", ORACLE_PRODUCTS)
def q_flow_products_csv(spark, sf):
    """The products flow from a ``;`` CSV export in part-key order; duplicate
    codes get their suffix in the file's row order."""
    path = fresh_path(spark, "csv")
    p = table(spark, sf, "part").select(F.col("p_name").alias("Product_Code"), F.col("p_size").alias("SIZE"),
                                        F.col("p_brand").alias("Format"), "p_partkey")
    write_csv(p.orderBy("p_partkey"), path)
    products = with_row_order(extract_csv(spark, path, ";"))
    df = flows.products_dimension(products, key="Product_Code", order_by=["_row"])
    return Q.conform_types(df.drop("_row"), {"Product_Code": "str", "SIZE": "int", "Format": "str",
                                             "p_partkey": "int"})



@query("stream_upsert", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id""")
def q_stream_upsert(spark, sf):
    """Events arrive as day files; a streaming query upserts each micro-batch
    into a table keyed by user (latest event wins), run until the files are
    consumed. The table then holds each user's latest event."""
    src = fresh_path(spark, "events-by-day")
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type",
                                           F.to_date("ts").alias("day"))
    e.hint("rebalance", "day").write.partitionBy("day").parquet(src)
    name = f"{fresh_database(spark)}.latest_event"
    stream = (spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 8).parquet(src)
              .drop("day"))
    q = upsert_stream(stream, name, "user_id", ["ts", "event_id"], fresh_path(spark, "stream"), available_now=True,
                      buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    q.awaitTermination()
    return spark.table(name)


# ============================================================ values and moves that are easy to lose
@query("upsert_moved_partition", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def q_upsert_moved_partition(spark, sf):
    """Orders by status: the second load moves the pending ones to another partition, which empties theirs."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    name = f"{fresh_database(spark)}.orders_by_status"
    UP.upsert(o, name, "o_orderkey", partition_by=["o_orderstatus"])
    UP.upsert(o.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F")), name, "o_orderkey")
    return spark.table(name)


@query("csv_quoted", """
SELECT c_custkey, 'say "' || c_name || '"; ' || c_mktsegment AS note, ' NA ' AS spaced,
       '1234567890123456789' || CAST(c_custkey AS VARCHAR) AS code FROM customer""")
def q_csv_quoted(spark, sf):
    """Doubled quotes, delimiters inside quotes, text like a token but for its spaces, codes beyond 64 bits."""
    path = fresh_path(spark, "csv")
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    rows = c.select("c_custkey", F.concat(F.lit('say "'), "c_name", F.lit('"; '), "c_mktsegment").alias("note"),
                    F.lit(" NA ").alias("spaced"), F.concat(F.lit("1234567890123456789"), key).alias("code"))
    # each part file has the header as its first line
    rows.write.option("header", True).option("sep", ";").option("quote", '"').option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return extract_csv(spark, path, ";")


@query("csv_declared_numeric_tokens", """
SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer""")
def q_csv_declared_numeric_tokens(spark, sf):
    """Missing-value tokens in columns declared as numbers."""
    path = fresh_path(spark, "csv")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    write_csv(c.select("c_custkey", F.when(F.col("c_nationkey") == 3, "NA").otherwise(
        F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") < 0, "NaN").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal")), path)
    return extract_csv(spark, path, ";", schema=c.schema)


@query("conform_big_int", """
SELECT 9007199254740993 + o_orderkey AS as_text, 9007199254740993 + o_orderkey AS as_decimal,
       CAST(o_custkey AS BIGINT) AS with_point FROM orders""")
def q_conform_big_int(spark, sf):
    """Whole numbers beyond a double's 53 bits keep their value."""
    big = F.lit(9007199254740993) + F.col("o_orderkey")
    o = table(spark, sf, "orders").select(big.cast("string").alias("as_text"), big.cast("decimal(20,0)").alias("as_decimal"),
                                          F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("with_point"))
    return Q.conform_types(o, {"as_text": "int", "as_decimal": "int", "with_point": "int"})


@query("fill_nulls_mixed_list", """
SELECT c_custkey, CASE WHEN c_nationkey = 5 THEN 0 ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS c_mktsegment,
       coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal > 5000 END, false) AS rich FROM customer""")
def q_fill_nulls_mixed_list(spark, sf):
    """One list for columns of all types, with a null in it."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.when(
        F.col("c_acctbal") >= 0, F.col("c_acctbal") > 5000).alias("rich"))
    for name in ("c_nationkey", "c_mktsegment", "rich"):
        c = C.fill_nulls(c, name, [None, 5, "BUILDING"])
    return c


@query("null_report_nan", """
SELECT 'c_acctbal' AS column, count(*) AS nulls FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0""")
def q_null_report_nan(spark, sf):
    """NaN counts as missing."""
    return Q.null_report(table(spark, sf, "customer").select("c_custkey", F.when(
        F.col("c_acctbal") >= 0, F.col("c_acctbal")).otherwise(F.lit(float("nan"))).alias("c_acctbal")))


# ============================================================ flows end to end
def _loads(spark, frame: DataFrame, key: str, first: F.Column, change: str, table_id: int, blank: F.Column | None = None,
           **layout) -> DataFrame:
    """Two loads of a flow's frame: the rows of ``first`` with ``change`` blanked where ``blank`` says (keys of odd length), then the whole frame.

    Returns the control rows: what the two loads did, and the summary's rows and columns.
    """
    db = fresh_database(spark)
    names = dict(summary_table=f"{db}.summary_tables", loads_table=f"{db}.summary_loads", as_of=AS_OF)
    kind = frame.schema[change].dataType
    blank = F.length(key) % 2 == 1 if blank is None else blank
    early = frame.where(first).withColumn(change, F.when(blank, F.lit(None).cast(kind)).otherwise(F.col(change)))
    for batch in (early, frame):
        flows.load(batch, f"{db}.loaded", table_id, key, **names, **layout)
    summary = spark.table(f"{db}.summary_tables").select("table_id", "rows", "columns")
    return spark.table(f"{db}.summary_loads").join(summary, "table_id")


def _loads_sql(frame_sql: str, key: str, first: str, change: str, table_id: int, columns: int,
               blank: str | None = None) -> str:
    blank = blank or f'length("{key}") % 2 = 1'
    blanked = f'{blank} AND "{change}" IS NOT NULL'
    return f"""
WITH f AS ({frame_sql}), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE {first}) AS early,
  count(*) FILTER (WHERE ({first}) AND {blanked}) AS changed FROM f)
SELECT '{AS_OF:%Y%m%d}-1' AS load_id, CAST({table_id} AS INTEGER) AS table_id, early AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_ignored, DATE '{AS_OF.isoformat()}' AS updated_at,
       n AS rows, CAST({columns} AS INTEGER) AS columns FROM n
UNION ALL SELECT '{AS_OF:%Y%m%d}-2', {table_id}, n - early, changed, early - changed, DATE '{AS_OF.isoformat()}', n, {columns} FROM n"""


@query("flow_outlets_loads", _loads_sql(ORACLE_OUTLETS, "Affiliated_Code", "\"Location\" <> 'AUTOMOBILE'", "Affiliated_Name",
                                        1, 10))
def q_flow_outlets_loads(spark, sf):
    return _loads(spark, outlets_flow(spark, sf), "Affiliated_Code", F.col("Location") != "AUTOMOBILE", "Affiliated_Name",
                  1, buckets=4)


@query("flow_products_loads", _loads_sql(ORACLE_PRODUCTS, "Product_Code", '"SIZE" > 10', "Format", 2, 4))
def q_flow_products_loads(spark, sf):
    return _loads(spark, q_flow_products(spark, sf), "Product_Code", F.col("SIZE") > 10, "Format", 2)


@query("flow_sales_loads", _loads_sql(FACT_SQL.format(
    ts="o_orderdate", order="o_orderkey", key="sales_ID", day="Sales_DAY", cols="o_orderkey, o_custkey, o_totalprice",
    src="orders"), "sales_ID", "o_totalprice > 50000", "o_custkey", 3, 5))
def q_flow_sales_loads(spark, sf):
    return _loads(spark, q_flow_sales(spark, sf), "sales_ID", F.col("o_totalprice") > 50000, "o_custkey", 3)


@query("flow_deliveries_loads", _loads_sql(ORACLE["flow_deliveries"], "delivery_ID", "l_quantity > 10", "l_suppkey", 4,
                                           2 + len(_LI_ORDER)))
def q_flow_deliveries_loads(spark, sf):
    return _loads(spark, q_flow_deliveries(spark, sf), "delivery_ID", F.col("l_quantity") > 10, "l_suppkey", 4, key_buckets=8)


@query("flow_out_of_stock_loads", _loads_sql(ORACLE["flow_out_of_stock"], "oos_ID", "event_type <> 'error'", "user_id", 5, 5))
def q_flow_out_of_stock_loads(spark, sf):
    return _loads(spark, q_flow_out_of_stock(spark, sf), "oos_ID", F.col("event_type") != "error", "user_id", 5)


@query("flow_calendar_loads", _loads_sql(ORACLE["flow_calendar"].replace("AS TIMESTAMP) AS \"Day\"", "AS TIMESTAMP) AS \"Day\", "
                                         "strftime(coalesce(cal.\"Day\", strptime(m.\"Day\", '%d-%m-%Y')), '%Y%m%d') AS \"Key\""),
                                         "Key", '"Month" > 3', "Week_day_name", 6, 11, '"Month" % 2 = 0'))
def q_flow_calendar_loads(spark, sf):
    frame = q_flow_calendar(spark, sf)
    frame = frame.select(F.date_format("Day", "yyyyMMdd").alias("Key"), *frame.columns)
    return _loads(spark, frame, "Key", F.col("Month") > 3, "Week_day_name", 6, F.col("Month") % 2 == 0)


# ============================================================ all flows from settings
_RUN_ORACLES = [(1, ORACLE_OUTLETS, 10), (2, ORACLE_PRODUCTS, 4), (3, ORACLE["flow_sales"], 5),
                (4, ORACLE["flow_deliveries"], 2 + len(_LI_ORDER)), (5, ORACLE["flow_out_of_stock"], 5), (6, ORACLE["flow_calendar"], 10)]


@query("flow_run_settings", " UNION ALL ".join(f"""
SELECT '{AS_OF:%Y%m%d}-{i}' AS load_id, CAST({i} AS INTEGER) AS table_id, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
       CAST(0 AS BIGINT) AS rows_ignored, DATE '{AS_OF.isoformat()}' AS updated_at, count(*) AS rows, CAST({n} AS INTEGER) AS columns
FROM ({sql}) AS f""" for i, sql, n in _RUN_ORACLES))
def q_flow_run_settings(spark, sf):
    """The whole run of six flows from settings, begun twice under one id: the second time finds all flows finished."""
    db = fresh_database(spark)
    start, end = _event_years(spark, sf)
    settings = {
        "outlets": ST.OutletSettings(
            rename={"Affiliated_NAME": "Affiliated_Name", "POSTALCODE": "cp"}, size_codes=SIZE_CODES, expected_types=OUTLET_TYPES,
            postcode_aggs={"poblacion": "FIRST", "provinciaid": "FIRST", "provincia": "FIRST"},
            order_by=["Affiliated_Code"], postcode_order=["provinciaid"]),
        "products": ST.ProductSettings(order_by=["p_partkey"], expected_types={"Product_Code": "str", "SIZE": "int",
                                                                               "Format": "str", "p_partkey": "int"}),
        "sales": ST.FactSettings("sales_day", 3, "sales_ID", "Sales_DAY", order_by=["o_orderkey"]),
        "deliveries": ST.FactSettings("delivery_day", 4, "delivery_ID", "Delivery_DAY", order_by=_LI_ORDER),
        "out_of_stock": ST.FactSettings("oos_day", 5, "oos_ID", "OoS_DAY", order_by=["event_id"]),
        "calendar": ST.CalendarSettings(start=start, end=end, expected_types=CALENDAR_TYPES)}
    orders = table(spark, sf, "orders").select(ymd("o_orderdate").cast("long").alias("Sales_DAY"), "o_orderkey", "o_custkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").select(ymd("l_shipdate").cast("long").alias("Delivery_DAY"), *_LI_ORDER)
    events = table(spark, sf, "events").select(ymd("ts").cast("long").alias("OoS_DAY"), "event_id", "user_id", "event_type")
    outlets, postcodes = _outlet_sources(spark, sf)
    sources = {"outlets": {"outlets": outlets, "postcodes": postcodes}, "products": {"products": _product_source(spark, sf)},
               "sales": {"facts": orders}, "deliveries": {"facts": lines}, "out_of_stock": {"facts": events},
               "calendar": {"holidays": lambda: _holiday_source(spark, sf)}}
    for _ in range(2):
        RN.run_all(spark, settings, sources, database=db, as_of=AS_OF, run_id=db, layouts={"deliveries": {"key_buckets": 8}})
    summary = spark.table(f"{db}.summary_tables").select("table_id", "rows", "columns")
    return spark.table(f"{db}.summary_loads").join(summary, "table_id")
