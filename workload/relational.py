"""D, J11-J19, A, W, O and U: duplicates, joins, aggregates, windows, order and unions."""

import uuid

from pyspark.sql import Window, functions as F

from civiclake.functions.classify import SEVERITIES, label_rank
from civiclake.functions.numeric import ratio
from civiclake.operators import dedup, ordering, quality, unions
from civiclake.plans import analytics, flood, reports
from civiclake.sources import catalog
from workload import duck
from workload.registry import query

_BY_PRICE = "PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey"


@query("D01_duplicate_count", "SELECT doc_id, count(*) OVER (PARTITION BY md5(text)) AS _dedup_count FROM documents")
def _(s):
    keyed = s.documents.select("doc_id", F.md5("text").alias("digest"))
    return dedup.count_per_key(keyed, ["digest"]).drop("digest")


@query("D02_duplicate_rank", f"""
    SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS _dedup_count,
           CAST(CASE WHEN o_totalprice IS NOT NULL THEN row_number() OVER ({_BY_PRICE}) END AS INT) AS _dedup_rank
    FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders)""")
def _(s):
    orders = s.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("o_totalprice"))
    return dedup.add_duplicate_markers(orders, key_cols=["o_custkey"], rank_col="o_totalprice", tiebreak=["o_orderkey"]).drop("o_totalprice")


@query("D03_keep_preferred", "SELECT lang, source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) = 1")
def _(s):
    return dedup.keep_preferred(s.documents.drop("text"), key_cols=["lang", "source"], rank_col="n_chars", tiebreak=["doc_id"])


@query("D04_distinct_sorted", "SELECT DISTINCT lang, source FROM documents")
def _(s):
    return dedup.distinct_sorted(s.documents, ["lang", "source"])


# -- joins ----------------------------------------------------------------------------------------

@query("J11_left_join_dimension", """
    SELECT e.sensor_id, e.onset_time_mins, e.drain_time_mins, e.duration_mins, e.max_depth_inches, s.borough, s.zipcode
    FROM {flood_events} e LEFT JOIN {sensors} s ON e.sensor_id = s.sensor_id""")
def _(s):
    joined = flood.join_sensors(s.flood_events, s.sensors, ["sensor_id", "borough", "zipcode"])
    return joined.select("sensor_id", "onset_time_mins", "drain_time_mins", "duration_mins", "max_depth_inches", "borough", "zipcode")


@query("J12_left_join_using", """
    SELECT year, r.riders, a.readings FROM (SELECT year(date) AS year, sum(count) AS riders FROM {ridership} GROUP BY 1) r
    LEFT JOIN (SELECT year, count(*) AS readings FROM {air} WHERE year <> 2020 GROUP BY 1) a USING (year)""")
def _(s):
    riders = s.ridership.groupBy(F.year("date").alias("year")).agg(F.sum("count").alias("riders"))
    readings = s.air.where("year <> 2020").groupBy("year").agg(F.count("*").alias("readings"))
    return riders.join(readings, on="year", how="left").withColumn("year", F.col("year").cast("bigint"))


@query("J13_left_join_count", """
    SELECT s.sensor_id, count(e.sensor_id) AS events FROM {sensors} s LEFT JOIN {flood_events} e ON s.sensor_id = e.sensor_id GROUP BY 1""")
def _(s):
    counted = s.flood_events.groupBy("sensor_id").agg(F.count("*").alias("events"))
    return s.sensors.select("sensor_id").join(counted, "sensor_id", "left").fillna(0, ["events"])


_NAMES = "('BROOKLYN', 'QUEENS', 'BRONX', 'MANHATTAN', 'STATEN ISLAND')"
_WATER = "('Sewer', 'Standing Water', 'Water System')"
_WATER_WIDE = "('Sewer', 'Standing Water', 'Water System', 'Water Quality')"


def _stacked(flood: str, request: str, floods_where: str, requests_where: str) -> str:
    """Floods and complaints as rows of one table: floods carry a depth and a span, complaints a kind."""
    return f"""
        SELECT {flood}, borough AS area, max_depth_inches AS depth, duration_mins AS span, flood_severity AS severity, NULL AS kind, true AS is_flood
        FROM {{floods}} WHERE flood_year >= 2024 AND {floods_where}
        UNION ALL SELECT {request}, NULL, NULL, NULL, NULL, complaint_type, false FROM {{requests}} WHERE {requests_where}"""


_DAY = {t: f"({duck.local_wall(t)})::DATE" for t in ("flood_start_time", "created_date")}
_FLOODS, _CALLS = "count(*) FILTER (is_flood)", "count(*) FILTER (NOT is_flood)"
_BY_DAY = f"""
    daily AS (
        SELECT place, day, max(area) AS area, {_FLOODS} AS floods, {_CALLS} AS calls, max(depth) AS deepest, max(severity) AS worst,
               count(*) FILTER (kind IN {_WATER}) AS water, count(*) FILTER (kind IN {_WATER_WIDE}) AS water_wide,
               min(y) AS y, min(m) AS m
        FROM ({_stacked(f"upper(borough) AS place, {_DAY['flood_start_time']} AS day, flood_year AS y, flood_month AS m",
                        f"borough, {_DAY['created_date']}, NULL, NULL", "borough IS NOT NULL", "borough <> 'Unspecified'")}) GROUP BY place, day)"""
MONTHLY_JOIN = f"""
    SELECT max(area) AS borough, y AS flood_year, m AS flood_month, {_FLOODS} AS flood_events, round(avg(depth), 1) AS avg_depth,
           count(*) FILTER (kind IN {_WATER}) AS water_complaints, {_CALLS} AS total_311
    FROM ({_stacked("upper(borough) AS place, flood_year AS y, flood_month AS m", "borough, year, month", "borough IS NOT NULL", "borough <> 'Unspecified'")})
    GROUP BY place, y, m HAVING bool_or(is_flood) AND NOT bool_and(is_flood)"""
ZIP_JOIN = f"""
    SELECT place AS zipcode, {_FLOODS} AS flood_events, round(avg(depth), 1) AS avg_depth, round(avg(span), 0) AS avg_duration,
           count(*) FILTER (kind IN {_WATER_WIDE}) AS water_complaints, {_CALLS} AS total_311,
           round(100.0 * count(*) FILTER (kind IN {_WATER_WIDE}) / {_CALLS}, 2) AS water_pct
    FROM ({_stacked("zipcode AS place", "incident_zip", "zipcode IS NOT NULL", "incident_zip IS NOT NULL")})
    GROUP BY place HAVING bool_or(is_flood) AND NOT bool_and(is_flood) ORDER BY 2 DESC, 1 LIMIT 20"""
NEXT_DAY_JOIN = f"""
    WITH {_BY_DAY},
    looked AS (SELECT *, max(CASE WHEN calls > 0 THEN water END) OVER (PARTITION BY place ORDER BY day RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL 1 DAY FOLLOWING) AS tomorrow FROM daily)
    SELECT day AS flood_date, area AS borough, y AS flood_year, m AS flood_month, floods AS flood_events, deepest AS max_depth, worst AS worst_severity,
           water AS water_complaints, tomorrow AS water_complaints_next_day FROM looked WHERE floods >= 3 AND calls > 0 ORDER BY floods DESC, day, area LIMIT 20"""
BUCKET_JOIN = f"""
    WITH {_BY_DAY}
    SELECT coalesce((map([3, 2, 1], ['major_flood_day (10+)', 'moderate_flood_day (5-9)', 'minor_flood_day (3-4)']))[(floods >= 3)::INT + (floods >= 5)::INT + (floods >= 10)::INT],
                    'no/low_flood_day (0-2)') AS flood_intensity,
           count(*) AS days, round(avg(water_wide), 0) AS avg_water_311, round(avg(calls), 0) AS avg_total_311,
           round(avg(water_wide) * 100.0 / nullif(avg(calls), 0), 2) AS water_pct_of_total
    FROM daily WHERE floods > 0 AND calls > 0 GROUP BY 1"""


def _instants(df, col):
    """The shape's wall times, taken as UTC instants."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def floods_at(s):
    return _instants(s.floods, "flood_start_time")


def requests_at(s):
    return _instants(s.requests, "created_date")


@query("J14_multi_key_join", MONTHLY_JOIN)
def _(s):
    return reports.monthly_floods_and_complaints(s.floods, s.requests)


@query("J15_aggregate_join", ZIP_JOIN)
def _(s):
    return reports.floods_and_complaints_by_zip(s.floods, s.requests)


@query("J16_next_day_join", NEXT_DAY_JOIN)
def _(s):
    return reports.flood_days_and_next_day(floods_at(s), requests_at(s))


@query("J17_bucketed_join", BUCKET_JOIN)
def _(s):
    return reports.flood_intensity(floods_at(s), requests_at(s))


@query("J18_anti_join_dropped", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_totalprice >= 1000 AND o_custkey % 10 <> 3)")
def _(s):
    contract = {"o_orderkey": ("o_orderkey", "bigint"), "o_custkey": ("o_custkey", "bigint"), "o_totalprice": ("o_totalprice", "double")}
    gone = quality.dropped_rows(s.orders.select("o_orderkey", "o_custkey", "o_totalprice"), contract,
                                lambda df: df.where("o_totalprice >= 1000 AND o_custkey % 10 <> 3"))
    return gone.select("o_orderkey", "o_custkey")


@query("J19_left_join_comments", """
    SELECT c.column_name, c.column_type, CASE c.column_name WHEN 'c_custkey' THEN 'Customer number' WHEN 'c_acctbal' THEN 'Balance' END AS comment, n AS filled
    FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'), ('c_mktsegment', 'string')) c(column_name, column_type)
    JOIN (UNPIVOT (SELECT count(c_custkey) AS c_custkey, count(c_name) AS c_name, count(c_nationkey) AS c_nationkey, count(c_acctbal) AS c_acctbal, count(c_mktsegment) AS c_mktsegment FROM customer)
          ON COLUMNS(*) INTO NAME column_name VALUE n) USING (column_name)""")
def _(s):
    view = f"customer_{uuid.uuid4().hex}"
    notes = {"c_custkey": "Customer number", "c_acctbal": "Balance"}
    s.customer.select(*[F.col(c).alias(c, metadata={"comment": notes[c]} if c in notes else {}) for c in s.customer.columns]).createOrReplaceTempView(view)
    filled = s.customer.agg(*[F.count(c).alias(c) for c in s.customer.columns]).unpivot([], s.customer.columns, "column_name", "filled")
    made = catalog.describe(s.spark, view, with_comments=True).withColumn("comment", F.nullif("comment", F.lit("")))
    return made.join(filled, "column_name")


# -- aggregates -----------------------------------------------------------------------------------

@query("A01_basic_aggregates", """
    SELECT mode, count(*) AS n, sum(count) AS riders, round(avg(count), 1) AS average, min(count) AS least, max(count) AS most FROM {ridership} GROUP BY 1""")
def _(s):
    return s.ridership.groupBy("mode").agg(F.count("*").alias("n"), F.sum("count").alias("riders"), F.round(F.avg("count"), 1).alias("average"),
                                           F.min("count").alias("least"), F.max("count").alias("most"))


@query("A02_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def _(s):
    return s.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"))


@query("A03_conditional_distinct", "SELECT borough, count(DISTINCT CASE WHEN res_organics_tons > 1 THEN community_district END) AS served FROM {tonnage} GROUP BY 1")
def _(s):
    return s.tonnage.groupBy("borough").agg(F.countDistinct(F.when(F.col("res_organics_tons") > 1, F.col("community_district"))).alias("served"))


@query("A04_conditional_counts", """
    SELECT borough, count(CASE WHEN res_organics_tons > 1 THEN 1 END) AS months, sum(CASE WHEN refuse_tons_collected > 500 THEN 1 ELSE 0 END)::BIGINT AS heavy FROM {tonnage} GROUP BY 1""")
def _(s):
    return s.tonnage.groupBy("borough").agg(F.count_if(F.col("res_organics_tons") > 1).alias("months"),
                                            F.count_if(F.col("refuse_tons_collected") > 500).alias("heavy"))


@query("A05_pivot", """
    SELECT year(date)::INT AS year, sum(CASE WHEN mode = 'Subway' THEN count END) AS "Subway", sum(CASE WHEN mode = 'Bus' THEN count END) AS "Bus" FROM {ridership} GROUP BY 1""")
def _(s):
    return s.ridership.groupBy(F.year("date").alias("year")).pivot("mode", ["Subway", "Bus"]).agg(F.sum("count"))


@query("A06_stddev", "SELECT name, round(stddev(data_value), 3) AS spread FROM {air} GROUP BY 1")
def _(s):
    return s.air.groupBy("name").agg(F.round(F.stddev_samp("data_value"), 3).alias("spread"))


@query("A07_exact_quantiles", """
    SELECT l_returnflag, median(l_quantity) AS mid, quantile_cont(l_quantity, 0.95) AS p95, round(quantile_cont(l_extendedprice, 0.25), 2) AS q1 FROM lineitem GROUP BY 1""")
def _(s):
    made = ordering.grouped_quantiles(s.lineitem, ["l_returnflag"], {"l_quantity": {"mid": 0.5, "p95": 0.95}, "l_extendedprice": {"q1": 0.25}})
    return made.withColumn("q1", F.round("q1", 2))


@query("A08_having", "SELECT o_custkey, count(*) AS n, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1 HAVING count(*) > 12")
def _(s):
    return s.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.to_date(F.max("o_orderdate")).alias("last_day")).where("n > 12")


@query("A09_group_by_expression", "SELECT year(o_orderdate)::INT AS y, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def _(s):
    return s.sql("SELECT year(o_orderdate) AS y, o_orderstatus, count(*) AS n FROM {orders} GROUP BY 1, 2", "orders")


@query("A10_global_aggregate", "SELECT count(*) AS n, min(o_orderkey) AS first_key, max(o_totalprice) AS top FROM orders")
def _(s):
    return s.orders.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_totalprice").alias("top"))


@query("A11_scalar_subquery_bound", """
    SELECT year(o_orderdate)::INT AS y, count(*) AS n FROM orders
    WHERE year(o_orderdate) BETWEEN (SELECT max(year(o_orderdate)) - 5 FROM orders) AND (SELECT max(year(o_orderdate)) - 1 FROM orders) GROUP BY 1""")
def _(s):
    last = s.orders.select(F.max(F.year("o_orderdate"))).scalar()
    return s.orders.where(F.year("o_orderdate").between(last - 5, last - 1)).groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))


@query("A12_ratio_of_sums", """
    SELECT borough, round(100.0 * sum(coalesce(paper_tons_collected, 0)) / nullif(sum(refuse_tons_collected), 0), 1) AS pct FROM {tonnage} GROUP BY 1""")
def _(s):
    return s.tonnage.groupBy("borough").agg(ratio(F.sum(F.coalesce("paper_tons_collected", F.lit(0))), F.sum("refuse_tons_collected"), 1, 100).alias("pct"))


@query("A13_worst_label", """
    SELECT sensor_id, max(flood_severity) AS by_name, (['minor','moderate','major','severe'])[max(list_position(['minor','moderate','major','severe'], flood_severity))] AS by_rank
    FROM {floods} GROUP BY 1""")
def _(s):
    return s.floods.groupBy("sensor_id").agg(reports.worst_label("flood_severity", SEVERITIES, by_rank=False).alias("by_name"),
                                             reports.worst_label("flood_severity", SEVERITIES, by_rank=True).alias("by_rank"))


@query("A14_frame_style", """
    SELECT sensor_name, count(*) AS events, max(max_depth_inches) AS worst_depth_in FROM {flood_events} GROUP BY 1 ORDER BY events DESC, sensor_name LIMIT 10""")
def _(s):
    return reports.deepest_sensors(s.flood_events)


# -- windows, order, top-k ------------------------------------------------------------------------

@query("W01_year_over_year", """
    WITH y AS (SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY 1)
    SELECT year, n, round(100.0 * (n - lag(n) OVER (ORDER BY year)) / nullif(lag(n) OVER (ORDER BY year), 0), 1) AS change_pct FROM y""")
def _(s):
    yearly = s.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return yearly.withColumn("change_pct", analytics.change_pct("n", "year"))


@query("W02_rank_of_aggregate", """
    SELECT c_nationkey, rank() OVER (ORDER BY avg(c_acctbal) DESC)::INT AS balance_rank, rank() OVER (ORDER BY count(*) DESC)::INT AS size_rank FROM customer GROUP BY 1""")
def _(s):
    # One row per nation: the ranked frame is as small as the list of nations.
    nations = s.customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("balance"), F.count("*").alias("n"))
    return nations.select("c_nationkey", F.rank().over(Window.orderBy(F.desc("balance"))).alias("balance_rank"),
                          F.rank().over(Window.orderBy(F.desc("n"))).alias("size_rank"))


@query("W03_row_number", "SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_partkey, l_linenumber) AS position FROM lineitem")
def _(s):
    items = s.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return ordering.grouped_position(items, ["l_suppkey"], [ordering.desc("l_quantity"), "l_orderkey", "l_partkey", "l_linenumber"]).drop("l_quantity")


@query("W04_share_of_total", "SELECT p_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def _(s):
    kinds = s.lineitem.select("l_partkey").join(s.part, F.col("p_partkey") == F.col("l_partkey"))
    return kinds.groupBy("p_type").agg(F.count("*").alias("n")).withColumn("pct", ratio(F.col("n"), analytics.total_of("n"), 2, 100))


@query("W05_count_and_rank", """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS events, CAST(row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS INT) AS place FROM events""")
def _(s):
    return dedup.add_duplicate_markers(s.events.select("event_id", "user_id", "value"), key_cols=["user_id"], rank_col="value", tiebreak=["event_id"],
                                       count_col="events", rank_out_col="place", descending=False).drop("value")


@query("O01_multi_key_sort", "SELECT o_orderstatus, o_orderkey, o_custkey FROM orders ORDER BY o_orderstatus DESC, o_custkey, o_orderkey")
def _(s):
    return s.orders.select("o_orderstatus", "o_orderkey", "o_custkey").orderBy(F.desc("o_orderstatus"), "o_custkey", "o_orderkey")


@query("O02_sort_by_rank", "SELECT flood_severity, count(*) AS n FROM {floods} GROUP BY 1 ORDER BY CASE flood_severity WHEN 'minor' THEN 1 WHEN 'moderate' THEN 2 WHEN 'major' THEN 3 ELSE 4 END")
def _(s):
    return s.floods.groupBy("flood_severity").agg(F.count("*").alias("n")).orderBy(label_rank("flood_severity", SEVERITIES))


@query("O03_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(s):
    return s.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("O04_top_k_per_group", """
    SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS rank
    FROM lineitem QUALIFY rank <= 10""")
def _(s):
    items = s.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    top = ordering.top_per_group(items, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_linenumber"], 10)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("O05_limit_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity LIMIT 5000")
def _(s):
    return s.lineitem.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity").limit(5000)


@query("O06_head_sample", "SELECT nation, customers FROM (SELECT c_nationkey AS nation, count(*) AS customers FROM customer GROUP BY 1 ORDER BY 1 LIMIT 5)")
def _(s):
    return s.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers")).orderBy("nation").limit(5)


# -- unions ---------------------------------------------------------------------------------------

@query("U01_unpivot", "SELECT collision_id, factor, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT collision_id, contributing_factor_vehicle_{i} AS factor FROM {{collisions}} WHERE contributing_factor_vehicle_{i} IS NOT NULL" for i in range(1, 6)) + ") GROUP BY ALL")
def _(s):
    return unions.unpivot_values(s.collisions.select("collision_id", *analytics.FACTOR_COLUMNS), ["collision_id"], analytics.FACTOR_COLUMNS,
                                 value="factor").groupBy("collision_id", "factor").agg(F.count("*").alias("n"))


@query("U02_diagonal_concat", """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment, NULL::INT AS p_size FROM customer UNION ALL BY NAME SELECT p_partkey AS key, p_name AS name, p_size FROM part""")
def _(s):
    return unions.diagonal_concat([s.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment"),
                                   s.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), "p_size")])


@query("U03_vertical_concat", "SELECT c_custkey AS key, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(s):
    return unions.vertical_concat([s.customer.selectExpr("c_custkey AS key", "c_acctbal AS balance"),
                                   s.supplier.selectExpr("s_suppkey AS key", "s_acctbal AS balance")])


@query("U04_relaxed_concat", "SELECT CAST(l_linenumber AS DOUBLE) AS x, CAST(l_linenumber AS BIGINT) AS y FROM lineitem UNION ALL SELECT o_totalprice, o_custkey FROM orders")
def _(s):
    return unions.relaxed_concat([s.lineitem.selectExpr("l_linenumber AS x", "l_linenumber AS y"),
                                  s.orders.selectExpr("o_totalprice AS x", "o_custkey AS y")])


SOURCES = [unions.YearSource("old", 1994, 1996), unions.YearSource("middle", 1996, 1998), unions.YearSource("new", 2000)]


@query("U05_year_routed_union", """
    SELECT year, source, count(*) AS n FROM (
        SELECT year(o_orderdate)::INT AS year, 'old' AS source FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996
        UNION ALL SELECT year(l_shipdate)::INT, 'middle' FROM lineitem WHERE year(l_shipdate) BETWEEN 1997 AND 1998
        UNION ALL SELECT year(o_orderdate)::INT, 'new' FROM orders WHERE year(o_orderdate) >= 2000) GROUP BY ALL""")
def _(s):
    orders = s.orders.select(F.year("o_orderdate").alias("year"))
    frames = {"old": orders, "middle": s.lineitem.select(F.year("l_shipdate").alias("year")), "new": orders}
    return unions.year_routed_union(frames, SOURCES).groupBy("year", "source").agg(F.count("*").alias("n"))
