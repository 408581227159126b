"""Q: row accounting and its verdicts, over landing and clean tables made of orders."""

from pyspark.sql import functions as F

from civiclake.operators import quality, unions
from civiclake.sources import landing, storage, tables
from workload.registry import query
from workload.sources import _ragged, land_raw_lines

# Landing: every order by month, except that nothing landed for April 1996, May 1996
# landed empty, and one line in 23 / 29 is malformed. Clean: well-formed orders by year, without
# the customers divisible by 50; 1999 has every order twice; 2030,
# outside the data, is clean only.
_GOOD = "(o_orderkey % 23 <> 0 AND o_orderkey % 29 <> 0)"
_LANDED = f"""
    landed AS (SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, o_orderkey, o_custkey, {_GOOD} AS good FROM orders
               WHERE strftime(o_orderdate, '%Y-%m') NOT IN ('1996-04', '1996-05')),
    clean AS (SELECT y, o_orderkey FROM landed WHERE good AND y <> 1999 AND (y > 1996 OR o_custkey % 50 <> 0)
              UNION ALL SELECT y, o_orderkey FROM landed WHERE good AND y = 1999 UNION ALL SELECT y, o_orderkey FROM landed WHERE good AND y = 1999
              UNION ALL SELECT 2030, o_orderkey FROM orders WHERE year(o_orderdate) = 2001),
    spine AS (SELECT y, m FROM (SELECT unnest(list_append(range(1995, 2002)::INT[], 2030)) AS y), (SELECT unnest(range(1, 13)) AS m)),
    months AS (SELECT s.y, s.m, count(l.o_orderkey) AS landing_rows, count(*) FILTER (l.good) AS parsed_rows,
                      count(l.o_orderkey) > 0 OR (s.y = 1996 AND s.m = 5) AS landed
               FROM spine s LEFT JOIN landed l ON l.y = s.y AND l.m = s.m GROUP BY s.y, s.m),
    years AS (SELECT y, count(*) FILTER (landed) AS months_materialized, count(*) FILTER (landing_rows > 0) AS months_with_data,
                     sum(landing_rows)::BIGINT AS landing_rows, sum(parsed_rows)::BIGINT AS parsed_rows FROM months GROUP BY y),
    counted AS (SELECT years.*, coalesce(c.n, 0) AS clean_rows FROM years LEFT JOIN (SELECT y, count(*) AS n FROM clean GROUP BY 1) c USING (y)),
    gaps AS (SELECT *, landing_rows - parsed_rows AS parse_gap, parsed_rows - clean_rows AS transform_gap FROM counted)"""


def _verdict(column: str, months: bool = False, allow: bool = False) -> str:
    """CASE over the verdict rules giving one of the three columns."""
    values = {"passed": ("true", "false", "false", "false", str(allow).lower(), "true"),
              "severity": ("'warn'", "'error'", "'error'", "'error'", "'warn'" if allow else "'error'", "'ok'"),
              "reason": ("'no_data_yet'", "'rows_lost_in_parsing'", "'row_expansion'", "'clean_is_empty'",
                         "'rows_filtered'" if allow else "'rows_lost_in_transform'", "'balanced'")}[column]
    conditions = ["months_materialized > 0 AND months_with_data = 0", "parse_gap > 0", "clean_rows > parsed_rows AND parsed_rows > 0",
                  "clean_rows = 0 AND landing_rows > 0", "transform_gap > 0"]
    arms = [f"WHEN {c} THEN {v}" for c, v in list(zip(conditions, values))[0 if months else 1:]]
    return f"CASE {' '.join(arms)} ELSE {values[5]} END AS {column}"


def _verdicts(months: bool = False, allow: bool = False) -> str:
    return ", ".join(_verdict(c, months, allow) for c in ("passed", "severity", "reason"))


def _layers(s, *, ragged: bool = True):
    """(landing root, clean root) as described above."""
    landing_root, clean_root = s.dir("landing"), s.dir("clean")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    orders = s.orders.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM")})
    orders = orders.where(~F.concat("year", "month").isin("199604", "199605"))
    fields = [key, F.col("o_custkey"), F.col("o_orderstatus")]
    line = F.concat_ws(",", *fields)
    if ragged:
        line = F.when(key % 23 == 0, F.concat_ws(",", *fields[:2])).when(key % 29 == 0, F.concat_ws(",", *fields, F.lit("x"))).otherwise(line)
    raw = orders.select(line.alias("id,customer,status"), "year", "month")
    storage.write_by_columns(raw, landing_root, "csv", ["year", "month"], header=True, sep="\u0001", quote="\u0002", compression="gzip")
    # A landed month without records: a shard with only a header.
    storage.write_partition(raw.limit(0).drop("year", "month"), landing_root, "csv", "1996-05", header=True, sep="\u0001", quote="\u0002")
    good = orders.where((key % 23 != 0) & (key % 29 != 0)) if ragged else orders
    kept = good.where((F.col("year") > "1996") | (F.col("o_custkey") % 50 != 0))
    late = s.orders.where(F.year(day) == 2001).withColumn("year", F.lit("2030"))
    clean = unions.diagonal_concat([kept.select("o_orderkey", "year"), good.where("year = '1999'").select("o_orderkey", "year"),
                                    late.select("o_orderkey", "year")])
    tables.write_hive(clean, clean_root, grain="yearly")
    return landing_root, clean_root


def _as_int(df, *cols):
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


@query("Q01_landing_record_counts", "SELECT sum(n)::BIGINT AS landing_rows, count(*) >= 1 AS has_files FROM (SELECT count(*) AS n FROM documents)")
def _(s):
    # Texts with line breaks are one record each.
    root = s.dir("documents")
    landing.write_landing(s.documents, root, rows_per_shard=1000)
    counts = quality.landing_file_counts(s.spark, root)
    return counts.agg(F.sum("landing_rows").alias("landing_rows"), (F.count("*") >= 1).alias("has_files"))


@query("Q02_parsed_record_counts", f"SELECT count(*) AS landing_rows, count(*) FILTER ({_GOOD}) AS parsed_rows FROM orders")
def _(s):
    root = s.dir("ragged")
    land_raw_lines(_ragged(s), root, "id,customer,status")
    return quality.landing_file_counts(s.spark, root).agg(F.sum("landing_rows").alias("landing_rows"), F.sum("parsed_rows").alias("parsed_rows"))


@query("Q03_clean_row_count", "SELECT 'orders' AS t, count(*) AS clean_rows FROM orders UNION ALL SELECT 'absent', 0")
def _(s):
    root = s.dir("orders")
    tables.write_table(s.orders, root)
    stored = quality.clean_counts(s.spark, root).withColumn("t", F.lit("orders"))
    return stored.unionByName(quality.clean_counts(s.spark, s.dir("nothing")).withColumn("t", F.lit("absent")))


@query("Q04_flat_accounting", f"""
    WITH gaps AS (SELECT *, landing_rows - parsed_rows AS parse_gap, parsed_rows - clean_rows AS transform_gap FROM
        (SELECT count(*) AS landing_rows, count(*) FILTER ({_GOOD}) AS parsed_rows, count(*) FILTER ({_GOOD} AND o_custkey % 50 <> 0) AS clean_rows FROM orders))
    SELECT *, {_verdicts()} FROM gaps""")
def _(s):
    landing_root, clean_root = s.dir("landing"), s.dir("clean")
    land_raw_lines(_ragged(s), landing_root, "id,customer,status")
    tables.write_table(landing.scan_landing(s.spark, landing_root).where("CAST(customer AS BIGINT) % 50 <> 0"), clean_root)
    return quality.flat_accounting(s.spark, landing_root, clean_root)


@query("Q05_monthly_landing", f"""
    WITH {_LANDED} SELECT y AS year, strftime(make_date(y, m::INT, 1), '%Y-%m') AS month_key, landed, landing_rows, parsed_rows,
    CASE WHEN NOT landed THEN 'not materialized' WHEN landing_rows > 0 THEN 'materialized' ELSE 'empty' END AS status FROM months""")
def _(s):
    landing_root, _ = _layers(s)
    return _as_int(quality.monthly_landing(s.spark, landing_root, [str(y) for y in [*range(1995, 2002), 2030]]), "year")


@query("Q06_verdicts", f"""
    WITH gaps AS (SELECT o_custkey AS id, *, landing_rows - parsed_rows AS parse_gap, parsed_rows - clean_rows AS transform_gap FROM (
        SELECT o_custkey, count(*) AS landing_rows, count(*) FILTER (o_orderkey % 40 <> 0) AS parsed_rows,
               CASE o_custkey % 5 WHEN 0 THEN count(*) + 1 WHEN 1 THEN 0 WHEN 2 THEN count(*) FILTER (o_orderkey % 3 <> 0) ELSE count(*) FILTER (o_orderkey % 40 <> 0) END AS clean_rows
        FROM orders GROUP BY 1))
    SELECT id, landing_rows, parsed_rows, clean_rows, parse_gap, transform_gap, {_verdicts()} FROM gaps""")
def _(s):
    parsed = F.count_if(F.col("o_orderkey") % 40 != 0)
    kind = F.col("id") % 5
    counts = s.orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").alias("landing_rows"), parsed.alias("parsed_rows"), F.count_if(F.col("o_orderkey") % 3 != 0).alias("some"))
    clean = F.when(kind == 0, F.col("landing_rows") + 1).when(kind == 1, 0).when(kind == 2, F.col("some")).otherwise(F.col("parsed_rows"))
    return quality.with_verdict(quality.with_gaps(counts.withColumn("clean_rows", clean).drop("some")))


@query("Q06_verdicts_with_filtering", f"""
    WITH {_LANDED} SELECT y AS year, parse_gap, transform_gap, {_verdicts(allow=True)} FROM (SELECT y, landing_rows, parsed_rows AS landing, parsed_rows, clean_rows, CAST(0 AS BIGINT) AS parse_gap, parsed_rows - clean_rows AS transform_gap
    FROM (SELECT y, parsed_rows AS landing_rows, parsed_rows, clean_rows FROM gaps))""")
def _(s):
    # Only well-formed lines are landed here, so what differs is the transform.
    landing_root, clean_root = _layers(s)
    counted = quality.monthly_accounting(s.spark, landing_root, clean_root, quality.discover_years(s.spark, clean_root))
    even = counted.select("year", F.col("parsed_rows").alias("landing_rows"), "parsed_rows", "clean_rows")
    return _as_int(quality.with_verdict(quality.with_gaps(even), allow_row_drop=True), "year") \
        .select("year", "parse_gap", "transform_gap", "passed", "severity", "reason")


@query("Q07_all_months_empty", f"""
    WITH {_LANDED}, judged AS (
        SELECT y, months_materialized, months_with_data, 12 - months_materialized AS months_missing, landing_rows, parsed_rows, parsed_rows AS clean_rows, landing_rows - parsed_rows AS parse_gap, 0 AS transform_gap
        FROM years WHERE y < 2030 UNION ALL SELECT 2030, 1, 0, 11, 0, 0, 0, 0, 0)
    SELECT y AS year, months_materialized, months_with_data, months_missing, landing_rows, clean_rows, {_verdicts(months=True)} FROM judged""")
def _(s):
    # Every landed year beside 2030, for which one month landed without records.
    landing_root, _ = _layers(s)
    clean_root = s.dir("clean")
    storage.write_partition(s.orders.select(F.lit("").alias("id,customer,status")).limit(0), landing_root, "csv", "2030-02", header=True, sep="\u0001", quote="\u0002")
    years = [str(y) for y in range(1995, 2002)]
    parsed = landing.scan_landing(s.spark, landing_root, years)
    tables.write_hive(parsed.select("id", "year"), clean_root, grain="yearly")
    judged = quality.monthly_accounting(s.spark, landing_root, clean_root, [*years, "2030"])
    return _as_int(judged, "year").select("year", "months_materialized", "months_with_data", "months_missing", "landing_rows", "clean_rows",
                                          "passed", "severity", "reason")


_ISSUES = """nullif(concat_ws('; ', CASE WHEN parse_gap > 0 THEN 'parse errors' END, CASE WHEN transform_gap > 0 THEN 'transform gap' END,
    CASE WHEN landing_rows > 0 AND clean_rows = 0 THEN 'landing has data but clean is empty' END), '') AS issues"""


@query("Q08_cross_partition_summary", f"""
    WITH {_LANDED} SELECT y AS year, months_with_data, months_materialized, landing_rows, parsed_rows, clean_rows, parse_gap, transform_gap, {_ISSUES} FROM gaps""")
def _(s):
    landing_root, clean_root = _layers(s)
    return _as_int(quality.cross_partition_summary(s.spark, landing_root, clean_root), "year")


@query("Q08_summary_totals", f"""
    WITH {_LANDED} SELECT count(*) AS total_partitions, sum(landing_rows)::BIGINT AS total_landing_rows, sum(clean_rows)::BIGINT AS total_clean_rows,
    sum(parse_gap)::BIGINT AS total_parse_gap, sum(transform_gap)::BIGINT AS total_transform_gap, count(issues) AS partitions_with_issues, true AS passed,
    CASE WHEN count(issues) > 0 THEN 'warn' ELSE 'ok' END AS severity FROM (SELECT *, {_ISSUES} FROM gaps)""")
def _(s):
    return quality.summary_totals(quality.cross_partition_summary(s.spark, *_layers(s)))


@query("Q09_discover_years", "SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders")
def _(s):
    root = s.dir("years")
    tables.write_hive(s.orders.select("o_orderkey", "o_orderdate"), root, "o_orderdate", grain="yearly")
    tables.write_table(s.region, f"{root}/year=archive")
    return s.spark.createDataFrame([(int(y),) for y in quality.discover_years(s.spark, root)], "year int")


SOURCES = [unions.YearSource("old", 1990, 1996), unions.YearSource("archive", 1997, 1998, layer="clean", grain="same_grain"),
           unions.YearSource("new", 1999, 2001)]
_ROUTED = f"""{_LANDED},
    routed AS (SELECT y, CASE WHEN y <= 1996 THEN 'old' WHEN y <= 1998 THEN 'archive' WHEN y <= 2001 THEN 'new' END AS active_source,
        CASE WHEN y > 2001 THEN 0 WHEN y IN (1997, 1998) THEN clean_rows ELSE landing_rows END AS landing_rows,
        CASE WHEN y > 2001 THEN 0 WHEN y IN (1997, 1998) THEN clean_rows ELSE parsed_rows END AS parsed_rows, clean_rows,
        CASE WHEN y NOT IN (1997, 1998) AND y <= 2001 THEN months_materialized END AS months_materialized,
        CASE WHEN y NOT IN (1997, 1998) AND y <= 2001 THEN months_with_data END AS months_with_data FROM gaps),
    judged AS (SELECT *, landing_rows - parsed_rows AS parse_gap, parsed_rows - clean_rows AS transform_gap FROM routed)"""


def _sources(s):
    landing_root, clean_root = _layers(s)
    return SOURCES, {"old": landing_root, "new": landing_root, "archive": clean_root}, clean_root


@query("Q10_dual_source_accounting", f"""
    WITH {_ROUTED} SELECT y AS year, active_source, landing_rows, parsed_rows, clean_rows, months_materialized, months_with_data, parse_gap, transform_gap,
    CASE WHEN active_source IS NULL THEN true ELSE passed END AS passed, CASE WHEN active_source IS NULL THEN 'warn' ELSE severity END AS severity,
    CASE WHEN active_source IS NULL THEN 'no_source' ELSE reason END AS reason FROM (SELECT *, {_verdicts(months=True)} FROM judged)""")
def _(s):
    sources, roots, clean_root = _sources(s)
    years = quality.discover_years(s.spark, clean_root)
    return _as_int(quality.dual_source_accounting(s.spark, sources, roots, clean_root, years), "year")


@query("Q11_dual_source_summary", f"WITH {_ROUTED} SELECT y AS year, active_source, landing_rows, parsed_rows, clean_rows, parse_gap, transform_gap, {_ISSUES} FROM judged")
def _(s):
    return _as_int(quality.dual_source_summary(s.spark, *_sources(s)), "year")


@query("Q12_nonempty_check", """
    SELECT 'some' AS result, count(*) AS row_count, count(*) > 0 AS passed FROM orders UNION ALL
    SELECT 'none', count(*), count(*) > 0 FROM orders WHERE o_totalprice < 0 UNION ALL SELECT 'never written', 0, false""")
def _(s):
    some, none = quality.nonempty_check(s.orders), quality.nonempty_check(s.orders.where("o_totalprice < 0"))
    absent = quality.stored_nonempty_check(s.spark, s.dir("absent"))
    named = [df.withColumn("result", F.lit(n)) for df, n in ((some, "some"), (none, "none"), (absent, "never written"))]
    return unions.diagonal_concat(named)


@query("Q13_transform_counts", """
    SELECT count(*) AS pre_transform_rows, count(*) FILTER (o_custkey % 10 <> 3) AS post_transform_rows, count(*) FILTER (o_custkey % 10 = 3) AS transform_row_delta FROM orders""")
def _(s):
    counts = quality.TransformCounts()
    tables.write_table(counts.watch(s.orders, lambda df: df.where("o_custkey % 10 <> 3")), s.dir("counted"))
    return counts.result(s.spark)


@query("Q14_dropped_rows", "SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_totalprice < 50000) AS dropped FROM orders WHERE o_totalprice < 50000")
def _(s):
    contract = {"o_orderkey": ("o_orderkey", "bigint"), "o_totalprice": ("o_totalprice", "double")}
    gone = quality.dropped_rows(s.orders.select("o_orderkey", "o_totalprice"), contract, lambda df: df.where("o_totalprice >= 50000"))
    path = s.dir("dropped")
    report = quality.report_dropped(gone, quality.Diagnostics(dropped_rows="full"), path)
    assert len(report["sample"]) == 20 and report["csv"] == path
    stored = s.spark.read.schema("o_orderkey bigint, o_totalprice double").csv(path, header=True)
    return stored.withColumn("dropped", F.lit(report["count"]).cast("bigint"))


@query("Q15_landing_keys_by_grain", f"""
    WITH {_LANDED} SELECT 'monthly_to_yearly' AS grain, count(*) AS parsed_rows FROM landed WHERE y = 1996 AND good
    UNION ALL SELECT 'unpartitioned', count(*) FROM landed WHERE good UNION ALL SELECT 'same_grain', count(*) FROM landed WHERE good AND y = 1997 AND m = 3""")
def _(s):
    landing_root, _ = _layers(s)
    wanted = {("monthly", "yearly"): "1996", (None, None): None, ("monthly", "monthly"): "1997-03"}
    parts = []
    for (low, high), key in wanted.items():
        grain = quality.infer_grain(low, high)
        keys = quality.landing_keys(s.spark, landing_root, key, grain)
        parts.append(landing.scan_landing(s.spark, landing_root, keys).agg(F.count("*").alias("parsed_rows")).withColumn("grain", F.lit(grain)))
    return unions.diagonal_concat(parts)
