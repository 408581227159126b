"""S: scans and sinks. Each query lands or stores a test table and reads it back."""

from pyspark.sql import functions as F, types as T

from civiclake.operators import ordering
from civiclake.operators.unions import diagonal_concat
from civiclake.sources import export, landing, pages, responses, storage, tables, views
from workload.registry import query

_ORDER_TEXT = ("CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
               "CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority")
_YM = "strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month"


def _orders(s):
    return s.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")


def _monthly(s):
    """orders with hive columns of their date."""
    return _orders(s).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                             F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "MM").alias("month"))


def land_raw_lines(df, root, header, key=None):
    """Landing files out of ready-made lines, so that some can be malformed."""
    lines = df.select(F.col(df.columns[0]).alias(header))
    storage.write_partition(lines, root, "csv", key, header=True, sep="\u0001", quote="\u0002", compression="gzip", maxRecordsPerFile=4000)


# One line in 23 lacks a field, one in 29 has one too many; both are skipped.
def _ragged(s):
    key = F.col("o_orderkey")
    fields = [key, F.col("o_custkey"), F.col("o_orderstatus")]
    return s.orders.select(F.when(key % 23 == 0, F.concat_ws(",", *fields[:2])).when(key % 29 == 0, F.concat_ws(",", *fields, F.lit("x")))
                           .otherwise(F.concat_ws(",", *fields)).alias("line"))


@query("S01_landing_scan", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status FROM orders WHERE o_orderkey % 23 <> 0 AND o_orderkey % 29 <> 0""")
def _(s):
    root = s.dir("ragged")
    land_raw_lines(_ragged(s), root, "id,customer,status")
    return landing.scan_landing(s.spark, root)


@query("S02_landing_sink", "SELECT doc_id::VARCHAR AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def _(s):
    # Texts hold line breaks, quotes and commas.
    root = s.dir("documents")
    landing.write_landing(s.documents.limit(0), root)
    landing.write_landing(s.documents, root, rows_per_shard=2000)  # replaces the shards above
    return landing.scan_landing(s.spark, root)


@query("S03_json_page_sink", "SELECT doc_id, text, lang FROM documents")
def _(s):
    root = s.dir("pages")
    pages.write_pages(s.documents.select("doc_id", "text", "lang"), root, records_per_page=500)
    return pages.scan_pages(s.spark, root, schema="doc_id bigint, text string, lang string")


@query("S04_json_page_scan", """
    SELECT conv_id, turn, role, text, count(*) OVER (PARTITION BY page) AS page_records FROM
    (SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 200 AS page FROM conversations)""")
def _(s):
    # One file per page of 200 records, each holding one JSON array.
    root = s.dir("conversation-pages")
    paged = ordering.page_index(s.conversations, ["conv_id", "turn"], 200)
    arrays = paged.groupBy("page").agg(F.to_json(F.sort_array(F.collect_list(F.struct("conv_id", "turn", "role", "text")))).alias("value"))
    storage.write_partition(arrays.select("value"), root, "text", maxRecordsPerFile=1)
    records = pages.scan_pages(s.spark, root, schema=s.conversations.schema, multi_line=True, with_file_name=True, pattern="*.txt")
    sizes = records.groupBy("page_file").agg(F.count("*").alias("page_records"))
    return records.join(sizes, "page_file").drop("page_file")


@query("S05_parquet_sink", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(s):
    root = s.dir("customer")
    tables.write_table(s.customer.limit(0), root)
    tables.write_table(s.customer, root)
    return tables.read_table(s.spark, root)


@query("S06_batched_sink", "SELECT count(*) AS row_count, sum(l_orderkey)::BIGINT AS keys, true AS bounded FROM lineitem")
def _(s):
    root = s.dir("lineitem")
    tables.write_batches(s.lineitem, root, rows_per_file=20_000)
    stored = tables.read_table(s.spark, root)
    per_file = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("k"))
    return per_file.agg(F.sum("n").alias("row_count"), F.sum("k").alias("keys"), (F.max("n") <= 20_000).alias("bounded"))


@query("S07_hive_write", f"SELECT o_orderkey, o_totalprice, {_YM} FROM orders")
def _(s):
    root = s.dir("orders")
    tables.write_hive(_orders(s).select("o_orderkey", "o_totalprice", "o_orderdate"), root, "o_orderdate")
    # Rewriting one year replaces its months only.
    again = _orders(s).where(F.year("o_orderdate") == 1996).select("o_orderkey", "o_totalprice", "o_orderdate")
    tables.write_hive(again, root, "o_orderdate")
    return tables.read_table(s.spark, root).drop("o_orderdate")


@query("S08_evolving_scan", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice END AS o_totalprice FROM orders""")
def _(s):
    # Years before 1998 were written without the price.
    root = s.dir("evolving")
    dated = _monthly(s)
    tables.write_hive(dated.where("year < '1998'").select("o_orderkey", "year"), root, grain="yearly")
    tables.write_hive(dated.where("year >= '1998'").select("o_orderkey", "o_totalprice", "year"), root, grain="yearly")
    return tables.read_table(s.spark, root)


@query("S09_load_partitions", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, strftime(o_orderdate, '%Y') AS year FROM orders")
def _(s):
    # The customer was a number before 1998 and text later.
    root = s.dir("drifted")
    dated = _monthly(s)
    tables.write_hive(dated.where("year < '1998'").select("o_orderkey", "o_custkey", "year"), root, grain="yearly")
    tables.write_hive(dated.where("year >= '1998'").selectExpr("o_orderkey", "CAST(o_custkey AS STRING) AS o_custkey", "year"), root, grain="yearly")
    assert tables.load_partitions(s.spark, root, ["1980"]) is None
    return tables.load_partitions(s.spark, root, [str(y) for y in range(1990, 2010)], cast_overrides={"o_custkey": "string"})


@query("S10_glob_read", "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders WHERE month(o_orderdate) IN (1, 10, 11, 12)")
def _(s):
    root = s.dir("globbed")
    tables.write_hive(_monthly(s).select("o_orderkey", "year", "month"), root)
    first = tables.read_glob(s.spark, f"{root}/year=*/month=01", hive_partitioning=True)
    rest = tables.read_glob(s.spark, f"{root}/year=*/month=1[0-2]/*.parquet", hive_partitioning=True)
    return first.unionByName(rest)


@query("S11_register_views", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(s):
    nation_csv = export.export(s.nation, "nation", "csv", s.dir("views"))
    done = views.register_views(s.spark, [nation_csv, f"{s.sf_dir}/region.parquet", f"{s.sf_dir}/nothing_here.parquet"],
                                ["view_nation", "view_region", "view_none"])
    assert done == ["view_nation", "view_region"]
    return s.spark.sql("SELECT n_name, r_name FROM view_nation JOIN view_region ON n_regionkey = r_regionkey")


@query("S12_register_tables", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(s):
    name = "stored_supplier_" + s.dir("t")[-12:]
    root = s.dir("stored")
    views.register_tables(s.spark, [f"{s.sf_dir}/supplier.parquet"], [name], location=root)
    return s.spark.table(name).select("s_suppkey", "s_name", "s_acctbal")


@query("S13_partitioned_view", f"SELECT month, count(*) AS n FROM (SELECT {_YM} FROM orders) WHERE year = '1997' GROUP BY 1")
def _(s):
    root = s.dir("orders-by-month")
    tables.write_hive(_monthly(s), root)
    assert views.register_partitioned_view(s.spark, root, "orders_by_month")
    return s.spark.sql("SELECT month, count(*) AS n FROM orders_by_month WHERE year = '1997' GROUP BY month")


@query("S14_bulk_register", "SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM orders) AS orders")
def _(s):
    base = s.dir("bulk")
    tables.write_table(s.customer, f"{base}/bulk_customer")
    tables.write_hive(_monthly(s), f"{base}/bulk_orders")
    assert views.bulk_register(s.spark, base, ["bulk_customer", "bulk_orders", "bulk_none"]) == ["bulk_customer", "bulk_orders"]
    return s.spark.sql("SELECT (SELECT count(*) FROM bulk_customer) AS customers, (SELECT count(*) FROM bulk_orders) AS orders")


@query("S15_mount_dependencies", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def _(s):
    analytics, clean = s.dir("analytics"), s.dir("clean")
    tables.write_table(s.customer.where("c_acctbal > 0"), f"{analytics}/mounted_customer")
    tables.write_table(s.customer, f"{clean}/mounted_customer")
    tables.write_table(s.nation, f"{clean}/mounted_nation")
    used = views.mount_dependencies(s.spark, ["mounted_customer", "mounted_nation"], [analytics, clean])
    assert used == {"mounted_customer": analytics, "mounted_nation": clean}
    return s.spark.sql("SELECT c_mktsegment, count(*) AS n FROM mounted_customer GROUP BY 1")


@query("S16_empty_stub", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS tier FROM customer")
def _(s):
    used = views.mount_dependencies(s.spark, ["mounted_tiers"], [s.dir("nowhere")], {"mounted_tiers": "custkey bigint, tier string"})
    assert used == {"mounted_tiers": None}
    return s.sql("SELECT c_custkey, tier FROM {customer} LEFT JOIN mounted_tiers ON custkey = c_custkey", "customer")


@query("S17_export", "SELECT c_mktsegment, count(*) AS n, 'parquet' AS format FROM customer GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*), 'csv' FROM customer GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*), 'json' FROM customer GROUP BY 1")
def _(s):
    result = s.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    folder = s.dir("exports")
    back = [views.read_file(s.spark, export.export(result, "segments", fmt, folder), fmt, schema="c_mktsegment string, n bigint")
            .withColumn("format", F.lit(fmt)) for fmt in export.EXPORT_FORMATS]
    return diagonal_concat(back)


@query("S18_sql_folder", "SELECT 'a_by_segment' AS name, count(DISTINCT c_mktsegment) AS n FROM customer UNION ALL SELECT 'b_positive', count(*) FROM customer WHERE c_acctbal > 0")
def _(s):
    import tempfile
    from pathlib import Path

    # The .sql files are small program text on the driver; their results go to the shared folder.
    with tempfile.TemporaryDirectory() as folder:
        Path(folder, "b_positive.sql").write_text("SELECT c_custkey FROM folder_customer WHERE c_acctbal > 0")
        Path(folder, "a_by_segment.sql").write_text("SELECT DISTINCT c_mktsegment FROM folder_customer")
        Path(folder, "c_blank.sql").write_text("  \n")
        s.customer.createOrReplaceTempView("folder_customer")
        results = export.run_sql_folder(s.spark, folder, "csv", s.dir("folder"))
    assert list(results) == ["a_by_segment", "b_positive"]
    return diagonal_concat([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in results.items()])


@query("S19_format_dispatch", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(s):
    folder = s.dir("fetched")
    supplier = s.supplier.select("s_suppkey", "s_name", "s_acctbal")
    third = F.col("s_suppkey") % 3
    paths = {fmt: export.export(supplier.where(third == i), "supplier", fmt, folder) for i, fmt in enumerate(export.EXPORT_FORMATS)}
    return diagonal_concat([views.read_file(s.spark, path, fmt, schema="s_suppkey bigint, s_name string, s_acctbal double")
                            for fmt, path in paths.items()])


TRANSACTION = "id string, agency string, amounts struct<adopted: string, spent: string>"


@query("S20_xml_scan", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Agency ' || CAST(o_custkey % 35 AS VARCHAR) AS agency,
           CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS adopted, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS spent FROM orders""")
def _(s):
    root = s.dir("xml")
    key = F.col("o_orderkey")
    amounts = F.when(key % 4 != 0, F.concat(F.lit("<amounts><adopted> "), F.col("o_custkey").cast("string"), F.lit("</adopted><spent>"), "o_orderstatus", F.lit(" </spent></amounts>"))).otherwise("")
    record = F.concat(F.lit("<transaction><id>"), key.cast("string"), F.lit("</id><agency> Agency "), (F.col("o_custkey") % 35).cast("string"),
                      F.lit("</agency>"), amounts, F.lit("</transaction>"))
    # A response per 2,000 orders; the status element comes first in each.
    response = (s.orders.groupBy(F.floor(key / 2000)).agg(F.array_join(F.collect_list(record), "").alias("records"))
                .select(F.concat(F.lit("<response><status><result>success</result></status><result_records>"), "records",
                                 F.lit("</result_records></response>")).alias("value")))
    response.write.mode("overwrite").option("maxRecordsPerFile", 1).text(root)
    return responses.scan_transactions(s.spark, root, TRANSACTION)


@query("S21_fixed_columns", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS VARCHAR) AS phone, c_name FROM customer")
def _(s):
    root = s.dir("fixed")
    landing.write_landing(landing.fixed_columns(s.customer, ["c_custkey", "phone", "c_name"]), root)
    return landing.scan_landing(s.spark, root)


def _weather(s, root, block, arrays, pattern, days):
    """Weather responses made of order totals: one response per period, arrays in time order."""
    step = F.date_format(F.col("t"), pattern).alias("time")
    hour = F.make_dt_interval(hours=F.col("o_custkey").cast("int") % 24)
    moment = F.col("o_orderdate") if days else F.col("o_orderdate") + hour
    base = s.orders.groupBy(moment.alias("t")).agg(F.count("*").alias("n"))
    values = []
    for i, name in enumerate(dict.fromkeys(arrays.values())):
        if name in ("sunrise", "sunset"):
            values.append(F.concat(F.date_format("t", "yyyy-MM-dd"), F.lit("T06:00")).alias(name))
        elif name == "weathercode":
            values.append((F.col("n") % 4).alias(name))
        else:
            values.append((F.col("n") / 8 + i).alias(name))
    rows = base.select(F.date_format("t", "yyyy-MM").alias("period"), F.struct(step, *values).alias("row"))
    packed = rows.groupBy("period").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    fields = ["time", *dict.fromkeys(arrays.values())]
    packed.select(F.struct(*[F.col(f"rows.{f}").alias(f) for f in fields]).alias(block)).write.mode("overwrite").json(root)
    # A response without data has no rows.
    s.spark.createDataFrame([("no data",)], "reason string").write.mode("append").json(root)


def _weather_sql(arrays, base):
    columns = []
    sources = list(dict.fromkeys(arrays.values()))
    for name, source in arrays.items():
        i = sources.index(source)
        value = "strftime(t, '%Y-%m-%d') || 'T06:00'" if source in ("sunrise", "sunset") else "n % 4" if source == "weathercode" else f"n / 8.0 + {i}"
        columns.append(f"CAST({value} AS DOUBLE) AS {name}" if source not in ("sunrise", "sunset", "weathercode") else f"{value} AS {name}")
    return f"SELECT strftime(t, '%Y-%m-%d %H:%M') AS date, {', '.join(columns)} FROM (SELECT {base} AS t, count(*) AS n FROM orders GROUP BY 1)"


@query("S22_daily_weather", _weather_sql(responses.DAILY_WEATHER, "o_orderdate"))
def _(s):
    root = s.dir("daily")
    _weather(s, root, "daily", responses.DAILY_WEATHER, "yyyy-MM-dd", True)
    return responses.scan_daily_weather(s.spark, root).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm"))


@query("S23_hourly_weather", _weather_sql(responses.HOURLY_WEATHER, "o_orderdate + CAST(o_custkey % 24 AS INT) * INTERVAL 1 HOUR"))
def _(s):
    root = s.dir("hourly")
    _weather(s, root, "hourly", responses.HOURLY_WEATHER, "yyyy-MM-dd'T'HH:mm", False)
    return responses.scan_hourly_weather(s.spark, root).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm"))


@query("S24_date_chunks", """
    WITH r AS (SELECT o_orderstatus, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1),
    c AS (SELECT o_orderstatus, b, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 30 DAY))::DATE AS chunk_start FROM r)
    SELECT o_orderstatus, chunk_start, least(chunk_start + 29, b)::DATE AS chunk_end FROM c""")
def _(s):
    ranges = s.orders.groupBy("o_orderstatus").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return responses.date_chunks(ranges, "a", "b", responses.DAILY_CHUNK_DAYS, keep=["o_orderstatus"])


@query("S25_page_plan", """
    SELECT row_offset // 7000 AS page, row_offset // 7000 * 7000 AS page_offset, count(*) AS row_count, min(l_orderkey) AS first_order, count(*) < 7000 AS is_final
    FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_offset FROM lineitem) GROUP BY ALL""")
def _(s):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    paged = ordering.page_index(s.lineitem.select(*keys), keys, 7000)
    return ordering.page_plan(paged, 7000, first={"first_order": "l_orderkey"}).withColumnRenamed("rows", "row_count")


@query("S26_slices_to_one_table", f"SELECT o_orderkey, o_totalprice, {_YM} FROM orders WHERE year(o_orderdate) = 1997")
def _(s):
    root = s.dir("slices")
    tables.write_hive(_monthly(s).select("o_orderkey", "o_totalprice", "year", "month"), root)
    keys = [f"1997-{m:02d}" for m in range(1, 13)]
    out = tables.combine_slices(tables.read_table(s.spark, root), s.dir("year-1997"), keys)
    return s.spark.read.parquet(out)
