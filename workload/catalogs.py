"""K: tables and columns by name, joined with what the test tables hold."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from civiclake import contracts
from civiclake.sources import catalog, tables
from civiclake.sources.views import Catalogue
from workload.registry import query

_TABLES = ["customer", "nation", "orders", "part"]


@contextmanager
def _store(s, schema):
    """A schema of external tables over the given files, dropped again; frames made of them stay readable."""
    name = f"{schema}_{uuid.uuid4().hex[:10]}"
    s.spark.sql(f"CREATE DATABASE {name} LOCATION '{s.dir(name)}'")
    try:
        for t in _TABLES:
            s.spark.catalog.createTable(f"{name}.{t}", path=f"{s.sf_dir}/{t}.parquet", source="parquet")
        yield name
    finally:
        s.spark.sql(f"DROP DATABASE {name} CASCADE")


@query("K01_list_tables", "SELECT * FROM (SELECT 'customer' AS name, 5 AS columns, count(*) AS n FROM customer UNION ALL SELECT 'nation', 3, count(*) FROM nation "
       "UNION ALL SELECT 'orders', 6, count(*) FROM orders UNION ALL SELECT 'part', 6, count(*) FROM part)")
def _(s):
    with _store(s, "listing") as schema:
        listed = catalog.list_tables(s.spark, schema).where(F.col("schema") == schema).select("name", "columns")
        counts = [s.spark.table(f"{schema}.{t}").agg(F.count("*").alias("n")).withColumn("name", F.lit(t)) for t in _TABLES]
        from civiclake.operators.unions import vertical_concat

        return listed.join(vertical_concat(counts), "name")


@query("K02_list_stored_tables", "SELECT 'customer' AS \"table\", 3 AS files, true AS sized, (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'supplier', 1, true, (SELECT count(*) FROM supplier)")
def _(s):
    base = s.dir("stored")
    tables.write_table(s.customer.repartition(3), f"{base}/customer")
    tables.write_table(s.supplier.coalesce(1), f"{base}/supplier")
    listed = catalog.list_stored_tables(s.spark, base)
    counts = [tables.read_table(s.spark, f"{base}/{t}").agg(F.count("*").alias("n")).withColumn("table", F.lit(t)) for t in ("customer", "supplier")]
    return listed.join(counts[0].unionByName(counts[1]), "table").select("table", F.col("files").cast("int").alias("files"), (F.col("size_mb") >= 0).alias("sized"), "n")


@query("K03_describe", """
    SELECT d.column_name, d.column_type, n FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'), ('c_mktsegment', 'string')) d(column_name, column_type)
    JOIN (SELECT unnest(['c_custkey','c_name','c_nationkey','c_acctbal','c_mktsegment']) AS column_name,
                 unnest([count(DISTINCT c_custkey), count(DISTINCT c_name), count(DISTINCT c_nationkey), count(DISTINCT c_acctbal), count(DISTINCT c_mktsegment)]) AS n FROM customer) USING (column_name)""")
def _(s):
    with _store(s, "describing") as schema:
        assert catalog.describe(s.spark, f"{schema}.unknown").isEmpty()
        names = s.customer.columns
        counts = s.customer.agg(*[F.countDistinct(c).alias(c) for c in names]).unpivot([], names, "column_name", "n")
        return catalog.describe(s.spark, f"{schema}.customer").join(counts, "column_name")


@query("K04_table_comments", "SELECT 'orders' AS table_name, 'All orders' AS comment, count(*) AS n FROM orders")
def _(s):
    with _store(s, "commented") as schema:
        s.spark.sql(f"COMMENT ON TABLE {schema}.orders IS 'All orders'")
        noted = catalog.table_comments(s.spark, schema)
        assert catalog.table_comments(s.spark, schema, include_empty=True).count() == len(_TABLES)
        counts = s.spark.table(f"{schema}.orders").agg(F.count("*").alias("n")).withColumn("table_name", F.lit("orders"))
        return noted.select("table_name", "comment").join(counts, "table_name")


@query("K05_column_comments", """
    SELECT column_name, comment, n FROM (VALUES ('id', 'Customer id'), ('balance', 'Account balance'), ('segment', NULL)) d(column_name, comment)
    JOIN (SELECT unnest(['id','balance','segment']) AS column_name, unnest([count(c_custkey), count(c_acctbal), count(c_mktsegment)]) AS n FROM customer) USING (column_name)""")
def _(s):
    contract = {"c_custkey": ("id", "bigint", "Customer id"), "c_acctbal": ("balance", "double", "Account balance"), "c_mktsegment": ("segment", "string", "")}
    made = contracts.with_comments(contracts.apply_schema_contract(s.customer, contract), contracts.build_table_schema(contract))
    name = "noted_" + s.dir("c")[-10:]
    made.write.option("path", s.dir(name)).saveAsTable(name)
    counts = made.agg(*[F.count(c).alias(c) for c in made.columns]).unpivot([], made.columns, "column_name", "n")
    return catalog.column_comments(s.spark, name).join(counts, "column_name")


@query("K06_table_references", "SELECT ref, n FROM (VALUES ('one'), ('two'), ('three')) r(ref), (SELECT count(*) AS n FROM part)")
def _(s):
    with _store(s, "referenced") as schema:
        s.spark.table(f"{schema}.part").createOrReplaceTempView("referenced_part")
        refs = {"one": "referenced_part", "two": f"{schema}.part", "three": f"spark_catalog.{schema}.part"}
        assert catalog.parse_table_ref("a.b.c") == ("a", "b", "c") and catalog.parse_table_ref("t")[1] == "default"
        from civiclake.operators.unions import vertical_concat

        return vertical_concat([s.spark.table(catalog.full_name(s.spark, r)).agg(F.count("*").alias("n")).select(F.lit(k).alias("ref"), "n") for k, r in refs.items()])


@query("K07_adhoc_sql", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 100 AND c_mktsegment <> 'O''Hara' GROUP BY 1")
def _(s):
    known = Catalogue(s.spark)
    known.register("adhoc_customer", s.customer)
    assert known.table("adhoc_customer").columns == s.customer.columns
    return known.sql("SELECT c_mktsegment, count(*) AS n FROM adhoc_customer WHERE c_acctbal > :least AND c_mktsegment <> :name GROUP BY 1", {"least": 100.0, "name": "O'Hara"})
