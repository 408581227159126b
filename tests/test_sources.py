import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from civiclake.sources import catalog, export, landing, pages, responses, storage, tables, views


def shard(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("key, path", [
    (None, "r"), ("2024", "r/year=2024"), ("2024-05", "r/year=2024/month=05"), ("2024-05-17", "r/year=2024/month=05"),
    ("FY24", "r/FY24"), ("2024-xx", "r/2024-xx"), ("20245", "r/20245")])
def test_partition_paths(key, path):
    assert storage.partition_path("r", key) == path


def test_landing_scan_of_hand_made_shards(spark, tmp_path):
    root = tmp_path / "landing"
    shard(root / "year=2024" / "month=01", "a.csv.gz", 'id,name\n1,"two\nlines"\n2,"say ""hi"""\n3\n4,a,b\n5, padded \n')
    shard(root / "year=2024" / "month=02", "a.csv.gz", "id,name\n6,x\n")
    shard(root / "year=2024" / "month=03", "a.csv.gz", "id,name\n")
    df = landing.scan_landing(spark, str(root))
    assert set(df.dtypes) == {("id", "string"), ("name", "string"), ("year", "string"), ("month", "string")}
    assert {(r.id, r.name, r.month) for r in df.collect()} == {("1", "two\nlines", "01"), ("2", 'say "hi"', "01"), ("5", " padded ", "01"), ("6", "x", "02")}
    # A row is judged the same whichever columns a query uses.
    assert df.count() == 4 and df.select("id").count() == 4
    assert landing.scan_landing(spark, str(root), ["2024-02", "2024-09"]).count() == 1
    assert landing.scan_landing(spark, str(root), ["2024"]).count() == 4


def test_landing_scan_of_nothing(spark, tmp_path):
    empty = landing.scan_landing(spark, str(tmp_path / "none"), contract={"a": ("x", "int")})
    assert empty.columns == ["a"] and empty.count() == 0
    assert landing.scan_landing_records(spark, str(tmp_path / "none")) is None


def test_shards_with_other_headers_fail_loudly(spark, tmp_path):
    shard(tmp_path / "l", "a.csv.gz", "id,name\n1,x\n")
    shard(tmp_path / "l", "b.csv.gz", "name,id\nx,1\n")
    with pytest.raises(Exception):
        landing.scan_landing(spark, str(tmp_path / "l")).collect()


def test_landing_round_trip_replaces_only_its_partition(spark, frame, tmp_path):
    root = str(tmp_path / "l")
    tricky = frame("a string, b int", ('q"uote', 1), ("line\nbreak", 2), (" blank ", 3), ("comma, too", None))
    landing.write_landing(frame("a string, b int", ("old", 0)), root, "2024-01")
    landing.write_landing(frame("a string, b int", ("kept", 0)), root, "2024-02")
    landing.write_landing(tricky, root, "2024-01", rows_per_shard=2)
    assert {(r.a, r.b) for r in landing.scan_landing(spark, root, ["2024-01"]).collect()} == {('q"uote', "1"), ("line\nbreak", "2"), (" blank ", "3"), ("comma, too", None)}
    assert landing.scan_landing(spark, root).count() == 5
    report = landing.landing_report(spark, root, "2024-01").first()
    assert report.batches >= 1 and report.total_size_mb >= 0


def test_fixed_columns(frame):
    made = landing.fixed_columns(frame("b int, x string, a string", (1, "no", "y")), ["a", "b", "c"])
    assert made.dtypes == [("a", "string"), ("b", "string"), ("c", "string")] and tuple(made.first()) == ("y", "1", None)


def test_json_pages(spark, frame, tmp_path):
    root = tmp_path / "pages"
    root.mkdir()
    (root / "page_0000.json").write_text('[\n  {"a": 1, "b": "x"},\n  {"a": 2, "b": "y"}\n]')
    (root / "page_0001.json").write_text('{"a": 3, "b": "z"}')
    df = pages.scan_pages(spark, str(root), multi_line=True, with_file_name=True)
    assert sorted((r.page_file, r.a) for r in df.collect()) == [("page_0000.json", 1), ("page_0000.json", 2), ("page_0001.json", 3)]
    assert pages.scan_pages(spark, str(tmp_path / "none")).count() == 0
    pages.write_pages(frame("a int, b string", (1, None), (2, "x")), str(tmp_path / "out"), "2024")
    assert sorted(tuple(r) for r in pages.scan_pages(spark, str(tmp_path / "out"), "2024", schema="a int, b string").collect()) == [(1, None), (2, "x")]


def test_tables_evolve(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    tables.write_table(frame("a int", 1, 2), root, "2023")
    tables.write_table(frame("a int, b string", (3, "x"), (4, "y")), root, "2024")
    assert {tuple(r) for r in tables.read_table(spark, root).select("a", "b", "year").collect()} == {(1, None, "2023"), (2, None, "2023"), (3, "x", "2024"), (4, "y", "2024")}
    assert tables.read_table(spark, root, ["2024", "2025"]).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root, ["1999"])
    assert tables.load_partitions(spark, root, ["1999"]) is None
    assert tables.load_partitions(spark, root, ["2023", "1999", "2024"], cast_overrides={"a": "string"}).schema["a"].dataType.simpleString() == "string"


def test_hive_write_replaces_only_what_it_has(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    tables.write_hive(frame("a int, d date", (1, None)).selectExpr("a", "DATE'2024-01-05' AS d").union(frame("a int, d date", (2, None)).selectExpr("a", "DATE'2024-02-05' AS d")), root, "d")
    tables.write_hive(frame("a int, d date", (9, None)).selectExpr("a", "DATE'2024-02-07' AS d"), root, "d")
    assert {(r.a, r.year, r.month) for r in tables.read_table(spark, root).collect()} == {(1, "2024", "01"), (9, "2024", "02")}
    plan = tables.read_table(spark, root).where("year = '2024' AND month = '02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        tables.write_hive(frame("a int", 1), root, grain="daily")


def test_glob_reads(spark, frame, tmp_path):
    root = str(tmp_path / "g")
    for key in ("2023", "2024"):
        tables.write_table(frame("a int", 1, 2), root, key)
    assert tables.read_glob(spark, f"{root}/year=*/*.parquet").columns == ["a"]
    assert tables.read_glob(spark, f"{root}/year=*/*.parquet", hive_partitioning=True).where("year = 2023").count() == 2


def test_views(spark, frame, tmp_path):
    export.export(frame("a int", 1), "v", "csv", str(tmp_path))
    with pytest.raises(ValueError):
        views.register_views(spark, ["x"], ["a", "b"])
    with pytest.raises(ValueError):
        views.read_file(spark, "x", "orc")
    assert views.register_views(spark, [f"{tmp_path}/v.csv", f"{tmp_path}/none.csv"], ["v_csv", "v_none"]) == ["v_csv"]
    known = views.Catalogue(spark)
    known.register("known", frame("a int", 1, 2))
    assert known.sql("SELECT * FROM known WHERE a > :n", {"n": 1}).count() == 1
    with pytest.raises(KeyError):
        known.table("unknown")


def test_dependencies(spark, frame, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    tables.write_table(frame("x int", 1), f"{first}/dep_one")
    tables.write_table(frame("x int", 1, 2), f"{second}/dep_one")
    tables.write_table(frame("x int", 1), f"{second}/dep_two", "2024")
    used = views.mount_dependencies(spark, ["dep_one", "dep_two", "dep_three"], [first, second], {"dep_three": "x int, y string"})
    assert used == {"dep_one": first, "dep_two": second, "dep_three": None}
    assert [spark.table(t).count() for t in used] == [1, 1, 0] and spark.table("dep_three").columns == ["x", "y"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_export(spark, frame, tmp_path, fmt):
    path = export.export(frame("a int, b string", (1, "x,y"), (2, 'q"')), "out", fmt, str(tmp_path))
    assert path.endswith(f"out.{fmt}")
    assert sorted(tuple(r) for r in views.read_file(spark, path, fmt, schema="a int, b string").collect()) == [(1, "x,y"), (2, 'q"')]


def test_export_unknown(frame, tmp_path):
    with pytest.raises(ValueError):
        export.export(frame("a int", 1), "out", "xlsx", str(tmp_path))


def test_sql_folder(spark, tmp_path):
    (tmp_path / "b.sql").write_text("SELECT 2 AS x")
    (tmp_path / "a.sql").write_text("SELECT 1 AS x")
    (tmp_path / "c.sql").write_text(" \n")
    results = export.run_sql_folder(spark, str(tmp_path), "json", str(tmp_path / "out"))
    assert {k: v.first().x for k, v in results.items()} == {"a": 1, "b": 2} and list(results) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        export.run_sql_folder(spark, str(tmp_path / "none"), "csv", str(tmp_path / "out"))


XML = ("<response><status><result>{0}</result><messages><message><description>bad key</description></message></messages></status><result_records>"
       "<transaction><id> 1 </id><amounts><adopted>5</adopted><spent> 6 </spent></amounts></transaction><transaction><id>2</id></transaction></result_records></response>")


def test_xml(spark, tmp_path):
    (tmp_path / "ok.xml").write_text(XML.format("success"))
    rows = responses.scan_transactions(spark, str(tmp_path / "ok.xml"), "id string, amounts struct<adopted: string, spent: string>").collect()
    assert sorted(tuple(r) for r in rows) == [("1", "5", "6"), ("2", None, None)]
    (tmp_path / "bad.xml").write_text(XML.format("failure"))
    with pytest.raises(PySparkException, match="response failed: bad key"):
        responses.scan_transactions(spark, str(tmp_path / "bad.xml"), "id string").collect()
    mixed = responses.scan_transactions(spark, str(tmp_path / "*.xml"), "id string")
    with pytest.raises(PySparkException, match="bad key"):
        mixed.count()
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan xml") == 1
    (tmp_path / "none.xml").write_text("<response><status><result>success</result></status><result_records/></response>")
    assert responses.scan_transactions(spark, str(tmp_path / "none.xml"), "id string").count() == 0


def test_weather(spark, tmp_path):
    hourly = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [30.5, null], "precipitation": [0.0, 0.1], "rain": [0, 0], "weathercode": [3, 61]}}'
    (tmp_path / "h.json").write_text(hourly + '\n{"reason": "none"}\n')
    rows = responses.scan_hourly_weather(spark, str(tmp_path / "h.json")).collect()
    assert [(r.date.hour, r.temperature_2m, r.weather_code) for r in rows] == [(0, 30.5, 3), (1, None, 61)]
    assert responses.scan_daily_weather(spark, str(tmp_path / "h.json")).count() == 0


def test_date_chunks(frame):
    made = responses.date_chunks(frame("a string, b string", ("2024-01-01", "2024-01-20"), ("2024-02-01", "2024-02-01"), ("2024-03-02", "2024-03-01")), "a", "b", 7)
    assert [(str(r.chunk_start), str(r.chunk_end)) for r in made.collect()] == [
        ("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-14"), ("2024-01-15", "2024-01-20"), ("2024-02-01", "2024-02-01")]


def test_catalog(spark, frame, tmp_path):
    assert catalog.parse_table_ref("t") == ("spark_catalog", "default", "t")
    assert catalog.parse_table_ref("s.t") == ("spark_catalog", "s", "t") and catalog.parse_table_ref("c.s.t") == ("c", "s", "t")
    with pytest.raises(ValueError):
        catalog.describe(spark, "bad name; drop")
    spark.sql(f"CREATE TABLE known_table (a INT COMMENT 'An a', b STRING) USING parquet COMMENT 'Known' LOCATION '{tmp_path}/k'")
    assert [tuple(r) for r in catalog.describe(spark, "known_table", with_comments=True).collect()] == [("a", "int", "An a"), ("b", "string", None)]
    assert [tuple(r) for r in catalog.column_comments(spark, "known_table", include_empty=False).collect()] == [("a", "An a")]
    assert ("default", "known_table", "Known") in {tuple(r) for r in catalog.table_comments(spark).collect()}
    assert catalog.describe(spark, "default.unknown_table", with_comments=True).columns == ["column_name", "column_type", "comment"]
    assert catalog.list_tables(spark).where(F.col("name") == "known_table").first()["columns"] == 2


def test_declared_schemas_need_no_pass_over_the_files(spark, frame, tmp_path):
    root = f"{tmp_path}/evolved"
    tables.write_table(frame("a int", 1), root, "2023")
    tables.write_table(frame("a int, b string", (2, "x")), root, "2024")
    (tmp_path / "typed.csv").write_text("a,b\n1,2\n")

    def jobs(action):
        group = f"schemas-{action.__name__}"
        spark.sparkContext.setJobGroup(group, group)
        action()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    def declared():
        views.bulk_register(spark, str(tmp_path), ["evolved"], {"evolved": "a int, b string"})
        views.register_views(spark, [str(tmp_path / "typed.csv")], ["typed"], schemas={"typed": "a bigint, b string"})
        views.mount_dependencies(spark, ["evolved"], [str(tmp_path)], {"evolved": "a int, b string"})

    def merged():
        views.bulk_register(spark, str(tmp_path), ["evolved"])

    assert jobs(declared) == 0 < jobs(merged)
    views.mount_dependencies(spark, ["evolved"], [str(tmp_path)], {"evolved": "a int, b string"})
    assert sorted(tuple(r) for r in spark.table("evolved").select("a", "b", "year").collect()) == [(1, None, "2023"), (2, "x", "2024")]
    assert [tuple(r) for r in spark.table("typed").collect()] == [(1, "2")]
