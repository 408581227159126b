from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest

from civiclake.plans import recipes
from civiclake.plans.recipes import Partition, Recipe, RecipeError
from civiclake.sources import tables

NY = ZoneInfo("America/New_York")
YEAR = Partition("2024", datetime(2024, 1, 1, tzinfo=NY), datetime(2025, 1, 1, tzinfo=NY))


def test_tokens_become_parameters():
    sql, args = recipes.bind_partition("a >= {{partition_start}} AND a < {{ partition_end }} AND k = {{partition_key}}", YEAR)
    assert sql == "a >= :partition_start AND a < :partition_end AND k = :partition_key"
    assert args == {"partition_start": date(2024, 1, 1), "partition_end": date(2025, 1, 1), "partition_key": "2024"}
    assert recipes.bind_partition("t >= {{partition_start_ts}}", YEAR)[1] == {"partition_start_ts": YEAR.start}
    assert recipes.bind_partition("SELECT 1", None) == ("SELECT 1", {})


@pytest.mark.parametrize("token", ["partition_start", "partition_end", "partition_start_ts", "partition_end_ts"])
def test_time_tokens_need_a_window(token):
    for partition in (None, Partition("2024")):
        with pytest.raises(RecipeError, match=token):
            recipes.bind_partition("x = {{" + token + "}}", partition)


@pytest.mark.parametrize("key, ok", [
    ("2024", True), ("2024-01", True), ("Dept of Health", True), ("a:b.c_d", True), ("x'; DROP", False), ("a\"b", False), ("f(x)", False), ("", False)])
def test_keys(key, ok):
    if ok:
        assert recipes.bind_partition("{{partition_key}}", Partition(key))[1] == {"partition_key": key}
    else:
        with pytest.raises(RecipeError):
            recipes.bind_partition("{{partition_key}}", Partition(key))
    with pytest.raises(RecipeError):
        recipes.bind_partition("{{partition_key}}")


def test_parameters_reach_spark(spark, frame):
    frame("d date, t timestamp, k string", (date(2024, 1, 1), datetime(2024, 1, 1, 5), "2024"), (date(2025, 1, 1), datetime(2025, 1, 1, 4, 59), "it's")).createOrReplaceTempView("bound")
    run = lambda where: recipes.query(spark, Recipe("r", f"SELECT count(*) FROM bound WHERE {where}"), YEAR).first()[0]
    assert run("d >= {{partition_start}} AND d < {{partition_end}}") == 1
    assert run("k = {{partition_key}}") == 1
    assert run("CAST(t AS TIMESTAMP) >= {{partition_start_ts}} AND t < {{partition_end_ts}}") == 2


def test_header():
    header, sql = recipes.split_header("/*---\nname: a\ndeps: [x, y]\n---*/\n\nSELECT 1")
    assert header == {"name": "a", "deps": ["x", "y"]} and sql == "SELECT 1"
    assert recipes.split_header("  SELECT 1") == ({}, "SELECT 1")
    with pytest.raises(RecipeError):
        recipes.split_header("/*---\na: [\n---*/ SELECT 1")


def test_discovery(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "one.sql").write_text("/*---\nname: renamed\ntags: {year: 2024}\ngroup: g\n---*/ SELECT 1")
    (tmp_path / "two.sql").write_text("SELECT 2")
    (tmp_path / "bad.sql").write_text("/*---\n: : [\n---*/ SELECT 3")
    (tmp_path / "binary.sql").write_bytes(b"\xff\xfe\x00bad")
    (tmp_path / "note.txt").write_text("no")
    found = {r.name: r for r in recipes.discover_recipes(tmp_path, {"two": ["extra"]})}
    assert set(found) == {"renamed", "two"}
    assert found["renamed"].tags == {"year": "2024"} and found["renamed"].group == "g" and found["two"].deps == ["extra"]


def test_partitions_of_a_recipe(spark):
    yearly = Recipe("r", "", partitions={"type": "yearly", "start": "2020", "end_offset": 1})
    got = recipes.recipe_partitions(spark, yearly, date(2022, 5, 1))
    assert [p.key for p in got] == ["2020", "2021", "2022"] and got[0].start == datetime(2020, 1, 1, tzinfo=NY)
    monthly = Recipe("r", "", partitions={"type": "monthly", "start": "2024-01-01", "end": "2024-03-15", "tz": "UTC"})
    assert [p.key for p in recipes.recipe_partitions(spark, monthly, date(2030, 1, 1))] == ["2024-01", "2024-02"]
    assert recipes.recipe_partitions(spark, Recipe("r", ""), date(2024, 1, 1)) == []
    with pytest.raises(RecipeError):
        recipes.recipe_partitions(spark, Recipe("r", "", partitions={"type": "monthly"}), date(2024, 1, 1))
    with pytest.raises(ValueError):
        recipes.recipe_partitions(spark, Recipe("r", "", partitions={"type": "weekly", "start": "2024"}), date(2024, 1, 1))


def test_run_and_backfill(spark, frame, tmp_path):
    clean, target = str(tmp_path / "clean"), str(tmp_path / "out")
    tables.write_table(frame("d date, n int", (date(2023, 5, 1), 1), (date(2024, 5, 1), 2), (date(2024, 6, 1), 3)), f"{clean}/backfill_input")
    recipe = Recipe("sums", "SELECT sum(n) AS n FROM backfill_input WHERE d >= {{partition_start}} AND d < {{partition_end}}", deps=["backfill_input"])
    years = [Partition("2023", datetime(2023, 1, 1, tzinfo=NY), YEAR.start), YEAR]
    assert tuple(recipes.backfill(spark, recipe, [clean], target, years).first()) == (2, True)
    tables.write_table(frame("d date, n int", (date(2024, 5, 1), 50)), f"{clean}/backfill_input")
    recipes.backfill(spark, recipe, [clean], target, years[1:])
    assert {(r.year, r.n) for r in tables.read_table(spark, f"{target}/sums").collect()} == {("2023", 1), ("2024", 50)}
    empty = recipes.run_recipe(spark, Recipe("none", "SELECT * FROM backfill_input WHERE false", deps=["backfill_input"]), [clean], target)
    assert tuple(empty.first()) == (0, False)


MONTHS = [Partition(f"2024-{m:02d}", datetime(2024, m, 1, tzinfo=NY), datetime(2024, m + 1, 1, tzinfo=NY)) for m in range(1, 5)]


@pytest.mark.parametrize("text", [
    "SELECT sum(n) AS n, count(*) AS c FROM fill WHERE d >= {{partition_start}} AND d < {{partition_end}}",
    "WITH w AS (SELECT * FROM fill WHERE d >= {{partition_start}} AND d < {{partition_end}}) SELECT k, sum(n) AS n FROM w GROUP BY k HAVING count(*) > 0",
    "SELECT k, n, rank() OVER (PARTITION BY k ORDER BY n) AS place FROM fill WHERE t >= {{partition_start_ts}} AND t < {{partition_end_ts}};",
    "SELECT '{{partition_key}}' AS label, k, 'x' AS month FROM fill WHERE date_format(d, 'yyyy-MM') = {{partition_key}}",
    "SELECT k, n FROM fill WHERE d >= {{partition_start}} AND d < {{partition_end}} ORDER BY n DESC LIMIT 1"])
def test_backfill_in_one_job_equals_one_per_partition(spark, frame, tmp_path, text):
    text = text.replace("'{{partition_key}}'", "{{partition_key}}")
    rows = [(date(2024, m, d), datetime(2024, m, d, 12), k, m * d) for m in (1, 2, 4) for d in (1, 20) for k in ("a", "b", None)]
    frame("d date, t timestamp, k string, n int", *rows).createOrReplaceTempView("fill")
    recipe, root = Recipe("r", text), str(tmp_path / "one")
    for partition in MONTHS:
        tables.write_table(recipes.query(spark, recipe, partition), root, partition.key)
    recipes.backfill(spark, recipe, [], str(tmp_path / "all"), MONTHS)
    read = lambda path: sorted(map(repr, (r.asDict().items() for r in tables.read_table(spark, path).select(*sorted(tables.read_table(spark, path).columns)).collect())))
    assert read(str(tmp_path / "all" / "r")) == read(root)


def test_backfill_is_one_write_and_clears_what_is_empty_now(spark, frame, tmp_path, monkeypatch):
    recipe = Recipe("r", "SELECT k, sum(n) AS n FROM fill WHERE d >= {{partition_start}} AND d < {{partition_end}} GROUP BY k")
    frame("d date, k string, n int", *[(date(2024, m, 1), "a", m) for m in (1, 2, 3)]).createOrReplaceTempView("fill")
    one_by_one = []
    monkeypatch.setattr(recipes, "query", lambda *a: one_by_one.append(a))
    plan = recipes.query_partitions(spark, recipe, MONTHS)._jdf.queryExecution().executedPlan().toString()
    # The partitions are sent to the data, not the data to the partitions.
    assert "CartesianProduct" not in plan and plan.count("BroadcastNestedLoopJoin BuildLeft") == plan.count("BroadcastNestedLoopJoin") == 1
    recipes.backfill(spark, recipe, [], str(tmp_path), MONTHS)
    frame("d date, k string, n int", (date(2024, 2, 1), "a", 7), (date(2024, 4, 2), "a", 9)).createOrReplaceTempView("fill")
    recipes.backfill(spark, recipe, [], str(tmp_path), MONTHS[:2])  # January is empty now; March stays as it was
    assert {(r.month, r.n) for r in tables.read_table(spark, f"{tmp_path}/r").collect()} == {("02", 7), ("03", 3)}
    assert one_by_one == []
    with pytest.raises(RecipeError):
        recipes.backfill(spark, recipe, [], str(tmp_path), [Partition("2024-01"), Partition("2024-02")])
