"""Operators on skewed data against plain Python."""

import random
import re
from datetime import date
from statistics import median, quantiles

import pytest
from pyspark.sql import Window, functions as F

from civiclake.operators import dedup, filters, ordering, unions
from civiclake.operators.unions import YearSource


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 6,000 rows share one key; values repeat; one key is null."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(200)}", float(rng.randrange(300))) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "id int, k string, v double").repartition(7).cache()


def grouped(rows):
    out = {}
    for i, k, v in rows:
        out.setdefault(k, []).append((v, i))
    return out


def test_positions_of_a_hot_key(skewed):
    rows, df = skewed
    expected = {i: (place, len(members)) for members in grouped(rows).values() for place, (_, i) in enumerate(sorted(members), 1)}
    made = ordering.grouped_position(df, ["k"], ["v", "id"], group_size="size").collect()
    assert {r.id: (r.position, r["size"]) for r in made} == expected


def test_positions_when_one_value_fills_many_partitions(spark):
    df = spark.range(5000).select(F.lit("only").alias("k"), F.lit(1).alias("v"), "id").repartition(5)
    made = ordering.grouped_position(df, ["k"], ["v", ordering.desc("id")], group_size="n")
    assert made.where("position <> 5000 - id OR n <> 5000").isEmpty() and made.count() == 5000


def test_ranges_split_a_hot_key_and_need_no_checkpoint(spark, skewed):
    rows, df = skewed
    ranges = ordering.Ranges.of(df, [ordering.By("k"), ordering.desc("v"), ordering.By("id")])
    numbered = ranges.number(df).withColumnRenamed("__range", "r")
    sizes = numbered.where("k = 'hot'").groupBy("r").count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) < 600
    order = {i: n for n, (_, _, i) in enumerate(sorted((k or "", -v, i) for i, k, v in rows))}
    held = sorted((order[r.id], r.r) for r in numbered.collect())
    assert [r for _, r in held] == sorted(r for _, r in held)  # ranges follow the order
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_suppkey", "l_orderkey", "l_linenumber")
    plan = ordering.grouped_position(items.withColumn("l_suppkey", F.col("l_suppkey") % 3), ["l_suppkey"], ["l_orderkey", "l_linenumber"])._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"Scan ExistingRDD\[(\w+)", plan)) == {"__k0"} and "Exchange rangepartitioning" not in plan


@pytest.mark.parametrize("order", [[ordering.By("a", nulls_last=True), "b"], [ordering.desc("a"), ordering.desc("b")], [ordering.desc("a", nulls_last=False), "b"], ["a", "b"]])
def test_positions_with_nulls_nan_and_ties(spark, order):
    rng = random.Random(2)
    rows = [(rng.choice([None, "x", "y"]), rng.choice([None, -1.5, 0.0, 2.0, float("nan"), float("inf")]), k) for k in range(700)]
    df = spark.createDataFrame(rows, "k string, a double, b int").repartition(5)
    window = Window.partitionBy("k").orderBy(*[o.sort for o in ordering._as_order(order)])
    expected = {r.b: r.n for r in df.withColumn("n", F.row_number().over(window)).collect()}
    assert {r.b: r.position for r in ordering.grouped_position(df, ["k"], order).collect()} == expected
    whole = Window.orderBy(*[o.sort for o in ordering._as_order(order)])
    expected = {r.b: r.n for r in df.withColumn("n", F.row_number().over(whole)).collect()}
    assert {r.b: r.position for r in ordering.table_position(df, order).collect()} == expected
    assert ordering.grouped_position(df.limit(0), ["k"], order).count() == 0 and ordering.table_position(df.limit(0), order).count() == 0


def test_quantiles_of_odd_values(spark):
    values = [-1e300, -5.0, -0.0, 0.0, 1e-300, 3.0, 3.0, 7.5, 1e18, float("inf")]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 2.0), ("c", None)], "k string, v double")
    made = {r.k: r for r in ordering.grouped_quantiles(df, ["k"], {"v": {"low": 0.0, "mid": 0.5, "high": 8 / 9}}).collect()}
    assert (made["a"].low, made["a"].mid, made["a"].high) == (-1e300, pytest.approx(1.5), 1e18) and made["b"].mid == 2.0 and "c" not in made
    assert ordering.grouped_quantiles(df.limit(0), ["k"], "v", {"mid": 0.5}).count() == 0


def test_pages(skewed):
    rows, df = skewed
    paged = ordering.page_index(df, [ordering.desc("v"), "id"], 700)
    order = [i for i, _, _ in sorted(rows, key=lambda r: (-r[2], r[0]))]
    assert {r.id: r.row_offset for r in paged.collect()} == {i: n for n, i in enumerate(order)}
    plan = [tuple(r) for r in ordering.page_plan(paged, 700).orderBy("page").collect()]
    assert plan == [(p, p * 700, min(700, 6000 - p * 700), p == 8) for p in range(9)]


def test_quantiles_of_a_hot_key(skewed):
    rows, df = skewed
    made = {r.k: r for r in ordering.grouped_quantiles(df, ["k"], "v", {"mid": 0.5, "p95": 0.95, "low": 0.0, "top": 1.0}).collect()}
    for k, members in grouped(rows).items():
        values = sorted(v for v, _ in members)
        assert made[k].mid == pytest.approx(median(values)) and made[k].low == values[0] and made[k].top == values[-1]
        if len(values) > 1:
            assert made[k].p95 == pytest.approx(quantiles(values, n=100, method="inclusive")[94])


def test_duplicate_markers_of_a_hot_key(skewed):
    rows, df = skewed
    made = {r.id: (r._dedup_count, r._dedup_rank) for r in dedup.add_duplicate_markers(df, key_cols=["k"], rank_col="v", tiebreak=["id"]).collect()}
    for members in grouped(rows).values():
        for place, (v, i) in enumerate(sorted(members, key=lambda m: (-m[0], m[1])), 1):
            assert made[i] == (len(members), place)


def test_counts_per_key_include_null(skewed):
    rows, df = skewed
    sizes = {k: len(m) for k, m in grouped(rows).items()}
    assert {r.id: r._dedup_count for r in dedup.count_per_key(df, ["k"]).collect()} == {i: sizes[k] for i, k, _ in rows}


def test_preferred_rows(skewed):
    rows, df = skewed
    best = {sorted(members, key=lambda m: (-m[0], m[1]))[0][1] for members in grouped(rows).values()}
    kept = dedup.keep_preferred(df, key_cols=["k"], rank_col="v", tiebreak=["id"])
    assert {r.id for r in kept.collect()} == best
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_top_per_group_limits_before_the_shuffle(skewed):
    rows, df = skewed
    top = ordering.top_per_group(df, ["k"], [F.desc("v"), "id"], 3)
    expected = {(i, place) for members in grouped(rows).values() for place, (_, i) in enumerate(sorted(members, key=lambda m: (-m[0], m[1]))[:3], 1)}
    assert {(r.id, r["rank"]) for r in top.collect()} == expected
    plan = top._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert "Exchange hashpartitioning" in plan[before:after]  # one limit below the shuffle, one above


def test_concats(frame):
    a, b = frame("x int, y string", (1, "a")), frame("x int, z double", (2, 0.5))
    assert sorted(tuple(r) for r in unions.diagonal_concat([a, b]).collect()) == [(1, "a", None), (2, None, 0.5)]
    with pytest.raises(ValueError):
        unions.vertical_concat([a, b])
    with pytest.raises(ValueError):
        unions.relaxed_concat([a, b])
    assert unions.relaxed_concat([frame("x int", 1), frame("x double", 0.5)]).dtypes == [("x", "double")]


def test_unpivot_is_one_scan(frame):
    df = frame("id int, a string, b string", (1, "p", None), (2, None, None), (3, "q", "p"))
    made = unions.unpivot_values(df, ["id"], ["a", "b"], value="v")
    assert sorted(tuple(r) for r in made.collect()) == [(1, "p"), (3, "p"), (3, "q")]
    assert made._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert unions.unpivot_values(df, ["id"], ["a", "b"], value="v", source="from").columns == ["id", "from", "v"]


def test_year_routing(frame):
    sources = [YearSource("a", 2010, 2019), YearSource("b", 2015, 2021), YearSource("c", 2023)]
    assert [getattr(unions.active_source(sources, y), "name", None) for y in (2009, 2010, 2019, 2020, 2022, 2099)] == [None, "a", "a", "b", None, "c"]
    years = frame("year int", *range(2008, 2026))
    routed = unions.year_routed_union({s.name: years for s in sources}, sources)
    named = years.select("year", unions.route_column(sources, "year").alias("source")).where("source IS NOT NULL")
    assert sorted(map(tuple, routed.collect())) == sorted(map(tuple, named.collect()))


def test_filters(frame):
    df = frame("d date, k string, n int", (date(2024, 1, 1), "a", 1), (date(2024, 2, 1), "b", 2), (date(2024, 3, 1), "a", 3))
    assert df.where(filters.partition_filter("d", window=(date(2024, 1, 1), date(2024, 2, 1)))).count() == 1
    assert df.where(filters.partition_filter("k", kind="equality", key="a")).count() == 2
    assert df.where(filters.partition_filter("d")).count() == 3
    rules = [{"name": "d", "type": "range", "start": "2024-01-01", "end": "2024-03-01"}, {"name": "k", "type": "value", "value": "a"}]
    assert filters.apply_criteria(df, rules).count() == 2 and filters.apply_criteria(df, []).count() == 3
    assert filters.apply_criteria(df, rules, [{"name": "n", "type": "value", "value": 3}]).count() == 1
    with pytest.raises(ValueError):
        filters.apply_criteria(df, [{"name": "k", "type": "regex", "value": "a"}])
    with pytest.raises(ValueError):
        filters.partition_filter("d", kind="hash")
