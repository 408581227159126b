"""The named analytics tables, from clean tables to small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from civiclake.functions.geo import board_borough, board_number
from civiclake.functions.temporal import NEW_YORK, wall_time
from civiclake.functions.numeric import filled, ratio, sum_components
from civiclake.operators.ordering import top_per_group
from civiclake.operators.unions import unpivot_values

# Output prefix -> people counted in the collision columns.
CASUALTIES = {"total": "persons", "pedestrians": "pedestrians", "cyclists": "cyclist", "motorists": "motorist"}
OUTCOMES = ("injured", "killed")
FACTOR_COLUMNS = [f"contributing_factor_vehicle_{i}" for i in range(1, 6)]
UNSPECIFIED = "Unspecified"

# Tonnage columns.
RECYCLING = ["paper_tons_collected", "mgp_tons_collected"]
ORGANICS = ["res_organics_tons", "school_organic_tons", "leaves_organic_tons", "xmas_tree_tons", "other_organics_tons"]
REFUSE = "refuse_tons_collected"

# Heat complaints and community boards.
RESIDENTIAL_HEAT, OTHER_HEAT = "HEAT/HOT WATER", "Non-Residential Heat"
BOARD_RANGE, BOARDS_PER_BOROUGH = (101, 599), 18

# Air quality indicators.
NO2, PM25, OZONE = "Nitrogen dioxide (NO2)", "Fine particles (PM 2.5)", "Ozone (O3)"


# -- collisions -----------------------------------------------------------------------------------

def _total(col) -> Column:
    return F.sum(filled(col))


def _casualties() -> list[Column]:
    return [F.round(_total(f"number_of_{who}_{what}"), 0).alias(f"{out}_{what}")
            for out, who in CASUALTIES.items() for what in OUTCOMES]


def change_pct(col: str, order: str) -> Column:
    """Percentage change against the row before. Only for frames already reduced to one row per
    period: the window has a single partition."""
    before = F.lag(col).over(Window.orderBy(order))
    return ratio(F.col(col) - before, before, 1, 100)


def total_of(col: str) -> Column:
    """Sum of a column over the whole frame. Only for aggregates of a few rows: the window has a single partition."""
    return F.sum(col).over(Window.partitionBy())


def collisions_annual(collisions: DataFrame, since: int = 2013) -> DataFrame:
    """One row per year with casualties, rates and change against the year before."""
    yearly = (collisions.where(F.col("crash_date") >= F.make_date(F.lit(since), F.lit(1), F.lit(1)))
              .groupBy(F.year("crash_date").alias("crash_year"))
              .agg(F.count("*").alias("total_crashes"), *_casualties()))
    vulnerable = F.col("pedestrians_killed") + F.col("cyclists_killed")
    return yearly.withColumns({
        "fatalities_per_10k_crashes": ratio(F.col("total_killed"), F.col("total_crashes"), 2, 10_000),
        "vulnerable_user_fatality_pct": ratio(vulnerable, F.col("total_killed"), 1, 100),
        "crash_yoy_change_pct": change_pct("total_crashes", "crash_year"),
        "fatality_yoy_change_pct": change_pct("total_killed", "crash_year"),
    }).orderBy("crash_year")


def collisions_by_borough_month(collisions: DataFrame) -> DataFrame:
    dated = collisions.where(F.col("borough").isNotNull() & F.col("crash_date").isNotNull())
    keys = ["borough", F.year("crash_date").alias("crash_year"), F.month("crash_date").alias("crash_month")]
    return dated.groupBy(*keys).agg(
        F.count("*").alias("total_crashes"), *_casualties(),
        ratio(_total("number_of_persons_injured"), F.count("*"), 3).alias("injuries_per_crash"),
        ratio(_total("number_of_persons_killed"), F.count("*"), 2, 10_000).alias("fatalities_per_10k_crashes"),
    ).orderBy("borough", "crash_year", "crash_month")


def contributing_factors(collisions: DataFrame) -> DataFrame:
    """Involvements, casualties and share per factor. The five factor columns are unpivoted in one
    scan; the grand total is summed over the result, which has one row per factor."""
    people = [f"number_of_persons_{o}" for o in OUTCOMES]
    factors = unpivot_values(collisions.select("collision_id", *people, *FACTOR_COLUMNS),
                             ["collision_id", *people], FACTOR_COLUMNS, value="factor").where(F.col("factor") != UNSPECIFIED)
    injured, killed = (_total(p) for p in people)
    return factors.groupBy(F.col("factor").alias("contributing_factor")).agg(
        F.count("*").alias("crash_involvements"),
        F.countDistinct("collision_id").alias("distinct_crashes"),
        F.round(injured, 0).alias("total_injured"), F.round(killed, 0).alias("total_killed"),
        ratio(injured, F.count("*"), 2, 100).alias("injury_rate_pct"),
        ratio(killed, F.count("*"), 2, 10_000).alias("fatality_rate_per_10k"),
    ).withColumn("pct_of_all_involvements", ratio(F.col("crash_involvements"), total_of("crash_involvements"), 2, 100)) \
     .orderBy(F.desc("crash_involvements"))


# -- sanitation -----------------------------------------------------------------------------------

def month_part(col, part: int) -> Column:
    """Year (1) or month (2) out of ``YYYY / MM``."""
    return F.trim(F.split_part(F.col(col) if isinstance(col, str) else col, F.lit(" / "), F.lit(part))).try_cast("int")


def _recycling() -> Column:
    return sum_components(RECYCLING)


def _organics() -> Column:
    return sum_components(ORGANICS)


def _curbside() -> Column:
    """Refuse and recycling: what diversion is measured against."""
    return F.col(REFUSE) + _recycling()


def _stream_sums(columns: dict[str, str], digits: int) -> list[Column]:
    return [F.round(_total(c), digits).alias(name) for name, c in columns.items()]


def tonnage_annual(tonnage: DataFrame) -> DataFrame:
    return tonnage.groupBy(month_part("month", 1).alias("year")).agg(
        F.countDistinct("community_district").alias("districts_reporting"),
        F.count("*").alias("records"),
        F.round(F.sum(REFUSE), 0).alias("total_refuse_tons"),
        *_stream_sums({
            "total_paper_tons": RECYCLING[0], "total_mgp_tons": RECYCLING[1], "total_res_organics_tons": ORGANICS[0],
            "total_school_organics_tons": ORGANICS[1], "total_leaves_tons": ORGANICS[2],
            "total_xmas_tree_tons": ORGANICS[3], "total_other_organics_tons": ORGANICS[4]}, 0),
        F.round(F.sum(_recycling()), 0).alias("total_recycling_tons"),
        F.round(F.sum(_organics()), 0).alias("total_organics_tons"),
        F.round(F.sum(_curbside() + _organics()), 0).alias("grand_total_tons"),
        ratio(F.sum(_recycling()), F.sum(_curbside()), 1, 100).alias("recycling_diversion_pct"),
        ratio(F.sum(_organics()), F.sum(_curbside()), 1, 100).alias("organics_diversion_pct"),
    ).orderBy("year")


def tonnage_by_borough_month(tonnage: DataFrame) -> DataFrame:
    totals = tonnage.groupBy("month", "borough", "borough_id").agg(
        F.round(F.sum(REFUSE), 1).alias("refuse_tons"),
        *_stream_sums({"paper_tons": RECYCLING[0], "mgp_tons": RECYCLING[1]}, 1),
        F.round(F.sum(_organics()), 1).alias("organics_tons"),
        F.round(F.sum(_curbside() + _organics()), 1).alias("total_tons"),
        ratio(F.sum(_recycling()), F.sum(_curbside()), 1, 100).alias("recycling_pct"),
        F.countDistinct("community_district").alias("districts"),
    )
    return totals.withColumns({"year": month_part("month", 1), "month_num": month_part("month", 2)}) \
        .orderBy(F.desc("month"), "borough")


def district_rankings(tonnage: DataFrame) -> DataFrame:
    """Districts ranked over the five full years before the last one. There are a few dozen
    districts, so ranking the aggregate in one window is safe."""
    dated = tonnage.withColumn("year", month_part("month", 1))
    last = tonnage.select(F.max(month_part("month", 1))).scalar()
    ranked = dated.where(F.col("year").between(last - 5, last - 1)).groupBy("borough", "community_district").agg(
        F.count("*").alias("months_observed"),
        F.avg(REFUSE).alias("__refuse"),
        *[F.round(F.avg(filled(c)), 1).alias(name) for name, c in (
            ("avg_monthly_paper", RECYCLING[0]), ("avg_monthly_mgp", RECYCLING[1]), ("avg_monthly_organics", ORGANICS[0]))],
        F.round(F.sum(REFUSE), 0).alias("total_refuse"),
        F.round(F.sum(_recycling()), 0).alias("total_recycling"),
        (F.lit(100.0) * F.sum(_recycling()) / F.nullif(F.sum(_curbside()), F.lit(0))).alias("__rate"),
    )
    return ranked.withColumns({
        "avg_monthly_refuse": F.round("__refuse", 1),
        "recycling_rate_pct": F.round("__rate", 1),
        "refuse_rank_desc": F.rank().over(Window.orderBy(F.desc_nulls_last("__refuse"))),
        "recycling_rank_desc": F.rank().over(Window.orderBy(F.desc_nulls_last("__rate"))),
    }).drop("__refuse", "__rate").orderBy(F.desc("avg_monthly_refuse"))


def organics_rollout(tonnage: DataFrame, since: int = 2013) -> DataFrame:
    served = F.col(ORGANICS[0]) > 0
    # Only the parsed year is bounded: the stored text may open with blanks, a sign or zeros, which sort below any year.
    return (tonnage.withColumn("year", month_part("month", 1)).where(F.col("year") >= since)
            .groupBy("borough", "year").agg(
                F.countDistinct("community_district").alias("total_districts"),
                F.countDistinct(F.when(served, F.col("community_district"))).alias("districts_with_res_organics"),
                F.count_if(served).alias("district_months_with_organics"),
                *_stream_sums({"residential_organics_tons": ORGANICS[0], "school_organics_tons": ORGANICS[1],
                               "leaves_tons": ORGANICS[2]}, 0),
                F.round(F.sum(_organics()), 0).alias("total_organics_tons"),
                F.round(F.sum(REFUSE), 0).alias("total_refuse_tons"),
                ratio(F.sum(_organics()), F.sum(F.col(REFUSE) + _organics()), 2, 100).alias("organics_share_pct"),
            ).orderBy("borough", "year"))


# -- transport, complaints, air -------------------------------------------------------------------

def _ridership(grouped) -> DataFrame:
    return grouped.agg(
        F.count("*").alias("days_reported"),
        F.round(F.sum("count"), 0).alias("total_riders"),
        F.round(F.avg("count"), 1).alias("avg_daily_riders"),
        F.round(F.max("count"), 0).alias("peak_daily_riders"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).orderBy(F.desc("total_riders"))


def ridership_by_mode(ridership: DataFrame) -> DataFrame:
    return _ridership(ridership.groupBy("mode"))


def ridership_by_year(ridership: DataFrame) -> DataFrame:
    return _ridership(ridership.groupBy(F.year("date").alias("year"), "mode"))


def top_heat_properties(requests: DataFrame, k: int = 10, tz: str = NEW_YORK) -> DataFrame:
    """The ``k`` properties with most heat complaints in each of the canonical community boards; days and
    months are those of ``tz``."""
    board = F.col("cb_number")
    heat = requests.where(F.col("complaint_type").isin(RESIDENTIAL_HEAT, OTHER_HEAT) & F.col("bbl").isNotNull()
                          & board.between(*BOARD_RANGE) & board_number(board).between(1, BOARDS_PER_BOROUGH))
    wall = wall_time(requests, "created_date", tz)
    day = F.to_date(wall)
    per_property = heat.groupBy("cb_number", "bbl").agg(
        F.count("*").alias("heat_complaints"),
        F.count_if(F.col("complaint_type") == RESIDENTIAL_HEAT).alias("residential_heat"),
        F.count_if(F.col("complaint_type") == OTHER_HEAT).alias("non_residential_heat"),
        F.min(day).alias("first_complaint"), F.max(day).alias("last_complaint"),
        F.countDistinct(F.date_trunc("month", wall)).alias("months_with_complaints"))
    ranked = top_per_group(per_property, ["cb_number"], [F.desc("heat_complaints"), "bbl"], k, rank="rank_in_cb")
    return ranked.withColumns({"borough": board_borough(board), "cb_in_borough": board_number(board)}) \
        .orderBy("cb_number", "rank_in_cb")


def air_quality_annual(air: DataFrame, since: int = 2018) -> DataFrame:
    value = F.col("data_value")
    wanted = air.where(F.col("name").isin(NO2, PM25, OZONE) & (F.col("measure") == "Mean") & (F.col("year") >= since))
    stats = {"avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp}
    return wanted.groupBy("year", F.col("name").alias("indicator"), F.col("measure_info").alias("units")).agg(
        F.count("*").alias("observations"), F.countDistinct("geo_place_name").alias("neighborhoods"),
        *[F.round(fn(value), 3).alias(f"{name}_value") for name, fn in stats.items()],
    ).orderBy("indicator", "year")


def _millions(col: Column) -> Column:
    return F.round(F.sum(col) / 1e6, 1)


def era(year) -> Column:
    year = F.col(year)
    return (F.when(year == 2020, "pandemic_trough").when(year.between(2021, 2023), "recovery")
            .when(year >= 2024, "post_recovery").otherwise("pre_pandemic"))


def transit_vs_air(yearly_ridership: DataFrame, annual_air: DataFrame) -> DataFrame:
    """Ridership and pollution side by side per year; both sides are aggregated before the join."""
    def riders(mode):
        return _millions(F.when(F.col("mode") == mode, F.col("total_riders")))

    transit = yearly_ridership.groupBy("year").agg(
        _millions(F.col("total_riders")).alias("total_riders_millions"),
        riders("Subway").alias("subway_riders_millions"), riders("Bus").alias("bus_riders_millions"))
    air = annual_air.groupBy("year").agg(*[
        F.max(F.when(F.col("indicator") == name, F.col("avg_value"))).alias(out)
        for out, name in (("no2_ppb", NO2), ("pm25_mcg_per_m3", PM25), ("o3_ppb", OZONE))])
    return transit.join(air, "year", "left").withColumns({
        "era": era("year"),
        "pm25_no2_ratio": ratio(F.col("pm25_mcg_per_m3"), F.col("no2_ppb"), 3),
    }).orderBy("year")
