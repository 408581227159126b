"""Ad-hoc reports over city tables, as functions of their input frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from civiclake.functions.classify import SEVERITIES, label_rank
from civiclake.functions.numeric import ratio
from civiclake.functions.temporal import NEW_YORK, wall_time
from civiclake.operators.filters import contains_any
from civiclake.operators.ordering import grouped_quantiles

# Borough names and water complaints used by the flood study.
BOROUGH_NAMES = ("BROOKLYN", "QUEENS", "BRONX", "MANHATTAN", "STATEN ISLAND")
WATER_WORDS = ("flood", "sewer", "water", "drain", "storm")
WATER_COMPLAINTS = ("Sewer", "Standing Water", "Water System")
WATER_COMPLAINTS_WIDE = WATER_COMPLAINTS + ("Water Quality",)
SEASONS = ("winter", "spring", "summer", "fall")
# Least floods per day of each intensity bucket.
INTENSITIES = ((10, "major_flood_day (10+)"), (5, "moderate_flood_day (5-9)"), (3, "minor_flood_day (3-4)"))
LOW_INTENSITY = "no/low_flood_day (0-2)"


def _share(condition: Column, digits: int = 1) -> Column:
    return ratio(F.count_if(condition), F.count("*"), digits, 100)


def _rounded(fn, col: str, digits: int = 0) -> Column:
    return F.round(fn(col), digits)


def top_counts(df: DataFrame, keys: list, k: int | None = None, *, name: str = "n") -> DataFrame:
    """Rows per key, most first. With ``k`` only the top ones, cut before the final merge; ties at
    the cut go to the smaller key."""
    counted = df.groupBy(*keys).agg(F.count("*").alias(name))
    ordered = counted.orderBy(F.desc(name), *counted.columns[:len(keys)])
    return ordered.limit(k) if k else ordered


# -- payroll --------------------------------------------------------------------------------------

def top_paying_agencies(payroll: DataFrame, year: int, k: int = 10) -> DataFrame:
    paid = F.col("regular_gross_paid") + F.col("total_ot_paid") + F.col("total_other_pay")
    return payroll.where(F.col("fiscal_year") == year).groupBy("agency_name").agg(
        F.count("*").alias("workers"), F.round(F.sum(paid), 0).alias("total_pay")).orderBy(F.desc("total_pay"), "agency_name").limit(k)


def salary_quantiles(payroll: DataFrame, year: int) -> DataFrame:
    """Exact median and 95th percentile per pay basis, computed by position (no gathered groups)."""
    paid = payroll.where((F.col("fiscal_year") == year) & (F.col("base_salary") > 0))
    basics = paid.groupBy("pay_basis").agg(F.count("*").alias("workers"), _rounded(F.max, "base_salary").alias("max_base"))
    middles = grouped_quantiles(paid, ["pay_basis"], "base_salary", {"median_base": 0.5, "p95_base": 0.95})
    rounded = middles.select("pay_basis", *[F.round(c, 0).alias(c) for c in ("median_base", "p95_base")])
    return basics.join(rounded, "pay_basis").orderBy(F.desc("median_base"))


def overtime_ratios(payroll: DataFrame, year: int, least_paid: float = 1e7, k: int = 10) -> DataFrame:
    sums = payroll.where(F.col("fiscal_year") == year).groupBy("agency_name").agg(
        F.sum("total_ot_paid").alias("ot"), F.sum("regular_gross_paid").alias("regular"))
    return sums.where(F.col("regular") > least_paid).select(
        "agency_name", F.round("ot", 0).alias("ot_paid"), F.round("regular", 0).alias("regular_paid"),
        ratio(F.col("ot"), F.col("regular"), 3).alias("ot_ratio")).orderBy(F.desc("ot_ratio"), "agency_name").limit(k)


# -- restaurants ----------------------------------------------------------------------------------

def grade_shares(inspections: DataFrame, least: int = 5000, k: int = 15) -> DataFrame:
    grades = ("A", "B", "C")
    return (inspections.where(F.col("grade").isin(*grades)).groupBy("cuisine_description")
            .agg(F.count("*").alias("inspections"), *[_share(F.col("grade") == g).alias(f"pct_{g}") for g in grades])
            .where(F.col("inspections") > least).orderBy(F.desc("inspections"), "cuisine_description").limit(k))


def common_violations(inspections: DataFrame, k: int = 10) -> DataFrame:
    critical = inspections.where((F.col("critical_flag") == "Critical") & F.col("violation_description").isNotNull())
    return top_counts(critical, ["violation_description"], k, name="occurrences")


def worst_inspections(inspections: DataFrame, year: int, boro: str, k: int = 10) -> DataFrame:
    return (inspections.where((F.col("year") == year) & (F.col("boro") == boro) & F.col("score").isNotNull())
            .select("dba", "cuisine_description", "score", "grade", "inspection_date")
            .orderBy(F.desc("score"), "dba", "cuisine_description", "inspection_date").limit(k))


# -- shootings ------------------------------------------------------------------------------------

def _murders() -> Column:
    return F.count_if(F.col("stat_murder_flg") == "true")


def shootings_by_year(shootings: DataFrame, first: int, last: int) -> DataFrame:
    return (shootings.where(F.col("year").between(first, last)).groupBy("year", "boro")
            .agg(F.count("*").alias("victims")).orderBy("year", F.desc("victims")))


def murder_rates(shootings: DataFrame) -> DataFrame:
    return shootings.groupBy("victim_age_group").agg(
        F.count("*").alias("shootings"), _murders().alias("murders"),
        _share(F.col("stat_murder_flg") == "true").alias("pct_fatal")).orderBy(F.desc("shootings"))


def top_precincts(shootings: DataFrame, year: int, k: int = 10) -> DataFrame:
    return (shootings.where(F.col("year") == year).groupBy("precinct", "boro")
            .agg(F.count("*").alias("victims"), _murders().alias("murders"))
            .orderBy(F.desc("victims"), "precinct", "boro").limit(k))


# -- housing --------------------------------------------------------------------------------------

def units_by_income(housing: DataFrame) -> DataFrame:
    bands = ("ext_low", "very_low", "low", "moderate", "middle", "above")
    return housing.agg(*[_rounded(F.sum, f"applied_income_ami_{b}").alias(f"units_{b}") for b in bands])


def largest_lotteries(housing: DataFrame, k: int = 10) -> DataFrame:
    sizes = {"studios": "studio", "one_br": "1bed", "two_br": "2bed", "three_br": "3bed"}
    return (housing.where(F.col("unit_count").isNotNull()).select(
        "lottery_name", "borough", "unit_count",
        *[F.col(f"unit_distribution_{c}").alias(name) for name, c in sizes.items()], "lottery_status")
        .orderBy(F.desc("unit_count"), "lottery_name").limit(k))


def lotteries_by_borough(housing: DataFrame) -> DataFrame:
    return housing.where(F.col("borough").isNotNull()).groupBy("borough").agg(
        F.count("*").alias("lotteries"), _rounded(F.avg, "lottery_duration_days").alias("avg_duration_days"),
        F.sum("unit_count").alias("total_units")).orderBy(F.desc("total_units"))


# -- air ------------------------------------------------------------------------------------------

def indicator_counts(air: DataFrame, k: int = 15) -> DataFrame:
    return (air.where(F.col("data_value").isNotNull()).groupBy(F.col("name").alias("indicator"), "measure").agg(
        F.count("*").alias("readings"), _rounded(F.min, "data_value", 2).alias("min_val"),
        _rounded(F.max, "data_value", 2).alias("max_val")).orderBy(F.desc("readings"), "indicator", "measure").limit(k))


def worst_neighborhoods(air: DataFrame, indicator: str, since: int, k: int = 10) -> DataFrame:
    return (air.where((F.col("name") == indicator) & (F.col("year") >= since) & F.col("geo_type_name").like("%Neighborhood%"))
            .groupBy("geo_place_name", "year").agg(_rounded(F.avg, "data_value", 2).alias("avg_pm25"))
            .orderBy(F.desc("avg_pm25"), "geo_place_name", "year").limit(k))


def citywide_trend(air: DataFrame, indicator: str) -> DataFrame:
    return (air.where((F.col("name") == indicator) & F.col("year").isNotNull()).groupBy("year").agg(
        _rounded(F.avg, "data_value", 2).alias("avg_no2"), F.countDistinct("geo_place_name").alias("sites")).orderBy("year"))


# -- floods and complaints ------------------------------------------------------------------------

def water_complaint_types(requests: DataFrame) -> DataFrame:
    return top_counts(requests.where(contains_any("complaint_type", list(WATER_WORDS))), ["complaint_type"], name="cnt")


def _placed(floods: DataFrame, since: int | None = None) -> DataFrame:
    placed = floods.where(F.col("borough").isNotNull())
    return placed.where(F.col("flood_year") >= since) if since else placed


def _depth() -> Column:
    return _rounded(F.avg, "max_depth_inches", 1).alias("avg_depth")


def _events() -> Column:
    return F.count("*").alias("flood_events")


def floods_by_borough(floods: DataFrame) -> DataFrame:
    return _placed(floods).groupBy("borough").agg(
        _events(), _depth(), _rounded(F.avg, "duration_mins").alias("avg_duration_mins")).orderBy(F.desc("flood_events"))


def flood_range(floods: DataFrame) -> DataFrame:
    return floods.agg(F.min("flood_start_time").alias("earliest"), F.max("flood_start_time").alias("latest"),
                      F.count("*").alias("total_events"))


def _complaints(requests: DataFrame, keys: list, words) -> DataFrame:
    """Complaints per key, aggregated before any join so that hot keys shrink first."""
    return requests.groupBy(*keys).agg(
        F.count("*").alias("total_311"), F.count_if(F.col("complaint_type").isin(*words)).alias("water_complaints"))


def _in_boroughs(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("borough").isin(*BOROUGH_NAMES))


def _upper(col: str = "borough") -> Column:
    return F.upper(col).alias("match_borough")


def monthly_floods_and_complaints(floods: DataFrame, requests: DataFrame, since: int = 2024) -> DataFrame:
    by_month = _placed(floods, since).groupBy("borough", "flood_year", "flood_month").agg(_events(), _depth())
    asked = _complaints(_in_boroughs(requests), [_upper(), F.col("year").alias("flood_year"), F.col("month").alias("flood_month")],
                        WATER_COMPLAINTS)
    keys = ["match_borough", "flood_year", "flood_month"]
    return by_month.withColumn("match_borough", F.upper("borough")).join(asked, keys).drop("match_borough") \
        .orderBy("flood_year", "flood_month", "borough")


def floods_and_complaints_by_zip(floods: DataFrame, requests: DataFrame, since: int = 2024, k: int = 20) -> DataFrame:
    wet = floods.where(F.col("zipcode").isNotNull() & (F.col("flood_year") >= since)).groupBy("zipcode").agg(
        _events(), _depth(), _rounded(F.avg, "duration_mins").alias("avg_duration"))
    asked = _complaints(requests.where(F.col("incident_zip").isNotNull()), [F.col("incident_zip").alias("zipcode")],
                        WATER_COMPLAINTS_WIDE)
    return wet.join(asked, "zipcode").withColumn(
        "water_pct", ratio(F.col("water_complaints"), F.col("total_311"), 2, 100)) \
        .orderBy(F.desc("flood_events"), "zipcode").limit(k)


def _flood_days(floods: DataFrame, since: int, tz: str, *more: Column) -> DataFrame:
    day = F.to_date(wall_time(floods, "flood_start_time", tz)).alias("day")
    return _placed(floods, since).groupBy(day, "borough").agg(_events(), *more)


def flood_days_and_next_day(floods: DataFrame, requests: DataFrame, since: int = 2024, least: int = 3, k: int = 20,
                            tz: str = NEW_YORK) -> DataFrame:
    """Flood days, by the calendar of ``tz``, with the complaints of the same and of the following day."""
    days = _flood_days(floods, since, tz, F.min("flood_year").alias("flood_year"), F.min("flood_month").alias("flood_month"), F.max("max_depth_inches").alias("max_depth"),
                       F.max("flood_severity").alias("worst_severity")).where(F.col("flood_events") >= least)
    asked = _complaints(_in_boroughs(requests), [F.to_date(wall_time(requests, "created_date", tz)).alias("day"), _upper()], WATER_COMPLAINTS) \
        .drop("total_311")
    following = asked.select(F.date_sub("day", 1).alias("day"), "match_borough",
                             F.col("water_complaints").alias("water_complaints_next_day"))
    keys = ["day", "match_borough"]
    return (days.withColumn("match_borough", F.upper("borough")).join(asked, keys).join(following, keys, "left")
            .drop("match_borough").withColumnRenamed("day", "flood_date")
            .orderBy(F.desc("flood_events"), "flood_date", "borough").limit(k))


def worst_label(col: str, labels, *, by_rank: bool) -> Column:
    """Greatest label, alphabetically or by its place in ``labels``."""
    return F.max_by(F.col(col), label_rank(col, labels)) if by_rank else F.max(col)


def flood_intensity(floods: DataFrame, requests: DataFrame, since: int = 2024, tz: str = NEW_YORK) -> DataFrame:
    days = _flood_days(floods, since, tz)
    asked = _complaints(_in_boroughs(requests), [F.to_date(wall_time(requests, "created_date", tz)).alias("day"), _upper()], WATER_COMPLAINTS_WIDE)
    events = F.col("flood_events")
    bucket = F.coalesce(*[F.when(events >= least, F.lit(name)) for least, name in INTENSITIES], F.lit(LOW_INTENSITY))
    return (days.withColumn("match_borough", F.upper("borough")).join(asked, ["day", "match_borough"])
            .groupBy(bucket.alias("flood_intensity")).agg(
                F.count("*").alias("days"), _rounded(F.avg, "water_complaints").alias("avg_water_311"),
                _rounded(F.avg, "total_311").alias("avg_total_311"),
                ratio(F.avg("water_complaints"), F.avg("total_311"), 2, 100).alias("water_pct_of_total"))
            .orderBy(F.desc("avg_water_311")))


def severity_by_borough(floods: DataFrame, since: int | None = 2024) -> DataFrame:
    return (_placed(floods, since).groupBy("borough", "flood_severity").agg(
        F.count("*").alias("events"), _rounded(F.avg, "duration_mins").alias("avg_duration"), _depth())
        .orderBy("borough", label_rank("flood_severity", SEVERITIES)))


def seasonal_floods(floods: DataFrame, since: int = 2024) -> DataFrame:
    night = F.col("flood_is_overnight")
    return _placed(floods, since).groupBy("flood_season", "borough").agg(
        _events(), _depth(), F.count_if(night).alias("overnight_events"), _share(night).alias("overnight_pct"),
    ).orderBy(label_rank("flood_season", SEASONS), F.desc("flood_events"))


def floods_by_hour(floods: DataFrame, since: int = 2024) -> DataFrame:
    return _placed(floods, since).groupBy("flood_hour").agg(_events(), _depth()).orderBy("flood_hour")


def complaints_by_hour(requests: DataFrame) -> DataFrame:
    return _complaints(_in_boroughs(requests), ["hour"], WATER_COMPLAINTS_WIDE).orderBy("hour")


# -- local exploration ----------------------------------------------------------------------------

def deepest_sensors(events: DataFrame, k: int = 10) -> DataFrame:
    return events.groupBy("sensor_name").agg(F.count("*").alias("events"), F.max("max_depth_inches").alias("worst_depth_in")) \
        .orderBy(F.desc("events"), "sensor_name").limit(k)


def severity_breakdown(floods: DataFrame) -> DataFrame:
    return floods.groupBy("flood_severity").agg(
        F.count("*").alias("events"), _rounded(F.avg, "max_depth_inches", 1).alias("avg_depth_in"),
        _rounded(F.avg, "duration_mins", 1).alias("avg_duration_min")).orderBy(F.desc("events"))


def busiest_sensors(sensors: DataFrame, events: DataFrame, k: int = 15) -> DataFrame:
    """Events per sensor, sensors without any included. Events are counted per sensor before the
    join, so a sensor with a third of them costs one row."""
    counted = events.groupBy("sensor_id").agg(F.count("*").alias("n"))
    return (sensors.join(counted, "sensor_id", "left").groupBy("sensor_name", "borough")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events"))
            .orderBy(F.desc("events"), "sensor_name").limit(k))


def severity_depths(floods: DataFrame) -> DataFrame:
    return floods.groupBy("borough", "flood_severity").agg(
        F.count("*").alias("events"), _depth(), _rounded(F.avg, "duration_mins", 1).alias("avg_duration")) \
        .orderBy("borough", F.desc("avg_depth"))


def flashiest_floods(floods: DataFrame, k: int = 20, *, tiebreak: list[str] = ()) -> DataFrame:
    """Floods that peak soonest; ``tiebreak`` settles the cut among equal ones."""
    ordered = floods.where(F.col("time_to_peak_pct").isNotNull()) \
        .orderBy("time_to_peak_pct", "flood_start_time", "sensor_name", *tiebreak).limit(k)
    return ordered.select(
        "sensor_name", "borough", "flood_start_time", "max_depth_inches", "duration_mins",
        F.round("rise_rate_in_per_min", 3).alias("rise_rate"), F.round("time_to_peak_pct", 3).alias("peak_pct"))


# -- remote exploration ---------------------------------------------------------------------------

def overnight_share(requests: DataFrame, year: int) -> DataFrame:
    night = F.col("is_overnight")
    return requests.where(F.col("year") == year).groupBy("borough").agg(
        F.count("*").alias("total"), F.count_if(night).alias("overnight"), _share(night).alias("pct_overnight")) \
        .orderBy(F.desc("total"))


def awards_by_category(budget: DataFrame, k: int = 10) -> DataFrame:
    return budget.groupBy("funding_category").agg(F.count("*").alias("projects"), _rounded(F.sum, "award", 2).alias("total_award")) \
        .orderBy(F.desc("total_award"), "funding_category").limit(k)


def pay_by_agency(payroll: DataFrame, k: int = 10) -> DataFrame:
    return payroll.groupBy("agency_name").agg(
        F.count("*").alias("employees"), _rounded(F.sum, "regular_gross_paid", 2).alias("total_pay")) \
        .orderBy(F.desc("total_pay"), "agency_name").limit(k)
