"""Flood events enriched with the metadata of their sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiclake.functions.classify import depth_severity, is_word
from civiclake.functions.flags import add_completeness_flags
from civiclake.functions.numeric import compute_rate
from civiclake.functions.profiles import area_under, parse_numbers, sample_count
from civiclake.functions.temporal import NEW_YORK, add_record_timestamp, add_temporal_columns, impute_interval, localize

# Source columns of the two tables, with their contract types and meanings.
FLOOD_EVENTS = {
    "sensor_name": ("sensor_name", "string", "Name of the sensor."),
    "sensor_id": ("sensor_id", "string", "Id of the sensor."),
    "flood_start_time": ("flood_start_time", "timestamp", "Start of the event."),
    "flood_end_time": ("flood_end_time", "timestamp", "End of the event."),
    "max_depth_inches": ("max_depth_inches", "double", "Greatest depth, inches."),
    "onset_time_mins": ("onset_time_mins", "double", "Minutes from start to greatest depth."),
    "drain_time_mins": ("drain_time_mins", "double", "Minutes from greatest depth to dry."),
    "duration_mins": ("duration_mins", "double", "Length of the event, minutes."),
    "duration_above_4_inches_mins": ("duration_above_4_inches_mins", "double", "Minutes at 4 inches or more."),
    "duration_above_12_inches_mins": ("duration_above_12_inches_mins", "double", "Minutes at 12 inches or more."),
    "duration_above_24_inches_mins": ("duration_above_24_inches_mins", "double", "Minutes at 24 inches or more."),
    "flood_profile_depth_inches": ("flood_profile_depth_inches", "string", "Depths, JSON array."),
    "flood_profile_time_secs": ("flood_profile_time_secs", "string", "Seconds from start, JSON array."),
}
FLOOD_SENSORS = {
    "sensor_name": ("sensor_name", "string", "Name of the sensor."),
    "sensor_id": ("sensor_id", "string", "Id of the sensor."),
    "date_installed": ("date_installed", "date", "Installation day."),
    "tidally_influenced": ("tidally_influenced", "string", "Yes where tides matter."),
    "date_removed": ("date_removed", "date", "Removal day."),
    "street_name": ("street_name", "string", "Street."),
    "borough": ("borough", "string", "Borough."),
    "zipcode": ("zipcode", "string", "Zip code."),
    "community_board": ("community_board", "bigint", "Community board."),
    "council_district": ("council_district", "string", "Council district."),
    "census_tract": ("census_tract", "string", "Census tract."),
    "nta": ("nta", "string", "Neighborhood tabulation area."),
    "latitude": ("latitude", "double", "Latitude."),
    "longitude": ("longitude", "double", "Longitude."),
    "lowest_point_height_delta_inches": ("lowest_point_height_delta_inches", "double", "Height over the lowest point."),
    "location": ("location", "string", "WKT point."),
}
SENSOR_COLUMNS = [c for c in FLOOD_SENSORS if c not in ("sensor_name", "location")]

# Rate column -> (numerator, denominator).
HYDRO_RATES = {
    "rise_rate_in_per_min": ("max_depth_inches", "onset_time_mins"),
    "drain_rate_in_per_min": ("max_depth_inches", "drain_time_mins"),
    "drain_efficiency_ratio": ("drain_time_mins", "onset_time_mins"),
    "time_to_peak_pct": ("onset_time_mins", "duration_mins"),
}


def duplicate_sensors(sensors: DataFrame) -> DataFrame:
    """Sensor ids listed more than once; joining them would multiply events."""
    return sensors.groupBy("sensor_id").agg(F.count("*").alias("copies")).where("copies > 1")


def join_sensors(events: DataFrame, sensors: DataFrame, columns: list[str] = SENSOR_COLUMNS) -> DataFrame:
    """Left join on the sensor. No broadcast hint: Spark broadcasts the sensors when their size is
    under its threshold and otherwise sort-merges, splitting a hot sensor at run time."""
    return events.join(sensors.select(columns), "sensor_id", "left")


def enrich_events(events: DataFrame, sensors: DataFrame, *, tz: str = NEW_YORK, null_is_severe: bool = True,
                  sort: bool = False) -> DataFrame:
    """The enriched table: imputed times, severity, hydrological rates, calendar columns, flags and
    profile measures, one row per event. Sensors listed twice would multiply events and are refused."""
    if not duplicate_sensors(sensors).isEmpty():
        raise ValueError("sensors are listed more than once; see duplicate_sensors")
    df = join_sensors(events, sensors)
    df = impute_interval(df, "flood_start_time", "flood_end_time", "duration_mins")
    if sort:
        # Before the derived columns: the shuffle is narrower, and the sampling pass of the sort does
        # not compute them. The projections below keep the order.
        df = df.orderBy("flood_start_time", "sensor_id")
    df = df.withColumns({"__depths": parse_numbers("flood_profile_depth_inches"),
                         "__seconds": parse_numbers("flood_profile_time_secs")})
    df = df.withColumns({
        **{c: localize(F.col(c), tz) for c in ("date_installed", "date_removed")},
        "is_tidally_influenced": is_word("tidally_influenced"),
        "flood_severity": depth_severity("max_depth_inches", null_is_severe=null_is_severe),
        **{name: compute_rate(*pair) for name, pair in HYDRO_RATES.items()},
        "flood_volume_index": area_under("__depths", "__seconds"),
        "profile_sample_count": sample_count("__depths"),
    }).drop("__depths", "__seconds")
    df = add_temporal_columns(df, "flood_start_time", prefix="flood_", quarter=False, hour=True, season=True,
                              is_overnight=True, tz=tz)
    df = add_record_timestamp(df, "flood_start_time", "datetime", tz=tz)
    return add_completeness_flags(df, lat_col="latitude", lon_col="longitude")
