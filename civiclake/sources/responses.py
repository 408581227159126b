"""Rows out of API responses kept as files: nested XML records and column-wise weather JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Output column -> response array (daily and hourly weather).
DAILY_WEATHER = {
    "weather_code": "weathercode",
    "temperature_max": "temperature_2m_max",
    "temperature_min": "temperature_2m_min",
    "temperature_mean": "temperature_2m_mean",
    "apparent_temperature_max": "apparent_temperature_max",
    "apparent_temperature_min": "apparent_temperature_min",
    "apparent_temperature_mean": "apparent_temperature_mean",
    "sunrise": "sunrise",
    "sunset": "sunset",
    "precipitation_sum": "precipitation_sum",
    "rain_sum": "rain_sum",
    "snowfall_sum": "snowfall_sum",
    "precipitation_hours": "precipitation_hours",
}
HOURLY_WEATHER = {
    "temperature_2m": "temperature_2m",
    "precipitation": "precipitation",
    "rain": "rain",
    "weather_code": "weathercode",
}
_TEXT_ARRAYS = ("sunrise", "sunset")
_INTEGER_ARRAYS = ("weathercode",)
# Days per request.
DAILY_CHUNK_DAYS = 30
HOURLY_CHUNK_DAYS = 7


def scan_transactions(spark: SparkSession, path: str, schema: T.StructType | str, *, response_tag: str = "response",
                      records_tag: str = "result_records", row_tag: str = "transaction", status_tag: str = "status") -> DataFrame:
    """``<transaction>`` records; groups one level deep become top-level columns, text is trimmed.

    The files are read once, a row per response (a page of the API, so bounded) that carries its status. A
    response whose status is not ``success`` is an error as soon as its rows are asked for."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    status = T.StructType.fromDDL("result string, messages struct<message: struct<description: string>>")
    page = T.StructType([T.StructField(status_tag, status),
                         T.StructField(records_tag, T.StructType([T.StructField(row_tag, T.ArrayType(schema))]))])
    pages = spark.read.format("xml").option("rowTag", response_tag).schema(page).load(path)
    reason = F.coalesce(F.col(f"{status_tag}.messages.message.description"), F.lit("unknown error"))
    records = F.when(F.trim(F.col(f"{status_tag}.result")) != "success", F.raise_error(F.concat(F.lit("response failed: "), reason))) \
        .otherwise(F.col(f"{records_tag}.{row_tag}"))
    rows = pages.select(F.explode(records).alias("record"))
    flat = []
    for field in schema.fields:
        nested = isinstance(field.dataType, T.StructType)
        names = [f"{field.name}.{f.name}" for f in field.dataType.fields] if nested else [field.name]
        flat += [F.trim(F.col(f"record.{n}")).alias(n.rsplit(".", 1)[-1]) for n in names]
    return rows.select(flat)


def _weather_schema(block: str, arrays: dict[str, str]) -> T.StructType:
    def element(name):
        if name in _TEXT_ARRAYS:
            return T.StringType()
        return T.LongType() if name in _INTEGER_ARRAYS else T.DoubleType()

    fields = [T.StructField("time", T.ArrayType(T.StringType()))]
    fields += [T.StructField(a, T.ArrayType(element(a))) for a in dict.fromkeys(arrays.values())]
    return T.StructType([T.StructField(block, T.StructType(fields))])


def _explode_weather(responses: DataFrame, block: str, arrays: dict[str, str], pattern: str) -> DataFrame:
    """One row per time step. A response without times has no rows."""
    columns = {"time": "time", **arrays}
    zipped = F.arrays_zip(*[F.col(f"{block}.{source}").alias(f"c{i}") for i, source in enumerate(columns.values())])
    step = responses.select(F.explode(zipped).alias("step"))
    out = [F.try_to_timestamp(F.col("step.c0"), F.lit(pattern)).cast("timestamp_ntz").alias("date")]
    out += [F.col(f"step.c{i}").alias(name) for i, name in enumerate(columns) if i]
    return step.select(out)


def scan_daily_weather(spark: SparkSession, path: str) -> DataFrame:
    responses = spark.read.schema(_weather_schema("daily", DAILY_WEATHER)).json(path)
    return _explode_weather(responses, "daily", DAILY_WEATHER, "yyyy-MM-dd")


def scan_hourly_weather(spark: SparkSession, path: str) -> DataFrame:
    responses = spark.read.schema(_weather_schema("hourly", HOURLY_WEATHER)).json(path)
    return _explode_weather(responses, "hourly", HOURLY_WEATHER, "yyyy-MM-dd'T'HH:mm")


def date_chunks(ranges: DataFrame, start, end, days: int, *, keep: list[str] = ()) -> DataFrame:
    """Closed chunks of ``days`` days covering each row's ``[start, end]``; the last one is clipped."""
    start, end = (F.to_date(F.col(c)) for c in (start, end))
    starts = F.when(start <= end, F.sequence(start, end, F.expr(f"INTERVAL {days} DAY")))
    return (ranges.select(*keep, end.alias("__end"), F.explode(starts).alias("chunk_start"))
            .select(*keep, "chunk_start",
                    F.least(F.date_add("chunk_start", days - 1), F.col("__end")).alias("chunk_end")))
