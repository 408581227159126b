"""T, G, X, N, M, F, I, J and E: column functions."""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from civiclake.functions import classify, coerce, flags, geo, ids, numeric, profiles, temporal, text
from civiclake.operators import enrichments
from workload import duck
from workload.registry import query

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _as_text(df, *cols):
    return df.withColumns({c: F.date_format(c, TS) for c in cols})


def _instants(s):
    """events with ``ts`` as an instant."""
    return s.events.select("event_id", F.col("ts").cast("timestamp").alias("at"))


_LOCAL = duck.local_wall("ts")


def _calendar(name, part, sql):
    """Register one calendar part over instants of events, seen in New York."""

    @query(name, f"SELECT event_id, {sql.format(ts=_LOCAL)} AS {part} FROM events")
    def _(s):
        only = {p: p == part for p in ("year", "month", "quarter", "day_of_week", "fiscal_year", "season", "hour", "is_overnight")}
        made = temporal.add_temporal_columns(_instants(s), "at", **only, year_month_key=part == "year_month")
        return made.select("event_id", part)


@query("T01_parse_string_date", """
    SELECT o_orderkey, try_strptime(replace(month, ' / ', '-') || '-01', '%Y-%m-%d')::DATE AS day
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 499 = 0 THEN 'unknown' ELSE CAST(year(o_orderdate) AS VARCHAR) || ' / ' ||
          lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') END AS month FROM orders)""")
def _(s):
    month = F.when(F.col("o_orderkey") % 499 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy / MM"))
    return s.orders.select("o_orderkey", temporal.parse_string_date(month, "%Y-%m-%d", pre_replace={" / ": "-"}, suffix="-01").alias("day"))


@query("T02_record_timestamp", f"""
    SELECT o_orderkey, {duck.utc_text(duck.localize('o_orderdate'))} AS from_wall, {duck.utc_text(duck.localize('make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0)'))} AS from_year,
           'day' AS record_date_precision, {duck.wall_text('o_orderdate')} AS from_instant FROM orders""")
def _(s):
    from_wall = temporal.add_record_timestamp(s.orders, "o_orderdate", "day")
    from_year = temporal.add_record_timestamp(from_wall.withColumnRenamed("record_timestamp", "from_wall"), F.year("o_orderdate"), "day")
    both = temporal.add_record_timestamp(from_year.withColumnRenamed("record_timestamp", "from_year"),
                                         F.col("o_orderdate").cast("timestamp"), "day").withColumnRenamed("record_timestamp", "from_instant")
    return _as_text(both.select("o_orderkey", "from_wall", "from_year", "from_instant", "record_date_precision"),
                    "from_wall", "from_year", "from_instant")


@query("T03_year_month_quarter", f"""
    SELECT event_id, CAST(year({_LOCAL}) AS INT) AS year, CAST(month({_LOCAL}) AS INT) AS month, CAST(quarter({_LOCAL}) AS INT) AS quarter FROM events""")
def _(s):
    return temporal.add_temporal_columns(_instants(s), "at").drop("at")


_calendar("T04_day_of_week", "day_of_week", "dayname({ts})")
_calendar("T05_fiscal_year", "fiscal_year", "CAST(CASE WHEN month({ts}) >= 7 THEN year({ts}) + 1 ELSE year({ts}) END AS INT)")


@query("T06_season", """
    SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
    WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
    CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END::INT AS fiscal_year FROM orders""")
def _(s):
    made = temporal.add_temporal_columns(s.orders, "o_orderdate", year=False, month=False, quarter=False, season=True, fiscal_year=True)
    return made.select("o_orderkey", "season", "fiscal_year")


_calendar("T07_year_month", "year_month", "strftime({ts}, '%Y-%m')")


@query("T08_hour_overnight", f"""
    SELECT event_id, CAST(hour({_LOCAL}) AS INT) AS hour, (hour({_LOCAL}) >= 22 OR hour({_LOCAL}) <= 5) AS is_overnight FROM events""")
def _(s):
    return temporal.add_temporal_columns(_instants(s), "at", year=False, month=False, quarter=False, hour=True, is_overnight=True).drop("at")


@query("T09_temporal_bundle", """
    SELECT o_orderkey, year(o_orderdate)::INT AS o_year, month(o_orderdate)::INT AS o_month, quarter(o_orderdate)::INT AS o_quarter,
           dayname(o_orderdate) AS o_day_of_week, strftime(o_orderdate, '%Y-%m') AS o_year_month, hour(o_orderdate)::INT AS o_hour FROM orders""")
def _(s):
    made = temporal.add_temporal_columns(s.orders, "o_orderdate", day_of_week=True, year_month_key=True, hour=True, prefix="o_")
    return made.select("o_orderkey", *[c for c in made.columns if c.startswith("o_") and c not in s.orders.columns])


_SPAN = "date_diff('microseconds', flood_start_time, flood_end_time)"


@query("T10_duration", f"""
    SELECT sensor_id, max_depth_inches, onset_time_mins, drain_time_mins, trunc({_SPAN} / 3600000000.0) + 0.0 AS hours,
           trunc({_SPAN} / 60000000.0) + 0.0 AS minutes, CAST({_SPAN} // 1000000 AS DOUBLE) AS seconds FROM {{flood_events}}""")
def _(s):
    units = ("hours", "minutes", "seconds")
    return s.flood_events.select("sensor_id", "max_depth_inches", "onset_time_mins", "drain_time_mins",
                                 *[temporal.compute_duration("flood_start_time", "flood_end_time", unit=u).alias(u) for u in units])


@query("T11_negative_duration", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(date_diff('microseconds', o_orderdate, l_shipdate) / 3600000000.0) AS DOUBLE) AS days_open,
           coalesce(l_shipdate < o_orderdate, false) AS is_temporal_error FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(s):
    joined = s.lineitem.join(s.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         *temporal.duration_columns("o_orderdate", "l_shipdate", alias="days_open", flag_negative=True))


@query("T12_enforce_timezone", f"""
    SELECT event_id, {duck.utc_text(duck.localize('ts'))} AS wall, {duck.wall_text('ts')} AS instant, {duck.utc_text(duck.localize('CAST(CAST(ts AS DATE) AS TIMESTAMP)'))} AS day,
           {duck.utc_text(duck.localize('ts'))} AS words FROM events""")
def _(s):
    ts = F.col("ts")
    mixed = s.events.select("event_id", ts.alias("wall"), ts.cast("timestamp").alias("instant"), ts.cast("date").alias("day"),
                            ts.cast("string").alias("words"))
    return _as_text(temporal.enforce_timezone(mixed, ["wall", "instant", "day", "words", "absent"]), "wall", "instant", "day", "words")


@query("T13_impute_interval", f"""
    SELECT sensor_id, onset_time_mins, max_depth_inches, flood_start_time IS NULL OR flood_end_time IS NULL AS has_imputed_timestamp,
           {duck.wall_text('coalesce(flood_start_time, flood_end_time - to_minutes(CAST(duration_mins AS BIGINT)))')} AS flood_start_time,
           {duck.wall_text('coalesce(flood_end_time, coalesce(flood_start_time, flood_end_time - to_minutes(CAST(duration_mins AS BIGINT))) + to_minutes(CAST(duration_mins AS BIGINT)))')} AS flood_end_time
    FROM {{flood_events}}""")
def _(s):
    made = temporal.impute_interval(s.flood_events, "flood_start_time", "flood_end_time", "duration_mins")
    return _as_text(made.select("sensor_id", "onset_time_mins", "max_depth_inches", "has_imputed_timestamp", "flood_start_time", "flood_end_time"),
                    "flood_start_time", "flood_end_time")


@query("T14_date_to_instant", f"SELECT o_orderkey, {duck.utc_text(duck.localize('CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)'))} AS midnight FROM orders")
def _(s):
    midnight = temporal.localize(F.to_date("o_orderdate"), duck.NY)
    return s.orders.select("o_orderkey", F.date_format(midnight, TS).alias("midnight"))


@query("T15_extract_parts", "SELECT extract(year FROM o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, count(*) AS n FROM orders GROUP BY 1, 2")
def _(s):
    return s.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))


@query("T16_date_trunc", """
    SELECT strftime(date_trunc('month', ts), '%Y-%m-%d') AS month, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n
    FROM events GROUP BY 1, 2""")
def _(s):
    cut = [F.date_format(F.date_trunc(unit, "ts"), "yyyy-MM-dd").alias(unit) for unit in ("month", "day")]
    return s.events.groupBy(*cut).agg(F.count("*").alias("n"))


@query("T17_add_interval", "SELECT o_orderkey, CAST(o_orderdate + INTERVAL '1 day' AS DATE) AS next_day FROM orders")
def _(s):
    return s.orders.select("o_orderkey", F.to_date(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("next_day"))


@query("T18_partition_windows", f"""
    WITH months AS (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS d FROM orders)
    SELECT strftime(d, '%Y-%m') AS partition_key, {duck.utc_text(duck.localize('CAST(d AS TIMESTAMP)'))} AS window_start,
           {duck.utc_text(duck.localize("CAST(d + INTERVAL 1 MONTH AS TIMESTAMP)"))} AS window_end FROM months""")
def _(s):
    bounds = s.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return _as_text(temporal.partition_windows(bounds, "monthly", "a", "b", end_offset=1), "window_start", "window_end")


@query("T19_timestamp_literal", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 05:00:00' GROUP BY 1")
def _(s):
    literal = temporal.timestamp_literal(datetime(2024, 1, 10, tzinfo=ZoneInfo(duck.NY)))
    assert literal == "2024-01-10 00:00:00-05:00"
    # Comparing against the literal as wall time in UTC keeps the filter on the stored column.
    start = F.lit(literal).cast("timestamp").cast("timestamp_ntz")
    return s.events.where(F.col("ts") >= start).groupBy("event_type").agg(F.count("*").alias("n"))


# -- geography ------------------------------------------------------------------------------------

@query("G01_borough_name", f"SELECT c_custkey, {duck.borough_name()} AS borough_name FROM {{places}}")
def _(s):
    return s.places.select("c_custkey", geo.borough_name("borough").alias("borough_name"))


@query("G02_borough_code", f"SELECT c_custkey, CAST({duck.BOROUGH_CODES} AS INT) AS borough_code FROM {{places}}")
def _(s):
    return s.places.select("c_custkey", geo.borough_code("borough").alias("borough_code"))


@query("G03_borough_key", f"SELECT c_custkey, replace(lower({duck.borough_name()}), ' ', '_') AS borough_key FROM {{places}}")
def _(s):
    return s.places.select("c_custkey", geo.borough_key("borough").alias("borough_key"))


@query("G04_add_borough_key", f"""
    SELECT c_custkey, replace(lower({duck.borough_name()}), ' ', '_') AS borough_key, CAST({duck.BOROUGH_CODES} AS INT) AS borough_code,
           {duck.borough_name()} AS borough_name FROM {{places}}""")
def _(s):
    return geo.add_borough_key(s.places, code=True, canonical_name=True).select("c_custkey", "borough_key", "borough_code", "borough_name")


@query("G05_location_flag", """
    SELECT c_custkey, coalesce(latitude BETWEEN 40.4 AND 40.95 AND longitude BETWEEN -74.3 AND -73.65, false) AS has_location,
           latitude IS NOT NULL AND longitude IS NOT NULL AS has_coordinates FROM {places}""")
def _(s):
    flagged = geo.add_location_flag(geo.add_location_flag(s.places), validate_nyc_bounds=False, alias="has_coordinates")
    return flagged.select("c_custkey", "has_location", "has_coordinates")


@query("G06_parcel_id", f"""
    SELECT c_custkey, substr(CAST({duck.BOROUGH_CODES} AS VARCHAR), 1, 1) || {duck.pad('CAST(block AS VARCHAR)', 5)} || {duck.pad('CAST(lot AS VARCHAR)', 4)} AS bbl FROM {{places}}""")
def _(s):
    coded = s.places.withColumn("boro", geo.borough_code("borough"))
    return geo.add_nyc_bbl(coded).select("c_custkey", "bbl")


@query("G07_community_district", f"""
    SELECT c_custkey, CAST({duck.BOROUGH_CODES} AS VARCHAR) || {duck.pad('trim(district)', 2)} AS community_district_key,
           {duck.pad('trim(district)', 3)} AS district_only FROM {{places}}""")
def _(s):
    keyed = geo.add_community_district_key(s.places, "district")
    return geo.add_community_district_key(keyed, "district", None, alias="district_only").select("c_custkey", "community_district_key", "district_only")


@query("G08_board_number", """
    SELECT unique_key, CASE cb_number // 100 WHEN 1 THEN 'MANHATTAN' WHEN 2 THEN 'BRONX' WHEN 3 THEN 'BROOKLYN' WHEN 4 THEN 'QUEENS'
    WHEN 5 THEN 'STATEN ISLAND' END AS borough, cb_number % 100 AS cb_in_borough FROM {requests}""")
def _(s):
    return s.requests.select("unique_key", geo.board_borough("cb_number").alias("borough"), geo.board_number("cb_number").alias("cb_in_borough"))


# -- text -----------------------------------------------------------------------------------------

# The texts are compared through a digest; DuckDB keeps the sharp s and ligatures in upper case.
@query("X01_clean_text",
       "SELECT doc_id, md5(upper(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), 'ß', 'ss'))) AS upper_text, "
       "md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS plain_text FROM documents")
def _(s):
    return s.documents.select("doc_id", F.md5(text.clean_text("text")).alias("upper_text"),
                              F.md5(text.clean_text("text", uppercase=False)).alias("plain_text"))


@query("X02_literal_replacements", """
    SELECT doc_id, md5(replace(replace(text, 'the', 'THE'), 'TH', '.*')) AS all_places,
           md5(CASE WHEN instr(text, 'a') > 0 THEN substr(text, 1, instr(text, 'a') - 1) || '<A>' || substr(text, instr(text, 'a') + 1) ELSE text END) AS first_place
    FROM documents""")
def _(s):
    every = text.apply_literal_replacements("text", {"the": "THE", "TH": ".*"})
    first = text.apply_literal_replacements("text", {"a": "<A>"}, replace_all=False)
    return s.documents.select("doc_id", F.md5(every).alias("all_places"), F.md5(first).alias("first_place"))


@query("X03_split_and_clean", """
    SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(listed, '|'), lambda x: trim(x)), lambda x: length(x) > 0), '~') AS pieces FROM {notes}""")
def _(s):
    return s.notes.select("p_partkey", F.array_join(text.split_and_clean_list("listed", delimiter="|"), "~").alias("pieces"))


@query("X04_sql_text", "SELECT p_partkey, trim(split_part(listed, '|', 1)) AS first_piece, upper(p_type) AS kind FROM {notes}")
def _(s):
    return s.sql("SELECT p_partkey, trim(split_part(listed, '|', 1)) AS first_piece, upper(p_type) AS kind FROM {notes}", "notes")


# -- numbers --------------------------------------------------------------------------------------

_ORGANICS = ["res_organics_tons", "school_organic_tons", "leaves_organic_tons"]


@query("N01_sum_components", "SELECT month, refuse_tons_collected, " + " + ".join(f"coalesce({c}, 0)" for c in _ORGANICS) + " AS organics FROM {tonnage}")
def _(s):
    return s.tonnage.select("month", "refuse_tons_collected", numeric.sum_components(_ORGANICS).alias("organics"))


@query("N02_compute_rate", """
    SELECT sensor_id, max_depth_inches, onset_time_mins, drain_time_mins, round(max_depth_inches / nullif(onset_time_mins, 0), 4) AS rate,
           round(max_depth_inches * 60.0 / nullif(drain_time_mins, 0), 2) AS per_hour,
           CASE WHEN onset_time_mins = 0 THEN CASE WHEN max_depth_inches = 0 THEN 'NaN' WHEN max_depth_inches > 0 THEN 'Infinity' END ELSE 'finite' END AS over_zero
    FROM {flood_events}""")
def _(s):
    loose = numeric.compute_rate("max_depth_inches", "onset_time_mins", null_on_zero=False, round_digits=None)
    return s.flood_events.select("sensor_id", "max_depth_inches", "onset_time_mins", "drain_time_mins",
                                 numeric.compute_rate("max_depth_inches", "onset_time_mins").alias("rate"),
                                 numeric.compute_rate("max_depth_inches", "drain_time_mins", scale=60, round_digits=2).alias("per_hour"),
                                 F.when(F.col("onset_time_mins") != 0, "finite").otherwise(loose.cast("string")).alias("over_zero"))


@query("N03_guarded_ratios", """
    SELECT borough, round(10000.0 * sum(coalesce(number_of_persons_killed, 0)) / nullif(count(*), 0), 2) AS per_10k,
           round(100.0 * sum(coalesce(number_of_cyclist_injured, 0)) / nullif(sum(coalesce(number_of_persons_injured, 0)), 0), 1) AS pct
    FROM {collisions} GROUP BY 1""")
def _(s):
    def total(c):
        return F.sum(numeric.filled(c))

    return s.collisions.groupBy("borough").agg(
        numeric.ratio(total("number_of_persons_killed"), F.count("*"), 2, 10_000).alias("per_10k"),
        numeric.ratio(total("number_of_cyclist_injured"), total("number_of_persons_injured"), 1, 100).alias("pct"))


@query("N04_round_div_mod", """
    SELECT o_orderkey, round(o_totalprice / 1000, 0) AS thousands, o_custkey // 100 AS block, o_custkey % 100 AS rest FROM orders""")
def _(s):
    return s.sql("SELECT o_orderkey, round(o_totalprice / 1000, 0) AS thousands, o_custkey div 100 AS block, o_custkey % 100 AS rest FROM {orders}", "orders")


@query("N05_coalesced_arithmetic", """
    SELECT borough, sum(refuse_tons_collected + coalesce(paper_tons_collected, 0) + coalesce(mgp_tons_collected, 0)) AS curbside FROM {tonnage} GROUP BY 1""")
def _(s):
    parts = ["refuse_tons_collected", "paper_tons_collected", "mgp_tons_collected"]
    return s.tonnage.groupBy("borough").agg(F.sum(numeric.sum_components(parts, fill_null=0)).alias("curbside"))


# -- labels, flags, ids, profiles -----------------------------------------------------------------

@query("M01_map_with_default", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'other' END AS state FROM lineitem""")
def _(s):
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             classify.map_with_default("l_returnflag", {"A": "accepted", "R": "returned"}, default="other").alias("state"))


RULES = [("license", r"(?i)license|copyright"), ("contact", r"[\w.]+@[\w.]+"), ("money", r"[$€]\d+"), ("digits", r"\d{3,}")]


@query("M02_ordered_regex", "SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{label}'" for label, p in RULES) + " ELSE 'other' END AS kind FROM documents")
def _(s):
    return s.documents.select("doc_id", classify.ordered_regex_classification("text", RULES, default="other").alias("kind"))


@query("M03_all_labels", "SELECT doc_id, nullif(concat_ws('; ', " + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{label}' END" for label, p in RULES) + "), '') AS labels FROM documents")
def _(s):
    return s.documents.select("doc_id", classify.collect_matching_labels("text", RULES).alias("labels"))


@query("M04_annotations", """
    SELECT d.doc_id, nullif(concat_ws(' | ', CASE WHEN n_chars > 5000 THEN 'long' END, CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END), '') AS notes
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(s):
    marked = s.documents.join(s.labels, "doc_id", "left")
    rules = [(F.col("n_chars") > 5000, "long"), (F.col("quality") == 1, "good"), (F.col("toxic") == 1, "toxic")]
    return marked.select("doc_id", classify.assemble_annotations(rules, separator=" | ").alias("notes"))


@query("M05_severity", """
    SELECT CASE WHEN max_depth_inches < 4 THEN 'minor' WHEN max_depth_inches < 12 THEN 'moderate' WHEN max_depth_inches < 24 THEN 'major' ELSE 'severe' END AS flood_severity,
           CASE WHEN max_depth_inches < 4 THEN 'minor' WHEN max_depth_inches < 12 THEN 'moderate' WHEN max_depth_inches < 24 THEN 'major'
                WHEN max_depth_inches IS NOT NULL THEN 'severe' END AS null_safe, count(*) AS n FROM {flood_events} GROUP BY 1, 2""")
def _(s):
    return s.flood_events.groupBy(classify.depth_severity("max_depth_inches").alias("flood_severity"),
                                  classify.depth_severity("max_depth_inches", null_is_severe=False).alias("null_safe")).agg(F.count("*").alias("n"))


@query("M06_word_flag", "SELECT sensor_id, tidally_influenced = 'Yes' AS is_tidally_influenced FROM {sensors}")
def _(s):
    return s.sensors.select("sensor_id", classify.is_word("tidally_influenced").alias("is_tidally_influenced"))


@query("F01_has_date", "SELECT sensor_id, date_installed IS NOT NULL AS has_date FROM {sensors}")
def _(s):
    return flags.add_completeness_flags(s.sensors, date_col="date_installed").select("sensor_id", "has_date")


@query("F02_has_location", "SELECT sensor_id, latitude IS NOT NULL AND longitude IS NOT NULL AS has_location FROM {sensors}")
def _(s):
    return flags.add_completeness_flags(s.sensors, lat_col="latitude", lon_col="longitude").select("sensor_id", "has_location")


@query("F03_has_geo_ids", "SELECT sensor_id, zipcode IS NOT NULL OR borough IS NOT NULL AS has_geo_ids FROM {sensors}")
def _(s):
    return flags.add_completeness_flags(s.sensors, geo_id_cols=["zipcode", "borough"]).select("sensor_id", "has_geo_ids")


@query("F04_custom_flags", "SELECT sensor_id, zipcode IS NOT NULL AND borough IS NOT NULL AS placed, latitude IS NOT NULL AS mapped FROM {sensors}")
def _(s):
    return flags.add_completeness_flags(s.sensors, custom_flags={"placed": ["zipcode", "borough"], "mapped": ["latitude"]}).select("sensor_id", "placed", "mapped")


@query("I01_stable_hash", "SELECT doc_id, md5(coalesce(text, '') || '|' || coalesce(lang, '') || '|' || coalesce(CAST(quality AS VARCHAR), '')) AS row_hash FROM documents LEFT JOIN labels USING (doc_id)")
def _(s):
    return s.documents.join(s.labels, "doc_id", "left").select("doc_id", ids.stable_string_hash(["text", "lang", "quality"]).alias("row_hash"))


_DEPTHS = "TRY_CAST(CASE WHEN json_valid(flood_profile_depth_inches) THEN flood_profile_depth_inches END AS DOUBLE[])"
_TIMES = "TRY_CAST(CASE WHEN json_valid(flood_profile_time_secs) THEN flood_profile_time_secs END AS DOUBLE[])"


@query("J01_profile_area", f"""
    WITH parsed AS (SELECT sensor_id, onset_time_mins, drain_time_mins, max_depth_inches, {_DEPTHS} AS d, {_TIMES} AS t FROM {{flood_events}})
    SELECT sensor_id, onset_time_mins, drain_time_mins, max_depth_inches, CASE WHEN len(d) >= 2 AND len(d) = len(t) THEN
        round(list_sum([(d[i] + d[i + 1]) / 2 * ((t[i + 1] - t[i]) / 60) for i in range(1, len(d))]), 2) END AS flood_volume_index FROM parsed""")
def _(s):
    return s.flood_events.select("sensor_id", "onset_time_mins", "drain_time_mins", "max_depth_inches",
                                 profiles.profile_area("flood_profile_depth_inches", "flood_profile_time_secs").alias("flood_volume_index"))


@query("J02_profile_samples", f"SELECT sensor_id, onset_time_mins, drain_time_mins, max_depth_inches, CAST(len({_DEPTHS}) AS INT) AS profile_sample_count FROM {{flood_events}}")
def _(s):
    return s.flood_events.select("sensor_id", "onset_time_mins", "drain_time_mins", "max_depth_inches",
                                 profiles.profile_sample_count("flood_profile_depth_inches").alias("profile_sample_count"))


BUNDLE = enrichments.StandardEnrichments(
    borough=enrichments.BoroughConfig("borough", code=True), location=enrichments.LocationConfig(),
    timestamp=enrichments.TimestampConfig("date_installed"), temporal=enrichments.TemporalConfig(fiscal_year=True, season=True),
    completeness=enrichments.CompletenessConfig(date_col="date_installed", geo_id_cols=["zipcode", "nta"]))


@query("E01_enrichment_bundle", f"""
    SELECT sensor_id, replace(lower({duck.borough_name()}), ' ', '_') AS borough_key, CAST({duck.BOROUGH_CODES} AS INT) AS borough_code,
           coalesce(latitude BETWEEN 40.4 AND 40.95 AND longitude BETWEEN -74.3 AND -73.65, false) AS has_location,
           {duck.utc_text(duck.localize('CAST(date_installed AS TIMESTAMP)'))} AS record_timestamp, 'day' AS record_date_precision,
           year(date_installed)::INT AS year, month(date_installed)::INT AS month, quarter(date_installed)::INT AS quarter,
           CASE WHEN month(date_installed) >= 7 THEN year(date_installed) + 1 ELSE year(date_installed) END::INT AS fiscal_year,
           CASE WHEN month(date_installed) IN (12, 1, 2) THEN 'winter' WHEN month(date_installed) IN (3, 4, 5) THEN 'spring'
                WHEN month(date_installed) IN (6, 7, 8) THEN 'summer' WHEN month(date_installed) IN (9, 10, 11) THEN 'fall' ELSE 'unknown' END AS season,
           date_installed IS NOT NULL AS has_date, zipcode IS NOT NULL OR nta IS NOT NULL AS has_geo_ids FROM {{sensors}}""")
def _(s):
    made = s.sensors.transform(BUNDLE.build_transform_fn())
    derived = [c.name for c in BUNDLE.build_derived_columns()]
    return _as_text(made.select("sensor_id", *derived), "record_timestamp")
