"""Inputs in the form of city tables, derived from the test tables.

Each shape is one SELECT that Spark and DuckDB both accept, with its inputs written ``{name}``.
Amounts are multiples of powers of two, so sums do not depend on the order of addition.
"""

from __future__ import annotations

import re

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _choose(selector: str, *values: str | None) -> str:
    """CASE over ``selector`` = 0, 1, 2...; None is NULL."""
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else v if v.startswith("(") else f"'{v}'")
                    for i, v in enumerate(values))
    return f"CASE {selector} {arms} END"


def _amount(expression: str, parts: int = 4) -> str:
    return f"(CAST({expression} AS DOUBLE) / {parts})"


def _two(expression: str) -> str:
    return f"lpad(CAST({expression} AS STRING), 2, '0')"


_BOROUGHS = ("BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND")
_NAMES = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
_FACTORS = ("Unspecified", "Driver Inattention", "Failure to Yield", "Unsafe Speed", "Following Too Closely")

_SQL: dict[str, str] = {
    "collisions": f"""
        SELECT l_orderkey AS collision_id,
               CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_shipdate + INTERVAL 18 YEAR AS DATE) END AS crash_date,
               {_choose('l_suppkey % 6', *_BOROUGHS, None)} AS borough,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 4 AS DOUBLE) END AS number_of_persons_injured,
               CASE WHEN l_partkey % 53 = 0 THEN CAST(1 AS DOUBLE) WHEN l_partkey % 59 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS number_of_persons_killed,
               CAST(l_partkey % 2 AS DOUBLE) AS number_of_pedestrians_injured,
               CASE WHEN l_partkey % 106 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS number_of_pedestrians_killed,
               CAST(l_suppkey % 3 AS DOUBLE) AS number_of_cyclist_injured,
               CASE WHEN l_partkey % 159 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS number_of_cyclist_killed,
               CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(l_orderkey % 3 AS DOUBLE) END AS number_of_motorist_injured,
               CAST(0 AS DOUBLE) AS number_of_motorist_killed,
               {_choose('l_partkey % 6', *_FACTORS, None)} AS contributing_factor_vehicle_1,
               {_choose('l_suppkey % 8', *_FACTORS)} AS contributing_factor_vehicle_2,
               CASE l_returnflag WHEN 'A' THEN 'Unsafe Speed' WHEN 'R' THEN 'Pavement Slippery' END AS contributing_factor_vehicle_3,
               CASE WHEN l_linestatus = 'F' AND l_linenumber = 4 THEN 'Glare' END AS contributing_factor_vehicle_4,
               CASE WHEN l_linenumber = 5 THEN 'Unspecified' END AS contributing_factor_vehicle_5
        FROM {{lineitem}}""",
    "tonnage": f"""
        SELECT CASE WHEN o_orderkey % 499 = 0 THEN 'unknown'
                    ELSE CAST(year(o_orderdate) + 18 AS STRING) || ' / ' || {_two('month(o_orderdate)')} END AS month,
               {_choose('o_custkey % 5', *_NAMES)} AS borough,
               CAST(o_custkey % 5 + 1 AS STRING) AS borough_id,
               {_two('o_custkey % 60 % 13 + 1')} AS community_district,
               {_amount('o_orderkey % 4000')} AS refuse_tons_collected,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_amount('o_orderkey % 800', 8)} END AS paper_tons_collected,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE {_amount('o_custkey % 640', 8)} END AS mgp_tons_collected,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {_amount('o_custkey % 50', 8)} END AS res_organics_tons,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_amount('o_orderkey % 30', 8)} END AS school_organic_tons,
               CASE WHEN month(o_orderdate) IN (11, 12) THEN {_amount('o_orderkey % 90')} END AS leaves_organic_tons,
               CASE WHEN month(o_orderdate) = 1 THEN {_amount('o_orderkey % 20')} END AS xmas_tree_tons,
               CASE WHEN o_custkey % 6 = 0 THEN {_amount('o_custkey % 12')} END AS other_organics_tons
        FROM {{orders}}""",
    "ridership": f"""
        SELECT CAST(o_orderdate + INTERVAL 23 YEAR AS DATE) AS date,
               {_choose('o_custkey % 4', 'Subway', 'Bus', 'Rail', 'Ferry')} AS mode,
               CAST(floor(o_totalprice) AS DOUBLE) AS count
        FROM {{orders}}""",
    "air": f"""
        SELECT CAST(year(o_orderdate) + 23 AS INT) AS year,
               {_choose('o_orderkey % 5', 'Nitrogen dioxide (NO2)', 'Fine particles (PM 2.5)', 'Ozone (O3)', 'Sulfur dioxide', 'Boiler emissions')} AS name,
               CASE WHEN o_custkey % 4 = 0 THEN 'Max' ELSE 'Mean' END AS measure,
               {_choose('o_orderkey % 5', 'ppb', 'mcg/m3', 'ppb', 'ppb', 'number')} AS measure_info,
               'Place ' || CAST(o_custkey % 42 AS STRING) AS geo_place_name,
               {_choose('o_custkey % 3', 'UHF42 Neighborhood', 'Borough', 'CD')} AS geo_type_name,
               CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE {_amount('o_orderkey * 7 % 400', 8)} END AS data_value
        FROM {{orders}}""",
    "requests": f"""
        SELECT CAST(o_orderkey AS STRING) AS unique_key,
               o_orderdate + INTERVAL 23 YEAR + CAST(o_orderkey % 24 AS INT) * INTERVAL 1 HOUR AS created_date,
               'Agency ' || CAST(o_custkey % 15 AS STRING) AS agency_name,
               {_choose('o_orderkey % 10', 'HEAT/HOT WATER', 'Non-Residential Heat', 'Sewer', 'Standing Water',
                        'Water System', 'Water Quality', 'Street Flooding', 'Storm Drain', 'Noise', 'Illegal Parking')} AS complaint_type,
               {_choose('o_custkey % 6', *_BOROUGHS, 'Unspecified')} AS borough,
               CASE WHEN o_custkey % 31 = 0 THEN NULL ELSE CAST(101 + 100 * (o_custkey % 5) + o_custkey % 20 AS INT) END AS cb_number,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'P' || CAST(o_orderkey % 97 AS STRING) END AS bbl,
               CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE 'Z' || CAST(o_custkey % 40 AS STRING) END AS incident_zip,
               CAST(year(o_orderdate) + 23 AS INT) AS year,
               CAST(month(o_orderdate) AS INT) AS month,
               CAST(o_orderkey % 24 AS INT) AS hour,
               (o_orderkey % 24 >= 22 OR o_orderkey % 24 <= 5) AS is_overnight
        FROM {{orders}}""",
    "flood_events": f"""
        SELECT event_id, 'Sensor ' || CAST(user_id AS STRING) AS sensor_name,
               'S' || CAST(user_id AS STRING) AS sensor_id,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS flood_start_time,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts + CAST(event_id % 75 AS INT) * INTERVAL 1 MINUTE END AS flood_end_time,
               CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(floor(value) AS DOUBLE) / 16 END AS max_depth_inches,
               CAST(event_id % 30 AS DOUBLE) AS onset_time_mins,
               CAST(event_id % 45 AS DOUBLE) AS drain_time_mins,
               CAST(event_id % 75 AS DOUBLE) AS duration_mins,
               CASE event_id % 8 WHEN 6 THEN '[1.5, 2' WHEN 7 THEN '[4.25]'
                    ELSE '[0.0, ' || CAST(event_id % 9 AS STRING) || '.5, ' || CAST(user_id % 7 AS STRING) || '.25, 0.5]' END AS flood_profile_depth_inches,
               CASE event_id % 8 WHEN 5 THEN '[0, 60]' WHEN 7 THEN '[0]'
                    ELSE '[0, 60, ' || CAST(120 + event_id % 4 * 30 AS STRING) || ', 300]' END AS flood_profile_time_secs
        FROM {{events}}""",
    "sensors": f"""
        SELECT 'Sensor ' || CAST(c_custkey AS STRING) AS sensor_name,
               'S' || CAST(c_custkey AS STRING) AS sensor_id,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE DATE '2020-03-01' + CAST(c_custkey % 900 AS INT) END AS date_installed,
               CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS tidally_influenced,
               CAST(NULL AS DATE) AS date_removed,
               'Street ' || CAST(c_custkey % 50 AS STRING) AS street_name,
               {_choose('c_custkey % 7', *_NAMES, None, 'Queens')} AS borough,
               CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE 'Z' || CAST(c_custkey % 40 AS STRING) END AS zipcode,
               c_custkey % 18 + 101 AS community_board,
               CAST(c_custkey % 51 AS STRING) AS council_district,
               CAST(c_custkey % 200 AS STRING) AS census_tract,
               'N' || CAST(c_custkey % 60 AS STRING) AS nta,
               CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 40.5 + CAST(c_custkey % 64 AS DOUBLE) / 128 END AS latitude,
               CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE -74.25 + CAST(c_custkey % 80 AS DOUBLE) / 128 END AS longitude,
               CAST(c_custkey % 5 AS DOUBLE) AS lowest_point_height_delta_inches
        FROM {{customer}}""",
    # The enriched flood table in plain SQL, for the reports that read it.
    "floods": """
        SELECT e.event_id, e.sensor_name, e.sensor_id, s.borough, s.zipcode, e.flood_start_time, e.max_depth_inches, e.duration_mins,
               CASE WHEN e.max_depth_inches < 4 THEN 'minor' WHEN e.max_depth_inches < 12 THEN 'moderate'
                    WHEN e.max_depth_inches < 24 THEN 'major' ELSE 'severe' END AS flood_severity,
               CAST(year(e.flood_start_time) AS INT) AS flood_year, CAST(month(e.flood_start_time) AS INT) AS flood_month,
               CAST(hour(e.flood_start_time) AS INT) AS flood_hour,
               CASE WHEN event_kind = 0 THEN 'winter' WHEN event_kind = 1 THEN 'spring' WHEN event_kind = 2 THEN 'summer' ELSE 'fall' END AS flood_season,
               (hour(e.flood_start_time) >= 22 OR hour(e.flood_start_time) <= 5) AS flood_is_overnight,
               CASE WHEN e.onset_time_mins <> 0 THEN e.max_depth_inches / e.onset_time_mins END AS rise_rate_in_per_min,
               CASE WHEN e.duration_mins <> 0 THEN e.onset_time_mins / e.duration_mins END AS time_to_peak_pct
        FROM (SELECT *, CAST(onset_time_mins AS INT) % 4 AS event_kind FROM {flood_events}) e
        LEFT JOIN {sensors} s ON e.sensor_id = s.sensor_id""",
    "payroll": f"""
        SELECT 'Agency ' || CAST(l_suppkey % 40 AS STRING) AS agency_name,
               {_choose('l_partkey % 4', 'per Annum', 'per Hour', 'per Day', 'Prorated Annual')} AS pay_basis,
               CAST(2021 + l_orderkey % 5 AS INT) AS fiscal_year,
               {_amount('l_partkey * 37 % 90000')} AS base_salary,
               {_amount('l_orderkey * 11 % 80000')} AS regular_gross_paid,
               {_amount('l_partkey % 9000')} AS total_ot_paid,
               {_amount('l_linenumber * 100')} AS total_other_pay
        FROM {{lineitem}}""",
    "inspections": f"""
        SELECT 'Place ' || CAST(l_partkey AS STRING) AS dba,
               'Cuisine ' || CAST(l_suppkey % 12 AS STRING) AS cuisine_description,
               {_choose('l_suppkey % 5', *_NAMES)} AS boro,
               {_choose('l_partkey % 7', 'A', 'A', 'A', 'B', 'C', 'Z', None)} AS grade,
               CASE WHEN l_linenumber > 3 THEN 'Critical' ELSE 'Not Critical' END AS critical_flag,
               CASE WHEN l_orderkey % 30 < 25 THEN 'Violation ' || CAST(l_orderkey % 30 AS STRING) END AS violation_description,
               CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_partkey % 80 AS INT) END AS score,
               CAST(l_shipdate + INTERVAL 24 YEAR AS DATE) AS inspection_date,
               CAST(year(l_shipdate) + 24 AS INT) AS year
        FROM {{lineitem}}""",
    "shootings": f"""
        SELECT CAST(year(l_shipdate) + 23 AS INT) AS year,
               {_choose('l_suppkey % 5', *_BOROUGHS)} AS boro,
               CAST(l_suppkey % 77 + 1 AS INT) AS precinct,
               {_choose('l_linenumber', 'UNKNOWN', '<18', '18-24', '25-44', '45-64', '65+')} AS victim_age_group,
               CASE WHEN l_partkey % 5 = 0 THEN 'true' ELSE 'false' END AS stat_murder_flg
        FROM {{lineitem}}""",
    "housing": f"""
        SELECT c_name AS lottery_name,
               {_choose('c_nationkey % 6', *_NAMES, None)} AS borough,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(c_custkey * 13 % 701 AS BIGINT) END AS unit_count,
               c_custkey % 20 AS unit_distribution_studio, c_custkey % 30 AS unit_distribution_1bed,
               c_custkey % 25 AS unit_distribution_2bed, c_custkey % 10 AS unit_distribution_3bed,
               {_choose('c_custkey % 3', 'Open', 'Filled', 'Closed')} AS lottery_status,
               CAST(c_custkey % 120 AS BIGINT) AS lottery_duration_days,
               {_amount('c_custkey % 9', 1)} AS applied_income_ami_ext_low, {_amount('c_custkey % 11', 1)} AS applied_income_ami_very_low,
               {_amount('c_custkey % 40', 1)} AS applied_income_ami_low, {_amount('c_custkey % 17', 1)} AS applied_income_ami_moderate,
               {_amount('c_custkey % 6', 1)} AS applied_income_ami_middle, {_amount('c_custkey % 3', 1)} AS applied_income_ami_above
        FROM {{customer}}""",
    "hourly": f"""
        SELECT l_shipdate + INTERVAL 24 YEAR + CAST(l_partkey % 24 AS INT) * INTERVAL 1 HOUR AS transit_timestamp,
               'Station ' || CAST(l_suppkey AS STRING) AS station_complex,
               {_choose('l_suppkey % 5', *_NAMES)} AS borough,
               CAST(l_quantity AS DOUBLE) AS ridership, CAST(l_linenumber AS DOUBLE) AS transfers,
               CAST(year(l_shipdate) + 24 AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
               CAST(l_partkey % 24 AS INT) AS hour, l_orderkey, l_linenumber, l_partkey
        FROM {{lineitem}}""",
    "budget": f"""
        SELECT 'Category ' || CAST(l_partkey % 30 AS STRING) AS funding_category,
               'Sponsor ' || CAST(l_suppkey % 60 AS STRING) AS sponsor,
               CAST(2020 + l_orderkey % 6 AS STRING) AS fiscal_year,
               {_amount('l_orderkey * 3 % 50000')} AS award
        FROM {{lineitem}}""",
    "spending": f"""
        SELECT 'Agency ' || CAST(o_custkey % 35 AS STRING) AS agency, CAST(2020 + o_orderkey % 6 AS INT) AS fiscal_year,
               CAST(o_orderdate + INTERVAL 23 YEAR AS DATE) AS issue_date, {_amount('o_orderkey % 9999')} AS check_amount, o_orderkey
        FROM {{orders}}""",
    "arrests": f"""
        SELECT {_choose('l_partkey % 5', 'ASSAULT', 'ROBBERY', 'LARCENY', 'FRAUD', 'BURGLARY')} AS ofns_desc,
               {_choose('l_suppkey % 5', 'M', 'B', 'K', 'Q', 'S')} AS arrest_boro, CAST(year(l_shipdate) + 23 AS INT) AS year
        FROM {{lineitem}}""",
    "courts": """
        SELECT 'Court ' || CAST(o_custkey % 62 AS STRING) AS court_name, CAST(year(o_orderdate) + 23 AS STRING) AS arrest_year
        FROM {orders}""",
    # Text as it lands: numbers with signs and commas, words for booleans, dates in many layouts.
    "landing_text": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE l_partkey % 9
                    WHEN 0 THEN '$' || CAST(l_extendedprice AS STRING)
                    WHEN 1 THEN '  ' || CAST(l_extendedprice AS STRING) || ' '
                    WHEN 2 THEN 'abc'
                    WHEN 3 THEN NULL
                    WHEN 4 THEN CAST(l_partkey AS STRING) || ',' || lpad(CAST(l_suppkey AS STRING), 3, '0') || '.5'
                    WHEN 5 THEN '-$' || CAST(l_quantity AS STRING)
                    WHEN 6 THEN '1d'
                    WHEN 7 THEN CAST(l_partkey AS STRING) || ' ' || '000'
                    ELSE CAST(l_extendedprice AS STRING) END AS price_text,
               CASE l_partkey % 8
                    WHEN 0 THEN CAST(l_orderkey AS STRING)
                    WHEN 1 THEN CAST(l_suppkey AS STRING) || ',' || lpad(CAST(l_linenumber AS STRING), 3, '0')
                    WHEN 2 THEN '12.0'
                    WHEN 3 THEN ' 5 '
                    WHEN 4 THEN NULL
                    WHEN 5 THEN '-' || CAST(l_partkey AS STRING)
                    WHEN 6 THEN 'n/a'
                    ELSE '99999999999999999999' END AS quantity_text,
               {_choose('l_partkey % 18', '1', 't', 'TRUE', ' yes ', 'Y', '0', 'f', 'False', 'NO', 'n', 'maybe', '', None, '100', '-5', "('yes' || chr(13))", "(chr(9) || 'no')", "(chr(9) || 'True' || chr(10))")} AS flag_text
        FROM {{lineitem}}""",
    "dated_text": f"""
        SELECT o_orderkey, o_custkey, o_orderdate,
               CASE WHEN o_orderkey % 101 = 0 THEN '2024-03-10T02:30:00'
                    WHEN o_orderkey % 103 = 0 THEN '2024-11-03 01:30:00'
                    ELSE CASE o_orderkey % 12
                         WHEN 0 THEN d || 'T' || t || '.123Z'
                         WHEN 1 THEN d || 'T' || t || 'Z'
                         WHEN 2 THEN d || 'T' || t || '.5'
                         WHEN 3 THEN d || 'T' || t
                         WHEN 4 THEN d || ' ' || t || '.000250'
                         WHEN 5 THEN d || ' ' || t
                         WHEN 6 THEN d
                         WHEN 7 THEN replace(d, '-', '')
                         WHEN 8 THEN substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4)
                         WHEN 9 THEN 'not a date'
                         WHEN 10 THEN '2023-02-30'
                         ELSE NULL END END AS date_text
        FROM (SELECT o_orderkey, o_custkey, o_orderdate,
                     CAST(year(o_orderdate) AS STRING) || '-' || {_two('month(o_orderdate)')} || '-' || {_two('day(o_orderdate)')} AS d,
                     {_two('o_orderkey % 24')} || ':' || {_two('o_orderkey % 60')} || ':' || {_two('o_custkey % 60')} AS t
              FROM {{orders}}) x""",
    "places": f"""
        SELECT c_custkey, c_acctbal,
               {_choose('c_custkey % 30', 'MANHATTAN', 'bronx', 'Brooklyn', ' queens ', 'Staten Island', 'M', 'b', 'K', 'q', 'S', 'X', 'r',
                        'MN', 'BX', 'bk', 'QN', 'SI', '1', '2', '3', '4', '5', 'New York', 'kings', 'Richmond',
                        'RICHMOND / STATEN ISLAND', 'Atlantis', '', None, '6')} AS borough,
               CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_custkey * 7 % 130000 END AS block,
               CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey % 11000 END AS lot,
               {_choose('c_custkey % 6', '1', '02', '12', ' 7 ', '112', None)} AS district,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 40.25 + CAST(c_custkey % 128 AS DOUBLE) / 128 END AS latitude,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE -74.5 + CAST(c_custkey % 128 AS DOUBLE) / 128 END AS longitude
        FROM {{customer}}""",
    # Text fields with blanks, lists and markers.
    "notes": """
        SELECT p_partkey, p_name, p_type, p_brand,
               '  ' || p_name || CASE p_partkey % 3 WHEN 0 THEN '   x' WHEN 1 THEN chr(9) || 'y' || chr(10) ELSE ' ' END || p_type AS messy,
               p_name || CASE p_partkey % 3 WHEN 0 THEN '|' WHEN 1 THEN '||' ELSE ' | ' END || p_type || '|' || p_brand AS listed
        FROM {part}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _inputs(sql: str) -> list[str]:
    return list(dict.fromkeys(_PLACEHOLDER.findall(sql)))


SHAPES: dict[str, tuple[str, list[str]]] = {name: (sql, _inputs(sql)) for name, sql in _SQL.items()}


def expand(sql: str) -> str:
    """DuckDB text of a query: shapes named ``{shape}`` become common table expressions."""
    needed: list[str] = []

    def need(name: str) -> None:
        for inner in SHAPES[name][1]:
            if inner in SHAPES:
                need(inner)
        if name not in needed:
            needed.append(name)

    for name in _inputs(sql):
        if name in SHAPES:
            need(name)
    body = _PLACEHOLDER.sub(r"\1", sql).strip()
    if not needed:
        return body
    shapes = ", ".join(f"{n} AS ({_PLACEHOLDER.sub(chr(92) + '1', SHAPES[n][0]).strip()})" for n in needed)
    rest = body[4:].lstrip() if body[:5].upper() == "WITH " else None
    return f"WITH {shapes}, {rest}" if rest else f"WITH {shapes} {body}"
