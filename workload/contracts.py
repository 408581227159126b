"""P and C: contracts, projections, predicates and lenient conversions."""

from datetime import datetime

from pyspark.sql import functions as F

from civiclake import contracts
from civiclake.functions import coerce
from civiclake.functions.numeric import ratio
from civiclake.operators import enrichments, filters, layout
from workload import duck
from workload.registry import query

CONTRACT = {
    "l_orderkey": ("id", "bigint", "Row key"),
    "price_text": ("price", "double", "Price"),
    "quantity_text": ("quantity", "bigint", "Quantity"),
    "flag_text": ("flag", "boolean", "Flag"),
    "not_there": ("note", "string", "Absent from the input"),
}
_CONTRACT_SQL = (f"l_orderkey AS id, {duck.number('price_text')} AS price, {duck.whole_number('quantity_text')} AS quantity, "
                 f"{duck.truth('flag_text')} AS flag, CAST(NULL AS VARCHAR) AS note")


@query("P01_contract_strict", f"SELECT {_CONTRACT_SQL} FROM {{landing_text}}")
def _(s):
    return contracts.apply_schema_contract(s.landing_text, CONTRACT)


@query("P02_contract_resilient", f"SELECT {_CONTRACT_SQL}, l_linenumber, l_partkey, l_suppkey FROM {{landing_text}}")
def _(s):
    return contracts.apply_schema_contract(s.landing_text, CONTRACT, drop_unknown=False)


@query("P03_missing_column_as_null", """
    SELECT o_orderkey, CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS DATE) AS due, CAST(NULL AS BOOLEAN) AS paid FROM orders""")
def _(s):
    return contracts.apply_schema_contract(s.orders, {
        "o_orderkey": ("o_orderkey", "bigint"), "amt": ("amount", "double"), "due_on": ("due", "date"), "paid": ("paid", "boolean")})


@query("P04_normalized_contract", f"""
    SELECT count(*) AS row_count, count(price) AS prices, count(quantity) AS quantities, count(flag) AS flags, count(note) AS notes
    FROM (SELECT {_CONTRACT_SQL} FROM {{landing_text}})""")
def _(s):
    contract, described = contracts.normalize_contract(CONTRACT)
    assert described
    return contracts.apply_schema_contract(s.landing_text, contract).agg(
        F.count("*").alias("row_count"), F.count("price").alias("prices"), F.count("quantity").alias("quantities"),
        F.count("flag").alias("flags"), F.count("note").alias("notes"))


# The dictionary rows beside the number of filled values each column has in the data.
@query("P05_column_dictionary", f"""
    WITH clean AS (SELECT {_CONTRACT_SQL} FROM {{landing_text}}),
    filled AS (SELECT unnest(['id','price','quantity','flag','note','year']) AS name,
                      unnest([count(id), count(price), count(quantity), count(flag), count(note), NULL]) AS filled FROM clean)
    SELECT d.*, f.filled FROM (VALUES
        ('id','number','l_orderkey','Row key'), ('price','number','price_text','Price'),
        ('year','number',NULL,'Derived'), ('quantity','number','quantity_text','Quantity'),
        ('flag','boolean','flag_text','Flag'), ('note','string','not_there','Absent from the input')
    ) d(name, type, api_name, description) JOIN filled f USING (name)""")
def _(s):
    derived = {"price": [{"name": "year", "type": "number", "description": "Derived"}]}
    words = contracts.dictionary_frame(s.spark, contracts.column_dictionary(CONTRACT, insert_after=derived))
    clean = contracts.apply_schema_contract(s.landing_text, CONTRACT)
    counts = clean.agg(*[F.count(c).alias(c) for c in clean.columns])
    return words.join(counts.unpivot([], clean.columns, "name", "filled"), "name", "left")


@query("P06_table_schema", f"""
    SELECT d.name, d.type, d.comment, c.distinct_values FROM
    (VALUES ('id','bigint','Row key'), ('price','double','Price'), ('quantity','bigint','Quantity'), ('flag','boolean','Flag'),
            ('note','string','Absent from the input')) d(name, type, comment)
    JOIN (SELECT unnest(['id','price','quantity','flag','note']) AS name, unnest([count(DISTINCT id), count(DISTINCT price),
          count(DISTINCT quantity), count(DISTINCT flag), count(DISTINCT note)]) AS distinct_values
          FROM (SELECT {_CONTRACT_SQL} FROM {{landing_text}})) c USING (name)""")
def _(s):
    schema = contracts.build_table_schema(CONTRACT)
    clean = contracts.with_comments(contracts.apply_schema_contract(s.landing_text, CONTRACT), schema)
    rows = [(f.name, f.dataType.simpleString(), clean.schema[f.name].metadata.get("comment")) for f in schema.fields]
    described = s.spark.createDataFrame(rows, "name string, type string, comment string")
    counts = clean.agg(*[F.countDistinct(c).alias(c) for c in clean.columns]).unpivot([], clean.columns, "name", "distinct_values")
    return described.join(counts, "name")


@query("P07_derived_dictionary", """
    SELECT name, type, n FROM (VALUES ('borough_key','string'), ('borough_code','int'), ('borough_name','string')) d(name, type)
    JOIN (SELECT unnest(['borough_key','borough_code','borough_name']) AS name, unnest([count(code), count(code), count(code)]) AS n
          FROM (SELECT """ + duck.BOROUGH_CODES + """ AS code FROM {places})) USING (name)""")
def _(s):
    bundle = enrichments.StandardEnrichments(borough=enrichments.BoroughConfig("borough", True, True, True))
    columns = bundle.build_derived_columns()
    made = s.places.transform(bundle.build_transform_fn())
    names = [c.name for c in columns]
    rows = s.spark.createDataFrame([(c.name, c.dataType.simpleString()) for c in columns], "name string, type string")
    return rows.join(made.agg(*[F.count(n).alias(n) for n in names]).unpivot([], names, "name", "n"), "name")


@query("P08_reorder_columns", "SELECT o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey, o_custkey FROM orders")
def _(s):
    moved = layout.reorder_columns(s.orders.drop("o_orderstatus", "o_orderpriority"), ["o_totalprice", "nowhere", "o_orderdate"])
    assert moved.columns == ["o_totalprice", "o_orderdate", "o_orderkey", "o_custkey"]
    return moved.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("P09_declarative_clean", f"""
    SELECT l_orderkey AS id, {duck.number('price_text')} AS price_text, {duck.whole_number('quantity_text')} AS quantity_text,
           {duck.truth('flag_text')} AS flag_text FROM {{landing_text}}""")
def _(s):
    landing = s.landing_text.select("l_orderkey", "price_text", "quantity_text", "flag_text")
    return contracts.clean_columns(landing, rename_map={"l_orderkey": "id"}, int_cols=["quantity_text"],
                                   float_cols=["price_text"], bool_cols=["flag_text"])


@query("P10_time_window", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""")
def _(s):
    window = (datetime(1997, 1, 1), datetime(1997, 7, 1))
    bounds = [F.lit(b).cast("timestamp_ntz") for b in window]
    return s.orders.where(filters.partition_filter("o_orderdate", window=tuple(bounds))).select("o_orderkey", "o_totalprice")


@query("P11_equality_partition", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'")
def _(s):
    return s.orders.where(filters.partition_filter("o_orderpriority", kind="equality", key="2-HIGH")).select("o_orderkey", "o_totalprice")


@query("P12_criteria", """
    SELECT o_orderkey, fiscal_year, check_amount FROM {spending}
    WHERE issue_date BETWEEN DATE '2020-01-01' AND DATE '2020-12-31' AND fiscal_year = 2022 AND agency = 'Agency 3'""")
def _(s):
    rules = [{"name": "issue_date", "type": "range", "start": "2020-01-01", "end": "2020-12-31"},
             {"name": "fiscal_year", "type": "value", "value": 2022}]
    return filters.apply_criteria(s.spending, rules, [{"name": "agency", "type": "value", "value": "Agency 3"}]) \
        .select("o_orderkey", "fiscal_year", "check_amount")


@query("P13_null_and_inequality", """
    SELECT count(*) AS n FROM {collisions} WHERE crash_date IS NOT NULL AND borough IS NOT NULL AND borough <> 'BRONX'
    AND number_of_persons_injured >= 2 AND number_of_persons_killed > 0""")
def _(s):
    c = F.col
    return s.collisions.where(c("crash_date").isNotNull() & c("borough").isNotNull() & (c("borough") != "BRONX")
                              & (c("number_of_persons_injured") >= 2) & (c("number_of_persons_killed") > 0)) \
        .agg(F.count("*").alias("n"))


@query("P14_in_between_modulo", """
    SELECT cb_number, count(*) AS n FROM {requests} WHERE complaint_type IN ('Sewer', 'Noise') AND cb_number BETWEEN 101 AND 599
    AND cb_number % 100 BETWEEN 1 AND 18 GROUP BY 1""")
def _(s):
    board = F.col("cb_number")
    return s.requests.where(F.col("complaint_type").isin("Sewer", "Noise") & board.between(101, 599) & (board % 100).between(1, 18)) \
        .groupBy("cb_number").agg(F.count("*").alias("n"))


@query("P15_like_any", """
    SELECT complaint_type, count(*) AS n FROM {requests} WHERE complaint_type ILIKE '%flood%' OR complaint_type ILIKE '%sewer%'
    OR complaint_type ILIKE '%STORM%' OR complaint_type LIKE 'Water%' GROUP BY 1""")
def _(s):
    kind = F.col("complaint_type")
    wet = filters.contains_any("complaint_type", ["flood", "sewer", "STORM"])
    return s.requests.where(wet | kind.like("Water%")).groupBy("complaint_type").agg(F.count("*").alias("n"))


@query("P16_case_labels", """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 'pandemic_trough' WHEN year(o_orderdate) BETWEEN 1998 AND 1999 THEN 'recovery'
    WHEN year(o_orderdate) >= 2000 THEN 'post_recovery' ELSE 'pre_pandemic' END AS era FROM orders""")
def _(s):
    year = F.year("o_orderdate")
    return s.orders.select("o_orderkey", F.when(year == 1997, "pandemic_trough").when(year.between(1998, 1999), "recovery")
                           .when(year >= 2000, "post_recovery").otherwise("pre_pandemic").alias("era"))


@query("P17_row_index", "SELECT count(*) AS row_count, count(*) AS ids FROM lineitem")
def _(s):
    return layout.with_row_index(s.lineitem, "i").agg(F.count("*").alias("row_count"), F.countDistinct("i").alias("ids"))


@query("P18_transform_hook", f"""
    SELECT quantity, count(*) AS n, round(sum(price), 2) AS price FROM (SELECT {_CONTRACT_SQL} FROM {{landing_text}})
    WHERE quantity IS NOT NULL AND flag GROUP BY 1""")
def _(s):
    def own(df):
        return df.where(F.col("quantity").isNotNull() & F.col("flag")).groupBy("quantity").agg(
            F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("price"))

    return s.landing_text.transform(contracts.apply_schema_contract, CONTRACT).transform(own)


@query("C01_multi_parse_date", f"SELECT o_orderkey, {duck.utc_text(duck.parsed_instant('date_text'))} AS instant FROM {{dated_text}}")
def _(s):
    instant = coerce.multi_parse_date("date_text")
    return s.dated_text.select("o_orderkey", F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("instant"))


@query("C02_local_date", f"""
    SELECT o_orderkey, CAST(timezone('{duck.NY}', {duck.parsed_instant('date_text')}) AS DATE) AS day FROM {{dated_text}}""")
def _(s):
    return s.dated_text.select("o_orderkey", coerce.parse_local_date("date_text").alias("day"))


@query("C03_safe_bool", f"SELECT l_partkey % 15 AS word, {duck.truth('flag_text')} AS flag, count(*) AS n FROM {{landing_text}} GROUP BY 1, 2")
def _(s):
    return s.landing_text.groupBy((F.col("l_partkey") % 15).alias("word"), coerce.safe_bool("flag_text").alias("flag")) \
        .agg(F.count("*").alias("n"))


@query("C04_safe_float", f"SELECT l_orderkey, l_linenumber, l_partkey, {duck.number('price_text')} AS price FROM {{landing_text}}")
def _(s):
    return s.landing_text.select("l_orderkey", "l_linenumber", "l_partkey", coerce.safe_float("price_text").alias("price"))


@query("C05_integers", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {duck.whole_number('quantity_text')} AS q64, {duck.whole_number('quantity_text', 'SMALLINT')} AS q16,
           CAST({duck.whole_number('quantity_text', 'USMALLINT')} AS INT) AS u16 FROM {{landing_text}}""")
def _(s):
    kinds = {"q64": "bigint", "q16": "smallint", "u16": "uint16"}
    return s.landing_text.select("l_orderkey", "l_linenumber", "l_partkey",
                                 *[contracts.coerce_column("quantity_text", k).alias(n) for n, k in kinds.items()])


@query("C06_generic_cast", "SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def _(s):
    return s.orders.select("o_orderkey", contracts.coerce_column("o_totalprice", "string").alias("price"),
                           contracts.coerce_column("o_custkey", "string").alias("customer"))


@query("C07_dispatch_by_type", f"""
    SELECT o_orderkey, CAST(timezone('{duck.NY}', {duck.parsed_instant('date_text')}) AS DATE) AS d,
           {duck.utc_text(duck.parsed_instant('date_text'))} AS ts, {duck.number('date_text')} AS f, {duck.whole_number('date_text')} AS i,
           {duck.truth('date_text')} AS b, date_text AS t FROM {{dated_text}}""")
def _(s):
    kinds = {"d": "date", "ts": "timestamp", "f": "double", "i": "bigint", "b": "boolean", "t": "string"}
    made = s.dated_text.select("o_orderkey", *[contracts.coerce_column("date_text", k).alias(n) for n, k in kinds.items()])
    return made.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_MONTH = "TRY_CAST(trim(split_part(month, ' / ', {})) AS INT)"


@query("C08_split_and_try_cast", f"SELECT {_MONTH.format(1)} AS year, {_MONTH.format(2)} AS month_num, count(*) AS n FROM {{tonnage}} GROUP BY 1, 2")
def _(s):
    from civiclake.plans.analytics import month_part

    return s.tonnage.groupBy(month_part("month", 1).alias("year"), month_part("month", 2).alias("month_num")).agg(F.count("*").alias("n"))


@query("C09_strict_casts", """
    SELECT CAST(extract(year FROM o_orderdate) AS INT) AS y, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS f,
           min(o_orderdate::DATE) AS first_day FROM orders GROUP BY 1""")
def _(s):
    return s.sql("""SELECT extract(year FROM o_orderdate)::INT AS y, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS f,
                    min(o_orderdate::DATE) AS first_day FROM {orders} GROUP BY 1""", "orders")
