"""Queries over projections, filters, null handling, casts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions import dates, strings, text
from caseloom.operators import clean
from caseloom.operators.ordered import drop_last, with_position
from caseloom.registry.core import Tables, query


@query("named_projection", """SELECT c_name AS "Customer Name", c_acctbal / 1000 AS balance_k FROM customer""")
def named_projection(t: Tables):
    return clean.project(t("customer"), {"Customer Name": "c_name", "balance_k": "c_acctbal / 1000"})


@query("rename_columns", "SELECT p_partkey AS part_key, p_name AS part_name, p_brand, p_type, p_size, p_retailprice FROM part")
def rename_columns(t: Tables):
    return clean.rename(t("part"), {"p_partkey": "part_key", "p_name": "part_name"})


@query("drop_columns", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def drop_columns(t: Tables):
    return t("part").drop("p_type", "p_size")


@query("select_columns", "SELECT l_shipdate, l_orderkey, l_quantity FROM lineitem")
def select_columns(t: Tables):
    return t("lineitem").select("l_shipdate", "l_orderkey", "l_quantity")


@query(
    "derived_arith",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount + l_tax AS rate_sum, l_quantity * l_quantity AS qty_squared,
    sqrt(l_quantity) AS qty_root, l_extendedprice / l_quantity AS unit_price, l_extendedprice / 1073741824 AS price_g,
    round_even(l_extendedprice / 1000, 1) AS price_k FROM lineitem""",
)
def derived_arith(t: Tables):
    return clean.project(t("lineitem"), {
        "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey",
        "rate_sum": "l_discount + l_tax", "qty_squared": "l_quantity * l_quantity", "qty_root": "sqrt(l_quantity)",
        "unit_price": "l_extendedprice / l_quantity", "price_g": "l_extendedprice / power(1024, 3)",
        "price_k": "bround(l_extendedprice / 1000, 1)",
    })


@query(
    "case_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN nullif(l_quantity, 10) > 25 THEN 'large' ELSE 'small' END AS category FROM lineitem""",
)
def case_flag(t: Tables):
    condition = F.nullif("l_quantity", F.lit(10.0)) > 25
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", clean.flag(condition, "large", "small").alias("category")
    )


@query(
    "composite_key",
    "SELECT l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey AS case_key, l_quantity FROM lineitem",
)
def composite_key(t: Tables):
    keyed = clean.composite_key(t("lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return keyed.select("case_key", "l_quantity")


@query(
    "row_filters",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 10 AND l_quantity <= 40 AND l_shipdate >= TIMESTAMP '1998-02-10'
    AND NOT (l_linestatus = 'F' OR l_tax IS NULL)""",
)
def row_filters(t: Tables):
    c = F.col
    return t("lineitem").where(
        (c("l_returnflag") == "R") & (c("l_quantity") >= 10) & (c("l_quantity") <= 40)
        & (c("l_shipdate") >= F.lit("1998-02-10").cast("timestamp_ntz"))
        & ~((c("l_linestatus") == "F") | c("l_tax").isNull())
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")


@query("contains_filter", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[0-9]{3}|@')")
def contains_filter(t: Tables):
    return clean.contains_pattern(t("documents"), "text", "[0-9]{3}|@").select("doc_id", "lang")


@query(
    "drop_nulls",
    """SELECT c_custkey, o_orderkey, nullif(o_orderstatus, 'P') AS status FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey WHERE o_orderkey IS NOT NULL AND nullif(o_orderstatus, 'P') IS NOT NULL""",
)
def drop_nulls(t: Tables):
    joined = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return clean.drop_nulls(joined.selectExpr("c_custkey", "o_orderkey", "nullif(o_orderstatus, 'P') AS status"))


@query(
    "fill_mean",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(nullif(l_quantity, 7), (SELECT avg(nullif(l_quantity, 7)) FROM lineitem)), 6) AS quantity
    FROM lineitem""",
)
def fill_mean(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    gaps = t("lineitem").select(*keys, F.nullif("l_quantity", F.lit(7.0)).alias("quantity"))
    return clean.fill_mean(gaps, "quantity").withColumn("quantity", F.round("quantity", 6))


@query("fill_constant", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'none') AS status FROM orders")
def fill_constant(t: Tables):
    return clean.fill_constant(t("orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'F') AS status"), "status", "none")


@query("drop_sparse_columns", "SELECT o_orderkey, CASE WHEN o_totalprice > 5000 THEN o_totalprice END AS nearly_full FROM orders")
def drop_sparse_columns(t: Tables):
    frame = t("orders").selectExpr(
        "o_orderkey", "CASE WHEN o_totalprice > 5000 THEN o_totalprice END AS nearly_full",
        "nullif(o_orderstatus, 'P') AS sparse",
    )
    return clean.drop_sparse_columns(frame, 0.9)


@query("cap_outliers", "SELECT o_orderkey, least(o_totalprice, 300000) AS o_totalprice FROM orders")
def cap_outliers(t: Tables):
    return clean.cap_outliers(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 300000.0)


@query(
    "drop_last_n",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 2)",
)
def drop_last_n(t: Tables):
    return drop_last(t("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 2)


@query("row_position", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders")
def row_position(t: Tables):
    return with_position(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).drop("o_totalprice")


@query(
    "typed_cast",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k_int, TRY_CAST(event_type AS INTEGER) AS no_int,
    CAST(value AS INTEGER) AS value_int, CAST(ts AS DATE) AS day, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS again FROM events""",
)
def typed_cast(t: Tables):
    raw = t("events").select(
        "event_id", F.regexp_extract("props", "([0-9]+)", 1).alias("k_int"), F.col("event_type").alias("no_int"),
        F.bround("value").alias("value_int"), F.col("ts").cast("string").alias("again"), F.col("ts").alias("day"),
    )
    kinds = {"k_int": "int", "no_int": "int", "value_int": "int", "day": "date", "again": "timestamp_ntz"}
    return clean.cast_columns(raw, kinds)


@query(
    "any_over_threshold",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > 0.07 OR l_tax > 0.07",
)
def any_over_threshold(t: Tables):
    frame = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax")
    return clean.any_over(frame, ["l_discount", "l_tax"], 0.07)


@query(
    "column_profile",
    """SELECT 'o_orderkey' AS "column", 'bigint' AS type, count(*) AS n, count(*) - count(o_orderkey) AS nulls, count(DISTINCT o_orderkey) AS "distinct" FROM orders
    UNION ALL SELECT 'status', 'string', count(*), count(*) - count(nullif(o_orderstatus, 'P')), count(DISTINCT nullif(o_orderstatus, 'P')) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(*), count(*) - count(o_totalprice), count(DISTINCT o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(*), count(*) - count(o_orderdate), count(DISTINCT o_orderdate) FROM orders""",
)
def column_profile(t: Tables):
    return clean.column_profile(t("orders").selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') AS status", "o_totalprice", "o_orderdate"
    ))


@query("target_rate", "SELECT round(100.0 * avg(CAST(quality AS DOUBLE)), 6) AS target_rate FROM labels")
def target_rate(t: Tables):
    return clean.target_rate(t("labels"), "quality").select(F.round("target_rate", 6).alias("target_rate"))


# Scalar functions


@query("round_day", "SELECT event_id, date_trunc('day', ts) AS day FROM events")
def round_day(t: Tables):
    return t("events").select("event_id", dates.round_day("ts").alias("day"))


@query("parse_date", "SELECT o_orderkey, o_orderdate AS parsed, o_orderdate AS month_first FROM orders")
def parse_date(t: Tables):
    written = t("orders").select(
        "o_orderkey", dates.format_timestamp("o_orderdate", "%Y-%m-%d %H:%M:%S").alias("a"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("b"),
    )
    return written.select(
        "o_orderkey", dates.parse_timestamp("a", "%Y-%m-%d %H:%M:%S").alias("parsed"), dates.parse_month_first("b").alias("month_first")
    )


@query("epoch_ms", "SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events")
def epoch_ms(t: Tables):
    millis = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return t("events").select("event_id", dates.epoch_millis_to_timestamp(millis).alias("ts"))


@query(
    "iso_week",
    """SELECT o_orderkey, week(o_orderdate) AS iso_week, isoyear(o_orderdate) AS iso_year,
    CAST(date_trunc('week', o_orderdate) - INTERVAL 7 DAY AS TIMESTAMP) AS previous_monday FROM orders""",
)
def iso_week(t: Tables):
    return t("orders").select(
        "o_orderkey", dates.iso_week("o_orderdate").cast("bigint").alias("iso_week"),
        dates.iso_year("o_orderdate").cast("bigint").alias("iso_year"),
        dates.previous_week_monday("o_orderdate").alias("previous_monday"),
    )


@query(
    "date_offset",
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 30 DAY AS TIMESTAMP) AS later,
    date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS age FROM orders""",
)
def date_offset(t: Tables):
    start = F.lit("1995-01-01").cast("date")
    return t("orders").select(
        "o_orderkey", dates.add_days("o_orderdate", 30).alias("later"),
        dates.days_between("o_orderdate", start).cast("bigint").alias("age"),
    )


@query("shift_dates", "SELECT o_orderkey, CAST(o_orderdate - INTERVAL 364 DAY AS TIMESTAMP) AS o_orderdate FROM orders")
def shift_dates(t: Tables):
    return t("orders").select("o_orderkey", dates.add_days("o_orderdate", -364).alias("o_orderdate"))


@query("format_ts", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d_%Hh%M') AS stamp FROM orders")
def format_ts(t: Tables):
    return t("orders").select("o_orderkey", dates.format_timestamp("o_orderdate", "%Y-%m-%d_%Hh%M").alias("stamp"))


@query(
    "literal_replace",
    """SELECT p_partkey, replace(p_brand, '#', '-') AS brand,
    CAST(replace(CAST(CAST(p_retailprice * 10 AS BIGINT) AS VARCHAR), ',', '') AS INTEGER) AS price FROM part""",
)
def literal_replace(t: Tables):
    grouped = F.format_number((F.col("p_retailprice") * 10).cast("decimal(20,0)"), 0)
    return t("part").select(
        "p_partkey", strings.literal_replace("p_brand", "#", "-").alias("brand"), strings.parse_number(grouped).alias("price")
    )


@query(
    "clean_text",
    f"""SELECT doc_id, replace(regexp_replace(regexp_replace(replace(text, ' the ', ' ''the'' '), '{text.EMAIL_PATTERN}', '', 'g'),
    '{text.SPACE_PATTERN}', ' ', 'g'), chr(39), '') AS cleaned FROM documents""",
)
def clean_text(t: Tables):
    quoted = F.replace("text", F.lit(" the "), F.lit(" 'the' "))
    return t.texts().select("doc_id", text.clean_text(quoted).alias("cleaned"))


@query(
    "string_basics",
    """SELECT c_custkey, upper(c_mktsegment) AS up, trim('  ' || c_name || ' ') AS trimmed, c_name || ':' || c_mktsegment AS joined,
    contains(c_name, '#0000') AS has_hash, starts_with(c_mktsegment, 'B') AS starts_b, ends_with(c_mktsegment, 'Y') AS ends_y FROM customer""",
)
def string_basics(t: Tables):
    return t("customer").select(
        "c_custkey", F.upper("c_mktsegment").alias("up"), F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
        F.concat("c_name", F.lit(":"), "c_mktsegment").alias("joined"), F.contains("c_name", F.lit("#0000")).alias("has_hash"),
        F.startswith("c_mktsegment", F.lit("B")).alias("starts_b"), F.endswith("c_mktsegment", F.lit("Y")).alias("ends_y"),
    )


@query("repair_encoding", "SELECT doc_id, text AS repaired FROM documents")
def repair_encoding(t: Tables):
    """Texts are damaged first (UTF-8 bytes read as Latin-1) and must come back whole."""
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t("documents").select("doc_id", strings.repair_encoding(damaged).alias("repaired"))


@query(
    "json_roundtrip",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS record, event_type AS decoded_type,
    json_extract_string(props, '$.k') AS k FROM events""",
)
def json_roundtrip(t: Tables):
    encoded = t("events").select("event_id", strings.to_json_record("event_id", "event_type").alias("record"), "props")
    return encoded.select(
        "event_id", "record", F.from_json("record", "event_type string")["event_type"].alias("decoded_type"),
        F.get_json_object("props", "$.k").alias("k"),
    )


@query("slug", "SELECT n_nationkey, replace(n_name || ' of ' || n_regionkey || '_' || n_nationkey, ' ', '_') AS slug FROM nation")
def slug(t: Tables):
    title = F.concat("n_name", F.lit(" of "), F.col("n_regionkey").cast("string"))
    return t("nation").select("n_nationkey", strings.slug(title, "n_nationkey").alias("slug"))


@query(
    "extract_field",
    "SELECT page_id, nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS page, nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host FROM pages",
)
def extract_field(t: Tables):
    return t("pages").select(
        "page_id", strings.extract_field("url", "page=([0-9]+)").alias("page"),
        strings.extract_field("url", "^https?://([^/?#]+)").alias("host"),
    )
