"""Queries over model queries, joins, aggregates, windows, ordering and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caseloom.functions.dates import round_day
from caseloom.operators import relational as rel
from caseloom.operators.ml import label_encode
from caseloom.operators.ordered import rolling_mean, shift_rows, zip_by_order
from caseloom.registry.core import Tables, query

# Model queries


@query(
    "daily_quantity_per_region",
    """SELECT date_trunc('day', o_orderdate) AS day, r_name AS region, sum(l_quantity) AS quantity FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def daily_quantity_per_region(t: Tables):
    flagship = t.model().query(
        dims={"day": "cast(date_trunc('day', orders.o_orderdate) as timestamp_ntz)", "region": "region.r_name"},
        measures={"quantity": "sum(lineitem.l_quantity)"},
        via={"nation": "customer"},
    )
    return flagship.to_df()


@query(
    "model_agg_filtered",
    "SELECT max(l_extendedprice) AS max_price, count(l_partkey) AS n_parts FROM lineitem WHERE l_quantity < 5 AND l_quantity > 3",
)
def model_agg_filtered(t: Tables):
    return t.model("lineitem").query(
        measures={"max_price": "max(l_extendedprice)", "n_parts": "count(l_partkey)"}, where=["l_quantity < 5", "l_quantity > 3"]
    ).to_df()


@query(
    "model_query_fk",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus AS status, c_name AS customer, n_name AS nation, r_name AS region
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 250000""",
)
def model_query_fk(t: Tables):
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return t.model().query(
        dims={**{k: f"lineitem.{k}" for k in keys}, "status": "orders.o_orderstatus", "customer": "customer.c_name",
              "nation": "nation.n_name", "region": "region.r_name"},
        where=["orders.o_totalprice > 250000"],
        via={"nation": "customer"},
    ).to_df()


@query(
    "model_query_grouped",
    """SELECT o_orderpriority AS priority, c_mktsegment AS segment, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice IS NOT NULL AND o_orderdate > TIMESTAMP '1996-08-17' GROUP BY 1, 2""",
)
def model_query_grouped(t: Tables):
    return t.model("orders", "customer").query(
        dims={"priority": "orders.o_orderpriority", "segment": "customer.c_mktsegment"},
        measures={"n_orders": "count(orders.o_orderkey)", "total": "round(sum(orders.o_totalprice), 2)"},
        where=["orders.o_totalprice IS NOT NULL", "orders.o_orderdate > to_timestamp_ntz('1996-08-17 00:00:00', 'yyyy-MM-dd HH:mm:ss')"],
    ).to_df()


@query(
    "model_query_page",
    """SELECT DISTINCT o_custkey AS customer, o_orderstatus AS status FROM orders ORDER BY customer DESC, status LIMIT 50 OFFSET 20""",
)
def model_query_page(t: Tables):
    return t.model("orders").query(
        dims={"customer": "orders.o_custkey", "status": "orders.o_orderstatus"},
        order=[("customer", "desc"), ("status", "asc")], distinct=True, limit=50, offset=20,
    ).to_df()


# Joins


@query(
    "enrich_left",
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0",
)
def enrich_left(t: Tables):
    customers = t("customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return rel.enrich_left(t("orders").select("o_orderkey", "o_custkey"), customers, ["o_custkey"], ["c_name", "c_mktsegment"])


@query("inner_join", "SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def inner_join(t: Tables):
    return rel.inner_join(t("nation"), t("region"), "n_regionkey", "r_regionkey")


@query(
    "combine_first",
    """SELECT coalesce(a.day, b.day) AS day, coalesce(a.n, b.n) AS n, n_orders, quantity FROM
    (SELECT o_orderdate AS day, nullif(count(*), 3) AS n, count(*) AS n_orders FROM orders GROUP BY 1) a FULL JOIN
    (SELECT l_shipdate AS day, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) b ON a.day = b.day""",
)
def combine_first(t: Tables):
    ordered = t("orders").groupBy(F.col("o_orderdate").alias("day")).agg(
        F.nullif(F.count(F.lit(1)), F.lit(3)).alias("n"), F.count(F.lit(1)).alias("n_orders")
    )
    shipped = t("lineitem").groupBy(F.col("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )
    return rel.combine_first(ordered, shipped, ["day"])


@query(
    "zip_by_order",
    """SELECT o_orderkey, c_custkey, coalesce(a.position, b.position) AS position FROM
    (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders) a FULL JOIN
    (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS position FROM customer) b ON a.position = b.position""",
)
def zip_query(t: Tables):
    zipped = zip_by_order(
        t("orders").select("o_orderkey", "o_totalprice"), t("customer").select("c_custkey", "c_acctbal"),
        [F.desc("o_totalprice"), "o_orderkey"], [F.desc("c_acctbal"), "c_custkey"],
    )
    return zipped.select("o_orderkey", "c_custkey", "position")


@query(
    "assign_by_key",
    """SELECT o_orderpriority, o_orderdate, n_orders, shipped FROM
    (SELECT o_orderpriority, o_orderdate, count(*) AS n_orders FROM orders GROUP BY 1, 2) a LEFT JOIN
    (SELECT o_orderpriority, l_shipdate AS o_orderdate, count(*) AS shipped FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     GROUP BY 1, 2) b USING (o_orderpriority, o_orderdate)""",
)
def assign_by_key(t: Tables):
    keys = ["o_orderpriority", "o_orderdate"]
    ordered = t("orders").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"))
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = joined.groupBy("o_orderpriority", F.col("l_shipdate").alias("o_orderdate")).agg(F.count(F.lit(1)).alias("shipped"))
    return rel.enrich_left(ordered, shipped, keys)


@query(
    "fill_from_prior_period",
    """WITH d AS (SELECT o_orderpriority, o_orderdate, nullif(count(*), 1) AS n FROM orders GROUP BY 1, 2)
    SELECT d.o_orderpriority, d.o_orderdate, coalesce(d.n, p.n) AS n FROM d LEFT JOIN d p
    ON d.o_orderpriority = p.o_orderpriority AND d.o_orderdate = p.o_orderdate + INTERVAL 364 DAY""",
)
def fill_from_prior_period(t: Tables):
    daily = t("orders").groupBy("o_orderpriority", "o_orderdate").agg(F.nullif(F.count(F.lit(1)), F.lit(1)).alias("n"))
    return rel.fill_from_prior_period(daily, "n", "o_orderdate", 364, ["o_orderpriority"])


@query("anti_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_join(t: Tables):
    big = t("orders").where("o_totalprice > 300000")
    return t("customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_join(t: Tables):
    big = t("orders").where("o_totalprice > 300000")
    return t("customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "remap_ids",
    """WITH s AS (SELECT c_mktsegment AS seg, CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS BIGINT) AS id FROM customer GROUP BY 1),
    tgt AS (SELECT upper(seg) AS seg, id + 100 AS id FROM s WHERE seg < 'H'),
    fresh AS (SELECT upper(seg) AS seg, (SELECT max(id) FROM tgt) + row_number() OVER (ORDER BY upper(seg)) AS id FROM s
      WHERE upper(seg) NOT IN (SELECT seg FROM tgt)),
    m AS (SELECT * FROM tgt UNION ALL SELECT * FROM fresh)
    SELECT c_custkey, m.id AS setting_id, CASE WHEN c_acctbal > 0 THEN m.id END AS default_id FROM customer JOIN m ON upper(c_mktsegment) = m.seg""",
)
def remap_ids(t: Tables):
    """Segments of customers as parameters; the other store knows some of them in lower case."""
    names = label_encode(t("customer").select("c_mktsegment").distinct(), "c_mktsegment", "id")
    source = names.select((F.col("id") + 1).alias("id"), F.col("c_mktsegment").alias("placeholder"))
    target = source.where("placeholder < 'H'").select((F.col("id") + 100).alias("id"), F.lower("placeholder").alias("placeholder"))
    records = t("customer").join(source, F.col("c_mktsegment") == F.col("placeholder")).select(
        "c_custkey", F.struct(F.col("id").alias("variable_id")).alias("settings"),
        F.when(F.col("c_acctbal") > 0, F.struct(F.col("id").alias("variable_id"))).alias("defaults"),
    )
    moved, _ = rel.remap_ids(records, ["settings.variable_id", "defaults.variable_id"], source, target)
    return moved.select("c_custkey", F.col("settings.variable_id").alias("setting_id"), F.col("defaults.variable_id").alias("default_id"))


# Aggregates


@query(
    "consumption_summary",
    """SELECT p_brand, p_type, round(sum(l_extendedprice) / 1073741824, 8) AS size_gb, min(l_shipdate) AS first_update
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE nullif(p_type, 'PROMO') IS NOT NULL GROUP BY 1, 2""",
)
def consumption_summary(t: Tables):
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    joined = joined.withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return rel.group_summary(joined, ["p_brand", "p_type"], {
        "size_gb": F.round(F.sum("l_extendedprice") / 1024**3, 8), "first_update": F.min("l_shipdate"),
    })


@query("grand_total", "SELECT round(sum(l_extendedprice), 2) AS total FROM lineitem")
def grand_total(t: Tables):
    return t("lineitem").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


# Means are taken over whole cents: their sums are exact in any order.
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@query(
    "conditional_mean",
    f"""SELECT avg({CENTS}) AS mean, avg({CENTS}) FILTER (o_orderdate <= TIMESTAMP '1998-01-01') AS before,
    avg({CENTS}) FILTER (o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1999-01-01') AS after FROM orders""",
)
def conditional_mean(t: Tables):
    day, cents = F.col("o_orderdate"), F.expr(CENTS)
    cut, end = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1999-01-01"))
    return t("orders").agg(
        F.avg(cents).alias("mean"), F.avg(F.when(day <= cut, cents)).alias("before"),
        F.avg(F.when((day > cut) & (day <= end), cents)).alias("after"),
    )


@query(
    "group_transform",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(avg(l_quantity) OVER (PARTITION BY l_returnflag), 6) AS flag_mean FROM lineitem""",
)
def group_transform(t: Tables):
    joined = rel.group_transform(t("lineitem"), ["l_returnflag"], {"flag_mean": F.round(F.avg("l_quantity"), 6)})
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flag_mean")


@query("value_counts", "SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS n FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL GROUP BY 1")
def value_counts(t: Tables):
    return rel.value_counts(t("orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")), "priority")


@query("weekofyear_mean", f"SELECT o_orderpriority, week(o_orderdate) AS iso_week, avg({CENTS}) AS mean FROM orders GROUP BY 1, 2")
def weekofyear_mean(t: Tables):
    week = F.weekofyear("o_orderdate").cast("bigint").alias("iso_week")
    return t("orders").groupBy("o_orderpriority", week).agg(F.avg(F.expr(CENTS)).alias("mean"))


@query(
    "binary_metrics",
    """SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall FROM (SELECT
    count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn,
    count(*) FILTER (y = 1 AND p = 1) AS tp FROM (SELECT quality AS y, CASE WHEN n_chars > 500 AND toxic = 0 THEN 1 ELSE 0 END AS p
    FROM labels JOIN documents USING (doc_id)))""",
)
def binary_metrics(t: Tables):
    guessed = t("labels").join(t("documents"), "doc_id").withColumn(
        "guess", F.when((F.col("n_chars") > 500) & (F.col("toxic") == 0), 1).otherwise(0)
    )
    return rel.binary_metrics(guessed, "quality", "guess")


@query("mse", "SELECT round(avg(pow(l_quantity - l_extendedprice / 2000, 2)), 4) AS mse FROM lineitem")
def mse(t: Tables):
    guessed = t("lineitem").withColumn("guess", F.col("l_extendedprice") / 2000)
    return rel.mean_squared_error(guessed, "l_quantity", "guess").select(F.round("mse", 4).alias("mse"))


# Windows

DAILY_SQL = "(SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1)"


def _daily(t: Tables):
    return t("orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rolling_mean_full",
    f"""SELECT day, CASE WHEN count(n) OVER w = 52 THEN round(avg(n) OVER w, 6) END AS mean FROM {DAILY_SQL}
    WINDOW w AS (ORDER BY day ROWS BETWEEN 51 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_full(t: Tables):
    return rolling_mean(_daily(t), "n", "day", 52, name="mean").select("day", F.round("mean", 6).alias("mean"))


@query(
    "rolling_mean_partial",
    f"SELECT day, round(avg(n) OVER (ORDER BY day ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS mean FROM {DAILY_SQL}",
)
def rolling_mean_partial(t: Tables):
    return rolling_mean(_daily(t), "n", "day", 12, min_periods=1, name="mean").select("day", F.round("mean", 6).alias("mean"))


@query(
    "rolling_mean_centered",
    f"""SELECT day, CASE WHEN count(n) OVER w = 10 THEN round(avg(n) OVER w, 6) END AS mean FROM {DAILY_SQL}
    WINDOW w AS (ORDER BY day ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)""",
)
def rolling_mean_centered(t: Tables):
    return rolling_mean(_daily(t), "n", "day", 10, center=True, name="mean").select("day", F.round("mean", 6).alias("mean"))


@query(
    "rolling_mean_group",
    """SELECT event_id, CASE WHEN count(value) OVER w = 7 THEN round(avg(value) OVER w, 6) END AS mean FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_group(t: Tables):
    events = t("events").select("event_id", "user_id", "ts", "value")
    return rolling_mean(events, "value", ["ts", "event_id"], 7, ["user_id"], name="mean").select(
        "event_id", F.round("mean", 6).alias("mean")
    )


@query("shift_rows", "SELECT event_id, lead(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_value FROM events")
def shift_query(t: Tables):
    events = t("events").select("event_id", "user_id", "ts", "value")
    return shift_rows(events, "value", ["ts", "event_id"], -1, ["user_id"], "next_value").select("event_id", "next_value")


# Order, limit, top


@query("sorted_rows", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, nullif(l_quantity, 5) AS quantity FROM lineitem ORDER BY quantity DESC NULLS LAST")
def sorted_rows(t: Tables):
    frame = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.nullif("l_quantity", F.lit(5.0)).alias("quantity"))
    return frame.orderBy(F.col("quantity").desc_nulls_last())


@query(
    "head_tail",
    """SELECT * FROM (SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)
    UNION ALL SELECT * FROM (SELECT 'tail', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10)""",
)
def head_tail(t: Tables):
    orders = t("orders").select("o_orderkey", "o_totalprice")
    head = orders.orderBy("o_totalprice", "o_orderkey").limit(10)
    tail = orders.orderBy(F.desc("o_totalprice"), F.desc("o_orderkey")).limit(10)
    return rel.tagged_union({"head": head, "tail": tail}, "part")


@query(
    "top_n_per_group",
    """SELECT l_returnflag, l_orderkey, l_partkey, l_extendedprice, rank FROM (SELECT *, row_number() OVER
    (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 15""",
)
def top_n_per_group(t: Tables):
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")]
    return rel.top_n(t("lineitem"), ["l_returnflag"], order, 15).select(
        "l_returnflag", "l_orderkey", "l_partkey", "l_extendedprice", F.col("rank").cast("bigint").alias("rank")
    )


@query("argmax_columns", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings")
def argmax_columns(t: Tables):
    return t("embeddings").select("vec_id", rel.argmax(F.col("embedding")).alias("best"))


@query("first_by", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 1")
def first_by(t: Tables):
    return t("events").select("event_id", "ts").orderBy("ts", "event_id").limit(1)


# Sets

UNION_SQL = """SELECT {tag}c_name AS party_name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT {tag2}s_name, s_acctbal, NULL FROM supplier"""


def _parties(t: Tables):
    customers = t("customer").selectExpr("c_name party_name", "c_acctbal balance", "c_mktsegment segment")
    return customers, t("supplier").selectExpr("s_acctbal balance", "s_name party_name")


@query("union_all", UNION_SQL.format(tag="", tag2=""))
def union_all(t: Tables):
    return rel.union_all(list(_parties(t)))


@query("tagged_union", UNION_SQL.format(tag="'Customer' AS subset, ", tag2="'Supplier', "))
def tagged_union(t: Tables):
    customers, suppliers = _parties(t)
    return rel.tagged_union({"Customer": customers, "Supplier": suppliers}, "subset")


@query(
    "append_rows",
    """SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1 UNION ALL
    SELECT TIMESTAMP '2002-01-01', 9 UNION ALL SELECT TIMESTAMP '2002-04-01', NULL""",
)
def append_rows(t: Tables):
    return rel.append_rows(_daily(t), [{"day": dt.datetime(2002, 1, 1), "n": 9}, {"day": dt.datetime(2002, 4, 1)}])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables):
    return t("lineitem").select("l_partkey", "l_returnflag").distinct()


@query(
    "snapshot_diff",
    """SELECT doc_id, change FROM (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'added'
    WHEN b.doc_id IS NULL THEN 'removed' WHEN a.text IS DISTINCT FROM b.text OR a.lang IS DISTINCT FROM b.lang THEN 'changed' END AS change
    FROM (SELECT doc_id, lang, text FROM documents WHERE lang <> 'es') a FULL JOIN
    (SELECT doc_id, lang, replace(text, 'the', 'THE') AS text FROM documents WHERE lang <> 'de') b ON a.doc_id = b.doc_id) WHERE change IS NOT NULL""",
)
def snapshot_diff(t: Tables):
    documents = t("documents").select("doc_id", "lang", "text")
    rewritten = documents.where("lang <> 'de'").withColumn("text", F.replace("text", F.lit("the"), F.lit("THE")))
    return rel.snapshot_diff(documents.where("lang <> 'es'"), rewritten, ["doc_id"])


@query("daily_event_value", "SELECT date_trunc('day', ts) AS day, event_type, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def daily_event_value(t: Tables):
    return t("events").groupBy(round_day("ts").alias("day"), "event_type").agg(F.round(F.sum("value"), 2).alias("total"))
