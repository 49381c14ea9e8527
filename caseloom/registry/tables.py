"""Queries over scans, sources, sinks and streams."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from caseloom.functions.strings import to_json_record
from caseloom.operators.ordered import with_group_position
from caseloom.operators.rewrite import script_bundle
from caseloom.plans.model import find_table, list_tables
from caseloom.registry.core import Tables, query
from caseloom.session import scratch_path
from caseloom.sinks.exports import export_report, locale_csv_frame, snapshot_rows
from caseloom.sinks.tables import TableStore, upsert_result
from caseloom.sources.csv import combine_csv, csv_payload, scan_csv
from caseloom.sources.extract import incremental_extract, trailing_days, unify_sources
from caseloom.sources.json import flatten, paged_service, parse_records, rows_until_empty
from caseloom.sources.pages import PagedJsonSource, read_pages
from caseloom.streaming.ingest import append_batches, drain, tail_cursor, tail_files, upsert_batches


@query("scan_table", "SELECT * FROM region")
def scan_table(t: Tables):
    return t.model("region").table("region")


CUSTOMER_CSV = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("scan_csv", "SELECT * FROM customer")
def scan_csv_query(t: Tables):
    path = scratch_path(t.spark, "csv")
    t("customer").write.option("header", True).csv(path)
    return scan_csv(t.spark, path, CUSTOMER_CSV)


@query(
    "combine_csv",
    """SELECT c_custkey AS party_key, c_name AS party_name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def combine_csv_query(t: Tables):
    path = scratch_path(t.spark, "csvs")
    customers = t("customer").selectExpr(
        "c_custkey party_key", "c_name party_name", "c_acctbal balance", "c_mktsegment segment"
    )
    suppliers = t("supplier").selectExpr("s_acctbal balance", "s_name party_name", "s_suppkey party_key")
    customers.write.option("header", True).mode("append").csv(path)
    suppliers.write.option("header", True).mode("append").csv(path)
    typed = combine_csv(t.spark, path)
    return typed.select(F.col("party_key").cast("bigint"), "party_name", "balance", "segment")


@query("find_table", "SELECT r_regionkey, r_name, 1::BIGINT AS tables_named_so FROM region")
def find_table_query(t: Tables):
    """A published table found again by a part of its name."""
    store, name = _store(t), _name("found_regions")
    store.create(name, t("region").select("r_regionkey", "r_name"))
    listed = sum(known == name for known in list_tables(t.spark, store.database))
    return find_table(t.spark, name[: -1], store.database, partial=True).withColumn("tables_named_so", F.lit(listed).cast("bigint"))


@query("write_new_only", "SELECT n_nationkey, n_name, true AS second_write_refused FROM nation")
def write_new_only(t: Tables):
    """A table that may only be new: the second write of the same name is an error and changes nothing."""
    store, name = _store(t), _name("new_only")
    nations = t("nation").select("n_nationkey", "n_name")
    store.create(name, nations, primary_keys=["n_nationkey"])
    try:
        store.create(name, nations.limit(0))
        refused = False
    except ValueError:
        refused = True
    return store.read(name).withColumn("second_write_refused", F.lit(refused))


@query("report_export", "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1")
def report_export(t: Tables):
    """A report written as a file and read back."""
    path = scratch_path(t.spark, "report")
    export_report(t("customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers")), path)
    return t.spark.read.parquet(path)


@query(
    "rebound_model",
    "SELECT n_name AS nation, count(*) AS customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def rebound_model(t: Tables):
    """The model's definition over same-named tables of another database."""
    root = scratch_path(t.spark, "moved")
    database = f"moved_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE `{database}` LOCATION '{root}'")
    for name in ("customer", "nation"):
        t(name).write.format("parquet").option("path", f"{root}/{name}").saveAsTable(f"{database}.{name}")
    bound = t.model("customer", "nation").rebind(t.spark, database, {}, "moved")
    return bound.query(dims={"nation": "nation.n_name"}, measures={"customers": "count(customer.c_custkey)"}).to_df()


SAVED_SQL = """SELECT c_name AS customer, n_name AS nation, c_acctbal AS balance
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0"""


def _save_balances(t: Tables):
    model = t.model("customer", "nation")
    saved = model.query(
        dims={"customer": "customer.c_name", "nation": "nation.n_name", "balance": "customer.c_acctbal"},
        where=["customer.c_acctbal > 0"],
    )
    model.save("customer_balances", saved)
    return model


@query("saved_query", SAVED_SQL)
def saved_query(t: Tables):
    _save_balances(t)
    return t.spark.table("customer_balances")


@query(
    "saved_query_extended",
    """SELECT c_name AS customer, n_name AS nation, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND n_regionkey = 1""",
)
def saved_query_extended(t: Tables):
    saved = _save_balances(t).saved["customer_balances"]
    extended = saved.with_dim("segment", "customer.c_mktsegment")
    return extended.where("customer.c_mktsegment IN ('BUILDING', 'MACHINERY')", "nation.n_regionkey = 1").to_df()


PAGE_ROWS = 5_000


def _page_number(df, order: str):
    """Rows of a table cut into pages of 5,000 consecutive keys."""
    return df.withColumn("__page", F.floor(F.col(order) / PAGE_ROWS).cast("bigint"))


@query("paged_json", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def paged_json_query(t: Tables):
    """Orders written as page files of one JSON object each (plus an empty last page), then ingested."""
    path = scratch_path(t.spark, "pages")
    rows = _page_number(t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), "o_orderkey")
    pages = rows.groupBy("__page").agg(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")).alias("rows"))
    last = rows.agg((F.max("__page") + 1).alias("__page")).withColumn("rows", F.array().cast(pages.schema["rows"].dataType))
    text = pages.unionByName(last).select(to_json_record("rows").alias("value"), F.concat(F.lit("page-"), "__page").alias("page"))
    text.repartition("page").write.partitionBy("page").text(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string"
    pages = t.spark.read.schema(f"rows array<struct<{schema}>>, page string").json(path)
    numbered = pages.select(F.regexp_extract("page", r"(\d+)", 1).cast("bigint").alias("page"), "rows")
    return rows_until_empty(numbered).drop("page")


@query(
    "trailing_days",
    """SELECT event_id, ts, event_type FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'""",
)
def trailing_days_query(t: Tables):
    return trailing_days(t("events").select("event_id", "ts", "event_type"), "ts", "2024-01-20", 7)


@query("json_flatten", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events""")
def json_flatten(t: Tables):
    flat = flatten(parse_records(t("events").select("event_id", "props"), "props", "k int"))
    return flat.withColumnRenamed("props.k", "props_k")


@query("csv_payload", "SELECT c_nationkey, c_custkey, c_acctbal, c_mktsegment FROM customer")
def csv_payload_query(t: Tables):
    """Customers folded into CSV texts of a few rows each, then parsed again."""
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string"), "c_mktsegment")
    chunk = F.floor(F.col("c_custkey") / 100)
    texts = t("customer").groupBy("c_nationkey", chunk.alias("chunk")).agg(
        F.concat(F.lit("custkey,acctbal,segment\n"), F.array_join(F.collect_list(line), "\n"), F.lit("\n")).alias("payload")
    )
    return csv_payload(texts, "payload", "c_custkey bigint, c_acctbal double, c_mktsegment string", ["c_nationkey"])


@query(
    "incremental_extract",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2001-06-30'
    AND o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') - INTERVAL 30 DAY""",
)
def incremental_extract_query(t: Tables):
    source = t("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    target = source.where("o_orderdate < timestamp_ntz'2000-01-01'")
    return incremental_extract(
        source, target, "o_orderdate", "1998-01-01", "2001-06-30", "o_orderdate", 30
    )


@query(
    "unify_sources",
    """SELECT 'customer' AS source, c_custkey AS party_key, c_name AS party_name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
    WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)""",
)
def unify_sources_query(t: Tables):
    customers = t("customer").selectExpr("c_custkey party_key", "c_name party_name", "c_mktsegment segment")
    suppliers = t("supplier").selectExpr("s_suppkey party_key", "s_name party_name")
    return unify_sources({"customer": customers, "supplier": suppliers}, ["party_key"])


def _store(t: Tables) -> TableStore:
    return TableStore(t.spark, "caseloom_check", scratch_path(t.spark, "store"))


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:8]}"


@query("write_replace", "SELECT n_nationkey, n_name FROM nation")
def write_replace(t: Tables):
    store, name = _store(t), _name("replaced")
    store.replace(name, t("region"))
    store.replace(name, t("nation").select("n_nationkey", "n_name"), primary_keys=["n_nationkey"])
    return store.read(name)


@query("write_append", "SELECT * FROM orders")
def write_append(t: Tables):
    store, name = _store(t), _name("appended")
    store.create(name, t("orders").where("o_orderstatus = 'O'"))
    store.append(name, t("orders").where("o_orderstatus <> 'O'").select(*reversed(t("orders").columns)))
    return store.read(name)


@query(
    "append_or_create",
    "SELECT o_orderpriority, count(*) AS n_orders, 1 AS run FROM orders GROUP BY 1 "
    "UNION ALL SELECT o_orderpriority, count(*), 2 FROM orders GROUP BY 1",
)
def append_or_create(t: Tables):
    store, name = _store(t), _name("history")
    counts = t("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    for run in (1, 2):
        store.append_or_create(name, counts.withColumn("run", F.lit(run)))
    return store.read(name)


UPSERT_SQL = """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate < TIMESTAMP '2000-01-01' AND NOT (o_orderdate >= TIMESTAMP '1999-07-01')
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice * 2 FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'"""


def _upsert_sides(t: Tables):
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    target = orders.where("o_orderdate < timestamp_ntz'2000-01-01'").drop("o_orderdate")
    changes = orders.where("o_orderdate >= timestamp_ntz'1999-07-01'").drop("o_orderdate")
    versions = changes.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    return target, versions.withColumn("o_totalprice", F.col("o_totalprice") * F.col("version"))


@query("upsert_result", UPSERT_SQL)
def upsert_result_query(t: Tables):
    target, changes = _upsert_sides(t)
    return upsert_result(target, changes, ["o_orderkey"], [F.desc("version")])


@query("write_upsert", UPSERT_SQL)
def write_upsert(t: Tables):
    store, name = _store(t), _name("upserted")
    target, changes = _upsert_sides(t)
    store.create(name, target, primary_keys=["o_orderkey"])
    store.upsert(name, changes.where("version = 1").drop("version"))
    store.upsert(name, changes.where("version = 2").drop("version"))
    return store.read(name)


@query(
    "locale_csv_frame",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    replace(CAST(l_quantity AS VARCHAR), '.', ',') AS l_quantity,
    replace(CAST(l_extendedprice AS VARCHAR), '.', ',') AS l_extendedprice,
    replace(CAST(l_discount AS VARCHAR), '.', ',') AS l_discount FROM lineitem""",
)
def locale_csv(t: Tables):
    return locale_csv_frame(t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    ))


@query(
    "snapshot_rows",
    """SELECT doc_id, source, lang, '{"doc_id":' || doc_id || ',"n_chars":' || n_chars || ',"md5":"' || md5(text) || '"}' AS record,
    '2024-01-01' AS snapshot FROM documents WHERE n_chars > 200""",
)
def snapshot_rows_query(t: Tables):
    hashed = t("documents").withColumn("md5", F.md5("text"))
    return snapshot_rows(hashed, F.col("n_chars") > 200, "2024-01-01", ["doc_id", "source", "lang"], ["doc_id", "n_chars", "md5"])


@query(
    "ordered_bundle",
    """SELECT conv_id, part, string_agg('--###' || role || turn || '###--' || chr(10) || chr(10)
      || trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) || chr(10) || chr(10), '' ORDER BY pos) AS bundle
    FROM (SELECT *, (pos - 1) // 1000 AS part FROM
      (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations))
    WHERE text IS NOT NULL GROUP BY conv_id, part""",
)
def ordered_bundle(t: Tables):
    placed = with_group_position(t("conversations"), ["conv_id"], "turn", "pos")
    return script_bundle(placed, ["conv_id"], "pos", F.concat("role", F.col("turn").cast("string")), "text")


@query("stream_upsert", "SELECT event_id, user_id, event_type, value FROM events")
def stream_upsert(t: Tables):
    """Events and a second delivery of half of them, streamed in batches and upserted once per key."""
    folder = scratch_path(t.spark, "arrivals")
    events = t("events").select("event_id", "ts", "user_id", "event_type", "value")
    events.write.mode("append").parquet(folder)
    events.where("event_type IN ('click', 'view', 'error')").write.mode("append").parquet(folder)
    store, name = _store(t), _name("streamed")
    stream = tail_files(t.spark, folder, events.schema, files_per_batch=4)
    running = upsert_batches(stream, store, name, ["event_id"], scratch_path(t.spark, "checkpoint"), [F.desc("ts")])
    running.awaitTermination()
    return store.read(name).select("event_id", "user_id", "event_type", "value")


@query("tail_files", "SELECT event_id, event_type, value FROM events")
def tail_files_query(t: Tables):
    folder, out = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "tailed")
    events = t("events").select("event_id", "event_type", "value")
    events.repartition(4).write.parquet(folder)
    stream = tail_files(t.spark, folder, events.schema, files_per_batch=2)
    append_batches(stream, out, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.schema(events.schema).parquet(out)


# Rows per page of the log service.
LOG_PAGE_ROWS = 1_000


@query("cursor_json", "SELECT event_id, event_type, value FROM events")
def cursor_json(t: Tables):
    """Events as a chain of log pages, each naming the next one, followed by cursor until drained."""
    folder, out = scratch_path(t.spark, "log_pages"), scratch_path(t.spark, "followed")
    page = F.floor(F.col("event_id") / LOG_PAGE_ROWS).cast("bigint")
    last = t("events").agg(F.max(page)).scalar()
    pages = t("events").groupBy(page.alias("page")).agg(F.collect_list(F.struct("event_id", "event_type", "value")).alias("logs"))
    following = F.when(F.col("page") < last, (F.col("page") + 1).cast("string")).alias("following")
    pages.select("page", to_json_record("logs", following).alias("value")).write.partitionBy("page").text(folder)
    stream = tail_cursor(
        t.spark, folder=folder, prefix="page=", suffix="", start="0", pages_per_batch="10", catch_up_pages="1000", next_key="following",
        row_schema="event_id bigint, event_type string, value double"
    )
    drain(append_batches(stream, out, scratch_path(t.spark, "checkpoint"), available_now=False))
    return t.spark.read.schema(stream.schema).parquet(out)


@query("paged_service", "SELECT p_partkey, p_name, p_retailprice FROM part")
def paged_service_query(t: Tables):
    """Parts as numbered pages read by several executors at once."""
    folder = scratch_path(t.spark, "service_pages")
    page = F.concat(F.floor(F.col("p_partkey") / LOG_PAGE_ROWS).cast("string"), F.lit(".json"))
    pages = t("part").groupBy(page.alias("page")).agg(F.collect_list(F.struct("p_partkey", "p_name", "p_retailprice")).alias("rows"))
    pages.select(F.concat(F.lit("page-"), "page").alias("file"), to_json_record("rows").alias("value")).write.partitionBy("file").text(folder)
    return paged_service(t.spark, _PartitionedPages, folder=folder, row_schema="p_partkey bigint, p_name string, p_retailprice double")


class _PartitionedPages(PagedJsonSource):
    """Pages in folders ``file=page-<n>.json``, as a partitioned write leaves them."""

    @classmethod
    def name(cls) -> str:
        return "caseloom_partitioned_pages"

    def fetch(self, page: int) -> list[dict]:
        texts = read_pages(self.options["folder"], f"file=page-{page}.json")
        return json.loads(texts[0])["rows"] if texts else []
