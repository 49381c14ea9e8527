"""Queries over event logs and rule-based rewriting."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.strings import safe_identifier
from caseloom.operators import rewrite
from caseloom.operators.clean import fill_mean
from caseloom.operators.line_diff import diff_counts, line_diff
from caseloom.operators.events import EventLog, case_variants, event_order, throughput_days, variant_codes, variant_counts
from caseloom.operators.ml import assemble, kmeans, label_encode
from caseloom.registry.core import Tables, query
from caseloom.session import materialize


def _log(t: Tables) -> EventLog:
    p = t.model("events").process
    return EventLog(t(p.activity_table), p.case_column, p.activity_column, p.timestamp_column, p.sorting_column)


def _daily_log(t: Tables) -> EventLog:
    """One case per user and day."""
    events = t("events").withColumn("day", F.col("ts").cast("date"))
    return EventLog(events, ["user_id", "day"], "event_type", "ts", "event_id")


@query("event_order", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events")
def event_order_query(t: Tables):
    return event_order(_log(t)).select("event_id", "position")


@query(
    "case_variant",
    """SELECT user_id, part, string_agg(event_type, ' > ' ORDER BY pos) AS variant FROM (SELECT *, (pos - 1) // 10000 AS part FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)) GROUP BY 1, 2""",
)
def case_variant(t: Tables):
    return case_variants(_log(t))


@query(
    "variant_counts",
    """SELECT variant, CAST(0 AS BIGINT) AS part, n_events, count(*) AS n_cases FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events,
    string_agg(event_type, ' > ' ORDER BY ts, event_id) AS variant FROM events GROUP BY 1, 2) GROUP BY variant, n_events""",
)
def variant_counts_query(t: Tables):
    return variant_counts(_daily_log(t))


@query(
    "throughput_days",
    """SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts,
    ((epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000) / 86400.0::DOUBLE AS throughput_days FROM events GROUP BY 1""",
)
def throughput_query(t: Tables):
    return throughput_days(_log(t))


@query("cluster_cases")
def cluster_cases(t: Tables):
    """Events with encoded activity, order and variant and filled throughput, in five clusters."""
    log = _daily_log(t)
    ordered = event_order(log, "sorting").select("event_id", "user_id", "day", "event_type", "sorting")
    times = throughput_days(log).select("user_id", "day", F.nullif("throughput_days", F.lit(0.0)).alias("throughput"))
    cases = variant_codes(log).join(times, ["user_id", "day"])
    frame = label_encode(ordered, "event_type", "activity_code").join(cases, ["user_id", "day"])
    filled = fill_mean(frame, "throughput").dropna("any")
    features = assemble(filled, ["activity_code", "sorting", "variant_code", "throughput"]).select("event_id", "features")
    _, clustered = kmeans(materialize(features, "features"), 5)
    return clustered.select("event_id", "cluster")


RULES = {"the": "thee", "er": "re", "thee re": "there"}


@query(
    "dictionary_replace",
    """SELECT doc_id, replace(replace(replace(text, 'the', 'thee'), 'er', 're'), 'thee re', 'there') AS text,
    replace(replace(replace(source, 'the', 'thee'), 'er', 're'), 'thee re', 'there') AS source FROM documents""",
)
def dictionary_replace(t: Tables):
    return t("documents").select("doc_id", *[rewrite.replace_all(c, RULES).alias(c) for c in ("text", "source")])


@query(
    "replacement_counts",
    """WITH s AS (SELECT text AS a, replace(text, 'the', 'thee') AS b, replace(replace(text, 'the', 'thee'), 'er', 're') AS c FROM documents)
    SELECT 'text' AS "column", 'the' AS old, CAST(sum((length(a) - length(replace(a, 'the', ''))) // 3) AS BIGINT) AS replacements FROM s UNION ALL
    SELECT 'text', 'er', CAST(sum((length(b) - length(replace(b, 'er', ''))) // 2) AS BIGINT) FROM s UNION ALL
    SELECT 'text', 'thee re', CAST(sum((length(c) - length(replace(c, 'thee re', ''))) // 7) AS BIGINT) FROM s""",
)
def replacement_counts(t: Tables):
    return rewrite.replacement_counts(t.texts(), ["text"], RULES)


@query(
    "template_vars",
    """SELECT doc_id, replace(replace(text, ' the ', ' ${the} '), ' of ', ' ${of} ') AS template FROM documents""",
)
def template_vars(t: Tables):
    """Markers in different spacings are put into the texts and must all become variables."""
    marked = F.replace(F.replace("text", F.lit(" the "), F.lit(" <%= the %> ")), F.lit(" of "), F.lit(" <%=of %> "))
    return t("documents").select("doc_id", rewrite.template_variables(marked, ["the", "of"]).alias("template"))


@query(
    "safe_names",
    "SELECT p_partkey, regexp_replace(replace(replace(p_name || ' (' || p_brand || ')', ')', ''), '(', ''), '[^0-9a-zA-Z]+', '_', 'g') AS clean_name FROM part",
)
def safe_names(t: Tables):
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return t("part").select("p_partkey", safe_identifier(name).alias("clean_name"))


@query(
    "rename_references",
    "SELECT p_partkey, 'SUM(' || replace(p_name, ' ', '_') || ') / COUNT(' || replace(p_name, ' ', '_') || ')' AS template FROM part",
)
def rename_references(t: Tables):
    formulas = t("part").select(
        "p_partkey", "p_name", F.concat(F.lit("SUM("), "p_name", F.lit(") / COUNT("), "p_name", F.lit(")")).alias("template")
    )
    return rewrite.rename_references(formulas, formulas.select("p_name"), "p_partkey", "template", "p_name")


@query(
    "param_ids",
    """SELECT user_id, 'p' || row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS id, event_type AS display_name, 0 AS default_value
    FROM (SELECT DISTINCT user_id, event_type FROM events)""",
)
def param_ids(t: Tables):
    lists = t("events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("parameters"))
    return rewrite.parameter_ids(lists, ["user_id"], "parameters")


@query(
    "alias_rewrite",
    """SELECT doc_id, line_no, CASE line_no WHEN 1 THEN line WHEN 2 THEN 'known.get(' || lang || ')' ELSE 'other.fetch_all(' || lang || ')' END AS rewritten FROM
    (SELECT doc_id, lang, CAST(i AS INTEGER) AS line_no, CASE i WHEN 1 THEN 'known = connect(' || lang || ')' END AS line FROM documents, range(1, 4) r(i))""",
)
def alias_rewrite(t: Tables):
    """Calls on names that a script binds itself change differently from calls on other names."""
    text = F.concat(F.lit("known = connect("), "lang", F.lit(")\nknown.fetch("), "lang", F.lit(")\nother.fetch("), "lang", F.lit(")"))
    scripts = t("documents").select("doc_id", text.alias("body"))
    lines = rewrite.script_lines(scripts, "doc_id", "body")
    known = rewrite.aliases(scripts, "doc_id", "body", "connect(")
    out = rewrite.rewrite_with_alias(lines, known, "doc_id", r"\.fetch\((\w+)\)", "$1.get($2)", "$1.fetch_all($2)")
    return out.select("doc_id", "line_no", "rewritten")


@query(
    "rewrite_lines",
    """SELECT doc_id, line_no, line, CASE WHEN changed THEN new || ' # CHANGED' ELSE new END AS rewritten, changed FROM
    (SELECT *, new <> line AS changed FROM (SELECT *, regexp_replace(regexp_replace(line, '([a-z]+)ing', '\\1ed', 'g'), '\\bof the\\b', 'of', 'g') AS new FROM
    (SELECT doc_id, CAST(i AS INTEGER) AS line_no, lines[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), range(1, len(lines) + 1) r(i))))""",
)
def rewrite_lines(t: Tables):
    lines = rewrite.script_lines(t.texts(), "doc_id", "text")
    return rewrite.rewrite_lines(lines, [("([a-z]+)ing", "$1ed"), (r"\bof the\b", "of")])


@query(
    "line_diff",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
    SELECT doc_id, count(*) FILTER (i % 7 <> 3) AS n_same, count(*) FILTER (i % 7 = 3) AS n_removed, 1::BIGINT AS n_added FROM l GROUP BY doc_id""",
)
def line_diff_query(t: Tables):
    """Documents against a version with a new first line and without every seventh line."""
    old = t.texts().select("doc_id", "text")
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: i % 7 != 2)
    new = old.select("doc_id", F.array_join(F.concat(F.array(F.lit("-- a new first line --")), kept), "\n").alias("text"))
    return diff_counts(line_diff(old, new, "doc_id", "text"), "doc_id")
