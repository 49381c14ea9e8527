import math
import unicodedata

import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseloom.functions import strings, text
from caseloom.functions.dates import spark_pattern
from caseloom.operators import clean, rewrite, topics
from caseloom.operators import relational as rel


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


# Cleaning


def test_numbers_held_as_text(spark):
    df = spark.createDataFrame([("1,200",), (" 950",), ("",), ("x",), (None,)], "s string")
    assert values(df, strings.parse_number("s")) == [1200, 950, None, None, None]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("7",), ("x",)], "s string")
    assert values(clean.cast_columns(df, {"s": "int"}), F.col("s")) == [7, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.cast_columns(df, {"s": "int"}, strict=True).collect()


def test_nulls_in_caps_flags_and_keys(spark):
    df = spark.createDataFrame([(5.0, "a"), (None, "b"), (1.0, None)], "x double, k string")
    assert rows(clean.cap_outliers(df, "x", 2.0)) == sorted([(2.0, "a"), (None, "b"), (1.0, None)], key=repr)
    assert values(df, clean.flag(F.col("x") > 2, "hi", "lo")) == ["hi", "lo", "lo"]
    assert values(clean.composite_key(df, ["k", "x"]), F.col("case_key")) == ["a|5.0", None, None]


def test_nan_is_null(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2)], "x double, i int")
    assert rows(clean.nan_to_null(df)) == sorted([(None, 1), (2.0, 2)], key=repr)


def test_fill_mean_of_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert values(clean.fill_mean(df, "x"), F.col("x")) == [None, None]


def test_sparse_columns_of_empty_frame(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    assert clean.drop_sparse_columns(df).columns == ["a"]
    assert clean.drop_sparse_columns(df.where("false")).columns == ["a", "b"]


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    assert rows(clean.column_profile(df)) == [("a", "int", 2, 0, 1), ("b", "string", 2, 1, 1)]


def test_metrics_with_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    assert rows(rel.binary_metrics(df, "y", "p")) == [(2, 0, 0, 0, None, None)]


def test_group_transform_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "k string, v double")
    out = rel.group_transform(df, ["k"], {"m": F.avg("v")})
    assert rows(out) == sorted([("a", 1.0, 2.0), ("a", 3.0, 2.0), (None, 5.0, 5.0)], key=repr)


def test_enrich_refuses_repeated_keys(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="repeat"):
        rel.enrich_left(left, right, ["k"])


def test_diff_of_equal_snapshots_is_empty(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 1.5)], "k int, v string, w double")
    assert rel.snapshot_diff(df, df, ["k"]).count() == 0
    other = spark.createDataFrame([(1, None, None), (3, "c", None)], "k int, v string, w double")
    assert rows(rel.snapshot_diff(df, other, ["k"])) == [(1, "changed"), (2, "removed"), (3, "added")]


def test_remap_creates_missing_ids_once(spark):
    source = spark.createDataFrame([(1, "Start"), (2, "END"), (3, "new"), (4, "NEW")], "id bigint, placeholder string")
    target = spark.createDataFrame([(70, "start"), (71, "end")], "id bigint, placeholder string")
    records = spark.sql("""SELECT * FROM VALUES (1, named_struct('pool', 1L)), (2, named_struct('pool', 3L)), (3, named_struct('pool', 4L)),
        (4, named_struct('pool', CAST(NULL AS BIGINT))), (5, NULL) AS t(k, settings)""")
    moved, complete = rel.remap_ids(records, ["settings.pool"], source, target)
    assert {r.k: (r.settings and r.settings.pool) for r in moved.collect()} == {1: 70, 2: 72, 3: 72, 4: None, 5: None}
    assert rows(complete) == [(70, "start"), (71, "end"), (72, "NEW")]


# Scalars


def test_format_codes():
    assert spark_pattern("%Y-%m-%d_%Hh%M") == "yyyy-MM-dd_HH'h'mm"
    with pytest.raises(ValueError):
        spark_pattern("%Q")


@pytest.mark.parametrize("damaged,want", [("â\x82¬", "€"), ("cafÃ©", "café"), ("café", "café"), ("日本", "日本"), (None, None), ("plain", "plain")])
def test_repair_encoding(spark, damaged, want):
    df = spark.createDataFrame([(damaged,)], "s string")
    assert values(df, strings.repair_encoding("s")) == [want]


def test_extract_and_occurrences(spark):
    df = spark.createDataFrame([("id=12; id=7",), ("none",)], "s string")
    assert values(df, strings.extract_field("s", r"id=(\d+)")) == ["12", None]
    assert values(df, strings.occurrences("s", "id")) == [2, 0]


# Text


@pytest.mark.parametrize("raw,want", [
    ("mail me@x.org now", "mail now"), ("a\n\tb c", "a b c"), ("it's 'so'", "its so"), ("x@y", ""), ("a @b c", "a c"),
])
def test_clean_text(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string")
    assert values(df, text.clean_text("s")) == [want]


def test_tokens_follow_the_rule_of_unicode_words(spark):
    raw = "Élan, naïve ÅNGSTRÖM x y2k a1b foo_bar _hidden straße ﬁne İstanbul résumé's " + "w" * 16 + " " + "v" * 15
    df = spark.createDataFrame([(raw,)], "s string")

    def expected(s):
        bare = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")
        words, word = [], ""
        for c in unicodedata.normalize("NFC", bare) + " ":
            if (c.isalnum() or c == "_") and not c.isdecimal():
                word += c
            else:
                words, word = words + [word], ""
        return [w for w in words if 2 <= len(w) <= 15 and not w.startswith("_")]

    assert values(df, text.tokenize("s"))[0] == expected(raw)


def test_lemmas_keep_order_and_empty_documents(spark):
    df = spark.createDataFrame([(1, ["the", "cats", "ran", "home"]), (2, []), (3, ["the"])], "k int, t array<string>")
    lexicon = spark.createDataFrame([("the", "the", "DET"), ("cats", "cat", "NOUN"), ("ran", "run", "VERB")], "form string, lemma string, pos string")
    got = {r.k: r.lemmas for r in topics.lemmatize(df, "k", "t", lexicon).collect()}
    assert got == {1: ["cat", "run", "home"], 2: [], 3: []}


def test_term_counts_and_sparsity(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a"]), (3, ["c"])], "k int, t array<string>")
    counts = topics.term_counts(df, "k", "t")
    assert rows(counts) == [(1, "a", 2), (2, "a", 1)]
    assert topics.sparsity(counts, df).first().sparsity == pytest.approx(100 * 2 / 3)


def test_documents_are_counted_without_a_shuffle(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", text.terms("text").alias("terms"))
    plan = topics.term_counts(df, "doc_id", "terms")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan


def test_topic_tables(spark):
    df = spark.createDataFrame([(1, [0.125, 0.875]), (2, [0.5, 0.5]), (3, [0.3, 0.7])], "k int, w array<double>")
    marked = topics.with_dominant_topic(df, F.col("w"))
    assert rows(marked.select("k", "weights", "dominant_topic")) == [(1, [0.12, 0.88], 1), (2, [0.5, 0.5], 0), (3, [0.3, 0.7], 1)]
    wide = topics.topic_columns(marked, "weights", 2)
    assert rows(topics.topic_distribution(wide, ["topic0", "topic1"], "dominant_topic", 0.6)) == [(1, 2, 2)]


# Rewriting


def test_rules_apply_one_after_the_other(spark):
    df = spark.createDataFrame([("ab ab",)], "s string")
    rules = {"a": "b", "bb": "c"}
    assert values(df, rewrite.replace_all("s", rules)) == ["c c"]
    table = spark.createDataFrame([(1, "a", "b"), (2, "bb", "c")], "rank int, old string, new string")
    assert rows(rewrite.replace_by_table(df, ["s"], table)) == [("c c",)]
    assert rows(rewrite.replacement_counts(df, ["s"], rules)) == [("s", "a", 2), ("s", "bb", 2)]


def test_template_variables_in_all_spacings(spark):
    df = spark.createDataFrame([("<%=a%> <%= a %> <%= a%> <%=a %> <%= b %> <%= ab %>",)], "s string")
    assert values(df, rewrite.template_variables("s", ["a"])) == ["${a} ${a} ${a} ${a} <%= b %> <%= ab %>"]
    assert values(df, rewrite.template_variables("s")) == ["${a} ${a} ${a} ${a} ${b} ${ab}"]


def test_names_come_from_the_original_text(spark):
    names = spark.createDataFrame([("x (y)",), ("yz-w",), ("a.b",), ("same start one",), ("same start two-2",), (r"q\E(",)], "name string")
    formulas = spark.createDataFrame([(1, "x (y)z-w"), (2, "a.b axb"), (3, "same start two-2/same start one"), (4, r"q\E("), (5, "$1 x (y)")], "k int, f string")
    got = dict(rows(rewrite.rename_references(formulas, names, "k", "f", "name")))
    assert got == {1: "x_yz-w", 2: "a_b axb", 3: "same_start_two_2/same_start_one", 4: "q_E", 5: "$1 x_y"}


def test_rules_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rewrite, "RULE_BLOCK", 2)
    rules = spark.createDataFrame([(i, f"<{i}>", f"<{i + 1}>") for i in range(7)], "rank int, old string, new string")
    assert rows(rewrite.replace_by_table(spark.createDataFrame([("<0> <5>",)], "s string"), ["s"], rules)) == [("<7> <7>",)]


@pytest.mark.parametrize(("number", "want"), [
    (1.2345678901234568e-05, "0.000012345678901234568"), (1e-19, "0.0000000000000000001"), (1e20, "100000000000000000000.0"), (-1.5e22, "-15000000000000000000000.0"),
    (23.0, "23.0"), (0.0, "0.0"), (-0.25, "-0.25"), (123456.789, "123456.789"), (1e7, "10000000.0"), (None, None),
])
def test_plain_decimal_of_any_magnitude(spark, number, want):
    from caseloom.functions.strings import plain_decimal

    df = spark.createDataFrame([(number,)], "x double")
    assert values(df, plain_decimal("x")) == [want]


def test_longer_names_first(spark):
    names = spark.createDataFrame([("Net Value",), ("Net Value (EUR)",), ("x y",), ("a b",), ("plain",)], "name string")
    formulas = spark.createDataFrame([
        (1, "KPI(Net Value (EUR)) / KPI(Net Value)"), (2, "x y + a b"), (3, "nothing"), (4, ""), (5, None),
    ], "k int, f string")
    got = dict(rows(rewrite.rename_references(formulas, names, "k", "f", "name")))
    assert got == {1: "KPI(Net_Value_EUR) / KPI(Net_Value)", 2: "x_y + a_b", 3: "nothing", 4: "", 5: None}


def test_lines_are_rewritten_and_tagged(spark):
    df = spark.createDataFrame([("p", "x.tables\ny = 1\nx.tables")], "path string, body string")
    out = rewrite.rewrite_lines(rewrite.script_lines(df, "path", "body"), [(r"(\S+)\.tables", "$1.get_tables()")])
    assert [(r.line_no, r.rewritten, r.changed) for r in out.orderBy("line_no").collect()] == [
        (1, "x.get_tables() # CHANGED", True), (2, "y = 1", False), (3, "x.get_tables() # CHANGED", True),
    ]


def test_rewrite_depends_on_the_alias_of_the_script(spark):
    scripts = spark.createDataFrame([
        ("one", "cel = connect()\na = cel.pools.find('x')\nb = other.pools.find(1) + cel.pools.find(2)"),
        ("two", "c2 = connect()\nd = cel.pools.find('x')\ne = cc2.pools.find('y')\nf = c2.pools.find('z')"),
        ("none", "g = cel.pools.find('x')"),
    ], "path string, body string")
    known = rewrite.aliases(scripts, "path", "body", "connect")
    assert rows(known) == [("one", "cel"), ("two", "c2")]
    lines = rewrite.script_lines(scripts, "path", "body")
    out = rewrite.rewrite_with_alias(lines, known, "path", r"\.(pools)\.find\(", "$1.data.get_$2().find(", "$1.get_$2().find(")
    got = {(r.path, r.line_no): r.rewritten for r in out.collect()}
    assert got[("one", 2)] == "a = cel.data.get_pools().find('x')"
    assert got[("one", 3)] == "b = other.get_pools().find(1) + cel.data.get_pools().find(2)"
    assert got[("two", 2)] == "d = cel.get_pools().find('x')"
    assert got[("two", 3)] == "e = cc2.get_pools().find('y')"
    assert got[("two", 4)] == "f = c2.data.get_pools().find('z')"
    assert got[("none", 1)] == "g = cel.get_pools().find('x')"


def test_bundle_skips_null_statements(spark):
    df = spark.createDataFrame([("j", 1, "a", " SELECT 1\n"), ("j", 2, "b", None), ("j", 3, "c", "SELECT 2")], "job string, pos int, name string, statement string")
    out = rewrite.script_bundle(df, ["job"], "pos", F.col("name"), "statement")
    assert rows(out) == [("j", 0, "--###a###--\n\nSELECT 1\n\n--###c###--\n\nSELECT 2\n\n")]
    parts = rewrite.script_bundle(df, ["job"], "pos", F.col("name"), "statement", part_rows=2)
    assert [r.part for r in parts.orderBy("part").collect()] == [0, 1]


def test_plain_decimal_is_one_small_expression(spark):
    """The steps of the conversion are evaluated once a value: the plan names the number's pattern a few times, not thousands."""
    from caseloom.functions.strings import plain_decimal

    df = spark.createDataFrame([("1.5E-5", "0.000015"), ("-12", "-12.0"), ("007.50", "7.5"), ("0.00", "0.0"), ("-1.2E3", "-1200.0"), ("abc", "abc"), (None, None)], "x string, want string")
    found = df.select(plain_decimal("x").alias("got"), "want")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") < 10
    assert all(r.got == r.want for r in found.collect())


def test_lemmas_shuffle_lists_and_merge_repeated_keys(spark):
    lexicon = spark.createDataFrame([("was", "be", "VERB"), ("the", "the", "DET"), ("odd", None, "DET")], "form string, lemma string, pos string")
    rows = [(1, ["the", "cat", "was", "odd"]), (2, None), (3, []), (4, ["the", None]), (5, ["a", "the", "c"]), (5, ["z", "was"]), (None, ["was"])]
    found = topics.lemmatize(spark.createDataFrame(rows, "k int, t array<string>"), "k", "t", lexicon)
    assert {r.k: r.lemmas for r in found.collect()} == {1: ["cat", "be", "odd"], 2: [], 3: [], 4: [], 5: ["a", "z", "be", "c"], None: ["be"]}
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_common_names_are_not_shuffled_by_name(spark):
    """Hot starts and names must not be one task's: only the rewritten formulas meet by hashing, by their key."""
    formulas = spark.createDataFrame([(i, "SUM(a b) / (c d)", "a b" if i % 2 else "c d") for i in range(20)], "k int, f string, n string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = rewrite.rename_references(formulas.select("k", "f"), formulas.select("n"), "k", "f", "n")
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
        assert {r.f for r in out.collect()} == {"SUM(a_b) / (c_d)"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_formulas_of_one_small_file_are_spread(spark):
    formulas = spark.range(40).coalesce(1).selectExpr("id AS k", "'SUM(a b)' AS f", "'a b' AS n")
    out = rewrite.rename_references(formulas.select("k", "f"), formulas.select("n"), "k", "f", "n")
    assert "RepartitionByExpression [k" in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.f for r in out.collect()} == {"SUM(a_b)"}
