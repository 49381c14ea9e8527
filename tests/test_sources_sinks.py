import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseloom.plans.model import ForeignKey, Model
from caseloom.sinks import exports
from caseloom.sinks.tables import TableStore, upsert_result
from caseloom.sinks.versions import VersionedTable
from caseloom.sources.csv import combine_csv, csv_payload, scan_csv
from caseloom.sources.extract import incremental_extract, trailing_days, unify_sources
from caseloom.sources.json import flatten, paged_json, paged_service
from caseloom.sources.pages import PagedJsonSource


@pytest.fixture()
def store(spark, tmp_path):
    return TableStore(spark, "sink_tests", str(tmp_path))


def write(path, text):
    path.write_text(text, encoding="utf-8")


def test_scan_csv_types(spark, tmp_path):
    write(tmp_path / "a.csv", "day,price\n2020-01-01,1.5\n2020-01-02,\n")
    assert rows(scan_csv(spark, str(tmp_path / "a.csv"), "day string, price double")) == [("2020-01-01", 1.5), ("2020-01-02", None)]
    assert dict(scan_csv(spark, str(tmp_path / "a.csv")).dtypes)["price"] == "double"


def test_combine_csv_matches_columns_by_name(spark, tmp_path):
    write(tmp_path / "one.csv", "a,b\n1,x\n2,y\n")
    write(tmp_path / "two.csv", "b,a\nz,3\n")
    write(tmp_path / "three.csv", "a,b,c\n4,w,9\n")
    write(tmp_path / "notes.txt", "ignored\n")
    combined = combine_csv(spark, str(tmp_path)).select("a", "b", "c")
    assert rows(combined) == [(1, "x", None), (2, "y", None), (3, "z", None), (4, "w", 9)]


def test_combine_csv_of_empty_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        combine_csv(spark, str(tmp_path))


def test_paged_json_stops_at_the_empty_page(spark, tmp_path):
    pages = [[{"id": 1}, {"id": 2}], [{"id": 3}], [], [{"id": 99}]]
    for i, page in enumerate(pages):
        write(tmp_path / f"page-{i}.json", json.dumps({"rows": page}))
    df = paged_json(spark, str(tmp_path), "rows", "id int")
    assert rows(df) == [(0, 1), (0, 2), (1, 3)]


def test_paged_service_reads_in_parallel(spark, tmp_path):
    for i in range(11):
        write(tmp_path / f"page-{i}.json", json.dumps({"rows": [{"id": 10 * i + j} for j in range(3)]}))
    df = paged_service(spark, PagedJsonSource, folder=str(tmp_path), row_schema="id int", readers="4")
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in df.collect()) == [10 * i + j for i in range(11) for j in range(3)]


def test_csv_payload_with_long_records(spark):
    long, quotes = "x" * 1_000_000, 'a""b,\n' * 150_000
    body = f'a,b\n1,{long}\n2,"{quotes}"\n3,plain\r\n4,"no end'
    df = spark.createDataFrame([(7, body)], "log int, body string")
    got = {r.a: r.b for r in csv_payload(df, "body", "a int, b string", ["log"]).collect()}
    assert got[1] == long and got[2] == quotes.replace('""', '"') and got[3] == "plain" and set(got) == {1, 2, 3, 4}
    short = csv_payload(spark.createDataFrame([(1, 'a;b\n\n5;"x;""y"" "\n6;z')], "log int, body string"), "body", "a int, b string", sep=";")
    assert rows(short) == [(5, 'x;"y" '), (6, "z")]


def test_csv_payload(spark):
    df = spark.createDataFrame([(1, "a,b\n1,x\r\n2,\"y,z\"\n\n"), (2, "a,b\n")], "log int, body string")
    assert rows(csv_payload(df, "body", "a int, b string", ["log"])) == [(1, 1, "x"), (1, 2, "y,z")]


def test_flatten_keeps_arrays(spark):
    df = spark.sql("SELECT struct(1 AS x, struct('v' AS z) AS y) AS a, array(1, 2) AS l")
    assert flatten(df).columns == ["a.x", "a.y.z", "l"]
    assert rows(flatten(df)) == [(1, "v", [1, 2])]


def test_incremental_extract_of_empty_target(spark):
    src = spark.sql("SELECT id, timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, cast(id AS int)) AS d FROM range(10)")
    everything = incremental_extract(src, src.where("false"), "d", "2020-01-03", "2020-01-08", "d", 2)
    assert sorted(r.id for r in everything.collect()) == [2, 3, 4, 5, 6, 7]
    later = incremental_extract(src, src.where("id <= 6"), "d", "2020-01-03", "2020-01-08", "d", 1)
    assert sorted(r.id for r in later.collect()) == [5, 6, 7]


def test_trailing_days_is_pushed_down(spark, folder):
    plan = trailing_days(spark.read.parquet(f"{folder}/events.parquet"), "ts", "2024-01-20", 7)
    assert "GreaterThanOrEqual(ts" in plan._jdf.queryExecution().executedPlan().toString()


def test_unify_prefers_the_first_source(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "b", 5), (2, "c", 6)], "k int, v string, w int")
    assert rows(unify_sources({"a": a, "b": b}, ["k"]).select("source", "k", "v", "w")) == [("a", 1, "a", None), ("b", 2, "c", 6)]


# Sinks


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string")


def test_replace_append_and_error(spark, store):
    store.replace("t", frame(spark, (1, "a")))
    store.append("t", frame(spark, (2, "b")).select("v", "k"))
    assert rows(store.read("t")) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="exists"):
        store.create("t", frame(spark, (3, "c")))
    with pytest.raises(ValueError, match="do not fit"):
        store.append("t", spark.createDataFrame([(1,)], "other int"))
    store.replace("t", store.read("t").where("k = 2"))
    assert rows(store.read("t")) == [(2, "b")]
    store.replace("t", spark.createDataFrame([(1.5,)], "x double"))
    assert store.read("t").columns == ["x"]


def test_replace_from_path_with_types_and_keys(spark, store, tmp_path):
    path = str(tmp_path / "in.parquet")
    frame(spark, (1, "7"), (2, "8")).write.parquet(path)
    store.replace("typed", path, types={"v": "int"}, primary_keys=["k"])
    assert dict(store.read("typed").dtypes)["v"] == "int"
    assert store.primary_keys("typed") == ["k"]
    with pytest.raises(ValueError, match="repeat"):
        store.replace("typed", frame(spark, (1, "a"), (1, "b")), primary_keys=["k"])


def test_upsert_new_changed_unchanged_and_null_keys(spark, store):
    store.create("u", frame(spark, (1, "a"), (2, "b"), (None, "n")), primary_keys=["k"])
    change = frame(spark, (2, "B"), (3, "c"), (None, "N"))
    store.upsert("u", change)
    want = sorted([(1, "a"), (2, "B"), (3, "c"), (None, "N")], key=repr)
    assert rows(store.read("u")) == want
    store.upsert("u", change)
    assert rows(store.read("u")) == want
    store.upsert("u", change.where("false"))
    assert rows(store.read("u")) == want


def test_upsert_duplicates_need_an_order(spark):
    target = frame(spark, (1, "a"))
    twice = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "k int, v string, at int")
    with pytest.raises(ValueError, match="repeat"):
        upsert_result(target, twice, ["k"])
    assert rows(upsert_result(target, twice, ["k"], [F.desc("at")])) == [(1, "c")]


def test_upsert_rewrites_touched_partitions_only(spark, store):
    data = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 1, "c")], "p string, k int, v string")
    store.create("parts", data, primary_keys=["p", "k"], partition_by=["p"])
    before = {f for f in store.read("parts").where("p = 'y'").inputFiles()}
    store.upsert("parts", spark.createDataFrame([("x", 2, "B"), ("x", 3, "d"), ("z", 1, "e")], "p string, k int, v string"))
    got = rows(store.read("parts").select("p", "k", "v"))
    assert got == [("x", 1, "a"), ("x", 2, "B"), ("x", 3, "d"), ("y", 1, "c"), ("z", 1, "e")]
    assert {f for f in store.read("parts").where("p = 'y'").inputFiles()} == before


def test_upsert_of_a_keyed_table_carries_untouched_buckets(spark, store, tmp_path):
    kept = VersionedTable(spark, str(tmp_path / "kept"))
    kept.replace(spark.range(400).selectExpr("id AS k", "'a' AS v"), ["k"], bucket_rows=50)
    before = kept.manifest()
    assert before["buckets"] == 8 and sum(before["rows"].values()) == 400
    kept.upsert(spark.createDataFrame([(7, "b")], "k bigint, v string"))
    after = kept.manifest()
    assert sum(after["folders"][b] != before["folders"][b] for b in before["folders"]) == 1
    assert rows(kept.read().where("v = 'b'")) == [(7, "b")] and kept.read().count() == 400
    assert kept.read(before["version"]).where("v = 'b'").count() == 0
    kept.upsert(spark.range(300, 1_300).selectExpr("id AS k", "'c' AS v"))  # the table outgrows its buckets
    assert kept.manifest()["buckets"] == 32
    assert rows(kept.read().groupBy("v").count()) == [("a", 299), ("b", 1), ("c", 1_000)]
    kept.retain(1)
    assert kept.versions() == [2] and kept.read().count() == 1_300
    folders = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "kept" / "data").glob("*/__bucket=*")}
    assert folders == {f for listed in kept.manifest()["folders"].values() for f in listed}


def test_two_writers_of_a_keyed_table(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "both")) for _ in range(2))
    one.replace(frame(spark, (1, "a"), (2, "a")), ["k"])
    publish, slept = one._list, []

    def late(manifest):
        if not slept:  # the other writer is faster once
            slept.append(two.upsert(frame(spark, (2, "two"), (3, "two"))))
        publish(manifest)

    one._list = late
    one.upsert(frame(spark, (1, "one")))
    assert rows(two.read()) == [(1, "one"), (2, "two"), (3, "two")]
    assert two.versions() == [0, 1, 2]


def test_keyed_table_is_also_a_view(spark, store):
    store.create("seen", frame(spark, (1, "a")).where("false"), primary_keys=["k"])
    assert rows(spark.table(store.full_name("seen"))) == [] and store.read("seen").count() == 0
    store.append("seen", frame(spark, *[(i, "b") for i in range(50)]))
    store.append("seen", frame(spark, (50, "c")))
    store.upsert("seen", frame(spark, (3, "x"), (51, "y")))
    assert rows(spark.table(store.full_name("seen"))) == rows(store.read("seen"))
    assert store.read("seen").count() == 52 and store.primary_keys("seen") == ["k"]
    store.replace("seen", store.read("seen").where("v <> 'b'"), primary_keys=["k"])
    assert rows(spark.table(store.full_name("seen"))) == [(3, "x"), (50, "c"), (51, "y")]
    store.replace("seen", store.read("seen").where("k = 50"))
    assert rows(store.read("seen")) == [(50, "c")] and store.primary_keys("seen") == []
    store.replace("seen", spark.createDataFrame([("z", 1)], "n string, k int"), primary_keys=["n"])
    assert rows(spark.table(store.full_name("seen"))) == [("z", 1)] and store.primary_keys("seen") == ["n"]


def test_append_or_create_registers_once(spark, store):
    model = Model({"orders": frame(spark, (1, "o"))})
    key = ForeignKey("orders", "history", (("k", "k"),))
    store.append_or_create("history", frame(spark, (1, "a")), model, key)
    store.append_or_create("history", frame(spark, (1, "b")), model, key)
    assert rows(store.read("history")) == [(1, "a"), (1, "b")]
    assert model.keys == [key]


def test_locale_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 1234567.5, 0.001), (2, 12345678.25, None), (3, 1e7, -0.5)], "k int, x double, y double")
    frame_ = exports.locale_csv_frame(df)
    assert rows(frame_) == [(1, "1234567,5", "0,001"), (2, "12345678,25", None), (3, "10000000,0", "-0,5")]
    path = exports.write_locale_csv(df, str(tmp_path), "summary", "2024-01-02_03h04")
    assert path.endswith("summary_2024-01-02_03h04")
    assert rows(spark.read.option("sep", ";").option("header", True).csv(path)) == [("1", "1234567,5", "0,001"), ("2", "12345678,25", None), ("3", "10000000,0", "-0,5")]


def test_snapshot_is_partitioned_and_skips_unpublished(spark, tmp_path):
    df = spark.createDataFrame([("s1", "kpi", "a", True), ("s1", "view", "b", True), ("s2", "kpi", "c", False)], "space string, kind string, body string, live boolean")
    out = exports.snapshot_rows(df, F.col("live"), "v1", ["space", "kind"], ["body"])
    exports.write_snapshot(out, str(tmp_path / "snap"), ["space", "kind"])
    assert sorted(p.name for p in (tmp_path / "snap" / "space=s1").iterdir() if p.is_dir()) == ["kind=kpi", "kind=view"]
    assert not (tmp_path / "snap" / "space=s2").exists()
    exports.export_report(out, str(tmp_path / "report"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 2


def test_csv_text_with_quoted_line_breaks(spark):
    from caseloom.sources.csv import csv_payload

    df = spark.createDataFrame([("p", 'a,b\n1,"two\nlines"\r\n\r\n2,"say ""hi"", x"\n3,')], "k string, t string")
    got = csv_payload(df, "t", "a int, b string", keep=["k"])
    assert rows(got) == [("p", 1, "two\nlines"), ("p", 2, 'say "hi", x'), ("p", 3, None)]


def test_null_placeholders_keep_a_reference(spark):
    from caseloom.operators.relational import remap_ids

    source = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, placeholder string")
    target = spark.createDataFrame([(7, "A")], "id bigint, placeholder string")
    records = spark.createDataFrame([((1,),), ((2,),), (None,)], "r struct<ref: bigint>")
    moved, complete = remap_ids(records, ["r.ref"], source, target)
    assert sorted((r.r.ref if r.r else None for r in moved.collect()), key=repr) == sorted([7, 8, None], key=repr)
    assert rows(complete) == sorted([(7, "A"), (8, None)], key=repr)


def test_page_service_stops_at_the_first_empty_page(spark, tmp_path):
    for page in range(14):
        (tmp_path / f"page-{page}.json").write_text(json.dumps({"rows": [] if page == 2 else [{"id": page}]}))
    df = paged_service(spark, PagedJsonSource, folder=str(tmp_path), row_schema="id int", readers="4")
    assert rows(df) == [(0,), (1,)] == rows(paged_json(spark, str(tmp_path), "rows", "id int").drop("page"))


def test_page_service_without_a_first_page_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no first page"):
        paged_service(spark, PagedJsonSource, folder=str(tmp_path), row_schema="id int").count()
