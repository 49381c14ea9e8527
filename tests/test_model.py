import pytest
from conftest import rows

from caseloom.plans.model import ForeignKey, Model, find_table, list_tables
from caseloom.registry.core import Tables


@pytest.fixture()
def model(spark, folder):
    return Tables(spark, folder).model()


def test_ambiguous_path_needs_via(model):
    query = dict(dims={"n": "nation.n_name"}, measures={"q": "sum(lineitem.l_quantity)"})
    with pytest.raises(ValueError, match="several ways"):
        model.query(**query).to_df()
    by_customer = model.query(**query, via={"nation": "customer"}).to_df()
    by_supplier = model.query(**query, via={"nation": "supplier"}).to_df()
    assert rows(by_customer) != rows(by_supplier)
    assert by_customer.columns == ["n", "q"]


def test_measure_of_repeated_rows_is_refused(model):
    with pytest.raises(ValueError, match="repeat"):
        model.query(dims={"f": "lineitem.l_returnflag"}, measures={"t": "sum(orders.o_totalprice)"}).to_df()
    allowed = model.query(
        dims={"f": "lineitem.l_returnflag"}, measures={"t": "max(orders.o_totalprice)"}, repeated_rows_ok=True
    ).to_df()
    assert allowed.count() == 3


def test_unmentioned_tables_are_not_joined(model):
    plan = model.query(dims={"k": "orders.o_orderkey"}).to_df()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_filters_and_columns_reach_the_scan(model):
    df = model.query(
        dims={"s": "orders.o_orderstatus"}, measures={"q": "sum(lineitem.l_quantity)"}, where=["lineitem.l_quantity < 5"]
    ).to_df()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_quantity,5.0)" in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_names_in_quotes_are_no_columns(model):
    assert model.tables_in("orders.o_orderstatus = 'lineitem.l_quantity' AND o_custkey > 1") == {"orders"}


def test_unknown_column_and_missing_order(model):
    with pytest.raises(ValueError, match="no column"):
        model.tables_in("orders.nothing")
    with pytest.raises(ValueError, match="order"):
        model.query(dims={"k": "orders.o_orderkey"}, limit=3)


def test_saved_query_is_not_changed_by_extension(model):
    base = model.query(dims={"c": "customer.c_name"})
    wider = base.with_dim("n", "nation.n_name").where("nation.n_nationkey = 3")
    assert list(base.dims) == ["c"] and base.filters == ()
    assert wider.to_df().columns == ["c", "n"]


def test_check_keys(model):
    report = model.check_keys().collect()
    assert all(r.orphans == 0 and r.repeated_keys == 0 for r in report)


def test_composite_key(spark):
    lines = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0)], "a int, b int, v double")
    heads = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, name string")
    small = Model({"lines": lines, "heads": heads}, [ForeignKey("lines", "heads", (("a", "a"), ("b", "b")))])
    df = small.query(dims={"name": "heads.name"}, measures={"v": "sum(lines.v)"}).to_df()
    assert rows(df) == [("x", 5.0), ("y", 6.0), (None, 7.0)] or rows(df) == sorted([("x", 5.0), ("y", 6.0), (None, 7.0)], key=repr)


def test_find_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS finding")
    for name in ("sales_2020", "sales_2021", "stock"):
        spark.range(3).write.mode("overwrite").saveAsTable(f"finding.{name}")
    assert list_tables(spark, "finding") == ["sales_2020", "sales_2021", "stock"]
    assert find_table(spark, "stock", "finding").count() == 3
    assert find_table(spark, "2021", "finding", partial=True).count() == 3
    for name in ("sales", "nothing"):
        with pytest.raises(LookupError):
            find_table(spark, name, "finding", partial=True)


def test_rebind_model(spark, folder):
    t = Tables(spark, folder)
    tables = {n: t(n) for n in ("nation", "region")}
    original = Model(tables, [ForeignKey("nation", "region", (("n_regionkey", "r_regionkey"),))])
    spark.sql("CREATE DATABASE IF NOT EXISTS other_store")
    registry = {}
    with pytest.raises(ValueError, match="lacks"):
        original.rebind(spark, "other_store", registry, "copy")
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"other_store.{name}")
    bound = original.rebind(spark, "other_store", registry, "copy")
    query = dict(dims={"n": "nation.n_name", "r": "region.r_name"})
    assert rows(bound.query(**query).to_df()) == rows(original.query(**query).to_df())
    with pytest.raises(ValueError, match="exists"):
        original.rebind(spark, "other_store", registry, "copy")


@pytest.mark.parametrize("expression", [
    "cast(orders.created as date)", "date_trunc('day', orders.created)", "orders.created + interval 1 day", "concat(orders.id, \"date\")", "sum(orders.id)", "transform(array(orders.id), day -> day)",
])
def test_only_columns_count_as_columns(spark, expression):
    orders = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-01-02")], "id int, created string")
    other = spark.createDataFrame([(1, 2, 3, 4)], "date int, day int, timestamp int, sum int")
    assert Model({"orders": orders, "other": other}).tables_in(expression) == {"orders"}


def test_names_that_are_types(spark):
    items = spark.createDataFrame([(1, "x"), (1, "y")], "order_id int, name string")
    orders = spark.createDataFrame([(1, "2020-01-01", 5)], "id int, date string, sum int")
    model = Model({"items": items, "orders": orders}, [ForeignKey("items", "orders", (("order_id", "id"),))])
    assert model.query(dims={"d": "cast(orders.date as date)"}, measures={"n": "count(orders.sum)"}).to_df().count() == 1
    assert model.tables_in("orders.`date`") == {"orders"} and model.tables_in("name") == {"items"}
