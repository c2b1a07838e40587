"""Each check passes clean data and names exactly the corrupted row."""

import pytest

from tallyspark.operators import quality as Q

SCHEMA = "id string, day int, amount double"
CLEAN = [("a", 1, 1.5), ("b", 1, 0.0), ("c", 2, None)]


@pytest.fixture
def table(spark):
    return lambda data: spark.createDataFrame(data, SCHEMA)


def test_clean_data_passes(table, rows):
    df = table(CLEAN)
    for check in (
        Q.not_null(df, "id"), Q.non_negative(df, "amount"), Q.unique(df, "id"),
        Q.unique_grain(df, ["id", "day"]), Q.drift_violations(df, "amount", df, "amount"),
    ):
        assert rows(check) == []


def test_corrupted_rows_are_found(table, rows):
    bad = table([*CLEAN, (None, 3, 1.0), ("a", 1, -2.0), (None, 4, 1.0)])
    assert rows(Q.not_null(bad, "id"), "day") == [(3,), (4,)]
    assert rows(Q.non_negative(bad, "amount")) == [(-2.0,)]
    assert rows(Q.unique(bad, "id")) == [("a", 2)]
    assert rows(Q.unique_grain(bad, ["id", "day"])) == [("a", 1, 2)]


@pytest.mark.parametrize("change, violated", [(0.009, False), (0.01, True), (-0.02, True)])
def test_drift(table, rows, change, violated):
    other = table([("x", 1, 1.5 + change)])
    got = rows(Q.drift_violations(table(CLEAN), "amount", other, "amount"))
    assert got == ([(pytest.approx(abs(change)),)] if violated else [])


def test_drift_of_empty_tables(table, rows):
    assert rows(Q.total_drift(table([]), "amount", table([]), "amount", "d")) == [(0.0,)]


def test_weights(spark, rows):
    schema = "account_id string, first_touch_weight double, last_touch_weight double, linear_weight double"
    good = [("a", 1.0, 0.0, 0.3333), ("a", 0.0, 0.0, 0.3333), ("a", 0.0, 1.0, 0.3333)]
    bad = [("b", 0.0, 1.0, 1.0), ("c", 1.0, 2.0, 1.0), ("d", 1.0, 1.0, 0.9989)]
    got = Q.weight_violations(spark.createDataFrame(good + bad, schema))
    assert rows(got, "account_id") == [("b",), ("c",), ("d",)]


def test_report_and_row_counts(table, rows):
    df = table([*CLEAN, ("d", 5, -1.0)])
    results = [
        Q.row_checks(df, {"id": df.id.isNull(), "amount": df.amount < 0}),
        Q.counted("unique", Q.unique(df, "id")),
    ]
    assert rows(Q.report(results)) == [("amount", 1, False), ("id", 0, True), ("unique", 0, True)]
    assert rows(Q.row_counts({"full": df, "none": table([])})) == [
        ("full", 4, True), ("none", 0, False),
    ]


def test_presence(spark, table, rows, tmp_path):
    (tmp_path / "here.csv").write_text("id\n1\n")
    got = Q.files_present(spark, str(tmp_path), ["here.csv", "gone.csv"])
    assert rows(got) == [("gone.csv", False), ("here.csv", True)]
    table(CLEAN).createOrReplaceTempView("checked_table")
    assert Q.table_exists(spark, "checked_table")
    assert not Q.table_exists(spark, "no_such_table")


def test_stored_models_are_read_back_and_checked(spark, rows, tmp_path):
    from tallyspark.queries import inputs

    w = inputs.order_world(spark, "/root/testdata/sf0.001")
    want = rows(w.fct_channel_efficiency_daily)
    w.store(str(tmp_path), "fct_channel_efficiency_daily")
    assert rows(w.fct_channel_efficiency_daily) == want
    assert str(tmp_path) in w.fct_channel_efficiency_daily.inputFiles()[0]
    w.register_views("stg_touchpoints")
    assert spark.sql("select count(*) from stg_touchpoints").first()[0] == 1500


def test_tables_present(spark, rows):
    spark.range(3).createOrReplaceTempView("three_rows")
    spark.range(0).createOrReplaceTempView("no_rows")
    got = Q.tables_present(spark, ["three_rows", "no_rows", "no_such_table"])
    assert rows(got) == [("no_rows", True, 0, False), ("no_such_table", False, 0, False), ("three_rows", True, 3, True)]
