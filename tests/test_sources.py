import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspark.operators import staging
from tallyspark.plans.models import RawTables
from tallyspark.sources import api, files
from tallyspark.sources.schemas import HACKERNEWS_BUZZ, PROJECT_TELEMETRY, RAW_SCHEMAS


def test_quotes_commas_and_line_breaks(spark, rows, tmp_path):
    path = tmp_path / "buzz.csv"
    path.write_text(
        "title,points,num_comments,created_at\n"
        '"Fly Postgres, Managed",292,118,2023-12-15T11:52:56Z\n'
        '"She said ""no""\nand left",5,,2023-12-16T11:52:56Z\n',
        newline="",
    )
    df = files.scan_csv(spark, str(path), HACKERNEWS_BUZZ, multi_line=True)
    staged = staging.stg_hackernews_buzz(df)
    assert rows(staged) == [
        (1, 'She said "no"\nand left', 5, None, dt.datetime(2023, 12, 16, 11, 52, 56), None),
        (2, "Fly Postgres, Managed", 292, 118, dt.datetime(2023, 12, 15, 11, 52, 56), 674.0),
    ]


def test_empty_date_and_capital_booleans(spark, rows, tmp_path):
    path = tmp_path / "projects.csv"
    path.write_text(
        "project_id,account_id,provisioned_at,has_auth,has_storage,has_edge_functions,has_pgvector,"
        "time_to_first_query_min,compute_hours,db_size_mb,egress_gb,is_pro_upgrade,"
        "pro_upgrade_date,monthly_invoice_usd\n"
        "p1,a1,2026-01-02,True,False,True,False,1.5,2.5,3.5,4.5,False,,0.0\n"
    )
    df = files.scan_csv(spark, str(path), PROJECT_TELEMETRY)
    assert rows(df, "has_auth", "has_storage", "pro_upgrade_date", "provisioned_at") == [
        (True, False, None, dt.date(2026, 1, 2))
    ]


def test_row_that_does_not_fit_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("title,points,num_comments,created_at\nx,many,1,2026-01-01\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD"):
        files.scan_csv(spark, str(path), HACKERNEWS_BUZZ).collect()


def test_csv_round_trip_keeps_text_and_microseconds(spark, rows, tmp_path):
    df = spark.sql(
        "select ' padded, \"q\" ' as t, timestamp_ntz'2026-01-02 03:04:05.123456' as at, "
        "date'2026-01-02' as d, cast(null as double) as v"
    )
    files.write_csv(df, str(tmp_path / "out"))
    back = files.scan_csv(spark, str(tmp_path / "out"), "t string, at timestamp_ntz, d date, v double")
    assert rows(back) == rows(df)
    inferred = files.infer_csv(spark, str(tmp_path / "out"))
    assert [f.dataType.simpleString() for f in inferred.schema] == [
        "string", "timestamp_ntz", "date", "string"
    ]


def test_load_all_tables(spark, rows, tmp_path):
    for name, schema in RAW_SCHEMAS.items():
        header = ",".join(part.split()[0] for part in schema.split(", "))
        (tmp_path / f"{name}.csv").write_text(header + "\n")
    raw = RawTables.from_csv(spark, str(tmp_path))
    assert raw.fx_rates.columns == ["base_currency", "quote_currency", "rate", "fetched_at"]
    assert rows(raw.marketing_spend) == []


def documents(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, doc string")


def test_missing_members_get_defaults_and_null_stays(spark, rows):
    df = documents(spark, '{"stargazers_count": 5, "forks_count": null}', "not json")
    assert rows(api.object_rows(df, "doc", keep=["id"])) == [(0, 5, None, 120, 1800)]


def test_first_stories_in_place(spark, rows):
    hits = ",".join(f'{{"title": "s{i}", "points": {i}}}' for i in range(30))
    df = documents(spark, f'{{"hits": [{hits}]}}', '{"hits": []}', "{}")
    got = rows(api.list_rows(df, "doc", keep=["id"]), ordered=True)
    assert len(got) == 20
    assert got[3] == (0, 3, "s3", 3, 0, "")
    assert len(rows(api.list_rows(df, "doc", first=2))) == 2


def test_rates_with_required_currencies(spark, rows):
    df = documents(spark, '{"rates": {"EUR": 0.9, "JPY": 150}}', '{"rates": {}}', "{}")
    plain = rows(api.rate_rows(df, "doc", keep=["id"]))
    assert plain == [(0, "USD", "EUR", 0.9), (0, "USD", "JPY", 150.0)]
    full = rows(api.rate_rows(df, "doc", keep=["id"], required={"EUR": 1.0, "CAD": 1.4}))
    assert full == [
        (0, "USD", "CAD", 1.4), (0, "USD", "EUR", 0.9), (0, "USD", "JPY", 150.0),
        (1, "USD", "CAD", 1.4), (1, "USD", "EUR", 1.0),
        (2, "USD", "CAD", 1.4), (2, "USD", "EUR", 1.0),
    ]


def test_fallback(spark, rows):
    full = spark.createDataFrame([(1,)] * 3, "x int")
    other = spark.createDataFrame([(7,), (8,)], "x int")
    assert rows(api.fallback_if_empty(full, other)) == [(1,)] * 3
    assert rows(api.fallback_if_empty(full.where("x > 1"), other)) == [(7,), (8,)]


def test_fill_members(spark, rows):
    have = spark.createDataFrame([("EUR", 0.9), ("EUR", 0.8)], "c string, rate double")
    need = spark.createDataFrame([("EUR", 1.0), ("IDR", 2.0)], "c string, rate double")
    assert rows(api.fill_required_members(have, "c", need)) == [
        ("EUR", 0.8), ("EUR", 0.9), ("IDR", 2.0)
    ]


def test_table_refresh_replaces(spark, rows, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("part"))
    for expected in (df, df.where("id < 10")):
        files.write_table(expected, path, partition_by=["part"])
        assert rows(spark.read.schema(df.schema).parquet(path)) == rows(expected)
    assert len(list((tmp_path / "mart").glob("part=*"))) == 3


def test_json_sections(spark, rows, tmp_path):
    df = spark.sql("select 'a' as k, 1.5D as v, cast(null as bigint) as n")
    files.write_json_sections({"one": df, "two": df}, str(tmp_path))
    assert rows(files.read_json_section(spark, str(tmp_path), "two", df.schema)) == rows(df)


def test_broken_documents_fall_back_or_are_rejected(spark, rows):
    df = documents(spark, "{broken", None, "[1]", '{"stargazers_count": 5, "hits": [{"title": "t"}, 5, null]}')
    assert [r[:2] for r in rows(api.object_rows(df, "doc", keep=["id"]))] == [(3, 5)]
    full = rows(api.object_rows(df, "doc", keep=["id"], fallback=True))
    assert [r[:2] for r in full] == [(0, 72000), (1, 72000), (2, 72000), (3, 5)]
    assert rows(api.rejected_documents(df, "doc", keep=["id"]), "id", "reason") == [
        (0, "not JSON"), (1, "missing"), (2, "not an object")
    ]
    # Entries that are no objects give no row; documents without a list give the fallback.
    listed = rows(api.list_rows(df, "doc", keep=["id"], fallback=[{"title": "f", "points": 9}]))
    assert [r[:4] for r in listed] == [(0, 0, "f", 9), (1, 0, "f", 9), (2, 0, "f", 9), (3, 0, "t", 0)]


def test_a_whole_list_is_unpacked(spark, rows):
    hits = ",".join(f'{{"title": "s{i}"}}' for i in range(300))
    df = documents(spark, f'{{"hits": [{hits}]}}', '{"hits": []}')
    assert len(rows(api.list_rows(df, "doc", first=None, keep=["id"]))) == 300


def test_inferred_rows_that_do_not_fit_fail(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('a,b\n1,"x\ny"\n2,z\n')
    got = files.infer_csv(spark, str(path), multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "x\ny"), (2, "z")]
    path.write_text("a,b\n1,x\n2,z,surplus\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.infer_csv(spark, str(path)).collect()


def test_files_of_bounded_length(spark, rows, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('line', char(10), id) as t").coalesce(1)
    files.write_csv(df, str(tmp_path / "out"), rows_per_file=30)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 4
    back = files.scan_csv(spark, str(tmp_path / "out"), "id bigint, t string", multi_line=True)
    assert rows(back) == rows(df)
