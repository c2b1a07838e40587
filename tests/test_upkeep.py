"""Published versions, refresh after changes, as-of rates, stable ids, ledger, checked input."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import asof, compare_tables, ledger, stable_ids
from tallyspark.operators.currency import spend_normalised
from tallyspark.plans import refresh
from tallyspark.plans.models import MeasurementModels, RawTables
from tallyspark.sources import files, schemas
from tallyspark.sources.versions import VersionedTable

DAY0 = dt.date(2026, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


# ------------------------------------------------------------ versions


def test_versions_stay_readable(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing is published"):
        table.read()
    first = table.publish(spark.range(3).toDF("a"))
    # Rebuilt from itself.
    second = table.publish(first.select((F.col("a") * 10).alias("a")))
    assert rows(first) == [(0,), (1,), (2,)] and rows(second) == [(0,), (10,), (20,)]
    assert table.versions() == [1, 2] and rows(table.read(1)) == rows(first)
    assert table.expire(keep=1) == [1] and rows(table.read()) == rows(second)
    assert len([f for f in os.listdir(tmp_path / "t" / "data") if not f.startswith(".")]) == 1


def test_a_failed_write_changes_nothing(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"), "k")
    table.publish(spark.range(10).select(F.col("id").alias("v"), (F.col("id") % 3).alias("k")))
    before = rows(table.read())
    broken = table.read().withColumn("v", F.when(F.col("v") == 7, F.raise_error(F.lit("half way"))).otherwise(F.col("v")).cast("long"))
    for attempt in (lambda: table.publish(broken), lambda: table.replace(broken, [0, 1, 2])):
        with pytest.raises(Exception, match="half way"):
            attempt()
        assert table.versions() == [1] and rows(table.read()) == before
    with pytest.raises(ValueError, match="outside the replaced"):
        table.replace(table.read(), [1])
    with pytest.raises(ValueError, match="columns differ"):
        table.replace(table.read().withColumn("more", F.lit(1)), [0, 1, 2])
    assert table.versions() == [1]


def test_replace_keeps_other_files(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"), "k")
    table.publish(spark.range(9).select(F.col("id").alias("v"), F.when(F.col("id") < 8, F.col("id") % 4).alias("k")))
    kept = files_of(table.read().where("k in (0, 1) or k is null"))
    # Partition 2 gets one row, partition 3 goes, partition 9 is new.
    table.replace(spark.createDataFrame([(100, 2), (200, 9)], "v long, k long"), [2, 3, 9])
    assert rows(table.read().select("v", "k")) == sorted(
        [(0, 0), (4, 0), (1, 1), (5, 1), (100, 2), (200, 9), (8, None)], key=repr
    )
    assert kept and kept <= files_of(table.read())


def test_second_writer_is_refused(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(1).toDF("a"))
    stale = table._manifest()
    table.publish(spark.range(2).toDF("a"))
    folder, names = table._write(spark.range(5).toDF("a"))
    with pytest.raises(RuntimeError, match="published by someone else"):
        table._commit(stale, spark.range(1).toDF("a").schema, {folder: names})
    assert table.read().count() == 2


# ------------------------------------------------------------ refresh


def small_world(spark, seed=1, days=40):
    rng = random.Random(seed)
    channels = ["paid_search", "paid_social", "organic"]
    spend = [
        (day(d), c, r, round(rng.uniform(0, 900), 2), rng.randrange(1000), rng.randrange(90), rng.randrange(9))
        for d in range(days) for c in channels for r in ("US-East", "US-West") if rng.random() < 0.6
    ]
    accounts, projects, touches = [], [], []
    for a in range(120):
        signup = rng.randrange(days)
        accounts.append((f"a{a}", day(signup), rng.choice(channels), rng.choice(["US-East", "US-West", "EU-Central"]), a % 9 == 0, "email"))
        up = rng.random() < 0.5
        upgrade = min(days - 1, signup + rng.randrange(20))
        projects.append(
            (f"p{a}", f"a{a}", day(signup), True, False, a % 2 == 0, False, 9.0, float(a), 1.0, 1.0, up, day(upgrade) if up else None, 25.0 * up)
        )
        for t in range(rng.randrange(5)):
            at = max(0, min(days - 1, signup + rng.randrange(-5, 10)))
            touches.append((f"a{a}", f"t{a}_{t}", dt.datetime.combine(day(at), dt.time(t)), rng.choice(channels), f"camp_00{t}"))
    return {"marketing_spend": spend, "developer_accounts": accounts, "project_telemetry": projects, "touchpoints": touches}


def raw_tables(spark, world):
    make = lambda name: spark.createDataFrame(world[name], schemas.RAW_SCHEMAS[f"raw_{name}"])
    return RawTables(**{name: make(name) for name in world})


def changed_rows(spark, old, new):
    both = {}
    for name in old:
        rows_ = [r for r in old[name] if r not in new[name]] + [r for r in new[name] if r not in old[name]]
        if rows_:
            both[name] = spark.createDataFrame(rows_, schemas.RAW_SCHEMAS[f"raw_{name}"])
    return refresh.Changes(**both)


def edit(world, kind, rng):
    new = {k: list(v) for k, v in world.items()}
    if kind == "spend":
        new["marketing_spend"] = [r for r in new["marketing_spend"] if not (r[0] == day(10) and r[1] == "organic")]
        new["marketing_spend"].append((day(20), "paid_search", "EU-Central", 555.5, 1, 1, 1))
    if kind == "touch":
        paid = {p[1] for p in new["project_telemetry"] if p[11]}
        victim = next(t for t in new["touchpoints"] if t[0] in paid)
        new["touchpoints"].remove(victim)
        new["touchpoints"].append(("a3", "late", dt.datetime.combine(day(2), dt.time(1)), "organic", "camp_001"))
    if kind == "project":
        i = next(i for i, p in enumerate(new["project_telemetry"]) if p[11])
        new["project_telemetry"][i] = (*new["project_telemetry"][i][:11], False, None, 0.0)
    if kind == "account":
        moved = new["developer_accounts"][5]
        new["developer_accounts"][5] = (moved[0], day(1), "organic", "EU-Central", False, "email")
        new["developer_accounts"].append(("new", day(30), "paid_social", "US-East", False, "email"))
    return new


@pytest.mark.parametrize("kind", ["spend", "touch", "project", "account"])
def test_refresh_equals_a_rebuild(spark, tmp_path, rows, kind):
    world = small_world(spark)
    after = edit(world, kind, random.Random(2))
    old, new = (MeasurementModels(raw_tables(spark, w)) for w in (world, after))
    folder = str(tmp_path / "marts")
    refresh.publish(old, folder)
    tables = {n: refresh.daily_table(spark, folder, n) for n in refresh.DAILY_MARTS}
    before = {n: (rows(t.read()), files_of(t.read())) for n, t in tables.items()}
    dirty = refresh.refresh(new, changed_rows(spark, world, after), folder)
    assert 0 < len(dirty) < 40
    for name, table in tables.items():
        got, want = table.read(), getattr(new, name)
        assert rows(got.select(*want.columns)) == rows(want)
        untouched = got.where(~F.col("date_day").isin(*dirty))
        kept = files_of(untouched)
        assert kept and kept <= before[name][1]
        # Nothing that differs lies outside the dirty days.
        assert rows(table.read(1)) == before[name][0]


def test_carry_over_reaches_four_rows(spark):
    days_ = [0, 1, 2, 9, 10, 11, 12, 30]
    spend = [(day(d), "a", "r", 1.0, 1, 1, 1) for d in days_] + [(day(5), "b", "r", 1.0, 1, 1, 1)]
    world = {"marketing_spend": spend}
    change = refresh.Changes(marketing_spend=spark.createDataFrame([(day(2), "a"), (day(4), "a")], "date date, channel string"))
    got = refresh.dirty_days(raw_tables(spark, world), change, MeasurementModels(None).params)
    # Day 2 and the next four rows; day 4 is gone but was there.
    assert sorted(r[0] for r in got.collect()) == [day(d) for d in (2, 4, 9, 10, 11, 12)]


def test_no_changes_is_an_error(spark):
    with pytest.raises(ValueError, match="no changes"):
        refresh.dirty_days(None, refresh.Changes(), None)


# ------------------------------------------------------------ as-of join


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_asof_join(spark, bucket):
    rng = random.Random(4)
    at = lambda: dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 50))
    key = lambda: rng.choice(["x", "x", "x", "y", "z", None])
    left = [(i, key(), None if rng.random() < 0.05 else at()) for i in range(400)]
    right = [(key(), None if rng.random() < 0.05 else at(), i, "_asof") for i in range(60)]
    right += [("x", right[0][1], 1000, "tie"), ("y", left[0][2], 2000, "same time")]
    df = asof.asof_join(
        spark.createDataFrame(left, "id long, k string, at timestamp_ntz"),
        spark.createDataFrame(right, "k string, t timestamp_ntz, v long, w string"),
        ["k"], "at", "t", ["v", "w"], bucket,
    )
    got = {r.id: (r.v, r.w) for r in df.collect()}
    assert len(got) == 400 and df.columns == ["id", "k", "at", "v", "w"]
    for i, k, t in left:
        best = max(((r[1], r[2], r[3]) for r in right if k is not None and t and r[0] == k and r[1] and r[1] <= t), default=None)
        assert got[i] == (best[1:] if best else (None, None))


def test_asof_join_of_nothing(spark):
    left = spark.createDataFrame([(1, "x", None)], "id long, k string, at timestamp_ntz")
    right = spark.createDataFrame([], "k string, t timestamp_ntz, v long")
    assert [tuple(r) for r in asof.asof_join(left, right, ["k"], "at", "t", ["v"]).collect()] == [(1, "x", None, None)]
    assert asof.asof_join(left.limit(0), right, ["k"], "at", "t", ["v"]).count() == 0


def test_spend_in_one_currency(spark, rows):
    spend = [(day(1), "USD", 10.0), (day(1), "EUR", 10.0), (day(3), "EUR", 10.0), (day(3), "GBP", 10.0), (day(4), None, 1.0)]
    quotes = [("EUR", dt.datetime(2026, 1, 2, 9), 2.0), ("EUR", dt.datetime(2026, 1, 2, 18), 4.0), ("EUR", dt.datetime(2026, 1, 6), 9.0), ("GBP", dt.datetime(2026, 1, 5), 9.0)]
    got = spend_normalised(
        spark.createDataFrame(spend, "date date, currency string, spend double"),
        spark.createDataFrame(quotes, "quote_currency string, fetched_at timestamp_ntz, rate_to_usd double"),
    )
    found = {(r.date, r.currency): (r.rate_to_usd, r.spend_home) for r in got.collect()}
    assert found == {
        (day(1), "USD"): (1.0, 10.0), (day(1), "EUR"): (4.0, 40.0), (day(3), "EUR"): (4.0, 40.0),
        (day(3), "GBP"): (None, None), (day(4), None): (None, None),
    }


# ------------------------------------------------------------ stable ids, ledger


def test_ids_never_change(spark, rows):
    load = lambda items: spark.createDataFrame(items, "key string, at int")
    first = stable_ids.with_new_keys(None, load([("b", 5), ("a", 5), ("c", 9), ("c", 1), (None, 3)]), "key", [F.col("at")], "id")
    assert rows(first) == [("a", 2), ("b", 3), ("c", 1)]
    second = stable_ids.with_new_keys(first, load([("z", 0), ("a", 0), ("y", 7)]), "key", [F.col("at")], "id")
    assert rows(second) == [("a", 2), ("b", 3), ("c", 1), ("y", 5), ("z", 4)]
    assert rows(stable_ids.with_new_keys(second, load([]), "key", [F.col("at")], "id")) == rows(second)


def test_every_upgrade_is_in_the_ledger(spark):
    world = small_world(spark, seed=5)
    world["touchpoints"] = world["touchpoints"][::2]
    models = MeasurementModels(raw_tables(spark, world))
    panel = models.int_adstock_and_saturation.where(F.dayofmonth("spend_date") % 3 != 0)
    cells = ledger.credit_ledger(panel, models.stg_touchpoints, models.stg_developer_plg_events, models.geo_lift_daily)
    total = ledger.ledger_totals(cells).first()
    assert total.upgrades == sum(p[11] for p in world["project_telemetry"])
    assert total.upgrades == total.shown + total.lost_without_spend + total.lost_without_touch
    assert min(total.shown, total.lost_without_spend, total.lost_without_touch) > 0
    # What the marts would show is what the ledger says is shown.
    shown = models.mta_daily.join(panel.select(F.col("spend_date").alias("date_day"), "channel"), ["date_day", "channel"])
    assert shown.agg(F.sum("mta_first_touch_conversions")).first()[0] == total.shown
    assert ledger.ledger_totals(cells.limit(0)).first().upgrades == 0


# ------------------------------------------------------------ checked and unknown files


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_unfit_rows_are_set_aside(spark, tmp_path, rows):
    path = write(tmp_path, "a.csv", 'id,day,note\n1,2026-01-01,"a, b"\nx,2026-13-01,c\n3,,\n4,2026-01-02\n5,2026-01-02,d,e\n6,2026-01-03,"say ""hi"""\n')
    good, bad = files.scan_csv_checked(spark, path, "id int, day date, note string", required=["note"])
    assert rows(good) == [(1, day(0), "a, b"), (6, day(2), 'say "hi"')]
    assert rows(bad) == sorted(
        [
            ("x,2026-13-01,c", "id", "not a int"),
            ("x,2026-13-01,c", "day", "not a date"),
            ("3,,", "note", "missing"),
            ("4,2026-01-02", None, "wrong number of fields"),
            ("5,2026-01-02,d,e", None, "wrong number of fields"),
        ],
        key=repr,
    )
    # Every line is in one of the two.
    assert good.count() + bad.select("record").distinct().count() == 6


def test_empty_file_has_neither(spark, tmp_path):
    good, bad = files.scan_csv_checked(spark, write(tmp_path, "e.csv", "id,day\n"), "id int, day date")
    assert good.count() == 0 and bad.count() == 0 and good.columns == ["id", "day"]


@pytest.mark.parametrize(
    "text, delimiter, quote, header, columns",
    [
        ("id;name\n1;a, b\n2;c\n", ";", '"', True, 2),
        ("1\t2.5\tx\n2\t3.5\ty\n", "\t", '"', False, 3),
        ("id|note\n1|'a|b'\n2|'c'\n", "|", "'", True, 2),
        ('1,"a, b",2026-01-01\n2,"c",2026-01-02\n', ",", '"', False, 3),
        ("one\ntwo\n", ",", '"', False, 1),
        ("name,other\na,b\nc,d\n", ",", '"', False, 2),
    ],
)
def test_dialects(spark, tmp_path, text, delimiter, quote, header, columns):
    path = write(tmp_path, "d.txt", text)
    found = files.sniff_csv(spark, path)
    assert found == {"delimiter": delimiter, "quote": quote, "header": header, "columns": columns}
    df = files.scan_sniffed_csv(spark, path)
    assert len(df.columns) == columns and df.count() == len(text.splitlines()) - header


# ------------------------------------------------------------ drift, document


def test_differing_keys(spark, rows):
    left = [(i, None if i % 50 == 0 else i % 7, "v") for i in range(500)] + [(3, 3, "v")]
    right = [r for r in left if r[0] != 11] + [(1000, 1, "new"), (1000, 1, "new")]
    right = [(k, v, "changed" if k == 77 else t) for k, v, t in right]
    make = lambda rows_: spark.createDataFrame(rows_, "k long, v long, t string")
    got = compare_tables.differing_keys(make(left), make(right), ["k"])
    assert rows(got) == [(1000, 0, 2), (11, 1, 0), (77, 1, 1)]
    assert compare_tables.differing_keys(make(left), make(left[::-1]), ["k"], levels=3, bits=4).count() == 0
    assert compare_tables.differing_keys(make([]), make([]), ["k"]).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        compare_tables.differing_keys(make(left), make(left).drop("t"), ["k"])


def test_document_parts_are_one_document(spark, tmp_path, rows):
    df = spark.range(2000).select(F.col("id"), F.concat(F.lit('say "'), "id", F.lit('"\n')).alias("text"), F.lit(None).cast("int").alias("none"))
    sections = {"many": (df, [F.col("id").desc()]), "none": (df.limit(0), [F.col("id")]), "one": (df.where("id = 7"), [F.col("id")])}
    folder = str(tmp_path / "doc")
    files.write_json_document(spark, sections, folder, {"generated_at": "2026-01-01", "live": True})
    parts = files.document_parts(spark, folder)
    whole = json.loads("".join(open(p.removeprefix("file:")).read() for p in parts))
    assert list(whole) == ["generated_at", "live", "many", "none", "one"] and whole["none"] == []
    assert [r["id"] for r in whole["many"]] == list(range(1999, -1, -1))
    assert whole["one"] == [{"id": 7, "text": 'say "7"\n', "none": None}]
    assert rows(files.read_document_section(spark, folder, 1, df.schema)) == rows(df)
