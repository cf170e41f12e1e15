from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from straitflow.operators.clean import with_event_date
from straitflow.plans import jobs
from straitflow.config import FeatureSettings
from straitflow.session import scratch_path, scratch_root
from straitflow.sources import catalog, events, market, sample
from straitflow.sources.schemas import EVENT_SCHEMA

FIELDS = [field.split()[0] for field in EVENT_SCHEMA.split(",")]


def line(values, count=58):
    fields = [""] * count
    for name, value in values.items():
        fields[FIELDS.index(name)] = str(value)
    return "\t".join(fields)


def test_schema_has_58_fields(spark):
    assert [f.name for f in T.StructType.fromDDL(EVENT_SCHEMA).fields] == FIELDS
    assert len(FIELDS) == 58
    assert FIELDS[26:30] == ["EventCode", "EventBaseCode", "EventRootCode", "QuadClass"]
    assert (FIELDS[53], FIELDS[54], FIELDS[57]) == ("ActionGeo_Lat", "ActionGeo_Long", "SOURCEURL")


def test_stray_quotes_and_ragged_lines(spark, tmp_path):
    good = {"GLOBALEVENTID": 1, "SQLDATE": 20240105, "Actor1Name": '"IRAN', "SOURCEURL": "u1"}
    lines = [
        line(good),
        line({**good, "GLOBALEVENTID": 2, "Actor1Name": 'A "B" C', "SOURCEURL": "u2"}),
        "3\t20240106",
        line({**good, "GLOBALEVENTID": 4, "SOURCEURL": "u4"}) + "\textra",
        line({**good, "GLOBALEVENTID": "x", "SOURCEURL": "u5"}),
    ]
    (tmp_path / "20240105.export.CSV").write_text("\n".join(lines) + "\n")
    df = events.scan_events(spark, f"{tmp_path}/*.CSV", lineage=True)
    rows = {r.SOURCEURL: r for r in df.collect()}
    assert rows["u1"].Actor1Name == '"IRAN' and rows["u2"].Actor1Name == 'A "B" C'
    assert rows[None].GLOBALEVENTID == 3 and rows[None].SQLDATE == 20240106
    assert rows["u4"].GLOBALEVENTID == 4 and rows["u5"].GLOBALEVENTID is None
    assert {r.file_name for r in rows.values()} == {"20240105.export.CSV"}


def test_repeated_close_headers(spark, tmp_path):
    text = (
        "date,close,commodity,symbol,close,close\n"
        ",CL=F,,,ZW=F,GC=F\n"
        "2024-01-02,70.5,crude_oil,CL=F,,\n"
        "2024-01-03,,wheat,ZW=F,610.25,\n"
        "bad,,gold,GC=F,,2050\n"
    )
    (tmp_path / "p.csv").write_text(text)
    wide = market.scan_wide_prices(spark, str(tmp_path / "p.csv"))
    assert "close1" in wide.columns
    rows = market.normalise_prices(market.coalesce_close(wide))
    got = {r.commodity: (r.price_date, r.close) for r in rows.filter("commodity is not null").collect()}
    assert got == {
        "crude_oil": (date(2024, 1, 2), 70.5),
        "wheat": (date(2024, 1, 3), 610.25),
        "gold": (None, 2050.0),
    }


def test_macro_file_with_dots_and_padded_header(spark, tmp_path):
    lines = [" Date ,DGS10 ", "2024-01-02,4.5", "2024-01-03,.", " 2024-01-04 , 4.25 ", "n/a,1"]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    got = [tuple(r) for r in market.scan_series(spark, str(tmp_path / "m.csv"), "treasury_10y").collect()]
    assert got == [
        (date(2024, 1, 2), 4.5),
        (date(2024, 1, 3), None),
        (date(2024, 1, 4), 4.25),
        (None, 1.0),
    ]


def test_reports_of_one_day_merge_or_fail(spark):
    rows = [("2024-01-02", 1.5, "a"), ("2024-01-02", 1.5, "a"), ("2024-01-02", None, "a"), ("n/a", 2.0, "a")]
    df = spark.createDataFrame(rows, "date string, close double, commodity string")
    assert sorted(map(tuple, market.normalise_prices(df).collect()), key=repr) == [
        (None, "a", 2.0),
        (date(2024, 1, 2), "a", 1.5),
    ] or {tuple(r) for r in market.normalise_prices(df).collect()} == {
        (None, "a", 2.0),
        (date(2024, 1, 2), "a", 1.5),
    }
    clash = df.unionByName(spark.createDataFrame([("2024-01-02", 9.0, "a")], df.schema))
    with pytest.raises(Exception, match="different values of close"):
        market.normalise_prices(clash).collect()


def test_union_skips_no_row_and_fills_missing_columns(spark):
    a = spark.createDataFrame([(date(2024, 1, 1), 1.0, 7)], "date date, close double, volume int")
    b = spark.createDataFrame([(date(2024, 1, 1), 2.0)], "date date, close double")
    out = market.union_prices({"CL=F": a, "GC=F": b}, {"CL=F": "crude_oil", "GC=F": "gold"})
    assert {(r.commodity, r.volume) for r in out.collect()} == {("crude_oil", 7), ("gold", None)}


def store_rows(spark, n, month, start=0):
    return spark.range(start, start + n).select(
        *[
            {
                "GLOBALEVENTID": F.col("id"),
                "SQLDATE": F.lit(20240000 + month * 100 + 1) + F.col("id") % 28,
                "NumMentions": F.lit(1),
                "EventRootCode": F.lit("19"),
                "ActionGeo_Lat": F.lit(26.0),
                "ActionGeo_Long": F.lit(56.0),
            }
            .get(f.name, F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in T.StructType.fromDDL(EVENT_SCHEMA).fields
        ]
    )


def by_month(spark, path):
    return {(r.year, r.month): r["count"] for r in spark.read.parquet(path).groupBy("year", "month").count().collect()}


def test_rerun_of_a_delivery_keeps_other_months_and_deliveries(spark, tmp_path):
    path = str(tmp_path / "store")
    events.write_event_store(store_rows(spark, 100, 1).unionByName(store_rows(spark, 50, 2)), path)
    events.write_event_store(store_rows(spark, 70, 2), path)
    assert by_month(spark, path) == {(2024, 1): 100, (2024, 2): 70}
    events.write_event_store(store_rows(spark, 1, 1), path, delivery="late row")
    assert by_month(spark, path) == {(2024, 1): 101, (2024, 2): 70}
    events.write_event_store(store_rows(spark, 5, 3), path, rebuild=True)
    assert by_month(spark, path) == {(2024, 3): 5}


def test_undated_rows_stay_apart(spark, tmp_path):
    path = str(tmp_path / "store")
    undated = store_rows(spark, 9, 1).withColumn("SQLDATE", F.lit(None).cast("int"))
    events.write_event_store(store_rows(spark, 20, 1).unionByName(undated), path, delivery="a")
    events.write_event_store(store_rows(spark, 30, 2).unionByName(undated.limit(1)), path, delivery="b")
    assert by_month(spark, path) == {(2024, 1): 20, (2024, 2): 30, (0, 0): 10}
    assert events.read_event_store(spark, path, start=date(2000, 1, 1)).count() == 50


@pytest.mark.parametrize("first", ["batch", "stream"])
def test_batch_and_incremental_loads_share_a_store(spark, tmp_path, first):
    store, landing = str(tmp_path / "store"), tmp_path / "landing"
    landing.mkdir()
    for day in range(1, 6):
        text = line({"GLOBALEVENTID": day, "SQLDATE": 20240100 + day}) + "\n"
        (landing / f"2024010{day}.export.CSV").write_text(text)
    loads = {
        "batch": lambda: events.write_event_store(store_rows(spark, 40, 1, 100), store, delivery="x"),
        "stream": lambda: events.append_new_files(spark, str(landing), store, str(tmp_path / "cp"), files_per_batch=2),
    }
    for name in (first, *(set(loads) - {first}), "stream", "batch"):
        loads[name]()
    assert by_month(spark, store) == {(2024, 1): 45}


def test_store_without_rebalancing_holds_the_same_rows(spark, tmp_path):
    rows = store_rows(spark, 500, 1).unionByName(store_rows(spark, 300, 2))
    stores = []
    for flag in (True, False):
        path = str(tmp_path / str(flag))
        events.write_event_store(rows, path, rebalance=flag)
        stores.append(sorted(map(repr, spark.read.parquet(path).collect())))
    assert stores[0] == stores[1] and len(stores[0]) == 800


def test_stored_rows_are_sorted_by_day_and_code_under_one_key(spark, tmp_path):
    """Many keys would have wide rows compared with one another; one number has them sorted by its digits."""
    path = str(tmp_path / "store")
    seen = []
    codes = F.element_at(F.array(*[F.lit(c) for c in ("19", "01", "", "2", "1\u00e9")], F.lit(None).cast("string")), F.pmod(F.hash("GLOBALEVENTID"), F.lit(6)) + 1)
    rows = store_rows(spark, 400, 1).unionByName(store_rows(spark, 300, 2)).withColumn("EventRootCode", codes)
    day = F.when(F.col("GLOBALEVENTID") % 50 != 0, F.lit(20240101) + F.pmod(F.hash("GLOBALEVENTID", F.lit(1)), F.lit(28)))
    rows = rows.withColumn("SQLDATE", day.cast("int"))
    events.write_event_store(rows, path)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    store = spark.read.parquet(path)
    assert store.count() == 700 and store.where("year = 0").count() == rows.where("SQLDATE IS NULL").count()
    for file in store.inputFiles():
        seen.append([(str(r.event_date or ""), r.EventRootCode or "") for r in spark.read.parquet(file).collect()])
    assert all(s == sorted(s) for s in seen) and max(len(s) for s in seen) > 100
    wide = rows.withColumn("event_date", F.to_date(F.col("SQLDATE").cast("string"), "yyyyMMdd"))
    assert wide.select(events._day_and_code().alias("key")).dtypes == [("key", "bigint")]


def test_one_hot_month_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "store")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        events.write_event_store(store_rows(spark, 200_000, 1).repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "store" / "year=2024" / "month=1").glob("*/*.parquet"))) > 1


def test_date_range_prunes_months(spark, tmp_path):
    path = str(tmp_path / "store")
    for month in (1, 2, 3):
        events.write_event_store(store_rows(spark, 28, month), path)
    df = events.read_event_store(spark, path, date(2024, 2, 10), date(2024, 3, 5))
    assert df.count() == 19 + 5
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [((year" in plan
    assert "PushedFilters: [IsNotNull(event_date), GreaterThanOrEqual(event_date" in plan


def test_intake_loads_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    run = lambda: events.append_new_files(
        spark, str(landing), str(tmp_path / "store"), str(tmp_path / "checkpoint")
    )
    (landing / "20240101.export.CSV").write_text(line({"GLOBALEVENTID": 1, "SQLDATE": 20240101}) + "\n")
    run()
    run()
    (landing / "20240102.export.CSV").write_text(line({"GLOBALEVENTID": 2, "SQLDATE": 20240102}) + "\n")
    listing = spark.createDataFrame([(f"2024010{i}.export.CSV",) for i in (1, 2)], "file_name string")
    missing = events.files_not_loaded(listing, spark.read.parquet(str(tmp_path / "store")))
    assert [r.file_name for r in missing.collect()] == ["20240102.export.CSV"]
    run()
    store = spark.read.parquet(str(tmp_path / "store"))
    assert sorted(r.GLOBALEVENTID for r in store.collect()) == [1, 2]


def test_catalog_table_and_archive(spark, tmp_path):
    path, archive = str(tmp_path / "store"), str(tmp_path / "archive")
    for month, n in ((1, 30), (2, 20), (3, 10)):
        events.write_event_store(store_rows(spark, n, month), path)
    table = catalog.create_event_table(spark, "stored_events", path)
    assert table.filter("month = 2").count() == 20
    spark.sql("DROP TABLE stored_events")
    catalog.archive_before(spark, path, archive, date(2024, 3, 1))
    assert spark.read.parquet(archive).count() == 50
    assert spark.read.parquet(path).count() == 60
    with pytest.raises(ValueError, match="first"):
        catalog.archive_before(spark, path, archive, date(2024, 3, 2))
    assert catalog.retire_before(spark, path, archive, date(2024, 3, 1)) == [(2024, 1), (2024, 2)]
    assert spark.read.parquet(archive).count() == 50
    assert by_month(spark, path) == {(2024, 3): 10}
    assert catalog.retire_before(spark, path, archive, date(2024, 3, 1)) == []
    assert spark.read.parquet(archive).count() == 50


def test_scratch_is_the_configured_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root)


@pytest.mark.skipif(not __import__("pathlib").Path("/root/testdata/sf0.001").exists(), reason="no tables")
def test_jobs_from_files_to_features(spark, tmp_path):
    """Raw files, a price file with repeated headers and a macro file, end to end."""
    d = "/root/testdata/sf0.001"
    rows = sample.as_event_rows(sample.table(spark, d, "lineitem"))
    rows.write.option("sep", "\t").option("quote", "").option("emptyValue", "").csv(str(tmp_path / "raw"))
    prices = sample.sample_prices(spark, d).filter(F.col("commodity").startswith("1"))
    lines = [f"{r.date},{r.close!r},crude_oil,CL=F," for r in prices.collect()]
    (tmp_path / "prices.csv").write_text("date,close,commodity,symbol,close\n" + "\n".join(lines) + "\n")
    macro = sample.sample_macro(spark, d).withColumn("cpi", F.lit(None).cast("double"))
    market.export_csv(macro, str(tmp_path / "macro"))
    loaded = jobs.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "store"))
    assert loaded == rows.count()
    table = jobs.build_features(
        spark,
        str(tmp_path / "store"),
        str(tmp_path / "prices.csv"),
        str(tmp_path / "macro"),
        str(tmp_path / "features"),
    )
    assert len(table.columns) == 23
    model, scores, importance, matrix = jobs.train(
        spark, table, str(tmp_path / "model"), start=None, trees=(3,), depths=(2,)
    )
    assert importance.count() == 15
    assert {r.split for r in scores.collect()} <= {"validation", "test"}
    assert (tmp_path / "model").exists()
    held_out = sum(r.row_count for r in scores.collect())
    assert sum(r.row_count for r in matrix.collect()) == held_out
    files = [str(tmp_path / x) for x in ("store", "prices.csv", "macro")]
    later = jobs.build_features(spark, *files, str(tmp_path / "later"), start=date(1998, 2, 10))
    assert sorted(map(tuple, later.collect())) == sorted(
        map(tuple, table.filter("event_date >= date '1998-02-10'").collect())
    )
    for months in ((None, date(1998, 3, 31)), (date(1998, 4, 1), None)):
        panel = jobs.build_panel(spark, files[0], str(tmp_path / "panel"), FeatureSettings(), *months)
    from_panel = jobs.build_features(spark, *files, str(tmp_path / "from_panel"), panel=panel)
    assert sorted(map(tuple, from_panel.collect())) == sorted(map(tuple, table.collect()))
    early = jobs.build_features(
        spark,
        str(tmp_path / "store"),
        str(tmp_path / "prices.csv"),
        str(tmp_path / "macro"),
        str(tmp_path / "features2"),
        FeatureSettings(prune_keys=False),
    )
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, table.collect()))
