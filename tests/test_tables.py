"""Upserts, run log, exports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from derrick.operators import relate
from derrick.schema import MODEL_AI, VERSION, VERSION_TYPE
from derrick.session import cut_lineage
from derrick.sinks import export, runs, snapshots, upsert

DAY = dt.date(2020, 1, 1)


def predictions(spark, rows):
    return spark.createDataFrame([(m, "T", d, a, a, a, p, p, p) for m, d, a, p in rows], MODEL_AI)


def test_merge_replaces_whole_rows_and_keeps_the_last(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, t string, v double")
    updates = spark.createDataFrame(
        [(2, "x", 9.0, 1), (2, None, None, 2), (3, "c", 3.0, 1)], "k int, t string, v double, seq int"
    )
    got = relate.merge_latest(base, updates, ["k"], ["seq"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", 1.0), (2, None, None), (3, "c", 3.0)]


def test_merge_fills_columns_the_update_lacks(spark):
    base = spark.createDataFrame([(1, "a", 1.0)], "k int, t string, v double")
    got = relate.merge_latest(base, spark.createDataFrame([(1, "z")], "k int, t string"), ["k"]).collect()
    assert [tuple(r) for r in got] == [(1, "z", None)]


def test_insert_if_absent_keeps_the_first_writer(spark):
    base = spark.createDataFrame([("a", 1)], "k string, seq int")
    new = spark.createDataFrame([("a", 5), ("b", 7), ("b", 6)], "k string, seq int")
    got = relate.insert_if_absent(base, new, ["k"], ["seq"]).collect()
    assert sorted(tuple(r) for r in got) == [("a", 1), ("b", 6)]


def test_semi_match_needs_key_and_hash(spark):
    registry = spark.createDataFrame([("u", "s")], "k string, s string").select("k", F.sha2("s", 256).alias("h"))
    rows = spark.createDataFrame([("u", "s"), ("u", "bad"), ("v", "s")], "k string, secret string")
    assert [r["k"] for r in relate.semi_match(rows, registry, "k", "secret", "h").collect()] == ["u"]


def test_stored_upsert_touches_only_its_partitions(spark, tmp_path):
    home = str(tmp_path)
    jan, feb = dt.date(2020, 1, 5), dt.date(2020, 2, 5)
    rows = spark.createDataFrame([(jan, "w", "f"), (feb, "w", "f")], "DAYTIME date, WELL_BORE_CODE string, FLOW_KIND string")
    upsert.upsert(spark, home, "pwell_data", rows)
    before = snapshots.snapshot(spark, home).tables["pwell_data"]["MONTH=2020-01"]
    late = spark.createDataFrame(
        [(feb, "w", "g", 1), (feb, "w", "h", 2), (feb, "x", "i", 1)],
        "DAYTIME date, WELL_BORE_CODE string, FLOW_KIND string, seq int",
    )
    upsert.upsert(spark, home, "pwell_data", late, ["seq"])
    upsert.upsert(spark, home, "pwell_data", late, ["seq"])  # a replay changes nothing
    got = upsert.read_table(spark, home, "pwell_data").select("DAYTIME", "WELL_BORE_CODE", "FLOW_KIND").collect()
    assert sorted(tuple(r) for r in got) == [(jan, "w", "f"), (feb, "w", "h"), (feb, "x", "i")]
    assert snapshots.snapshot(spark, home).tables["pwell_data"]["MONTH=2020-01"] == before
    assert len(list((tmp_path / "pwell_data").glob("LOAD=*/MONTH=2020-01"))) == 1


def test_nothing_is_published_when_one_table_cannot_be_staged(spark, tmp_path):
    good = spark.createDataFrame([(DAY, "w")], "DAYTIME date, WELL_BORE_CODE string")
    bad = good.withColumn("FLOW_KIND", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        upsert.upsert_together(spark, str(tmp_path), {"objects": good, "pwell_data": bad})
    assert upsert.read_table(spark, str(tmp_path), "objects").count() == 0


def test_staged_rows_are_unseen_until_their_manifest(spark, tmp_path):
    home = str(tmp_path)
    rows = predictions(spark, [("m", DAY, 1.0, 2.0)])
    staged = upsert.stage(spark, home, "model_ai", rows)
    assert upsert.read_table(spark, home, "model_ai").count() == 0
    state = snapshots.publish(spark, home, snapshots.Snapshot(), {s.name: dict.fromkeys(s.partitions, s.load) for s in staged})
    upsert.upsert(spark, home, "model_ai", rows)
    assert upsert.read_table(spark, home, "model_ai").count() == 1
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, home, snapshots.Snapshot(), {})
    assert [n for n in snapshots.numbers(spark, home)] == [state.number, state.number + 1]


def test_run_log(spark, tmp_path):
    home = str(tmp_path)
    run = runs.create_run(spark, f"{home}/runs", "first")
    assert run != runs.create_run(spark, f"{home}/runs", "second")
    assert spark.read.parquet(f"{home}/runs").count() == 2
    rows = predictions(spark, [("m", DAY, 1.0, 2.0), ("m", DAY + dt.timedelta(1), 3.0, 3.0)])
    metric = {r["target"]: r for r in runs.metric_rows(run, rows).collect()}
    assert metric["OIL"]["mae"] == 0.5 and metric["OIL"]["rmse"] == pytest.approx(0.5**0.5)
    assert metric["OIL"]["r2"] == pytest.approx(0.5)
    long = runs.prediction_rows(run, rows, sample_type="test")
    assert long.count() == 6 and long.filter("target = 'GAS' AND y_pred = 3.0").count() == 1
    params = runs.param_rows(spark, run, {"OIL": {"maxDepth": 3, "subsamplingRate": 0.8}, "GAS": {"maxDepth": 5}})
    assert sorted((r["target"], r["param"], r["value"]) for r in params.collect()) == [
        ("GAS", "maxDepth", "5"),
        ("OIL", "maxDepth", "3"),
        ("OIL", "subsamplingRate", "0.8"),
    ]


def test_export_and_landing_refuse_to_overwrite(spark, tmp_path):
    upsert.upsert(spark, str(tmp_path), "model_ai", predictions(spark, [("m", DAY, 1.0, 2.0)]))
    now = dt.datetime(2020, 1, 2, 3, 4, 5)
    path = export.export_predictions(spark, str(tmp_path), str(tmp_path / "out"), now)
    assert path.endswith("ml_predictions_2020-01-02_03-04-05")
    assert spark.read.option("header", True).csv(path).count() == 1
    with pytest.raises(Exception, match="already exists"):
        export.export_predictions(spark, str(tmp_path), str(tmp_path / "out"), now)


def test_several_updates_of_a_key_need_a_sequence(spark):
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1)], "k int, v string, seq int")
    with pytest.raises(Exception, match="need a sequence"):
        relate.merge_latest(base, updates.drop("seq"), ["k"]).collect()
    merged = relate.merge_latest(base, updates, ["k"], ["seq"])
    assert sorted(map(tuple, merged.collect())) == [(1, "c"), (2, "d")]


def wells(spark, rows):
    """day, well, flow kind, oil volume, and the second and line that the row comes from."""
    given = [(*r[:3], None if r[3] is None else float(r[3]), *r[4:]) for r in rows]
    frame = spark.createDataFrame(given, "DAYTIME date, WELL_BORE_CODE string, FLOW_KIND string, BORE_OIL_VOL double, t long, line long")
    time = F.timestamp_seconds("t")
    return frame.withColumn(VERSION, F.struct(time, time, F.concat(F.lit("f"), "t"), F.lit(0), "line").cast(VERSION_TYPE)).drop("t", "line")


def test_a_load_that_breaks_leaves_the_old_state(spark, tmp_path, monkeypatch):
    home = str(tmp_path)
    feb = dt.date(2020, 2, 1)
    both = lambda kind, n: wells(spark, [(DAY, "w", kind, n, 1, 1), (feb, "w", kind, n, 1, 2)])
    upsert.upsert_together(spark, home, {"objects": both("a", 1), "pwell_data": both("a", 1)})
    real, calls = upsert._write, []

    def broken(rows, session, warehouse, name, load):
        calls.append(name)
        if len(calls) == 2:  # one partition of the table gets written, then the load is lost
            real(rows.filter("MONTH = '2020-01'"), session, warehouse, name, load)
            raise OSError("lost")
        return real(rows, session, warehouse, name, load)

    monkeypatch.setattr(upsert, "_write", broken)
    with pytest.raises(OSError, match="lost"):
        upsert.upsert_together(spark, home, {"objects": both("b", 2), "pwell_data": both("b", 2)})
    monkeypatch.setattr(upsert, "_write", real)
    assert calls == ["objects", "pwell_data"] and snapshots.numbers(spark, home) == [1]
    kinds = lambda number=None: {r.FLOW_KIND for r in upsert.read_table(spark, home, "pwell_data", number).collect()}
    assert kinds() == {"a"} and upsert.read_table(spark, home, "objects").count() == 2
    upsert.upsert_together(spark, home, {"objects": both("b", 2), "pwell_data": both("b", 2)})
    assert kinds() == {"b"} and kinds(1) == {"a"}
    assert len(snapshots.expire(spark, home, keep=1)) == 6 and kinds() == {"b"}
    with pytest.raises(ValueError, match="no state 1"):
        kinds(1)


def test_a_load_published_meanwhile_is_merged_with(spark, tmp_path, monkeypatch):
    home = str(tmp_path)
    feb = dt.date(2020, 2, 1)
    upsert.upsert(spark, home, "pwell_data", wells(spark, [(DAY, "w", "a", 1, 1, 1)]))
    real, others = snapshots.publish, []
    for rows in ([(feb, "x", "other", 5, 2, 1)], [(DAY, "x", "other", 7, 2, 1)]):

        def late(session, warehouse, state, changes, rows=rows):
            if rows and rows not in others:
                others.append(rows)
                monkeypatch.setattr(snapshots, "publish", real)
                upsert.upsert(session, warehouse, "pwell_data", wells(session, rows))
                monkeypatch.setattr(snapshots, "publish", late)
            return real(session, warehouse, state, changes)

        monkeypatch.setattr(snapshots, "publish", late)
        upsert.upsert(spark, home, "pwell_data", wells(spark, [(DAY, "w", "b", 2, 3, 1)]))
    monkeypatch.setattr(snapshots, "publish", real)
    got = {(r.DAYTIME, r.WELL_BORE_CODE): r.FLOW_KIND for r in upsert.read_table(spark, home, "pwell_data").collect()}
    assert got == {(DAY, "w"): "b", (feb, "x"): "other", (DAY, "x"): "other"}
    total = {r.DAYTIME: (r.n_rows, float(r.BORE_OIL_VOL)) for r in upsert.read_table(spark, home, "daily_totals").collect()}
    assert total == {DAY: (2, 9.0), feb: (1, 5.0)}


def test_loads_commute_and_totals_follow_them(spark, tmp_path):
    mar = dt.date(2020, 3, 1)
    loads = [
        [(DAY, "w", "old", 1, 10, 1), (DAY, "w", "old", 2, 10, 2), (mar, "w", "old", 3, 10, 3)],
        [(DAY, "w", "mid", 20, 20, 1), (DAY, "x", "mid", 30, 20, 2), (DAY, "y", "mid", None, 20, 3)],
        [(DAY, "w", "new", None, 30, 2), (DAY, "w", "new", 200, 30, 1), (DAY, "y", "new", 7, 30, 3)],
    ]
    want = {(DAY, "w"): ("new", None), (DAY, "x"): ("mid", 30.0), (DAY, "y"): ("new", 7.0), (mar, "w"): ("old", 3.0)}
    for n, order in enumerate([(0, 1, 2), (2, 0, 1, 2)]):
        home = str(tmp_path / str(n))
        for k in order:
            upsert.upsert(spark, home, "pwell_data", wells(spark, loads[k]))
        rows = upsert.read_table(spark, home, "pwell_data").collect()
        assert {(r.DAYTIME, r.WELL_BORE_CODE): (r.FLOW_KIND, r.BORE_OIL_VOL and float(r.BORE_OIL_VOL)) for r in rows} == want
        totals = {r.DAYTIME: (r.n_rows, float(r.BORE_OIL_VOL), r.BORE_OIL_VOL_n, r.BORE_GAS_VOL_n) for r in upsert.read_table(spark, home, "daily_totals").collect()}
        assert totals == {DAY: (3, 37.0, 2, 0), mar: (1, 3.0, 1, 0)}


def test_an_unnamed_folder_is_an_error_on_a_cluster(spark):
    from types import SimpleNamespace

    from derrick.session import shared_folder

    def session(master, named=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda _k, _d=None: named), sparkContext=SimpleNamespace(master=master, applicationId="a"))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
        assert shared_folder(session(master, "hdfs://x/y/")) == "hdfs://x/y"


def test_updates_are_ranked_after_they_are_dealt_and_older_ones_rewrite_nothing(spark, tmp_path, monkeypatch):
    home = str(tmp_path)
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    monkeypatch.setattr(upsert, "cut_lineage", kept)
    upsert.upsert(spark, home, "pwell_data", wells(spark, [(DAY, "w", "new", 1, 20, 1)]))
    # Read from the bottom: a rank below the exchange would sort the wide rows where they are read.
    assert "WindowGroupLimit" not in plans[0][plans[0].rindex("Exchange") :]
    before = snapshots.snapshot(spark, home).tables["pwell_data"]
    upsert.upsert(spark, home, "pwell_data", wells(spark, [(DAY, "w", "old", 2, 10, 1)]))
    assert snapshots.snapshot(spark, home).tables["pwell_data"] == before
    assert [r.FLOW_KIND for r in upsert.read_table(spark, home, "pwell_data").collect()] == ["new"]


def test_lines_are_ranked_before_the_columns_of_a_well_are_derived(spark, tmp_path):
    from derrick.plans import wells as plans

    day = F.lit("2020-01-01").cast("timestamp")
    lines = spark.createDataFrame([(1, None, 5.0), (2, None, 6.0), (3, 7, 7.0), (97, 7, 8.0)], "l_orderkey long, l_suppkey long, l_quantity double")
    rest = {c: F.lit(1.0) for c in ("l_extendedprice", "l_discount", "l_tax")} | {c: F.lit("F") for c in ("l_returnflag", "l_linestatus")}
    lines.withColumns(rest | {"l_partkey": F.lit(1), "l_linenumber": F.lit(1), "l_shipdate": day}).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = plans.production(spark, str(tmp_path))
    assert sorted((r.WELL_BORE_CODE or "", float(r.BORE_OIL_VOL)) for r in found.collect()) == [("", 6.0), ("W-7", 7.0)]
    deal = next(line for line in plans.last_lines(lines.withColumns(rest | {"l_partkey": F.lit(1), "l_linenumber": F.lit(1), "l_shipdate": day}))._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line)
    assert "WELL_BORE_CODE" not in deal and "l_suppkey" in deal
