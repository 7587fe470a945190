from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions import scalar
from palimpsest.model import EPOCH, OPEN, ticks
from palimpsest.operators import control, extract, layout, maintenance, metadata, schema_sync, timemap, transitions
from palimpsest.plans import matching
from palimpsest.plans.engine import REGISTRY, Engine, Template, actions, register
from palimpsest.sources import dialect
from palimpsest.sources.store import Store
from palimpsest.streaming.cdc import merge_stream


def test_ticks_order_changes_of_one_commit(spark):
    at = datetime(2024, 7, 1, 12, 0, 0, 123000)
    rows = spark.createDataFrame([(3, at), (1, at), (2, at)], "lsn long, tran_end_time timestamp_ntz")
    got = {r.lsn: r["__from"] for r in timemap.rank_map(rows).collect()}
    base = ticks(at - timedelta(hours=1))
    assert got == {1: base + 1, 2: base + 2, 3: base + 3}


def test_numbering_by_blocks(spark):
    rows = spark.range(0, 5000, 7).withColumnRenamed("id", "lsn")
    got = [r["__n"] for r in timemap.numbered(rows, bits=6).orderBy("lsn").collect()]
    assert got == list(range(1, len(got) + 1))


def test_overlap_hour(spark):
    assert timemap.backed_off(datetime(2024, 10, 27, 0, 30)) == datetime(2024, 10, 26, 23, 30)
    assert timemap.backed_off(datetime(2024, 10, 20, 0, 30)) == datetime(2024, 10, 20, 0, 30)
    # The first pass through the hour that clocks repeat.
    local = spark.createDataFrame([(datetime(2024, 10, 27, 1, 30),), (datetime(2024, 3, 31, 1, 30),)], "t timestamp_ntz")
    got = [r[0] for r in local.select(timemap.utc_ticks(F.col("t"))).collect()]
    assert got == [ticks(datetime(2024, 10, 27, 0, 30)), ticks(datetime(2024, 3, 31, 1, 30))]


def test_overlap_known_before(spark):
    t = lambda h, m: ticks(datetime(2024, 10, 27, h, m))
    rows = spark.createDataFrame([(3, t(0, 10)), (4, t(0, 20))], "lsn long, __from long")
    known = spark.createDataFrame([(1, t(0, 5)), (2, t(0, 50))], "lsn long, __from long")
    assert {r.lsn: r["__from"] for r in timemap.repair_overlap(rows, known).collect()} == {3: t(1, 10), 4: t(1, 20)}


def test_scalar_functions(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31, 23, 59, 59, 999000), datetime(2024, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(*[scalar.date_diff(u, "a", "b").alias(u) for u in ("millisecond", "second", "minute", "hour", "day", "month", "year")]).first()
    assert tuple(got) == (1, 1, 1, 1, 1, 1, 0)
    words = spark.createDataFrame([("orders_202401",), ("ordersX202401",), ("orders_209901",), (" ",)], "s string")
    like = scalar.like_pattern(r"orders\_20[0-2][0-9][0-1][0-9]", escape="\\")
    assert [r[0] for r in words.select(F.col("s").rlike(like)).collect()] == [True, False, False, False]
    assert words.select(scalar.to_smallint(F.lit("")), scalar.to_smallint(F.lit("2401")), scalar.length(F.lit("ab  "))).first() == (0, 2401, 2)
    assert scalar.quoted("a]b") == "[a]]b]"


@pytest.mark.parametrize(
    ("name", "columns", "key", "schema", "form"),
    [
        ("__$Complete", ["x"], False, "s", "CTL"), ("lsn_time_mapping", ["x"], True, "s", "XXX"), ("t", ["__$start_lsn"], True, "s", "CDC"), ("t", ["__$From", "__$To"], True, "s", "LAK"),
        ("t", ["__$From", "__$To"], False, "s", "PUB"), ("t", ["__$From"], True, "s", "PUB"), ("t", ["DateFrom", "DateTo"], True, "s", "OLD"), ("t", ["DateFrom", "DateTo"], True, "dbo", "NON"), ("t", ["x"], True, "s", "NON"),
    ],
)
def test_forms(name, columns, key, schema, form):
    assert metadata.form_of(name, columns, key, schema) == form


def test_marks():
    assert metadata.snapshot_mark(datetime(2024, 1, 1), datetime(2024, 2, 1), "__to") == datetime(1900, 1, 1)
    assert metadata.snapshot_mark(datetime(2024, 1, 1), datetime(2024, 2, 1), None) == datetime(2024, 1, 1)
    assert maintenance.retention_date(datetime(2024, 1, 31, 5), 10) == date(2024, 1, 20)
    assert maintenance.retention_date(datetime(2024, 1, 31, 5), 10, date(2024, 1, 2)) == date(2024, 1, 2)
    a, b = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert matching.complete_date(b, a, None) == b and matching.complete_date(b, a, datetime(2024, 1, 5)) == datetime(2024, 1, 5) and matching.complete_date(a, b, None) == b
    assert matching.batch_suffix(True, a, b, b, a) == " (Dry Run)" and matching.batch_suffix(False, b, a, b, a) == " (Waiting)"
    assert matching.batch_suffix(False, a, b, a, a) == " (Incomplete)" and matching.batch_suffix(False, a, b, b, a) == ""


def test_schema_plans(spark):
    source = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType()), T.StructField("new", T.IntegerType())])
    plan = schema_sync.plan_table("t", "LAK", source, None, ["id"])
    assert plan.status == "A" and [f.name for f in plan.schema][:5] == ["__from", "__to", "__load", "__action", "__source"] and plan.warning is None
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.IntegerType())])
    plan = schema_sync.plan_table("t", "NON", source, target, [])
    assert plan.status == "M" and plan.added == ["new"] and plan.widened == ["x"] and plan.warning
    assert schema_sync.choose_key(["a"], ["b"]) == ["a"] and schema_sync.choose_key(["a"], ["b"], True) == ["b"] and schema_sync.choose_key([], ["b"]) == ["b"]
    old = spark.createDataFrame([(1, 2)], "id long, x int")
    assert schema_sync.evolve(old, plan.schema).columns == ["id", "x", "new"]
    assert schema_sync.new_type("ntext") == "nvarchar(max)"


def test_dialects():
    p = dialect.Path("or]ders", "dbo", "shop", "SQLServer")
    assert p.name() == "[shop].[dbo].[or]]ders]"
    assert p.query(["id"], "PUB", "id > 1") == "SELECT [__$From], [__$Load], [__$Action], [__$Source], [id] FROM [shop].[dbo].[or]]ders] WHERE id > 1"
    assert dialect.Path("t", "s", "d", "Oracle").name() == '"s"."t"' and dialect.Path("t", None, "d", "MySQL").name() == "`d`.`t`"
    assert dialect.system_of("jdbc:oracle:thin:@x") == "Oracle" and dialect.remote_options("jdbc:mysql://x", "SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError):
        dialect.system_of("odbc:x")


def test_store_versions(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.create("t", T.StructType([T.StructField("k", T.LongType())]), key=["k"])
    assert store.read("t").count() == 0 and store.tables() == ["t"]
    store.commit("t", spark.range(3).withColumnRenamed("id", "k"), batch="b1")
    store.commit("t", store.read("t").unionByName(spark.range(3, 5).withColumnRenamed("id", "k")), batch="b2")
    assert store.read("t").count() == 5
    assert store.commit("t", spark.range(9).withColumnRenamed("id", "k"), batch="b2")["version"] == 3
    before = store.manifest("t")
    with pytest.raises(Exception):
        store.commit("t", store.read("t").select(F.raise_error(F.lit("no")).cast("long").alias("k")))
    assert store.manifest("t") == before and store.read("t").count() == 5
    assert store.vacuum("t") >= 1 and store.read("t").count() == 5
    assert not maintenance.safe_drop(store, "t")
    store.commit("t", store.read("t").limit(0))
    assert maintenance.safe_drop(store, "t") and not store.exists("t")


def test_engine_runs_snapshots_and_publishes(spark, tmp_path):
    source, lake, shop = (Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "lake", "shop"))
    rows = lambda *r: spark.createDataFrame(list(r), "id long, v string")
    source.commit("t", rows((1, "a"), (2, "b")), key=["id"], form="NON")
    source.commit("nokey", rows((1, "a")), form="NON")
    engine, d1, d2 = Engine(source, lake), datetime(2024, 1, 1), datetime(2024, 1, 2)
    run = engine.transfer("NON-LAK", d1)
    assert {o.table: o.outcome for o in run.outcomes} == {"t": "Success", "nokey": "Failure"} and "no key" in run.failed[0].error
    assert not lake.exists("__complete")
    source.drop("nokey")
    assert [o.outcome for o in engine.transfer("NON-LAK", d1).outcomes] == ["Pass"]
    source.commit("t", rows((1, "A"), (3, "c")))
    assert engine.transfer("NON-LAK", d2, dry_run=True).outcomes[0].outcome == "Pass" and lake.read("t").count() == 2
    out = engine.transfer("NON-LAK", d2).outcomes[0]
    assert (out.inserted, out.updated, out.deleted) == (2, 2, 1) and engine.complete(lake) == d2
    published = Engine(lake, shop).transfer("LAK-PUB", OPEN, ["t"]).outcomes[0]
    assert published.outcome == "Success", published.error
    assert sorted((r.id, r.v) for r in shop.read("t").collect()) == [(1, "A"), (3, "c")]
    with pytest.raises(ValueError):
        engine.transfer("XXX", d2)
    assert len(REGISTRY) == 8


def test_engine_keeps_a_log_and_schemas_and_prunes(spark, tmp_path):
    source, lake = (Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "lake"))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    source.commit("t", rows, key=["id"], form="NON")
    engine, days = Engine(source, lake), [datetime(2024, 1, d) for d in (1, 2, 3)]
    assert [p.status for p in engine.sync_schemas("LAK", dry_run=True)] == ["A"] and not lake.exists("t")
    assert [p.status for p in engine.sync_schemas("LAK")] == ["A"] and [p.status for p in engine.sync_schemas("LAK")] == ["="]
    engine.transfer("NON-LAK", days[0])
    source.commit("t", rows.withColumn("w", F.lit(1)).where("id = 1"))
    assert engine.sync_schemas("LAK")[0].added == ["w"] and lake.read("t").where("w IS NULL").count() == 2
    engine.transfer("NON-LAK", days[1])
    source.commit("t", spark.createDataFrame([("1",)], "wrong string"), key=["wrong"])
    assert engine.transfer("NON-LAK", days[2]).failed
    summary = {r.Batch: r for r in control.run_summary(engine.log()).collect()}
    assert len(summary) == 3 and [r.Failed for r in summary.values()].count(1) == 1 and sum(r.Inserted for r in summary.values()) == 3
    assert control.run_latest(engine.log(), batches=1).count() == 1
    before = lake.read("t").count()
    assert engine.rewind("t", days[0]) == {"deleted": 2, "updated": 2} and lake.read("t").count() == before - 2
    assert engine.prune("t", 0, dry_run=True) == date(2024, 1, 1) and "RetentionDate" not in lake.manifest("t")
    assert engine.prune("t", 0) == date(2024, 1, 1) and lake.manifest("t")["RetentionDate"] == "2024-01-01" and lake.read("t").count() == 2


def test_actions_of_a_task_run_in_order(spark, tmp_path):
    from palimpsest.model import ChangeSet

    def mark(text):
        def run(target, source, context):
            new = source.select("id", F.concat(F.coalesce(target.select(F.max("v")).scalar(), F.lit("")), F.lit(text)).alias("v"))
            return ChangeSet(target.unionByName(new), new)

        return run

    try:
        register(Template("TST-NON", "NON", "NON", mark("b"), priority=2))
        register(Template("TST-NON", "NON", "NON", mark("a"), priority=1))
        register(Template("TST-NON", "NON", "NON", mark("x"), priority=3, optional=True))
        with pytest.raises(ValueError):
            register(Template("TST-NON", "CDC", "LAK", mark("z")))
        assert len(actions("TST-NON")) == 3 and len(actions("TST-NON", has_key=False)) == 2
        for t in REGISTRY["TST-NON"]:
            t.needs_key = t.optional
        source, target = (Store(spark, f"file://{tmp_path}/{n}") for n in ("s", "t"))
        source.commit("t", spark.createDataFrame([(1, "?")], "id long, v string"))
        out = Engine(source, target).transfer("TST-NON", datetime(2024, 1, 1)).outcomes[0]
        assert out.outcome == "Success", out.error
        assert out.inserted == 2 and sorted(r.v for r in target.read("t").collect()) == ["a", "ab"]
    finally:
        REGISTRY.pop("TST-NON")


def test_engine_maintains_its_time_map(spark, tmp_path):
    lake = Store(spark, f"file://{tmp_path}/lake")
    engine = Engine(lake, lake)
    rows = [(k, datetime(2024, 1, 1, k // 3)) for k in range(1, 30)]
    frame = lambda r: spark.createDataFrame(r, "lsn long, tran_end_time timestamp_ntz")
    assert engine.refresh_times(frame(rows[:20]), datetime(2024, 2, 1)) == {"I": 20}
    first = {r.lsn: tuple(r) for r in lake.read("__time").collect()}
    assert engine.refresh_times(frame(rows[:20]), datetime(2024, 2, 2)) == {}
    # A late commit moves the ranks of its hour's other rows.
    assert engine.refresh_times(frame([*rows[12:], (13, rows[11][1])]), datetime(2024, 2, 3)).keys() >= {"I"}
    got = {r.lsn: tuple(r) for r in lake.read("__time").collect()}
    assert got[1] == first[1] and max(got) == 29


def test_stream_is_the_batch(spark, tmp_path):
    schema = "k long, v string, __start_lsn long, __seqval long, __operation int, ts timestamp_ntz"
    rows = [(k % 4, f"v{k}", k, k, 1 if k % 5 == 0 else 4, datetime(2024, 1, 1 + k // 3)) for k in range(1, 30)]
    for i in range(3):
        spark.createDataFrame(rows[i * 9 : i * 9 + 9], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    store = Store(spark, f"file://{tmp_path}/s")
    lake = "__from timestamp_ntz, __to timestamp_ntz, __load timestamp_ntz, __action string, __source smallint, k long, v string"
    store.create("t", spark.createDataFrame([], lake).schema, ["k"], form="LAK")
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(f"{tmp_path}/log")
    merge_stream(log, store, "t", ["k"], f"file://{tmp_path}/cp").awaitTermination()
    first = store.read("t").count()
    merge_stream(log, store, "t", ["k"], f"file://{tmp_path}/cp").awaitTermination()
    assert first == store.read("t").count() > 0
    assert store.read("t").where(F.col("__to") == F.lit(OPEN)).count() == 4


def test_a_batch_rewrites_open_rows_and_the_months_it_closes_in(spark, tmp_path):
    source, lake = (Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "lake"))
    engine, rows = Engine(source, lake), lambda *r: spark.createDataFrame(list(r), "id long, v string")
    days = [datetime(2024, 1, 5), datetime(2024, 2, 5), datetime(2024, 3, 5), datetime(2024, 3, 6)]
    manifests = []
    for k, at in enumerate(days):
        source.commit("t", rows((1, f"a{k}"), (2, "b"), (10 + k, "new")), key=["id"], form="NON")
        out = engine.transfer("NON-LAK", at).outcomes[0]
        assert out.outcome == "Success", out.error
        assert (out.inserted, out.updated, out.deleted) == ((3, 0, 0) if not k else (2, 2, 1))
        manifests.append(lake.manifest("t")["parts"])
    assert sorted(manifests[-1]) == ["2024-02", "2024-03", "open"] and [len(manifests[-1][p]) for p in sorted(manifests[-1])] == [1, 2, 1]
    assert manifests[1]["2024-02"] == manifests[3]["2024-02"] and manifests[2]["2024-03"][0] == manifests[3]["2024-03"][0]
    assert lake.read("t").count() == 3 + 3 * 3 and lake.read("t", ["open"]).count() == 6
    keep = lake.read("t").count()
    lake.vacuum("t")
    assert lake.read("t").count() == keep
    before = lake.manifest("t")["parts"]
    assert engine.rewind("t", datetime(2024, 3, 5)) == {"deleted": 3, "updated": 2} and lake.manifest("t")["parts"]["2024-02"] == before["2024-02"]
    # Retention takes whole months from the manifest.
    assert engine.prune("t", 0, date(2024, 3, 1)) == date(2024, 3, 1) and lake.parts("t") == ["2024-03", "open"]
    assert lake.read("__complete").first().RetentionDate == datetime(2024, 3, 1)


def test_a_batch_over_pieces_and_a_lagging_log(spark, tmp_path):
    """Monthly pieces are sources of one history; a log is read no further than a second behind the clock; retention bounds extraction."""
    source, lake, shop = (Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "lake", "shop"))
    lsns = [(k, datetime(2024, 1, 1, 0, 0, k)) for k in range(1, 31)]
    times = spark.createDataFrame(lsns, "lsn long, __from timestamp_ntz")
    log = lambda low, high: spark.createDataFrame([(k % 3, f"v{k}", "x", k, k, 2 if k < low + 3 else 4) for k in range(low, high)], "k long, v string, more string, __start_lsn long, __seqval long, __operation int")
    lake.create("t", spark.createDataFrame([], "__from timestamp_ntz, __to timestamp_ntz, __load timestamp_ntz, __action string, __source smallint, k long, v string").schema, ["k"], form="LAK")
    source.commit("t_202401", log(1, 11), key=["k"], form="CDC")
    source.commit("t_202402", log(11, 31), key=["k"], form="CDC")
    engine = Engine(source, lake)
    assert engine.pairs() == {"t": [("t_202401", 2401), ("t_202402", 2402)]}
    run = engine.transfer("CDC-LAK", datetime(2024, 1, 2), times=times, now=datetime(2024, 1, 1, 0, 0, 21))
    assert [(o.outcome, o.inserted, o.updated, o.deleted, o.left_out) for o in run.outcomes] == [("Success", 10, 0, 0, ["more"])] * 2, run.outcomes
    got = lake.read("t")
    assert {r[0]: r[1] for r in got.groupBy("__source").count().collect()} == {2401: 10, 2402: 10} and got.where("__to >= TIMESTAMP_NTZ '9999-01-01'").count() == 6
    # The rest of the log comes with a later clock; the first piece has nothing new.
    run = engine.transfer("CDC-LAK", datetime(2024, 1, 2), times=times, now=datetime(2024, 1, 1, 1))
    assert [(o.outcome, o.inserted, o.updated) for o in run.outcomes] == [("Pass", 0, 0), ("Success", 10, 3)]
    want = extract.current(transitions.cdc_history(spark.createDataFrame([], got.schema), log(11, 31), times, ["k"], EPOCH, OPEN, 2402).result)
    both = [sorted(tuple(r) for r in x.collect()) for x in (extract.current(lake.read("t")).where("__source = 2402"), want)]
    assert both[0] == both[1] and len(both[0]) == 3
    assert engine.complete(lake) == datetime(2024, 1, 1, 0, 0, 30)
    lists = engine.columns()
    assert lists.columns[0] == "TableName"
    # A history that was pruned says so, and the window's rows up to that date aren't taken.
    lake.amend("t", lake.read("t", []), [], RetentionDate="2024-01-01")
    out = Engine(lake, shop).transfer("LAK-PUB", OPEN, ["t"]).outcomes[0]
    assert out.outcome == "Success" and shop.read("t").count() == 6, out.error


def test_snapshots_wait_for_a_bound_behind_a_layout_change(spark, tmp_path):
    source, lake = (Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "lake"))
    source.commit("t", spark.createDataFrame([(1, "a")], "id long, v string"), key=["id"], form="NON")
    engine = Engine(source, lake)
    engine.transfer("NON-LAK", datetime(2024, 1, 1))
    source.commit("t", spark.createDataFrame([(1, "b", 2)], "id long, v string, w int"))
    engine.sync_schemas("LAK", at=datetime(2024, 1, 10))
    assert engine.transfer("NON-LAK", datetime(2024, 1, 5)).outcomes[0].outcome == "Pass"
    assert engine.transfer("NON-LAK", datetime(2024, 1, 11)).outcomes[0].inserted == 1


def test_late_changes_of_a_stream_are_kept_aside(spark, tmp_path):
    schema = "k long, v string, __start_lsn long, __seqval long, __operation int, ts timestamp_ntz"
    store = Store(spark, f"file://{tmp_path}/s")
    store.create("t", spark.createDataFrame([], "__from timestamp_ntz, __to timestamp_ntz, __load timestamp_ntz, __action string, __source smallint, k long, v string").schema, ["k"], form="LAK")
    (tmp_path / "log").mkdir()
    log = spark.readStream.schema(schema).parquet(f"{tmp_path}/log")
    for rows in ([(1, "a", 10, 10, 2, datetime(2024, 1, 10)), (2, "b", 11, 11, 2, datetime(2024, 1, 11))], [(1, "old", 5, 5, 4, datetime(2024, 1, 5)), (2, "c", 12, 12, 4, datetime(2024, 1, 12))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        merge_stream(log, store, "t", ["k"], f"file://{tmp_path}/cp").awaitTermination()
    got = store.read("t")
    assert got.where("__to <= __from").count() == 0 and {r.v for r in extract.current(got).collect()} == {"a", "c"}
    assert [r.v for r in store.read("__late_t").collect()] == ["old"]


def test_an_open_last_scn_range(spark):
    ranges = spark.createDataFrame([(datetime(2024, 1, 1), 1, 99), (datetime(2024, 1, 2), 100, 1 << 48)], "scn_dt timestamp_ntz, min_scn long, max_scn long")
    log = spark.createDataFrame([(5,), (150,), (70_000,)], "lsn long")
    assert {(r.lsn, r.min_scn, r.max_scn) for r in timemap.scn_map(log, ranges).collect()} == {(5, 1, 99), (150, 100, 1 << 48), (70_000, 100, 1 << 48)}
    assert timemap.scn_map(log.limit(0), ranges).count() == 0


def test_boundaries_by_day(spark):
    values = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 3),)], "value timestamp_ntz")
    assert layout.grain(values).first()[0] == "D"
    got = {(r.Boundary, r.Action) for r in layout.boundaries(values, "D", high=datetime(2024, 1, 4)).collect()}
    assert got == {(datetime(2024, 1, 5), "Insert"), (OPEN, "Insert"), (layout.LAST, "Insert")}
