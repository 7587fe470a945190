from datetime import datetime

import pytest
from pyspark.sql import functions as F

from palimpsest.model import EPOCH, OPEN
from palimpsest.operators import extract, maintenance, transitions

LAKE = "__from timestamp_ntz, __to timestamp_ntz, __load timestamp_ntz, __action string, __source smallint, k long, v string"
D1, D2, D3, D4 = (datetime(2024, 1, d) for d in (1, 2, 3, 4))


def lake(spark, rows):
    return spark.createDataFrame(rows, LAKE)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def snap(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def history_is_sound(df):
    """Per key: intervals that don't overlap, and one open row at most."""
    by = {}
    for r in df.collect():
        by.setdefault((r.k, r["__source"]), []).append((r["__from"], r["__to"]))
    for spans in by.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert sum(t == OPEN for _, t in spans) <= 1
        assert all(f <= t for f, t in spans)


def test_baseline_takes_what_is_new_and_treats_nulls_as_equal(spark):
    target = lake(spark, [(D1, OPEN, D1, "I", 0, 1, "a"), (D1, OPEN, D1, "I", 0, 2, None), (D1, D2, D1, "I", 0, 3, "c")])
    got = transitions.baseline_load(target, snap(spark, [(1, "a"), (2, None), (3, "c"), (4, "d")]), D4)
    assert plain(got.inserts) == sorted([(EPOCH, OPEN, D4, "X", 0, 3, "c"), (EPOCH, OPEN, D4, "X", 0, 4, "d")], key=repr)
    assert got.result.count() == 5


def test_duplicate_source_rows_by_count(spark):
    empty = lake(spark, [])
    rows = [(1, "a")] * 2 + [(2, "b")] * 3 + [(3, "c")]
    assert plain(transitions.baseline_load(empty, snap(spark, rows), D1).inserts.select("k")) == [(2,), (3,)]
    assert plain(transitions.baseline_load(empty, snap(spark, rows), D1, dedupe=True).inserts.select("k")) == [(1,), (2,), (3,)]


def test_first_baseline_needs_an_empty_target(spark):
    target = lake(spark, [(D1, OPEN, D1, "I", 0, 1, "a")])
    with pytest.raises(ValueError):
        transitions.baseline_first(target, snap(spark, [(1, "a")]), D1, D2)


def changes(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, __start_lsn long, __seqval long, __operation int")


def times(spark, rows):
    return spark.createDataFrame(rows, "lsn long, __from timestamp_ntz")


def test_cdc_collapses_an_instant_and_closes_open_rows(spark):
    target = lake(spark, [(D1, OPEN, D1, "I", 0, 1, "a"), (D1, OPEN, D1, "I", 0, 2, "b")])
    log = changes(spark, [(1, "x", 10, 1, 4), (1, "y", 10, 2, 4), (1, None, 11, 3, 1), (3, "n", 11, 4, 2), (3, "m", 11, 5, 4), (2, "before", 11, 6, 3)])
    clock = times(spark, [(10, D2), (11, D3)])
    got = transitions.cdc_history(target, log, clock, ["k"], D1, D4)
    assert plain(got.closes) == [(D1, D2, D1, "I", 0, 1, "a")]
    assert plain(got.inserts) == sorted([(D2, D3, D2, "U", 0, 1, "y"), (D3, OPEN, D3, "I", 0, 3, "m")], key=repr)
    assert plain(got.tombstones) == [(D3, OPEN, D3, "D", 0, 1, None)]
    assert got.counts() == {"inserted": 2, "updated": 1, "deleted": 1}
    history_is_sound(got.result)


def test_cdc_maxima_on_different_rows(spark):
    log = changes(spark, [(1, "late lsn", 11, 1, 4), (1, "late seq", 10, 2, 4)])
    clock = times(spark, [(10, D2), (11, D2)])
    assert transitions.cdc_collapse(log, clock, ["k"], D1, D4).count() == 0
    assert [r.v for r in transitions.cdc_collapse(log, clock, ["k"], D1, D4, strict=True).collect()] == ["late seq"]


def test_cdc_without_a_time_raises(spark):
    log = changes(spark, [(1, "a", 10, 1, 2), (1, "b", 11, 2, 4), (1, "c", 12, 3, 4)])
    with pytest.raises(Exception, match="no time for LSN"):
        transitions.cdc_collapse(log, times(spark, [(10, D2), (12, D3)]), ["k"], D1, D4).collect()


def test_cdc_in_two_batches_is_cdc_in_one(spark):
    log = changes(spark, [(k % 5, f"v{k}", k, k, 1 if k % 7 == 0 else 2 if k % 3 == 0 else 4) for k in range(1, 60)])
    clock = times(spark, [(k, datetime(2024, 1, 1 + k // 4)) for k in range(1, 60)])
    one = transitions.cdc_history(lake(spark, []), log, clock, ["k"], EPOCH, OPEN).result
    first = transitions.cdc_history(lake(spark, []), log, clock, ["k"], EPOCH, datetime(2024, 1, 8)).result
    two = transitions.cdc_history(first, log, clock, ["k"], datetime(2024, 1, 8), OPEN).result
    assert plain(one) == plain(two)
    history_is_sound(one)


def test_snapshot_matrix(spark):
    old = [(1, "a", "X"), (2, "b", "I"), (3, "c", "U"), (4, "d", "D"), (5, "e", "D"), (6, "f", "I"), (7, None, "I")]
    target = lake(spark, [(D1, OPEN, D1, act, 0, k, v) for k, v, act in old])
    got = transitions.snapshot_apply(target, snap(spark, [(1, "a"), (2, "B"), (5, "E"), (8, "new"), (7, None)]), ["k"], D2)
    actions = {r.k: r["__action"] for r in got.inserts.collect()}
    assert actions == {2: "U", 5: "I", 8: "I"}
    assert sorted(r.k for r in got.tombstones.collect()) == [3, 6]
    assert sorted(r.k for r in got.closes.collect()) == [2, 3, 5, 6]
    history_is_sound(got.result)
    again = transitions.snapshot_apply(got.result, snap(spark, [(1, "a"), (2, "B"), (5, "E"), (8, "new"), (7, None)]), ["k"], D3)
    assert again.counts() == {"inserted": 0, "updated": 0, "deleted": 0}


def test_deleted_key_returns_with_its_last_values(spark):
    target = lake(spark, [(D1, OPEN, D1, "D", 0, 1, "a")])
    assert transitions.snapshot_apply(target, snap(spark, [(1, "a")]), ["k"], D2).inserts.count() == 0
    got = transitions.snapshot_apply(target, snap(spark, [(1, "a")]), ["k"], D2, strict=True)
    assert plain(got.inserts) == [(D2, OPEN, D2, "I", 0, 1, "a")]
    assert plain(got.closes) == [(D1, D2, D1, "D", 0, 1, "a")]


def test_snapshot_without_an_instant_raises(spark):
    with pytest.raises(ValueError):
        transitions.snapshot_apply(lake(spark, []), snap(spark, [(1, "a")]), ["k"], None)


def test_legacy_zones(spark):
    rows = [(1, "a", datetime(2024, 6, 1, 1), datetime(2024, 7, 1, 1)), (1, "b", datetime(2024, 7, 1, 1), datetime(2024, 12, 1)), (2, "c", datetime(2024, 6, 1, 1), OPEN)]
    old = spark.createDataFrame(rows, "k long, v string, DateFrom timestamp_ntz, DateTo timestamp_ntz")
    got = transitions.legacy_convert(old, ["k"])
    assert plain(got.inserts.select("k", "__from", "__to", "__action")) == sorted([(1, datetime(2024, 6, 1), datetime(2024, 7, 1), "X"), (1, datetime(2024, 7, 1), datetime(2024, 12, 1), "U"), (2, datetime(2024, 6, 1), OPEN, "X")], key=repr)
    assert plain(got.tombstones.select("k", "v", "__from", "__to")) == [(1, "b", datetime(2024, 12, 1), OPEN)]


def test_publishing_net_changes_gives_the_current_view(spark):
    log = changes(spark, [(k % 7, f"v{k}", k, k, 1 if k % 5 == 0 else 2 if k % 3 == 0 else 4) for k in range(1, 80)])
    clock = times(spark, [(k, datetime(2024, 1, 1 + k // 4)) for k in range(1, 80)])
    h = transitions.cdc_collapse(log, clock, ["k"], EPOCH, OPEN)
    a, b = datetime(2024, 1, 6), datetime(2024, 1, 15)
    got = transitions.publish(extract.as_of(h, a).drop("__to"), extract.net_changes(h, ["k"], a, b), ["k"]).result
    want = extract.as_of(h, b)
    assert plain(got.select("k", "v", "__from")) == plain(want.select("k", "v", "__from"))


def test_propagation_follows_its_source(spark):
    log = changes(spark, [(k % 7, f"v{k}", k, k, 1 if k % 5 == 0 else 4) for k in range(1, 80)])
    clock = times(spark, [(k, datetime(2024, 1, 1 + k // 4)) for k in range(1, 80)])
    h = transitions.cdc_collapse(log, clock, ["k"], EPOCH, OPEN)
    copy = lake(spark, [])
    marks = [EPOCH, datetime(2024, 1, 5), datetime(2024, 1, 12), OPEN]
    for a, b in zip(marks, marks[1:]):
        copy = transitions.propagate_history(copy, extract.all_changes(h, a, b), ["k"], a, b).result
    assert plain(copy) == plain(h.select(*copy.columns))


def test_copy_net_deletes_what_ended_without_a_successor(spark):
    rows = [(1, "a", D1, OPEN), (2, "b", D1, D3), (3, "c", D1, D3), (3, "C", D3, OPEN), (4, "d", D3, OPEN)]
    h = spark.createDataFrame(rows, "k long, v string, DateFrom timestamp_ntz, DateTo timestamp_ntz")
    target = snap(spark, [(1, "a"), (2, "b"), (3, "c")])
    got = transitions.copy_net(target, h, ["k"], D2, D4)
    assert plain(got.result) == [(1, "a"), (3, "C"), (4, "d")]
    assert got.counts() == {"inserted": 1, "updated": 1, "deleted": 1}


def test_rollback_and_sequences(spark):
    h = lake(spark, [(D1, D2, D1, "I", 0, 1, "a"), (D2, OPEN, D2, "U", 0, 1, "b"), (D1, D3, D1, "I", 0, 2, "c")])
    back = maintenance.rollback(h, D1, "__from", "__to")
    assert plain(back.result.select("k", "__to")) == [(1, OPEN), (2, OPEN)]
    assert back.counts() == {"inserted": 0, "updated": 2, "deleted": 1}
    wrong = lake(spark, [(D3, OPEN, D1, "I", 0, 1, "a"), (D2, D3, D2, "U", 0, 1, "b"), (D3, OPEN, D1, "I", 0, 2, "z")])
    assert maintenance.out_of_sequence(wrong, ["k"]).count() == 1
    fixed = maintenance.fix_sequence(wrong, ["k"])
    assert maintenance.out_of_sequence(fixed, ["k"]).count() == 0
    assert plain(fixed.where(F.col("k") == 2)) == [(D3, OPEN, D1, "I", 0, 2, "z")]


def test_empty_tables(spark):
    empty = lake(spark, [])
    assert transitions.snapshot_apply(empty, snap(spark, []), ["k"], D1).result.count() == 0
    assert transitions.cdc_history(empty, changes(spark, []), times(spark, []), ["k"], EPOCH, OPEN).result.count() == 0
    assert extract.net_changes(empty, ["k"], EPOCH, OPEN).count() == 0
