"""Transitions between kinds of table: T1 to T8. Each gives a ChangeSet and leaves writing to the store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import ACTION, EPOCH, FROM, LOAD, OPEN, SOURCE, TO, WHAT, ChangeSet, business, equal, moment, open_of
from .rowdiff import row_diff


def _like(rows: DataFrame, target: DataFrame) -> DataFrame:
    """rows with the target's columns and types, in its order; columns that rows lack are null."""
    have = set(rows.columns)
    return rows.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema])


def _tagged(rows: DataFrame, *parts: tuple[DataFrame, Column | str], closes: DataFrame | None = None, inserts: DataFrame, tombstones: DataFrame | None = None) -> ChangeSet:
    """rows (with WHAT, or null there) and the parts with what they are, as one change set."""
    if WHAT not in rows.columns:
        rows = rows.withColumn(WHAT, F.lit(None).cast("string"))
    for part, what in parts:
        rows = rows.unionByName(_like(part.withColumn(WHAT, what if isinstance(what, Column) else F.lit(what)), rows))
    return ChangeSet(rows.drop(WHAT), inserts, closes, tombstones, rows)


def _closed(target: DataFrame, ends: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The target with its open rows ended where `ends` (keys, __end) has their key, which WHAT says, and these rows alone.

    One left join; `ends` is the small side, and its runtime size decides whether it is broadcast.
    """
    # New names, as the ends may come from the target itself.
    ends = ends.select(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys], "__end")
    on = target[TO] == open_of(target)
    for k in keys:
        on = on & (target[f"`{k}`"] == ends[f"`__key_{k}`"])
    new = lambda end: [end.alias(c) if c == TO else target[f"`{c}`"] for c in target.columns]
    return target.join(ends, on, "left").select(*new(F.coalesce(ends["__end"], target[TO])), F.when(ends["__end"].isNotNull(), "U").alias(WHAT)), target.join(ends, on).select(*new(ends["__end"]))


def baseline_load(target: DataFrame, source: DataFrame, load: datetime | Column, source_id: int = 0, dedupe: bool = False) -> ChangeSet:
    """Source rows that no open target row equals become baseline rows (action X), valid since EPOCH. Nothing is closed.

    Of equal source rows, two without an old row cancel out, as in a full-row comparison by counts; dedupe=True takes one.
    """
    columns = business(source)
    new = source.withColumn(SOURCE, F.lit(source_id).cast("smallint"))
    new = new.dropDuplicates(columns) if dedupe else new
    old = target.where(F.col(TO) == open_of(target)).select(SOURCE, *columns)
    added = row_diff(old, new.select(SOURCE, *columns), [SOURCE, *columns]).where("n_new > 0")
    kind = target.schema[TO].dataType
    inserts = _like(added.withColumn(FROM, moment(EPOCH, kind)).withColumn(TO, moment(OPEN, kind)).withColumn(LOAD, moment(load, kind)).withColumn(ACTION, F.lit("X")), target)
    return _tagged(target, (inserts, "I"), inserts=inserts)


def baseline_first(target: DataFrame, source: DataFrame, start: datetime | Column, load: datetime | Column) -> ChangeSet:
    """The whole source into an empty target."""
    if not target.isEmpty():
        raise ValueError("the target of a first baseline has rows")
    kind = target.schema[TO].dataType
    inserts = _like(source.withColumn(FROM, moment(start, kind)).withColumn(TO, moment(OPEN, kind)).withColumn(LOAD, moment(load, kind)).withColumn(ACTION, F.lit("X")).withColumn(SOURCE, F.lit(0)), target)
    return ChangeSet(inserts, inserts)


def cdc_collapse(log: DataFrame, times: DataFrame, keys: list[str], begin: datetime | Column, end: datetime | Column, source_id: int = 0, strict: bool = False) -> DataFrame:
    """T3, first half: one row for each key and instant of a change log, with __from, __to and __action.

    log: keys, columns, __start_lsn, __seqval, __operation (1 delete, 2 insert, 4 update; others are ignored).
    times: lsn, __from, and __load if known. A change without a time raises when the rows are used.
    Of a key's changes at an instant the last stays: the one of the greatest sequence value and the greatest LSN, each
    taken alone unless `strict`. It is a delete if that row is, an insert if the first is, else an update.
    """
    kind = times.schema[FROM].dataType
    inside = (F.col(FROM) > moment(begin, kind)) & (F.col(FROM) <= moment(end, kind))
    # The LSNs of the window's times bound the log; as scalars they are known before its scan, which they prune.
    bound = lambda f: times.where(inside).agg(f("lsn")).scalar()
    load = LOAD if LOAD in times.columns else FROM
    clock = times.select(F.col("lsn").alias("__lsn"), F.col(FROM), F.col(load).alias("__at"))
    wanted = log.where(F.col("__operation").isin(1, 2, 4) & (F.col("__start_lsn") >= bound(F.min)) & (F.col("__start_lsn") <= bound(F.max)))
    timed = wanted.join(clock, wanted["__start_lsn"] == clock["__lsn"], "left").drop("__lsn")
    timed = timed.where(F.col(FROM).isNull() | inside)
    missing = F.raise_error(F.concat(F.lit("no time for LSN "), F.col("__start_lsn").cast("string")))
    timed = timed.withColumn(FROM, F.when(F.col(FROM).isNotNull(), F.col(FROM)).otherwise(missing.cast(kind)))
    timed = timed.withColumn(SOURCE, F.lit(source_id).cast("smallint")).withColumn(ACTION, F.when(F.col("__operation") == 1, "D").when(F.col("__operation") == 2, "I").otherwise("U"))
    # Dealt once, by the key: the windows over a key's instants and over the key share that exchange and its order.
    timed = timed.repartition(*keys)
    instant = W.partitionBy(*keys, SOURCE, FROM)
    marked = timed.withColumn("__first", F.first(ACTION).over(instant.orderBy("__seqval")))
    if strict:
        last = F.row_number().over(instant.orderBy(F.desc("__seqval"), F.desc("__start_lsn"))) == 1
        marked = marked.withColumn("__last", last)
    else:
        marked = marked.withColumn("__max_lsn", F.max("__start_lsn").over(instant)).withColumn("__max_seq", F.max("__seqval").over(instant))
        marked = marked.withColumn("__last", (F.col("__seqval") == F.col("__max_seq")) & (F.col("__start_lsn") == F.col("__max_lsn")))
    one = marked.where("__last").withColumn(ACTION, F.when(F.col(ACTION) == "D", "D").when(F.col("__first") == "I", "I").otherwise("U"))
    after = F.coalesce(F.lead(FROM).over(W.partitionBy(*keys, SOURCE).orderBy(FROM)), moment(OPEN, kind))
    one = one.withColumn(TO, after).withColumn(LOAD, F.col("__at"))
    columns = [c for c in log.columns if c not in ("__start_lsn", "__seqval", "__operation")]
    return one.select(FROM, TO, LOAD, ACTION, SOURCE, *columns)


def cdc_history(target: DataFrame, log: DataFrame, times: DataFrame, keys: list[str], begin: datetime | Column, end: datetime | Column, source_id: int = 0, strict: bool = False) -> ChangeSet:
    """A change log merged into a history. Open rows of changed keys end at the key's first change."""
    changes = cdc_collapse(log, times, keys, begin, end, source_id, strict)
    ends = changes.groupBy(*keys, SOURCE).agg(F.min(FROM).alias("__end"))
    result, closes = _closed(target, ends, [*keys, SOURCE])
    inserts, tombstones = changes.where(F.col(ACTION) != "D"), changes.where(F.col(ACTION) == "D")
    return _tagged(result, (changes, F.when(F.col(ACTION) == "D", "D").otherwise("I")), inserts=inserts, closes=closes, tombstones=tombstones)


#: Actions in order, as numbers: these aggregate by hash, strings only by sorting.
_RANK = {"D": 1, "I": 2, "U": 3}
#: Old and new side of a key whose rows differ -> what happened to it.
_MATRIX = {(None, "I"): "I", ("I", "I"): "U", ("U", "I"): "U", ("I", None): "D", ("U", None): "D", ("D", "I"): "I", ("D", None): "Z"}


def snapshot_actions(old: DataFrame, new: DataFrame, keys: list[str], strict: bool = False, dedupe: bool = False) -> DataFrame:
    """T4, first half: rows that differ between open history rows and a snapshot, with the key's __action.

    old, new: __source and the business columns; old has __action too (X counts as I). `side_old` and `side_new` tell where
    a row is. Z marks a tombstone whose key is still absent. A deleted key that returns with its last values stays deleted
    unless `strict`. Equal snapshot rows disturb the counts unless `dedupe`.

    Rows are dealt once, by their keys: equal rows have equal keys, so grouping and the windows share that exchange.
    """
    columns = [c for c in new.columns if c != SOURCE]
    rank = lambda c: F.when(c == "D", _RANK["D"]).when(c == "U", _RANK["U"]).when(c.isin("I", "X"), _RANK["I"])
    name = lambda c: F.when(c == _RANK["D"], "D").when(c == _RANK["I"], "I").when(c == _RANK["U"], "U")
    past = old.select(SOURCE, *columns, rank(F.col(ACTION)).alias("__old"))
    now = new.dropDuplicates([SOURCE, *columns]) if dedupe else new
    group = [SOURCE, *columns]
    if strict:
        # A tombstone and a new row of the same values are two different rows.
        past, now = past.withColumn("__gone", F.col("__old") == _RANK["D"]), now.withColumn("__gone", F.lit(False))
        group = [*group, "__gone"]
    different = row_diff(past, now, group, {"__old": "max(__old)"}, keys)
    key = W.partitionBy(*keys, SOURCE)
    a, b = F.max("__old").over(key), F.max("n_new").over(key) > 0
    action = F.lit(None).cast("string")
    for (x, y), z in _MATRIX.items():
        action = F.when((a.isNull() if x is None else a == _RANK[x]) & (~b if y is None else b), z).otherwise(action)
    side_new = F.when(F.col("n_new") > 0, "I")
    return different.select(*keys, *[c for c in columns if c not in keys], SOURCE, name(F.col("__old")).alias("side_old"), side_new.alias("side_new"), action.alias(ACTION))


def snapshot_apply(target: DataFrame, source: DataFrame, keys: list[str], at: datetime | Column, load: datetime | Column | None = None, source_id: int = 0, strict: bool = False, dedupe: bool = False) -> ChangeSet:
    """T4: a full snapshot compared to the open rows: changed and absent keys end, new versions and tombstones follow.

    at: the instant of the snapshot (the last of the time map's window); None raises.
    """
    if at is None:
        raise ValueError("the time map has no row in the window")
    kind = target.schema[TO].dataType
    columns = business(source)
    new = source.select(F.lit(source_id).cast("smallint").alias(SOURCE), *columns)
    old = target.where(F.col(TO) == open_of(target)).select(ACTION, SOURCE, *columns)
    rows = snapshot_actions(old, new, keys, strict, dedupe).where(f"{ACTION} IS NULL OR {ACTION} <> 'Z'")
    stamped = rows.withColumn(FROM, moment(at, kind)).withColumn(TO, moment(OPEN, kind)).withColumn(LOAD, moment(at if load is None else load, kind))
    ends = rows.where("side_old IS NOT NULL").select(*keys, SOURCE).distinct().withColumn("__end", moment(at, kind))
    result, closes = _closed(target, ends, [*keys, SOURCE])
    inserts, tombstones = stamped.where("side_new IS NOT NULL"), stamped.where(f"side_new IS NULL AND {ACTION} = 'D'")
    inserts, tombstones = _like(inserts, target), _like(tombstones, target)
    return _tagged(result, (inserts, "I"), (tombstones, "D"), inserts=inserts, closes=closes, tombstones=tombstones)


def legacy_convert(source: DataFrame, keys: list[str], zone: str = "Europe/London") -> ChangeSet:
    """T5: a history in local time (DateFrom, DateTo) as a history in UTC, with tombstones for keys that have ended.

    The whole table's first instant is the baseline (X). That instant comes from an aggregate, not from a window over all rows.
    """
    utc = lambda c: F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(c)).cast("timestamp_ntz")
    columns = [c for c in source.columns if c not in ("DateFrom", "DateTo")]
    first = source.agg(F.min("DateFrom").alias("__first"))
    key = W.partitionBy(*keys)
    marked = source.crossJoin(F.broadcast(first)).withColumn("__began", F.min("DateFrom").over(key)).withColumn("__ended", F.max("DateTo").over(key))
    action = F.when(F.col("DateFrom") == F.col("__first"), "X").when(F.col("DateFrom") == F.col("__began"), "I").otherwise("U")
    # The far end is a mark, not a time of day, so it isn't converted.
    versions = marked.select(utc("DateFrom").alias(FROM), F.when(F.col("DateTo") >= moment(OPEN), moment(OPEN)).otherwise(utc("DateTo")).alias(TO), utc("DateFrom").alias(LOAD), action.alias(ACTION), F.lit(0).cast("smallint").alias(SOURCE), *columns)
    gone = marked.where((F.col("__ended") != moment(OPEN)) & (F.col("__ended") == F.col("DateTo")))
    tombstones = gone.select(utc("DateTo").alias(FROM), moment(OPEN).alias(TO), utc("DateFrom").alias(LOAD), F.lit("D").alias(ACTION), F.lit(0).cast("smallint").alias(SOURCE), *columns)
    return ChangeSet(versions.unionByName(tombstones), versions, None, tombstones)


def propagate_history(target: DataFrame, changes: DataFrame, keys: list[str], begin: datetime | Column, end: datetime | Column) -> ChangeSet:
    """All changes of another history (R2) carried over: rows that ended are ended, rows that began are added.

    A row that ends after the window is open as far as the window can tell.
    """
    kind = target.schema[TO].dataType
    ended = changes.where(F.col(FROM) <= moment(begin, kind)).select(*keys, SOURCE, FROM, F.col(TO).alias("__end"))
    result, closes = _closed(target, ended, [*keys, SOURCE, FROM])
    clipped = F.when(F.col(TO) > moment(end, kind), moment(OPEN, kind)).otherwise(F.col(TO))
    inserts = _like(changes.where(F.col(FROM) > moment(begin, kind)).withColumn(TO, clipped), target)
    return _tagged(result, (inserts, "I"), inserts=inserts, closes=closes)


def merge(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert with the action taken: all target columns and `merged` ('INSERT', 'UPDATE' or null for rows left alone)."""
    mine, other = target.withColumn("__mine", F.lit(True)), _like(rows, target).withColumn("__other", F.lit(True))
    joined = mine.join(other, equal(mine, other, keys), "full")
    merged = F.when(mine["__mine"].isNull(), "INSERT").when(other["__other"].isNotNull(), "UPDATE")
    columns = [F.when(other["__other"].isNotNull(), other[f"`{c}`"]).otherwise(mine[f"`{c}`"]).alias(c) for c in target.columns]
    return joined.select(*columns, merged.alias("merged"))


def publish(target: DataFrame, changes: DataFrame, keys: list[str]) -> ChangeSet:
    """Net changes (R1) into a published table: insert or update by key, and delete."""
    on = [*keys, SOURCE]
    merged = merge(target, changes.where(F.col(ACTION).isin("I", "U")), on)
    gone = changes.where(F.col(ACTION) == "D").select(*on)
    left = merged.join(gone, on, "left_anti").select(*target.columns, "merged")
    deleted = merged.join(gone, on, "left_semi").select(*target.columns)
    return ChangeSet(left.drop("merged"), left.where("merged = 'INSERT'").drop("merged"), left.where("merged = 'UPDATE'").drop("merged"), deleted)


def copy_net(target: DataFrame, history: DataFrame, keys: list[str], begin: datetime | Column, end: datetime | Column) -> ChangeSet:
    """A plain copy kept up to date from a DateFrom/DateTo history: upsert what is current, delete what has ended."""
    kind = history.schema["DateFrom"].dataType
    f, t = moment(begin, kind), moment(end, kind)
    current = (F.col("DateFrom") > f) & (F.col("DateFrom") <= t) & (F.col("DateTo") > t)
    ended = (F.col("DateTo") > f) & (F.col("DateTo") <= t) & (F.col("DateFrom") <= f)
    merged = merge(target, history.where(current), keys)
    gone = history.where(current | ended).groupBy(*keys).agg(F.count("*").alias("n"), F.min("DateFrom").alias("began")).where((F.col("n") == 1) & (F.col("began") <= f)).select(*keys)
    left = merged.join(gone, keys, "left_anti").select(*target.columns, "merged")
    deleted = merged.join(gone, keys, "left_semi").select(*target.columns)
    return ChangeSet(left.drop("merged"), left.where("merged = 'INSERT'").drop("merged"), left.where("merged = 'UPDATE'").drop("merged"), deleted)
