"""The replication engine: a batch of one task over all matching tables of two stores.

Tables are matched by name, monthly pieces of one target included (X2, X3); each piece has its own number in the history and
its own mark. Change logs are read up to the last instant that they are sure to be complete to (H8, H9), histories from the
date to which they are retained (R3), snapshots as of the bound (H12). Histories are written part by part: a batch reads and
writes their open rows only, and counts what it has written.
"""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import EPOCH, FROM, LAKE, LOAD, OPEN, OPEN_PART, PUBLISHED, SOURCE, TO, WHAT, ChangeSet
from ..operators import control, extract, timemap, transitions
from ..operators.maintenance import retain, retention_date, rollback, rollback_counts
from ..operators.metadata import catalog, cdc_limit, cdc_marks, lake_mark, ordinals, snapshot_mark
from ..operators.schema_sync import TablePlan, evolve, plan_table
from ..operators.timemap import synthetic
from ..sources.store import Store
from .matching import batch_dates, batch_suffix, column_lists, complete_date, match_columns, match_tables


@dataclass
class Context:
    """What a template gets besides the two tables."""

    keys: list[str]
    begin: datetime
    end: datetime
    source_id: int = 0
    times: DataFrame | None = None
    retained: datetime | None = None
    at: datetime | None = None
    load: datetime | None = None


@dataclass
class Template:
    """One action of a task. Instead of text with placeholders: a function of (target, source, context)."""

    task: str
    source_form: str
    target_form: str
    run: Callable[[DataFrame, DataFrame, Context], ChangeSet]
    priority: int = 0
    needs_key: bool = True
    optional: bool = False
    #: Whether ended rows of the target stay as they are, so that its open ones suffice.
    open_only: bool = False


def _net(history: DataFrame, c: Context) -> DataFrame:
    return extract.net_changes(history, c.keys, c.begin, c.end, c.retained)


#: The tasks. Baselines take plain tables as sources.
REGISTRY: dict[str, list[Template]] = {
    t.task: [t]
    for t in (
        Template("BAS-LAK", "NON", "LAK", lambda a, b, c: transitions.baseline_load(a, b, c.end, c.source_id), needs_key=False, open_only=True),
        Template("BAS-LAK1", "NON", "LAK", lambda a, b, c: transitions.baseline_first(a, b, c.begin, c.end), needs_key=False),
        Template("CDC-LAK", "CDC", "LAK", lambda a, b, c: transitions.cdc_history(a, b, c.times, c.keys, c.begin, c.end, c.source_id), open_only=True),
        Template("NON-LAK", "NON", "LAK", lambda a, b, c: transitions.snapshot_apply(a, b, c.keys, c.at, c.load, c.source_id), open_only=True),
        Template("OLD-LAK", "OLD", "LAK", lambda a, b, c: transitions.legacy_convert(b, c.keys)),
        Template("LAK-LAK", "LAK", "LAK", lambda a, b, c: transitions.propagate_history(a, extract.all_changes(b, c.begin, c.end, c.retained), c.keys, c.begin, c.end), open_only=True),
        Template("LAK-PUB", "LAK", "PUB", lambda a, b, c: transitions.publish(a, _net(b, c), c.keys)),
        Template("LAK-NON", "OLD", "NON", lambda a, b, c: transitions.copy_net(a, b, c.keys, c.begin, c.end)),
    )
}


def register(template: Template) -> None:
    """Adds an action to a task, or a new task; all actions of a task have the same forms."""
    have = REGISTRY.setdefault(template.task, [])
    if have and (have[0].source_form, have[0].target_form) != (template.source_form, template.target_form):
        raise ValueError(f"the actions of {template.task} differ in form")
    have.append(template)


def actions(task: str, has_key: bool = True) -> list[Template]:
    """A task's actions in their order; optional ones that lack what they need are left out."""
    found = sorted(REGISTRY.get(task, ()), key=lambda t: t.priority)
    if not found:
        raise ValueError(f"there is no template for task {task}")
    return [t for t in found if has_key or not (t.needs_key and t.optional)]


@dataclass
class Outcome:
    table: str
    outcome: str
    begin: datetime
    end: datetime
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    seconds: float = 0.0
    error: str | None = None
    started: datetime = EPOCH
    source: str = ""
    #: Columns of the source that the target lacks; sync_schemas() adds them.
    left_out: list[str] = field(default_factory=list)


LOG_KEY = ["BatchDate", "Batch", "Task", "DatabaseName", "SchemaName", "ObjectName"]
LOG = "BatchDate timestamp_ntz, Batch string, Task string, DatabaseName string, SchemaName string, ObjectName string, event long, EventTime timestamp_ntz, Outcome string, FromDate timestamp_ntz, ToDate timestamp_ntz, InsertCount long, UpdateCount long, DeleteCount long, ErrorMessage string"


@dataclass
class Batch:
    task: str
    begin: datetime
    end: datetime
    dry_run: bool
    outcomes: list[Outcome] = field(default_factory=list)

    @property
    def failed(self) -> list[Outcome]:
        return [o for o in self.outcomes if o.outcome == "Failure"]


class Engine:
    """Moves tables from one store to another. `now` is given, so that runs can be repeated."""

    def __init__(self, source: Store, target: Store, parallel: int = 1):
        self.source, self.target, self.parallel = source, target, parallel

    def mark(self, store: Store, name: str, source_id: int | None = None) -> datetime:
        """A table's high-water mark, or that of one of its sources; EPOCH for none."""
        if not store.exists(name):
            return EPOCH
        m = store.manifest(name)
        # Open rows suffice, as each key has one.
        df = store.read(name, [OPEN_PART]) if m["form"] == "LAK" else store.read(name)
        if source_id is not None and SOURCE in df.columns:
            df = df.where(F.col(SOURCE) == source_id)
        column = FROM if FROM in df.columns else "DateFrom" if m["form"] == "OLD" else None
        if column is None:
            committed = m.get("mark")
            return datetime.fromisoformat(committed) if committed else EPOCH
        return lake_mark(df, OPEN, open_only=m["form"] == "LAK", column=column).first().DMLDate or EPOCH

    def complete(self, store: Store) -> datetime:
        return datetime.fromisoformat(store.manifest("__complete")["CompleteDate"]) if store.exists("__complete") else EPOCH

    def pairs(self, tables: list[str] | None = None) -> dict[str, list[tuple[str, int]]]:
        """By target table its sources, each with its number. A source that is no target's piece is a table of its own."""
        names = [n for n in self.source.tables() if not n.startswith("__")]
        known = [n for n in self.target.tables() if not n.startswith("__")]
        frame = lambda rows, c: self.target.spark.createDataFrame([(n,) for n in rows], f"{c} string")
        found: dict[str, list[tuple[str, int]]] = {}
        for r in match_tables(frame(names, "SourceTable"), frame(known, "TargetTable")).collect():
            found.setdefault(r.TargetTable, []).append((r.SourceTable, r.Source or 0))
        for n in set(names).difference(s for sources in found.values() for s, _ in sources):
            found[n] = [(n, 0)]
        return {t: sorted(s) for t, s in sorted(found.items()) if tables is None or t in tables or any(n in tables for n, _ in s)}

    def columns(self) -> DataFrame:
        """The columns that both sides of each table have, as the lists that statements are built from."""
        sides = []
        for store in (self.source, self.target):
            names = [n for n in store.tables() if not n.startswith("__")]
            sides.append(ordinals(catalog(store.spark, {n: store.read(n) for n in names}, {n: store.manifest(n)["key"] for n in names})))
        return column_lists(match_columns(*[x.withColumnRenamed("KeyId", "Key") for x in sides]))

    def transfer(self, task: str, bound: datetime, tables: list[str] | None = None, keys: dict[str, list[str]] | None = None, times: DataFrame | None = None, batch: str | None = None, dry_run: bool = False, now: datetime | None = None) -> Batch:
        """Runs a task for every target and its sources (or for those that `tables` names), up to the bound.

        Targets are independent: each commits alone, a failure is recorded and the others go on (X10), `parallel` at a time;
        a target's pieces follow each other. times: the map of a change log, else the target's own, __time. now: the clock,
        behind which a change log's end is left to the next batch. The completion mark moves only if all tables of the store
        went well (X11), and no further than their marks (X8).
        """
        actions(task)
        run = Batch(task, self.complete(self.target), bound, dry_run)
        if times is None and self.target.exists("__time"):
            times = self._instants()

        def all_of(target: str, sources: list) -> list[Outcome]:
            return [self._one(task, target, name, number if len(sources) > 1 or number else None, bound, (keys or {}).get(target), times, batch, dry_run, now) for name, number in sources]

        with ThreadPoolExecutor(max(1, self.parallel)) as pool:
            run.outcomes = [o for some in pool.map(lambda p: all_of(*p), self.pairs(tables).items()) for o in some]
        if not dry_run and run.outcomes:
            spans = self.target.spark.createDataFrame([(o.begin, o.end) for o in run.outcomes], "FromDate timestamp_ntz, ToDate timestamp_ntz")
            dates = batch_dates(spans).first()
            done = complete_date(dates.MaxToDate, run.begin, bound)
            suffix = " (Incomplete)" if run.failed else batch_suffix(False, dates.MaxFromDate, dates.MaxToDate, done, run.begin)
            self._log(run, suffix)
            if not run.failed and tables is None:
                self._advance(CompleteDate=done, LoadedDate=bound)
        return run

    def _instants(self) -> DataFrame:
        """The target's time map with instants instead of ticks."""
        instant = lambda c: F.timestamp_add("MICROSECOND", F.floor(F.col(c) / 10).cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias(c)
        return self.target.read("__time").select("lsn", instant(FROM), instant(LOAD))

    def _one(self, task: str, name: str, origin: str, number: int | None, bound: datetime, key: list[str] | None, times, batch, dry_run, now) -> Outcome:
        """number: the source's in a target that has several; None where it has one."""
        began = time.time()
        out = Outcome(name, "Running", EPOCH, bound, started=datetime.now(), source=origin)
        try:
            template, *_ = actions(task)
            source, m = self.source.read(origin), self.source.manifest(origin)
            if not self.target.exists(name):
                self._create(name, template, source, key or m["key"])
            known = self.target.manifest(name)
            keys = key or known["key"] or m["key"]
            todo = actions(task, bool(keys))
            if not keys and any(t.needs_key for t in todo):
                raise ValueError(f"{name} has no key")
            out.begin = self.mark(self.target, name, number)
            out.end = self._end(template, origin, source, out.begin, bound, known, times, now)
            if out.begin >= out.end:
                out.end = max(out.begin, EPOCH)
                out.outcome = "Pass"
                return out
            parts = [OPEN_PART] if known["form"] == "LAK" and all(t.open_only for t in todo) else None
            whole = target = self.target.read(name, parts)
            out.left_out = [c for c in source.columns if c not in target.columns and not c.startswith("__") and c not in ("DateFrom", "DateTo")]
            others = None
            if number is not None and SOURCE in target.columns:
                target, others = whole.where(F.col(SOURCE) == number), whole.where(F.col(SOURCE) != number)
            retained = m.get("RetentionDate")
            context = Context(keys, out.begin, out.end, number or 0, times, retained and datetime.fromisoformat(retained), synthetic(source.sparkSession, out.begin, out.end, bound).first()[FROM], out.end)
            steps = []
            for t in todo:
                steps.append(t.run(target, source, context))
                target = steps[-1].result
            if dry_run:
                target.schema  # the plan is analysed, and nothing runs
                out.outcome = "Pass"
                return out
            tagged = steps[0].tagged if len(steps) == 1 else None
            # One run of the plan: what was written is counted. Other changes are counted before they are written.
            counts = None if tagged is not None else [s.counts() for s in steps]
            rows = target if tagged is None else tagged
            if others is not None:
                rows = rows.unionByName(others if tagged is None else others.withColumn(WHAT, F.lit(None).cast("string")))
            self.target.amend(name, rows, parts, batch and f"{batch}:{name}:{number or 0}", key=keys, mark=bound.isoformat())
            if counts is None:
                tally = self.target.tally(name)
                out.inserted, out.updated, out.deleted = (tally.get(k, 0) for k in "IUD")
            else:
                out.inserted, out.updated, out.deleted = (sum(c[k] for c in counts) for k in ("inserted", "updated", "deleted"))
            out.outcome = "Success"
        except Exception:
            out.outcome, out.error = "Failure", traceback.format_exc(limit=3)
        out.seconds = time.time() - began
        return out

    def _end(self, template: Template, origin: str, source: DataFrame, begin: datetime, bound: datetime, known: dict, times, now) -> datetime:
        """How far a table's window goes; no further than it begins if there is nothing to do."""
        if template.source_form == "NON":
            changed = known.get("changed")
            return snapshot_mark(bound, changed and datetime.fromisoformat(changed), TO if known["form"] == "LAK" else None)
        if template.source_form == "CDC":
            if times is None:
                raise ValueError("a change log needs a time map")
            limit = cdc_limit(times, bound, now)
            changes = source.where(F.col("__operation").isin(1, 2, 4)).select(F.lit(origin).alias("TableName"), "__start_lsn")
            last = cdc_marks(changes, times, limit).first()
            if last is None or (last[FROM] is not None and last[FROM] <= begin):
                return begin
            return limit.first()[FROM]
        # A history knows itself how far it goes.
        return min(bound, self.mark(self.source, origin))

    def _create(self, name: str, template: Template, source: DataFrame, key: list[str]) -> None:
        drop = ["__start_lsn", "__seqval", "__operation"] + (["DateFrom", "DateTo"] if template.source_form == "OLD" else [])
        own = source.drop(*[c for c in drop if c in source.columns])
        business = own.select(*[c for c in own.columns if c not in LAKE])
        form = template.target_form
        plan = plan_table(name, form, business.schema, None, key)
        if form in ("LAK", "PUB") and len(plan.schema) != len(business.columns) + len(LAKE if form == "LAK" else PUBLISHED):
            raise ValueError(f"columns of {name} are named like a history's own")
        self.target.create(name, plan.schema, plan.key, form=form)

    def _log(self, run: Batch, suffix: str) -> None:
        """The events of each table's run are appended; log() folds them."""
        rows = []
        for o in run.outcomes:
            key = (run.end, f"{run.end:%Y-%m-%d %H:%M:%S}{suffix}", run.task, "lake", "dbo", o.source)
            rows.append((*key, 0, o.started, "Running", o.begin, o.end, None, None, None, None))
            rows.append((*key, 1, o.started + timedelta(seconds=o.seconds), o.outcome, o.begin, o.end, o.inserted, o.updated, o.deleted, o.error))
        self.target.append("__log", self.target.spark.createDataFrame(rows, LOG), form="CTL")

    def log(self) -> DataFrame:
        """A row for each table of each batch; run_summary() and run_latest() read them."""
        return control.merge_log(self.target.read("__log"), LOG_KEY)

    def refresh_times(self, mapping: DataFrame, now: datetime, zone: str = timemap.ZONE, since: datetime | None = None) -> dict[str, int]:
        """The time map of the target brought up to a log's mapping (lsn, tran_end_time): M1, M5, M6, M8, M9 in a row.

        since: only what was committed from then on is read, or from an hour before if that is in the hour that clocks repeat
        (M7); a whole instant's rows, as they rank each other. Load times of rows that are known stay, so that a row that comes again unchanged is no difference.
        """
        known = self.target.read("__time") if self.target.exists("__time") else None
        if since is not None:
            mapping = mapping.where(F.col("tran_end_time") >= F.lit(timemap.backed_off(since)))
        rows = timemap.repair_overlap(timemap.rank_map(mapping.select("lsn", "tran_end_time"), zone), known)
        loads = rows.withColumn(LOAD, F.lit(None).cast("long")) if known is None else rows.join(known.select("lsn", LOAD), "lsn", "left")
        source = timemap.stamp_load(loads.select("lsn", "tran_end_time", FROM, LOAD), now)
        if known is None:
            self.target.commit("__time", source, form="CTL", key=["lsn"])
            return {"I": source.count()}
        inside = known.join(source.select("lsn"), "lsn", "left_semi").select(*source.columns)
        differences = timemap.classify(source, inside)
        self.target.commit("__time", timemap.upsert(known.select(*source.columns), differences), form="CTL", key=["lsn"])
        return {r.upsert: r["count"] for r in differences.groupBy("upsert").count().collect()}

    def sync_schemas(self, form: str, preserve_key: bool = False, dry_run: bool = False, at: datetime | None = None) -> list[TablePlan]:
        """New tables of the source are made in the target, and new columns are added to those it has.

        at: the instant of the change; snapshots up to a bound before it wait for a later one (H12)."""
        plans = []
        for name in [n for n in self.source.tables() if not n.startswith("__")]:
            m = self.source.manifest(name)
            have = self.target.schema(name) if self.target.exists(name) else None
            plan = plan_table(name, form, self.source.schema(name), have, m["key"], self.target.manifest(name)["key"] if have else [], preserve_key)
            plans.append(plan)
            if dry_run or plan.status == "=":
                continue
            if have is None:
                self.target.create(name, plan.schema, plan.key, form=form)
            else:
                self.target.commit(name, evolve(self.target.read(name), plan.schema), key=plan.key, **({"changed": at.isoformat()} if at else {}))
        return plans

    def prune(self, name: str, days: int, bound: date | None = None, dry_run: bool = False) -> date:
        """B2: history that ended before the retention date goes; the date is recorded, but not in a dry run.

        Whole months before the date's are taken from the manifest; the date's own month alone is read and written.
        """
        day = retention_date(self.complete(self.target), days, bound)
        if not dry_run:
            month, parts = f"{day:%Y-%m}", self.target.parts(name)
            gone = [p for p in parts if p != OPEN_PART and p <= month] if self.target.manifest(name)["form"] == "LAK" else None
            self.target.amend(name, retain(self.target.read(name, None if gone is None else [month]), day), gone, RetentionDate=day.isoformat())
            if self.target.exists("__complete"):
                self._advance(RetentionDate=datetime(day.year, day.month, day.day))
        return day

    def rewind(self, name: str, at: datetime) -> dict[str, int]:
        """B1: a history as it was at an instant. Months that ended before it stay as they are."""
        parts = [p for p in self.target.parts(name) if p >= f"{at:%Y-%m}"] if self.target.manifest(name)["form"] == "LAK" else None
        df = self.target.read(name, parts)
        begin, end = (FROM, TO) if FROM in df.columns else ("DateFrom", "DateTo")
        counts = rollback_counts(df, at, begin, end).first()
        self.target.amend(name, rollback(df, at, begin, end).result, parts)
        return counts.asDict()

    def _advance(self, **marks: datetime) -> None:
        """The store's marks: given ones replace the old ones, and CompleteDate never goes back."""
        names = ["CompleteDate", "LoadedDate", "RetentionDate"]
        if "CompleteDate" in marks:
            marks["CompleteDate"] = max(marks["CompleteDate"], self.complete(self.target))
        schema = ", ".join(f"{c} timestamp_ntz" for c in names)
        new = self.target.spark.createDataFrame([tuple(marks.get(c) for c in names)], schema)
        old = self.target.read("__complete") if self.target.exists("__complete") else self.target.spark.createDataFrame([], schema)
        merged = control.merge_complete(old, new)
        properties = {"CompleteDate": marks["CompleteDate"].isoformat()} if "CompleteDate" in marks else {}
        self.target.commit("__complete", merged, form="CTL", **properties)
