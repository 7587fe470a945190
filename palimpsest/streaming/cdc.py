"""A change log that arrives as a stream, merged into a stored history micro-batch by micro-batch.

Each micro-batch runs the same transition as a batch does. The history's own marks, not a streaming watermark, say what is
known; a micro-batch that is delivered again is recognised by its number and not merged twice. Changes that come too late to
be merged in order are kept in a table of their own beside the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import EPOCH, FROM, OPEN, OPEN_PART, TO, open_of
from ..operators.transitions import cdc_history
from ..sources.store import Store


def merge_stream(log: DataFrame, store: Store, name: str, keys: list[str], checkpoint: str, time_column: str = "ts", trigger: dict | None = None) -> StreamingQuery:
    """log: a streaming DataFrame of a change log, with the instant of each change in `time_column`.

    A change at or before the instant at which its key's open row began is late: it goes to the table `__late_<name>`.
    """
    missed = f"__late_{name}"

    def step(rows: DataFrame, number: int) -> None:
        times = rows.select(F.col("__start_lsn").alias("lsn"), F.col(time_column).cast("timestamp_ntz").alias(FROM)).groupBy("lsn").agg(F.max(FROM).alias(FROM))
        # Ended rows stay where they are, so only the open ones are read and written.
        history, batch = store.read(name, [OPEN_PART]), f"{checkpoint}:{number}"
        if not store.exists(missed):
            store.create(missed, rows.schema, keys, form="CTL")
        store.amend(missed, late(rows, history, keys, time_column), [], batch)
        changes = cdc_history(history, late(rows, history, keys, time_column, False).drop(time_column), times, keys, EPOCH, OPEN)
        store.amend(name, changes.tagged, [OPEN_PART], batch)

    writer = log.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def late(changes: DataFrame, history: DataFrame, keys: list[str], time_column: str = "ts", whether: bool = True) -> DataFrame:
    """Changes that came too late (or, not `whether`, in time) to be merged in order: at or before their key's open row began."""
    began = history.where(F.col(TO) == open_of(history)).groupBy(*keys).agg(F.max(FROM).alias("__began"))
    known = began.select(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys], "__began")
    on = changes[time_column].cast("timestamp_ntz") <= known["__began"]
    for k in keys:
        on = on & (changes[f"`{k}`"] == known[f"`__key_{k}`"])
    return changes.join(known, on, "left_semi" if whether else "left_anti")
