"""Schema synchronisation: differences (S2, S4), key choice (S3), and the plan to make a target follow its source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import LAKE, PUBLISHED

# Types that new tables replace.
REPLACED_TYPES = {"timestamp": "varbinary(8)", "image": "varbinary(max)", "text": "varchar(max)", "ntext": "nvarchar(max)"}
METADATA_TYPES = {"__from": "timestamp_ntz", "__to": "timestamp_ntz", "__load": "timestamp_ntz", "__action": "string", "__source": "smallint"}


def schema_diff(source: DataFrame, target: DataFrame, properties: tuple[str, ...] = ("ColumnType", "ColumnLength", "ColumnScale", "ColumnPrecision")) -> DataFrame:
    """Each source column as new (A), changed (M) or equal (=), and its table as new, changed or equal.

    A property that is unknown on either side counts as equal; columns of the target alone aren't seen.
    """
    t = target.select("TableName", "ColumnName", F.lit(1).alias("__known"), *[F.col(p).alias(f"__{p}") for p in properties])
    differs = F.lit(False)
    for p in properties:
        differs = differs | F.coalesce(F.col(p) != F.col(f"__{p}"), F.lit(False))
    status = F.when(F.col("__known").isNull(), "A").when(differs, "M").otherwise("=")
    rows = source.join(t, ["TableName", "ColumnName"], "left").withColumn("ColumnStatus", status)
    table = W.partitionBy("TableName")
    all_are = lambda s: F.min(F.col("ColumnStatus") == s).over(table)
    return rows.withColumn("TableStatus", F.when(all_are("="), "=").when(all_are("A"), "A").otherwise("M")).drop("__known", *[f"__{p}" for p in properties])


def choose_key(source: list[str], target: list[str], preserve_target: bool = False) -> list[str]:
    """S3: the source's key, or the target's, whichever comes first and has columns."""
    first, second = (target, source) if preserve_target else (source, target)
    return list(first or second)


@dataclass
class TablePlan:
    name: str
    status: str
    schema: T.StructType
    added: list[str]
    widened: list[str]
    key: list[str]
    warning: str | None = None


def plan_table(name: str, form: str, source: T.StructType, target: T.StructType | None, source_key: list[str], target_key: list[str] = (), preserve_target: bool = False) -> TablePlan:
    """S1 for one table: the schema that the target should have, with a history's own columns in front."""
    own = [*LAKE, "DateFrom", "DateTo", "__$From", "__$To", "__$Load", "__$Action", "__$Source"]
    wanted = [f for f in source if f.name not in own]
    front = {"LAK": LAKE, "PUB": PUBLISHED}.get(form, ())
    have = {f.name: f for f in target or ()}
    added = [f.name for f in wanted if f.name not in have]
    widened = [f.name for f in wanted if f.name in have and have[f.name].dataType != f.dataType]
    fields = [T.StructField(c, T._parse_datatype_string(METADATA_TYPES[c]), False) for c in front if c not in have]
    fields += list(target or ()) + [T.StructField(f.name, f.dataType, True) for f in wanted if f.name not in have]
    key = choose_key(list(source_key), list(target_key), preserve_target)
    status = "A" if target is None else "M" if added or widened else "="
    return TablePlan(name, status, T.StructType(fields), added, widened, key, None if key else f"{name}: neither source nor target has a key")


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of an older schema in a newer one; new columns are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def new_type(name: str) -> str:
    """The type that a new table gets for one of the source's."""
    return REPLACED_TYPES.get(name.lower(), name)
