"""A store of versioned Parquet tables.

A commit writes a new version's folder and then replaces the table's manifest by a rename, so readers see the whole of one
version or the other, and a failed commit leaves nothing but a folder that no manifest names. Hadoop's file system API does
the file work, so a store can lie wherever Spark reads.

Histories are kept in parts: the open rows, and those that have ended by the month of their end. The manifest names each
part's folders, so a commit writes the parts that it changes and names the others' folders again: a batch rewrites the open
rows and adds what it has closed, whatever the length of the history. New months come up by themselves (X9), and retention
takes whole months out of the manifest.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import OPEN_PART, TO, WHAT, open_of


def part_of(df: DataFrame) -> Column:
    """The part of a history that a row belongs to."""
    end = F.col(TO)
    if isinstance(df.schema[TO].dataType, T.LongType):
        end = F.timestamp_add("MICROSECOND", F.floor(end / 10).cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.when(F.col(TO) == open_of(df), OPEN_PART).otherwise(F.date_format(end, "yyyy-MM"))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(self.root))

    def _path(self, p: str):
        return self.hadoop.Path(p)

    def _manifest(self, name: str) -> str:
        return f"{self.root}/{name}/manifest.json"

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(self._manifest(name)))

    def tables(self) -> list[str]:
        found = [s.getPath().getName() for s in self.fs.listStatus(self._path(self.root)) if s.isDirectory()]
        return sorted(n for n in found if self.exists(n))

    def manifest(self, name: str) -> dict:
        stream = self.fs.open(self._path(self._manifest(name)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.manifest(name)["schema"]))

    def parts(self, name: str) -> list[str]:
        return sorted(self.manifest(name)["parts"])

    def read(self, name: str, parts: list[str] | None = None) -> DataFrame:
        """The table, or the named parts of a history."""
        m = self.manifest(name)
        folders = [f for p, fs in sorted(m["parts"].items()) if parts is None or p in parts for f in fs]
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def create(self, name: str, schema: T.StructType, key: list[str] = (), partition_by: list[str] = (), form: str = "NON") -> None:
        self.commit(name, self.spark.createDataFrame([], schema), key=list(key), partition_by=list(partition_by), form=form)

    def commit(self, name: str, df: DataFrame, batch: str | None = None, **properties) -> dict:
        """Writes df as the table's next version; properties are kept from version to version unless given.

        A batch that the table has already is not written again, so that a repeated run doesn't insert twice.
        """
        return self.amend(name, df, None, batch, **properties)

    def append(self, name: str, df: DataFrame, **properties) -> dict:
        return self.amend(name, df, [], **properties)

    def amend(self, name: str, df: DataFrame, replaced: list[str] | None, batch: str | None = None, **properties) -> dict:
        """A version in which df's rows stand for the replaced parts (all of them for None); other parts stay as they are.

        A column WHAT of df is stored beside the rows, but not read as the table's; tally() counts it.
        """
        old = self.manifest(name) if self.exists(name) else {"version": 0, "batches": [], "key": [], "partition_by": [], "form": "NON", "parts": {}}
        if batch and batch in old["batches"]:
            return old
        m = old | properties
        version = old["version"] + 1
        path = f"{self.root}/{name}/v{version:06d}-{uuid.uuid4().hex[:8]}"
        schema = T.StructType([f for f in df.schema if f.name != WHAT])
        parts = {p: fs for p, fs in old["parts"].items() if replaced is not None and p not in replaced}
        if m["form"] == "LAK" and TO in df.columns:
            rows = df.withColumn("__part", part_of(df)).sortWithinPartitions("__part", *m["key"])
            rows.write.partitionBy("__part").parquet(path)
            for s in self.fs.listStatus(self._path(path)):
                folder = s.getPath().getName()
                if s.isDirectory() and folder.startswith("__part="):
                    part = folder.partition("=")[2]
                    parts[part] = [*parts.get(part, []), f"{path}/{folder}"]
        else:
            rows = df.sortWithinPartitions(*m["key"]) if m["key"] else df
            (rows.write.partitionBy(*m["partition_by"]) if m["partition_by"] else rows.write).parquet(path)
            parts[""] = [*parts.get("", []), path]
        m |= {"version": version, "path": path, "parts": parts, "previous": old["parts"], "schema": schema.json(), "batches": [*old["batches"], *([batch] if batch else [])][-1000:], "committed": datetime.now().isoformat()}
        self._replace(self._manifest(name), json.dumps(m))
        return m

    def tally(self, name: str) -> dict[str, int]:
        """The rows of the last commit by WHAT."""
        folders = [f for fs in self.manifest(name)["parts"].values() for f in fs if f.startswith(self.manifest(name)["path"])]
        if not folders:
            return {}
        rows = self.spark.read.schema(f"{WHAT} string").parquet(*folders).where(f"{WHAT} IS NOT NULL")
        return {r[0]: r[1] for r in rows.groupBy(WHAT).count().collect()}

    def _replace(self, path: str, text: str) -> None:
        temporary = self._path(f"{path}.{uuid.uuid4().hex}")
        stream = self.fs.create(temporary, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(temporary, self._path(path), options)

    def drop(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.root}/{name}"), True)

    def vacuum(self, name: str) -> int:
        """Deletes what neither the manifest nor its predecessor names: whole versions, and parts of versions."""
        m = self.manifest(name)
        keep, gone = {self._path(f).toUri().getPath() for parts in (m["parts"], m["previous"]) for fs in parts.values() for f in fs}, 0
        for s in self.fs.listStatus(self._path(f"{self.root}/{name}")):
            path = s.getPath().toUri().getPath()
            if not s.isDirectory() or path in keep:
                continue
            if not any(k.startswith(path + "/") for k in keep):
                self.fs.delete(s.getPath(), True)
                gone += 1
                continue
            for p in self.fs.listStatus(s.getPath()):
                if p.isDirectory() and p.getPath().toUri().getPath() not in keep:
                    self.fs.delete(p.getPath(), True)
                    gone += 1
        return gone
