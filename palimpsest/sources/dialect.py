"""Names and queries in other systems' dialects (Q1 to Q4), as options for Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass

# Quotes by system, and the metadata columns that reading a form adds.
QUOTES = {"SQLServer": ("[", "]"), "Oracle": ('"', '"'), "MySQL": ("`", "`"), "Spark": ("`", "`")}
URL_PREFIXES = {"jdbc:sqlserver:": "SQLServer", "jdbc:oracle:": "Oracle", "jdbc:mysql:": "MySQL", "jdbc:mariadb:": "MySQL"}
FORM_COLUMNS = {"LAK": ("__$From", "__$To", "__$Load", "__$Action", "__$Source"), "PUB": ("__$From", "__$Load", "__$Action", "__$Source"), "CDC": ("__$start_lsn", "__$seqval", "__$operation"), "OLD": ("DateFrom", "DateTo")}


def quote(name: str, system: str = "Spark") -> str:
    a, b = QUOTES[system]
    return a + name.replace(b, b * 2) + b


@dataclass(frozen=True)
class Path:
    """Q1: a table's place; the server names the connection and isn't part of the name."""

    table: str
    schema: str | None = None
    database: str | None = None
    system: str = "Spark"

    def name(self) -> str:
        # Oracle and MySQL have one level above tables.
        levels = [self.database, self.schema, self.table] if self.system in ("SQLServer", "Spark") else [self.schema or self.database, self.table]
        return ".".join(quote(x, self.system) for x in levels if x)

    def query(self, columns: list[str] | None = None, form: str | None = None, where: str | None = None) -> str:
        """A query for the columns that are needed, with the form's own in front, so that the source prunes and filters."""
        if columns is None and where is None:
            return f"SELECT * FROM {self.name()}"
        chosen = "*" if columns is None else ", ".join(quote(c, self.system) for c in [*FORM_COLUMNS.get(form or "", ()), *columns])
        return f"SELECT {chosen} FROM {self.name()}" + (f" WHERE {where}" if where else "")


def remote_options(url: str, query: str, driver: str | None = None, fetch: int = 10_000) -> dict[str, str]:
    """Q2: options for spark.read.format("jdbc") that run a query where the data is."""
    options = {"url": url, "query": query, "fetchsize": str(fetch), "pushDownPredicate": "true"}
    return options | ({"driver": driver} if driver else {})


def partitioned_options(url: str, path: Path, column: str, low: int, high: int, parts: int) -> dict[str, str]:
    """Q2 for large tables: as many connections as parts, each with a range of a numeric column."""
    return {"url": url, "dbtable": path.name(), "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}


def system_of(url: str) -> str:
    """Q3: the system behind a JDBC URL."""
    for prefix, system in URL_PREFIXES.items():
        if url.lower().startswith(prefix):
            return system
    raise ValueError(f"unknown kind of database: {url}")


def create_database(name: str, location: str | None = None) -> str:
    """Q4: DDL for a database of the catalog."""
    return f"CREATE DATABASE IF NOT EXISTS {quote(name)}" + (f" LOCATION '{location}'" if location else "")
