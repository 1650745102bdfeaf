"""The agent's session database as a data source (S-8): SQLite through Python's own library.

``spark.read.format("sessiondb").option("path", file).option("table", "session")`` reads one table in
ranges of its row ids, a partition each, so a large table is not read by one task.  Simple comparisons
are pushed into the query.  The database is opened read-only and busy writers are waited for.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual

#: The three tables and their columns.
TABLES = {
    "session": "id string, title string, project_id string, parent_id string, directory string, agent string, model string, cost double, tokens_input bigint, tokens_output bigint, tokens_reasoning bigint, tokens_cache_read bigint, tokens_cache_write bigint, time_created bigint, time_updated bigint",
    "message": "id string, session_id string, time_created bigint, data string",
    "part": "id string, message_id string, session_id string, time_created bigint, data string",
}
ROWS_PER_PARTITION = 50_000
_OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=60)


class RowRange(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SessionReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str]):
        self.path, self.table, self.columns = path, table, columns
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in self.columns and type(f) in _OPERATORS and isinstance(f.value, (str, int, float)):
                self.where.append(f'"{name}" {_OPERATORS[type(f)]} ?')
                self.values.append(f.value)
            elif name in self.columns and isinstance(f, (IsNull, IsNotNull)):
                self.where.append(f'"{name}" IS {"NOT " * isinstance(f, IsNotNull)}NULL')
            else:
                yield f

    def partitions(self) -> list[RowRange]:
        with _open(self.path) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [RowRange(0, -1)]  # an empty range: no partition at all would be read as one of None
        return [RowRange(a, min(a + ROWS_PER_PARTITION - 1, high)) for a in range(low, high + 1, ROWS_PER_PARTITION)]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        names = ", ".join(f'"{c}"' for c in self.columns)
        extra = "".join(f" AND {w}" for w in self.where)
        with _open(self.path) as db:
            yield from db.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid BETWEEN ? AND ?{extra} ORDER BY rowid', (partition.low, partition.high, *self.values))


class SessionDatabase(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sessiondb"

    def schema(self) -> str:
        table = self.options.get("table", "session")
        if table not in TABLES:
            raise ValueError(f"unknown table {table}")
        return TABLES[table]

    def reader(self, schema) -> SessionReader:
        return SessionReader(self.options["path"], self.options.get("table", "session"), schema.fieldNames())


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SessionDatabase)
