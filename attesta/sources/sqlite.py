"""SQLite as a data source: files are read in ranges of rowid and written one for each task.

`register(spark)` makes it known as format "sqlite". Options: path (a file, or a folder of .sqlite files, on a file system
that driver and executors mount), table, and for reading rows (of a partition, at most so many rowids).
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

#: Rowids of a partition.
ROWS = 1_000_000


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def kind_of(declared: str):
    """The Spark type for a declared column type, by SQLite's rules of affinity."""
    d = declared.upper()
    if "INT" in d:
        return LongType()
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return StringType()
    if "BLOB" in d or not d:
        return BinaryType()
    return DoubleType()


@dataclass
class Range(InputPartition):
    """Rows of a file with low <= rowid <= high."""

    file: str
    low: int
    high: int


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, files: list[str], table: str, rows: int) -> None:
        self.schema, self.files, self.table, self.rows, self.equal = schema, files, table, rows, []

    def pushFilters(self, filters: list[Filter]):
        """Equality is left to SQLite, which may have an index; all else comes back to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and isinstance(f.value, (int, str)) and not isinstance(f.value, bool):
                self.equal.append((f.attribute[0], f.value))
            else:
                yield f

    def partitions(self) -> list[Range]:
        out = []
        for file in self.files:
            with closing(sqlite3.connect(file)) as c:
                low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
            if low is not None:
                out += [Range(file, at, min(at + self.rows - 1, high)) for at in range(low, high + 1, self.rows)]
        return out

    def read(self, part: Range) -> Iterator[tuple]:
        names = ", ".join(quoted(f.name) for f in self.schema.fields)
        more = "".join(f" AND {quoted(n)} = ?" for n, _ in self.equal)
        with closing(sqlite3.connect(part.file)) as c:
            for row in c.execute(f"SELECT {names} FROM {quoted(self.table)} WHERE rowid BETWEEN ? AND ?{more}", (part.low, part.high, *(v for _, v in self.equal))):
                yield tuple(float(v) if isinstance(f.dataType, DoubleType) and v is not None else v for f, v in zip(self.schema.fields, row))


class Writer(DataSourceWriter):
    """A new file for each task; files of tasks that failed are removed at the end."""

    def __init__(self, schema: StructType, path: str, table: str, overwrite: bool) -> None:
        self.schema, self.path, self.table, self.overwrite = schema, path, table, overwrite

    def write(self, rows: Iterator) -> WriterCommitMessage:
        kinds = {LongType: "INTEGER", StringType: "TEXT", BinaryType: "BLOB", DoubleType: "REAL"}
        os.makedirs(self.path, exist_ok=True)
        name = f"{uuid.uuid4().hex}.sqlite.part"
        with closing(sqlite3.connect(f"{self.path}/{name}")) as c:
            c.execute(f"CREATE TABLE {quoted(self.table)} ({', '.join(f'{quoted(f.name)} {kinds[type(f.dataType)]}' for f in self.schema.fields)})")
            marks = ", ".join("?" * len(self.schema.fields))
            c.executemany(f"INSERT INTO {quoted(self.table)} VALUES ({marks})", (tuple(r) for r in rows))
            c.commit()
        message = WriterCommitMessage()
        message.name = name
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        own = {m.name for m in messages if m is not None}
        for file in os.listdir(self.path):
            if file in own:
                os.rename(f"{self.path}/{file}", f"{self.path}/{file.removesuffix('.part')}")
            elif self.overwrite and file.endswith(".sqlite") or file.endswith(".sqlite.part"):
                os.remove(f"{self.path}/{file}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m is not None:
                os.remove(f"{self.path}/{m.name}")


class SQLiteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _files(self) -> list[str]:
        path = local(self.options["path"])
        return sorted(f"{path}/{f}" for f in os.listdir(path) if f.endswith(".sqlite")) if os.path.isdir(path) else [path]

    def schema(self) -> StructType:
        with closing(sqlite3.connect(self._files()[0])) as c:
            columns = c.execute(f"PRAGMA table_info({quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        return StructType([StructField(name, kind_of(kind or "")) for _, name, kind, *_ in columns])

    def reader(self, schema: StructType) -> Reader:
        return Reader(schema, self._files(), self.options["table"], int(self.options.get("rows", ROWS)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(schema, local(self.options["path"]), self.options["table"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SQLiteSource)
