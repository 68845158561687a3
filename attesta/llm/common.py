"""What the corpus operators share: staged tables in the shared folder, and plain helpers for Arrow batches."""

from __future__ import annotations

import contextlib
import functools
import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words everywhere in this subpackage; bytes.split() splits at exactly these.
WHITE = " \t\n\x0b\x0c\r"

_staged: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset, one below the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


#: Rows of an Arrow batch where a row holds a whole text, or the hashes of one or two.
LONG_ROWS = 500
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, jobs hand Python no more than so many rows at a time: bounds the buffers of long rows, outside the heap, in executors and in Python."""
    before = int(spark.conf.get(_ROWS))
    spark.conf.set(_ROWS, min(before, rows) if before > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(_ROWS, before)


#: Bytes of an Arrow batch that a session with long rows hands to Python at a time.
BATCH_BYTES = 4 << 20
_BYTES_OF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on, jobs of the session hand Python no more than so many bytes at a time (a row at least).

    For results that run after the function that made them has returned. Rows and results are the same. A bound given with
    a unit is the user's and stays.
    """
    found = spark.conf.get(_BYTES_OF).removesuffix("b")
    if found.isdigit() and int(found) > most:
        spark.conf.set(_BYTES_OF, most)


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation. It also drops any known
    partitioning, so that a join on the result gets its own exchange on both sides, which adaptive execution can split
    when a key is hot.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    _staged.append(path)
    return out


#: Bytes that a staged table may have, as rows in memory, to be broadcast.
BROADCAST_BYTES = 32 << 20


def sized(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A staged table, marked for broadcast if it is small, counted in bytes: its rows by their width, lists and texts as long as they are.

    Beyond the limit the join shuffles both sides. The result is the same.
    """
    fixed = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4}
    width = 16 + sum(fixed.get(t, 8) for _, t in table.dtypes)
    long = [F.length(F.to_json(F.struct(c))) if "<" in t else F.octet_length(c) for c, t in table.dtypes if "<" in t or t in ("string", "binary")]
    size = table.agg(F.count("*") * width + F.coalesce(F.sum(sum(map(lambda c: F.coalesce(c, F.lit(0)), long), F.lit(0))), F.lit(0))).first()[0]
    return F.broadcast(table) if size <= limit else table


def drop(spark: SparkSession, *tables: DataFrame, shuffles: bool = False) -> None:
    """Delete staged tables that nothing reads any more; with shuffles, also let Spark clean the shuffles that made them."""
    for table in tables:
        _staged.remove(table.staged_path)
        _delete(spark, table.staged_path)
    for _ in range(2 * shuffles):  # the first round finds what the second can clean
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete the staged tables of this session. Call it only when no result that reads them is needed any more."""
    while _staged:
        _delete(spark, _staged.pop())


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows of each value of the first `keys` (integer) columns together, from batches sorted by them: slices of batches."""
    last, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns[:keys]]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for i, j in zip(starts, starts[1:]):
            key = tuple(c[i] for c in cols)
            if held and key != last:
                yield held
                held = []
            last = key
            held.append(b.slice(i, j - i))
    if held:
        yield held


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that none holds much more than max_bytes (one row at least): bounds the Python objects made of a batch."""
    for b in batches:
        n = b.num_rows
        step = max(1, min(n, int(n * max_bytes / max(1, b.nbytes)))) if n else 1
        for at in range(0, n, step):
            yield b.slice(at, step)


UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIX = np.uint64(0x9E3779B97F4A7C15)


_BYTES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA0761D6478BD642F)


@functools.cache
def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, MIX)]))


def hashed_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a text: hashes (A-Z lower-cased), starts and ends in code points. No loop over words: a word is hashed as a polynomial in its bytes."""
    raw = text.encode()
    x = np.frombuffer(raw.translate(UPPER), np.uint8)
    inside = np.empty(len(x) + 1, bool)
    inside[-1] = False
    np.logical_and(x != 32, (x < 9) | (x > 13), out=inside[:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    first, last = edge[::2], edge[1::2]
    if not len(first):
        return np.zeros(0, np.uint64), first, last
    sizes = last - first
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    h = np.add.reduceat(_BYTES[x[inside[:-1]]] * _powers(1 << int(sizes.max()).bit_length())[place], begin)
    h = (h ^ (h >> np.uint64(29)) ^ sizes.astype(np.uint64)) * MIX
    h ^= h >> np.uint64(32)
    if len(raw) > len(text):
        inner = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80)])
        first, last = first - inner[first], last - inner[last]
    return h, first, last


def kmers(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive words."""
    n = len(hashes) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for i in range(k):
                out = (out ^ hashes[i : i + n]) * MIX
                out ^= out >> np.uint64(29)
    return out


def batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
