"""Whitening of embeddings by hierarchical merging of singular value decompositions.

Every vector becomes whole numbers, x = floor(64 c) + 1000000, and each distinct x is fitted once. A partition keeps,
of its vectors less their mean, all singular values and right singular vectors, with their number and exact sums. Two
such summaries merge without loss: the scaled vectors of both and one row that corrects for the difference of the
means, decomposed again. Merging goes level by level as Spark jobs over staged summaries, `FAN` of them to one, so a
task holds FAN times the square of the dimensions and the driver one summary.

Numbers are kept less OFFSET, which changes no centred value. Sums are exact, so means are too.

Cases: a vector that is null or holds a null, NaN or infinite entry, or one beyond 2**55, has no rows. Vectors of
another length than the commonest (of several such, the greatest) have none either, nor have empty vectors. Equal
vectors are fitted once and every row of theirs is returned, as are rows that repeat an id or have a null one. With
fewer than 16 dimensions there are fewer components. A component without variance (at most `FLAT` of the greatest) has
no whitened value (null), and does not count in identity_error. An empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import drop, slices, stage

SCALE, OFFSET = 64, 1_000_000
#: Summaries merged into one at a time.
FAN = 8
#: Share of the greatest eigenvalue below which a component counts as having no variance.
FLAT = 1e-13
#: Vectors decomposed at a time.
ROWS = 8192


@dataclass
class Summary:
    """n vectors of d dimensions: exact sums, and rows whose product with themselves is the scatter about the mean."""

    n: int
    sums: list[int]
    rows: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def decomposed(rows: np.ndarray) -> np.ndarray:
    """Singular values times right singular vectors of rows: all that are not beyond the rank."""
    _, s, vt = np.linalg.svd(rows, full_matrices=False)
    return s[:, None] * vt


def summarised(x: np.ndarray) -> Summary:
    """Of vectors as rows of whole numbers (int64)."""
    n, sums = len(x), [int(v) for v in (x.astype(object).sum(0) if np.abs(x).max(initial=0) > 2**62 // max(1, len(x)) else x.sum(0))]
    return Summary(n, sums, decomposed(x - np.array([s / n for s in sums])))


def merged(a: Summary, b: Summary) -> Summary:
    """The summary of both: their rows, one more for the distance of the means, decomposed anew."""
    n = a.n + b.n
    # the difference of the means, from whole numbers: no cancellation
    apart = np.array([(p * b.n - q * a.n) / (a.n * b.n) for p, q in zip(a.sums, b.sums)])
    return Summary(n, [p + q for p, q in zip(a.sums, b.sums)], decomposed(np.vstack([a.rows, b.rows, np.sqrt(a.n / n * b.n) * apart])))


def coded(v: np.ndarray) -> bytes | None:
    """x less OFFSET as bytes: the width of its numbers, then the numbers; equal vectors have equal bytes."""
    x = v.astype(float)
    if not len(x) or not np.isfinite(x).all() or np.abs(x).max() > 2.0**55:
        return None
    y = np.floor(SCALE * x).astype(np.int64)
    top = int(max(y.max(), -1 - y.min()))
    kind = np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.int64
    return bytes([np.dtype(kind).itemsize]) + y.astype(kind).tobytes()


def numbers(codes: list[bytes], d: int) -> np.ndarray:
    """Back from bytes: one row of int64 for each."""
    if all(c[0] == 2 for c in codes):
        return np.frombuffer(b"".join(c[1:] for c in codes), np.int16).reshape(-1, d).astype(np.int64)
    return np.array([np.frombuffer(c, f"i{c[0]}", offset=1) for c in codes], np.int64).reshape(-1, d)


def encoded(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, dim, code of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [None if not v.is_valid or v.values.null_count else coded(v.values.to_numpy(zero_copy_only=False)) for v in b.column(1)]
            dims = [None if c is None else (len(c) - 1) // c[0] for c in codes]
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(dims, pa.int32()), pa.array(codes, pa.binary())], ["id", "dim", "code"])
            yield out.filter(out.column(1).is_valid())

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col), F.col(vector_col)).mapInArrow(run, f"id {kind}, dim int, code binary")


_SUMMARY = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("rows", pa.binary())])
_SUMMARY_DDL = "node bigint, n bigint, sums array<string>, rows binary"


def _packed(node: int, s: Summary) -> pa.RecordBatch:
    columns = [[node], [s.n], [[str(v) for v in s.sums]], [np.ascontiguousarray(s.rows).tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUMMARY)], schema=_SUMMARY)


def _unpacked(n: int, sums: list[str], rows: bytes) -> Summary:
    return Summary(n, [int(v) for v in sums], np.frombuffer(rows).reshape(-1, len(sums)))


def _leaves(fit: DataFrame, d: int) -> DataFrame:
    """One summary of each partition, made a stretch of its vectors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, node = None, 0
        for b in batches:
            if b.num_rows:
                node = b.column(1)[0].as_py()
            for at in range(0, b.num_rows, ROWS):
                s = summarised(numbers(b.column(0).slice(at, ROWS).to_pylist(), d))
                own = s if own is None else merged(own, s)
        if own is not None:
            yield _packed(node, own)

    return fit.select("code", F.spark_partition_id().cast("long").alias("node")).mapInArrow(run, _SUMMARY_DDL)


def _level(nodes: DataFrame) -> DataFrame:
    """Up to FAN summaries merged into one."""

    def run(table: pa.Table) -> pa.Table:
        own = None
        for r in table.sort_by("node").to_pylist():
            s = _unpacked(r["n"], r["sums"], r["rows"])
            own = s if own is None else merged(own, s)
        return pa.Table.from_batches([_packed(table.column("node")[0].as_py() // FAN, own)])

    return nodes.groupBy(F.floor(F.col("node") / FAN)).applyInArrow(run, _SUMMARY_DDL)


def summary_of(spark: SparkSession, fit: DataFrame, d: int) -> Summary:
    """The summary of all vectors of fit (code), merged level by level until one is left."""
    nodes = stage(spark, _leaves(fit, d), "whitening-nodes")
    while nodes.count() > 1:
        old, nodes = nodes, stage(spark, _level(nodes), "whitening-nodes")
        drop(spark, old)
    r = nodes.first()
    return _unpacked(r["n"], r["sums"], bytes(r["rows"]))


@dataclass
class Model:
    """What whitens: n and the exact sums S (of x less OFFSET), components as rows, eigenvalues, and their shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of rows of numbers; NaN for components without variance."""
        with np.errstate(divide="ignore"):
            scale = np.where(self.values > FLAT * self.values[:1], 1 / np.sqrt(self.values), np.nan)
        return self.centred(x).astype(float) / self.n @ self.components.T * scale

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: int64 where that surely suffices, else Python's numbers."""
        s = np.array(self.sums, object)
        if int(np.abs(x).max(initial=0)) * self.n + max((abs(v) for v in self.sums), default=0) < 2**63:
            return self.n * x - s.astype(np.int64)
        return self.n * x.astype(object) - s

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of the squares of n x - S, exact."""
        t = self.centred(x)
        top = max(abs(int(t.max(initial=0))), abs(int(t.min(initial=0))))
        t = t if top**2 * max(1, t.shape[1]) < 2**63 and t.dtype != object else t.astype(object)
        return [int(v) for v in (t * t).sum(1)]


def model_of(s: Summary, most: int | None = 16) -> Model:
    """Components by falling eigenvalue, the entry of greatest size positive."""
    _, sv, vt = np.linalg.svd(s.rows, full_matrices=True)
    d = vt.shape[1]
    values = np.zeros(d)
    values[: len(sv)] = sv**2 / s.n
    total = values.sum()
    k = min(d, most or d)
    sign = np.sign(vt[np.arange(d), np.abs(vt).argmax(1)])
    return Model(s.n, s.sums, (vt * sign[:, None])[:k], values[:k], (values / total if total else values)[:k])


def identity_error(fit: DataFrame, model: Model) -> float:
    """The largest entry of the whitened vectors' covariance over fit, less the identity. Only sums of products leave the tasks."""
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                w = model.apply(numbers(b.column(0).slice(at, ROWS).to_pylist(), d))
                first += w.sum(0)
                second += w.T @ w
        both = np.vstack([second, first])
        i, j = np.indices(both.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(both.ravel())], ["i", "j", "s"])

    sums = fit.select("code").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # square of the components
    k = len(model.values)
    both = np.zeros((k + 1, k))
    for r in sums:
        both[r["i"], r["j"]] = r["s"]
    mean = both[k] / model.n  # zero but for rounding: values are centred before they are multiplied
    error = np.abs(both[:k] / model.n - np.outer(mean, mean) - np.eye(k))
    return float(np.nanmax(error)) if np.isfinite(error).any() else 0.0


OUT = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(spark: SparkSession, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16) -> DataFrame:
    """For each vector and component: the id, component, n, deviation, whitened, explained, identity_error. Fits on the distinct vectors first."""
    kind = rows.schema[id_col].dataType.simpleString()
    codes = stage(spark, encoded(rows, id_col, vector_col), "whitening-codes")
    sizes = codes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).first()
    schema = f"`{id_col}` {kind}, {OUT}"
    if sizes is None:
        return spark.createDataFrame([], schema)
    d = sizes["dim"]
    fit = stage(spark, codes.where(F.col("dim") == d).select("code").distinct(), "whitening-fit")
    model = model_of(summary_of(spark, fit, d), most)
    error = identity_error(fit, model)
    drop(spark, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for b in slices(batches, 1 << 20):
            if not b.num_rows:
                continue
            x = numbers(b.column(1).to_pylist(), d)
            m, w = len(x), model.apply(x).ravel()
            decimal = pa.array(model.deviations(x), pa.decimal128(38, 0))
            each = np.repeat(np.arange(m), k)
            columns = [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n)), decimal.take(pa.array(each))]
            columns += [pa.array(w, mask=np.isnan(w)), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return codes.where(F.col("dim") == d).select("id", "code").mapInArrow(run, schema)
