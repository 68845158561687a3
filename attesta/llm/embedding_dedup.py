"""Near-duplicates among embeddings, by cosine within a label: int8 tile products with rigorous error bounds.

Each unit vector x is stored as x = s * q + e, with int8 codes q, a scale s and the exact norm of the error e. For two
vectors, |cos - s s' q.q'| <= |s q| |e'| + |e|, so a matrix product of codes, tile by tile, settles all pairs but those
within the bound of the threshold. Codes are made once and only they travel at first; pairs of tiles in which a pair is
unsettled get the doubles of the vectors concerned in a second round. Tiles hold neighbours in the
order of their nearest pivot, and a pair of tiles is not formed at all where, by the triangle inequality on angles,
some pivot shows that no pair of their vectors can be near enough.

Equal vectors of a label are one class: only classes are compared, and members count with their number.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import stage
from attesta.llm.components import connected
from attesta.llm.simhash import Forest

THRESHOLD = 0.93
#: Rows of a tile, and pivots that order and prune tiles.
TILE, PIVOTS = 2048, 16
#: Rows of a product that are held at a time.
STRIPE = 256
#: More than what rounding adds to a product of codes or of doubles in any dimension used.
SLACK = 1e-7


def signed(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, dim, key (a 128-bit digest of the vector), unit (the unit vector as doubles); key is null for a vector that links with nothing."""
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, keys, units = [], [], []
            for v, label in zip(b.column(2), b.column(1)):
                x = None if not v.is_valid or not label.is_valid or v.values.null_count else np.asarray(v.values.to_numpy(zero_copy_only=False), float)
                if x is None or not len(x) or not np.isfinite(x).all() or not (top := np.abs(x).max()):
                    dims.append(None), keys.append(None), units.append(None)
                    continue
                raw = x + 0.0  # a negative zero is a zero
                x = raw / top  # no overflow or underflow of squares
                dims.append(len(x))
                keys.append(hashlib.blake2b(raw.tobytes(), digest_size=16).digest())
                units.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(units, pa.binary())], ["id", "label", "dim", "key", "unit"])

    kinds = [schema[c].dataType.simpleString() for c in (id_col, label_col)]
    return rows.select(F.col(id_col), F.col(label_col), F.col(vector_col)).mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, dim int, key binary, unit binary")


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of the coded vectors and norms of the errors, for the rows of x."""
    scale = np.abs(x).max(1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: float32 is exact below 2**24, so at most 1024 dimensions are summed in it."""
    if q.shape[1] <= 1024:
        return q.astype(np.float32) @ r.astype(np.float32).T
    return sum((q[:, at : at + 1024].astype(np.float32) @ r[:, at : at + 1024].astype(np.float32).T).astype(float) for at in range(0, q.shape[1], 1024))


def settled(x: tuple, y: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs that may reach the threshold, a stripe of rows at a time, and whether they are sure to. x, y: codes, scales, norms, errors."""
    (q, s, n, e), (r, t, m, f) = x, y
    for at in range(0, len(q), STRIPE):
        rows = slice(at, at + STRIPE)
        cos = products(q[rows], r) * s[rows, None] * t
        bound = n[rows, None] * f + e[rows, None] + SLACK
        maybe = cos + bound >= threshold
        if same:
            maybe &= np.arange(len(r)) > np.arange(at, at + len(cos))[:, None]
        i, j = np.nonzero(maybe)
        yield i + at, j, cos[i, j] - bound[i, j] >= threshold


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine of at least threshold between unit rows of x and y; i < j if they are the same tile."""
    left, right = [], []
    for i, j, sure in settled(quantise(x), quantise(y), threshold, same):
        ok = sure.copy()
        ok[~sure] = exact(x, y, i[~sure], j[~sure], threshold)
        left.append(i[ok])
        right.append(j[ok])
    return np.concatenate(left), np.concatenate(right)


def exact(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the cosine of each pair, in double precision, reaches the threshold."""
    return np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", x[i[a : a + 16384]], y[j[a : a + 16384]]) >= threshold for a in range(0, len(i), 16384))])


@functools.cache
def _pivots(dim: int) -> np.ndarray:
    """Fixed pseudo-random directions: the same for every task and every run."""
    rng = np.random.default_rng(int.from_bytes(hashlib.blake2b(f"{dim}".encode(), digest_size=8).digest(), "little"))
    p = rng.normal(size=(PIVOTS, dim))
    return p / np.linalg.norm(p, axis=1, keepdims=True)


#: The arrays of a tile.
PARTS = ("codes", "scales", "norms", "errors", "units")


def tiles(spark: SparkSession, classes: DataFrame, tile: int = TILE) -> DataFrame:
    """Tiles of at most `tile` classes of one label and dimension: label, dim, tile, ids, sizes, codes, scales, norms, errors, units (bytes of arrays), low, high (angles to the pivots).

    Classes are range-partitioned by label, dimension and nearest pivot and tiles are cut within partitions, so a
    label that holds most vectors is spread over many tasks.
    """
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = []
            for dim, unit in zip(b.column(b.schema.get_field_index("dim")).to_pylist(), b.column(b.schema.get_field_index("unit")).to_pylist()):
                cos = _pivots(dim) @ np.frombuffer(unit)
                best = int(cos.argmax())
                place.append(best - (1 - float(cos[best])) / 3)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.float64())], [*b.schema.names, "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group: tuple, ids: list, sizes: list, units: list, label_type: pa.DataType, id_type: pa.DataType) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(units)).reshape(len(ids), -1)
            angle = np.arccos(np.clip(x @ _pivots(x.shape[1]).T, -1, 1))
            arrays = [pa.array([group[0]], label_type), pa.array([group[1]], pa.int32()), pa.array([ids], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())), *(pa.array([c.tobytes()], pa.binary()) for c in (*quantise(x), x)), pa.array([angle.min(0).tolist()], pa.list_(pa.float64())), pa.array([angle.max(0).tolist()], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays(arrays, ["label", "dim", "ids", "sizes", *PARTS, "low", "high"])

        group, ids, sizes, units, types = None, [], [], [], ()
        for b in batches:
            types = (b.schema.field(0).type, b.schema.field(2).type)
            for label, dim, first, size, unit in zip(*(c.to_pylist() for c in b.columns)):
                if ids and ((label, dim) != group or len(ids) >= tile):
                    yield out(group, ids, sizes, units, *types)
                    ids, sizes, units = [], [], []
                group = (label, dim)
                ids.append(first), sizes.append(size), units.append(unit)
        if ids:
            yield out(group, ids, sizes, units, *types)

    placed = classes.select("label", "dim", "first", "size", "unit").mapInArrow(ranked, f"label {kinds['label']}, dim int, first {kinds['first']}, size bigint, unit binary, place double")
    dealt = placed.repartitionByRange("label", "dim", "place").sortWithinPartitions("label", "dim", "place", "first").select("label", "dim", "first", "size", "unit")
    return dealt.mapInArrow(cut, f"label {kinds['label']}, dim int, ids array<{kinds['first']}>, sizes array<bigint>, {', '.join(f'{c} binary' for c in PARTS)}, low array<double>, high array<double>").withColumn("tile", F.monotonically_increasing_id())


def links(spark: SparkSession, classes: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(a, b): links that connect all linked classes; (first, n): number of members linked to each class, by tile pair.

    classes: first (number of the class, a long), size, label, dim, unit. A task gets two tiles at a time.
    """
    cut = stage(spark, tiles(spark, classes, tile), "embedding-tiles")  # tile numbers are fixed from here on
    brief = cut.select("tile", "label", "dim", "low", "high")
    other = brief.select(F.col("tile").alias("tile2"), "label", "dim", F.col("low").alias("low2"), F.col("high").alias("high2"))
    reach = float(np.arccos(threshold)) + 1e-6
    near = F.forall(F.sequence(F.lit(0), F.lit(PIVOTS - 1)), lambda i: (F.get("low", i) <= F.get("high2", i) + reach) & (F.get("low2", i) <= F.get("high", i) + reach))
    pairs = stage(spark, brief.join(other, ["label", "dim"]).where((F.col("tile") <= F.col("tile2")) & near).select("tile", "tile2"), "embedding-pairs")
    kind = classes.schema["first"].dataType.simpleString()

    def sides(pairs: DataFrame, *columns: str) -> DataFrame:
        """Both tiles of each pair, one if it is the same."""
        own = cut.select("tile", F.struct("ids", "sizes", *columns).alias("body"))
        one = pairs.join(own, "tile").select("tile", "tile2", F.lit(0).alias("side"), "body")
        two = pairs.where("tile <> tile2").join(own.withColumnRenamed("tile", "tile2"), "tile2").select("tile", "tile2", F.lit(1).alias("side"), "body")
        return one.union(two)

    def join(doubles: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of a pair of tiles: those that the codes settle, and whether some are unsettled; or, with doubles, the unsettled ones."""
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["side"])
        same = len(rows) == 1
        bodies = [rows[0]["body"], rows[-1]["body"]]
        coded = []
        for o in bodies:
            n = len(o["ids"])
            coded.append((np.frombuffer(o["codes"], np.int8).reshape(n, -1), *(np.frombuffer(o[c]) for c in ("scales", "norms", "errors"))))
        units = [np.frombuffer(o["units"]).reshape(len(o["ids"]), -1) for o in bodies] if doubles else []
        ids = bodies[0]["ids"] + ([] if same else bodies[1]["ids"])
        sizes = np.array(bodies[0]["sizes"] + ([] if same else bodies[1]["sizes"]))
        shift = 0 if same else len(bodies[0]["ids"])
        order = np.argsort(np.array(ids), kind="stable")  # the forest's roots are then the smallest ids
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        count, forest, open_ = np.zeros(len(ids), np.int64), Forest(len(ids)), False
        for i, j, sure in settled(*coded, threshold, same):
            if doubles:
                i, j = i[~sure], j[~sure]
                near = exact(units[0], units[1], i, j, threshold)
            else:
                near, open_ = sure, open_ or not sure.all()
            i, j = i[near], j[near] + shift
            np.add.at(count, i, sizes[j])
            np.add.at(count, j, sizes[i])
            forest.roots(rank[i], rank[j])
        some = np.flatnonzero(count)
        a, b = [ids[k] for k in some], [ids[order[forest.parent[rank[k]]]] for k in some]
        n, first, second = count[some].tolist(), [None] * len(some), [None] * len(some)
        if open_:
            a, b, n, first, second = [*a, None], [*b, None], [*n, None], [*first, rows[0]["tile"]], [*second, rows[0]["tile2"]]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["a", "b", "n", "tile", "tile2"])

    def from_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return join(False, batches)

    def from_doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return join(True, batches)

    schema = f"a {kind}, b {kind}, n bigint, tile bigint, tile2 bigint"
    coded = PARTS[:-1]
    by_codes = stage(spark, sides(pairs, *coded).groupBy("tile", "tile2").applyInArrow(from_codes, schema), "embedding-links")
    unsettled = by_codes.where("tile IS NOT NULL").select("tile", "tile2")
    by_doubles = stage(spark, sides(unsettled, *PARTS).groupBy("tile", "tile2").applyInArrow(from_doubles, schema), "embedding-links-exact")
    found = by_codes.union(by_doubles).where("a IS NOT NULL")
    return found.select("a", "b"), found.select(F.col("a").alias("first"), "n")


def components(spark: SparkSession, rows: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """One row per input row: id, n_links, component_id (the smallest id reachable, itself included), kept.

    Vectors link if their labels are equal and not null, they have the same dimension, and their cosine reaches the
    threshold. Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing. A row
    with a null id links with nothing, has a null component and is not kept. Repeated rows are rows: each links with
    the others. Further columns are not read; an empty table gives an empty result.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    own = stage(spark, signed(rows, id_col, vector_col, label_col), "embedding-rows")
    good = own.where("id IS NOT NULL AND key IS NOT NULL")
    classes = stage(spark, good.groupBy("label", "dim", "key").agg(F.min("id").alias("first"), F.count("*").alias("size"), F.any_value("unit").alias("unit")), "embedding-classes")
    # a class is named by its smallest id and label: repeated ids can name several, so classes get numbers of their own
    named = stage(spark, classes.withColumn("cls", F.monotonically_increasing_id()), "embedding-named")
    edges, counts = links(spark, named.select(F.col("cls").alias("first"), "size", "label", "dim", "unit"), threshold, tile)
    comp = connected(spark, edges)
    total = counts.groupBy(F.col("first").alias("cls")).agg(F.sum("n").alias("n"))
    with_comp = named.select("cls", "label", "dim", "key", "first", "size").join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls")).join(total, "cls", "left")
    least = with_comp.groupBy("component").agg(F.min("first").alias("component_id"))
    # equal vectors have cosine one, which a threshold above one would not reach
    alike = F.col("size") - 1 if threshold <= 1 - 1e-9 else F.lit(0)
    facts = stage(spark, with_comp.join(least, "component").select("label", "dim", "key", (F.coalesce("n", F.lit(0)) + alike).cast("long").alias("n_links"), "component_id"), "embedding-facts")
    linked = good.select("id", "label", "dim", "key").join(facts, ["label", "dim", "key"]).select("id", "n_links", "component_id")
    alone = own.where("id IS NULL OR key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").cast(kind).alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
