"""Bytes that lie in a string of LENGTH bytes which also starts elsewhere, found with a logarithmic family of suffix arrays.

A window is a string of LENGTH bytes. Its anchor is the K-byte string in it with the smallest hash (the first of
several), so equal windows have equal anchors. A cell is a run of windows of a text with one anchor place; the cells of
a text hold each of its windows once.

1. Tasks give each text's cells as (hash of the anchor, hash of the cell's bytes), equal ones of a text counted once.
   Anchors that occur once are done: nothing like them is elsewhere. That is nearly all of unrepeated text.
2. A cell that occurs twice is repeated as a whole. Where an anchor has several different cells, one copy of each is
   dealt by its anchor, and the windows of what meets in a partition are compared by an index family (`Family`): a new
   batch gets a suffix array (of the suffixes that are windows, by their first LENGTH bytes), is merge-scanned with the
   levels there are, and levels of equal size are merged, so each suffix is moved a logarithmic number of times.
   A window that a level has is marked on both sides and not added again.
3. An anchor with more than CONTEXTS different cells (the edge of a passage that very many texts share) would be one
   hot key. Its cells are cut where the windows' anchors of FINER bytes change, and dealt by those. Finer cells that
   occur twice are repeated as a whole, anchors that occur once are done, and only where a finer anchor has several
   different cells are windows dealt one by one, by the hash of all their bytes.
4. The cells and windows that are repeated go back to their texts, which are cut.

Texts are known by a 128-bit digest: equal texts are one, and a text that occurs twice is repeated as a whole. Anchors
and cells are known by 64-bit hashes each, so two cells are confused with a chance of about 2**-128.

Cases: null texts are empty, and texts shorter than LENGTH keep all they have. Rows that repeat an id count like any
others; null ids stay. Matches may overlap themselves, as in a run of one character, whose cells are all the same.
Further columns are ignored. No rows give none.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import MIX, drop, slices, stage

LENGTH, K, FINER = 200, 64, 180
#: Different cells of an anchor that one task compares.
CONTEXTS = 256
#: Window starts that are worked on at a time: bounds the arrays for very long texts.
STRETCH = 1 << 20
#: Cells of a batch of the index family, and of a partition.
BATCH, PARTITION = 2048, 20_000

_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_CODEC = "zstd"


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, np.uint64)]))
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64)]))
    return up, down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


class Cells:
    """The cells of a stretch of a text: where they begin and end (window starts), and hashes of anchors, cells and windows."""

    def __init__(self, text: np.ndarray, length: int = LENGTH, k: int = K) -> None:
        n = len(text)
        up, down = _powers(1 << max(10, int(n).bit_length()))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[text] * down[:n], out=sums[1:])
        self._sums, self._up, self.length = sums, up, length
        grams = self._hash(np.arange(n - k + 1), k)
        # the hash and, below it, the place: the smallest is the first of equal ones
        low = np.uint64(24)
        keys = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
        width, size, least = length - k + 1, 1, keys
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
        place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        self.first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        self.last = np.append(self.first[1:], len(place)) - 1
        self.windows = len(place)
        self.anchor = grams[place[self.first]]
        self.cell = self.spans(self.first, self.last)

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from a window to another."""
        sizes = last - first + self.length
        return _mixed((self._sums[first + sizes] - self._sums[first]) * self._up[first] ^ sizes.astype(np.uint64) * MIX)

    def _hash(self, at: np.ndarray, size: int) -> np.ndarray:
        return _mixed((self._sums[at + size] - self._sums[at]) * self._up[at])

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        return self._hash(at, self.length)


def stretches(text: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, Cells]]:
    """A text's cells, STRETCH windows at a time, each with where it begins. A cell over a border is two."""
    for at in range(0, len(text) - length + 1, STRETCH):
        yield at, Cells(text[at : at + STRETCH + length - 1], length)


def digest(text: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def pair_key(anchor: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """One number for an anchor and a cell, to look up within a text."""
    return _mixed(anchor * MIX ^ cell)


def runs(at: np.ndarray) -> np.ndarray:
    """Rising numbers as runs: first, last, first, last ..."""
    if not len(at):
        return at
    new = np.flatnonzero(np.diff(at) != 1)
    return np.stack([at[np.append(0, new + 1)], at[np.append(new, len(at) - 1)]], 1).ravel()


class Level:
    """A suffix array over the windows of cells: sorted by anchor, then by the windows' bytes. own: the cell of a window, and its start there."""

    def __init__(self, text: np.ndarray, anchor: np.ndarray, at: np.ndarray, own: np.ndarray, size: int, length: int) -> None:
        self.text, self.anchor, self.at, self.own, self.size, self.length = text, anchor, at, own, size, length

    def bytes_of(self, rows: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(self.text, self.length)
        return view[self.at[rows]].copy().view(f"S{self.length}").ravel()

    @classmethod
    def of(cls, anchors: np.ndarray, texts: list[bytes], first_cell: int, length: int) -> Level:
        """The suffix array of a batch of cells."""
        sizes = np.array([len(t) for t in texts])
        windows = sizes - length + 1
        begin = np.cumsum(sizes) - sizes
        cell = np.repeat(np.arange(len(texts)), windows)
        start = np.arange(len(cell)) - np.repeat(np.cumsum(windows) - windows, windows)
        own = np.stack([cell + first_cell, start], 1)
        made = cls(np.frombuffer(b"".join(texts), np.uint8), anchors[cell], begin[cell] + start, own, len(texts), length)
        return made.taken(np.lexsort((made.bytes_of(np.arange(len(cell))), made.anchor)))

    def taken(self, rows: np.ndarray) -> Level:
        return Level(self.text, self.anchor[rows], self.at[rows], self.own[rows], self.size, self.length)

    def same_as_before(self) -> np.ndarray:
        """Whether a window equals the one before it: the longest common prefix of neighbours reaches the length."""
        out = np.zeros(len(self.at), bool)
        near = np.flatnonzero(self.anchor[1:] == self.anchor[:-1]) + 1
        out[near] = self.bytes_of(near) == self.bytes_of(near - 1)
        return out

    def scanned(self, other: Level) -> tuple[np.ndarray, np.ndarray]:
        """Windows of both that are equal, as places in each: a merge of the two arrays where they have an anchor in common."""
        mine, its = np.flatnonzero(np.isin(self.anchor, other.anchor)), np.flatnonzero(np.isin(other.anchor, self.anchor))
        if not len(mine):
            return mine, its
        x, y = self.bytes_of(mine), other.bytes_of(its)
        whole = np.concatenate([x, y])
        order = np.argsort(whole, kind="stable")
        ranked = whole[order]
        group = np.cumsum(np.append(True, ranked[1:] != ranked[:-1]))
        number = np.empty(len(whole), np.int64)
        number[order] = group
        anchors, own = np.unique(np.concatenate([self.anchor[mine], other.anchor[its]]), return_inverse=True)
        number = number * len(anchors) + own
        return mine[np.isin(number[: len(x)], number[len(x) :])], its[np.isin(number[len(x) :], number[: len(x)])]

    def merged(self, other: Level) -> Level:
        """Both as one: in order of anchors, and of bytes where both have an anchor."""
        both = Level(np.concatenate([self.text, other.text]), np.concatenate([self.anchor, other.anchor]), np.concatenate([self.at, other.at + len(self.text)]), np.concatenate([self.own, other.own]), self.size + other.size, self.length)
        rank = np.concatenate([np.arange(len(self.at)), np.arange(len(other.at))])
        shared = np.flatnonzero(np.isin(both.anchor, np.intersect1d(self.anchor, other.anchor)))
        if len(shared):
            rank[shared[np.argsort(both.bytes_of(shared), kind="stable")]] = np.arange(len(shared))
        return both.taken(np.lexsort((rank, both.anchor)))


class Family:
    """Levels of suffix arrays whose sizes grow geometrically, and the windows (cell, start) found to be repeated."""

    def __init__(self, length: int = LENGTH) -> None:
        self.levels: list[Level] = []
        self.cells, self.length = 0, length
        self.marked: list[np.ndarray] = []

    def add(self, anchors: np.ndarray, texts: list[bytes]) -> None:
        """Index a batch of cells: mark what it repeats of itself and of the levels, and what of those it repeats."""
        new = Level.of(anchors, texts, self.cells, self.length)
        self.cells += len(texts)
        same = new.same_as_before()
        self.marked.append(new.own[same | np.append(same[1:], False)])
        new = new.taken(np.flatnonzero(~same))
        for level in self.levels:
            mine, its = new.scanned(level)
            self.marked += [new.own[mine], level.own[its]]
            new = new.taken(np.delete(np.arange(len(new.at)), mine))
        while self.levels and self.levels[-1].size <= new.size:
            new = self.levels.pop().merged(new)
        self.levels.append(new)

    def repeated(self) -> Iterator[tuple[int, np.ndarray]]:
        """Cells with repeated windows, and these as runs."""
        if not self.marked:
            return
        rows = np.unique(np.concatenate(self.marked), axis=0)
        cut = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.zeros(0, np.int64)
        for at, to in zip(cut, np.append(cut[1:], len(rows))):
            yield int(rows[at, 0]), runs(rows[at:to, 1])


def cell_rows(texts: DataFrame) -> DataFrame:
    """k1, k2 (digest), anchor, cell, c: the distinct cells of each text and how often it has them; and for each text a row with a null anchor whose c counts it.

    A task that meets a text again only counts it.
    """
    names = ["k1", "k2", "anchor", "cell", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for b in slices(batches):
            keys, found = [], []
            for raw in b.column(0).cast(pa.binary()):
                text = np.frombuffer(raw.as_buffer(), np.uint8) if raw.is_valid else np.zeros(0, np.uint8)
                if len(text) < LENGTH:
                    continue
                key = digest(text)
                seen[key] = seen.get(key, 0) + 1
                if seen[key] == 1:
                    keys.append(key)
                    found.append(distinct(np.concatenate([np.stack([x.anchor, x.cell]) for _, x in stretches(text)], 1)))
            if keys:
                k = np.repeat(np.array(keys), [len(c) for _, c in found], axis=0)
                rows = np.concatenate([r for r, _ in found], 1).view(np.int64)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (k[:, 0], k[:, 1], rows[0], rows[1], np.concatenate([c for _, c in found])))], names)
            if len(seen) > 200_000:
                yield counted(seen)
        yield counted(seen)

    def counted(seen: dict[tuple[int, int], int]) -> pa.RecordBatch:
        keys, none = list(seen), [None] * len(seen)
        out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(seen.values(), pa.int64())], names)
        seen.clear()
        return out

    return texts.mapInArrow(run, "k1 bigint, k2 bigint, anchor bigint, cell bigint, c bigint")


def distinct(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of pairs and how often each occurs."""
    if not pairs.shape[1]:
        return pairs, np.zeros(0, np.int64)
    pairs = pairs[:, np.lexsort(pairs)]
    new = np.flatnonzero(np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(0)))
    return pairs[:, new], np.diff(np.append(new, pairs.shape[1]))


def packed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, k1, k2, n_bytes and the text compressed, which is what travels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_CODEC, compression_level=1)
        for b in slices(batches):
            keys, sizes, packed = [], [], []
            for raw in b.column(1).cast(pa.binary()):
                text = raw.as_buffer() if raw.is_valid else pa.py_buffer(b"")
                keys.append(digest(text))
                sizes.append(text.size)
                packed.append(codec.compress(text, asbytes=True))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], ["id", "k1", "k2", "n_bytes", "packed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, k1 bigint, k2 bigint, n_bytes bigint, packed binary")


def unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.Codec(_CODEC).decompress(packed, size) if size else b"", np.uint8)


def listed(column: pa.Array, names: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """The lists of structs of a column as arrays, one for each name; null and empty lists are empty."""
    flat, offsets = column.values, column.offsets.to_numpy()
    columns = [np.asarray(flat.field(n)) if not pa.types.is_list(flat.field(n).type) else flat.field(n) for n in names]
    for i, valid in enumerate(column.is_valid().to_pylist()):
        part = slice(offsets[i], offsets[i + 1]) if valid else slice(0, 0)
        yield tuple(c[part] for c in columns)


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of numbers of a column; null ones are empty."""
    flat, offsets = np.asarray(column.values), column.offsets.to_numpy()
    for i, valid in enumerate(column.is_valid().to_pylist()):
        yield flat[offsets[i] : offsets[i + 1]] if valid else flat[:0]


def cut_out(rows: DataFrame) -> DataFrame:
    """k1, k2, anchor, cell, c, text, windows: of each text (packed, n_bytes, asked: array of (anchor, cell, hot)) the cells that are asked for.

    A cell of a hot anchor comes as finer cells, with the hashes of their windows and how often the text has them; another one with its bytes.
    """
    names = ["k1", "k2", "anchor", "cell", "c", "text", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in slices(batches):
            out: list[tuple] = []
            for k1, k2, size, packed, (anchor, cell, hot) in zip(*(b.column(i).to_pylist() for i in range(4)), listed(b.column(4), ["anchor", "cell", "hot"])):
                if (k1, k2) in seen:  # another copy
                    continue
                seen.add((k1, k2))
                text, keys, hot, given = unpacked(packed, size), pair_key(anchor.view(np.uint64), cell.view(np.uint64)), hot.astype(bool), set()
                for base, x in stretches(text):
                    own = pair_key(x.anchor, x.cell)
                    hits = [i for i in np.flatnonzero(np.isin(own, keys[~hot])) if own[i] not in given and not given.add(own[i])]
                    if hits:
                        pieces = [text[base + x.first[i] : base + x.last[i] + LENGTH].tobytes() for i in hits]
                        out.append((k1, k2, x.anchor[hits], x.cell[hits], np.ones(len(hits), np.int64), pieces, [None] * len(hits)))
                    wide = np.flatnonzero(np.isin(own, keys[hot]))
                    if len(wide):
                        found = finer(text[base : base + x.windows + LENGTH - 1], x, wide)
                        out.append((k1, k2, *found[:3], [None] * len(found[0]), found[3]))
            if out:
                n = [len(o[4]) for o in out]
                columns = [pa.array(np.repeat(np.array([o[i] for o in out], np.int64), n)) for i in range(2)]
                columns += [pa.array(np.concatenate([o[i] for o in out]).view(np.int64)) for i in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([t for o in out for t in o[5]], pa.binary()), pa.array([t for o in out for t in o[6]], pa.list_(pa.int64()))], names)

    return rows.select("k1", "k2", "n_bytes", "packed", "asked").mapInArrow(run, "k1 bigint, k2 bigint, anchor bigint, cell bigint, c bigint, text binary, windows array<bigint>")


def finer(text: np.ndarray, x: Cells, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Anchors and hashes of the finer cells in cells of a stretch, how often each occurs, and the hashes of its windows."""
    y = Cells(text, LENGTH, FINER)
    sizes = x.last[wide] - x.first[wide] + 1
    at = np.repeat(x.first[wide], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    cell = np.searchsorted(y.first, at, "right") - 1
    new = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(cell) != 0)))
    ends = np.append(new[1:], len(at))
    anchor, span = y.anchor[cell[new]], y.spans(at[new], at[ends - 1])
    _, first, c = np.unique(pair_key(anchor, span), return_index=True, return_counts=True)
    hashes = y.window_hashes(at).view(np.int64)
    return anchor[first], span[first], c, [hashes[new[i] : ends[i]] for i in first]


def repeated_windows(cells: DataFrame) -> DataFrame:
    """anchor, cell, runs: of different cells (anchor, cell, text), dealt by anchor, the windows that two of them share, or one has twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, names, anchors, texts = Family(), [], [], []

        def index() -> None:
            family.add(np.array(anchors, np.int64).view(np.uint64), texts)
            anchors.clear(), texts.clear()

        for b in batches:
            for a, c, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                names.append((a, c)), anchors.append(a), texts.append(t)
                if len(texts) == BATCH:
                    index()
        if texts:
            index()
        found = list(family.repeated())
        for at in range(0, len(found), 10_000):
            part = found[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([names[i][0] for i, _ in part], pa.int64()), pa.array([names[i][1] for i, _ in part], pa.int64()), pa.array([r.tolist() for _, r in part], pa.list_(pa.int32()))], ["anchor", "cell", "runs"])

    return cells.select("anchor", "cell", "text").mapInArrow(run, "anchor bigint, cell bigint, runs array<int>")


def marked_texts(spark: SparkSession, docs: DataFrame, text_col: str) -> DataFrame:
    """k1, k2, copies, found, windows: of each text of LENGTH bytes or more with repeated windows, how often it occurs (null: once), its repeated cells (anchor, cell, runs), and hashes of single repeated windows."""
    rows = stage(spark, cell_rows(docs.select(F.col(text_col).cast("string"))), "suffix-cells")
    copies = rows.where("anchor IS NULL").groupBy("k1", "k2").agg(F.sum("c").alias("copies")).where("copies > 1")
    own = rows.where("anchor IS NOT NULL")
    twice = stage(spark, own.groupBy("anchor").agg(F.sum("c").alias("n")).where("n > 1").select("anchor"), "suffix-anchors")
    some = stage(spark, own.join(twice, "anchor", "left_semi"), "suffix-repeated")
    cells = stage(spark, some.groupBy("anchor", "cell").agg(F.sum("c").alias("n"), F.min("k1").alias("rep")), "suffix-distinct")
    many = stage(spark, cells.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1"), "suffix-contexts")
    open_cells = stage(spark, cells.join(many, "anchor").select("anchor", "cell", "rep", (F.col("contexts") > CONTEXTS).alias("hot")), "suffix-open")
    # one text gives a cell's bytes; all texts give the windows of hot anchors
    wanted = some.select("k1", "k2", "anchor", "cell").join(open_cells, ["anchor", "cell"]).where("hot OR k1 = rep")
    asked = stage(spark, wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "cell", "hot")).alias("asked")), "suffix-asked")
    once = packed_texts(docs.withColumn("_n", F.lit(0)), "_n", text_col).where(F.col("n_bytes") >= LENGTH)
    pieces = stage(spark, cut_out(once.join(asked, ["k1", "k2"])), "suffix-pieces")
    bytes_of = pieces.where("text IS NOT NULL")
    parts = max(1, -(-bytes_of.count() // PARTITION), int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = repeated_windows(bytes_of.select("anchor", "cell", "text").repartition(parts, "anchor"))
    whole = cells.where("n > 1").select("anchor", "cell", F.lit(None).cast("array<int>").alias("runs"))
    part = cells.where("n = 1").select("anchor", "cell").join(shared, ["anchor", "cell"])
    verdicts = stage(spark, whole.unionByName(part), "suffix-verdicts")
    hits = some.select("k1", "k2", "anchor", "cell").join(verdicts, ["anchor", "cell"])
    single, windows = windows_of_hot(spark, pieces.where("windows IS NOT NULL").select("k1", "k2", "anchor", "cell", "c", "windows"))
    none = F.lit(None)
    marks = hits.select("k1", "k2", F.struct("anchor", "cell", "runs").alias("f"), none.cast("array<bigint>").alias("w")).unionByName(windows.select("k1", "k2", none.cast("struct<anchor:bigint,cell:bigint,runs:array<int>>").alias("f"), "w"))
    found = marks.groupBy("k1", "k2").agg(F.collect_set("f").alias("found"), F.flatten(F.collect_set("w")).alias("windows"))
    out = stage(spark, found.join(copies, ["k1", "k2"], "full"), "suffix-found")
    drop(spark, rows, twice, some, cells, many, open_cells, asked, pieces, verdicts, *single)
    return out


def windows_of_hot(spark: SparkSession, finer_cells: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """k1, k2, w: hashes of the repeated windows among finer cells (k1, k2, anchor, cell, c, windows), and the staged tables it reads.

    Copies of a text that several tasks met are one.
    """
    counts = stage(spark, finer_cells.select("k1", "k2", "anchor", "cell", "c").distinct().groupBy("anchor", "cell").agg(F.sum("c").alias("n")), "suffix-finer")
    several = counts.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    mixed = finer_cells.groupBy("anchor", "cell").agg(F.first("windows").alias("windows")).join(counts, ["anchor", "cell"]).join(several, "anchor")
    each = stage(spark, mixed.select("anchor", "cell", "n", F.explode("windows").alias("window")), "suffix-windows")
    again = each.groupBy("window").agg(F.sum("n").alias("m")).where("m > 1").select("window")
    part = each.where("n = 1").join(again, "window").groupBy("anchor", "cell").agg(F.collect_set("window").alias("w"))
    whole = counts.where("n > 1").select("anchor", "cell", F.lit(None).cast("array<bigint>").alias("w"))
    verdicts = stage(spark, whole.unionByName(part), "suffix-finer-verdicts")
    out = finer_cells.join(verdicts, ["anchor", "cell"]).select("k1", "k2", F.coalesce("w", "windows").alias("w"))
    return [counts, each, verdicts], out


def covered(text: np.ndarray, anchor: np.ndarray, cell: np.ndarray, inner: pa.Array, single: np.ndarray) -> np.ndarray:
    """Whether each byte lies in a repeated window: of whole cells (no runs), of runs within cells, or single ones by their hash."""
    partial = np.asarray(inner.is_valid())
    keys = pair_key(anchor.view(np.uint64), cell.view(np.uint64))
    whole, some, single = keys[~partial], np.flatnonzero(partial), single.view(np.uint64)
    within = {int(keys[i]): np.array(inner[int(i)].as_py()) for i in some}
    steps = np.zeros(len(text) + 1, np.int32)

    def add(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(steps, first, 1)
        np.add.at(steps, last + LENGTH, -1)

    for base, x in stretches(text):
        own = pair_key(x.anchor, x.cell)
        i = np.flatnonzero(np.isin(own, whole))
        add(base + x.first[i], base + x.last[i])
        for i in np.flatnonzero(np.isin(own, keys[some])):
            r = base + x.first[i] + within[int(own[i])]
            add(r[::2], r[1::2])
        if len(single):
            at = base + np.flatnonzero(np.isin(x.window_hashes(np.arange(x.windows)), single))
            add(at, at)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """The id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (bytes) of every document."""
    marks = marked_texts(spark, docs, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out: list[tuple] = []
            for n, packed, copies, found, single in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), listed(b.column(4), ["anchor", "cell", "runs"]), lists(b.column(5))):
                if copies is not None:
                    out.append((n, n, 1, hashlib.sha256(b"").hexdigest(), *[b""] * with_text))
                    continue
                text = unpacked(packed, n)
                gone = covered(text, *found, single) if len(found[0]) or len(single) else np.zeros(n, bool)
                kept = text[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                out.append((n, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
            columns = list(zip(*out)) if out else [[] for _ in names[1:]]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names)

    joined = packed_texts(docs, id_col, text_col).join(marks, ["k1", "k2"], "left").select("id", "n_bytes", "packed", "copies", "found", "windows")
    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text)
