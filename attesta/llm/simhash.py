"""SimHash near-duplicates: fingerprints of word shingles, and a self-join of them in binary tries.

Fingerprints are dealt into buckets of which two near ones share at least one; the fingerprints of a bucket form a
binary trie, which is joined with itself: pairs of nodes are walked down together, their differing bits are counted,
and a pair is pruned when it has more than the budget, or when all that lies below both is linked already. Pairs are
folded into a forest as they are found, so a worker holds a bounded stretch of the walk, however dense the bucket is.

Two ways to deal:

* `links`, exact, for short fingerprints and a small budget: two that differ in at most k bits agree wholly in one of
  k + 1 blocks of bits. A block value that many fingerprints share is dealt again by blocks of its other bits; this
  loses nothing, since the budget holds for the other bits as well.
* `copy_links`, for five-word shingles and a similarity of 0.8, where 256 bits may differ in 44: blocks of some 20 bits
  are dealt under their own value and under those with the least certain bits (whose sums over the shingles are
  nearest to a tie) turned over. Nearly all bits in which near copies differ are such bits. A large bucket is cut into
  parts, and every pair of parts is joined.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import LONG_ROWS, MIX, UPPER, batches_of, hashed_words, kmers, sized, slices, stage
from attesta.llm.components import connected

SHINGLE, BITS, BUDGET, SEED = 3, 64, 2, 42
#: Near copies: words of a shingle, bits of a fingerprint, and bits that may differ. Of sets with a Jaccard similarity of
#: 0.8, 39 bits differ on average, with a standard deviation of 6.
COPY_SHINGLE, COPY_BITS, COPY_BUDGET = 5, 256, 48
#: Closer budgets whose links are candidates as well, and the similarity that verified links have.
COPY_CLOSER, COPY_LEAST = (30, 40), 0.8
#: Candidates of a fingerprint in the first round that takes all; later rounds take the rest.
FEW = 1024
#: Distinct fingerprints of one bucket that one task joins; larger buckets are dealt again.
BUCKET = 2048
#: Fingerprints that are joined at a time, and node pairs of the walk that are held at a time.
BATCH, FRONTIER = 1 << 15, 1 << 14
#: Node pairs with no more pairs of fingerprints than this are settled at once.
SETTLE = 16


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a whole text: a bit is 1 if it is set in over half the hashes of its shingles."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(UPPER).split()
    n = len(words) - SHINGLE + 1
    if not words:
        return 0
    if n <= 1:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
        n = 1
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(sizes) - sizes
        ends = starts[SHINGLE - 1 :] + sizes[SHINGLE - 1 :] - 1
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())]
    total = np.zeros(BITS, np.int64)
    values = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 65535):  # bounds the unpacked bits
        total += np.unpackbits(values[at : at + 65535], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (the fingerprint as a signed long) of every whole text; null texts have no words: fingerprint 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = np.array([fingerprint(t) for t in b.column(1).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found)], [id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


class Forest:
    """Union-find over array indices, by minimum. parent: the smallest index linked with each; ends: where the run of indices of one component ends."""

    def __init__(self, n: int):
        self.parent, self.ends = np.arange(n), np.arange(1, n + 1)

    def roots(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Link i[k] with j[k]: vectorised hooking and pointer jumping. Returns parent."""
        p = self.parent
        while len(i):
            x, y = p[i], p[j]
            np.minimum.at(p, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(q := p[p], p):
                p = q
            alive = p[i] != p[j]
            i, j = i[alive], j[alive]
        self.parent = p
        return p

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        p = self.roots(i, j)
        last = np.concatenate([np.flatnonzero(p[1:] != p[:-1]) + 1, [len(p)]])
        self.ends = last[np.searchsorted(last, np.arange(len(p)), "right")]


def trie_pairs(values: np.ndarray, bounds: np.ndarray, budget: int = BUDGET, frontier: int = FRONTIER, forest: Forest | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of values that lie in the same group and differ in at most `budget` bits, a stretch at a time.

    values: uint64 [n] or [n, words], distinct and sorted within each group; bounds: where groups start, and the end.
    Each group is a binary trie whose nodes are ranges of the sorted values. The walk keeps a stack of chunks of node
    pairs, so memory stays bounded by the frontier, whatever the data. With a forest, into which the caller links the
    pairs as they come, pairs of nodes that lie in one component are passed over, so a dense group costs little more
    than its size.
    """
    values = values[:, None] if values.ndim == 1 else values
    bits = 64 * values.shape[1]
    bit_sums: dict[int, np.ndarray] = {}

    def ones(level: int) -> np.ndarray:
        """Running sums of the bit that a trie level tests."""
        if level not in bit_sums:
            bit = (values[:, level >> 6] >> np.uint64(63 - (level & 63))) & np.uint64(1)
            bit_sums[level] = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)])
        return bit_sums[level]

    def near(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs below small node pairs that are near enough."""
        wide = d - c
        sizes = (b - a) * wide
        which = np.repeat(np.arange(len(a)), sizes)
        k = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i, j = a[which] + k // wide[which], c[which] + k % wide[which]
        ok = i < j
        if forest is not None:
            ok &= forest.parent[i] != forest.parent[j]
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(values[i] ^ values[j]).sum(1, dtype=np.int64) <= budget
        return i[ok], j[ok]

    lo, hi = bounds[:-1], bounds[1:]
    some = hi - lo > 1
    lo, hi = lo[some], hi[some]
    stack = [(0, (lo, hi, lo, hi, np.zeros(len(lo), np.int16)))]
    while stack:
        level, nodes = stack.pop()
        if len(nodes[0]) > frontier:
            half = len(nodes[0]) // 2
            stack += [(level, tuple(x[half:] for x in nodes)), (level, tuple(x[:half] for x in nodes))]
            continue
        a, b, c, d, errors = nodes
        if forest is not None:
            open_ = (forest.ends[a] < b) | (forest.ends[c] < d) | (forest.parent[a] != forest.parent[c])
            a, b, c, d, errors = (x[open_] for x in (a, b, c, d, errors))
        few = (b - a) * (d - c) <= (SETTLE if level < bits else len(values) ** 2)
        if few.any():
            i, j = near(a[few], b[few], c[few], d[few])
            if len(i):
                yield i, j
            a, b, c, d, errors = (x[~few] for x in (a, b, c, d, errors))
        if not len(a):
            continue
        sums = ones(level)
        m, n = b - (sums[b] - sums[a]), d - (sums[d] - sums[c])  # where the ones begin
        same = a == c  # a node with itself: its two children meet once
        parts = []
        for p, q, r, s, more in ((a, m, c, n, 0), (m, b, n, d, 0), (a, m, n, d, 1), (m, b, c, n, 1)):
            ok = (q > p) & (s > r) & (errors + more <= budget)
            if not more:
                ok &= ~(same & (q - p < 2))  # one value alone
            elif p is m:
                ok &= ~same
            parts.append((p[ok], q[ok], r[ok], s[ok], errors[ok] + np.int16(more)))
        stack.append((level + 1, tuple(np.concatenate(x) for x in zip(*parts))))


def trie_join(values: np.ndarray, bounds: np.ndarray, budget: int = BUDGET, frontier: int = FRONTIER) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of trie_pairs at once."""
    found = [*trie_pairs(values, bounds, budget, frontier)]
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns (key, then fingerprints as rows of uint64) of batches sorted by key, some BATCH rows at a time, keys whole."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append([b.column(0).to_numpy(), *map(words_of, b.columns[1:])])
        size += b.num_rows
        if size >= BATCH:
            columns = [np.concatenate(c) for c in zip(*held)]
            keys = columns[0]
            cut = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
            if cut:
                yield [c[:cut] for c in columns]
            held, size = [[c[cut:] for c in columns]], len(keys) - cut
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def in_groups(keys: np.ndarray, fps: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct fingerprints of keys with two rows or more, sorted within each: group (from 0), bounds, key, fps and further columns."""
    same = keys[1:] == keys[:-1]
    some = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    keys, fps, more = keys[some], fps[some], [m[some] for m in more]
    group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]])) if len(keys) else keys
    order = np.lexsort((*fps.T[::-1], group))
    group, keys, fps, more = group[order], keys[order], fps[order], [m[order] for m in more]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (fps[1:] != fps[:-1]).any(1)
    group, keys, fps, more = group[new], keys[new], fps[new], [m[new] for m in more]
    bounds = np.concatenate([np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), [len(group)]]) if len(group) else np.zeros(1, np.int64)
    return group, bounds, keys, fps, *more


def bucket_links(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Links a, b of fingerprints of one bucket, from batches (key, fp) sorted by key; fp is a long or a binary of longs.

    Whole buckets are joined, many at a time; they give a spanning forest of their links: enough for components, and
    never more rows than the bucket has. A row of the forest names a component by its first fingerprint, which need not
    be near itself.
    """
    first, batches = _peek(batches)
    if first is None:
        return
    kind = first.column(1).type
    for columns in whole_keys(batches):
        group, bounds, _, fps = in_groups(*columns)
        forest = Forest(len(group))
        for i, j in trie_pairs(fps, bounds, budget, FRONTIER, forest):
            forest.link(i, j)
        far = np.flatnonzero(forest.parent != np.arange(len(group)))
        yield pa.RecordBatch.from_arrays([written(fps[far], kind), written(fps[forest.parent[far]], kind)], ["a", "b"])


def _peek(batches: Iterator[pa.RecordBatch]) -> tuple[pa.RecordBatch | None, Iterator[pa.RecordBatch]]:
    batches = iter(batches)
    first = next(batches, None)
    return first, itertools.chain([] if first is None else [first], batches)


def first_met(a: np.ndarray, b: np.ndarray, turned_a: np.ndarray, turned_b: np.ndarray, root: np.ndarray, block: int) -> np.ndarray:
    """Whether a pair of fingerprints has no bucket (block and value: root) before this one in which both are: of those of their first block, the one with fewest ones."""
    flat = lambda x: np.unpackbits(x.astype(">u8").view(np.uint8).reshape(len(x), -1), axis=1)
    number = 64 * a.shape[1] // block
    differ = flat((a ^ b) & ~(turned_a | turned_b))[:, : number * block].reshape(len(a), number, block).any(2)
    at = root >> block
    free = flat(turned_a & turned_b)[:, : number * block].reshape(len(a), number, block)[np.arange(len(a)), at]
    ones = (root[:, None] >> np.arange(block)) & 1
    return (differ.argmin(1) == at) & ~(free & ones).any(1)


def open_links(batches: Iterator[pa.RecordBatch], budgets: tuple[int, ...], few: int, block: int | None) -> Iterator[pa.RecordBatch]:
    """Candidates key, a, b of fingerprints of one bucket, from batches (key, fp, component, turned, root) sorted by key.

    Pairs of one component are settled and passed over. Without a block's size, the pairs that are found link the two
    ends for the rest of the walk, so that a dense bucket gives few for each fingerprint. With it, every open pair is a
    candidate of the first bucket that has it, but those of which both ends had `few` already; a bucket in which such
    pairs are left has a row with null a and b.
    """
    for columns in whole_keys(batches):
        group, bounds, keys, fps, comps, turned, roots = in_groups(*columns)
        roots = roots[:, 0].astype(np.int64)
        n = len(group)
        order = np.lexsort((*comps.T[::-1], group))
        new = np.ones(n, bool)
        new[1:] = (group[order[1:]] != group[order[:-1]]) | (comps[order[1:]] != comps[order[:-1]]).any(1)
        first = order[np.maximum.accumulate(np.where(new, np.arange(n), 0))] if n else order
        known = order != first
        used, left, found, size = np.zeros(n, np.int64), np.zeros(n, bool), [], 0

        def out() -> pa.RecordBatch:
            i, j = np.unique(np.concatenate(found, 1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(keys[i]), written(fps[i], pa.binary()), written(fps[j], pa.binary())], ["key", "a", "b"])

        for most in budgets:
            forest = Forest(n)
            if known.any():
                forest.link(order[known], first[known])
            for i, j in trie_pairs(fps, bounds, most, FRONTIER, forest):
                if block:
                    own = np.concatenate([first_met(fps[x], fps[y], turned[x], turned[y], roots[x], block) for x, y in ((i[at : at + BATCH], j[at : at + BATCH]) for at in range(0, len(i), BATCH))])
                    i, j = i[own], j[own]
                place = nth(np.concatenate([i, j])).reshape(2, -1)
                some = ((used[i] + place[0]) < few) | ((used[j] + place[1]) < few)
                if block:
                    used += np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
                    left[bounds[group[i[~some]]]] = True
                else:
                    forest.link(i, j)
                found.append(np.stack([i[some], j[some]]))
                size += int(some.sum())
                if size >= BATCH:
                    yield out()
                    found, size = [], 0
        if size:
            yield out()
        again = keys[left]
        none = pa.nulls(len(again), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(again), none, none], ["key", "a", "b"])


def nth(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(values[order]) != 0)) if len(values) else values
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(new, np.diff(np.append(new, len(values))))
    return out


def words_of(fps: pa.Array) -> np.ndarray:
    """Fingerprints as rows of uint64."""
    if pa.types.is_integer(fps.type):
        return fps.to_numpy().view(np.uint64)[:, None]
    return np.frombuffer(b"".join(fps.to_pylist()), ">u8").astype(np.uint64).reshape(len(fps), -1)


def written(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    if pa.types.is_integer(kind):
        return pa.array(values[:, 0].view(np.int64))
    raw, size = values.astype(">u8").tobytes(), 8 * values.shape[1]
    return pa.array([raw[i : i + size] for i in range(0, len(raw), size)], pa.binary())


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def links(spark: SparkSession, distinct: DataFrame, budget: int = BUDGET, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp, a long) that connect all that differ in at most `budget` bits.

    Null fingerprints link with nothing; repeated ones do no harm; an empty table gives an empty result.
    """
    # A path names the blocks that were fixed so far, key their values: a bucket is (path, key)
    free = {0: list(range(BITS))}
    todo = distinct.where("fp IS NOT NULL").select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("key"))
    found: list[DataFrame] = []
    while True:
        below, steps = {}, []
        for path, bits in free.items():
            own = []
            for n, block in enumerate(x.tolist() for x in np.array_split(np.array(bits), budget + 1)):
                name = path * (budget + 1) + n + 1
                below[name] = [x for x in bits if x not in block]
                own.append(F.struct(F.lit(name).cast("long").alias("path"), F.lit(_mask(block)).cast("long").alias("mask")))
            steps += [F.lit(path).cast("long"), F.array(*own)]
        # every fingerprint is dealt once for each block of what is free on its path
        dealt = todo.withColumn("_d", F.explode(F.element_at(F.create_map(*steps), F.col("path"))))
        dealt = stage(spark, dealt.select("fp", F.col("_d.path").alias("path"), F.xxhash64("_d.path", "key", F.col("fp").bitwiseAND(F.col("_d.mask"))).alias("key")), "simhash-dealt")
        large = None
        if 1 << max(map(len, below.values())) > 4 * bucket:  # else no bucket can hold more distinct values than that
            large = stage(spark, dealt.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).drop("n"), "simhash-large")
            if large.isEmpty():
                large = None
        small = dealt if large is None else dealt.join(large, "key", "left_anti")
        found.append(small.select("key", "fp"))
        if large is None:
            every = functools.reduce(DataFrame.union, found)
            return every.repartition("key").sortWithinPartitions("key").mapInArrow(functools.partial(bucket_links, budget=budget), "a bigint, b bigint")
        todo = stage(spark, dealt.join(large, "key").select("fp", "path", "key"), "simhash-again")
        free = below


def components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id: the smallest id reachable over links.

    Equal fingerprints are one class; its smallest id stands for it, and only classes are joined. Null texts and texts
    without words have fingerprint zero and are linked like any other; rows with a null id get the component of their
    fingerprint; repeated rows share it; further columns are not read; an empty table gives an empty result.
    """
    own = stage(spark, fingerprints(docs, id_col, text_col), "simhash-docs")
    classes = stage(spark, own.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash-classes")
    label = labelled(spark, classes, links(spark, classes.select("fp")))
    return own.join(label, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def labelled(spark: SparkSession, classes: DataFrame, found: DataFrame) -> DataFrame:
    """fp, component_id: the smallest `first` of all classes (fp, first) that links reach."""
    comp = connected(spark, found)
    grouped = classes.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # staged, so that the join back on a large component has exchanges of its own, which split
    least = stage(spark, grouped.groupBy("component").agg(F.min("first").alias("component_id")), "simhash-least")
    return stage(spark, grouped.join(least, "component").select("fp", "component_id"), "simhash-labels")


def copy_print(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the distinct hashes of a text's shingles: the fingerprint's bits, and how far the sum behind each is from a tie."""
    total, words = np.zeros(bits, np.int64), bits // 64
    seeds = MIX * (2 * np.arange(words, dtype=np.uint64) + np.uint64(1))
    for at in range(0, len(codes), 1 << 14):
        with np.errstate(over="ignore"):
            y = codes[at : at + (1 << 14), None] * seeds
            y = (y ^ (y >> np.uint64(32))) * MIX
            y ^= y >> np.uint64(29)
        total += np.unpackbits(y.view(np.uint8), axis=1).sum(0, dtype=np.int64)
    margin = 2 * total - len(codes)
    return margin > 0, np.abs(margin)


def block_size(rows: int) -> tuple[int, int]:
    """Bits of a block, and how many of them are turned over, for a table of so many rows.

    A block grows with the logarithm of the table, so that buckets of unlike texts stay small; the bits turned over
    grow with it, so that near copies are found alike at any size (measured: tests, README).
    """
    extra = max(0, int(rows).bit_length() - 20)
    bits = min(40, 20 + 4 * -(-extra // 4))
    return bits, bits // 4 - 3


def copy_prints(docs: DataFrame, id_col: str, text_col: str, block: int, turned: int, shingle: int = COPY_SHINGLE, bits: int = COPY_BITS) -> DataFrame:
    """id, fp (binary), turned (mask of the bits turned over) and keys (of the buckets: block and value) of every whole text, by its distinct shingles; fewer words are one shingle."""
    kind = docs.schema[id_col].dataType.simpleString()
    number = bits // block
    place = np.uint64(1) << np.arange(block, dtype=np.uint64)
    subsets = (np.arange(1 << turned)[:, None] >> np.arange(turned)) & 1

    def keys_of(ones: np.ndarray, sure: np.ndarray) -> np.ndarray:
        own, sure = ones[: number * block].reshape(number, block), sure[: number * block].reshape(number, block)
        value = (own * place).sum(1, dtype=np.uint64)
        flips = place[np.argsort(sure, axis=1, kind="stable")[:, :turned]] @ subsets.T.astype(np.uint64)
        return (value[:, None] ^ flips | np.arange(number, dtype=np.uint64)[:, None] << np.uint64(block)).view(np.int64).ravel()

    def turned_of(sure: np.ndarray) -> bytes:
        mask = np.zeros(bits, bool)
        places = np.argsort(sure[: number * block].reshape(number, block), axis=1, kind="stable")[:, :turned]
        mask[(places + block * np.arange(number)[:, None]).ravel()] = True
        return np.packbits(mask).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps, keys, masks = [], [], []
            for text in b.column(1).to_pylist():
                codes = shingle_codes(text, shingle)
                ones, sure = copy_print(codes, bits)
                fps.append(np.packbits(ones).tobytes())
                keys.append(keys_of(ones, sure) if len(codes) else [])
                masks.append(turned_of(sure))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.binary()), pa.array(masks, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], [id_col, "fp", "turned", "keys"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, fp binary, turned binary, keys array<bigint>")


def dealt_again(dealt: DataFrame, spark: SparkSession, bucket: int) -> DataFrame:
    """Rows (key, fp, component, turned) with large buckets cut into parts: every pair of parts is a bucket of its own. root: the bucket it was cut from."""
    large = stage(spark, dealt.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "simhash-copies-large")
    dealt = dealt.withColumn("root", F.col("key"))
    if large.isEmpty():
        return dealt
    near = sized(large)
    cut = dealt.join(near, "key").withColumn("parts", F.ceil(F.col("n") / (bucket // 2)).cast("long")).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    pairs = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    again = pairs.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"), "fp", "component", "turned", "root")
    return dealt.join(near, "key", "left_anti").select("key", "fp", "component", "turned", "root").union(again)


def copy_links(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, block: int, turned: int, budget: int = COPY_BUDGET, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between classes (fp, first, keys, turned) that hold and connect all that hold of the pairs which share a bucket and differ in at most `budget` bits.

    Candidates come in rounds, and each is verified once. What holds makes components, whose pairs need no more
    comparison. The first round takes the buckets of one block and the closest pairs only, which folds a large group of
    copies; the second all buckets and pairs that are still close, some for each fingerprint; the third all buckets and
    the whole budget, the further ones only buckets in which pairs were left, with FEW times as many pairs for a
    fingerprint each time, until none are left in any.
    """
    keys = stage(spark, classes.select(F.explode("keys").alias("key"), "fp", "turned"), "simhash-copies-dealt")
    closer = tuple(min(c, budget) for c in COPY_CLOSER)
    settled, held, few, rounds = None, None, FEW, 0
    while True:
        dealt = keys if rounds else keys.where(F.col("key") < (1 << block))  # of the first block
        if held is None:
            dealt = dealt.select("key", "fp", F.col("fp").alias("component"), "turned")
        else:
            label = sized(stage(spark, connected(spark, held), "simhash-components"))
            dealt = dealt.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("component", "fp").alias("component"), "turned")
        dealt = dealt_again(dealt, spark, bucket)
        spanning = rounds < 2
        run = functools.partial(open_links, budgets=closer[: rounds + 1] if spanning else (budget,), few=1 if spanning else few, block=None if spanning else block)
        found = stage(spark, dealt.select("key", "fp", "component", "turned", F.col("root")).repartition("key").sortWithinPartitions("key").mapInArrow(run, "key bigint, a binary, b binary"), "simhash-found")
        pairs = found.where("a IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        if settled is not None:
            pairs = pairs.join(settled, ["a", "b"], "left_anti")
        pairs = stage(spark, pairs, "simhash-candidates")
        holds = verified(spark, docs, id_col, text_col, classes, pairs)
        held, settled = (holds, pairs) if held is None else (held.union(holds), settled.union(pairs))
        if not spanning:
            marked = found.where("a IS NULL").select("key").distinct()
            # the buckets that the marked ones are parts of
            left = stage(spark, dealt.join(sized(stage(spark, marked, "simhash-marked")), "key", "left_semi").select(F.col("root").alias("key")).distinct(), "simhash-left")
            if left.isEmpty():
                return held
            keys = stage(spark, keys.join(sized(left), "key", "left_semi"), "simhash-copies-open")
            few *= FEW
        rounds += 1


def shingle_codes(text: str | None, shingle: int = COPY_SHINGLE) -> np.ndarray:
    """Distinct hashes of the shingles of a text, sorted; fewer words are one shingle."""
    words = hashed_words(text or "")[0]
    return np.unique(kmers(words, min(shingle, max(1, len(words)))))


def verified(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, pairs: DataFrame, least: float = COPY_LEAST) -> DataFrame:
    """Of distinct staged pairs a < b of classes (fp, first), those whose texts have a similarity of `least` or more over their distinct shingles, as a / b of equal hashes.

    One text stands for a class: that of its smallest id. Only the texts of linked classes are read again, and only
    their hashes travel. A class without an id has no text to compare and links with nothing.
    """
    ends = stage(spark, pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(classes.select("fp", F.col("first").alias(id_col)), "fp"), "simhash-ends")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            codes = [shingle_codes(t) for t in b.column(1).to_pylist()]
            prints = [np.packbits(copy_print(c, COPY_BITS)[0]).tobytes() for c in codes]
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary())], ["fp", "codes"])

    own = docs.select(F.col(id_col), F.col(text_col)).join(sized(ends.select(id_col).distinct()), id_col, "left_semi")
    # rows that repeat an id may have other texts: the fingerprint says whose codes they are
    with batches_of(spark, LONG_ROWS):
        codes = stage(spark, own.mapInArrow(coded, "fp binary, codes binary").dropDuplicates(["fp"]), "simhash-codes")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= least * max(len(x), len(y)) else 0
                keep.append(common >= least * (len(x) + len(y) - common) and common > 0)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(codes.select(F.col("fp").alias("a"), F.col("codes").alias("x")), "a").join(codes.select(F.col("fp").alias("b"), F.col("codes").alias("y")), "b")
    with batches_of(spark, LONG_ROWS):
        return stage(spark, both.select("a", "b", "x", "y").mapInArrow(alike, "a binary, b binary"), "simhash-alike")


def near_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = COPY_BUDGET, bucket: int = BUCKET) -> DataFrame:
    """One row per input row: id, component_id: the smallest id reachable over near copies, itself included.

    Texts are near copies if their sets of five-word shingles have a similarity of 0.8 or more. Candidates are pairs whose
    256-bit fingerprints differ in at most `budget` bits; each link between them is verified on the shingles' hashes
    before components are made. Equal fingerprints are one class. Null texts and texts without words are one class that links
    with no other; rows with a null id get the component of their class; repeated rows share it; further columns are
    not read; an empty table gives an empty result.
    """
    block, turned = block_size(docs.count())
    with batches_of(spark, LONG_ROWS):
        own = stage(spark, copy_prints(docs, id_col, text_col, block, turned), "simhash-copies")
    classes = stage(spark, own.groupBy("fp").agg(F.min(id_col).alias("first"), F.min(F.struct("keys", "turned")).alias("k")).select("fp", "first", "k.keys", "k.turned"), "simhash-copy-classes")
    links = copy_links(spark, docs, id_col, text_col, classes, block, turned, budget, bucket)
    label = labelled(spark, classes.select("fp", "first"), links)
    return own.select(id_col, "fp").join(label, "fp").select(id_col, "component_id")
