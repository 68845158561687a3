"""Divergence of sources within a language: how differently each pair of sources, and each source and its language, use terms.

For a pair of sources of one language the distinct pairs of counts (of a term in the one, and in the other) are
tallied, and what the pair of counts contributes is evaluated once for each and multiplied by its tally. Tasks tally
the terms that both sources have; what only one or neither has are cells implied by the tallies of each source alone
and the number of terms, so a term costs what it has sources, not the square of all sources.

All arithmetic is exact: counts are long, and the scaled share 1 + floor(10**9 (count + 5) / (N + 5 V)) is taken in
whole decimals.

Cases: null text, language and source are empty ones. A group without any kept term still has rows: all its counts are
0. A language without kept terms has pairs of value 0 and no terms; one with a single source has no pairs. Documents
count as often as there are rows, whatever their ids, which are not read; nor are further columns. Ties are in the
order of the item's UTF-8 bytes, so ranks are unique. An empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.llm.common import UPPER, slices, stage

#: Documents of its language that a kept term is in at least, and terms that are reported of a group.
LEAST, MOST = 30, 50
#: Distinct terms that a task counts before it hands them on.
HELD = 400_000
#: Sources of one language in a block; tallies are made for pairs of blocks.
BLOCK = 128
#: Pairs of counts that are tallied at a time.
PAIRS = 1 << 20
#: What is no part of a term becomes a blank; A-Z become a-z.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in (UPPER[i] for i in range(256)))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, c (occurrences), n (documents), added up within tasks; a row with a null term for each group."""

    def flush(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (c, n) in held.items():
            words = list(c)
            for at in range(0, len(words) + 1, 50_000):
                part = words[at : at + 50_000]
                size = len(part) + (at == 0)  # the group itself, once
                columns = [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array([*part, *[None] * (at == 0)], pa.binary()).cast(pa.string())]
                columns += [pa.array([*map(c.__getitem__, part), *[0] * (at == 0)], pa.int64()), pa.array([*map(n.__getitem__, part), *[0] * (at == 0)], pa.int64())]
                if size:
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "c", "n"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in slices(batches):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                c, n = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(c)
                own = Counter(terms(text))
                c.update(own)
                n.update(own.keys())
                size += len(c) - before
                if size > HELD:
                    yield from flush(held)
                    size = 0
        yield from flush(held)

    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(blank("lang").alias("lang"), blank("source").alias("source"), blank("text").alias("text")).mapInArrow(run, "lang string, source string, term string, c bigint, n bigint")


def share(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(10**9 (count + 5) / (total + 5 kept)), in whole decimals; null where the language has no term."""
    whole = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
    above = (F.lit(10**9).cast("decimal(10,0)") * (whole(count) + 5)).cast("decimal(30,0)")
    below = (whole(total) + whole(kept) * 5).cast("decimal(30,0)")
    return F.when(whole(kept) > 0, F.call_function("div", above, F.when(below > 0, below)) + 1)


def tallied(kept: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """lang, a < b, ca, cb, m: how many of a task's terms have count ca > 0 in source a and cb > 0 in source b.

    kept: lang, term, lo, hi (blocks), side, place (of the source, in order of its name), c; rows of a term, language
    and pair of blocks lie in one partition, sorted by them.
    """
    names = ["lang", "a", "b", "ca", "cb", "m"]

    def tally(lang: str, start: np.ndarray, sides: np.ndarray, place: np.ndarray, c: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        # rows i < j of one term: a row is repeated for each one after it
        n = len(place)
        stop = np.append(start[1:], n)
        end = np.repeat(stop, stop - start)
        many = end - np.arange(n) - 1
        at = 0
        total = np.cumsum(many)
        while at < n:
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + pairs, "right")))
            i = np.repeat(np.arange(at, to), many[at:to])
            j = i + 1 + (np.arange(len(i)) - np.repeat(np.cumsum(many[at:to]) - many[at:to], many[at:to]))
            at = to
            if not same:
                keep = sides[i] != sides[j]
                i, j = i[keep], j[keep]
            if not len(i):
                continue
            first = place[i] < place[j]
            a, b = np.where(first, i, j), np.where(first, j, i)
            cells = np.stack([place[a], place[b], c[a], c[b]])
            cells = cells[:, np.lexsort(cells[::-1])]
            new = np.flatnonzero(np.append(True, (cells[:, 1:] != cells[:, :-1]).any(0)))
            m = np.diff(np.append(new, cells.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(new), pa.string()), *[pa.array(v[new]) for v in cells], pa.array(m)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            for i in range(0, b.num_rows, 1 << 16):
                held.append(b.slice(i, 1 << 16))
                table = pa.Table.from_batches(held).combine_chunks()
                # the last term may go on in the next batch
                last = table.slice(table.num_rows - 1).to_pylist()[0]
                same = np.ones(table.num_rows, bool)
                for k in ("lang", "lo", "hi", "term"):
                    same &= np.asarray(pc.equal(table.column(k), last[k]))
                cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if cut:
                    yield from parts(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
        if held:
            yield from parts(pa.Table.from_batches(held))

    def parts(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        codes = {k: np.asarray(table.column(k).chunk(0).dictionary_encode().indices) for k in ("lang", "term")}
        lo, hi, sides, place, c = (np.asarray(table.column(k)) for k in ("lo", "hi", "side", "place", "c"))
        edge = lambda *cols: np.flatnonzero(np.append(True, np.any([v[1:] != v[:-1] for v in cols], axis=0)))
        outer = edge(codes["lang"], lo, hi)
        for at, to in zip(outer, np.append(outer[1:], len(lo))):
            rows = slice(at, to)
            yield from tally(table.column("lang")[int(at)].as_py(), edge(codes["term"][rows]), sides[rows], place[rows], c[rows], lo[at] == hi[at])

    return kept.select("lang", "term", "lo", "hi", "side", "place", "c").mapInArrow(run, "lang string, a bigint, b bigint, ca bigint, cb bigint, m bigint")


def audit(spark: SparkSession, docs: DataFrame, least: int = LEAST, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: for each group the other sources of its language, and the terms it has more of, by value."""
    found = stage(spark, term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "divergence-counts")
    used = found.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("c").alias("q")).where(F.col("n") >= least).select("lang", "term", "q")
    by_lang = used.groupBy("lang").agg(F.count("*").alias("v"), F.sum("q").alias("total"))
    kept = stage(spark, found.join(used, ["lang", "term"]).select("lang", "source", "term", "c", "q"), "divergence-kept")
    own = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    named = found.where("term IS NULL").select("lang", "source").join(own, ["lang", "source"], "left").join(by_lang, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1  # one row for each source
    groups = stage(spark, named.select("lang", "source", place.alias("place"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), "total"), "divergence-groups")
    facts = kept.join(groups, ["lang", "source"])
    pairs = pair_values(spark, facts, groups, block)
    more = facts.select("lang", "source", "term", (share("c", "n", "v") - share("q", "total", "v")).alias("value")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    one = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    two = more.withColumnRenamed("term", "item").select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= most)
    return one.unionByName(two)


def pair_values(spark: SparkSession, facts: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, source, item (each other source of the language), value. facts: lang, term, place, c; groups: lang, source, place, n, v."""
    blocks = groups.groupBy("lang").agg((F.floor(F.max("place") / block) + 1).alias("blocks"))
    dealt = facts.select("lang", "term", "place", "c").join(blocks, "lang").withColumn("side", F.floor(F.col("place") / block)).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("side", "_o")).withColumn("hi", F.greatest("side", "_o"))
    together = dealt.repartition("lang", "lo", "hi", "term").sortWithinPartitions("lang", "lo", "hi", "term", "place")
    both = tallied(together).groupBy("lang", "a", "b", "ca", "cb").agg(F.sum("m").alias("m"))
    single = facts.groupBy("lang", "place", "c").agg(F.count("*").alias("m"))
    x, y = groups.alias("x"), groups.alias("y")
    pairs = x.join(y, (F.col("x.lang") == F.col("y.lang")) & (F.col("x.place") < F.col("y.place")))  # as many as the result has rows
    pairs = pairs.select("x.lang", F.col("x.place").alias("a"), F.col("y.place").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"), "x.v", F.col("x.source").alias("sa"), F.col("y.source").alias("sb"))
    pairs = stage(spark, pairs, "divergence-pairs")
    both = stage(spark, both, "divergence-cells")
    zero = F.lit(0).cast("long")
    cell = lambda df, ca, cb, m: df.select("lang", "a", "b", ca.alias("ca"), cb.alias("cb"), m.alias("m"))
    m = F.col("m")
    left = pairs.select("lang", "a", "b").join(single.withColumnRenamed("place", "a"), ["lang", "a"])
    right = pairs.select("lang", "a", "b").join(single.withColumnRenamed("place", "b"), ["lang", "b"])
    # a term of both is one cell; what each source has beside those, and the terms of neither, are what is left of its own tally and of v
    signed = F.explode(F.array(F.struct(F.col("ca").alias("x"), F.col("cb").alias("y"), m.alias("w")), F.struct(F.col("ca").alias("x"), zero.alias("y"), (-m).alias("w")), F.struct(zero.alias("x"), F.col("cb").alias("y"), (-m).alias("w")), F.struct(zero.alias("x"), zero.alias("y"), m.alias("w"))))
    edge = lambda x, y: F.explode(F.array(F.struct(x.alias("x"), y.alias("y"), m.alias("w")), F.struct(zero.alias("x"), zero.alias("y"), (-m).alias("w"))))
    cells = both.select("lang", "a", "b", signed.alias("s")).unionByName(left.select("lang", "a", "b", edge(F.col("c"), zero).alias("s"))).unionByName(right.select("lang", "a", "b", edge(zero, F.col("c")).alias("s")))
    cells = cell(cells, F.col("s.x"), F.col("s.y"), F.col("s.w")).unionByName(cell(pairs, zero, zero, F.col("v")))
    cells = cells.groupBy("lang", "a", "b", "ca", "cb").agg(F.sum("m").alias("m")).where("m <> 0")
    each = cells.join(pairs, ["lang", "a", "b"]).withColumn("f", F.abs(share("ca", "na", "v") - share("cb", "nb", "v")))
    summed = each.groupBy("lang", "a", "b").agg(F.sum(F.col("f") * m).alias("value"))
    values = pairs.join(summed, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", zero))
    turned = F.explode(F.array(F.struct(F.col("sa").alias("source"), F.col("sb").alias("item")), F.struct(F.col("sb").alias("source"), F.col("sa").alias("item"))))
    return values.select("lang", turned.alias("t"), "value").select("lang", "t.source", "t.item", "value")
