"""Near-duplicate components by HyperMinHash sketches, verified on full shingle sets.

A text's words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; its set holds the distinct shingles of
``shingle`` words (one shingle of all words where there are fewer). Two documents are linked when
100 * intersection >= percent * union.

1. ``_sketch``: one pass over the texts. The set is hashed (64 bits a shingle); equal sets meet by a
   128-bit digest of the whole set and only one document of each goes on. Each of 128 buckets keeps
   its least hash as a leading-zero count and ten mantissa bits; empty buckets borrow from others.
2. Banding: 25 bands of 5 compressed registers. Documents that share a band are compared by the
   collision-corrected estimate, and those that may be linked are tied: a spanning forest of at most
   m - 1 ties for m members, whatever the number of pairs. The estimate may miss by over five
   standard deviations before a link is lost.
3. The ties' connected components are the clusters. The members' texts go to their cluster, each
   text once, and ``_verified`` computes exact Jaccard values on full sets there through an inverted
   index, emitting a spanning forest of true links. A cluster over ``block_shingles`` is dealt to
   blocks by hash and verified block by block; then one leader per block and group of linked members
   meets the others. What is then linked throughout is finished, so a hot group of near copies costs
   one pass. Of the rest (``_unsettled``) only cells of different groups meet, and only where their
   sets' sizes allow a link.
4. The links' components, with the copies of each set, are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.arrays import LOWER, U64, gram_hashes, mix, release, slices, word_hashes, word_spans
from sentrylake.operators.components import connected_components
from sentrylake.operators.ranking import NARROW_ROWS, if_small, join_hot, running_total
from sentrylake.session import materialise

BUCKETS, BAND, MANTISSA = 128, 5, 10
BANDS = BUCKETS // BAND
_SEEDS = mix(np.arange(1, 65, dtype=U64) * U64(0x9E3779B97F4A7C15))
#: Which registers make up a band: a fixed shuffle, so borrowed neighbours fall into different bands.
_ORDER = np.argsort(mix(np.arange(BUCKETS, dtype=U64) + U64(77)), kind="stable")[: BANDS * BAND]

_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())])
_SKETCH_DDL = "doc_id bigint, n bigint, digest binary, sketch binary"


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each row."""
    for lo, hi, data, offsets in slices(column):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        grams = gram_hashes(hashes, shingle)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= shingle:
                yield np.unique(grams[a : b - shingle + 1])
            elif b > a:
                yield gram_hashes(hashes[a:b], int(b - a), seed=int(b - a))
            else:
                yield np.zeros(0, U64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers (rows x BUCKETS, 16 bits: leading zeros and mantissa) of non-empty sets."""
    n = len(sets)
    least = np.full(n * BUCKETS, np.iinfo(U64).max, U64)
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    np.minimum.at(least, rows * BUCKETS + (values & U64(BUCKETS - 1)).astype(np.int64), values >> U64(7))
    exponent = np.frexp(np.maximum(least, U64(1)).astype(np.float64))[1].astype(np.int64)
    exponent = np.minimum(exponent, 57)
    zeros = (57 - exponent).astype(U64)
    mantissa = ((least << zeros) >> U64(56 - MANTISSA)) & U64((1 << MANTISSA) - 1)
    packed = ((zeros << U64(MANTISSA)) | mantissa).astype(np.uint16).reshape(n, BUCKETS)
    empty = (least == np.iinfo(U64).max).reshape(n, BUCKETS)
    if not empty.any():
        return packed
    out, todo = packed.copy(), empty.copy()
    places = np.arange(BUCKETS, dtype=U64)
    for seed in _SEEDS:  # borrow from pseudo-random buckets, the same ones for every document
        source = (mix(places + seed) & U64(BUCKETS - 1)).astype(np.int64)
        take = todo & ~empty[:, source]
        out[take] = (packed[:, source] ^ (seed & U64(0xFFFF)).astype(np.uint16))[take]
        todo &= ~take
        if not todo.any():
            return out
    for step in range(1, BUCKETS):
        source = (np.arange(BUCKETS) + step) % BUCKETS
        take = todo & ~empty[:, source]
        out[take] = (packed[:, source] + np.uint16(step))[take]
        todo &= ~take
    return out


def _sketch(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        at, sets, rows = 0, [], []

        def flush(ids=ids):
            nonlocal sets, rows, at
            full = [s for s in sets if len(s)]
            regs = iter(registers(full)) if full else iter(())
            out = [(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None, next(regs).tobytes() if len(s) else None) for s in sets]
            made = pa.RecordBatch.from_arrays([ids.slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())], schema=_SKETCH)
            at, sets = at + len(sets), []
            return made

        size = 0
        for s in shingle_sets(batch.column(1), shingle):
            sets.append(s)
            size += len(s)
            if len(sets) >= 2000 or size > 2_000_000:
                yield flush()
                size = 0
        if sets:
            yield flush()


_BAND = pa.schema([("band", pa.int64()), ("doc_id", pa.int64())])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = mix(np.arange(1, BANDS * BAND + 1, dtype=U64) + U64(991)) | U64(1)
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)[:, _ORDER]
        keys = mix(((mix(regs.astype(U64) + U64(1)) * weights).reshape(-1, BANDS, BAND)).sum(-1, dtype=U64) + np.arange(BANDS, dtype=U64))
        ids = np.repeat(np.asarray(batch.column(0)), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], schema=_BAND)


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _chances(sizes: np.ndarray) -> np.ndarray:
    """Rows whose inner products are the shares of registers that are equal by chance."""
    level = 2.0 ** np.arange(1, 48)
    load = (np.maximum(sizes, 1) / BUCKETS)[:, None]
    return (np.exp(-load / level) - np.exp(-2 * load / level)) / 2 ** (MANTISSA / 2)


def estimate(regs: np.ndarray, chances: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of one row with others."""
    equal = (regs[others] == regs[one]).mean(1)
    by_chance = chances[others] @ chances[one]
    return (equal - by_chance) / (1 - by_chance)


#: Sets under this many shingles are too small for an estimate; the larger of two linked sets around
#: it is under the second figure.
_SMALL, _SMALLISH = 64, 80


def band_ties(ids: np.ndarray, regs: np.ndarray, sizes: np.ndarray, least: float) -> list[tuple[int, int]]:
    """At most one tie less than members, connecting all pairs that may be linked.

    A pair may be linked if its estimate is ``least`` or more; among sets too small to estimate,
    every pair may. A member is compared only with those that it is not yet connected to.
    """
    n, forest, ties = len(ids), Forest(len(ids)), []
    small = np.flatnonzero(sizes < _SMALLISH)
    for k in small[1:]:
        forest.join(int(small[0]), int(k))
        ties.append((int(ids[k]), int(ids[small[0]])))
    large = np.flatnonzero(sizes >= _SMALL)
    if len(large) < 2:
        return ties
    chances = _chances(sizes)
    label = np.array([forest.root(k) for k in range(n)])
    for one in large.tolist():
        others = large[label[large] != label[one]]
        if not len(others):
            if (label == label[0]).all():
                break
            continue
        others = others[others > one]
        near = others[estimate(regs, chances, one, others) >= least] if len(others) else others
        for k in near.tolist():
            if label[k] != label[one]:
                ties.append((int(ids[k]), int(ids[one])))
                label[label == label[k]] = label[one]
    return ties


_TIES = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Rows with one value of an integer column after another; the input is sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.asarray(batch.column(key))
        if not len(keys):
            continue
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges = [0, *cuts.tolist(), len(keys)]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if held and lo == 0 and np.asarray(held[-1].column(key))[-1] != keys[0]:
                yield pa.Table.from_batches(held)
                held = []
            elif lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _tied(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Input sorted by band: (band, doc_id, n, sketch). Output: ties without repeats in a task's reach."""
    ties: set[tuple[int, int]] = set()
    for group in _groups(batches, 0):
        if group.num_rows < 2:
            continue
        ids = group.column(1).to_numpy()
        order = np.argsort(ids, kind="stable")
        regs = np.frombuffer(b"".join(group.column(3).to_pylist()), np.uint16).reshape(-1, BUCKETS)
        ties.update(band_ties(ids[order], regs[order], group.column(2).to_numpy()[order], least))
        if len(ties) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array([t[k] for t in ties], pa.int64()) for k in (0, 1)], schema=_TIES)
            ties = set()
    if ties:
        yield pa.RecordBatch.from_arrays([pa.array([t[k] for t in ties], pa.int64()) for k in (0, 1)], schema=_TIES)


#: From so few sets on, a set is held against each by itself and not through the index.
_FEW = 48


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the exact links between the sets, through an inverted index of shingles.

    A set is held only against those that it is not yet connected to, so a group of near copies costs
    about a pass over its sets and not one a member.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets) if n else np.zeros(0, U64)
    rows = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    uniq, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    post, start = rows[order], np.concatenate([[0], np.cumsum(counts)])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    label, members, links = np.arange(n), {}, []
    for x in range(n - 1):
        terms = inverse[ends[x] : ends[x + 1]]
        terms = terms[counts[terms] > 1]
        length = counts[terms]
        reach = int(length.sum())
        dense = reach >= n
        if dense:
            others = np.flatnonzero(label[x + 1 :] != label[x]) + x + 1
            # sizes alone rule out what cannot reach the share
            others = others[100 * np.minimum(sizes[others], sizes[x]) >= percent * np.maximum(sizes[others], sizes[x])]
        if not reach or (dense and not len(others)):
            continue
        if dense and len(others) <= _FEW:
            shared = np.array([np.intersect1d(sets[x], sets[y], assume_unique=True).size for y in others.tolist()], np.int64)
        else:
            at = np.arange(reach) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start[terms], length)
            met = post[at]
            if dense:
                shared = np.bincount(met, minlength=n)[others]
            else:
                others, shared = np.unique(met[(met > x) & (label[met] != label[x])], return_counts=True)
        union = sizes[others] + sizes[x] - shared
        for y in others[(100 * shared >= percent * union) & (shared > 0)].tolist():
            if label[x] != label[y]:
                links.append((x, y))
                # the smaller side takes the other's label
                small, large = sorted((int(label[x]), int(label[y])), key=lambda k: len(members.get(k, (k,))))
                moved = members.pop(small, [small])
                label[moved] = large
                members.setdefault(large, [large]).extend(moved)
    return links


def _verified(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Input sorted by pair: (pair, doc_id, text). Output: verified links."""
    out: list[tuple[int, int]] = []
    for group in _groups(batches, 0):
        if group.num_rows < 2:
            continue
        ids = group.column(1).to_numpy()
        sets = [s for chunk in group.column(2).chunks for s in shingle_sets(chunk, shingle)]
        out += [(int(ids[x]), int(ids[y])) for x, y in spanning_links(sets, percent)]
        if group.num_rows > 1000:
            del sets
            release()
        if len(out) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array([t[k] for t in out], pa.int64()) for k in (0, 1)], schema=_TIES)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([t[k] for t in out], pa.int64()) for k in (0, 1)], schema=_TIES)


def _links(texts: DataFrame, dealt: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(src, dst): true links among the texts that ``dealt`` (doc_id, pair) puts together."""
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    grouped = texts.join(dealt, "doc_id").select("pair", "doc_id", "text").repartition(parts, "pair").sortWithinPartitions("pair", "doc_id")
    return grouped.mapInArrow(partial(_verified, shingle=shingle, percent=percent), "src bigint, dst bigint")


def _grouped(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with ``part``, the least member that links lead to."""
    found = connected_components(links).withColumnRenamed("component", "part")
    return members.join(found, "node", "left").withColumn("part", F.coalesce("part", "node"))


def _settled(texts: DataFrame, members: DataFrame, shingle: int, percent: int, block_shingles: int) -> DataFrame:
    """(src, dst) links of clusters that are larger than a block; members has node, component, n, blocks.

    Exact: two members end in one component exactly if links lead from one to the other. Every pair of
    members of different groups whose sizes allow a link meets; members of one group need not.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = materialise(members.withColumn("block", block), "large-members")
    inside = materialise(_links(texts, members.select(F.col("node").alias("doc_id"), F.xxhash64("component", "block").alias("pair")), shingle, percent), "block-links")
    # one leader of each group of a block; leaders of a cluster meet in as few blocks as hold them
    leaders = _grouped(members, inside).groupBy("component", "block", "part").agg(F.min_by(F.struct("node", "n"), "node").alias("l")).select("component", "l.*")
    room = leaders.groupBy("component").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("rooms"))
    met = leaders.join(room, "component").select(F.col("node").alias("doc_id"), F.xxhash64("component", F.lit(1), F.pmod(F.xxhash64("node", F.lit(1)), "rooms")).alias("pair"))
    between = materialise(_links(texts, met, shingle, percent), "leader-links")
    links = inside.unionByName(between)
    rest = _unsettled(_grouped(members, links), percent, block_shingles)
    return links.unionByName(_links(texts, rest, shingle, percent))


def _unsettled(members: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """(doc_id, pair): members of clusters that are not one group yet, once for each cell that theirs must meet.

    A cell holds members of one large group, or of several small ones, of one class of sizes; sets that
    may be linked differ by one class at most. Cells of one large group do not meet.
    """
    several = members.groupBy("component").agg(F.count_distinct("part").alias("groups")).where("groups > 1").select("component")
    members = materialise(members.join(several, "component"), "unsettled")
    loads = members.groupBy("component", "part").agg(F.sum("n").alias("load"))
    small = F.col("load") <= block_shingles // 2
    bins = loads.groupBy("component").agg(F.greatest(F.ceil(F.sum(F.when(small, F.col("load"))) / block_shingles), F.lit(1)).alias("bins"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)))) if percent < 100 else F.col("n")
    placed = members.drop("load").join(loads, ["component", "part"]).join(bins, "component").withColumn("size", size_class.cast("bigint"))
    owner = F.when(~small, F.col("part"))
    slot = F.when(small, F.pmod(F.xxhash64("part"), "bins")).otherwise(F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("load") / block_shingles)))
    placed = placed.withColumn("owner", owner).withColumn("cell", F.xxhash64("component", "owner", slot.cast("bigint"), "size"))
    placed = materialise(placed.select("node", "component", "owner", "size", "cell"), "cells")
    cells = placed.select("component", "owner", "size", "cell").distinct()
    other = cells.select("component", F.col("owner").alias("owner2"), F.col("size").alias("size2"), F.col("cell").alias("cell2"))
    pairs = cells.join(other, "component").where("cell <= cell2 AND abs(size - size2) <= 1 AND (owner IS NULL OR owner2 IS NULL OR owner <> owner2)")
    pairs = pairs.select("cell", "cell2", F.xxhash64("cell", "cell2").alias("pair"))
    ends = pairs.select("cell", "pair").unionByName(pairs.select(F.col("cell2").alias("cell"), "pair")).distinct()
    return placed.select(F.col("node").alias("doc_id"), "cell").join(ends, "cell").select("doc_id", "pair")


def near_components(docs: DataFrame, shingle: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", block_shingles: int = 1_000_000, most_members: int = 10_000) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    A text that is null or has no word has the empty set and is linked with nothing. component_id is
    the least id reachable through links; kept marks it. Rows that repeat an id are one document: any
    of its texts links it, and its rows that have words share one component. Rows with a null id are
    left alone: no links, component null, kept true. Texts of any length are read whole; equal texts
    are one set; other columns are ignored whatever their names. An empty table gives an empty result.

    ``most_members`` and ``block_shingles`` bound what a task holds, not what is found: a band with more
    members ties all of them to its first without estimates, a cluster with more shingles is verified
    in blocks (``_settled``).
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = materialise(texts.mapInArrow(partial(_sketch, shingle=shingle), _SKETCH_DDL), "sketches")
    known = sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    # equal sets: the least id stands for all
    classes = materialise(known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("copies")), "set-classes")
    # an id of several texts is no name for one set
    again = known.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b")
    if not again.isEmpty():
        return _apart(docs, shingle, percent, id_col, text_col, block_shingles, most_members)
    reps = classes.select(F.col("rep").alias("doc_id"), "n", "sketch")
    # sets of so few shingles are linked to equal ones only
    least = next(k for k in range(1, 1000) if 100 * (k - 1) >= percent * k) if percent < 100 else None
    big = reps.where(F.col("n") >= (least - 1 if least else 1 << 60))
    banded = big.select("doc_id", "sketch").mapInArrow(_bands, "band bigint, doc_id bigint")
    shared = banded.groupBy("band").agg(F.count("*").alias("c"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("band", "c", "lo")
    shared = materialise(shared, "shared-bands")
    meet = join_hot(banded, shared, "band", "c", BANDS * classes.count(), bound=NARROW_ROWS)
    wide = F.col("c") > most_members
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = meet.where(~wide).join(big, "doc_id").select("band", "doc_id", "n", "sketch")
    ordered = placed.repartition(parts, "band").sortWithinPartitions("band", "doc_id")
    # five standard deviations of an estimate from ``_SMALL`` effective registers, and some more
    spread = (percent / 100 * (1 - percent / 100) / _SMALL) ** 0.5
    ties = ordered.mapInArrow(partial(_tied, least=percent / 100 - 7 * spread), "src bigint, dst bigint")
    ties = ties.unionByName(meet.where(wide & (F.col("doc_id") != F.col("lo"))).select(F.col("doc_id").alias("src"), F.col("lo").alias("dst")))
    clusters = connected_components(ties)
    members = materialise(clusters.join(reps.select(F.col("doc_id").alias("node"), "n"), "node"), "members")
    blocks = members.groupBy("component").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"))
    large = materialise(blocks.where("blocks > 1"), "large-clusters")
    alone = members.join(large, "component", "left_anti")
    links = _links(texts, alone.select(F.col("node").alias("doc_id"), F.xxhash64("component").alias("pair")), shingle, percent)
    if not large.isEmpty():
        links = links.unionByName(_settled(texts, members.join(large, "component"), shingle, percent, block_shingles))
    return _named(sketches, classes, links)


def _named(sketches: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every sketched row, from the links between classes."""
    found = connected_components(links)
    named = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("digest", "copies", F.coalesce("component", "rep").alias("component_id"))
    named = materialise(named, "named-classes")
    total = named.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    rows = sketches.select("doc_id", "n", "digest")
    joined = join_hot(rows.where("digest IS NOT NULL"), named, "digest", "copies", total, "left", bound=NARROW_ROWS).select("doc_id", "n", "component_id")
    joined = joined.unionByName(rows.where("digest IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _apart(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, block_shingles: int, most_members: int) -> DataFrame:
    """The way for tables in which an id has several texts: each (id, text) is a document, then ids link theirs.

    Distinct (id, text) rows are numbered in order of id, so the least number stands for the least id.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    pairs = texts.where("doc_id IS NOT NULL").select("doc_id", mark.alias("mark")).distinct()
    numbers = materialise(running_total(pairs, F.lit(1), "doc_id", "mark").select("doc_id", "mark", F.col("total").alias("number")), "numbers")
    once = texts.where("doc_id IS NOT NULL").withColumn("mark", mark).dropDuplicates(["doc_id", "mark"]).join(numbers, ["doc_id", "mark"])
    made = materialise(near_components(once.select("number", "text"), shingle, percent, "number", "text", block_shingles, most_members), "numbered").withColumnRenamed("doc_id", "number")
    full = made.join(numbers, "number")
    edges = full.where("n_shingles > 0").select(F.col("number").alias("src"), F.col("component_id").alias("dst"))
    ids = full.where("n_shingles > 0").groupBy("doc_id").agg(F.min("number").alias("dst"))
    edges = edges.unionByName(full.where("n_shingles > 0").select("doc_id", "number").join(ids, "doc_id").select(F.col("number").alias("src"), "dst"))
    found = connected_components(edges)
    least = found.join(numbers.select(F.col("number").alias("component"), F.col("doc_id").alias("least")), "component").select(F.col("node").alias("number"), "least")
    told = full.join(least, "number", "left").select("doc_id", "mark", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    rows = texts.withColumn("mark", mark)
    joined = rows.where("doc_id IS NOT NULL").select("doc_id", "mark").join(told, ["doc_id", "mark"])
    lost = sketch_sizes(rows.where("doc_id IS NULL"), shingle).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    out = joined.select("doc_id", "n_shingles", "component_id").unionByName(lost)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def sketch_sizes(texts: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n): how many distinct shingles each text has."""
    return texts.select("doc_id", "text").mapInArrow(partial(_sketch, shingle=shingle), _SKETCH_DDL).select("doc_id", "n")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose document stands for its component (its least id).

    An id goes with all its rows if it is not the least of its component; rows without an id stay.
    """
    goes = materialise(near_components(docs, shingle, percent, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("__goes")).distinct(), "replaced-ids")
    return docs.join(if_small(goes), docs[id_col] == goes["__goes"], "left_anti")
