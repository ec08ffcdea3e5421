"""Substring dedup of word sequences by prefix-partitioned suffix trees.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if some window of ``window`` words that covers it
also starts earlier in the corpus (smaller id, or same document and earlier place).

The suffixes of all texts are never dealt out whole. Each window hands itself to its anchor, the
leftmost least hash among its five-word grams: equal windows have equal anchors, and runs of windows
share one, so an anchor's gram is the prefix by which suffixes are partitioned.

1. ``_anchors`` lists each text's anchor grams; a gram that occurs once in the corpus starts no repeat.
   A gram that a task sees twice is announced once, so a common passage costs a row per task.
2. ``_segments`` cuts, from texts with repeated grams, the words around each such anchor. Equal
   segments of a task are combined: the earliest goes on, the others are repeats already.
3. Segments meet by gram. The suffixes of a gram with over ``group_bytes`` bytes of segments are dealt by
   longer prefixes, their own first 10, then 15 words, so that each group fits a task's memory; what
   10 or 15 words do not part is a node by itself, grouped by whole windows with map-side combining.
4. ``_subtree`` builds the suffix tree of a group (suffixes in order with their common prefixes, word by
   word). Its internal nodes of depth ``window`` and more that cannot be extended to the left are the
   maximal repeats; the leaf that starts first stays, the others are repeats.
5. ``_kept`` covers the repeats of each text that has any and joins what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.llm.arrays import U64, gram_hashes, mix, release, slices, word_hashes, word_spans
from sentrylake.operators.ranking import if_small, join_hot
from sentrylake.session import materialise

GRAM = 5
#: A tree is built over whole names of at least so many bytes, and at most that, a batch and one name more.
TREE_BYTES = 1 << 20
#: A name of more bytes is dealt by longer prefixes.
GROUP_BYTES = 1 << 22
#: Words of the longer prefixes; what is too common even then is grouped by whole windows.
PREFIXES = (10, 15)
_NULL_ID = -(1 << 63)


def _owners(data: np.ndarray, offsets: np.ndarray, window: int):
    """(starts, ends, first, windows, anchors, grams): each whole window's place and its anchor's."""
    starts, ends, first = word_spans(data, offsets)
    grams = gram_hashes(word_hashes(data, starts, ends), GRAM)
    span = window - GRAM + 1
    n = len(grams) - span + 1
    if n <= 0:
        return starts, ends, first, np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    best, place, have = grams.copy(), np.arange(len(grams)), 1
    while have < span:  # leftmost least of [i, i + have), doubling
        step = min(have, span - have)
        a, b = best[: len(best) - step], best[step:]
        right = b < a
        place = np.where(right, place[step:], place[: len(place) - step])
        best = np.where(right, b, a)
        have += step
    inside = np.zeros(len(starts) + 1, np.int64)
    long = np.diff(first) >= window
    np.add.at(inside, first[:-1][long], 1)
    np.add.at(inside, first[1:][long] - window + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    return starts, ends, first, windows, place[windows], grams


def _own(gram: np.ndarray, tids: np.ndarray) -> np.ndarray:
    """What a text calls a gram that its own task saw twice."""
    return mix(gram + mix(tids.astype(U64)) * U64(3))


_ANCHORS = pa.schema([("name", pa.int64()), ("tid", pa.int64()), ("weight", pa.int32())])


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = np.asarray(batch.column(0))
        names, owners = [], []
        for lo, hi, data, offsets in slices(batch.column(1)):
            _, _, first, _, anchors, grams = _owners(data, offsets, window)
            if len(anchors):
                anchors = anchors[np.append(True, anchors[1:] != anchors[:-1])]
                names.append(grams[anchors])
                owners.append(ids[lo:hi][np.searchsorted(first, anchors, "right") - 1])
        if not names:
            continue
        gram, doc = np.concatenate(names), np.concatenate(owners)
        uniq, inverse, counts = np.unique(gram, return_inverse=True, return_counts=True)
        single = counts[inverse] == 1
        twice = uniq[counts > 1]
        name = np.concatenate([gram[single], _own(gram[~single], doc[~single]), twice]).view(np.int64)
        owner = pa.array(np.concatenate([doc[single], doc[~single], np.zeros(len(twice), np.int64)]), mask=np.arange(len(name)) >= len(gram))
        weight = np.concatenate([np.ones(int(single.sum())), np.full(len(name) - int(single.sum()), 2)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(name), owner, pa.array(weight)], schema=_ANCHORS)


#: kind 0: finished text (sha, n = words); 1: text with repeated grams; 2: segment; 3: repeats start..start+n.
_PARTS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("tid", pa.int64()), ("name", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])
_PARTS_DDL = "kind int, doc_id bigint, tid bigint, name bigint, start bigint, n bigint, body binary"


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).hexdigest().encode()


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _segments(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        rows: list[tuple] = []
        found: dict[tuple[int, bytes], tuple] = {}
        for lo, hi, data, offsets in slices(batch.column(2)):
            raw = data.tobytes()
            hot = [batch.column(3)[i].as_py() for i in range(lo, hi)]
            if any(hot):
                starts, ends, first, windows, anchors, grams = _owners(data, offsets, window)
            for i, names in enumerate(hot):
                text = raw[offsets[i] : offsets[i + 1]]
                words = text.split()
                doc_id, tid = int(ids[lo + i]), int(tids[lo + i])
                if not names:
                    rows.append((0, doc_id, tid, 0, 0, len(words), _digest(words)))
                    continue
                rows.append((1, doc_id, tid, 0, 0, len(words), text))
                a, b = np.searchsorted(windows, first[i]), np.searchsorted(windows, first[i + 1])
                at, who = windows[a:b] - first[i], anchors[a:b]
                if not len(at):
                    continue
                cut = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
                gram = grams[who[cut]]
                known = np.array(names, np.int64).view(U64)
                keep = np.isin(gram, known) | np.isin(_own(gram, np.full(len(gram), tid)), known)
                size = np.diff(np.append(cut, len(at)))
                for g, s, n in zip(gram[keep].view(np.int64).tolist(), at[cut[keep]].tolist(), size[keep].tolist()):
                    body = b" ".join(words[s : s + n + window - 1])
                    old = found.get((g, body))
                    new = (doc_id, tid, s, n)
                    if old is None or new < old:
                        found[g, body] = new
                        new = old
                    if new is not None and new != found[g, body]:
                        rows.append((3, new[0], new[1], 0, new[2], n, None))
            if len(rows) > 20_000:
                yield _table(rows, _PARTS)
                rows = []
        rows += [(2, doc_id, tid, g, s, n, body) for (g, body), (doc_id, tid, s, n) in found.items()]
        for k in range(0, len(rows), 20_000):
            yield _table(rows[k : k + 20_000], _PARTS)


def _by_prefix(batches: Iterator[pa.RecordBatch], window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """Segments of too common names, a suffix of ``window`` words each, named by the first ``prefix`` of them."""
    for batch in batches:
        rows = []
        for doc_id, tid, start, n, body in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tid", "start", "n", "body"))):
            words = body.split(b" ")
            for k in range(n):
                first = hashlib.blake2b(b" ".join(words[k : k + prefix]), digest_size=8).digest()
                rows.append((2, doc_id, tid, int.from_bytes(first, "little", signed=True), start + k, 1, b" ".join(words[k : k + window])))
        for k in range(0, len(rows), 20_000):
            yield _table(rows[k : k + 20_000], _PARTS)


_REPEATS = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])


def _subtree(group: pa.Table, window: int) -> pa.RecordBatch | None:
    """The repeats of a group: suffixes in order, their common prefixes, and so the tree's internal nodes.

    Words are numbered by their bytes, suffixes compared by these numbers. A node of depth ``window``
    or more whose leaves do not all follow one word is a maximal repeat; its first leaf stays.
    """
    group = group.combine_chunks()
    doc, tid, start, n = (np.asarray(group.column(c)) for c in ("doc_id", "tid", "start", "n"))
    words = pc.split_pattern(group.column("body").combine_chunks(), pattern=b" ")
    first = np.asarray(words.offsets).astype(np.int64)
    codes = np.asarray(words.flatten().dictionary_encode().indices)
    owner = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = first[owner] + k
    # suffixes whose first words' hash is alone share no deep node
    _, inverse, counts = np.unique(gram_hashes(mix(codes.astype(U64) + U64(1)), window)[at], return_inverse=True, return_counts=True)
    live = np.flatnonzero(counts[inverse] > 1)
    if not len(live):
        return None
    owner, k, at = owner[live], k[live], at[live]
    left = first[owner + 1] - at
    depth = int(left.max())
    reach = np.arange(depth)
    text = codes[np.minimum(at[:, None] + reach, len(codes) - 1)].astype(">u4")
    text[reach >= left[:, None]] = 0xFFFFFFFF
    order = np.argsort(text.view(f"V{4 * depth}").ravel(), kind="stable")
    differ = text[order[1:]] != text[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    common = np.minimum(common, np.minimum(left[order[1:]], left[order[:-1]]))
    before = np.where(k > 0, codes[at - 1].astype(np.int64), -1)[order]
    place = np.stack([doc[owner], tid[owner], start[owner] + k])
    longest = np.zeros(len(order), np.int64)
    for d in range(window, depth + 1):
        if not (common == d).any():
            continue
        run = np.concatenate([[0], np.cumsum(common < d)])
        heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        node = np.zeros(len(heads), bool)
        node[run[1:][common == d]] = True
        low, high = np.minimum.reduceat(before, heads), np.maximum.reduceat(before, heads)
        node &= (low < 0) | (low != high)
        earliest = np.minimum.reduceat(order, heads)[run]  # suffixes of a group come in the order of their places
        longest[node[run] & (place[:, order] != place[:, earliest]).any(axis=0)] = d
    found = longest > 0
    doc_ids, tids, starts = place[:, order[found]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (doc_ids, tids, starts, longest[found] - window + 1)], schema=_REPEATS)


def _subtrees(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Input sorted by (name, doc_id, tid, start). Whole names are gathered until they are worth a tree."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        if sum(b.column("body").nbytes for b in waiting) >= TREE_BYTES:
            cut = int(np.searchsorted(np.asarray(batch.column("name")), waiting[-1].column("name")[-1].as_py(), "right"))
            if cut < len(batch):
                made = _subtree(pa.Table.from_batches([*waiting, batch.slice(0, cut)]), window)
                waiting, batch = [], batch.slice(cut)
                if made is not None:
                    yield made
        waiting.append(batch)
    made = _subtree(pa.Table.from_batches(waiting), window) if waiting else None
    if made is not None:
        yield made
    release()


_DONE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def _kept(batches: Iterator[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "body", "spans"))):
            words = text.split()
            cover = np.zeros(len(words) + 1, np.int64)
            for s in spans or ():
                cover[s["start"]] += 1
                cover[s["start"] + s["n"] + window - 1] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            left = [w for w, g in zip(words, gone.tolist()) if not g]
            rows.append((doc_id, len(words), int(gone.sum()), b" ".join(left) if with_text else None, _digest(left).decode()))
            if len(rows) >= 5000:
                yield _table(rows, _DONE)
                rows = []
        if rows:
            yield _table(rows, _DONE)


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256[, kept: the words left, if any went].

    Null and empty texts have no words. Texts shorter than a window lose nothing. A null id comes
    before any other. Rows that share an id but not a text are told apart by their texts' hash, in
    that order; rows that repeat both are one document and lose the same words. An empty table gives
    an empty result. ``group_bytes`` bounds what a tree is built from, not what is found.
    """
    if window < GRAM:
        raise ValueError("window must have five words or more")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID)).alias("doc_id"), F.xxhash64(F.col(id_col).cast("bigint"), text).alias("tid"), text.alias("text"))
    # a text is known by the hash of its id and itself, so texts without an id are told apart
    names = texts.select("tid", "text").mapInArrow(partial(_anchors, window=window), "name bigint, tid bigint, weight int")
    seen = names.withColumn("seen", F.sum("weight").over(Window.partitionBy("name"))).where("seen > 1 AND tid IS NOT NULL")
    lists = seen.groupBy("tid").agg(F.collect_set("name").alias("names"))
    joined = texts.join(lists, "tid", "left").select("doc_id", "tid", "text", "names")
    parts = materialise(joined.mapInArrow(partial(_segments, window=window), _PARTS_DDL), "segments")
    segments = parts.where("kind = 2").select(*_PARTS.names)
    repeats = parts.where("kind = 3").select(*_REPEATS.names)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for prefix in (*(p for p in PREFIXES if p < window), window):
        sizes = segments.groupBy("name").agg(F.sum(F.octet_length("body")).alias("size"))
        wide = materialise(sizes.where(F.col("size") > group_bytes).select("name"), "wide-names")
        whole = wide.isEmpty()
        narrow = segments if whole else segments.join(if_small(wide), "name", "left_anti")
        dealt = narrow.select("name", "doc_id", "tid", "start", "n", "body").repartition(count, "name").sortWithinPartitions("name", "doc_id", "tid", "start")
        repeats = repeats.unionByName(dealt.mapInArrow(partial(_subtrees, window=window), "doc_id bigint, tid bigint, start bigint, n bigint"))
        if whole:
            break
        segments = segments.join(if_small(wide), "name", "left_semi").select(*_PARTS.names)
        segments = materialise(segments.mapInArrow(partial(_by_prefix, window=window, prefix=prefix), _PARTS_DDL), "longer-prefixes")
    else:
        place = F.struct("doc_id", "tid", "start")
        nodes = segments.groupBy("body").agg(F.min(place).alias("first"), F.count("*").alias("leaves"))
        nodes = materialise(nodes.where("leaves > 1"), "whole-windows")
        total = nodes.agg(F.coalesce(F.sum("leaves"), F.lit(0))).first()[0]
        again = join_hot(segments.select("doc_id", "tid", "start", "n", "body"), nodes, "body", "leaves", total)
        repeats = repeats.unionByName(again.where(F.col("first") != place).select(*_REPEATS.names))
    spans = repeats.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    open_texts = parts.where("kind = 1").select("doc_id", "tid", "body")
    covered = open_texts.join(spans, ["doc_id", "tid"], "left").select("doc_id", "body", "spans")
    done = covered.mapInArrow(partial(_kept, window=window, with_text=with_text), "doc_id bigint, n_words bigint, n_removed bigint, kept binary, kept_sha256 string")
    whole = parts.where("kind = 0").select("doc_id", F.col("n").alias("n_words"), F.lit(0).cast("bigint").alias("n_removed"), F.lit(None).cast("binary").alias("kept"), F.decode("body", "UTF-8").alias("kept_sha256"))
    result = whole.unionByName(done).withColumn("doc_id", F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")))
    return result.withColumn("kept", F.decode("kept", "UTF-8")) if with_text else result.drop("kept")
