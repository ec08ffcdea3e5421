"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts.

Normalised: A-Z in lower case, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Every window of ``window`` words
of an item (a shorter item is one window) is a pattern. The automaton reads words, not letters, and
lies in flat arrays: a node is an edge (parent, word) in a sorted array, beside it its failure link and
the length of the pattern that ends there. That is 13 bytes a node, so at most 130 bytes for each word of
the benchmark at a window of ten (17 bytes where some item is shorter than a window), whatever the
number of items; there is one automaton and each text is read once.

Texts are read in batches: runs of words that the benchmark has are cut into segments that overlap by
all but one word of a window, so a state is exact behind the overlap, and all segments of a batch take
each step together. Words are known by 64-bit hashes; those of every hit are compared byte by byte.
Hits are mapped back to words and to offsets in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.arrays import slices, utf8, word_hashes, word_spans

#: Every byte that is no part of a word becomes a space, A-Z become a-z.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
_BYTES = np.frombuffer(_TABLE, np.uint8)

_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
_DDL = "n_words bigint, spans array<struct<first_word:bigint,last_word:bigint,start:bigint,end:bigint>>, items array<string>"

#: Bytes of benchmark text that the driver takes: what is broadcast has a bound. More is an error.
MOST_BYTES = 64 << 20
#: Words of a segment behind its overlap.
_SEGMENT = 64


@dataclass
class Automaton:
    """Node 0 is the root; node k + 1 hangs on edge k. ``length`` is that of the pattern that ends at a node, or 0."""

    vocabulary: np.ndarray
    spelled: np.ndarray
    spelled_at: np.ndarray
    edges: np.ndarray
    fail: np.ndarray
    length: np.ndarray
    link: np.ndarray | None
    longest: int
    shortest: int
    items: list[str]
    owner_nodes: np.ndarray
    owners: np.ndarray

    def children(self, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The nodes that words lead to, 0 where there is no edge."""
        keys = nodes * np.int64(len(self.vocabulary) + 1) + words
        at = np.minimum(np.searchsorted(self.edges, keys), max(len(self.edges) - 1, 0))
        return np.where(self.edges[at] == keys, at + 1, 0) if len(self.edges) else np.zeros(len(nodes), np.int64)

    def step(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The next states: along an edge, else along failure links until there is one."""
        out = self.children(states, words)
        todo = np.flatnonzero((out == 0) & (states > 0))
        states = states.copy()
        while len(todo):
            states[todo] = self.fail[states[todo]]
            out[todo] = self.children(states[todo], words[todo])
            todo = todo[(out[todo] == 0) & (states[todo] > 0)]
        return out

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, node) of every pattern in the texts words[first[i]:first[i+1]]; word 0 is one that no item has."""
        none = np.zeros(0, np.int64)
        if not len(self.edges) or not len(words):
            return none, none
        edge = words > 0
        begins = edge.copy()
        inner = np.zeros(len(words) + 1, bool)
        inner[first] = True
        begins[1:] &= ~edge[:-1] | inner[1:-1]
        ends = edge.copy()
        ends[:-1] &= ~edge[1:] | inner[1:-1]
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        long = stop - start >= self.shortest
        start, stop = start[long], stop[long]
        # segments of a run: each reads the words before its own that a pattern may reach back to
        count = -(-(stop - start) // _SEGMENT)
        number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        own = np.repeat(start, count) + number * _SEGMENT
        begin = np.maximum(own - (self.longest - 1), np.repeat(start, count))
        end = np.minimum(own + _SEGMENT, np.repeat(stop, count))
        order = np.argsort(begin - end, kind="stable")
        own, begin, size = own[order], begin[order], (end - begin)[order]
        state = np.zeros(len(begin), np.int64)
        where, nodes = [none], [none]
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, "left"))
            at = begin[:live] + t
            state[:live] = self.step(state[:live], words[at])
            node = np.where(self.length[state[:live]] > 0, state[:live], 0 if self.link is None else self.link[state[:live]])
            told = np.flatnonzero((node > 0) & (at >= own[:live]))
            node, at = node[told], at[told]
            while len(node):
                where.append(at)
                nodes.append(node)
                node = np.zeros(0, np.int64) if self.link is None else self.link[node].astype(np.int64)
                at, node = (at[node > 0], node[node > 0]) if len(node) else (at[:0], node)
        return np.concatenate(where), np.concatenate(nodes)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _read(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(normalised bytes, word starts, word ends, first word of each text)."""
    data = _BYTES[data]
    return (data, *word_spans(data, offsets))


def build_automaton(items: list[tuple[str, bytes]], window: int) -> Automaton:
    """The automaton of all windows of the items (identifier, text)."""
    texts = [t for _, t in items]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    data, starts, ends, first = _read(np.frombuffer(b"".join(texts), np.uint8), offsets)
    hashes = word_hashes(data, starts, ends)
    vocabulary, sample, ids = np.unique(hashes, return_index=True, return_inverse=True)
    ids = ids.astype(np.int64) + 1
    sizes = (ends - starts)[sample]
    spelled_at = np.concatenate([[0], np.cumsum(sizes)])
    spelled = data[_ranges(starts[sample], sizes)]
    size = ends - starts
    same = size == sizes[ids - 1]
    if not same.all() or not (data[_ranges(starts, size)] == spelled[_ranges(spelled_at[ids - 1], size)]).all():
        raise ValueError("two words of the benchmark share a 64-bit hash")
    words = np.diff(first)
    n = np.minimum(words, window)
    count = np.where(n > 0, words - n + 1, 0)
    begin = _ranges(first[:-1], count)
    size = np.repeat(n, count)
    owner = np.repeat(np.arange(len(items)), count)
    width, node = np.int64(len(vocabulary) + 1), np.zeros(len(begin), np.int64)
    edges, levels, last = [], [0], 0
    for depth in range(int(n.max()) if len(n) else 0):
        on = np.flatnonzero(size > depth)
        keys, inverse = np.unique(node[on] * width + ids[begin[on] + depth], return_inverse=True)
        node[on] = last + 1 + inverse
        edges.append(keys)
        last += len(keys)
        levels.append(last)
    edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    length = np.zeros(last + 1, np.uint16)
    length[node] = size
    length[0] = 0
    fail = np.zeros(last + 1, np.int32)
    short = len(begin) > 0 and int(size.min()) < int(size.max())
    pairs = np.unique(node * np.int64(max(len(items), 1)) + owner)
    made = Automaton(vocabulary, spelled, spelled_at, edges, fail, length, np.zeros(last + 1, np.int32) if short else None, int(size.max()) if len(begin) else 1, int(size.min()) if len(begin) else 1, [i for i, _ in items], pairs // max(len(items), 1), (pairs % max(len(items), 1)).astype(np.int32))
    for low, high in zip(levels[1:-1], levels[2:]):  # by depth: the links of lesser depths are known
        level = np.arange(low + 1, high + 1)
        parent, word = np.divmod(edges[level - 1], width)
        fail[level] = made.step(fail[parent].astype(np.int64), word)
        if made.link is not None:
            made.link[level] = np.where(length[fail[level]] > 0, fail[level], made.link[fail[level]])
    return made


def _found(made: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last word, node) of every hit, the words compared byte by byte."""
    hashes = word_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(made.vocabulary, hashes), max(len(made.vocabulary) - 1, 0))
    words = np.where(made.vocabulary[at] == hashes, at + 1, 0) if len(made.vocabulary) else np.zeros(len(hashes), np.int64)
    while True:
        last, node = made.hits(words, first)
        n = made.length[node].astype(np.int64)
        seen = np.unique(_ranges(last - n + 1, n))
        size = (ends - starts)[seen]
        same = size == np.diff(made.spelled_at)[words[seen] - 1]
        here, size = seen[same], size[same]
        if len(here):
            equal = data[_ranges(starts[here], size)] == made.spelled[_ranges(made.spelled_at[words[here] - 1], size)]
            same[same] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
        if same.all():
            return last, node
        words[seen[~same]] = 0  # another word of the same hash


def _spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> list[dict]:
    """Runs of hit words of one text, with the characters of the original that they reach from and to."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [{"first_word": int(a), "last_word": int(b), "start": int(chars[starts[a]]), "end": int(chars[ends[b]])} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1)]


def _scan(batches: Iterator[pa.RecordBatch], automaton) -> Iterator[pa.RecordBatch]:
    made = automaton.value
    for batch in batches:
        for lo, hi, raw, offsets in slices(batch.column(1)):
            data, starts, ends, first = _read(raw, offsets)
            last, node = _found(made, data, starts, ends, first)
            n = made.length[node].astype(np.int64)
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, last - n + 1, 1)
            np.add.at(cover, last + 1, -1)
            hit = np.cumsum(cover[:-1]) > 0
            row = np.searchsorted(first, last, "right") - 1
            spans: list[list[dict]] = [[] for _ in range(hi - lo)]
            items: list[list[str]] = [[] for _ in range(hi - lo)]
            pairs = np.unique(row * np.int64(len(made.length)) + node)
            row, node = np.divmod(pairs, len(made.length))
            low, high = np.searchsorted(made.owner_nodes, node, "left"), np.searchsorted(made.owner_nodes, node, "right")
            for r in np.unique(row).tolist():
                a, b = first[r], first[r + 1]
                spans[r] = _spans(raw[offsets[r] : offsets[r + 1]], starts[a:b] - offsets[r], ends[a:b] - offsets[r], hit[a:b])
                mine = slice(*np.searchsorted(row, [r, r + 1]))
                items[r] = sorted({made.items[i] for i in made.owners[_ranges(low[mine], (high - low)[mine])].tolist()})
            columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first), pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "spans", "items"])


def _benchmark(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> list[tuple[str, bytes]]:
    """(identifier, text) of the items that have both, each pair once; an error beyond ``most`` bytes."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL AND i IS NOT NULL").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length("i")), F.lit(0))).first()[0]
    if size > most:
        raise ValueError(f"the benchmark has {size} bytes, over the bound of {most}: scan for parts of it, or raise most_bytes")
    return sorted((r.i, utf8(r.t)) for r in rows.collect())


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_words, spans (hit words, with offsets into the original text), items, one row per document.

    ``items`` are the identifiers, as strings and in order, of items with an occurring window. No
    shuffle of texts: each passes through the automaton once, whole, whatever its length. Null or empty
    texts have no words and no hits; null or empty items (and null identifiers) have no windows; items
    repeated under one identifier count once; items that share a window are all named. Repeated rows
    of ``docs`` are scanned each by itself. Other columns are ignored whatever their names. An empty
    table gives an empty result, an empty benchmark no hits.
    """
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    automaton = docs.sparkSession.sparkContext.broadcast(build_automaton(_benchmark(benchmark, item_col, item_text_col, most_bytes), window))
    return frame.mapInArrow(partial(_scan, automaton=automaton), f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, {_DDL}")


def _clean(batches: Iterator[pa.RecordBatch], automaton, column: int) -> Iterator[pa.RecordBatch]:
    made = automaton.value
    for batch in batches:
        clean = np.ones(batch.num_rows, bool)
        for lo, _, raw, offsets in slices(batch.column(column)):
            data, starts, ends, first = _read(raw, offsets)
            last, _ = _found(made, data, starts, ends, first)
            clean[lo + np.searchsorted(first, last, "right") - 1] = False
        yield batch.filter(pa.array(clean))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, without any window of the benchmark. No shuffle of texts."""
    automaton = docs.sparkSession.sparkContext.broadcast(build_automaton(_benchmark(benchmark, item_col, item_text_col, most_bytes), window))
    return docs.mapInArrow(partial(_clean, automaton=automaton, column=docs.columns.index(text_col)), docs.schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["last_word"] - s["first_word"] + 1)
    return scan(docs, benchmark, window=window).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
