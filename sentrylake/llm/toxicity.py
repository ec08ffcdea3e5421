"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are a text's lower-case words and their beginnings (5 bytes), so inflected forms meet. The
vector space is every term of a bounded training sample, none left out: a term weighs its inverse
document frequency, counted over all documents, times ``FLOOR`` plus how far the sample's labels
differ by it (log odds), so telling terms count more and no term counts nothing. Terms that no example
has cannot meet one and are no part of the space.

The examples lie in blocks. Terms that few of them have add up exactly from postings; for the common
ones, whose lists are long, each block has every term's largest weight. So a batch of texts bounds
every block at once, scores its two best blocks exactly, and then only those blocks whose bound
reaches a text's k-th neighbour, so the neighbours are exact. Votes are weighted by squared similarity
and class size and calibrated by a logistic fit on leave-one-out votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.arrays import LOWER, U64, mix, slices, word_hashes, word_spans
from sentrylake.llm.quality import held_out
from sentrylake.session import materialise

#: Bytes of a longer word's beginning.
HEAD = 5
#: What a term weighs, times its inverse document frequency, that both labels have alike.
FLOOR = 0.02
#: Postings that a worker expands at once.
_POSTINGS = 1_000_000
#: Texts that a worker scores at once, at most.
_TEXTS = 256
#: A term of more than one example in so many is a dense column.
_COMMON = 16


def _pairs(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the distinct pairs, in order of row, then term; terms are under ``width``."""
    keys = rows * width + terms
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    row, term = np.divmod(keys[at], width)
    return row, term, np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)


def text_terms(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, row, place in terms, count): every word and the beginning of every longer word of each text.

    ``terms`` are sorted hashes: those of the vocabulary where one is given, else all that occur. Each
    distinct word is looked at once, whatever the number of its places.
    """
    data = LOWER[data]
    # words here end at any ASCII byte that is no letter or digit
    keep = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    data = np.where(keep, data, np.uint8(32))
    starts, ends, first = word_spans(data, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    word, at, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    begin, size = starts[at], (ends - starts)[at]
    row, place, count = _pairs(rows, inverse, np.ones(len(rows), np.int64), max(len(word), 1))
    long = size > HEAD
    head = mix(word_hashes(data, begin[long], begin[long] + HEAD) + U64(HEAD))
    terms = np.unique(np.concatenate([word, head])) if vocabulary is None else vocabulary
    of_word, of_head = np.full(len(word), -1), np.full(len(word), -1)
    for out, where, hashes in ((of_word, slice(None), word), (of_head, long, head)):
        near = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
        out[where] = np.where(terms[near] == hashes, near, -1) if len(terms) else -1
    row, count = np.concatenate([row, row]), np.concatenate([count, count])
    place = np.concatenate([of_word[place], of_head[place]])
    some = place >= 0
    return terms, *_pairs(row[some], place[some], count[some], max(len(terms), 1))


_EXAMPLES = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, label and all terms of the whole text with their counts; (text, doc_id, label) batches."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(0)):
            terms, rows, place, counts = text_terms(data, offsets)
            ends = pa.array(np.searchsorted(rows, np.arange(hi - lo + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)).cast(f.type) for v, f in zip((terms[place].view(np.int64), counts.astype(np.int32)), list(_EXAMPLES)[2:])]
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), *lists], schema=_EXAMPLES)


_FREQUENCIES = pa.schema([("term", pa.int32()), ("n", pa.int64())])


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """(place in the vocabulary, texts that have it), combined over a whole task."""
    known = vocabulary.value
    total = np.zeros(len(known), np.int64)
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            _, _, place, _ = text_terms(data, offsets, known)
            total += np.bincount(place, minlength=len(known))
    seen = np.flatnonzero(total)
    for k in range(0, len(seen), 100_000):
        some = seen[k : k + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=_FREQUENCIES)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after another."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)


@dataclass
class Index:
    """Unit vectors of examples in blocks.

    A term that many examples have is a dense column of each block (``dense``: blocks x common terms x
    examples) with its largest weight there (``dense_max``). Other terms have postings, by term, then
    example; ``first_post`` says where a term's postings start.
    """

    weight: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    block: int
    odds: float
    empty: float
    common: np.ndarray | None = None
    dense: np.ndarray | None = None
    dense_max: np.ndarray | None = None
    first_post: np.ndarray | None = None
    post_place: np.ndarray | None = None
    post_weight: np.ndarray | None = None
    fit: tuple[float, float] = (1.0, 0.0)

    def vectors(self, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Unit TF-IDF weights of (row, term, count) triples of n texts."""
        w = (1 + np.log(counts)) * self.weight[terms]
        norm = np.sqrt(np.bincount(rows, w * w, minlength=n))
        return w / np.maximum(norm, 1e-300)[rows]

    def nearest(self, rows: np.ndarray, terms: np.ndarray, q: np.ndarray, n: int, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, example, similarity) of each text's k nearest with any term in common, nearest first.

        Of equal similarities the earlier example goes first. ``skip`` names an example per text
        that is left out (-1: none). Triples are in order of row.
        """
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        cost = np.concatenate([[0], np.cumsum(self.first_post[terms + 1] - self.first_post[terms])])
        first = np.searchsorted(rows, np.arange(n + 1))
        lo = 0
        while lo < n and len(self.ids):
            # as many texts as fit, one at least
            hi = min(max(lo + 1, int(np.searchsorted(cost[first], cost[first[lo]] + _POSTINGS, "right")) - 1), lo + _TEXTS)
            some = slice(first[lo], first[hi])
            found = self._chunk(rows[some] - lo, terms[some], q[some], hi - lo, k, None if skip is None else skip[lo:hi])
            out.append((found[0] + lo, found[1], found[2]))
            lo = hi
        return tuple(np.concatenate([o[i] for o in out]) for i in range(3))

    def _chunk(self, rows, terms, q, n, k, skip):
        blocks, width = len(self.dense), len(self.dense) * self.block
        much = self.common[terms] >= 0
        dense = np.zeros((n, self.dense.shape[1]))
        dense[rows[much], self.common[terms[much]]] = q[much]
        rows, terms, q = rows[~much], terms[~much], q[~much]
        lengths = self.first_post[terms + 1] - self.first_post[terms]
        at = _runs(self.first_post[terms], lengths)
        # what the other terms add is exact for every example; the common ones are bounded block by block
        s = np.bincount(np.repeat(rows * width, lengths) + self.post_place[at], np.repeat(q, lengths) * self.post_weight[at], minlength=n * width).astype(np.float64, copy=False).reshape(n, blocks, self.block)
        if skip is not None:
            left_out = np.flatnonzero(skip >= 0)
            s[left_out, skip[left_out] // self.block, skip[left_out] % self.block] = -np.inf
        bound = np.maximum(s.max(2), 0) + dense @ self.dense_max
        first = np.zeros((n, blocks), bool)
        best = np.argpartition(-bound, 1, axis=1)[:, :2] if blocks > 2 else np.broadcast_to(np.arange(blocks), (n, blocks))
        np.put_along_axis(first, best, True, 1)
        self._add_common(s, dense, first)
        tried = np.take_along_axis(s, best[:, :, None], 1).reshape(n, -1)
        # the k-th best so far; blocks that cannot reach it hold none of the k nearest
        least = np.maximum(np.partition(tried, -k, axis=1)[:, -k], 0) if tried.shape[1] >= k else np.zeros(n)
        rest = (bound > 0) & (bound >= least[:, None]) & ~first
        self._add_common(s, dense, rest)
        row, block, place = np.nonzero((s >= least[:, None, None]) & (s > 0) & (first | rest)[:, :, None])
        return self._top(row, block * self.block + place, s[row, block, place], k)

    def _add_common(self, s, dense, mask):
        """What the common terms add to the examples of the chosen (row, block) cells."""
        for b in np.flatnonzero(mask.any(0)):
            mine = np.flatnonzero(mask[:, b])
            s[mine, b] += dense[mine] @ self.dense[b]

    @staticmethod
    def _top(r, e, s, k):
        order = np.lexsort((e, -s, r))
        r, e, s = r[order], e[order], s[order]
        start = np.searchsorted(r, r, "left")
        keep = np.arange(len(r)) - start < k
        return r[keep], e[keep], s[keep]

    def votes(self, rows, terms, counts, n: int, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log-odds of the weighted votes of each text, the neighbours' rows, the neighbours)."""
        r, e, s = self.nearest(rows, terms, self.vectors(rows, terms, counts, n), n, k, skip)
        toxic = self.labels[e] == 1
        yes = np.bincount(r[toxic], s[toxic] ** 2, minlength=n)
        no = np.bincount(r[~toxic], s[~toxic] ** 2, minlength=n) * self.odds
        return np.log((yes + 0.02) / (no + 0.02 * self.odds)), r, e

    def score(self, rows, terms, counts, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of label 1 of each text, the neighbours' rows, the neighbours)."""
        x, r, e = self.votes(rows, terms, counts, n, k)
        p = 1 / (1 + np.exp(-(self.fit[0] * x + self.fit[1])))
        return np.where(np.bincount(rows, minlength=n) > 0, p, self.empty), r, e


def _clusters(x: np.ndarray, most: int = 16, rounds: int = 8) -> np.ndarray:
    """The cluster of each row, by k-means over directions; centres start as rows far from each other."""
    x = x / np.maximum(np.sqrt((x * x).sum(1)), 1e-9)[:, None]
    if not x.size:
        return np.zeros(len(x), np.int64)
    centres, near = x[:1], x @ x[0]
    for _ in range(most - 1):
        far = int(np.argmin(near))
        centres, near = np.vstack([centres, x[far]]), np.maximum(near, x @ x[far])
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        centres = np.stack([x[own == c].sum(0) if (own == c).any() else centres[c] for c in range(most)])
        centres = centres / np.maximum(np.sqrt((centres * centres).sum(1)), 1e-9)[:, None]
    return np.argmax(x @ centres.T, axis=1)


def build_index(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, weight: np.ndarray, odds: float, k: int, block: int = 64) -> Index:
    """The index of examples given as (row, term, count) triples in order of row, then term.

    odds: label-0 rows that a label-0 example stands for, against those of a label-1 example.
    """
    sizes = np.bincount(rows, minlength=len(ids))
    void, full = np.flatnonzero(sizes == 0), np.flatnonzero(sizes > 0)
    hits = float(labels[void].sum())
    empty = (hits + 0.5) / (hits + (len(void) - hits) * odds + 1)
    rows = np.searchsorted(full, rows)
    index = Index(weight, ids[full], labels[full], block, odds, float(empty))
    unit = index.vectors(rows, terms, counts, len(full))
    much = np.flatnonzero(np.bincount(terms, minlength=len(weight)) * _COMMON > len(full))
    index.common = np.full(len(weight), -1)
    index.common[much] = np.arange(len(much))
    # examples alike in their common words (so, in language), then in their heaviest term, lie together: blocks have tight bounds
    on = index.common[terms] >= 0
    said = np.zeros((len(full), len(much)), np.float32)
    said[rows[on], index.common[terms[on]]] = 1
    heavy = np.lexsort((terms, -unit, rows))
    lead = terms[heavy[np.searchsorted(rows, np.arange(len(full)))]]
    order = np.lexsort((index.ids, lead, _clusters(said)))
    place = np.empty(len(full), np.int64)
    place[order] = np.arange(len(full))
    index.ids, index.labels = index.ids[order], index.labels[order]
    blocks = -(-len(full) // block)
    index.dense = np.zeros((blocks, len(much), block))
    at, column = place[rows], index.common[terms]
    on = column >= 0
    index.dense[at[on] // block, column[on], at[on] % block] = unit[on]
    # a little more than the largest weight, so that rounding never hides a block
    index.dense_max = index.dense.max(2, initial=0).T * (1 + 1e-9)
    by = np.flatnonzero(~on)[np.lexsort((at[~on], terms[~on]))]
    index.first_post = np.searchsorted(terms[by], np.arange(len(weight) + 1))
    index.post_place, index.post_weight = at[by].astype(np.int32), unit[by]
    x, _, _ = index.votes(rows, terms, counts, len(full), k, skip=place)
    y = labels[full].astype(float)
    size = np.where(y == 1, 1.0, odds)
    a, b = 1.0, 0.0
    for _ in range(30 if len(x) and 0 < y.sum() < len(y) else 0):  # Newton steps of a logistic fit
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([(size * (y - p) * x).sum() - 0.01 * (a - 1), (size * (y - p)).sum() - 0.01 * b])
        h = size * p * (1 - p)
        m = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()], [(h * x).sum(), h.sum() + 0.01]])
        step = np.linalg.solve(m, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
    index.fit = (max(a, 0.05), b)
    return index


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.list_(pa.int64()))])


def _score(batches: Iterator[pa.RecordBatch], vocabulary, index, k: int) -> Iterator[pa.RecordBatch]:
    known, made = vocabulary.value, index.value
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            _, *vectors = text_terms(data, offsets, known)
            scores, r, e = made.score(*vectors, hi - lo, k)
            ends = pa.array(np.searchsorted(r, np.arange(hi - lo + 1)).astype(np.int32))
            near = pa.ListArray.from_arrays(ends, pa.array(made.ids[e], pa.int64())).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(scores), near], schema=_SCORES)


def training_sample(texts: DataFrame, labels: DataFrame, most_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, doc_id, label) of at most most_rows distinct texts, and how many ids have each label.

    Half of each label, the ids of least hash. An id that repeats stands by its least text; a text that
    repeats by its least id; an id with both labels counts as label 1.
    """
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    marked = marked.where(~held_out(F.col("doc_id"), 5, 0)).where("label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    totals = {r[0]: r[1] for r in marked.groupBy("label").count().where("label IN (0, 1)").collect()}
    halves = [marked.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows // 2) for label in (0, 1)]
    sample = halves[0].unionByName(halves[1])
    by_id = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    once = by_id.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))
    return materialise(once.select("text", "doc_id", "label"), "toxic-training"), totals


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, k: int = 15, most_rows: int = 6_000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (ids of the nearest examples).

    Labels are learnt only from ids whose crc32 mod 5 is not 0, from at most most_rows rows (see
    ``training_sample``); all terms of those whole texts make up the vectors. Texts without any of
    them, empty and null texts among them, get the smoothed share of label 1 among such training
    texts. Texts of any length are read whole. Equal texts get equal scores; of examples at equal
    similarity the one that lies first in the index goes first. Repeated rows are scored each by
    itself. A null id is scored and never a training row. Other columns are ignored whatever their
    names. Without labels of both kinds the votes stay uncalibrated. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    training, totals = training_sample(texts, labels, most_rows)
    made = training.mapInArrow(_example_terms, "doc_id bigint, label int, terms array<bigint>, counts array<int>").toArrow()
    order = np.argsort(made.column("doc_id").to_numpy())
    ids, marks = made.column("doc_id").to_numpy()[order], made.column("label").to_numpy()[order].astype(np.int64)
    sizes = pc.list_value_length(made.column("terms")).to_numpy().astype(np.int64)
    at = _runs((np.cumsum(sizes) - sizes)[order], sizes[order])
    owner = np.repeat(np.arange(len(ids)), sizes[order])
    terms = made.column("terms").combine_chunks().flatten().to_numpy(zero_copy_only=False)[at].view(U64)
    counts = made.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)[at]
    del made, at
    known = np.unique(terms)
    place = np.searchsorted(known, terms)
    by = np.argsort(owner * max(len(known), 1) + place, kind="stable")
    place, counts = place[by], counts[by]
    del terms, by
    n1 = int(marks.sum())
    n0 = len(marks) - n1
    has = np.bincount(place, minlength=len(known))
    yes = np.bincount(place, marks[owner].astype(float), minlength=len(known))
    vocabulary = spark.sparkContext.broadcast(known)
    counted = texts.select("text").mapInArrow(partial(_frequencies, vocabulary=vocabulary), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(known))
    frequency[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    total = texts.count()
    told = np.abs(np.log(((yes + 1) / (n1 + 2)) / ((has - yes + 1) / (n0 + 2)))) if n0 and n1 else np.zeros(len(known))
    weight = (np.log((1 + total) / (1 + frequency)) + 1) * (FLOOR + told)
    odds = (totals.get(0, 0) / n0) / max(totals.get(1, 0) / n1, 1e-9) if n0 and n1 else 1.0
    index = spark.sparkContext.broadcast(build_index(ids, marks, owner, place, counts, weight, odds, k))
    scored = texts.mapInArrow(partial(_score, vocabulary=vocabulary, index=index, k=k), "doc_id bigint, score double, evidence array<bigint>")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id"), 5, 0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
