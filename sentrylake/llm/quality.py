"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed in one pass and written to the shared folder. A bounded
sample of labelled rows (``most_rows``, those with the least hash of their id) trains the trees on the
driver in numpy; what the driver gets is at most most_rows x len(FEATURES) numbers. The trees are
flattened into arrays (feature, threshold, left, right, value) that score batches of rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.arrays import LOWER, U64, gram_hashes, slices, word_hashes, word_spans
from sentrylake.session import materialise

FEATURES = (
    "log_bytes", "log_words", "mean_word", "long_words", "one_letter", "letters", "upper", "digits",
    "punctuation", "symbols", "pipes", "white", "line_breaks", "words_a_line", "distinct_words",
    "distinct_pairs", "repeats_next", "distinct_lines", "capitals_share", "sentence_ends",
    "marks_in_words", "longest_word", "top_word", "entropy",
)

_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 upper, 3 digit, 4 usual punctuation, 5 symbol, 6 white
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
for _c in b".,;:!?'\"()-":
    _KIND[_c] = 4
_KIND[[9, 10, 11, 12, 13, 32]] = 6
_KIND[(_KIND == 0)] = 5


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return run[offsets[1:]] - run[offsets[:-1]]


def _distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: distinct values, the share of the commonest, entropy in bits."""
    n = len(first) - 1
    rows = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(v))).astype(np.float64)
    owner = r[at]
    total = np.maximum(np.diff(first), 1)
    top = np.zeros(n)
    np.maximum.at(top, owner, count)
    p = count / total[owner]
    return np.bincount(owner, minlength=n)[:n], top / total, np.bincount(owner, -p * np.log2(p), minlength=n)[:n]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x FEATURES of the texts data[offsets[i]:offsets[i+1]]; an empty text has zeros."""
    size = np.diff(offsets).astype(np.float64)
    kind = _KIND[data]
    starts, ends, first = word_spans(data, offsets)
    words = np.diff(first).astype(np.float64)
    length = (ends - starts).astype(np.float64)
    hashes = word_hashes(LOWER[data], starts, ends)
    share = lambda mask: _sums(mask, offsets) / np.maximum(size, 1)
    by_word = lambda mask: _sums(mask, first) / np.maximum(words, 1)
    breaks = data == 10
    n_lines = _sums(breaks, offsets) + 1
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][words > 0]] = False
    pairs = gram_hashes(hashes, 2) if len(hashes) > 1 else np.zeros(0, U64)
    pairs = np.append(pairs, np.zeros(len(hashes) - len(pairs), U64))
    distinct, top, entropy = _distinct(hashes, first)
    distinct2, _, _ = _distinct(pairs, first)
    # lines: spans between breaks and row ends
    edges = np.unique(np.concatenate([np.flatnonzero(breaks) + 1, offsets]))
    line_first = np.searchsorted(edges, offsets)
    lines = word_hashes(data, edges[:-1], edges[1:]) if len(edges) > 1 else np.zeros(0, U64)
    distinct_lines, _, _ = _distinct(lines, line_first)
    longest = np.zeros(len(size))
    np.maximum.at(longest, np.repeat(np.arange(len(size)), np.diff(first)), length)
    first_kind, last = kind[starts], data[ends - 1]
    odd = (kind == 5).astype(np.float64)
    run = np.concatenate([[0], np.cumsum(odd)])
    symbols_in_word = run[ends] - run[starts]
    made = np.stack([
        np.log1p(size), np.log1p(words), by_word(length), by_word(length > 14), by_word(length == 1),
        share((kind == 1) | (kind == 2)), share(kind == 2), share(kind == 3), share(kind == 4),
        share(kind == 5), share(data == 124), share(kind == 6), share(breaks), words / n_lines,
        distinct / np.maximum(words, 1), distinct2 / np.maximum(words, 1), by_word(same),
        distinct_lines / n_lines, by_word(first_kind == 2), by_word((last == 46) | (last == 33) | (last == 63)),
        by_word(symbols_in_word > 0), np.log1p(longest), top, entropy,
    ], axis=1)
    made[size == 0] = 0
    return made.astype(np.float32)


@dataclass
class Trees:
    """Flattened trees; node 0 of each starts at roots[t]. A leaf has feature -1."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all rows walking each tree together."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(inner, np.where(right, self.right[node], self.left[node]), node)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 20, ridge: float = 1.0) -> Trees:
    """Boosted trees on logistic loss; splits are sought over histograms of gradients."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1) if n else np.zeros((0, m), int)
    rate1 = (y.sum() + 1) / (n + 2)
    base = float(np.log(rate1 / (1 - rate1)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    raw = np.full(n, base)
    for _ in range(rounds if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        roots.append(node())
        todo = [(roots[-1], np.arange(n), 0)]
        while todo:
            k, rows, level = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            best = (1e-6, None, None)
            if level < depth and len(rows) >= 2 * least:
                for j in range(m):
                    if not len(cuts[j]):
                        continue
                    b = binned[rows, j]
                    width = len(cuts[j]) + 1
                    gs, hs, cs = (np.cumsum(np.bincount(b, w, width))[:-1] for w in (grad[rows], hess[rows], None))
                    gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                    gain[(cs < least) | (len(rows) - cs < least)] = -1
                    at = int(np.argmax(gain))
                    if gain[at] > best[0]:
                        best = (gain[at], j, at)
            if best[1] is None:
                value[k] = rate * g / (h + ridge)
                raw[rows] += value[k]
            else:
                _, j, at = best
                feature[k], threshold[k] = j, float(np.float32(cuts[j][at]))
                goes = binned[rows, j] > at
                left[k], right[k] = node(), node()
                todo += [(left[k], rows[~goes], level + 1), (right[k], rows[goes], level + 1)]
    as_array = np.array
    return Trees(base, as_array(roots, np.int64), as_array(feature, np.int64), as_array(threshold, np.float32), as_array(left, np.int64), as_array(right, np.int64), as_array(value), depth)


_STATS = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float32()))])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            x = statistics(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists.cast(_STATS.field(1).type)], schema=_STATS)


def _score(batches: Iterator[pa.RecordBatch], trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.value.score(x))], names=["doc_id", "score"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_measure, "doc_id bigint, stats array<float>")


def train(stats: DataFrame, labels: DataFrame, label_col: str, most_rows: int = 20_000) -> Trees:
    """Trees from labelled statistics: the most_rows ids of least hash; conflicting labels of an id count each.

    An id that repeats stands by its least statistics, so the driver gets no more than most_rows rows.
    """
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL").distinct()
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most_rows)
    once = F.broadcast(sample).join(stats, "doc_id").groupBy("doc_id", "label").agg(F.min("stats").alias("stats"))
    rows = once.orderBy("doc_id", "label").toPandas()
    x = np.stack(rows["stats"].to_numpy()) if len(rows) else np.zeros((0, len(FEATURES)), np.float32)
    return fit_trees(x, rows["label"].to_numpy(np.float64))


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    return (F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % mod) == remainder


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, most_rows: int = 20_000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels are learnt only from ids whose crc32 mod 4 is not 2. Null and empty texts have zero
    statistics and a score like any other. Repeated rows are scored each by itself; a null id is
    scored, is never a training row, and held_out is null-safe false. Without labels of both kinds
    the score is the smoothed share of label 1. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    stats = materialise(document_statistics(docs, id_col, text_col), "statistics")
    usable = labels.where(~held_out(F.col("doc_id"), 4, 2))
    trees = spark.sparkContext.broadcast(train(stats, usable, "quality", most_rows))
    scored = stats.mapInArrow(partial(_score, trees=trees), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id"), 4, 2), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _keep(batches: Iterator[pa.RecordBatch], trees, column: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = np.concatenate([statistics(data, offsets) for _, _, data, offsets in slices(batch.column(column))])
            yield batch.filter(pa.array(trees.value.score(x) >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, most_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``. No text is shuffled.

    Trees are trained as in ``quality_scores``; the bounded sample's ids are broadcast to pick its texts.
    """
    spark = docs.sparkSession
    usable = labels.where(~held_out(F.col("doc_id"), 4, 2))
    ids = usable.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "doc_id", "left_semi")
    stats = materialise(document_statistics(picked), "statistics")
    trees = spark.sparkContext.broadcast(train(stats, usable, "quality", most_rows))
    return docs.mapInArrow(partial(_keep, trees=trees, column=docs.columns.index(text_col), threshold=threshold), docs.schema)
