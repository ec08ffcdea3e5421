"""Bounded-space online packing of token ids into fixed windows.

Each partition keeps at most ``open_windows`` windows open. A document's whole windows go out as they
are; the rest goes to the open window where it fits best. When none fits, the fullest window is
emitted, topped up by a cut of that document unless what is free is under ``slack`` ids. At the end
of a partition the open windows are run together into full ones and a single leftover; leftovers of
up to ``merge_width`` partitions are merged, best fit, in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.tokens import tokenizer
from sentrylake.session import materialise

_DDL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, leftover int"


class _Packer:
    """Open windows of one partition; pieces are (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, size: int, most: int, slack: int):
        self.size, self.most, self.slack = size, most, slack
        self.windows: dict[int, list] = {}
        self.free: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.number = 0
        self.out: list[list] = []

    def _emit(self, pieces: list) -> None:
        self.out.append(pieces)

    def add(self, doc_id, ids: bytes) -> None:
        total, whole = len(ids) // 4, self.size * 4
        start = 0
        while len(ids) - start * 4 >= whole:
            self._emit([(doc_id, start, ids[start * 4 : start * 4 + whole], total)])
            start += self.size
        while rest := total - start:
            k = bisect_left(self.free, (rest, -1))
            if k == len(self.free) and len(self.windows) >= self.most:
                room, window = self.free.pop(0)
                pieces = self.windows.pop(window)
                if room >= self.slack:
                    pieces.append((doc_id, start, ids[start * 4 : (start + room) * 4], total))
                    start += room
                self._emit(pieces)
                continue
            if k < len(self.free):
                room, window = self.free.pop(k)
            else:
                room, window = self.size, self.number
                self.number += 1
                self.windows[window] = []
            self.windows[window].append((doc_id, start, ids[start * 4 :], total))
            if room == rest:
                self._emit(self.windows.pop(window))
            else:
                insort(self.free, (room - rest, window))
            start = total

    def close(self) -> list | None:
        """Runs the open windows together; what is left of a last window."""
        run, size = [], 0
        for _, window in self.free:
            for doc_id, start, ids, total in self.windows[window]:
                while ids:
                    part = ids[: (self.size - size) * 4]
                    run.append((doc_id, start, part, total))
                    size, start, ids = size + len(part) // 4, start + len(part) // 4, ids[len(part) :]
                    if size == self.size:
                        self._emit(run)
                        run, size = [], 0
        self.windows, self.free = {}, []
        return run or None


def _rows(windows: list[list], first: int, leftover: int, with_ids: bool) -> list[tuple]:
    rows = []
    for k, pieces in enumerate(windows):
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            rows.append((doc_id, start, n, zlib.crc32(ids), total, first + k, offset, leftover, *([ids] if with_ids else [])))
            offset += n
    return rows


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int, most: int, slack: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    words, packer = tokenizer(path), _Packer(size, most, slack)
    fields = [("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("leftover", pa.int32())] + ([("ids", pa.binary())] if with_ids else [])
    schema, number = pa.schema(fields), TaskContext.get().partitionId() << 32
    end = end_id.to_bytes(4, "little")

    def rows(windows, leftover=0):
        nonlocal number
        got = _rows(windows, number, leftover, with_ids)
        number += len(windows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)

    for batch in batches:
        column = batch.column(1)
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            packer.add(doc_id, words.ids(column[i].as_py()) + end)
            if len(packer.out) >= 512:
                yield rows(packer.out)
                packer.out = []
    last = packer.close()
    if packer.out:
        yield rows(packer.out)
    if last:
        yield rows([last], 1)


def _merge(group: pd.DataFrame, size: int) -> pd.DataFrame:
    """Best-fit merging of whole leftover windows, fullest first; ids stay in the same pieces."""
    group = group.sort_values(["sequence_id", "offset"], kind="stable")
    lengths = group.groupby("sequence_id", sort=True)["length"].sum()
    free: list[tuple[int, int]] = []
    to, shift = {}, {}
    for window, n in sorted(lengths.items(), key=lambda x: (-x[1], x[0])):
        k = bisect_left(free, (n, -1))
        room, target = free.pop(k) if k < len(free) else (size, window)
        to[window], shift[window] = target, size - room
        if room > n:
            insort(free, (room - n, target))
    group["offset"] += group["sequence_id"].map(shift)
    group["sequence_id"] = group["sequence_id"].map(to)
    return group.drop(columns=["part"])


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", size: int = 2048, end_id: int = 1, open_windows: int = 64, slack: int = 8, merge_width: int = 256, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    A document's ids are those of its text and ``end_id``; a null or empty text has the end id alone.
    Every id lies in one piece; the offsets of a sequence have no gaps. ``ids`` (with_ids) holds the
    ids as little-endian 32-bit numbers. Rows that repeat, or that have a null id, are packed each by
    itself. The partition pass is written once to the shared folder: a lost executor cannot deal a
    partition anew under the same sequence numbers. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = _DDL + (", ids binary" if with_ids else "")
    first = materialise(texts.mapInArrow(partial(_pack, path=vocabulary, end_id=end_id, size=size, most=open_windows, slack=slack, with_ids=with_ids), ddl), "packed")
    done = first.where("leftover = 0")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return _merge(group, size)

    part = F.expr(f"shiftright(sequence_id, 32) div {merge_width}")
    merged = first.where("leftover = 1").withColumn("part", part).groupBy("part").applyInPandas(merge, ddl)
    return done.unionByName(merged).drop("leftover")
