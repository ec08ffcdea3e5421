"""Exact dedup by skew-safe combining.

Texts are equal when identical after lower-casing A-Z only. Three stages, each comparing the whole
content (a lossless compressed copy of it; equal contents give equal copies and different contents
different ones), never a digest alone:

1. each task keeps one winner per distinct content of an Arrow batch (``_local_winners``);
2. winners meet by (digest, salt, content), so a text copied into every partition is spread over
   ``salts`` reducers that each get a row per batch, not a row per copy;
3. the salt winners meet by (digest, content).

A row then finds its group by digest; groups of more than a thousandth of the rows, so at most a
thousand, are broadcast and their rows stay where they are (``join_hot``), so no group of copies meets
in one task. Should two contents share a digest, rows of all digests are joined by content instead
(``_by_content``), which costs a shuffle of the content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.arrays import byte_view
from sentrylake.operators.ranking import join_hot
from sentrylake.session import materialise

_WINNERS = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("best", pa.int64()), ("n", pa.int64()), ("salt", pa.int32())])
_MEMBERS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("sha", pa.string())])


def _normalised(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    data, ends = byte_view(batch.column(1))
    view = data.tobytes() if len(data) < 1 << 20 else memoryview(data)
    for i, doc_id in enumerate(batch.column(0).to_pylist()):
        yield doc_id, bytes(view[ends[i] : ends[i + 1]]).lower()  # bytes.lower() changes A-Z alone


def _local_winners(batches: Iterator[pa.RecordBatch], digest_bytes: int, salts: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, packer = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=1)
    for batch in batches:
        seen: dict[bytes, list] = {}
        for doc_id, text in _normalised(batch):
            slot = seen.setdefault(text, [doc_id, 0])
            slot[1] += 1
            if slot[0] is None or (doc_id is not None and doc_id > slot[0]):
                slot[0] = doc_id
        rows = [(hashlib.sha256(t).digest()[:digest_bytes], packer.compress(t), best, n, task % salts) for t, (best, n) in seen.items()]
        for lo in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo : lo + 2000]), _WINNERS)], schema=_WINNERS)


def _members(batches: Iterator[pa.RecordBatch], digest_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shas = [hashlib.sha256(t).digest() for _, t in _normalised(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s[:digest_bytes] for s in shas], pa.binary()), pa.array([s.hex() for s in shas], pa.string())], schema=_MEMBERS)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=1)
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.binary()), ("sha", pa.string())])
    for batch in batches:
        rows = [(i, packer.compress(t), hashlib.sha256(t).hexdigest()) for i, t in _normalised(batch)]
        for lo in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo : lo + 2000]), schema)], schema=schema)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, digest_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The largest id of a group stays. A null text counts as empty. A null id is smaller than any
    other: it stays only in a group without ids, where keep_id is null and kept true. Rows that
    repeat an id and a text are the same document: all of them count, all carry the same ``kept``.
    An empty table gives an empty result; other columns are ignored whatever their names.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    local = texts.mapInArrow(partial(_local_winners, digest_bytes=digest_bytes, salts=salts), "digest binary, content binary, best bigint, n bigint, salt int")
    salted = local.groupBy("digest", "salt", "content").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    groups = salted.groupBy("digest", "content").agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"))
    classes = materialise(groups.select("digest", "keep_id", "group_size"), "exact-groups")
    if classes.groupBy("digest").count().where("count > 1").isEmpty():
        members = texts.mapInArrow(partial(_members, digest_bytes=digest_bytes), "doc_id bigint, digest binary, sha string")
        total = classes.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
        joined = join_hot(members, classes, "digest", "group_size", total)
    else:
        joined = _by_content(texts, groups)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _by_content(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """The way for digests that two contents share: rows meet their group by content."""
    members = texts.mapInArrow(_contents, "doc_id bigint, content binary, sha string")
    return members.join(groups.select("content", "keep_id", "group_size"), "content")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that a larger id with an equal text replaces.

    A row stays by its id and its text together: of two texts under one id each is judged by itself.
    Rows that repeat an id and a text all stay.
    """
    stays = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("__stays"), F.col("text_sha256").alias("__sha")).distinct()
    sha = F.sha2(F.translate(F.coalesce(docs[text_col].cast("string"), F.lit("")), _UPPER, _LOWER), 256)
    return docs.join(stays, docs[id_col].eqNullSafe(stays["__stays"]) & (sha == stays["__sha"]), "left_semi")
