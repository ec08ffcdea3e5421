"""Line dedup over content-defined chunks of lines (built-in functions only).

A text's lines (cut at ``\\n``) are hashed; a rolling hash over the last ``WINDOW`` line hashes chooses the
places where chunks end, so a passage put in or taken out shifts no boundary beyond its own
neighbourhood. Each text is cut ``EVERY`` times: the cut c ends its chunks where the rolling hash is c
modulo ``EVERY``, so every place ends a chunk of one cut, and a passage that one cut divides badly has
another chance. Chunks of two lines or more that are not blank and occur more than once in the corpus
stay at their first place (least document, then least line); elsewhere their lines are removed.

Chunks are compared by their whole text: the grouping key of the first pass is the text, combined
before the shuffle, so a passage that a third of the corpus shares costs a row per task. Places
then find their group by a 64-bit key, the commonest by a bounded broadcast; if two different texts share a key, places find their group by
text as well.

Chunks still miss short passages: two boundaries of one cut must fall inside both copies, and half of the
supplied texts have 3 to 8 lines. ``drop_repeats``, which the pipeline runs, lets an exact comparison of
every two lines follow the chunks, which has no boundaries and misses none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.operators.ranking import BROADCAST_ROWS, join_hot
from sentrylake.session import materialise

WINDOW, EVERY, BASE, MODULUS = 2, 2, 31, 1_000_003


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def line_hash(line: Column) -> Column:
    """The first 32 bits of a line's MD5, as a number."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def chunk_spans(lines: Column) -> Column:
    """array<struct<start, n>>: the chunks of an array of lines by all cuts, each once, start counted from 0."""

    def rolled(h: Column) -> Column:
        at = lambda i, back: F.element_at(h, (i - back + 1).cast("int")) % MODULUS
        value = lambda i: sum((at(i, back) * BASE**back for back in range(1, WINDOW)), at(i, 0)) % MODULUS
        return F.transform(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.when(i >= WINDOW - 1, value(i) % EVERY).otherwise(-1))

    def ends(r: Column, cut: int) -> Column:
        last = F.size(r) - 1
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.element_at(r, i + 1) == cut))

    def spans(e: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(e)),
            lambda k: _let(
                F.when(k > 1, F.element_at(e, F.greatest(k - 1, F.lit(1))) + 1).otherwise(0),
                lambda start: F.struct(start.alias("start"), (F.element_at(e, k) - start + 1).alias("n")),
            ),
        )

    def cuts(r: Column) -> Column:
        return F.array_distinct(F.concat(*[_let(ends(r, cut), spans) for cut in range(EVERY)]))

    return _let(_let(F.transform(lines, line_hash), rolled), cuts)


def _chunks(texts: DataFrame) -> DataFrame:
    """(doc_id, version, start, n, chunk, key) of every chunk of two lines or more that is not blank."""
    lined = texts.where("text IS NOT NULL").select("doc_id", "version", F.split("text", "\n").alias("lines"))
    pieces = F.expr("transform(spans, s -> struct(s.start AS start, s.n AS n, if(s.n > 1, array_join(slice(lines, s.start + 1, s.n), '\n'), '') AS chunk))")
    exploded = lined.withColumn("spans", chunk_spans(F.col("lines"))).select("doc_id", "version", F.explode(pieces).alias("c")).select("doc_id", "version", "c.*")
    return exploded.where("n > 1 AND chunk RLIKE '\\\\S'").withColumn("key", F.xxhash64("chunk"))


def _if_few(table: DataFrame, lists: str) -> DataFrame:
    """``table``, marked to be broadcast where its lists, none of which is empty, are counted to be short together."""
    total = table.agg(F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()[0]
    return F.broadcast(table) if total <= BROADCAST_ROWS else table


def _later_chunks(chunks: DataFrame) -> DataFrame:
    """(doc_id, version, start, n) of the chunks that are not the first of their text."""
    place = F.struct("doc_id", "start", "version")
    by_text = chunks.groupBy("chunk").agg(F.first("key").alias("key"), F.min(place).alias("first"), F.count("*").alias("places"))
    groups = materialise(by_text.select("key", "first", "places"), "chunk-groups")
    if groups.groupBy("key").count().where("count > 1").isEmpty():
        repeated = materialise(groups.where("places > 1"), "chunk-repeats")
        total = groups.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
        found = join_hot(chunks.select("doc_id", "version", "start", "n", "key"), repeated, "key", "places", total)
    else:
        repeated = by_text.where("places > 1").select("chunk", "first")
        found = chunks.select("doc_id", "version", "start", "n", "key", "chunk").join(repeated, "chunk")
    return found.where(~F.col("first").eqNullSafe(place)).select("doc_id", "version", "start", "n")


def _gone_lists(places: DataFrame, id_name: str, version_name: str, name: str) -> DataFrame:
    """Places of lines that go as one list of spans a document."""
    spans = F.collect_set(F.struct("start", "n")).alias(name)
    return places.groupBy(F.col("doc_id").alias(id_name), F.col("version").alias(version_name)).agg(spans)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: all its columns but the text, n_lines, n_chunks, n_removed_lines, text (what is left).

    A null text stays null with no lines; an empty text is one empty line and stays. A text whose
    lines all go becomes empty. Texts of any length are cut whole. Null ids come before any other.
    Rows that repeat an id and a text are one document: they keep and lose the same lines; texts
    under one id are told apart. Equal passages at one place in the order keep the first. A column of
    ``docs`` that has a counter's name stays as it is, and that counter is left out. An empty table
    gives an empty result.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    plain = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(plain).alias("version"), plain.alias("text"), F.struct(*others).alias("rest") if others else F.lit(None).alias("rest"))
    chunks = _chunks(base.select("doc_id", "version", "text"))
    if key_bits < 64:
        chunks = chunks.withColumn("key", F.col("key") % F.lit(1 << key_bits))
    gone = _gone_lists(_later_chunks(chunks), "gone_id", "gone_version", "gone")
    gone = _if_few(materialise(gone, "chunks-gone"), "gone")
    joined = base.join(gone, base["doc_id"].eqNullSafe(gone["gone_id"]) & (base["version"] == gone["gone_version"]), "left")
    lined = joined.select("doc_id", "rest", "text", F.split("text", "\n").alias("lines"), "gone")
    lined = lined.withColumn("spans", F.when(F.col("lines").isNotNull(), chunk_spans(F.col("lines"))))
    stays = F.expr("array_except(sequence(0, size(lines) - 1), flatten(transform(gone, s -> sequence(s.start, s.start + s.n - 1))))")
    kept = lined.withColumn("stays", F.when(F.col("gone").isNotNull(), stays))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.expr("array_join(transform(stays, i -> element_at(lines, i + 1)), '\n')"))
    n_lines = F.coalesce(F.array_size("lines"), F.lit(0)).cast("bigint")
    removed = F.coalesce(F.array_size("lines") - F.array_size("stays"), F.lit(0)).cast("bigint")
    counters = {"n_lines": n_lines, "n_chunks": F.coalesce(F.array_size("spans"), F.lit(0)).cast("bigint"), "n_removed_lines": removed}
    return kept.select("doc_id", *[F.col("rest")[c].alias(c) for c in others], *[v.alias(c) for c, v in counters.items() if c not in others], text.alias("text"))


def _pairs(texts: DataFrame) -> DataFrame:
    """(doc_id, version, start, key) of every two lines next to each other that are not both blank."""
    pairs = F.expr(
        "filter(transform(sequence(1, size(lines) - 1), i -> named_struct('start', i - 1, 'pair', concat(element_at(lines, i), '\n', element_at(lines, i + 1)))), p -> p.pair RLIKE '\\\\S')"
    )
    lined = texts.where("text IS NOT NULL").select("doc_id", "version", F.split("text", "\n").alias("lines")).where("size(lines) > 1")
    return lined.select("doc_id", "version", F.explode(pairs).alias("p")).select("doc_id", "version", "p.start", F.unhex(F.sha2("p.pair", 256)).alias("key"))


def _later_pairs(texts: DataFrame) -> DataFrame:
    """(doc_id, version, start, n) of every two lines that are not the first place of their pair."""
    pairs, place = _pairs(texts), F.struct("doc_id", "start", "version")
    groups = pairs.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("places"))
    repeated = materialise(groups.where("places > 1"), "pair-groups")
    total = repeated.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
    found = join_hot(pairs, repeated, "key", "places", total).where(~F.col("first").eqNullSafe(place))
    return found.select("doc_id", "version", "start", F.lit(2).alias("n"))


def _drop(docs: DataFrame, id_col: str, text_col: str, counter: str, *finds: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` without the lines that any of ``finds`` names, all judged on the texts as they are."""
    base = docs.withColumn("__version", F.xxhash64(F.col(text_col).cast("string")))
    texts = base.select(F.col(id_col).alias("doc_id"), F.col("__version").alias("version"), F.col(text_col).cast("string").alias("text"))
    places = finds[0](texts)
    for find in finds[1:]:
        places = places.unionByName(find(texts))
    gone = _if_few(materialise(_gone_lists(places, "__gone_id", "__gone_version", "__gone"), "lines-gone"), "__gone")
    same = base[id_col].eqNullSafe(gone["__gone_id"]) & (base["__version"] == gone["__gone_version"])
    joined = base.join(gone, same, "left").withColumn("__lines", F.split(F.col(text_col).cast("string"), "\n"))
    stays = F.expr("array_except(sequence(0, size(__lines) - 1), flatten(transform(__gone, s -> sequence(s.start, s.start + s.n - 1))))")
    kept = joined.withColumn("__stays", F.when(F.col("__gone").isNotNull(), stays))
    left = F.expr("array_join(transform(__stays, i -> element_at(__lines, i + 1)), '\n')")
    text = F.when(F.col("__gone").isNull(), F.col(text_col).cast("string")).otherwise(left)
    removed = F.coalesce(F.size("__lines") - F.array_size("__stays"), F.lit(0)).cast("bigint")
    return kept.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], removed.alias(counter))


def drop_repeated_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counter: str = "n_removed_lines") -> DataFrame:
    """One row per row of ``docs``: all its columns, the text without repeats, and ``counter`` (which docs must not have).

    Every two lines next to each other that are not both blank are compared, by SHA-256, with all
    others of the corpus; both lines go unless it is their first place (least document, then least
    line). So every line of a repeated passage of two lines or more goes, and of a run of one line
    the first stays. Nulls, empty texts and repeated rows are met as in ``dedup_lines``.
    """
    return _drop(docs, id_col, text_col, counter, _later_pairs)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counter: str = "n_removed_lines") -> DataFrame:
    """The same with the lines of the repeated content-defined chunks of ``dedup_lines`` gone too.

    Chunks come first; the pairs follow as the exact check of what their boundaries miss. Both are
    judged on the texts as they are, so what one removes makes no new neighbours for the other.
    """
    return _drop(docs, id_col, text_col, counter, lambda texts: _later_chunks(_chunks(texts)), _later_pairs)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_lines, kept_sha256."""
    slim = docs.select("doc_id", "text")
    return dedup_lines(slim).select("doc_id", "n_lines", "n_chunks", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
