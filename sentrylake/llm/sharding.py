"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (built-in functions only).

The ring has ``buckets`` equal arcs. A row falls into the arc of its key's hash; an arc's rows go to
the shard of the next virtual node clockwise. A shard takes no more than its bound; what overflows
continues clockwise to the next shard on the ring with room. The bounds are the row count divided by
the shards, rounded up for the first few and down for the others, so counts are at most one apart.

Rows that would come out alike (same id, size and checksum) are counted before the shuffle and dealt
as one row with a count. Arcs with many different rows, such as those of one id with many texts, are
cut into cells by a hash of the whole row. Only counts of arcs and cells, at most ``buckets`` + 2 *
``CELLS`` of them whatever the input, reach the driver, which walks the ring; the plan that comes back
has at most cells x shards rows. A row's place in its cell is a running total over that cell, which
holds at most about one in ``CELLS`` of the different rows.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.session import materialise

_PLAN = "array<struct<bucket:int,cell:int,lo:bigint,hi:bigint,shard:int,slot0:bigint>>"
#: An arc of more than one different row in so many is cut into cells.
CELLS = 1024
#: A run of alike rows that is longer is dealt out in pieces before it is written out row by row.
RUN = 100_000


def ring_preferences(shards: int, buckets: int, virtual_nodes: int) -> list[list[int]]:
    """For each arc, the shards in the order in which its rows meet them clockwise."""
    nodes = []
    for shard in range(shards):
        for copy in range(virtual_nodes):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{copy}".encode()).digest()[:8], "big")
            nodes.append((place * buckets >> 64, place, shard))
    nodes.sort()
    out, k = [], 0
    for bucket in range(buckets):
        while k < len(nodes) and nodes[k][0] < bucket:
            k += 1
        order: list[int] = []
        for step in range(len(nodes)):
            shard = nodes[(k + step) % len(nodes)][2]
            if shard not in order:
                order.append(shard)
                if len(order) == shards:
                    break
        out.append(order)
    return out


def bounded_plan(counts: dict[tuple[int, int], int], shards: int, buckets: int, virtual_nodes: int) -> list[dict]:
    """Which ranks of which (arc, cell) go to which shard, and from which slot on."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    left = dict(sorted(counts.items()))
    placed = dict.fromkeys(left, 0)
    prefs, plan = ring_preferences(shards, buckets, virtual_nodes), []
    for turn in range(shards):
        for bucket, cell in left:
            if left[bucket, cell]:
                shard = prefs[bucket][turn]
                take = min(left[bucket, cell], room[shard] - used[shard])
                if take:
                    plan.append({"bucket": bucket, "cell": cell, "lo": placed[bucket, cell], "hi": placed[bucket, cell] + take, "shard": shard, "slot0": used[shard]})
                    used[shard] += take
                    placed[bucket, cell] += take
                    left[bucket, cell] -= take
    return plan


def _arc(key: Column, buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 20), F.lit(buckets)).cast("int")


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", buckets: int = 4096, virtual_nodes: int = 64) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    law is ``rows``: shard counts are at most one apart; slots of a shard are 0, 1, ... without gaps.
    size is the text's UTF-8 bytes plus 1. A null or empty text has no bytes (crc32 0). A null id is
    a key like any other. Equal rows take neighbouring slots. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    alike = materialise(alike.withColumn("key", F.xxhash64("doc_id")).withColumn("bucket", _arc(F.col("key"), buckets)), "shard-rows")
    arcs = alike.groupBy("bucket").agg(F.count("*").alias("different"), F.max("n").alias("most")).collect()
    every = sum(r.different for r in arcs)
    cut = {r.bucket: -(-r.different * CELLS // every) for r in arcs if r.different * CELLS > every}
    pieces = F.lit(1)
    if cut:
        pieces = F.coalesce(F.element_at(F.from_json(F.lit(json.dumps({str(k): v for k, v in cut.items()})), "map<string,int>"), F.col("bucket").cast("string")), F.lit(1))
    celled = alike.withColumn("cell", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), pieces).cast("int"))
    counts = {(r[0], r[1]): r[2] for r in celled.groupBy("bucket", "cell").agg(F.sum("n")).collect()}
    plan = bounded_plan(counts, shards, buckets, virtual_nodes)
    table = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(plan)), _PLAN)).alias("p")).select("p.*").withColumnsRenamed({"bucket": "p_bucket", "cell": "p_cell"})
    w = Window.partitionBy("bucket", "cell").orderBy("key", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = celled.withColumn("end", F.sum("n").over(w)).withColumn("begin", F.col("end") - F.col("n"))
    here = (F.col("bucket") == F.col("p_bucket")) & (F.col("cell") == F.col("p_cell")) & (F.col("begin") < F.col("hi")) & (F.col("end") > F.col("lo"))
    first, last = F.greatest("begin", "lo"), F.least("end", "hi")
    runs = ranked.join(F.broadcast(table), here).select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + first - F.col("lo")).alias("from"), (F.col("slot0") + last - F.col("lo") - 1).alias("to"))
    if any(r.most > RUN for r in arcs):
        long = runs.where(F.col("to") - F.col("from") >= RUN).withColumn("from", F.explode(F.sequence("from", "to", F.lit(RUN).cast("bigint"))))
        long = long.withColumn("to", F.least("to", F.col("from") + (RUN - 1))).repartition("shard", "from")
        runs = runs.where(F.col("to") - F.col("from") < RUN).unionByName(long)
    return runs.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.explode(F.sequence("from", "to")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
