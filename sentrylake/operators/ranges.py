"""Projection of affected ranges onto a version inventory.

The inventory is ranked once, together with every boundary that ranges name, so a boundary is known by
how many versions lie below it and up to it. An event list then is a few intervals of ranks, found by
folding the events at each change; equal lists are folded once. No range is held against versions
that it does not match. Specifiers, which are no intervals, are held against the inventory one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions import pep440
from sentrylake.operators.evidence import ratio
from sentrylake.operators.ranking import running_total
from sentrylake.session import materialise

#: An inventory of at most so many versions is broadcast to the specifiers.
BROADCAST_VERSIONS = 100_000


def list_id(events: Column) -> Column:
    """128 bits that name an event list."""
    return F.md5(F.to_json(F.struct(events)))


def ranked_inventory(inventory: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((rank, key, text) of the distinct versions, (key, below, upto) of the boundary keys).

    inventory has ``version``, a parsed struct; bounds has ``key``. Equal versions that differ as text
    are all kept, in order of key, then text.
    """
    lost = F.raise_error(F.lit("the inventory holds a version that cannot be parsed"))
    whole = inventory.where(F.when(F.col("version").isNull(), lost).otherwise(F.lit(True)))
    stock = whole.select("version.key", "version.text").distinct().select("key", F.lit(1).alias("kind"), "text")
    edges = bounds.select("key").where("key IS NOT NULL").distinct()
    both = edges.select("key", F.explode(F.array(F.lit(0), F.lit(2))).alias("kind"), F.lit("").alias("text"))
    placed = running_total(stock.unionByName(both), F.col("kind") == 1, "key", "kind", "text")
    stock = placed.where("kind = 1").select((F.col("total") - 1).alias("rank"), "key", "text")
    edges = placed.where("kind <> 1").groupBy("key").agg(F.min("total").alias("below"), F.max("total").alias("upto"))
    return stock, edges


def _at(rank: Column, events: Column) -> Column:
    """Whether the version of a rank is affected: the events are folded in order."""

    def step(acc: Column, e: Column) -> Column:
        return (
            F.when(e["kind"] == "introduced", F.when(e["zero"] | (rank >= e["below"]), True).otherwise(acc))
            .when(e["kind"] == "last_affected", F.when(rank >= e["upto"], False).otherwise(acc))
            .otherwise(F.when(rank >= e["below"], False).otherwise(acc))
        )

    return F.aggregate(events, F.lit(False), step)


def _intervals(events: Column, size: Column) -> Column:
    """array<struct<lo, hi>> of affected ranks; between two changes nothing changes."""
    edge = F.lit(0).cast("bigint")
    points = F.array_sort(F.array_distinct(F.concat(F.array(edge), F.array_compact(F.flatten(F.transform(events, lambda e: F.array(e["below"], e["upto"])))))))
    return pep440.let(
        F.filter(points, lambda p: p < size),
        lambda ps: F.filter(
            F.transform(ps, lambda p, i: F.struct(p.alias("lo"), F.coalesce(F.get(ps, i + 1), size).alias("hi"), _at(p, events).alias("on"))),
            lambda x: x["on"],
        ),
    )


def resolve_intervals(ranges: DataFrame, inventory: DataFrame, events: str = "events") -> tuple[DataFrame, DataFrame]:
    """((id, error, spans) of the distinct event lists, (rank, key, text) of the inventory).

    id is ``list_id``; spans are intervals [lo, hi) of ranks, empty where there is an error.
    """
    lists = ranges.select(list_id(F.col(events)).alias("id"), F.col(events).alias("events")).groupBy("id").agg(F.first("events").alias("events"))
    lists = materialise(lists.withColumn("keyed", pep440.event_keys(F.col("events"))).withColumn("error", pep440.event_error(F.col("keyed"))).drop("events"), "event-lists")
    named = lists.where("error IS NULL").select("id", F.posexplode("keyed").alias("place", "e"))
    stock, edges = ranked_inventory(inventory, named.select("e.key"))
    stock = materialise(stock, "ranked")
    size = stock.count()
    placed = named.join(edges, named["e"]["key"].eqNullSafe(edges["key"]), "left")
    one = F.struct("place", F.col("e.kind").alias("kind"), F.col("e.zero").alias("zero"), "below", "upto")
    folded = placed.groupBy("id").agg(F.array_sort(F.collect_list(one)).alias("placed")).select("id", _intervals(F.col("placed"), F.lit(size).cast("bigint")).alias("spans"))
    return lists.select("id", "error").join(folded, "id", "left").select("id", "error", F.coalesce("spans", F.expr("CAST(array() AS array<struct<lo:bigint,hi:bigint,on:boolean>>)")).alias("spans")), stock


def resolve_events(ranges: DataFrame, inventory: DataFrame, events: str = "events") -> DataFrame:
    """Per distinct event list: id, error, resolved (structs of key and text in PEP 440 order; null where none)."""
    lists, stock = resolve_intervals(ranges, inventory, events)
    lists = materialise(lists, "intervals")
    ranks = lists.select("id", F.explode("spans").alias("s")).select("id", F.explode(F.sequence("s.lo", F.col("s.hi") - 1)).alias("rank"))
    hits = ranks.join(stock, "rank").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("key", "text"))).alias("resolved"))
    return lists.select("id", "error").join(hits, "id", "left")


def specifier_hits(specs: DataFrame, inventory: DataFrame, spec: str = "spec", prereleases: bool | None = True) -> DataFrame:
    """(spec, version) of every inventory version that satisfies a valid specifier.

    The side that is broadcast is counted first; beyond BROADCAST_VERSIONS Spark deals out the pairs.
    """
    valid = specs.select(F.col(spec).alias("spec")).distinct().where(pep440.specifier_error(F.col("spec")).isNull())
    stock = inventory.select("version").distinct()
    small = stock.limit(BROADCAST_VERSIONS + 1).count() <= BROADCAST_VERSIONS
    return valid.crossJoin(F.broadcast(stock) if small else stock).where(pep440.specifier_match(F.col("version"), F.col("spec"), prereleases))


def range_statistics(resolved: DataFrame, issues: DataFrame) -> DataFrame:
    """One row of eight counters of a projection, and the share of advisories that it could resolve (1.0 of none)."""
    one = resolved.agg(F.count("*").alias("total_advisories"), F.coalesce(F.sum(F.size("affected_ranges")), F.lit(0)).cast("bigint").alias("total_ranges"))
    of = lambda kind: F.count_if(F.col("kind") == kind)
    two = issues.agg(
        F.count_distinct(F.when(F.col("kind") == "unresolvable", F.col("canonical"))).alias("unresolvable_advisories"), of("invalid_range").alias("invalid_ranges"),
        of("missing_fixed_version").alias("missing_fixed_versions"), of("contradictory_ranges").alias("contradictory_ranges"),
    )
    row = one.crossJoin(two)
    good = F.col("total_advisories") - F.col("unresolvable_advisories")
    return row.select("*", good.alias("resolvable_advisories"), (F.col("total_ranges") - F.col("invalid_ranges")).alias("resolved_ranges"), ratio(good, F.col("total_advisories")).alias("coverage_ratio"))
