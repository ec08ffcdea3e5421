"""Alias clusters of advisories and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.ident import canonical_id
from sentrylake.functions.text import sorted_set
from sentrylake.operators.components import connected_components


def alias_components(records: DataFrame, id_col: str, aliases_col: str) -> DataFrame:
    """(record, component): records that share identifiers, directly or through others.

    Records hang on their identifiers (a row per identifier, so a common one gathers nothing); the
    component is the least record id.
    """
    ends = records.select(F.col(id_col).alias("record"), F.explode(aliases_col).alias("alias"))
    hub = ends.groupBy("alias").agg(F.min("record").alias("hub"))
    edges = ends.join(hub, "alias").select(F.col("record").alias("src"), F.col("hub").alias("dst"))
    found = connected_components(edges)
    return records.select(F.col(id_col).alias("record")).distinct().join(found, F.col("record") == F.col("node"), "left").select("record", F.coalesce("component", "record").alias("component"))


def first_by(value: str, order: str) -> Column:
    """The first non-null value in source order."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def _union(lists: str) -> Column:
    """The distinct values of a group's lists; equal lists are combined before the shuffle."""
    return sorted_set(F.flatten(F.collect_set(lists)))


def merge_clusters(records: DataFrame, component: str = "component", ordinal: str = "ordinal") -> DataFrame:
    """One row per cluster of feed records.

    Sets are unions; summary, severity, cvss and the package are the first in source order, details the
    longest (the first of equal length), dates the widest span, ranges distinct in source order, sources
    the first of each type and id. No text but the one picked is gathered. ``ghsas`` are the
    members' own canonical GHSA identifiers.
    """
    longest = F.min_by("details", F.when(F.col("details").isNotNull(), F.struct(-F.length("details"), ordinal)))
    in_order = lambda c: F.sort_array(F.collect_set(F.struct(ordinal, c)))[c]
    merged = records.groupBy(component).agg(
        F.count("*").alias("members"), _union("ids").alias("ids"), first_by("own_id", ordinal).alias("own_id"),
        first_by("summary", ordinal).alias("summary"), first_by("severity", ordinal).alias("severity"), first_by("cvss", ordinal).alias("cvss"),
        longest.alias("details"), F.min("published").alias("published"), F.max("modified").alias("modified"),
        _union("cwe").alias("cwe"), _union("references").alias("references"), _union("commits").alias("commits"),
        _union("affected").alias("affected"), _union("fixed").alias("fixed"),
        F.array_distinct(F.flatten(in_order("ranges"))).alias("ranges"), in_order("source").alias("sources"),
        first_by("package_name", ordinal).alias("package_name"), first_by("ecosystem", ordinal).alias("ecosystem"),
        sorted_set(F.collect_set(F.when(F.col("canonical").startswith("GHSA-"), F.col("canonical")))).alias("ghsas"),
    )
    return merged.withColumn("canonical", canonical_id(F.col("ids")))


def conflicts(clusters: DataFrame) -> DataFrame:
    """(canonical_id, conflicting_ids, reason) of clusters with two canonical GHSA identifiers or more."""
    reason = F.lit("multiple distinct GHSA canonical IDs merged into single cluster")
    return clusters.where(F.size("ghsas") > 1).select(F.col("canonical").alias("canonical_id"), F.col("ghsas").alias("conflicting_ids"), reason.alias("reason"))
