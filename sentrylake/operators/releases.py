"""Tags, releases and their correlation with versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.pep440 import parse


def tag_candidate(tag: Column) -> Column:
    """struct<text, match_type, confidence>: ``release-`` (0.8), then ``v`` (1.0), then the tag itself."""

    def made(rest: Column, kind: str, confidence: float) -> Column:
        text = parse(rest)["text"]
        return F.when(text.isNotNull(), F.struct(text.alias("text"), F.lit(kind).alias("match_type"), F.lit(confidence).alias("confidence")))

    return F.coalesce(
        F.when(tag.startswith("release-"), made(F.substr(tag, F.lit(9)), "release_prefix", 0.8)),
        F.when(tag.startswith("v"), made(F.substr(tag, F.lit(2)), "v_prefix", 1.0)),
        made(tag, "exact", 1.0),
    )


def preferred_tags(tags: DataFrame) -> DataFrame:
    """(name, sha) -> one tag per version: highest confidence, then v over exact over release, then name."""
    parsed = tags.withColumn("c", tag_candidate(F.col("name"))).where("c IS NOT NULL")
    rank = F.expr("CASE c.match_type WHEN 'v_prefix' THEN 3 WHEN 'exact' THEN 2 ELSE 1 END")
    best = F.max(F.struct(F.col("c.confidence").alias("confidence"), rank.alias("rank"), "name", "sha", F.col("c.match_type").alias("match_type")))
    return parsed.groupBy(F.col("c.text").alias("normalized_version")).agg(best.alias("b")).select("normalized_version", F.col("b.name").alias("git_tag"), F.col("b.sha").alias("commit_sha"), F.col("b.match_type").alias("match_type"), F.col("b.confidence").alias("confidence"))


RELEASES = "ARRAY<STRUCT<tag_name:STRING,html_url:STRING,body:STRING>>"


def release_rows(bodies: DataFrame) -> DataFrame:
    """(tag_name, release_url, release_body) of landed release lists; of one tag's releases the last counts."""
    told = bodies.select("retrieved_at", "body_sha256", F.posexplode(F.from_json("body", RELEASES)).alias("place", "r")).where("r.tag_name IS NOT NULL")
    last = F.max_by(F.struct(F.col("r.html_url").alias("release_url"), F.col("r.body").alias("release_body")), F.struct("retrieved_at", "body_sha256", "place"))
    return told.groupBy("r.tag_name").agg(last.alias("l")).select("tag_name", "l.*")


def correlate(versions: DataFrame, tags: DataFrame, releases: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per version with the evidence for it: tag, release of that tag's name, changelog entries.

    versions has normalized_version; tags are ``preferred_tags``, releases ``release_rows``, entries
    ``changelog.by_version``. Versions without a tag are not resolved and have no release.
    """
    joined = versions.select("normalized_version").join(tags, "normalized_version", "left").join(releases, F.col("git_tag") == F.col("tag_name"), "left")
    joined = joined.join(entries, "normalized_version", "left")
    return joined.select("normalized_version", "git_tag", "commit_sha", "release_url", "release_body", "changelog_entries", "match_type", F.col("git_tag").isNotNull().alias("is_resolved"))


def correlation_statistics(correlations: DataFrame, tags: DataFrame, releases: DataFrame, entries: DataFrame) -> DataFrame:
    """One row of seven counters of a correlation pass."""
    one = correlations.agg(F.count("*").alias("total_versions"), F.count_if("is_resolved").alias("resolved_versions"), F.count_if(~F.col("is_resolved")).alias("unresolved_versions"), F.count_distinct("git_tag").alias("matched"))
    two = tags.agg(F.count("*").alias("total_tags"))
    three = releases.agg(F.count("*").alias("total_releases"))
    four = entries.agg(F.coalesce(F.sum(F.size("changelog_entries")), F.lit(0)).cast("bigint").alias("total_changelog_entries"))
    row = one.crossJoin(two).crossJoin(three).crossJoin(four)
    return row.withColumn("unmatched_tags", F.col("total_tags") - F.col("matched")).drop("matched")
