"""The raw landing folder and what was asked for: integrity, retries, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.ident import request_key

#: The headers that are kept.
KEPT_HEADERS = ("cache-control", "content-type", "date", "etag", "expires", "last-modified", "retry-after", "x-ratelimit-limit", "x-ratelimit-remaining", "x-ratelimit-reset", "x-ratelimit-resource")
#: Statuses worth another attempt.
TRANSIENT = (429, 500, 502, 503, 504)

SIDECAR = "request STRUCT<method:STRING,url:STRING,body_sha256:STRING>, response STRUCT<status_code:INT,content_type:STRING,retrieved_at:STRING,body_sha256:STRING,body_size:BIGINT,headers:MAP<STRING,STRING>>"


def raw_store(spark: SparkSession, path: str) -> DataFrame:
    """Bodies joined to their sidecars by the key in the file names, with ``problem`` where they disagree.

    A full outer join: a body without a sidecar, or the reverse, is a row with a problem.
    """
    stem = lambda c: F.regexp_replace(F.regexp_replace(c, r"^[a-z]+:/+", "/"), r"\.[a-z]+$", "")
    bodies = spark.read.format("binaryFile").option("pathGlobFilter", "*.body").option("recursiveFileLookup", "true").load(path)
    bodies = bodies.select(stem(F.col("path")).alias("stem"), F.col("content"))
    cards = spark.read.schema(SIDECAR).option("multiLine", "true").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(path)
    cards = cards.select(stem(F.input_file_name()).alias("stem"), "request", "response")
    joined = bodies.join(cards, "stem", "full_outer").withColumn("key", F.regexp_extract("stem", r"([0-9a-f]{64})$", 1))
    named = request_key(F.col("request.method"), F.col("request.url"), F.col("request.body_sha256"))
    problem = integrity(F.col("content"), F.col("response.body_size"), F.col("response.body_sha256"))
    return joined.withColumn("problem", F.coalesce(problem, F.when(~named.eqNullSafe(F.col("key")), "request key differs")))


def integrity(content: Column, size: Column, sha256: Column) -> Column:
    """What is wrong with a body and its record, null if nothing is."""
    return (
        F.when(content.isNull() | size.isNull(), "half of a pair is missing")
        .when(F.octet_length(content) != size, "size differs")
        .when(F.sha2(content, 256) != sha256, "digest differs")
    )


def retry_after_seconds(header: Column, now: Column) -> Column:
    """A Retry-After header as seconds from ``now``: a whole number, or a date in GMT; null if it is neither or negative."""
    day = F.regexp_extract(header, r"(\d{1,2} [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d) GMT$", 1)
    until = F.try_to_timestamp(F.concat(day, F.lit(" +0000")), F.lit("d MMM yyyy HH:mm:ss Z"))
    count = F.when(header.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(header).try_cast("double"))
    wait = F.when(until.isNotNull(), F.greatest(F.lit(0.0), until.cast("double") - now.cast("double")))
    return F.when(count.isNotNull(), F.when(count >= 0, count)).otherwise(wait)


def retry_decision(status: Column, attempt: Column, asked: Column, limited: Column | None = None, most: int = 4, initial: float = 0.5, cap: float = 30.0) -> Column:
    """struct<retry, delay, reason> of one response.

    Transient statuses, and a 403 of a spent quota (``limited``), back off exponentially up to ``cap``. A
    wait that the provider asks for is a lower bound; one over ``cap`` is refused.
    """
    spent = F.coalesce((status == 403) & limited, F.lit(False)) if limited is not None else F.lit(False)
    passing = status.isin(*TRANSIENT) | spent
    backoff = F.least(F.lit(initial) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt - 1)), F.lit(cap))
    reason = (
        F.when(~F.coalesce(passing, F.lit(False)), "permanent_status")
        .when(attempt > most, "attempts_exhausted")
        .when(asked > cap, "wait_over_bound")
        .when(asked.isNotNull(), F.when(spent, "github_rate_limit").otherwise("retry_after"))
        .otherwise("transient_status")
    )
    again = ~reason.isin("permanent_status", "attempts_exhausted", "wait_over_bound")
    return F.struct(again.alias("retry"), F.when(again, F.greatest(backoff, asked.cast("double"))).alias("delay"), reason.alias("reason"))


def kept_headers(headers: Column) -> Column:
    """Allowed headers only: lower-case names, values of at most 2048 characters, in order of name."""
    lower = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("k"), F.left(e["value"], F.lit(2048)).alias("v")))
    return F.array_sort(F.filter(lower, lambda e: e["k"].isin(*KEPT_HEADERS)))
