"""Identifiers: canonical choice, stable record ids, package names, commit hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_with(ids: Column, *prefixes: str) -> Column:
    """The first identifier with one of the prefixes, whatever its case; null if there is none."""
    fits = lambda i: i.rlike("(?iu)^(?:" + "|".join(prefixes) + ")")
    return F.get(F.filter(ids, fits), F.lit(0))


def canonical_id(ids: Column) -> Column:
    """GHSA, else CVE, else PYSEC or OSV, else the first; within a tier the first of the list."""
    return F.coalesce(first_with(ids, "GHSA-"), first_with(ids, "CVE-"), first_with(ids, "PYSEC-", "OSV-"), F.get(ids, F.lit(0)))


def canonical_json(**fields: Column) -> Column:
    """A JSON object with sorted keys, no blanks, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def stable_record_id(kind: str, **fields: Column) -> Column:
    """kind:sha256 of the identity's canonical JSON."""
    return F.concat(F.lit(kind + ":"), F.sha2(canonical_json(**fields), 256))


def package_name(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[-_.]+", "-"))


def commit_in_url(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?i)github\.com/[^/]+/[^/]+/commit/([0-9a-f]{64}|[0-9a-f]{40})", 1)
    # the address is read once
    return F.element_at(F.transform(F.array(found), lambda f: F.when(f != "", F.lower(f))), 1)


# Query keys, letters and digits only, that carry credentials.
SECRET_KEYS = ("accesskey", "accesstoken", "apikey", "authorization", "clientsecret", "password", "secret", "signature", "token")
#: The longest URL that is asked for.
LONGEST_URL = 8192


def _pairs(url: Column) -> Column:
    """Query pairs as array<struct<k, v>>, decoded, in order; pairs without ``=`` have an empty value."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    plain = lambda t: F.coalesce(F.try_url_decode(t), t)
    return F.array_sort(F.transform(parts, lambda p: F.struct(plain(F.substring_index(p, "=", 1)).alias("k"), plain(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v"))))


def _quoted(value: Column) -> Column:
    """Form encoding: blanks are plus signs; letters, digits and ``_.-~`` stay."""
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def request_url(url: Column) -> Column:
    """A URL with its query pairs in order and encoded anew, without a fragment or an empty query."""
    query = F.array_join(F.transform(_pairs(url), lambda p: F.concat(_quoted(p["k"]), F.lit("="), _quoted(p["v"]))), "&")
    bare = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.when(query == "", bare).otherwise(F.concat(bare, F.lit("?"), query))


def request_problem(method: Column, url: Column) -> Column:
    """Why a request is refused, null if it is not."""
    authority = F.regexp_extract(url, "^[^:/?#]+://([^/?#]*)", 1)
    secret = F.exists(_pairs(url), lambda p: F.regexp_replace(F.lower(p["k"]), "[^a-z0-9]", "").isin(*SECRET_KEYS))
    return (
        F.when(method.isNull() | ~F.trim(method).rlike("^[A-Za-z]{1,16}$"), "method is not a word of at most 16 letters")
        .when(url.isNull() | (F.length(url) > LONGEST_URL), "URL is missing or too long")
        .when(~F.lower(url).startswith("https://") | (authority == ""), "URL is not https with a host")
        .when(authority.contains("@"), "URL names a user")
        .when(secret, "URL carries credentials")
    )


def request_key(method: Column, url: Column, body_sha256: Column | None = None) -> Column:
    """sha256 of a request's identity: body digest, upper-case method, URL as ``request_url`` has it."""
    body = F.lit(None).cast("string") if body_sha256 is None else body_sha256
    return F.sha2(canonical_json(method=F.upper(F.trim(method)), url=request_url(url), body_sha256=body), 256)
