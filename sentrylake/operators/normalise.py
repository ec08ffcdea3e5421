"""Landed payloads to typed record families: versions, advisories, patches; and their JSON lines.

Structs name their fields in alphabetical order, so a record's JSON has sorted keys. Arrays are
never null. Order that matters is carried as an ordinal, never taken from row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions import pep440, text
from sentrylake.functions.ident import canonical_id, commit_in_url, first_with, stable_record_id
from sentrylake.operators.advisories import alias_components, merge_clusters
from sentrylake.operators.ranges import list_id, resolve_events, specifier_hits
from sentrylake.operators.releases import preferred_tags
from sentrylake.session import discard, in_slices, materialise, working

ARTIFACT = "STRUCT<filename:STRING,url:STRING,size:BIGINT,digests:STRUCT<sha256:STRING>,packagetype:STRING,python_version:STRING,requires_python:STRING,upload_time_iso_8601:STRING,yanked:BOOLEAN,yanked_reason:STRING>"
PROJECT = f"info STRUCT<name:STRING>, releases MAP<STRING,ARRAY<{ARTIFACT}>>"
TAGS = "ARRAY<STRUCT<name:STRING,commit:STRUCT<sha:STRING>>>"
VULN = (
    "STRUCT<id:STRING,summary:STRING,details:STRING,aliases:ARRAY<STRING>,modified:STRING,published:STRING,"
    "database_specific:STRUCT<cwe_ids:ARRAY<STRING>,cwe:ARRAY<STRING>,severity:STRING>,references:ARRAY<STRUCT<type:STRING,url:STRING>>,"
    "affected:ARRAY<STRUCT<package:STRUCT<name:STRING,ecosystem:STRING,purl:STRING>,ranges:ARRAY<STRUCT<type:STRING,"
    "events:ARRAY<STRUCT<introduced:STRING,fixed:STRING,last_affected:STRING,limit:STRING>>>>,versions:ARRAY<STRING>>>,"
    "severity:ARRAY<STRUCT<type:STRING,score:STRING>>>"
)
COMMIT = "sha STRING, html_url STRING, parents ARRAY<STRUCT<sha:STRING>>, files ARRAY<STRUCT<filename:STRING,status:STRING,patch:STRING>>"

_NONE = "CAST(array() AS array<string>)"
#: Releases of a project, artifacts of a release, characters of a text and of a release key, at most.
MOST_RELEASES, MOST_ARTIFACTS, MOST_TEXT, MOST_KEY = 10_000, 1_000, 4_096, 256


#: The end of a stamp that names its zone.
ZONE = r"(?:Z|[+-]\d\d:?\d\d)$"


#: A stamp that is sure to be an instant as it is written; most are.
SURE = r"^[1-9]\d{3}-(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\dZ\z"
#: One written alike, which may be no instant.
_ALIKE = r"^[1-9]\d{3}-\d\d-\d\dT\d\d:\d\d:\d\dZ\z"
_WRITTEN = """a -> concat(date_format(a, "yyyy-MM-dd'T'HH:mm:ss"), if(date_format(a, 'SSSSSS') <> '000000', concat('.', date_format(a, 'SSSSSS')), ''), 'Z')"""


def sql_iso_z(s: str) -> str:
    """``iso_z`` of a name, in SQL."""
    return f"""CASE WHEN {s} RLIKE r'{SURE}' THEN {s} WHEN {s} RLIKE r'{_ALIKE}' THEN CASE WHEN try_to_timestamp({s}) IS NOT NULL THEN {s} END
  WHEN {s} RLIKE r'{ZONE}' THEN {pep440.sql_let(f"try_to_timestamp({s})", _WRITTEN)} END"""


def iso_z(stamp: Column) -> Column:
    """An instant as ISO text in UTC; microseconds only where there are any. Needs a zone in the text."""
    return pep440.apply(stamp, f"s -> {sql_iso_z('s')}")


def provenance(source_type: str, source_id: Column) -> Column:
    """One provenance entry of a landed body (columns retrieved_at and body_sha256)."""
    return F.struct(F.lit("0.1.0").alias("extractor_version"), F.col("body_sha256").alias("raw_sha256"), iso_z(F.col("retrieved_at")).alias("retrieved_at"), source_id.alias("source_id"), F.lit(source_type).alias("source_type"))


def package(name: str, ecosystem: str) -> Column:
    return F.struct(F.lit(ecosystem).alias("ecosystem"), F.lit(name).alias("name"), F.lit(f"pkg:{ecosystem.lower()}/{name.lower()}").alias("purl"))


def by_version(values: Column, equal_texts: bool = False) -> Column:
    """Version texts in PEP 440 order, then by text. Equal versions are one unless equal_texts."""
    firsts = (lambda keyed: f"{keyed}.t") if equal_texts else (lambda keyed: f"{pep440.sql_let(keyed, 'a -> filter(a, (p, i) -> i = 0 OR get(a, i - 1).k <> p.k)')}.t")
    pairs = f"transform(u, w -> {pep440.sql_let(pep440.sql_parse('w'), 'p -> named_struct(\'k\', p.key, \'t\', p.text)')})"
    ordered = firsts(f"filter(array_sort(array_distinct({pairs})), p -> p.t IS NOT NULL)")
    plain = firsts(f"sort_array(transform(u, w -> named_struct('k', {pep440.sql_normal_key('w')}, 't', w)))")
    # a single text has no order, so its key is not needed; texts that are normal already are ordered without parsing
    several = f"CASE WHEN forall(u, w -> coalesce({pep440.sql_is_normal('w')}, false)) THEN {plain} ELSE {ordered} END"
    return pep440.apply(F.array_distinct(values), f"u -> CASE WHEN size(u) <= 1 THEN array_compact(transform(u, w -> {pep440.sql_normal_text('w')})) ELSE {several} END")


def _releases(project: DataFrame) -> DataFrame:
    """(source, raw_version, files, v) of every release key of landed project bodies; v is null where it is no version."""
    parsed = project.select(F.from_json("body", PROJECT).alias("p"), provenance("pypi", F.col("url")).alias("source"))
    held = F.when(F.size("p.releases") > MOST_RELEASES, F.raise_error(F.lit(f"project body exceeds {MOST_RELEASES} releases"))).otherwise(F.col("p.releases"))
    return parsed.select("source", F.explode(held).alias("raw_version", "files")).withColumn("v", pep440.parse(F.col("raw_version")))


def unparsable_versions(project: DataFrame) -> DataFrame:
    """(raw_version): the release keys that are no PEP 440 versions."""
    return _releases(project).where("v IS NULL").select("raw_version").distinct()


_TEXTS = [f"a.{c}" for c in ("filename", "url", "packagetype", "python_version", "requires_python", "yanked_reason")]
#: What is wrong with one artifact; what is sound is told from one look at each field.
_WRONG = f"""a -> CASE
  WHEN a.filename IS NULL OR NOT (a.filename >= '!' AND a.filename < '\x7f') AND {text.sql_blank_to_null("a.filename")} IS NULL THEN 'artifact without a filename'
  WHEN greatest({", ".join(f"octet_length({t})" for t in _TEXTS)}) > {MOST_TEXT} AND greatest({", ".join(f"char_length({text.sql_strip(t)})" for t in _TEXTS)}) > {MOST_TEXT} THEN 'artifact text exceeds {MOST_TEXT} characters'
  WHEN a.yanked IS NULL THEN 'artifact yanked flag is not a boolean'
  WHEN a.size < 0 THEN 'artifact size is negative'
  WHEN NOT a.upload_time_iso_8601 RLIKE r'{SURE}' AND {pep440.sql_let(text.sql_blank_to_null("a.upload_time_iso_8601"), f"u -> u IS NOT NULL AND (try_to_timestamp(u) IS NULL OR NOT u RLIKE r'{ZONE}')")} THEN 'artifact upload time is no datetime with a zone'
  END"""
_CLEAN = ", ".join(
    f"'{name}', {made}"
    for name, made in (
        ("filename", "a.filename"), ("is_yanked", "a.yanked"), ("package_type", text.sql_blank_to_null("a.packagetype")), ("python_version", text.sql_blank_to_null("a.python_version")),
        ("requires_python", text.sql_blank_to_null("a.requires_python")), ("sha256", text.sql_blank_to_null("a.digests.sha256")), ("size", "a.size"), ("upload_time", sql_iso_z("a.upload_time_iso_8601")),
        ("url", text.sql_blank_to_null("a.url")), ("yanked_reason", text.sql_blank_to_null("a.yanked_reason")),
    )
)


def release_problem(raw_version: Column, files: Column) -> Column:
    """What makes a release unusable, null if nothing does: bounds, required fields, dates without a zone."""
    found = F.get(F.array_compact(F.call_function("transform", files, F.expr(_WRONG))), F.lit(0))
    told = (
        F.when((raw_version == "") | (F.char_length(raw_version) > MOST_KEY), "release key is empty or too long")
        .when(F.size(files) > MOST_ARTIFACTS, f"release exceeds {MOST_ARTIFACTS} artifacts")
        .otherwise(found)
    )
    return F.when(told.isNotNull(), F.concat(F.lit("release "), F.left(raw_version, F.lit(MOST_KEY)), F.lit(": "), told))


def require(rows: DataFrame, problem: Column) -> DataFrame:
    """The rows; an error with the message of the first that has a problem."""
    return rows.where(F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.lit(True)))


def equal_versions(versions: DataFrame) -> DataFrame:
    """(key, texts) of the versions that two raw keys or more share under PEP 440."""
    rows = versions.groupBy("version.key").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("raw_version")).alias("texts"))
    return rows.where("n > 1").select("key", "texts")


def inventory_statistics(versions: DataFrame, unparsable: DataFrame) -> DataFrame:
    """One row: versions, pre-releases, yanked releases, artifacts, and release keys that are no versions."""
    one = versions.agg(
        F.count("*").alias("total_versions"), F.count_if("is_prerelease").alias("total_prereleases"), F.count_if("is_yanked").alias("total_yanked_versions"),
        F.coalesce(F.sum(F.size("artifacts")), F.lit(0)).cast("bigint").alias("total_artifacts"),
    )
    return one.crossJoin(unparsable.agg(F.count("*").alias("total_unparsable_versions")))


def version_records(project: DataFrame, tags: DataFrame, name: str, ecosystem: str) -> DataFrame:
    """One row per release of landed project bodies, with its preferred tag; see ``untagged_versions``."""
    return tagged_versions(untagged_versions(project, name, ecosystem), picked_tags(tags))


def picked_tags(tags: DataFrame) -> DataFrame:
    """(tagged, git_tag, commit_sha): the preferred tag of each version that the tag lists of (body) name."""
    rows = tags.select(F.explode(F.from_json("body", TAGS)).alias("t")).select("t.name", F.col("t.commit.sha").alias("sha"))
    return preferred_tags(rows).select(F.col("normalized_version").alias("tagged"), "git_tag", "commit_sha")


def tagged_versions(versions: DataFrame, picked: DataFrame) -> DataFrame:
    """The versions with their tags, null where there is none."""
    return versions.join(picked, F.col("normalized_version") == F.col("tagged"), "left").drop("tagged")


def untagged_versions(project: DataFrame, name: str, ecosystem: str) -> DataFrame:
    """One row per release of landed project bodies.

    project: (body, url, retrieved_at, body_sha256). Keys that are no versions are in
    ``unparsable_versions``; keys that are equal are in ``equal_versions``, which the engine refuses. A
    release over the bounds or with a broken artifact is an error. A project without releases gives an
    empty table; a release without artifacts is a row without a date.
    """
    rows = _releases(project).where("v IS NOT NULL")
    rows = require(rows, release_problem(F.col("raw_version"), F.col("files")))
    artifacts = F.expr(f"sort_array(transform(files, a -> named_struct({_CLEAN})))")
    rows = rows.withColumn("artifacts", artifacts)
    only = lambda c: pep440.let(F.array_distinct(F.array_compact(F.col(c))), lambda u: F.when(F.size(u) == 1, F.get(u, F.lit(0))))
    yanked = (F.size("artifacts") > 0) & F.forall("artifacts", lambda a: a["is_yanked"])
    purl = f"pkg:{ecosystem.lower()}/{name.lower()}"
    return rows.select(
        "artifacts", F.col("v.is_prerelease").alias("is_prerelease"), yanked.alias("is_yanked"), F.col("v.text").alias("normalized_version"),
        package(name, ecosystem).alias("package"), F.array("source").alias("provenance"), "raw_version",
        stable_record_id("version", package=F.lit(purl), version=F.col("v.text")).alias("record_id"), F.lit("version").alias("record_type"),
        F.array_min("artifacts.upload_time").alias("release_date"), only("artifacts.requires_python").alias("requires_python"), F.lit("1.0").alias("schema_version"),
        F.lit(None).cast("string").alias("support_branch"), F.lit(None).cast("string").alias("support_status"),
        F.when(yanked, only("artifacts.yanked_reason")).alias("yanked_reason"), F.col("v").alias("version"),
    )


def _boundary(value: Column) -> Column:
    """struct<v, sha>: ``0``, a version's text or a commit; both null otherwise."""
    sha = lambda clean: F.when(clean.rlike("(?i)^(?:[0-9a-f]{40}|[0-9a-f]{64})$"), F.lower(clean))
    made = lambda clean, v: F.struct(v.alias("v"), F.when(v.isNull(), sha(clean)).alias("sha"))
    return pep440.let(text.py_strip(value), lambda clean: pep440.let(pep440.normal_text(clean), lambda v: made(clean, v)))


def advisory_records(feed: DataFrame, name: str, ecosystem: str) -> DataFrame:
    """One row per feed entry: the typed advisory with its ordinal, before alias merging.

    feed: (body, retrieved_at, body_sha256) with {"vulns": [...]} bodies, of any number. The ordinal is a
    text that sorts in source order: when the body was retrieved, its digest, the place in it.
    """
    rows = feed.select(F.posexplode(F.from_json("body", f"vulns ARRAY<{VULN}>")["vulns"]).alias("place", "o"), "retrieved_at", "body_sha256")
    rows = rows.withColumn("ordinal", F.concat_ws(" ", iso_z(F.col("retrieved_at")), "body_sha256", F.lpad(F.col("place").cast("string"), 9, "0")))
    ids = text.sorted_set(F.transform(F.concat(F.array("o.id"), F.coalesce("o.aliases", F.expr(_NONE))), text.blank_to_null))
    mine = F.filter("o.affected", lambda a: a["package"]["name"].isNull() | (F.lower(text.py_strip(a["package"]["name"])) == name.lower()))
    rows = rows.withColumn("ids", ids).withColumn("mine", mine)

    def event(e: Column) -> Column:
        kind = F.when(e["introduced"].isNotNull(), "introduced").when(e["fixed"].isNotNull(), "fixed").when(e["last_affected"].isNotNull(), "last_affected").otherwise("limit")
        return F.struct(kind.alias("kind"), _boundary(F.coalesce(e["introduced"], e["fixed"], e["last_affected"], e["limit"])).alias("b"))

    spans = F.flatten(F.transform("mine", lambda a: F.coalesce(F.transform(a["ranges"], lambda r: F.struct(F.upper(F.coalesce(r["type"], F.lit("ECOSYSTEM"))).alias("raw"), F.transform(r["events"], event).alias("e"))), F.expr("array()"))))
    rows = rows.withColumn("spans", spans)
    only = lambda e, k: F.when(e["kind"] == k, e["b"]["v"])
    valid = lambda r: F.filter(r["e"], lambda e: e["b"]["v"].isNotNull())
    ranges = F.transform(
        F.filter("spans", lambda r: F.size(valid(r)) > 0),
        lambda r: F.struct(
            F.transform(valid(r), lambda e: F.struct(only(e, "fixed").alias("fixed"), only(e, "introduced").alias("introduced"), only(e, "last_affected").alias("last_affected"), only(e, "limit").alias("limit"))).alias("events"),
            by_version(F.array_compact(F.transform(r["e"], lambda e: only(e, "fixed")))).alias("fixed_versions"),
            r["raw"].alias("raw"),
            F.expr(_NONE).alias("resolved"),
        ),
    )
    rows = rows.withColumn("ranges", ranges)
    urls = F.col("urls")
    rows = rows.withColumn("urls", text.sorted_set(F.transform("o.references", lambda r: text.blank_to_null(r["url"]))))
    shas = F.flatten(F.transform("spans", lambda r: F.array_compact(F.transform(r["e"], lambda e: e["b"]["sha"]))))
    cwe = F.transform(F.coalesce("o.database_specific.cwe_ids", "o.database_specific.cwe"), lambda c: F.when(text.py_strip(c).rlike("^[0-9]+$"), F.concat(F.lit("CWE-"), text.py_strip(c))).otherwise(text.blank_to_null(c)))
    scored = F.get(F.filter("o.severity", lambda s: F.upper(s["type"]).contains("CVSS") & (text.py_strip(s["score"]) != "")), F.lit(0))
    version = lambda kind: F.when(kind.contains("V3"), "3.1").when(kind.contains("V2"), "2.0").otherwise("4.0")
    cvss = pep440.let(scored, lambda s: F.when(s.isNotNull(), F.struct(F.lit(None).cast("double").alias("score"), text.py_strip(s["score"]).alias("vector"), version(F.upper(s["type"])).alias("version"))))
    listed = F.flatten(F.transform("mine", lambda a: F.coalesce(a["versions"], F.expr(_NONE))))
    return rows.select(
        "ordinal", "ids", canonical_id(F.col("ids")).alias("canonical"), text.py_strip(F.col("o.id")).alias("own_id"),
        text.blank_to_null(F.col("o.summary")).alias("summary"), text.blank_to_null(F.col("o.details")).alias("details"), text.sorted_set(cwe).alias("cwe"),
        F.upper(text.py_strip(F.col("o.database_specific.severity"))).alias("severity"), cvss.alias("cvss"), "ranges",
        by_version(F.transform(listed, text.py_strip)).alias("affected"), by_version(F.flatten("ranges.fixed_versions")).alias("fixed"),
        iso_z(F.col("o.published")).alias("published"), iso_z(F.col("o.modified")).alias("modified"), urls.alias("references"),
        text.sorted_set(F.concat(F.transform(urls, commit_in_url), shas)).alias("commits"), provenance("osv", F.col("o.id")).alias("source"),
        F.lit(name).alias("package_name"), F.lit(ecosystem).alias("ecosystem"),
    )


def clustered_advisories(records: DataFrame) -> DataFrame:
    """Alias clusters of feed records, merged; see ``advisories.merge_clusters``. They are written.

    The records are numbered as they are written, and their ordinals, long texts, are put in order once; so
    linking, joining and merging shuffle numbers. Whole records are shuffled slice by slice, to meet their
    cluster and to be merged; what led there is deleted.
    """
    spark = records.sparkSession
    with working(spark, "members"):
        numbered = materialise(records.withColumn("number", F.monotonically_increasing_id()), "feed")
        with working(spark, "places"):
            ordered = numbered.select("number", "ordinal").repartitionByRange("ordinal").sortWithinPartitions("ordinal")
            places = materialise(ordered.select("number", F.monotonically_increasing_id().alias("place")), "places")
        with working(spark, "parts"):
            # a record without identifiers is alone, but for copies of its body
            linked = numbered.select("number", F.when(F.size("ids") > 0, F.col("ids")).otherwise(F.array("ordinal")).alias("ids"))
            parts = alias_components(linked, "number", "ids").join(places, F.col("record") == F.col("number")).drop("number")
            parts = materialise(parts, "parts")
        meet = lambda part: part(numbered.drop("ordinal"), "number").join(part(parts, "record"), F.col("number") == F.col("record")).drop("record", "number")
        members = in_slices(spark, numbered.count(), "members", meet)
    with working(spark, "clusters"):
        merged = in_slices(spark, members.count(), "clusters", lambda part: merge_clusters(part(members, "component"), ordinal="place"))
    discard(members)
    return merged


def merged_advisories(clusters: DataFrame) -> DataFrame:
    """Advisory records of merged clusters."""
    sources = F.aggregate("sources", F.expr("slice(sources, 1, 0)"), lambda a, s: F.when(F.exists(a, lambda x: (x["source_type"] == s["source_type"]) & (x["source_id"] == s["source_id"])), a).otherwise(F.array_append(a, s)))
    n = F.col("members")
    reason = F.when(n == 1, F.lit("Authoritative OSV vulnerability metadata")).otherwise(F.concat(F.lit("Merged "), n.cast("string"), F.lit(" alias-linked advisory records")))
    own = F.when(n == 1, F.get(F.filter("ids", lambda i: i.rlike("(?iu)^(?:OSV-|PYSEC-)") | (i == F.col("own_id"))), F.lit(0))).otherwise(first_with(F.col("ids"), "OSV-", "PYSEC-"))
    identifiers = F.struct(F.filter("ids", lambda i: i != F.col("canonical")).alias("aliases"), F.col("canonical").alias("canonical"), first_with(F.col("ids"), "CVE-").alias("cve"), first_with(F.col("ids"), "GHSA-").alias("ghsa"), own.alias("osv"))
    order = F.array_sort(sources, lambda a, b: F.when(F.struct(a["source_type"], a["source_id"]) < F.struct(b["source_type"], b["source_id"]), -1).otherwise(1))
    purl = F.concat(F.lit("pkg:"), F.lower("ecosystem"), F.lit("/"), F.lower("package_name"))
    return clusters.select(
        F.col("ranges").alias("affected_ranges"), by_version(F.col("affected")).alias("affected_versions"),
        F.struct(F.array(reason).alias("rationale"), F.lit(1.0).alias("score")).alias("confidence"), "cvss", "cwe",
        F.col("details").alias("detailed_impact"), by_version(F.col("fixed")).alias("fixed_versions"), identifiers.alias("identifiers"), F.col("modified").alias("modified_at"),
        F.struct("ecosystem", F.col("package_name").alias("name"), purl.alias("purl")).alias("package"),
        F.col("commits").alias("patch_commits"), order.alias("provenance"), F.col("published").alias("published_at"),
        stable_record_id("advisory", canonical_id=F.col("canonical"), package=F.col("package_name"), ecosystem=F.col("ecosystem")).alias("record_id"),
        F.lit("advisory").alias("record_type"), "references", F.lit("1.0").alias("schema_version"), "severity",
        F.lit("tier_1_authoritative").alias("source_priority"), "summary", F.expr(_NONE).alias("workarounds"),
    )


def resolved_advisories(merged: DataFrame, versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(advisories with resolved ranges, issues): every range projected onto the inventory. The advisories are written.

    Issues are (canonical, phase, position, kind, message); phases keep the order in which an advisory's
    issues are reported: its ranges, then missing fixed versions, then overlap, then unresolvable.
    """
    spans = merged.select(F.col("identifiers.canonical").alias("canonical"), F.posexplode("affected_ranges").alias("position", "r"))
    raw = F.col("r.raw")
    spec = (F.size("r.events") == 0) & pep440.is_specifier(F.coalesce(raw, F.lit("")))
    spans = spans.withColumn("spec", F.when(spec, raw)).withColumn("id", F.when(F.size("r.events") > 0, list_id(F.col("r.events"))))
    by_events = spans.where("id IS NOT NULL")
    found = resolve_events(by_events.select("r.events"), versions)
    joined = by_events.join(found, "id", "left").select(
        "canonical", "position", "r", "error", F.coalesce(F.col("resolved.text"), F.expr(_NONE)).alias("resolved")
    )
    # ranges without events: by specifier, or not at all
    bare = spans.where("id IS NULL")
    fits = specifier_hits(bare.where("spec IS NOT NULL"), versions).groupBy("spec").agg(F.transform(F.array_sort(F.collect_set(F.struct("version.key", "version.text"))), lambda x: x["text"]).alias("fits"))
    told = (
        F.when(F.col("spec").isNotNull(), pep440.specifier_error(F.col("spec")))
        .when(F.coalesce(F.col("r.raw"), F.lit("")) != "", F.concat(F.lit("unsupported raw range expression: '"), "r.raw", F.lit("'")))
        .otherwise(F.lit("version range has neither events nor a parseable raw specifier"))
    )
    joined = joined.unionByName(bare.join(fits, "spec", "left").select("canonical", "position", "r", told.alias("error"), F.coalesce("fits", F.expr(_NONE)).alias("resolved")))
    joined = materialise(joined, "projected")
    full = F.struct(F.col("r.events").alias("events"), F.col("r.fixed_versions").alias("fixed_versions"), F.col("r.raw").alias("raw"), F.col("resolved").alias("resolved"))

    def whole(part):
        lists = part(joined, "canonical").groupBy("canonical").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("position", full.alias("r")))), lambda x: x["r"]).alias("new_ranges"), F.count_if(F.col("error").isNull()).alias("good")
        )
        rows = part(merged, "identifiers.canonical").join(lists, F.col("identifiers.canonical") == F.col("canonical"), "left").drop("canonical")
        ranges = F.coalesce("new_ranges", "affected_ranges")
        rows = rows.withColumn("had_versions", F.size("affected_versions") > 0).withColumn("affected_ranges", ranges)
        rows = rows.withColumn("affected_versions", by_version(F.concat("affected_versions", F.flatten("affected_ranges.resolved")), equal_texts=True))
        return rows.withColumn("fixed_versions", by_version(F.concat("fixed_versions", F.flatten("affected_ranges.fixed_versions")), equal_texts=True))

    rows = in_slices(merged.sparkSession, merged.count(), "advisories", whole)
    issue = lambda phase, position, kind, message: (F.lit(phase).alias("phase"), position.alias("position"), F.lit(kind).alias("kind"), message.alias("message"))
    both = F.array_intersect("resolved", "r.fixed_versions")
    invalid = joined.where("error IS NOT NULL").select("canonical", *issue(0, F.col("position"), "invalid_range", F.col("error")))
    clash = joined.where(F.col("error").isNull() & (F.size(both) > 0)).select("canonical", *issue(0, F.col("position"), "contradictory_ranges", F.concat(F.lit("fixed versions also appear in the resolved affected set: "), F.array_join(both, ", "))))
    named = rows.withColumn("canonical", F.col("identifiers.canonical"))
    claims = named.select("canonical", F.posexplode("fixed_versions").alias("position", "fixed"))
    missing = claims.join(versions.select(F.col("version.text").alias("fixed")), "fixed", "left_anti").select("canonical", *issue(1, F.col("position"), "missing_fixed_version", F.concat(F.lit("fixed version not present in inventory: "), "fixed")))
    shared = F.array_intersect("affected_versions", "fixed_versions")
    overlap = named.where(F.size(shared) > 0).select("canonical", *issue(2, F.lit(0), "contradictory_ranges", F.concat(F.lit("advisory fixed versions overlap resolved affected versions: "), F.array_join(shared, ", "))))
    lost = named.where((F.size("affected_ranges") > 0) & (F.coalesce("good", F.lit(0)) == 0) & ~F.col("had_versions"))
    stuck = lost.select("canonical", *issue(3, F.lit(0), "unresolvable", F.concat(F.lit("no resolvable range or explicit affected versions remain after "), F.size("affected_ranges").cast("string"), F.lit(" invalid range(s)"))))
    issues = invalid.unionByName(clash).unionByName(missing).unionByName(overlap).unionByName(stuck)
    return rows.drop("new_ranges", "good", "had_versions"), issues


def _commit_problem(repository: str) -> Column:
    """Why a landed commit body gives no patch, null if it does."""
    names = F.transform(F.coalesce("c.files", F.expr("slice(c.files, 1, 0)")), lambda f: text.blank_to_null(f["filename"]))
    unsafe = F.exists(F.filter(names, lambda n: n.isNotNull() & ~n.isin(".", "..")), lambda n: n.contains("..") | n.contains("\x00") | n.startswith("/"))
    owner = F.regexp_extract("url", r"/repos/([^/]+/[^/]+)/commits/", 1)
    files = F.get_json_object("body", "$.files")
    return (
        F.when(F.col("c").isNull() | ~F.trim("body").startswith("{"), "commit body is no JSON object")
        .when((owner != "") & (owner != repository), F.concat(F.lit("commit repository "), owner, F.lit(f" does not match {repository}")))
        .when(F.col("sha").isNull(), "commit without a valid SHA")
        .when(F.get("c.parents", F.lit(0))["sha"].isNotNull() & _sha(F.get("c.parents", F.lit(0))["sha"]).isNull(), "commit with an invalid parent SHA")
        .when(files.isNotNull() & ~F.trim(files).startswith("["), "commit files are no list")
        .when(unsafe, "commit with an unsafe file name")
    )


def _sha(value: Column) -> Column:
    """A commit SHA in lower case, null if it is none."""
    clean = F.lower(text.py_strip(value))
    return F.when(clean.rlike("^(?:[0-9a-f]{40}|[0-9a-f]{64})$"), clean)


def _owned_commits(commits: DataFrame, advisories: DataFrame, slug: str) -> DataFrame:
    parsed = commits.select(F.from_json("body", COMMIT).alias("c"), "body", "url", "retrieved_at", "body_sha256")
    # the address names the commit where the body does not
    asked = F.regexp_extract("url", r"/commits/([0-9A-Fa-f]+)$", 1)
    parsed = parsed.withColumn("sha", _sha(F.col("c.sha"))).withColumn("problem", _commit_problem(slug)).withColumn("sha", F.coalesce("sha", _sha(asked)))
    owners = advisories.select(F.col("identifiers.canonical").alias("canonical"), "fixed_versions", F.explode("patch_commits").alias("sha"))
    owners = owners.groupBy("sha").agg(F.min_by(F.struct("canonical", "fixed_versions"), "canonical").alias("a"))
    return parsed.join(owners, "sha")


def unresolved_patches(commits: DataFrame, advisories: DataFrame, slug: str) -> DataFrame:
    """(commit_sha, reason, advisory_ids): landed commits that an advisory names and that give no patch."""
    return _owned_commits(commits, advisories, slug).where("problem IS NOT NULL").select(F.col("sha").alias("commit_sha"), F.col("problem").alias("reason"), F.array("a.canonical").alias("advisory_ids"))


def patch_records(commits: DataFrame, advisories: DataFrame, versions: DataFrame, slug: str, name: str, ecosystem: str) -> DataFrame:
    """One row per landed commit that an advisory names; the least advisory that names it gets it.

    commits: (body, url, retrieved_at, body_sha256) with commit bodies. Bodies of another repository,
    malformed ones and unsafe file names are in ``unresolved_patches``.
    """
    tagged = versions.where("commit_sha IS NOT NULL AND git_tag IS NOT NULL").groupBy("commit_sha").agg(F.max_by("normalized_version", "version.key").alias("tagged"))
    rows = _owned_commits(commits, advisories, slug).where("problem IS NULL").join(tagged, F.col("sha") == F.col("commit_sha"), "left").drop("commit_sha")
    files = F.filter("c.files", lambda f: text.blank_to_null(f["filename"]).isNotNull() & ~text.py_strip(f["filename"]).isin(".", ".."))
    paths = F.transform(files, lambda f: F.replace(text.py_strip(f["filename"]), F.lit("\\"), F.lit("/")))
    diffs = F.array_compact(F.transform(files, lambda f: f["patch"]))
    page = F.when(F.col("c.html_url").contains("/commit/"), F.regexp_replace("c.html_url", "/commit/[^/]*$", "")).otherwise(F.lit(f"https://github.com/{slug}"))
    return rows.select(
        text.sorted_set(F.flatten(F.transform(diffs, text.diff_guards))).alias("added_guards"), F.array("a.canonical").alias("advisory_ids"), F.expr(_NONE).alias("behavioral_differences"),
        text.sorted_set(paths).alias("changed_files"), text.sorted_set(F.flatten(F.transform(diffs, text.diff_symbols))).alias("changed_symbols"), F.col("sha").alias("commit_sha"),
        F.struct(F.array(F.lit("official repository commit with extracted diff evidence")).alias("rationale"), F.lit(0.95).alias("score")).alias("confidence"),
        by_version(F.array_compact(F.concat("a.fixed_versions", F.array("tagged")))).alias("fixed_versions"), package(name, ecosystem).alias("package"),
        _sha(F.get("c.parents", F.lit(0))["sha"]).alias("parent_sha"), F.array(provenance("github_commit", F.concat(F.lit(slug + "@"), "c.sha"))).alias("provenance"),
        stable_record_id("patch", commit_sha=F.col("sha"), package=F.lit(name), ecosystem=F.lit(ecosystem)).alias("record_id"), F.lit("patch").alias("record_type"),
        text.sorted_set(F.filter(paths, text.is_regression_test)).alias("regression_tests"), page.alias("repository_url"), F.lit("1.0").alias("schema_version"),
    )


def json_lines(records: DataFrame, *order: Column) -> DataFrame:
    """(line) in the given order: every column, keys sorted, nulls kept, no blanks."""
    # a parsed version is working state; a pattern's version_range is exported as its version
    names = {"version_range": "version"}
    columns = sorted((names.get(c, c), c) for c in records.columns if c != "version")
    line = F.to_json(F.struct(*[F.col(c).alias(n) for n, c in columns]), {"ignoreNullFields": "false"})
    return records.orderBy(*order).select(line.alias("line"))
