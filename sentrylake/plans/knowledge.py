"""From a landing folder to the knowledge base: all families, findings, metrics, exports and queries."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions import pep440
from sentrylake.operators import advisories, changelog, normalise, patterns, releases, validation
from sentrylake.operators.evidence import ratio
from sentrylake.operators.ranges import range_statistics
from sentrylake.session import at_once, discard, in_slices, materialise, working
from sentrylake.sources.files import write_atomically
from sentrylake.sources.landing import raw_store


@dataclass
class Bundle:
    """The record families, the issues of range projection, and what could not be linked."""

    versions: DataFrame
    advisories: DataFrame
    patches: DataFrame
    patterns: DataFrame
    documents: DataFrame
    issues: DataFrame
    #: Side tables: release keys that are no versions, clusters of several GHSA identifiers, commits that
    #: gave no patch, and versions with tag, release and changelog entries.
    unparsable: DataFrame | None = None
    conflicts: DataFrame | None = None
    unresolved: DataFrame | None = None
    correlations: DataFrame | None = None
    #: One row of counters each: inventory, ranges, correlations, documents.
    counters: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def families(self) -> dict[str, tuple[DataFrame, list[Column]]]:
        """Export path -> (records, total order)."""
        canonical = F.col("identifiers.canonical")
        return {
            "normalized/versions.jsonl": (self.versions, [F.col("version.key")]),
            "normalized/advisories.jsonl": (self.advisories, [canonical]),
            "normalized/patches.jsonl": (self.patches, [F.col("commit_sha"), F.col("record_id")]),
            "normalized/security_patterns.jsonl": (self.patterns.drop("usefulness"), [canonical, F.col("record_id")]),
            "kb/documents.jsonl": (self.documents, [F.col("metadata.advisory_ids")[0], F.col("title"), F.col("record_id")]),
        }


def landed(spark: SparkSession, path: str) -> DataFrame:
    """Sound bodies of a landing folder as text; half-present or corrupt pairs are an error."""
    rows = raw_store(spark, path)
    sound = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("landed pair "), "stem", F.lit(": "), "problem"))).otherwise(F.decode("content", "UTF-8"))
    return rows.select(sound.alias("body"), F.col("request.url").alias("url"), F.col("response.retrieved_at").alias("retrieved_at"), F.col("response.body_sha256").alias("body_sha256"))


def commit_refs(spark: SparkSession, path: str, name: str, ecosystem: str = "PyPI") -> DataFrame:
    """(sha): the commits that landed advisories name, each once."""
    feed = landed(spark, path).where("url LIKE '%/v1/query%'")
    return normalise.advisory_records(feed, name, ecosystem).select(F.explode("commits").alias("sha")).distinct()


def build(spark: SparkSession, path: str, name: str, slug: str, ecosystem: str = "PyPI", drop_tests: bool = False) -> Bundle:
    """All families from a landing folder. Of several project bodies those retrieved last count."""
    return build_from(materialise(landed(spark, path), "landed"), name, slug, ecosystem, drop_tests)


def build_from(raw: DataFrame, name: str, slug: str, ecosystem: str = "PyPI", drop_tests: bool = False) -> Bundle:
    """The same of landed bodies: (body, url, retrieved_at, body_sha256), told apart by their addresses."""
    made = Base(lambda kind: raw, name, slug, ecosystem, drop_tests)
    whole = made.records()
    return replace(whole, unparsable=made.unparsable, conflicts=made.conflicts, unresolved=made.unresolved, correlations=made.correlations, counters=made.counters)


class Base:
    """The tables of a ``Bundle``, each made when it is first read and then kept, with what it needs and no more.

    ``bodies`` gives landed bodies of a kind (project, tags, releases, changelog, feed, commits); what else
    it gives is left out by address. Refused are equal release keys with the versions, and shared record
    ids with the documents.
    """

    def __init__(self, bodies: Callable[[str], DataFrame], name: str, slug: str, ecosystem: str = "PyPI", drop_tests: bool = False):
        self.bodies, self.name, self.slug, self.ecosystem, self.drop_tests = bodies, name, slug, ecosystem, drop_tests

    def records(self) -> Bundle:
        """The record families and issues, without side tables."""
        return Bundle(self.versions, self.advisories, self.patches, self.patterns, self.documents, self.issues)

    @cached_property
    def _project(self) -> DataFrame:
        return project_bodies(self.bodies("project"), self.name)

    @cached_property
    def versions(self) -> DataFrame:
        project, tags = self._project, self._tags
        spark = project.sparkSession
        with working(spark, "versions"):
            with working(spark, "releases"):
                plain = materialise(normalise.untagged_versions(project, self.name, self.ecosystem), "releases")
            picked = materialise(normalise.picked_tags(tags), "picked")
            # some artifacts weigh as much as a row
            size = plain.agg(F.coalesce(F.sum(F.size("artifacts") / 8 + 1), F.lit(0)).cast("bigint")).first()[0]
            made = in_slices(spark, size, "versions", lambda part: normalise.tagged_versions(part(plain, "normalized_version"), part(picked, "tagged")))
        return self._told_apart(made)

    @cached_property
    def inventory(self) -> DataFrame:
        """What ranges and commits are held against: the versions, and where they have not been made, those without artifacts.

        Every release is read and judged as for the records; its artifacts are not written.
        """
        if "versions" in self.__dict__:
            return self.versions
        rows = normalise.version_records(self._project, self._tags, self.name, self.ecosystem)
        with working(rows.sparkSession, "inventory"):
            made = materialise(rows.select("version", "normalized_version", "raw_version", "git_tag", "commit_sha"), "inventory")
        return self._told_apart(made)

    @property
    def _tags(self) -> DataFrame:
        return self.bodies("tags").where("url LIKE '%/tags%'")

    @staticmethod
    def _told_apart(versions: DataFrame) -> DataFrame:
        refuse(normalise.equal_versions(versions), "release keys are equal as versions")
        return versions

    @cached_property
    def unparsable(self) -> DataFrame:
        return materialise(normalise.unparsable_versions(self._project), "unparsable")

    @cached_property
    def _correlated(self) -> tuple[DataFrame, DataFrame]:
        return correlated(self.bodies, self.versions)

    @cached_property
    def correlations(self) -> DataFrame:
        return self._correlated[0]

    @cached_property
    def clusters(self) -> DataFrame:
        feed = self.bodies("feed").where("url LIKE '%/v1/query%'")
        return normalise.clustered_advisories(normalise.advisory_records(feed, self.name, self.ecosystem))

    @cached_property
    def conflicts(self) -> DataFrame:
        return materialise(advisories.conflicts(self.clusters), "conflicts")

    @cached_property
    def _resolved(self) -> tuple[DataFrame, DataFrame]:
        # neither reads the other, and few of their stages fill all cores
        spark = SparkSession.active()
        clusters, inventory = at_once(spark, lambda: self.clusters, lambda: self.inventory)
        with working(spark, "advisories", "issues"):
            resolved, issues = normalise.resolved_advisories(normalise.merged_advisories(clusters), inventory)
            issues = materialise(issues, "issues")
        # whole clusters are read no more; should they be asked for, they are made again
        self.conflicts  # noqa: B018
        discard(self.__dict__.pop("clusters"))
        return resolved, issues

    @cached_property
    def advisories(self) -> DataFrame:
        return self._resolved[0]

    @cached_property
    def issues(self) -> DataFrame:
        return self._resolved[1]

    @cached_property
    def _commits(self) -> DataFrame:
        return self.bodies("commits").where("url LIKE '%/commits/%'")

    @cached_property
    def patches(self) -> DataFrame:
        return materialise(normalise.patch_records(self._commits, self.advisories, self.inventory, self.slug, self.name, self.ecosystem), "patches")

    @cached_property
    def unresolved(self) -> DataFrame:
        return normalise.unresolved_patches(self._commits, self.advisories, self.slug)

    @cached_property
    def patterns(self) -> DataFrame:
        advisories, patches = self.advisories, self.patches
        with working(advisories.sparkSession, "patterns"):
            return in_slices(advisories.sparkSession, advisories.count(), "patterns", lambda part: patterns.security_patterns(part(advisories, "identifiers.canonical"), patches, self.name, self.drop_tests))

    @cached_property
    def _made_documents(self) -> DataFrame:
        p, a, patches, key = self.patterns, self.advisories, self.patches, "identifiers.canonical"
        with working(p.sparkSession, "made-documents"):
            made = in_slices(p.sparkSession, p.count(), "made-documents", lambda part: patterns.made_documents(part(p, key), part(a, key), patches))
        refuse(made.groupBy("record_id").count().where("count > 1"), "documents share a record id")
        return made

    @cached_property
    def documents(self) -> DataFrame:
        return patterns.keep_first_content(self._made_documents)

    def counter(self, of: str) -> DataFrame:
        """One row of counters: inventory, ranges, correlations or documents."""
        if of == "inventory":
            return normalise.inventory_statistics(self.versions, self.unparsable)
        if of == "ranges":
            return range_statistics(self.advisories, self.issues)
        return self._correlated[1] if of == "correlations" else patterns.document_statistics(self._made_documents, self.documents)

    @property
    def counters(self) -> dict[str, DataFrame]:
        return {of: self.counter(of) for of in ("inventory", "ranges", "correlations", "documents")}


def project_bodies(raw: DataFrame, name: str) -> DataFrame:
    """The project bodies that were retrieved last."""
    project = raw.where(F.col("url").endswith(f"/pypi/{name}/json"))
    return project.join(F.broadcast(project.agg(F.max("retrieved_at").alias("retrieved_at"))), "retrieved_at", "left_semi")


def correlated(bodies: Callable[[str], DataFrame], versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions with tag, release and changelog entries; one row of counters). Changelogs ending in .md are Markdown."""
    tag_rows = bodies("tags").where("url LIKE '%/tags%'").select(F.explode(F.from_json("body", normalise.TAGS)).alias("t")).select("t.name", F.col("t.commit.sha").alias("sha"))
    tags = materialise(releases.preferred_tags(tag_rows), "tags")
    told = materialise(releases.release_rows(bodies("releases").where("url RLIKE '/releases(?:[?]|$)'")), "releases")
    files = bodies("changelog").where("url LIKE 'https://raw.githubusercontent.com/%'")
    parsed = [changelog.parse_changelogs(files.where(F.col("url").endswith(".md") == (kind == "markdown")), "url", "body", kind) for kind in changelog.FORMATS]
    entries = materialise(changelog.by_version(parsed[0].unionByName(parsed[1])), "changelog")
    rows = materialise(releases.correlate(versions, tags, told, entries), "correlations")
    return rows, releases.correlation_statistics(rows, tags, told, entries)


def refuse(rows: DataFrame, message: str) -> None:
    """An error with the first of the rows, if there are any."""
    first = rows.head(1)
    if first:
        raise ValueError(f"{message}: {first[0].asDict()}")


def findings(bundle: Bundle, name: str | None = None, ecosystem: str = "PyPI", range_issues: bool = True, release_checks: bool = True) -> DataFrame:
    """(ordinal, rank, check, record_id, reason) in the order of ``ordinal, rank, record_id, reason``.

    Contracts, provenance and links of every record, then the inventory's invariants (where a package
    name is given), duplicates, shared aliases, range issues, and fixed versions that were never released
    (not told where there is no inventory).
    """
    families = {"version": bundle.versions, "advisory": bundle.advisories, "patch": bundle.patches, "security_pattern": bundle.patterns, "kb_document": bundle.documents}
    parts: list[DataFrame] = []

    def add(rows: DataFrame, check: str, key: Column, reason: Column, rank: Column | None = None) -> None:
        place = F.lit("") if rank is None else rank
        parts.append(rows.select(F.lit(len(parts)).alias("ordinal"), place.alias("rank"), F.lit(check).alias("check"), key.alias("record_id"), reason.alias("reason")))

    key, reason = F.col("record_id"), F.col("reason")
    every = None
    for family, records in families.items():
        add(validation.schema_findings(records, family), "schema", key, reason)
        part = records.select("record_id", F.size("provenance").alias("sources"))
        every = part if every is None else every.unionByName(part)
    add(every.where("sources <= 0 OR sources IS NULL"), "provenance", key, F.lit("normalized record must include at least one provenance entry"))
    links = bundle.advisories.select("record_id", F.posexplode("references").alias("i", "url"))
    add(links.where(~F.col("url").rlike("^https?://")), "reference", key, F.concat(F.lit("reference["), "i", F.lit("] is not an http(s) URL: "), "url"))
    add(bundle.patches.where(~F.col("repository_url").rlike("^https?://")), "reference", key, F.concat(F.lit("repository_url is not an http(s) URL: "), "repository_url"))
    if name is not None:
        add(validation.inventory_findings(bundle.versions, name, ecosystem), "version", key, reason)
    canonical = F.col("identifiers.canonical")
    named = bundle.advisories.select("record_id", canonical.alias("canonical"), F.col("identifiers.aliases").alias("aliases"))
    again = named.join(named.groupBy("canonical").count().where("count > 1"), "canonical", "left_semi")
    add(again, "duplicate", key, F.concat(F.lit("duplicate canonical advisory: "), "canonical"))
    owners = named.select(F.explode("aliases").alias("alias"), "canonical", "record_id")
    shared = owners.groupBy("alias").agg(F.count_distinct("canonical").alias("n"), F.min_by("record_id", "canonical").alias("record_id"), F.array_sort(F.collect_set("canonical")).alias("names")).where("n > 1")
    add(shared, "alias", key, F.concat(F.lit("alias "), "alias", F.lit(" is shared by "), F.array_join("names", ", ")))
    add(every.groupBy("record_id").count().where("count > 1"), "duplicate", key, F.lit("duplicate record_id"))
    if range_issues:
        order = F.concat_ws("/", "canonical", F.col("phase").cast("string"), F.lpad(F.col("position").cast("string"), 9, "0"))
        known = named.groupBy("canonical").agg(F.min("record_id").alias("record_id"))
        spans = bundle.issues.join(known, "canonical", "left")
        add(spans, "range", F.coalesce("record_id", F.concat(F.lit("advisory:"), "canonical")), F.concat("kind", F.lit(": "), "message"), order)
    if release_checks:
        stock = bundle.versions.select(F.col("normalized_version").alias("fixed"))
        some = F.broadcast(bundle.versions.limit(1).select(F.lit(1).alias("one")))
        for kind, records in (("advisory", bundle.advisories), ("patch", bundle.patches)):
            claims = records.select("record_id", F.explode("fixed_versions").alias("fixed")).join(stock, "fixed", "left_anti").crossJoin(some)
            add(claims, "patch_release", key, F.concat(F.lit(f"{kind} fixed version not in inventory: "), "fixed"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def require_clean(found: DataFrame) -> None:
    """Strict mode: an error if there is any finding."""
    first = found.orderBy("ordinal", "rank", "record_id", "reason").select("record_id", "check", "reason").head(1)
    if first:
        raise ValueError(f"{first[0].check} finding on {first[0].record_id}: {first[0].reason}")


def statistics(bundle: Bundle, found: DataFrame) -> DataFrame:
    """One row of volume and quality metrics."""
    v, a = bundle.versions, bundle.advisories
    one = v.agg(
        F.count("*").alias("total_versions"), F.count_if("is_prerelease").alias("total_prereleases"), F.count_if("is_yanked").alias("total_yanked_versions"),
        ratio(F.count_if(F.col("git_tag").isNotNull() | F.col("commit_sha").isNotNull()), F.count("*")).alias("version_coverage"),
    )
    ids = a.select(F.explode(F.concat("identifiers.aliases", F.array_compact(F.array("identifiers.cve", "identifiers.ghsa", "identifiers.osv")))).alias("i"))
    issued = bundle.issues.agg(F.count_distinct("canonical").alias("issued"))
    two = a.agg(F.count("*").alias("total_advisories")).crossJoin(ids.agg(F.count_distinct("i").alias("total_aliases"))).crossJoin(issued)
    stock = v.select(F.col("normalized_version").alias("fixed"), F.lit(True).alias("known"))
    claimed = lambda records: records.select("record_id", F.explode_outer("fixed_versions").alias("fixed")).join(stock, "fixed", "left")
    verified = claimed(bundle.patches).groupBy("record_id").agg(F.bool_and(F.col("fixed").isNull() | F.col("known").isNotNull()).alias("ok"))
    three = verified.agg(F.count("*").alias("total_patches"), ratio(F.count_if("ok"), F.count("*")).alias("patch_resolution_rate"))
    claims = claimed(bundle.patches).unionByName(claimed(a)).where("fixed IS NOT NULL")
    four = claims.agg(ratio(F.count("known"), F.count("*")).alias("fixed_release_verification_rate"))
    five = bundle.patterns.agg(F.count("*").alias("total_security_patterns"), F.coalesce(F.round(F.avg("usefulness"), 6), F.lit(0.0)).alias("average_sast_usefulness_score"))
    six = bundle.documents.agg(F.count("*").alias("total_kb_documents"))
    of = lambda *checks: F.col("check").isin(*checks)
    seven = found.agg(
        F.count_distinct(F.when(of("alias", "duplicate"), F.col("record_id"))).alias("bad_aliases"), F.count_if(of("provenance")).alias("bare"),
        F.count_distinct(F.when(of("schema"), F.col("record_id"))).alias("bad_schema"), F.count_if(of("duplicate")).alias("duplicates"),
    )
    row = one.crossJoin(two).crossJoin(three).crossJoin(four).crossJoin(five).crossJoin(six).crossJoin(seven)
    total = F.expr("total_versions + total_advisories + total_patches + total_security_patterns + total_kb_documents")
    rest = lambda part, whole: F.when(whole == 0, 1.0).otherwise(F.round(1 - part / whole, 6))
    n = F.col("total_advisories")
    row = row.select(
        "*", rest(F.col("issued"), n).alias("range_resolution_rate"), rest(F.col("bad_aliases"), n).alias("alias_resolution_rate"), rest(F.col("bare"), total).alias("provenance_coverage"),
        rest(F.col("bad_schema"), total).alias("schema_validation_rate"), ratio(F.col("duplicates"), total, 0.0).alias("duplicate_rate"),
    )
    return row.drop("issued", "bad_aliases", "bare", "bad_schema", "duplicates")


def query(found: DataFrame, package: str, version: str, symbol: str | None = None, compat: bool = False) -> DataFrame:
    """What is known about one version: every pattern of the package (and symbol), affected or not.

    Affected: in the resolved versions if there are any, else by specifier, else by events. By default
    resolved versions are compared as versions and all events count; compat compares texts and
    reads the first event alone.
    """
    rows = found.where(F.col("package.name") == package)
    if symbol is not None:
        rows = rows.where(F.exists("vulnerable_usage.symbols", lambda s: F.contains(s, F.lit(symbol))))
    # the version asked for is parsed once, not for each pattern
    asked = F.struct(pep440.parse(F.lit(version)).alias("v"), pep440.equal_text(F.lit(version)).alias("equal")).alias("__asked")
    rows = rows.crossJoin(F.broadcast(found.sparkSession.range(1).select(asked)))
    v, equal = F.col("__asked.v"), F.col("__asked.equal")
    resolved, raw, events = F.col("version_range.resolved"), F.col("version_range.raw"), F.col("version_range.events")
    member = (F.array_contains(resolved, version) | F.array_contains(resolved, v["text"])) if compat else F.array_contains(F.transform(resolved, pep440.equal_text), equal)
    spec = pep440.is_specifier(F.coalesce(raw, F.lit("")))
    folded = pep440.event_match(v["key"], pep440.event_keys(F.slice(events, 1, 1) if compat else events))
    by_spec = pep440.specifier_match(v, raw, prereleases=None)
    affected = F.when(v.isNull(), False).when(F.size(resolved) > 0, member).when(spec, by_spec | folded).otherwise(folded)
    joined = lambda c, other="none": F.coalesce(F.nullif(F.array_join(c, ", "), F.lit("")), F.lit(other))
    pairs = lambda c: F.transform(c, lambda e: F.concat(e["evidence_type"], F.lit(":"), e["source_id"]))
    sources = F.transform("provenance", lambda p: F.concat(F.lit("provenance:"), p["source_type"], F.lit(":"), p["source_id"]))
    fixed = F.coalesce(F.nullif(F.array_join("remediation.fixed_versions", ", "), F.lit("")), joined("version_range.fixed_versions", "unknown"))
    return rows.select(
        F.lit(package).alias("Package"), F.lit(version).alias("Version"), F.when(F.coalesce(affected, F.lit(False)), "yes").otherwise("no").alias("Affected"), F.col("identifiers.canonical").alias("Canonical advisory"),
        F.col("detection_type").alias("Detection type"), joined("vulnerable_usage.symbols").alias("Relevant symbols"), joined("vulnerable_usage.preconditions").alias("Required preconditions"),
        joined("negative_conditions").alias("Negative conditions"), fixed.alias("Fixed version"), F.coalesce("remediation.upgrade_guidance", F.lit("none")).alias("Recommended remediation"),
        joined(F.concat(pairs("patch_evidence"), pairs("test_evidence"), sources)).alias("Evidence"),
        F.format_string("%.2f (%s)", F.col("confidence.score"), F.array_join("confidence.rationale", "; ")).alias("Confidence"),
    )


def _pretty(value: object) -> bytes:
    return (json.dumps(value, indent=2, sort_keys=True) + "\n").encode()


def export_records(bundle: Bundle, folder: str, *only: str) -> dict[str, str]:
    """Single-file JSON lines of the families (all, or those whose path starts with one of ``only``);
    path -> sha256. For small bases; large ones write ``normalise.json_lines`` with Spark's own writers."""
    made = {}
    for path, (records, order) in bundle.families.items():
        if not only or path.startswith(only):
            if path.endswith("/versions.jsonl"):
                first = validation.schema_findings(records, "version").head(1)
                if first:
                    raise ValueError(f"{first[0].record_id}: {first[0].reason}")
            lines = [r.line for r in normalise.json_lines(records, *order).toLocalIterator()]
            made[path] = ("\n".join(lines) + "\n").encode() if lines else b""
    return _write_all(made, folder)


def export_findings(found: DataFrame, folder: str) -> dict[str, str]:
    """The findings file, rewritten also when there is none."""
    rows = [{"record_id": r.record_id, "check": r.check, "reason": r.reason} for r in found.orderBy("ordinal", "rank", "record_id", "reason").toLocalIterator()]
    return _write_all({"validation_errors.json": _pretty({"error_count": len(rows), "findings": rows})}, folder)


def export_schemas(bundle: Bundle, folder: str) -> dict[str, str]:
    """One JSON Schema a family."""
    families = {"version": bundle.versions, "advisory": bundle.advisories, "patch": bundle.patches, "security_pattern": bundle.patterns, "kb_document": bundle.documents}
    made = {f: validation.json_schema(r, f) for f, r in families.items()} | {"provenance": validation.provenance_schema()}
    return _write_all({f"schemas/{f}.schema.json": _pretty(s) for f, s in made.items()}, folder)


def export_manifest(spark: SparkSession, folder: str) -> dict[str, str]:
    """The sorted (path, sha256) list of what a folder's exports are."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where(F.col("path").rlike(r"(?:\.jsonl|/stats\.json|/validation_errors\.json)$") & ~F.col("path").contains("/raw/"))
    base = os.path.abspath(folder) + "/"
    rows = files.select(F.substring_index("path", base, -1).alias("path"), F.sha2("content", 256).alias("sha256")).orderBy("path").collect()
    return _write_all({"manifest.json": _pretty({"files": [r.asDict() for r in rows]})}, folder)


def export(bundle: Bundle, folder: str, name: str | None = None, ecosystem: str = "PyPI") -> dict[str, str]:
    """Records, findings and metrics; path -> sha256."""
    found = materialise(findings(bundle, name, ecosystem), "findings")
    return export_records(bundle, folder) | export_findings(found, folder) | export_statistics(bundle, found, folder)


def export_statistics(bundle: Bundle, found: DataFrame, folder: str) -> dict[str, str]:
    return _write_all({"stats.json": _pretty(statistics(bundle, found).first().asDict())}, folder)


def _write_all(made: dict[str, bytes], folder: str) -> dict[str, str]:
    for path, payload in made.items():
        write_atomically(payload, os.path.join(folder, path))
    return {path: hashlib.sha256(payload).hexdigest() for path, payload in made.items()}


def _typed_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    texts = spark.read.text(path).where(F.trim("value") != "")
    return texts.select(F.from_json("value", ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")


#: What ``query`` reads of a pattern.
PATTERN = (
    "package STRUCT<name:STRING>, identifiers STRUCT<canonical:STRING>, detection_type STRING, negative_conditions ARRAY<STRING>, "
    "vulnerable_usage STRUCT<preconditions:ARRAY<STRING>,symbols:ARRAY<STRING>>, remediation STRUCT<fixed_versions:ARRAY<STRING>,upgrade_guidance:STRING>, "
    "version STRUCT<events:ARRAY<STRUCT<fixed:STRING,introduced:STRING,last_affected:STRING,limit:STRING>>,fixed_versions:ARRAY<STRING>,raw:STRING,resolved:ARRAY<STRING>>, "
    "patch_evidence ARRAY<STRUCT<evidence_type:STRING,source_id:STRING>>, test_evidence ARRAY<STRUCT<evidence_type:STRING,source_id:STRING>>, "
    "provenance ARRAY<STRUCT<source_id:STRING,source_type:STRING>>, confidence STRUCT<rationale:ARRAY<STRING>,score:DOUBLE>"
)


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """Exported patterns as ``query`` takes them."""
    return _typed_lines(spark, path, PATTERN).withColumnRenamed("version", "version_range")


def read_family(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Exported JSON lines as the records they were, typed as ``like``; a broken line is an error, blank ones are not."""
    names = {"version_range": "version"} if "version_range" in like.columns else {}
    kept = [f for f in like.schema.fields if f.name not in ({"usefulness"} if names else {"version"})]
    ddl = ", ".join(f"`{names.get(f.name, f.name)}` {f.dataType.simpleString()}" for f in kept)
    rows = _typed_lines(spark, path, ddl)
    return rows.withColumnRenamed("version", "version_range") if names else rows


def rendered(rows: DataFrame) -> str:
    """Query rows as blocks of text."""
    blocks = ["\n".join([f"--- Result {n} ---", *(f"{k}: {v}" for k, v in row.asDict().items())]) for n, row in enumerate(rows.toLocalIterator(), 1)]
    return "\n\n".join(blocks) + "\n" if blocks else "No matching security patterns found.\n"
