"""The engine's own results over the world made of the supplied tables, each next to its DuckDB SQL.

Every query here reads a table of ``world.bundle``, the ``knowledge.Base`` that ``knowledge.build_from``
reads too, so what is held against SQL is what the engine exports.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentrylake.operators import patterns
from sentrylake.operators.normalise import advisory_records, json_lines, unparsable_versions
from sentrylake.plans import knowledge, world
from sentrylake.plans.registry import query

_WITH = f"WITH {world.SQL}"


def _joined(name: str | Column, by: str = ",") -> Column:
    return F.array_join(name, by)


def _sql_list(name: str, by: str = ",") -> str:
    return f"coalesce(array_to_string({name}, '{by}'), '')"


@query(f"""{_WITH} SELECT raw, v AS normalized_version, 'version:' || sha256('{{"package":"pkg:pypi/demo","version":"' || v || '"}}') AS record_id, is_prerelease, coalesce(is_yanked, false) AS is_yanked, yanked_reason, release_date, requires_python, git_tag, commit_sha, coalesce(n_artifacts, 0)::BIGINT AS n_artifacts, sha256(coalesce(listed, '')) AS artifacts_sha256, 'pypi/https://pypi.org/pypi/demo/json' AS source FROM inv LEFT JOIN rel USING (p)""")
def landed_versions(spark, d):
    listed = F.transform("artifacts", lambda a: F.concat_ws("|", a["filename"], F.coalesce(a["package_type"], F.lit("")), a["size"].cast("string"), a["sha256"], a["upload_time"]))
    return world.bundle(spark, d).versions.select(
        F.col("raw_version").alias("raw"), "normalized_version", "record_id", "is_prerelease", "is_yanked", "yanked_reason", "release_date", "requires_python", "git_tag", "commit_sha",
        F.size("artifacts").cast("bigint").alias("n_artifacts"), F.sha2(_joined(listed, ";"), 256).alias("artifacts_sha256"),
        F.concat_ws("/", F.col("provenance")[0]["source_type"], F.col("provenance")[0]["source_id"]).alias("source"),
    )


@query("SELECT 'nightly-' || p_partkey AS raw_version FROM part WHERE p_partkey % 11 = 0")
def diverted_versions(spark, d):
    return unparsable_versions(world.projects(spark, d))


@query(f"{_WITH} SELECT count(*) AS total_versions, count(*) FILTER (is_prerelease) AS total_prereleases, count(*) FILTER (is_yanked) AS total_yanked_versions, sum(coalesce(n_artifacts, 0))::BIGINT AS total_artifacts, count(*) FILTER (p % 11 = 0) AS total_unparsable_versions FROM inv LEFT JOIN rel USING (p)")
def inventory_statistics(spark, d):
    return world.bundle(spark, d).counter("inventory")


@query(f"""{_WITH} SELECT v AS normalized_version, git_tag, commit_sha, match_type, git_tag IS NOT NULL AS is_resolved, CASE WHEN p % 4 = 0 THEN 'https://github.com/acme/demo/releases/tag/v' || v END AS release_url, CASE WHEN p % 4 = 0 THEN p_name END AS release_body,
 CASE WHEN p % 3 = 0 THEN 'bugfix|Fixed ' || p_name || '|;security|Added CVE-2024-' || left(lpad(p::VARCHAR, greatest(4, length(p::VARCHAR))::INT, '0'), 4) || ' for #' || p || '|#' || p || ',CVE-2024-' || left(lpad(p::VARCHAR, greatest(4, length(p::VARCHAR))::INT, '0'), 4) END AS entries FROM inv""")
def release_correlations(spark, d):
    entries = F.transform("changelog_entries", lambda e: F.concat_ws("|", e["category"], e["text"], F.array_join(e["references"], ",")))
    return world.bundle(spark, d).correlations.select("normalized_version", "git_tag", "commit_sha", "match_type", "is_resolved", "release_url", "release_body", _joined(entries, ";").alias("entries"))


@query(f"{_WITH} SELECT count(*) AS total_versions, count(git_tag) AS resolved_versions, count(*) FILTER (git_tag IS NULL) AS unresolved_versions, count(git_tag) AS total_tags, 0::BIGINT AS unmatched_tags, count(*) FILTER (p % 4 = 0) AS total_releases, 2 * count(*) FILTER (p % 3 = 0) AS total_changelog_entries FROM inv")
def correlation_statistics(spark, d):
    return world.bundle(spark, d).counter("correlations")


@query(f"""{_WITH} SELECT own AS own_id, array_to_string(ids, ',') AS ids, own_canonical AS canonical, summary, details, severity, CASE WHEN vector IS NOT NULL THEN '3.1 ' || vector END AS cvss, {_sql_list('cwe')} AS cwe, published, modified, array_to_string(refs, ',') AS refs, array_to_string(commits, ',') AS commits,
 fixed, CASE WHEN o % 7 = 0 THEN {world._dnorm('q')} || ',' || {world._dnorm('(q + 21)')} ELSE '' END AS affected, 'ECOSYSTEM ' || {world._dnorm('q')} || ' ' || fixed AS ranges FROM o3""")
def feed_advisories(spark, d):
    told = F.transform("ranges", lambda r: F.concat_ws(" ", r["raw"], F.get(r["events"], F.lit(0))["introduced"], F.get(r["events"], F.lit(1))["fixed"]))
    return advisory_records(world.feed(spark, d), world.NAME, "PyPI").select(
        "own_id", _joined("ids").alias("ids"), "canonical", "summary", "details", "severity", F.concat_ws(" ", "cvss.version", "cvss.vector").alias("c"), _joined("cwe").alias("cwe"), "published", "modified",
        _joined("references").alias("refs"), _joined("commits").alias("commits"), _joined("fixed").alias("fixed"), _joined("affected").alias("affected"), _joined(told, ";").alias("ranges"),
    ).withColumn("cvss", F.nullif("c", F.lit(""))).drop("c")


_OSV = "CASE WHEN n = 1 THEN list_filter(ids, lambda i: regexp_matches(upper(i), '^(OSV-|PYSEC-)') OR i = own)[1] ELSE list_filter(ids, lambda i: regexp_matches(upper(i), '^(OSV-|PYSEC-)'))[1] END"


@query(f"""{_WITH} SELECT canonical, 'advisory:' || sha256('{{"canonical_id":"' || canonical || '","ecosystem":"PyPI","package":"demo"}}') AS record_id, array_to_string(list_filter(ids, lambda i: i <> canonical), ',') AS aliases, list_filter(ids, lambda i: upper(i) LIKE 'CVE-%')[1] AS cve, list_filter(ids, lambda i: upper(i) LIKE 'GHSA-%')[1] AS ghsa, {_OSV} AS osv,
 summary, severity, CASE WHEN vector IS NOT NULL THEN '3.1 ' || vector END AS cvss, details, published, modified, array_to_string(cwe, ',') AS cwe, array_to_string(refs, ',') AS refs, array_to_string(commits, ',') AS commits, n_sources AS sources,
 CASE WHEN n = 1 THEN 'Authoritative OSV vulnerability metadata' ELSE 'Merged ' || n || ' alias-linked advisory records' END AS rationale FROM cl""")
def merged_advisories(spark, d):
    i = "identifiers."
    return world.bundle(spark, d).advisories.select(
        F.col(i + "canonical").alias("canonical"), "record_id", _joined(i + "aliases").alias("aliases"), F.col(i + "cve").alias("cve"), F.col(i + "ghsa").alias("ghsa"), F.col(i + "osv").alias("osv"),
        "summary", "severity", F.nullif(F.concat_ws(" ", "cvss.version", "cvss.vector"), F.lit("")).alias("cvss"), F.col("detailed_impact").alias("details"), F.col("published_at").alias("published"), F.col("modified_at").alias("modified"),
        _joined("cwe").alias("cwe"), _joined("references").alias("refs"), _joined("patch_commits").alias("commits"), F.size("provenance").cast("bigint").alias("sources"), _joined("confidence.rationale").alias("rationale"),
    )


@query(f"{_WITH} SELECT canonical AS canonical_id, array_to_string(ghsas, ',') AS conflicting_ids, 'multiple distinct GHSA canonical IDs merged into single cluster' AS reason FROM cl WHERE len(ghsas) > 1")
def alias_conflicts(spark, d):
    return world.bundle(spark, d).conflicts.select("canonical_id", _joined("conflicting_ids").alias("conflicting_ids"), "reason")


@query(f"""{_WITH} SELECT canonical, array_to_string(affected, ',') AS affected, array_to_string(fixed, ',') AS fixed, n_ranges, string_agg(array_to_string(resolved, ' ') || '<' || rg.fixed, ';' ORDER BY first_o) AS ranges FROM adv JOIN (SELECT c, t, resolved, rg.fixed, first_o FROM rg) rg USING (c, t) GROUP BY ALL""".replace("array_to_string(fixed", "array_to_string(adv.fixed"))
def resolved_advisories(spark, d):
    told = F.transform("affected_ranges", lambda r: F.concat(F.array_join(r["resolved"], " "), F.lit("<"), F.array_join(r["fixed_versions"], " ")))
    return world.bundle(spark, d).advisories.select(F.col("identifiers.canonical").alias("canonical"), _joined("affected_versions").alias("affected"), _joined("fixed_versions").alias("fixed"), F.size("affected_ranges").cast("bigint").alias("n_ranges"), _joined(told, ";").alias("ranges"))


_ISSUES = f"""issues AS (SELECT canonical, 1 AS phase, unnest(generate_series(0, len(fixed) - 1)) AS position, 'missing_fixed_version' AS kind, 'fixed version not present in inventory: ' || unnest(fixed) AS message, unnest(fixed) AS f FROM adv),
shared AS (SELECT canonical, list_filter(affected, lambda v: list_contains(fixed, v)) AS inter FROM adv),
iss AS (SELECT canonical, phase, position::INT AS position, kind, message FROM issues WHERE f NOT IN (SELECT v FROM inv)
 UNION ALL SELECT canonical, 2, 0, 'contradictory_ranges', 'advisory fixed versions overlap resolved affected versions: ' || array_to_string(inter, ', ') FROM shared WHERE len(inter) > 0)"""


@query(f"{_WITH}, {_ISSUES} SELECT * FROM iss")
def range_issues(spark, d):
    return world.bundle(spark, d).issues


@query(f"{_WITH}, {_ISSUES} SELECT (SELECT count(*) FROM adv) AS total_advisories, (SELECT sum(n_ranges)::BIGINT FROM adv) AS total_ranges, 0::BIGINT AS unresolvable_advisories, 0::BIGINT AS invalid_ranges, count(*) FILTER (phase = 1) AS missing_fixed_versions, count(*) FILTER (phase = 2) AS contradictory_ranges, (SELECT count(*) FROM adv) AS resolvable_advisories, (SELECT sum(n_ranges)::BIGINT FROM adv) AS resolved_ranges, 1.0::DOUBLE AS coverage_ratio FROM iss")
def range_statistics(spark, d):
    return world.bundle(spark, d).counter("ranges")


@query(f"""{_WITH} SELECT sha AS commit_sha, 'patch:' || sha256('{{"commit_sha":"' || sha || '","ecosystem":"PyPI","package":"demo"}}') AS record_id, canonical AS advisory_ids, array_to_string(fixed, ',') AS fixed, array_to_string(files, ',') AS files, array_to_string(symbols, ',') AS symbols, array_to_string(guards, ',') AS guards, files[2] AS tests,
 lpad(p::VARCHAR, 40, 'b') AS parent, 'https://github.com/acme/demo' AS repository, 'acme/demo@' || upper(sha) AS source FROM pt""")
def patch_records(spark, d):
    return world.bundle(spark, d).patches.select(
        "commit_sha", "record_id", _joined("advisory_ids").alias("advisory_ids"), _joined("fixed_versions").alias("fixed"), _joined("changed_files").alias("files"), _joined("changed_symbols").alias("symbols"), _joined("added_guards").alias("guards"),
        _joined("regression_tests").alias("tests"), F.col("parent_sha").alias("parent"), F.col("repository_url").alias("repository"), F.col("provenance")[0]["source_id"].alias("source"),
    )


@query(f"{_WITH} SELECT DISTINCT sha AS commit_sha, problem AS reason, canonical AS advisory_ids FROM pt0 WHERE problem IS NOT NULL")
def unresolved_patches(spark, d):
    return world.bundle(spark, d).unresolved.select("commit_sha", "reason", _joined("advisory_ids").alias("advisory_ids"))


_GUARD = {k: label for k, (_, label) in enumerate(patterns.GUARD_PRECONDITIONS)}
_PROSE = {phrase: label for phrase, label in patterns.PROSE}
_NOT = "unsupported inference: "
#: What a pattern is made of, in SQL: d0 and d1 are the two kinds of details, even and odd the two kinds of guards.
_PATTERNS = f"""k AS (SELECT adv.canonical, adv.c, adv.t, adv.ids, adv.own, adv.n, adv.n_sources, adv.summary, adv.details, adv.severity, adv.cwe, adv.f0, adv.q0, adv.x0, pt.sha, pt.p, pt.fixed AS patch_fixed, pt.files, pt.sha IS NOT NULL AS has,
  coalesce(adv.details LIKE 'redirect%', false) AS d0, coalesce(adv.details LIKE 'denial%', false) AS d1, coalesce(pt.p % 2 = 0, false) AS even, coalesce(pt.p % 2 = 1, false) AS odd,
  list_transform(CASE WHEN x0 THEN [q0, q0 + 7, q0 + 14] ELSE [q0, q0 + 7] END, lambda p: {world._dnorm('p')}) AS resolved FROM adv LEFT JOIN lastp USING (canonical) LEFT JOIN pt ON pt.sha = lastp.sha),
k1 AS (SELECT *, CASE WHEN has THEN list_transform(['K' || (p % 4), 'fn_' || (p % 9), 'test_a'], lambda s: 'demo.mod_' || (p % 9) || '.' || s) ELSE []::VARCHAR[] END AS symbols, CASE WHEN has THEN ['demo.mod_' || (p % 9)] ELSE []::VARCHAR[] END AS modules,
  CASE WHEN even THEN ['cert_reqs', 'cert_reqs=ssl.CERT_NONE'] ELSE []::VARCHAR[] END AS arguments, CASE WHEN d0 THEN ['redirect_location_header', 'untrusted_input'] ELSE []::VARCHAR[] END AS sources, CASE WHEN d0 THEN ['redirect handler', 'vulnerable API'] ELSE []::VARCHAR[] END AS sinks,
  CASE WHEN d0 THEN ['redirect_location_header->redirect handler', 'untrusted_input->vulnerable API'] ELSE []::VARCHAR[] END AS flows,
  CASE WHEN even THEN ['cert_reqs defaults to ssl.CERT_REQUIRED'] WHEN odd THEN ['installed version is at or above fixed release ' || patch_fixed[-1]] ELSE []::VARCHAR[] END AS negatives,
  list_sort(list_filter([CASE WHEN has THEN 'vulnerable API invoked: demo.mod_' || (p % 9) || '.K' || (p % 4) END, CASE WHEN d0 THEN '{_PROSE["redirect"]}' END, CASE WHEN d1 THEN '{_PROSE["cert_none"]}' END, CASE WHEN even THEN '{_GUARD[0]}' END, CASE WHEN odd THEN '{_GUARD[1]}' END], lambda s: s IS NOT NULL)) AS preconditions,
  CASE WHEN summary IS NULL AND details IS NULL AND severity IS NOT NULL THEN ['severity: ' || severity] ELSE list_sort(list_filter([summary, details], lambda s: s IS NOT NULL)) END AS notes FROM k),
k2 AS (SELECT *, round((3 + 2 * has::INT + (len(preconditions) > 0)::INT + even::INT + (len(negatives) > 0)::INT) / 8, 4) AS score,
  CASE WHEN has AND even AND d0 THEN 'version_api_configuration_dataflow' WHEN has AND d0 THEN 'version_api_dataflow' WHEN has AND even THEN 'version_api_configuration' WHEN has THEN 'version_api' ELSE 'version_only' END AS kind FROM k1),
pat AS (SELECT *, list_sort(list_filter([CASE WHEN n = 1 THEN 'Authoritative OSV vulnerability metadata' ELSE 'Merged ' || n || ' alias-linked advisory records' END, CASE WHEN has THEN 'patch diff evidence linked' ELSE '{_NOT}patch evidence unavailable; API usage inferred from advisory text only' END, '{_NOT}changelog text not supplied',
  CASE WHEN has THEN 'vulnerable symbols extracted from patch paths' ELSE '{_NOT}no vulnerable symbol extracted from patch evidence' END, 'sast_usefulness_score=' || printf('%.4f', score)], lambda s: s IS NOT NULL)) AS rationale FROM k2)"""


@query(f"""{_WITH}, {_PATTERNS} SELECT canonical, 'security_pattern:' || sha256('{{"canonical":"' || canonical || '","ecosystem":"PyPI","package":"demo"}}') AS record_id, kind AS detection_type, {', '.join(f"array_to_string({c}, ',') AS {c}" for c in ('symbols', 'modules', 'arguments', 'sources', 'sinks', 'flows', 'preconditions', 'negatives', 'notes', 'resolved'))},
 array_to_string(rationale, ';') AS rationale, CASE WHEN d1 THEN 'source-reported availability impact' END AS availability, CASE WHEN summary IS NOT NULL THEN true END AS data_exposure, f0 AS fixed, 'Upgrade to ' || f0 || ' or later.' AS upgrade, CASE WHEN has THEN 'commit:' || sha ELSE '' END AS patch_evidence, coalesce(files[2], '') AS test_evidence, score AS usefulness, severity, n_sources + has::INT AS sources_n FROM pat""")
def security_patterns(spark, d):
    use = "vulnerable_usage."
    return world.bundle(spark, d).patterns.select(
        F.col("identifiers.canonical").alias("canonical"), "record_id", "detection_type", _joined(use + "symbols").alias("symbols"), _joined(use + "modules").alias("modules"), _joined(use + "arguments").alias("arguments"),
        _joined(use + "sources").alias("sources"), _joined(use + "sinks").alias("sinks"), _joined(use + "required_dataflow").alias("flows"), _joined(use + "preconditions").alias("preconditions"), _joined("negative_conditions").alias("negatives"),
        _joined("impact.notes").alias("notes"), _joined("version_range.resolved").alias("resolved"), _joined("confidence.rationale", ";").alias("rationale"), F.col("impact.availability").alias("availability"), F.col("impact.data_exposure").alias("data_exposure"),
        _joined("remediation.fixed_versions").alias("fixed"), F.col("remediation.upgrade_guidance").alias("upgrade"), _joined(F.transform("patch_evidence", lambda e: F.concat(e["evidence_type"], F.lit(":"), e["source_id"]))).alias("patch_evidence"),
        _joined("test_evidence.source_id").alias("test_evidence"), "usefulness", "severity", F.size("provenance").cast("bigint").alias("sources_n"),
    )


def _section(title: str, items: str) -> str:
    return f"CASE WHEN len({items}) > 0 THEN '## {title}' || chr(10) || chr(10) || '- ' || array_to_string({items}, chr(10) || '- ') END"


_SEP = "chr(10) || chr(10)"
_TITLE = {topic: title for topic, title, _ in patterns.TOPICS}


def _page(topic: str, *blocks: str) -> str:
    closing = patterns.CLOSING[topic].replace("'", "''")
    return f"array_to_string(list_filter(['# {_TITLE[topic]}: ' || canonical, {', '.join(blocks)}, '{closing}'], lambda b: b IS NOT NULL), {_SEP})"


_PAGES = {
    "vulnerability_overview": _page("vulnerability_overview", "'## Summary' || chr(10) || coalesce(summary, notes[1])", "'## Impact' || chr(10) || details",
        "CASE WHEN d1 OR summary IS NOT NULL THEN '## Structured impact' || CASE WHEN d1 THEN chr(10) || '- Availability: source-reported availability impact' ELSE '' END || CASE WHEN summary IS NOT NULL THEN chr(10) || '- Data exposure: reported' ELSE '' END END",
        "CASE WHEN len(cwe) > 0 THEN '## CWE' || chr(10) || array_to_string(cwe, ', ') END", "'## Affected range (source)' || chr(10) || 'ECOSYSTEM'", "'## Fixed versions' || chr(10) || f0"),
    "detection_guidance": _page("detection_guidance", "'Detection type: ' || kind", _section("Vulnerable symbols", "symbols"), "CASE WHEN has THEN '## API surface' || chr(10) || '- Modules: ' || modules[1] || chr(10) || '- Classes: (none)' END", _section("Dangerous arguments", "arguments"),
        _section("Required preconditions", "preconditions"), _section("Required data-flow", "flows"), _section("Data sources", "sources"), _section("Data sinks", "sinks")),
    "negative_conditions": _page("negative_conditions", f"coalesce({_section('Safe or not-affected conditions', 'negatives')}, '## Safe or not-affected conditions' || chr(10) || chr(10) || '(none documented in source evidence)')"),
    "remediation_guidance": _page("remediation_guidance", "'## Fixed versions' || chr(10) || f0", "'## Upgrade guidance' || chr(10) || 'Upgrade to ' || f0 || ' or later.'"),
    "patch_evidence": _page("patch_evidence", "'## Commit' || chr(10) || '- SHA: ' || first_sha || chr(10) || '- Repository: https://github.com/acme/demo'", _section("Changed files", "first_files"), _section("Changed symbols", "first_symbols"), _section("Added guards", "first_guards"), _section("Regression tests", "[first_files[2]]"),
        "'## Linked patch evidence' || chr(10) || '- commit: ' || sha || ' (https://github.com/acme/demo)'", "'## Linked test evidence' || chr(10) || '- regression_test: ' || files[2] || ' (' || files[2] || ')'"),
}
_DOCUMENTS = f"""pf AS (SELECT pat.*, f.sha AS first_sha, f.files AS first_files, f.symbols AS first_symbols, f.guards AS first_guards FROM pat LEFT JOIN firstp USING (canonical) LEFT JOIN pt f ON f.sha = firstp.sha),
doc AS ({' UNION ALL '.join(f"SELECT canonical, ids, resolved, '{topic}' AS topic, '{title}: ' || canonical AS title, '{kind}' AS document_type, {_PAGES[topic]} AS content FROM pf{' WHERE has' if topic == 'patch_evidence' else ''}" for topic, title, kind in patterns.TOPICS)})"""


@query(f"""{_WITH}, {_PATTERNS}, {_DOCUMENTS} SELECT title, document_type, sha256(content) AS content_sha256, octet_length(encode(content))::BIGINT AS bytes, array_to_string(ids, ',') AS advisory_ids, array_to_string(resolved, ',') AS affected_versions,
 'kb_document:' || sha256('{{"source_record_id":"security_pattern:' || sha256('{{"canonical":"' || canonical || '","ecosystem":"PyPI","package":"demo"}}') || '","topic":"' || topic || '"}}') AS record_id FROM doc""")
def kb_documents(spark, d):
    return world.bundle(spark, d).documents.select("title", "document_type", F.sha2("content", 256).alias("content_sha256"), F.octet_length("content").cast("bigint").alias("bytes"), _joined("metadata.advisory_ids").alias("advisory_ids"), _joined("metadata.affected_versions").alias("affected_versions"), "record_id")


@query(f"{_WITH}, {_PATTERNS}, {_DOCUMENTS} SELECT count(*) AS documents_attempted, count(DISTINCT content) AS documents_written, count(*) - count(DISTINCT content) AS duplicates_skipped, round((count(*) - count(DISTINCT content)) / count(*), 6) AS duplicate_rate FROM (SELECT content FROM doc UNION ALL SELECT content FROM doc WHERE canonical LIKE '%3')")
def document_statistics(spark, d):
    # some documents once more, under other record ids: copies of content go, the first by title and id stays
    made = world.bundle(spark, d).documents
    again = made.where(F.col("title").endswith("3")).withColumn("record_id", F.concat("record_id", F.lit("x")))
    every = made.unionByName(again)
    return patterns.document_statistics(every, patterns.keep_first_content(every))


_FINDINGS = f"""adv2 AS (SELECT * FROM adv UNION ALL SELECT * FROM adv WHERE canonical LIKE '%7'),
rid AS (SELECT *, 'advisory:' || sha256('{{"canonical_id":"' || canonical || '","ecosystem":"PyPI","package":"demo"}}') AS id FROM adv2),
fnd AS (SELECT 'reference' AS check_name, id AS record_id, 'reference[' || i || '] is not an http(s) URL: ' || r AS reason FROM (SELECT id, unnest(refs) AS r, unnest(generate_series(0, len(refs) - 1)) AS i FROM rid) WHERE r NOT LIKE 'http%'
 UNION ALL SELECT 'duplicate', id, 'duplicate canonical advisory: ' || canonical FROM rid WHERE canonical LIKE '%7'
 UNION ALL SELECT DISTINCT 'duplicate', id, 'duplicate record_id' FROM rid WHERE canonical LIKE '%7'
 UNION ALL SELECT 'alias', arg_min(id, canonical), 'alias SHARED-' || right(canonical, 1) || ' is shared by ' || string_agg(DISTINCT canonical, ', ' ORDER BY canonical) FROM rid WHERE canonical LIKE 'GHSA-%' GROUP BY right(canonical, 1) HAVING count(DISTINCT canonical) > 1
 UNION ALL SELECT 'range', 'advisory:' || sha256('{{"canonical_id":"' || canonical || '","ecosystem":"PyPI","package":"demo"}}'), kind || ': ' || message FROM iss
 UNION ALL SELECT 'patch_release', id, 'advisory fixed version not in inventory: ' || v FROM (SELECT id, unnest(fixed) AS v FROM rid) WHERE v NOT IN (SELECT v FROM inv)
 UNION ALL SELECT 'patch_release', 'patch:' || sha256('{{"commit_sha":"' || sha || '","ecosystem":"PyPI","package":"demo"}}'), 'patch fixed version not in inventory: ' || v FROM (SELECT sha, unnest(fixed) AS v FROM pt) WHERE v NOT IN (SELECT v FROM inv)
 UNION ALL SELECT 'schema', 'version:' || sha256('{{"package":"pkg:pypi/demo","version":"' || v || '"}}'), '''1.0'' was expected at schema_version' FROM inv WHERE p % 50 = 0
 UNION ALL SELECT 'version', 'version:' || sha256('{{"package":"pkg:pypi/demo","version":"' || v || '"}}'), 'incorrect prerelease flag: ' || v FROM inv WHERE p % 40 = 0
 UNION ALL SELECT 'version', 'version:' || sha256('{{"package":"pkg:pypi/demo","version":"' || v || '"}}'), 'duplicate artifact filename: ' || filename FROM (SELECT p, filename FROM files GROUP BY 1, 2 HAVING count(*) > 1) JOIN inv USING (p)
 UNION ALL SELECT 'provenance', 'patch:' || sha256('{{"commit_sha":"' || sha || '","ecosystem":"PyPI","package":"demo"}}'), 'normalized record must include at least one provenance entry' FROM pt WHERE p % 10 = 0
 UNION ALL SELECT 'schema', 'patch:' || sha256('{{"commit_sha":"' || sha || '","ecosystem":"PyPI","package":"demo"}}'), '[] should be non-empty at provenance' FROM pt WHERE p % 10 = 0)"""


@query(f"{_WITH}, {_ISSUES}, {_FINDINGS} SELECT * FROM fnd")
def bundle_findings(spark, d):
    # advisories twice, shared aliases, a wrong schema version, a wrong flag and lost provenance are planted
    made = world.bundle(spark, d)
    number = F.regexp_extract("normalized_version", r"^\d+\.(\d+)", 1).cast("bigint")
    versions = made.versions.withColumn("schema_version", F.when(number % 50 == 0, "0").otherwise(F.col("schema_version"))).withColumn("is_prerelease", F.col("is_prerelease") != (number % 40 == 0))
    canonical = F.col("identifiers.canonical")
    more = F.when(canonical.startswith("GHSA-"), F.array_append("identifiers.aliases", F.concat(F.lit("SHARED-"), F.right(canonical, F.lit(1))))).otherwise(F.col("identifiers.aliases"))
    advisories = made.advisories.unionByName(made.advisories.where(canonical.endswith("7"))).withColumn("identifiers", F.col("identifiers").withField("aliases", more))
    bare = F.regexp_extract("commit_sha", r"^[ac]*(\d+)$", 1).cast("bigint") % 10 == 0
    patches = made.patches.withColumn("provenance", F.when(bare, F.slice("provenance", 1, 0)).otherwise(F.col("provenance")))
    found = knowledge.findings(replace(made.records(), versions=versions, advisories=advisories, patches=patches), world.NAME)
    return found.select(F.col("check").alias("check_name"), "record_id", "reason")


@query(f"""{_WITH}, {_ISSUES}, {_PATTERNS}, {_DOCUMENTS}, cl_ids AS (SELECT DISTINCT unnest(ids) AS i FROM adv), bad AS (SELECT sha, bool_and(v IN (SELECT v FROM inv)) AS ok FROM (SELECT sha, unnest(fixed) AS v FROM pt) GROUP BY 1),
said AS (SELECT unnest(fixed) AS v FROM adv UNION ALL SELECT unnest(fixed) FROM pt)
SELECT (SELECT count(*) FROM inv) AS total_versions, (SELECT count(*) FROM inv WHERE is_prerelease) AS total_prereleases, (SELECT count(*) FROM rel WHERE is_yanked) AS total_yanked_versions, (SELECT round(count(git_tag) / count(*), 6) FROM inv) AS version_coverage, (SELECT count(*) FROM adv) AS total_advisories, (SELECT count(*) FROM cl_ids) AS total_aliases,
 (SELECT count(*) FROM pt) AS total_patches, (SELECT round(count(*) FILTER (ok) / count(*), 6) FROM bad) AS patch_resolution_rate, (SELECT round(count(*) FILTER (v IN (SELECT v FROM inv)) / count(*), 6) FROM said) AS fixed_release_verification_rate, (SELECT count(*) FROM pat) AS total_security_patterns, (SELECT round(avg(score), 6) FROM pat) AS average_sast_usefulness_score,
 (SELECT count(*) FROM doc) AS total_kb_documents, (SELECT round(1 - (SELECT count(DISTINCT canonical) FROM iss) / count(*), 6) FROM adv) AS range_resolution_rate, 1.0::DOUBLE AS alias_resolution_rate, 1.0::DOUBLE AS provenance_coverage, 1.0::DOUBLE AS schema_validation_rate, 0.0::DOUBLE AS duplicate_rate""")
def bundle_statistics(spark, d):
    made = world.bundle(spark, d)
    return knowledge.statistics(made, knowledge.findings(made, world.NAME))


_ASKED = 30
_NONE_SQL = lambda c: f"CASE WHEN len({c}) > 0 THEN array_to_string({c}, ', ') ELSE 'none' END"


@query(f"""{_WITH}, {_PATTERNS}, src AS (SELECT c, t, string_agg('provenance:osv:' || own, ', ' ORDER BY own) AS s FROM o3 GROUP BY 1, 2)
SELECT 'demo' AS package, '{_ASKED % 7}.{_ASKED}' AS version, CASE WHEN list_contains(resolved, {world._dnorm(str(_ASKED))}) THEN 'yes' ELSE 'no' END AS affected, canonical, kind AS detection_type, {_NONE_SQL('symbols')} AS symbols, {_NONE_SQL('preconditions')} AS preconditions, {_NONE_SQL('negatives')} AS negatives, f0 AS fixed, 'Upgrade to ' || f0 || ' or later.' AS remediation,
 CASE WHEN has THEN 'commit:' || sha || ', regression_test:' || files[2] || ', provenance:github_commit:acme/demo@' || upper(sha) || ', ' ELSE '' END || s AS evidence, '1.00 (' || array_to_string(rationale, '; ') || ')' AS confidence FROM pat JOIN src USING (c, t)""")
def knowledge_query(spark, d):
    # asked for without the trailing zero of the release text
    names = ("package", "version", "affected", "canonical", "detection_type", "symbols", "preconditions", "negatives", "fixed", "remediation", "evidence", "confidence")
    return knowledge.query(world.bundle(spark, d).patterns, world.NAME, f"{_ASKED % 7}.{_ASKED}").toDF(*names)


@query(f"{_WITH}, {_PATTERNS} SELECT canonical, CASE WHEN list_contains(resolved, {world._dnorm(str(_ASKED))}) THEN 'yes' ELSE 'no' END AS affected FROM pat WHERE list_contains(list_transform(symbols, lambda s: contains(s, 'mod_3.fn')), true)")
def knowledge_query_symbol(spark, d):
    rows = knowledge.query(world.bundle(spark, d).patterns, world.NAME, f"{_ASKED % 7}.{_ASKED}.0", symbol="mod_3.fn")
    return rows.select(F.col("Canonical advisory").alias("canonical"), F.col("Affected").alias("affected"))


@query(f"""{_WITH} SELECT '{{"added_guards":["' || array_to_string(guards, '","') || '"],"advisory_ids":["' || canonical || '"],"behavioral_differences":[],"changed_files":["' || array_to_string(files, '","') || '"],"changed_symbols":["' || array_to_string(symbols, '","') || '"],"commit_sha":"' || sha || '","confidence":{{"rationale":["official repository commit with extracted diff evidence"],"score":0.95}},"fixed_versions":["' || array_to_string(fixed, '","') || '"],"package":{{"ecosystem":"PyPI","name":"demo","purl":"pkg:pypi/demo"}},"parent_sha":"' || lpad(p::VARCHAR, 40, 'b') || '"' AS line_start,
 '"record_id":"patch:' || sha256('{{"commit_sha":"' || sha || '","ecosystem":"PyPI","package":"demo"}}') || '","record_type":"patch","regression_tests":["' || files[2] || '"],"repository_url":"https://github.com/acme/demo","schema_version":"1.0"}}' AS line_end FROM pt""")
def exported_patches(spark, d):
    # the export's lines without their provenance, which holds digests of the landed bodies
    lines = json_lines(world.bundle(spark, d).patches, F.col("commit_sha"))
    return lines.select(F.substring_index("line", ',"provenance":', 1).alias("line_start"), F.regexp_extract("line", r'("record_id".*)$', 1).alias("line_end"))
