"""The whole engine over a small landed snapshot made here: families, findings, metrics, exports, queries.

The snapshot has aliases over three records, two GHSA identifiers in one cluster, a commit that two
advisories name, equal versions of different text, ranges by commit, a fixed version that was never
released, a body of another repository, and a Markdown-free changelog. Digests of the exports are pinned.
"""

import json

import pytest

from sentrylake import settings
from sentrylake.plans import knowledge
from sentrylake.sources import fetch

SHA = {c: c * 40 for c in "abcdef"}
FILE = lambda v, n, **more: {"filename": f"demo-{v}-{n}.tar.gz", "url": f"https://files.pythonhosted.org/p/demo-{v}-{n}.tar.gz", "size": n, "digests": {"sha256": "0" * 64}, "packagetype": "sdist", "requires_python": ">=3.8", "upload_time_iso_8601": f"2020-01-0{n}T00:00:00Z", "yanked": False} | more
PROJECT = {"info": {"name": "demo"}, "releases": {"0.9": [FILE("0.9", 1)], "1.0.0": [FILE("1.0.0", 2), FILE("1.0.0", 3, requires_python=">=3.9")], "1.1": [FILE("1.1", 4, yanked=True, yanked_reason="broken")], "1.2rc1": [], "1.2": [FILE("1.2", 5)], "2.0": [FILE("2.0", 6)], "nightly": []}}
COMMIT_URL = "https://github.com/o/demo/commit/"


def vuln(key, aliases, fixed, shas=(), introduced="0", versions=(), **more):
    events = [{"introduced": introduced}] + ([{"fixed": fixed}] if fixed else [])
    spans = [{"type": "ECOSYSTEM", "events": events}, {"type": "GIT", "events": [{"introduced": "0"}, {"fixed": SHA["e"]}]}] if key == "GHSA-git" else [{"type": "ECOSYSTEM", "events": events}]
    refs = [{"type": "FIX", "url": COMMIT_URL + SHA[s]} for s in shas] + [{"type": "WEB", "url": "https://example.org/" + key}]
    return {"id": key, "aliases": list(aliases), "modified": "2021-01-01T00:00:00.5Z", "published": "2020-06-01T00:00:00Z", "references": refs, "affected": [{"package": {"name": "Demo", "ecosystem": "PyPI"}, "ranges": spans, "versions": list(versions)}]} | more


FEED = {"vulns": [
    vuln("PYSEC-1", ["CVE-2020-1"], "1.2", summary="redirect leak", details="An attacker-controlled redirect", database_specific={"cwe_ids": ["79"], "severity": "high"}),
    vuln("CVE-2020-1", ["GHSA-one"], "1.2", details="short"),
    vuln("GHSA-one", ["CVE-2020-1"], "1.2.0", "ab", versions=["1.0", "1.0.0"], severity=[{"type": "CVSS_V3", "score": "CVSS:3.1/AV:N"}]),
    vuln("GHSA-two", ["CVE-2020-1"], "1.3", "b", introduced="1.0"),
    vuln("GHSA-zoo", [], "2.0", "ab", introduced="1.2", summary="denial of service"),
    vuln("GHSA-git", [], None, "c", introduced="2.0", summary="DoS", details="needs CERT_NONE"),
]}
COMMITS = {
    "a": {"sha": SHA["a"], "html_url": COMMIT_URL + SHA["a"], "parents": [{"sha": SHA["f"]}], "files": [{"filename": "src/demo/redirects.py", "patch": "@@\n+class Redirects:\n+    def location(self):\n+        if url is None:\n+            raise ValueError\n"}, {"filename": "tests/test_redirects.py", "patch": "+def test_it():"}]},
    "b": {"sha": SHA["b"], "html_url": COMMIT_URL + SHA["b"], "parents": [], "files": [{"filename": "demo/tls.py", "patch": "+    if cert_reqs == CERT_NONE:\n-def old(x):"}]},
    "c": {"sha": SHA["c"], "files": [{"filename": "../escape.py", "patch": "+x"}]},
    "e": {"sha": SHA["e"], "html_url": COMMIT_URL + SHA["e"], "parents": [{"sha": SHA["d"]}]},
}
RST = "1.2 (2020-01-05)\n================\n\n* Fixed CVE-2020-1\n\n1.0.0\n-----\n- Added things\n"


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("snapshot")
    made = {"project.json": PROJECT, "releases.json": [{"tag_name": "v1.2", "html_url": "https://github.com/o/demo/releases/v1.2", "body": "notes"}], "tags.json": [{"name": "v1.2", "commit": {"sha": SHA["a"]}}, {"name": "1.2", "commit": {"sha": SHA["d"]}}, {"name": "release-2.0", "commit": {"sha": SHA["b"]}}, {"name": "old", "commit": {"sha": SHA["f"]}}], "vulns.json": FEED}
    routes = {"/pypi/demo/json$": "project.json", "/releases": "releases.json", "/tags": "tags.json", "/v1/query$": "vulns.json", "CHANGES": "changes.rst"}
    for c, body in COMMITS.items():
        made[f"{c}.json"], routes[f"/commits/{c}"] = body, f"{c}.json"
    for name, value in made.items():
        (folder / name).write_text(json.dumps(value))
    (folder / "changes.rst").write_text(RST)
    client = fetch.Fetcher(str(folder / "raw"), fetch.from_folder(str(folder), routes), settings.Crawl(), now=lambda: __import__("datetime").datetime(2026, 1, 1, tzinfo=__import__("datetime").timezone.utc))
    client.project("demo"), client.releases("o/demo"), client.tags("o/demo"), client.advisories("demo"), client.file("o/demo", "CHANGES.rst")
    for c in COMMITS:
        client.commit("o/demo", SHA[c])
    return folder / "raw"


@pytest.fixture(scope="module")
def bundle(spark, landing):
    return knowledge.build(spark, str(landing), "demo", "o/demo")


def test_commit_refs(spark, landing):
    assert sorted(r.sha[0] for r in knowledge.commit_refs(spark, str(landing), "demo").collect()) == ["a", "b", "c", "e"]


def test_versions(bundle):
    got = {r.normalized_version: r for r in bundle.versions.collect()}
    assert set(got) == {"0.9", "1.0.0", "1.1", "1.2rc1", "1.2", "2.0"} and [r.raw_version for r in bundle.unparsable.collect()] == ["nightly"]
    assert (got["1.2"].git_tag, got["1.2"].commit_sha, got["2.0"].git_tag, got["1.1"].git_tag) == ("v1.2", SHA["a"], "release-2.0", None)
    assert (got["1.1"].is_yanked, got["1.1"].yanked_reason, got["1.0.0"].requires_python, got["1.0.0"].release_date, got["1.2rc1"].release_date) == (True, "broken", None, "2020-01-02T00:00:00Z", None)
    linked = {r.normalized_version: (r.release_body, [e.text for e in r.changelog_entries or []]) for r in bundle.correlations.collect()}
    assert linked["1.2"] == ("notes", ["Fixed CVE-2020-1"]) and linked["1.0.0"] == (None, ["Added things"])


def test_advisories(bundle):
    got = {r.identifiers.canonical: r for r in bundle.advisories.collect()}
    assert set(got) == {"GHSA-one", "GHSA-zoo", "GHSA-git"}
    one = got["GHSA-one"]
    assert (one.identifiers.aliases, one.identifiers.cve, one.identifiers.osv) == (["CVE-2020-1", "GHSA-two", "PYSEC-1"], "CVE-2020-1", "PYSEC-1")
    assert (one.summary, one.severity, one.cwe, one.cvss.version, one.detailed_impact) == ("redirect leak", "HIGH", ["CWE-79"], "3.1", "An attacker-controlled redirect")
    assert one.affected_versions == ["0.9", "1.0", "1.0.0", "1.1", "1.2rc1", "1.2"] and one.fixed_versions == ["1.2", "1.2.0", "1.3"]
    assert [len(r.resolved) for r in one.affected_ranges] == [4, 4, 4] and got["GHSA-zoo"].affected_versions == ["1.2"]
    # commits of ranges are references, never versions; the range by commit stays open
    assert got["GHSA-git"].patch_commits == [SHA["c"], SHA["e"]] and len(got["GHSA-git"].affected_versions) == 6
    assert [(r.canonical_id, r.conflicting_ids) for r in bundle.conflicts.collect()] == [("GHSA-one", ["GHSA-one", "GHSA-two"])]
    issues = sorted((r.canonical, r.kind, r.message) for r in bundle.issues.collect())
    assert issues == [("GHSA-one", "contradictory_ranges", "advisory fixed versions overlap resolved affected versions: 1.2"), ("GHSA-one", "missing_fixed_version", "fixed version not present in inventory: 1.2.0"), ("GHSA-one", "missing_fixed_version", "fixed version not present in inventory: 1.3")]


def test_patches(bundle):
    got = {r.commit_sha[0]: r for r in bundle.patches.collect()}
    assert set(got) == {"a", "b", "e"} and {k: r.advisory_ids for k, r in got.items()} == {"a": ["GHSA-one"], "b": ["GHSA-one"], "e": ["GHSA-git"]}
    assert (got["a"].changed_symbols, got["a"].regression_tests, got["a"].parent_sha) == (["Redirects", "location", "test_it"], ["tests/test_redirects.py"], SHA["f"])
    assert (got["b"].added_guards, got["b"].changed_symbols, got["b"].parent_sha) == (["if cert_reqs == CERT_NONE:"], ["old"], None)
    assert [(r.commit_sha, r.reason, r.advisory_ids) for r in bundle.unresolved.collect()] == [(SHA["c"], "commit with an unsafe file name", ["GHSA-git"])]


def test_patterns_and_queries(bundle):
    split = {r.detection_type: r["count"] for r in bundle.patterns.groupBy("detection_type").count().collect()}
    assert split == {"version_api_configuration_dataflow": 1, "version_only": 2}
    rows = {r["Canonical advisory"]: r for r in knowledge.query(bundle.patterns, "demo", "1.0").collect()}
    assert {k: r.Affected for k, r in rows.items()} == {"GHSA-one": "yes", "GHSA-zoo": "no", "GHSA-git": "no"}
    assert rows["GHSA-one"]["Relevant symbols"] == "demo.tls.old" and {r.Affected for r in knowledge.query(bundle.patterns, "demo", "not a version").collect()} == {"no"}
    assert knowledge.query(bundle.patterns, "demo", "1.0", symbol="tls").count() == 1 and knowledge.query(bundle.patterns, "other", "1.0").count() == 0
    text = knowledge.rendered(knowledge.query(bundle.patterns, "demo", "1.0"))
    assert text.startswith("--- Result 1 ---\nPackage: demo") and text.count("--- Result") == 3
    assert knowledge.rendered(knowledge.query(bundle.patterns, "nothing", "1")) == "No matching security patterns found.\n"


def test_findings_and_metrics(bundle):
    found = knowledge.findings(bundle, "demo")
    told = sorted((r.check, r.reason) for r in found.collect())
    assert told == sorted([("patch_release", f"{who} fixed version not in inventory: {v}") for who, v in (("advisory", "1.2.0"), ("advisory", "1.3"), ("patch", "1.3"), ("patch", "1.3"))] + [("range", "contradictory_ranges: advisory fixed versions overlap resolved affected versions: 1.2")] + [("range", f"missing_fixed_version: fixed version not present in inventory: {v}") for v in ("1.2.0", "1.3")])
    with pytest.raises(ValueError, match="finding on"):
        knowledge.require_clean(found)
    row = knowledge.statistics(bundle, found).first().asDict()
    assert (row["total_versions"], row["total_advisories"], row["total_aliases"], row["total_patches"], row["range_resolution_rate"], row["version_coverage"]) == (6, 3, 6, 3, 0.666667, 0.333333)
    assert bundle.counters["inventory"].first().total_unparsable_versions == 1 and bundle.counters["documents"].first().duplicate_rate == 0.0


#: The first sixteen digits of the exports' SHA-256.
PINNED = {
    "kb/documents.jsonl": "43940462a2bf216e",
    "normalized/advisories.jsonl": "37daebafd103e7d6",
    "normalized/patches.jsonl": "c7879e281a444d22",
    "normalized/security_patterns.jsonl": "81258f258eb7ae7f",
    "normalized/versions.jsonl": "b88bb7650f31dc44",
}


def test_exports(spark, bundle, tmp_path):
    got = knowledge.export(bundle, str(tmp_path), "demo")
    assert {k: v[:16] for k, v in got.items() if k in PINNED} == PINNED and set(got) == {*PINNED, "validation_errors.json", "stats.json"}
    knowledge.export_manifest(spark, str(tmp_path))
    assert {f["path"]: f["sha256"] for f in json.loads((tmp_path / "manifest.json").read_text())["files"]} == got
    pairs = (("normalized/patches.jsonl", bundle.patches), ("normalized/security_patterns.jsonl", bundle.patterns.drop("usefulness")), ("normalized/versions.jsonl", bundle.versions.drop("version")))
    for path, want in pairs:
        again = knowledge.read_family(spark, str(tmp_path / path), want)
        assert sorted(map(str, again.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    (tmp_path / "bad.jsonl").write_text("{}\n{broken\n")
    with pytest.raises(Exception):
        knowledge.read_family(spark, str(tmp_path / "bad.jsonl"), bundle.patches).collect()
    assert list(knowledge.export_records(bundle, str(tmp_path / "kb"), "kb/")) == ["kb/documents.jsonl"]
    knowledge.export_schemas(bundle, str(tmp_path))
    assert sorted(f.name.split(".")[0] for f in (tmp_path / "schemas").iterdir()) == ["advisory", "kb_document", "patch", "provenance", "security_pattern", "version"]
