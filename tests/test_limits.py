"""Bounds, diverted rows, conflicts and statistics of the engine on records made for them."""

import json

import pytest
from pyspark.sql import functions as F

from sentrylake import settings
from sentrylake.operators import advisories, normalise, patterns, ranges, ranking, releases, validation
from sentrylake.plans import knowledge
from sentrylake.sources import fetch

FILE = {"filename": "d-1.tar.gz", "url": "https://x.org/d", "size": 1, "digests": {"sha256": "a" * 64}, "upload_time_iso_8601": "2020-01-01T00:00:00Z", "yanked": False}


def project(spark, releases_):
    return spark.createDataFrame([(json.dumps({"info": {"name": "d"}, "releases": releases_}), "https://x.org", "2021-01-01T00:00:00Z", "b" * 64)], "body string, url string, retrieved_at string, body_sha256 string")


def tags(spark):
    return spark.createDataFrame([("[]",)], "body string")


@pytest.mark.parametrize(
    "change, message",
    [
        ({"filename": " "}, "without a filename"), ({"yanked": None}, "yanked flag"), ({"size": -1}, "negative"), ({"upload_time_iso_8601": "2020-01-01T00:00:00"}, "no datetime with a zone"),
        ({"requires_python": "x" * 4097}, "exceeds 4096 characters"), ({"upload_time_iso_8601": "soon"}, "no datetime with a zone"), (None, None),
    ],
)
def test_broken_artifacts(spark, change, message):
    made = normalise.version_records(project(spark, {"1.0": [FILE | (change or {})]}), tags(spark), "d", "PyPI")
    if message is None:
        assert made.count() == 1
    else:
        with pytest.raises(Exception, match=message):
            made.collect()


def test_release_bounds(spark, monkeypatch):
    monkeypatch.setattr(normalise, "MOST_ARTIFACTS", 2)
    with pytest.raises(Exception, match="exceeds 2 artifacts"):
        normalise.version_records(project(spark, {"1.0": [FILE] * 3}), tags(spark), "d", "PyPI").collect()
    monkeypatch.setattr(normalise, "MOST_RELEASES", 2)
    with pytest.raises(Exception, match="exceeds 2 releases"):
        normalise.version_records(project(spark, {"1": [], "2": [], "3": []}), tags(spark), "d", "PyPI").collect()
    with pytest.raises(Exception, match="empty or too long"):
        normalise.version_records(project(spark, {"1." + "0" * 300: []}), tags(spark), "d", "PyPI").collect()


def test_diverted_and_equal_keys(spark):
    body = project(spark, {"1.0": [FILE], "1.0.0": [], "v2": [], "nightly": [], "2 beta ": []})
    made = normalise.version_records(body, tags(spark), "d", "PyPI")
    assert sorted(r.raw_version for r in normalise.unparsable_versions(body).collect()) == ["2 beta ", "nightly"]
    assert [r.texts for r in normalise.equal_versions(made).collect()] == [["1.0", "1.0.0"]]
    with pytest.raises(ValueError, match="equal"):
        knowledge.refuse(normalise.equal_versions(made), "release keys are equal as versions")
    row = normalise.inventory_statistics(made, normalise.unparsable_versions(body)).first()
    assert (row.total_versions, row.total_artifacts, row.total_unparsable_versions) == (3, 1, 2)


def test_specifier_ranges_and_statistics(spark):
    versions = normalise.version_records(project(spark, {v: [] for v in ("1.0", "1.1", "1.2", "2.0")}), tags(spark), "d", "PyPI")
    kind = "array<struct<events:array<struct<fixed:string,introduced:string,last_affected:string,limit:string>>,fixed_versions:array<string>,raw:string,resolved:array<string>>>"
    spans = {
        "spec": [([], ["1.2"], ">=1.1,<2", [])], "bad": [([], [], ">=x", [])], "raw": [([], [], "ECOSYSTEM", [])], "none": [([], [], None, [])],
        "event": [([(None, "1.1", None, None), (None, None, "2.0", None)], ["3.0"], "ECOSYSTEM", []), ([(None, "oops", None, None)], [], "ECOSYSTEM", [])],
    }
    merged = spark.createDataFrame([(k, v, []) for k, v in spans.items()], f"canonical string, affected_ranges {kind}, affected_versions array<string>")
    merged = merged.select(F.struct("canonical").alias("identifiers"), "affected_ranges", "affected_versions", F.expr("CAST(array() AS array<string>)").alias("fixed_versions"))
    resolved, issues = normalise.resolved_advisories(merged, versions)
    got = {r.identifiers.canonical: r.affected_versions for r in resolved.collect()}
    assert got == {"spec": ["1.1", "1.2"], "bad": [], "raw": [], "none": [], "event": ["1.1", "1.2", "2.0"]}
    told = sorted((r.canonical, r.kind, r.message) for r in issues.collect())
    assert [(c, k) for c, k, _ in told] == [("bad", "invalid_range"), ("bad", "unresolvable"), ("event", "invalid_range"), ("event", "missing_fixed_version"), ("none", "invalid_range"), ("none", "unresolvable"), ("raw", "invalid_range"), ("raw", "unresolvable"), ("spec", "contradictory_ranges"), ("spec", "contradictory_ranges")]
    assert {m for c, k, m in told if k == "invalid_range"} == {"invalid PEP 440 specifier: >=x", "invalid introduced boundary: 'oops'", "version range has neither events nor a parseable raw specifier", "unsupported raw range expression: 'ECOSYSTEM'"}
    row = ranges.range_statistics(resolved, issues).first()
    assert (row.total_advisories, row.resolvable_advisories, row.unresolvable_advisories, row.total_ranges, row.resolved_ranges, row.invalid_ranges, row.missing_fixed_versions, row.contradictory_ranges, row.coverage_ratio) == (5, 2, 3, 6, 2, 4, 1, 2, 0.4)
    lost = versions.withColumn("version", F.lit(None).cast(versions.schema["version"].dataType))
    with pytest.raises(Exception, match="cannot be parsed"):
        normalise.resolved_advisories(merged, lost)


def commit(spark, *bodies):
    rows = [(json.dumps(b) if not isinstance(b, str) else b, f"https://api.github.com/repos/{slug}/commits/{sha}", "2021-01-01T00:00:00Z", "b" * 64) for slug, sha, b in bodies]
    return spark.createDataFrame(rows, "body string, url string, retrieved_at string, body_sha256 string")


def test_commits_that_give_no_patch(spark):
    sha = lambda c: c * 40
    bodies = commit(
        spark, ("o/d", sha("a"), {"sha": sha("A"), "html_url": f"https://github.com/o/d/commit/{sha('a')}", "files": [{"filename": "a\\b.py"}, {"filename": "."}]}), ("x/y", sha("b"), {"sha": sha("b")}), ("o/d", sha("c"), "[1]"),
        ("o/d", sha("d"), {"sha": sha("d"), "files": [{"filename": "/etc/x"}]}), ("o/d", sha("e"), {"sha": sha("e"), "files": "none"}), ("o/d", sha("f"), {"sha": sha("f"), "parents": [{"sha": "zz"}]}), ("o/d", "1" * 40, {"sha": "1" * 39}),
        ("o/d", "2" * 40, {"sha": "2" * 40}),
    )
    named = spark.createDataFrame([("G", ["1.0"], [c * 40 for c in "abcdef12"])], "canonical string, fixed_versions array<string>, patch_commits array<string>").select(F.struct("canonical").alias("identifiers"), "fixed_versions", "patch_commits")
    versions = normalise.version_records(project(spark, {"1.0": []}), tags(spark), "d", "PyPI")
    good = {r.commit_sha[0]: r for r in normalise.patch_records(bodies, named, versions, "o/d", "d", "PyPI").collect()}
    assert set(good) == {"a", "2"} and good["a"].changed_files == ["a/b.py"] and good["2"].repository_url == "https://github.com/o/d"
    bad = {r.commit_sha[0]: r.reason for r in normalise.unresolved_patches(bodies, named, "o/d").collect()}
    assert bad == {"b": "commit repository x/y does not match o/d", "c": "commit body is no JSON object", "d": "commit with an unsafe file name", "e": "commit files are no list", "f": "commit with an invalid parent SHA", "1": "commit without a valid SHA"}


def test_documents_of_equal_content(spark):
    rows = [("r2", "B", "same"), ("r1", "A", "same"), ("r3", "C", "own")]
    docs = spark.createDataFrame(rows, "record_id string, title string, content string").withColumn("metadata", F.struct(F.array(F.lit("X")).alias("advisory_ids")))
    kept = patterns.keep_first_content(docs)
    assert sorted(r.record_id for r in kept.collect()) == ["r1", "r3"]
    assert tuple(patterns.document_statistics(docs, kept).select("documents_attempted", "documents_written", "duplicates_skipped", "duplicate_rate").first()) == (3, 2, 1, 0.333333)
    assert patterns.document_statistics(docs.limit(0), kept.limit(0)).first().duplicate_rate == 0.0
    with pytest.raises(ValueError, match="share"):
        knowledge.refuse(docs.unionByName(docs).groupBy("record_id").count().where("count > 1"), "documents share a record id")


def test_order_and_events(spark):
    rows = spark.createDataFrame([(0, "a", "1.0"), (1, "b", "1.10"), (2, "c", "1.9"), (3, "d", "2.0")], "place int, record_id string, normalized_version string")
    assert [(r.record_id, r.reason) for r in validation.order_findings(rows, "place").collect()] == [("b", "version records are not PEP 440 sorted")]
    kind = "struct<fixed:string,introduced:string,last_affected:string,limit:string>"
    one = spark.createDataFrame([([(None, "0", None, None)],), ([("1", "0", None, None), (None, None, None, None)],)], f"events array<{kind}>")
    found = validation._walk("advisory", one.schema["events"].dataType, F.col("events"), F.lit("events"), "events", "events", True)
    assert [r.f for r in one.select(found.alias("f")).collect()] == [[], ["an event has exactly one boundary at events.0", "an event has exactly one boundary at events.1"]]
    schema = validation.provenance_schema()
    assert schema["properties"]["raw_sha256"] == {"type": "string", "pattern": validation.SHA256} and schema["properties"]["source_id"]["minLength"] == 1 and len(schema["required"]) == 5


def test_conflicts(spark):
    kind = "component int, ordinal string, ids array<string>, own_id string, canonical string, summary string, severity string, cvss struct<score:double>, details string, published string, modified string, cwe array<string>, references array<string>, commits array<string>, affected array<string>, fixed array<string>, ranges array<string>, source string, package_name string, ecosystem string"
    row = lambda n, i, d, s: (1, f"{n}", [i], i, i, s, None, None, d, f"2020-0{n}", f"2021-0{n}", [], [], [], [], [], [f"r{n}", "r"], f"s{n}", "d", "PyPI")
    made = advisories.merge_clusters(spark.createDataFrame([row(2, "GHSA-b", "long!", "two"), row(1, "GHSA-a", "short", None), row(3, "CVE-1", None, "three")], kind))
    one = made.first()
    assert (one.members, one.canonical, one.summary, one.details, one.published, one.modified, one.ranges, one.sources) == (3, "GHSA-a", "two", "short", "2020-01", "2021-03", ["r1", "r", "r2", "r3"], ["s1", "s2", "s3"])
    assert [tuple(r) for r in advisories.conflicts(made).collect()] == [("GHSA-a", ["GHSA-a", "GHSA-b"], "multiple distinct GHSA canonical IDs merged into single cluster")]


def test_correlation(spark):
    versions = spark.createDataFrame([("1.0",), ("2.0",), ("3.0",)], "normalized_version string")
    named = releases.preferred_tags(spark.createDataFrame([("v1.0", "a"), ("1.0", "b"), ("2.0", "c"), ("9.0", "d")], "name string, sha string"))
    told = releases.release_rows(spark.createDataFrame([("t", "s", json.dumps([{"tag_name": "v1.0", "html_url": "old", "body": "x"}, {"tag_name": "v1.0", "html_url": "new", "body": "y"}, {"tag_name": None}]))], "retrieved_at string, body_sha256 string, body string"))
    entries = spark.createDataFrame([("3.0", [("other", "e", [])])], "normalized_version string, changelog_entries array<struct<category:string,text:string,references:array<string>>>")
    rows = releases.correlate(versions, named, told, entries)
    got = {r.normalized_version: (r.git_tag, r.release_url, r.is_resolved, len(r.changelog_entries or [])) for r in rows.collect()}
    assert got == {"1.0": ("v1.0", "new", True, 0), "2.0": ("2.0", None, True, 0), "3.0": (None, None, False, 1)}
    counted = releases.correlation_statistics(rows, named, told, entries).first().asDict()
    assert counted == {"total_versions": 3, "resolved_versions": 2, "unresolved_versions": 1, "total_tags": 3, "unmatched_tags": 1, "total_releases": 1, "total_changelog_entries": 1}


def test_running_total_and_hot_joins(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 3).alias("w")).repartition(5)
    got = {r.k: r.total for r in ranking.running_total(rows, F.col("w"), "k").collect()}
    sums, total = {}, 0
    for k in range(1000):
        total += next(i for i in range(1000) if i * 7 % 1000 == k) % 3
        sums[k] = total
    assert got == sums
    many = spark.range(5000).select(F.when(F.col("id") < 3000, F.lit(1)).when(F.col("id") < 4000, F.col("id")).alias("k"), "id")
    table = many.groupBy("k").agg(F.count("*").alias("c")).where("k IS NOT NULL AND (k = 1 OR k % 2 = 0)")
    assert ranking.join_hot(many, table, "k", "c", 5000).count() == 3000 + 500
    assert ranking.join_hot(many, table, "k", "c", 5000, "left").where("c IS NULL").count() == 1500
    assert ranking.join_hot(many, table, "k", "c", 5000, "left", bound=5000).where("c IS NULL").count() == 1500


def test_components_of_a_hub(spark, monkeypatch):
    """A star over half of the nodes, chains on it and loose pairs, with hubs broadcast from the first round on."""
    from sentrylake.operators import components

    monkeypatch.setattr(components, "NARROW_ROWS", 0)
    edges = [(500, k) for k in range(501, 1500)] + [(k, k + 2000) for k in range(600, 700)] + [(9000, 9001), (9001, 9002), (7, 500)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {n: (9000 if n >= 9000 else 7) for e in edges for n in e}


def test_request_headers_are_bounded(tmp_path, caplog):
    calls = []

    def transport(method, url, headers, body, timeout):
        calls.append(headers)
        return (503, {}, []) if len(calls) == 1 else (200, {"Content-Type": "application/json"}, [b"{}"])

    client = fetch.Fetcher(str(tmp_path), transport, settings.Crawl(), sleep=lambda s: None)
    for bad in ({"a" * 257: "x"}, {"a": "x" * 4097}, {f"h{i}": "x" * 4000 for i in range(5)}, {" Cookie ": "x"}):
        with pytest.raises(fetch.FetchError):
            client.fetch("GET", "https://a.org/x", **bad)
    with caplog.at_level("WARNING"):
        client.project("demo")
    assert len(calls) == 2 and "attempt=1" in caplog.text and "status 503" in caplog.text


def test_crawl_settings_alone(tmp_path):
    file = tmp_path / "s.json"
    file.write_text(json.dumps({"package": "not looked at", "crawl": {"max_retries": 2}}))
    assert settings.load_crawl(file).max_retries == 2
    file.write_text(json.dumps({"crawl": {"max_retries": 99}}))
    with pytest.raises(settings.SettingsError):
        settings.load_crawl(file)
    file.write_text("[]")
    with pytest.raises(settings.SettingsError):
        settings.load_crawl(file)
