"""Fetching, settings and the command line, from files instead of a network."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sentrylake import __main__ as cli
from sentrylake import settings
from sentrylake.functions import ident
from sentrylake.sources import fetch, landing

SHA = "d" * 40
PROJECT = {"info": {"name": "demo"}, "releases": {v: [{"filename": f"demo-{v}.tar.gz", "url": f"https://files.pythonhosted.org/p/demo-{v}.tar.gz", "size": 1, "digests": {"sha256": "a" * 64}, "upload_time_iso_8601": "2020-01-01T00:00:00Z", "yanked": False}] for v in ("1.0", "1.1", "1.2")}}
VULNS = {"vulns": [{"id": "GHSA-aaaa", "aliases": ["CVE-2020-1"], "summary": "redirect", "details": "leak of a header", "modified": "2020-02-01T00:00:00Z", "published": "2020-01-02T00:00:00Z",
    "references": [{"type": "FIX", "url": f"https://github.com/o/demo/commit/{SHA}"}], "affected": [{"package": {"name": "demo", "ecosystem": "PyPI"}, "ranges": [{"type": "ECOSYSTEM", "events": [{"introduced": "0"}, {"fixed": "1.2"}]}], "versions": ["1.0"]}]}]}
COMMIT = {"sha": SHA, "html_url": f"https://github.com/o/demo/commit/{SHA}", "parents": [{"sha": "e" * 40}], "files": [{"filename": "src/demo/a.py", "patch": "@@\n+def fix():\n+    if x:"}]}
ROUTES = {"/pypi/demo/json$": "project.json", "/releases": "releases.json", "/tags": "tags.json", "/v1/query$": "vulns.json", "/commits/": "commit.json", "CHANGES": "changes.rst"}


@pytest.fixture()
def fixtures(tmp_path):
    folder = tmp_path / "fixtures"
    folder.mkdir()
    made = {"project.json": PROJECT, "releases.json": [], "tags.json": [{"name": "v1.2", "commit": {"sha": SHA}}], "vulns.json": VULNS, "commit.json": COMMIT, "routes.json": ROUTES}
    for name, value in made.items():
        (folder / name).write_text(json.dumps(value))
    (folder / "changes.rst").write_text("1.2 (2020-01-01)\n----------------\n\n* Fixed CVE-2020-1\n")
    return folder


URLS = ["https://a.org/x?b=2&a=1#top", "https://a.org/x?", "https://a.org/x?q=a%20b&q=a+a&r=%7E*", "https://a.org", "https://a.org/x?z&y=", "https://a.org/p?k=%E2%82%AC", "http://a.org/", "https://u@a.org/", "https://a.org/?API-key=1", "ftp://x", "https://a.org/?" + "a" * 9000]


def test_identity_equals_the_expression(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", ident.request_key(F.lit("get"), F.col("u")).alias("key"), ident.request_problem(F.lit("get"), F.col("u")).alias("problem")).collect()
    for row in rows:
        try:
            want = fetch.identity("get", row.u)["key"]
        except fetch.FetchError:
            want = None
        assert (row.key if row.problem is None else None) == want, row.u
    assert sum(r.problem is not None for r in rows) == 5


def answers(*given):
    left = list(given)

    def transport(method, url, headers, body, timeout):
        answer = left.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    return transport


NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


def client(tmp_path, slept, *given, **limits):
    return fetch.Fetcher(str(tmp_path / "raw"), answers(*given), settings.Crawl(**limits), sleep=slept.append, now=lambda: NOW)


def test_retries_then_lands_once(spark, tmp_path):
    slept: list[float] = []
    kind = {"Content-Type": "application/json", "Set-Cookie": "no", "ETag": "x" * 3000}
    one = client(tmp_path, slept, (503, {}, []), OSError("cut"), (429, {"Retry-After": "7"}, []), (200, kind, [b"{", b"}"]))
    content, record = one.project("De.Mo")
    assert content == b"{}" and slept == [1.0, 2.0, 7.0] and record["request"]["url"].endswith("/pypi/de-mo/json")
    assert set(record["response"]["headers"]) == {"content-type", "etag"} and len(record["response"]["headers"]["etag"]) == 2048
    assert one.project("de_mo")[0] == b"{}"  # landed: the transport has no more answers
    stored = landing.raw_store(spark, str(tmp_path / "raw")).collect()
    assert [(r.problem, bytes(r.content)) for r in stored] == [(None, b"{}")]
    body = next(p for p in (tmp_path / "raw").rglob("*.body"))
    body.write_bytes(b"[]")
    with pytest.raises(fetch.FetchError):
        one.project("de-mo")
    assert landing.raw_store(spark, str(tmp_path / "raw")).first().problem == "digest differs"
    body.unlink()
    with pytest.raises(fetch.FetchError):
        one.project("de-mo")


def test_refusals(tmp_path):
    slept: list[float] = []
    for given, limits in [(((429, {"Retry-After": "100"}, []),), {}), (((200, {}, [b"x" * 11]),), {"max_response_bytes": 10}), (((404, {}, []),), {}), (((200, {"Content-Type": "text/html"}, [b"{}"]),), {}), ((OSError("x"),), {"max_retries": 0}), (((503, {}, []),), {"max_retries": 0})]:
        with pytest.raises(fetch.FetchError):
            client(tmp_path / str(len(slept)), slept, *given, **limits).project("demo")
    reset = {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": str(int(NOW.timestamp()) + 9)}
    client(tmp_path / "hub", slept, (403, reset, []), (200, {"Content-Type": "application/json"}, [b"[]"])).tags("o/demo")
    assert slept[-1] == 9.0
    idle = client(tmp_path, slept)
    for bad in (lambda: idle.project("-x"), lambda: idle.commit("o/demo", "xyz"), lambda: idle.file("o/demo", "../x"), lambda: idle.tags("o"), lambda: idle.fetch("GET", "https://a.org", Authorization="x"), lambda: idle.advisory("")):
        with pytest.raises(fetch.FetchError):
            bad()


def test_retry_after(spark):
    given = ["7", " 12 ", "-1", "soon", None, "1.5", "+3", "1e2", "Thu, 01 Jan 2026 00:00:09 GMT", "Wed, 31 Dec 2025 23:59:00 GMT"]
    rows = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, g string")
    got = rows.select("i", landing.retry_after_seconds(F.col("g"), F.lit("2026-01-01 00:00:00").cast("timestamp")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [7.0, 12.0, None, None, None, None, 3.0, None, 9.0, 0.0]


def test_settings(tmp_path, monkeypatch):
    good = {"package": {"name": "demo", "ecosystem": "PyPI", "purl": "pkg:pypi/demo", "repository": "o/demo"}, "crawl": {"max_retries": 0}}
    assert settings.parse(good).crawl.max_retries == 0
    for bad in ([], {}, {"package": {}}, good | {"more": 1}, good | {"crawl": {"max_retries": 11}}, good | {"crawl": {"max_retries": True}}, good | {"crawl": {"timeout_seconds": 0}}, good | {"sources": {"nvd": "maybe"}}, good | {"output": None}):
        with pytest.raises(settings.SettingsError):
            settings.parse(bad)
    file = tmp_path / "s.json"
    file.write_text(json.dumps(good))
    assert settings.load(file) == settings.parse(good)
    (tmp_path / "link.json").symlink_to(file)
    file.with_name("big.json").write_bytes(b" " * (1 << 20) + b"{}")
    for bad in ("link.json", "big.json", "none.json"):
        with pytest.raises(settings.SettingsError):
            settings.load(tmp_path / bad)
    (tmp_path / ".env").write_text("export NVD_API_KEY='a b'\nPATH=/x\n# GITHUB_TOKEN=1\nGITHUB_TOKEN = t\nCRAWLER_OFFLINE=\"\n1x=2\n")
    monkeypatch.setenv("GITHUB_TOKEN", "mine")
    monkeypatch.delenv("NVD_API_KEY", raising=False)
    monkeypatch.setenv("CRAWLER_OFFLINE", "0")
    (tmp_path / "deep").mkdir()
    assert settings.load_env(tmp_path / "deep") == ("NVD_API_KEY",)
    assert os.environ["NVD_API_KEY"] == "a b" and os.environ["GITHUB_TOKEN"] == "mine"
    monkeypatch.delenv("NVD_API_KEY")


def test_command_line(spark, fixtures, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("CRAWLER_OFFLINE", raising=False)
    out, conf = str(tmp_path / "data"), tmp_path / "s.json"
    conf.write_text(json.dumps({"package": {"name": "demo", "ecosystem": "PyPI", "purl": "pkg:pypi/demo", "repository": "o/demo"}, "repository": {"changelog_candidates": ["NONE.md", "CHANGES.rst"]}, "output": {"directory": out}}))
    common = ["--config", str(conf), "--fixture-dir", str(fixtures)]
    assert cli.main(["run", *common]) == 0
    files = {f["path"] for f in json.load(open(f"{out}/manifest.json"))["files"]}
    assert files == {"normalized/versions.jsonl", "normalized/advisories.jsonl", "normalized/patches.jsonl", "normalized/security_patterns.jsonl", "kb/documents.jsonl", "validation_errors.json", "stats.json"}
    assert json.load(open(f"{out}/stats.json"))["total_patches"] == 1
    assert json.load(open(f"{out}/validation_errors.json"))["error_count"] == 0
    capsys.readouterr()
    assert cli.main(["query", "--package", "demo", "--version", "1.1", "--config", str(conf)]) == 0
    assert "Affected: yes" in capsys.readouterr().out
    assert cli.main(["query", "--package", "demo", "--version", "1.2", "--output", out]) == 0
    assert "Affected: no" in capsys.readouterr().out
    assert cli.main(["validate", "--config", str(conf), "--offline", "--strict"]) == 0
    assert cli.main(["crawl", "--config", str(conf), "--offline"]) == 1
    assert cli.main(["stats", "--config", str(tmp_path / "none.json")]) == 1
    with pytest.raises(SystemExit) as wrong:
        cli.main(["polish"])
    assert wrong.value.code == 2
