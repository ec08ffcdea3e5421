"""Changelogs of both formats against a plain reading of them, and what is refused."""

import re

import pytest
from pyspark.sql import functions as F

from sentrylake.operators import changelog

RST = """Changes
=======
- before any version

1.26.18 (2023-10-17)
--------------------

* Fixed a bug in #3143
  continued
- Added CVE-2023-45803 handling, see abcdef1 and 1234567
not an entry
* 
2.0.0rc1
~~~
^^^
* Deprecated thing
- docs: new page

3.0 (2024-01-02)
=====
"""
MARKDOWN = """# Changelog
- lost
## v1.2 (2024-05-06)
- Support for x
#### deeper is text
* security fix
### no number
- lost
##no heading
## 2.0.dev3
"""


def told(rows):
    return {(r.doc, r.version): (r.date, [(e.category, e.text, list(e.references)) for e in r.entries]) for r in rows}


def test_rst(spark):
    docs = spark.createDataFrame([("a", RST), ("b", None), ("c", ""), ("d", "1.0\n---\n---\n* x")], "name string, body string")
    got = told(changelog.parse_changelogs(docs, "name", "body").collect())
    assert got == {
        ("a", "1.26.18"): ("2023-10-17", [("bugfix", "Fixed a bug in #3143", ["#3143"]), ("security", "Added CVE-2023-45803 handling, see abcdef1 and 1234567", ["CVE-2023-45803", "abcdef1"])]),
        ("a", "2.0.0rc1"): (None, [("deprecation", "Deprecated thing", []), ("documentation", "docs: new page", [])]),
        ("a", "3.0"): ("2024-01-02", []),
        ("d", "1.0"): (None, [("other", "x", [])]),
    }


def test_markdown(spark):
    docs = spark.createDataFrame([("a", MARKDOWN)], "name string, body string")
    got = told(changelog.parse_changelogs(docs, "name", "body", "markdown").collect())
    assert got == {("a", "1.2"): ("2024-05-06", [("feature", "Support for x", []), ("security", "security fix", [])]), ("a", "2.0.dev3"): (None, [])}
    with pytest.raises(ValueError):
        changelog.parse_changelogs(docs, "name", "body", "md")


def test_headings_equal_a_plain_walk(spark):
    """Lines and underlines in every order: a line that the next one underlines takes it along."""
    import itertools

    rows = [(k, "\n".join(p)) for k, p in enumerate(itertools.product(["1.0", "---", "~~~~", "- e", ""], repeat=5))]
    want = {}
    for k, text in rows:
        lines, i, found = text.splitlines(), 0, []
        while i < len(lines):
            if i + 1 < len(lines) and re.fullmatch(r"[-=~^]{3,}", lines[i + 1].strip()):
                found.append([lines[i], 0])
                i += 2
                continue
            if found and lines[i] == "- e":
                found[-1][1] += 1
            i += 1
        want[k] = sorted(n for line, n in found if line == "1.0")
    made = changelog.parse_changelogs(spark.createDataFrame(rows, "k int, t string"), "k", "t").select("doc", F.size("entries").alias("n")).collect()
    got = {k: [] for k, _ in rows}
    for r in made:
        got[r.doc].append(r.n)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_bounds(spark, monkeypatch):
    docs = spark.createDataFrame([("a", "1.0\n---\n- a\n- b\n2.0\n---\n- c")], "name string, body string")
    for name, value in (("MOST_ENTRIES", 1), ("MOST_RELEASES", 1), ("MOST_CHARACTERS", 5)):
        with monkeypatch.context() as m:
            m.setattr(changelog, name, value)
            with pytest.raises(Exception, match="exceeds"):
                changelog.parse_changelogs(docs, "name", "body").collect()


def test_last_heading_of_a_version_counts(spark):
    docs = spark.createDataFrame([("a", "1.0\n---\n- old\n1.0.0\n---\n- other\n1.0\n---\n- new")], "name string, body string")
    got = {r.normalized_version: [e.text for e in r.changelog_entries] for r in changelog.by_version(changelog.parse_changelogs(docs, "name", "body")).collect()}
    assert got == {"1.0": ["new"], "1.0.0": ["other"]}
