"""Working tables do not outlive their use, and wide rows are shuffled slice by slice with the same results."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sentrylake import session
from sentrylake.operators import normalise, patterns
from sentrylake.plans import knowledge, world


@pytest.fixture
def folder(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_dir", lambda spark: f"file://{tmp_path}")
    return lambda: sorted({name.rsplit("-", 1)[0] if len(name) > 33 else name for name in os.listdir(tmp_path)})


def test_working_tables_are_deleted(spark, folder):
    with session.working(spark, "c"):
        session.materialise(spark.range(3), "a")
        with session.working(spark, "b", "c"):
            kept = [session.materialise(spark.range(4), name) for name in "bcd"][1]
        assert folder() == ["a", "b", "c"]
    last = session.materialise(spark.range(5), "e")
    assert folder() == ["c", "e"] and last.count() == 5 and kept.count() == 4
    session.discard(last)
    assert folder() == ["c"]
    with pytest.raises(ValueError, match="lost"), session.working(spark):
        session.materialise(spark.range(3), "f")
        raise ValueError("lost")
    assert folder() == ["c"]


def test_every_row_is_of_one_slice(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "ROWS_AT_ONCE", 30)
    left = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.concat(F.lit("k"), "id")).alias("k"), "id")
    right = left.where("id % 2 = 0").select(F.col("k").alias("other"), F.col("id").alias("twice"))
    asked = []
    made = session.in_slices(spark, 100, "joined", lambda part: asked.append(1) or part(left, "k").join(part(right, "other"), F.col("k") == F.col("other"), "left"))
    assert len(asked) == 4 and sorted(r.id for r in made.collect()) == list(range(100)) and made.where("twice IS NOT NULL").count() == 40


def test_advisories_leave_no_working_tables(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "ROWS_AT_ONCE", 800)
    base = knowledge.Base(world._bodies_of(spark, "/root/testdata/sf0.001"), world.NAME, world.SLUG)
    n = base.advisories.count()
    # neither bodies, feed, edges, rounds, clusters, projections nor artifacts stay
    assert folder() == ["advisories", "conflicts", "inventory", "issues", "repository"]
    assert base.conflicts.count() > 0 and base.issues.count() > 0 and n == base.advisories.select("record_id").distinct().count()
    assert "artifacts" not in base.inventory.columns and "versions" not in base.__dict__


def test_an_inventory_without_artifacts_judges_them(spark, folder):
    body = {"info": {"name": "d"}, "releases": {"1.0": [{"filename": "d", "size": -1, "yanked": False}]}}
    project = spark.createDataFrame([(json.dumps(body), "https://x.org/pypi/d/json", "2021-01-01T00:00:00Z", "b" * 64), ("[]", "https://x.org/tags?", "2021-01-01T00:00:00Z", "c" * 64)], "body string, url string, retrieved_at string, body_sha256 string")
    with pytest.raises(Exception, match="artifact size is negative"):
        knowledge.Base(lambda kind: project, "d", "o/d").inventory  # noqa: B018


def test_entries_without_identifiers_meet_their_copies(spark, folder):
    body = json.dumps({"vulns": [{"summary": "x"}, {"summary": "y"}, {"id": "A"}, {"id": "B", "aliases": ["A"]}]})
    feed = spark.createDataFrame([(body, "2021-01-01T00:00:00Z", "b" * 64)] * 2 + [(body, "2020-01-01T00:00:00Z", "c" * 64)], "body string, retrieved_at string, body_sha256 string")
    made = normalise.clustered_advisories(normalise.advisory_records(feed, "d", "PyPI"))
    assert sorted((r.members, r.summary, r.own_id) for r in made.select("members", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("own_id", F.lit("")).alias("own_id")).collect()) == [(1, "x", ""), (1, "y", ""), (2, "x", ""), (2, "y", ""), (6, "", "A")]


def test_contents_that_share_a_short_hash_are_told_apart(spark, folder, monkeypatch):
    monkeypatch.setattr(patterns.F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    docs = spark.createDataFrame([("r2", "B", "same"), ("r1", "A", "same"), ("r3", "C", "own"), ("r4", "D", ""), ("r5", "E", None)], "record_id string, title string, content string").withColumn("metadata", F.struct(F.array(F.lit("X")).alias("advisory_ids")))
    assert sorted(r.record_id for r in patterns.keep_first_content(docs).collect()) == ["r1", "r3", "r4", "r5"]
    assert folder() == ["copies"]
