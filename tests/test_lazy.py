"""The engine's tables are made when they are read; the cheap paths of texts give what the long ones do."""

import threading

import pytest
from pyspark.sql import functions as F

from sentrylake.functions import pep440, text
from sentrylake.operators import normalise, patterns, ranking
from sentrylake.plans import knowledge, world
from sentrylake.session import materialise

TEXTS = ["1", "1.0", "1.0.0", "01.0", "1.0.10", "10.0", "0.0", "1.0rc1", "1rc1", "1.0.0.post2", "1.post2", "1!1.0", "1!1", "1.0+ubuntu.0", "1+ubuntu.0", "1.0.dev3", "v1.0", "1.0-1", "1.0\n", "1.0.post01", "x", "", "0", "00", "1.0b", "1..0", None]


def test_normal_and_equal_texts(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", pep440.parse(F.col("t")).alias("v"), pep440.normal_text(F.col("t")).alias("n"), pep440.equal_text(F.col("t")).alias("e")).collect()
    for r in rows:
        assert r.n == (r.v.text if r.v else None), r.t
    for a in rows:
        for b in rows:
            if a.v and b.v:
                assert (a.e == b.e) == (a.v.key == b.v.key), (a.t, b.t)


def test_single_texts_in_order(spark):
    lists = [["1.0"], ["v1.0"], ["x"], [None], [], ["1.0", "1.0.0"], ["2", "1.10", "1.9"], ["1.0", "1.0"], None]
    rows = spark.createDataFrame([(x,) for x in lists], "x array<string>")
    made = [r.m for r in rows.select(normalise.by_version(F.col("x")).alias("m")).collect()]
    assert made == [["1.0"], ["1.0"], [], [], [], ["1.0"], ["1.9", "1.10", "2"], ["1.0"], None]


def test_blanks_and_stamps(spark):
    blanks = [chr(c) for c in range(0x3001) if spark_blank(c)]
    rows = spark.createDataFrame([(f"{c}a{c}b{c}",) for c in [*blanks, "\x1c", "​"]], "t string")
    for r in rows.select("t", text.py_strip(F.col("t")).alias("now"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("before")).collect():
        assert r.now == r.before, r
    stamps = {"2020-01-02T03:04:05Z": "2020-01-02T03:04:05Z", "2020-13-02T03:04:05Z": None, "2020-02-30T03:04:05Z": None, "2020-01-02T03:04:05.5Z": "2020-01-02T03:04:05.500000Z", "2020-01-02T03:04:05+02:00": "2020-01-02T01:04:05Z", "2020-01-02T03:04:05": None}
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select("s", normalise.iso_z(F.col("s")).alias("z")).collect()
    assert {r.s: r.z for r in rows} == stamps


def spark_blank(c):
    return chr(c).isspace() and not 0x1C <= c <= 0x1F


def test_no_table_is_made_that_is_not_read(spark):
    given = world._bodies_of(spark, "/root/testdata/sf0.001")
    asked = []

    def bodies(kind):
        asked.append(kind)
        if kind in ("feed", "commits"):
            pytest.fail(f"{kind} is not needed")
        return given(kind)

    base = knowledge.Base(bodies, world.NAME, world.SLUG)
    assert base.versions.count() == 200 and base.counter("inventory").first().total_versions == 200 and base.correlations.count() == 200
    assert set(asked) == {"project", "tags", "releases", "changelog"}
    others = knowledge.Base(lambda kind: given(kind) if kind == "feed" else pytest.fail(f"{kind} is not needed"), world.NAME, world.SLUG)
    assert others.conflicts.count() >= 0 and others.clusters.count() > 0


def test_bodies_are_made_by_all_cores(spark):
    assert world.feed(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_normal_texts_are_ordered_without_parsing(spark):
    ends = ["", "a1", "b2", "rc1", "rc10", ".post2", ".post0", ".dev3", "a1.dev3", "rc1.post2", "rc1.post2.dev1", ".post2.dev3"]
    texts = [r + e for r in ["0", "1", "1.0", "1.0.0", "1.2", "1.10", "10", "1.0.1", "2.999999999999999999"] for e in ends]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pep440.parse(F.col("t"))["key"].alias("k"), pep440.normal_key(F.col("t")).alias("n"), pep440.is_normal(F.col("t")).alias("is"))
    assert rows.where("is").count() == len(texts)
    told = [r.n for r in rows.orderBy("k", "t").collect()]
    assert told == sorted(told) and rows.select("k").distinct().count() == rows.select("n").distinct().count() == rows.select("k", "n").distinct().count()
    lists = spark.createDataFrame([(texts[::-1],), (texts + ["1.0-1", "x", None],)], "x array<string>")
    for equal in (False, True):
        plain, long = (r.m for r in lists.select(normalise.by_version(F.col("x"), equal).alias("m")).collect())
        assert [t for t in long if t != "1.0.post1"] == plain


def test_stripping_and_sets_give_what_they_did(spark):
    texts = ["", " ", "a", " a", "a ", "~", "!", "é", " é b ", "　x", "x ", "\x7f", "x\x1c", "a b", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.py_strip(F.col("t")).alias("s"), text.blank_to_null(F.col("t")).alias("b"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("before")).collect()
    for r in rows:
        assert r.s == r.before and r.b == (r.before or None), r
    stamps = spark.createDataFrame([(f"2023-{m:02}-{d:02}T{h:02}:00:59Z",) for m in (0, 1, 2, 4, 12, 13) for d in (0, 1, 28, 29, 30, 31, 32) for h in (0, 23, 24)], "s string")
    for r in stamps.select("s", normalise.iso_z(F.col("s")).alias("z"), F.try_to_timestamp("s").isNotNull().alias("ok")).collect():
        assert r.z == (r.s if r.ok else None), r
    made = spark.createDataFrame([(["b", None, "a", "b"],), ([],), (None,)], "x array<string>").select(text.sorted_set(F.col("x")).alias("m")).collect()
    assert [r.m for r in made] == [["a", "b"], [], []]


def test_versions_and_merged_advisories_are_made_at_once(spark):
    met = threading.Barrier(2, timeout=20)

    def bodies(kind):
        met.wait()
        raise RuntimeError("both are asked for")

    with pytest.raises(RuntimeError, match="both are asked for"):
        knowledge.Base(bodies, world.NAME, world.SLUG).advisories  # noqa: B018


@pytest.mark.parametrize("bound", [500_000, 1])
def test_documents_stay_where_they_are(spark, monkeypatch, bound):
    written = []
    monkeypatch.setattr(patterns, "materialise", lambda df, name: written.append(name) or materialise(df, name))
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", bound)
    rows = [(f"r{i}", f"t{i % 5}", f"same {i % 3}" if i < 9 else f"own {i}", f"X{i % 2}") for i in range(12)]
    docs = spark.createDataFrame(rows, "record_id string, title string, content string, a string").withColumn("metadata", F.struct(F.array("a").alias("advisory_ids")))
    kept = patterns.keep_first_content(docs)
    first = {min((r for r in rows if r[2] == c), key=lambda r: (r[3], r[1], r[0]))[0] for c in {r[2] for r in rows}}
    assert sorted(r.record_id for r in kept.collect()) == sorted(first) and kept.columns == docs.columns
    # where few copies go, no whole document is written or shuffled
    assert written == ["repeated", "copies"] + ["documents"] * (bound == 1)
