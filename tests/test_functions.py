"""Versions against the packaging library; components against union-find."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentrylake.functions import pep440
from sentrylake.operators.components import connected_components

packaging = pytest.importorskip("packaging.version")

NUMBER = st.integers(0, 12).map(str)
VERSION = st.tuples(
    st.sampled_from(["", "v", "V", " "]),
    st.sampled_from(["", "1!", "0!"]),
    st.lists(NUMBER, min_size=1, max_size=4).map(".".join),
    st.sampled_from(["", "a1", "-alpha.2", "b", "_beta3", "rc1", "C2", "pre", ".preview4"]),
    st.sampled_from(["", "-3", ".post1", "post", "_rev2", ".r4"]),
    st.sampled_from(["", ".dev1", "dev", "-DEV3"]),
    st.sampled_from(["", "+abc", "+1.2", "+A-01_x"]),
).map("".join)


def known(text):
    try:
        return packaging.Version(text)
    except packaging.InvalidVersion:
        return None


@settings(max_examples=3, deadline=None)
@given(st.lists(st.one_of(VERSION, st.sampled_from(["", "x", "1..2", "1.0+", "a1", "1.0|2"])), min_size=40, max_size=120))
def test_parse_and_order(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("p", pep440.parse(F.col("t")))
    got = {r.i: r for r in frame.select("i", "p.text", "p.is_prerelease", "p.is_postrelease").collect()}
    for i, t in enumerate(texts):
        v = known(t)
        want = (None, None, None) if v is None else (str(v), v.is_prerelease, v.is_postrelease)
        assert (got[i].text, got[i].is_prerelease, got[i].is_postrelease) == want, t
    order = [r.i for r in frame.where("p IS NOT NULL").orderBy("p.key", "i").collect()]
    assert order == sorted((i for i, t in enumerate(texts) if known(t)), key=lambda i: (known(texts[i]), i))


def test_specifiers(spark):
    from packaging.specifiers import SpecifierSet

    versions = ["1.0", "1.0.0", "1.0a1", "1.0.dev3", "1.0rc2.post1", "1.0.post2", "1!0.5", "2.0rc1", "1.0+abc.1", "1.26.18", "0"]
    specs = [">=1.0,<2.0", "~=1.0.0", "==1.0.*", "!=1.0", "<1.0", ">1.0", "<=1.0", "==1.0+abc.1", "~=1.0a1", ">=1.0rc1", "===1.0", ">1.0.post1", ""]
    frame = spark.createDataFrame([(v, s) for v in versions for s in specs], "v string, s string")
    for r in frame.select("v", "s", pep440.specifier_match(pep440.parse(F.col("v")), F.col("s")).alias("m")).collect():
        assert r.m == (packaging.Version(r.v) in SpecifierSet(r.s, prereleases=True)), (r.v, r.s)
    bad = spark.createDataFrame([(s,) for s in ("1.0", ">>1", "~=1", ">=1.*")], "s string")
    assert bad.where(pep440.specifier_error(F.col("s")).isNull()).count() == 0


def test_events(spark):
    event = "struct<introduced:string,fixed:string,last_affected:string,limit:string>"
    frame = spark.createDataFrame(
        [
            ("1.26.4", [("0", None, None, None), (None, "1.26.5", None, None)], True),
            ("1.26.5", [("0", None, None, None), (None, "1.26.5", None, None)], False),
            ("99.0.0", [("1.0", None, None, None)], True),
            ("2.0", [("1.0", None, None, None), (None, None, "2.0", None)], True),
            ("2.0", [("1.0", None, None, None), (None, None, None, "2.0")], False),
            ("2.0.0a1", [("2.0.0", None, None, None)], False),
            ("1.0", [("0", None, None, None), (None, "oops", None, None)], False),
            ("1.0", [], False),
        ],
        f"v string, e array<{event}>, want boolean",
    )
    got = frame.select("want", pep440.event_match(pep440.parse(F.col("v"))["key"], pep440.event_keys(F.col("e"))).alias("got"), pep440.event_error(pep440.event_keys(F.col("e"))).alias("error")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert [r.error for r in got][-2:] == ["invalid fixed boundary: 'oops'", "version range has no events"]


def test_components(spark):
    random.seed(5)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (None, 3)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
        else:
            root(b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {x: root(x) for x in up}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0
