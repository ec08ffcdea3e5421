"""Every registered query of the engine against its DuckDB SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from sentrylake.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_whole_texts_are_read(spark, tmp_path):
    """References and entries beyond a text's first line and first 40 characters count."""
    rows = [(1, "x" * 50 + "\nfixes CVE-2023-12345 and #77"), (7, "one\ntwo\nthree deprecated call"), (8, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    refs = {r.doc_id: r.refs for r in QUERIES["reference_extract"](spark, str(tmp_path)).collect()}
    assert refs == {1: "[#77, CVE-2023-12345, CVE-2024-0001]", 7: "[CVE-2024-0007]", 8: "[CVE-2024-0008, GHSA-ab12-cd34-xxx8]"}
    kinds = sorted(tuple(r) for r in QUERIES["changelog_line_classify"](spark, str(tmp_path)).collect())
    assert kinds == [(1, "feature", 1), (1, "security", 1), (7, "bugfix", 1), (7, "deprecation", 1), (7, "feature", 1)]
