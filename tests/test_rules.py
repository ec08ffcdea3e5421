"""Rules are handed to the JVM as one text each, not call by call; repeats cost no more than they must."""

import pytest
from pyspark.sql import functions as F

from sentrylake.functions import pep440, text
from sentrylake.operators import normalise, validation


@pytest.fixture
def trips(spark, monkeypatch):
    """Counts the round trips to the JVM that a call makes."""
    client = spark.sparkContext._gateway._gateway_client
    sent, plain = [], client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *rest, **more: (sent.append(command), plain(command, *rest, **more))[1])

    def count(make):
        before = len(sent)
        make()
        # what the collector of garbage sends is not the call's own
        return len([c for c in sent[before:] if not c.startswith("m\n")])

    return count


@pytest.mark.parametrize("rule", [pep440.parse, pep440.normal_text, pep440.normal_key, normalise.by_version, normalise.iso_z, text.py_strip, text.blank_to_null])
def test_rules_are_one_text(trips, rule):
    column = F.col("t")
    rule(column)
    assert trips(lambda: rule(column)) < 100


def test_contracts_are_one_text(spark, trips):
    rows = spark.createDataFrame([], "record_id string, schema_version string, artifacts array<struct<filename:string,sha256:string,upload_time:string,size:bigint>>")
    validation.schema_findings(rows, "version")
    assert trips(lambda: validation.schema_findings(rows, "version")) < 400


def test_contract_stamps_and_quotes(spark):
    rows = spark.createDataFrame([("x'\\", ["2020-02-29T00:00:00Z", "2021-02-29T00:00:00Z", "2020-01-01T00:00:00", "2020-01-01T00:00:00.5+02:00", None])], "record_id string, stamps array<string>")
    listed = rows.select(F.col("record_id"), F.transform("stamps", lambda s: F.struct(s.alias("upload_time"), F.lit("f").alias("filename"))).alias("artifacts"))
    told = [r.reason for r in validation.schema_findings(listed, "version").collect() if " at " in r.reason]
    assert told == [
        "'2021-02-29T00:00:00Z' is not a 'date-time' at artifacts.1.upload_time",
        "'2020-01-01T00:00:00' is not a 'date-time' at artifacts.2.upload_time",
        "'x'\\' does not match '^[a-z][a-z0-9_]*:[0-9a-f]{64}$' at record_id",
    ]


def test_artifacts_are_judged_by_one_text(spark, trips):
    kind = "array<struct<filename:string,url:string,size:bigint,packagetype:string,python_version:string,requires_python:string,upload_time_iso_8601:string,yanked:boolean,yanked_reason:string>>"
    sound = {"filename": "a", "size": 1, "yanked": False, "upload_time_iso_8601": "2020-01-01T00:00:00Z", "url": None, "packagetype": None, "python_version": None, "requires_python": None, "yanked_reason": None}
    broken = {
        None: [{}, {"filename": "é"}, {"filename": " a"}, {"upload_time_iso_8601": " "}, {"upload_time_iso_8601": None}, {"upload_time_iso_8601": " 2020-01-01T00:00:00+01:00 "}, {"url": " " * 9 + "x" * 4096}, {"size": None}],
        "artifact without a filename": [{"filename": None}, {"filename": ""}, {"filename": " \t"}],
        "artifact text exceeds 4096 characters": [{"yanked_reason": "x" * 4097}, {"url": "é" * 4097}],
        "artifact yanked flag is not a boolean": [{"yanked": None}],
        "artifact size is negative": [{"size": -1}],
        "artifact upload time is no datetime with a zone": [{"upload_time_iso_8601": t} for t in ("2020-01-01T00:00:00", "2020-02-30T00:00:00Z", "x")],
    }
    cases = [(want, sound | change) for want, changes in broken.items() for change in changes]
    given = spark.createDataFrame([(i, "1.0", [sound, case]) for i, (_, case) in enumerate(cases)], f"i int, r string, files {kind}")
    told = {r.i: r.told for r in given.select("i", normalise.release_problem(F.col("r"), F.col("files")).alias("told")).collect()}
    assert told == {i: want and f"release 1.0: {want}" for i, (want, _) in enumerate(cases)}
    assert trips(lambda: normalise.release_problem(F.col("r"), F.col("files"))) < 200
