"""Evidence from patches, detection classes, usefulness and release facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def detection_type(api: Column, config: Column, dataflow: Column) -> Column:
    """The coarsest class that the evidence supports."""
    return (
        F.when(api & config & dataflow, "version_api_configuration_dataflow")
        .when(api & dataflow, "version_api_dataflow")
        .when(api & config, "version_api_configuration")
        .when(api, "version_api")
        .otherwise("version_only")
    )


def usefulness(*parts: Column) -> Column:
    """The share of the eight evidence parts that are there, to four places."""
    return F.round(sum((p.cast("int") for p in parts[1:]), parts[0].cast("int")) / F.lit(len(parts)), 4)


def ratio(part: Column, whole: Column, empty: float = 1.0) -> Column:
    """part / whole to six places; ``empty`` where there is nothing."""
    return F.when(whole == 0, F.lit(empty)).otherwise(F.round(part / whole, 6))
