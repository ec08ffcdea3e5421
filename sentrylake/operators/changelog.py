"""Changelogs to releases and their classified entries.

Lines are numbered rows; headings, the release that a line belongs to and the entries are expressions
and windows over a document's lines. A document with too much in it is an error, not cut short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.functions import pep440, text

#: Characters of a changelog, releases of it and entries of a release, at most.
MOST_CHARACTERS, MOST_RELEASES, MOST_ENTRIES = 10_000_000, 10_000, 5_000
FORMATS = ("rst", "markdown")


def numbered_lines(docs: DataFrame, doc: str, content: str) -> DataFrame:
    """(doc, i, line) of every line; a null text has none."""
    bounded = F.when(F.char_length(content) > MOST_CHARACTERS, F.raise_error(F.lit(f"changelog exceeds {MOST_CHARACTERS} characters"))).otherwise(F.col(content))
    return docs.select(F.col(doc).alias("doc"), F.posexplode(text.lines(bounded)).alias("i", "line"))


def underlined(numbered: DataFrame) -> DataFrame:
    """Lines with ``heading`` (its text, where the next line underlines it) and ``used`` (part of a heading).

    A line that underlines the one before is no heading itself; in a run of underlines every other one is.
    """
    w = Window.partitionBy("doc").orderBy("i")
    rule = text.py_strip(F.col("line")).rlike(text.UNDERLINE)
    marked = numbered.withColumn("rule", rule)
    # the place of a line in its run of underlines, counted from the line before the run
    last_text = F.last(F.when(~F.col("rule"), F.col("i")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("place", F.col("i") - F.coalesce(last_text, F.lit(0)))
    starts = (F.col("place") % 2 == 0) & F.coalesce(F.lead("rule").over(w), F.lit(False))
    marked = marked.withColumn("starts", starts)
    used = F.col("starts") | F.coalesce(F.lag("starts").over(w), F.lit(False))
    return marked.withColumn("heading", F.when(F.col("starts"), text.py_strip(F.col("line")))).withColumn("used", used).drop("rule", "place", "starts")


def hashed(numbered: DataFrame) -> DataFrame:
    """The same of Markdown headings of the second and third level."""
    bare = text.py_strip(F.col("line"))
    found = bare.rlike(text.MARKDOWN_HEADING)
    return numbered.withColumn("heading", F.when(found, text.py_strip(F.regexp_extract(bare, text.MARKDOWN_HEADING, 1)))).withColumn("used", found)


def sections(marked: DataFrame) -> DataFrame:
    """Lines with the number (from 1; 0 before the first) and the text of the heading they belong to."""
    w = Window.partitionBy("doc").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("section", F.count("heading").over(w)).withColumn("title", F.last("heading", ignorenulls=True).over(w))


def parse_changelogs(docs: DataFrame, doc: str, content: str, format: str = "rst") -> DataFrame:
    """One row per release heading: doc, section, version, date, entries.

    entries are structs of category, text and references in order of their lines. Headings without a
    version, and what stands under them, are left out. Null and empty texts have no releases.
    """
    if format not in FORMATS:
        raise ValueError(f"unsupported changelog format: {format!r}")
    lines = numbered_lines(docs, doc, content)
    told = sections(underlined(lines) if format == "rst" else hashed(lines)).where("section > 0")
    entry = F.when(~F.col("used"), text.entry_text(F.col("line")))
    told = told.withColumn("entry", entry)
    one = F.struct("i", F.struct(text.entry_category(F.col("line"), F.col("entry")).alias("category"), F.col("entry").alias("text"), text.references(F.col("entry")).alias("references")).alias("e"))
    made = told.groupBy("doc", "section", "title").agg(F.array_sort(F.collect_list(F.when(F.col("entry").isNotNull(), one))).alias("found"))
    bounded = F.when(F.size("found") > MOST_ENTRIES, F.raise_error(F.lit(f"release exceeds {MOST_ENTRIES} entries"))).otherwise(F.transform("found", lambda x: x["e"]))
    made = made.select("doc", "section", text.heading_version(F.col("title")).alias("version"), text.heading_date(F.col("title")).alias("date"), bounded.alias("entries")).where("version IS NOT NULL")
    number = F.count(F.lit(1)).over(Window.partitionBy("doc"))
    checked = made.withColumn("n", number)
    return checked.withColumn("version", F.when(F.col("n") > MOST_RELEASES, F.raise_error(F.lit(f"changelog exceeds {MOST_RELEASES} releases"))).otherwise(F.col("version"))).drop("n")


def by_version(parsed: DataFrame) -> DataFrame:
    """(normalized_version, changelog_entries): of several headings of one version the last counts; others are dropped."""
    named = parsed.withColumn("normalized_version", pep440.parse(F.col("version"))["text"]).where("normalized_version IS NOT NULL")
    return named.groupBy("normalized_version").agg(F.max_by("entries", F.struct("doc", "section")).alias("changelog_entries"))
