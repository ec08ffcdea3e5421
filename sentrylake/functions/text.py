"""Text rules: Python-like strip and lines, changelog, diff and prose patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentrylake.functions.pep440 import apply

#: Unicode's White_Space.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _sql_bare(t: str) -> str:
    """Whether a text begins and ends with a visible ASCII character; most do and need no stripping."""
    return f"{t} >= '!' AND {t} < '\x7f' AND substring({t}, -1, 1) BETWEEN '!' AND '~'"


def sql_strip(t: str) -> str:
    """``py_strip`` of a name, in SQL."""
    return f"CASE WHEN {_sql_bare(t)} THEN {t} ELSE btrim({t}, '{_BLANKS}') END"


def sql_blank_to_null(t: str) -> str:
    """``blank_to_null`` of a name, in SQL."""
    return f"CASE WHEN {_sql_bare(t)} THEN {t} ELSE nullif(btrim({t}, '{_BLANKS}'), '') END"


def py_strip(text: Column) -> Column:
    """Leading and trailing Unicode white space off."""
    return apply(text, f"t -> {sql_strip('t')}")


def blank_to_null(text: Column) -> Column:
    return apply(text, f"t -> {sql_blank_to_null('t')}")


def lines(text: Column) -> Column:
    """Lines as Python's splitlines cuts them; no empty piece after a final break."""
    cut = F.split(text, "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]", -1)
    return F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)


def sorted_set(values: Column) -> Column:
    """Distinct non-null values in order; null lists are empty."""
    return F.sort_array(F.array_distinct(F.array_compact(F.coalesce(values, F.expr("CAST(array() AS array<string>)")))))


# --- changelog ---------------------------------------------------------------------------------

#: Fixed patterns: security, deprecation, bug fix, documentation and feature entries, in this order.
_SECURITY = r"(?iu)\b(?:CVE|GHSA|vulnerability|vulnerabilities|security)\b"
_DEPRECATION_START, _DEPRECATION = r"(?iu)^\s*[-*]\s+Deprecated\b", r"(?iu)\bdeprecat"
_BUGFIX_START = r"(?iu)^\s*[-*]\s+(?:Bugfix|Bug|Fix|Fixed)\b"
_DOCUMENTATION = r"(?iu)\bdoc(?:umentation|s)?\b"
_FEATURE_START = r"(?iu)^\s*[-*]\s+(?:Added|New|Support|Implement)"
_ENTRY = r"^\s*[-*]\s+(.+)$"
#: Fixed patterns: references in an entry.
_CVE, _GHSA, _ISSUE = r"CVE-\d{4}-\d{4,}", r"GHSA-[a-z0-9]{4}-[a-z0-9]{4}-[a-z0-9]{4}", r"#(\d+)"
_COMMIT = r"(?:^|\s)([0-9a-f]{7,40})(?:\s|$)"
#: Fixed patterns: a heading's underline, a Markdown heading, the version and the date in a heading.
UNDERLINE, MARKDOWN_HEADING = r"^[-=~^]{3,}$", r"^#{2,3}\s+(.+)$"
_VERSION = r"(\d+\.\d+(?:\.\d+)?(?:(?:a|b|rc|\.dev|\.post)\d+)?)"
_DATE = r"\((\d{4}-\d{2}-\d{2})\)"


def entry_text(line: Column) -> Column:
    """The text of a bullet line, null for any other line."""
    return F.when(line.rlike(_ENTRY), blank_to_null(F.regexp_extract(line, _ENTRY, 1)))


def entry_category(line: Column, text: Column) -> Column:
    return (
        F.when(text.rlike(_SECURITY), "security")
        .when(line.rlike(_DEPRECATION_START) | text.rlike(_DEPRECATION), "deprecation")
        .when(line.rlike(_BUGFIX_START), "bugfix")
        .when(text.rlike(_DOCUMENTATION), "documentation")
        .when(line.rlike(_FEATURE_START), "feature")
        .otherwise("other")
    )


def references(text: Column) -> Column:
    """CVE and GHSA ids, #numbers and commit-like words, distinct and in order."""
    issues = F.transform(F.regexp_extract_all(text, F.lit(_ISSUE), 1), lambda n: F.concat(F.lit("#"), n))
    commits = F.filter(F.regexp_extract_all(text, F.lit(_COMMIT), 1), lambda c: ~c.rlike("^[0-9]+$"))
    return sorted_set(F.concat(F.regexp_extract_all(text, F.lit(_CVE), 0), F.regexp_extract_all(text, F.lit(_GHSA), 0), issues, commits))


def heading_version(heading: Column) -> Column:
    """The first version-like number of a heading, null if there is none."""
    return F.nullif(F.regexp_extract(heading, _VERSION, 1), F.lit(""))


def heading_date(heading: Column) -> Column:
    """The first (YYYY-MM-DD) of a heading, null if there is none."""
    return F.nullif(F.regexp_extract(heading, _DATE, 1), F.lit(""))


# --- diffs -------------------------------------------------------------------------------------

#: Fixed patterns of diff lines.
_SYMBOL = r"^[+\- ]?\s*(?:async\s+)?(?:(?:def|class)\s+([A-Za-z_]\w*))"
_GUARD = r"^\+\s*if\s+.+:|^\+\s*raise\s+\w|^\+\s*assert\s+.+"
_TEST_FILE = r"(?:^|/)(?:tests?/)?(?:.*/)?test_[A-Za-z0-9_]+\.py$"


def diff_symbols(patch: Column) -> Column:
    return sorted_set(F.filter(F.transform(lines(patch), lambda x: F.regexp_extract(x, _SYMBOL, 1)), lambda s: s != ""))


def diff_guards(patch: Column) -> Column:
    kept = F.filter(lines(patch), lambda x: x.rlike(_GUARD) & ~py_strip(F.substr(x, F.lit(2))).startswith("+++"))
    return sorted_set(F.filter(F.transform(kept, lambda x: py_strip(F.substr(x, F.lit(2)))), lambda s: s != ""))


def is_regression_test(path: Column) -> Column:
    return path.rlike(_TEST_FILE)


# --- rules over prose --------------------------------------------------------------------------


def rule_labels(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Labels of the (pattern, label) rules that match, distinct and in order."""
    return sorted_set(F.array(*[F.when(text.rlike(pattern), F.lit(label)) for pattern, label in rules]))


def list_section(title: Column, items: Column) -> Column:
    """A title, a blank line and a bullet per item."""
    bullets = F.transform(items, lambda i: F.concat(F.lit("- "), i))
    return F.when(F.size(items) == 0, F.concat(title, F.lit("\n\n(none documented in source evidence)"))).otherwise(F.concat(title, F.lit("\n\n"), F.array_join(bullets, "\n")))
