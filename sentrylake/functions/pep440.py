"""PEP 440 versions as native expressions: parse, normal text, order, events and specifiers.

A version is one struct: its normal text, flags, and ``key``, a struct that Spark orders as PEP 440
orders versions. Absent parts have sentinels instead of nulls, so no comparison meets a null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX = 9223372036854775807

#: The grammar of PEP 440's appendix, as one pattern over lower-case text.
_GRAMMAR = (
    r"^\s*v?(?:([0-9]+)!)?([0-9]+(?:\.[0-9]+)*)"
    r"(?:[-_.]?(alpha|a|beta|b|preview|pre|c|rc)[-_.]?([0-9]+)?)?"
    r"(?:-([0-9]+)|[-_.]?(post|rev|r)[-_.]?([0-9]+)?)?"
    r"(?:[-_.]?(dev)[-_.]?([0-9]+)?)?"
    r"(?:\+([a-z0-9]+(?:[-_.][a-z0-9]+)*))?\s*$"
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def apply(value: Column, rule: str) -> Column:
    """A rule, ``name -> expression`` in SQL, of a value that is computed once.

    A rule is one text for the JVM, however long; the same of Column calls takes a round trip for each.
    """
    return F.element_at(F.call_function("transform", F.array(value), F.expr(rule)), 1)


def sql_let(value: str, rule: str) -> str:
    """``let`` in SQL."""
    return f"element_at(transform(array({value}), {rule}), 1)"


def _number(part: str) -> str:
    return f"if({part} = '', 0L, CAST({part} AS bigint))"


_DIGITS = "s RLIKE '^[0-9]+$'"
#: What the grammar's ten groups come to; absent parts have sentinels.
_PARTS = f"""p -> named_struct(
  'epoch', {_number("p[0]")}, 'release', transform(split(p[1], '[.]'), x -> CAST(x AS bigint)),
  'tag', CASE WHEN p[2] = '' THEN '' WHEN p[2] IN ('a', 'alpha') THEN 'a' WHEN p[2] IN ('b', 'beta') THEN 'b' ELSE 'rc' END, 'n', {_number("p[3]")},
  'post', CASE WHEN p[4] <> '' THEN CAST(p[4] AS bigint) WHEN p[5] <> '' THEN {_number("p[6]")} ELSE -1L END,
  'dev', if(p[7] <> '', {_number("p[8]")}, {_MAX}L), 'local', if(p[9] = '', CAST(array() AS array<string>), split(p[9], '[-_.]')))"""
#: Trailing zeros do not order versions; the first number always stays.
_VERSION = f"""v -> named_struct(
  'text', concat(if(v.epoch <> 0, concat(CAST(v.epoch AS string), '!'), ''), array_join(transform(v.release, x -> CAST(x AS string)), '.'), if(v.tag <> '', concat(v.tag, CAST(v.n AS string)), ''),
    if(v.post <> -1, concat('.post', CAST(v.post AS string)), ''), if(v.dev <> {_MAX}, concat('.dev', CAST(v.dev AS string)), ''),
    if(size(v.local) > 0, concat('+', array_join(transform(v.local, s -> if({_DIGITS}, CAST(CAST(s AS bigint) AS string), s)), '.')), '')),
  'is_prerelease', v.tag <> '' OR v.dev <> {_MAX}, 'is_postrelease', v.post <> -1, 'release', v.release,
  'key', named_struct('epoch', v.epoch, 'release', slice(v.release, 1, array_max(transform(v.release, (x, i) -> if(x <> 0, i + 1, 1)))),
    'pre', named_struct('rank', CASE v.tag WHEN 'a' THEN 0 WHEN 'b' THEN 1 WHEN 'rc' THEN 2 ELSE if(v.post = -1 AND v.dev <> {_MAX}, -1, 9) END, 'n', if(v.tag <> '', v.n, 0L)), 'post', v.post, 'dev', v.dev,
    'local', transform(v.local, s -> named_struct('isnum', CAST({_DIGITS} AS int), 'num', if({_DIGITS}, CAST(s AS bigint), 0L), 'txt', if({_DIGITS}, '', s)))))"""


def sql_parse(t: str) -> str:
    """``parse`` of a name, in SQL."""
    groups = f"split(substr(regexp_replace(lower({t}), r'{_GRAMMAR}', '=$1|$2|$3|$4|$5|$6|$7|$8|$9|$10'), 2), '[|]', -1)"
    return f"CASE WHEN lower({t}) RLIKE r'{_GRAMMAR}' THEN {sql_let(sql_let(groups, _PARTS), _VERSION)} END"


def parse(text: Column) -> Column:
    """struct<text, is_prerelease, is_postrelease, release, key>, null where text is no version."""
    return apply(text, f"t -> {sql_parse('t')}")


_INT = r"(?:0|[1-9][0-9]{0,17})"
#: Texts that are their own normal text.
_NORMAL = rf"^{_INT}(?:\.{_INT})*(?:(?:a|b|rc){_INT})?(?:\.post{_INT})?(?:\.dev{_INT})?\z"


def sql_normal_text(t: str) -> str:
    """``normal_text`` of a name, in SQL."""
    return f"CASE WHEN {t} RLIKE r'{_NORMAL}' THEN {t} ELSE {sql_let(t, f't -> {sql_parse("t")}')}.text END"


def normal_text(text: Column) -> Column:
    """``parse(text)["text"]``; most texts need no parsing for it."""
    return apply(text, f"t -> {sql_normal_text('t')}")


def sql_is_normal(t: str) -> str:
    return f"{t} RLIKE r'{_NORMAL}'"


def is_normal(text: Column) -> Column:
    """Whether ``normal_key`` can order a text: it is its own normal text, without epoch or local part."""
    return text.rlike(_NORMAL)


_NORMAL_PARTS = r"^([0-9]+(?:\.[0-9]+)*?)(?:\.0)*(?:(a|b|rc)([0-9]+))?(?:\.post([0-9]+))?(?:\.dev([0-9]+))?\z"


def _pad(n: str) -> str:
    return f"lpad({n}, 18, '0')"


_NORMAL_KEY = f"""p -> named_struct('release', transform(split(p[0], '[.]'), x -> {_pad("x")}), 'rest', concat(
  CASE WHEN p[1] = 'a' THEN '2' WHEN p[1] = 'b' THEN '3' WHEN p[1] = 'rc' THEN '4' WHEN p[3] = '' AND p[4] <> '' THEN '1' ELSE '9' END, {_pad("p[2]")},
  if(p[3] = '', '0', '1'), {_pad("p[3]")}, if(p[4] = '', '1', '0'), {_pad("p[4]")}))"""


def sql_normal_key(t: str) -> str:
    """``normal_key`` of a name, in SQL."""
    return sql_let(f"split(regexp_replace({t}, r'{_NORMAL_PARTS}', '$1|$2|$3|$4|$5'), '[|]', -1)", _NORMAL_KEY)


def normal_key(text: Column) -> Column:
    """A key that orders texts that are ``is_normal`` as ``parse(text)["key"]`` does, for a fraction of its cost.

    Numbers of at most 18 digits are padded to as many, so texts are in the order of their numbers.
    """
    return apply(text, f"t -> {sql_normal_key('t')}")


def equal_text(text: Column) -> Column:
    """One text for all versions that are equal: the normal text without the release's trailing zeros."""
    return F.regexp_replace(normal_text(text), r"^((?:[0-9]+!)?[0-9]+(?:\.[0-9]+)*?)(?:\.0)*(?=\z|[a-z+]|\.[a-z])", "$1")


def event_keys(events: Column) -> Column:
    """Events (structs of introduced, fixed, last_affected, limit) as (kind, zero, key, text)."""

    def one(e: Column) -> Column:
        kind = F.when(e["introduced"].isNotNull(), "introduced").when(e["fixed"].isNotNull(), "fixed").when(e["last_affected"].isNotNull(), "last_affected").when(e["limit"].isNotNull(), "limit")
        value = F.coalesce(e["introduced"], e["fixed"], e["last_affected"], e["limit"])
        return F.struct(kind.alias("kind"), ((kind == "introduced") & (value == "0")).alias("zero"), parse(value)["key"].alias("key"), value.alias("text"))

    return F.transform(events, one)


def event_match(key: Column, keyed: Column) -> Column:
    """Whether a version is affected: the events are folded in order; an invalid boundary means no."""

    def step(acc: Column, e: Column) -> Column:
        return (
            F.when(acc == -1, -1)
            .when(~e["zero"] & e["key"].isNull(), -1)
            .when(e["kind"] == "introduced", F.when(e["zero"] | (key >= e["key"]), 1).otherwise(acc))
            .when(e["kind"] == "last_affected", F.when(key > e["key"], 0).otherwise(acc))
            .otherwise(F.when(key >= e["key"], 0).otherwise(acc))
        )

    return F.aggregate(keyed, F.lit(0), step) == 1


def event_error(keyed: Column) -> Column:
    """The first invalid boundary's message, null if all are valid; no events are an error."""
    bad = F.filter(keyed, lambda e: ~e["zero"] & e["key"].isNull())
    first = F.get(bad, F.lit(0))
    return F.when(F.size(keyed) == 0, F.lit("version range has no events")).when(F.size(bad) > 0, F.concat(F.lit("invalid "), first["kind"], F.lit(" boundary: '"), first["text"], F.lit("'")))


def is_specifier(raw: Column) -> Column:
    """Whether a raw range is a specifier expression, not a range type."""
    text = F.trim(raw)
    return ~F.upper(text).isin("", "ECOSYSTEM", "SEMVER", "GIT") & text.rlike("[<>!=~]")


_CLAUSE = r"^\s*(~=|===|==|!=|<=|>=|<|>)\s*([^\s,;)]+?)(\.\*)?\s*$"


def _clauses(spec: Column) -> Column:
    parts = F.filter(F.split(spec, ","), lambda c: F.trim(c) != "")
    return F.transform(
        parts,
        lambda c: F.struct(
            F.regexp_extract(c, _CLAUSE, 1).alias("op"),
            (F.regexp_extract(c, _CLAUSE, 3) != "").alias("star"),
            F.regexp_extract(c, _CLAUSE, 2).alias("text"),
            parse(F.regexp_extract(c, _CLAUSE, 2)).alias("v"),
        ),
    )


def specifier_error(spec: Column) -> Column:
    """A message where the specifier cannot be read, else null."""
    bad = F.exists(_clauses(spec), lambda c: (c["op"] == "") | ((c["op"] != "===") & c["v"].isNull()) | (c["star"] & ~c["op"].isin("==", "!=")) | ((c["op"] == "~=") & (F.size(c["v"]["release"]) < 2)))
    return F.when(bad, F.concat(F.lit("invalid PEP 440 specifier: "), spec))


def _padded(release: Column, n: Column) -> Column:
    return F.slice(F.concat(release, F.array_repeat(F.lit(0).cast("bigint"), F.greatest(n - F.size(release), F.lit(0)))), 1, n)


def specifier_match(version: Column, spec: Column, prereleases: bool | None = True) -> Column:
    """Whether a parsed version satisfies a specifier. prereleases None: only if a clause names one."""
    no_local = lambda k: F.struct(k["epoch"], k["release"], k["pre"], k["post"], k["dev"])
    base = lambda v: F.struct(v["key"]["epoch"], v["key"]["release"])
    prefix = lambda v, c, n: (v["key"]["epoch"] == c["v"]["key"]["epoch"]) & (_padded(v["release"], n) == F.slice(c["v"]["release"], 1, n))

    def one(c: Column) -> Column:
        k, s = version["key"], c["v"]["key"]
        public, spec_public = no_local(k), no_local(s)
        equal = F.when(c["star"], prefix(version, c, F.size(c["v"]["release"]))).when(F.size(s["local"]) > 0, k == s).otherwise(public == spec_public)
        below = (k < s) & ~(~c["v"]["is_prerelease"] & version["is_prerelease"] & (base(version) == base(c["v"])))
        same = base(version) == base(c["v"])
        above = (k > s) & ~(~c["v"]["is_postrelease"] & version["is_postrelease"] & same) & ~((F.size(k["local"]) > 0) & same)
        return (
            F.when(c["op"] == "===", F.lower(version["text"]) == F.lower(c["text"]))
            .when(c["op"] == "==", equal)
            .when(c["op"] == "!=", ~equal)
            .when(c["op"] == "<=", public <= spec_public)
            .when(c["op"] == ">=", public >= spec_public)
            .when(c["op"] == "<", below)
            .when(c["op"] == ">", above)
            .when(c["op"] == "~=", (public >= spec_public) & prefix(version, c, F.size(c["v"]["release"]) - 1))
        )

    def whole(clauses: Column) -> Column:
        fits = F.forall(clauses, one)
        if prereleases:
            return fits
        named = F.exists(clauses, lambda c: F.coalesce(c["v"]["is_prerelease"], F.lit(False)) & (c["op"] != "!=")) if prereleases is None else F.lit(False)
        return fits & (~version["is_prerelease"] | named)

    return let(_clauses(spec), whole)
