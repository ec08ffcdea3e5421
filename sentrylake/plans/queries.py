"""The registered queries over the supplied tables, each next to its DuckDB SQL.

Rows that the tables lack (versions, tags, patches, advisories) are derived from keys, the same way
on both sides; every query covers its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions import ident, pep440, text
from sentrylake.operators import advisories, changelog, evidence, ranges, releases
from sentrylake.operators.ranking import running_total
from sentrylake.plans.registry import ORACLES, QUERIES, query
from sentrylake.sources import landing
from sentrylake.streaming.replay import replay_counts

__all__ = ["ORACLES", "QUERIES"]

def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_RAW = "concat('V', p_size % 4, '.', p_partkey % 12, element_at(array('.0', '-RC.1', '.POST2', '_dev3', ''), CAST(p_partkey % 5 AS int) + 1))"
_RAW_SQL = "'V' || (p_size % 4) || '.' || (p_partkey % 12) || ['.0', '-RC.1', '.POST2', '_dev3', ''][p_partkey % 5 + 1]"
_NORM_SQL = "(p_size % 4) || '.' || (p_partkey % 12) || ['.0', 'rc1', '.post2', '.dev3', ''][p_partkey % 5 + 1]"
_CLASS_SQL = "[2, 1, 3, 0, 2][p_partkey % 5 + 1]"


def _versions(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "part").select("p_partkey", F.expr(_RAW).alias("raw")).withColumn("version", pep440.parse(F.col("raw")))


@query(f"SELECT p_partkey, {_RAW_SQL} AS raw, {_NORM_SQL} AS normalized, p_partkey % 5 IN (1, 3) AS is_prerelease FROM part")
def version_normalize(spark, d):
    return _versions(spark, d).select("p_partkey", "raw", F.col("version.text").alias("normalized"), F.col("version.is_prerelease").alias("is_prerelease"))


@query(f"SELECT DISTINCT {_NORM_SQL} AS normalized, dense_rank() OVER (ORDER BY p_size % 4, p_partkey % 12, {_CLASS_SQL}) AS version_rank FROM part")
def version_order_rank(spark, d):
    # the first text of each key counts one, so equal versions share a rank; no task holds the inventory
    stock = _versions(spark, d).select(F.col("version.key").alias("key"), F.col("version.text").alias("normalized")).distinct()
    keys = running_total(stock.select("key").distinct(), F.lit(1), "key").withColumnRenamed("total", "version_rank")
    return stock.join(keys, "key").select("normalized", "version_rank")


_EVENTS = """array(named_struct('introduced', concat(o_orderkey % 4, '.', o_orderkey % 12), 'fixed', CAST(NULL AS string), 'last_affected', CAST(NULL AS string), 'limit', CAST(NULL AS string)),
 named_struct('introduced', CAST(NULL AS string), 'fixed', concat(o_custkey % 4 + 1, '.', o_custkey % 7), 'last_affected', CAST(NULL AS string), 'limit', CAST(NULL AS string)))"""
_RESOLVED_SQL = f"""stock AS (SELECT DISTINCT p_size % 4 AS a, p_partkey % 12 AS b, {_CLASS_SQL} AS c, {_NORM_SQL} AS v FROM part),
r AS (SELECT DISTINCT o_orderkey % 4 AS ia, o_orderkey % 12 AS ib, o_custkey % 4 + 1 AS fa, o_custkey % 7 AS fb FROM orders),
hit AS (SELECT ia, ib, fa, fb, count(*) AS n_affected, string_agg(v, ',' ORDER BY a, b, c, v) AS l, bool_or(c = 2 AND a = fa AND b = fb) AS overlap
  FROM r JOIN stock ON (a, b, c) >= (ia, ib, 2) AND (a, b, c) < (fa, fb, 2) GROUP BY ALL)"""


def _orders_resolved(spark, d):
    rows = _t(spark, d, "orders").withColumn("events", F.expr(_EVENTS))
    return rows.withColumn("id", ranges.list_id(F.col("events"))).join(ranges.resolve_events(rows, _versions(spark, d)), "id", "left")


@query(f"WITH {_RESOLVED_SQL} SELECT o_orderkey, coalesce(n_affected, 0)::BIGINT AS n_affected, sha256(coalesce(l, '')) AS affected_sha256 FROM orders LEFT JOIN hit ON ia = o_orderkey % 4 AND ib = o_orderkey % 12 AND fa = o_custkey % 4 + 1 AND fb = o_custkey % 7")
def range_event_resolve(spark, d):
    found = F.coalesce(F.array_size("resolved"), F.lit(0)).cast("bigint")
    listed = F.sha2(F.coalesce(F.array_join(F.col("resolved.text"), ","), F.lit("")), 256)
    return _orders_resolved(spark, d).select("o_orderkey", found.alias("n_affected"), listed.alias("affected_sha256"))


_SPECS = (">=1.2,<3.0", "~=2.3", "==1.*", "!=2.4.0", "<=0.5.post2")


@query(f"WITH s AS (SELECT DISTINCT p_size % 4 AS a, p_partkey % 12 AS b, {_CLASS_SQL} AS c, {_NORM_SQL} AS v FROM part), n AS (SELECT *, a * 1000 + b * 10 + c AS n FROM s) SELECT '>=1.2,<3.0' AS spec, v AS version FROM n WHERE n >= 1022 AND n < 3000 UNION ALL SELECT '~=2.3', v FROM n WHERE a = 2 AND n >= 2032 UNION ALL SELECT '==1.*', v FROM n WHERE a = 1 UNION ALL SELECT '!=2.4.0', v FROM n WHERE n <> 2042 UNION ALL SELECT '<=0.5.post2', v FROM n WHERE n <= 53")
def specifier_resolve(spark, d):
    specs = spark.range(1).select(F.explode(F.array(*map(F.lit, _SPECS))).alias("spec"))
    return ranges.specifier_hits(specs, _versions(spark, d)).select("spec", F.col("version.text").alias("version"))


_IDS = "array_compact(array(if(c_custkey % 2 = 0, concat('cve-2024-', c_custkey), NULL), if(c_custkey % 3 = 0, concat('GHSA-', c_custkey), NULL), if(c_custkey % 5 = 0, concat('PYSEC-', c_custkey), NULL), concat('X-', c_custkey)))"


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'GHSA-' WHEN c_custkey % 2 = 0 THEN 'cve-2024-' WHEN c_custkey % 5 = 0 THEN 'PYSEC-' ELSE 'X-' END || c_custkey AS canonical, CASE WHEN c_custkey % 2 = 0 THEN 'cve-2024-' || c_custkey END AS cve FROM customer")
def canonical_identifier(spark, d):
    rows = _t(spark, d, "customer").select("c_custkey", F.expr(_IDS).alias("ids"))
    return rows.select("c_custkey", ident.canonical_id(F.col("ids")).alias("canonical"), ident.first_with(F.col("ids"), "CVE-").alias("cve"))


#: Records are orders; two share an identifier if the same customer placed them in the same month.
_SHARED = "concat(o_custkey, '/', date_format(o_orderdate, 'yyyy-MM'))"


def _records(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", F.array(F.expr(_SHARED), F.expr("concat('chain-', o_custkey, '/', quarter(o_orderdate))")).alias("aliases"))


_COMPONENT_SQL = "min(o_orderkey) OVER (PARTITION BY o_custkey, quarter(o_orderdate))"


@query(f"SELECT o_orderkey AS record, {_COMPONENT_SQL} AS component FROM orders")
def alias_components(spark, d):
    return advisories.alias_components(_records(spark, d), "o_orderkey", "aliases")


_TAGS = "element_at(array('v', 'release-', ''), CAST(p_partkey % 3 AS int) + 1)"
_TAG_SQL = "['v', 'release-', ''][p_partkey % 3 + 1] || (p_size % 4) || '.' || (p_partkey % 12)"
_PICK_SQL = f"""tags AS (SELECT {_TAG_SQL} AS name, (p_size % 4) || '.' || (p_partkey % 12) AS v, lpad(p_partkey::VARCHAR, 40, '0') AS sha, [3, 1, 2][p_partkey % 3 + 1] AS rank FROM part),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY v ORDER BY rank = 1, rank DESC, name DESC, sha DESC) AS k FROM tags) WHERE k = 1)"""


def _tags(spark, d):
    return _t(spark, d, "part").select(F.expr(f"concat({_TAGS}, p_size % 4, '.', p_partkey % 12)").alias("name"), F.expr("lpad(CAST(p_partkey AS string), 40, '0')").alias("sha"))


@query(f"WITH {_PICK_SQL} SELECT v AS normalized_version, name AS git_tag, sha AS commit_sha, ['release_prefix', 'exact', 'v_prefix'][rank] AS match_type, CASE WHEN rank = 1 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS confidence FROM best")
def tag_preference(spark, d):
    return releases.preferred_tags(_tags(spark, d))


_HEAD = "concat('Release ', doc_id % 9, '.', doc_id, if(doc_id % 2 = 0, ' (2024-02-03)', ''))"
_HEAD_SQL = "'Release ' || (doc_id % 9) || '.' || doc_id || CASE WHEN doc_id % 2 = 0 THEN ' (2024-02-03)' ELSE '' END"


@query(rf"""WITH l AS (SELECT doc_id, trim(regexp_replace(unnest(regexp_split_to_array(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]')), '^[\s\x0B]+|[\s\x0B]+$', '', 'g')) AS line FROM documents)
SELECT doc_id, (doc_id % 9) || '.' || doc_id AS version, CASE WHEN doc_id % 2 = 0 THEN '2024-02-03' END AS date, count(*) FILTER (line <> '') AS n_entries, coalesce(sum(length(line)), 0)::BIGINT AS n_letters FROM l WHERE doc_id % 9 < 10 GROUP BY 1""")
def changelog_parse(spark, d):
    # every line of the whole text as an entry under one heading: reStructuredText for odd ids, Markdown for even ones
    docs = _t(spark, d, "documents").where("text IS NOT NULL")
    bullets = F.concat(F.lit("* "), F.regexp_replace("text", "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\n* "))
    rst = docs.where("doc_id % 2 = 1").select("doc_id", F.concat(F.lit("Title\n=====\n* lost\n"), F.expr(_HEAD), F.lit("\n----\n"), bullets, F.lit("\nno version\n~~~\n* lost")).alias("log"))
    markdown = docs.where("doc_id % 2 = 0").select("doc_id", F.concat(F.lit("# Title\n* lost\n## "), F.expr(_HEAD), F.lit("\n"), bullets, F.lit("\n### no version\n* lost")).alias("log"))
    found = changelog.parse_changelogs(rst, "doc_id", "log").unionByName(changelog.parse_changelogs(markdown, "doc_id", "log", "markdown"))
    letters = F.aggregate("entries", F.lit(0).cast("bigint"), lambda n, e: n + F.char_length(e["text"]))
    return found.select(F.col("doc").alias("doc_id"), "version", "date", F.size("entries").cast("bigint").alias("n_entries"), letters.alias("n_letters"))


_BULLETS = "array('- Fixed ', '- Added ', '* Deprecated ', '- ', '- Security: ', '- Documentation for ', '')"


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i FROM documents),
p AS (SELECT doc_id, ['- Fixed ', '- Added ', '* Deprecated ', '- ', '- Security: ', '- Documentation for ', ''][(doc_id + i) % 7 + 1] || t AS line FROM l),
e AS (SELECT doc_id, line, regexp_extract(line, '^\s*[-*]\s+(.+)$', 1) AS entry FROM p)
SELECT doc_id, CASE WHEN regexp_matches(entry, '(?i)\b(CVE|GHSA|vulnerability|vulnerabilities|security)\b') THEN 'security' WHEN regexp_matches(entry, '(?i)\bdeprecat') THEN 'deprecation'
 WHEN regexp_matches(line, '(?i)^\s*[-*]\s+(Bugfix|Bug|Fix|Fixed)\b') THEN 'bugfix' WHEN regexp_matches(entry, '(?i)\bdoc(umentation|s)?\b') THEN 'documentation'
 WHEN regexp_matches(line, '(?i)^\s*[-*]\s+(Added|New|Support|Implement)') THEN 'feature' ELSE 'other' END AS category, count(*) AS n_entries FROM e WHERE trim(entry) <> '' GROUP BY 1, 2""")
def changelog_line_classify(spark, d):
    # every line of the whole texts, bullets planted before all but each seventh
    planted = F.concat(F.expr(f"element_at({_BULLETS}, CAST((doc_id + i) % 7 AS int) + 1)"), "t")
    rows = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "t")).select("doc_id", planted.alias("line"))
    found = rows.withColumn("entry", text.entry_text(F.col("line"))).where("entry IS NOT NULL")
    return found.groupBy("doc_id", text.entry_category(F.col("line"), F.col("entry")).alias("category")).agg(F.count("*").alias("n_entries"))


@query("SELECT doc_id, list_sort(list_distinct(list_filter(['CVE-2024-' || lpad((doc_id % 977)::VARCHAR, 4, '0'), CASE WHEN doc_id % 3 = 0 THEN '#' || doc_id END, CASE WHEN doc_id % 4 = 0 THEN 'GHSA-ab12-cd34-' || lpad((doc_id % 50)::VARCHAR, 4, 'x') END], lambda x: x IS NOT NULL)))::VARCHAR AS refs FROM documents")
def reference_extract(spark, d):
    # the whole text with planted references appended; the SQL lists the planted ones, as no supplied text has any
    planted = F.expr("concat(coalesce(text, ''), '\\nSee CVE-2024-', lpad(CAST(doc_id % 977 AS string), 4, '0'), if(doc_id % 3 = 0, concat(' and #', doc_id), ''), if(doc_id % 4 = 0, concat(' GHSA-ab12-cd34-', lpad(CAST(doc_id % 50 AS string), 4, 'x')), ''), ' in the log')")
    rows = _t(spark, d, "documents").select("doc_id", text.references(planted).alias("refs"))
    return rows.select("doc_id", F.concat(F.lit("["), F.array_join("refs", ", "), F.lit("]")).alias("refs"))


@query("""WITH p AS (SELECT page_id, url, regexp_replace(url, '#.*$', '') AS u FROM pages), q AS (SELECT *, CASE WHEN position('?' IN u) > 0 THEN substr(u, position('?' IN u) + 1) ELSE '' END AS s FROM p)
SELECT page_id, sha256('{"body_sha256":null,"method":"GET","url":"' || CASE WHEN s = '' THEN rtrim(u, '?') ELSE split_part(u, '?', 1) || '?' || array_to_string(list_sort(string_split(s, '&')), '&') END || '"}') AS request_key,
CASE WHEN url NOT LIKE 'https://%' THEN 'URL is not https with a host' END AS problem FROM q""")
def request_identity(spark, d):
    method, url = F.lit("get"), F.col("url")
    return _t(spark, d, "pages").select("page_id", ident.request_key(method, url).alias("request_key"), ident.request_problem(method, url).alias("problem"))


@query("""WITH r AS (SELECT event_id, [200, 429, 500, 404, 503, 403][event_id % 6 + 1] AS status, user_id % 6 + 1 AS attempt, CASE WHEN event_id % 7 = 0 AND event_id % 3 <> 0 THEN event_id % 50 END AS after, event_id % 4 = 1 AS spent FROM events),
d AS (SELECT *, CASE WHEN NOT (status IN (429, 500, 502, 503, 504) OR (status = 403 AND spent)) THEN 'permanent_status' WHEN attempt > 4 THEN 'attempts_exhausted' WHEN after > 30 THEN 'wait_over_bound' WHEN after IS NOT NULL THEN CASE WHEN status = 403 THEN 'github_rate_limit' ELSE 'retry_after' END ELSE 'transient_status' END AS reason FROM r)
SELECT event_id, status, reason, reason IN ('retry_after', 'github_rate_limit', 'transient_status') AS retry, CASE WHEN reason IN ('retry_after', 'github_rate_limit', 'transient_status') THEN greatest(least(0.5 * 2 ** (attempt - 1), 30), coalesce(after, 0))::DOUBLE END AS delay FROM d""")
def retry_decision(spark, d):
    status = "element_at(array(200, 429, 500, 404, 503, 403), CAST(event_id % 6 AS int) + 1)"
    rows = _t(spark, d, "events").select("event_id", F.expr(status).alias("status"), F.expr("user_id % 6 + 1").alias("attempt"), F.expr("CASE WHEN event_id % 21 = 0 THEN concat(event_id % 50, '.5') WHEN event_id % 7 = 0 THEN concat(' ', event_id % 50) END").alias("after"), F.expr("event_id % 4 = 1").alias("spent"))
    asked = landing.retry_after_seconds(F.col("after"), F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return rows.withColumn("r", landing.retry_decision(F.col("status"), F.col("attempt"), asked, F.col("spent"))).select("event_id", "status", "r.reason", "r.retry", "r.delay")


_NAMES = "Cache-Control,Content-Type,Date,ETag,Expires,Last-Modified,Retry-After,X-RateLimit-Limit,X-RateLimit-Remaining,X-RateLimit-Reset,X-RateLimit-Resource"


@query(f"SELECT event_id, list_aggregate(list_transform(string_split('{_NAMES}', ','), lambda n: lower(n) || '=' || CASE n WHEN 'ETag' THEN substr(repeat(props, 300), 1, 2048) WHEN 'Content-Type' THEN event_type ELSE n || event_id END), 'string_agg', ';') AS headers FROM events")
def header_sanitize(spark, d):
    value = lambda n: F.expr("repeat(props, 300)") if n == "ETag" else F.col("event_type") if n == "Content-Type" else F.concat(F.lit(n), "event_id")
    given = [*_NAMES.split(","), "Authorization", "Content-Length", "Content-Encoding", "Link", "Set-Cookie"]
    headers = F.create_map(*[c for n in given for c in (F.lit(n), value(n))])
    rows = _t(spark, d, "events").select("event_id", landing.kept_headers(headers).alias("h"))
    return rows.select("event_id", F.array_join(F.transform("h", lambda e: F.concat(e["k"], F.lit("="), e["v"])), ";").alias("headers"))


@query("SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'half of a pair is missing' WHEN doc_id % 7 = 0 THEN 'size differs' WHEN doc_id % 5 = 0 THEN 'digest differs' END AS problem FROM documents")
def raw_integrity(spark, d):
    body = F.encode("text", "UTF-8")
    size = F.expr("if(doc_id % 11 = 0, NULL, octet_length(text) + if(doc_id % 7 = 0, 1, 0))")
    digest = F.sha2(F.concat(F.col("text"), F.expr("if(doc_id % 5 = 0, '!', '')")), 256)
    return _t(spark, d, "documents").select("doc_id", landing.integrity(body, size, digest).alias("problem"))


@query("""SELECT doc_id, 'advisory:' || sha256('{"doc":' || doc_id || ',"source":"' || source || '"}') AS record_id FROM documents""")
def stable_record_id(spark, d):
    return _t(spark, d, "documents").select("doc_id", ident.stable_record_id("advisory", source=F.col("source"), doc=F.col("doc_id")).alias("record_id"))


_PATCH = "concat('@@ -1 +1 @@\\n+def f', p_partkey % 50, '(x):\\n+    if x is None:\\n+        raise ValueError', p_partkey % 3, '\\n-class C', p_size, ':\\n+    assert ok', if(p_partkey % 2 = 0, '\\n async def g():', ''))"


def _patches(spark, d):
    return _t(spark, d, "part").select("p_partkey", F.expr(_PATCH).alias("patch"), F.expr("concat(if(p_partkey % 3 = 0, 'tests/', 'src/'), if(p_partkey % 2 = 0, 'test_', 'mod_'), p_partkey, '.py')").alias("path"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(['f' || (p_partkey % 50), 'C' || p_size, CASE WHEN p_partkey % 2 = 0 THEN 'g' END], lambda x: x IS NOT NULL))), ',') AS symbols FROM part")
def diff_symbols(spark, d):
    return _patches(spark, d).select("p_partkey", F.array_join(text.diff_symbols(F.col("patch")), ",").alias("symbols"))


@query("SELECT p_partkey, 'assert ok,if x is None:,raise ValueError' || (p_partkey % 3) AS guards FROM part")
def diff_guards(spark, d):
    return _patches(spark, d).select("p_partkey", F.array_join(text.diff_guards(F.col("patch")), ",").alias("guards"))


@query("SELECT p_partkey, p_partkey % 2 = 0 AS is_test FROM part")
def regression_tests(spark, d):
    return _patches(spark, d).select("p_partkey", text.is_regression_test(F.col("path")).alias("is_test"))


_FLAGS = "n_chars > 500 AS api, doc_id % 3 = 0 AS config, quality = 1 AS flow"


@query(f"WITH f AS (SELECT doc_id, {_FLAGS} FROM documents JOIN labels USING (doc_id)) SELECT doc_id, 'version' || CASE WHEN api AND config AND flow THEN '_api_configuration_dataflow' WHEN api AND flow THEN '_api_dataflow' WHEN api AND config THEN '_api_configuration' WHEN api THEN '_api' ELSE '_only' END AS detection_type FROM f")
def detection_type(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", "n_chars").join(_t(spark, d, "labels"), "doc_id")
    return rows.selectExpr("doc_id", *[x.strip() for x in _FLAGS.split(",")]).select("doc_id", evidence.detection_type(F.col("api"), F.col("config"), F.col("flow")).alias("detection_type"))


@query("SELECT doc_id, round(((n_chars > 500)::INT + (doc_id % 3 = 0)::INT + quality + toxic + (lang = 'en')::INT + (doc_id % 2)::INT + (n_chars > 2000)::INT + 1) / 8, 4) AS score FROM documents JOIN labels USING (doc_id)")
def usefulness_score(spark, d):
    rows = _t(spark, d, "documents").drop("text").join(_t(spark, d, "labels"), "doc_id")
    parts = [F.expr(x) for x in ("n_chars > 500", "doc_id % 3 = 0", "quality = 1", "toxic = 1", "lang = 'en'", "doc_id % 2 = 1", "n_chars > 2000", "true")]
    return rows.select("doc_id", evidence.usefulness(*parts).alias("score"))


@query("""SELECT n_nationkey, '{"name":"' || n_name || '","nationkey":' || n_nationkey || ',"region":' || CASE WHEN n_regionkey = 0 THEN 'null' ELSE '"' || r_name || '"' END || '}' AS line FROM nation JOIN region ON n_regionkey = r_regionkey""")
def canonical_jsonl(spark, d):
    rows = _t(spark, d, "nation").join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", ident.canonical_json(region=F.when(F.col("n_regionkey") != 0, F.col("r_name")), name=F.col("n_name"), nationkey=F.col("n_nationkey")).alias("line"))


@query("SELECT event_type, count(*) AS n_events, count(DISTINCT event_id)::BIGINT AS n_ids FROM events GROUP BY 1")
def stream_replay(spark, d):
    # event ids are unique, so their count is that of the rows with one
    return replay_counts(spark, d, "events.parquet", "event_type", F.count("*").alias("n_events"), F.count("event_id").alias("n_ids"))


from sentrylake.plans import engine_queries  # noqa: E402, F401  (registers its queries)
