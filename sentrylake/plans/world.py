"""Landed bodies made of the supplied tables, so the whole engine runs over whole tables.

``landed`` gives what a landing folder would: a project body, tags, releases and a changelog per part,
an advisory feed body per order, and commit bodies. ``SQL`` derives from the same tables, without any
body, what the engine must make of them, as DuckDB common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.plans import knowledge
from sentrylake.session import materialise, tasks_for

NAME, SLUG = "demo", "acme/demo"
#: Orders name the parts 1 to 150; their fixed versions and commits reach the parts up to here.
MOST_PART = 171


def _norm(p: str) -> str:
    return f"concat(({p}) % 7, '.', {p}, element_at(array('.0', 'rc1', '.post2', '.dev3', ''), CAST(({p}) % 5 AS int) + 1))"


def _raw(p: str) -> str:
    return f"concat('V', ({p}) % 7, '.', {p}, element_at(array('.0', '-RC.1', '.POST2', '_dev3', ''), CAST(({p}) % 5 AS int) + 1))"


def _sha(p: str, fill: str) -> str:
    return f"lpad(CAST({p} AS string), 40, '{fill}')"


def _bodies(rows: DataFrame, body: str, url: str, at: str = "'2026-01-01T00:00:00Z'") -> DataFrame:
    made = rows.select(F.expr(body).alias("body"), F.expr(url).alias("url"), F.expr(at).alias("retrieved_at"))
    return made.withColumn("body_sha256", F.sha2("body", 256))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """A table dealt out by a key, so that all cores make bodies of it however few files it has."""
    return rows.repartition(tasks_for(rows), key)


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One project body per part: its release with an artifact per order line; each eleventh has an unreadable key."""
    lines = _spread(_table(spark, sf_dir, "lineitem"), "l_partkey").withColumn("filename", F.expr(f"concat('demo-', {_norm('l_partkey')}, '-', l_orderkey, '-', l_linenumber, '.tar.gz')"))
    file = F.expr(
        "named_struct('filename', filename, 'url', concat('https://files.pythonhosted.org/p/', filename), 'size', CAST(l_quantity AS bigint), 'digests', named_struct('sha256', sha2(filename, 256)), "
        "'packagetype', if(l_linenumber % 2 = 0, ' sdist ', ' '), 'python_version', CAST(NULL AS string), 'requires_python', CASE WHEN l_linestatus = 'F' THEN '>=3.8' WHEN l_partkey % 3 = 0 THEN '>=3.9' END, "
        "'upload_time_iso_8601', date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), 'yanked', l_returnflag = 'R' OR l_partkey % 10 = 0, 'yanked_reason', CASE WHEN l_partkey % 20 = 0 THEN 'withdrawn' WHEN l_returnflag = 'R' THEN concat('broken ', l_linestatus) END)"
    )
    files = lines.groupBy("l_partkey").agg(F.collect_list(file).alias("files"))
    rows = _table(spark, sf_dir, "part").join(files, F.col("p_partkey") == F.col("l_partkey"), "left")
    some = "coalesce(files, slice(array(named_struct('filename', '', 'url', '', 'size', CAST(0 AS bigint), 'digests', named_struct('sha256', ''), 'packagetype', '', 'python_version', CAST(NULL AS string), 'requires_python', '', 'upload_time_iso_8601', '', 'yanked', false, 'yanked_reason', '')), 1, 0))"
    entries = f"if(p_partkey % 11 = 0, map({_raw('p_partkey')}, {some}, concat('nightly-', p_partkey), slice({some}, 1, 0)), map({_raw('p_partkey')}, {some}))"
    return _bodies(rows, f"to_json(named_struct('info', named_struct('name', '{NAME}'), 'releases', {entries}))", f"'https://pypi.org/pypi/{NAME}/json'")


def _tag(name: str, fill: str) -> str:
    return f"named_struct('name', {name}, 'commit', named_struct('sha', {_sha('p_partkey', fill)}))"


def repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lists, release lists and changelogs, a body per part."""
    parts, norm = _table(spark, sf_dir, "part"), _norm("p_partkey")
    released, plain, v = _tag(f"concat('release-', {norm})", "c"), _tag(norm, "a"), _tag(f"concat('v', {norm})", "a")
    tags = f"to_json(CASE p_partkey % 4 WHEN 0 THEN array({released}, {v}) WHEN 1 THEN array({plain}, {released}) WHEN 2 THEN array({released}) ELSE slice(array({v}), 1, 0) END)"
    api = f"https://api.github.com/repos/{SLUG}"
    release = f"to_json(array(named_struct('tag_name', concat('v', {norm}), 'html_url', concat('https://github.com/{SLUG}/releases/tag/v', {norm}), 'body', p_name)))"
    entries = "concat('\\n- Fixed ', p_name, '\\n  more words\\n* Added CVE-2024-', lpad(CAST(p_partkey AS string), 4, '0'), ' for #', p_partkey, '\\n')"
    rst = f"concat('Changes\\n=======\\n', {norm}, ' (2024-01-05)\\n-----\\n', {entries}, 'unversioned\\n~~~~\\n- lost\\n')"
    markdown = f"concat('# Changes\\n## ', {norm}, '\\n', {entries}, '### notes\\n- lost\\n')"
    files = f"https://raw.githubusercontent.com/{SLUG}/main/CHANGES"
    logs = parts.where("p_partkey % 3 = 0")
    log = _bodies(logs, f"if(p_partkey % 2 = 0, {markdown}, {rst})", f"concat('{files}-', p_partkey, if(p_partkey % 2 = 0, '.md', '.rst'))")
    return _bodies(parts, tags, f"'{api}/tags?per_page=100'").unionByName(_bodies(parts.where("p_partkey % 4 = 0"), release, f"'{api}/releases?per_page=100'")).unionByName(log)


#: The part that an order's advisory is about.
_Q = "(o_orderkey % 150 + 1)"
_COMMIT_URL = f"https://github.com/{SLUG}/commit/"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed body per order; orders of one customer in one quarter share an alias."""
    own = "CASE o_orderkey % 4 WHEN 0 THEN concat('GHSA-', o_orderkey) WHEN 1 THEN concat('CVE-2024-', o_orderkey) WHEN 2 THEN concat('PYSEC-2024-', o_orderkey) ELSE concat('OSV-', o_orderkey) END"
    aliases = "array_compact(array(concat('LINK-', o_custkey, '-', quarter(o_orderdate)), if(o_orderkey % 8 = 0, concat('cve-2024-', o_orderkey), NULL), ' '))"
    details = "CASE o_orderkey % 3 WHEN 0 THEN concat('redirect to attacker-controlled host ', repeat('x', CAST(o_orderkey % 7 AS int))) WHEN 1 THEN 'denial of service via cert_none' END"
    summary = "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE concat(' Leak of header ', o_orderkey, ' ') END"
    stamp = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    event = lambda i, f: f"named_struct('introduced', {i}, 'fixed', {f})"
    null = "CAST(NULL AS string)"
    fixed = f"if(o_orderkey % 6 = 0, concat(({_Q} + 14) % 7, '.', {_Q} + 14, '.1.5'), {_norm(f'({_Q} + 14)')})"
    ecosystem = f"named_struct('type', 'ecosystem', 'events', array({event(_norm(_Q), null)}, {event(null, fixed)}))"
    git = f"named_struct('type', 'GIT', 'events', array({event(_sha(f'({_Q} + 1)', 'c'), null)}))"
    ranges = f"if(o_orderkey % 5 = 0, array({ecosystem}, {git}), array({ecosystem}))"
    listed = f"if(o_orderkey % 7 = 0, array({_norm(_Q)}, concat(' ', {_norm(f'({_Q} + 21)')}, ' ')), NULL)"
    mine = f"named_struct('package', named_struct('name', ' Demo ', 'ecosystem', 'PyPI'), 'ranges', {ranges}, 'versions', {listed})"
    other = f"named_struct('package', named_struct('name', 'other', 'ecosystem', 'PyPI'), 'ranges', slice({ranges}, 1, 0), 'versions', array('9.9'))"
    references = f"array(named_struct('type', 'FIX', 'url', concat('{_COMMIT_URL}', {_sha(_Q, 'A')})), named_struct('type', 'WEB', 'url', if(o_orderkey % 10 = 0, concat('ftp://mirror/', o_orderkey), 'https://example.org/x')))"
    vuln = (
        f"named_struct('id', {own}, 'summary', {summary}, 'details', {details}, 'aliases', {aliases}, 'modified', if(o_orderkey % 9 = 0, 'yesterday', {stamp}), 'published', {stamp}, "
        f"'database_specific', named_struct('cwe_ids', if(o_orderkey % 2 = 0, array(' 79 ', 'CWE-200', ''), NULL), 'severity', if(o_orderstatus = 'F', 'high', NULL)), 'references', {references}, "
        f"'affected', array({mine}, {other}), 'severity', if(o_orderkey % 4 = 0, array(named_struct('type', 'note', 'score', '1'), named_struct('type', 'CVSS_V3', 'score', concat('CVSS:3.1/', o_orderkey))), NULL))"
    )
    at = "date_format(timestamp'2026-01-02 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, o_orderkey), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    return _bodies(_spread(_table(spark, sf_dir, "orders"), "o_orderkey"), f"to_json(named_struct('vulns', array({vuln})))", "'https://api.osv.dev/v1/query'", at)


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commit bodies per low part; some of another repository, some malformed, some with unsafe names."""
    parts = _table(spark, sf_dir, "part").where(f"p_partkey <= {MOST_PART}").select("p_partkey", F.explode(F.array(F.lit("a"), F.lit("c"))).alias("fill"))
    sha = "lpad(CAST(p_partkey AS string), 40, fill)"
    guard = "if(p_partkey % 2 = 0, 'if cert_reqs == ssl.CERT_NONE:', 'if redirect url is None:')"
    patch = f"concat('@@ -1 +1 @@ def hunk\\n+def fn_', p_partkey % 9, '(self):\\n+    ', {guard}, '\\n+        raise ValueError\\n-class K', p_partkey % 4, ':\\n context')"
    source = "if(p_partkey % 19 = 0, '../x.py', concat(' src\\\\demo\\\\mod_', p_partkey % 9, '.py '))"
    files = f"array(named_struct('filename', {source}, 'patch', {patch}), named_struct('filename', concat('tests/test_', p_partkey, '.py'), 'patch', '+async def test_a():'), named_struct('filename', ' ', 'patch', CAST(NULL AS string)))"
    body = f"named_struct('sha', upper({sha}), 'html_url', concat('{_COMMIT_URL}', {sha}), 'parents', array(named_struct('sha', {_sha('p_partkey', 'B')})), 'files', {files})"
    url = f"concat('https://api.github.com/repos/', if(p_partkey % 13 = 0, 'evil/fork', '{SLUG}'), '/commits/', {sha})"
    return _bodies(parts, f"if(p_partkey % 17 = 0, '[]', to_json({body}))", url)


#: What makes the bodies of each kind.
KINDS = {"project": projects, "tags": repository, "releases": repository, "changelog": repository, "feed": feed, "commits": commits}


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = projects(spark, sf_dir).unionByName(repository(spark, sf_dir)).unionByName(feed(spark, sf_dir)).unionByName(commits(spark, sf_dir))
    return materialise(made, "world")


def _bodies_of(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Bodies by kind, each table of them made once; feed and projects are read whole once only, so they are not written."""
    made: dict[Callable, DataFrame] = {}

    def bodies(kind: str) -> DataFrame:
        make = KINDS[kind]
        if make not in made:
            made[make] = make(spark, sf_dir) if make in (feed, projects) else materialise(make(spark, sf_dir), make.__name__)
        return made[make]

    return bodies


_BUILT: dict[tuple[str, str], knowledge.Base] = {}


def bundle(spark: SparkSession, sf_dir: str) -> knowledge.Base:
    """The engine over the tables of a folder; each of its tables is made once a session, when it is asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = knowledge.Base(_bodies_of(spark, sf_dir), NAME, SLUG)
    return _BUILT[key]


def _dnorm(p: str) -> str:
    return f"((({p}) % 7) || '.' || ({p}) || ['.0', 'rc1', '.post2', '.dev3', ''][({p}) % 5 + 1])"


#: DuckDB: what each part, order and cluster comes to.
SQL = f"""files AS (SELECT l_partkey AS p, 'demo-' || {_dnorm('l_partkey')} || '-' || l_orderkey || '-' || l_linenumber || '.tar.gz' AS filename, l_returnflag = 'R' OR l_partkey % 10 = 0 AS yanked, l_linenumber % 2 = 0 AS sdist, l_quantity::BIGINT AS size,
  CASE WHEN l_linestatus = 'F' THEN '>=3.8' WHEN l_partkey % 3 = 0 THEN '>=3.9' END AS python, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, CASE WHEN l_partkey % 20 = 0 THEN 'withdrawn' WHEN l_returnflag = 'R' THEN 'broken ' || l_linestatus END AS why FROM lineitem),
rel AS (SELECT p, count(*) AS n_artifacts, bool_and(yanked) AS is_yanked, min(stamp) AS release_date, CASE WHEN count(DISTINCT python) = 1 THEN min(python) END AS requires_python, CASE WHEN bool_and(yanked) AND count(DISTINCT why) = 1 THEN min(why) END AS yanked_reason,
  string_agg(filename || '|' || CASE WHEN sdist THEN 'sdist' ELSE '' END || '|' || size || '|' || sha256(filename) || '|' || stamp, ';' ORDER BY filename, yanked, python NULLS FIRST, size, stamp) AS listed FROM files GROUP BY 1),
inv AS (SELECT p_partkey AS p, p_partkey % 7 AS m, {_dnorm('p_partkey')} AS v, 'V' || (p_partkey % 7) || '.' || p_partkey || ['.0', '-RC.1', '.POST2', '_dev3', ''][p_partkey % 5 + 1] AS raw, p_name, p_partkey % 5 IN (1, 3) AS is_prerelease,
  CASE p_partkey % 4 WHEN 0 THEN 'v' || {_dnorm('p_partkey')} WHEN 1 THEN {_dnorm('p_partkey')} WHEN 2 THEN 'release-' || {_dnorm('p_partkey')} END AS git_tag,
  CASE WHEN p_partkey % 4 < 2 THEN lpad(p_partkey::VARCHAR, 40, 'a') WHEN p_partkey % 4 = 2 THEN lpad(p_partkey::VARCHAR, 40, 'c') END AS commit_sha, ['v_prefix', 'exact', 'release_prefix', NULL][p_partkey % 4 + 1] AS match_type FROM part),
o AS (SELECT o_orderkey AS o, o_custkey AS c, quarter(o_orderdate) AS t, o_orderkey % 150 + 1 AS q, o_orderkey % 6 = 0 AS x, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS modified,
  ['GHSA-', 'CVE-2024-', 'PYSEC-2024-', 'OSV-'][o_orderkey % 4 + 1] || o_orderkey AS own, CASE WHEN o_orderkey % 5 > 1 THEN 'Leak of header ' || o_orderkey END AS summary,
  CASE o_orderkey % 3 WHEN 0 THEN trim('redirect to attacker-controlled host ' || repeat('x', (o_orderkey % 7)::INT)) WHEN 1 THEN 'denial of service via cert_none' END AS details, CASE WHEN o_orderstatus = 'F' THEN 'HIGH' END AS severity,
  CASE WHEN o_orderkey % 4 = 0 THEN 'CVSS:3.1/' || o_orderkey END AS vector FROM orders),
o2 AS (SELECT *, list_sort(list_distinct(list_filter([own, 'LINK-' || c || '-' || t, CASE WHEN o % 8 = 0 THEN 'cve-2024-' || o END], lambda i: i IS NOT NULL))) AS ids,
  CASE WHEN o % 2 = 0 THEN ['CWE-200', 'CWE-79'] ELSE []::VARCHAR[] END AS cwe, list_sort(['{_COMMIT_URL}' || upper(lpad(q::VARCHAR, 40, 'a')), CASE WHEN o % 10 = 0 THEN 'ftp://mirror/' || o ELSE 'https://example.org/x' END]) AS refs,
  list_sort(list_filter([lpad(q::VARCHAR, 40, 'a'), CASE WHEN o % 5 = 0 THEN lpad((q + 1)::VARCHAR, 40, 'c') END], lambda s: s IS NOT NULL)) AS commits,
  CASE WHEN x THEN ((q + 14) % 7) || '.' || (q + 14) || '.1.5' ELSE {_dnorm('(q + 14)')} END AS fixed FROM o),
o3 AS (SELECT *, coalesce(list_filter(ids, lambda i: upper(i) LIKE 'GHSA-%')[1], list_filter(ids, lambda i: upper(i) LIKE 'CVE-%')[1], list_filter(ids, lambda i: upper(i) LIKE 'PYSEC-%' OR upper(i) LIKE 'OSV-%')[1], ids[1]) AS own_canonical FROM o2),
cl0 AS (SELECT c, t, count(*) AS n, list_sort(list_distinct(flatten(list(ids)))) AS ids, arg_min(own, o) AS own, arg_min(summary, o) FILTER (summary IS NOT NULL) AS summary, arg_min(severity, o) FILTER (severity IS NOT NULL) AS severity, arg_min(vector, o) FILTER (vector IS NOT NULL) AS vector,
  arg_max(details, length(details) * 1000000000 - o) FILTER (details IS NOT NULL) AS details, min(published) AS published, max(modified) AS modified, list_sort(list_distinct(flatten(list(cwe)))) AS cwe, list_sort(list_distinct(flatten(list(refs)))) AS refs,
  list_sort(list_distinct(flatten(list(commits)))) AS commits, list_sort(list_distinct(list(own_canonical) FILTER (own_canonical LIKE 'GHSA-%'))) AS ghsas, count(DISTINCT own) AS n_sources, arg_min(q, o) AS q0, arg_min(x, o) AS x0, arg_min(fixed, o) AS f0 FROM o3 GROUP BY 1, 2),
cl AS (SELECT *, coalesce(list_filter(ids, lambda i: upper(i) LIKE 'GHSA-%')[1], list_filter(ids, lambda i: upper(i) LIKE 'CVE-%')[1], list_filter(ids, lambda i: upper(i) LIKE 'PYSEC-%' OR upper(i) LIKE 'OSV-%')[1], ids[1]) AS canonical FROM cl0),
fx0 AS (SELECT DISTINCT c, t, (q + 14) % 7 AS m, q + 14 AS p, x, fixed AS v FROM o3),
fx AS (SELECT c, t, list(v ORDER BY m, p, x) AS fixed FROM fx0 GROUP BY 1, 2),
ex0 AS (SELECT DISTINCT c, t, unnest([q, q + 21]) AS p FROM o3 WHERE o % 7 = 0),
ex AS (SELECT c, t, list({_dnorm('p')} ORDER BY p % 7, p) AS listed FROM ex0 GROUP BY 1, 2),
rg AS (SELECT c, t, q, x, min(o) AS first_o, arg_min(fixed, o) AS fixed, list_transform(CASE WHEN x THEN [q, q + 7, q + 14] ELSE [q, q + 7] END, lambda p: {_dnorm('p')}) AS resolved FROM o3 GROUP BY c, t, q, x),
af0 AS (SELECT DISTINCT c, t, unnest(CASE WHEN x THEN [q, q + 7, q + 14] ELSE [q, q + 7] END) AS p FROM rg UNION SELECT c, t, p FROM ex0),
af AS (SELECT c, t, list({_dnorm('p')} ORDER BY p % 7, p) AS affected FROM af0 GROUP BY 1, 2),
adv AS (SELECT cl.*, fx.fixed, af.affected, ex.listed, n_ranges FROM cl JOIN fx USING (c, t) JOIN af USING (c, t) LEFT JOIN ex USING (c, t) JOIN (SELECT c, t, count(*) AS n_ranges FROM rg GROUP BY 1, 2) USING (c, t)),
claims AS (SELECT sha, min(canonical) AS canonical FROM (SELECT canonical, unnest(commits) AS sha FROM cl) GROUP BY 1),
cm AS (SELECT p, fill, lpad(p::VARCHAR, 40, fill) AS sha, CASE WHEN p % 17 = 0 THEN 'commit body is no JSON object' WHEN p % 13 = 0 THEN 'commit repository evil/fork does not match {SLUG}' WHEN p % 19 = 0 THEN 'commit with an unsafe file name' END AS problem FROM (SELECT p_partkey AS p, unnest(['a', 'c']) AS fill FROM part WHERE p_partkey <= {MOST_PART})),
pt0 AS (SELECT cm.*, claims.canonical, adv.fixed AS advisory_fixed, inv.v AS tagged, fx0c.c, fx0c.t FROM cm JOIN claims USING (sha) JOIN cl fx0c ON fx0c.canonical = claims.canonical JOIN adv ON adv.canonical = claims.canonical LEFT JOIN inv ON inv.commit_sha = cm.sha),
ptf AS (SELECT sha, list(v ORDER BY m, p, x) AS fixed FROM (SELECT sha, f.m, f.p, f.x, f.v FROM pt0 JOIN fx0 f ON f.c = pt0.c AND f.t = pt0.t UNION SELECT sha, p % 7, p, false, tagged FROM pt0 WHERE tagged IS NOT NULL) GROUP BY 1),
pt AS (SELECT pt0.sha, pt0.p, canonical, ptf.fixed, ['src/demo/mod_' || (p % 9) || '.py', 'tests/test_' || p || '.py'] AS files, ['K' || (p % 4), 'fn_' || (p % 9), 'test_a'] AS symbols,
  [CASE WHEN p % 2 = 0 THEN 'if cert_reqs == ssl.CERT_NONE:' ELSE 'if redirect url is None:' END, 'raise ValueError'] AS guards FROM pt0 JOIN ptf USING (sha) WHERE problem IS NULL),
lastp AS (SELECT canonical, max(sha) AS sha FROM pt GROUP BY 1),
firstp AS (SELECT canonical, min(sha) AS sha FROM pt GROUP BY 1)"""
