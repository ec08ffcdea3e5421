"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentrylake.llm import (
    decontamination,
    exact_dedup,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    quality,
    sharding,
    substring_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licence_report(_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents"))


#: A-Z in lower case, other letters unchanged.
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT % {line_dedup.MODULUS} AS h FROM l),
r AS (SELECT *, (lag(h) OVER w * {line_dedup.BASE} + h) % {line_dedup.MODULUS} % {line_dedup.EVERY} AS r FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT r.*, cut, coalesce(sum(CASE WHEN r = cut THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, cut ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM r, generate_series(0, {line_dedup.EVERY - 1}) AS cuts(cut)),
chunks AS (SELECT DISTINCT doc_id, start, n, chunk FROM (SELECT doc_id, cut, c, min(i) AS start, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM c GROUP BY ALL)),
marked AS (SELECT *, n > 1 AND regexp_matches(chunk, '[^\\s\\x0B]') AND row_number() OVER (PARTITION BY n > 1, chunk ORDER BY doc_id, start) > 1 AS gone FROM chunks),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(start, start + n - 1)) AS i FROM marked WHERE gone),
counts AS (SELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY 1),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed_lines,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '')) AS kept_sha256 FROM l LEFT JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_chunks, 0)::BIGINT AS n_chunks, coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM rep),
word AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS t, count(gone.p) AS n_removed FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '{_BENCH_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_ASCII_LOWER}, '{_BENCH_WORD}') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM bw),
sizes AS (SELECT DISTINCT n FROM pat),
dw AS (SELECT doc_id, sizes.n, w, unnest(generate_series(1, len(w) - sizes.n + 1)) AS i FROM d, sizes WHERE len(w) >= sizes.n),
hits AS (SELECT doc_id, i, dw.n, item_id FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM dw) dw JOIN pat USING (n, p)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def _op4_sql() -> str:
    """Sentences matched one by one in SQL; the rules are walked over (position, identifier) rows, a gap where a position is missing."""
    case = " ".join(f"WHEN regexp_full_match(n, '{pattern}') THEN '{name}'" for name, pattern in license_scan.SENTENCES + tuple((license_scan._FILLER, x) for x in license_scan.FILLERS))
    known = ", ".join(f"('{text}', '{name}')" for text, name in sorted(license_scan.DICTIONARY.items()))
    values = ", ".join(f"({k}, '{name}', '{kind}', [{', '.join(repr(x) for x in seq)}])" for k, (name, kind, seq) in enumerate(license_scan.RULES))
    dot = "regexp_replace(regexp_replace(lower(s), '([0-9])\\.([0-9])', '\\1\x01\\2', 'g'), '([0-9])\\.([0-9])', '\\1\x01\\2', 'g')"
    return rf"""
WITH cut AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?;])[\s\x0B]+', '\1' || chr(10), 'g'), '[\n\r]+'), lambda x: trim(x) <> '') AS l FROM documents),
sent AS (SELECT doc_id, unnest(l) AS s, unnest(generate_series(1, len(l))) AS i FROM cut),
norm AS (SELECT doc_id, i, trim(regexp_replace(replace(replace({dot}, '.', ' '), chr(1), '.'), '[^\p{{L}}\p{{N}}.]+', ' ', 'g')) AS n FROM sent WHERE regexp_matches(s, '{license_scan.TRIGGER}')),
known(n, id) AS (VALUES {known}),
told AS (SELECT doc_id, i, coalesce(known.id, CASE {case} END) AS id FROM norm LEFT JOIN known USING (n)),
ids AS (SELECT * FROM (SELECT doc_id, i, id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM sent LEFT JOIN told USING (doc_id, i) WHERE id IS DISTINCT FROM '{license_scan._FILLER}' AND regexp_matches(s, '[\p{{L}}\p{{N}}]')) WHERE id IS NOT NULL),
seqs AS (SELECT doc_id, list(id ORDER BY i) AS q, list(pos ORDER BY i) AS ps FROM ids GROUP BY doc_id),
rules(k, name, kind, seq) AS (VALUES {values}),
long_hits AS (SELECT doc_id, k, name, kind, p, len(seq) AS n FROM (SELECT doc_id, q, ps, unnest(generate_series(1, len(q))) AS p FROM seqs) JOIN rules ON len(seq) > 1 AND list_slice(q, p, p + len(seq) - 1) = seq AND ps[p + len(seq) - 1] - ps[p] = len(seq) - 1),
long_used AS (SELECT * FROM long_hits h WHERE NOT EXISTS (SELECT 1 FROM long_hits g WHERE g.doc_id = h.doc_id AND g.k < h.k AND g.p < h.p + h.n AND h.p < g.p + g.n)),
free AS (SELECT doc_id, q[p] AS id FROM (SELECT doc_id, q, unnest(generate_series(1, len(q))) AS p FROM seqs) x WHERE NOT EXISTS (SELECT 1 FROM long_used u WHERE u.doc_id = x.doc_id AND x.p BETWEEN u.p AND u.p + u.n - 1)),
hits AS (SELECT doc_id, k, name, kind FROM long_used UNION SELECT doc_id, k, name, kind FROM free JOIN rules ON len(seq) = 1 AND seq[1] = id),
named AS (SELECT doc_id, string_agg(name, ',' ORDER BY k) AS licences FROM (SELECT doc_id, name, min(k) AS k FROM hits GROUP BY ALL) GROUP BY 1),
kinds AS (SELECT doc_id, string_agg(DISTINCT kind, ',' ORDER BY kind) AS categories, bool_or(kind = 'restricted') AS restricted FROM hits GROUP BY 1)
SELECT doc_id, len(l)::BIGINT AS n_sentences, coalesce(len(q), 0)::BIGINT AS n_matched, coalesce(array_to_string(q, ','), '') AS sentence_ids,
  coalesce(licences, '') AS licences, coalesce(categories, '') AS categories, coalesce(restricted, false) AS restricted
FROM cut LEFT JOIN seqs USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN kinds USING (doc_id)
"""


OP8_SQL = f"""
WITH t AS (SELECT doc_id, {_ASCII_LOWER} AS text FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
FROM t WINDOW g AS (PARTITION BY text)
"""

QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_sharding": op5_sharding,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_near_dedup": op10_near_dedup,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op4_license_scan": _op4_sql(),
    "op6_decontamination": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
}
