"""Security patterns from advisories and patches, and the retrieval documents made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.ident import stable_record_id
from sentrylake.functions.text import list_section, sorted_set
from sentrylake.operators.evidence import detection_type, ratio, usefulness
from sentrylake.operators.normalise import by_version
from sentrylake.operators.ranking import if_small, is_small
from sentrylake.session import in_slices, materialise, working

_NONE = "CAST(array() AS array<string>)"

#: Fixed values: (pattern, label) of configuration arguments.
ARGUMENTS = [
    (r"(?U)\bCERT_NONE\b", "cert_reqs=ssl.CERT_NONE"),
    (r"(?U)\bcert_reqs\b", "cert_reqs"),
    (r"(?iU)\bredirect\s*=\s*True\b", "redirect=True"),
    (r"(?U)\bfollow_redirects\b", "follow_redirects"),
    (r"(?U)\bassert_hostname\b", "assert_hostname"),
    (r"(?U)\bpreload_content\b", "preload_content"),
]
#: Fixed values: (pattern, source, sink) of data flows.
FLOWS = [
    (r"(?iU)\bredirect\b|\bLocation\b|\blocation header\b", "redirect_location_header", "redirect handler"),
    (r"(?iU)\battacker[- ]controlled\b|\buntrusted\b|\buser[- ]input\b", "untrusted_input", "vulnerable API"),
    (r"(?iU)\bcookie\b|\bCookie header\b", "cookie_header", "proxy destination"),
    (r"(?iU)\brequest body\b|\bHTTP body\b", "request_body", "redirect follow-up request"),
]
#: Fixed values: (phrase in lower-case prose, precondition).
PROSE = [
    ("redirect", "application follows HTTP redirects"),
    ("cert_none", "HTTPS connection uses cert_reqs=ssl.CERT_NONE"),
    ("proxy", "ProxyManager or HTTP(S) proxy in use"),
]
#: Fixed values: (phrases in a lower-case guard, precondition).
GUARD_PRECONDITIONS = [
    (("cert_none",), "create_urllib3_context called with cert_reqs=ssl.CERT_NONE"),
    (("redirect url", "protocol-relative"), "redirect Location header reaches redirect validation"),
    (("_fp is none",), "HTTPResponse.drain_conn called with active body reader"),
]
#: Fixed values: (phrase in a lower-case guard, condition under which nothing is wrong).
GUARD_NEGATIVES = [
    ("_fp is none", "HTTPResponse._fp is None (no body to drain)"),
    ("cert_none is not permitted", "cert_reqs is not ssl.CERT_NONE"),
    ("protocol-relative redirects are not allowed", "redirect URL is not protocol-relative"),
    ("redirect url must not be none", "redirect URL is a non-null string"),
]
#: Patterns of impact.
SSRF, RCE = r"(?iU)\bSSRF\b|server[- ]side request forgery", r"(?iU)\bRCE\b|remote code execution"
EXPOSURE = r"(?iU)\bdata exposure\b|\binformation disclosure\b|\bleak\b"
AVAILABILITY, INTEGRITY = r"(?iU)\bdenial of service\b|\bDoS\b", r"(?iU)\bintegrity\b"
CONFIDENTIALITY = r"(?iU)\bconfidentiality\b|\bdisclosure\b"


def _set(*values: Column) -> Column:
    return sorted_set(F.array(*values))


def _when(test: Column, value) -> Column:
    return F.when(test, value if isinstance(value, Column) else F.lit(value))


def _any(items: Column, *phrases: str) -> Column:
    return F.exists(items, lambda g: reduce(lambda a, b: a | b, (F.contains(F.lower(g), F.lit(p)) for p in phrases)))


def _provenance(*lists: Column) -> Column:
    entries = F.array_distinct(F.concat(*lists))
    order = lambda s: F.struct(s["source_type"], s["source_id"], s["retrieved_at"], s["raw_sha256"], s["extractor_version"])
    return F.array_sort(entries, lambda a, b: F.when(order(a) < order(b), -1).when(order(a) > order(b), 1).otherwise(0))


def linked_patches(patches: DataFrame, last: bool) -> DataFrame:
    """(canonical, patch): the patch of the highest or the lowest commit that names an advisory."""
    rows = patches.select(F.explode("advisory_ids").alias("canonical"), F.struct(*patches.columns).alias("patch"))
    pick = F.max_by if last else F.min_by
    return rows.groupBy("canonical").agg(pick("patch", "patch.commit_sha").alias("patch"))


def security_patterns(advisories: DataFrame, patches: DataFrame, name: str, drop_tests: bool = False) -> DataFrame:
    """One row per advisory: what must be there for it to apply, and how well that is evidenced.

    drop_tests leaves out symbols of test functions, which else count like any other.
    """
    a = advisories.select(F.col("identifiers.canonical").alias("canonical"), F.struct(*advisories.columns).alias("a"))
    rows = a.join(linked_patches(patches, last=True), "canonical", "left")
    of = lambda c: F.coalesce(f"patch.{c}", F.expr(_NONE))
    has = F.col("patch").isNotNull()
    files, names, guards = of("changed_files"), of("changed_symbols"), of("added_guards")
    if drop_tests:
        names = F.filter(names, lambda s: ~s.startswith("test_"))
    path = rf"(?:^|/)(?:src/)?{name}/(.+)\.py$"
    module = lambda f: F.when(f.rlike(path), F.concat(F.lit(name + "."), F.replace(F.regexp_extract(f, path, 1), F.lit("/"), F.lit("."))))
    in_order = F.array_compact(F.transform(files, module))
    texts = F.concat(guards, of("behavioral_differences"), names)
    classes_seen = F.array_sort(F.filter(F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(r"(?U)class\s+([A-Za-z_]\w*)"), 1))), lambda c: c != ""))
    defs_seen = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(r"(?U)def\s+([A-Za-z_]\w*)"), 1)))
    rows = rows.withColumn("modules", in_order).withColumn("owners", classes_seen).withColumn("defs", defs_seen)
    qualify = lambda s: (
        F.when(s.contains("."), s)
        .when((F.size("owners") > 0) & F.array_contains("defs", s), F.concat(F.get("owners", F.lit(0)), F.lit("."), s))
        .when(F.size("modules") > 0, F.concat(F.get("modules", F.lit(0)), F.lit("."), s))
        .otherwise(s)
    )
    rows = rows.withColumn("symbols", sorted_set(F.transform(names, qualify)))
    head = lambda s: F.substring_index(s, ".", 1)
    rows = rows.withColumn("classes", sorted_set(F.transform(F.filter("symbols", lambda s: s.contains(".") & head(s).rlike(r"^\p{Lu}")), head)))
    blank = lambda c: F.coalesce(f"a.{c}", F.lit(""))
    prose = F.concat_ws("\n", blank("summary"), blank("detailed_impact"))
    corpus = F.concat_ws("\n", prose, F.array_join("a.workarounds", "\n"), F.array_join(guards, "\n"), F.array_join(names, "\n"))
    rows = rows.withColumn("prose", prose).withColumn("arguments", _set(*[_when(corpus.rlike(p), label) for p, label in ARGUMENTS]))
    led = F.filter("symbols", lambda s: F.lower(s).contains("redirect") | F.lower(s).contains("location"))
    hit = [F.col("prose").rlike(p) for p, _, _ in FLOWS]
    rows = rows.withColumn("sources", sorted_set(F.array(*[_when(h, s) for h, (_, s, _) in zip(hit, FLOWS)], _when(F.size(led) > 0, "redirect_location_header"))))
    rows = rows.withColumn("sinks", sorted_set(F.concat(F.array(*[_when(h, k) for h, (_, _, k) in zip(hit, FLOWS)]), led)))
    rows = rows.withColumn("flows", sorted_set(F.concat(F.array(*[_when(h, f"{s}->{k}") for h, (_, s, k) in zip(hit, FLOWS)]), F.transform(led, lambda s: F.concat(F.lit("redirect_location_header->"), s)))))
    said = lambda phrase: F.contains(F.lower(blank("summary")), F.lit(phrase)) | F.contains(F.lower(blank("detailed_impact")), F.lit(phrase))
    written = {"cert_none": said("cert_none") | said("cert-none")}
    rows = rows.withColumn(
        "preconditions",
        _set(
            _when(F.size("symbols") > 0, F.concat(F.lit("vulnerable API invoked: "), F.get("symbols", F.lit(0)))),
            *[_when(written.get(p, said(p)), label) for p, label in PROSE],
            *[_when(_any(guards, *p), label) for p, label in GUARD_PRECONDITIONS],
        ),
    )
    negatives = _set(*[_when(_any(guards, p), label) for p, label in GUARD_NEGATIVES], _when(F.array_contains("arguments", "cert_reqs=ssl.CERT_NONE"), "cert_reqs defaults to ssl.CERT_REQUIRED"))
    released = of("fixed_versions")
    fallback = F.when(F.size(released) > 0, F.array(F.concat(F.lit("installed version is at or above fixed release "), F.element_at(released, -1)))).otherwise(F.expr(_NONE))
    rows = rows.withColumn("negatives", F.when(F.size(negatives) > 0, negatives).otherwise(fallback))
    first = F.get("a.affected_ranges", F.lit(0))
    pick = lambda own, other: F.when(F.size(own) > 0, own).otherwise(other)
    ranged = F.size("a.affected_ranges") > 0
    rows = rows.withColumn(
        "range",
        F.struct(
            F.when(ranged, first["events"]).otherwise(F.expr("CAST(array() AS array<struct<fixed:string,introduced:string,last_affected:string,limit:string>>)")).alias("events"),
            by_version(F.when(ranged, pick(first["fixed_versions"], F.col("a.fixed_versions"))).otherwise(F.col("a.fixed_versions"))).alias("fixed_versions"),
            F.when(ranged, first["raw"]).alias("raw"),
            by_version(F.when(ranged, pick(first["resolved"], F.col("a.affected_versions"))).otherwise(F.col("a.affected_versions"))).alias("resolved"),
        ),
    )
    rows = rows.withColumn("fixed", by_version(pick(F.col("range.fixed_versions"), F.col("a.fixed_versions"))))
    upgrade = F.when(F.size("fixed") > 0, F.concat(F.lit("Upgrade to "), F.element_at("fixed", -1), F.lit(" or later.")))
    judged = F.concat_ws("\n", F.col("prose"), F.array_join("a.cwe", "\n"))
    notes = _set(F.nullif(blank("summary"), F.lit("")), F.nullif(blank("detailed_impact"), F.lit("")))
    notes = F.when((F.size(notes) == 0) & (F.coalesce("a.severity", F.lit("")) != ""), F.array(F.concat(F.lit("severity: "), "a.severity"))).otherwise(notes)
    tests = F.transform(of("regression_tests"), lambda t: F.struct(F.lit("regression_test").alias("evidence_type"), F.lit(None).cast("string").alias("notes"), t.alias("reference"), t.alias("source_id")))
    commit = F.array(F.struct(F.lit("commit").alias("evidence_type"), F.lit("patch diff symbols and guards").alias("notes"), F.col("patch.repository_url").alias("reference"), F.col("patch.commit_sha").alias("source_id")))
    score = usefulness(
        (F.size("range.events") > 0) | (F.size("range.resolved") > 0) | (F.coalesce("range.raw", F.lit("")) != ""), F.size("range.fixed_versions") > 0, F.size("symbols") > 0, F.size("preconditions") > 0,
        F.size("arguments") > 0, F.size("negatives") > 0, (F.size("fixed") > 0) | (F.size("a.workarounds") > 0), has,
    )
    unsupported = lambda note: F.lit("unsupported inference: " + note)
    rationale = sorted_set(
        F.concat(
            "a.confidence.rationale",
            F.array(
                _when(has, "patch diff evidence linked"),
                _when(~has, unsupported("patch evidence unavailable; API usage inferred from advisory text only")),
                unsupported("changelog text not supplied"),
                F.when(F.size("symbols") > 0, F.lit("vulnerable symbols extracted from patch paths")).otherwise(unsupported("no vulnerable symbol extracted from patch evidence")),
                _when((F.size("a.affected_ranges") == 0) & (F.size("a.affected_versions") == 0), unsupported("affected version range absent on advisory; not inferred")),
            ),
        )
    )
    sure = F.round(F.least(F.lit(1.0), F.col("a.confidence.score") + F.when(has, 0.05).otherwise(0.0)), 4)
    sequence = F.when(F.size("classes") > 0, F.array(F.get("classes", F.lit(0)), F.substring_index(F.get("symbols", F.lit(0)), ".", -1))).otherwise(F.expr(_NONE))
    reported = lambda pattern, what: _when(judged.rlike(pattern), f"source-reported {what} impact").alias(what)
    flag = lambda pattern, what: _when(judged.rlike(pattern), True).alias(what)
    return rows.select(
        F.struct(F.array_sort(F.array_append(rationale, F.format_string("sast_usefulness_score=%.4f", score))).alias("rationale"), sure.alias("score")).alias("confidence"),
        F.col("a.cvss").alias("cvss"), F.col("a.cwe").alias("cwe"), detection_type(F.size("symbols") > 0, F.size("arguments") > 0, (F.size("flows") > 0) | (F.size("sources") > 0)).alias("detection_type"),
        F.col("a.identifiers").alias("identifiers"),
        F.struct(reported(AVAILABILITY, "availability"), reported(CONFIDENTIALITY, "confidentiality"), flag(EXPOSURE, "data_exposure"), reported(INTEGRITY, "integrity"), notes.alias("notes"), flag(RCE, "rce"), flag(SSRF, "ssrf")).alias("impact"),
        F.col("negatives").alias("negative_conditions"), F.col("a.package").alias("package"),
        F.when(has, commit).otherwise(F.slice(commit, 1, 0)).alias("patch_evidence"),
        F.when(has, _provenance(F.col("a.provenance"), F.col("patch.provenance"))).otherwise(_provenance(F.col("a.provenance"))).alias("provenance"),
        stable_record_id("security_pattern", canonical=F.col("canonical"), package=F.col("a.package.name"), ecosystem=F.col("a.package.ecosystem")).alias("record_id"),
        F.lit("security_pattern").alias("record_type"),
        F.struct(F.col("fixed").alias("fixed_versions"), F.expr(_NONE).alias("safe_alternatives"), upgrade.alias("upgrade_guidance"), sorted_set(F.col("a.workarounds")).alias("workarounds")).alias("remediation"),
        F.lit("1.0").alias("schema_version"), F.col("a.severity").alias("severity"), F.array_sort(tests).alias("test_evidence"), F.col("range").alias("version_range"),
        F.struct(sequence.alias("api_sequence"), F.col("arguments"), F.col("classes"), sorted_set(F.col("modules")).alias("modules"), F.col("preconditions"), F.col("flows").alias("required_dataflow"), F.col("sinks"), F.col("sources"), F.col("symbols")).alias("vulnerable_usage"),
        score.alias("usefulness"),
    )


#: Fixed values: (topic, title, document type), in the order of a pattern's documents.
TOPICS = (
    ("vulnerability_overview", "Vulnerability overview", "advisory"),
    ("detection_guidance", "Detection guidance", "security_pattern"),
    ("negative_conditions", "Negative conditions", "security_pattern"),
    ("remediation_guidance", "Remediation guidance", "security_pattern"),
    ("patch_evidence", "Patch evidence", "patch"),
)
#: The sentences that close the documents.
CLOSING = {
    "vulnerability_overview": "Evidence-backed overview derived from normalized advisory and pattern records.",
    "detection_guidance": "Use version, symbol, and precondition filters together; do not flag on version exposure alone when detection type requires API usage.",
    "negative_conditions": "When a negative condition applies, downgrade or reject a vulnerable verdict even if the installed version is inside the affected range.",
    "remediation_guidance": "Prefer upgrading to a listed fixed release; workarounds are secondary and must be validated against project constraints.",
    "patch_evidence": "Patch and test pointers support implementation-level SAST checks.",
}
MOST_BYTES = 32 * 1024


def _document(topic: str, title: str, blocks: list[Column]) -> Column:
    """A heading, the blocks that are there, a closing sentence; blocks are a blank line apart."""
    heading = F.concat(F.lit(f"# {title}: "), F.col("canonical"))
    return F.array_join(F.array_compact(F.array(heading, *blocks, F.lit(CLOSING[topic]))), "\n\n")


def _titled(title: str, body: Column) -> Column:
    return F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(title + "\n"), body))


def _listed(title: str, items: Column) -> Column:
    return F.when(F.size(items) > 0, list_section(F.lit(title), items))


def _bullets(*lines: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def made_documents(patterns: DataFrame, advisories: DataFrame, patches: DataFrame) -> DataFrame:
    """Five retrieval documents per pattern; the patch topic only where there is evidence.

    A document over MOST_BYTES is an error.
    """
    p = patterns.select(F.col("identifiers.canonical").alias("canonical"), F.struct(*patterns.columns).alias("p"))
    a = advisories.select(F.col("identifiers.canonical").alias("canonical"), F.struct("summary", "detailed_impact", "record_id", "provenance").alias("a"))
    rows = p.join(a, "canonical", "left").join(linked_patches(patches, last=False), "canonical", "left")
    use, impact, has = F.col("p.vulnerable_usage"), F.col("p.impact"), F.col("patch").isNotNull()
    listed = lambda c: F.nullif(F.array_join(c, ", "), F.lit(""))
    line = lambda label, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"- {label}: "), value))
    evidence = lambda title, items: F.when(F.size(items) > 0, F.concat(F.lit(title + "\n"), F.array_join(F.transform(items, lambda e: F.concat(F.lit("- "), e["evidence_type"], F.lit(": "), e["source_id"], F.lit(" ("), F.coalesce(e["reference"], F.lit("(no reference)")), F.lit(")"))), "\n")))
    blocks = {
        "vulnerability_overview": [
            _titled("## Summary", F.coalesce(F.nullif("a.summary", F.lit("")), F.get(impact["notes"], F.lit(0)))),
            _titled("## Impact", F.col("a.detailed_impact")),
            _titled("## Structured impact", _bullets(line("Confidentiality", impact["confidentiality"]), line("Integrity", impact["integrity"]), line("Availability", impact["availability"]), _when(impact["ssrf"], "- SSRF: reported"), _when(impact["rce"], "- RCE: reported"), _when(impact["data_exposure"], "- Data exposure: reported"))),
            _titled("## CWE", listed(F.col("p.cwe"))),
            _titled("## Affected range (source)", F.col("p.version_range.raw")),
            _titled("## Fixed versions", listed(F.col("p.version_range.fixed_versions"))),
        ],
        "detection_guidance": [
            F.concat(F.lit("Detection type: "), "p.detection_type"),
            _listed("## Vulnerable symbols", use["symbols"]),
            F.when((F.size(use["modules"]) > 0) | (F.size(use["classes"]) > 0), F.concat(F.lit("## API surface\n- Modules: "), F.coalesce(listed(use["modules"]), F.lit("(none)")), F.lit("\n- Classes: "), F.coalesce(listed(use["classes"]), F.lit("(none)")))),
            *[_listed(f"## {title}", use[c]) for title, c in (("Dangerous arguments", "arguments"), ("Required API sequence", "api_sequence"), ("Required preconditions", "preconditions"), ("Required data-flow", "required_dataflow"), ("Data sources", "sources"), ("Data sinks", "sinks"))],
        ],
        "negative_conditions": [list_section(F.lit("## Safe or not-affected conditions"), F.col("p.negative_conditions"))],
        "remediation_guidance": [
            _titled("## Fixed versions", listed(F.col("p.remediation.fixed_versions"))),
            _titled("## Upgrade guidance", F.col("p.remediation.upgrade_guidance")),
            _listed("## Workarounds", F.col("p.remediation.workarounds")),
            _listed("## Safe alternatives", F.col("p.remediation.safe_alternatives")),
        ],
        "patch_evidence": [
            F.when(has, F.concat(F.lit("## Commit\n- SHA: "), "patch.commit_sha", F.lit("\n- Repository: "), F.coalesce("patch.repository_url", F.lit("(not recorded)")))),
            *[_listed(f"## {title}", F.col(f"patch.{c}")) for title, c in (("Changed files", "changed_files"), ("Changed symbols", "changed_symbols"), ("Added guards", "added_guards"), ("Behavioral differences", "behavioral_differences"), ("Regression tests", "regression_tests"))],
            evidence("## Linked patch evidence", F.col("p.patch_evidence")),
            evidence("## Linked test evidence", F.col("p.test_evidence")),
        ],
    }
    evidenced = has | (F.size("p.patch_evidence") > 0) | (F.size("p.test_evidence") > 0)
    made = []
    for topic, title, kind in TOPICS:
        extra = {"vulnerability_overview": "a.record_id", "patch_evidence": "patch.record_id"}.get(topic)
        sources = sorted_set(F.array("p.record_id", F.col(extra) if extra else F.lit(None)))
        body = F.struct(F.lit(topic).alias("topic"), F.concat(F.lit(f"{title}: "), "canonical").alias("title"), F.lit(kind).alias("document_type"), _document(topic, title, blocks[topic]).alias("content"), sources.alias("sources"))
        made.append(F.when(evidenced, body) if topic == "patch_evidence" else body)
    ids = sorted_set(F.array_append("p.identifiers.aliases", F.col("canonical")))
    fixed = F.when(F.size("p.version_range.fixed_versions") > 0, F.col("p.version_range.fixed_versions")).otherwise(F.col("p.remediation.fixed_versions"))
    metadata = F.struct(ids.alias("advisory_ids"), F.col("p.version_range.resolved").alias("affected_versions"), F.col("p.confidence").alias("confidence"), F.col("p.detection_type").alias("detection_type"), fixed.alias("fixed_versions"), F.col("p.package.name").alias("package_name"), use["symbols"].alias("symbols"))
    empty = F.slice("p.provenance", 1, 0)
    sources = _provenance(F.col("p.provenance"), F.coalesce("a.provenance", empty), F.coalesce("patch.provenance", empty))
    docs = rows.select("p.package", F.col("p.record_id").alias("pattern_id"), metadata.alias("metadata"), sources.alias("provenance"), F.explode(F.array_compact(F.array(*made))).alias("d"))
    bounded = F.when(F.octet_length("d.content") > MOST_BYTES, F.raise_error(F.lit(f"document content exceeds {MOST_BYTES} bytes"))).otherwise(F.col("d.content"))
    return docs.select(
        bounded.alias("content"), F.col("d.document_type").alias("document_type"), "metadata", "package", "provenance",
        stable_record_id("kb_document", source_record_id=F.col("pattern_id"), topic=F.col("d.topic")).alias("record_id"), F.lit("kb_document").alias("record_type"),
        F.lit("1.0").alias("schema_version"), F.col("d.sources").alias("source_record_ids"), F.col("d.title").alias("title"),
    )


def keep_first_content(documents: DataFrame) -> DataFrame:
    """Of documents with equal content the first by (least advisory id, title, record id).

    Contents are compared by SHA-256, but only those that share a 64-bit hash with another; copies are combined
    before the shuffle. Only the ids of what goes are sent to the documents, which stay where they are; where
    those ids are many, the rest is written.
    """
    place = F.struct(F.col("metadata.advisory_ids")[0].alias("advisory"), "title", "record_id")
    keys = documents.select(F.xxhash64(F.coalesce("content", F.lit(""))).alias("x"), F.coalesce(F.sha2("content", 256), F.lit("")).alias("h"), place.alias("place"))
    with working(documents.sparkSession, "copies"):
        alike = in_slices(documents.sparkSession, 1, "alike", lambda part: keys.groupBy("x").count().where("count > 1").select("x"))
        keys = keys.join(if_small(alike), "x", "left_semi")
        again = keys.groupBy("h").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        again = materialise(again, "repeated")
        copies = materialise(keys.join(if_small(again), "h").where(F.col("place") > F.col("first")).select(F.col("place.record_id").alias("copy")), "copies")
    few = is_small(copies)
    kept = documents.join(F.broadcast(copies) if few else copies, F.col("record_id") == F.col("copy"), "left_anti")
    return kept if few else materialise(kept, "documents")


def document_statistics(made: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: documents attempted, written, skipped as duplicates, and the duplicates' share (0.0 of none)."""
    row = made.agg(F.count("*").alias("documents_attempted")).crossJoin(kept.agg(F.count("*").alias("documents_written")))
    row = row.withColumn("duplicates_skipped", F.col("documents_attempted") - F.col("documents_written"))
    return row.withColumn("duplicate_rate", ratio(F.col("duplicates_skipped"), F.col("documents_attempted"), 0.0))
