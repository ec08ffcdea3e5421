"""``python -m sentrylake VERB``: the engine's stages over a landing folder, and queries of what it made.

Exit codes: 0 done, 1 findings in strict mode, input that does not fit or a stage that failed, 2 wrong usage.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from sentrylake import settings as config
from sentrylake.plans import knowledge
from sentrylake.session import build_session, materialise
from sentrylake.sources import fetch

STAGES = ("crawl", "normalize", "enrich", "validate", "build-kb", "stats", "run")


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sentrylake")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name in STAGES:
        verb = verbs.add_parser(name)
        verb.add_argument("--config", required=True, help="YAML or JSON settings")
        verb.add_argument("--output", help="folder instead of the settings' output.directory")
        verb.add_argument("--offline", action="store_true", help="nothing is fetched but from --fixture-dir")
        verb.add_argument("--fixture-dir", help="answers from files; routes.json there maps URL patterns to names")
        if name == "validate":
            verb.add_argument("--strict", action="store_true")
        if name == "run":
            verb.add_argument("--skip-crawl", action="store_true")
    ask = verbs.add_parser("query")
    ask.add_argument("--package", required=True)
    ask.add_argument("--version", required=True)
    ask.add_argument("--symbol")
    ask.add_argument("--config")
    ask.add_argument("--output")
    ask.add_argument("--compat", action="store_true", help="compare versions as texts, read the first event only")
    return parser.parse_args(argv)


def fetcher(options: argparse.Namespace, settings: config.Settings, folder: str) -> fetch.Fetcher | None:
    """None where nothing may be fetched."""
    offline = options.offline or os.environ.get("CRAWLER_OFFLINE") in ("1", "true")
    if options.fixture_dir:
        with open(os.path.join(options.fixture_dir, "routes.json"), encoding="utf-8") as file:
            transport = fetch.from_folder(options.fixture_dir, json.load(file))
    elif offline:
        return None
    else:
        transport = fetch.over_network
    return fetch.Fetcher(os.path.join(folder, "raw"), transport, settings.crawl, os.environ.get("GITHUB_TOKEN") or None)


def crawl(spark, settings: config.Settings, client: fetch.Fetcher) -> None:
    """Lands all sources, then the commits that the landed advisories name."""
    for what, problem in fetch.crawl(client, settings):
        print(f"{what}: {problem or 'landed'}", file=sys.stderr)
    if settings.sources.osv and settings.sources.patches:
        package = settings.package
        for row in knowledge.commit_refs(spark, client.folder, package.name, package.ecosystem).toLocalIterator():
            try:
                client.commit(package.repository, row.sha)
            except fetch.FetchError as problem:
                print(f"commit {row.sha}: {problem}", file=sys.stderr)


def stage(options: argparse.Namespace) -> int:
    settings = config.load(options.config)
    package, folder = settings.package, options.output or settings.output.directory
    client = fetcher(options, settings, folder)
    spark = build_session()
    if options.verb == "crawl" or (options.verb == "run" and not options.skip_crawl and client is not None):
        if client is None:
            raise fetch.FetchError("offline, and no fixture folder")
        crawl(spark, settings, client)
    if options.verb == "crawl":
        return 0
    bundle = knowledge.build(spark, os.path.join(folder, "raw"), package.name, package.repository, package.ecosystem)
    whole = options.verb == "run"
    if whole or options.verb == "normalize":
        knowledge.export_records(bundle, folder, "normalized/versions", "normalized/advisories")
    if whole or options.verb == "enrich":
        knowledge.export_records(bundle, folder, "normalized/patches", "normalized/security_patterns")
    if (whole and settings.output.include_kb_documents) or options.verb == "build-kb":
        knowledge.export_records(bundle, folder, "kb/")
    if whole or options.verb in ("validate", "stats"):
        found = materialise(knowledge.findings(bundle, package.name, package.ecosystem), "findings")
        if whole or options.verb == "validate":
            knowledge.export_findings(found, folder)
            if getattr(options, "strict", False):
                knowledge.require_clean(found)
        if whole or options.verb == "stats":
            knowledge.export_statistics(bundle, found, folder)
            knowledge.export_manifest(spark, folder)
    return 0


def ask(options: argparse.Namespace) -> int:
    folder = options.output or (config.load(options.config).output.directory if options.config else "data")
    spark = build_session()
    found = knowledge.read_patterns(spark, os.path.join(folder, "normalized/security_patterns.jsonl"))
    print(knowledge.rendered(knowledge.query(found, options.package, options.version, options.symbol, options.compat)), end="")
    return 0


def main(argv: list[str] | None = None) -> int:
    options = arguments(argv)
    try:
        config.load_env()
        return ask(options) if options.verb == "query" else stage(options)
    except (ValueError, OSError, fetch.FetchError) as problem:
        print(f"{options.verb} failed: {problem}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
