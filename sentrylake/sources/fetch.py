"""Fetching into the landing folder: one bounded request at a time on the driver, ahead of the engine.

The engine itself reads landed bytes only. What has landed is not asked for again. A transport is any
function (method, url, headers, body, timeout) -> (status, headers, chunks), so runs without a network
take ``from_folder``.
"""

from __future__ import annotations

import hashlib
import json
import logging
import os
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from urllib.parse import parse_qsl, quote, urlencode, urlsplit

from sentrylake.functions.ident import LONGEST_URL, SECRET_KEYS
from sentrylake.sources.files import write_atomically
from sentrylake.settings import Crawl
from sentrylake.sources.landing import KEPT_HEADERS, TRANSIENT

_LOG = logging.getLogger(__name__)

Transport = Callable[[str, str, dict[str, str], bytes | None, float], tuple[int, dict[str, str], Iterable[bytes]]]

#: The only host that is shown the token.
TOKEN_HOST = "api.github.com"
#: Characters of a header's name, of its value and of all headers of a request, at most.
MOST_HEADER = (256, 4_096, 16_384)
#: Headers that callers may not set.
_SECRET_HEADERS = ("authorization", "cookie", "proxy-authorization", "set-cookie")


class FetchError(RuntimeError):
    """A request that is refused, or an answer that is no use."""


def identity(method: str, url: str, body: bytes | None = None) -> dict[str, str | None]:
    """method, url, body_sha256 and key; the key equals ``ident.request_key``."""
    method = method.strip().upper()
    parts = urlsplit(url)
    if not re.fullmatch("[A-Z]{1,16}", method) or len(url) > LONGEST_URL or parts.scheme != "https" or not parts.hostname or "@" in parts.netloc:
        raise FetchError("only https requests without a user are made")
    pairs = sorted(parse_qsl(parts.query, keep_blank_values=True))
    if any(re.sub("[^a-z0-9]", "", k.lower()) in SECRET_KEYS for k, _ in pairs):
        raise FetchError("credentials do not belong in a query")
    plain = parts._replace(query=urlencode(pairs), fragment="").geturl()
    digest = None if body is None else hashlib.sha256(body).hexdigest()
    named = {"body_sha256": digest, "method": method, "url": plain}
    key = hashlib.sha256(json.dumps(named, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()).hexdigest()
    return named | {"key": key}


def over_network(method: str, url: str, headers: dict[str, str], body: bytes | None, timeout: float) -> tuple[int, dict[str, str], Iterable[bytes]]:
    """The standard library's client, without redirects."""

    class Stay(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, *_):
            return None

    request = urllib.request.Request(url, data=body, headers=headers, method=method)
    try:
        answer = urllib.request.build_opener(Stay).open(request, timeout=timeout)
    except urllib.error.HTTPError as refused:
        answer = refused
    return answer.status, dict(answer.headers.items()), iter(lambda: answer.read(1 << 16), b"")


def from_folder(folder: str, routes: dict[str, str]) -> Transport:
    """Answers from files: the first pattern found in the URL names the file; others are not found."""

    def answer(method, url, headers, body, timeout):
        for pattern, name in routes.items():
            if re.search(pattern, url):
                with open(os.path.join(folder, name), "rb") as file:
                    kind = "application/json" if name.endswith(".json") else "text/plain"
                    return 200, {"Content-Type": kind}, [file.read()]
        return 404, {}, []

    return answer


@dataclass
class Fetcher:
    folder: str
    transport: Transport = over_network
    limits: Crawl = field(default_factory=Crawl)
    token: str | None = None
    sleep: Callable[[float], None] = time.sleep
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc)

    def __post_init__(self) -> None:
        if self.token is not None and not re.fullmatch(r"\S+", self.token):
            raise FetchError("the token is malformed")

    def _paths(self, key: str) -> tuple[str, str]:
        stem = os.path.join(self.folder, key[:2], key)
        return stem + ".body", stem + ".json"

    def landed(self, key: str) -> tuple[bytes, dict] | None:
        """A landed pair; None if there is none, an error if it is half there or does not fit its record."""
        files = self._paths(key)
        there = [os.path.isfile(f) and not os.path.islink(f) for f in files]
        if not any(there):
            return None
        if not all(there):
            raise FetchError(f"half of the pair {key} is missing")
        with open(files[0], "rb") as body, open(files[1], "rb") as card:
            content, record = body.read(self.limits.max_response_bytes + 1), json.loads(card.read())
        answer = record["response"]
        if answer["body_size"] != len(content) or answer["body_sha256"] != hashlib.sha256(content).hexdigest():
            raise FetchError(f"the pair {key} is corrupt")
        return content, record

    def land(self, named: dict, status: int, headers: dict[str, str], content: bytes) -> dict:
        """Writes a pair, the body first; returns its record."""
        kept = {k.lower(): v[:2048] for k, v in headers.items() if k.lower() in KEPT_HEADERS}
        answer = {
            "body_sha256": hashlib.sha256(content).hexdigest(), "body_size": len(content), "content_type": kept.get("content-type", ""),
            "headers": kept, "retrieved_at": self.now().astimezone(timezone.utc).isoformat().replace("+00:00", "Z"), "status_code": status,
        }
        record = {"request": {k: named[k] for k in ("body_sha256", "method", "url")}, "response": answer}
        body, card = self._paths(named["key"])
        write_atomically(content, body)
        write_atomically((json.dumps(record, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode(), card)
        return record

    def _wait(self, status: int, headers: dict[str, str], host: str, attempt: int) -> float | None:
        """Seconds until the next attempt, None if there is to be none."""
        limited = status == 403 and host == TOKEN_HOST and headers.get("x-ratelimit-remaining") == "0"
        if (status not in TRANSIENT and not limited) or attempt > self.limits.max_retries:
            return None
        asked, now = None, self.now().timestamp()
        if self.limits.respect_rate_limits:
            after, reset = headers.get("retry-after"), headers.get("x-ratelimit-reset")
            try:
                if after is not None:
                    asked = float(int(after)) if re.fullmatch(r"\s*[+-]?\d+\s*", after) else max(0.0, parsedate_to_datetime(after).timestamp() - now)
                    asked = asked if asked >= 0 else None
            except (TypeError, ValueError):
                asked = None
            if asked is None and limited and reset and reset.strip().isdigit():
                asked = max(0.0, int(reset) - now)
        if asked is not None and asked > self.limits.max_retry_delay_seconds:
            raise FetchError("the provider asks for a longer wait than is allowed")
        return max(self._backoff(attempt), asked or 0.0)

    def _pause(self, named: dict, host: str | None, attempt: int, delay: float, reason: str) -> None:
        _LOG.warning("asking again: request=%s host=%s attempt=%d delay_seconds=%.3f reason=%s", named["key"][:12], host, attempt, delay, reason)
        self.sleep(delay)

    def _backoff(self, attempt: int) -> float:
        return min(self.limits.initial_backoff_seconds * 2.0 ** max(0, attempt - 1), self.limits.max_retry_delay_seconds)

    def _bounded(self, chunks: Iterable[bytes]) -> bytes:
        content = bytearray()
        for chunk in chunks:
            content += chunk
            if len(content) > self.limits.max_response_bytes:
                raise FetchError("the answer is larger than allowed")
        return bytes(content)

    def fetch(self, method: str, url: str, body: bytes | None = None, **headers: str) -> tuple[bytes, dict]:
        """(content, record) of a request, landed before or now. Answers that may pass are asked for again."""
        named = identity(method, url, body)
        if self.limits.cache_enabled and (known := self.landed(named["key"])):
            return known
        sent = {k.replace("_", "-"): v for k, v in headers.items()}
        if any(k.strip().lower() in _SECRET_HEADERS or re.search(r"[\r\n]", k + v) for k, v in sent.items()):
            raise FetchError("that header may not be sent")
        if any(len(k) > MOST_HEADER[0] or len(v) > MOST_HEADER[1] for k, v in sent.items()) or sum(len(k) + len(v) for k, v in sent.items()) > MOST_HEADER[2]:
            raise FetchError("the headers are longer than allowed")
        host = urlsplit(named["url"]).hostname
        if self.token and host == TOKEN_HOST:
            sent["Authorization"] = f"Bearer {self.token}"
        for attempt in range(1, self.limits.max_retries + 2):
            try:
                status, got, chunks = self.transport(named["method"], named["url"], sent, body, self.limits.timeout_seconds)
                content = self._bounded(chunks)
            except OSError as broken:
                if attempt > self.limits.max_retries:
                    raise FetchError(f"no answer after {attempt} attempts") from broken
                self._pause(named, host, attempt, self._backoff(attempt), "no answer")
                continue
            wait = self._wait(status, {k.lower(): v for k, v in got.items()}, host, attempt)
            if wait is None:
                break
            self._pause(named, host, attempt, wait, f"status {status}")
        record = self.land(named, status, got, content) if status == 200 else {"response": {"status_code": status}}
        return content, record

    def json(self, method: str, url: str, body: bytes | None = None, **headers: str) -> tuple[bytes, dict]:
        content, record = self.fetch(method, url, body, **headers)
        answer = record["response"]
        if answer["status_code"] != 200:
            raise FetchError(f"{url} answered {answer['status_code']}")
        if not re.match(r"application/(?:[\w.]+\+)?json\s*(?:;|$)", answer["content_type"] or "", re.I):
            raise FetchError(f"{url} is not JSON")
        return content, record

    def project(self, name: str) -> tuple[bytes, dict]:
        if not re.fullmatch(r"[A-Za-z0-9](?:[A-Za-z0-9._-]*[A-Za-z0-9])?", name):
            raise FetchError("not a project name")
        return self.json("GET", f"https://pypi.org/pypi/{re.sub('[-_.]+', '-', name).lower()}/json", Accept="application/json")

    def _hub(self, slug: str, rest: str) -> tuple[bytes, dict]:
        return self.json("GET", f"https://{TOKEN_HOST}/repos/{_slug(slug)}/{rest}", Accept="application/vnd.github+json")

    def releases(self, slug: str) -> tuple[bytes, dict]:
        return self._hub(slug, "releases?per_page=100")

    def tags(self, slug: str) -> tuple[bytes, dict]:
        return self._hub(slug, "tags?per_page=100")

    def commit(self, slug: str, sha: str) -> tuple[bytes, dict]:
        sha = sha.strip().lower()
        if not re.fullmatch("[0-9a-f]{40}|[0-9a-f]{64}", sha):
            raise FetchError("not a commit hash")
        return self._hub(slug, f"commits/{sha}")

    def file(self, slug: str, path: str, ref: str = "main") -> tuple[bytes, dict]:
        if not path or ".." in path or "\0" in path or not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._/-]*", ref):
            raise FetchError("not a safe path")
        content, record = self.fetch("GET", f"https://raw.githubusercontent.com/{_slug(slug)}/{ref}/{quote(path)}")
        if record["response"]["status_code"] != 200:
            raise FetchError(f"{path} answered {record['response']['status_code']}")
        return content, record

    def advisories(self, name: str, ecosystem: str = "PyPI") -> tuple[bytes, dict]:
        if not name or not ecosystem:
            raise FetchError("a package and an ecosystem are needed")
        body = json.dumps({"package": {"ecosystem": ecosystem, "name": name}}, sort_keys=True).encode()
        return self.json("POST", "https://api.osv.dev/v1/query", body, Accept="application/json", Content_Type="application/json")

    def advisory(self, key: str) -> tuple[bytes, dict]:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._:-]*", key):
            raise FetchError("not an advisory id")
        return self.json("GET", f"https://api.osv.dev/v1/vulns/{quote(key, safe='')}", Accept="application/json")


def _slug(slug: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+", slug) or ".." in slug:
        raise FetchError("not an owner/repository pair")
    return slug


def crawl(fetcher: Fetcher, settings) -> Iterator[tuple[str, str | None]]:
    """Lands every source that the settings switch on: (what, problem). The first changelog there is counts."""
    package, on, slug = settings.package, settings.sources, settings.package.repository
    wanted = [
        ("project", on.pypi, lambda: fetcher.project(package.name)), ("releases", on.github_releases, lambda: fetcher.releases(slug)),
        ("tags", on.github_tags, lambda: fetcher.tags(slug)), ("advisories", on.osv, lambda: fetcher.advisories(package.name, package.ecosystem)),
    ]
    for what, switched, ask in wanted:
        if switched:
            ask()
            yield what, None
    for candidate in settings.repository.changelog_candidates if on.changelog else ():
        try:
            fetcher.file(slug, candidate, settings.repository.default_branch)
            yield candidate, None
            return
        except FetchError as problem:
            yield candidate, str(problem)
