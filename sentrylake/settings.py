"""Run settings: a closed configuration file and the few environment values that are taken from ``.env``."""

from __future__ import annotations

import dataclasses
import json
import os
import re
from dataclasses import dataclass
from pathlib import Path
from typing import Any

LARGEST_FILE = 1 << 20
LARGEST_ENV = 64_000
#: How many folders up ``.env`` is looked for.
DEEPEST = 8
# The names that ``.env`` may set.
ENV_NAMES = ("GITHUB_TOKEN", "NVD_API_KEY", "CRAWLER_OFFLINE")


class SettingsError(ValueError):
    """A configuration that is unsafe or does not fit."""


@dataclass(frozen=True)
class Package:
    name: str
    ecosystem: str
    purl: str
    repository: str
    version_scheme: str = "pep440"


@dataclass(frozen=True)
class Sources:
    pypi: bool = True
    github_releases: bool = True
    github_tags: bool = True
    changelog: bool = True
    github_advisories: bool = True
    osv: bool = True
    nvd: bool | str = "optional"
    patches: bool = True
    regression_tests: bool = True


@dataclass(frozen=True)
class Repository:
    default_branch: str = "main"
    changelog_candidates: tuple[str, ...] = ()
    security_policy_candidates: tuple[str, ...] = ()


@dataclass(frozen=True)
class Output:
    directory: str = "data"
    deterministic: bool = True
    include_raw: bool = True
    include_kb_documents: bool = True


@dataclass(frozen=True)
class Crawl:
    timeout_seconds: float = 30.0
    max_retries: int = 4
    cache_enabled: bool = True
    respect_rate_limits: bool = True
    max_response_bytes: int = 10 << 20
    initial_backoff_seconds: float = 1.0
    max_retry_delay_seconds: float = 60.0


@dataclass(frozen=True)
class Settings:
    package: Package
    sources: Sources = Sources()
    repository: Repository = Repository()
    output: Output = Output()
    crawl: Crawl = Crawl()


#: Least and most of the numbers; a least of 0 with ``open`` set is not itself allowed.
LIMITS = {
    "timeout_seconds": (0, 300, True), "max_retries": (0, 10, False), "max_response_bytes": (0, 100 << 20, True),
    "initial_backoff_seconds": (0, 60, False), "max_retry_delay_seconds": (0, 3600, True),
}


def _value(name: str, kind: str, value: Any) -> Any:
    if kind.startswith("tuple"):
        if not isinstance(value, (list, tuple)) or not all(isinstance(v, str) for v in value):
            raise SettingsError(f"{name} must be a list of texts")
        return tuple(value)
    allowed = {"str": (str,), "bool": (bool,), "int": (int,), "float": (float, int), "bool | str": (bool, str)}[kind]
    if not isinstance(value, allowed) or (isinstance(value, bool) and bool not in allowed):
        raise SettingsError(f"{name} must be {kind}")
    if name in LIMITS:
        low, high, open_ = LIMITS[name]
        if not low <= value <= high or (open_ and value == low):
            raise SettingsError(f"{name} is out of bounds")
    if name == "version_scheme" and value != "pep440":
        raise SettingsError("version_scheme must be pep440")
    if name == "nvd" and isinstance(value, str) and value != "optional":
        raise SettingsError("nvd must be true, false or optional")
    return value


def _section(kind: type, name: str, data: Any) -> Any:
    if not isinstance(data, dict):
        raise SettingsError(f"{name} must be a mapping")
    fields = {f.name: f for f in dataclasses.fields(kind)}
    if extra := sorted(set(map(str, data)) - set(fields)):
        raise SettingsError(f"{name} has unknown entries: {', '.join(extra)}")
    lost = [n for n, f in fields.items() if n not in data and f.default is dataclasses.MISSING]
    if lost:
        raise SettingsError(f"{name} lacks {', '.join(lost)}")
    return kind(**{n: _value(n, fields[n].type, v) for n, v in data.items()})


SECTIONS = {"package": Package, "sources": Sources, "repository": Repository, "output": Output, "crawl": Crawl}


def parse(data: Any) -> Settings:
    """A mapping as settings; entries that are not known are an error, sections but ``package`` may be left out."""
    if not isinstance(data, dict):
        raise SettingsError("the configuration must be a mapping")
    if extra := sorted(set(map(str, data)) - set(SECTIONS)):
        raise SettingsError(f"unknown sections: {', '.join(extra)}")
    if "package" not in data:
        raise SettingsError("the configuration lacks package")
    return Settings(**{n: _section(SECTIONS[n], n, v) for n, v in data.items()})


def _document(path: str | Path) -> object:
    """What a JSON file holds, or a YAML file where a YAML reader is there; links and files over 1 MiB are refused."""
    path = Path(path)
    if path.is_symlink():
        raise SettingsError("the configuration must not be a link")
    if not path.is_file():
        raise SettingsError(f"no configuration at {path}")
    if path.stat().st_size > LARGEST_FILE:
        raise SettingsError("the configuration exceeds 1 MiB")
    text = path.read_text(encoding="utf-8")
    try:
        if path.suffix == ".json":
            return json.loads(text)
        try:
            import yaml
        except ModuleNotFoundError as lost:
            raise SettingsError("reading YAML needs the yaml package; JSON does not") from lost
        try:
            return yaml.safe_load(text)
        except yaml.YAMLError as bad:
            raise SettingsError(f"{path} is not YAML") from bad
    except json.JSONDecodeError as bad:
        raise SettingsError(f"{path} is not JSON") from bad


def load(path: str | Path) -> Settings:
    """The settings of a file, every section checked."""
    return parse(_document(path))


def load_crawl(path: str | Path) -> Crawl:
    """The crawl section alone, checked; the file's other sections are not looked at."""
    data = _document(path)
    if not isinstance(data, dict):
        raise SettingsError("the configuration must be an object")
    return _section(Crawl, "crawl", data.get("crawl", {}))


_ASSIGNMENT = re.compile(r"^\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$")


def env_values(text: str) -> dict[str, str]:
    """The assignments of a ``.env`` text whose names are known; a pair of quotes around a value goes."""
    found = {}
    for line in text.splitlines():
        match = _ASSIGNMENT.match(line)
        if match and match[1] in ENV_NAMES:
            value = match[2]
            found[match[1]] = value[1:-1] if re.fullmatch(r"""(["']).*\1""", value) and len(value) > 1 else value
    return found


def load_env(start: str | Path | None = None) -> tuple[str, ...]:
    """Sets what the nearest ``.env`` names and the environment lacks; returns the names set."""
    here = Path(start or os.getcwd()).resolve()
    for folder in (here, *here.parents)[:DEEPEST]:
        file = folder / ".env"
        if file.is_file() and not file.is_symlink():
            if file.stat().st_size > LARGEST_ENV:
                raise SettingsError(f"{file} exceeds {LARGEST_ENV} bytes")
            new = {k: v for k, v in env_values(file.read_text(encoding="utf-8")).items() if k not in os.environ}
            os.environ.update(new)
            return tuple(new)
    return ()
