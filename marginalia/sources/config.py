"""TOML policies: small, bounded tables that the driver reads and the operators take as arguments."""

from __future__ import annotations

import fnmatch
import re
import tomllib
from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class FileRule:
    pattern: str
    role: str
    subject: str | None = None
    topics: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class Exception_:
    key: str
    reason: str
    path_contains: str | None = None
    adapter: str | None = None
    review_after: date | None = None


@dataclass(frozen=True)
class Policy:
    rules: tuple[FileRule, ...] = ()
    exceptions: tuple[Exception_, ...] = ()
    required: dict[str, list[str]] = field(default_factory=dict)
    issue_limit: int = 200


ROLES = ("curated", "derived", "archive")
SLUG = re.compile(r"^[a-z0-9]+(-[a-z0-9]+)*$")


def glob_pattern(glob: str) -> str:
    """A regular expression of a path glob: ** spans folders, * and ? stay inside one."""
    out, k = "", 0
    while k < len(glob):
        if glob[k : k + 3] == "**/":
            out, k = out + "(?:.*/)?", k + 3
        elif glob[k : k + 2] == "**":
            out, k = out + ".*", k + 2
        else:
            out, k = out + {"*": "[^/]*", "?": "[^/]"}.get(glob[k], re.escape(glob[k])), k + 1
    return f"(?:^|/){out}$"


def template(text: str, path: str) -> str:
    """{stem}, {parent} and {grandparent} of a path filled in."""
    parts = path.split("/")
    return text.replace("{stem}", parts[-1].rpartition(".")[0]).replace("{parent}", parts[-2] if len(parts) > 1 else "").replace("{grandparent}", parts[-3] if len(parts) > 2 else "")


def load_policy(text: str) -> Policy:
    """A policy of TOML text. Unknown keys are errors; exceptions without key or reason are left out."""
    data = tomllib.loads(text)
    if unknown := set(data) - {"rule", "exception", "required", "issue_limit"}:
        raise ValueError(f"unknown keys: {', '.join(sorted(unknown))}")
    rules = tuple(FileRule(r["pattern"], r["role"], r.get("subject"), tuple(r.get("topics", ())), tuple(r.get("exclude", ()))) for r in data.get("rule", ()))
    known = tuple(Exception_(e["key"], e["reason"], e.get("path_contains"), e.get("adapter"), e.get("review_after")) for e in data.get("exception", ()) if e.get("key") and e.get("reason"))
    return Policy(rules, known, data.get("required", {}), max(1, int(data.get("issue_limit", 200))))


def resolve(path: str, rules: tuple[FileRule, ...]) -> FileRule | None:
    """The first rule whose pattern fits and whose exclusions don't, with its templates filled in."""
    for r in rules:
        if re.search(glob_pattern(r.pattern), path) and not any(fnmatch.fnmatch(path, x) for x in r.exclude):
            return FileRule(r.pattern, r.role, template(r.subject, path) if r.subject else None, tuple(template(t, path) for t in r.topics), r.exclude)
    return None


def problems(rule: FileRule) -> list[str]:
    """What is wrong with resolved metadata: an unknown role, fields that the role can't have, names that are no slugs."""
    out = [] if rule.role in ROLES else [f"unknown role: {rule.role}"]
    if rule.role == "derived" and rule.topics:
        out.append("derived files have no topics")
    out += [f"not a slug: {t}" for t in (*rule.topics, *([rule.subject] if rule.subject else [])) if not SLUG.match(t)]
    return out


def inline_blocks(text: str, name: str) -> list[tuple[int, str]]:
    """(offset, body) of the `@comment{name: ...}` blocks of a file; braces and strings inside are balanced."""
    out = []
    for m in re.finditer(rf"(?i)@comment\s*\{{\s*{re.escape(name)}\s*:", text):
        depth, k, quoted = 1, m.end(), False
        while k < len(text) and depth:
            c = text[k]
            if c == '"' and text[k - 1] != "\\":
                quoted = not quoted
            elif not quoted:
                depth += {"{": 1, "}": -1}.get(c, 0)
            k += 1
        if not depth:
            out.append((m.start(), text[m.end() : k - 1].strip()))
    return out


def inline_fields(body: str) -> dict:
    """A block's body as TOML: pairs are split by commas or line feeds at the top level."""
    parts, depth, quoted, last = [], 0, False, 0
    for k, c in enumerate(body):
        if c == '"':
            quoted = not quoted
        elif not quoted:
            depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(c, 0)
            if c in ",\n" and not depth:
                parts.append(body[last:k])
                last = k + 1
    parts.append(body[last:])
    pairs = []
    for p in (p.strip() for p in parts):
        if p:
            name, _, v = p.partition("=")
            v = v.strip()
            pairs.append(f"{name.strip()} = {v}" if re.match(r'["\[{\d]|true|false', v) else f'{name.strip()} = "{v}"')
    return tomllib.loads("\n".join(pairs))
