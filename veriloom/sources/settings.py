"""Settings files: JSON, and the part of YAML that hand-kept lists need.

Mappings and lists by indentation or in brackets, quoted and bare scalars, comments.  Anchors, block
scalars and several documents are errors, not guesses."""

from __future__ import annotations

import json
import re
from pathlib import Path

_WORDS = {"true": True, "false": False, "null": None, "~": None, "": None}
_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s#:\[\]{},"'][^#:]*?)\s*:(?:\s+|$)""")


def read(path: str | Path):
    text = Path(path).read_text(encoding="utf-8")
    return json.loads(text) if str(path).endswith(".json") else parse(text)


def parse(text: str):
    """The value that a YAML text holds; None if it holds nothing."""
    lines = [(len(raw) - len(raw.lstrip(" ")), bare) for raw in text.split("\n") if (bare := _uncommented(raw).strip())]
    joined: list[tuple[int, str]] = []
    for depth, line in lines:
        if joined and (_open_brackets(joined[-1][1]) or _open_quote(joined[-1][1]) or depth > joined[-1][0] and _carries_on(joined[-1][1], line)):
            joined[-1] = (joined[-1][0], f"{joined[-1][1]} {line}")
        else:
            joined.append((depth, line))
    if not joined:
        return None
    value, rest = _block(joined, 0)
    if rest < len(joined):
        raise ValueError(f"cannot read: {joined[rest][1]}")
    return value


def _uncommented(line: str) -> str:
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and (i == 0 or line[i - 1] in " [,:{-"):
            quote = c
        elif c == "#" and (i == 0 or line[i - 1] in " \t"):
            return line[:i]
    return line


def _open_brackets(line: str) -> bool:
    bare = re.sub(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^']|'')*'", "", line)
    return bare.count("[") + bare.count("{") > bare.count("]") + bare.count("}")


def _open_quote(line: str) -> bool:
    """A quoted scalar that the line does not end."""
    body = re.sub(r"^(?:- +)*", "", line)
    m = _KEY.match(body)
    body = body[m.end() :] if m else body
    return body[:1] in ("'", '"') and not re.fullmatch(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^']|'')*'", body.strip())


def _carries_on(before: str, line: str) -> bool:
    """A deeper line that is neither item nor key goes on with the scalar before it."""
    opens = re.fullmatch(r"(?:- +)*-?", before) or ((m := _KEY.match(re.sub(r"^(?:- +)*", "", before))) and not re.sub(r"^(?:- +)*", "", before)[m.end() :])
    return not opens and not line.startswith("- ") and not _KEY.match(line)


def _block(lines: list[tuple[int, str]], at: int):
    """The value that begins at a line, and the line after it."""
    depth, first = lines[at]
    if first.startswith("- ") or first == "-":
        out = []
        while at < len(lines) and lines[at][0] == depth and (lines[at][1].startswith("- ") or lines[at][1] == "-"):
            body = lines[at][1][1:].lstrip()
            if not body:
                value, at = _block(lines, at + 1) if at + 1 < len(lines) and lines[at + 1][0] > depth else (None, at + 1)
            elif _KEY.match(body) or body.startswith("- "):
                inner = depth + len(lines[at][1]) - len(body)
                value, at = _block([*lines[:at], (inner, body), *lines[at + 1 :]], at)
            else:
                value, at = _scalar(body), at + 1
            out.append(value)
        return out, at
    if not _KEY.match(first):
        return _scalar(first), at + 1
    found = {}
    while at < len(lines) and lines[at][0] == depth and (m := _KEY.match(lines[at][1])):
        body = lines[at][1][m.end() :].strip()
        nested = at + 1 < len(lines) and (lines[at + 1][0] > depth or lines[at + 1][0] == depth and lines[at + 1][1].startswith("- "))
        value, at = (_scalar(body), at + 1) if body else _block(lines, at + 1) if nested else (None, at + 1)
        found[_scalar(m[1])] = value
    return found, at


def _scalar(s: str):
    if s[:1] in "[{":
        return _flow(s)
    if s[:1] == '"':
        return json.loads(s)
    if s[:1] == "'":
        return s[1:-1].replace("''", "'")
    if s[:1] in "&*|>!%@`" and s not in ("*",) and not re.match(r"\*\w", s):
        raise ValueError(f"not supported: {s}")
    if s.lower() in _WORDS:
        return _WORDS[s.lower()]
    if re.fullmatch(r"[-+]?\d+", s):
        return int(s)
    return float(s) if re.fullmatch(r"[-+]?\d+\.\d*", s) else s


def _flow(s: str):
    inner, parts, level, quote, last = s[1:-1], [], 0, "", 0
    for i, c in enumerate(inner):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "[{":
            level += 1
        elif c in "]}":
            level -= 1
        elif c == "," and not level:
            parts.append(inner[last:i])
            last = i + 1
    parts = [p.strip() for p in [*parts, inner[last:]] if p.strip()]
    if s[0] == "[":
        return [_scalar(p) for p in parts]
    return {_scalar(k.strip()): _scalar(v.strip()) for k, _, v in (p.partition(":") for p in parts)}
