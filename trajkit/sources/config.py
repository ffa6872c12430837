"""Configuration files: the part of YAML that settings need, without a library."""

from __future__ import annotations

import os
import re

_NUMBER = re.compile(r"[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None, "~": None, "": None}


def scalar(text: str) -> object:
    """A quoted string, truth value, null, number, inline list or mapping, or else the text."""
    value, rest = _inline(text.strip(), 0, "")
    return value if rest >= len(text.strip()) else text.strip()


def _inline(s: str, i: int, stop: str) -> tuple[object, int]:
    """The value that starts at ``s[i]``, and the place after it; plain text ends before ``stop``."""
    while s[i : i + 1] == " ":
        i += 1
    c = s[i : i + 1]
    if c and c in "'\"":
        end = i + 1
        while end < len(s) and (s[end] != c or (c == "'" and s[end : end + 2] == "''")):
            end += 2 if (c == '"' and s[end] == "\\") or s[end : end + 2] == "''" else 1
        body = s[i + 1 : end]
        return (body.replace("''", "'") if c == "'" else body.replace('\\"', '"').replace("\\n", "\n").replace("\\\\", "\\")), end + 1
    if c and c in "[{":
        close = "]" if c == "[" else "}"
        items: list[object] = []
        pairs: dict[object, object] = {}
        i += 1
        while i < len(s) and s[i] != close:
            if s[i] in ", ":
                i += 1
                continue
            first, i = _inline(s, i, ",:" + close if c == "{" else "," + close)
            if c == "[":
                items.append(first)
                continue
            while s[i : i + 1] in (" ", ":") and i < len(s):
                i += 1
            pairs[first], i = _inline(s, i, "," + close)
        return (items if c == "[" else pairs), i + 1
    end = i
    while end < len(s) and s[end] not in stop:
        end += 1
    word = s[i:end].strip()
    if word.lower() in _WORDS:
        return _WORDS[word.lower()], end
    if _NUMBER.fullmatch(word):
        return (float(word) if re.search(r"[.eE]", word) else int(word)), end
    return word, end


def _uncommented(line: str) -> str:
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c == "#" and (i == 0 or line[i - 1].isspace()):
            return line[:i]
    return line


def parse(text: str) -> object:
    """The document's value; an empty document is an empty mapping."""
    rows = [(len(x) - len(x.lstrip(" ")), x.strip()) for x in map(_uncommented, text.splitlines()) if x.strip() and x.strip() != "---"]
    return _block(rows, 0, rows[0][0])[0] if rows else {}


def _split(row: str) -> tuple[str, str] | None:
    found = re.match(r"""("[^"]*"|'[^']*'|[^\s'"\[{][^:]*?)\s*:(?:\s+(.*))?$""", row)
    return (str(scalar(found[1]) if found[1][0] in "'\"" else found[1]), (found[2] or "").strip()) if found else None


def _block(rows: list[tuple[int, str]], i: int, indent: int) -> tuple[object, int]:
    if rows[i][1].startswith("-") and rows[i][1][1:2] in ("", " "):
        items: list[object] = []
        while i < len(rows) and rows[i][0] == indent and rows[i][1][:2] in ("-", "- "):
            rest = rows[i][1][1:].strip()
            inner = indent + len(rows[i][1]) - len(rest)
            if not rest:
                value, i = _block(rows, i + 1, rows[i + 1][0]) if i + 1 < len(rows) and rows[i + 1][0] > indent else (None, i + 1)
            elif _split(rest):
                value, i = _block([*rows[:i], (inner, rest), *rows[i + 1 :]], i, inner)
            else:
                value, i = scalar(rest), i + 1
            items.append(value)
        return items, i
    pairs: dict[str, object] = {}
    while i < len(rows) and rows[i][0] == indent:
        entry = _split(rows[i][1])
        if entry is None:
            if not pairs:
                return scalar(rows[i][1]), i + 1
            raise ValueError(f"not a key and a value: {rows[i][1]!r}")
        i += 1
        nested = i < len(rows) and (rows[i][0] > indent or (rows[i][0] == indent and rows[i][1][:2] in ("-", "- ")))
        if entry[1] or not nested:
            pairs[entry[0]] = scalar(entry[1])
        else:
            pairs[entry[0]], i = _block(rows, i, rows[i][0])
    return pairs, i


def load(folder: str) -> dict[str, object]:
    """Every ``.yaml`` file of a folder on the driver, by stem."""
    found = {}
    for name in sorted(os.listdir(folder)):
        if name.endswith((".yaml", ".yml")):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                found[name.rsplit(".", 1)[0]] = parse(f.read())
    return found
