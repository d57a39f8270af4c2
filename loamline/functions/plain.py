"""What one parse tells of the text of a payload: its redacted text, its leaks and the digest of its canonical form.

Plain texts are answered here: those without escapes whose denied attributes are single scalars, written without spaces, that stand where they must
go. Of all others this says nothing, and ``spans`` or the JVM is asked.
"""

from __future__ import annotations

import hashlib
import json
import re

#: Texts beyond these are looked at for depth and long names, which the JVM's reader limits.
_LONG, _MANY = 40_000, 900
#: What that reader certainly takes.
_LONGEST, _DEEPEST, _NAME = 4_000_000, 500, 10_000
_ENCODE = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False, check_circular=False).encode
_POINTS = ("gauge", "sum", "histogram", "exponentialHistogram", "summary")


class Reader:
    """Reads texts of which ``denied`` attributes go everywhere and ``content`` ones from log records."""

    def __init__(self, denied: frozenset[str], content: frozenset[str]) -> None:
        self._denied, self._content = denied, content - denied
        self._listed = {"logs": sorted(denied | content), "metrics": sorted(denied)}
        self._cuts = {s: _cuts(keys) for s, keys in self._listed.items() if keys}
        self._exact = True  # whether all numbers so far are written alike here and there
        self._decode = json.JSONDecoder(parse_float=self._float, parse_int=self._int, parse_constant=self._other).decode

    def named(self, text: str, signal: str) -> bool:
        return any(k in text for k in self._listed[signal])

    def tree(self, text: str) -> object:
        """The parsed text; ValueError if it is no JSON."""
        self._exact = True
        return self._decode(text)

    def cut(self, text: str, tree: object, signal: str) -> tuple[str, int] | None:
        """The text without what must go and how many content values said something, None if that is not certain. ``tree`` loses the same."""
        listed = self._listed[signal]
        try:
            found, leaks = self._drop(tree, signal)
        except (AttributeError, KeyError, TypeError):
            return None
        if found != sum(text.count(f'"{k}"') for k in listed):
            return None
        if not found:
            return text, 0
        out = text
        for pattern, instead in self._cuts[signal]:
            out = pattern.sub(instead, out)
            if not any(f'"{k}"' in out for k in listed):
                return out, leaks
        return None

    def digest(self, text: str, tree: object) -> str | None:
        """SHA-256 of the canonical form, None if only the JVM knows it: a repeated name shows in the number of quotes."""
        if not self._exact or type(tree) is not dict or not text.isascii():
            return None
        if (len(text) > _LONG or text.count("{") + text.count("[") > _MANY) and not _within(text, tree):
            return None
        canonical = _ENCODE(tree)
        return hashlib.sha256(canonical.encode()).hexdigest() if canonical.count('"') == text.count('"') else None

    def _drop(self, tree: dict, signal: str) -> tuple[int, int]:
        found = leaks = 0
        denied, logs = self._denied, signal == "logs"
        at_gate = denied | self._content if logs else denied
        for block in tree.get("resourceLogs" if logs else "resourceMetrics") or ():
            lists = [(block.get("resource"), denied)]
            for scope in block.get("scopeLogs" if logs else "scopeMetrics") or ():
                lists.append((scope.get("scope"), denied))
                if logs:
                    lists += [(x, at_gate) for x in scope.get("logRecords") or ()]
                else:
                    lists += [(x, denied) for m in scope.get("metrics") or () for k in _POINTS if m.get(k) for x in m[k].get("dataPoints") or ()]
            for owner, keys in lists:
                attributes = owner.get("attributes") if owner else None
                if not attributes:
                    continue
                gone = [a for a in attributes if a.get("key") in keys]
                if gone:
                    found += len(gone)
                    leaks += sum(_says(a["value"]) for a in gone if a["key"] not in denied)
                    owner["attributes"] = [a for a in attributes if a.get("key") not in keys]
        return found, leaks

    def _float(self, literal: str) -> float | int:
        if len(literal) > 16 or "e" in literal or "E" in literal:
            return self._other(literal)
        x = float(literal)
        if x.is_integer():
            return int(x)
        return x if abs(x) >= 1e-4 else self._other(literal)

    def _int(self, literal: str) -> int:
        return int(literal) if len(literal) <= 18 else self._other(literal)

    def _other(self, literal: str) -> int:
        self._exact = False
        return 0


def _cuts(keys: list[str]) -> list[tuple[re.Pattern[str], str]]:
    """Patterns of attributes of one scalar value, and what to put there: before others, after others, alone."""
    one = r'\{"key":"(?:' + "|".join(map(re.escape, keys)) + r')","value":\{"(?:stringValue|intValue|doubleValue|boolValue)":(?:"[^"]*"|[^"{}\[\],:\s]+)\}\}'
    return [(re.compile(one + r",\s*"), ""), (re.compile("," + one + r"(?=\])"), ""), (re.compile(r"\[" + one + r"\]"), "[]")]


def _says(value: dict) -> bool:
    """Whether a tagged scalar is more than an empty text."""
    return "stringValue" not in value or value["stringValue"] not in ("", None)


def _within(text: str, tree: dict) -> bool:
    """Whether a large text is within what the JVM's reader takes."""
    depth, level = 0, [tree]
    while level and depth <= _DEEPEST and len(text) <= _LONGEST:
        depth += 1
        below = []
        for x in level:
            if type(x) is dict:
                if any(len(k) > _NAME for k in x):
                    return False
                below += [v for v in x.values() if type(v) in (dict, list)]
            else:
                below += [v for v in x if type(v) in (dict, list)]
        level = below
    return not level
