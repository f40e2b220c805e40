"""Secret scans that know assignments.

Three plain patterns give the base spans. Beside them a lexer reads source and configuration syntax into
name-literal pairs, follows names that were set to a literal before, and scores each literal by how sensitive
the name is that it ends up in.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "pair")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of 24 or more is the same as a longest run, kept if it has 24.
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_HINT = re.compile(r"passw|secret|token|api", re.IGNORECASE | re.ASCII)

# Parts of names that hold secrets, with their weight.
_STRONG = {"password", "passwd", "passphrase", "secret", "token", "apikey", "pwd", "credential", "credentials", "bearer"}
_WEAK = {"auth", "authorization", "pass", "pw", "signature", "salt", "dsn", "key"}
_KEY_OF = {"api", "private", "access", "secret", "signing", "encryption", "auth", "client", "service", "master"}
_NAME_HINT = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|dsn|signature", re.IGNORECASE | re.ASCII)
_PLACEHOLDER = re.compile(
    r"^(?:none|null|nil|true|false|undefined|changeme|example|placeholder|redacted|xxx+|\*+|<.*>|\$\{.*\}|\$\w+|%\w+%|your[_-].*)$",
    re.IGNORECASE,
)
_QUOTED = {'"': r""""(?:[^"\\\n]|\\.)*"?""", "'": r"""'(?:[^'\\\n]|\\.)*'?"""}


def _token(quotes: str) -> re.Pattern:
    """What the lexer looks for next, where only ``quotes`` can open a string."""
    strings = "|".join(_QUOTED[q] for q in quotes) or "(?!)"
    return re.compile(
        f"(?P<string>{strings})"
        r"""|(?P<op>:=|=>|==|!=|<=|>=|[:=+])"""
        r"""|(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]*)"""
        r"""|(?P<end>[\n;,{}()\[\]])"""
        r"""|(?P<bare>[^\s;,{}()\[\]"'=+]+)"""
    )


_TOKENS = {q: _token(q) for q in ("\"'", '"', "'", "")}
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SETS = {"=", ":", ":=", "=>"}
_THRESHOLD = 4


def sensitivity(name: str) -> int:
    """0 to 3, by the words of a name in any of the usual spellings."""
    words = [w.lower() for w in _PARTS.findall(name)]
    found = set(words)
    if found & _STRONG:
        return 3
    if "key" in found and found & _KEY_OF:
        return 3
    return 1 if found & _WEAK else 0


def strength(literal: str) -> int:
    """0 to 3: how much a literal looks like a value that is not meant to be read."""
    if len(literal) < 6 or _PLACEHOLDER.match(literal) or " " in literal:
        return -3
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    classes = sum(any(test(c) for c in counts) for test in (str.isdigit, str.islower, str.isupper)) + any(
        not c.isalnum() for c in counts
    )
    return (classes >= 2) + (entropy >= 2.5) + (len(literal) >= 12)


def _lex(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Tokens of a text. A quote that nothing closes on its line is passed over, like what is no token.

    After such a quote no other of its kind closes before the end of the line either: those that might are escaped, and
    read from any of them, what follows is escaped alike. So each line is searched for a closing quote once, and its
    end, a token, comes before any string of a later line.
    """
    at, dead = 0, {'"': 0, "'": 0}
    while m := _TOKENS["".join(q for q in ("\"", "'") if dead[q] <= at)].search(text, at):
        piece, at = m.group(), m.end()
        if m.lastgroup == "string" and not _closed(piece):
            dead[piece[0]], at = m.end(), m.start() + 1
        else:
            yield m.lastgroup, piece, m.start(), m.end()


def _closed(string: str) -> bool:
    """Whether what begins with a quote ends with it, and the last one is not escaped."""
    inner = string[1:-1]
    return len(string) > 1 and string[-1] == string[0] and (len(inner) - len(inner.rstrip("\\"))) % 2 == 0


class _Value:
    """Literals and other values that a name was set to; values that were taken over are shared, not copied."""

    def __init__(self) -> None:
        self.parts: list[tuple[str, int, int] | _Value] = []

    def literals(self, seen: dict[_Value, int]) -> Iterator[tuple[str, int, int]]:
        """The literals in it, passing over what was ``seen`` before: so many parts of each value, as some still grow."""
        waiting: list = [self]
        while waiting:
            part = waiting.pop()
            if isinstance(part, tuple):
                yield part
            else:
                known, seen[part] = seen.get(part, 0), len(part.parts)
                waiting.extend(reversed(part.parts[known:]))


def _assignments(text: str) -> Iterator[tuple[str, tuple[str, int, int] | _Value]]:
    """Name and value of each assignment, a piece at a time; a value is a literal with its place, or that of another name."""
    constants: dict[str, _Value] = {}
    name, target, open_value, fresh = "", "", False, False
    for kind, piece, start, end in _lex(text):
        if kind == "end":
            name, target, open_value = "", "", False
        elif kind == "op":
            if piece in _SETS:
                target, open_value, fresh = (name, True, True) if name else ("", False, False)
            elif piece == "+" and target:
                open_value = True
            else:
                target, open_value = "", False
        elif open_value:
            inner = (piece[1:-1], start + 1, end - 1) if kind == "string" else (piece, start, end)
            value = constants.get(piece, inner) if kind == "name" else inner
            if kind != "name" or piece in constants or text[start - 1:start] != ".":
                # The value of a name is that of its latest assignment, which may have its former value in it.
                if fresh:
                    constants[target], fresh = _Value(), False
                constants[target].parts.append(value)
                yield target, value
            name, open_value = (piece if kind == "name" else ""), False
        elif kind in ("name", "string"):
            name = piece[1:-1] if kind == "string" else piece


def pairs(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Name, literal and the literal's place for each assignment, constants followed to where they came from.

    ``name = "a"``, ``"name": "a"``, ``name: a`` and ``name = other`` are assignments; ``"a" + "b"`` gives both
    parts. Of several names before an assignment sign the last one counts, so types and modifiers are passed over. A name
    has all literals of its latest assignment.
    """
    for name, value in _assignments(text):
        listed = [value] if isinstance(value, tuple) else value.literals({})
        for literal, start, end in listed:
            yield name, literal, start, end


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans as ``(start, end, kind)``, by start and then by kind as listed."""
    if not text:
        return [], []
    base: list[tuple[int, int, str]] = []
    if _ASSIGN_HINT.search(text):
        base += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        base += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    order = {k: i for i, k in enumerate(KINDS)}
    base.sort(key=lambda s: (s[0], order[s[2]]))
    found = list(base)
    if ("=" in text or ":" in text) and _NAME_HINT.search(text):
        spans: set[tuple[int, int]] = set()
        # A shared value is looked into once for each weight, so the work follows the length of the text.
        looked: dict[int, dict[_Value, int]] = {}
        for name, value in _assignments(text):
            weight = sensitivity(name)
            if weight:
                listed = [value] if isinstance(value, tuple) else value.literals(looked.setdefault(weight, {}))
                spans.update((a, b) for literal, a, b in listed if weight + strength(literal) >= _THRESHOLD)
        inside = _Cover([(a, b) for a, b, _ in base])
        found += [(a, b, "pair") for a, b in spans if not inside.holds(a, b)]
        found.sort(key=lambda s: (s[0], order[s[2]], s[1]))
    return base, found


class _Cover:
    """Finds out whether one of some spans, sorted by their start, holds another."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.starts = [a for a, _ in spans]
        self.ends = list(accumulate((b for _, b in spans), max))

    def holds(self, start: int, end: int) -> bool:
        before = bisect_right(self.starts, start)
        return before > 0 and self.ends[before - 1] >= end


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_assign, n_access, n_hex, n_pair, base_spans, spans``; spans are ``kind:start:end`` in code points.

    ``pair`` spans are literals in sensitive assignments that no base span holds already. Null and empty texts
    have none. Whole texts of any length are read. An empty table gives no rows; input columns called like a
    result column are replaced, names that
    begin with an underscore are reserved.
    """
    counts = [f"n_{k}" for k in KINDS]
    kind = pa.struct([*((c, pa.int64()) for c in counts), ("base", pa.string()), ("all", pa.string())])

    @F.arrow_udf(f"struct<{', '.join(f'{c}: bigint' for c in counts)}, base: string, all: string>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for value in texts.to_pylist():
                base, found = scan(value)
                by_kind = Counter(k for _, _, k in found)
                rows.append({f"n_{k}": by_kind[k] for k in KINDS} | {"base": _listed(base), "all": _listed(found)})
            yield pa.array(rows, kind)

    return df.withColumn("_found", find(F.col(text))).withColumns(
        {c: F.col(f"_found.{c}") for c in counts} | {"base_spans": F.col("_found.base"), "spans": F.col("_found.all")}
    ).drop("_found")
