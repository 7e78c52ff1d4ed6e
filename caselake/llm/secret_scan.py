"""Secret scan: fixed shapes, and literals assigned to sensitive names.

Besides the three base shapes, text is read as source or configuration. A lexer
cuts it once from left to right into literals (double, single, triple and back
quotes, indented blocks behind ``name: |``), words and signs; a literal's inside is
read in turn. Name-literal pairs are ``name = "x"``, ``name: x``, ``"name": "x"``,
``a["name"] = "x"``, ``name => 'x'``, ``name: kind = "x"``, ``f(name="x")``, ``f("x")``,
``f("name", "x")``, ``<name>x</name>``, ``key="name" value="x"`` (``--name x`` is none).
Constants are carried from name to name within the text, also to places before
their own, adjacent and added literals count as one value, and a literal is scored
by the name that receives it and by how much it looks like a key rather than a
word. Spans of the method are kind ``secret``. Time is in proportion to the text.

Defined results: a null or empty text has no span; repeated rows give the same
spans each; an empty table gives no row. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed shapes: values that must match.
ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the least length can stand in the pattern
KINDS = ("assign", "access", "hex", "secret")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: Words of names and how sensitive they are; a name counts by its most sensitive word.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "apikey": 1.0, "token": 0.9, "credential": 0.9,
    "credentials": 0.9, "bearer": 0.9, "pass": 0.8, "auth": 0.7, "key": 0.6, "private": 0.6, "signature": 0.6, "signing": 0.6, "salt": 0.5, "pin": 0.7,
}
#: Values that stand for a secret but are none.
PLACEHOLDERS = {"changeme", "example", "password", "secret", "token", "undefined", "null", "none", "true", "false", "xxxxxxxx", "placeholder"}
THRESHOLD = 0.5
LEAST = 8
#: First characters kept of a joined value; no placeholder is as long.
HEAD = 32

#: Words that, standing last, make a name that of something about the secret.
ABOUT = {"type", "hint", "length", "len", "size", "count", "limit", "ttl", "expiry", "expires", "policy", "label", "placeholder", "field", "format", "pattern", "regex", "prompt", "message", "error", "status"}

NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
#: What the lexer tells apart. A run of word characters is one token, so no start inside it is tried,
#: and a backslash takes the next character with it, inside of literals and outside.
TOKEN = re.compile(
    r"""(?P<long>\"{3}|'{3}|`)|(?P<quote>"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|(?:(?<![A-Za-z0-9])|(?<=[=:(,\x20\t][bBrRfFuU])|(?<=[=:(,\x20\t][bBrRfFuU]{2}))'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+')"""
    r"""|(?P<word>[A-Za-z0-9_$][A-Za-z0-9_.$-]*+)|(?P<assign>:=|=>|\+=|={1,2}(?!=)|:(?!//))|(?P<mark>[()\[\]{},+\n])|(?P<escape>\\[\s\S])"""
)
#: What may stand behind an assignment besides a literal in quotes: spaces, a prefix of the literal, a block, a bare value.
GAP = re.compile(r"[\x20\t]*+(?:[bBrRfFuU]{1,2}(?=[\"']))?")
BLOCK = re.compile(r"[|>][-+0-9]*+[\x20\t]*+\n")
BARE = re.compile(r"[A-Za-z0-9+/_.=$-]++")
LINE = re.compile(r"([\x20\t]*+)([^\n]*+)(?:\n|\Z)")
QUOTED_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\x20-]*+")
PATH = re.compile(r"[A-Za-z_]++(?:\.[A-Za-z_]++)++")
ELEMENT = re.compile(rf"<(?P<name>{NAME})>(?P<value>[^<>\s]+)</(?P=name)>")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
MARKS = re.compile(r"[:=(]|</")
KINDS_OF_CHARACTERS = [re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")]

#: (kind, start, end): kinds are literal, word, escape, or the mark or sign of assignment itself; a literal's bounds lie inside its quotes.
Token = tuple[str, int, int]
#: (text, start, end, quoted)
Part = tuple[str, int, int, bool]


@lru_cache(4096)
def sensitivity(name: str) -> float:
    words = [w.lower() for w in WORDS.findall(name)]
    if words and words[-1] in ABOUT:
        return 0.0
    pairs = [a + b for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words + pairs), default=0.0)


class Value:
    """What a name holds: a literal's span, or other values one after the other.

    Only what the score needs is joined (counts of characters, the first of them),
    so a constant made of any number of pieces costs no more than its pieces.
    """

    __slots__ = ("span", "pieces", "size", "head", "literal", "joined")

    def __init__(self, literal: str = "", span: tuple[int, int] | None = None, pieces: tuple[Value, ...] = ()):
        self.span, self.pieces, self.literal = span, pieces, literal
        self.size = len(literal) + sum(p.size for p in pieces)
        self.head = (literal + "".join(p.head for p in pieces))[:HEAD]
        self.joined: Counter | None = None
        if pieces:
            self.joined = Counter()
            for p in pieces:
                self.joined.update(p.counts)

    @property
    def counts(self) -> Counter:
        return Counter(self.literal) if self.joined is None else self.joined

    def spans(self, told: set[int]) -> Iterator[tuple[int, int]]:
        """Spans of the literals in values not yet ``told``."""
        left = [self]
        while left:
            value = left.pop()
            if id(value) not in told:
                told.add(id(value))
                left += value.pieces
                if value.span and value.size:
                    yield value.span


def randomness(value: Value) -> float:
    """0 for words, towards 1 for keys: entropy per character, and mixed kinds of characters."""
    counts = value.counts
    entropy = -sum(c / value.size * math.log2(c / value.size) for c in counts.values())
    different = "".join(counts)
    kinds = sum(p.search(different) is not None for p in KINDS_OF_CHARACTERS)
    return min(1.0, entropy / 4) * (0.4 + 0.2 * kinds)


def score(name: str, value: Value) -> float:
    sensitive = sensitivity(name)
    if not sensitive or value.size < LEAST or value.head.startswith("$") or (value.size < HEAD and value.head.lower() in PLACEHOLDERS):
        return 0.0
    return sensitive * min(1.0, 0.3 + randomness(value))


def _block(text: str, key: int, at: int, stop: int) -> tuple[int, int, int] | None:
    """Start, end and last position read of the indented lines from ``at``, below the line that holds ``key``."""
    outer = len(LINE.match(text, text.rfind("\n", 0, key) + 1)[1])
    start, end, least = -1, at, outer + 1
    while at < stop:
        line = LINE.match(text, at, stop)
        if line[2].strip():
            if len(line[1]) < least:
                break
            if start < 0:
                start, least = line.start(2), len(line[1])
            end = line.start(2) + len(line[2].rstrip())
        at = line.end()
    return (start, end, end) if start >= 0 else None


def tokens(text: str, start: int, stop: int) -> Iterator[Token]:
    """Tokens of a part of a text. Every character is read a bounded number of times."""
    at = start
    while m := TOKEN.search(text, at, stop):
        kind, begin, at = m.lastgroup, m.start(), m.end()
        if kind == "long":  # literals that may span lines
            close = text.find(m.group(), at, stop)
            if close >= 0:
                yield "literal", at, close
                at = close + len(m.group())
            else:  # none further on closes either
                at = begin + 1
        elif kind == "quote":
            yield "literal", begin + 1, at - 1
        elif kind == "assign":
            yield m.group(), begin, at
            value = GAP.match(text, at, stop).end()
            block = BLOCK.match(text, value, stop) if m.group() == ":" else None
            inner = _block(text, begin, block.end(), stop) if block else None
            if inner:
                yield "literal", inner[0], inner[1]
                at = inner[2]
            elif bare := BARE.match(text, value, stop):
                yield "word", value, bare.end()
                at = bare.end()
            else:
                at = value
        elif kind == "mark":
            yield m.group(), begin, at
        else:
            yield kind, begin, at


SIGNS = {"=", ":", ":=", "=>", "==", "+="}


def _name(text: str, row: list[Token], i: int) -> str | None:
    """The name that ends before token ``i``: a word, a quoted name, or a quoted name as index."""
    if i and row[i - 1][0] == "]" and i > 2 and row[i - 3][0] == "[":
        i -= 1
    if not i:
        return None
    kind, start, end = row[i - 1]
    if kind == "literal":
        return text[start:end] if QUOTED_NAME.fullmatch(text, start, end) else None
    return text[start:end].lstrip("$0123456789.-") or None if kind == "word" else None


def _parts(text: str, row: list[Token], i: int) -> list[Part]:
    """The literals and names from token ``i`` on that make one value: added, adjacent, or so in brackets."""
    inside = i < len(row) and row[i][0] == "("
    i += inside
    parts: list[Part] = []
    added = True
    while i < len(row):
        kind, start, end = row[i]
        after = row[i + 1][0] if i + 1 < len(row) else ""
        if kind == "escape" or (inside and kind == "\n"):
            pass
        elif kind == "+":
            added = True
        elif kind == "literal" and after not in SIGNS and (added or parts[-1][3]):
            parts.append((text[start:end], start, end, True))
            added = False
        elif kind == "word" and added and after not in ("(", "[") and not (after == "=" and row[i - 1][0] == ":"):
            if not PATH.fullmatch(text, start, end):
                parts.append((text[start:end], start, end, False))
            added = False
        else:
            break
        i += 1
    return parts


def _within(text: str, start: int, stop: int) -> Iterator[tuple[str, list[Part]]]:
    """Pairs of a part of a text, and of what its literals hold in turn.

    A literal cannot hold its own kind of quote, so literals nest a few levels at most.
    """
    left = [(start, stop)]
    while left:
        start, stop = left.pop()
        row = list(tokens(text, start, stop))
        key, free = None, -1  # <add key="name" value="literal"/>
        for i, (kind, begin, end) in enumerate(row):
            if kind == "literal":
                if (begin, end) != (start, stop) and MARKS.search(text, begin, end):
                    left.append((begin, end))
            elif kind in SIGNS:
                name = _name(text, row, i)
                if kind == "=" and i > 1 and row[i - 2][0] == ":" and row[i - 1][0] == "word":  # name: kind = value
                    name = _name(text, row, i - 2) or name
                if name:
                    parts = _parts(text, row, i + 1)
                    if kind == "+=":
                        parts.insert(0, (name, begin, begin, False))
                    lower = name.lower()
                    if key and free == i - 1 and lower == "value":
                        yield key, parts
                    key, free = None, i + 2
                    if lower in ("key", "name", "id") and len(parts) == 1 and len(row) > i + 3 and row[i + 3][0] == "=" and (_name(text, row, i + 3) or "").lower() == "value":
                        key = parts[0][0]
                    elif parts:
                        yield name, parts
            elif kind == "(" and (name := _name(text, row, i)) and row[i - 1][0] == "word":
                # f("literal") and f("name", "literal")
                given = [t[0] for t in row[i + 1 : i + 5]]
                if given[:2] == ["literal", ")"]:
                    yield name, [(text[row[i + 1][1] : row[i + 1][2]], *row[i + 1][1:], True)]
                elif given[:3] == ["literal", ",", "literal"] and (name := _name(text, row, i + 2)):
                    yield name, [(text[row[i + 3][1] : row[i + 3][2]], *row[i + 3][1:], True)]


def _pairs(text: str) -> list[tuple[str, list[Part]]]:
    """(name, parts of its value) in order of the value."""
    found = list(_within(text, 0, len(text)))
    # what stands between the tags is the literal, whatever its characters
    found += [(m["name"], [(m["value"], m.start("value"), m.end("value"), True)]) for m in ELEMENT.finditer(text)]
    return sorted(found, key=lambda pair: (pair[1][-1][1], pair[1][-1][2]) if pair[1] else (0, 0))


def assigned_literals(text: str) -> set[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or through constants.

    A name stands for what it was given last before its use, or else first after it;
    a value made of itself in a circle holds what lies outside the circle.
    """
    pairs = _pairs(text)
    later: dict[str, int] = {}
    for j in range(len(pairs) - 1, -1, -1):
        later[pairs[j][0]] = j
    before: dict[str, int] = {}
    given: list[list[int]] = []  # of each part the pair it refers to, or -1
    for j, (name, parts) in enumerate(pairs):
        refs = []
        for literal, _, _, quoted in parts:
            ref = -1 if quoted else before.get(literal, later.get(literal, -1))
            refs.append(-1 if ref == j else ref)
        given.append(refs)
        before[name] = j
    values: list[Value | None] = [None] * len(pairs)
    open_: set[int] = set()
    told: set[int] = set()
    spans: set[tuple[int, int]] = set()
    for j in range(len(pairs)):
        left = [j]
        while left:  # referred pairs first
            k = left[-1]
            wanted = [r for r in given[k] if r >= 0 and values[r] is None and r not in open_] if values[k] is None else []
            open_.add(k)
            if wanted:
                left += wanted
                continue
            left.pop()
            open_.discard(k)
            if values[k] is None:
                values[k] = _value(pairs[k][1], given[k], values)
        name, value = pairs[j][0], values[j]
        if score(name, value) >= THRESHOLD:
            spans.update(value.spans(told))
    return spans


def _value(parts: list[Part], refs: list[int], values: list[Value | None]) -> Value:
    held = []
    for (literal, start, end, quoted), ref in zip(parts, refs):
        if ref >= 0:
            if values[ref] is not None:
                held.append(values[ref])
        elif quoted or len(parts) == 1:
            held.append(Value(literal, (start, end)))
    return held[0] if len(held) == 1 else Value(pieces=tuple(held))


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """All spans as (start, number of the kind, end), in order."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(found)
    if MARKS.search(text):
        # what lies inside a base span is known already: the furthest end of those that start no later tells
        starts = [s for s, _, _ in base]
        ends = list(accumulate((e for _, _, e in base), max))
        for start, end in assigned_literals(text):
            known = bisect_right(starts, start)
            if not known or ends[known - 1] < end:
                found.append((start, 3, end))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every document."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in batch.column("text"):
                every = scan(text.as_py())
                base = [s for s in every if s[1] < 3]
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scanned, schema)
