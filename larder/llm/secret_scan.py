"""Secret scan: assignment-aware lexing of names and literals, on top of three base patterns."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from larder.llm.arrow import map_text

# The base patterns, with the shortest match (assign: of group 2) that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18

KINDS = ("assign", "access", "hex", "literal", "constant")

#: How telling each word of a name is; a name scores as its best word.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "credential": 0.9, "credentials": 0.9,
    "token": 0.9, "apikey": 1.0, "bearer": 0.9, "private": 0.7, "auth": 0.7, "key": 0.6, "salt": 0.6, "signature": 0.5,
}
#: Words that make a name harmless although it has a telling word (token_count, public_key).
NAME_HARMLESS = {"count", "counts", "limit", "length", "size", "max", "min", "public", "type", "name", "id", "field", "path",
                 "url", "file", "hint", "label", "prompt", "policy"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|changeme.*|example.*|dummy.*|placeholder.*|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(?.*\)?s|none|null|true|false|undefined|test|todo)$")

_TOKEN = re.compile(r"""
    (?P<skip>[\x20\t]+|\\\r?\n)
  | (?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`)
  | (?P<name>[$@]?[A-Za-z_][A-Za-z0-9_]*(?:(?:\.|->|::|-)[A-Za-z_][A-Za-z0-9_]*)*)
  | (?P<assign>:=|=>|==|!=|<=|>=|\+=|[=:])
  | (?P<plus>\+|\.\.)
  | (?P<bare>[A-Za-z0-9+/_.=@$%^&*!~-]+)
  | (?P<other>.|\n)""", re.X | re.S)
_ASSIGNS = {"=", ":", ":=", "=>", "+="}
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Texts without a telling word or without an assignment sign have no name-literal pair to score.
_WORTH = r"(?i)passw|pwd|passphrase|secret|credential|token|key|bearer|private|auth|salt|signature"
_SIGN = r"[:=]"


def name_score(name: str) -> float:
    """How likely a name is to hold a secret, 0 to 1."""
    last = re.split(r"\.|->|::", name)[-1]
    words = [w.lower() for w in _WORDS.findall(last)]
    joined = "".join(words)
    if any(w in NAME_HARMLESS for w in words):
        return 0.0
    best = max((NAME_WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    return max(best, NAME_WEIGHTS["apikey"] if joined.endswith(("apikey", "accesskey", "secretkey", "privatekey")) else 0.0)


ENDS = 64  # characters at the start, and at the end, by which a longer value is told to be a placeholder


class Value:
    """What a name stands for: the places of its literals, as a graph of the values it was put together from, and what
    the score needs to know of the text, which is never put together itself."""

    def __init__(self, place: tuple[int, int] | None = None, text: str = "", parts: tuple[Value, ...] = ()):
        self.place, self.parts = place, parts
        if len(parts) == 1:  # another name's value
            self.length, self.counts, self.head, self.tail = parts[0].length, parts[0].counts, parts[0].head, parts[0].tail
            return
        self.length, self.counts, self.head, self.tail = len(text), Counter(text), text[:ENDS], text[-ENDS:]
        for part in parts:
            self.length += part.length
            self.counts = self.counts + part.counts
            self.head = (self.head + part.head)[:ENDS]
            self.tail = (self.tail + part.tail)[-ENDS:]

    def score(self) -> float:
        """How much a literal looks like a secret rather than a word or a placeholder, 0 to 1."""
        ends = self.head if self.length <= ENDS else self.head + self.tail
        if self.length < 6 or PLACEHOLDER.match(ends) or any(c.isspace() for c in self.counts):
            return 0.0
        entropy = -sum(n / self.length * math.log2(n / self.length) for n in self.counts.values())
        letters = "".join(self.counts)
        kinds = sum(bool(re.search(p, letters)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        return min(1.0, entropy / 4.0) * (0.5 + 0.25 * min(kinds, 3) - 0.25 * (kinds < 2))


def _declared(text: str, tokens: list[tuple[str, int, int]], at: int) -> int | None:
    """The token of the name in front of ``name : type``, if the tokens up to ``at`` end in a type on the same line."""
    low = at
    while low > 0 and (tokens[low][0] in ("name", "bare") or text[tokens[low][1]:tokens[low][2]] in "[](),.|&<>?* "):
        low -= 1
    colon = text[tokens[low][1]:tokens[low][2]] == ":" and 0 < low < at and tokens[low - 1][0] in ("name", "string")
    return low - 1 if colon else None


def assignments(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Name-value pairs of source and configuration syntax in text order.

    A value is a list of parts joined by a concatenation: ("literal", start, end) without quotes, or ("name",
    start, end) for another name. Names may be quoted keys or the last subscript of an expression. Comment
    signs in front of a pair (#, //) do not hide it, as secrets are left in comments too.
    """
    tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(text) if m.lastgroup not in ("skip",)]
    pairs, k = [], 0
    while k < len(tokens):
        kind, start, end = tokens[k]
        if kind == "assign" and text[start:end] in _ASSIGNS and k:
            back = k - 1
            typed = _declared(text, tokens, back) if text[start:end] == "=" else None
            while typed is None and back and text[tokens[back][1]:tokens[back][2]] in ("]", ")"):
                back -= 1
            left, s, e = tokens[back if typed is None else typed]
            while typed is not None and pairs and pairs[-1][1][0][1] > s:  # the type had been taken for the value
                pairs.pop()
            name = text[s + 1:e - 1] if left == "string" else text[s:e] if left == "name" else ""
            parts, k = [], k + 1
            while k < len(tokens):
                kind, s, e = tokens[k]
                if kind == "string":
                    parts.append(("literal", s + 1, e - 1))
                elif kind == "name" and not (k + 1 < len(tokens) and tokens[k + 1][0] == "bare" and tokens[k + 1][1] == e):
                    parts.append(("name", s, e))
                elif kind in ("name", "bare"):  # an unquoted value runs up to white space
                    stop = re.compile(r"[^\s,;)\]}\"']*").match(text, s).end()
                    parts.append(("literal", s, stop))
                    while k + 1 < len(tokens) and tokens[k + 1][1] < stop:
                        k += 1
                else:
                    break
                k += 1
                if k < len(tokens) and tokens[k][0] == "plus":
                    k += 1
                else:
                    break
            if name and parts:
                pairs.append((name, parts))
        else:
            k += 1
    return pairs


def lexed_spans(text: str, threshold: float) -> list[tuple[int, str, int]]:
    """Spans found by the lexer: ``literal`` under a telling name, ``constant`` where a telling name takes its
    value from another name whose literal was assigned before."""
    constants: dict[str, Value] = {}
    found, told = set(), set()
    for name, parts in assignments(text):
        values = []
        for kind, start, end in parts:
            if kind == "literal" or (len(parts) == 1 and text[start:end] not in constants):  # or an unquoted word
                values.append(Value((start, end), text[start:end]))
            elif text[start:end] in constants:
                values.append(Value(parts=(constants[text[start:end]],)))
        value = constants[name] = values[0] if len(values) == 1 else Value(parts=tuple(values))
        weight = name_score(name)
        if weight and weight * value.score() >= threshold:
            found.update((v.place[0], "literal", v.place[1]) for v in values if v.place)
            rest = [p for v in values for p in v.parts]
            while rest:  # a value is gone through once, however many names lead to it
                v = rest.pop()
                if id(v) not in told:
                    told.add(id(v))
                    rest.extend(v.parts)
                    if v.place:
                        found.add((v.place[0], "constant", v.place[1]))
    literals = {(s, e) for s, kind, e in found if kind == "literal"}
    return [x for x in found if x[1] == "literal" or (x[0], x[2]) not in literals]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    return ([(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
            + [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
            + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)])


def written(spans: list[tuple[int, str, int]]) -> str:
    """kind:start:end by start, then kind in the order of KINDS, joined by commas."""
    ordered = sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in ordered)


def scan_secrets(frame: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``base`` and ``lexed``, both arrays of (start, kind, end) in code points, end exclusive.

    ``base`` holds matches of the three fixed patterns: leftmost, non-overlapping per kind, those too short
    dropped after matching. ``lexed`` holds what assignment-aware lexing adds. A null or empty text has none, a
    null key stays null, repeated rows each give a row, other columns are left out. Whole texts are lexed,
    whatever their length; a text that holds no name, sign and literal of interest is passed over quickly.
    """
    span = "array<struct<start:int,kind:string,end:int>>"
    kind = frame.schema[key].dataType.simpleString()

    def rows(spans):
        return [{"start": s, "kind": k, "end": e} for s, k, e in sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))]

    def work(batch: pa.RecordBatch) -> dict:
        texts = batch.column(text).fill_null("")
        worth_base = pc.or_(pc.match_substring_regex(texts, r"(?i)(?:passw|secret|token|api_?key)|\x{017f}|\x{212a}"),
                            pc.match_substring_regex(texts, r"AKIA[A-Z0-9]|[0-9a-f]{16}")).to_pylist()
        worth_lexing = pc.and_(pc.match_substring_regex(texts, _WORTH), pc.match_substring_regex(texts, _SIGN)).to_pylist()
        base, lexed = [], []
        for k in range(len(texts)):
            t = texts[k].as_py() if worth_base[k] or worth_lexing[k] else ""
            base.append(rows(base_spans(t)) if worth_base[k] else [])
            lexed.append(rows(lexed_spans(t, threshold)) if worth_lexing[k] else [])
        return {key: batch.column(key), "base": base, "lexed": lexed}

    return map_text(frame.select(key, text), work, f"`{key}` {kind}, base {span}, lexed {span}", text)


def digest(spans: list[tuple[int, str, int]]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()
