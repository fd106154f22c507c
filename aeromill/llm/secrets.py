"""Secret scans: fixed token shapes plus assignment-aware lexing of source and configuration.

Two scanners work on every whole text:

* fixed shapes (``assign``, ``access``, ``hex``), matched left to right without overlap;
* a lexer for name-literal pairs, led by assignment operators (``=``, ``:``, ``:=``, ``=>``, ``==``).
  The name is read backwards from the operator (``"name"``, ``cfg["name"]``, ``name: type =``), the
  value forwards: strings (with escapes, three quotes, back quotes, prefixes), bare values up to a
  delimiter, lists of strings, YAML blocks and lists, ``+`` and adjacent strings. Calls, indexing and
  dotted references are no literals. ``<name>x</name>`` is a pair too.

Names bound to literals are constants of their indentation's scope; an assignment whose right side
is made of such names and literals gets their concatenation; with an unknown name among them each
literal counts alone, and so it does where concatenations would build more than GROWTH times the
text. What stands in a comment or inside a string is scored but binds nothing. Of the names of a
chain (``a = b = "x"``) the most sensitive counts.

A literal is scored by how sensitive the words of its target name are, and by the literal's length
and spread of characters; placeholders score low. Literals from ``literal_score`` up become
``literal`` spans, at the place where the text holds the literal. Everything is linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_batches, map_rows, place_of

#: Span kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words of target names (fixed values): how much each says that its literal is a secret.
NAME_SCORES = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
    "passwords": 1.0, "secrets": 1.0, "tokens": 0.9,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "bearer": 0.8, "auth": 0.6, "authorization": 0.8,
    "private": 0.5, "access": 0.4, "key": 0.5, "salt": 0.6, "signature": 0.5, "cookie": 0.5, "session": 0.4,
    "pin": 0.4, "cert": 0.4, "encryption": 0.6, "signing": 0.6, "client": 0.2, "api": 0.4,
}
#: Words that say that the literal is not itself a secret (fixed values).
NAME_DISCOUNTS = {"name": 0.6, "label": 0.6, "url": 0.4, "path": 0.4, "file": 0.4, "type": 0.5, "id": 0.3, "count": 0.6, "length": 0.6, "max": 0.4, "hint": 0.6, "public": 0.7}
#: Literals that stand for a missing value (fixed values).
PLACEHOLDERS = re.compile(r"(?i)^(?:x{3,}|\*{3,}|\.{3,}|change_?me|todo|none|null|true|false|example|your[_-].*|<.*>|\$\{.*\}|\$\w+|%\w+%|%\(.*\)s|\{\{.*\}\})$")

#: Characters of a name that are read at most, and blanks between it and its operator.
MAX_NAME, MAX_GAP = 256, 256
#: Concatenations of constants may hold so many times the text's characters, or LEAST.
GROWTH, LEAST = 4, 4096

_OPERATOR = re.compile(r":=|=>|==?|(?<!:):(?!:|//)")
_FOLLOWS = re.compile(r"[\x20\t]*(?::=|=(?![=>]))")
_LETTER = re.compile(r"[A-Za-z_]")
_NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
_IDENTIFIER = re.compile(rf"{_NAME}\Z")
_REFERENCE = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)+\Z")
_BLANKS = re.compile(r"[\x20\t]*")
_STRING = {q: re.compile(rf"{q}((?:[^{q}\\\n]|\\.)*){q}") for q in "\"'"}
_PREFIX = re.compile(r"[rRbBfFuU]{1,2}(?=[\"'])")
_BARE = re.compile(r"(?:[^\s\"'`,;(){}\[\]<>=&]|&(?!\w+=))+(?:={1,2}(?=[\s\"'`,;(){}\[\]<>]|\Z))?")
_TYPE = re.compile(
    r"&?[A-Za-z_][A-Za-z0-9_.]*(?:\[[^\]\n=]{0,80}\]|<[^<>\n=]{0,80}>)?(?:\[\])?\??(?:[\x20\t]*\|[\x20\t]*[A-Za-z_][A-Za-z0-9_.]*){0,8}[\x20\t]*=(?![=>])"
)
_JOIN = re.compile(r"[\x20\t]*\+(?!=)[\x20\t]*(?:\\?\r?\n[\x20\t]*)?")
_NEXT_LINE = re.compile(r"[\x20\t]*\r?\n[\x20\t]*(?=[\"'])")
_ITEM = re.compile(r"[\x20\t]*\r?\n[\x20\t]*-[\x20\t]+")
_BLOCK = re.compile(r"[|>][+-]?[0-9]?[\x20\t]*\r?\n")
_COMMENT = re.compile(r"(?:^|(?<=\s))(?:#|//|--\s|/\*|<!--)")
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})>(?P<value>[^<>\n]+)</(?P=name)>")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """Sensitivity of a target name from the words in it (snake, kebab, dotted or camel case)."""
    words = [w.lower() for w in _WORD.findall(name)]
    joined = "".join(words)
    score = max((NAME_SCORES.get(w, 0.0) for w in words), default=0.0)
    if "apikey" in joined or ("key" in words and {"api", "private", "access", "secret", "signing", "encryption"} & set(words)):
        score = max(score, 0.9)
    return score - max((NAME_DISCOUNTS.get(w, 0.0) for w in words), default=0.0)


def _mixed(literal: str) -> bool:
    return any(len(w) >= 6 and any(c.isdigit() for c in w) and any(c.isalpha() for c in w) for w in literal.split())


def literal_score(name: str, literal: str) -> float:
    """0..1: sensitivity of the name times the weight of the literal's entropy; words weigh half.

    Literals with white space are prose unless one of their words has both letters and digits.
    """
    score = name_score(name)
    if score <= 0 or len(literal) < 6 or PLACEHOLDERS.match(literal) or (any(c.isspace() for c in literal) and not _mixed(literal)):
        return 0.0
    counts = Counter(literal)
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    plain = 0.5 if literal.isalpha() and (literal.islower() or literal.istitle()) else 1.0  # an ordinary word
    return score * plain * min(1.0, 0.35 + 0.2 * bits)


@dataclass
class _Lexer:
    """Reads the value at a place; what was searched for in vain is remembered, so no tail is read twice."""

    text: str
    missing: set[str] = field(default_factory=set)
    open_until: dict[str, int] = field(default_factory=dict)

    def until(self, mark: str, start: int) -> int:
        """Place of ``mark`` from ``start`` on, or -1."""
        if mark in self.missing:
            return -1
        at = self.text.find(mark, start)
        if at < 0:
            self.missing.add(mark)
        return at

    def string(self, at: int) -> tuple[int, int, int] | None:
        """(start, end, after) of the string that begins with the quote at ``at``."""
        text, quote = self.text, self.text[at]
        if quote == "\\":  # a string inside a string
            mark = text[at : at + 2]
            end = self.until(mark, at + 2)
            return (at + 2, end, end + 2) if end >= 0 else None
        if text.startswith(quote * 3, at) or quote == "`":
            mark = quote if quote == "`" else quote * 3
            end = self.until(mark, at + len(mark))
            if end >= 0:
                return at + len(mark), end, end + len(mark)
            if quote == "`":
                return None
        if at < self.open_until.get(quote, 0):
            return None
        m = _STRING[quote].match(text, at)
        if m is None:
            line = text.find("\n", at)
            self.open_until[quote] = len(text) if line < 0 else line
            return None
        return m.start(1), m.end(1), m.end()

    def begins_string(self, at: int) -> bool:
        text = self.text
        return at < len(text) and (text[at] in "\"'`" or (text[at] == "\\" and text[at + 1 : at + 2] in ("'", '"')))

    def terms(self, at: int) -> tuple[list[tuple[str, int, int]], int]:
        """The parts of a sum: (kind, start, end), kind is string, bare or other; and the place after it."""
        text, out = self.text, []
        while True:
            at = _BLANKS.match(text, at).end()
            if m := _PREFIX.match(text, at):
                at = m.end()
            if self.begins_string(at):
                found = self.string(at)
                if found is None:
                    break
                out.append(("string", *found[:2]))
                at = found[2]
            elif m := _BARE.match(text, at):
                end = m.end()
                if text[end : end + 1] in ("(", "["):
                    return [*out, ("other", at, end)], end
                while end > at + 1 and text[end - 1] in ".:" and (end == len(text) or text[end].isspace()):
                    end -= 1
                out.append(("bare", at, end))
                at = end
            else:
                break
            if m := _JOIN.match(text, at):
                at = m.end()
            elif out[-1][0] != "string" or not self.begins_string(_BLANKS.match(text, at).end()):
                break
        return out, at

    def items(self, at: int) -> tuple[list[tuple[int, int]], int]:
        """The strings and bare values of a list that begins at ``at``, after its bracket."""
        text, out = self.text, []
        while at < len(text):
            if text[at].isspace() or text[at] == ",":
                at += 1
            elif self.begins_string(at):
                found = self.string(at)
                if found is None:
                    break
                out.append(found[:2])
                at = found[2]
            elif m := _BARE.match(text, at):
                out.append((at, m.end()))
                at = m.end()
            else:
                break
        return out, at

    def block(self, at: int, indent: int) -> int:
        """End of the lines from ``at`` on that are blank or further in than ``indent``."""
        text, end = self.text, at
        while at < len(text):
            stop = text.find("\n", at)
            stop = len(text) if stop < 0 else stop
            line = text[at:stop]
            if line.strip():
                if len(line) - len(line.lstrip(" \t")) <= indent:
                    break
                end = stop
            at = stop + 1
        return end


def _name_before(text: str, at: int) -> tuple[str, int] | None:
    """(name, start) of the name that ends before the operator at ``at``."""
    i, stop = at, max(0, at - MAX_GAP)
    while i > stop and text[i - 1] in " \t":
        i -= 1
    for _ in range(3):
        if i and text[i - 1] in "\"'`]\\":
            i -= 1
    end, stop = i, max(0, i - MAX_NAME)
    while i > stop and text[i - 1] in _NAME_CHARS:
        i -= 1
    m = _LETTER.search(text, i, end)
    return (text[m.start() : end], m.start()) if m else None


def pairs(text: str) -> list[tuple[str, str, int, int]]:
    """Name-literal pairs in order: (name, literal after propagation, start, end of the value's text)."""
    out = [(m["name"], m["value"], *m.span("value")) for m in _ELEMENT.finditer(text)] if "</" in text else []
    if "=" not in text and ":" not in text:
        return out
    lexer, scopes = _Lexer(text), [(0, {})]
    waiting: list[str] = []  # names to the left of the one that comes next, in ``a = b = "x"``
    built, limit = 0, max(LEAST, GROWTH * len(text))
    skip = inside = 0  # ends of the last value that is settled, and of the last string that is read again
    line, next_line, comment = 0, -1, len(text)
    for op in _OPERATOR.finditer(text):
        if op.start() < skip:
            continue
        found = _name_before(text, op.start())
        if found is None:
            waiting = []
            continue
        name, begin = found
        while next_line < op.start():  # where the line begins, and its comment
            line = next_line + 1
            next_line = text.find("\n", line)
            next_line = len(text) if next_line < 0 else next_line
            if next_line >= op.start():
                m = _COMMENT.search(text, line, next_line)
                comment = m.start() if m else len(text)
        indent = _BLANKS.match(text, line).end() - line
        binds = begin >= inside and op.start() < comment
        if binds:
            while len(scopes) > 1 and scopes[-1][0] > indent:
                scopes.pop()
            if scopes[-1][0] < indent:
                scopes.append((indent, {}))
        at = _BLANKS.match(text, op.end()).end()
        if text[at : at + 1] in ("\n", "\r") and (m := _NEXT_LINE.match(text, at)):
            at = m.end()
        if _TYPE.match(text, at):
            waiting.append(name)
            continue
        names, waiting = [*waiting, name], []
        best = max(names, key=name_score)
        telling = name_score(best) > 0
        if text[at : at + 1] == "[":
            listed, after = lexer.items(at + 1)
            out += [(best, text[a:b], a, b) for a, b in listed if telling]
            inside = max(inside, after)
            continue
        if telling and op[0] == ":" and (m := _BLOCK.match(text, at)):
            after = lexer.block(m.end(), indent)
            body = text[m.end() : after]
            out.append((best, body.strip(), m.end() + len(body) - len(body.lstrip()), m.end() + len(body.rstrip())))
            skip = after
            continue
        if telling and op[0] == ":" and _ITEM.match(text, at):
            while m := _ITEM.match(text, at):
                terms, at = lexer.terms(m.end())
                out += [(best, text[a:b], a, b) for kind, a, b in terms if kind != "other"]
            continue
        terms, after = lexer.terms(at)
        if not terms:
            continue
        if len(terms) == 1 and terms[0][0] == "bare" and _IDENTIFIER.match(text[terms[0][1] : terms[0][2]]) and _FOLLOWS.match(text, terms[0][2]):
            waiting = names
            continue
        if any(kind == "string" for kind, _, _ in terms):
            if telling:
                skip = after
            else:
                inside = max(inside, after)
        parts: list[tuple[str, int, int]] = []
        known = True
        for kind, a, b in terms:
            value = text[a:b]
            bound = next((s[value] for _, s in reversed(scopes) if value in s), None) if kind == "bare" else None
            if bound is not None:
                parts.append(bound)
            elif kind == "string" or (kind == "bare" and len(terms) == 1 and not _REFERENCE.match(value)):
                parts.append((value, a, b))
            else:
                known = False
        if len(parts) > 1 and known:
            size = sum(len(p[0]) for p in parts)
            known = built + size <= limit
            built += size if known else 0
        if not known:
            out += [(best, *p) for p in parts if telling and p[1] < p[2]]
            continue
        if len(parts) > 1:  # from the first part's text to the last one's, quotes included
            whole = ("".join(p[0] for p in parts), terms[0][1] - (terms[0][0] == "string"), terms[-1][2] + (terms[-1][0] == "string"))
        else:
            whole = parts[0]
        if whole[1] < whole[2]:
            out.append((best, *whole))
            if binds and len(whole[0]) <= limit:
                for n in names:
                    scopes[-1][1][n] = whole
    return out


def scan(text: str | None, threshold: float = 0.6) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) of a text by start, then kind; offsets in code points."""
    text = text or ""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    literals = {(s, e) for name, value, s, e in pairs(text) if literal_score(name, value) >= threshold}
    spans += [(s, e, "literal") for s, e in literals]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_literal", T.LongType()),
    ]
)


def scan_secrets(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Spans of secrets in every whole text: one row per row of ``docs`` (doc_id, text).

    Returns doc_id, counts by kind, base_sha256 (digest of the fixed-shape spans) and spans
    (``kind:start:end`` by start, then kind, comma-joined; code points, end exclusive). A null or
    empty text has no span and the digest of the empty string. Repeated rows give repeated
    results, no rows none; other columns are ignored. No shuffle.
    """

    def make():
        def one(doc_id, text):
            spans = scan(text, threshold)
            listed = [f"{k}:{s}:{e}" for s, e, k in spans]
            base = ",".join(x for x in listed if not x.startswith("literal"))
            n = Counter(k for _, _, k in spans)
            digest = hashlib.sha256(base.encode()).hexdigest()
            return [(doc_id, n["assign"], n["access"], n["hex"], digest, ",".join(listed), n["literal"])]

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text")), make, SCHEMA)


def redact(text: str | None, threshold: float = 0.6, mark: str = "[secret]") -> str | None:
    """The text with every span (overlaps joined) replaced by ``mark``; null stays null."""
    if text is None:
        return None
    out, at, until = [], 0, -1
    for start, end, _ in scan(text, threshold):
        if start >= until:
            if until >= 0:
                at = until
            out += [text[at:start], mark]
            until = end
        until = max(until, end)
    return "".join(out) + text[max(until, 0) :] if out else text


def redact_texts(docs: DataFrame, threshold: float = 0.6, mark: str = "[secret]") -> DataFrame:
    """All rows and columns of ``docs``; spans in ``text`` are replaced by ``mark``.

    Where a column ``n_chars`` exists and a text changes, it gets the new length. Null texts stay
    null. No shuffle.
    """
    at, size = place_of(docs, "text"), place_of(docs, "n_chars") if "n_chars" in docs.columns else None

    def make():
        import pyarrow as pa

        def hide(batch):
            old = batch.column(at).to_pylist()
            new = [redact(t, threshold, mark) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if size is not None:
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, columns[size].to_pylist(), strict=True)]
                columns[size] = pa.array(sizes, columns[size].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return hide

    return map_batches(docs, make, docs.schema)
