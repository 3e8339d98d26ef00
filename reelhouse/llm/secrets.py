"""Secret scans: fixed patterns, and assignments whose target name is sensitive.

The text is lexed as source or configuration: names with dots and subscripts, assignment
marks, type annotations, string and bare literals, indented blocks, and the signs that join
literals, over as many lines as a value takes. Pairs of a name and its literals come out of
it, constants given by name are followed to their literals, whether they are defined before
or after, and every literal is scored by how sensitive its target's name is and by how much
it looks like a secret.

Null texts are empty and have no spans; repeated rows and null ids each stay; a table
without rows gives none. Texts of any length are scanned whole, in a time that grows with
their length but for values joined of very many constants. Columns other than the id and the text are passed over or passed on.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, pick, with_text

KINDS = ("assign", "access", "hex", "literal")

# The base patterns. A match is greedy, so asking for the least length at
# once finds the same spans where a match is one run of a class.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "api")

# One forward pass: a quote that nothing closes fails once for its kind and line, and runs of
# escapes outside strings are one token, so the time grows with the length of the text.
_TOKEN = re.compile(
    r"""(?P<string>(?<![A-Za-z0-9_])[bBrRfFuU]{0,2}(?:"{3}(?:[^"\\]|\\[\s\S]|"(?!""))*+"{3}|'{3}(?:[^'\\]|\\[\s\S]|'(?!''))*+'{3}"""
    r"""|"(?:[^"\\\n]|\\[^\n])*+"|'(?:[^'\\\n]|\\[^\n])*+')|"(?:[^"\\\n]|\\[^\n])*+"|`[^`\n]*+`|\\"[^"\\\n]++\\")"""
    r"""|(?P<name>[A-Za-z_$][A-Za-z0-9_$]*+(?:[.\-][A-Za-z_$][A-Za-z0-9_$]*+)*+)"""
    r"""|(?P<mark>:=|=>|==|!=|<=|>=|[:=])"""
    r"""|(?P<join>[+.&]|\.\.)"""
    r"""|(?P<space>(?:[^\S\n]|\\\r?\n)++)"""
    r"""|(?P<newline>\n)"""
    r"""|(?P<other>(?:\\[^\n])++|[\s\S])"""
)
_ASSIGNS = (":", "=", ":=", "=>")
_QUOTES = re.compile(r"""[bBrRfFuU]*("{3}|'{3}|\\"|["'`])""")
_BARE = re.compile(r"[^\s,;\"'`(){}\[\]<>\\]+")
_REFERENCE = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*(?:[.\-][A-Za-z_$][A-Za-z0-9_$]*)*")
_BLOCK_MARK = re.compile(r"[|>][+\-0-9]{0,2}[^\S\n]*(?:#[^\n]*)?\n")
_BLANK = re.compile(r"[^\S\n]*(?:\n|\Z)")
_INDENT = re.compile(r"[ \t]*")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HINT = re.compile(r"[:=]")

# How sensitive a part of a target's name is, and parts that say the value is none.
_SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "pass": 2, "secret": 3, "token": 3, "apikey": 3,
    "credential": 3, "credentials": 3, "private": 1, "access": 1, "api": 1, "auth": 2, "authorization": 2, "bearer": 2,
    "signature": 1, "signing": 1, "encryption": 1, "client": 1, "key": 1, "salt": 1, "session": 1, "cookie": 1,
}
_HARMLESS = {"public": 3, "name": 2, "url": 2, "uri": 2, "path": 2, "file": 2, "type": 2, "length": 3, "count": 3, "id": 1, "example": 3}
_PLACEHOLDER = re.compile(r"(?i)^(?:.*(?:example|changeme|placeholder|your[_-]|todo|dummy|redacted|\*{3}|x{4}|<|\$\{|%\().*|none|null|true|false|undefined)$")


@dataclass(frozen=True)
class Scan:
    """``least_score`` is the smallest score of a reported literal, ``least_length`` its shortest length."""

    least_score: float = 4.0
    least_length: int = 8


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the three patterns, leftmost and not overlapping for each kind."""
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def name_score(name: str) -> int:
    parts = [p.lower() for p in _NAME_PART.findall(name)]
    return sum(_SENSITIVE.get(p, 0) for p in parts) - sum(_HARMLESS.get(p, 0) for p in parts)


def literal_score(value: str) -> float:
    """0 for a placeholder or a plain word, more for mixed classes and a high entropy."""
    if not value or _PLACEHOLDER.match(value) or " " in value.strip():
        return 0.0
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
    counts, n = Counter(value), len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    return (classes >= 2) + max(0.0, entropy - 2.0)


Literal = tuple[str, int, int]  # text, start, end


@dataclass
class Pair:
    """A target's name and the terms joined to its value: literals, and names of constants with the literal they may be."""

    name: str
    terms: list[Literal | tuple[str, Literal | None]]


class _Parser:
    """Name-literal pairs of a text, in order.

    Only lines with an assignment mark are lexed, and those that go on from them: open
    brackets, a join at the end of a line, a value on the next line, an indented block.
    """

    def __init__(self, text: str) -> None:
        self.text, self.at, self.tokens = text, 0, []

    def _line(self) -> bool:
        """Lex up to the end of the next line, or of the string that goes beyond it."""
        before = len(self.tokens)
        while self.at < len(self.text):
            m = _TOKEN.match(self.text, self.at)
            self.at = m.end()
            if m.lastgroup != "space":
                self.tokens.append((m.lastgroup, m.start(), m.end()))
            if m.lastgroup == "newline":
                break
        return len(self.tokens) > before

    def _token(self, i: int) -> tuple[str, int, int]:
        while i >= len(self.tokens):
            if not self._line():
                return ("end", len(self.text), len(self.text))
        return self.tokens[i]

    def _is(self, i: int, signs: str | tuple[str, ...]) -> bool:
        """Whether token ``i`` of the lines lexed so far is one of some signs."""
        if i >= len(self.tokens):
            return False
        _, start, end = self.tokens[i]
        return end - start <= 2 and self.text[start:end] in signs

    def _kind(self, i: int) -> str:
        return self.tokens[i][0] if i < len(self.tokens) else "end"

    def _content(self, i: int) -> Literal:
        _, start, end = self.tokens[i]
        m = _QUOTES.match(self.text, start)
        start, end = m.end(), end - len(m[1])
        return self.text[start:end], start, end

    def pairs(self) -> Iterator[Pair]:
        while hint := _HINT.search(self.text, self.at):
            self.tokens, i = [], 0
            self.at = max(self.at, self.text.rfind("\n", 0, hint.start()) + 1)
            self._line()
            while i < len(self.tokens):
                name, mark = self._target(i)
                if not name:
                    i += 1
                    continue
                terms, after = self._value(mark)
                if terms:
                    yield Pair(name, terms)
                i = max(mark + 1, after)

    def _target(self, i: int) -> tuple[str, int]:
        """The name that begins at token ``i`` and the place of its assignment mark; an empty name if none is assigned."""
        kind, start, end = self.tokens[i]
        if kind == "name":
            name, i = self._reference(i)
        elif kind == "string":
            name, i = self._content(i)[0], i + 1
        else:
            return "", 0
        if self._kind(i) != "mark" or not self._is(i, _ASSIGNS):
            return "", 0
        return (name, self._annotated(i)) if self._is(i, ":") else (name, i)

    def _reference(self, i: int) -> tuple[str, int]:
        """A name with its subscripts, joined by dots, and the place after it."""
        _, start, end = self.tokens[i]
        name, i = self.text[start:end], i + 1
        while self._is(i, "[") and self._kind(i + 1) == "string" and self._is(i + 2, "]"):
            name, i = f"{name}.{self._content(i + 1)[0]}", i + 3
        return name, i

    def _annotated(self, mark: int) -> int:
        """The place of the mark behind a type that stands after the colon at ``mark``, or ``mark``."""
        i, depth, names = mark + 1, 0, 0
        while i < len(self.tokens):
            if self._is(i, "="):
                return i if names and not depth else mark
            if self._kind(i) == "name":
                names += 1
            elif self._is(i, ("[", "<")):
                depth += 1
            elif self._is(i, ("]", ">")):
                depth -= 1
            elif not self._is(i, ("|", "?", ".")) and not (depth and self._is(i, ",")):
                return mark
            i += 1
        return mark

    def _block(self, mark: int) -> list[Literal] | None:
        """The lines of an indented block that a bar or an angle after the colon begins."""
        _, start, end = self.tokens[mark]
        begins = _INDENT.match(self.text, end).end()
        head = _BLOCK_MARK.match(self.text, begins)
        if self.text[start:end] != ":" or not head:
            return None
        first = self.text.rfind("\n", 0, start) + 1
        outer, at, found = _INDENT.match(self.text, first).end() - first, head.end(), []
        while at < len(self.text):
            blank = _BLANK.match(self.text, at)
            inner = _INDENT.match(self.text, at).end()
            if not blank and inner - at <= outer:
                break
            stop = self.text.find("\n", at)
            stop = len(self.text) if stop < 0 else stop
            if not blank:
                line = self.text[inner:stop].rstrip()
                found.append((line, inner, inner + len(line)))
            at = stop + 1
        # Lexing goes on behind the block.
        self.tokens = self.tokens[: mark + 1]
        self.at = max(head.end(), min(at, len(self.text)))
        return found

    def _value(self, mark: int) -> tuple[list, int]:
        """The terms of the value behind the mark, and the place after it."""
        block = self._block(mark)
        if block is not None:
            return block, mark + 1
        i, terms, depth, joined, fresh = mark + 1, [], 0, True, True
        while True:
            # A line's end is passed over inside brackets, behind a join and before any term.
            kind, start, end = self._token(i) if depth or joined else self.tokens[i] if i < len(self.tokens) else ("end", 0, 0)
            if kind == "newline":
                if not (depth or joined):
                    break
                fresh, i = False, i + 1
            elif kind == "string" and not (terms and not joined and self._kind(i - 1) != "string" and not depth):
                terms.append(self._content(i))
                joined, i = False, i + 1
            elif self._is(i, "("):
                depth, i = depth + 1, i + 1
            elif depth and self._is(i, ")"):
                depth, joined, i = depth - 1, False, i + 1
                if not depth and not terms:
                    break
            elif terms and kind == "join":
                joined, i = True, i + 1
            elif joined and kind != "end" and (fresh or terms or depth):
                bare = _BARE.match(self.text, start)
                if not bare:
                    break
                literal = (bare[0], *bare.span())
                if kind == "name" and _REFERENCE.fullmatch(bare[0]):
                    name, after = self._reference(i)
                    called = self._is(after, "(")
                    if self._kind(after) == "mark" and self._is(after, _ASSIGNS):
                        # An assignment in a value: its target stands for the value, and is read next.
                        if not terms:
                            terms.append((name, None))
                        break
                    plain = not terms and not called and "." not in name
                    terms.append((name, literal if plain else None))
                    joined, i = False, after
                    if called:
                        break
                elif not terms:
                    terms.append(literal)
                    while self._kind(i) != "end" and self.tokens[i][1] < bare.end():
                        i += 1
                    break
                else:
                    break
            else:
                break
        if len(terms) > 1:  # a name joined to others is no literal of its own
            terms = [(t[0], None) if len(t) == 2 else t for t in terms]
        return terms, i


def pairs(text: str) -> Iterator[Pair]:
    """Name-literal pairs of a text, in order."""
    return _Parser(text).pairs()


class _Constants:
    """Which pair a name stands for: its last value before the use, or its first one after it."""

    def __init__(self, all_pairs: list[Pair]) -> None:
        self.pairs, self.places, self.roots = all_pairs, {}, {}
        for i, pair in enumerate(all_pairs):
            self.places.setdefault(pair.name, []).append(i)

    def source(self, name: str, at: int) -> int | None:
        known = self.places.get(name, [])
        before = bisect.bisect_left(known, at) - 1
        return known[before] if before >= 0 else next((k for k in known if k != at), None)

    def root(self, i: int) -> int:
        """The pair at the end of a chain of pairs whose value is one constant alone: its literals are theirs."""
        chain = []
        while i not in self.roots:
            self.roots[i] = i  # a circle ends where it is met again
            chain.append(i)
            terms = self.pairs[i].terms
            source = self.source(terms[0][0], i) if len(terms) == 1 and len(terms[0]) == 2 else None
            i = i if source is None else source
        self.roots.update(dict.fromkeys(chain, self.roots[i]))
        return self.roots[i]

    def literals(self, starts: list[int]) -> list[Literal]:
        """The literals in the values of some pairs, constants followed to theirs, in order."""
        found: dict[Literal, None] = {}
        seen = set(starts)
        todo = [(i, t) for i in reversed(starts) for t in reversed(self.pairs[i].terms)]
        while todo:
            at, term = todo.pop()
            source = None if len(term) == 3 else self.source(term[0], at)
            if len(term) == 3:
                found[term] = None
            elif source is None:
                if term[1] is not None:
                    found[term[1]] = None
            elif source not in seen:
                seen.add(source)
                todo += [(source, t) for t in reversed(self.pairs[source].terms)]
        return list(found)


def literal_spans(text: str, scan: Scan) -> list[tuple[str, int, int]]:
    """Literals that are given, directly or through constants, to a sensitive name.

    Every value is followed to all its literals, however many constants lie between. Chains
    of constants that only name the next are followed once; for a value joined of constants
    the work is the number of constants in it, for each such value anew.
    """
    constants = _Constants(list(pairs(text)))
    secret, judged = [], {}
    for i, pair in enumerate(constants.pairs):
        sensitive = name_score(pair.name)
        if sensitive > 0:
            root = constants.root(i)
            if root not in judged:
                whole = "".join(v for v, _, _ in constants.literals([root]))
                judged[root] = len(whole), literal_score(whole)
            length, score = judged[root]
            if length >= scan.least_length and sensitive + score >= scan.least_score:
                secret.append(i)
    return list(dict.fromkeys(("literal", s, e) for _, s, e in constants.literals(secret) if e > s))


def spans_of(text: str, scan: Scan) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then by kind as listed in ``KINDS``, then by end."""
    found = base_spans(text) + (literal_spans(text, scan) if ":" in text or "=" in text else [])
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(text: Column, scan: Scan = Scan()) -> Column:
    """The spans of a text as an array of (kind, start, end); empty for a null text."""

    @F.pandas_udf("array<struct<kind string, start int, end int>>")
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t or "", scan)] for t in part], dtype=object)

    return find(text)


def scanned(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """``doc_id``, ``text`` and ``spans`` for each row of ``docs``, repeated rows and null ids included."""
    return pick(docs, "doc_id", "text").withColumn("spans", secret_spans(F.col("text"), scan))


def digest(spans: Column, *kinds: str) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked_text(text: Column, scan: Scan = Scan(), mask: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans are replaced as one. Null stays null."""

    def hide(value: str | None) -> str | None:
        if value is None:
            return None
        out, at = [], 0
        for _, start, end in spans_of(value, scan):
            if end <= at:
                continue
            if start >= at:
                out += [value[at:start], mask]
            at = end
        return "".join([*out, value[at:]]) if out else value

    @F.pandas_udf("string")
    def masked(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([hide(t) for t in part], dtype=object)

    return masked(text)


def mask_secrets(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """``docs`` with the secrets in its texts masked, and ``n_chars``, where there is one, counted anew. Every row stays."""
    rows = packed(docs, "text").withColumn("masked", masked_text(F.col("text"), scan))
    return with_text(rows, docs, F.col("masked"))
