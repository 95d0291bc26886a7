"""Secret scan over a document-sharded trigram inverted index.

Each rule's pattern gives a Boolean query: its parse tree yields sets of strings of which every match
holds one, and the sets become alternatives that each need all their trigrams. A task indexes its shard of texts (postings from trigram to texts, for the trigrams of
the rules' queries), intersects the postings, and runs the rule's pattern on the candidates only.
A rule without mandatory trigrams scans every text. The index is partitioned by document, so
nothing is shuffled and memory is bounded by the chunk of texts in hand.

Defined results: a null or empty text has no spans; repeated rows give a row each; extra columns
of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as token
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_columns, text_bytes, text_chunks


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = True


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs are maximal, so asking for 32 in the pattern drops the same matches as a check afterwards.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", base=False),
)

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_verified int")


def trigrams(literal: str) -> list[int]:
    b = literal.encode()
    return sorted({b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)})


class _Stretch:
    """Reads a parse tree: ``exact`` are all texts (in lower case) that the current stretch can have, and
    ``needs`` are sets of strings of which every match holds one each."""

    #: Texts of a stretch, and characters of a class that is spelled out.
    MOST, CLASS = 64, 8

    def __init__(self):
        self.exact, self.needs, self.whole = {""}, [], True

    def cut(self):
        """What follows is not known as text: the stretch so far becomes a need."""
        self.whole = False
        if min(map(len, self.exact)) >= 3:
            self.needs.append({x for x in self.exact if not any(y != x and y in x for y in self.exact)})
        self.exact = {""}

    def add(self, texts: set[str]):
        if len(self.exact) * len(texts) > self.MOST:
            self.cut()
            texts = texts if len(texts) <= self.MOST else {""}
        self.exact = {x + y for x in self.exact for y in texts}

    def inside(self, tree) -> "_Stretch":
        """A part read by itself; ``whole`` tells that it is one stretch, never cut."""
        part = _Stretch()
        part.read(tree)
        return part

    def read(self, tree):
        for op, value in tree:
            if op is token.LITERAL:
                self.add({chr(value).lower() if value < 128 else chr(value)})
            elif op is token.IN and (texts := _members(value)):
                self.add(texts)
            elif op is token.SUBPATTERN:
                self.read(value[3])
            elif op is token.BRANCH:
                parts = [self.inside(t) for t in value[1]]
                if all(p.whole for p in parts):
                    self.add(set().union(*(p.exact for p in parts)))
                    continue
                self.cut()
                for p in parts:
                    p.cut()
                if all(p.needs for p in parts):  # one need of every branch
                    self.needs.append(set().union(*(min(p.needs, key=len) for p in parts)))
            elif op in (token.MAX_REPEAT, token.MIN_REPEAT, token.POSSESSIVE_REPEAT):
                least, most, again = value
                part = self.inside(again)
                if part.whole and (least, most) == (0, 1):
                    self.add(part.exact | {""})
                    continue
                for _ in range(min(least, 8)):
                    self.read(again)
                if most > min(least, 8):
                    self.cut()
            elif op is not token.AT:  # any character, look-arounds, back references: nothing is known
                self.cut()


def _members(options) -> set[str]:
    """The characters of a class in lower case; empty if it is negated, named or large."""
    out: set[str] = set()
    for op, value in options:
        if op is token.LITERAL:
            out.add(chr(value))
        elif op is token.RANGE and value[1] - value[0] < _Stretch.CLASS:
            out.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return set()
    return {c.lower() if c.isascii() else c for c in out} if len(out) <= _Stretch.CLASS else set()


def boolean_query(rule: Rule) -> list[list[int]] | None:
    """Any of these lists of trigrams, each as a whole; None if the pattern has no mandatory trigrams
    and the rule has to scan everything."""
    found = _Stretch()
    found.read(parser.parse(rule.pattern, re.ASCII))
    found.cut()
    query: list[set[int]] = []
    for need in sorted(found.needs, key=len):
        lists = [set(trigrams(x)) for x in need]
        if query and len(query) * len(lists) > _Stretch.MOST:
            break  # the query stays necessary with fewer of its needs
        query = [a | b for a in query for b in lists] if query else lists
    return sorted(map(sorted, query)) or None


def build_postings(texts: list[bytes], wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Trigram -> sorted positions of the texts that hold it (ASCII letters compared in lower case)."""
    flat = np.frombuffer(b"\n\n\n".join(texts).lower(), dtype=np.uint8).astype(np.uint32)
    if flat.size < 3:
        return {}
    code = flat[:-2] << np.uint32(16) | flat[1:-1] << np.uint32(8) | flat[2:]
    table = np.zeros(1 << 24, dtype=bool)
    table[wanted] = True
    at = np.flatnonzero(table[code])
    starts = np.cumsum([0] + [len(t) + 3 for t in texts[:-1]])
    # A code's 24 bits and the text's number make one sortable key.
    pairs = np.unique(code[at].astype(np.int64) << 32 | (np.searchsorted(starts, at, side="right") - 1))
    grams = pairs >> 32
    return {int(g): pairs[lo:hi] & 0xFFFFFFFF for g, lo, hi in zip(*_runs(grams))}


def _runs(values: np.ndarray):
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if values.size else np.zeros(0, dtype=int)
    return values[first], first, np.r_[first[1:], values.size].astype(int)


def candidates(postings: dict, clauses: list[list[int]] | None, n: int) -> np.ndarray:
    if clauses is None:
        return np.arange(n)
    out = np.zeros(0, dtype=np.int64)
    for clause in clauses:
        lists = sorted((postings.get(g, out[:0]) for g in clause), key=len)
        both = lists[0]
        for other in lists[1:]:
            if not both.size:
                break
            both = np.intersect1d(both, other, assume_unique=True)
        out = np.union1d(out, both)
    return out.astype(np.int64)


def _scan(rules, queries, batches):
    wanted = np.array(sorted({g for q in queries if q for c in q for g in c}), dtype=np.int64)
    compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
    for part in text_chunks(batches):
        raw = text_bytes(part)
        postings = build_postings(raw, wanted)
        spans: list[list] = [[] for _ in raw]
        verified = np.zeros(len(raw), dtype=np.int32)
        decoded: dict[int, str] = {}
        for rank, (rule, query, pattern) in enumerate(zip(rules, queries, compiled)):
            for i in candidates(postings, query, len(raw)):
                verified[i] += query is not None
                text = decoded.get(i)
                if text is None:
                    text = decoded[i] = raw[i].decode("utf-8", "replace")
                for m in pattern.finditer(text):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[i].append((m.start(), rank, m.end(), rule))
        rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for found in spans:
            found.sort(key=lambda s: s[:3])
            kinds = [s[3].kind for s in found]
            for k in ("assign", "access", "hex"):
                rows[f"n_{k}"].append(kinds.count(k))
            text_of = [f"{s[3].kind}:{s[0]}:{s[2]}" for s in found]
            base = ",".join(t for t, s in zip(text_of, found) if s[3].base)
            rows["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            rows["spans"].append(",".join(text_of))
        yield pa.record_batch([part.column(0), *(pa.array(rows[k], pa.int64()) for k in ("n_assign", "n_access", "n_hex")),
                               pa.array(rows["base_sha256"], pa.string()), pa.array(rows["spans"], pa.string()), pa.array(verified, pa.int32())],
                              names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_verified"])


def secret_scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document row: counts per base kind, digest of the base spans, all spans, and in how
    many rules the index made the text a candidate (``n_verified``)."""
    queries = [boolean_query(r) for r in rules]
    return doc_columns(docs).mapInArrow(lambda batches: _scan(rules, queries, batches), SCHEMA)
