"""Personal data in texts: patterns propose spans, checksums confirm them, context words move the score.

Everything is built-in SQL functions, so the scan stays in the JVM. Matches are found with
``regexp_extract_all``; the pieces between them come from ``split`` on the same pattern, and
running sums of both lengths give the positions in code points.

Defined results: a null or empty text has no spans; a repeated row gives its own row; extra
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_columns

#: Code points looked at on either side of a span (up to the neighbouring span of the kind).
CONTEXT = 40
#: Added kinds are reported from this score on.
MIN_SCORE = 0.6
_BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` proposes, ``check`` confirms, ``score`` +/- context words rates the span.

    ``needs``: cheap substrings of which one must be in the text before the pattern is tried.
    """

    kind: str
    pattern: str
    check: object
    score: float
    words: tuple = ()
    needs: tuple = ()
    base: bool = True
    penalties: tuple = field(default=("example", "version", "sample"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _ip_ok(m: Column) -> Column:
    # A part of any length is at most 255 when it has at most three digits after its leading zeros.
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(m, "[.]"), lambda p: (F.length(part(p)) <= 3) & (F.lpad(part(p), 3, "0") <= F.lit("255")))


def _card_ok(m: Column) -> Column:
    d = _digits(m)
    return F.length(d).between(12, 19) & F.call_function("luhn_check", d)


def _phone_ok(m: Column) -> Column:
    return F.length(_digits(m)).between(9, 15)


def _iban_ok(m: Column) -> Column:
    """ISO 7064 mod 97: the first four characters go to the end, letters count 10 to 35."""
    s = F.regexp_replace(m, " ", "")
    moved = F.split(F.concat(F.substring(s, 5, 34), F.substring(s, 1, 4)), "")
    value = lambda c: F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    rest = F.aggregate(F.filter(moved, lambda c: c != ""), F.lit(0),
                       lambda acc, c: (acc * F.when(F.ascii(c) >= 65, 100).otherwise(10) + value(c)) % 97)
    return F.length(s).between(15, 34) & (rest == 1)


# The patterns keep the contract's matches; possessive loops and look-behinds only save retries that cannot succeed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

RULES = (
    Rule("email", EMAIL, lambda m: F.lit(True), 0.9, ("mail", "contact", "write"), ("@",)),
    Rule("ip", IP, _ip_ok, 0.6, ("ip", "host", "server", "address"), (".",)),
    Rule("card", CARD, _card_ok, 0.8, ("card", "visa", "credit", "payment"), ()),
    Rule("phone", PHONE, _phone_ok, 0.7, ("phone", "call", "tel", "mobile"), ("+",)),
    Rule("iban", IBAN, _iban_ok, 0.9, ("iban", "bank", "account"), (), base=False),
    Rule("ssn", SSN, lambda m: F.lit(True), 0.4, ("ssn", "social", "security"), ("-",), base=False),
)


def find_spans(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id`` and ``spans``: array of (start, rank, stop, kind, base, score) by start and rule order.

    Positions count code points, the end is exclusive. A confirmed span scores ``rule.score``,
    plus 0.2 with a context word near it, minus 0.2 with a word that speaks against it.
    """
    df = doc_columns(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = []
    for r in rules:
        hit = F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))
        if r.needs:
            some = F.lit(False)
            for s in r.needs:
                some = some | F.contains(F.col("text"), F.lit(s))
            hit = F.when(some, hit).otherwise(F.array().cast("array<string>"))
        found.append(hit.alias(f"m_{r.kind}"))
    df = df.select("doc_id", "text", *found)
    df = df.select("doc_id", *[f"m_{r.kind}" for r in rules],
                   *[F.when(F.size(f"m_{r.kind}") > 0, F.split("text", r.pattern, -1)).alias(f"g_{r.kind}") for r in rules])
    keep = [c for r in rules for c in (f"m_{r.kind}", f"g_{r.kind}")]
    sizes = [F.expr(f"transform(m_{r.kind}, (x, i) -> cast(length(x) + length(g_{r.kind}[i]) as bigint))").alias(f"z_{r.kind}") for r in rules]
    df = df.select("doc_id", *keep, *sizes)
    # Running sums go block by block: long lists of matches cost no square.
    blocks = [F.expr(f"CASE WHEN size(z_{r.kind}) > 0 THEN transform(sequence(0, cast((size(z_{r.kind}) - 1) div {_BLOCK} as int)), b -> "
                     f"aggregate(slice(z_{r.kind}, b * {_BLOCK} + 1, {_BLOCK}), 0L, (a, x) -> a + x)) ELSE array() END").alias(f"b_{r.kind}") for r in rules]
    keep += [f"z_{r.kind}" for r in rules]
    df = df.select("doc_id", *keep, *blocks)
    before = [F.expr(f"transform(b_{r.kind}, (x, b) -> aggregate(slice(b_{r.kind}, 1, b), 0L, (a, y) -> a + y))").alias(f"p_{r.kind}") for r in rules]
    df = df.select("doc_id", *keep, *before)
    spans = []
    for rank, r in enumerate(rules):
        stop = F.expr(f"transform(m_{r.kind}, (x, i) -> named_struct('m', x, 'stop', p_{r.kind}[cast(i div {_BLOCK} as int)] + "
                      f"aggregate(slice(z_{r.kind}, cast(i div {_BLOCK} as int) * {_BLOCK} + 1, i % {_BLOCK} + 1), 0L, (a, y) -> a + y), "
                      f"'near', lower(concat(right(g_{r.kind}[i], {CONTEXT}), ' ', left(g_{r.kind}[i + 1], {CONTEXT})))))")

        spans.append(_confirmed(stop, rank, r))
    return df.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def _confirmed(matches: Column, rank: int, r: Rule) -> Column:
    """Spans of a rule's matches (m, stop, near) that its check confirms, with their scores."""
    def rated(s):
        has = lambda words: F.rlike(s["near"], F.lit(r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])"))
        score = F.lit(r.score) + F.when(has(r.words), 0.2).otherwise(0.0) - F.when(has(r.penalties), 0.2).otherwise(0.0)
        return F.struct((s["stop"] - F.length(s["m"])).alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"),
                        F.lit(r.kind).alias("kind"), F.lit(r.base).alias("base"), F.round(score, 2).alias("score"))

    out = F.transform(F.filter(matches, lambda s: r.check(s["m"])), rated)
    return out if r.base else F.filter(out, lambda s: s["score"] >= MIN_SCORE)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per document row: counts per base kind, digest of the base spans, all spans, their scores."""
    df = find_spans(docs)
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return df.select("doc_id", count("email"), count("ip"), count("card"), count("phone"),
                     F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
                     F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))
