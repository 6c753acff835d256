"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the lower-cased text: at-signs,
``://`` of schemes, digits, plus signs and words that announce an identifier. A small
deterministic parser per kind then expands the anchor to both sides, decides the exact
boundaries, and validates the span.

Base kinds, each leftmost and non-overlapping within its kind: ``email``, ``ip`` (four
parts of at most 255), ``card`` (14 to 19 digits passing the Luhn check), ``phone`` (a plus
sign and 10 to 15 digits). A failing candidate is dropped and not tried again. The method
adds two kinds: ``login``, the user part of ``scheme://user:password@host``, and ``account``,
the identifier that follows a cue such as ``IBAN`` or ``passport no`` (6 to 34 letters and
digits, four digits at least). Base spans stay as they are: an account never touches one,
and a login may overlap the email that password and host look like.

Defined cases: null and empty texts have no spans; offsets are code points, ends exclusive;
order is by start, then kind as listed. Repeated rows are judged each by itself. Texts are
handled one at a time, whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "login", "account")
BASE = KINDS[:4]

#: Words that announce an identifier; the identifier follows within a few characters.
CUES = (
    "account number", "account no", "acct", "iban", "passport no", "passport number",
    "social security number", "ssn", "tax id", "national id", "customer id",
)

DIGITS = frozenset("0123456789")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = DIGITS | frozenset(" ().-")
_LINK = frozenset(" \t\r\n/?#\"'<>")

Span = tuple[int, int]


@cache
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
    automaton.add_word("@", ("at", 1))
    automaton.add_word("+", ("plus", 1))
    automaton.add_word("://", ("scheme", 3))
    for cue in CUES:
        automaton.add_word(cue, ("cue", len(cue)))
    automaton.make_automaton()
    return automaton


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _email(text: str, at: int, floor: int) -> Span | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _run(text, end + 1, _LABEL)
        labels += 1
    return (start, end) if labels > 1 else None


def _addresses(text: str, at: int) -> tuple[list[Span], int]:
    """The addresses of the chain of dotted numbers at ``at``, and where the chain ends."""
    parts, end = [], at
    while True:
        stop = _run(text, end, DIGITS)
        parts.append((end, stop))
        if stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in DIGITS:
            end = stop + 1
        else:
            break
    found = []
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        # Longer than three digits can still be small: leading zeros.
        if all(len(text[s:e].lstrip("0")) <= 3 and int(text[s:e][-4:]) <= 255 for s, e in four):
            found.append((four[0][0], four[3][1]))
    return found, parts[-1][1]


def _card(text: str, at: int) -> tuple[Span | None, int]:
    digits, end = [text[at]], at + 1
    n = len(text)
    while end < n:
        if text[end] in DIGITS:
            digits.append(text[end])
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            digits.append(text[end + 1])
            end += 2
        else:
            break
    if 14 <= len(digits) <= 19 and luhn(digits):
        return (at, end), end
    return None, end


def luhn(digits) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit)
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _phone(text: str, at: int) -> tuple[Span | None, int]:
    """The phone at a plus sign, and where the next one may begin."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None, at + 1
    end = _run(text, at + 2, _PHONE)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:  # at least one character between the first and the last digit
        return None, at + 1
    count = sum(c in DIGITS for c in text[at:end])
    return ((at, end) if 10 <= count <= 15 else None), end


def _login(text: str, after: int) -> Span | None:
    """``user:password`` of ``://user:password@host``; ``after`` follows the scheme."""
    at, n = after, len(text)
    while at < n and text[at] not in _LINK and text[at] != "@":
        at += 1
    if at < n and text[at] == "@" and ":" in text[after:at] and at - after > 2:
        return after, at
    return None


def _account(text: str, after: int) -> Span | None:
    """The identifier behind a cue, past a few of `` .:#=``."""
    start = after
    while start < len(text) and start - after < 4 and text[start] in " .:#=":
        start += 1
    if start == after:
        return None
    end, count, digits = start, 0, 0
    while end < len(text):
        if text[end] in _ALNUM:
            count += 1
            digits += text[end] in DIGITS
            end += 1
        elif text[end] in " -" and end + 1 < len(text) and text[end + 1] in DIGITS:
            end += 1
        else:
            break
    return (start, end) if 6 <= count <= 34 and digits >= 4 else None


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), in order."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    added: list[tuple[str, int, int]] = []
    floor = dict.fromkeys(BASE, 0)
    folded = text.lower()
    if len(folded) != len(text):  # a letter whose lower case is longer would shift places
        folded = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for last, (anchor, length) in _anchors().iter(folded):
        at = last - length + 1
        if anchor == "digit":
            if at >= floor["ip"]:
                spans, floor["ip"] = _addresses(text, at)
                found += [("ip", *s) for s in spans]
            if at >= floor["card"]:
                span, floor["card"] = _card(text, at)
                if span:
                    found.append(("card", *span))
        elif anchor == "at":
            if at >= floor["email"] and (span := _email(text, at, floor["email"])):
                found.append(("email", *span))
                floor["email"] = span[1]
        elif anchor == "plus":
            if at >= floor["phone"]:
                span, floor["phone"] = _phone(text, at)
                if span:
                    found.append(("phone", *span))
        elif anchor == "scheme":
            if span := _login(text, last + 1):
                added.append(("login", *span))
        elif (at == 0 or not folded[at - 1].isalnum()) and (span := _account(text, last + 1)):
            added.append(("account", *span))
    for kind, start, end in added:
        if kind == "login" or all(end <= s or e <= start for _, s, e in found if s < end):
            found.append((kind, start, end))
    return sorted(set(found), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def join_spans(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _per_text(one: Callable, kind: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    return lambda texts: pa.array([one(x.as_py()) for x in texts], kind)


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def personal_data(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with an array column of (kind, start, end)."""
    one = lambda t: [dict(zip(("kind", "start", "end"), s)) for s in find_spans(t)]
    find = F.arrow_udf(
        _per_text(one, _SPANS), "array<struct<kind:string,start:bigint,end:bigint>>"
    )
    return docs.withColumn(spans, find(F.col(text)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets."""

    def one(value):
        if value is None:
            return None
        out, at = [], 0
        for kind, start, end in find_spans(value):
            if start >= at:
                out += [value[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*out, value[at:]])

    return docs.withColumn(text, F.arrow_udf(_per_text(one, pa.string()), "string")(F.col(text)))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of base spans, and all spans as text, per row."""

    def one(value):
        spans = find_spans(value)
        base = [s for s in spans if s[0] in BASE]
        counts = {f"n_{k}": sum(s[0] == k for s in base) for k in BASE}
        digest = hashlib.sha256(join_spans(base).encode()).hexdigest()
        return {**counts, "base_sha256": digest, "spans": join_spans(spans)}

    fields = [(f"n_{k}", pa.int64()) for k in BASE]
    kind = pa.struct([*fields, ("base_sha256", pa.string()), ("spans", pa.string())])
    sql = ",".join([*(f"n_{k}:bigint" for k in BASE), "base_sha256:string,spans:string"])
    report = F.arrow_udf(_per_text(one, kind), f"struct<{sql}>")
    return docs.select("doc_id", report("text").alias("r")).select("doc_id", "r.*")
