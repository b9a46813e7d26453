"""Personal data by anchor expansion: an automaton finds cues, local parsers find bounds."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import decoded, text_bytes

# Kinds in the order in which spans of the same start are listed; the base ones first.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]

# Shapes of the base kinds, matched at an anchor.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Shapes of what the method adds.
_WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_IPV6 = re.compile(r"[0-9A-Fa-f:.]*")
_LOGIN = re.compile(r"[^\s/@:?#<>\"']+(?::[^\s/@?#<>\"']*)?@[\w.-]+(?::[0-9]+)?(?:/[^\s<>\"']*)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?:[ \t]*(?:no|nr|number|num|#|:|=|\.|is))*[ \t]*([0-9](?:[ -]?[0-9]){5,17})(?![0-9])", re.I)

# Words before an account number, in the languages of the texts, in any case.
CUES = (
    "iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte", "ssn",
    "passport", "customer id",
)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Most characters of an address of this kind.
_IPV6_CHARS = 45

_DIGITS = frozenset("0123456789")


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    base: bool
    checked: bool = True


def automaton() -> ahocorasick.Automaton:
    """Anchors: at-signs, plus signs, digits, schemes, double colons and cue words."""
    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, (0, 1))
    for number, anchor in enumerate(("@", "+", "://", "::"), 1):
        found.add_word(anchor, (number, len(anchor)))
    for cue in CUES:
        found.add_word(cue, (5, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def lowered(text: str) -> str:
    """The text with small letters, every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_LOWER)


def find(text: str, anchors: ahocorasick.Automaton) -> list[Span]:
    """All spans of a text in code points, by start and kind.

    Base spans are those of the fixed shapes, leftmost and not overlapping within a kind:
    an anchor inside the last match of its kind is passed over, and a match that fails its
    check is dropped without a second try.
    """
    spans: list[Span] = []
    email_end = ip_end = card_end = 0
    for last, (anchor, length) in anchors.iter(lowered(text)):
        at = last - length + 1
        if anchor == 0:
            if at >= ip_end and (at == 0 or text[at - 1] not in _DIGITS):
                match = _IP.match(text, at)
                if match:
                    ip_end = match.end()
                    if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                        spans.append(Span(at, 1, ip_end, True))
            if at >= card_end:
                match = _CARD.match(text, at)
                if match:
                    card_end = match.end()
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append(Span(at, 2, card_end, True))
            if at >= 2 and text[at - 1].isupper():
                spans += _iban(text, at - 2)
        elif anchor == 1:
            if at >= email_end:
                start = at
                while start > email_end and _LOCAL.match(text, start - 1):
                    start -= 1
                match = _DOMAIN.match(text, at + 1)
                if match and start < at:
                    email_end = match.end()
                    spans.append(Span(start, 0, email_end, True))
                else:
                    spans += _wide_email(text, at)
        elif anchor == 2:
            match = _PHONE.match(text, at)
            if match and 9 <= sum(c in _DIGITS for c in match[0]) <= 15:
                spans.append(Span(at, 3, match.end(), True))
        elif anchor == 3:
            spans += _login(text, at)
        elif anchor == 4:
            spans += _ipv6(text, at)
        else:
            spans += _account(text, at, last + 1)
    return sorted(set(spans), key=lambda s: (s.start, s.kind, s.end, not s.base))


def _wide_email(text: str, at: int) -> list[Span]:
    """An address with letters beyond ASCII, with a top level of two letters or more."""
    start = at
    while start and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
        start -= 1
    while start < at and text[start] in ".-":
        start += 1
    match = _WIDE_DOMAIN.match(text, at + 1)
    if not match or start == at or text[at - 1] == "." or text[start:match.end()].isascii():
        return []
    return [Span(start, 0, match.end(), False)]


def _ipv6(text: str, at: int) -> list[Span]:
    start, first = at, max(at - _IPV6_CHARS, 0)
    while start > first and text[start - 1] in "0123456789abcdefABCDEF:":
        start -= 1
    # One more than an address may have shows that the run is longer.
    end = _IPV6.match(text, at, at + _IPV6_CHARS + 1).end()
    while end > at and text[end - 1] == ".":
        end -= 1
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return []
    address = text[start:end]
    if address.count(":") < 3 or len(address) > _IPV6_CHARS:
        return []
    try:
        ipaddress.IPv6Address(address)
    except ValueError:
        return []
    return [Span(start, 1, end, False)]


def _login(text: str, at: int) -> list[Span]:
    """An address with a scheme that carries a user name."""
    match = _LOGIN.match(text, at + 3)
    start = at
    while start and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
        start -= 1
    if not match or start == at:
        return []
    end = match.end() - (len(match[0]) - len(match[0].rstrip(".,;:!?)")))
    return [Span(start, 4, end, False)]


def _iban(text: str, at: int) -> list[Span]:
    """An international account number with valid check digits."""
    match = None if at and text[at - 1].isalnum() else _IBAN.match(text, at)
    while match:
        number = match[0].replace(" ", "")
        if 15 <= len(number) <= 34:
            rearranged = number[4:] + number[:4]
            if int("".join(str(int(c, 36)) for c in rearranged)) % 97 == 1:
                return [Span(at, 5, match.end(), False)]
        # Words in capitals may follow the number: try without the last group.
        cut = text.rfind(" ", at, match.end())
        match = _IBAN.fullmatch(text, at, cut) if cut > at else None
    return []


def _account(text: str, at: int, end: int) -> list[Span]:
    """A number of 6 to 18 digits right after a cue word.

    Only after some cues its digits can be checked; after others a date or years are
    taken for what they look like, and anything else is not checked.
    """
    if at and text[at - 1].isalnum() or end < len(text) and text[end].isalpha():
        return []
    match = _NUMBER.match(text, end)
    if not match:
        return []
    number, digits = match[1], re.sub("[ -]", "", match[1])
    if text[at:end].lower() == "ssn":
        checked = len(digits) == 9 and _ssn(digits)
    elif _is_date(number, digits):
        return []
    else:
        checked = False
    return [Span(match.start(1), 5, match.end(1), False, checked)]


def _ssn(digits: str) -> bool:
    area, group, serial = digits[:3], digits[3:5], digits[5:]
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _is_date(number: str, digits: str) -> bool:
    """Eight digits that are a day, or groups that are all years."""
    groups = re.split("[ -]", number)
    if all(len(group) == 4 and group[:2] in ("19", "20") for group in groups):
        return True
    if len(digits) != 8 or len(groups) not in (1, 3):
        return False
    orders = ((digits[:4], digits[4:6], digits[6:]), (digits[4:], digits[2:4], digits[:2]))
    return any(y[:2] in ("19", "20") and 1 <= int(m) <= 12 and 1 <= int(d) <= 31 for y, m, d in orders)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones together, replaced by ``<kind>``."""
    parts, done, end = [], 0, 0
    for span in spans:
        if span.start >= end:
            parts += [text[done : span.start], f"<{KINDS[span.kind]}>"]
        end = max(end, span.end)
        done = end
    return "".join([*parts, text[done:]])


SPANS_TYPE = "array<struct<start: bigint, kind: string, end: bigint, base: boolean, checked: boolean>>"


def personal_data(docs: DataFrame, mask: bool = False) -> DataFrame:
    """``doc_id, spans`` for every row of ``doc_id, text``; with ``mask`` also ``masked``.

    Spans are by start, then kind, counted in code points, ends exclusive; ``base`` marks
    those of the fixed shapes, ``checked`` all but account numbers that no rule can check.
    No shuffle; a text is read whole in the task that has it. Bytes that are no UTF-8
    count as one U+FFFD for each that a decoder reports. A null text counts as empty and has no spans. Repeated rows are searched each. An
    empty table gives no rows. Other columns are not read.
    """
    fields = [
        ("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_()),
        ("checked", pa.bool_()),
    ]
    spans_type = pa.list_(pa.struct(fields))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            rows, hidden = [], []
            # One text at a time, so that a task holds no second copy of the batch.
            for value in batch.column(1):
                text = decoded(value)
                spans = find(text, anchors)
                rows.append([s._asdict() | {"kind": KINDS[s.kind]} for s in spans])
                if mask:
                    hidden.append(masked(text, spans))
            columns = [batch.column(0), pa.array(rows, spans_type)]
            if mask:
                columns.append(pa.array(hidden, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "spans", *(["masked"] if mask else [])]
    rows = docs.select("doc_id", text_bytes().alias("_text"))
    schema = rows.select("doc_id", F.lit(None).cast(SPANS_TYPE).alias("spans"))
    if mask:
        schema = schema.withColumn("masked", F.lit("").cast("string"))
    return rows.mapInArrow(per_batch, schema.schema)
