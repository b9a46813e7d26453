"""Substring dedup: lines and sentences that an earlier document has are cut out."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import decoded, stored, text_bytes

# A unit ends with its line, or with a sentence inside a line; white space goes with it.
# Full-width marks end a sentence without a space too. Every sentence is cut after commas
# as well, however long it is, so that a passage has the same units whether it is a
# sentence or stands in one. A clause that is short joins the next, at the end of a
# sentence the one before, so a passage loses one at either end at most.
_END = re.compile(
    r"[\n.!?,;:。！？｡，、；：](?:(?<=\n)\s*|(?<=[.!?,;:])[ \t]++(?!\s*\n)"
    r"|(?<=[。！？｡，、；：])(?![。！？｡，、；：\s]))"
)
_COMMAS = frozenset(",;:，、；：")

# Units of fewer words and characters are looked up together with their neighbours in the
# line. Characters are counted without white space, for scripts that put none between words.
UNIT_WORDS, UNIT_CHARS = 3, 16
# A run of repeated units is cut out if it has so many words or characters. Of a shorter
# one whole lines are cut, of any length if an earlier document has them,
RUN_WORDS, RUN_CHARS = 8, 24
# and of so many words or characters if only the text itself has them before.
LINE_WORDS, LINE_CHARS = 4, 16

# Rows that a task hands on at once.
_ROWS = 1 << 15

# Rank of a document without an id: after all others.
_LAST = (1 << 63) - 1


class Unit(NamedTuple):
    start: int
    end: int
    line: int
    words: list[str]


def units(text: str) -> list[Unit]:
    """The units of a text in code points; together they cover it."""
    found: list[Unit] = []
    begin = line = first = 0
    for match in _END.finditer(text):
        start, end = match.span()
        found.append(Unit(begin, end, line, text[begin:end].split()))
        begin = end
        if text[start] not in _COMMAS:
            if len(found) - first > 1:
                found[first:] = _joined(found[first:])
            first = len(found)
            line += text[start] == "\n"
    if begin < len(text):
        found.append(Unit(begin, len(text), line, text[begin:].split()))
    if len(found) - first > 1:
        found[first:] = _joined(found[first:])
    return found


def _joined(clauses: list[Unit]) -> list[Unit]:
    """The clauses of a sentence, short ones with their neighbours."""
    found: list[Unit] = []
    open_ = False
    for clause in clauses:
        if open_:
            found[-1] = _both(found[-1], clause)
        else:
            found.append(clause)
        open_ = not _is_long(found[-1].words)
    if open_ and len(found) > 1:
        last = found.pop()
        found[-1] = _both(found[-1], last)
    return found


def _both(one: Unit, other: Unit) -> Unit:
    return Unit(one.start, other.end, one.line, one.words + other.words)


def _is_long(words: list[str]) -> bool:
    return len(words) >= UNIT_WORDS or sum(map(len, words)) >= UNIT_CHARS


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.lower().encode("utf-8", "surrogatepass"), digest_size=16).digest()


def keys(text: str) -> Iterator[tuple[int, bytes]]:
    """Number and digest of each unit that has a word.

    Units are normalised to lower-case words with single spaces. A short one says little
    by itself: its digest is of it and its neighbours in the line, none for a whole line.
    """
    parts = units(text)
    for number, (_, _, line, words) in enumerate(parts):
        if _is_long(words):
            yield number, _digest(" ".join(words))
        elif words:
            near = [
                " ".join(parts[other].words) if 0 <= other < len(parts) and parts[other].line == line else ""
                for other in (number - 1, number, number + 1)
            ]
            yield number, _digest("\n".join(near))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, unit, again, h1, h2`` per unit that has a word.

    A unit that the same text has before has a second row, marked ``again``.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[int] = []
            unit: list[int] = []
            hashes: list[bytes] = []
            again: list[int] = []  # places in ``unit``

            def flush(until: int) -> Iterator[pa.RecordBatch]:
                """The units of the texts before ``until`` that were not handed on yet."""
                source = np.repeat(np.arange(until - len(counts), until), counts)
                both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                order = np.concatenate([np.arange(len(unit)), np.array(again, np.int64)])
                repeated = np.arange(len(order)) >= len(unit)
                number = np.array(unit, np.int32)
                for part in (counts, unit, hashes, again):
                    part.clear()
                for begin in range(0, len(order), _ROWS):
                    some = order[begin : begin + _ROWS]
                    index = pa.array(source[some])
                    columns = [
                        batch.column(0).take(index), batch.column(1).take(index), pa.array(number[some]),
                        pa.array(repeated[begin : begin + _ROWS]), pa.array(both[some, 0]), pa.array(both[some, 1]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

            for row, text in enumerate(batch.column(2)):
                seen: set[bytes] = set()
                begun = len(unit)
                for number, digest in keys(decoded(text)):
                    if digest in seen:
                        again.append(len(unit))
                    unit.append(number)
                    hashes.append(digest)
                    seen.add(digest)
                counts.append(len(unit) - begun)
                if len(unit) >= _ROWS:
                    yield from flush(row + 1)
            yield from flush(batch.num_rows)

    names = ["doc_id", "text_key", "unit", "again", "h1", "h2"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), text_bytes().alias("text"))
    extra = "CAST(0 AS INT) unit", "true AS again", "0L AS h1", "0L AS h2"
    return rows.mapInArrow(per_batch, rows.selectExpr("doc_id", "text_key", *extra).schema)


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, repeats``: the units of each text that an earlier one has.

    Digests are grouped over all documents, pre-aggregated, by their smallest doc_id;
    only digests of several documents are joined back. ``repeats`` holds unit numbers
    with the document that keeps the unit.
    """
    found = stored(digests(docs), "substring-units")
    rank = F.coalesce("doc_id", F.lit(_LAST))
    kept = found.where(~F.col("again")).groupBy("h1", "h2")
    kept = kept.agg(F.min(rank).alias("keep"), F.max(rank).alias("last")).where("last > keep")
    # Stored, so that a line of very many documents is a skewed key of a plain join.
    kept = stored(kept.drop("last"), "substring-kept")
    later = found.where(~F.col("again")).join(kept, ["h1", "h2"]).where(rank > F.col("keep"))
    later = later.select("doc_id", "text_key", "unit", "keep")
    again = found.where("again").select("doc_id", "text_key", "unit", F.col("doc_id").alias("keep"))
    each = later.unionByName(again).groupBy("doc_id", "text_key")
    return each.agg(F.collect_set(F.struct("unit", "keep")).alias("repeats"))


def _keepers(listed: list[dict]) -> dict[int, int | None]:
    """Who keeps each repeated unit; an earlier document before the text itself."""
    found: dict[int, int | None] = {}
    for unit, keep in ((r["unit"], r["keep"]) for r in listed):
        if unit not in found or keep is not None and (found[unit] is None or keep < found[unit]):
            found[unit] = keep
    return found


def cut(
    text: str, repeated: dict[int, int | None], own: int | None = None
) -> tuple[str, list[tuple[int, int, int | None]]]:
    """The text without repeated runs, and the runs: ``start, end`` and who keeps them.

    A run holds repeated units only. ``own`` is the keeper of units that only the text
    itself has before.
    """
    parts = units(text)
    sizes = [(len(part.words), sum(map(len, part.words))) for part in parts]
    lines: dict[int, list[int]] = {}
    for number, part in enumerate(parts):
        lines.setdefault(part.line, []).append(number)

    def reaches(numbers: list[int], least_words: int, least_chars: int) -> bool:
        found = [sizes[n] for n in numbers]
        return sum(w for w, _ in found) >= least_words or sum(c for _, c in found) >= least_chars

    whole = set()
    for numbers in lines.values():
        if all(n in repeated for n in numbers):
            earlier = all(repeated[n] != own for n in numbers)
            if earlier or reaches(numbers, LINE_WORDS, LINE_CHARS):
                whole.update(numbers)
    runs, i = [], 0
    while i < len(parts):
        j = i
        while j in repeated:
            j += 1
        cuts = range(i, j)
        if not reaches(list(cuts), RUN_WORDS, RUN_CHARS):
            cuts = [n for n in cuts if n in whole]
        for n in cuts:
            if runs and n != cuts[0] and runs[-1][1] == parts[n].start:
                runs[-1] = (runs[-1][0], parts[n].end, runs[-1][2])
            else:
                runs.append((parts[n].start, parts[n].end, repeated[n]))
        i = max(j, i + 1)
    left, done = [], 0
    for start, end, _ in runs:
        left.append(text[done:start])
        done = end
    return "".join([*left, text[done:]]), runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_removed, removed_words, removed`` for every row of ``doc_id, text``.

    ``text`` is what is left; ``removed`` lists the cut runs by their place in the
    original text, in code points, end exclusive, with the doc_id that keeps the run's
    first unit. The smallest doc_id keeps a unit, null after all others; within a text
    the first. Rows of the same doc_id rank the same, so repeated rows take nothing from
    each other. A null text counts as empty; bytes that are no UTF-8 become U+FFFD. An
    empty table gives no rows.
    """
    found = stored(repeats(docs), "substring-repeats")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), text_bytes().alias("text"))
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_key"] == found["text_key"])
    joined = rows.join(found, same, "left").select(rows["doc_id"], rows["text"], "repeats")
    run = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("keep_id", pa.int64())])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, words = [], [], []
            for doc_id, text, listed in zip(*batch.columns, strict=True):
                text, listed = decoded(text), listed.as_py()
                left, runs = cut(text, _keepers(listed), doc_id.as_py()) if listed else (text, [])
                texts.append(left)
                removed.append(
                    [
                        {"start": s, "end": e, "keep_id": None if k == _LAST else k}
                        for s, e, k in runs
                    ]
                )
                words.append(sum(len(text[s:e].split()) for s, e, _ in runs))
            columns = [
                batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, removed), pa.int64()),
                pa.array(words, pa.int64()), pa.array(removed, pa.list_(run)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "text", "n_removed", "removed_words", "removed"]
    schema = joined.selectExpr(
        "doc_id", "CAST(text AS STRING) AS text", "0L AS n_removed", "0L AS removed_words",
        "CAST(NULL AS array<struct<start: bigint, end: bigint, keep_id: bigint>>) AS removed",
    ).schema
    return joined.mapInArrow(per_batch, schema)
