"""Hard negatives: rotated one-bit codes bound every score, survivors are scored exactly.

A vector is taken from the mean of all, turned by a fixed random rotation and kept as the
signs of its parts: its code ``x``, of unit length. Stored with it is its alignment, the
product ``a`` of the turned vector and its code; what the code leaves, ``r = o - a * x``, is
coded by its own signs in the same way, LEVELS times, and the length of the last rest is
stored too. So the product of a row and an anchor is the sum of ``a * <x, q>`` over the
levels, give or take the length of the rest times that of the anchor, by Cauchy and
Schwarz, always. ``<x, q>`` comes from counts of common bits of the code and the bit planes
of the anchor's parts; what the planes leave of the anchor is bounded in the same way.
Rows whose interval cannot matter are passed over, all others scored in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.llm.common import stored

POSITIVES = 5
NEGATIVES = 10

SCALE = 256

# Bounds of a negative's score, in tenths of the positive's.
LEAST_TENTHS, MOST_TENTHS = 3, 9

# Bytes of anchors that are sent to all tasks at once; more anchors take another pass.
ANCHOR_BYTES = 8 << 20

# Anchors and rows that are compared at a time.
ANCHORS, ROWS = 64, 2048

# Codes of a row, one of what the other leaves, and bits of an anchor's part.
LEVELS = 4
PLANES = 6

SEED = 42

# Above every score.
_BEYOND = np.int64(1 << 62)

_RESULT = (
    "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, positive_score BIGINT,"
    " negative_score BIGINT"
)


# -- index --------------------------------------------------------------------------


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same for the same size and seed."""
    made, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return made * np.sign(np.diag(upper))


@dataclass(frozen=True)
class Shape:
    """What all tasks must agree on: dimensions, their mean and the rotation."""

    size: int
    mean: np.ndarray
    turn: np.ndarray

    @property
    def words(self) -> int:
        return -(-self.size // 64)

    @property
    def side(self) -> float:
        """Length of a vector of signs."""
        return math.sqrt(self.size)


def _padded(vectors: pa.Array, size: int) -> np.ndarray:
    """Integer vectors as a matrix, shorter ones filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    made = np.zeros((len(lengths), size), np.int64)
    made[np.arange(size) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return made


def _packed_bits(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    bytes_ = np.packbits(bits, axis=1, bitorder="little")
    full = np.zeros((len(bits), words * 8), np.uint8)
    full[:, : bytes_.shape[1]] = bytes_
    return full.view(np.uint64)


def encode(vectors: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, alignments and the length of the last rest of integer vectors.

    Codes of all levels lie side by side, ``shape.words`` words for each.
    """
    rest = (vectors - shape.mean) @ shape.turn
    codes, aligned = [], []
    for _ in range(LEVELS):
        up = rest > 0
        along = np.abs(rest).sum(1) / shape.side
        rest = rest - np.where(up, 1, -1) * (along / shape.side)[:, None]
        codes.append(_packed_bits(up, shape.words))
        aligned.append(along)
    return np.hstack(codes), np.stack(aligned, 1), np.sqrt((rest * rest).sum(1))


def valid_rows(rows: DataFrame) -> DataFrame:
    """``vec_id, label, q``: rows that take part, with integer components.

    ``q`` is ``floor(256 * x)``. No part is taken by rows with a null id, label or
    vector, a null or non-finite component, or one so large that a row's product with
    itself could leave 64-bit integers.
    """
    sound = F.forall("x", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    given = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
    # Ten times a product must fit as well.
    most = F.floor(F.sqrt(F.lit(float(1 << 62)) / (10 * F.greatest(F.size("x"), F.lit(1)))))
    scaled = F.transform("x", lambda x: F.floor(x * SCALE))
    fits = F.forall("x", lambda x: F.abs(x) * SCALE < most)
    return given.where(sound).where(fits).select("vec_id", "label", scaled.alias("q"))


def build_index(rows: DataFrame) -> tuple[DataFrame, Shape]:
    """The stored index of ``vec_id, label, q`` and what its codes were made with.

    The index adds ``code``, ``align`` and ``rest``. One count and sum per dimension and
    task decides the mean; nothing is sampled.
    """
    size = max(1, rows.agg(F.max(F.size("q")).alias("longest")).first().longest or 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(size), 0
        for batch in batches:
            count += batch.num_rows
            total += _padded(batch.column(0), size).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([count], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))],
            names=["n", "total"],
        )

    parts = rows.select("q").mapInArrow(sums, "n BIGINT, total ARRAY<DOUBLE>")
    by_place = parts.select("n", F.posexplode("total").alias("place", "part"))
    found = by_place.groupBy("place").agg(F.sum("n").alias("n"), F.sum("part").alias("part")).collect()
    mean = np.zeros(size)
    for row in found:
        mean[row.place] = row.part / max(row.n, 1)
    shape = Shape(size, mean, rotation(size))
    shared = rows.sparkSession.sparkContext.broadcast((size, mean, shape.turn))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Shape(*shared.value)
        for batch in batches:
            made, align, rest = encode(_padded(batch.column(2), size), known)
            arrays = [
                pa.array([row.tobytes() for row in made], pa.binary()),
                pa.array(align.tolist(), pa.list_(pa.float64())), pa.array(rest),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=["vec_id", "label", "q", "code", "align", "rest"]
            )

    schema = "vec_id BIGINT, label BIGINT, q ARRAY<BIGINT>, code BINARY, align ARRAY<DOUBLE>, rest DOUBLE"
    return stored(rows.mapInArrow(codes, schema), "vectors"), shape


# -- bounds -------------------------------------------------------------------------


class Anchors:
    """Anchors of one pass: integer vectors, and bit planes of their turned vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, shape: Shape) -> None:
        self.ids, self.labels, self.q, self.size, self.side = ids, labels, q, shape.size, shape.side
        turned = q @ shape.turn
        self.norms2 = (turned * turned).sum(1)
        self.with_mean = q @ shape.mean
        low = turned.min(1, initial=0)
        steps = (turned.max(1, initial=0) - low) / ((1 << PLANES) - 1)
        self.low, self.steps = low, np.where(steps > 0, steps, 1.0)
        levels = np.rint((turned - low[:, None]) / self.steps[:, None]).astype(np.int64)
        self.level_sums = levels.sum(1)
        rest = turned - low[:, None] - self.steps[:, None] * levels
        self.rests = np.sqrt((rest * rest).sum(1))
        self.planes = [_packed_bits(levels >> p & 1 == 1, shape.words) for p in range(PLANES)]

    @classmethod
    def restored(cls, parts: dict) -> Anchors:
        """Anchors in a task, which gets their parts as plain arrays."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def bounds(
        self, some: slice, codes: np.ndarray, align: np.ndarray, rest: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor (rows) with each row's codes (columns).

        With signs s = 2b - 1 and parts low + step * level, the sum of s * part is
        2 * step * (levels at set bits) + 2 * low * (set bits) - (sum of all parts).
        """
        low, step = self.low[some, None], self.steps[some, None]
        whole = (self.size * self.low[some] + self.steps[some] * self.level_sums[some])[:, None]
        middle = np.repeat(self.with_mean[some, None], len(codes), 1)
        words = codes.shape[1] // align.shape[1]
        for level in range(align.shape[1]):
            code = codes[:, level * words : (level + 1) * words]
            common = np.zeros(middle.shape, np.int64)
            for p, plane in enumerate(self.planes):
                for w in range(words):
                    common += np.bitwise_count(plane[some, w, None] & code[None, :, w]).astype(np.int64) << p
            ones = np.bitwise_count(code).sum(1, dtype=np.int64)
            middle += (2 * step * common + 2 * low * ones - whole) * (align[:, level] / self.side)
        # What the codes leave of a row, and the planes of an anchor: the sum of the
        # codes is as long as the alignments together at most.
        norm = np.sqrt(self.norms2[some, None])
        reach = rest * norm + align.sum(1) * self.rests[some, None]
        # Rounding of doubles, far below one part in 10 ** 9 of the lengths.
        reach += 1e-6 + 1e-9 * (norm * (align.sum(1) + rest) + np.abs(self.with_mean[some, None]))
        return middle - reach, middle + reach

    def pair(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors and rows for integer products; as doubles where these are exact, and faster."""
        most = float(np.abs(self.q).max(initial=0)) * float(np.abs(q).max(initial=0)) * self.size
        kind = np.float64 if most < 1 << 52 else np.int64
        return self.q.astype(kind, copy=False), q.astype(kind, copy=False)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Ids, labels, vectors, codes, alignments and rests of some rows of the index."""
    for whole in batches:
        for begin in range(0, whole.num_rows, ROWS):
            batch = whole.slice(begin, ROWS)
            ids, labels, rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 5))
            codes = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64)
            align = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            both = (values.reshape(batch.num_rows, -1) for values in (codes, align))
            yield ids, labels, _padded(batch.column(2), size), *both, rest


def _merged(kept: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The first ``most`` of (-score, id), kept ones and new ones."""
    return sorted(kept + list(zip((-scores).tolist(), ids.tolist(), strict=True)))[:most]


def _pair_batch(anchor: list[int], rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [anchor, *(list(c) for c in zip(*rows, strict=True))] if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


# -- search -------------------------------------------------------------------------


def _best_positives(index: DataFrame, anchors: Anchors, most: int) -> DataFrame:
    """``anchor_id, vec_id, score``: the first ``most`` of the anchor's label, per anchor."""
    shared = index.sparkSession.sparkContext.broadcast(vars(anchors))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Anchors.restored(shared.value)
        kept: list[list[tuple[int, int]]] = [[] for _ in known.ids]
        least = np.full(len(known.ids), -_BEYOND)
        for ids, labels, q, *codes in _blocks(batches, known.size):
            own, q = known.pair(q)
            for begin in range(0, len(known.ids), ANCHORS):
                some = slice(begin, begin + ANCHORS)
                fit = (labels == known.labels[some, None]) & (ids != known.ids[some, None])
                fit &= known.bounds(some, *codes)[1] >= least[some, None]
                for i in begin + np.flatnonzero(fit.any(1)):
                    at = np.flatnonzero(fit[i - begin])
                    scores = (q[at] @ own[i]).astype(np.int64)
                    good = scores >= least[i]
                    kept[i] = _merged(kept[i], scores[good], ids[at[good]], most)
                    if len(kept[i]) == most:
                        least[i] = -kept[i][-1][0]
        pairs = [(int(known.ids[i]), row) for i, rows in enumerate(kept) for row in rows]
        yield _pair_batch([a for a, _ in pairs], [(row[1], -row[0]) for _, row in pairs], ["anchor_id", "vec_id", "score"])

    found = index.mapInArrow(per_task, "anchor_id BIGINT, vec_id BIGINT, score BIGINT")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _best_negatives(
    index: DataFrame, anchors: Anchors, positives: np.ndarray, most: int, least_tenths: int, most_tenths: int
) -> DataFrame:
    """``anchor_id, place, vec_id, score``: for each anchor and positive the first ``most``.

    ``positives`` has the score of each anchor's positive at each place, or _BEYOND.
    """
    shared = index.sparkSession.sparkContext.broadcast((vars(anchors), positives))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, given = shared.value
        known = Anchors.restored(parts)
        places = given.shape[1]
        # Just the integers between these are within the bounds.
        there = given != _BEYOND
        low = np.where(there, -(-np.where(there, given, 0) * least_tenths // 10), _BEYOND)
        high = np.where(there, np.where(there, given, 0) * most_tenths // 10, -_BEYOND)
        kept: list[list[tuple[int, int]]] = [[] for _ in range(len(known.ids) * places)]
        for ids, labels, q, *codes in _blocks(batches, known.size):
            own, q = known.pair(q)
            for begin in range(0, len(known.ids), ANCHORS):
                some = slice(begin, begin + ANCHORS)
                smallest, greatest = known.bounds(some, *codes)
                fit = np.zeros(smallest.shape, bool)
                for p in range(places):
                    fit |= (greatest >= low[some, p, None]) & (smallest <= high[some, p, None])
                fit &= (labels != known.labels[some, None]) & (ids != known.ids[some, None])
                for i in begin + np.flatnonzero(fit.any(1)):
                    at = np.flatnonzero(fit[i - begin])
                    scores = (q[at] @ own[i]).astype(np.int64)
                    for p in range(places):
                        good = np.flatnonzero((scores >= low[i, p]) & (scores <= high[i, p]))
                        if len(good) > 4 * most:
                            bar = np.partition(scores[good], -most)[-most]
                            good = good[scores[good] >= bar]
                        if len(good):
                            number = i * places + p
                            kept[number] = _merged(kept[number], scores[good], ids[at[good]], most)
                            if len(kept[number]) == most:
                                low[i, p] = -kept[number][-1][0]
        pairs = [(n, row) for n, rows in enumerate(kept) for row in rows]
        yield _pair_batch(
            [int(known.ids[n // places]) for n, _ in pairs],
            [(n % places + 1, row[1], -row[0]) for n, row in pairs],
            ["anchor_id", "place", "vec_id", "score"],
        )

    found = index.mapInArrow(per_task, "anchor_id BIGINT, place BIGINT, vec_id BIGINT, score BIGINT")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _anchor_batches(index: DataFrame, every: int, shape: Shape) -> Iterator[Anchors]:
    """All anchors, a bounded number at a time."""
    chosen = index.where(F.col("vec_id") % every == 0)
    # Repeated ids: one anchor each, that of the smallest label and vector.
    once = chosen.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("a")).select("vec_id", "a.*")
    once = stored(once, "anchors")
    fits = max(1, ANCHOR_BYTES // (8 * max(shape.size, POSITIVES * NEGATIVES)))
    batches = -(-once.count() // fits)
    for number in range(batches):
        some = once.where(F.pmod(F.xxhash64("vec_id"), F.lit(batches)) == number).orderBy("vec_id")
        table = some.toArrow().combine_chunks()
        if table.num_rows:
            ids, labels, q = (table.column(i).combine_chunks() for i in range(3))
            yield Anchors(ids.to_numpy(), labels.to_numpy(), _padded(q, shape.size), shape)


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_tenths: int = LEAST_TENTHS,
    most_tenths: int = MOST_TENTHS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, embedding, label``. Anchors are the rows whose vec_id is
    divisible by ``every``; their positives are the rows of highest score of the same
    label, at most ``positives``; for each positive the ``negatives`` highest scores of
    other labels between the bounds are given. A score is the product of the integer
    vectors; equal ones are ordered by vec_id.

    All rows are compared with all anchors, in blocks: a bounded number of anchors is
    sent to all tasks, each of which reads its rows once and gives its best. A shorter
    vector counts as filled up with zeros. Rows that share a vec_id are rows of their
    own, but no row is compared with an anchor of its id, and of several anchors with
    one id the smallest label and vector counts. Nulls: see ``valid_rows``. An empty
    table, or one without anchors, gives no rows. Other columns are not read.
    """
    session: SparkSession = rows.sparkSession
    index, shape = build_index(valid_rows(rows))
    result = session.createDataFrame([], _RESULT)
    for anchors in _anchor_batches(index, every, shape):
        found = stored(_best_positives(index, anchors, positives), "positives")
        scores = np.full((len(anchors.ids), positives), _BEYOND)
        # At most as many rows as anchors were sent, times ``positives``.
        for row in found.select("anchor_id", "place", "score").collect():
            scores[np.searchsorted(anchors.ids, row.anchor_id), row.place - 1] = row.score
        worst = _best_negatives(index, anchors, scores, negatives, least_tenths, most_tenths)
        named = found.select(
            "anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        pairs = worst.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        joined = pairs.join(named, ["anchor_id", "place"])
        result = result.unionByName(joined.select(*result.columns))
    return result
