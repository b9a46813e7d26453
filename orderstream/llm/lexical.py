"""Ranked lexical search that scores every class of equal term bags once.

Only the terms of the items count for a document, so documents are reduced to those
terms with their frequencies and the length factor m. Equal reductions are one class:
rows meet by a hash, and the bags themselves are part of the key, so different bags
never share a class. Classes are scored, and only the best are expanded to documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.llm.common import stored, text_bytes

TOP = 20

# Bytes of item text whose terms are looked up together; more items take another pass.
VOCABULARY_BYTES = 4 << 20

# Places of the table of weights (terms x items) that a scoring task holds.
WEIGHTS = 1 << 22

# Classes that a task scores before it looks at the best again.
CLASSES = 256

# Bytes that belong to no term become spaces, A-Z become a-z. Bytes of
# characters beyond ASCII belong to terms.
_ASCII_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 128 else ord(chr(c).lower()) if c in _ASCII_TERM else 32 for c in range(256))

_RESULT = "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT"


def terms(data: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return data.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# -- reduced documents --------------------------------------------------------------


def _bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag``: number of terms, and the known ones as (number, count) pairs.

    Pairs are sorted by number, as little-endian 32-bit words.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                sizes.append(len(words))
                counts = Counter(words)
                pairs = sorted((numbers[w], c) for w, c in counts.items() if w in numbers)
                bags.append(np.array(pairs, "<u4").tobytes())
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "bag"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("_text_utf8"))
    return rows.mapInArrow(per_batch, "doc_id BIGINT, n BIGINT, bag BINARY")


def _document_counts(classes: DataFrame, size: int) -> np.ndarray:
    """In how many documents each known term is; one row per term and task meets."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for bag, members in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[np.frombuffer(bag.as_py(), "<u4")[::2]] += members
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["term", "df"])

    found = classes.select("bag", "size").mapInArrow(per_task, "term BIGINT, df BIGINT")
    total = np.zeros(size, np.int64)
    for row in found.groupBy("term").agg(F.sum("df").alias("df")).collect():
        total[row.term] = row.df
    return total


# -- scores -------------------------------------------------------------------------


class _Best:
    """The classes of highest score per item, equal scores by the smallest doc_id.

    A class whose smallest doc_id comes after that of ``top`` better classes has no
    document among the first ``top``.
    """

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, classes: list[tuple]) -> None:
        """Scores of classes (rows) for items (columns)."""
        fit = scores >= self.least
        for item in np.flatnonzero(fit.any(0)):
            some = np.flatnonzero(fit[:, item])
            found = self.rows[item] + [(-int(scores[i, item]), *classes[i]) for i in some]
            found.sort(key=lambda row: (row[0], row[1] is None, row[1] or 0, row[2:]))
            self.rows[item] = found[: self.top]
            if len(found) >= self.top:
                self.least[item] = -found[self.top - 1][0]


def _scored(
    classes: DataFrame, block: list[tuple[int, dict[int, int]]], weights: np.ndarray, top: int
) -> DataFrame:
    """``item, score, first, m, bag``: per task and item the best classes.

    ``block`` has the number of an item and how often it has each known term.
    """
    used = sorted({term for _, counts in block for term in counts})
    places = np.full(len(weights), -1, np.int64)
    places[used] = np.arange(len(used))
    table = np.zeros((len(used), len(block)), np.int64)
    for column, (_, counts) in enumerate(block):
        for term, repeats in counts.items():
            table[places[term], column] = repeats * weights[term]
    shared = classes.sparkSession.sparkContext.broadcast((places, table, [item for item, _ in block]))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, table, items = shared.value
        best = _Best(len(items), top)
        for whole in batches:
            for begin in range(0, whole.num_rows, CLASSES):
                batch = whole.slice(begin, CLASSES)
                rows = list(zip(*(column.to_pylist() for column in batch.columns), strict=True))
                scores = np.zeros((len(rows), len(items)), np.int64)
                for i, (_, m, bag) in enumerate(rows):
                    pairs = np.frombuffer(bag, "<u4").reshape(-1, 2).astype(np.int64)
                    at = places[pairs[:, 0]]
                    at, tf = at[at >= 0], pairs[at >= 0, 1]
                    scores[i] = (10**9 * tf // (1000 * tf + 12 * m)) @ table[at]
                best.add(scores, rows)
        found = [(items[i], -row[0], *row[1:]) for i, rows in enumerate(best.rows) for row in rows]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "score", "first", "m", "bag"])

    schema = "item BIGINT, score BIGINT, first BIGINT, m BIGINT, bag BINARY"
    return classes.select("first", "m", "bag").mapInArrow(per_task, schema)


def _search_vocabulary(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """The best documents for items ``number, item_id, terms`` whose terms are known at once."""
    vocabulary = {word: i for i, word in enumerate(sorted({word for item in items for word in item[2]}))}
    session = docs.sparkSession
    bags = stored(_bags(docs, vocabulary), "lexical-bags")
    totals = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not totals.docs:
        return session.createDataFrame([], _RESULT)
    m = F.expr(f"75 + (25 * n * {totals.docs}) div {totals.terms}")
    keyed = bags.where(F.length("bag") > 0).withColumn("m", m)
    keyed = keyed.withColumn("key", F.xxhash64("m", "bag"))
    same = keyed.groupBy("key", "m", "bag")
    classes = stored(
        same.agg(F.count("*").alias("size"), F.min("doc_id").alias("first")), "lexical-classes"
    )
    df = _document_counts(classes, len(vocabulary))
    weights = np.array([weight(totals.docs, int(count)) for count in df], np.int64)
    counted = [(number, Counter(vocabulary[word] for word in words)) for number, _, words in items]
    scored = None
    # The table of a block has at most as many terms as its items have together.
    for begin, end in _item_blocks([len(counts) for _, counts in counted]):
        found = _scored(classes, counted[begin:end], weights, top)
        scored = found if scored is None else scored.unionByName(found)
    first = Window.partitionBy("item").orderBy(
        F.desc("score"), F.col("first").asc_nulls_last(), "m", "bag"
    )
    winners = scored.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top)
    winners = winners.withColumn("key", F.xxhash64("m", "bag"))
    winners = stored(winners.select("item", "score", "key", "m", "bag"), "lexical-winners")
    # Of a class, the first members are enough for any item that it wins.
    wanted = winners.select("key", "m", "bag").distinct()
    members = keyed.join(wanted.select("key").distinct(), "key", "left_semi")
    members = members.join(wanted, ["key", "m", "bag"], "left_semi")
    by_id = Window.partitionBy("key", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    members = members.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= top)
    expanded = winners.join(members.select("key", "m", "bag", "doc_id"), ["key", "m", "bag"])
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = expanded.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    names = session.createDataFrame([(number, item_id) for number, item_id, _ in items], "item BIGINT, item_id BIGINT")
    # As many rows as items whose terms fit into one vocabulary.
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _item_blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of items whose table of weights has at most WEIGHTS places, or a single item."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and (total + size) * (i + 1 - begin) > WEIGHTS:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``. Terms are maximal
    runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
    lower-cased. Statistics cover all documents. Items are read in batches by the length
    of their texts; each batch takes a pass over the documents, and tasks hold its terms.

    A null or empty text has no terms and no result. Equal scores are ordered by
    doc_id, null last. Rows that share an id are documents, or items, of their own.
    A document without a common term, or with a score of 0, is no result. Empty tables
    give no rows. Other columns are not read.
    """
    session = docs.sparkSession
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_bytes().alias("_text"))
    total = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    batches = max(1, math.ceil(total / VOCABULARY_BYTES))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("item_id", "_text"), F.lit(batches)))
    result = session.createDataFrame([], _RESULT)
    for number in range(batches):
        # About VOCABULARY_BYTES of text, ordered for equal results on a rerun.
        some = rows.where(F.col("_part") == number).orderBy("item_id", "_text").collect()
        found = [(i, row.item_id, terms(bytes(row["_text"]))) for i, row in enumerate(some)]
        if any(words for _, _, words in found):
            result = result.unionByName(_search_vocabulary(docs, found, top))
    return result
