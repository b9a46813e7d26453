"""Token ids packed into rows of one length, by best fit decreasing."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import decoded, text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 2048

# Text that is packed together in one task, in bytes, on average.
SHARD_BYTES = 16 << 20

# The split of the vocabulary's own tokenizer, and its end-of-text id.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256

# What the split calls white space, and how long a run of it may be before
# the split's own search for its end outgrows its stack.
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def load_vocabulary(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of lines ``base64 rank``; at most 65,536 tokens fit."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if max(ranks.values(), default=0) >= 1 << 16:
        raise ValueError("ids must fit into 16 bits")
    return ranks


def encode(own: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text. Long runs of white space are cut out before the split, where it cuts too.

    A run before other characters leaves its last one to them; the others are one piece,
    as is a whole run at the end of the text.
    """
    parts, done = [], 0
    for run in _SPACES.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        parts.append(own.encode_to_numpy(text[done : run.start()], disallowed_special=()))
        parts.append(np.array(own._encode_single_piece(text[run.start() : end]), np.uint32))
        done = end
    parts.append(own.encode_to_numpy(text[done:], disallowed_special=()))
    return np.concatenate(parts)


def tokenize(docs: DataFrame, ranks: dict[bytes, int], length: int, end: int | None) -> DataFrame:
    """``doc_id, row, piece, n, ids``: each document's ids, cut into pieces of ``length``.

    ``ids`` are little-endian 16-bit numbers. ``end`` is put after each document. ``row``
    tells rows of the table apart.
    """
    # The vocabulary has a fixed size, about one MB.
    vocabulary = docs.sparkSession.sparkContext.broadcast(ranks)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tiktoken.Encoding(
            "own", pat_str=PATTERN, mergeable_ranks=vocabulary.value, special_tokens={}
        )
        for batch in batches:
            source, piece, sizes, data = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                ids = encode(own, decoded(text)).astype("<u2")
                if end is not None:
                    ids = np.append(ids, np.array([end], "<u2"))
                for number, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    source.append(row)
                    piece.append(number)
                    sizes.append(len(part))
                    data.append(part.tobytes())
            index = pa.array(source, pa.int64())
            columns = [
                batch.column(0).take(index), batch.column(1).take(index), pa.array(piece, pa.int32()),
                pa.array(sizes, pa.int32()), pa.array(data, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "piece", "n", "ids"])

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_bytes().alias("t"))
    schema = rows.selectExpr("doc_id", "row", "CAST(0 AS INT) piece", "CAST(0 AS INT) n", "t AS ids")
    return rows.mapInArrow(per_batch, schema.schema)


class Capacities:
    """Open rows by what still fits into them; a segment tree over 0 .. length counts them."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _count(self, free: int, change: int) -> None:
        node = free + self.leaves
        while node:
            self.tree[node] += change
            node >>= 1

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._count(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least free space of at least ``need``, with that space."""
        node, tree = need + self.leaves, self.tree
        while not tree[node]:
            # On to the next subtree on the right, or up while there is none.
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            node += not tree[node]
        free = node - self.leaves
        self._count(free, -1)
        return self.rows[free].pop(), free


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of piece numbers: largest pieces first, each where it leaves the least space."""
    open_rows, rows = Capacities(length), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = open_rows.take(size)
        if found is None:
            rows.append([piece])
            row, free = len(rows) - 1, length
        else:
            row, free = found
            rows[row].append(piece)
        open_rows.add(free - size, row)
    return rows


def pack_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    end: int | None = END_OF_TEXT,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Packed rows of all documents: one output row per row of an id matrix.

    ``shard, row`` name the matrix and its row; ``input_ids`` are ``length`` little-endian
    16-bit ids, padded with ``end`` or 0; ``cu_seqlens`` the segment borders 0 .. n_tokens;
    ``position_ids``, like the ids, restart at 0 with each segment, those of padding
    are 0. ``doc_ids`` and ``pieces`` name
    the segments. Documents longer than a row are cut into pieces, none lost.

    Pieces are dealt to shards by a hash of their place, of bounded size on average
    whatever the documents, and each shard is packed by itself: best fit decreasing,
    open rows searched in a segment tree. A null or empty text has just ``end``, or
    nothing without one. Repeated rows are packed each. An empty table gives no rows.
    """
    if not 0 < length < 1 << 16:
        raise ValueError("positions must fit into 16 bits")
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = total // shard_bytes + 1
    tokens = tokenize(docs, load_vocabulary(vocabulary), length, end)
    shard = F.pmod(F.xxhash64("row", "piece"), F.lit(shards))
    padding = end or 0

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sizes = table["n"].to_numpy()
        # An order of its own, so that a rerun packs alike.
        order = np.lexsort((table["piece"].to_numpy(), table["row"].to_numpy()))
        table, sizes = table.take(pa.array(order)), sizes[order]
        data, docs_, pieces = table["ids"], table["doc_id"], table["piece"]
        rows = best_fit_decreasing(sizes, length)
        matrix = np.full((len(rows), length), padding, "<u2")
        places = np.zeros((len(rows), length), "<u2")
        borders = []
        for row, members in enumerate(rows):
            at = 0
            border = [0]
            for piece in members:
                size = int(sizes[piece])
                matrix[row, at : at + size] = np.frombuffer(data[piece].as_py(), "<u2")
                places[row, at : at + size] = np.arange(size)
                at += size
                border.append(at)
            borders.append(border)
        flat = pa.array([piece for members in rows for piece in members], pa.int64())
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        return pa.table({
            "shard": pa.array(np.full(len(rows), table["shard"][0].as_py())),
            "row": pa.array(np.arange(len(rows))),
            "n_tokens": pa.array([border[-1] for border in borders], pa.int32()),
            "input_ids": pa.array([row.tobytes() for row in matrix], pa.binary()),
            "cu_seqlens": pa.array(borders, pa.list_(pa.int32())),
            "position_ids": pa.array([row.tobytes() for row in places], pa.binary()),
            "doc_ids": pa.ListArray.from_arrays(ends, docs_.take(flat).combine_chunks()),
            "pieces": pa.ListArray.from_arrays(ends, pieces.take(flat).combine_chunks()),
        })

    doc_type = dict(docs.select("doc_id").dtypes)["doc_id"]
    schema = (
        "shard bigint, row bigint, n_tokens int, input_ids binary, cu_seqlens array<int>, "
        f"position_ids binary, doc_ids array<{doc_type}>, pieces array<int>"
    )
    return tokens.withColumn("shard", shard).groupBy("shard").applyInArrow(pack, schema)
