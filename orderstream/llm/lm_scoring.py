"""LM scoring by online logistic mixing of hashed-context bit predictors.

A text is the sequence of its lower-case words and an end. A word of the vocabulary is
written as bits: the class of its frequency rank, then its place in the class. Any other
word is an escape followed by its bytes and a space, as bits of a byte code. Each bit is
predicted by PREDICTORS hashed contexts from counts of zeros and ones; their log odds are
combined by weights that a gate chooses, and the mix is refined by an adaptive map.

Learning is online: every task goes through its training texts in blocks and predicts a
block before it counts it, so weights and refinement are fitted to bits the counts have
not seen. Counts of all tasks are added up, weights averaged by the bits they saw. Texts
are scored with what all of them learned, so a score depends on no order.
"""

from __future__ import annotations

import ctypes
import heapq
import re
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import stored, text_bytes, word_blocks

# Words beyond the vocabulary are spelled and looked up by a join.
VOCABULARY = (1 << 18) - 1
WORD_BYTES = 64
# Least sizes of the context tables. They double whenever the training tokens grow fourfold,
# as new contexts turn up about with the root of the text read, up to MOST_DOUBLED times:
# by then 2^38 tokens were read, and a learning task holds 1.2 GB of counts.
SLOT_BITS = (20, 18, 20)
FIRST_DOUBLED = 28
MOST_DOUBLED = 6

PREDICTORS = 4
# Ranks up to which the word before, the last common word, and the last word common
# enough to tell the language, are contexts of their own. The first two double with the tables.
BEFORE, COMMON, TELLING = 1024, 256, 16
# Bits of a place in a class that are predicted by all contexts; the finer ones by their
# own counts and those after the last telling word only.
SHALLOW = 4
# Words that a task gathers before it hands their counts on.
COUNTED = 1 << 22
# Bytes of a block, and of a text after which contexts begin anew, so that blocks stay bounded.
PART_BYTES = 1 << 16
# Spellings whose score a task remembers.
SPELLED = 1 << 18
# Tables that one task adds up.
FAN_IN = 64
CHUNK = 1 << 16

# The first table has a slot for each node of the vocabulary, and some for spelled words.
_SPELLED = VOCABULARY + 65
_NODES = _SPELLED + (1 << 16)
# Predictors whose confidence chooses the weights.
_ASKED = (1, 3)
_GATES = 2 * 36 + 6
_STEPS = 33
_STAGES = 64
_PRIOR = 0.2
_FINE = 16
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# -- word counts --------------------------------------------------------------------


def held_out() -> Column:
    """Whether a document is kept from training; a null id has the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over the column ``t``; tasks count what they read first."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[pa.Array] = []
        words: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts = pa.chunked_array([*gathered, pa.array(words, pa.binary())]).value_counts()
            gathered.clear()
            words.clear()
            return pa.RecordBatch.from_arrays(counts.flatten(), names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                for block in word_blocks(text.as_py().lower()):
                    words += block
                    size += len(block)
                    if len(words) >= CHUNK:
                        gathered.append(pa.array(words, pa.binary()))
                        words.clear()
                    if size >= COUNTED:
                        yield flush()
                        size = 0
        yield flush()

    parts = texts.select("t").mapInArrow(per_batch, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


# -- codes --------------------------------------------------------------------------


def _huffman(weights: list[int]) -> list[list[tuple[int, int]]]:
    """Paths ``(inner node, bit)`` of each symbol in a code for the given weights."""
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    heap = [(weight, symbol, (symbol,)) for symbol, weight in enumerate(weights)]
    heapq.heapify(heap)
    for node in range(len(weights) - 1):
        pair = heapq.heappop(heap), heapq.heappop(heap)
        for bit, (_, _, symbols) in enumerate(pair):
            for symbol in symbols:
                paths[symbol].append((node, bit))
        heapq.heappush(
            heap, (pair[0][0] + pair[1][0], min(pair[0][1], pair[1][1]), pair[0][2] + pair[1][2])
        )
    return [path[::-1] for path in paths]


@dataclass
class Code:
    """Paths of a small code as flat arrays: ``begin[s] .. begin[s] + size[s]``."""

    begin: np.ndarray
    size: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, weights: list[int]) -> Code:
        paths = _huffman(weights)
        size = np.array([len(path) for path in paths], np.int64)
        flat = [step for path in paths for step in path]
        return cls(
            np.cumsum(size) - size,
            size,
            np.array([node for node, _ in flat], np.uint32),
            np.array([bit for _, bit in flat], np.uint8),
        )


# Symbol classes: the end, the escape, then ranks of 0, 1, 2 ... bits.
_END, _ESCAPE, _RANKS = 0, 1, 2


@dataclass
class RareWords:
    """Shares of escaped tokens: words seen but not in the vocabulary, by their count.

    Words seen once are expected as often as words seen twice are by chance, unseen ones
    as often as words were seen once (the estimate of Good and Turing).
    """

    once: int
    twice: int
    more: int  # tokens of words seen more than once that are not in the vocabulary

    @property
    def known(self) -> float:
        """Share of known words among escaped tokens."""
        seen = self.more + 2 * self.twice
        return (seen + 0.5) / (seen + self.once + 1)

    def score(self, count: Column, spelled: Column) -> Column:
        """log10 of a word's share, from its count (null if unseen) and its spelling's."""
        each = F.when(count > 1, count).otherwise(F.lit((2 * self.twice + 0.5) / max(self.once, 1)))
        mass = self.more + 2 * self.twice + 0.5
        listed = F.log10(each * F.lit(self.known / mass))
        other = spelled + F.lit(float(np.log10(1 - self.known)))
        high, low = F.greatest(listed, other), F.least(listed, other)
        return F.when(count > 0, high + F.log10(1 + F.pow(F.lit(10.0), low - high))).otherwise(other)


@dataclass
class Lexicon:
    """What learning and scoring share: words by rank, corpus totals and the two codes."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    ends: int
    rare: RareWords
    classes: Code
    letters: Code
    doubled: int = 0  # times that the context tables were

    @property
    def slots(self) -> tuple[int, ...]:
        """Slots of each predictor."""
        return _NODES, *(1 << bits + self.doubled for bits in SLOT_BITS)

    def base(self, count: np.ndarray | int) -> np.ndarray:
        """log10 of the smoothed share of a token with such a count."""
        return np.log10((count + 0.1) / (self.total + 0.1 * (self.distinct + 1)))


def doublings(tokens: int) -> int:
    """How often the context tables are doubled for a corpus of so many training tokens."""
    return min(max((tokens.bit_length() + 1 - FIRST_DOUBLED) // 2, 0), MOST_DOUBLED)


def lexicon(counts: DataFrame, documents: int, size: int = VOCABULARY) -> Lexicon:
    """The ``size`` most frequent words of ``word, n``, and totals over all of them."""
    tokens, distinct, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    # Words seen once are left out, so that learning meets words to spell as scoring will.
    short = counts.where((F.octet_length("word") <= WORD_BYTES) & (F.col("n") > 1))
    top = short.orderBy(F.desc("n"), "word").limit(size).toArrow()
    ranked = top["n"].to_numpy().astype(np.int64)
    letters = _letter_counts(counts)
    classes = [documents + 1, tokens - int(ranked.sum()) + 1]
    for bits in range(max(size.bit_length(), 1)):
        classes.append(int(ranked[(1 << bits) - 1 : (1 << (bits + 1)) - 1].sum()) + 1)
    return Lexicon(
        top["word"].to_pylist(),
        ranked, tokens + documents, distinct + (documents > 0), documents,
        RareWords(once, twice, tokens - int(ranked.sum()) - once),
        Code.of(classes), Code.of(letters), doublings(tokens),
    )


def _letter_counts(counts: DataFrame) -> list[int]:
    """Bytes over the distinct words, each once, and a space after each; at least one."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, np.int64)
        for batch in batches:
            data = b" ".join(word.as_py() for word in batch.column(0)) + b" "
            seen += np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        columns = [pa.array(np.arange(256)), pa.array(seen)]
        yield pa.RecordBatch.from_arrays(columns, names=["byte", "n"])

    each = counts.select("word").mapInArrow(per_batch, "byte bigint, n bigint")
    found = {row["byte"]: row["n"] for row in each.groupBy("byte").agg(F.sum("n").alias("n")).collect()}
    return [found.get(byte, 0) + 1 for byte in range(256)]


# -- bits of a block of texts -------------------------------------------------------


@dataclass
class Bits:
    """One entry per bit: its owner, its value, a slot per predictor, and its stage.

    The first bits are of ranks, up to ``spelled``, the rest of spelled words. Bits of
    ranks are owned by their text, those of letters by their word's number. The finer
    bits of ranks are given by token: ``text``, ``symbol`` and the last ``telling`` word.
    """

    owner: np.ndarray
    value: np.ndarray
    slots: list[np.ndarray]
    spelled: int
    stage: np.ndarray
    text: np.ndarray
    symbol: np.ndarray
    telling: np.ndarray


def _taken(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    return table.take(index, mode="clip")  # all are inside; this skips the test


class _Writer:
    """Arrays for a number of bits, filled slice by slice."""

    def __init__(self, size: int, slots: tuple[int, ...]) -> None:
        self.at = 0
        self.shifts = [np.uint32(33 - size.bit_length()) for size in slots]
        self.owner = np.empty(size, np.int64)
        self.value = np.empty(size, np.uint8)
        self.stage = np.empty(size, np.int32)
        self.slots = [np.empty(size, np.uint32) for _ in range(PREDICTORS)]

    def put(
        self, owner: np.ndarray, node: np.ndarray, value: np.ndarray, stage: int,
        contexts: list[np.ndarray], first: np.ndarray | None = None,
    ) -> None:
        """Adds one bit for each of the given tokens or letters.

        The first predictor's slot is the node itself, if none is given.
        """
        here = slice(self.at, self.at + len(node))
        self.at = here.stop
        self.owner[here] = owner
        self.value[here] = value
        self.stage[here] = stage
        self.slots[0][here] = node if first is None else first
        spread = node * np.uint32(0x9E3779B1)
        for predictor, context in enumerate(contexts, 1):
            mixed = np.bitwise_xor(context, spread, out=self.slots[predictor][here])
            mixed *= _FACTOR
            mixed >>= self.shifts[predictor]


_FACTOR = np.uint32(0x85EBCA6B)


def _mixed(context: np.ndarray) -> np.ndarray:
    context = (context ^ context >> np.uint32(16)) * np.uint32(0x7FEB352D)
    return (context ^ context >> np.uint32(15)) * np.uint32(0x846CA68B)


def bits_of(lex: Lexicon, block: Block, rare: list[bytes]) -> Bits:
    """Bits of a block's tokens, and of the spellings of ``rare``.

    Bits are written step by step: the first bit of every token, then the second of those
    that have one, so that each step works on slices.
    """
    symbols, text, first = block.symbols, block.text, block.first
    count = len(symbols)
    place = np.arange(count)
    known = np.concatenate([[-2], symbols])

    def at(places: np.ndarray) -> np.ndarray:
        return np.where(places >= first, known[np.maximum(places, -1) + 1], -2).astype(np.uint32)

    def last(limit: int) -> np.ndarray:
        """The last word before each token of a rank up to ``limit``."""
        found = np.maximum.accumulate(np.where((symbols > 0) & (symbols <= limit), place, -1))
        return at(np.concatenate([[-1], found[:-1]]))

    before, common = BEFORE << lex.doubled, COMMON << lex.doubled
    ranked = symbols > 0
    rank_bits = np.where(ranked, np.frexp(symbols.astype(np.float64))[1] - 1, 0)
    kind = np.where(ranked, _RANKS + rank_bits, np.where(symbols == 0, _END, _ESCAPE))
    short = np.where(known > before, 0, known)
    short[1:] -= np.where(symbols > before, kind + 8, 0)
    one = np.where(place > first, short[:-1], -2).astype(np.uint32)
    telling = last(TELLING)
    contexts = [
        _mixed(one * np.uint32(0x2545F491) + np.uint32(1)),
        _mixed(last(common) * np.uint32(0x6C078965) + np.uint32(2)),
        _mixed(telling * np.uint32(0x5BD1E995) + np.uint32(3)),
    ]
    sizes = lex.classes.size[kind]
    data = np.frombuffer(b" ".join([*rare, b""]), np.uint8)
    spelled_sizes = lex.letters.size[data]
    coarse = np.minimum(rank_bits, SHALLOW)
    writer = _Writer(int(sizes.sum() + coarse.sum() + spelled_sizes.sum()), lex.slots)

    def by(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Columns with the largest keys first, and how many keys are above 0, 1, 2 ..."""
        order = np.argsort(-keys.astype(np.int8), kind="stable")
        above = len(keys) - np.cumsum(np.bincount(keys, minlength=1))
        return above[above > 0], [column[order] for column in columns]

    # The class of each token, then the place in the class.
    above, (own, begin, *sorted_) = by(sizes, text, lex.classes.begin[kind], *contexts)
    for step, n in enumerate(above.tolist()):
        path = begin[:n] + step
        writer.put(
            own[:n], lex.classes.node[path], lex.classes.bit[path], min(step, 11), [c[:n] for c in sorted_]
        )
    above, (own, number, left, *sorted_) = by(
        coarse, text, symbols.astype(np.uint32), rank_bits.astype(np.uint32), *contexts
    )
    top = (np.uint32(1) << left) + np.uint32(32)
    for step, n in enumerate(above.tolist()):
        rest = number[:n] >> (left[:n] - np.uint32(step + 1))
        writer.put(
            own[:n], top[:n] + (rest >> np.uint32(1)), rest & np.uint32(1), 12 + step, [c[:n] for c in sorted_]
        )
    spelled = writer.at
    if rare:
        _spell(lex, writer, data, spelled_sizes, by, rare)
    return Bits(
        writer.owner, writer.value, writer.slots, spelled, writer.stage,
        text, symbols, np.where(telling > TELLING, 0, telling).astype(np.int64),
    )


def _spell(
    lex: Lexicon, writer: _Writer, data: np.ndarray, sizes: np.ndarray, by: Callable, rare: list[bytes]
) -> None:
    """Bits of spelled words; a letter is predicted from up to four before it in its word."""
    lengths = np.fromiter(map(len, rare), np.int64, len(rare)) + 1
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    shifted = np.concatenate([np.zeros(4, np.uint32), data.astype(np.uint32)])

    def before(steps: int) -> np.ndarray:
        return np.where(place >= steps, shifted[4 - steps : len(shifted) - steps], np.uint32(0))

    one, two, three, four = map(before, range(1, 5))
    two = one + (two << np.uint32(8))
    three = two + (three << np.uint32(16))
    four = three + (four << np.uint32(24))
    contexts = [
        _mixed(three * np.uint32(0x2545F491) + np.uint32(5)),
        _mixed(two * np.uint32(0x6C078965) + np.uint32(6)),
        _mixed(four * np.uint32(0x5BD1E995) + np.uint32(7)),
    ]
    above, (own, begin, one, *sorted_) = by(
        sizes, np.repeat(np.arange(len(rare)), lengths), lex.letters.begin[data], one, *contexts
    )
    for step, n in enumerate(above.tolist()):
        path = begin[:n] + step
        node = lex.letters.node[path]
        first = (one[:n] << np.uint32(8)) + node + np.uint32(_SPELLED)
        writer.put(
            own[:n], node + np.uint32(1 << 20), lex.letters.bit[path], 40 + min(step, 15),
            [c[:n] for c in sorted_], first,
        )


# Powers of an odd number and of its inverse, for hashes of words within a part.
_BASE = 0x9E3779B97F4A7C15
_REACH = 2 * PART_BYTES + 4096


def _powers(base: int) -> np.ndarray:
    factors = np.full(_REACH, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


@dataclass
class WordTable:
    """Ranks of words by a 64-bit hash of their bytes, looked up for all words of a part at once.

    A hash is the difference of two running sums over the part. Ranks are found in up to
    three tables of four slots per word, the first of them for all words whose slot no
    more frequent word has. A rank counts only if all 64 bits and the length agree.
    """

    hashes: np.ndarray
    lengths: np.ndarray
    slots: list[np.ndarray]

    @classmethod
    def of(cls, words: list[bytes]) -> WordTable:
        table = cls(np.zeros(1, np.uint64), np.zeros(1, np.int32), [])
        hashes, lengths = [np.zeros(1, np.uint64)], [np.zeros(1, np.int32)]
        for begin in range(0, len(words), 512):
            data = b" ".join(words[begin : begin + 512])
            found, starts, ends = _hashes(data)
            hashes.append(found)
            lengths.append((ends - starts).astype(np.int32))
        table.hashes, table.lengths = np.concatenate(hashes), np.concatenate(lengths)
        left = np.arange(1, len(words) + 1, dtype=np.int32)
        for level in range(6):
            slots = np.full(1 << 20, len(table.hashes), np.int32)
            own = _slot_of(table.hashes[left], level)
            np.minimum.at(slots, own, left)
            slots[slots == len(table.hashes)] = 0
            table.slots.append(slots)
            left = left[slots[own] != left]
            if not len(left):
                break
        return table

    def find(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rank of each word from 1, or -1."""
        ranks = np.full(len(hashes), -1, np.int64)
        left, own = None, hashes
        for level, slots in enumerate(self.slots):
            rank = _taken(slots, _slot_of(own, level))
            good = (_taken(self.hashes, rank) == own) & (rank > 0)
            if left is None:
                good &= _taken(self.lengths, rank) == lengths
                ranks[good] = rank[good]
                left = np.flatnonzero(~good)
            else:
                good &= _taken(self.lengths, rank) == lengths[left]
                ranks[left[good]] = rank[good]
                left = left[~good]
            own = hashes[left]
        return ranks


def _slot_of(hashes: np.ndarray, level: int) -> np.ndarray:
    return (hashes >> np.uint64(44 - 7 * level) & np.uint64((1 << 20) - 1)).astype(np.intp)


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of a part."""
    text = np.frombuffer(data, np.uint8)
    inside = np.ones(len(text) + 2, bool)
    inside[0] = inside[-1] = False
    # White space is 0x20 and 0x09 to 0x0D.
    inside[1:-1] = (text != 0x20) & ((text - np.uint8(9)) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(text) >= _REACH:
        return _long_hashes(data, starts, ends), starts, ends
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text + np.uint64(1)) * POWERS[: len(text)], out=sums[1:])
    return _finished((sums[ends] - sums[starts]) * INVERSE[starts]), starts, ends


def _long_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for a part with a word longer than a part, which no vocabulary has."""
    found = [
        _hashes(data[a:b])[0][0] if b - a < _REACH else 0
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
    ]
    return np.array(found, np.uint64)


def _finished(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ hashes >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return hashes ^ hashes >> np.uint64(29)


POWERS, INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def parts_of(data: bytes) -> Iterator[bytes]:
    """A text in parts of bounded size that end at white space."""
    begin = 0
    while len(data) - begin > PART_BYTES:
        found = _SPACE.search(data, begin + PART_BYTES)
        end = found.start() if found else len(data)
        yield data[begin:end]
        begin = end
    yield data[begin:] if begin else data


@dataclass
class Block:
    """Tokens of some texts: symbols, the text of each, and the place where its part begins.

    A symbol is a rank from 1, 0 for the end, or -1 for the next of ``rare``.
    """

    symbols: np.ndarray
    text: np.ndarray
    first: np.ndarray
    rare: list[bytes]
    rare_text: np.ndarray
    sizes: np.ndarray  # bytes of each token and the space after it; none of an end


class Blocks:
    """Gathers parts of lower-case texts to blocks. Contexts begin anew with each part."""

    def __init__(self, lex: Lexicon) -> None:
        self.table = WordTable.of(lex.words)
        self.parts: list[bytes] = []
        self.numbers: list[int] = []
        self.ends: list[bool] = []
        self.size = 0

    def add(self, number: int, part: bytes, end: bool) -> bool:
        """Adds a part of a text; tells whether the block is full."""
        self.parts.append(part)
        self.numbers.append(number)
        self.ends.append(end)
        self.size += len(part) + 1
        return self.size >= PART_BYTES

    def take(self) -> Block:
        """The block, which is then begun anew."""
        data = b"\n".join(self.parts)
        hashes, starts, ends = _hashes(data)
        sizes = np.fromiter(map(len, self.parts), np.int64, len(self.parts)) + 1
        count = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
        closed = np.array(self.ends, np.int64)
        part_of_word = np.repeat(np.arange(len(count)), count)
        closed_before = np.cumsum(closed) - closed
        # A part's end stands after its words; words move on by the ends before them.
        place = np.arange(len(hashes)) + closed_before[part_of_word]
        symbols = np.zeros(len(hashes) + int(closed.sum()), np.int64)
        lengths = np.zeros(len(symbols), np.int64)
        ranks = self.table.find(hashes, ends - starts)
        symbols[place] = ranks
        lengths[place] = ends - starts + 1
        tokens = count + closed
        text = np.repeat(np.array(self.numbers, np.int64), tokens)
        rare = np.flatnonzero(ranks < 0)
        block = Block(
            symbols, text, np.repeat(np.cumsum(tokens) - tokens, tokens),
            [data[a:b] for a, b in zip(starts[rare].tolist(), ends[rare].tolist(), strict=True)],
            text[place[rare]], lengths,
        )
        self.parts, self.numbers, self.ends, self.size = [], [], [], 0
        return block


# -- the model ----------------------------------------------------------------------


def _confidence(seen: np.ndarray) -> np.ndarray:
    """How well a context is known, in six steps."""
    # The exponent of a count as a float tells how many bits the count has.
    size = (seen.astype(np.float32).view(np.int32) >> np.int32(23)) - np.int32(126)
    return np.clip(size, 0, 5).astype(np.uint8)


def _squash(odds: np.ndarray) -> np.ndarray:
    share = np.clip(odds, -80, 80)
    np.negative(share, out=share)
    np.exp(share, out=share)
    share += 1
    return np.divide(1, share, out=share)


def _gates(bits: Bits, seen: list[np.ndarray]) -> np.ndarray:
    """Weights are chosen by the kind of bit and how well the asked predictors know it."""
    gate = seen[0] * np.uint8(6) + seen[1]
    gate[bits.spelled :] += np.uint8(36)
    return gate.astype(np.intp)


def _steps(odds: np.ndarray, stage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the refinement map below each mix, and the share of the one above."""
    scaled = np.clip(odds, -7.99, 7.99)
    scaled += np.float32(8)
    scaled *= np.float32(2)
    low = scaled.astype(np.int32)
    scaled -= low.astype(np.float32)
    low += stage * np.int32(_STEPS)
    return low.astype(np.intp), scaled


class Mixer:
    """Weights by gate and the refinement map by stage; both learn block by block."""

    def __init__(self) -> None:
        self.weights = np.tile(np.array([0.4, 0.2, 0.2, 0.4, 0.0]), (_GATES, 1))
        curve = _squash((np.arange(_STEPS) - 16) / 2)
        self.map = np.tile(curve, _STAGES)

    def predict(self, odds: list[np.ndarray | None], gate: np.ndarray, stage: np.ndarray) -> tuple:
        columns = np.ascontiguousarray(self.weights.T, np.float32)
        mix = _taken(columns[PREDICTORS], gate)
        for predictor, each in enumerate(odds):
            if each is not None:
                part = _taken(columns[predictor], gate)
                part *= each
                mix += part
        return self._refined(mix, stage)

    def _refined(self, mix: np.ndarray, stage: np.ndarray) -> tuple:
        place, share = _steps(mix, stage)
        table = self.map.astype(np.float32)
        final = _taken(np.diff(table, append=table[-1]), place)
        final *= share
        final += _taken(table, place)
        mixed = _squash(mix)
        final += mixed
        final *= np.float32(0.5)
        np.clip(final, np.float32(1e-6), np.float32(1 - 1e-6), out=final)
        return final, mixed, place, share

    def learn(self, odds: list[np.ndarray], used: list[int], gate: np.ndarray, value: np.ndarray, stage: np.ndarray) -> None:
        """One step of each gate's weights down the coding cost, and of the map to the bits.

        ``odds`` are of the predictors ``used``. Bits are put in the order of their gates,
        so that each gate's bits are a slice of a matrix.
        """
        sizes = np.bincount(gate, minlength=_GATES)
        order = np.argsort(gate.astype(np.uint8), kind="stable")
        inputs = np.empty((len(used) + 1, len(gate)), np.float32)
        for row, each in zip(inputs, odds, strict=False):
            np.take(each, order, out=row, mode="clip")
        inputs[-1] = 1
        value = _taken(value, order)
        ends = np.cumsum(sizes)
        slices = [(g, slice(end - size, end)) for g, (size, end) in enumerate(zip(sizes, ends, strict=True)) if size]
        rows = [*used, PREDICTORS]
        weights = self.weights[:, rows].astype(np.float32)
        mix = np.empty(len(gate), np.float32)
        for g, here in slices:
            np.dot(weights[g], inputs[:, here], out=mix[here])
        low, share = _steps(mix, _taken(stage, order))
        mixed = _squash(mix)
        error = value.astype(np.float32)
        error -= mixed
        curvature = 1 - mixed
        curvature *= mixed
        squares = inputs * inputs
        for g, here in slices:
            slope, scale = inputs[:, here] @ error[here], squares[:, here] @ curvature[here]
            self.weights[g, rows] += 0.2 * slope / (scale + 2)
        self._refine(low, share, value)

    def _refine(self, place: np.ndarray, share: np.ndarray, value: np.ndarray) -> None:
        """Moves the two places of the map around each mix towards the bit, by their shares."""
        size = len(self.map)
        key = 2 * place + value
        count = np.bincount(key, minlength=2 * size).reshape(-1, 2)
        above = np.bincount(key, share, 2 * size).reshape(-1, 2)
        below = count - above
        for part, at in ((below, slice(0, size)), (above[:-1], slice(1, size))):
            total = part.sum(1)
            self.map[at] += 0.5 * (part[:, 1] - total * self.map[at]) / (total + 20)


class Finer:
    """Counts of words by the last telling word, for the finer bits of ranks.

    A bit splits a range of neighbouring ranks. Ranges are nodes of a binary tree over all
    ranks: the halves of node ``i`` are ``2 * i`` and ``2 * i + 1``, and the ranks its leaves.
    The counts of two halves lie side by side, for every telling word, and are read as one number.
    """

    WIDTH = 1 << (VOCABULARY + 1).bit_length() - 1

    def __init__(self) -> None:
        self.tree = np.zeros(2 * self.WIDTH * (TELLING + 1), np.int32)
        self.every = np.zeros(2 * self.WIDTH, np.int32)

    @property
    def n(self) -> np.ndarray:
        """Counts of the ranks themselves, by rank and telling word."""
        halves = self.tree[self.WIDTH * (TELLING + 1) :].reshape(-1, TELLING + 1, 2)
        return halves.transpose(0, 2, 1).ravel()

    def learn(self, mixer: Mixer, bits: Bits) -> int:
        """Predicts the finer bits of a block, learns from them and counts them; how many."""
        inside = np.flatnonzero(bits.symbol >= 2 << SHALLOW)
        if not len(inside):
            return 0
        symbol, telling = bits.symbol[inside], bits.telling[inside]
        left = np.frexp(symbol.astype(np.float64))[1] - SHALLOW - 2  # bits after the next
        symbol += self.WIDTH
        nodes, rows, stages = [], [], []
        while len(symbol):
            nodes.append(symbol >> left)
            rows.append(telling)
            stages.append(np.full(len(symbol), 12 + SHALLOW + len(stages), np.int32))
            more = left > 0
            symbol, telling, left = symbol[more], telling[more], left[more] - 1
        node, row = np.concatenate(nodes), np.concatenate(rows)
        above, half = node >> 1, node & 1
        value = half.astype(np.uint8)
        own = above * (TELLING + 1) + row
        odds, gate = _finer_odds(
            *(_taken(counts.view(np.int64), at).view(np.int32).reshape(-1, 2)
              for counts, at in ((self.every, above), (self.tree, own)))
        )
        mixer.learn([odds[0], odds[3]], [0, 3], gate, value, np.concatenate(stages))
        np.add.at(self.every, node, np.int32(1))
        np.add.at(self.tree, 2 * own + half, np.int32(1))
        return len(node)

    @classmethod
    def costs(cls, counts: np.ndarray, mixer: Mixer) -> np.ndarray:
        """log10 of the probability of a word's finer bits, by symbol and telling word."""
        by_row = np.ascontiguousarray(counts.reshape(cls.WIDTH, TELLING + 1).T)
        total = by_row.sum(axis=0)
        costs = np.zeros(by_row.shape, np.float32)
        for size in range(SHALLOW + 1, cls.WIDTH.bit_length() - 1):
            span = slice(1 << size, 1 << size + 1)
            for step in range(SHALLOW, size):
                every = total[span].reshape(1 << step, 2, -1).sum(-1)
                for row in range(TELLING + 1):
                    own = by_row[row, span].reshape(1 << step, 2, -1).sum(-1)
                    odds, gate = _finer_odds(every, own)
                    stage = np.full(1 << step, 12 + step, np.int32)
                    one = mixer.predict(odds, gate, stage)[0]
                    both = np.log10(np.stack([1 - one, one], axis=1)).ravel()
                    costs[row, span] += np.repeat(both, 1 << size - step - 1)
        return costs.T.ravel()


def _finer_odds(every: np.ndarray, own: np.ndarray) -> tuple[list[np.ndarray | None], np.ndarray]:
    gate = _confidence(own[:, 0] + own[:, 1]).astype(np.intp) + 72
    return [_odds(every), None, None, _odds(own)], gate


def _odds(pairs: np.ndarray) -> np.ndarray:
    """Log odds from rows of zeros and ones."""
    counts = pairs.astype(np.float32)
    counts += np.float32(_PRIOR)
    odds = counts[:, 1] / counts[:, 0]
    return np.log(odds, out=odds)


def _handed_out(rows: DataFrame, what: object) -> Broadcast[bytes]:
    """For the tasks: a lexicon or model; the constants above keep them below 300 MB."""
    return rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(what))


# Names of two settings of the C library, the size from which arrays get memory
# of their own, and the freed memory that is kept.
_OWN_FROM, _KEPT = (-3, 1 << 24), (-1, 1 << 26)


def _keep_memory() -> None:
    """Lets a task use the memory of a block's arrays again for the next block.

    Else it goes back to the system after every block and is cleared when it is asked for
    again. Libraries without these settings do as they do.
    """
    with suppress(OSError, AttributeError, TypeError):
        library = ctypes.CDLL(None)
        for setting in (_OWN_FROM, _KEPT):
            library.mallopt(*setting)


class Learner:
    """What a task has learned: counts by predictor and slot, finer counts, and the mixer."""

    def __init__(self, lex: Lexicon) -> None:
        self.lex, self.mixer, self.finer = lex, Mixer(), Finer()
        self.counts = [np.zeros(-(-2 * size // CHUNK) * CHUNK, np.int32) for size in lex.slots]
        self.fitted = 0

    def take(self, block: Block) -> None:
        """Predicts a block, fits weights and refinement to all its bits, then counts them."""
        bits = bits_of(self.lex, block, block.rare)
        odds, seen = [], []
        places = [slots.astype(np.intp) for slots in bits.slots]
        for predictor, (counts, slots) in enumerate(zip(self.counts, places, strict=True)):
            # Zeros and ones of a slot lie side by side and are read as one number.
            pairs = _taken(counts.view(np.int64), slots).view(np.int32).reshape(-1, 2)
            odds.append(_odds(pairs))
            if predictor in _ASKED:
                seen.append(_confidence(pairs[:, 0] + pairs[:, 1]))
        self.mixer.learn(odds, list(range(PREDICTORS)), _gates(bits, seen), bits.value, bits.stage)
        for counts, slots in zip(self.counts, places, strict=True):
            slots <<= 1
            slots += bits.value
            np.add.at(counts, slots, np.int32(1))
        self.fitted += len(bits.value) + self.finer.learn(self.mixer, bits)


def learn(texts: DataFrame, lex: Lexicon) -> Model:
    """Goes through the training texts ``t`` online; adds up what the tasks learned."""
    shared = _handed_out(texts, lex)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        lex = cloudpickle.loads(shared.value)
        blocks, learner = Blocks(lex), Learner(lex)
        for batch in batches:
            for text in batch.column(0):
                parts = list(parts_of(text.as_py().lower()))
                for number, part in enumerate(parts, 1):
                    if blocks.add(0, part, number == len(parts)):
                        learner.take(blocks.take())
        if blocks.parts:
            learner.take(blocks.take())
        if learner.fitted:
            yield from _learned([*learner.counts, learner.finer.n], learner.mixer, learner.fitted)

    parts = texts.select("t").mapInArrow(per_task, "part string, chunk int, task int, data binary")
    tasks = texts.rdd.getNumPartitions()
    while True:
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        parts = parts.groupBy("part", "chunk", "task").applyInArrow(_added, parts.schema)
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            break
    found = {(r["part"], r["chunk"]): r["data"] for r in parts.drop("task").collect()}
    return Model.of(found, lex.slots)


def _learned(counts: list[np.ndarray], mixer: Mixer, fitted: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    parts = [
        (f"counts{predictor}", chunk, n[chunk * CHUNK : (chunk + 1) * CHUNK].astype("<i8"))
        for predictor, n in enumerate(counts)
        for chunk in range(len(n) // CHUNK)
    ]
    flat = np.concatenate([mixer.weights.ravel(), mixer.map, [1.0]]) * fitted
    parts.append(("mixer", 0, flat.astype("<f8")))
    for part, chunk, values in parts:
        if not values.any():
            continue  # contexts that the task has not met
        data = pa.compress(values.tobytes(), "zstd", asbytes=True)
        columns = [
            pa.array([part]), pa.array([chunk], pa.int32()), pa.array([task], pa.int32()),
            pa.array([data], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "task", "data"])


def _values(part: str, data: bytes) -> np.ndarray:
    size, kind = (_GATES * (PREDICTORS + 1) + _STAGES * _STEPS + 1, "<f8") if part == "mixer" else (CHUNK, "<i8")
    return np.frombuffer(pa.decompress(data, size * 8, "zstd", asbytes=True), kind)


def _added(rows: pa.Table) -> pa.Table:
    part = rows["part"][0].as_py()
    total = 0
    # In the order of the tasks, so that sums of fractions come out alike.
    for data in sorted(rows["data"].to_pylist()):
        total = total + _values(part, data)
    first = rows.slice(0, 1)
    data = pa.compress(total.tobytes(), "zstd", asbytes=True)
    return first.set_column(3, "data", pa.array([data], pa.binary()))


@dataclass
class Model:
    """Log odds by predictor and slot in sixteenths, the mixer, and the costs of finer bits.

    Predictors that the gate asks have their confidence in the upper byte.

    Bytes keep the tables of a task in the cache; a sixteenth costs next to no bits.
    """

    tables: list[np.ndarray]
    mixer: Mixer
    finer: np.ndarray

    @classmethod
    def of(cls, parts: dict[tuple[str, int], bytes], slots: tuple[int, ...]) -> Model:
        tables, mixer = [], Mixer()
        for predictor, size in enumerate(slots):
            asked = predictor in _ASKED
            table = np.zeros(-(-2 * size // CHUNK) * CHUNK // 2, np.uint16 if asked else np.int8)
            for chunk in range(2 * len(table) // CHUNK):
                both = cls._counts(parts, predictor, chunk)
                zeros, ones = both[::2], both[1::2]
                # Counts without limit here: the more was seen, the finer the odds.
                each = np.log(ones + _PRIOR) - np.log(zeros + _PRIOR)
                odds = np.rint(np.clip(each * _FINE, -127, 127)).astype(np.int8)
                if asked:
                    seen = _confidence(zeros + ones).astype(np.uint16)
                    odds = seen << np.uint16(8) | odds.view(np.uint8)
                table[chunk * CHUNK // 2 : (chunk + 1) * CHUNK // 2] = odds
            tables.append(table)
        if ("mixer", 0) in parts:
            flat = _values("mixer", parts["mixer", 0])
            flat = flat[:-1] / flat[-1]
            mixer.weights = flat[: mixer.weights.size].reshape(mixer.weights.shape)
            mixer.map = flat[mixer.weights.size :]
        size = (TELLING + 1) * Finer.WIDTH
        words = np.concatenate([cls._counts(parts, PREDICTORS, chunk) for chunk in range(-(-size // CHUNK))])
        return cls(tables, mixer, Finer.costs(words[:size], mixer))

    @staticmethod
    def _counts(parts: dict[tuple[str, int], bytes], number: int, chunk: int) -> np.ndarray:
        """Counts of a chunk of a table; a chunk that no task has met is zero."""
        name = f"counts{number}"
        found = parts.get((name, chunk))
        return np.zeros(CHUNK, np.int64) if found is None else _values(name, found)

    def finer_cost(self, bits: Bits) -> np.ndarray:
        """log10 of the probability of the finer bits of each token."""
        index = np.maximum(bits.symbol, 0) * (TELLING + 1) + bits.telling
        return _taken(self.finer, index)

    def cost(self, bits: Bits) -> np.ndarray:
        """log10 of the probability of each bit."""
        odds, seen = [], []
        for predictor, (table, slots) in enumerate(zip(self.tables, bits.slots, strict=True)):
            found = _taken(table, slots.astype(np.intp))
            if predictor in _ASKED:
                seen.append((found >> np.uint16(8)).astype(np.uint8))
                found = found.astype(np.uint8).view(np.int8)
            found = found.astype(np.float32)
            found *= np.float32(1 / _FINE)
            odds.append(found)
        gate = _gates(bits, seen)
        share = (1 - bits.value).astype(np.float32)
        share -= self.mixer.predict(odds, gate, bits.stage)[0]
        np.abs(share, out=share)
        return np.log10(share, out=share)


# -- scoring ------------------------------------------------------------------------


def _scored(docs: DataFrame, lex: Lexicon, model: Model) -> DataFrame:
    """One row per document, and one per word of it outside the vocabulary.

    ``row`` tells documents apart; rows of words have the word and the score of its
    spelling, which is not in the document's.
    """
    shared = _handed_out(docs, (lex, model))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        lex, model = cloudpickle.loads(shared.value)
        known = np.append(0.0, lex.base(lex.counts))  # by rank, from 1
        end = float(lex.base(lex.ends))
        blocks = Blocks(lex)
        spelled: dict[bytes, float] = {}
        next_row = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = batch.num_rows
            score, base = np.zeros(size), np.zeros(size)
            tokens, seen = np.zeros(size, np.int64), np.zeros(size, np.int64)
            sizes = np.zeros(size, np.int64)
            rare_words: list[bytes] = []
            rare_rows, rare_scores = [np.zeros(0, np.int64)], [np.zeros(0)]

            def take() -> None:
                block = blocks.take()
                # The score of a spelling depends on the word alone.
                if len(spelled) > SPELLED:
                    spelled.clear()
                fresh = [word for word in dict.fromkeys(block.rare) if word not in spelled]
                bits = bits_of(lex, block, fresh)
                cost = model.cost(bits)
                ranks, letters = slice(0, bits.spelled), slice(bits.spelled, None)
                each = np.bincount(bits.owner[letters], cost[letters], len(fresh))
                spelled.update(zip(fresh, each.tolist(), strict=True))
                rare_words.extend(block.rare)
                rare_rows.append(block.rare_text + next_row)
                rare_scores.append(np.array([spelled[word] for word in block.rare], float))
                inside = block.symbols > 0
                for total, owner, amounts in (
                    (score, bits.owner[ranks], cost[ranks]),
                    (score, block.text, model.finer_cost(bits)),
                    (base, block.text, known[np.maximum(block.symbols, 0)]),
                    (tokens, block.text, None),
                    (seen, block.text[inside], None),
                    (sizes, block.text, block.sizes),
                ):
                    np.add(total, np.bincount(owner, amounts, size), out=total, casting="unsafe")

            for number, text in enumerate(batch.column(1)):
                parts = list(parts_of(text.as_py().lower()))
                for place, part in enumerate(parts, 1):
                    if blocks.add(number, part, place == len(parts)):
                        take()
            if blocks.parts:
                take()
            base += end
            seen += lex.ends > 0
            rare_row, rare_score = np.concatenate(rare_rows), np.concatenate(rare_scores)
            more = len(rare_row)

            def doc(values: np.ndarray) -> pa.Array:
                return pa.concat_arrays([pa.array(values), pa.nulls(more, pa.from_numpy_dtype(values.dtype))])

            columns = [
                pa.concat_arrays([batch.column(0), pa.nulls(more, batch.column(0).type)]),
                pa.array(np.concatenate([np.arange(size) + next_row, rare_row])),
                pa.concat_arrays([pa.nulls(size, pa.binary()), pa.array(rare_words, pa.binary())]),
                doc(tokens), doc(seen), doc(sizes), doc(base),
                pa.array(np.concatenate([score, rare_score])),
            ]
            next_row += size
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select("doc_id", text_bytes().alias("t"))
    # Rows of words have no doc_id, also where documents must have one.
    schema = rows.selectExpr(
        "IF(true, doc_id, NULL) AS doc_id", "0L AS row", "CAST(NULL AS BINARY) AS word",
        *(f"CAST(NULL AS BIGINT) AS {name}" for name in ("n_tokens", "n_known", "n_bytes")),
        *(f"CAST(NULL AS DOUBLE) AS {name}" for name in ("base_score", "score")),
    ).schema
    names = schema.names
    return rows.mapInArrow(per_task, schema)


def score_documents(docs: DataFrame, vocabulary: int = VOCABULARY) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Learns from the documents that are not held out and scores all. ``score`` is the
    model's log10 probability of a text's tokens, ``base_score`` that of smoothed word
    counts, ``bits_per_byte`` the model's cost over the bytes of the words and one more
    for each. Counts are of all training tokens: the most frequent words are handed to
    the tasks, all others are joined to the documents that have them.

    A null text counts as empty: its only token is the end. A null doc_id is held out.
    Repeated rows learn and are scored each. An empty table gives no rows; without
    training documents the model is uniform.
    """
    training = docs.where(~held_out()).select(text_bytes().alias("t"))
    counts = stored(word_counts(training), "lm-counts")
    lex = lexicon(counts, training.count(), vocabulary)
    model = learn(training, lex)

    found = stored(_scored(docs, lex, model), "lm-scored")
    scale = lex.total + 0.1 * (lex.distinct + 1)
    term = F.log10((F.coalesce(F.col("c"), F.lit(0)) + 0.1) / F.lit(scale))
    rare = found.where(F.col("word").isNotNull()).select("row", "word", "score")
    rare = rare.join(counts.withColumnRenamed("n", "c"), "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(term).alias("rare_base"),
        F.count_if(F.col("c") > 0).alias("rare_known"),
        F.sum(lex.rare.score(F.col("c"), F.col("score"))).alias("rare_score"),
    )
    joined = found.where(F.col("word").isNull()).join(rare, "row", "left")
    joined = joined.withColumn("score", F.col("score") + F.coalesce("rare_score", F.lit(0.0)))
    none = F.lit(0)
    return joined.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(lex.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rare_base", none)).alias("base_score"),
        "score",
        (-F.col("score") / F.lit(float(np.log10(2))) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
