"""Steps of op5's learning against their plain versions, and the memory of its blocks."""

from __future__ import annotations

import resource
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa

from orderstream.llm import lm_scoring


def test_confidence_is_the_number_of_bits_up_to_five():
    for kind in (np.int32, np.int64):
        seen = np.array([*range(70), 2**20, 2**24 + 1, 2**31 - 1], kind)
        expected = [min(int(n).bit_length(), 5) for n in seen]
        assert lm_scoring._confidence(seen).tolist() == expected


def test_finer_counts_come_out_by_rank_and_telling_word():
    rng = np.random.default_rng(7)
    symbol = rng.integers(1, lm_scoring.VOCABULARY, 5000)
    telling = rng.integers(0, lm_scoring.TELLING + 1, 5000)
    bits = SimpleNamespace(symbol=symbol, telling=telling)
    finer = lm_scoring.Finer()
    finer.learn(lm_scoring.Mixer(), bits)
    deep = symbol >= 2 << lm_scoring.SHALLOW
    expected = np.zeros((finer.WIDTH, lm_scoring.TELLING + 1), np.int64)
    np.add.at(expected, (symbol[deep], telling[deep]), 1)
    assert np.array_equal(finer.n.reshape(expected.shape), expected)


def test_memory_of_a_block_is_used_again():
    """Freed arrays of a block's size are not cleared anew by the system, page by page."""
    lm_scoring._keep_memory()

    def faults() -> int:
        before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
        for _ in range(200):
            arrays = [np.ones(175_000) for _ in range(8)]
            del arrays
        return resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before

    faults()
    # 200 rounds of 11 MB in pages of 4 KB are half a million.
    assert faults() < 100_000


def test_a_task_hands_on_one_count_per_word(spark):
    """Counts of many distinct words are not handed on in pieces that repeat the frequent ones."""
    texts = [b"a%d b%d A%d  b" % (n, n % 7, n) for n in range(300_000)]
    found = []
    rows = MagicMock()
    rows.select.return_value.mapInArrow.side_effect = lambda code, schema: found.append(code) or MagicMock()
    lm_scoring.word_counts(rows)
    batches = list(found[0](iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])])))
    words, counts = (pa.chunked_array([b.column(k) for b in batches]).to_pylist() for k in (0, 1))
    assert len(words) == len(set(words)) == 300_008
    each = dict(zip(words, counts, strict=True))
    assert each[b"a5"] == 2 and each[b"b"] == 300_000 and sum(counts) == 4 * 300_000


def test_finer_bits_are_those_of_each_rank(monkeypatch):
    """Nodes, telling words, bits and stages that are learned, against bit strings."""
    symbol = np.array([-1, 0, 1, 31, 32, 33, 1000, 262_143, 40, 262_142, 131_071])
    telling = np.arange(len(symbol)) % (lm_scoring.TELLING + 1)
    seen = []
    mixer = lm_scoring.Mixer()
    monkeypatch.setattr(mixer, "learn", lambda *parts: seen.append(parts))
    finer = lm_scoring.Finer()
    expected = []
    for step in range(lm_scoring.SHALLOW, 18):
        for rank in symbol.tolist():
            digits = format(max(rank, 0), "b")[1:]
            if len(digits) > step:
                expected.append((int(digits[step]), 12 + step))
    assert finer.learn(mixer, SimpleNamespace(symbol=symbol.copy(), telling=telling)) == len(expected)
    _, used, _, value, stage = seen[0]
    assert used == [0, 3]
    assert list(zip(value.tolist(), stage.tolist(), strict=True)) == expected


def test_most_frequent_words_have_the_first_table():
    words = [b"w%d" % n for n in range(200_000)]
    table = lm_scoring.WordTable.of(words)
    own = lm_scoring._slot_of(table.hashes[1:], 0)
    first: dict[int, int] = {}
    for rank, slot in enumerate(own.tolist(), 1):
        first.setdefault(slot, rank)
    assert {slot: int(table.slots[0][slot]) for slot in first} == first
    assert np.count_nonzero(table.slots[0]) == len(first) < len(words)
    assert table.find(table.hashes[1:], table.lengths[1:]).tolist() == list(range(1, len(words) + 1))
