"""Mixing, packing, token output and LM scoring against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from orderstream.llm import lm_scoring, mixing, packing, token_output
from orderstream.llm.catalog import QUERIES
from orderstream.llm.common import ranked

WORD = r"[^\x20\x09-\x0D]+"


# -- mixing -------------------------------------------------------------------------


def plain_targets(sizes: dict, share: float = 1.5, cap: float = 2.0) -> dict:
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weight = {name: (3, 1, 2)[i % 3] for i, name in enumerate(names)}
    full: set = set()
    while True:
        rest = share * sum(sizes.values()) - sum(cap * sizes[n] for n in full)
        total = sum(weight[n] for n in names if n not in full)
        level = rest / total if total else 0
        above = {n for n in names if n not in full and weight[n] * level > cap * sizes[n]}
        if not above:
            return {n: cap * sizes[n] if n in full else weight[n] * level for n in names}
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}": rnd.choice([0, 1, 10, 500, 10_000]) for i in range(rnd.randint(1, 30))} | {None: 300, "é": 7}
    rows = spark.createDataFrame(list(sizes.items()), "source STRING, source_size BIGINT")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = mixing.mix(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in found} == {i: len(re.findall(WORD, t or "")) for i, t in texts.items()}
    sizes, taken, targets = Counter(), Counter(), {}
    for r in found:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert targets == pytest.approx(plain_targets(sizes))
    largest = {source: max(r["size"] for r in found if r.source == source) for source in targets}
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(0.03 * target, largest[source] / 2)
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in found}
    other = {(r.doc_id, r.taken) for r in mixing.mix(docs, seed=7).collect()}
    assert other != again
    rows = Counter(r.doc_id for r in mixing.repeat_documents(docs).select("doc_id").collect())
    assert rows == Counter({r.doc_id: r.repeats for r in found if r.repeats})


@pytest.mark.parametrize("seed", range(3))
def test_a_very_long_document_leaves_no_gap(spark, seed):
    """Nothing that still fits is left out, wherever a long document lies in hash order."""
    rnd = random.Random(seed)
    sizes = {"a": [500] * 300 + [300_000], "b": [rnd.randint(1, 900) for _ in range(200)] + [50_000] * 2}
    rows = [(f"{s}{i}", s, "w " * n) for s, each in sizes.items() for i, n in enumerate(each)]
    rows += [row for row in rows if row[1] == "b" and row[0] < "b12"]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id STRING, source STRING, text STRING").repartition(3)
    found = mixing.mix(docs, seed, 1.3, 1.3).collect()
    for source in sizes:
        some = [r for r in found if r.source == source]
        once: Counter = Counter()
        for r in some:
            if r.repeats == min(x.repeats for x in some):
                once[r.doc_id] += r["size"]
        gap = some[0].target - sum(r.taken for r in some)
        assert abs(gap) < min(size for size in once.values() if size)
    rows = Counter(r.doc_id for r in mixing.repeat_documents(docs, seed, 1.3, 1.3).select("doc_id").collect())
    expected: Counter = Counter()
    for r in found:
        expected[r.doc_id] += r.repeats
    assert rows == +expected


def test_global_ranks(spark):
    values = random.Random(3).sample(range(10**6), 3000)
    rows = spark.createDataFrame([(v,) for v in values], "v BIGINT").repartition(7)
    found = {r.v: r.place for r in ranked(rows, [rows["v"]], "place").collect()}
    assert found == {v: i for i, v in enumerate(sorted(values))}


# -- packing ------------------------------------------------------------------------


@settings(deadline=None, max_examples=150)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
def test_boundaries_are_optimal(histogram, buckets):
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[n] for n in lengths])

    def cost(ends) -> int:
        return sum(c * min(e for e in ends if e >= n) for n, c in histogram.items())

    ends = packing.boundaries(lengths, counts, buckets)
    choices = combinations(lengths.tolist()[:-1], min(buckets, len(lengths)) - 1)
    assert len(ends) <= buckets
    assert cost(ends) == min(cost([*some, int(lengths[-1])]) for some in choices)


def test_packing(spark):
    rnd = random.Random(1)
    texts = [" ".join(["w"] * rnd.choice([0, 1, 3, 7, 8, 20, 33, 75])) for _ in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    found = packing.pack(docs, max_length=30, buckets=4, batch_tokens=100, shard_rows=50).collect()
    parts = defaultdict(list)
    batches = defaultdict(list)
    for r in found:
        parts[r.doc_id].append((r.piece, r.start, r.length))
        batches[r.padded, r.batch].append(r.slot)
        assert r.length <= r.padded <= 30
    for doc_id, text in enumerate(texts):
        pieces = sorted(parts[doc_id])
        assert sum(length for _, _, length in pieces) == len(text.split())
        assert [start for _, start, _ in pieces] == [30 * i for i in range(len(pieces))]
    for padded in {padded for padded, _ in batches}:
        own = sorted(batch for p, batch in batches if p == padded)
        assert own == list(range(len(own)))
        for batch in own:
            slots = sorted(batches[padded, batch])
            assert slots == list(range(len(slots)))
            assert len(slots) == 100 // padded or batch == own[-1]
    assert len({padded for padded, _ in batches}) <= 4


# -- tokens -------------------------------------------------------------------------


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing(sizes):
    rows = token_output.best_fit_decreasing(np.array(sizes, np.int64), 20)
    assert sorted(p for row in rows for p in row) == list(range(len(sizes)))
    free: list[int] = []
    plain: list[list[int]] = []
    for piece in sorted(range(len(sizes)), key=lambda p: -sizes[p]):
        fits = [i for i, f in enumerate(free) if f >= sizes[piece]]
        if fits:
            best = min(fits, key=lambda i: free[i])
        else:
            best = len(free)
            free.append(20)
            plain.append([])
        free[best] -= sizes[piece]
        plain[best].append(piece)
    assert sorted(sum(sizes[p] for p in row) for row in rows) == sorted(20 - f for f in free)


@pytest.mark.parametrize("end", [token_output.END_OF_TEXT, None])
def test_token_round_trip(spark, sf_dir, end):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ranks = token_output.load_vocabulary(token_output.VOCABULARY)
    own = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = token_output.pack_tokens(docs, length=256, end=end, shard_bytes=50_000).collect()
    parts = defaultdict(dict)
    for r in found:
        ids, places = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 256
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == (end or 0)).all() and not places[r.n_tokens :].any()
        for k, (doc_id, piece) in enumerate(zip(r.doc_ids, r.pieces, strict=True)):
            a, b = r.cu_seqlens[k : k + 2]
            assert (places[a:b] == np.arange(b - a)).all()
            parts[doc_id][piece] = ids[a:b]
    assert len({r.shard for r in found}) > 3
    for doc_id, text in docs.collect():
        ids = np.concatenate([parts[doc_id][p] for p in sorted(parts[doc_id])] or [np.array([], "<u2")]).tolist()
        assert ids == own.encode_ordinary(text or "") + ([end] if end else [])
    assert sum(r.n_tokens for r in found) > 0.95 * 256 * len(found)


# -- LM scoring ---------------------------------------------------------------------


def test_base_score_and_gain(spark):
    """The base of every document, and the model ahead of it on held-out documents."""
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    end = b"\n"
    counts: Counter = Counter()
    for doc_id, text in texts.items():
        if zlib.crc32(str(doc_id).encode()) % 10:
            counts.update([*(text or "").encode().lower().split(), end])
    total, distinct = sum(counts.values()), len(counts)
    held = [0.0, 0.0]
    for r in QUERIES["op5_lm_scoring"](spark, folder).collect():
        tokens = [*(texts[r.doc_id] or "").encode().lower().split(), end]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        assert r.base_score == pytest.approx(base)
        assert (r.n_tokens, r.train_tokens) == (len(tokens), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        if r.held_out:
            held[0] += r.base_score
            held[1] += r.score
    assert held[1] > held[0]


def small_model(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the cat sat"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    from orderstream.llm.common import text_bytes

    training = docs.select(text_bytes().alias("t"))
    lex = lm_scoring.lexicon(lm_scoring.word_counts(training), len(texts))
    return lex, lm_scoring.learn(training, lex)


def test_the_model_is_a_distribution(spark):
    """Probabilities of everything that may come next add up to one; repeats become cheap."""
    lex, model = small_model(spark)

    def score(words: list[bytes], end: bool) -> float:
        blocks = lm_scoring.Blocks(lex)
        blocks.add(0, b" ".join(words), end)
        block = blocks.take()
        bits = lm_scoring.bits_of(lex, block, block.rare)
        return float(model.cost(bits).sum() + model.finer_cost(bits).sum())

    before = [b"the", b"cat"]
    known = sum(10 ** score([*before, word], False) for word in lex.words)
    stop = 10 ** score(before, True)
    # An escape is what is left; it can't be scored without its bytes.
    escaped = 10 ** score([*before, b"zebra"], False)
    start = 10 ** score(before, False)
    assert 0.9 * start < known + stop + escaped <= start * (1 + 1e-4)
    assert score([*before, b"sat"], False) > score([*before, b"log"], False)
    for size in (2, 5, 300):
        code = lm_scoring.Code.of([1 + i % 7 for i in range(size)])
        assert sum(2.0 ** -int(n) for n in code.size) == pytest.approx(1)


def test_words_are_found_by_their_hash():
    rnd = random.Random(2)
    words = list({bytes(rnd.choices(range(33, 256), k=rnd.randint(1, 9))) for _ in range(60_000)})
    table, ranks = lm_scoring.WordTable.of(words), {word: rank for rank, word in enumerate(words, 1)}
    for _ in range(100):
        some = rnd.choices(words, k=rnd.randint(0, 200)) + [bytes(rnd.choices(range(33, 256), k=70))]
        rnd.shuffle(some)
        data = b"".join(word + rnd.choice([b" ", b"\n", b"\t ", b"\x0b\x0c\r"]) for word in some)
        hashes, starts, ends = lm_scoring._hashes(data)
        assert [data[a:b] for a, b in zip(starts, ends, strict=True)] == some == data.split()
        assert table.find(hashes, ends - starts).tolist() == [ranks.get(word, -1) for word in some]


@pytest.mark.parametrize("text", [b"", b" ", b"ab cd " * 40_000, b"x" * 300_000 + b" ab " + b"y" * 70_000])
def test_parts_cover_a_text(text):
    parts = list(lm_scoring.parts_of(text))
    assert b"".join(parts) == text
    assert [word for part in parts for word in part.split()] == text.split()


def test_tables_add_up_alike_in_any_split(spark):
    """Counts do not depend on how texts are dealt to tasks; levels of sums are used."""
    texts = [("x y z " * (i % 9),) for i in range(60)]
    rows = spark.createDataFrame(texts, "t STRING").selectExpr("CAST(t AS BINARY) AS t")
    lex = lm_scoring.lexicon(lm_scoring.word_counts(rows), len(texts))
    few, many = (lm_scoring.learn(rows.repartition(n), lex) for n in (1, 70))
    for a, b in zip(few.tables, many.tables, strict=True):
        assert np.array_equal(a, b)


def test_long_texts_and_many_words(spark, monkeypatch):
    """Small bounds for blocks and counters give the same counts."""
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choices("abc", k=rnd.randint(1, 5))) for _ in range(3000))
    rows = spark.createDataFrame([(text,), (None,), ("",)], "t STRING").selectExpr("CAST(coalesce(t, '') AS BINARY) AS t")
    monkeypatch.setattr(lm_scoring, "COUNTED", 10)
    blocks = lm_scoring.word_blocks
    monkeypatch.setattr(lm_scoring, "word_blocks", lambda data, size=0: blocks(data, 50))
    found = {bytes(r.word): r.n for r in lm_scoring.word_counts(rows).collect()}
    assert found == Counter(text.encode().split())


@pytest.mark.parametrize("tokens, doubled", [(0, 0), ((1 << 28) - 1, 0), (1 << 28, 1), ((1 << 30) - 1, 1), (1 << 30, 2), (1 << 33, 3), (1 << 38, 6), (1 << 60, 6)])
def test_tables_grow_with_the_root_of_the_tokens(tokens, doubled):
    assert lm_scoring.doublings(tokens) == doubled


def test_larger_tables_tell_more_contexts_apart(spark, monkeypatch):
    """A word that decides the next one, beyond the least number of words with contexts."""
    monkeypatch.setattr(lm_scoring, "BEFORE", 8)
    monkeypatch.setattr(lm_scoring, "COMMON", 4)
    rnd = random.Random(7)
    texts = [" ".join(f"k{n} v{n}" for n in rnd.choices(range(200), k=40)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").selectExpr("CAST(t AS BINARY) AS t")
    score, sizes = {}, {}
    for doubled in (0, 6):
        monkeypatch.setattr(lm_scoring, "doublings", lambda tokens, doubled=doubled: doubled)
        lex = lm_scoring.lexicon(lm_scoring.word_counts(rows), len(texts))
        model = lm_scoring.learn(rows, lex)
        blocks = lm_scoring.Blocks(lex)
        blocks.add(0, " ".join(f"k{n} v{n}" for n in range(200)).encode(), True)
        block = blocks.take()
        bits = lm_scoring.bits_of(lex, block, block.rare)
        score[doubled] = model.cost(bits).sum() + model.finer_cost(bits).sum()
        sizes[doubled] = [len(table) for table in model.tables[1:]]
    assert sizes[6] == [64 * size for size in sizes[0]]
    assert score[6] > 0.9 * score[0]


def test_every_block_moves_the_weights():
    """Also late blocks and those of a source that comes between others; also finer bits."""
    words = [f"w{i}".encode() for i in range(1, 400)]
    rnd = random.Random(4)
    code = lm_scoring.Code.of([1 + i % 5 for i in range(21)]), lm_scoring.Code.of([1] * 256)
    lex = lm_scoring.Lexicon(
        words, np.ones(len(words), np.int64), 400, 400, 1, lm_scoring.RareWords(1, 1, 1), *code
    )
    learner, blocks, bits = lm_scoring.Learner(lex), lm_scoring.Blocks(lex), 0
    for _ in range(60):
        blocks.add(0, b" ".join(rnd.choices(words, k=300) + [b"other"]), True)
        block = blocks.take()
        found = lm_scoring.bits_of(lex, block, block.rare)
        ranks = block.symbols[block.symbols > 0]
        bits += len(found.value) + sum(max(int(r).bit_length() - 1 - lm_scoring.SHALLOW, 0) for r in ranks)
        weights, curve = learner.mixer.weights.copy(), learner.mixer.map.copy()
        learner.take(block)
        assert not np.array_equal(weights, learner.mixer.weights)
        assert not np.array_equal(curve, learner.mixer.map)
        assert learner.fitted == bits
    assert learner.finer.n.sum() == sum(learner.finer.every[lm_scoring.Finer.WIDTH :])
