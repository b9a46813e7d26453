"""Exact, near and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderstream.llm import exact_dedup, simhash, substring_dedup
from orderstream.llm.catalog import QUERIES
from orderstream.llm.components import components
from orderstream.llm.oracle import ORACLE


def roots(nodes, pairs):
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {node: find(node) for node in nodes}


# -- exact --------------------------------------------------------------------------


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == ""


@pytest.mark.parametrize("count", [0, 1, 2, 10, 1000, 70_000])
def test_filter_knows_its_keys(count):
    rng = np.random.default_rng(count)
    keys = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    built = exact_dedup.FuseFilter.from_bytes(exact_dedup.FuseFilter.build(keys).to_bytes())
    assert built.may_hold(keys).all()
    others = rng.integers(1 << 63, 1 << 64, 100_000, dtype=np.uint64)
    assert built.may_hold(others).mean() < 0.001
    if count > 1000:
        assert len(built.to_bytes()) < 2.6 * count


def texts_with_copies():
    rnd = random.Random(5)
    texts = [rnd.choice(["a b", "a  b", "a\tb", " a b", "c", "", None, "d\n e", "d e"]) for _ in range(300)]
    return list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, "c"), (None, "only"), (None, "only")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, weak):
    """Also with a digest that mixes up different texts, and shards of a few digests."""
    rows = texts_with_copies()
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    digest = (lambda text: F.length(text).cast("string")) if weak else exact_dedup.sha256
    found = exact_dedup.dedup(docs, digest=digest, shard_rows=2).collect()
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    expected = sorted(
        (str(doc_id), str(min((i for i in ids if i is not None), default=None)), len(ids))
        for ids in groups.values()
        for doc_id in ids
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == expected
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    if not weak:
        digests = {hashlib.sha256(text.encode()).hexdigest() for text in groups}
        assert {r.digest for r in found} == digests


def test_screened_batch_joins_only_positives(spark):
    old = spark.createDataFrame([(f"d{i}",) for i in range(500)], "digest STRING")
    new = spark.createDataFrame([(f"d{i}", i) for i in range(400, 2000)], "digest STRING, size INT")
    filters = exact_dedup.build_filters(old, 7)
    found = exact_dedup.screen(new, filters, 7).collect()
    known = {r.digest for r in found if r.known}
    assert len(found) == 1600
    assert known >= {f"d{i}" for i in range(400, 500)}
    assert len(known) < 110


@pytest.mark.parametrize("weak", [False, True])
def test_hot_digests_are_dealt_in_pieces(spark, monkeypatch, weak):
    """Digests of one text or of two, of very many rows and of a few."""
    monkeypatch.setattr(exact_dedup, "PIECE_ROWS", 16)
    monkeypatch.setattr(exact_dedup, "HOT", 4)
    texts = [("same", 400), ("twin a", 150), ("twin b", 3), ("few", 2), ("one", 1), ("other", 1)]
    rows = [(i, text) for i, text in enumerate(text for text, n in texts for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(7)
    digest = (lambda text: F.sha2(F.substring(text, 1, 4).cast("binary"), 256)) if weak else exact_dedup.sha256
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.dedup(docs, digest=digest).collect()}
    first = {}
    for i, text in rows:
        first.setdefault(text, i)
    assert got == {i: (first[text], dict(texts)[text]) for i, text in rows}


def test_dropping_exact_copies_keeps_one(spark):
    docs = spark.createDataFrame(texts_with_copies(), "doc_id BIGINT, text STRING")
    kept = exact_dedup.drop_exact_duplicates(docs).collect()
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept]
    assert len(texts) == len(set(texts)) == len({t or "" for t in texts})
    assert set(texts) == {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts_with_copies()}


# -- near ---------------------------------------------------------------------------


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rnd = random.Random(radius)
    tries = [rnd.sample(range(64), radius) for _ in range(20_000)]
    for places in [*combinations(range(12), radius), *tries]:
        apart = sum(1 << p for p in places)
        assert any(not mask & apart for mask in masks)


def plain_fingerprint(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="aBc é\n\t\x0b\x00Ü", max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_long_text_in_blocks(monkeypatch):
    text = " ".join(f"word{i % 997}" for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    blocks = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda data: blocks(data, 100))
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("bucket", [1, 4, 1024])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    """Dense balls and a chain; with small buckets through midpoints."""
    rnd = random.Random(9)
    fps = set()
    for _ in range(4):
        centre = rnd.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(60)}
    chain = rnd.getrandbits(64)
    for i in range(12):
        chain ^= 0b1111 << 4 * i
        fps.add(chain)
    signed = sorted(fp - (1 << 64) if fp >> 63 else fp for fp in fps)
    rows = spark.createDataFrame([(fp,) for fp in signed], "fp BIGINT")
    links = simhash.links(rows, 4, bucket)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in links.collect())
    found = {r.node: r.root for r in components(links).collect()}
    pairs = [p for p in combinations(signed, 2) if ((p[0] ^ p[1]) & (1 << 64) - 1).bit_count() <= 4]
    assert {fp: found.get(fp, fp) for fp in signed} == roots(signed, pairs)


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(-400, 400), rnd.randrange(-400, 400)) for _ in range(350)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(80)] + [(7, 7)]
    found = components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT"))
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    rows = found.collect()
    assert {r.node: r.root for r in rows} == roots(nodes, [p for p in pairs if p[0] != p[1]])
    assert len(rows) == len(nodes)


def test_near_duplicates_of_documents(spark, sf_dir):
    """The registered query against all pairs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    pairs = [p for p in combinations(fps, 2) if (fps[p[0]] ^ fps[p[1]]).bit_count() <= 4]
    expected = roots(fps, pairs)
    found = QUERIES["op7_simhash_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: int(r.fingerprint, 16) for r in found} == fps
    kept = simhash.drop_near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(expected.values()))


# -- substrings ---------------------------------------------------------------------


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab,. \n!é", max_size=400))
def test_units_cover_the_text(text):
    found = list(substring_dedup.units(text))
    assert "".join(text[a:b] for a, b, *_ in found) == text
    assert all(one.end == other.start for one, other in zip(found, found[1:], strict=False))


def sentences(seed: int, count: int) -> list[str]:
    rnd = random.Random(seed)
    return [
        " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(3, 7))) for _ in range(rnd.randint(6, 14))) + "."
        for _ in range(count)
    ]


def test_substring_dedup(spark):
    passage = sentences(1, 8)
    shared = " ".join(passage)
    own = [" ".join(sentences(10 + i, 6)) for i in range(6)]
    texts = {
        1: f"{own[0]}\n{shared}\n{own[1]}",
        2: f"{own[2]} {shared} {own[3]}",  # inside a line
        3: f"{own[4]}\n{shared.upper()}",  # normalised alike
        4: own[5],
        5: "short line.\nshort line.\n" + " ".join(sentences(30, 3)),
        6: f"cut off {shared}",  # its first sentence is another one
        None: own[5],
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert found[1].text == texts[1] and found[1].n_removed == 0
    assert found[4].text == texts[4] and found[5].text == texts[5]
    assert found[2].text == f"{own[2]} {own[3]}"
    assert found[3].text == f"{own[4]}\n"
    assert found[None].text == ""
    assert found[6].text == f"cut off {passage[0]} "
    for doc_id, row in found.items():
        left, done = "", 0
        for run in row.removed:
            assert run.keep_id in (1, 4)
            left, done = left + texts[doc_id][done : run.start], run.end
        assert left + texts[doc_id][done:] == row.text


def test_substring_dedup_within_a_text(spark):
    line = " ".join(sentences(2, 1))
    docs = spark.createDataFrame([(1, f"{line}\n{line}\n{line}")], "doc_id BIGINT, text STRING")
    row = substring_dedup.remove_repeats(docs).first()
    assert row.text == f"{line}\n"
    assert [run.keep_id for run in row.removed] == [1]


def test_short_lines_of_its_own_stay_between_repeated_lines(spark):
    """A run passes over a short unit only if an earlier document has it there."""
    first, second, third = sentences(3, 3)
    own = "\n".join(f"Name{i} {i}" for i in range(40)) + "\n\u540d\u524d\u306e\u4e00\u89a7"
    texts = {
        1: f"{first}\n{second} Yes. {third}",
        2: f"{first}\n{own}\n{second}",
        3: f"{second} Yes. {third}",
        4: f"{second} No. {third}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert found[1].text == texts[1]
    assert found[2].text == f"{own}\n"
    assert [run.keep_id for run in found[2].removed] == [1, 1]
    assert found[3].text == ""
    assert found[4].text.strip() == "No."


def test_repeated_lines_of_any_length_are_cut(spark):
    """Also of one word, and of scripts that put no space between words."""
    first, second, third, fourth = sentences(8, 4)
    chinese = "本网站所有内容均由编辑部整理发布，未经许可不得转载。" * 2
    texts = {
        1: f"Share\n{first}\n{chinese}\nRead more here",
        2: f"{second}\nshare\n{chinese}\n{third}\nRead  more here",
        3: f"Share this. {fourth} 前言各不相同！{chinese}",
        4: "5\n5\n6\n5",
        5: f"Read more here. {sentences(9, 1)[0]}",  # a short sentence inside a line
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    half = chinese[: len(chinese) // 2]
    assert found[1].text == texts[1].replace(chinese + "\n", half)  # the text repeats it itself
    assert found[2].text == f"{second}\n{third}\n"
    assert found[3].text == f"Share this. {fourth} 前言各不相同！"
    assert found[4].text == texts[4]
    assert found[5].text == texts[5]
    assert [run.keep_id for run in found[2].removed] == [1, 1]
