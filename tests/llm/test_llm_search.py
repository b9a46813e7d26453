"""Hard negatives, ranked search and web archives against plain versions and awkward rows."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge import documents, rows  # noqa: E402
from orderstream.llm import hard_negatives, lexical, warc  # noqa: E402

# -- hard negatives -----------------------------------------------------------------

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, q STRING, score INT"


def vectors(count, size=9, seed=1):
    """Close and far vectors, ties, equal rows, nulls, odd numbers and lengths."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(size)] for _ in range(4)]
    made = []
    for i in range(count):
        centre = rnd.choice(centres)
        x = [c + rnd.gauss(0, 0.7) for c in centre]
        made.append((i, x, rnd.randrange(3)))
    same = made[3][1]
    made += [(count + i, same, i % 3) for i in range(30)]
    made += [made[5], (7, made[8][1], 2), (40, made[9][1], 1)]
    made += [
        (None, same, 1), (901, None, 1), (902, same, None), (903, [*same[:-1], None], 1),
        (904, [*same[:-1], math.nan], 1), (905, [*same[:-1], math.inf], 2), (906, [], 1),
        (907, same[:4], 2), (908, [0.0] * size, 0), (909, [1e5] * size, 0), (910, [3e38] * size, 0),
    ]
    return [(*row, "q", 1) for row in made]


def plain_negatives(given, every):
    kept = []
    for vec_id, x, label, *_ in given:
        if None in (vec_id, x, label) or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * float(np.float32(v))) for v in x]
        if all(abs(v) < 1 << 28 for v in q):
            kept.append((vec_id, label, q))
    anchors = {}
    for row in sorted(kept):
        if row[0] % every == 0:
            anchors.setdefault(row[0], row)
    found = []
    for anchor, label, a in anchors.values():
        scores = sorted(
            (-sum(u * v for u, v in zip(a, q)), vec_id, other) for vec_id, other, q in kept if vec_id != anchor
        )
        for ps, positive in [(-s, i) for s, i, other in scores if other == label][:5]:
            fit = [(-s, i) for s, i, other in scores if other != label and 30 * ps <= -100 * s <= 90 * ps]
            found += [(anchor, positive, r, i, ps, s) for r, (s, i) in enumerate(fit[:10], 1)]
    return sorted(found)


@pytest.mark.parametrize("size", [1, 9, 70])
def test_negatives_equal_plain_version(spark, monkeypatch, size):
    given = vectors(300, size)
    monkeypatch.setattr(hard_negatives, "ROWS", 32)
    frame = spark.createDataFrame(given, VECTORS).repartition(3)
    found = hard_negatives.mine(frame, every=10)
    assert sorted(map(tuple, found.collect())) == plain_negatives(given, 10)


def test_negatives_in_several_passes(spark, monkeypatch):
    given = vectors(120)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 8 * 50 * 4)
    found = hard_negatives.mine(spark.createDataFrame(given, VECTORS), every=10)
    assert sorted(map(tuple, found.collect())) == plain_negatives(given, 10)


def test_negatives_of_no_rows(spark):
    empty = hard_negatives.mine(spark.createDataFrame([], VECTORS))
    no_anchor = hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1, "", 0)], VECTORS))
    assert empty.collect() == no_anchor.collect() == []
    assert empty.dtypes == no_anchor.dtypes


@pytest.mark.parametrize("size", [1, 3, 64, 100])
def test_bounds_hold_every_score(size):
    rng = np.random.default_rng(size)
    q = rng.integers(-300, 300, (400, size))
    q[:5], q[5:9] = 0, q[9]
    shape = hard_negatives.Shape(size, q.mean(0), hard_negatives.rotation(size))
    codes = hard_negatives.encode(q, shape)
    anchors = hard_negatives.Anchors(np.arange(40), np.zeros(40, np.int64), q[:40], shape)
    least, most = anchors.bounds(slice(0, 40), *codes)
    true = q[:40] @ q.T
    assert (least <= true).all() and (true <= most).all()
    own, rows_ = anchors.pair(q)
    assert (own @ rows_.T == true).all()
    if size == 64:  # and tell rows apart
        lengths = np.sqrt((q * q).sum(1))
        assert (most - least).mean() < 0.5 * (lengths[:40, None] * lengths).mean()


# -- ranked search ------------------------------------------------------------------

ITEMS = "item_id BIGINT, text STRING, m INT, bag STRING"


def plain_terms(text):
    found = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in word) for word in found]


def plain_search(docs, items, top=20):
    texts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, bag in texts if bag)
    total = sum(sum(bag.values()) for _, bag in texts)
    df = Counter(word for _, bag in texts for word in bag)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in texts:
            m = 75 + 25 * sum(bag.values()) * n_docs // max(total, 1)
            score = 0
            for word in plain_terms(text):
                if word in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[word] + 1)))
                    score += w * (10**9 * bag[word] // (1000 * bag[word] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda row: (row[0], row[1], row[2] or 0))
        found += [(item_id, rank, row[2], -row[0]) for rank, row in enumerate(scored[:top], 1)]
    return sorted(found, key=str)


def some_items(docs):
    texts = [text for _, text in docs if text and len(text.split()) > 1]
    made = [(i, " ".join(text.split()[:12])) for i, text in enumerate(texts)]
    made += [(90, None), (91, ""), (92, "... !"), (93, "NoSuchTerm"), (None, texts[0]), (1, texts[2]), (1, texts[2])]
    return [(*row, 1, "x") for row in made]


def test_search_equals_plain_version(spark, monkeypatch):
    docs = [row[:2] for row in rows()]
    items = some_items(docs)
    frame = spark.createDataFrame(items, ITEMS)
    expected = plain_search(docs, [row[:2] for row in items], 5)
    found = lexical.search(documents(spark), frame, 5)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    # Tables of weights for a few items, and a vocabulary for a few.
    monkeypatch.setattr(lexical, "WEIGHTS", 30)
    monkeypatch.setattr(lexical, "CLASSES", 3)
    monkeypatch.setattr(lexical, "VOCABULARY_BYTES", 600)
    found = lexical.search(documents(spark), frame, 5)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_search_expands_classes_in_order(spark):
    """Copies in one class, and ties between classes, interleave by doc_id."""
    docs = [(i, "alpha beta" if i % 3 else "beta, alpha", "x", "y") for i in range(40)]
    docs += [(100 + i, f"filler word{i}", "x", "y") for i in range(60)]
    docs += [(50, "alpha other1", "x", "y"), (51, "alpha other2", "x", "y"), (8, "alpha beta", "", "")]
    random.Random(3).shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, bag STRING, key STRING").repartition(4)
    items = spark.createDataFrame([(1, "Alpha", 1, ""), (2, "beta beta alpha", 1, "")], ITEMS)
    expected = plain_search([row[:2] for row in docs], [(1, "Alpha"), (2, "beta beta alpha")])
    assert sorted(map(tuple, lexical.search(frame, items).collect()), key=str) == expected


def test_search_of_no_rows(spark):
    items = spark.createDataFrame([(1, "word", 1, "")], ITEMS)
    no_docs = lexical.search(documents(spark, many=False), items)
    no_items = lexical.search(documents(spark), spark.createDataFrame([], ITEMS))
    assert no_docs.collect() == no_items.collect() == []
    assert no_docs.dtypes == no_items.dtypes


# -- web archives -------------------------------------------------------------------

PAGES = "page_id BIGINT, url STRING, html BINARY, archive STRING, offset INT"


def pages():
    long = ("long page " * 50_000).encode()
    made = [
        (1, "http://a/1", b"<p>same</p>"), (2, "http://a/2", b"<p>same</p>"), (9, None, b"<p>same</p>"),
        (3, "http://a/3", None), (4, "http://a/4", b""), (5, "http://a/b c\r\nX: y", b"odd url"),
        (6, "http://a/6", b"bad \xff\xfe bytes"), (7, "u", long), (8, "u", long), (None, None, b"no id"),
        (None, "u", b"no id too"), (10, "u", b"no id too"), (11, "u", b"twice"), (11, "u", b"twice"),
        (11, "v", b"twice"), (12, "u", b"\r\n\r\nWARC/1.1\r\n\r\n"), (13, "u", "né 日本".encode()),
    ]
    return [(*row, "x", i) for i, row in enumerate(made)]


def as_text(spark, given):
    frame = spark.createDataFrame(given, PAGES).repartition(3)
    return frame.withColumn("html", frame["html"].cast("string"))


def plain_records(given, min_bytes=0):
    best = {}
    for page_id, url, html, *_ in given:
        order = (page_id is not None, page_id or 0, url is not None, url or "")
        best[html or b""] = max(best.get(html or b"", order), order)
    found, answered = [], set()
    for page_id, url, html, *_ in given:
        data = html or b""
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        order = (page_id is not None, page_id or 0, url is not None, url or "")
        response = len(data) < min_bytes or (order == best[data] and data not in answered)
        if len(data) >= min_bytes and response:
            answered.add(data)
        to = None if response else best[data][1]
        found.append((page_id, url, "response" if response else "revisit", len(data), digest, to, data if response else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_records_read_back(spark, min_bytes):
    index = warc.write_archives(as_text(spark, pages()), min_bytes=min_bytes, archive_bytes=400)
    found = [(*row[:-1], None if row[-1] is None else bytes(row[-1])) for row in warc.read_records(index).collect()]
    assert sorted(found, key=str) == plain_records(pages(), min_bytes)


def test_archives_are_gzip_members_in_order(spark):
    """Any reader of the format can go through an archive without the index."""
    index = warc.write_archives(as_text(spark, pages()))
    for archive in {row.archive for row in index.collect()}:
        system, path = warc._opened(archive)
        with system.open_input_file(path) as file:
            rest = file.read()
        at, places = 0, []
        while rest:
            reader = zlib.decompressobj(31)
            whole = reader.decompress(rest)
            assert whole.startswith(b"WARC/1.1\r\nWARC-Type: ") and whole.endswith(b"\r\n\r\n")
            length = len(rest) - len(reader.unused_data)
            places.append((at, length, warc.parse(whole)["payload_digest"]))
            at, rest = at + length, reader.unused_data
        rows = index.where(index["archive"] == archive).orderBy("offset").collect()
        assert [(row.offset, row.length, row.payload_digest) for row in rows] == places


def test_selected_records_share_reads(spark):
    index = warc.write_archives(as_text(spark, pages()))
    some = index.where("page_id in (2, 6, 13)")
    found = {row.page_id: row for row in warc.read_records(some).collect()}
    assert set(found) == {2, 6, 13} and bytes(found[13].payload).decode() == "né 日本"
    assert found[2].refers_to == 9 and found[2].payload is None
    places = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 50), ("b", 0, 5), ("b", 5, 500), ("b", 505, 1)]
    assert list(warc.ranges(places, gap=5, most=60)) == [
        ("a", 0, 30, [0, 1, 2]), ("a", 100, 150, [3]), ("b", 0, 5, [4]), ("b", 5, 505, [5]), ("b", 505, 506, [6]),
    ]


def test_a_changed_record_is_an_error():
    whole, _ = warc.record(1, "u", b"payload", True, None, "id")
    assert warc.parse(whole)["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        warc.parse(whole.replace(b"payload", b"changed"))


def test_archives_of_no_pages(spark):
    index = warc.write_archives(spark.createDataFrame([], PAGES))
    assert index.collect() == [] and warc.read_records(index).collect() == []
