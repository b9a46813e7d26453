"""Texts that break careless code: long runs, bytes that are no UTF-8, deep nesting, odd names."""

from __future__ import annotations

import re
import time

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderstream.llm import exact_dedup, html_text, lm_scoring, pii, substring_dedup, token_output

PROSE = "This is a long paragraph of prose, with commas, that goes on so that it counts as real text. " * 2


def broken(spark):
    """One row of bytes that are no UTF-8 between rows that are."""
    rows = [(1, b"plain text here, and more of it"), (2, b"bad \xff\xfe\xc3 bytes a@b.org \xff"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text BINARY")
    return frame.withColumn("text", F.col("text").cast("string"))


def seconds(work):
    begun = time.perf_counter()
    work()
    return time.perf_counter() - begun


# -- tokens -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def own():
    ranks = token_output.load_vocabulary(token_output.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("space", [" ", "\n", "\t \n", "　", "\x85\xa0"])
def test_long_runs_of_white_space_get_the_same_ids(own, space):
    for count in (4095, 4096, 4097, 20_000):
        run = (space * count)[:count]
        for text in (run, f"a{run}", f"{run}b", f"x.{run}'s 5{run}é{run}", f"1{run}日本 {run} y"):
            whole = own.encode_to_numpy(text, disallowed_special=())
            assert np.array_equal(token_output.encode(own, text), whole)


def test_a_million_spaces(own):
    for text in (" " * 1_000_000 + "x", "\n" * 2_000_000, "a" + " \n" * 1_000_000):
        assert seconds(lambda text=text: token_output.encode(own, text)) < 20
    ids = token_output.encode(own, "a" + " " * 1_000_000 + "b")
    assert own.decode(ids.tolist()) == "a" + " " * 1_000_000 + "b"


# -- bytes that are no UTF-8 --------------------------------------------------------


def test_bytes_that_are_no_text(spark):
    docs = broken(spark)
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert [(s.kind, s.start, s.end) for s in spans[2]] == [("email", 14, 21)] and spans[1] == spans[3] == []
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert left[2] == b"bad \xff\xfe\xc3 bytes a@b.org \xff".decode("utf-8", "replace") and left[3] == ""
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    texts = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert texts[2].startswith("bad ��� bytes")
    assert token_output.pack_tokens(docs).count() == 1
    assert lm_scoring.score_documents(docs).count() == exact_dedup.dedup(docs).count() == 3


# -- personal data ------------------------------------------------------------------


def found(text):
    return [(pii.KINDS[s.kind], text[s.start : s.end], s.checked) for s in pii.find(text, pii.automaton())]


def test_colons_and_cues_take_linear_time():
    anchors = pii.automaton()
    for text in (":" * 1_000_000, "f::" * 300_000, "account" + " " * 500_000, "account:" * 100_000, "@" * 300_000):
        assert seconds(lambda text=text: pii.find(text, anchors)) < 15


def test_addresses_between_colons():
    assert found("at 2001:db8::1 and ::1:2:3.") == [("ip", "2001:db8::1", True), ("ip", "::1:2:3", True)]
    assert found("x" + "f" * 60 + "::1:2:3") == []


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Customer ID 123456789", [("account", "123456789", False)]),
        ("ACCOUNT no. 12345678", [("account", "12345678", False)]),
        ("Kontonummer: 1234 5678 90", [("account", "1234 5678 90", False)]),
        ("SSN 123-45-6789", [("account", "123-45-6789", True)]),
        ("ssn: 666-45-6789", [("account", "666-45-6789", False)]),
        ("account 20240131", []),
        ("account: 31-01-2024", []),
        ("account: 2019 2020 2021", []),
        ("account 20241331", [("account", "20241331", False)]),
        ("accounting 123456789", []),
    ],
)
def test_account_numbers(text, expected):
    assert found(text) == expected


def test_places_hold_where_small_letters_are_longer():
    text = "İİ ACCOUNT 12345678"
    assert found(text) == [("account", "12345678", False)]


# -- pages --------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name", ["class='has-sidebar layout'", "class='post-comments-on-law'", "id='ad-free-story'", "class='sidebar'"]
)
def test_a_wrapper_with_an_odd_name_is_kept(name):
    page = (
        f"<body><nav><a href=x>menu</a></nav><h1>Title</h1><div {name}><p>{PROSE}</p><p>{PROSE}2</p>"
        "<ul><li>one thing</li></ul></div><div class='ad'>Buy</div><footer>end</footer></body>"
    )
    line = PROSE.strip()
    assert html_text.main_text(page) == f"Title\n{line}\n{line} 2\none thing"


@pytest.mark.parametrize("name", ["class='comments'", "id='comment-list'", "class='sidebar right'", "class='newsletter-box'"])
def test_what_surrounds_a_text_goes(name):
    page = f"<body><h1>Title</h1><div class=x><p>{PROSE}</p><p>{PROSE}</p></div><div {name}><p>{PROSE}!</p></div></body>"
    assert html_text.main_text(page) == "\n".join(["Title", PROSE.strip(), PROSE.strip()])


def test_readers_write_more_than_the_article():
    page = f"<h1>T</h1><div><p>{PROSE}</p></div><div class='comments'>{f'<p>{PROSE}, no</p>' * 9}</div>"
    assert html_text.main_text(page) == f"T\n{PROSE.strip()}"


def test_paragraphs_of_an_article_with_odd_names():
    page = (
        f"<article><p>{PROSE}</p><p class='share-price'>{PROSE}1</p><div class='share'>Share</div>"
        f"<div class='cookie-notice'>{PROSE}</div><header><h2>Part</h2></header></article>"
    )
    assert html_text.main_text(page) == f"{PROSE.strip()}\n{PROSE.strip()} 1\nPart"


def test_pages_decided_by_scores_alone(spark, sf_dir):
    """The given pages say the same with the article element called by another name."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()
    assert pages
    for (page,) in pages:
        text = html_text.main_text(page)
        assert text == html_text.main_text(re.sub("<(/?)article", r"<\1div", page)) != ""


def test_deep_pages_take_linear_time():
    many = 50_000
    for page in (
        "<div>" * many + "text" + "</section>" * many, "<article>" * many + "x" + "<header>h</header>" * 9,
        "<div>" * many + "<li>a" * many, "<li><ul>" + "<div>" * many + "<li>x" * many,
        "<body>" + "<div class='ad'>x</div>" * many + f"<p>{PROSE}</p>",
    ):
        assert seconds(lambda page=page: html_text.main_text(page)) < 20
    deep = html_text.main_text("<div>" * 2000 + f"<p>{PROSE}</p><p>{PROSE}</p>" + "</div>" * 2000 + "<p>after</p>")
    assert deep.count(PROSE.strip()) == 2


# -- the rest -----------------------------------------------------------------------


def test_documents_that_must_have_an_id(spark):
    schema = StructType([StructField("doc_id", LongType(), False), StructField("text", StringType(), False)])
    docs = spark.createDataFrame([(i, f"word{i} and others {i}") for i in range(30)], schema)
    assert lm_scoring.score_documents(docs).count() == 30


def test_a_large_batch_on_an_empty_snapshot(spark):
    """Its digests meet their filters in many tasks."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 1500).alias("text"))
    found = exact_dedup.dedup(rows, in_snapshot=F.lit(False), shard_rows=100).collect()
    assert all(r.keep_id == r.doc_id % 1500 and r.group_size == 2 for r in found)
    texts = rows.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 5, "0")))
    by_text = exact_dedup.dedup(texts).collect()
    assert len(by_text) == 3000 and sum(r.kept for r in by_text) == 1500


def plain_repeats(docs):
    """Unit numbers that an earlier document has, by plain dictionaries over all texts."""
    listed = [(doc_id, list(substring_dedup.keys(text or ""))) for doc_id, text in docs]
    first = {}
    for doc_id, found in listed:
        for _, key in found:
            first[key] = min(first.get(key, doc_id), doc_id)
    result = []
    for doc_id, found in listed:
        seen, repeated = set(), {}
        for number, key in found:
            if first[key] < doc_id:
                repeated[number] = first[key]
            elif key in seen:
                repeated[number] = doc_id
            seen.add(key)
        result.append(repeated)
    return result


def test_repeats_equal_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    given = [tuple(row) for row in docs.collect()]
    expected = {
        doc_id: substring_dedup.cut(text or "", repeated, doc_id)
        for (doc_id, text), repeated in zip(given, plain_repeats(given), strict=True)
    }
    found = substring_dedup.remove_repeats(docs).collect()
    assert sum(r.n_removed for r in found) > 50
    for row in found:
        text, runs = expected[row.doc_id]
        assert row.text == text
        assert [(r.start, r.end, r.keep_id) for r in row.removed] == runs


@pytest.mark.parametrize("before", ["", "In other news from the same place, ", "So, "])
def test_a_passage_is_found_in_a_sentence_of_any_length(spark, before):
    """Alone, or in a sentence of more characters; a clause at either end may be lost."""
    passage = ", ".join(f"clause {i} says something of its own number {i * i}" for i in range(8))
    rows = [(1, f"{passage}. Another sentence of document one."), (2, f"Begin here. {before}{passage}, and more of two.")]
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    second = next(r for r in found if r.doc_id == 2)
    assert second.removed_words >= len(passage.split()) * 6 // 8
    assert "Begin here." in second.text and "and more of two." in second.text
