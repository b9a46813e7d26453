"""Quality rules, personal data and page text against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderstream.llm import html_text, pii, quality
from orderstream.llm.catalog import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


# -- quality ------------------------------------------------------------------------


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


@pytest.mark.parametrize("hashed", [quality.HASHED, "-5L", "shiftleft(length({}) * 4L + length({}) * 2 + length({}), 40)"])
def test_counts(spark, hashed):
    """Also with hashes that mix up all windows, or those of equal lengths."""
    rnd = random.Random(4)
    texts = [None, "", " ", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n\n x\nx\n \n", "é# <b> | x\r\n x"]
    for _ in range(120):
        some = rnd.choices(["a", "b", "cc", "d|", "é", "\U0001f600"], k=rnd.randint(1, 90))
        texts.append("".join(w + rnd.choice([" ", "  ", "\n", "\t", " \x0b"]) for w in some))
    texts.append(" ".join(rnd.choices("abcdefghij", k=40_000)))
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    for row in quality.with_counts(rows, "text", hashed).collect():
        assert tuple(row[name] for name in quality.COUNTS) == plain_counts(texts[row.i])


def test_counts_are_not_computed_again_for_a_filter(spark):
    docs = spark.createDataFrame([("a b c", "en", "s")], "text STRING, lang STRING, source STRING")
    plan = quality.drop_low_quality(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1


def test_thresholds_follow_the_source(spark):
    """The same text is junk in one source and usual in another; small groups use the language."""
    rnd = random.Random(1)

    def text(size: int, mark: str = "") -> str:
        return " ".join("".join(rnd.choices("abcdefgh", k=size)) + mark for _ in range(80))

    rows = [(i, text(5), "en", "prose") for i in range(300)]
    rows += [(1000 + i, text(12, "#"), "en", "code") for i in range(300)]
    rows += [(2000, text(12, "#"), "en", "prose"), (2001, text(5), "en", "prose"), (2002, text(5), "en", "few")]
    rows += [(2003, "too short", "en", "prose"), (2004, "a b c " * 50, "en", "prose"), (2005, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    found = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(found[i].kept for i in [*range(300), *range(1000, 1300), 2001, 2002])
    assert not found[2000].kept and not found[2000].base_failed
    assert all(found[i].base_failed and not found[i].kept for i in (2003, 2004, 2005))
    kept = quality.drop_low_quality(docs)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}


def test_sketches_merge(spark):
    values = [random.Random(2).randint(0, 10**6) for _ in range(5000)]
    rows = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "v BIGINT, part INT")
    bucket = quality._bucket(rows["v"]).alias("bucket")
    parts = rows.select("part", bucket).groupBy("part", "bucket").count().withColumnRenamed("count", "n")
    sketch = parts.selectExpr("'m' AS metric", "bucket", "n")
    got = quality._quartiles(sketch).first()
    ordered = sorted(values)
    assert got["size"] == len(values)
    for k, name in ((1, "q25"), (2, "q50"), (3, "q75")):
        exact = ordered[-(-len(values) * k // 4) - 1]
        assert got[name] <= exact <= got[name] * (1 + 1 / 32) + 1


def test_quality_separates_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [r for r in QUERIES["op4_quality_rules"](spark, folder).collect() if r.doc_id in labels]
    passed = [r for r in found if not r.base_failed]
    good = [r.kept for r in passed if labels[r.doc_id]]
    bad = [r.kept for r in passed if not labels[r.doc_id]]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.2 * len(bad)


# -- personal data ------------------------------------------------------------------


def plain_spans(text: str) -> list[tuple]:
    def luhn(digits: str) -> bool:
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


ANCHORS = pii.automaton()


@settings(deadline=None, max_examples=1500)
@given(st.text(alphabet="01259. @a-+b_%é()", max_size=50) | st.text(alphabet="0123456789 -", max_size=40))
def test_base_spans(text):
    found = pii.find(text, ANCHORS)
    assert [(s.start, s.kind, s.end) for s in found if s.base] == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("mail müller@bücher.de now", "email", "müller@bücher.de"),
        ("get ftp://bob:pw@host.example.org/x.", "url", "ftp://bob:pw@host.example.org/x"),
        ("IBAN DE89 3704 0044 0532 0130 00 OK", "account", "DE89 3704 0044 0532 0130 00"),
        ("to GB29NWBK60161331926819.", "account", "GB29NWBK60161331926819"),
        ("host 2001:db8::8a2e:370:7334 up", "ip", "2001:db8::8a2e:370:7334"),
        ("Account no. 12345678, thanks", "account", "12345678"),
    ],
)
def test_added_spans(text, kind, value):
    added = [s for s in pii.find(text, ANCHORS) if not s.base]
    assert [(pii.KINDS[s.kind], text[s.start : s.end]) for s in added] == [(kind, value)]
    assert value not in pii.masked(text, added)


@pytest.mark.parametrize(
    "text",
    [
        "std::string a::b", "http://example.org/a@b", "DE00 3704 0044 0532 0130 00", "on account of it",
        "accountant 12345678", "version 1.2.3", "12:34:56", "a @ b", "", "AB12 is a place",
    ],
)
def test_nothing_added(text):
    assert pii.find(text, ANCHORS) == []


def test_personal_data_of_documents(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in QUERIES["op8_personal_data"](spark, sf_dir).collect():
        base = plain_spans(texts[row.doc_id])
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        counts = Counter(k for _, k, _ in base)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [counts[k] for k in range(4)]
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


def test_masked_text(spark):
    docs = spark.createDataFrame([(1, "a x@y.zz b 10.0.0.1"), (2, None)], "doc_id BIGINT, text STRING")
    found = {r.doc_id: r.masked for r in pii.personal_data(docs, mask=True).collect()}
    assert found == {1: "a <email> b <ip>", 2: ""}


# -- pages --------------------------------------------------------------------------

LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<script>var a='<p>x</p>'</script><style>p{}</style>", ""),
        ("just text &amp; more", "just text & more"),
        (f"<p>{LONG}<p>{LONG}", f"{LONG}\n{LONG}"),
        (
            "<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div id=cookie-notice><p>We use"
            f" cookies, {LONG}</p></div><div class=content><h1>Title</h1><div class=post-body><p>{LONG}</p>"
            f"<p>{LONG} Two.</p><ul><li>One<li>Two</ul><p>End.</p></div></div><div class=sidebar><p>{LONG}</p>"
            f"<p>{LONG}</p></div><section id=comments><div class=comment><p>{LONG}</p></div></section>"
            f"<form><p>{LONG}</p></form><footer><p>{LONG}</p></footer>",
            f"Title\n{LONG}\n{LONG} Two.\nOne\nTwo\nEnd.",
        ),
        (
            f"<article><header class=entry-header><h1>T</h1><p>By x</p></header><div><p>{LONG}</p></div>"
            f"<section class=comments><p>{LONG}</p></section><aside>{LONG}</aside></article>",
            f"T\n{LONG}",
        ),
        (
            f"<nav>a</nav><main><h2>Head</h2><p>{LONG}</p><section><h3>Sub</h3><p>{LONG}</p></section>"
            f"<section><h3>Sub 2</h3><p>{LONG}</p></section></main>",
            f"Head\n{LONG}\nSub\n{LONG}\nSub 2\n{LONG}",
        ),
        (f"<article><p>a <b>b\n\t c</b><br>d&nbsp;e &lt;i&gt; {LONG}</article>", f"a b c d\xa0e <i> {LONG}"),
        (f'<article><a title="x > y" href=/>l</a> <p data-x=\'a>b\'>{LONG}</p></article>', f"l\n{LONG}"),
        (f"<article><p>{LONG}</p><div class=ad>Buy</div><div hidden>no</div></article>", LONG),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_main_text_of_pages(spark, sf_dir):
    """The given pages hold one article of headings and paragraphs."""
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in QUERIES["op10_html_extraction"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.S)[1].replace("<br>", " ")
        blocks = (html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)[^>]*>", article))
        blocks = (re.sub(r"[\x20\x09-\x0D]+", " ", block).strip(" ") for block in blocks)
        assert row.text == "\n".join(filter(None, blocks))
        assert row.n_chars == len(row.text)


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<a href=x>", "</a>", "<li>", "<td", '"', ">",
                                 "<!--", "-->", "<script>", "x, y", "&amp;", "<table>", "</table>", "<b>", "</b"])))
def test_any_markup_is_read(parts):
    html_text.main_text("".join(parts))
