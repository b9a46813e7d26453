"""Every operator and stage on awkward rows, on an empty table, and written as Parquet."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from edge import documents, rows  # noqa: E402
from orderstream.llm import (  # noqa: E402
    exact_dedup,
    html_text,
    lm_scoring,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    substring_dedup,
    token_output,
)

# Operators that give one row per document.
PER_ROW = {
    "substring": substring_dedup.remove_repeats,
    "exact": exact_dedup.dedup,
    "quality": quality.judge,
    "lm": lm_scoring.score_documents,
    "simhash": simhash.near_duplicates,
    "pii": pii.personal_data,
    "mix": mixing.mix,
}
OTHERS = {"tokens": token_output.pack_tokens, "pack": packing.pack}
OPERATORS = {**PER_ROW, **OTHERS}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, tmp_path, name):
    docs = documents(spark)
    result = OPERATORS[name](docs)
    result.write.parquet(str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.columns == result.columns
    if name in PER_ROW:
        ids = sorted((r[0] is None, r[0] or 0) for r in found.select("doc_id").collect())
        assert ids == sorted((r[0] is None, r[0] or 0) for r in rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    full, empty = documents(spark), documents(spark, many=False)
    result = OPERATORS[name](empty)
    assert result.collect() == []
    assert result.dtypes == OPERATORS[name](full).dtypes


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = documents(spark)
    kept = stage(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    given = set(rows())
    assert set(map(tuple, kept.collect())) <= given
    assert stage(spark, documents(spark, many=False), "").collect() == []


def test_extraction_on_awkward_pages(spark):
    pages = [
        (1, "u", "<p>Text, here</p>", "x"), (None, None, None, None), (2, "u", "", "y"),
        (3, None, "<script>1</script>", "z"), (1, "u", "<p>Text, here</p>", "x"),
        (4, "u", "<p>" + "word, " * 50_000, None), (5, "u", "<<<>>> < & &amp; &#0; </x>", "w"),
    ]
    schema = "page_id BIGINT, url STRING, html STRING, text STRING"
    found = html_text.extract(spark.createDataFrame(pages, schema)).collect()
    assert len(found) == len(pages)
    by_id = {row.page_id: row.text for row in found}
    assert by_id[1] == "Text, here"
    assert by_id[2] == by_id[3] == by_id[None] == ""
    assert by_id[4].count("word") == 50_000
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
