"""The pipeline against plain versions of its stages, and the contract without this subpackage."""

from __future__ import annotations

import os
import re
import subprocess
import sys
from collections import Counter
from itertools import combinations

import corpus_pipeline
from test_llm_dedup import plain_fingerprint, roots

import __spark_entry__ as contract
from orderstream.llm import mixing
from orderstream.llm.oracle import ORACLE

WORD = r"[^\x20\x09-\x0D]+"


def plain_survivors(spark, con, sf_dir) -> set[int]:
    """Ids left by quality rules (as SQL), exact dedup and SimHash, in that order."""
    kept = con.execute(f"SELECT doc_id FROM ({ORACLE['op4_quality_rules']}) WHERE kept").fetchall()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    first: dict[str, int] = {}
    for (doc_id,) in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[doc_id]), doc_id)
    fps = {doc_id: plain_fingerprint(texts[doc_id]) for doc_id in first.values()}
    pairs = [p for p in combinations(fps, 2) if (fps[p[0]] ^ fps[p[1]]).bit_count() <= 4]
    return set(roots(fps, pairs).values())


def test_pipeline(spark, con, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = plain_survivors(spark, con, sf_dir)
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        rows = stage(spark, rows, sf_dir)
        assert rows.dtypes == docs.dtypes
    assert {r.doc_id for r in rows.select("doc_id").collect()} == left

    mixed = mixing.mix(docs.where(docs["doc_id"].isin(*left))).collect()
    words = {r.doc_id: r["size"] for r in mixed}
    expected = Counter({r.doc_id: r.taken for r in mixed if r.taken})
    found = corpus_pipeline.run(spark, sf_dir).collect()
    taken: Counter = Counter()
    for row in found:
        taken[row.doc_id] += row.length
    assert taken == expected
    repeats = Counter(r.doc_id for r in found if r.piece == 0)
    assert repeats == Counter({r.doc_id: r.repeats for r in mixed if r.taken})
    assert all(row.length <= row.padded for row in found)
    places = Counter((row.padded, row.batch, row.slot) for row in found)
    assert max(places.values()) == 1
    assert max(words.values()) >= max(row.length for row in found)


def test_every_operator_is_registered():
    names = contract.queries()
    for number in range(1, 11):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5


def test_the_rest_works_without_this_subpackage():
    """As if the folders were gone: their import fails, the other queries stay."""
    root = os.path.dirname(os.path.abspath(contract.__file__))
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('orderstream.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'order_etl' in names and 'pipeline' not in names\n"
        "assert not any(name.startswith('op') and '_' in name and name[2].isdigit() for name in names)\n"
        "assert names >= set(e.oracle_sql())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
