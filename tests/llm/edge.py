"""Documents with every awkward value, for all operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, row STRING, fp STRING, t INT"

WORDS = [f"{a}{b}" for a in "ba co di fu ge ha li mo nu pe".split() for b in "n r st ll m k".split()]


def prose(seed: int, count: int) -> str:
    rnd = random.Random(seed)
    words = rnd.choices(WORDS, k=count)
    words[9::10] = [f"{word}." for word in words[9::10]]
    words[39::40] = [f"{word}\n" for word in words[39::40]]
    return " ".join(words)


def rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows."""
    long = prose(1, 30_000)
    copy = prose(2, 120)
    near = copy.replace(copy.split()[60], "changed", 1)
    texts = [
        (1, copy), (2, copy.replace(" ", "  ")), (3, near), (4, None), (5, ""), (6, " \n\t "),
        (7, long), (8, long + " tail"), (9, "one two"), (9, "one two"), (9, "another text"),
        (None, copy), (None, "no id"), (None, "no id"), (10, "a b c d " * 100), (11, "### $$$ " * 60),
        (12, "x" * 50_000), (13, "né ñandú 日本語 \U0001f600 Ünïcode"), (14, prose(3, 200)),
    ]
    kinds = [("en", "a"), ("en", "b"), (None, "a"), ("de", None), (None, None)]
    return [
        (doc_id, text, *kinds[i % len(kinds)], None if i % 3 else len(text or ""), "r", None, i)
        for i, (doc_id, text) in enumerate(texts)
    ]


def documents(spark, many: bool = True):
    found = rows() if many else []
    return spark.createDataFrame(found, SCHEMA).repartition(3) if many else spark.createDataFrame([], SCHEMA)
