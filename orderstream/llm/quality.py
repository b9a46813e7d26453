"""Quality rules with thresholds taken from quantile sketches of each language and source.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.llm.common import SPACES, stored

# The base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
_SPACE = SPACES.removesuffix("+")
_TRIM = " \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Hash of a window of three words.
HASHED = "xxhash64({}, {}, {})"

# Documents a language or source needs for thresholds of its own.
MIN_GROUP = 100

# How many spreads from the median a value may be.
SPREADS = 6


@dataclass(frozen=True)
class Metric:
    """A whole-number measure of a document, and how far from the median it may always be."""

    name: str
    part: str
    whole: str
    scale: int
    slack: int
    both: bool = False

    def value(self) -> Column:
        scaled = F.floor(F.col(self.part) * self.scale / F.greatest(F.col(self.whole), F.lit(1)))
        return scaled.cast("bigint")


METRICS = (
    Metric("word_length", "word_chars", "n_words", 100, 100, both=True),
    Metric("symbols", "n_symbols", "n_words", 1000, 100),
    Metric("dup_lines", "n_dup_lines", "n_lines", 1000, 400),
    Metric("repeat_words", "n_repeat_words", "n_words", 1000, 300),
)


# -- counts of a text ---------------------------------------------------------------


def with_counts(rows: DataFrame, text: str = "text", hashed: str = HASHED) -> DataFrame:
    """Rows with the columns COUNTS of column ``text``; null counts as empty.

    Repeated windows of three words are found by sorting one number per window, hash
    above and place below, and comparing the words of neighbours. Should windows of
    different words share their hash part, the text is sorted by the windows themselves.
    """
    columns = rows.columns
    rows = rows.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))
    words = F.split(F.btrim(text, F.lit(_TRIM)), SPACES)
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_TRIM)) != "")
    rows = rows.withColumns({
        "_w": F.when(F.btrim(text, F.lit(_TRIM)) == "", F.array().cast("array<string>")).otherwise(words),
        "_l": lines,
        "word_chars": F.char_length(text) - F.regexp_count(text, F.lit(_SPACE)),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
    })
    rows = rows.withColumns({
        "n_words": F.size("_w"),
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        # Bits that hold a place in the text.
        "_b": F.length(F.bin(F.size("_w"))),
    }).drop("_l")
    place = "CAST(i AS BIGINT)"
    window = hashed.format("_w[i]", "_w[i + 1]", "_w[i + 2]")
    packed = f"shiftleft(shiftright({window}, _b), _b) | {place}"
    rows = rows.withColumn(
        "_s",
        F.expr(
            f"CASE WHEN n_words < 3 THEN CAST(array() AS ARRAY<BIGINT>) ELSE"
            f" sort_array(transform(sequence(0, n_words - 3), i -> {packed})) END"
        ),
    )
    # Against the neighbour before: 0 another hash, 1 the same words, 2 other words.
    x, y = (f"CAST({v} & (shiftleft(1L, _b) - 1) AS INT)" for v in ("x", "_s[i - 1]"))
    equal = " AND ".join(f"_w[{x} + {k}] = _w[{y} + {k}]" for k in range(3))
    rows = rows.withColumn(
        "_m",
        F.expr(
            "transform(_s, (x, i) -> CASE WHEN i = 0 THEN 0 WHEN shiftright(x, _b) !="
            f" shiftright(_s[i - 1], _b) THEN 0 WHEN {equal} THEN 1 ELSE 2 END)"
        ),
    )
    by_hash = (
        "transform(filter(_s, (x, i) -> _m[i] = 1 OR (i + 1 < size(_m) AND _m[i + 1] = 1)),"
        " x -> CAST(x & (shiftleft(1L, _b) - 1) AS INT))"
    )
    strings = (
        "sort_array(transform(sequence(0, n_words - 3),"
        " i -> struct(concat_ws(' ', _w[i], _w[i + 1], _w[i + 2]) AS t, i AS i)))"
    )
    by_words = (
        f"transform(filter(transform(array({strings}), a -> transform(a, (x, i) -> struct(x.i AS i,"
        " (i > 0 AND a[i - 1].t = x.t) OR (i + 1 < size(a) AND a[i + 1].t = x.t) AS hit)))[0],"
        " x -> x.hit), x -> x.i)"
    )
    rows = rows.withColumn(
        "_p",
        F.expr(
            f"sort_array(CASE WHEN array_contains(_m, 2) THEN {by_words}"
            f" WHEN array_contains(_m, 1) THEN {by_hash} ELSE CAST(array() AS ARRAY<INT>) END)"
        ),
    )
    covered = (
        "aggregate(transform(_p, (x, i) -> CASE WHEN i + 1 < size(_p) THEN least(3, _p[i + 1] - x)"
        " ELSE 3 END), 0, (sum, x) -> sum + x)"
    )
    rows = rows.withColumn("n_repeat_words", F.expr(covered))
    # A filter on counts does not pass a generator: below it they would be computed anew
    # for each mention.
    counts = F.array(F.struct(*(F.col(name).cast("bigint").alias(name) for name in COUNTS)))
    rows = rows.select(*columns, F.explode(counts).alias("_c"))
    return rows.select(*columns, "_c.*")


def base_failed() -> Column:
    repeated = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    return (F.col("n_words") < MIN_WORDS) | repeated


# -- sketches and thresholds --------------------------------------------------------


def _bucket(value: Column) -> Column:
    """Lower end of a value's bucket: exact below 64, then 32 buckets for each doubling."""
    bits = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(counted: DataFrame) -> DataFrame:
    """``lang, source, metric, bucket, n``: a quantile sketch per language, source, metric.

    A sketch counts values by buckets of bounded relative width. Sketches merge by adding
    counts, in any order and with the same result, so tasks sketch what they read.
    """
    values = F.array(
        *(F.struct(F.lit(m.name).alias("metric"), _bucket(m.value()).alias("bucket")) for m in METRICS)
    )
    passed = counted.where(~base_failed()).select("lang", "source", F.explode(values).alias("v"))
    return passed.groupBy("lang", "source", "v.metric", "v.bucket").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """``size`` and the quartiles ``q25, q50, q75`` of the merged sketches of each group."""
    merged = sketch.groupBy(*group, "metric", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "metric")
    upto = F.sum("n").over(whole.orderBy("bucket")).alias("upto")
    ranked = merged.select(*group, "metric", "bucket", upto, F.sum("n").over(whole).alias("size"))
    picked = [
        F.min(F.when(F.col("upto") * 4 >= F.col("size") * k, F.col("bucket"))).alias(f"q{25 * k}")
        for k in (1, 2, 3)
    ]
    return ranked.groupBy(*group, "metric").agg(F.max("size").alias("size"), *picked)


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """``lang, source`` and for each metric ``<metric>_low, <metric>_high``.

    A value may be SPREADS times the distance between the median and the quartile on the
    other side away from the median, and ``slack`` besides: junk up to half of a source
    does not widen its limits. Pairs of fewer than ``min_group`` documents use the merged
    sketch of the language, languages of fewer that of all documents.
    """
    sketch = stored(sketch, "quality-sketch")
    own, lang, every = (_quartiles(sketch, *g) for g in (("lang", "source"), ("lang",), ()))
    names = ("size", "q25", "q50", "q75")
    lang = lang.select(
        F.col("lang").alias("_lang"), F.col("metric").alias("_metric"), F.struct(*names).alias("by_lang")
    )
    every = every.select("metric", F.struct(*names).alias("by_all"))
    own = own.select("lang", "source", "metric", F.struct(*names).alias("own"))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("metric") == F.col("_metric"))
    # One row per metric is broadcast: a fixed size.
    rows = own.join(lang, same).join(F.broadcast(every), "metric")
    used = F.when(F.col("own.size") >= min_group, F.col("own"))
    used = used.when(F.col("by_lang.size") >= min_group, F.col("by_lang")).otherwise(F.col("by_all"))
    rows = rows.select("lang", "source", "metric", used.alias("u"))
    q25, q50, q75 = (F.col(f"u.q{k}") for k in (25, 50, 75))
    limits = []
    for m in METRICS:
        chosen = F.col("metric") == m.name
        high = q50 + SPREADS * (q50 - q25) + m.slack
        low = q50 - SPREADS * (q75 - q50) - m.slack if m.both else F.lit(0)
        limits += [
            F.max(F.when(chosen, low)).alias(f"{m.name}_low"),
            F.max(F.when(chosen, high)).alias(f"{m.name}_high"),
        ]
    return stored(rows.groupBy("lang", "source").agg(*limits), "quality-limits")


def with_verdict(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``base_failed, kept``. The limits are stored, so a small table is broadcast."""
    named = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = counted["lang"].eqNullSafe(named["_lang"]) & counted["source"].eqNullSafe(named["_source"])
    inside = F.lit(True)
    for m in METRICS:
        value = m.value()
        inside &= (value >= F.col(f"{m.name}_low")) & (value <= F.col(f"{m.name}_high"))
    rows = counted.join(named, same, "left").withColumn("base_failed", base_failed())
    rows = rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
    return rows.drop(*named.columns)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, COUNTS, ``base_failed, kept`` for every row.

    Texts are read once; their counts go to the shared folder. A null text is empty and
    fails the base rule. Null languages and sources are groups of their own. Repeated
    rows are judged each. An empty table gives no rows.
    """
    rows = with_counts(docs.select("doc_id", "lang", "source", "text")).drop("text")
    counted = stored(rows, "quality-counts")
    return with_verdict(counted, thresholds(sketches(counted)))


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, that are kept.

    Counts are taken twice, once for the sketches and once to filter, so that texts are
    neither stored nor shuffled.
    """
    limits = thresholds(sketches(with_counts(docs.select("lang", "source", "text"))))
    rows = with_counts(docs.select("lang", "source", "text", F.struct("*").alias("row")))
    return with_verdict(rows, limits).where("kept").select("row.*")
