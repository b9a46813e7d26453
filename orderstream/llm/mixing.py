"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderstream.llm.common import WORD, ranked, stored

# Weights of the sources in order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)

# Digits of the sampling hash that are decided per pass, and passes: all of its 60 bits.
DIGIT_BITS = 15
PASSES = 4


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sources: DataFrame,
    share: float = 1.5,
    max_epochs: float = 2.0,
    weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Sources in code point order, null last, get the weights in turn and share ``share``
    times all sizes by them. A source is clamped at ``max_epochs`` times its size; what
    it leaves over is shared again among the others by weight until none is above. Each
    round is one small aggregate that brings two numbers to the driver: the water level
    rises, so a clamped source stays clamped. If all are clamped, all get their cap.
    """
    placed = ranked(sources, [F.col("source").isNull(), F.col("source")], "place")
    turn = F.pmod("place", F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    cap = F.col("source_size") * F.lit(max_epochs)
    rows = stored(placed.select("source", "source_size", weight.alias("w"), cap.alias("cap")), "mix-sources")

    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level = -1.0
    while True:
        full = F.col("cap") <= F.col("w") * F.lit(level)
        open_weight, closed = rows.agg(
            F.sum(F.when(~full, F.col("w"))), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0))
        ).first()
        if not open_weight:
            break
        higher = (total - closed) / open_weight
        if higher <= level:
            break
        level = higher
    target = F.least("cap", F.col("w") * F.lit(level))
    return rows.select("source", "source_size", target.alias("target"))


def _plan(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source: whole repetitions, and which further documents are taken once more.

    ``rows`` has ``source, size, h`` per document, ``h`` a seeded hash. The fractional
    repetition is gathered in ``rounds``: documents no larger than what is needed
    (``most``), by hash from ``start`` up to ``cut``, where the next no longer fits. Then
    the largest single document that fits, ``extra``, and the next round goes on behind
    the cut. Documents passed over stay too large, as the need only falls; a round and
    its extra at least halve it unless rows of one hash stop the round. When nothing
    fits any more, a last document may exceed the target if that comes nearer to it.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    whole = F.coalesce(whole, F.lit(0)).cast("int")
    need = F.col("target") - whole * F.col("source_size")
    plan = wanted.select("source", "source_size", "target", whole.alias("whole"), need.alias("need"))
    zero = F.lit(0).cast("bigint")
    plan = plan.withColumns(
        {
            "cut": zero, "took": zero, "extra": F.array().cast("array<bigint>"),
            "rounds": F.array().cast("array<struct<start: bigint, cut: bigint, most: double>>"),
        }
    )
    plan = stored(plan, "mix-plan")
    while True:
        plan = _round(rows, plan)
        found = stored(_single(rows, plan, F.col("need") - F.col("took")), "mix-single")
        if found.isEmpty():
            break
        plan = stored(_added(plan, found), "mix-plan")
    over = _single(rows, plan, 2 * (F.col("need") - F.col("took")))
    return stored(_added(plan, over), "mix-plan")


def _round(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with one more round for every source.

    The cut is found digit by digit: each pass sums sizes by source and digit,
    pre-aggregated, and keeps the digit in which the needed sum is reached.
    """
    # The document at the last cut did not fit.
    start = F.when(F.size("rounds") > 0, F.col("cut") + 1).otherwise(F.col("cut"))
    plan = plan.withColumns({"start": start, "most": (F.col("need") - F.col("took")).cast("double")})
    plan = plan.withColumn("cut", F.col("start"))
    columns = plan.columns
    fresh = (F.col("h") >= F.col("start")) & (F.col("size") <= F.col("most"))
    fresh = fresh & ~F.array_contains("extra", F.col("h"))
    for step in range(1, PASSES + 1):
        shift = 60 - DIGIT_BITS * step  # hashes have 60 bits
        above = shift + DIGIT_BITS
        same = F.lit(True) if step == 1 else F.shiftright("h", above) == F.shiftright("cut", above)
        open_rows = _with(rows, plan).where(fresh & same)
        digit = F.shiftright("h", shift)
        sums = open_rows.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("source").orderBy("digit"))
        sums = sums.withColumn("upto", upto)
        sums = sums.join(plan.select(F.col("source").alias("s"), "need", "took"), F.col("source").eqNullSafe(F.col("s")))
        fits = F.col("took") + F.col("upto") <= F.col("need")
        ends = sums.groupBy(F.col("source").alias("s")).agg(
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("more"),
            F.min(F.when(~fits, F.col("digit"))).alias("stop"),
            F.max("digit").alias("last"),
        )
        # Every digit below the first that no longer fits is taken.
        cut = F.shiftleft(F.coalesce("stop", F.col("last") + 1), shift)
        plan = plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").withColumns(
            {
                "cut": F.coalesce(cut, F.col("cut")),
                "took": F.col("took") + F.coalesce("more", F.lit(0)),
            }
        )
        plan = stored(plan.select(*columns), "mix-plan")
    this = F.struct("start", "cut", "most")
    return stored(plan.withColumn("rounds", F.array_append("rounds", this)).drop("start", "most"), "mix-plan")


def _single(rows: DataFrame, plan: DataFrame, below: Column) -> DataFrame:
    """``s, best``: the untaken document of each source that comes nearest to its need.

    Only documents of at most ``below`` words, and less than twice what is needed.
    """
    gap = F.col("need") - F.col("took")
    near = (F.col("size") > 0) & (F.col("size") < 2 * gap) & (F.col("size") <= below)
    left = _with(rows, plan).where(~_taken() & near)
    # Rows equal in doc_id and text share a hash and are taken together.
    left = left.groupBy("source", "h", "need", "took").agg(F.sum("size").alias("size"))
    return left.where(near).groupBy(F.col("source").alias("s")).agg(
        F.min_by(F.struct("h", "size"), F.struct(F.abs(gap - F.col("size")), "h")).alias("best")
    )


def _added(plan: DataFrame, found: DataFrame) -> DataFrame:
    columns = plan.columns
    plan = plan.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
    more = F.when(F.col("best").isNull(), F.col("extra")).otherwise(F.array_append("extra", F.col("best.h")))
    plan = plan.withColumns({"took": F.col("took") + F.coalesce("best.size", F.lit(0)), "extra": more})
    return plan.select(*columns)


def _with(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the plan of their source; the plan is stored, so a small one is broadcast."""
    named = plan.withColumnRenamed("source", "_source")
    return rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")


def sampling_hash(seed: int) -> Column:
    """60 bits that depend on the document and the seed alone, so a rerun samples the same."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 4)


def _taken() -> Column:
    """Whether a document is in the fractional repetition."""
    in_round = F.exists(
        "rounds", lambda r: (F.col("h") >= r["start"]) & (F.col("h") < r["cut"]) & (F.col("size") <= r["most"])
    )
    return in_round | F.array_contains("extra", F.col("h"))


def _repeats() -> Column:
    return F.col("whole") + _taken().cast("int")


def mixed(
    docs: DataFrame, seed: int = 42, share: float = 1.5, max_epochs: float = 2.0
) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, source, size, h`` of the documents, and the plan of each source."""
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("size"), sampling_hash(seed).alias("h"))
    rows = stored(rows, "mix-rows")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return rows, _plan(rows, targets(sources, share, max_epochs))


def mix(
    docs: DataFrame, seed: int = 42, share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """``doc_id, source, size, source_size, target, repeats, taken`` for every row.

    ``size`` is the number of words (null text: 0), ``repeats`` how often the whole
    document is taken, ``taken`` the words that makes. A source of no words gets target
    0. Null sources are one source. Rows equal in doc_id and text are taken alike. An
    empty table gives no rows.
    """
    rows, plan = mixed(docs, seed, share, max_epochs)
    return _with(rows, plan).select(
        "doc_id", "source", "size", "source_size", "target",
        _repeats().alias("repeats"), (_repeats() * F.col("size")).alias("taken"),
    )


def repeat_documents(
    docs: DataFrame, seed: int = 42, share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, each as often as it is taken.

    The plan is joined by source; texts are not shuffled unless the plan is too large
    to broadcast.
    """
    _, plan = mixed(docs, seed, share, max_epochs)
    size = words(F.col("text")).alias("size")
    rows = docs.select("source", size, sampling_hash(seed).alias("h"), F.struct("*").alias("row"))
    times = _with(rows, plan).select("row", _repeats().alias("times"))
    copies = F.array_repeat(F.lit(0), F.col("times"))
    return times.select("row", F.explode(copies).alias("copy")).select("row.*")
