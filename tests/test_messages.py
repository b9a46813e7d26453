"""Field extraction, envelopes and the exact money sum."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from orderstream.operators import messages as msg
from orderstream.operators import reports


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def fields(spark, line):
    return tuple(msg.order_fields(lines(spark, [line])).first())


@pytest.mark.parametrize("line", ["{bad", "[]", "", "null", "5", '"text"', '[{"orderId":"1"}]'])
def test_not_an_object_gives_nulls(spark, line):
    assert fields(spark, line) == (None,) * 6


@pytest.mark.parametrize(
    ("member", "text"),
    [("123.40", "123.4"), ('"12"', "12"), ("1.0E7", "1.0E7"), ("null", None), ("true", "true"),
     ('{"a":1.50}', '{"a":1.5}'), ('""', "")],
)
def test_money_text(spark, member, text):
    assert fields(spark, f'{{"orderMoney":{member}}}')[4] == text


def test_parse_equals_path_lookup(spark):
    """All shapes of lines, repeated and hidden members included, read as by path."""
    rng = random.Random(4)
    names = [*msg.ETL_FIELDS, "ip", "other"]
    texts = ['"a"', '"x y"', "1", "1.50", "1e6", "null", "true", '""', '{"city":"n"}', "[1,2]",
             '"\\u0041"', '"q\\"city\\"q"', "\"it's\"", "tru", '"province"', "12,"]

    def member():
        name = rng.choice(names)
        quoted = rng.choice([f'"{name}"'] * 8 + [f"'{name}'", f'"\\u00{ord(name[0]):x}{name[1:]}"'])
        return quoted + rng.choice([":", ":", " : "]) + rng.choice(texts)

    made = ["{" + ",".join(member() for _ in range(rng.randrange(9))) + rng.choice(["}", "}", "} x", ""])
            for _ in range(3000)]
    made += ['{"city":"a","city":"b"}', '{"city":null,"city":"b"}', "{'city':'a','city':'b'}",
             '{"c\\u0069ty":"a","city":"b"}']
    frame = lines(spark, made)
    for names, numbers in ((msg.ETL_FIELDS, ()), (msg.ORDER_FIELDS, msg.ORDER_NUMBERS)):
        parsed = msg.json_fields(frame, names, ["value"], numbers)
        by_path = parsed.select(
            "value", *names, *(F.get_json_object("value", f"$.{n}").alias(f"p_{n}") for n in names)
        )
        wrong = [
            (row.value, n, row[n], row[f"p_{n}"])
            for row in by_path.collect() for n in names if row[n] != row[f"p_{n}"]
        ]
        assert wrong == []


def test_report_rows_without_a_number(spark):
    rows = msg.report_rows(lines(spark, [
        '{"orderMoney":"abc","province":"P","city":"C"}', '{"orderMoney":"12.5"}', ",", "{bad",
    ])).collect()
    assert [tuple(r) for r in rows] == [(None, "P", "C"), (12.5, None, None), (None, None, None)]


def test_envelope_leaves_out_nulls_and_round_trips(spark):
    schema = ", ".join(f"{name} STRING" for name in msg.ETL_FIELDS)
    given = [("1", "2", "t", None, 'Quo"te\\ 中', "5.5", "0"), ("1", "2", "t", "P", "C", None, "0")]
    made = msg.etl_envelope(spark.createDataFrame(given, schema))
    first = made.first().value
    assert first == '{"orderId":"1","userId":"2","orderTime":"t","city":"Quo\\"te\\\\ 中","orderMoney":"5.5","orderStatus":"0"}'
    assert [tuple(r) for r in msg.json_fields(made, msg.ETL_FIELDS).collect()] == given


def total(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "money DOUBLE")
    return reports.amt_total(rows).first().total_amt


def test_money_sum_is_exact_in_cents(spark):
    assert total(spark, [0.1] * 1000) == 100.0
    assert total(spark, [0.1, 0.2]) == 0.3
    assert total(spark, [1e13 + 0.01, -1e13]) == pytest.approx(0.01, abs=0.01)


def test_money_sum_keeps_what_is_not_cents(spark):
    assert total(spark, [0.1, 0.005]) == 0.105  # cents are cents and not the double next to them
    assert total(spark, [1e300, 1.0]) == 1e300
    assert total(spark, [float("inf"), 1.0]) == float("inf")
    assert total(spark, [float("nan"), 1.0]) != total(spark, [1.0])
    assert total(spark, [-5.25, 5.0]) == -0.25


def test_money_sum_skips_nulls(spark):
    assert total(spark, [None, 2.5]) == 2.5
    assert total(spark, [None]) is None
    assert total(spark, []) is None


def test_money_sum_does_not_depend_on_order(spark):
    rng = random.Random(1)
    values = [round(rng.uniform(5, 505), 2) for _ in range(5000)]
    sums = set()
    for parts in (1, 3, 7):
        rng.shuffle(values)
        rows = spark.createDataFrame([(v,) for v in values], "money DOUBLE").repartition(parts)
        sums.add(reports.amt_total(rows).first().total_amt)
    assert len(sums) == 1


def test_key_cities_from_a_short_and_a_long_list(spark):
    rows = spark.createDataFrame(
        [(1.0, "P", "A"), (2.0, "P", "B"), (3.0, "P", None), (4.0, "Q", "A")],
        "money DOUBLE, province STRING, city STRING",
    )
    long = ("A", *(f"other {i}" for i in range(reports.LONG_LIST)), "A")
    for cities in (("A",), long):
        chosen = reports.key_city_rows(rows, cities)
        assert chosen.columns == rows.columns
        assert sorted(tuple(r) for r in chosen.collect()) == [(1.0, "P", "A"), (4.0, "Q", "A")]
    plan = reports.key_city_rows(rows, long)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert reports.key_city_rows(rows, ()).count() == 0


@pytest.mark.parametrize(
    ("name", "lines"), [("order_fields", 1), ("order_etl", 1), ("amt_by_city", 1), ("report_rows", 2)]
)
def test_each_json_line_is_written_once(spark, sf_dir, name, lines):
    from orderstream.plans.catalog import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == lines
