"""Sums of doubles: exact, rounded once, the same in any order and at any number of partitions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from marlstone.functions import exact_sums
from marlstone.operators import mart_product_performance
from marlstone.operators.marts import distinct_ids
from marlstone.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def nearest(values):
    """The sum as a fraction, rounded once."""
    values = [v for v in values if v is not None]
    odd = [v for v in values if math.isnan(v) or math.isinf(v)]
    if odd or not values:
        return sum(odd) if odd else None
    total = sum(map(Fraction, values))
    return total.numerator / total.denominator


def groups():
    rng = random.Random(9)
    tiny, huge = 5e-324, 1.7976931348623157e308
    out = [[0.1, 0.2], [0.1] * 10, [1e308, 1.0, -1e308], [huge, -huge, tiny], [tiny, tiny, tiny], [-tiny], [tiny * 3, -1e-300],
           [1e16, 1.0, -1e16], [None], [None, 2.5, None], [], [0.0, -0.0], [float("inf"), 1.0], [float("inf"), float("-inf")],
           [float("nan"), 1.0], [2.0 ** 24], [2.0 ** 48, 2.0 ** -1074], [-(2.0 ** 24), 1.0], [2.0 ** 53, 1.0, 1.0],
           [2.0 ** 53, 1.0], [2.0 ** 53 + 2, 1.0], [-(2.0 ** 53), -1.0, -tiny], [1 / 3] * 999, [huge / 4] * 3, [2.0 ** -1022, -tiny]]
    out += [[float(2.0 ** (24 * k)) * s for s in (1, -1, 0.5, 3)] for k in range(-44, 43, 3)]
    for _ in range(60):
        spread = rng.choice([1, 8, 60, 600])
        out.append([math.ldexp(rng.uniform(-1, 1), rng.randint(-spread, spread)) for _ in range(rng.randint(1, 60))])
    for _ in range(30):  # amounts of money, and what is left after cancelling
        amounts = [round(rng.uniform(-5000, 5000), 2) for _ in range(200)]
        out.append(amounts + [-a for a in amounts[:199]])
    return out


def test_sums_are_exact_and_rounded_once(spark):
    sets = groups()
    rows = [(i, v, -v if v is not None else None) for i, g in enumerate(sets) for v in g]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double, w double")
    got = {r.k: r for r in exact_sums(df, ["k"], {"s": "v", "t": "w"}, {"n": F.col("v").isNotNull()}).collect()}
    assert set(got) == {i for i, g in enumerate(sets) if g}
    for i, g in enumerate(sets):
        if g:
            want = nearest(g)
            for have, value in ((got[i].s, want), (got[i].t, nearest([None if v is None else -v for v in g]))):
                assert have == value or (have != have and value != value), (i, g[:5], have, value)
            assert got[i].n == sum(v is not None for v in g)


def test_overflow_of_the_result_is_infinite(spark):
    df = spark.createDataFrame([(1, 1.7e308)] * 3 + [(2, -1.7e308)] * 3, "k int, v double")
    assert {r.k: r.s for r in exact_sums(df, ["k"], {"s": "v"}).collect()} == {1: math.inf, 2: -math.inf}


def test_nothing(spark):
    assert exact_sums(spark.createDataFrame([], "k int, v double"), ["k"], {"s": "v"}).collect() == []


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_mart_is_bit_equal_at_any_number_of_partitions(spark, ansi):
    before = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.shuffle.partitions")}
    fact = QUERIES["fact_order_items"](spark, SF_SMALL).cache()
    products = QUERIES["dim_products"](spark, SF_SMALL).cache()
    seen = []
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        for n in (1, 8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(min(n, 16)))
            dealt = fact.repartition(n, F.rand(n))
            rows = mart_product_performance(products, dealt).collect()
            seen.append(sorted(tuple(x.hex() if isinstance(x, float) else x for x in r) for r in rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 100


def test_repeated_dimension_rows_count_their_facts_again(spark):
    amounts = [0.1, 0.2, 0.3, 1e15, None]
    fact = spark.createDataFrame([(1, 7, a, a, a) for a in amounts],
                                 "order_item_id int, product_id int, revenue_usd double, refund_amount_usd double, net_profit_usd double")
    products = spark.createDataFrame([(7, "x")] * 5 + [(7, None), (8, "y")], "product_id int, product_name string")
    got = {(r.product_id, r.product_name): (r.total_units_sold, r.gross_revenue_usd) for r in
           mart_product_performance(products, fact).collect()}
    assert got == {(7, "x"): (25, nearest(amounts * 5)), (7, None): (5, nearest(amounts)), (8, "y"): (0, None)}


def test_distinct_ids_of_any_size(spark):
    """Negative, zero, bucket edges, the ends of the range and NULL."""
    ids = [None, 0, 1, -1, 32767, 32768, 32769, -32768, -32769, 65536, 65537, 2 ** 31, -(2 ** 31), 2 ** 63 - 1, -(2 ** 63) + 1]
    rows = [("a", i) for i in ids * 3] + [("b", None)] * 4 + [(None, i) for i in ids[3:9]] + [("c", i) for i in range(-70_000, 70_000, 7)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(9)
    got = {r.k: r.n for r in distinct_ids(df, ["k"], "v", "n").collect()}
    assert got == {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    assert got["b"] == 0 and got["a"] == len(ids) - 1
    assert distinct_ids(df.limit(0), ["k"], "v", "n").collect() == []
