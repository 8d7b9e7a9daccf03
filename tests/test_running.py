"""Running operators: cut into slices, the result is that of a plain loop, also with NULL keys and slices."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.asof import asof_join, next_in_list
from tallyframe.operators.running import fill_down, neighbour_values, running_row_number, running_sum

def make_rows(seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(90):
        key = "hot" if i < 40 else rng.choice(["a", "b", None])
        rows.append((key, rng.choice([None, 0, 1, 2, 3, 4]), i, rng.choice([None, 1, 2, 3])))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k string, day int, id int, v int").repartition(3)


def by_key(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2]))
    return [list(g) for _, g in groupby(order, key=lambda r: r[0])]


def test_running_sum(table, rows):
    expected = {}
    for group in by_key(rows):
        total = 0
        for row in group:
            total += row[3] or 0
            expected[row[2]] = total
    out = running_sum(table, ["k"], ["day", "id"], "v", "s")
    assert out.columns == ["k", "day", "id", "v", "s"]
    assert {r.id: r.s for r in out.collect()} == expected


def test_running_sum_shares_equal_rows(spark):
    table = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("a", 2, 1)], "k string, day int, v int")
    out = running_sum(table.withColumn("down", -F.col("v")), ["k"], ["day", "down"], "v", "s")
    assert sorted(r.s for r in out.collect()) == [10, 10, 11]


def test_running_row_number(table, rows):
    expected = {row[2]: n for group in by_key(rows) for n, row in enumerate(group, 1)}
    out = running_row_number(table, ["k"], ["day", "id"], "n")
    assert {r.id: r.n for r in out.collect()} == expected


def test_neighbour_values(table, rows):
    expected = {}
    for group in by_key(rows):
        values = [None, *[row[3] for row in group], None]
        expected |= {row[2]: (values[i], values[i + 2]) for i, row in enumerate(group)}
    out = neighbour_values(table, ["k"], ["day", "id"], "v", "b", "a")
    assert {r.id: (r.b, r.a) for r in out.collect()} == expected


def test_fill_down(table, rows):
    expected = {}
    for group in by_key(rows):
        last = None
        for row in group:
            last = row[3] if row[3] is not None else last
            expected[row[2]] = last
    out = fill_down(table, ["k"], ["day", "id"], "v", "f")
    assert {r.id: r.f for r in out.collect()} == expected


def brute_asof(left, right, forward, strict):
    out = {}
    for lid, key, time in left:
        later = [
            (t, rid)
            for rid, k, t in right
            if None not in (k, key, t, time) and k == key and ((t > time if strict else t >= time) if forward else (t < time if strict else t <= time))
        ]
        out[lid] = ((min(later) if forward else max(later))[1]) if later else None
    return out


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_join(spark, direction, strict):
    rng = random.Random(3)
    left = [(i, rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(60)])) for i in range(60)]
    right = [(i, rng.choice(["hot", "hot", "a", "c", None]), rng.choice([None, *range(60)])) for i in range(50)]
    lf = spark.createDataFrame(left, "id int, k string, t int")
    rf = spark.createDataFrame(right, "rid int, k string, t int")
    out = asof_join(lf, rf, ["k"], "t", ["rid"], direction, strict)
    assert {r.id: r.rid for r in out.collect()} == brute_asof(left, right, direction == "forward", strict)


def test_next_in_list(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-06')) AS d")
    marks = spark.sql("SELECT explode(array(DATE'2024-01-03', DATE'2024-01-05')) AS m")
    for strict, expected in ((True, [3, 3, 5, 5, None, None]), (False, [3, 3, 3, 5, 5, None])):
        out = next_in_list(days, "d", marks, "m", "n", strict).orderBy("d").collect()
        assert [r.n.day if r.n else None for r in out] == expected
