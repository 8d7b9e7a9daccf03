"""Cut orders: even pieces whatever the skew, results of plain loops, names that clash, tables without a key."""

import random
from bisect import bisect_left, bisect_right
from datetime import date, timedelta
from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.asof import asof_join
from tallyframe.operators.ledger import statement
from tallyframe.operators.ranges import in_ranges, sort_cuts
from tallyframe.operators.running import fill_down, fill_up, neighbour_values, running_rank, running_row_number, running_sum

N, PIECES = 6_000, 12


def make_rows():
    """Half of the rows have one key, a third one key and day; some keys and days are NULL."""
    rng = random.Random(11)
    rows = []
    for i in range(N):
        kind = i % 6
        key = "hot" if kind < 3 else rng.choice([None, *"abcdefgh"])
        day = 7 if kind < 2 else rng.choice([None, *range(30)])
        rows.append((key, day, i * 7919 % N, rng.choice([None, 1, 2, 3, 40])))
    return rows


ROWS = make_rows()


def low(value):
    return (value is not None, value if value is not None else 0)


def walk(keyed=True):
    """The rows by group, each group in the order of day and id."""
    groups = {}
    for row in sorted(ROWS, key=lambda r: (low(r[1]), r[2])):
        groups.setdefault(row[0] if keyed else "all", []).append(row)
    return groups.values()


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(ROWS, "k string, day int, id int, v int").repartition(5)
    for name in ("_piece", "_borders", "_place", "_carry", "_other", "_all", "_c0", "_side", "_hit", "_found"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.mark.parametrize("by", [["k"], []])
def test_pieces_are_even(table, by):
    cut = in_ranges(table, by, ["day", "id"], ranges=PIECES)
    rows = cut.rows.repartitionById(cut.count, F.col(cut.piece)).groupBy(F.spark_partition_id()).count().collect()
    sizes = [r["count"] for r in rows]
    assert len(sizes) == PIECES and sum(sizes) == N
    assert max(sizes) <= 2 * median(sizes)
    # What is handed on: at most two groups for each piece.
    assert cut.carry(F.count("*")).count() <= 2 * PIECES


def test_no_second_shuffle_of_rows(table, capsys):
    running_row_number(table, ["k"], ["day", "id"], "n", ranges=PIECES).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("shufflepartitionidpassthrough") == 1
    window = plan.split("Window [row_number()", 1)[1]
    assert "hashpartitioning" not in window.split("shufflepartitionidpassthrough", 1)[0]


def test_cuts_of_small_and_empty_tables(spark, table):
    assert sort_cuts(table, ["k", "day"]).pieces == 1  # too few rows for more
    empty = table.limit(0)
    assert sort_cuts(empty, ["k"], 5).pieces == 1
    assert running_sum(empty, ["k"], ["day"], "v", "s", ranges=5).count() == 0
    same = spark.range(500).select(F.lit(1).alias("k"), F.col("id"))
    assert {r.r for r in running_rank(same, [], ["k"], "r", ranges=4).collect()} == {1}


@pytest.mark.parametrize("ranges", [PIECES, None])
def test_running_sum_and_number(table, ranges):
    sums, numbers = {}, {}
    for group in walk():
        total = 0
        for n, row in enumerate(group, 1):
            total += row[3] or 0
            sums[row[2]], numbers[row[2]] = total, n
    out = running_sum(table, ["k"], ["day", "id"], "v", "s", ranges=ranges)
    assert out.columns == [*table.columns, "s"]
    assert {r.id: r.s for r in out.collect()} == sums
    out = running_row_number(table, ["k"], ["day", "id"], "n", ranges=ranges)
    rows = out.collect()
    assert {r.id: r.n for r in rows} == numbers and {r._piece for r in rows} == {"mine"}


def test_without_a_key(table):
    (group,) = walk(keyed=False)
    sums, total = {}, 0
    for row in group:
        total += row[3] or 0
        sums[row[2]] = total
    assert {r.id: r.s for r in running_sum(table, [], ["day", "id"], "v", "s", ranges=PIECES).collect()} == sums
    down, last = {}, None
    for row in group:
        last = row[3] if row[3] == 40 else last
        down[row[2]] = last
    marked = table.withColumn("mark", F.when(F.col("v") == 40, F.col("v")))
    assert {r.id: r.f for r in fill_down(marked, [], ["day", "id"], "mark", "f", ranges=PIECES).collect()} == down


@pytest.mark.parametrize("dense", [True, False])
def test_ranks_with_ties(table, dense):
    expected = {}
    for group in walk():
        places = [low(r[1]) for r in group]
        for row in group:
            mine = low(row[1])
            expected[row[2]] = 1 + (len({p for p in places if p < mine}) if dense else bisect_left(places, mine))
    out = running_rank(table, ["k"], ["day"], "r", dense, ranges=PIECES)
    assert {r.id: r.r for r in out.collect()} == expected


def test_neighbours_and_fill_up(table):
    near, up = {}, {}
    for group in walk():
        values = [None, *[r[3] for r in group], None]
        for i, row in enumerate(group):
            near[row[2]] = (values[i], values[i + 2])
        ahead = None
        for row in reversed(group):
            ahead = row[3] if row[3] is not None else ahead
            up[row[2]] = ahead
    out = neighbour_values(table, ["k"], ["day", "id"], "v", "b", "a", ranges=PIECES)
    assert {r.id: (r.b, r.a) for r in out.collect()} == near
    assert {r.id: r.f for r in fill_up(table, ["k"], ["day", "id"], "v", "f", ranges=PIECES).collect()} == up


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_without_a_key(spark, table, direction, strict):
    """A third of the rows on both sides share one time."""
    rng = random.Random(5)
    right = [(rng.choice([None, 7, 7, *range(0, 30, 4)]), i) for i in range(2_000)]
    marks = sorted((t, i) for t, i in right if t is not None)
    times = [t for t, _ in marks]
    expected = {}
    for _, day, i, _ in ROWS:
        if day is None:
            expected[i] = None
        elif direction == "forward":
            p = (bisect_right if strict else bisect_left)(times, day)
            expected[i] = marks[p][1] if p < len(marks) else None
        else:
            p = (bisect_left if strict else bisect_right)(times, day)
            expected[i] = marks[p - 1][1] if p else None
    rf = spark.createDataFrame(right, "day int, hit int").withColumn("_side", F.lit("theirs"))
    out = asof_join(table, rf, [], "day", ["hit"], direction, strict, ranges=PIECES)
    assert out.columns == [*table.columns, "hit"]
    assert {r.id: r.hit for r in out.collect()} == expected


def test_statement_with_one_hot_account_day(spark):
    """A third of all movements are on one day of one account; equal values share their balance."""
    rng = random.Random(2)
    first = date(2024, 1, 1)
    legs = []
    for i in range(4_000):
        hot = i % 3 == 0
        account, day = (1, first) if hot else (rng.randrange(20), first + timedelta(rng.randrange(9)))
        legs.append((account, day, Decimal(rng.randrange(-90_000, 90_000)) / 100))
    opening = [(a, first - timedelta(1), Decimal(a)) for a in range(20)]
    got = statement(
        spark.createDataFrame(legs, "account int, transaction_date date, value decimal(18,2)"),
        spark.createDataFrame(opening, "account int, transaction_date date, balance decimal(18,2)"),
        ranges=PIECES,
    ).collect()
    expected = []
    for a, day, balance in opening:
        expected.append((a, day, None, balance))
        mine = sorted((r for r in legs if r[0] == a), key=lambda r: (r[1], -r[2]))
        for i, row in enumerate(mine):
            balance += row[2]
            expected.append([a, row[1], row[2], balance])
            j = i
            while j and mine[j - 1][1:] == row[1:]:
                j -= 1
                expected[-1 - (i - j)][3] = balance
    key = lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, r[3])
    assert sorted((tuple(r) for r in got), key=key) == sorted((tuple(r) for r in expected), key=key)


def test_borders_are_read_by_all_tasks(spark):
    """Only the chosen keys meet in one task, not the table."""
    context = spark.sparkContext
    source = spark.range(0, 8_000, numPartitions=8).withColumn("day", F.col("id") % 30)
    context.setJobGroup("borders", "borders")
    try:
        assert sort_cuts(source, ["day", "id"], ranges=4, size=8_000).pieces == 4
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("borders")]
    assert max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds) == 8
