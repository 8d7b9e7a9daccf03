import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dates, geo, numbers, text
from tallyframe.operators import nearest, ranking, reshape, scaffold
from tallyframe.sources.tables import inline_rows, read_tagged, stack_tagged


def values(spark, expression, schema, rows):
    frame = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in frame.select(expression.alias("x")).collect()]


def test_blank_to_null(spark):
    got = values(spark, text.blank_to_null(F.col("s")), "s string", ["null", "", " ", "x", None])
    assert got == [None, None, None, "x", None]


def test_leading_number(spark):
    got = values(spark, text.leading_number(F.col("s")), "s string", ["20km", "13.4 km", "32 minutes", "15mins", "10", "none", None])
    assert got == [20.0, 13.4, 32.0, 15.0, 10.0, None, None]


def test_scaled_amount(spark):
    got = values(spark, text.scaled_amount(F.col("s")), "s string", ["$1.5B", "$300M", "$24.99", None])
    assert got == [1.5e9, 3e8, 24.99, None]


def test_list_ids(spark):
    got = values(spark, text.list_ids(F.col("s")), "s string", ["1, 2,5", " 7 ", None])
    assert got == [[1, 2, 5], [7], None]


def test_band_keeps_null_apart(spark):
    got = values(spark, numbers.band(F.col("v"), ((10.0, "low"), (20.0, "mid")), "high"), "v double", [9.99, 10.0, 20.0, None])
    assert got == ["low", "mid", "high", None]


def test_bin_label_edges(spark):
    got = values(spark, numbers.bin_label(F.col("d"), 30, 12), "d int", [0, 1, 30, 31, 360, 361, None])
    assert got == ["under 1 days", "1 - 30 days", "1 - 30 days", "31 - 60 days", "331 - 360 days", "over 360 days", None]


def test_percentages(spark):
    frame = spark.createDataFrame([(6, 7), (1, 0)], "a int, b int")
    out = frame.select(numbers.percent_text(F.col("a"), F.col("b")), numbers.percent(F.col("a"), F.col("b"), 1)).collect()
    assert out[0][0] == "85.71%" and out[0][1] == 85.7
    assert out[1][1] is None


def test_round_half_up(spark):
    assert values(spark, numbers.round_half_up(F.col("v"), 2), "v double", [2.675, -2.675, 0.125]) == [2.68, -2.68, 0.13]


def test_minute_steps_counts_marks(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1)), (datetime(2024, 1, 1, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 59))]
    got = values(spark, dates.minute_steps(F.col("a"), F.col("b")), "a timestamp_ntz, b timestamp_ntz", rows)
    assert got == [1, 0]


def test_week_start_on_friday(spark):
    days = [date(2021, 1, d) for d in (1, 5, 7, 8, 14, 15)]
    got = values(spark, dates.week_start(F.col("d"), 4), "d date", days)
    assert [d.day for d in got] == [1, 1, 1, 8, 8, 15]


def test_weekday_from_sunday(spark):
    assert values(spark, dates.weekday_from_sunday(F.col("d")), "d date", [date(2024, 1, 7), date(2024, 1, 6)]) == [0, 6]


def test_distance_to_itself_is_zero(spark):
    got = values(spark, geo.great_circle_miles(F.col("a"), F.col("b"), F.col("a"), F.col("b")), "a double, b double", [(51.5, -0.12), (90.0, 10.0)])
    assert all(abs(x) < 0.001 for x in got)


def test_top_rows_with_ties(spark):
    frame = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("a", 2, 3), ("a", 1, 4), ("b", 1, 5)], "k string, v int, id int")
    order = [F.col("v").desc()]
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(ranking.top_rows(frame, ["k"], order, 2, "rank")) == [1, 2, 5]
    assert ids(ranking.top_rows(frame, ["k"], order, 2, "dense_rank")) == [1, 2, 3, 5]
    assert ids(ranking.top_rows(frame, ["k"], [*order, F.col("id")], 1)) == [1, 5]
    assert "WindowGroupLimit" in ranking.top_rows(frame, ["k"], order, 2, "rank")._jdf.queryExecution().executedPlan().toString()


def test_unpivot_and_pivot_are_inverse_on_values(spark):
    wide = spark.createDataFrame([(1, 10, None), (2, 30, 40)], "id int, x int, y int")
    long = reshape.unpivot_non_null(wide, ["id"], ["x", "y"], "name", "value")
    assert long.count() == 3
    back = reshape.pivot_named(long, ["id"], "name", "value", {"x": "x", "y": "y"})
    assert sorted(map(tuple, back.collect())) == [(1, 10, None), (2, 30, 40)]


def test_explode_items_drops_missing_lists(spark):
    frame = spark.createDataFrame([(1, "4, 5"), (2, None)], "id int, s string")
    assert sorted((r.id, r.x) for r in reshape.explode_items(frame, text.list_ids(F.col("s")), "x").collect()) == [(1, 4), (1, 5)]


def test_grid_and_carry_forward(spark):
    grid = scaffold.date_grid(spark.createDataFrame([(1,)], "k int"), date(2024, 1, 31), date(2024, 4, 30), "d", "1 month")
    assert [r.d for r in grid.orderBy("d").collect()] == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30)]
    frame = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None), (1, 4, None)], "k int, t int, v int")
    out = scaffold.carry_forward(frame, ["k"], "t", "v", "f").orderBy("t").collect()
    assert [r.f for r in out] == [None, 5, 5, 5]


def test_stack_tagged_matches_by_position(spark):
    jan = spark.createDataFrame([(1, "x")], "id int, Demographic string")
    feb = spark.createDataFrame([(2, "y")], "id int, Demagraphic string")
    out = stack_tagged({"Jan": jan, "Feb": feb}, "period")
    assert out.columns == ["id", "Demographic", "period"]
    assert sorted(map(tuple, out.collect())) == [(1, "x", "Jan"), (2, "y", "Feb")]


def test_read_tagged(spark, tmp_path):
    for name in ("Jan", "Feb"):
        spark.createDataFrame([(name,)], "v string").write.parquet(str(tmp_path / f"sheet_{name}.parquet"))
    out = read_tagged(spark, [str(tmp_path / f"sheet_{n}.parquet") for n in ("Jan", "Feb")], "period", r"sheet_(\w+)\.parquet")
    assert sorted(map(tuple, out.collect())) == [("Feb", "Feb"), ("Jan", "Jan")]


def test_inline_rows(spark):
    out = inline_rows(spark, [(1, 2), (2, None)], "order_id int, rating int")
    assert out.dtypes == [("order_id", "int"), ("rating", "int")] and out.count() == 2


def miles(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    c = math.sin(la) * math.sin(lb) + math.cos(la) * math.cos(lb) * math.cos(math.radians(b[1] - a[1]))
    return 3963 * math.acos(max(-1.0, min(1.0, c)))


@pytest.mark.parametrize("world", ["globe", "clusters", "one site", "edges", "0..360"])
def test_nearest_site_equals_brute_force(spark, world):
    rng = random.Random(11)
    anywhere = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    if world == "globe":
        points, sites = [anywhere() for _ in range(80)], [anywhere() for _ in range(40)]
    elif world == "clusters":
        points = [(52 + rng.gauss(0, 0.2), 4.9 + rng.gauss(0, 0.2)) for _ in range(60)] + [anywhere() for _ in range(20)]
        sites = [(52 + rng.gauss(0, 0.05), 4.9 + rng.gauss(0, 0.05)) for _ in range(60)]
    elif world == "0..360":
        points = [(10.0, 300.0), (10.0, -60.0), (-20.0, 359.0), (5.0, 181.0)]
        sites = [(95.0, 10.0), (10.0, 300.0), (10.0, 150.0), (-20.0, 2.0), (5.0, 179.0)]
    elif world == "one site":
        points, sites = [anywhere() for _ in range(30)], [(-33.9, 151.2)]
    else:
        points = [(90.0, 180.0), (-90.0, -180.0), (0.0, 180.0), (0.0, -180.0), (45.0, 179.99), (45.0, -179.99), (89.9, 0.0)]
        sites = [(0.0, 179.9), (0.0, -179.8), (90.0, 0.0), (-89.0, 5.0), (45.0, 179.0), (44.0, -179.5), (45.0, 179.0)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(999, None, 1.0)], "p int, lat double, long double")
    places = spark.createDataFrame([(i, *s) for i, s in enumerate(sites)], "site int, slat double, slong double")
    out = nearest.nearest_site(frame, places, "lat", "long", "site", "slat", "slong").collect()
    assert len(out) == len(points) + 1
    for row in out:
        if row.p == 999:
            assert row.site is None and row.distance is None
            continue
        best = min((round(miles(points[row.p], s), 3), i) for i, s in enumerate(sites) if abs(s[0]) <= 90)
        assert abs(row.distance - best[0]) < 0.0011
        assert row.site == best[1] or abs(miles(points[row.p], sites[row.site]) - best[0]) < 0.0011


def test_nearest_site_in_one_dense_place(spark):
    """Many points and sites within two miles: each point meets few of the sites."""
    rng = random.Random(5)
    near = lambda n: [(52 + rng.uniform(0, 0.03), 4.9 + rng.uniform(0, 0.03)) for _ in range(n)]
    points, sites = near(300), near(400)
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "p int, lat double, long double")
    places = spark.createDataFrame([(i, *s) for i, s in enumerate(sites)], "site int, slat double, slong double")
    for row in nearest.nearest_site(frame, places, "lat", "long", "site", "slat", "slong").collect():
        assert abs(row.distance - min(miles(points[row.p], s) for s in sites)) < 0.0011


def test_nearest_site_splits_crowded_cells(spark, monkeypatch):
    """Thousands of points and sites within 250 feet: a point meets a few sites, and rightly the nearest."""
    rng = random.Random(8)
    near = lambda n: [(52 + rng.uniform(0, 0.0007), 4.9 + rng.uniform(0, 0.0011)) for _ in range(n)]
    points, sites = near(5000), near(1000)
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "p int, lat double, long double")
    places = spark.createDataFrame([(i, *s) for i, s in enumerate(sites)], "site int, slat double, slong double")
    met, pairs = nearest._meeting, []
    monkeypatch.setattr(nearest, "_meeting", lambda *a: pairs.append(met(*a)) or pairs[-1])
    out = {r.p: r for r in nearest.nearest_site(frame, places, "lat", "long", "site", "slat", "slong").collect()}
    assert len(out) == 5000
    for p in range(0, 5000, 100):
        best = min((round(miles(points[p], s), 3), i) for i, s in enumerate(sites))
        assert abs(out[p].distance - best[0]) < 0.0011
        assert out[p].site == best[1] or abs(miles(points[p], sites[out[p].site]) - best[0]) < 0.0016
    print("pairs per point", pairs[0].count() / 5000)
    assert pairs[0].count() < 50 * 5000


def test_nearest_site_stops_where_cells_are_sparse(spark):
    """No finer level than the sites need."""
    spots = spark.createDataFrame([(float(i), float(i)) for i in range(-80, 80, 5)], "lat double, long double")
    spots = spots.select("lat", "long", *nearest._leaf("lat", "long"))
    assert nearest._levels_for(spots) == nearest.LEVELS[:2]
    assert nearest._levels_for(spots.limit(0)) == nearest.LEVELS[:1]


def test_before_a_mark(spark):
    assert values(spark, text.before(F.col("s"), "-"), "s string", ["DTB-1-2", "-x", "none", "", None]) == ["DTB", "", "none", "", None]
