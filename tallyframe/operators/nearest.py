"""Nearest site by great-circle distance, without pairing all points with all sites.

Points and sites are both summarised in square degree cells on several levels,
each cell holding up to eight by eight cells of the next level. How far down
the levels go is counted: to the first one on which no cell holds more than
``CROWD`` different site positions, at the latest to cells of four feet. From
the coarsest level down, each cell with points keeps only the cells with sites
that may hold the nearest site of any of its points: a real site in one of them
gives an upper bound, the gap between two cells a lower bound. All this works
on cells; only at the end do the points meet the sites in the few cells left
for their own cell, which are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.geo import EARTH_MILES, great_circle_miles

# The finest cell edge in degrees and how far each level is above it (as powers of two).
LEAF_DEGREES = 180.0 / 2**24
LEVELS = (21, 18, 15, 12, 9, 6, 4, 2, 0)
# Fixed value: a cell with more site positions than this is split, if a finer level is left.
CROWD = 4
# Fixed value: a level with no more cells than this on the whole earth is small enough to broadcast.
_BROADCAST_CELLS = 1_000_000
# Distances are compared to a thousandth of a mile: the cosine formula itself is
# only good to about 0.0001 miles, and equal distances must be ties.
RESOLUTION_DIGITS = 3
# Bounds give way by the step in which distances are compared and by that error.
_SLACK_MILES = 0.002


def _latitude(name: str) -> Column:
    return F.when(F.col(name).between(-90, 90), F.col(name).cast("double"))


def _longitude(name: str) -> Column:
    """From -180 up to 180; what already lies there stays exactly as it is."""
    degrees = F.col(name).cast("double")
    return F.when(degrees.between(-180, 180), degrees).otherwise(F.pmod(degrees + 180.0, F.lit(360.0)) - 180.0)


def _leaf(lat: str, long: str) -> list[Column]:
    return [F.floor((F.col(lat) + 90.0) / LEAF_DEGREES).alias("y"), F.floor((F.col(long) + 180.0) / LEAF_DEGREES).alias("x")]


def _up(y: str, x: str, steps: int, prefix: str) -> list[Column]:
    return [F.shiftright(y, steps).alias(f"{prefix}y"), F.shiftright(x, steps).alias(f"{prefix}x")]


def _point_cells(cells: DataFrame, steps: int, size: float) -> DataFrame:
    """Cells with points and what the bounds need of them, worked out once per cell."""
    south, north = F.radians(F.col("py") * size - 90.0), F.radians((F.col("py") + 1) * size - 90.0)
    middle = F.radians((F.col("py") + 0.5) * size - 90.0)
    # From the middle of a cell to any of its points: along the meridian, then the parallel.
    half_way = F.lit(EARTH_MILES) * F.radians(F.lit(size / 2)) * (1 + F.greatest(F.cos(south), F.cos(north)))
    return cells.select(*_up("y", "x", steps, "p")).distinct().select(
        "py",
        "px",
        F.sin(middle).alias("p_sin"),
        F.cos(middle).alias("p_cos"),
        F.radians((F.col("px") + 0.5) * size - 180.0).alias("p_turn"),
        half_way.alias("half_way"),
        F.least(F.cos(south), F.cos(north)).alias("narrowest"),
    )


def _site_cells(cells: DataFrame, steps: int) -> DataFrame:
    """Cells with sites and the position of one site in each."""
    lat = F.radians("site_at.lat")
    return cells.groupBy(*_up("y", "x", steps, "s")).agg(F.min("site_at").alias("site_at")).select(
        "sy", "sx", F.sin(lat).alias("s_sin"), F.cos(lat).alias("s_cos"), F.radians("site_at.long").alias("s_turn")
    )


def _cell_gap(size: float) -> Column:
    """Lower bound of the miles between cell (py, px) and cell (sy, sx)."""
    rows = F.greatest(F.lit(0), F.abs(F.col("py") - F.col("sy")) - 1)
    around = int(360 / size)
    turn = F.abs(F.col("px") - F.col("sx"))
    columns = F.greatest(F.lit(0), F.least(turn, F.lit(around) - turn) - 1)
    across = F.asin(F.col("narrowest") * F.sin(F.radians(F.least(columns * size, F.lit(90.0)))))
    return F.lit(EARTH_MILES) * F.greatest(F.radians(rows * size), across)


def _cell_reach() -> Column:
    """Upper bound of the miles from any point of cell (py, px) to the known site of cell (sy, sx)."""
    cosine = F.expr("p_sin * s_sin + p_cos * s_cos * cos(s_turn - p_turn)")
    return F.lit(EARTH_MILES) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) + F.col("half_way")


def _levels_for(spots: DataFrame) -> tuple[int, ...]:
    """The levels down to the first without a crowded cell; one number per level comes back from the sites."""
    cells = F.array(*(F.struct(F.lit(steps).alias("steps"), *_up("y", "x", steps, "s")) for steps in LEVELS))
    held = spots.select(F.inline(cells)).groupBy("steps", "sy", "sx").agg(F.count("*").alias("n"))
    most = {r["steps"]: r["most"] for r in held.groupBy("steps").agg(F.max("n").alias("most")).collect()}
    enough = next((i for i, steps in enumerate(LEVELS) if most.get(steps, 0) <= CROWD), len(LEVELS) - 1)
    return LEVELS[: enough + 1]


def _candidate_cells(place_cells: DataFrame, site_cells: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """For every cell with points (py, px) of the last level the cells (sy, sx) that may hold a nearest site."""
    pairs = None
    for level, steps in enumerate(levels):
        size = LEAF_DEGREES * 2**steps
        rows, columns = int(180 / size) + 1, int(360 / size) + 1  # cells on the whole earth, edges included
        with_points, with_sites = _point_cells(place_cells, steps, size), _site_cells(site_cells, steps)
        if pairs is None:
            # The coarsest level has 9 x 17 cells, so this is a small fixed number of pairs.
            pairs = with_points.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(rows * columns - 1))))
            pairs = pairs.selectExpr("*", f"CAST(i DIV {columns} AS BIGINT) AS sy", f"CAST(i % {columns} AS BIGINT) AS sx")
            pairs = pairs.join(F.broadcast(with_sites), ["sy", "sx"])
        else:
            wider = levels[level - 1] - steps
            with_points = with_points.select("*", *_up("py", "px", wider, "pp"))
            with_sites = with_sites.select("*", *_up("sy", "sx", wider, "ps"))
            if rows * columns <= _BROADCAST_CELLS:
                with_points, with_sites = F.broadcast(with_points), F.broadcast(with_sites)
            above = pairs.selectExpr("py AS ppy", "px AS ppx", "sy AS psy", "sx AS psx")
            pairs = above.join(with_points, ["ppy", "ppx"]).join(with_sites, ["psy", "psx"])
        pairs = (
            pairs.select("py", "px", "sy", "sx", _cell_gap(size).alias("gap"), _cell_reach().alias("reach"))
            .withColumn("bound", F.min("reach").over(Window.partitionBy("py", "px")))
            .filter(F.col("gap") <= F.col("bound") + _SLACK_MILES)
            .select("py", "px", "sy", "sx")
        )
    return pairs


def _meeting(places: DataFrame, spots: DataFrame, candidates: DataFrame, steps: int) -> DataFrame:
    """The pairs of places and sites that are compared: those in a cell and in the cells left for it."""
    places, spots = places.select("*", *_up("y", "x", steps, "p")), spots.select("*", *_up("y", "x", steps, "s"))
    looked_at = places.join(candidates, ["py", "px"]).select("plat", "plong", "sy", "sx")
    return looked_at.join(spots, ["sy", "sx"])


def nearest_site(
    points: DataFrame, sites: DataFrame, point_lat: str, point_long: str, site: str, site_lat: str, site_long: str
) -> DataFrame:
    """``points`` plus the columns ``site`` and ``distance`` (miles) of the nearest site.

    Equal distances go to the smallest site id. Longitudes may be any number
    of turns around the earth. A point without coordinates, or with a latitude
    that does not exist, keeps NULLs; such sites are left out.
    """
    points = points.withColumn("_plat", _latitude(point_lat)).withColumn("_plong", _longitude(point_long))
    sites = sites.withColumn("_slat", _latitude(site_lat)).withColumn("_slong", _longitude(site_long))
    point_lat, point_long, site_lat, site_long = "_plat", "_plong", "_slat", "_slong"
    # Points and sites that share a place are handled once.
    places = points.select(F.col(point_lat).alias("plat"), F.col(point_long).alias("plong")).dropna().distinct()
    places = places.select("plat", "plong", *_leaf("plat", "plong"))
    spots = (
        sites.dropna(subset=[site_lat, site_long])
        .groupBy(F.col(site_lat).alias("lat"), F.col(site_long).alias("long"))
        .agg(F.min(site).alias(site))
        .select("lat", "long", site, *_leaf("lat", "long"))
    )
    levels = _levels_for(spots)
    # Each level is one small aggregation straight from the tables.
    candidates = _candidate_cells(
        points.select(*_leaf(point_lat, point_long)).dropna(),
        sites.select(*_leaf(site_lat, site_long), F.struct(F.col(site_lat).alias("lat"), F.col(site_long).alias("long")).alias("site_at")).dropna(),
        levels,
    )
    meeting = _meeting(places, spots, candidates, levels[-1])
    miles = great_circle_miles(F.col("plat"), F.col("plong"), F.col("lat"), F.col("long"))
    best = (
        meeting.groupBy("plat", "plong")
        .agg(F.min(F.struct(F.round(miles, RESOLUTION_DIGITS).alias("distance"), site)).alias("best"))
        .select("plat", "plong", F.col("best")[site].alias(site), F.col("best.distance").alias("distance"))
    )
    same_place = (points[point_lat] == best["plat"]) & (points[point_long] == best["plong"])
    return points.join(best, same_place, "left").drop("plat", "plong", "_plat", "_plong")
