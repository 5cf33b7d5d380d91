"""Where the rings of a region cross, touch or lie on each other.

Coordinates are snapped to whole multiples of 2^-40 degrees (a ten-thousandth of
a millimetre), and everything after that is exact: the side of a line on which a point
lies is decided in floating point where rounding cannot change the sign, else in
whole numbers.

Edges are dealt to the cells of a square grid that they run through, and two edges
meet only where they share a cell of their region. Cells with many edges are split
into eight by eight, again and again, so that no cell pairs many edges, wherever
the outline is dense. Segments that occur more than once are paired by grouping,
and so are vertices: what is left for a cell are edges that differ.

Rings that lie inside each other without meeting are found by winding: the first
point of each ring is tested against the edges of the region's other rings at its
latitude.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweft.functions.geo import snapped, twice_area, unsnapped
from panelweft.operators.zonal import ring_edges
from panelweft.scale import materialise

CELL_BITS = 37  # first cells: an eighth of a degree
BAND_BITS = 38  # bands of latitude for the winding test: a quarter
SPLIT_BITS = 3  # a dense cell becomes eight by eight
DENSE = 48  # edges of a cell that is not split
DEPTH = 8
SLACK = 1e-9  # of a cell, by which an edge reaches into neighbouring columns

CROSSES, TOUCHES, OVERLAPS, TWICE = "crosses", "touches", "overlaps", "covered twice"


def side(a: tuple, b: tuple, c: tuple) -> Column:
    """1, -1 or 0: whether c lies to the left of the line from a to b, to its
    right, or on it. Exact for whole-number coordinates."""
    (ax, ay), (bx, by), (cx, cy) = a, b, c
    parts = ((bx - ax, cy - ay), (by - ay, cx - ax))
    left, right = (p.cast("double") * q.cast("double") for p, q in parts)
    exact = [p.cast("decimal(19,0)") * q.cast("decimal(19,0)") for p, q in parts]
    unsure = F.abs(left - right) <= (F.abs(left) + F.abs(right)) * 4e-16
    return F.when(unsure, F.signum(exact[0] - exact[1])).otherwise(F.signum(left - right))


def segments(rings: DataFrame, region: str = "region") -> DataFrame:
    """(region, ring_id, seq, x0, y0, x1, y1) of the edges that have a length."""
    edges = ring_edges(rings, region, strict=False).select(
        region, "ring_id", "seq",
        *(snapped(F.col(c)).alias(n) for c, n in (("lon0", "x0"), ("lat0", "y0"), ("lon1", "x1"), ("lat1", "y1"))),
    )
    return edges.where("x0 <> x1 or y0 <> y1")


def _deal(edges: DataFrame, bits: int, within: int | None = None) -> DataFrame:
    """Edges with each cell (cell_x, cell_y) of 2^bits units that they run
    through. Cells that are given already are split; an edge then only goes to
    parts of its own cell."""
    size = float(1 << bits)
    at = lambda c: F.shiftright(c, bits)
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    top, bottom = at(low), at(high)
    if within is not None:
        top = F.greatest(top, F.shiftleft("cell_y", SPLIT_BITS))
        bottom = F.least(bottom, F.shiftleft("cell_y", SPLIT_BITS) + (1 << SPLIT_BITS) - 1)
    rows = edges.where(top <= bottom).withColumn("__row", F.explode(F.sequence(top, bottom)))
    # the part of the edge in this row, in cells
    begin, end = F.col("__row") * size, (F.col("__row") + 1) * size
    slope = F.try_divide((F.col("x1") - F.col("x0")).cast("double"), (F.col("y1") - F.col("y0")).cast("double"))
    reach = lambda y: F.when(F.col("y0") == F.col("y1"), F.col("x0").cast("double")).otherwise(
        F.col("x0") + (y - F.col("y0")) * slope
    )
    xa, xb = reach(F.greatest(low.cast("double"), begin)), reach(F.least(high.cast("double"), end))
    level = F.col("y0") == F.col("y1")
    left = F.when(level, F.least("x0", "x1").cast("double")).otherwise(F.least(xa, xb))
    right = F.when(level, F.greatest("x0", "x1").cast("double")).otherwise(F.greatest(xa, xb))
    first, last = F.floor(left / size - SLACK), F.floor(right / size + SLACK)
    if within is not None:
        first = F.greatest(first, F.shiftleft("cell_x", SPLIT_BITS))
        last = F.least(last, F.shiftleft("cell_x", SPLIT_BITS) + (1 << SPLIT_BITS) - 1)
    kept = [c for c in edges.columns if c not in ("cell_x", "cell_y")]
    return rows.where(first <= last).select(
        *kept, F.explode(F.sequence(first, last)).alias("cell_x"), F.col("__row").alias("cell_y")
    )


def _meeting(a: str, b: str) -> Column:
    """How two different segments meet: (reason, x, y), or null."""
    point = lambda e, n: (F.col(f"{e}_x{n}"), F.col(f"{e}_y{n}"))
    a0, a1, b0, b1 = point(a, 0), point(a, 1), point(b, 0), point(b, 1)
    sides = (side(a0, a1, b0), side(a0, a1, b1), side(b0, b1, a0), side(b0, b1, a1))
    of = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    said = lambda reason, x, y: F.struct(F.lit(reason).alias("reason"), x.cast("double").alias("x"), y.cast("double").alias("y"))
    # on one line: the stretch that both have
    begin = F.greatest(F.least(of(a0), of(a1)), F.least(of(b0), of(b1)))
    end = F.least(F.greatest(of(a0), of(a1)), F.greatest(of(b0), of(b1)))
    on_one_line = reduce(lambda x, y: x & y, [s == 0 for s in sides])
    # proper crossing, as far along a as the sides of its ends are apart
    dx, dy = (F.col(f"{a}_{c}1") - F.col(f"{a}_{c}0") for c in "xy")
    ex, ey = (F.col(f"{b}_{c}1") - F.col(f"{b}_{c}0") for c in "xy")
    product = lambda p, q: p.cast("double") * q.cast("double")
    part = F.try_divide(
        product(b0[0] - a0[0], ey) - product(b0[1] - a0[1], ex), product(dx, ey) - product(dy, ex)
    )
    crossing = (sides[0] * sides[1] < 0) & (sides[2] * sides[3] < 0)

    def inside(p, s, q0, q1):
        within = p[0].between(F.least(q0[0], q1[0]), F.greatest(q0[0], q1[0])) & p[1].between(
            F.least(q0[1], q1[1]), F.greatest(q0[1], q1[1])
        )
        return (s == 0) & within & (of(p) != of(q0)) & (of(p) != of(q1))

    found = F.when(
        on_one_line, F.when(begin < end, said(OVERLAPS, begin["x"], begin["y"]))
    ).when(crossing, said(CROSSES, F.col(f"{a}_x0") + part * dx, F.col(f"{a}_y0") + part * dy))
    for p, s, q0, q1 in ((b0, sides[0], a0, a1), (b1, sides[1], a0, a1), (a0, sides[2], b0, b1), (a1, sides[3], b0, b1)):
        found = found.when(inside(p, s, q0, q1), said(TOUCHES, *p))
    return found


def ring_contacts(rings: DataFrame, region: str = "region") -> DataFrame:
    """(region, ring_id, seq, other_ring, other_seq, reason, lon, lat): the pairs
    of edges of a region, known by their first vertex, that cross, touch at
    an inner point or lie on each other; and vertices that outlines pass twice.

    Edges that follow each other share a vertex, which is no contact; a vertex
    that is passed more than once touches: its first two passes are given. Of
    segments that occur more than once, first and last are given, and other
    edges meet the first. Two outlines that cross exactly at a vertex of one of
    them touch there.
    """
    edges = segments(rings, region)
    who = F.struct("ring_id", "seq")
    start, end = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    same = materialise(
        edges.groupBy(region, F.least(start, end).alias("p"), F.greatest(start, end).alias("q")).agg(
            F.min(who).alias("one"), F.max(who).alias("other"), F.count(F.lit(1)).alias("n")
        ),
        "segments",
    )
    names = [region, "ring_id", "seq", "other_ring", "other_seq", "reason", "lon", "lat"]

    def listed(df, reason, x, y):
        return df.select(
            region, F.col("one.ring_id"), F.col("one.seq"), F.col("other.ring_id"), F.col("other.seq"),
            reason, unsnapped(x), unsnapped(y),
        ).toDF(*names)

    repeated = listed(same.where("n > 1"), F.lit(OVERLAPS), F.col("p.x"), F.col("p.y"))
    passes = edges.groupBy(region, "x0", "y0").agg(
        F.slice(F.sort_array(F.collect_list(who)), 1, 2).alias("who"), F.count(F.lit(1)).alias("n")
    )
    passed = passes.where("n > 1").select(region, "x0", "y0", F.col("who")[0].alias("one"), F.col("who")[1].alias("other"))
    passed = listed(passed, F.lit(TOUCHES), F.col("x0"), F.col("y0"))

    now = same.select(
        region, "one", F.col("p.x").alias("x0"), F.col("p.y").alias("y0"), F.col("q.x").alias("x1"), F.col("q.y").alias("y1")
    )
    cell = [region, "cell_x", "cell_y"]
    dealt, found = _deal(now, CELL_BITS), []
    for depth in range(DEPTH + 1):
        dealt = materialise(dealt, "dealt-edges")
        many = dealt.groupBy(*cell).count().where(F.col("count") > DENSE).drop("count")
        dense = materialise(many, "dense-cells") if depth < DEPTH else many.limit(0)
        some = dealt.join(dense, cell, "left_anti") if depth < DEPTH else dealt
        named = lambda e: some.select(*cell, *(F.col(c).alias(f"{e}_{c}") for c in ("one", "x0", "y0", "x1", "y1")))  # noqa: E731, B023
        boxes = F.lit(True)
        for c in "xy":
            a, b = ((F.least(f"{e}_{c}0", f"{e}_{c}1"), F.greatest(f"{e}_{c}0", f"{e}_{c}1")) for e in "ab")
            boxes = boxes & (a[0] <= b[1]) & (b[0] <= a[1])
        met = named("a").join(named("b"), cell).where((F.col("a_one") < F.col("b_one")) & boxes)
        met = met.select(region, F.col("a_one").alias("one"), F.col("b_one").alias("other"), _meeting("a", "b").alias("at"))
        found.append(met.where("at is not null"))
        if depth == DEPTH or dense.isEmpty():
            break
        dealt = _deal(dealt.join(dense, cell, "left_semi"), CELL_BITS - SPLIT_BITS * (depth + 1), within=1)
    met = reduce(DataFrame.unionByName, found).dropDuplicates([region, "one", "other"])
    met = listed(met, F.col("at.reason"), F.col("at.x"), F.col("at.y"))
    return met.unionByName(repeated).unionByName(passed)


def nested_rings(rings: DataFrame, region: str = "region") -> DataFrame:
    """(region, ring_id, lon, lat): rings that lie in another ring of their
    region and turn the same way, so that what they hold is covered twice. For
    rings without contacts; the point is the ring's first from the west."""
    edges = segments(rings, region)
    of_ring = edges.groupBy(region, "ring_id").agg(
        F.min(F.struct("x0", "y0")).alias("p"), F.signum(twice_area("x0", "y0", "x1", "y1")).alias("turn")
    )
    many = of_ring.groupBy(region).count().where("count > 1").select(region)
    points = of_ring.join(many, region, "left_semi").select(
        region, F.col("ring_id").alias("ring"), "turn", F.col("p.x0").alias("px"), F.col("p.y0").alias("py"),
        F.shiftright(F.col("p.y0"), BAND_BITS).alias("band"),
    )
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    bands = F.sequence(F.shiftright(low, BAND_BITS), F.shiftright(high, BAND_BITS))
    crossing = edges.where("y0 <> y1").withColumn("band", F.explode(bands))
    up = F.col("y0") < F.col("y1")
    spans = (low <= F.col("py")) & (F.col("py") < high)
    beside = side((F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y1")), (F.col("px"), F.col("py")))
    west = F.when(up, beside < 0).otherwise(beside > 0)  # the edge passes west of the point
    around = (
        points.join(crossing, [region, "band"])
        .where((F.col("ring") != F.col("ring_id")) & spans & west)
        .groupBy(region, "ring", "turn", "px", "py")
        .agg(F.sum(F.when(up, 1).otherwise(-1)).alias("around"))
    )
    # inside a ring that turns left the count is -1
    return around.where(F.abs(F.col("around") - F.col("turn")) > 1).select(
        region, F.col("ring").alias("ring_id"), unsnapped(F.col("px")).alias("lon"), unsnapped(F.col("py")).alias("lat")
    )


def outline_faults(rings: DataFrame, region: str = "region") -> DataFrame:
    """(region, ring_id, other_ring, reason, lon, lat): one row for each pair of
    rings and reason, with the first such point from the west; rings covered
    twice are named with themselves."""
    point = F.struct("lon", "lat")
    met = ring_contacts(rings, region).groupBy(region, "ring_id", "other_ring", "reason").agg(F.min(point).alias("at"))
    inside = nested_rings(rings, region).select(
        region, "ring_id", F.col("ring_id").alias("other_ring"), F.lit(TWICE).alias("reason"), point.alias("at")
    )
    return met.unionByName(inside).select(region, "ring_id", "other_ring", "reason", "at.lon", "at.lat")
