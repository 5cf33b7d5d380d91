"""Contacts of outlines against every pair of edges in whole numbers."""

import random
from fractions import Fraction

import pytest

from panelweft.functions.geo import UNIT_BITS
from panelweft.operators import outlines, zonal
from panelweft.operators.outlines import CROSSES, OVERLAPS, TOUCHES, nested_rings, outline_faults, ring_contacts
from panelweft.plans.zonal import BadOutlines
from tests.test_zonal import rings_frame, star


def snap(p):
    return tuple(int((Fraction(c) * 2**UNIT_BITS + Fraction(1, 2)) // 1) for c in p)


def side(a, b, c):
    d = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (d > 0) - (d < 0)


def meeting(a, b):
    (a0, a1), (b0, b1) = a, b
    s = side(a0, a1, b0), side(a0, a1, b1), side(b0, b1, a0), side(b0, b1, a1)
    if not any(s):
        lo, hi = max(min(a), min(b)), min(max(a), max(b))
        return (OVERLAPS, lo) if lo < hi else None
    if s[0] * s[1] < 0 and s[2] * s[3] < 0:
        return CROSSES, None
    for p, t, q in ((b0, s[0], a), (b1, s[1], a), (a0, s[2], b), (a1, s[3], b)):
        if t == 0 and p not in q and min(q[0][0], q[1][0]) <= p[0] <= max(q[0][0], q[1][0]) and min(q[0][1], q[1][1]) <= p[1] <= max(q[0][1], q[1][1]):
            return TOUCHES, p
    return None


def plain_contacts(rings):
    """(ring, seq, other, seq, reason, point or None) of one region."""
    edges = []
    for ring, points in enumerate(rings):
        at = [snap(p) for p in points]
        edges += [((ring, n), (at[n], at[(n + 1) % len(at)])) for n in range(len(at)) if at[n] != at[(n + 1) % len(at)]]
    out, first, starts = set(), {}, {}
    for who, e in sorted(edges):
        first.setdefault((min(e), max(e)), []).append(who)
        starts.setdefault(e[0], []).append(who)
    for (p, _), who in first.items():
        if len(who) > 1:
            out.add((*min(who), *max(who), OVERLAPS, p))
    for p, who in starts.items():
        if len(who) > 1:
            out.add((*sorted(who)[0], *sorted(who)[1], TOUCHES, p))
    distinct = sorted((min(w), e) for e, w in first.items())
    for i, (w, e) in enumerate(distinct):
        for v, f in distinct[i + 1 :]:
            met = meeting(e, f)
            if met:
                out.add((*w, *v, *met))
    return out


def found_contacts(df):
    out = {}
    for r in df.collect():
        at = None if r["reason"] == CROSSES else snap((r["lon"], r["lat"]))
        out.setdefault(r["region"], set()).add((r["ring_id"], r["seq"], r["other_ring"], r["other_seq"], r["reason"], at))
    return out


def test_contacts_match_every_pair(spark, monkeypatch):
    rnd = random.Random(5)
    shapes = {}
    for n in range(25):  # a coarse lattice: many touches and overlaps
        step = rnd.choice([0.5, 0.05, 1 / 3])
        shapes[f"lattice{n}"] = [[(rnd.randint(-6, 6) * step, rnd.randint(-6, 6) * step) for _ in range(rnd.randint(3, 9))] for _ in range(rnd.randint(1, 3))]
    for n in range(15):
        shapes[f"any{n}"] = [[(rnd.uniform(-2, 2), rnd.uniform(-2, 2)) for _ in range(rnd.randint(3, 12))]]
    shapes["star"] = [star(10, 10, 3, 400, rnd)]
    shapes["twice"] = [star(30, 10, 0.01, 200, random.Random(2)), star(30, 10, 0.01, 200, random.Random(3), turn=-1)]
    shapes["same"] = [[(1, 1), (2, 1), (2, 2)], [(2, 2), (2, 1), (1, 1)], [(1, 1), (2, 1), (2, 2)]]
    shapes["spike"] = [[(0, 0), (4, 0), (4, 4), (4, 9), (4, 4), (0, 4)]]
    shapes["edge of the world"] = [[(-180, -90), (180, -90), (180, 90), (-180, 90)]]
    monkeypatch.setattr(outlines, "DENSE", 12)
    got = found_contacts(ring_contacts(rings_frame(spark, shapes)))
    for name, rings in shapes.items():
        assert got.get(name, set()) == plain_contacts(rings), name
    reasons = [c[4] for cs in got.values() for c in cs]
    assert min(reasons.count(r) for r in (CROSSES, TOUCHES, OVERLAPS)) > 8


def test_crossing_points(spark):
    bow = {"bow": [[(0, 0), (2, 2), (2, 0), (0, 2)]]}
    (r,) = ring_contacts(rings_frame(spark, bow)).collect()
    assert (r["seq"], r["other_seq"], r["reason"], r["lon"], r["lat"]) == (0, 2, CROSSES, 1.0, 1.0)


def test_overlaps_inside_one_cell_are_named(spark):
    box = lambda x, y, s, turn=1: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)][::turn]
    shapes = {
        "overlap": [box(0.125, 0.0625, 0.3), box(0.25, 0.125, 0.3)], "nested": [box(5, 5, 3), box(6, 6, 0.01)],
        "hole": [box(5, 5, 3), box(6, 6, 0.01, -1)], "island": [box(5, 5, 3), box(6, 6, 1, -1), box(6.2, 6.2, 0.1)],
        "apart": [box(0, 0, 1), box(2, 0, 1)], "far": [box(0, 0, 1), box(-50, 0, 1), box(-170, 0, 1, -1)],
    }
    rings = rings_frame(spark, shapes)
    faults = {(r["region"], r["ring_id"], r["reason"]) for r in outline_faults(rings).collect()}
    assert faults == {("overlap", 0, CROSSES), ("overlap", 1, outlines.TWICE), ("nested", 1, outlines.TWICE)}
    at = {(r["region"], r["lon"], r["lat"]) for r in nested_rings(rings).collect()}
    assert at == {("nested", 6.0, 6.0), ("overlap", 0.25, 0.125)}


def test_small_rings_have_an_area(spark):
    tiny = [(10.0, 20.0), (10.0000005, 20.0), (10.0000005, 20.0000005), (10.0, 20.0000005)]
    line = [(170.1, 80.2), (170.3, 80.2), (170.2, 80.2)]
    bad = zonal.bad_rings(rings_frame(spark, {"tiny": [tiny], "line": [line]})).collect()
    assert [(r["region"], r["reason"]) for r in bad] == [("line", "zero area")]


def test_build_zonal_names_the_fault(spark):
    from panelweft.plans.zonal import build_zonal
    from tests.test_zonal_plan import make, square

    over = square("AAA.1", 0.1, 0.1, 0.3) + square("AAA.1", 0.3, 0.2, 0.3, ring=1) + square("BBB.1", 2.0, 2.0)
    with pytest.raises(BadOutlines, match="crosses: AAA.1"):
        build_zonal(make(spark, over))
