"""Many positions against brute force: 180th meridian, poles, far positions, one dense cell, equal points."""
import math
import random

import pytest

from dockline.operators import recommend as RC


def km(la1, lo1, la2, lo2):
    p = math.radians
    a = math.sin(p(la2 - la1) / 2) ** 2 + math.cos(p(la1)) * math.cos(p(la2)) * math.sin(p(lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def check(spark, stations, positions, k):
    st = spark.createDataFrame([(s, f"n{s[-1]}", la, lo, b, b) for s, la, lo, b in stations],
                               "station_id string, name string, latitude double, longitude double, num_bikes_available bigint, num_docks_available bigint")
    pos = spark.createDataFrame(positions, "position_id bigint, latitude double, longitude double")
    got = {}
    for r in sorted(RC.recommend_many(pos, st, "velo", k).collect(), key=lambda r: (r.position_id, r["rank"])):
        got.setdefault(r.position_id, []).append((r["rank"], r.station_id, r.distance_km))
    for p, la, lo in positions:
        near = sorted((km(la, lo, a, b), f"n{s[-1]}", s) for s, a, b, n in stations if n > 0 and a is not None)[:k] if la is not None else []
        mine = got.get(p, [])
        assert [m[0] for m in mine] == list(range(1, len(near) + 1))
        assert [m[2] for m in mine] == pytest.approx([n[0] for n in near], abs=2e-6)
        # equal but for rounding: order by name and id decides between exact ties only
        assert all(abs(next(km(la, lo, a, b) for s, a, b, _ in stations if s == m[1]) - m[2]) < 2e-6 for m in mine)
    return got


def test_nearest_equals_brute_force_on_the_globe(spark):
    rng = random.Random(6)
    st = [(f"g{i}", math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180), rng.randrange(0, 5)) for i in range(150)]
    st += [(f"m{i}", rng.uniform(-1, 1), 180 - 1e-4 * i if i % 2 else -180 + 1e-4 * i, 1) for i in range(30)]
    st += [(f"p{i}", 89.9 + 0.001 * i, 12.0 * i, 1) for i in range(30)]
    st += [("null", None, None, 3), ("pole", -90.0, 0.0, 1)]
    pos = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(60)]
    pos += [(100, 0.0, 180.0), (101, 0.0, -180.0), (102, 0.2, 179.9999), (103, 90.0, 0.0), (104, -90.0, 50.0), (105, 89.95, -170.0), (106, None, 3.0)]
    check(spark, st, pos, 3)


def test_dense_cell_far_positions_and_equal_points(spark):
    rng = random.Random(7)
    st = [(f"c{i}", 48.85 + rng.uniform(-0.05, 0.05), 2.35 + rng.uniform(-0.05, 0.05), 1) for i in range(200)]
    st += [(f"d{i}", 48.8566 + rng.uniform(0, 1e-6), 2.3522 + rng.uniform(0, 1e-6), 1) for i in range(600)]
    st += [(f"e{i:04d}", 48.9, 2.4, 1) for i in range(500)]
    pos = [(i, 48.85 + rng.uniform(-0.06, 0.06), 2.35 + rng.uniform(-0.06, 0.06)) for i in range(40)]
    pos += [(50, 48.8566, 2.3522), (51, 48.9, 2.4), (52, -33.9, 151.2), (53, -48.85, -177.65), (54, 48.9001, 2.4)]
    got = check(spark, st, pos, 5)
    ties = sorted((f"n{i % 10}", f"e{i:04d}") for i in range(500))[:5]
    assert [g[1] for g in got[51]] == [t[1] for t in ties]


def test_fewer_stations_than_asked_and_none(spark):
    assert len(check(spark, [("a1", 1.0, 1.0, 1), ("a2", 2.0, 2.0, 0)], [(1, 0.0, 0.0)], 3)[1]) == 1
    assert check(spark, [("a2", 2.0, 2.0, 0)], [(1, 0.0, 0.0)], 3) == {}
