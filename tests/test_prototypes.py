"""Nearest prototypes against comparing every row with every prototype."""

import random

import pytest

from lodestat.operators.prototypes import nearest_gower

SCHEMA = "id long, a double, b double, c string, d string"


def brute(rows, protos, ranges):
    out = {}
    for i, *row in rows:
        if None in row:
            out[i] = (None, None)
            continue
        ways = []
        for k, *proto in protos:
            if None not in proto:
                gaps = [abs(x - y) / ranges[n] for n, x, y in zip("ab", row, proto)] + [float(x != y) for x, y in zip(row[2:], proto[2:])]
                ways.append((round(sum(gaps) / 4, 9), k))
        out[i] = min(ways)[::-1] if ways else (None, None)
    return out


def found(spark, rows, protos, ranges, **options):
    frames = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(protos, SCHEMA)
    got = nearest_gower(frames[0], "id", frames[1], "id", ["a", "b"], ["c", "d"], ranges, **options).collect()
    assert len(got) == len(rows)
    return {r.id: (r.nearest, None if r.distance is None else round(r.distance, 9)) for r in got}


def cases(seed, n, spread=10.0, levels=6):
    rng = random.Random(seed)
    return [(i, rng.uniform(0, spread), float(rng.randrange(levels)), rng.choice("pqrst"), rng.choice("xyz")) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_comparing_all(spark, seed):
    rows, protos = cases(seed, 400), [(1000 + i, *r) for i, *r in cases(seed + 10, 150)]
    ranges = {"a": 10.0, "b": 5.0}
    assert found(spark, rows, protos, ranges) == brute(rows, protos, ranges)


def test_crowded_prototypes_and_rows_far_outside(spark):
    """A third of the prototypes within a thousandth of the range, copies and ties, categories no prototype has, and rows out of range."""
    rng = random.Random(5)
    protos = [(i, 3 + rng.random() / 1000, 2.0, "p", "x") for i in range(100)] + [(500 + i, *r) for i, *r in cases(6, 180)] + [(900, 3.0, 2.0, "p", "x"), (901, 3.0, 2.0, "p", "x")]
    rows = [(i, 3 + rng.random() / 500, 2.0, "p", "x") for i in range(120)] + [(200 + i, *r) for i, *r in cases(7, 60)]
    rows += [(300, -40.0, 2.0, "p", "x"), (301, 75.0, -9.0, "new", "new"), (302, 3.0, 2.0, "p", "x"), (303, 5.0, 5.0, "new", "z")]
    ranges = {"a": 10.0, "b": 5.0}
    want = brute(rows, protos, ranges)
    assert want[302] == (900, 0.0)
    assert found(spark, rows, protos, ranges) == want and found(spark, rows, protos, ranges, levels=3) == want


def test_nulls_one_value_and_empty_tables(spark):
    rows = [(1, 1.0, 1.0, "p", "x"), (1, 1.0, 1.0, "p", "x"), (2, None, 1.0, "p", "x"), (3, 1.0, 1.0, None, "x"), (4, float("nan"), 1.0, "p", "x")]
    protos = [(9, 1.0, 1.0, "q", "x"), (8, None, 1.0, "p", "x"), (7, 1.0, 1.0, "p", None)]
    got = found(spark, rows, protos, {"a": 0.0, "b": 0.0})
    assert got == {1: (9, 0.25), 2: (None, None), 3: (None, None), 4: (None, None)}
    assert found(spark, rows, [], {"a": 1.0, "b": 1.0})[1] == (None, None)
    none = spark.createDataFrame([], SCHEMA)
    assert nearest_gower(none, "id", spark.createDataFrame(protos, SCHEMA), "id", ["a", "b"], ["c", "d"], {"a": 1.0, "b": 1.0}).isEmpty()
