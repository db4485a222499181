"""Hierarchies against a walk over dictionaries."""

import random

from marlstone.operators import hierarchy

SCHEMA = "id int, parent int, root string, size int, path string"  # the further columns clash with names used inside


def walk(parents):
    out = {}
    for node in parents:
        way, at = [node], node
        while parents.get(at) is not None and parents[at] in parents and parents[at] not in way:
            at = parents[at]
            way.append(at)
        nxt = parents.get(at)
        if nxt is not None and nxt in parents:
            out[node] = (min(way[way.index(nxt) :]), -1, None)
        else:
            out[node] = (at, len(way) - 1, way[::-1])
    return out


def rows_of(spark, rows):
    return spark.createDataFrame([(i, p, "x", 1, "y") for i, p in rows], SCHEMA)


def check(spark, rows):
    parents = {}
    for i, p in rows:
        if i is not None:
            known = parents.get(i)
            parents[i] = p if known is None else known if p is None else min(p, known)
    want = walk(parents)
    got = {r["id"]: r for r in hierarchy.hierarchy(rows_of(spark, rows), "id", "parent", paths=True).collect()}
    assert got.keys() == want.keys()
    below = {i: set() for i in want}
    for i, (_, depth, path) in want.items():
        for up in (path or [])[:-1]:
            below[up].add(i)
    for i, (root, depth, path) in want.items():
        r = got[i]
        assert (r["root"], r["depth"], r["path"]) == (root, depth, path)
        if depth >= 0:
            assert r["descendants"] == len(below[i]) and r["rgt"] - r["lft"] == len(below[i]) + 1
            inside = {j for j in want if want[j][1] >= 0 and got[j]["root"] == root and r["lft"] < got[j]["lft"] < r["rgt"]}
            assert inside == below[i]
        else:
            assert r["lft"] is None and r["descendants"] is None


def test_random_forest_with_cycles(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice([None, draw.randrange(70), draw.randrange(60), 500])) for i in range(60)]
    check(spark, rows + rows[:9] + [(None, 3), (60, 60)])


def test_chain_and_hub(spark):
    check(spark, [(i, i + 1 if i < 20 else None) for i in range(21)] + [(100 + i, 3) for i in range(40)])


def test_empty(spark):
    assert hierarchy.hierarchy(rows_of(spark, []), "id", "parent", paths=True).count() == 0
    check(spark, [(5, 5)])


def test_descendants_and_ancestry(spark):
    tree = hierarchy.hierarchy(rows_of(spark, [(1, None), (2, 1), (3, 2), (4, 1)]), "id", "parent", paths=True)
    asked = spark.createDataFrame([(2,), (1,), (9,)], "id int")
    assert {tuple(r) for r in hierarchy.descendants(tree, asked).collect()} == {(2, 3), (1, 2), (1, 3), (1, 4)}
    assert {tuple(r) for r in hierarchy.ancestry(tree).collect()} == {(1, 2, 1), (2, 3, 1), (1, 3, 2), (1, 4, 1)}
