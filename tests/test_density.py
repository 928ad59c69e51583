import numpy as np
import pytest

from gapweave.operators import density


def brute(points, eps, least):
    d = (points[:, None, 0] - points[None, :, 0]) ** 2 + (points[:, None, 1] - points[None, :, 1]) ** 2
    near = d <= eps * eps
    core = near.sum(1) >= least
    label = -np.ones(len(points), int)
    number = 0
    for i in range(len(points)):
        if label[i] != -1 or not core[i]:
            continue
        stack, label[i] = [i], number
        while stack:
            j = stack.pop()
            if core[j]:
                for m in np.flatnonzero(near[j] & (label == -1)):
                    label[m] = number
                    stack.append(m)
        number += 1
    return label, core


def cases():
    rng = np.random.default_rng(7)
    yield np.round(rng.uniform(-15, 15, (150, 2)), 1), 1.5, 3
    hot = np.tile([[4.0, 4.0]], (80, 1))
    yield np.vstack([rng.normal(0, 1, (100, 2)), hot, rng.normal(8, 1, (60, 2))]), 0.5, 5
    wall = np.column_stack([np.zeros(200), np.linspace(0, 3, 200)])
    # One wall just out of reach, one just within it.
    yield np.vstack([wall, wall + [1.0000001, 0], wall - [0.99999, 0]]), 1.0, 4


@pytest.mark.parametrize("case", range(3))
def test_clusters_equal_the_plain_scan(spark, case):
    points, eps, least = list(cases())[case]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id long, x double, y double")
    label, core = brute(points, eps, least)
    got = {r.id: r.cluster for r in density.density_clusters(df, "id", "x", "y", eps, least).collect()}
    assert [got[i] for i in range(len(points))] == list(label)
    marked = {r.id: r.is_core for r in density.core_points(df, "id", "x", "y", eps, least).collect()}
    assert [marked[i] for i in range(len(points))] == list(core)


@pytest.mark.parametrize("limit", [1000, 2])
def test_components_of_paths_and_hubs(spark, limit):
    edges = [(i, i + 1) for i in range(40) if i % 20 != 19] + [(500, x) for x in range(300, 320)] + [(7, 7)]
    got = density.components(spark.createDataFrame(edges, "a long, b long"), edge_rows=limit)
    sizes = {r.component: r["count"] for r in got.groupBy("component").count().collect()}
    assert sizes == {0: 20, 20: 20, 300: 21}
    assert got.count() == got.select("node").distinct().count()
