"""Mixture fits on planted components; levels against direct counting."""

import numpy as np
import pytest

from ledgerplay.operators import mixture as MX


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    a = rng.multivariate_normal([0, 0], [[1, 0.5], [0.5, 1]], 3000)
    b = rng.multivariate_normal([8, 5], [[1, -0.3], [-0.3, 2]], 1000)
    rows = [(float(x), float(y) + 1e6) for x, y in np.vstack([a, b])] + [(None, 1e6), (0.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    return df, MX.fit_mixture(df, ["x", "y"], 2, 20)


def test_fit_finds_planted_components(spark, planted):
    rows = planted[1].table(spark).orderBy("component").collect()
    assert [round(r["weight"], 2) for r in rows] == [0.75, 0.25]
    for r, (mx, my, vx, cov, vy) in zip(rows, [(0, 1e6, 1, 0.5, 1), (8, 1e6 + 5, 1, -0.3, 2)]):
        assert abs(r["mean_x"] - mx) < 0.1 and abs(r["mean_y"] - my) < 0.15
        assert abs(r["var_x"] - vx) < 0.15 and abs(r["cov_xy"] - cov) < 0.15 and abs(r["var_y"] - vy) < 0.3


def test_levels_hold_their_mass_and_labels_split(planted):
    df, m = planted
    levels = MX.density_levels(df, m, [0.5, 0.8, 0.95]).orderBy("mass").collect()
    for r in levels:  # the share of rows inside a highest-density region is its mass
        assert abs(r["n_rows"] / 4000 - r["mass"]) < 0.04
    assert levels[0]["level"] > levels[1]["level"] > levels[2]["level"] and levels[0]["cells"] < levels[2]["cells"]
    counts = {r["component"]: r["count"] for r in MX.assign_component(df, m).groupBy("component").count().collect()}
    assert counts[None] == 2 and abs(counts[0] - 3000) < 20 and abs(counts[1] - 1000) < 20


def test_constant_and_empty_columns_are_refused(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    for df in (flat, flat.limit(0)):
        with pytest.raises(ValueError):
            MX.fit_mixture(df, ["x", "y"])
