"""Second forms of operators on hand cases; tree tables against the fitted model."""

import pytest
from pyspark.sql import functions as F

from ledgerplay.operators import aggregates as G
from ledgerplay.operators import clean as P
from ledgerplay.operators import models as ML
from ledgerplay.sources import tables as S


def test_fill_mode_ties_and_empty_columns(spark):
    df = spark.createDataFrame([("b", 1, None), ("a", 1, None), (None, None, None), ("b", 2, None), ("a", 3, None)], "s string, n int, e string")
    got = sorted(tuple(r) for r in P.fill_mode(df, df, ["s", "n", "e"]).select("s", "n").collect())
    assert got == [("a", 1), ("a", 1), ("a", 3), ("b", 1), ("b", 2)]
    assert P.fill_mode(df, df, ["e"]).where("e IS NOT NULL").count() == 0


def test_outlier_share(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4, 100)] + [(None,)], "v double")
    assert tuple(P.outlier_share(df, "v").first()) == (7.0, 1, 0.2)
    assert P.outlier_share(df.limit(0), "v").first()["share"] is None


def test_selection_quantiles_null_flag_counts_in_all_only(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 3.0), (False, 10.0), (None, 6.0), (True, None)], "f boolean, v double")
    got = {r["scope"]: r["value"] for r in G.selection_quantiles(df, "f", ["v"], [0.5]).collect()}
    assert got == {"selected": 2.0, "rest": 10.0, "all": 4.5}


def test_columns_by_type_and_variability(spark):
    df = spark.createDataFrame([(1, 1.0, "x", "k"), (2, 1.0, "y", "k"), (3, 2.0, "y", None)], "a long, b double, c string, d string")
    assert {r["dtype"]: r["n_columns"] for r in P.dtype_counts(df).collect()} == {"bigint": 1, "double": 1, "string": 2}
    assert P.drop_lowest_variability(df, 2).columns == ["a", "c"]  # d has one value, b comes before c among those with two


def test_fraction_of_the_files(spark, tmp_path):
    for i in range(5):
        spark.range(i * 10, i * 10 + 2).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        part = next((tmp_path / f"w{i}").glob("part-*.parquet"))
        (tmp_path / "all").mkdir(exist_ok=True)
        (tmp_path / "all" / f"f{i}.parquet").write_bytes(part.read_bytes())
    read = lambda frac: sorted(r[0] for r in S.read_parquet_fraction(spark, str(tmp_path / "all"), frac).collect())
    assert read(0.5) == [0, 1, 10, 11, 20, 21]
    assert read(0.01) == [0, 1] and len(read(1.0)) == 10
    with pytest.raises(ValueError):
        read(0.0)


def test_importances_equal_the_models_own(spark):
    rows = [(float(i % 17), float(i % 5), float((i * 7) % 11), 3.0 * (i % 17) + (i % 5) ** 2) for i in range(400)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, x3 double, y double")
    names = ["x1", "x2", "x3"]
    model, train, test = ML.gbt_regression(df, df, "y", names, iters=5)
    nodes = ML.tree_nodes(model)
    assert nodes.select("tree").distinct().count() == 5
    got = {r["feature"]: r["importance"] for r in ML.importances(nodes, names).collect()}
    assert abs(sum(got.values()) - 1.0) < 1e-9
    for name, want in zip(names, model.stages[-1].featureImportances.toArray()):
        assert abs(got[name] - want) < 1e-6
    table = ML.loss_per_round(model, df, df, "squared").orderBy("round").collect()
    # partial sums merge in any order, so the last bits differ from run to run
    assert [r["train_loss"] for r in table] == pytest.approx(train, rel=1e-12) and [r["test_loss"] for r in table] == pytest.approx(test, rel=1e-12)
    assert table[-1]["train_loss"] < table[0]["train_loss"]


def test_boosted_fits_compute_their_rows_once(spark):
    """Folds, parameters and trees are many passes; the features behind them are joins and root searches."""
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda x: (seen.add(1), float(x))[1], "double").asNondeterministic()
    df = spark.range(0, 120, 1, 2).select(mark("id").alias("a"), (F.col("id") % 7).cast("double").alias("y"), F.lit("x").alias("unused"))
    cv = ML.grid_cv(df, "y", ["a"], [1, 2], folds=2)
    assert len(cv.avgMetrics) == 2 and seen.value == 120
    ML.gbt_regression(df, df, "y", ["a"], iters=2)
    assert seen.value == 120 + 2 * 120
