"""MLlib pipelines and model-based operators.

Fitting is MLlib's distributed optimisers (treeAggregate of gradients, no
driver-side data).  Closed-form fits (one regressor, per group, per resample)
are sums in one aggregate.  Scores come back as columns; nothing is collected
except model parameters.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerplay.operators.prefix import prefix_agg
from ledgerplay.session import checkpoint_dir, cut_lineage


def _assemble(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip")


def _stored(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns a fit reads, stored once: a boosted fit passes over them many times, and folds
    drawn by row (train and validation apart) must see the rows in one order."""
    return cut_lineage(df.select(*dict.fromkeys(cols)))


def linear_regression(train: DataFrame, y: str, xs: Sequence[str]) -> PipelineModel:
    """Least squares on the given features."""
    return Pipeline(stages=[_assemble(xs), LinearRegression(featuresCol="features", labelCol=y, solver="normal")]).fit(train)


def poly2_regression(train: DataFrame, y: str, xs: Sequence[str]) -> PipelineModel:
    """Degree-2 expansion + regression."""
    return Pipeline(stages=[_assemble(xs, "raw"), PolynomialExpansion(degree=2, inputCol="raw", outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=y, solver="normal")]).fit(train)


def lasso(train: DataFrame, y: str, xs: Sequence[str], alpha: float, standardize_first: bool = True) -> PipelineModel:
    """L1 regression (objective scaled by 1/(2n)), optionally on standardised inputs."""
    stages = [_assemble(xs, "raw")]
    if standardize_first:
        stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    else:
        stages[0] = _assemble(xs, "features")
    stages.append(LinearRegression(featuresCol="features", labelCol=y, elasticNetParam=1.0, regParam=alpha,
                                   standardization=False, maxIter=200))
    return Pipeline(stages=stages).fit(train)


def logistic(train: DataFrame, y: str, xs: Sequence[str], weight: str | None = None) -> PipelineModel:
    """Unpenalised logistic regression on standardised features (class weight optional)."""
    lr = LogisticRegression(featuresCol="features", labelCol=y, regParam=0.0, maxIter=500, tol=1e-12)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[_assemble(xs, "raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            lr]).fit(train)


def coefficients(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Coefficients with names, largest |coef| first (a small table)."""
    m = model.stages[-1]
    coefs = list(m.coefficients.toArray()) if hasattr(m, "coefficients") else list(m.featureImportances.toArray())
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(n, float(c), abs(float(c))) for n, c in zip(names, coefs)],
                                 "feature string, coef double, abs_coef double").orderBy(F.col("abs_coef").desc())


def predict_proba(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of class 1 and the thresholded label."""
    out = model.transform(df).withColumn("p1", vector_to_array("probability")[1])
    return out.withColumn("label_hat", (F.col("p1") >= threshold).cast("int"))


def gmm(df: DataFrame, cols: Sequence[str], k: int = 2, seed: int = 1) -> DataFrame:
    """Gaussian mixture on the columns (NULL -> 0); component of each row."""
    d = df.fillna(0.0, subset=list(cols))
    model = Pipeline(stages=[_assemble(cols), GaussianMixture(k=k, seed=seed, featuresCol="features")]).fit(d)
    return model.transform(d).withColumn("component", F.col("prediction"))


def kmeans_twice_agree(df: DataFrame, cols: Sequence[str], k: int, seed: int, key: str) -> DataFrame:
    """Cluster standardised data twice with one seed; count rows whose cluster differs."""
    d = df.dropna(subset=list(cols))
    pipe = Pipeline(stages=[_assemble(cols, "raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            KMeans(k=k, seed=seed, featuresCol="features")])
    a = pipe.fit(d).transform(d).select(key, F.col("prediction").alias("a"))
    b = pipe.fit(d).transform(d).select(key, F.col("prediction").alias("b"))
    return a.join(b, key).agg(F.count_if(F.col("a") != F.col("b")).alias("n_differ"), F.count(F.lit(1)).alias("n"))


def pca_first(df: DataFrame, cols: Sequence[str], out: str = "pc1") -> DataFrame:
    """First principal component of the standardised columns, sign fixed so
    that the first loading is positive."""
    d = df.dropna(subset=list(cols))
    model = Pipeline(stages=[_assemble(cols, "raw"), StandardScaler(inputCol="raw", outputCol="z", withMean=True),
                             PCA(k=1, inputCol="z", outputCol="pcv")]).fit(d)
    sign = 1.0 if model.stages[-1].pc.toArray()[0, 0] >= 0 else -1.0
    return model.transform(d).withColumn(out, vector_to_array("pcv")[0] * sign).drop("raw", "z", "pcv")


def gbt_regression(train: DataFrame, test: DataFrame, y: str, xs: Sequence[str], iters: int = 20,
                   depth: int = 3, seed: int = 7) -> tuple[PipelineModel, list[float], list[float]]:
    """Boosted trees; train and test loss after each round."""
    train, test = (_stored(d, [y, *xs]) for d in (train, test))
    model = Pipeline(stages=[_assemble(xs), GBTRegressor(featuresCol="features", labelCol=y, maxIter=iters,
                                                         maxDepth=depth, seed=seed)]).fit(train)
    gbt = model.stages[-1]
    tr = gbt.evaluateEachIteration(model.stages[0].transform(train), "squared")
    te = gbt.evaluateEachIteration(model.stages[0].transform(test), "squared")
    return model, list(tr), list(te)


def tree_nodes(model: PipelineModel) -> DataFrame:
    """T4: the fitted trees as a table (tree, node, feature, gain, rows, prediction), one row per node.

    ``feature`` (the column's name) and ``gain`` (impurity taken away) are null at leaves;
    ``rows`` is the weight of the training rows that reached the node.  The rows are read
    back from the model's own store below the shared folder.
    """
    spark = SparkSession.getActiveSession()
    path = os.path.join(checkpoint_dir(spark), "ledgerplay-models", uuid.uuid4().hex)
    model.stages[-1].write().save(path)
    names = F.array(*[F.lit(c) for c in model.stages[0].getInputCols()])
    n, leaf = "nodeData", F.col("nodeData.leftChild") < 0
    return spark.read.parquet(os.path.join(path, "data")).select(
        F.col("treeID").alias("tree"), F.col(f"{n}.id").alias("node"), F.when(~leaf, F.get(names, F.col(f"{n}.split.featureIndex"))).alias("feature"),
        F.when(~leaf, F.col(f"{n}.gain")).alias("gain"), F.col(f"{n}.rawCount").cast("double").alias("rows"), F.col(f"{n}.prediction").alias("prediction"))


def importances(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """T4: (feature, importance, splits) from the nodes of fitted trees.

    The gain of a split counts with the rows it divides; the sums over all trees are scaled
    to 1 (later trees of a boosted model, which have less to gain, count for less).  Columns
    never split on have importance 0; without any split all have.
    """
    gain = nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"), F.count(F.lit(1)).alias("splits"))
    every = nodes.sparkSession.createDataFrame([(c,) for c in names], "feature string").join(gain, "feature", "left")
    total = F.sum("g").over(Window.partitionBy())  # one row per column of the model
    return every.select("feature", F.when(total > 0, F.coalesce("g", F.lit(0.0)) / total).otherwise(0.0).alias("importance"),
                        F.coalesce("splits", F.lit(0).cast("long")).alias("splits"))


def loss_per_round(model: PipelineModel, train: DataFrame, test: DataFrame, loss: str) -> DataFrame:
    """(round, train_loss, test_loss) of boosted trees, one row per round."""
    first, trees = model.stages[0], model.stages[-1]
    call = lambda d: trees.evaluateEachIteration(first.transform(d), *([loss] if loss == "squared" else []))
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(call(train), call(test)))]
    return train.sparkSession.createDataFrame(rows, "round int, train_loss double, test_loss double")


def grid_cv(train: DataFrame, y: str, xs: Sequence[str], depths: Sequence[int], folds: int = 3, seed: int = 7):
    """K-fold grid search on the training set only (folds evaluated in parallel)."""
    gbt = GBTRegressor(featuresCol="features", labelCol=y, maxIter=10, seed=seed)
    pipe = Pipeline(stages=[_assemble(xs), gbt])
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=y, metricName="rmse"),
                        numFolds=folds, seed=seed, parallelism=min(4, len(grid)))
    return cv.fit(_stored(train, [y, *xs]))


def gbt_classifier(train: DataFrame, y: str, xs: Sequence[str], iters: int = 20, seed: int = 7) -> PipelineModel:
    """Boosted-tree classifier."""
    return Pipeline(stages=[_assemble(xs), GBTClassifier(featuresCol="features", labelCol=y, maxIter=iters, seed=seed)]).fit(_stored(train, [y, *xs]))


def binned_logistic(df: DataFrame, bin_col: str, x: str, y: str, iters: int = 25) -> DataFrame:
    """One logistic curve p = 1/(1+exp(-(a + b x))) per bin by Newton steps.

    Each step is ONE grouped aggregate of the gradient and Hessian sums for all
    bins at once; the per-bin 2x2 solve is column arithmetic on the small
    (bins) table, which is broadcast back for the next step.
    """
    # every Newton step reads the data again: materialise the three columns once
    d = cut_lineage(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        bin_col, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")))
    params = d.groupBy(bin_col).agg(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    for _ in range(iters):
        j = d.join(F.broadcast(params), bin_col)
        p = 1.0 / (1.0 + F.exp(-(F.col("a") + F.col("b") * F.col("__x"))))
        w = p * (1 - p)
        g = j.groupBy(bin_col).agg(
            F.first("a").alias("a"), F.first("b").alias("b"),
            F.sum(F.col("__y") - p).alias("g0"), F.sum((F.col("__y") - p) * F.col("__x")).alias("g1"),
            F.sum(w).alias("h00"), F.sum(w * F.col("__x")).alias("h01"), F.sum(w * F.col("__x") * F.col("__x")).alias("h11"))
        det = F.col("h00") * F.col("h11") - F.col("h01") * F.col("h01")
        da = F.when(det != 0, (F.col("h11") * F.col("g0") - F.col("h01") * F.col("g1")) / det).otherwise(0.0)
        db = F.when(det != 0, (F.col("h00") * F.col("g1") - F.col("h01") * F.col("g0")) / det).otherwise(0.0)
        params = g.select(bin_col, (F.col("a") + da).alias("a"), (F.col("b") + db).alias("b"))
        # the parameter table is tiny; a reliable checkpoint keeps the plan short
        params = cut_lineage(params)
    return params


def activation_curve(model: PipelineModel, loans: DataFrame, rate_col: str, rates: Sequence[float]) -> DataFrame:
    """Predicted activation per loan over a rate range (fixed expansion per loan)."""
    g = loans.withColumn(rate_col, F.explode(F.array(*[F.lit(float(r)) for r in rates])))
    return predict_proba(model, g).select(*loans.columns, "p1")


def score_table(df: DataFrame, path: str) -> DataFrame:
    """Apply a stored pipeline; columns are selected by the pipeline itself."""
    return PipelineModel.load(path).transform(df)


def learning_curve(df: DataFrame, y: str, x: str, key: str, sizes: Sequence[int], reps: int, test: DataFrame) -> DataFrame:
    """Mean test R^2 by training size over resamples, closed form (one regressor).

    Sample (size, rep) = the ``size`` rows with the smallest hash of (key, rep);
    positions come from running counts by ranges of (rep, hash, key).  One aggregate
    fits every sample; the test R^2 of every fit follows from six test sums
    (SSE expands into sums of y, x, xy, x^2, y^2), so no test row is paired
    with any sample.
    """
    from ledgerplay.functions.formulas import HASH_P, hash31_sql
    base = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(key, x, y)
    per_rep = base.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
    per_rep = per_rep.withColumn("__h", F.expr(f"CAST({hash31_sql(f'`{key}`', 'rep')} AS DOUBLE) / {HASH_P}"))  # an order of its own per rep
    per_rep = per_rep.withColumn("__one", F.lit(1.0))
    ranked = prefix_agg(per_rep, "__h", ["__one"], tie_cols=[key], by=["rep"])
    s = ranked.withColumn("size", F.explode(F.array(*[F.lit(int(n)) for n in sizes]))).where(F.col("__one_cum") <= F.col("size"))
    fit = s.groupBy("size", "rep").agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"))
    t = test.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ts = t.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("sy"), F.sum(x).alias("sx"),
               F.sum(F.col(x) * F.col(y)).alias("sxy"), F.sum(F.col(x) * F.col(x)).alias("sxx"),
               F.sum(F.col(y) * F.col(y)).alias("syy")).collect()[0]
    a, b = F.col("a"), F.col("b")
    sse = (F.lit(ts["syy"]) - 2 * a * ts["sy"] - 2 * b * ts["sxy"] + a * a * ts["n"] + 2 * a * b * ts["sx"] + b * b * ts["sxx"])
    sst = ts["syy"] - ts["sy"] * ts["sy"] / ts["n"]
    r2 = fit.withColumn("r2", 1 - sse / F.lit(sst))
    return r2.groupBy("size").agg(F.avg("r2").alias("mean_r2"), F.count(F.lit(1)).alias("reps"))


def range_holdout(df: DataFrame, y: str, x: str, cut: float) -> DataFrame:
    """Fit on x < cut, R^2 on x >= cut (closed form, one regressor)."""
    tr = df.where(F.col(x) < cut)
    f = tr.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")).collect()[0]
    te = df.where(F.col(x) >= cut).withColumn("yhat", F.lit(f["a"]) + F.lit(f["b"]) * F.col(x))
    from ledgerplay.operators.aggregates import r2
    return r2(te, y, "yhat")
