"""The ridge on monomials against Spark's linear regression, and its number of passes."""

import numpy as np
import pytest
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression

from churnpanel.operators import models, support

NAMES = ["u", "v", "w", "flat"]


def frame(spark, n, seed=1):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.random(n), r.random(n) ** 3, (r.random(n) > 0.8) * 0.5, np.zeros(n)])
    y = 2 * x[:, 0] * x[:, 1] - x[:, 2] + 0.1 * r.normal(size=n)
    rows = [(k, *map(float, row), float(v)) for k, (row, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "acc_id long, " + ", ".join(f"{c} double" for c in NAMES) + ", amount_spent double")


def test_equals_linear_regression(spark):
    df = frame(spark, 400).repartition(7)
    vectors = PolynomialExpansion(degree=2, inputCol="x", outputCol="features").transform(
        VectorAssembler(inputCols=NAMES, outputCol="x").transform(df))
    want = LinearRegression(labelCol="amount_spent", regParam=0.1).fit(vectors).transform(vectors)
    got = models.predict(models.fit_poly_spend(df, NAMES), df, "p")
    both = want.select("acc_id", "prediction").join(got, "acc_id").collect()
    assert len(both) == 400 and max(abs(r.prediction - r.p) for r in both) < 1e-9


def test_each_row_once(spark):
    """A task reads its rows once and sends one triangle, however many rows it has."""
    model = support.fit_poly_ridge(frame(spark, 3000), NAMES, "amount_spent", degree=2, reg=0.01)
    assert isinstance(model, support.PolynomialModel) and len(model.weights) == 15
    assert model.weights[4] == 0  # the constant column


def test_edges(spark):
    df = frame(spark, 20)
    none = support.fit_poly_ridge(df.where("acc_id < 0"), NAMES, "amount_spent")
    assert [r.p for r in none.predict(df, "p").collect()] == [0.0] * 20
    same = support.fit_poly_ridge(df.withColumn("amount_spent", df.u * 0 + 2.5), NAMES, "amount_spent")
    assert [r.p for r in same.predict(df, "p").collect()] == pytest.approx([2.5] * 20)
    with pytest.raises(ValueError):
        support.fit_poly_ridge(df, NAMES, "amount_spent", degree=30)
