"""Permutation importance: which features it covers, and its drops where they are known."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from starmetrics.operators import learn as L
from starmetrics.plans import ml_models_q as M


def test_query_permutes_every_feature_of_the_model(spark, monkeypatch):
    empty = spark.createDataFrame([], "anio_mes int")
    monkeypatch.setattr(M, "_return_model", lambda *_: (None, None, empty))
    monkeypatch.setattr(L, "permutation_importance", lambda mdl, iso, df, label, features: features)
    got = M.m11(spark, "")
    assert sorted(got) == sorted([*L.RETURN_NUM, *L.RETURN_CAT])


def test_drops_of_known_features(spark):
    """``a`` alone makes the label: permuted, the AUC falls from 1 to about a half.  The others are in no split."""
    df = spark.range(4000).select(
        (F.col("id") * 37 % 101 / 101.0).alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.concat(F.lit("x"), F.col("id") % 3).alias("c"))
    df = df.withColumn("y", (F.col("a") > 0.5).cast("int")).withColumn("_y", F.col("y").cast("double"))
    model = Pipeline(stages=[StringIndexer(inputCol="c", outputCol="c_ix"), VectorAssembler(inputCols=["a", "b", "c_ix"], outputCol="features"),
                             GBTClassifier(labelCol="_y", featuresCol="features", maxIter=1, maxDepth=1)]).fit(df)
    raw = model.transform(df).select(vector_to_array("probability")[1].alias("p_raw"), "_y")
    iso = IsotonicRegression(featuresCol="p_raw", labelCol="_y", predictionCol="prob").fit(raw)
    got = {r["feature"]: r for r in L.permutation_importance(model, iso, df.drop("_y"), "y", ["a", "b", "c"]).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert got["a"]["importancia"] == pytest.approx(0.5, abs=0.05) and 0 < got["a"]["desvio"] < 0.05
    assert all(got[f]["importancia"] == 0 and got[f]["desvio"] == 0 for f in "bc")
