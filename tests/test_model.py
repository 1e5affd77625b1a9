import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from paysieve.operators import model as m
from paysieve.operators.gold import to_gold
from paysieve.operators.registry import load_model, registry, save_model

NAN = float("nan")


@pytest.fixture(scope="module")
def gold(payments):
    return to_gold(payments).cache()


@pytest.fixture(scope="module")
def labelled(gold):
    return m.with_label(gold)


@pytest.fixture(scope="module")
def model(labelled):
    return m.train(labelled)


def terms(model):
    return np.array([value for _, value in m.coefficients(model)])


def arrays(labelled):
    pdf = labelled.select("amount", "tx_count_window", "label").toPandas()
    x = pdf[["amount", "tx_count_window"]].to_numpy(float)
    return x, pdf["label"].to_numpy(float)


def test_label_is_the_flag(labelled):
    assert dict(labelled.dtypes)["label"] == "int"
    assert labelled.where(F.col("label") != F.col("is_fraud").cast("int")).isEmpty()


def test_features_are_scaled_without_centring(model, labelled):
    x, _ = arrays(labelled)
    scaled = model.transform(labelled).select("amount", "tx_count_window", vector_to_array("scaledFeatures").alias("s"))
    pdf = scaled.toPandas()
    expected = pdf[["amount", "tx_count_window"]].to_numpy(float) / x.std(axis=0, ddof=1)
    assert np.allclose(np.stack(pdf["s"]), expected)


def test_converged_fit_matches_newton(labelled):
    x, y = arrays(labelled)
    design = np.column_stack([x / x.std(axis=0, ddof=1), np.ones(len(x))])
    beta = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ beta))
        beta += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design, design.T @ (y - p))
    assert np.allclose(terms(m.train(labelled, max_iter=300, tol=1e-12)), beta, rtol=1e-6)


def test_ten_iterations_and_repeatable(labelled, model):
    assert model.stages[-1].getMaxIter() == 10
    assert np.allclose(terms(m.train(labelled.repartition(5))), terms(model), rtol=1e-8)


def test_save_and_load(spark, model, tmp_path):
    path = str(tmp_path / "model")
    assert save_model(model, path) == path
    assert np.array_equal(terms(load_model(spark, path)), terms(model))
    save_model(model, path)


def test_versions(spark, model, labelled, tmp_path):
    path = str(tmp_path / "models")
    other = m.train(labelled, max_iter=2)
    assert save_model(model, path, version=1).endswith("/v1")
    save_model(other, path, version=2)
    with pytest.raises(Exception, match="already exists"):
        save_model(model, path, version=2)
    assert np.array_equal(terms(load_model(spark, path, version="latest")), terms(other))
    assert np.array_equal(terms(load_model(spark, path, version=1)), terms(model))
    lines = {r["version"]: r for r in registry(spark, path).collect()}
    assert set(lines) == {1, 2}
    assert [*lines[2]["coefficients"], lines[2]["intercept"]] == list(terms(other))


def test_one_class_is_refused(labelled):
    with pytest.raises(m.SingleClassError):
        m.train(labelled.where("label = 0"))
    with pytest.raises(m.SingleClassError):
        m.train(labelled.limit(0))


def test_rows_with_missing_features_are_not_trained_on(labelled, model):
    extra = labelled.limit(3).withColumn("amount", F.lit(None).cast("double"))
    nan = labelled.limit(3).withColumn("amount", F.lit(NAN))
    assert np.allclose(terms(m.train(labelled.unionByName(extra).unionByName(nan))), terms(model), rtol=1e-8)


def test_scoring_keeps_every_row(spark, model, gold, tmp_path):
    odd = gold.limit(2).withColumn("amount", F.lit(None).cast("double")).withColumn("event_id", F.lit("odd"))
    nan = gold.limit(1).withColumn("amount", F.lit(NAN)).withColumn("event_id", F.lit("odd"))
    rows = gold.unionByName(odd).unionByName(nan)
    path = str(tmp_path / "model")
    save_model(model, path)
    scored = m.score(load_model(spark, path), rows)
    assert scored.columns == [
        *gold.columns,
        "features",
        "scaledFeatures",
        "rawPrediction",
        "probability",
        "prediction",
        "fraud_probability",
    ]
    assert scored.count() == gold.count() + 3
    unscored = scored.where("prediction IS NULL")
    assert unscored.count() == 3 and unscored.where("event_id <> 'odd' OR fraud_probability IS NOT NULL").isEmpty()
    wrong = scored.where("prediction <> CAST(fraud_probability > 0.5 AS DOUBLE)")
    assert wrong.isEmpty()


def test_scoring_matches_the_formula(model, gold):
    x, _ = arrays(m.with_label(gold))
    pdf = m.score(model, gold).select("amount", "tx_count_window", "fraud_probability").toPandas()
    beta = terms(model)
    z = pdf[["amount", "tx_count_window"]].to_numpy(float) / x.std(axis=0, ddof=1) @ beta[:2] + beta[2]
    assert np.allclose(pdf["fraud_probability"], 1 / (1 + np.exp(-z)))


def test_silver_can_be_scored(model, payments, gold):
    from_silver = m.serving_view(m.score(model, payments)).toPandas().sort_values("event_id", ignore_index=True)
    from_gold = m.serving_view(m.score(model, gold)).toPandas().sort_values("event_id", ignore_index=True)
    assert from_silver.equals(from_gold)
    assert list(from_gold.columns) == ["event_id", "user_id", "prediction"]


def test_labels_from_elsewhere(spark, gold):
    labels = spark.createDataFrame([("1", 1), ("1", 0), ("2", 0), ("absent", 1)], "event_id string, label int")
    got = m.with_label(gold, labels)
    assert {(r["event_id"], r["label"]) for r in got.collect()} == {("1", 1), ("2", 0)}


def test_split_and_evaluation(model, labelled):
    train, test = m.split(labelled, holdout=0.3)
    assert train.count() + test.count() == labelled.count()
    assert 0.2 < test.count() / labelled.count() < 0.4
    assert train.join(test, "event_id").isEmpty()
    measures = m.evaluate(model, test)
    assert 0.9 < measures["auc"] <= 1
    assert sum(measures[k] for k in ("tp", "fp", "tn", "fn")) == test.count()


def test_feature_table(labelled):
    assert m.feature_table(labelled).columns == ["event_id", "user_id", "amount", "tx_count_window", "label"]
