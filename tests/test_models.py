"""Models on small frames."""

import math

import pytest
from pyspark.ml.linalg import Vectors

from quillframe.operators.udf import config_sweep
from quillframe.plans import models


@pytest.fixture
def flowers(spark):
    rows = [(float(i % 7) + (3.0 if i % 2 else 0.0), float(i % 5), "red" if i % 2 else "blue") for i in range(60)]
    return spark.createDataFrame(rows, "length double, width double, kind string")


def test_formula_order_and_names(flowers):
    _, frame = models.formula_features(flowers, "length ~ width + kind")
    assert models.feature_names(frame) == ["width", "kind_blue"]
    _, free = models.formula_features(flowers, "~ length + width")
    assert "label" not in free.columns and models.feature_names(free) == ["length", "width"]


def test_glm_summary(flowers):
    fitted = models.glm(flowers, "length ~ width + kind")
    assert set(fitted.measures("estimate")) == {"width", "kind_blue", "(Intercept)"} == set(fitted.measures("std_error"))
    s = fitted.measures("statistic")
    assert s["null_degrees_of_freedom"] == 59 and s["residual_degrees_of_freedom"] == 57
    residuals = [r[0] for r in models.deviance_residuals(fitted).collect()]
    assert len(residuals) == 60 and sum(x * x for x in residuals) == pytest.approx(s["residual_deviance"])
    assert "std_error" not in {r.measure for r in models.glm(flowers, "length ~ width", reg=0.3).summary.collect()}


def test_glm_families(flowers):
    binomial = models.glm(flowers, "kind ~ length + width", family="binomial")
    classes = models.label_values(binomial.core.summary.predictions)
    rows = binomial.predict(flowers).collect()
    assert all(r.predicted_label == classes[r.prediction >= 0.5] for r in rows)
    assert sum(r.predicted_label == r.kind for r in rows) > 40
    assert models.glm(flowers, "length ~ width", family="gaussian", link="identity").measures("statistic")["iterations"] >= 1


def test_save_keeps_summary(spark, flowers, tmp_path):
    fitted = models.logit(flowers, "kind ~ length + width", reg=0.1)
    fitted.save(f"{tmp_path}/m")
    loaded = models.Fitted.load(spark, f"{tmp_path}/m")
    assert loaded.measures("estimate") == fitted.measures("estimate")
    assert [r.predicted_label for r in loaded.predict(flowers).collect()] == [r.predicted_label for r in fitted.predict(flowers).collect()]


@pytest.mark.parametrize("fit", [models.gbt, models.random_forest])
def test_trees(flowers, fit):
    classes = fit(flowers, "kind ~ length + width", "classification")
    assert {r.predicted_label for r in classes.predict(flowers).collect()} == {"red", "blue"}
    assert set(classes.measures("importance")) == {"length", "width"}
    numbers = fit(flowers, "length ~ width + kind")
    assert all(0 <= r.prediction <= 9 for r in numbers.predict(flowers).collect())
    again = fit(flowers, "length ~ width + kind")
    assert numbers.measures("importance") == again.measures("importance")


def test_mlp(flowers):
    fitted = models.mlp(flowers, "kind ~ length + width", [2, 4, 2], iterations=20)
    assert fitted.measures("layer") == {"0": 2, "1": 4, "2": 2}


def test_naive_bayes_prior(spark):
    rows = [("1st", "Male", "Yes"), ("1st", "Female", "Yes"), ("2nd", "Male", "No"), ("2nd", "Male", "No"), ("2nd", "Female", "No")]
    df = spark.createDataFrame(rows, "cls string, sex string, survived string")
    fitted = models.naive_bayes(df, "survived ~ cls + sex")
    assert fitted.measures("log_prior") == pytest.approx({"No": math.log(4 / 7), "Yes": math.log(3 / 7)})
    assert fitted.measures("log_probability")["No: cls_2nd"] == pytest.approx(math.log(4 / 5))


def test_isotonic_pools(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 4.0), (4.0, 6.0)], "x double, y double")
    up = {r.x: r.prediction for r in models.isotonic(df, "y", "x").predict(df).collect()}
    assert up == {1.0: 1.0, 2.0: 2.5, 3.0: 2.5, 4.0: 5.0}
    down = models.isotonic(df, "y", "x", increasing=False).predict(df).collect()
    assert {round(r.prediction, 6) for r in down} == {3.2}


def test_survreg(spark):
    df = spark.createDataFrame([(float(t), float(s), float(r)) for t, s, r in [(40 + 37 * i + (i * i) % 11, i % 4 != 3, 1 + i % 2) for i in range(12)]], "days double, seen double, dose double")
    fitted = models.survreg(df, "days", "seen", "dose")
    assert set(fitted.measures("estimate")) == {"dose", "(Intercept)"} and fitted.measures("statistic")["scale"] > 0


def test_clusters(spark):
    df = spark.createDataFrame([(float(x + 10 * c), float(c)) for c in range(3) for x in range(4)], "x double, y double")
    fitted = models.kmeans(df, "~ x + y", 3)
    assert sorted(fitted.measures("size").values()) == [4, 4, 4]
    assert fitted.measures("statistic")["cost"] == pytest.approx(15.0)
    assert models.fitted_clusters(fitted).count() == 12


def test_mixture(spark):
    rows = [(10.0 * (i % 2) + math.sin(7 * i), math.cos(5 * i)) for i in range(80)]
    mixture = models.gaussian_mixture(spark.createDataFrame(rows, "x double, y double"), "~ x + y", 2)
    weight, mean = mixture.measures("weight"), mixture.measures("mean")
    middle = sum(x for x, _ in rows) / len(rows)
    assert sum(weight[c] * mean[f"{c}: 0"] for c in weight) == pytest.approx(middle)
    assert sum(mixture.measures("weight").values()) == pytest.approx(1)


def test_als_and_unknown_user(spark):
    data = [(u, i, float(1 + (u + 1) * (i + 2) % 5)) for u in range(4) for i in range(u % 2, 5, 2)]
    df = spark.createDataFrame(data, "buyer int, part int, grade double")
    fitted = models.als(df, "buyer", "part", "grade", iterations=10, reg=0.01)
    assert all(abs(r.prediction - r.grade) < 0.5 for r in fitted.predict(df).collect())
    new = spark.createDataFrame([(9, 0, 1.0)], df.schema)
    assert math.isnan(fitted.predict(new).first().prediction)


def test_lda_on_vectors(spark):
    df = spark.createDataFrame([(Vectors.dense([3.0, 0.0]),), (Vectors.dense([0.0, 4.0]),)], ["features"])
    fitted = models.lda(df, "features", k=2, iterations=5)
    assert fitted.measures("statistic")["counted_words"] == 7
    assert fitted.predict(df).count() == 2


def test_ks(spark):
    # A published sample whose statistic is known.
    df = spark.createDataFrame([(x,) for x in (0.1, 0.15, 0.2, 0.3, 0.25, -1.0, -0.5)], "test double")
    found = models.ks_test(df, "test").first()
    assert found.statistic == pytest.approx(0.38209, abs=1e-5) and found.p_value == pytest.approx(0.19849, abs=1e-5)


def test_sweep(spark):
    from pyspark.ml.clustering import KMeans

    df = spark.createDataFrame([(Vectors.dense([float(i)]),) for i in range(20)], ["features"])
    found = config_sweep(df, KMeans(), [{"k": 2, "seed": 1}, {"k": 4, "seed": 1}], lambda m: m.summary.trainingCost, "k int, seed int")
    by_k = {r.k: r.measure for r in found.collect()}
    assert by_k[4] < by_k[2]
    # Values go by their names, whatever the order of a configuration.
    turned = config_sweep(df, KMeans(), [{"seed": 9, "k": 3}], lambda m: m.summary.trainingCost, "k int, seed int").first()
    assert (turned.k, turned.seed) == (3, 9)
    for wrong in ({"k": 3}, {"k": 3, "seed": 1, "maxIter": 2}):
        with pytest.raises(ValueError):
            config_sweep(df, KMeans(), [wrong], lambda m: 0.0, "k int, seed int")


def test_partitions_of_a_fit_grow_with_the_rows(spark):
    from quillframe.operators.partitions import spread

    rows = spark.range(0, 40_000, 1, 20)
    assert spread(rows).rdd.getNumPartitions() == 20
    dealt = spread(rows, 1000)
    sizes = dealt.rdd.glom().map(len).collect()
    assert len(sizes) == 40 and max(sizes) <= 1100 and sum(sizes) == 40_000
    assert spread(rows, 5000).rdd.getNumPartitions() == 20
    # A few large row groups: however many parts the files are cut into, the rows are dealt out.
    assert spread(spark.range(0, 40_000, 1, 1), 1000).rdd.getNumPartitions() == 40
