"""Statistical models, one function per model, with formula input.

Each fit returns a ``Fitted``: the model, its summary as a table and the
prediction. Saving keeps the summary beside the model, because Spark's own
model files leave it out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans
from pyspark.ml.feature import IndexToString, RFormula, SQLTransformer
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import (
    AFTSurvivalRegression,
    GBTRegressor,
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
    IsotonicRegression,
    RandomForestRegressor,
)
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import vector_total

SUMMARY = "measure string, term string, value double"


@dataclass
class Fitted:
    """A fitted model; ``summary`` has rows (measure, term, value)."""

    model: PipelineModel
    summary: DataFrame

    @property
    def core(self) -> Model:
        """The model itself, without formula and label steps."""
        return next(s for s in reversed(self.model.stages) if not isinstance(s, (IndexToString, SQLTransformer)))

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def measures(self, measure: str) -> dict[str, float]:
        return {r.term: r.value for r in self.summary.where(F.col("measure") == measure).collect()}

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.summary.coalesce(1).write.mode("overwrite").parquet(f"{path}/summary")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        return Fitted(PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/summary"))


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the entries of a feature vector, in vector order."""
    attributes = df.schema[column].metadata.get("ml_attr", {})
    named = [a for group in attributes.get("attrs", {}).values() for a in group]
    if named:
        return [a.get("name", str(a["idx"])) for a in sorted(named, key=lambda a: a["idx"])]
    return [str(i) for i in range(attributes.get("num_attrs", 0))]


def label_values(df: DataFrame, column: str = "label") -> list[str]:
    return df.schema[column].metadata.get("ml_attr", {}).get("vals", [])


def formula_features(df: DataFrame, formula: str, *, index_label: bool = False):
    """Fit a formula such as ``y ~ a + b`` or ``~ a + b``; texts become 0/1 columns.

    Returns the fitted formula and the frame with ``features`` and ``label``.
    """
    model = RFormula(formula=formula, featuresCol="features", labelCol="label", forceIndexLabel=index_label).fit(df)
    return model, model.transform(df)


def _fit(
    df: DataFrame,
    formula: str,
    estimator: Estimator,
    summarise: Callable[[Model, DataFrame], dict[str, dict[str, float]]],
    *,
    classes: bool = False,
    also: Sequence[str] = (),
    one_pass: bool = False,
) -> Fitted:
    """Formula, then model, then (for classes) the class name of each prediction.

    Only the columns the fit needs are kept while it passes over the data.
    ``summarise`` gets the model and the training frame.
    """
    shaped, frame = formula_features(df, formula, index_label=classes)
    columns = [c for c in ("features", "label") if c in frame.columns]
    training = frame.select(*columns, *also)
    if not one_pass:
        training = training.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        core = estimator.fit(training)
        stages = [shaped, core]
        if classes and label_values(training):
            index = "prediction"
            if isinstance(core, GeneralizedLinearRegressionModel):
                # Its prediction is the probability of class 1.
                index = "predicted_index"
                stages.append(SQLTransformer(statement=f"SELECT *, round(prediction) AS {index} FROM __THIS__"))
            named = IndexToString(inputCol=index, outputCol="predicted_label")
            stages.append(named.setLabels(label_values(training)))
        return Fitted(PipelineModel(stages), _table(df, **summarise(core, training)))
    finally:
        if not one_pass:
            training.unpersist()


def _table(df: DataFrame, **measures: dict[str, float]) -> DataFrame:
    rows = [(m, t, float(v)) for m, values in measures.items() for t, v in values.items()]
    return df.sparkSession.createDataFrame(rows, SUMMARY)


def _named(names: Sequence[str], values) -> dict[str, float]:
    return dict(zip(names, map(float, values)))


def glm(
    df: DataFrame,
    formula: str,
    *,
    family: str = "gaussian",
    link: str | None = None,
    iterations: int = 25,
    reg: float = 0.0,
    tol: float = 1e-6,
) -> Fitted:
    """Generalised linear model with the full summary. Standard errors, t and p
    values exist only without regularisation."""
    estimator = GeneralizedLinearRegression(family=family, maxIter=iterations, regParam=reg, tol=tol)
    if link:
        estimator.setLink(link)

    def summarise(core, training):
        names, s = [*feature_names(training), "(Intercept)"], core.summary
        measures = {
            "estimate": _named(names, [*core.coefficients, core.intercept]),
            "statistic": {
                "dispersion": s.dispersion,
                "null_deviance": s.nullDeviance,
                "residual_deviance": s.deviance,
                "null_degrees_of_freedom": s.residualDegreeOfFreedomNull,
                "residual_degrees_of_freedom": s.residualDegreeOfFreedom,
                "aic": s.aic,
                "iterations": s.numIterations,
            },
        }
        if reg == 0.0:
            measures["std_error"] = _named(names, s.coefficientStandardErrors)
            measures["t_value"] = _named(names, s.tValues)
            measures["p_value"] = _named(names, s.pValues)
        return measures

    text_label = dict(df.dtypes).get(formula.split("~")[0].strip()) == "string"
    return _fit(df, formula, estimator, summarise, classes=text_label)


def deviance_residuals(fitted: Fitted) -> DataFrame:
    """One deviance residual per row of a model just fitted (not of a loaded one)."""
    return fitted.core.summary.residuals("deviance")


def logit(
    df: DataFrame,
    formula: str,
    *,
    iterations: int = 100,
    reg: float = 0.0,
    elastic_net: float = 0.0,
    tol: float = 1e-6,
    family: str = "auto",
) -> Fitted:
    """Logistic regression with two or more classes."""
    estimator = LogisticRegression(
        maxIter=iterations, regParam=reg, elasticNetParam=elastic_net, tol=tol, family=family
    )

    def summarise(core, training):
        names, s = [*feature_names(training), "(Intercept)"], core.summary
        if core.numClasses == 2:
            estimates = _named(names, [*core.coefficients, core.intercept])
        else:
            estimates = {
                f"{c}: {n}": v
                for c, row, intercept in zip(
                    label_values(training), core.coefficientMatrix.toArray(), core.interceptVector
                )
                for n, v in zip(names, [*row, intercept])
            }
        return {
            "estimate": estimates,
            "statistic": {"accuracy": s.accuracy, "iterations": s.totalIterations},
        }

    return _fit(df, formula, estimator, summarise, classes=True)


def _trees(core, training) -> dict[str, dict[str, float]]:
    return {
        "importance": _named(feature_names(training), core.featureImportances.toArray()),
        "statistic": {"features": core.numFeatures, "trees": core.getNumTrees},
        "tree_weight": {str(i): w for i, w in enumerate(core.treeWeights)},
    }


def gbt(
    df: DataFrame,
    formula: str,
    kind: str = "regression",
    *,
    iterations: int = 20,
    depth: int = 5,
    step: float = 0.1,
    bins: int = 32,
    seed: int = 42,
) -> Fitted:
    """Gradient-boosted trees; ``kind`` is ``regression`` or ``classification``."""
    cls = {"regression": GBTRegressor, "classification": GBTClassifier}[kind]
    estimator = cls(maxIter=iterations, maxDepth=depth, stepSize=step, maxBins=bins, seed=seed)
    return _fit(df, formula, estimator, _trees, classes=kind == "classification")


def random_forest(
    df: DataFrame,
    formula: str,
    kind: str = "regression",
    *,
    trees: int = 20,
    depth: int = 5,
    bins: int = 32,
    bootstrap: bool = True,
    features: str = "auto",
    seed: int = 42,
) -> Fitted:
    """Random forest; ``kind`` is ``regression`` or ``classification``, ``features`` how many are tried per split."""
    cls = {"regression": RandomForestRegressor, "classification": RandomForestClassifier}[kind]
    estimator = cls(
        numTrees=trees, maxDepth=depth, maxBins=bins, bootstrap=bootstrap, featureSubsetStrategy=features, seed=seed
    )
    return _fit(df, formula, estimator, _trees, classes=kind == "classification")


def mlp(
    df: DataFrame, formula: str, layers: Sequence[int], *, iterations: int = 100, block: int = 128, seed: int = 1234
) -> Fitted:
    """Multilayer perceptron; the first layer has one node per feature, the last one per class."""
    estimator = MultilayerPerceptronClassifier(
        layers=list(layers), maxIter=iterations, blockSize=block, seed=seed
    )

    def summarise(core, training):
        return {
            "layer": {str(i): n for i, n in enumerate(core.getLayers())},
            "statistic": {"weights": core.weights.size, "accuracy": core.summary().accuracy},
        }

    return _fit(df, formula, estimator, summarise, classes=True)


def naive_bayes(df: DataFrame, formula: str, *, smoothing: float = 1.0) -> Fitted:
    """Bernoulli naive Bayes. The summary has the log of the prior of each class
    and of the probability of each 0/1 feature within it."""

    def summarise(core, training):
        names, classes = feature_names(training), label_values(training)
        inside = {f"{c}: {n}": v for c, row in zip(classes, core.theta.toArray()) for n, v in zip(names, row)}
        return {"log_prior": _named(classes, core.pi), "log_probability": inside}

    estimator = NaiveBayes(modelType="bernoulli", smoothing=smoothing)
    return _fit(df, formula, estimator, summarise, classes=True, one_pass=True)


def isotonic(df: DataFrame, label: str, feature: str, *, increasing: bool = True) -> Fitted:
    """Isotonic (or, not increasing, antitonic) regression on one feature.

    Rows with the same feature value are merged into their mean with their
    number as weight. This gives the same fit, and what is sorted and pooled
    is one row per feature value. Spark's pooling ends on the driver, so the
    feature values of the pooled pieces must fit there.
    """
    merged = df.groupBy(F.col(feature).cast("double").alias("features")).agg(
        F.avg(label).alias("label"), F.count(F.lit(1)).cast("double").alias("weight")
    )
    core = IsotonicRegression(isotonic=increasing, weightCol="weight").fit(merged).setFeaturesCol(feature)
    # The boundaries stay in the saved model: there may be one per feature value.
    return Fitted(PipelineModel([core]), _table(df, statistic={"boundaries": core.boundaries.size}))


def survreg(
    df: DataFrame, time: str, event: str, terms: str, *, iterations: int = 100, tol: float = 1e-6
) -> Fitted:
    """Accelerated failure time (Weibull) regression, ``Surv(time, event) ~ terms``.

    ``event`` is 1 where the event was seen and 0 where the row is censored.
    Times must be positive.
    """
    estimator = AFTSurvivalRegression(censorCol=event, maxIter=iterations, tol=tol)

    def summarise(core, training):
        names = [*feature_names(training), "(Intercept)"]
        return {
            "estimate": _named(names, [*core.coefficients, core.intercept]),
            "statistic": {"scale": core.scale},
        }

    return _fit(df, f"{time} ~ {terms}", estimator, summarise, also=[event])


def kmeans(
    df: DataFrame,
    formula: str,
    k: int,
    *,
    iterations: int = 20,
    init: str = "k-means||",
    tol: float = 1e-4,
    seed: int = 42,
) -> Fitted:
    """k-means with centres, sizes and cost in the summary."""
    estimator = KMeans(k=k, maxIter=iterations, initMode=init, tol=tol, seed=seed)

    def summarise(core, training):
        names, s = feature_names(training), core.summary
        return {
            "center": {f"{i}: {n}": v for i, c in enumerate(core.clusterCenters()) for n, v in zip(names, c)},
            "size": {str(i): n for i, n in enumerate(s.clusterSizes)},
            "statistic": {"cost": s.trainingCost, "iterations": s.numIter},
        }

    return _fit(df, formula, estimator, summarise)


def fitted_clusters(fitted: Fitted) -> DataFrame:
    """Training rows with their cluster (of a model just fitted)."""
    return fitted.core.summary.predictions


def gaussian_mixture(
    df: DataFrame, formula: str, k: int, *, iterations: int = 100, tol: float = 0.01, seed: int = 42
) -> Fitted:
    """Gaussian mixture with weights, means and covariances in the summary."""
    estimator = GaussianMixture(k=k, maxIter=iterations, tol=tol, seed=seed)

    def summarise(core, training):
        means, covariances = {}, {}
        for i, g in enumerate(core.gaussians):
            means |= {f"{i}: {j}": v for j, v in enumerate(g.mean)}
            covariances |= {
                f"{i}: {a},{b}": v for a, row in enumerate(g.cov.toArray()) for b, v in enumerate(row)
            }
        return {
            "weight": {str(i): w for i, w in enumerate(core.weights)},
            "mean": means,
            "covariance": covariances,
            "statistic": {"log_likelihood": core.summary.logLikelihood},
        }

    return _fit(df, formula, estimator, summarise)


def als(
    df: DataFrame,
    user: str,
    item: str,
    rating: str,
    *,
    rank: int = 10,
    iterations: int = 10,
    reg: float = 0.1,
    user_blocks: int = 10,
    item_blocks: int = 10,
    seed: int = 42,
) -> Fitted:
    """Alternating least squares. Unknown users and items are predicted as NaN.

    The blocks are the tasks of a fit: raise them with the users and items.
    The frame is read several times: give it as a stored table.
    """
    estimator = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        seed=seed,
        coldStartStrategy="nan",
    )
    core = estimator.fit(df)
    sizes = {"rank": core.rank, "users": core.userFactors.count(), "items": core.itemFactors.count()}
    return Fitted(PipelineModel([core]), _table(df, statistic=sizes))


def lda(
    df: DataFrame,
    features: str,
    *,
    k: int = 10,
    iterations: int = 20,
    optimizer: str = "online",
    subsampling: float = 1.0,
    seed: int = 42,
) -> Fitted:
    """Topics of vectors of counts that are already features, e.g. of a libsvm
    file. ``predict`` gives the topic distribution of each row."""
    estimator = LDA(featuresCol=features, k=k, maxIter=iterations, optimizer=optimizer, subsamplingRate=subsampling, seed=seed)
    training = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        core = estimator.fit(training)
        counted = training.agg(F.sum(vector_total(features))).first()[0]
        likelihood = core.logLikelihood(training)
    finally:
        training.unpersist()
    measures = {
        "log_likelihood": likelihood,
        "log_perplexity": -likelihood / counted,
        "vocabulary": core.vocabSize(),
        "counted_words": counted,
    }
    concentration = {str(i): v for i, v in enumerate(core.estimatedDocConcentration())}
    return Fitted(PipelineModel([core]), _table(df, statistic=measures, doc_concentration=concentration))


def ks_test(df: DataFrame, column: str, mean: float = 0.0, sd: float = 1.0) -> DataFrame:
    """Two-sided one-sample test of a column against a normal distribution."""
    found = KolmogorovSmirnovTest.test(df, column, "norm", mean, sd)
    return found.select(F.col("statistic"), F.col("pValue").alias("p_value"))
