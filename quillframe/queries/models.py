"""Statistical models.

Closed-form fits are checked value by value. For the others the SQL gives what
a right fit must show, computed from the data: score equations (predicted
class totals equal class sizes), kept means, pooled averages and sizes.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions.arrays import array_total
from ..operators.partitions import spread
from ..operators.sweep import concurrent_sweep
from ..operators.udf import config_sweep
from ..plans import models, monotone
from ..session import fresh_path, stored
from .registry import query, table


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("embedding")
    )


#: Rows of a fit's partition: some 50 MB in the form a tree keeps them in.
_FIT_ROWS = 1 << 18


def _lines(spark, sf):
    return spread(table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", "l_discount", "l_tax"), _FIT_ROWS)


def _labelled(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return table(spark, sf, "labels").join(documents, "doc_id")


def _digits(column):
    """Six significant digits as text, so that tiny float differences do not count."""
    return F.format_string("%.5e", column)


def _class_totals(scored, labels, names):
    """Rows per class and the sum of the predicted probabilities of the class."""
    long = scored.select(F.posexplode_outer(vector_to_array("probability")).alias("i", "p"))
    sums = long.groupBy("i").agg(F.sum("p").alias("p"))
    classes = F.array(*[F.lit(n) for n in names])
    total = sums.select(F.element_at(classes, F.col("i") + 1).alias("class"), F.round("p", 2).alias("expected"))
    sizes = scored.groupBy(F.col(labels).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return total.join(sizes, "class")


@query(
    "formula_features",
    """
    WITH levels AS (
        SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) AS place, count(*) OVER () AS n FROM part GROUP BY p_type
    )
    SELECT p_partkey, p_retailprice AS label, concat('p_type_', levels.p_type) AS name,
           CASE WHEN part.p_type = levels.p_type THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
    FROM part, levels WHERE place < n
    UNION ALL SELECT p_partkey, p_retailprice, 'p_size', p_size::DOUBLE FROM part
    """,
)
def formula_features(spark, sf):
    _, frame = models.formula_features(table(spark, sf, "part"), "p_retailprice ~ p_type + p_size")
    names = F.array(*[F.lit(n) for n in models.feature_names(frame)])
    entries = frame.select("p_partkey", "label", F.posexplode_outer(vector_to_array("features")).alias("i", "value"))
    return entries.select("p_partkey", "label", F.element_at(names, F.col("i") + 1).alias("name"), "value")


_GAUSSIAN_SQL = """
WITH fit AS (
    SELECT count(*)::DOUBLE AS n, avg(l_quantity) AS mean_x, regr_slope(l_extendedprice, l_quantity) AS slope,
           regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_sxx(l_extendedprice, l_quantity) AS sxx,
           regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy
    FROM lineitem
), dev AS (SELECT *, syy - slope * sxy AS deviance FROM fit
), se AS (SELECT *, sqrt(deviance / (n - 2) / sxx) AS se_slope, sqrt(deviance / (n - 2) * (1 / n + mean_x * mean_x / sxx)) AS se_intercept FROM dev
), found(measure, term, value) AS (
    SELECT 'estimate', 'l_quantity', slope FROM se UNION ALL SELECT 'estimate', '(Intercept)', intercept FROM se
    UNION ALL SELECT 'std_error', 'l_quantity', se_slope FROM se UNION ALL SELECT 'std_error', '(Intercept)', se_intercept FROM se
    UNION ALL SELECT 't_value', 'l_quantity', slope / se_slope FROM se UNION ALL SELECT 't_value', '(Intercept)', intercept / se_intercept FROM se
    UNION ALL SELECT 'statistic', 'dispersion', deviance / (n - 2) FROM se
    UNION ALL SELECT 'statistic', 'null_deviance', syy FROM se UNION ALL SELECT 'statistic', 'residual_deviance', deviance FROM se
    UNION ALL SELECT 'statistic', 'null_degrees_of_freedom', n - 1 FROM se UNION ALL SELECT 'statistic', 'residual_degrees_of_freedom', n - 2 FROM se
    UNION ALL SELECT 'statistic', 'aic', n * (ln(2 * pi() * deviance / n) + 1) + 2 + 4 FROM se
)
"""


@query(
    "glm_gaussian",
    _GAUSSIAN_SQL
    + """
    SELECT measure, term, printf('%.5e', value) AS value FROM found
    UNION ALL SELECT 'residuals', 'sum_of_squares', printf('%.5e', deviance) FROM dev
    """,
)
def glm_gaussian(spark, sf):
    fitted = models.glm(_lines(spark, sf), "l_extendedprice ~ l_quantity")
    kept = fitted.summary.where("measure <> 'p_value' AND term <> 'iterations'")
    residuals = models.deviance_residuals(fitted).select(F.col("devianceResiduals").alias("r"))
    squares = residuals.agg(F.sum(F.col("r") * F.col("r")).alias("value"))
    named = squares.select(F.lit("residuals").alias("measure"), F.lit("sum_of_squares").alias("term"), "value")
    return kept.unionByName(named).select("measure", "term", _digits("value").alias("value"))


@query(
    "model_round_trip",
    _GAUSSIAN_SQL
    + """
    SELECT term, printf('%.5e', value) AS value, (SELECT count(*) FROM lineitem) AS n,
           (SELECT printf('%.5e', avg(l_extendedprice)) FROM lineitem) AS mean_prediction
    FROM found WHERE measure = 'estimate'
    """,
)
def model_round_trip(spark, sf):
    lines, path = table(spark, sf, "lineitem"), fresh_path(spark, "model")
    models.glm(lines, "l_extendedprice ~ l_quantity").save(path)
    loaded = models.Fitted.load(spark, path)
    scored = loaded.predict(lines).agg(F.count(F.lit(1)).alias("n"), _digits(F.avg("prediction")).alias("mean_prediction"))
    estimates = loaded.summary.where("measure = 'estimate'").select("term", _digits("value").alias("value"))
    n, mean = scored.first()
    return estimates.withColumn("n", F.lit(n).cast("bigint")).withColumn("mean_prediction", F.lit(mean))


@query(
    "glm_binomial",
    """
    WITH cells AS (
        SELECT toxic, count(*)::DOUBLE AS n, sum(quality)::DOUBLE AS good FROM labels GROUP BY toxic
    ), whole AS (
        SELECT sum(good) AS good, sum(n) AS n, -2 * sum(good * ln(good / n) + (n - good) * ln(1 - good / n)) AS residual FROM cells
    ), odds AS (
        SELECT max(CASE WHEN toxic = 0 THEN ln(good / (n - good)) END) AS off, max(CASE WHEN toxic = 1 THEN ln(good / (n - good)) END) AS on_ FROM cells
    )
    SELECT 'toxic' AS term, round(on_ - off, 4) AS value FROM odds UNION ALL SELECT '(Intercept)', round(off, 4) FROM odds
    UNION ALL SELECT 'residual_deviance', round(residual, 4) FROM whole
    UNION ALL SELECT 'null_deviance', round(-2 * (good * ln(good / n) + (n - good) * ln(1 - good / n)), 4) FROM whole
    """,
)
def glm_binomial(spark, sf):
    named = table(spark, sf, "labels").select("toxic", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("rating"))
    # A text label is coded 0, 1, ... from the most frequent value on.
    fitted = models.glm(named, "rating ~ toxic", family="binomial", tol=1e-10)
    coded = models.label_values(fitted.core.summary.predictions)
    sign = 1.0 if coded[1] == "good" else -1.0
    signed = F.when(F.col("measure") == "estimate", F.col("value") * sign).otherwise(F.col("value"))
    kept = fitted.summary.where("measure = 'estimate' OR term IN ('residual_deviance', 'null_deviance')")
    return kept.select("term", F.round(signed, 4).alias("value"))


@query(
    "logit_binomial",
    """
    SELECT CAST(quality AS VARCHAR) AS class, count(*)::DOUBLE AS expected, count(*) AS n
    FROM labels JOIN documents USING (doc_id) GROUP BY quality
    """,
)
def logit_binomial(spark, sf):
    rows = _labelled(spark, sf)
    fitted = models.logit(rows, "quality ~ n_chars + lang", reg=0.01, elastic_net=0.8, tol=1e-9, iterations=200)
    return _class_totals(fitted.predict(rows), "quality", fitted.model.stages[-1].getLabels())


@query(
    "logit_multinomial",
    "SELECT CAST(label AS VARCHAR) AS class, count(*)::DOUBLE AS expected, count(*) AS n FROM embeddings GROUP BY label",
)
def logit_multinomial(spark, sf):
    rows = _embeddings(spark, sf).withColumnRenamed("label", "digit")
    fitted = models.logit(rows, "digit ~ embedding", reg=0.01, tol=1e-8, iterations=200)
    return _class_totals(fitted.predict(rows), "digit", fitted.model.stages[-1].getLabels())


@query(
    "gbt_classify",
    """
    SELECT CAST(quality AS VARCHAR) AS quality, count(*) AS n, count(*) AS n_scored, max(count(*)) OVER () AS largest, TRUE AS as_good
    FROM labels JOIN documents USING (doc_id) GROUP BY quality
    """,
)
def gbt_classify(spark, sf):
    rows = _labelled(spark, sf)
    scored = models.gbt(rows, "quality ~ n_chars + lang", "classification", iterations=5, depth=3).predict(rows)
    good = F.col("predicted_label").isin("0", "1") & vector_to_array("probability")[0].between(0, 1)
    label = F.col("quality").cast("string")
    found = scored.groupBy(label.alias("quality")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(good).alias("n_scored"), F.count_if(F.col("predicted_label") == label).alias("right")
    )
    found = stored(found, "classes")
    largest, total = found.agg(F.max("n"), F.sum("right")).first()
    return found.select("quality", "n", "n_scored", F.lit(largest).alias("largest"), F.lit(total >= largest).alias("as_good"))


@query("gbt_regress", "SELECT count(*) AS n, printf('%.5e', avg(l_extendedprice)) AS mean_prediction FROM lineitem")
def gbt_regress(spark, sf):
    # Boosting on squared error leaves the mean of the label in the predictions.
    lines = _lines(spark, sf)
    fitted = models.gbt(lines, "l_extendedprice ~ l_quantity + l_discount + l_tax", iterations=5, depth=3)
    return fitted.predict(lines).agg(F.count(F.lit(1)).alias("n"), _digits(F.avg("prediction")).alias("mean_prediction"))


@query(
    "forest_classify",
    """SELECT count(*) AS n, count(*)::DOUBLE AS total, CAST(count(DISTINCT label) AS INTEGER) AS n_classes,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)) AS largest, TRUE AS as_good FROM embeddings""",
)
def forest_classify(spark, sf):
    rows = _embeddings(spark, sf).withColumnRenamed("label", "digit")
    scored = models.random_forest(rows, "digit ~ embedding", "classification", trees=10).predict(rows)
    p = vector_to_array("probability")
    total = F.sum(F.aggregate(p, F.lit(0.0), lambda a, x: a + x))
    largest = rows.groupBy("digit").count().agg(F.max("count")).first()[0]
    right = F.count_if(F.col("predicted_label") == F.col("digit").cast("string"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.round(total, 4).alias("total"), F.max(F.size(p)).alias("n_classes"),
        F.lit(largest).cast("bigint").alias("largest"), (right >= largest).alias("as_good"),
    )


_STUMP_SQL = """
WITH v AS (SELECT l_quantity AS q, count(*) AS n, sum(l_extendedprice) AS s FROM lineitem GROUP BY l_quantity
), c AS (SELECT q, sum(n) OVER (ORDER BY q) AS nl, sum(s) OVER (ORDER BY q) AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM v
), best AS (SELECT * FROM c WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
SELECT printf('%.5e', sl / nl) AS leaf, CAST(nl AS BIGINT) AS n FROM best
UNION ALL SELECT printf('%.5e', (s - sl) / (n - nl)), CAST(n - nl AS BIGINT) FROM best
"""


def _leaves(scored):
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).select(_digits(F.col("prediction")).alias("leaf"), "n")


@query("gbt_stump", _STUMP_SQL)
def gbt_stump(spark, sf):
    # One tree of one split: its leaves are the split with the least sum of squares.
    lines = _lines(spark, sf)
    return _leaves(models.gbt(lines, "l_extendedprice ~ l_quantity", iterations=1, depth=1, bins=256).predict(lines))


@query("forest_stump", _STUMP_SQL)
def forest_stump(spark, sf):
    lines = _lines(spark, sf)
    fitted = models.random_forest(lines, "l_extendedprice ~ l_quantity", trees=1, depth=1, bins=256, bootstrap=False, features="all")
    return _leaves(fitted.predict(lines))


@query("forest_regress", "SELECT count(*) AS n, count(*) AS n_inside FROM lineitem")
def forest_regress(spark, sf):
    # A mean of leaf means stays between the smallest and the largest label.
    lines = _lines(spark, sf)
    low, high = lines.agg(F.min("l_extendedprice"), F.max("l_extendedprice")).first()
    fitted = models.random_forest(lines, "l_extendedprice ~ l_quantity + l_discount + l_tax", trees=10)
    inside = F.col("prediction").between(low, high)
    return fitted.predict(lines).agg(F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("n_inside"))


@query(
    "mlp_classify",
    """SELECT count(*) AS n, count(*)::DOUBLE AS total, CAST(count(DISTINCT label) AS INTEGER) AS n_classes,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)) AS largest, TRUE AS as_good FROM embeddings""",
)
def mlp_classify(spark, sf):
    rows = _embeddings(spark, sf).withColumnRenamed("label", "digit")
    classes = rows.select("digit").distinct().count()
    scored = models.mlp(rows, "digit ~ embedding", [64, 16, classes], iterations=30).predict(rows)
    p = vector_to_array("probability")
    total = F.sum(F.aggregate(p, F.lit(0.0), lambda a, x: a + x))
    largest = rows.groupBy("digit").count().agg(F.max("count")).first()[0]
    right = F.count_if(F.col("predicted_label") == F.col("digit").cast("string"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.round(total, 4).alias("total"), F.max(F.size(p)).alias("n_classes"),
        F.lit(largest).cast("bigint").alias("largest"), (right >= largest).alias("as_good"),
    )


@query(
    "mlp_separable",
    """SELECT CASE WHEN l_quantity <= 10 THEN 'few' WHEN l_quantity <= 35 THEN 'some' ELSE 'many' END AS amount, count(*) AS n, count(*) AS n_right
       FROM lineitem GROUP BY 1""",
)
def mlp_separable(spark, sf):
    # Classes that one column tells apart: the network has to get every row right.
    amount = F.when(F.col("l_quantity") <= 10, "few").when(F.col("l_quantity") <= 35, "some").otherwise("many")
    lines = spread(table(spark, sf, "lineitem").select("l_quantity"), _FIT_ROWS)
    rows = lines.select(amount.alias("amount"), ((F.col("l_quantity") - 25) / 10).cast("double").alias("scaled"))
    scored = models.mlp(rows, "amount ~ scaled", [1, 6, 3], iterations=400).predict(rows)
    right = F.count_if(F.col("predicted_label") == F.col("amount"))
    return scored.groupBy("amount").agg(F.count(F.lit(1)).alias("n"), right.alias("n_right"))


@query(
    "naive_bayes",
    """
    WITH rows AS (
        SELECT o_orderstatus AS status, o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
    ), long AS (
        SELECT status, 'o_orderpriority' AS feature, o_orderpriority AS level FROM rows
        UNION ALL SELECT status, 'c_mktsegment', c_mktsegment FROM rows
    ), levels AS (
        SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, level) AS place,
               count(*) OVER (PARTITION BY feature) AS n FROM long GROUP BY feature, level
    ), sizes AS (SELECT status, count(*) AS n FROM rows GROUP BY status
    ), cells AS (SELECT status, feature, level, count(*) AS n FROM long GROUP BY status, feature, level)
    SELECT 'log_prior' AS measure, status AS term,
           round(ln(n + 1) - ln((SELECT sum(n) FROM sizes) + (SELECT count(*) FROM sizes)), 6) AS value FROM sizes
    UNION ALL
    SELECT 'log_probability', concat(sizes.status, ': ', levels.feature, '_', levels.level),
           round(ln(coalesce(cells.n, 0) + 1) - ln(sizes.n + 2), 6)
    FROM sizes CROSS JOIN levels
    LEFT JOIN cells ON cells.status = sizes.status AND cells.feature = levels.feature AND cells.level = levels.level
    WHERE place < levels.n
    """,
)
def naive_bayes(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = table(spark, sf, "orders").join(customers, "o_custkey")
    fitted = models.naive_bayes(rows, "o_orderstatus ~ o_orderpriority + c_mktsegment")
    return fitted.summary.select("measure", "term", F.round("value", 6).alias("value"))


@query(
    "isotonic",
    """
    WITH points AS (
        SELECT l_quantity, avg(l_extendedprice) * count(*) AS y, count(*)::DOUBLE AS w, row_number() OVER (ORDER BY l_quantity) AS i
        FROM lineitem GROUP BY l_quantity
    ), sums AS (SELECT *, sum(y) OVER (ORDER BY i) AS cy, sum(w) OVER (ORDER BY i) AS cw FROM points
    ), blocks AS (
        SELECT s.i AS s, t.i AS t, (t.cy - s.cy + s.y) / (t.cw - s.cw + s.w) AS level FROM sums s JOIN sums t ON s.i <= t.i
    ), highest AS (
        SELECT p.i, b.s, max(b.level) AS level FROM points p JOIN blocks b ON b.s <= p.i AND b.t >= p.i GROUP BY p.i, b.s
    )
    SELECT l_quantity, round(min(level), 4) AS fitted FROM points JOIN highest USING (i) GROUP BY l_quantity
    """,
)
def isotonic(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    fitted = models.isotonic(lines, "l_extendedprice", "l_quantity", increasing=False)
    return fitted.predict(lines.select("l_quantity").distinct()).select("l_quantity", F.round("prediction", 4).alias("fitted"))


@query(
    "isotonic_ranges",
    """
    WITH points AS (
        SELECT date_diff('day', DATE '1970-01-01', o_orderdate) // 7 AS week, sum(o_totalprice)::DOUBLE AS y, count(*)::DOUBLE AS w,
            row_number() OVER (ORDER BY date_diff('day', DATE '1970-01-01', o_orderdate) // 7) AS i
        FROM orders GROUP BY 1
    ), sums AS MATERIALIZED (SELECT *, sum(y) OVER (ORDER BY i) AS cy, sum(w) OVER (ORDER BY i) AS cw FROM points
    ), blocks AS MATERIALIZED (
        SELECT s.i AS s, t.i AS t, (t.cy - s.cy + s.y) / (t.cw - s.cw + s.w) AS level FROM sums s JOIN sums t ON s.i <= t.i
    ), least AS (
        SELECT s, t, min(level) OVER (PARTITION BY s ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS level FROM blocks
    )
    SELECT week, round(max(level), 4) AS fitted FROM sums JOIN least ON i = t GROUP BY week
    """,
)
def isotonic_ranges(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    orders = table(spark, sf, "orders").select(F.floor(days / 7).alias("week"), "o_totalprice")
    fit = monotone.fit_monotone(orders, "o_totalprice", "week")
    return fit.fitted().select(F.col("feature").cast("bigint").alias("week"), F.round("fitted", 4).alias("fitted"))


@query(
    "survival_aft",
    """
    WITH rows AS (
        SELECT l_linestatus = 'F' AS seen FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE date_diff('day', o_orderdate, l_shipdate) > 0
    )
    SELECT count(*) AS n, count(*) FILTER (WHERE seen) AS events, round(count(*) FILTER (WHERE seen) / 10.0) * 10 AS expected FROM rows
    """,
)
def survival_aft(spark, sf):
    # At the best fit the summed hazards of all rows equal the number of events.
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = table(spark, sf, "lineitem").join(orders, "l_orderkey").select(
        F.date_diff("l_shipdate", "o_orderdate").cast("double").alias("days"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("seen"),
        "l_quantity",
        "l_discount",
    ).where("days > 0")
    fitted = models.survreg(rows, "days", "seen", "l_quantity + l_discount", tol=1e-9)
    scale = fitted.measures("statistic")["scale"]
    hazard = F.exp((F.log("days") - F.log("prediction")) / scale)
    return fitted.predict(rows).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("seen") == 1).alias("events"),
        (F.round(F.sum(hazard) / 10) * 10).alias("expected"),
    )


_SQUARES_SQL = """
    WITH long AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(64)) AS i FROM embeddings),
    means AS (SELECT i, avg(x) AS mean, sum(x * x) - count(*) * avg(x) * avg(x) AS squares FROM long GROUP BY i)
"""


@query(
    "kmeans",
    _SQUARES_SQL + "SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(squares), 3) AS squares, 3::BIGINT AS n_clusters FROM means",
)
def kmeans(spark, sf):
    # Cost around the centres plus the spread of the centres is the whole sum of squares.
    rows = _embeddings(spark, sf)
    fitted = models.kmeans(rows, "~ embedding", 3, iterations=200, tol=0.0)
    points = fitted.predict(rows)
    centers = fitted.core.clusterCenters()
    sizes = {int(k): v for k, v in fitted.measures("size").items()}
    n = sum(sizes.values())
    middle = sum(c * sizes[i] for i, c in enumerate(centers)) / n
    spread = sum(sizes[i] * float(((c - middle) ** 2).sum()) for i, c in enumerate(centers))
    whole = fitted.measures("statistic")["cost"] + spread
    return points.agg(
        F.count(F.lit(1)).alias("n"), F.lit(round(whole, 3)).alias("squares"), F.count_distinct("prediction").alias("n_clusters")
    )


@query(
    "lda_posterior",
    """
    SELECT vec_id, 1.0::DOUBLE AS total, 10 AS n_topics,
           (SELECT round(sum(len(list_filter(embedding, lambda x: x > 0))), 3) FROM embeddings)::DOUBLE AS counted_words
    FROM embeddings
    """,
)
def lda_posterior(spark, sf):
    # Counts per row: 1 where an embedding entry is positive.
    ones = F.transform("embedding", lambda x: F.when(x > 0, 1.0).otherwise(0.0))
    rows = table(spark, sf, "embeddings").select("vec_id", array_to_vector(ones).alias("counts"))
    fitted = models.lda(rows, "counts", k=10, iterations=10)
    counted = fitted.measures("statistic")["counted_words"]
    total = vector_to_array("topicDistribution")
    return fitted.predict(rows).select(
        "vec_id",
        F.round(array_total(total), 6).alias("total"),
        F.size(total).alias("n_topics"),
        F.lit(counted).alias("counted_words"),
    )


@query("gaussian_mixture", _SQUARES_SQL + "SELECT CAST(i AS INTEGER) AS dimension, round(mean, 6) AS mean FROM means")
def gaussian_mixture(spark, sf):
    # The weighted component means give back the mean of the data.
    fitted = models.gaussian_mixture(_embeddings(spark, sf), "~ embedding", 2, iterations=10)
    means = fitted.summary.where("measure = 'mean'").select(F.split("term", ": ").alias("t"), "value")
    weights = fitted.summary.where("measure = 'weight'").select(F.col("term").alias("component"), F.col("value").alias("weight"))
    long = means.select(F.col("t")[0].alias("component"), F.col("t")[1].cast("int").alias("dimension"), "value")
    return long.join(weights, "component").groupBy("dimension").agg(
        F.round(F.sum(F.col("value") * F.col("weight")), 6).alias("mean")
    )


@query(
    "als",
    """
    WITH ratings AS (
        SELECT o_custkey, l_partkey, sum(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    )
    SELECT count(*) AS n, count(*) AS n_scored, count(DISTINCT o_custkey) AS users, count(DISTINCT l_partkey) AS items,
           count(DISTINCT o_custkey) AS n_solved FROM ratings
    """,
)
def als(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    bought = table(spark, sf, "lineitem").join(orders, "l_orderkey").groupBy("o_custkey", "l_partkey")
    ratings = stored(bought.agg(F.sum("l_quantity").alias("quantity")), "ratings")
    fitted = models.als(ratings, "o_custkey", "l_partkey", "quantity", rank=5, iterations=3, reg=0.01)
    sizes = fitted.measures("statistic")
    # The users' vectors are solved last: for each, the errors times the items' vectors add up to the penalty.
    core = fitted.model.stages[-1]
    users = core.userFactors.select(F.col("id").alias("o_custkey"), F.col("features").alias("u"))
    items = core.itemFactors.select(F.col("id").alias("l_partkey"), F.col("features").alias("v"))
    # Users are joined last, so that a user's rows lie together when they are added up.
    both = ratings.join(items, "l_partkey").join(users, "o_custkey")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda t, x: t + x)
    # Factors are stored as floats, so the gap is measured against the size of what is added up.
    reach = F.aggregate(F.zip_with("u", "v", lambda a, b: F.abs(a.cast("double") * b)), F.lit(0.0), lambda t, x: t + x)
    terms = both.select("o_custkey", "u", "v", "quantity", (F.col("quantity") - dot).alias("error"), reach.alias("reach"))
    places = range(core.rank)
    pull = terms.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("error") * F.col("v")[k]).alias(f"pull{k}") for k in places],
        *[F.sum((F.abs("quantity") + F.col("reach")) * F.abs(F.col("v")[k])).alias(f"size{k}") for k in places],
        *[F.max(F.col("u")[k]).alias(f"own{k}") for k in places],
    )

    def gap(k):
        own = F.col(f"own{k}")
        return F.abs(F.col(f"pull{k}") - 0.01 * F.col("n") * own) / (F.col(f"size{k}") + 0.01 * F.col("n") * F.abs(own) + 1e-9)

    solved = pull.where(F.greatest(*[gap(k) for k in places]) < 1e-3).count()
    return fitted.predict(ratings).agg(
        F.lit(solved).cast("bigint").alias("n_solved"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.isnan("prediction")).alias("n_scored"),
        F.lit(int(sizes["users"])).cast("bigint").alias("users"),
        F.lit(int(sizes["items"])).cast("bigint").alias("items"),
    )


@query(
    "ks_test",
    """
    WITH points AS (
        SELECT (value - avg(value) OVER ()) / stddev_samp(value) OVER () / sqrt(2) AS z,
               row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events
    ), tail AS (SELECT z, i, n, 1 / (1 + 0.3275911 * abs(z)) AS t FROM points
    ), below AS (
        SELECT i, n, 0.5 * (1 + sign(z) * (1 - t * (0.254829592 + t * (-0.284496736 + t * (1.421413741
               + t * (-1.453152027 + t * 1.061405429)))) * exp(-z * z))) AS p FROM tail
    )
    SELECT round(max(greatest(i / n - p, p - (i - 1) / n)), 4) AS statistic FROM below
    """,
)
def ks_test(spark, sf):
    events = table(spark, sf, "events").select("value")
    mean, sd = events.agg(F.avg("value"), F.stddev("value")).first()
    return models.ks_test(events, "value", mean, sd).select(F.round("statistic", 4).alias("statistic"))


@query(
    "config_sweep",
    _SQUARES_SQL
    + """
    SELECT CAST(k AS INTEGER) AS k, start, CAST(seed AS INTEGER) AS seed, (SELECT sum(squares) FROM means) > 0 AS below, TRUE AS no_worse
    FROM (SELECT unnest([2, 3, 5]) AS k), (SELECT unnest(['random', 'k-means||']) AS start), (SELECT unnest([1, 2]) AS seed)
    """,
)
def config_sweep_query(spark, sf):
    points = _embeddings(spark, sf)
    configs = [{"k": k, "initMode": m, "seed": s} for k in (2, 3, 5) for m in ("random", "k-means||") for s in (1, 2)]
    costs = []

    def cost(model):
        """Squared distances to the nearest centre; a last step of the fit cannot have made them larger."""
        values = vector_to_array("embedding")
        squares = [
            F.aggregate(F.zip_with(values, F.lit(c.tolist()), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x)
            for c in model.clusterCenters()
        ]
        found = points.agg(F.sum(F.least(*squares))).first()[0]
        costs.append(found <= model.summary.trainingCost * (1 + 1e-6))
        return found

    found = config_sweep(
        points, KMeans(featuresCol="embedding", maxIter=10), configs, cost, "k int, start string, seed int", {"initMode": "start"}
    )
    spread = points.select(F.posexplode_outer(vector_to_array("embedding")).alias("i", "x")).groupBy("i").agg(
        (F.sum(F.col("x") * F.col("x")) - F.count("x") * F.avg("x") * F.avg("x")).alias("squares")
    )
    whole = spread.agg(F.sum("squares")).first()[0]
    return found.select("k", "start", "seed", (F.col("measure") < whole).alias("below"), F.lit(all(costs)).alias("no_worse"))


@query(
    "concurrent_sweep",
    """
    SELECT CAST(penalty AS DOUBLE) AS penalty, round(sum(l_quantity * l_extendedprice) / (sum(l_quantity * l_quantity) + count(*) * penalty / stddev_pop(l_extendedprice)), 6) AS slope, NULL::VARCHAR AS error
    FROM lineitem, (SELECT unnest([0, 1, 10, 100, 1000, 5000]) AS penalty) GROUP BY penalty
    """,
)
def concurrent_sweep_query(spark, sf):
    """Slopes through the origin of ridge regressions, which have a closed form; Spark counts the penalty in deviations of the label."""
    lines = table(spark, sf, "lineitem").select(array_to_vector(F.array(F.col("l_quantity").cast("double"))).alias("features"), F.col("l_extendedprice").cast("double").alias("label"))
    ridge = LinearRegression(fitIntercept=False, standardization=False, solver="normal", elasticNetParam=0.0)
    configs = [{"regParam": float(p)} for p in (0, 1, 10, 100, 1000, 5000)]
    found = concurrent_sweep(lines, ridge, configs, lambda m: float(m.coefficients[0]), "penalty double", {"regParam": "penalty"})
    return found.select("penalty", F.round("measure", 6).alias("slope"), "error")
