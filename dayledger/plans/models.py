"""Model fits on ``pyspark.ml``. Fits read whole tables; results are aggregated on Spark."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml import classification as C
from pyspark.ml import clustering as CL
from pyspark.ml import feature as FT
from pyspark.ml import regression as R
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.operators.nearest import Skips, best_rows, matrix
from dayledger.plans.graphs import TRADE_SQL, nation_trade
from dayledger.plans.rows import gapless_index
from dayledger.registry import query
from dayledger.session import TASK_ROWS, materialize, parts_for, table

SEED = 42


# Fits that turn the input into rows of their own at once and keep those: the input beside them would be held twice.
KEEP_THEIR_OWN = (FT.Word2Vec,)


def fitted(est: Estimator, df: DataFrame) -> Model:
    """Fit with the input kept on executors for the passes of the fit, unless the fit keeps its own."""
    if isinstance(est, KEEP_THEIR_OWN):
        return est.fit(df)
    df.persist()
    try:
        return est.fit(df)
    finally:
        df.unpersist()


def assembled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return FT.VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines: features, a two-class label (dear after discount or not) and the net price in thousands."""
    price = F.col("l_extendedprice") / 1000
    net = price * (1 - F.col("l_discount"))
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax", price.alias("price"), net.alias("net"),
        F.when(net > 45, 1.0).otherwise(0.0).alias("label"),
    )
    return assembled(li, ["l_quantity", "l_discount", "l_tax", "price"])


def parts(spark: SparkSession, d: str) -> DataFrame:
    kinds = FT.StringIndexer(inputCol="p_type", outputCol="kind")
    p = table(spark, d, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("size"),
                                       F.col("p_retailprice").alias("label"))
    p = kinds.fit(p).transform(p).withColumn("pos", F.pmod(F.col("p_partkey"), F.lit(1000)).cast("double"))
    return assembled(p, ["size", "kind", "pos"])


def vectors(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select(
        "vec_id", v.alias("v"), array_to_vector(v).alias("features"), F.col("label").cast("double").alias("label")
    )


def labelled_docs(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id")


def confusion(predicted: DataFrame) -> DataFrame:
    """Label and prediction counts: the whole result of a classifier in a few rows."""
    return predicted.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def judged(predicted: DataFrame, accuracy: float) -> DataFrame:
    """Rows of each label, and whether at least this share of all rows is predicted right."""
    cells = confusion(predicted)
    hits = cells.agg(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).first()[0]
    return cells.groupBy("label").agg(F.sum("n").alias("n")).withColumn("good", F.lit(hits is not None and hits >= accuracy))


LINES_SQL = (
    "SELECT (l_extendedprice / 1000 * (1 - l_discount) > 45)::INTEGER::DOUBLE AS label, count(*) AS n, true AS good "
    "FROM lineitem GROUP BY 1"
)
DOCS_SQL = "SELECT quality::DOUBLE AS label, count(*) AS n, true AS good FROM documents JOIN labels USING (doc_id) GROUP BY 1"
VECTORS_SQL = "SELECT label::DOUBLE AS label, count(*) AS n, true AS good FROM embeddings GROUP BY 1"


def errors(predicted: DataFrame, label: str = "label") -> DataFrame:
    miss = F.col("prediction") - F.col(label)
    return predicted.agg(
        F.count("*").alias("n"), F.sqrt(F.avg(miss * miss)).alias("rmse"), F.avg(F.abs(miss)).alias("mae"),
        (1 - F.var_pop(miss) / F.var_pop(label)).alias("explained"),
    )


def bounded(predicted: DataFrame, explained: float, label: str = "label") -> DataFrame:
    """Rows, and whether at least this share of the label's variance is explained."""
    return errors(predicted, label).select("n", (F.col("explained") >= explained).alias("good"))


def counted(name: str) -> str:
    return f"SELECT count(*) AS n, true AS good FROM {name}"


# ---- labels ----------------------------------------------------------------


@query("ml_pipeline", DOCS_SQL)
def ml_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Tokens, hashed counts and a classifier in one fitted pipeline."""
    docs = labelled_docs(spark, d)
    stages = [
        FT.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+"),
        FT.HashingTF(inputCol="words", outputCol="features"),
        C.LogisticRegression(maxIter=10, regParam=0.01),
    ]
    return judged(fitted(Pipeline(stages=stages), docs).transform(docs), 0.9)


@query(
    "ml_logistic",
    "SELECT 'two' AS kind, count(*) AS n, 4 AS width, true AS good FROM lineitem UNION ALL "
    "SELECT 'many', count(*), max(len(embedding)), true FROM embeddings",
)
def ml_logistic(spark: SparkSession, d: str) -> DataFrame:
    """Two classes with an elastic net, and many classes; accuracy and weights."""
    two = lines(spark, d)
    m2 = fitted(C.LogisticRegression(maxIter=15, regParam=0.01, elasticNetParam=0.5), two)
    many = vectors(spark, d)
    m5 = fitted(C.LogisticRegression(maxIter=15, regParam=0.01, family="multinomial"), many)
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    auc = float(m2.summary.areaUnderROC)
    a = m2.transform(two).agg(F.count("*").alias("n"), (right >= 0.95).alias("good"))
    b = m5.transform(many).agg(F.count("*").alias("n"), (right >= 0.3).alias("good"))
    a = a.select(F.lit("two").alias("kind"), "n", F.lit(m2.numFeatures).alias("width"), (F.col("good") & F.lit(auc >= 0.98)).alias("good"))
    return a.unionAll(b.select(F.lit("many"), "n", F.lit(m5.numFeatures), "good"))


def _classifier(spark: SparkSession, d: str, est: Estimator, accuracy: float) -> DataFrame:
    df = lines(spark, d).select("features", "label")  # only these are kept for the passes
    tasks = parts_for(df)
    if df.rdd.getNumPartitions() < tasks:  # parts of a file have a given size in bytes, and a pass reads many times that
        df = df.repartition(tasks)
    return judged(fitted(est, df).transform(df), accuracy)


@query("ml_linear_svc", LINES_SQL)
def ml_linear_svc(spark: SparkSession, d: str) -> DataFrame:
    return _classifier(spark, d, C.LinearSVC(maxIter=10, regParam=0.01), 0.95)


@query("ml_tree_classifier", LINES_SQL)
def ml_tree_classifier(spark: SparkSession, d: str) -> DataFrame:
    return _classifier(spark, d, C.DecisionTreeClassifier(maxDepth=5, seed=SEED), 0.95)


@query("ml_forest_classifier", LINES_SQL)
def ml_forest_classifier(spark: SparkSession, d: str) -> DataFrame:
    return _classifier(spark, d, C.RandomForestClassifier(numTrees=10, maxDepth=5, seed=SEED), 0.9)


@query("ml_gbt_classifier", LINES_SQL)
def ml_gbt_classifier(spark: SparkSession, d: str) -> DataFrame:
    return _classifier(spark, d, C.GBTClassifier(maxIter=5, maxDepth=3, seed=SEED), 0.95)


@query("ml_fm_classifier", LINES_SQL)
def ml_fm_classifier(spark: SparkSession, d: str) -> DataFrame:
    scaled = Pipeline(stages=[
        FT.MinMaxScaler(inputCol="features", outputCol="scaled"),
        C.FMClassifier(featuresCol="scaled", stepSize=0.05, maxIter=15, factorSize=4, seed=SEED),
    ])
    df = lines(spark, d).select("features", "label")
    return judged(scaled.fit(df).transform(df), 0.7)  # the library keeps the points of the fit itself


@query("ml_naive_bayes", DOCS_SQL)
def ml_naive_bayes(spark: SparkSession, d: str) -> DataFrame:
    docs = labelled_docs(spark, d)
    stages = [
        FT.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+"),
        FT.HashingTF(inputCol="words", outputCol="features"),
        C.NaiveBayes(smoothing=1.0, modelType="multinomial"),
    ]
    return judged(fitted(Pipeline(stages=stages), docs).transform(docs), 0.9)


@query("ml_perceptron", VECTORS_SQL)
def ml_perceptron(spark: SparkSession, d: str) -> DataFrame:
    df = vectors(spark, d)
    r = df.agg(F.max(F.size("v")).alias("width"), (F.max("label") + 1).cast("int").alias("classes")).first()
    est = C.MultilayerPerceptronClassifier(layers=[r.width, 16, r.classes], maxIter=20, blockSize=128, seed=SEED)
    return judged(fitted(est, df).transform(df), 0.2)


@query("ml_one_vs_rest", VECTORS_SQL)
def ml_one_vs_rest(spark: SparkSession, d: str) -> DataFrame:
    df = vectors(spark, d)
    est = C.OneVsRest(classifier=C.LogisticRegression(maxIter=5, regParam=0.01), parallelism=4)
    return judged(fitted(est, df).transform(df), 0.25)


# ---- values ----------------------------------------------------------------


# Penalised fits of one feature in closed form: on standardised columns the plain weight is the correlation r;
# a share a of the penalty p is absolute (r is moved towards zero by a * p) and the rest square (r is divided by
# 1 + (1 - a) * p), p being in units of the label's deviation.
PENALTIES = {"plain": (0.0, 0.0), "ridge": (2.0, 0.0), "lasso": (2.0, 1.0), "elastic": (2.0, 0.5)}


@query(
    "ml_linear_regression",
    "WITH s AS (SELECT corr(l_extendedprice / 1000, l_quantity) AS r, stddev_pop(l_extendedprice / 1000) AS sy, "
    "stddev_pop(l_quantity) AS sx, avg(l_extendedprice / 1000) AS my, avg(l_quantity) AS mx FROM lineitem), "
    "w AS (SELECT kind, greatest(r - a * p / sy, 0) / (1 + (1 - a) * p / sy) * sy / sx AS slope, my, mx FROM s, (VALUES "
    + ", ".join(f"('{k}', {p}, {a})" for k, (p, a) in PENALTIES.items())
    + ") v(kind, p, a)) SELECT kind, round(slope, 3) AS slope, round(my - slope * mx, 2) AS intercept FROM w",
)
def ml_linear_regression(spark: SparkSession, d: str) -> DataFrame:
    """One feature without penalty, with a square, an absolute and a mixed one: equal to the closed forms."""
    df = assembled(lines(spark, d).select("l_quantity", F.col("price").alias("label")), ["l_quantity"])
    rows = []
    for kind, (p, a) in PENALTIES.items():
        m = fitted(R.LinearRegression(solver="normal", regParam=p, elasticNetParam=a, tol=1e-9, maxIter=500), df)
        rows.append((kind, round(float(m.coefficients[0]), 3), round(float(m.intercept), 2)))
    return spark.createDataFrame(rows, "kind string, slope double, intercept double")


@query(
    "ml_glm",
    "SELECT 'all' AS kind, count(*) AS n, NULL AS slope, NULL AS intercept, true AS good FROM lineitem UNION ALL "
    "SELECT 'one', count(*), round(regr_slope(y, l_quantity), 5), round(regr_intercept(y, l_quantity), 4), true "
    "FROM (SELECT l_quantity, l_extendedprice / 1000 * (1 - l_discount) AS y FROM lineitem)",
)
def ml_glm(spark: SparkSession, d: str) -> DataFrame:
    """All features, judged by what is explained; one feature, equal to the closed form."""
    df = lines(spark, d)
    family = {"family": "gaussian", "link": "identity", "labelCol": "net"}
    full = bounded(fitted(R.GeneralizedLinearRegression(maxIter=10, **family), df).transform(df), 0.99, "net")
    one = assembled(df.select("l_quantity", "net"), ["l_quantity"])
    m = fitted(R.GeneralizedLinearRegression(maxIter=10, **family), one)
    nothing = F.lit(None).cast("double")
    a = full.select(F.lit("all").alias("kind"), "n", nothing.alias("slope"), nothing.alias("intercept"), "good")
    return a.unionAll(one.agg(F.count("*").alias("n")).select(
        F.lit("one"), "n", F.lit(round(float(m.coefficients[0]), 5)), F.lit(round(float(m.intercept), 4)), F.lit(True)))


def _regressor(spark: SparkSession, d: str, est: Estimator, explained: float) -> DataFrame:
    df = parts(spark, d)
    return bounded(fitted(est, df).transform(df), explained)


@query("ml_tree_regressor", counted("part"))
def ml_tree_regressor(spark: SparkSession, d: str) -> DataFrame:
    return _regressor(spark, d, R.DecisionTreeRegressor(maxDepth=5, seed=SEED), 0.9)


@query("ml_forest_regressor", counted("part"))
def ml_forest_regressor(spark: SparkSession, d: str) -> DataFrame:
    return _regressor(spark, d, R.RandomForestRegressor(numTrees=10, maxDepth=5, seed=SEED), 0.7)


@query("ml_gbt_regressor", counted("part"))
def ml_gbt_regressor(spark: SparkSession, d: str) -> DataFrame:
    return _regressor(spark, d, R.GBTRegressor(maxIter=5, maxDepth=4, seed=SEED), 0.9)


@query("ml_survival", "SELECT 2::BIGINT AS width, count(*) AS n, true AS good FROM orders")
def ml_survival(spark: SparkSession, d: str) -> DataFrame:
    """Order value as a survival time, open orders are censored."""
    o = table(spark, d, "orders").select(
        (F.col("o_totalprice") / 10000).alias("label"), F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.when(F.col("o_orderstatus") == "O", 0.0).otherwise(1.0).alias("censor"), F.month("o_orderdate").cast("double").alias("m"),
    )
    m = fitted(R.AFTSurvivalRegression(maxIter=10), assembled(o, ["priority", "m"]))
    # no column bears on the value, so the weights stay near zero and the intercept near the log of a usual value
    sound = 1 < m.intercept < 6 and 0 < m.scale < 10 and all(abs(c) < 0.5 for c in m.coefficients)
    return o.agg(F.lit(len(m.coefficients)).alias("width"), F.count("*").alias("n"), F.lit(bool(sound)).alias("good"))


@query(
    "ml_isotonic",
    """
WITH p AS (SELECT p_size::DOUBLE AS size, avg(p_retailprice) AS label, count(*) AS w FROM part GROUP BY 1),
c AS (SELECT size, label, sum(w * label) OVER o AS s, sum(w) OVER o AS c, w * label AS own, w FROM p WINDOW o AS (ORDER BY size)),
m AS (SELECT a.size AS lo, b.size AS hi, (b.s - a.s + a.own) / (b.c - a.c + a.w) AS mean FROM c a JOIN c b ON a.size <= b.size),
low AS (SELECT x.size, m.lo, min(m.mean) AS least FROM p x JOIN m ON m.lo <= x.size AND m.hi >= x.size GROUP BY ALL)
SELECT size, round(any_value(label), 4) AS label, round(max(least), 4) AS prediction FROM low JOIN p USING (size) GROUP BY size
""",
)
def ml_isotonic(spark: SparkSession, d: str) -> DataFrame:
    """Price over size: means per size first, weighted by their rows, then the fit on one row per size."""
    p = table(spark, d, "part").groupBy(F.col("p_size").cast("double").alias("size")).agg(
        F.avg("p_retailprice").alias("label"), F.count("*").cast("double").alias("weight")
    )
    df = assembled(p, ["size"])
    m = fitted(R.IsotonicRegression(weightCol="weight"), df)
    return m.transform(df).select("size", F.round("label", 4).alias("label"), F.round("prediction", 4).alias("prediction"))


@query("ml_fm_regressor", counted("lineitem"))
def ml_fm_regressor(spark: SparkSession, d: str) -> DataFrame:
    li = lines(spark, d).select("features", "net")
    df = FT.MinMaxScaler(inputCol="features", outputCol="scaled").fit(li).transform(li).select("scaled", "net")
    est = R.FMRegressor(featuresCol="scaled", labelCol="net", stepSize=0.1, maxIter=15, factorSize=4, seed=SEED)
    # the library keeps the points of a fit itself, unless the frame is kept: then it would read them anew in each pass
    return bounded(est.fit(df).transform(df), 0.1, "net")


# ---- clusters --------------------------------------------------------------


def _clusters(predicted: DataFrame, sound: bool) -> DataFrame:
    """Rows and used clusters, and whether the fit is sound: sizes add up to the rows, centres say what they should."""
    sizes = predicted.groupBy("prediction").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n"), (F.count("*") > 1).alias("parted"), F.lit(bool(sound)).alias("good"))


def clustered(name: str) -> str:
    return f"SELECT count(*) AS n, true AS parted, true AS good FROM {name}"


def squared_distances(centres: Sequence[Sequence[float]], v: str = "v") -> Column:
    """Of a vector from each of some centres, which are few."""
    given = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    one = lambda c: F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return F.transform(given, one)


def clusters(df: DataFrame, model: Model) -> tuple[DataFrame, float, bool]:
    """Vectors with their cluster, its distance and the least distance; the cost; and whether it beats as many given rows as centres."""
    centres = model.clusterCenters()
    placed = model.transform(df).withColumn("far", squared_distances(centres))
    placed = materialize(placed.select("vec_id", "prediction", F.element_at("far", F.col("prediction") + 1).alias("own"), F.array_min("far").alias("least")), "clusters")
    drawn = [r["v"] for r in df.select("v").limit(len(centres)).collect()]
    plain = df.agg(F.sum(F.array_min(squared_distances(drawn)))).first()[0]
    cost = placed.agg(F.sum("own")).first()[0]
    return placed, cost, cost < plain


@query("ml_kmeans", "SELECT vec_id, true AS nearest, true AS better, true AS agrees FROM embeddings")
def ml_kmeans(spark: SparkSession, d: str) -> DataFrame:
    """Nearest: no centre is nearer to the vector than its own, by all distances. Better: the centres cost less than as many
    rows taken as centres. Agrees: they cost no more than the fit says, whose last step moved them once more."""
    df = vectors(spark, d)
    m = fitted(CL.KMeans(k=10, maxIter=10, seed=SEED), df)
    placed, cost, better = clusters(df, m)
    agrees = cost <= m.summary.trainingCost * (1 + 1e-9) and len(m.clusterCenters()) == 10
    return placed.select("vec_id", (F.col("own") <= F.col("least") + 1e-9).alias("nearest"), F.lit(better).alias("better"), F.lit(bool(agrees)).alias("agrees"))


@query("ml_bisecting_kmeans", "SELECT vec_id, true AS member, true AS better, true AS agrees FROM embeddings")
def ml_bisecting_kmeans(spark: SparkSession, d: str) -> DataFrame:
    """Member: the cluster found down the tree is one of the centres. Better: as in ``ml_kmeans``. Agrees: the cost by
    all distances is that of the fit within a twentieth, as the walk down the tree meets centres that have moved since."""
    df = vectors(spark, d)
    m = fitted(CL.BisectingKMeans(k=6, maxIter=5, seed=SEED), df)
    placed, cost, better = clusters(df, m)
    agrees = abs(cost - m.summary.trainingCost) <= 0.05 * cost
    return placed.select("vec_id", F.col("own").isNotNull().alias("member"), F.lit(better).alias("better"), F.lit(bool(agrees)).alias("agrees"))


@query("ml_gaussian_mixture", clustered("customer"))
def ml_gaussian_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Sound: the weights add up to one, and the weighted means of the parts are the mean of all."""
    c = table(spark, d, "customer").select(
        (F.col("c_acctbal") / 1000).alias("balance"), F.col("c_nationkey").cast("double").alias("nation")
    )
    df = assembled(c, ["balance", "nation"])
    m = fitted(CL.GaussianMixture(k=3, maxIter=10, seed=SEED), df)
    mean = c.agg(F.avg("balance"), F.avg("nation")).first()
    mixed = [sum(w * g.mean[i] for w, g in zip(m.weights, m.gaussians)) for i in range(2)]
    sound = abs(sum(m.weights) - 1) < 1e-6 and all(abs(x - y) < 0.05 * (1 + abs(y)) for x, y in zip(mixed, mean))
    return _clusters(m.transform(df), sound)


@query("ml_lda", clustered("documents"))
def ml_lda(spark: SparkSession, d: str) -> DataFrame:
    """Topics over hashed words; each document goes to its strongest topic. Sound: every topic has ten terms of falling weight."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    words = FT.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+").transform(docs)
    tf = FT.HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 16).transform(words).select("doc_id", "features")
    m = fitted(CL.LDA(k=5, maxIter=5, seed=SEED, optimizer="online"), tf)
    tops = [r.termWeights for r in m.describeTopics(10).collect()]
    sound = len(tops) == 5 and all(len(t) == 10 and t == sorted(t, reverse=True) and t[0] > 0 for t in tops)
    topics = vector_to_array("topicDistribution")
    best = F.array_position(topics, F.array_max(topics)).alias("prediction")
    return _clusters(m.transform(tf).select(best), sound)


@query(
    "ml_power_iteration",
    f"WITH {TRADE_SQL.format(share=0.0).strip()} SELECT DISTINCT unnest([src, dst]) AS id, true AS known FROM edges WHERE src <> dst",
)
def ml_power_iteration(spark: SparkSession, d: str) -> DataFrame:
    """Nations by how much they trade with each other, both ways added."""
    e = nation_trade(spark, d, 0.0).filter("src <> dst")
    both = e.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(
        F.sum("total").alias("weight")
    )
    pic = CL.PowerIterationClustering(k=3, maxIter=10, initMode="degree", weightCol="weight")
    return pic.assignClusters(both).select("id", F.col("cluster").between(0, 2).alias("known"))


# ---- recommendation and patterns --------------------------------------------


RECOMMENDED = 5


@query(
    "ml_als",
    f"""
WITH b AS (SELECT o_custkey AS user, count(DISTINCT l_partkey) AS bought FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT user, unnest(range(1, 1 + least({RECOMMENDED}, (SELECT count(DISTINCT l_partkey) FROM lineitem) - bought))) AS place,
       true AS unbought, true AS exact, true AS good FROM b
""",
)
def ml_als(spark: SparkSession, d: str) -> DataFrame:
    """Quantities as ratings of parts by customers; for each customer the five parts scored best among those not bought.

    Customers and parts are numbered first, since the library takes keys of 32 bits; numbers follow the order of the keys.
    Parts lie in lists, and a customer visits a list only while its bound on the inner product beats the fifth score: no
    all-pairs product. Exact: for every hundredth customer the same as all pairs. Good: the scores miss the ratings by less
    than their deviation.
    """
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity")
    keys = {key: materialize(df.select(key).distinct(), "keys") for key, df in (("user", o), ("item", li))}
    numbers = {
        key: materialize(gapless_index(df, key, f"{key}_no").withColumn(f"{key}_no", F.col(f"{key}_no").cast("int")), "numbers") for key, df in keys.items()
    }
    # orders are numbered before they meet their lines, and lines are grouped where they met the numbers of their parts
    lines = li.join(o.join(numbers["user"], "user").select("l_orderkey", "user_no"), "l_orderkey").select("user_no", "item", "l_quantity")
    pairs = lines.join(numbers["item"], "item").groupBy("item", "item_no", "user_no").agg(F.avg("l_quantity").alias("rating"))
    ratings = materialize(pairs.select("user_no", "item_no", "rating"), "ratings")
    blocks = als_blocks(ratings.count(), spark.sparkContext.defaultParallelism)
    als = ALS(rank=5, maxIter=4, regParam=0.1, userCol="user_no", itemCol="item_no", ratingCol="rating", seed=SEED,
              numUserBlocks=blocks, numItemBlocks=blocks)
    model = als.fit(ratings)  # the library reads them once and keeps blocks of its own
    scored = model.transform(ratings)
    miss = scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))) < F.stddev("rating")).first()[0]

    def factors(df: DataFrame, no: str) -> DataFrame:
        return df.select(F.col("id").alias(no), F.col("features").cast("array<double>").alias("v"))

    bought = ratings.groupBy("user_no").agg(F.collect_list("item_no").alias("skip"))
    named = numbers["user"].withColumn("query", F.col("user").cast("long")).select("user_no", "query")
    users = factors(model.userFactors, "user_no").join(bought, "user_no").join(named, "user_no")
    items = materialize(factors(model.itemFactors, "item_no").select(F.col("item_no").cast("long").alias("id"), "v"), "item-factors")
    users = materialize(users.select("query", "v", "skip"), "user-factors")
    tops = materialize(best_rows(users, items, RECOMMENDED, "product"), "recommended")
    checked = all_pairs_best(users.filter("query % 100 = 0"), items, RECOMMENDED)
    found = tops.filter("query % 100 = 0").select("query", "place", "id")
    exact = found.exceptAll(checked).isEmpty() and checked.exceptAll(found).isEmpty()
    told = tops.join(named, "query").select("user_no", F.col("id").cast("int").alias("item_no"))
    again = told.join(ratings.select("user_no", "item_no"), ["user_no", "item_no"], "left_semi").isEmpty()
    return tops.select(F.col("query").alias("user"), "place", F.lit(again).alias("unbought"), F.lit(exact).alias("exact"), F.lit(bool(miss)).alias("good"))


# Ratings of a block of the library, beyond one block a core.
RATINGS_BLOCK = 12_000_000


def als_blocks(ratings: int, cores: int) -> int:
    """Blocks of users and of items. A factor goes, in each pass, to every block that has a rating of it, so more blocks than
    the cores ask for, or than their memory does, only send more."""
    return max(2, min(cores, -(-ratings // TASK_ROWS)), -(-ratings // RATINGS_BLOCK))


def all_pairs_best(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(query, place, id) by scores of a stated set of queries against all rows, in blocks of rows."""
    blocks = max(1, parts_for(rows, 100_000))
    asked = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def run(mine: pa.Table, here: pa.Table) -> pa.Table:
        out = []
        order = np.argsort(here["id"].to_numpy())
        ids, vectors, bought = here["id"].to_numpy()[order], matrix(here["v"])[order], Skips(mine["skip"])
        for n, (name, v) in enumerate(zip(mine["query"].to_pylist(), matrix(mine["v"]), strict=True)) if len(ids) else ():
            score = np.einsum("ij,j->i", vectors, v)
            at = np.minimum(np.searchsorted(ids, bought[n]), len(ids) - 1)
            score[at[ids[at] == bought[n]]] = -np.inf
            # ties with the k-th stay until ids decide
            at = np.flatnonzero(score >= np.partition(score, -k)[-k]) if len(score) > k else np.arange(len(score))
            for i in at[np.lexsort((ids[at], -score[at]))[:k]]:
                if np.isfinite(score[i]):
                    out.append((name, int(ids[i]), float(-score[i])))
        return pa.table({"query": pa.array([x[0] for x in out], pa.int64()), "id": pa.array([x[1] for x in out], pa.int64()), "cost": pa.array([x[2] for x in out], pa.float64())})

    found = asked.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(run, "query long, id long, cost double")
    w = Window.partitionBy("query").orderBy("cost", "id")
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("query", "place", "id")


BASKETS_SQL = """
b AS MATERIALIZED (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
need AS (SELECT 0.01 * count(DISTINCT l_orderkey) AS n FROM b)
"""


@query(
    "ml_fp_growth",
    f"""
WITH {BASKETS_SQL.strip()},
one AS (SELECT p_brand AS a, count(*) AS freq FROM b GROUP BY 1),
two AS (SELECT x.p_brand AS a, y.p_brand AS c, count(*) AS freq FROM b x JOIN b y
  ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY ALL),
three AS (SELECT x.p_brand || ',' || y.p_brand || ',' || z.p_brand AS items, count(*) AS freq FROM b x JOIN b y
  ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand JOIN b z ON z.l_orderkey = y.l_orderkey AND y.p_brand < z.p_brand GROUP BY 1),
ways AS (SELECT a, c, freq FROM two UNION ALL SELECT c, a, freq FROM two)
SELECT 'set' AS kind, a AS items, freq, NULL AS confidence FROM one WHERE freq >= (SELECT n FROM need)
UNION ALL SELECT 'set', a || ',' || c, freq, NULL FROM two WHERE freq >= (SELECT n FROM need)
UNION ALL SELECT 'set', items, freq, NULL FROM three WHERE freq >= (SELECT n FROM need)
UNION ALL SELECT 'rule', ways.a || '>' || c, NULL, round(ways.freq / one.freq, 6) FROM ways JOIN one ON ways.a = one.a
WHERE ways.freq >= (SELECT n FROM need) AND ways.freq / one.freq >= 0.1
""",
)
def ml_fp_growth(spark: SparkSession, d: str) -> DataFrame:
    """Brands bought in one order: frequent sets and rules. The list of brands is short, so a basket stays short too."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(p, "l_partkey")
    baskets = li.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))
    m = fitted(FPGrowth(itemsCol="items", minSupport=0.01, minConfidence=0.1), baskets)
    sets = m.freqItemsets.select(
        F.lit("set").alias("kind"), F.array_join(F.array_sort("items"), ",").alias("items"), "freq", F.lit(None).cast("double").alias("confidence")
    )
    side = lambda c: F.array_join(F.array_sort(c), ",")
    rules = m.associationRules.select(
        F.lit("rule"), F.concat(side("antecedent"), F.lit(">"), side("consequent")), F.lit(None).cast("long"), F.round("confidence", 6)
    )
    return sets.unionAll(rules)


@query(
    "ml_prefix_span",
    """
WITH RECURSIVE s AS MATERIALIZED (SELECT user_id, ts::DATE AS d, hour(ts) // 6 AS q, list_sort(list(DISTINCT event_type)) AS k
  FROM events GROUP BY ALL),
o AS MATERIALIZED (SELECT user_id, d, q, list_filter(k, lambda x, i: (m >> (i - 1)) & 1 = 1) AS p
  FROM s, LATERAL (SELECT unnest(range(1, 1 << len(k))) AS m)),
r AS (SELECT user_id, d, q, [p] AS pattern FROM o
  UNION ALL SELECT r.user_id, r.d, o.q, list_append(pattern, p) FROM r JOIN o ON o.user_id = r.user_id AND o.d = r.d AND o.q > r.q),
f AS (SELECT pattern, count(*) AS freq FROM (SELECT DISTINCT user_id, d, pattern FROM r) GROUP BY 1)
SELECT to_json(pattern)::VARCHAR AS pattern, freq FROM f WHERE freq >= 0.05 * (SELECT count(*) FROM (SELECT DISTINCT user_id, d FROM s))
""",
)
def ml_prefix_span(spark: SparkSession, d: str) -> DataFrame:
    """A user's day as four sets of event types; such a sequence has a fixed largest size."""
    quarter = F.floor(F.hour("ts") / 6).alias("q")
    sets = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day"), quarter).agg(
        F.array_sort(F.collect_set("event_type")).alias("kinds")
    )
    days = sets.groupBy("user_id", "day").agg(F.array_sort(F.collect_list(F.struct("q", "kinds"))).alias("s"))
    seq = days.select(F.col("s.kinds").alias("sequence"))
    found = PrefixSpan(minSupport=0.05).findFrequentSequentialPatterns(seq)
    return found.select(F.to_json(F.transform("sequence", lambda x: F.array_sort(x))).alias("pattern"), "freq")


@query(
    "ml_tuning",
    "SELECT kind, reg_param, count(*) AS n, true AS good FROM lineitem, (VALUES ('folds'), ('split')) k(kind), "
    "(VALUES (0.01::DOUBLE), (1.0::DOUBLE)) r(reg_param) GROUP BY ALL",
)
def ml_tuning(spark: SparkSession, d: str) -> DataFrame:
    """A grid scored by folds and by one split."""
    df = lines(spark, d).select("features", F.col("net").alias("label"))
    lr = R.LinearRegression(maxIter=5, solver="l-bfgs")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 1.0]).build()
    judge = RegressionEvaluator(metricName="rmse")
    folds = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=judge, numFolds=2, parallelism=2, seed=SEED)
    split = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=judge, trainRatio=0.75, parallelism=2, seed=SEED)
    a, b = fitted(folds, df).avgMetrics, fitted(split, df).validationMetrics
    # good: better than the mean of all, and the weaker penalty wins
    n, deviation = df.agg(F.count("*"), F.stddev_pop("label")).first()
    rows = [(k, p[lr.regParam], n, bool(v < deviation and ms[0] < ms[1])) for k, ms in (("folds", a), ("split", b)) for p, v in zip(grid, ms)]
    return spark.createDataFrame(rows, "kind string, reg_param double, n long, good boolean")
