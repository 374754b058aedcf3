"""Feature transforms, statistics and measures."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import feature as FT
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    MultilabelClassificationEvaluator,
    RankingEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest, Correlation, KolmogorovSmirnovTest, Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.operators import matrix as M
from dayledger.operators.hot import SLICE, by_ranges
from dayledger.operators.likeness import among, distinct_sets, hashed_bands, hashed_like_sets, leader_links, like_sets, rarest_first
from dayledger.operators.nearest import best_rows, probed_nearest
from dayledger.plans.joins import WORDS_SQL, words
from dayledger.plans.models import SEED, assembled, fitted, lines, vectors
from dayledger.registry import query
from dayledger.session import BROADCAST_ROWS, TASK_ROWS, materialize, small_side, table


@query(
    "ml_feature_scale",
    """
WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, max(abs(l_extendedprice)) AS ma,
                  avg(l_extendedprice) AS mu, stddev_samp(l_extendedprice) AS sd FROM lineitem)
SELECT l_orderkey, l_partkey, round((l_quantity - lo) / (hi - lo), 8) AS min_max, round(l_extendedprice / ma, 8) AS max_abs,
       round((l_extendedprice - mu) / sd, 6) AS standard,
       round(l_quantity / sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice), 8) AS unit, true AS robust_known
FROM lineitem, s
""",
)
def ml_feature_scale(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    df = assembled(li, ["l_quantity", "l_extendedprice"])
    m = Pipeline(stages=[
        FT.MinMaxScaler(inputCol="features", outputCol="mm"), FT.MaxAbsScaler(inputCol="features", outputCol="ma"),
        FT.StandardScaler(inputCol="features", outputCol="st", withMean=True, withStd=True),
        FT.RobustScaler(inputCol="features", outputCol="ro"), FT.Normalizer(inputCol="features", outputCol="no", p=2.0),
    ])
    out = fitted(m, df).transform(df)

    def at(col: str, i: int):
        return vector_to_array(col)[i]

    return out.select(
        "l_orderkey", "l_partkey", F.round(at("mm", 0), 8).alias("min_max"), F.round(at("ma", 1), 8).alias("max_abs"),
        F.round(at("st", 1), 6).alias("standard"), F.round(at("no", 0), 8).alias("unit"),
        at("ro", 0).isNotNull().alias("robust_known"),
    )


@query(
    "ml_feature_bin",
    """
WITH q AS (SELECT quantile_disc(l_quantity, 0.25) AS a, quantile_disc(l_quantity, 0.5) AS b,
                  quantile_disc(l_quantity, 0.75) AS c FROM lineitem)
SELECT l_orderkey, l_partkey, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END::DOUBLE AS above,
       CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 30 THEN 1 ELSE 2 END::DOUBLE AS bucket,
       CASE WHEN l_quantity < a THEN 0 WHEN l_quantity < b THEN 1 WHEN l_quantity < c THEN 2 ELSE 3 END::DOUBLE AS quarter
FROM lineitem, q
""",
)
def ml_feature_bin(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    inf = float("inf")
    m = Pipeline(stages=[
        FT.Binarizer(inputCol="l_quantity", outputCol="above", threshold=25.0),
        FT.Bucketizer(inputCol="l_quantity", outputCol="bucket", splits=[-inf, 10.0, 30.0, inf]),
        FT.QuantileDiscretizer(inputCol="l_quantity", outputCol="quarter", numBuckets=4, relativeError=0.0001),
    ])
    return m.fit(li).transform(li).drop("l_quantity")


@query(
    "ml_feature_index",
    """
WITH i AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx FROM orders GROUP BY 1)
SELECT o_orderkey, idx::DOUBLE AS idx, o_orderpriority AS back,
       array_to_string(list_transform(range(0, 4), lambda k: CASE WHEN k = idx THEN '1.0' ELSE '0.0' END), ',') AS hot
FROM orders JOIN i USING (o_orderpriority)
""",
)
def ml_feature_index(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    index = FT.StringIndexer(inputCol="o_orderpriority", outputCol="idx", stringOrderType="frequencyDesc").fit(o)
    df = index.transform(o)
    df = FT.OneHotEncoder(inputCol="idx", outputCol="hot").fit(df).transform(df)
    df = FT.VectorIndexer(inputCol="hot", outputCol="hot_index", maxCategories=4).fit(df).transform(df)
    df = FT.IndexToString(inputCol="idx", outputCol="back", labels=index.labels).transform(df)
    return df.select("o_orderkey", "idx", "back", vector_to_array("hot").alias("hot"))


@query(
    "ml_feature_impute",
    """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b,
                  CASE WHEN c_nationkey <> 3 THEN c_nationkey::DOUBLE END AS n FROM customer),
m AS (SELECT n FROM c WHERE n IS NOT NULL GROUP BY n ORDER BY count(*) DESC, n LIMIT 1)
SELECT c_custkey, round(coalesce(b, (SELECT avg(b) FROM c)), 6) AS mean_filled,
       coalesce(n, (SELECT quantile_disc(n, 0.5) FROM c)) AS median_filled, coalesce(n, (SELECT n FROM m)) AS mode_filled FROM c
""",
)
def ml_feature_impute(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("b"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("double")).alias("n"),
    )
    m = Pipeline(stages=[
        FT.Imputer(inputCol="b", outputCol="mean_filled", strategy="mean"),
        FT.Imputer(inputCol="n", outputCol="median_filled", strategy="median", relativeError=0.0001),
        FT.Imputer(inputCol="n", outputCol="mode_filled", strategy="mode"),
    ])
    out = m.fit(c).transform(c)
    return out.select("c_custkey", F.round("mean_filled", 6).alias("mean_filled"), "median_filled", "mode_filled")


@query(
    "ml_feature_vector",
    """
SELECT l_orderkey, l_partkey, l_quantity AS sliced, round(l_quantity * l_discount, 6) AS crossed, 9::BIGINT AS poly_size,
       round(2 * l_quantity, 6) AS weighted, round((l_quantity + l_discount + l_tax) / sqrt(3), 6) AS dct0 FROM lineitem
""",
)
def ml_feature_vector(spark: SparkSession, d: str) -> DataFrame:
    """Assemble, size hint, slice, interact, expand, weight by element, cosine transform, vector to array."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax")
    stages = [
        FT.VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="v"),
        FT.VectorSizeHint(inputCol="v", size=3, handleInvalid="error"),
        FT.VectorSlicer(inputCol="v", outputCol="slice", indices=[0]),
        FT.Interaction(inputCols=["l_quantity", "l_discount"], outputCol="cross"),
        FT.PolynomialExpansion(inputCol="v", outputCol="poly", degree=2),
        FT.ElementwiseProduct(inputCol="v", outputCol="weighted", scalingVec=Vectors.dense([2.0, 1.0, 0.5])),
        FT.DCT(inputCol="v", outputCol="dct"),
    ]
    out = Pipeline(stages=stages).fit(li).transform(li)
    return out.select(
        "l_orderkey", "l_partkey", vector_to_array("slice")[0].alias("sliced"),
        F.round(vector_to_array("cross")[0], 6).alias("crossed"), F.size(vector_to_array("poly")).alias("poly_size"),
        F.round(vector_to_array("weighted")[0], 6).alias("weighted"), F.round(vector_to_array("dct")[0], 6).alias("dct0"),
    )


# Words left out of text features (fixed list).
STOP_WORDS = ["the", "of", "and", "in", "to", "la", "le", "el", "die", "der"]


@query(
    "ml_feature_text",
    f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \\n]+'), lambda w: w <> '') AS w FROM documents),
k AS (SELECT *, list_filter(w, lambda x: NOT list_contains({STOP_WORDS}, x)) AS kept FROM t)
SELECT doc_id, len(w) AS n_tokens, len(w) AS n_regex, len(kept) AS n_kept, greatest(len(kept) - 1, 0) AS n_bigrams,
       CASE WHEN len(kept) > 1 THEN kept[1] || ' ' || kept[2] END AS first_bigram FROM k
""",
)
def ml_feature_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[ \n]+", " ").alias("text"))
    stages = [
        FT.Tokenizer(inputCol="text", outputCol="plain"),
        FT.RegexTokenizer(inputCol="text", outputCol="words", pattern="[ \n]+"),
        FT.StopWordsRemover(inputCol="words", outputCol="kept", stopWords=STOP_WORDS, caseSensitive=True),
        FT.NGram(inputCol="kept", outputCol="bigrams", n=2),
    ]
    out = Pipeline(stages=stages).fit(docs).transform(docs)
    return out.select(
        "doc_id", F.size(F.filter("plain", lambda w: w != "")).alias("n_tokens"), F.size("words").alias("n_regex"),
        F.size("kept").alias("n_kept"), F.size("bigrams").alias("n_bigrams"), F.try_element_at("bigrams", F.lit(1)).alias("first_bigram"),
    )


@query(
    "ml_feature_tfidf",
    f"""
WITH w AS (SELECT * FROM ({WORDS_SQL.format(cols='doc_id,', table='documents')}) WHERE word <> ''),
tf AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL), df AS (SELECT word, count(*) AS df FROM tf GROUP BY 1)
SELECT doc_id, word, tf, round(tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)), 6) AS tfidf
FROM tf JOIN df USING (word)
""",
)
def ml_feature_tfidf(spark: SparkSession, d: str) -> DataFrame:
    """Exact weights with words as keys: no vocabulary on the driver, no hash clashes.

    Texts are moved once, by document, and their words counted where they lie. Frequent words, of which there are no more
    than may be broadcast, find their document count there; only pairs of rarer words are moved to theirs.
    """
    docs = table(spark, d, "documents").select("doc_id", "text")
    tf = words(docs.repartition("doc_id"), "doc_id").groupBy("doc_id", "word").agg(F.count("*").alias("tf"))
    df = materialize(tf.groupBy("word").agg(F.count("*").alias("df")), "document-counts")
    n, pairs = docs.select(F.count("*")).scalar(), df.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    frequent = F.col("df") > pairs // BROADCAST_ROWS
    near = tf.join(small_side(df.filter(frequent)), "word", "left")
    far = near.filter("df IS NULL").drop("df").join(df.filter(~frequent), "word")
    weight = F.col("tf") * F.log((n + 1.0) / (F.col("df") + 1.0))
    out = near.filter("df IS NOT NULL").unionByName(far)
    return out.select("doc_id", "word", "tf", F.round(weight, 6).alias("tfidf"))


@query(
    "ml_feature_hash",
    f"""
WITH w AS (SELECT * FROM ({WORDS_SQL.format(cols='doc_id,', table='documents')}) WHERE word <> ''),
df AS (SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS df FROM w GROUP BY 1)
SELECT coalesce(sum(tf) FILTER (WHERE df >= 2), 0)::DOUBLE AS counts, sum(tf)::DOUBLE AS hashed,
       round(sum(tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0))), 3) AS weighted,
       (SELECT sum(1 + n_chars)::DOUBLE FROM documents) AS columns, (SELECT count(*) FROM documents) AS n FROM df
""",
)
def ml_feature_hash(spark: SparkSession, d: str) -> DataFrame:
    """Mass of counted, hashed and weighted terms and of hashed columns.

    Counts and weights are keyed by word, so there is no vocabulary to cut.
    Hashed vectors are summed as they are, sparse: clashes add up and lose no mass.
    """
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    per = words(docs, "doc_id").groupBy("doc_id", "word").agg(F.count("*").alias("tf"))
    per = per.groupBy("word").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    n = docs.select(F.count("*")).scalar()
    counts = per.agg(
        F.coalesce(F.sum(F.when(F.col("df") >= 2, F.col("tf"))), F.lit(0)).cast("double").alias("counts"),
        F.round(F.sum(F.col("tf") * F.log((n + 1.0) / (F.col("df") + 1.0))), 3).alias("weighted"),
    )
    split = docs.withColumn("words", F.filter(F.split("text", "[ \n]+"), lambda w: w != ""))
    hashed = FT.HashingTF(inputCol="words", outputCol="hashed").transform(split)
    hashed = FT.FeatureHasher(inputCols=["lang", "n_chars"], outputCol="columns").transform(hashed)
    mass = hashed.agg(*[F.struct(Summarizer.metrics("normL1").summary(F.col(c)).alias("s")).alias(c) for c in ("hashed", "columns")], F.count("*").alias("n"))
    mass = mass.select(*[F.aggregate(vector_to_array(F.col(f"{c}.s.normL1")), F.lit(0.0), lambda a, x: a + x).alias(c) for c in ("hashed", "columns")], "n")
    # one row beside one row
    return counts.withColumn("_k", F.lit(1)).join(mass.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("ml_word2vec", "SELECT count(*) AS n, 10::BIGINT AS found, true AS good FROM documents")
def ml_word2vec(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of the more frequent words. Good: ten words near the most frequent one, by falling cosine, itself not among them."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    tokens = FT.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+").transform(docs)
    counts = materialize(words(docs).groupBy("word").agg(F.count("*").alias("n")), "word-counts")
    # a task trains on the words of its texts, so these are its rows, not the texts
    total = counts.agg(F.sum("n")).first()[0] or 0
    est = FT.Word2Vec(inputCol="words", outputCol="vec", vectorSize=16, minCount=20, maxIter=1, numPartitions=max(1, -(-total // TASK_ROWS)), seed=SEED)
    m = fitted(est, tokens.select("words"))
    top = counts.orderBy(F.desc("n"), "word").first()["word"]
    near = m.findSynonyms(top, 10).collect()
    sims = [r.similarity for r in near]
    good = sims == sorted(sims, reverse=True) and all(-1 <= x <= 1 + 1e-6 for x in sims) and top not in {r.word for r in near}
    return docs.agg(F.count("*").alias("n"), F.lit(len(near)).cast("long").alias("found"), F.lit(bool(good)).alias("good"))


@query(
    "ml_feature_select",
    """
WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS i FROM embeddings),
g AS (SELECT i, label, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS within FROM e GROUP BY ALL),
a AS (SELECT i, avg(x) AS m, count(*) AS n, var_samp(x) AS v FROM e GROUP BY 1),
f AS (SELECT g.i, (sum(g.n * (g.m - a.m) ** 2) / (count(*) - 1)) / (sum(g.within) / (any_value(a.n) - count(*))) AS f
      FROM g JOIN a ON a.i = g.i GROUP BY 1)
SELECT 'chi' AS method, NULL AS feature, 8::BIGINT AS n UNION ALL
SELECT 'f_value', i, 1 FROM (SELECT i FROM f ORDER BY f DESC LIMIT 8) UNION ALL SELECT 'variance', i, 1 FROM a WHERE v > 0.0155
""",
)
def ml_feature_select(spark: SparkSession, d: str) -> DataFrame:
    """Columns kept by chi-square (how many), F-value and variance (which)."""
    df = vectors(spark, d)
    bins = F.transform("v", lambda x: F.floor(x * 10).cast("double") + 20)
    binned = df.withColumn("binned", array_to_vector(bins))
    chi = FT.ChiSqSelector(numTopFeatures=8, featuresCol="binned", labelCol="label", outputCol="s1").fit(binned)
    uni = FT.UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="s2", selectionMode="numTopFeatures")
    uni = uni.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(8).fit(df)
    var = FT.VarianceThresholdSelector(featuresCol="features", outputCol="s3", varianceThreshold=0.0155).fit(df)
    rows = [(n, int(i), 1) for n, m in (("f_value", uni), ("variance", var)) for i in m.selectedFeatures]
    rows.append(("chi", None, len(set(chi.selectedFeatures))))
    return spark.createDataFrame(rows, "method string, feature int, n long")


@query(
    "ml_formula_sql",
    """
SELECT o_orderkey, o_totalprice / 1000 AS k, (o_orderstatus = 'F')::INTEGER::DOUBLE AS done, 5::BIGINT AS width
FROM orders WHERE o_totalprice > 2000
""",
)
def ml_formula_sql(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    stages = [
        FT.SQLTransformer(
            statement="SELECT o_orderkey, o_totalprice / 1000 AS k, o_orderpriority, "
            "CAST(CAST(o_orderstatus = 'F' AS INT) AS DOUBLE) AS done FROM __THIS__ WHERE o_totalprice > 2000"
        ),
        FT.RFormula(formula="done ~ k + o_orderpriority", featuresCol="f", labelCol="l"),
    ]
    out = Pipeline(stages=stages).fit(o).transform(o)
    return out.select("o_orderkey", "k", "done", F.size(vector_to_array("f")).alias("width"))


@query(
    "ml_pca_svd",
    "SELECT 'all' AS kind, round(sum(x * x), 3) AS squares, true AS good "
    "FROM (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings)",
)
def ml_pca_svd(spark: SparkSession, d: str) -> DataFrame:
    """Explained shares of the first components, and singular values from the Gram matrix: their squares add up to the
    sum of all squares. Good: shares and values fall, and no share is above the largest value's.

    The Gram matrix has width² entries however many rows there are; its
    eigenvalues are the squares of the singular values.
    """
    import numpy as np

    df = vectors(spark, d)
    pca = fitted(FT.PCA(k=5, inputCol="features", outputCol="pc"), df.select("features"))
    entries = M.gram(df).collect()  # width x width
    n = max(r.i for r in entries) + 1
    g = np.zeros((n, n))
    for r in entries:
        g[r.i, r.j] = r.x
    singular = np.sqrt(np.maximum(np.linalg.eigvalsh(g)[::-1], 0.0))
    shares = pca.explainedVariance.toArray()
    good = (np.diff(shares) <= 1e-12).all() and 0 < shares[-1] and shares.sum() < 1 and shares[0] <= singular[0] ** 2 / (singular**2).sum() + 0.05
    return spark.createDataFrame([("all", round(float((singular**2).sum()), 3), bool(good))], "kind string, squares double, good boolean")


ENTRIES_SQL = "SELECT l_linenumber::BIGINT AS i, l_suppkey AS j, sum(l_quantity) AS x FROM lineitem GROUP BY ALL"


@query(
    "ml_matrix_blocks",
    f"WITH a AS ({ENTRIES_SQL}) SELECT p.i, q.i AS j, round(sum(p.x * q.x), 2) AS x FROM a p JOIN a q ON p.j = q.j GROUP BY ALL",
)
def ml_matrix_blocks(spark: SparkSession, d: str) -> DataFrame:
    """A times its transpose. Lines are summed to entries first: a supplier has at most seven."""
    a = table(spark, d, "lineitem").groupBy(F.col("l_linenumber").cast("long").alias("i"), F.col("l_suppkey").alias("j")).agg(
        F.sum("l_quantity").alias("x")
    )
    return M.multiply(a, M.transpose(a)).withColumn("x", F.round("x", 2))


@query(
    "ml_column_similarity",
    """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS i FROM embeddings),
n AS (SELECT i, sqrt(sum(x * x)) AS norm FROM e GROUP BY 1),
g AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS x FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY ALL)
SELECT g.i, g.j, round(g.x / (p.norm * q.norm), 6) AS cosine, true AS near FROM g JOIN n p ON p.i = g.i JOIN n q ON q.i = g.j
""",
)
def ml_column_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Cosines of columns, exactly. Near: the estimate from sampled entries lies within six of its deviations."""
    df = vectors(spark, d).select(F.col("vec_id").alias("id"), "v")
    width = df.agg(F.max(F.size("v"))).first()[0] or 0
    sampled = M.sampled_column_cosines(df, width, 0.9).withColumnRenamed("cosine", "estimate")
    both = M.column_cosines(df).join(sampled, ["i", "j"])
    near = F.abs(F.col("estimate") - F.col("cosine")) <= 6 * F.col("sigma") + 1e-9
    return both.select("i", "j", F.round("cosine", 6).alias("cosine"), near.alias("near"))


LIKE = 60  # percent of two sets' words that are common


@query(
    "ml_lsh_minhash",
    f"""
WITH w AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(regexp_split_to_array(lower(text), '[ \n]+'))) AS words
  FROM documents WHERE text IS NOT NULL),
s AS MATERIALIZED (SELECT words, min(doc_id) AS other, count(*) AS copies FROM w GROUP BY words),
p AS (SELECT doc_id, other, copies, len(list_intersect(w.words, s.words)) AS common, len(w.words) + len(s.words) AS sizes
  FROM w JOIN s ON len(s.words) * 100 >= {LIKE} * len(w.words) AND len(w.words) * 100 >= {LIKE} * len(s.words) WHERE doc_id % 100 = 0)
SELECT doc_id, other, copies, round(common / (sizes - common), 6) AS jaccard, true AS recall, true AS led
FROM p WHERE common * 100 >= {LIKE} * (sizes - common)
""",
)
def ml_lsh_minhash(spark: SparkSession, d: str) -> DataFrame:
    """Texts whose word sets are like those of every hundredth text, exactly, by prefix filter; a set stands for its ``copies``.

    Beside it MinHash in bands: ``recall`` holds if it finds nine in ten of these pairs. ``led`` holds if, of all texts linked
    to leaders in rounds, none is less like its leader than asked for and none of the exact pairs lies between two texts
    that share a band but are neither leaders nor linked.
    """
    docs = table(spark, d, "documents").filter("text IS NOT NULL")
    words = F.array_distinct(F.split(F.lower("text"), "[ \n]+"))
    docs = docs.select("doc_id", words.alias("words"))
    sets = materialize(distinct_sets(docs, "doc_id", "words"), "sets")
    ordered = rarest_first(sets, "doc_id", "words").withColumnRenamed("doc_id", "id")
    hashed = materialize(hashed_bands(ordered, 24, 4, SEED), "bands")
    ordered = hashed.select("id", "words")
    digest = F.sha2(F.to_json(F.struct(F.array_sort("words").alias("w"))), 256)
    asked = docs.filter("doc_id % 100 = 0").select("doc_id", digest.alias("h"))
    of_set = ordered.select("id", digest.alias("h"))
    # texts asked for by the set that stands for them
    asked = materialize(asked.join(of_set, "h").select("doc_id", F.col("id").alias("left_id")), "asked")
    ids = asked.select(F.col("left_id").alias("id")).distinct()
    mine = materialize(among(hashed, ids, "id").join(ids, "id", "left_semi"), "asked-sets")
    exact = materialize(like_sets(mine.select("id", "words"), ordered, LIKE), "like-sets")
    found = hashed_like_sets(mine, hashed, LIKE)
    pair = ["left_id", "right_id"]
    seen = exact.join(found.select(*pair).distinct().withColumn("seen", F.lit(1)), pair, "left")
    recall = seen.agg(F.coalesce(F.sum("seen") >= 0.9 * F.count("*"), F.lit(True))).first()[0]
    led = leaders_hold(hashed, exact)
    copies = sets.select(F.col("doc_id").alias("right_id"), "copies")
    out = asked.join(exact, "left_id").join(copies, "right_id")
    return out.select(
        "doc_id", F.col("right_id").alias("other"), "copies", F.round("jaccard", 6).alias("jaccard"), F.lit(bool(recall)).alias("recall"), F.lit(led).alias("led")
    )


def leaders_hold(hashed: DataFrame, exact: DataFrame) -> bool:
    """Of two like sets with a common key, one at least has a leader: the smaller of two that lead cannot be passed over."""
    links = materialize(leader_links(hashed, LIKE), "leader-links")
    has = links.select("id").distinct().withColumn("led", F.lit(1))
    keys = hashed.select("id", "keys")
    pairs = exact.filter("left_id <> right_id").join(keys.toDF("left_id", "a"), "left_id").join(keys.toDF("right_id", "b"), "right_id")
    pairs = pairs.filter(F.arrays_overlap("a", "b"))
    left = pairs.join(has.withColumnsRenamed({"id": "left_id", "led": "l"}), "left_id", "left")
    both = left.join(has.withColumnsRenamed({"id": "right_id", "led": "r"}), "right_id", "left")
    return both.filter("l IS NULL AND r IS NULL").isEmpty()


NEAREST = 10


@query(
    "ml_lsh_projection",
    f"""
WITH v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT q.vec_id, o.vec_id AS other, list_distance(q.v, o.v) AS distance FROM v q JOIN v o ON q.vec_id <> o.vec_id WHERE q.vec_id % 100 = 0)
SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY distance, other) AS place, other, round(distance, 6) AS distance, true AS recall
FROM p QUALIFY place <= {NEAREST}
""",
)
def ml_lsh_projection(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector, by lists that are visited while they may hold a nearer one.

    Beside it random projections with several probes: ``recall`` holds if these find nine in ten of them. A query looks
    into its own bucket and into those across the nearest bucket edges, nearest first.
    """
    df = vectors(spark, d).select(F.col("vec_id").alias("id"), "v")
    asked = df.filter("id % 100 = 0").select(F.col("id").alias("query"), "v", F.array("id").alias("skip"))
    best = materialize(best_rows(asked, df, NEAREST, "distance"), "nearest")
    found = probed_nearest(asked, df, NEAREST, SEED)
    seen = best.join(found.select("query", "id").withColumn("seen", F.lit(1)), ["query", "id"], "left")
    recall = seen.agg(F.coalesce(F.sum("seen") >= 0.9 * F.count("*"), F.lit(True))).first()[0]
    return best.select(
        F.col("query").alias("vec_id"), "place", F.col("id").alias("other"), F.round("cost", 6).alias("distance"), F.lit(bool(recall)).alias("recall")
    )


def mean_ranks(df: DataFrame, col: str) -> DataFrame:
    """(col, rank_col): the mean rank of each value of a column. Windows run within ranges of distinct values, and over one row for each range."""
    counts = by_ranges(df.groupBy(col).agg(F.count("*").alias("n")), [], [col])
    sizes = counts.groupBy(SLICE).agg(F.sum("n").alias("all")).withColumn("_one", F.lit(0))
    before = Window.partitionBy("_one").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(sizes.select(SLICE, F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before")))
    upto = F.sum("n").over(Window.partitionBy(SLICE).orderBy(col).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("upto", upto).join(starts, SLICE)
    return materialize(placed.select(col, (F.col("before") + F.col("upto") - (F.col("n") - 1) / 2).alias(f"rank_{col}")), "mean-ranks")


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "ml_correlation_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{m}' AS method, {i}::BIGINT AS i, {j}::BIGINT AS j, round(corr({p}{a}, {p}{b}), 5) AS corr FROM {src}"
        for m, p, src in (
            ("pearson", "", "lineitem"),
            ("spearman", "r_", "(SELECT "
             + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in CORR_COLS)
             + " FROM lineitem)"),
        )
        for i, a in enumerate(CORR_COLS) for j, b in enumerate(CORR_COLS) if i < j
    ),
)
def ml_correlation_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Spearman is Pearson on mean ranks. The library sorts all entries and groups them by row again; here the distinct values
    of a column are ranked with their counts, and the rows look them up."""
    li = table(spark, d, "lineitem").select(*CORR_COLS)
    ranks = li
    for c in CORR_COLS:
        ranks = ranks.join(small_side(mean_ranks(li, c)), c).drop(c)
    rows = []
    for method, df in (("pearson", assembled(li, CORR_COLS)), ("spearman", assembled(ranks, [f"rank_{c}" for c in CORR_COLS]))):
        m = Correlation.corr(df.select("features"), "features").first()[0].toArray()
        n = len(CORR_COLS)
        rows += [(method, i, j, round(float(m[i, j]), 5)) for i in range(n) for j in range(n) if i < j]
    return spark.createDataFrame(rows, "method string, i int, j int, corr double")


@query(
    "ml_hypothesis_tests",
    """
WITH c AS (SELECT l_returnflag AS f, l_linestatus AS s, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL),
e AS (SELECT *, sum(n) OVER (PARTITION BY f) * sum(n) OVER (PARTITION BY s) / sum(n) OVER () AS want FROM c)
SELECT round(sum((n - want) * (n - want) / want), 6) AS chi_square, 2::BIGINT AS degrees, true AS ks_in_range FROM e
""",
)
def ml_hypothesis_tests(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", ((F.col("l_quantity") - 25.5) / 14.4).alias("z"))
    idx = FT.StringIndexer(inputCols=["l_returnflag", "l_linestatus"], outputCols=["f", "s"])
    df = assembled(idx.fit(li).transform(li), ["s"])
    chi = ChiSquareTest.test(df, "features", "f").first()
    ks = KolmogorovSmirnovTest.test(li, "z", "norm", 0.0, 1.0).first()
    row = (round(float(chi.statistics[0]), 6), int(chi.degreesOfFreedom[0]), bool(0 <= ks.statistic <= 1))
    return spark.createDataFrame([row], "chi_square double, degrees long, ks_in_range boolean")


@query(
    "ml_vector_summary",
    """
WITH e AS (SELECT unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS place FROM embeddings)
SELECT place, round(avg(x), 8) AS mean, round(var_samp(x), 8) AS variance, min(x) AS low, max(x) AS high,
       round(sum(abs(x)), 5) AS norm1, round(sqrt(sum(x * x)), 6) AS norm2 FROM e GROUP BY 1
""",
)
def ml_vector_summary(spark: SparkSession, d: str) -> DataFrame:
    measures = ["mean", "variance", "min", "max", "normL1", "normL2"]
    s = vectors(spark, d).agg(Summarizer.metrics(*measures).summary(F.col("features")).alias("s"))
    zipped = F.arrays_zip(*[vector_to_array(f"s.{m}").alias(m) for m in measures])
    rows = s.select(F.posexplode(zipped).alias("place", "z")).select(F.col("place").cast("long"), "z.*")
    return rows.select(
        "place", F.round("mean", 8).alias("mean"), F.round("variance", 8).alias("variance"), F.col("min").alias("low"),
        F.col("max").alias("high"), F.round("normL1", 5).alias("norm1"), F.round("normL2", 6).alias("norm2"),
    )


POINTS = [900.0, 1000.0, 1100.0, 1250.0, 1500.0]
BANDWIDTH = 50.0


@query(
    "ml_kernel_density",
    f"SELECT point, round(avg(exp(-0.5 * pow((p_retailprice - point) / {BANDWIDTH}, 2)) / ({BANDWIDTH} * sqrt(2 * pi()))), 10) "
    f"AS density FROM part, (SELECT unnest({POINTS})::DOUBLE AS point) GROUP BY 1",
)
def ml_kernel_density(spark: SparkSession, d: str) -> DataFrame:
    """One mean per point in a single pass; rows are not multiplied by points."""
    price = F.col("p_retailprice")
    scale = BANDWIDTH * F.sqrt(2 * F.pi())
    means = [F.avg(F.exp(-0.5 * F.pow((price - p) / BANDWIDTH, 2)) / scale) for p in POINTS]
    pairs = F.array(*[F.struct(F.lit(p).alias("point"), F.round(m, 10).alias("density")) for p, m in zip(POINTS, means)])
    return table(spark, d, "part").agg(pairs.alias("a")).select(F.inline("a"))


CLASS_SQL = """
WITH p AS (SELECT quality AS y, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS g FROM labels JOIN documents USING (doc_id)),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = 1 AND g = 1) AS tp, count(*) FILTER (WHERE y = 0 AND g = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND g = 0) AS fn, count(*) FILTER (WHERE y = 0 AND g = 0) AS tn FROM p)
SELECT n, tp, fp, fn, tn, round((tp + tn) / n, 8) AS accuracy, round(tp / (tp + fp), 8) AS prec, round(tp / (tp + fn), 8) AS recall,
       round(2.0 * tp / (2 * tp + fp + fn), 8) AS f1, true AS auc_in_range, round((fp + fn) / n, 8) AS hamming FROM c
"""


@query("ml_metrics_class", CLASS_SQL)
def ml_metrics_class(spark: SparkSession, d: str) -> DataFrame:
    """Quality guessed from text length. Counts by one aggregate; the evaluators read the same frame."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    guess = F.when(F.col("n_chars") > 400, 1.0).otherwise(0.0)
    p = table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("quality").cast("double").alias("label"), guess.alias("prediction"),
        F.col("n_chars").cast("double").alias("rawPrediction"),
    )
    p = materialize(p, "predicted")

    def score(name: str, **kw) -> float:
        return round(float(MulticlassClassificationEvaluator(metricName=name, **kw).evaluate(p)), 8)

    sets = p.select(F.array("label").alias("label"), F.array("prediction").alias("prediction"))
    auc = BinaryClassificationEvaluator(numBins=1000).evaluate(p)
    y, g = F.col("label"), F.col("prediction")
    counts = p.agg(
        F.count("*").alias("n"), F.sum(y * g).cast("long").alias("tp"), F.sum((1 - y) * g).cast("long").alias("fp"),
        F.sum(y * (1 - g)).cast("long").alias("fn"), F.sum((1 - y) * (1 - g)).cast("long").alias("tn"),
    )
    values = {
        "accuracy": score("accuracy"), "prec": score("precisionByLabel", metricLabel=1.0),
        "recall": score("recallByLabel", metricLabel=1.0), "f1": score("fMeasureByLabel", metricLabel=1.0),
        "auc_in_range": bool(0 <= auc <= 1),
        "hamming": round(float(MultilabelClassificationEvaluator(metricName="hammingLoss").evaluate(sets)), 8),
    }
    row = counts.first()
    return spark.createDataFrame([(*row, *values.values())], [*row.asDict(), *values])


@query(
    "ml_metrics_value",
    """
WITH p AS (SELECT l_extendedprice / 1000 AS y, 2.1 * l_quantity AS g FROM lineitem)
SELECT round(avg((y - g) * (y - g)), 6) AS mse, round(sqrt(avg((y - g) * (y - g))), 6) AS rmse, round(avg(abs(y - g)), 6) AS mae,
       round(1 - sum((y - g) * (y - g)) / sum((y - mu) * (y - mu)), 6) AS r2, true AS others_in_range
FROM p, (SELECT avg(l_extendedprice / 1000) AS mu FROM lineitem)
""",
)
def ml_metrics_value(spark: SparkSession, d: str) -> DataFrame:
    """Regression measures, with a silhouette of labelled vectors and a ranking measure beside them."""
    p = lines(spark, d).select(F.col("price").alias("label"), (2.1 * F.col("l_quantity")).alias("prediction"))
    p = materialize(p, "predicted")
    reg = {m: round(float(RegressionEvaluator(metricName=m).evaluate(p)), 6) for m in ("mse", "rmse", "mae", "r2")}
    v = vectors(spark, d).select("features", F.col("label").alias("prediction"))
    silhouette = ClusteringEvaluator().evaluate(v)
    kinds = table(spark, d, "events").groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).count().na.fill(0)
    ids = F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0))
    counts = F.array("click", "view", "purchase")
    order = F.array_sort(F.transform(ids, lambda i: F.struct(-F.get(counts, i.cast("int")), i.alias("id"))))
    ranked = kinds.select(F.transform(order, lambda s: s["id"]).alias("prediction"), F.array(F.lit(2.0)).alias("label"))
    good = RankingEvaluator(metricName="meanAveragePrecision").evaluate(ranked)
    ok = bool(-1 <= silhouette <= 1 and 0 <= good <= 1)
    return spark.createDataFrame([(*reg.values(), ok)], [*reg, "others_in_range"])
