"""Fitting and scoring. Fits in closed form or by a few rounds of sums agree with SQL to the digit; of the others SQL states what they must beat."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from fitloom.functions import text as tx
from fitloom.functions.classes import price_class_code
from fitloom.operators import encode, models, regression, splits, words
from fitloom.operators.joins import kept
from fitloom.plans.registry import EMB, LINE_IDS, SQL_PRICE_CODE, SQL_RATING, entries, query, r6, rating, rounded, sql_r6, sql_rank
from fitloom.session import scratch_path
from fitloom.sources.readers import table


def _fitted_on(df, ids):
    """Prepared rows, computed once and dealt evenly: every round of every fit reads them again."""
    return kept(df.repartition(*ids))


def _sql_split(tab: str, ids: list[str], share: float, cols: str) -> str:
    ranked = f"SELECT {cols}, {sql_rank(42, *ids)} AS k, count(*) OVER () AS rows FROM {tab}"
    return f"SELECT *, CASE WHEN k <= ceil({share}::DOUBLE * rows) THEN 'holdout' ELSE 'train' END AS split FROM ({ranked})"


def _sql_majority(base: str) -> str:
    """Rows, and those of the largest class, per split of ``base`` (split, label)."""
    return f"SELECT split, sum(c)::BIGINT AS n, max(c) AS majority, true AS beats FROM (SELECT split, label, count(*) AS c FROM ({base}) GROUP BY split, label) GROUP BY split"


def _beats(scored, truth, guess):
    """Per split the rows, those of its largest class, and whether the guesses are right more often than that."""
    held = scored.groupBy("split", truth.alias("truth")).agg(F.count(F.lit(1)).alias("c"), F.count_if(truth == guess).alias("right"))
    return held.groupBy("split").agg(F.sum("c").alias("n"), F.max("c").alias("majority"), (F.sum("right") > F.max("c")).alias("beats"))


_SQL_LINES = _sql_split("lineitem", LINE_IDS, 0.3, ", ".join([*LINE_IDS, "l_quantity", "l_discount", "l_tax", "l_extendedprice"]))


_SQL_AMOUNT = "l_quantity::DOUBLE * (1.0::DOUBLE - l_discount::DOUBLE) * (1.0::DOUBLE + l_tax::DOUBLE)"


@query(
    "fit_l1_regressor",
    f"WITH s AS (SELECT split, {_SQL_AMOUNT} AS amount FROM ({_SQL_LINES})), m AS (SELECT median(amount) AS m FROM s WHERE split = 'train') "
    f"SELECT split, count(*) AS n, {sql_r6('avg(abs(amount - m))')} AS constant_mae, true AS beats FROM s, m GROUP BY split",
)
def fit_l1_regressor(spark, d):
    """Whether boosted trees come closer to the amount after discount and tax than the median of the training rows does, whose error SQL gives."""
    cols = ["l_quantity", "l_discount", "l_tax"]
    parts = splits.holdout_split(table(spark, d, "lineitem").select(*LINE_IDS, *cols), LINE_IDS, 0.3)
    quantity, discount, tax = (F.col(c).cast("double") for c in cols)
    parts = parts.withColumn("amount", quantity * (F.lit(1.0) - discount) * (F.lit(1.0) + tax))
    parts = _fitted_on(encode.standard_scale_fit(parts.where("split = 'train'"), cols).apply(parts), LINE_IDS)
    train = parts.where("split = 'train'")
    model = models.fit_l1_regressor(train.select(*cols, "amount"), cols, "amount", rounds=5)
    median = train.agg(F.percentile("amount", 0.5)).first()[0]
    y = F.col("amount")
    errors = model.transform(parts).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - F.lit(median))).alias("constant_mae"), F.avg(F.abs(y - F.col("prediction"))).alias("mae")
    )
    return errors.select("split", "n", r6("constant_mae").alias("constant_mae"), (F.col("mae") < F.col("constant_mae")).alias("beats"))


L1_ROUNDS = 6


def _sql_l1() -> str:
    """Least squares of l_extendedprice on l_quantity, weighted anew ``L1_ROUNDS`` times by one over the last error."""
    fit = "(sum(w) * sum(w * x * y) - sum(w * x) * sum(w * y)) / (sum(w) * sum(w * x * x) - sum(w * x) * sum(w * x))"
    parts = [f"t AS (SELECT l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE AS y FROM ({_SQL_LINES}) WHERE split = 'train')"]
    for k in range(L1_ROUNDS + 1):
        source = "SELECT x, y, 1.0::DOUBLE AS w FROM t"
        if k:
            source = f"SELECT x, y, 1.0::DOUBLE / greatest(abs(y - a - b * x), 0.001::DOUBLE) AS w FROM t, f{k - 1}"
        parts.append(f"f{k} AS MATERIALIZED (SELECT b, (swy - b * swx) / sw AS a FROM (SELECT {fit} AS b, sum(w * y) AS swy, sum(w * x) AS swx, sum(w) AS sw FROM ({source})))")
    return f"WITH {', '.join(parts)} SELECT 'intercept' AS term, round(a, 3) AS value FROM f{L1_ROUNDS} UNION ALL SELECT 'l_quantity', round(b, 3) FROM f{L1_ROUNDS}"


@query("fit_l1_linear", _sql_l1())
def fit_l1_linear(spark, d):
    lines = splits.holdout_split(table(spark, d, "lineitem").select(*LINE_IDS, "l_quantity", "l_extendedprice"), LINE_IDS, 0.3)
    model = regression.fit_l1_linear(lines.where("split = 'train'").persist(), ["l_quantity"], "l_extendedprice", rounds=L1_ROUNDS)
    return model.table(lines).select("term", F.round("value", 3).alias("value"))


LOGIT_ROUNDS = 6


def _sql_logit() -> str:
    """Newton steps for high price (class 2 or not) by the sum of quantities, rows weighted by one over the size of their class."""
    base = (
        f"SELECT q::DOUBLE / 100 AS x, CASE WHEN ({SQL_PRICE_CODE.format(x='o_totalprice')}) = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y "
        "FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"
    )
    parts = [f"r AS ({base})", "t AS MATERIALIZED (SELECT x, y, 1000.0::DOUBLE / count(*) OVER (PARTITION BY y) AS c FROM r)", "f0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    fit = "(sum(w) * sum(w * x * z) - sum(w * x) * sum(w * z)) / (sum(w) * sum(w * x * x) - sum(w * x) * sum(w * x))"
    for k in range(LOGIT_ROUNDS):
        p = f"SELECT x, y, c, a + b * x AS e, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(a + b * x))) AS p FROM t, f{k}"
        z = f"SELECT x, c * p * (1 - p) AS w, e + (y - p) / (p * (1 - p)) AS z FROM ({p})"
        parts.append(f"f{k + 1} AS MATERIALIZED (SELECT (swz - b * swx) / sw AS a, b FROM (SELECT {fit} AS b, sum(w * z) AS swz, sum(w * x) AS swx, sum(w) AS sw FROM ({z})))")
    return f"WITH {', '.join(parts)} SELECT 'intercept' AS term, {sql_r6('a')} AS value FROM f{LOGIT_ROUNDS} UNION ALL SELECT 'quantity', {sql_r6('b')} FROM f{LOGIT_ROUNDS}"


def _quantities(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").cast("double").alias("quantity"))


@query("fit_weighted_logistic", _sql_logit())
def fit_weighted_logistic(spark, d):
    orders = table(spark, d, "orders").join(_quantities(spark, d), "o_orderkey")
    rows = orders.select("o_orderkey", (F.col("quantity") / 100).alias("quantity"), (price_class_code(F.col("o_totalprice")) == 2).cast("double").alias("y"))
    counts = rows.groupBy("y").agg((F.lit(1000.0) / F.count(F.lit(1))).alias("c"))
    rows = rows.join(F.broadcast(counts), "y").persist()  # two classes
    return rounded(regression.fit_weighted_logistic(rows, ["quantity"], "y", "c", rounds=LOGIT_ROUNDS).table(rows), "value")


def _balanced(spark, d):
    """Orders with customer and size, encoded and scaled on the training part; the label is the class of the customer's balance."""
    orders = table(spark, d, "orders").join(_quantities(spark, d), "o_orderkey", "left").na.fill({"quantity": 0.0})
    parts = splits.holdout_split(orders, ["o_orderkey"], 0.3)
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    balance = F.when(F.col("c_acctbal") < 2000, 0.0).when(F.col("c_acctbal") < 6000, 1.0).otherwise(2.0)
    parts = parts.join(customers, "o_custkey").select(
        "o_orderkey", "split", balance.alias("label"), "quantity", "c_acctbal", "c_mktsegment", "o_orderpriority", "o_orderstatus"
    )
    parts = _fitted_on(parts, ["o_orderkey"])
    train = parts.where("split = 'train'")
    coded = encode.one_hot_apply(parts, encode.one_hot_levels(train, ["c_mktsegment", "o_orderpriority", "o_orderstatus"]))
    scaled = encode.standard_scale_fit(train, ["quantity", "c_acctbal"]).apply(coded)
    cols = [c for c in scaled.columns if c not in ("o_orderkey", "label", "split")]
    return models.with_vector(encode.assemble_features(scaled, cols, "x"), "x").select("o_orderkey", "label", "split", "features")


_SQL_BALANCED = (
    "SELECT split, CASE WHEN c_acctbal < 2000 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS label "
    f"FROM ({_sql_split('orders', ['o_orderkey'], 0.3, 'o_orderkey, o_custkey')}) JOIN customer ON c_custkey = o_custkey"
)


@query("fit_mlp_classifier", _sql_majority(_SQL_BALANCED))
def fit_mlp_classifier(spark, d):
    rows = _balanced(spark, d)
    model = models.fit_mlp_classifier(rows.where("split = 'train'"), "features", "label", 3, hidden=(16,), rounds=40)
    return _beats(model.transform(rows), F.col("label"), F.col("prediction"))


_SQL_TOP = "CASE WHEN v[1] >= v[2] AND v[1] >= v[3] THEN 0 WHEN v[2] >= v[3] THEN 1 ELSE 2 END"


def _labelled_vectors(spark, d):
    """Vectors with the place of the largest of their first three entries as class; a fifth is held out."""
    v = F.col("embedding").cast("array<double>")
    emb = table(spark, d, "embeddings").select("vec_id", v.alias("v"))
    label = F.when((F.col("v")[0] >= F.col("v")[1]) & (F.col("v")[0] >= F.col("v")[2]), 0).when(F.col("v")[1] >= F.col("v")[2], 1).otherwise(2)
    parts = splits.fraction_split(emb.withColumn("label", label), ["vec_id"], [0.8, 0.2])
    return _fitted_on(models.with_vector(parts, "v"), ["vec_id"])


_SQL_VECTORS = (
    f"SELECT vec_id, v, label, CASE WHEN k <= floor(0.8::DOUBLE * n) + CASE WHEN n - floor(0.8::DOUBLE * n) - floor(0.2::DOUBLE * n) >= 1 THEN 1 ELSE 0 END THEN 0 ELSE 1 END AS part FROM "
    f"(SELECT vec_id, v, {_SQL_TOP} AS label, {sql_rank(42, 'vec_id')} AS k, count(*) OVER () AS n FROM ({EMB}))"
)


@query("fit_weighted_classifier", _sql_majority(f"SELECT part AS split, label FROM ({_SQL_VECTORS})"))
def fit_weighted_classifier(spark, d):
    rows = _labelled_vectors(spark, d)
    model = models.fit_weighted_classifier(rows.where("part = 0"), "features", "label", ["vec_id"], rounds=20)
    return _beats(model.transform(rows).withColumnRenamed("part", "split"), F.col("label"), F.col("prediction"))


def _rated_tokens(spark, d):
    # a number is given, so that the costly steps after it keep that many tasks
    docs = table(spark, d, "documents").select("doc_id", "lang", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    tokens = docs.select("doc_id", rating(F.col("lang")).alias("label"), tx.content_words(F.col("text")).alias("tokens"))
    return splits.holdout_split(tokens, ["doc_id"], 0.15)


_SQL_RATED = f"SELECT split, ({SQL_RATING}) AS label FROM ({_sql_split('documents', ['doc_id'], 0.15, 'doc_id, lang')})"


@query("fit_bow_classifier", _sql_majority(_SQL_RATED))
def fit_bow_classifier(spark, d):
    rows = kept(_rated_tokens(spark, d))
    vocab, model = models.fit_bow_classifier(rows.where("split = 'train'"), F.col("tokens"), "label", ["doc_id"], rounds=20)
    scored = model.transform(words.bow_vector(rows, F.col("tokens"), vocab, "features"))
    return _beats(scored, F.col("label"), F.col("prediction"))


@query("fit_text_linear", _sql_majority(_SQL_RATED))
def fit_text_linear(spark, d):
    buckets = 1 << 14
    rows = kept(models.with_word_pairs(_rated_tokens(spark, d), "tokens", buckets).drop("tokens"))  # for the fit and the scores
    model = models.fit_text_linear(rows.where("split = 'train'"), "tokens", "label", buckets=buckets, rounds=20)
    return _beats(model.stages[-1].transform(rows), F.col("label"), F.col("prediction"))


SWEEP = {"8": (8,), "16": (16,), "8-8": (8, 8)}
_SQL_SWEEP_NAMES = ", ".join(f"('{c}')" for c in SWEEP)


@query(
    "config_sweep",
    f"SELECT config, {sql_r6('majority / n')} AS majority, true AS beats FROM (SELECT * FROM ({_sql_majority(_SQL_BALANCED)}) WHERE split = 'train'), (VALUES {_SQL_SWEEP_NAMES}) c(config)",
)
def config_sweep(spark, d):
    """Every configuration beside the share of the largest class of the training rows, and whether it is right more often."""
    rows = _balanced(spark, d)
    report = models.config_sweep(rows, "features", "label", 3, "split", "train", "holdout", SWEEP, rounds=40)
    counts = [r["count"] for r in rows.where("split = 'train'").groupBy("label").count().collect()]
    majority = F.lit(max(counts) / sum(counts))
    return report.select("config", r6(majority).alias("majority"), (F.col("acc_train") > majority).alias("beats"))


_SQL_BAYES = (
    f"e AS (SELECT vec_id, label, part, unnest(range(len(v))) AS i, unnest(v) AS x FROM ({_SQL_VECTORS})), "
    "t AS (SELECT label, i, avg(x) AS m, var_pop(x) AS s FROM e WHERE part = 0 GROUP BY label, i), "
    "least AS (SELECT 1e-9::DOUBLE * max(s) AS s FROM (SELECT var_pop(x) AS s FROM e WHERE part = 0 GROUP BY i)), "
    f"prior AS (SELECT label, ln(count(*)) AS p FROM ({_SQL_VECTORS}) WHERE part = 0 GROUP BY label), "
    "odds AS (SELECT vec_id, t.label, sum(-0.5::DOUBLE * ln(t.s + least.s) - (x - m) * (x - m) / (2.0::DOUBLE * (t.s + least.s))) AS o FROM e, t, least WHERE e.i = t.i GROUP BY vec_id, t.label), "
    "bayes AS (SELECT vec_id, label AS predicted FROM odds JOIN prior USING (label) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY o + p DESC) = 1)"
)


@query(
    "score_batch",
    f"WITH {_SQL_BAYES}, near AS (SELECT vec_id, label AS nearest FROM (SELECT vec_id, t.label, sum((x - m) * (x - m)) AS far FROM e JOIN t ON e.i = t.i GROUP BY vec_id, t.label) "
    "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far) = 1) SELECT vec_id, predicted, nearest FROM bayes JOIN near USING (vec_id)",
)
def score_batch(spark, d):
    """Classes by a Bayes model of Spark and by the nearest class mean as a plain linear model; SQL works both out from the rows."""
    rows = _labelled_vectors(spark, d)
    model = NaiveBayes(modelType="gaussian").fit(rows.where("part = 0"))
    own = models.score_batch(model, rows, ["vec_id", "v"])
    means = model.theta.toArray()
    both = models.score_foreign(own, "v", ["vec_id", "predicted"], means, -0.5 * (means**2).sum(axis=1), out="nearest")
    return both.select("vec_id", "predicted", "nearest")


_SQL_PCA_STEPS = 18


def _sql_axes(k: int) -> str:
    """Tables axis0, axis1, ... (i, x): leading directions of the covariance c0, found by squaring it again and again, each then taken out of it."""
    parts = [
        f"b AS (SELECT vec_id, unnest(range(len(v))) AS i, unnest(v) AS x FROM ({EMB}))",
        "m AS (SELECT i, avg(x) AS m FROM b GROUP BY i)", "d AS (SELECT vec_id, b.i, x - m AS x FROM b JOIN m ON b.i = m.i)",
        f"c0 AS MATERIALIZED (SELECT p.i, q.i AS j, sum(p.x * q.x) / ((SELECT count(*) FROM ({EMB})) - 1) AS x FROM d p JOIN d q ON p.vec_id = q.vec_id GROUP BY p.i, q.i)",
    ]
    for n in range(k):
        last = f"c{n}"
        for s in range(_SQL_PCA_STEPS):
            square = f"SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY a.i, b.j"
            last = f"p{n}_{s}"
            parts.append(f"{last} AS MATERIALIZED (SELECT i, j, x / sqrt(sum(x * x) OVER ()) AS x FROM ({square}))")
        # a power of one direction: its longest column points along it
        parts.append(f"o{n} AS (SELECT i, x FROM {last} WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY x DESC LIMIT 1))")
        sign = f"(SELECT sign(x) FROM o{n} ORDER BY abs(x) DESC LIMIT 1)"
        parts.append(f"axis{n} AS MATERIALIZED (SELECT i, x * {sign} / sqrt((SELECT sum(x * x) FROM o{n})) AS x FROM o{n})")
        value = f"(SELECT sum(p.x * c.x * q.x) FROM c{n} c JOIN axis{n} p ON p.i = c.i JOIN axis{n} q ON q.i = c.j)"
        parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c.i, c.j, c.x - {value} * p.x * q.x AS x FROM c{n} c JOIN axis{n} p ON p.i = c.i JOIN axis{n} q ON q.i = c.j)")
    return ", ".join(parts)


_SQL_FEATURES = " UNION ALL ".join(f"SELECT vec_id, {n}::INTEGER AS pos, {sql_r6('sum(b.x * a.x)')} AS value FROM b JOIN axis{n} a ON a.i = b.i GROUP BY vec_id" for n in range(4))


@query("extract_features", f"WITH {_sql_axes(4)} {_SQL_FEATURES}")
def extract_features(spark, d):
    return entries(models.extract_features(table(spark, d, "embeddings"), "embedding", 4, ["vec_id"]), ["vec_id"], "features")


@query("save_load_model", f"WITH {_SQL_BAYES} SELECT vec_id, predicted FROM bayes")
def save_load_model(spark, d):
    """The classes that a model gives once it is written and read back; SQL works them out from the rows."""
    rows = _labelled_vectors(spark, d)
    model = Pipeline(stages=[NaiveBayes(modelType="gaussian")]).fit(rows.where("part = 0"))
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    return models.score_batch(models.load_model(path), rows.drop("label"), ["vec_id"])
