"""Metrics and distribution comparison."""

from pyspark.sql import functions as F

from fitloom.functions.classes import price_class_code
from fitloom.operators import distributions, metrics, splits
from fitloom.plans.registry import EMB, SQL_PRICE_CODE, query, rounded, sql_r6, sql_rank
from fitloom.plans.vectors import SQL_NOISY, noisy_vectors
from fitloom.sources.readers import table

# A linear guess of the price from the quantity.
_GUESS = "l_quantity * 1500.0"
_SQL_GUESS = "l_quantity * 1500.0::DOUBLE"


@query("mae", f"SELECT {sql_r6(f'avg(abs(l_extendedprice - {_SQL_GUESS}))')} AS mae FROM lineitem")
def mae(spark, d):
    guess = F.col("l_quantity") * F.lit(1500.0)
    return rounded(metrics.mae(table(spark, d, "lineitem"), F.col("l_extendedprice"), guess), "mae")


@query("mse", f"SELECT round(avg((l_extendedprice - {_SQL_GUESS}) * (l_extendedprice - {_SQL_GUESS})), 2) AS mse FROM lineitem")
def mse(spark, d):
    guess = F.col("l_quantity") * F.lit(1500.0)
    return metrics.mse(table(spark, d, "lineitem"), F.col("l_extendedprice"), guess).withColumn("mse", F.round("mse", 2))


_HIT = "(quality = 1 - toxic)"


@query(
    "accuracy",
    f"SELECT split, count(*) AS n, {sql_r6(f'avg({_HIT}::INTEGER::DOUBLE)')} AS accuracy, floor(count(*) FILTER ({_HIT}) * 100.0::DOUBLE / count(*))::INTEGER AS percent "
    f"FROM (SELECT *, CASE WHEN k <= ceil(0.3::DOUBLE * n) THEN 'holdout' ELSE 'train' END AS split FROM (SELECT *, {sql_rank(42, 'doc_id')} AS k, count(*) OVER () AS n FROM labels)) GROUP BY split",
)
def accuracy(spark, d):
    parts = splits.holdout_split(table(spark, d, "labels"), ["doc_id"], 0.3)
    return rounded(metrics.accuracy(parts, F.col("quality"), F.lit(1) - F.col("toxic"), ("split",)), "accuracy")


@query(
    "batch_mean_accuracy",
    f"SELECT count(*) AS batches, {sql_r6('avg(a)')} AS accuracy FROM (SELECT (k - 1) // 32 AS batch, avg({_HIT}::INTEGER::DOUBLE) AS a FROM "
    f"(SELECT *, {sql_rank(42, 'doc_id')} AS k, count(*) OVER () AS n FROM labels) WHERE (k - 1) // 32 < n // 32 GROUP BY 1)",
)
def batch_mean_accuracy(spark, d):
    out = metrics.batch_mean_accuracy(table(spark, d, "labels"), ["doc_id"], F.col("quality"), F.lit(1) - F.col("toxic"), 32)
    return rounded(out, "accuracy")


_SQL_TRUTH = SQL_PRICE_CODE.format(x="o_totalprice")
_SQL_SHIFTED = SQL_PRICE_CODE.format(x="o_totalprice * 0.9::DOUBLE")


def _shifted(spark, d):
    orders = table(spark, d, "orders")
    return orders, price_class_code(F.col("o_totalprice")), price_class_code(F.col("o_totalprice") * F.lit(0.9))


@query(
    "precision_per_class",
    "SELECT label, coalesce(precision, 0.0::DOUBLE) AS precision FROM (SELECT unnest([0, 1, 2, 3])::INTEGER AS label) LEFT JOIN "
    f"(SELECT g AS label, {sql_r6('avg((t = g)::INTEGER::DOUBLE)')} AS precision FROM (SELECT {_SQL_TRUTH} AS t, {_SQL_SHIFTED} AS g FROM orders) GROUP BY g) USING (label)",
)
def precision_per_class(spark, d):
    orders, truth, guess = _shifted(spark, d)
    return rounded(metrics.precision_per_class(orders, truth, guess, [0, 1, 2, 3]), "precision")


@query("precision_at_1", f"SELECT count(*) AS n, {sql_r6(f'avg({_HIT}::INTEGER::DOUBLE)')} AS p_at_1 FROM labels")
def precision_at_1(spark, d):
    return rounded(metrics.precision_at_1(table(spark, d, "labels"), F.col("quality"), F.lit(1) - F.col("toxic")), "p_at_1")


@query(
    "bias_variance",
    f"WITH s AS (SELECT {_HIT}::INTEGER::DOUBLE AS hit, k <= ceil(0.3::DOUBLE * n) AS held FROM (SELECT *, {sql_rank(42, 'doc_id')} AS k, count(*) OVER () AS n FROM labels)), "
    "a AS (SELECT avg(hit) FILTER (NOT held) AS t, avg(hit) FILTER (held) AS v FROM s) "
    f"SELECT {sql_r6('abs(100.0::DOUBLE - t * 100.0::DOUBLE)')} AS bias, {sql_r6('abs(t - v) * 100.0::DOUBLE')} AS variance FROM a",
)
def bias_variance(spark, d):
    parts = splits.holdout_split(table(spark, d, "labels"), ["doc_id"], 0.3)
    out = metrics.bias_variance(parts, F.col("quality"), F.lit(1) - F.col("toxic"), "split", "train", "holdout")
    return rounded(out, "bias", "variance")


FACTORS = [0.8, 0.9, 1.0, 1.1, 1.2]


def scored_configs(spark, d):
    """Each order under each configuration: a factor on the price before it is binned."""
    parts = splits.holdout_split(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.3)
    each = F.explode(F.array(*[F.struct(F.lit(f"x{f}").alias("config"), F.lit(f).alias("factor")) for f in FACTORS])).alias("c")
    rows = parts.select("split", "o_totalprice", each)
    return rows.select(
        "split", "c.config", price_class_code(F.col("o_totalprice")).alias("truth"),
        price_class_code(F.col("o_totalprice") * F.col("c.factor")).alias("guess"),
    )


def _sql_experiment() -> str:
    parts = {"train": "NOT held", "valid": "held"}
    cols = []
    for name, cond in parts.items():
        cols.append(f"avg(hit) FILTER ({cond}) AS acc_{name}")
        cols += [f"coalesce(avg(hit) FILTER ({cond} AND g = {c}), 0.0::DOUBLE) AS prec_{name}_{c}" for c in range(3)]
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    guess = SQL_PRICE_CODE.format(x="o_totalprice * f")
    return (
        f"WITH s AS (SELECT o_totalprice, k <= ceil(0.3::DOUBLE * n) AS held FROM (SELECT *, {sql_rank(42, 'o_orderkey')} AS k, count(*) OVER () AS n FROM orders)), "
        f"c AS (SELECT 'x' || f::VARCHAR AS config, held, {_SQL_TRUTH} AS t, {guess} AS g FROM s, (SELECT unnest([{', '.join(f'{f}::DOUBLE' for f in FACTORS)}]) AS f)), "
        f"a AS (SELECT config, {', '.join(cols)} FROM (SELECT *, (t = g)::INTEGER::DOUBLE AS hit FROM c) GROUP BY config) "
        f"SELECT config, {', '.join(f'{sql_r6(n)} AS {n}' for n in names)}, {sql_r6('abs(100.0::DOUBLE - acc_train * 100.0::DOUBLE)')} AS bias, "
        f"{sql_r6('abs(acc_train - acc_valid) * 100.0::DOUBLE')} AS variance FROM a"
    )


SQL_EXPERIMENT = _sql_experiment()


@query("experiment_table", SQL_EXPERIMENT)
def experiment_table(spark, d):
    out = metrics.experiment_table(scored_configs(spark, d), "config", "split", "train", "holdout", [0, 1, 2])
    return rounded(out, *[c for c in out.columns if c != "config"])


@query(
    "bin_then_score",
    f"SELECT count(*) AS n, {sql_r6('avg((t = g)::INTEGER::DOUBLE)')} AS accuracy, floor(count(*) FILTER (t = g) * 100.0::DOUBLE / count(*))::INTEGER AS percent FROM "
    f"(SELECT {_SQL_TRUTH} AS t, {_SQL_SHIFTED} AS g FROM orders)",
)
def bin_then_score(spark, d):
    orders, truth, guess = _shifted(spark, d)
    return rounded(metrics.accuracy(orders, truth, guess), "accuracy")


@query(
    "mean_l1_vectors",
    f"SELECT count(*) AS batches, {sql_r6('avg(m)')} AS mean_l1 FROM (SELECT (k - 1) // 32 AS batch, sum(s) / sum(c) AS m FROM "
    f"(SELECT list_sum(list_transform(v, lambda x, i: abs(noisy[i] - x))) AS s, len(v) AS c, {sql_rank(42, 'vec_id')} AS k FROM ({SQL_NOISY})) GROUP BY 1)",
)
def mean_l1_vectors(spark, d):
    return rounded(metrics.mean_l1_vectors(noisy_vectors(spark, d), ["vec_id"], "noisy", "v", 32), "mean_l1")


@query(
    "weighted_cross_entropy",
    "WITH z AS (SELECT label, v AS z FROM (" + EMB + ")), w AS (SELECT label, 1.0::DOUBLE / count(*) AS w FROM z GROUP BY label), "
    "c AS (SELECT label, ln(list_sum(list_transform(z, lambda x: exp(x)))) - z[label + 1] AS ce FROM z) "
    f"SELECT {sql_r6('sum(ce * w) / sum(w)')} AS weighted, {sql_r6('avg(ce)')} AS plain FROM c JOIN w USING (label)",
)
def weighted_cross_entropy(spark, d):
    emb = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("z"))
    return rounded(metrics.weighted_cross_entropy(emb, ["vec_id"], "z", "label"), "weighted", "plain")


@query(
    "vae_loss_terms",
    "SELECT " + sql_r6("sum(se)") + " AS squared_error, " + sql_r6("sum(kl)") + " AS divergence, " + sql_r6("sum(se) + sum(kl)") + " AS loss FROM "
    "(SELECT list_sum(list_transform(v, lambda x, i: (noisy[i] - x) * (noisy[i] - x))) AS se, "
    f"-0.5::DOUBLE * list_sum(list_transform(range(1, 33), lambda i: 1.0::DOUBLE + v[32 + i] - v[i] * v[i] - exp(v[32 + i]))) AS kl FROM ({SQL_NOISY}))",
)
def vae_loss_terms(spark, d):
    rows = noisy_vectors(spark, d).withColumns({"mean": F.slice("v", 1, 32), "log_var": F.slice("v", 33, 32)})
    return rounded(metrics.vae_loss_terms(rows, "v", "noisy", "mean", "log_var"), "squared_error", "divergence", "loss")


def _halves(spark, d):
    emb = table(spark, d, "embeddings").select("embedding", "label")
    return emb.where("label < 5"), emb.where("label >= 5")


NEWTON_STEPS = 30


def _sql_moments(groups: str) -> str:
    """Tables mu (grp, n, i, m) and cov (grp, i, j, x) of the vectors of ``groups`` (grp, v)."""
    return (
        f"s AS ({groups}), r AS (SELECT grp, row_number() OVER () AS k, v FROM s), "
        "b AS (SELECT grp, k, unnest(range(len(v))) AS i, unnest(v) AS x FROM r), "
        "mu AS (SELECT grp, count(*) AS n, i, avg(x) AS m FROM b GROUP BY grp, i), "
        "d AS (SELECT b.grp, k, b.i, x - m AS x, n FROM b JOIN mu ON b.grp = mu.grp AND b.i = mu.i), "
        "cov AS MATERIALIZED (SELECT p.grp, p.i, q.i AS j, sum(p.x * q.x) / (any_value(p.n) - 1) AS x FROM d p JOIN d q ON p.grp = q.grp AND p.k = q.k GROUP BY ALL)"
    )


def _sql_product(a: str, b: str, value: str = "sum(a.x * b.x)") -> str:
    return f"SELECT a.grp, a.i, b.j, {value} AS x FROM {a} a JOIN {b} b ON a.grp = b.grp AND a.j = b.i GROUP BY a.grp, a.i, b.j"


def _sql_root_trace(pairs: str) -> str:
    """Table root (grp, t): the trace of the square root of each matrix of ``pairs`` (grp, i, j, x), by Newton-Schulz steps.

    y goes to the root and z to its inverse, of the matrix over its norm; every step is a product of relations.
    """
    parts = [
        f"a AS MATERIALIZED ({pairs})", "norm AS (SELECT grp, sqrt(sum(x * x)) AS f FROM a GROUP BY grp)",
        "y0 AS MATERIALIZED (SELECT a.grp, i, j, x / f AS x FROM a JOIN norm ON a.grp = norm.grp)",
        "z0 AS MATERIALIZED (SELECT grp, i, j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x FROM a)",
    ]
    step = "(CASE WHEN a.i = b.j THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END) - 0.5::DOUBLE * sum(a.x * b.x)"
    for k in range(NEWTON_STEPS):
        parts.append(f"t{k} AS MATERIALIZED ({_sql_product(f'z{k}', f'y{k}', step)})")
        parts.append(f"y{k + 1} AS MATERIALIZED ({_sql_product(f'y{k}', f't{k}')})")
        if k < NEWTON_STEPS - 1:
            parts.append(f"z{k + 1} AS MATERIALIZED ({_sql_product(f't{k}', f'z{k}')})")
    parts.append(f"root AS (SELECT y.grp, sum(y.x) * sqrt(any_value(f)) AS t FROM y{NEWTON_STEPS} y JOIN norm ON y.grp = norm.grp WHERE i = j GROUP BY y.grp)")
    return ", ".join(parts)


def _sql_cov_product(where: str, grp: str) -> str:
    return f"SELECT {grp} AS grp, a.i, b.j, sum(a.x * b.x) AS x FROM cov a JOIN cov b ON a.j = b.i WHERE {where} GROUP BY ALL"


_SQL_HALVES = f"SELECT CASE WHEN label < 5 THEN 1 ELSE 2 END AS grp, v FROM ({EMB})"
_SQL_CLASSES = f"SELECT label::VARCHAR AS grp, v FROM ({EMB}) UNION ALL SELECT '*', v FROM ({EMB})"
_SQL_WHOLE = "(SELECT x FROM tr WHERE grp = '*')"


@query(
    "frechet_distance",
    f"WITH {_sql_moments(_SQL_HALVES)}, {_sql_root_trace(_sql_cov_product('a.grp = 1 AND b.grp = 2', '1'))}, "
    "g AS (SELECT sum((p.m - q.m) ** 2) AS gap, any_value(p.n) AS n1, any_value(q.n) AS n2 FROM mu p JOIN mu q ON p.i = q.i AND p.grp = 1 AND q.grp = 2) "
    f"SELECT n1, n2, {sql_r6('gap + (SELECT sum(x) FROM cov WHERE i = j) - 2 * t')} AS distance FROM g, root",
)
def frechet_distance(spark, d):
    return rounded(distributions.frechet_distance(*_halves(spark, d), "embedding"), "distance")


@query(
    "frechet_parts",
    "WITH e AS (SELECT label < 5 AS low, (unnest(range(len(v))))::INTEGER AS pos, unnest(v) AS x FROM (" + EMB + ")), "
    "m AS (SELECT pos, avg(x) FILTER (low) - avg(x) FILTER (NOT low) AS gap, var_samp(x) FILTER (low) AS v1, var_samp(x) FILTER (NOT low) AS v2 FROM e GROUP BY pos) "
    f"SELECT {sql_r6('sum(gap * gap)')} AS mean_gap, {sql_r6('sum(v1)')} AS trace_1, {sql_r6('sum(v2)')} AS trace_2 FROM m",
)
def frechet_parts(spark, d):
    return rounded(distributions.frechet_parts(*_halves(spark, d), "embedding"), "mean_gap", "trace_1", "trace_2")


@query(
    "frechet_by_class",
    f"WITH {_sql_moments(_SQL_CLASSES)}, {_sql_root_trace(_sql_cov_product('''a.grp <> '*' AND b.grp = '*' ''', 'a.grp'))}, "
    "g AS (SELECT p.grp, sum((p.m - q.m) ** 2) AS gap, any_value(p.n) AS n FROM mu p JOIN mu q ON p.i = q.i AND q.grp = '*' WHERE p.grp <> '*' GROUP BY p.grp), "
    "tr AS (SELECT grp, sum(x) AS x FROM cov WHERE i = j GROUP BY grp) "
    f"SELECT g.grp, n, {sql_r6(f'gap + tr.x + {_SQL_WHOLE} - 2 * t')} AS distance FROM g JOIN root ON g.grp = root.grp JOIN tr ON g.grp = tr.grp",
)
def frechet_by_class(spark, d):
    return rounded(distributions.frechet_by_class(table(spark, d, "embeddings"), "embedding", "label"), "distance")
