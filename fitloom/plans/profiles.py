"""Profiling queries."""

from pyspark.sql import functions as F

from fitloom.functions.classes import price_class_name
from fitloom.operators import distributions, profile, scan
from fitloom.plans.registry import EMB, SQL_PRICE_NAME, query, rounded, sql_r6
from fitloom.sources.readers import table

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {sql_r6(f'avg({c})')} AS mean, {sql_r6(f'stddev_samp({c})')} AS std, min({c}) AS min, "
        + ", ".join(f"{sql_r6(f'quantile_cont({c}, {p})')} AS p{round(100 * p)}" for p in profile.QUARTILES)
        + f", max({c}) AS max FROM lineitem"
        for c in NUM
    ),
)
def describe(spark, d):
    return rounded(profile.describe(table(spark, d, "lineitem"), NUM), "mean", "std", "p25", "p50", "p75")


@query(
    "null_count",
    "WITH t AS (SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), "
    + "c AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM t" for c in ["doc_id", "lang", "n_chars", "quality", "toxic"])
    + ") SELECT * FROM c UNION ALL SELECT '*', sum(nulls)::BIGINT FROM c",
)
def null_count(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return profile.null_count(docs.join(table(spark, d, "labels"), "doc_id", "left"))


@query(
    "corr_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {sql_r6(f'corr({a}, {b})')} AS corr FROM lineitem" for a in NUM for b in NUM),
)
def corr_matrix(spark, d):
    return rounded(profile.corr_matrix(table(spark, d, "lineitem"), NUM), "corr")


@query("class_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def class_counts(spark, d):
    return profile.class_counts(table(spark, d, "events"), "event_type")


@query(
    "class_percent",
    f"SELECT name, n, {sql_r6('n * 100.0::DOUBLE / sum(n) OVER ()')} AS percent FROM "
    f"(SELECT {SQL_PRICE_NAME.format(x='o_totalprice')} AS name, count(*) AS n FROM orders GROUP BY 1)",
)
def class_percent(spark, d):
    named = table(spark, d, "orders").select(price_class_name(F.col("o_totalprice")).alias("name"))
    return rounded(profile.class_percent(named, "name"), "percent")


@query("class_weights", "SELECT lang, 1.0::DOUBLE / count(*) AS weight FROM documents GROUP BY lang")
def class_weights(spark, d):
    return profile.class_weights(table(spark, d, "documents"), "lang")


def _sql_profile(tab: str, col: str) -> str:
    return (
        f"SELECT '{col}' AS \"column\", {sql_r6('q1')} AS q1, {sql_r6('q2')} AS median, {sql_r6('q3')} AS q3, bin, count(*) AS n FROM ("
        f"SELECT q1, q2, q3, least(floor(({col} - lo) / ((hi - lo) / 20)), 19)::INTEGER AS bin FROM {tab}, "
        f"(SELECT min({col}) AS lo, max({col}) AS hi, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS q2, "
        f"quantile_cont({col}, 0.75) AS q3 FROM {tab})) GROUP BY ALL"
    )


@query("distribution_profile", _sql_profile("lineitem", "l_extendedprice") + " UNION ALL " + _sql_profile("customer", "c_acctbal"))
def distribution_profile(spark, d):
    price = profile.distribution_profile(table(spark, d, "lineitem"), "l_extendedprice")
    balance = profile.distribution_profile(table(spark, d, "customer"), "c_acctbal")
    return rounded(price.unionByName(balance), "q1", "median", "q3")


@query("class_amount", "SELECT count(DISTINCT label) AS classes FROM embeddings")
def class_amount(spark, d):
    return profile.class_amount(table(spark, d, "embeddings"), "label")


@query(
    "mean_vector",
    f"SELECT pos, {sql_r6('avg(x)')} AS mean FROM (SELECT (unnest(range(len(v))))::INTEGER AS pos, unnest(v) AS x FROM ({EMB})) GROUP BY pos",
)
def mean_vector(spark, d):
    return rounded(distributions.mean_vector(table(spark, d, "embeddings"), "embedding"), "mean")


@query(
    "covariance_matrix",
    f"WITH e AS (SELECT vec_id, (unnest(range(len(v))))::INTEGER AS pos, unnest(v) AS x FROM ({EMB})) "
    f"SELECT a.pos AS i, b.pos AS j, {sql_r6('covar_samp(a.x, b.x)')} AS cov FROM e a JOIN e b USING (vec_id) GROUP BY a.pos, b.pos",
)
def covariance_matrix(spark, d):
    return rounded(distributions.covariance_matrix(table(spark, d, "embeddings"), "embedding"), "cov")


@query(
    "epoch_mean_loss",
    f"SELECT ts::DATE::VARCHAR AS epoch, {sql_r6('avg(value)')} AS mean_loss, {sql_r6('sum(value)')} AS sum_loss, "
    f"{sql_r6('sum(value) / 2000.0::DOUBLE')} AS scaled_loss FROM events GROUP BY 1",
)
def epoch_mean_loss(spark, d):
    epoch = F.to_date("ts").cast("string")
    return rounded(profile.epoch_loss(table(spark, d, "events"), epoch, "value"), "mean_loss", "sum_loss", "scaled_loss")


def _daily(spark, d):
    """Per calendar day a factor in (0, 1) that falls with the day's share of all events."""
    events = table(spark, d, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    total = events.agg(F.sum("n")).scalar()
    return events.select("day", (F.lit(1.0) - F.lit(0.5) * F.col("n") / total).alias("factor"))


_SQL_DAILY = (
    "SELECT ts::DATE::VARCHAR AS day, 1.0::DOUBLE - 0.5::DOUBLE * count(*) / (SELECT count(*) FROM events) AS factor FROM events GROUP BY 1"
)


@query(
    "running_product",
    f"SELECT day, {sql_r6('factor')} AS factor, {sql_r6('exp(sum(ln(factor)) OVER (ORDER BY day))')} AS product FROM ({_SQL_DAILY})",
)
def running_product(spark, d):
    return rounded(scan.running_product(_daily(spark, d), "factor", "day"), "factor", "product")


@query(
    "shift_with_default",
    f"SELECT day, {sql_r6('factor')} AS factor, {sql_r6('lag(factor, 1, 1.0) OVER (ORDER BY day)')} AS previous FROM ({_SQL_DAILY})",
)
def shift_with_default(spark, d):
    return rounded(scan.shift_with_default(_daily(spark, d), "factor", "day", 1.0), "factor", "previous")


# Every event turns the sign or not and moves the product a little; the order is that of time, ties by number.
_SQL_FACTORS = "SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END * (1.0::DOUBLE + ((event_id % 7) - 3) / 1000.0::DOUBLE) AS factor FROM events"


def _factors(spark, d):
    sign = F.when(F.col("event_id") % 3 == 0, -1.0).otherwise(1.0)
    return table(spark, d, "events").select("event_id", "ts", (sign * (F.lit(1.0) + (F.col("event_id") % 7 - 3) / F.lit(1000.0))).alias("factor"))


@query(
    "running_product_rows",
    f"SELECT event_id, {sql_r6('exp(sum(ln(abs(factor))) OVER w) * CASE WHEN count(*) FILTER (factor < 0) OVER w % 2 = 1 THEN -1 ELSE 1 END')} AS product "
    f"FROM ({_SQL_FACTORS}) WINDOW w AS (ORDER BY ts, event_id)",
)
def running_product_rows(spark, d):
    return rounded(scan.running_product(_factors(spark, d), "factor", ["ts", "event_id"]).select("event_id", "product"), "product")


@query("shift_rows", "SELECT event_id, lag(event_id, 1, -1) OVER (ORDER BY ts, event_id) AS previous FROM events")
def shift_rows(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    return scan.shift_with_default(events, "event_id", ["ts", "event_id"], -1).select("event_id", "previous")


_MANY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey"]


def _gappy(c: str) -> str:
    return f"CASE WHEN (l_orderkey + l_linenumber) % {7 + _MANY.index(c)} <> 0 THEN {c}::DOUBLE END"


@query(
    "corr_matrix_gaps",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {sql_r6(f'corr({_gappy(a)}, {_gappy(b)})')} AS corr FROM lineitem" for a in _MANY for b in _MANY),
)
def corr_matrix_gaps(spark, d):
    """Cells are missing in every column, in other rows each; a pair is over the rows that have both."""
    lines = table(spark, d, "lineitem")
    cells = [F.when((F.col("l_orderkey") + F.col("l_linenumber")) % (7 + i) != 0, F.col(c).cast("double")).alias(c) for i, c in enumerate(_MANY)]
    return rounded(profile.corr_matrix(lines.select(*cells), _MANY), "corr")
