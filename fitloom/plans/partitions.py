"""Splits, shuffles, batches, encoding and scaling."""


from fitloom.operators import encode, splits
from fitloom.operators.levels import level_index
from fitloom.plans.registry import LINE_IDS, entries, query, rounded, sql_entries, sql_r6, sql_rank
from fitloom.sources.readers import table


def _ranked(tab: str, key: str, seed: int = 42, cols: str = "", where: str = "") -> str:
    extra = f", {cols}" if cols else ""
    return f"SELECT {key}{extra}, {sql_rank(seed, key)} AS k, count(*) OVER () AS n FROM {tab} {where}"


@query(
    "holdout_split",
    f"SELECT doc_id, CASE WHEN k <= ceil(0.3::DOUBLE * n) THEN 'holdout' ELSE 'train' END AS split FROM ({_ranked('documents', 'doc_id')})",
)
def holdout_split(spark, d):
    return splits.holdout_split(table(spark, d, "documents").select("doc_id"), ["doc_id"], 0.3)


@query(
    "three_way_split",
    f"WITH r AS ({_ranked('orders', 'o_orderkey')}), h AS (SELECT o_orderkey FROM r WHERE k <= ceil(0.3::DOUBLE * n)), "
    f"q AS ({_ranked('h', 'o_orderkey', 43)}) "
    "SELECT r.o_orderkey, CASE WHEN q.o_orderkey IS NULL THEN 'train' WHEN q.k <= ceil(0.33::DOUBLE * q.n) THEN 'test' "
    "ELSE 'validate' END AS split FROM r LEFT JOIN q ON r.o_orderkey = q.o_orderkey",
)
def three_way_split(spark, d):
    return splits.three_way_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    "train_fraction_split",
    f"SELECT event_id, CASE WHEN k <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'valid' END AS split FROM ({_ranked('events', 'event_id')})",
)
def train_fraction_split(spark, d):
    return splits.train_fraction_split(table(spark, d, "events").select("event_id"), ["event_id"])


@query(
    "fraction_split",
    "SELECT vec_id, CASE WHEN k <= floor(n * 0.8::DOUBLE) + (CASE WHEN n - floor(n * 0.8::DOUBLE) - floor(n * 0.2::DOUBLE) > 0 THEN 1 ELSE 0 END) "
    f"THEN 0 ELSE 1 END::INTEGER AS part FROM ({_ranked('embeddings', 'vec_id')})",
)
def fraction_split(spark, d):
    return splits.fraction_split(table(spark, d, "embeddings").select("vec_id"), ["vec_id"], [0.8, 0.2])


@query(
    "stratified_split",
    "SELECT doc_id, lang, CASE WHEN k <= round_even(n * 0.7::DOUBLE, 0) THEN 'train' "
    "WHEN k <= round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.2::DOUBLE, 0) THEN 'validate' ELSE 'test' END AS split FROM "
    f"(SELECT doc_id, lang, {sql_rank(42, 'doc_id', by='lang')} AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)",
)
def stratified_split(spark, d):
    return splits.stratified_split(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], "lang")


@query("index_within_class", f"SELECT doc_id, lang, {sql_rank(42, 'doc_id', by='lang')} - 1 AS idx FROM documents")
def index_within_class(spark, d):
    return splits.index_within_class(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], "lang")


@query("shuffle_rows", f"SELECT doc_id, quality, {sql_rank(45, 'doc_id')} AS rank FROM labels")
def shuffle_rows(spark, d):
    return splits.shuffle_rows(table(spark, d, "labels").select("doc_id", "quality"), ["doc_id"], seed=42, epoch=3)


@query("assign_batches", f"SELECT event_id, (k - 1) // 32 AS batch FROM ({_ranked('events', 'event_id')}) WHERE (k - 1) // 32 < n // 32")
def assign_batches(spark, d):
    return splits.assign_batches(table(spark, d, "events").select("event_id"), ["event_id"], 32, drop_last=True)


_ONE_HOT = {"o_orderpriority": ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "o_orderstatus": ["O", "P"]}
_SQL_ONE_HOT = ", ".join(
    f"(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END)::DOUBLE AS \"{c}_{v}\"" for c, vs in _ONE_HOT.items() for v in vs
)


@query("one_hot_drop_first", f"SELECT o_orderkey, {_SQL_ONE_HOT} FROM orders")
def one_hot_drop_first(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return encode.one_hot_apply(orders, encode.one_hot_levels(orders, ["o_orderpriority", "o_orderstatus"]))


@query(
    "one_hot_apply",
    f"SELECT o_orderkey, {_SQL_ONE_HOT} FROM ({_ranked('orders', 'o_orderkey', cols='o_orderpriority, o_orderstatus')}) WHERE k <= ceil(0.3::DOUBLE * n)",
)
def one_hot_apply(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    parts = splits.holdout_split(orders, ["o_orderkey"], 0.3)
    levels = encode.one_hot_levels(parts.where("split = 'train'"), ["o_orderpriority", "o_orderstatus"])
    return encode.one_hot_apply(parts.where("split = 'holdout'").drop("split"), levels)


_LEVEL_COLUMNS = ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]


def _sql_levels(fitted: str, applied: str) -> str:
    """(o_orderkey, index) of the ones in ``applied`` under levels of ``fitted``; columns follow each other without their first level."""
    ranks = " UNION ALL ".join(
        f"SELECT {i} AS place, {c}::VARCHAR AS level, row_number() OVER (ORDER BY {c}) AS k FROM (SELECT DISTINCT {c} FROM ({fitted}))"
        for i, c in enumerate(_LEVEL_COLUMNS)
    )
    cells = " UNION ALL ".join(f"SELECT o_orderkey, {i} AS place, {c}::VARCHAR AS level FROM ({applied})" for i, c in enumerate(_LEVEL_COLUMNS))
    before = "(SELECT coalesce(sum(w), 0) FROM (SELECT place AS q, max(k) - 1 AS w FROM l GROUP BY place) WHERE q < l.place)"
    return f"WITH l AS ({ranks}), c AS ({cells}) SELECT o_orderkey, (k - 2 + {before})::BIGINT AS index FROM c JOIN l USING (place, level) WHERE k > 1"


_SQL_LEVEL_ROWS = _ranked("orders", "o_orderkey", cols=", ".join(_LEVEL_COLUMNS))


@query("one_hot_index", _sql_levels("SELECT * FROM orders", "SELECT * FROM orders"))
def one_hot_index(spark, d):
    """A level for every customer and day: places of the ones, no column per level."""
    orders = table(spark, d, "orders").select("o_orderkey", *_LEVEL_COLUMNS)
    return level_index(orders, _LEVEL_COLUMNS).rows(orders, ["o_orderkey"])


@query(
    "one_hot_index_apply",
    _sql_levels(f"SELECT * FROM ({_SQL_LEVEL_ROWS}) WHERE k > ceil(0.3::DOUBLE * n)", f"SELECT * FROM ({_SQL_LEVEL_ROWS}) WHERE k <= ceil(0.3::DOUBLE * n)"),
)
def one_hot_index_apply(spark, d):
    """Levels of the training rows, applied to the others beyond the limit of a broadcast."""
    parts = splits.holdout_split(table(spark, d, "orders").select("o_orderkey", *_LEVEL_COLUMNS), ["o_orderkey"], 0.3)
    index = level_index(parts.where("split = 'train'"), _LEVEL_COLUMNS)
    return index.rows(parts.where("split = 'holdout'"), ["o_orderkey"], limit=0)


_SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "standard_scale_fit",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {sql_r6(f'avg({c})')} AS mean, {sql_r6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END')} AS std FROM lineitem"
        for c in _SCALED
    ),
)
def standard_scale_fit(spark, d):
    return rounded(encode.scale_table(table(spark, d, "lineitem"), _SCALED), "mean", "std")


@query(
    "standard_scale_apply",
    f"WITH r AS (SELECT *, {sql_rank(42, *LINE_IDS)} AS k, count(*) OVER () AS n FROM lineitem), "
    "s AS (SELECT *, CASE WHEN k <= ceil(0.3::DOUBLE * n) THEN 'holdout' ELSE 'train' END AS split FROM r), "
    "p AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED) + " FROM s WHERE split = 'train') "
    f"SELECT {', '.join(LINE_IDS)}, split, " + ", ".join(f"{sql_r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in _SCALED) + " FROM s, p",
)
def standard_scale_apply(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_IDS, *_SCALED)
    parts = splits.holdout_split(lines, LINE_IDS, 0.3)
    scaler = encode.standard_scale_fit(parts.where("split = 'train'"), _SCALED)
    return rounded(scaler.apply(parts), *_SCALED)


@query(
    "scale_selected",
    "WITH p AS (SELECT avg(p_size) AS ms, stddev_pop(p_size) AS ss, avg(p_retailprice) AS mp, stddev_pop(p_retailprice) AS sp FROM part) "
    f"SELECT p_partkey, {sql_r6('(p_size - ms) / ss')} AS p_size, {sql_r6('(p_retailprice - mp) / sp')} AS p_retailprice, "
    + ", ".join(f"(CASE WHEN p_type = '{v}' THEN 1.0 ELSE 0.0 END)::DOUBLE AS \"p_type_{v}\"" for v in ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    + " FROM part, p",
)
def scale_selected(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    coded = encode.one_hot_apply(part, encode.one_hot_levels(part, ["p_type"]))
    cols = ["p_size", "p_retailprice"]
    return rounded(encode.standard_scale_fit(coded, cols).apply(coded), *cols)


@query(
    "assemble_features",
    sql_entries(f"SELECT {', '.join(LINE_IDS)}, [l_quantity, l_extendedprice, l_discount, l_tax] AS v FROM lineitem", ", ".join(LINE_IDS)),
)
def assemble_features(spark, d):
    lines = encode.assemble_features(table(spark, d, "lineitem"), _SCALED)
    return entries(lines, LINE_IDS, "features")
