"""Projections, filters, lookups, ordering and set operations."""

from pyspark.sql import functions as F

from fitloom.functions.classes import cast_numeric, price_class_code, price_class_name
from fitloom.operators import augment, encode, joins, profile, splits
from fitloom.plans.registry import EMB, SQL_PRICE_CODE, SQL_PRICE_NAME, query, sql_key, sql_rank
from fitloom.sources.readers import table


@query("select_target_features", "SELECT l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def select_target_features(spark, d):
    out = encode.select_target_features(
        table(spark, d, "lineitem"), "l_extendedprice", drop=("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    )
    return out.select("l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_linenumber")


@query("filter_by_class", "SELECT text FROM documents WHERE lang = 'de'")
def filter_by_class(spark, d):
    return encode.filter_by_class(table(spark, d, "documents"), "lang", "de", ["text"])


@query("price_class_code", f"SELECT o_orderkey, ({SQL_PRICE_CODE.format(x='o_totalprice')})::INTEGER AS code FROM orders")
def price_code(spark, d):
    return table(spark, d, "orders").select("o_orderkey", price_class_code(F.col("o_totalprice")).alias("code"))


@query("price_class_name", f"SELECT o_orderkey, {SQL_PRICE_NAME.format(x='o_totalprice')} AS name FROM orders")
def price_name(spark, d):
    return table(spark, d, "orders").select("o_orderkey", price_class_name(F.col("o_totalprice")).alias("name"))


@query(
    "split_num_cat",
    "SELECT p_partkey, p_size::DOUBLE AS num_0, p_retailprice AS num_1, "
    + ", ".join(
        f"(CASE WHEN p_type = '{v}' THEN 1.0 ELSE 0.0 END)::DOUBLE AS cat_{i}"
        for i, v in enumerate(["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    )
    + " FROM part",
)
def split_num_cat(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    coded = encode.one_hot_apply(part, encode.one_hot_levels(part, ["p_type"]))
    cat = [c for c in coded.columns if c.startswith("p_type_")]
    pair = encode.split_num_cat(coded, ["p_size", "p_retailprice"], cat)
    return pair.select(
        "p_partkey", *[F.get("num", F.lit(i)).alias(f"num_{i}") for i in range(2)],
        *[F.get("cat", F.lit(i)).alias(f"cat_{i}") for i in range(len(cat))],
    )


_LINE_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
    ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@query(
    "list_columns",
    " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS pos, '{c}' AS \"column\", '{t}' AS type, count({c}) AS n FROM lineitem" for i, (c, t) in enumerate(_LINE_TYPES)
    ),
)
def list_columns(spark, d):
    return profile.list_columns(table(spark, d, "lineitem"))


@query(
    "reset_index",
    f"WITH r AS (SELECT doc_id, {sql_rank(42, 'doc_id')} AS k, count(*) OVER () AS n FROM documents), "
    "t AS (SELECT doc_id FROM r WHERE k > ceil(0.3::DOUBLE * n)) "
    f"SELECT doc_id, {sql_rank(7, 'doc_id')} - 1 AS idx FROM t",
)
def reset_index(spark, d):
    docs = splits.holdout_split(table(spark, d, "documents").select("doc_id"), ["doc_id"], 0.3, 42)
    return splits.reset_index(docs.where("split = 'train'").drop("split"), ["doc_id"], 7)


@query(
    "cast_numeric",
    "SELECT l_orderkey, l_linenumber, TRY_CAST(l_extendedprice AS BIGINT) AS price, "
    "TRY_CAST(l_returnflag AS DOUBLE) AS flag, l_linenumber::DOUBLE AS line FROM "
    "(SELECT l_orderkey, l_linenumber, floor(l_extendedprice) AS l_extendedprice, l_returnflag FROM lineitem)",
)
def cast_numeric_query(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", cast_numeric(F.col("l_extendedprice"), "bigint").alias("price"),
        cast_numeric(F.col("l_returnflag"), "double").alias("flag"), cast_numeric(F.col("l_linenumber"), "double").alias("line"),
    )


@query(
    "label_lookup",
    "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def label_lookup(spark, d):
    names = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.label_lookup(table(spark, d, "nation"), names, "n_regionkey", ["n_nationkey"]).select("n_nationkey", "n_name", "r_name")


@query("label_lookup_hot", "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_returnflag) AS lines FROM lineitem")
def label_lookup_hot(spark, d):
    """Three return flags share all rows: beyond the limit of a broadcast the hot keys are split by their counts."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    counts = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))
    return joins.attach_by_key(lines, counts, ["l_returnflag"], ["l_orderkey", "l_linenumber"], "left", limit=0).select("l_orderkey", "l_linenumber", "lines")


@query("align_columns", "SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def align_columns(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.align_columns(docs, table(spark, d, "labels"), ["doc_id"], drop=("source",))


@query("head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query("take_first_n", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 1000")
def take_first_n(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label").orderBy("vec_id").limit(1000)


@query("take_range", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 100 OFFSET 10")
def take_range(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label").orderBy("vec_id").offset(10).limit(100)


@query("first_batch", f"SELECT vec_id, label FROM ({EMB}) ORDER BY {sql_key(42, 'vec_id')}, vec_id LIMIT 32")
def first_batch(spark, d):
    return splits.first_batch(table(spark, d, "embeddings").select("vec_id", "label"), ["vec_id"], 32)


@query(
    "cap_rows",
    f"WITH c AS (SELECT greatest(count(*) FILTER (lang = 'en') - count(*) FILTER (lang = 'fr'), 0) AS k FROM documents), "
    f"r AS (SELECT doc_id, lang, {sql_rank(42, 'doc_id')} AS p FROM documents WHERE lang = 'en') "
    "SELECT doc_id, lang FROM r, c WHERE p <= k",
)
def cap_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    n = docs.agg(F.count_if(F.col("lang") == "en").alias("en"), F.count_if(F.col("lang") == "fr").alias("fr")).first()
    return splits.cap_rows(docs.where("lang = 'en'"), ["doc_id"], n["en"] - n["fr"])


@query(
    "sorted_class_counts",
    "SELECT event_type, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, event_type))::INTEGER AS place FROM events GROUP BY event_type",
)
def sorted_class_counts(spark, d):
    from pyspark.sql import Window as W

    counts = profile.sorted_class_counts(table(spark, d, "events"), "event_type")
    return counts.withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "event_type")))


@query(
    "append_rows",
    "WITH u AS (SELECT doc_id, lang, 'first' AS part, 0 AS frame FROM documents UNION ALL SELECT doc_id, upper(lang), 'second', 1 FROM documents) "
    f"SELECT doc_id, lang, part, {sql_rank(42, 'frame', 'doc_id')} - 1 AS idx FROM u",
)
def append_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    second = docs.select(F.upper("lang").alias("lang"), F.lit("second").alias("part"), "doc_id")
    return augment.append_rows(docs.withColumn("part", F.lit("first")), second, ids=["doc_id"])
