"""Named queries over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder)``; without ``sql`` only rows can be checked."""

    def add(f):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def r6(col: Column | str) -> Column:
    """Six decimals; adding zero turns a negative zero into a plain one."""
    return F.round(F.col(col) if isinstance(col, str) else col, 6) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


def entries(df: DataFrame, ids: list[str], vec: str, kind: str = "double") -> DataFrame:
    """One row per array entry (ids, pos, value)."""
    # outer, since for an inner one Catalyst computes the array once more to filter by its size
    out = df.select(*ids, F.posexplode_outer(vec).alias("pos", "value")).where(F.col("pos").isNotNull())
    return out.withColumn("value", r6("value")) if kind == "double" else out


# --- SQL text shared by the oracles ---


def sql_r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0::DOUBLE)"


def sql_entries(base: str, ids: str, vec: str = "v", kind: str = "double") -> str:
    """SQL of ``entries`` for a sub-query ``base`` with an array column."""
    value = f"{vec}[i]" if kind != "double" else sql_r6(f"{vec}[i]")
    return (
        f"SELECT {ids}, (i - 1)::INTEGER AS pos, {value} AS value FROM "
        f"(SELECT {ids}, {vec}, unnest(range(1, len({vec}) + 1)) AS i FROM ({base}))"
    )


def sql_key(seed: int, *ids: str) -> str:
    text = " || ':' || ".join(f"{i}::VARCHAR" for i in ids)
    return f"md5({text} || ':{seed}')"


def sql_rank(seed: int, *ids: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY {sql_key(seed, *ids)}, {', '.join(ids)})"


def _sql_word(text: str, start: int) -> str:
    return f"(('0x' || substr(md5({text}), {start}, 8))::BIGINT)::DOUBLE"


def sql_uniform(text: str) -> str:
    """``text`` is an SQL string expression, the parts joined by ':'."""
    return f"({_sql_word(text, 1)} / 4294967296.0::DOUBLE)"


def sql_gauss(text: str) -> str:
    return (
        f"(sqrt(-2.0::DOUBLE * ln(({_sql_word(text, 1)} + 1.0::DOUBLE) / 4294967297.0::DOUBLE))"
        f" * cos(2.0::DOUBLE * pi() * {_sql_word(text, 9)} / 4294967296.0::DOUBLE))"
    )


LANG_RATING = {"en": 4, "fr": 3, "de": 2, "es": 1}


def rating(lang: Column) -> Column:
    """Language as stand-in for a rating of 0 to 4."""
    out = F.lit(0)
    for name, code in LANG_RATING.items():
        out = F.when(lang == name, code).otherwise(out)
    return out


SQL_RATING = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_RATING.items()) + " ELSE 0 END"

SQL_PRICE_CODE = "CASE WHEN {x} < 100000 THEN 0 WHEN {x} < 350000 THEN 1 ELSE 2 END"
SQL_PRICE_NAME = "CASE WHEN {x} < 100000 THEN 'cheap' WHEN {x} < 350000 THEN 'average' ELSE 'expensive' END"

EMB = "SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings"
EMB_COUNT = "(SELECT count(*) FROM embeddings)"
LINE_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
