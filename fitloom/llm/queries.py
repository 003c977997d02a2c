"""The registered queries of this subpackage, one per operator, and their SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.llm import decontaminate, hard_negatives, learned_ann, license_align, lsh_forest, packing, ppm, secret_crf, spelling_variants, substring_index, url_rules, warc, weak_quality
from fitloom.llm.store import saved
from fitloom.session import scratch_path
from fitloom.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query("op1_url_rules")
def op1(spark, folder):
    """Pages are labelled by the ratings of the documents of the same number."""
    return url_rules.judge(table(spark, folder, "pages"), ratings(spark, folder), URL_RULES)


@query("op2_licenses")
def op2(spark, folder):
    return license_align.scan(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_repeats")
def op3(spark, folder):
    return substring_index.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query("op4_neighbours")
def op4(spark, folder):
    return learned_ann.search(table(spark, folder, "embeddings"))


@query("op5_pack")
def op5(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer_path()).drop("ids")


def ratings(spark, folder):
    """Ratings of documents: bad if of low quality or toxic."""
    return table(spark, folder, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))


@query("op6_quality")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return weak_quality.score(docs, weak_quality.fit(docs, ratings(spark, folder))).drop("text")


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


@query("op7_secrets")
def op7(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_crf.scan(docs, secret_crf.fit(docs))
    counts = {f"n_{k}": F.size(F.expr(f"filter(base, s -> s.kind = '{k}')")).cast("bigint") for k in secret_crf.KINDS[:3]}
    return found.select(
        "doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("found").alias("spans")
    )


@query("op8_near_dedup")
def op8(spark, folder):
    return lsh_forest.near_duplicates(table(spark, folder, "documents"))


@query(
    "op9_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d),
    r AS (SELECT *, payload_bytes >= 1000 AND page_id <> last AS again FROM m)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN last END AS refers_to FROM r
    """,
)
def op9(spark, folder):
    files = scratch_path(spark, "warc")
    rows = saved(warc.write_monolithic(table(spark, folder, "pages"), files), "warc-rows")
    done = saved(warc.normalise(warc.revisits(rows), files), "warc-archives")
    return warc.read_members(done, files)



@query("op10_decontaminate")
def op10(spark, folder):
    found = decontaminate.find_leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_SQL_CRC = """
    crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)
"""


def _sql_crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of an SQL string, beside the column ``t`` of the table ``crc``."""
    octets = f"list_transform(range(1, strlen({text}) * 2, 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)"
    step = "xor(c >> 8, t[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295)"


@query(
    "op11_spelling",
    f"""
    WITH RECURSIVE {_SQL_CRC},
    runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
             FROM documents),
    once AS (SELECT doc_id, run, count(*) AS n, doc_id::VARCHAR || ':' || run AS named FROM runs GROUP BY ALL),
    hashed AS (SELECT run, n, {_sql_crc32("named")} AS h FROM once, crc),
    made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cuts AS (SELECT word, i, substr(word, 1, i - 1) AS p, substr(word, i + 1) AS q FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (SELECT a.word AS word, b.word AS near FROM cuts a JOIN cuts b ON a.i = b.i AND a.p = b.p AND a.q = b.q AND a.word <> b.word
             UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.p || c.q
             UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.p || c.q),
    ranked AS (SELECT r.word, r.near, w.n, count(*) OVER (PARTITION BY r.word) AS n_near,
                      row_number() OVER (PARTITION BY r.word ORDER BY w.n DESC, r.near) AS place FROM near r JOIN words w ON w.word = r.near),
    forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN r.n >= 2 * w.n THEN near END AS form,
                     CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
    ways AS (SELECT word, word AS at FROM forms UNION ALL SELECT y.word, f.form FROM ways y JOIN forms f ON f.word = y.at WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, y.at AS root, f.n, f.n_near, f.form_n
    FROM forms f JOIN ways y USING (word) JOIN forms l ON l.word = y.at WHERE l.form IS NULL
    """,
)
def op11(spark, folder):
    found = spelling_variants.runs(table(spark, folder, "documents"), least=spelling_variants.MIN_LENGTH)
    return spelling_variants.group_variants(spelling_variants.vocabulary(spelling_variants.with_slips(found)))


@query(
    "op13_hard_negatives",
    """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
    scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
               FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    neg AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id AS negative_id, positive_score, score AS negative_score
            FROM pos JOIN scored USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT * FROM neg WHERE rank <= 3
    """,
)
def op13(spark, folder):
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query("op12_lm_score")
def op12(spark, folder):
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    return ppm.score(table(spark, folder, "documents"), train)
