"""Reading and writing: CSV, labelled folders, images, predictions, reports."""

import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from fitloom.functions.classes import price_class_code
from fitloom.operators import metrics, splits
from fitloom.operators.joins import kept
from fitloom.plans.evaluation import SQL_EXPERIMENT, scored_configs
from fitloom.plans.registry import SQL_PRICE_CODE, query, rounded, sql_rank
from fitloom.plans.vectors import _SQL_PX, images
from fitloom.session import scratch_path
from fitloom.sources import readers, writers
from fitloom.sources.readers import table


@query(
    "csv_scan",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders",
)
def csv_scan(spark, d):
    orders = table(spark, d, "orders")
    orders = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    path = scratch_path(spark, "orders-csv")
    orders.select(F.col("o_orderkey").alias("stray"), "*").write.csv(path, header=True, escape='"')
    kinds = ", ".join(f"{name} {kind}" for name, kind in orders.dtypes)
    return readers.csv_scan(spark, path, f"stray string, {kinds}", drop=("stray",))


@query(
    "labelled_folder_scan",
    "SELECT 'c' || label || '/' || vec_id || '.txt' AS file, 'c' || label AS class_name, (dense_rank() OVER (ORDER BY 'c' || label) - 1)::INTEGER AS class_idx FROM embeddings",
)
def labelled_folder_scan(spark, d):
    """Every vector as a file in the folder of its label; the scan gives each file once, with its class."""
    path = scratch_path(spark, "labelled")
    vectors = table(spark, d, "embeddings")
    write_text_files(vectors.select("vec_id", F.concat(F.lit("c"), "label").alias("folder"), F.to_json("embedding").alias("text")), path)
    found = readers.labelled_folder_scan(spark, path, "*.txt")
    return found.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("file"), "class_name", "class_idx")


@query(
    "class_index",
    "SELECT doc_id, source, (dense_rank() OVER (ORDER BY source) - 1)::INTEGER AS class_idx FROM documents",
)
def class_index(spark, d):
    return readers.with_class_index(table(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"])


def _png(rgb: np.ndarray) -> bytes:
    """Smallest valid colour PNG of an (h, w, 3) byte array."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w, _ = rgb.shape
    lines = b"".join(b"\x00" + row.tobytes() for row in rgb)
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def _files_below(path: str):
    """(file system, root) of a folder given as a path or an address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_text_files(rows, path: str) -> None:
    """A file ``<folder>/<vec_id>.txt`` per row."""

    def save(batches):
        disk, root = _files_below(path)
        for pdf in batches:
            for folder in pdf["folder"].unique():
                disk.create_dir(f"{root}/{folder}")
            for vec_id, folder, text in zip(pdf["vec_id"], pdf["folder"], pdf["text"]):
                with disk.open_output_stream(f"{root}/{folder}/{vec_id}.txt") as f:
                    f.write(text.encode())
            yield pdf[["vec_id"]]

    rows.mapInPandas(save, "vec_id bigint").write.format("noop").mode("overwrite").save()


def write_image_files(rows, path: str, shapes=((8, 8),)) -> None:
    """One file per row of (vec_id, label, p): red p, green 255 - p, blue p // 2; class 3 is damaged.

    Height and width go by the row's number through ``shapes``.
    """

    def save(batches):
        disk, root = _files_below(path)
        for pdf in batches:
            for vec_id, label, p in zip(pdf["vec_id"], pdf["label"], pdf["p"]):
                grey = np.asarray(p, np.uint8).reshape(shapes[vec_id % len(shapes)])
                data = b"no image" if label == 3 else _png(np.stack([grey, 255 - grey, grey // 2], axis=-1))
                folder = f"{root}/{label}"
                disk.create_dir(folder)
                with disk.open_output_stream(f"{folder}/{vec_id}.png") as f:
                    f.write(data)
            yield pdf[["vec_id"]]

    rows.mapInPandas(save, "vec_id bigint").write.format("noop").mode("overwrite").save()


@query(
    "image_decode_scan",
    f"SELECT vec_id::VARCHAR || '.png' AS file, label <> 3 AS readable, CASE WHEN label <> 3 THEN 8 END AS height, CASE WHEN label <> 3 THEN 8 END AS width, "
    "CASE WHEN label <> 3 THEN list_sum(p)::BIGINT END AS red, CASE WHEN label <> 3 THEN list_sum(list_transform(p, lambda x: 255 - x))::BIGINT END AS green, "
    "CASE WHEN label <> 3 THEN list_sum(list_transform(p, lambda x: x // 2))::BIGINT END AS blue "
    f"FROM ({_SQL_PX.replace('SELECT vec_id,', 'SELECT vec_id, label,')})",
)
def image_decode_scan(spark, d):
    path = scratch_path(spark, "images")
    labels = table(spark, d, "embeddings").select("vec_id", "label")
    write_image_files(images(spark, d).join(labels, "vec_id"), path)
    seen = readers.decode_images(readers.read_images(spark, path))

    def plane(c):
        return F.aggregate(F.filter("pixels", lambda x, i: i % 3 == c), F.lit(0.0), lambda a, x: a + x).cast("bigint")

    name = F.element_at(F.split("path", "/"), -1).alias("file")
    return seen.select(name, "readable", "height", "width", plane(0).alias("red"), plane(1).alias("green"), plane(2).alias("blue"))


@query(
    "write_predictions_fixed",
    f"SELECT (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS line, ({SQL_PRICE_CODE.format(x='o_totalprice')})::DOUBLE AS value FROM orders",
)
def write_predictions_fixed(spark, d):
    path = scratch_path(spark, "fixed")
    writers.write_predictions_fixed(table(spark, d, "orders"), price_class_code(F.col("o_totalprice")), path, ["o_orderkey"])
    return writers.read_predictions_fixed(spark, path)


@query("write_predictions_csv", "SELECT doc_id, 1 - toxic AS predicted FROM labels")
def write_predictions_csv(spark, d):
    path = scratch_path(spark, "predictions")
    rows = table(spark, d, "labels").select("doc_id", (F.lit(1) - F.col("toxic")).alias("predicted"))
    writers.write_predictions_csv(rows, ["doc_id", "predicted"], path)
    return spark.read.csv(path, schema="doc_id bigint, predicted int")


@query(
    "write_labelled_text",
    "SELECT regexp_replace(regexp_replace('__label__' || quality || ' ' || text, '[\\r\\n]', ' ', 'g'), '([,/])', '/\\1', 'g') AS value "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def write_labelled_text(spark, d):
    path = scratch_path(spark, "labelled")
    rows = table(spark, d, "documents").select("doc_id", "text").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    writers.write_labelled_text(rows, "quality", "text", path)
    return spark.read.text(path)


@query("write_experiment_report", SQL_EXPERIMENT)
def write_experiment_report(spark, d):
    path = scratch_path(spark, "report")
    report = kept(metrics.experiment_table(scored_configs(spark, d), "config", "split", "train", "holdout", [0, 1, 2]))
    first, rest = report.where("config = 'x0.8'"), report.where("config <> 'x0.8'")
    writers.write_experiment_report(first, path)
    writers.write_experiment_report(rest, path, append=True)
    cols = [c for c in report.columns if c != "config"]
    return rounded(spark.read.parquet(path), *cols)


@query(
    "write_split_folders",
    "SELECT lang, split, count(*) AS n, sum(n_chars)::BIGINT AS chars, greatest(1, ceil(sum(strlen(text)) / 500000))::INTEGER AS files, "
    "true AS bounded FROM (SELECT doc_id, n_chars, lang, text, CASE WHEN k <= round_even(n * 0.7::DOUBLE, 0) THEN 'train' "
    "WHEN k <= round_even(n * 0.7::DOUBLE, 0) + round_even(n * 0.2::DOUBLE, 0) THEN 'validate' ELSE 'test' END AS split FROM "
    f"(SELECT *, {sql_rank(42, 'doc_id', by='lang')} AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)) GROUP BY lang, split",
)
def write_split_folders(spark, d):
    path = scratch_path(spark, "splits")
    docs = splits.stratified_split(table(spark, d, "documents"), ["doc_id"], "lang")
    plan = writers.write_split_folders(docs, "split", "lang", path, ["doc_id"], F.octet_length("text"), 500_000)
    back = spark.read.parquet(path).select("lang", "split", "n_chars", F.input_file_name().alias("file")).groupBy("lang", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.countDistinct("file").alias("written")
    )
    both = back.join(plan.select("lang", "split", "files"), ["lang", "split"])
    return both.select("lang", "split", "n", "chars", "files", (F.col("written") <= F.col("files")).alias("bounded"))
