"""Image files of three channels and mixed sizes, from the file to the training array."""

from pyspark.sql import functions as F

from fitloom.functions import pixels as px
from fitloom.operators import images as im
from fitloom.plans.exchange import write_image_files
from fitloom.plans.registry import entries, query, sql_entries, sql_uniform
from fitloom.plans.vectors import _SQL_PX, _sql_coin
from fitloom.plans.vectors import images as byte_images
from fitloom.session import scratch_path
from fitloom.sources import readers
from fitloom.sources.readers import table

# Height and width of the picture of a vector, by its number.
SHAPES = [(8, 8), (4, 16), (16, 4)]


def _pictures(spark, d):
    """Pictures as decoded from their files, one per vector but those of label 3, whose files are damaged."""
    path = scratch_path(spark, "pictures")
    labels = table(spark, d, "embeddings").select("vec_id", "label")
    write_image_files(byte_images(spark, d).join(labels, "vec_id"), path, SHAPES)
    seen = readers.decode_images(readers.read_images(spark, path))
    return seen.withColumn("vec_id", F.regexp_extract("path", r"(\d+)\.png$", 1).cast("bigint"))


def _transformed(spark, d, steps):
    seen = _pictures(spark, d)
    done = im.transform_images(seen.select("vec_id", "height", "width", "pixels"), "pixels", F.col("height"), F.col("width"), F.lit(3), F.col("vec_id"), 42, steps)
    return entries(done, ["vec_id"], "pixels")


_SQL_RGB = (
    "SELECT e.vec_id, [8, 4, 16][e.vec_id % 3 + 1] AS h, [8, 16, 4][e.vec_id % 3 + 1] AS w, "
    "list_transform(range(192), lambda i: CASE i % 3 WHEN 0 THEN p[i // 3 + 1] WHEN 1 THEN 255 - p[i // 3 + 1] ELSE p[i // 3 + 1] // 2 END::DOUBLE) AS q "
    f"FROM ({_SQL_PX}) x JOIN embeddings e ON x.vec_id = e.vec_id WHERE label <> 3"
)


def _sql_step(base: str, cell: str) -> str:
    return f"SELECT vec_id, h, w, list_transform(range(192), lambda i: {cell}) AS q FROM ({base})"


def _sql_hflip(base: str) -> str:
    return _sql_step(base, f"CASE WHEN {_sql_coin(0.2, 'hflip')} THEN q[(i // (3 * w)) * 3 * w + (w - 1 - (i % (3 * w)) // 3) * 3 + i % 3 + 1] ELSE q[i + 1] END")


def _sql_vflip(base: str) -> str:
    return _sql_step(base, f"CASE WHEN {_sql_coin(0.5, 'vflip')} THEN q[(h - 1 - i // (3 * w)) * 3 * w + i % (3 * w) + 1] ELSE q[i + 1] END")


def _sql_rotation(base: str) -> str:
    draw = sql_uniform("vec_id::VARCHAR || ':rotate:42'")
    turn = f"SELECT *, ({draw} * 2.0::DOUBLE - 1.0::DOUBLE) * 24.0::DOUBLE * (pi() / 180.0::DOUBLE) AS a, (w - 1) / 2.0::DOUBLE AS cx, (h - 1) / 2.0::DOUBLE AS cy FROM ({base})"
    x, y = "((i % (3 * w)) // 3 - cx)", "(i // (3 * w) - cy)"
    sx = f"floor({x} * cos(a) - {y} * sin(a) + (cx + 0.5::DOUBLE))::INTEGER"
    sy = f"floor({x} * sin(a) + {y} * cos(a) + (cy + 0.5::DOUBLE))::INTEGER"
    return _sql_step(turn, f"CASE WHEN {sx} BETWEEN 0 AND w - 1 AND {sy} BETWEEN 0 AND h - 1 THEN q[({sy} * w + {sx}) * 3 + i % 3 + 1] ELSE 0.0::DOUBLE END")


def _sql_unit(base: str) -> str:
    return _sql_step(base, "q[(i % (h * w)) * 3 + i // (h * w) + 1] / 255.0::DOUBLE")


def _sql_erase(base: str) -> str:
    u = {k: sql_uniform(f"vec_id::VARCHAR || ':{k}:42'") for k in ("area", "ratio", "top", "left")}
    (lo, hi), (low, high) = px.ERASE_AREA, [f"ln({r}::DOUBLE)" for r in px.ERASE_RATIO]
    first = f"SELECT *, ({u['area']} * {hi - lo!r}::DOUBLE + {lo}::DOUBLE) * (h * w)::DOUBLE AS area, exp({u['ratio']} * ({high} - {low}) + {low}) AS ratio FROM ({base})"
    sized = f"SELECT *, least(floor(sqrt(area * ratio) + 0.5::DOUBLE), h - 1)::INTEGER AS eh, least(floor(sqrt(area / ratio) + 0.5::DOUBLE), w - 1)::INTEGER AS ew FROM ({first})"
    placed = f"SELECT *, floor({u['top']} * (h + 1 - eh))::INTEGER AS t, floor({u['left']} * (w + 1 - ew))::INTEGER AS l FROM ({sized})"
    row, col = "(i % (h * w)) // w", "i % w"
    hit = f"({_sql_coin(0.2, 'erase')}) AND {row} >= t AND {row} < t + eh AND {col} >= l AND {col} < l + ew"
    return _sql_step(placed, f"CASE WHEN {hit} THEN 0.0::DOUBLE ELSE q[i + 1] END")


def _sql_normalize(base: str) -> str:
    return _sql_step(base, "(q[i + 1] - 0.5::DOUBLE) / 0.5::DOUBLE")


def _picture_query(name: str, steps: tuple[str, ...]) -> None:
    sql = _SQL_RGB
    for step in steps:
        sql = globals()[f"_sql_{step}"](sql)
    query(name, sql_entries(sql, "vec_id", "q"))(lambda spark, d: _transformed(spark, d, steps))


_picture_query("picture_hflip", ("hflip",))
_picture_query("picture_vflip", ("vflip",))
_picture_query("picture_rotation", ("rotation",))
_picture_query("picture_erase", ("unit", "erase"))
_picture_query("picture_augmentation", im.TRAIN)
_picture_query("picture_preparation", im.PLAIN)
