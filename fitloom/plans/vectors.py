"""Sequences, vectors, noise and pixel arrays."""

from pyspark.sql import functions as F

from fitloom.functions import pixels as px
from fitloom.functions import vectors as vx
from fitloom.operators import profile, sequences
from fitloom.plans.registry import EMB, entries, query, r6, rounded, sql_entries, sql_gauss, sql_r6, sql_rank, sql_uniform
from fitloom.sources.readers import gaussian_latents, noise_schedule, table

# Fixed value: class codes of the stand-in for labelled sequences, in alphabetical order.
EVENT_CODES = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}


def _events(spark, d):
    return table(spark, d, "events").select("user_id", "ts", "event_id", "value", "event_type")


def _label(rows):
    code = F.lit(None).cast("int")
    for name, c in EVENT_CODES.items():
        code = F.when(F.col("event_type") == name, c).otherwise(code)
    return rows.withColumn("label", code).drop("event_type")


def _sequences(spark, d):
    return _label(sequences.build_sequences(_events(spark, d), "user_id", ["ts", "event_id"], "value", "event_type"))


def _values(records, ids):
    """One row per value, with its place in the whole sequence."""
    out = entries(records, [*ids, "start"], "seq")
    return out.withColumn("pos", (F.col("start") + F.col("pos")).cast("int")).drop("start")


_SQL_SEQ = (
    "SELECT user_id, list(value ORDER BY k) AS v, "
    "(CASE first(event_type ORDER BY k) " + " ".join(f"WHEN '{n}' THEN {c}" for n, c in EVENT_CODES.items()) + " END)::INTEGER AS label FROM "
    "(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) GROUP BY user_id"
)


def _sql_pad(length: str) -> str:
    return f"list_concat(v, list_transform(range({length} - len(v)), lambda x: 0.0::DOUBLE))"


@query("sequence_scan", sql_entries(_SQL_SEQ, "user_id, label"))
def sequence_scan(spark, d):
    return _values(_sequences(spark, d), ["user_id", "label"])


@query("max_sequence_length", "SELECT max(n) AS max_len FROM (SELECT count(*) AS n FROM events GROUP BY user_id)")
def max_sequence_length(spark, d):
    return profile.max_sequence_length(_events(spark, d), "user_id")


@query(
    "pad_to_max",
    sql_entries(
        f"WITH s AS ({_SQL_SEQ}) SELECT user_id, (len(v) - 1)::INTEGER AS last_idx, {_sql_pad('(SELECT max(len(v)) FROM s)')} AS v FROM s",
        "user_id, last_idx",
    ),
)
def pad_to_max(spark, d):
    return _values(sequences.pad_to_max(_sequences(spark, d), "seq", segments=True), ["user_id", "last_idx"])


@query(
    "pad_batch",
    sql_entries(
        f"WITH s AS ({_SQL_SEQ}), b AS (SELECT *, ({sql_rank(42, 'user_id')} - 1) // 32 AS batch FROM s) "
        f"SELECT user_id, batch, (len(v) - 1)::INTEGER AS last_idx, {_sql_pad('max(len(v)) OVER (PARTITION BY batch)')} AS v FROM b",
        "user_id, batch, last_idx",
    ),
)
def pad_batch(spark, d):
    padded = sequences.pad_batch(_sequences(spark, d), ["user_id"], "seq", 32, segments=True)
    return _values(padded, ["user_id", "batch", "last_idx"])


@query("gather_last", f"SELECT user_id, label, v[len(v)] AS last FROM ({_SQL_SEQ})")
def gather_last(spark, d):
    return _label(sequences.sequence_totals(_events(spark, d), "user_id", ["ts", "event_id"], "value", "event_type")).select("user_id", "label", "last")


# --- noise schedule ---

STEPS = 200
_TERMS = ["beta", "alpha", "alpha_bar", "alpha_bar_prev", "sqrt_recip_alpha", "sqrt_alpha_bar", "sqrt_one_minus_alpha_bar", "posterior_variance"]
_SQL_SCHEDULE = (
    "WITH b AS (SELECT t::INTEGER AS t, 0.0001::DOUBLE + t * ((0.02::DOUBLE - 0.0001::DOUBLE) / 199) AS beta FROM (SELECT unnest(range(200)) AS t)), "
    "a AS (SELECT *, 1.0::DOUBLE - beta AS alpha, exp(sum(ln(1.0::DOUBLE - beta)) OVER (ORDER BY t)) AS alpha_bar FROM b), "
    "p AS (SELECT *, lag(alpha_bar, 1, 1.0::DOUBLE) OVER (ORDER BY t) AS alpha_bar_prev FROM a) "
    "SELECT *, sqrt(1.0::DOUBLE / alpha) AS sqrt_recip_alpha, sqrt(alpha_bar) AS sqrt_alpha_bar, sqrt(1.0::DOUBLE - alpha_bar) AS sqrt_one_minus_alpha_bar, "
    "beta * (1.0::DOUBLE - alpha_bar_prev) / (1.0::DOUBLE - alpha_bar) AS posterior_variance FROM p"
)


def _vectors(spark, d):
    emb = table(spark, d, "embeddings")
    return emb.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def _stepped(spark, d, terms):
    """Every vector with a step of the schedule and the schedule's terms."""
    rows = _vectors(spark, d).withColumn("t", (F.col("vec_id") % STEPS).cast("int"))
    return sequences.gather_by_step(rows, noise_schedule(spark, STEPS), "t", terms)


_SQL_STEPPED = f"SELECT e.*, s.* FROM ({EMB}) e JOIN ({_SQL_SCHEDULE}) s ON e.vec_id % 200 = s.t"


@query("noise_schedule", f"SELECT t, count(*) AS n, {', '.join(f'{sql_r6(c)} AS {c}' for c in _TERMS)} FROM ({_SQL_STEPPED}) GROUP BY ALL")
def noise_schedule_query(spark, d):
    used = _vectors(spark, d).groupBy((F.col("vec_id") % STEPS).cast("int").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(sequences.gather_by_step(used, noise_schedule(spark, STEPS), "t", _TERMS), *_TERMS)


@query("gather_by_step", f"SELECT vec_id, t, {sql_r6('sqrt_alpha_bar')} AS sqrt_alpha_bar, {sql_r6('sqrt_one_minus_alpha_bar')} AS sqrt_one_minus_alpha_bar FROM ({_SQL_STEPPED})")
def gather_by_step(spark, d):
    terms = ["sqrt_alpha_bar", "sqrt_one_minus_alpha_bar"]
    return rounded(_stepped(spark, d, terms).select("vec_id", "t", *terms), *terms)


def _sql_noise(seed: int) -> str:
    """Noise for entry i (1-based) of a vector."""
    text = f"vec_id::VARCHAR || ':' || (i - 1)::VARCHAR || ':{seed}'"
    return sql_gauss(text)


@query(
    "gaussian_latents",
    f"SELECT vec_id, (i - 1)::INTEGER AS pos, {sql_r6(_sql_noise(42))} AS value FROM (SELECT vec_id, unnest(range(1, 33)) AS i FROM embeddings)",
)
def gaussian_latents_query(spark, d):
    return entries(gaussian_latents(table(spark, d, "embeddings").select("vec_id"), F.col("vec_id"), 32), ["vec_id"], "latent")


SQL_NOISY = (
    f"SELECT vec_id, label, v, list_transform(v, lambda x, i: sqrt_alpha_bar * x + sqrt_one_minus_alpha_bar * {_sql_noise(42)}) AS noisy, "
    f"list_transform(v, lambda x, i: {_sql_noise(42)}) AS noise FROM ({_SQL_STEPPED})"
)


def noisy_vectors(spark, d):
    rows = _stepped(spark, d, ["sqrt_alpha_bar", "sqrt_one_minus_alpha_bar"])
    rows = rows.withColumn("noise", vx.unit_noise(F.col("vec_id"), F.col("v"), 42))
    noisy = vx.forward_noise(F.col("v"), F.col("sqrt_alpha_bar"), F.col("sqrt_one_minus_alpha_bar"), F.col("noise"))
    return rows.withColumn("noisy", noisy).select("vec_id", "label", "v", "noisy", "noise")


@query(
    "forward_noise",
    f"SELECT vec_id, (i - 1)::INTEGER AS pos, {sql_r6('noisy[i]')} AS noisy, {sql_r6('noise[i]')} AS noise FROM "
    f"(SELECT vec_id, noisy, noise, unnest(range(1, len(v) + 1)) AS i FROM ({SQL_NOISY}))",
)
def forward_noise(spark, d):
    pair = F.posexplode(F.arrays_zip("noisy", "noise")).alias("pos", "z")
    out = noisy_vectors(spark, d).select("vec_id", pair)
    return out.select("vec_id", "pos", r6("z.noisy").alias("noisy"), r6("z.noise").alias("noise"))


@query(
    "gaussian_sample",
    sql_entries(
        f"SELECT vec_id, list_transform(list_slice(v, 1, 32), lambda m, i: m + exp(0.5::DOUBLE * v[32 + i]) * {_sql_noise(43)}) AS v FROM ({EMB})", "vec_id"
    ),
)
def gaussian_sample(spark, d):
    mean, log_var = F.slice("v", 1, 32), F.slice("v", 33, 32)
    z = vx.gaussian_sample(mean, log_var, vx.unit_noise(F.col("vec_id"), mean, 43))
    return entries(_vectors(spark, d).withColumn("v", z), ["vec_id"], "v")


@query("argmax", f"SELECT vec_id, (list_position(v, list_max(v)) - 1)::INTEGER AS best FROM ({EMB})")
def argmax(spark, d):
    return _vectors(spark, d).select("vec_id", vx.argmax(F.col("v")).alias("best"))


@query("flatten_vector", sql_entries(EMB, "vec_id"))
def flatten_vector(spark, d):
    grid = _vectors(spark, d).withColumn("grid", vx.reshape(F.col("v"), 8, 8))
    return entries(grid.withColumn("flat", vx.flatten_vector(F.col("grid"))), ["vec_id"], "flat")


@query(
    "stack_interleave",
    sql_entries(f"SELECT vec_id, 0 AS slot, v FROM ({SQL_NOISY}) UNION ALL SELECT vec_id, 1, noisy FROM ({SQL_NOISY})", "vec_id, slot"),
)
def stack_interleave(spark, d):
    pairs = sequences.interleave(noisy_vectors(spark, d), ["vec_id"], "v", "noisy")
    return entries(pairs, ["vec_id", "slot"], "vec")


@query(
    "softmax",
    sql_entries(f"SELECT vec_id, list_transform(v, lambda x: exp(x - list_max(v)) / list_sum(list_transform(v, lambda y: exp(y - list_max(v))))) AS v FROM ({EMB})", "vec_id"),
)
def softmax(spark, d):
    return entries(_vectors(spark, d).withColumn("v", vx.softmax(F.col("v"))), ["vec_id"], "v")


# --- pixels: a vector of 64 entries seen as an image ---

_SQL_PX = f"SELECT vec_id, list_transform(v, lambda x: floor(least(greatest((x / 2.0::DOUBLE + 0.5::DOUBLE) * 255.0::DOUBLE, 0), 255))::INTEGER) AS p FROM ({EMB})"


def images(spark, d):
    """Byte pixels derived from the vectors."""
    return _vectors(spark, d).select("vec_id", px.to_bytes(px.denormalize(F.col("v"))).alias("p"))


def _sql_map_px(expr: str, base: str = _SQL_PX) -> str:
    """``expr`` over lambda variable i, the 0-based place in the new image."""
    return f"SELECT vec_id, list_transform(range(64), lambda i: {expr}) AS v FROM ({base})"


def _px_query(name: str, base: str, make, kind: str = "int"):
    value = "double" if kind == "double" else "int"
    query(name, sql_entries(base, "vec_id", kind=value))(
        lambda spark, d: entries(images(spark, d).select("vec_id", make().alias("v")), ["vec_id"], "v", kind=value)
    )


_SQL_CHW = "p[(i % 16) * 4 + i // 16 + 1] / 255.0::DOUBLE"
_SQL_HFLIP = "p[(i // 8) * 8 + 7 - i % 8 + 1]"
_SQL_VFLIP = "p[(7 - i // 8) * 8 + i % 8 + 1]"


def _sql_coin(p: float, op: str) -> str:
    return f"{sql_uniform(f'''vec_id::VARCHAR || ':{op}:42\'''')} < {p}::DOUBLE"


_px_query("to_unit_chw", _sql_map_px(_SQL_CHW), lambda: px.to_unit_chw(F.col("p"), 4, 4, 4), "double")
_px_query("normalize_pixels", _sql_map_px(f"({_SQL_CHW} - 0.5::DOUBLE) / 0.5::DOUBLE"), lambda: px.plain_preparation(F.col("p"), 4, 4, 4), "double")
_px_query("denormalize_pixels", f"SELECT vec_id, p AS v FROM ({_SQL_PX})", lambda: F.col("p"))
_px_query("chw_to_hwc", _sql_map_px("p[(i % 4) * 16 + i // 4 + 1]"), lambda: px.chw_to_hwc(F.col("p"), 4, 4, 4))
_px_query("random_hflip", _sql_map_px(f"CASE WHEN {_sql_coin(0.2, 'hflip')} THEN {_SQL_HFLIP} ELSE p[i + 1] END"), lambda: px.random_hflip(F.col("p"), F.col("vec_id"), 0.2, 42, 8, 8))
_px_query("random_vflip", _sql_map_px(f"CASE WHEN {_sql_coin(0.5, 'vflip')} THEN {_SQL_VFLIP} ELSE p[i + 1] END"), lambda: px.random_vflip(F.col("p"), F.col("vec_id"), 0.5, 42, 8, 8))


def _sql_rotated(base: str) -> str:
    turn = f"SELECT vec_id, p, ({sql_uniform('''vec_id::VARCHAR || ':rotate:42\'''')} * 2.0::DOUBLE - 1.0::DOUBLE) * 24.0::DOUBLE * (pi() / 180.0::DOUBLE) AS a FROM ({base})"
    x, y = "(i % 8 - 3.5::DOUBLE)", "(i // 8 - 3.5::DOUBLE)"
    sx = f"floor({x} * cos(a) - {y} * sin(a) + 4.0::DOUBLE)::INTEGER"
    sy = f"floor({x} * sin(a) + {y} * cos(a) + 4.0::DOUBLE)::INTEGER"
    return _sql_map_px(f"CASE WHEN {sx} BETWEEN 0 AND 7 AND {sy} BETWEEN 0 AND 7 THEN p[{sy} * 8 + {sx} + 1]::DOUBLE ELSE 0.0::DOUBLE END", turn)


_px_query("random_rotation", _sql_rotated(_SQL_PX), lambda: px.random_rotation(F.col("p").cast("array<double>"), F.col("vec_id"), 24.0, 42, 8, 8), "double")


def _sql_erased(base: str) -> str:
    """``base`` gives (vec_id, p) with p in channel-first order, one channel."""
    u = {k: sql_uniform(f"vec_id::VARCHAR || ':{k}:42'") for k in ("area", "ratio", "top", "left")}
    lo, hi = px.ERASE_AREA
    log = [f"ln({r}::DOUBLE)" for r in px.ERASE_RATIO]
    first = (
        f"SELECT vec_id, p, ({u['area']} * {hi - lo!r}::DOUBLE + {lo}::DOUBLE) * 64.0::DOUBLE AS area, "
        f"exp({u['ratio']} * ({log[1]} - {log[0]}) + {log[0]}) AS ratio FROM ({base})"
    )
    sized = (
        "SELECT vec_id, p, least(floor(sqrt(area * ratio) + 0.5::DOUBLE), 7)::INTEGER AS eh, "
        f"least(floor(sqrt(area / ratio) + 0.5::DOUBLE), 7)::INTEGER AS ew FROM ({first})"
    )
    placed = f"SELECT *, floor({u['top']} * (9 - eh))::INTEGER AS t, floor({u['left']} * (9 - ew))::INTEGER AS l FROM ({sized})"
    hit = f"({_sql_coin(0.2, 'erase')}) AND i // 8 >= t AND i // 8 < t + eh AND i % 8 >= l AND i % 8 < l + ew"
    return _sql_map_px(f"CASE WHEN {hit} THEN 0.0::DOUBLE ELSE p[i + 1] END", placed)


_SQL_UNIT = f"SELECT vec_id, list_transform(p, lambda x: x / 255.0::DOUBLE) AS p FROM ({_SQL_PX})"
_px_query("random_erase", _sql_erased(_SQL_UNIT), lambda: px.random_erase(px.to_unit_chw(F.col("p"), 8, 8, 1), F.col("vec_id"), 0.2, 42, 8, 8), "double")


def _sql_step(base: str, expr: str) -> str:
    return _sql_map_px(expr, base).replace(" AS v FROM", " AS p FROM", 1)


def _sql_all_steps() -> str:
    h = _sql_step(_SQL_PX, f"CASE WHEN {_sql_coin(0.2, 'hflip')} THEN {_SQL_HFLIP} ELSE p[i + 1] END")
    v = _sql_step(h, f"CASE WHEN {_sql_coin(0.5, 'vflip')} THEN {_SQL_VFLIP} ELSE p[i + 1] END")
    r = _sql_rotated(v)
    unit = f"SELECT vec_id, list_transform(v, lambda x: x / 255.0::DOUBLE) AS p FROM ({r})"
    e = _sql_erased(unit)
    return f"SELECT vec_id, list_transform(v, lambda x: (x - 0.5::DOUBLE) / 0.5::DOUBLE) AS v FROM ({e})"


_px_query(
    "augment_images", _sql_all_steps(),
    lambda: px.train_augmentation(F.col("p").cast("array<double>"), F.col("vec_id"), 42, 8, 8, 1), "double",
)


@query(
    "noisy_image",
    sql_entries(f"SELECT vec_id, list_transform(range(64), lambda i: (noisy[(i % 4) * 16 + i // 4 + 1] / 2.0::DOUBLE + 0.5::DOUBLE) * 255.0::DOUBLE) AS v FROM ({SQL_NOISY})", "vec_id"),
)
def noisy_image(spark, d):
    noisy = noisy_vectors(spark, d).withColumn("v", px.denormalize(px.chw_to_hwc(F.col("noisy"), 4, 4, 4)))
    return entries(noisy.withColumn("v", F.transform("v", lambda x: x * F.lit(255.0))), ["vec_id"], "v")
