"""Document quality from weak labels: labellers, their accuracies by expectation-maximisation, a hashed scorer.

Heuristic labellers, and ratings where there are some, vote bad, good or nothing on each document. All
documents are counted by their combination of votes; on these counts EM estimates how often each labeller
votes what for good and for bad documents. The posterior of a bounded sample's votes trains a linear scorer
on hashed words, and the scorer judges every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fitloom.llm.packing import KINDS
from fitloom.llm.words import LOWER, WHITE, split, tidy, worded

SAMPLE_ROWS = 20_000
MIN_ROWS = 5
BUCKET_BITS = 18
STAT_LEVELS = 8
THRESHOLD = 0.25
LEAST_DEVIATION = 4.0
PENALTY = 1e-6
STEPS = 400

# Words of abuse.
TOXIC = "idiot idiots moron morons stupid clown loser scum trash worthless pathetic disgusting".split()

NOTHING, GOOD, BAD = 0, 1, 2
FIGURES = ("signs", "capitals", "calls", "repeats", "abuse")
HEURISTICS = FIGURES
LABELLERS = (*HEURISTICS, "rated")
TRUST = (0.9, 0.9, 0.9, 0.9, 0.9, 0.99)  # share of right votes that EM starts from, and moves away from as the votes say


def _hashes(texts: list[str]) -> np.ndarray:
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    return split(range(1), data, np.array([0, len(data)]), WHITE, LOWER, KINDS).hashes


_ABUSE = np.sort(_hashes(TOXIC))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]


def described(column: pa.Array):
    """(row, bucket) pairs of the distinct segments, and five figures, of each slice's rows."""
    for words in worded(column, WHITE, LOWER, KINDS):
        n = len(words.rows)
        count = words.counts()
        row = np.repeat(np.arange(n), count)
        bucket = (words.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        pairs = np.unique((row << BUCKET_BITS) + bucket)
        rows, buckets = pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1)
        byte = words.data
        # the bytes of a row lie between its first and last segment
        filled = count > 0
        begin, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
        begin[filled] = words.start[words.first[:-1][filled]]
        end[filled] = words.stop[words.first[1:][filled] - 1]

        def share(mask, of=None):
            sums = np.concatenate(([0], np.cumsum(mask)))
            base = (end - begin) if of is None else np.concatenate(([0], np.cumsum(of)))[end] - np.concatenate(([0], np.cumsum(of)))[begin]
            return (sums[end] - sums[begin]) / np.maximum(base, 1)

        upper = (byte >= 65) & (byte <= 90)
        letter = upper | ((byte >= 97) & (byte <= 122))
        calls = byte == 33
        calls[1:] &= byte[:-1] == 33
        signs = np.isin(byte, np.frombuffer(b"#$%&*|", np.uint8))
        place = np.minimum(np.searchsorted(_ABUSE, words.hashes), len(_ABUSE) - 1)
        yield words.rows, rows, buckets, {
            "n": count,
            "signs": share(signs),
            "capitals": share(upper, letter),
            "calls": share(calls) * 20,
            "repeats": 1 - np.bincount(rows, minlength=n) / np.maximum(count, 1),
            "abuse": _sums(_ABUSE[place] == words.hashes, words.first).astype(float),
        }


def votes(figures: dict[str, np.ndarray]) -> np.ndarray:
    """(rows, labellers): what each heuristic says; a document without words gets no votes.

    Bad documents have one fault of several, so the labeller of a fault keeps silent where it sees
    none; what silence tells is estimated with the votes.
    """
    n = figures["n"]

    def fault(x, least_words, bound):
        return np.where((n >= least_words) & (x >= bound), BAD, NOTHING)

    return np.stack([
        fault(figures["signs"], 1, 0.03),
        fault(figures["capitals"], 3, 0.4),
        fault(figures["calls"], 3, 0.2),
        fault(figures["repeats"], 12, 0.8),
        fault(figures["abuse"], 1, 1),
    ], axis=1)


def _levels(figures) -> np.ndarray:
    """Figures in a few steps each, as further features behind the hashed ones."""
    steps = {"signs": [0.001, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1], "capitals": [0.05, 0.1, 0.2, 0.3, 0.4, 0.6, 0.8],
             "calls": [0.01, 0.05, 0.1, 0.2, 0.3, 0.5, 1], "repeats": [0.2, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], "abuse": [1, 2, 3, 4, 6, 8, 16]}
    own = [np.searchsorted(steps[k], figures[k], "right") + STAT_LEVELS * i for i, k in enumerate(FIGURES)]
    return np.stack(own, axis=1) + (1 << BUCKET_BITS)


N_WEIGHTS = (1 << BUCKET_BITS) + STAT_LEVELS * len(FIGURES)


PSEUDO = 10.0
SHARE = np.array([0.8, 0.2])


def start(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Vote rates to start from: each labeller speaks as often as it does, for both classes, and is right as ``TRUST`` says."""
    total = max(counts.sum(), 1.0)
    rate = np.empty((patterns.shape[1], 2, 3))
    for j, t in enumerate(TRUST[: patterns.shape[1]]):
        said = min(max(float(counts[patterns[:, j] != NOTHING].sum()) / total, 1e-3), 1 - 1e-3)
        rate[j] = [[1 - said, said * t, said * (1 - t)], [1 - said, said * (1 - t), said * t]]
    return rate


def _joint(patterns: np.ndarray, share: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Log probability of each class together with each combination of votes; silence is a vote like others."""
    log = np.log(share)[:, None] + np.zeros((2, len(patterns)))
    for j in range(patterns.shape[1]):  # of heuristics alone, the columns of ratings are left out
        log += np.log(rate[j][:, patterns[:, j]])
    return log


def strength(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """As how many documents each labeller's start counts: ``PSEUDO``, for the ratings as many as there are ratings.

    Ratings say what is meant by bad; without this hold EM may take any other grouping of the votes for the classes.
    """
    out = np.full(patterns.shape[1], PSEUDO)
    if len(out) == len(LABELLERS):
        out[-1] = max(PSEUDO, float(counts[patterns[:, -1] != NOTHING].sum()))
    return out


def likelihood(patterns: np.ndarray, counts: np.ndarray, share: np.ndarray, rate: np.ndarray, prior: np.ndarray) -> float:
    """What every round of EM raises: the log likelihood of all votes, and of the documents that the start counts as."""
    votes = float(counts @ np.logaddexp(*_joint(patterns, share, rate)))
    held = strength(patterns, counts)[:, None, None] * prior * np.log(rate)
    return votes + float(held.sum()) + PSEUDO * float((SHARE * np.log(share)).sum())


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, tolerance: float = 1e-7) -> tuple[np.ndarray, np.ndarray]:
    """Class shares [2] and vote rates [labeller, class, vote] from combinations of votes and their counts.

    A labeller may also tell by its silence, so silence has its rates like the two votes. The start counts as some documents (``strength``),
    which keeps every rate above zero and soon weighs nothing against the votes of heuristics. Ends when no document's probability
    moves by more than ``tolerance``, or after ``rounds``.
    """
    share, rate = SHARE.copy(), start(patterns, counts)
    prior, post, hold = rate.copy(), None, strength(patterns, counts)
    for _ in range(rounds):
        last, post = post, posterior(patterns, share, rate)
        if last is not None and len(post) and np.abs(post - last).max() < tolerance:
            break
        weight = np.stack((1 - post, post)) * counts
        share = (weight.sum(axis=1) + PSEUDO * SHARE) / (counts.sum() + PSEUDO)
        rate = np.empty_like(prior)
        for j in range(patterns.shape[1]):
            for v in (NOTHING, GOOD, BAD):
                rate[j, :, v] = (weight * (patterns[:, j] == v)).sum(axis=1) + hold[j] * prior[j, :, v]
        rate /= rate.sum(axis=2, keepdims=True)
    return share, rate


def posterior(patterns: np.ndarray, share: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Probability of bad for each combination of votes."""
    log = _joint(patterns, share, rate)
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))


@dataclass
class Quality:
    share: np.ndarray
    rate: np.ndarray
    weights: np.ndarray
    bias: float


_CODE = 3 ** np.arange(len(HEURISTICS))


def _voted(rows: DataFrame) -> DataFrame:
    """(id, code of the heuristics' votes) per row."""

    @tidy
    def run(batches):
        for batch in batches:
            codes = [votes(f) @ _CODE for _, _, _, f in described(batch.column(1))]
            code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(code, pa.int64())], names=["id", "code"])

    return rows.select("id", "text").mapInArrow(run, StructType([rows.schema["id"], StructField("code", LongType())]))


def _features(rows: DataFrame) -> DataFrame:
    """(h, t, code, rated, features) of the sampled rows (h, t, text, rated)."""

    @tidy
    def run(batches):
        for batch in batches:
            codes, lists = [], []
            for part, rows, buckets, figures in described(batch.column(2)):
                codes += (votes(figures) @ _CODE).tolist()
                bounds = np.searchsorted(rows, np.arange(len(part) + 1))
                lists += [np.concatenate((buckets[a:b], s)) for a, b, s in zip(bounds, bounds[1:], _levels(figures))]
            features = pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(codes, pa.int64()), batch.column(3), features], names=["h", "t", "code", "rated", "features"]
            )

    return rows.select("h", "t", "text", "rated").mapInArrow(run, "h bigint, t bigint, code bigint, rated bigint, features array<int>")


def _sample(rows: DataFrame, rated: DataFrame, any_rated: bool, sample_rows: int) -> DataFrame:
    """(h, t, text, rated): rows whose id has one of the ``sample_rows`` smallest hashes, of the rated ones if any of ``rows`` is.

    Ratings of other documents take no places, as ids are joined before they are chosen.
    """
    hashed = rows.select("id", "text", F.xxhash64("id").alias("h"))
    ids = hashed.select("id", "h")
    if any_rated:
        ids = ids.join(rated, "id")
    top = ids.select("h").distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    near = hashed.where(F.col("h") <= F.lit(top)) if top is not None else hashed.limit(0)
    if any_rated:
        own = ids.where(F.col("h") <= F.lit(top)).select("id", "rated").distinct()
        near = near.join(F.broadcast(own), "id")  # at most sample_rows ids
    else:
        near = near.withColumn("rated", F.lit(NOTHING).cast("bigint"))
    return near.withColumn("t", F.xxhash64("text"))


def _pattern(code: np.ndarray, rated: np.ndarray) -> np.ndarray:
    return np.stack([*(code // 3**j % 3 for j in range(len(HEURISTICS))), rated], axis=1)


def fit(docs: DataFrame, ratings: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Quality:
    """Labeller accuracies from all of ``docs``; scorer from a sample of at most ``sample_rows`` rows.

    ``ratings`` (id, bad as boolean) may cover any documents; of several for one id, bad wins. The
    sample are those of ``docs`` that are rated and have the smallest hash of their id, or of all where none is rated.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    if ratings is None:
        rated = rows.sparkSession.createDataFrame([], StructType([rows.schema["id"], StructField("rated", LongType())]))
    else:
        own = ratings.toDF("id", "bad").where("id is not null and bad is not null")
        rated = own.groupBy("id").agg(F.when(F.max("bad"), BAD).otherwise(GOOD).cast("bigint").alias("rated"))
    seen = _voted(rows).join(rated, "id", "left").groupBy("code", F.coalesce("rated", F.lit(NOTHING)).alias("rated")).count()
    seen = np.array([tuple(r) for r in seen.collect()], np.int64).reshape(-1, 3)  # at most 3 ** labellers rows
    share, rate = em(_pattern(seen[:, 0], seen[:, 1]), seen[:, 2].astype(float))
    sample = _sample(rows, rated, bool((seen[:, 1] != NOTHING).any()), sample_rows)
    # repeated ids may give more rows than ids; the first of them by text are taken, so a fit is always the same
    got = _features(sample).orderBy("h", "t", "code").limit(sample_rows).toArrow()
    if not got.num_rows:
        return Quality(share, rate, np.zeros(N_WEIGHTS, np.float32), float(np.log(share[1] / share[0])))
    target = posterior(_pattern(got["code"].to_numpy(), got["rated"].to_numpy()), share, rate)
    column = got["features"].combine_chunks()
    return Quality(share, rate, *train(column.flatten().to_numpy(), np.diff(column.offsets.to_numpy()), target))


def train(features: np.ndarray, sizes: np.ndarray, target: np.ndarray, steps: int = STEPS, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic weights on the distinct features of each row, by Adam.

    Features of few rows get none, nor do those whose rows are bad about as often as all rows are.
    """
    row = np.repeat(np.arange(len(sizes)), sizes)
    count, bad, mean = np.bincount(features, minlength=N_WEIGHTS), np.bincount(features, target[row], minlength=N_WEIGHTS), target.mean()
    apart = np.abs(bad - count * mean) >= LEAST_DEVIATION * np.sqrt(np.maximum(count * mean * (1 - mean), 1e-9))
    frequent = (count >= MIN_ROWS) & apart
    place = np.cumsum(frequent) - 1
    keep = frequent[features]
    row, at = row[keep], place[features[keep]]
    w, bias, size = np.zeros(int(frequent.sum())), 0.0, len(sizes)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for turn in range(1, steps + 1):
        z = np.bincount(row, w[at], minlength=size) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / size
        g = np.bincount(at, error[row], minlength=len(w)) + PENALTY * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**turn, 1 - 0.99**turn
        w -= rate * (m / a) / (np.sqrt(v / b) + 1e-7)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-7)
    out = np.zeros(N_WEIGHTS, np.float32)
    out[frequent] = w
    return out, float(bias)


def score(docs: DataFrame, model: Quality, text: str = "text") -> DataFrame:
    """``docs`` with quality_score (probability of bad), weak_score (posterior of the votes alone) and rejected.

    A document with one sign of bad out of many that were seen to go together scores below a half, and one
    without any near zero; hence the threshold.

    Each row is judged by its own whole text, so repeated rows get the same. A null or empty text
    has no votes and no words; it gets what the scorer says of a text without any sign of bad.
    Columns with the names of results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["quality_score", "weak_score", "rejected"]
    keep = docs.drop(*names)

    @tidy
    def run(batches):
        m = shared.value
        for batch in batches:
            scores, weak = [], []
            for part, rows, buckets, figures in described(batch.column(batch.schema.names.index(text))):
                z = np.bincount(rows, m.weights[buckets], minlength=len(part)) + m.weights[_levels(figures)].sum(axis=1) + m.bias
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                weak.append(posterior(votes(figures), m.share, m.rate))
            s, p = (np.concatenate(x) if x else np.zeros(0) for x in (scores, weak))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array(p), pa.array(s > THRESHOLD)], names=[*batch.schema.names, *names])

    schema = StructType(list(keep.schema))
    for f in docs.sparkSession.createDataFrame([], "quality_score double, weak_score double, rejected boolean").schema:
        schema = schema.add(f)
    return keep.mapInArrow(run, schema)
