"""Spelling variants: words one edit apart, by an asymmetric join of chunks and positional grams.

The shorter word of a pair (of equal lengths the first in code-point order) gives two disjoint chunks, its
halves; the longer one gives the grams of the same lengths within a shift of one of those places. One edit
lies in one half and leaves the other as a gram of the longer word: the first half where it was, the second
half shifted by the difference of the lengths. Words that meet on a chunk are verified.

A chunk that very many words share is not joined as it stands. What is left of its words beside the chunk
must then be one edit apart, so the rest is halved by the same rule and the key grows, until the pairs of a
key are few for its rows or one letter is left; a key that leaves one letter open cannot hold more words
than there are letters. No pair is lost and no key is capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 5
MIN_COUNT = 3
PAIRS_PER_ROW = 8
STRONGER = 2


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 1) -> DataFrame:
    """(doc_id, run): every maximal run of at least ``least`` letters of the whole texts, A-Z in lower case.

    A null or empty text has none; a run that occurs again is a row again.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run")).withColumn("run", ascii_lower(F.col("run")))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of ``words`` (word) of at least ``min_length`` code points, met ``min_count`` times or more."""
    long_enough = words.where(F.length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row (key, word, more, a, b) as two: one half of the open part [a, b) goes into the key, the other stays open.

    ``more`` is how much longer the word is than the shorter word of its pairs, and null for the shorter word
    itself; halves are those of the shorter word, the first at the same place, the second at the same end.
    """
    size = F.col("b") - F.col("a") - F.coalesce("more", F.lit(0))
    cut = (size / 2).cast("int")
    first = F.struct(
        F.lit(1).alias("half"), F.substring("word", F.col("a") + 1, cut).alias("chunk"), (F.col("a") + cut).alias("a"), F.col("b").alias("b")
    )
    rest = size - cut
    second = F.struct(
        F.lit(2).alias("half"), F.substring("word", F.col("b") - rest + 1, rest).alias("chunk"), F.col("a").alias("a"), (F.col("b") - rest).alias("b")
    )
    split = rows.select("key", "word", "more", F.explode(F.array(first, second)).alias("s"))
    return split.select(F.xxhash64("key", "s.half", "s.chunk").alias("key"), "word", "more", "s.a", "s.b")


def near_pairs(words: DataFrame, pairs_per_row: int = PAIRS_PER_ROW) -> DataFrame:
    """(x, y): the pairs of different words that are exactly one inserted, deleted or replaced code point apart, once each.

    ``words`` has one row per ``word``; words of one code point and empty ones take part like any other. x is the
    shorter word, of equal lengths the first in code-point order. An empty table gives no pair.
    """
    whole = words.where("word is not null").select("word", F.length("word").alias("b"))
    sides = F.explode(F.array(F.lit(None).cast("int"), F.lit(0), F.lit(1)))
    rows = whole.select("word", "b", sides.alias("more")).where("b - coalesce(more, 0) >= 0")
    rows = rows.select(F.xxhash64(F.col("b") - F.coalesce("more", F.lit(0))).alias("key"), "word", "more", F.lit(0).alias("a"), "b")
    found = None
    # a word of one letter has no halves; below, its key is its length alone
    rows = rows.where("b - coalesce(more, 0) < 2").unionByName(_halves(rows.where("b - coalesce(more, 0) >= 2")))
    while True:
        rows = saved(rows, "grams")
        held = rows.groupBy("key").agg(F.count(F.when(F.col("more").isNull(), 1)).alias("xs"), F.count("more").alias("ys"))
        held = held.where("xs > 0 and ys > 0 and xs + ys > 2").select("key", (F.col("xs") * F.col("ys") > pairs_per_row * (F.col("xs") + F.col("ys"))).alias("many"))
        open_ = (F.col("b") - F.col("a") - F.coalesce("more", F.lit(0))) >= 2
        met = saved(rows.join(held, "key").withColumn("many", F.col("many") & open_), "met")
        x = met.where("more is null and not many").select("key", F.col("word").alias("x"))
        y = met.where("more is not null and not many").select("key", F.col("word").alias("y"), "more")
        close = x.join(y, "key").where("(more = 1 or x < y) and levenshtein(x, y, 1) = 1").select("x", "y")
        close = saved(close, "close")
        found = close if found is None else found.unionByName(close)
        again = met.where("many")
        if again.isEmpty():
            return found.distinct()
        rows = _halves(again.drop("many"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last word reached by following forms, by doubling the step.

    Every form occurs at least twice as often as its word, so the ways end and their length is at most the
    binary logarithm of the largest count.
    """
    at = saved(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(at.join(further, "root", "left").select("word", "root", "next"), "steps")
        at = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return at


def group_variants(words: DataFrame, stronger: int = STRONGER) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per row of ``words`` (word, n), one row per word.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that is at least
    ``stronger`` times the word's n, else null; ``root`` follows forms to the last. A word without near words is its own root.
    Words that are null are left out; an empty table gives no rows.
    """
    words = saved(words.where("word is not null").select("word", F.col("n").cast("bigint").alias("n")), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("near"))
    both = saved(both.unionByName(pairs.select(F.col("y").alias("word"), F.col("x").alias("near"))), "near")
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    judged = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = -F.col("best.minus") >= stronger * F.col("n")
    forms = words.join(judged, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.minus")).alias("form_n"),
    )
    forms = saved(forms, "forms")
    roots = _roots(forms.where("form is not null"))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_slips(found: DataFrame, one_in: int = 97) -> DataFrame:
    """(word) per row of ``found`` (doc_id, run), in which a fixed share of runs has lost a code point.

    Where ``one_in`` divides the crc32 of ``<doc_id>:<run>``, the code point at crc32 modulo the run's length goes;
    a run without document id stays as it is.
    """
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.select(F.when(h % one_in == 0, cut).otherwise(F.col("run")).alias("word"))
