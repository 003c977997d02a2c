"""More rows for rare classes by editing the words of their texts."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.functions.hashing import coin
from fitloom.functions.text import MAX_LITERAL_WORDS, drop_words, misspell_words, replace_words
from fitloom.operators.joins import attach_by_key
from fitloom.operators.rank import find_cuts
from fitloom.operators.splits import reset_index

# Texts that a task unpacks at a time to put words back.
PUT_ROWS = 500


@dataclass(frozen=True)
class WordEdits:
    """Dictionaries given by the user, share of edited words and seed.

    A dictionary is a dict or a table (word, new) of any size with one row per word; a table, and a dict of
    more words than one literal holds, is joined to the words and never becomes part of the plan.
    """

    synonyms: dict[str, str] | DataFrame = field(default_factory=dict)
    antonyms: dict[str, str] | DataFrame = field(default_factory=dict)
    share: float = 0.3
    seed: int = 42

    def edit(self, kind: str, text: Column, row_id: Column) -> Column:
        if kind == "synonym":
            return replace_words(text, row_id, self.synonyms, self.share, "synonym", self.seed)
        if kind == "antonym":
            return replace_words(text, row_id, self.antonyms, self.share, "antonym", self.seed)
        if kind == "spelling":
            return misspell_words(text, row_id, self.share, self.seed)
        if kind == "random":
            return drop_words(text, row_id, self.share, self.seed)
        raise ValueError(kind)


    def joined(self, kind: str) -> dict | DataFrame | None:
        """The dictionary of an edit that takes a join, else None."""
        words = {"synonym": self.synonyms, "antonym": self.antonyms}.get(kind, {})
        return words if isinstance(words, DataFrame) or len(words) > MAX_LITERAL_WORDS else None


def replace_words_joined(df: DataFrame, text: str, row_id: str, words: dict | DataFrame, p: float, op: str, seed: int) -> DataFrame:
    """``df`` with each word of ``text`` that is in the dictionary exchanged with probability ``p``, as ``replace_words`` does.

    Only the words drawn for an exchange leave their texts: they are joined to the dictionary by ``attach_by_key``, so a frequent
    word is split over many tasks, and those found come back, as one list per text, to be put in their places. ``row_id``
    is unique and not null. A null text stays null; words that are null or mapped to null stay.
    """
    if isinstance(words, dict):
        words = df.sparkSession.createDataFrame(list(words.items()), "word string, new string")
    table = words.select(F.col("word").alias("__word"), F.col("new").alias("__new")).where("__word is not null and __new is not null")
    places = df.select(row_id, F.posexplode(F.split(text, " ")).alias("__pos", "__word"))
    drawn = places.where(coin(p, F.col(row_id), F.col("__pos"), op, seed))
    found = attach_by_key(drawn, table, ["__word"], [row_id, "__pos"])
    cells = found.groupBy(row_id).agg(F.collect_list(F.struct("__pos", "__word", "__new")).alias("__cells"))
    whole = df.groupBy(row_id).agg(F.collect_list(text).alias("__texts")).where(F.size("__texts") > 0).join(cells, row_id, "left")
    parts = whole.select(row_id, "__texts", *[F.col("__cells")[c].alias(c) for c in ("__pos", "__word", "__new")])
    edited = parts.mapInArrow(_put_back, f"`{row_id}` {dict(df.dtypes)[row_id]}, __text string")
    return df.join(edited, row_id, "left").withColumn(text, F.col("__text")).select(*df.columns)


def _put_back(batches):
    """Task code: (row id, text) with the new words in the places of the old ones; texts of one id are laid together place by place."""
    for batch in batches:
        for i in range(0, batch.num_rows, PUT_ROWS):
            part = batch.slice(i, PUT_ROWS)
            texts, cells = part.column(1).to_pylist(), [part.column(c) for c in range(2, 5)]
            pos, new = cells[0].flatten().to_pylist(), cells[2].flatten().to_pylist()
            ends = np.cumsum(np.nan_to_num(cells[0].value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64).tolist()
            out = []
            for row, (t, lo, hi) in enumerate(zip(texts, [0, *ends], ends)):
                at, now = pos[lo:hi], new[lo:hi]
                if len(t) == 1 and len(set(at)) == len(at):
                    places = t[0].split(" ")
                    for k, word in zip(at, now):
                        places[k] = word
                    out.append(" ".join(places))
                else:
                    gone = set(zip(at, cells[1][row].as_py() or []))
                    stay = [c for x in t for c in enumerate(x.split(" ")) if c not in gone]
                    out.append(" ".join(word for _, word in sorted([*stay, *zip(at, now)])))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=[part.schema.names[0], "__text"])


def augmented(df: DataFrame, text: str, row_id: str, kind: str, edits: WordEdits) -> DataFrame:
    """One new row per row with the edited text; column ``edit`` names the kind."""
    return _edited(df.withColumn("edit", F.lit(kind)), text, row_id, [kind], edits)


def _edited(df: DataFrame, text: str, row_id: str, kinds: list[str], edits: WordEdits) -> DataFrame:
    """Rows whose ``edit`` is one of ``kinds`` with their texts edited; others stay. A row id occurs once per edit at most."""
    new, parts = F.col(text), []
    for kind in kinds:
        words = edits.joined(kind)
        if words is None:
            new = F.when(F.col("edit") == kind, edits.edit(kind, F.col(text), F.col(row_id))).otherwise(new)
        else:
            parts.append(replace_words_joined(df.where(F.col("edit") == kind), text, row_id, words, edits.share, kind, edits.seed))
    apart = [kind for kind in kinds if edits.joined(kind) is not None]
    out = (df.where(~F.col("edit").isin(apart)) if apart else df).withColumn(text, new)
    for part in parts:
        out = out.unionByName(part)
    return out


# Which edits each class gets; the last class in the list is capped.
PLAIN_MIX = {0: ("synonym",), 1: ("synonym",), 2: ("synonym",), 3: ("synonym",)}
FULL_MIX = {
    0: ("synonym", "random", "spelling", "antonym"),
    1: ("synonym", "random", "spelling", "antonym"),
    2: ("synonym", "spelling", "antonym"),
    3: ("synonym",),
}
CAPPED, LARGEST = 3, 4


def _augment(df: DataFrame, text: str, row_id: str, label: str, edits: WordEdits, mix: dict, last_class_only: bool) -> DataFrame:
    """Rows and their edited copies from one scan; column ``edit`` is "none" for the rows.

    Two small passes before it count the two classes of the cap and find its last row.
    """
    sizes = df.agg(
        F.count_if(F.col(label) == LARGEST).alias("largest"), F.count_if(F.col(label) == CAPPED).alias("capped")
    ).first()
    room = max(sizes["largest"] - sizes["capped"], 0)
    within = F.lit(True)
    if room < sizes["capped"]:
        _, (cut,) = find_cuts(df.where(F.col(label) == CAPPED), [row_id], edits.seed, lambda n: [room])
        within = cut.holds()
    kinds = F.array(F.lit("none"))
    for c, copies in mix.items():
        if c == CAPPED or not last_class_only:
            here = F.col(label) == c
            here = here & within if c == CAPPED else here
            kinds = F.when(here, F.array(F.lit("none"), *[F.lit(x) for x in copies])).otherwise(kinds)
    return _edited(df.withColumn("edit", F.explode(kinds)), text, row_id, sorted({x for copies in mix.values() for x in copies}), edits)


def augment_minority(df: DataFrame, text: str, row_id: str, label: str, edits: WordEdits, last_class_only: bool = False) -> DataFrame:
    """Append synonym copies of classes 0 to 3; class 3 only up to the size of class 4."""
    return _augment(df, text, row_id, label, edits, PLAIN_MIX, last_class_only)


def augment_full(df: DataFrame, text: str, row_id: str, label: str, edits: WordEdits, last_class_only: bool = False) -> DataFrame:
    """Append the class-dependent mix of edits; class 3 capped as before."""
    return _augment(df, text, row_id, label, edits, FULL_MIX, last_class_only)


def append_rows(*frames: DataFrame, ids: list[str] | None = None, out: str = "idx", seed: int = 42) -> DataFrame:
    """All rows of all frames, columns matched by name.

    With ``ids``, unique in each frame, the rows get a fresh consecutive 0-based index ``out`` in
    place of ids that repeat between the frames.
    """
    if ids is not None:
        frames = tuple(f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames))
    united = frames[0]
    for f in frames[1:]:
        united = united.unionByName(f)
    return united if ids is None else reset_index(united, ["__frame", *ids], seed, out).drop("__frame")
