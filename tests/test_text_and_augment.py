from collections import Counter

import pytest
from pyspark.sql import functions as F

from fitloom.functions import text as tx
from fitloom.operators import augment, words


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "html, plain",
    [
        ("<p>a</p><p>b</p>", "ab"),
        ("<p>x &amp; y &lt;z&gt; &quot;q&quot; it&#39;s</p>", "x & y <z> \"q\" it's"),
        ("&amp;lt;", "&lt;"),
        ("<script>var a='<b>';</script>t<style>p{}</style><!-- no -->e", "te"),
        ("  many \n\t blanks  ", "many blanks"),
        ("", ""),
        ("<br/>", ""),
    ],
)
def test_html(spark, html, plain):
    assert one(spark, html, tx.html_to_text) == plain


def test_entities(spark):
    html = "<p>caf&eacute;&nbsp;ol&#233; it&#8217;s&#x21; A&amp;lt;B &copy; &middot; R&D; &nosuch; &#0; &#55296; a & b&</p>"
    assert one(spark, html, tx.html_to_text) == "caf\u00e9\u00a0ol\u00e9 it\u2019s! A&lt;B \u00a9 \u00b7 R&D; &nosuch; &#0; &#55296; a & b&"
    assert one(spark, "<b>room</b>&nbsp;&copy;&middot;good", tx.review_to_words) == "room good"


def test_review_to_words(spark):
    assert one(spark, "<b>The</b> Room wasn't good, 10/10 would NOT stay!", tx.review_to_words) == "room good would stay"
    assert one(spark, "!!! 123", tx.review_to_words) == ""


def test_stop_list_is_whole():
    assert len(tx.STOP_WORDS) == len(set(tx.STOP_WORDS)) == 179


def test_escape_line(spark):
    assert one(spark, 'a,b/c "d"\ne', tx.escape_line) == 'a/,b//c "d" e'


def test_vocabulary_ties_and_counts(spark):
    df = spark.createDataFrame([(1, "bb aa cc x"), (2, "cc zz"), (3, ""), (4, None)], "id int, t string")
    tokens = tx.lower_tokenize(F.col("t"))
    vocab = words.bow_vocabulary(df, tokens, size=3)
    assert {(r["word"], r["n"], r["idx"]) for r in vocab.collect()} == {("aa", 1, 0), ("bb", 1, 1), ("cc", 2, 2)}
    known = words.vocabulary_words(vocab)
    assert {tuple(r) for r in words.bow_counts(df.where("t is not null"), tokens, known, ["id"]).collect()} == {(1, 0, 1), (1, 1, 1), (1, 2, 1), (2, 2, 1)}


@pytest.mark.parametrize("limit", [50_000, 1])
def test_token_ids_inside_the_row_and_joined(spark, monkeypatch, limit):
    monkeypatch.setattr(words, "MAX_LITERAL_WORDS", limit)
    df = spark.createDataFrame([(1, "bb aa nope bb"), (2, ""), (3, "aa aa aa aa aa aa")], "id int, t string")
    vocab = spark.createDataFrame([("aa", 5, 0), ("bb", 2, 1)], "word string, n bigint, idx int")
    out = words.tokenize_pad_truncate(df, tx.lower_tokenize(F.col("t")), vocab, 5, ["id"])
    got = {r["id"]: (list(r["input_ids"]), list(r["attention_mask"])) for r in out.collect()}
    assert got == {
        1: ([3, 2, 1, 3, 0], [1, 1, 1, 1, 0]),
        2: ([0] * 5, [0] * 5),
        3: ([2] * 5, [1] * 5),
    }


def test_lookup_with_quotes_and_many_words(spark):
    mapping = {f"w{i}": f"v{i}'\\" for i in range(300)} | {"it's": "it is", "é": "e"}
    lookup = tx.hashed_lookup(mapping, "string")
    rows = [(w,) for w in [*mapping, "absent"]]
    got = {r["w"]: r["v"] for r in spark.createDataFrame(rows, "w string").select("w", lookup(F.col("w")).alias("v")).collect()}
    assert got == {**mapping, "absent": None}


def test_lookup_in_several_literals(spark, monkeypatch):
    monkeypatch.setattr(tx, "MAX_LITERAL_WORDS", 2)
    mapping = {"a": "1", "b": "2", "c": "3", "d": "4", "e": "5"}
    look = tx.hashed_lookup(mapping, "string")
    rows = spark.createDataFrame([(w,) for w in "abcdef"], "w string").select("w", look(F.col("w")).alias("v")).collect()
    assert {r["w"]: r["v"] for r in rows} == {**mapping, "f": None}
    assert spark.range(1).select(tx.hashed_lookup({}, "string")(F.lit("a")).alias("v")).first()["v"] is None


EDITS = augment.WordEdits(synonyms={"good": "fine"}, antonyms={"good": "bad"}, share=1.0)


def test_each_edit(spark):
    df = spark.createDataFrame([(1, "good  room\nabcd")], "id int, t string")
    edit = lambda kind: augment.augmented(df, "t", "id", kind, EDITS).first()["t"]
    assert edit("synonym") == "fine  room\nabcd"
    assert edit("antonym") == "bad  room\nabcd"
    assert edit("spelling") == "good  room\nabcd"  # equal letters change places
    assert edit("random") == ""
    other = spark.createDataFrame([(1, "stay cat nights")], "id int, t string")
    assert augment.augmented(other, "t", "id", "spelling", EDITS).first()["t"] == "saty cat ngihts"


def test_share_of_edited_words(spark):
    df = spark.createDataFrame([(i, " ".join(["good"] * 50)) for i in range(40)], "id int, t string")
    half = augment.WordEdits(synonyms={"good": "fine"}, share=0.3)
    n = sum(r["t"].split().count("fine") for r in augment.augmented(df, "t", "id", "synonym", half).collect())
    assert 450 < n < 750


def sizes(df):
    return Counter((r["label"], r["edit"]) for r in df.collect())


def test_augment_mixes_and_cap(spark):
    counts = {0: 2, 1: 3, 2: 4, 3: 5, 4: 8}
    rows = [(c * 100 + i, c, "good day") for c, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id int, label int, t string")
    plain = sizes(augment.augment_minority(df, "t", "id", "label", EDITS))
    assert {k: v for k, v in plain.items() if k[1] != "none"} == {(0, "synonym"): 2, (1, "synonym"): 3, (2, "synonym"): 4, (3, "synonym"): 3}
    last = sizes(augment.augment_minority(df, "t", "id", "label", EDITS, last_class_only=True))
    assert {k: v for k, v in last.items() if k[1] != "none"} == {(3, "synonym"): 3}
    full = sizes(augment.augment_full(df, "t", "id", "label", EDITS))
    assert full[0, "random"] == 2 and full[2, "antonym"] == 4 and (2, "random") not in full and full[3, "synonym"] == 3


def test_cap_below_zero_adds_nothing(spark):
    df = spark.createDataFrame([(i, 3, "good") for i in range(4)] + [(9, 4, "good")], "id int, label int, t string")
    assert sizes(augment.augment_minority(df, "t", "id", "label", EDITS)) == {(3, "none"): 4, (4, "none"): 1}


def test_append_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert {tuple(r) for r in augment.append_rows(a, b, a).collect()} == {(1, "x"), (2, "y")}


def test_append_with_a_fresh_index(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    rows = augment.append_rows(a, a.limit(0), a, ids=["i"]).collect()
    assert sorted(r["idx"] for r in rows) == [0, 1, 2, 3] and sorted(r["i"] for r in rows) == [1, 1, 2, 2]
