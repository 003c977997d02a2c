"""One test per mended finding of round 3."""

from pyspark.sql import functions as F

from fitloom.functions import text as tx
from fitloom.operators import augment, joins, models
from fitloom.sources import readers


def test_joined_exchange_moves_drawn_words_only(spark, monkeypatch):
    joined = []

    def counted(df, *args, **options):
        joined.append(df.count())
        return joins.attach_by_key(df, *args, **options)

    monkeypatch.setattr(augment, "attach_by_key", counted)
    texts = {i: " ".join(f"w{(i * j) % 7}" for j in range(100)) for i in range(1, 21)} | {21: "", 22: " w1  w2 ", 23: None}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    words = {f"w{k}": f"new{k}" for k in range(6)}
    table = spark.createDataFrame([*words.items(), ("w6", None)], "word string, new string")
    found = augment.replace_words_joined(df, "text", "id", table, 0.3, "synonym", 42)
    want = df.select("id", tx.replace_words(F.col("text"), F.col("id"), words, 0.3, "synonym", 42).alias("text"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert len(joined) == 1 and 0 < joined[0] < 1000  # of 2,006 words


def test_many_small_images_are_read_by_few_tasks(spark, tmp_path):
    for i in range(1200):
        (tmp_path / f"{i}.png").write_bytes(b"no image")
    read = readers.read_images(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert read.count() == 1200


def test_letter_tokens_are_those_of_the_two_steps(spark):
    texts = ["", " ", "A,b  c-d\n", "x1y", "ÜnïKode it's", "İI", None, "..", "end."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = df.select(tx.letter_tokens(t), tx.batch_letter_tokens(t), tx.lower_tokenize(tx.letters_only(t))).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] == [r[2] for r in rows]


def test_word_pairs_are_counted_once_per_fit(spark, monkeypatch):
    rows = [(i, [f"w{(i * j) % 5}" for j in range(12)], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, label double")
    fitted = []

    def spied(estimator, rows):
        fitted.append(rows.columns)
        return fit(estimator, rows)

    fit = models._fit_kept
    monkeypatch.setattr(models, "_fit_kept", spied)
    model = models.fit_text_linear(df, "tokens", "label", buckets=64, rounds=5)
    again = models.fit_text_linear(models.with_word_pairs(df, "tokens", 64).drop("tokens"), "tokens", "label", buckets=64, rounds=5)
    assert fitted == [["features", "label"]] * 2
    guess = [[r[0] for r in m.transform(df).orderBy("id").select("prediction").collect()] for m in (model, again)]
    assert guess[0] == guess[1]
