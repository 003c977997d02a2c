"""Text cleaning, bag of words, token ids and augmentation."""

from html.entities import name2codepoint

from pyspark.sql import functions as F

from fitloom.functions import text as tx
from fitloom.operators import augment, splits, words
from fitloom.plans.registry import SQL_RATING, query, rating, sql_rank, sql_uniform
from fitloom.sources.readers import table


def _sql_list(items) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in items) + "]"


def _sql_entities(x: str) -> str:
    names = "MAP {" + ", ".join(f"'{n}': {c}" for n, c in (name2codepoint | {"apos": 39}).items()) + "}"
    name = f"regexp_extract(p, '{tx.ENTITY}', 1)"
    code = (
        f"CASE WHEN lower({name}[1:2]) = '#x' THEN ('0x' || {name}[3:])::INTEGER WHEN {name}[1:1] = '#' THEN {name}[2:]::INTEGER "
        f"ELSE {names}[{name}] END"
    )
    parts = f"list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE coalesce(chr(nullif({code}, 0)) || p[length({name}) + 2:], '&' || p) END)"
    return f"array_to_string({parts}, '')"


def _sql_html(x: str) -> str:
    out = f"regexp_replace(regexp_replace({x}, '{tx.HIDDEN}', '', 'g'), '{tx.TAG}', '', 'g')"
    return f"trim(regexp_replace({_sql_entities(out)}, '{tx.BLANKS}', ' ', 'g'))"


def _sql_letters(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z]', ' ', 'g')"


def _sql_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({_sql_letters(x)}), '{tx.BLANKS}'), lambda w: w <> '')"


def _sql_content(x: str) -> str:
    return f"list_filter({_sql_tokens(x)}, lambda w: NOT list_contains({_sql_list(tx.STOP_WORDS)}, w))"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text", "lang")


def _tokens(col="text"):
    return tx.lower_tokenize(tx.letters_only(F.col(col)))


def _content(col="text"):
    return tx.remove_stopwords(tx.batch_letter_tokens(F.col(col)))


@query("html_to_text", f"SELECT page_id, {_sql_html('html')} AS text FROM pages")
def html_to_text(spark, d):
    return table(spark, d, "pages").select("page_id", "html").select("page_id", tx.html_to_text(F.col("html")).alias("text"))


@query("letters_only", f"SELECT doc_id, {_sql_letters('text')} AS text FROM documents")
def letters_only(spark, d):
    return _docs(spark, d).select("doc_id", tx.letters_only(F.col("text")).alias("text"))


@query("lower_tokenize", f"SELECT doc_id, len(t)::INTEGER AS n, array_to_string(t, '|') AS tokens FROM (SELECT doc_id, {_sql_tokens('text')} AS t FROM documents)")
def lower_tokenize(spark, d):
    return _docs(spark, d).select("doc_id", _tokens().alias("t")).select("doc_id", F.size("t").alias("n"), F.array_join("t", "|").alias("tokens"))


@query("remove_stopwords", f"SELECT doc_id, len(t)::INTEGER AS n, array_to_string(t, '|') AS tokens FROM (SELECT doc_id, {_sql_content('text')} AS t FROM documents)")
def remove_stopwords(spark, d):
    kept = _docs(spark, d).select("doc_id", tx.remove_stopwords(_tokens()).alias("t"))
    return kept.select("doc_id", F.size("t").alias("n"), F.array_join("t", "|").alias("tokens"))


@query("join_tokens", f"SELECT doc_id, array_to_string({_sql_tokens('text')}, ' ') AS text FROM documents")
def join_tokens(spark, d):
    return _docs(spark, d).select("doc_id", tx.join_tokens(_tokens()).alias("text"))


@query("review_to_words", f"SELECT page_id, array_to_string({_sql_content(_sql_html('html'))}, ' ') AS words FROM pages")
def review_to_words(spark, d):
    return table(spark, d, "pages").select("page_id", "html").select("page_id", tx.review_to_words(F.col("html")).alias("words"))


_SQL_HELD = f"SELECT *, {sql_rank(42, 'doc_id')} AS k, count(*) OVER () AS n FROM documents"


def _sql_vocab(source: str, size: int = 1000) -> str:
    return (
        f"SELECT word, n, (row_number() OVER (ORDER BY word) - 1)::INTEGER AS idx FROM (SELECT word, count(*) AS n FROM "
        f"(SELECT unnest({_sql_content('text')}) AS word FROM ({source})) WHERE len(word) >= 2 GROUP BY word ORDER BY n DESC, word LIMIT {size})"
    )


@query("bow_vocabulary", _sql_vocab("SELECT text FROM documents"))
def bow_vocabulary(spark, d):
    return words.bow_vocabulary(_docs(spark, d), _content())


def _sql_counts(vocab_of: str, counted: str) -> str:
    return (
        f"WITH v AS ({_sql_vocab(vocab_of)}), w AS (SELECT doc_id, unnest({_sql_content('text')}) AS word FROM ({counted})) "
        "SELECT doc_id, idx, count(*) AS n FROM w JOIN v USING (word) GROUP BY doc_id, idx"
    )


@query("bow_counts", _sql_counts("SELECT text FROM documents", "SELECT doc_id, text FROM documents"))
def bow_counts(spark, d):
    tokens = _content()
    vocab = words.vocabulary_words(words.bow_vocabulary(_docs(spark, d), tokens))
    return words.bow_counts(_docs(spark, d), tokens, vocab, ["doc_id"])


@query(
    "bow_apply",
    _sql_counts(f"SELECT text FROM ({_SQL_HELD}) WHERE k > ceil(0.3::DOUBLE * n)", f"SELECT doc_id, text FROM ({_SQL_HELD}) WHERE k <= ceil(0.3::DOUBLE * n)"),
)
def bow_apply(spark, d):
    tokens = _content()
    parts = splits.holdout_split(_docs(spark, d), ["doc_id"], 0.3)
    vocab = words.vocabulary_words(words.bow_vocabulary(parts.where("split = 'train'"), tokens))
    return words.bow_counts(parts.where("split = 'holdout'"), tokens, vocab, ["doc_id"])


@query("label_prefix_format", "SELECT d.doc_id, '__label__' || quality || ' ' || text AS line FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def label_prefix_format(spark, d):
    joined = _docs(spark, d).join(table(spark, d, "labels"), "doc_id")
    return joined.select("doc_id", tx.label_prefix(F.col("quality"), F.col("text")).alias("line"))


@query(
    "tokenize_pad_truncate",
    f"WITH v AS ({_sql_vocab('SELECT text FROM documents')}), "
    f"t AS (SELECT doc_id, unnest(list_slice(t, 1, 64)) AS word, unnest(range(least(len(t), 64))) AS pos FROM (SELECT doc_id, {_sql_content('text')} AS t FROM documents)), "
    "c AS (SELECT doc_id, list(coalesce(idx + 2, 1) ORDER BY pos) AS ids FROM t LEFT JOIN v USING (word) GROUP BY doc_id), "
    "a AS (SELECT d.doc_id, coalesce(ids, []::INTEGER[]) AS ids FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id) "
    "SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(64 - len(ids)), lambda x: 0)), ' ') AS input_ids, "
    "array_to_string(list_concat(list_transform(ids, lambda x: 1), list_transform(range(64 - len(ids)), lambda x: 0)), ' ') AS attention_mask FROM a",
)
def tokenize_pad_truncate(spark, d):
    tokens = _content()
    vocab = words.bow_vocabulary(_docs(spark, d), tokens)
    coded = words.tokenize_pad_truncate(_docs(spark, d), tokens, vocab, 64, ["doc_id"])
    return coded.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"), F.array_join("attention_mask", " ").alias("attention_mask"))


# Small dictionaries in the languages of the documents; users bring their own.
EDITS = augment.WordEdits(
    synonyms={"the": "that", "and": "plus", "with": "alongside", "by": "via", "is": "exists", "le": "ce", "la": "cette", "der": "jener", "und": "sowie", "el": "aquel"},
    antonyms={"with": "without", "in": "out", "on": "off", "is": "isn't", "un": "aucun", "que": "sauf", "ein": "kein"},
)


def _sql_coin(op: str) -> str:
    return f"{sql_uniform(f'''doc_id::VARCHAR || ':' || (i - 1)::VARCHAR || ':{op}:42\'''')} < 0.3::DOUBLE"


def _sql_map(mapping: dict) -> str:
    return "CASE w " + " ".join("WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in mapping.items()) + " ELSE NULL END"


def _sql_edit(kind: str) -> str:
    base = "string_split(text, ' ')"
    if kind in ("synonym", "antonym"):
        new = _sql_map(EDITS.synonyms if kind == "synonym" else EDITS.antonyms)
        one = f"CASE WHEN {_sql_coin(kind)} THEN coalesce({new}, w) ELSE w END"
    elif kind == "spelling":
        one = f"CASE WHEN length(w) >= 4 AND {_sql_coin(kind)} THEN substr(w, 1, 1) || substr(w, 3, 1) || substr(w, 2, 1) || substr(w, 4) ELSE w END"
    else:
        return f"array_to_string(list_filter({base}, lambda w, i: NOT ({_sql_coin('drop')})), ' ')"
    return f"array_to_string(list_transform({base}, lambda w, i: {one}), ' ')"


def _edited(spark, d, kind):
    return augment.augmented(_docs(spark, d).select("doc_id", "text"), "text", "doc_id", kind, EDITS)


for _kind, _name in (("synonym", "synonym_augment"), ("antonym", "antonym_augment"), ("spelling", "spelling_augment"), ("random", "random_word_augment")):
    query(_name, f"SELECT doc_id, {_sql_edit(_kind)} AS text, '{_kind}' AS edit FROM documents")(
        lambda spark, d, kind=_kind: _edited(spark, d, kind)
    )


def _long_words(spark, d):
    """A dictionary that grows with the documents: every word of four letters or more, and that word with a mark."""
    words = table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("word")).where(F.length("word") >= 4).distinct()
    return words.select("word", F.concat("word", F.lit("~")).alias("new"))


def _sql_marked(op: str) -> str:
    return f"array_to_string(list_transform(string_split(text, ' '), lambda w, i: CASE WHEN length(w) >= 4 AND {_sql_coin(op)} THEN w || '~' ELSE w END), ' ')"


@query("synonym_augment_joined", f"SELECT doc_id, {_sql_marked('synonym')} AS text, 'synonym' AS edit FROM documents")
def synonym_augment_joined(spark, d):
    edits = augment.WordEdits(synonyms=_long_words(spark, d))
    return augment.augmented(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id", "synonym", edits)


@query("antonym_augment_joined", f"SELECT doc_id, {_sql_marked('antonym')} AS text, 'antonym' AS edit FROM documents")
def antonym_augment_joined(spark, d):
    edits = augment.WordEdits(antonyms=_long_words(spark, d))
    return augment.augmented(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id", "antonym", edits)


def _rated(spark, d):
    return _docs(spark, d).select("doc_id", "text", rating(F.col("lang")).alias("rating"))


def _sql_augmented(mix: dict) -> str:
    by_kind: dict[str, list[str]] = {}
    for c, kinds in mix.items():
        for kind in kinds:
            if c != augment.CAPPED:
                by_kind.setdefault(kind, []).append(str(c))
    parts = ["SELECT doc_id, text, rating, 'none' AS edit FROM r"]
    parts += [f"SELECT doc_id, {_sql_edit(k)}, rating, '{k}' FROM r WHERE rating IN ({', '.join(cs)})" for k, cs in by_kind.items()]
    parts.append(f"SELECT doc_id, {_sql_edit('synonym')}, rating, 'synonym' FROM c WHERE p <= room")
    return (
        f"WITH r AS (SELECT doc_id, text, ({SQL_RATING})::INTEGER AS rating FROM documents), "
        f"c AS (SELECT *, {sql_rank(42, 'doc_id')} AS p, (SELECT count(*) FILTER (rating = 4) - count(*) FILTER (rating = 3) FROM r) AS room FROM r WHERE rating = 3) "
        + " UNION ALL ".join(parts)
    )


@query("augment_minority", _sql_augmented(augment.PLAIN_MIX))
def augment_minority(spark, d):
    return augment.augment_minority(_rated(spark, d), "text", "doc_id", "rating", EDITS)


@query("augment_full", _sql_augmented(augment.FULL_MIX))
def augment_full(spark, d):
    return augment.augment_full(_rated(spark, d), "text", "doc_id", "rating", EDITS)


@query("augment_minority_joined", _sql_augmented(augment.PLAIN_MIX).replace(_sql_edit("synonym"), _sql_marked("synonym")))
def augment_minority_joined(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", rating(F.col("lang")).alias("rating"))
    return augment.augment_minority(rows, "text", "doc_id", "rating", augment.WordEdits(synonyms=_long_words(spark, d)))
