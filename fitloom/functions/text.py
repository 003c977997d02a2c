"""Text cleaning, tokens and word edits."""

from __future__ import annotations

import json
import string
import zlib
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fitloom.functions.hashing import coin, let

# The English stop words of the widely used NLTK list.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# What may stand between an ampersand and the rest of a text: a number or a name, ended by ";".
ENTITY = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

HIDDEN = "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
TAG = "(?s)<[^>]*>"
BLANKS = "[ \\t\\r\\n\\f]+"


def html_to_text(html: Column, joiner: str = "", decode: bool = True) -> Column:
    """Visible text: hidden bodies and tags out, character entities decoded, blanks folded."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), TAG, joiner)
    if decode:
        text = decode_entities(text)
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def decode_entities(text: Column) -> Column:
    """Named (HTML 4) and numeric entities as characters, each once; what is none of them stays.

    The text is cut at every ampersand, so a decoded ampersand never begins another entity.
    """
    named = hashed_lookup(name2codepoint | {"apos": 39}, "int")

    def one(part, i):
        name = F.regexp_extract(part, ENTITY, 1)
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(name.startswith("#"), F.substr(name, F.lit(2)))
        code = F.coalesce(digits.cast("int"), named(name))
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.substr(part, F.length(name) + 2)
        return F.when(i == 0, part).when(real, F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    return F.array_join(F.transform(F.split(text, "&"), one), "")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z]", " ")


def lower_tokenize(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BLANKS), lambda x: x != "")


def letter_tokens(text: Column) -> Column:
    """``lower_tokenize(letters_only(text))`` at less cost: a run of other characters is one blank, and words are cut at plain blanks."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, "[^a-zA-Z]+", " ")), " "), lambda x: x != "")


_LOWER_LETTERS = np.full(256, ord(" "), np.uint8)
for _c in string.ascii_letters:
    _LOWER_LETTERS[ord(_c)] = ord(_c.lower())


@F.arrow_udf(StringType())
def _lower_letters(text: pa.Array) -> pa.Array:
    """Texts in lower case, every byte that is no A-Z or a-z letter a blank: one table look-up a byte."""
    there, places, data = text.buffers()
    if data is None:
        return text
    return pa.Array.from_buffers(text.type, len(text), [there, places, pa.py_buffer(_LOWER_LETTERS[np.frombuffer(data, np.uint8)])], offset=text.offset)


def batch_letter_tokens(text: Column) -> Column:
    """``letter_tokens`` with the letters picked in Arrow batches, for whole tables of texts; not for use inside a lambda."""
    return F.filter(F.split(_lower_letters(text), " "), lambda x: x != "")


def remove_stopwords(tokens: Column, stop: list[str] = STOP_WORDS) -> Column:
    return F.filter(tokens, lambda x: ~x.isin(stop))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def content_words(markup: Column, stop: list[str] = STOP_WORDS) -> Column:
    """Markup -> lower-case words without stop words, as an array."""
    return remove_stopwords(letter_tokens(html_to_text(markup)), stop)


def review_to_words(markup: Column, stop: list[str] = STOP_WORDS) -> Column:
    return join_tokens(content_words(markup, stop))


def label_prefix(label: Column, text: Column) -> Column:
    """``__label__<label> <text>``"""
    return F.concat(F.lit("__label__"), label.cast("string"), F.lit(" "), text)


def escape_line(text: Column) -> Column:
    """One unquoted line: ',' and '/' get a '/' in front, line breaks become blanks."""
    return F.regexp_replace(F.regexp_replace(text, "[\\r\\n]", " "), "([,/])", "/$1")


# Words in one literal of a plan; larger dictionaries take several.
MAX_LITERAL_WORDS = 50_000


def _literal(rows: list[list], kind: str) -> Column:
    """Constant array<array<kind>>.

    Written as one JSON text, which the optimizer turns into a single literal; an array
    expression with a node per word would be walked by every analysis rule.
    """
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), f"array<array<{kind}>>")


def hashed_lookup(mapping: dict, kind: str):
    """A function ``word column -> mapped value or NULL`` with constant cost per word."""
    names = sorted(mapping)
    parts = [names[i : i + MAX_LITERAL_WORDS] for i in range(0, len(names), MAX_LITERAL_WORDS)] or [[]]
    lookups = [_one_lookup({w: mapping[w] for w in part}, kind) for part in parts]
    return lambda word: F.coalesce(*[look(word) for look in lookups])


def _one_lookup(mapping: dict, kind: str):
    """The dictionary as a literal array of short shelves, addressed by crc32, since a map
    literal would be searched from its start for every word."""
    n = 1
    while n < len(mapping):
        n *= 2
    shelves: list[list[str]] = [[] for _ in range(n)]
    for word in mapping:
        shelves[zlib.crc32(word.encode()) % n].append(word)
    words = _literal(shelves, "string")
    values = _literal([[mapping[w] for w in s] for s in shelves], kind)

    def lookup(word: Column) -> Column:
        slot = (F.crc32(word) % n).cast("int")
        return let(slot, lambda s: F.get(F.get(values, s), (F.array_position(F.get(words, s), word) - 1).cast("int")))

    return lookup


def pad_ids(ids: Column, length: int) -> Column:
    """First ``length`` ids, filled up with 0."""
    kept = F.slice(ids, 1, length)
    return F.concat(kept, F.array_repeat(F.lit(0), F.lit(length) - F.size(kept)))


def attention_mask(ids: Column, length: int) -> Column:
    """1 for real tokens, 0 for padding."""
    kept = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), F.lit(length) - kept))


def _edit_words(text: Column, row_id: Column, p: float, op: str, seed: int, edit) -> Column:
    """Change each blank-separated word with probability ``p``; the rest stays as it is."""

    def one(word, i):
        new = edit(word)
        return F.when(new.isNotNull() & coin(p, row_id, i, op, seed), new).otherwise(word)

    return F.array_join(F.transform(F.split(text, " "), one), " ")


def replace_words(text: Column, row_id: Column, mapping: dict, p: float, op: str, seed: int) -> Column:
    """Words of the dictionary are exchanged with probability ``p`` (synonyms, antonyms)."""
    return _edit_words(text, row_id, p, op, seed, hashed_lookup(mapping, "string"))


def misspell_words(text: Column, row_id: Column, p: float, seed: int) -> Column:
    """The second and third letter of words of four or more letters change places."""

    def swap(word):
        swapped = F.concat(
            F.substring(word, 1, 1), F.substring(word, 3, 1), F.substring(word, 2, 1), F.substr(word, F.lit(4))
        )
        return F.when(F.length(word) >= 4, swapped)

    return _edit_words(text, row_id, p, "spelling", seed, swap)


def drop_words(text: Column, row_id: Column, p: float, seed: int) -> Column:
    """Each word is dropped with probability ``p``."""
    kept = F.filter(F.split(text, " "), lambda w, i: ~coin(p, row_id, i, "drop", seed))
    return F.array_join(kept, " ")
