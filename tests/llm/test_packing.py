"""Packed sequences: every id once, no gaps, little padding."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from tokenizers import Tokenizer

from fitloom.llm import packing
from fitloom.llm.packing import Packer, pack
from fitloom.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def check(rows, texts, capacity=2048):
    tok = Tokenizer.from_file(tokenizer_path())
    ids = {k: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for k, t in texts.items()}
    at, fill = dict.fromkeys(ids, 0), {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.start)):
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length > 0 and r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        at[r.doc_id] += r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {k: len(v) for k, v in ids.items()}
    padding = 0
    for pieces in fill.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    return padding


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert check(QUERIES["op5_pack"](spark, FOLDER).collect(), texts) == 0


def test_edge_texts(spark):
    texts = {1: None, 2: "", 3: " \n", 4: "It's <|endoftext|> we'll", 5: "ab12,x'd;;é.́x İ ﬁ y\x85z Σ≠", 6: "word " * 30000, 7: "a\x00b!?c", None: "no id"}
    frame = spark.createDataFrame([(k, v, 1, 2) for k, v in texts.items()], "doc_id long, text string, start int, ids int")
    assert check(pack(frame, tokenizer_path()).collect(), texts) == 0
    assert pack(frame.limit(0), tokenizer_path()).count() == 0


def random_texts(n):
    rng = np.random.default_rng(2)
    letters = np.array([*"aeiourstlnTHÉßçÿÀö"])
    word = lambda: "".join(rng.choice(letters, rng.integers(1, 12)))
    words = [word() for _ in range(n)]
    marks = [" ", "  ", "\n", ", ", ". ", "'s ", "7", "-", " e\u0301 ", " × ", " . ", "ª"]
    return ["".join(words[i] + marks[j] for i, j in zip(rng.integers(n, size=n // 10), rng.choice(len(marks), n // 10, p=[0.89, *[0.01] * 11]))) for _ in range(30)]


def whole_ids(texts):
    tok = Tokenizer.from_file(tokenizer_path())
    return [[*tok.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_words_of_letters_go_many_to_a_text(monkeypatch):
    passed = []

    class Spied:
        def __init__(self, made):
            vars(self)["made"] = made if isinstance(made, Tokenizer) else Tokenizer(made)

        def __getattr__(self, name):
            return getattr(self.made, name)

        def __setattr__(self, name, value):
            setattr(self.made, name, value)

        @classmethod
        def from_file(cls, path):
            return cls(Tokenizer.from_file(path))

        def encode_batch_fast(self, texts, **options):
            passed.extend(texts)
            return self.made.encode_batch_fast(texts, **options)

    texts = random_texts(20000)
    want = whole_ids(texts)
    monkeypatch.setattr(tokenizers, "Tokenizer", Spied)
    assert [x.tolist() for x in packing.token_ids(pa.array(texts), tokenizer_path(), 1)] == want
    assert len({w for t in texts for w in t.split()}) > 15000 and len(passed) < 3000


@pytest.mark.parametrize("slots, room", [(1, 1 << 14), (16, 1 << 14), (1 << 12, 40), (1 << 12, 1 << 14)])
def test_ids_when_known_segments_lose_their_place(monkeypatch, slots, room):
    monkeypatch.setattr(packing, "SLOTS", slots)
    monkeypatch.setattr(packing, "ROOM", room)
    monkeypatch.setattr(packing, "_known", {})
    texts = random_texts(3000)
    segments = packing.Segments(tokenizer_path())
    rows = [x for t in texts * 2 for x in packing.token_ids(pa.array([t]), tokenizer_path(), 1, segments)]
    assert [x.tolist() for x in rows] == whole_ids(texts) * 2


@pytest.mark.parametrize("max_open", [3, 1000])
def test_packer_rule(max_open):
    rng, done = np.random.default_rng(1), []
    packer = Packer(done.append, 64, max_open)
    sizes = [int(n) for n in rng.integers(1, 200, 500)]
    for i, n in enumerate(sizes):
        packer.add(i, np.arange(n, dtype=np.int32))
        assert packer.open <= max_open
    packer.settle()
    pieces = sorted((d, s, len(x)) for w in done for d, s, x in w)
    for i, n in enumerate(sizes):
        own = [p for p in pieces if p[0] == i]
        assert [p[1] for p in own] == list(np.cumsum([0, *[p[2] for p in own]])[:-1]) and sum(p[2] for p in own) == n
    fill = [sum(len(x) for _, _, x in w) for w in done]
    assert all(f == 64 or f & (f - 1) == 0 for f in fill)
