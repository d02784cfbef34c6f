"""BPE encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vigil.llm import bpe
from vigil.llm import textkernel as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "'", "s", "t", "'re", "'ll", "'ve", " ", "  ", "\n", "\t", "1", "23", "!", "..", "é", "中文", " ", "　", "\x1c", "\x00",
         "Ᲊ", "<|endoftext|>", "<|end", "it's", "🤦🏼‍♂️", "aaaaaaa", "́", "The", "hello", "\U0010ffff"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(b, texts):
    data, off = K.string_parts(pa.array(texts, pa.large_string()))
    ids, first = b.encode(data, off)
    return [ids[first[i]:first[i + 1]].tolist() for i in range(len(texts))]


def mixed_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_librarys(library):
    texts = mixed_texts(3, 3000) + ["", "'s's", "''s", "a's", "'st", " 's", "\n's", "a ", " ", "a\n\n", "<|endoftext|>", "<|endoftext|><|endoftext|> x"]
    texts += ["<|endof", "text|>"]                                 # not one token over two rows
    assert encoded(bpe.Bpe(PATH), texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_very_long_words_and_texts(library):
    rng = random.Random(4)
    words = ["aaaa" * 700 + "the" * 900, "".join(rng.choice("abcdetho") for _ in range(30_000)), "中" * 5000 + "文字" * 3000, "a" * 20_001, "-" * 9999]
    b = bpe.Bpe(PATH)
    assert encoded(b, words) == [library.encode(w, add_special_tokens=False).ids for w in words]
    text = " ".join(mixed_texts(5, 4000)) * 25
    raw = np.frombuffer(text.encode(), np.uint8)
    assert len(raw) > 2 * bpe.PIECE_BYTES
    assert b.encode_long(raw).tolist() == library.encode(text, add_special_tokens=False).ids


def test_merges_out_of_order_go_one_by_one(tmp_path, library):
    spec = json.load(open(PATH))
    merges = spec["model"]["merges"]
    spec["model"]["merges"] = merges[200:2000] + merges[:200]      # tokens merged further before they are made
    path = str(tmp_path / "odd.json")
    json.dump(spec, open(path, "w"))
    b, t = bpe.Bpe(path), Tokenizer.from_file(path)
    texts = ["the theatre on the other hand", "in the beginning", "aaaa hhhh thththth"] + mixed_texts(6, 300)
    assert not b.ordered
    assert encoded(b, texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_decoding_any_ids(library):
    rng, b = random.Random(7), bpe.Bpe(PATH)
    for _ in range(500):
        ids = [rng.randrange(b.n_ids) for _ in range(rng.randint(0, 12))]
        assert b.decode(np.array(ids, np.int64)).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_running_minimum():
    x = np.random.default_rng(1).integers(0, 1000, 500).astype(np.int32)
    for reach in (1, 3, 64, 600):
        assert bpe.reach_minimum(x, reach).tolist() == [int(x[max(0, i - reach):i + reach + 1].min()) for i in range(len(x))]


def test_round_trip_of_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "x <|endoftext|> y"), (3, "x <|endoftext|> y"), (None, "é\n\n"), (4, "word " * 9000)]
    df = spark.createDataFrame([(i, t, "z", 5, [1]) for i, t in rows], "doc_id long, text string, id string, c0 int, ids array<int>")
    got = sorted([tuple(r) for r in bpe.round_trip(df, PATH).collect()], key=str)

    def plain(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        return i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text))
    assert got == sorted([plain(i, t) for i, t in rows], key=str)
    assert bpe.round_trip(df.limit(0), PATH).collect() == []


def test_decoding_unknown_ids(spark):
    df = spark.createDataFrame([(1, [31373, None, -1, 99999, 995]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(df, PATH).collect()} == {1: "hello world", 2: "", 3: ""}
