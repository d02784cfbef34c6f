"""Huge texts without spaces are spliced too, at places no piece crosses."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from vigil.llm import tokencount

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def lines(rng, n):
    return "\n".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))) for _ in range(n))


@pytest.mark.parametrize("kind", ["lines", "tabs", "chinese", "digits and marks", "spaces", "cyrillic words"])
def test_chunks_splice_everywhere(kind, monkeypatch):
    rng = random.Random(8)
    text = {"lines": lines(rng, 9000), "tabs": lines(rng, 9000).replace("\n", "\t"),
            "chinese": "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(40_000)),
            "digits and marks": "".join(rng.choice("0123456789.,;é") for _ in range(40_000)),
            "spaces": "".join(rng.choice(["  ", " ", "ab", "the"]) for _ in range(30_000)),
            "cyrillic words": " ".join("".join(rng.choice("абвгдеё") for _ in range(6)) for _ in range(6000))}[kind]
    c = tokencount.Counter(PIECES)
    seen = []
    starts = c.starts
    monkeypatch.setattr(c, "starts", lambda t: (seen.append(len(t)), starts(t))[1])
    assert c.as_written and c.count_huge(text) == c.count([text])[0]
    assert max(seen) <= tokencount.CHUNK + 4 * tokencount.OVERLAP and len(seen) > 2


def test_small_chunks_of_mixed_text():
    rng, c = random.Random(9), tokencount.Counter(PIECES)
    for _ in range(200):
        text = "".join(rng.choice([" ", "\n", "the ", "中", "aaaa", "é", "▁", "  ", "-", "12", "\x00", "🙂", "ing"]) for _ in range(rng.randint(1, 120)))
        assert c.count_huge(text, 16, 4) == c.count([text])[0], repr(text)


def test_letters_that_pieces_join_freely():
    c, text = tokencount.Counter(PIECES), "a" * 3000 + "the" * 1000
    assert not c.apart("a", "a") and c.apart("a", "\n") and c.apart("d", " ") and not c.apart(" ", "t")
    assert c.count_huge(text, 64, 8) == c.count([text])[0]
