"""Byte-level BPE: encoding by batched merge rounds, and decoding.

The words (pre-tokenizer's pieces) of a slice of texts are found in arrays of
character classes, each distinct word is encoded once.  Their symbols lie in
one flat array; a round looks up the rank of every changed adjacent pair by
binary search over the sorted pair keys, takes the lowest rank of each word
and merges all its places, left to right, for all words together.  Words that
have no pair left drop out.

Merging all places of a word's lowest pair in one round equals the merges one
by one if no merge that uses a token ranks before the merge that makes it;
that is checked when the file is read, and otherwise a round merges a word's
leftmost lowest pair only.  In a very long word a pair is merged as soon as no
lower one is within the longest token's reach, since nothing beyond can change
its neighbours first, so that far apart places are merged in one round.

Texts longer than ``PIECE_BYTES`` are encoded in pieces that begin where white
space follows another character; the pre-tokenizer never joins the two, so a
text needs memory for a piece (about 60 times its size) and for its ids.  A
text without any such place is one piece.

Defined results: null and empty texts have no ids and decode to an empty text;
strings of added tokens inside texts become their ids; ids decode by their
tokens' bytes, ill-formed UTF-8 becoming U+FFFD; unknown and null ids are left
out; repeated rows are encoded one by one; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.langid import code_points
from vigil.llm.records import chunk_starts
from vigil.llm.storage import gives_back, small_batches

PIECE_BYTES = 1 << 20
LONG_WORD = 1024                    # symbols beyond which pairs within reach decide, not the whole word's
NO_RANK = np.int32(0x7FFFFFFF)

# classes of characters
LETTER, NUMBER, OTHER, WHITE, BLANK, UNSEEN = range(6)
# White_Space of Unicode, and the contractions of the pre-tokenizer's pattern.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def byte_alphabet() -> dict[str, int]:
    """The visible character that stands for each byte in the vocabulary:
    printable Latin-1 as it is, the other bytes from U+0100 on in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class CharClasses:
    """Class of each code point; those Python's Unicode tables do not know yet
    are asked of the tokenizer's own pre-tokenizer when they first occur."""

    def __init__(self, pre_tokenizer):
        self.pre = pre_tokenizer
        kind = {"L": LETTER, "N": NUMBER, "C": OTHER}
        self.of = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            cat = unicodedata.category(chr(c))
            self.of[c] = UNSEEN if cat == "Cn" else kind.get(cat[0], OTHER)
        self.of[WHITE_SPACE] = WHITE
        self.of[0x20] = BLANK

    def __call__(self, cp: np.ndarray) -> np.ndarray:
        out = self.of[cp]
        if (out == UNSEEN).any():
            for c in np.unique(cp[out == UNSEEN]):
                joins = [x for x, lead in ((LETTER, "a"), (NUMBER, "1")) if len(self.pre.pre_tokenize_str(lead + chr(c))) == 1]
                self.of[c] = joins[0] if joins else OTHER
            out = self.of[cp]
        return out


def word_starts(cp: np.ndarray, cls: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Marks the first character of each piece; ``texts`` marks the first
    character of each text.  A word takes one blank before it along; white
    space that ends a text is one piece; a lone apostrophe makes a piece with
    the contraction's letters that follow it."""
    n = len(cp)
    white = cls >= WHITE
    start = texts.copy()
    start[1:] |= (cls[1:] != cls[:-1]) & ~(white[1:] & white[:-1])
    ends = np.append(start[1:], True)                      # last character of each run
    after = np.append(texts[1:], True)                     # a text ends here
    # the last white character before a word begins a piece, with the word if it is a blank
    lead = np.flatnonzero(white & ends & ~after)
    start[lead] = True
    blank = lead[cls[lead] == BLANK]
    start[blank + 1] = False
    # a piece that is just an apostrophe, then letters
    apostrophe = np.flatnonzero((cp == 0x27) & start & ends & ~after)
    apostrophe = apostrophe[cls[apostrophe + 1] == LETTER]
    last = np.append(np.flatnonzero(ends), n - 1)
    run_end = last[np.searchsorted(last, apostrophe + 1)]
    for c in CONTRACTIONS:
        fits = run_end - apostrophe >= len(c)
        for j, x in enumerate(c):
            fits &= cp[np.minimum(apostrophe + 1 + j, n - 1)] == ord(x)
        at = apostrophe[fits]
        start[at + 1] = False
        rest = at + 1 + len(c)
        start[rest[rest < n]] = True
    return start


class Bpe:
    """Vocabulary, merges and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        from tokenizers import Tokenizer
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"] or spec["normalizer"]
                or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges")):
            raise ValueError(f"{path} is no plain byte-level BPE")
        self.classes = CharClasses(Tokenizer.from_file(path).pre_tokenizer)
        vocab, alphabet = model["vocab"], byte_alphabet()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.n_ids = max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]) + 1
        key = left * self.n_ids + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made.astype(np.int32)
        first = np.full(self.n_ids, -1, np.int64)         # rank of the first merge that makes a token
        first[made[::-1]] = np.arange(len(made))[::-1]
        nth = np.arange(len(made))
        self.ordered = bool((first[left] < nth).all() and (first[right] < nth).all())
        # bytes of each id, for decoding, and its digits, for lists of ids
        spell = [b""] * self.n_ids
        for token, i in vocab.items():
            spell[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.reach = max(map(len, spell))
        self.added = {}
        for x in spec["added_tokens"]:
            if x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]:
                raise ValueError(f"added token {x['content']!r} takes in its surroundings")
            spell[x["id"]] = bytes(alphabet[c] for c in x["content"]) if all(c in alphabet for c in x["content"]) else x["content"].encode()
            self.added[x["content"].encode()] = x["id"]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self.spell_at = np.append(0, np.cumsum([len(s) for s in spell]))
        self.spell = np.frombuffer(b"".join(spell), np.uint8)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a.astype(np.int64) * self.n_ids + b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.rank[at], NO_RANK)

    def merge(self, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first) of the words that begin at ``start`` in ``data``; word
        i's ids are ``ids[first[i]:first[i+1]]``."""
        n_words = len(start)
        sym = self.byte_id[data]
        word = np.repeat(np.arange(n_words, dtype=np.int32), np.diff(np.append(start, len(data))))
        rank = np.full(len(sym), NO_RANK, np.int32)         # of the pair (i, i + 1)
        if len(sym) > 1:
            same = np.flatnonzero(word[:-1] == word[1:])
            rank[same] = self._ranks(sym[same], sym[same + 1])
        done_sym, done_word = [], []
        while len(sym):
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(head, len(sym)))
            low = np.minimum.reduceat(rank, head)
            more = low != NO_RANK
            if not more.all():                               # finished words leave
                stay = np.repeat(more, size)
                done_sym.append(sym[~stay])
                done_word.append(word[~stay])
                sym, word, rank = sym[stay], word[stay], rank[stay]
                size, low = size[more], low[more]
                if not len(sym):
                    break
                head = np.cumsum(size) - size
            hit = rank == np.repeat(low, size)
            if not self.ordered:                             # a word's leftmost lowest pair alone
                at = np.flatnonzero(hit)
                hit[:] = False
                hit[at[np.unique(word[at], return_index=True)[1]]] = True
            elif len(size) and size.max() > LONG_WORD:
                hit |= (rank != NO_RANK) & (rank == reach_minimum(rank, self.reach)) & np.repeat(size > LONG_WORD, size)
            at = np.flatnonzero(hit)
            # pairs that overlap are of one rank: every second one of a row of neighbours,
            # if the row is known from its first pair on
            row = np.append(True, at[1:] != at[:-1] + 1)
            nth = np.arange(len(at))
            head_of = np.maximum.accumulate(np.where(row, nth, 0))
            front = at[head_of]
            whole = (front == 0) | (rank[front - 1] != rank[front])
            at = at[((nth - head_of) % 2 == 0) & whole]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, word, rank = sym[keep], word[keep], rank[keep]
            here = place[at]
            renew = np.unique(np.concatenate([here, here[here > 0] - 1]))
            inside = renew < len(sym) - 1
            inside[inside] = word[renew[inside]] == word[renew[inside] + 1]
            rank[renew[~inside]] = NO_RANK
            renew = renew[inside]
            rank[renew] = self._ranks(sym[renew], sym[renew + 1])
        ids = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int32)
        of = np.concatenate(done_word) if done_word else np.zeros(0, np.int32)
        by = np.argsort(of, kind="stable")
        return ids[by], np.append(0, np.cumsum(np.bincount(of, minlength=n_words)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of text i are ``ids[first[i]:first[i+1]]``."""
        special = []                                         # (begin, end, id) of added tokens
        if self.find_added is not None:
            raw = data.tobytes()
            special = [(m.start(), m.end(), self.added[m.group()]) for m in self.find_added.finditer(raw)]
            if special:      # none goes over the end of a text
                row = np.searchsorted(offsets, [s[0] for s in special], side="right") - 1
                special = [s for s, r in zip(special, row) if s[1] <= offsets[r + 1]]
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cp, at = code_points(data)
        texts = np.zeros(len(data) + 1, bool)                # by byte: texts begin, and what follows an added token
        texts[offsets] = True
        for a, b, _ in special:
            texts[a] = texts[b] = True
        texts = texts[at]
        start = at[word_starts(cp, self.classes(cp), texts)]
        for a, b, _ in special:                              # an added token is one piece
            start = start[(start <= a) | (start >= b)]
        length = np.diff(np.append(start, len(data)))
        _, one, which = np.unique(K.span_hash(data, length), return_index=True, return_inverse=True)
        begin, size = start[one], length[one]
        to = np.cumsum(size)
        flat = data[np.repeat(begin - (to - size), size) + np.arange(to[-1])]
        got, first = self.merge(flat, to - size)
        if special:          # added tokens: their own id in place of their spelling's
            spots = np.searchsorted(start, [s[0] for s in special])
            n = np.diff(first)
            got = np.append(got, np.array([s[2] for s in special], np.int32))
            base, n = first[:-1][which], n[which]
            base[spots], n[spots] = first[-1] + np.arange(len(special)), 1
        else:
            base, n = first[:-1][which], np.diff(first)[which]
        total = np.append(0, np.cumsum(n))
        ids = got[np.repeat(base - total[:-1], n) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, offsets)]

    def encode_long(self, data: np.ndarray) -> np.ndarray:
        """Ids of one long text, piece by piece."""
        marks = np.zeros(256, bool)                          # pieces begin at white space only
        cuts, out, a = chunk_starts(data, np.array([0, len(data)]), marks), [], 0
        if self.find_added is not None:                      # never inside an added token
            inside = np.zeros(len(data) + 1, bool)
            for m in self.find_added.finditer(data.tobytes()):
                inside[m.start() + 1:m.end()] = True
            cuts = cuts[~inside[cuts]]
        while a < len(data):
            nxt = np.searchsorted(cuts, a + PIECE_BYTES)
            b = int(cuts[nxt]) if nxt < len(cuts) else len(data)
            out.append(self.encode(data[a:b], np.array([0, b - a]))[0])
            a = b
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of known ids, one after the other."""
        ids = ids[(ids >= 0) & (ids < self.n_ids)]
        size = (self.spell_at[1:] - self.spell_at[:-1])[ids]
        to = np.cumsum(size)
        if not len(ids):
            return b""
        return self.spell[np.repeat(self.spell_at[ids] - (to - size), size) + np.arange(to[-1])].tobytes()


def reach_minimum(x: np.ndarray, reach: int) -> np.ndarray:
    """Lowest value within ``reach`` places on either side of each place: the
    running minima of blocks from both of their ends."""
    width, n = 2 * reach + 1, len(x)
    padded = np.full(-(-(n + 2 * reach) // width) * width, NO_RANK, x.dtype)
    padded[reach:reach + n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[2 * reach:2 * reach + n])


@lru_cache(maxsize=2)
def _bpe(path: str) -> Bpe:
    return Bpe(path)


@gives_back
def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(path)
    for batch in batches:
        data, off = K.string_parts(batch.column(1))
        for a, b in K.slices(off, 4 * K.SLICE_BYTES):
            if b == a + 1 and off[b] - off[a] > PIECE_BYTES:
                ids = bpe.encode_long(data[off[a]:off[b]])
                first = np.array([0, len(ids)])
            else:
                ids, first = bpe.encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))], ["id", "ids"])


@gives_back
def _decode(batches: Iterator[pa.RecordBatch], path: str, keep: int) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(path)
    for batch in batches:
        lists = batch.column(keep)
        texts = []
        for i in range(len(lists)):
            ids = lists[i].values
            known = ids.drop_null().to_numpy() if ids is not None else np.zeros(0, np.int64)
            texts.append(bpe.decode(known).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(texts, pa.string())], [*batch.schema.names[:keep], "decoded"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row of ``docs``: the token ids of its whole text."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([src.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return src.mapInArrow(partial(_encode, path=path), schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The other columns of ``encoded`` and ``decoded``, the text of its ids."""
    names = [n for n in encoded.columns if n != ids_col]
    rows = encoded.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(names)], F.col(ids_col).alias("ids"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(partial(_decode, path=path, keep=len(names)), schema).toDF(*names, "decoded")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: digests of the ids,
    as decimal numbers joined by commas, and of the text decoded from them."""
    ids = encode(docs, path, id_col, text_col)
    digests = ids.select(F.col(id_col), F.size("ids").cast("long").alias("n_tokens"), "ids",
                         F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"))
    return decode(digests, path).select(id_col, "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
