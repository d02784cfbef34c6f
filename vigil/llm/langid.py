"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character 1- to 3-grams
over all training documents.  A document is compared by the out-of-place
distance: for each of its own most frequent n-grams, how far its rank is from
its rank in the profile, or the profile's length where the profile lacks it.

N-grams are taken inside words (runs of letters, lower-cased) with one blank
on either side, and are packed exactly into 63 bits (three code points).
Ranks go by count, then by the packed value, so reruns agree.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text when nothing could be learned; documents with a null id or a
null language teach nothing (a null id counts as held out); ties between
languages go to the first by code point; repeated rows count once each; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.storage import gives_back, small_batches

UNKNOWN = "und"
RANKS = 300                 # n-grams of a profile, and of a document
MIN_SCORE = 0.3             # of a document whose language can be told
MIN_MARGIN = 0.01           # by which its language is nearer than the next, of the largest distance
_NONE = 0x1FFFFF            # no character: above every code point
_HELD_GRAMS = 400_000       # a training task passes its counts on beyond this many


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, 0 for everything that is no letter."""
    out = np.zeros(0x110000, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code point, byte position) of each character of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    b0 = data[at].astype(np.int32)
    cp = b0.copy()
    many = np.flatnonzero(b0 >= 0xC0)
    if len(many):
        lead = b0[many]
        size = 1 + (lead >= 0xC0).astype(np.int8) + (lead >= 0xE0) + (lead >= 0xF0)
        val = np.where(size == 2, lead & 0x1F, np.where(size == 3, lead & 0x0F, lead & 0x07))
        for j in (1, 2, 3):
            more = size > j
            nxt = data[np.minimum(at[many] + j, len(data) - 1)] & 0x3F
            val = np.where(more, (val << 6) | nxt, val)
        cp[many] = val
    return cp, at


def grams(data: np.ndarray, offsets: np.ndarray):
    """N-grams of some rows: (row, code, alphabet).  A code is three digits in
    base ``len(alphabet)``; the alphabet is ascending, so codes sort as the
    packed values do."""
    cp, at = code_points(data)
    low = _letters()[cp]
    n_rows = len(offsets) - 1
    first = np.searchsorted(at, offsets[:-1])
    seq = np.insert(low, first, 0)                       # a blank before each row
    row = np.insert(np.repeat(np.arange(n_rows), np.diff(np.append(first, len(cp)))), first, np.arange(n_rows))
    seq = np.append(seq, 0)
    row = np.append(row, n_rows)
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0)          # one blank per run
    seq, row = seq[keep], row[keep]
    used = np.flatnonzero(np.bincount(seq, minlength=1))
    alphabet = np.concatenate([[0] if not len(used) or used[0] else [], used, [_NONE]]).astype(np.int64)
    small = np.zeros(int(alphabet[-2]) + 1, np.int64)
    small[alphabet[:-1]] = np.arange(len(alphabet) - 1)
    s = small[seq]
    base, none = len(alphabet), len(alphabet) - 1
    letter = s > 0
    one = np.flatnonzero(letter)
    two = np.flatnonzero(letter[:-1] | letter[1:])
    three = np.flatnonzero(letter[1:-1])
    codes = np.concatenate([(none * base + none) * base + s[one],
                            (none * base + s[two]) * base + s[two + 1],
                            (s[three] * base + s[three + 1]) * base + s[three + 2]])
    rows = np.concatenate([row[one], np.where(letter[two], row[two], row[two + 1]), row[three + 1]])
    return rows, codes, alphabet


def packed(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    base = len(alphabet)
    return (alphabet[codes // (base * base)] << 42) | (alphabet[codes // base % base] << 21) | alphabet[codes % base]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[head], np.diff(np.append(head, len(keys)))


@gives_back
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): n-gram counts of a task's training texts (text, lang)."""
    held: dict[str, list] = {}

    def merge(lang):
        g = np.concatenate([x[0] for x in held[lang]])
        c = np.concatenate([x[1] for x in held[lang]])
        u, inv = np.unique(g, return_inverse=True)
        held[lang] = [(u, np.bincount(inv, c).astype(np.int64))]

    def flush():
        for lang in list(held):
            merge(lang)
            g, c = held.pop(lang)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(c)], ["lang", "gram", "n"])

    for batch in batches:
        data, off = K.string_parts(batch.column(0))
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for a, b in K.slices(off):
            rows, codes, alphabet = grams(data[off[a]:off[b]], off[a:b + 1] - off[a])
            names, which = np.unique(langs[a:b].astype(str), return_inverse=True)
            cube = len(alphabet) ** 3
            key, n = _runs(np.sort(which[rows] * cube + codes))
            lang = key // cube
            gram = packed(key % cube, alphabet)
            for i, name in enumerate(names):
                mine = lang == i
                held.setdefault(str(name), []).append((gram[mine], n[mine]))
        for lang in list(held):
            if len(held[lang]) > 1:
                merge(lang)
        if sum(len(x[0][0]) for x in held.values()) > _HELD_GRAMS:
            yield from flush()
    yield from flush()


def top_grams(data: np.ndarray, offsets: np.ndarray, ranks: int):
    """(row, rank, packed gram) of each row's most frequent n-grams."""
    rows, codes, alphabet = grams(data, offsets)
    cube = len(alphabet) ** 3
    key, n = _runs(np.sort(rows * cube + codes))
    row, code = key // cube, key % cube
    most = int(n.max()) if len(n) else 0
    if (len(offsets)) * (most + 1) * cube < 1 << 62:
        order = np.sort((row * (most + 1) + (most - n)) * cube + code)
        row, code = order // cube // (most + 1), order % cube
    else:
        by = np.lexsort((code, -n, row))
        row, code = row[by], code[by]
    first = np.searchsorted(row, np.arange(len(offsets) - 1))
    rank = np.arange(len(row)) - first[row] if len(row) else np.zeros(0, np.int64)
    top = rank < ranks
    return row[top], rank[top], packed(code[top], alphabet)


class Profiles:
    """Profiles as one table: rank of each n-gram in each language."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int):
        self.ranks = ranks
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.rank = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        column = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.rank[np.searchsorted(self.grams, gram), column[lang]] = rank

    def distances(self, row, rank, gram, n_rows):
        """Out-of-place distance to each language, and the largest it can be."""
        at = np.searchsorted(self.grams, gram)
        hit = np.minimum(at, max(len(self.grams) - 1, 0))
        at = np.where(self.grams[hit] == gram, hit, len(self.grams)) if len(self.grams) else np.zeros(len(gram), int)
        n = np.bincount(row, minlength=n_rows)
        out = np.zeros((n_rows, len(self.langs)))
        for j in range(len(self.langs)):
            place = self.rank[at, j]
            far = np.where(place < 0, self.ranks, np.minimum(np.abs(place - rank), self.ranks))
            out[:, j] = np.bincount(row, far, minlength=n_rows)
        return out, n * self.ranks


@gives_back
def _predict(batches: Iterator[pa.RecordBatch], profiles_b, text_at: int, keep: list[int]) -> Iterator[pa.RecordBatch]:
    p: Profiles = profiles_b.value
    langs = np.array([*p.langs, UNKNOWN], dtype=object)
    for batch in batches:
        data, off = K.string_parts(batch.column(text_at))
        lang, score, margin = np.full(batch.num_rows, len(p.langs)), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for a, b in K.slices(off):
            if not p.langs:
                continue
            row, rank, gram = top_grams(data[off[a]:off[b]], off[a:b + 1] - off[a], p.ranks)
            far, most = p.distances(row, rank, gram, b - a)
            best = far.argmin(axis=1)
            some = most > 0
            lang[a:b] = np.where(some, best, len(p.langs))
            nearest = np.sort(np.column_stack([far, most]), axis=1)     # as if a language shared no n-gram, for one alone
            score[a:b] = np.where(some, 1 - nearest[:, 0] / np.maximum(most, 1), 0.0)
            margin[a:b] = np.where(some, (nearest[:, 1] - nearest[:, 0]) / np.maximum(most, 1), 0.0)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), pa.array(langs[lang], pa.string()), pa.array(score), pa.array(margin)],
            [*(batch.schema.names[i] for i in keep), "lang_pred", "score", "margin"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def learn_profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   ranks: int = RANKS) -> Profiles:
    """Profiles from all documents that are not held out and have a language.
    Only ``ranks`` rows per language come to the driver."""
    small_batches(docs.sparkSession)
    train = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = (train.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= ranks)
    return Profiles([(r.lang, r.gram, r["rank"] - 1) for r in top.select("lang", "gram", "rank").collect()], ranks)


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of ``docs`` (all: ``keep=None``), under the names c0, c1,
    ..., with ``lang_pred``, ``score`` (1 - distance / largest distance) and
    ``margin`` (how much nearer than the second language, in the same measure)."""
    small_batches(docs.sparkSession)
    names = keep if keep is not None else docs.columns
    rows = docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(names)], F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("margin", T.DoubleType())])
    if keep is None:        # the text goes along once
        at = names.index(text_col)
        rows = rows.drop("text")
    else:
        at = len(names)
    held = docs.sparkSession.sparkContext.broadcast(profiles)
    return rows.mapInArrow(partial(_predict, profiles_b=held, text_at=at, keep=list(range(len(names)))), schema)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      ranks: int = RANKS) -> DataFrame:
    """(id, held_out, lang_pred, score, margin): profiles learned from the documents
    that are not held out, applied to every document."""
    found = identify(docs, learn_profiles(docs, id_col, text_col, lang_col, ranks), text_col, [id_col])
    return found.select(F.col("c0").alias(id_col), held_out(F.col("c0")).alias("held_out"), "lang_pred", "score", "margin")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    ranks: int = RANKS, min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` without the documents whose language cannot be told: no text or
    letter (``und``), too far from every profile, or hardly nearer to one than
    to the next.  ``lang_col`` becomes the identified language; the other
    columns stay as they were."""
    found = identify(docs, learn_profiles(docs, id_col, text_col, lang_col, ranks), text_col)
    told = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score) & (F.col("margin") >= min_margin)
    lang = F.col("lang_pred").cast(docs.schema[lang_col].dataType)
    return found.filter(told).select(*[(lang if n == lang_col else F.col(f"c{i}")).alias(n) for i, n in enumerate(docs.columns)])
