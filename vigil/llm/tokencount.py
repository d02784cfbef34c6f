"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text beyond ``chunk`` characters is encoded in overlapping chunks with
offsets, so memory is bounded by the chunk.  Two neighbouring chunks are
spliced at a character that begins a token in both and is proven stable: no
piece of the vocabulary holds it right after the character before it (spaces
count as the vocabulary writes them).  No token can go across such a place, so
what lies on its two sides is encoded independently: a space after a word, a
line break, most neighbours in scripts without spaces.  If an overlap holds no
such place it is widened until it does, or until the text ends (one run of
letters of a kind that the vocabulary joins freely).

A model that rewrites characters before it encodes is spliced at a space after
a character that is none, if no piece goes across one.

Defined results: null counts as empty, 0 tokens; repeated rows are counted one
by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.storage import small_batches

CHUNK, OVERLAP = 16_384, 256     # characters
SPACE_PIECE = "▁"
_PROBE = "a\tb\nｶﾞﬁe\u0301①Å x"     # characters that a normaliser would rewrite


class Counter:
    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        self.splits_at_spaces = not any(SPACE_PIECE in p.lstrip(SPACE_PIECE) for p in pieces)
        self.joined = {pair for p in pieces for pair in zip(p, p[1:])}     # neighbours inside some piece
        self.as_written = m.normalize(_PROBE).replace(SPACE_PIECE, " ").strip(" ") == _PROBE

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def starts(self, text: str) -> np.ndarray:
        """First character of each token (the library's offsets are bytes)."""
        at = np.array([p.begin for p in self.model.encode(text, return_type="proto").pieces], np.int64)
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.append(np.cumsum((raw & 0xC0) != 0x80) - 1, len(text))
        return char[at]

    def apart(self, before: str, here: str) -> bool:
        """Whether no token can hold both of these neighbours."""
        if before == " " or before == SPACE_PIECE:
            return False
        if not self.as_written:
            return self.splits_at_spaces and here == " "
        return (before, SPACE_PIECE if here == " " else here) not in self.joined

    def count_huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if len(text) <= chunk:
            return self.count([text])[0]
        total, at, begin = 0, 0, 0           # tokens before ``at`` are counted; the chunk begins at ``begin``
        while True:
            wide = overlap
            while True:
                end = min(len(text), begin + chunk + wide)
                here = self.starts(text[begin:end]) + begin
                if end == len(text):
                    return total + int((here >= at).sum())
                following = begin + chunk
                there = self.starts(text[following:min(len(text), following + chunk + wide)]) + following
                common = np.intersect1d(here[(here > max(at, following)) & (here < end)], there)
                stable = next((int(p) for p in common if self.apart(text[p - 1], text[p])), None)
                if stable is not None:
                    break
                wide *= 2
            total += int(((here >= at) & (here < stable)).sum())
            at, begin = stable, following


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def _count(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    counter = _counter(path)
    for batch in batches:
        data, off = K.string_parts(batch.column(1))
        n = np.zeros(batch.num_rows, np.int64)
        for a, b in K.slices(off):
            texts = [data[off[i]:off[i + 1]].tobytes().decode() for i in range(a, b)]
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            n[np.array(short, np.int64) + a] = counter.count([texts[i] for i in short])
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    n[a + i] = counter.count_huge(t, chunk, overlap)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off)), pa.array(n)], ["id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per document."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([src.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    out = src.mapInArrow(partial(_count, path=model, chunk=chunk, overlap=overlap), schema)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
