"""Benchmark decontamination by training suffix arrays.

Documents are cut into shards of whole documents (a slice of a record batch).
Each shard builds the sorted array of its suffixes (prefix doubling) and every
suffix of every test item is binary-searched in it: for the interval that
shares the suffix's window, and for its place among the suffixes, whose
neighbours give the longest verbatim matches.  No shuffle is needed: the test
items travel to the shards in blocks of bounded size, equal items once.

Only stretches of words made of ``q``-word sequences of the test items enter
the array (q: the shortest window, 4 at most); nothing outside could match one
whole window.  Common words of two places are counted by doubling over rolling
hashes modulo two primes, so a search costs the logarithm of the match.

Work and memory follow text plus items plus matches: every distinct window is
expanded once over its places in the shard, and an item's longest match at a
place is found from the two item suffixes next to it, never by item suffix
times place, so texts and items that repeat a word thousands of times do not
multiply.

A window is ``window`` consecutive words of an item; an item of fewer words,
but not none, is one window.  Defined results: null and empty texts have no
words, no hits; an item without words occurs nowhere; an item with a null id
causes hits but has no id to list; items of equal words have the same matches
each; repeated rows are judged one by one; other columns are ignored, whatever
their names.
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
from vigil.llm.storage import Scratch, gives_back, small_batches

BLOCK_BYTES = 16 << 20      # test items held by a task at once


_PRIMES = (np.uint64(2_147_483_629), np.uint64(2_147_483_587))
_BASES = (np.uint64(1_103_515_245), np.uint64(845_190_217))


@lru_cache(maxsize=4)
def _powers(n: int) -> list[np.ndarray]:
    """Powers of the bases, ``n`` (a power of two) of each."""
    out = []
    for p, base in zip(_PRIMES, _BASES):
        w = np.ones(1, np.uint64)
        step = base
        while len(w) < n:
            w = np.concatenate([w, w * step % p])
            step = step * step % p
        out.append(w)
    return out


class Rolling:
    """Prefix hashes of a sequence of words: common beginnings of two places."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.sums = []
        power = _powers(1 << max(self.n, 1).bit_length())
        for p, w in zip(_PRIMES, power):
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(words % p * w[:self.n] % p, out=total[1:])
            self.sums.append(total % p)

    def common(self, i: np.ndarray, other: "Rolling", j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from place i here and place j there on, up to ``most``."""
        got = np.zeros(len(i), np.int64)
        if not len(i) or not most.max():
            return got
        power = _powers(1 << (max(self.n, other.n, 1)).bit_length())
        for k in range(int(most.max()).bit_length() - 1, -1, -1):
            size = 1 << k
            fits = np.flatnonzero(got + size <= most)
            a, b = i[fits] + got[fits], j[fits] + got[fits]
            same = np.ones(len(fits), bool)
            for p, w, x, y in zip(_PRIMES, power, self.sums, other.sums):
                same &= (x[a + size] + p - x[a]) % p * w[b] % p == (y[b + size] + p - y[b]) % p * w[a] % p
            got[fits[same]] += size
        return got


class TestItems:
    """The suffixes of a block of test items; ``ids[i]``: the ids of item i."""

    def __init__(self, ids: list[list[str | None]], texts: list[str], window: int):
        data, off = K.string_parts(pa.array(texts, pa.large_string()))
        words = K.Words(data, off, K.ALNUM, lower=True)
        sizes = np.diff(words.first)
        self.window = window
        self.n_ids = np.array([len(x) for x in ids], np.int64)
        self.id_at = np.cumsum(self.n_ids) - self.n_ids
        self.ids = [x for own in ids for x in own]
        self.hash = words.hash
        self.rolling = Rolling(self.hash)
        self.item = words.row_of_word()                       # item of each suffix
        self.first = words.first
        self.left = words.first[self.item + 1] - np.arange(len(self.item))
        self.width = np.minimum(window, sizes[self.item])     # its window's words
        self.depth = int(sizes.max()) if len(sizes) else 0
        usable = sizes[sizes > 0]
        self.q = int(min(4, window, usable.min())) if len(usable) else 0
        grams = K.windows(self.hash, self.q) if self.q else np.zeros(0, np.uint64)
        inside = np.flatnonzero(self.left[:len(grams)] >= self.q)
        self.grams, which = np.unique(grams[inside], return_inverse=True)
        self.gram = np.full(len(self.item), -1, np.int64)     # gram of each suffix that has one
        self.gram[inside] = which


def suffix_array(words: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places of all words in the order of the sequences that begin there and
    stop at ``ends[i]``, compared over ``depth`` words at least; a sequence
    sorts before those it is the beginning of.  Prefix doubling."""
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    size = 1
    while True:
        nxt = np.arange(n) + size
        second = np.where(nxt < ends, rank[np.minimum(nxt, n - 1)], 0)
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.append(True, key[order][1:] != key[order][:-1])
        size *= 2
        if size >= depth or new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)


class Shard:
    """The suffix array of a shard's stretches: ``at[i]`` is the place (a word
    of the stretches), ``end[i]`` where its stretch ends, in sorted order."""

    def __init__(self, words: np.ndarray, ends: np.ndarray, depth: int):
        self.words, self.rolling = words, Rolling(words)
        self.at = suffix_array(words, ends, depth)
        self.end = ends[self.at]

    def common(self, items: TestItems, suffix: np.ndarray, place: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that test suffixes share with the suffixes at these places of the array."""
        at, end = self.at[place], self.end[place]
        return items.rolling.common(suffix, self.rolling, at, np.minimum(most, end - at))

    def search(self, items: TestItems, suffix: np.ndarray, limit: np.ndarray, above: bool) -> np.ndarray:
        """Binary search: the first place of the array not below (or above) the
        first ``limit`` words of each test suffix."""
        lo, hi = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(self.at), np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            s, most = suffix[open_], limit[open_]
            got = self.common(items, s, mid, most)
            here = self.at[mid] + got
            ended = here >= self.end[mid]                     # the shard's suffix is a beginning
            mine = items.hash[np.minimum(s + got, len(items.hash) - 1)]
            theirs = self.words[np.minimum(here, len(self.words) - 1)]
            below = np.where(got == most, above, ended | (theirs < mine))
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, value): first[i], first[i] + 1, ... (count[i] of them) for each i."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(which))


def _matches(words: K.Words, items: TestItems):
    """Longest verbatim matches of at least a window: arrays (row, item,
    item_start, doc_start, length); positions count words of the row.  Per row,
    item and word of the row the longest match from there, unless it is the
    rest of the one a word before."""
    empty = tuple(np.zeros(0, np.int64) for _ in range(5))
    if not items.q or len(words.hash) < items.q:
        return empty
    row_end = np.repeat(words.first[1:], np.diff(words.first))
    grams = K.windows(words.hash, items.q)
    spot = np.minimum(np.searchsorted(items.grams, grams), len(items.grams) - 1)
    known = (items.grams[spot] == grams) & (np.arange(len(grams)) + items.q <= row_end[:len(grams)])
    starts = np.flatnonzero(known)
    if not len(starts):
        return empty
    # stretches: words of known sequences; one ends where no known sequence goes on, or the row does
    new = np.append(True, (starts[1:] != starts[:-1] + 1) | (row_end[starts[1:]] != row_end[starts[:-1]]))
    head = starts[new]
    tail = starts[np.append(np.flatnonzero(new)[1:], len(starts)) - 1] + items.q
    size = tail - head
    which, place = _expand(head, size)                        # word of the shard at each word of the stretches
    shard = Shard(words.hash[place], np.cumsum(size)[which], items.depth)

    # test suffixes that can begin a window here, and the interval of each one's window
    present = np.zeros(len(items.grams), bool)
    present[spot[starts]] = True
    suffix = np.flatnonzero((items.gram >= 0) & (items.left >= items.width))
    suffix = suffix[present[items.gram[suffix]]]
    width = items.width[suffix]
    low = shard.search(items, suffix, width, above=False)
    high = shard.search(items, suffix, width, above=True)
    found = low < high
    suffix, width, low, high = suffix[found], width[found], low[found], high[found]
    if not len(suffix):
        return empty
    item = items.item[suffix]

    # distinct windows, the items that have each, and each item's places
    window, of = np.unique(np.stack([low, width]), axis=1, return_inverse=True)
    of = of.ravel()
    upto = np.zeros(window.shape[1], np.int64)
    upto[of] = high
    own = np.unique(of * (len(items.first)) + item)           # window and item, once
    own_window, own_item = own // len(items.first), own % len(items.first)
    pair, sorted_at = _expand(window[0][own_window], (upto - window[0])[own_window])
    pair_item = own_item[pair]

    # the longest match at a place is with one of the two item suffixes around it
    insert = shard.search(items, suffix, items.left[suffix], above=False)
    n = len(shard.at)
    after = shard.common(items, suffix, np.minimum(insert, n - 1), items.left[suffix]) * (insert < n)
    before = shard.common(items, suffix, np.maximum(insert - 1, 0), items.left[suffix]) * (insert > 0)
    by_after = np.lexsort((after, insert, item))              # the last of equals shares most with what follows
    by_before = np.lexsort((-before, insert, item))           # the first of equals shares most with what precedes
    key = item[by_after] * (n + 1) + insert[by_after]
    goal = pair_item * (n + 1) + sorted_at
    place_after = np.searchsorted(key, goal, side="right")
    length, item_start = np.zeros(len(goal), np.int64), np.zeros(len(goal), np.int64)
    for by, at in ((by_after, place_after - 1), (by_before, place_after)):
        ok = np.flatnonzero((at >= 0) & (at < len(by)))
        s = suffix[by[at[ok]]]
        mine = items.item[s] == pair_item[ok]
        ok, s = ok[mine], s[mine]
        got = shard.common(items, s, sorted_at[ok], items.left[s])
        start = s - items.first[items.item[s]]
        better = (got > length[ok]) | ((got == length[ok]) & (start < item_start[ok]))
        length[ok[better]], item_start[ok[better]] = got[better], start[better]

    word = place[shard.at[sorted_at]]
    by = np.lexsort((word, pair_item))
    word, found_item, item_start, length = word[by], pair_item[by], item_start[by], length[by]
    row = np.searchsorted(words.first, word, side="right") - 1
    rest = np.zeros(len(word), bool)
    rest[1:] = (word[1:] == word[:-1] + 1) & (found_item[1:] == found_item[:-1]) & (row[1:] == row[:-1]) & (length[1:] < length[:-1])
    keep = ~rest
    row = row[keep]
    return row, found_item[keep], item_start[keep], word[keep] - words.first[row], length[keep]


@gives_back
def _scan(batches: Iterator[pa.RecordBatch], items_b, text_at: int, keep: list[int]) -> Iterator[pa.RecordBatch]:
    """Per document: the kept columns, number of words, and its matches."""
    items: TestItems = items_b.value
    ids = np.array(items.ids, dtype=object)
    for batch in batches:
        data, off = K.string_parts(batch.column(text_at))
        for a, b in K.slices(off, 4 * K.SLICE_BYTES):
            words = K.Words(data[off[a]:off[b]], off[a:b + 1] - off[a], K.ALNUM, lower=True)
            row, item, item_start, doc_start, length = _matches(words, items)
            which, id_at = _expand(items.id_at[item], items.n_ids[item])      # a match for each id of its item
            by = np.argsort(row[which], kind="stable")
            which, id_at = which[by], id_at[by]
            cuts = np.searchsorted(row[which], np.arange(b - a + 1)).astype(np.int32)
            fields = [pa.array(ids[id_at], pa.string()), pa.array(item_start[which]), pa.array(doc_start[which]), pa.array(length[which])]
            found = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                fields, ["item_id", "item_start", "doc_start", "length"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in keep] + [pa.array(np.diff(words.first)), found],
                [*(batch.schema.names[i] for i in keep), "n_words", "matches"])


MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()),
                                  T.StructField("doc_start", T.LongType()), T.StructField("length", T.LongType())]))


def _test_items(items: DataFrame, item_id_col: str, item_text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Rows (text, ids) of the distinct texts and the number of blocks they
    make; no text leaves the tasks."""
    test = items.select(F.col(item_id_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    id_bytes = F.coalesce(F.octet_length("item_id"), F.lit(0)).cast("long") + 8
    test = (test.filter(F.col("text").isNotNull()).groupBy("text", "item_id").agg(F.first(id_bytes).alias("bytes"))
            # a text's bytes, and those of its ids beyond one
            .groupBy("text").agg(F.collect_list(F.struct("item_id")).alias("ids"),
                                 (F.sum("bytes") - F.min("bytes") + F.first(F.octet_length("text"))).alias("bytes")))
    size = test.agg(F.sum("bytes")).first()[0] or 0
    return test, max(1, -(-size // block_bytes))


def _blocks(items: DataFrame, item_id_col: str, item_text_col: str, window: int, block_bytes: int) -> Iterator:
    """The test items as broadcast blocks of about ``block_bytes``: each
    distinct text with its distinct ids."""
    small_batches(items.sparkSession)
    test, n = _test_items(items, item_id_col, item_text_col, block_bytes)
    if n > 1:
        test = Scratch(items.sparkSession, "items").keep(test, "texts")
    for b in range(n):
        got = test.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).select("text", "ids").collect()
        yield n, items.sparkSession.sparkContext.broadcast(
            TestItems([[x.item_id for x in r.ids] for r in got], [r.text for r in got], window))


def verbatim_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, matches) for every row of ``docs``.

    ``matches`` lists, per item and word of the document, the longest verbatim
    match of at least one window that begins there, unless it is the rest of
    the one a word before: item, first word in the item, first word in the
    document, words.  Test items beyond ``block_bytes`` are searched block by
    block, one block's matches being written before the next is read, so that
    driver and tasks hold one block at a time; the matches are joined per row.
    The rows are written first, so that every block sees the same row keys.
    """
    src = docs.select(F.col(id_col).alias(id_col), F.monotonically_increasing_id().alias("__row"),
                      F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([*src.schema.fields[:2], T.StructField("n_words", T.LongType()), T.StructField("matches", MATCH)])
    run = Scratch(docs.sparkSession, "matches")
    scan = lambda rows, held: rows.mapInArrow(partial(_scan, items_b=held, text_at=2, keep=[0, 1]), schema)
    out = None
    for b, (n, held) in enumerate(_blocks(items, item_id_col, item_text_col, window, block_bytes)):
        if n == 1:
            return scan(src, held).drop("__row")
        if not b:
            src = run.keep(src, "rows")
        found = run.keep(scan(src, held), f"block-{b}")
        held.destroy()
        out = found if out is None else out.unionByName(found)
    # a row's matches of all blocks; bounded by the row's own text
    out = out.groupBy(id_col, "__row").agg(F.first("n_words").alias("n_words"),
                                           F.flatten(F.collect_list("matches")).alias("matches"))
    return out.drop("__row")


def judge(found: DataFrame, times: int = 20) -> DataFrame:
    """Adds n_hit (words inside any match), n_items, items_sha256 and
    contaminated (n_hit > 0 and times * n_hit >= n_words)."""
    # union of the matches' word ranges: sorted by start, each adds what lies beyond the furthest end so far
    ranges = F.array_sort(F.transform("matches", lambda m: F.struct(m["doc_start"].alias("a"), (m["doc_start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    hit = F.aggregate(ranges, zero, lambda s, m: F.struct(
        (s["n"] + F.greatest(F.lit(0).cast("long"), m["b"] - F.greatest(m["a"], s["end"]))).alias("n"),
        F.greatest(s["end"], m["b"]).alias("end")), lambda s: s["n"])
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]), lambda x: x.isNotNull())))
    return (found.withColumn("n_hit", hit).withColumn("__ids", ids)
            .withColumn("n_items", F.size("__ids").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "__ids"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (times * F.col("n_hit") >= F.col("n_words")))
            .drop("__ids"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = 13, times: int = 20,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the contaminated ones, all columns as they were.  With
    several blocks of test items the blocks' judgement is joined by row."""
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index(text_col)
    extra = [T.StructField("n_words", T.LongType()), T.StructField("matches", MATCH)]
    if _test_items(items, item_id_col, item_text_col, block_bytes)[1] == 1:
        ((_, held),) = _blocks(items, item_id_col, item_text_col, window, block_bytes)
        found = rows.mapInArrow(partial(_scan, items_b=held, text_at=at, keep=list(range(len(names)))),
                                T.StructType([*rows.schema.fields, *extra]))
        return judge(found, times).filter(~F.col("contaminated")).select(
            *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    run = Scratch(docs.sparkSession, "decontaminate")
    rows = run.keep(rows.withColumn("row", F.expr("uuid()")), "rows")
    bad = judge(verbatim_matches(rows, items, "row", f"c{at}", item_id_col, item_text_col, window, block_bytes), times)
    kept = rows.join(bad.filter("contaminated").select("row"), "row", "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
