"""Runs (maximal periodic stretches of words) by suffix trees.

The words of the stretches that may hold runs become symbols of a text, its
stretches kept apart by symbols of their own.  An Ukkonen suffix tree of the
text and one of its reversal, with Euler tours prepared for range minima, give
the longest common extension of any two places to the right and to the left in
constant time.  Every run has a Lyndon root under the order of the symbols or
its reverse, so the longest Lyndon word from each place under either order
(its length: the distance to the next smaller suffix, whose ranks the tree's
leaves give) is a candidate, extended in both directions; it makes a run if it
is as long as twice its root.

A run of at least ``max(12, 2q)`` words equals itself shifted by q, so all of
it is covered by sequences of six words that occur twice in its document: the
rest of the words stay out of the trees, without loss.  Words and sequences
are told apart by 64-bit hashes.

Each row is judged alone: nothing is shuffled.  A stretch of n covered words is
held in one task, at about 700 n bytes; so is a text, at 40 times its size.

Defined results: null and empty texts have no words and no runs and collapse
to an empty text; repeated rows are judged one by one; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.storage import gives_back, small_batches

MIN_WORDS = 12              # words of a run, at least
SHIFTED = 6                 # words of it that equal words one period on, at least
TREE_WORDS = 1 << 15        # stretches share a tree up to about this many words
_LOW = 5                    # range minima: windows up to 2^5 places, then blocks of as many


class RangeMinima:
    """Minimum of any range of an array in constant time: sparse tables of
    short windows, and of whole blocks for the rest."""

    def __init__(self, x: np.ndarray):
        self.windows = [x]
        for k in range(_LOW):
            prev, step = self.windows[-1], 1 << k
            nxt = prev.copy()
            np.minimum(prev[:-step], prev[step:], out=nxt[:-step]) if len(prev) > step else None
            self.windows.append(nxt)
        width = 1 << _LOW
        whole = len(x) // width
        self.blocks = [x[:whole * width].reshape(-1, width).min(axis=1) if whole else np.zeros(0, x.dtype)]
        while (1 << len(self.blocks)) <= whole:
            step, prev = 1 << (len(self.blocks) - 1), self.blocks[-1]
            self.blocks.append(np.minimum(prev[:-step], prev[step:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of the places ``low`` to ``high``, both included."""
        size = high - low + 1
        out = np.empty(len(low), self.windows[0].dtype)
        level = np.where(size >= 1 << _LOW, _LOW, 0)
        for k in range(1, _LOW):
            level = np.where((size >= 1 << k) & (size < 1 << _LOW), k, level)
        for k in range(_LOW + 1):
            at = np.flatnonzero(level == k)
            if len(at):
                t = self.windows[k]
                out[at] = np.minimum(t[low[at]], t[high[at] - (1 << k) + 1])
        a, b = -(-low >> _LOW), (high + 1) >> _LOW           # whole blocks between
        at = np.flatnonzero((level == _LOW) & (a < b))
        if len(at):
            n = b[at] - a[at]
            k = np.int64(np.floor(np.log2(n)))
            k -= (1 << k) > n
            for level_ in np.unique(k):
                here = at[k == level_]
                t = self.blocks[level_]
                out[here] = np.minimum(out[here], np.minimum(t[a[here]], t[b[here] - (1 << level_)]))
        return out


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of symbols whose last one occurs
    nowhere else; symbols are below ``size``."""

    def __init__(self, symbols: list[int], size: int):
        s, n = symbols, len(symbols)
        start, stop, link, depth = [0], [0], [0], [0]
        child: dict[int, int] = {}                           # node * size + first symbol of the edge
        leaves: list[int] = []                               # of the suffixes, in order
        node = edge = length = pending = 0
        for i in range(n):
            c, last = s[i], 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                key = node * size + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = stop[below] - start[below]
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    if s[start[below] + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    # the edge is split ``pending - 1`` symbols below the root
                    split = len(start)
                    start.append(start[below])
                    start[below] += length
                    stop.append(start[below])
                    link.append(0)
                    depth.append(pending - 1)
                    child[key] = split
                    child[split * size + c] = split + 1
                    child[split * size + s[start[below]]] = below
                    if last:
                        link[last] = split
                    last = split
                leaves.append(len(start))                    # the new leaf
                start.append(i)
                stop.append(n)
                link.append(0)
                depth.append(n - len(leaves) + 1)
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.size, self.n_nodes = size, len(start)
        self.leaves = np.array(leaves, np.int64)
        self.depth = np.array(depth, np.int32)
        key = np.fromiter(child.keys(), np.int64, len(child))
        self.below = np.fromiter(child.values(), np.int64, len(child))
        self.above, self.symbol = key // size, key % size

    def children(self, order: np.ndarray) -> tuple[list[int], list[int]]:
        """(children of all nodes, first child of each node), by the symbols' ``order``."""
        by = np.lexsort((order[self.symbol], self.above))
        first = np.searchsorted(self.above[by], np.arange(self.n_nodes + 1))
        return self.below[by].tolist(), first.tolist()

    def euler_tour(self, order: np.ndarray) -> np.ndarray:
        """Nodes in the order of a walk that comes back to a node after each child."""
        kids, first = self.children(order)
        ends, nxt = first[1:], first[:-1]
        tour, path = [0], [0]
        while path:
            v = path[-1]
            k = nxt[v]
            if k < ends[v]:
                nxt[v] = k + 1
                c = kids[k]
                tour.append(c)
                if nxt[c] < ends[c]:
                    path.append(c)
                else:
                    tour.append(v)
            else:
                path.pop()
                if path:
                    tour.append(path[-1])
        return np.array(tour, np.int64)

    def leaf_order(self, order: np.ndarray) -> np.ndarray:
        """Leaves from the smallest suffix to the largest."""
        kids, first = self.children(-order)
        stack, out = [0], []
        while stack:
            v = stack.pop()
            a, b = first[v], first[v + 1]
            if a < b:
                stack.extend(kids[a:b])
            else:
                out.append(v)
        return np.array(out, np.int64)


class Extensions:
    """Longest common extensions: the depth of two leaves' lowest common
    ancestor, a range minimum over the Euler tour."""

    def __init__(self, tree: SuffixTree, order: np.ndarray):
        tour = tree.euler_tour(order)
        place = np.zeros(tree.n_nodes, np.int64)
        place[tour] = np.arange(len(tour))                   # a leaf is met once
        self.place = place[tree.leaves]
        self.minima = RangeMinima(tree.depth[tour])

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common symbols from two different places on."""
        a, b = self.place[i], self.place[j]
        return self.minima(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one of lower rank (the end: the last place)."""
    out, stack = [0] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    for i in stack:
        out[i] = len(rank) - 1
    return out


def runs(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a sequence of symbols from 1 to
    ``size - 1``, by start, then period."""
    n = len(symbols)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, none
    up = np.arange(size)
    down = np.where(up == 0, 0, size - up)                   # the end stays the smallest
    tree = SuffixTree([*symbols.tolist(), 0], size)
    right = Extensions(tree, up)
    at, root = [], []
    for order in (up, down):
        rank = np.zeros(tree.n_nodes, np.int64)
        rank[tree.leaf_order(order)] = np.arange(n + 1)
        smaller = np.array(next_smaller(rank[tree.leaves].tolist()), np.int64)[:n]
        at.append(np.arange(n))
        root.append(smaller - np.arange(n))
    i, p = np.concatenate(at), np.concatenate(root)
    del tree
    left = Extensions(SuffixTree([*symbols[::-1].tolist(), 0], size), up)
    after = right(i, i + p)                                  # the end's suffix is place n
    before = np.zeros(len(i), np.int64)
    some = i > 0
    before[some] = left(n - i[some], n - i[some] - p[some])
    found = before + after >= p
    start, end, p = (i - before)[found], (i + p + after)[found], p[found]
    got = np.unique(np.stack([start, p, end - start]), axis=1)
    return got[0], got[2], got[1]


def _covered(words: K.Words) -> np.ndarray:
    """Words in a sequence of ``SHIFTED`` words that its row has twice."""
    n = len(words.hash)
    row = words.row_of_word()
    wins = K.windows(words.hash, SHIFTED)
    inside = np.flatnonzero(row[:len(wins)] == row[SHIFTED - 1:SHIFTED - 1 + len(wins)])
    key = K.mix(wins[inside] ^ (row[inside].astype(np.uint64) * np.uint64(K._GOLD)))
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    twice = np.zeros(len(key), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    at = inside[twice]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + SHIFTED, -1)
    return np.cumsum(edge[:-1]) > 0


def find_in_rows(words: K.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, period) of the rows' runs of at least
    ``max(MIN_WORDS, 2 * period)`` words; words are counted over all rows."""
    none = np.zeros(0, np.int64)
    if len(words.hash) < MIN_WORDS:
        return none, none, none
    covered = _covered(words)
    row = words.row_of_word()
    begins = covered.copy()
    begins[1:] &= ~covered[:-1] | (row[1:] != row[:-1])
    ends = covered.copy()
    ends[:-1] &= ~covered[1:] | (row[1:] != row[:-1])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    wide = b - a >= MIN_WORDS
    a, b = a[wide], b[wide]
    out = []
    k = 0
    while k < len(a):
        # stretches up to TREE_WORDS words, one at least
        total = np.cumsum(b[k:] - a[k:])
        m = k + max(1, int(np.searchsorted(total, TREE_WORDS, side="right")))
        size = b[k:m] - a[k:m]
        shift = np.cumsum(size + 1) - size - 1                # place of each stretch in the text
        places = np.repeat(a[k:m] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        distinct, symbol = np.unique(words.hash[places], return_inverse=True)
        text = np.zeros(int(size.sum()) + m - k, np.int64)
        text[np.repeat(shift - (np.cumsum(size) - size), size) + np.arange(len(places))] = symbol + 1
        text[shift + size] = len(distinct) + 1 + np.arange(m - k)
        start, length, period = runs(text, len(distinct) + 1 + m - k)
        good = (length >= MIN_WORDS) & (length >= 2 * period)
        start, length, period = start[good], length[good], period[good]
        which = np.searchsorted(shift, start, side="right") - 1
        out.append((a[k:m][which] + start - shift[which], length, period))
        k = m
    if not out:
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def _joined(data: np.ndarray, words: K.Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    at = np.flatnonzero(kept)
    first = np.searchsorted(at, words.first)                 # kept words before each row
    size = words.length[at] + 1
    to = np.cumsum(size)
    total = int(to[-1]) if len(at) else 0
    chars = np.full(total, 0x20, np.uint8)
    inside = np.ones(total, bool)
    inside[to - 1] = False
    n = words.length[at]
    chars[inside] = data[np.repeat(words.start[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    last = np.diff(first) > 0                                # no space after a row's last word
    whole = np.ones(total, bool)
    whole[to[first[1:][last] - 1] - 1] = False
    chars = chars[whole]
    ends = np.append(0, to)[first] - np.append(0, np.cumsum(last))
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(chars)).cast(pa.string())


@gives_back
def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = K.string_parts(batch.column(1))
        for a, b in K.slices(off, 4 * K.SLICE_BYTES):
            part = data[off[a]:off[b]]
            words = K.Words(part, off[a:b + 1] - off[a], K.NON_SPACE, lower=False)
            start, length, period = find_in_rows(words)
            row = np.searchsorted(words.first, start, side="right") - 1
            by = np.lexsort((period, start))
            start, length, period, row = start[by], length[by], period[by], row[by]
            edge = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            cuts = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
            fields = [pa.array(start - words.first[row]), pa.array(length), pa.array(period)]
            found = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(words.first)), found, _joined(part, words, kept)],
                                             ["id", "n_words", "runs", "collapsed"])


RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: its runs by start, then
    period, and its words without those that only repeat (each run's words
    beyond its first period), joined by one space."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([src.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                           T.StructField("collapsed", T.StringType())])
    return src.mapInArrow(_find, schema).withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256) from ``find_runs``: the longest run, ties to the first
    start and the shortest period, and digests of all runs and of the text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    top = found.withColumn("__best", best)
    return top.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("__best.start")).alias("start"), F.col("__best.length").alias("length"),
        (-F.col("__best.period")).alias("period"),
        F.expr("(1000 * __best.length) div (-__best.period)").cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def repeated_tail(text: Column, key: Column) -> Column:
    """``text`` with, for every tenth key, a periodic end: with h the key's
    CRC-32, g = h div 10, its n words from a = g mod n on repeat the first
    1 + (n - a) div (3 + g mod 8) of them.  Other texts stay as they are."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tail(w):
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: w[place(i)]), " ")).otherwise("")
    return F.when(F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False)), F.transform(F.array(words), tail)[0]).otherwise(text)
