"""N-gram Jaccard join: which documents are near copies of each other.

The document by n-gram incidence matrix is multiplied with its transpose, but
only where the product can reach the threshold:

1. Documents with equal shingle sets form a class; one member goes on.
2. A fixed-size table of shingle counts over all documents gives one global
   order, rare shingles first.  Two sets with Jaccard >= t share a shingle
   among the first ``n - ceil(t n) + 1`` of both (the block of columns that is
   multiplied); the rest never leaves its document.
3. The product is evaluated first against one central document per shingle,
   and verified links are contracted to components, so a group of thousands
   of near copies costs one check per copy instead of all pairs.
4. What is left are pairs of different components that share a shingle.  In a
   family (documents with the same central document) the whole product is
   evaluated block by block.  Other pairs are multiplied over the prefix
   columns: overlaps are summed, and pairs that cannot reach
   ``ceil(t (nx + ny) / (1 + t))`` are discarded, first by how much of either
   document other components share at all, then by the pair's own sum; the
   rest are verified on their whole sets.

Every link between different sets is either found, or lies inside a component
that is already connected; the components are exact (up to collisions of
64-bit shingle hashes).

Defined results: null or empty texts and texts without words have 0 shingles
and are linked with nothing; texts of fewer than ``k`` words are one shingle;
rows with the same id are one node whose links are those of all its rows; a
null id takes part in nothing and gets a null component; no rows give no rows;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.components import connected_components
from vigil.llm.storage import Scratch, gives_back, small_batches
from vigil.operators.common import bounded_broadcast

BLOCK_SHINGLES = 100_000    # entries of a block of the product of a family, about
BLOCK_DOCS = 256            # and its documents
HOT_CLASSES = 4096  # classes of more than 1/4096 of all rows join by broadcast: fewer than 4096 rows
COUNT_BITS = 18     # the shingle count table has 2^18 cells, whatever the input


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of every row of a batch (id, text)."""
    data, off = K.string_parts(batch.column(1))
    for a, b in K.slices(off):
        words = K.Words(data[off[a]:off[b]], off[a:b + 1] - off[a], K.NON_SPACE, lower=True)
        wins = K.windows(words.hash, k)
        for r in range(b - a):
            yield a + r, K.row_shingles(words, r, wins, k)


def _class_key(s: np.ndarray) -> tuple[int, int]:
    """Order-free 128-bit key of a set."""
    one = int(s.sum(dtype=np.uint64))
    two = int(K.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return one - (1 << 64) * (one >> 63), two - (1 << 64) * (two >> 63)


def _long_lists(parts: list[np.ndarray]) -> pa.ListArray:
    at = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=at[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))


@gives_back
def _keys_and_counts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(id, n, s1, s2) per document, and one row with the task's shingle counts."""
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    shift = np.uint64(64 - COUNT_BITS)
    id_type = pa.int64()
    for batch in batches:
        id_type = batch.schema.types[0]
        n = np.zeros(batch.num_rows, np.int64)
        key = np.zeros((2, batch.num_rows), np.int64)
        held = []
        for r, s in _sets(batch, k):
            n[r] = len(s)
            key[0, r], key[1, r] = _class_key(s)
            held.append(s)
            if len(held) >= 256:
                counts += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=len(counts))
                held = []
        if held:
            counts += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=len(counts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), pa.array(key[0]), pa.array(key[1]),
             pa.nulls(batch.num_rows, pa.binary())], ["id", "n", "s1", "s2", "counts"])
    if counts.any():
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
             pa.array([counts.tobytes()], pa.binary())], ["id", "n", "s1", "s2", "counts"])


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.frombuffer(x.as_buffer(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])


@gives_back
def _prefixes(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, counts) -> Iterator[pa.RecordBatch]:
    """The first ``n - ceil(t n) + 1`` shingles of each set, rare ones first."""
    shift = np.uint64(64 - COUNT_BITS)
    table = counts.value
    for batch in batches:
        rows, n, s1, s2, prefix = [], [], [], [], []
        for r, s in _sets(batch, k):
            if not len(s):
                continue
            size = len(s)
            keep = size - -(-num * size // den) + 1
            order = np.argsort(table[(s >> shift).astype(np.int64)], kind="stable")   # s is sorted: ties by value
            one, two = _class_key(s)
            rows.append(r), n.append(size), s1.append(one), s2.append(two), prefix.append(s[order[:keep]])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
             pa.array(s2, pa.int64()), _long_lists(prefix)], ["id", "n", "s1", "s2", "prefix"])


@gives_back
def _whole_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: list[np.ndarray] = []
        for r, s in _sets(batch, k):
            held.append(s)
            if len(held) == 256 or r + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(r + 1 - len(held), len(held)), _long_lists(held)], ["id", "shingles"])
                held = []


@gives_back
def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, rep): those whose h another row of the partition
    has too, and the first and last h of the partition, which may go on in the
    next one.  Holds one batch and one row, however many rows an h has."""
    held: pa.RecordBatch | None = None
    last_h = None
    first_h = None

    def pick(batch, before, after):
        h = batch.column(0).to_numpy()
        same = h[1:] == h[:-1]
        keep = np.zeros(len(h), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep |= h == first_h
        if before is not None and h[0] == before:
            keep[0] = True
        if after is None or h[-1] == after:
            keep |= h == h[-1]
        return batch.filter(pa.array(keep))

    for batch in batches:
        if not batch.num_rows:
            continue
        if first_h is None:
            first_h = batch.column(0)[0].as_py()
        if held is not None:
            yield pick(held, last_h, batch.column(0)[0].as_py())
            last_h = held.column(0)[-1].as_py()
        held = batch
    if held is not None:
        yield pick(held, last_h, None)


def _need(nx: Column, ny: Column, num: int, den: int) -> Column:
    """Smallest overlap of two sets of these sizes with Jaccard >= num/den."""
    return F.ceil(num * (nx + ny) / F.lit(num + den))


def _rest(n: Column, num: int, den: int) -> Column:
    """Shingles of a set beyond its prefix."""
    return F.ceil(num * n / F.lit(den)) - 1


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the threshold."""
    a = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    both = pairs.select("u", "v").join(a.hint("merge"), "u").join(b.hint("merge"), "v")
    common = F.size(F.array_intersect("a", "b"))
    return (both.select("u", "v", common.alias("o"), (F.size("a") + F.size("b") - common).alias("w"))
            .filter(F.col("o") * den >= F.col("w") * num).select("u", "v"))


def _block_links(table: pa.Table, num: int, den: int) -> pa.Table:
    """One block of the product: of the documents of two blocks of a family
    (rows comp, block, n, shingles), which components a pair links.  Columns
    are taken 4096 at a time; a spanning part of the links comes back."""
    table = table.combine_chunks()
    comp = np.array(table.column("comp").to_pylist(), dtype=object)
    block, lists = table.column("block").to_numpy(), table.column("shingles").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    n = len(comp)
    flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(n), size)
    by = np.argsort(flat, kind="stable")
    flat, owner = flat[by], owner[by]
    head = np.append(True, flat[1:] != flat[:-1]) if len(flat) else np.zeros(0, bool)
    column = np.cumsum(head) - 1
    several = (np.bincount(column) > 1)[column] if len(column) else head
    owner, column = owner[several], column[several]
    overlap = np.zeros((n, n), np.float32)
    cuts = np.unique(column)
    for a in range(0, len(cuts), 4096):
        lo, hi = np.searchsorted(column, cuts[a]), np.searchsorted(column, cuts[min(a + 4096, len(cuts)) - 1], side="right")
        part = np.zeros((n, min(4096, len(cuts) - a)), np.float32)
        part[owner[lo:hi], np.searchsorted(cuts, column[lo:hi]) - a] = 1
        overlap += part @ part.T
    o = overlap.astype(np.int64)
    linked = o * den >= (size[:, None] + size[None, :] - o) * num
    wanted = block[:, None] != block[None, :] if len(np.unique(block)) > 1 else np.ones((n, n), bool)
    root = {c: c for c in comp}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    u, v = [], []
    for i, j in zip(*np.nonzero(np.triu(linked & wanted, 1) & (comp[:, None] != comp[None, :]))):
        x, y = find(comp[i]), find(comp[j])
        if x != y:
            root[x] = y
            u.append(comp[i]), v.append(comp[j])
    return pa.table([pa.array(u, table.schema.field("comp").type), pa.array(v, table.schema.field("comp").type)], ["u", "v"])


def _family_links(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) between components inside families, documents with the same
    central document: the full product of a family in blocks of about
    ``BLOCK_DOCS`` documents and ``BLOCK_SHINGLES`` entries, each pair of blocks a task of its own."""
    sizes = members.groupBy("family").agg(F.sum("n").alias("all"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                            F.count(F.lit(1)).alias("docs"))
    sizes = sizes.filter("lo < hi").select("family", F.greatest(F.ceil(F.col("all") / BLOCK_SHINGLES), F.ceil(F.col("docs") / BLOCK_DOCS)).alias("blocks"))
    dealt = members.select("rep", "comp", "family").join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    paired = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    rows = paired.join(sets.withColumnRenamed("id", "rep").hint("merge"), "rep").select("family", "low", "high", "comp", "block", "shingles")
    kind = members.schema["comp"].dataType

    def block(part: pa.Table) -> pa.Table:
        return _block_links(part, num, den)

    return rows.groupBy("family", "low", "high").applyInArrow(
        block, T.StructType([T.StructField("u", kind), T.StructField("v", kind)]))


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       num: int = 75, den: int = 100, star_rounds: int = 1) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``: the size of
    its set of ``k``-word shingles and the smallest id reachable over links
    with Jaccard >= ``num/den``."""
    spark = docs.sparkSession
    small_batches(spark)
    run = Scratch(spark, "ngram-join")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType

    def schema(**cols: T.DataType) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in cols.items()])

    long, longs = T.LongType(), T.ArrayType(T.LongType())
    keys = run.keep(src.mapInArrow(partial(_keys_and_counts, k=k),
                                   schema(id=id_type, n=long, s1=long, s2=long, counts=T.BinaryType())), "keys")
    summed = (keys.filter(F.col("counts").isNotNull()).select("counts").repartition(8)
              .mapInArrow(_sum_counts, "counts binary").collect())
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for row in summed:
        counts += np.frombuffer(row.counts, np.int64)
    counts_b = spark.sparkContext.broadcast(counts)
    keys = keys.filter(F.col("counts").isNull()).drop("counts")

    classes = (src.filter(F.col("id").isNotNull())
               .mapInArrow(partial(_prefixes, k=k, num=num, den=den, counts=counts_b),
                           schema(id=id_type, n=long, s1=long, s2=long, prefix=longs))
               .groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.first("prefix").alias("prefix")))
    postings = classes.select(F.explode("prefix").alias("h"), "rep", F.col("n").cast("int").alias("n"))
    # one shuffle; a shingle of very many documents spans several partitions
    shared = run.keep(postings.repartitionByRange("h", "rep").sortWithinPartitions("h", "rep")
                      .mapInArrow(_shared_rows, postings.schema), "shared")

    weight = F.count(F.lit(1)) / (F.col("n") - _rest(F.col("n"), num, den))
    central = shared.groupBy("rep", "n").agg(weight.alias("share"))
    rows = run.keep(shared.join(central, ["rep", "n"]), "rows")
    run.drop("shared")
    links: DataFrame | None = None
    stars: DataFrame | None = None
    comp = rows.select(F.col("rep").alias("node")).distinct().withColumn("component", F.col("node"))

    def labelled(r: DataFrame) -> DataFrame:
        """Rows of shingles that documents of different components share."""
        if links is None:
            r = r.withColumn("comp", F.col("rep"))
        else:
            r = (r.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                 .withColumn("comp", F.coalesce("component", "rep")).drop("component"))
        ends = r.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("h")
        return r.join(ends, "h", "left_semi")

    for i in range(star_rounds):
        open_rows = run.keep(labelled(rows), f"open-{i}")
        lead = (open_rows.groupBy("h").agg(F.max(F.struct("share", "rep", "comp")).alias("lead"))
                .select("h", F.col("lead.rep").alias("v"), F.col("lead.comp").alias("lead_comp")))
        star = (open_rows.join(lead, "h").filter("comp <> lead_comp")
                .groupBy(F.col("rep").alias("u"), "v").agg(F.count(F.lit(1)).alias("o"))
                .groupBy("u").agg(F.max(F.struct("o", "v")).alias("best")).select("u", "best.v"))
        star = run.keep(star, f"star-{i}")
        ids = star.select("u").union(star.select("v")).distinct()
        sets = (src.join(bounded_broadcast(ids.withColumnRenamed("u", "id")), "id", "left_semi")
                .mapInArrow(partial(_whole_sets, k=k), schema(id=id_type, shingles=longs)))
        found = _verified(star, sets, num, den)
        links = run.keep(found if links is None else links.unionByName(found), f"links-{i}")
        comp = connected_components(links, run, f"cc-{i}")
        stars = star if stars is None else stars.unionByName(star)

    # the rest of the product: pairs of different components
    open_rows = run.keep(labelled(rows), "open")
    shares = open_rows.groupBy("rep", "n", "comp").agg(F.count(F.lit(1)).alias("open"))
    enough = _need(F.col("n"), F.col("n"), num, den) - _rest(F.col("n"), num, den)
    shares = run.keep(shares.withColumn("strong", F.col("open") >= enough), "shares")
    # documents that share much of their prefix with other components: how much of the whole set is shared
    strong = shares.filter("strong").select(F.col("rep").alias("id")).distinct()
    whole = run.keep(src.join(bounded_broadcast(strong), "id", "left_semi")
                     .mapInArrow(partial(_whole_sets, k=k), schema(id=id_type, shingles=longs)), "whole")
    usable = (labelled(whole.select(F.col("id").alias("rep"), F.explode("shingles").alias("h")).distinct())
              .groupBy("rep").agg(F.count(F.lit(1)).alias("usable")))
    family = stars.groupBy(F.col("u").alias("rep")).agg(F.min("v").alias("family"))
    shares = run.keep(shares.join(usable, "rep", "left").join(family, "rep", "left")
                      .withColumn("usable", F.coalesce("usable", F.lit(0))).withColumn("family", F.coalesce("family", "rep")), "limits")
    in_family = _family_links(shares.filter(F.col("strong") & (F.col("usable") * den >= F.col("n") * num)), whole, num, den)
    side = open_rows.select("h", "rep", "n").join(shares, ["rep", "n"])
    a, b = side.alias("a"), side.alias("b")
    need = _need(F.col("a.n"), F.col("b.n"), num, den)
    rest = F.greatest(_rest(F.col("a.n"), num, den), _rest(F.col("b.n"), num, den))
    pairs = (a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.comp") < F.col("b.comp"))
                    & (F.least("a.n", "b.n") * den >= F.greatest("a.n", "b.n") * num)
                    & (F.least("a.open", "b.open") + rest >= need)
                    & (~(F.col("a.strong") & F.col("b.strong"))
                       | (F.least("a.usable", "b.usable") >= need) & (F.col("a.family") != F.col("b.family"))))
             .groupBy(F.col("a.rep").alias("u"), F.col("b.rep").alias("v"), F.col("a.n").alias("nu"), F.col("b.n").alias("nv"))
             .agg(F.count(F.lit(1)).alias("o"))
             .filter(F.col("o") + F.greatest(_rest(F.col("nu"), num, den), _rest(F.col("nv"), num, den))
                     >= _need(F.col("nu"), F.col("nv"), num, den)))
    pairs = run.keep(pairs.select("u", "v").distinct(), "pairs")
    ids = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    sets = (src.join(bounded_broadcast(ids), "id", "left_semi")
            .mapInArrow(partial(_whole_sets, k=k), schema(id=id_type, shingles=longs)))
    found = _verified(pairs, sets, num, den).unionByName(in_family)
    links = run.keep(found if links is None else links.unionByName(found), "links")
    comp = connected_components(links, run, "cc")

    reps = keys.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    reps = run.keep(reps.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                    .select("n", "s1", "s2", F.coalesce("component", "rep").alias("own"), "rows"), "classes")
    for name in ("open", "shares", "whole", "limits", "pairs"):
        run.drop(name)
    # a class of many copies would be one hot key: at most HOT_CLASSES classes
    # hold more than that share of all rows, and they are broadcast
    total = keys.count()
    hot = F.broadcast(reps.filter(F.col("rows") * HOT_CLASSES > total).drop("rows"))
    same = ["n", "s1", "s2"]
    some = keys.filter("n > 0")
    alone = keys.filter("n = 0").withColumn("own", F.col("id"))
    result = (some.join(hot, same).unionByName(some.join(hot, same, "left_anti").join(reps.drop("rows"), same, "left"))
              .unionByName(alone))
    # rows that share an id share the node
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("id").isNotNull(), F.coalesce("own", "id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near copies, that of the
    smallest id, all columns as they were.  Rows that share an id are documents
    of their own, the first by hash of the text counting as the smaller.
    Documents with a null id, or without words, stay."""
    names = docs.columns
    kept = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, c_text = (f"c{names.index(c)}" for c in (id_col, text_col))
    if kept.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1).count():
        # a key of the row's own in the order of the ids: place in the sorted rows
        order = [F.col(key), F.xxhash64(c_text), F.col(c_text)]
        sorted_rows = kept.repartitionByRange(*order).sortWithinPartitions(*order)
        row = F.when(F.col(key).isNotNull(), F.monotonically_increasing_id())
        kept, key = Scratch(docs.sparkSession, "near-copies").keep(sorted_rows.withColumn("row", row), "numbered"), "row"
    groups = ngram_jaccard_join(kept, key, c_text, **options)
    gone = groups.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("__id")).distinct()
    kept = kept.join(bounded_broadcast(gone), F.col(key) == F.col("__id"), "left_anti")
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
