"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents, in a shuffled order that reruns repeat, form a
stream of words that is cut into equal blocks.  The mix is a list of slots; a
slot's place in the golden-ratio sequence is mapped through the cumulative
weights of the sources, which spreads every source evenly over the mix.  The
r-th slot of a source takes its block ``r mod blocks`` in pass ``r div
blocks``.  A source gets exactly the slots nearest its target: slots beyond
are passed over, and the few that the sequence falls short of follow at the
end.

Targets: weights share ``epochs`` times all words; no source's target exceeds
``max_repeat`` times its words, the excess being shared again by weight until
none does (the level of a filling, found in one pass over the sources).

Only DataFrame operations.  Ranks and running sums are built from bounded
groups (chunks of the sequence, hash ranges of a source) and small tables of
their totals, so a source may hold any part of all rows.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, the last; repeated rows are documents of their
own; an empty table gives no rows; other columns are ignored or, by
``mixed_documents``, handed on as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.storage import ROW, Scratch, located
from vigil.operators.common import bounded_broadcast, unbounded

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 256
GROUP_ROWS = 2000           # documents of a source and hash range, about
CHUNK = 1 << 16             # slots ranked together
GOLDEN = 0.6180339887498949
GOLDEN_HIGH = math.fmod((1 << 20) * GOLDEN, 1.0)    # the same step for 2^20 slots

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, epochs: float = 1.5, max_repeat: int = 2,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """(source, sid, source_size, n_docs, target, blocks, slots) from rows
    (source, size); one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(by_name).cast("long"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("most", max_repeat * F.col("source_size"))
    # fill by weight: a source is full at level most / weight
    full = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    everything = Window.partitionBy(F.lit(0))
    per = (per.withColumn("nth", F.row_number().over(full))
           .withColumn("filled", F.sum("most").over(full) - F.col("most"))
           .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(full) + F.col("weight"))
           .withColumn("level", (epochs * F.sum("source_size").over(everything) - F.col("filled")) / F.col("open")))
    first = F.min(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct("nth", "level"))).over(everything)
    target = F.least(F.col("most").cast("double"), first["level"] * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    slots = F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5)).otherwise(0)
    return (per.withColumn("target", target).withColumn("blocks", blocks).withColumn("slots", slots.cast("long"))
            .select("source", "sid", "source_size", "n_docs", "target", "blocks", "slots"))


def schedule(targets: DataFrame, n_slots: int) -> DataFrame:
    """(slot, sid, rank): the mix's slots in order, ``slots`` of every source."""
    spark = targets.sparkSession
    w = Window.orderBy("sid")
    ends = (targets.filter("slots > 0").select("sid", "slots", F.sum("slots").over(w).alias("to"))
            .withColumn("lo", (F.col("to") - F.col("slots")) / F.lit(float(max(n_slots, 1))))
            .withColumn("hi", F.col("to") / F.lit(float(max(n_slots, 1)))))
    # range join on cells of the unit interval
    cells = 4096
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1))
    spread = ends.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    high, low = F.floor(F.col("slot") / (1 << 20)), F.pmod("slot", F.lit(1 << 20))
    point = (high * GOLDEN_HIGH) - F.floor(high * GOLDEN_HIGH) + (low + 1) * GOLDEN
    points = (spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("u", point - F.floor(point))
              .withColumn("cell", cell(F.col("u"))))
    drawn = (points.join(bounded_broadcast(spread), "cell").filter("lo <= u and u < hi")
             .select("slot", "sid", "slots", F.floor(F.col("slot") / CHUNK).alias("chunk")))
    in_chunk = Window.partitionBy("chunk", "sid").orderBy("slot")
    per_chunk = drawn.groupBy("chunk", "sid").agg(F.count(F.lit(1)).alias("n"))
    before = per_chunk.select("chunk", "sid", (F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = (drawn.withColumn("nth", F.row_number().over(in_chunk)).join(bounded_broadcast(before), ["chunk", "sid"])
              .withColumn("rank", F.col("before") + F.col("nth") - 1).filter("rank < slots").select("slot", "sid", "rank"))
    got = per_chunk.groupBy("sid").agg(F.sum("n").alias("got"))
    late = (targets.join(bounded_broadcast(got), "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
            .filter("got < slots")
            .select(F.lit(n_slots).cast("long").alias("slot"), "sid", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank")))
    return ranked.unionByName(late)


def _digits(n_docs: int) -> int:
    """Hexadecimal digits of the shuffle key that deal documents to groups."""
    return max(1, math.ceil(math.log(max(n_docs / GROUP_ROWS, 1), 16)))


def shuffle_key(row_id: Column, text: Column) -> Column:
    """Order of a source's stream: reruns agree, and rows that share an id (or
    have none) are dealt by their texts."""
    return F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit("")))))


def _placed(rows: DataFrame, targets: DataFrame, digits: int) -> DataFrame:
    """Rows (id, source, size, key, ...) with their source's columns and ``at``,
    the words of the source's shuffled stream before them."""
    keyed = (rows.join(bounded_broadcast(targets.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("grp", F.substring("key", 1, digits)))
    sums = keyed.groupBy("sid", "grp").agg(F.sum("size").alias("words"))
    offsets = sums.select("sid", "grp", (F.sum("words").over(Window.partitionBy("sid").orderBy("grp")) - F.col("words")).alias("base"))
    inside = Window.partitionBy("sid", "grp").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (keyed.withColumn("at", F.sum("size").over(inside) - F.col("size"))
            .join(bounded_broadcast(offsets), ["sid", "grp"]).withColumn("at", F.col("at") + F.col("base")).drop("base", "grp"))


def _block_of(word: Column) -> Column:
    """Block that holds a word of a stream of source_size words in ``blocks``
    blocks: the first ``source_size mod blocks`` have one word more."""
    some = F.greatest("blocks", F.lit(1))       # a source of empty texts has no block
    small = F.floor(F.col("source_size") / some)
    extra = F.pmod("source_size", some)
    return F.when(word < extra * (small + 1), F.floor(word / (small + 1))).otherwise(
        extra + F.floor((word - extra * (small + 1)) / F.greatest(small, F.lit(1))))


def block_start(block: Column) -> Column:
    """First word of a block (see ``_block_of``)."""
    some = F.greatest("blocks", F.lit(1))
    small = F.floor(F.col("source_size") / some)
    return block * small + F.least(block, F.pmod("source_size", some))


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, run: Scratch, row: list, **options):
    """(sized, targets, slots, digits); ``row``: columns that name a row."""
    sized = run.keep(docs.select(*row, F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                                 shuffle_key(F.col(id_col), F.col(text_col)).alias("key")), "sized")
    targets = run.keep(source_targets(sized, **options), "targets")
    total = targets.agg(F.sum("slots"), F.sum("n_docs")).first()
    slots = schedule(targets, total[0] or 0)
    return sized, targets, slots, _digits(total[1] or 0)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """(id, size, source_size, target, taken, first_slot) per document: words
    the mix takes, repeats counted, and the first slot that takes any."""
    run = Scratch(docs.sparkSession, "mix")
    # the row's own key: rows of size 0 may be equal in all else
    row = [F.monotonically_increasing_id().alias("row")]
    sized, targets, slots, digits = _plan(docs, id_col, text_col, source_col, run, row, **options)
    placed = _placed(sized, targets, digits)
    blocks = F.when(F.col("size") > 0, F.sequence(_block_of(F.col("at")), _block_of(F.col("at") + F.col("size") - 1)))
    cut = placed.withColumn("block", F.explode_outer(blocks)).withColumn(
        "words", F.least(F.col("at") + F.col("size"), block_start(F.col("block") + 1)) - F.greatest("at", block_start(F.col("block"))))
    times = (slots.join(bounded_broadcast(targets.select("sid", "blocks")), "sid")
             .groupBy("sid", F.pmod("rank", "blocks").alias("block"))
             .agg(F.count(F.lit(1)).alias("times"), F.min("slot").alias("first_slot")))
    return (cut.join(times, ["sid", "block"], "left")
            .groupBy("row", "id", "size", "source_size", "target")
            .agg(F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).cast("long").alias("taken"), F.min("first_slot").alias("first_slot"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_slot"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    length_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix as documents in mix order, all columns as they were.

    Each pass of the schedule over a source gives its documents once, the last
    one cut after the words that the pass's last block takes (``length_col`` is
    then set anew).  A copy stands where the slot that takes its first word
    stands in the schedule: the result's partitions, and so the files it is
    written to, follow the slots from the first to the last.

    The schedule is worked out on sizes and keys alone; texts are joined to
    their copies once, by the place of their row in the table's files."""
    run = Scratch(docs.sparkSession, "mixed")
    names = docs.columns
    c = {n: f"c{i}" for i, n in enumerate(names)}
    rows = located(docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(names)]), run)
    sized, targets, slots, digits = _plan(rows, c[id_col], c[text_col], c[source_col], run, ROW, **options)
    slots = run.keep(slots, "slots")
    # blocks that each pass takes of a source: its first ones
    per_pass = (slots.join(bounded_broadcast(targets.select("sid", "blocks")), "sid")
                .groupBy("sid", F.floor(F.col("rank") / F.col("blocks")).alias("pass")).agg(F.count(F.lit(1)).alias("n")))
    passes = per_pass.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("pass", "n"))).alias("passes"))
    placed = _placed(sized.filter("size > 0"), targets, digits).join(bounded_broadcast(passes), "sid")
    words = lambda p: F.least(F.col("size"), F.greatest(F.lit(0), block_start(p["n"]) - F.col("at"))).cast("int")
    copies = F.filter(F.transform("passes", lambda p: F.struct(p["pass"].alias("pass"), words(p).alias("take"))), lambda x: x["take"] > 0)
    copies = (placed.select(*ROW, "sid", "key", "size", "blocks", _block_of(F.col("at")).alias("block"), F.inline(copies))
              .withColumn("rank", F.col("pass") * F.col("blocks") + F.col("block")))
    copies = copies.join(unbounded(slots), ["sid", "rank"]).select(*ROW, "key", "size", "pass", "take", "slot")
    # hashed by partition: copies are a few numbers each, and texts need no sort
    taken = rows.join(copies.hint("shuffle_hash"), ROW)
    pieces = F.split(F.col(c[text_col]), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("take") >= F.col("size"), F.col(c[text_col])).otherwise(F.array_join(F.slice(pieces, 1, F.col("take")), ""))
    # slots hold equally many words, so equal spans of slots are equal partitions
    n_slots = targets.agg(F.sum("slots")).first()[0] or 0
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = F.least(F.floor(F.col("slot") * n / max(n_slots, 1)), F.lit(n - 1)).cast("int")
    taken = taken.withColumn("cut", text).repartitionById(n, span).sortWithinPartitions("slot", "key", "pass", *ROW)
    out = []
    for name in names:
        if name == text_col:
            out.append(F.col("cut").alias(name))
        elif name == length_col:
            out.append(F.when(F.col("take") >= F.col("size"), F.col(c[name])).otherwise(F.length("cut")).cast(docs.schema[name].dataType).alias(name))
        else:
            out.append(F.col(c[name]).alias(name))
    return taken.select(*out)


#: DuckDB SQL for ``mix_documents`` on ``documents``; the schedule's points are
#: drawn one by one (first_slot -1: never taken).
MIX_SQL = r"""
WITH sized AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source),
weighted AS (SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS most FROM per),
filling AS (SELECT *, row_number() OVER f AS nth, sum(most) OVER f - most AS filled,
    sum(weight) OVER () - sum(weight) OVER f + weight AS open FROM weighted WINDOW f AS (ORDER BY most::DOUBLE / weight, sid)),
levels AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM per)::DOUBLE - filled::DOUBLE) / open::DOUBLE AS level FROM filling),
chosen AS (SELECT level FROM levels WHERE level <= most::DOUBLE / weight ORDER BY nth LIMIT 1),
targets AS (SELECT source, sid, source_size, least(most::DOUBLE, (SELECT level FROM chosen) * weight) AS target,
    ceil(source_size::DOUBLE / 256)::BIGINT AS blocks FROM levels),
slotted AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target * blocks / source_size + 0.5)::BIGINT ELSE 0 END AS slots FROM targets),
placed AS (SELECT s.doc_id, s.size, t.*, sum(s.size) OVER (PARTITION BY t.sid ORDER BY s.key, s.doc_id, s.size
    ROWS UNBOUNDED PRECEDING)::BIGINT - s.size AS pos FROM sized s JOIN slotted t ON s.source IS NOT DISTINCT FROM t.source),
limits AS (SELECT *, CASE WHEN blocks > 0 THEN (slots // blocks) ELSE 0 END AS whole, CASE WHEN blocks > 0 THEN (slots % blocks) ELSE 0 END AS part FROM placed),
cut AS (SELECT *, CASE WHEN blocks > 0 THEN part * (source_size // blocks) + least(part, source_size % blocks) ELSE 0 END AS words,
    CASE WHEN size = 0 THEN NULL WHEN pos < (source_size % blocks) * (source_size // blocks + 1) THEN pos // (source_size // blocks + 1)
         ELSE source_size % blocks + (pos - (source_size % blocks) * (source_size // blocks + 1)) // (source_size // blocks) END AS block FROM limits),
total AS (SELECT sum(slots)::BIGINT AS n FROM slotted),
ends AS (SELECT sid, slots, sum(slots) OVER (ORDER BY sid)::BIGINT AS upto FROM slotted WHERE slots > 0),
points AS (SELECT i AS slot, (i // 1048576)::DOUBLE * fmod(1048576 * 0.6180339887498949::DOUBLE, 1.0::DOUBLE) AS high,
    (i % 1048576 + 1)::DOUBLE * 0.6180339887498949::DOUBLE AS low FROM range((SELECT n FROM total)) r(i)),
spots AS (SELECT slot, (high - floor(high)) + low - floor((high - floor(high)) + low) AS u FROM points),
drawn AS (SELECT p.slot, e.sid, e.slots, row_number() OVER (PARTITION BY e.sid ORDER BY p.slot) - 1 AS rank FROM spots p, ends e, total
    WHERE (e.upto - e.slots)::DOUBLE / n::DOUBLE <= p.u AND p.u < e.upto::DOUBLE / n::DOUBLE)
SELECT c.doc_id, c.size, c.source_size, c.target, (whole * size + greatest(0, least(size, words - pos)))::BIGINT AS taken,
    CASE WHEN c.block < c.slots THEN coalesce(d.slot, (SELECT n FROM total)) ELSE -1 END AS first_slot
FROM cut c LEFT JOIN drawn d ON d.sid = c.sid AND d.rank = c.block
"""
