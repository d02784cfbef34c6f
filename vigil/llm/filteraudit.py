"""Audit of how filters interact: who removes what, in every order.

Each document's failures of the five filters are a set, a number below 32.
Spark counts the documents of every part by that number; all that an order of
the filters can show follows from these (at most 32) counts.  For a part, the
number of documents that each of the 32 coalitions of filters removes is
tabulated; the differences of two coalitions are the counts of a step, and the
filters' Shapley values are the solution of the least squares problem over all
coalitions with the kernel weights, under the constraint that the values add
up to what all filters remove.  Its normal equations are solved in rationals.

Filters (``words``: runs of characters other than ASCII white space):
A: under 200 words; B: less than half of the words distinct; C: over 2% of the
code points are A-Z; D: one of ``#$%&*|`` occurs; E: identical to the text of
a smaller id, anywhere in the table, removed or not.

Copies: rows are first counted by id and digest of the text, then by text and
part, so a text that a third of all rows share is a few rows when its smallest
id is looked for, and null ids (which no label has) are spread.

Defined results: a null text is empty (it fails A only, and E if a smaller id
is empty too); a null part is the empty string; a null id is neither smaller
nor larger than another, so it never fails E; rows of the same id and text do
not fail E by each other; repeated rows count each; several labels of an id:
good or toxic if one of them says so; a document without a label is neither;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import lru_cache
from itertools import combinations, permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
SALTS = 1024


# ---------------------------------------------------------------------------
# Failures and their counts (DataFrame)
# ---------------------------------------------------------------------------
def own_failures(text: Column, parts: Column, min_words: int = 200, distinct_pct: int = 50, upper_pct: int = 2,
                 marks: str = "#$%&*|") -> Column:
    """Bits 0 to 3: filters A to D, which look at the text alone.  ``parts``:
    the text split at white space, empty at most at either end."""
    empty_ends = (parts[0] == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    n = F.greatest(F.size(parts) - empty_ends, F.lit(0)).cast("long")
    distinct = (F.size(F.array_distinct(parts)) - F.least(empty_ends, F.lit(1))).cast("long")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return (F.when(n < min_words, 1).otherwise(0) + F.when(100 * distinct < distinct_pct * n, 2).otherwise(0)
            + F.when(100 * upper > upper_pct * F.length(text).cast("long"), 4).otherwise(0)
            + F.when(text.rlike("[" + marks + "]"), 8).otherwise(0))


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                   label_id_col: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, docs, good, toxic): documents of each part by the set of
    filters they fail."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = texts.select("id", "part", "text", F.split("text", WORD_SPLIT).alias("parts")).select(
        "id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        own_failures(F.col("text"), F.col("parts")).cast("int").alias("own"))
    counted = rows.groupBy("id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n"))
    marked = (labels.select(F.col(label_id_col).alias("label_id"), (F.col(good_col) == 1).alias("good"), (F.col(toxic_col) == 1).alias("toxic"))
              .filter("good or toxic").groupBy("label_id").agg(F.coalesce(F.max("good"), F.lit(False)).alias("good"),
                                                                F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic")))
    # a null id meets no label: such rows are dealt by their text
    salt = F.when(F.col("id").isNull(), F.pmod(F.hash("digest"), F.lit(SALTS))).otherwise(0)
    known = (counted.withColumn("salt", salt)
             .join(marked.withColumn("salt", F.lit(0)).withColumnRenamed("label_id", "id"), ["id", "salt"], "left")
             .withColumn("good", F.coalesce("good", F.lit(False))).withColumn("toxic", F.coalesce("toxic", F.lit(False))))
    # per text and part: its rows, and those of the smallest id among them
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    per_text = (known.groupBy("digest", "own", "part", "good", "toxic")
                .agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"), least.alias("least")))
    first = F.min("least.id").over(Window.partitionBy("digest"))
    per_text = per_text.withColumn("first", first)
    original = F.col("no_id") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    kinds = F.array(F.struct(F.col("own").alias("mask"), original.alias("n")),
                    F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - original).alias("n")))
    masks = per_text.select("part", "good", "toxic", F.inline(kinds)).filter("n > 0")
    return masks.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


# ---------------------------------------------------------------------------
# Coalitions, Shapley values, steps (at most 32 counts per part)
# ---------------------------------------------------------------------------
def coalition_removals(counts: Sequence[int]) -> list[int]:
    """Documents that each coalition (a set of filters as a number) removes,
    from the counts by failure set."""
    return [sum(n for mask, n in enumerate(counts) if mask & coalition) for coalition in range(len(counts))]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Gaussian elimination in rationals; the matrix is regular."""
    rows = [[*r, b] for r, b in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        pivot = next(j for j in range(i, n) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for j in range(n):
            if j != i and rows[j][i]:
                rows[j] = [x - rows[j][i] * y for x, y in zip(rows[j], rows[i])]
    return [r[n] for r in rows]


@lru_cache(maxsize=8)
def kernel_weights(k: int) -> dict[int, Fraction]:
    """Weight of every coalition but the empty and the full one."""
    return {s: Fraction(k - 1, comb(k, size) * size * (k - size))
            for s in range(1, (1 << k) - 1) for size in [bin(s).count("1")]}


@lru_cache(maxsize=8)
def normal_matrix(k: int) -> list[list[Fraction]]:
    """Normal equations of the weighted problem, bordered by the constraint
    that the k values add up to the full coalition's."""
    w = kernel_weights(k)
    square = [[sum(x for s, x in w.items() if s >> i & 1 and s >> j & 1) for j in range(k)] + [Fraction(1)] for i in range(k)]
    return [*square, [Fraction(1)] * k + [Fraction(0)]]


def shapley_values(removed: Sequence[int], k: int) -> list[Fraction]:
    """The filters' values: least squares of ``removed`` over all coalitions
    with the kernel weights, their sum held to the full coalition's."""
    right = [sum(x * removed[s] for s, x in kernel_weights(k).items() if s >> i & 1) for i in range(k)]
    return solve(normal_matrix(k), [*right, Fraction(removed[-1])])[:k]


def audit_part(docs: Sequence[int], good: Sequence[int], toxic: Sequence[int], filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of all orders, from one part's counts by failure set."""
    k = len(filters)
    by_docs, by_good, by_toxic = map(coalition_removals, (docs, good, toxic))
    everything, full = sum(docs), (1 << k) - 1
    values = [v * factorial(k) for v in shapley_values(by_docs, k)]
    if any(v.denominator != 1 for v in values):
        raise ArithmeticError("the sum over all orders is no whole number")
    out = []
    for order in permutations(range(k)):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = by_docs[after] - by_docs[before]
            out.append((name, step, everything - by_docs[after], removed, by_docs[1 << i] - removed,
                        by_docs[full] - by_docs[full ^ 1 << i], by_good[after] - by_good[before], by_toxic[after] - by_toxic[before], int(values[i])))
            before = after
    return out


STEP_COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _audit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part, docs, good, toxic in zip(frame["part"], frame["docs"], frame["good"], frame["toxic"]):
            steps = pd.DataFrame(audit_part(docs.tolist(), good.tolist(), toxic.tolist()), columns=STEP_COLUMNS)
            steps.insert(0, "part", part)
            yield steps


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, order of the filters and step."""
    counts = failure_counts(docs, labels, **columns)
    # the 32 counts of a part as one row
    full = [F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)) for m in range(1 << len(FILTERS))]).alias(c)
            for c in ("docs", "good", "toxic")]
    per_part = counts.groupBy("part").agg(*full)
    return per_part.mapInPandas(_audit, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in STEP_COLUMNS[2:]))


#: DuckDB SQL for ``audit`` on ``documents`` and ``labels``: every order walked
#: step by step, Shapley values as sums over the orders.
AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
judged AS (SELECT doc_id, part, [
    len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(first_id < doc_id, false)] AS fails FROM worded),
marked AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
counts AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM judged LEFT JOIN marked USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, s::INTEGER AS step, filter_order[s] AS f, ascii(filter_order[s]) - 64 AS nth,
    [ascii(x) - 64 FOR x IN string_split(filter_order[1:s - 1], '') IF x <> ''] AS earlier FROM orders, range(1, 6) r(s)),
seen AS (SELECT c.part, t.filter_order, t.step, t.f, c.n, c.good, c.toxic, c.fails[t.nth] AS fails_it,
    len([i FOR i IN t.earlier IF c.fails[i]]) > 0 AS gone, len([x FOR x IN c.fails IF x]) AS n_fails FROM counts c, steps t),
summed AS (SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails_it), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND fails_it), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails_it AND n_fails = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails_it), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails_it), 0)::BIGINT AS toxic_lost
    FROM seen GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM summed
"""
