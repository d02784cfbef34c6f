"""Registered queries: standing searches over ``documents``.

The DuckDB twins evaluate every clause by brute force on each document's
token list (no join), an independent check of the join-based Spark plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vigil import schemas
from vigil.operators import search as S
from vigil.plans.registry import query
from vigil.sources import fixtures
from vigil.sources.config import literal_table
from vigil.sources.tables import table

TOKEN_SQL = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}]+')"
DOCS_CTE = """
WITH d0 AS (SELECT doc_id, lang, text, split_part(text, chr(10), 1) AS title,
                   TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '1' DAY * (doc_id % 30) - INTERVAL '1' HOUR * (doc_id % 24)
                   AS indexed_date FROM documents),
d AS (SELECT doc_id, lang, indexed_date, """ + TOKEN_SQL.format(c="concat_ws(' ', title, text)") + """ AS toks,
             """ + TOKEN_SQL.format(c="title") + """ AS ttoks FROM d0)
"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _clause_sql(kind: str, term: str) -> str:
    col = "toks"
    if kind.startswith("title:"):
        col, kind = "ttoks", kind[len("title:"):]
    words = S._words(term)
    if kind == "term" or kind.startswith("near") and len(words) == 1:
        kind = "phrase"
    if kind == "phrase":
        return f"contains(' ' || array_to_string({col}, ' ') || ' ', {_q(' ' + ' '.join(words) + ' ')})"
    if kind == "prefix":
        return f"len(list_filter({col}, lambda x: starts_with(x, {_q(term.lower())}))) > 0"
    if kind == "wildcard":
        return f"len(list_filter({col}, lambda x: regexp_full_match(x, {_q(S.wildcard_regex(term)[1:-1])}))) > 0"
    if kind.startswith("fuzzy"):
        k = int(kind[5:] or 1)
        return f"len(list_filter({col}, lambda x: levenshtein(x, {_q(term.lower())}) <= {k})) > 0"
    if kind.startswith("near"):
        n = int(kind[4:])
        every = " AND ".join(f"len(list_filter({col}[i:i + {n}], lambda x: x = {_q(w)})) >= {words.count(w)}"
                             for w in sorted(set(words)))
        return f"len(list_filter(range(1, len({col}) + 1), lambda i: {every})) > 0"
    raise ValueError(kind)


def _project_sql(pid: int, terms=fixtures.PROJECT_TERM_ROWS) -> str:
    rows = [r for r in terms if r[0] == pid]
    pos, neg = {}, []
    for _, cid, negated, kind, term in rows:
        (neg.append(_clause_sql(kind, term)) if negated else pos.setdefault(cid, []).append(_clause_sql(kind, term)))
    conj = " AND ".join("(" + " OR ".join(v) + ")" for _, v in sorted(pos.items()))
    if neg:
        conj += " AND NOT (" + " OR ".join(neg) + ")"
    return conj


def _match_sql(with_language: bool) -> str:
    parts = []
    for r in fixtures.PROJECT_ROWS:
        pid, lang = r[0], r[2]
        cond = _project_sql(pid)
        if with_language and lang:
            cond += f" AND lower(lang) = {_q(lang.lower())}"
        parts.append(f"SELECT CAST({pid} AS BIGINT) AS project_id, doc_id FROM d WHERE {cond}")
    return DOCS_CTE + ", m AS (" + "\nUNION ALL\n".join(parts) + ")\n"


def _docs(spark, sf_dir):
    s = fixtures.stories_from_documents(table(spark, sf_dir, "documents"))
    return s.withColumnRenamed("story_id", "doc_id")


@query("match_projects", sql=_match_sql(True) + "SELECT * FROM m")
def q_match_projects(spark, sf_dir):
    return S.match_projects(_docs(spark, sf_dir), fixtures.project_terms(spark), fixtures.projects(spark))


@query("match_projects_any_language", sql=_match_sql(False) + "SELECT * FROM m")
def q_match_projects_any_lang(spark, sf_dir):
    return S.match_projects(_docs(spark, sf_dir), fixtures.project_terms(spark))


def _counts_sql() -> str:
    vals = ", ".join(f"({r[0]})" for r in fixtures.PROJECT_ROWS)
    return (_match_sql(True) + f", p AS (SELECT CAST(v AS BIGINT) AS project_id FROM (VALUES {vals}) AS t(v))\n"
            "SELECT p.project_id, CAST(count(m.doc_id) AS BIGINT) AS matches FROM p LEFT JOIN m USING (project_id) "
            "GROUP BY 1")


@query("match_counts", sql=_counts_sql())
def q_match_counts(spark, sf_dir):
    projects = fixtures.projects(spark)
    return S.match_counts(S.match_projects(_docs(spark, sf_dir), fixtures.project_terms(spark), projects), projects)


# One column per builder over every document (C1-C14), evaluated in a single
# narrow projection.
BUILDERS = [
    ("c_term", "term", "thing"), ("c_phrase", "phrase", "the thing"), ("c_hyphen", "phrase", "two-spirit"),
    ("c_wild_one", "wildcard", "th?ng"), ("c_wild_any", "wildcard", "er*e"), ("c_prefix", "prefix", "ered"),
    ("c_fuzzy", "fuzzy1", "thong"), ("c_near", "near5", "thing erre"), ("c_title", "title:term", "the"),
]


@query("search_builders", sql=DOCS_CTE + "SELECT doc_id, "
       + ", ".join(f"{_clause_sql(k, t)} AS {n}" for n, k, t in BUILDERS)
       + ", (list_contains(toks, 'thing') AND (list_contains(toks, 'erre') OR list_contains(toks, 'eran'))"
         " AND NOT list_contains(toks, 'no')) AS c_boolean"
       + ", lower(lang) = 'en' AS c_language"
       + ", (indexed_date > TIMESTAMP '2024-01-20 00:00:00' AND indexed_date <= TIMESTAMP '2024-01-25 00:00:00')"
         " AS c_range FROM d")
def q_search_builders(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("tokens", S.search_tokens()) \
        .withColumn("title_tokens", F.regexp_extract_all(F.lower("title"), F.lit(r"[\p{L}\p{N}]+"), 0))
    cols = {
        "c_term": S.term("thing"), "c_phrase": S.phrase("the thing"), "c_hyphen": S.phrase("two-spirit"),
        "c_wild_one": S.wildcard("th?ng"), "c_wild_any": S.wildcard("er*e"), "c_prefix": S.prefix("ered"),
        "c_fuzzy": S.fuzzy("thong", 1), "c_near": S.near("thing", "erre", 5),
        "c_title": S.term("the", on="title_tokens"),
        "c_boolean": S.all_of(S.term("thing"), S.any_of(S.term("erre"), S.term("eran")), S.none_of(S.term("no"))),
        "c_language": S.language("en"),
        "c_range": S.date_range("indexed_date", dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 25)),
    }
    return d.select("doc_id", *[c.alias(n) for n, c in cols.items()])


# Searches at the edges of the syntax: one project each.
EDGE_TERM_ROWS = [
    (0, 1, False, "near5", "thing erre the"), (1, 1, False, "near8", "the the thing"),
    (2, 1, False, "wildcard", "*ing"), (3, 1, False, "wildcard", "*hin*"), (4, 1, False, "wildcard", "*[xy]g"),
    (5, 1, False, "wildcard", "*.b*"), (6, 1, False, "wildcard", "*(ban"), (7, 1, False, "wildcard", "???"),
    (8, 1, False, "prefix", "th?"), (9, 1, False, "term", "the thing"),
    (10, 1, False, "phrase", "big thing"), (10, 1, False, "phrase", "the other"),
    (11, 1, False, "phrase", " ".join(["the thing"] * 50)),
    (12, 1, False, "near5", "thing"), (13, 1, False, "title:wildcard", "*e"), (13, 2, True, "wildcard", "?h*g"),
]


@query("match_edge_searches", sql=DOCS_CTE + "\nUNION ALL\n".join(
    f"SELECT CAST({pid} AS BIGINT) AS project_id, doc_id FROM d WHERE {_project_sql(pid, EDGE_TERM_ROWS)}"
    for pid in sorted({r[0] for r in EDGE_TERM_ROWS})))
def q_match_edge_searches(spark, sf_dir):
    """Near over several words, wildcards at the start and around,
    special characters, alternatives that are phrases, a long phrase."""
    return S.match_projects(_docs(spark, sf_dir), literal_table(spark, EDGE_TERM_ROWS, schemas.PROJECT_TERMS))
