"""Standing searches.

Two forms:

* **Column builders** (``term``, ``phrase``, ``wildcard``, ``prefix``,
  ``near``, ``fuzzy``, ``all_of``, ``any_of``, ``none_of``, ``language``,
  ``date_range``) evaluate one search on each row of a DataFrame that has a
  token array -- a narrow ``filter``, no shuffle.
* **``match_projects``** evaluates *every* project's search against every
  document at once.  The patterns and fuzzy terms are first expanded against
  the distinct vocabulary of the documents into an index token -> clause;
  then each document is tokenised once, its tokens are cut down to those of
  the index inside the row, and only these are exploded, joined with the index
  by equality and moved through a single shuffle keyed by document.  Patterns
  cost the vocabulary, not its occurrences, and no work grows with
  tokens x projects.

Clause rows (``project_terms``): ``project_id, clause_id, negated, kind,
term``.  Positive clauses are ANDed, rows sharing a clause are alternatives
(OR), a hit on any negated clause excludes the document.  ``kind`` is
``term | phrase | prefix | wildcard | fuzzyK | nearN``, optionally scoped to
the title as ``title:<kind>``.  Search text = title + body, lower-cased,
tokens = runs of letters and digits (a hyphenated phrase is its token
sequence).
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.dates import ts_lit
from vigil.functions.text import tokens
from vigil.operators.common import bounded_broadcast, spread
from vigil.session import checkpoint_dir


# ---------------------------------------------------------------------------
# Column builders over a token array column
# ---------------------------------------------------------------------------
def search_tokens(title: str = "title", text: str = "story_text") -> Column:
    return tokens(F.concat_ws(" ", F.col(title), F.col(text)))


def _toks(on: str | Column) -> Column:
    return F.col(on) if isinstance(on, str) else on


def _words(s: str) -> list[str]:
    return re.findall(r"[^\W_]+", s.lower())


def term(t: str, on: str | Column = "tokens") -> Column:
    """Whole word, case-insensitive; text of several words is a phrase."""
    ws = _words(t)
    return F.array_contains(_toks(on), ws[0]) if len(ws) == 1 else phrase(t, on)


def phrase(p: str, on: str | Column = "tokens") -> Column:
    """Adjacent tokens (a hyphenated phrase is its token sequence); a
    phrase without a word matches nothing."""
    ws = _words(p)
    padded = F.concat(F.lit(" "), F.array_join(_toks(on), " "), F.lit(" "))
    return padded.contains(" " + " ".join(ws) + " ") if ws else F.lit(False)


def wildcard_regex(p: str) -> str:
    return "^" + "".join(".*" if ch == "*" else "." if ch == "?" else re.escape(ch) for ch in p.lower()) + "$"


def wildcard(p: str, on: str | Column = "tokens") -> Column:
    """``?`` one character, ``*`` any run."""
    rx = wildcard_regex(p)
    return F.exists(_toks(on), lambda x: x.rlike(rx))


def prefix(p: str, on: str | Column = "tokens") -> Column:
    """Stem search ``learn*``."""
    return F.exists(_toks(on), lambda x: x.startswith(p.lower()))


def fuzzy(t: str, max_edits: int = 1, on: str | Column = "tokens") -> Column:
    """C11: a token within ``max_edits`` edits (bounded Levenshtein returns -1
    beyond the bound)."""
    return F.exists(_toks(on), lambda x: F.levenshtein(x, F.lit(t.lower()), max_edits) >= 0)


def near(*words_and_n: str | int, on: str | Column = "tokens") -> Column:
    """``near(word, word, ..., n)``: all the words, in any order, with no
    two of them more than ``n`` positions apart (a repeated word must occur as
    often as it is given)."""
    *given, n = words_and_n
    ts, wanted = _toks(on), Counter(w.lower() for w in given)

    def occurrences(window: Column, word: str) -> Column:
        return F.size(F.filter(window, lambda x: x == word))

    return F.exists(
        F.sequence(F.lit(1), F.greatest(F.size(ts), F.lit(1))),
        lambda i: all_of(*[occurrences(F.slice(ts, i, F.lit(n + 1)), w) >= k for w, k in wanted.items()]))


def all_of(*preds: Column) -> Column:
    """AND (also the meaning of juxtaposition)."""
    return reduce(lambda x, y: x & y, preds)


def any_of(*preds: Column) -> Column:
    """OR."""
    return reduce(lambda x, y: x | y, preds)


def none_of(*preds: Column) -> Column:
    """NOT / ``-``."""
    return ~any_of(*preds)


def language(code: str, col: str = "language") -> Column:
    """The story's language equals the project's."""
    return F.lower(F.col(col)) == code.lower()


def date_range(col: str, start: dt.datetime, end: dt.datetime) -> Column:
    """C14: the half-open range ``{start TO end]`` = ``> start AND <= end``."""
    return (F.col(col) > ts_lit(start)) & (F.col(col) <= ts_lit(end))


def search(df: DataFrame, pred: Column, title: str = "title", text: str = "story_text") -> DataFrame:
    """Keep rows satisfying ``pred``; adds ``tokens`` (title + body) and
    ``title_tokens`` for the builders, dropped again afterwards."""
    return (df.withColumn("tokens", search_tokens(title, text))
            .withColumn("title_tokens", tokens(F.col(title)))
            .filter(pred).drop("tokens", "title_tokens"))


# ---------------------------------------------------------------------------
# Every project against every document
# ---------------------------------------------------------------------------
def _parse_kind(project_terms: DataFrame) -> DataFrame:
    # A ``title:`` prefix scopes a clause to the title token stream
    k = F.col("kind")
    field = F.when(k.startswith("title:"), F.lit("title")).otherwise(F.lit("all"))
    base = F.regexp_replace(k, "^title:", "")
    return (project_terms
            .withColumn("field", field)
            .withColumn("base", F.regexp_extract(base, "^([a-z]+)", 1))
            .withColumn("arg", F.regexp_extract(base, "([0-9]+)$", 1))
            .withColumn("alt", F.xxhash64(base, F.lower("term")))
            .dropDuplicates(["project_id", "clause_id", "negated", "field", "alt"]))


KINDS = ("term", "phrase", "prefix", "wildcard", "fuzzy", "near")
GRAM = 3    # length of the probe of a pattern that has a literal only in its middle


def _patterns(pt: DataFrame) -> DataFrame:
    """Prefix and wildcard clauses with ``regex`` and the literal part they are
    found by: ``part`` = (form, lit), the form being ``p`` a literal start, ``s``
    a literal end, ``g`` up to ``GRAM`` characters of the longest inner
    literal, ``a`` none (a pattern of ``?`` and ``*`` alone)."""
    t = F.lower("term")
    is_prefix = F.col("base") == "prefix"
    start = F.when(is_prefix, t).otherwise(F.regexp_extract(t, r"^[^?*]*", 0))
    end = F.regexp_extract(t, r"[^?*]*$", 0)
    inner = F.array_max(F.transform(F.split(t, r"[?*]+"), lambda x: F.struct(F.length(x).alias("n"), x.alias("lit"))))
    gram = F.substring(inner["lit"], 1, GRAM)

    def part(form: str, lit: Column) -> Column:
        return F.struct(F.lit(form).alias("form"), lit.alias("lit"))

    literal = F.regexp_replace(t, r"([^\p{L}\p{N}])", r"\\$1")
    wild = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"([^\p{L}\p{N}?*])", r"\\$1"), r"\?", "."), r"\*", ".*")
    return pt.filter(F.col("base").isin("prefix", "wildcard")).select(
        "field", "project_id", "clause_id", "negated", "alt",
        F.when(start != "", part("p", start)).when(end != "", part("s", end))
        .when(gram != "", part("g", gram)).otherwise(part("a", F.lit(""))).alias("part"),
        F.concat(F.lit("^"), F.when(is_prefix, F.concat(literal, F.lit(".*"))).otherwise(wild), F.lit("$")).alias("regex"))


def search_meta(project_terms: DataFrame) -> dict:
    """Two small actions over the (config-sized) clause table: the forms and
    lengths of pattern literals, the fuzzy edit bound and word-length range,
    whether any clause is title-scoped, and the fields with patterns or fuzzy
    terms.  Everything the index needs to
    know up front.  Clauses of an unknown kind are an error."""
    pt = _parse_kind(project_terms)
    t = F.lower("term")
    is_fz = F.col("base") == "fuzzy"
    edits = F.coalesce(F.nullif("arg", F.lit("")), F.lit("1")).cast("int")
    r = pt.select(
        F.max(F.when(is_fz, edits)).alias("edits"),
        F.min(F.when(is_fz, F.length(t) - edits)).alias("fz_min"),
        F.max(F.when(is_fz, F.length(t) + edits)).alias("fz_max"),
        F.max((F.col("field") == "title").cast("int")).alias("has_title"),
        F.min(F.when(~F.col("base").isin(*KINDS), F.col("kind"))).alias("unknown"),
        F.collect_set(F.when(is_fz, F.col("field"))).alias("fuzzy_fields"),
    ).first()
    if r["unknown"] is not None:
        raise ValueError(f"unknown kind of clause: {r['unknown']}")
    parts = _patterns(pt).select("field", "part.form", F.length("part.lit").alias("n")).distinct().collect()
    return {"parts": sorted({(x["form"], x["n"]) for x in parts}), "edits": int(r["edits"] or 0),
            "fz_min": r["fz_min"], "fz_max": r["fz_max"], "has_title": bool(r["has_title"]),
            "loose": sorted({x["field"] for x in parts} | set(r["fuzzy_fields"]))}


def clause_keys(project_terms: DataFrame, max_edits: int) -> DataFrame:
    """Probe keys of every clause word.

    Columns: ``field, key, project_id, clause_id, negated, alt, near, offset,
    n, dist, times, regex, word, edits``.  ``alt`` tells the alternatives of a
    clause apart.  ``near`` = 0 marks a token sequence of ``n`` words, 1 the
    ``n`` distinct words of a near clause (word number ``offset`` needed
    ``times`` times within ``dist`` positions).  Words of sequences and near
    clauses are keyed by themselves, single words by ``~w:<word>``, patterns by
    their literal part (then checked with ``regex``), fuzzy terms by their
    deletion variants ``~d:<variant>`` (then checked with Levenshtein).  Keys
    are equality keys, so the vocabulary meets them in a hash join.
    """
    pt = _parse_kind(project_terms)
    common = ["field", "project_id", "clause_id", "negated", "alt"]
    pt = pt.withColumn("words", tokens(F.col("term")))
    # a near clause of one word is that word
    is_near = (F.col("base") == "near") & (F.size("words") > 1)

    seq = (pt.filter(F.col("base").isin("term", "phrase", "near") & ~is_near)
           .select(*common, F.posexplode("words").alias("offset", "word"), F.size("words").alias("n"))
           .select(*common, F.when(F.col("n") == 1, F.concat(F.lit("~w:"), "word")).otherwise(F.col("word")).alias("key"),
                   "offset", "n", "word"))

    pats = _patterns(pt).select(
        *common, F.format_string("~%s%d:%s", "part.form", F.length("part.lit"), "part.lit").alias("key"),
        F.lit(0).alias("offset"), F.lit(1).alias("n"), "regex")

    t = F.lower(F.col("term"))
    fz = (pt.filter(F.col("base") == "fuzzy")
          .select(*common, t.alias("word"),
                  F.coalesce(F.nullif("arg", F.lit("")), F.lit("1")).cast("int").alias("edits"),
                  F.explode(deletion_variants(t, max_edits)).alias("v"))
          .select(*common, F.concat(F.lit("~d:"), F.col("v")).alias("key"),
                  F.lit(0).alias("offset"), F.lit(1).alias("n"), "word", "edits"))

    # without a number the words of a near clause are neighbours, in any order
    dist = F.coalesce(F.nullif("arg", F.lit("")).cast("int"), F.size("words") - 1)
    nears = (pt.filter(is_near)
             .select(*common, "words", dist.alias("dist"), F.size(F.array_distinct("words")).alias("n"),
                     F.posexplode(F.array_distinct("words")).alias("offset", "key"))
             .withColumn("times", F.size(F.filter("words", lambda x: x == F.col("key")))).drop("words"))

    out = (seq.unionByName(pats, allowMissingColumns=True)
           .unionByName(fz, allowMissingColumns=True)
           .unionByName(nears, allowMissingColumns=True))
    return out.withColumn("near", F.col("dist").isNotNull().cast("int"))


def deletion_variants(w: Column, depth: int) -> Column:
    """The word and every string made by deleting up to ``depth`` characters.

    Two words within ``k`` edits share a variant of depth ``k`` (symmetric
    deletion), so fuzzy search becomes an equality join plus a check.
    """
    out = F.array(w)
    for _ in range(depth):
        out = F.array_distinct(F.flatten(F.transform(out, lambda x: F.array_union(F.array(x), F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(x), F.lit(1))),
            lambda i: F.concat(F.substring(x, 1, i - 1), F.substring(x, i + 1, 1 << 20)))))))
    return out


def _grams(tok: Column, n: int, head: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(tok) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.concat(head, F.substring(tok, i, F.lit(n))))


def _pattern_keys(tok: Column, meta: dict) -> list[Column]:
    """Arrays of the probe keys of one token for pattern and fuzzy clauses."""
    keys = []
    for form, n in meta["parts"]:
        head = F.lit(f"~{form}{n}:")
        if form == "g":
            keys.append(F.array_distinct(_grams(tok, n, head)))
        else:
            lit = {"p": F.substring(tok, 1, n), "s": F.substring(tok, -n, n), "a": F.lit("")}[form]
            keys.append(F.array(F.concat(head, lit)))
    if meta["edits"]:
        # only tokens whose length is within reach of some fuzzy term
        reach = F.length(tok).between(meta["fz_min"], meta["fz_max"])
        keys.append(F.when(reach, F.transform(deletion_variants(tok, meta["edits"]),
                                               lambda v: F.concat(F.lit("~d:"), v)))
                    .otherwise(F.array().cast("array<string>")))
    return keys


def _tokenised(d: DataFrame, title: str, text: str, meta: dict) -> DataFrame:
    """``(doc_id, doc_lang, all, title)``: the token arrays of every document."""
    in_title = tokens(F.col(title)) if meta["has_title"] else F.array().cast("array<string>")
    return d.select("doc_id", "doc_lang", search_tokens(title, text).alias("all"),
                    F.coalesce(in_title, F.array().cast("array<string>")).alias("title"))


def _placed_clauses(keys: DataFrame) -> DataFrame:
    """Phrases and near clauses, one row per alternative: ``phrase`` (its words
    with single spaces) or ``needs`` (word, times) within ``dist``, and as
    ``token`` the longest word, by which documents find the clause."""
    key = F.col("key")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("offset", "key"))), lambda x: x["key"])
    need = F.sort_array(F.collect_set(F.struct(key.alias("word"), F.coalesce("times", F.lit(1)).alias("times"))))
    return (keys.filter("regex IS NULL AND edits IS NULL").filter(~key.startswith("~w:"))
            .groupBy("field", "project_id", "clause_id", "negated", "alt", "near")
            .agg(F.max(F.struct(F.length(key), key))["key"].alias("token"), F.array_join(in_order, " ").alias("phrase"),
                 need.alias("needs"), F.max("dist").alias("dist"))
            .select("field", F.lit(True).alias("placed"), "token", "project_id", "clause_id", "negated",
                    F.when(F.col("near") == 0, F.col("phrase")).alias("phrase"), "needs", "dist"))


def clause_index(toks: DataFrame, keys: DataFrame, meta: dict) -> DataFrame:
    """The standing searches as an index ``token -> clause``: ``field, placed,
    token``, the clause's columns and what ``_placed_clauses`` checks.

    Words stand for themselves.  Patterns and fuzzy terms are expanded once
    against the distinct tokens of their field in all documents: a token's
    probe keys meet the clauses' literals and deletion variants, and the
    survivors are checked.  Not ``placed``: the token's presence in a document
    is the hit; phrases and near clauses are then looked for in the document.
    """
    columns = ["field", "placed", "token", "project_id", "clause_id", "negated"]
    words = keys.filter("regex IS NULL AND edits IS NULL").filter(F.col("key").startswith("~w:"))
    out = words.withColumn("token", F.expr("substring(key, 4)")).withColumn("placed", F.lit(False)).select(*columns)
    loose = keys.filter("regex IS NOT NULL OR edits IS NOT NULL")
    fits = F.when(F.col("regex").isNotNull(), F.expr("token RLIKE regex")).otherwise(F.levenshtein("token", "word") <= F.col("edits"))
    for field in meta["loose"]:
        vocabulary = toks.select(F.explode(F.array_distinct(field)).alias("token")).distinct()
        probes = vocabulary.select("token", F.explode(F.concat(*_pattern_keys(F.col("token"), meta))).alias("key"))
        found = probes.join(bounded_broadcast(loose.filter(F.col("field") == field)), "key").filter(fits)
        out = out.unionByName(found.withColumn("placed", F.lit(False)).select(*columns))
    return out.distinct().unionByName(_placed_clauses(keys), allowMissingColumns=True)


# An index of up to this many tokens goes into the plan as a set, by which
# documents drop all other tokens before the explode; a larger one is met by
# the join alone, with the same result.
SET_TOKENS = 1 << 16


def _token_sets(tokens_of: DataFrame) -> dict[tuple[str, str], list[str] | None]:
    """``(field, use) -> its distinct tokens``, None for more than ``SET_TOKENS``."""
    tokens_of = tokens_of.distinct()
    counts = {(r.field, r.use): r["count"] for r in tokens_of.groupBy("field", "use").count().collect()}
    return {k: [r.token for r in tokens_of.filter((F.col("field") == k[0]) & (F.col("use") == k[1])).collect()] if n <= SET_TOKENS else None
            for k, n in counts.items()}


def _together(text: Column, needs: Column, dist: Column, copies: Column) -> Column:
    """Whether all the words of a near clause lie within ``dist`` positions,
    each position counting ``copies`` times.  A position holds one token, so no
    window holds more than ``dist`` + 1."""
    at = F.filter(F.transform(F.split(text, " "), lambda x, i: F.struct(i.alias("pos"), x.alias("word"))),
                  lambda y: F.exists(needs, lambda w: w["word"] == y["word"]))

    def enough(win: Column) -> Column:
        return F.forall(needs, lambda w: F.size(F.filter(win, lambda y: y["word"] == w["word"])) * copies >= w["times"])

    # the occurrences are bound once (one element) and looked at by position
    return F.exists(F.array(at), lambda occ: F.exists(F.sequence(F.lit(1), F.greatest(F.size(occ), F.lit(1))), lambda j: enough(
        F.filter(F.slice(occ, j, dist + 1), lambda y: y["pos"] <= F.get(occ, j - 1)["pos"] + dist))))


def _hits(toks: DataFrame, index: DataFrame) -> DataFrame:
    """``(doc_id, doc_lang, project_id, clause_id, negated)``: the documents'
    clause hits.

    A document is cut inside the row, before anything is exploded: to the
    distinct tokens that are clauses of their own, and to the words of phrases
    and near clauses.  The latter leave as one text, in which every other token
    is an empty word, with each token by which such a clause is found; the
    clause is checked in it as soon as the index is met.  No occurrence moves
    by itself."""
    placed_words = index.filter("placed").select("field", F.lit("words").alias("use"), F.explode(F.coalesce(
        F.split("phrase", " "), F.transform("needs", lambda w: w["word"]))).alias("token"))
    sets = _token_sets(index.select("field", F.when(F.col("placed"), "found_by").otherwise("alone").alias("use"), "token").unionByName(placed_words))

    def kept(tokens_: Column, field: str, use: str) -> Column:
        wanted = sets[field, use]
        return tokens_ if wanted is None else F.filter(tokens_, lambda x: x.isin(wanted))

    def entries(tokens_: Column, field: str, placed: bool, text: Column) -> Column:
        return F.transform(F.array_distinct(tokens_), lambda x: F.struct(
            F.lit(field).alias("field"), F.lit(placed).alias("placed"), x.alias("token"), text.alias("text")))

    cuts = []
    for field in ("all", "title"):
        if (field, "alone") in sets:
            cuts.append(entries(kept(F.col(field), field, "alone"), field, False, F.lit(None).cast("string")))
        if (field, "words") in sets:
            wanted = sets[field, "words"]
            cut = F.col(field) if wanted is None else F.transform(field, lambda x: F.when(x.isin(wanted), x).otherwise(""))  # noqa: B023
            text = f"{field}_text"
            toks = toks.withColumn(text, F.concat(F.lit(" "), F.array_join(cut, " "), F.lit(" ")))
            cuts.append(entries(kept(F.col(field), field, "found_by"), field, True, F.col(text)))
    if not cuts:
        cuts = [F.array().cast("array<struct<field:string,placed:boolean,token:string,text:string>>")]
    rows = toks.select("doc_id", "doc_lang", F.inline(F.concat(*cuts)))
    phrase_hit = F.col("text").contains(F.concat(F.lit(" "), "phrase", F.lit(" ")))
    near = F.col("placed") & F.col("phrase").isNull()
    met = rows.join(bounded_broadcast(index), ["field", "placed", "token"]).filter(~F.col("placed") | near | phrase_hit)
    # an id with several rows counts the positions of equal ones together: a
    # near clause short of a repeated word alone waits for the number of copies
    most = F.aggregate("needs", F.lit(1), lambda m, w: F.greatest(m, w["times"]))
    sure = F.when(near, _together(F.col("text"), F.col("needs"), F.col("dist"), F.lit(1))).otherwise(F.lit(True))
    met = met.withColumn("sure", sure)
    met = met.filter(F.col("sure") | F.when(most > 1, _together(F.col("text"), F.col("needs"), F.col("dist"), most)).otherwise(F.lit(False)))
    waits = lambda c: F.when(~F.col("sure"), F.col(c)).alias(c)
    columns = ["doc_id", "doc_lang", "project_id", "clause_id", "negated"]
    counted = met.select(*columns, "sure", waits("text"), waits("needs"), waits("dist")) \
        .groupBy(*columns, "sure", "text", "needs", "dist").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    short = F.when(F.col("copies") > 1, _together(F.col("text"), F.col("needs"), F.col("dist"), F.col("copies"))).otherwise(F.lit(False))
    return counted.filter(F.when(F.col("sure"), F.lit(True)).otherwise(short)).select(*columns)


def match_projects(docs: DataFrame, project_terms: DataFrame, projects: DataFrame | None = None,
                   doc_id: str = "doc_id", title: str = "title", text: str = "story_text",
                   lang: str = "language") -> DataFrame:
    """``(project_id, doc_id)`` for every document satisfying a project's
    standing search (and its language, when ``projects`` is given).

    Plan: the searches become an index of tokens (``clause_index``; with
    patterns or fuzzy terms one pass over the distinct vocabulary), written
    once -> one scan; each document is tokenised once, cut down to the index's
    tokens inside the row, and these are exploded -> hash join with the index
    (broadcast within its measured bound), phrases and near clauses checked in
    the document's cut text -> AND/NOT per (document, project).  Every token
    counts once per document, so frequent words flood neither the join nor the
    shuffle, and no group grows with the length of a document.
    """
    meta = search_meta(project_terms)
    # keys per clause row are bounded (words of a phrase, deletion variants)
    keys = clause_keys(project_terms, meta["edits"])
    d = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("doc_lang"), title, text))
    toks = _tokenised(d, title, text, meta)
    # read three times below: written once to the shared folder
    checkpoint_dir(docs.sparkSession)
    hits = _hits(toks, clause_index(toks, keys, meta).checkpoint())
    clauses = hits.distinct()
    per_doc = (clauses.groupBy("doc_id", "doc_lang", "project_id")
               .agg(F.count_if(~F.col("negated")).alias("pos_hits"),
                    F.max(F.col("negated").cast("int")).alias("neg_hit")))

    need = (project_terms.filter(~F.col("negated")).groupBy("project_id")
            .agg(F.count_distinct("clause_id").alias("need")))
    need = bounded_broadcast(need)
    out = per_doc.join(need, "project_id") \
        .filter((F.col("pos_hits") == F.col("need")) & (F.col("neg_hit") == 0))
    if projects is not None:
        # B2: the project's language clause (C13), applied to every project at once
        pl = projects.select("project_id", F.lower("language").alias("__pl"))
        out = out.join(bounded_broadcast(pl), "project_id") \
            .filter(F.col("__pl").isNull() | (F.lower("doc_lang") == F.col("__pl")))
    return out.select("project_id", F.col("doc_id").alias(doc_id))


def match_counts(matches: DataFrame, projects: DataFrame) -> DataFrame:
    """C17: matches per project, 0 for projects without any."""
    c = matches.groupBy("project_id").agg(F.count(F.lit(1)).alias("matches"))
    return (projects.select("project_id").join(c, "project_id", "left")
            .select("project_id", F.coalesce("matches", F.lit(0)).cast("long").alias("matches")))
