"""Quality rules, lines first: a line that fails a rule is taken out, and a
document that loses too many of its words is rejected.

Only DataFrame functions, in one pass over the texts and without a shuffle.

Line rules (a line without words fails none and counts for nothing):

* symbols: at least one symbol of ``[#*$%&|<>]`` per four words;
* navigation: two or more ``|`` or ``»`` or ``>`` between words, or one or two
  words of 24 characters at most without a closing mark (a sentence of a script
  without spaces is longer);
* boilerplate: a usual phrase of menus and notices, in a line of 30 words at most;
* punctuation: 40 words or more without any sentence mark.

Defined results: null and empty texts have no words, fail the base rules and
are not kept; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
# fixed phrases of the boilerplate rule: English, German, French, Spanish
BOILERPLATE = (r"(?i)\b(cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|read more|"
               r"sign up|log in|subscribe (now|to our)|enable javascript|javascript is (disabled|required)|"
               r"share (this|on)|back to top|skip to (main )?content|"
               r"datenschutzerkl[äÄ]rung|nutzungsbedingungen|alle rechte vorbehalten|hier klicken|weiterlesen|jetzt (anmelden|abonnieren)|"
               r"zum seitenanfang|zum inhalt springen|"
               r"politique de cookies|conditions d.utilisation|tous droits r[éÉ]serv[éÉ]s|cliquez ici|lire la suite|se connecter|haut de page|"
               r"aller au contenu|"
               r"pol[íÍ]tica de (privacidad|cookies)|t[éÉ]rminos de uso|todos los derechos reservados|haga clic|leer m[áÁ]s|iniciar sesi[óÓ]n|"
               r"volver arriba|ir al contenido)\b")
SHORT_LINE = 24             # characters of a line that may be an entry of a menu
MARKS = r"[.!?…。！？]"
MAX_LOST = 0.5


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _removed(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def repeated_words(words: Column, k: int = 5) -> Column:
    """Words inside ``k``-word windows that occur twice or more in the text."""
    n = F.size(words)
    zero = F.lit(0).cast("long")
    windows = F.when(n < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), lambda i: F.xxhash64(*[words[i + j] for j in range(k)])))

    def covered(places: Column) -> Column:
        start = F.struct(zero.alias("n"), F.lit(-k).cast("long").alias("last"))
        return F.aggregate(places, start, lambda s, p: F.struct(
            (s["n"] + F.least(F.lit(k).cast("long"), p - s["last"])).alias("n"), p.alias("last")), lambda s: s["n"])

    def again(sorted_: Column) -> Column:
        m = F.size(sorted_)
        twice = F.filter(sorted_, lambda x, i: F.when(i > 0, sorted_[i - 1]["h"] == x["h"]).otherwise(False)
                         | F.when(i < m - 1, sorted_[i + 1]["h"] == x["h"]).otherwise(False))
        return covered(F.array_sort(F.transform(twice, lambda x: x["i"].cast("long"))))

    def count(g: Column) -> Column:
        placed = F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(g)) < F.size(g), let(F.array_sort(placed), again)).otherwise(zero)

    return let(windows, count)


def _line_fails(line: Column, n: Column) -> Column:
    symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
    bars = F.length(line) - F.length(F.translate(line, "|»>", ""))
    return ((symbols * 4 >= n) & (symbols > 0) | (bars >= 2)
            | (n <= 2) & (F.length(line) <= SHORT_LINE) & ~line.rlike(MARKS)
            | (n <= 30) & line.rlike(BOILERPLATE)
            | (n >= 40) & ~line.rlike(MARKS))


def judge_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_lines_removed, n_words_removed) per document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    long = lambda c: c.cast("long")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    judged = F.transform(lines, lambda x: let(F.size(words_of(x)), lambda n: F.struct(n.alias("n"), _line_fails(x, n).alias("bad"))))
    bad = F.filter("judged", lambda x: x["bad"])
    base = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        let(words_of(F.col("t")), lambda w: F.struct(long(F.size(w)).alias("n"), repeated_words(w).alias("again"))).alias("w"),
        long(F.length(F.translate("t", " \t\n\u000b\f\r", ""))).alias("word_chars"),
        _removed(F.col("t"), SYMBOLS).alias("n_symbols"),
        let(lines, lambda x: long(F.size(x) - F.size(F.array_distinct(x)))).alias("n_dup_lines"),
        judged.alias("judged"))
    counted = base.select(
        "id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.again").alias("n_repeat_words"),
        long(F.size(bad)).alias("n_lines_removed"),
        F.aggregate(bad, F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("n_words_removed"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (counted.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("n_words_removed") <= max_lost * F.col("n_words")))
            .select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_lines_removed", "n_words_removed"))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """(id, text) of the kept documents, their failed lines taken out."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    good = F.filter(F.split(t, "\n"), lambda x: ~x.rlike(WORD) | let(F.size(words_of(x)), lambda n: ~_line_fails(x, n)))
    verdict = judge_lines(docs.select(F.struct(F.col(id_col).alias("id"), F.array_join(good, "\n").alias("clean")).alias("__r"), F.col(text_col)),
                          "__r", text_col, max_lost)
    return verdict.filter("kept").select(F.col("__r.id").alias(id_col), F.col("__r.clean").alias(text_col))


#: DuckDB SQL for ``judge_lines`` on ``documents``.
LINES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 3, 1))) AS i, w FROM d),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
raw AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    length(line) - length(translate(line, '#*$%&|<>', '')) AS symbols,
    length(line) - length(translate(line, '|»>', '')) AS bars FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (SELECT *, (symbols * 4 >= n AND symbols > 0) OR bars >= 2 OR (n <= 2 AND length(line) <= @SHORT@ AND NOT regexp_matches(line, '[.!?…。！？]'))
    OR (n <= 30 AND regexp_matches(line, '@BOILERPLATE@'))
    OR (n >= 40 AND NOT regexp_matches(line, '[.!?…。！？]')) AS bad FROM ln),
per AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines, count(*) FILTER (bad)::BIGINT AS n_lines_removed,
    coalesce(sum(n) FILTER (bad), 0)::BIGINT AS n_words_removed FROM judged GROUP BY doc_id),
counted AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed,
    coalesce(n_words_removed, 0)::BIGINT AS n_words_removed
    FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN per USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words_removed <= 0.5 * n_words AS kept,
    n_lines_removed, n_words_removed FROM counted
""".replace("@BOILERPLATE@", BOILERPLATE).replace("@SHORT@", str(SHORT_LINE))
