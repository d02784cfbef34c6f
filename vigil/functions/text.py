"""Text expressions (I5, I10-I15, C18): HTML to text, JSON fields, entities,
tokens, message wording.  All native Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import schemas

# Token rules.  Search tokens: runs of letters/digits.  Model features: the
# same, at least two characters long.
TOKEN = r"[\p{L}\p{N}]+"
FEATURE_TOKEN = r"[\p{L}\p{N}]{2,}"

# Elements whose whole content is page furniture, not story text.
_BOILERPLATE = ["script", "style", "nav", "header", "footer", "aside", "noscript", "template"]
# Named character references decoded in the extracted text (the rest become a space).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " ")]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_terms(s: Column | str) -> Column:
    """Curly double quotes to straight ones, no-break space to space."""
    return F.translate(_c(s), "“” ", '"" ')


def html_title(html: Column | str) -> Column:
    t = F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(decode_entities(t), r"\s+", " "))


def decode_entities(s: Column) -> Column:
    # "&amp;" is set aside first and restored last, so "&amp;lt;" stays the
    # literal text "&lt;"; unknown references become a space.
    s = F.replace(s, F.lit("&amp;"), F.lit("\u0001"))
    for ent, ch in ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    s = F.regexp_replace(s, r"&(?:#[0-9]+|#x[0-9a-fA-F]+|[a-zA-Z]+);", " ")
    return F.replace(s, F.lit("\u0001"), F.lit("&"))


def html_to_text(html: Column | str) -> Column:
    """Main text of a page.

    Drops comments, the ``head``, boilerplate elements and ad blocks, then all
    tags; decodes entities; collapses whitespace.
    """
    s = _c(html)
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    s = F.regexp_replace(s, r"(?is)<head[\s>].*?</head>", " ")
    for tag in _BOILERPLATE:
        s = F.regexp_replace(s, rf"(?is)<{tag}[\s>].*?</{tag}>", " ")
    s = F.regexp_replace(s, r"(?is)<div class=\"ad\"[^>]*>.*?</div>", " ")
    s = F.regexp_replace(s, r"<[^>]*>", " ")
    s = decode_entities(s)
    return F.trim(F.regexp_replace(s, r"\s+", " "))


# Block density (I13).  Elements that hold no text of the page, or only its
# furniture by their own name; elements that begin and end a block of text.
_UNSEEN = ["script", "style", "noscript", "template", "nav", "footer", "aside"]
BLOCK_TAG = (r"(?i)</?(?:address|article|blockquote|body|br|dd|div|dl|dt|fieldset|figure|figcaption|form|h[1-6]|header|hr|html|li|main|ol|p|pre|"
             r"section|table|tbody|td|th|tr|ul)(?:\s[^>]*)?/?>")
MIN_DENSITY = 8          # words outside links, smoothed over neighbouring blocks
MAX_LINK_SHARE = 3       # at most one word in three inside links


def _plain(s: Column) -> Column:
    return F.trim(F.regexp_replace(decode_entities(F.regexp_replace(s, r"<[^>]*>", " ")), r"\s+", " "))


def _n_words(s: Column) -> Column:
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, " ")))


def html_blocks(html: Column | str) -> Column:
    """The blocks of text of a page, in order: ``array<struct<text, words,
    linked>>`` with each block's words and how many of them lie inside links.
    Blocks without words are left out."""
    s = F.regexp_replace(_c(html), r"(?s)<!--.*?-->", " ")
    for tag in ["head", *_UNSEEN]:
        s = F.regexp_replace(s, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}>", " ")
    links = lambda b: F.array_join(F.regexp_extract_all(b, F.lit(r"(?is)<a(?:\s[^>]*)?>(.*?)</a>"), 1), " ")
    parts = F.transform(F.split(s, BLOCK_TAG), lambda b: F.struct(_plain(b).alias("text"), _plain(links(b)).alias("link")))
    blocks = F.transform(parts, lambda p: F.struct(p["text"].alias("text"), _n_words(p["text"]).alias("words"), _n_words(p["link"]).alias("linked")))
    return F.filter(blocks, lambda b: b["words"] > 0)


def main_text(html: Column | str, min_density: int = MIN_DENSITY, max_link_share: int = MAX_LINK_SHARE) -> Column:
    """I13 by block density: the blocks whose words outside links, smoothed
    with those of the block before and after (1 : 2 : 1), are dense enough and
    which do not mainly consist of links.  Short blocks (menus, advertisements,
    captions) stay only among dense ones (headings).  No class or id of any
    site is looked at."""
    # the blocks are bound once (one element) and looked at by position
    kept = F.transform(F.array(html_blocks(html)), lambda bs: F.filter(bs, lambda b, i: (
        (F.coalesce(F.get(bs, i - 1)["words"] - F.get(bs, i - 1)["linked"], F.lit(0)) + 2 * (b["words"] - b["linked"])
         + F.coalesce(F.get(bs, i + 1)["words"] - F.get(bs, i + 1)["linked"], F.lit(0)) >= 4 * min_density)
        & (max_link_share * b["linked"] <= b["words"]))))
    return F.array_join(F.transform(kept[0], lambda b: b["text"]), " ")


def html_published_date(html: Column | str) -> Column:
    """I14 (page part): ``article:published_time`` meta or ``<time datetime>``."""
    h = _c(html)
    meta = F.regexp_extract(h, r"(?is)<meta[^>]+property=\"article:published_time\"[^>]+content=\"([^\"]+)\"", 1)
    tm = F.regexp_extract(h, r"(?is)<time[^>]+datetime=\"([^\"]+)\"", 1)
    return F.coalesce((F.nullif(meta, F.lit(""))).try_cast("timestamp"),
                      (F.nullif(tm, F.lit(""))).try_cast("timestamp"))


def json_field(s: Column | str, field: str) -> Column:
    """One top-level field of a JSON document as text; NULL when the
    document does not parse or lacks the field."""
    return F.get_json_object(_c(s), f"$.{field}")


def entity_text(title: Column | str, story_text: Column | str) -> Column:
    """The text sent to entity extraction."""
    return F.concat_ws(" ", _c(title), _c(story_text))


def keep_entities(entities: Column | str) -> Column:
    """Keep accepted entity types, lower-case the text, keep order and
    repeats; NULL stays NULL (extraction failed)."""
    types = F.array(*[F.lit(t) for t in schemas.ACCEPTED_ENTITY_TYPES])
    return F.transform(F.filter(_c(entities), lambda e: F.array_contains(types, e["type"])),
                       lambda e: F.lower(e["text"]))


def tokens(s: Column | str, pattern: str = TOKEN) -> Column:
    """Lower-cased word tokens of a text, in order."""
    return F.regexp_extract_all(F.lower(_c(s)), F.lit(pattern), 0)
