"""HTML pages to rows with JVM-side regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablework.functions.dates import relative_time
from tablework.functions.text import (
    ENGINE_CAPACITY, ENGINE_POWER, LAST_PART, NOT_DEFINED, NOT_SPECIFIED,
    extract_or, repair_utf8, strip_unit, unescape_unicode,
)

# A listing page has an article with an id per listing; articles without one lie inside.
LISTING_START = r"(?i)<article\b(?=[^<>]*\bdata-id\s*=)"
LISTING_ID = r"""^[^>]*?\bdata-id\s*=\s*["']?(\d+)"""
LISTING_LINK = r"""(?is)\bhref\s*=\s*["']([^"']*)["']"""
# Links that open in place, and values with a name.
_IN_PLACE = r"""(?s)^a\b.*\btarget\s*=\s*["']_self["']"""
_NAMED = r"""(?s)^dd\b.*\bdata-parameter\s*=\s*["']([^"']*)["']"""
NAV_LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def inner_text(html: Column) -> Column:
    """What stands between and behind the tags of a piece of markup, blanks collapsed; null when there is nothing."""
    text = F.trim(F.regexp_replace(F.regexp_replace(html, "(?s)<[^>]*>", " "), r"[\s\x{a0}]+", " "))
    return F.nullif(text, F.lit(""))


def first_text(html: Column | str, tag: str) -> Column:
    """Text of the first ``<tag>...</tag>`` on the page."""
    html = F.col(html) if isinstance(html, str) else html
    return F.nullif(F.regexp_extract(html, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1), F.lit(""))


def nav_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Ranked links of each page's navigation list."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(NAV_LINK), 1).alias("href"),
        F.regexp_extract_all(html, F.lit(NAV_LINK), 2).alias("label"),
    )
    links = pages.select(key, F.posexplode(pairs).alias("i", "link"))
    return links.select(key, (F.col("i") + 1).alias("rank"), "link.href", "link.label")


def tokens(html: Column) -> tuple[Column, Column, Column]:
    """A piece of markup cut once at its opening brackets: (raw, heads, texts), three arrays of one length.

    A raw token is a tag and the text behind it; its head is the tag in lower case, its text what follows. The first token
    is what stands before the first bracket. Every array is linear in the markup, whether its tags close or not.
    """
    raw = F.split(html, "<")
    heads = F.transform(raw, lambda t: F.lower(F.substring_index(t, ">", 1)))
    texts = F.transform(raw, lambda t: F.when(F.contains(t, F.lit(">")), F.substr(t, F.instr(t, ">") + 1)).otherwise(""))
    return raw, heads, texts


def listing_kind(head: Column, name: Column) -> Column:
    """What a token opens or closes: the tag's name, ``self`` for a link that opens in place, ``dd:name`` for a named value."""
    return F.when((name == "a") & head.rlike(_IN_PLACE), "self").when(
        (name == "dd") & head.rlike(_NAMED), F.concat(F.lit("dd:"), F.regexp_extract(head, _NAMED, 1))).otherwise(name)


def _blank(text: Column) -> Column:
    return F.trim(F.translate(text, "\n\r\t\u00a0", "    ")) == ""


def _from(opens: Column, close: str) -> Column:
    """Text from a token on (its place, from 1) to the next one that closes; null without either."""
    behind = F.array_position(F.slice("kinds", opens + 1, F.size("kinds")), close).cast("int")
    return F.when((opens > 0) & (behind > 0), inner_text(F.array_join(F.slice("texts", opens, behind), " ")))


def parse_listings(pages: DataFrame, html: str, anchor: Column) -> DataFrame:
    """Listing pages to one row per listing; relative times are resolved against ``anchor``, missing parts are null.

    A card is cut into tokens once, and every part is found by the place of its token: the link that opens in place is the
    title, the paragraph behind it (only closing tags between) the description, a third-level heading the price, and
    the paragraph that begins a value without a name, right behind another value, the time of publication.
    """
    text = repair_utf8(unescape_unicode(html))
    cards = pages.select(F.explode(F.slice(F.split(text, LISTING_START), 2, 2_147_483_646)).alias("card"))
    raw, heads, texts = tokens(F.col("card"))
    cut = cards.select("card", raw.alias("raw"), heads.alias("heads"), texts.alias("texts"))
    cut = cut.withColumn("names", F.transform("heads", lambda h: F.regexp_extract(h, "^(/?[a-z][a-z0-9]*)", 1)))
    cut = cut.withColumn("kinds", F.transform("heads", lambda h, i: listing_kind(h, F.get("names", i)))).drop("heads", "names")
    at = lambda kind: F.array_position("kinds", kind).cast("int")
    kind, words = lambda i: F.get("kinds", i - 1), lambda i: F.get("texts", i - 1)
    # the nearest paragraph behind the title's end, and values without a name that follow a value and begin with a paragraph
    ends = F.col("title") + F.array_position(F.slice("kinds", F.col("title") + 1, F.size("kinds")), "/a").cast("int")
    steps = F.array_position(F.slice("kinds", F.col("ends") + 1, F.size("kinds")), "p").cast("int")
    only_closed = F.forall(F.slice("kinds", F.col("ends") + 1, F.greatest(F.col("steps") - 1, F.lit(0))), lambda k: k.startswith("/")) & F.forall(
        F.slice("texts", "ends", "steps"), _blank)
    values = F.filter(F.sequence(F.lit(2), F.size("kinds") - 1), lambda i: (kind(i) == "dd") & (kind(i - 1) == "/dd") & (kind(i + 1) == "p")
                      & _blank(words(i - 1)) & _blank(words(i)))
    placed = cut.withColumn("title", at("self")).withColumn("ends", F.when(F.col("title") > 0, ends)).withColumn("steps", F.when(F.col("ends") > F.col("title"), steps))
    placed = placed.withColumn("line_at", F.when((F.col("steps") > 0) & only_closed, F.col("ends") + F.col("steps")))
    placed = placed.withColumn("added_at", F.when(F.size("kinds") > 3, F.get(values, F.lit(0))) + 1)
    line = F.col("line")
    value = lambda name: _from(at(f"dd:{name}"), "/dd")
    return (
        placed.withColumn("line", _from(F.col("line_at"), "/p"))
        .select(
            F.regexp_extract("card", LISTING_ID, 1).try_cast("bigint").alias("listing_id"),
            _from(F.col("title"), "/a").alias("notice_name"),
            F.nullif(F.regexp_extract(F.get("raw", F.col("title") - 1), LISTING_LINK, 1), F.lit("")).alias("link"),
            F.trim(extract_or(line, ENGINE_CAPACITY, NOT_SPECIFIED)).alias("engine_capacity"),
            F.trim(extract_or(line, ENGINE_POWER, NOT_SPECIFIED)).alias("engine_power"),
            extract_or(line, LAST_PART, NOT_DEFINED, 2).alias("rest"),
            strip_unit(_from(at("h3"), "/h3"), "PLN").alias("price"),
            strip_unit(value("mileage"), "km").alias("mileage"),
            value("fuel_type").alias("fuel_type"),
            value("gearbox").alias("gearbox"),
            value("year").try_cast("int").alias("production_year"),
            relative_time(_from(F.col("added_at"), "/p"), anchor).alias("when_added"),
        )
    )
