"""String, URL and dictionary expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# International Morse code.
MORSE = {
    "A": ".-", "B": "-...", "C": "-.-.", "D": "-..", "E": ".", "F": "..-.", "G": "--.", "H": "....",
    "I": "..", "J": ".---", "K": "-.-", "L": ".-..", "M": "--", "N": "-.", "O": "---", "P": ".--.",
    "Q": "--.-", "R": ".-.", "S": "...", "T": "-", "U": "..-", "V": "...-", "W": ".--", "X": "-..-",
    "Y": "-.--", "Z": "--..",
}

# Engine line of a car listing, for example "1 998 cm3 • 190 KM • Diesel estate".
ENGINE_CAPACITY = r"(^[0-9\s]+cm3\s+)"
ENGINE_POWER = r"•([0-9\s]*KM\s+)•"
LAST_PART = r"(•\s+)([^•]+$)"
NOT_SPECIFIED = "NOT SPECIFIED"
NOT_DEFINED = "NOT DEFINED"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_blank(*parts: Column | str) -> Column:
    """Concatenate with null counting as the empty string."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def strip_controls(c: Column | str) -> Column:
    """Remove line feed, carriage return and tab."""
    return F.translate(_col(c), "\n\r\t", "")


def strip_cr(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\r$", "")


def ascii_upper(c: Column | str) -> Column:
    """Upper-case a-z only."""
    return F.translate(_col(c), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _number(c: Column, to: str) -> Column:
    """Cast text that holds a digit; a failed cast costs an exception per row."""
    return F.when(c.rlike("[0-9]"), c.try_cast(to))


def money(c: Column | str) -> Column:
    """``$1,234.50`` to a number; text that is no number gives null."""
    return _number(F.translate(_col(c), "$,", ""), "double")


def strip_unit(c: Column | str, unit: str, to: str = "bigint") -> Column:
    """``1 234 km`` to a number."""
    return _number(F.regexp_replace(_col(c), rf"\s|{unit}", ""), to)


def extract_or(c: Column | str, pattern: str, default: str, group: int = 1) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit("")), F.lit(default))


def unescape_unicode(c: Column | str) -> Column:
    r"""Turn written-out ``\uXXXX`` escapes into characters (rows without one stay as they are)."""
    c = _col(c)
    quoted = F.concat(F.lit('["'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"]'))
    return F.when(
        c.rlike(r"\\u[0-9a-fA-F]{4}"),
        F.coalesce(F.from_json(quoted, "array<string>", {"allowUnquotedControlChars": "true"})[0], c),
    ).otherwise(c)


def repair_utf8(c: Column | str) -> Column:
    """Undo UTF-8 that was read as Latin-1; rows that were read correctly are left alone."""
    c = _col(c)
    latin_only = c.rlike(r"^[\x{00}-\x{ff}]*$") & c.rlike(r"[\x{c2}-\x{f4}][\x{80}-\x{bf}]")
    again = F.encode(c, "ISO-8859-1").cast("string")
    return F.when(latin_only, F.when(F.is_valid_utf8(again), again).otherwise(c)).otherwise(c)


_WHOLE_URL = r"^([^?#]*)(?:\?([^#]*))?(#.*)?$"


def _decoded(text: Column) -> Column:
    """Percent codes and plus signs undone; what is wrongly encoded stays as it is."""
    return F.coalesce(F.try_url_decode(text), text)


def _pairs(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, _WHOLE_URL, 2), "&"), lambda p: p != "")


def _name(pair: Column) -> Column:
    return _decoded(F.substring_index(pair, "=", 1))


def url_get(url: Column | str, name: str) -> Column:
    """Decoded value of a query parameter (the first of that name); null when it is missing."""
    pair = F.get(F.filter(_pairs(_col(url)), lambda p: _name(p) == name), F.lit(0))
    return _decoded(F.when(pair.contains("="), F.substr(pair, F.instr(pair, "=") + 1, F.length(pair))).otherwise(F.when(pair.isNotNull(), "")))


def url_set(url: Column | str, name: str, value: Column | str) -> Column:
    """Replace a query parameter where it stands, or append it; name and value are encoded."""
    url = _col(url)
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    base, fragment = F.regexp_extract(url, _WHOLE_URL, 1), F.regexp_extract(url, _WHOLE_URL, 3)
    pair = F.concat(F.url_encode(F.lit(name)), F.lit("="), F.url_encode(value))
    pairs = _pairs(url)
    at = F.array_position(F.transform(pairs, _name), name)
    # the first of that name is replaced, others are dropped; names before it differ by definition
    before = F.slice(pairs, F.lit(1), F.greatest(at.cast("int") - 1, F.lit(0)))
    after = F.filter(F.slice(pairs, at.cast("int") + 1, F.size(pairs)), lambda p: _name(p) != name)
    pairs = F.when(at > 0, F.concat(before, F.array(pair), after)).otherwise(F.array_append(pairs, pair))
    return F.concat(base, F.lit("?"), F.array_join(pairs, "&"), fragment)


def next_page(url: Column | str, name: str = "page") -> Column:
    """URL of the following result page: one more than the page asked for, 2 when there is none."""
    asked = url_get(url, name)
    number = F.when(asked.rlike("^[0-9]{1,9}$"), asked).cast("int")
    return url_set(url, name, F.coalesce(number + 1, F.lit(2)))


def translate_each(c: Column | str, codes: dict[str, str], sep: str = " ", blank: str = "/") -> Column:
    """Replace every character by its code word, a blank by ``blank``; a character without a code stays as it is."""
    table = F.create_map(*[F.lit(x) for item in {**codes, " ": blank}.items() for x in item])
    letters = F.filter(F.split(_col(c), ""), lambda ch: ch != "")
    return F.array_join(F.transform(letters, lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), sep)


def translate_back(c: Column | str, codes: dict[str, str], sep: str = " ", blank: str = "/") -> Column:
    """Undo :func:`translate_each`: code words to characters; a word that is no code stays as it is."""
    table = F.create_map(*[F.lit(x) for ch, code in {**codes, " ": blank}.items() for x in (code, ch)])
    return F.array_join(F.transform(F.split(_col(c), sep), lambda w: F.coalesce(F.try_element_at(table, w), w)), "")


def split_rank_title(c: Column | str) -> tuple[Column, Column]:
    """``12) Title`` to (12, Title)."""
    c = _col(c)
    pattern = r"^(\d+)\)\s*(.*)$"
    return _number(F.regexp_extract(c, pattern, 1), "int"), F.regexp_extract(c, pattern, 2)
