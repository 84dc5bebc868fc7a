"""Pseudonyms that keep the format: personal numbers and dates go through a keyed Feistel permutation.

Candidates are found by pattern and validated (Luhn sum, calendar, number ranges). A valid value is an index in the set of
all valid values of its format; a Feistel network with a keyed hash permutes that index, and the result is written
back into the same places. Equal values get equal pseudonyms in every document, two values never get the same one,
and a pseudonym is again valid. Mail addresses, which are no numbers, get a keyed digest as mailbox.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked

ROUNDS = 8
# A domain has 127 labels at most; a loop without a bound recurses once per label in the JVM and can end it.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9])(?:(?:19|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2(?:19|20)[0-9]{2})(?![0-9])"
# DATE inside a later part of the combined pattern, where its groups have other numbers.
_DATE_AHEAD = DATE.replace("\\1", "\\3").replace("\\2", "\\4")
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
# National and international numbers in groups of 3 and 4; international ones in pairs, with an unbroken rest, or unbroken; French
# and Spanish ones in pairs. Unbroken national numbers look like any other number and are no candidates.
PHONE = (
    r"(?<![0-9A-Za-z+])(?:"
    r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?(?!(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9]))|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}"
    r"|\+[0-9]{1,3}[ .-]?(?:\(0\)[ .-]?)?[0-9]{1,4}(?:[ .-][0-9]{2}){3,5}|\+[0-9]{1,3}[ -](?:\(0\)[ .-]?)?[0-9]{7,12}|\+[0-9]{8,15}"
    r"|0[1-9](?:[ .-][0-9]{2}){4}|[6-9][0-9]{2}(?:[ -][0-9]{2}){3})(?![0-9])"
)
# Groups of digits parted by one blank or hyphen, 13 digits at least: one or more cards, phones and other numbers in a row. It ends
# before a group that begins a date, mail address, address, social number or dotted phone.
_DOTTED = r"(?:[0-9]{2,4}\.[0-9]{3,4}[ .-]?[0-9]{3,4}|0[1-9](?:\.[0-9]{2}){4})(?![0-9])"
RUN = (
    r"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++"
    rf"(?:[ -](?!{_DATE_AHEAD}|{MAIL}|{ADDRESS}|(?<!-){SOCIAL}|{_DOTTED})[0-9]++)*+"
)
PATTERNS = {"mail": MAIL, "address": ADDRESS, "date": DATE, "social": SOCIAL, "run": RUN, "phone": PHONE}
# How cards are grouped, likeliest first: 16 digits by fours before 16 digits and a security code, then 4-6-5, 4-6-4 and
# shorter or longer ones, digits in one piece, and digit by digit.
GROUPINGS = (
    (4, 4, 4, 4), *((4, 4, 4, 4, n) for n in (3, 2, 1)), (4, 6, 5), (4, 6, 4), *((4, 4, 4, n) for n in (3, 2, 1)),
    *((n,) for n in (16, 15, 14, 13, 19, 18, 17)), (1,) * 16, (1,) * 15,
)
LEAST_CARD, MOST_CARD = 13, 19
# Part of every match of every pattern: 8.8.8.8 and 4-1-1-1 have no two digits side by side.
NEEDED = "[0-9][0-9. -][0-9]|@"
# Days from 1900-01-01 to 2099-12-31.
FIRST_DAY, DAYS = "1900-01-01", 73049
_COUNTRY = r"^\+[0-9]{1,3}(?=[ .(-])"


def _combined() -> str:
    """All patterns as one; the back references of the date pattern count groups from the start."""
    return "|".join(PATTERNS[k] for k in ("date", "mail", "address", "social", "run", "phone"))


def _keyed(key: str, kind: str, turn: Column, half: Column, size: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), size.cast("string"), turn.cast("string"), half.cast("string")).cast("binary"), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), size)


def permuted(index: Column, left: Column, right: Column, key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. left * right - 1: each round adds a hash of one half to the other."""

    def turn(state, i):
        changed_left = F.pmod(state["l"] + _keyed(key, kind, i, state["r"], left), left)
        changed_right = F.pmod(state["r"] + _keyed(key, kind, i, state["l"], right), right)
        return F.when(i % 2 == 0, F.struct(changed_left.alias("l"), state["r"].alias("r"))).otherwise(
            F.struct(state["l"].alias("l"), changed_right.alias("r"))
        )

    # whole-number division: a double would lose digits of long numbers
    start = F.struct(((index - F.pmod(index, right)) / right).cast("decimal(20,0)").cast("long").alias("l"), F.pmod(index, right).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * right + s["r"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _put(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in order."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.array_join(F.transform(places, lambda i: F.when(
        F.substr(text, i, F.lit(1)).rlike("[0-9]"),
        F.substr(digits, F.length(_digits(F.substr(text, F.lit(1), i))), F.lit(1)),
    ).otherwise(F.substr(text, i, F.lit(1)))), "")


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    n = F.length(digits)
    half = F.floor(n / 2)
    value = permuted(digits.cast("long"), _power(half), _power(n - half), key, kind)
    return F.lpad(value.cast("string"), n, "0")


def _luhn_sum(digits: Column) -> Column:
    """Sum over digits from the right, every second one doubled, the rightmost being doubled first (no check digit yet)."""
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda s, i: s + F.element_at(
        F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 0, F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))))
        .otherwise(F.array(*map(F.lit, range(10)))), F.substr(digits, i, F.lit(1)).cast("int") + 1,
    ))


def _check_digit(body: Column) -> Column:
    return F.pmod(-_luhn_sum(body), F.lit(10)).cast("string")


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group)


def _card(text: Column, key: str) -> Column:
    digits = _digits(text)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = _permuted_digits(body, key, "card")
    return _let(new, lambda n: _put(text, F.concat(n, _check_digit(n))))


def _phone(text: Column, key: str) -> Column:
    country = _part(text, _COUNTRY, 0)
    rest = F.substr(text, F.length(country) + 1, F.length(text))
    return F.when(F.length(_digits(rest)).between(7, 15), F.concat(country, _put(rest, _permuted_digits(_digits(rest), key, "phone"))))


def _social(text: Column, key: str) -> Column:
    area, group, serial = (_part(text, r"([0-9]+)-([0-9]+)-([0-9]+)", k).cast("long") for k in (1, 2, 3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    # 898 areas, 99 groups, 9,999 serial numbers
    index = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    new = permuted(index, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, "social")
    serial_, above = F.pmod(new, F.lit(9999)), F.floor(new / 9999)
    group_, area_ = F.pmod(above, F.lit(99)), F.floor(above / 99)
    area_ = area_ + F.when(area_ >= 665, 2).otherwise(1)
    return F.when(valid, F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in ((area_, 3), (group_ + 1, 2), (serial_ + 1, 4))]))


def _address(text: Column, key: str) -> Column:
    parts = F.transform(F.split(text, "[.]"), lambda x: x.cast("long"))
    index = F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    side = F.lit(65536).cast("long")
    new = permuted(index, side, side, key, "address")
    out = F.concat_ws(".", *[F.shiftright(new, s).bitwiseAND(F.lit(255).cast("long")).cast("string") for s in (24, 16, 8, 0)])
    return F.when(F.forall(parts, lambda x: x < 256), out)


def _date(text: Column, key: str) -> Column:
    year_first = text.rlike("^[0-9]{4}")
    a, b, c = (_part(text, r"([0-9]+)[-/.]([0-9]+)[-/.]([0-9]+)", k) for k in (1, 2, 3))
    mark = _part(text, r"([-/.])", 1)
    # 31.12.2020, or 12/31/2020 when the second number can be no month
    month_first = ~year_first & ((b.cast("int") > 12) | ((mark == "/") & (a.cast("int") <= 12)))
    year = F.when(year_first, a).otherwise(c)
    month = F.when(year_first | ~month_first, b).otherwise(a)
    day = F.when(year_first, c).when(month_first, b).otherwise(a)
    parsed = F.try_to_timestamp(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")
    first = F.lit(FIRST_DAY).cast("date")
    # 73,049 = 17 * 4,297
    new = permuted(F.datediff(parsed, first).cast("long"), F.lit(17).cast("long"), F.lit(DAYS // 17).cast("long"), key, "date")
    moved = F.date_add(first, new.cast("int"))

    def shown(value, old):
        return F.when(F.length(old) == 2, F.lpad(value.cast("string"), 2, "0")).otherwise(value.cast("string"))

    y, m, d = F.year(moved).cast("string"), shown(F.month(moved), month), shown(F.dayofmonth(moved), day)
    out = F.when(year_first, F.concat(y, mark, m, mark, d)).when(month_first, F.concat(m, mark, d, mark, y)).otherwise(F.concat(d, mark, m, mark, y))
    return F.when(parsed.isNotNull(), out)


def _mail(text: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(text)).cast("binary"), 256)
    return F.concat(F.lit("user"), F.substring(digest, 1, 16), F.lit("@example.org"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _spans(groups: Column, count_at, next_at) -> Column:
    """Cards among groups of digits: array of (at, n), groups at .. at + n - 1, from left to right and apart.

    ``count_at(i)`` is the number of groups of a valid card that begins with group i, or 0; ``next_at(i)`` where to look
    next when there is none.
    """
    tried = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.struct(i.alias("at"), count_at(i).alias("n"), next_at(i).alias("next")))
    none = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<at: int, n: int>>").alias("cards"))
    return F.aggregate(tried, none, lambda s, x: F.when(x["at"] < s["next"], s).when(
        x["n"] > 0, F.struct((x["at"] + x["n"]).alias("next"), F.concat(s["cards"], F.array(F.struct(x["at"].alias("at"), x["n"].alias("n")))).alias("cards"))
    ).otherwise(F.struct(x["next"].alias("next"), s["cards"].alias("cards"))))["cards"]


def _joined(groups: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(groups, at, n), "")


def _is_card(digits: Column) -> Column:
    def passes(found, body):
        # all zeros pass the sum but are no number
        return (_check_digit(body) == F.substr(found, F.length(found), F.lit(1))) & body.rlike("[1-9]")

    # a value named by several terms is made for each of them, so the digits and all but the last are made first
    return _let(digits, lambda d: F.length(d).between(LEAST_CARD, MOST_CARD)
                & _let(F.substr(d, F.lit(1), F.length(d) - 1), lambda body: passes(d, body)))


def _grouped_cards(groups: Column) -> Column:
    """Cards in one of ``GROUPINGS`` with the same mark between all groups."""
    # a separator and a letter for the length of every group: b for 1, e for 4, t for 19 digits, z for more
    letters = F.transform(groups, lambda g: F.concat(
        F.regexp_replace(g, "[0-9]", ""), F.chr(F.least(F.length(_digits(g)), F.lit(25)).cast("long") + 97)
    ))
    known = F.array(*[F.struct(F.lit(mark.join(chr(97 + n) for n in sizes)).alias("shape"), F.lit(len(sizes)).alias("n"))
                      for sizes in GROUPINGS for mark in (" ", "-")[: len(sizes)]])

    def count_at(letters, i):
        ahead = F.regexp_replace(_joined(letters, i, F.lit(max(map(len, GROUPINGS)))), "^[ -]", "")
        fits = _let(ahead, lambda a: F.filter(known, lambda k: a.startswith(k["shape"]) & _is_card(_digits(_joined(groups, i, k["n"])))))
        return F.coalesce(F.get(fits, F.lit(0))["n"], F.lit(0))

    return _let(letters, lambda found: _spans(groups, lambda i: count_at(found, i), lambda i: i + 1))


def _loose_cards(groups: Column) -> Column:
    """Cards in any grouping: as many groups as a card can have, again from behind them when they are none."""

    def most(i):
        ends = F.aggregate(F.slice(groups, i, F.lit(MOST_CARD)), F.struct(F.lit(0).alias("n"), F.lit(0).alias("digits")), lambda s, g: F.struct(
            F.when(s["digits"] + F.length(_digits(g)) <= MOST_CARD, s["n"] + 1).otherwise(s["n"]).alias("n"),
            (s["digits"] + F.length(_digits(g))).alias("digits"),
        ))
        return ends["n"]

    def count_at(i):
        return _let(most(i), lambda n: F.when(_is_card(_digits(_joined(groups, i, n))), n).otherwise(0))

    return _spans(groups, count_at, lambda i: i + F.greatest(most(i), F.lit(1)))


def _piece(text: Column, kind: str) -> Column:
    """Part of a text: ``kind`` is card (valid), one (candidate of another kind) or empty (stays)."""
    return F.struct(text.alias("text"), F.lit(kind).alias("kind"))


def _cut(groups: Column, cards: Column) -> Column:
    """Pieces: the groups before a card, the card, and so on, the groups behind the last card at the end."""

    def end(k):
        return F.coalesce(F.get(cards, k)["at"] + F.get(cards, k)["n"], F.lit(1))

    return F.concat(
        F.flatten(F.transform(cards, lambda c, k: F.array(
            _piece(_joined(groups, end(k - 1), c["at"] - end(k - 1)), ""), _piece(_joined(groups, c["at"], c["n"]), "card")
        ))),
        F.array(_piece(_joined(groups, end(F.size(cards) - 1), F.size(groups)), "")),
    )


def _cut_where(text: Column, cards) -> Column:
    return _let(F.regexp_extract_all(text, F.lit("[ -]?[0-9]+"), F.lit(0)), lambda g: _let(cards(g), lambda c: _cut(g, c)))


def _run(found: Column, glued: Column) -> Column:
    """Pieces of a run: grouped cards, other kinds between them, cards in any grouping where other kinds leave digits.

    ``glued`` says that a letter or + stands right before the run, which forbids a phone there.
    """
    others = "|".join(PATTERNS[k] for k in ("date", "social", "phone"))

    def marked(piece, k):
        return F.concat(F.when((k == 0) & glued, "A").otherwise(""), piece["text"])

    def loose(piece, k):
        left = F.regexp_replace(marked(piece, k), others, "").rlike("[0-9]")
        many = F.length(_digits(piece["text"])) >= LEAST_CARD
        return F.when((piece["kind"] == "") & many & left, _cut_where(piece["text"], _loose_cards)).otherwise(F.array(piece))

    def other_kinds(text):
        gaps, hits = F.split(text, others, -1), F.regexp_extract_all(text, F.lit(others), F.lit(0))
        return F.flatten(F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: F.array(
            _piece(F.regexp_replace(x["gap"], "^A", ""), ""), _piece(F.coalesce(x["hit"], F.lit("")), "one")
        )))

    pieces = F.flatten(F.transform(_cut_where(found, _grouped_cards), loose))
    return F.flatten(F.transform(pieces, lambda p, k: F.when(p["kind"] == "card", F.array(p)).otherwise(other_kinds(marked(p, k)))))


def _pieces(found: Column, glued: Column) -> Column:
    """Pieces of a match of the combined pattern: what holds digits, blanks and hyphens only may hold several values."""
    whole = {kind: f"^(?:{PATTERNS[kind]})$" for kind in ("date", "social", "phone")}
    single = found.rlike(whole["date"]) | found.rlike(whole["social"]) | (found.rlike(whole["phone"]) & ~glued)
    return F.when(found.rlike("^[0-9][0-9 -]*$") & ~single, _run(found, glued)).otherwise(F.array(_piece(found, "one")))


def pseudonym(piece: Column, key: str) -> Column:
    """Pseudonym of one piece, null when it stays."""
    whole = {kind: f"^(?:{p})$" for kind, p in PATTERNS.items()}
    found = piece["text"]
    return F.when(piece["kind"] == "card", _card(found, key)).when(
        piece["kind"] == "one",
        F.when(found.contains("@"), _mail(found, key))
        .when(found.rlike(whole["date"]), _date(found, key))
        .when(found.rlike(whole["address"]), _address(found, key))
        .when(found.rlike(whole["social"]), _social(found, key))
        .when(found.rlike(whole["phone"]), _phone(found, key)),
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_replaced), one row per input row: every valid candidate of the whole text replaced.

    ``key`` fixes the permutation. Candidates that fail validation stay as they are. A null text stays null with 0
    replacements; ids may be null or repeat; an empty table gives no rows; other columns are not looked at.
    """
    pattern = F.lit(_combined())
    source = picked(docs, doc_id=id_col, text=text_col)
    # most texts have no candidate: one cheap look for what every pattern needs spares them the patterns
    seen = source.withColumn("hits", F.when(F.col("text").rlike(NEEDED), F.regexp_extract_all("text", pattern, F.lit(0))))
    gaps = F.split("text", _combined(), -1)
    pieces = F.flatten(F.transform(F.arrays_zip(gaps.alias("gap"), F.col("hits").alias("hit")), lambda x: F.when(
        x["hit"].isNull(), F.array(_piece(x["gap"], ""))
    ).otherwise(F.concat(F.array(_piece(x["gap"], "")), _pieces(x["hit"], x["gap"].rlike("[A-Za-z+]$"))))))
    cut = seen.withColumn("pieces", F.when(F.size("hits") > 0, pieces))
    new = cut.withColumn("new", F.transform("pieces", lambda p: pseudonym(p, key)))
    both = F.transform("pieces", lambda p, i: F.coalesce(F.get(F.col("new"), i), p["text"]))
    return new.select(
        "doc_id",
        F.when(F.size("hits") > 0, F.array_join(both, "")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.when(F.size("hits") > 0, F.size(F.array_compact("new"))), F.lit(0)).alias("n_replaced"),
    )
