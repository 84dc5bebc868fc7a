"""String, date, math, array, JSON and URL expressions (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions import dates, numbers, text
from tablework.operators import matrix
from tablework.plans.registry import query
from tablework.session import table
from tablework.sources.tables import staged


def _alias(**columns):
    return [c.alias(name) for name, c in columns.items()]


@query("H1", """
    SELECT doc_id, coalesce(lang, '') || ':' || coalesce(CAST(quality AS VARCHAR), '') || ':' || coalesce(source, '') AS label
    FROM documents LEFT JOIN labels USING (doc_id)""")
def concat_null_as_blank(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang", "source").join(
        table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", text.concat_blank(
        "lang", F.lit(":"), "quality", F.lit(":"), "source").alias("label"))


@query("H2", """
    SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 6, '0') AS left_padded, rpad(p_brand, 12, '.') AS right_padded,
           CAST(length(p_name) AS INTEGER) AS name_length FROM part""")
def pad_and_length(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *_alias(
        left_padded=F.lpad(F.col("p_size").cast("string"), 6, "0"), right_padded=F.rpad("p_brand", 12, "."),
        name_length=F.length("p_name")))


@query("H3", """
    SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m'), 1, 4) AS report_year, substr(strftime(o_orderdate, '%Y-%m'), 6, 2) AS report_month,
           substr(o_orderpriority, 3) AS priority_name, string_split(o_orderpriority, '-')[2] AS after_mark FROM orders""")
def substrings(spark, sf):
    period = F.date_format("o_orderdate", "yyyy-MM")
    return table(spark, sf, "orders").select("o_orderkey", *_alias(
        report_year=F.substring(period, 0, 4), report_month=F.substring(period, 6, 2),
        priority_name=F.expr("substring(o_orderpriority, 3)"), after_mark=F.substring_index("o_orderpriority", "-", -1)))


@query("H4", """
    SELECT doc_id, replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(9), '') AS clean FROM documents""")
def strip_control_characters(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_controls("text").alias("clean"))


@query("H5", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS amount FROM orders""")
def money_text_to_number(spark, sf):
    """Prices written as $1,234.50 (every fiftieth as a word) and read back."""
    written = F.when(F.col("o_orderkey") % 50 == 0, "unknown").otherwise(
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
    return table(spark, sf, "orders").select("o_orderkey", text.money(written).alias("amount"))


@query("H6", """
    SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS ascii_text, upper(source) AS source FROM documents""")
def upper_case(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *_alias(
        ascii_text=text.ascii_upper("text"), source=F.upper("source")))


@query("H7", """
    SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'NOT SPECIFIED' ELSE p_size || ' 998 cm3' END AS capacity,
           CASE WHEN p_size % 6 = 0 THEN 'NOT SPECIFIED' ELSE '1' || p_size || ' KM' END AS power, p_name AS rest FROM part""")
def extract_with_default(spark, sf):
    size = F.col("p_size").cast("string")
    line = F.concat(
        F.when(F.col("p_size") % 4 == 0, "electric ").otherwise(F.concat(size, F.lit(" 998 cm3 "))),
        F.when(F.col("p_size") % 6 == 0, "").otherwise(F.concat(F.lit("• 1"), size, F.lit(" KM "))),
        F.lit("• "), "p_name")
    return table(spark, sf, "part").select("p_partkey", *_alias(
        capacity=F.trim(text.extract_or(line, text.ENGINE_CAPACITY, text.NOT_SPECIFIED)),
        power=F.trim(text.extract_or(line, text.ENGINE_POWER, text.NOT_SPECIFIED)),
        rest=text.extract_or(line, text.LAST_PART, text.NOT_DEFINED, 2)))


@query("H8", "SELECT p_partkey, CAST(p_partkey AS BIGINT) * 10000000 + p_size AS kilometres FROM part")
def strip_unit(spark, sf):
    """``1 234 km`` with blanks as thousands separators."""
    km = F.col("p_partkey") * 10_000_000 + F.col("p_size")
    written = F.concat(F.replace(F.format_number(km, 0), F.lit(","), F.lit(" ")), F.lit(" km"))
    return table(spark, sf, "part").select("p_partkey", text.strip_unit(written, "km").alias("kilometres"))


@query("H9", """
    SELECT doc_id, string_split(text, '.')[1] AS first_sentence, ltrim(string_split(text, ',')[2]) AS second_part,
           CAST(len(string_split(text, '.')) AS INTEGER) AS sentences FROM documents""")
def split_elements(spark, sf):
    parts = F.split("text", ",")
    return table(spark, sf, "documents").select("doc_id", *_alias(
        first_sentence=F.split("text", r"\.")[0], second_part=F.ltrim(F.get(parts, 1)),
        sentences=F.size(F.split("text", r"\."))))


@query("H10", "SELECT doc_id, text AS repaired FROM documents")
def repair_encoding(spark, sf):
    """Texts whose bytes were read as Latin-1, repaired; correctly read ones must stay."""
    broken = F.when(F.col("doc_id") % 2 == 0, F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", text.repair_utf8(broken).alias("repaired"))


@query("H11", """
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN ts - INTERVAL 1 DAY WHEN 1 THEN ts - to_minutes(event_id % 50 + 2)
      WHEN 2 THEN ts - to_hours(event_id % 20 + 2) WHEN 3 THEN ts - to_days(CAST(event_id % 6 + 2 AS INTEGER)) END AS added FROM events""")
def relative_times(spark, sf):
    n = F.col("event_id")
    word = (
        F.when(n % 5 == 0, "wczoraj")
        .when(n % 5 == 1, F.concat(F.lit("Opublikowano "), n % 50 + 2, F.lit(" minut temu")))
        .when(n % 5 == 2, F.concat(n % 20 + 2, F.lit(" godziny temu")))
        .when(n % 5 == 3, F.concat(n % 6 + 2, F.lit(" dni temu")))
        .otherwise("kiedyś")
    )
    worded = table(spark, sf, "events").select("event_id", "ts", word.alias("word"))
    return worded.select("event_id", dates.relative_time("word", F.col("ts")).alias("added"))


@query("H12", r"""
    SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
           CASE WHEN url LIKE '%?%page=%' THEN regexp_replace(url, '([?&]page=)[^&#]*', '\1next')
                WHEN url LIKE '%?%' THEN regexp_replace(url, '^([^#]*)', '\1&page=next')
                ELSE regexp_replace(url, '^([^#]*)', '\1?page=next') END AS next_url FROM pages""")
def url_parameters(spark, sf):
    return table(spark, sf, "pages").select("page_id", *_alias(
        page=text.url_get("url", "page"), next_url=text.url_set("url", "page", "next")))


@query("H12", """
    SELECT page_id, url AS found, 'a b' AS asked,
           'https://x.example/?search%5Border%5D=' || url_encode(url) || '&q=a+b&page=' || (page_id % 5 + 1) || '#top' AS next_url,
           CASE WHEN url LIKE '%?%page=%' THEN regexp_extract(url, '[?&]page=([^&#]*)', 1)::INTEGER + 1 ELSE 2 END AS next_number FROM pages""")
def url_parameters_decoded(spark, sf):
    """Encoded names and values, and the step to the next page."""
    asked = F.concat(F.lit("https://x.example/?search%5Border%5D="), F.url_encode("url"), F.lit("&q=a+b&page="),
                     (F.col("page_id") % 5).cast("string"), F.lit("#top"))
    return table(spark, sf, "pages").withColumn("asked", asked).select("page_id", *_alias(
        found=text.url_get("asked", "search[order]"), asked=text.url_get("asked", "q"), next_url=text.next_page("asked"),
        next_number=text.url_get(text.next_page("url"), "page").cast("int")))


@query("H13", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
           strftime(o_orderdate, '%Y-%m') AS period FROM orders""")
def extract_year_month(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *_alias(
        y=F.year("o_orderdate"), m=F.month("o_orderdate"), period=F.date_format("o_orderdate", "yyyy-MM")))


@query("H14", """
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) = last_day(o_orderdate) THEN last_day(o_orderdate + INTERVAL 12 MONTH)
      ELSE CAST(o_orderdate + INTERVAL 12 MONTH AS DATE) END AS next_year,
      CASE WHEN CAST(o_orderdate AS DATE) = last_day(o_orderdate) THEN last_day(o_orderdate - INTERVAL 1 MONTH)
      ELSE CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) END AS last_month FROM orders""")
def add_months(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", *_alias(
        next_year=dates.shift_months(day, 12), last_month=dates.shift_months(day, -1)))


@query("H15", """
    SELECT user_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0, 6) AS active_days FROM events GROUP BY 1""")
def fractional_days(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.round(dates.frac_days(F.max("ts"), F.min("ts")), 6).alias("active_days"))


@query("H16", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def parse_mixed_dates(spark, sf):
    """Three written formats and text that is no date."""
    n, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    written = F.when(n == 0, F.date_format(d, "yyyy-MM-dd")).when(n == 1, F.date_format(d, "d.M.yyyy")).when(
        n == 2, F.date_format(d, "yyyy/MM/dd")).otherwise("not a date")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.try_date(written, "yyyy-MM-dd", "d.M.yyyy", "yyyy/MM/dd").alias("parsed"))


@query("H17", """
    SELECT CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS season,
           count(*) AS orders FROM orders GROUP BY 1""")
def season_of_date(spark, sf):
    return table(spark, sf, "orders").groupBy(dates.season("o_orderdate").alias("season")).agg(
        F.count(F.lit(1)).alias("orders"))


@query("H18", """
    SELECT CAST(year(ts) // 10 * 10 AS INTEGER) AS decade, CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS events
    FROM events GROUP BY 1, 2""")
def decade_and_hour(spark, sf):
    return table(spark, sf, "events").groupBy(
        dates.decade("ts").alias("decade"), F.hour("ts").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("events"))


@query("H19", """
    SELECT o_orderkey, CAST(o_custkey % 30 + 18 + 2024 - CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS BIGINT) AS age
    FROM orders""")
def roll_age_forward(spark, sf):
    age = F.col("o_custkey") % 30 + 18
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.age_now(age, dates.season("o_orderdate"), 2024).alias("age"))


@query("H20", """
    SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS BIGINT), 7, 1 + o_custkey % 28) AS summer, make_date(CAST(year(o_orderdate) + 1 AS BIGINT), 1, 1 + o_custkey % 28) AS winter
    FROM orders""")
def transfer_window_dates(spark, sf):
    day = (1 + F.col("o_custkey") % 28).cast("int")
    season = F.year("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", *_alias(
        summer=dates.window_date(season, F.lit(7), day), winter=dates.window_date(season, F.lit(1), day)))


@query("H21", """
    SELECT c_custkey, round(c_acctbal * 1.2345678, 2) AS scaled, abs(c_acctbal) AS size, c_custkey % 7 AS rest, round(c_acctbal / 977, 1) + 0.0::DOUBLE AS thousands
    FROM customer""")
def round_abs_modulo(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", *_alias(
        scaled=F.round(balance * 1.2345678, 2), size=F.abs(balance), rest=F.col("c_custkey") % 7,
        thousands=F.round(balance / 977, 1)))


@query("H22", """
    SELECT p_partkey, round((1 - p_size / 100.0::DOUBLE) / nullif(p_size / 100.0::DOUBLE, 0), 6) AS leverage,
           round(p_retailprice / nullif(p_size - 25, 0), 6) AS return_on_equity, round(100 / nullif(p_retailprice, 0) * p_size, 6) AS pct_baseline
    FROM part""")
def financial_ratios(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *_alias(
        leverage=F.round(numbers.leverage("p_size"), 6),
        return_on_equity=F.round(numbers.safe_div("p_retailprice", F.col("p_size") - 25), 6),
        pct_baseline=F.round(numbers.safe_div(F.lit(100), "p_retailprice") * F.col("p_size"), 6)))


@query("H23", """
    SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[len(embedding)] AS DOUBLE) AS last_value,
           round(list_sum(list_transform(embedding[3:6], lambda x: CAST(x AS DOUBLE))), 6) AS slice_sum,
           len(list_filter(embedding, lambda x: x > 0)) AS positives, CAST(ceil(len(embedding) / 2.0) AS BIGINT) AS every_second,
           CAST(embedding[len(embedding) - 1] AS DOUBLE) AS second_last,
           round((CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)) * 0.5::DOUBLE, 6) AS blend
    FROM embeddings""")
def array_operations(spark, sf):
    e = F.col("embedding")
    as_double = lambda c: c.cast("double")
    return table(spark, sf, "embeddings").select("vec_id", *_alias(
        first_value=as_double(F.element_at(e, 1)), last_value=as_double(F.element_at(e, -1)),
        slice_sum=F.round(F.aggregate(F.slice(e, 3, 4), F.lit(0.0), lambda a, x: a + as_double(x)), 6),
        positives=F.size(F.filter(e, lambda x: x > 0)).cast("bigint"),
        every_second=F.size(numbers.every_nth(e, 2)).cast("bigint"),
        second_last=as_double(F.reverse(e)[1]),
        blend=F.round(as_double(F.element_at(e, 1)) * F.element_at(numbers.grid(0.0, 1.0, 3), 2)
                      + as_double(F.element_at(e, 2)) * F.element_at(numbers.grid(0.0, 1.0, 3), 2), 6)))


# Luminance weights of the red, green and blue channel.
LUMINANCE = [0.2126, 0.7152, 0.0722]


@query("H24", """
    SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) * 0.2126::DOUBLE + CAST(embedding[2] AS DOUBLE) * 0.7152::DOUBLE + CAST(embedding[3] AS DOUBLE) * 0.0722::DOUBLE, 6) AS grey
    FROM embeddings""")
def weighted_channel_sum(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(numbers.weighted_sum(F.slice("embedding", 1, 3), LUMINANCE), 6).alias("grey"))


@query("H24", """
    WITH a AS (SELECT vec_id AS i, unnest(range(len(embedding))) AS k, CAST(unnest(embedding) AS DOUBLE) AS v, label FROM embeddings),
    b AS (SELECT k, label AS j, avg(v) AS v FROM a GROUP BY 1, 2)
    SELECT a.i, b.j, round(sum(a.v * b.v), 5) + 0.0::DOUBLE AS v FROM a JOIN b ON a.k = b.k GROUP BY 1, 2""")
def matrix_product(spark, sf):
    """Vectors times the matrix of label means."""
    vectors = table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    means = matrix.coordinates(vectors, "vec_id", "embedding", "label").groupBy("k", F.col("label").alias("j")).agg(F.avg("v").alias("v"))
    return matrix.tiled_product(vectors, "vec_id", "embedding", staged(means, "means")).withColumn("v", F.round("v", 5) + F.lit(0.0))


@query("H24", """
    WITH a AS (SELECT label AS i, unnest(range(len(embedding))) AS k, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
    SELECT a.i, b.i AS j, round(sum(a.v * b.v), 4) + 0.0::DOUBLE AS v
    FROM (SELECT i, k, avg(v) AS v FROM a GROUP BY 1, 2) a JOIN (SELECT i, k, avg(v) AS v FROM a GROUP BY 1, 2) b ON a.k = b.k GROUP BY 1, 2""")
def matrix_by_coordinates(spark, sf):
    """The matrix of label means times its transpose, both in coordinate form."""
    cells = matrix.coordinates(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    means = cells.groupBy("label", "k").agg(F.avg("v").alias("v"))
    a, b = means.withColumnRenamed("label", "i"), means.withColumnRenamed("label", "j")
    return matrix.product(a, b).withColumn("v", F.round("v", 4) + F.lit(0.0))


@query("H25", """
    SELECT p_partkey, CAST(bit_count(p_partkey) AS INTEGER) AS ones,
           CAST(list_sum(list_transform(range(32), lambda b: ((p_partkey >> CAST(b AS INTEGER)) & 1) << CAST(31 - b AS INTEGER))) AS BIGINT) AS reversed FROM part""")
def bit_operations(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *_alias(
        ones=F.bit_count("p_partkey"), reversed=numbers.reverse_bits("p_partkey")))


_MORSE_SQL = ", ".join(f"('{k}', '{v}')" for k, v in text.MORSE.items())


@query("H26", f"""
    WITH c AS (SELECT p_partkey, unnest(string_split(upper(p_name), '')) AS ch, unnest(range(len(string_split(p_name, '')))) AS i FROM part)
    SELECT c.p_partkey, string_agg(coalesce(m.code, c.ch), ' ' ORDER BY c.i) AS code
    FROM c LEFT JOIN (VALUES {_MORSE_SQL}, (' ', '/')) AS m(ch, code) ON c.ch = m.ch GROUP BY 1""")
def translate_characters(spark, sf):
    """Every character of the name: letters to codes, blanks to a stroke, digits as they are."""
    return table(spark, sf, "part").select("p_partkey", text.translate_each(F.upper("p_name"), text.MORSE).alias("code"))


@query("H26", "SELECT p_partkey, upper(p_name) AS name FROM part")
def translate_back(spark, sf):
    """Codes back to characters."""
    coded = translate_characters(spark, sf)
    return coded.select("p_partkey", text.translate_back("code", text.MORSE).alias("name"))


NESTED_SQL = """CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 100 + 1 END"""


def _transfer_json():
    into = F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 100 + 1).otherwise(F.lit(0))
    teams = F.struct(F.struct(into.alias("id")).alias("in"), F.struct((F.col("user_id") + 500).alias("id")).alias("out"))
    move = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), teams.alias("teams"))
    player = F.struct(F.col("user_id").alias("id"))
    return F.to_json(F.struct(player.alias("player"), F.array(move).alias("transfers")))


TRANSFER = ("player struct<id bigint>, transfers array<struct<date string, "
            "teams struct<`in` struct<id bigint>, `out` struct<id bigint>>>>")


@query("H27 H28", f"""
    SELECT event_id, user_id AS player_id, CAST(ts AS DATE) AS moved, coalesce({NESTED_SQL}, user_id + 500) AS team_id FROM events""")
def nested_json_pick(spark, sf):
    """First transfer of a JSON record; the team joined, or the team left where none was joined."""
    records = table(spark, sf, "events").select("event_id", F.from_json(_transfer_json(), TRANSFER).alias("r"))
    first = F.element_at("r.transfers", 1)
    return records.select("event_id", *_alias(
        player_id=F.col("r.player.id"), moved=F.to_date(first["date"]),
        team_id=F.coalesce(F.nullif(first["teams"]["in"]["id"], F.lit(0)), first["teams"]["out"]["id"])))


@query("H29", "SELECT CAST(p_partkey + 1 AS INTEGER) AS rank, p_name AS title FROM part")
def rank_title_split(spark, sf):
    line = F.concat((F.col("p_partkey") + 1).cast("string"), F.lit(") "), F.col("p_name"))
    rank, title = text.split_rank_title(line)
    return table(spark, sf, "part").select(rank.alias("rank"), title.alias("title")).orderBy("rank")


@query("H30", """
    SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)">([^<]*)</a>', 1)) AS href,
           unnest(regexp_extract_all(html, 'href="([^"]*)">([^<]*)</a>', 2)) AS label FROM pages""")
def pair_lists_by_position(spark, sf):
    pattern = F.lit('href="([^"]*)">([^<]*)</a>')
    lists = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract_all("html", pattern, 1).alias("href"), F.regexp_extract_all("html", pattern, 2).alias("label"))
    return lists.select("page_id", F.inline(F.arrays_zip("href", "label")))


@query("M2 M5", """
    SELECT c_custkey, c_name || '|' || c_mktsegment || '|' || c_nationkey AS joined_key FROM customer""")
def fold_columns(spark, sf):
    """Several columns folded into one string, in a stated order."""
    columns = F.array(*[F.col(c).cast("string") for c in ("c_name", "c_mktsegment", "c_nationkey")])
    return table(spark, sf, "customer").select("c_custkey", F.array_join(F.transform(columns, lambda c: F.trim(c)), "|").alias("joined_key"))


@query("M1", """
    SELECT CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, count(*) AS customers FROM customer GROUP BY 1""")
def sql_function_reuse(spark, sf):
    """A named SQL function applied to each value; it is inlined into the plan."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION tablework_band(x DOUBLE) RETURNS STRING
                 RETURN CASE WHEN x < 0 THEN 'debt' WHEN x < 5000 THEN 'low' ELSE 'high' END""")
    return table(spark, sf, "customer").groupBy(F.expr("tablework_band(c_acctbal)").alias("band")).agg(
        F.count(F.lit(1)).alias("customers"))
