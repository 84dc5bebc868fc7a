"""Registered reports (R), bound to the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tablework.functions.dates import quarter_end, season
from tablework.functions.text import ascii_upper, strip_controls
from tablework.operators import aggs
from tablework.operators.filters import not_blank
from tablework.plans import reports
from tablework.plans.registry import query
from tablework.session import scratch_path, table
from tablework.sources import delimited, html
from tablework.sources.tables import staged

# --- statements and exposures shared by the credit reports ---------------------------------------------------------

STATEMENTS_SQL = """
    raw AS (SELECT o_custkey AS firm, last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS date,
              sum(o_totalprice) AS income, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS filled,
              count(*)::DOUBLE AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS nf, count(*) FILTER (WHERE o_orderstatus = 'O') AS no,
              count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS nu, max(o_totalprice) AS top FROM orders GROUP BY 1, 2),
    st AS (SELECT firm, date, round(100 * c_acctbal / income, 6) AS k1, nf / n AS cr, no / n AS qr, nu / n AS wod,
             CASE WHEN c_nationkey % 5 = 0 THEN round(150 * top / income, 6) END AS woz, round(100 * (filled - 0.6::DOUBLE * income) / income, 6) AS ros,
             round(income, 2) AS income, round(filled - 0.6::DOUBLE * income, 2) AS profit, c_acctbal AS equity
           FROM raw JOIN customer ON firm = c_custkey)"""

EXPOSURES_SQL = """
    ex AS (SELECT o_custkey AS firm, last_day(o_orderdate) AS report_date, round(sum(o_totalprice), 2) AS exposure,
             max(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END) AS bucket FROM orders GROUP BY 1, 2)"""

MATCHED_SQL = f"""{STATEMENTS_SQL},{EXPOSURES_SQL},
    r AS (SELECT *, (1 - k1 / 100) / nullif(k1 / 100, 0) AS leverage, profit / nullif(equity, 0) AS roe FROM st),
    y AS (SELECT a.*, b.date AS last_date, b.income AS last_income, b.leverage AS last_leverage, b.ros AS last_ros, b.roe AS last_roe,
            CASE WHEN b.leverage >= 0 THEN a.leverage - b.leverage END AS leverage_change, a.ros - b.ros AS ros_change, a.roe - b.roe AS roe_change,
            (a.income - b.income) / nullif(b.income, 0) * 100 AS income_change,
            CASE WHEN a.cr < 0.5 AND a.wod < 1 THEN 1 ELSE 0 END AS low_cr, CASE WHEN a.qr < 0.4 AND a.wod < 1 THEN 1 ELSE 0 END AS low_qr,
            CASE WHEN a.k1 < 0 THEN 1 ELSE 0 END AS lost_equity, CASE WHEN a.woz > 100 THEN 1 ELSE 0 END AS shared_debt
          FROM r a LEFT JOIN r b ON a.firm = b.firm AND last_day(b.date + INTERVAL 12 MONTH) = a.date),
    m AS (SELECT ex.report_date, ex.exposure, ex.bucket, y.* FROM ex ASOF JOIN y ON ex.firm = y.firm AND ex.report_date >= y.date)"""


def _monthly(spark, sf):
    """Orders per firm and month, written once: statements and exposures are both built from it."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    monthly = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("firm"), F.last_day("o_orderdate").alias("month")).agg(
        F.sum(price).alias("total"), F.sum(F.when(status == "F", price).otherwise(0.0)).alias("filled"),
        F.count(F.lit(1)).alias("n"), F.count_if(status == "F").alias("nf"), F.count_if(status == "O").alias("no"),
        F.count_if(status == "P").alias("np"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("nu"),
        F.max(price).alias("top"))
    return staged(monthly, "firm_months")


def _by_firm(monthly):
    """Dealt once by firm for all steps of the warnings; a firm has at most one row per calendar month here."""
    return monthly.repartition("firm")


def _statements(spark, sf, monthly):
    """Quarterly statements per firm; the months are added up before the customers are joined."""
    raw = monthly.groupBy("firm", quarter_end("month").alias("date")).agg(
        *[F.sum(c).alias(c) for c in ("total", "filled", "n", "nf", "no", "nu")], F.max("top").alias("top"))
    firms = table(spark, sf, "customer").select(F.col("c_custkey").alias("firm"), "c_acctbal", "c_nationkey")
    profit = F.col("filled") - F.lit(0.6) * F.col("total")
    return raw.join(firms, "firm").select(
        "firm", "date", F.round(100 * F.col("c_acctbal") / F.col("total"), 6).alias("k1"),
        (F.col("nf") / F.col("n")).alias("cr"), (F.col("no") / F.col("n")).alias("qr"), (F.col("nu") / F.col("n")).alias("wod"),
        F.when(F.col("c_nationkey") % 5 == 0, F.round(150 * F.col("top") / F.col("total"), 6)).alias("woz"),
        F.round(100 * profit / F.col("total"), 6).alias("ros"), F.round("total", 2).alias("income"),
        F.round(profit, 2).alias("profit"), F.col("c_acctbal").alias("equity"))


def _exposures(monthly):
    return monthly.select("firm", F.col("month").alias("report_date"), F.round("total", 2).alias("exposure"),
                          F.when(F.col("np") > 0, 2).otherwise(1).alias("bucket"))


def _rounded(df, *columns, digits=3):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_RATIOS = ["cr", "qr", "wod", "ros_change", "roe", "last_roe", "roe_change", "income_change", "leverage", "last_leverage", "leverage_change"]
_RATIO_SQL = ", ".join(f"round({c}, 3) AS {c}" for c in _RATIOS)


@query("R1 B12 B13", f"""
    WITH {MATCHED_SQL},
    w AS (SELECT *, CASE WHEN sum(low_qr) OVER w >= 6 THEN 1 ELSE 0 END AS lasting_qr, CASE WHEN sum(low_cr) OVER w >= 3 THEN 1 ELSE 0 END AS lasting_cr,
            CASE WHEN income_change <= -20 AND leverage_change >= 1 THEN 1 ELSE 0 END AS income_and_leverage,
            CASE WHEN ros_change <= -3 AND roe_change <= -2 THEN 1 ELSE 0 END AS ros_and_roe FROM m WHERE woz IS NULL
          WINDOW w AS (PARTITION BY firm ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT report_date, firm, date, bucket, exposure, low_cr, low_qr, lost_equity, lasting_qr, lasting_cr, income_and_leverage, ros_and_roe,
           k1, ros, last_ros, income, last_income, last_date, {_RATIO_SQL}
    FROM w WHERE 1 IN (low_cr, low_qr, lost_equity, lasting_qr, lasting_cr, income_and_leverage, ros_and_roe)
      AND year(date) >= 1996 AND exposure > 100000 AND bucket = 1""")
def early_warning(spark, sf):
    """Flagship: early-warning flags from quarterly statements, for every report date."""
    monthly = _by_firm(_monthly(spark, sf))
    matched = reports.monitored(_statements(spark, sf, monthly), _exposures(monthly))
    flagged = reports.early_warning(matched, report_date=None, min_year=1996, min_exposure=100_000, bucket=1)
    return _rounded(flagged, *_RATIOS)


@query("R1", f"""
    WITH {MATCHED_SQL},
    w AS (SELECT *, CAST(sum(shared_debt) OVER (PARTITION BY firm ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS hits
          FROM m WHERE woz IS NOT NULL AND abs(woz) < 1000000)
    SELECT report_date, firm, date, bucket, exposure, hits FROM w WHERE hits >= 6 AND year(date) >= 1996 AND exposure > 100000 AND bucket = 1""")
def early_warning_shared(spark, sf):
    monthly = _by_firm(_monthly(spark, sf))
    matched = reports.monitored(_statements(spark, sf, monthly), _exposures(monthly))
    return reports.early_warning_shared(matched, report_date=None, min_year=1996, min_exposure=100_000, bucket=1)


@query("R2", f"""
    WITH {STATEMENTS_SQL},{EXPOSURES_SQL},
    t AS (SELECT firm, sum(exposure) AS exposure, max(bucket) AS bucket FROM ex WHERE report_date = DATE '1998-12-31' GROUP BY 1),
    r AS (SELECT *, (1 - k1 / 100) / nullif(k1 / 100, 0) AS leverage, profit / nullif(equity, 0) AS roe FROM st),
    l AS (SELECT *, coalesce((income - lag(income) OVER w) / nullif(lag(income) OVER w, 0), 0) * 100 AS income_change,
            CASE WHEN lag(leverage) OVER w >= 0 THEN leverage - lag(leverage) OVER w END AS leverage_change,
            ros - lag(ros) OVER w AS ros_change, roe - lag(roe) OVER w AS roe_change FROM r WINDOW w AS (PARTITION BY firm ORDER BY date))
    SELECT l.firm, l.date, t.exposure, t.bucket, CASE WHEN income_change <= -20 AND leverage_change >= 1 THEN 1 END AS leverage_premise,
           CASE WHEN ros_change <= -3 AND roe_change <= -2 THEN 2 END AS income_premise, round(income_change, 2) AS income_change,
           round(leverage_change, 2) AS leverage_change, round(ros_change, 2) AS ros_change, round(roe_change, 2) AS roe_change
    FROM l LEFT JOIN t ON l.firm = t.firm WHERE l.date = DATE '1998-12-31'""")
def premises_report(spark, sf):
    day = datetime.date(1998, 12, 31)
    monthly = _monthly(spark, sf)
    return reports.premises(_statements(spark, sf, monthly), _exposures(monthly), day, day)


PROFILE_SQL = """
    rows AS (SELECT l_orderkey AS account, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS capital,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS defaulted, CASE WHEN l_extendedprice > 40000 AND l_quantity > 40 THEN 1 ELSE 0 END AS overdue,
               CASE WHEN l_tax > 0.07 THEN 'T' ELSE 'N' END AS lost FROM lineitem),
    x AS (SELECT *, max(date) OVER (PARTITION BY account) AS final FROM rows),
    profile AS (SELECT account, min(date) FILTER (WHERE defaulted = 1) AS default_date, min(date) FILTER (WHERE overdue = 1) AS overdue_date,
                  min(date) FILTER (WHERE lost = 'T') AS loss_date, min(date) AS first_date, max(date) AS last_date,
                  max(capital) FILTER (WHERE date = final) AS capital_now, max(lost) FILTER (WHERE date = final) AS lost_now,
                  min(defaulted) FILTER (WHERE date = final) AS defaulted_now,
                  CAST(min(date) FILTER (WHERE defaulted = 1) - min(date) AS INTEGER) AS days_to_default,
                  CAST(min(date) FILTER (WHERE overdue = 1) - min(date) AS INTEGER) AS days_to_overdue,
                  CAST(min(date) FILTER (WHERE lost = 'T') - min(date) AS INTEGER) AS days_to_loss FROM x GROUP BY 1)"""


def _account_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("account"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("capital"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("defaulted"),
        F.when((F.col("l_extendedprice") > 40000) & (F.col("l_quantity") > 40), 1).otherwise(0).alias("overdue"),
        F.when(F.col("l_tax") > 0.07, "T").otherwise("N").alias("lost"))


@query("R3", f"WITH {PROFILE_SQL} SELECT * FROM profile")
def default_profile(spark, sf):
    return reports.default_profile(_account_rows(spark, sf))


def _deviation_sql(start, end):
    return f"""
    WITH {PROFILE_SQL},
    a AS (SELECT count(*) AS n FROM orders JOIN profile ON o_orderkey = account
          WHERE first_date BETWEEN DATE '{start}' AND DATE '{end}' AND o_orderpriority IN ('1-URGENT', '2-HIGH')),
    b AS (SELECT count(*) AS m FROM orders JOIN profile ON o_orderkey = account
          WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) - first_date < 1 AND CAST(o_orderdate AS DATE) BETWEEN DATE '{start}' AND DATE '{end}')
    SELECT n AS deviations, m AS started, round(n::DOUBLE / nullif(m, 0), 8) AS share FROM a, b"""


def _deviation_share(spark, sf, start, end):
    rows = _account_rows(spark, sf)
    orders = table(spark, sf, "orders")
    details = orders.select(F.col("o_orderkey").alias("account"),
                            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("deviations"))
    applications = orders.select(
        F.col("o_orderkey").alias("account"), F.col("o_orderdate").alias("audit"),
        F.when(F.col("o_orderstatus") == "F", "T").otherwise("N").alias("started"))
    first_seen = staged(reports.default_profile(rows).select("account", "first_date"), "first_seen")
    shares = reports.deviation_share(details, applications, first_seen, start, end)
    return shares.withColumn("share", F.round("share", 8))


HALF_YEAR = (datetime.date(1997, 7, 1), datetime.date(1997, 12, 31))
OVER_NEW_YEAR = (datetime.date(1997, 11, 15), datetime.date(1998, 2, 20))


@query("R3 D-17", _deviation_sql(*HALF_YEAR))
def deviation_share(spark, sf):
    return _deviation_share(spark, sf, *HALF_YEAR)


@query("R3", _deviation_sql(*OVER_NEW_YEAR))
def deviation_share_over_new_year(spark, sf):
    """A period that begins in one year and ends in the next."""
    return _deviation_share(spark, sf, *OVER_NEW_YEAR)


@query("R4", f"""
    WITH {STATEMENTS_SQL},{EXPOSURES_SQL},
    c AS (SELECT o_custkey AS account, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS defaulted,
            CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END AS overdue, CASE WHEN o_orderpriority = '1-URGENT' THEN 'T' ELSE 'N' END AS lost FROM orders),
    p AS (SELECT account, CAST(min(date) FILTER (WHERE defaulted = 1) - min(date) AS INTEGER) AS days_to_default,
            CAST(min(date) FILTER (WHERE overdue = 1) - min(date) AS INTEGER) AS days_to_overdue,
            CAST(min(date) FILTER (WHERE lost = 'T') - min(date) AS INTEGER) AS days_to_loss FROM c GROUP BY 1)
    SELECT st.firm, st.date, st.k1, ex.firm AS account, ex.exposure, ex.bucket, p.days_to_default, p.days_to_overdue, p.days_to_loss,
           round(st.k1 / 100, 8) AS equity_share, round((1 - k1 / 100) / nullif(k1 / 100, 0), 3) AS leverage
    FROM st JOIN ex ON st.firm = ex.firm AND st.date = ex.report_date JOIN p ON p.account = ex.firm""")
def leverage_report(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("account"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("capital"),
        (F.col("o_orderstatus") == "P").cast("int").alias("defaulted"), (F.col("o_totalprice") > 400000).cast("int").alias("overdue"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "T").otherwise("N").alias("lost"))
    monthly = _monthly(spark, sf)
    exposures = _exposures(monthly).withColumnRenamed("firm", "owner").withColumn("account", F.col("owner"))
    found = reports.leverage_report(_statements(spark, sf, monthly), exposures, reports.default_profile(rows))
    return found.withColumns({"equity_share": F.round("equity_share", 8), "leverage": F.round("leverage", 3)})


STATEMENT_CODES = list(range(1, 33))


@query("R5", f"""
    SELECT s.s_suppkey, replace(s.s_name, chr(9), '') AS name, n1.n_name AS rating, n2.n_name AS rating_document,
           coalesce(n1.n_name, n2.n_name) AS rating_last, r.r_name AS rating_proposed, CAST(year(l.l_shipdate) AS INTEGER) AS statement_year,
           round(coalesce(sum(l_extendedprice) FILTER (WHERE p_size = 1), sum(l_extendedprice) FILTER (WHERE p_size = 2)), 2) AS income,
           {", ".join(f"round(sum(l_extendedprice) FILTER (WHERE p_size = {c}), 2) AS k{c}" for c in STATEMENT_CODES[2:])}
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation n1 ON s.s_nationkey = n1.n_nationkey LEFT JOIN nation n2 ON (s.s_nationkey + 1) % 25 = n2.n_nationkey
    LEFT JOIN region r ON n1.n_regionkey = r.r_regionkey
    WHERE p_size IN ({", ".join(map(str, STATEMENT_CODES))}) AND l_linestatus = 'F' AND year(l_shipdate) BETWEEN 1996 AND 2000 AND s_name <> '' AND s_name <> ' '
    GROUP BY ALL""")
def statement_pivot(spark, sf):
    """Field values of accepted statements, one column per code, with ratings from three lookups."""
    shipped = F.col("l_shipdate")
    lines = table(spark, sf, "lineitem").where(
        "l_linestatus = 'F' AND l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '2001-01-01'")
    coded = table(spark, sf, "part").where(F.col("p_size").isin(STATEMENT_CODES)).select(F.col("p_partkey").alias("l_partkey"), "p_size")
    fields = lines.join(coded, "l_partkey").withColumn("statement_year", F.year(shipped))
    # pivot on keys alone; names and ratings are looked up for the few resulting rows
    wide = aggs.pivot_sum(fields, ["l_suppkey", "statement_year"], "p_size", "l_extendedprice", STATEMENT_CODES)
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    n1, n2 = nation.alias("n1"), nation.alias("n2")
    suppliers = table(spark, sf, "supplier").where(not_blank("s_name"))
    return (
        wide.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(n1, F.col("s_nationkey") == F.col("n1.n_nationkey"), "left")
        .join(n2, (F.col("s_nationkey") + 1) % 25 == F.col("n2.n_nationkey"), "left")
        .join(region, F.col("n1.n_regionkey") == F.col("r_regionkey"), "left")
        .select("s_suppkey", strip_controls("s_name").alias("name"), F.col("n1.n_name").alias("rating"),
                F.col("n2.n_name").alias("rating_document"), F.coalesce("n1.n_name", "n2.n_name").alias("rating_last"),
                F.col("r_name").alias("rating_proposed"), "statement_year",
                F.round(F.coalesce(F.col("1"), F.col("2")), 2).alias("income"),
                *[F.round(F.col(str(c)), 2).alias(f"k{c}") for c in STATEMENT_CODES[2:]])
    )


UNITS_SQL = """
    units AS (SELECT p_brand AS unit, 'RU_' || p_brand AS unit_name, min(p_type) AS service, 'tower' || length(p_brand) AS tower,
                CASE CAST(substr(p_brand, 7) AS INTEGER) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'U' ELSE 'F' END AS pricing FROM part GROUP BY p_brand),
    vol AS (SELECT p_brand AS unit, round(sum(l_quantity) FILTER (WHERE strftime(l_shipdate, '%Y-%m') = '1997-03'), 2) AS march,
              round(sum(l_quantity) FILTER (WHERE strftime(l_shipdate, '%Y-%m') = '1997-02'), 2) AS february,
              round(sum(l_quantity) / 60, 2) AS baseline, round(avg(p_retailprice), 4) AS price
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    charges AS (SELECT unit, CASE WHEN length(unit) = 7 THEN round(march * 1.25::DOUBLE, 2) END AS arc_quantity, march AS delivered_quantity,
                  round(price * 1.1::DOUBLE, 4) AS arc_price, price AS base_price FROM vol)"""


def _units(spark, sf):
    number = F.substring("p_brand", 7, 3).cast("int") % 3
    units = table(spark, sf, "part").groupBy(F.col("p_brand").alias("unit")).agg(F.min("p_type").alias("service"), F.max(number).alias("g")).select(
        "unit", F.concat(F.lit("RU_"), "unit").alias("unit_name"), "service",
        F.concat(F.lit("tower"), F.length("unit")).alias("tower"),
        F.when(F.col("g") == 0, "A").when(F.col("g") == 1, "U").otherwise("F").alias("pricing"))
    # a written dimension has a known size, so its joins are planned as broadcasts when it is small
    return staged(units, "units")


def _volumes(spark, sf):
    # quantity and rows per part and month first, so the join carries one row per part and month
    monthly = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"), F.trunc("l_shipdate", "month").alias("month")).agg(
        F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    joined = monthly.join(table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice"), "p_partkey")
    in_month = lambda m: F.round(F.sum(F.when(F.col("month") == F.lit(m).cast("date"), F.col("q"))), 2)
    return staged(joined.groupBy(F.col("p_brand").alias("unit")).agg(
        in_month("1997-03-01").alias("march"), in_month("1997-02-01").alias("february"), F.round(F.sum("q") / 60, 2).alias("baseline"),
        F.round(F.sum(F.col("p_retailprice") * F.col("n")) / F.sum("n"), 4).alias("price")), "volumes")


def _charges(volumes):
    return volumes.select(
        "unit", F.when(F.length("unit") == 7, F.round(F.col("march") * F.lit(1.25), 2)).alias("arc_quantity"),
        F.col("march").alias("delivered_quantity"), F.round(F.col("price") * 1.1, 4).alias("arc_price"), F.col("price").alias("base_price"))


@query("R6", f"""
    WITH {UNITS_SQL},
    facts AS (SELECT p_brand AS unit, l_quantity AS quantity, CASE WHEN l_suppkey % 2 = 0 THEN 'pc' || l_suppkey END AS computer,
                'u' || l_suppkey || '@x' AS mail, CASE WHEN l_linenumber > 2 THEN p_name END AS application,
                lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber || '-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || '-' || CAST(l_quantity AS INTEGER) AS line
              FROM lineitem JOIN part ON l_partkey = p_partkey WHERE strftime(l_shipdate, '%Y-%m') = '1997-03' AND l_returnflag IN ('A', 'R')),
    how AS (SELECT unit, sum(quantity) AS n FROM facts GROUP BY 1),
    lines AS (SELECT * FROM facts UNION ALL SELECT c.unit, coalesce(arc_quantity, delivered_quantity) - coalesce(n, 0), NULL, NULL, NULL, NULL
              FROM charges c LEFT JOIN how ON c.unit = how.unit WHERE coalesce(arc_quantity, delivered_quantity) - coalesce(n, 0) > 0),
    j AS (SELECT l.*, u.unit_name, u.service, u.tower, u.pricing, c.arc_price, c.base_price FROM lines l JOIN units u ON l.unit = u.unit LEFT JOIN charges c ON l.unit = c.unit WHERE u.unit <> 'Brand#6')
    SELECT '1997-03-' || lpad(CAST(row_number() OVER (ORDER BY unit, line NULLS LAST) AS VARCHAR), 6, '0') AS line_id, '1997' AS report_year, '03' AS report_month,
           unit, tower, service, CASE WHEN pricing = 'A' THEN unit_name || ':' || coalesce(computer, service) WHEN pricing = 'U' THEN unit_name || ':' || coalesce(application, 'Minimum Volume')
             ELSE unit_name || ':' || mail END AS lifetime_id, quantity, round(CASE WHEN pricing = 'A' THEN arc_price ELSE base_price END, 2) AS unit_price,
           round(round(CASE WHEN pricing = 'A' THEN arc_price ELSE base_price END, 2) * quantity, 2) AS amount FROM j""")
def invoice_lines(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    lines = table(spark, sf, "lineitem").where("l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1997-04-01'")
    padded = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    facts = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("unit"), F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("pc"), "l_suppkey")).alias("computer"),
        F.concat(F.lit("u"), "l_suppkey", F.lit("@x")).alias("mail"),
        F.when(F.col("l_linenumber") > 2, F.col("p_name")).alias("application"),
        F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "R", "invoiced").otherwise("draft").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period"),
        F.concat_ws("-", padded("l_orderkey"), "l_linenumber", padded("l_partkey"), padded("l_suppkey"),
                    F.col("l_quantity").cast("int")).alias("line"))
    return reports.invoice_lines(facts, _units(spark, sf), _charges(_volumes(spark, sf)), "1997-03", without="Brand#6")


@query("R7", f"""
    WITH {UNITS_SQL}
    SELECT u.unit, u.tower, CASE u.unit_name WHEN 'RU_Brand#1' THEN 'FIRST' WHEN 'RU_Brand#2' THEN 'SECOND' WHEN 'RU_Brand#3' THEN 'THIRD' END AS prefix,
           round(coalesce(c.base_price, c.arc_price), 2) AS unit_price, coalesce(v.baseline, 0) AS baseline, coalesce(v.february, 0) AS previous_volume,
           coalesce(CASE WHEN u.pricing = 'A' THEN c.arc_quantity ELSE c.delivered_quantity END, 0) AS invoiced_volume,
           round(coalesce(CASE WHEN u.pricing = 'A' THEN c.arc_quantity ELSE c.delivered_quantity END - v.february, 0), 2) AS delta_volume,
           round(coalesce(100.0::DOUBLE / nullif(v.baseline, 0) * CASE WHEN u.pricing = 'A' THEN c.arc_quantity ELSE c.delivered_quantity END, 0), 2) AS pct_baseline
    FROM units u LEFT JOIN charges c ON u.unit = c.unit LEFT JOIN vol v ON u.unit = v.unit""")
def invoice_totals(spark, sf):
    volumes = _volumes(spark, sf)
    past = volumes.select("unit", F.lit(None).cast("double").alias("past_arc"), F.col("february").alias("past_delivered"))
    prefixes = {"RU_Brand#1": "FIRST", "RU_Brand#2": "SECOND", "RU_Brand#3": "THIRD"}
    totals = reports.invoice_totals(_units(spark, sf), _charges(volumes), past, volumes.select("unit", "baseline"), prefixes)
    return totals.withColumn("delta_volume", F.round("delta_volume", 2))


SEASON_SQL = "CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER)"


@query("R8 D-18 H17", f"""
    WITH tr AS (SELECT DISTINCT o_custkey AS player, o_orderpriority AS team, d FROM (
            SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d, max(strftime(o_orderdate, '%Y-%m-%d')) OVER (PARTITION BY o_custkey) AS x FROM orders WHERE o_orderstatus = 'F') WHERE d = x),
    se AS (SELECT o_custkey AS player, {SEASON_SQL} AS season, min(o_orderpriority) AS first_name, CAST(min(o_orderkey) % 20 + 18 AS BIGINT) AS age, min(o_orderstatus) AS nationality FROM orders GROUP BY 1, 2),
    j AS (SELECT tr.*, 'club' AS squad_team, se.first_name, se.age, se.nationality, se.season FROM tr LEFT JOIN se ON tr.player = se.player AND se.season = 2000),
    full_rows AS (SELECT player, team, CAST(d AS DATE) AS date, squad_team, first_name, age, nationality, season, NULL::BIGINT AS count FROM j WHERE season IS NOT NULL),
    gap AS (SELECT player, team, CAST(d AS DATE) AS date, CASE WHEN month(CAST(d AS DATE)) >= 7 THEN year(CAST(d AS DATE)) ELSE year(CAST(d AS DATE)) - 1 END AS season FROM j WHERE season IS NULL)
    SELECT * FROM full_rows UNION ALL
    SELECT g.player, g.team, g.date, NULL, coalesce(a.first_name, b.first_name), coalesce(a.age + 2024 - a.season, b.age + 2024 - b.season), coalesce(a.nationality, b.nationality),
           CAST(g.season AS INTEGER), count(*) OVER (PARTITION BY g.team, g.season)
    FROM gap g LEFT JOIN se a ON g.player = a.player AND a.season = g.season LEFT JOIN se b ON g.player = b.player AND b.season = g.season - 1""")
def player_master(spark, sf):
    orders = table(spark, sf, "orders")
    transfers = orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("player"), F.col("o_orderpriority").alias("team"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    seasons = orders.groupBy(F.col("o_custkey").alias("player"), season("o_orderdate").alias("season")).agg(
        F.min("o_orderpriority").alias("first_name"), (F.min("o_orderkey") % 20 + 18).alias("age"), F.min("o_orderstatus").alias("nationality"))
    squads = seasons.where("season = 2000").withColumn("squad_team", F.lit("club"))
    return reports.player_master(transfers, squads, seasons, 2024)


@query("R8", """
    SELECT c.c_mktsegment, c.c_custkey, c.c_name FROM customer c JOIN (
      SELECT c_mktsegment, min(c_custkey) AS k FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1) m ON c.c_custkey = m.k AND c.c_mktsegment = m.c_mktsegment""")
def main_row_per_group(spark, sf):
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_name")
    return reports.main_per_group(customers, "c_mktsegment", "c_custkey", "FURNITURE")


@query("R9 A10 C11", """
    SELECT p_partkey AS listing_id, p_name AS notice_name, 'https://x.example/' || p_partkey AS link,
           CASE WHEN p_size % 4 = 0 THEN 'NOT SPECIFIED' ELSE p_size || ' 998 cm3' END AS engine_capacity,
           CASE WHEN p_size % 6 = 0 THEN 'NOT SPECIFIED' ELSE '1' || p_size || ' KM' END AS engine_power, 'ąć ' || p_type AS rest,
           CAST(p_size * 1000 AS BIGINT) AS price, CAST(p_partkey % 90 * 1000 + 7 AS BIGINT) AS mileage, 'benzyna' AS fuel_type, p_brand AS gearbox,
           CAST(2000 + p_size % 20 AS INTEGER) AS production_year,
           CASE p_partkey % 3 WHEN 0 THEN TIMESTAMP '2025-01-09 12:00:00' WHEN 1 THEN TIMESTAMP '2025-01-10 12:00:00' - to_minutes(p_size) END AS when_added FROM part""")
def listing_ingest(spark, sf):
    """Listing pages of twenty cards, parsed; ids stored before are not appended again."""
    p, size, key = F.col, F.col("p_size").cast("string"), F.col("p_partkey")
    line = F.concat(
        F.when(p("p_size") % 4 == 0, "prąd ").otherwise(F.concat(size, F.lit(" 998 cm3 "))),
        F.when(p("p_size") % 6 == 0, "").otherwise(F.concat(F.lit("• 1"), size, F.lit(" KM "))), F.lit("• ąć "), "p_type")
    added = F.when(key % 3 == 0, "wczoraj").when(key % 3 == 1, F.concat(size, F.lit(" minut temu"))).otherwise("dawno")
    icon = '<svg class="i" viewbox="0 0 24 24"><path d="m1 2"></path></svg>'

    def named(name, *value):
        return F.concat(F.lit(f'<dt>\n {name}\n</dt><dd class="v" data-parameter="{name}">{icon}\n   '), *value, F.lit("\n  </dd>"))

    card = F.concat(
        F.lit('<article class="c" data-id="'), key, F.lit('" data-place="1"><section><div><img src="x.jpg"/></div><div>\n<h2 class="t">\n <a class="l" href="https://x.example/'),
        key, F.lit('" target="_self">\n  '), "p_name", F.lit('\n </a>\n</h2>\n<p class="d">\n '), line, F.lit("\n</p></div><div><dl>"),
        named("mileage", key % 90, F.lit(" 007 km")), named("fuel_type", F.lit("benzyna")), named("gearbox", "p_brand"),
        named("year", 2000 + p("p_size") % 20), F.lit('</dl><dl><dd class="w"><p>Place (Region)</p></dd>\n<dd class="w">\n<p class="a">Opublikowano '),
        added, F.lit('</p></dd></dl><article class="f"><ol></ol></article><h3 class="p">\n '), size, F.lit(" 000\n</h3></div></section></article>"))
    pages = table(spark, sf, "part").groupBy(F.floor(key / 20).alias("page")).agg(
        F.concat(F.lit("<html>"), F.array_join(F.collect_list(card), ""), F.lit("</html>")).alias("html"))
    # half of the pages arrive with their bytes read as Latin-1
    pages = pages.withColumn("html", F.when(p("page") % 2 == 0, F.decode(F.encode("html", "UTF-8"), "ISO-8859-1")).otherwise(p("html")))
    # landed in several files: a few large pages would lie in one task
    pages = staged(pages.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("page")), "pages")
    # parsed once: the rows are compared with the stored ids and appended to them
    parsed = staged(html.parse_listings(pages, "html", F.lit("2025-01-10 12:00:00").cast("timestamp_ntz")), "listings")
    stored = parsed.where("listing_id % 3 = 0")
    return reports.ingest_listings(parsed, stored)


@query("R10 A4 A5 A6 C15", """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, upper(o_orderpriority) AS vehicle_type,
           o_orderkey % 7 AS axles, 'T' || o_custkey AS tag, 'plaza' || (o_orderkey % 9) AS plaza,
           lpad(CAST(o_orderkey % 9999 AS VARCHAR), 4, '0') AS payment, 'c' || lpad(CAST(o_custkey % 99999 AS VARCHAR), 5, '0') AS vehicle_code FROM orders""")
def toll_consolidation(spark, sf):
    """Comma, tab and fixed-width slices of the same rows, joined line by line."""
    # ordered and written once, so that all slices meet the rows in one order
    orders = staged(table(spark, sf, "orders").orderBy("o_orderkey"), "ordered").withColumn("day", F.to_date("o_orderdate"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    comma, tab, fixed = (scratch_path(spark, f"toll_{n}") for n in ("csv", "tsv", "fixed"))
    delimited.write_delimited(orders.select("o_orderkey", "o_custkey", "day", F.lower("o_orderpriority"), "o_orderstatus", "o_totalprice"), comma)
    tabbed = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", (key % 7).alias("axles"),
                           F.concat(F.lit("T"), cust).alias("tag"), F.concat(F.lit("plaza"), key % 9).alias("plaza"))
    delimited.write_lines(tabbed, tab, end="\r")
    line = F.concat(F.rpad(F.concat_ws(" ", "o_orderstatus", "o_orderpriority"), 58, " "),
                    F.lpad((key % 9999).cast("string"), 4, "0"), F.lit("c"), F.lpad((cust % 99999).cast("string"), 5, "0"))
    orders.select(line.alias("value")).write.text(fixed)
    left = delimited.read_delimited(
        spark, comma, "o_orderkey bigint, o_custkey bigint, day date, vehicle_type string, status string, total double",
        columns=["o_orderkey", "o_custkey", "day", "vehicle_type"])
    middle = delimited.read_tab_fields(
        spark, tab, "a bigint, b bigint, c string, d double, axles bigint, tag string, plaza string", ["axles", "tag", "plaza"])
    right = delimited.read_fixed_width(spark, fixed, {"payment": (59, 4), "vehicle_code": (63, 6)})
    return delimited.zip_join(left, middle, right).withColumn("vehicle_type", ascii_upper("vehicle_type")).drop("line")


FILMS_SQL = """
    films AS (SELECT o_orderkey, o_orderdate AS released, o_totalprice AS budget, coalesce(round(g, 2), 0) AS worldwide,
                CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE coalesce(round(g / 2, 2), 0) END AS domestic
              FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS g FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


def _films(spark, sf):
    gross = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("g"))
    dollars = lambda c: F.concat(F.lit("$"), F.format_number(c, 2))
    joined = table(spark, sf, "orders").join(gross, "o_orderkey", "left")
    worldwide = F.coalesce(F.round("g", 2), F.lit(0.0))
    domestic = F.when(F.col("o_orderpriority") == "5-LOW", 0.0).otherwise(F.coalesce(F.round(F.col("g") / 2, 2), F.lit(0.0)))
    return joined.select(
        F.col("o_orderkey").alias("title"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("released"),
        dollars(F.col("o_totalprice")).alias("budget"), dollars(worldwide).alias("worldwide"), dollars(domestic).alias("domestic"))


@query("R11 H5 H16 H18", f"""
    WITH {FILMS_SQL}
    SELECT CASE WHEN year(released) <= 1998 THEN 'old' ELSE 'new' END AS era, CAST(year(released) // 10 * 10 AS INTEGER) AS decade, count(*) AS films,
           round(avg(CASE WHEN budget > worldwide THEN 1.0 ELSE 0.0 END), 6) AS loss_share, count(*) FILTER (WHERE worldwide = 0) AS zero_worldwide,
           count(*) FILTER (WHERE domestic = 0 AND worldwide > 0) AS international_only, round(avg(budget), 2) AS mean_budget, max(budget) AS top_budget
    FROM films GROUP BY 1, 2""")
def film_profitability(spark, sf):
    return reports.film_profitability(_films(spark, sf), 1998)


@query("R11", f"""
    WITH {FILMS_SQL} SELECT o_orderkey AS title, budget FROM films WHERE worldwide = 0 ORDER BY budget DESC, o_orderkey LIMIT 10""")
def dearest_zero_gross(spark, sf):
    facts = reports.film_facts(_films(spark, sf))
    return facts.where("worldwide = 0").select("title", "budget").orderBy(F.col("budget").desc(), "title").limit(10)


@query("R12", """
    WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS theme, coalesce(n, 0) AS parts FROM orders
               LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)
    SELECT year, count(*) AS sets, count(DISTINCT theme) AS themes, round(avg(parts), 6) AS mean_parts FROM s
    WHERE year < (SELECT max(year) - 1 FROM s) GROUP BY 1""")
def release_trend(spark, sf):
    trend = reports.release_trend(_sets(spark, sf), 2)
    return trend.withColumn("mean_parts", F.round("mean_parts", 6))


def _sets(spark, sf):
    parts = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf, "orders").join(parts, "o_orderkey", "left").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("theme"), F.coalesce("n", F.lit(0)).alias("parts"))


@query("R12 F2", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, n AS parts FROM orders
    JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey ORDER BY n DESC, o_orderkey LIMIT 5""")
def largest_sets(spark, sf):
    return _sets(spark, sf).select("o_orderkey", "year", "parts").orderBy(F.col("parts").desc(), "o_orderkey").limit(5)
