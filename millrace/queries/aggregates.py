"""Grouped and global aggregates, profiles, calendar answers."""

from pyspark.sql import functions as F

from millrace.operators import aggregates as ops
from millrace.operators.relational import in_year
from millrace.plans import stocks, weather
from millrace.registry import query


def rounded(df, digits=6):
    """Doubles rounded, so that the order of summation does not show."""
    return df.select([F.round(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


@query(
    "agg_global",
    """SELECT round(sum(o_totalprice), 2) AS sum_o_totalprice, max(o_totalprice) AS max_o_totalprice,
              min(o_totalprice) AS min_o_totalprice FROM orders""",
)
def agg_global(t):
    return rounded(ops.aggregate(t.orders, {"o_totalprice": ["sum", "max", "min"]}), 2)


def _group_all_sql(function, name):
    columns = ", ".join(
        f"round(CAST({function}({c}) AS {kind}), 6) AS {name}_{c}" if kind == "DOUBLE"
        else f"CAST({function}({c}) AS {kind}) AS {name}_{c}"
        for c, kind in (
            ("c_custkey", "BIGINT" if function in ("max", "min", "sum") else "DOUBLE"),
            ("c_nationkey", {"max": "INTEGER", "min": "INTEGER", "sum": "BIGINT"}.get(function, "DOUBLE")),
            ("c_acctbal", "DOUBLE"),
        )
    )
    return f"SELECT c_mktsegment, {columns} FROM customer GROUP BY c_mktsegment"


def _group_all(name, function):
    @query(name, _group_all_sql(function, function))
    def build(t):
        return rounded(ops.group_all(t.customer, ["c_mktsegment"], function))


for _name, _function in (
    ("group_mean_all", "avg"),
    ("group_max_all", "max"),
    ("group_min_all", "min"),
    ("group_sum_all", "sum"),
):
    _group_all(_name, _function)


@query("group_count", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority")
def group_count(t):
    return ops.group_count(t.orders, "o_orderpriority")


@query(
    "group_agg_dict",
    """SELECT l_returnflag, l_linestatus, max(l_extendedprice) AS max_l_extendedprice,
              round(avg(l_quantity), 6) AS avg_l_quantity, count(*) AS count,
              CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def group_agg_dict(t):
    spec = {"l_extendedprice": "max", "l_quantity": "avg", "*": "count", "l_linenumber": "sum"}
    return rounded(ops.aggregate(t.lineitem, spec, ["l_returnflag", "l_linestatus"]))


@query(
    "group_count_nonnull",
    """SELECT age, count(age) AS count FROM
         (SELECT CASE WHEN p_size % 10 <> 0 THEN p_size END AS age FROM part) GROUP BY age""",
)
def group_count_nonnull(t):
    gaps = t.part.select(F.when(F.col("p_size") % 10 != 0, F.col("p_size")).alias("age"))
    return ops.group_count_nonnull(gaps, "age")


@query(
    "count_distinct",
    """SELECT count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts,
              count(DISTINCT CASE WHEN l_quantity > 40 THEN l_partkey END) AS bulk_parts FROM lineitem""",
)
def count_distinct(t):
    bulk = F.when(F.col("l_quantity") > 40, F.col("l_partkey"))
    return t.lineitem.agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct(bulk).alias("bulk_parts"),
    )


@query(
    "global_stats",
    """SELECT round(avg(o_totalprice), 6) AS avg_o_totalprice, round(stddev_samp(o_totalprice), 6) AS stddev_o_totalprice,
              max(o_totalprice) AS max_o_totalprice, min(o_totalprice) AS min_o_totalprice FROM orders""",
)
def global_stats(t):
    return rounded(ops.aggregate(t.orders, {"o_totalprice": ["avg", "stddev", "max", "min"]}))


@query("corr_pair", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def corr_pair(t):
    return rounded(t.lineitem.agg(F.corr("l_quantity", "l_extendedprice").alias("corr")))


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem" for a in _CORR for b in _CORR
    ),
)
def corr_matrix(t):
    matrix = ops.corr_matrix(t.lineitem, _CORR)
    return matrix.select("x", "y", (F.round("corr", 6) + 0.0).alias("corr"))


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
_PROFILE_SQL = """SELECT '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 6) AS mean,
    round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max{more}
    FROM lineitem"""


@query("profile_columns", " UNION ALL ".join(_PROFILE_SQL.format(c=c, more="") for c in _PROFILED))
def profile_columns(t):
    return rounded(ops.profile(t.lineitem, _PROFILED))


def _formatted_sql():
    def cell(column, statistic, whole):
        value = {"count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "stddev": "stddev_samp({c})",
                 "min": "CAST(min({c}) AS DOUBLE)", "max": "CAST(max({c}) AS DOUBLE)"}[statistic].format(c=column)
        if whole:
            return f"CAST(CAST(trunc({value}) AS BIGINT) AS VARCHAR) AS {column}"
        return f"format('{{:,.2f}}', CAST(CAST({value} AS FLOAT) AS DOUBLE)) AS {column}"

    rows = [
        f"SELECT '{s}' AS summary, {cell('o_totalprice', s, False)}, {cell('o_custkey', s, True)} FROM orders"
        for s in ("count", "mean", "stddev", "min", "max")
    ]
    return " UNION ALL ".join(rows)


@query("profile_formatted", _formatted_sql())
def profile_formatted(t):
    return ops.profile_formatted(t.orders, ["o_totalprice", "o_custkey"], whole=["o_custkey"])


@query(
    "profile_quartiles",
    " UNION ALL ".join(
        _PROFILE_SQL.format(
            c=c,
            more="".join(
                f", round(CAST(quantile_cont({c}, {p}) AS DOUBLE), 6) AS {n}"
                for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            ).replace("{c}", c),
        )
        for c in _PROFILED
    ),
)
def profile_quartiles(t):
    return rounded(ops.profile_quartiles(t.lineitem, _PROFILED))


@query("percent_rows", "SELECT round(100.0 * count(*) FILTER (o_totalprice > 400000) / count(*), 6) AS percent FROM orders")
def percent_rows(t):
    return rounded(ops.percent_rows(t.orders, F.col("o_totalprice") > 400000))


@query("filtered_count", "SELECT count(*) AS count FROM orders WHERE o_totalprice < 60000")
def filtered_count(t):
    return ops.filtered_count(t.orders, "o_totalprice < 60000")


# --- calendar answers ----------------------------------------------------------

@query(
    "year_mean",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, format('{:,.2f}', avg(o_totalprice)) AS mean
       FROM orders GROUP BY ALL""",
)
def year_mean(t):
    return stocks.by_year(t.orders, "o_orderdate", F.format_number(F.avg("o_totalprice"), 2).alias("mean"))


@query(
    "year_max_all",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, max(o_totalprice) AS max FROM orders GROUP BY ALL",
)
def year_max_all(t):
    return stocks.by_year(t.orders, "o_orderdate", F.max("o_totalprice").alias("max"))


@query(
    "month_mean",
    "SELECT CAST(month(o_orderdate) AS INTEGER) AS month, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY ALL",
)
def month_mean(t):
    return rounded(stocks.by_month(t.orders, "o_orderdate", F.avg("o_totalprice").alias("mean")))


def _readings(t, year):
    """Shipments of one year as daily readings; the range on the date reaches the scan."""
    return t.lineitem.filter(in_year("l_shipdate", year)).select(
        F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("Month"), F.col("l_quantity").alias("MeanTemp")
    )


@query("year_rounded_mean", "SELECT round(avg(l_quantity), 1) AS MeanTemp FROM lineitem WHERE year(l_shipdate) = 1997")
def year_rounded_mean(t):
    return weather.year_mean(_readings(t, 1997), 1997)


@query("year_max", "SELECT max(l_quantity) AS MeanTemp FROM lineitem WHERE year(l_shipdate) = 1997")
def year_max(t):
    return weather.year_max(_readings(t, 1997), 1997, "MeanTemp")


@query("year_min", "SELECT min(l_quantity) AS MeanTemp FROM lineitem WHERE year(l_shipdate) = 1997")
def year_min(t):
    return weather.year_min(_readings(t, 1997), 1997, "MeanTemp")


@query(
    "monthly_mean",
    """SELECT CAST(month(l_shipdate) AS INTEGER) AS "Month", round(avg(l_quantity), 1) AS MeanTemp
       FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY ALL""",
)
def monthly_mean(t):
    return weather.monthly_mean(_readings(t, 1997), 1997)


@query(
    "mean_text_length",
    "SELECT lang, round(avg(length(text)), 6) AS avg_length FROM documents GROUP BY lang",
)
def mean_text_length(t):
    lengths = t.documents.select("lang", F.length("text").alias("length"))
    return rounded(ops.group_all(lengths, ["lang"], "avg"))
