"""Missing data and quality checks. The tables hold no nulls, so some are put in on both sides."""

from pyspark.sql import functions as F

from millrace.operators import quality as ops
from millrace.queries.aggregates import rounded
from millrace.registry import query

_GAPS = """(SELECT c_custkey AS key,
        CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS name,
        CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment,
        CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance,
        CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS nation FROM customer)"""


def gaps(t):
    """Customers with a null name in every third row, segment in every fifth, and so on."""

    def some(column, every):
        return F.when(F.col("c_custkey") % every != 0, F.col(column))

    return t.customer.select(
        F.col("c_custkey").alias("key"),
        some("c_name", 3).alias("name"),
        some("c_mktsegment", 5).alias("segment"),
        some("c_acctbal", 7).alias("balance"),
        some("c_nationkey", 4).alias("nation"),
    )


@query(
    "drop_any_null",
    f"SELECT * FROM {_GAPS} WHERE name IS NOT NULL AND segment IS NOT NULL AND balance IS NOT NULL AND nation IS NOT NULL",
)
def drop_any_null(t):
    return ops.drop_nulls(gaps(t))


@query(
    "drop_all_null",
    f"SELECT name, segment, balance FROM {_GAPS} WHERE name IS NOT NULL OR segment IS NOT NULL OR balance IS NOT NULL",
)
def drop_all_null(t):
    return ops.drop_nulls(gaps(t).select("name", "segment", "balance"), "all")


@query(
    "drop_thresh",
    f"""SELECT name, segment, balance FROM {_GAPS}
        WHERE (name IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT >= 2""",
)
def drop_thresh(t):
    return ops.drop_nulls(gaps(t).select("name", "segment", "balance"), at_least=2)


@query("drop_subset", f"SELECT * FROM {_GAPS} WHERE balance IS NOT NULL")
def drop_subset(t):
    return ops.drop_nulls(gaps(t), subset=["balance"])


@query(
    "fill_text",
    f"SELECT key, coalesce(name, 'FILL') AS name, coalesce(segment, 'FILL') AS segment, balance, nation FROM {_GAPS}",
)
def fill_text(t):
    return ops.fill(gaps(t), "FILL")


@query(
    "fill_number",
    f"SELECT key, name, segment, coalesce(balance, 0) AS balance, coalesce(nation, 0) AS nation FROM {_GAPS}",
)
def fill_number(t):
    return ops.fill(gaps(t), 0)


@query("fill_subset", f"SELECT key, coalesce(name, 'No Name') AS name, segment, balance, nation FROM {_GAPS}")
def fill_subset(t):
    return ops.fill(gaps(t), "No Name", ["name"])


@query(
    "fill_dict",
    f"SELECT key, coalesce(name, 'unknown') AS name, segment, coalesce(balance, 50) AS balance, nation FROM {_GAPS}",
)
def fill_dict(t):
    return ops.fill(gaps(t), {"name": "unknown", "balance": 50})


@query(
    "fill_mean",
    f"""SELECT key, round(coalesce(CAST(nation AS DOUBLE), (SELECT avg(nation) FROM {_GAPS})), 6) AS nation,
               round(coalesce(balance, (SELECT avg(balance) FROM {_GAPS})), 6) AS balance FROM {_GAPS}""",
)
def fill_mean(t):
    table = gaps(t).select("key", "nation", "balance")
    return rounded(ops.fill_mean(table, "nation", "balance"))


@query(
    "duplicate_count",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM
         (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority)""",
)
def duplicate_count(t):
    return ops.duplicate_count(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {_GAPS}"
        for c in ("key", "name", "segment", "balance", "nation")
    ),
)
def null_counts(t):
    return ops.null_counts(gaps(t))


def _report_sql(name, source, columns):
    listed = ", ".join(columns)
    rows = [
        f"SELECT '{name}' AS \"table\", 'rows' AS \"check\", '' AS \"column\", count(*) AS value FROM {source}",
        f"SELECT '{name}', 'duplicates', '', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {listed})",
    ]
    rows += [f"SELECT '{name}', 'nulls', '{c}', count(*) - count({c}) FROM {source}" for c in columns]
    return " UNION ALL ".join(rows)


@query(
    "quality_report",
    " UNION ALL ".join(
        (
            _report_sql("weather", "(SELECT segment, nation FROM " + _GAPS + ")", ["segment", "nation"]),
            _report_sql("stations", "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]),
            _report_sql("geonames", "nation", ["n_nationkey", "n_name", "n_regionkey"]),
        )
    ),
)
def quality_report(t):
    return ops.quality_report(
        {"weather": gaps(t).select("segment", "nation"), "stations": t.supplier, "geonames": t.nation}
    )
