"""Joins of facts with dimensions."""

from pyspark.sql import functions as F

from millrace.operators import relational as ops
from millrace.registry import query


@query(
    "join_inner_using",
    "SELECT o_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner_using(t):
    orders = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return ops.join_on(orders, customers, "custkey")


@query(
    "join_matched_only",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)
def join_matched_only(t):
    big = t.orders.filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return ops.matched_only(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


def _located(df, key, name):
    """Coordinates standing in for a place: near the cell of its nation number modulo 5."""
    nation = F.col(key)
    return df.select(
        name,
        ops.grid_key((nation % 5) * 1.5 + 0.2 + nation * 0.001, (nation % 5) * -2.5 - 0.3 - nation * 0.001).alias("cell"),
    )


_CELL = (
    "translate(CAST(round(({k} % 5) * 1.5::DOUBLE + 0.2::DOUBLE + {k} * 0.001::DOUBLE, 1) AS VARCHAR) || "
    "CAST(round(({k} % 5) * -2.5::DOUBLE - 0.3::DOUBLE - {k} * 0.001::DOUBLE, 1) AS VARCHAR), '-.', 'XZ')"
)


@query(
    "join_grid_fanout",
    f"""SELECT cell, c_custkey, n_name FROM
          (SELECT c_custkey, {_CELL.format(k='c_nationkey')} AS cell FROM customer)
          JOIN (SELECT n_name, {_CELL.format(k='n_nationkey')} AS cell FROM nation) USING (cell)""",
)
def join_grid_fanout(t):
    """Each customer once for every nation name in its grid cell: linear in customers."""
    customers = _located(t.customer, "c_nationkey", "c_custkey")
    places = _located(t.nation, "n_nationkey", "n_name")
    return ops.enrich(customers, places, ["cell"])


@query(
    "denormalize_star",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, o_orderdate, o_totalprice, c_custkey, c_name,
              n_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey""",
)
def denormalize_star(t):
    """The dimensions meet the orders first, so the large fact is shuffled once, on its order key."""
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "n_name"
    )
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "o_totalprice", "c_custkey", "c_name", "n_name"
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query(
    "dimension_chain",
    """SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN
         (SELECT n_nationkey FROM nation WHERE n_regionkey =
            (SELECT r_regionkey FROM region WHERE r_name ILIKE '%asi%' ORDER BY r_name, r_regionkey LIMIT 1))""",
)
def dimension_chain(t):
    """Region name to its code, code to nations, nations to suppliers; nothing leaves the plan."""
    code = ops.first_value(t.region.filter(F.col("r_name").ilike("%asi%")), "r_regionkey", "r_name")
    nations = t.nation.filter(F.col("n_regionkey") == code).select(F.col("n_nationkey").alias("s_nationkey"))
    return ops.matched_only(t.supplier, nations, ["s_nationkey"]).select("s_suppkey", "s_name")
