"""Projections, predicates, sorts and top-k."""

from pyspark.sql import functions as F

from millrace.functions.text import term_counts, words
from millrace.operators import relational as ops
from millrace.registry import query
from millrace.sources.files import union_all
from millrace.sources.sinks import register_view

@query("project_columns", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def project_columns(t):
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")


@query("sql_star_plus_expr", "SELECT *, p_retailprice * 2 AS double_price, p_size + 1 AS next_size FROM part")
def sql_star_plus_expr(t):
    register_view(t.part, "millrace_part")
    return t.spark.sql("SELECT *, p_retailprice * 2 AS double_price, p_size + 1 AS next_size FROM millrace_part")


@query(
    "derive_arith",
    """SELECT l_orderkey, l_linenumber, l_quantity AS copy, l_quantity * 2 AS doubled, l_quantity + 1 AS plus_one,
              l_linenumber / 2 AS half, l_quantity * CAST(0.45 AS DOUBLE) AS metric,
              l_quantity * CAST(0.425 AS DOUBLE) AS metric2 FROM lineitem""",
)
def derive_arith(t):
    q = F.col("l_quantity")
    return ops.derive(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"),
        {
            "copy": q,
            "doubled": q * 2,
            "plus_one": q + 1,
            "half": F.col("l_linenumber") / 2,
            "metric": q * 0.45,
            "metric2": q * 0.425,
        },
    ).drop("l_quantity")


@query("rename_map", "SELECT s_suppkey AS StationID, s_name AS StationName, s_nationkey, s_acctbal AS MaxTemp FROM supplier")
def rename_map(t):
    return ops.rename(
        t.supplier,
        {"s_suppkey": "StationID", "s_name": "StationName", "s_acctbal": "MaxTemp", "not there": "Ignored"},
    )


@query("filter_sql_string", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000")
def filter_sql_string(t):
    return t.orders.filter("o_totalprice < 50000").select("o_orderkey", "o_totalprice")


@query("filter_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 400000")
def filter_compare(t):
    return t.orders.where(F.col("o_totalprice") >= 400000).select("o_orderkey", "o_totalprice")


@query("filter_equal", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_suppkey = 7")
def filter_equal(t):
    return t.lineitem.filter(F.col("l_suppkey") == 7).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("filter_and", "SELECT o_orderkey FROM orders WHERE o_totalprice < 200000 AND o_orderstatus = 'F'")
def filter_and(t):
    return t.orders.filter((F.col("o_totalprice") < 200000) & (F.col("o_orderstatus") == "F")).select("o_orderkey")


@query("filter_or", "SELECT o_orderkey FROM orders WHERE o_totalprice < 20000 OR o_orderstatus = 'P'")
def filter_or(t):
    return t.orders.filter((F.col("o_totalprice") < 20000) | (F.col("o_orderstatus") == "P")).select("o_orderkey")


@query("filter_not", "SELECT o_orderkey FROM orders WHERE o_totalprice < 200000 AND NOT (o_orderstatus = 'F')")
def filter_not(t):
    return t.orders.filter((F.col("o_totalprice") < 200000) & ~(F.col("o_orderstatus") == "F")).select("o_orderkey")


@query("filter_like_prefix", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'ECON%'")
def filter_like_prefix(t):
    return t.part.filter(F.startswith(F.col("p_type"), F.lit("ECON"))).select("p_partkey", "p_type")


@query("filter_ilike", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%OREA%'")
def filter_ilike(t):
    return t.documents.filter(F.col("text").ilike("%OREA%")).select("doc_id", "lang")


@query("filter_not_equal", "SELECT c_custkey FROM customer WHERE CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END <> 'MACHINERY'")
def filter_not_equal(t):
    """A null segment is neither equal nor unequal, so its row goes."""
    segment = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    return t.customer.filter(segment != "MACHINERY").select("c_custkey")


@query(
    "complete_rows",
    "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0",
)
def complete_rows(t):
    gaps = t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return ops.complete_rows(gaps, ["c_acctbal", "c_mktsegment"])


@query("column_ratio", "SELECT o_orderkey, o_totalprice / nullif(o_custkey, 0) AS ratio FROM orders")
def column_ratio(t):
    return t.orders.select("o_orderkey", ops.ratio(F.col("o_totalprice"), F.col("o_custkey")).alias("ratio"))


@query(
    "percent_text",
    """SELECT l_orderkey, l_linenumber,
              format('{:,.2f}', l_tax / nullif(CASE WHEN l_orderkey % 10 = 0 THEN 0 ELSE l_discount END, 0) * 100) || '%'
                AS share
       FROM lineitem""",
)
def percent_text(t):
    base = F.when(F.col("l_orderkey") % 10 == 0, 0.0).otherwise(F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", ops.percent_text(F.col("l_tax"), base).alias("share"))


@query("null_above", "SELECT p_partkey, CASE WHEN p_size <= 31 THEN p_size END AS meal FROM part")
def null_above(t):
    return t.part.select("p_partkey", ops.null_above(F.col("p_size"), 31).alias("meal"))


@query(
    "code_lookup",
    """SELECT s_suppkey, CASE WHEN s_nationkey > 20 THEN 'elsewhere' ELSE n_name END AS nation_name
       FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def code_lookup(t):
    """Names of nation codes; codes above 20 are taken for missing."""
    coded = t.supplier.select("s_suppkey", ops.null_above(F.col("s_nationkey"), 20).alias("nation"))
    names = t.nation.select("n_nationkey", "n_name")
    return ops.map_codes(coded, "nation", names, "nation_name", missing="elsewhere").drop("nation")


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "grid_key",
    """SELECT c_custkey, translate(
                CAST(CAST(round(CAST(c_acctbal AS DECIMAL(18, 2)), 1) AS DOUBLE) + 0.0 AS VARCHAR)
                || CAST(CAST(-(c_custkey % 180) AS DOUBLE) + 0.0 AS VARCHAR), '-.', 'XZ') AS cell
       FROM customer""",
)
def grid_key(t):
    return t.customer.select(
        "c_custkey", ops.grid_key(F.col("c_acctbal"), -(F.col("c_custkey") % 180).cast("double") + 0.0).alias("cell")
    )


# --- sorts and top-k ---------------------------------------------------------

@query("sort_asc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def sort_asc(t):
    return ops.first_n(t.orders.select("o_orderkey", "o_totalprice"), 50, "o_totalprice", "o_orderkey")


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def sort_desc(t):
    return ops.first_n(t.orders.select("o_orderkey", "o_totalprice"), 50, F.col("o_totalprice").desc(), "o_orderkey")


@query("sort_by_agg", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey ORDER BY orders DESC, o_custkey LIMIT 20")
def sort_by_agg(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return ops.first_n(counts, 20, F.col("orders").desc(), "o_custkey")


@query(
    "derive_then_sort",
    """SELECT p_partkey, p_retailprice, p_retailprice * CAST(0.425 AS DOUBLE) AS scaled
       FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25""",
)
def derive_then_sort(t):
    derived = ops.derive(t.part.select("p_partkey", "p_retailprice"), {"scaled": F.col("p_retailprice") * 0.425})
    return ops.first_n(derived, 25, F.col("p_retailprice").desc(), "p_partkey")


@query("first_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def first_n(t):
    return ops.first_n(t.orders, 5, "o_orderkey")


@query(
    "argmax_row",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
)
def argmax_row(t):
    return ops.argmax_row(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), "o_totalprice", "o_orderkey")


@query(
    "top_k_tokens",
    r"""SELECT word, count(*) AS count FROM
          (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM documents)
        GROUP BY word ORDER BY count DESC, word LIMIT 10""",
)
def top_k_tokens(t):
    counts = term_counts(t.documents.select("text"), words(F.col("text")), "word")
    return ops.first_n(counts, 10, F.col("count").desc(), "word")


@query(
    "top_n_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM
         (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
          FROM orders) WHERE rank <= 3""",
)
def top_n_per_group(t):
    table = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return ops.top_n_per_group(table, ["o_custkey"], 3, F.col("o_totalprice").desc(), "o_orderkey")


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def union_by_name(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return union_all([customers, suppliers])
