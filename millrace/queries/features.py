"""Feature columns."""

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from millrace.operators import features as ops
from millrace.registry import query

_INDEX = """SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS segment_index
            FROM customer GROUP BY c_mktsegment"""


@query(
    "string_index",
    f"SELECT c_custkey, c_mktsegment, segment_index FROM customer JOIN ({_INDEX}) USING (c_mktsegment)",
)
def string_index(t):
    return ops.index_category(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment_index")


@query(
    "one_hot",
    f"""SELECT c_custkey, {", ".join(f"CAST(segment_index = {i} AS INTEGER)::DOUBLE AS is_{i}" for i in range(4))}
        FROM customer JOIN ({_INDEX}) USING (c_mktsegment)""",
)
def one_hot(t):
    indexed = ops.index_category(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment_index")
    encoded = ops.one_hot(indexed, "segment_index", "segment_vector")
    return ops.vector_columns(encoded, "segment_vector", [f"is_{i}" for i in range(4)]).select(
        "c_custkey", *[f"is_{i}" for i in range(4)]
    )


@query(
    "assemble_vector",
    "SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2 FROM lineitem",
)
def assemble_vector(t):
    table = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    vectors = ops.assemble(table, ["l_quantity", "l_extendedprice", "l_discount"], "v")
    return ops.vector_columns(vectors, "v", ["f0", "f1", "f2"]).select("l_orderkey", "l_linenumber", "f0", "f1", "f2")


@query(
    "standard_scale",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS f0,
              round(l_tax / (SELECT stddev_samp(l_tax) FROM lineitem), 6) AS f1 FROM lineitem""",
)
def standard_scale(t):
    vectors = ops.assemble(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"), ["l_quantity", "l_tax"])
    scaled = ops.vector_columns(ops.scale(vectors), "scaled", ["f0", "f1"])
    return scaled.select("l_orderkey", "l_linenumber", F.round("f0", 6).alias("f0"), F.round("f1", 6).alias("f1"))


@query(
    "key_split",
    "SELECT CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS part, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL",
)
def key_split(t):
    train, test = ops.key_split(t.orders, "o_orderkey")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "random_split",
    "SELECT count(*) AS rows, round(sum(o_totalprice), 2) AS total, CAST(0 AS BIGINT) AS shared, true AS near FROM orders",
)
def random_split(t):
    """A seeded random split: its parts have every row once, and about their shares of them."""
    train, test = ops.random_split(t.orders.select("o_orderkey", "o_totalprice"), [0.7, 0.3], seed=11)
    both = train.withColumn("train", F.lit(1)).unionByName(test.withColumn("train", F.lit(0)))
    by_key = both.groupBy("o_orderkey").agg(F.sum("o_totalprice").alias("total"), F.sum("train").alias("train"), F.count(F.lit(1)).alias("n"))
    return by_key.agg(
        F.sum("n").alias("rows"), F.round(F.sum("total"), 2).alias("total"),
        F.count_if(F.col("train").between(1, F.col("n") - 1)).alias("shared"), (F.abs(F.sum("train") / F.sum("n") - 0.7) < 0.05).alias("near"),
    )


_SCALED = ", ".join(
    f"round({x} / (SELECT stddev_samp({x}) FROM coded), 6) AS s{i}"
    for i, x in enumerate(["is_0", "is_1", "is_2", "is_3", "c_acctbal", "c_nationkey"])
)


@query(
    "chained_features",
    f"""WITH coded AS (SELECT c_custkey, c_acctbal, c_nationkey,
                         {", ".join(f"CAST(segment_index = {i} AS INTEGER)::DOUBLE AS is_{i}" for i in range(4))}
                       FROM customer JOIN ({_INDEX}) USING (c_mktsegment))
        SELECT c_custkey, {_SCALED} FROM coded""",
)
def chained_features(t):
    """Index, encode, assemble and scale as one fitted chain."""
    stages = [
        StringIndexer(inputCol="c_mktsegment", outputCol="segment_index"),
        OneHotEncoder(inputCols=["segment_index"], outputCols=["segment_vector"]),
        VectorAssembler(inputCols=["segment_vector", "c_acctbal", "c_nationkey"], outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled"),
    ]
    table = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    names = [f"s{i}" for i in range(6)]
    scaled = ops.vector_columns(ops.fit_stages(table, stages).transform(table), "scaled", names)
    return scaled.select("c_custkey", *[F.round(n, 6).alias(n) for n in names])


@query(
    "vector_index",
    """SELECT l_orderkey, l_linenumber, l_extendedprice AS price,
              CAST(dense_rank() OVER (ORDER BY l_discount) - 1 AS DOUBLE) AS discount,
              CAST(dense_rank() OVER (ORDER BY l_tax) - 1 AS DOUBLE) AS tax FROM lineitem""",
)
def vector_index(t):
    """Discounts and taxes have few values and become category indices; prices stay numbers."""
    vectors = ops.assemble(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_extendedprice"),
        ["l_discount", "l_tax", "l_extendedprice"],
    )
    indexed = ops.index_vector(vectors, "features", "indexed", 16)
    return ops.vector_columns(indexed, "indexed", ["discount", "tax", "price"]).select(
        "l_orderkey", "l_linenumber", "price", "discount", "tax"
    )
