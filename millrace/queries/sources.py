"""Scans, sinks and staging. Files go through the shared folder."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators.features import assemble
from millrace.registry import query
from millrace.sources import files, sinks
from millrace.workspace import fresh_path

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


@query("csv_roundtrip_scan", "SELECT * FROM customer")
def csv_roundtrip_scan(t):
    path = fresh_path(t.spark, "customer-csv")
    sinks.sink_csv(t.customer, path)
    return files.scan_csv(t.spark, path, CUSTOMER)


@query("csv_inferred_scan", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_inferred_scan(t):
    """Types are inferred from the file: whole numbers that fit are int."""
    path = fresh_path(t.spark, "supplier-csv")
    sinks.sink_csv(t.supplier, path)
    return files.scan_csv(t.spark, path)


@query(
    "tsv_scan",
    "SELECT CAST(item_id AS VARCHAR) AS id, translate(text, chr(9) || chr(13) || chr(10), '   ') AS text FROM benchmark",
)
def tsv_scan(t):
    path = fresh_path(t.spark, "benchmark-tsv")
    sinks.sink_tsv(t.benchmark, path)
    return files.scan_tsv(t.spark, path, ["id", "text"])


@query("preamble_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def preamble_scan(t):
    """Every file of the table gets two title lines and a header before its rows."""
    path = fresh_path(t.spark, "supplier-preamble")
    heads = ["Supplier list", "exported for a test of the scan", "s_suppkey,s_name,s_nationkey,s_acctbal"]
    rows = t.supplier.select("s_suppkey", F.to_csv(F.struct("s_suppkey", "s_name", "s_nationkey", "s_acctbal")).alias("value"))
    top = t.spark.createDataFrame([(i, line) for i, line in enumerate(heads)], "line int, value string")
    for part in range(2):  # two files
        own = rows.filter(F.pmod("s_suppkey", F.lit(2)) == part).select(F.lit(len(heads)).alias("line"), "value")
        top.unionAll(own).repartition(1).sortWithinPartitions("line").select("value").write.mode("append").text(path)
    schema = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    return files.scan_csv_skip(t.spark, path, 2, schema)


@query("json_scan", "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def json_scan(t):
    path = fresh_path(t.spark, "customer-json")
    sinks.sink_json(t.customer, path)
    return files.scan_json(t.spark, path)


@query("json_scan_schema", "SELECT CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS c_nationkey, c_name FROM customer")
def json_scan_schema(t):
    """Absent keys read as null."""
    path = fresh_path(t.spark, "people-json")
    sinks.sink_json(
        t.customer.select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"), "c_name"),
        path,
    )
    return files.scan_json(t.spark, path, "c_nationkey INT, c_name STRING")


@query(
    "libsvm_roundtrip",
    "SELECT l_quantity AS label, l_extendedprice AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
)
def libsvm_roundtrip(t):
    path = fresh_path(t.spark, "lineitem-libsvm")
    columns = ["l_extendedprice", "l_discount", "l_tax"]
    data = assemble(t.lineitem.select("l_quantity", *columns), columns).withColumnRenamed("l_quantity", "label")
    sinks.sink_libsvm(data, path)
    part = vector_to_array(F.col("features"))
    return files.scan_libsvm(t.spark, path, 3).select("label", *[part[i].alias(f"f{i}") for i in range(3)])


@query(
    "coerce_long",
    """SELECT c_custkey,
              CAST(trunc(CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_acctbal END) AS BIGINT) AS balance,
              CASE WHEN c_custkey % 11 = 0 THEN CAST(0 AS BIGINT) ELSE c_custkey END AS code
       FROM customer""",
)
def coerce_long(t):
    """Missing and unreadable values become 0; fractions are cut."""
    raw = t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("c_custkey").cast("string")).alias("code"),
    )
    return files.coerce(raw, {"balance": "bigint", "code": "bigint"})


_AREAS = [(0, "south"), (1, "west"), (2, "east"), (9, "nowhere")]


@query(
    "literal_rows",
    f"SELECT n_name, area FROM nation JOIN (VALUES {', '.join(f'({k}, {a!r})' for k, a in _AREAS)}) v(k, area) ON n_regionkey = k",
)
def literal_rows(t):
    """Nations with a name for their region from literal rows."""
    areas = files.from_rows(t.spark, _AREAS, "n_regionkey int, area string")
    return t.nation.join(areas, "n_regionkey").select("n_name", "area")


@query("glob_union", "SELECT * FROM orders")
def glob_union(t):
    """Files of two layouts (columns in another order) appended by name."""
    root = fresh_path(t.spark, "orders-layouts")
    late = F.year("o_orderdate") >= 1998
    reordered = "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_orderkey BIGINT, o_custkey BIGINT, " \
                "o_orderstatus STRING, o_totalprice DOUBLE"
    orders = t.orders
    sinks.sink_csv(orders.filter(~late), f"{root}/a")
    sinks.sink_csv(
        orders.filter(late).select("o_orderdate", "o_orderpriority", "o_orderkey", "o_custkey",
                                   "o_orderstatus", "o_totalprice"),
        f"{root}/b",
    )
    return files.scan_layouts(t.spark, {f"{root}/a/*.csv": ORDERS, f"{root}/b/*.csv": reordered})


@query("lit_column", "SELECT s_suppkey, s_name, CAST(31688 AS INTEGER) AS station_id FROM supplier")
def lit_column(t):
    return files.with_source_key(t.supplier.select("s_suppkey", "s_name"), "station_id", 31688)


@query(
    "partitioned_sink",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders",
)
def partitioned_sink(t):
    path = fresh_path(t.spark, "orders-by-year")
    table = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    sinks.sink_partitioned(table, path, ["order_year"])
    return files.scan_csv(t.spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, order_year INT")


@query(
    "export_by_year",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year
       FROM orders WHERE year(o_orderdate) IN (1998, 1997, 1996)""",
)
def export_by_year(t):
    path = fresh_path(t.spark, "orders-export")
    table = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    sinks.sink_by_year(table, path, [1998, 1997, 1996], "order_year")
    return files.scan_csv(t.spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, order_year INT")


@query(
    "staged_view",
    """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total
       FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority""",
)
def staged_view(t):
    """Two stages, the second reading the first by name."""
    sinks.register_view(t.orders, "millrace_orders")
    sinks.stage(t.spark, "millrace_settled", "SELECT * FROM millrace_orders WHERE o_orderstatus <> 'P'")
    return sinks.stage(
        t.spark,
        "millrace_by_priority",
        """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total
           FROM millrace_settled GROUP BY o_orderpriority""",
    )


@query("sql_select_all", "SELECT * FROM supplier")
def sql_select_all(t):
    sinks.drop_view(t.spark, "millrace_supplier")
    sinks.register_view(t.supplier, "millrace_supplier", replace=False)
    return t.spark.sql("SELECT * FROM millrace_supplier")


@query(
    "range_map_filter",
    """SELECT r - 1 AS id FROM range(1, (SELECT max(o_orderkey) FROM orders)) AS x(r)
       WHERE (r - 1) % 10 < 9""",
)
def range_map_filter(t):
    """Whole numbers up to the highest order key, minus one, those below 9 modulo 10."""
    end = t.orders.agg(F.max("o_orderkey")).first()[0] or 1
    mapped = files.range_source(t.spark, 1, end).select((F.col("id") - 1).alias("id"))
    return mapped.filter(F.col("id") % 10 < 9)
