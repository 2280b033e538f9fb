import csv
import io
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.sources import files, sinks
from millrace.workspace import fresh_path, materialize, shared_root


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_inferred_and_declared(spark, tmp_path):
    path = write(tmp_path / "sales.csv", "Company,Person,Sales\nGOOG,Sam,200\nAPPL, Chris, 350\n")
    inferred = files.scan_csv(spark, path)
    assert inferred.columns == ["Company", "Person", "Sales"]
    trimmed = files.scan_csv(spark, path, "Company STRING, Person STRING, Sales DOUBLE", trim=True)
    assert rows(trimmed) == [("APPL", "Chris", 350.0), ("GOOG", "Sam", 200.0)]


def test_csv_keeps_short_and_long_rows(spark, tmp_path):
    path = write(tmp_path / "c.csv", "Names,Age\nAndrew,37.0,\nMichelle\n")
    assert rows(files.scan_csv(spark, path, "Names STRING, Age DOUBLE")) == [("Andrew", 37.0), ("Michelle", None)]


def test_tsv_leaves_quotes_alone(spark, tmp_path):
    path = write(tmp_path / "sms", 'ham\tsaid "hi\nspam\t"win" now\n')
    assert rows(files.scan_tsv(spark, path, ["class", "text"])) == [("ham", 'said "hi'), ("spam", '"win" now')]


def test_preamble_in_many_files(spark, tmp_path):
    for i in range(5):
        body = "".join(f'{i * 100 + j},"name, {j}"\n' for j in range(50))
        write(tmp_path / "s" / f"part{i}.csv", f"Modified: today\n\nid,label\n{body}")
    declared = files.scan_csv_skip(spark, str(tmp_path / "s"), 2, "id INT, label STRING")
    assert declared.count() == 250 and declared.agg(F.sum("id")).first()[0] == sum(
        i * 100 + j for i in range(5) for j in range(50)
    )
    assert declared.filter("id = 3").first()["label"] == "name, 3"
    named = files.scan_csv_skip(spark, str(tmp_path / "s"), 2)
    assert named.columns == ["id", "label"] and named.count() == 250


def test_preamble_never_shifts_values(spark, tmp_path):
    write(tmp_path / "a" / "1.csv", "title\nid,name\n1,x\n")
    write(tmp_path / "a" / "2.csv", "title\nname,id\ny,2\n")
    with pytest.raises(Exception, match="header"):
        files.scan_csv_skip(spark, str(tmp_path / "a"), 1).collect()
    write(tmp_path / "b" / "1.csv", 'title\nid,name\n1,"a\nb"\n2,5" pipe\n')
    assert rows(files.scan_csv_skip(spark, str(tmp_path / "b"), 1)) == [("1", "a\nb"), ("2", '5" pipe')]
    write(tmp_path / "c" / "1.csv", 'title\nname\n   \n\n"say ""hi"""\n')
    assert files.scan_csv_skip(spark, str(tmp_path / "c"), 1).count() == 2  # blanks are a value, an empty line is none
    plan = files.scan_csv_skip(spark, str(tmp_path / "c"), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "96")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


VALUES = ["", "a", "two words", "5\" pipe", "line\nend", "\n", "a,b", 'said "hi"', "x\r\ny", '"', '""', "\n\n,\n", "é\n東", "long " * 40, ("wide, line\n" * 30)]


@pytest.mark.parametrize("seed,end", [(0, "\n"), (1, "\r\n"), (2, "\n"), (3, "\r\n")])
def test_records_over_line_ends_and_splits(spark, tmp_path, small_splits, seed, end):
    """Many splits, some of them wholly within one value; the csv module reads the same records."""
    chance = random.Random(seed)
    expected = []
    for part in range(2):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end, quoting=chance.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        for i in range(40):
            row = [str(part * 100 + i), chance.choice(VALUES), chance.choice(VALUES)]
            writer.writerow(row)
            if chance.random() < 0.2:
                out.write(end)
        path = tmp_path / "r" / f"{part}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes((f'a "title{end}{end}id,one,two{end}' + out.getvalue()).encode())
        expected += [tuple(r) for r in csv.reader(io.StringIO(out.getvalue(), newline="")) if r]
    df = files.scan_csv_skip(spark, str(tmp_path / "r"), 2, "id STRING, one STRING, two STRING")
    assert spark.read.text(str(tmp_path / "r"), lineSep="\n").rdd.getNumPartitions() > 40
    got = sorted((r["id"], r["one"] or "", r["two"] or "") for r in df.collect())
    assert got == sorted(expected)


def test_lone_quotes_are_characters(spark, tmp_path, small_splits):
    path = write(tmp_path / "q.csv", 'title\nid,name,more\n1,5" pipe,a\n2,x "y" z,"b\n""c"" d"\n3,"closed"tail,e\n4,,f"\n')
    assert rows(files.scan_csv_skip(spark, path, 1, "id INT, name STRING, more STRING").select("id", "more")) == [(1, "a"), (2, 'b\n"c" d'), (3, "e"), (4, 'f"')]
    assert [r["name"] for r in files.scan_csv_skip(spark, path, 1).orderBy("id").collect()][:2] == ['5" pipe', 'x "y" z']


def test_rows_and_dates(spark):
    literal = files.from_rows(spark, [(1, "2024-01-31"), (2, "n/a"), (3, None)], "k int, day string")
    assert literal.count() == 3 and literal.columns == ["k", "day"]
    dates = files.coerce(literal, {"day": "date"})
    assert [str(r["day"]) for r in dates.orderBy("k").collect()] == ["2024-01-31", "None", "None"]


def test_preamble_in_a_file_of_many_splits(spark, tmp_path):
    body = "".join(f"{j},{'x' * 50}\n" for j in range(20_000))
    path = write(tmp_path / "big.csv", f"title\nid,v\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        df = files.scan_csv_skip(spark, path, 1, "id INT, v STRING")
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        assert df.agg(F.count("id"), F.sum("id")).first() == (20_000, 199_990_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json(spark, tmp_path):
    path = write(tmp_path / "p.json", '{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    inferred = files.scan_json(spark, path)
    assert inferred.columns == ["age", "name"] and dict(inferred.dtypes)["age"] == "bigint"
    declared = files.scan_json(spark, path, "age INT, name STRING")
    assert dict(declared.dtypes)["age"] == "int"
    assert rows(declared) == [(19, "Justin"), (30, "Andy"), (None, "Michael")]


def test_glob_checks_headers_and_layouts_align(spark, tmp_path):
    write(tmp_path / "fact/2020/1.csv", "a,b\n1,x\n")
    write(tmp_path / "fact/2021/2.csv", "a,b\n2,y\n")
    write(tmp_path / "late/1.csv", "b,c\nz,9\n")
    df = files.scan_glob(spark, str(tmp_path / "fact/*/*.csv"), "a INT, b STRING")
    assert rows(df) == [(1, "x"), (2, "y")]
    keyed = files.with_file_key(df, "year", r"/(\d{4})/")
    assert rows(keyed.select("a", "year")) == [(1, "2020"), (2, "2021")]
    both = files.scan_layouts(
        spark, {str(tmp_path / "fact/*/*.csv"): "a INT, b STRING", str(tmp_path / "late/*.csv"): "b STRING, c INT"}
    )
    assert rows(both) == [(1, "x", None), (2, "y", None), (None, "z", 9)]
    with pytest.raises(Exception):
        files.scan_glob(spark, str(tmp_path / "late/*.csv"), "a INT, b STRING").collect()


def test_coerce(spark):
    df = spark.createDataFrame([("12.7", "a"), (None, None), ("x", "b"), ("9007199254740993", "c")], "n string, s string")
    got = files.coerce(df, {"n": "bigint", "s": "string"})
    assert [tuple(r) for r in got.collect()] == [(12, "a"), (0, None), (0, "b"), (9007199254740993, "c")]


def test_partitioned_sink_splits_a_hot_folder(spark, tmp_path):
    """A year holding nearly all rows is written by several tasks, all rows once."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).select(
            "id", F.when(F.col("id") % 50 == 0, 2001).otherwise(2000).alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("h")
        )
        path = str(tmp_path / "out")
        sinks.sink_partitioned(df, path, ["year"])
        assert len(list((tmp_path / "out" / "year=2000").glob("*.csv"))) > 1
        back = files.scan_csv(spark, path, "id BIGINT, h STRING, year INT")
        assert back.agg(F.count_distinct("id"), F.count("id")).first() == (200_000, 200_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_export_by_year(spark, tmp_path):
    df = spark.createDataFrame([(1, 2019), (2, 2020), (3, 2021)], "v int, Year int")
    sinks.sink_by_year(df, str(tmp_path / "x"), [2021, 2020])
    assert sorted(p.name for p in (tmp_path / "x").glob("Year=*")) == ["Year=2020", "Year=2021"]


def test_views_and_stages(spark):
    sinks.register_view(spark.range(3), "v_ids")
    staged = sinks.stage(spark, "v_twice", "SELECT id * 2 AS id FROM v_ids")
    assert rows(staged) == rows(spark.table("v_twice")) == [(0,), (2,), (4,)]
    sinks.drop_view(spark, "v_ids")
    sinks.drop_view(spark, "v_ids")
    with pytest.raises(Exception):
        spark.table("v_ids")
    stored = sinks.stage_table(spark, "stored_twice", "SELECT id + 1 AS id FROM v_twice")
    assert rows(stored) == [(1,), (3,), (5,)]


def test_range_source(spark):
    df = files.range_source(spark, 1, 30)
    assert df.count() == 29
    assert rows(df.select((F.col("id") - 1).alias("id")).filter("id < 10")) == [(i,) for i in range(10)]


def test_files_go_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert fresh_path(spark, "x").startswith(root)
    kept = materialize(spark.range(5), "ids")
    assert kept.count() == 5 and all(root in f for f in kept.inputFiles())
