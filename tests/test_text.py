import pytest
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, NGram, RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from millrace.functions import scalars, text, udfs

SENTENCES = [
    "Grain comes to the mill by river",
    "Nobody KNOWS which Wheel turns first",
    "oats;barley,rye|wheat,spelt",
    "",
    "   ",
    " leading and  double\tblanks\n\nand lines \n ",
    "ÀÉ wörds stay",
]


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame(list(enumerate(SENTENCES)), "id int, sentence string")


def test_tokenize_equals_mllib(sentences):
    expected = Tokenizer(inputCol="sentence", outputCol="words").transform(sentences).orderBy("id").collect()
    ours = sentences.select("id", text.tokenize(F.col("sentence")).alias("w")).orderBy("id").collect()
    assert [r["w"] for r in ours] == [r["words"] for r in expected]


@pytest.mark.parametrize("pattern,gaps", [(r"\W", True), (r"\w+", False)])
def test_tokenize_regex_equals_mllib(sentences, pattern, gaps):
    stage = RegexTokenizer(inputCol="sentence", outputCol="words", pattern=pattern, gaps=gaps)
    expected = stage.transform(sentences).orderBy("id").collect()
    ours = sentences.select("id", text.tokenize_regex(F.col("sentence"), pattern, gaps=gaps).alias("w")).orderBy("id")
    assert [r["w"] for r in ours.collect()] == [r["words"] for r in expected]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams_equal_mllib(sentences, n):
    tokens = Tokenizer(inputCol="sentence", outputCol="words").transform(sentences)
    expected = NGram(n=n, inputCol="words", outputCol="grams").transform(tokens).orderBy("id").collect()
    ours = tokens.select("id", text.ngrams(F.col("words"), n).alias("g")).orderBy("id").collect()
    assert [r["g"] for r in ours] == [r["grams"] for r in expected]


@pytest.mark.parametrize("language", ["english", "french", "german"])
def test_stop_words_equal_mllib(spark, language):
    data = [(0, ["Under", "the", "bridge", "runs", "THE", "mill", "le", "und", "ist"]), (1, ["a", "stone", "or", "a", "wheel", "dans", "nicht"])]
    df = spark.createDataFrame(data, "id int, raw array<string>")
    stop = text.stop_words(language)
    expected = StopWordsRemover(inputCol="raw", outputCol="kept", stopWords=stop).transform(df).orderBy("id").collect()
    ours = df.select("id", text.remove_stopwords(F.col("raw"), stop).alias("k")).orderBy("id").collect()
    assert [r["k"] for r in ours] == [r["kept"] for r in expected]


def test_vocabulary_against_mllib(spark):
    df = spark.createDataFrame([(0, ["a", "b", "c"]), (1, ["a", "b", "b", "c", "a"])], "id int, words array<string>")
    got = [tuple(r) for r in text.vocabulary(df, F.col("words"), size=3, min_docs=2).collect()]
    assert got == [("a", 3, 2), ("b", 3, 2), ("c", 2, 2)]
    model = CountVectorizer(inputCol="words", outputCol="f", vocabSize=3, minDF=2.0).fit(df)
    assert set(model.vocabulary) == {t for t, _, _ in got}


def test_tf_idf_against_mllib(sentences):
    tokens = Tokenizer(inputCol="sentence", outputCol="words").transform(sentences)
    vectors = CountVectorizer(inputCol="words", outputCol="counts").fit(tokens)
    counted = vectors.transform(tokens)
    scored = IDF(inputCol="counts", outputCol="weights").fit(counted).transform(counted).collect()
    expected = {}
    for row in scored:
        for i, weight in zip(row["weights"].indices, row["weights"].values):
            expected[row["id"], vectors.vocabulary[i]] = weight
    ours = text.tf_idf(sentences, "id", text.tokenize(F.col("sentence"))).collect()
    assert {(r["id"], r["term"]): pytest.approx(r["tf_idf"]) for r in ours} == expected


def test_hashing_tf_keeps_all_tokens(spark):
    df = spark.createDataFrame([(["hi", "i", "heard", "hi"],)], "words array<string>")
    vector = HashingTF(inputCol="words", outputCol="tf", numFeatures=20).transform(df).first()["tf"]
    assert vector.size == 20 and sum(vector.values) == 4


def test_words_split_on_single_blanks(spark):
    df = spark.createDataFrame([("a  b\nc",)], "t string")
    assert df.select(text.words(F.col("t"))).first()[0] == ["a", "", "b", "c"]


def test_json_field_and_keyword(spark):
    data = [('{"text": "Soccer now"}',), ('{"text": null}',), ("{broken",), ('{"other": 1}',)]
    df = spark.createDataFrame(data, "m string")
    field = df.select(scalars.json_field(F.col("m"), "text", "STRING").alias("t")).na.drop()
    assert [r["t"] for r in field.collect()] == ["Soccer now"]
    assert field.filter(scalars.has_keyword(F.col("t"), "SOCCER", "chess")).count() == 1


def test_udfs_and_their_native_forms(spark):
    udfs.register_udfs(spark)
    spark.createDataFrame([(2.0, 2**31, ["a", "b"]), (None, None, None)], "wt double, d long, w array<string>") \
        .createOrReplaceTempView("cars_v")
    got = spark.sql(
        "SELECT convert_weight(wt) AS a, convert_mileage(wt) AS b, double_whole(d) AS c, count_tokens(w) AS n FROM cars_v"
    ).collect()
    assert got[0]["a"] == pytest.approx(0.9) and got[0]["b"] == pytest.approx(0.85)
    assert got[0]["c"] == 2**32 and got[0]["n"] == 2
    assert tuple(got[1]) == (None, None, None, None)
    native = spark.table("cars_v").select(udfs.scaled_native(F.col("wt"), 0.45)).first()[0]
    assert native == got[0]["a"]
