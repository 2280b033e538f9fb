"""The pipeline against its stages done by hand, and its stages on odd rows."""

import random

import public_tokenizers
import pytest
from conftest import SMALL
from llm_rows import none, odd  # noqa: F401
from tokenizers import Tokenizer as Library

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import secrets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of two languages with copies, an edited copy, leaked items, secrets and rows without a language."""
    rng = random.Random(12)
    vocabulary = {lang: [("".join(rng.choice(parts) for _ in range(rng.randint(2, 4)))) for _ in range(400)]
                  for lang, parts in (("aa", ["ka", "lo", "mi", "tu", "re"]), ("bb", ["sch", "eng", "ung", "ver", "ich"]))}

    def text(lang, n):
        return " ".join(rng.choice(vocabulary[lang]) for _ in range(n))

    docs = [(i, text("aa" if i % 2 else "bb", rng.randint(60, 150)), "aa" if i % 2 else "bb") for i in range(120)]
    items = [(i, text("aa", 30)) for i in range(3)]
    by_id = {i: t for i, t, _ in docs}
    gone = set()
    docs += [(200, by_id[3], "aa"), (201, by_id[3], "aa"), (202, by_id[4] + " " + vocabulary["bb"][0], "bb")]
    gone |= {200, 201, 202}  # the least id of a class stays
    docs += [(300, by_id[5] + " " + items[0][1], "aa"), (301, " ".join(items[1][1].split()[:25]) + " " + text("aa", 40), "aa")]
    gone |= {300, 301}
    docs += [(400, text("aa", 30) + " password=abcdef123456 " + text("aa", 30), "aa"), (401, "AKIA" + "A1" * 8 + " " + text("bb", 50), "bb")]
    docs += [(500, None, "aa"), (501, "", None), (502, "12 34 !!", "bb")]
    gone |= {500, 501, 502}
    root = tmp_path_factory.mktemp("pipeline")
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in docs]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(
        str(root / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root), dict((i, t) for i, t, _ in docs), gone


def test_stages_by_hand(spark, folder):
    path, texts, gone = folder
    library = Library.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    assert set(got) == set(texts) - gone
    for doc_id, row in got.items():
        text = texts[doc_id]
        for start, _, end in reversed(secrets.base_spans(text)):
            text = text[:start] + secrets.MASK + text[end:]
        want = library.encode(text, add_special_tokens=False).ids
        assert row.ids == want and row.n_tokens == len(want), doc_id
        whole = library.decode(want, skip_special_tokens=False).replace("</w> ", "\t").replace("</w>", "\t").replace(" ", "").replace("\t", " ")
        assert row.decoded == whole  # all letters of these texts are ASCII


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secrets", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.dtypes == docs.dtypes


def test_stages_on_odd_rows(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        some = stage(spark, odd, SMALL)
        assert some.count() <= 13
        assert stage(spark, none, SMALL).collect() == [], name
        if name != "bpe":
            assert some.columns == odd.columns


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
