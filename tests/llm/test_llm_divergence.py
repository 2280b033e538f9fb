"""The audit against a plain count in Python, and its steps on their own."""

import re
import string
import weakref
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from llm_rows import none, odd  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import blocks, divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(docs, least=10, top=10):
    """Rows of the audit from (text, lang, source) by counting all words."""
    docs = [tuple(x or "" for x in d) for d in docs]
    held, n = defaultdict(set), defaultdict(Counter)
    for i, (text, lang, source) in enumerate(docs):
        for term in re.findall(divergence.TERM, text.translate(LOWER)):
            held[lang, term].add(i)
            n[lang, source][term] += 1
    groups = sorted({d[1:] for d in docs})
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), ids in held.items() if x == lang and len(ids) >= least]
        sources = [s for x, s in groups if x == lang]
        whole = Counter({t: sum(n[lang, s][t] for s in sources) for t in kept})

        def shares(counts):
            mass = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // mass for t in kept}

        q = shares(whole)
        p = {s: shares(n[lang, s]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(r, sum(f(p[s][t], p[r][t]) for t in kept)) for r in sources if r != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


def audited(spark, docs, **params):
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(6)
    return rows(divergence.audit(df, **params))


def made(n, seed=1, sources=5, words=40):
    chance = np.random.default_rng(seed)
    marks = ["", ",", ".", "-x", " y", "'", "\x1c", "\x00", "…", "é", "9"]
    docs = []
    for i in range(n):
        lang, source = f"l{i % 2}", f"s{(i * i) % sources}"
        own = chance.zipf(1.3, 60) % words + (i % sources)
        text = "".join(
            f"{'W' if chance.random() < 0.3 else 'w'}{w}{chr(97 + w % 26)}{marks[chance.integers(len(marks))]}{chance.choice([' ', '  ', chr(9), chr(11), chr(13)])}"
            for w in own
        )
        docs.append((text, lang, source))
    return docs


def test_audit_equals_a_plain_count(spark):
    docs = made(150)
    assert audited(spark, docs) == plain(docs)
    assert audited(spark, docs, least=3, top=2) == plain(docs, 3, 2)


def test_spelled_in_several_chunks_a_term_is_in_one_document(spark):
    docs = [("Word word, WORD-word (word) word.", "en", "a")] * 9 + [("other", "en", "b")] * 12
    found = audited(spark, docs)
    assert found == plain(docs) and not any(r[3] == "word" for r in found)  # in nine documents
    docs.append(("word", "en", "b"))
    found = audited(spark, docs)
    assert found == plain(docs) and any(r[3] == "word" for r in found)


def test_groups_without_terms(spark):
    docs = [("common words here", "en", "a")] * 11 + [("12 34 !?", "en", "digits"), (None, "en", None), ("", None, "x"), ("rare", None, "y"), ("z", "xx", "alone")]
    found = audited(spark, docs)
    assert found == plain(docs)
    assert {r[:4] for r in found if r[0] == ""} == {("", "x", "pair", "y"), ("", "y", "pair", "x")}
    assert all(r[4] == 0 for r in found if r[0] == "") and not any(r[0] == "xx" for r in found)


def test_many_small_blocks_buckets_and_tiles(spark, monkeypatch):
    docs = made(120, seed=3, sources=9)
    want = plain(docs, 5)
    monkeypatch.setattr(divergence, "TILE", 4)
    monkeypatch.setattr(divergence, "BUCKET_BYTES", 500)
    import inspect

    # Blocks are cut in the workers, so the smaller size is written into what they run.
    source = inspect.getsource(divergence._texts_of_size).replace("BLOCK_BYTES", "700")
    space = dict(vars(divergence))
    exec(source, space)
    cut = list(space["_texts_of_size"](iter([pa.record_batch([pa.array([d[i] for d in docs]) for i in range(3)], ["text", "lang", "source"])])))
    assert len(cut) > 20 and sum(t.num_rows for t in cut) == len(docs)
    assert audited(spark, docs, least=5) == want


def test_packed_arrays():
    for values in ([], [0], [255, 1], [256], [1 << 40, 3]):
        packed = divergence._small(np.array(values, np.int64))
        assert divergence._large(packed).tolist() == values
    assert len(divergence._small(np.arange(200))) == 201


def test_very_long_text_without_blanks(spark):
    docs = [("ab." * 300_000, "en", "a")] + [("ab cd", "en", "b")] * 10
    assert audited(spark, docs) == plain(docs)


def test_odd_rows(spark, odd, none):  # noqa: F811
    docs = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    many = odd.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(12))))
    assert rows(divergence.audit(many)) == plain(docs * 12)
    empty = divergence.audit(none)
    assert empty.count() == 0 and empty.columns == COLUMNS


@pytest.mark.parametrize("least", [1, 10])
def test_terms_of_other_scripts(spark, least):
    docs = [("Straße ÄÖ 東京 İstanbul ﬁ K", "de", f"s{i % 3}") for i in range(12)] + [("straße äö 東京", "de", "s0")] * 4
    assert audited(spark, docs, least=least) == plain(docs, least)


def test_chunks_of_texts_are_narrow():
    """Distinct chunks, their numbers and texts without empty ones, in four bytes each: a task holds them for a whole block."""
    texts = ["a b a", "  b\tc ", "", "   ", "c", "\u00e9 a"]
    chunks, at, doc = divergence._chunks_of(pa.chunked_array([texts[:2], texts[2:]], pa.string()))
    words = chunks.to_pylist()
    assert sorted(words) == ["a", "b", "c", "\u00e9"] and at.dtype == doc.dtype == np.int32
    assert [(int(d), words[i]) for d, i in zip(doc, at)] == [(d, w) for d, t in enumerate(texts) for w in t.split()]
    assert all(len(x) == 0 for x in divergence._chunks_of(pa.chunked_array([["", " "]], pa.string())))


def test_steps_give_memory_back(monkeypatch):
    """At the end of a task, when its arrays are free, and after each group."""
    class Held:
        pass

    calls, held = [], []

    def step(batches):
        own = Held()
        held.append(weakref.ref(own))
        yield from batches

    monkeypatch.setattr(blocks, "give_back", lambda: calls.append(held[0]() is None if held else None))
    assert list(blocks.lean(step)(iter([1, 2]))) == [1, 2] and calls == [True]
    assert blocks.lean_group(lambda table: table + 1)(1) == 2 and len(calls) == 2
    monkeypatch.undo()
    blocks.give_back()
