"""The conditional random field against enumeration, and languages of held-out texts."""

import itertools
import zlib

import numpy as np
import pytest
from conftest import SMALL
from llm_rows import none, odd  # noqa: F401

from millrace.llm import crf, language_id


def paths(scores, transitions):
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        yield path, sum(scores[i, s] for i, s in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))


def test_marginals_and_best_path_by_enumeration(monkeypatch):
    monkeypatch.setattr(crf, "STEPS", 3)  # several blocks a sequence
    rng = np.random.default_rng(4)
    scores, transitions = rng.normal(size=(16, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 7, 7, 8, 16])
    pairs = np.zeros((3, 3))
    got, best = crf.marginals(scores, first, transitions, pairs), crf.viterbi(scores, first, transitions)
    want_pairs = np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:]):
        if a == b:
            continue
        all_paths = list(paths(scores[a:b], transitions))
        total = sum(np.exp(w) for _, w in all_paths)
        want = np.zeros((b - a, 3))
        for path, w in all_paths:
            for i, s in enumerate(path):
                want[i, s] += np.exp(w) / total
            for x, y in zip(path, path[1:]):
                want_pairs[x, y] += np.exp(w) / total
        assert np.allclose(got[a:b], want)
        assert tuple(best[a:b]) == max(all_paths, key=lambda p: p[1])[0]
    assert np.allclose(pairs, want_pairs)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_held_out_accuracy(docs):
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 30 and len(got) == 200
    assert (held.lang == held.lang_pred).mean() >= 0.97
    assert held.score.between(0, 1).all()


def test_prediction_reads_the_text_only(spark, docs):
    model = language_id.fit_on(docs, ~language_id.held_out())
    other = docs.selectExpr("doc_id + 1 as doc_id", "text", "'xx' as lang", "'y' as source")
    one = language_id.predict(docs, model).select("lang_pred", "score").toPandas()
    two = language_id.predict(other, model).select("lang_pred", "score").toPandas()
    assert one.equals(two)


def test_code_switching(docs):
    """Two halves in two languages: words get the label of their half, the score is a share."""
    model = language_id.fit_on(docs, ~language_id.held_out())
    by_lang = {r.lang: r.text for r in docs.filter("length(text) between 1500 and 4000").orderBy("doc_id").collect()}
    one, two = sorted(by_lang)[:2]
    halves = [" ".join(by_lang[x].split()[:150]) for x in (one, two)]
    raw = np.frombuffer((halves[0] + " " + halves[1]).encode(), np.uint8)
    posterior, share, counts, words = model.languages_of(raw, np.array([0, len(raw)]))
    state = posterior.argmax(1)
    at = int(np.searchsorted(words.starts, len(halves[0].encode())))
    assert (state[:at] == model.languages.index(one)).mean() > 0.95
    assert (state[at:] == model.languages.index(two)).mean() > 0.95
    assert 0.3 < share[0].max() < 0.7


def test_letters_in_no_learned_language_go(spark, docs):
    """Random letters and languages never learned go; held-out texts, their first four words and half-foreign texts stay."""
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    strange = [" ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(n)) for n in (8, 20, 60, 200) for _ in range(5)]
    strange += ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan Heille on annettu järki ja omatunto",
                "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
                "Все люди рождаются свободными и равными в своем достоинстве и правах"]
    held = [r.text for r in docs.filter(language_id.held_out()).orderBy("doc_id").collect()]
    clean = held + [" ".join(t.split()[:4]) for t in held] + [" ".join(t.split()[:40]) + " " + strange[-2] for t in held[:10]]
    ids = [i for i in range(10000, 20000) if zlib.crc32(str(i).encode()) % 3 == 1]  # no fit sees these
    rows = list(zip(ids, strange + clean))
    more = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "cast(null as string) as lang")
    kept = language_id.accepted(docs.select("doc_id", "text", "lang").unionAll(more))
    got = {r.doc_id for r in kept.filter("doc_id >= 10000").collect()}
    assert got == {i for i, _ in rows[len(strange):]}


def test_odd_rows(odd, none):
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(odd).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (7, "und")} <= got
    assert language_id.identify(odd).count() == 13
    assert language_id.identify(none).collect() == []
    kept = language_id.accepted(odd)
    assert kept.columns == odd.columns
    assert not {r.doc_id for r in kept.collect()} & {4, 5, 6, 7}
    assert language_id.accepted(none).collect() == []


def test_nothing_labelled(odd):
    assert {r.lang_pred for r in language_id.identify(odd.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
