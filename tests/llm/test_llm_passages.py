"""Test items, secrets and licence notices in texts."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import none, odd  # noqa: F401

from millrace.llm import decontamination, licenses, secrets


# --- test items ------------------------------------------------------------------

def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_against_the_textbook():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 15)), rng.integers(0, 4, rng.integers(1, 25))
        assert decontamination.align(a, b)[0] == plain_align(a, b)


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(3000)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = {i: words(rng.randint(25, 40)) for i in range(12)}
    items[12] = ["short", "item"]
    docs, want = [], {}
    for d in range(160):
        text = words(rng.randint(50, 300))
        if d % 3 == 0:  # one item is in a third of all documents
            text[20:20] = items[0]
            want[d] = {0}
        elif d % 8 == 1:
            item = list(items[d % 11 + 1])
            for at in rng.sample(range(len(item)), len(item) // 6):  # reworded
                item[at] = f"new{d}"
            del item[rng.randrange(len(item))]
            text += item
            want[d] = {d % 11 + 1}
        docs.append((d, ", ".join(text).upper() if d % 2 else " ".join(text)))
    docs.append((500, "Short item."))
    want[500] = {12}
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string"),
        want,
    )


def test_exact_and_edited_items_are_found_and_nothing_else(leaks):
    docs, items, want = leaks
    got = {}
    for r in decontamination.contaminated(docs, items).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
        assert 0.5 <= r.score <= 1 and r.first_word < r.end_word
    assert got == want
    assert {r.doc_id for r in decontamination.clean(docs, items).collect()} == set(range(160)) - set(want)


def test_items_edited_in_every_phase(spark):
    """Wherever an edited copy keeps one run of four words and half of the score, it is found, exact copies around or not."""
    rng = random.Random(14)
    items = {i: [f"i{i}x{k}" for k in range(n)] for i, n in enumerate((40, 40, 15, 15))}
    docs, want = [], set()

    def add(item, gone):
        words = [f"d{len(docs)}w{k}" if k in gone else w for k, w in enumerate(items[item])]
        kept = any(not gone & set(range(a, a + 4)) for a in range(len(words) - 3))
        if kept and plain_align(items[item], words) >= len(words):
            want.add((len(docs), item))
        docs.append((len(docs), " ".join([f"d{len(docs)}a{k}" for k in range(9)] + words + [f"d{len(docs)}z{k}" for k in range(9)])))

    for item in (0, 1):
        for step in (5, 6):
            for phase in range(step):
                add(item, set(range(phase, 40, step)))
    for item in (2, 3):
        for n in (1, 2, 3):
            for gone in rng.sample(list(itertools.combinations(range(15), n)), 12):
                add(item, set(gone))
    for item in (1, 3):  # these leaked unchanged as well
        for _ in range(5):
            add(item, set())
    assert sum(item < 2 for _, item in want) == 2 * 11 + 5
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, rows).collect()} == want


def test_common_runs_propose_only_together(spark, monkeypatch):
    """A turn of phrase in every item and most texts, a passage in hundreds of copies: the same rows as with all runs rare."""
    rng = random.Random(17)
    word = lambda: f"w{rng.randrange(4000)}"
    phrase = "once upon a time"
    items = [" ".join([*(word() for _ in range(12)), phrase, *(word() for _ in range(12))]) for _ in range(20)] + [phrase, phrase + " there"]
    texts = [" ".join([*(word() for _ in range(30)), phrase, *(word() for _ in range(20))]) for _ in range(150)]
    texts += [f"{word()} {items[3]} {word()}"] * 40  # copies of one text
    for k in range(12):  # edited at every seventh word
        words = items[k].split()
        words[k % 7 :: 7] = [word() for _ in words[k % 7 :: 7]]
        texts.append(" ".join([word(), *words, word()]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    pairs = []
    plain = decontamination._proposed
    monkeypatch.setattr(decontamination, "_proposed", lambda *a: pairs.append(plain(*a)) or pairs[-1])

    def found():
        return {(r.doc_id, r.item_id): (r.score, r.first_word, r.end_word) for r in decontamination.contaminated(docs, bench).collect()}

    every = found()
    monkeypatch.setattr(decontamination, "RARE", 8)
    assert found() == every and {(150 + i, 3) for i in range(40)} <= set(every) and {(190 + k, k) for k in range(12)} <= set(every)
    assert all((d, 20) in every for d in range(150))  # the phrase is an item as well
    many, few = (p.filter("item_id < 20").count() for p in pairs)
    assert many > 150 * 20 and few <= 40 + 12 * 3


def test_items_against_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (None, "a b c d e"), (3, "")],
                                  "item_id bigint, text string")
    got = decontamination.contaminated(odd, items).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in got] == [(1, 1, 1.0)] * 2
    assert decontamination.contaminated(none, items).collect() == []
    assert decontamination.contaminated(odd, items.limit(0)).collect() == []
    kept = decontamination.clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == 11


# --- secrets -----------------------------------------------------------------------

def plain_spans(text):
    """The patterns as they are stated."""
    kinds = [
        (0, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
            r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        (1, r"AKIA[A-Z0-9]+"), (2, r"[0-9a-f]+"),
    ]
    out = []
    for kind, pattern in kinds:
        for m in re.finditer(pattern, text):
            size = len(m[2]) if kind == 0 else len(m[0])
            if size >= (6, 20, 24)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_patterns():
    rng = random.Random(6)
    bits = ["password", "PassWD", "token", "tOKen", "apikey", "API_KEY", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIA" + "A" * 16, "X9" * 9,
            "a" * 24, "0123456789abcdef" * 2, "secret", "é", "ſecret", "abc", "abcdef-1", "\n", "K"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert secrets.base_spans(text) == plain_spans(text), text


@pytest.fixture(scope="module")
def files(spark):
    rng = random.Random(8)

    def key(n, letters="abcdef0123456789"):
        return "".join(rng.choice(letters) for _ in range(n))

    prose = "the service reads its settings from a file and writes the rest to disk as before".split()
    docs = []
    for d in range(240):
        text = [rng.choice(prose) for _ in range(60)]
        if d % 4 == 0:
            text.insert(30, f'token = "{key(40)}"')
        elif d % 4 == 1:
            text.insert(20, f"password={key(18)}")
        elif d % 16 == 2:
            text.insert(20, "é AKIA" + key(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
        docs.append((d, " ".join(text)))
    docs += [(1000 + i, " ".join(prose) + f" credential = {key(22)} " + " ".join(prose)) for i in range(5)]
    return docs, spark.createDataFrame(docs, "doc_id bigint, text string")


def test_patterns_stay_and_the_field_adds(files):
    docs, frame = files
    got = {r.doc_id: r for r in secrets.scan_digests(frame).collect()}
    for doc_id, text in docs:
        base = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text)]
        spans = got[doc_id].spans.split(",") if got[doc_id].spans else []
        assert [s for s in spans if not s.startswith("crf")] == base
        assert doc_id >= 1000 or got[doc_id].n_added == 0, got[doc_id].spans
    # A form that no pattern knows, in texts the fit has not seen.
    model = secrets.fit([text for doc_id, text in docs if doc_id < 1000])
    new = [text for doc_id, text in docs if doc_id >= 1000]
    data, offsets = secrets.text_arrays(pa.array(new))
    found = secrets.spans_of(new, model, data, offsets)
    assert [[k for _, k, _ in own] for own in found] == [[3]] * 5
    assert all(re.fullmatch("[0-9a-f]{22}", text[a:b]) for text, [(a, _, b)] in zip(new, found))


def test_a_secret_at_the_start_of_a_text_is_opened():
    """A field that would rather go on with a secret than open one."""
    weights, transitions = np.zeros((secrets._STARTS[-1], 3)), np.zeros((3, 3))
    weights[:, 1:] = 0.5, 1
    transitions[0, 2] = -1e9
    texts = ["alpha beta", "", "gamma"]
    data, offsets = secrets.text_arrays(pa.array(texts))
    assert secrets.spans_of(texts, (weights, transitions), data, offsets) == [[(0, 3, 10)], [], [(0, 3, 5)]]


def test_redaction(files):
    docs, frame = files
    for r in secrets.redacted(frame).collect():
        text = dict(docs)[r.doc_id]
        assert not secrets.base_spans(r.text)
        assert (secrets.MASK in r.text) or r.text == text


def test_spans_of_the_field_count_code_points():
    text = "é" * 7 + " x"
    data = np.frombuffer(text.encode(), np.uint8)
    found = secrets.tokens(data, np.array([0, len(data)]))
    assert found.starts.tolist() == [0, 15] and found.ends.tolist() == [14, 16]


def test_secrets_of_odd_rows(odd, none):
    got = secrets.scan_digests(odd).collect()
    assert len(got) == 13 and {r.spans for r in got} == {""}
    assert secrets.scan(none).collect() == [] and secrets.scan_digests(none).collect() == []
    same = secrets.redacted(odd)
    assert same.columns == odd.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd.collect()))
    assert secrets.redacted(none).collect() == []


# --- licence notices ------------------------------------------------------------------

def test_longest_increasing_run():
    rng = random.Random(9)
    for _ in range(200):
        places = rng.sample(range(30), 8)
        pairs = list(enumerate(places))
        best = max(len(c) for n in range(9) for c in itertools.combinations(places, n) if list(c) == sorted(c))
        got = licenses._increasing(pairs)
        assert len(got) == best and [j for _, j in got] == sorted(j for _, j in got)


def test_patience_matches_equal_words_in_order():
    rng = random.Random(10)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert licenses.patience(a, a) == [(i, i) for i in range(len(a))]


def test_notices(spark):
    mit = licenses.TEMPLATES["mit"]
    edited = mit.replace("free of charge", "at no cost").replace("documentation", "docs")
    filler = "some words that no licence holds are here " * 20
    docs = [(1, filler + mit + filler), (2, filler + edited.upper() + "\n" + licenses.TEMPLATES["cc-by-nc-4.0-line"]),
            (3, filler), (4, licenses.TEMPLATES["apache-2.0"]), (5, "the license under the version of this work is public " * 30)]
    got = {}
    for r in licenses.notices(spark.createDataFrame(docs, "doc_id bigint, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.license, round(r.coverage, 2)))
    assert got[1] == [("mit", 1.0)] and got[4] == [("apache-2.0", 1.0)]
    assert [name for name, _ in got[2]] == ["mit", "cc-by-nc-4.0-line"] and 0.9 < got[2][0][1] < 1
    assert 3 not in got and 5 not in got


def test_notices_of_odd_rows(odd, none):
    assert licenses.notices(odd).collect() == [] and licenses.notices(none).collect() == []
    assert licenses.notices(odd, {"none": ""}).collect() == []
