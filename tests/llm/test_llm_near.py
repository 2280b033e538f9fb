"""Near-duplicates and components against brute force."""

import collections
import random

import numpy as np
import pytest
from llm_rows import none, odd  # noqa: F401

from millrace.llm import components as graph
from millrace.llm import near_dedup


def unions(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["path", "hub", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(60)] + [(100, 101)],
        "hub": [(500, i) for i in range(300)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "none": [],
    }[shape]
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {k: v for k, v in unions(edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def runs_of(text):
    """Five-word runs of a text of plain words; a shorter text is one run."""
    words = text.split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or collections.Counter([tuple(words)] if words else [])


def exact_classes(texts, least=0.8):
    """Classes by all pairs, with document frequencies counted here."""
    runs = [runs_of(t) for t in texts]
    df = collections.Counter(run for own in runs for run in own)
    n = len(texts)
    vectors = [{k: c * (1 + np.log(n / df[k]) / np.log(n + 1)) for k, c in own.items()} for own in runs]
    edges = [(i, i) for i in range(n)]
    for i, v in enumerate(vectors):
        for j in range(i):
            w = vectors[j]
            both = sum(min(v[k], w[k]) for k in v.keys() & w.keys())
            whole = sum(v.values()) + sum(w.values()) - both
            if texts[i] == texts[j] or whole and both / whole >= least:
                edges.append((i, j))
    found = unions(edges)
    return [found[i] for i in range(n)]


def star(rng, n, edits):
    """Copies of one text, each with a few words of its own: alike to the first, less so to one another."""
    base = [f"b{i}" for i in range(150)]
    out = [" ".join(base)]
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, edits)):
            words[at] = f"e{k}x{at}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("pivots", [1, 4])
def test_classes(spark, monkeypatch, pivots):
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)  # with one pivot the blocks do most of the work
    monkeypatch.setattr(near_dedup, "MINOR_BLOCK", 3)
    monkeypatch.setattr(near_dedup, "MAJOR_BLOCK", 7)
    rng = random.Random(3)
    texts = star(rng, 60, 6) + [" ".join(f"u{rng.randrange(5000)}" for _ in range(rng.randint(1, 80))) for _ in range(40)]
    texts += [texts[3], texts[3], texts[70], "", "", "one two", "one two", "one three"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == exact_classes(texts)


def test_recall_against_all_pairs(spark):
    """Copies edited at one to four of 300 words: of the pairs of 0.8 and more, at least 0.99 share a class, and no pair without a chain of links does."""
    rng = random.Random(40)
    texts = []
    for k in range(40):
        base = [f"t{k}w{rng.randrange(900)}" for _ in range(300)]
        texts.append(" ".join(base))
        for _ in range(5):
            words = list(base)
            for at in rng.sample(range(300), rng.randint(1, 12)):
                words[at] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    want = exact_classes(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    found = sum(got[i] == got[j] for i, j in pairs)
    assert len(pairs) > 100 and found >= 0.99 * len(pairs)
    assert all(want[i] == want[j] for i in range(len(texts)) for j in range(i) if got[i] == got[j])


def test_every_link_in_blocks(spark, monkeypatch):
    """A hub that comes last in every bucket still joins what only it is alike to."""
    monkeypatch.setattr(near_dedup, "PIVOTS", 0)
    texts = star(random.Random(5), 25, 5)
    docs = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    want = exact_classes(texts)
    groups = collections.defaultdict(set)
    for i, c in enumerate(want):
        groups[c].add(100 - i)
    assert {d: min(g) for g in groups.values() for d in g} == got


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(8)
    sampler = near_dedup.Sampler(1024)
    grams = near_dedup.mix(rng.integers(1, 1 << 62, 300).astype(np.uint64))
    one, other = rng.uniform(0.5, 3, 200), rng.uniform(0.5, 3, 200)
    a = dict(zip(grams[:200].tolist(), one))
    b = dict(zip(grams[60:260].tolist(), other))
    b.update({k: a[k] for k in grams[60:160].tolist()})
    keys = sorted(set(a) | set(b))
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    x, y = (sampler.samples(np.array(list(v), np.uint64), np.array(list(v.values()))) for v in (a, b))
    assert abs((x == y).mean() - want) < 0.05


@pytest.mark.parametrize("n", [1, 300, 1024, 2500])
def test_samples_are_the_least_of_all_values(monkeypatch, n):
    """Against every value worked out; few are, where sets are large."""
    rng = np.random.default_rng(n)
    sampler = near_dedup.Sampler(64)
    grams = near_dedup.mix(rng.integers(1, 1 << 62, n).astype(np.uint64))
    grams[n // 2 :: 2] ^= np.uint64(1)  # some share their random numbers with a neighbour
    weights = (1 + rng.integers(0, 30, n) ** 3 * rng.random(n)).astype(np.float32)
    draw = ((grams[:, None] * sampler.factors) >> np.uint64(48)).astype(np.int64)
    level, value = sampler._values(draw, np.log(weights)[:, None])
    first = value.argmin(0)
    won = level[first, np.arange(64)].astype(np.int64).view(np.uint64)
    want = near_dedup.mix(grams[first] ^ (won * np.uint64(0x9E3779B97F4A7C15)))
    plain, sizes = near_dedup.Sampler._values, []
    monkeypatch.setattr(near_dedup.Sampler, "_values", lambda self, draw, log_w: sizes.append(draw.size) or plain(self, draw, log_w))
    assert (sampler.samples(grams, weights) == want).all()
    assert n < 300 or sum(sizes) < 64 * n / 2


def test_shingles_of_more_texts_than_16_bits_count():
    texts = ["a b c d e f a b c d e", "", "one two"] * 30_000
    raw = [t.encode() for t in texts]
    text, grams, counts = near_dedup.shingles(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, raw)))]))
    assert len(text) == 30_000 * 7 and (np.diff(text) >= 0).all() and counts.sum() == 30_000 * 8
    assert (np.bincount(text, minlength=90_000).reshape(-1, 3) == [6, 0, 1]).all()
    assert (grams.reshape(-1, 7) == grams[:7]).all() and (np.diff(grams.reshape(-1, 7)[:, :6].astype(object)) > 0).all()


def test_document_frequencies_cover_all_documents(spark):
    docs = spark.createDataFrame([(i, "one two three four five" + (" six" if i % 2 else "")) for i in range(100)], "doc_id bigint, text string")
    data = np.frombuffer(b"one two three four five six", np.uint8)
    _, grams, _ = near_dedup.shingles(data, np.array([0, len(data)]))
    weights = sorted(near_dedup.cell_weights(docs.repartition(7))[near_dedup._cell(grams)].tolist())
    assert np.allclose(weights, [1.0, 1 + np.log(2) / np.log(101)])


@pytest.mark.parametrize("cells", ["own", "one"])
def test_weights_by_exact_document_frequencies(spark, monkeypatch, cells):
    """Frequencies counted here by the words themselves; shingles whose hashes share a cell do not count for one another."""
    if cells == "one":
        monkeypatch.setattr(near_dedup, "_cell", lambda grams: np.zeros(len(grams), np.int64))
    monkeypatch.setattr(near_dedup, "SHARE", 4000)  # several buckets
    monkeypatch.setattr(near_dedup, "BODY", 2000)
    rng = random.Random(21)
    texts = [" ".join(f"{rng.choice('abc')}{rng.randrange(4)}" for _ in range(rng.randint(5, 60))) for _ in range(150)]
    texts += [texts[7], texts[7]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)

    def runs(text):
        words = text.split()
        return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    df = collections.Counter(run for text in texts for run in runs(text))
    nodes = docs.filter("doc_id % 3 = 1").select(near_dedup._text_hash().alias("node")).distinct()
    got = {r.node: r.vector for r in near_dedup._vectors(docs, nodes, len(texts)).collect()}
    hashes = {r.doc_id: r.node for r in docs.select("doc_id", near_dedup._text_hash().alias("node")).collect()}
    assert set(got) == {hashes[i] for i in range(len(texts)) if i % 3 == 1}
    for i in range(1, len(texts), 3):
        want = sorted(n * (1 + np.log(len(texts) / df[run]) / np.log(len(texts) + 1)) for run, n in runs(texts[i]).items())
        assert np.allclose(sorted(near_dedup._vector(got[hashes[i]])[1]), want)


def test_a_shared_cell_links_nothing(spark, monkeypatch):
    """Texts of one common passage and five words of their own: 0.82 alike by plain counts, 0.70 by weights."""
    monkeypatch.setattr(near_dedup, "_cell", lambda grams: np.zeros(len(grams), np.int64))
    common = " ".join(f"c{i}" for i in range(50))
    texts = [common + "".join(f" u{d}x{i}" for i in range(5)) for d in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r.doc_id, r.class_id) for r in near_dedup.classes(docs).collect()} == {(d, d) for d in range(60)}


def test_odd_rows(odd, none):
    got = near_dedup.classes(odd).collect()
    assert len(got) == 13
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.class_id)
    assert by_id[3] == {2} and by_id[1] == {1}
    assert by_id[4] == by_id[5] == {4}  # null, empty, and a row without any value
    assert by_id[6] == {6} and by_id[7] == {7}
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [-9, 1, 2, 4, 6, 7, 8, 1 << 62]
    assert near_dedup.classes(none).collect() == [] and near_dedup.deduplicated(none).collect() == []
