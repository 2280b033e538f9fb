"""Repeated windows of words and bytes against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from llm_rows import none, odd  # noqa: F401

from millrace.llm import substring_dedup, suffix_dedup, superkmers
from millrace.llm.blocks import sliding_min


def removed(units, span):
    """Flags of the units of each text covered by a window that starts anywhere else."""
    counts = collections.Counter(tuple(u[i : i + span]) for u in units for i in range(len(u) - span + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - span + 1):
            if counts[tuple(u[i : i + span])] > 1:
                gone[i : i + span] = [True] * span
        out.append(gone)
    return out


def texts(seed):
    """Random texts that share passages, hold some twice, and repeat single words and letters."""
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("aa bb cc dd ee".split()) for _ in range(rng.randint(20, 60))) for _ in range(4)]
    out = []
    for _ in range(30):
        parts = []
        for _ in range(rng.randint(1, 5)):
            if rng.random() < 0.4:
                parts.append(rng.choice(shared))
            else:
                parts.append(" ".join(f"x{rng.randint(0, 40)}" for _ in range(rng.randint(1, 50))))
        out.append(rng.choice([" ", "\n", "  "]).join(parts))
    return [*out, out[0], out[0], "word " * 200, "ab" * 300, "", " \t"]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("span,seed", [(35, 4), (8, 3)])
def test_words(spark, span, seed):
    values = texts(span)
    units = [t.encode().split() for t in values]
    got = {r.doc_id: r for r in substring_dedup.repeat_digests(frame(spark, values), span, seed).collect()}
    for i, (words, gone) in enumerate(zip(units, removed(units, span))):
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        assert (got[i].n_words, got[i].n_removed) == (len(words), sum(gone)), i
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_bytes(spark):
    values = texts(3)
    units = [t.encode() for t in values]
    got = {r.doc_id: r for r in suffix_dedup.repeat_digests(frame(spark, values)).collect()}
    for i, (data, gone) in enumerate(zip(units, removed(units, 200))):
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = len([x for x in "".join("1" if g else " " for g in gone).split() if x])
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(data), sum(gone), runs), i
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def strings(values, multi=True):
    data = "".join(values).encode()
    n = len(values)
    return superkmers.Strings(
        np.ones(n, np.uint64), np.arange(n), np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool), np.full(n, multi),
        np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum([len(v.encode()) for v in values])]),
    )


def test_words_are_counted_by_their_words_where_hashes_collide(monkeypatch):
    values = [t for t in texts(5) if len(t.split()) >= 8]
    units = [v.split() for v in values]
    counts = collections.Counter(tuple(u[i : i + 8]) for u in units for i in range(len(u) - 7))
    want = [counts[tuple(u[i : i + 8])] > 1 for u in units for i in range(len(u) - 7)]
    monkeypatch.setattr(substring_dedup, "mix", lambda h: h & np.uint64(7))
    assert substring_dedup.count_windows(strings(values), 8).tolist() == want


def test_suffixes_are_sorted_by_their_bytes_where_hashes_lie(monkeypatch):
    values = [t for t in texts(6) if len(t) >= 40]
    counts = collections.Counter(v[i : i + 40] for v in values for i in range(len(v) - 39))
    want = [counts[v[i : i + 40]] > 1 for v in values for i in range(len(v) - 39)]
    assert suffix_dedup.count_suffixes(strings(values), 40).tolist() == want
    true = suffix_dedup.Suffixes.common

    def lie(self, p, q):
        out = true(self, p, q)
        return np.where((p + q) % 3 == 0, np.minimum(out + 7, self.span), out)

    monkeypatch.setattr(suffix_dedup.Suffixes, "common", lie)
    assert suffix_dedup.count_suffixes(strings(values), 40).tolist() == want


def test_sliding_min():
    values = np.random.default_rng(0).integers(0, 100, 300)
    for width in (1, 2, 31, 32, 177):
        assert sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(300 - width + 1)]


def test_a_repeated_string_is_settled_in_the_flush_it_fills():
    """A passage in every text of a flush travels once, not once per text."""
    from millrace.llm.substring_dedup import word_units

    def shipped(copies):
        data = np.frombuffer(b"".join([(" ".join(f"w{i}" for i in range(90)) + " ").encode()] * copies), np.uint8)
        offsets = np.arange(copies + 1) * (len(data) // copies)
        flush = superkmers.Flush(4, 35)
        flush.add(data, word_units(data, offsets), 4, np.arange(copies), np.arange(copies))
        return sum(len(superkmers._unpack([blob]).least) for _, kind, blob in flush.rows() if kind == superkmers.STRINGS)

    assert shipped(500) == shipped(1)


FOOTER = " ".join(f"foot{i}" for i in range(20))


@pytest.mark.parametrize("module,bound", [(substring_dedup, 2.0), (suffix_dedup, 2.0)])
def test_a_footer_in_every_text_fills_no_bucket(spark, module, bound):
    """Different texts with one footer, shorter than a window: no bucket holds twice the median."""
    rng = random.Random(2)
    footer = FOOTER if module is substring_dedup else FOOTER[:110]
    values = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(120)) + "\n" + footer for _ in range(1200)]
    docs = frame(spark, values)
    if module is substring_dedup:
        seed, span, span_bytes, units = 4, 35, 210, substring_dedup.word_units
    else:
        seed, span, span_bytes, units = 24, 200, 200, suffix_dedup.byte_units
    total = sum(map(len, values))
    common = superkmers.common_cells(superkmers.keyed(docs), seed, span_bytes, total // 16, total, units)
    assert common is not None and common.sum() < 300

    def sizes(flags):
        data = np.frombuffer("".join(values).encode(), np.uint8)
        flush = superkmers.Flush(64, span, flags)
        flush.add(data, units(data, np.concatenate([[0], np.cumsum([len(v) for v in values])])), seed, np.arange(len(values)), np.arange(len(values)))
        packed = [len(superkmers._unpack([blob]).data) for _, kind, blob in flush.rows() if kind == superkmers.STRINGS]
        return max(packed) / np.median(packed)

    assert sizes(common) < bound < sizes(None)


def test_common_grams_set_back_change_no_result(spark, monkeypatch):
    rng = random.Random(12)
    values = [t + "\n" + FOOTER for t in texts(9)] + [FOOTER + " " + FOOTER] * 2 + [FOOTER]
    rng.shuffle(values)
    for module in (substring_dedup, suffix_dedup):
        plain = {r.doc_id: tuple(r) for r in module.repeat_digests(frame(spark, values)).collect()}
        asked = []
        true = superkmers.common_cells
        with monkeypatch.context() as m:
            m.setattr(superkmers, "common_cells", lambda docs, seed, span_bytes, bucket_bytes, total, units: asked.append(true(docs, seed, span_bytes, total // 50, total, units)) or asked[-1])
            assert {r.doc_id: tuple(r) for r in module.repeat_digests(frame(spark, values)).collect()} == plain
        assert asked[0] is not None and asked[0].any()


def test_odd_rows(odd, none):
    for module in (substring_dedup, suffix_dedup):
        got = module.repeat_digests(odd).collect()
        assert len(got) == 13
        by_id = {r.doc_id: r for r in got}
        empty = hashlib.sha256(b"").hexdigest()
        assert by_id[4].kept_sha256 == by_id[5].kept_sha256 == empty
        assert by_id[2].n_removed == by_id[3].n_removed > 0  # equal texts
        assert by_id[8].n_removed == by_id[8][1] - (0 if module is substring_dedup else 0)  # one phrase over and over
        assert module.repeat_digests(none).collect() == []
        assert len(module.remove_repeats(odd).collect()) == 13
