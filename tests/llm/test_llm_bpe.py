"""The transducer against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from llm_rows import none, odd  # noqa: F401
from tokenizers import Tokenizer as Library

from millrace.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as file:
        return bpe.Tokenizer(file.read())


def odd_texts():
    rng = random.Random(2)
    return [
        "", "  ", "ΑΣ ΣΑΣ Σ", "İstanbul", "a<|endoftext|>b<|startoftext|> c", "don't we'll 'sun 12345 ½²", "\x1c\x1d x\x85y z　w",
        "é é ﬁ 한국어 漢字 👍🏽 ~~~!!! ---===", "a" * 5000, "ab" * 3000 + "<|endoftext", "th" * 900 + " " + "=" * 700,
        "".join(rng.choice("etaoinshr") for _ in range(20_000)), "abcdefghijklmnopqrstuvwxyz" * 200, "x " * 40_000 + "y",
        "".join(chr(rng.randrange(32, 0x530)) for _ in range(3000)),
    ]


@pytest.mark.parametrize("i", range(15))
def test_odd_texts(ours, library, i):
    text = odd_texts()[i]
    want = library.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == want
    machine = ours.library_text()
    cut = len(want) // 3
    got = machine.feed(want[:cut]) + machine.feed(want[cut:]) + machine.finish()
    assert got == library.decode(want, skip_special_tokens=False)


def test_streaming_emits_and_keeps_a_bounded_state(ours):
    rng = random.Random(7)
    symbols = "".join(rng.choice("etaoinshrdl") for _ in range(30_000))
    machine, out, most = bpe.Transducer(ours.merges), [], 0
    at = 0
    while at < len(symbols):
        step = rng.randint(1, 400)
        out += machine.feed(symbols[at : at + step])
        most = max(most, len(machine.text))
        at += step
    out += machine.finish()
    whole = bpe.Transducer(ours.merges)
    assert out == whole.feed(symbols) + whole.finish()
    assert most < 20 * ours.merges.lookahead
    assert sum(ours.length[i] for i in out) == len(symbols)


def test_merges_of_any_list():
    """Random merge lists against the textbook loop."""
    for seed in range(30):
        rng = random.Random(seed)
        letters = "abc"
        vocab = {c: i for i, c in enumerate(letters)}
        merges = []
        while len(merges) < 12:
            a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
            if a + b not in vocab and len(a + b) < 7:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        machine = bpe.Transducer(bpe.Merges(vocab, merges, ""))
        for _ in range(40):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
            parts = list(text)
            while True:
                ranks = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not ranks:
                    break
                _, i = min(ranks)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert machine.feed(text) + machine.finish() == [vocab[p] for p in parts], (seed, text)


def test_bytes_wait_for_their_character(ours):
    machine = bpe.ByteText([bytes([b]) for b in range(256)])
    assert [machine.feed([b]) for b in "é👍".encode()] == ["", "é", "", "", "", "👍"]
    assert machine.feed([0xC3]) + machine.finish() == "�"


def test_packed_rows(ours, library):
    """What ``encode`` makes of a batch: ids and readable text of every row, also of empty ones."""
    texts = ["", "Sun, don't (we) go?", " ", "ab" * 3000 + " x", "é<|endoftext|>漢字 👍🏽"]
    rows = bpe._encoded(ours, pa.record_batch([pa.array([3, None, 5, 6, 7], pa.int64()), pa.array(texts)], ["doc_id", "text"]))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert rows.column("ids").to_pylist() == want and rows.column("n_tokens").to_pylist() == list(map(len, want))
    machines = [ours.plain_text() for _ in texts]
    assert rows.column("decoded").to_pylist() == [m.feed(own) + m.finish() for m, own in zip(machines, want)]


def test_a_worker_remembers_a_bounded_number_of_packed_tokens(library):
    """More words than the stores hold: results stay right, the stores stay within their size, and an entry is no more than its tokens."""
    with open(PATH, "rb") as file:
        small = bpe.Tokenizer(file.read(), 200)
    text = " ".join(f"w{i * 7919 % 1000}ord, q{i}" for i in range(1500))
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert 0 < len(small.fresh) + len(small.older) <= 400 and len(small.known) + len(small.known_before) <= 200
    assert len(small.ends) <= 264 and len(small.merges.follows) <= 401  # a word adds up to 64 beginnings
    assert all(type(x) is bytes and len(x) % 4 == 0 for x in small.fresh.values())
    small.forget()
    assert not (small.fresh or small.older or small.known or small.known_before or small.ends or small.merges.follows)


def test_query(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = bpe.token_digests(docs, PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd, none):
    for run in (bpe.encode, bpe.token_digests):
        got = run(odd, PATH).collect()
        assert len(got) == 13 and {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {0}
        assert run(none, PATH).collect() == []
