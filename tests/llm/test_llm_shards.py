"""Shards and Order MinHash against plain Python."""

import hashlib
import random

import pytest
import xxhash
from llm_rows import none, odd  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import order_minhash, shards


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, "copy" if i % 3 == 0 else "x" * rng.randint(0, 300)) for i in range(1001)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_law_of_rows(docs):
    got = shards.shard_digests(docs).toPandas()
    assert len(got) == 1001 and got.doc_id.nunique() == 1001
    sizes = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert len(sizes) == 8 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["count"] - 1).all() and (sizes["nunique"] == sizes["count"]).all()
    assert (got.law == "rows").all() and got.grown_shard.isna().all()


def test_the_order_depends_on_rows_and_seed_only(docs):
    def order(frame, **how):
        return {r.doc_id: (r.shard, r.slot) for r in shards.shuffled(frame, bucket_bytes=10_000, **how).collect()}

    one = order(docs)
    assert one == order(docs.repartition(7).orderBy(F.desc("doc_id")))
    assert one != order(docs, seed=3)
    # Uniform: places are not tied to ids, and copies are spread over the shards.
    places = [one[i][0] * 126 + one[i][1] for i in range(1001)]
    assert sum(a < b for a, b in zip(places, places[1:])) in range(430, 570)
    copies = [one[i][0] for i in range(0, 1001, 3)]
    assert all(20 <= copies.count(s) <= 65 for s in range(8))


def test_fisher_yates():
    counts = {}
    for seed in range(6000):
        order = tuple(shards.fisher_yates(3, seed))
        counts[order] = counts.get(order, 0) + 1
    assert len(counts) == 6 and all(850 < n < 1150 for n in counts.values())
    assert shards.fisher_yates(0, 1) == [] and sorted(shards.fisher_yates(50, 1)) == list(range(50))


def test_shards_of_odd_rows(odd, none):
    assert shards.shard_digests(odd).count() == 13
    assert set(shards.shuffled(odd).columns) == set(odd.columns)
    assert shards.shard_digests(none).collect() == []


# --- Order MinHash ---------------------------------------------------------------

def hashed(*values):
    """Spark's xxhash64 of strings and longs; nulls pass the seed on."""
    seed = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else (v & (2**64 - 1)).to_bytes(8, "little")
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_signature(text):
    import re

    tokens = [hashed(t) for t in re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text)]
    if not tokens:
        return []
    grams = [hashed(*(tokens[i : i + 5] + [None] * 5)[:5]) for i in range(max(len(tokens) - 4, 1))]
    seen, bins = {}, {}
    for at, gram in enumerate(grams):
        key = gram >> 26
        number = seen.get(key, 0)
        seen[key] = number + 1
        e = hashed_numbered(key, number)
        bins.setdefault(e & 63, []).append(((e & (2**64 - 1)) >> 33, at))
    out = []
    for b in sorted(bins):
        least = sorted(bins[b])[:2]
        tuple_hash = hashed(*[b << 31 | rank for rank, _ in sorted(least, key=lambda x: x[1])])
        value = b << 25 | tuple_hash & ((1 << 25) - 1)
        out.append(value - (1 << 32) if value >= 1 << 31 else value)
    return out


def hashed_numbered(key, number):
    seed = xxhash.xxh64_intdigest((key & (2**64 - 1)).to_bytes(8, "little"), 42)
    # The number is an int: Spark hashes four bytes of it.
    seed = xxhash.xxh64_intdigest((number & (2**32 - 1)).to_bytes(4, "little"), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_likeness(a, b):
    filled = {v >> 25 for v in a} | {v >> 25 for v in b}
    return len(set(a) & set(b)) / len(filled) if filled else 1.0


def test_signatures_and_edits(spark):
    rng = random.Random(2)
    words = ["ab", "cd", "ef", "é", "long" * 9, "x"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(40)] + ["", "one", "same line\n" * 400]
    rows = [(i * 977 - 5000, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in order_minhash.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    rows.sort(reverse=True)
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, other = plain_signature(text), plain_signature(edited)
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{v & 0xFFFFFFFFFFFFFFFF:016x}"[-8:] for v in own), (doc_id, text)
        assert r.edited_fingerprint == "".join(f"{v & 0xFFFFFFFFFFFFFFFF:016x}"[-8:] for v in other)
        assert r.near_edited == pytest.approx(plain_likeness(own, other))
        assert r.near_next == pytest.approx(plain_likeness(own, plain_signature(after)))


def test_rows_without_an_id_are_spread(spark):
    """Ten thousand of them: every row has its own next one, they come last, and no group is large."""
    docs = spark.range(10_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('text of row ', id) AS text")
    docs = docs.unionAll(spark.createDataFrame([(7, "seven"), (-3, "least")], "doc_id bigint, text string"))
    chained = order_minhash.with_next(docs).select("doc_id", F.col("own.text").alias("text"), F.col("next.text").alias("next")).cache()
    assert chained.count() == 10_002
    assert rows_of(chained.select("next")) == rows_of(chained.select("text"))  # each text follows once
    by_text = {r.text: r.next for r in chained.filter("doc_id IS NOT NULL").collect()}
    assert by_text["seven"] == "least" and by_text["least"].startswith("text of row")
    assert chained.filter("next = 'seven'").first().doc_id is None
    groups = docs.filter("doc_id IS NULL").groupBy(F.pmod(F.xxhash64("text"), F.lit(order_minhash._ABSENT))).count()
    assert groups.agg(F.max("count")).first()[0] < 20


def test_likeness_follows_order():
    """The same k-mers in another order are less alike; a small edit leaves much alike."""
    base = [f"w{i}" for i in range(400)]
    swapped = base[200:] + base[:200]
    edited = base[:100] + ["new"] + base[101:]
    own = plain_signature(" ".join(base))
    near, far = plain_likeness(own, plain_signature(" ".join(edited))), plain_likeness(own, plain_signature(" ".join(swapped)))
    assert near > 0.9 > 0.7 > far


def test_no_python_in_the_plan(spark, docs):
    plan = order_minhash.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_fingerprints_of_odd_rows(odd, none):
    got = order_minhash.fingerprints(odd).collect()
    assert len(got) == 13
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].fingerprint == by_id[3].fingerprint != ""
    assert by_id[4].fingerprint == by_id[5].fingerprint == "" and by_id[4].near_next in (0.0, 1.0)
    assert order_minhash.fingerprints(none).collect() == []
