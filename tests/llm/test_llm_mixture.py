"""The mix against targets dealt in fractions, subset sums against all sums, and the rules of the contract."""

import itertools
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL, rows
from llm_rows import none, odd  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import mixture
from millrace.llm.queries import QUERIES

COLUMNS = ["doc_id", "size", "source_size", "target", "taken", "source"]


def dealt(sizes, weights=mixture.WEIGHTS, share=Fraction(3, 2), most=2):
    """Targets by the rule as it is told: shares by weight, the excess of those above dealt again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, Fraction(0)), set(), share * sum(sizes.values())
    while left and len(full) < len(names):
        rest = sum(weight[s] for s in names if s not in full)
        for s in set(names) - full:
            target[s] += left * weight[s] / rest
        left = Fraction(0)
        for s in set(names) - full:
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = Fraction(most * sizes[s])
                full.add(s)
    return target


def checked(found, docs):
    """The rules that hold for any mix; gives each source's taken words less its target."""
    sizes, targets, taken = defaultdict(int), {}, defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    wanted = dealt(sizes)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in found) == Counter(
        (i, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), s) for i, text, s in docs
    )
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(wanted[r["source"]]), rel=1e-12)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    return {s: taken[s] - targets[s] for s in targets}


def test_nearest_sum_is_the_best_of_all():
    chance = np.random.default_rng(4)
    for _ in range(300):
        lengths = sorted(chance.choice(np.arange(1, 30), chance.integers(1, 5), replace=False).tolist())
        counts = chance.integers(0, 4, len(lengths)).tolist()
        goal = float(chance.uniform(0, 1.2 * sum(n * c for n, c in zip(lengths, counts)) + 3))
        found = mixture.nearest_sum(lengths, counts, goal)
        assert all(0 <= k <= c for k, c in zip(found, counts))
        best = min(abs(sum(n * k for n, k in zip(lengths, ks)) - goal) for ks in itertools.product(*[range(c + 1) for c in counts]))
        assert abs(sum(n * k for n, k in zip(lengths, found)) - goal) == pytest.approx(best)


def test_counts_fit_a_large_budget():
    chance = np.random.default_rng(9)
    lengths = sorted(chance.choice(np.arange(3, 30_000), 400, replace=False).tolist())
    counts = chance.integers(1, 5_000_000, 400).tolist()
    total = sum(n * c for n, c in zip(lengths, counts))
    for budget in (0.0, 1.0, total * 0.37, total - 5.0, float(total), total * 2.0):
        found = mixture.fit_counts(lengths, counts, budget)
        assert all(0 <= k <= c for k, c in zip(found, counts))
        assert abs(sum(n * k for n, k in zip(lengths, found)) - min(budget, total)) <= (lengths[0] if budget < 3 or total - budget < 6 else 0.5)
    found = mixture.fit_counts(lengths, counts, total * 0.37)  # every length gives its share
    assert max(abs(k / c - 0.37) for k, c in zip(found, counts) if c > 10_000) < 0.01


def test_a_document_longer_than_the_window():
    long = 3 * mixture.RESERVE
    assert mixture.fit_counts([long], [2], 1.2 * long) == [1]
    assert mixture.fit_counts([long], [2], 1.8 * long) == [2]
    assert mixture.fit_counts([7, long], [3, 1], long - 3.0) == [0, 1]


def test_query_meets_its_targets(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    df = QUERIES["op12_mixture"](spark, SMALL)
    assert df.columns == COLUMNS
    found = df.collect()
    off = checked(found, docs)
    sums = defaultdict(lambda: {0})  # of all subsets of a source's documents
    for _, text, source in docs:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sums[source] |= {x + size for x in sums[source]}
    for source, x in off.items():
        r = next(r for r in found if r["source"] == source)
        left = r["target"] % r["source_size"] if r["target"] < 2 * r["source_size"] else 0.0
        if left <= mixture.RESERVE:
            assert abs(x) == pytest.approx(min(abs(y - left) for y in sums[source]), abs=1e-6)
        else:
            assert abs(x) <= 1


def test_sources_above_their_bound_pass_on_the_rest(spark):
    docs = [(i, "w " * (1 + i % 9), f"s{i % 7}" if i % 3 else "s0") for i in range(400)]
    docs += [(1000 + i, "a b c", None) for i in range(5)] + [(2000, "x " * 500, "")] + [(3000, None, "empty"), (3001, " \t", "empty")]
    off = checked(mixture.plan(spark.createDataFrame(docs, "doc_id int, text string, source string").repartition(7)).collect(), docs)
    assert abs(off[""]) <= 250 and off["empty"] == 0 and all(abs(x) <= 3 for s, x in off.items() if s)


def test_one_source_and_many(spark):
    docs = [(i, "w " * (i + 1), "only") for i in range(20)]
    assert abs(checked(mixture.plan(spark.createDataFrame(docs, "doc_id int, text string, source string")).collect(), docs)["only"]) <= 0.5
    docs = [(i, "w " * 10, f"{i:04d}") for i in range(500)]
    checked(mixture.plan(spark.createDataFrame(docs, "doc_id int, text string, source string")).collect(), docs)


def test_reruns_and_partitions_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.unionAll(docs.filter("doc_id < 40"))  # repeated rows
    first = rows(mixture.plan(docs))
    assert first == rows(mixture.plan(docs)) == rows(mixture.plan(docs.repartition(9).sortWithinPartitions(F.desc("doc_id"))))
    assert first != rows(mixture.plan(docs, seed=2))


def test_many_equal_rows_are_split(spark):
    df = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("one two three").alias("text"), F.lit("hot").alias("source"))
    df = df.unionAll(spark.range(60).selectExpr("id", "repeat('w ', int(id))", "'b'"))
    found = mixture.plan(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 3 for r in found)


def test_odd_rows(spark, odd, none):  # noqa: F811
    found = mixture.plan(odd).collect()
    checked(found, [tuple(r) for r in odd.select("doc_id", "text", "source").collect()])
    assert mixture.plan(none).count() == 0 and mixture.plan(none).columns == COLUMNS
    assert mixture.mixed(none).columns == none.columns


def test_mixed_rows_are_the_plan(spark, odd):  # noqa: F811
    docs = odd.unionByName(spark.read.parquet(f"{SMALL}/documents.parquet"), allowMissingColumns=True)
    mixed = mixture.mixed(docs)
    assert mixed.columns == docs.columns
    size = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t-\r]+"), lambda w: w != ""))
    by_row = mixed.groupBy("doc_id", "source").agg(F.sum(size).cast("bigint").alias("taken"))
    by_plan = mixture.plan(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("taken")).filter("taken > 0")
    assert rows(by_row) == rows(by_plan)
