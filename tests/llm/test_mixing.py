from __future__ import annotations

from collections import defaultdict
from fractions import Fraction
from hashlib import md5

from helpers import documents, odd_texts
from orderloom.llm import mixing
from pyspark.sql import functions as F


def brute_targets(sizes):
    """Exact targets, sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, out, open_ = sum(sizes.values()), {}, set(order)
    while True:
        left, share = total - sum(out.values()), sum(weights[s] for s in open_)
        now = {s: Fraction(left * weights[s], share) for s in open_} if share else {}
        over = {s for s in open_ if now[s] > 3 * sizes[s]}
        if not over:
            return out | now
        out |= {s: 3 * sizes[s] for s in over}
        open_ -= over


def check(docs, got):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len((text or "").encode().split())
    want = brute_targets(sizes)
    taken = defaultdict(int)
    assert len(got) == len(docs)
    for r in got:
        assert r["mix_source_size"] == sizes[r["source"]] and abs(r["mix_target"] - want[r["source"]]) < 1e-6
        own = r["mix_passes"] * r["mix_size"] + r["mix_cut"]
        assert 0 <= r["mix_cut"] <= r["mix_size"] and own <= 3 * r["mix_size"]
        taken[r["source"]] += own
    return taken, want


def rows(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_exact_budgets(spark):
    texts = [(i, " ".join("w" * (i % 7 + 1) for _ in range(i * 37 % 91)), "en", [None, "b", "a", "ä", "\U0001f600"][min(4, i % 9)], 0) for i in range(500)]
    docs = documents(spark, texts)
    for digits in (3, 1):
        got = mixing.mix(docs, range_digits=digits).collect()
        taken, want = check(rows(docs), got)
        assert all(taken[s] == int(want[s]) for s in want)


def test_cut_follows_the_random_order(spark):
    docs = documents(spark, [(i, "w " * (i % 5 + 1), "en", "one" if i % 4 else "two", 0) for i in range(200)])
    got = mixing.mix(docs).collect()
    for source in ("one", "two"):
        own = sorted((md5(f"{r['doc_id']}:7".encode()).hexdigest(), r) for r in got if r["source"] == source)
        whole = [r["mix_cut"] == r["mix_size"] for _, r in own]
        edge = whole.index(False) if False in whole else len(whole)
        assert all(whole[:edge]) and all(r["mix_cut"] == 0 for _, r in own[edge + 1 :])


def test_reruns_and_partitions_agree(spark):
    docs = documents(spark, [(i, "w " * (i % 11), "en", f"s{i % 3}", 0) for i in range(300)])
    again = mixing.mix(docs.repartition(7, "n_chars").repartition(5))
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, again.collect()))


def test_odd_rows(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    texts = [*odd_texts(), (None, "a b c", None, None, None), (3, "a b", "", "s1", 0), (3, "a b", "", "s1", 0), (9, None, None, "empty", 0)]
    docs = documents(spark, texts).selectExpr("*", "1 AS key", "2 AS size", "3 AS target", "4 AS source_size")
    taken, want = check(rows(docs), mixing.mix(docs).collect())
    assert all(abs(taken[s] - want[s]) < 2 for s in want)


def test_repeated_rows_come_near_targets(spark):
    docs = documents(spark, [(i, "w " * (i % 11), "en", "big" if i % 3 else f"s{i % 4}", 0) for i in range(2000)])
    want = {r["source"]: r["mix_target"] for r in mixing.mix(docs).collect()}
    out = mixing.repeated(mixing.mix(docs))
    assert out.columns == docs.columns
    got = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()}
    assert all(abs(got[s] - want[s]) <= 11 for s in want)
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
