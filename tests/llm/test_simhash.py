from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash
from helpers import documents, odd_texts
from orderloom.llm import simhash
from orderloom.llm.components import components
from orderloom.llm.queries import op3_simhash
from orderloom.llm.stages import stage


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest id reachable over links of three bits or fewer; prints: {id: fingerprint}."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    root = {}
    for at, i in enumerate(ids):
        if i in root:
            continue
        root[i], todo = i, [at]
        while todo:
            close = np.flatnonzero(np.bitwise_count(values ^ values[todo.pop()]) <= 3)
            for c in close.tolist():
                if ids[c] not in root:
                    root[ids[c]] = i
                    todo.append(c)
    return root


def test_query_equals_brute_force(spark, folder):
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = slow_components(prints)
    got = op3_simhash(spark, folder).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {i: (prints[i], want[i]) for i in prints}
    assert len(got) == len(prints)


def planted(n=400, seed=5):
    """Chains and clusters of fingerprints, with hot bytes and repeats."""
    pick = random.Random(seed)
    values = [0, 0, 2**64 - 1]
    for _ in range(n // 8):
        value = pick.getrandbits(64) if pick.random() < 0.5 else pick.getrandbits(24)
        for _ in range(8):
            values.append(value)
            for bit in pick.sample(range(64), pick.randint(0, 4)):
                value ^= 1 << bit
    return {i: v for i, v in enumerate(values)}


def test_links_and_long_lists_equal_brute_force(spark):
    prints = planted()
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()]
    docs = stage(spark.createDataFrame(rows, "doc_id bigint, fp bigint"), "test")
    want = slow_components(prints)
    for long_list in (64, 5, 1):
        got = simhash.near_duplicates(docs, long_list=long_list).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert len(got) == len(prints)


def test_shared_postings_tell_how_many_bytes_are_equal():
    assert len(set(simhash.POSTINGS)) == 28 and {len(p) for p in simhash.POSTINGS} == {4}
    for n_equal in range(9):
        for equal in combinations(range(8), n_equal):
            shared = sum(set(p) <= set(equal) for p in simhash.POSTINGS)
            assert (shared >= simhash.LEAST_SHARED) == (n_equal >= 5)


def test_links_are_the_pairs_within_three_bits(spark):
    values = sorted(set(planted(seed=8).values()))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = simhash.links(stage(spark.createDataFrame(signed, "fp bigint"), "test"), long_list=len(values)).collect()
    close = {(a, b) for (a,), (b,) in combinations(sorted(signed), 2) if ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert close and {tuple(r) for r in got} == close and len(got) == len(close)


def test_fingerprints_of_odd_texts(spark):
    docs = documents(spark, odd_texts())
    got = docs.select("doc_id", simhash.fingerprint_column(docs["text"]).alias("fp")).collect()
    for r, text in zip(sorted(got), odd_texts()):
        assert r["fp"] % (1 << 64) == slow_fingerprint(text)


def test_runs_of_words_do_not_matter(monkeypatch):
    text = " ".join(map(str, range(1000)))
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_RUN", 7)
    assert simhash.fingerprint(text) == want


def test_empty_and_null(spark):
    schema = "doc_id bigint, fp bigint"
    assert simhash.near_duplicates(stage(spark.createDataFrame([], schema), "test")).count() == 0
    docs = stage(spark.createDataFrame([(None, 5), (3, 5), (4, None)], schema), "test")
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.near_duplicates(docs).collect()) == [("3", 3), ("None", 3)]


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(300)] + [(500, 501), (501, 500), (7, 7), (None, 1)]
    random.Random(1).shuffle(path)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 301)} | {501: 500}
