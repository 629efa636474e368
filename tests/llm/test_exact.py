from __future__ import annotations

import hashlib
import re

import pytest
from helpers import documents, odd_texts
from orderloom.llm import exact


def brute(docs):
    groups = {}
    for i, text in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i))
    return {
        i: (min(groups[norm])[1], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest())
        for i, text in docs for norm in [re.sub(r"[\x20\x09-\x0D]", "", text or "")]
    }


def test_equals_brute_force_with_split_buckets(spark):
    texts = odd_texts() + [f"text {i % 40} {'same' * (i % 3)}" + " " * (i % 5) for i in range(300)] + ["hot\ttext" + " " * (i % 2) for i in range(200)]
    docs = documents(spark, texts)
    want = brute(list(enumerate(texts)))
    for rows in (exact.BUCKET_ROWS, 3):
        got = exact.exact_duplicates(docs, bucket_rows=rows).collect()
        assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got) and len(got) == len(texts)


def test_index_buckets_hold_their_key_range(spark):
    docs = documents(spark, [f"t{i}" for i in range(500)])
    index = exact.build_index(docs, bucket_rows=20).table.collect()
    order = sorted(index, key=lambda r: r["key"] % (1 << 64))
    assert [r["bucket"] for r in order] == sorted(r["bucket"] for r in index)
    assert len({r["bucket"] for r in index}) > 8 and all(r["chain"] == 0 for r in index)


@pytest.mark.parametrize("bits", [0, 3, 7])
def test_colliding_keys_are_told_apart_by_bytes(spark, bits):
    """With few key bits most texts share a key with others, copies included."""
    texts = odd_texts() + [f"text {i % 60} {'same' * (i % 3)}" + " " * (i % 5) for i in range(300)] + ["hot\ttext" + " " * (i % 2) for i in range(200)]
    docs = documents(spark, texts)
    index = exact.build_index(docs, key_bits=bits)
    chains = {}
    for r in index.table.collect():
        chains.setdefault(r["key"], []).append((r["chain"], r["chained"]))
    assert len(chains) <= 1 << bits and max(map(len, chains.values())) > 1
    assert all(sorted(c) == [(i, len(c)) for i in range(len(c))] for c in chains.values())
    got = exact.exact_duplicates(docs, key_bits=bits).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == brute(list(enumerate(texts)))
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got) and len(got) == len(texts)


def test_directory_doubles_only_overfull_buckets():
    assert exact.directory({0: 5, 1: 5, 2: 1}, 3, 6) == [0, 1, 2, 2, 3, 3, 3, 3]
    assert exact.directory({}, 2, 1) == [0, 0, 0, 0]
    assert exact.directory({3: 100}, 2, 1) == [0, 0, 1, 2]


def test_repeats_null_ids_and_empty_table(spark):
    assert exact.exact_duplicates(documents(spark, [])).count() == 0
    rows = [(None, "a b", None, None, None), (1, "a b", "en", "s", 1), (1, "a b", "en", "s", 1), (-5, "ab", "en", "s", 1), (2, None, "", "", 0)]
    got = sorted((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(documents(spark, rows)).collect())
    assert got == [("-5", 1, 4, False), ("1", 1, 4, True), ("1", 1, 4, True), ("2", 2, 1, True), ("None", 1, 4, False)]


def test_clashing_columns(spark):
    docs = documents(spark, ["a", "a ", "b"]).selectExpr("*", "1 AS norm", "2 AS rank", "3 AS digest", "4 AS keep_id", "5 AS points")
    assert {r["doc_id"]: r["keep_id"] for r in exact.exact_duplicates(docs).collect()} == {0: 1, 1: 1, 2: 2}
