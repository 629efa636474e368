from __future__ import annotations

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, odd_texts, prose
from hypothesis import given, settings, strategies as st
from orderloom.llm import packing
from orderloom.llm.queries import op1_packing, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def brute(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [2]


def check(pieces, docs, plain, capacity=4096):
    """Every id of every document once, sequences gapless and within capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc_id, text in docs:
        ids, at = brute(plain, text), 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            want = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(want)
            at += p["length"]
        assert at == len(ids)
    padding = total = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        total += at
    return padding / total


def test_query_equals_brute_force(spark, folder, plain):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert check(op1_packing(spark, folder).collect(), docs, plain) < 0.05


def test_odd_texts(spark, plain):
    texts = [*odd_texts(), "It's <|endoftext|> <|ENDOFTEXT|> we'll DON'T é É ÀB Σας don't...", "İstanbul ΑΣ. x_y!!", " ab　cd"]
    docs = documents(spark, texts)
    pieces = packing.pack(docs, tokenizer_path(), capacity=512, batch_tokens=5000).collect()
    by_doc = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        by_doc[p["doc_id"]].append(p)
    for i, text in enumerate(texts):
        ids = b"".join(p["tokens"] for p in by_doc[i])
        assert np.frombuffer(ids, "<u4").tolist() == brute(plain, text), repr(text)[:60]


def test_empty_table_null_id_and_sequences(spark):
    assert packing.pack(documents(spark, []), tokenizer_path()).count() == 0
    docs = documents(spark, [(None, prose(3, 900), "en", "s", 0), (None, None, None, None, None), (1, "x", "en", "s", 0)])
    pieces = packing.pack(docs, tokenizer_path(), capacity=256)
    whole = packing.sequences(pieces, 256).collect()
    assert all(len(r["tokens"]) // 4 in (256, r["n_tokens"]) for r in whole)
    assert sum(r["n_tokens"] for r in whole) == sum(r["length"] for r in pieces.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 400), max_size=60))
def test_plan_is_a_partition_within_capacity(lengths):
    pieces = packing.plan(lengths, 128)
    covered, windows = defaultdict(int), defaultdict(list)
    for doc, start, n, window, offset in sorted(pieces, key=lambda p: (p[0], p[1])):
        assert start == covered[doc]
        covered[doc] += n
        windows[window].append((offset, n))
    assert [covered[i] for i in range(len(lengths))] == lengths
    for own in windows.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 128
    assert sorted(windows) == list(range(len(windows)))


def test_differencing_levels_windows():
    sizes = np.random.default_rng(1).integers(1, 4000, 2000)
    sums = np.bincount(packing.differencing(sizes, 300), sizes, 300)
    assert sums.max() - sums.min() <= 0.03 * sums.mean()


def test_differencing_small_case():
    sums = np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])
    assert sorted(sums.tolist()) == [14, 16]


@pytest.mark.parametrize("text", ["the of and to in is was for on", None])
def test_many_short_texts_take_bounded_memory(text):
    n = 60_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([text] * n, pa.string())], ["id", "text"])
    packing.word_ids(tokenizer_path()).ids(text)
    each, windows, starts = len(packing.word_ids(tokenizer_path()).ids(text)) // 4 + 1, defaultdict(list), defaultdict(dict)
    tracemalloc.start()
    peak = 0
    for out in packing._pieces(iter([batch]), tokenizer_path(), 2, packing.CAPACITY, packing.BATCH_TOKENS):
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()  # what the test itself keeps is not counted
        for doc, start, length, window, offset in zip(*(out.column(c).to_pylist() for c in (0, 1, 2, 5, 6))):
            windows[window].append((offset, length))
            starts[doc][start] = length
        tracemalloc.start()
    tracemalloc.stop()
    assert peak < 30e6
    assert len(starts) == n and all(sum(own.values()) == each for own in starts.values())
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_every_letter_before_a_mark_is_encoded_like_the_tokenizer():
    import sys

    from orderloom.llm.packing import WordIds
    from tokenizers import Tokenizer

    path = tokenizer_path()
    plain, words = Tokenizer.from_file(path), WordIds(path)
    made = [c + m for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalpha() for m in (".", "a,")]
    made += ["BELEDİYESİ.", "HAKKARİ, VAN", "aİ!!", "क़.", "İ.İ,"]
    want = plain.encode_batch(made, add_special_tokens=False)
    wrong = [t for t, w in zip(made, want) if words.ids(t) != np.array(w.ids, "<u4").tobytes()]
    assert wrong == []
