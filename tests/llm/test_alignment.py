from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import documents, odd_texts, prose
from orderloom.llm import alignment
from orderloom.llm.queries import op13_alignment, tokenizer_path
from pyspark.sql import functions as F

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def tokens(text):
    """(ids, bytes) of both tokenizers over a whole text."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    if not hasattr(tokens, "both"):
        tokens.both = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        tokens.both[0].encode_special_tokens = True
        shown = {c: bytes([b]) for b, c in ((b, c) for c, b in alignment._byte_level().items())}
        assert ByteLevel().decode(["Ġa"]) == " a" and shown["Ġ"] == b" "
        tokens.shown = shown
    a, b = tokens.both
    one = a.encode(" " + text, add_special_tokens=False)
    two = b.encode(text)
    pieces = [b.id_to_piece(i) for i in two]
    return (
        (one.ids, [b"".join(tokens.shown[c] for c in t) for t in one.tokens]),
        (two, [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(two, pieces)]),
    )


def brute(texts):
    found = []
    for text in texts:
        if not text:
            found.append(None)
            continue
        (a, a_bytes), (b, b_bytes) = tokens(text)
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append(None)
            continue
        spans = []
        for side in (a_bytes, b_bytes):
            at, own = 0, []
            for t in side:
                own.append((at, at + len(t)))
                at += len(t)
            spans.append(own)
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, i, j = [], 0, 0
        for end in ends:
            left, right = [], []
            while i < len(a) and spans[0][i][1] <= end:
                left.append(str(a[i]))
                i += 1
            while j < len(b) and spans[1][j][1] <= end:
                right.append(str(b[j]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    held = Counter(p for f in found if f for p in set(f[3]))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else
        (*f[:3], len(f[3]), sum(held[p] == most[p[0]] for p in f[3]), sum(held[p] for p in f[3]), hashlib.sha256(f[4].encode()).hexdigest())
        for f in found
    ]


def texts():
    pick = random.Random(4)
    signs = "ab Z\t\n\r  　\x1c\x85é'1٣中\U0001f600.,!-_▁ "
    made = ["".join(pick.choice(signs) for _ in range(pick.randint(1, 60))) for _ in range(150)]
    return [
        *odd_texts(), "the same text", "the same text", "the same text", "a<|endoftext|>b <s> </s> <unk> <0x41>", "I'll we've 'tis ''s x's", "a ▁ b", "▁", "nul \x00 here",
        "ends with blank ", " starts", "   ", "a​b﻿", "é é ﬁ ① Ａ", "9" * 300, "= = ==  =   ====\t\t\t", "\U0001f468‍\U0001f469", prose(3, 800), *made,
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 10])
def test_equals_whole_texts(spark, limit):
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in alignment.align_documents(documents(spark, texts()), *PATHS, broadcast_pairs=limit).collect()}
    want = brute(texts())
    assert len(got) == len(want) and sum(w[0] == 0 for w in want) > 3
    for i, w in enumerate(want):
        assert got[i] == w, repr(texts()[i])[:100]


def test_small_caches_give_the_same():
    want = list(alignment.Aligner(*PATHS).align([t for t in texts() if t]))
    small = alignment.Aligner(*PATHS)
    got = []
    for t in texts():
        if t:
            got += small.align([t])
            small.forget()
    assert [(w[:5], list(w[5]), list(w[6])) for w in want] == [(g[:5], list(g[5]), list(g[6])) for g in got]


def test_query_equals_brute_force(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(docs, brute(docs.values())))
    got = op13_alignment(spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r[c] for c in NAMES) == want[r["doc_id"]]


def test_odd_tables(spark):
    assert alignment.align_documents(documents(spark, []), *PATHS).collect() == []
    assert [tuple(r) for r in alignment.align_documents(documents(spark, [None]), *PATHS).collect()] == [(0, 0, 0, 0, 0, 0, 0, "")]
    rows = [(1, "one two", "en", "s", 0)] * 2 + [(None, "one two", None, None, None)] * 2 + [(1, None, None, None, None)]
    df = documents(spark, rows).withColumns({c: F.lit(i) for i, c in enumerate(("own", "digest", "copies", "pair", "times", "n", "best", "id", "n_a"))})
    got = alignment.align_documents(df, *PATHS)
    assert got.columns == ["doc_id", *NAMES]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert len(rows) == 5 and len(set(rows)) == 3
    full = next(r for r in rows if r[0] is None)
    assert full[6] == 4 * full[4] and full[5] == full[4]


def test_bytes_that_move_between_units_leave_the_text_one_unit():
    aligner = alignment.Aligner(*PATHS)
    first, second = (aligner.a.encode(t, add_special_tokens=False).ids for t in (" house", " water"))
    assert len(first) == len(second) == 1
    for token, value in ((first[0], b" house "), (second[0], b"water")):
        aligner.a_bytes[token] = value
        aligner.a_size[token] = len(value)
    b = aligner.b.encode("house water")
    found = list(aligner.align(["house water", "house", "house water", "water water"]))
    assert found[0][:5] == found[2][:5] == (2, len(b), 1, 3, hashlib.sha256(f"{first[0]},{second[0]}|{b[0]},{b[1]}".encode()).hexdigest())
    assert found[1][:5] == found[3][:5] == (0, 0, 0, 0, "")
