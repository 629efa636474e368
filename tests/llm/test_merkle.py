from __future__ import annotations

import hashlib
import zlib

import pytest
from helpers import documents, odd_texts
from orderloom.llm import merkle
from pyspark.sql import functions as F

LOW = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes, at, own):
    """(root, siblings, folded) of one tree, bottom up."""
    proof = []
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        run, place = runs[at // 8], at % 8
        proof += run[:place] + run[place + 1 :]
        own = sha("".join(run[:place] + [own] + run[place + 1 :]))
        nodes, at = [sha("".join(r)) for r in runs], at // 8
    return nodes[0], proof, own


def brute(rows):
    made = []
    for row in rows:
        doc_id, text = row[0], row[1]
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        own = leaf(*row)
        made.append((row[2], doc_id, own, leaf(doc_id, text and text.translate(LOW), *row[2:]) if hit else own))
    order = lambda v: (v is not None, b"" if v is None else v.encode() if isinstance(v, str) else v)
    langs = sorted({m[0] for m in made}, key=order)
    trees = {lang: sorted((m for m in made if m[0] == lang), key=lambda m: ((m[1] is not None, m[1] or 0), m[2])) for lang in langs}
    subroots = [climb([m[2] for m in trees[lang]], 0, "")[0] for lang in langs]
    out = []
    for i, lang in enumerate(langs):
        for j, (_, doc_id, own, changed) in enumerate(trees[lang]):
            _, below, folded = climb([m[2] for m in trees[lang]], j, changed)
            root, above, folded = climb(subroots, i, folded)
            out.append((doc_id, own, subroots[i], root, sha("".join(below + above)), folded, folded == root))
    return sorted(out, key=str)


def rows(n):
    texts = odd_texts()
    langs = ["en", "de", None, "é", "Z", "z", "en", "en"]
    made = [(i * 7 % n, (texts[i % len(texts)] or "")[:300] + f" Word{i}", langs[i % 8], f"s{i % 3}", i) for i in range(n)]
    return made + [(None, None, "en", None, None), (None, "A", "en", None, None), (3, "Twice", "en", "s", 1), (3, "Twice", "en", "s", 1), (5, "", None, "s", -2)]


@pytest.mark.parametrize("share", [merkle.HEAVY_SHARE, 20, 1])
def test_proofs_equal_brute_force(spark, share):
    made = rows(300)
    got = merkle.document_manifest(documents(spark, made), heavy_share=share).collect()
    assert sorted(map(tuple, got), key=str) == brute(made)
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)


@pytest.mark.parametrize("made", [
    [(1, "A b", "en", "s", 3)], [(i, f"T{i}", "en", "s", 0) for i in range(9)], [(i, "T", f"l{i:02}", "s", 0) for i in range(70)], [(0, "X", None, None, None)] * 20,
])
def test_small_trees(spark, made):
    assert sorted(map(tuple, merkle.document_manifest(documents(spark, made)).collect()), key=str) == brute(made)


def test_empty_table_and_clashing_columns(spark):
    none = merkle.document_manifest(documents(spark, []))
    assert none.collect() == [] and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    made = rows(30)
    extra = documents(spark, made).withColumns({c: F.lit(i) for i, c in enumerate(("leaf", "id", "tree", "idx", "n", "level", "group", "digest", "step"))})
    assert sorted(map(tuple, merkle.document_manifest(extra).collect()), key=str) == brute(made)


def test_the_climb_is_a_recursive_query_and_leaves_settings_alone(spark):
    before = spark.conf.get(merkle._ROW_LIMIT, None)
    merkle.document_manifest(documents(spark, rows(20))).count()
    assert spark.conf.get(merkle._ROW_LIMIT, None) == before
    assert "WITH RECURSIVE" in merkle._CLIMB
