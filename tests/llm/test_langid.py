from __future__ import annotations

import zlib
from collections import Counter

from helpers import documents, odd_texts
from orderloom.llm import langid
from orderloom.llm.queries import op7_language
from pyspark.sql import functions as F


def slow_grams(text):
    folded = "".join((c.lower()[0] if c.isalpha() else "\1") for c in text)
    found = Counter()
    for word in folded.split("\1"):
        padded = f"\1{word}\1"
        found.update(c for c in word)
        for n in (2, 3):
            found.update(padded[i : i + n] for i in range(len(padded) - n + 1) if word and "\1" not in padded[i + 1 : i + n - 1])
    return found


def as_text(gram):
    out = []
    gram = int(gram)
    while gram:
        out.append(chr(gram & 0x1FFFFF))
        gram >>= 21
    return "".join(reversed(out))


def test_grams_equal_brute_force(monkeypatch):
    for text in ["Über den  Wolken, 12 x-y", "a", "ab", "É", "no", "\U00010400\U0001f600 x", "ß ſ İ"]:
        assert {as_text(g): n for g, n in zip(*langid.grams(text))} == slow_grams(text), text
    text = "ab cd " * 50
    whole = langid.grams(text)
    monkeypatch.setattr(langid, "_CHUNK", 16)
    assert all((a == b).all() for a, b in zip(whole, langid.grams(text)))


def test_held_out_accuracy_and_folds(spark, folder):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet").collect()}
    got = op7_language(spark, folder.replace("0.001", "0.01")).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and len(docs[r["doc_id"]]["text"]) > 50]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held) > 0
    assert all(0 <= r["score"] <= 1 for r in got)


def test_only_learning_documents_count(spark):
    texts = [(i, "aa ab ac" if i % 2 else "xx xy xz", "A" if i % 2 else "X", "s", 0) for i in range(200)]
    docs = documents(spark, texts)
    flipped = docs.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("Q")).otherwise(F.col("lang")))
    assert langid.fit(docs) == langid.fit(flipped)
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_odd_texts_and_no_learning(spark):
    docs = documents(spark, [*odd_texts(), "123 !!"])
    assert {r["lang_pred"] for r in langid.predict(docs, {}).collect()} == {"und"}
    profiles = {"one": langid.top(*langid.grams("the thing and the other")).tolist()}
    for r in langid.predict(docs.withColumn("score", F.lit("clash")), profiles).collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"], r["score"] > 0 or letters) == (("one", True) if letters else ("und", False))
    assert langid.fit(documents(spark, [])) == {} and langid.fit(documents(spark, [(0, "a", None, None, 0)])) == {}


def test_ties_go_to_the_first_name(spark):
    same = langid.top(*langid.grams("abc")).tolist()
    assert langid.nearest("abc", *langid.ranks({"b": same, "a": same}))[0] == "a"


def test_query_equals_brute_force(spark, folder):
    """Profiles, out-of-place distances, choices and scores of every document, in plain Python."""
    docs = [r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    number = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    ranked = lambda counts: sorted(counts, key=lambda g: (-counts[g], number(g)))[: langid.PROFILE]
    learned = {}
    for r in docs:
        if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            learned.setdefault(r["lang"], Counter()).update(slow_grams(r["text"]))
    places = {lang: {g: i for i, g in enumerate(ranked(counts))} for lang, counts in sorted(learned.items())}
    got = {r["doc_id"]: r for r in op7_language(spark, folder).collect()}
    assert len(got) == len(docs)
    for r in docs:
        own = ranked(slow_grams(r["text"] or ""))
        pred, score = got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["score"]
        if not own:
            assert (pred, score) == ("und", 0.0)
            continue
        apart = {lang: sum(abs(i - known[g]) if g in known else langid.PROFILE for i, g in enumerate(own)) for lang, known in places.items()}
        best = min(apart, key=apart.get)
        assert pred == best and abs(score - (1 - apart[best] / (langid.PROFILE * len(own)))) < 1e-12
