from __future__ import annotations

import re
from collections import Counter, defaultdict

import __spark_entry__ as registered
import corpus_pipeline
import pytest
from helpers import documents, odd_texts
from orderloom.llm.queries import tokenizer_path
from orderloom.llm.stages import stage
from test_simhash import slow_components, slow_fingerprint


@pytest.fixture(scope="module")
def results(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        made = function(spark, docs, folder)
        if name != "packing":
            assert made.columns == docs.columns
        out.append((name, docs, made := stage(made, name)))
        docs = made
    return {name: (before.collect(), after.collect()) for name, before, after in out}


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_language_keeps_what_has_letters(results):
    before, after = results["language_id"]
    assert ids(after) == ids([r for r in before if any(c.isalpha() for c in r["text"] or "")])


def test_one_of_equal_texts_stays(results):
    before, after = results["exact_dedup"]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"])].append((-len(r["text"]), r["doc_id"]))
    assert ids(after) == Counter(min(g)[1] for g in groups.values())


def test_one_of_near_texts_stays(results):
    before, after = results["simhash_dedup"]
    roots = slow_components({r["doc_id"]: slow_fingerprint(r["text"]) for r in before})
    assert ids(after) == Counter(set(roots.values()))


def test_mix_repeats_whole_documents(results):
    before, after = results["mixing"]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(texts[r["doc_id"]] == r["text"] for r in after) and max(ids(after).values()) <= 3
    words = lambda rows: sum(len(r["text"].encode().split()) for r in rows)
    assert abs(words(after) - words(before)) < 0.2 * words(before)


def test_packing_holds_every_token_of_every_row(results):
    from tokenizers import Tokenizer

    before, after = results["packing"]
    plain, held = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in after:
        held[r["doc_id"]] += r["length"]
    want = Counter()
    for r in before:
        want[r["doc_id"]] += len(plain.encode(r["text"], add_special_tokens=False).ids) + 1
    assert held == want


def test_run_is_registered_and_equals_the_stages(spark, folder, results):
    got = registered.queries()["pipeline"](spark, folder)
    assert sorted((r["doc_id"], r["start"], r["length"]) for r in got.collect()) == sorted((r["doc_id"], r["start"], r["length"]) for r in results["packing"][1])


def test_stages_take_odd_and_empty_tables(spark, folder):
    rows = [*odd_texts(), (None, "words without an id " * 9, None, None, None), (40, "one of two equal rows here " * 5, "en", "s", 0), (40, "one of two equal rows here " * 5, "en", "s", 0)]
    for docs in (documents(spark, rows), documents(spark, [])):
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, folder), name)
        left = Counter(docs.where("start = 0").select("doc_id").toPandas()["doc_id"])
    assert not left


CLASHING = ("score", "lang_pred", "mix_note", "mix_size", "own_text", "own_fp", "own_id", "fp", "id", "tokens", "row", "guess", "kept_id", "digest")


def test_columns_of_other_names_come_out_unchanged(spark, folder):
    from pyspark.sql import functions as F

    rows = [(i, f"plain words of text number {i} which differ from others by their number {i * 7919} and so on", "en", f"s{i % 2}", i) for i in range(30)]
    docs = documents(spark, rows).withColumns({c: F.col("n_chars") + i + 0.5 for i, c in enumerate(CLASHING)})
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, docs, folder), name)
        assert after.columns == docs.columns
        got = after.collect()
        assert got and all(r[c] == r["n_chars"] + i + 0.5 for r in got for i, c in enumerate(CLASHING)), name
        docs = after


def test_near_copies_without_ids_keep_one_of_each_group(spark, folder):
    words = [f"w{i}" for i in range(400)]
    near = [" ".join(words), " ".join([*words[:399], "other"]), " ".join(["first", *words[1:]])]
    far = " ".join(f"v{i}" for i in range(300))
    rows = [(None, t, "en", "s", 0) for t in [*near, *near, far]] + [(7, f"x{'y' * 40} " * 50, "en", "s", 0)] * 2
    fingerprints = {slow_fingerprint(t) for t in near}
    assert len(fingerprints) > 1 and len(set(slow_components(dict(enumerate(slow_fingerprint(t) for t in [*near, far]))).values())) == 2
    after = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), folder).collect()
    assert len(after) == 3 and sum(r["text"] in near for r in after) == 1 and sum(r["doc_id"] == 7 for r in after) == 1
