from __future__ import annotations

import itertools
import math
import random
import re
import time
from collections import Counter

import pytest
from helpers import documents, odd_texts
from orderloom.llm import secrets
from orderloom.llm.queries import op2_secrets
from pyspark.sql import functions as F

KEY = re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
RUN = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]


def runs(text, signs, least):
    """(start, end) of the longest runs of some characters."""
    at = 0
    for own, part in itertools.groupby(text, signs.__contains__):
        n = sum(1 for _ in part)
        if own and n >= least:
            yield at, at + n
        at += n


def entropy(text, window):
    best = None
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window]).values()
        value = -sum(c / window * math.log2(c / window) for c in counts)
        best = value if best is None else max(best, value)
    return best


def harmless(own):
    """The allow list in plain words."""
    low = own.lower()
    if re.fullmatch("[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", low) or re.match("sha(1|256|384|512)[-=_]", low):
        return True
    if any(w in low for w in ("example", "sample", "dummy", "placeholder", "changeme", "xxxx", "0123456789", "abcdefghij")):
        return True
    if not any(c.isdigit() for c in own) or not any(c.isalpha() for c in own):
        return True
    parts = re.split("[-_/=+]+", own)
    return parts[0] != "" and all(p == "" or p.isdigit() or p.isalpha() for p in parts)


def brute(text):
    """All spans as (start, rank, kind, end), by plain Python."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in KEY.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(s, 2, "hex", e) for s, e in runs(text, set("0123456789abcdef"), 24)]
    base = list(found)
    for s, e in runs(text, RUN, 20):
        own = text[s:e]
        if any(a < e and s < b for a, _, _, b in base) or harmless(own):
            continue
        hexadecimal = set(own.lower()) <= set("0123456789abcdef")
        if entropy(own.lower() if hexadecimal else own, 20) >= (3.0 if hexadecimal else 3.9) - 1e-9:
            rank = 3 if hexadecimal else 4
            found.append((s, rank, KINDS[rank], e))
    return sorted(found)


def texts():
    pick = random.Random(2)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    made = ["".join(pick.choice(b64) for _ in range(n)) for n in (19, 20, 21, 40, 64, 300)]
    return [
        *odd_texts(),
        "é password = \"hunter22\" x\U0001f600 TOKEN:abcdef, secret=token: abcdefgh api_key=abcde Api_Key: 'a.b/c+d=e'",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "Z9" * 10, "0123456789abcdef01234567", "f" * 23, "f" * 24 + "G" + "0" * 30,
        "DEADBEEF" * 4, *made, " | ".join(made), "12345678-1234-1234-1234-123456789abc", "sha256-" + made[3], "EXAMPLE" + made[3],
        "/usr/local/share/documents/reports", "a" * 30 + "1", "password: " + made[4] + " " + made[4], "token='" * 500, "9" * 40, "abc123" * 8,
        *["".join(pick.choice(h) for _ in range(n)) for h in ("0123456789ABCDEF", "0123456789abcdefABCDEF") for n in (20, 32, 64)],
        "secret=token: abcdefgh", made[4] + "password=abcdefgh.x " + made[3], "token: abcdef" + made[3] + "." + made[5], "a\uffff" + made[3] + "\uffffb", "password\uffff= abcdefgh",
        "-" + "ab-12-" * 20, "ab-12-" * 20 + "x9y", made[5] * 6, ("quiet-1quiet " * 30 + made[3] + " ") * 3,
    ]


def test_spans_equal_brute_force(spark):
    docs = documents(spark, texts())
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["found"]] for r in secrets.scan_secrets(docs).collect()}
    for i, text in enumerate(texts()):
        assert got[i] == [(s, k, e) for s, _, k, e in brute(text)], repr(text)[:80]
    assert any(k == "entropy_base64" for own in got.values() for _, k, _ in own)


def test_incremental_entropy_equals_counting(spark):
    _, alphabet, window, _ = secrets.CLASSES[1]
    pick = random.Random(3)
    own = ["".join(pick.choice(alphabet[:n]) for _ in range(pick.randint(1, 60))) for n in (1, 2, 5, 40, 67) for _ in range(8)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(own)], "i int, t string")
    for r in df.select("i", secrets.window_entropy(F.col("t"), alphabet, window).alias("e")).collect():
        want = entropy(own[r["i"]], window)
        assert (r["e"] is None) == (want is None) and (want is None or abs(r["e"] - want) < 1e-9)


def test_query_equals_brute_force(spark, folder):
    folder = folder.replace("0.001", "0.01")
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op2_secrets(spark, folder).collect()
    assert len(got) == len(docs) and sum(r["n_assign"] for r in got) > 0
    for r in got:
        want = brute(docs[r["doc_id"]])
        assert r["spans"] == ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == kind for _, _, k, _ in want) for kind in KINDS[:3])


def test_planted_keys_of_each_class_are_found(spark):
    pick = random.Random(8)
    key = lambda signs, n: "".join(pick.choice(signs) for _ in range(n))
    upper, mixed = "0123456789ABCDEF", "0123456789abcdefABCDEF"
    b64 = "".join(sorted(RUN - set("=_-")))
    planted = [f"see {key(s, n)} there" for s, n in ((upper, 32), (upper, 64), (mixed, 40), (mixed, 64), (b64, 40), (b64, 88)) for _ in range(20)]
    found = [r["found"] for r in secrets.scan_secrets(documents(spark, planted)).orderBy("doc_id").collect()]
    assert sum(any(s["start"] == 4 and s["end"] == len(t) - 6 for s in f) for f, t in zip(found, planted)) >= 0.97 * len(planted)


LONG = {
    "words": lambda n: "see " + "ab-12-" * (n // 6),
    "blob": lambda n: "data:" + "".join(random.Random(n).choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnop0123456789+/") for _ in range(n)),
    "quiet": lambda n: "a1b2" * (n // 4),
    "matches": lambda n: "token: abcdef " * (n // 14),
    "candidates": lambda n: "".join(f"Zx{i:09}Qw{i:08} " for i in range(n // 22)),
}


@pytest.mark.parametrize("kind", LONG)
def test_time_grows_with_the_text(spark, kind):
    def seconds(n):
        df = documents(spark, [LONG[kind](n)])
        began = time.perf_counter()
        rows = secrets.scan_secrets(df).collect()
        return time.perf_counter() - began, len(rows[0]["found"])

    seconds(2_000)
    small, large = seconds(300_000), seconds(1_200_000)
    assert large[0] < 8 * small[0] + 4 and large[0] < 40
    assert large[1] >= small[1]


def test_clashing_columns(spark):
    df = documents(spark, ["token: abcdef", None]).withColumns({c: F.lit(1) for c in ("found", "start", "end", "kind", "own")})
    got = secrets.scan_secrets(df)
    assert got.columns == ["doc_id", "found"] and sorted(len(r["found"]) for r in got.collect()) == [0, 1]


def test_no_python_in_the_plan(spark, folder):
    plan = op2_secrets(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
