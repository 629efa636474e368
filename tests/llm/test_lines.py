from __future__ import annotations

import random
import re

from helpers import documents, odd_texts, prose
from orderloom.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(docs, near=20):
    """{(id, line): (id, line) of the earliest line it repeats}."""
    seen, out = [], {}
    for i, text in sorted(docs):
        for n, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
            if not norm:
                continue
            for place, other in seen:
                close = min(len(norm), len(other)) >= near and abs(len(norm) - len(other)) <= 1 and distance(norm, other) <= 1
                if norm == other or close:
                    out[(i, n)] = place
                    break
            seen.append(((i, n), norm))
    return out


def edited(text, pick):
    at = pick.randrange(len(text))
    return pick.choice([text[:at] + "Q" + text[at:], text[:at] + text[at + 1 :], text[:at] + "é" + text[at + 1 :]])


def planted(n=60):
    pick = random.Random(4)
    base = [prose(100 + i, pick.choice([3, 5, 9, 40])).replace("\n", " ") for i in range(12)]
    base += ["page number 1000000 of the book", "aaaaaaaaaaaaaaaaaaaaaaaa", "abababababababababababab"]
    texts = []
    for _ in range(n):
        own = []
        for _ in range(pick.randint(1, 4)):
            line = pick.choice(base)
            for _ in range(pick.choice([0, 1, 1, 2])):
                line = edited(line, pick) if len(line) > 1 else line
            own.append(pick.choice(["", " ", "\t"]) + line)
        texts.append("\n".join(own))
    return texts


def test_equals_brute_force(spark):
    texts = [*planted(), *[f"page number 10000{i:02d} of the book" for i in range(60)], None, "", "\n \n"]
    got = lines.duplicate_lines(documents(spark, texts)).collect()
    want = brute(list(enumerate(texts)))
    assert {(r["doc_id"], r["line_no"]): (r["keep_id"], r["keep_line_no"]) for r in got} == want
    assert len(got) == len(want)


def test_long_and_odd_texts(spark):
    long = prose(9, 4000).replace("\n", " ")
    texts = [*odd_texts(), long, long[:9000] + "Q" + long[9001:], long[1:], long[:-4]]
    texts[10] = texts[11] = None  # brute force on these would take minutes
    n = len(texts)
    got = {(r["doc_id"], r["line_no"]): (r["keep_id"], r["keep_line_no"]) for r in lines.duplicate_lines(documents(spark, texts)).collect()}
    want = brute(list(enumerate(texts[: n - 4])))
    assert got == want | {(n - 3, 0): (n - 4, 0), (n - 2, 0): (n - 4, 0)}


def test_short_lines_only_when_equal(spark):
    got = lines.duplicate_lines(documents(spark, ["Of.", "Or.", "Of.", "x" * 19, "x" * 18 + "y", "x" * 20])).collect()
    assert [(r["doc_id"], r["keep_id"]) for r in got] == [(2, 0)]


def test_texts_without_lines(spark):
    docs = documents(spark, ["one\ntwo\none", None, "two\n\nthree", (None, "three", None, None, None)])
    gone = lines.duplicate_lines(docs)
    left = {str(r["doc_id"]): r["text"] for r in lines.without_lines(docs, gone).collect()}
    assert left == {"0": "one\ntwo", "1": None, "2": "\nthree", "None": ""}


def test_empty(spark):
    assert lines.duplicate_lines(documents(spark, [])).count() == 0
