"""Secrets in text: fixed patterns and sliding-window entropy; built-in functions only."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns, and the least length of what each must match.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
#: What entropy is measured on: long runs of token characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character classes of candidates: name, characters, window, least entropy in bits. Both
#: cases of a hexadecimal digit are one character.
CLASSES = (
    ("entropy_hex", "0123456789abcdef", 20, 3.0),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=", 20, 3.9),
)
#: Candidates that are no secrets: identifiers, digests named as such, examples, counting
#: runs, runs of letters or of digits alone, and (``_worded``) words joined by marks. No
#: pattern repeats a group, which would take a stack frame for each repetition.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?i:sha1|sha256|sha384|sha512)[-=_]",
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
    r"(?i)0123456789|abcdefghij",
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
)
MARKS = r"[-_/=+]+"
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
_SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
#: Stands for what an assignment covers while candidates are looked for.
COVER = "\uffff"
#: What the same sign in a text counts as; no pattern has either.
OTHER = "\ufffe"
#: Sizes summed in one piece when starts are made of them, and characters judged at once.
PIECE, BLOCK = 512, 512


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once; inside a lambda an expression is made for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(sizes: Column, begin: Column) -> Column:
    """``begin`` plus the sum of all sizes before each one, as an array."""
    start = F.struct(begin.alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        sizes, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"]
    )


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def _pieces(array: Column, step: int, length: int) -> Column:
    """Slices of ``length`` that begin at every ``step``-th element."""
    last = F.floor((F.greatest(F.size(array), F.lit(1)) - 1) / step).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda p: F.slice(array, p * step + 1, F.lit(length)))


def starts(sizes: Column) -> Column:
    """The sum of all sizes before each one.

    An array that grows is copied with every value, so it only grows over ``PIECE`` sizes
    at a time; the sums of those pieces say where each begins.
    """
    begins = lambda pieces: _running(F.transform(pieces, _total), F.lit(0).cast("bigint"))
    return _let(sizes, lambda all_sizes: _let(
        _pieces(all_sizes, PIECE, PIECE), lambda pieces: F.flatten(F.zip_with(pieces, begins(pieces), _running))
    ))


def _found(text: Column, pattern: str, kind: str) -> Column:
    """(start, rank, kind, end, own) of all matches, leftmost first; own is the matched text.

    What lies between matches is what splitting by the pattern leaves, so starts are
    running sums of the lengths of gaps and matches.
    """
    gaps = lambda matches: F.slice(F.split(text, pattern, -1), 1, F.size(matches))  # noqa: E731 - the last has no match after it
    both = lambda matches: F.zip_with(gaps(matches), matches, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
    ends = lambda sizes: F.zip_with(starts(sizes), sizes, lambda s, n: s + n)
    typed = lambda matches, sizes: F.zip_with(ends(sizes), matches, lambda end, own: F.struct(
        (end - F.length(own)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), own.alias("own"),
    ))
    spans = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: _let(both(m), lambda sizes: typed(m, sizes)))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,own:string>>"))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "kind", "end")])).cast(_SPANS)


def _plogp(window: int) -> Column:
    """n log2 n for counts 0, 1 .. window."""
    return F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)])


def _lowest(slots: Column, alphabet: str, window: int) -> Column:
    """The least sum of n log2 n over any window of ``slots``; null if there is none."""
    table = _plogp(window)
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
        F.lit(None).cast("double").alias("least"),
    )

    def step(acc: Column, i: Column) -> Column:
        enters = F.element_at(slots, i)
        leaves = F.when(i > window, F.element_at(slots, F.greatest(i - window, F.lit(1)))).otherwise(0)
        moved = F.transform(acc["counts"], lambda n, j: n + (j + 1 == enters).cast("int") - (j + 1 == leaves).cast("int"))
        into = F.element_at(acc["counts"], enters)
        out = F.when(leaves > 0, F.element_at(acc["counts"], F.greatest(leaves, F.lit(1)))).otherwise(0)
        total = F.when(enters == leaves, acc["sum"]).otherwise(
            acc["sum"] + F.element_at(table, into + 2) - F.element_at(table, into + 1)
            + F.when(leaves > 0, F.element_at(table, F.greatest(out, F.lit(1))) - F.element_at(table, out + 1)).otherwise(0.0)
        )
        return F.struct(
            moved.alias("counts"), total.alias("sum"),
            F.when(i >= window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"),
        )

    steps = F.when(F.size(slots) >= window, F.sequence(F.lit(1), F.size(slots)))
    return F.aggregate(steps, start, step, lambda acc: acc["least"])


def _slots(text: Column, alphabet: str) -> Column:
    """The place of each character in the alphabet, from 1."""
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c))


def window_entropy(text: Column, alphabet: str, window: int) -> Column:
    """Largest Shannon entropy, in bits, of any ``window`` characters in a row.

    One pass: the counts of the characters in the window change by the one that enters
    and the one that leaves, and so does the sum of n log2 n that entropy follows from.
    Null for texts shorter than the window. All characters must be in ``alphabet``.
    """
    return F.lit(math.log2(window)) - _lowest(_slots(text, alphabet), alphabet, window) / window


def _loud(text: Column, alphabet: str, window: int, least: float) -> Column:
    """Whether any window reaches ``least`` bits: block by block, up to the first that does.

    Blocks overlap by a window less one character, so each window lies in one of them.
    """
    heard = lambda b: F.coalesce(F.lit(math.log2(window)) - _lowest(b, alphabet, window) / window >= least, F.lit(False))
    return _let(_slots(text, alphabet), lambda slots: F.exists(_pieces(slots, BLOCK, BLOCK + window - 1), heard))


def _worded(candidate: Column) -> Column:
    """Runs of letters, or of digits, joined by marks; it begins with none."""
    parts = F.split(candidate, MARKS, -1)
    return ~candidate.rlike("^" + MARKS) & F.forall(parts, lambda p: (p == "") | p.rlike("^[A-Za-z]+$") | p.rlike("^[0-9]+$"))


def _unlike(candidate: Column, allowed: Sequence[str]) -> Column:
    ok = ~_worded(candidate)
    for pattern in allowed:
        ok = ok & ~candidate.rlike(pattern)
    return ok


def secret_spans(text: Column, allowed: Sequence[str] = ALLOWED) -> Column:
    """All spans of a text, by start, then kind as listed in ``KINDS``; null counts as empty.

    Positions are code points, the end exclusive. Matches of the fixed patterns always
    stay. A candidate adds a span if it touches none of those, is neither on the allow
    list nor words joined by marks, and one of its windows reaches the entropy of the
    narrowest class it belongs to. Time grows in proportion to the text, whatever the
    number of matches and the length of a candidate.
    """
    text = F.replace(F.coalesce(text, F.lit("")), F.lit(COVER), F.lit(OTHER))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    fits = lambda size: size >= ASSIGN_LEAST
    assigned = _let(F.transform(values, F.length), lambda sizes: F.filter(_found(text, ASSIGN, "assign"), lambda s, i: fits(F.element_at(sizes, i + 1))))
    base = F.concat(
        F.when(text.rlike(ASSIGN), _plain(assigned)).otherwise(F.array().cast(_SPANS)), _plain(_found(text, ACCESS, "access")), _plain(_found(text, HEX, "hex"))
    )
    # Most texts have no candidate; the lambdas run for those that have.
    more = F.when(text.rlike(CANDIDATE), _added(text, values, fits, allowed)).otherwise(F.array().cast(_SPANS))
    return F.array_sort(F.concat(base, more))


def _added(text: Column, values: Column, fits: Callable[[Column], Column], allowed: Sequence[str]) -> Column:
    """Spans of loud candidates.

    An assignment becomes a run of one sign, of the same length, that candidates may hold,
    so a candidate that it touches shows it. Hexadecimal and access key matches lie inside
    one candidate as a whole.
    """
    narrow, wide = CLASSES
    cover = lambda m, value: F.when(fits(F.length(value)), F.repeat(F.lit(COVER), F.length(m))).otherwise(m)
    covers = F.zip_with(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)), values, cover)
    rebuilt = F.array_join(F.zip_with(F.split(text, ASSIGN, -1), covers, lambda gap, m: F.concat(gap, F.coalesce(m, F.lit("")))), "")
    covered = F.when(text.rlike(ASSIGN), rebuilt).otherwise(text)
    wide_candidate = CANDIDATE.replace("[", "[" + COVER, 1)

    def judged(s: Column) -> Column:
        own = s["own"]
        hexadecimal = own.rlike("^[0-9a-fA-F]+$")
        loud = F.when(hexadecimal, _loud(F.lower(own), *narrow[1:])).otherwise(_loud(own, *wide[1:]))
        return F.struct(
            s["start"].alias("start"), F.when(hexadecimal, KINDS.index(narrow[0])).otherwise(KINDS.index(wide[0])).alias("rank"),
            F.when(hexadecimal, narrow[0]).otherwise(wide[0]).alias("kind"), s["end"].alias("end"), (_unlike(own, allowed) & loud).alias("loud"),
        )

    touched = f"{COVER}|{ACCESS}|{HEX}"
    free = _let(covered, lambda c: F.filter(_found(c, wide_candidate, wide[0]), lambda s: ~s["own"].rlike(touched)))
    return _plain(F.filter(F.transform(free, judged), lambda s: s["loud"]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """(id, found) per document; found holds start, kind and end of every span. No shuffle.

    Null and repeated ids are kept and other columns are not read. A text of any length is
    one row; its characters, matches and candidates are gone through once.
    """
    found = docs.select(F.col(id_col), secret_spans(F.col(text_col), allowed).alias("found"))
    return found.withColumn("found", F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
