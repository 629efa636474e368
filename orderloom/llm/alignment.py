"""Token alignment of two tokenizers over each distinct text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.stages import attach, stage

#: A blank between two characters that are no white space: both tokenizers end a token before it.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Units remembered per Python worker; beyond it the half that is used most stays, without
#: units of more than so many characters.
CACHE_UNITS = 100_000
CACHE_CHARS = 24
#: Characters of text aligned at a time, and units tokenised in one call.
BATCH_CHARS = 1 << 20
CALL_UNITS = 5_000
#: Up to this many id pairs, 16 bytes each, their counts are broadcast.
BROADCAST_PAIRS = 2_000_000
_TEXTS = (
    "digest string, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<int>"
)
_MARK = "▁"


def _byte_level() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(other)): b for b in range(256)}


class Aligner:
    """Both tokenizers, and the alignment of units that were seen.

    A text with a blank before it is cut into units at single blanks between words. Token
    borders of both tokenizers lie there: the byte-level pattern never joins a word to a
    following blank, and no piece has a blank mark after another character. So a text's
    tokens, groups and links are those of its units in order. ``cuts`` is off for pieces
    that do not allow it; then a text is one unit.
    """

    def __init__(self, byte_path: str, piece_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        values = _byte_level()
        # An entry in other letters than those is a special token and keeps its text.
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes([values[c] for c in e]) if all(c in values for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(t) for t in self.a_bytes])
        self.b_size = np.array([len(t) for t in self.b_bytes])
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        self.signed = [b"%d%c" % (i, sign) for sign in b",|;" for i in range(self.most)]
        self.cuts = not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        """Start again without any unit. Units have numbers in the order of ``number``."""
        self.number: dict[str, int] = {}
        self.chars = 0
        self.groups: list[bytes] = []
        self.wrong: dict[int, tuple[bytes, bytes]] = {}
        self.uses = np.zeros(0, np.int64)
        self.counts = np.zeros((0, 4), np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.ends = np.zeros(1, np.int64)

    def _links(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many links each unit has, the places of all of them in ``pairs``)."""
        many = self.ends[ids + 1] - self.ends[ids]
        return many, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.ends[ids], many)

    def _shrink(self) -> None:
        """Keep the units used most, at most half as many as may be remembered."""
        units, least = list(self.number), 2
        while (self.uses >= least).sum() > CACHE_UNITS // 2:
            least += 1
        stay = [i for i in np.flatnonzero(self.uses >= least).tolist() if len(units[i]) <= CACHE_CHARS and i not in self.wrong]
        ids = np.array(stay, np.int64)
        many, place = self._links(ids)
        kept, groups, uses, counts, pairs = [units[i] for i in stay], [self.groups[i] for i in stay], self.uses[ids] // 2, self.counts[ids], self.pairs[place]
        self.forget()
        self.number, self.groups, self.uses, self.counts, self.pairs = dict(zip(kept, range(len(kept)))), groups, uses, counts, pairs
        self.chars, self.ends = sum(map(len, kept)), np.concatenate([self.ends, np.cumsum(many)])

    def units(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.cuts else [" " + text]

    @staticmethod
    def _same(ids: list[list[int]], table: list[bytes], lengths: np.ndarray, own: list[bytes], size: np.ndarray) -> bool:
        """Whether every unit's tokens have its bytes: all bytes in a row agree, and units end at equal places."""
        flat = [t for x in ids for t in x]
        ends = np.concatenate([[0], np.cumsum(lengths[np.array(flat, np.int64)])])
        at = np.cumsum([len(x) for x in ids])
        return np.array_equal(ends[at], np.cumsum(size)) and b"".join([table[t] for t in flat]) == b"".join(own)

    def _add(self, units: list[str]) -> None:
        """Tokenise and align new units, all in one row of bytes."""
        own = [u.encode() for u in units]
        ids = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)], self.b.encode([u[1:] for u in units], num_threads=1)
        size = np.array([len(u) for u in own])
        good = np.ones(len(units), bool)
        sides = list(zip(ids, (self.a_bytes, self.b_bytes)))
        if not all(self._same(side, table, lengths, own, size) for (side, table), lengths in zip(sides, (self.a_size, self.b_size))):
            for i in range(len(units)):
                a, b = (b"".join([table[t] for t in side[i]]) for side, table in sides)
                if a != own[i] or b != own[i]:
                    good[i] = False
                    self.wrong[len(self.groups) + i] = (a, b)
        which = np.flatnonzero(good)
        kept = [[side[i] for i in which.tolist()] for side in ids]
        numbers = [np.array([len(x) for x in side], np.int64) for side in kept]
        flat = [np.array([t for x in side for t in x], np.int64) for side in kept]
        a_end, b_end = np.cumsum(self.a_size[flat[0]]), np.cumsum(self.b_size[flat[1]])
        a_start, b_start = a_end - self.a_size[flat[0]], b_end - self.b_size[flat[1]]
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        # Of each first token, the second ones that share a byte with it.
        low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        many = high - low
        first = np.repeat(np.arange(len(flat[0])), many)
        second = np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        codes = flat[0][first] << 32 | flat[1][second]
        unit_ends = np.cumsum(size[which])
        of_first = np.searchsorted(unit_ends, a_start, "right")
        links = np.bincount(of_first, many, minlength=len(which)).astype(np.int64)
        groups = np.diff(np.searchsorted(both, unit_ends, "right"), prepend=0)
        counts = np.zeros((len(units), 4), np.int64)
        counts[which] = np.stack([numbers[0], numbers[1], groups, links], 1)
        # Tokens by group, those of the first tokenizer ahead, each with the sign that follows it.
        of_group = [np.searchsorted(both, end) for end in (a_end, b_end)]
        order = np.argsort(np.concatenate([2 * of_group[0], 2 * of_group[1] + 1]), kind="stable")
        last = [np.diff(g, append=-1) != 0 for g in of_group]
        signed = np.concatenate([flat[0] + self.most * last[0], flat[1] + 2 * self.most * last[1]])[order]
        written = [self.signed[c] for c in signed.tolist()]
        at, texts = 0, [b""] * len(units)
        for i, n in zip(which.tolist(), (numbers[0] + numbers[1]).tolist()):
            texts[i] = b"".join(written[at : at + n])[:-1]
            at += n
        self.groups += texts
        self.uses = np.concatenate([self.uses, np.zeros(len(units), np.int64)])
        self.counts = np.concatenate([self.counts, counts])
        self.pairs = np.concatenate([self.pairs, codes])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts[:, 3])])

    def _learn(self, units: Iterable[str]) -> None:
        missing = [u for u in dict.fromkeys(units) if u not in self.number]
        for at in range(0, len(missing), CALL_UNITS):
            some = missing[at : at + CALL_UNITS]
            self.number.update(zip(some, range(len(self.groups), len(self.groups) + len(some))))
            self.chars += sum(map(len, some))
            self._add(some)

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups digest, pairs, times) per text; no numbers if bytes differ."""
        split = [self.units(t) for t in texts]
        self._learn(u for s in split for u in s)
        for text, own in zip(texts, split):
            ids = np.fromiter(map(self.number.__getitem__, own), np.int64, len(own))
            if self.wrong and any(i in self.wrong for i in ids.tolist()):
                said = [b"".join(self.wrong[i][side] if i in self.wrong else u.encode() for i, u in zip(ids.tolist(), own)) for side in (0, 1)]
                whole = " " + text
                if said == [whole.encode()] * 2:
                    # One unit lacks bytes that another has too many; only the whole text has borders then.
                    self._learn([whole])
                    ids = np.array([self.number[whole]])
                if said != [whole.encode()] * 2 or int(ids[0]) in self.wrong:
                    yield 0, 0, 0, 0, "", [], []
                    continue
            digest = hashlib.sha256(b";".join([self.groups[i] for i in ids.tolist()])).hexdigest()
            units, often = np.unique(ids, return_counts=True)
            self.uses[units] += often
            many, place = self._links(units)
            pairs, back = np.unique(self.pairs[place], return_inverse=True)
            times = np.bincount(back, np.repeat(often, many), minlength=len(pairs)).astype(np.int32)
            yield *self.counts[ids].sum(0).tolist(), digest, pairs, times
        if len(self.number) > CACHE_UNITS or self.chars > CACHE_UNITS * CACHE_CHARS:
            self._shrink()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligned(batches: Iterator[pa.RecordBatch], byte_path: str, piece_path: str) -> Iterator[pa.RecordBatch]:
    key = (byte_path, piece_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    aligner = _ALIGNERS[key]
    names = [c.split()[0] for c in _TEXTS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def done(held: list[tuple[str, int, str]]) -> pa.RecordBatch:
        found = list(zip(*aligner.align([h[2] for h in held])))
        digests, copies, _ = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip([digests, copies, *found], types)], names)

    for batch in batches:
        held, chars = [], 0
        for digest, copies, text in zip(*batch.columns):
            held.append((digest.as_py(), copies.as_py(), text.as_py()))
            chars += len(held[-1][2])
            if chars >= BATCH_CHARS:
                yield done(held)
                held, chars = [], 0
        if held:
            yield done(held)


def aligned_texts(docs: DataFrame, byte_path: str, piece_path: str, text_col: str = "text") -> DataFrame:
    """One row per distinct text that is not empty: digest, copies, its numbers, its pairs and how often each.

    Copies meet in a shuffle by the full text, combined before it in each scan task. A
    pair is the id of the first tokenizer times 2^32 plus that of the second.
    """
    texts = docs.where(F.length(text_col) > 0).groupBy(F.col(text_col).alias("own")).agg(F.count("*").alias("copies"))
    return texts.select(F.sha2("own", 256).alias("digest"), "copies", "own").mapInArrow(
        lambda batches: _aligned(batches, byte_path, piece_path), _TEXTS
    )


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, n_texts, best): documents and texts that hold a pair linked, and whether no pair of its first id has more."""
    each = texts.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("n"), F.count("*").alias("n_texts"))
    each = stage(each, "pairs")
    first = lambda c: F.shiftright(c, 32)
    most = each.groupBy(first("pair").alias("first")).agg(F.max("n").alias("most"))
    return each.join(most, first(F.col("pair")) == F.col("first")).select("pair", "n", "n_texts", (F.col("n") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    Each distinct text is tokenised and aligned once, whatever its copies; pair counts
    weigh a text by them; measures come back by the text's digest, those of much copied
    texts by broadcast. Counts of up to ``broadcast_pairs`` pairs are broadcast; beyond it
    frequent pairs are, and the others are joined in a shuffle. Null and empty texts, and
    texts that a tokenizer does not give back byte by byte, have zeros. Null and repeated
    ids are kept; other columns are not read. A long text is aligned in its one task, and
    its links leave it as one count per different pair.
    """
    texts = stage(aligned_texts(docs, byte_path, piece_path, text_col), "aligned")
    counts = stage(pair_counts(texts), "counts")
    linked = texts.select("digest", F.inline_outer(F.arrays_zip("pairs", "times"))).select("digest", F.col("pairs").alias("pair"), "times")
    if counts.count() <= broadcast_pairs:
        met = linked.join(F.broadcast(counts), "pair")
    else:
        met = attach(linked.where("pair IS NOT NULL"), counts, "pair", "n_texts")
    sums = met.groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    measures = stage(texts.select("digest", "copies", *numbers, "groups_sha256").join(sums, "digest", "left"), "measures")
    own = F.when(F.length(text_col) > 0, F.sha2(F.col(text_col), 256))
    probes = stage(docs.select(F.col(id_col).alias("id"), own.alias("digest")), "probes")
    met = attach(probes.where("digest IS NOT NULL"), measures, "digest", "copies")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    out = met.select(F.col("id").alias(id_col), *map(zero, [*numbers, "n_best", "count_sum"]), "groups_sha256")
    without = probes.where("digest IS NULL").select(
        F.col("id").alias(id_col), *[F.lit(0).cast("bigint").alias(c) for c in [*numbers, "n_best", "count_sum"]], F.lit("").alias("groups_sha256")
    )
    return out.unionByName(without)
