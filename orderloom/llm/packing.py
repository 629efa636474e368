"""Packing documents into token sequences by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CAPACITY = 4096
#: Tokens gathered before a batch is packed: about 500 windows of 4,096.
BATCH_TOKENS = 1 << 21
#: Documents gathered before a batch is packed, however short: differencing holds two
#: numbers for each of their remainders and each window, so at most about 70 MB.
BATCH_DOCS = 1 << 13
#: Words remembered per Python worker, about 160 bytes each; longer ones seldom come back.
CACHE_WORDS = 250_000
CACHE_BYTES = 16
#: ASCII punctuation and symbols: a run of them is one token group of its own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds(dict):
    """Token ids of words, as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and never merges across it, so a text's ids are
    those of its words in order. Up to ``CACHE_WORDS`` short words are remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # How byte-level vocabularies write bytes: printable ones as they are, others from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.shown = [chr(b) if b in plain else chr(next(other)) for b in range(256)]

    def _of(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if text.isalpha() and text == text.lower() and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            tokens = self.tokenizer.model.tokenize("".join([self.shown[b] for b in word]))
            return np.array([t.id for t in tokens], "<u4").tobytes()
        stem = text.rstrip(_MARKS)
        # As the vocabulary sees it: a letter that turns into one with a mark of its own would join those behind it.
        if stem and stem != text and stem.isalpha() and unicodedata.normalize("NFC", stem).lower().isalpha():
            cut = len(stem.encode())
            return self[word[:cut]] + self[word[cut:]]
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self._of(word)
        if len(self) < CACHE_WORDS and len(word) <= CACHE_BYTES:
            self[word] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        raw = (text or "").encode("utf-8", "replace")
        # Lower case first, so that words are found in the cache; not where that could make a special token.
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One cache per Python worker and vocabulary; workers live longer than tasks."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window 0..k-1 of each piece, by Karmarkar-Karp multiway differencing.

    Every piece starts as a partial partition of k subsets, all but one empty. The two
    partitions with the largest differences are merged until one is left, the largest
    subset of one with the smallest of the other, so that their imbalances cancel.
    """
    n = len(sizes)
    if k <= 1 or n == 0:
        return np.zeros(n, np.int64)
    heap, parts = [], {}
    for i, size in enumerate(sizes.tolist()):
        sums = np.zeros(k, np.int64)
        nodes = np.full(k, -1, np.int64)
        sums[0], nodes[0] = size, i
        parts[i] = (sums, nodes)
        heap.append((-size, i))
    heapq.heapify(heap)
    free, merges = n, []
    for turn in range(n, 2 * n - 1):
        (sums, nodes), (more, others) = parts.pop(heapq.heappop(heap)[1]), parts.pop(heapq.heappop(heap)[1])
        sums, more, others = sums + more[::-1], None, others[::-1]
        both = np.flatnonzero((nodes >= 0) & (others >= 0))
        joined = np.where(nodes >= 0, nodes, others)
        if len(both):
            made = np.arange(free, free + len(both))
            merges.append((made, nodes[both], others[both]))
            joined[both] = made
            free += len(both)
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]  # only differences matter
        parts[turn] = (sums, joined[order])
        heapq.heappush(heap, (-int(sums[0]), turn))
    window = np.full(free, -1, np.int64)
    (_, nodes), = parts.values()
    held = nodes >= 0
    window[nodes[held]] = np.flatnonzero(held)
    for made, left, right in reversed(merges):
        window[left] = window[made]
        window[right] = window[made]
    return window[:n]


def plan(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces of a batch: (document, start, length, window, offset), windows from 0.

    Documents of a window or more are cut into full windows first. A few tokens are cut
    off the last pieces, into windows of a power of two, which need no padding; the rest
    is differenced into windows whose mean is just below the capacity. If one exceeds it,
    the window count rises and the pieces are differenced again.
    """
    out: list[tuple[int, int, int, int, int]] = []
    window, rest = 0, []
    for doc, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            out.append((doc, start, capacity, window, 0))
            window += 1
        if n % capacity:
            rest.append((doc, n - n % capacity, n % capacity))
    total = sum(r[2] for r in rest)
    k = total // capacity
    margin = 2 * k
    while True:
        small = total - (k * capacity - margin)  # tokens for windows of a power of two
        if small > capacity or k == 0:
            k, small = (k, small) if k == 0 else (k + 1, 0)
        keep, cut, need = list(rest), [], small
        while need:
            doc, start, n = keep.pop()
            take = min(n, need)
            cut.append((doc, start + n - take, take))
            if take < n:
                keep.append((doc, start, n - take))
            need -= take
        sizes = np.array([r[2] for r in keep], np.int64)
        to = differencing(sizes, k)
        if not len(sizes) or np.bincount(to, sizes).max() <= capacity:
            break
        margin = 4 * margin if small else margin
        k += not small
    filled = np.zeros(max(k, 1), np.int64)
    for (doc, start, n), w in zip(keep, to.tolist()):
        out.append((doc, start, n, window + w, int(filled[w])))
        filled[w] += n
    window += int((filled > 0).sum()) if k else 0
    room = used = 0
    for doc, start, n in cut:
        while n:
            if not room:
                room, used = 1 << (small.bit_length() - 1), 0
            take = min(n, room)
            out.append((doc, start, take, window, used))
            start, n, used, room, small = start + take, n - take, used + take, room - take, small - take
            window += not room
    return out


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, capacity: int, batch_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    words = word_ids(path)
    context = TaskContext.get()
    window = (context.partitionId() if context else 0) << 40
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    held: list[tuple[pa.Scalar, bytes]] = []
    tokens = 0

    def packed() -> Iterator[pa.RecordBatch]:
        nonlocal window, tokens
        pieces = plan([len(ids) // 4 for _, ids in held], capacity)
        # A document's pieces leave together in windows' order; slices of bounded size.
        for at in range(0, len(pieces), 4096):
            some = pieces[at : at + 4096]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([held[p[0]][0].as_py() for p in some], ids_type),
                    pa.array([p[1] for p in some], pa.int64()),
                    pa.array([p[2] for p in some], pa.int64()),
                    pa.array([held[p[0]][1][4 * p[1] : 4 * (p[1] + p[2])] for p in some], pa.binary()),
                    pa.array([len(held[p[0]][1]) // 4 for p in some], pa.int64()),
                    pa.array([window + p[3] for p in some], pa.int64()),
                    pa.array([p[4] for p in some], pa.int64()),
                ],
                ["id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"],
            )
        window += 1 + max((p[3] for p in pieces), default=-1)
        held.clear()
        tokens = 0

    ids_type = None
    for batch in batches:
        ids_type = batch.schema.field(0).type
        for doc, text in zip(batch.column(0), batch.column(1)):
            ids = words.ids(text.as_py()) + end
            if ids:
                held.append((doc, ids))
                tokens += len(ids) // 4
            if tokens >= batch_tokens or len(held) >= BATCH_DOCS:
                yield from packed()
    if held:
        yield from packed()


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 2,
    capacity: int = CAPACITY,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens.

    Columns: id, start (the document's tokens before the piece), length, tokens
    (little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset (gapless from 0
    in the sequence). Each scan task packs its rows in batches of ``batch_tokens`` tokens or
    ``BATCH_DOCS`` documents, whichever comes first, without a shuffle; ids of sequences are made of partition and count, so a task that runs again
    makes the same ones. A null or empty text has its end token only, or no piece if
    there is no end token. Repeated rows are packed once each; null ids are kept.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, tokens binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(lambda batches: _pieces(batches, tokenizer, end_id, capacity, batch_tokens), schema)
        .withColumnRenamed("id", id_col)
    )


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per sequence: (sequence_id, tokens, n_tokens), padded unless a power of two long."""
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "tokens"))).alias("parts"),
    )
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["tokens"]))
    due = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(F.lit(capacity) - F.col("n_tokens"))
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), due.cast("int")))
    return whole.select("sequence_id", F.concat(joined, pad).alias("tokens"), "n_tokens")
