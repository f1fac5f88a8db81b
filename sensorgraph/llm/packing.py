"""Packing of documents into sequences by a configuration linear program over the length histogram."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.llm.text import WHITE, byte_column, pieces, ranges, span_hashes
from sensorgraph.operators.storage import stored

#: Distinct words whose token ids a task keeps; beyond it the store starts anew (about 30 bytes a word).
KEPT_WORDS = 2_000_000
#: Rounds of multiplicative weights each time the program is solved, and sequences that are left to the filling.
ROUNDS, LEAST_SEQUENCES = 4, 32
#: Power of the length that a piece's first price is: above 1, so that short pieces, which fit anywhere, last to the end.
START = 1.1


#: Kinds of bytes: white space, ASCII letters and digits, ASCII marks, anything else (also what special tokens hold).
_KIND = np.full(256, 3, np.uint8)
_KIND[WHITE] = 0
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[ord(c) for c in '.,;:!?#$%&*()"-+=/']] = 2


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of stretches that are tokenized by themselves, and per text its range of them.

    Tokens never cross white space, nor the place where ASCII letters or digits meet one of the marks above: the
    tokenizer splits runs of letters, digits and other characters, and an apostrophe, which it may join, is no such mark.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (kind[1:] * kind[:-1] == 2) | (kind[1:] * kind[:-1] == 0)
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    if edges[0]:
        edges = np.concatenate(([0], edges))
    starts = edges[:-1][kind[edges[:-1]] > 0]
    ends = edges[1:][kind[edges[:-1]] > 0]
    return starts, ends, np.searchsorted(starts, offsets)


class WordTokens:
    """Token ids by the hash of a stretch of text in lower case, as the tokenizer reads it."""

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.forget()

    def forget(self) -> None:
        self.hashes, self.starts, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > KEPT_WORDS:
            self.forget()
        whole = data.tobytes()
        words = [whole[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        coded = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        lengths = np.array([len(x) for x in coded], np.int64)
        all_hashes = np.concatenate((self.hashes, hashes))
        all_lengths = np.concatenate((self.lengths, lengths))
        all_starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.ids = np.concatenate((self.ids, np.array([i for x in coded for i in x], np.uint32)))
        order = np.argsort(all_hashes, kind="stable")
        self.hashes, self.starts, self.lengths = all_hashes[order], all_starts[order], all_lengths[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and the number of ids per text."""
        starts, ends, first = chunks(data, offsets)
        # Special tokens are read before the case is dropped.
        lower = b"<|" not in data.tobytes()
        hashes, where = np.unique(span_hashes(data, starts, ends, lower), return_inverse=True)
        one = np.zeros(len(hashes), np.int64)
        one[where] = np.arange(len(starts))  # some occurrence of each distinct word
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        if not known.all():
            fresh = len(self.hashes) + int((~known).sum()) > KEPT_WORDS
            new = one if fresh else one[~known]
            self._learn(data, starts[new], ends[new], hashes if fresh else hashes[~known])
            at = np.searchsorted(self.hashes, hashes)
        lengths = self.lengths[at][where]
        before = np.concatenate(([0], np.cumsum(lengths)))
        counts = before[first[1:]] - before[first[:-1]] + 1
        out = np.full(int(counts.sum()), self.end_id, np.uint32)
        text_of_word = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        out[ranges(before[:-1] + text_of_word, lengths)] = self.ids[ranges(self.starts[at][where], lengths)]
        return out, counts


_KEPT: dict[tuple[str, int], WordTokens] = {}


def _coder(path: str, end_id: int) -> WordTokens:
    """One per Python worker, as loading the vocabulary takes longer than a small task; words are kept within a task."""
    if (path, end_id) not in _KEPT:
        _KEPT[path, end_id] = WordTokens(path, end_id)
    return _KEPT[path, end_id]


def pieces_of(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Token pieces of at most ``capacity``, with the task that made them and their number among its equal lengths.

    ``doc_id, piece, start, length, ids_crc32, task, nth``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = _coder(tokenizer, end_id), TaskContext.get().partitionId()
        coder.forget()  # what an earlier task of this worker left, should it have failed
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            data, offsets = byte_column(batch.column(1))
            for a, b in pieces(offsets):
                ids, counts = coder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                cut = -(-counts // capacity)
                doc, piece = np.repeat(np.arange(b - a), cut), ranges(np.zeros(b - a, np.int64), cut)
                start = piece * capacity
                length = np.minimum(counts[doc] - start, capacity)
                place = (np.cumsum(counts) - counts)[doc] + start
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * p : 4 * (p + n)]) for p, n in zip(place.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                part = batch.column(0).slice(a, b - a).take(pa.array(doc))
                columns = [part, piece.astype(np.int32), start, length, np.array(crc, np.int64)]
                columns += [np.full(len(doc), task, np.int64), nth]
                yield pa.record_batch([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], _PIECES)
        coder.forget()  # a worker outlives its tasks; words kept would stay with it through all later stages

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
    return rows.mapInArrow(run, kinds)


_PIECES = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]


def dearest_patterns(prices: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int, share: float = 0.9) -> list[np.ndarray]:
    """For every length the dearest pattern (uses per length) with it as the largest, dearest pattern first.

    A knapsack by dynamic programming over the lengths in ascending order, each taken at most as often as there are
    pieces (in bundles of 1, 2, 4, ... and the rest). Per bundle and room the last bundle taken is kept, so that the
    one pass gives all patterns. Those below ``share`` of the dearest are left out.
    """
    bundles = []
    for k, (n, many) in enumerate(zip(lengths.tolist(), np.minimum(counts, capacity // lengths).tolist(), strict=True)):
        size = 1
        while many:
            size = min(size, many)
            bundles.append((k, size, n * size))
            many, size = many - size, size * 2
    best = np.zeros(capacity + 1)
    last = np.full((len(bundles) + 1, capacity + 1), -1, np.int32)
    ends = []
    for i, (k, size, room) in enumerate(bundles):
        row = last[i + 1]
        row[:] = last[i]
        value = best[: capacity + 1 - room] + prices[k] * size
        ends.append(float(value[-1]))
        better = value > best[room:] + 1e-12
        best[room:][better] = value[better]
        row[room:][better] = i
    found = []
    for i in np.argsort(-np.array(ends), kind="stable").tolist():
        if ends[i] < share * best[capacity]:
            break
        pattern, room, at = np.zeros(len(lengths), np.int64), capacity, i
        while at >= 0:
            pattern[bundles[at][0]] += bundles[at][1]
            room -= bundles[at][2]
            at = int(last[at, room])
        found.append(pattern)
    return found


def fractional_plan(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> dict[bytes, float]:
    """Patterns with their uses in the covering program, min sum x_c with each length covered, by multiplicative weights:
    a length gets cheaper as it is covered, the knapsack gives the dearest patterns at these prices, and the uses,
    scaled to hold the total length once, are the solution."""
    weights, chosen = counts * (lengths / capacity) ** START, {}
    held = 0.0
    for _ in range(rounds):
        covered = np.zeros(len(lengths))
        for pattern in dearest_patterns(weights / counts, lengths, counts, capacity):
            used = np.flatnonzero(pattern)
            if (covered[used] >= counts[used]).any():
                continue  # covered in full in this round already
            times = float(((counts[used] - covered[used]) / pattern[used]).min())  # covers one length in full
            covered[used] += times * pattern[used]
            held += times * float(pattern[used] @ lengths[used])
            chosen[pattern.tobytes()] = chosen.get(pattern.tobytes(), 0.0) + times
        weights *= np.exp(-0.5 * covered / counts)
    scale = min(1.0, float(counts @ lengths) / held)
    return {key: times * scale for key, times in chosen.items()}


def configurations(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS, least: int = LEAST_SEQUENCES
) -> tuple[list[tuple[np.ndarray, int]], int]:
    """Patterns (count per length) with how often each is used, covering every count exactly, and how many of the
    sequences the rounded program gave.

    The program is solved on the histogram, its uses are rounded up as far as the pieces reach, and it is solved
    again on what is left, until less than ``least`` sequences are left or no tight pattern is found; those are filled
    largest first. A pattern that wastes more than 1/256 is not taken from the program.
    """
    plan: dict[bytes, int] = {}
    left = counts.astype(np.int64).copy()

    def take(pattern: np.ndarray, most: int) -> int:
        used = pattern > 0
        copies = min(most, int((left[used] // pattern[used]).min()))
        if copies > 0:
            plan[pattern.tobytes()] = plan.get(pattern.tobytes(), 0) + copies
            left[:] -= pattern * copies
        return copies

    full = np.flatnonzero(lengths == capacity)
    placed = 0
    if len(full):  # a piece of full length is a pattern of its own
        alone = np.zeros(len(lengths), np.int64)
        alone[full] = 1
        placed += take(alone, int(left[full[0]]))
    while left @ lengths > least * capacity:
        have = np.flatnonzero(left)
        solved, before = fractional_plan(lengths[have], left[have], capacity, rounds), placed
        for key, times in sorted(solved.items(), key=lambda x: (-x[1], x[0])):
            part = np.frombuffer(key, np.int64)
            if part @ lengths[have] >= capacity - capacity // 256:
                pattern = np.zeros(len(lengths), np.int64)
                pattern[have] = part
                placed += take(pattern, math.ceil(times))
        if placed == before:
            break
    while left.any():
        pattern, room = np.zeros(len(lengths), np.int64), capacity
        for k in np.flatnonzero(left)[::-1]:
            if lengths[k] <= room:
                pattern[k] = min(left[k], room // lengths[k])
                room -= int(pattern[k] * lengths[k])
        if room:
            pattern = _tighter(pattern, left, lengths, capacity)
        take(pattern, int(left.max()))
    return [(np.frombuffer(key, np.int64), n) for key, n in plan.items()], placed


def _tighter(greedy: np.ndarray, left: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The largest length left, and the fullest fit beside it: subset sums over the lengths, each used as often as left."""
    first = int(np.flatnonzero(left)[-1])
    room = capacity - int(lengths[first])
    used = np.full(room + 1, -1, np.int64)  # the length that reaches this sum last
    used[0] = len(lengths)
    for k in np.flatnonzero(left)[::-1]:
        size = int(lengths[k])
        many = min(int(left[k]) - (k == first), room // size) if size <= room else 0
        for _ in range(min(many, 8)):
            reach = np.flatnonzero(used[: room + 1 - size] >= 0) + size
            reach = reach[used[reach] < 0]
            if not len(reach):
                break
            used[reach] = k
        if used[room] >= 0:
            break
    pattern = np.zeros(len(lengths), np.int64)
    pattern[first] = 1
    at = int(np.flatnonzero(used >= 0)[-1])
    while at > 0:
        k = int(used[at])
        pattern[k] += 1
        at -= int(lengths[k])
    fits = (pattern <= left).all()
    return pattern if fits and pattern @ lengths >= greedy @ lengths else greedy


def _slots(lengths: np.ndarray, plan: list[tuple[np.ndarray, int]], capacity: int):
    """Per length, in order: how many pieces the slot takes in all, its first sequence and its place there."""
    takes: list[list[int]] = [[] for _ in range(capacity + 1)]
    first: list[list[int]] = [[] for _ in range(capacity + 1)]
    place: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = 0
    for pattern, copies in plan:
        offset = 0
        for k in np.flatnonzero(pattern)[::-1]:
            for _ in range(int(pattern[k])):
                n = int(lengths[k])
                takes[n].append(copies)
                first[n].append(sequence)
                place[n].append(offset)
                offset += n
        sequence += copies
    return [(np.cumsum(t, dtype=np.int64), np.array(f, np.int64), np.array(p, np.int64)) for t, f, p in zip(takes, first, place, strict=True)]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` so that as few sequences as possible hold them all.

    Every text, followed by the end id, is cut into pieces of ``capacity`` only if it is longer. Null and empty texts are
    one piece, the end id; repeated rows are packed each; an empty table gives no row. ``tokenizer`` is the path of a
    tokenizer file present on all executors (default: the public 49k word tokenizer).

    Pieces are written once without their ids. The driver sees one count per length, at most ``capacity`` rows, plans
    patterns, and broadcasts their slots. Every pattern taken uses up some length or all of its share, so there are about
    as many as lengths (2,232 patterns and 9,185 slots of 24 bytes for all 2,046 lengths of 31,000 sequences).
    Pieces are numbered per length from the counts of each task, and number and slots give the place without a shuffle.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    made = stored(pieces_of(docs, id_col, text_col, tokenizer, capacity, end_id), "pieces")
    by_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = stored(by_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-counts")
    histogram = by_task.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect()
    lengths = np.array([row["length"] for row in histogram], np.int64)
    counts = np.array([row["n"] for row in histogram], np.int64)
    slots = docs.sparkSession.sparkContext.broadcast(_slots(lengths, configurations(lengths, counts, capacity)[0], capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(k).to_numpy() for k in (3, 5))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                ends, first, start = slots.value[n]
                slot = np.searchsorted(ends, number[rows], "right")
                before = np.where(slot > 0, ends[slot - 1], 0)
                sequence[rows], offset[rows] = first[slot] + number[rows] - before, start[slot]
            columns = [batch.column(k) for k in range(5)] + [pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(columns, [*_PIECES[:5], "sequence_id", "offset"])

    numbered = made.join(by_task.select("length", "task", "before"), ["length", "task"]).select(
        *_PIECES[:5], (F.col("before") + F.col("nth")).alias("number")
    )
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(place, kinds)
