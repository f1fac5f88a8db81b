"""Benchmark decontamination: an FM-index per training shard, searched backwards for the test phrases."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.llm.text import WORD_CHARS, byte_column, pieces, ranges, span_hashes, spans

SHARD_BYTES = 2 << 20
SAMPLE_EVERY = 32
#: Bytes of benchmark text whose phrases are searched in one pass; a larger benchmark takes several.
BENCHMARK_BLOCK = 16 << 20


class Phrases(NamedTuple):
    """Distinct windows of benchmark words (by hash) and the items that hold them."""

    words: np.ndarray  # one row per window, shorter ones padded on the left with 0
    lengths: np.ndarray
    items: np.ndarray  # item ids, window after window
    item_ends: np.ndarray


def phrases(texts: list[tuple[int, str]], width: int) -> Phrases:
    """Windows of ``width`` words of every item; an item of fewer words, but not none, is one window."""
    found: dict[tuple[int, ...], set[int]] = {}
    for item, text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _ = spans(data, np.array([0, len(data)]), WORD_CHARS)
        hashes = span_hashes(data, starts, ends, lower=True).tolist()
        for k in range(max(1, len(hashes) - width + 1) if hashes else 0):
            found.setdefault(tuple(hashes[k : k + width]), set()).add(item)
    words = np.zeros((len(found), width), np.uint64)
    for row, window in enumerate(found):
        words[row, width - len(window) :] = window
    items = [sorted(x) for x in found.values()]
    return Phrases(
        words,
        np.array([len(x) for x in found], np.int64),
        np.array([i for x in items for i in x], np.int64),
        np.cumsum([len(x) for x in items], dtype=np.int64),
    )


class FmIndex:
    """Words of one shard in suffix order: Burrows-Wheeler transform in a wavelet matrix, sampled positions.

    Symbol 0 ends every document. Its occurrences count as different and rank by position, so suffixes never compare
    across documents and prefix doubling ends within the longest document.
    """

    def __init__(self, symbols: np.ndarray, size: int, every: int = SAMPLE_EVERY):
        self.n = len(symbols)
        order = self._suffixes(symbols)
        transform = symbols[order - 1]  # position -1 is the last end mark
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = max(1, int(size - 1).bit_length())
        row = transform
        for level in range(self.bits - 1, -1, -1):
            ones = (row >> level) & 1
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((before, self.n - int(before[-1])))
            row = np.concatenate((row[ones == 0], row[ones == 1]))
        counts = np.bincount(symbols, minlength=size)
        self.smaller = np.cumsum(counts) - counts
        # A walk back must stop at a document's first word: end marks are equal in the transform, not in the order.
        sampled = (order % every == 0) | (transform == 0)
        self.sampled = np.zeros(self.n + 1, np.int32)
        np.cumsum(sampled, out=self.sampled[1:])
        self.positions = order[sampled]

    @staticmethod
    def _suffixes(symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        ends = np.flatnonzero(symbols == 0)
        value = symbols.astype(np.int64) + len(ends) - 1
        value[ends] = np.arange(len(ends))
        width = int(value.max()).bit_length() or 1
        depth = max(1, min(4, 62 // width, n))
        key = np.zeros(n, np.int64)
        for k in range(depth):  # the first words of a suffix in one number
            key <<= width
            key[: n - k] |= value[k:]
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        first = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[order] = group
        slots = np.flatnonzero(~(first & np.concatenate((first[1:], [True]))))  # places of order still tied
        while len(slots):
            open_ = order[slots]
            key = rank[open_] * n + rank[open_ + depth]
            moved = np.argsort(key, kind="stable")
            order[slots] = open_ = open_[moved]
            key = key[moved]
            first = np.concatenate(([True], key[1:] != key[:-1]))
            rank[open_] = np.maximum.accumulate(np.where(first, slots, 0))
            alone = first & np.concatenate((first[1:], [True]))
            slots = slots[~alone]
            depth *= 2
        return order

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        low, high = np.zeros(len(symbol), np.int64), place
        for level, (before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low

    def symbol(self, place: np.ndarray) -> np.ndarray:
        out = np.zeros(len(place), np.int64)
        for before, zeros in self.levels:
            one = before[place + 1] > before[place]
            place = np.where(one, zeros + before[place], place - before[place])
            out = out * 2 + one
        return out

    def search(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that start with each phrase, read from its last word to its first; -1 is no word."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.n, np.int64)
        for step in range(words.shape[1]):
            live = np.flatnonzero((low < high) & (step < lengths))
            if not len(live):
                break
            symbol = words[live, words.shape[1] - 1 - step]
            known = symbol >= 0
            low[live[~known]] = high[live[~known]] = 0
            live, symbol = live[known], symbol[known]
            start = self.smaller[symbol]
            low[live] = start + self.rank(symbol, low[live])
            high[live] = start + self.rank(symbol, high[live])
        return low, high

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of places in suffix order: steps back until a sampled one."""
        out, steps = np.empty(len(place), np.int64), 0
        open_, place = np.arange(len(place)), place.copy()
        while len(open_):
            known = self.sampled[place + 1] > self.sampled[place]
            out[open_[known]] = self.positions[self.sampled[place[known]]] + steps
            open_, place = open_[~known], place[~known]
            symbol = self.symbol(place)
            place = self.smaller[symbol] + self.rank(symbol, place)
            steps += 1
        return out


def _merged(starts: list[int], ends: list[int]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _search_shard(data: np.ndarray, offsets: np.ndarray, wanted: Phrases):
    """Per text: words, spans of hit words in bytes, item ids and the number of hit words."""
    starts, ends, first = spans(data, offsets, WORD_CHARS)
    count = len(offsets) - 1
    texts = np.repeat(np.arange(count), np.diff(first))
    vocabulary, symbol = np.unique(span_hashes(data, starts, ends, lower=True), return_inverse=True)
    place = np.arange(len(starts)) + texts  # each text is followed by an end mark
    symbols = np.zeros(len(starts) + count, np.int64)
    symbols[place] = symbol + 1
    index = FmIndex(symbols, len(vocabulary) + 1)
    at = np.searchsorted(vocabulary, wanted.words)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == wanted.words if len(vocabulary) else np.zeros(at.shape, bool)
    low, high = index.search(np.where(known, at + 1, -1), wanted.lengths)
    window = np.repeat(np.arange(len(low)), high - low)
    position = index.locate(ranges(low, high - low))
    text = np.searchsorted(np.flatnonzero(symbols == 0), position)
    word = position - text
    hit = np.zeros(len(starts) + 1, np.int64)
    np.add.at(hit, word, 1)
    np.add.at(hit, word + wanted.lengths[window], -1)
    hit = np.cumsum(hit[:-1]) > 0
    hits_before = np.concatenate(([0], np.cumsum(hit)))
    n_hit = hits_before[first[1:]] - hits_before[first[:-1]]
    item_starts = wanted.item_ends - np.diff(np.concatenate(([0], wanted.item_ends)))
    of_text: dict[int, tuple[list, set]] = {}
    pairs = np.unique(text * len(low) + window) if len(text) else text
    for pair in pairs.tolist():
        t, w = divmod(pair, len(low))
        of_text.setdefault(t, ([], set()))[1].update(wanted.items[item_starts[w] : wanted.item_ends[w]].tolist())
    for t in of_text:
        a, b = int(first[t]), int(first[t + 1])
        edges = np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0])))
        runs = zip(np.flatnonzero(edges == 1) + a, np.flatnonzero(edges == -1) - 1 + a, strict=True)
        of_text[t][0].extend((int(starts[p] - offsets[t]), int(ends[q] - offsets[t])) for p, q in runs)
    return np.diff(first), n_hit, of_text


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BENCHMARK_BLOCK,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per document row: ``doc_id``, ``text``, ``n_words``, ``n_hit``, ``item_ids``, ``spans`` (merged, in bytes).

    The columns named in ``keep`` pass through after these, with ``_kept`` appended to the name of a result; null text is
    given back as null.

    Words are runs of ASCII letters and digits and characters outside ASCII, ASCII letters in lower case. A phrase is
    ``width`` consecutive words of an item, or a whole shorter item. Each task indexes its documents in shards of about
    ``shard_bytes`` (a longer text is a shard of its own); no document is shuffled. The benchmark is streamed to the
    driver and broadcast in blocks of at most ``block_bytes`` (or one longer item); each further block is a further
    pass over the same rows, not a join. Words are compared by 64-bit hashes.

    Null or empty texts have no words and no hits; null items none either; repeated rows each give their row; tables
    may be empty; other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col)).where(F.col(item_text_col).isNotNull())
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<long>").alias("item_ids"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        *[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep or [])],
    )

    def searched(rows: DataFrame, block: list[tuple[int, str]]) -> DataFrame:
        shared = context.broadcast(phrases(block, width))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = byte_column(batch.column(1))
                for a, b in pieces(offsets, shard_bytes):
                    part = batch.slice(a, b - a)
                    yield _with_hits(part, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shared.value)

        return rows.mapInArrow(run, rows.schema)

    block, size, passes = [], 0, 0
    for item, text in items.toLocalIterator():
        if block and size + len(text) > block_bytes:
            found, block, size, passes = searched(found, block), [], 0, passes + 1
        block.append((item, text))
        size += len(text)
    if block or not passes:
        found = searched(found, block)
    own = set(found.columns)
    return found.withColumnsRenamed({f"keep_{k}": f"{c}_kept" if c in own else c for k, c in enumerate(keep or [])})


def _with_hits(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, wanted: Phrases) -> pa.RecordBatch:
    n_words, n_hit, of_text = _search_shard(data, offsets, wanted)
    items, places = part.column(4).to_pylist(), part.column(5).to_pylist()
    hits = n_hit.copy()
    for t, (runs, ids) in of_text.items():
        items[t] = sorted(ids.union(items[t]))
        if places[t]:  # an earlier block of the benchmark also hit this text
            runs = runs + [(p["start"], p["end"]) for p in places[t]]
        places[t] = _merged([a for a, _ in runs], [b for _, b in runs])
    for t in np.flatnonzero(part.column(3).to_numpy() > 0).tolist():
        inside = np.zeros(offsets[t + 1] - offsets[t] + 1, np.int8)
        for p in places[t]:
            inside[p["start"] : p["end"]] = 1
        text = data[offsets[t] : offsets[t + 1]]
        starts, _, _ = spans(text, np.array([0, len(text)]), WORD_CHARS)
        hits[t] = int(inside[starts].sum())
    kind = part.schema.field
    columns = [pa.array(n_words), pa.array(hits), pa.array(items, kind(4).type), pa.array(places, kind(5).type)]
    return pa.record_batch(
        [part.column(0), part.column(1), *columns, *part.columns[6:]],
        schema=part.schema,
    )


def without_spans(text_col: str = "text", spans_col: str = "spans"):
    """The text without its spans: whatever is between them, taken by byte positions, in order."""
    text, cut = F.encode(F.col(text_col), "UTF-8"), F.col(spans_col)
    size = F.octet_length(F.col(text_col)).cast("long")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda s: s["end"]))
    ends = F.concat(F.transform(cut, lambda s: s["start"]), F.array(size))
    between = F.zip_with(starts, ends, lambda a, b: F.substring(text, a.cast("int") + 1, (b - a).cast("int")))
    joined = F.decode(F.aggregate(between, F.lit(b"").cast("binary"), lambda whole, x: F.concat(whole, x)), "UTF-8")
    return F.when(F.size(cut) == 0, F.col(text_col)).otherwise(joined)


def items_digest(items_col: str = "item_ids"):
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(F.col(items_col), lambda i: i.cast("string"))), ","), 256)
