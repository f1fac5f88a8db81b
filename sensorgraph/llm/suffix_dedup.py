"""Removal of repeated byte strings by prefix-free parsing."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorgraph.llm.blocks import block_texts, bucket_bits, by_bucket, code_levels, doubled, levels_of, read_block, write_blocks
from sensorgraph.llm.text import _BYTE_CODES, PIECE_BYTES, _INVERSE, _MULTIPLIER, mixed, pieces, powers, ranges

LENGTH = 50
TRIGGER = 24
_PLACE = np.uint64((1 << 24) - 1)
_UP, _DOWN = powers(_MULTIPLIER, 2 * PIECE_BYTES), powers(_INVERSE, 2 * PIECE_BYTES)


class Phrases(NamedTuple):
    """Phrases of a block: where they start, how many strings of LENGTH bytes start in each, trigger, hash, document."""

    start: np.ndarray
    count: np.ndarray
    trigger: np.ndarray
    hash: np.ndarray
    doc: np.ndarray


def _parse_piece(data: np.ndarray, offsets: np.ndarray) -> Phrases:
    n = len(data)
    up, down = (_UP, _DOWN) if n < len(_UP) else (powers(_MULTIPLIER, n + 1), powers(_INVERSE, n + 1))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:n], out=total[1:])
    rolling = mixed((total[TRIGGER:] - total[:-TRIGGER]) * down[: n + 1 - TRIGGER])
    # The least trigger hash among the 27 of a string decides; the place in the low bits takes the first of equals.
    key = (rolling & ~_PLACE) | (np.arange(len(rolling), dtype=np.uint64) & _PLACE)
    for step in (1, 2, 4, 8):
        key = np.minimum(key[:-step], key[step:])
    reach = LENGTH - TRIGGER + 1 - 16
    key = np.minimum(key[:-reach], key[reach:])
    at = (key & _PLACE).astype(np.int64)
    doc = np.searchsorted(offsets, np.arange(len(at)), "right") - 1
    fits = np.arange(len(at)) + LENGTH <= offsets[doc + 1]
    change = np.concatenate(([True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | ~fits[:-1]))
    begin = np.flatnonzero(change & fits)
    before = np.concatenate(([0], np.cumsum(fits)))
    after = np.concatenate((begin[1:], [len(at)]))
    count = before[after] - before[begin]
    whole = (total[begin + count + LENGTH - 1] - total[begin]) * down[begin] + count.astype(np.uint64)
    return Phrases(begin, count, rolling[at[begin]], mixed(whole), doc[begin])


def parse(data: np.ndarray, offsets: np.ndarray) -> Phrases:
    """Phrases of all texts: runs of string starts that share their trigger; a phrase's bytes hold its strings whole."""
    found = []
    for a, b in pieces(offsets):
        low, high = offsets[a], offsets[b]
        step = 1 << 23  # places must fit the low bits; a longer text is parsed in parts that overlap
        for p in range(low, max(high - LENGTH + 1, low), step):
            q = min(high, p + step + LENGTH - 1)
            if q - p >= LENGTH:
                part = _parse_piece(data[p:q], np.clip(offsets[a : b + 1], p, q) - p)
                found.append(part._replace(start=part.start + p, doc=part.doc + a))
    if not found:
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none.astype(np.uint64), none.astype(np.uint64), none)
    return Phrases(*[np.concatenate(x) for x in zip(*found, strict=True)])


def _trigger_codes(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Triggers of a block, sorted; twice if two of its documents have it."""
    phrases = parse(data, offsets)
    return doubled(phrases.trigger, ids[phrases.doc])


def _shared_phrases(path: str, group: pa.Table, bits: int):
    """The phrases of a block whose trigger another document has too: one of each, its smallest id, all occurrences."""
    ids, data, offsets = block_texts(read_block(path))
    phrases = parse(data, offsets)
    codes = doubled(phrases.trigger, ids[phrases.doc])
    wanted = np.unique(codes[levels_of(group, codes, bits) > 1])
    if len(wanted):
        at = np.minimum(np.searchsorted(wanted, phrases.trigger), len(wanted) - 1)
        kept = np.flatnonzero(wanted[at] == phrases.trigger)
    else:
        kept = np.zeros(0, np.int64)
    phrases = Phrases(*[x[kept] for x in phrases])
    order = np.lexsort((ids[phrases.doc], phrases.hash, phrases.trigger))
    phrases = Phrases(*[x[order] for x in phrases])
    same = (phrases.hash[1:] == phrases.hash[:-1]) & (phrases.trigger[1:] == phrases.trigger[:-1])
    new = np.concatenate(([True], ~same)) if len(order) else np.zeros(0, bool)
    return ids, data, offsets, phrases, np.flatnonzero(new), np.cumsum(new) - 1


def _dictionary_rows(group: pa.Table, bits: int) -> pa.Table:
    path = group.column("block")[0].as_py()
    ids, data, _, phrases, first, _ = _shared_phrases(path, group, bits)
    rows = []
    for bucket, a, b in by_bucket(phrases.trigger[first], bits) if len(first) else ():
        one = first[a:b]
        length = phrases.count[one] + LENGTH - 1
        text = data[ranges(phrases.start[one], length)].tobytes()
        head = np.concatenate((ids[phrases.doc[one]], phrases.count[one])).astype("<i8").tobytes()
        rows.append((bucket, zlib.compress(len(one).to_bytes(8, "little") + head + text, 1)))
    return pa.table(
        {
            "block": pa.array([path] * len(rows), pa.string()),
            "bucket": pa.array([k for k, _ in rows], pa.int64()),
            "payload": pa.array([p for _, p in rows], pa.binary()),
        }
    )


def suffix_order(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``text`` in the order of their next LENGTH bytes, and whether each differs from the one before.

    Places are sorted by 8 bytes. Groups that agree in them but are not equal throughout are sorted by the next 8, and so
    on; one word of 8 bytes per place is held at a time.
    """
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(text) + 1, ">u8", padded, strides=(1,))  # the 8 bytes from every place on

    def word(places: np.ndarray, k: int) -> np.ndarray:
        return eight[starts[places] + k].astype(np.uint64)

    steps = [*range(8, LENGTH - 8, 8), LENGTH - 8]  # the last overlaps the one before: no byte beyond LENGTH
    first = eight[starts].astype(np.uint64)
    order = np.argsort(first)
    first = first[order]
    new = np.ones(len(starts), bool)
    new[1:] = first[1:] != first[:-1]
    del first
    differs = np.zeros(len(starts), bool)
    for k in steps:
        part = word(order, k)
        differs[1:] |= (part[1:] != part[:-1]) & ~new[1:]
    left = np.logical_or.reduceat(differs, np.flatnonzero(new)) if len(starts) else differs
    left = np.flatnonzero(left[np.cumsum(new) - 1])
    for k in steps:
        if not len(left):
            break
        group, part = np.cumsum(new[left]), word(order[left], k)
        by = np.lexsort((part, group))
        order[left], part = order[left][by], part[by]
        new[left[1:]] |= part[1:] != part[:-1]
        alone = new[left] & np.append(new[left[1:]], True)
        left = left[~alone]
    return order, new


def _judged(group: pa.Table) -> pa.Table:
    """Per row of a bucket, for each string of its phrases the smallest id that has it.

    The bucket's dictionary is all phrases of its triggers. A string has one trigger, so equal strings are in one bucket,
    and a phrase is long enough to order its suffixes by LENGTH bytes without looking at the phrase that follows.
    """
    texts, docs, counts, sizes = [], [], [], []
    for payload in group.column("payload"):
        raw = zlib.decompress(payload.as_py())
        n = int.from_bytes(raw[:8], "little")
        head = np.frombuffer(raw, "<i8", 2 * n, 8)
        docs.append(head[:n])
        counts.append(head[n:])
        texts.append(np.frombuffer(raw, np.uint8, offset=8 + 16 * n))
        sizes.append(n)
    text, doc, count = np.concatenate(texts), np.concatenate(docs), np.concatenate(counts)
    length = count + LENGTH - 1
    starts = ranges(np.cumsum(length) - length, count)
    order, new = suffix_order(text, starts)
    of_string = np.repeat(doc, count)
    least = np.minimum.reduceat(of_string[order], np.flatnonzero(new)) if len(order) else of_string
    smallest = np.empty(len(order), np.int64)
    smallest[order] = least[np.cumsum(new) - 1]
    ends, string_ends = np.cumsum(sizes), np.concatenate(([0], np.cumsum(count)))
    out = [zlib.compress(smallest[string_ends[b - n] : string_ends[b]].astype("<i8").tobytes(), 1) for n, b in zip(sizes, ends.tolist(), strict=True)]
    return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "least": pa.array(out, pa.binary())})


_OUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _removed(group: pa.Table, bits: int) -> pa.Table:
    path = group.column("block")[0].as_py()
    ids, data, offsets, phrases, first, distinct = _shared_phrases(path, group, bits)
    judged = dict(zip(group.column("bucket").to_pylist(), group.column("least").to_pylist(), strict=True))
    covered = np.zeros(len(data) + 1, np.int32)
    if len(first):
        parts = [np.frombuffer(zlib.decompress(judged[k]), "<i8") for k, _, _ in by_bucket(phrases.trigger[first], bits)]
        least = np.concatenate(parts)  # string by string, phrase by phrase
        count = phrases.count[first]
        base = np.cumsum(count) - count
        string = ranges(base[distinct], phrases.count)
        gone = least[string] < np.repeat(ids[phrases.doc], phrases.count)
        start = ranges(phrases.start, phrases.count)[gone]
        covered[:-1] += np.bincount(start, minlength=len(data)).astype(np.int32)
        covered -= np.bincount(start + LENGTH, minlength=len(data) + 1).astype(np.int32)
    cut = np.cumsum(covered[:-1]) > 0
    out = []
    for k in range(len(ids)):
        mine, text = cut[offsets[k] : offsets[k + 1]], data[offsets[k] : offsets[k + 1]]
        edge = np.diff(np.concatenate(([0], mine.astype(np.int8), [0])))
        spans = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
        out.append((None if ids[k] == -(1 << 63) else int(ids[k]), len(text), int(mine.sum()), spans, text[~mine].tobytes()))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, spans, kept``: bytes covered by a string of 50 bytes that also starts in a
    document with a smaller id are removed; strings are judged on the input.

    Prefix-free parsing: the hash rolling over 24 bytes triggers where it is the least of a string, which every
    string of 50 bytes has exactly once, and a phrase is the text of all strings of one trigger. Phrases without a trigger
    in two documents are done with after one exchange of 5-byte codes. The others' dictionary (each phrase once per
    block) is dealt out by trigger, sorted by suffixes, and the parse (which phrase stands where) takes the order's
    groups back to the texts. Phrases overlap by 49 bytes, so the order to 50 bytes never leaves the phrase and the parse
    itself need not be sorted. Texts are written once in blocks and read from there; a trigger that very many documents
    have sends one phrase per block and variant.

    Null text is empty and a null id counts as the smallest; rows that repeat an id are one document, which does not
    remove its own strings; an empty table gives no row.
    """
    bits = bucket_bits(docs)
    codes = write_blocks(docs, id_col, text_col, _trigger_codes, bits)
    levels = code_levels(codes)
    rows = levels.groupBy("block").applyInArrow(lambda g: _dictionary_rows(g, bits), "block string, bucket long, payload binary")
    judged = rows.groupBy("bucket").applyInArrow(_judged, "block string, bucket long, least binary")
    # Neither side's size is known before it runs, so neither may be broadcast.
    both = levels.hint("merge").join(judged, ["block", "bucket"], "left").select("block", "bucket", "levels", "least")
    return both.groupBy("block").applyInArrow(lambda g: _removed(g, bits), _OUT)
