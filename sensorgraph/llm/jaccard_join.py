"""Near-duplicate classes by an exact Jaccard join of word shingles under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.blocks import block_texts, bucket_bits, code_levels, code_rows, doubled, levels_of, read_block, write_blocks
from sensorgraph.llm.components import components
from sensorgraph.llm.text import NOT_WHITE, mixed, pieces, ranges, span_hashes, spans, window_hashes
from sensorgraph.operators.storage import stored

WIDTH, PERCENT = 5, 75
#: Input per bucket of the exchange of codes. With 30 GB a block still has some 60 codes for each bucket.
BUCKET_BYTES = 16 << 20
#: Seeds of the token orders by which candidates are filtered; each order is by frequency first.
ORDERS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def _more(n: np.ndarray) -> np.ndarray:
    """Shared tokens asked for beyond the first, when a prefix is longer by as many."""
    return 1 + n // 16


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, text after text, and their number per text."""
    out, sizes = [], []
    for a, b in pieces(offsets):
        starts, ends, first = spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], NOT_WHITE)
        hashes = span_hashes(data[offsets[a] : offsets[b]], starts, ends, lower=True)
        words = np.diff(first)
        count = np.where(words >= width, words - width + 1, 0)
        windows = window_hashes(hashes, width)
        owner, value = [np.repeat(np.arange(b - a), count)], [windows[ranges(first[:-1], count)]]
        for t in np.flatnonzero((words > 0) & (words < width)).tolist():  # fewer words: one shingle of them all
            owner.append(np.array([t]))
            value.append(window_hashes(hashes[first[t] : first[t + 1]], int(words[t])))
        owner, value = np.concatenate(owner), np.concatenate(value)
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))) if len(owner) else np.zeros(0, bool)
        out.append(value[new])
        sizes.append(np.bincount(owner[new], minlength=b - a))
    none = np.zeros(0, np.int64)
    return np.concatenate(out or [none.astype(np.uint64)]), np.concatenate(sizes or [none])


def _heads(tokens: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of each set by hash, the first global order, and their texts."""
    head = np.where(sizes > 0, sizes - _least_overlap(sizes, percent) + _more(sizes), 0)
    head = np.minimum(head, sizes)
    return tokens[ranges(np.cumsum(sizes) - sizes, head)], np.repeat(np.arange(len(sizes)), head)


def _survivors(group: pa.Table, width: int, percent: int, bits: int) -> pa.Table:
    """Per document its set's size and signature, and whether enough of its head is shared for any link."""
    path = group.column("block")[0].as_py()
    ids, data, offsets = block_texts(read_block(path))
    tokens, sizes = shingle_sets(data, offsets, width)
    head, text = _heads(tokens, sizes, percent)
    codes = doubled(head, text)
    wanted = np.unique(codes[levels_of(group, codes, bits) > 1])
    at = np.minimum(np.searchsorted(wanted, head), max(len(wanted) - 1, 0))
    shared = wanted[at] == head if len(wanted) else np.zeros(len(head), bool)
    enough = np.bincount(text[shared], minlength=len(ids)) >= _more(_least_overlap(sizes, percent))
    ends = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(tokens))))
    stop = np.cumsum(sizes)
    signature = mixed(ends[stop] - ends[stop - sizes]).view(np.int64)
    columns = [pa.array([path] * len(ids)), ids, np.arange(len(ids)), sizes.astype(np.int64), signature, enough & (sizes > 0)]
    return pa.table([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["block", "id", "place", "n", "signature", "linked"])


def _nodes(places: np.ndarray, path: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, tokens and set sizes of some texts of a block."""
    ids, data, offsets = block_texts(read_block(path).take(pa.array(places)))
    tokens, sizes = shingle_sets(data, offsets, width)
    return ids, tokens, sizes


def _spread(places: DataFrame) -> DataFrame:
    """Blocks dealt over all tasks: a number that is given is kept, however few bytes name the blocks."""
    return places.repartition(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block")


def _tokens_of(places: DataFrame, width: int) -> DataFrame:
    """``id, n, tokens`` of the texts at ``block, places``, read from their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, tokens, sizes = _nodes(np.array(at, np.int64), path, width)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, tokens.view(np.int64))
                yield pa.record_batch([pa.array(ids), pa.array(sizes.astype(np.int64)), lists], ["id", "n", "tokens"])

    return _spread(places).mapInArrow(run, "id long, n long, tokens array<long>")


def _by_block(rows: DataFrame) -> DataFrame:
    """``block, places`` of rows ``block, place``: at most the texts of a block each."""
    return rows.groupBy("block").agg(F.sort_array(F.collect_set("place")).alias("places"))


def _prefix_rows(ids: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, levels: np.ndarray, percent: int) -> pa.Table:
    """Tokens of the sets' prefixes that another set has, with their place, under each order (``turn``)."""
    owner = np.repeat(np.arange(len(ids)), sizes)
    central = np.bincount(owner, levels, len(ids)) / np.maximum(sizes, 1)
    place = ranges(np.zeros(len(sizes), np.int64), sizes)
    inside = place < (sizes - _least_overlap(sizes, percent) + 1)[owner]
    out = []
    for turn, seed in enumerate(ORDERS):
        order = np.lexsort((mixed(tokens ^ np.uint64(seed)), levels, owner))
        at = np.flatnonzero(inside & (levels[order] > 1))
        mine = owner[at]
        columns = [np.full(len(at), turn, np.int32), tokens[order[at]].view(np.int64), place[at], ids[mine], sizes[mine].astype(np.int64), central[mine]]
        out.append(pa.table([pa.array(c) for c in columns], ["turn", "token", "at", "id", "n", "central"]))
    return pa.concat_tables(out)


def _pairs(group: pa.Table, percent: int) -> pa.Table:
    """Pairs of documents with a common token that pass sizes and positions and are not yet in one component."""
    token, n, at, label, ids = (group.column(c).to_numpy() for c in ("token", "n", "at", "label", "id"))
    order = np.lexsort((ids, n, token))
    token, n, at, label, ids = (x[order] for x in (token, n, at, label, ids))
    ends = np.searchsorted(token, token, "right")
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(ends - np.arange(len(token)) > 1).tolist():
        stop = k + 1 + int(np.searchsorted(n[k + 1 : ends[k]], n[k] * 100 // percent, "right"))
        other = slice(k + 1, stop)
        most = 1 + np.minimum(n[k] - at[k] - 1, n[other] - at[other] - 1)
        fits = (label[other] != label[k]) & ((100 + percent) * most >= percent * (n[k] + n[other])) & (ids[other] != ids[k])
        mates = ids[other][fits]
        if len(mates):
            left.append(np.minimum(mates, ids[k]))
            right.append(np.maximum(mates, ids[k]))
    pairs = np.unique(np.column_stack((np.concatenate(left), np.concatenate(right))), axis=0)
    return pa.table([pairs[:, 0], pairs[:, 1]], ["a", "b"])


def _links(pairs: DataFrame, places: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that do link, by the size of the intersection of their sets.

    Only the sets of documents in a pair move: they are read from their blocks anew.
    """
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = _tokens_of(stored(_by_block(places.join(ends, "id")), "ends-by-block"), width)
    # Spark takes what a Python function returns to be as small as its input; such a side must never be broadcast.
    left = pairs.join(sets.toDF("a", "n_a", "tokens_a").hint("merge"), "a")
    both = left.join(sets.toDF("b", "n_b", "tokens_b").hint("merge"), "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.where((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id``: documents whose sets of ``width``-word shingles have at least
    ``percent`` % in common link, and the smallest id that links reach names the class.

    1. Order by hash: a set's head, long enough that any partner shares ``1 + n / 16`` tokens of it, is sent as 5-byte
       codes. Documents with fewer shared codes have no link and go no further.
    2. Documents with equal sets are one node. Tokens of nodes get their frequency class by the same exchange.
    3. Orders by (frequency class, seeded hash): under each a linked pair shares a token of both prefixes. Only these
       prefixes are written and moved, not the nodes' whole sets. Each node is tried with the most central node of its
       prefix tokens; the links found give components.
    4. What is left: tokens of prefixes whose documents are in several components. Pairs of different components that
       share such a token under every order (and pass the bounds of size and position) are intersected over the orders and
       verified on the whole sets. Pairs within a component are never made, so a group of copies costs one pair each.

    Fewer than ``width`` words are one shingle; null or empty texts have none and their own class (a null id is the
    smallest number and given back as null); rows that repeat an id are one document; an empty table gives no row.
    Shingles are compared by 64-bit hashes.
    """
    bits = bucket_bits(docs, BUCKET_BYTES)

    def head_codes(ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return doubled(*_heads(*shingle_sets(data, offsets, width), percent))

    levels = code_levels(write_blocks(docs, id_col, text_col, head_codes, bits))
    kinds = "block string, id long, place long, n long, signature long, linked boolean"
    sets = stored(levels.groupBy("block").applyInArrow(lambda g: _survivors(g, width, percent, bits), kinds), "shingle-sets")
    linked = sets.where("linked")
    first = stored(linked.groupBy("signature", "n").agg(F.min(F.struct("id", "block", "place")).alias("first"), F.count("*").alias("copies")), "equal-sets")
    copies = linked.join(first.where("copies > 1"), ["signature", "n"]).select(F.col("id").alias("a"), F.col("first.id").alias("b"))
    places = first.select("first.*")
    chosen = stored(_by_block(places), "nodes-by-block")

    def node_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, tokens, _ = _nodes(np.array(places, np.int64), path, width)
                yield code_rows(path, np.sort(tokens), bits)

    classes = code_levels(_spread(chosen).mapInArrow(node_codes, "block string, bucket long, payload binary"))

    def node_rows(group: pa.Table, listed: pa.Table) -> pa.Table:
        path, places = listed.column("block")[0].as_py(), listed.column("places")[0].as_py()
        ids, tokens, sizes = _nodes(np.array(places, np.int64), path, width)
        order = np.argsort(tokens, kind="stable")
        level = np.empty(len(tokens), np.uint8)
        level[order] = levels_of(group, tokens[order], bits)
        return _prefix_rows(ids, tokens, sizes, level, percent)

    kinds = "turn int, token long, at long, id long, n long, central double"
    # Grouped beside the codes, not joined to them: the list of places would be repeated for each bucket of its block.
    prefixes = stored(classes.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(node_rows, kinds), "prefix-tokens")
    postings = prefixes.where("turn = 0")
    centre = postings.groupBy("token").agg(F.max(F.struct("central", (-F.col("id")).alias("minus"))).alias("top"), F.count("*").alias("m"))
    centre = stored(centre.where("m > 1").select("token", (-F.col("top.minus")).alias("centre")), "centres")
    # Only a pair that shares a fair part of a prefix is worth moving two sets; the rest is left to the filters below.
    votes = postings.select("token", "id", "n").join(centre, "token").where("id <> centre").groupBy("id", "n", "centre").count()
    votes = votes.where(F.col("count") * 32 >= F.col("n"))
    best = votes.groupBy("id").agg(F.max(F.struct("count", "centre")).alias("best"))
    tried = stored(best.select(F.least("id", "best.centre").alias("a"), F.greatest("id", "best.centre").alias("b")).distinct(), "tried")
    links = stored(_links(tried, places, width, percent), "links")
    labels = components(links)

    own = postings.select("token", "at", "id", "n").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    several = own.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_tokens = stored(several.where("low < high").select("token"), "open-tokens")
    open_rows = stored(own.join(open_tokens, "token"), "open-rows")
    if not open_rows.isEmpty():
        open_nodes = stored(open_rows.select("id", "label").distinct(), "open-nodes")
        cell = F.pmod("token", F.lit(1 << bits))  # several tokens a group; all rows of a token are in one
        others = [prefixes.where(F.col("turn") == k).select("token", "at", "id", "n").join(open_nodes, "id") for k in range(1, len(ORDERS))]
        found = [rows.groupBy(cell).applyInArrow(lambda g: _pairs(g, percent), "a long, b long").distinct() for rows in [open_rows, *others]]
        pairs = stored(reduce(lambda x, y: x.join(y, ["a", "b"]), found), "pairs")
        links = links.union(stored(_links(pairs, places, width, percent), "more-links"))
    labels = components(links.union(copies.where("a <> b")))
    smallest = -(1 << 63)
    real = lambda c: F.when(F.col(c) != smallest, F.col(c))
    return sets.join(labels, "id", "left").select(
        real("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce(real("label"), real("id")).alias("component_id")
    )
