"""Operators against plain versions on small, awkward tables."""

import itertools
import random
import re
import struct
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sensorgraph.llm import (
    decontamination,
    jaccard_join,
    language_id,
    packing,
    quality_rules,
    sentence_dedup,
    suffix_dedup,
    text,
    token_counts,
    toxicity,
    warc,
)
from tests.llm.checks import jaccard_classes, packing_faults, passages, repeated_bytes

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score string, id int, bucket int"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = [f"{r.choice('bdfgkl')}{r.choice('aeiou')}{r.choice('mnrst')}{k % 37}" for k in range(vocabulary)]
    out = []
    while n > 0:
        k = min(n, r.randint(3, 14))
        out.append(" ".join(r.choices(words, k=k)).capitalize() + r.choice([".", "!", ".\n"]))
        n -= k
    return " ".join(out)


BASE, LONG = prose(1, 120), prose(2, 30_000)
ODD = [
    (7, None), (8, ""), (9, " \t\n"), (10, "word"), (11, "Ünïcode — words, twice twice. Twice!"), (12, LONG), (13, LONG + " end"),
    (20, BASE), (20, BASE), (21, BASE), (3, BASE + " One word more."), (4, prose(3, 60) + "\n" + BASE), (None, prose(4, 80)),
    (None, None), (30, "same same same same same same same same same same"), (31, "x" * 70_000), (32, "a. a. a. a. a. a."),
]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(d, t, "en", None if d == 8 else "h", 0, 1, "s", 2, 3) for d, t in rows], schema)


def tuples(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_token_counts(odd, none):
    encoder = token_counts._encoder(None)
    lengths = sorted(len(encoder.encode_ordinary(t or "")) for _, t in ODD)
    sums = token_counts.length_sums(token_counts.length_histogram(odd))
    for row in sums.collect():
        at = row["length"]
        assert row["n_docs"] == lengths.count(at)
        assert row["docs_at_least"] == sum(n >= at for n in lengths)
        assert row["tokens_at_least"] == sum(n for n in lengths if n >= at)
        assert row["truncated_tokens"] == sum(min(n, at) for n in lengths)
    limits = [1, lengths[5], lengths[5] + 1, 10**9]
    wanted = [(n, sum(min(x, n) for x in lengths), sum(x > n for x in lengths)) for n in limits]
    assert tuples(token_counts.truncated_totals(sums, limits), "limit", "tokens", "docs_cut") == sorted(wanted, key=repr)
    assert tuples(token_counts.length_quantiles(sums, [0.5, 1.0]), "share", "length") == [(0.5, lengths[8]), (1.0, lengths[-1])]
    empty = token_counts.length_sums(token_counts.length_histogram(none))
    assert empty.count() == 0
    assert tuples(token_counts.truncated_totals(empty, [4]), "limit", "tokens", "docs_cut") == [(4, 0, 0)]


def test_repeated_sentences(spark, odd, none):
    shared = "The old mill stands by the river bank. Nobody goes there after dark now."
    rows = [(5, f"Alone here. {shared} After it all."), (2, f"Before. {shared}"), (9, f"{shared}\nLast words."), (6, "Before. After.")]
    found = tuples(sentence_dedup.remove_repeated_sentences(frame(spark, rows)), "doc_id", "text", "n_removed")
    assert [(d, n) for d, _, n in found] == [(2, 0), (5, 2), (6, 0), (9, 2)]
    assert {d: t for d, t, _ in found}[2] == f"Before. {shared}"
    assert {d: t for d, t, _ in found}[5].split() == "Alone here. After it all.".split()
    kept = {(d, t): n for d, t, n in tuples(sentence_dedup.remove_repeated_sentences(odd), "doc_id", "text", "n_removed")}
    assert kept[7, None] == 0 and kept[8, ""] == 0 and kept[None, None] == 0 and kept[32, "a. a. a. a. a. a."] == 0
    assert (3, BASE + " One word more.") in kept and kept[21, ""] > 5  # the smallest id keeps the passage
    assert sum(1 for d, _ in kept if d == 20) == 1
    assert sentence_dedup.remove_repeated_sentences(none).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_benchmark_passages(spark, odd, none, block_bytes):
    base = BASE.split()
    items = [(1, " ".join(base[5:30])), (2, "same same same"), (3, None), (4, ""), (5, " ".join(base[20:32]).upper()), (6, "twice"), (7, prose(9, 40))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_passages(odd, benchmark, shard_bytes=4000, block_bytes=block_bytes, keep=["n_words", "bucket"])
    wanted = sorted(passages(ODD, items), key=repr)
    assert tuples(found, "doc_id", "n_words", "n_hit", "item_ids") == wanted
    assert {r["n_words_kept"] for r in found.collect()} == {1}
    cut = {r["doc_id"]: r["cut"] for r in found.select("doc_id", decontamination.without_spans().alias("cut")).collect()}
    assert " ".join(base[8:28]) not in cut[21] and cut[8] == "" and cut[7] is None
    assert decontamination.find_passages(none, benchmark).count() == 0
    clean = decontamination.find_passages(odd, benchmark.where("false"))
    assert clean.where("n_hit > 0").count() == 0 and clean.count() == len(ODD)


def test_index_equals_scan():
    r = random.Random(5)
    symbols = []
    for _ in range(40):
        symbols += [r.randint(1, 4) for _ in range(r.randint(0, 30))] + [0]
    import numpy as np

    index = decontamination.FmIndex(np.array(symbols), 5, every=4)
    patterns = [[r.randint(1, 4) for _ in range(3)] for _ in range(30)]
    low, high = index.search(np.array(patterns), np.full(30, 3))
    for p, a, b in zip(patterns, low, high, strict=True):
        places = [i for i in range(len(symbols) - 2) if symbols[i : i + 3] == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_archives(spark, tmp_path):
    pages = [(k, f"<p>page {k % 40} " + "text " * (k % 40) + "</p>", f"http://h/{k}") for k in range(200)]
    pages += [(500, None, None), (501, "", "u\r\nx"), (None, "<p>" + "n" * 200, "n"), (502, "<p>" + "n" * 200, "n"), (502, "<p>" + "n" * 200, "n")]
    pages += [(503, "é" * 300_000, "long"), (504, "a\r\n\r\nb" * 40, "crlf")]
    df = spark.createDataFrame(pages, "page_id long, html string, url string").withColumn("digest", pages_lit("clash"))
    manifest = warc.write_archives(df, f"{tmp_path}/w", archive_bytes=4000)
    rows = warc.read_archives(manifest).collect()
    assert len(rows) == len(pages) and manifest.agg({"records": "sum"}).first()[0] == len(pages)
    first = {}
    for page, html, _ in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html or "", page)
    for row in rows:
        html = next((h or "" for p, h, _ in pages if p == row["page_id"]), "")
        size = len(html.encode())
        revisit = row["page_id"] is not None and size >= 100 and first[html] != row["page_id"]
        assert row["payload_bytes"] == size and row["record_type"] == ("revisit" if revisit else "response")
        assert row["refers_to"] == (first[html] if revisit else None)
        assert revisit or row["payload"] == html.encode()
    # Enough records for a dictionary only in larger archives.
    warc.write_archives(df, f"{tmp_path}/d")
    heads = [struct.unpack("<I", Path(f).read_bytes()[:4])[0] for f in Path(tmp_path, "d").iterdir() if f.suffix == ".zst"]
    assert warc.DICTIONARY_FRAME in heads
    empty = warc.write_archives(df.where("false"), f"{tmp_path}/e")
    assert warc.read_archives(empty).count() == 0


def pages_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_jaccard_classes(spark, odd, none):
    r = random.Random(11)
    rows = [(d, t) for d, t in ODD if d is not None and d != 12 and d != 13]
    for group in range(6):  # edited copies: some link only through the first of them
        words = prose(100 + group, 90).split()
        for k in range(7):
            copy = list(words)
            for _ in range(k % 4):
                copy[r.randrange(len(copy))] = f"edit{r.random()}"
            rows.append((1000 + 10 * group + k, " ".join(copy)))
    line = prose(77, 25)
    rows += [(2000 + k, prose(200 + k, 30) + " " + line) for k in range(30)]
    found = jaccard_join.near_duplicate_classes(frame(spark, rows).repartition(4))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == sorted(jaccard_classes(rows), key=repr)
    assert jaccard_join.near_duplicate_classes(none).count() == 0
    found = jaccard_join.near_duplicate_classes(odd).collect()
    assert len(found) == len(ODD) and {(r["doc_id"], r["component_id"]) for r in found} >= {(12, 12), (13, 12), (20, 3), (None, None)}


def test_jaccard_moves_no_whole_sets(spark, monkeypatch):
    """Between blocks only codes and prefixes move, whichever side would have been broadcast; a pair's sets move to be verified."""
    written, keep = {}, jaccard_join.stored

    def stored(df, name):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = []
    for group in range(4):  # each copy links with its neighbours in a chain, and all have one passage of another class
        words = prose(300 + group, 120).split()
        for k in range(10):
            words = [*words[3:], *prose(400 + 10 * group + k, 3).split()]
            rows.append((3000 + 10 * group + k, " ".join(words)))
    rows += [(4000 + k, " ".join([*prose(500 + k, 60).split(), *rows[10 * (k % 4)][1].split()[:30]])) for k in range(12)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tuples(jaccard_join.near_duplicate_classes(frame(spark, rows).repartition(5)), "doc_id", "n_shingles", "component_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == sorted(jaccard_classes(rows), key=repr)
    assert {"prefix-tokens", "open-nodes", "pairs"} <= set(written) and written["open-nodes"].count() > 0
    assert [n for n, df in written.items() if any(kind.startswith(("array<bigint>", "binary")) and c != "places" for c, kind in df.dtypes)] == []


def test_jaccard_prefixes():
    r = np.random.default_rng(5)
    sizes = np.array([1, 3, 4, 40, 100])
    tokens = r.integers(0, 1 << 64, sizes.sum(), dtype=np.uint64)
    levels = r.integers(1, 6, len(tokens)).astype(np.uint8)
    found = jaccard_join._prefix_rows(np.array([5, 4, 9, 7, 1]), tokens, sizes, levels, 75).to_pylist()
    wanted, first = [], 0
    for id_, n in zip([5, 4, 9, 7, 1], sizes.tolist(), strict=True):
        mine = slice(first, first + n)
        for turn, seed in enumerate(jaccard_join.ORDERS):
            order = sorted(zip(levels[mine].tolist(), jaccard_join.mixed(tokens[mine] ^ np.uint64(seed)).tolist(), tokens[mine].view(np.int64).tolist(), strict=True))
            head = enumerate(order[: n - -(-n * 75 // 100) + 1])
            wanted += [(turn, token, at, id_, n, float(levels[mine].mean())) for at, (level, _, token) in head if level > 1]
        first += n
    assert sorted(tuple(row.values()) for row in found) == sorted(wanted)


def test_jaccard_codes_per_bucket(spark):
    """Blocks and buckets both grow with the input; with 30 GB a block's row of a bucket is still mostly codes."""
    bits = jaccard_join.bucket_bits(spark.range((30 << 30) // 8), jaccard_join.BUCKET_BYTES)
    codes = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 124_000, dtype=np.uint64))  # as many as nodes of a block sent at 0.51 GB
    assert jaccard_join.code_rows("block", codes, bits).num_rows * 60 <= len(codes)


def test_jaccard_memory_of_a_block(tmp_path):
    """A worker holds small tables for hashes and a few bytes for each byte of the texts it reads again."""
    texts = [prose(k, 400) for k in range(600)]
    path, size = f"{tmp_path}/block.parquet", sum(map(len, texts))
    pq.write_table(pa.table({"id": range(600), "text": texts}), path)
    places = np.array([k for k in range(600) if k % 9])
    tracemalloc.start()
    try:
        ids, tokens, sizes = jaccard_join._nodes(places, f"file:{path}", 5)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert text._UP.nbytes + text._DOWN.nbytes <= 4 << 20
    assert size > 1_300_000 and most < 16 * size
    assert ids.tolist() == places.tolist() and sizes.sum() == len(tokens)
    starts = np.cumsum(sizes) - sizes
    for k in (0, 1, 300, len(places) - 1):  # as the text alone gives
        data = np.frombuffer(texts[places[k]].encode(), np.uint8)
        alone, _ = jaccard_join.shingle_sets(data, np.array([0, len(data)]), 5)
        assert alone.tolist() == tokens[starts[k] : starts[k] + sizes[k]].tolist()


def test_hashes_of_words_in_windows():
    """A word's hash does not depend on where the pieces end that are hashed at once, nor on its length."""
    r = random.Random(8)
    lengths = [r.randint(1, 30) for _ in range(40_000)]
    lengths[100:100], lengths[9_000:9_000] = [text.HASH_BYTES], [3 * text.HASH_BYTES]
    words = [r.randbytes(n).replace(b" ", b"_") for n in lengths]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([n + 1 for n in lengths]) - 1
    found = text.span_hashes(data, ends - lengths, ends, lower=True)
    for k in [*range(0, len(words), 97), 100, 9_000]:
        word = np.frombuffer(words[k], np.uint8)
        assert found[k] == text.span_hashes(word, np.array([0]), np.array([len(word)]), lower=True)[0]


def test_jaccard_places_beside_codes(spark, monkeypatch):
    """The list of a block's nodes reaches its task once, not with every bucket of the block."""
    plans, keep = {}, jaccard_join.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().analyzed().toString()
        return keep(df, name)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = [(k, prose(k // 3, 40) + f" tail{k}") for k in range(30)]
    assert tuples(jaccard_join.near_duplicate_classes(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == sorted(jaccard_classes(rows), key=repr)
    assert "CoGroup" in plans["prefix-tokens"] and "Join" not in plans["prefix-tokens"]


def test_repeated_bytes(spark, none):
    r = random.Random(3)
    rows = [(k, "".join(r.choices("ab", k=r.randint(0, 400)))) for k in range(12)]
    passage = prose(6, 60)
    rows += [(100 + k, prose(50 + k, 40) + passage[k * 3 :] + prose(70 + k, 5)) for k in range(8)]
    rows += [(200, None), (201, ""), (202, "ab" * 9000), (203, LONG), (204, LONG[5000:]), (205, "é" * 60), (206, "é" * 60)]
    found = suffix_dedup.remove_repeats(frame(spark, rows).repartition(3)).collect()
    wanted = repeated_bytes(dict(rows))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in found} == wanted
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_packing(spark, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    awkward = "Don't stop... I'm «here»! é́ a.b,c <|endoftext|>x <|ENDOFTEXT|> 3.14 x-y ''s 'S #'s\x1c wide ￼ ſ's İ.i"
    rows = [(d, t) for d, t in dict(ODD).items() if d is not None] + [(300 + k, prose(k, 7 * k % 61)) for k in range(60)] + [(999, awkward)]
    found = packing.pack(frame(spark, rows).repartition(3), capacity=64).collect()
    assert packing_faults(found, dict(rows), encode, capacity=64) == []
    total = sum(r["length"] for r in found)
    assert len({r["sequence_id"] for r in found}) <= 1.02 * total / 64 + 1
    assert packing.pack(none).count() == 0


def test_program_places_pieces():
    """The rounded program places nine in ten sequences, all reach the lower bound, and every piece is placed once."""
    rng = np.random.default_rng(7)
    for n, spread in ((1_200, 500), (12_000, 800)):
        histogram = np.bincount(np.clip(rng.gamma(1.2, spread, n).astype(int), 1, 2048), minlength=2049)
        lengths = np.flatnonzero(histogram)
        counts = histogram[lengths]
        plan, placed = packing.configurations(lengths, counts, 2048)
        total = sum(times for _, times in plan)
        assert (sum(pattern * times for pattern, times in plan) == counts).all()
        assert all(pattern @ lengths <= 2048 for pattern, _ in plan)
        assert total == -(-int(counts @ lengths) // 2048)
        assert placed >= 0.9 * total
    assert packing.configurations(np.zeros(0, np.int64), np.zeros(0, np.int64), 64) == ([], 0)


def test_dearest_pattern_by_enumeration():
    lengths, counts, prices = np.array([2, 3, 5, 7]), np.array([3, 1, 2, 1]), np.array([1.0, 1.7, 2.4, 4.1])
    uses = [np.array(x) for x in itertools.product(*[range(n + 1) for n in counts])]
    for capacity in (7, 11, 16):
        best = max(float(x @ prices) for x in uses if x @ lengths <= capacity)
        patterns = packing.dearest_patterns(prices, lengths, counts, capacity)
        assert float(patterns[0] @ prices) == pytest.approx(best)
        assert all((x <= counts).all() and x @ lengths <= capacity for x in patterns)


def test_suffix_order():
    """Against sorting the strings themselves, with much and little that agrees in its first bytes."""
    rng = np.random.default_rng(3)
    words = [b"alpha ", b"alphabet ", b"beta ", b"b "]
    text = np.frombuffer(b"".join(words[k] for k in rng.integers(0, 4, 900)), np.uint8)
    text = np.concatenate((text, rng.integers(0, 256, 700).astype(np.uint8), text[100:900]))
    starts = np.arange(len(text) - suffix_dedup.LENGTH + 1)
    order, new = suffix_dedup.suffix_order(text, starts)
    strings = [text[k : k + suffix_dedup.LENGTH].tobytes() for k in starts]
    ordered = [strings[k] for k in order]
    assert ordered == sorted(strings)
    assert new.tolist() == [True] + [a != b for a, b in itertools.pairwise(ordered)]


def test_runs_of_sentences():
    """The shortest runs with 2 sentences and 8 words from and up to each sentence, a long one alone, by plain search."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        words = rng.choice([1, 2, 3, 9, 17], rng.integers(0, 14)).tolist()
        n = len(words)
        fit = {(p, q) for p in range(n) for q in range(p + 1, n) if sum(words[p : q + 1]) >= 8}
        wanted = {min(x for x in fit if x[0] == p) for p, _ in fit} | {max(x for x in fit if x[1] == q) for _, q in fit}
        found = list(sentence_dedup.covering_runs(words, 2, 8, 16))
        assert len(found) == len(set(found))
        assert set(found) == wanted | {(p, p) for p in range(n) if words[p] >= 16}


def test_language(spark, none):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language_id.document_rows(docs).unionByName(language_id.page_rows(spark.read.parquet(f"{FOLDER}/pages.parquet")))
    extra = [(900, "document", None, None, None), (901, "document", "", "de", "h"), (902, "page", "Ja", None, None)]
    more = spark.createDataFrame(extra, "id long, kind string, text string, lang string, host string")
    found = language_id.identify(rows.unionByName(more, allowMissingColumns=True)).collect()
    right = [r["language"] == lang[r["id"]] for r in found if r["kind"] == "document" and r["id"] < 900]
    assert sum(right) >= 0.97 * len(right)
    assert {r["id"]: r["accepted"] for r in found if r["id"] in (900, 901)} == {900: False, 901: False}
    assert language_id.identify(language_id.document_rows(none)).count() == 0
    unlabelled = language_id.identify(language_id.document_rows(docs.withColumn("lang", pages_lit(None)))).collect()
    assert {r["language"] for r in unlabelled} == {None} and not any(r["accepted"] for r in unlabelled)


def test_language_evidence(spark):
    """Text that says nothing follows the declared language, the suffix or the host, as these went with the texts."""
    de, en = "der die und nicht einer der schon auch wenn", "the and not one of with they when that"
    rows = [(k, "page", t, l, f"h{k % 5}.example.{l}", f"example.{l}", l, l) for k in range(60) for t, l in [((de, "de"), (en, "en"))[k % 2]]]
    rows += [(100, "page", "", None, None, None, None, "de"), (101, "page", "", None, None, None, "en", None), (102, "page", "x1", None, "h1.example.de", "example.de", None, None)]
    df = spark.createDataFrame(rows, "id long, kind string, text string, lang string, host string, domain string, suffix string, markup string")
    found = {r["id"]: r["language"] for r in language_id.identify(df).collect()}
    assert (found[100], found[101], found[102]) == ("de", "en", "de")


def test_toxicity(spark, odd, none):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        rows.append((k, prose(k, 60) + (" You stupid idiot, what trash." if bad else "") + prose(k + 1000, 30)))
        labels.append((k, int(bad), 1))
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, marks)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).select("doc_id", "score", toxicity.held_out().alias("h")).collect()}
    held = [(found[d]["score"] >= 0.5, bool(t)) for d, t, _ in labels if found[d]["h"]]
    assert len(held) > 40 and sum(a == b for a, b in held) >= 0.97 * len(held)
    disguised = [(1, "Go home you i.d.i.o.t and stay."), (2, "So stu-pid a plan, you id_iot."), (3, "A kind word for a friend."), (4, "What an i d i o t he is.")]
    score = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, disguised), model).collect()}
    assert min(score[1], score[2], score[4]) > score[3] + 0.2
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(none, model).count() == 0
    blank = toxicity.fit(docs, marks.where("false"))
    assert max(r["score"] for r in toxicity.score(odd, blank).collect()) < 1e-6


def test_toxicity_scores_spelled_words_at_once():
    """Every run of short words of one sentence counts like the word it spells, and the runs share a call of the scorer."""
    texts = ["An i d i o t said so", "a b. c d", "Word ß é É and I D I O T too. 1 2 3 all", "", "x y " * 40 + "end", "so i t\nis no w"] * 50
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts, ends, first = text.spans(data, offsets, text.NOT_WHITE)
    sentence = np.cumsum(np.concatenate(([0], toxicity._ENDS[data])))[starts] + np.repeat(np.arange(len(texts)), np.diff(first))
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    calls = []

    class Counted(toxicity.WordScores):
        def direct(self, words):
            calls.append(len(words))
            return super().direct(words)

    scorer = Counted(np.random.default_rng(3).normal(size=toxicity.LETTERS**3), -0.5)
    expected, k = np.full(len(words), -3.0), 0
    while k < len(words):
        after = next((j for j in range(k, len(words)) if len(words[j].encode()) > 2), len(words))
        if after - k >= 3 and sentence[k] == sentence[after - 1]:
            expected[k] = max(-3.0, toxicity.WordScores.direct(scorer, ["".join(words[k:after])])[0])
        k = after + 1
    found = toxicity._with_spelled(scorer, data, starts, ends, sentence, np.full(len(words), -3.0))
    assert (expected > -3).sum() >= 150 and np.array_equal(found, expected)
    assert len(calls) == 1


def test_quality(spark, odd, none):
    found = quality_rules.quality_verdicts(odd, most_docs=2).collect()
    assert len(found) == len(ODD)
    by_id = {r["doc_id"]: r for r in found}
    for d, t in ODD:
        if d is None:
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 5000 else None
        row = by_id[d]
        assert (row["n_words"], row["word_chars"]) == (len(words), sum(map(len, words)))
        if twice is not None:
            covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
            assert row["n_repeat_words"] == len(covered)
            assert row["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row["base_failed"] and row["kept"])
    assert not by_id[21]["kept"] and by_id[12]["kept"] and by_id[4]["n_removed_chars"] > 0
    assert quality_rules.quality_verdicts(none).count() == 0


def test_lines_are_frequent_by_host(spark):
    """One document on two hosts: its menu is removed on the host that has it often, and counts there only."""
    menu, body = "Home page and about us and contact and terms", prose(77, 60)
    rows = [(k, f"{menu}\n{prose(k, 60)}", "a") for k in range(4)] + [(50, f"{menu}\n{body}", "a"), (50, f"{menu}\n{body}", "b"), (50, f"{menu}\n{body}", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = sum(len(w) for w in menu.split())
    found = quality_rules.quality_verdicts(df, most_docs=3).where("doc_id = 50").collect()
    assert sorted(r["n_removed_chars"] for r in found) == [0, 0, cut]
    strict = quality_rules.quality_verdicts(df, most_docs=3, most_removed=0.01).where("doc_id = 50").collect()
    assert sorted((r["n_removed_chars"], r["kept"]) for r in strict) == [(0, True), (0, True), (cut, False)]


def test_repeated_short_sentences(spark):
    """Passages of short sentences, of one long sentence, and of other scripts go whole; what surrounds them stays."""
    shouted = " ".join(f"WORD{k}!!" for k in range(60))
    lines = "\n".join(["Menu", "Home page", "", " ", "About us today", "Contact", "All rights are reserved", "Top"]) + "\n"
    uneven = "One two three four. Five. Six seven eight nine."
    alone = " ".join(f"word{k}" for k in range(30)) + ".\n"
    han, hindi = "今日は晴れです。明日は雨でしょう。", "एक दो तीन चार पाँच। छह सात आठ नौ।"
    passages_ = [shouted, lines, uneven, alone, han, hindi, "Three words here."]
    rows = [(10 * k + d, f"{10 * k + d} has its own first words here.\n{p} {10 * k + d} ends with other words.") for k, p in enumerate(passages_) for d in (3, 5)]
    blank = "One two three four five six seven eight.\n \n"
    rows += [(901, blank + "Else."), (902, blank + "Other.")]
    found = {r["doc_id"]: r["text"] for r in sentence_dedup.remove_repeated_sentences(frame(spark, rows)).collect()}
    for k, passage in enumerate(passages_[:-1]):
        d = 10 * k + 5
        assert found[d - 2] == dict(rows)[d - 2]
        assert found[d].split() == f"{d} has its own first words here. {d} ends with other words.".split(), passage
    assert found[65] == dict(rows)[65]
    assert found[901] == dict(rows)[901] and found[902].split() == ["Other."]


def test_frequent_lines_removed(spark, none):
    menu = "Home  | About"
    rows = [(k, f"{menu.upper() if k % 2 else menu}\n\n{prose(k, 60)}\n {menu} \nEnd {k}") for k in range(4)]
    rows += [(10, menu), (11, None), (12, "Home\n"), (0, rows[0][1])]
    found = quality_rules.without_frequent_lines(frame(spark, rows), most_docs=3).collect()
    assert len(found) == len(rows)
    for row in found:
        text = dict(rows)[row["doc_id"]]
        if row["doc_id"] < 5:
            assert row["text"] == f"\n{prose(row['doc_id'], 60)}\nEnd {row['doc_id']}"
            assert row["n_removed_lines"] == 2 and row["kept"]
        else:
            assert (row["text"], row["kept"]) == ("" if row["doc_id"] == 10 else text, False)
    assert quality_rules.without_frequent_lines(none).count() == 0
