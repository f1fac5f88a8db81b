"""Removal of sentences that lie in a repeated run of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sensorgraph.llm.rows import HASH, ID, TEXT, attach, keyed, once, small_batches
from sensorgraph.operators.storage import stored

#: End marks of all scripts and all line ends.
ENDS = ".!?\\n\\x0B\\f\\r\x85\u2028\u2029…‼⁇⁈⁉。．！？｡؟۔।॥։።፧፨။។៕།༎"
#: A sentence with what ends it; every character of a text is in exactly one.
SENTENCE = f"[^{ENDS}]*+[{ENDS}]++|[^{ENDS}]++"
#: Characters of scripts that set no spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = "\u0e01-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


_SENTENCE = re.compile(SENTENCE)
_MARKS = re.compile(rf"[ \t-\r{ENDS}]+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_WORD = re.compile(f"[{UNSPACED}]{{1,2}}|[^ {UNSPACED}]+")
#: Runs of a batch that a task hands on.
RUNS_PER_BATCH = 50_000


def normal_sentence(sentence: str) -> str:
    """As compared: lower case, no end marks, single spaces."""
    return _MARKS.sub(" ", sentence.lower()).strip(" ")


def n_words(normal: str) -> int:
    if not normal.isascii() and _UNSPACED.search(normal):
        return len(_WORD.findall(normal))
    return normal.count(" ") + 1 if normal else 0


def _least(words: list[int], places: range, run: int, least_words: int) -> int:
    """How many sentences from the first of these places on make a run; 0 if they do not."""
    total = 0
    for k, p in enumerate(places, 1):
        total += words[p]
        if k >= run and total >= least_words:
            return k
    return 0


def covering_runs(words: list[int], run: int, least_words: int, alone_words: int) -> Iterator[tuple[int, int]]:
    """First and last place of the shortest runs with enough sentences and words from every sentence on and up to every
    sentence, and of long sentences alone. Every sentence has a word, so a run is over after ``least_words``.

    The runs from the left alone could leave the last sentences of a passage uncovered; with those from the right, two
    texts share a run over every sentence of a passage that has enough sentences and words.
    """
    n, most = len(words), max(run, least_words)
    for p in range(n):
        k = _least(words, range(p, min(p + most, n)), run, least_words)
        if k:
            yield p, p + k - 1
        k = _least(words, range(p, max(p - most, -1), -1), run, least_words)
        # A run that is also the shortest from its first sentence on is there already.
        if k > run and sum(words[p - k + 1 : p]) >= least_words:
            yield p - k + 1, p
        if words[p] >= alone_words:
            yield p, p


def hashed_runs(text: str, run: int, least_words: int, alone_words: int) -> Iterator[tuple[int, int, int, int]]:
    """``at, to, hash, chars`` of a text's runs: sentences without words are passed over, and runs that hold such a one
    are hashed beside. No normal sentence has a line end, so joined ones are equal only if all their sentences are."""
    normal = [normal_sentence(s) for s in _SENTENCE.findall(text)]
    words = [n_words(s) for s in normal]

    def hashed(at: int, to: int, sentences: list[str]) -> tuple[int, int, int, int]:
        return at, to, xxh64_intdigest("\n".join(sentences)), sum(map(len, sentences))

    full = [i for i, n in enumerate(words) if n]
    spoken = [normal[i] for i in full]
    for p, q in covering_runs([words[i] for i in full], run, least_words, alone_words):
        yield hashed(full[p], full[q], spoken[p : q + 1])
    if len(full) < len(words):
        for i in range(len(words) - run + 1):
            part = words[i : i + run]
            if 0 in part and sum(part) >= least_words:
                yield hashed(i, i + run - 1, normal[i : i + run])


def _runs(rows: DataFrame, run: int, least_words: int, alone_words: int) -> DataFrame:
    """``id, hash, at, to, a, chars`` of all runs; a row's text leaves its task only as these."""

    def batch_of(ids: pa.Array, hashes: pa.Array, row: list[int], found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        at, to, a, chars = zip(*found, strict=True)
        where = pa.array(row, pa.int64())
        columns = [ids.take(where), hashes.take(where), pa.array(at, pa.int32()), pa.array(to, pa.int32())]
        columns += [pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(chars, pa.int32())]
        return pa.record_batch(columns, [ID, HASH, "at", "to", "a", "chars"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = [], []
            for k in range(batch.num_rows):
                for one in hashed_runs(batch.column(2)[k].as_py(), run, least_words, alone_words):
                    row.append(k)
                    found.append(one)
                    if len(found) >= RUNS_PER_BATCH:
                        yield batch_of(batch.column(0), batch.column(1), row, found)
                        row, found = [], []
            if found:
                yield batch_of(batch.column(0), batch.column(1), row, found)

    small_batches(rows.sparkSession)
    return rows.select(ID, HASH, TEXT).mapInArrow(work, f"{ID} long, {HASH} long, at int, to int, a long, chars int")


def remove_repeated_sentences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = 2,
    least_words: int = 8,
    alone_words: int = 16,
) -> DataFrame:
    """The input with ``text`` less the sentences in repeated runs, and ``n_removed`` sentences.

    Runs of consecutive sentences are hashed that have ``run`` sentences and ``least_words`` words, or more sentences
    where so few have too few words; and single sentences of ``alone_words`` words. So of a passage that two documents
    share the later one loses every whole sentence, however short, if there are ``run`` of them with ``least_words``
    words. Sentences end at the marks of any script; of scripts without spaces two characters count as a word.

    Of equal runs the one of the smallest (id, place) stays; the sentences of all others are removed. Runs are taken
    from the input, so chains and overlaps do not depend on an order of removal. Runs are equal if hash and length agree.

    Null text stays null; texts of fewer sentences are left alone; a null id counts as the smallest; rows that repeat id
    and text are one document and keep or lose the same sentences; an empty table stays empty; other columns pass through,
    but for ``n_removed``, which is replaced.

    Runs are written once. First places are found by an aggregation that combines before its shuffle, and written; the
    join of all runs with the repeated ones then has plain inputs, so that a very frequent run is split. Only removed
    places move to the texts.
    """
    rows = keyed(docs, id_col, text_col)
    spans = stored(_runs(rows, run, least_words, alone_words), "sentence-runs")
    place = F.struct(ID, "at")
    groups = spans.groupBy("a", "chars").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    groups = stored(groups.where("n > 1").drop("n"), "repeated-runs")
    again = spans.join(groups, ["a", "chars"]).where(~(F.col(ID).eqNullSafe(F.col("first")[ID]) & (F.col("at") == F.col("first")["at"])))
    gone = again.groupBy(ID, HASH).agg(F.collect_set(F.struct("at", "to")).alias("__llm_gone"))
    gone = stored(gone, "repeated-places")
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumns({ID: F.col(id_col).cast("long"), HASH: F.xxhash64(text)})
    marked = attach(marked, gone).drop(ID, HASH)

    covered = F.array_distinct(F.flatten(F.transform("__llm_gone", lambda x: F.sequence(x["at"], x["to"]))))

    def kept(found: Column) -> Column:
        """Sentences at the places that are not covered; the set difference keeps order and is one pass."""
        left = F.array_except(F.sequence(F.lit(0), F.size(found) - 1), covered)
        return F.array_join(F.transform(left, lambda i: F.get(found, i)), "")

    changed = F.col("__llm_gone").isNotNull()
    return marked.withColumns(
        {
            text_col: F.when(changed, once(sentences(F.col(text_col)), kept)).otherwise(F.col(text_col)),
            "n_removed": F.when(changed, F.size(covered)).otherwise(0).cast("long"),
        }
    ).drop("__llm_gone")
