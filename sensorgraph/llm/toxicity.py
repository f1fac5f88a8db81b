"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nystroem landmarks."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.llm.text import NOT_WHITE, byte_column, pieces, ranges, span_hashes, spans
from sensorgraph.operators.storage import stored

#: Kernel: triples of letters within a span of SPAN characters, each character of the span weighing DECAY.
SPAN, DECAY = 8, 0.7
LETTERS = 64  # codes of letters; 0 is any other character, which only widens a gap, 1 the edge of a word
LONG_WORD = 32  # longer words are looked at in windows that overlap by half
#: Bounds of what is fitted on: documents per class, words per class, landmarks per class.
SAMPLE_DOCS, SAMPLE_WORDS, LANDMARKS = 8000, 4000, 160
KEPT_WORDS = 2_000_000
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
_SHORT = 2  # words of so many bytes may be letters of one word written apart
_SHIFTS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


class Triples(NamedTuple):
    """Per word its distinct triples with weights, scaled to length 1: a sparse row of the kernel's feature space."""

    word: np.ndarray
    code: np.ndarray
    weight: np.ndarray


def triples(words: list[str]) -> Triples:
    """Explicit features of the kernel; the kernel of two words is the product of their rows."""
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    points = np.frombuffer("".join(f"\0{w.lower()}\0"[: len(w) + 2] for w in words).encode("utf-32-le"), np.uint32)
    letter = np.frompyfunc(lambda c: chr(c).isalpha(), 1, 1)
    distinct, where = np.unique(points, return_inverse=True)
    codes = np.array([1 if c == 0 else 2 + int(c) % (LETTERS - 2) if letter(int(c)) else 0 for c in distinct.tolist()], np.int64)
    code = codes[where] if len(points) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    last = np.cumsum(lengths)[owner] if len(words) else owner
    place = np.arange(len(code))
    keys, weights = [], []
    for a, b in _SHIFTS:
        i = place[place + b < last]
        first, second, third = code[i], code[i + a], code[i + b]
        fine = (first > 0) & (second > 0) & (third > 0)
        i = i[fine]
        keys.append((owner[i] * LETTERS + code[i]) * LETTERS**2 + code[i + a] * LETTERS + code[i + b])
        weights.append(np.full(len(i), DECAY ** (b + 1)))
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(at, np.concatenate(weights), len(key))
    word, code = np.divmod(key, LETTERS**3)
    norm = np.sqrt(np.bincount(word, weight**2, len(words)))
    return Triples(word, code, weight / norm[word])


def kernel(rows: Triples, n: int, landmarks: Triples, m: int) -> np.ndarray:
    """Kernel values of ``n`` words and ``m`` landmarks."""
    out = np.empty((n, m))
    for k in range(m):
        table = np.zeros(LETTERS**3)
        mine = landmarks.word == k
        table[landmarks.code[mine]] = landmarks.weight[mine]
        out[:, k] = np.bincount(rows.word, rows.weight * table[rows.code], n)
    return out


class Model(NamedTuple):
    table: np.ndarray  # weight of each triple
    bias: float
    document: np.ndarray  # weights of the document features, the constant last


def _spread(rows: Triples, n: int, most: int) -> list[int]:
    """Words in order, without those that are close to one taken before."""
    taken, nearest = [], np.zeros(n)
    for k in range(n):
        if nearest[k] < 0.75 and len(taken) < most:
            taken.append(k)
            table, mine = np.zeros(LETTERS**3), rows.word == k
            table[rows.code[mine]] = rows.weight[mine]
            nearest = np.maximum(nearest, np.bincount(rows.word, rows.weight * table[rows.code], n))
    return taken


def fit_words(toxic: list[tuple[str, float]], clean: list[tuple[str, float]], strictness: float = 8.0) -> tuple[np.ndarray, float]:
    """Squared-hinge machine on Nystroem features; returned as weights of triples, which scores any word.

    All clean words together weigh ``strictness`` times as much as the toxic ones: a text has far more of them.
    """
    words, weight = [w for w, _ in toxic + clean], np.array([c for _, c in toxic + clean], float)
    label = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    marks = [w for w, _ in (toxic[k] for k in _spread(triples([w for w, _ in toxic]), len(toxic), LANDMARKS))]
    marks += [w for w, _ in clean[:LANDMARKS]]
    rows, mark_rows = triples(words), triples(marks)
    among = kernel(mark_rows, len(marks), mark_rows, len(marks))
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    x = np.column_stack((kernel(rows, len(words), mark_rows, len(marks)) @ root, np.ones(len(words))))
    for side, total in ((1, 1.0), (-1, strictness)):
        weight[label == side] *= total / max(weight[label == side].sum(), 1e-12)
    w, ridge = np.zeros(x.shape[1]), 1e-4 * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(50):  # Newton steps on the words that violate the margin
        inside = label * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(ridge + a.T @ x[inside], a.T @ label[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    mark_weight = root @ w[:-1]
    table = np.bincount(mark_rows.code, mark_rows.weight * mark_weight[mark_rows.word], LETTERS**3)
    return table, float(w[-1])


class WordScores:
    """Scores of words by hash, kept per task."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.hashes, self.scores = np.zeros(0, np.uint64), np.zeros(0)

    def direct(self, words: list[str]) -> np.ndarray:
        """The highest score among a word's windows."""
        parts, owner = [], []
        for k, word in enumerate(words):
            for p in range(0, max(1, len(word) - LONG_WORD // 2), LONG_WORD // 2) if len(word) > LONG_WORD else (0,):
                parts.append(word[p : p + LONG_WORD])
                owner.append(k)
        out = np.full(len(words), -np.inf)
        for p in range(0, len(parts), 4096):
            rows = triples(parts[p : p + 4096])
            score = np.bincount(rows.word, rows.weight * self.table[rows.code], len(parts[p : p + 4096])) + self.bias
            np.maximum.at(out, owner[p : p + 4096], score)
        return out

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes, first, where = np.unique(span_hashes(data, starts, ends, lower=True), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        scores = np.zeros(len(hashes))
        scores[known] = self.scores[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            scores[new] = self.direct(words)
            if len(self.hashes) + len(new) > KEPT_WORDS:
                self.hashes, self.scores = np.zeros(0, np.uint64), np.zeros(0)
            joined = np.concatenate((self.hashes, hashes[new]))
            order = np.argsort(joined, kind="stable")
            self.hashes, self.scores = joined[order], np.concatenate((self.scores, scores[new]))[order]
        return scores[where]


#: Per document: its three highest sentence scores, share and logarithm of the number of sentences above 0.
FEATURES = 5


def document_features(scorer: WordScores, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts, ends, first = spans(data, offsets, NOT_WHITE)
    count = len(offsets) - 1
    text = np.repeat(np.arange(count), np.diff(first))
    score = scorer.of(data, starts, ends)
    ended = np.concatenate(([0], np.cumsum(_ENDS[data])))
    sentence = ended[starts] + text  # grows with each end of a sentence and with each text
    score = _with_spelled(scorer, data, starts, ends, sentence, score)
    out = np.tile([-2.0, -2.0, -2.0, 0.0, 0.0], (count, 1))
    if not len(starts):
        return out
    begins = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
    best, owner = np.clip(np.maximum.reduceat(score, begins), -2, 2), text[begins]
    order = np.lexsort((-best, owner))
    best, owner = best[order], owner[order]
    nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
    for k in range(3):
        out[owner[nth == k], k] = best[nth == k]
    above = np.bincount(owner, best > 0, count)
    out[:, 3] = above / np.maximum(np.bincount(owner, minlength=count), 1)
    out[:, 4] = np.log1p(above)
    return out


def _with_spelled(scorer, data, starts, ends, sentence, score):
    """Runs of three or more very short words of a sentence also count as one word written apart."""
    short = ends - starts <= _SHORT
    edge = np.diff(np.concatenate(([0], short.astype(np.int8), [0])))
    begin, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    apart = after - begin >= 3
    begin, after = begin[apart], after[apart]
    apart = sentence[begin] == sentence[after - 1]
    begin, after = begin[apart], after[apart]
    if len(begin):  # all runs at once: a call of the scorer for each run costs most of the time
        inside = ranges(begin, after - begin)
        sizes = (ends - starts)[inside]
        joined = data[ranges(starts[inside], sizes)].tobytes()
        edges = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(after - begin)))].tolist()
        words = [joined[a:b].decode() for a, b in itertools.pairwise(edges)]
        distinct = list(dict.fromkeys(words))
        found = dict(zip(distinct, scorer.direct(distinct).tolist(), strict=True))
        score[begin] = np.maximum(score[begin], [found[word] for word in words])
    return score


def _featured(docs: DataFrame, id_col: str, text_col: str, table: np.ndarray, bias: float, document: np.ndarray | None):
    model = docs.sparkSession.sparkContext.broadcast((table, bias, document))
    small_batches(docs.sparkSession)
    names = ["doc_id", "features"] if document is None else ["doc_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScores(*model.value[:2])
        weights = model.value[2]
        for batch in batches:
            data, offsets = byte_column(batch.column(1))
            for a, b in pieces(offsets):
                found = document_features(scorer, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if weights is None:
                    column = pa.array(found.tolist(), pa.list_(pa.float64()))
                else:
                    column = pa.array(1 / (1 + np.exp(-np.clip(found @ weights[:-1] + weights[-1], -40, 40))))
                yield pa.record_batch([batch.column(0).slice(a, b - a), column], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, features array<double>" if document is None else "doc_id long, score double")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on labelled rows outside the held-out fifth: at most ``SAMPLE_DOCS`` per class, those of least hash.

    A label of a document holds for its sentences only through their words: words that stand in significantly more
    toxic than clean documents are the positive examples (all words of clean documents are negative), the kernel
    machine learns to tell them apart, and a logistic regression on the scores of a document's sentences decides.
    Without labels of both classes every score is the share of toxic labels (0 without labels).
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = stored(known, "labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    drawn = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS) for k in (0, 1)]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most 2 * SAMPLE_DOCS rows of two columns, so the texts stay where they are.
    sample = stored(texts.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id"), "labelled")
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 1))
    counts = sample.select("toxic", F.explode(words).alias("word")).groupBy("word")
    counts = stored(counts.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "word-counts")
    many = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = many.get(1, 0), many.get(0, 0)
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    constant = Model(np.zeros(LETTERS**3), -1.0, np.array([0.0] * FEATURES + [np.log(max(share, 1e-9) / max(1 - share, 1e-9))]))
    if not n_toxic or not n_clean:
        return constant
    rate_t, rate_c, both = F.col("t") / n_toxic, F.col("c") / n_clean, (F.col("t") + F.col("c")) / (n_toxic + n_clean)
    surprise = (rate_t - rate_c) / F.sqrt((both + 1e-9) * (1 - both + 1e-9) * (1 / n_toxic + 1 / n_clean))
    rated = counts.select("word", "t", "c", surprise.alias("z")).where((F.col("t") >= 2) & (F.col("z") > 3.5) & (rate_t > 8 * rate_c))
    toxic = [(r["word"], float(r["t"]) ** 1.5) for r in rated.orderBy(F.desc("z"), "word").limit(SAMPLE_WORDS).collect()]
    clean = counts.where("c >= 1").orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS).select("word", "c").collect()
    common = counts.where("c >= 1").orderBy(F.desc("c"), "word").limit(SAMPLE_WORDS).select("word", "c").collect()
    positive = {w for w, _ in toxic}
    clean = {r["word"]: float(np.sqrt(r["c"])) for r in [*clean, *common] if r["word"] not in positive}
    if not toxic or not clean:
        return constant
    table, bias = fit_words(toxic, list(clean.items()))
    featured = _featured(sample, "doc_id", "text", table, bias, None).join(sample.select("doc_id", "toxic").distinct(), "doc_id")
    rows = featured.collect()
    x = np.column_stack((np.array([r["features"] for r in rows]), np.ones(len(rows))))
    y = np.array([r["toxic"] for r in rows], float)
    weight = np.where(y == 1, sizes[1] / n_toxic, sizes[0] / n_clean) / sum(sizes.values())
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of the logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-5 * np.eye(len(w))
        w = w + np.linalg.solve(curve, x.T @ (weight * (y - p)) - 1e-5 * w)
    return Model(table, bias, w)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` in 0..1 per row, over whole texts and without a shuffle.

    Null and empty texts get the score of a text without sentences; repeated rows each theirs; an empty table no row;
    a very long text is looked at whole. The model is 2 MB, whatever the size of the corpus.
    """
    return _featured(docs, id_col, text_col, model.table, model.bias, model.document)
