"""Secrets by fixed patterns and by a battery of randomness tests with false-discovery control per length.

A candidate is a run of at least 16 characters that an encoding could have written. The smallest alphabet that holds it is
its encoding, and its symbols should then be uniform and independent if it is a secret. Three tests ask that: chi-squared of
the symbol counts, runs above and below the alphabet's middle, and correlation of neighbouring symbols. Fisher's sum joins
them to one p-value, which ordinary text has near 0 and random strings anywhere.

How often ordinary text passes depends on its length: a short word can look random. So every candidate brings decoys,
stretches of its own document's other text of the same length, read through the same alphabet and put through the same
tests. Per encoding and length class, the lowest bar is taken that as many decoys clear as make up at most ``SHARE`` of the
candidates that clear it. Counts cover all documents; approximate p-values cost power only, as decoys share them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.operators.storage import stored

# The base patterns, the group whose length counts, and the least length.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", re.compile(ASSIGN, re.IGNORECASE | re.ASCII), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}"), 0, 16),
)
ASSIGNED = ("password", "passwd", "secret", "token", "key")
KINDS = [kind for kind, *_ in BASE] + ["random"]
# Encodings with their symbols, from the smallest alphabet to the largest.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", "234567" + _UPPER),
    ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", "+/" + _DIGITS + _UPPER + _LOWER),
    ("base64url", "-" + _DIGITS + _UPPER + "_" + _LOWER),
)
LEAST = 16
RUN = re.compile(rf"(?<![A-Za-z0-9])[A-Za-z0-9]{{{LEAST},}}")
WIDE = [re.compile(rf"(?<![A-Za-z0-9{s}])[A-Za-z0-9{s}]{{{LEAST},}}") for s in ("+/", "_-")]
#: Decoys per candidate, and the share of false discoveries that is let through per encoding and length class.
DECOYS, SHARE = 32, 0.05
#: Bars for the joint p-value; a p-value is kept as the number of bars that it clears.
BARS = (1e-4, 1e-3, 0.01, 0.05, 0.1, 0.2, 0.5)
_CODES = {}
for _name, _symbols in ENCODINGS:
    _CODES[_name] = np.full(128, -1, np.int16)
    _CODES[_name][[ord(c) for c in _symbols]] = np.arange(len(_symbols))
_both_tails = np.frompyfunc(lambda z: math.erfc(abs(z) / math.sqrt(2)), 1, 1)
_upper_tail = np.frompyfunc(lambda z: 0.5 * math.erfc(z / math.sqrt(2)), 1, 1)


def encoding_of(token: str) -> int | None:
    """Number of the smallest encoding whose alphabet holds the token; numbers and mixtures have none."""
    if token.isdigit():
        return None
    return next((k for k, (_, symbols) in enumerate(ENCODINGS) if not set(token) - set(symbols)), None)


def joint_p(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Per row of symbols: the chance that a random string fails the three tests so badly or worse."""
    rows, n = symbols.shape
    counts = np.bincount((symbols + alphabet * np.arange(rows)[:, None]).ravel(), minlength=rows * alphabet).reshape(rows, alphabet)
    chi, free = alphabet / n * (counts.astype(float) ** 2).sum(1) - n, alphabet - 1
    uneven = (np.cbrt(np.maximum(chi, 0) / free) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    high = symbols >= alphabet // 2
    changes = (high[:, 1:] != high[:, :-1]).sum(1)
    runs = (2 * changes - (n - 1)) / math.sqrt(n - 1)
    off = symbols - (alphabet - 1) / 2
    serial = (off[:, 1:] * off[:, :-1]).sum(1) / ((alphabet**2 - 1) / 12) / math.sqrt(n - 1)
    tails = [_upper_tail(uneven), _both_tails(runs), _both_tails(serial)]
    half = -np.log(np.maximum(np.array(tails, float), 1e-300)).sum(0)
    return np.exp(-half) * (1 + half + half**2 / 2)


def bars_cleared(p: np.ndarray) -> np.ndarray:
    return np.searchsorted(BARS, p, side="right")


def candidates(text: str) -> list[tuple[int, int, int, list[int]]]:
    """(start, end, encoding, numbers of the candidates around it): runs of letters and digits, and wider runs with signs."""
    wide = [(m.start(), m.end(), k) for pattern in WIDE for m in pattern.finditer(text) if not m[0].isalnum() and (k := encoding_of(m[0])) is not None]
    wide = sorted(wide)
    out, at = [(*w, []) for w in wide], 0
    for m in RUN.finditer(text):
        if (k := encoding_of(m[0])) is None:
            continue
        while at < len(wide) and max(w[1] for w in wide[at : at + 2]) <= m.start():  # of each alphabet, runs are apart
            at += 1
        out.append((m.start(), m.end(), k, [j for j in range(at, min(at + 4, len(wide))) if wide[j][0] <= m.start() and m.end() <= wide[j][1]]))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, in order."""
    lower, out = text.lower(), []
    for k, (kind, pattern, group, least) in enumerate(BASE):
        if kind != "assign" or any(word in lower for word in ASSIGNED):
            out += [(m.start(), m.end(), k) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out, key=lambda s: (s[0], s[2]))


def length_class(length: int) -> int:
    """Two classes per doubling."""
    return int(2 * math.log2(length))


def _tested(text: str, found: list[tuple[int, int, int, list[int]]], decoys: int) -> list[tuple[int, int, list[int]]]:
    """Per candidate: class, bars cleared, and the bars that its decoys clear."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(points) + 1, np.int32)
    for start, end, *_ in found:
        inside[start] += 1
        inside[end] -= 1
    other = points[(np.cumsum(inside)[:-1] == 0) & (points < 128)]
    through, out = {}, []
    for start, end, k, _ in found:
        name, symbols = ENCODINGS[k]
        if k not in through:
            codes = _CODES[name][other]
            through[k] = codes[codes >= 0]
        n, text_symbols, alphabet = end - start, through[k], len(symbols)
        own = bars_cleared(joint_p(_CODES[name][points[start:end]][None].astype(np.int64), alphabet))[0]
        room = len(text_symbols) - n
        places = np.unique(np.linspace(0, room, decoys).astype(np.int64)) if room >= 0 else np.zeros(0, np.int64)
        cleared, step = [], max(1, (1 << 20) // n)
        for at in range(0, len(places), step):
            stretch = text_symbols[places[at : at + step, None] + np.arange(n)].astype(np.int64)
            cleared += bars_cleared(joint_p(stretch, alphabet)).tolist()
        out.append((k * 1000 + length_class(n), int(own), cleared))
    return out


_BASE_TYPE = "array<struct<start:long,end:long,kind:int>>"
_CANDIDATE_TYPE = "array<struct<start:long,end:long,class:int,bars:int,covered:boolean,around:array<struct<class:int,bars:int>>,decoys:array<int>>>"


def _scan(decoys: int):
    spot = pa.struct([("class", pa.int32()), ("bars", pa.int32())])
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
    candidate_type = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("class", pa.int32()), ("bars", pa.int32()), ("covered", pa.bool_()), ("around", pa.list_(spot)), ("decoys", pa.list_(pa.int32()))])
    )

    def row(text: str) -> tuple[list, list]:
        base, found = base_spans(text), candidates(text)
        tested = _tested(text, found, decoys) if found else []
        starts, reach = [s for s, _, _ in base], np.maximum.accumulate([e for _, e, _ in base]) if base else []
        out = []
        for (start, end, _, around), (group, bars, cleared) in zip(found, tested, strict=True):
            before = int(np.searchsorted(starts, start, side="right"))  # base spans that start no later
            covered = before > 0 and reach[before - 1] >= end
            spots = [{"class": tested[j][0], "bars": tested[j][1]} for j in around]
            out.append({"start": start, "end": end, "class": group, "bars": bars, "covered": covered, "around": spots, "decoys": cleared})
        return [{"start": s, "end": e, "kind": k} for s, e, k in base], out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(text.as_py() or "") for text in batch["text"]]
            yield pa.record_batch([batch["id"], pa.array([b for b, _ in rows], base_type), pa.array([c for _, c in rows], candidate_type)], names=["id", "base", "candidates"])

    return run


def bars_by_class(scanned: DataFrame, share: float = SHARE) -> dict[int, int]:
    """Per class the least number of bars whose clearing lets through at most ``share`` of false discoveries.

    The estimate is (1 + decoys that clear) / decoys * candidates / (candidates that clear). Counts are summed per task
    first; classes are six encodings times two lengths per doubling, so the driver sees a few hundred rows at most.
    """
    each = scanned.select(F.explode("candidates").alias("c"))
    counted = each.select("c.class", F.col("c.bars").alias("bars"), F.lit(1).alias("own"), F.lit(0).alias("decoy")).unionByName(
        each.select("c.class", F.explode("c.decoys").alias("bars"), F.lit(0).alias("own"), F.lit(1).alias("decoy"))
    )
    sums = counted.groupBy("class", "bars").agg(F.sum("own").alias("own"), F.sum("decoy").alias("decoy"))
    clear, every = Window.partitionBy("class").orderBy(F.col("bars").desc()), Window.partitionBy("class")
    sums = sums.select(
        "class", "bars", F.sum("own").over(clear).alias("own"), F.sum("decoy").over(clear).alias("decoy"),
        F.sum("own").over(every).alias("all_own"), F.sum("decoy").over(every).alias("all_decoys"),
    )
    false_share = (1 + F.col("decoy")) * F.col("all_own") / (F.col("all_decoys") * F.col("own"))
    good = sums.where("bars > 0 and own > 0 and all_decoys > 0").where(false_share <= share)
    return {row["class"]: row["bars"] for row in good.groupBy("class").agg(F.min("bars").alias("bars")).collect()}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, decoys: int = DECOYS) -> DataFrame:
    """``id``, ``base`` and ``spans`` (all spans: start, end and kind number, in order) per row; code points, end exclusive.

    Base spans are the matches of the fixed patterns. Candidates that clear their class's bar are added as kind ``random``
    unless a base span or another added span holds them. Null and empty texts have no spans; repeated rows count as often
    as they stand there; texts are read whole and once; other columns are left out. Plain numbers are no candidates. A
    document with too little other text for a candidate's length adds no decoys; its candidates are judged by their class.
    """
    small_batches(docs.sparkSession)
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    scanned = stored(read.mapInArrow(_scan(decoys), f"id {kind}, base {_BASE_TYPE}, candidates {_CANDIDATE_TYPE}"), "secret-candidates")
    bars = bars_by_class(scanned, share)
    known = F.create_map(*[F.lit(x) for pair in (bars or {-1: 0}).items() for x in pair])
    clears = lambda c: F.coalesce(c["bars"] >= F.element_at(known, c["class"]), F.lit(False))
    added = F.filter("candidates", lambda c: clears(c) & ~c["covered"] & ~F.exists(c["around"], clears))
    spans = F.transform(added, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit(len(BASE)).alias("kind")))
    by_place = F.transform(F.concat("base", spans), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return scanned.select("id", "base", F.array_sort(by_place).alias("spans"))


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def kind_count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
