"""Language identification against a plain version, on held-out rows and with many languages."""

import math
import random
from collections import Counter

import numpy as np

from sensorgraph.llm import language_id
from sensorgraph.llm.text import LOWER

FOLDER = "/root/testdata/sf0.01"
COLUMNS = "id long, kind string, text string, lang string, host string, domain string, suffix string, markup string"


def cells(text):
    b = [int(LOWER[x]) for x in text.encode()]
    return [((b[i] * 0x9E3779B1 + b[i + 1] * 0x85EBCA6B + b[i + 2] * 0xC2B2AE35) % 2**32 >> 13) % language_id.CELLS for i in range(len(b) - 2)]


def normal(terms):
    top = max(terms)
    e = [math.exp(x - top) for x in terms]
    return [x / sum(e) for x in e]


def plain(rows):
    """Id to (language, confidence), one row at a time; every labelled text is in the sample."""
    names = sorted({r[3] for r in rows if r[3] and r[2]})
    count = {name: Counter() for name in names}
    for r in rows:
        if r[3] and r[2]:
            count[r[3]].update(cells(r[2]))
    size = {name: sum(c.values()) + 0.5 * language_id.CELLS for name, c in count.items()}
    scores = []
    for r in rows:
        found = cells(r[2] or "")
        weight = min(len(found), language_id.TEXT_WEIGHT) / max(len(found), 1)
        ll = [weight * sum(math.log((count[name][c] + 0.5) / size[name]) for c in found) for name in names]
        scores.append((len(found), [x - max(ll) for x in ll], normal(ll)))
    known = [(r, p) for r, (n, _, p) in zip(rows, scores) if n]
    add = lambda some: [sum(p[k] for p in some) for k in range(len(names))]
    world = [x + 1 for x in add([p for _, p in known])]
    world = [x / sum(world) for x in world]
    out = {}
    for r, (n, ll, own) in zip(rows, scores):
        prior = world
        for at in (5, 4):
            left = [max(a - b, 0) for a, b in zip(add([p for q, p in known if q[at] == r[at] and r[at] is not None]), own if n else [0] * len(names))]
            prior = [(a + language_id.HOST_SMOOTHING * b) / (sum(left) + language_id.HOST_SMOOTHING) for a, b in zip(left, prior)] if sum(left) else prior
        terms = [a + math.log(b) for a, b in zip(ll, prior)]
        for at in (6, 7):
            group, every = add([p for q, p in known if q[at] == r[at]]), add([p for q, p in known if q[at] is not None])
            if r[at] is not None and sum(group):
                base = language_id.MARKUP_SMOOTHING * sum(group) / sum(every)
                terms = [t + math.log((g + base) / (e + language_id.MARKUP_SMOOTHING)) for t, g, e in zip(terms, group, every)]
        posterior = normal(terms)
        out[r[0]] = (names[posterior.index(max(posterior))], max(posterior))
    return out


def test_posterior_is_that_of_a_plain_version(spark):
    r = random.Random(3)
    words = {"aa": ["kato", "mire", "solun", "pelta"], "bb": ["katu", "mira", "solen", "dorn"], "cc": ["wix", "mira", "zonk", "kato"]}
    rows = []
    for k in range(90):
        lang = r.choice(sorted(words))
        text = " ".join(r.choices(words[lang], k=r.choice([1, 2, 12, 60])))
        host = None if k % 9 == 0 else f"h{r.randrange(6)}.{lang}.org"
        declared = r.choice([None, lang, lang, r.choice(sorted(words))])
        rows.append((k, "page", text, lang if k % 3 else None, host, host and f"{lang}.org", r.choice([None, lang]), declared))
    rows += [(200, "page", None, None, "h1.aa.org", "aa.org", None, "bb"), (201, "page", "", "aa", None, None, "cc", None), (202, "page", "ka", None, None, None, None, "zz")]
    found = language_id.identify(spark.createDataFrame(rows, COLUMNS).repartition(4)).collect()
    expected = plain(rows)
    assert len(found) == len(rows)
    for row in found:
        language, confidence = expected[row["id"]]
        assert row["language"] == language and abs(row["confidence"] - confidence) < 1e-4, row


def test_two_hundred_languages(spark):
    """Every language has words of its own; all 200 are told apart, and a bound on the modelled ones raises nothing."""
    r = random.Random(5)
    words = [["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for _ in range(200)]
    rows = [(k, "document", " ".join(r.choices(words[k % 200], k=30)), f"l{k % 200:03}" if k < 800 else None, f"h{k % 7}", None, None, None) for k in range(1000)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    found = language_id.identify(df).collect()
    assert len(found) == 1000 and all(row["language"] == f"l{row['id'] % 200:03}" for row in found)
    few = language_id.identify(df.where("id < 800"), most_languages=3).collect()
    assert len(few) == 800 and {row["language"] for row in few} == {"l000", "l001", "l002"}


def test_held_out_accuracy(spark):
    """Labels of a fifth of the documents are hidden from the model."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language_id.document_rows(docs)
    hidden = "pmod(crc32(cast(id as string)), 5) = 0"
    seen = rows.selectExpr("id", "kind", "text", f"case when not {hidden} then lang end as lang", "host", "domain", "suffix", "markup")
    lang = {r["id"]: r["lang"] for r in rows.where(hidden).select("id", "lang").collect()}
    right = [r["language"] == lang[r["id"]] for r in language_id.identify(seen).collect() if r["id"] in lang]
    print(f"held out {len(right)}, accuracy {np.mean(right):.4f}")
    assert len(right) > 100 and np.mean(right) >= 0.97


def test_awkward_rows(spark):
    """Repeated rows, very long texts, texts of one or two bytes and rows without an id each give one row."""
    long_text = "der die und nicht einer der schon auch wenn " * 20_000
    rows = [(1, "document", long_text, "de", "h", None, None, None), (1, "document", long_text, "de", "h", None, None, None)]
    rows += [(2, "document", "the and not one of with they when that", "en", None, None, None, None), (None, "document", "the one that they", None, None, None, None, None)]
    rows += [(3, "document", "x", None, "h", None, None, None), (4, "document", "xy", None, None, None, None, None)]
    found = [(r["id"], r["language"], r["accepted"]) for r in language_id.identify(spark.createDataFrame(rows, COLUMNS)).collect()]
    assert found.count((1, "de", True)) == 2 and (2, "en", True) in found and (None, "en", True) in found
    assert len(found) == 6 and {(i, a) for i, _, a in found if i in (3, 4)} == {(3, False), (4, False)}
