"""Secret scans against a plain version, and what the randomness battery finds and leaves alone."""

import base64
import random
import re

import numpy as np

from sensorgraph.llm import secret_scans
from tests.llm.checks import secret_spans
from tests.llm.test_operators import SCHEMA, prose

R = random.Random(11)
SYMBOLS = {name: symbols for name, symbols in secret_scans.ENCODINGS}


def token(name, n):
    return "".join(R.choices(SYMBOLS[name], k=n))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "h", 0, 1, "s", 2, 3) for d, t in rows], SCHEMA).repartition(3)


PLANTED = [(name, n) for name in SYMBOLS for n in (24, 40, 64, 90)]
TEXTS = [(k, f"{prose(k, 150)} key {token(name, n)} {prose(100 + k, 150)}") for k, (name, n) in enumerate(PLANTED)]
WORDS = [
    "Donaudampfschifffahrtsgesellschaftskapitaen", "pneumonoultramicroscopicsilicovolcanoconiosis", "getApplicationConfigurationManagerInstance",
    "some/path/to/an/ordinary/folder", "a-long-hyphenated-name-of-something", "snake_case_identifier_with_words", "AAAAAAAAAAAAAAAAAAAAAAAA", "0123456789012345678901",
]
PLAIN = [(200 + k, f"{prose(200 + k, 200)} {w} {prose(300 + k, 100)}") for k, w in enumerate(WORDS)]
ODD = [
    (400, None), (401, ""), (402, " \n"), (403, "Token: 'abcdefghijklmnop' PASSWORD=short api_KEY = " + "A1" * 10), (404, "secret=" + "x" * 12 + "token:abc.def-ghi_jkl"),
    (405, "AKIA" + "Z9" * 7 + " AKIAAKIA" + "Q" * 10 + " AKIA12"), (406, "é" * 30 + "deadbeef" * 3 + "ß" + "0" * 15), (407, "ſecret=aaaaaaaaaaaaaa toKen=bbbbbbbbbbbbbbbb"),
    (408, token("base62", 200)), (409, f"{prose(9, 60)} {token('base64', 30)}-{token('base64url', 30)} {prose(10, 60)}"), (20, TEXTS[0][1]), (20, TEXTS[0][1]), (None, TEXTS[5][1]),
    (410, prose(12, 20_000) + f" {token('base62', 700)} and {token('hex', 33)}"), (411, "\U0001f600 " * 5 + token("base64url", 43) + " \U0001f600"),
]


def found(spark, rows, **options):
    df = secret_scans.find_secrets(frame(spark, rows), **options)
    return df.select("id", secret_scans.spans_text("base").alias("base"), secret_scans.spans_text("spans").alias("spans")).collect()


def test_spans_equal_plain_version(spark):
    rows = TEXTS + PLAIN + ODD
    assert sorted(map(tuple, found(spark, rows)), key=repr) == sorted(secret_spans(rows), key=repr)


def test_random_strings_are_found_and_words_are_not(spark):
    result = {r["id"]: r for r in found(spark, TEXTS + PLAIN)}
    # The words of these texts hold digits; cut to 24 symbols, some of them look as random as a key of that length.
    assert [PLANTED[k] for k in range(len(PLANTED)) if not result[k]["spans"] and PLANTED[k][1] > 24] == []
    assert [r["spans"] for k, r in result.items() if k >= 200 and r["spans"] != r["base"]] == []
    whole = base64.b64encode(bytes(R.randrange(256) for _ in range(48))).decode()
    assert found(spark, [(1, f"{prose(1, 300)} {whole} {prose(2, 300)}")])[0]["spans"].count("random") == 1


def test_no_rows_and_no_candidates(spark):
    assert found(spark, []) == []
    assert sorted(tuple(r) for r in found(spark, [(1, "nothing here"), (2, None)])) == [(1, "", ""), (2, "", "")]


def test_short_lengths_need_more_than_long_ones():
    """Random strings have uniform p-values; those of text fall with its length."""
    r = np.random.default_rng(1)
    p = secret_scans.joint_p(r.integers(0, 64, (4000, 40)), 64)
    assert abs((p < 0.5).mean() - 0.5) < 0.06 and (p < 0.001).mean() < 0.01
    letters = np.frombuffer(re.sub("[^A-Za-z]", "", prose(5, 4000)).encode(), np.uint8)
    codes = secret_scans._CODES["base62"][letters[letters < 128]]
    codes = codes[codes >= 0].astype(np.int64)
    for n, most in ((16, 0.4), (24, 0.02), (32, 0.001), (64, 1e-4)):
        places = np.arange(0, len(codes) - n, 7)
        assert (secret_scans.joint_p(codes[places[:, None] + np.arange(n)], 62) >= 1e-4).mean() <= most
