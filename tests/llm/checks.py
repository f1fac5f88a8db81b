"""Plain single-process versions that results are held against."""

import zlib
from collections import defaultdict


def packing_faults(rows, texts, encode, capacity=2048, end_id=0):
    """What is wrong with packed rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset); ids are unique."""
    faults, ids, by_doc, by_sequence = [], {k: [*encode(t or ""), end_id] for k, t in texts.items()}, defaultdict(list), defaultdict(list)
    for row in rows:
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        if zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) != row["ids_crc32"]:
            faults.append(("crc", row))
        by_doc[row["doc_id"]].append((row["piece"], row["start"], row["length"]))
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    for doc, whole in ids.items():
        wanted = [(k, p, min(capacity, len(whole) - p)) for k, p in enumerate(range(0, len(whole), capacity))]
        if sorted(by_doc[doc]) != wanted:
            faults.append(("pieces", doc))
    for sequence, placed in by_sequence.items():
        end = 0
        for offset, length in sorted(placed):
            if offset != end:
                faults.append(("gap", sequence))
            end = offset + length
        if end > capacity:
            faults.append(("long", sequence))
    return faults


def repeated_bytes(texts, length=50):
    """Per id: bytes, removed bytes, removed runs and the kept bytes, by a table of all strings."""
    least, out = {}, {}
    for doc, text in sorted(texts.items()):
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            least.setdefault(raw[p : p + length], doc)
    for doc, text in texts.items():
        raw = (text or "").encode()
        gone = bytearray(len(raw) + 1)
        for p in range(len(raw) - length + 1):
            if least[raw[p : p + length]] < doc:
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out[doc] = (len(raw), sum(gone), runs, bytes(b for k, b in enumerate(raw) if not gone[k]))
    return out


def jaccard_classes(rows, width=5, percent=75):
    """Per row (id, text): set size and smallest id reachable by links, over all pairs."""
    import re

    sets, parent = [], {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets.append((doc, grams))
        parent[doc] = doc

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return sorted((doc, len(grams), root(doc)) for doc, grams in sets)


def passages(rows, items, width=10):
    """Per row (id, text): words, hit words and item ids, by comparing every window with every place."""
    import re

    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words_of(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def vector_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Rows (id, label, vector) to {id: (code, error)}, the sum of errors per label, and the codebooks; ids are unique."""
    import math

    kept = [(i, label, [math.floor(x * scale) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0))
    width = len(kept[0][2]) // parts if kept else 0
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda v, p: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, _, v in kept:
            for p in range(parts):
                groups[p, nearest(v, p)[1]].append(cut(v, p))
        for (p, e), members in groups.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    codes, errors = {}, defaultdict(int)
    for i, label, v in kept:
        found = [nearest(v, p) for p in range(parts)]
        codes[i] = ([e for _, e in found], sum(d for d, _ in found))
        errors[label] += codes[i][1]
    return codes, dict(errors), books


def negatives_of(rows, step, positives=5, negatives=5, percent=80, scale=256):
    """Rows (id, label, vector) to (anchor, positive, rank, negative, positive score, negative score), by all pairs."""
    import math

    usable = [
        (i, label, [math.floor(x * scale) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, a in (row for row in usable if row[0] % step == 0):
        scored = [(-sum(x * y for x, y in zip(a, v)), j, other) for j, other, v in usable]
        for score, j, _ in sorted(s for s in scored if s[2] == label and s[1] != i)[:positives]:
            fit = sorted(s for s in scored if s[2] != label and percent * -score <= 100 * -s[0] <= 100 * -score)[:negatives]
            out += [(i, j, rank, n, -score, -s) for rank, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


def secret_spans(rows, share=0.05, decoys=32):
    """Per row (id, text): base spans and all spans as text, with every test written out for one string at a time."""
    import math
    import re

    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [
        sorted(a) for a in (digits + "abcdef", digits + "ABCDEF", "234567" + upper, digits + upper + lower, digits + upper + lower + "+/", digits + upper + lower + "-_")
    ]
    bars = (1e-4, 1e-3, 0.01, 0.05, 0.1, 0.2, 0.5)

    def p_value(word, alphabet):
        n, m = len(word), len(alphabet)
        x = [alphabet.index(c) for c in word]
        chi = sum((x.count(s) - n / m) ** 2 for s in range(m)) * m / n
        z = ((chi / (m - 1)) ** (1 / 3) - 1 + 2 / (9 * (m - 1))) / math.sqrt(2 / (9 * (m - 1)))
        changes = sum((a >= m // 2) != (b >= m // 2) for a, b in zip(x, x[1:]))
        mid, spread = (m - 1) / 2, (m * m - 1) / 12
        serial = sum((a - mid) * (b - mid) for a, b in zip(x, x[1:])) / spread / math.sqrt(n - 1)
        p = [math.erfc(z / math.sqrt(2)) / 2, math.erfc(abs(2 * changes - n + 1) / math.sqrt(2 * (n - 1))), math.erfc(abs(serial) / math.sqrt(2))]
        half = -sum(math.log(max(v, 1e-300)) for v in p)
        return math.exp(-half) * (1 + half + half * half / 2)

    cleared = lambda word, k: sum(p_value(word, alphabets[k]) >= bar for bar in bars)
    found = {}
    for at, (_, text) in enumerate(rows):
        text = text or ""
        assign = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
        base = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        runs = [(m.start(), m.end()) for signs in ("", "+/", "_-") for m in re.finditer(f"[A-Za-z0-9{signs}]+", text) if len(m[0]) >= 16 and (not signs or set(m[0]) & set(signs))]
        runs = [(s, e, next(k for k, a in enumerate(alphabets) if set(text[s:e]) <= set(a))) for s, e in runs if not text[s:e].isdigit()]
        held = {p for s, e, _ in runs for p in range(s, e)}
        other = [c for p, c in enumerate(text) if p not in held]
        tests = []
        for s, e, k in runs:
            mine = [c for c in other if c in alphabets[k]]
            room = len(mine) - (e - s)
            places = sorted({int(room * j / (decoys - 1)) for j in range(decoys)}) if room >= 0 else []
            tests.append((s, e, (k, int(2 * math.log2(e - s))), cleared(text[s:e], k), [cleared(mine[p : p + e - s], k) for p in places]))
        found[at] = (sorted(base), tests)
    every = [t for _, tests in found.values() for t in tests]
    least = {}
    for group in {t[2] for t in every}:
        own, others = [t[3] for t in every if t[2] == group], [d for t in every if t[2] == group for d in t[4]]
        for bar in range(len(bars), 0, -1):
            n = sum(x >= bar for x in own)
            if n and others and (1 + sum(x >= bar for x in others)) * len(own) / (len(others) * n) <= share:
                least[group] = bar
    out = []
    for at, (doc, _) in enumerate(rows):
        base, tests = found[at]
        good = [(s, e) for s, e, group, bar, _ in tests if bar >= least.get(group, 99)]
        good = [(s, e) for s, e in good if not any((a, b) != (s, e) and a <= s and e <= b for a, b in good)]
        added = [(s, 3, e) for s, e in good if not any(a <= s and e <= b for a, _, b in base)]
        text = lambda spans: ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        out.append((doc, text(base), text(base + added)))
    return out
