"""Prefix trie, vector codes and repeated spans against brute force, on awkward tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from almoner.llm import debruijn, prefix_trie, vector_codes

# --- 11: prefix trie


def trie_by_definition(turns: list[tuple]) -> Counter:
    said = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in said.items()}
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        whole[c] = said.get(base, [])[:h] + own[h:]
    members = defaultdict(set)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].add(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    childless = {p for p in members if sum(len(q) == len(p) + 1 for q in below[p]) == 0}
    rows = []
    for p, who in members.items():
        ends = sorted(c for c in who if len(whole[c]) == len(p))
        rows.append(
            (
                min(who), len(p), min(members[p[:-1]]) if p else None, len(who),
                sum(len(q) == len(p) + 1 for q in below[p]), sum(q in childless for q in below[p]),
                sum((len(members[q]) - 1) * len(q[-1][1]) for q in below[p] if q),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return Counter(rows)


def conversations() -> list[tuple]:
    rng = np.random.default_rng(4)
    rows = []
    for c in [*range(-130, 130), 5000, 5001, 5099]:
        for t in range(rng.integers(0, 12)):
            rows.append((c, t, "user" if t % 2 else "assistant", "ab"[rng.integers(0, 2)] * int(rng.integers(0, 3))))
    rows += [(200, t, "user", "the same turn") for t in range(40)]  # repeated texts, a long one
    rows += [(201, 0, "user", "the same turn")] * 9  # repeated rows
    rows += [(300, None, "user", "first"), (300, 2, None, None), (300, 1, "user", None), (None, 1, "user", "nobody's")]
    rows += [(c, 0, "user", "alone") for c in (399, 498)]  # their bases are absent
    return rows


@pytest.mark.parametrize("width", [1, 3, 4])
def test_trie(spark, width):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("block", "key0", "depth", "a0")})
    got = Counter(tuple(r) for r in prefix_trie.trie(frame.repartition(7), width).collect())
    assert got == trie_by_definition(rows)


def test_trie_of_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(empty).collect() == []


def test_trie_of_turnless_conversations(spark, monkeypatch):
    few = [(c, 0, "user", "x") for c in (1, 2, 3, 101, 102) if zlib.crc32(str(c).encode()) % 6]
    frame = spark.createDataFrame(few, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(prefix_trie, "CHUNK", 1)
    assert Counter(tuple(r) for r in prefix_trie.trie(frame).collect()) == trie_by_definition(few)


# --- 12: vector codes


def codes_by_definition(rows: list[tuple], length: int, entries: int = 16, rounds: int = 6):
    kept = [(v, lab, [math.floor(4096 * x) for x in e]) for v, lab, e in rows if e is not None and len(e) == length and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cuts = [(p * length // 8, (p + 1) * length // 8) for p in range(8)]
    books = [[r[2][i:j] for r in kept[:entries]] for i, j in cuts]

    def near(book, part):
        found = [sum((x - c) ** 2 for x, c in zip(part, entry)) for entry in book]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        for p, (i, j) in enumerate(cuts):
            held = defaultdict(list)
            for _, _, e in kept:
                held[near(books[p], e[i:j])[0]].append(e[i:j])
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else entry for k, entry in enumerate(books[p])]
    coded = []
    for v, lab, e in kept:
        found = [near(books[p], e[i:j]) for p, (i, j) in enumerate(cuts)]
        coded.append((v, lab, "".join(f"{k:02x}" for k, _ in found), sum(d for _, d in found)))
    whole = defaultdict(int)
    for _, lab, _, d in coded:
        whole[lab] += d
    fits = lambda x: x if x < 1 << 63 else None
    digest = hashlib.sha256(",".join(str(x) for b in books for r in b for x in r).encode()).hexdigest()
    bad = {lab for _, lab, _, d in coded if d >= 1 << 63}
    return Counter((v, c, fits(d), None if lab in bad else fits(whole[lab]), digest) for v, lab, c, d in coded)


def vectors(scale: float, length: int = 24, n: int = 90) -> list[tuple]:
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 4) if i % 7 else None, (rng.normal(0, scale, length)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(7, 1, rows[7][2]), (None, 2, rows[3][2]), (500, 1, [0.0] * length), (501, 1, [-0.0001] * length)]
    rows += [(502, 1, None), (503, 1, [None] + [1.0] * (length - 1)), (504, 1, [float("nan")] * length), (505, 2, [float("inf")] * length), (506, 3, [1.0] * (length - 1)), (507, 3, [])]
    return rows


@pytest.mark.parametrize(("scale", "length"), [(0.2, 24), (3e4, 24), (1e9, 16), (1e30, 16), (0.5, 20), (1.0, 5)])
def test_codes(spark, scale, length):
    rows = vectors(scale, length)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({c: F.lit(1) for c in ("vector", "code", "part")})
    got = Counter(tuple(r) for r in vector_codes.compressed(frame.repartition(5)).collect())
    assert got == codes_by_definition(rows, length)


def test_codes_of_few_and_no_vectors(spark):
    rows = vectors(1.0, 8, 10)[:3]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert Counter(tuple(r) for r in vector_codes.compressed(frame).collect()) == codes_by_definition(rows, 8)
    assert vector_codes.compressed(frame.filter("false")).collect() == []
    assert vector_codes.compressed(frame.withColumn("embedding", F.lit(None).cast("array<float>"))).collect() == []


def test_limb_products_are_exact():
    rng = np.random.default_rng(3)
    for bits, length in ((20, 8), (40, 64), (70, 512), (120, 3)):
        entries = [[int(x) * (1 << bits - 20) + int(y) for x, y in zip(rng.integers(-(1 << 19), 1 << 19, length), rng.integers(0, 1 << 19, length))] for _ in range(16)]
        values = np.array([[float(int(x) * (1 << max(0, bits - 40))) for x in rng.integers(-(1 << min(bits, 40) - 1), 1 << min(bits, 40) - 1, length)] for _ in range(50)])
        largest = max(max(abs(x) for row in entries for x in row), int(np.abs(values).max())) + 1
        code, distance = vector_codes.Codebook(entries, largest).nearest(values)
        for row, k, d in zip(values, code, distance):
            exact = [sum((int(x) - c) ** 2 for x, c in zip(row, entry)) for entry in entries]
            assert (k, d) == (exact.index(min(exact)), min(exact))


# --- 13: repeated spans


def kept_by_definition(docs: list[tuple], window: int = 20) -> Counter:
    order = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0))
    seen: set[tuple] = set()
    found = {}
    for doc in order:
        w = (doc[1] or "").encode("utf-8", "surrogatepass").split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        found[doc] = (doc[0], len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return Counter(found[d] for d in docs)


def repeated_texts() -> list[tuple]:
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choice(words, n)) for n in (19, 20, 21, 60, 300)]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choice(words, rng.integers(0, 40))) if rng.random() < 0.6 else str(rng.choice(passages)) for _ in range(rng.integers(0, 6))]
        docs.append((i, "  \n".join(parts)))
    near = passages[4].split()
    docs += [(200 + i, " ".join([*near[: 37 * i], "changed", *near[37 * i + 1 :]])) for i in range(8)]
    docs += [(300, "a " * 500), (301, "a b " * 200), (302, "b " * 19), (303, "b " * 20), (304, "b " * 21)]
    docs += [(400, None), (401, ""), (402, " \t\n"), (403, "A b \x85 c " * 12), (404, "日本 " * 45), (None, passages[3])]
    docs += [docs[5]] * 3 + [(-4, passages[4]), (500, passages[4].replace(" ", "\x0b"))]
    docs += [(600, " ".join(rng.choice(words, 30_000)) + " " + passages[4])]
    return docs


@pytest.mark.parametrize("window", [20, 3])
def test_repeats(spark, window):
    rows = repeated_texts()
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("at", "anchor", "piece", "tie", "n", "spans")})
    got = debruijn.without_repeats(frame.repartition(9), window).select("doc_id", "n_words", "n_removed", "kept_text")
    assert Counter(tuple(r) for r in got.collect()) == kept_by_definition(rows, window)


def test_repeats_in_small_slices(spark, monkeypatch):
    rows = repeated_texts()[:140]
    monkeypatch.setattr(debruijn, "SLICE", 500)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = debruijn.without_repeats(frame).select("doc_id", "n_words", "n_removed", "kept_text")
    assert Counter(tuple(r) for r in got.collect()) == kept_by_definition(rows)


def test_repeats_of_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert debruijn.without_repeats(empty).collect() == []
    one = spark.createDataFrame([(1, "few words")], "doc_id long, text string")
    assert [tuple(r) for r in debruijn.without_repeats(one).collect()] == [(1, "few words", 2, 0)]


def test_paths_are_compact(spark):
    """A passage of 300 words that ten documents share is one path, verified at its source."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 1000, 300))
    rows = [(i, f"{' '.join(f'd{i}x{j}' for j in range(50))} {passage} {' '.join(f'e{i}x{j}' for j in range(50))}") for i in range(10)]
    spans = debruijn.repeats(debruijn.texts_of(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    long = [s for s in spans if s.digest0 is not None]
    assert Counter(s.doc_id for s in long) == Counter(range(1, 10)) and {(s.source_id, s.source_at > 40) for s in long} == {(0, True)}
    assert min(s.windows for s in long) > 250
