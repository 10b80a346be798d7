"""Work kept out of Python, or done there in bulk, with the same results."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from almoner.llm import mixing, toxicity
from almoner.llm.common import WORD


def in_python(df) -> list[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "MapInArrow" in line]


def test_pieces_are_cut_without_python(spark):
    def cut(text, first, n):
        starts = [m.start() for m in re.finditer(WORD, text)]
        return text[starts[first] if first else 0 : starts[first + n] if first + n < len(starts) else len(text)]

    texts = ["one", " \t one\ntwo\r\n three  ", "ä ö x y 漢 😀\0z", "\x0b\x0ca\x1fb c\n\n", "w\n " * 300_000]
    rows = []
    for text in texts:
        size = len(re.findall(WORD, text))
        ends = [(0, 1), (0, size), (1, 1), (size - 1, 1), (1, size - 1), (0, size - 1), (size // 2, 4)]
        rows += [(text, f, n, size) for f, n in sorted(set(ends)) if f >= 0 and n > 0 and f + n <= size]
    frame = spark.createDataFrame(rows, "text string, first long, n long, size long")
    got = frame.select("*", mixing.piece(*map(F.col, ("text", "first", "n", "size"))).alias("piece")).collect()
    assert [r.piece for r in got] == [cut(*r[:3]) for r in got] and len(got) > 20
    docs = spark.createDataFrame([(i, f"a b {i} " * 999, "s", -1) for i in range(9)], "doc_id long, text string, source string, n_chars int")
    mixed = mixing.mixed_documents(docs)
    assert not any("text" in line or "n_chars" in line for line in in_python(mixed))
    assert mixed.dtypes == docs.dtypes and all(r.n_chars == len(r.text) for r in mixed.collect())


def test_scored_texts_go_to_python_once(spark):
    docs = spark.createDataFrame([(1, "fine words"), (2, None), (3, "")], "doc_id long, text string")
    found = toxicity.scored(docs, toxicity.Model.fresh(np.random.default_rng(1)))
    assert in_python(found) and not any("text_" in line for line in in_python(found))
    got = {r.doc_id: r for r in found.collect()}
    assert got[2].text is None and got[2].score == got[3].score != got[1].score
    binary = toxicity.scored(docs.withColumn("text", F.col("text").cast("binary")), toxicity.Model.fresh(np.random.default_rng(1)))
    assert {r.doc_id: r.score for r in binary.collect()} == {d: r.score for d, r in got.items()}


def test_words_are_hashed_together():
    def parts(word):
        bare = word.strip(toxicity.MARKS).lower()
        names = [f"={bare}", *(f"{n}{bare[:n]}" if len(bare) >= n else f"={bare}" for n in (3, 4, 5, 6))]
        return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % toxicity.BUCKETS for p in names]

    rng, signs = random.Random(7), "abcXYZ09.'-\0éßİ漢😀\ud800"
    found = ["", "(a)", "Words,", "x" * 24, "x" * 25, *("".join(rng.choices(signs[: rng.choice([3, 9, 18])], k=rng.randrange(40))) for _ in range(3_000))]
    words = toxicity.Words()
    assert words.numbers(" ".join(["b", "a", "b"])).tolist() == [0, 1, 0]
    for word in found:
        words[word]
    assert words.buckets().tolist() == [parts(w) for w in words] and words.buckets(len(words)).shape == (0, toxicity.PARTS)
    assert (words.buckets(5) == words.buckets()[5:]).all()
