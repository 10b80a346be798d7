"""Toxicity: a convolutional text classifier on hashed word embeddings.

A word is the sum of hashed embeddings of itself and of its beginnings, so that
inflected forms of one stem share weights. Filters of several widths slide over
the words; each filter's largest value in the text goes into a logistic layer.
Width ``w`` at a place is a sum of ``w`` tables' rows, so a text costs a few
look-ups a word, and texts are scored whole. Trained in numpy with Adam on every
labelled row. Rows are dealt by a hash to shards of bounded size, packed once as word
numbers. In each round every shard learns for an epoch from the common model; then a row
of weights moves by the mean of its moves in the shards that used it (sums of whole
numbers, so that their order doesn't matter). A single shard learns all epochs in one
round. Calibrated on every fifth row of each kind and shard, which none learnt from.

Only the text goes into a score. Thresholds are calibrated by language on those rows,
counted by logits of ``LOGIT`` steps a unit: per language the one with the best F1, drawn
towards the overall one where few labels are known; they give ``flagged``, beside the
fixed threshold's ``predicted``.

Missing and empty texts get the score of a text without words; labels other than
0 and 1 and labelled rows without document don't count; repeated labels count
repeatedly. With fewer than 4 labels of either kind nothing is learnt
and every score is the share of toxic ones (0.5 for no labels). Repeated rows are scored alike, an empty table gives an empty result,
other columns are ignored or, in ``without_toxic``, kept.
"""

from __future__ import annotations

import copy
import itertools
from collections.abc import Iterable
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.llm.chunks import give_back, held, slices
from almoner.llm.common import fresh, ship, text_of
from almoner.session import drop_tables, recording, written

#: Rows and characters of a shard, on average; words worked on at once.
SHARD_ROWS, SHARD_CHARS, BLOCK = 6_000, 24_000_000, 1 << 20
#: Moves are summed as whole multiples of ``1 / MOVE``, logits counted in steps of ``1 / LOGIT``.
MOVE, LOGIT = 1 << 40, 1 << 12
#: Up to this many labels go to every executor.
BROADCAST_ROWS = 5_000_000
#: Bounds of ``sample``, which nothing is learnt from.
SAMPLE_ROWS, SAMPLE_WORDS, SAMPLE_CHARS = 6_000, 4_000_000, 50_000_000
LONG = 40_000
THRESHOLD = 0.7
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 8
PARTS = 5  # the word and its beginnings of 3 to 6 letters
EPOCHS, BATCH, RATE, WORDS = 6, 48, 0.02, 100_000
START, DROPOUT = 0.1, 0.25
#: What the names of parts begin with, hashed: the word, and its beginnings by length.
WHOLE, BEGINNINGS = crc32(b"="), {n: crc32(b"%d" % n) for n in (3, 4, 5, 6)}
#: Words whose parts are hashed together, and their most letters; longer ones go one by one.
HASHED, SHORT = 1 << 16, 24
MARKS = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum())


# a checksum byte by byte, and how that of ``length`` bytes changes when others stand before them
_STEP = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], np.uint32)


def _after(begun: int, length: int) -> int:
    return crc32(bytes(length), begun) ^ crc32(bytes(length))


_AFTER = {n: np.uint32(_after(begun, n)) for n, begun in BEGINNINGS.items()}
_AFTER_WHOLE = np.array([_after(WHOLE, n) for n in range(SHORT + 1)], np.uint32)


def hashed(words: list[str]) -> np.ndarray:
    """Per word the buckets of its parts."""
    bare = [w.strip(MARKS).lower() for w in words]
    raw = [b.encode("utf-8", "surrogatepass") for b in bare]
    letters, size = (np.fromiter(map(len, x), np.int64, len(words)) for x in (bare, raw))
    out = np.empty((len(words), PARTS), np.int32)
    for i in np.flatnonzero((letters < size) | (size > SHORT)):
        whole = crc32(raw[i], WHOLE)
        out[i] = [x % BUCKETS for x in (whole, *(crc32(bare[i][:n].encode("utf-8", "surrogatepass"), begun) if letters[i] >= n else whole for n, begun in BEGINNINGS.items()))]
    # of the others a letter is a byte; by length, so that those with a letter more stand at the end
    short = np.flatnonzero((letters == size) & (size <= SHORT))
    short = short[np.argsort(size[short], kind="stable")]
    size = size[short]
    signs = np.array([raw[i] for i in short], f"S{SHORT}").view(np.uint8).reshape(-1, SHORT).T.copy()
    state, begun = np.full(len(short), 0xFFFFFFFF, np.uint32), {}
    for at in range(int(size.max(initial=0))):
        rest = slice(int(np.searchsorted(size, at, "right")), None)
        old = state[rest]
        state[rest] = _STEP[(old ^ signs[at, rest]) & 255] ^ (old >> 8)
        if at + 1 in BEGINNINGS:
            begun[at + 1] = ~state[rest] ^ _AFTER[at + 1]
    parts = np.repeat((~state ^ _AFTER_WHOLE[size])[:, None], PARTS, 1)
    for i, n in enumerate(BEGINNINGS, 1):
        if n in begun:
            parts[len(parts) - len(begun[n]) :, i] = begun[n]
    out[short] = parts % BUCKETS
    return out


class Words(dict):
    """Numbers of words, in the order of their numbers."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number

    def buckets(self, first: int = 0) -> np.ndarray:
        """Per word from number ``first`` on the buckets of its parts."""
        words, out = itertools.islice(self, first, None), [np.empty((0, PARTS), np.int32)]
        while some := list(itertools.islice(words, HASHED)):
            out.append(hashed(some))
        return np.concatenate(out)

    def numbers(self, text: str) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, DIM, FILTERS)
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    share: float | None = None  # the answer when there was nothing to learn
    thresholds: dict[str | None, float] = field(default_factory=dict)
    threshold: float = THRESHOLD

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Model:
        n = len(WIDTHS) * FILTERS
        return cls(
            rng.normal(0, START, (BUCKETS, DIM)).astype(np.float32),
            {w: rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS},
            np.zeros(n, np.float32),
            rng.normal(0, 0.5, n).astype(np.float32),
            -1.0,
        )

    # -- as rows of weights

    def rows(self) -> np.ndarray:
        """The weights as rows of ``DIM``: those of the buckets, then all others."""
        others = np.concatenate([*(self.filters[w].ravel() for w in WIDTHS), self.bias, self.weight, [self.offset]])
        others = np.pad(others, (0, -len(others) % DIM)).reshape(-1, DIM)
        return np.concatenate([self.embedding.astype(np.float64), others.astype(np.float64)])

    def set_rows(self, rows: np.ndarray) -> None:
        self.embedding = rows[:BUCKETS].astype(np.float32)
        flat, at = rows[BUCKETS:].ravel(), 0
        for w in WIDTHS:
            n = w * DIM * FILTERS
            self.filters[w], at = flat[at : at + n].reshape(w, DIM, FILTERS).astype(np.float32), at + n
        n = len(self.bias)
        self.bias, self.weight = flat[at : at + n].astype(np.float32), flat[at + n : at + 2 * n].astype(np.float32)
        self.offset = float(flat[at + 2 * n])

    # -- scoring

    def tables(self, buckets: np.ndarray) -> list[np.ndarray]:
        """Per width and place in the filter, every word's share of the sum."""
        vectors = self.embedding[buckets].sum(1)
        return [vectors @ self.filters[w][i] for w in WIDTHS for i in range(w)]

    def pooled(self, tables: list[np.ndarray], words: np.ndarray) -> np.ndarray:
        """Each filter's largest value over a text, 0 at least."""
        out, at = [], 0
        for w in WIDTHS:
            n = len(words) - w + 1
            if n > 0:
                total = tables[at].take(words[:n], axis=0)
                for i in range(1, w):
                    total += tables[at + i].take(words[i : i + n], axis=0)
                out.append(total.max(0))
            else:
                out.append(np.full(FILTERS, -np.inf, np.float32))
            at += w
        return np.maximum(np.concatenate(out) + self.bias, 0)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(logits), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))

    # -- training

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, buckets: np.ndarray, rng: np.random.Generator, epochs: int = EPOCHS) -> None:
        state = {}
        step = 0

        def adam(name, value, gradient, rows=None):
            m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
            at = slice(None) if rows is None else rows
            m[at] = 0.9 * m[at] + 0.1 * gradient
            v[at] = 0.99 * v[at] + 0.01 * gradient**2
            value[at] -= RATE * (m[at] / (1 - 0.9**step)) / (np.sqrt(v[at] / (1 - 0.99**step)) + 1e-6)

        every = np.arange(FILTERS)
        rare = max(1.0, min(5.0, (labels == 0).sum() / max(1, (labels == 1).sum()))) ** 0.5
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
                step += 1
                lengths = np.array([len(texts[i]) for i in part])
                flat = np.concatenate([texts[i] for i in part])
                used, flat = np.unique(flat, return_inverse=True)
                vectors = self.embedding[buckets[used]].sum(1)
                ends = np.cumsum(lengths)
                pooled = np.zeros((len(part), len(WIDTHS) * FILTERS), np.float32)
                best = np.full(pooled.shape, -1)
                tables = [vectors @ self.filters[w][i] for w in WIDTHS for i in range(w)]
                # places are worked on in blocks, however long the texts are
                for begin in range(0, len(flat), BLOCK):
                    for k, w in enumerate(WIDTHS):
                        own, cut = tables[w * (w - 1) // 2 :][:w], slice(k * FILTERS, (k + 1) * FILTERS)
                        stop = min(begin + BLOCK, len(flat) - w + 1)
                        if stop <= begin:
                            continue
                        total = np.take(own[0], flat[begin:stop], axis=0)
                        for i in range(1, w):
                            total += np.take(own[i], flat[begin + i : stop + i], axis=0)
                        for d, (end, n) in enumerate(zip(ends, lengths)):
                            low, high = max(end - n, begin), min(end - w + 1, stop)
                            if low < high:
                                values = total[low - begin : high - begin]
                                at = values.argmax(0)
                                value = values[at, every] + self.bias[cut]
                                if low == end - n:
                                    pooled[d, cut], best[d, cut] = value, at + low
                                else:
                                    better = value > pooled[d, cut]
                                    pooled[d, cut] = np.where(better, value, pooled[d, cut])
                                    best[d, cut] = np.where(better, at + low, best[d, cut])
                active = (pooled > 0) & (best >= 0) & (rng.random(pooled.shape) >= DROPOUT)
                hidden = np.where(active, pooled, 0) / (1 - DROPOUT)
                y = labels[part]
                p = 1 / (1 + np.exp(-np.clip(hidden @ self.weight + self.offset, -30, 30)))
                error = ((p - y) * np.where(y == 1, rare, 1) / len(part)).astype(np.float32)
                back = error[:, None] * self.weight * active / (1 - DROPOUT)
                back = back.astype(np.float32)
                words, grads = [], []
                filter_grads = {}
                for k, w in enumerate(WIDTHS):
                    cut = slice(k * FILTERS, (k + 1) * FILTERS)
                    g, b = back[:, cut], best[:, cut]
                    d, f = np.nonzero(g)
                    gradient = np.zeros_like(self.filters[w])
                    for i in range(w):
                        word = flat[b[d, f] + i]
                        for one in range(FILTERS):
                            own = f == one
                            gradient[i, :, one] = g[d[own], one] @ vectors[word[own]]
                        words.append(word)
                        grads.append(g[d, f][:, None] * self.filters[w][i].T[f])
                    filter_grads[w] = gradient
                words, grads = np.concatenate(words), np.concatenate(grads)
                rows, inverse = np.unique(buckets[used[words]], return_inverse=True)
                total = np.zeros((len(rows), DIM), np.float32)
                np.add.at(total, inverse.reshape(len(words), PARTS), grads[:, None, :])
                adam("embedding", self.embedding, total, rows)
                for w in WIDTHS:
                    adam(w, self.filters[w], filter_grads[w] + 1e-4 * self.filters[w])
                adam("bias", self.bias, back.sum(0))
                adam("weight", self.weight, error @ hidden + 1e-4 * self.weight)
                offset = np.array([self.offset])
                adam("offset", offset, np.array([error.sum()]))
                self.offset = float(offset[0])

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, languages: Iterable, counts: np.ndarray) -> None:
        """Platt scaling, then per language the threshold with the best F1; a value of
        ``logits`` stands for as many rows as ``counts`` says."""
        ones, zeros = (counts * labels).sum(), (counts * (1 - labels)).sum()
        t = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            e = counts * (p - t)
            g = np.array([(e * logits).sum() + 1e-3 * (a - 1), e.sum()])
            r = counts * np.maximum(p * (1 - p), 1e-9)
            h = np.array([[(r * logits**2).sum() + 1e-3, (r * logits).sum()], [(r * logits).sum(), r.sum() + 1e-6]])
            change = np.clip(np.linalg.solve(h, g), -1, 1)
            a, b = a - change[0], b - change[1]
        self.slope, self.shift = max(float(a), 1e-3), float(b)
        scores, languages = self.probability(logits), np.array([x or "" for x in languages])
        self.threshold = best_threshold(scores, labels, counts, THRESHOLD)
        for language in sorted(set(languages)):
            own = languages == language
            known = min(int((counts * labels)[own].sum()), int((counts * (1 - labels))[own].sum()))
            trust = known / (known + 5)
            self.thresholds[language] = trust * best_threshold(scores[own], labels[own], counts[own], self.threshold) + (1 - trust) * self.threshold


def best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray, otherwise: float) -> float:
    """The middle of the best cut by F1; ``otherwise`` without both kinds of labels."""
    if labels.min(initial=1) == labels.max(initial=0) or not len(labels):
        return otherwise
    order = np.argsort(scores, kind="stable")
    scores, labels, counts = scores[order], labels[order], counts[order]
    ones = counts * labels
    found = ones.sum() - np.concatenate([[0], np.cumsum(ones)])
    taken = counts.sum() - np.concatenate([[0], np.cumsum(counts)])
    f1 = 2 * found / np.maximum(1, taken + ones.sum())
    borders = np.concatenate([[0.0], (scores[1:] + scores[:-1]) / 2, [1.0]])
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(borders[best[len(best) // 2]])


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept out of training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> list:
    """Labelled rows to look at: the first by a hash, within both bounds. ``trained`` takes all rows."""
    marked = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("d"), F.col(label).cast("int").alias("y"))
    text = text_of(docs)
    language = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    drawn = F.xxhash64(F.lit(17), "d", "y")
    first = marked.withColumn("drawn", drawn).orderBy("drawn", "d", "y").limit(SAMPLE_ROWS)
    rows = docs.select(docs["doc_id"].cast("long").alias("d"), text.alias("text"), language.alias("lang")).join(F.broadcast(first), "d")
    # a text without white space is one word, however long: its characters count, too
    most = F.ceil(F.char_length("text") * F.lit(SAMPLE_WORDS / SAMPLE_CHARS))
    rows = rows.withColumn("n", F.greatest(F.size(F.split("text", r"\s+")).cast("long"), most))
    # repeated documents could pass the bound on labels: bound the rows again
    rows = rows.orderBy("drawn", "d", "text").limit(SAMPLE_ROWS)
    # two passes over at most SAMPLE_ROWS rows: lengths alone decide which texts come
    rows = rows.withColumn("at", F.row_number().over(Window.orderBy("drawn", "d", "text", "lang")))
    chosen = fitting([(r["at"], r["n"]) for r in rows.select("at", "n").collect()], SAMPLE_WORDS, LONG)
    return rows.filter(F.col("at").isin(chosen)).orderBy("at").select("text", "y", "lang").collect()


def fitting(lengths: list[tuple[int, int]], most: int, long: int) -> list[int]:
    """Which of the rows ``(place, words)`` have ``most`` words together at most: in
    the order of places, those over ``long`` last, passing over what doesn't fit."""
    left, chosen = most, []
    for at, n in sorted(lengths, key=lambda r: (r[1] > long, r[0])):
        if n <= left:
            left -= n
            chosen.append(at)
    return chosen


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """Every labelled row that isn't held out, as often as label and document occur."""
    marked = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("d"), F.col(label).cast("int").alias("y"))
    language = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = text_of(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("d"), text.alias("text"), language.alias("lang"), F.char_length(text).cast("long").alias("chars"))
    # ids and labels alone, so that the texts needn't move; of more of them, both sides do
    few = marked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(marked) if few else marked, "d").withColumn("drawn", F.xxhash64(F.lit(17), "d", "y"))


def shards(rows: DataFrame, n: int) -> DataFrame:
    """A stored row per shard: words as numbers in the order of a hash, text by text, the
    buckets of the words, and the rows' labels and languages."""
    ship(rows.sparkSession)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(19), "d", "y", "text"), F.lit(n)).cast("int")).repartitionById(n, "shard")

    def run(batches):
        words, shard, texts, lengths, y, lang = Words(), None, [], [], [], []
        for batch in batches:
            for part in slices(batch.column(1)):
                cut = batch.slice(part.start, part.stop - part.start)
                numbers = [words.numbers(t) for t in cut.column(1).to_pylist()]
                shard, texts = cut.column(0)[0].as_py(), [*texts, np.concatenate(numbers)]
                lengths += map(len, numbers)
                y += cut.column(2).to_pylist()
                lang += cut.column(3).to_pylist()
        if shard is not None:
            packed = [np.concatenate(texts), np.array(lengths, np.int64), np.array(y, np.int8), words.buckets()]
            columns = [pa.array([a.tobytes()], pa.binary()) for a in packed]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *columns, pa.array([lang], pa.list_(pa.string()))], names=names)
        del words, texts
        give_back()

    schema = "shard int, words binary, lengths binary, y binary, buckets binary, lang array<string>"
    names = [f.split()[0] for f in schema.split(", ")]
    return written(dealt.sortWithinPartitions("drawn", "d", "text", "lang").select("shard", "text", "y", "lang").mapInArrow(run, schema), "toxicity-shards")


def opened(batches: Iterable[pa.RecordBatch]) -> Iterable[tuple[int, list[np.ndarray], np.ndarray, np.ndarray, list, np.ndarray]]:
    """Per shard: number, texts, labels, buckets, languages and which rows are for calibration."""
    for batch in batches:
        for i in range(batch.num_rows):
            shard, words, lengths, y, buckets, lang = (c[i] for c in batch.columns)
            words, lengths, y, buckets = (np.frombuffer(b.as_buffer(), t) for b, t in ((words, np.int32), (lengths, np.int64), (y, np.int8), (buckets, np.int32)))
            # every fifth row of each kind is for calibration
            aside = np.argsort(y, kind="stable")[::5]
            yield shard.as_py(), np.split(words, np.cumsum(lengths)[:-1]), y.astype(np.float32), buckets.reshape(-1, PARTS), lang.as_py(), aside


def moves(packed: DataFrame, model: Model, rng: np.random.Generator, seed: int, turn: int, epochs: int) -> pa.Table:
    """The sum of the moves of each row of weights in all shards, and in how many it moved."""
    spark = packed.sparkSession
    shared = spark.sparkContext.broadcast((model, rng))
    values = [f"v{i}" for i in range(DIM)]

    def run(batches):
        model, rng = shared.value
        base = model.rows()
        total, n = np.zeros(base.shape, np.int64), np.zeros(len(base), np.int64)
        for shard, texts, y, buckets, _, aside in opened(batches):
            kept = np.array([i for i in np.setdiff1d(np.arange(len(y)), aside) if len(texts[i])], np.int64)
            if not len(kept):
                continue
            own = copy.deepcopy(model)
            own.learn([texts[i] for i in kept], y[kept], buckets, copy.deepcopy(rng) if turn == shard == 0 else np.random.default_rng((seed, turn, shard)), epochs)
            moved = np.rint((own.rows() - base) * MOVE).astype(np.int64)
            total += moved
            n += moved.any(1)
            del own, moved
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), *(pa.array(total[some, i]) for i in range(DIM))], names=["row", "n", *values])
        del base, total, n, some
        give_back()

    found = packed.mapInArrow(run, ", ".join(f"{c} long" for c in ("row", "n", *values)))
    out = found.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n", *values))).toArrow()
    shared.destroy()
    return out


def aside_logits(packed: DataFrame, model: Model) -> pa.Table:
    """How many rows kept for calibration have a language, a label and a logit."""
    shared = packed.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for _, texts, y, buckets, lang, aside in opened(batches):
            own = shared.value
            tables = own.tables(buckets)
            logits = np.array([own.pooled(tables, texts[i]) @ own.weight + own.offset for i in aside], np.float64)
            steps = np.rint(np.clip(logits, -1000, 1000) * LOGIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang[i] for i in aside], pa.string()), pa.array(y[aside].astype(np.int32)), pa.array(steps)], names=["lang", "y", "step"])
        give_back()

    found = packed.mapInArrow(run, "lang string, y int, step long").groupBy("lang", "y", "step").agg(F.count(F.lit(1)).alias("n"))
    out = found.orderBy("step", "y", "lang").toArrow()
    shared.destroy()
    return out


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", seed: int = 5) -> Model:
    """The model learnt from all labelled rows that aren't held out."""
    rng = np.random.default_rng(seed)
    model, rows = Model.fresh(rng), training_rows(docs, labels, label)
    size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum("chars"), F.lit(0))).first()
    n, ones, chars = map(int, size)
    if min(ones, n - ones) < 4:
        model.share = ones / n if n else 0.5
        return model
    n = max(1, -(-n // SHARD_ROWS), -(-chars // SHARD_CHARS))
    with recording() as tables:
        packed = shards(rows, n)
    turns = 1 if n == 1 else EPOCHS
    for turn in range(turns):
        found = moves(packed, model, rng, seed, turn, EPOCHS // turns)
        weights, at = model.rows(), found["row"].to_numpy()
        weights[at] += np.stack([found[f"v{i}"].to_numpy() for i in range(DIM)], 1) / MOVE / found["n"].to_numpy()[:, None]
        model.set_rows(weights)
    found = aside_logits(packed, model)
    y, counts = found["y"].to_numpy().astype(np.float64), found["n"].to_numpy().astype(np.float64)
    model.calibrate(found["step"].to_numpy() / LOGIT, y, found["lang"].to_pylist(), counts)
    del found
    drop_tables(docs.sparkSession, tables)
    give_back()  # the driver may train again
    return model


class Scorer:
    """Scores texts, keeping the look-up tables of the words seen."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.words, self.known = Words(), 0
        self.tables = [np.empty((0, FILTERS), np.float32) for _ in range(sum(WIDTHS))]

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.words) > WORDS:
            self.reset()
        numbers = [self.words.numbers(t) for t in texts]
        if len(self.words) > self.known:
            if len(self.words) > len(self.tables[0]):
                size = 2 * len(self.words)
                self.tables = [np.concatenate([t, np.empty((size - len(t), FILTERS), np.float32)]) for t in self.tables]
            new = self.model.tables(self.words.buckets(self.known))
            for table, rows in zip(self.tables, new):
                table[self.known : self.known + len(rows)] = rows
            self.known = len(self.words)
        logits = [float(self.model.pooled(self.tables, n) @ self.model.weight) + self.model.offset for n in numbers]
        return self.model.probability(np.array(logits, np.float64))


def scored(docs: DataFrame, model: Model, score: str = "score", threshold: float = THRESHOLD, flagged: str = "flagged") -> DataFrame:
    """``docs`` with a score and whether it passes the threshold of its language."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # 8 MB, whatever the data
    language = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    names = {c: fresh(docs, c) for c in ("text_", "lang_")}
    rows = docs.withColumn(names["lang_"], language)
    # a text goes to the workers once
    if isinstance(docs.schema["text"].dataType, T.StringType):
        names["text_"] = "text"
    else:
        rows = rows.withColumn(names["text_"], text_of(docs))
    schema = T.StructType([*docs.schema, T.StructField(score, T.DoubleType()), T.StructField(flagged, T.BooleanType())])

    def run(batches):
        held("toxicity", dict)  # gives up what tasks of another stage have left
        scorer = Scorer(shared.value)
        known, overall = shared.value.thresholds, shared.value.threshold
        for batch in batches:
            for part in slices(batch.column(names["text_"]).fill_null("")):
                cut = batch.slice(part.start, part.stop - part.start)
                scores = scorer.scores(cut.column(names["text_"]).fill_null("").to_pylist())
                limits = np.array([known.get(x or "", overall) for x in cut.column(names["lang_"]).to_pylist()])
                columns = cut.columns[: len(schema) - 2]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores), pa.array(scores >= limits)], names=schema.names)
        del scorer
        give_back()

    return rows.mapInArrow(run, schema)


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its score, whether its label was held out, and both decisions."""
    model = trained(docs, labels)
    columns = [docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")]
    if "lang" in docs.columns:
        columns.append(docs["lang"])
    found = scored(docs.select(*columns), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "flagged")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted to be toxic."""
    score, flagged = fresh(docs, "score"), fresh(docs, "flagged")
    return scored(docs, trained(docs, labels), score, flagged=flagged).filter(F.col(score) < THRESHOLD).drop(score, flagged)
