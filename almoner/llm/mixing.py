"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Documents of a source are laid on a line in an order drawn from the seed; the
   line is cut into blocks of ``block`` words. Long lines need no single task:
   places come from sums over buckets of the order and sums within a bucket.
2. A source's target is its share of the mix by weight, at most ``most`` times its
   words, the excess shared anew by weight. The target is reached to the word:
   blocks are taken in a permuted order, all of them once and then, in another
   order, again; the last one taken is cut. That gives each source an exact quota
   of blocks.
3. The tree deals the quotas to output shards of equal size: at each node, the left
   half's share of every source is one draw from the multivariate hypergeometric
   distribution. A node's draw depends on the seed and its place alone, so each
   task walks from the root to the shards it is given.
4. Taken blocks fill their source's share of the shards in permuted order, which
   makes the shards disjoint; within a shard pieces are shuffled by a hash.

A size is the number of words; missing and empty texts have none, are never
taken, and count as zero. A missing source is a source of its own, the last.
Repeated rows and ids are rows of their own (equal rows lie next to each other
on the line); reruns take the same words. An empty table gives an empty mix.
Other columns are ignored or, in ``mixed_documents``, kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import WORD, fresh, numbered, ship, text_of
from almoner.session import written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK, SHARD, BUCKET = 4096, 4_000_000, 5_000
MOST_BLOCKS = 400_000_000  # numpy draws from fewer than 10^9 at once


# --- sources -----------------------------------------------------------------


def targets(sizes: list[int], weights: tuple[int, ...], share: float, most: float) -> list[float]:
    """Words each source is to give: by weight, capped, the excess shared anew."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, free, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        per_weight = left / sum(weight[i] for i in free)
        full = {i for i in free if per_weight * weight[i] > most * sizes[i]}
        for i in full or free:
            target[i] = float(most * sizes[i]) if full else per_weight * weight[i]
        if not full:
            break
        left -= sum(target[i] for i in full)
        free -= full
    return target


def sources(lines: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[tuple[str | None, int, float]]:
    """Name, words and target of every source, by code point, the missing one last.

    The list has a row per source, not per document.
    """
    # UTF-8 orders as code points do
    found = [(r[0], int(r[1])) for r in lines.groupBy("source").agg(F.sum("size")).collect()]
    found.sort(key=lambda s: (s[0] is None, (s[0] or "").encode("utf-8", "surrogatepass")))
    return [(*s, t) for s, t in zip(found, targets([n for _, n in found], weights, share, most))]


# --- the line ----------------------------------------------------------------


def lines(docs: DataFrame, seed: int, row: str | None = None) -> DataFrame:
    """One narrow stored row per document: source, size, place in the drawn order."""
    text = text_of(docs)
    return written(
        docs.select(
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
            docs["doc_id"].cast("long").alias("doc_id"),
            docs["source"].cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), docs["doc_id"].cast("long"), text).alias("drawn"),
        ),
        "lines",
    )


def placed(line: DataFrame) -> DataFrame:
    """Each document's first word's place on its source's line."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET))
    per_source = line.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.col("source").alias("s"), buckets.cast("long").alias("buckets"))
    # the order's upper bits name the bucket, so buckets follow each other on the line
    upper = F.shiftrightunsigned(F.col("drawn"), 33)
    rows = line.join(per_source, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("bucket", F.shiftright(upper * F.col("buckets"), 31))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(up_to), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "bucket").orderBy("drawn", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("place", F.col("before") + F.col("within"))
        .select("row", "doc_id", "source", "size", "place")
    )


def permuted(values: np.ndarray, n: int, seed: tuple[int, ...]) -> np.ndarray:
    """Where a seeded permutation of ``range(n)`` puts ``values``: four Feistel rounds, walked until in range."""
    if n <= 1:
        return values.copy()
    half = ((n - 1).bit_length() + 1) // 2
    mask = np.uint64((1 << half) - 1)
    keys = np.random.SeedSequence(seed).generate_state(4, np.uint64)
    out, todo = values.astype(np.uint64), np.ones(len(values), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for key in keys:
            mixed = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


class Quota:
    """Which blocks of a source are taken, in which order, and how much of them."""

    def __init__(self, number: int, size: int, target: float, block: int, seed: int):
        self.words, self.block, self.size = round(target), block, size
        self.blocks = -(-size // block)
        self.short = self.blocks * block - size
        self.seeds = [(seed, number, turn) for turn in range(MOST)]
        last = np.array([self.blocks - 1])
        self.last = [int(permuted(last, self.blocks, s)[0]) for s in self.seeds] if size else []
        # every rank below has words; a cut one is the last
        full, rest = divmod(self.words, size) if size else (0, 0)
        self.taken = full * self.blocks + (self.ranks(rest, full) if rest else 0)

    def ranks(self, words: int, turn: int) -> int:
        n = -(-words // self.block)
        return -(-(words + self.short) // self.block) if n > self.last[turn] else n

    def take(self, blocks: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Of blocks on their ``turn``-th copy: rank among those taken, and words taken."""
        rank = permuted(blocks, self.blocks, self.seeds[turn])
        begin = rank * self.block - np.where(rank > self.last[turn], self.short, 0) + turn * self.size
        length = np.where(blocks == self.blocks - 1, self.block - self.short, self.block)
        return rank + turn * self.blocks, np.clip(self.words - begin, 0, length)


# --- the tree ----------------------------------------------------------------


def shard_shares(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every source, the first rank and the number of blocks that ``shard`` gets."""
    low, high, first, left = 0, shards, np.zeros_like(quotas), quotas.copy()
    total = int(quotas.sum())

    def cut(k: int) -> int:
        return total * k // shards

    while high - low > 1:
        middle = (low + high) // 2
        draw = np.random.default_rng((seed, low, high)).multivariate_hypergeometric(left, cut(middle) - cut(low), method="marginals")
        if shard < middle:
            high, left = middle, draw
        else:
            low, first, left = middle, first + draw, left - draw
    return first, left


def shares(spark, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """Rows ``(number, rank, shard)``: where each taken block of each source goes."""

    def run(batches):
        left = np.array(quotas, np.int64)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, n = shard_shares(left, shards, shard, seed)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(first[some], pa.int64()), pa.array(n[some], pa.int64()), pa.array(np.full(len(some), shard), pa.int64())], names=["number", "first", "n", "shard"])

    ranges = spark.range(shards).mapInArrow(run, "number int, first long, n long, shard long")
    return ranges.select("number", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("rank"))


# --- the mix -----------------------------------------------------------------


def pieces(line: DataFrame, table: list[tuple[str | None, int, float]], seed: int, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix, one row per piece of a document in a taken block.

    ``row, doc_id, first_word, n_words, copy, shard, position``: positions order
    the pieces of a shard.
    """
    spark = line.sparkSession
    ship(spark)
    block = max(block, -(-2 * sum(n for _, n, _ in table) // MOST_BLOCKS))
    quotas = [Quota(i, n, t, block, seed) for i, (_, n, t) in enumerate(table)]
    names = {name: i for i, (name, _, _) in enumerate(table)}
    shards = max(1, -(-sum(q.words for q in quotas) // shard))

    def run(batches):
        for batch in batches:
            number = np.array([names[s] for s in batch.column(2).to_pylist()], np.int64)
            row, doc, size, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4))
            first = place // block
            n = (place + size - 1) // block - first + 1
            at = np.repeat(np.arange(len(row)), n)
            blocks = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            begin = np.maximum(place[at], blocks * block)
            end = np.minimum((place + size)[at], (blocks + 1) * block)
            for copy in range(MOST):
                rank, words = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
                for s in np.unique(number):
                    own = number[at] == s
                    rank[own], words[own] = quotas[s].take(blocks[own], copy)
                stop = np.minimum(end, blocks * block + words)
                some = np.flatnonzero(stop > begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row[at[some]]),
                        batch.column(1).take(pa.array(at[some])),
                        pa.array(number[at[some]], pa.int32()),
                        pa.array(rank[some]),
                        pa.array((begin - place[at])[some]),
                        pa.array((stop - begin)[some]),
                        pa.array(np.full(len(some), copy), pa.int32()),
                    ],
                    names=["row", "doc_id", "number", "rank", "first_word", "n_words", "copy"],
                )

    taken = placed(line.filter("size > 0")).mapInArrow(run, "row long, doc_id long, number int, rank long, first_word long, n_words long, copy int")
    drawn = F.xxhash64(F.lit(seed), "shard", "row", "first_word", "copy")
    dealt = taken.join(shares(spark, [q.taken for q in quotas], shards, seed), ["number", "rank"])
    return dealt.select("row", "doc_id", "first_word", "n_words", "copy", "shard", drawn.alias("position"))


def taken_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per document: its size, its source's size and target, the words the mix takes."""
    line = lines(docs, seed)
    table = sources(line)
    mix = pieces(line, table, seed).groupBy("row").agg(F.sum("n_words").alias("taken"))
    known = line.sparkSession.createDataFrame(table, "source string, source_size long, target double")
    known = known.withColumnRenamed("source", "s")
    return (
        line.join(mix, "row", "left")
        .join(known, F.col("source").eqNullSafe(F.col("s")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def piece(text: Column, first: Column, n: Column, size: Column) -> Column:
    """Words ``first`` to ``first + n`` of ``text``, which has ``size``, up to the next word.

    The pattern counts words possessively, so it takes no memory per word.
    """
    gap = WORD.replace("[^", "[")

    def words(count: Column) -> Column:
        return F.concat(F.lit(f"(?:{gap})?+(?:{WORD}+{gap}+){{"), count.cast("string"), F.lit("}+"))

    before = F.when(first > 0, words(first)).otherwise("")
    own = F.when(first + n < size, words(n)).otherwise("(?s:.*+)")
    pattern = F.concat(F.lit("^"), before, F.lit("("), own, F.lit(")"))
    return F.when(n == size, text).otherwise(F.call_function("regexp_extract", text, pattern, F.lit(1)))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as documents: a row per piece, with the piece as its text.

    A document lies whole in one piece unless a block's border cuts it; a piece
    runs from its first word to its last, with what stands before the first and
    after the last if it has these. ``n_chars`` counts the piece. The rows stand
    shard by shard in the mix's order.
    """
    row = fresh(docs, "row")
    stored = written(numbered(docs, row), "mixing")
    line = lines(stored, seed, row)
    mix = pieces(line, sources(line), seed).join(line.select("row", "size"), "row")
    extra = {c: fresh(docs, c) for c in ("first_word", "n_words", "size", "shard", "position")}
    mix = mix.select(F.col("row").alias(row), *[F.col(c).cast("long").alias(name) for c, name in extra.items()])
    joined = stored.join(mix, row)
    text = piece(text_of(joined), *(F.col(extra[c]) for c in ("first_word", "n_words", "size")))
    out = joined.withColumn("text", text.cast(stored.schema["text"].dataType))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(F.col("text").cast("string")).cast(stored.schema["n_chars"].dataType))
    order = [extra["shard"], extra["position"]]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select(docs.columns)
