"""N-gram Jaccard self-join by signature trees.

1. A text becomes the set of its shingles' hashes; texts with the same set are one
   vertex from here on, however many copies there are.
2. The upper level of the tree is spread over the cluster by tokens. In one order
   of all tokens, two sets of the wanted overlap share one of their first
   ``n - ceil(t n) + 1`` tokens; node pairs that share none can't have it and
   never meet. Common tokens come last in the order, so that passages many
   documents share bring few of them together. A sample of documents says which
   tokens are common; it only decides the order, and every order gives the same
   links.
3. The sets that share a token go to the cell of that token's first set; cells of
   more than ``CELL`` sets are split into pairs of blocks.
4. In a cell, sets sorted by size become a tree whose nodes hold the OR of their
   bitmaps, the range of sizes, and the largest number of shingles that share a
   bit with another one. The dual traversal drops a pair of nodes if the sizes or
   the largest overlap these allow rule out a link. A first traversal has the
   bitmaps alone and tells which sets have a possible partner; only their texts
   travel. In the second, what is left is compared shingle by shingle, but for
   nodes whose sets are all connected already.
5. Components of the verified links.

The component path skips what is connected already, so it doesn't give every link.
``linked_pairs`` and ``link_counts`` do: the same cells, without that shortcut, each
pair of different sets credited to one cell. A group of ``g`` different near copies
has up to ``g^2 / 2`` pairs, and all are compared.

A text without words has no shingles and links with nothing; missing texts count
as empty. A component's id is its smallest ``doc_id`` (missing ids don't count).
Repeated rows and ids are rows of their own; an empty table gives an empty
result; other columns are ignored or, in ``one_of_each``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import fresh, ship, text_of
from almoner.llm.components import components
from almoner.llm.shingles import forgetting, shingle_hashes
from almoner.session import written

K = 5
#: Jaccard similarity of linked sets, as a fraction of whole numbers.
PART, WHOLE = 3, 4
CELL, LEAF, FAN = 2048, 16, 8
SAMPLE, COMMON, MOST_COMMON = 10_000, 10, 200_000


# --- sets and tokens ---------------------------------------------------------


def sampled_tokens(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in ``COMMON`` or more of about ``SAMPLE`` documents, and in how many.

    At most ``MOST_COMMON`` of them: 3 MB.
    """

    @forgetting
    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text, k).view(np.int64))], names=["token"])

    every = max(1, docs.count() // SAMPLE)
    text = text_of(docs)
    rows = docs.filter(F.pmod(F.xxhash64(text, F.col("doc_id")), F.lit(every)) == 0).select(text.alias("text"))
    common = (
        rows.mapInArrow(run, "token long")
        .groupBy("token")
        .count()
        .filter(F.col("count") >= COMMON)
        .orderBy(F.desc("count"), "token")
        .limit(MOST_COMMON)
        .toPandas()
    )
    tokens = common["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], common["count"].to_numpy(np.int64)[order]


def prefix(tokens: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``n - ceil(t n) + 1`` of sorted ``tokens``: rare ones by hash, common ones by count."""
    length = len(tokens) - -(-PART * len(tokens) // WHOLE) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        known = common[at] == tokens
        if known.any():
            count = np.where(known, counts[at], 0)
            tokens = tokens[np.argsort(count, kind="stable")]
    return tokens[:length]


def sets(docs: DataFrame, row: str | None, k: int) -> DataFrame:
    """Per document, stored: the digest and size of its set and its first tokens."""
    ship(docs.sparkSession)
    common, counts = sampled_tokens(docs, k)

    @forgetting
    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                rows = batch.slice(part, 1000)
                keys, sizes, firsts, maps = [], [], [], []
                for text in rows.column(3).to_pylist():
                    tokens = shingle_hashes(text, k)
                    keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                    sizes.append(len(tokens))
                    maps.append(bitmap(tokens, width(len(tokens))).tobytes())
                    # 48 bits tell tokens apart well enough to meet: links are verified
                    firsts.append((prefix(tokens, common, counts) >> np.uint64(16)).view(np.int64) if len(tokens) else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(i) for i in range(3)),
                        pa.array(keys, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(firsts, pa.list_(pa.int64())),
                        pa.array(maps, pa.binary()),
                    ],
                    names=["row", "doc_id", "text_hash", "key", "n_shingles", "first", "bitmap"],
                )

    text = text_of(docs)
    number = F.col(row) if row else F.monotonically_increasing_id()
    return written(
        docs.select(number.alias("row"), docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
            run, "row long, doc_id long, text_hash long, key binary, n_shingles long, first array<long>, bitmap binary"
        ),
        "sets",
    )


def vertices(rows: DataFrame) -> DataFrame:
    """One stored row per set that isn't empty: a number, its first document, its tokens."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "text_hash"))
    return written(
        rows.filter("n_shingles > 0").groupBy("key").agg(least.alias("least"), F.first("first").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap")).withColumn("vertex", F.monotonically_increasing_id()),
        "vertices",
    )


# --- cells -------------------------------------------------------------------


def cells(found: DataFrame, size: int) -> DataFrame:
    """Which sets meet: rows ``(leader, i, j, vertex, block)``, one cell for each (leader, i, j)."""
    tokens = found.select("vertex", F.explode("first").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("vertex").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(tokens.join(shared.drop("n"), "token").select("leader", "vertex").distinct(), "cells")
    blocks = F.ceil(F.col("n") / size).cast("int")
    large = members.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    block = F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int")
    return (
        members.join(large.select("leader", blocks.alias("blocks"), "n").filter("n > 1"), "leader")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("leader", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "vertex", "block")
    )


class Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def width(size: int) -> int:
    """Bits of the map of a set, a power of two."""
    return 1 << max(6, min(15, (2 * size - 1).bit_length()))


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits // 64, np.uint64)
    at = tokens >> np.uint64(20) & np.uint64(bits - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


class SignatureTree:
    """Sets in order of size under nodes with OR-ed bitmaps and size ranges."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray):
        # shingles of a set that may hide behind another one's bit
        hidden = sizes - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, hidden)]
        for fan in [LEAF, *[FAN] * 20]:
            maps, least, most, hidden = self.levels[-1]
            if len(maps) == 1:
                break
            at = np.arange(0, len(maps), fan)
            self.levels.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at), np.maximum.reduceat(hidden, at)))

    def possible(self, level: int, a: slice, b: slice) -> np.ndarray:
        """Which pairs of nodes may hold a link."""
        maps, least, most, hidden = self.levels[level]
        shared = np.bitwise_count(maps[a][:, None] & maps[b][None]).sum(2).astype(np.int64)
        overlap = shared + np.minimum(hidden[a][:, None], hidden[b][None])
        # overlap >= t * union, and sizes within t of each other
        fits = overlap * (PART + WHOLE) >= PART * (least[a][:, None] + least[b][None])
        fits &= most[a][:, None] * WHOLE >= PART * least[b][None]
        return fits & (most[b][None] * WHOLE >= PART * least[a][:, None])

    def span(self, level: int, node: int) -> slice:
        fan = LEAF if level == 1 else FAN
        return slice(node * fan, min((node + 1) * fan, len(self.levels[level - 1][0])))

    def traverse(self, settled) -> Iterator[tuple[int, int]]:
        """Pairs of sets that may be linked, but for leaves where ``settled(rows, columns)``."""
        todo = [(len(self.levels) - 1, 0, 0)]
        while todo:
            level, a, b = todo.pop()
            if level == 0:
                yield a, b
                continue
            rows, columns = self.span(level, a), self.span(level, b)
            if level == 1 and settled(rows, columns):
                continue
            fits = np.argwhere(self.possible(level - 1, rows, columns))
            pairs = [(level - 1, rows.start + int(x), columns.start + int(y)) for x, y in fits]
            # far pairs first on the stack: near ones, likely alike, are done before
            todo += sorted((p for p in pairs if p[1] <= p[2] and (level > 1 or p[1] < p[2])), key=lambda p: p[1] - p[2])


def with_partner(maps: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Which sets, sorted by size, have another one that their bitmaps allow a link with."""
    found = np.zeros(len(sizes), bool)
    lengths = np.array([len(m) for m in maps])
    for length in np.unique(lengths):
        # sets of linked sizes have maps of this length or twice that
        own = np.flatnonzero((lengths == length) | (lengths == 2 * length))
        if len(own) < 2:
            continue
        rows = np.zeros((len(own), length // 8), np.uint64)
        for row, x in zip(rows, own):
            words = np.frombuffer(maps[x], np.uint64)
            row[:] = words if len(words) == len(row) else words[: len(row)] | words[len(row) :]
        narrow = lengths[own] == length
        tree = SignatureTree(rows, sizes[own])
        marked = found[own]

        def settled(a: slice, b: slice, narrow=narrow, marked=marked) -> bool:
            return bool((marked[a].all() and marked[b].all()) or not (narrow[a].any() or narrow[b].any()))

        for a, b in tree.traverse(settled):
            if narrow[a] or narrow[b]:
                marked[a] = marked[b] = True
        found[own] = marked
    return found


def shared(x: np.ndarray, y: np.ndarray) -> int | None:
    """How many shingles two sets share, if they are linked."""
    both = len(x) + len(y) - len(np.union1d(x, y))
    return both if both * WHOLE >= PART * (len(x) + len(y) - both) else None


def linked(sets_: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """Of sets sorted by size, every linked pair and how many shingles it shares."""
    sizes = np.array([len(s) for s in sets_])
    bits = width(int(sizes.max()))
    for a, b in SignatureTree(np.array([bitmap(s, bits) for s in sets_]), sizes).traverse(lambda rows, columns: False):
        if (both := shared(sets_[a], sets_[b])) is not None:
            yield a, b, both


def connected(sets_: list[np.ndarray]) -> Union:
    """Of sets sorted by size, which ones links connect."""
    sizes, union = np.array([len(s) for s in sets_]), Union(len(sets_))
    bits = width(int(sizes.max()))
    tree = SignatureTree(np.array([bitmap(s, bits) for s in sets_]), sizes)

    def settled(a: slice, b: slice) -> bool:
        return len({union.find(x) for r in (a, b) for x in range(r.start, r.stop)}) == 1

    for a, b in tree.traverse(settled):
        if union.find(a) != union.find(b) and shared(sets_[a], sets_[b]) is not None:
            union.join(a, b)
    return union


def runs(batches, keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Consecutive rows with the same first ``keys`` columns, over batch borders."""
    key, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != key:
                if key is not None:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if key is not None:
        yield key, held


CELL_KEY = ["leader", "i", "j"]


def promising(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of cells whose bitmap allows a link with another member's."""

    def run(batches):
        keys, vertices_ = [], []

        def flushed():
            return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))), pa.array(vertices_, pa.int64())], names=[*CELL_KEY, "vertex"])

        for key, rows in runs(batches, 3):
            rows = sorted({v: (n, v, m) for v, n, m in rows}.values())
            if len(rows) > 1:
                for x in np.flatnonzero(with_partner([m for _, _, m in rows], np.array([n for n, _, _ in rows]))):
                    keys.append(key)
                    vertices_.append(rows[x][1])
            if len(keys) > 10_000:
                yield flushed()
                keys, vertices_ = [], []
        yield flushed()

    rows = members.join(found.select("vertex", "n_shingles", "bitmap"), "vertex").select(*CELL_KEY, "vertex", "n_shingles", "bitmap")
    return written(rows.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInArrow(run, "leader long, i int, j int, vertex long"), "promising")


def links(members: DataFrame, k: int) -> DataFrame:
    """Within every cell, each connected set's first one: ``(src, dst)`` with ``src > dst``."""

    @forgetting
    def run(batches):
        src, dst = [], []
        for _, rows in runs(batches, 3):
            texts = dict(rows)
            if len(texts) < 2:
                continue
            found = sorted(((shingle_hashes(t, k), v) for v, t in texts.items()), key=lambda p: (len(p[0]), p[1]))
            union = connected([s for s, _ in found])
            least: dict[int, int] = {}
            for x, (_, vertex) in enumerate(found):
                root = union.find(x)
                least[root] = min(vertex, least.get(root, vertex))
            for x, (_, vertex) in enumerate(found):
                if vertex != least[union.find(x)]:
                    src.append(vertex)
                    dst.append(least[union.find(x)])
            if len(src) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])
                src, dst = [], []
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return members.select(*CELL_KEY, "vertex", "text").repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInArrow(run, "src long, dst long")


def pairs(members: DataFrame, k: int) -> DataFrame:
    """Every linked pair of vertices once: numbers, documents with them, sizes, overlap.

    Of the cells that two sets share, the one with the smallest leader has their
    pair, and of its blocks those that the two are in.
    """
    names = ["a", "b", "copies_a", "copies_b", "n_a", "n_b", "n_shared"]

    @forgetting
    def run(batches):
        out = []

        def flushed():
            columns = list(zip(*out)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for (leader, i, j), rows in runs(batches, 3):
            members_ = {v: (t, n, block, set(leaders)) for v, t, n, block, leaders in rows}
            if len(members_) < 2:
                continue
            found = sorted(((shingle_hashes(t, k), v) for v, (t, *_) in members_.items()), key=lambda p: (len(p[0]), p[1]))
            for x, y, both in linked([s for s, _ in found]):
                a, b = found[x][1], found[y][1]
                (_, m, own, leaders), (_, n, other, others) = members_[a], members_[b]
                if min(leaders & others) == leader and (min(own, other), max(own, other)) == (i, j):
                    out.append((a, b, m, n, len(found[x][0]), len(found[y][0]), both))
                if len(out) > 10_000:
                    yield flushed()
                    out.clear()
        yield flushed()

    rows = members.select(*CELL_KEY, "vertex", "text", "copies", "block", "leaders")
    return rows.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInArrow(run, ", ".join(f"{c} long" for c in names))


# --- the join ----------------------------------------------------------------


def with_texts(members: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """Members of cells with their set's text."""
    text = text_of(docs)
    texts = docs.select(docs["doc_id"].cast("long").alias("d"), F.xxhash64(text).alias("h"), text.alias("text"))
    members = members.join(found.select("vertex", "least.doc_id", "least.text_hash"), "vertex")
    return members.join(texts, (F.col("h") == F.col("text_hash")) & F.col("d").eqNullSafe(F.col("doc_id")))


def joined(docs: DataFrame, row: str | None = None, k: int = K, cell: int = CELL) -> DataFrame:
    """Per document: row number, id, hash of its text, size of its set, component,
    and whether it is the component's first."""
    rows = sets(docs, row, k)
    found = vertices(rows)
    members = with_texts(promising(cells(found, cell), found), found, docs)
    star = components(links(members, k)).select(F.col("src").alias("vertex"), F.col("dst").alias("root"))
    labelled = found.join(star, "vertex", "left").select("key", "least", F.coalesce("root", "vertex").alias("root"))
    first = labelled.groupBy("root").agg(F.min("least").alias("component"))
    by_key = labelled.join(first, "root").select("key", "component")
    return rows.join(by_key, "key", "left").select(
        "row",
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.col("n_shingles").eqNullSafe(0) | (F.col("component.row") == F.col("row"))).alias("kept"),
    )


def all_links(docs: DataFrame, k: int, cell: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored rows, the sets with the number of their documents, the pairs of sets."""
    rows = sets(docs, None, k)
    found = vertices(rows)
    met = cells(found, cell)
    near = promising(met, found)
    leaders = near.groupBy("vertex").agg(F.collect_set("leader").alias("leaders"))
    counted = found.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "key").select("vertex", "key", "least", "copies")
    members = near.join(met, [*CELL_KEY, "vertex"]).join(leaders, "vertex").join(counted.select("vertex", "copies"), "vertex")
    return rows, counted, pairs(with_texts(members, found, docs), k)


def linked_pairs(docs: DataFrame, k: int = K, cell: int = CELL) -> DataFrame:
    """Every linked pair of different sets once, each set by its first document:
    ids, numbers of documents with the set, sizes, and shingles in common."""
    _, counted, found = all_links(docs, k, cell)
    for side in "ab":
        ids = counted.select(F.col("vertex").alias(side), F.col("least.doc_id").alias(f"doc_id_{side}"))
        found = found.join(ids, side)
    return found.select("doc_id_a", "doc_id_b", "copies_a", "copies_b", "n_a", "n_b", "n_shared")


def link_counts(docs: DataFrame, k: int = K, cell: int = CELL) -> DataFrame:
    """Per document its id, the size of its set and the number of other documents
    it is linked with, those with the same set too."""
    rows, counted, found = all_links(docs, k, cell)
    ends = F.array(*[F.struct(F.col(x).alias("vertex"), F.col(f"copies_{y}").alias("n")) for x, y in ("ab", "ba")])
    near = found.select(F.explode(ends).alias("end")).groupBy(F.col("end.vertex").alias("vertex")).agg(F.sum("end.n").alias("near"))
    n_links = (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")
    by_key = counted.join(near, "vertex", "left").select("key", n_links)
    return rows.join(by_key, "key", "left").select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of every component the first stays; of
    rows with the same id and text one, chosen by a hash of the whole row."""
    kept = joined(docs).filter("kept")
    names = {c: fresh(docs, c) for c in ("text_hash", "known_id", "turn")}
    key = [names["text_hash"], names["known_id"]]

    def known(doc_id: Column) -> Column:
        return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))

    staying = kept.select(F.col("text_hash").alias(key[0]), known(F.col("doc_id")).alias(key[1])).distinct()
    rows = docs.withColumns({key[0]: F.xxhash64(text_of(docs)), key[1]: known(docs["doc_id"])})
    turn = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*docs.columns)))
    return rows.join(staying, key).withColumn(names["turn"], turn).filter(F.col(names["turn"]) == 1).select(*docs.columns)
