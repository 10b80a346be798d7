"""Substring dedup by compacting the de Bruijn graph of repeated word sequences.

An edge of the graph is a window of ``window`` words, a node what two neighbouring
windows share. The graph is never held edge by edge:

* windows in a row whose least ``ANCHOR``-word hash (the leftmost one) is the same form a
  piece, a path that is already compact. Equal windows have equal anchors, so pieces
  whose anchor occurs once hold no repeated window and go no further. A piece is known
  by its anchor and a second hash of its words, and has a source, its first place.
* pieces are compacted into paths by joins: if every occurrence of P is followed by Q and
  every one of Q preceded by P, the node between doesn't branch. Such pieces lie side by
  side at their source too, so paths are runs of pieces there.
* where one anchor has several pieces (paths that branch off), the windows of these are
  looked up at their sources and compared one by one, by a SHA-256 of their words.
* what a path repeats is verified: the words at its source coordinates are digested, and
  a document loses the words of an occurrence only if its own ones give the same digest.

A word of ``words()`` is a run of anything but ASCII white space, unchanged. A window is
removed if its words also start earlier: in a document before, by ``doc_id`` (missing
ones first; different texts with one id in order of their hash), or before in the same
document. Rows with the same id and text are one document and get the same result. Texts
are read whole; a missing or empty one has no words, one of fewer words than a window
loses none. An empty table gives an empty result; other columns are ignored.

Only narrow rows are grouped, with partial results before each shuffle. The lists that
go back to a document hold at most one entry for each of its own windows. Joins are left
to Spark, which splits large keys (a common passage) while it runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import ship, text_of
from almoner.session import written

WINDOW, ANCHOR = 20, 6
#: Bytes of text looked at together, and the most a task remembers of words.
SLICE, KNOWN, LONG_WORD = 1 << 22, 100_000, 64
PLACE = ["doc_id", "tie"]


class _Hashes(dict):
    """Hashes of words, bounded in number and in the length of what is kept."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = found
        return found


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of sequences put together from two parts."""
    h = (left ^ (left >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + right * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _runs(one: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` words in a row, from those of two shorter runs that cover them."""
    found, size = one, 1
    while size < n:
        step = min(size, n - size)
        found, size = _joined(found[:-step], found[step:]), size + step
    return found


class Words:
    """The words of several texts, one after another."""

    def __init__(self, texts: list[str]):
        found = [text.encode("utf-8", "surrogatepass").split() for text in texts]
        self.counts = np.array([len(w) for w in found], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.words = [word for words in found for word in words]

    def spaced(self) -> tuple[bytes, np.ndarray]:
        """All words joined by one space, and where each begins there."""
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        return b" ".join(self.words), np.concatenate([[0], np.cumsum(lengths + 1)])


def word_hashes(words: Words, hashes: _Hashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words.words), np.uint64, len(words.words))


def anchors(words: Words, one: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of all texts: first window, number of windows, hash of the anchor.

    ``one`` are the hashes of the words.
    """
    empty = np.empty(0, np.int64)
    if len(one) < window:
        return empty, empty, empty
    grams = _runs(one, min(ANCHOR, window))
    # the least gram of each window and its place, by doubling; the leftmost of equal ones
    least, place, size, span = grams, np.arange(len(grams)), 1, len(grams) - (len(one) - window)
    while size < span:
        step = min(size, span - size)
        left = least[:-step] <= least[step:]
        least, place = np.where(left, least[:-step], least[step:]), np.where(left, place[:-step], place[step:])
        size += step
    valid = np.ones(len(least), bool)
    for end in words.starts[1:-1].tolist():  # windows that reach into the next text
        valid[max(0, end - window + 1) : end] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return empty, empty, empty
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (place[at[1:]] != place[at[:-1]])
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    return first, count, least[first].view(np.int64)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of at most ``SLICE`` bytes of text, or one text."""
    texts = batch.column(column)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE:
            yield batch.slice(begin, i - begin), texts.slice(begin, i - begin).to_pylist()
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin), texts.slice(begin).to_pylist()


def _digests(words: Words, first: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """SHA-256 of the words of spans, as bytes in rows."""
    data, begin = words.spaced()
    view = memoryview(data)
    ends = begin[first + n_words] - 1
    found = b"".join(hashlib.sha256(view[i:j]).digest() for i, j in zip(begin[first].tolist(), ends.tolist()))
    return np.frombuffer(found, np.uint8).reshape(-1, 32)


def texts_of(docs: DataFrame) -> DataFrame:
    """Id, text, and the text's hash, which tells apart texts with one id."""
    text = text_of(docs)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def repeated_anchors(texts: DataFrame, window: int) -> DataFrame:
    """Hashes of anchors that two or more pieces have."""

    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            for _, part in slices(batch, 0):
                words = Words(part)
                values, counts = np.unique(anchors(words, word_hashes(words, hashes), window)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["anchor", "n"])

    counted = texts.select("text").mapInArrow(run, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")


def occurrences(texts: DataFrame, window: int) -> DataFrame:
    """Every piece at every place: anchor, second hash, document, first window, number of windows."""

    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            for rows, part in slices(batch, 2):
                words = Words(part)
                one = word_hashes(words, hashes)
                first, count, anchor = anchors(words, one, window)
                if not len(first):
                    continue
                whole = _runs(one * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(0xA0761D6478BD642F), window)
                # its first and last window have all words of a piece
                piece = _joined(whole[first] + count.astype(np.uint64), whole[first + count - 1]).view(np.int64)
                doc = np.searchsorted(words.starts, first, "right") - 1
                # empty texts share their start with the next one; the last of these has the words
                ids = rows.column(0).take(pa.array(doc))
                ties = rows.column(1).take(pa.array(doc))
                at = pa.array((first - words.starts[doc]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(piece), ids, ties, at, pa.array(count.astype(np.int32))], names=["anchor", "piece", *PLACE, "at", "n"])

    return texts.mapInArrow(run, "anchor long, piece long, doc_id long, tie long, at int, n int")


def same(left: DataFrame, right: DataFrame, *names: str):
    """Equal keys, missing ones too."""
    found = F.lit(True)
    for name in names:
        found = found & left[name].eqNullSafe(right[name])
    return found


def compacted(places: DataFrame, pieces: DataFrame) -> DataFrame:
    """Paths: source, number of windows, their first piece.

    ``pieces`` has the number of places of every piece and its source.
    """
    follows = places.select(
        F.col("anchor").alias("anchor2"), F.col("piece").alias("piece2"), F.col("doc_id").alias("doc2"), F.col("tie").alias("tie2"), F.col("at").alias("at2")
    )
    repeated = pieces.filter("copies > 1")
    pairs = (
        places.join(follows, F.col("doc_id").eqNullSafe(F.col("doc2")) & (F.col("tie") == F.col("tie2")) & (F.col("at") + F.col("n") == F.col("at2")))
        .groupBy("anchor", "piece", "anchor2", "piece2")
        .agg(F.count(F.lit(1)).alias("together"))
        .filter("together > 1")
    )
    before = repeated.select("anchor", "piece", F.col("copies").alias("together"))
    after = repeated.select(F.col("anchor").alias("anchor2"), F.col("piece").alias("piece2"), F.col("copies").alias("together"))
    # no branch between them: as often together as each by itself
    inner = pairs.join(before, ["anchor", "piece", "together"]).join(after, ["anchor2", "piece2", "together"]).select(F.col("anchor2").alias("anchor"), F.col("piece2").alias("piece"), F.lit(1).alias("inner"))
    along = Window.partitionBy(*PLACE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = repeated.join(inner, ["anchor", "piece"], "left").withColumn("path", F.sum(F.when(F.col("inner").isNull(), 1).otherwise(0)).over(along))
    return numbered.groupBy(*PLACE, "path").agg(
        F.min("at").alias("at"),
        (F.max(F.col("at") + F.col("n")) - F.min("at")).alias("windows"),
        F.min_by(F.struct("anchor", "piece"), "at").alias("head"),
        F.first("copies").alias("copies"),
    )


def looked_up(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Digests from the sources: of whole paths, and of the single windows of pieces.

    ``wanted`` names a document, a first window, a number of windows, and whether these
    form a path. Repeated documents give their digests repeatedly.
    """

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, 2):
                words, lists = Words(texts), rows.column(3)
                owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                at, n, path = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(3))
                at, n, path = at + words.starts[owner], n.astype(np.int64), path.astype(bool)
                pieces, sizes = at[~path], n[~path]
                # the windows of all pieces, each once
                windows = np.unique(np.repeat(pieces - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()))
                first = np.concatenate([at[path], windows])
                size = np.concatenate([n[path], np.ones(len(windows), np.int64)])
                digest = _digests(words, first, size + window - 1)
                halves = [np.ascontiguousarray(digest[:, k : k + 8]).view(np.int64).ravel() for k in (0, 8)]
                doc = np.searchsorted(words.starts, first, "right") - 1
                places = pa.array((first - words.starts[doc]).astype(np.int32))
                ids, ties = (rows.column(k).take(pa.array(doc)) for k in (0, 1))
                columns = [ids, ties, places, pa.array(size.astype(np.int32)), pa.array(np.arange(len(first)) < path.sum()), *map(pa.array, halves)]
                yield pa.RecordBatch.from_arrays(columns, names=[*PLACE, "at", "windows", "path", "digest0", "digest1"])

    lists = wanted.groupBy(*PLACE).agg(F.collect_list(F.struct("at", "n", "path")).alias("wanted"))
    rows = texts.join(lists, same(texts, lists, *PLACE)).select(texts["doc_id"], texts["tie"], "text", "wanted")
    return written(rows.mapInArrow(run, "doc_id long, tie long, at int, windows int, path boolean, digest0 long, digest1 long"), "sources")


def repeats(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans whose windows all start earlier too: document, first window, number of windows.

    Those that repeat a path have its digest, and its source.
    """
    ship(texts.sparkSession)
    # hashed, not sorted: the anchors of a partition are few beside its pieces
    repeated = repeated_anchors(texts, window).hint("shuffle_hash")
    places = written(occurrences(texts, window).join(repeated, "anchor", "left_semi").distinct(), "places")
    source = F.min(F.struct(*PLACE, "at"))
    pieces = places.groupBy("anchor", "piece", "n").agg(source.alias("source"), F.count(F.lit(1)).alias("copies"))
    pieces = written(pieces.select("anchor", "piece", "n", "copies", "source.*"), "pieces")
    paths = written(compacted(places, pieces), "paths")
    branching = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = pieces.join(branching, "anchor", "left_semi").select(*PLACE, "at", "n", F.lit(False).alias("path"))
    wanted = wanted.unionByName(paths.select(*PLACE, "at", F.col("windows").alias("n"), F.lit(True).alias("path")))
    sources = looked_up(texts, wanted, window)

    edges = sources.filter(~F.col("path")).select(*PLACE, "at", "digest0", "digest1")
    first = edges.groupBy("digest0", "digest1").agg(F.min(F.struct(*PLACE, "at")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = edges.join(first, ["digest0", "digest1"]).filter(F.struct(*PLACE, "at") != F.col("first"))
    none = F.lit(None).cast("long")
    single = later.select(*PLACE, "at", F.lit(1).alias("windows"), none.alias("digest0"), none.alias("digest1"), F.col("first.doc_id").alias("source_id"), F.col("first.at").alias("source_at"))

    whole = sources.filter("path").distinct().select(F.col("doc_id").alias("source_id"), F.col("tie").alias("source_tie"), F.col("at").alias("source_at"), "digest0", "digest1")
    known = paths.join(
        whole, paths["doc_id"].eqNullSafe(whole["source_id"]) & (paths["tie"] == whole["source_tie"]) & (paths["at"] == whole["source_at"])
    ).select("head.anchor", "head.piece", "windows", "source_id", "source_tie", "source_at", "digest0", "digest1")
    copies = places.join(known, ["anchor", "piece"]).filter(
        ~(F.col("doc_id").eqNullSafe(F.col("source_id")) & (F.col("tie") == F.col("source_tie")) & (F.col("at") == F.col("source_at")))
    )
    names = [*PLACE, "at", "windows", "digest0", "digest1", "source_id", "source_at"]
    return copies.select(*names).unionByName(single.select(*names))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: id, kept text (words joined by one space), numbers of words."""

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, 1):
                kept, n_words, n_removed = [], [], []
                for i, text in enumerate(texts):
                    words, spans = Words([text]), part.column(2)[i]
                    n = len(words.words)
                    gone = np.zeros(n, bool)
                    if spans.is_valid and n >= window:
                        at, size, digest0, digest1 = (spans.values.field(k) for k in range(4))
                        at, size = at.to_numpy().astype(np.int64), size.to_numpy().astype(np.int64)
                        to_verify = digest0.is_valid().to_numpy(zero_copy_only=False)
                        good = np.ones(len(at), bool)
                        if to_verify.any():
                            found = _digests(words, at[to_verify], size[to_verify] + window - 1)
                            for k, digest in enumerate((digest0, digest1)):
                                expected = digest.drop_null().to_numpy()
                                good[to_verify] &= np.ascontiguousarray(found[:, 8 * k : 8 * k + 8]).view(np.int64).ravel() == expected
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, at[good], 1)
                        np.add.at(edge, at[good] + size[good] + window - 1, -1)
                        gone = np.cumsum(edge)[:n] > 0
                    kept.append(b" ".join(w for w, g in zip(words.words, gone.tolist()) if not g) if gone.any() else b" ".join(words.words))
                    n_words.append(n)
                    n_removed.append(int(gone.sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=["doc_id", "kept_text", "n_words", "n_removed"]
                )

    texts = texts_of(docs)
    spans = repeats(texts, window).groupBy(*PLACE).agg(F.collect_list(F.struct("at", "windows", "digest0", "digest1")).alias("spans"))
    rows = texts.join(spans, same(texts, spans, *PLACE), "left").select(texts["doc_id"], "text", "spans")
    return rows.mapInArrow(run, "doc_id long, kept_text string, n_words long, n_removed long")


SQL = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM d WHERE len(w) >= 20),
    k AS (SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 19), ' ') AS words FROM p),
    n AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY words ORDER BY doc_id, pos) AS nth FROM k),
    g AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(pos, pos + 20)) AS i FROM n WHERE nth > 1) GROUP BY doc_id),
    e AS (SELECT d.doc_id, d.w, i, g.gone FROM d LEFT JOIN g USING (doc_id), unnest(range(1, len(d.w) + 1)) AS u(i)),
    r AS (SELECT e.doc_id, string_agg(e.w[e.i], ' ' ORDER BY e.i) AS kept FROM e LEFT JOIN (SELECT doc_id, unnest(gone) AS i FROM g) x USING (doc_id, i) WHERE x.i IS NULL GROUP BY e.doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
    FROM d LEFT JOIN g USING (doc_id) LEFT JOIN r USING (doc_id)
"""
