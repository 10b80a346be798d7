"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the hash's upper bits name one of ``BINS`` bins, of
which the smallest hash is kept. An empty bin takes over the value of a full one
by optimal densification: each bin ranks all others by a hash of the pair, and
takes the best-ranked full one, so equal sets fill alike and no two empty bins
have to agree. Of each value the low ``BITS`` bits are kept, packed as hex. The
likeness of two fingerprints is the share of equal bins, freed of the share that
is equal by chance.

Shingles have five words, A-Z as a-z, words ending at ASCII white space; a text
with fewer words is one shingle. Missing texts count as empty; without words the
fingerprint is empty, like other empty ones (1) and unlike the rest (0). Equal
texts have equal fingerprints.

``edited`` pairs every document with its successor by descending ``doc_id``
(missing ids last, ties by a hash of the text). Documents are dealt by quantiles
of the id, whose first documents are also given to the bucket before, so that one
window within buckets finds every successor. A single document succeeds itself;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import text_of

K, BINS, BITS = 5, 128, 8
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bin(h: Column) -> Column:
    half = BINS // 2
    return F.shiftright(h, 64 - half.bit_length()).cast("int") + half


def with_sketch(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the bins' low bits of column ``text``, empty without words."""
    words = F.split(F.btrim(F.translate(text, UPPER, LOWER), F.lit(SPACE)), r"[\x20\x09-\x0D]+", -1)
    w, s, f = f"{name}_w", f"{name}_s", f"{name}_f"
    rows = rows.withColumn(w, F.transform(words, lambda x: F.xxhash64(x)))
    shingles = F.transform(
        F.slice(w, F.lit(1), F.size(w) - (K - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(F.col(w), i + j) for j in range(1, K)]),
    )
    rows = rows.withColumn(s, F.when(F.size(w) >= K, F.sort_array(shingles)).otherwise(F.array(F.xxhash64(w))))
    # sorted hashes stand bin by bin: the first of each is the bin's smallest
    firsts = F.filter(s, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(F.col(s), i - 1))))
    rows = rows.withColumn(f, firsts).withColumn(w, F.transform(f, _bin))

    def value(j: Column) -> Column:
        at = F.array_position(w, j)
        ranked = F.transform(w, lambda b, i: F.struct(F.xxhash64(j, b).alias("rank"), i.alias("i")))
        taken = F.when(at > 0, (at - 1).cast("int")).otherwise(F.array_min(ranked)["i"])
        return F.get(F.col(f), taken).bitwiseAND((1 << BITS) - 1).cast("int")

    sketch = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)
    has_words = F.btrim(F.col(text), F.lit(SPACE)) != ""
    return rows.withColumn(name, F.when(has_words, sketch).otherwise(F.array().cast("array<int>"))).drop(w, s, f)


def packed(sketch: Column) -> Column:
    digits = -(-BITS // 4)
    return F.array_join(F.transform(sketch, lambda v: F.lower(F.lpad(F.hex(v), digits, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the sets behind two sketches."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))
    empty_a, empty_b = F.size(a) == 0, F.size(b) == 0
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(corrected)


def _bucket(doc_id: Column, borders: list[int]) -> Column:
    """How many borders lie below the id: of groups of borders, then within one."""
    if not borders:
        return F.lit(0)
    step = max(1, math.isqrt(len(borders)))
    groups = [borders[i : i + step] for i in range(0, len(borders), step)]

    def longs(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    group = F.size(F.filter(longs([g[-1] for g in groups]), lambda b: b < doc_id))
    own = F.get(F.array(*[longs(g) for g in groups]), group)
    inside = F.when(group < len(groups), F.size(F.filter(own, lambda b: b < doc_id))).otherwise(0)
    return F.when(doc_id.isNull(), 0).otherwise(group * step + inside)


def with_next(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with a struct ``next`` of the successor's ``text`` and ``sketch``."""
    ids = rows.select("doc_id")
    shares = [i / buckets for i in range(1, buckets)]
    cuts = ids.agg(F.percentile_approx("doc_id", F.array(*[F.lit(p) for p in shares]), F.lit(100 * buckets))).first()[0] if shares else None
    borders = sorted(set(cuts or []))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("bucket", _bucket(F.col("doc_id"), borders).cast("int"))
    # a row per bucket: its first document
    heads = {r[0]: r[1] for r in rows.select("bucket", "doc_id", "tie").groupBy("bucket").agg(F.max(F.struct("doc_id", "tie"))).collect()}
    present = sorted(heads)
    before = {b: present[(k + 1) % len(present)] for k, b in enumerate(present)}
    table = F.array(
        *[
            F.struct(
                F.lit(heads[b][0] if b in heads else None).cast("long").alias("doc_id"),
                F.lit(heads[b][1] if b in heads else None).cast("long").alias("tie"),
                F.lit(before.get(b, 0)).alias("before"),
            )
            for b in range(len(borders) + 1)
        ]
    )
    head = F.get(table, F.col("bucket"))
    is_head = F.col("doc_id").eqNullSafe(head["doc_id"]) & F.col("tie").eqNullSafe(head["tie"])
    places = F.when(is_head, F.array("bucket", head["before"])).otherwise(F.array("bucket"))
    dealt = rows.select(*[c for c in rows.columns if c != "bucket"], F.posexplode(places).alias("guest", "bucket"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return dealt.withColumn("next", F.lead(F.struct("text", "sketch")).over(order)).filter("guest = 0").drop("guest", "bucket", "tie")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its text with an end from its successor."""
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    paired = with_next(with_sketch(rows, "text", "sketch"), buckets).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    text = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring(F.col("next.text"), F.lit(1), third))
    paired = paired.select("doc_id", "n_chars", "sketch", F.col("next.sketch").alias("next_sketch"), text.alias("edited"))
    both = with_sketch(paired, "edited", "edited_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("sketch")).alias("fingerprint"),
        packed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
