"""Product codes of integer vectors, by exact matrix products of limbs.

Components become integers, ``floor(SCALE * x)``. Nearest entries are told by
``|c|^2 - 2 x.c``, where the dot products come from BLAS: integers are split into limbs
of ``limb_bits`` bits, so short that a product of two limb matrices stays below 2^53
and float64 is exact; the products are put together in int64, or in Python's integers
where int64 doesn't hold them. Ties go to the first entry.

A round is one pass of a Spark job over the stored vectors: each task sums the limbs of
the parts it assigned to every entry, Spark adds these up, and what comes to the driver
is a codebook's worth of sums (entries times vector length), whatever the table's size.
Sums of limbs fit 64 bits for 2^32 rows.

Vectors that are missing, or hold missing or non-finite components, are left out. The
vector with the smallest id gives the length; vectors of another length are left out as
well, since they have no parts to compare. Parts are cut at ``p * length // parts``,
equal where the length allows. Ties of ``vec_id`` (repeated rows, missing ids, which
come last) stand in order of their vectors. With fewer than 16 vectors there are fewer
entries. Errors that don't fit 64 bits are NULL, as are the sums they belong to.
Components of 2^1012 and more count as non-finite. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almoner.llm.common import ship
from almoner.session import written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
SUM_BITS = 31
LONGEST = (1 << 63) - 1


def limb_bits(length: int) -> int:
    """Bits of a limb: ``length`` products of two limbs stay below 2^53."""
    return (52 - max(length - 1, 0).bit_length()) // 2


def limbs(values: np.ndarray, bits: int, n: int) -> list[np.ndarray]:
    """Integers, as floats, in ``n`` limbs, lowest first; the last has the sign."""
    found, base = [], float(1 << bits)
    for _ in range(n - 1):
        high = np.floor(values / base)
        found.append(values - high * base)
        values = high
    return [*found, values]


def entry_limbs(entries: list[list[int]], bits: int, n: int) -> list[np.ndarray]:
    low = (1 << bits) - 1
    cut = [[[x >> bits * k & low if k < n - 1 else x >> bits * k for x in row] for row in entries] for k in range(n)]
    return [np.array(rows, np.float64) for rows in cut]


class Codebook:
    """The entries of one part, ready for products with any number of vectors.

    ``largest`` bounds all components of vectors and entries.
    """

    def __init__(self, entries: list[list[int]], largest: int):
        self.entries = entries
        length = len(entries[0])
        self.bits = limb_bits(length)
        self.n = max(1, -(-largest.bit_length() // self.bits))
        self.limbs = entry_limbs(entries, self.bits, self.n)
        # all distances, and what they are made of, fit 64 bits
        self.small = 4 * max(length, 1) * largest * largest < 1 << 62
        self.norms = np.array([sum(x * x for x in row) for row in entries], np.int64 if self.small else object)

    def together(self, products: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
        """The sum of limb products, each with the place of its lowest bit."""
        total = 0
        for shift, product in products:
            exact = product.astype(np.int64)
            total = total + (exact << shift if self.small else exact.astype(object) * (1 << shift))
        return total

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the first of the nearest entries, and its squared distance."""
        cut = limbs(values, self.bits, self.n)
        pairs = [(self.bits * (i + j), i, j) for i in range(self.n) for j in range(self.n)]
        dots = self.together((shift, cut[i] @ self.limbs[j].T) for shift, i, j in pairs)
        norms = self.together((shift, (cut[i] * cut[j]).sum(axis=1)) for shift, i, j in pairs)
        distances = self.norms[None, :] - 2 * dots
        code = np.argmin(distances, axis=1)
        return code, distances[np.arange(len(code)), code] + norms


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    return [(p * length // parts, (p + 1) * length // parts) for p in range(parts)]


def matrix(column: pa.Array, scale: int, length: int) -> np.ndarray:
    """A batch's integer vectors, as floats: a multiple by a power of two is exact."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).reshape(len(column), length)


def kept_vectors(vectors: DataFrame, scale: int) -> tuple[DataFrame, int, int, list[list[float]]]:
    """The vectors to encode, stored; their length, a bound of their integers' size, the first ones."""
    vector = F.col("embedding").cast("array<double>") if vectors.schema["embedding"].dataType != T.ArrayType(T.FloatType()) else F.col("embedding")
    good = vectors["embedding"].isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float(2**1012)))
    rows = written(vectors.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector")), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = rows.orderBy(*order).first()
    if first is None:
        return rows, 0, 0, []
    length = len(first["vector"])
    rows = rows.filter(F.size("vector") == length)
    most = rows.agg(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))).first()[0] or 0.0
    return rows, length, int(most * scale) + 1, [r["vector"] for r in rows.orderBy(*order).limit(ENTRIES).collect()]


def entry_sums(rows: DataFrame, books: list[list[list[int]]], places: list[tuple[int, int]], largest: int, scale: int) -> DataFrame:
    """Per part, entry, position and limb: the sum over the vectors assigned there, and their number."""
    length, n = places[-1][1], max(1, -(-largest.bit_length() // SUM_BITS))

    def run(batches):
        coded = [Codebook(book, largest) for book in books]
        totals = [np.zeros((n, len(book), stop - start + 1), np.int64) for book, (start, stop) in zip(books, places)]
        for batch in batches:
            values = matrix(batch.column(0), scale, length)
            for total, book, (start, stop) in zip(totals, coded, places):
                code, _ = book.nearest(values[:, start:stop])
                chosen = (code[None, :] == np.arange(len(book.entries))[:, None]).astype(np.float64)
                for k, limb in enumerate(limbs(values[:, start:stop], SUM_BITS, n)):
                    total[k, :, :-1] += (chosen @ limb).astype(np.int64)
                    total[k, :, -1] += (chosen.sum(axis=1)).astype(np.int64)
        for part, total in enumerate(totals):
            limb, entry, position = (x.ravel() for x in np.indices(total.shape))
            kept = total.ravel() != 0
            columns = [np.full(kept.sum(), part), entry[kept], position[kept], limb[kept]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), pa.array(total.ravel()[kept])], names=["part", "entry", "position", "limb", "total"])

    ship(rows.sparkSession)
    sums = rows.select("vector").mapInArrow(run, "part int, entry int, position int, limb int, total long")
    return sums.groupBy("part", "entry", "position", "limb").agg(F.sum("total").alias("total"))


def moved(books: list[list[list[int]]], sums: DataFrame) -> list[list[list[int]]]:
    """The entries after a round: mean of what was assigned, rounded down; unused ones stay."""
    whole: dict[tuple[int, int, int], int] = {}
    counts: dict[tuple[int, int], int] = {}
    for part, entry, position, limb, total in sums.collect():  # one codebook's worth of sums
        if position == len(books[part][0]):
            counts[part, entry] = total
        else:
            whole[part, entry, position] = whole.get((part, entry, position), 0) + (total << SUM_BITS * limb)
    return [
        [[whole.get((p, e, i), 0) // counts[p, e] for i in range(len(row))] if (p, e) in counts else row for e, row in enumerate(book)]
        for p, book in enumerate(books)
    ]


def learned(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, rounds: int = ROUNDS):
    """Kept vectors, and the codebooks of all parts after the last round."""
    rows, length, largest, first = kept_vectors(vectors, scale)
    places = cuts(length, parts)
    books = [[[int(np.floor(x * scale)) for x in np.array(vector[start:stop], np.float64)] for vector in first] for start, stop in places]
    for _ in range(rounds if first else 0):
        books = moved(books, entry_sums(rows, books, places, largest, scale))
    return rows, places, largest, books


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for row in book for x in row).encode()).hexdigest()


def coded(rows: DataFrame, places: list[tuple[int, int]], largest: int, books: list[list[list[int]]], scale: int = SCALE) -> DataFrame:
    """Per vector: id, label, the entries of its parts, its squared error."""
    length = places[-1][1]

    def run(batches):
        ready = None
        for batch in batches:
            ready = ready or [Codebook(book, largest) for book in books]
            values = matrix(batch.column(2), scale, length)
            found = [book.nearest(values[:, start:stop]) for book, (start, stop) in zip(ready, places)]
            codes = np.stack([code for code, _ in found], axis=1)
            errors = sum(error.astype(object) for _, error in found)
            names = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            fitting = [int(e) if e <= LONGEST else None for e in errors]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(fitting, pa.int64())], names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    ship(rows.sparkSession)
    return rows.select("vec_id", "label", "vector").mapInArrow(run, schema)


def compressed(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: code, error, the error of its label's vectors, hash of the codebooks."""
    rows, places, largest, books = learned(vectors, scale, parts, rounds)
    codes = written(coded(rows, places, largest, books, scale), "codes")
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error"))
    labels = codes.groupBy(F.col("label").alias("of")).agg(whole.alias("label_error"))
    return codes.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )


def sql(rounds: int = ROUNDS) -> str:
    """The same over ``embeddings``, where squared errors fit 64 bits."""
    steps = [
        """
        v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        i AS (SELECT r, e, unnest(range(0, len(e))) AS k FROM v),
        x AS MATERIALIZED (SELECT r, k // (len(e) // 8) AS part, k % (len(e) // 8) AS pos, e[k + 1] AS x FROM i),
        b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x AS c FROM x WHERE r <= 16)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""
        d{k} AS (SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM x JOIN b{k} USING (part, pos) GROUP BY ALL),
        a{k} AS MATERIALIZED (SELECT r, part, min(d * 16 + entry) % 16 AS entry, min(d) AS d FROM d{k} GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
        s{k} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM x JOIN a{k} USING (r, part) GROUP BY ALL),
        b{k + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, b.pos, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c
            FROM b{k} b LEFT JOIN s{k} s ON s.part = b.part AND s.entry = b.entry AND s.pos = b.pos
        )""")
    return f"""
        WITH {",".join(steps)},
        q AS (
            SELECT r, string_agg('0' || substr('0123456789abcdef', CAST(entry AS INTEGER) + 1, 1), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY r
        ),
        l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM v JOIN q USING (r) GROUP BY label),
        h AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, label_error, codebooks_sha256
        FROM v JOIN q USING (r) JOIN l ON l.label IS NOT DISTINCT FROM v.label CROSS JOIN h
    """
