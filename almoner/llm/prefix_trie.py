"""Prefix trie of conversations: every distinct beginning as one node, by ROLLUP.

A turn's id is 128 bits of a digest of its role and text, with the text's length
beside it; texts never travel. A conversation is cut into blocks of ``WIDTH``
positional columns of such ids. ``ROLLUP`` over the columns of a block gives all its
prefixes in one aggregate, and ``grouping_id`` tells how long each is. Blocks beyond
the first are grouped under the key of the node their block starts at: the XOR of
hashes of (position, turn id) over all turns before, so that blocks of any depth are
aggregated at the same time and no round waits for another.

What a subtree holds follows from its members alone, without walking the trie. The
owner of a node is its smallest member; a conversation owns its nodes from some depth
down to its last one. Hence, with a conversation's ``shared`` the code points of the
turns whose nodes it does not own,

* a subtree has as many leaves as members that own a childless node;
* its saved code points are the members' ``shared`` but the owner's, less, for each of
  them, what they share above the node;

and both are sums over the same ROLLUP.

Places of turns come from a range sort of narrow rows, so a conversation may hold a
third of all turns; who ends at a node is hashed from chunks of ids, of at most
``CHUNK`` ids each, streamed in order through one hash per node (SHA-256 is sequential
by nature; memory stays bounded).

Turns stand in order of ``turn``, missing ones first, ties by the turn's digest, equal
ones in any order; repeated rows are turns of their own. Missing roles and texts are
empty. Rows without ``conv_id`` belong to no conversation and are left out. A table
without conversations has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import ship
from almoner.operators.joins import lookup_join
from almoner.session import written

WIDTH = 4
CHUNK = 4096
#: The longest beginning taken from another conversation.
HEAD = 6


def _turn_id(role: Column, text: Column) -> tuple[Column, Column]:
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17))


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per turn its place in the conversation; per conversation its number of turns."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    a, b = _turn_id(role, text)
    narrow = turns.filter(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        a.alias("a"),
        b.alias("b"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("row")]
    placed = written(
        narrow.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "a", "b", "chars", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "turns",
    )
    # one row per conversation and range it lies in
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    lengths = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    place = F.col("at") - F.col("first") + F.col("before")
    return placed.join(starts, ["conv_id", "part"]).select("conv_id", place.alias("place"), "a", "b", "chars"), lengths


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations by place, and every conversation's length.

    The first ``h`` turns come from conversation ``c - c % 100``, the rest is the
    conversation's own after its first ``h``; ``h`` is the CRC of ``c``, modulo 6.
    """
    placed, lengths = numbered_turns(turns)
    taken = F.crc32(F.col("conv_id").cast("string")) % HEAD
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = lengths.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(bases, "base", "left").select(
        "conv_id",
        "base",
        taken.alias("h"),
        F.least(taken, F.coalesce("n_base", F.lit(0))).alias("from_base"),
        F.greatest(F.col("n") - taken, F.lit(0)).alias("own"),
    )
    plan = written(plan, "rebuilding")
    heads = placed.filter(F.col("place") < HEAD - 1).withColumnRenamed("conv_id", "base")
    taken_turns = plan.filter("from_base > 0").join(heads, "base").filter("place < from_base").select("conv_id", "place", "a", "b", "chars")
    offsets = plan.filter("own > 0").select("conv_id", "h", "from_base")
    own = placed.join(offsets, "conv_id").filter("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("from_base")).alias("place"), "a", "b", "chars")
    return taken_turns.unionByName(own), plan.select("conv_id", (F.col("from_base") + F.col("own")).alias("length"))


def _mark(lane: int, place: Column, a: Column, b: Column) -> Column:
    """One of two independent hashes of a turn at a place."""
    return F.xxhash64(place, a, b) if lane == 0 else F.xxhash64(b, F.lit("second"), a, place)


def blocks(turns: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per conversation and block: the key of the node above, turn ids by position.

    ``above_chars`` is what the turns before the block hold. A conversation without
    turns has one block without ids.
    """
    block, position = F.floor(F.col("place") / width), F.col("place") % width
    columns = [
        F.max(F.when(position == i, F.col(c))).alias(f"{c}{i}") for i in range(width) for c in ("a", "b", "chars")
    ]
    marks = [F.bit_xor(_mark(lane, F.col("place"), F.col("a"), F.col("b"))).alias(f"own{lane}") for lane in (0, 1)]
    cut = turns.groupBy("conv_id", block.alias("block")).agg(F.sum("chars").alias("own_chars"), *marks, *columns)
    # a row per block of a conversation, without texts
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"{c}{i}" for i in range(width) for c in ("a", "b", "chars")]
    cut = cut.select(
        "conv_id",
        "block",
        *(F.coalesce(F.bit_xor(f"own{lane}").over(before), F.lit(0)).alias(f"above{lane}") for lane in (0, 1)),
        F.coalesce(F.sum("own_chars").over(before), F.lit(0)).alias("above_chars"),
        *names,
    ).join(lengths.filter("length > 0"), "conv_id")
    zero, missing = F.lit(0).cast("long"), F.lit(None).cast("long")
    silent = lengths.filter("length = 0").select(
        "conv_id",
        zero.alias("block"),
        *(zero.alias(c) for c in ("above0", "above1", "above_chars")),
        *(missing.alias(c) for c in names),
        "length",
    )
    return cut.unionByName(silent)


def prefixes(rows: DataFrame, aggregates: str, width: int = WIDTH) -> DataFrame:
    """One row per node: ``aggregates`` over its members, its depth, keys and last turn."""
    triples = [f"(a{i}, b{i}, chars{i})" for i in range(width)]
    flat = ", ".join(t.strip("()") for t in triples)
    rolled = rows.sparkSession.sql(
        f"SELECT block, above0, above1, above_chars, {flat}, grouping_id() AS gid, {aggregates} FROM {{rows}} "
        f"GROUP BY block, above0, above1, above_chars, ROLLUP({', '.join(triples)})",
        rows=rows,
    )
    # a bit of grouping_id is set per column that is rolled up
    level = (width - F.bit_count(F.col("gid")) / 3).cast("int")
    rolled = rolled.withColumn("level", level)
    last = functools.reduce(lambda other, i: F.when(F.col("level") == i + 1, F.col(f"chars{i}")).otherwise(other), range(width), F.lit(0).cast("long"))
    real = F.when(F.col("level") == 0, F.col("block") == 0)
    for i in range(width):
        real = real.when(F.col("level") == i + 1, F.col(f"a{i}").isNotNull())
    key, up = [], []
    for lane in (0, 1):
        marks = [F.when(F.col("level") > i, _mark(lane, F.col("block") * width + i, F.col(f"a{i}"), F.col(f"b{i}"))).otherwise(0) for i in range(width)]
        shorter = [F.when(F.col("level") > i + 1, mark).otherwise(0) for i, mark in enumerate(marks)]
        key.append(functools.reduce(lambda x, y: x.bitwiseXOR(y), marks, F.col(f"above{lane}")).alias(f"key{lane}"))
        up.append(functools.reduce(lambda x, y: x.bitwiseXOR(y), shorter, F.col(f"above{lane}")).alias(f"up{lane}"))
    above = functools.reduce(lambda x, y: x + y, (F.when(F.col("level") > i + 1, F.col(f"chars{i}")).otherwise(0) for i in range(width)), F.col("above_chars"))
    carried = [c for c in rolled.columns if c not in {"block", "above0", "above1", "above_chars", "gid", "level"} and c.rstrip("0123456789") not in {"a", "b", "chars"}]
    return rolled.filter(real).select(
        (F.col("block") * width + F.col("level")).alias("depth"), *key, *up, last.alias("last_chars"), above.alias("chars_above"), *carried
    )


def _hashed(batches):
    """SHA-256 of the joined chunks of every node; rows come in order of node and chunk."""
    node, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for depth, key0, key1, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, key0, key1) != node:
                if digest:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, key0, key1), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield _ends(done)
    if digest:
        yield _ends([(*node, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    depth, key0, key1, ends = zip(*rows)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (depth, key0, key1)), pa.array(ends, pa.string())], names=["depth", "key0", "key1", "ends_sha256"])


def ends(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per node where conversations end: the hash of their ids in ascending order."""
    last = rows.filter(F.col("length") <= (F.col("block") + 1) * width)
    key = []
    for lane in (0, 1):
        marks = [F.when(F.col(f"a{i}").isNotNull(), _mark(lane, F.col("block") * width + i, F.col(f"a{i}"), F.col(f"b{i}"))).otherwise(0) for i in range(width)]
        key.append(functools.reduce(lambda x, y: x.bitwiseXOR(y), marks, F.col(f"above{lane}")).alias(f"key{lane}"))
    chunks = (
        last.select(F.col("length").alias("depth"), *key, "conv_id", F.floor(F.col("conv_id") / CHUNK).alias("chunk"))
        .groupBy("depth", "key0", "key1", "chunk")
        .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    ship(rows.sparkSession)
    return (
        chunks.repartition("depth", "key0", "key1")
        .sortWithinPartitions("depth", "key0", "key1", "chunk")
        .select("depth", "key0", "key1", "ids")
        .mapInArrow(_hashed, "depth long, key0 long, key1 long, ends_sha256 string")
    )


def trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    rows = written(blocks(*rebuilt(turns), width), "blocks")
    nodes = written(prefixes(rows, "min(conv_id) AS conv_id, count(*) AS n_convs", width), "nodes")
    ended = written(ends(rows, width), "ends")
    n_children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up0").alias("key0"), F.col("up1").alias("key1")).agg(F.count(F.lit(1)).alias("n_children"))
    keyed = ["depth", "key0", "key1"]
    nodes = written(
        nodes.join(n_children, keyed, "left").join(ended, keyed, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "nodes",
    )
    # what a conversation owns: the nodes of which it is the smallest member
    owned = nodes.groupBy("conv_id").agg(F.sum("last_chars").alias("owned_chars"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf"))
    total = F.sum(sum((F.coalesce(f"chars{i}", F.lit(0)) for i in range(width)), F.lit(0)))
    members = rows.groupBy("conv_id").agg(total.alias("total")).join(owned, "conv_id", "left")
    members = members.select("conv_id", (F.col("total") - F.coalesce("owned_chars", F.lit(0))).alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = prefixes(rows.join(members, "conv_id"), "sum(leaf) AS n_leaves, sum(shared) AS shared, min(struct(conv_id, shared)).shared AS of_owner", width)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key0").alias("up0"), F.col("key1").alias("up1"), F.col("conv_id").alias("parent_conv_id"))
    known = lookup_join(nodes, parents, ["depth", "up0", "up1"], "key0")
    result = known.join(sums.select(*keyed, "n_leaves", "shared", "of_owner"), keyed)
    saved = F.col("shared") - F.col("of_owner") - (F.col("n_convs") - 1) * F.col("chars_above")
    return result.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


SQL = """
    WITH t AS (
        SELECT conv_id, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS said,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    c AS (SELECT conv_id, list(said ORDER BY place) AS own FROM t GROUP BY conv_id),
    h AS (
        SELECT conv_id, own,
               xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
                   lambda v, byte: list_reduce(
                       list_prepend(xor(v, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                       lambda w, bit: CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384::BIGINT) ELSE w >> 1 END)
               ), 4294967295::BIGINT) % 6 AS h
        FROM c
    ),
    b AS (
        SELECT h.conv_id, list_concat(list_slice(coalesce(base.own, []), 1, h.h), list_slice(h.own, h.h + 1, len(h.own))) AS turns
        FROM h LEFT JOIN c base ON base.conv_id = h.conv_id - h.conv_id % 100
    ),
    p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM b),
    g AS (
        SELECT d, list_slice(turns, 1, d) AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(max(length(turns[d].x)), 0) AS chars,
               string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = d) AS ends
        FROM p GROUP BY ALL
    ),
    k AS (SELECT list_slice(path, 1, d - 1) AS path, count(*) AS n FROM g WHERE d > 0 GROUP BY ALL),
    f AS (SELECT g.*, coalesce(k.n, 0) AS n_children FROM g LEFT JOIN k ON k.path = g.path),
    a AS (SELECT path, n_convs, chars, n_children, unnest(range(0, d + 1)) AS up FROM f),
    s AS (
        SELECT list_slice(path, 1, up) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
        FROM a GROUP BY ALL
    )
    SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
           CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
    FROM f JOIN s ON s.path = f.path LEFT JOIN g parent ON f.d > 0 AND parent.path = list_slice(f.path, 1, f.d - 1)
"""
