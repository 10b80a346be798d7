"""Token ids in Arrow files of equal-length sequences.

A shard is an Arrow IPC file: the stream format with a footer that gives every
batch's place. Its batches have ``BATCH`` sequences each (the last may have
fewer); a sequence is a fixed-size list of ``length`` ids, packed from document
after document, and a fixed-size list of mask bits, 0 where the end of the shard
is padded. So sequence ``k`` is row ``k % BATCH`` of batch ``k // BATCH``, and a
mapped file is read without a copy. Ids take 16 bits if the vocabulary allows,
else 32. A second file beside it lists the shard's documents: id, first position
and number of ids.

Documents are sorted by ``doc_id`` over all shards (missing ids first, ties in
any order). A task writes under a name of its own and reports it in the manifest,
a table Spark commits; files of tasks that were lost are in no manifest.

Special tokens that stand in a text are found there, as the library does without being
told otherwise. Missing texts count as empty ones; an empty text is the end id alone. Repeated
rows are written repeatedly, other columns ignored, an empty table gives an empty
manifest.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.chunks import Recent, cut, gathered, held, slices
from almoner.llm.common import ship, text_of
from almoner.session import scratch_path

LENGTH, BATCH = 1024, 256
CHUNKS = 250_000
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_sequences long"


class Encoder:
    """The tokenizer behind a table of recent chunks (see ``chunks``).

    The vocabulary's pattern ends a piece before and after a single line break, too, so
    new chunks go through the tokenizer as the lines of one text.
    """

    def __init__(self, path: str, as_bytes: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype(as_bytes)
        self.line = self.ids("\n")
        self.recent = Recent(CHUNKS)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def learn(self, chunks: list[bytes]) -> Iterator[bytes]:
        """Ids of chunks without line breaks that neither begin (a blank aside) nor end
        with white space."""
        for at in range(0, len(chunks), 20_000):
            part = chunks[at : at + 20_000]
            ids = self.ids(b"\n".join(part).decode("utf-8", "surrogatepass"))
            breaks = np.flatnonzero(ids == self.line[0])
            if len(breaks) != len(part) - 1:  # not a pattern of this kind
                raise ValueError("the tokenizer doesn't keep line breaks apart")
            data, size = memoryview(ids.tobytes()), self.dtype.itemsize
            first = np.concatenate([[0], breaks + 1]) * size
            stop = np.append(breaks, len(ids)) * size
            for i, j in zip(first.tolist(), stop.tolist()):
                yield bytes(data[i:j])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian ids of each text."""
        # special tokens hold several kinds of signs, but no white space
        marked = any(pc.any(pc.match_substring(texts, s.decode())).as_py() for s in self.special)
        distinct, numbers, ends = cut(texts, signs=not marked)
        found = self.recent.look_up(distinct)
        new, lines = [], []
        for i, known in enumerate(found):
            if known is None:
                chunk = distinct[i]
                bare = chunk[1:] if chunk[0] == 32 else chunk
                if bare.isalpha() or (bare and b"\n" not in bare and (text := bare.decode("utf-8", "surrogatepass")).strip() == text):
                    new.append(i)
                    lines.append(chunk)
                else:
                    found[i] = self.ids(chunk.decode("utf-8", "surrogatepass")).tobytes()
                    self.recent.put(chunk, found[i])
        for i, known in zip(new, self.learn(lines)):
            found[i] = known
            self.recent.put(distinct[i], known)
        ids, offsets = gathered(found, self.dtype, numbers)
        data, places = memoryview(ids.tobytes()), offsets[np.concatenate([[0], ends])] * self.dtype.itemsize
        return [bytes(data[i:j]) for i, j in zip(places[:-1].tolist(), places[1:].tolist())]


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


class ShardWriter:
    """Packs ids into sequences and writes a batch whenever it is full."""

    def __init__(self, folder: str, shard: int, dtype: str, length: int, end: int):
        self.files, root = store(folder)
        self.files.create_dir(root)
        self.name = f"shard-{shard:06d}-{uuid.uuid4().hex}.arrow"
        self.path = f"{root}/{self.name}"
        self.dtype, self.length, self.end = np.dtype(dtype), length, np.array([end], dtype).tobytes()
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.files.open_output_stream(self.path)
        self.writer = ipc.new_file(self.sink, self.schema)
        self.docs_sink = self.files.open_output_stream(f"{self.path}.docs")
        self.docs_writer = ipc.new_file(self.docs_sink, DOCUMENTS)
        self.pending, self.pending_bytes = [], 0
        self.n_tokens = self.n_docs = self.n_sequences = 0
        self.full = BATCH * length * self.dtype.itemsize

    def add(self, doc_ids: list, encoded: list[bytes]) -> None:
        firsts, counts = [], []
        for ids in encoded:
            firsts.append(self.n_tokens)
            counts.append(len(ids) // self.dtype.itemsize + 1)
            self.n_tokens += counts[-1]
            self.pending += (ids, self.end)
            self.pending_bytes += len(ids) + len(self.end)
        self.n_docs += len(counts)
        self.docs_writer.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(firsts, pa.int64()), pa.array(counts, pa.int64())], schema=DOCUMENTS))
        if self.pending_bytes >= self.full:
            data = b"".join(self.pending)
            whole = len(data) // self.full * self.full
            for at in range(0, whole, self.full):
                self.write(data[at : at + self.full], BATCH * self.length)
            self.pending, self.pending_bytes = [data[whole:]], len(data) - whole

    def write(self, data: bytes, n_real: int) -> None:
        ids = np.frombuffer(data, self.dtype)
        mask = np.arange(len(ids)) < n_real
        self.n_sequences += len(ids) // self.length
        self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        data = b"".join(self.pending)
        if data:
            size = self.length * self.dtype.itemsize
            self.write(data + bytes(-len(data) % size), len(data) // self.dtype.itemsize)
        for part in (self.writer, self.sink, self.docs_writer, self.docs_sink):
            part.close()


class Shard:
    """Random access to a written shard, without copies where it can be mapped."""

    def __init__(self, folder: str, name: str):
        files, root = store(folder)

        def opened(path: str):
            local = isinstance(files, pafs.LocalFileSystem)
            return ipc.open_file(pa.memory_map(path) if local else files.open_input_file(path))

        self.file, self.docs = opened(f"{root}/{name}"), opened(f"{root}/{name}.docs")
        self.length = self.file.schema.field("ids").type.list_size

    def batch(self, number: int) -> np.ndarray:
        """The ids of a batch, sequence after sequence."""
        return self.file.get_batch(number).column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, number: int) -> np.ndarray:
        at = number % BATCH * self.length
        return self.batch(number // BATCH)[at : at + self.length]

    def mask(self, number: int) -> pa.BooleanArray:
        return self.file.get_batch(number // BATCH).column(1)[number % BATCH].values

    def documents(self):
        """Of every document: id, first position, and its ids in one or more pieces."""
        size, number, ids = BATCH * self.length, -1, None
        for k in range(self.docs.num_record_batches):
            for doc_id, first, n in zip(*(c.to_pylist() for c in self.docs.get_batch(k).columns)):
                pieces, at, end = [], first, first + n
                while at < end:
                    if at // size != number:
                        number = at // size
                        ids = self.batch(number)
                    stop = min(end, (number + 1) * size)
                    pieces.append(ids[at - number * size : stop - number * size])
                    at = stop
                yield doc_id, first, pieces


def write_ids(docs: DataFrame, tokenizer: str, end: int, folder: str, length: int = LENGTH, vocabulary: int = 1 << 16) -> DataFrame:
    """Write ``docs`` as shards below ``folder``; the stored manifest."""
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches):
        writer, coder = None, held(("token files", tokenizer, dtype), lambda: Encoder(tokenizer, dtype))
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch.column(1)):
                rows = batch.slice(part.start, part.stop - part.start)
                writer = writer or ShardWriter(folder, shard, dtype, length, end)
                writer.add(rows.column(0).to_pylist(), coder.encode(rows.column(1)))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [writer.name], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens], "n_sequences": [writer.n_sequences]})

    ship(docs.sparkSession)
    ordered = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Of every written document its place and the checksum of its ids."""

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, starts, counts, sums = [], [], [], []
                for doc_id, first, pieces in Shard(folder, name).documents():
                    crc = 0
                    for piece in pieces:
                        crc = zlib.crc32(piece.astype("<u4"), crc)
                    ids.append(doc_id)
                    starts.append(base + first)
                    counts.append(sum(map(len, pieces)))
                    sums.append(crc)
                for at in range(0, len(ids), 10_000):
                    cut = slice(at, at + 10_000)
                    yield pa.RecordBatch.from_arrays([pa.array(x[cut], pa.int64()) for x in (ids, starts, counts, sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per shard: a running sum over all of them is short
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("base"), "shard")
    tasks = max(1, min(manifest.count(), 10_000))
    return places.repartition(tasks, "shard").select("path", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_ids(write_ids(docs, tokenizer, end, folder), folder)
