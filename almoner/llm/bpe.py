"""Byte-level BPE as a lazily determinised finite-state transducer.

Encoding. A sequence of tokens is the encoding of its bytes exactly if every two
neighbours are the encoding of theirs, and every prefix of a text has exactly one
such sequence. So reading a byte adds one last token per prefix: the one token
that ends there and goes with the last token of the prefix before it. A state is
the last token that is already certain and the bytes after it; a token becomes
certain, and is emitted, as soon as all places where a longer token may still
start agree on it, so the lookahead is bounded by the longest token. States and
transitions are built when a text first asks for them and kept in a table that
is emptied when it is full. Texts are cut into chunks (``chunks``), and the transducer
sees each distinct chunk of a few megabytes of text once. In ``transcoded`` a worker
keeps its tables from task to task; in ``encoded``, a stage of pipelines, the tables are
smaller and go with the task, since an idle worker would keep them.

Decoding. Tokens may end inside a character. The decoder is a state machine over
UTF-8 whose state is the begun character; it takes the bytes of a block of tokens at a
time and gives U+FFFD for bytes that aren't UTF-8.

Missing texts count as empty ones and have no ids. Texts are encoded whole and
rows independently: null, repeated or tied ids make no difference, other columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from almoner.llm.chunks import Recent, cut, gathered, give_back, held, slices
from almoner.llm.common import fresh, ship, text_of

STATES, PAIRS, CHUNKS = 400_000, 400_000, 150_000
#: What share of these a worker may take that has other stages' work to do, too.
SMALL = 0.6
#: Ids decoded at a time.
BLOCK = 1 << 16


class Transducer:
    """Encodes single pieces (matches of the splitting pattern)."""

    def __init__(self, ranks: dict[bytes, int], most: int = STATES, most_pairs: int = PAIRS):
        self.most, self.most_pairs = most, most_pairs
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.prefixes = {token[:k] for token in ranks for k in range(len(token))}
        self.pairs: dict[int, bool] = {}
        self.reached: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # what isn't certain yet: bytes, and the last token of each of their prefixes
        self.number: dict[tuple, int] = {(b"", (-1,)): 0}
        self.states: list[tuple[bytes, tuple[int | None, ...]]] = [(b"", (-1,))]
        # by state and byte: the next state, or the complement of a step's place
        self.moves: dict[int, int] = {}
        self.steps: list[tuple[int, tuple[int, ...]]] = []
        self.ends: dict[int, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """By definition: merge the neighbours of lowest rank until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)
            )
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: the start of a piece)."""
        if token not in self.reached:
            self.reached[token] = self.merged(self.bytes_of[token]) == [token]
        if before < 0 or not self.reached[token]:
            return self.reached[token]
        pair = before << 32 | token
        if pair not in self.pairs:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            self.pairs[pair] = self.merged(self.bytes_of[before] + self.bytes_of[token]) == [before, token]
        return self.pairs[pair]

    def last_token(self, tail: bytes, last: tuple[int | None, ...]) -> int | None:
        """The last token of ``tail``, given those of its prefixes.

        None if it starts before ``tail``: then no later token starts at its end,
        or what stands before ``tail`` weren't certain.
        """
        ranks = self.ranks
        for begin, before in enumerate(last):
            if before is not None and (token := ranks.get(tail[begin:])) is not None and self.fits(before, token):
                return token
        return None

    def path(self, last: tuple[int | None, ...], at: int) -> tuple[int, ...]:
        """The tokens before place ``at`` of what isn't certain."""
        tokens = []
        while at:
            tokens.append(last[at])
            at -= self.sizes[last[at]]
        return tuple(reversed(tokens))

    def move(self, state: int, byte: int) -> int:
        tail, last = self.states[state]
        tail += bytes((byte,))
        last, sizes, prefixes = (*last, self.last_token(tail, last)), self.sizes, self.prefixes
        cut = len(tail)
        for live in range(len(tail) - 1, -1, -1):  # back to the place all may go on from
            if tail[live:] in prefixes:
                while live != cut:
                    if live > cut:
                        live -= sizes[last[live]]
                    else:
                        cut -= sizes[last[cut]]
        emitted = ()
        if cut:
            emitted = self.path(last, cut)
            kept = enumerate(last[cut + 1 :], cut + 1)
            tail = tail[cut:]
            last = (last[cut], *(t if t is not None and at - sizes[t] >= cut else None for at, t in kept))
        if tail and tail not in prefixes:  # no token starts here any more
            last = (None, *last[1:])
        key = (tail, last)
        after = self.number.setdefault(key, len(self.states))
        if after == len(self.states):
            self.states.append(key)
        if emitted:
            self.steps.append((after, emitted))
            after = ~(len(self.steps) - 1)
        self.moves[state << 8 | byte] = after
        return after

    def end(self, state: int) -> tuple[int, ...]:
        tail, last = self.states[state]
        self.ends[state] = found = self.path(last, len(tail))
        return found

    def stream(self, piece: Iterable[int]) -> Iterator[int]:
        """Tokens of a piece, each as soon as it is certain."""
        state, moves = 0, self.moves
        for byte in piece:
            after = moves.get(state << 8 | byte)
            if after is None:
                after = self.move(state, byte)
            state, emitted = (after, ()) if after >= 0 else self.steps[~after]
            yield from emitted
        yield from self.ends[state] if state in self.ends else self.end(state)

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:  # also tokens that no merge reaches
            return [self.ranks[piece]]
        if len(self.states) > self.most:
            self.reset()
        state, steps, tokens, known = 0, self.steps, [], self.moves.get
        for byte in piece:  # as in stream(), without its cost per token
            after = known(state << 8 | byte)
            if after is None:
                after = self.move(state, byte)
            if after >= 0:
                state = after
            else:
                state, emitted = steps[~after]
                tokens += emitted
        tokens += self.ends[state] if state in self.ends else self.end(state)
        return tokens


class Encoder:
    """Encodes texts: distinct chunks are split by the pattern, each piece goes through
    the transducer; what recent chunks gave is looked up."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, share: float = 1.0):
        self.transducer = Transducer(ranks, int(STATES * share), int(PAIRS * share))
        self.pattern = regex.compile(pattern)
        self.recent = Recent(int(CHUNKS * share))

    def pieces(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            ids += self.transducer.encode(piece.encode("utf-8", "surrogatepass"))
        return ids

    def chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha() or (chunk[0] == 32 and chunk[1:].isalpha()):  # ASCII letters: one piece
            ids = self.transducer.encode(chunk)
        else:
            ids = self.pieces(chunk.decode("utf-8", "surrogatepass"))
        found = array("i", ids).tobytes()
        self.recent.put(chunk, found)
        return found

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of text after text, and where each text's begin, and the last ends."""
        distinct, numbers, ends = cut(texts)
        known = self.recent.look_up(distinct)
        found = [self.chunk(c) if k is None else k for c, k in zip(distinct, known)]
        ids, offsets = gathered(found, np.dtype("i4"), numbers)
        return ids, offsets[np.concatenate([[0], ends])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text]))[0].tolist()


class Decoder:
    """Turns ids into text as they come, a block of bytes at a time."""

    def __init__(self, bytes_of: dict[int, bytes]):
        tokens = [bytes_of.get(i, b"") for i in range(max(bytes_of, default=-1) + 1)]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begins = np.cumsum(self.lengths) - self.lengths

    def stream(self, ids: Iterable[int], block: int = BLOCK) -> Iterator[str]:
        """The text of each block of ids; a character that isn't whole yet comes later."""
        machine, ids = codecs.getincrementaldecoder("utf-8")("replace"), np.asarray(ids, np.int64)
        for at in range(0, len(ids), block):
            part = ids[at : at + block]
            own = self.lengths[part]
            offsets = np.cumsum(own) - own
            yield machine.decode(self.data[np.repeat(self.begins[part] - offsets, own) + np.arange(own.sum())].tobytes())
        if rest := machine.decode(b"", True):
            yield rest

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def coders(path: str, pattern: str) -> tuple[Encoder, Decoder]:
    """A worker's pair; ``path`` is a file on its machine."""

    def made() -> tuple[Encoder, Decoder]:
        encoder = Encoder(read_ranks(path), pattern)
        return encoder, Decoder(encoder.transducer.bytes_of)

    return held(("bpe", path, pattern), made)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with the text's ids, and their number, in place of the text."""
    ship(docs.sparkSession)
    ids, number = fresh(docs, "ids"), fresh(docs, "n_tokens")
    rows = docs.withColumn("text", text_of(docs))
    schema = T.StructType([*(f for f in docs.schema if f.name != "text"), T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(number, T.LongType())])

    def run(batches):
        held("encoding", dict)  # gives up what tasks of another stage have left
        encoder = Encoder(read_ranks(path), pattern, SMALL)
        for batch in batches:
            for part in slices(batch.column("text")):
                rows = batch.slice(part.start, part.stop - part.start)
                found, offsets = encoder.encode_all(rows.column("text"))
                kept = [rows.column(f.name) for f in schema.fields[:-2]]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([*kept, lists, pa.array(np.diff(offsets))], names=schema.names)
        del encoder
        give_back()

    return rows.mapInArrow(run, schema)


def transcoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document its ids and the text decoded from them."""

    def run(batches):
        encoder, decoder = coders(path, pattern)
        for batch in batches:
            for part in slices(batch.column(1)):
                rows = batch.slice(part.start, part.stop - part.start)
                found, offsets = encoder.encode_all(rows.column(1))
                texts = [decoder.decode(found[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    ship(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )
