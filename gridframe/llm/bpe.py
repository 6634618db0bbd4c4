"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is itself in the vocabulary is resolved by a minimal perfect
hash over the vocabulary. The rest are merged by a heap over linked bytes. The
vocabulary is read on the driver and sent once to each executor; its size is
fixed. Each task keeps a bounded cache of pre-tokens it has already resolved.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.kept import kept

# Pre-tokens a worker remembers in each of two generations; results do not depend on it.
CACHE_TOKENS = 200_000
# Longer pre-tokens are rare and large, so they are not remembered.
CACHE_LENGTH = 64
# Texts are matched in runs of this many pre-tokens, so a very long text needs no list of all of them.
RUN_TOKENS = 1_000_000
# Bits of an id in the number that stands for a pair; vocabularies are far smaller.
PAIR_BITS = 24
# Texts whose results are handed back at a time.
SLICE = 200
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash: as many slots as keys, each key in a slot of its own.

    Keys are grouped by their hash. A group of several keys gets the first seed
    that sends all of them to free slots, largest groups first; a group of one
    key then names a free slot outright (a negative seed). A stored key is
    compared on lookup, so a string outside the set is never taken for a key.
    """

    def __init__(self, keys: list[bytes]) -> None:
        size = len(keys)
        groups: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
        for number, value in enumerate(hashes):
            groups.setdefault(value % size, []).append(number)
        self.seeds = [0] * size
        self.slots = [-1] * size
        self.keys = keys
        ordered = sorted(groups.items(), key=lambda group: (-len(group[1]), group[0]))
        for group, members in ordered:
            if len(members) == 1:
                break
            seed = 1
            while True:
                places = [self._place(hashes[number], seed, size) for number in members]
                if len(set(places)) == len(places) and all(self.slots[place] < 0 for place in places):
                    break
                seed += 1
            self.seeds[group] = seed
            for place, number in zip(places, members):
                self.slots[place] = number
        free = (place for place in range(size) if self.slots[place] < 0)
        for group, members in ordered:
            if len(members) == 1:
                place = next(free)
                self.seeds[group] = -place - 1
                self.slots[place] = members[0]

    @staticmethod
    def _place(value: int, seed: int, size: int) -> int:
        mixed = ((value ^ seed) * MULTIPLIER) & MASK
        return ((mixed ^ (mixed >> 29)) * MULTIPLIER & MASK) % size

    def get(self, key: bytes) -> int | None:
        """Number of the key, or None if it is not in the set."""
        value = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[value % len(self.seeds)]
        number = self.slots[-seed - 1 if seed < 0 else self._place(value, seed, len(self.slots))]
        return number if self.keys[number] == key else None


def mergeable_pairs(tokens: list[bytes]) -> dict[int, int]:
    """Id of the token that two tokens join to, by both their ids in one number."""
    number = {token: i for i, token in enumerate(tokens)}
    joined = {}
    for i, token in enumerate(tokens):
        for cut in range(1, len(token)):
            left, right = number.get(token[:cut]), number.get(token[cut:])
            if left is not None and right is not None:
                joined[left << PAIR_BITS | right] = i
    return joined


def merge_bytes(piece: bytes, single: list[int], joined: dict[int, int]) -> list[int]:
    """Ids of a piece outside the vocabulary: the pair of least rank, leftmost first, merges until none is left.

    Parts are a doubly linked list over byte positions. The heap holds candidate
    pairs, each as one number made of rank, position and the ids it would join;
    one that a merge has outdated is skipped when it comes up. The work is
    n log n for any length.
    """
    size = len(piece)
    ids = [single[byte] for byte in piece]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    bits = size.bit_length()
    place_mask, lookup = (1 << bits) - 1, joined.get
    heap = []
    for left in range(size - 1):
        rank = lookup(ids[left] << PAIR_BITS | ids[left + 1])
        if rank is not None:
            heap.append(rank << bits | left)
    heapq.heapify(heap)
    while heap:
        first = heapq.heappop(heap)
        rank, left = first >> bits, first & place_mask
        right = after[left]
        if ids[left] < 0 or right >= size or lookup(ids[left] << PAIR_BITS | ids[right]) != rank:
            continue
        ids[left], ids[right] = rank, -1
        after[left] = stop = after[right]
        if stop < size:
            before[stop] = left
            rank = lookup(ids[left] << PAIR_BITS | ids[stop])
            if rank is not None:
                heapq.heappush(heap, rank << bits | left)
        start = before[left]
        if start >= 0:
            rank = lookup(ids[start] << PAIR_BITS | ids[left])
            if rank is not None:
                heapq.heappush(heap, rank << bits | start)
    return [i for i in ids if i >= 0]


class Encoder(dict):
    """Packed little-endian ids by pre-token; a pre-token not yet seen is resolved and remembered."""

    def __init__(self, table: PerfectHash, pattern: str) -> None:
        super().__init__()
        self.table = table
        self.older: dict[str, bytes] = {}
        self.pattern = regex.compile(pattern)
        self.single = [table.get(bytes([byte])) for byte in range(256)]
        self.joined = mergeable_pairs(table.keys)

    def __missing__(self, token: str) -> bytes:
        packed = self.older.get(token)
        if packed is None:
            raw = token.encode("utf-8", "replace")
            number = self.table.get(raw)
            ids = [number] if number is not None else merge_bytes(raw, self.single, self.joined)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= CACHE_LENGTH:
            if len(self) >= CACHE_TOKENS:
                # What was used since the last turn is kept for one more.
                self.older = dict(self)
                self.clear()
            self[token] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if len(text) <= RUN_TOKENS:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        matches, runs = self.pattern.finditer(text), []
        while run := b"".join(self[match.group()] for match in islice(matches, RUN_TOKENS)):
            runs.append(run)
        return b"".join(runs)


def slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for low in range(0, len(batch), SLICE):
            yield batch.slice(low, SLICE)


@lru_cache(maxsize=4)
def perfect_hash(path: str) -> PerfectHash:
    return PerfectHash(read_ranks(path))


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with column ``out``: the token ids of ``text`` as binary, 4 little-endian bytes each.

    Every match of ``pattern`` is encoded by itself, without special tokens;
    characters that no match covers give no ids. Null and empty texts give empty
    ids. Texts of any length are encoded whole. Other columns, repeated rows and
    empty tables pass through; a column already named ``out`` is replaced.
    ``ranks`` is the path of the vocabulary on the driver.
    """
    sent = df.sparkSession.sparkContext.broadcast(perfect_hash(ranks))

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = kept(("bpe", ranks, pattern), lambda: Encoder(sent.value, pattern))
        for part in slices(batches):
            yield pa.array([encoder.encode(value.as_py() or "") for value in part], pa.binary())

    return df.withColumn(out, F.arrow_udf(encode_batches, T.BinaryType())(F.col(text)))


def decode_one(packed: bytes | None, tokens: list[bytes]) -> bytes | None:
    """Bytes of packed ids as ``decode`` gives them."""
    if packed is None or len(packed) % 4:
        return None
    try:
        return b"".join(map(tokens.__getitem__, memoryview(packed).cast("I"))) if packed else b""
    except IndexError:
        return None


def encode_decode(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The columns of ``df`` but ``text``, then ``ids`` and ``out`` as ``decode(encode(df))`` gives them.

    Both run in one pass over the rows, so a task holds one Python worker and
    one copy of the vocabulary rather than one of each for either step.
    """
    sent = df.sparkSession.sparkContext.broadcast(perfect_hash(ranks))
    rest = [name for name in df.columns if name not in (text, ids, out)]
    schema = T.StructType([*(df.schema[name] for name in rest), T.StructField(ids, T.BinaryType()), T.StructField(out, T.BinaryType())])

    def coded_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("bpe", ranks, pattern), lambda: Encoder(sent.value, pattern))
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                packed = [encoder.encode(value or "") for value in part.column(text).to_pylist()]
                decoded = [decode_one(value, encoder.table.keys) for value in packed]
                columns = [part.column(name) for name in rest]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())], schema=pa.schema([*(part.schema.field(name) for name in rest), pa.field(ids, pa.binary()), pa.field(out, pa.binary())]))

    return df.mapInArrow(coded_batches, schema)


def token_count(ids: Column) -> Column:
    """Number of ids in packed ids."""
    return F.floor(F.octet_length(ids) / 4).cast("bigint")


def decode(df: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with column ``out``: the bytes that packed ``ids`` stand for.

    Null ids, a length that is not a multiple of 4 and ids outside the
    vocabulary give null; empty ids give empty bytes. Bytes need not be valid
    UTF-8 for arbitrary ids. A column already named ``out`` is replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(perfect_hash(ranks))

    def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = sent.value.keys
        for part in slices(batches):
            yield pa.array([decode_one(value.as_py(), tokens) for value in part], pa.binary())

    return df.withColumn(out, F.arrow_udf(decode_batches, T.BinaryType())(F.col(ids)))

