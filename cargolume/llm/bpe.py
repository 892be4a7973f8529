"""Byte-level BPE: texts to token ids and back, by a rank file.

The pieces that a pattern cuts from a text are encoded separately. The distinct pieces of a batch are sorted into
length buckets and laid out as padded matrices of byte tokens. Every round, each row merges its leftmost pair of
minimum rank (ranks come from a hashed pair table), is compacted by one column, and leaves the matrix when no pair
has a rank. All rows of a matrix shrink together, so a bucket of width L ends after at most L - 1 rounds. A piece
longer than `LONGEST` bytes is merged on a heap instead, which gives the same ids in n log n.

Defined results: a null or empty text has no tokens and decodes to no bytes; ids of special tokens are never made;
rows are encoded one by one, also those of equal doc_id; a very long text is encoded part by part, cut between pieces;
an empty table gives no rows; decoding fails on ids that are not in the vocabulary.
"""

import base64
import heapq
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import query, table, text_slices

NONE = np.int32(2**31 - 1)
LONGEST = 256
WIDTHS = [*range(2, 17), 20, 24, 32, 48, 64, 96, 128, 192, LONGEST]
BUCKET = [min(w for w in WIDTHS if w >= n) for n in range(LONGEST + 1)]  # by length
CACHED = 24 << 20        # bytes of pieces and ids that a task keeps
ENTRY = 180              # bytes that an entry takes besides them
CHUNK = 2_000_000        # characters whose pieces are encoded together


class PairTable:
    """(left id, right id) -> id of the merged token; open addressing, looked up by whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.bits = max(4, (2 * len(found)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter(found, np.int64, len(found))
        values = np.fromiter(found.values(), np.int32, len(found))
        slot = self.slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def slots(self, keys):
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left, right):
        """Ranks of the pairs, NONE where they don't merge or a side is padding (-1)."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(keys.shape, NONE, np.int32)
        at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self.slots(keys[at])
        while len(at):
            there = self.keys[slot]
            hit = there == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (there != -1)
            at, slot = at[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.cache: dict[str, bytes] = {}  # ids as packed 32-bit numbers
        self.held = 0

    def encode_bytes(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = (whole,)
            elif len(p) > LONGEST:
                out[i] = self.merge_long(p)
            else:
                buckets.setdefault(BUCKET[len(p)], []).append(i)
        for width, members in buckets.items():
            for k in range(0, len(members), 20_000):
                rows = members[k:k + 20_000]
                for i, ids in zip(rows, self.merge_matrix([pieces[i] for i in rows], width)):
                    out[i] = ids
        return out

    def merge_matrix(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        ids = np.where(np.arange(width) < length[:, None], self.single[raw], -1)
        ranks = self.pairs.look_up(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(pieces))
        out: list = [None] * len(pieces)
        while True:
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)  # the leftmost minimum
            low = np.take_along_axis(ranks, best[:, None], 1)[:, 0] if ranks.shape[1] else np.full(len(row), NONE)
            done = low == NONE
            for r, got in zip(row[done].tolist(), ids[done].tolist()):
                out[r] = tuple(got)
            if done.all():
                return [ids[:n] for ids, n in zip(out, length.tolist())]
            on = ~done
            ids, ranks, row, best, low = ids[on], ranks[on], row[on], best[on, None], low[on]
            length[row] -= 1
            np.put_along_axis(ids, best, low[:, None], 1)
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > best), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= best), 1)
            for shift in (-1, 0):  # the pairs that the merged token is now part of
                at = best[:, 0] + shift
                r = np.flatnonzero((at >= 0) & (at < ranks.shape[1]))
                ranks[r, at[r]] = self.pairs.look_up(ids[r, at[r]], ids[r, at[r] + 1])

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same merges on a linked list, with pairs in a heap by (rank, position)."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.look_up(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != NONE).tolist()]
        heapq.heapify(heap)
        merged = {}

        def push(i, j):
            key = (ids[i], ids[j])
            if key not in merged:
                merged[key] = self.ranks.get(self.tokens[key[0]] + self.tokens[key[1]])
            if merged[key] is not None:
                heapq.heappush(heap, (merged[key], i, *key))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return tuple(x for x in ids if x >= 0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out, chunk, held = [], [], 0
        for t in texts:
            if len(t) > CHUNK:  # pieces of a very long text are taken part by part
                pieces = (m.group() for m in self.pattern.finditer(t))
                parts = iter(lambda: list(islice(pieces, CHUNK // 8)), [])
                out += self._encode(chunk)
                chunk, held = [], 0
                out.append(np.concatenate([self._encode([part])[0] for part in parts]))
                continue
            chunk.append(self.pattern.findall(t))
            held += len(t)
            if held > CHUNK:
                out += self._encode(chunk)
                chunk, held = [], 0
        return out + self._encode(chunk)

    def _encode(self, pieces_of: list[list[str]]) -> list[np.ndarray]:
        new = list(set().union(*pieces_of).difference(self.cache))
        for piece, ids in zip(new, self.encode_bytes([p.encode() for p in new])):
            self.cache[piece] = array("i", ids).tobytes()
            self.held += ENTRY + len(piece) + 4 * len(ids)
        get = self.cache.__getitem__
        out = [np.frombuffer(b"".join(map(get, pieces)), np.int32) for pieces in pieces_of]
        for piece in (p for p in new if len(p) > LONGEST):
            self.held -= ENTRY + len(piece) + len(self.cache.pop(piece))
        if self.held > CACHED:
            self.forget()
        return out

    def forget(self) -> None:
        self.cache, self.held = {}, 0

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and `ids`, the token ids of the whole text."""

    def run(batches):
        use = codec(path, pattern)
        for batch in batches:
            for keys, texts in text_slices(batch):
                ids = use.encode(texts)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, pa.array(values))], ["doc_id", "ids"])
        use.forget()  # the worker goes on to other tasks

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and `decoded`, the bytes that the ids stand for."""

    def run(batches):
        use = codec(path, pattern)
        for batch in batches:
            for k in range(0, len(batch), 200):
                part = batch.slice(k, 200)
                raw = [use.decode(ids or ()) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"])
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(tokens: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded bytes, and the columns asked for."""
    return tokens.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return digests(decode(encode(docs, path, pattern), path, pattern))


@query("op4_byte_bpe")
def op4_byte_bpe(spark, folder):
    return round_trip(table(spark, folder, "documents", "doc_id", "text"))
