"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The bytes of many pre-tokens lie one behind the other as a linked list of tokens. Adjacent pairs within a
pre-token wait in one bucket per merge rank, which holds their positions. Which buckets hold anything is
kept in a bitmap of two levels, so that find-first-set gives the lowest waiting rank in constant time. A
bucket is worked off from left to right until a merge makes a pair of a lower rank, which then comes first. A
merge changes the ranks of its two neighbours only; entries of pairs that have changed since are skipped
when they surface. Pre-tokens of n bytes together take n log n steps at most, however long one of them is.

Defined cases: a NULL text counts as empty and gives no ids; a NULL id among those to decode gives
no bytes; repeated rows give repeated rows; other columns are neither read nor returned.
"""

import base64
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BITS = 256
BIT = [1 << i for i in range(WORD_BITS)]
CACHED_TOKENS = 300_000  # per Python worker, and as many older ones
CACHED_LENGTH = 48
ROWS = 256


class RankQueue:
    """Positions by rank in buckets, with a bitmap of two levels over the ranks that have one."""

    def __init__(self, ranks: int):
        self.words = [0] * (ranks // WORD_BITS + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket with positions in order, which makes it a heap."""
        self.buckets[rank] = positions
        word = rank // WORD_BITS
        self.words[word] |= BIT[rank % WORD_BITS]
        self.top |= BIT[word]

    def lowest(self) -> int:
        """The lowest rank with a bucket, -1 without any."""
        if not self.top:
            return -1
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        return word * WORD_BITS + (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        del self.buckets[rank]
        word = rank // WORD_BITS
        self.words[word] ^= BIT[rank % WORD_BITS]
        if not self.words[word]:
            self.top ^= BIT[word]


class ByteBPE:
    """A rank file and a splitting pattern; ``encode`` and ``decode`` are inverse to each other."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.split = splitter(pattern)
        self.known: dict[str, bytes] = {}  # ids of the pre-tokens met lately, as 32-bit numbers
        self.older: dict[str, bytes] = {}
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.of_pair = np.full(1 << 16, -1, np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.of_pair[token[0] << 8 | token[1]] = rank

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, none empty, as 32-bit numbers."""
        text = b"".join(pieces)
        size = len(text)
        ends = np.cumsum([len(piece) for piece in pieces])
        codes = np.frombuffer(text, np.uint8).astype(np.int64)
        first = np.full(size, -1, np.int64)
        first[:-1] = self.of_pair[codes[:-1] << 8 | codes[1:]]
        first[ends - 1] = -1
        starts = bytearray(size + 1)  # where no token joins the one before
        starts[0] = 1
        for end in ends.tolist():
            starts[end] = 1
        following, previous = list(range(1, size + 1)), list(range(-1, size))
        waiting, ids = first.tolist(), self.of_byte[codes].tolist()
        queue, rank_of = self.queue, self.ranks.get
        buckets = queue.buckets
        order = np.flatnonzero(first >= 0)
        order = order[np.argsort(first[order], kind="stable")]
        parts = np.flatnonzero(np.diff(first[order], prepend=-1)).tolist()
        order_list = order.tolist()
        for i, j in zip(parts, [*parts[1:], len(order_list)]):
            queue.open(waiting[order_list[i]], order_list[i:j])
        while (rank := queue.lowest()) >= 0:
            bucket = buckets[rank]
            lower = False
            while bucket and not lower:
                i = heappop(bucket)
                if waiting[i] != rank:
                    continue
                taken = following[i]
                end = following[taken]
                following[i] = end
                ids[i], ids[taken] = rank, -1
                waiting[taken] = -1
                new = -1
                if not starts[end]:
                    previous[end] = i
                    new = rank_of(text[i : following[end]], -1)
                    if new >= 0:
                        at = buckets.get(new)
                        if at is None:
                            queue.open(new, [i])
                        else:
                            heappush(at, i)
                        lower = new < rank
                waiting[i] = new
                if not starts[i]:
                    before = previous[i]
                    waiting[before] = new = rank_of(text[before:end], -1)
                    if new >= 0:
                        at = buckets.get(new)
                        if at is None:
                            queue.open(new, [before])
                        else:
                            heappush(at, before)
                        lower = lower or new < rank
            if not bucket:
                queue.close(rank)
        left = np.array(ids, np.int64)
        kept = left >= 0
        stops = (np.cumsum(kept)[ends - 1] * 4).tolist()
        flat = left[kept].astype(np.int32).tobytes()
        return [flat[i:j] for i, j in zip([0, *stops], stops)]

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of the pieces; what is short is kept for the next texts."""
        if len(self.known) > CACHED_TOKENS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = pieces.difference(known)
        for piece in new & older.keys():
            known[piece] = older[piece]
        raws = {piece: piece.encode() for piece in new.difference(older)}
        for piece, raw in raws.items():
            whole = self.ranks.get(raw)
            if whole is not None:
                known[piece] = array("i", [whole]).tobytes()
        several = [piece for piece in raws if piece not in known]
        found = dict(zip(several, self.merge([raws[piece] for piece in several]))) if several else {}
        long = {piece: ids for piece, ids in found.items() if len(piece) > CACHED_LENGTH}
        known.update((piece, ids) for piece, ids in found.items() if piece not in long)
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit numbers."""
        split = [self.split(text) for text in texts]
        long = self.learn({piece for pieces in split for piece in pieces})
        known = self.known
        known.update(long)
        ids = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for piece in long:
            del known[piece]
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern. Texts of the first 256 characters, which are the most, take
    Python's own engine, which is twice as fast but needs the property classes spelled out."""
    spelled = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}{letters('L')}{letters('N')}]")
    for written, means in ((r"\p{L}", letters("L")), (r"\p{N}", letters("N")), (r"\s", SPACE)):
        spelled = spelled.replace(written, f"[{means}]")
    spelled = spelled.replace(r"\S", f"[^{SPACE}]")
    every = regex.compile(pattern).findall
    few = re.compile(spelled).findall if r"\p" not in spelled else every

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return every(text)
        return few(text)

    return split


# White space among the first 256 characters.
SPACE = r"\t-\r \x85\xa0"


def letters(category: str) -> str:
    """Those of the first 256 characters whose category starts so, for a character class."""
    return "".join(chr(c) for c in range(256) if unicodedata.category(chr(c)).startswith(category))


@lru_cache
def loaded(path: str, pattern: str) -> ByteBPE:
    """One per Python worker."""
    return ByteBPE(path, pattern)


SCHEMA = "doc_id long, ids array<int>"


def encoded_rows(bpe: ByteBPE, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) for each (doc_id, text)."""
    for batch in batches:
        # A few rows at a time, since one text may be very long.
        for some in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
            ids = bpe.encode([text.as_py() or "" for text in some.column(1)])
            ends = np.cumsum([0, *map(len, ids)]) // 4
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([some.column(0), lists], ["doc_id", "ids"])


def decoded_rows(bpe: ByteBPE, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, decoded) for each (doc_id, ids)."""
    for batch in batches:
        for some in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
            lists = (ids.values.drop_null() if ids.is_valid else pa.array([], pa.int32()) for ids in some.column(1))
            texts = [bpe.decode(ids.to_numpy().tolist()) for ids in lists]
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row, without special tokens; ``path`` is a rank file on each executor."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(lambda batches: encoded_rows(loaded(path, pattern), batches), SCHEMA)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) where ``decoded`` holds the bytes that the ids stand for."""
    ids = encoded.select("doc_id", "ids")
    return ids.mapInArrow(lambda batches: decoded_rows(loaded(path, pattern), batches), SCHEMA + ", decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode_documents`` of ``encode_documents`` in one Python worker per task: two would each come to hold
    ranks and pre-tokens, since workers change places from task to task."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        return decoded_rows(bpe, encoded_rows(bpe, batches))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(both, SCHEMA + ", decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of its tokens, and digests of its ids and of what they decode to."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return round_trip(docs, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
