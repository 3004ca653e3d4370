"""Byte-level BPE encoding and decoding.

Pre-tokenisation is the array scan of ``pretokens``; every piece is merged once by its ranks and kept.  The offsets of
the pieces, in the text and in the ids, are retained, and ids are decoded piece by piece through them.  Texts are handled in slices, whole texts
never cut.  Null counts as empty; an empty text has no ids and decodes to nothing.  Repeated rows give
repeated results, and an empty table an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import kept_in, output, text_slices, texts_of, utf8, worker_store
from peerbench.llm.pretokens import Splitter

RANKS = "byte_bpe_multi_50k.tiktoken"
# Pieces kept by a worker; beyond this the store is emptied and filled anew, so results do not depend on it.
KEPT_PIECES = 500_000
# Longer pieces are merged with a heap instead of repeated passes.
SHORT_PIECE = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_short(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """Merge the lowest-ranked neighbours, leftmost first, until none is in ``ranks``."""
    none, rank_of = len(ranks), ranks.get
    waiting = [rank_of(a + b, none) for a, b in pairwise(parts)]
    while waiting and (lowest := min(waiting)) != none:
        place = waiting.index(lowest)
        parts[place] += parts.pop(place + 1)
        del waiting[place]
        if place:
            waiting[place - 1] = rank_of(parts[place - 1] + parts[place], none)
        if place < len(waiting):
            waiting[place] = rank_of(parts[place] + parts[place + 1], none)
    return parts


def merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """As ``merge_short``, in n log n: a heap of candidate pairs over a linked list of parts."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(ranks[a + b], i, a + b) for i, (a, b) in enumerate(pairwise(parts)) if a + b in ranks]
    heapq.heapify(waiting)
    while waiting:
        _, left, merged = heapq.heappop(waiting)
        right = after[left]
        if parts[left] is None or right >= n or parts[left] + parts[right] != merged:
            continue
        parts[left], parts[right] = merged, None
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        for a, b in ((before[left], left), (left, after[left])):
            if a >= 0 and b < n and (pair := parts[a] + parts[b]) in ranks:
                heapq.heappush(waiting, (ranks[pair], a, pair))
    return [part for part in parts if part is not None]


class Pieces(dict):
    """piece -> ids; unseen pieces are merged when asked for."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        if raw in self.ranks:
            ids = (self.ranks[raw],)
        else:
            merge = merge_short if len(raw) <= SHORT_PIECE else merge_long
            parts = merge([raw[i : i + 1] for i in range(len(raw))], self.ranks)
            ids = tuple(self.ranks[part] for part in parts)
        self[piece] = ids
        return ids


class Spelled(dict):
    """ids of a piece -> its bytes."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.bytes_of = bytes_of

    def __missing__(self, ids: tuple[int, ...]) -> bytes:
        self[ids] = found = b"".join(map(self.bytes_of.__getitem__, ids))
        return found


class Codec:
    """Encodes and decodes with one rank file."""

    def __init__(self, path: str) -> None:
        ranks = read_ranks(path)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.written = {rank: str(rank) for rank in self.bytes_of}
        self.known = Pieces(ranks)
        self.spelled = Spelled(self.bytes_of)
        self.splitter = Splitter()

    def encode(self, texts: list[str]) -> Iterator[tuple[list[str], list[int], list[int]]]:
        """Pieces and ids of every text, and where in the ids each piece begins, with their number at the end."""
        for pieces in self.splitter.pieces(texts):
            for store in (self.known, self.spelled):
                if len(store) > KEPT_PIECES:
                    store.clear()
            found = list(map(self.known.__getitem__, pieces))
            yield pieces, list(chain.from_iterable(found)), list(accumulate(map(len, found), initial=0))

    def decode(self, ids: list[int], starts: list[int]) -> bytes:
        """The bytes of the pieces that begin at ``starts``."""
        return b"".join([self.spelled[tuple(ids[a:b])] for a, b in pairwise(starts)])

    def offsets(self, pieces: list[str], starts: list[int]) -> list[tuple[int, int, int]]:
        """First id, start and end (code points, end exclusive) of every piece."""
        ends = list(accumulate(map(len, pieces), initial=0))
        return list(zip(starts, ends, ends[1:]))


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    with_offsets: bool = False,
) -> DataFrame:
    """``id_col``, ids (array), decoded (binary), and with ``with_offsets`` also the pieces' offsets."""
    path = path or public_tokenizers.path(RANKS)
    store = worker_store(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_in(store, lambda: Codec(path))
        for batch in text_slices(batches):
            encoded = list(codec.encode(texts_of(batch)))
            columns = {
                "ids": pa.array([ids for _, ids, _ in encoded], pa.list_(pa.int32())),
                "decoded": pa.array([codec.decode(ids, starts) for _, ids, starts in encoded], pa.binary()),
            }
            if with_offsets:
                columns["offsets"] = pa.array(
                    [[dict(zip(("id", "start", "end"), x)) for x in codec.offsets(p, s)] for p, _, s in encoded],
                    pa.list_(pa.struct([(k, pa.int32()) for k in ("id", "start", "end")])),
                )
            yield output(batch, ["_id"], **columns)

    source = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, ids array<int>, decoded binary"
    schema += ", offsets array<struct<id:int,start:int,end:int>>" * with_offsets
    return source.mapInArrow(encode, schema).withColumnRenamed("_id", id_col)


def encode_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """``id_col``, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256.

    The same encoding and decoding as ``encode_documents``; only the digests leave the worker.
    """
    path = path or public_tokenizers.path(RANKS)
    store = worker_store(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept_in(store, lambda: Codec(path))
        for batch in text_slices(batches):
            counts, of_ids, of_bytes = [], [], []
            for _, ids, starts in codec.encode(texts_of(batch)):
                counts.append(len(ids))
                decimal = ",".join(map(codec.written.__getitem__, ids))
                of_ids.append(hashlib.sha256(decimal.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(codec.decode(ids, starts)).hexdigest())
            yield output(
                batch,
                ["_id"],
                n_tokens=pa.array(counts, pa.int64()),
                ids_sha256=pa.array(of_ids, pa.string()),
                decoded_sha256=pa.array(of_bytes, pa.string()),
            )

    source = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(digest, schema).withColumnRenamed("_id", id_col)
