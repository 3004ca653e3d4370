"""Token counts by rank-synchronous merging.

The pieces of a slice of texts that were not met before are held as one flat symbol array with the piece each
symbol belongs to.  In every round each piece merges all occurrences of its own lowest-ranked pair at the same
time; pieces without a known pair leave the arrays, and what is left of a piece is its count.  A special token
inside a text counts as one token and separates the text before and behind it, as the library does by default.
Null and empty texts have no tokens; repeated rows give repeated results, an empty table an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import kept_in, output, text_slices, texts_of, utf8, worker_store
from peerbench.llm.pretokens import Splitter

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
# Pieces kept by a worker; beyond this the store is emptied and filled anew.
KEPT_PIECES = 500_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Fixed rule: printable Latin-1 characters stand for themselves, the rest for U+0100 onwards in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The merge table of a vocabulary file as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.special = [t["content"] for t in content["added_tokens"] if t["special"]]
        self.size = max(vocabulary.values()) + 1
        self.first = np.empty(256, dtype=np.int64)
        for char, byte in byte_symbols().items():
            self.first[byte] = vocabulary[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.merged, self.ranks = keys[order], merged[order], order
        self.none = len(keys)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; rank ``none`` where there is no such merge."""
        wanted = left * self.size + right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.ranks[place], self.none), self.merged[place]


def surviving_symbols(words: list[bytes], merges: Merges) -> np.ndarray:
    """How many symbols are left of each word (not empty) when nothing can be merged any more."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = lengths.copy()
    word = np.repeat(np.arange(len(words)), lengths)
    symbol = merges.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    while len(symbol) > 1:
        rank = np.full(len(symbol), merges.none, dtype=np.int64)
        result = np.zeros(len(symbol), dtype=np.int64)
        pairs = np.flatnonzero(word[:-1] == word[1:])
        rank[pairs], result[pairs] = merges.look_up(symbol[pairs], symbol[pairs + 1])
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sizes = np.diff(np.append(starts, len(word)))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        hits = np.flatnonzero((rank == lowest) & (lowest < merges.none))
        # In a run of overlapping occurrences every second one is merged, from the left.
        fresh = np.append(True, np.diff(hits) != 1) if hits.size else np.zeros(0, dtype=bool)
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0)) if hits.size else hits
        hits = hits[(np.arange(len(hits)) - run_start) % 2 == 0]
        symbol[hits] = result[hits]
        np.subtract.at(counts, word[hits], 1)
        # Words without a merge are done.
        stays = lowest < merges.none
        stays[hits + 1] = False
        symbol, word = symbol[stays], word[stays]
    return counts


class Counter:
    """Counts the tokens of texts; a worker makes one and uses it for all its batches."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        self.splitter = Splitter()
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        parts, owner, counts = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            stretches = [text]
            for special in self.merges.special:
                stretches = [x for s in stretches for x in s.split(special)]
            counts[i] = len(stretches) - 1
            parts += stretches
            owner += [i] * len(stretches)
        pieces = self.splitter.pieces(parts)
        unseen = list({p for found in pieces for p in found} - self.known.keys())
        if unseen:
            numbers = surviving_symbols([p.encode() for p in unseen], self.merges)
            self.known.update(zip(unseen, numbers.tolist()))
        for i, found in zip(owner, pieces):
            counts[i] += sum(map(self.known.__getitem__, found))
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        return counts


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """``id_col``, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens)."""
    path = path or public_tokenizers.path(VOCABULARY)
    store = worker_store(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_in(store, lambda: Counter(path))
        for batch in text_slices(batches):
            yield output(
                batch,
                ["_id", "n_bytes"],
                n_tokens=pa.array(counter.count(texts_of(batch)), pa.int64()),
            )

    source = docs.select(
        F.col(id_col).alias("_id"),
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n_bytes"),
        utf8(F.col(text_col)).alias("text"),
    )
    kind = source.schema["_id"].dataType.simpleString()
    counted = source.mapInArrow(count, f"_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
