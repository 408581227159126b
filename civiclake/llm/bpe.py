"""BPE encoding and decoding with a queue of merge ranks over a doubly linked list of symbols.

Per piece, all neighbouring symbols that form a merge enter a heap by (rank, position). The smallest is
taken; an entry whose symbols have meanwhile changed is stale and skipped. A merge joins the right symbol
to the left one in the linked list and queues the two new neighbourhoods. Decoding concatenates the
vocabulary's strings, separated by a blank because the tokenizer's file declares no decoder.

Contract of :func:`encode`: one row per input row, repeated rows included, in no order. A null text is an
empty one: no ids, an empty decoded text. Texts are processed whole; columns of the input other than the
id and text are ignored, so clashing names cannot occur. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from civiclake.llm.common import blocks, small_batches, table
from civiclake.llm.pieces import Memo, pieces, specials


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Bpe:
    """Encoder and decoder of one tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.ranks: dict[int, int] = {}  # of a pair of ids
        self.merged: list[int] = []  # id that a merge makes, by rank
        for left, right in map(tuple, model["merges"]):
            self.ranks[self.ids[left] << 20 | self.ids[right]] = len(self.merged)
            self.merged.append(self.ids[left + right])
        self.special, special_ids = specials(path)
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in special_ids.items()}
        self.special_ids = special_ids
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.inner = [self.ids[letters[b]] for b in range(256)]
        self.last = [self.ids[letters[b] + self.end] for b in range(256)]

    def merge(self, symbols: list[int]) -> list[int]:
        """Symbols after all merges, lowest rank first, leftmost first among equals."""
        n, ranks, merged = len(symbols), self.ranks, self.merged
        if n == 1:
            return symbols
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [rank * n + k for k in range(n - 1) if (rank := ranks.get(symbols[k] << 20 | symbols[k + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, k = divmod(heapq.heappop(queue), n)
            other = after[k]
            if other < 0 or symbols[k] < 0 or ranks.get(symbols[k] << 20 | symbols[other]) != rank:
                continue  # stale: one of the symbols has been merged away or has changed
            joined = symbols[k] = merged[rank]
            symbols[other] = -1
            following = after[k] = after[other]
            if following >= 0:
                before[following] = k
                if (rank := ranks.get(joined << 20 | symbols[following])) is not None:
                    heapq.heappush(queue, rank * n + k)
            if (previous := before[k]) >= 0 and (rank := ranks.get(symbols[previous] << 20 | joined)) is not None:
                heapq.heappush(queue, rank * n + previous)
        return [s for s in symbols if s >= 0]

    def encode_piece(self, piece: str) -> list[int]:
        if piece in self.special_ids:
            return [self.special_ids[piece]]
        raw = piece.encode()
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        return self.merge(symbols)

    def encode(self, text: str) -> list[int]:
        return [i for piece in pieces(text, self.special) for i in self.encode_piece(piece)]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


@cache
def _worker(path: str) -> tuple[Bpe, Memo, Memo]:
    """A worker's encoder with the ids of the pieces it has met, as decimal texts, and strings by decimal id."""
    bpe = Bpe(path)
    return bpe, Memo(lambda piece: " ".join(map(str, bpe.encode_piece(piece)))), Memo(lambda shown: bpe.strings[int(shown)])


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", emit: str = "digests") -> DataFrame:
    """Ids and round trip of every text.

    ``emit="ids"`` returns (doc_id, ids array<int>, decoded string); ``emit="digests"`` returns (doc_id,
    n_tokens long, ids_sha256, decoded_sha256), where ids are hashed as decimals joined by one blank.
    """
    small_batches(docs.sparkSession)
    schema = ("doc_id long, ids array<int>, decoded string" if emit == "ids" else
              "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shown, strings = _worker(path)
        for batch in blocks(batches):
            rows = []
            for value in pc.fill_null(batch.column("text"), "").to_pylist():
                ids = " ".join(map(shown.__getitem__, pieces(value, bpe.special)))
                split = ids.split(" ") if ids else []
                decoded = " ".join(map(strings.__getitem__, split))
                rows.append((list(map(int, split)), decoded) if emit == "ids" else (len(split), _digest(ids), _digest(decoded)))
            first = pa.int32() if emit != "ids" else pa.list_(pa.int32())
            kinds = [first, pa.string()] if emit == "ids" else [pa.int64(), pa.string(), pa.string()]
            names = ["ids", "decoded"] if emit == "ids" else ["n_tokens", "ids_sha256", "decoded_sha256"]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], ["doc_id", *names])

    return docs.selectExpr(f"cast(`{doc_id}` as bigint) doc_id", f"cast(`{text}` as string) text").mapInArrow(run, schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of all documents."""
    return encode(table(spark, sf_dir, "documents"), vocabulary())
