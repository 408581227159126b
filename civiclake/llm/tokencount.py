"""Token counts under a unigram vocabulary, without building the tokens.

Texts are cut before every blank, as a metaspace pre-tokenizer does: a blank becomes the mark U+2581 that
opens a word, and a text that does not begin with one gets one. For each word an Aho-Corasick automaton
enumerates the vocabulary's matches by their end; a dynamic program carries, for every end, the best score
and its number of pieces. Tie rule of the exact tokenizer: among equal scores the match with the earliest
start stays (a later one must be strictly better). A character that is no piece itself costs the lowest
score minus 10 and counts as its UTF-8 bytes where the vocabulary has byte pieces; without them a run of
such characters counts as one unknown piece.

Contract: one row per input row. A null text counts as empty (no tokens). Word counts are remembered per
worker up to a bound, which changes nothing but speed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from civiclake.llm.bpe import vocabulary
from civiclake.llm.common import blocks, small_batches, table
from civiclake.llm.pieces import Memo

MARK = "▁"
#: By how much an unknown character scores below the vocabulary's lowest score.
UNKNOWN_PENALTY = 10.0


def load_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece vocabulary, in the order of its ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts pieces of words."""

    def __init__(self, vocabulary_pieces: list[tuple[str, float]]):
        self.matches = ahocorasick.Automaton()
        scores: dict[str, float] = {}
        for piece, score in vocabulary_pieces:
            scores[piece] = score  # the last of repeated pieces counts
        for piece, score in scores.items():
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary_pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))

    def word(self, word: str) -> int:
        """Number of pieces of the best segmentation."""
        n = len(word)
        score: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        if self.single.issuperset(word):
            for end, (length, gain) in self.matches.iter(word):
                end += 1
                total = score[end - length] + gain
                if score[end] is None or total > score[end]:
                    score[end], count[end] = total, count[end - length] + 1
            return count[n]
        return self._with_unknown(word, score, count)

    def _with_unknown(self, word: str, score: list[float | None], count: list[int]) -> int:
        ends: dict[int, list[tuple[int, float]]] = {}
        for end, match in self.matches.iter(word):
            ends.setdefault(end + 1, []).append(match)
        loose = [False] * (len(word) + 1)  # whether the best way to an end closes with an unknown character
        for end in range(1, len(word) + 1):
            for length, gain in ends.get(end, ()):
                total = score[end - length] + gain
                if score[end] is None or total > score[end]:
                    score[end], count[end], loose[end] = total, count[end - length] + 1, False
            char = word[end - 1]
            if char not in self.single:
                total = score[end - 1] + self.unknown
                if score[end] is None or total > score[end]:
                    more = len(char.encode("utf-8", "surrogatepass")) if self.bytes else not loose[end - 1]
                    score[end], count[end], loose[end] = total, count[end - 1] + more, True
        return count[len(word)]

    def words(self, text: str) -> list[str]:
        """Words of a text, each with its opening mark."""
        text = text.replace(" ", MARK)
        if not text:
            return []
        return [MARK + word for word in (text[1:] if text[0] == MARK else text).split(MARK)]


@cache
def _worker(path: str) -> tuple[Counter, Memo]:
    counter = Counter(load_pieces(path))
    return counter, Memo(counter.word)


def count_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens long) of every text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = _worker(path)
        for batch in blocks(batches):
            counts = [sum(map(known.__getitem__, counter.words(value))) for value in pc.fill_null(batch.column("text"), "").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.selectExpr(f"cast(`{doc_id}` as bigint) doc_id", f"cast(`{text}` as string) text").mapInArrow(run, "doc_id long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under the public 32,000-piece vocabulary, read as a unigram model."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
