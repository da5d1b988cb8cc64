"""Token counts without tokens: Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each place;
dynamic programming carries the best score to that place and its number of
pieces, nothing else. Ties and unknown characters follow the ``tokenizers``
library's unigram model exactly: a later candidate must score strictly more,
candidates come by ascending start, a character without a piece of its own
costs the lowest score less 10 and becomes its UTF-8 bytes' pieces.

The text is cut as the library's metaspace rule cuts it: spaces become U+2581,
one is put in front, and each U+2581 opens a word. A word's count is worked out
once per worker (up to ``MEMO`` words are remembered).

Defined results: a null text is empty and an empty text has no pieces; rows with
equal ids each get a result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, text_or_empty

MEMO = 400_000
PENALTY = 10.0  # fixed value of the library's unigram model
SPACE = "\u2581"


def unigram_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces of a public model file by rank, with log-probabilities by Zipf's law (the file holds ranks only)."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return [(pieces.id_to_piece(i), -math.log(i + 1) - total) for i in range(len(pieces))]


class Counter(dict):
    """word -> (pieces, score) of its best segmentation."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        self.single = {p: s for p, s in vocabulary if len(p) == 1}
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - PENALTY

    def count(self, word: str) -> tuple[int, float]:
        n = len(word)
        best, pieces = [None] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        found = self.automaton.iter(word)
        end, match = next(found, (n, None))
        for i in range(n):
            score, count = None, 0
            while end == i:  # longest first: ascending starts
                size, piece_score = match
                start = i + 1 - size
                candidate = piece_score + best[start]
                if score is None or candidate > score:
                    score, count = candidate, pieces[start] + 1
                end, match = next(found, (n, None))
            if word[i] not in self.single:
                candidate = self.unknown + best[i]
                if score is None or candidate > score:
                    score, count = candidate, pieces[i] + len(word[i].encode("utf-8", "surrogatepass"))
            best[i + 1], pieces[i + 1] = score, count
        return pieces[n], best[n]

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.count(word)
        if len(self) < MEMO and len(word) <= 64:
            self[word] = found
        return found

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and score of a whole text."""
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        text = text if text.startswith(SPACE) else SPACE + text
        found = [self[SPACE + w] for w in text.split(SPACE)[1:]]
        return sum([f[0] for f in found]), math.fsum([f[1] for f in found])


def counter(model_file: str) -> Counter:
    """The worker's automaton for a vocabulary file."""
    return held(("unigrams", model_file), lambda: Counter(unigram_vocabulary(model_file)))


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, log_score (natural logarithm of the best segmentation)."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = rows.select("id").schema.add("n_tokens", "long").add("log_score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(model_file)
        for batch in batches:
            out = [words.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in out], pa.int64()),
                                              pa.array([r[1] for r in out], pa.float64())],
                                             names=["id", "n_tokens", "log_score"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
