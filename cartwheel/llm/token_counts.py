"""Token counts under a unigram vocabulary, by dynamic programming shared
along a trie of distinct pre-tokens.

A task numbers the distinct pre-tokens of the documents it reads and walks
their trie depth first (in sorted order).  The forward score of a prefix, the
best sum of piece scores over its segmentations, is computed once and shared
by every pre-token below it; only the current path is held.  The number of
pieces at each terminal is stored, and a document's count is the sum over its
pre-tokens.  No shuffle is needed: every document is counted where it is read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ship, text_column

#: Distinct pre-tokens, and documents' characters, that a task holds at a time.
HELD_TOKENS, HELD_CHARS = 400_000, 32_000_000
WORD_START = "▁"
UNKNOWN_PENALTY = 10.0


@functools.lru_cache(maxsize=2)
def load_pieces(path: str) -> dict[str, float]:
    """Piece -> log probability.  A merge-ordered vocabulary gives ranks, not
    probabilities; Zipf's law turns rank r into -log(r + 1)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size())
                if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i): -math.log(r + 1) for r, i in enumerate(ordinary)}


def count_pieces(tokens, pieces: dict[str, float]) -> list[int]:
    """Pieces of the best segmentation of each of the sorted ``tokens``.

    A character that is no piece itself scores the least piece score less
    UNKNOWN_PENALTY and counts its UTF-8 bytes.  Of equal scores the one with
    the longest last piece is kept."""
    get = pieces.get
    longest = max(map(len, pieces), default=1)
    unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
    scores, counts = [0.0], [0]  # of every prefix on the current path
    out, last = [], ""
    for token in tokens:
        shared, most = 0, min(len(token), len(last))
        while shared < most and token[shared] == last[shared]:
            shared += 1
        del scores[shared + 1:], counts[shared + 1:]
        for end in range(shared + 1, len(token) + 1):
            best, count = -math.inf, 0
            for start in range(max(0, end - longest), end):
                s = get(token[start:end])
                if s is not None and scores[start] + s > best:
                    best, count = scores[start] + s, counts[start] + 1
            if token[end - 1] not in pieces and scores[end - 1] + unknown > best:
                best, count = scores[end - 1] + unknown, counts[end - 1] + len(token[end - 1].encode())
            scores.append(best)
            counts.append(count)
        out.append(counts[len(token)])
        last = token
    return out


class _Numbers(dict):
    def __missing__(self, token):
        self[token] = n = len(self)
        return n


def _counting(path):
    def run(batches):
        pieces = load_pieces(path)

        def send(numbers, docs):
            tokens = list(numbers)
            order = sorted(range(len(tokens)), key=tokens.__getitem__)
            sizes = np.zeros(len(tokens), dtype=np.int64)
            sizes[order] = count_pieces([WORD_START + tokens[i] for i in order], pieces)
            return pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in docs], pa.int64()), pa.array([len(x) for _, x in docs], pa.int64()),
                 pa.array([int(sizes[x].sum()) for _, x in docs], pa.int64())], names=["doc_id", "n_words", "n_tokens"])

        numbers, docs, chars = _Numbers(), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                docs.append((doc_id.as_py(), np.array([numbers[w] for w in text.split()], dtype=np.uint32)))
                chars += len(text)
                if len(numbers) >= HELD_TOKENS or chars >= HELD_CHARS:
                    yield send(numbers, docs)
                    numbers, docs, chars = _Numbers(), [], 0
        if docs:
            yield send(numbers, docs)
    return run


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_words (white-space separated pre-tokens, each with a word
    start mark) and n_tokens (pieces of their best unigram segmentations) of
    every whole text; one row per input row.

    Null text counts as empty: 0 and 0.  A null doc_id is kept, repeated rows
    are counted alike, words and texts of any length are segmented whole, an
    empty table gives no rows and other columns are ignored.
    """
    ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
            .mapInArrow(_counting(model_path), "doc_id long, n_words long, n_tokens long"))


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
