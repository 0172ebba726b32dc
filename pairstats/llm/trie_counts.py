"""Token counts under a unigram model, by dynamic programming shared along a trie.

The best segmentation of a prefix does not depend on what follows. Distinct pre-tokens, sorted, walk
a trie depth first: the forward scores of the prefix that a pre-token shares with the one before are
kept, and only its new characters are worked out. Each end of a pre-token stores its count of tokens and
its score.

Pieces come from a SentencePiece model file; the log-probability of the piece of rank r is
``-log10(r + RANK)`` up to a constant (Zipf's law), since the file holds ranks, no probabilities.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame

from pairstats.llm.chunks import Index, batches_of, piece_chunks
from pairstats.llm.common import map_texts, texts_of
from pairstats.llm.pieces import Pieces, model_path

RANK = 2.7
#: Decimal digits of scores, so that sums and ties do not hang on rounding.
DIGITS = 6
#: Log-probability of a byte of a character that no piece covers.
BYTE = -6.0


def piece_scores(model: Pieces) -> dict[str, int]:
    """Log-probability of each piece in millionths; bytes and control pieces have none."""
    ranks = sorted(model.ids, key=lambda p: (-model.score[p], model.ids[p]))
    total = math.log10(sum(1 / (r + RANK) for r in range(len(ranks))))
    unit = 10**DIGITS
    return {p: round((-math.log10(r + RANK) - total) * unit) for r, p in enumerate(ranks)}


class TrieCounter:
    """Best scores and token counts of pre-tokens, each shared prefix worked out once."""

    def __init__(self, scores: dict[str, int]) -> None:
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.nodes = 0

    def count(self, words: list[str]) -> list[tuple[int, int]]:
        """(tokens, score) of each word; of equal scores the fewer tokens win."""
        scores, longest = self.scores, self.longest
        out: list[tuple[int, int]] = [(0, 0)] * len(words)
        best, tokens, last = [0], [0], ""
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                c = word[end - 1]
                n = len(c.encode("utf-8", "surrogatepass"))
                unit = scores.get(c)
                if unit is None:
                    value, count = best[-1] + n * int(BYTE * 10**DIGITS), tokens[-1] + n
                else:
                    value, count = best[-1] + unit, tokens[-1] + 1
                for start in range(max(0, end - longest), end - 1):
                    unit = scores.get(word[start:end])
                    if unit is not None:
                        v, t = best[start] + unit, tokens[start] + 1
                        if v > value or (v == value and t < count):
                            value, count = v, t
                best.append(value)
                tokens.append(count)
                self.nodes += 1
            out[k] = (tokens[-1], best[-1])
            last = word
        return out


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, score) of each row of ``docs``; score in log10.

    Whole texts count; a null or empty text has no pre-token and a score of 0. Repeated rows and
    rows without id get their own results.
    """
    path = path or model_path()

    def task():
        counter, index = TrieCounter(piece_scores(Pieces(path))), Index()
        held = {"tokens": np.empty(0, np.int64), "score": np.empty(0, np.int64)}

        def learn(chunks: list[str]) -> None:
            found = np.array(counter.count(chunks), np.int64).reshape(-1, 2)
            held["tokens"] = np.concatenate([held["tokens"], found[:, 0]])
            held["score"] = np.concatenate([held["score"], found[:, 1]])

        def forget() -> None:
            held.update(tokens=np.empty(0, np.int64), score=np.empty(0, np.int64))

        def run(texts: list[str]) -> list[list]:
            words, tokens, scores = [], [], []
            for _, rows in batches_of(texts, piece_chunks, learn, forget, index, 4000):
                for numbers in rows:
                    words.append(len(numbers))
                    tokens.append(int(held["tokens"][numbers].sum()))
                    scores.append(int(held["score"][numbers].sum()) / 10**DIGITS)
            return [words, tokens, scores]

        return run

    added = "n_pretokens bigint, n_tokens bigint, score double"
    return map_texts(texts_of(docs), added, task, per_task=True)
