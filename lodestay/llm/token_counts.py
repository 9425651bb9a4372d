"""Greedy word-piece counts in linear time: a trie of the vocabulary with failure links, each node
holding how many pieces the way to its link completes."""

from __future__ import annotations

from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestay.llm.common import Memo, map_slices, texts

SCHEMA = "doc_id long, n_words long, n_tokens long"
WORD_START = "▁"


class LongestMatch:
    """Counts of greedy longest-match pieces, one step a character and no piece built.

    A character that no piece begins with on its own counts as its UTF-8 bytes.
    """

    def __init__(self, pieces: set[str]):
        weight = dict.fromkeys(pieces, 1)
        for c in {c for p in pieces for c in p}:
            weight.setdefault(c, len(c.encode()))  # byte pieces
        self.arrows: list[dict[str, int]] = [{}]
        own = [0]  # pieces that the node itself is
        for piece, n in weight.items():
            node = 0
            for c in piece:
                to = self.arrows[node].get(c)
                if to is None:
                    to = self.arrows[node][c] = len(self.arrows)
                    self.arrows.append({})
                    own.append(0)
                node = to
            own[node] = n
        self.fail, self.popped = [0] * len(own), [0] * len(own)
        queue = deque((to, 0, c) for c, to in self.arrows[0].items())
        while queue:
            node, parent, c = queue.popleft()
            if own[node]:
                self.popped[node] = own[node]  # back to the root with this one piece
            else:
                # every single character is a piece, so the walk ends at the root's arrow at last
                at, n = self.fail[parent], self.popped[parent]
                while c not in self.arrows[at]:
                    n += self.popped[at]
                    at = self.fail[at]
                self.fail[node], self.popped[node] = self.arrows[at][c], n
            queue.extend((to, node, d) for d, to in self.arrows[node].items())

    def count(self, word: str) -> int:
        arrows, fail, popped = self.arrows, self.fail, self.popped
        node = total = 0
        for c in word:
            to = arrows[node].get(c)
            while to is None and node:
                total += popped[node]
                node = fail[node]
                to = arrows[node].get(c)
            if to is None:
                total += len(c.encode())  # in no piece at all
            else:
                node = to
        while node:
            total += popped[node]
            node = fail[node]
        return total


def vocabulary(path: str) -> set[str]:
    """The ordinary pieces of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }


@lru_cache(maxsize=2)
def load(path: str) -> Memo:
    automaton = LongestMatch(vocabulary(path))

    def learn(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = [automaton.count(WORD_START + w.decode()) for w in words]
        return np.array(counts, np.int32), np.ones(len(words), np.int64)

    return Memo(learn)


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its words and the greedy pieces of them, each word with a mark at its start.

    Null and empty texts have none. Repeated rows are counted each; other
    columns are not read.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, n_words = load(path).of_words(batch.column("text"))
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])  # one code a word: its pieces
        ends = np.cumsum(n_words)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(sums[ends] - sums[ends - n_words], pa.int64())],
            ["doc_id", "n_words", "n_tokens"])

    return map_slices(texts(docs, doc_id, text), "text", SCHEMA, work)
