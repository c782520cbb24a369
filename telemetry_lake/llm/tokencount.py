"""Token counts under a unigram model, with one dynamic programme for all shared prefixes.

Distinct pre-tokens (a word with a mark before it) are inserted in a trie that a worker
keeps from batch to batch. The best score and token count of a node follow from its path
alone, so each shared prefix is worked out when its node is made and never again; the count
of the node where a pre-token ends is that pre-token's. Documents only add up stored counts.
A trie of more than TRIE_NODES nodes starts anew, and what lies deeper than DEPTH characters
is worked out without nodes: neither changes a count.

Model: the pieces of a public vocabulary; a piece at rank r has the log probability of a
Zipf law, in whole millionths, so that sums are exact. A character that no piece covers
costs its UTF-8 bytes as tokens. The best segmentation has the greatest score, of equal
ones the fewest tokens.

Defined cases: a null or empty text has no tokens; texts and words are counted whole;
repeated rows are counted row by row; only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import map_arrow

# Fixed value: the mark before a word in the vocabulary.
WORD_MARK = "▁"
# Shift of the ranks in the Zipf law, and the price of each byte of an unknown character.
ZIPF_SHIFT, BYTE_LOG = 2.7, -20.0
# Nodes and distinct words that a worker remembers; then it starts anew. Depth of the trie.
TRIE_NODES = CACHE_WORDS = 1 << 19
DEPTH = 32


class Unigram:
    """Pieces with their scores in millionths."""

    def __init__(self, pieces: list[str]):
        total = math.log(sum(1 / (rank + ZIPF_SHIFT) for rank in range(len(pieces))))
        self.scores: dict[str, int] = {}
        for rank, piece in enumerate(pieces):
            if piece:
                self.scores.setdefault(piece, round(1e6 * (-math.log(rank + ZIPF_SHIFT) - total)))
        self.byte = round(1e6 * BYTE_LOG)
        # Lengths of the pieces that end in a character: no others are tried.
        self.lengths: dict[str, list[int]] = {}
        for piece in self.scores:
            own = self.lengths.setdefault(piece[-1], [])
            if len(piece) not in own:
                own.append(len(piece))

    @classmethod
    def of_file(cls, path: str) -> Unigram:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return cls([model.id_to_piece(i) for i in plain])

    def counts(self, words: Iterable[str]) -> list[int]:
        """Tokens of each of the pre-tokens, by a trie of their own."""
        trie = Trie(self)
        return [trie.count(word) for word in words]


class Trie:
    """Prefixes of pre-tokens with their best score and its token count; node 0 is the empty one."""

    def __init__(self, model: Unigram):
        self.model = model
        # Child by (node, character), as one number.
        self.children: dict[int, int] = {}
        self.best, self.number = [0], [0]

    def count(self, word: str) -> int:
        """Tokens of the pre-token, which is in the trie from now on."""
        children, node, end = self.children, 0, 0
        best, number = [0], [0]
        for character in word:
            child = children.get(node << 21 | ord(character))
            if child is None:
                break
            node, end = child, end + 1
            best.append(self.best[node])
            number.append(self.number[node])
        scores, lengths, byte = self.model.scores, self.model.lengths, self.model.byte
        for end in range(end + 1, len(word) + 1):
            last = word[end - 1]
            width = len(last.encode("utf-8", "surrogatepass"))
            # The character as bytes is always possible.
            top, fewest = best[end - 1] + width * byte, number[end - 1] + width
            for length in lengths.get(last, ()):
                if length <= end and (score := scores.get(word[end - length : end])) is not None:
                    score += best[end - length]
                    tokens = number[end - length] + 1
                    if score > top or score == top and tokens < fewest:
                        top, fewest = score, tokens
            best.append(top)
            number.append(fewest)
            if end <= DEPTH:
                child = len(self.best)
                children[node << 21 | ord(last)] = child
                self.best.append(top)
                self.number.append(fewest)
                node = child
        return number[-1]


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and n_tokens of every whole text; the model's file is on every executor."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def work(batches):
        trie, known = Trie(Unigram.of_file(model_file)), {}
        for batch in batches:
            split = [(text or "").split() for text in batch.column(1).to_pylist()]
            flat = list(chain.from_iterable(split))
            if len(known) > CACHE_WORDS:
                known.clear()
            if len(trie.best) > TRIE_NODES:
                trie = Trie(trie.model)
            for word in set(flat).difference(known):
                known[word] = trie.count(WORD_MARK + word)
            sums = np.concatenate([[0], np.cumsum(np.fromiter(map(known.__getitem__, flat), dtype=np.int64, count=len(flat)))])
            ends = np.cumsum([0, *map(len, split)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends)), pa.array(np.diff(sums[ends]))], ["doc_id", "n_words", "n_tokens"]
            )

    return map_arrow(texts, work, f"doc_id {kind}, n_words long, n_tokens long")
