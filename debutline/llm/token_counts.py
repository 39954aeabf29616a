"""Token counts under a unigram model, by dynamic programming that words with a common beginning share.

The distinct words of a batch are walked in sorted order, which is the order of a walk through their trie: the best scores of the
letters that a word shares with the one before it are already there, and only the rest is computed. At a terminal the number of tokens of
the best segmentation is stored with the word. Texts add up the counts of their words where they are read; nothing is shuffled.

The pieces are those of a public vocabulary, none trained here; their probabilities follow their ranks (Zipf). What no piece covers is
counted as its bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 300_000
BYTE_PENALTY = 2.0


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict, float]:
    """(trie of the pieces from their last letter to their first, score of a byte) of a sentencepiece vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    return backward_trie(zipf_scores(plain)), -math.log(len(plain) + 1) - BYTE_PENALTY - math.log(sum(1 / (rank + 1) for rank in range(len(plain))))


def zipf_scores(ranked: list[str]) -> dict[str, float]:
    norm = math.log(sum(1 / (rank + 1) for rank in range(len(ranked))))
    return {piece: -math.log(rank + 1) - norm for rank, piece in enumerate(ranked)}


def backward_trie(scores: dict[str, float]) -> dict:
    """Nested dicts by letter; the score of a whole piece is under the empty string."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for letter in reversed(piece):
            node = node.setdefault(letter, {})
        node[""] = score
    return root


def word_counts(words: list[str], trie: dict, byte_score: float) -> list[int]:
    """Tokens of the best segmentation of each word, which are given in ascending order; the fewer tokens win a tie."""
    out, before = [], ""
    best, tokens = [0.0], [0]  # of the best segmentation of each beginning
    for word in words:
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared, len(word)):
            # the last letter as its bytes, or any piece that ends with it
            letter = word[end]
            size = 1 if letter < "\x80" else len(letter.encode("utf-8", "surrogatepass"))
            top, count = best[end] + size * byte_score, tokens[end] + size
            node, start = trie.get(letter), end
            while node is not None:
                score = node.get("")
                if score is not None:
                    score += best[start]
                    if score > top or (score == top and tokens[start] + 1 < count):
                        top, count = score, tokens[start] + 1
                start -= 1
                if start < 0:
                    break
                node = node.get(word[start])
            best.append(top)
            tokens.append(count)
        out.append(tokens[len(word)])
        before = word
    return out


def count_tokens(documents: DataFrame, path: str, text: str = "text", mark: str = "▁") -> DataFrame:
    """`documents` with `_words` and `_tokens` in place of the text; null, empty and blank texts have none of either.

    A word is a run of other than white space, with `mark` in front. `_words` and `_tokens` may not be in use.
    """
    names = [name for name in documents.columns if name != text]
    if {"_words", "_tokens"} & set(names):
        raise ValueError("column names in use: _words or _tokens")
    kinds = ", ".join([*(f"`{name}` {documents.schema[name].dataType.simpleString()}" for name in names), "_words long, _tokens long"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        known: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                split = [(value or "").split() for value in part.column(text).to_pylist()]
                new = {word for words in split for word in words if word not in known}
                if len(known) + len(new) > CACHED_WORDS:
                    known = {}
                    new = {word for words in split for word in words}
                order = sorted(new)
                known.update(zip(order, word_counts([mark + word for word in order], *vocabulary)))
                columns = [*(part.column(n) for n in names), pa.array([len(w) for w in split], pa.int64()), pa.array([sum(map(known.__getitem__, w)) for w in split], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "_words", "_tokens"])

    return documents.select(*[f"`{n}`" for n in names], F.col(text)).mapInArrow(scan, kinds)
