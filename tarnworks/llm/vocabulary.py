"""An existing subword vocabulary: its pieces, scores and byte pieces.

The vocabulary file is read on the driver and goes to the executors as a plain
mapping; it has a fixed size (tens of thousands of pieces), whatever the corpus.

Scores are natural logs of weights. A vocabulary that was made by merges has no such
scores but the ranks 0, -1, -2, ... of its merges: there a piece of rank r weighs
1 / (r + RANK_SHIFT), as frequencies fall with rank, over the sum of all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

#: Where the vocabularies of public tokenizers lie here; a parameter wherever it is used.
FOLDER = "/opt/tokenizers"
PIECES = f"{FOLDER}/piece_bpe_32k.model"
RANKS = f"{FOLDER}/byte_bpe_50k.tiktoken"
RANK_SHIFT = 10


@dataclass
class Vocabulary:
    """Pieces by their text, in which a space stands for the word mark, and the 256 byte pieces; each with id and score."""

    name: str
    ids: dict[str, int]
    byte_ids: list[int]
    byte_score: float
    longest: int
    #: Score by every prefix of a piece, None where the prefix is no piece itself.
    step: dict[str, float | None] = field(repr=False)
    #: Bytes and score by id.
    texts: list[bytes] = field(repr=False)
    scores: list[float] = field(repr=False)


def log_weights(scores: list[float]) -> list[float]:
    """The scores themselves, or logs of weights where they are ranks: whole numbers. Ranks beyond the number of pieces count as that number."""
    ranks = -np.array(scores)
    if (ranks % 1).any():
        return scores
    weights = 1 / (np.minimum(ranks, len(ranks)) + RANK_SHIFT)
    return np.log(weights / weights.sum()).tolist()


def read_pieces(path: str = PIECES) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    ids, byte_ids, texts, scores = {}, [0] * 256, [b""] * size, [0.0] * size
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(re.fullmatch(r"<0x(..)>", piece)[1], 16)
            byte_ids[value], texts[i] = i, bytes([value])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = piece.replace("▁", " ")
            ids[text], texts[i] = i, text.encode()
    for i, score in zip(ids.values(), log_weights([model.get_score(i) for i in ids.values()])):
        scores[i] = score
    # byte pieces carry no score of their own: a character spelled in bytes is worse than any piece
    byte_score = min(scores) - 1.0
    for i in byte_ids:
        scores[i] = byte_score
    step: dict[str, float | None] = {t[:k]: None for t in ids for k in range(1, len(t) + 1)}
    step |= {t: scores[i] for t, i in ids.items()}
    return Vocabulary(path, ids, byte_ids, byte_score, max(map(len, ids)), step, texts, scores)
