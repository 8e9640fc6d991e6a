"""The pieces of a SentencePiece model file, and the cuts that no piece can cross.

The model file is read through its library, on the driver for its bytes and in each task for its
pieces; nothing is copied into the repository. A text is cut between two neighbouring characters
when no piece holds them side by side. Every segmentation of the text is then the joined
segmentations of its chunks, whatever the scores, so chunks can be solved once and remembered.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACE_MARK = "▁"  # stands for a blank in pieces
UNKNOWN_PENALTY = 10.0  # below the worst piece, as the library's lattice has it


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Ids and scores of the normal pieces, byte ids, and the pairs of neighbours inside pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in ids]
        self.byte_id = {int(self.text[i][3:5], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.id = {
            self.text[i]: i
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.score = {piece: model.get_score(i) for piece, i in self.id.items()}
        self.longest = max(map(len, self.id))
        self.unknown_score = min(self.score.values()) - UNKNOWN_PENALTY
        letters = sorted({c for piece in self.id if len(piece) > 1 for c in piece})
        number = {c: k + 1 for k, c in enumerate(letters)}
        # Class 0 is every character that stands in no piece of two or more.
        self._class = np.zeros(max(map(ord, letters), default=0) + 2, np.int32)
        for c, k in number.items():
            self._class[ord(c)] = k
        self._joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for piece in self.id:
            for a, b in zip(piece, piece[1:]):
                self._joined[number[a], number[b]] = True

    def cuts(self, text: str) -> np.ndarray:
        """Where the chunks of ``text`` begin, and its length at the end."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self._class[np.minimum(codes, len(self._class) - 1)]
        inner = np.flatnonzero(~self._joined[classes[:-1], classes[1:]]) + 1
        return np.concatenate(([0], inner, [len(text)])) if text else np.zeros(1, np.int64)

    def chunks(self, text: str) -> list[str]:
        """The chunks of ``text`` in order; joined they are the text."""
        edges = self.cuts(text).tolist()
        return [text[a:b] for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One copy for each Python process."""
    return Pieces(path)


class Memory(dict):
    """Remembers results by key in two generations, so that it never grows beyond ``2 * most``."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.solve(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def solve(self, key):
        raise NotImplementedError
