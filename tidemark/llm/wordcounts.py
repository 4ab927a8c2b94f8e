"""Words of whole texts, as bytes, for the operators that work in Arrow batches."""

from __future__ import annotations

import numpy as np

#: ASCII that is not a letter becomes a space; A-Z are lower-cased; other bytes stay.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


class Numbered(dict):
    """Words numbered in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def letter_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and bytes outside ASCII, A-Z lower-cased."""
    return (text or b"").translate(LETTERS).split()


def sum_by_doc(scores: np.ndarray, numbers: list[list[int]]) -> np.ndarray:
    """For each list of row numbers, the sum of these rows of ``scores``."""
    out = np.zeros((len(numbers), scores.shape[1]))
    for row, members in zip(out, numbers):
        if members:
            row += scores[members].sum(0)
    return out
