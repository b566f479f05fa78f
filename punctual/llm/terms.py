"""Terms of texts: runs of ASCII letters and digits and of all characters from U+0080 on.

Split and hashed as in ``tokens``, with other separators; the letters A-Z count as a-z.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

from punctual.llm.tokens import Tokenizer, Words

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Terms(Tokenizer):
    """Splits chunks of bytes into hashed terms; hashes parts of terms as well."""

    def __init__(self):
        super().__init__()
        self.space = np.ones(256, dtype=bool)
        for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
            self.space[first : last + 1] = False

    def prefix_sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums from which ``part_hashes`` takes any range of ``data``."""
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], dtype=np.uint64, out=sums[1:])
        return sums

    def part_hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges, to be spread by ``mix``. ``words`` was called before."""
        return (sums[ends] - sums[starts]) * self.inverse[starts]


def sentence_of(data: np.ndarray, words: Words) -> np.ndarray:
    """A number per word that grows where a sentence ends: at ``.``, ``!``, ``?``, a line
    feed, or a new text."""
    stops = np.zeros(256, dtype=np.int64)
    stops[[0x0A, 0x21, 0x2E, 0x3F]] = 1
    passed = np.cumsum(stops[data])
    return passed[words.starts] + words.text_of_word() if len(words.starts) else words.starts
