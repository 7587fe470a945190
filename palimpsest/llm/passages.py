"""Passages of PASSAGE_WORDS words or more that start at two places, in any documents or one.

Words are runs of anything but ASCII white space, so line breaks within a passage don't matter. Runs of windows of
PASSAGE_WORDS words are named by their anchor, the GRAM_WORDS words in them of the least hash, and the words on its longer side
that all windows of the run have; the windows of runs that share a name with others are then counted by two independent 64-bit
hashes.

The words of a text beyond SEGMENT_BYTES are taken in segments that overlap by a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import BASE, U64, mix, powers, word_hashes
from .lines import BASE_2, INVERSE_2
from .windows import INVERSE, hash_of, window_runs

#: More than 50 words.
PASSAGE_WORDS, GRAM_WORDS = 51, 8
SEGMENT_BYTES, SEGMENT_WORDS = 4 << 20, 1 << 19


@dataclass
class WordRuns:
    """text, first word and number of windows of each run, and its bucket's key."""

    text: np.ndarray
    place: np.ndarray
    number: np.ndarray
    key: np.ndarray
    at: np.ndarray
    words: np.ndarray
    sums: np.ndarray


def _sums(words: np.ndarray, base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, U64), np.cumsum(words * powers(base, len(words)))])


def _lots(texts: list[bytes]):
    """(texts' numbers, their first words' places, where each begins in the words, the words)."""
    short = [i for i, t in enumerate(texts) if len(t) <= SEGMENT_BYTES]
    if short:
        words, begin = word_hashes(np.frombuffer(b"\n".join(texts[i] for i in short), np.uint8))
        ends = np.cumsum([len(texts[i]) + 1 for i in short])
        base = np.concatenate([[0], np.searchsorted(begin, ends)])
        yield np.array(short), np.zeros(len(short), np.int64), base, words
    for i, t in enumerate(texts):
        if len(t) > SEGMENT_BYTES:
            words, _ = word_hashes(np.frombuffer(t, np.uint8))
            for a in range(0, max(1, len(words) - PASSAGE_WORDS + 1), SEGMENT_WORDS):
                part = words[a : a + SEGMENT_WORDS + PASSAGE_WORDS - 1]
                yield np.array([i]), np.array([a]), np.array([0, len(part)]), part


def word_runs(texts: list[bytes]):
    """The runs of all texts, in lots."""
    for number, first, base, words in _lots(texts):
        sums = _sums(words, BASE)
        text, at, windows, key, _ = window_runs(sums, base, PASSAGE_WORDS, GRAM_WORDS)
        # Apart from the keys of byte strings.
        key = mix(key.view(U64) ^ U64(PASSAGE_WORDS)).view(np.int64)
        yield WordRuns(number[text], at - base[text] + first[text], windows, key, at, words, sums)


def word_windows(texts: list[bytes], asked: np.ndarray):
    """asked: text << 32 | place of runs. (text, place, hash, other hash) of all windows in them, in lots."""
    for x in word_runs(texts):
        k = np.flatnonzero(np.isin(x.text << 32 | x.place, asked))
        run = np.repeat(k, x.number[k])
        inside = np.arange(len(run)) - np.repeat(np.cumsum(x.number[k]) - x.number[k], x.number[k])
        at = x.at[run] + inside
        other = _sums(mix(x.words), BASE_2)
        hashes = [hash_of(s, inverse, at, at + PASSAGE_WORDS).view(np.int64) for s, inverse in ((x.sums, INVERSE), (other, INVERSE_2))]
        yield x.text[run], x.place[run] + inside, *hashes
