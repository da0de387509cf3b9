"""Hashed word features of texts, computed for blocks of texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd

WORD = re.compile(r"\w+")
WORD_OR_MARKS = re.compile(r"\w+|[^\w\s]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 4_000_000


def blocks(texts: pd.Series, chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Runs of texts of a few million characters; a longer text stands alone."""
    block, held = [], 0
    for text in texts:
        block.append(text or "")
        held += len(block[-1])
        if held >= chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def hashed(words: list[str]) -> np.ndarray:
    """A 64-bit hash per word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, object), categorize=True)


def word_hashes(texts: list[str], pattern: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words of each text."""
    found = [pattern.findall(text) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return hashed([w for words in found for w in words]), counts


def owners(counts: np.ndarray) -> np.ndarray:
    """The index of the text that each word belongs to."""
    return np.repeat(np.arange(len(counts)), counts)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread hashes anew, so that combined ones stay uniform."""
    with np.errstate(over="ignore"):
        out = hashes * _MIX
        out ^= out >> np.uint64(32)
        return out * _MIX


def pairs(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbouring words of one text, and their texts.

    All pairs of a word with itself count as one pair: stuttering.
    """
    same = owner[1:] == owner[:-1]
    with np.errstate(over="ignore"):
        joined = mixed(mixed(hashes[:-1]) + hashes[1:])
    joined[hashes[1:] == hashes[:-1]] = _MIX
    return joined[same], owner[1:][same]
