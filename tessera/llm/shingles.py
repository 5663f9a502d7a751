"""Word shingles, MinHash and groups of a sorted partition, for the operators on near copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

from tessera.llm.common import ship_by_value

ship_by_value(__name__)

WORDS = 5
_CACHE = 100_000
_STEP = 2048


class WordHashes(dict):
    """64-bit hashes of words, alike on every machine; refilled when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def word_hashes(text: str | None, cache: dict) -> np.ndarray:
    """Of the lower-cased words of a text, that is its runs without white space."""
    found = (text or "").lower().split()
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def shingle_set(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    n = min(size, len(words))
    run = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        run = run * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - n + 1 + i]
    return np.unique(mixed(run + np.uint64(n)))


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240131)
    return r.integers(0, 1 << 32, (count, 1), dtype=np.uint32), r.integers(0, 1 << 31, (count, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhash(shingles: np.ndarray, xor: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The least of all shingles under each permutation."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(xor), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), _STEP):
        np.minimum(out, ((x[i:i + _STEP] ^ xor) * odd).min(axis=1), out=out)
    return out


def sorted_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """(key, rows) of each group of a partition that is sorted by ``key``."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[key].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        if rest and rest[0][key].iat[0] != values[0]:
            yield rest[0][key].iat[0], pd.concat(rest) if len(rest) > 1 else rest[0]
            rest = []
        bounds = [0, *cuts, len(batch)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.iloc[a:b]
            if b < len(batch):
                yield values[a], pd.concat([*rest, part]) if rest else part
                rest = []
            else:
                rest.append(part)
    if rest:
        yield rest[0][key].iat[0], pd.concat(rest) if len(rest) > 1 else rest[0]
