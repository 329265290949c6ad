"""Word shingles as 64-bit numbers, and MinHash signatures of their sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE_WORDS = 5
#: Bytes of text hashed at once.
CHUNK = 1 << 20

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0x100000001B3
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACES = np.zeros(256, bool)
_SPACES[list(b" \t\n\r\f\x0b")] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finishing step which spreads every bit over all bits."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i below n, by doubling."""
    out = np.ones(n, np.uint64)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(step)
        have, step = have + more, step * step % (1 << 64)
    return out


_UP = _powers(_BASE, CHUNK + 1)
_DOWN = _powers(_BASE_INVERSE, CHUNK + 1)


def _parts(data: bytes) -> Iterator[bytes]:
    """The text in parts of about ``CHUNK`` bytes, cut at white space."""
    at = 0
    while len(data) - at > CHUNK:
        cut = max(data.rfind(s, at, at + CHUNK) for s in (b" ", b"\n", b"\t", b"\r", b"\f", b"\x0b"))
        if cut <= at:  # a word of more than a chunk: up to the next white space
            ends = [e for s in (b" ", b"\n", b"\t", b"\r", b"\f", b"\x0b") if (e := data.find(s, at + CHUNK)) >= 0]
            cut = min(ends, default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, and where the word starts."""
    raw = np.frombuffer(data, np.uint8)
    space = np.concatenate(([True], _SPACES[raw], [True]))
    change = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = change[::2], change[1::2]
    up, down = (_UP, _DOWN) if len(raw) <= CHUNK else (_powers(_BASE, len(raw) + 1), _powers(_BASE_INVERSE, len(raw) + 1))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts]), starts


def _of_words(words: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` words."""
    out = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        out = out * _M3 + words[j : len(words) - n + 1 + j]
    return _mixed(out)


def _distinct(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    found = np.sort(_of_words(words, min(len(words), SHINGLE_WORDS)))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The different shingles of each text, sorted; words are lower-cased runs of other than white space.

    A text of fewer than five words has one shingle, of all of them; one without
    words has none.
    """
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        words, starts = _hashed(b"\n".join(held))
        firsts = np.cumsum([0, *(len(h) + 1 for h in held)])
        bounds = np.searchsorted(starts, firsts)
        for a, b in zip(bounds, bounds[1:]):
            yield _distinct(words[a:b])

    for text in texts:
        data = (text or "").lower().encode("utf-8", "surrogatepass")
        if size + len(data) + 1 > CHUNK and held:
            yield from flush()
            held, size = [], 0
        if len(data) >= CHUNK:
            yield _distinct(np.concatenate([_hashed(p)[0] for p in _parts(data)]))
        else:
            held.append(data)
            size += len(data) + 1
    if held:
        yield from flush()


def hash_family(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    odd = draw.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
    return odd, draw.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of the smallest value that each hash function takes on the set."""
    a, b = family
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(low, (x[at : at + 512, None] * a + b).min(axis=0), out=low)
    return ((low ^ (low >> np.uint32(16))) & np.uint32(0xFFFF)).astype(np.uint16)
