"""Word shingles of whole texts as sorted 64-bit hashes, many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_PAD = _U(0x5851F42D4C957F2D)
#: Bytes handled in one go; a longer text is cut between words.
CHUNK = 2 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _powers(count: int) -> np.ndarray:
    p = np.full(count, _STEP, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some bytes, and where each word begins."""
    letter = ~_SPACE[data]
    before = np.concatenate(([False], letter[:-1]))
    begins = np.flatnonzero(letter & ~before)
    if not len(begins):
        return np.empty(0, np.uint64), begins
    at = np.flatnonzero(letter)
    first = np.searchsorted(at, begins)
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    value = _BYTE[data[at]] * _powers(int(lengths.max()))[place]
    return _mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64)), begins


def _long_text(raw: bytes) -> np.ndarray:
    found, at = [], 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        found.append(_words(np.frombuffer(raw[at:end], np.uint8))[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def word_hashes(texts: list[str | bytes | None], lower: bool = True) -> Iterator[np.ndarray]:
    """The words of each text in order, A-Z as a-z unless told otherwise; texts
    go in chunks."""
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
        if lower:
            raw = raw.translate(_LOWER)
        if size + len(raw) > CHUNK:
            yield from _several(waiting)
            waiting, size = [], 0
        if len(raw) > CHUNK:
            yield _long_text(raw)
            continue
        waiting.append(raw)
        size += len(raw) + 1
    yield from _several(waiting)


def _several(raws: list[bytes]) -> Iterator[np.ndarray]:
    if not raws:
        return
    hashes, begins = _words(np.frombuffer(b" ".join(raws), np.uint8))
    starts = np.cumsum([0] + [len(r) + 1 for r in raws])
    cuts = np.searchsorted(begins, starts)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield hashes[a:b]


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text. A text with fewer words than
    ``size`` has its whole sequence as one; one without words has none."""
    for words in word_hashes(texts):
        if not len(words):
            yield words
            continue
        if len(words) < size:
            words = np.concatenate((words, np.full(size - len(words), _PAD)))
        count = len(words) - size + 1
        value = np.zeros(count, np.uint64)
        for k in range(size):
            value = value * _STEP + _mixed(words[k : k + count] + _U(k + 1))
        yield np.unique(_mixed(value))
