"""Hashes of the words of many texts at once, in numpy.

A word is a maximal run of characters other than `\\x20 \\x09-\\x0D`, with A-Z lower-cased. Its
64-bit hash is a polynomial over its UTF-8 bytes, taken from prefix sums, then mixed; it depends
on the word alone, not on its place or on the texts around it.
"""

from __future__ import annotations

import numpy as np

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

PIECE = 1 << 20                          # bytes hashed at a time; never splits a word
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(PIECE, 1 << int(n).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _hash_piece(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start byte of each word of one piece."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.concatenate(([False], ~SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_table(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])
    plain = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(plain + (ends - starts).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)), starts


def _pieces(raw: bytes):
    """Cut a long text between words."""
    at = 0
    while len(raw) - at > PIECE:
        cut = at + PIECE
        while cut < len(raw) and not SPACE[raw[cut]]:
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def hash_bytes(raw: bytes) -> np.ndarray:
    """Hash of each word of UTF-8 bytes, with letters as they are."""
    return np.concatenate([_hash_piece(piece)[0] for piece in _pieces(raw)])


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the offsets at which each text's words begin.

    A null text has no words. The offsets have one more entry than there are texts.
    """
    hashes, counts = [], np.zeros(len(texts), np.int64)
    group: list[bytes] = []
    first = size = 0

    def flush(upto: int) -> None:
        nonlocal first, size
        if group:
            got, starts = _hash_piece(b" ".join(group))
            begins = np.cumsum([0] + [len(raw) + 1 for raw in group[:-1]])
            owner = np.searchsorted(begins, starts, "right") - 1
            counts[first:upto] += np.bincount(owner, minlength=len(group))
            hashes.append(got)
        group.clear()
        first, size = upto, 0

    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
        if len(raw) > PIECE:
            flush(i)
            for piece in _pieces(raw):
                got, _ = _hash_piece(piece)
                hashes.append(got)
                counts[i] += len(got)
            first = i + 1
            continue
        if size + len(raw) > PIECE:
            flush(i)
        group.append(raw)
        size += len(raw) + 1
    flush(len(texts))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-word shingles of every text, and their offsets.

    A text with fewer than n words, but at least one, has its whole word sequence as its only
    shingle; a text without words has none.
    """
    counts = np.diff(offsets)
    total = len(hashes)
    owner = np.repeat(np.arange(len(counts)), counts)
    rolled = np.zeros(total, np.uint64)
    for k in range(n):
        part = np.zeros(total, np.uint64)
        part[:max(total - k, 0)] = hashes[k:]
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(1))
    left = offsets[1:][owner] - np.arange(total)          # words from here to the text's end
    whole = left >= n
    values, owners = rolled[whole], owner[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        sequence = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = counts[short] > k
            part = np.where(has, hashes[np.minimum(offsets[short] + k, max(total - 1, 0))],
                            np.uint64(0))
            sequence = np.where(has, mix(sequence * np.uint64(0x9E3779B97F4A7C15) + part
                                         + np.uint64(1)), sequence)
        values = np.concatenate((values, mix(sequence + counts[short].astype(np.uint64))))
        owners = np.concatenate((owners, short))
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[fresh], owners[fresh]
    return values, np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(counts)))))
