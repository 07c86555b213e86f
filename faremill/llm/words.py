"""Word and shingle hashes of whole texts, vectorised over the bytes of many texts at once.

Runs inside tasks on Arrow batches. A word is a run of bytes outside a separator set; all separators are
ASCII, so no UTF-8 sequence is ever cut. Equal byte runs have equal hashes whatever text they stand in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Separators of the word pattern [^\x20\x09-\x0D]+.
BLANKS = bytes([*range(0x09, 0x0E), 0x20])
#: Every ASCII character that is neither a letter nor a digit.
NON_WORD = bytes(c for c in range(128) if not chr(c).isalnum())
#: Bytes of text that are hashed at once; a longer text is a block of its own, hashed in pieces.
BLOCK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """The words of texts ``first`` to ``first + texts - 1``; ``bounds[i]:bounds[i+1]`` are those of text i."""

    first: int
    texts: int
    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def shingles(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words that begin at each word; only positions inside one text are meaningful."""
        count = len(self.hashes) - width + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        factors = mixed(np.arange(1, width + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
        total = np.full(count, width * int(_BASE) % (1 << 64), np.uint64)
        for i in range(width):
            total += self.hashes[i : i + count] * factors[i]
        return mixed(total)


class WordHasher:
    """Splits and hashes texts. One instance serves one task and keeps its tables."""

    def __init__(self, separators: bytes = BLANKS, fold_ascii: bool = True):
        self.is_word = np.ones(256, np.int8)
        self.is_word[list(separators)] = 0
        self.values = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
        if fold_ascii:
            self.values[65:91] = self.values[97:123]
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _tables(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, BLOCK_BYTES + 1)
            self.powers, self.inverses = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, step)])) for step in (_BASE, _INVERSE)
            )

    def blocks(self, texts: list[bytes | None]) -> Iterator[Block]:
        """The texts in order; a null text has no words."""
        first, size, held = 0, 0, []
        for i, text in enumerate(texts):
            text = text or b""
            if held and size + len(text) > BLOCK_BYTES:
                yield self._block(first, held)
                first, size, held = i, 0, []
            held.append(text)
            size += len(text) + 1
        if held:
            yield self._block(first, held)

    def _block(self, first: int, texts: list[bytes]) -> Block:
        buffer = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, ends, hashes = self._words(buffer)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        return Block(first, len(texts), buffer, starts, ends, bounds, hashes)

    def _words(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and hash of every word; the work arrays cover one piece of BLOCK_BYTES, however long the text is."""
        self._tables(min(len(buffer), BLOCK_BYTES) + 1)
        place = np.int32 if len(buffer) < 1 << 31 else np.int64
        starts, ends, sums = [np.zeros(0, place)], [np.zeros(0, place)], [np.zeros(0, np.uint64)]
        goes_on = False
        for at in range(0, len(buffer), BLOCK_BYTES):
            part = buffer[at : at + BLOCK_BYTES]
            inside = self.is_word[part]
            edges = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
            begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * self.powers[: len(part)], out=total[1:])
            # Of each word, the sum of its bytes' values times powers that count from its own begin.
            own = (total[end] - total[begin]) * self.inverses[begin]
            begin, end = (begin + at).astype(place), (end + at).astype(place)
            if goes_on and inside[0]:  # the last word of the piece before goes on here
                size = int(ends[-1][-1]) - int(starts[-1][-1])
                sums[-1][-1:] += own[:1] * np.uint64(pow(int(_BASE), size, 1 << 64))
                ends[-1][-1] = end[0]
                begin, end, own = begin[1:], end[1:], own[1:]
            if len(begin):
                starts.append(begin)
                ends.append(end)
                sums.append(own)
            goes_on = bool(inside[-1])
        for i, (begin, end) in enumerate(zip(starts, ends)):  # piece by piece: mixing takes arrays of its own
            sums[i] = mixed(sums[i] + (end - begin).astype(np.uint64))
        return tuple(_concatenated(parts) for parts in (starts, ends, sums))


def _concatenated(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array; each is let go as soon as it is copied."""
    if len(parts) <= 2:
        return parts[-1]
    out = np.empty(sum(map(len, parts)), parts[0].dtype)
    at = len(out)
    while parts:
        part = parts.pop()
        out[at - len(part) : at] = part
        at -= len(part)
    return out
