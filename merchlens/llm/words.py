"""Words of whole columns of texts as arrays: spans, text numbers and 64-bit hashes.

Everything works on the UTF-8 bytes of an Arrow column at once. A word is a maximal run
of bytes that a 256-entry table marks; the tables here mark all bytes above 0x7F, so a
character outside ASCII never ends a word.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONG_WORD = 128
#: Bytes over which running sums are made at once.
HASHED_BYTES = 1 << 20
#: Bytes of text that are worked on at once; one longer text is still taken whole.
BLOCK_BYTES = 512 << 10


def byte_table(*, outside: bytes) -> np.ndarray:
    """True for every byte that belongs to a word, given the bytes that do not."""
    table = np.ones(256, dtype=bool)
    table[list(outside)] = False
    return table


#: Words divided by ASCII white space.
SPACED = byte_table(outside=b" \t\n\v\f\r")
#: Words of digits, letters and everything outside ASCII.
ALPHANUMERIC = byte_table(
    outside=bytes(b for b in range(128) if not chr(b).isalnum())
)


def process_cache(name: str) -> dict:
    """What this Python process keeps between tasks under a name.

    Functions travel to tasks by value, since executors need no copy of the package. So a
    variable of a module begins anew in every task; an entry among the process's modules
    stays.
    """
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kept = process_cache("_merchlens_words")
    if "lower" not in kept:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        random = np.random.PCG64(20240229).random_raw(257)
        kept.update(lower=lower, random=np.asarray(random[:256], dtype=np.uint64))
        # Powers of an odd number and of its inverse, both modulo 2 to the 64.
        base = int(random[256]) | 1
        for name, factor in (("powers", base), ("inverse", pow(base, -1, 1 << 64))):
            steps = np.full(HASHED_BYTES, factor, np.uint64)
            steps[0] = 1
            kept[name] = np.cumprod(steps)
    return kept["lower"], kept["random"]


def stable_order(group: np.ndarray, groups: int) -> np.ndarray:
    """Places in the order of their groups, equal ones as they stand."""
    return np.argsort(group.astype(np.uint16) if groups <= 1 << 16 else group, kind="stable")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and len + 1 offsets into them; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes each."""
    out, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        out.append((first, last))
        first = last
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per non-empty span, given in order and without overlap.

    A span's hash is a polynomial in an odd number over random numbers for its bytes: a
    difference of running sums over all bytes, shifted to the span's beginning. Long spans
    have a cryptographic one, so no polynomial has more than ``LONG_WORD`` terms.
    """
    _, random = _tables()
    kept = process_cache("_merchlens_words")
    powers, inverse = kept["powers"], kept["inverse"]
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        base = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, base + HASHED_BYTES, "right")))
        if lengths[a] <= HASHED_BYTES:  # else a long one, alone
            part = data[base : ends[b - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(random[part] * powers[: len(part)], out=sums[1:])
            out[a:b] = (sums[ends[a:b] - base] - sums[starts[a:b] - base]) * inverse[starts[a:b] - base]
        a = b
    out = mix(out + lengths.astype(np.uint64))
    for i in np.flatnonzero(lengths > LONG_WORD):
        whole = data[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little")
    return out


def text_blocks(
    column: pa.Array, size: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``a`` to ``b`` of a string column, their bytes and offsets, block by block.

    Only a block is copied at a time, so the memory follows the block, not the batch.
    """
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in blocks(np.append(0, np.cumsum(lengths, dtype=np.int64)), size):
        yield a, b, *bytes_and_offsets(column.slice(a, b - a))
    pa.default_memory_pool().release_unused()


class Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``, in order.

    ``starts`` and ``ends`` are byte positions, ``counts`` the words of each text,
    ``bounds`` the first word of each text (and the number of words at the end).
    """

    def __init__(
        self,
        data: np.ndarray,
        offsets: np.ndarray,
        inside: np.ndarray = SPACED,
        lower: bool = False,
    ):
        self.data = _tables()[0][data] if lower else data
        n = len(data)
        if n:
            word = inside[data]
            begins = word.copy()
            begins[1:] &= ~word[:-1]
            stops = word.copy()
            stops[:-1] &= ~word[1:]
            cut = offsets[(offsets > 0) & (offsets < n)]
            begins[cut] = word[cut]
            stops[cut - 1] = word[cut - 1]
            self.starts = np.flatnonzero(begins)
            self.ends = np.flatnonzero(stops) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.bounds[-1] = len(self.starts)
        self.counts = np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the number of runs in each text.

    A text with fewer words, but not none, has its whole sequence as one run.
    """
    hashes = words.hashes()
    n = len(hashes)
    factors = np.random.PCG64(99).random_raw(width) | np.uint64(1)
    if n >= width:
        runs = hashes[: n - width + 1] * factors[0]
        for k in range(1, width):
            runs = runs + hashes[k : n - width + 1 + k] * factors[k]
        runs = mix(runs)
    else:
        runs = np.zeros(0, np.uint64)
    counts = np.where(words.counts >= width, words.counts - width + 1, words.counts > 0)
    first = np.cumsum(counts) - counts
    within = np.arange(int(counts.sum())) - np.repeat(first, counts)
    at = np.repeat(words.bounds[:-1], counts) + within
    out = np.zeros(len(at), np.uint64)
    whole = np.repeat(words.counts >= width, counts)
    out[whole] = runs[at[whole]]
    for i in np.flatnonzero((words.counts < width) & (words.counts > 0)):
        own = hashes[words.bounds[i] : words.bounds[i + 1]]
        digest = hashlib.blake2b(own.tobytes(), digest_size=8).digest()
        out[first[i]] = int.from_bytes(digest, "little")
    return out, counts


def distinct_per_text(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and how many there are."""
    if not len(values):
        return values, counts
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(values)
    order = order[stable_order(text[order], len(counts))]
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.bincount(text[new], minlength=len(counts))
