"""Texts of an Arrow batch as flat byte arrays, and 64-bit hashes of their words, without per-row Python."""

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_powers = {_ODD: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown by doubling."""
    known = _powers[base]
    if len(known) < n:
        grown = np.full(max(n, 2 * len(known)), base, np.uint64)
        grown[0] = 1
        known = _powers[base] = np.multiply.accumulate(grown)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(texts: pa.Array, target: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets): runs of whole rows of about `target` bytes; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + target, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of each row, and the first word of each row (one more at the end)."""
    letter = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins, stops = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1] | first[1:-1]
    stops[:-1] &= ~letter[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: equal bytes, equal hash, wherever they lie."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_ODD, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and the first word of each row."""
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(LOWER[data], starts, ends), first


def planes(x: np.ndarray, width: int = 8) -> bytes:
    """Unsigned integers as byte planes, the form that block compression shortens most."""
    raw = np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def from_planes(data: bytes, width: int = 8) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view(np.uint64).ravel()


def delta_planes(x: np.ndarray, width: int = 8) -> bytes:
    """Sorted unsigned integers as byte planes of their steps."""
    return planes(np.diff(x, prepend=np.uint64(0)), width)


def from_delta_planes(data: bytes, width: int = 8) -> np.ndarray:
    return np.cumsum(from_planes(data, width), dtype=np.uint64)


def release() -> None:
    """Give freed memory back to the system: an idle Python worker would hold it beside the next stage's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


_held: list = []


def claim(owner: str, drop=lambda: None) -> None:
    """A Python worker serves one operator after the other; what one has cached goes when the next one's task begins."""
    if _held and _held[0] != owner:
        _held[1]()
        release()
    _held[:] = [owner, drop]


def tuned(spark):
    """Arrow batches of at most 1000 rows: texts are long, and a task holds several copies of a batch."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark
