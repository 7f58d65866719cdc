"""Words of many texts at once, straight from the Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from wardlake.llm.shared import WHITE_BYTES

#: Bytes of text handled in one numpy pass.
BLOCK_BYTES = 1 << 20

IS_WHITE = np.zeros(256, bool)
IS_WHITE[list(WHITE_BYTES)] = True
#: Random odd factors per byte value; the hash of a word is a polynomial in them.
BYTE_VALUES = np.random.default_rng(42).integers(1, 1 << 63, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def blocks(
    texts: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole texts of about ``limit``
    bytes. A longer text is a run of its own; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offs, offs[low] + limit, "right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high, whole[offs[low] : offs[high]], offs[low : high + 1] - offs[low]
        low = high


def words(
    data: np.ndarray, offs: np.ndarray, member: np.ndarray = ~IS_WHITE
) -> tuple[np.ndarray, ...]:
    """Starts and ends of all words, and the index of each text's first word (one
    more entry than texts). ``member`` says which byte values a word is made of. No
    word crosses from one text into the next."""
    inside = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def powers(n: int) -> np.ndarray:
    """1, BASE, BASE**2, ... in 64-bit arithmetic."""
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse_powers(at: np.ndarray) -> np.ndarray:
    """INVERSE**at, by squaring, for many exponents."""
    out, square, rest = np.ones(len(at), np.uint64), INVERSE, at.astype(np.uint64)
    with np.errstate(over="ignore"):
        while rest.any():
            out = np.where(rest & np.uint64(1), out * square, out)
            square, rest = square * square, rest >> np.uint64(1)
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(31))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values = values ^ (values >> np.uint64(29))
        values = values * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial of the bytes before each place, one entry more than bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=out[1:])
    return out


def span_hashes(
    prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """64-bit hash of the bytes of each span; depends on content and length only."""
    with np.errstate(over="ignore"):
        raw = (prefix[ends] - prefix[starts]) * inverse_powers(starts)
        return mixed(raw + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_hashes(data), starts, ends)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data | ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


#: Spans up to this many bytes are keyed and compared in steps of eight.
SHORT_BYTES = 64
STEP_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def _steps(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number; beyond the end they are zero."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of spans by content; equal spans have equal keys, not conversely."""
    size = ends - starts
    keys = mixed(size.astype(np.uint64))
    steps = _steps(data)
    at = np.flatnonzero((size > 0) & (size <= SHORT_BYTES))
    done = 0
    while len(at):
        part = steps[starts[at] + done] & STEP_MASKS[np.minimum(size[at] - done, 8)]
        keys[at] = mixed(keys[at] ^ part)
        done += 8
        at = at[size[at] > done]
    long = np.flatnonzero(size > SHORT_BYTES)
    if len(long):
        whole = data.tobytes()
        spans = zip(starts[long].tolist(), ends[long].tolist(), strict=True)
        keys[long] = [xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in spans]
    return keys


def same_bytes(
    data: np.ndarray,
    starts: np.ndarray,
    ends: np.ndarray,
    other: np.ndarray,
    other_starts: np.ndarray,
    other_ends: np.ndarray,
) -> np.ndarray:
    """True where a span of ``data`` has the bytes of its partner in ``other``."""
    size = ends - starts
    same = size == other_ends - other_starts
    left, right = _steps(data), _steps(other)
    at = np.flatnonzero(same & (size > 0) & (size <= SHORT_BYTES))
    done = 0
    while len(at):
        mask = STEP_MASKS[np.minimum(size[at] - done, 8)]
        unlike = (left[starts[at] + done] ^ right[other_starts[at] + done]) & mask
        same[at[unlike != 0]] = False
        done += 8
        at = at[(unlike == 0) & (size[at] > done)]
    for i in np.flatnonzero(same & (size > SHORT_BYTES)).tolist():
        a, b, n = starts[i], other_starts[i], size[i]
        same[i] = np.array_equal(data[a : a + n], other[b : b + n])
    return same


def distinct_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(class of each span, index of a span of each class): spans are of one class
    exactly if their bytes are equal. Keys only bring candidates together; spans of
    one key and other bytes get classes of their own."""
    keys = span_keys(data, starts, ends) if keys is None else keys
    # The low bits of a key make room for the place, so that plain values are sorted.
    mask = np.uint64((1 << len(keys).bit_length()) - 1)
    order = np.sort((keys & ~mask) | np.arange(len(keys), dtype=np.uint64))
    place = (order & mask).astype(np.int64)
    order &= ~mask
    new = np.ones(len(keys), bool)
    new[1:] = order[1:] != order[:-1]
    sample = place[new]
    which = np.empty(len(keys), np.int64)
    which[place] = np.cumsum(new) - 1
    pair = sample[which]
    other = np.flatnonzero(pair != np.arange(len(starts)))
    same = same_bytes(
        data, starts[other], ends[other], data, starts[pair[other]], ends[pair[other]]
    )
    more: dict[bytes, int] = {}
    found = [sample]
    for i in other[~same].tolist():
        text = data[starts[i] : ends[i]].tobytes()
        number = more.setdefault(text, len(sample) + len(more))
        if number == len(sample) + len(found) - 1:
            found.append(np.array([i]))
        which[i] = number
    return which, np.concatenate(found)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array; they must be valid UTF-8."""
    size = ends - starts
    limits = np.concatenate(([0], np.cumsum(size)))
    step = np.arange(limits[-1]) - np.repeat(limits[:-1], size)
    flat = data[np.repeat(starts, size) + step]
    return pa.Array.from_buffers(
        pa.large_string(),
        len(starts),
        [None, pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(flat)],
    ).cast(pa.string())


#: Bytes of a term: digits, letters and all bytes of characters beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
