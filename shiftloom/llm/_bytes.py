"""Vectorised work on Arrow text columns: whole texts as UTF-8 bytes, many documents a call.

A chunk is a run of rows whose bytes lie one after the other in ``buf`` (with PAD spare
zero bytes at the end); ``off`` holds the n + 1 row boundaries. Null texts are empty.
Texts are never cut: a row larger than the chunk size is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PAD = 64
CHUNK_BYTES = 2 << 20

U64 = np.uint64
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)
_M1, _M2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(inside) -> np.ndarray:
    """A 256-entry table: 1 where ``inside(byte)``."""
    return np.array([1 if inside(b) else 0 for b in range(256)], dtype=np.uint8)


#: words ``[^\x20\x09-\x0D]+``
SPACED = byte_class(lambda b: b != 0x20 and not 9 <= b <= 13)
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text: digits, a-z, everything beyond ASCII
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buf, off) of a string or binary column; nulls become empty rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=column.offset + n + 1)[column.offset :] if offsets is not None and n else np.zeros(n + 1, np.int64)
    base, end = int(off[0]), int(off[-1])
    raw = np.frombuffer(data, dtype=np.uint8)[base:end] if data is not None and end > base else np.zeros(0, np.uint8)
    off = off - base
    if column.null_count:  # a null row may still cover bytes
        valid = np.asarray(column.is_valid())
        lens = np.where(valid, np.diff(off), 0)
        if int(lens.sum()) != end - base:
            raw = raw[np.repeat(valid, np.diff(off))]
            off = np.concatenate([[0], np.cumsum(lens)])
    buf = np.zeros(len(raw) + PAD, np.uint8)
    buf[: len(raw)] = raw
    return buf, off.astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts batches into runs of rows of about ``limit`` bytes of text: (rows, buf, off)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buf, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), buf[off[at] : off[to] + PAD], off[at : to + 1] - off[at]
            at = to


def words(buf: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word_off): byte spans of words in order; word_off bounds each row's words."""
    n = int(off[-1])
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(off), np.int64)
    inside = table[buf[:n]]
    edge = np.zeros(n, np.uint8)
    edge[1:] = inside[:-1]
    edge[off[off < n]] = 0
    starts = np.flatnonzero(inside > edge)
    edge[:] = 0
    edge[:-1] = inside[1:]
    last = off[1:] - 1
    edge[last[last >= 0]] = 0
    ends = np.flatnonzero(inside > edge) + 1
    return starts, ends, np.searchsorted(starts, off)


def words64(buf: np.ndarray) -> np.ndarray:
    """The little-endian 8-byte integer that starts at each byte (buf is padded)."""
    buf = np.ascontiguousarray(buf)
    return np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))


def hash_spans(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span; equal bytes give equal hashes whatever lies around them."""
    at = words64(buf)
    h = lens.astype(U64) * _M2 + U64(seed)
    if not len(starts):
        return h
    h = (h ^ (at[starts] & _MASK[np.minimum(lens, 8)])) * _M1
    h ^= h >> U64(29)
    h *= _M2
    h ^= h >> U64(32)
    k, left = 8, np.flatnonzero(lens > 8)
    while len(left):
        x = at[starts[left] + k] & _MASK[np.minimum(lens[left] - k, 8)]
        y = (h[left] ^ x) * _M1
        y ^= y >> U64(29)
        y *= _M2
        y ^= y >> U64(32)
        h[left] = y
        k += 8
        left = left[lens[left] > k]
    return h


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


# The five primes of the published XXH64 specification (fixed values).
_P1, _P2, _P3, _P4, _P5 = (U64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def xxh64_spans(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each span as uint64."""
    at = words64(buf)
    s = U64(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(starts), s + _P5, U64)
        long = np.flatnonzero(lens >= 32)
        if len(long):
            first = np.array([int(s) + int(_P1) + int(_P2), int(s) + int(_P2), int(s), int(s) - int(_P1)], dtype=object) % (1 << 64)
            acc = [np.full(len(long), int(x), U64) for x in first]
            pos, stripes, left, k = starts[long], lens[long] // 32, np.arange(len(long)), 0
            while len(left):
                for lane in range(4):
                    x = acc[lane][left] + at[pos[left] + 32 * k + 8 * lane] * _P2
                    acc[lane][left] = _rotl(x, 31) * _P1
                k += 1
                left = left[stripes[left] > k]
            x = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for lane in acc:
                x = (x ^ (_rotl(lane * _P2, 31) * _P1)) * _P1 + _P4
            h[long] = x
        h += lens.astype(U64)
        rest = lens & 31
        pos = starts + (lens - rest)
        for k in range(3):
            i = np.flatnonzero(rest >= 8 * (k + 1))
            if not len(i):
                break
            x = _rotl(at[pos[i] + 8 * k] * _P2, 31) * _P1
            h[i] = _rotl(h[i] ^ x, 27) * _P1 + _P4
        pos = pos + (rest & ~7)
        i = np.flatnonzero(rest & 4)
        h[i] = _rotl(h[i] ^ ((at[pos[i]] & _MASK[4]) * _P1), 23) * _P2 + _P3
        pos = pos + (rest & 4)
        for k in range(3):
            i = np.flatnonzero((rest & 3) > k)
            if not len(i):
                break
            h[i] = _rotl(h[i] ^ (buf[pos[i] + k].astype(U64) * _P5), 11) * _P1
        h ^= h >> U64(33)
        h *= _P2
        h ^= h >> U64(29)
        h *= _P3
        h ^= h >> U64(32)
    return h


def joined_words(buf: np.ndarray, off: np.ndarray, table: np.ndarray = SPACED, lower: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row put one space apart: (buf, starts, ends, word_off) over the new bytes."""
    starts, ends, word_off = words(buf, off, table)
    lens = ends - starts
    before = np.cumsum(lens) - lens
    new = before + np.arange(len(starts))
    total = int(lens.sum()) + len(starts)
    out = np.zeros(total + PAD, np.uint8)
    out[:total] = 32
    n = int(off[-1])
    inside = table[buf[:n]].astype(bool)
    if len(starts):
        out[np.arange(int(lens.sum())) + np.repeat(np.arange(len(starts)), lens)] = lower[buf[:n][inside]]
    return out, new, new + lens, word_off


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), then those of starts[1], and so on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(begin - starts, counts)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a union of half-open spans; touching spans join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([first[1:], [True]])
    return s[first], e[last]


def char_positions(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each byte boundary of the chunk, how many code points start before it."""
    n = int(off[-1])
    out = np.zeros(n + 1, np.int64)
    np.cumsum((buf[:n] & 0xC0) != 0x80, out=out[1:])
    return out


def replace_column(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with some columns exchanged."""
    return pa.RecordBatch.from_arrays([columns.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)


def text_array(parts: list[bytes]) -> pa.Array:
    """UTF-8 byte strings as a string column."""
    return pa.array(parts, pa.binary()).view(pa.string())


def code_points(parts: list[bytes]) -> np.ndarray:
    return np.array([len(x.decode("utf-8", "replace")) for x in parts], np.int64)
