"""Exact substring removal: every byte covered by a ``length``-byte string that also starts in a document with a smaller id.

A string of ``length`` bytes always holds a locally least ``gram``-byte gram (a minimizer), at the same
place in every copy. So each window of ``length`` bytes belongs to one anchor, and the windows of one
anchor lie side by side; the bytes they span are the anchor's unit. The job works on anchors, about
one in fourteen bytes, and looks at bytes only where copies differ:

1. anchors: each map task hashes units and their grams; a unit that a smaller id of the same task
   holds is settled there, so a unit that a third of all documents share is one entry a task;
2. settle: entries meet by gram hash; a unit that a smaller id holds is removed wholly in the larger;
   where one gram has several units, the least id of each is asked for the unit's bytes;
3. sort: the windows of those units are suffix-sorted - deep-shallow: buckets of the first bytes, multikey quicksort to a
   shallow depth, blind tries for the groups that still tie - and windows that the sort finds equal, byte by byte, take
   the least id among them;
4. removal: documents meet the settled units and windows, and their covered bytes go.

Documents are dealt by a hash of id and text into buckets; the two steps that read texts by bucket
share one exchange. All entries travel as packed arrays, a row per task and bin or bucket.

Defined cases: null text is empty; a null id counts as larger than every id; rows of one id are not
copies of each other (equal rows have equal results); texts shorter than ``length`` lose nothing;
columns other than the two named are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import PAD, chunks, hash_spans, ranges, text_buffer
from ._spark import checkpointed, partitions

LENGTH, GRAM = 50, 25
SHALLOW, BUCKET = 32, 8
BLOCK = 4 << 20
NO_ID = np.int64((1 << 63) - 1)
_FLOW = "target long, kind int, payload binary"


# --- anchors -----------------------------------------------------------------------------------


def gram_hashes(buf: np.ndarray, n: int, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each byte on, by doubling."""
    mul = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
    h = (buf[: n + PAD].astype(np.uint64) + np.uint64(1)) * mul[0]
    h ^= h >> np.uint64(32)
    out, at, size, have = None, 0, gram, 1
    while True:  # binary digits of the length, the least first
        if size & 1:
            if out is None:
                out = h.copy()
            else:
                new = out[: len(h) - at] * mul[1]
                new += h[at:]
                out = new
            at += have
        size >>= 1
        if not size:
            break
        new = h[:-have] * mul[0]
        new += h[have:]
        new ^= new >> np.uint64(29)
        h, have = new, 2 * have
    out = out[:n] * mul[0]
    out ^= out >> np.uint64(31)
    return out


def units(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, unit hash, first window start, bytes spanned, row) of each anchor's run of windows."""
    n = int(off[-1])
    none = np.zeros(0, np.int64)
    if len(off) == 2 and n > 2 * BLOCK:  # a very long text in overlapping blocks; a window keeps its gram hash
        parts = []
        for at in range(0, n - length + 1, BLOCK):
            part = units(buf[at : min(n, at + BLOCK + length - 1) + PAD], np.array([0, min(n, at + BLOCK + length - 1) - at]), length, gram)
            parts.append((part[0], part[1], part[2] + at, part[3], part[4]))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    windows = np.maximum(np.diff(off) - length + 1, 0)
    if not windows.sum():
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    h = gram_hashes(buf, n, gram)
    # the least hash among the length - gram + 1 grams of each window, by doubling
    span = length - gram + 1
    low, have, at = h, 1, 0
    best = None
    size = span
    level = low
    while True:
        if size & 1:
            best = level if best is None else np.minimum(best[: len(level) - at], level[at:])
            at += have
        size >>= 1
        if not size:
            break
        level = np.minimum(level[:-have], level[have:])
        have *= 2
    start = ranges(off[:-1], windows)
    least = best[start]
    row = np.repeat(np.arange(len(windows)), windows)
    # equal neighbours can be one gram met twice (a repetition); such runs are windows of one gram hash
    # all the same, which is all the later steps need, but a run is cut at ``span`` windows
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(start)]]))
    if count.max(initial=0) > span:
        pieces = -(-count // span)
        k = ranges(np.zeros(len(first), np.int64), pieces)
        total = np.repeat(count, pieces)
        first = np.repeat(first, pieces) + k * span
        count = np.minimum(span, total - k * span)
    spanned = count + length - 1
    return least[first], hash_spans(buf, start[first], spanned, 7), start[first], spanned, row[first]


# --- packed entries ----------------------------------------------------------------------------


_TYPES = ("<u2", "<u4", "<i8")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each with its type and length."""
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        code = _TYPES.index(x.dtype.str) if x.dtype.str in _TYPES else 2
        out += [np.array([code, len(x)], "<i8").tobytes(), (x.view("<i8") if x.dtype == np.uint64 else x.astype(_TYPES[code], copy=False)).tobytes()]
    return b"".join(out)


def unpack(payload: bytes, count: int) -> tuple[list[np.ndarray], int]:
    """The first ``count`` arrays and where they end."""
    out, at = [], 0
    for _ in range(count):
        code, n = (int(x) for x in np.frombuffer(payload, "<i8", 2, at))
        out.append(np.frombuffer(payload, _TYPES[code], n, at + 16))
        at += 16 + n * out[-1].itemsize
    return out, at


def small(x: np.ndarray) -> np.ndarray:
    return x.astype("<u2" if x.max(initial=0) < 1 << 16 else "<u4")


def by_document(key: np.ndarray, ident: np.ndarray, *arrays: np.ndarray) -> bytes:
    """Entries in document order with each document's key and id once."""
    docs, first, which = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    return pack(docs, ident[first], small(which[order]), *(x[order] for x in arrays))


def documents_of(payloads: list[bytes], extra: int) -> list[np.ndarray]:
    """[key, id, *arrays] of entries packed with by_document."""
    out: list[list[np.ndarray]] = [[] for _ in range(extra + 2)]
    for p in payloads:
        (docs, ident, which, *arrays), _ = unpack(p, 3 + extra)
        for x, y in zip(out, (docs[which], ident[which], *arrays), strict=True):
            x.append(y)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def dealt(target: np.ndarray, kind: int, key: np.ndarray, ident: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Rows (target, kind, payload), one for each target."""
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], np.diff(target[order]) != 0]))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True):
        part = order[a:b]
        yield int(target[part[0]]), kind, by_document(key[part], ident[part], *(x[part] for x in arrays))


def flow(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["target", "kind", "payload"])


UNIT, SETTLED, ASKED, BYTES, WINDOWS = range(5)


def _least_of_runs(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, new, least): entries sorted by keys, then id; where a key begins; each entry's least id of its key."""
    order = np.lexsort((ids, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    return order, new, ids[order][begin]


def _bin(g: np.ndarray, bins: int) -> np.ndarray:
    return ((g.view(np.uint64) >> np.uint64(34)) % np.uint64(bins)).astype(np.int64)


def _anchors(length: int, gram: int, bins: int, flush_at: int = 500_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(store: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            g, u, key, ident = (np.concatenate(x) for x in zip(*store, strict=True))
            store.clear()
            order, _, least = _least_of_runs((u,), ident)
            g, u, key, ident = (x[order] for x in (g, u, key, ident))
            settled = ident > least
            keep = ~settled
            del order, least
            rows = [*dealt(_bin(g[keep], bins), UNIT, key[keep], ident[keep], g[keep].astype("<u4"), u[keep])]
            rows += dealt(_bucket(key[settled], bins), SETTLED, key[settled], ident[settled], u[settled])
            for at in range(0, len(rows), 512):
                yield flow(rows[at : at + 512])

        store, held = [], 0
        for rows, buf, off in chunks(batches, "text", 1 << 19):
            g, u, _, _, row = units(buf, off, length, gram)
            if not len(g):
                continue
            _, once = np.unique(u ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)
            key = np.asarray(rows.column("key"))
            ident = np.asarray(rows.column("doc_id").fill_null(int(NO_ID)))
            store.append([g[once], u[once], key[row[once]], ident[row[once]]])
            held += len(once)
            if held > flush_at:
                yield from flush(store)
                store, held = [], 0
        if held:
            yield from flush(store)

    return run


def _bucket(key: np.ndarray, bins: int) -> np.ndarray:
    return key % bins  # of numpy's sign: never negative, as pmod


def _settle(bins: int):
    def run(table: pa.Table) -> pa.Table:
        target, kind, payload = (table.column(c).to_pylist() for c in ("target", "kind", "payload"))
        rows = [(t, k, p) for t, k, p in zip(target, kind, payload, strict=True) if k == SETTLED]
        key, ident, g, u = documents_of([p for k, p in zip(kind, payload, strict=True) if k == UNIT], 2)
        if len(g):
            order, new, least = _least_of_runs((g, u), ident)
            g, u, key, ident = (x[order] for x in (g, u, key, ident))
            settled = ident > least
            rows += dealt(_bucket(key[settled], bins), SETTLED, key[settled], ident[settled], u[settled])
            # where one gram has several units, the first holders of each are asked for its bytes
            fresh = np.ones(len(g), bool)
            fresh[1:] = g[1:] != g[:-1]
            group = np.cumsum(fresh) - 1
            ask = (np.bincount(group[new]) > 1)[group] & ~settled
            rows += dealt(_bucket(key[ask], bins), ASKED, key[ask], ident[ask], u[ask])
        return pa.Table.from_batches([flow(rows)])

    return run


# --- deep-shallow suffix sorting ---------------------------------------------------------------


def _groups(live: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each group begins among the live places, its size, each place's group); a group is live as a whole."""
    begin = np.flatnonzero(head[live] == live)
    size = np.diff(np.concatenate([begin, [len(live)]]))
    return begin, size, np.repeat(np.arange(len(begin)), size)


def deep_shallow_sort(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, same): suffixes in order of their first ``depth`` bytes; same[i]: order[i] equals order[i - 1] there.

    Buckets of the first ``BUCKET`` bytes by counting, two bytes a pass, then multikey quicksort: every group is split around a pivot key of 8 bytes into less, equal and
    greater, all groups at once and in linear time; only the equal part moves on to the next bytes. Groups that still tie at
    ``shallow`` bytes have long common prefixes and go to blind tries.
    """
    n = len(starts)
    at = np.ndarray(shape=(len(data) - 7,), dtype=">u8", buffer=np.ascontiguousarray(data), strides=(1,))
    wide = min(BUCKET, depth)
    key = at[starts].astype(np.uint64) >> np.uint64(8 * (8 - wide))
    order = np.arange(n)
    for shift in range(0, 8 * wide, 16):  # two bytes a pass, the last ones first
        order = order[np.argsort(((key >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)[order], kind="stable")]
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    level = np.full(n, wide)
    same = np.zeros(n, bool)
    count = np.diff(np.concatenate([np.flatnonzero(new), [n]])) if n else np.zeros(0, np.int64)
    live, deep = np.flatnonzero(np.repeat(count > 1, count)), []
    if wide >= depth:
        same[live] = head[live] != live
        return order, same
    stop = min(shallow, depth)
    if wide >= stop:
        live, deep = live[:0], [live]
    while len(live):
        begin, size, group = _groups(live, head)
        o, done = order[live], level[live]
        width = np.minimum(8, depth - done)
        key = at[starts[o] + done].astype(np.uint64) >> (8 * (8 - width)).astype(np.uint64)
        a, b, c = key[begin], key[begin + size // 2], key[begin + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[group]
        less, equal = key < pivot, key == pivot
        n_less, n_equal = np.add.reduceat(less, begin, dtype=np.int64), np.add.reduceat(equal, begin, dtype=np.int64)
        rank = lambda mark: (total := np.cumsum(mark) - mark) - total[begin][group]
        greater = ~less & ~equal
        to = begin[group] + np.where(less, rank(less), np.where(equal, n_less[group] + rank(equal), (n_less + n_equal)[group] + rank(greater)))
        moved = np.empty_like(o)
        moved[to] = o
        order[live] = moved
        place = np.arange(len(live)) - begin[group]
        part = (place >= n_less[group]).astype(np.int64) + (place >= (n_less + n_equal)[group])
        sizes = np.stack([n_less, n_equal, size - n_less - n_equal])[part, group]
        head[live] = live[begin][group] + np.stack([np.zeros_like(n_less), n_less, n_less + n_equal])[part, group]
        level[live] = done + np.where(part == 1, width, 0)
        tied = sizes > 1
        same[live[tied & (level[live] >= depth)]] = True
        deep.append(live[tied & (level[live] >= stop) & (level[live] < depth)])
        live = live[tied & (level[live] < stop)]
    rest = np.sort(np.concatenate(deep)) if deep else live
    if len(rest):
        blind_tries(data, starts, depth, order, head, level, same, rest)
    same[same] = head[same] != np.flatnonzero(same)
    return order, same


def blind_tries(data: np.ndarray, starts: np.ndarray, depth: int, order: np.ndarray, head: np.ndarray, level: np.ndarray, same: np.ndarray, live: np.ndarray) -> None:
    """Orders the groups at ``live`` by a blind trie each, the branches of all tries of one generation at once.

    A node knows only the next byte at which its strings differ: all are compared with the first of them, the least difference is
    the node's place, and its children are told apart by the byte there, whatever lies between. Strings without a difference share a leaf.
    """
    view = np.lib.stride_tricks.sliding_window_view
    while len(live):
        begin, size, group = _groups(live, head)
        o, done = order[live], level[live]
        reach = int((depth - done).max())
        body = view(np.concatenate([data, np.zeros(reach, np.uint8)]), reach)[starts[o] + done]
        differ = (body != body[begin][group]) & (np.arange(reach)[None, :] < (depth - done)[:, None])
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), reach)
        branch = np.minimum.reduceat(first, begin)
        leaf = (branch == reach)[group]
        same[live[leaf]] = True
        fork = np.flatnonzero(~leaf)
        if not len(fork):
            return
        live, o, group, done = live[fork], o[fork], group[fork], done[fork] + branch[group[fork]]
        byte = data[starts[o] + done]
        sort = np.lexsort((byte, group))
        order[live] = o[sort]
        byte, group = byte[sort], group[sort]
        new = np.ones(len(live), bool)
        new[1:] = (group[1:] != group[:-1]) | (byte[1:] != byte[:-1])
        head[live] = np.maximum.accumulate(np.where(new, live, 0))
        level[live] = done + 1  # the place is the same for a whole group, so it needs no sorting
        count = np.diff(np.concatenate([np.flatnonzero(new), [len(live)]]))
        several = np.repeat(count > 1, count)
        whole = several & (level[live] >= depth)
        same[live[whole]] = True
        live = live[several & ~whole]


# --- bytes where copies differ -----------------------------------------------------------------


def _unit_chunks(docs: pa.Table, rows: np.ndarray, length: int, gram: int, limit: int = 1 << 19) -> Iterator[tuple]:
    """Units of the given rows, some texts at a time: (rows, buf, off, gram hash, unit hash, start, spanned, place in rows)."""
    part = docs.select(["text"]).take(pa.array(rows))
    at = 0
    for batch in part.combine_chunks().to_batches():
        for some, buf, off in chunks(iter([batch]), "text", limit):
            g, u, start, spanned, row = units(buf, off, length, gram)
            yield rows[at : at + some.num_rows], buf, off, g.view(np.int64), u.view(np.int64), start, spanned, row
            at += some.num_rows


def _mixed(key: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """One number for a (text key, unit hash) pair."""
    return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ unit.view(np.uint64)


def _among(x: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Whether each x is in the sorted array."""
    if not len(distinct):
        return np.zeros(len(x), bool)
    return distinct[np.minimum(np.searchsorted(distinct, x), len(distinct) - 1)] == x


def _extract(length: int, gram: int, bins: int):
    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not docs.num_rows or not asked.num_rows:
            return pa.Table.from_batches([flow([])])
        of_key, _, of_unit = documents_of(asked.column("payload").to_pylist(), 1)
        asked_units = np.unique(_mixed(of_key, of_unit))
        key, ident = docs.column("key").to_numpy(), docs.column("doc_id").fill_null(int(NO_ID)).to_numpy()
        got: list[tuple[np.ndarray, ...]] = []
        bodies: list[np.ndarray] = []
        for rows, buf, _, g, u, start, spanned, row in _unit_chunks(docs, np.flatnonzero(_among(key, np.unique(of_key))), length, gram):
            mix = _mixed(key[rows[row]], u)
            hit = np.flatnonzero(_among(mix, asked_units))
            hit = hit[np.unique(mix[hit], return_index=True)[1]]
            if len(hit):
                got.append((g[hit], u[hit], key[rows[row[hit]]], ident[rows[row[hit]]], spanned[hit]))
                bodies.append(buf[ranges(start[hit], spanned[hit])])
        if not got:
            return pa.Table.from_batches([flow([])])
        g, u, key, ident, spanned = (np.concatenate(x) for x in zip(*got, strict=True))
        data = np.concatenate(bodies)
        begin = np.cumsum(spanned) - spanned
        target = _bin(g, bins)
        rows = []
        for t in np.unique(target).tolist():
            i = np.flatnonzero(target == t)
            rows.append((t, BYTES, pack(g[i], u[i], key[i], ident[i], small(spanned[i])) + data[ranges(begin[i], spanned[i])].tobytes()))
        return pa.Table.from_batches([flow(rows)])

    return run


def _sort_windows(length: int, bins: int):
    def run(table: pa.Table) -> pa.Table:
        heads, bodies = [], []
        for p in table.column("payload").to_pylist():
            head, at = unpack(p, 5)
            heads.append(head)
            bodies.append(np.frombuffer(p, np.uint8, offset=at))
        g, u, key, ident, spanned = (np.concatenate(x) for x in zip(*heads, strict=True))
        spanned = spanned.astype(np.int64)
        data = np.concatenate([*bodies, np.zeros(PAD, np.uint8)])
        begin = np.cumsum(spanned) - spanned
        # units of one bin by gram hash, a few hundred thousand windows at a time
        order = np.argsort(g, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(g[order]) != 0, [True]]))
        windows = spanned - length + 1
        rows: list[tuple[int, int, bytes]] = []
        at = 0
        while at < len(cut) - 1:
            to = at + 1
            while to < len(cut) - 1 and windows[order[cut[at] : cut[to + 1]]].sum() < 400_000:
                to += 1
            part = order[cut[at] : cut[to]]
            at = to
            unit = np.repeat(part, windows[part])
            place = ranges(np.zeros(len(part), np.int64), windows[part])
            ranked, same = deep_shallow_sort(data, begin[unit] + place, length)
            unit, place = unit[ranked], place[ranked]
            run_of = np.cumsum(~same) - 1
            least = np.full(int(run_of[-1]) + 1, NO_ID)
            np.minimum.at(least, run_of, ident[unit])
            gone = ident[unit] > least[run_of]
            unit, place = unit[gone], place[gone]
            rows += dealt(_bucket(key[unit], bins), WINDOWS, key[unit], ident[unit], u[unit], small(place))
        return pa.Table.from_batches([flow(rows)])

    return run


def _remove(length: int, gram: int, keep_bytes: bool):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        key = docs.column("key").to_numpy()
        kind, payload = found.column("kind").to_pylist(), found.column("payload").to_pylist()
        s_key, _, s_unit = documents_of([p for k, p in zip(kind, payload, strict=True) if k == SETTLED], 1)
        w_key, _, w_unit, w_place = documents_of([p for k, p in zip(kind, payload, strict=True) if k == WINDOWS], 2)
        s_mix, w_mix = np.unique(_mixed(s_key, s_unit)), _mixed(w_key, w_unit)
        order = np.argsort(w_mix, kind="stable")
        w_mix, w_place = w_mix[order], w_place[order].astype(np.int64)
        touched = _among(key, np.unique(np.concatenate([s_key, w_key])))
        n = docs.num_rows
        n_bytes, removed, n_spans = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        digest, kept = [""] * n, [b""] * n

        def put(i: int, size: int, raw: bytes) -> None:
            n_bytes[i], removed[i] = size, size - len(raw)
            digest[i] = hashlib.sha256(raw).hexdigest()
            if keep_bytes:
                kept[i] = raw

        plain = np.flatnonzero(~touched)
        buf, off = text_buffer(docs.column("text").take(pa.array(plain)))
        for k, i in enumerate(plain.tolist()):
            put(i, int(off[k + 1] - off[k]), buf[off[k] : off[k + 1]].tobytes())
        for rows, buf, off, _, u, start, spanned, row in _unit_chunks(docs, np.flatnonzero(touched), length, gram):
            mix = _mixed(key[rows[row]], u)
            whole = np.flatnonzero(_among(mix, s_mix))
            low, high = np.searchsorted(w_mix, mix, "left"), np.searchsorted(w_mix, mix, "right")
            some = np.flatnonzero(high > low)
            windows = np.repeat(start[some], (high - low)[some]) + w_place[ranges(low[some], (high - low)[some])]
            total = int(off[-1])
            edge = np.bincount(np.concatenate([start[whole], windows]), minlength=total + 1) - np.bincount(np.concatenate([start[whole] + spanned[whole], windows + length]), minlength=total + 1)
            covered = np.cumsum(edge)[:total] > 0
            begins = covered.copy()
            begins[1:] &= ~covered[:-1]
            first = off[:-1][np.diff(off) > 0]
            begins[first] = covered[first]
            n_spans[rows] = np.diff(np.searchsorted(np.flatnonzero(begins), off))
            for k, i in enumerate(rows.tolist()):
                a, b = int(off[k]), int(off[k + 1])
                put(i, b - a, buf[a:b][~covered[a:b]].tobytes())
        out = [docs.column("doc_id"), pa.array(n_bytes), pa.array(removed), pa.array(n_spans), pa.array(digest, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        return pa.table([*out, pa.array(kept, pa.binary())] if keep_bytes else out, names=[*names, "kept"] if keep_bytes else names)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes): one row per row of ``docs``."""
    spark = docs.sparkSession
    gram = max(1, length // 2)
    bins = partitions(spark)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))
    entries = source.mapInArrow(_anchors(length, gram, bins), _FLOW)
    settled = checkpointed(entries.groupBy("target").applyInArrow(_settle(bins), _FLOW))
    by_bucket = source.withColumn("bucket", F.pmod("key", F.lit(bins).cast("long"))).groupBy("bucket")
    parts = by_bucket.cogroup(settled.where(F.col("kind") == ASKED).groupBy("target")).applyInArrow(_extract(length, gram, bins), _FLOW)
    windows = parts.groupBy("target").applyInArrow(_sort_windows(length, bins), _FLOW)
    found = settled.where(F.col("kind") == SETTLED).unionByName(windows)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_bytes else "")
    return by_bucket.cogroup(found.groupBy("target")).applyInArrow(_remove(length, gram, keep_bytes), schema)
