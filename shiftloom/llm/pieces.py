"""SentencePiece encoding and decoding as a batched Viterbi in numpy, for BPE and for unigram models.

A text becomes units: a run of blanks (written U+2581, one more in front of a non-empty text) and the
characters up to the next run. No piece crosses from a character to a following blank, so units are
encoded independently, each distinct unit of a chunk once.

Units of equal length advance together. For each end position all substrings are probed by
polynomial hashes against the sorted hashes of the pieces, and vectorised maxima over the pieces that end there store the backpointer. Under a
unigram model a path's score is the sum of its pieces' scores. Under a BPE model a step scores 0 or minus
infinity: a piece may follow the best last piece of the prefix before it exactly when
merging the two side by side would leave them apart, which replaying both pieces' merges from the
cut outwards decides (``apart``). Exactly one last piece survives per prefix, and the path read back is the merge result of the
model itself, not an approximation of it.

A few long units of one length go through the same recurrence one position after another, with all their substrings probed at once; what they
give is the same. Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

from ._bytes import hash_spans, ranges

BLANK = 0x2581
#: From this length on, fewer than FEW units of a length are taken one by one.
LONG, FEW = 48, 32
#: What a character outside the vocabulary costs below the least score (fixed value of the format).
UNKNOWN = 10.0
UNIGRAM, BPE = 1, 2
KEEP_UNITS = 1_200_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MOD = 1 << 64
_SLOTS = 20


def _string_hash(codes: list[int]) -> int:
    h = 0
    for c in codes:
        h = (h * _BASE + c + 1) % _MOD
    return h


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at += 1
        if not data[at - 1] & 128:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(number, value) of the fields of a message: a number, or the bytes of a nested one."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def model_type(proto: bytes) -> int:
    """UNIGRAM or BPE: field 3 of the training settings (field 2) of a model file (fixed numbers of the format; unigram if not set)."""
    settings = next((v for n, v in _fields(proto) if n == 2), b"")
    return next((v for n, v in _fields(settings) if n == 3), UNIGRAM)


@dataclass
class PieceModel:
    """What encoding and decoding need of a model file, as arrays; token numbers here are piece ids."""

    pieces: list[str]
    rank: np.ndarray  # merge order of a piece by score; -1 for single characters
    kind: np.ndarray  # 0 usable, 1 byte, 2 other (control, unknown, never produced)
    byte_id: np.ndarray  # id of each byte piece
    left: np.ndarray = field(default=None)
    right: np.ndarray = field(default=None)
    keys: np.ndarray = field(default=None)
    key_ids: np.ndarray = field(default=None)
    slots: np.ndarray = field(default=None)
    size: np.ndarray = field(default=None)
    hashes: np.ndarray = field(default=None)
    longest: int = 0
    score: np.ndarray = field(default=None)  # of a unigram model; null for BPE
    lost: float = 0.0  # score of a character outside the vocabulary
    pairs: dict = field(default_factory=dict)  # pairs of pieces already decided by ``apart``

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        return cls.of(sentencepiece.SentencePieceProcessor(model_file=path))

    @classmethod
    def of(cls, m) -> PieceModel:
        """From a model that the library has read."""
        n = m.vocab_size()
        pieces = [m.id_to_piece(i) for i in range(n)]
        kind = np.zeros(n, np.int8)
        byte_id = np.full(256, m.unk_id(), np.int64)
        for i, p in enumerate(pieces):
            if m.is_byte(i):
                kind[i], byte_id[int(p[3:5], 16)] = 1, i
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                kind[i] = 2
        return cls.build(pieces, np.array([m.get_score(i) for i in range(n)]), kind, byte_id, model_type(m.serialized_model_proto()))

    @classmethod
    def build(cls, pieces: list[str], scores: np.ndarray, kind: np.ndarray, byte_id: np.ndarray, algorithm: int = BPE) -> PieceModel:
        n = len(pieces)
        _, order = np.unique(-scores, return_inverse=True)  # equal scores share a rank
        rank = np.where(np.array([len(p) for p in pieces]) == 1, -1, order)
        m = cls(pieces, rank.astype(np.int64), kind.copy(), byte_id)
        m.by_text = {p: i for i, p in enumerate(pieces) if kind[i] == 0}
        m.left, m.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        if algorithm == UNIGRAM:
            m.score = scores.astype(np.float64)
            m.lost = float(scores[kind == 0].min(initial=0.0)) - UNKNOWN
        for p, i in m.by_text.items() if algorithm == BPE else ():
            if len(p) > 1:
                parts, last = m.merge(p)
                if len(parts) == 1 and last is not None:
                    m.left[i], m.right[i] = last
                else:
                    m.kind[i] = 2
        usable = [i for i in range(n) if m.kind[i] == 0]
        hashes = np.array([_string_hash([ord(c) for c in pieces[i]]) for i in usable], np.uint64)
        at = np.argsort(hashes)
        m.keys, m.key_ids = hashes[at], np.array(usable, np.int64)[at]
        m.hashes = np.zeros(n, np.uint64)
        m.hashes[usable] = hashes
        m.slots = np.zeros(1 << _SLOTS, bool)
        m.slots[(m.keys >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True
        m.size = np.array([len(p) for p in pieces], np.int64)
        m.longest = int(m.size[usable].max(initial=1))
        return m

    def merge(self, unit: str) -> tuple[list[int], tuple[int, int] | None]:
        """(ids, the two parts of the last merge): best score first, then leftmost; -1 - c stands for a character c outside the vocabulary."""
        known = self.by_text
        text, left, right = list(unit), list(range(-1, len(unit) - 1)), list(range(1, len(unit) + 1))
        heap: list[tuple[int, int, int, str]] = []

        def push(i: int) -> None:
            j = right[i]
            if j < len(text) and (got := known.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (int(self.rank[got]), i, j, text[i] + text[j]))

        for i in range(len(text) - 1):
            push(i)
        last = None
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not text[i] or right[i] != j or not text[j] or text[i] + text[j] != both:
                continue
            last = (known.get(text[i], -1), known.get(text[j], -1))
            text[i], text[j] = both, ""
            right[i] = right[j]
            if right[j] < len(text):
                left[right[j]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return [known.get(x, -1 - ord(x[0])) for x in text if x], last

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        out = np.full(h.shape, -1, np.int64)
        maybe = np.flatnonzero(self.slots[(h >> np.uint64(64 - _SLOTS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        good = self.keys[at] == h[maybe]
        out[maybe[good]] = self.key_ids[at[good]]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging piece a followed by piece b leaves them apart; -1 is a character outside the vocabulary.

        Both pieces' merges are undone from the cut outwards, latest first. Whenever the parts that
        then touch make a piece that ranks before the next merge undone, that merge would have come first.
        """
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        x, y = a[live].copy(), b[live].copy()
        big = np.int64(1) << 40
        limit = np.full(len(live), big)
        power = self._powers
        while len(live):
            joined = self.hashes[x] * power[self.size[y]] + self.hashes[y]
            both = self.probe(joined)
            lost = (both >= 0) & (2 * self.rank[np.maximum(both, 0)] < limit)
            ok[live[lost]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = lost | ((rx < 0) & (ry < 0))
            undo_left = rx > ry  # the left piece was made later; of equal ranks the leftmost merge comes first
            limit = np.where(undo_left, 2 * rx, 2 * ry + 1)
            nx = np.where(undo_left, self.right[x], x)
            ny = np.where(undo_left, y, self.left[y])
            keep = ~done
            live, x, y, limit = live[keep], nx[keep], ny[keep], limit[keep]
        return ok

    @property
    def _powers(self) -> np.ndarray:
        if getattr(self, "_pow", None) is None:
            out = [1]
            for _ in range(self.longest + 1):
                out.append(out[-1] * _BASE % _MOD)
            self._pow = np.array(out, np.uint64)
        return self._pow

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many each) of units of one length, one a row of ``codes``; -3 - c for a character outside the vocabulary."""
        m, n = codes.shape
        power = self._powers
        prefix = np.zeros((n + 1, m), np.uint64)
        for k in range(n):
            prefix[k + 1] = prefix[k] * np.uint64(_BASE) + codes[:, k].astype(np.uint64) + np.uint64(1)
        last = np.full((n + 1, m), -1, np.int64)  # best last piece of each prefix; -1: a character outside the vocabulary
        step = np.ones((n + 1, m), np.int64)  # its length: the backpointer
        (self._scored_steps if self.score is not None else self._merged_steps)(prefix, power, last, step)
        at = np.full(m, n)
        back, rows = [], np.arange(m)
        while True:
            live = at > 0
            if not live.any():
                break
            ids = np.where(live, last[at, rows], -2)
            missing = live & (ids == -1)
            ids[missing] = -3 - codes[rows[missing], at[missing] - 1].astype(np.int64)
            back.append(ids)
            at = np.where(live, at - step[at, rows], 0)
        table = np.stack(back[::-1], axis=1)
        real = table != -2
        return table[real], real.sum(axis=1)

    def _merged_steps(self, prefix: np.ndarray, power: np.ndarray, last: np.ndarray, step: np.ndarray) -> None:
        n, m = prefix.shape[0] - 1, prefix.shape[1]
        for j in range(1, n + 1):
            open_rows = np.arange(m)
            for size in range(min(j, self.longest), 0, -1):
                i = j - size
                piece = self.probe(prefix[j, open_rows] - prefix[i, open_rows] * power[size])
                hit = np.flatnonzero(piece >= 0)
                if not len(hit):
                    continue
                rows = open_rows[hit]
                fits = np.ones(len(hit), bool) if i == 0 else self.apart(last[i, rows], piece[hit])
                rows = rows[fits]
                last[j, rows], step[j, rows] = piece[hit][fits], size
                taken = np.zeros(m, bool)
                taken[rows] = True
                open_rows = open_rows[~taken[open_rows]]
                if not len(open_rows):
                    break

    def _scored_steps(self, prefix: np.ndarray, power: np.ndarray, last: np.ndarray, step: np.ndarray) -> None:
        n, m = prefix.shape[0] - 1, prefix.shape[1]
        best = np.zeros((n + 1, m))
        for j in range(1, n + 1):
            best[j] = best[j - 1] + self.lost
            for size in range(1, min(j, self.longest) + 1):
                piece = self.probe(prefix[j] - prefix[j - size] * power[size])
                total = best[j - size] + np.where(piece >= 0, self.score[np.maximum(piece, 0)], -np.inf)
                better = total > best[j]
                best[j, better], last[j, better], step[j, better] = total[better], piece[better], size

    def one_long(self, codes: np.ndarray) -> np.ndarray:
        """Ids of one unit (-3 - c for a character outside the vocabulary): all substrings probed at once, then position by position."""
        n = len(codes)
        ends: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]  # (size, piece) of the pieces that end there, the longest first
        h = np.zeros(n, np.uint64)
        found = []
        for size in range(1, min(self.longest, n) + 1):
            h = h[: n - size + 1] * np.uint64(_BASE) + codes[size - 1 :].astype(np.uint64) + np.uint64(1)
            found.append(self.probe(h))
        for size in range(len(found), 0, -1):
            for i in np.flatnonzero(found[size - 1] >= 0).tolist():
                ends[i + size].append((size, int(found[size - 1][i])))
        last, step, best = [-1] * (n + 1), [1] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            if self.score is not None:
                best[j] = best[j - 1] + self.lost
                for size, piece in reversed(ends[j]):
                    if best[j - size] + self.score[piece] > best[j]:
                        best[j], last[j], step[j] = best[j - size] + self.score[piece], piece, size
                continue
            for size, piece in ends[j]:
                if size == j or self._stay_apart(last[j - size], piece):
                    last[j], step[j] = piece, size
                    break
        out, at = [], n
        while at:
            out.append(last[at] if last[at] >= 0 else -3 - int(codes[at - 1]))
            at -= step[at]
        return np.array(out[::-1], np.int64)

    def _stay_apart(self, a: int, b: int) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            got = self.pairs[a, b] = bool(self.apart(np.array([a]), np.array([b]))[0])
        return got

    def unit_ids(self, codes: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many each) of units, by length; bytes for characters outside the vocabulary."""
        flat, count, order = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in np.unique(lens).tolist():
            who = np.flatnonzero(lens == n)
            if n > LONG and len(who) < FEW:
                for k in who.tolist():
                    flat.append(self.one_long(codes[starts[k] : starts[k] + n]))
                    count.append(np.array([len(flat[-1])]))
                    order.append(np.array([k]))
                continue
            each = max(1, min(20_000, 4_000_000 // n))
            for at in range(0, len(who), each):
                part = who[at : at + each]
                ids, size = self.viterbi(codes[starts[part][:, None] + np.arange(n)[None, :]])
                flat.append(ids)
                count.append(size)
                order.append(part)
        ids, size, who = self._with_bytes(np.concatenate(flat), np.concatenate(count)) + (np.concatenate(order),)
        place = np.argsort(who, kind="stable")
        begin = np.cumsum(size) - size
        return ids[ranges(begin[place], size[place])], size[place]

    def _with_bytes(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary become the byte pieces of their UTF-8 form."""
        foreign = np.flatnonzero(ids < 0)
        if not len(foreign):
            return ids, count
        parts = [self.byte_id[list(chr(-3 - c).encode("utf-8", "replace"))] for c in ids[foreign].tolist()]
        size = np.ones(len(ids), np.int64)
        size[foreign] = [len(x) for x in parts]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.repeat(ids, size)
        out[ranges(ends[foreign], size[foreign])] = np.concatenate(parts)
        bounds = ends[np.concatenate([[0], np.cumsum(count)])]
        return out, np.diff(bounds)


class Encoder:
    """Encodes and decodes chunks; keeps the ids of units already met (at most ``keep``, then starts anew)."""

    def __init__(self, model: PieceModel, keep: int = KEEP_UNITS):
        self.model, self.keep = model, keep
        self._forget()
        parts = []
        for i, p in enumerate(model.pieces):
            parts.append(bytes([int(p[3:5], 16)]) if model.kind[i] == 1 else b"" if p in ("<unk>", "<s>", "</s>") else p.replace("▁", " ").encode())
        self.piece_off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        self.piece_bytes = np.frombuffer(b"".join(parts), np.uint8)

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.off = np.zeros(1, np.int64)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row_off) of the rows of a chunk."""
        n = int(off[-1])
        codes = np.frombuffer(buf[:n].tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")
        before = np.zeros(n + 1, np.int64)
        np.cumsum((buf[:n] & 0xC0) != 0x80, out=before[1:])
        rows = before[off]  # row bounds in code points
        size = np.diff(rows)
        full = size > 0
        new_off = rows + np.concatenate([[0], np.cumsum(full)])
        text = np.full(int(new_off[-1]) + 16, BLANK, np.uint32)
        text[ranges(new_off[:-1] + full, size)] = codes
        total = int(new_off[-1])
        body = text[:total]
        body[body == 32] = BLANK
        blank = body == BLANK
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[new_off[:-1][full]] = True
        starts = np.flatnonzero(start)
        lens = np.diff(np.concatenate([starts, [total]]))
        which = self._units(text, starts, lens)
        count = self.off[which + 1] - self.off[which]
        ids = self.ids[ranges(self.off[which], count)]
        unit_off = np.searchsorted(starts, new_off)
        token_off = np.concatenate([[0], np.cumsum(count)])
        return ids, token_off[unit_off]

    def _units(self, text: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The place of each unit in the store, after unknown ones were encoded."""
        h = hash_spans(text.view(np.uint8), starts * 4, lens * 4)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > max(self.keep, len(distinct)):
            self._forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        have = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        fresh = np.flatnonzero(~have)
        if len(fresh):
            new, size = self.model.unit_ids(text, starts[first[fresh]], lens[first[fresh]])
            base = len(self.off) - 1
            self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(size)])
            self.ids = np.concatenate([self.ids, new.astype(np.int32)])
            known, slot = np.concatenate([self.known, distinct[fresh]]), np.concatenate([self.slot, base + np.arange(len(fresh))])
            order = np.argsort(known)
            self.known, self.slot = known[order], slot[order]
        return self.slot[np.searchsorted(self.known, distinct)][inverse]

    def decode(self, ids: np.ndarray, row_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, off): the rows' texts; the blank put in front of a text goes again."""
        size = self.piece_off[ids + 1] - self.piece_off[ids]
        out = self.piece_bytes[ranges(self.piece_off[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        off = ends[row_off]
        lead = off[:-1][(np.diff(off) > 0)]
        lead = lead[out[lead] == 32]
        drop = np.zeros(len(out) + 1, np.int64)
        drop[lead + 1] = 1
        keep = np.ones(len(out), bool)
        keep[lead] = False
        return out[keep], off - np.cumsum(drop)[off]

    def spans(self, ids: np.ndarray, row_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code point spans of the tokens within their rows; a character's byte pieces share its span."""
        size = self.model.size[ids].copy()
        is_byte = self.model.kind[ids] == 1
        at = np.flatnonzero(is_byte)
        value = self.piece_bytes[self.piece_off[ids[at]]]
        lead = (value & 0xC0) != 0x80
        size[at] = lead  # a byte piece that continues a character has no length of its own
        ends = np.cumsum(size)
        base = np.concatenate([[0], ends])[row_off[:-1]]
        row = np.repeat(np.arange(len(row_off) - 1), np.diff(row_off))
        end = ends - base[row] - 1  # the blank in front stands before position 0
        start = end - size
        start[at[~lead]] = end[at[~lead]] - 1
        return np.maximum(start, 0), np.maximum(end, 0)
