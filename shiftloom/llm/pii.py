"""Personal data: exact base patterns, and a linear-chain CRF over word shapes for what they miss.

Base kinds (email, ip, card, phone) follow their patterns leftmost and non-overlapping per kind;
matches that fail their check are dropped. They are found from their rarest byte (``@``, the first
digit of a run, ``+``), so cost is linear in the text.

The CRF labels every word of every text. Its spans (email and phone in unusual spellings, id, secret, person,
birth) are added where they overlap no base span. It is trained on the driver from the small labelled table.

Defined cases: null and empty texts have no spans; offsets are code points, ends exclusive; spans
never cross documents; repeated rows are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._bytes import SPACED, byte_class, char_positions, chunks, words
from ._spark import texts
from .decontaminate import exchanged
from .crf import KINDS, LABELS, MOST_WORDS, Emitter, LinearChainCRF, labelled_table

#: Kinds in the order in which spans of one start are listed.
ORDER = ("email", "ip", "card", "phone", *(k for k in KINDS if k not in ("email", "phone")))
_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = byte_class(lambda b: 48 <= b <= 57)


def luhn(digits: bytes) -> bool:
    d = np.frombuffer(digits, np.uint8).astype(np.int64)[::-1] - 48
    d[1::2] *= 2
    return int((d - 9 * (d > 9)).sum()) % 10 == 0


def base_spans(data: bytes, buf: np.ndarray, off: np.ndarray) -> list[tuple[int, str, int, int]]:
    """(row, kind, start, end) in bytes of the chunk, per row and kind in order."""
    out = []
    n = int(off[-1])
    row_of = lambda at: int(np.searchsorted(off, at, "right")) - 1
    last, before = 0, -1
    for at in np.flatnonzero(buf[:n] == 64).tolist():
        row = row_of(at)
        floor = max(int(off[row]), last, before + 1)
        before = at
        if at < last:
            continue
        local = data[floor:at]
        size = len(local) - len(local.rstrip(_LOCAL))
        if size and (m := _DOMAIN.match(data, at + 1, int(off[row + 1]))):
            out.append((row, "email", at - size, m.end()))
            last = m.end()
    digit = _DIGIT[buf[:n]]
    edge = np.zeros(n, np.uint8)
    edge[1:] = digit[:-1]
    edge[off[off < n]] = 0
    last_ip = last_card = 0
    for at in np.flatnonzero(digit > edge).tolist():
        row = row_of(at)
        end = int(off[row + 1])
        if at >= last_ip and (m := _IP.match(data, at, end)):
            last_ip = m.end()
            if all(len(p.lstrip(b"0")) <= 3 and int(p[-20:]) <= 255 for p in m.group().split(b".")):
                out.append((row, "ip", at, m.end()))
        if at >= last_card and (m := _CARD.match(data, at, end)):
            last_card = m.end()
            digits = m.group().replace(b" ", b"").replace(b"-", b"")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((row, "card", at, m.end()))
    last = 0
    for at in np.flatnonzero(buf[:n] == 43).tolist():
        row = row_of(at)
        if at >= last and (m := _PHONE.match(data, at, int(off[row + 1]))):
            last = m.end()
            if 10 <= sum(48 <= c <= 57 for c in m.group()) <= 15:
                out.append((row, "phone", at, m.end()))
    return out


def crf_spans(model: LinearChainCRF, emitter: Emitter, data: bytes, buf: np.ndarray, off: np.ndarray) -> list[tuple[int, str, int, int]]:
    """(row, kind, start, end) in bytes of the chunk, from Viterbi over all words."""
    starts, ends, word_off = words(buf, off, SPACED)
    if not len(starts):
        return []
    label = model.decode(emitter(buf, starts, ends, word_off), word_off)
    out = []
    for i in np.flatnonzero((label > 0) & (label % 2 == 1)).tolist():  # the begin labels
        row = int(np.searchsorted(word_off, i, "right")) - 1
        j = i + 1
        while j < word_off[row + 1] and label[j] == label[i] + 1:
            j += 1
        if j - i > MOST_WORDS:
            continue
        a, b = int(starts[i]), int(ends[j - 1])
        while a < b and data[a] in b"\"'<([{" and not (data[a] in b"(" and data[a + 1 : a + 2].isdigit()):
            a += 1
        while a < b and data[b - 1] in b".,;:!?\"'>)]}":
            b -= 1
        if a < b:
            out.append((row, LABELS[label[i]][2:], a, b))
    return out


def find_spans(model: LinearChainCRF, emitter: Emitter, buf: np.ndarray, off: np.ndarray) -> tuple[list[list[tuple[str, int, int]]], list[list[tuple[str, int, int]]]]:
    """(base, all) spans of each row in bytes of the chunk, by start, then kind."""
    n = len(off) - 1
    data = buf[: int(off[-1])].tobytes()
    base: list[list] = [[] for _ in range(n)]
    for row, kind, a, b in base_spans(data, buf, off):
        base[row].append((kind, a, b))
    every = [list(x) for x in base]
    for row, kind, a, b in crf_spans(model, emitter, data, buf, off):
        if all(b <= c or d <= a for _, c, d in every[row]):
            every[row].append((kind, a, b))
    by = lambda s: (s[1], ORDER.index(s[0]), s[2])
    return [sorted(x, key=by) for x in base], [sorted(x, key=by) for x in every]


def _finder(model: LinearChainCRF):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitter = Emitter(model.emission)
        for rows, buf, off in chunks(batches, "text"):
            base, every = find_spans(model, emitter, buf, off)
            n = rows.num_rows
            counts = np.zeros((4, n), np.int64)
            digest, said = [hashlib.sha256(b"").hexdigest()] * n, [""] * n
            touched = [i for i in range(n) if every[i]]
            if touched:
                chars = char_positions(buf, off)
                write = lambda i, spans: ",".join(f"{k}:{chars[a] - chars[off[i]]}:{chars[b] - chars[off[i]]}" for k, a, b in spans)
                for i in touched:
                    for kind, _, _ in base[i]:
                        counts[ORDER.index(kind), i] += 1
                    digest[i] = hashlib.sha256(write(i, base[i]).encode()).hexdigest()
                    said[i] = write(i, every[i])
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c) for c in counts), pa.array(digest), pa.array(said, pa.string())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return find


@functools.cache
def train() -> LinearChainCRF:
    """The model of the labelled table (the same in every process)."""
    return LinearChainCRF.fit(labelled_table())


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: LinearChainCRF | None = None) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans (``kind:start:end`` joined by commas), a row per row."""
    return texts(docs, doc_id, text).mapInArrow(_finder(model or train()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(buf: np.ndarray, begin: int, end: int, spans: list[tuple[str, int, int]]) -> bytes:
    """The bytes with every span replaced by ``<KIND>``; overlapping spans become the first one's mark."""
    parts, at = [], begin
    for kind, a, b in spans:
        if a >= at:
            parts += [buf[at:a].tobytes(), f"<{kind.upper()}>".encode()]
        at = max(at, b)
    return b"".join([*parts, buf[at:end].tobytes()])


def mask(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", model: LinearChainCRF | None = None) -> DataFrame:
    """``docs`` with personal data in the text replaced by marks and ``n_chars`` counted anew; other rows as they were."""
    model = model or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitter = Emitter(model.emission)
        for rows, buf, off in chunks(batches, text):
            _, every = find_spans(model, emitter, buf, off)
            hit = np.array([i for i, spans in enumerate(every) if spans], np.int64)
            yield exchanged(rows, hit, [masked(buf, int(off[i]), int(off[i + 1]), every[i]) for i in hit.tolist()], text, n_chars) if len(hit) else rows

    return docs.mapInArrow(run, docs.schema)
