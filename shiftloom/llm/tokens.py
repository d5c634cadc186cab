"""Token columns: whole texts to piece ids and back, and token counts by field and section.

The model file is read once on the driver and its arrays are broadcast (their size is the
vocabulary's, not the data's). Each Python worker keeps its own store of units already encoded.

Attribution (``section_tokens``): a row's document is its fields that have characters, one blank apart, encoded once; as a
text is encoded with a blank in front, each field gets the tokens it has by itself (unless the field before ends in a blank).
Sections are the fields, each cut after every line feed; the blank before a field belongs to it and is no character of it. Token character
spans and section spans are two sorted interval lists, joined by position search. A token that crosses a boundary goes to
the section that holds most of its characters, the earlier one on a tie; a token without characters
of its own (a later byte of a character, a blank in front) goes where it stands. So the sections'
counts add up to the row's tokens.

Defined cases: null and empty texts have no tokens (``token_ids`` empty) and null fields are empty
sections; texts are never cut; repeated rows and ids are rows of their own; U+2581 in a text is
encoded like a blank, so it decodes to a blank; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._bytes import chunks, ranges
from ._spark import texts
from .pieces import Encoder, PieceModel

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_ENCODERS: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder a worker process and model, whatever the number of tasks it runs."""
    key = shared.value[0]
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value[1])
    return _ENCODERS[key]


def share_model(spark, path: str):
    return spark.sparkContext.broadcast((path, PieceModel.load(path)))


def encode_texts(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, token_ids: the ids of each whole text."""
    shared = share_model(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for rows, buf, off in chunks(batches, "text"):
            ids, row_off = encoder.encode(buf, off)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(row_off, pa.int32()), pa.array(ids, pa.int32()))], names=["doc_id", "token_ids"])

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, token_ids array<int>")


def with_tokens(docs: DataFrame, model: str = MODEL, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and token_ids in place of the text."""
    shared = share_model(docs.sparkSession, model)
    kept = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for rows, buf, off in chunks(batches, text):
            ids, row_off = encoder.encode(buf, off)
            columns = [rows.column(rows.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(row_off)), pa.ListArray.from_arrays(pa.array(row_off, pa.int32()), pa.array(ids, pa.int32()))], names=[*(f.name for f in kept), "n_tokens", "token_ids"])

    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode_tokens(tokens: DataFrame, model: str = MODEL, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text: the texts of ``token_ids``; a null list gives the empty text."""
    shared = share_model(tokens.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            lists = batch.column("token_ids")
            size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            out, off = encoder.decode(np.asarray(lists.flatten()).astype(np.int64), np.concatenate([[0], np.cumsum(size)]))
            words = [out[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("token_ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def token_digests(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_bytes, ids_sha256 (of the ids in decimal, comma-joined), round_trip (decoding gives the text again)."""
    shared = share_model(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        names = np.array([str(i) for i in range(len(encoder.model.pieces))])
        width = names.dtype.itemsize // 4
        flat = np.frombuffer(names.astype(f"S{width}").tobytes(), np.uint8).reshape(-1, width)
        size = (flat != 0).sum(axis=1)
        for rows, buf, off in chunks(batches, "text"):
            ids, row_off = encoder.encode(buf, off)
            back, back_off = encoder.decode(ids, row_off)
            # "id," for every token: digits from a table, laid end to end
            length = size[ids] + 1
            end = np.cumsum(length)
            said = np.full(int(end[-1]) if len(end) else 0, 44, np.uint8)
            spot = np.arange(width)[None, :] < size[ids][:, None]
            said[ranges(end - length, length - 1)] = flat[ids][spot]
            ends = np.concatenate([[0], end])[row_off]
            raw = said.tobytes()
            digests = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            same = [back_off[i + 1] - back_off[i] == off[i + 1] - off[i] and np.array_equal(back[back_off[i] : back_off[i + 1]], buf[off[i] : off[i + 1]]) for i in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(row_off)), pa.array(np.diff(off)), pa.array(digests, pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "n_bytes", "ids_sha256", "round_trip"])

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, n_bytes long, ids_sha256 string, round_trip boolean")


def attribute(start: np.ndarray, end: np.ndarray, row_off: np.ndarray, bounds: np.ndarray, bound_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary).

    ``start``, ``end``: spans of tokens of all rows; ``bounds``: ends of each row's sections in order,
    row r's at bound_off[r]:bound_off[r + 1]; all positions count from the row's start.
    """
    row = np.repeat(np.arange(len(row_off) - 1), np.diff(row_off))
    far = np.int64(max(int(bounds.max(initial=0)), int(end.max(initial=0))) + 2)
    flat = bounds + np.repeat(np.arange(len(bound_off) - 1), np.diff(bound_off)) * far
    low, high = bound_off[row], bound_off[row + 1] - 1
    first = np.clip(np.searchsorted(flat, start + row * far, "right"), low, high)
    last = np.clip(np.searchsorted(flat, np.maximum(end - 1, start) + row * far, "right"), low, high)
    section, crosses = first.copy(), last > first
    at = np.flatnonzero(crosses)
    if len(at):
        many = last[at] - first[at] + 1
        token, piece = np.repeat(at, many), ranges(first[at], many)
        begins = np.where(piece == first[token], start[token], bounds[np.maximum(piece - 1, 0)])
        length = np.minimum(bounds[piece], end[token]) - begins
        best = np.lexsort((piece, -length, token))  # the earliest of the longest comes first
        section[at] = piece[best][np.searchsorted(token[best], at)]
    return section, crosses


def section_tokens(docs: DataFrame, fields: tuple[str, ...] = ("text",), model: str = MODEL, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, field, section, n_chars, n_tokens, n_crossing: one row per row of ``docs``, field and section.

    ``section`` numbers a field's lines from 0; a field without characters has one section. n_crossing
    counts tokens given to the section that cross a boundary.
    """
    shared = share_model(docs.sparkSession, model)
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for rows, buf, off in chunks(batches, "joined"):
            ids, row_off = encoder.encode(buf, off)
            start, end = encoder.spans(ids, row_off)
            n, total = rows.num_rows, int(off[-1])
            before = np.zeros(total + 1, np.int64)
            np.cumsum((buf[:total] & 0xC0) != 0x80, out=before[1:])
            size = np.stack([np.asarray(rows.column(f"size{k}")).astype(np.int64) for k in range(len(names))], axis=1)
            gap = (size > 0) & (np.cumsum(size, axis=1) > size)  # fields with a blank before them
            edge = before[off[:-1]][:, None] + np.cumsum(size + gap, axis=1)  # ends of fields, in code points of the chunk
            line = before[np.flatnonzero(buf[:total] == 10) + 1]
            line_row = np.searchsorted(before[off], line, "left") - 1
            keep = ~np.isin(line, edge)  # a line feed that ends its field ends no further section
            at = np.concatenate([edge.ravel(), line[keep]])
            of = np.concatenate([np.repeat(np.arange(n), len(names)), line_row[keep]])
            field = np.concatenate([np.tile(np.arange(len(names)), n), (edge[line_row[keep]] < line[keep][:, None]).sum(axis=1)])
            order = np.lexsort((at, field, of))
            at, of, field = at[order], of[order], field[order]
            bound_off = np.searchsorted(of, np.arange(n + 1))
            bounds = at - before[off[:-1]][of]
            section, crosses = attribute(start, end, row_off, bounds, bound_off)
            new = np.concatenate([[True], (of[1:] != of[:-1]) | (field[1:] != field[:-1])]) if len(of) else np.zeros(0, bool)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(of)), 0)) if len(of) else of
            left = np.where(np.concatenate([[True], of[1:] != of[:-1]]), 0, np.concatenate([[0], bounds[:-1]])) if len(of) else bounds
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(of)), pa.array(np.array(names, dtype=object)[field], pa.string()), pa.array(np.arange(len(of)) - begin), pa.array(bounds - left - np.where(begin == np.arange(len(of)), gap[of, field], 0)), pa.array(np.bincount(section, minlength=len(of))), pa.array(np.bincount(section[crosses], minlength=len(of)))],
                names=["doc_id", "field", "section", "n_chars", "n_tokens", "n_crossing"],
            )

    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in names]
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]).alias("joined"), *(F.length(p).alias(f"size{k}") for k, p in enumerate(parts)))
    return source.mapInArrow(run, "doc_id long, field string, section long, n_chars long, n_tokens long, n_crossing long")
