"""Benchmark decontamination with an FM-index per training shard.

A window is ``width`` consecutive words of a benchmark item (a shorter item is one window). Each map
task indexes its shard of documents as word symbols and backward-searches all distinct windows;
occurrences are located by sampled suffix positions and merged into spans of hit words.

Every word of a shard is in its index, with a separator after each document; the alphabet is that of the benchmark, and words
that no item has are separators too, as no window holds them. Words are compared by 64-bit hashes.

The benchmark is the query set. It reaches the tasks by broadcast in blocks of at most
``block_bytes`` of text (measured first; items are dealt to blocks by a hash), each block one pass
over the documents, one block after the other: a pass is stored and its block given up before the next is read. There is no
limit on the number of blocks.

Defined cases: null texts have no words; a null item id hits words but is not listed; repeated item
ids count once; repeated document rows are rows of their own; empty tables give no hits or no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import ALNUM, LOWER, chunks, code_points, hash_spans, merged, ranges, replace_column, text_array, text_buffer, words
from ._spark import checkpointed
from .fm_index import FMIndex

WIDTH = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = LOWER[buf]
    starts, ends, word_off = words(low, off, ALNUM)
    return hash_spans(low, starts, ends - starts), starts, ends, word_off


@dataclass
class Windows:
    """The windows of a block of items as symbol matrices by length."""

    vocabulary: np.ndarray  # sorted hashes; symbol = index + 1
    by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # length, patterns, item_off, items
    ids: list  # item id of each item


def build_windows(items: pa.Table, width: int) -> Windows:
    buf, off = text_buffer(items.column("text"))
    h, _, _, word_off = word_hashes(buf, off)
    vocabulary = np.unique(h)
    symbol = np.searchsorted(vocabulary, h) + 1
    n = np.diff(word_off)
    found: dict[int, tuple[list, list]] = {}
    for i in range(len(n)):
        a, b = word_off[i], word_off[i + 1]
        size = min(width, b - a)
        if size <= 0:
            continue
        rows = np.lib.stride_tricks.sliding_window_view(symbol[a:b], size)
        found.setdefault(int(size), ([], []))[0].append(rows)
        found[int(size)][1].append(np.full(len(rows), i))
    by_length = []
    for size, (rows, owner) in sorted(found.items()):
        patterns, of = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        owned = np.unique(np.stack([of.ravel(), np.concatenate(owner)], axis=1), axis=0)
        by_length.append((size, patterns.astype(np.int64), np.searchsorted(owned[:, 0], np.arange(len(patterns) + 1)), owned[:, 1]))
    return Windows(vocabulary, by_length, items.column("item_id").to_pylist())


def shard_symbols(h: np.ndarray, word_off: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, word): all words of the shard, a separator (symbol 0, word -1) after each document."""
    docs = len(word_off) - 1
    at = np.minimum(np.searchsorted(w.vocabulary, h), len(w.vocabulary) - 1)
    place = np.arange(len(h)) + np.repeat(np.arange(docs), np.diff(word_off))
    symbols, word = np.zeros(len(h) + docs, np.int64), np.full(len(h) + docs, -1, np.int64)
    symbols[place], word[place] = np.where(w.vocabulary[at] == h, at + 1, 0), np.arange(len(h))
    return symbols, word


def shard_hits(h: np.ndarray, word_off: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, item): merged spans of hit words, and distinct (row, item) pairs."""
    none = np.zeros(0, np.int64)
    if not len(h) or not len(w.vocabulary):
        return none, none, none, none
    symbols, word = shard_symbols(h, word_off, w)
    index = FMIndex(symbols, len(w.vocabulary))
    starts, ends, pairs = [], [], []
    for size, patterns, item_off, items in w.by_length:
        low, high = index.search(patterns)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        at = word[index.locate(ranges(low[hit], high[hit] - low[hit]))]
        pattern = np.repeat(hit, high[hit] - low[hit])
        starts.append(at)
        ends.append(at + size)
        row = np.searchsorted(word_off, at, "right") - 1
        once = np.unique(row * len(patterns) + pattern)
        row, pattern = once // len(patterns), once % len(patterns)
        owners = item_off[pattern + 1] - item_off[pattern]
        pairs.append(np.stack([np.repeat(row, owners), items[ranges(item_off[pattern], owners)]], axis=1))
    if not starts:
        return none, none, none, none
    start, end = merged(np.concatenate(starts), np.concatenate(ends))
    both = np.unique(np.concatenate(pairs), axis=0)
    return start, end, both[:, 0], both[:, 1]


def split_at_rows(start: np.ndarray, end: np.ndarray, word_off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans cut at row ends (touching spans of two rows were merged): (start, end, row)."""
    first = np.searchsorted(word_off, start, "right") - 1
    last = np.searchsorted(word_off, end, "left") - 1
    many = last - first + 1
    row = ranges(first, many)
    s, e = np.maximum(np.repeat(start, many), word_off[row]), np.minimum(np.repeat(end, many), word_off[row + 1])
    keep = s < e
    return s[keep], e[keep], row[keep]


def _scanner(block, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Windows = block.value
        for rows, buf, off in chunks(batches, "text", SHARD_BYTES):
            h, starts, ends, word_off = word_hashes(buf, off)
            a, b, row, item = shard_hits(h, word_off, w)
            a, b, span_row = split_at_rows(a, b, word_off)
            n = rows.num_rows
            span_off = np.searchsorted(span_row, np.arange(n + 1))
            item_off = np.searchsorted(row, np.arange(n + 1))
            names = [[str(w.ids[k]) for k in item[item_off[i] : item_off[i + 1]] if w.ids[k] is not None] if item_off[i] < item_off[i + 1] else [] for i in range(n)]
            lists = lambda x: pa.ListArray.from_arrays(pa.array(span_off, pa.int32()), pa.array(x, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("row"), pa.array(np.diff(word_off), pa.int64()), lists(a), lists(b), lists(starts[a] if len(a) else a), lists(ends[b - 1] if len(b) else b), pa.array(names, pa.list_(pa.string()))],
                names=["key", "row", "n_words", "first_word", "end_word", "first_byte", "end_byte", "items"],
            )

    return scan


SCAN_SCHEMA = "key long, row long, n_words long, first_word array<long>, end_word array<long>, first_byte array<long>, end_byte array<long>, items array<string>"


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The benchmark's items in blocks of ``block_bytes`` of text or less each (but for a larger single item)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-int(size) // block_bytes))
    return [items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) for k in range(blocks)]


def _shared(items: DataFrame, width: int):
    return items.sparkSession.sparkContext.broadcast(build_windows(items.toArrow(), width))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> tuple[int, DataFrame]:
    """(number of passes, a row per row of ``docs`` and pass: spans of hit words and the items found)."""
    blocks = _blocks(benchmark, block_bytes)
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    out = None
    for k, items in enumerate(blocks):
        block = _shared(items, width)
        found = source.mapInArrow(_scanner(block, width), SCAN_SCHEMA).withColumn("block", F.lit(k))
        if len(blocks) > 1:
            found = checkpointed(found)
            block.destroy()
        out = found if out is None else out.unionByName(found)
    return len(blocks), out


def _merge_blocks(found: DataFrame) -> DataFrame:
    """One row per document row again after several passes; equal rows have equal results and are counted, then repeated."""
    one = found.groupBy("key", "row", "block").agg(F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("spans").alias("spans"), F.first("items").alias("items"))
    rows = one.groupBy("key", "row").agg(F.first("copies").alias("copies"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    empty = F.slice("spans", 1, 0)
    joined = F.aggregate(
        F.array_sort("spans"),
        empty,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end_word"] >= x["first_word"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.get(acc, F.size(acc) - 1)["first_word"].alias("first_word"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["end_word"], x["end_word"]).alias("end_word"),
                        F.get(acc, F.size(acc) - 1)["first_byte"].alias("first_byte"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["end_byte"], x["end_byte"]).alias("end_byte"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return rows.withColumn("spans", joined).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_hit, items (distinct, sorted as strings), spans.

    A span is a maximal run of hit words: first_word and end_word number the words from 0,
    first_byte and end_byte are its UTF-8 byte offsets; ends are exclusive.
    """
    blocks, found = benchmark_hits(docs, benchmark, key, text, width, block_bytes)
    found = found.withColumn("spans", F.arrays_zip("first_word", "end_word", "first_byte", "end_byte"))
    if blocks > 1:
        found = _merge_blocks(found)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end_word"] - x["first_word"])
    return found.select("key", "n_words", hit.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"), "spans")


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", n_chars: str = "n_chars", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with every span of hit words cut out of the text and ``n_chars`` counted anew; other rows as they were.

    Several benchmark blocks are cut one after the other.
    """

    def cutter(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w: Windows = block.value
            for rows, buf, off in chunks(batches, text, SHARD_BYTES):
                h, starts, ends, word_off = word_hashes(buf, off)
                a, b, _, _ = shard_hits(h, word_off, w)
                if not len(a):
                    yield rows
                    continue
                a, b, row = split_at_rows(a, b, word_off)
                hit = np.unique(row)
                gone = np.zeros(int(off[-1]), bool)
                gone[ranges(starts[a], ends[b - 1] - starts[a])] = True
                parts = [buf[off[i] : off[i + 1]][~gone[off[i] : off[i + 1]]].tobytes() for i in hit.tolist()]
                yield exchanged(rows, hit, parts, text, n_chars)

        return run

    blocks = _blocks(benchmark, block_bytes)
    for items in blocks:
        block = _shared(items, width)
        docs = docs.mapInArrow(cutter(block), docs.schema)
        if len(blocks) > 1:
            docs = checkpointed(docs)
            block.destroy()
    return docs


def exchanged(rows: pa.RecordBatch, hit: np.ndarray, parts: list[bytes], text: str, n_chars: str) -> pa.RecordBatch:
    """The batch with new texts (and their lengths in code points) in the rows ``hit``."""
    mask = np.zeros(rows.num_rows, bool)
    mask[hit] = True
    old = rows.column(rows.schema.get_field_index(text))
    new = pc.replace_with_mask(old, pa.array(mask), text_array(parts).cast(old.type))
    size = rows.column(rows.schema.get_field_index(n_chars))
    return replace_column(rows, **{text: new, n_chars: pc.replace_with_mask(size, pa.array(mask), pa.array(code_points(parts)).cast(size.type))})
