"""SimHash near-duplicates by segment popcounts.

Fingerprints: words of a text (A-Z lower-cased) make shingles of ``shingle`` words; bit b of the
64-bit fingerprint is 1 where over half of the shingles' XXH64 values have it. Numpy computes them
a chunk of documents at a time from the Arrow bytes.

Links (Hamming distance of ``radius`` = 3 or less) come from a segment-popcount embedding: each
2-bit segment becomes its bit count, so a fingerprint is a point of 32 small integers, and the
Manhattan distance of two points never exceeds the Hamming distance. Halve the 32 coordinates: of
a distance of at most 3, one half has at most 1. So a grid range-join probes, for each half, the
cell of the point itself and the cells one step down on one axis (the step up is the same pair seen
from the other side): at most 17 rows a half, whatever the data. Pairs that share a cell are checked
for the whole Manhattan bound and then exactly by XOR and bit count. Only distinct fingerprints take
part, so copies never meet each other.

Components: large-star / small-star contraction over the links of distinct fingerprints, each
round checkpointed; no component is gathered in one task or on the driver.

Defined cases: null or wordless text has fingerprint zero and links like any other; one or two words
make one shingle; null ids keep their row and never become a component id (a component of null ids
has a null id); repeated rows and ids are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._bytes import SPACED, chunks, joined_words, xxh64_spans
from ._spark import checkpointed, texts

SHINGLE, RADIUS, SEED = 3, 3, 42

_LANE = (np.arange(8, dtype=np.int64) * 256)[None, :]
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def shingle_hashes(buf: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row_off): XXH64 of each row's shingles in order, repeats included."""
    text, starts, ends, word_off = joined_words(buf, off, SPACED)
    n = np.diff(word_off)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    row_off = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(word_off[:-1] - row_off[:-1], count) + np.arange(row_off[-1])
    last = first + np.repeat(np.minimum(n, shingle), count) - 1
    return xxh64_spans(text, starts[first], ends[last] - starts[first], SEED), row_off


def fingerprints(hashes: np.ndarray, row_off: np.ndarray) -> np.ndarray:
    """Bit majorities of each row's hashes; zero for a row without any."""
    out = np.zeros(len(row_off) - 1, np.uint64)
    lanes = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    weight = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i in range(len(out)):
        a, b = row_off[i], row_off[i + 1]
        if a < b:
            seen = np.bincount((lanes[a:b] + _LANE).ravel(), minlength=2048).reshape(8, 256) @ _BITS
            out[i] = weight[(2 * seen.ravel()) > b - a].sum(dtype=np.uint64)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in chunks(batches, "text"):
        hashes, row_off = shingle_hashes(buf, off)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(fingerprints(hashes, row_off).view(np.int64))], names=["doc_id", "fp"])


def fingerprint_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    return texts(docs, doc_id, text).mapInArrow(_fingerprint_batches, "doc_id long, fp long")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The embedding: 32 counts (0 to 2) of each fingerprint, two bits a segment."""
    pairs = (fp[:, None] >> (np.arange(32, dtype=np.uint64) * np.uint64(2))[None, :]) & np.uint64(3)
    return np.array([0, 1, 1, 2], np.uint8)[pairs.astype(np.int64)]


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = (3 ** np.arange(16)).astype(np.int64)
    for batch in batches:
        fp = np.asarray(batch.column("fp")).view(np.uint64)
        for at in range(0, len(fp), 50_000):
            part = fp[at : at + 50_000]
            counts = segment_counts(part).astype(np.int64)
            for half in (0, 1):
                c = counts[:, 16 * half : 16 * half + 16]
                own = c @ base
                row, axis = np.nonzero(c)
                cell = np.concatenate([own, own[row] - base[axis]]) * 2 + half
                who = np.concatenate([part, part[row]])
                down = np.concatenate([np.zeros(len(part), bool), np.ones(len(row), bool)])
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(who.view(np.int64)), pa.array(down)], names=["cell", "fp", "down"])


def manhattan(a: Column, b: Column) -> Column:
    """The Manhattan distance of two fingerprints' embeddings: per 2-bit segment, 1 where the parities of the counts differ, 2 where one is full and the other empty."""
    low = F.lit(0x5555555555555555)
    odd = lambda x: x.bitwiseXOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low)
    full = lambda x: x.bitwiseAND(F.shiftrightunsigned(x, 1)).bitwiseAND(low)
    differ = odd(a).bitwiseXOR(odd(b))
    return F.bit_count(differ) + 2 * F.bit_count(full(a).bitwiseXOR(full(b)).bitwiseAND(F.bitwise_not(differ)))


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: distinct fingerprints at a Hamming distance of at most ``radius`` (3 at most)."""
    if radius > 3:
        raise ValueError("halves of the embedding cover a radius of 3 at most")
    cells = distinct.select("fp").mapInArrow(_cell_batches, "cell long, fp long, down boolean")
    own = cells.where(~F.col("down")).select("cell", F.col("fp").alias("a"))
    near = cells.select("cell", F.col("fp").alias("b"), "down")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = own.join(near, (own["cell"] == near["cell"]) & (F.col("down") | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b")) & (manhattan(F.col("a"), F.col("b")) <= radius) & (apart <= radius))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): root is the least node of each node's component; nodes without a link are absent.

    Minima are partial aggregates. They are stored before they are joined back, so that both sides of the join come straight from
    a shuffle and AQE can split a node with many neighbours.
    """
    edges = checkpointed(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        large = checkpointed(large)
        low = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = checkpointed(small)
        # a forest of stars: no node is both a leaf and a centre, and no leaf has two centres
        state = small.select(F.col("u").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(small.select(F.col("v").alias("n"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
        open_nodes = state.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).where((F.col("leaf") > 1) | ((F.col("leaf") == 1) & (F.col("centre") == 1)))
        edges = small
        if open_nodes.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def labelled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, root, component_id): one row per row; root is the component's least fingerprint, component_id its least id."""
    prints = checkpointed(fingerprint_table(docs, doc_id, text))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = checkpointed(components(links(distinct)))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = named.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    return labelled(docs, doc_id, text).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns kept: the least id's; of its rows one of the least fingerprint.

    A component of null ids alone keeps one row too.
    """
    chosen = labelled(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = chosen.groupBy("root").agg(F.min(F.struct("fp", "doc_id")).alias("x"))
    place = lambda i, p: F.xxhash64(F.coalesce(i.cast("string"), F.lit("-")), p)
    chosen = chosen.select(place(F.col("x.doc_id"), F.col("x.fp")).alias("__place"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in chunks(batches, text):
            prints = fingerprints(*shingle_hashes(buf, off)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(prints)], names=[*rows.schema.names, "__fp"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    printed = docs.mapInArrow(add, schema).withColumn("__place", place(F.col(doc_id), F.col("__fp")))
    return printed.join(chosen, "__place", "left_semi").dropDuplicates(["__place"]).drop("__place", "__fp")
