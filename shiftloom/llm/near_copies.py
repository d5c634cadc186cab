"""Near-copies by exact Jaccard similarity of word shingles, each pair of the whole table.

The shingles of a text (XXH64 of ``SHINGLE`` words, A-Z lower-cased) are a set; texts of equal sets are
one node. Two sets of n and m shingles are near-copies if 5 * common >= 4 * union (Jaccard 0.8 or more).
Of such a pair each set holds at least 4/5 of the other's size in common, so under any order of all
shingles that both follow, the first n // 5 + 1 of one and the first m // 5 + 1 of the other have one in
common. Only these meet; the order puts shingles of crowded hash bins last (counted on the
cluster, ``BINS`` bins), which saves pairs and loses none. Sizes and the places of a common shingle rule
out further pairs. So does a sketch of each set: bit b of ``SKETCH`` is the parity of the shingles that
hash to it, the XOR of two sketches is the sketch of what the sets do not share, and its bit count never
exceeds their number, which is at most (n + m) / 9 in a near-copy. The rest are checked on the whole sets.

Pairs come from op5's operator first: SimHash fingerprints of the sets, linked at ``simhash.RADIUS`` bits by segment popcounts, each
link checked on the whole sets. A near-copy can differ in more bits than these, so the shingles above give the rest, in
two passes. The first compares a shingle's holders with the one before and with the
first, by size and by a hash of shingle and set, so that a set meets other partners at each of its shingles:
a group of n near-copies costs at most 4 n pairs a shingle and is mostly one component. The second compares all holders that are not yet in one component, so the components are those of all pairs;
of two groups only members that the other group's sketches do not rule out are paired.

Defined cases: one to four words make one shingle; null and wordless texts are one node; null ids keep
one row of a component only if it has no other id; repeated rows are near-copies; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ._bytes import chunks
from ._spark import checkpointed, texts
from .simhash import components, fingerprints, links, shingle_hashes

SHINGLE, BINS, SLICE, MARKS, CHUNK, SKETCH = 5, 1 << 22, 1 << 16, 1 << 24, 1 << 20, 256
WORDS = [f"s{i}" for i in range(SKETCH // 64)]


def shingle_sets(buf: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, hashes, set_off): each row's distinct shingles in ascending order, and a 64-bit key of the set."""
    h, row_off = shingle_hashes(buf, off, shingle)
    row = np.repeat(np.arange(len(off) - 1), np.diff(row_off))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    once = np.ones(len(h), bool)
    once[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[once], row[once]
    set_off = np.searchsorted(row, np.arange(len(off)))
    mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return (total[set_off[1:]] - total[set_off[:-1]]).view(np.int64), h, set_off


def sketches(h: np.ndarray, set_off: np.ndarray) -> np.ndarray:
    """(sets, words): parities of each set's hashes by their top bits."""
    rows = len(set_off) - 1
    at = np.repeat(np.arange(rows), np.diff(set_off)) * SKETCH + (h >> np.uint64(56)).astype(np.int64)
    odd = (np.bincount(at, minlength=rows * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").reshape(rows, len(WORDS))


def _bin(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BINS - 1)).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BINS, np.uint32)
    for _, buf, off in chunks(batches, "text", CHUNK):
        used, n = np.unique(_bin(shingle_sets(buf, off)[1]), return_counts=True)
        counts[used] += n.astype(np.uint32)
    for at in range(0, BINS, SLICE):
        used = np.flatnonzero(counts[at : at + SLICE])
        if len(used):
            body = used.astype("<u2").tobytes() + counts[at + used].astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([body], pa.binary())], names=["at", "counts"])


def _add_counts(table: pa.Table) -> pa.Table:
    total = np.zeros(SLICE, np.int64)
    for body in table.column("counts").to_pylist():
        n = len(body) // 6
        total[np.frombuffer(body, "<u2", n)] += np.frombuffer(body, "<u4", n, 2 * n)
    return pa.table([pa.array([table.column("at")[0].as_py()]), pa.array([total.tobytes()], pa.binary())], names=["at", "counts"])


def crowding(rows: DataFrame) -> np.ndarray:
    """Sets that hold a shingle of each hash bin."""
    out = np.zeros(BINS, np.uint32)
    for r in rows.mapInArrow(_count_batches, "at long, counts binary").groupBy("at").applyInArrow(_add_counts, "at long, counts binary").collect():
        out[r.at : r.at + SLICE] = np.minimum(np.frombuffer(r.counts, np.int64), (1 << 32) - 1)
    return out


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in chunks(batches, "text", CHUNK):
        key, h, set_off = shingle_sets(buf, off)
        words = [pa.array(np.ascontiguousarray(w)) for w in sketches(h, set_off).T]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(key), pa.array(np.diff(set_off).astype(np.int32)), pa.array(fingerprints(h, set_off).view(np.int64)), *words], names=["doc_id", "key", "n", "fp", *WORDS])


def _prefix_pass(crowded):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, off in chunks(batches, "text", CHUNK):
            key, h, set_off = shingle_sets(buf, off)
            n = np.diff(set_off)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, crowded.value[_bin(h)], row))
            place = np.arange(len(h)) - set_off[row]
            fresh = np.zeros(len(n), bool)  # equal sets of a chunk once
            fresh[np.unique(key, return_index=True)[1]] = True
            take = (place <= (n // 5)[row]) & fresh[row]
            r = row[take]
            yield pa.RecordBatch.from_arrays([pa.array(h[order][take].view(np.int64)), pa.array(key[r]), pa.array(n[r].astype(np.int32)), pa.array(place[take].astype(np.int32))], names=["token", "key", "n", "place"])

    return run


def _marks(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the low bits of ``keys``: a sieve, not a proof of membership."""
    at = F.col("key").bitwiseAND(F.lit(MARKS - 1)) + 1
    found = keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros(MARKS // 8, np.uint8)
    for r in found:
        body = np.frombuffer(r.bits, np.uint8)
        out[(r.bucket - 1) * 4096 :][: len(body)] = body
    return out


def _set_pass(marks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, off in chunks(batches, "text", CHUNK):
            key, h, set_off = shingle_sets(buf, off)
            low = key & (MARKS - 1)
            fresh = np.zeros(len(key), bool)
            fresh[np.unique(key, return_index=True)[1]] = True
            sets = pa.ListArray.from_arrays(pa.array(set_off.astype(np.int32)), pa.array(h.view(np.int64)))
            whole = pa.RecordBatch.from_arrays([pa.array(key), sets], names=["key", "shingles"])
            yield whole.filter(pa.array(fresh & ((marks.value[low >> 3] >> (low & 7)) & 1).astype(bool)))

    return run


def _near(common: Column, n: Column, m: Column) -> Column:
    return 9 * common >= 4 * (n + m)


def _possible(x: Column, y: Column) -> Column:
    """Whether a common shingle at these places, if the first one, leaves enough for both."""
    return _near(F.least(x["n"] - x["place"], y["n"] - y["place"]), x["n"], y["n"])


def _apart(x: Column, y: Column) -> Column:
    """Shingles that two sets do not share, at least."""
    return sum((F.bit_count(x[w].bitwiseXOR(y[w])) for w in WORDS[1:]), F.bit_count(x[WORDS[0]].bitwiseXOR(y[WORDS[0]])))


def _groups_apart(x: Column, y: Column) -> Column:
    """The same for any two members: only bits that all members of a group agree on count (``all_``: AND, ``any_``: OR of the sketches)."""
    unsure = lambda g, w: g[f"any_{w}"].bitwiseXOR(g[f"all_{w}"])
    sure = lambda w: F.bitwise_not(unsure(x, w).bitwiseOR(unsure(y, w)))
    counts = [F.bit_count(x[f"all_{w}"].bitwiseXOR(y[f"all_{w}"]).bitwiseAND(sure(w))) for w in WORDS]
    return sum(counts[1:], counts[0])


def _kept(members: str, group: str, n: Column) -> Column:
    """Members of one group that may be near some member of the other."""
    g = F.col(group)
    sure = lambda w: F.bitwise_not(g[f"any_{w}"].bitwiseXOR(g[f"all_{w}"]))
    apart = lambda m: sum((F.bit_count(m[w].bitwiseXOR(g[f"all_{w}"]).bitwiseAND(sure(w))) for w in WORDS[1:]), F.bit_count(m[WORDS[0]].bitwiseXOR(g[f"all_{WORDS[0]}"]).bitwiseAND(sure(WORDS[0]))))
    return F.filter(members, lambda m: 9 * apart(m) <= n)


def print_pairs(named: DataFrame) -> DataFrame:
    """(a, b): keys of sets whose fingerprints link, by the least key of each fingerprint; those of one fingerprint with its least."""
    prints = checkpointed(named.groupBy("fp").agg(F.min("key").alias("first")))
    same = named.select("fp", "key").distinct().join(prints, "fp").where("key != first").select(F.col("first").alias("a"), F.col("key").alias("b"))
    linked = links(prints.select("fp")).join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b")
    return same.unionByName(linked.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def _checked(pairs: DataFrame, body: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are near; only sets of such pairs are shuffled."""
    pairs = checkpointed(pairs.distinct())
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    marks = body.sparkSession.sparkContext.broadcast(_marks(keys))
    sets = body.mapInArrow(_set_pass(marks), "key long, shingles array<long>").join(keys, "key", "left_semi").dropDuplicates(["key"])
    of = lambda x: sets.select(F.col("key").alias(x), F.col("shingles").alias(f"of_{x}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    return met.where(_near(F.size(F.array_intersect("of_a", "of_b")), F.size("of_a"), F.size("of_b"))).select("a", "b")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x["key"], y["key"]).alias("a"), F.greatest(x["key"], y["key"]).alias("b")]


def near_roots(rows: DataFrame, named: DataFrame) -> DataFrame:
    """(key, root) of the keys that have a near-copy; ``rows``: doc_id, text; ``named``: their keys, fingerprints and sketches."""
    body = rows.select("text")
    prints = named.select("key", F.struct("n", *WORDS).alias("print")).dropDuplicates(["key"])
    crowded = rows.sparkSession.sparkContext.broadcast(crowding(body))
    whole = W.partitionBy("token")
    met = body.mapInArrow(_prefix_pass(crowded), "token long, key long, n int, place int")
    met = met.withColumns({"low": F.min("key").over(whole), "high": F.max("key").over(whole)}).where("low != high")
    met = checkpointed(met.select("token", "key", "n", "place").dropDuplicates(["token", "key"]))
    x, y = F.col("x"), F.col("y")
    by_size, dealt = whole.orderBy("n", "key"), whole.orderBy(F.xxhash64("token", "key"), "key")
    own = F.struct("key", "n", "place")
    pairs = met.select("token", "n", "key", own.alias("x")).select("x", F.array(*[f("x").over(order) for order in (by_size, dealt) for f in (F.lag, F.first)]).alias("ys")).select("x", F.explode("ys").alias("y"))
    pairs = pairs.where((x["key"] != y["key"]) & _possible(x, y)).select(*_ordered(x, y)).unionByName(print_pairs(named)).distinct()
    px, py = F.col("px"), F.col("py")
    sketched = pairs.join(prints.toDF("a", "px"), "a").join(prints.toDF("b", "py"), "b")
    found = _checked(sketched.where(9 * _apart(px, py) <= px["n"] + py["n"]).select("a", "b"), body)
    first = checkpointed(components(found).withColumnRenamed("node", "key"))
    # members of a component alike in size and place stay together, and none meets its own component
    bits = [f(F.col("print")[w]).alias(f"{name}_{w}") for w in WORDS for name, f in (("all", F.bit_and), ("any", F.bit_or))]
    member = F.struct("key", *[F.col("print")[w].alias(w) for w in WORDS])
    rooted = met.join(first, "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = rooted.withColumns({"low": F.min("root").over(whole), "high": F.max("root").over(whole)}).where("low != high")
    groups = rooted.join(prints, "key").groupBy("token", "root", "n", "place").agg(F.collect_list(member).alias("members"), *bits)
    groups = checkpointed(groups)
    sizes = F.struct("root", "n", "place", *[f"{name}_{w}" for w in WORDS for name in ("all", "any")])
    left, right = (groups.select("token", sizes.alias(s), F.col("members").alias(f"of_{s}")) for s in "xy")
    both = left.join(right, "token").where((x["root"] < y["root"]) & _possible(x, y) & (9 * _groups_apart(x, y) <= x["n"] + y["n"]))
    nm = x["n"] + y["n"]
    both = both.select(nm.alias("nm"), _kept("of_x", "y", nm).alias("of_x"), _kept("of_y", "x", nm).alias("of_y")).where((F.size("of_x") > 0) & (F.size("of_y") > 0))
    both = both.select("nm", "of_y", F.explode("of_x").alias("mx")).select("nm", "mx", F.explode("of_y").alias("my"))
    mx, my = F.col("mx"), F.col("my")
    across = both.where(9 * _apart(mx, my) <= F.col("nm")).select(*_ordered(mx, my))
    more = _checked(across, body)
    root = lambda s: first.select(F.col("key").alias(s), F.col("root").alias(f"root_{s}"))
    more = more.join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("root_a", "a").alias("u"), F.coalesce("root_b", "b").alias("v"))
    joined = checkpointed(components(more.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()))
    last = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    every = first.unionByName(joined.select(F.col("node").alias("key"), F.col("node").alias("root"))).distinct()
    return every.join(last, "root", "left").select("key", F.coalesce("top", "root").alias("root")).groupBy("key").agg(F.min("root").alias("root"))


def labelled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, root, component_id): one row per row; component_id is the least id of the component."""
    rows = texts(docs, doc_id, text)
    named = checkpointed(rows.mapInArrow(_key_batches, f"doc_id long, key long, n int, fp long, {', '.join(f'{w} long' for w in WORDS)}"))
    least = named.groupBy("key").agg(F.min("doc_id").alias("least_id"))
    least = checkpointed(least.join(near_roots(rows, named), "key", "left").withColumn("root", F.coalesce("root", "key")))
    ids = least.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return named.select("doc_id", "key").join(least.join(ids, "root").select("key", "root", "component_id"), "key").select("doc_id", "key", "root", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns kept: the least id's; of its rows one of the least key."""
    chosen = labelled(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = chosen.groupBy("root").agg(F.min(F.struct("key", "doc_id")).alias("x"))
    place = lambda i, k: F.xxhash64(F.coalesce(i.cast("string"), F.lit("-")), k)
    chosen = chosen.select(place(F.col("x.doc_id"), F.col("x.key")).alias("_place"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in chunks(batches, text, CHUNK):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(shingle_sets(buf, off)[0])], names=[*rows.schema.names, "_key"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_key", T.LongType())])
    keyed = docs.mapInArrow(add, schema).withColumn("_place", place(F.col(doc_id), F.col("_key")))
    return keyed.join(chosen, "_place", "left_semi").dropDuplicates(["_place"]).drop("_place", "_key")
