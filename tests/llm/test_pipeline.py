import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shiftloom.llm import near_copies, registry
from tests.llm.conftest import prose

DATA = "/root/testdata/sf0.001"
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def test_ten_operators_and_the_pipeline_are_registered():
    q = entry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in q if n.startswith("op")} == {str(i) for i in range(1, 11)} and "pipeline" in q
    assert set(entry.oracle_sql()) <= set(q) and set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, DATA).cache()
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert sum(labels[d] == 1 for d in kept if d in labels) >= 0.98 * sum(v == 1 for v in labels.values())
    once = stages["near_dedup"](spark, good, DATA).cache()
    assert once.columns == docs.columns and once.select("doc_id").distinct().count() == once.count()
    clean = stages["decontaminate"](spark, once, DATA).cache()
    assert clean.count() == once.count()
    items = [re.findall(WORD, r.text.lower()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    windows = {" ".join(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    for r in clean.collect():
        words = re.findall(WORD, r.text.lower())
        assert not windows & {" ".join(words[i : i + 10]) for i in range(len(words))} and r.n_chars == len(r.text)
    masked = stages["pii"](spark, clean, DATA).cache()
    assert masked.columns == docs.columns and not masked.where(F.col("text").rlike(r"[a-z0-9]@[a-z0-9]+\.")).count()
    out = stages["tokens"](spark, masked, DATA)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids"] and out.where(F.size("token_ids") != F.col("n_tokens")).count() == 0


def test_stages_equal_their_rows_taken_one_by_one(spark):
    """Quality against scores of single texts, personal data against the spans of single texts, token ids against the library."""
    import numpy as np
    import pyarrow as pa
    import sentencepiece

    from shiftloom.llm import byte_cnn, crf, pii, tokens
    from shiftloom.llm._bytes import text_buffer

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows, stages = docs.collect(), dict(corpus_pipeline.STAGES)
    weights = byte_cnn.train_quality(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    buffers = {r.doc_id: text_buffer(pa.array([r.text], pa.string())) for r in rows}
    want = {d for d, b in buffers.items() if byte_cnn.score(weights, *b)[0] >= 0.3}
    assert {r.doc_id for r in stages["quality"](spark, docs, DATA).collect()} == want
    model = pii.train()
    masked = {r.doc_id: r.text for r in stages["pii"](spark, docs, DATA).collect()}
    for d, (buf, off) in buffers.items():
        _, every = pii.find_spans(model, crf.Emitter(model.emission), buf, off)
        out, at = b"", 0
        for kind, a, b in every[0]:
            out += (buf[at:a].tobytes() + f"<{kind.upper()}>".encode()) if a >= at else b""
            at = max(at, b)
        assert masked[d] == (out + buf[at : int(off[-1])].tobytes()).decode()
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    texts_ = {r.doc_id: r.text for r in rows}
    assert all(list(r.token_ids) == sp.encode(texts_[r.doc_id] or "") for r in stages["tokens"](spark, docs, DATA).collect())
    assert np.isfinite(weights.share)


@pytest.mark.parametrize("empty", [True, False])
def test_run_and_empty_table(spark, empty):
    if not empty:
        assert corpus_pipeline.run(spark, DATA).count() > 100
        return
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.count() == 0


def shingles(t):
    w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def first_of_near_copies(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), (True, 0)), (d is None, d or 0))
    return sorted(str(None if none else d) for none, d in least.values())


def test_near_dedup_finds_every_pair_at_jaccard_four_fifths(spark, odd_docs, no_docs):
    r, rows, line = random.Random(11), [], prose(1, 30)
    for i in range(25):
        w = prose(700 + i, r.randint(25, 160)).split()
        rows.append((i * 10, " ".join(w) + (" " + line if i % 3 else "")))
        for j in range(1, 6):
            v = list(w)
            for at in r.sample(range(len(v)), r.randint(1, 1 + len(v) // 25)):
                v[at] = f"changed{j}"
            rows.append((i * 10 + j, " ".join(v[: len(v) - r.randint(0, 3)]) + (" " + line if i % 3 else "")))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = sorted(str(x.doc_id) for x in near_dedup(spark, docs, DATA).collect())
    assert got == first_of_near_copies(rows) and 25 < len(got) < len(rows)
    odd = near_copies.keep_first(odd_docs)
    assert odd.columns == odd_docs.columns and near_copies.keep_first(no_docs).count() == 0
    assert sorted(str(x.doc_id) for x in odd.collect()) == first_of_near_copies([(x.doc_id, x.text) for x in odd_docs.collect()])


def test_sketches_never_claim_more_than_two_sets_differ_by(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(400)]
    sets = [sorted({*base[: r.randint(0, 400)], *(r.getrandbits(64) for _ in range(r.choice((0, 1, 5, 40))))}) for _ in range(60)]
    off = np.cumsum([0, *map(len, sets)])
    words = near_copies.sketches(np.array([h for x in sets for h in x], np.uint64), off).tolist()
    rows = spark.createDataFrame([(i, i % 12, *w) for i, w in enumerate(words)], ["i", "g", *near_copies.WORDS])
    x, y = F.col("x"), F.col("y")
    one = rows.select("i", F.struct(*near_copies.WORDS).alias("w"))
    met = one.toDF("a", "x").crossJoin(one.toDF("b", "y")).select("a", "b", near_copies._apart(x, y).alias("n")).collect()
    assert all(m.n <= len(set(sets[m.a]) ^ set(sets[m.b])) for m in met) and sum(m.n > 20 for m in met) > 100
    bits = [f(w).alias(f"{name}_{w}") for w in near_copies.WORDS for name, f in (("all", F.bit_and), ("any", F.bit_or))]
    groups = rows.groupBy("g").agg(*bits)
    groups = groups.select("g", F.struct(*groups.columns[1:]).alias("w"))
    least = {(m.a, m.b): m.n for m in met}
    far = groups.toDF("a", "x").crossJoin(groups.toDF("b", "y")).select("a", "b", near_copies._groups_apart(x, y).alias("n")).collect()
    assert all(m.n <= min(least[i, j] for i in range(m.a, 60, 12) for j in range(m.b, 60, 12)) for m in far)


def test_near_dedup_links_fingerprints_first(spark):
    """The pairs of op5's operator: texts within three bits and texts of one fingerprint."""
    base = prose(40, 600).split()
    said = [" ".join(base), " ".join([*base[:-1], "changed"]), " ".join([*base[:-1], "other"]), prose(41, 300)]
    rows = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    words = ", ".join(f"{w} long" for w in near_copies.WORDS)
    named = rows.mapInArrow(near_copies._key_batches, f"doc_id long, key long, n int, fp long, {words}").cache()
    at = {r.key: (r.doc_id, r.fp) for r in named.collect()}
    got = {tuple(sorted((r.a, r.b))) for r in near_copies.print_pairs(named).collect()}
    apart = lambda a, b: ((at[a][1] ^ at[b][1]) & (2**64 - 1)).bit_count()
    assert got and all(apart(a, b) <= 3 for a, b in got) and not any(3 in (at[a][0], at[b][0]) for a, b in got)
    met = {at[k][0] for pair in got for k in pair}
    assert met == {0, 1, 2}


def test_members_that_another_group_rules_out_are_not_paired(spark):
    r = random.Random(6)
    base = [r.getrandbits(64) for _ in range(90)]
    sets = [sorted({*base[i:], *(r.getrandbits(64) for _ in range(i))}) for i in (0, 2, 4, 6, 8, 60, 70, 80)]
    words = near_copies.sketches(np.array([h for x in sets for h in x], np.uint64), np.cumsum([0, *map(len, sets)])).tolist()
    rows = spark.createDataFrame([(i, *w) for i, w in enumerate(words)], ["key", *near_copies.WORDS])
    members = rows.agg(F.collect_list(F.struct("key", *near_copies.WORDS)).alias("of_x"))
    group = rows.where("key = 0").select(F.struct(*[F.col(w).alias(f"{name}_{w}") for w in near_copies.WORDS for name in ("all", "any")]).alias("y"))
    kept = members.crossJoin(group).select(near_copies._kept("of_x", "y", F.lit(180)).alias("k")).first().k
    near = {i for i, x in enumerate(sets) if 9 * len(set(x) & set(sets[0])) >= 4 * (len(x) + len(sets[0]))}
    assert near <= {m.key for m in kept} and not {5, 6, 7} & {m.key for m in kept}


def test_the_driver_collects_between_steps(spark):
    from shiftloom.plans import shared

    kinds = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(k.getCollectionCount() for k in kinds if "Old" in k.getName() or "MarkSweep" in k.getName())
    time.sleep(2)
    before = whole()
    rows = shared.checkpointed(spark.range(5000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert whole() > before
    assert not shared.swept(spark, 60.0)  # not again so soon
    assert rows.count() == 7 and rows.where("count > 0").count() == 7
