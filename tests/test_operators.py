from collections import Counter

import pytest
from pyspark.sql import functions as F

from shiftloom.functions import clean, formulas, spectrum, text
from shiftloom.operators import cluster, dataset, enrich, ingest, precedents


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# --- datasets --------------------------------------------------------------------------------------


def clustered(spark, sizes):
    return spark.createDataFrame([(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))], "id long, cluster string")


@pytest.mark.parametrize(("sizes", "n", "want"), [({"a": 4, "b": 4, "c": 4}, 6, [2, 2, 2]), ({"a": 10, "b": 4, "c": 2}, 9, [2, 3, 4]), ({"a": 10, "b": 1}, 50, [1, 10]), ({"a": 3}, 0, [])])
def test_balanced_sample_quota(spark, sizes, n, want):
    got = dataset.sample(clustered(spark, sizes), n, 1, "id", "cluster").collect()
    assert sorted(Counter(r.cluster for r in got).values()) == want


def test_sample_falls_back_and_refuses(spark):
    df = clustered(spark, {"a": 5, "b": 1}).withColumn("cluster", F.when(F.col("id") > 0, F.col("cluster")))
    assert dataset.sample(df, 2, 1, "id", "cluster").count() == 2 and not dataset.check_labels(df, "cluster")
    with pytest.raises(ValueError):
        dataset.sample(df, -1, 1, "id")


def test_views(spark):
    df = dataset.in_memory(spark, [{"id": i, "value": i * i} for i in range(6)], "id long, value long")
    ids = lambda x: [r.id for r in x.collect()]
    assert ids(dataset.select(df, [4, 0, 2])) == [4, 0, 2] and ids(dataset.item(df, -1)) == [5] and ids(dataset.select(df, [])) == []
    with pytest.raises(IndexError):
        dataset.select(df, [6])
    assert ids(dataset.take(df, 3, ["row_id"])) == [0, 1, 2] and dataset.head(df, 99, ["row_id"]).count() == 6
    assert sorted(ids(dataset.shuffle(df, 3, "id"))) == list(range(6)) and ids(dataset.shuffle(df, 3, "id")) == ids(dataset.shuffle(df.repartition(5), 3, "id"))
    assert ids(dataset.where(df, lambda r: r["value"] > 10).orderBy("id")) == [4, 5] == ids(dataset.where(df, F.col("value") > 10).orderBy("id"))
    assert [r.y for r in dataset.map_rows(df, lambda r: {"y": r["id"] + 1}, "y long").orderBy("y").collect()] == [1, 2, 3, 4, 5, 6]
    assert dataset.positions(df.limit(0), ["id"], "p").count() == 0


def test_positions_and_splits_of_many_rows(spark):
    df = spark.range(200_000).withColumn("k", F.xxhash64("id"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    placed = dataset.positions(df, ["k", "id"], "p")
    seen = placed.agg(F.countDistinct("p").alias("n"), F.min("p").alias("a"), F.max("p").alias("b")).first()
    assert (seen.n, seen.a, seen.b) == (200_000, 0, 199_999)
    assert placed.where("p < 3").orderBy("p").select("id").collect() == df.orderBy("k", "id").limit(3).select("id").collect()
    assert dataset.slice_rows(placed, 70_000, 130_000, "p").count() == 60_000
    for sizes in ({"train": 60_000, "test": 30_000, "sft": 60_000}, {"train": 9_000, "test": 10}):
        got = {r.split: r.n for r in dataset.disjoint_splits(df, sizes, 1, "id").groupBy("split").agg(F.countDistinct("id").alias("n")).collect()}
        assert got == sizes
    big = dataset.sample(df, 50_000, 1, "id").select("id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(big) == 50_000 and {r.id for r in big[:10]} <= {r.id for r in dataset.sample(df, 100_000, 1, "id").select("id").collect()}


def test_splits_need_enough_rows(spark):
    with pytest.raises(ValueError):
        dataset.disjoint_splits(spark.range(5), {"train": 4, "test": 2}, 1, "id")
    got = Counter(r.split for r in dataset.disjoint_splits(spark.range(9), {"train": 4, "test": 2}, 1, "id").collect())
    assert got == {"train": 4, "test": 2}


# --- ingest ----------------------------------------------------------------------------------------

BASE = dict(Filename="f.pdf", SMILES="c1ccccc1C", Page_in_file_mol=1.0, Page_in_file_para=1, Location_in_page_mol="[]", Location_in_page_para="[]", NMR_type="1H NMR", NMR_frequency="400 MHz", NMR_solvent="CDCl3", NMR_shift_text="3.70 (q, 2H), 1.20 (t, 3H)", NMR_note=None, NMR_processed="[('q', [], '2H', 3.7, 3.7), ('t', [], '3H', 1.2, 1.2)]", Atom_number=7, Atom_number_diff_env=5, Atom_number_abstract=7.0)
REVIEW = dict(smiles_actual="Cc1ccccc1", text_in_pdf="x", nmr_frequency_right="right", nmr_solvent_right="right", nmr_processed_right="right", is_same_molecule=True, is_same_skeleton=True, num_chiral_centers=0)


def table(spark, rows):
    kinds = {k: "bigint" if k in ("Page_in_file_para", "Atom_number", "Atom_number_diff_env", "num_chiral_centers") else "double" if k in ("Page_in_file_mol", "Atom_number_abstract") else "boolean" if k.startswith("is_same") else "string" for k in rows[0]}
    df = spark.createDataFrame([tuple(r[k] for k in kinds) + (i,) for i, r in enumerate(rows)], ", ".join(f"{k} {v}" for k, v in kinds.items()) + ", row_index bigint")
    return df.withColumn("source_ord", F.lit(0))


def ingested(spark, rows, **o):
    options = ingest.IngestOptions(**o)
    every = ingest.records(table(spark, rows), "set", "train", "src", options)
    return every, ingest.merge_records(every.where("drop_reason is null"), options)


def test_review_wins_and_raw_is_kept(spark):
    every, _ = ingested(spark, [BASE | REVIEW])
    r = every.first()
    assert r.gt_smiles == "Cc1ccccc1" and r.provenance.smiles_raw == "c1ccccc1C" and r.sample_id == "set:train:src:0" and r.quality.is_same_molecule
    assert r.nmr.processed == '[["q",[],"2H",3.7,3.7],["t",[],"3H",1.2,1.2]]'
    assert ingested(spark, [BASE])[0].first().quality is None


@pytest.mark.parametrize(
    ("rows", "options", "reason"),
    [
        ([BASE | REVIEW, BASE | REVIEW | {"SMILES": "", "smiles_actual": "nan"}], {}, "empty"),
        ([BASE | REVIEW, BASE | REVIEW | {"nmr_solvent_right": " Wrong"}], {}, "qc"),
        ([BASE | REVIEW, BASE | REVIEW | {"is_same_skeleton": False}], {"quality": "same_skeleton"}, "quality"),
        ([BASE, BASE | {"NMR_type": "13C NMR"}], {"nmr_types": ("1H NMR",)}, "type"),
    ],
)
def test_drop_reasons(spark, rows, options, reason):
    every, _ = ingested(spark, rows, **options)
    assert [r.drop_reason for r in every.orderBy("row_index").collect()] == [None, reason]
    total = next(r for r in ingest.summary(every, ["source"]).collect() if r.source is None)
    assert total.kept == 1 and total[f"dropped_{reason}"] == 1
    if reason == "qc":
        assert ingested(spark, rows, drop_wrong=False)[0].where("drop_reason is null").count() == 2


def test_merge_counts_and_cap(spark):
    rows = [BASE | {"SMILES": s, "NMR_type": t} for s, t in (("CCO", "1H NMR"), ("CCN", "1H NMR"), ("CCO", "13C NMR"), ("CCC", "1H NMR"), ("CCO", "1H NMR"))]
    _, merged = ingested(spark, rows)
    got = {r.gt_smiles: r for r in merged.collect()}
    assert len(got) == 3 and [b.type for b in got["CCO"].nmr_list] == ["1H NMR", "13C NMR", "1H NMR"] and got["CCO"].merged_sample_ids == [f"set:train:src:{i}" for i in (0, 2, 4)] and got["CCC"].merged_sample_ids is None
    counts = ingest.merge_counts(merged).first()
    assert (counts.merged_groups, counts.merged_into) == (1, 2)
    assert [r.gt_smiles for r in ingested(spark, rows, max_records=2)[1].orderBy("row_index").collect()] == ["CCO", "CCN"]


def test_schema_errors(spark):
    with pytest.raises(ValueError, match="SMILES"):
        ingest.reviewed([c for c in ingest.BASE_COLUMNS if c != "SMILES"])
    with pytest.raises(ValueError, match="smiles_actual"):
        ingest.reviewed([*ingest.BASE_COLUMNS, "text_in_pdf"])
    with pytest.raises(ValueError):
        ingest.IngestOptions(quality="good")


# --- functions -------------------------------------------------------------------------------------


def test_peaks_and_numbers(spark):
    assert one(spark, spectrum.split_peaks(F.lit("7.26 (d, J = 8.0, 2H), 1.2 [a, (b, c), d], , 3.3"))) == ["7.26 (d, J = 8.0, 2H)", "1.2 [a, (b, c), d]", "3.3"]
    assert one(spark, spectrum.split_peaks(F.lit("a), b, (c, d"))) == ["a)", "b", "(c, d"] and one(spark, spectrum.split_peaks(F.lit(""))) == []
    assert one(spark, spectrum.digits_only(F.lit("8.52-8.49 (m), -63.4 (s)"))) == "8.52 8.49 -63.4"
    assert one(spark, spectrum.spectrum_text(F.lit("1H NMR"), F.lit("400 MHz"), F.lit("CDCl3"), F.lit("1.2"))) == "1H NMR (400 MHz, CDCl3): 1.2"


def test_noise(spark):
    key, t = F.lit("s1"), "8.52 (d, J = 5.0 Hz, 1H), 7.10 (s, 2H), 3.00 (t), 1.00 (s)"
    assert not set("()[],") & set(one(spark, spectrum.strip_punctuation(F.lit(t), 1.0, 1, key)))
    assert len(one(spark, spectrum.split_peaks(spectrum.drop_peaks(F.lit(t), 1.0, 1, key)))) == 1 and one(spark, spectrum.drop_peaks(F.lit("1.0 (s)"), 1.0, 1, key)) == "1.0 (s)"
    moved = one(spark, spectrum.numbers(spectrum.perturb_values(F.lit(t), 1.0, 1, key)))
    assert abs(float(moved[0]) - 8.52) <= 0.09 and abs(float(moved[1]) - 5) <= 0.91 and one(spark, spectrum.perturb_values(F.lit(t), 1.0, 1, key)) == one(spark, spectrum.perturb_values(F.lit(t), 1.0, 1, key))
    for n in (0, 1, 2, 5):
        kept = one(spark, spectrum.keep_modalities(F.lit(n), 1, key))
        assert kept == sorted(set(kept)) and (len(kept) == n if n < 2 else 1 <= len(kept) < n)


def test_formula_edits(spark):
    df = spark.createDataFrame([(i, "C6H12O2") for i in range(40)] + [(99, "(C2H4)n"), (98, "X")], "id int, f string").select("id", formulas.perturb(F.col("f"), 1, F.col("id")).alias("x"))
    got = {r.id: r.x for r in df.collect()}
    assert got[99].formula == "(C2H4)n" and got[99].operation == "unsupported_formula" and not got[99].applied
    assert all(sum(abs(v) for v in got[i].deltas.values()) <= 3 and got[i].formula != "C6H12O2" for i in range(40)) and len({got[i].operation for i in range(40)}) >= 5
    assert one(spark, formulas.hill(formulas.counts(F.lit("OC2NaH5H")))) == "C2H6NaO"


def test_text_helpers(spark):
    assert one(spark, text.strip_fences(F.lit("```python\nprint(1)\n```"))) == "print(1)" and one(spark, text.strip_fences(F.lit("x"))) == "x"
    assert one(spark, text.embedded_reaction(F.lit("see CCO>>CC=O. Then"))) == "CCO>>CC=O"
    assert one(spark, text.reaction_parts(F.lit("CC>O"))) is None
    assert one(spark, text.user_input(F.lit("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user\n hello <|im_end|>"))) == "hello"
    assert one(spark, clean.clean_int(F.lit(5.9), "double")) == 5 and one(spark, clean.clean_float(F.lit("nan"))) is None


# --- look-ups --------------------------------------------------------------------------------------


def test_precedent_cap_and_duplicates(spark):
    rows = [(0, "b", ["x"], ["T"]), (1, "a", ["x"], ["T"]), (2, "a", ["x"], ["T"]), (3, "a", ["y"], ["T", "Z"]), (4, "a", ["z"], ["Q"])]
    df = spark.createDataFrame(rows, "record long, source string, reactants array<string>, products array<string>")
    targets = spark.createDataFrame([("T",)], "product string")
    rank = F.when(F.col("source") == "a", 0).otherwise(1)
    assert [(r.record, r["rank"]) for r in precedents.scan_precedents(df, targets, 3, rank).orderBy("rank").collect()] == [(1, 1), (3, 2), (0, 3)]
    assert precedents.scan_precedents(df, targets, 2, rank).count() == 2 and precedents.scan_precedents(df, targets, 0, rank).count() == 0


def test_scores(spark):
    s = precedents.overlap_score(F.lit(2.0), F.lit(2.0), F.lit(4.0))
    assert one(spark, precedents.adjusted(s, F.lit(True), F.lit(0.5))) == pytest.approx(0.5 + 0.15 + 0.06 + 0.08 + 0.04)
    assert one(spark, precedents.adjusted(F.lit(0.1), F.lit(False))) == 0.0
    assert one(spark, precedents.balance(F.array(F.lit("CC"), F.lit("CCCC")))) == 0.5
    routes = F.array(*[F.struct(F.lit(b).alias("balance"), F.lit(v).alias("verified"), F.lit(n).alias("template")) for b, v, n in ((0.9, False, "a"), (0.2, True, "b"), (0.5, False, "a"), (0.7, False, "c"))])
    assert [r.template for r in one(spark, precedents.order_routes(routes, 2))] == ["b", "a"]


def test_cache_refresh(spark):
    cache = spark.createDataFrame([("k", 1, ["names"], "old"), ("k", 2, ["names"], "newer")], "key string, version int, stages array<string>, name string")
    latest = enrich.latest(cache)
    assert latest.first().name == "newer"
    new = spark.createDataFrame([("k", ["properties"], None), ("m", ["names"], "x")], "key string, stages array<string>, name string")
    got = {r.key: r for r in enrich.refresh(latest, new, ["name"]).collect()}
    assert got["k"].stages == ["names", "properties"] and got["k"].name == "newer" and got["k"].version == 3 and got["m"].version == 1
    assert [r.percentage for r in enrich.completion(cache.limit(0)).collect()] == [0.0] * 4


# --- clusters --------------------------------------------------------------------------------------


def test_kmeans_marks_invalid_rows_and_refuses_none(spark):
    rows = [(i, [float(i % 2), 1.0] if i < 6 else None) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {r.id: r.cluster for r in cluster.kmeans(df, "id", "v", 5000).collect()}
    assert got[6] == got[7] == -1 and got[0] == got[2] != got[1]
    with pytest.raises(ValueError):
        cluster.kmeans(df.where("id > 5"), "id", "v", 2)


def test_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0]), (1, [3.0, 5.0])], "id long, v array<double>")
    assert sorted(r.value for r in cluster.standardize(df, "id", "v").collect()) == [-1.0, 0.0, 0.0, 1.0]
    assert one(spark, cluster.l2_normalized(F.array(F.lit(3.0), F.lit(4.0)))) == [0.6, 0.8] and one(spark, cluster.l2_normalized(F.array(F.lit(0.1)))) == [0.1]
    import numpy as np

    bits = np.random.default_rng(0).integers(0, 2, (3, 20))
    assert (cluster.unpacked_bits(cluster.packed_bits(bits), 20) == bits).all()
