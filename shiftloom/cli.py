"""Command line: preprocess and info of exports, cluster, augment, compile, tool configuration, query runs.

    python -m shiftloom.cli preprocess --source a.parquet --source b.csv --out records.parquet
    python -m shiftloom.cli run balanced_sample /path/to/tables
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import cluster, dataset, ingest
from .plans import augment
from .plans import compile as artifacts
from .plans.shared import checkpointed
from .session import session
from .sources import sinks, tables
from .tools.registry import DEFAULT_NAMES, default_registry


def load_records(spark: SparkSession, sources: list[str], name: str, split: str, options: ingest.IngestOptions) -> tuple[DataFrame, DataFrame]:
    """(all records with drop reasons, merged records) of exports in their order."""
    every = None
    for i, path in enumerate(sources):
        part = tables.export(spark, path).withColumn("source_ord", F.lit(i))
        part = ingest.records(part, name, split, path.rsplit("/", 1)[-1].rsplit(".", 1)[0], options)
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    return every, ingest.merge_records(every.where("drop_reason is null"), options)


def preprocess(spark: SparkSession, a: argparse.Namespace) -> dict:
    options = ingest.IngestOptions(tuple(a.types or ()), a.quality, not a.keep_wrong, a.max_records)
    every, merged = load_records(spark, a.source, a.name, a.split, options)
    built = []
    tables.load_or_build(spark, a.out, lambda: built.append(1) or merged, a.overwrite)
    total = next(r.asDict() for r in ingest.summary(every, ["source"]).collect() if r["source"] is None)
    return {"status": "built" if built else "cached", **{k: v for k, v in total.items() if k != "source"}}


def add_clusters(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Labels records by structure features and replaces the table as a whole."""
    from collections.abc import Iterator

    import pyarrow as pa

    from .chem.backend import get

    df = spark.read.parquet(a.table).drop("cluster")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            rows = [get("graph").features(s or "", a.bits) for s in b.column("gt_smiles").to_pylist()]
            bits = [np.unpackbits(np.frombuffer(x, np.uint8)).astype(float).tolist() if ok else None for x, _, ok in rows]
            yield pa.RecordBatch.from_arrays([b.column("sample_id"), pa.array(bits, pa.list_(pa.float64())), pa.array([p if ok else None for _, p, ok in rows], pa.list_(pa.float64()))], names=["sample_id", "bits", "properties"])

    raw = checkpointed(df.select("sample_id", "gt_smiles").mapInArrow(features, "sample_id string, bits array<double>, properties array<double>"))
    fitted = cluster.standardized(F.col("properties"), *cluster.moments(raw.where("properties is not null"), "properties"))
    vectors = raw.select("sample_id", F.when(F.col("bits").isNotNull(), cluster.joined_features(F.col("bits"), fitted)).alias("v"))
    labels = cluster.kmeans(vectors, "sample_id", "v", a.k, a.seed)
    sinks.publish(df.join(labels, "sample_id", "left"), a.table)
    return {r["cluster"]: r["n_rows"] for r in dataset.sizes(spark.read.parquet(a.table), "cluster").collect()}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="shiftloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("preprocess")
    c.add_argument("--source", action="append", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--name", default="spectra")
    c.add_argument("--split", default="train")
    c.add_argument("--types", nargs="*")
    c.add_argument("--quality", default="any", choices=ingest.GATES)
    c.add_argument("--keep-wrong", action="store_true")
    c.add_argument("--max-records", type=int)
    c.add_argument("--overwrite", action="store_true")
    c = sub.add_parser("info")
    c.add_argument("table")
    c = sub.add_parser("cluster")
    c.add_argument("table")
    c.add_argument("--k", type=int, default=256)
    c.add_argument("--bits", type=int, default=2048)
    c.add_argument("--seed", type=int, default=7)
    c = sub.add_parser("compile")
    c.add_argument("samples")
    c.add_argument("out")
    c.add_argument("--split", default="train")
    c.add_argument("--tools", nargs="*", default=list(DEFAULT_NAMES))
    c = sub.add_parser("augment")
    c.add_argument("records")
    c.add_argument("out")
    c.add_argument("--seed", type=int, default=0)
    c.add_argument("--noise", type=float, default=0.0)
    c.add_argument("--modality-drop", type=float, default=0.5)
    c = sub.add_parser("write-config")
    c.add_argument("out")
    c.add_argument("--tools", nargs="*", default=list(DEFAULT_NAMES))
    c = sub.add_parser("run")
    c.add_argument("query")
    c.add_argument("tables")
    c.add_argument("--out")
    a = p.parse_args(argv)
    if a.command == "write-config":
        with open(a.out, "w", encoding="utf-8") as f:
            f.write(sinks.yaml_text({"tools": default_registry().schemas(a.tools)}))
        return 0
    spark = session()
    if a.command == "preprocess":
        print(json.dumps(preprocess(spark, a)))
    elif a.command == "info":
        df = spark.read.parquet(a.table)
        print(json.dumps({"rows": df.count(), "columns": df.columns}))
    elif a.command == "cluster":
        print(json.dumps(add_clusters(spark, a)))
    elif a.command == "compile":
        df = spark.read.parquet(a.samples)
        print(json.dumps({"rows": sinks.write_as(artifacts.compile_samples(df, a.split, artifacts.ArtifactOptions(tool_names=tuple(a.tools))), a.out)}))
    elif a.command == "augment":
        o = augment.AugmentOptions(seed=a.seed, noise=a.noise, modality_drop=a.modality_drop)
        out = augment.assemble(augment.plan_samples(spark.read.parquet(a.records), o), o)
        print(json.dumps({"rows": sinks.write_as(out, a.out)}))
    else:
        from .queries import QUERIES

        df = QUERIES[a.query](spark, a.tables)
        if a.out:
            print(json.dumps({"rows": sinks.write_as(df, a.out)}))
        else:
            df.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main())
