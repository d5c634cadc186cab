"""The local precedent search as a tool over a reaction table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..chem.backend import components, get
from ..functions.text import reaction_parts
from ..operators.precedents import inverted_index, overlap_search
from .registry import result


class LocalSearch:
    """Holds the index of a reaction table (record, source_ord, reactants, products) and answers queries."""

    def __init__(self, reactions: DataFrame, backend: str = "opaque", complete: bool = True):
        self.records = reactions.select("record", F.get("products", F.lit(0)).alias("product"), "source_ord").where(F.col("product").isNotNull())
        self.index = inverted_index(reactions.select("record", F.col("reactants").alias("components")))
        self.spark, self.backend, self.complete = reactions.sparkSession, backend, complete

    def __call__(self, arguments: dict) -> dict:
        parts = list(arguments.get("reactants") or [])
        if not parts and arguments.get("reaction"):
            row = self.spark.range(1).select(reaction_parts(F.lit(arguments["reaction"])).alias("p")).first()["p"]
            parts = [*row["reactants"], *row["agents"]] if row else []
        parts, _ = components(self.backend, [*parts, *(arguments.get("reagents") or [])], "search")
        if not parts:
            return result("failure", "error", warnings=["no readable reactant was given"])
        query = self.spark.createDataFrame([(0, p) for p in parts], "query int, component string")
        formula, hints = (arguments.get("formula") or "").strip(), list(arguments.get("hints") or [])
        evidence = (lambda pairs: structure_evidence(pairs, formula, hints)) if formula or hints else None
        found = overlap_search(self.index, query, self.records, arguments.get("top", 10), evidence)
        rows = [r.asDict() for r in found.orderBy("rank").collect()]
        warnings = ["recorded conditions are those of the precedent"] if rows else []
        for r in rows:
            r.pop("query")
            if formula:
                r["formula_match"] = r.pop("formula_equal")
                warnings += [] if r["formula_match"] else [f"candidate {r['rank']} does not have the formula {formula}"]
            if hints:
                r["missing_hints"] = get("graph").hints_met(r["product"], hints)[1]
        return result("success" if self.complete else "partial", "ok" if rows else "no_candidates", {"candidates": rows, "provenance": {"records": "reaction table", "query_components": parts}}, warnings)


def structure_evidence(pairs: DataFrame, formula: str, hints: list[str]) -> DataFrame:
    """Adds formula_equal (null without a formula) and matched_share (null without hints) to (query, product), on Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chem = get("graph")
        for b in batches:
            products = b.column("product").to_pylist()
            equal = [chem.formula(p) == formula if formula else None for p in products]
            share = [chem.hints_met(p or "", hints)[0] / len(hints) if hints else None for p in products]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(equal, pa.bool_()), pa.array(share, pa.float64())], names=[*b.schema.names, "formula_equal", "matched_share"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return pairs.mapInArrow(run, f"{kinds}, formula_equal boolean, matched_share double")
