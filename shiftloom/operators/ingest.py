"""Raw spectrum exports to truth records: schema checks, prioritized drops, merge by molecule, summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_bool, clean_float, clean_int, clean_str, text_or_null

#: Columns of an export, and the review columns that come all together or not at all (fixed values).
BASE_COLUMNS = ("Filename", "SMILES", "Page_in_file_mol", "Page_in_file_para", "Location_in_page_mol", "Location_in_page_para", "NMR_type", "NMR_frequency", "NMR_solvent", "NMR_shift_text", "NMR_note", "NMR_processed", "Atom_number", "Atom_number_diff_env", "Atom_number_abstract")
REVIEW_COLUMNS = ("smiles_actual", "text_in_pdf", "nmr_frequency_right", "nmr_solvent_right", "nmr_processed_right", "is_same_molecule", "is_same_skeleton", "num_chiral_centers")
BOOKKEEPING = ("Page_in_file_mol", "Page_in_file_para", "Location_in_page_mol", "Location_in_page_para")
GATES = ("any", "same_skeleton", "same_molecule")


@dataclass(frozen=True)
class IngestOptions:
    """What to keep: spectrum types (all if empty), the quality gate, the review check and a cap on records."""

    nmr_types: tuple[str, ...] = ()
    quality: str = "any"
    drop_wrong: bool = True
    max_records: int | None = None

    def __post_init__(self):
        if self.quality not in GATES:
            raise ValueError(f"quality must be one of {GATES}")
        if self.max_records is not None and self.max_records < 0:
            raise ValueError("max_records must not be negative")


def reviewed(columns: list[str]) -> bool:
    """Whether an export has the review columns; missing base columns and partial reviews raise."""
    missing = [c for c in BASE_COLUMNS if c not in columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    have = [c for c in REVIEW_COLUMNS if c in columns]
    if have and len(have) < len(REVIEW_COLUMNS):
        raise ValueError(f"incomplete review columns, missing: {', '.join(c for c in REVIEW_COLUMNS if c not in have)}")
    return bool(have)


def drop_reason(truth: Column, kind: Column, molecule: Column, skeleton: Column, marks: list[Column], options: IngestOptions) -> Column:
    """The first reason to drop a row, null if it stays: empty, type, quality, qc in this order.

    Only an explicit false fails the quality gate; unknown passes. A mark is wrong if it says so as a whole.
    """
    reason = F.when(F.coalesce(truth, F.lit("")) == "", "empty")
    if options.nmr_types:
        reason = reason.when(~F.coalesce(kind, F.lit("")).isin(*options.nmr_types), "type")
    gate = {"any": None, "same_skeleton": skeleton, "same_molecule": molecule}[options.quality]
    if gate is not None:
        reason = reason.when(~F.coalesce(gate, F.lit(True)), "quality")
    if options.drop_wrong and marks:
        wrong = F.lit(False)
        for m in marks:
            wrong = wrong | (F.lower(F.coalesce(m, F.lit(""))) == "wrong")
        reason = reason.when(wrong, "qc")
    return reason


def parsed_peaks(c: Column) -> Column:
    """A Python-literal peak list as JSON text; the raw text where it is none."""
    json = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.translate(c, "()'", '[]"'), r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    json = F.regexp_replace(json, r",\s*\]", "]")
    return F.coalesce(F.to_json(F.try_parse_json(json)), c)


def records(df: DataFrame, dataset: str, split: str, source: str, options: IngestOptions = IngestOptions()) -> DataFrame:
    """Truth records with ``drop_reason``; ``df`` needs ``row_index`` (position in its file) and ``source_ord``."""
    checked = reviewed(df.columns)
    col = lambda n: F.col(n) if checked or n not in REVIEW_COLUMNS else F.lit(None).cast("string")
    raw, actual = text_or_null(F.col("SMILES")), text_or_null(col("smiles_actual"))
    truth = F.coalesce(actual, raw)
    kind = clean_str(F.col("NMR_type"))
    molecule, skeleton = clean_bool(col("is_same_molecule")), clean_bool(col("is_same_skeleton"))
    marks = [clean_str(col(c)) for c in REVIEW_COLUMNS[2:5]] if checked else []
    nmr = F.struct(
        F.nullif(kind, F.lit("")).alias("type"),
        text_or_null(F.col("NMR_frequency")).alias("frequency"),
        text_or_null(F.col("NMR_solvent")).alias("solvent"),
        text_or_null(F.col("NMR_shift_text")).alias("shift_text"),
        text_or_null(F.col("NMR_note")).alias("note"),
        parsed_peaks(text_or_null(F.col("NMR_processed"))).alias("processed"),
        clean_int(F.col("Atom_number")).alias("atom_number"),
        clean_int(F.col("Atom_number_diff_env")).alias("atom_number_diff_env"),
        clean_float(F.col("Atom_number_abstract")).alias("atom_number_abstract"),
    )
    quality = F.struct(
        text_or_null(col("smiles_actual")).alias("smiles_actual"),
        text_or_null(col("text_in_pdf")).alias("text_in_pdf"),
        *(text_or_null(col(c)).alias(c) for c in REVIEW_COLUMNS[2:5]),
        molecule.alias("is_same_molecule"),
        skeleton.alias("is_same_skeleton"),
        clean_int(col("num_chiral_centers")).alias("num_chiral_centers"),
    )
    return df.select(
        F.concat_ws(":", F.lit(dataset), F.lit(split), F.lit(source), F.col("row_index").cast("string")).alias("sample_id"),
        F.lit("nmr").alias("modality"),
        truth.alias("gt_smiles"),
        nmr.alias("nmr"),
        F.lit(None).cast("string").alias("ms"),
        F.struct(F.lit(dataset).alias("dataset"), F.lit(split).alias("split"), F.lit(source).alias("source"), F.col("row_index").alias("row_index"), text_or_null(F.col("Filename")).alias("filename"), raw.alias("smiles_raw")).alias("provenance"),
        (quality if checked else F.lit(None).cast("struct<smiles_actual:string>")).alias("quality"),
        F.lit(source).alias("source"),
        F.col("source_ord").cast("int").alias("source_ord"),
        F.col("row_index").cast("bigint").alias("row_index"),
        drop_reason(truth, kind, molecule, skeleton, marks, options).alias("drop_reason"),
    )


def merge_by_key(df: DataFrame, key: str, order: list[str], ident: str, block: str) -> DataFrame:
    """One row a key: identity of its first row, its blocks and ids in order, and the group's size.

    A struct with the order in front keeps the lists right under any shuffle.
    """
    place = F.struct(*[F.col(o) for o in order])
    grouped = df.groupBy(key).agg(
        F.min(place).alias("first_place"),
        F.min_by(ident, place).alias(ident),
        F.array_sort(F.collect_list(F.struct(place.alias("at"), F.col(block).alias("block"), F.col(ident).alias("id")))).alias("members"),
        F.count("*").alias("n_members"),
    )
    return grouped.select(
        key, ident, "first_place", "n_members",
        F.transform("members", lambda m: m["block"]).alias(f"{block}_list"),
        F.when(F.col("n_members") > 1, F.transform("members", lambda m: m["id"])).alias("merged_sample_ids"),
    )


def merge_records(kept: DataFrame, options: IngestOptions = IngestOptions()) -> DataFrame:
    """Records merged by structure in (source, row) order, then capped."""
    merged = merge_by_key(kept, "gt_smiles", ["source_ord", "row_index"], "sample_id", "nmr")
    whole = kept.join(merged.select(F.col("sample_id").alias("_id"), "nmr_list", "merged_sample_ids", "n_members", "first_place"), kept["sample_id"] == F.col("_id")).drop("_id", "drop_reason")
    if options.max_records is not None:
        whole = whole.orderBy("first_place").limit(options.max_records)
    return whole.drop("first_place")


def summary(all_rows: DataFrame, by: list[str]) -> DataFrame:
    """Kept and dropped counts for each group of ``by`` and in all (rollup)."""
    count = lambda r: F.count_if(F.col("drop_reason") == r).alias(f"dropped_{r}")
    return all_rows.rollup(*by).agg(F.count("*").alias("n_rows"), F.count_if(F.col("drop_reason").isNull()).alias("kept"), *(count(r) for r in ("empty", "type", "quality", "qc")))


def merge_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(F.count_if(F.col("n_members") > 1).alias("merged_groups"), F.coalesce(F.sum(F.col("n_members") - 1), F.lit(0)).alias("merged_into"))
