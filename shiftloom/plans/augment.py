"""Training samples: spectrum text with noise, information by weighted draw, tone, placement, and rewrite acceptance.

Every choice is a keyed draw, so a sample is the same under any partitioning, and no choice shifts another.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spectrum as sp
from ..functions import text as tx
from ..functions.draws import draw_bits, let, pick, u, weighted
from ..functions.formulas import perturb

INFORMATION = ("none", "formula", "structure", "reaction", "fragment")
NOISE_MODES = ("digits_only", "strip_punctuation", "perturb_values", "drop_peaks")


@dataclass(frozen=True)
class AugmentOptions:
    seed: int = 0
    mix: dict[str, float] = field(default_factory=lambda: dict(zip(INFORMATION, (0.30, 0.20, 0.20, 0.15, 0.15), strict=True)))
    followup: float = 0.4
    uncertain: float = 0.5
    raw: float = 0.3
    noise: float = 0.0
    strength: float = 0.3
    modes: tuple[str, ...] = NOISE_MODES
    modality_drop: float = 0.5
    formula_noise: float = 0.0
    reaction_noise: float = 0.0
    max_reactions: int = 2
    max_fragments: int = 2

    def __post_init__(self):
        if set(self.mix) - set(INFORMATION) or min(self.mix.values()) < 0 or abs(sum(self.mix.values()) - 1) > 1e-6:
            raise ValueError("mix must weigh known information types and sum to 1")
        for name in ("followup", "uncertain", "raw", "noise", "modality_drop", "formula_noise"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must be within 0 and 1")
        if set(self.modes) - set(NOISE_MODES):
            raise ValueError("unknown noise mode")
        sp.reaction_noise(self.reaction_noise)


def noised_spectra(blocks: Column, o: AugmentOptions, key: Column) -> tuple[Column, Column, Column]:
    """(text, mode or null, whether it changed): one mode for the whole row, only where there is text."""
    clean = sp.multimodal_text(blocks, o.seed, key)
    if not o.noise:
        return clean, F.lit(None).cast("string"), F.lit(False)
    mode = pick(list(o.modes), o.seed, "mode", key)
    filled = F.filter(blocks, lambda b: F.coalesce(b["shift_text"], F.lit("")) != "")

    def header(b: Column) -> Column:
        """What stands before the peaks, without the colon."""
        return F.regexp_replace(sp.spectrum_text(b["type"], b["frequency"], b["solvent"], F.lit("~")), r"(: )?~$", "")

    def noised(mode: str) -> Column:
        return F.array_join(F.transform(filled, lambda b: sp.apply_noise(b["shift_text"], header(b), mode, o.strength, o.seed, key)), "\n")

    rendered = None
    for m in o.modes:
        rendered = F.when(mode == m, noised(m)) if rendered is None else rendered.when(mode == m, noised(m))
    hit = (clean != "") & (u(o.seed, "noise", key) < o.noise)
    text = F.when(hit, rendered).otherwise(clean)
    return text, F.when(hit, mode), hit & (text != clean)


#: What a record brings, besides sample_id, gt_smiles and spectra; missing columns are null.
ITEM = "struct<reactants:array<string>,conditions:string,name:string,template:string,verified:boolean>"
FACTS = {
    "modality": "string", "cluster": "string", "formula": "string", "molecular_weight": "double", "names": "struct<chinese:string,english:string>",
    "precedents": f"array<{ITEM}>", "routes": f"array<{ITEM}>", "fragments": "array<struct<key:string,zh:string>>", "polymer": "array<struct<zh:string,polymerization_zh:string>>",
    "ms": "string", "provenance": "string", "quality": "string",
}


def with_facts(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in FACTS.items() if name not in df.columns})


def quoted_items(precedents: Column, routes: Column, most: int) -> Column:
    """What is quoted of a compound's making: precedents as they come, else routes, verified ones first and one a template."""
    none = F.array().cast(f"array<{ITEM}>")
    known, proposed = F.coalesce(precedents, none), F.coalesce(routes, none)
    ordered = F.concat(F.filter(proposed, lambda r: F.coalesce(r["verified"], F.lit(False))), F.filter(proposed, lambda r: ~F.coalesce(r["verified"], F.lit(False))))
    once = let(ordered, lambda rs: F.filter(rs, lambda r, i: ~F.exists(F.slice(rs, 1, i), lambda p: p["template"] == r["template"])))
    return F.slice(F.when(F.size(known) > 0, known).otherwise(once), 1, most)


def plan_samples(df: DataFrame, o: AugmentOptions = AugmentOptions()) -> DataFrame:
    """The scenario of each record.

    ``df``: sample_id, gt_smiles, spectra array<struct<type, frequency, solvent, shift_text>>, and any of FACTS.
    Adds active spectra, spectrum_text, noise_mode, noise_changed, requested, information_type, information, degraded,
    uncertain, placement, rewrite (whether the row is up for rewriting), items, formula_noise, and the literals that the
    first turn and the follow-up must keep.
    """
    df, key = with_facts(df), F.col("sample_id")
    n = F.size("spectra")
    dropped = (n > 1) & (u(o.seed, "moddrop", key) < o.modality_drop)
    positions = F.when(dropped, sp.keep_modalities(n, o.seed, key)).otherwise(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))
    all_positions = F.filter(F.transform("spectra", lambda b, i: i), lambda i: i >= 0)
    df = df.withColumns({"active": F.filter(F.transform(positions, lambda i: F.get("spectra", i)), lambda b: b.isNotNull()), "dropped": F.array_except(all_positions, positions)})
    text, mode, changed = noised_spectra(F.col("active"), o, key)
    noised = (u(o.seed, "formulanoise", key) < o.formula_noise) if o.formula_noise else F.lit(False)
    edited = perturb(F.col("formula"), o.seed, key)
    plain = F.struct(F.col("formula").alias("formula"), F.lit(False).alias("applied"), F.lit(None).cast("string").alias("operation"), F.lit(None).cast("map<string,int>").alias("deltas"))
    named = F.filter(F.coalesce("fragments", F.array().cast(FACTS["fragments"])), lambda x: (x["key"] != "murcko_scaffold") & (F.coalesce(x["zh"], F.lit("")) != ""))
    df = df.withColumns(
        {
            "spectrum_text": text, "noise_mode": mode, "noise_changed": changed, "requested": weighted(o.mix, u(o.seed, "information", key)),
            "items": quoted_items(F.col("precedents"), F.col("routes"), o.max_reactions), "formula_noise": F.when(noised, edited).otherwise(plain),
            "quoted": F.transform(F.slice(named, 1, (1 + draw_bits(o.seed, "fragments", key) % max(o.max_fragments, 1)).cast("int")), lambda x: x["zh"]),
        }
    )
    both = F.col("names.chinese").isNotNull() & F.col("names.english").isNotNull()
    kinds = F.when(both, F.array(*[F.lit(k) for k in tx.KIND_NAMES])).otherwise(F.array(F.lit("smiles")))
    kind = F.element_at(kinds, (1 + draw_bits(o.seed, "structure", key) % F.size(kinds)).cast("int"))
    df = df.withColumns({"structure_kind": kind, "structure": F.when(kind == "name_zh", F.col("names.chinese")).when(kind == "name_en", F.col("names.english")).otherwise(F.col("gt_smiles"))})
    proposed = F.coalesce(F.size("precedents"), F.lit(0)) <= 0
    drawn = (F.col("requested") == "structure") | (u(o.seed, "tone", key) < o.uncertain)
    hedged = drawn | ((F.col("requested") == "reaction") & proposed)
    made = tx.reaction_block(F.col("items"), hedged, o.seed, key)
    polymer = F.when(u(o.seed, "polymer", key) < 0.5, tx.polymer_block(F.col("polymer"))).otherwise("")
    said = {
        "formula": tx.formula_block(F.col("formula_noise.formula")), "structure": tx.structure_block(F.col("structure"), F.col("structure_kind"), o.seed, key),
        "reaction": F.when(made == "", "").otherwise(F.concat_ws("。", made, F.nullif(polymer, F.lit("")))), "fragment": tx.fragment_block(F.col("quoted"), hedged, o.seed, key),
    }
    information = F.coalesce(*[F.when(F.col("requested") == k, v) for k, v in said.items()], F.lit(""))
    df = df.withColumn("information", information)
    has = F.col("information") != ""
    literals = F.when(F.col("requested") == "formula", F.array("formula_noise.formula")).when(F.col("requested") == "structure", F.array("structure")).when(F.col("requested") == "reaction", F.flatten(F.transform("items", lambda i: i["reactants"])))
    df = df.withColumns(
        {
            "information_type": F.when(has, F.col("requested")).otherwise("none"), "degraded": (F.col("requested") != "none") & ~has, "uncertain": hedged & has,
            "placement": F.when(~has, "none").when(u(o.seed, "followup", key) < o.followup, "followup").otherwise("first"), "rewrite": u(o.seed, "raw", key) >= o.raw,
            "literals": F.when(has, F.coalesce(literals, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")),
        }
    )
    first = F.concat(F.array("spectrum_text"), F.when(F.col("placement") == "first", F.col("literals")).otherwise(F.array().cast("array<string>")))
    return df.withColumns({"keep_first": first, "keep_followup": F.when(F.col("placement") == "followup", F.col("literals"))})


def attach_rewrites(planned: DataFrame, rewrites: DataFrame) -> DataFrame:
    """Adds ``rewritten`` and ``rewritten_followup`` from (sample_id, slot, text): slot 0 is the first turn, 1 the follow-up."""
    of = lambda slot, name: F.max(F.when(F.col("slot") == slot, F.col("text"))).alias(name)
    return planned.join(rewrites.groupBy("sample_id").agg(of(0, "rewritten"), of(1, "rewritten_followup")), "sample_id", "left")


def assemble(planned: DataFrame, o: AugmentOptions = AugmentOptions()) -> DataFrame:
    """Augmented records of 19 fields; rewrites (columns of attach_rewrites, where there are any) stand where they keep the literals."""
    key = F.col("sample_id")
    given = lambda c: F.col(c) if c in planned.columns else F.lit(None).cast("string")
    later = F.col("placement") == "followup"
    first = tx.accept(given("rewritten"), tx.first_turn(F.col("spectrum_text"), F.when(later, "").otherwise(F.col("information")), o.seed, key), F.col("keep_first"))
    followup = tx.accept(given("rewritten_followup"), tx.followup_turn(F.col("information"), o.seed, key), F.col("keep_followup"))
    df = planned.withColumns({"__first": first, "__later": F.when(later, followup)})
    status = F.when(F.col("__later.status").isNull() | (F.col("__later.status") == F.col("__first.status")), F.col("__first.status")).otherwise("mixed")
    turn = lambda i, c: F.struct(F.lit(i).alias("turn_index"), F.lit("user").alias("role"), c.alias("content"))
    turns = F.filter(F.array(turn(0, F.col("__first.text")), turn(1, F.coalesce("__later.text", F.lit("")))), lambda t: (t["turn_index"] == 0) | (t["content"] != ""))
    count = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    augmentation = F.struct(
        F.col("requested").alias("requested_information_type"), "information_type", F.col("placement").alias("information_placement"), (F.col("information") != "").alias("information_available"), F.col("degraded").alias("information_degraded"),
        F.col("information").alias("information_text"), F.col("uncertain").alias("uncertain_tone"), F.col("rewrite").alias("llm_requested"), (status == "llm").alias("llm_rewritten"), status.alias("llm_status"),
        F.col("noise_mode").isNotNull().alias("nmr_noise_applied"), F.col("noise_mode").alias("nmr_noise_mode"), F.col("noise_changed").alias("nmr_noise_changed"),
        ((F.col("information_type") == "formula") & F.col("formula_noise.applied")).alias("formula_noise_applied"), F.col("formula_noise").alias("formula_noise_detail"), F.lit(False).alias("reaction_noise_applied"),
        F.size("active").alias("num_active_modalities"), F.col("dropped").alias("dropped_modalities"), (F.size("dropped") > 0).alias("modal_drop_applied"),
        F.col("names.chinese").isNotNull().alias("has_name_zh"), F.col("names.english").isNotNull().alias("has_name_en"), (count("precedents") > 0).alias("has_reaction_precedent"), count("routes").alias("num_retro_routes"),
        F.coalesce(F.exists("routes", lambda r: F.coalesce(r["verified"], F.lit(False))), F.lit(False)).alias("askcos_verified"), (count("polymer") > 0).alias("has_polymer_context"), count("fragments").alias("num_fragments"), F.lit(str(o.seed)).alias("seed"),
    )
    return df.select(
        F.concat_ws(":", key, F.lit("aug")).alias("sample_id"), key.alias("source_sample_id"), F.coalesce("modality", F.lit("nmr")).alias("modality"), "cluster", turns.alias("turns"), F.size(turns).alias("num_of_queries"),
        "gt_smiles", F.col("formula").alias("molecular_formula"), "molecular_weight", F.get("spectra", F.lit(0)).alias("nmr"), F.col("spectra").alias("nmr_list"), F.col("active").alias("active_nmr_list"), "ms",
        F.col("spectrum_text").alias("nmr_text"), F.array_join(F.filter(F.transform("active", lambda b: sp.spectrum_text(b["type"], b["frequency"], b["solvent"], b["shift_text"])), lambda x: x != ""), "\n").alias("nmr_text_clean"),
        augmentation.alias("augmentation"), F.struct("names", "precedents", "routes", "fragments", "polymer").alias("enrichment"), F.struct("provenance", key.alias("augmented_from")).alias("provenance"), "quality",
    )


#: Counts of a build: name and condition on ``augmentation``.
COUNTS = {
    "information_degraded": lambda a: a("information_degraded"), "llm_rewritten": lambda a: a("llm_rewritten"), "llm_rejected": lambda a: a("llm_status") == "rejected_information_loss", "formula_noise_eligible": lambda a: a("information_type") == "formula",
    "formula_noised": lambda a: a("formula_noise_applied"), "multi_turn": lambda a: F.col("num_of_queries") > 1, "modal_dropped": lambda a: a("modal_drop_applied"),
}
HISTOGRAMS = {"information_types": "information_type", "requested_information_types": "requested_information_type", "placements": "information_placement", "noised": "nmr_noise_mode"}


def build_summary(samples: DataFrame) -> DataFrame:
    """One row: the number of records, the seven counts, and four histograms as maps from value to number (null values left out)."""
    a = lambda n: F.col(f"augmentation.{n}")
    values = F.array(*[F.struct(F.lit(name).alias("histogram"), a(column).cast("string").alias("value")) for name, column in HISTOGRAMS.items()])
    counted = samples.select(F.explode(values).alias("x")).where("x.value is not null").groupBy("x.histogram", "x.value").agg(F.count("*").alias("n"))
    entries = lambda name: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("histogram") == name, F.struct("value", "n"))))).alias(name)
    maps = counted.agg(*[entries(name) for name in HISTOGRAMS])  # a few values each
    return samples.agg(F.count("*").alias("records"), *[F.count_if(test(a)).alias(name) for name, test in COUNTS.items()]).crossJoin(maps)
