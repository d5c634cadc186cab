"""Reaction look-ups: target scan, overlap search through an inverted index, ranking and scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.sizes import small_side


def scan_precedents(reactions: DataFrame, targets: DataFrame, cap: int, source_rank: Column) -> DataFrame:
    """Reactions whose products hold a target: at most ``cap`` different ones a target, in source order.

    ``reactions``: record, source, reactants array, products array; ``targets``: product. Products are
    exploded once; the target side is broadcast only while its measured size stays small. Duplicates are
    the same source and ordered reactants. The ranked cut is a window group limit, so no target's
    rows are held beyond the cap after the local pass.
    """
    if cap <= 0:
        return reactions.limit(0).select("record", "source", F.lit("").alias("product"), F.lit(0).alias("rank"))
    made = reactions.select("record", "source", source_rank.alias("source_rank"), F.array_join("reactants", ".").alias("signature"), F.explode(F.array_distinct("products")).alias("product"))
    met = made.join(small_side(targets.select("product").distinct()), "product")
    first = met.groupBy("product", "source", "source_rank", "signature").agg(F.min("record").alias("record"))
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("product").orderBy("source_rank", "record")))
    return ranked.where(F.col("rank") <= cap).select("product", "record", "source", "rank")


def inverted_index(reactions: DataFrame) -> DataFrame:
    """(component, record, n_components): one posting a distinct component."""
    return reactions.select("record", F.array_distinct("components").alias("c")).select("record", F.size("c").alias("n_components"), F.explode("c").alias("component"))


def overlap_score(shared: Column, query_size: Column, record_size: Column) -> Column:
    """0.50 coverage + 0.30 Jaccard + 0.12 record coverage."""
    return 0.5 * shared / query_size + 0.3 * shared / (query_size + record_size - shared) + 0.12 * shared / record_size


def adjusted(score: Column, formula_equal: Column | None = None, matched_share: Column | None = None) -> Column:
    """Formula bonus 0.08 or penalty 0.20, constraint bonus 0.08 times the share met; clipped to [0, 1], six digits."""
    if formula_equal is not None:
        score = score + F.when(formula_equal, 0.08).when(~formula_equal, -0.20).otherwise(0.0)
    if matched_share is not None:
        score = score + 0.08 * F.coalesce(matched_share, F.lit(0.0))
    return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 6)


def confidence(score: Column, coverage: Column) -> Column:
    return F.when((score >= 0.8) & (coverage >= 0.75), "high").when(score >= 0.45, "medium").otherwise("low")


def overlap_search(index: DataFrame, queries: DataFrame, records: DataFrame, top: int, evidence: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Ranked products for each query by component overlap.

    ``index`` from inverted_index; ``queries``: query, component (distinct); ``records``: record, product,
    source_ord. ``evidence`` adds formula_equal and matched_share to (query, product) pairs; they enter the score
    before anything is cut. The best record of a product stays (earlier source, then record, on ties); top is kept
    within 1 to 100. Postings meet queries by an equi-join, which AQE splits where a component is frequent; counts are
    partially aggregated.
    """
    top = min(max(top, 1), 100)
    q = queries.join(queries.groupBy("query").agg(F.count("*").alias("query_size")), "query")
    shared = index.join(small_side(q), "component").groupBy("query", "record").agg(F.count("*").alias("shared"), F.first("query_size").alias("query_size"), F.first("n_components").alias("record_size"))
    met = shared.join(records, "record").withColumn("coverage", F.col("shared") / F.col("query_size"))
    formula = share = None
    if evidence:
        met = met.join(evidence(met.select("query", "product").distinct()), ["query", "product"])
        formula, share = F.col("formula_equal"), F.col("matched_share")
    scored = met.withColumn("score", adjusted(overlap_score(F.col("shared"), F.col("query_size"), F.col("record_size")), formula, share))
    place = F.struct(-F.col("score"), -F.col("coverage"), F.col("source_ord"), F.col("record"))
    one = scored.groupBy("query", "product").agg(F.min_by(F.struct("record", "score", "coverage", "source_ord", *(["formula_equal", "matched_share"] if evidence else [])), place).alias("x")).select("query", "product", "x.*")
    ranked = one.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.desc("coverage"), "source_ord", "record")))
    kept = ["formula_equal", "matched_share"] if evidence else []
    return ranked.where(F.col("rank") <= top).select("query", "rank", "product", "record", "score", F.round("coverage", 6).alias("coverage"), confidence(F.col("score"), F.col("coverage")).alias("confidence"), *kept)


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order: a partial aggregate over ascending or ``desc`` numbers and texts given as sort keys."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("__x")).select(*keys, "__x.*")


def softmax_scores(df: DataFrame, group: str, score: str) -> DataFrame:
    """Adds ``probability``: softmax in each group, missing scores as the maximum less 100."""
    w = W.partitionBy(group)
    top = F.coalesce(F.max(score).over(w), F.lit(0.0))
    e = F.exp(F.coalesce(F.col(score), top - 100.0) - top)
    return df.withColumn("_e", e).withColumn("probability", F.col("_e") / F.sum("_e").over(w)).drop("_e")


def forward_score(raw: Column, rank: Column, formula_equal: Column) -> Column:
    """A predicted product's score: softmax value or 1 / rank; a formula that differs costs four fifths, an equal one lifts."""
    s = F.coalesce(raw, 1.0 / rank)
    return F.when(formula_equal, F.greatest(s, 0.62 + 0.30 * s)).when(~formula_equal, 0.2 * s).otherwise(s)


def forward_band(score: Column) -> Column:
    return F.when(score >= 0.5, "high").when(score >= 0.1, "medium").otherwise("low")


def balance(reactants: Column) -> Column:
    """Length of the shortest over that of the longest component."""
    n = F.transform(reactants, lambda x: F.char_length(x))
    return F.array_min(n) / F.array_max(n)


def order_routes(routes: Column, cap: int) -> Column:
    """array<struct<balance, verified, template, ...>>: verified first, then balance, stable; one a template; at most cap."""
    placed = F.array_sort(F.transform(routes, lambda r, i: F.struct((~r["verified"]).alias("unverified"), (-r["balance"]).alias("negative"), i.alias("i"), r.alias("route"))))
    flat = F.transform(placed, lambda x: x["route"])
    once = F.filter(flat, lambda r, i: ~F.exists(F.slice(flat, 1, i), lambda p: p["template"] == r["template"]))
    return F.slice(once, 1, cap)


def dense_ranks(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order)))


def set_sizes(a: Column, b: Column) -> Column:
    """struct<common, only_a, only_b, both, jaccard>."""
    common, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.struct(common.alias("common"), F.size(F.array_except(a, b)).alias("only_a"), F.size(F.array_except(b, a)).alias("only_b"), union.alias("both"), F.when(union > 0, common / union).otherwise(0.0).alias("jaccard"))
