"""Molecular formulas: parsing, Hill order and small keyed edits, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .draws import draw_bits, let

TOKEN = r"([A-Z][a-z]?)(\d*)"
#: Edits by name: element, change (fixed values).
EDITS = (
    ("hydrogen_plus_2", {"H": 2}),
    ("hydrogen_minus_2", {"H": -2}),
    ("oxygen_plus_1", {"O": 1}),
    ("oxygen_minus_1", {"O": -1}),
    ("nitrogen_plus_1", {"N": 1}),
    ("nitrogen_minus_1", {"N": -1}),
    ("homolog_plus_CH2", {"C": 1, "H": 2}),
    ("homolog_minus_CH2", {"C": -1, "H": -2}),
)


def supported(formula: Column) -> Column:
    return F.coalesce(formula.rlike(r"^([A-Z][a-z]?([1-9]\d*|0+[1-9]\d*)?)+$"), F.lit(False))


def counts(formula: Column) -> Column:
    """map<string,int> of a supported formula; repeated elements add up."""
    element = F.regexp_extract_all(formula, F.lit(TOKEN), F.lit(1))
    number = F.transform(F.regexp_extract_all(formula, F.lit(TOKEN), F.lit(2)), lambda n: F.coalesce(F.nullif(n, F.lit("")).cast("int"), F.lit(1)))
    pairs = F.arrays_zip(element.alias("e"), number.alias("n"))
    return F.map_from_entries(F.transform(F.array_distinct(element), lambda e: F.struct(e, F.aggregate(F.filter(pairs, lambda p: p["e"] == e), F.lit(0), lambda a, p: a + p["n"]))))


def hill(count_map: Column) -> Column:
    """Carbon, hydrogen, then the rest by name; ones are not written; zero counts vanish."""
    place = lambda e: F.when(e == "C", 0).when(e == "H", 1).otherwise(2)
    live = F.filter(F.map_entries(count_map), lambda x: x["value"] > 0)
    order = F.array_sort(F.transform(live, lambda x: F.struct(place(x["key"]).alias("p"), x["key"].alias("e"), x["value"].alias("n"))))
    return F.array_join(F.transform(order, lambda x: F.concat(x["e"], F.when(x["n"] == 1, "").otherwise(x["n"].cast("string")))), "")


def perturb(formula: Column, seed: int | str, key: Column) -> Column:
    """struct<formula, applied, operation, deltas>: one valid edit of EDITS by a draw; others leave the formula alone."""
    draw = draw_bits(seed, "formula", key)
    known = F.array(*[F.struct(F.lit(name).alias("operation"), F.create_map(*[x for e, d in deltas.items() for x in (F.lit(e), F.lit(d))]).alias("deltas")) for name, deltas in EDITS])
    of = lambda m, e: F.coalesce(F.try_element_at(m, e), F.lit(0))

    def valid(m: Column) -> Column:
        """Edits that leave no negative count, and a carbon where they take one."""
        fine = lambda x, e: of(m, e) + x["deltas"][e] >= F.when((e == "C") & (x["deltas"][e] < 0), 1).otherwise(0)
        return F.filter(known, lambda x: F.forall(F.map_keys(x["deltas"]), lambda e: fine(x, e)))

    def edited(m: Column) -> Column:
        pick = lambda v: F.get(v, (draw % F.greatest(F.size(v), F.lit(1))).cast("int"))
        merge = lambda x: F.map_zip_with(m, x["deltas"], lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
        return let(let(valid(m), pick), lambda x: F.when(x.isNotNull(), F.struct(hill(merge(x)).alias("formula"), F.lit(True).alias("applied"), x["operation"].alias("operation"), x["deltas"].alias("deltas"))))

    result = F.when(supported(formula), let(counts(formula), edited))
    same = F.struct(formula.alias("formula"), F.lit(False).alias("applied"), F.when(supported(formula), "no_valid_perturbation").otherwise("unsupported_formula").alias("operation"), F.lit(None).cast("map<string,int>").alias("deltas"))
    return F.coalesce(result, same)
