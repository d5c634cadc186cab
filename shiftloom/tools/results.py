"""What tools make of service answers: hits, names and candidates as rows, in DataFrame operations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.clean import strip
from ..functions.text import CAS, ID_PREFIXES, first_authors, name_class, page_url, strip_tags, truncated
from ..sources.remote import Service, nested_items


def distinct_hits(hits: DataFrame, query: str = "query") -> DataFrame:
    """Hits of each query without repeats of (title, url, text): the earliest of each; text is the snippet or the content."""
    key = [F.coalesce(F.lower("title"), F.lit("")), F.coalesce("url", F.lit("")), F.coalesce("snippet", "content", F.lit(""))]
    w = W.partitionBy(query, *key).orderBy("position")
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def page_hits(hits: DataFrame) -> DataFrame:
    """Encyclopedia hits: tags gone from snippets, page addresses from titles."""
    return hits.withColumn("snippet", strip_tags(F.col("snippet"))).withColumn("url", page_url(F.col("title")))


def work_rows(answers: DataFrame, column: str = "item") -> DataFrame:
    """Works of a JSON answer: first title, year of the issue date, DOI."""
    c = F.col(column)
    year = F.get_json_object(c, "$.issued['date-parts'][0][0]").try_cast("int")
    return answers.select("*", F.get_json_object(c, "$.title[0]").alias("title"), year.alias("year"), F.get_json_object(c, "$.DOI").alias("doi"))


def paper_rows(papers: DataFrame) -> DataFrame:
    """Papers with the abstract cut at 700 characters and the first five authors."""
    return papers.withColumn("abstract", truncated(F.col("abstract"), 700, "...")).withColumn("authors", first_authors(F.col("authors")))


def top_candidates(candidates: Column, top: int) -> Column:
    """Distinct structures in order of the service, at most ``top``."""
    return F.slice(F.array_distinct(F.filter(F.transform(candidates, strip), lambda s: F.coalesce(s, F.lit("")) != "")), 1, top)


def clean_names(names: Column, most: int) -> Column:
    """Distinct names by folded case, first spelling kept, at most ``most``."""
    kept = F.aggregate(
        F.filter(F.transform(names, strip), lambda n: n != ""),
        F.array().cast("array<string>"),
        lambda acc, n: F.when(F.exists(acc, lambda x: F.lower(x) == F.lower(n)), acc).otherwise(F.array_append(acc, n)),
    )
    return F.slice(kept, 1, most)


def classified_names(df: DataFrame, synonyms: str, most: int = 10) -> DataFrame:
    """Adds chinese_names, english_names, cas_numbers, and status: found with both languages, partial with one, else not_found."""
    of = lambda kind: F.filter(F.coalesce(F.col(synonyms), F.array().cast("array<string>")), lambda n: name_class(n) == kind)
    df = df.withColumns({"chinese_names": clean_names(of("chinese"), most), "english_names": clean_names(of("english"), most), "cas_numbers": clean_names(of("cas"), most)})
    have = (F.size("chinese_names") > 0).cast("int") + (F.size("english_names") > 0).cast("int")
    return df.withColumn("status", F.when(have == 2, "found").when(have == 1, "partial").otherwise("not_found")).withColumn("complete", have == 2)


def resolve_names(smiles: str, service: Service, most: int = 10) -> dict:
    """Names of one structure from a compound service: first id, its synonyms, classified. Failures are statuses."""
    if not smiles or not smiles.strip():
        return {"status": "invalid_smiles", "english": [], "chinese": [], "cas": []}
    found = service.call({"smiles": smiles})
    if found["completion"] != "success":
        return {"status": "not_found" if "HTTP 404" in found["warnings"] else "request_failed", "english": [], "chinese": [], "cas": []}
    said = [n for x in nested_items(found["data"], "Synonym") for n in x["Synonym"] if isinstance(n, str)]
    out: dict[str, list[str]] = {"english": [], "chinese": [], "cas": []}
    for n in map(str.strip, said):
        cjk, known_id = re.search("[一-鿿]", n), re.match("(?i)(?:" + "|".join(ID_PREFIXES) + ")", n)
        kind = "chinese" if cjk and 2 <= len(n) <= 160 else "cas" if re.match(CAS, n) else "english" if not cjk and not known_id and 2 <= len(n) <= 200 and re.search("[A-Za-z]", n) else None
        if kind and n.lower() not in map(str.lower, out[kind]) and len(out[kind]) < most:
            out[kind].append(n)
    both = bool(out["english"]) + bool(out["chinese"])
    return {"status": ("not_found", "partial", "found")[both], **out}


def compact(payload: dict) -> dict:
    """A tool result without the request's echo and without empty warnings."""
    return {k: v for k, v in payload.items() if k != "request" and not (k == "warnings" and not v)}
