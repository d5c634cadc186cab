"""Quality rules with cross-document line frequency, in DataFrame operations only.

A line (``\\n``-split, with at least one word) is normalised (lower case, white space runs to one
blank, trimmed) and hashed to 64 bits. The distinct documents that hold it are counted per host. A line in
at least ``floor_docs`` documents of its host and in more than ``share_per_mille`` thousandths of them
is boilerplate and is taken out of the text; a document that loses more than ``depleted_percent`` % of the
characters of its distinct normalised lines is depleted and rejected.

Each document emits its distinct lines once, stored as hashes. Rows are counted first, partially aggregated
before the shuffle on (host, line), so a line that a third of all documents share costs each map task one row; only
lines that reach the limits that way are counted again by distinct documents. The lines above the limits are
one list a host: more than a share of the host's documents hold each, so a host has at most its mean number of lines a
document times 1000 / ``share_per_mille`` of them (or, below the floor's size, a few documents' lines). Documents meet
their host's list by a broadcast where its stored size is small, else by a join that AQE splits where a host is large.

Defined cases: a document is a row's id, for null ids the row itself; rows that repeat an id count once; null text has
no words and fails the base rules; a null host is a host of its own; repeated rows get the same verdict; an empty
table gives an empty result; columns other than the named ones are ignored; null ids are returned as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sizes import small_side
from ._spark import stored

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8


def repeated_words(windows: str) -> Column:
    """Words covered by windows whose hash occurs at least twice; ``windows``: array column of hashes."""
    w = F.col(windows)
    ranked = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    marked = F.transform(
        F.array(ranked),  # binds the sorted array to a name
        lambda s: F.aggregate(
            F.array_sort(
                F.transform(
                    F.filter(
                        F.sequence(F.lit(0), F.size(s) - 1),
                        lambda j: F.coalesce(F.get(s, j)["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(F.get(s, j)["h"] == F.get(s, j + 1)["h"], F.lit(False)),
                    ),
                    lambda j: F.get(s, j)["i"],
                )
            ),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")),
        )["n"],
    )
    return F.when(F.size(w) == F.size(F.array_distinct(w)), F.lit(0)).otherwise(F.get(marked, F.lit(0)))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def plain_line(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), SPACE, " "))


def named(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """doc_id, host (null as a mark of its own), t (the text, null as empty)."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("\0null")).alias("host"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))


def frequent_lines(rows: DataFrame, floor_docs: int, share_per_mille: int) -> DataFrame:
    """(host, line, n_docs) of boilerplate lines; ``rows`` from ``named``."""
    ident = F.coalesce("doc_id", F.xxhash64(F.lit("-"), "host", "t"))
    hashes = F.array_distinct(F.transform(_lines(F.col("t")), lambda x: F.xxhash64(plain_line(x))))
    held, _ = stored(rows.select("host", ident.alias("ident"), hashes.alias("lines")))
    hosts = held.select("host", "ident").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    lines = held.select("host", "ident", F.explode("lines").alias("line"))
    enough = (F.col("n_docs") >= floor_docs) & (1000 * F.col("n_docs") > share_per_mille * F.col("host_docs"))
    # a line's rows are no fewer than its documents, so this loses none
    maybe = lines.groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= floor_docs).join(hosts, "host").where(enough).select("host", "line", "host_docs")
    maybe, _ = stored(maybe)
    counted = lines.join(small_side(maybe), ["host", "line"]).select("host", "line", "ident", "host_docs").distinct()
    return counted.groupBy("host", "line").agg(F.count("*").alias("n_docs"), F.first("host_docs").alias("host_docs")).where(enough).select("host", "line", "n_docs")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", floor_docs: int = 3, share_per_mille: int = 50, depleted_percent: int = 70) -> DataFrame:
    """doc_id, counts, base_failed, removed_lines, removed_chars, depleted, kept, text: one row per row of ``docs``.

    ``text`` is the document without its boilerplate lines; removed_lines counts the lines taken out, removed_chars the
    characters of the distinct normalised ones.
    """
    rows = named(docs, doc_id, text, host)
    bad, _ = stored(frequent_lines(rows, floor_docs, share_per_mille).groupBy("host").agg(F.sort_array(F.collect_set("line")).alias("bad")))
    d = rows.join(small_side(bad), "host", "left").withColumn("bad", F.coalesce("bad", F.array().cast("array<bigint>")))
    d = d.withColumn("words", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    d = d.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x))).withColumn("lines", _lines(F.col("t")))
    windows = F.when(
        F.size("hashes") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    plain = F.transform("lines", lambda x: F.struct(F.xxhash64(plain_line(x)).alias("h"), F.length(plain_line(x)).cast("long").alias("n")))
    # each line as it stands, with whether it goes; lines without a word stay
    marked = F.transform(F.split("t", "\n"), lambda x: F.struct(x.alias("line"), (x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains("bad", F.xxhash64(plain_line(x)))).alias("gone")))
    d = d.withColumns({"windows": windows, "plain": F.array_distinct(plain), "marked": F.when(F.size("bad") > 0, marked)})
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + x["n"])
    lost = F.when(F.size("bad") > 0, total(F.filter("plain", lambda x: F.array_contains("bad", x["h"])))).otherwise(F.lit(0).cast("long"))
    gone = F.coalesce(F.size(F.filter("marked", lambda x: x["gone"])), F.lit(0))
    clean = F.when(gone > 0, F.array_join(F.transform(F.filter("marked", lambda x: ~x["gone"]), lambda x: x["line"]), "\n")).otherwise(F.col("t"))
    d = d.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("windows").cast("long").alias("n_repeat_words"),
        gone.cast("long").alias("removed_lines"), lost.alias("removed_chars"), total("plain").alias("line_chars"), clean.alias("text"),
    )
    d = d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    d = d.withColumn("depleted", 100 * F.col("removed_chars") > depleted_percent * F.col("line_chars")).drop("line_chars")
    return d.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
