"""Tool-using transcripts: Column expressions for the regular part, Arrow functions for full fidelity.

A flat transcript holds ``<tool_call>{...}</tool_call>`` blocks; the answer is a JSON object with a
``smiles`` list. ``marks`` finds the calls, fenced blocks and answer objects of a text once; turns, the answer's region
and the ranked answers are read off those marks. ``answers`` and ``turns`` run the grammar on Arrow batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import strip

#: Call block, fenced block, and inline answer object (formats fixed by the transcripts).
CALL = r"(?is)<tool_call>\s*(.*?)\s*</tool_call>"
FENCE = r"(?is)```(?:json)?\s*(.*?)```"
ANSWER = r'\{[^{}]*"smiles"\s*:\s*\[[\s\S]*?\]\s*\}'


def strip_calls(c: Column) -> Column:
    return strip(F.regexp_replace(c, CALL, ""))


def call_bodies(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(CALL), F.lit(1))


def orphan_calls(c: Column) -> Column:
    """Opening tags without an end."""
    return F.greatest(F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(?i)<tool_call>"), F.lit(0))) - F.size(call_bodies(c)), F.lit(0))


def answer_object(c: Column) -> Column:
    """The last inline answer object after the last closed call, as text; null if there is none."""
    region = F.element_at(F.split(F.coalesce(c, F.lit("")), "(?i)</tool_call>"), -1)
    found = F.regexp_extract_all(region, F.lit(ANSWER), F.lit(0))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def answer_list(c: Column) -> Column:
    """Trimmed non-empty strings of the last inline answer object."""
    got = F.from_json(answer_object(c), "struct<smiles:array<string>>")["smiles"]
    return F.coalesce(F.filter(F.transform(got, strip), lambda x: x != ""), F.array().cast("array<string>"))


def flat_content(blocks: Column) -> Column:
    """Text of content blocks (array<struct<text, content>>), one a line."""
    return F.array_join(F.transform(blocks, lambda b: F.coalesce(b["text"], b["content"], F.lit(""))), "\n")


def answer_json(smiles: Column) -> Column:
    return F.to_json(F.struct(smiles.alias("smiles")))


def last_assistant(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conversation, text): what the assistant said last; conversations without such a turn give the empty text."""
    said = F.when(F.col(role) == "assistant", F.struct(F.col(turn).alias("turn"), F.col(text).alias("text")))
    return df.groupBy(conversation).agg(F.coalesce(F.max(said)["text"], F.lit("")).alias("text"))


# --- full grammar, on rows ------------------------------------------------------------------------


@dataclass(frozen=True)
class Mark:
    kind: str
    start: int
    end: int
    body: str


#: What a text is searched for, the most trusted form of an answer last.
GRAMMAR = (("call", re.compile(CALL), 1), ("fence", re.compile(FENCE), 1), ("object", re.compile(ANSWER), 0))


def marks(text: str) -> list[Mark]:
    """All calls, fenced blocks and answer objects of a text in order; those before the last call's end belong to it or to a tool."""
    return sorted((Mark(kind, m.start(), m.end(), m[group].strip()) for kind, pattern, group in GRAMMAR for m in pattern.finditer(text)), key=lambda m: m.start)


def load(text: str):
    """(ok, value): JSON or nothing."""
    try:
        return True, json.loads(text)
    except ValueError:
        return False, None


def named(item: Any) -> str:
    """One answer of a list: text, or an object's smiles or canonical_smiles; empty if it is neither."""
    options = [item] if isinstance(item, str) else [item.get(k) for k in ("smiles", "canonical_smiles")] if isinstance(item, dict) else []
    return next((o.strip() for o in options if isinstance(o, str) and o.strip()), "")


def listed(blob: str) -> list[str] | None:
    """The answers that a JSON text lists under ``smiles`` (one text or a list); null if it is no such object."""
    value = load(blob)[1]
    got = value.get("smiles") if isinstance(value, dict) else None
    got = [got] if isinstance(got, str) else got
    return [n for x in got if (n := named(x))] if isinstance(got, list) else None


def answer_begin(text: str, found: list[Mark], tail: int) -> int:
    """Where the answer begins in what stands after ``tail``: at the last answer object, else at the last fenced one, else at once.

    A tool's result alone (an object with completion and status) holds no answer.
    """
    later = [m for m in found if m.start >= tail]
    spots = [m.start for m in later if m.kind == "object"] or [m.start for m in later if m.kind == "fence" and listed(m.body) is not None]
    if spots:
        return spots[-1]
    value = load(text[tail:].strip())[1]
    return len(text) if isinstance(value, dict) and {"completion", "status"} <= value.keys() else tail


def ranked_answers(text: str | None) -> list[str]:
    """Answers in order: of the forms after the last call, objects count before fenced blocks and those before the whole, later ones first."""
    text = text or ""
    found = marks(text)
    begin = answer_begin(text, found, max((m.end for m in found if m.kind == "call"), default=0))
    forms = sorted((m for m in found if m.kind != "call" and m.start >= begin), key=lambda m: (m.kind == "object", m.start), reverse=True)
    blobs = [*(m.body for m in forms), text[begin:].strip()]
    return next((got for b in blobs if b and (got := listed(b)) is not None), [])


def split_turns(text: str | None) -> list[dict[str, str]]:
    """A flat transcript as role-tagged turns: a call is the assistant's, what follows it the tool's, the answer the assistant's.

    Text before the first call is not kept (scores depend on it).
    """
    text = text or ""
    found = marks(text)
    calls = [m for m in found if m.kind == "call"]
    if not calls:
        return [{"role": "assistant", "content": text}]
    begin = answer_begin(text, found, calls[-1].end)
    said = [part for m, until in zip(calls, [*(c.start for c in calls[1:]), begin], strict=True) for part in (("assistant", text[m.start : m.end]), ("tool", text[m.end : until].strip()))]
    return [{"role": r, "content": c} for r, c in [*said, ("assistant", text[begin:].strip())] if c]


def last_json(text: str | None):
    """The JSON object or array that starts last in a free text, as text; null without one."""
    decoder, text = json.JSONDecoder(), text or ""
    for m in reversed(list(re.finditer(r"[\[{]", text))):
        try:
            return json.dumps(decoder.raw_decode(text, m.start())[0], ensure_ascii=False)
        except ValueError:
            continue
    return None


def segments(text: str | None) -> list[dict[str, str]]:
    """A logged output as text, tool_call and tool_response parts; JSON bodies are pretty-printed."""
    out = []
    at = 0
    for m in re.finditer(r"(?is)<(tool_call|tool_response)>\s*(.*?)\s*</\1>", text or ""):
        if (text[at : m.start()]).strip():
            out.append({"kind": "text", "content": text[at : m.start()].strip()})
        ok, value = load(m[2])
        out.append({"kind": m[1].lower(), "content": json.dumps(value, indent=2, ensure_ascii=False) if ok else m[2]})
        at = m.end()
    if (text or "")[at:].strip():
        out.append({"kind": "text", "content": text[at:].strip()})
    return out


def on_column(df: DataFrame, column: str, name: str, fn, kind: str) -> DataFrame:
    """Adds ``name`` = fn(column), on Arrow batches."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
    arrow = __import__("pyspark.sql.pandas.types", fromlist=["to_arrow_type"]).to_arrow_type(schema[name].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [fn(x) for x in b.column(b.schema.get_field_index(column)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, arrow)], names=[*b.schema.names, name])

    return df.mapInArrow(run, schema)


def answers(df: DataFrame, column: str, name: str = "answers") -> DataFrame:
    return on_column(df, column, name, ranked_answers, "array<string>")


def turns(df: DataFrame, column: str, name: str = "turns") -> DataFrame:
    return on_column(df, column, name, split_turns, "array<struct<role:string,content:string>>")
