"""Named tools with parameter schemas: registration, validation, uniform results, and failure counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from ..functions.schema_check import decoded_arguments, problems
from ..sources.remote import Service
from . import answers


@dataclass(frozen=True)
class Tool:
    name: str
    description: str
    parameters: dict
    run: Callable[[dict], dict]

    @property
    def schema(self) -> dict:
        return {"type": "function", "function": {"name": self.name, "description": self.description, "parameters": self.parameters}}


def result(completion: str, status: str, data: Any = None, warnings: list[str] | None = None) -> dict:
    return {"completion": completion, "status": status, "data": data, "warnings": warnings or []}


@dataclass
class Registry:
    """Tools by name in the order of registration."""

    tools: dict[str, Tool] = field(default_factory=dict)
    streaks: dict[str, int] = field(default_factory=dict)

    def register(self, tool: Tool, replace: bool = False) -> None:
        if tool.name in self.tools and not replace:
            raise ValueError(f"tool {tool.name!r} is registered already")
        self.tools[tool.name] = tool

    def get(self, name: str) -> Tool:
        return self.tools[name]

    @property
    def names(self) -> list[str]:
        return list(self.tools)

    def schemas(self, names: list[str] | None = None) -> list[dict]:
        unknown = [n for n in names or [] if n not in self.tools]
        if unknown:
            raise ValueError(f"unknown tools: {', '.join(unknown)}")
        return [self.tools[n].schema for n in (names if names is not None else self.tools)]

    def invoke(self, name: str, arguments: dict | str) -> dict:
        """The tool's result; unknown names, bad arguments and exceptions become failures, every third in a row warns.

        Arguments may be JSON text of an object.
        """
        wrong = None
        if isinstance(arguments, str):
            arguments, wrong = decoded_arguments(arguments)
        if name not in self.tools:
            out = result("failure", "error", warnings=[f"unknown tool {name!r}"])
        elif wrong:
            out = result("failure", "error", warnings=[wrong])
        elif found := list(problems(arguments, self.tools[name].parameters)):
            out = result("failure", "error", warnings=found)
        else:
            try:
                out = self.tools[name].run(arguments)
            except Exception as e:  # a tool's own failure is a result, not a crash of the caller
                out = result("failure", "error", warnings=[str(e)])
        before = self.streaks.get(name, 0)
        n = self.streaks[name] = before + 1 if out["completion"] == "failure" else 0
        if n and n % 3 == 0:
            out["warnings"] = [*out["warnings"], f"{name} failed {n} times in a row"]
        elif before and not n:
            out["warnings"] = [*out["warnings"], f"{name} works again"]
        return out


def _object(required: list[str], **properties: dict) -> dict:
    return {"type": "object", "properties": properties, "required": required, "additionalProperties": False}


_TEXT, _NUMBER = {"type": "string"}, {"type": "number"}
_TEXTS, _NUMBERS = {"type": "array", "items": _TEXT}, {"type": "array", "items": _NUMBER}
_COUNT = {"type": "integer", "minimum": 1}
_TOP = {"type": "integer", "minimum": 1, "maximum": 100}
_PEAKS = {"type": "array", "items": {"type": "object"}}
_SPECTRUM = {"h_nmr_peaks": _PEAKS, "c_nmr_peaks": _PEAKS, "h_shifts": _NUMBERS, "h_split": _TEXTS, "c_shifts": _NUMBERS, "formula": _TEXT, "solvent": _TEXT}
_KNOBS = {"sigma_h": _NUMBER, "sigma_c": _NUMBER, "split_coef": _NUMBER, "use_h_split": {"type": "boolean"}, "use_stereo": {"type": "boolean"}, "include_active_hs": _TEXT, "optional_halogens": _TEXTS, "invalid_patterns": _TEXTS} | {k: _COUNT for k in ("max_iter", "num_search", "num_pool", "num_filter_pair", "num_filter_mol", "num_mutate_mol", "max_cycle_length")}
_REACTION = {"reactants": _TEXTS, "reagents": _TEXTS, "solvent": _TEXTS, "formula": _TEXT, "hints": _TEXTS, "backend": _TEXT, "top": _TOP}

#: Remote tools: name, what it does, parameters, required ones, method, time-out.
REMOTE = (
    ("web_search", "Search the web.", {"query": _TEXT, "time_range": _TEXT, "limit": _TOP}, ["query"], "SSE", 60),
    ("wikipedia_search", "Search Wikipedia.", {"query": _TEXT, "limit": {"type": "integer", "minimum": 1, "maximum": 50}}, ["query"], "GET", 30),
    ("crossref_search", "Search Crossref works.", {"query": _TEXT, "limit": _TOP}, ["query"], "GET", 30),
    ("semantic_scholar_search", "Search papers.", {"query": _TEXT, "limit": _TOP}, ["query"], "GET", 30),
    ("nmr_generate", "Structures from a spectrum.", {**_SPECTRUM, "nmr_type": _TEXT, "top": _TOP}, [], "POST", 180),
    ("nmr_repair", "Repair a structure to a formula.", {"smiles": _TEXT, "seed_smiles": _TEXT, "formula": _TEXT, "molecular_formula": _TEXT}, [], "POST", 60),
    ("nmr_rerank", "Score structures against a spectrum.", {"smiles_list": _TEXTS, **_SPECTRUM, "top": _TOP}, ["smiles_list"], "POST", 120),
    ("nmr_forward_predict", "Predict a spectrum.", {"smiles": _TEXT, "solvent": _TEXT}, ["smiles"], "POST", 60),
    ("nmrexp_search", "Search experimental spectra.", {**_SPECTRUM, **_KNOBS, "top": _TOP}, [], "POST", 60),
    ("askcos_reaction_forward_predict", "Predict products.", _REACTION, ["reactants"], "POST", 120),
    ("unimol3_reaction_forward_predict", "Predict products.", _REACTION, ["reactants"], "POST", 120),
    ("code_interpreter", "Run code in a remote sandbox.", {"code": _TEXT, "timeout": _NUMBER}, ["code"], "POST", 60),
)
DEFAULT_NAMES = ("reaction_local_index_search", "nmr_generate", "nmr_rerank", "nmr_forward_predict", "nmrexp_search")


def remote_tool(name: str, description: str, parameters: dict, required: list[str], method: str, timeout: float, url: str | None) -> Tool:
    """A service behind a tool: arguments become its request, its answer becomes ranked rows."""
    service, shape = Service(url, method, timeout), answers.SHAPES.get(name, answers.PLAIN)

    def run(arguments: dict) -> dict:
        arguments, payload, warnings = shape.ask(arguments)
        if payload is None:
            kind = ("success", "no_candidates", {"candidates": []}) if shape.key == "candidates" and warnings and warnings[0].startswith("formula") else ("failure", "error", None)
            return result(*kind, warnings)
        out = service.call(payload)
        if out["completion"] != "success":
            return out | {"data": {"request": payload}, "warnings": [*warnings, *out["warnings"]]}
        rows = shape.read(out["data"], arguments)
        if shape.key is None:
            return result("success", "ok", rows, warnings)
        return result("success", "ok" if rows else f"no_{shape.key}", {"request": payload, shape.key: rows}, warnings)

    return Tool(name, description, _object(required, **parameters), run)


def default_registry(endpoints: dict[str, str] | None = None, search: Callable[[dict], dict] | None = None) -> Registry:
    """All thirteen tools; those without an endpoint (and the search without an index) answer unavailable."""
    r = Registry()
    local = search or (lambda _: result("failure", "unavailable", warnings=["no reaction index is set"]))
    r.register(Tool("reaction_local_index_search", "Find precedents by shared components.", _object([], reaction=_TEXT, reactants=_TEXTS, reagents=_TEXTS, formula=_TEXT, hints=_TEXTS, top=_TOP), local))
    for row in REMOTE:
        r.register(remote_tool(*row, (endpoints or {}).get(row[0])))
    return r


def register_udtf(spark, registry: Registry, name: str = "call_tool") -> None:
    """SQL: SELECT * FROM call_tool('tool', '{json arguments}')."""
    import json

    from pyspark.sql.functions import udtf

    class Call:
        def eval(self, tool: str, arguments: str):
            out = registry.invoke(tool, arguments)
            yield out["completion"], out["status"], json.dumps(out["data"], ensure_ascii=False), "; ".join(out["warnings"])

    spark.udtf.register(name, udtf(Call, returnType="completion string, status string, data string, warnings string"))
