"""Remote services: JSON and event-stream calls on Arrow batches, a bounded number at a time, with retries.

Calls in flight are partitions x ``parallel``; answers keep their rows. Nothing is called where no endpoint is set.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Service:
    url: str | None
    method: str = "POST"
    timeout: float = 60.0
    retries: int = 2
    pause: float = 1.0
    headers: tuple[tuple[str, str], ...] = (("Content-Type", "application/json"),)

    def call(self, payload: dict) -> dict:
        """{completion, status, data, warnings}: unavailable without an endpoint; a 404 is not tried again."""
        if not self.url:
            return {"completion": "failure", "status": "unavailable", "data": None, "warnings": ["no endpoint is set"]}
        last = ""
        for attempt in range(self.retries + 1):
            try:
                if self.method == "GET":
                    request = urllib.request.Request(f"{self.url}?{urllib.parse.urlencode(payload)}", headers=dict(self.headers))
                else:
                    request = urllib.request.Request(self.url, json.dumps(payload).encode(), dict(self.headers))
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    body = answer.read().decode("utf-8", "replace")
                return {"completion": "success", "status": "ok", "data": events(body) if self.method == "SSE" else json.loads(body), "warnings": []}
            except urllib.error.HTTPError as e:
                last = f"HTTP {e.code}"
                if e.code == 404:
                    break
            except (OSError, ValueError) as e:
                last = str(e)
            if attempt < self.retries:
                time.sleep(self.pause * (attempt + 1))
        return {"completion": "failure", "status": "error", "data": None, "warnings": [last]}


def events(body: str) -> list:
    """JSON bodies of ``data:`` lines up to ``[DONE]``; comments and other lines are skipped."""
    out = []
    for line in body.splitlines():
        if not line.startswith("data:"):
            continue
        text = line[5:].strip()
        if text == "[DONE]":
            break
        try:
            out.append(json.loads(text))
        except ValueError:
            continue
    return out


def nested_items(value, key: str) -> list:
    """All dicts below a value that hold ``key``, in order."""
    found, stack = [], [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            if key in v:
                found.append(v)
            stack.extend(reversed(list(v.values())))
        elif isinstance(v, list):
            stack.extend(reversed(v))
    return found


def candidate_list(answer) -> list:
    """The candidates of an answer under one of the known keys, or inside ``data``."""
    for _ in range(3):
        if isinstance(answer, list):
            return answer
        if not isinstance(answer, dict):
            return []
        got = next((answer[k] for k in ("candidates", "results", "smiles_list", "smiles", "result", "hits") if isinstance(answer.get(k), list)), None)
        if got is not None:
            return got
        answer = answer.get("data")
    return []


def fan_out(df: DataFrame, service: Service | Callable[[dict], dict], columns: list[str], name: str = "answer", parallel: int = 8) -> DataFrame:
    """Adds ``name``: each row's answer as JSON text."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])
    call = service.call if isinstance(service, Service) else service

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(parallel) as pool:
            for b in batches:
                got = list(pool.map(call, b.select(columns).to_pylist()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([json.dumps(g, ensure_ascii=False) for g in got], pa.string())], names=[*b.schema.names, name])

    return df.mapInArrow(run, schema)
