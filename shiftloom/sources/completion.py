"""A chat-completion client: one or many prompts, order kept, counted; a DataFrame stage that is skipped when it is not configured."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .remote import Service, fan_out


@dataclass
class CompletionClient:
    url: str | None
    model: str = ""
    key: str = ""
    parallel: int = 8
    timeout: float = 60.0
    retries: int = 2
    counters: dict[str, int] = field(default_factory=lambda: {"requests": 0, "failures": 0})

    @property
    def available(self) -> bool:
        return bool(self.url and self.model)

    def _service(self) -> Service:
        headers = (("Content-Type", "application/json"), *((("Authorization", f"Bearer {self.key}"),) if self.key else ()))
        return Service(self.url if self.available else None, "POST", self.timeout, self.retries, headers=headers)

    def _payload(self, prompt: str) -> dict:
        return {"model": self.model, "messages": [{"role": "user", "content": prompt}]}

    def complete(self, prompt: str) -> str | None:
        """The answer's text; null on failure."""
        self.counters["requests"] += 1
        got = said(self._service().call(self._payload(prompt)))
        self.counters["failures"] += got is None
        return got

    def complete_many(self, prompts: Sequence[str]) -> list[str | None]:
        with ThreadPoolExecutor(self.parallel) as pool:
            return list(pool.map(self.complete, prompts))

    def stage(self, df: DataFrame, prompt: str, name: str = "rewrite") -> DataFrame:
        """Adds ``name`` from the prompt column; null everywhere without a client."""
        if not self.available:
            return df.withColumn(name, F.lit(None).cast("string"))
        service, payload = self._service(), self._payload

        def call(row: dict) -> dict:
            return {"text": said(service.call(payload(row[prompt] or "")))}

        out = fan_out(df, call, [prompt], "_answer", self.parallel)
        return out.withColumn(name, F.get_json_object("_answer", "$.text")).drop("_answer")


def said(result: dict) -> str | None:
    try:
        return result["data"]["choices"][0]["message"]["content"]
    except (KeyError, IndexError, TypeError):
        return None
