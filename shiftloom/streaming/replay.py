"""Scripted follow-ups and failure streaks, in batch and as state of a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


class ScriptedFollowup:
    """Per instance a queue of user turns: each call pops one, then the end is signalled; blanks are left out."""

    def __init__(self):
        self._turns: dict[str, list[str]] = {}

    def start(self, instance: str, followup_turns: list[str] | None) -> str:
        self._turns[instance] = [t for t in followup_turns or [] if isinstance(t, str) and t.strip()]
        return instance

    def generate(self, instance: str) -> tuple[bool, str]:
        queue = self._turns.get(instance)
        return (False, queue.pop(0)) if queue else (True, "")

    def finalize(self, instance: str) -> None:
        self._turns.pop(instance, None)


def replay(df: DataFrame, key: str, turns: str) -> DataFrame:
    """(key, step, content, done): the whole script of each row, a terminal row at its end."""
    filled = F.filter(F.coalesce(F.col(turns), F.array().cast("array<string>")), lambda t: F.coalesce(F.trim(t), F.lit("")) != "")
    script = F.concat(F.transform(filled, lambda t: F.struct(t.alias("content"), F.lit(False).alias("done"))), F.array(F.struct(F.lit("").alias("content"), F.lit(True).alias("done"))))
    return df.select(key, F.posexplode(script).alias("step", "x")).select(key, "step", "x.content", "x.done")


def replay_stream(calls: DataFrame, key: str = "instance") -> DataFrame:
    """A stream of (instance, turns) calls: the first call of an instance brings its turns, each call gets the next."""

    def step(ident, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        left = list(state.get[0]) if state.exists else None
        for pdf in batches:
            out = []
            for turns in pdf["turns"]:
                if left is None:
                    left = [t for t in (turns if turns is not None else []) if t and t.strip()]
                out.append((ident[0], left.pop(0), False) if left else (ident[0], "", True))
            yield pd.DataFrame(out, columns=[key, "content", "done"])
        state.update((left or [],))

    from pyspark.sql.streaming.state import GroupStateTimeout

    return calls.groupBy(key).applyInPandasWithState(step, f"{key} string, content string, done boolean", "left array<string>", "append", GroupStateTimeout.NoTimeout)


def failure_streaks(df: DataFrame, group: str, order: list[str], failed: str) -> DataFrame:
    """Adds ``streak`` (consecutive failures so far), ``warn`` (a multiple of three) and ``recovered`` (success after a failure)."""
    w = W.partitionBy(group).orderBy(*order)
    running = w.rowsBetween(W.unboundedPreceding, 0)
    bad = F.col(failed).cast("int")
    df = df.withColumn("_island", F.sum(1 - bad).over(running))
    island = W.partitionBy(group, "_island").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    df = df.withColumn("streak", F.sum(bad).over(island))
    return df.withColumn("warn", (F.col("streak") > 0) & (F.col("streak") % 3 == 0)).withColumn("recovered", ~F.col(failed) & (F.coalesce(F.lag("streak").over(w), F.lit(0)) > 0)).drop("_island")


def failure_stream(calls: DataFrame) -> DataFrame:
    """A stream of (tool, failed) calls: tool, streak, warn, recovered after each call."""

    def step(ident, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        for pdf in batches:
            out = []
            for failed in pdf["failed"]:
                before, n = n, n + 1 if failed else 0
                out.append((ident[0], n, bool(n and n % 3 == 0), bool(not failed and before)))
            yield pd.DataFrame(out, columns=["tool", "streak", "warn", "recovered"])
        state.update((n,))

    from pyspark.sql.streaming.state import GroupStateTimeout

    return calls.groupBy("tool").applyInPandasWithState(step, "tool string, streak bigint, warn boolean, recovered boolean", "n bigint", "append", GroupStateTimeout.NoTimeout)
