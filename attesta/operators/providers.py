"""Models and recognisers outside the engine, as injected functions over Arrow batches. Tests inject fakes.

A provider is made once in each Python worker, so that a model is loaded there; it gets and gives lists.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def backoff(n: int) -> float:
    """Seconds to wait after the n-th failed call: from 4, doubled each time, at most 120."""
    return min(120.0, 4.0 * 2**n)


def at_once(n: int) -> float:
    """No wait: for models made by rule; give `backoff` for a service."""
    return 0.0


def answers(rows: DataFrame, prompt_col: str, make: Callable[[], Callable[[str], str]], out_col: str = "answer", tries: int = 10, wait: Callable[[int], float] = backoff) -> DataFrame:
    """Ask a provider for every row's prompt. A call that fails is tried again after a growing wait; after the last try answer is null and error says why."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{out_col}` string, error string"

    def ask(call: Callable[[str], str], prompt: str) -> tuple[str | None, str | None]:
        error = None
        for n in range(tries):
            try:
                return call(prompt), None
            except Exception as e:  # a provider may fail in any way; the row keeps the reason
                error = f"{type(e).__name__}: {e}"
                if n + 1 < tries:
                    time.sleep(wait(n))
        return None, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for b in batches:
            found = [ask(call, p) for p in b[prompt_col]]
            yield b.assign(**{out_col: [a for a, _ in found], "error": [e for _, e in found]})

    return rows.mapInPandas(run, schema)


def embedded(rows: DataFrame, text_col: str, make: Callable[[], Callable[[list[str]], list[list[float]]]] | None, out_col: str = "embedding") -> DataFrame:
    """Add unit vectors of the texts; without a provider they are null."""
    if make is None:
        return rows.withColumn(out_col, F.lit(None).cast("array<double>"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{out_col}` array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = make()
        for b in batches:
            yield b.assign(**{out_col: embed(b[text_col].tolist())})

    return rows.mapInPandas(run, schema)


def parsed_json(rows: DataFrame, col: str, schema: str, out_col: str = "parsed") -> DataFrame:
    """Parse answers as JSON after removing a fence; parse_error marks those that are none, whose text is kept in raw_text."""
    from attesta.functions.text import strip_json_fence

    body = strip_json_fence(F.col(col))
    valid = F.try_parse_json(body).isNotNull()
    return rows.withColumn(out_col, F.when(valid, F.from_json(body, schema))).withColumn("parse_error", ~valid).withColumn("raw_text", F.when(~valid, F.col(col)))
