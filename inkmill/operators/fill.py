"""Pending answers completed by a language model that the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import PENDING
from .shape import turn


def pending(pairs: DataFrame, key: str = "rec_id", chosen: str = "chosen") -> DataFrame:
    """(key, system, prompt) of the pairs whose first gpt turn of the chosen answer is the placeholder itself."""
    waits = F.coalesce(turn(chosen, "gpt") == PENDING, F.lit(False))
    return pairs.where(waits).select(key, F.coalesce(turn(chosen, "system"), F.lit("")).alias("system"), F.coalesce("prompt", F.lit("")).alias("prompt"))


def filled(pairs: DataFrame, client: Callable[[], Callable[[str, str], str | None]], done: DataFrame | None = None, key: str = "rec_id", limit: int | None = None) -> DataFrame:
    """(key, answer) of pending pairs that ``done`` (key) hasn't yet; a null answer is a failed call, to be tried again.

    ``client`` is called once per task and returns a function of system text and prompt. Appending the result to what ``done``
    reads makes a run that can be stopped and taken up again. ``limit`` is for trials: the first pairs by key.
    """
    open_ = pending(pairs, key)
    if done is not None:
        open_ = open_.join(done.select(key).distinct(), key, "left_anti")
    if limit is not None:
        open_ = open_.orderBy(key).limit(limit)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        for b in batches:
            yield pd.DataFrame({key: b[key], "answer": pd.Series([call(s, p) for s, p in zip(b["system"], b["prompt"])], dtype=object)})

    return open_.mapInPandas(ask, f"`{key}` {dict(pairs.dtypes)[key]}, answer string")
