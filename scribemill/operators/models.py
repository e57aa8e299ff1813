"""Hooks for models: any function from a list of inputs to a list of outputs, run over Arrow batches of chunks.

A model is loaded once a worker process, by the factory that is sent along, and kept there under its name. Filter before
the hook: a predicate does not pass a Python step.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

_loaded: dict[str, object] = {}


def loaded(name: str, factory: Callable):
    """The model of this name in this process. Tasks import this function, so what it holds outlives them."""
    if name not in _loaded:
        _loaded[name] = factory()
    return _loaded[name]


def with_model(rows: DataFrame, column: str, output: str, kind: str, factory: Callable, batch: int = 16, name: str | None = None) -> DataFrame:
    """Adds what the model says about a column. factory() gives the model: a callable from a list to a list as long.
    name: what the model is kept under in each worker process, for later calls that meet the process (None: for this call). Nulls go to the model as None; a column of the
    output's name is replaced; an empty table gives none."""
    token = name or uuid.uuid4().hex

    def run(frames):
        from scribemill.operators.models import loaded as get

        model = get(token, factory)
        for df in frames:
            values, out = df[column].tolist(), []
            for i in range(0, len(values), batch):
                part = model(values[i : i + batch])
                if len(part) != len(values[i : i + batch]):
                    raise ValueError("the model gave another number of outputs than inputs")
                out += list(part)
            yield df.drop(columns=[output], errors="ignore").assign(**{output: pd.Series(out, index=df.index, dtype=object)})

    kept = [f for f in rows.schema.fields if f.name != output]
    return rows.mapInPandas(run, StructType([*kept, StructField(output, _parse_datatype_string(kind))]))


def to_detect(chunks: DataFrame, least_ms: int = 20_000) -> DataFrame:
    """Chunks long enough whose language is not known yet."""
    return chunks.where((F.col("duration") >= least_ms) & F.col("language_probs").isNull())


def to_transcribe(chunks: DataFrame, language=None, lang: str = "sv", least_ms: int = 20_000) -> DataFrame:
    """Chunks long enough whose likeliest language is the one asked for."""
    return chunks.where((F.col("duration") >= least_ms) & F.col("language_probs").isNotNull() & ((F.col("language") if language is None else language) == lang))
