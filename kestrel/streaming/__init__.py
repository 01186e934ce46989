"""Streaming surface.

The reference has no streams (every input is a finished file). The only
stream-shaped needs are scoring newly arriving rows with a persisted
pipeline and appending to the experiment log; both are provided for
Structured Streaming without any extra stateful operator.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from kestrel.operators.training import batch_score


def score_stream(model: PipelineModel, stream: DataFrame, key: str) -> DataFrame:
    """Apply a fitted pipeline to a streaming DataFrame (stateless map)."""
    return batch_score(model, stream, key)


def write_scores_per_batch(scored: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append each micro-batch to a parquet table; the query checkpoint in the
    shared folder makes a restarted query resume without duplicates."""
    w = scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
