"""Which run a stream belongs to."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from badgeflow.sources import files
from badgeflow.sources.tables import BY_HAND


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """A stream's own name, kept in its checkpoint: a new checkpoint is a new run.

    Batch numbers start anew with it, and must not name the batches of an earlier run.
    """
    if not files.exists(spark, f"{checkpoint}/metadata"):
        return BY_HAND
    return f"stream-{json.loads(spark.read.text(f'{checkpoint}/metadata').first().value)['id']}"
