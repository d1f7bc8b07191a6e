"""Standings over a stream of battle files (Structured Streaming)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerplay.operators.gamelog import battle_sides, standings
from ledgerplay.session import checkpoint_dir


def standings_stream(spark: SparkSession, source_dir: str, schema: StructType | str, query_name: str,
                     checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Read battle files as they arrive; keep per-player standings in a memory table.

    ``battle_sides`` is stateless (explode); ``standings`` is a streaming
    aggregation whose state is one row per player, checkpointed in the shared
    folder, so a restarted query resumes where it stopped.
    """
    battles = spark.readStream.schema(schema).parquet(source_dir)
    agg = standings(battle_sides(battles))
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "ledgerplay-streams", f"{query_name}-{uuid.uuid4().hex}")
    w = agg.writeStream.outputMode("complete").format("memory").queryName(query_name).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
