"""Linkage of queries that arrive in micro-batches against stored targets.

Ranks within a query aren't allowed on a stream, so each micro-batch is linked as a table of its own
and written under its number: a batch that is run again overwrites itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import enrich
from ..plans.linkage import link


def link_stream(arrivals: DataFrame, targets: DataFrame, out: str, checkpoint: str, event_time: str | None = None, late: str = "1 hour", **options) -> StreamingQuery:
    """Link a stream of records (entity_id, business_name, business_address, country) and write matches to out/batch=n.

    With event_time, a record sent again within `late` is dropped.
    """
    if event_time:
        arrivals = arrivals.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["entity_id"])

    def one(batch: DataFrame, number: int) -> None:
        matches = link(enrich(batch.dropDuplicates(["entity_id"])), targets, **options).matches
        matches.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arrivals.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
