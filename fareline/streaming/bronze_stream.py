"""Bronze refresh driven by commits of the landing table instead of a schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fareline.plans import pipeline
from fareline.sources import tables
from fareline.sources.store import Store


def refresh_bronze(store: Store, checkpoint: str) -> StreamingQuery:
    """Process every version committed since the checkpoint, then stop.

    The stream reads manifests, so it sees only what is committed. A batch says that something
    changed; which files did is told by the marks of both tables, as in the batch refresh, so
    a version that was replaced or vacuumed in the meantime is not missed.
    """

    def refresh(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            pipeline.refresh_bronze_trips(store)

    manifests = tables.manifests_folder(store.path("yellow_trips"))
    return (
        store.spark.readStream.schema("number long, changed array<string>").json(manifests)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
