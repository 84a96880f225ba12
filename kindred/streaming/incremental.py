"""Resolution of arriving S1 records against a static pool, by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import silver
from ..operators import blocking, decisions
from ..operators.features import exact
from ..sources.scratch import written


def resolve_stream(arriving: DataFrame, pool: DataFrame, out: str, checkpoint: str, th_s2: float = 0.5, th_s3: float = 0.5, seen: tuple[str, ...] = (), offset: float = 0.0, similar: bool = False, k: int = blocking.TOP_K) -> StreamingQuery:
    """Links of each micro-batch to Parquet under out/batch=N. The pool is normalised and its postings are written
    once, before the first batch; a batch normalises its own rows alone. A batch that is run again overwrites its
    own folder, so each S1 is written once. One owner for each candidate holds within a batch."""
    held = written(silver(pool), "pool")
    index = written(blocking.postings(blocking.keys(held)), "postings")

    def each(batch: DataFrame, n: int) -> None:
        own = written(silver(batch), "arrived")
        pairs = blocking.probe(blocking.keys(own), index).select("sid", "cid").distinct()
        scored = blocking.overlap_score(blocking.with_sides(pairs, own.unionByName(held)))
        top = exact(blocking.top_k(blocking.composite_score(scored) if similar else scored, k))
        links = decisions.exclusive(decisions.above(top, th_s2, th_s3, seen, offset))
        links.select("sid", "cid", "p").write.mode("overwrite").parquet(f"{out}/batch={n}")

    return arriving.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
