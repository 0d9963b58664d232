"""Keeping profiles and pending orphans up to date from streams of files.

Each trigger is one micro-batch of new rows; the state is a set of parquet tables in the given folder, one version per
batch. A batch that is replayed after a failure finds its version already written and does nothing, so counts are never
applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelloom.operators import orphans, quality_profile
from panelloom.sources.versions import Versions


def stream_files(spark: SparkSession, folder: str, schema) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def _drain(rows: DataFrame, checkpoint: str, act: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return rows.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def maintain_profile(rows: DataFrame, load: Column, columns: list[str], state: str, checkpoint: str) -> StreamingQuery:
    """Apply each batch's value-count delta to the persistent counts in ``state``."""
    store = Versions(rows.sparkSession, state, "load string, column string, value string, n long")

    def act(batch: DataFrame, number: int) -> None:
        if not store.has(number):
            store.write(quality_profile.apply_delta(store.latest(), quality_profile.value_counts(batch, load, columns)), number)

    return _drain(rows, checkpoint, act)


EVENTS = "side string, table_name string, source_file string, varnumber string, year int, n long"


def orphan_state(spark: SparkSession, state: str) -> tuple[orphans.State, dict[str, Versions]]:
    """The keyed state in a folder, and the versioned tables that hold it."""
    none = orphans.start(spark)
    stores = {name: Versions(spark, f"{state}/{name}", getattr(none, name).schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")) for name in ("index", "counts", "pending")}
    return orphans.State(**{name: store.latest() for name, store in stores.items()}), stores


def maintain_orphans(events: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """Advance the keyed state in ``state`` by each batch of ``events`` (see ``EVENTS``).

    An event is ``n`` references (side ``reference``) or parents (side ``parent``) of a key that come (n > 0) or go (n < 0): new
    references probe the index, arriving parents resolve what waits, deletions reopen it. The pending table is written last, so
    a batch that was cut off is done again from the version before.
    """

    def act(batch: DataFrame, number: int) -> None:
        now, stores = orphan_state(batch.sparkSession, state)
        if stores["pending"].has(number):
            return
        key = orphans.KEY
        references = batch.where("side = 'reference'").groupBy(*key).agg(F.sum("n").alias("n"))
        parents = batch.where("side = 'parent'").groupBy(*orphans.PARENT_KEY).agg(F.sum("n").alias("n"))
        before = orphans.State(**{name: store.before(number) for name, store in stores.items()})
        after = orphans.advance(before, references, parents)
        for name in ("index", "counts", "pending"):
            stores[name].write(getattr(after, name).coalesce(8), number)

    return _drain(events, checkpoint, act)


def open_references(spark: SparkSession, state: str) -> DataFrame:
    """The references that wait for a parent, per table and period."""
    return orphans.snapshot(orphan_state(spark, state)[0].pending)
