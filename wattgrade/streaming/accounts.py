"""Keyed de-duplication that accounts for every record: first ones, and those that came too late to be judged."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATE = "late"
_MS, _KEY = "_event_ms", "_key_text"
# Groups of keys that share a state; more of them make each smaller.
BUCKETS = 1024


def _stored(known: dict[str, int]) -> bytes:
    batch = pa.record_batch([pa.array(known.keys(), pa.large_string()), pa.array(known.values(), pa.int64())], ["key", "ms"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _restored(stored: bytes) -> dict[str, int]:
    table = pa.ipc.open_stream(stored).read_all()
    return dict(zip(table.column("key").to_pylist(), table.column("ms").to_pylist(), strict=True))


def first_seen_and_late(
    records: DataFrame, key: Sequence[str], time: str, delay_seconds: int, buckets: int = BUCKETS
) -> DataFrame:
    """The first record of each key, and every record behind the watermark with ``late`` true; repeated ones are gone.

    Land it by ``late`` to get two tables from one read. Records without a time are neither late nor early: they are
    judged at the time zero of the epoch until a watermark exists, and are late after that. A key is remembered until the
    watermark has passed its time by the delay; its bucket drops it with the next records that come. Keys are judged a bucket at a time, so calls from Python to the state
    follow the buckets and not the keys; any state store will do. A bucket's records are read as a stream of batches, so a
    key of any share never fills a task's memory; a task holds the remembered keys of one bucket. ``buckets`` stays the
    same for the life of a checkpoint.
    """
    columns, keep_ms = records.columns, delay_seconds * 1000
    timed = records.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, f"{delay_seconds} seconds")
    millis = F.coalesce(F.unix_millis(F.col(time)), F.lit(0)).alias(_MS)
    schema = T.StructType([*timed.schema.fields, T.StructField(LATE, T.BooleanType())])
    # Names that are no identifiers are left out of the text, and times keep every digit; null is a key of its own.
    named = F.struct(*[F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(key)])
    exact = {f"timestamp{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" + zone for kind, zone in (("", "XXX"), ("NTZ", ""))}
    text = F.to_json(named, {"ignoreNullFields": "false", **exact})
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(buckets)).alias("_bucket")
    grouped = timed.select(*[F.col(f"`{c}`") for c in columns], millis, text.alias(_KEY), bucket).groupBy("_bucket")
    names = [*columns, _MS, _KEY]

    def judged(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        known = _restored(state.get[0]) if state.exists else {}
        known = {k: ms for k, ms in known.items() if ms + keep_ms >= watermark}
        for batch in batches:
            batch = batch.iloc[:, : len(names)].set_axis(names, axis=1)  # names that are no identifiers arrive changed
            late = batch[_MS] < watermark
            timely = batch[~late]
            fresh = timely[np.fromiter((k not in known for k in timely[_KEY]), bool)]
            first = fresh.sort_values(_MS, kind="stable").drop_duplicates(_KEY)
            known.update(zip(first[_KEY].tolist(), first[_MS].astype("int64").tolist(), strict=True))
            told = batch.loc[batch.index[late].union(first.index)]
            yield told.assign(**{LATE: late.loc[told.index]})[[*columns, LATE]]
        if known:
            state.update((_stored(known),))
        elif state.exists:
            state.remove()

    # Without a timeout Spark drops no late row; a bucket forgets what is due when its next records come.
    told = grouped.applyInPandasWithState(judged, schema, "seen binary", "append", GroupStateTimeout.NoTimeout)
    # An expression on top, since a sink that sorts rows by ``late`` does not take them as they come from Python.
    return told.withColumn(LATE, F.coalesce(LATE, F.lit(False)))
