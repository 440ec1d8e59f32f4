"""Repeated keys of tables too large to shuffle their keys.

Every key has a position among many more positions than there are keys. Tasks
send the positions they saw as sorted, packed lists; positions seen twice are
few, and only rows at such a position are counted by their keys, which makes the
result exact. Keys without repeats thus cost a byte or a few each instead of a
row, however long they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.integrity import key_violations
from riskloom.storage import BROADCAST_ROWS, materialize

# Keys a task holds before it sends lists: 64 MB of positions, about three times that while they are sorted.
HELD_KEYS = 1 << 23
# Keys of a bucket, until there are MOST_BUCKETS; then a task's list of a bucket still has some 256 keys.
BUCKET_KEYS = 1 << 20
MOST_BUCKETS = 1 << 15
# Different keys that may be expected to meet at a position, and positions per key at least.
CHANCE_MEETINGS = 1 << 16
ROOM = 64


def grid(keys: int) -> tuple[int, int]:
    """(buckets, places in each) for a number of keys. Places grow with the
    square of the keys, so that chance meetings stay few, up to 63 bits in all."""
    buckets = min(max(1, math.ceil(keys / BUCKET_KEYS)), MOST_BUCKETS)
    wanted = max(ROOM * keys, keys * keys // (2 * CHANCE_MEETINGS), 2)
    places = 1 << max(0, math.ceil(wanted / buckets) - 1).bit_length()
    return buckets, min(places, (1 << 63) // buckets)


def _position(key: Sequence[str], buckets: int, places: int):
    """Bucket and place of a row's key in one number, place * buckets + bucket."""
    return F.pmod(F.shiftrightunsigned(F.xxhash64(*key), 1), F.lit(buckets * places - 1))


def position_lists(df: DataFrame, key: Sequence[str], buckets: int, places: int, held: int = HELD_KEYS) -> DataFrame:
    """(bucket, once, twice): per task and bucket the places seen, and those
    seen more than once, each once, in order, packed."""

    def lists(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        def pack(places):
            gaps = np.diff(places, prepend=0).astype("<u8")
            return zlib.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 6) if len(gaps) else b""

        def send(parts):
            at = np.concatenate(parts)
            at, times = np.unique(at, return_counts=True)
            of, place = at % buckets, at // buckets
            order = np.argsort(of, kind="stable")  # places stay in order
            of, place, often = of[order], place[order], times[order] > 1
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            rows = {"bucket": [], "once": [], "twice": []}
            for a, b in zip(starts, [*starts[1:], len(of)], strict=True):
                rows["bucket"].append(int(of[a]))
                rows["once"].append(pack(place[a:b]))
                rows["twice"].append(pack(place[a:b][often[a:b]]))
            return pa.RecordBatch.from_pydict(
                {"bucket": pa.array(rows["bucket"], pa.int64()), "once": pa.array(rows["once"], pa.binary()), "twice": pa.array(rows["twice"], pa.binary())}
            )

        parts, size = [], 0
        for batch in batches:
            parts.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= held:
                yield send(parts)
                parts, size = [], 0
        if size:
            yield send(parts)

    return df.select(_position(key, buckets, places)).mapInArrow(lists, "bucket bigint, once binary, twice binary")


def _met(lists: DataFrame, buckets: int) -> DataFrame:
    """Positions that several lists hold, or one list twice."""

    def meet(rows):
        import zlib

        import numpy as np
        import pandas as pd

        def unpack(packed):
            if not packed:
                return np.empty(0, np.int64)
            planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
            return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64))

        seen = np.sort(np.concatenate([unpack(p) for p in rows["once"]]))
        again = np.concatenate([seen[1:][seen[1:] == seen[:-1]], *[unpack(p) for p in rows["twice"]]])
        return pd.DataFrame({"_at": np.unique(again) * buckets + int(rows["bucket"].iloc[0])})

    return lists.groupBy("bucket").applyInPandas(meet, "_at bigint")


def repeated_keys(df: DataFrame, key: Sequence[str], held: int = HELD_KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows: what
    ``key_violations`` returns, from three passes over the key columns and a
    shuffle of packed positions. NULL is a key like any other; an empty table has
    none. With more than ``BROADCAST_ROWS`` positions met, repeats are no
    exception, and keys are counted plainly."""
    buckets, places = grid(df.count())
    met = materialize(_met(position_lists(df, key, buckets, places, held), buckets), "positions")
    if met.count() > BROADCAST_ROWS:
        return key_violations(df, key)
    at = max([*key, "_at"], key=len) + "_"  # no key column is called so
    rows = df.select(*key, _position(key, buckets, places).alias(at))
    return key_violations(rows.join(F.broadcast(met.withColumnRenamed("_at", at)), at, "left_semi"), key)
