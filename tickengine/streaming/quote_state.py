"""F6 + F7 as a Structured Streaming query: the quote producer's publication rule, live.

State per instrument is the last published signature and its time. A quote is published unless its signature equals the
last published one or less than the interval passed since; a suppressed quote changes neither. Quotes of a micro-batch
are taken in (time, sequence) order per instrument; batches in the order they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.quotes import MIN_INTERVAL_MS, SIGNATURE
from ..session import ship


def _throttle(keys: list[str], interval_us: int):
    def fn(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_sig, last_t = state.get if state.exists else (None, None)
        rows = pd.concat(list(frames)).sort_values(["_t", "_s"])
        keep = np.zeros(len(rows), dtype=bool)
        for i, (t, sig) in enumerate(zip(rows["_t"].tolist(), rows["_sig"].tolist(), strict=True)):
            if last_t is None or (sig != last_sig and t - last_t >= interval_us):
                keep[i] = True
                last_sig, last_t = sig, t
        state.update((last_sig, last_t))
        if keep.any():
            yield rows.loc[keep, [*keys, "_t", "_s", "_sig"]]

    return fn


def throttle_stream(quotes: DataFrame, keys: list[str], t_us: str, seq: str, signature: tuple[str, ...] = SIGNATURE,
                    interval_ms: int = MIN_INTERVAL_MS) -> DataFrame:
    """The quotes of a stream that are published: keys, ``t_us``, ``seq`` and the signature columns."""
    ship(quotes.sparkSession)
    sig = T.StructType([quotes.schema[c] for c in signature])
    rows = quotes.select(*keys, F.col(t_us).cast("long").alias("_t"), F.col(seq).cast("long").alias("_s"),
                         F.to_json(F.struct(*signature), {"ignoreNullFields": "false"}).alias("_sig"))
    out = T.StructType([quotes.schema[k] for k in keys]).add("_t", "long").add("_s", "long").add("_sig", "string")
    kept = rows.groupBy(*keys).applyInPandasWithState(
        _throttle(keys, int(interval_ms) * 1000), out, "sig string, t long", "append", GroupStateTimeout.NoTimeout)
    return kept.select(*keys, F.col("_t").alias(t_us), F.col("_s").alias(seq), F.from_json("_sig", sig).alias("_sig")).select(
        *keys, t_us, seq, "_sig.*")
