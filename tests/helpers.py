"""Small builders for hand-written traces."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tickengine.schema import ENVELOPE

BASE = datetime(2024, 1, 15, 9, 0, tzinfo=timezone.utc)


def us(minute: int, second: float = 0.0) -> int:
    return int((BASE.timestamp() + minute * 60 + second) * 1_000_000)


def envelopes(spark, values, key="ibkr:ASML", start_offset=0):
    """Envelope rows for JSON strings in arrival order (partition 0)."""
    rows = [(key, v, "market.trades.raw", 0, start_offset + i, BASE) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def tick(minute, second=0.0, **fields):
    import json

    msg = {"exchange": "ibkr", "symbol": "ASML", "currency": "EUR", "sourceTimestamp":
           datetime.fromtimestamp(us(minute, second) / 1e6, tz=timezone.utc).isoformat().replace("+00:00", "Z")}
    msg.update(fields)
    return json.dumps(msg)


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]


def col_dec(c):
    return F.col(c).cast("double")
