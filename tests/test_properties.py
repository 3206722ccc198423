"""Random tick streams: the chunked Spark candles equal a direct model of the reference's candle loop."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickengine.operators import candles as C
from tickengine.schema import TickSpec

SPEC = TickSpec(order=("seq",), seq="seq", seq_prefix=(), price="price", size="size", cum="cum", time_us="t_us",
                currency=None, chunk_size=3, order_key="seq")

tick = st.tuples(
    st.sampled_from(["A", "B"]),                 # instrument
    st.integers(0, 4),                           # minute
    st.integers(0, 59),                          # second
    st.integers(-2, 9),                          # price (zero and negative prices are accepted)
    st.integers(0, 5),                           # size
    st.one_of(st.none(), st.integers(0, 60)),    # cumulative volume
)


def model(ticks):
    """The reference loop: one open candle per instrument, in arrival order."""
    state, out = {}, []
    for sym, minute, _, price, size, cum in ticks:
        c = state.get(sym)
        if c is not None and minute < c["m"]:
            continue
        if c is not None and minute == c["m"]:
            if cum is not None and c["cum"] is not None:
                inc = max(cum - c["cum"], 0)
            elif size > 0:
                inc = size
            else:
                inc = 0
            c.update(h=max(c["h"], price), l=min(c["l"], price), c=price, v=c["v"] + inc, n=c["n"] + 1,
                     cum=cum if cum is not None else c["cum"])
            continue
        if c is not None:
            out.append((sym, c["m"], c["o"], c["h"], c["l"], c["c"], c["v"], c["n"]))
        state[sym] = dict(m=minute, o=price, h=price, l=price, c=price, v=0, n=1, cum=cum)
    out += [(s, c["m"], c["o"], c["h"], c["l"], c["c"], c["v"], c["n"]) for s, c in state.items()]
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tick, min_size=1, max_size=40))
def test_candles_match_reference_loop(spark, ticks):
    rows = [(sym, i, (m * 60 + s) * 1_000_000, p, z, c) for i, (sym, m, s, p, z, c) in enumerate(ticks)]
    df = spark.createDataFrame(rows, "symbol string, seq long, t_us long, price long, size long, cum long")
    df = df.withColumn("exchange", df.symbol.substr(0, 0))
    got = C.candles(df, SPEC, "1m").collect()
    got = sorted((r.symbol, r.open_us // 60_000_000, r.open, r.high, r.low, r.close, r.volume, r.tick_count)
                 for r in got)
    assert got == model(ticks)
