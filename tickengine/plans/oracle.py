"""Independent DuckDB SQL for every registered query (the correctness gate).

The SQL is written directly against the test tables; it shares no code with the Spark side except the proxy
definition text of FIXTURES.md. Late drop, volume and revisions use plain whole-instrument windows, so they also
check the chunked two-level form of the Spark operators.
"""

from __future__ import annotations

from ..schema import TIMEFRAME_SECONDS

# FIXTURES §2 tick proxy (DuckDB dialect)
TICKS = """
ticks as (
  select e.*,
    case when event_id % 6 = 0 then null else price_c end as last_c,
    case when event_id % 4 = 2 then -1 else price_c - 1 end as bid_c,
    price_c + 3 as ask_c,
    case when event_id % 24 = 6 then null else price_c + 10 end as close_c
  from (
    select event_type as symbol,
      concat('x', cast(user_id % 2 as varchar)) as exchange,
      event_id,
      event_id + case when event_id % 7 = 3 then 12 else 0 end
               + case when event_id % 11 = 5 then 150 else 0 end as arrival,
      1705298400000000 + (epoch_us(ts) - 1704067200000000) // 60 as ts_us,
      cast(round(value * 100) as bigint) as price_c,
      case when event_id % 5 = 0 then null else (event_id * 10) % 100000 end as cum,
      event_id % 4 as size
    from events) e
)"""


def _accepted(bucket_us: int) -> str:
    """CTEs late -> acc (accepted ticks with inc) for one bucket length."""
    return f"""
bucketed as (
  select *, ts_us - (ts_us % {bucket_us}) as bucket from ticks
),
marked as (
  select *, coalesce(bucket < max(bucket) over (partition by exchange, symbol order by arrival, event_id
                     rows between unbounded preceding and 1 preceding), false) as is_late
  from bucketed
),
acc0 as (
  select *,
    row_number() over (partition by exchange, symbol, bucket order by arrival, event_id) as rn,
    last_value(cum ignore nulls) over (partition by exchange, symbol, bucket order by arrival, event_id
                     rows between unbounded preceding and 1 preceding) as prev_cum
  from marked where not is_late
),
acc as (
  select *, case when rn = 1 then 0
                 when cum is not null and prev_cum is not null then greatest(cum - prev_cum, 0)
                 when size > 0 then size else 0 end as inc
  from acc0
)"""


def _candles_sql(bucket_us: int, timeframe: str) -> str:
    return f"""
with {TICKS},{_accepted(bucket_us)}
select exchange, symbol, '{timeframe}' as timeframe, bucket as open_us, bucket + {bucket_us - 1000} as close_us,
  first(price_c order by arrival, event_id) as open, max(price_c) as high, min(price_c) as low,
  last(price_c order by arrival, event_id) as close, sum(inc) as volume, count(*) as tick_count
from acc group by exchange, symbol, bucket
"""


CANDLES_1M = _candles_sql(60_000_000, "1m")

LATE_TICKS = f"""
with {TICKS},
bucketed as (select *, ts_us - (ts_us % 60000000) as bucket from ticks),
marked as (
  select *, bucket < max(bucket) over (partition by exchange, symbol order by arrival, event_id
                     rows between unbounded preceding and 1 preceding) as is_late
  from bucketed
)
select exchange, symbol, event_id, arrival, ts_us, bucket, price_c
from marked where is_late
"""

# the parsed view of the proxy messages: offset, price chain (last -> positive midpoint -> close)
PARSED = """
parsed as (
  select *, arrival * 4 + case arrival - event_id when 162 then 0 when 150 then 1 when 12 then 2 else 3 end as "offset",
    coalesce(last_c, case when bid_c > 0 and ask_c > 0 then (bid_c + ask_c) // 2 end, close_c) as price_p,
    case when last_c is not null then 'last' when bid_c > 0 and ask_c > 0 then 'midpoint'
         when close_c is not null then 'close' end as price_source
  from ticks
)"""

PARSE_TICKS = f"""
with {TICKS},{PARSED}
select 0 as "partition", "offset", exchange, symbol, 'EUR' as currency, price_p as price_c, size, cum,
  ts_us as event_us, price_source
from parsed where price_p is not null
"""

BAD_RECORDS = f"""
with {TICKS},{PARSED}
select 'market.trades.raw' as topic, 0 as "partition", "offset", concat(exchange, ':', symbol) as "key",
  'no_price' as reason
from parsed where price_p is null
"""

PRICE_SOURCE = f"""
with {TICKS},{PARSED}
select exchange, symbol, coalesce(price_source, 'none') as price_source, count(*) as n
from parsed group by all
"""

def _candles_parsed_sql(bucket_us: int, timeframe: str) -> str:
    return f"""
with {TICKS},{PARSED},
good as (select * exclude (price_c), price_p as price_c from parsed where price_p is not null),
bucketed as (select *, ts_us - (ts_us % {bucket_us}) as bucket from good),
marked as (
  select *, coalesce(bucket < max(bucket) over (partition by exchange, symbol order by "offset"
                     rows between unbounded preceding and 1 preceding), false) as is_late
  from bucketed
),
acc0 as (
  select *,
    row_number() over (partition by exchange, symbol, bucket order by "offset") as rn,
    last_value(cum ignore nulls) over (partition by exchange, symbol, bucket order by "offset"
                     rows between unbounded preceding and 1 preceding) as prev_cum
  from marked where not is_late
),
acc as (
  select *, case when rn = 1 then 0
                 when cum is not null and prev_cum is not null then greatest(cum - prev_cum, 0)
                 when size > 0 then size else 0 end as inc
  from acc0
)
select exchange, symbol, 'EUR' as currency, '{timeframe}' as timeframe, bucket as open_us, bucket + {bucket_us - 1000} as close_us,
  first(price_c order by "offset") as open, max(price_c) as high, min(price_c) as low,
  last(price_c order by "offset") as close, sum(inc) as volume, count(*) as tick_count
from acc group by exchange, symbol, bucket
"""


CANDLES_1M_PARSED = _candles_parsed_sql(60_000_000, "1m")
CANDLES_TIMEFRAMES_STREAM = " union all ".join(
    f"select * from ({_candles_parsed_sql(seconds * 1_000_000, name)})" for name, seconds in TIMEFRAME_SECONDS.items())

LATE_TICKS_STREAM = CANDLES_1M_PARSED[: CANDLES_1M_PARSED.index("acc0 as (")].rstrip().rstrip(",") + """
select exchange, symbol, ts_us as event_us, bucket, price_c from marked where is_late
"""

SESSION_LABEL = f"""
with {TICKS},
lt as (
  select *, epoch_us(timezone('Europe/Amsterdam', timezone('UTC', make_timestamp(ts_us)))) as local_us from ticks
),
tod as (select *, ((local_us % 86400000000) + 86400000000) % 86400000000 as tod_us from lt)
select exchange, symbol, event_id, ts_us,
  case when tod_us < 32400000000 then 'premarket' when tod_us <= 63000000000 then 'regular' else 'afterhours' end
    as session,
  tod_us < 32400000000 as is_premarket
from tod
"""

QUOTE_CHANGES = f"""
with {TICKS},
s as (
  select *, lag(bid_c) over w as pb, lag(size) over w as ps, row_number() over w as rn
  from ticks window w as (partition by exchange, symbol order by ts_us, event_id)
)
select exchange, symbol, event_id, ts_us, bid_c, size from s
where rn = 1 or bid_c is distinct from pb or size is distinct from ps
"""

# F6 + F7 as the producer's fold, one step per quote (recursive CTE)
QUOTE_THROTTLE = f"""
with recursive {TICKS},
q as (select *, row_number() over (partition by exchange, symbol order by ts_us, event_id) as rn from ticks),
walk as (
  select exchange, symbol, rn, event_id, true as pub, bid_c as lb, size as ls, ts_us as lt from q where rn = 1
  union all
  select q.exchange, q.symbol, q.rn, q.event_id, x.pub,
    case when x.pub then q.bid_c else w.lb end, case when x.pub then q.size else w.ls end,
    case when x.pub then q.ts_us else w.lt end
  from walk w join q on q.exchange = w.exchange and q.symbol = w.symbol and q.rn = w.rn + 1,
  lateral (select ((q.bid_c is distinct from w.lb or q.size is distinct from w.ls)
                   and q.ts_us - w.lt >= 15000000) as pub) x
)
select t.exchange, t.symbol, t.event_id, t.ts_us, t.bid_c, t.size
from walk join ticks t using (exchange, symbol, event_id) where walk.pub
"""

CANDLE_REVISIONS = f"""
with {TICKS},{_accepted(60_000_000)},
upd as (
  select exchange, symbol, '1m' as timeframe, bucket as open_us, rn as rev, 'candle.updated' as event,
    first_value(price_c) over w as open, max(price_c) over w as high, min(price_c) over w as low,
    price_c as close, sum(inc) over w as volume, count(*) over w as tick_count, false as is_final
  from acc
  window w as (partition by exchange, symbol, bucket order by arrival, event_id
               rows between unbounded preceding and current row)
),
fin as (
  select exchange, symbol, '1m' as timeframe, bucket as open_us, count(*) + 1 as rev, 'candle.closed' as event,
    first(price_c order by arrival, event_id) as open, max(price_c) as high, min(price_c) as low,
    last(price_c order by arrival, event_id) as close, sum(inc) as volume, count(*) as tick_count, true as is_final
  from acc group by exchange, symbol, bucket
)
select * from upd union all select * from fin
"""


def _rollup_sql(inner: str, bucket_us: int, timeframe: str) -> str:
    return f"""
select exchange, symbol, '{timeframe}' as timeframe, b as open_us, b + {bucket_us - 1000} as close_us,
  first(open order by open_us) as open, max(high) as high, min(low) as low, last(close order by open_us) as close,
  sum(volume) as volume, sum(tick_count) as tick_count
from (select *, open_us - (open_us % {bucket_us}) as b from ({inner}) c) r
group by exchange, symbol, b
"""


ROLLUP_5M = _rollup_sql(CANDLES_1M, 300_000_000, "5m")
ROLLUP_1H = _rollup_sql(CANDLES_1M, 3_600_000_000, "1h")

def _iso(us: str) -> str:
    """Instant text with 0, 3 or 6 fraction digits."""
    base = f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S')"
    frac = f"(({us}) % 1000000)"
    return (f"(case when {frac} = 0 then {base} || 'Z' "
            f"when {frac} % 1000 = 0 then {base} || '.' || lpad(cast({frac} // 1000 as varchar), 3, '0') || 'Z' "
            f"else {base} || '.' || lpad(cast({frac} as varchar), 6, '0') || 'Z' end)")


# all revisions with their publication time and replay offset
REVS = f"""
{_accepted(60_000_000)},
revs as (
  select exchange, symbol, bucket as open_us, rn as rev, 'candle.updated' as event,
    first_value(price_c) over w as open, max(price_c) over w as high, min(price_c) over w as low,
    price_c as close, sum(inc) over w as volume, count(*) over w as tick_count, false as is_final,
    ts_us as published_us
  from acc
  window w as (partition by exchange, symbol, bucket order by arrival, event_id
               rows between unbounded preceding and current row)
  union all
  select exchange, symbol, bucket, count(*) + 1, 'candle.closed',
    first(price_c order by arrival, event_id), max(price_c), min(price_c),
    last(price_c order by arrival, event_id), sum(inc), count(*), true,
    last(ts_us order by arrival, event_id)
  from acc group by exchange, symbol, bucket
)"""

STORE_ROWS = f"""
with {TICKS},{REVS}
select event, exchange, symbol, cast(null as varchar) as currency, '1m' as timeframe,
  {_iso("open_us")} as "openTime", {_iso("open_us + 59999000")} as "closeTime",
  strftime(make_timestamp(open_us), '%Y-%m-%d') as "tradingDate",
  cast(open as varchar) as open, cast(high as varchar) as high, cast(low as varchar) as low,
  cast(close as varchar) as close, cast(volume as varchar) as volume, tick_count as "tickCount",
  is_final as "isFinal", {_iso("published_us")} as "publishedAt",
  exchange || ':' || symbol || ':1m' as "kafkaKey", 'market.candles.1m' as "kafkaTopic", 0 as "kafkaPartition",
  (open_us // 1000) * 1000000 + rev as "kafkaOffset",
  exchange as _p_exchange, symbol as _p_symbol, '1m' as _p_timeframe,
  strftime(make_timestamp(open_us), '%Y-%m-%d') as date
from revs where is_final
"""

STORE_ROUNDTRIP = f"""
with {TICKS},{REVS},
named as (select * exclude (symbol), exchange || case when open_us % 120000000 = 0 then '/' else '_' end || symbol as symbol
  from revs where is_final)
select event, exchange, symbol, cast(null as varchar) as currency, '1m' as timeframe,
  {_iso("open_us")} as "openTime", {_iso("open_us + 59999000")} as "closeTime",
  strftime(make_timestamp(open_us), '%Y-%m-%d') as "tradingDate",
  cast(open as varchar) as open, cast(high as varchar) as high, cast(low as varchar) as low,
  cast(close as varchar) as close, cast(volume as varchar) as volume, tick_count as "tickCount",
  is_final as "isFinal", {_iso("published_us")} as "publishedAt",
  exchange || ':' || symbol || ':1m' as "kafkaKey", 'market.candles.1m' as "kafkaTopic", 0 as "kafkaPartition",
  (open_us // 1000) * 1000000 + rev as "kafkaOffset",
  exchange as path_exchange, replace(symbol, '/', '_') as path_symbol, '1m' as path_timeframe,
  strftime(make_timestamp(open_us), '%Y-%m-%d') as date
from named
"""

LIVE = f"""
live as (
  select strftime(make_timestamp(open_us), '%Y-%m-%d') as trading_date, event, exchange, symbol,
    cast(null as varchar) as currency, '1m' as timeframe,
    {_iso("open_us")} as open_time, {_iso("open_us + 59999000")} as close_time,
    cast(open as varchar) as open, cast(high as varchar) as high, cast(low as varchar) as low,
    cast(close as varchar) as close, cast(volume as varchar) as volume, tick_count,
    cast(is_final as int) as is_final, {_iso("published_us")} as published_at
  from (select *, row_number() over (partition by exchange, symbol, open_us order by rev desc) as k from revs) r
  where k = 1
)"""

LATEST_STATE = f"""
with {TICKS},{REVS},{LIVE}
select * from live
"""

HISTORY = f"""
with {TICKS},{REVS},{LIVE}
select event, exchange, symbol, nullif(currency, '') as currency, timeframe, open_time as "openTime",
  close_time as "closeTime", open, high, low, close, volume, tick_count as "tickCount", is_final = 1 as "isFinal",
  published_at as "publishedAt"
from live where trading_date = '2024-01-15' and symbol = 'click' and timeframe = '1m'
order by open_time
"""

SUBS = """
subs as (
  select cast(n_nationkey as varchar) as client_id,
    nullif(upper(trim(case n_nationkey % 8 when 0 then null when 1 then ' click ' when 2 then 'VIEW' when 3 then ''
      when 4 then 'purchase' when 5 then 'Signup' when 6 then 'error' else 'nope' end)), '') as sub_symbol,
    nullif(trim(case (n_nationkey // 8) % 4 when 0 then null when 1 then '1m' when 2 then ' 1m ' else '5m' end), '')
      as sub_timeframe
  from nation
)"""

ROUTED = f"""
{REVS},{SUBS},
msgs as (select exchange || ':' || symbol || ':1m' as "key", 0 as "partition",
           (open_us // 1000) * 1000000 + rev as "offset", upper(symbol) as rsym, '1m' as rtf, * from revs),
routed as (
  select s.client_id, m.* from msgs m join subs s
    on (s.sub_symbol is null or s.sub_symbol = m.rsym) and (s.sub_timeframe is null or s.sub_timeframe = m.rtf)
)"""

ROUTE = f"""
with {TICKS},{ROUTED}
select client_id, "partition", "offset", "key" from routed
"""

FEED_METRICS = f"""
with {TICKS},{ROUTED},
ranked as (select *, count(*) over (partition by client_id) as message_count,
             row_number() over (partition by client_id order by "offset" desc, "key" desc) as k from routed)
select client_id, message_count, cast(close as varchar) as last_close, {_iso("open_us")} as last_open_time,
  {_iso("published_us")} as last_update
from ranked where k = 1
"""

FEED_METRICS_HISTORY = f"""
with {TICKS},{ROUTED},
both_sources as (
  select 0 as src, * from routed where is_final and open_us < 1705320000000000
  union all
  select 1, * from routed where open_us >= 1705320000000000 and symbol <> 'error'),
ranked as (select *, count(*) over (partition by client_id) as message_count,
             row_number() over (partition by client_id order by src desc, "offset" desc, "key" desc) as k from both_sources)
select client_id, message_count, cast(close as varchar) as last_close, {_iso("open_us")} as last_open_time,
  {_iso("published_us")} as last_update
from ranked where k = 1
"""

CHART_SERIES = f"""
with {TICKS},{REVS},
pts as (
  select 0 as src, (open_us // 1000) * 1000000 + rev as "offset", exchange || ':' || symbol || ':1m' as "key", *
  from revs where is_final and open_us < 1705320000000000
  union all
  select 1, (open_us // 1000) * 1000000 + rev, exchange || ':' || symbol || ':1m', *
  from revs where open_us >= 1705320000000000 - 60000000
),
ranked as (select *, row_number() over (partition by exchange, symbol, open_us order by src desc, "offset" desc) as k
           from pts)
select exchange, symbol, '1m' as timeframe, open_us // 1000000 as time, cast(open as double) as open, cast(high as double) as high,
  cast(low as double) as low, cast(close as double) as close, cast(volume as double) as volume,
  case when close >= open then '#26a69a' else '#ef5350' end as color
from ranked where k = 1
"""

OPTIONS = """
opts as (
  select p_partkey as arrival, p_brand as underlying,
    cast('2026-06-19' as date) + cast((p_partkey % 8) * 7 as int) as expiry,
    cast(100 + 5 * (p_partkey % 40) as int) as strike,
    case when p_partkey % 2 = 0 then 'C' else 'P' end as "right",
    cast('2026-05-25' as date) + cast(p_size % 3 as int) as snapshot_date,
    (p_partkey * 37) % 1000 as open_interest,
    cast(195 as int) as underlying_price
  from part
),
latest as (
  select * from (select *, row_number() over (partition by underlying, expiry, strike, "right", snapshot_date
                                                order by arrival desc) as k from opts) where k = 1
)"""

OI_SELECTION = f"""
with {OPTIONS},
live as (select * from latest where expiry >= snapshot_date),
exp as (select underlying, snapshot_date, expiry,
          dense_rank() over (partition by underlying, snapshot_date order by expiry) as er
        from (select distinct underlying, snapshot_date, expiry from live)),
s1 as (select l.* from live l join exp e using (underlying, snapshot_date, expiry) where e.er <= 2),
stk as (select underlying, snapshot_date, expiry, strike,
          row_number() over (partition by underlying, snapshot_date, expiry
                             order by abs(strike - px), strike) as sr
        from (select underlying, snapshot_date, expiry, strike, max(underlying_price) as px from s1 group by all))
select s1.underlying, s1.snapshot_date, s1.expiry, s1.strike, s1."right", s1.open_interest, s1.arrival
from s1 join stk using (underlying, snapshot_date, expiry, strike) where stk.sr <= 10
"""

OI_PUT_CALL = f"""
with {OPTIONS}
select underlying, snapshot_date,
  sum(case when "right" = 'C' then open_interest else 0 end) as call_oi,
  sum(case when "right" = 'P' then open_interest else 0 end) as put_oi,
  case when sum(case when "right" = 'C' then open_interest else 0 end) > 0 then
    (sum(case when "right" = 'P' then open_interest else 0 end) * 1000000)
      // sum(case when "right" = 'C' then open_interest else 0 end) end as put_call_ppm
from latest group by underlying, snapshot_date
"""

HALF_STRIKES = OPTIONS.replace("cast(100 + 5 * (p_partkey % 40) as int)", "cast(100 + 2.5 * (p_partkey % 40) as decimal(10,1))")
OI_HALF_STRIKES = (
    OI_SELECTION.replace(OPTIONS, HALF_STRIKES)
    .replace("select s1.underlying, s1.snapshot_date, s1.expiry, s1.strike,", "select s1.underlying, s1.snapshot_date, s1.expiry, cast(s1.strike * 10 as bigint) as strike_tenths,")
)

OI_BAD_RECORDS = f"""
with {HALF_STRIKES}
select 'market.options.oi.snapshot' as topic, 0 as "partition", arrival as "offset",
  case when arrival % 7 = 3 then 'x' else underlying || ':' || strftime(expiry, '%Y-%m-%d') || ':' || cast(strike as varchar) || ':' || "right" end as "key",
  case arrival % 7 when 0 then 'not_json' when 1 then 'not_object' when 2 then 'no_open_interest' else 'no_contract' end as reason
from opts where arrival % 7 < 4
"""

CHART_LABELS = f"""
with {TICKS},
c as ({_candles_sql(60_000_000, "1m").replace("with " + TICKS + ",", "with ", 1)})
select exchange, symbol, open_us, format('{{:,.2f}}', close / 100.0) as price, strftime(make_timestamp(open_us), '%H:%M') as axis,
  case when tick_count > 1 then strftime(make_timestamp(open_us), '%H:%M:%S') else 'No updates' end as updated,
  case when tick_count > 1 then strftime(make_timestamp(open_us), '%A, %B %-d, %Y') else 'No date' end as day
from c
"""

HISTORY_RANK = f"""
with {TICKS},{REVS},{LIVE}
select exchange, open_time as "openTime", true as in_order
from live where trading_date = '2024-01-15' and symbol = 'click' and timeframe = '1m'
"""

HISTORY_DATES = """
select c_custkey, strftime(case when c_custkey % 5 = 0 then date '2024-01-01' + cast(c_custkey % 400 as int)
  else cast(timezone('UTC', now()) as date) end, '%Y-%m-%d') as day
from customer
"""

LEARNING_EVENTS = f"""
select 'user-' || cast((event_id + 1) % 3 as varchar) as "key",
  '{{"event":"page_view","count":' || cast(event_id + 1 as varchar) || ',"at":"' || {_iso("epoch_us(ts)")} || '"}}'
    as value,
  0 as "partition", event_id as "offset"
from events
"""

SNAPSHOT_EVENTS = f"""
with {TICKS},
raw as (
  select *, case when event_id % 13 = 0 then null else ts_us end as time_us, ts_us + 5000 as published_us,
    case when exchange = 'x0' then 'AEB' end as primary_exchange
  from ticks
),
lt as (
  select *, epoch_us(timezone('Europe/Amsterdam', timezone('UTC', make_timestamp(coalesce(time_us, published_us)))))
    % 86400000000 as tod_us
  from raw
)
select 'ibkr:' || symbol as "key", 'ibkr:' || symbol || ':EUR:' || coalesce(primary_exchange, 'SMART') as source,
  symbol, bid_c / 100.0 as bid, 100 as "bidSize", ask_c / 100.0 as ask, 200 as "askSize", last_c / 100.0 as last,
  size as "lastSize", close_c / 100.0 as close, cum as volume,
  {_iso("time_us")} as "sourceTimestamp", {_iso("published_us")} as "publishedAt",
  case when tod_us < 32400000000 then 'premarket' when tod_us <= 63000000000 then 'regular' else 'afterhours' end
    as session,
  tod_us < 32400000000 as "isPremarket", 1000 + event_id % 5 as "conId", primary_exchange as "primaryExchange"
from lt
"""

# revisions of the parsed messages; the last candle of each instrument has no close yet in a stream
CANDLE_REVISIONS_STREAM = f"""
with {TICKS},{PARSED},
good as (select * exclude (price_c), price_p as price_c from parsed where price_p is not null),
bucketed as (select *, ts_us - (ts_us % 60000000) as bucket from good),
marked as (
  select *, coalesce(bucket < max(bucket) over (partition by exchange, symbol order by "offset"
                     rows between unbounded preceding and 1 preceding), false) as is_late
  from bucketed
),
acc0 as (
  select *,
    row_number() over (partition by exchange, symbol, bucket order by "offset") as rn,
    last_value(cum ignore nulls) over (partition by exchange, symbol, bucket order by "offset"
                     rows between unbounded preceding and 1 preceding) as prev_cum
  from marked where not is_late
),
acc as (
  select *, case when rn = 1 then 0
                 when cum is not null and prev_cum is not null then greatest(cum - prev_cum, 0)
                 when size > 0 then size else 0 end as inc
  from acc0
),
upd as (
  select exchange, symbol, bucket as open_us, false as is_final, count(*) over w as tick_count,
    first_value(price_c) over w as open, max(price_c) over w as high, min(price_c) over w as low,
    price_c as close, sum(inc) over w as volume
  from acc
  window w as (partition by exchange, symbol, bucket order by "offset" rows between unbounded preceding and current row)
),
fin as (
  select exchange, symbol, bucket as open_us, true as is_final, count(*) as tick_count,
    first(price_c order by "offset") as open, max(price_c) as high, min(price_c) as low,
    last(price_c order by "offset") as close, sum(inc) as volume
  from acc group by exchange, symbol, bucket
)
select * from upd
union all
select f.* from fin f
where f.open_us < (select max(open_us) from fin g where g.exchange = f.exchange and g.symbol = f.symbol)
"""

ORACLE: dict[str, str] = {
    "candles_1m": CANDLES_1M,
    "late_ticks": LATE_TICKS,
    "parse_ticks": PARSE_TICKS,
    "bad_records": BAD_RECORDS,
    "price_source": PRICE_SOURCE,
    "candles_1m_parsed": CANDLES_1M_PARSED,
    "session_label": SESSION_LABEL,
    "quote_changes": QUOTE_CHANGES,
    "quote_throttle": QUOTE_THROTTLE,
    "quote_throttle_stream": QUOTE_THROTTLE,
    "candle_revisions": CANDLE_REVISIONS,
    "candles_1s": _candles_sql(1_000_000, "1s"),
    "candles_5m": _candles_sql(300_000_000, "5m"),
    "candles_15m": _candles_sql(900_000_000, "15m"),
    "candles_1h": _candles_sql(3_600_000_000, "1h"),
    "candles_1d": _candles_sql(86_400_000_000, "1d"),
    "rollup_5m": ROLLUP_5M,
    "rollup_1h": ROLLUP_1H,
    "store_rows": STORE_ROWS,
    "latest_state": LATEST_STATE,
    "history": HISTORY,
    "route": ROUTE,
    "chart_series": CHART_SERIES,
    "feed_metrics": FEED_METRICS,
    "feed_metrics_stream": FEED_METRICS,
    "feed_metrics_history": FEED_METRICS_HISTORY,
    # the stream must equal the batch candles of the same messages
    "candles_1m_stream": CANDLES_1M_PARSED,
    "candles_timeframes_stream": CANDLES_TIMEFRAMES_STREAM,
    "late_ticks_stream": LATE_TICKS_STREAM,
    "candles_lagging_stream": CANDLES_1M_PARSED,
    "candles_moved_partition": CANDLES_1M_PARSED,
    "candles_moved_partition_stream": CANDLES_1M_PARSED,
    "candles_1m_chunks": CANDLES_1M,
    "candle_revisions_chunks": CANDLE_REVISIONS,
    "chart_labels": CHART_LABELS,
    "history_rank": HISTORY_RANK,
    "history_dates": HISTORY_DATES,
    "oi_half_strikes": OI_HALF_STRIKES,
    "oi_bad_records": OI_BAD_RECORDS,
    "live_after_retry": LATEST_STATE,
    "live_after_restart": LATEST_STATE,
    "store_roundtrip": STORE_ROUNDTRIP,
    "store_late_arrivals": STORE_ROWS,
    "oi_moved_partition": OI_PUT_CALL,
    "oi_tables": OI_PUT_CALL,
    "oi_selection": OI_SELECTION,
    "oi_put_call": OI_PUT_CALL,
    "learning_events": LEARNING_EVENTS,
    "oi_from_messages": OI_PUT_CALL,
    "snapshot_events": SNAPSHOT_EVENTS,
    "candle_revisions_stream": CANDLE_REVISIONS_STREAM,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
