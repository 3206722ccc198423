import json

from pyspark.sql import functions as F

from helpers import envelopes, tick
from tickengine.functions.text import key_part
from tickengine.operators.parse import bad_records, good_ticks, parse_candles, parse_ticks


def test_key_split_like_java(spark):
    df = spark.createDataFrame([("",), (":",), (":A",), ("ibkr:",), ("a::b",), (None,), ("x:y:z",)], "k string")
    got = [(r.k, r.p0, r.p1) for r in df.select("k", key_part(F.col("k"), 0).alias("p0"),
                                                  key_part(F.col("k"), 1).alias("p1")).collect()]
    assert got == [("", "", None), (":", None, None), (":A", "", "A"), ("ibkr:", "ibkr", None),
                   ("a::b", "a", ""), (None, None, None), ("x:y:z", "x", "y")]


def test_exchange_symbol_fallbacks(spark):
    msgs = [json.dumps({"last": 1}), json.dumps({"last": 1}), json.dumps({"last": 1, "symbol": "S"}),
            json.dumps({"last": 1, "symbol": 123})]
    rows = []
    for key, m in zip([":", ":A", None, "ex:SYM"], msgs):
        p = parse_ticks(envelopes(spark, [m], key=key)).first()
        rows.append((p.exchange, p.symbol, p.bad_reason))
    assert rows == [("unknown", None, "no_symbol"), ("", "A", None), ("unknown", "S", None),
                    ("ex", "SYM", None)]  # a numeric symbol is not a symbol: the key's part is used


def test_price_chain_and_types(spark):
    msgs = [
        tick(0, last="12.5"),                       # numeric text
        tick(0, last="abc", bid=1, ask=3),          # bad text -> midpoint 2
        tick(0, last=True, bid=0, ask=3, close=7),  # boolean is not a price; bid 0 -> no midpoint; close
        tick(0, bid=-1, ask=3),                     # no price
        "[1, 2]",                                   # valid JSON, not an object (Q6: dead-letter, no crash)
        "{bad",
    ]
    p = parse_ticks(envelopes(spark, msgs)).orderBy("offset").collect()
    assert [(None if r.price is None else float(r.price), r.price_source, r.bad_reason) for r in p] == [
        (12.5, "last", None), (2.0, "midpoint", None), (7.0, "close", None), (None, None, "no_price"),
        (None, None, "not_object"), (None, None, "not_json")]
    assert bad_records(parse_ticks(envelopes(spark, msgs))).count() == 3


def test_event_time_fallbacks(spark):
    msgs = [
        tick(0, last=1, sourceTimestamp="2024-01-15T09:00:00"),              # zone-less: rejected
        tick(0, last=1, sourceTimestamp=None, publishedAt="2024-01-15T09:00:01.5Z"),
        tick(0, last=1, sourceTimestamp="2024-01-15T10:00:00+01:00"),
    ]
    p = good_ticks(parse_ticks(envelopes(spark, msgs))).orderBy("offset").collect()
    base = 1705309200000000  # 2024-01-15T09:00:00Z
    record_ts = base  # helpers stamp records with 09:00:00
    assert [r.event_us for r in p] == [record_ts, base + 1_500_000, base]


def test_candle_message_defaults(spark):
    full = {"exchange": "e", "symbol": "0012", "timeframe": "1m", "openTime": "2024-01-15T09:00:00Z",
            "closeTime": "2024-01-15T09:00:59.999Z", "open": 1, "high": "2", "low": "0.5", "close": "1.5"}
    msgs = [json.dumps(full), json.dumps({**full, "tickCount": "7", "isFinal": True, "currency": ""}),
            json.dumps({k: v for k, v in full.items() if k != "open"}), json.dumps({**full, "high": "x"})]
    p = parse_candles(envelopes(spark, msgs)).orderBy("offset").collect()
    assert (p[0].event, p[0].volume, p[0].tickCount, p[0].isFinal, p[0].publishedAt, p[0].open) == (
        "candle", "0", 0, False, "", "1")
    assert (p[1].tickCount, p[1].isFinal, p[1].currency, p[1].symbol) == (7, True, None, "0012")
    assert [r.bad_reason for r in p] == [None, None, "missing_field", "not_numeric"]


def test_texts_of_odd_messages(spark):
    """The text of a string field is the variant's, whatever else the message holds."""
    whole = json.dumps({"exchange": "e", "symbol": "S", "last": 1})
    texts = ['"a\\"b\\\\c\\u00e9\\n"', '"\\ud83d\\ude00"', '"\\ud800"', '"\\u0000"', '" "', '""', "1.50", "true", "null", '{"symbol": "T"}', '["S"]']
    msgs = [whole[:-1] + f', "currency": {t}}}' for t in texts] + [f'{{"currency": {t}, ' + whole[1:] for t in texts]
    msgs += [whole + " more", whole + whole, whole[:-1], whole[:-1] + ",}", " \t\r\n" + whole, "[" + whole + "]", whole.replace('"', "'"), "\ufeff" + whole,
             whole[:-1] + ', "symbol": "T"}', whole[:-1] + ', "Symbol": "T"}', whole[:-1] + ', "x": NaN}', whole[:-1] + ', "x": {"symbol": "T"}}',
             whole.replace("symbol", "sym\\u0062ol"), whole[:-1] + ', "x": ' + "[" * 1200 + "]" * 1200 + "}", "{}", "", None]
    p = parse_ticks(envelopes(spark, msgs, key="k"))
    v = F.try_parse_json("value")
    own = {f: F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")) == "STRING", F.nullif(F.try_variant_get(v, f"$.{f}", "string"), F.lit("")))
           for f in ("symbol", "currency")}
    rows = p.select("symbol", "currency", "bad_reason", own["symbol"].alias("s"), own["currency"].alias("c"), v.isNull().alias("no")).collect()
    assert len(rows) == len(msgs) and {r.bad_reason for r in rows} == {None, "not_json", "not_object", "no_symbol"}
    assert all((r.symbol, r.currency) == (r.s, r.c) and (r.bad_reason == "not_json") == r.no for r in rows)
