"""The physical plans keep the properties the scale design relies on."""

import re

import pytest

from tickengine.operators import candles as C
from tickengine.operators import feed as FD
from tickengine.operators.parse import parse_candles, parse_ticks
from tickengine.schema import PROXY_TICKS
from tickengine.sources.envelope import tick_envelopes
from tickengine.sources.proxy import tick_proxy

from conftest import SF_SMALL


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # filters are printed whole, however long their ids
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def final(p: str) -> str:
    return p[: p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p


@pytest.mark.parametrize("build", [C.candles, C.candle_revisions])
def test_ticks_are_parsed_and_shuffled_once(spark, build):
    from tickengine.operators.parse import good_ticks
    from tickengine.schema import ENVELOPE_TICKS

    for ticks, spec in ((tick_proxy(spark, SF_SMALL), PROXY_TICKS),
                        (good_ticks(parse_ticks(tick_envelopes(tick_proxy(spark, SF_SMALL)))), ENVELOPE_TICKS)):
        df = build(ticks, spec, "1m")
        df.collect()
        p = final(df._jdf.queryExecution().executedPlan().toString())
        assert p.count("REPARTITION_BY_COL") - len(re.findall(r"ReusedExchange[^\n]*REPARTITION_BY_COL", p)) == 1
        assert p.count("FileScan") == 1 and len(re.findall(r"parseJson|try_parse_json", p)) <= 1
        assert "InsertInto" not in p and "InMemoryRelation" not in p
        # whatever else is shuffled is a row per cell, or per cell and candle
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_route_is_an_equi_join(spark):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    subs = spark.createDataFrame([("a", None, None), ("b", "click", "1m")], "client_id string, symbol string, timeframe string")
    p = plan(FD.route(env, subs))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_json_parsed_once(spark):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    p = plan(parse_ticks(env).where("bad_reason is null and price > 1"))
    assert len(re.findall(r"parseJson|try_parse_json", p)) == 1


@pytest.mark.parametrize("parse", [parse_ticks, parse_candles])
def test_fields_are_taken_out_of_a_message_at_once(spark, parse):
    """One get a message for all fields, and no cast of a variant for the text of a string."""
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    p = parse(env)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"variant_get\(_v#", p)) == 1 and len(re.findall(r"parseJson|try_parse_json", p)) == 1
    assert len(re.findall(r"variant_get\(_f#\d+\.(symbol|exchange|currency|openTime|sourceTimestamp|publishedAt)", p)) == 0
    assert "schema_of_variant(_v#" not in p and not re.search(r"variant_get\(_f_(symbol|exchange|currency)#", p)


def test_subscriptions_are_not_copied_per_shuffle_partition(spark):
    env = tick_envelopes(tick_proxy(spark, SF_SMALL))
    subs = spark.createDataFrame([("a", None, None), ("b", "click", "1m")], "client_id string, symbol string, timeframe string")
    assert "_salt" not in FD.route(env, subs)._jdf.queryExecution().optimizedPlan().toString()


def test_history_reads_one_trading_date(spark, tmp_path):
    """the date is a partition filter of both scans of the live table, and of the store's."""
    from tickengine.operators import store as S
    from tickengine.plans import queries as Q
    from tickengine.streaming.sinks import LiveTable

    table, parsed = LiveTable(spark, f"{tmp_path}/live"), Q._parsed_candles(spark, SF_SMALL)
    table.append(parsed, "q", 0)
    before = sorted(map(str, table.read().collect()))
    covered = table.compact("2024-01-15")
    table.append(parsed, "q", 1)
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(S.history(table.read(), "click", "1m", "2024-01-15")))
    assert len(scans) == 2 and all("trading_date" in x and "2024-01-15" in x for x in scans)
    assert sorted(map(str, table.read().collect())) == before
    assert len(covered) == 1 and table.retire(covered) == 1 and table.retire(covered) == 0
    assert sorted(map(str, table.read().collect())) == before

    path = f"{tmp_path}/store"
    S.write_store(S.store_rows(S.final_only(parsed)), path)
    n = S.compact_store(spark, path, "2024-01-15")
    S.write_store(S.store_rows(S.final_only(parsed)), path)  # a day's rows again, after its compaction
    assert S.read_store(spark, path).count() == 2 * n
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(S.store_history(S.read_store(spark, path), "click", "1m", "2024-01-15")))
    assert len(scans) >= 2 and all("date" in x and "2024-01-15" in x for x in scans)
