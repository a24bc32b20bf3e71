"""Events that land with their JSON parsed: equal facts, malformed text kept and counted."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starweave.plans.build import Models
from starweave.plans.run import build_full_to_warehouse, build_incremental
from starweave.plans.warehouse import Warehouse
from starweave.sources import testdata_sources
from starweave.sources.arrivals import late_arrivals, mixed_properties
from starweave.sources.properties import PARSED_EVENTS, parsed_events, properties_report
from starweave.sources.raw import RawSources, land
from tests.conftest import RUN_TS, SF_SMALL, raw_frames, ts

# text -> (sr_id, is JSON); null is neither JSON nor malformed
CASES = [('{"sr_id": "a"}', "a", True), ('{"sr_id": "a"', None, False), ('{"sr_id": 7}', "7", True),
         ('{"sr_id": null}', None, True), ("{}", None, True), ("", None, False), (" ", None, False), ("null", None, True),
         (None, None, False), ("[1]", None, True), ('"text"', None, True), ('{"sr_id": {"b": 1}}', '{"b":1}', True),
         ('{"sr_id": "a", "sr_id": "b"}', None, False), ("not json", None, False), ('{"other": 1, "sr_id": "q"}', "q", True),
         ('{"sr_id": ""}', "", True), ("{'sr_id': 'single'}", None, False), ('{"a": {"sr_id": "deep"}}', None, True),
         ('{"sr_id": "' + "long" * 100_000 + '"}', "long" * 100_000, True), ('{"sr_id": "é\\u00e9"}', "éé", True)]


def events_of(spark, texts):
    rows = [(f"e{i}", "s", "booking_submitted", ts(f"2024-01-01 10:{i:02d}:00"), t) for i, t in enumerate(texts)]
    return raw_frames(spark, raw_events=rows)


def test_every_text_has_its_landed_form(spark):
    raw = events_of(spark, [c[0] for c in CASES]).raw_events
    got = {r.event_id: r for r in parsed_events(raw.withColumn("further", F.lit(1))).select(
        "event_id", "properties_sr_id", "properties_malformed", F.col("properties").isNotNull().alias("is_json")).collect()}
    for i, (text, sr_id, is_json) in enumerate(CASES):
        row = got[f"e{i}"]
        assert (row.properties_sr_id, row.is_json) == (sr_id, is_json), text
        assert row.properties_malformed == (None if is_json else text)
    report, = properties_report(parsed_events(raw)).collect()
    bad = sum(not c[2] and c[0] is not None for c in CASES)
    assert (report.n_events, report.n_absent, report.n_malformed) == (len(CASES), 1, bad)
    assert report.n_sr_id == sum(c[1] is not None for c in CASES)
    assert report.malformed_share == round(bad / (len(CASES) - 1), 9)


def test_empty_events_land_empty(spark, tmp_path):
    raw = raw_frames(spark)
    land(raw, str(tmp_path), 1, parse_properties=True)
    landed = RawSources.from_landing(spark, str(tmp_path)).raw_events
    assert landed.schema == PARSED_EVENTS and landed.count() == 0 and properties_report(landed).count() == 0


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The same events landed as text and parsed."""
    texts = [c[0] for c in CASES if c[2] or c[0] in (None, "", "not json", '{"sr_id": "a"')]
    raw, out = events_of(spark, texts), {}
    for parsed in (False, True):
        path = str(tmp_path_factory.mktemp(f"landed{parsed}"))
        land(raw, path, 1, parse_properties=parsed)
        out[parsed] = RawSources.from_landing(spark, path)
    return out


@pytest.mark.parametrize("fact", ["fct_booking_events", "fct_session_events", "session_funnel"])
def test_facts_are_equal_on_both_forms(spark, landed, fact):
    rows = {p: sorted(map(str, Models(spark, raw, run_ts=RUN_TS)[fact].collect())) for p, raw in landed.items()}
    assert rows[True] == rows[False] and (rows[True] or fact == "session_funnel")


def test_facts_parse_nothing_and_read_one_string(spark, landed):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        plan, text = (Models(spark, landed[p], run_ts=RUN_TS)["fct_booking_events"]._jdf.queryExecution().executedPlan().toString()
                      for p in (True, False))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "get_json_object" in text and "get_json_object" not in plan and "variant_get" not in plan
    assert "ReadSchema: struct<event_id:string,session_id:string,event_type:string,event_ts:timestamp_ntz,properties_sr_id:string>" in plan
    assert "IsNotNull(properties_sr_id)" in plan


def test_other_paths_stay_open(spark, landed):
    got = landed[True].raw_events.select(F.try_variant_get("properties", "$.other", "long").alias("v")).filter("v is not null")
    assert [r.v for r in got.collect()] == [1]
    whole = landed[True].raw_events.filter("event_id = 'e0'").select(F.to_json("properties").alias("t")).first().t
    assert json.loads(whole) == {"sr_id": "a"}


def test_nights_over_parsed_events_end_as_the_full_build(spark, tmp_path):
    """Mixed and malformed properties, a fifth of the events late."""
    raw, night = mixed_properties(testdata_sources(spark, SF_SMALL)), dt.date(2024, 1, 16)
    land(raw, str(tmp_path / "landed"), 4, parse_properties=True)
    parsed = RawSources.from_landing(spark, str(tmp_path / "landed"))
    wh, facts = Warehouse(spark, str(tmp_path / "w")), ["fct_booking_events", "fct_session_events"]
    build_full_to_warehouse(spark, late_arrivals(parsed, night), wh, RUN_TS, ["dim_session", *facts])
    before = wh.read(facts[1]).count()
    build_incremental(spark, late_arrivals(parsed, None), wh, night, RUN_TS, ["dim_session", *facts])
    for fact in facts:
        full = Models(spark, late_arrivals(raw, None), RUN_TS)[fact].drop("dw_updated_at")
        got = wh.read(fact).select(*full.columns)
        assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert wh.read(facts[1]).count() > before > 0
