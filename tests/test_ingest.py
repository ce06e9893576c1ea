"""Readers on hand-written files, and merging of late and repeated rows."""

import gzip
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from towerline.operators import quality, space, statistics
from towerline.sources import files, sinks, structure
from towerline.streaming import ingest

OMES = """<?xml version="1.0" encoding="UTF-8"?>
<OMeS>
<PMSetup startTime="2026-01-05T08:00:00.000+07:00:00" interval="15">
<PMMOResult><MO><DN>PLMN-1/BTS-1/CELL-2</DN></MO><PMTarget measurementType="LTE"><M1C1>5</M1C1><M1C2 unit="x">NIL</M1C2><M1C3>&#49;0</M1C3></PMTarget></PMMOResult>
<PMMOResult><MO><DN>PLMN-1/BTS-1/CELL-3</DN></MO><PMTarget measurementType="LTE"><M1C1>7.5</M1C1></PMTarget></PMMOResult>
</PMSetup>
<PMSetup startTime="2026-01-05T02:00:00.000+00:00:00" interval="60"><PMMOResult><MO><DN>PLMN-1/BTS-1</DN></MO><PMTarget measurementType="B"><X>1</X></PMTarget></PMMOResult></PMSetup>
</OMeS>
"""
LISTED = """<?xml version="1.0"?>
<!-- two objects, one value missing -->
<measCollecFile>
 <fileHeader fileFormatVersion="2" vendorName="T" dnPrefix="SubNetwork=9"><fileSender localDn="Manager=4" elementType="x"/><measCollec beginTime="2026-03-02T22:30:00+01:00"/></fileHeader>
 <measData>
  <managedElement localDn="Node=77" swVersion="4.1"/>
  <measInfo measInfoId="Traffic"><job jobId="7"/><granPeriod duration="PT1800S" endTime="2026-03-02T23:00:00+01:00"/><repPeriod duration="PT3600S"/>
   <measTypes>attempts drops</measTypes>
   <measValue measObjLdn="Sector=1"><measResults>120 3.5</measResults></measValue>
   <measValue measObjLdn="Sector=2"><measResults>NIL 0</measResults><suspect>true</suspect></measValue>
  </measInfo>
 </measData>
 <fileFooter><measCollec endTime="2026-03-02T23:00:00+01:00"/></fileFooter>
</measCollecFile>
"""
NUMBERED = LISTED.replace("<measTypes>attempts drops</measTypes>", '<measType p="1">attempts</measType><measType p="2">drops</measType><measType p="3">holds</measType>').replace(
    "<measResults>120 3.5</measResults>", '<r p="2">3.5</r><r p="1">120</r><r p="3">8</r>').replace("<measResults>NIL 0</measResults>", '<r p="1">NIL</r><r p="2">0</r><r p="3">1</r>')


def packed(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(gzip.compress(text.encode()))
    return str(folder)


def test_omes_file_with_gzip_attributes_and_references(spark, tmp_path):
    got = files.read_omes_xml(spark, packed(tmp_path / "o", "OMeS_EMS-1_20260105T0100Z.xml.gz", OMES))
    rows = {(r["object_dn"], r["meas_group"], r["counter"]): (r["value"], r["period_start"], r["period_end"]) for r in got.collect()}
    quarter, hour = (datetime(2026, 1, 5, 1), datetime(2026, 1, 5, 1, 15)), (datetime(2026, 1, 5, 2), datetime(2026, 1, 5, 3))
    assert rows == {
        ("PLMN-1/BTS-1/CELL-2", "LTE", "M1C1"): (5.0, *quarter), ("PLMN-1/BTS-1/CELL-2", "LTE", "M1C2"): (None, *quarter), ("PLMN-1/BTS-1/CELL-2", "LTE", "M1C3"): (10.0, *quarter),
        ("PLMN-1/BTS-1/CELL-3", "LTE", "M1C1"): (7.5, *quarter), ("PLMN-1/BTS-1", "B", "X"): (1.0, *hour),
    }


def test_both_forms_with_gzip(spark, tmp_path):
    for k, (text, extra) in enumerate([(LISTED, {}), (NUMBERED, {("Sector=1", "holds"): 8.0, ("Sector=2", "holds"): 1.0})]):
        path = packed(tmp_path / f"p{k}", "A20260302.2230+0100-2300+0100_Node-77.xml.gz", text)
        rows = files.read_pm_xml(spark, path).collect()
        assert {(r["object_dn"].removeprefix("SubNetwork=9,Node=77,"), r["counter"]): r["value"] for r in rows} == {("Sector=1", "attempts"): 120.0, ("Sector=1", "drops"): 3.5, ("Sector=2", "attempts"): None, ("Sector=2", "drops"): 0.0} | extra
        assert {(r["period_start"], r["period_end"]) for r in rows} == {(datetime(2026, 3, 2, 21, 30), datetime(2026, 3, 2, 22))}
        assert {(r["object_dn"][-1], r["suspect"]) for r in rows} == {("1", False), ("2", True)}
        assert files.validate_pm_files(files.raw_pm_xml(spark, path)).count() == 0 == structure.validate_structure(spark, path).count()


@pytest.mark.parametrize("old, new", [('<r p="3">1</r>', ""), ('<r p="3">1', '<r p="4">1'), ('<measType p="2">', '<measType p="1">'), ('<r p="2">3.5</r><r p="1">120</r><r p="3">8</r>', "<measResults>5</measResults>")])
def test_results_of_another_form_or_number_than_their_types(spark, tmp_path, old, new):
    broken = packed(tmp_path / "b", "x.xml.gz", NUMBERED.replace(old, new))
    assert [r["violation"] for r in files.validate_pm_files(files.raw_pm_xml(spark, broken)).collect()] == ["results do not match types"]


FOOTER = '<fileFooter><measCollec endTime="2026-03-02T23:00:00+01:00"/></fileFooter>'
BREAKS = {
    "no fileFooter": [(FOOTER, "")],
    "fileFooter is not last": [(FOOTER, ""), ("</fileHeader>", "</fileHeader>" + FOOTER)],
    "measValue without measObjLdn": [(' measObjLdn="Sector=2"', "")],
    "fileHeader without fileFormatVersion": [(' fileFormatVersion="2"', "")],
    "granPeriod without duration or endTime": [(' endTime="2026-03-02T23:00:00+01:00"/><repPeriod', "/><repPeriod")],
    "measInfo is not granPeriod, types, values": [("<measTypes>attempts drops</measTypes>", ""), ("</measInfo>", "<measTypes>attempts drops</measTypes></measInfo>")],
    "foreign element": [("</managedElement>", ""), ('<measInfo measInfoId="Traffic">', '<remark a="b"><x/></remark><measInfo measInfoId="Traffic">')],
    "duration is no number of seconds": [("PT1800S", "PT30M")],
    "fileHeader without beginTime": [(' beginTime="2026-03-02T22:30:00+01:00"', "")],
    "fileFooter without endTime": [(FOOTER, "<fileFooter><measCollec/></fileFooter>")],
    "fileFooter is not measCollec": [(FOOTER, "<fileFooter/>")],
    "fileHeader is not fileSender, measCollec": [('<fileSender localDn="Manager=4" elementType="x"/>', "")],
    "no fileHeader at the beginning": [('<fileHeader fileFormatVersion="2" vendorName="T" dnPrefix="SubNetwork=9"><fileSender localDn="Manager=4" elementType="x"/><measCollec beginTime="2026-03-02T22:30:00+01:00"/></fileHeader>', "")],
    "measValue does not hold results of one form": [("<measResults>120 3.5</measResults>", "<measResults>120 3.5</measResults><measResults>1 2</measResults>")],
    "measData is not managedElement, measInfo": [('<managedElement localDn="Node=77" swVersion="4.1"/>', "")],
    "element out of place or not closed": [("</measCollecFile>", "")],
    "no measCollecFile": [("measCollecFile", "otherFile")],
}


def test_each_broken_rule_is_named_alone(spark, tmp_path):
    folder = tmp_path / "rules"
    for k, edits in enumerate(BREAKS.values()):
        text = LISTED
        for old, new in edits:
            text = text.replace(old, new)
        packed(folder, f"f{k}.xml.gz", text)
    packed(folder, "sound.xml.gz", LISTED)
    (folder / "two.xml").write_text(f"<files>{LISTED.split('?>')[1]}{LISTED.split('?>')[1].replace(FOOTER, '')}</files>")
    (folder / "empty.xml").write_text("")
    got = sorted((r["file_name"], r["violation"]) for r in structure.validate_structure(spark, str(folder)).collect())
    assert got == sorted([*((f"f{k}.xml.gz", rule) for k, rule in enumerate(BREAKS)), ("two.xml", "no fileFooter")])


def test_long_collections_are_judged_whole(spark, tmp_path):
    values = "".join(f'<measValue measObjLdn="Sector={i}"><measResults>{i} 1</measResults></measValue>' for i in range(20_000))
    sound = LISTED.replace("<measTypes>attempts drops</measTypes>", "<measTypes>attempts drops</measTypes>" + values)
    path = packed(tmp_path / "long", "sound.xml.gz", sound)
    packed(tmp_path / "long", "broken.xml.gz", sound.replace(' measObjLdn="Sector=19999"', ""))
    assert [tuple(r) for r in structure.validate_structure(spark, path).collect()] == [("broken.xml.gz", "measValue without measObjLdn")]


def test_names_of_both_dialects(spark):
    names = [("A20260105.2345+0700-0000+0700_E1.xml.gz",), ("OMeS_EMS-NK-01_20260105T0800Z.xml.gz",), ("OMeS_EMS 1_20260105T0800Z.xml",), ("C20260105.1500+0700-20260106.1500+0700_X.xml",)]
    got = [r["p"] for r in spark.createDataFrame(names, "n string").select(files.file_period(F.col("n")).alias("p")).collect()]
    assert got[0] == (datetime(2026, 1, 5, 16, 45), datetime(2026, 1, 5, 17)) and got[1] == (datetime(2026, 1, 5, 8), None) and got[2] is None and got[3] is None


def test_the_newest_version_stays(spark, tmp_path):
    path, keys = str(tmp_path / "silver"), ["cell"]
    each = ingest.merge_batches(path, keys)
    at = datetime(2026, 1, 5, 8)
    batch = lambda *rows: spark.createDataFrame([(c, at, v, datetime(2026, 1, 6, h), "f") for c, v, h in rows], "cell string, period_start timestamp, value double, arrival_time timestamp, file_hash string")
    table = lambda: {r["cell"]: r["value"] for r in spark.read.parquet(path).collect()}
    each(batch(("a", 1.0, 1), ("a", 2.0, 2), ("b", 5.0, 1)), 0)
    assert table() == {"a": 2.0, "b": 5.0}
    each(batch(("a", 1.5, 1), ("b", 6.0, 3)), 1)
    each(batch(("a", 1.5, 1), ("b", 6.0, 3)), 1)
    assert table() == {"a": 2.0, "b": 6.0}


def test_a_key_that_a_source_repeats_comes_in_once(spark):
    t, s = spark.createDataFrame([(1, 1.0), (2, 1.0)], "k int, v double"), spark.createDataFrame([(1, 5.0), (1, 7.0), (3, 2.0)], "k int, v double")
    assert sorted(map(tuple, quality.upsert(t, s, ["k"]).collect())) == [(1, 7.0), (2, 1.0), (3, 2.0)]


def test_samples_over_the_cap_or_empty_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="bytes"):
        sinks.export_sample({"x": spark.range(1000)}, str(tmp_path / "a"), cap_bytes=10)
    with pytest.raises(ValueError, match="empty"):
        sinks.export_sample({"x": spark.range(0)}, str(tmp_path / "b"))
    assert not (tmp_path / "a").exists() and sinks.export_sample({"x": spark.range(9)}, str(tmp_path / "c")).first()["rows"] == 9


def test_a_long_chain_is_spaced_out_to_its_end(spark):
    points = spark.createDataFrame([(i, float(i), 0.0, 1000.0 - i) for i in range(60)], "top int, x double, y double, height double")
    assert sorted(r["top"] for r in space.space_out(points, 1.5).select("top").collect()) == list(range(0, 60, 2))


def test_ordinal_ranks_with_ties(spark):
    rnd = random.Random(1)
    rows = [(g, float(rnd.choice([0, 0, 0, 1, 2, rnd.random()])), float(rnd.randint(0, 5)), i) for g in "ab" for i in range(700)]
    got = {r["g"]: r["rho"] for r in statistics.spearman_ordinal(spark.createDataFrame(rows, "g string, x double, y double, t int"), "x", "y", ["g"], "t").collect()}
    import numpy as np

    for g in "ab":
        mine = [r for r in rows if r[0] == g]
        rank = lambda k: np.argsort(np.argsort([r[k] for r in mine], kind="stable"))  # noqa: E731, B023
        assert got[g] == pytest.approx(np.corrcoef(rank(1), rank(2))[0, 1])
