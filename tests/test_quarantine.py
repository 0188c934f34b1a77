"""Landings that are not clean: bad elements, malformed lines, repeated and
missing pages, absent dates; and the ledgers that tell what was written."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from terrascore.plans import snapshot_job as J
from terrascore.schemas import CLEAN, MALFORMED, RAW
from terrascore.session import shared_path
from terrascore.sinks import writers as W
from terrascore.sources import envelopes as E
from terrascore.sources import files
from terrascore.streaming.landing import read_quarantined, run_quarantine

D = dt.date(2025, 1, 1)


def rec(code, year, value, ind="NY.GDP.MKTP.CD"):
    return {"countryiso3code": code, "country": {"id": code[:2], "value": "N" + code}, "indicator": {"id": ind, "value": "x"},
            "date": year, "value": value}


def page(n, pages, records):
    return json.dumps([{"page": n, "pages": pages, "per_page": 2, "total": 3}, records])


def test_one_bad_element_costs_only_itself(spark):
    bad = [5, None, "text", [rec("ZZZ", "2020", 1)], {"value": "abc"}, {"country": "X", "value": 1}, {"indicator": 3}, {"value": True}]
    good = [rec("AAA", "2020", 1.5), {"value": "2.5"}, {"country": None, "indicator": None, "value": None}, {}]
    mixed = [x for pair in zip(good, bad) for x in pair] + bad[len(good):]
    docs = spark.createDataFrame([(page(7, 9, mixed),), (page(8, 9, []),), ("[{}, {}]",), (None,), ("",)], "envelope string")
    rows = E.flatten_envelopes(docs, D).collect()
    assert sorted((r.country_code, r.year, r.value) for r in rows if r.value) == [("", "", 2.5), ("AAA", "2020", 1.5)]
    assert len(rows) == len(good)
    told = [(r.page, r.position, r.reject_reason) for r in E.rejected_records(docs).orderBy("position").collect()]
    assert told == [(7, 1, "not_an_object"), (7, 3, "not_an_object"), (7, 5, "not_an_object"), (7, 7, "not_an_object"), (7, 8, "bad_value"),
                    (7, 9, "bad_country"), (7, 10, "bad_indicator"), (7, 11, "bad_value")]
    texts = [r.record for r in E.rejected_records(docs).orderBy("position").collect()]
    assert texts[:3] == ["5", None, "text"] and json.loads(texts[4]) == {"value": "abc"}


def test_last_landing_of_a_page_counts_once(spark, tmp_path):
    def land(name, text, age):
        (tmp_path / name).write_text(text)
        t = time.time() - age
        os.utime(tmp_path / name, (t, t))
    land("c.json", page(1, 2, [5, rec("AAA", "2020", 1.0)]), 300)  # the first element names no indicator
    land("a.json", page(1, 2, [rec("AAA", "2020", 2.0)]), 100)
    land("b.json", page(1, 2, [rec("AAA", "2020", 3.0)]), 200)
    land("d.json", page(2, 2, [rec("BBB", "2020", 4.0)]), 200)
    land("e.json", page(1, 1, [rec("AAA", "2020", 5.0, "OTHER")]), 400)
    land("f.json", page(1, 1, [{"value": 6.0}]), 400)
    land("g.json", page(1, 1, [{"value": 7.0}]), 400)  # no indicator: not the same page
    pages = E.read_envelopes(spark, str(tmp_path))
    once = E.latest_pages(pages)
    assert once.columns == pages.columns
    assert sorted(r.value for r in E.flatten_envelopes(once, D).collect()) == [2.0, 4.0, 5.0, 6.0, 7.0]
    raw, malformed = J.load_landed(spark, "envelopes", str(tmp_path), D)
    assert raw.count() == 5 and malformed.count() == 0 and malformed.schema.names == MALFORMED.names
    assert E.latest_pages(pages.limit(0)).count() == 0


def test_missing_pages_are_named(spark):
    docs = [page(n, 7, [rec("A", "2020", 1)]) for n in (1, 2, 4, 4, 7)] + [page(1, 3, [rec("A", "2020", 1, "B")]), page(1, 1, [rec("A", "2020", 1, "C")]), "x", None]
    got = E.missing_pages(spark.createDataFrame([(d,) for d in docs], "envelope string")).collect()
    assert sorted((r.indicator_id, r.page) for r in got) == [("B", 2), ("B", 3)] + [("NY.GDP.MKTP.CD", n) for n in (3, 5, 6)]
    many = E.missing_pages(spark.createDataFrame([(page(2, 3 * E.PAGE_BLOCK + 5, [rec("A", "2020", 1)]),)], "envelope string"))
    assert many.agg(F.count("page"), F.min("page"), F.max("page"), F.count_distinct("page")).first() == (
        3 * E.PAGE_BLOCK + 4, 1, 3 * E.PAGE_BLOCK + 5, 3 * E.PAGE_BLOCK + 4)


JSON_LINES = ['{"country_code":"A","country_name":"a","indicator_id":"i","indicator_name":"gdp","year":"2020","value":1.5,"extraction_date":"2025-01-01"}',
              '{"country_code":"B","country_name"', '{"country_code":"C","indicator_name":"gdp","year":"2020","value":"n/a"}', "no json"]
CSV_TEXT = ('country_code,country_name,indicator_id,indicator_name,year,value,extraction_date\n'
            'A,"a ""x""",i,gdp,2020,1.5,2025-01-01\nB,b,i\nC,c,i,gdp,2020,7,not a date\n')


@pytest.mark.parametrize("fmt,text,bad", [("json", "\n".join(JSON_LINES), 3), ("csv", CSV_TEXT, 2)])
def test_malformed_lines_in_job_and_stream(spark, tmp_path, fmt, text, bad):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / f"day.{fmt}").write_text(text)
    out = str(tmp_path / "out")
    args = ["--date", "2025-01-01", "--source", fmt, "--input", str(tmp_path / "in"), "--out", out]
    for _ in range(2):  # a second run replaces what the first wrote
        assert J.main(args) == 0
    told = spark.read.parquet(f"{out}/malformed").collect()
    assert len(told) == bad and {r.reject_reason for r in told} == {"malformed_line"}
    assert all(r.record in text and r.page_file.endswith(f"day.{fmt}") for r in told)
    assert [r.country_code for r in spark.read.parquet(f"{out}/observations").collect()] == ["A"]

    sinks = [str(tmp_path / n) for n in ("clean", "malformed")]
    run_quarantine(spark, str(tmp_path / "in"), *sinks, str(tmp_path / "ckpt"), fmt=fmt)
    run_quarantine(spark, str(tmp_path / "in"), *sinks, str(tmp_path / "ckpt"), fmt=fmt)   # nothing new
    run_quarantine(spark, str(tmp_path / "in"), *sinks, str(tmp_path / "again"), fmt=fmt)  # batch 0 run again
    clean, malformed = read_quarantined(spark, *sinks)
    assert [r.country_code for r in clean.collect()] == ["A"] and malformed.count() == bad
    (tmp_path / "in" / f"next.{fmt}").write_text(text)
    run_quarantine(spark, str(tmp_path / "in"), *sinks, str(tmp_path / "ckpt"), fmt=fmt)
    clean, malformed = read_quarantined(spark, *sinks)
    assert clean.count() == 2 and malformed.count() == 2 * bad


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV_TEXT.splitlines()[0] + '\nA,"one\ntwo",i,gdp,2020,1.5,2025-01-01\n')
    rows = files.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    assert [r.country_name for r in rows] == ["one\ntwo"]
    raw, malformed = J.load_landed(spark, "csv", str(tmp_path), D, multi_line=True)
    assert raw.count() == 1 and malformed.count() == 0


def clean_rows(spark, value):
    return spark.createDataFrame([("A", "a", "i", "gdp", 2020, value, D, D)], CLEAN)


def test_dates_resolve_by_folder(spark):
    path = shared_path(spark, "dated")
    for day, value in ((dt.date(2025, 1, 1), 1.0), (dt.date(2025, 1, 5), 5.0)):
        W.write_snapshot(clean_rows(spark, value).withColumn("process_date", F.lit(day)), path)
    assert files.snapshot_dates(spark, path, CLEAN) == [dt.date(2025, 1, 1), dt.date(2025, 1, 5)]

    def value(day, **kw):
        return [r["value"] for r in files.read_snapshot(spark, path, day, schema=CLEAN, **kw).collect()]
    assert value("2025-01-05") == [5.0] and value("2025-01-04", on_or_before=True) == [1.0]
    assert value(dt.date(2026, 1, 1), on_or_before=True) == [5.0] and value("2025-01-04", missing_ok=True) == []
    with pytest.raises(files.SnapshotNotFound, match="2025-01-01 to 2025-01-05"):
        value("2025-01-04")
    with pytest.raises(files.SnapshotNotFound, match="on or before"):
        value("2024-12-31", on_or_before=True)


def test_landing_manifest_and_rerun(spark):
    root = shared_path(spark, "landing")
    rows = [("A", "a", "i", "gdp", "2020", 1.0, D), ("B", "b", "i", "gdp", "2020", None, D), ("B", "b", "?", None, "2020", 2.0, D)]
    for _ in range(2):
        manifest = W.land_raw(spark.createDataFrame(rows, RAW), root, D)
    W.land_raw(spark.createDataFrame(rows[:1], RAW), root, D + dt.timedelta(days=1))
    by_name = {r.indicator_name: (r.n_rows, r.status) for r in manifest.collect()}
    assert by_name["gdp"] == (2, "landed") and by_name[None] == (1, "landed") and by_name["inflation"] == (0, "skipped_empty")
    assert len(by_name) == 14
    assert files.read_raw_json(spark, f"{root}/json").count() == 4
    assert files.read_raw_csv(spark, f"{root}/csv", files.CSV_SINK_OPTIONS).count() == 4
    empty = W.land_raw(spark.createDataFrame([], RAW), shared_path(spark, "landing"), D)
    assert empty.where("status = 'skipped_empty'").count() == empty.count() == 13


def test_load_log_counts_without_reading_the_table(spark):
    log, path = shared_path(spark, "log"), shared_path(spark, "table")
    db = "log_" + shared_path(spark, "x").rsplit("-", 1)[1]
    W.ensure_database(spark, db, location=shared_path(spark, "db"))
    df = spark.range(5)
    counts = []
    for disposition, rows in (("WRITE_APPEND", df), ("WRITE_APPEND", df), ("WRITE_TRUNCATE", spark.range(3)), ("WRITE_APPEND", df), ("WRITE_APPEND", df.limit(0))):
        W.load_table(rows, f"{db}.t", disposition, path=path, log=log)
        counts.append(W.loaded_rows(W.load_log(spark, log)).collect()[0]["n_rows"])
        assert spark.table(f"{db}.t").count() == counts[-1]
    assert counts == [5, 10, 3, 8, 8]
    entries = W.load_log(spark, log).orderBy("loaded_at").collect()
    assert [e.disposition for e in entries][2] == "WRITE_TRUNCATE" and entries[2].version.startswith(path)
