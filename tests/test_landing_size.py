"""What a landing moves and parses: packed text, one read of the pages, no row
shuffled for its number, staged intermediates packed tight."""

import glob
import gzip

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrascore.plans import io_queries as IO
from terrascore.registry import INDICATORS
from terrascore.schemas import ENVELOPE_RECORD
from terrascore.session import checkpoint_root, shared_path, stage_table
from terrascore.sinks.writers import write_raw_json
from terrascore.sources import adapter
from terrascore.sources import envelopes as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _written(spark, run, pattern="*"):
    """Files that ``run`` wrote below the shared folder."""
    top = checkpoint_root(spark).removeprefix("file:")
    before = set(glob.glob(f"{top}/**/part-*", recursive=True))
    run().collect()
    return {f for f in set(glob.glob(f"{top}/**/part-*", recursive=True)) - before if glob.fnmatch.fnmatch(f, pattern)}


# F1
def test_pages_are_read_and_parsed_once(spark, tmp_path):
    """A filter on the elements parses none again, and the rank reads the pages once."""
    (tmp_path / "p.json").write_text('[{"page":1},[{"indicator":{"id":"X"},"value":1}]]\n[{"page":1},[{"value":2}]]\n' * 2)
    once = E.latest_pages(E.read_envelopes(spark, str(tmp_path), whole_files=False))
    assert _plan(once).count("FileScan") == 1
    assert once.count() == 3  # two of no known indicator, each kept
    flat = _plan(E.page_elements(once).where("reject_reason is null").select("record.*"))
    assert flat.count("from_json(StructField(countryiso3code") == 1


def test_first_indicator_named_is_found_behind_others(spark):
    doc = '[{"page":3,"pages":4},["text",{"value":1},{"indicator":{"id":null}},{"indicator":{"id":"X"}},{"indicator":{"id":"Y"}}]]'
    keys = E._page_key(spark.createDataFrame([(doc,), ('[{"page":1},[{"indicator":{"id":"Y"}},{"indicator":{"id":"X"}}]]',)], "envelope string"),
                       "envelope")
    assert {tuple(r) for r in keys.select("indicator_id", "page").collect()} == {("X", 3), ("Y", 1)}


@pytest.mark.parametrize("element,reason,value", [
    ('{"country":null,"indicator":null,"value":null}', None, None), ('{"value":"1e3"}', None, "1e3"), ('{"value":""}', "bad_value", ""),
    ('{"value":{"a":1}}', "bad_value", '{"a":1}'), ('{"value":[1]}', "bad_value", "[1]"), ('{"value":true}', "bad_value", "true"),
    ('{"country":"x","indicator":7,"value":"a"}', "bad_country", None), ('{"country":{},"indicator":[{}]}', "bad_indicator", None),
    ('{"country":[{"value":"n"}],"value":2}', "bad_country", None), ('{"indicator":"i","value":2}', "bad_indicator", None),
    ("7", "not_an_object", None), ('"text"', "not_an_object", None), ("null", "not_an_object", None), ("[]", "not_an_object", None),
])
def test_element_reasons(spark, element, reason, value):
    """Beside good elements, which all stay."""
    doc = f'[{{"page":1}},[{{"value":5}},{element},{{"value":6}}]]'
    rows = E.page_elements(spark.createDataFrame([(doc,)], "envelope string")).orderBy("position").collect()
    assert [r["reject_reason"] for r in rows] == [None, reason, None]
    assert [rows[0]["record"]["value"], rows[2]["record"]["value"]] == ["5", "6"]
    if value is not None:
        assert rows[1]["record"]["value"] == value
    assert rows[0]["record"].asDict().keys() == {f.name for f in ENVELOPE_RECORD.fields}


def test_rows_are_numbered_without_a_shuffle(spark):
    """Null, empty and uneven indicators, in several parts: numbers from 0, each once."""
    raw = spark.range(5000).repartition(7).select(
        F.when(F.col("id") % 10 < 6, "A").when(F.col("id") % 10 < 8, "").when(F.col("id") % 10 == 8, "B").alias("indicator_id"), "id")
    numbered = E._numbered(raw)
    assert "hashpartitioning" not in _plan(numbered)
    got = numbered.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_row").alias("d"), F.min("_row").alias("lo"),
                                               F.max("_row").alias("hi"), F.min("_total").alias("t"), F.max("_total").alias("u"))
    assert {r["indicator_id"]: tuple(r)[1:] for r in got.collect()} == {
        k: (n, n, 0, n - 1, n, n) for k, n in (("A", 3000), ("", 1000), ("B", 500), (None, 500))}


def test_staged_tables_are_packed_tight(spark):
    path = shared_path(spark, "staged")
    assert stage_table(spark.range(100), "staged", path=path).count() == 100
    files = glob.glob(f"{path.removeprefix('file:')}/part-*")
    assert files and all(".zstd." in f for f in files)


# F1, F2, F3, F6, F7, F8: text lands packed
@pytest.mark.parametrize("name", ["flatten_envelopes", "envelope_completeness", "missing_pages", "malformed_in_job", "stream_quarantine",
                                  "stream_clean_observations", "json_roundtrip", "empty_indicator_landing", "landed_back"])
def test_text_lands_packed(spark, name):
    files = _written(spark, lambda: IO.io_queries()[name](spark, SF_SMALL))
    text = {f for f in files if ".parquet" not in f}
    assert text and all(f.endswith(".gz") for f in text)


# F1
def test_pages_are_staged_as_lines(spark):
    """No batch of pages is ever held by a columnar reader."""
    pages = IO._staged_pages(spark, SF_SMALL)
    assert "FileScan text" in _plan(pages) and pages.columns == ["page", "envelope"]
    both = E.pack_envelopes(adapter.raw_observations(spark, SF_SMALL)).select("page", F.json_array_length(F.get_json_object("envelope", "$[1]")).alias("n"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, pages.select(
        "page", F.json_array_length(F.get_json_object("envelope", "$[1]")).alias("n")).collect()))


# F2, F6
@pytest.mark.parametrize("name", ["envelope_completeness", "missing_pages"])
def test_pages_of_one_use_are_not_staged(spark, name):
    assert not _written(spark, lambda: IO.io_queries()[name](spark, SF_SMALL), "*/packed_pages-*")


# F4, F5
@pytest.mark.parametrize("name", ["landed_back", "landing_manifest"])
def test_landing_in_two_formats_makes_the_rows_once(spark, name):
    assert _written(spark, lambda: IO.io_queries()[name](spark, SF_SMALL), "*/raw-*")


# F9, F10
def test_packed_json_is_cut_into_files(spark, monkeypatch):
    """A packed file is one task to its reader, so none grows without end."""
    from terrascore.sinks import writers
    monkeypatch.setitem(writers.PACKED, "maxRecordsPerFile", 50)
    raw, path = adapter.raw_observations(spark, SF_SMALL), shared_path(spark, "json")
    write_raw_json(raw, path)
    lines = [sum(1 for _ in gzip.open(f)) for f in glob.glob(f"{path.removeprefix('file:')}/**/part-*.gz", recursive=True)]
    assert max(lines) <= 50 and sum(lines) == raw.count() and len(lines) > len(INDICATORS)


# F11, F12
def test_snapshots_are_packed_tight(spark):
    from terrascore.sinks.writers import write_snapshot
    path = shared_path(spark, "snapshot")
    write_snapshot(spark.range(100).withColumn("process_date", F.lit("2025-01-01").cast("date")), path, ("process_date",))
    files = glob.glob(f"{path.removeprefix('file:')}/process_date=2025-01-01/part-*")
    assert files and all(".zstd." in f for f in files)
    assert spark.read.parquet(path).count() == 100


# F11
def test_ungathered_rows_are_written_where_they_are(spark):
    """A file per task and folder, the same rows, more folders than are open at once, the setting put back."""
    from terrascore.sinks import writers
    key, folders = "spark.sql.maxConcurrentOutputFileWriters", writers.OPEN_FOLDERS + 8
    before, path = spark.conf.get(key), shared_path(spark, "snapshot")
    rows = spark.range(0, 4000, 1, 4).withColumn("folder", F.col("id") % folders)
    for _ in range(2):  # the second replaces the first
        writers.write_snapshot(rows, path, ("folder",), gather=False)
    assert len(glob.glob(f"{path.removeprefix('file:')}/folder=*/part-*")) == 4 * folders
    back = spark.read.schema(rows.schema).parquet(path)
    assert back.exceptAll(rows).isEmpty() and back.count() == 4000
    assert spark.conf.get(key) == before


# F11
def test_job_moves_no_row_to_write_it(spark, monkeypatch):
    """Observations and facts go from the files they are read from to their
    folders; the rows of an index year are brought together."""
    from terrascore.plans import snapshot_job as J
    plans = {}

    def written(df, path, partition_by=("process_date", "indicator_name"), gather=True):
        moved = df.hint("rebalance", *[F.col(c) for c in partition_by]) if gather else df
        plans[path.rsplit("/", 1)[1]] = _plan(moved)
        return real(df, path, partition_by, gather)
    real = J.write_snapshot
    monkeypatch.setattr(J, "write_snapshot", written)
    raw = stage_table(adapter.raw_observations(spark, SF_SMALL), "raw")
    J.run(spark, raw, shared_path(spark, "job"), adapter.DEFAULT_EXTRACTION_DATE)
    still = {n for n, plan in plans.items() if "Exchange" not in plan and n != "rejected"}
    assert still == {"observations", "fact_employment_metrics", "fact_economic_indicators", "fact_education"}
    assert "rebalance" in plans["opportunity_index"].lower()


# F12
def test_refused_rows_are_written_where_they_are(spark, monkeypatch):
    """What is refused or malformed is not brought together to be written: a file
    per reading task and reason, every row in its own folder."""
    from terrascore.plans import snapshot_job as J
    gathered = {}
    real = J.write_snapshot
    monkeypatch.setattr(J, "write_snapshot", lambda df, path, partition_by=None, gather=True: (
        gathered.update({path.rsplit("/", 1)[1]: gather}),
        real(df, path, partition_by or ("process_date", "indicator_name"), gather=gather)))
    path, root = shared_path(spark, "landing"), shared_path(spark, "job")
    IO._flawed_lines(spark, SF_SMALL).write.text(path)
    raw, malformed = J.load_landed(spark, "json", path, adapter.DEFAULT_EXTRACTION_DATE)
    J.run(spark, raw, root, adapter.DEFAULT_EXTRACTION_DATE, malformed=malformed)
    assert gathered["rejected"] is False and gathered["malformed"] is False
    want = J.C.rejected_observations(raw).groupBy("reject_reason").count()
    got = spark.read.parquet(f"{root}/rejected").groupBy("reject_reason").count()
    assert got.count() == 3 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(f"{root}/malformed").count() == malformed.count() > 0
