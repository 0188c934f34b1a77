"""Edge inputs (FIXTURES §5, SURVEY §2.13) on small hand-written fixtures."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from terrascore.operators import clean as C
from terrascore.operators import facts, index
from terrascore.operators.rank import rank_window
from terrascore.schemas import RAW
from terrascore.session import shared_path
from terrascore.sinks.writers import ensure_database, load_table, write_raw_csv, write_snapshot
from terrascore.sources import envelopes, files

D = dt.date(2025, 1, 1)


def raw_df(spark, rows):
    return spark.createDataFrame(
        [(c, n, i, ind, y, v, D) for c, n, i, ind, y, v in rows], RAW)


def test_clean_rules_and_reject_reasons(spark):
    raw = raw_df(spark, [
        ("AAA", "A", "x", "gdp", "2020", 1.0),
        ("", "E", "x", "gdp", "2020", 1.0),
        (None, "N", "x", "gdp", "2020", 1.0),
        ("BBB", "B", "x", "gdp", "2020", None),
        ("CCC", "C", "x", "gdp", "20x0", 1.0),
    ])
    assert [r["country_code"] for r in C.clean_observations(raw).collect()] == ["AAA"]
    reasons = {r["country_name"]: r["reject_reason"]
               for r in C.rejected_observations(raw).collect()}
    assert reasons == {"E": "empty_code", "N": "null_code", "B": "null_value", "C": "bad_year"}
    bad = C.bad_years(raw).collect()
    assert [(r["country_code"], r["year"]) for r in bad] == [("CCC", "20x0")]


def test_exclusion_list_and_name_drift(spark):
    from terrascore.operators import dims
    raw = raw_df(spark, [
        ("AAA", "Alpha", "x", "gdp", "2020", 1.0),
        ("AAA", "Alpha Rep.", "x", "gdp", "2021", 2.0),
        ("WLD", "World", "x", "gdp", "2020", 9.0),
        ("BBB", "Beta", "x", "gdp", "2020", 3.0),
    ])
    kept = C.clean_observations(raw, exclude_codes=("WLD",))
    assert sorted(r.country_code for r in kept.collect()) == ["AAA", "AAA", "BBB"]
    drift = dims.name_drift(kept).collect()
    assert [(r.country_code, r.n_names, r.first_name, r.last_name) for r in drift] == [
        ("AAA", 2, "Alpha", "Alpha Rep.")]
    # parity: both names stay in the dimension
    assert dims.country_dimension(kept).where(F.col("country_code") == "AAA").count() == 2


def test_missing_indicators_keep_all_columns_and_score_50(spark):
    raw = raw_df(spark, [
        ("AAA", "A", "x", "unemployment_rate", "2020", 5.0),
        ("AAA", "A", "x", "gdp", "2020", 100.0),
    ])
    wide = facts.build_wide(C.clean_observations(raw))
    edu = facts.fact_from_wide(wide, "education")
    assert edu.columns == ["country_code", "year", "education_spending", "school_enrollment"]
    assert edu.count() == 0
    out = index.scored(wide).collect()
    assert len(out) == 1 and out[0]["edu_score"] == 50 and out[0]["business_score"] == 50


def test_duplicates_collapse_to_max_and_are_reported(spark):
    raw = raw_df(spark, [
        ("AAA", "A", "x", "gdp", "2020", 1.0),
        ("AAA", "A", "x", "gdp", "2020", 3.0),
        ("AAA", "A", "x", "inflation", "2020", 2.0),
    ])
    clean = C.clean_observations(raw)
    fact = facts.build_fact(clean, "economic").collect()
    assert len(fact) == 1 and fact[0]["gdp"] == 3.0 and fact[0]["inflation"] == 2.0
    dup = C.duplicate_keys(clean).collect()
    assert [(r["indicator_name"], r["n_obs"]) for r in dup] == [("gdp", 2)]


def test_inner_and_left_join_membership(spark):
    raw = raw_df(spark, [
        ("EMP", "E", "x", "unemployment_rate", "2020", 5.0),      # employment only
        ("BOTH", "B", "x", "unemployment_rate", "2020", 5.0),
        ("BOTH", "B", "x", "gdp", "2020", 5.0),                   # no education
    ])
    keys = [r["country_code"] for r in index.scored(
        facts.build_wide(C.clean_observations(raw))).collect()]
    assert keys == ["BOTH"]


def test_ties_rank_1_1_3(spark):
    df = spark.createDataFrame([("a", 1, 9.0), ("b", 1, 9.0), ("c", 1, 8.0)],
                               "k string, year int, v double")
    got = {r["k"]: r["r"] for r in rank_window(df, "year", "v", "r").collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def test_outer_join_chain_equals_pivot_on_unique_keys(spark):
    raw = raw_df(spark, [
        ("A", "A", "x", "unemployment_rate", "2020", 1.0),
        ("B", "B", "x", "youth_unemployment", "2020", 2.0),
        ("A", "A", "x", "employment_ratio", "2021", 3.0),
        ("A", "A", "x", "youth_unemployment", "2020", 4.0),
    ])
    clean = C.clean_observations(raw)
    names = ("unemployment_rate", "youth_unemployment", "employment_ratio")
    a = sorted(tuple(r) for r in facts.outer_join_chain(clean, names).collect())
    b = sorted(tuple(r) for r in facts.build_fact(clean, "employment").collect())
    assert a == b and len(a) == 3


def test_envelope_edge_documents(spark):
    docs = [
        '[{"message":[{"id":"120","value":"Invalid value"}]}]',               # error payload
        '[{"page":1,"pages":1},[]]',                                           # empty rows
        '[{"page":1,"pages":1},null]',                                         # null rows
        '[{"page":1},[{"countryiso3code":"AAA","country":{"id":"AA","value":"Alpha"},'
        '"indicator":{"id":"NY.GDP.MKTP.CD","value":"GDP"},"date":"2020","value":12.5},'
        '{"country":null,"indicator":{"id":"NY.GDP.MKTP.CD"},"date":"2021","value":null},'
        '{"countryiso3code":"BBB","country":{"value":"Be, \\"ta\\""},'
        '"indicator":{"id":"UNKNOWN"},"date":"2020","value":1}]]',
    ]
    env = spark.createDataFrame([(d,) for d in docs], "envelope string")
    rows = envelopes.flatten_envelopes(env, D).orderBy("year", F.col("country_code").asc()).collect()
    assert [(r.country_code, r.country_name, r.indicator_name, r.year, r.value) for r in rows] == [
        ("AAA", "Alpha", "gdp", "2020", 12.5),
        ("BBB", 'Be, "ta"', None, "2020", 1.0),
        ("", "", "gdp", "2021", None),
    ]
    asked = envelopes.flatten_envelopes(env, D, indicator=("UNKNOWN", "asked_for"))
    assert {r.indicator_name for r in asked.collect()} == {"gdp", "asked_for"}
    reasons = [r.reject_reason for r in envelopes.rejected_pages(
        spark.createDataFrame([(d,) for d in [*docs, "[{", None, '[1,{"a":2}]']], "envelope string")).collect()]
    assert sorted(reasons) == ["error_payload", "not_json_array", "not_json_array", "records_not_array"]


def test_envelope_completeness_flags_missing_and_repeated_pages(spark):
    rows = [(f"C{i}", f"N{i}", ind_id, ind, "2020", float(i))
            for i in range(9) for ind_id, ind in (("NY.GDP.MKTP.CD", "gdp"),
                                                  ("SE.TER.ENRR", "school_enrollment"))]
    pages = envelopes.pack_envelopes(raw_df(spark, rows), page_size=3).collect()
    gdp = sorted((p for p in pages if p["indicator_id"] == "NY.GDP.MKTP.CD"),
                 key=lambda p: p["page"])
    edu = [p for p in pages if p["indicator_id"] == "SE.TER.ENRR"]
    # gdp: one page lost; education: every page, one landed twice; + an error doc
    docs = [p["envelope"] for p in gdp[1:]] + [p["envelope"] for p in edu] \
        + [edu[0]["envelope"], '[{"message":[{"id":"120","value":"Invalid value"}]}]']
    got = {r["indicator_id"]: r.asDict() for r in envelopes.envelope_completeness(
        spark.createDataFrame([(d,) for d in docs], "envelope string")).collect()}
    assert set(got) == {"NY.GDP.MKTP.CD", "SE.TER.ENRR", None}
    assert got[None]["pages_landed"] == 1 and not got[None]["complete"]
    g, e = got["NY.GDP.MKTP.CD"], got["SE.TER.ENRR"]
    assert g["rows_expected"] == 9 and 0 < g["rows_seen"] < 9
    assert g["pages_seen"] == g["pages_expected"] - 1 and not g["complete"]
    assert e["rows_expected"] == 9 and e["pages_landed"] == e["pages_seen"] + 1
    assert e["pages_seen"] == e["pages_expected"] and not e["complete"]


def test_equal_rows_spread_over_pages(spark):
    raw = raw_df(spark, [("A", "A", "id", "gdp", "2020", 1.0)] * 5000)
    pages = envelopes.pack_envelopes(raw, page_size=1000)
    sizes = [r[0] for r in pages.select(F.expr("json_array_length(get_json_object(envelope, '$[1]'))")).collect()]
    assert sizes == [1000] * 5


def test_partitioned_write_files_follow_the_data(spark):
    raw = raw_df(spark, [(f"C{i}", "N", "id", ind, "2020", 1.0) for i in range(500)
                         for ind in ("gdp", "inflation", "government_debt")]).repartition(40)
    path = shared_path(spark, "edge_files")
    write_raw_csv(raw, path)
    local = path.replace("file:", "")
    assert len([f for _, _, fs in os.walk(local) for f in fs if f.endswith(".csv")]) == 3


def test_two_dates_of_raw_landing_survive(spark):
    raw = raw_df(spark, [("AAA", "A", "x", "gdp", "2020", 1.0)])
    path = shared_path(spark, "edge_dates")
    for d in (dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 2)):
        write_raw_csv(raw.withColumn("extraction_date", F.lit(d)), path)
    back = files.read_raw_csv(spark, path, files.CSV_SINK_OPTIONS)
    assert sorted(str(r.extraction_date) for r in back.collect()) == ["2025-01-01", "2025-01-02"]


def test_malformed_records_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"country_code":"AAA","year":"2020","value":1.5}\n{"country_code":"BBB","year":"2020","value":"abc"}\n{"cut\n')
    rows, bad = files.read_raw_with_rejects(spark, str(tmp_path))
    assert [r.country_code for r in rows.collect()] == ["AAA"]
    assert sorted(r.record for r in bad.collect()) == ['{"country_code":"BBB","year":"2020","value":"abc"}', '{"cut']


def test_index_from_stored_facts_equals_the_wide_one(spark):
    rows = [(c, c, "x", i, y, float(len(c) * 7 + k)) for c in ("A", "BB", "CCC") for y in ("2020", "2021")
            for k, i in enumerate(("unemployment_rate", "gdp", "gdp_per_capita", "inflation", "school_enrollment"))]
    wide = facts.build_wide(C.clean_observations(raw_df(spark, rows[:-1] + [("D", "D", "x", "gdp", "2020", 1.0)])))
    three = [facts.fact_from_wide(wide, f) for f in ("employment", "economic", "education")]
    a, b = index.from_facts(*three), index.opportunity_index(wide)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_working_folder_is_asked_for_on_a_cluster(monkeypatch):
    from terrascore import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"
        def getCheckpointDir(self): return None
        def getConf(self): return Conf()

    class Session:
        sparkContext = Context()
    try:
        session.checkpoint_root(Session())
        raised = False
    except ValueError:
        raised = True
    assert raised


def test_csv_roundtrip_quotes_commas_empty_and_null(spark):
    raw = raw_df(spark, [
        ("AAA", 'Name, "quoted"', "x", "gdp", "2020", 1.5),
        ("", None, "x", "gdp", "2020", None),
    ])
    path = shared_path(spark, "edge_csv")
    write_raw_csv(raw, path)
    back = files.read_raw_csv(spark, path, files.CSV_SINK_OPTIONS).withColumn(
        "value", F.col("value").try_cast("double"))
    assert sorted(back.collect(), key=str) == sorted(raw.collect(), key=str)


def test_landed_pandas_style_csv(spark, tmp_path):
    p = tmp_path / "gdp.csv"
    p.write_text('country_code,country_name,indicator_id,indicator_name,year,value,'
                 'extraction_date\nAAA,"Korea, ""Rep.""",NY.GDP.MKTP.CD,gdp,2020,1.5,2025-01-01\n'
                 ',Aggregate,NY.GDP.MKTP.CD,gdp,2020,,2025-01-01\n'
                 'CCC,C,NY.GDP.MKTP.CD,gdp,20x0,abc,2025-01-01\n')
    raw = files.read_raw_csv(spark, str(p))
    clean = C.clean_observations(raw).collect()
    assert [(r.country_code, r.country_name, r.year, r.value) for r in clean] == [
        ("AAA", 'Korea, "Rep."', 2020, 1.5)]


def test_landed_json_array_of_records(spark, tmp_path):
    # one array per file, pretty-printed over several lines, null value
    (tmp_path / "gdp.json").write_text(
        '[\n {"country_code":"AAA","country_name":"A","indicator_id":"NY.GDP.MKTP.CD",'
        '"indicator_name":"gdp","year":"2020","value":1.5,"extraction_date":"2025-01-01"},\n'
        ' {"country_code":"BBB","country_name":"B","indicator_id":"NY.GDP.MKTP.CD",'
        '"indicator_name":"gdp","year":"2021","value":null,"extraction_date":"2025-01-01"}\n]\n')
    raw = files.read_raw_json(spark, str(tmp_path), multi_line=True)
    rows = sorted((r.country_code, r.year, r.value, str(r.extraction_date)) for r in raw.collect())
    assert rows == [("AAA", "2020", 1.5, "2025-01-01"), ("BBB", "2021", None, "2025-01-01")]
    assert [r.country_code for r in C.clean_observations(raw).collect()] == ["AAA"]


def test_wildcard_table_source(spark):
    root = shared_path(spark, "tables")
    for name, n in (("a", 3), ("b", 5)):
        spark.range(n).write.parquet(f"{root}/{name}")
        # a stray non-Parquet file next to the data is skipped by the glob
        with open(f"{root.replace('file:', '')}/{name}/notes.txt", "w") as fh:
            fh.write("not data")
    got = files.read_tables(spark, root, {n: spark.range(0).schema for n in ("a", "b")})
    assert {k: v.count() for k, v in got.items()} == {"a": 3, "b": 5}


def test_snapshot_rewrite_keeps_other_dates(spark):
    raw = raw_df(spark, [("AAA", "A", "x", "gdp", "2020", 1.0),
                         ("BBB", "B", "x", "inflation", "2020", 2.0)])
    path = shared_path(spark, "edge_snap")
    for d in (dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 1)):
        write_snapshot(C.clean_observations(raw, d), path)
    counts = {str(r[0]): r[1] for r in spark.read.parquet(path)
              .groupBy(F.col("process_date").cast("string")).count().collect()}
    assert counts == {"2025-01-01": 2, "2025-01-02": 2}
    one = files.read_snapshot(spark, path, "2025-01-02", ("gdp",))
    assert "PartitionFilters: [isnotnull(process_date" in \
        one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_load_dispositions(spark):
    db = f"edge_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, location=shared_path(spark, "db"))
    df = spark.createDataFrame([(1,), (2,)], "x int")
    path = shared_path(spark, "edge_table")
    assert load_table(df, f"{db}.t", "WRITE_TRUNCATE", path=path) == 2
    load_table(df, f"{db}.t", "WRITE_APPEND", path=path)
    assert spark.table(f"{db}.t").count() == 4
    load_table(df, f"{db}.t", "WRITE_TRUNCATE", path=path)
    assert spark.table(f"{db}.t").count() == 2
    try:
        load_table(df, f"{db}.t", "WRITE_EMPTY", path=path)
        raised = False
    except Exception:
        raised = True
    assert raised


def test_failed_truncate_keeps_the_previous_table(spark):
    import glob
    db = f"edge_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, location=shared_path(spark, "db"))
    path = shared_path(spark, "edge_versions")
    good = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert load_table(good, f"{db}.t", "WRITE_TRUNCATE", path=path) == 3
    bad = spark.range(10).select(
        F.when(F.col("id") == 7, F.raise_error(F.lit("boom")))
        .otherwise(F.col("id")).cast("int").alias("x"))
    try:
        load_table(bad, f"{db}.t", "WRITE_TRUNCATE", path=path)
        raised = False
    except Exception:
        raised = True
    assert raised
    assert sorted(r.x for r in spark.table(f"{db}.t").collect()) == [1, 2, 3]
    # a successful truncate points the table at the new version
    assert load_table(spark.createDataFrame([(9,)], "x int"), f"{db}.t",
                      "WRITE_TRUNCATE", path=path) == 1
    assert [r.x for r in spark.table(f"{db}.t").collect()] == [9]
    local = path.replace("file:", "")
    kept = [d for d in glob.glob(f"{local}/v-*") if glob.glob(f"{d}/*.parquet")]
    assert len(kept) == 2  # the replaced version stays for its readers
    assert not [t for t in spark.catalog.listTables(db) if "__load_" in t.name]


def test_load_schema_override_orders_and_casts_by_name(spark):
    from terrascore.schemas import TABLE_SCHEMAS
    db = f"edge_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, location=shared_path(spark, "db"))
    # columns out of order, year as bigint, an extra column the table drops
    df = spark.createDataFrame([(1.5, 2001, "C1", 2.5, 9, "x")],
                               "school_enrollment double, year bigint, country_code string, "
                               "education_spending double, extra int, junk string")
    target = TABLE_SCHEMAS["fact_education"]
    n = load_table(df.drop("extra", "junk"), f"{db}.edu", schema=target,
                   path=shared_path(spark, "edge_edu"))
    t = spark.table(f"{db}.edu")
    assert n == 1 and t.schema.simpleString() == target.simpleString()
    assert t.first().asDict() == {"country_code": "C1", "year": 2001,
                                  "education_spending": 2.5, "school_enrollment": 1.5}


def test_outer_join_chain_never_multiplies_duplicate_keys(spark):
    # a hot key observed 40 times per indicator: the chain stays one row
    rows = [("H", "H", "x", ind, "2020", float(i))
            for i in range(40) for ind in ("unemployment_rate", "youth_unemployment",
                                           "employment_ratio")]
    clean = C.clean_observations(raw_df(spark, rows))
    names = ("unemployment_rate", "youth_unemployment", "employment_ratio")
    chain = facts.outer_join_chain(clean, names).collect()
    assert len(chain) == 1 and chain[0]["unemployment_rate"] == 39.0
    assert sorted(tuple(r) for r in chain) == sorted(
        tuple(r) for r in facts.build_fact(clean, "employment").collect())


def test_checkpoint_dir_is_session_setting(spark):
    from terrascore.session import checkpoint_root
    root = checkpoint_root(spark)
    assert root and os.path.basename(os.path.dirname(root.replace("file:", ""))).startswith(
        "ts-test-ckpt-")
