"""The pipeline's stages one by one on planted cases, and the whole run."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline as P
from terrascore.llm.queries import llm_queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain(k, n=60):
    return " ".join(f"plain{k}x{i}" for i in range(n)) + "."


def planted(spark, rows):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(10_000 + i, t, "en", "src1", None) for i, t in enumerate(rows)], base.schema)
    return base.unionByName(more)


def ids(df):
    return {r.doc_id - 10_000 for r in df.where("doc_id >= 10000").select("doc_id").collect()}


def test_toxic_documents_go_and_clean_ones_stay(spark):
    rude = plain(1, 30) + " you idiot moron worthless scum pathetic loser disgusting trash clown stupid idiot " + plain(2, 30)
    out = P.drop_toxic(spark, planted(spark, [rude, plain(3), plain(4)]), SF_SMALL)
    assert ids(out) == {1, 2} and out.columns == COLUMNS


def test_repeated_lines_go_once(spark):
    line = plain(9, 20)
    out = P.dedup_lines(spark, planted(spark, [f"{plain(1)}\n{line}", f"{line}\n{plain(2)}", line]), SF_SMALL)
    got = {r.doc_id - 10_000: r.text for r in out.where("doc_id >= 10000").collect()}
    assert got == {0: f"{plain(1)}\n{line}", 1: plain(2)} and out.columns == COLUMNS


def test_one_of_each_near_duplicate_group_stays(spark):
    copy = plain(1, 200)
    out = P.near_dedup(spark, planted(spark, [copy, copy, copy.replace("plain1x50", "other"), plain(2)]), SF_SMALL)
    assert ids(out) == {0, 3} and out.columns == COLUMNS


def test_benchmark_passages_go(spark):
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    out = P.drop_contaminated(spark, planted(spark, [f"{plain(1)} {item} {plain(2)}", plain(3), " ".join(item.split()[:5])]), SF_SMALL)
    assert ids(out) == {1, 2} and out.columns == COLUMNS


def test_mixing_reaches_its_total(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = P.mix_sources(spark, docs, SF_SMALL)
    total = docs.select(F.sum(F.size(F.split(F.btrim("text"), r"\s+")))).first()[0]
    assert abs(out.agg(F.sum("copy_words")).first()[0] - total) <= 20


def test_whole_run(spark):
    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    out = llm_queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 50 and out.columns[:5] == COLUMNS
