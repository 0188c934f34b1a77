"""URL filter, decontamination, mixing and quality rules: against SQL, against
brute force, and on awkward rows."""

import collections
import re

import pytest
from conftest import SF_SMALL
from harness import compare, duck_connect
from pyspark.sql import functions as F

from terrascore.llm import decontaminate, mixing, quality_lines, url_filter
from terrascore.llm.queries import llm_queries, llm_sql

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASH = "words int, row int, src int, size int, hash int, keys int, item int, h int, cut int, lines int, host int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows, clash=True):
    """(doc_id, text, source) rows as a documents table with clashing columns."""
    n = len(CLASH.split(",")) if clash else 0
    return spark.createDataFrame([(i, t, None, s, None, *([7] * n)) for i, t, s in rows], f"{DOC}, {CLASH}" if clash else DOC)


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_its_sql(spark, name):
    rep = compare(llm_queries()[name](spark, SF_SMALL), llm_sql()[name], duck_connect(SF_SMALL), tol=1e-9)
    assert rep["ok"], rep


def test_rules_and_hosts(spark):
    urls = ["https://WWW.Example.com/en/1", "http://a.example.com/en/x", "http://example.com/EN/x", "https://b.net/es/1?x#y",
            "https://b.net?q=/es/", "https://xnet/es/1", "no scheme", None, "http://h#f/en/", "ftp://example.org:80/en/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(pages).collect()}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/"), 1: ("a.example.com", "/en/x", "example.com/en/"),
        2: ("example.com", "/EN/x", "com/"), 3: ("b.net", "/es/1", "net/es/"), 4: ("b.net", "", None),
        5: ("xnet", "/es/1", None), 6: ("", "", None), 7: ("", "", None), 8: ("h", "", None), 9: ("example.org:80", "/en/", None)}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_model_learns_its_table_and_scores_like_plain_python(spark):
    table = url_filter.labelled_urls(spark)
    weights = url_filter.train(table)
    rows = table.collect()
    pages = spark.createDataFrame([(i, r.url) for i, r in enumerate(rows)], "page_id long, url string")
    p = {r.page_id: r.bad_probability for r in url_filter.judge(pages, weights=weights).collect()}
    assert sum((p[i] > 0.5) == (r.label == 1) for i, r in enumerate(rows)) / len(rows) > 0.95
    unseen = spark.createDataFrame([(0, "http://www.cheap-pills.example.org/en/9"), (1, "http://mountain.example.org/en/9")],
                                   "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(unseen, weights=weights).collect()} == {0: "block", 1: "allow"}
    real = ["http://www.online-casinos.co/start", "https://bestpokerbonus.ru/join", "http://freeporncams.tv/", "http://replicawatch.shop/en/3",
            "https://www.nationalgallery.org.uk/visiting", "https://docs.python.org/3/library/os.html",
            "https://cooking.stackexchange.com/questions/12/how-long", "http://www.thehistoryofscience.ca/en/3", "https://ruralhealth.gov.au/fr/3"]
    pages = spark.createDataFrame(list(enumerate(real)), "page_id long, url string")
    got = {r.page_id: r.bad_probability > 0.5 for r in url_filter.judge(pages, weights=weights).collect()}
    assert got == {i: i < 4 for i in range(len(real))}


def test_url_table_is_not_made_of_the_given_pages(spark):
    given = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select(url_filter.host_and_path(F.col("url"))[0].alias("h"))
    names = {p for r in given.distinct().collect() for p in r.h.split(".")[:-2]} - {"www", "m", "blog"}
    made = url_filter.labelled_urls(spark).select(url_filter.host_and_path(F.col("url"))[0].alias("h"))
    assert not names & {p for r in made.distinct().collect() for p in r.h.split(".")}


def test_decontamination_brute_force_and_edges(spark):
    w = [f"w{k}" for k in range(40)]
    items = [(1, " ".join(w[:12])), (2, "Short Item"), (3, None), (4, " ,. "), (5, "w3 " * 10), (1, " ".join(w[20:31]))]
    texts = [(1, "x " + " ".join(w[1:11]).upper() + ", y", "a"), (2, "a short-item b", "a"), (3, None, None), (4, "", "b"),
             (5, "w3 " * 25, "a"), (6, " ".join(w[:9]), "a"), (7, "w1", "a"), (7, " ".join(w), "a"), (7, " ".join(w), "a"),
             (None, "short item short item", "a"), (8, "filler " * 30000 + " ".join(w[20:31]), "a")]
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))

    def expected(text):
        d, hit, ids = word(text), set(), set()
        for i, t in items:
            b = word(t)
            k = min(len(b), 10)
            for a in range(max(len(b) - 9, 1) if b else 0):
                for s in range(len(d) - k + 1):
                    if d[s:s + k] == b[a:a + k]:
                        hit |= set(range(s, s + k))
                        ids.add(str(i))
        return len(d), len(hit), tuple(sorted(ids))
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, words int")
    got = decontaminate.decontaminate(docs(spark, texts), bench).collect()
    want = [(i, *expected(t)) for i, t, _ in texts]
    assert sorted(map(repr, ((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got))) == sorted(map(repr, want))
    kept = decontaminate.drop_contaminated(docs(spark, texts), bench)
    assert kept.columns == docs(spark, texts).columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, t, _ in texts if not expected(t)[1])
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs(spark, texts), empty).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs(spark, texts).limit(0), bench).count() == 0


def test_mixing_targets_shares_and_repetitions(spark):
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(300)] + [(1000 + i, "a b c", "mid") for i in range(9)]
    rows += [(2000, "x", "tiny"), (2001, None, "tiny"), (2002, "  ", None), (None, "q r", None), (None, "q r", None), (5, "w w", "big")]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(lambda: [0, 0, None])
    for r in got:
        by[r.source][0] += r["size"]
        by[r.source][1] += r.taken
        by[r.source][2] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    total = sum(v[0] for v in by.values())
    assert abs(sum(v[2] for v in by.values()) - total) < 1e-6 and by["mid"][2] == 3 * 27 and by["tiny"][2] == 3
    for size, taken, target in by.values():
        assert abs(taken - target) <= 3
    assert sorted(map(repr, mixing.mix(docs(spark, rows)).collect())) == sorted(map(repr, got))
    copies = mixing.materialise(docs(spark, rows))
    assert copies.columns == [*docs(spark, rows).columns, "copy_no", "copy_words"]
    assert copies.agg({"copy_words": "sum"}).first()[0] == sum(r.taken for r in got)
    assert mixing.mix(docs(spark, rows).limit(0)).count() == 0
    assert mixing.mix(docs(spark, [(1, None, None), (2, "", "a")])).where("taken > 0 or target > 0").count() == 0


def test_quality_rules_brute_force_and_edges(spark):
    common = "this line stands in very many documents of one host 17"
    rows = [(i, f"only here {i} {'abcdefghij'[i % 10]} some more words that are of document {i} alone ok\n{common}", "h") for i in range(30)]
    rows += [(100 + i, f"{common}\n\n {common.upper()} \nword{i}", "h") for i in range(3)] + [(200, common + "\nand ten more words that are here to stay in it", "other")]
    rows += [(300, None, None), (301, "", "h"), (302, "# $ %\n# $ %\n" * 4, "h"), (303, "a b c d e f " * 9, "h"), (303, "a b c d e f " * 9, "h"), (304, "long " * 50000, "h")]
    got = quality_lines.judge(docs(spark, rows)).collect()
    assert len(got) == len(rows)

    def base(t):
        w = WORDS.findall(t or "")
        at = collections.defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i:i + 5])].append(i)
        rep = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep)
    want = sorted(((i, *base(t)) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == want
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(30)) and kept[200] and not any(kept[i] for i in (100, 101, 102, 300, 301, 302, 303, 304))
    out = {r.doc_id: r.text for r in quality_lines.clean(docs(spark, rows)).collect()}
    assert set(out) == {i for i, k in kept.items() if k} and common not in out[3] and common in out[200]
    assert quality_lines.judge(docs(spark, rows).limit(0)).count() == 0


def test_different_windows_of_a_long_text_are_not_equal(spark):
    # 2 million different words: no window stands twice
    long = spark.range(1).selectExpr("transform(sequence(1L, 2000000L), i -> xxhash64(i)) AS hashes", "2000000L AS n").persist()
    keys = long.withColumn("keys", quality_lines.window_keys("hashes", "n")).persist()
    assert keys.select(quality_lines.repeated_starts("keys", "n").alias("s")).selectExpr("size(s)").first()[0] == 0
    keys.unpersist()
    long.unpersist()


def test_copies_count_in_a_lines_frequency(spark):
    """Forty documents of one host share a line, and the same text: the line is in
    forty documents. Elsewhere the same line is rare."""
    body = "this very line stands in every page of the host\nand nothing else is there"
    rows = docs(spark, [(i, body, "a") for i in range(40)] + [(100 + i, body, "b") for i in range(quality_lines.MAX_DOCS)])
    got = {r.doc_id: (r.boilerplate_words, r.kept) for r in quality_lines.judge(rows).collect()}
    assert all(got[i] == (15, False) for i in range(40)) and all(got[100 + i] == (0, True) for i in range(quality_lines.MAX_DOCS))


def test_decontamination_by_shuffle_equals_broadcast(spark, monkeypatch):
    folder = SF_SMALL
    d, b = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    def result():
        return sorted(map(tuple, decontaminate.digest(decontaminate.decontaminate(d, b)).collect()))
    want = result()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result() == want and any(r[2] for r in want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
