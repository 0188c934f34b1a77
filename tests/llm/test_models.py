"""LM scoring, HTML extraction, near-duplicates, language, toxicity and line
dedup: against brute force or held-out labels, and on awkward rows."""

import collections
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from terrascore.llm import html_extract, langid, line_dedup, linking, lm_scoring, minhash_join, toxicity
from terrascore.llm.html_blocks import blocks
from terrascore.llm.queries import llm_queries
from test_native import docs

AWKWARD = [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, "one", "a"), (4, "one", "a"), (4, "Two words", "a"), (None, "one", "a"),
           (5, "ß é x 日本", "b"), (6, "word " * 40000, "b"), (7, "x" * 5000, None)]


def table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


# ------------------------------------------------------------------ LM scoring
def kneser_ney(train, score):
    """Plain bigram model: log10 probability of each text, and of the base."""
    tok = lambda t: [b"<s>", *(t or "").encode().lower().split(), b"</s>"]
    big, uni = collections.Counter(), collections.Counter()
    for t in train:
        w = tok(t)
        uni.update(w[1:])
        big.update(zip(w, w[1:]))
    n, v = sum(uni.values()), len(uni)
    cont, ctx = collections.Counter(b for _, b in big), collections.defaultdict(list)
    for (a, _), c in big.items():
        ctx[a].append(c)

    def disc(c):
        k = collections.Counter(c.values())
        return [0.0, *lm_scoring.discounts(np.array([k[i] for i in (1, 2, 3, 4)]))]
    d2, d1 = disc(big), disc(cont)
    mass = lambda cs, d: sum(d[min(c, 3)] for c in cs)

    def p(a, b):
        q = 1 / (v + 1)
        if cont:
            t = sum(cont.values())
            q = max(cont[b] - d1[min(cont[b], 3)], 0) / t + mass(cont.values(), d1) / t * q
        if a in ctx:
            c, t = big[a, b], sum(ctx[a])
            q = max(c - d2[min(c, 3)], 0) / t + mass(ctx[a], d2) / t * q
        return q
    for t in score:
        w = tok(t)
        yield (len(w) - 1, sum(uni[b] > 0 for b in w[1:]), n, sum(math.log10((uni[b] + 0.5) / (n + 0.5 * (v + 1))) for b in w[1:]),
               sum(math.log10(p(a, b)) for a, b in zip(w, w[1:])))


def test_lm_equals_brute_force_and_probabilities_sum_to_one(spark):
    rng = random.Random(3)
    vocab = [f"v{k}" for k in range(12)]
    rows = [(i, " ".join(rng.choice(vocab[: 3 + i % 9]) for _ in range(rng.randint(0, 25))), "s") for i in range(40)]
    d = docs(spark, rows + AWKWARD)
    out = lm_scoring.score(d, lm_scoring.train(d.where(~lm_scoring.held_out()))).collect()
    train = [t for i, t, _ in rows + AWKWARD if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1]
    want = sorted(kneser_ney(train, [t for _, t, _ in rows + AWKWARD]))
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out)
    assert len(got) == len(want) and all(a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-9) for a, b in zip(got, want))
    model = lm_scoring.train(docs(spark, rows))
    words = [*vocab, "unseen"]
    texts = docs(spark, [(k, f"v1 {w}", "s") for k, w in enumerate(words)] + [(99, "v1", "s")])
    data = [10 ** r.score for r in lm_scoring.score(texts, model).orderBy("doc_id").collect()]
    assert all(0 < x < 1 for x in data)


def test_lm_third_order_without_training_rows_and_empty_table(spark):
    d = docs(spark, AWKWARD)
    tri = lm_scoring.score(d, lm_scoring.train(d, order=3)).collect()
    assert len(tri) == len(AWKWARD) and all(math.isfinite(r.score) for r in tri)
    none = lm_scoring.score(d, lm_scoring.train(d.limit(0))).collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)} and all(r.score == 0 for r in none)
    assert lm_scoring.score(d.limit(0), lm_scoring.train(d)).count() == 0


def test_registered_lm_equals_brute_force_of_three_words(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").select("doc_id", "text").collect()]
    tok = lambda t: [b"<s>", b"<s>", *bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split(), b"</s>"]
    grams, words = [None] + [collections.Counter() for _ in range(3)], collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            w = tok(t)
            words.update(w[2:])
            grams[3].update(zip(w, w[1:], w[2:]))
    for k in (2, 1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    disc, contexts = [None], [None]
    for g in grams[1:]:
        of = collections.Counter(g.values())
        disc.append([0.0, *lm_scoring.discounts(np.array([of[c] for c in (1, 2, 3, 4)]))])
        contexts.append(collections.defaultdict(list))
        for x, c in g.items():
            contexts[-1][x[:-1]].append(c)
    mass = [None] + [{h: (sum(cs), sum(disc[k][min(c, 3)] for c in cs)) for h, cs in contexts[k].items()} for k in (1, 2, 3)]

    def p(g):
        q = 1 / (len(words) + 1)
        for k in (1, 2, 3):
            x = g[3 - k:]
            if x[:-1] in mass[k]:
                total, left = mass[k][x[:-1]]
                q = max(grams[k][x] - disc[k][min(grams[k][x], 3)], 0) / total + left / total * q
        return q
    want = {i: sum(math.log10(p(g)) for w in [tok(t)] for g in zip(w, w[1:], w[2:])) for i, t in rows}
    got = {r.doc_id: r.score for r in llm_queries()["op1_lm_scoring"](spark, SF_SMALL).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_lm_looks_up_each_ngram_once(spark, monkeypatch):
    """However often a block repeats an n-gram or a context, its files are asked once."""
    d = docs(spark, [(i, f"a b c a b {'d' * (i % 3)}", "s") for i in range(30)])
    model = lm_scoring.train(d, order=3)
    tokens, at, _ = lm_scoring.token_stream(np.frombuffer(b"a b c a b d" * 1 + b" a b c" * 50, np.uint8), np.array([0, 311]), 3)
    words, places = np.unique(tokens, return_inverse=True)
    asked, real = [], lm_scoring._lookup
    monkeypatch.setattr(lm_scoring, "_lookup", lambda folder, entries, shard, keys, *a, **kw: asked.append(keys) or real(folder, entries, shard, keys, *a, **kw))
    numbers, _ = lm_scoring.word_ids(model.folder, model.first, words)
    got = lm_scoring.log_probabilities(model, numbers, places, at)
    assert len(got) == len(at) > 150 and all(len(k) == len(np.unique(k)) <= 12 for k in asked)
    assert len({(tuple(tokens[i - 2:i + 1]), p) for i, p in zip(at.tolist(), got.tolist())}) == len({tuple(tokens[i - 2:i + 1]) for i in at.tolist()})


def test_lm_deals_the_same_ngrams_by_places():
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(0, 1 << 24, 300).astype(np.uint64))
    places = [rng.integers(0, len(words), 5000).astype(np.uint64) for _ in range(3)]
    by_number = lm_scoring._dealt([words[c] for c in places], words[:2], 7)
    assert lm_scoring._dealt(places, words[:2], 7, words) == by_number


def test_lm_shards_follow_the_input(spark, monkeypatch):
    d = docs(spark, [(i, f"a b{i} c{i % 5}", "s") for i in range(20)])
    plain = [r.score for r in lm_scoring.score(d, lm_scoring.train(d)).orderBy("doc_id").collect()]
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 5)
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 10)
    model = lm_scoring.train(d)
    assert model.shards == 16 and len(model.first) - 1 == 15
    assert np.allclose([r.score for r in lm_scoring.score(d, model).orderBy("doc_id").collect()], plain, rtol=1e-9)


# ------------------------------------------------------------------ HTML
PAGE = """<!doctype html><title>T</title><header class=site-header><p>Site</header><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>
<div class="cookie-banner"><p>We use cookies.</p></div><main><article class="post"><h1>A &amp; B&nbsp;title</h1><p>First  <b>para</b>graph
here, with words enough to be one.<br>Second line of it.<p>Unclosed one &lt;tag&gt; &eacute;.<div class="ad"><p>Buy now</p></div><script>var x="<p>no</p>"</script>
<p>The last paragraph of the article.</p></article></main><section class="comments"><p>Nice post!</p><p>I agree.</p></section><aside class=sidebar><p>Related</p></aside>
<form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2024 Site</footer><!-- end"""


def test_main_text_of_a_page(spark):
    rows = [(1, "u", PAGE, 0), (2, None, None, 0), (2, "v", "", 0), (3, "w", "<p", 0), (4, "x", "<!-- <p>never ends", 0), (5, "y", "<script>a", 0),
            (6, "z", "<article>" + "<p>Again and again, words.</p>" * 3000 + "</article>", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.url): r.text for r in html_extract.extract(pages).collect()}
    assert got[1, "u"] == ("A & B title First paragraph here, with words enough to be one. Second line of it. Unclosed one <tag> é. "
                           "The last paragraph of the article.")
    assert got[2, None] == got[2, "v"] == got[4, "x"] == got[5, "y"] == "" and got[6, "z"] == " ".join(["Again and again, words."] * 3000)
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_field_on_unseen_layouts_and_exact_gradient():
    model = html_extract.train(250)
    pages = html_extract.labelled_pages(100, seed=77)
    pairs = [(y, p) for bs, ys in pages for y, p in zip(ys, model.viterbi([html_extract.features(b) for b in bs]))]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.97
    # the likelihood gradient against differences, and Viterbi against all paths
    small = html_extract.Field()
    small.weights = {"a": 0.3, "b": -0.7}
    small.trans = [[0.2, -0.1], [0.4, 0.1], [0.0, 0.5]]
    feats, y = [["a"], ["b"], ["a", "b"]], [1, 0, 1]

    def total(labels):
        s = small.trans[2][labels[0]] + sum(small.trans[i][j] for i, j in zip(labels, labels[1:]))
        return s + sum(k * v for k, v in zip(labels, small._scores(feats)))
    paths = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    assert tuple(small.viterbi(feats)) == max(paths, key=total)
    z = math.log(sum(math.exp(total(p)) for p in paths))
    g, gt = small.gradient(feats, y)
    small.weights["a"] += 1e-6
    z2 = math.log(sum(math.exp(total(p)) for p in paths))
    assert abs((g[0] + g[2]) - ((2 * 1e-6 - (z2 - z)) / 1e-6)) < 1e-4
    assert [b.text for b in blocks("a<p>b<i>c</i><script>x</script>d<li>e")] == ["a", "bcd", "e"]
    assert gt.shape == (3, 2)


def test_pages_with_omitted_end_tags(spark):
    of = lambda page: [b.text for b in blocks(page)]
    for end in ("<body>", "", "</head>", "</head><body>"):
        assert of(f"<html><head><meta charset=utf-8><title>T</title><style>a</style>{end}<h1>A</h1><p>b</html>") == ["A", "b"]
    assert of("<head><title>T</title>\n <script>x</script> text <p>b") == ["text", "b"]
    assert of("<head><noscript><p>on</p></noscript><link><body><p>b") == of("<head><noscript><link><body><p>b") == ["b"]
    assert of("a<p>b<script>x") == ["a", "b"]
    for tag in ("noscript", "svg", "object", "iframe", "template"):
        assert of(f"<div><p>a</p><{tag} x=1>no<p>b</p><p>c</p></div><p>d") == ["a", "b", "c", "d"]
        assert of(f"<div><p>a</p><{tag} x=1>no<p>no</p></{tag}><p>b</div>") == ["a", "b"]
        assert of(f"<div><{tag}>no</div>a<{tag}>no<div>b<{tag}>no<p>no</{tag}>c") == ["a", "b", "c"]
    article = "".join(f"<p>Paragraph {k} of the article, with words enough to be one.</p>" for k in range(4))
    heads = ("<head><title>T</title></head>", "<head><title>T</title>")
    pages = [(k, f"<!doctype html><html>{h}<body><nav><a href=/>Home</a></nav><article>{article}</article></body></html>") for k, h in enumerate(heads)]
    got = [r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, html string")
                                                .selectExpr("page_id", "'u' AS url", "html")).collect()]
    assert got[0] == got[1] and got[0].startswith("Paragraph 0")


def test_driver_pages_give_their_articles(spark):
    got = llm_queries()["op2_html_extraction"](spark, SF_SMALL).collect()
    assert len(got) == table(spark, "pages").count() and all(r.n_chars == len(r.text) for r in got)


# ------------------------------------------------------------------ near-duplicates
def near(texts, size, percent):
    """doc index -> least index of its component, by all pairs."""
    sets = []
    for t in texts:
        w = (t or "").encode().translate(bytes((c + 32 if 65 <= c <= 90 else c) for c in range(256))).split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    comp = list(range(len(texts)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if k and 100 * k >= percent * (len(a) + len(sets[j]) - k):
                x, y = find(i), find(j)
                comp[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], sets


def variants(seed, n, length, most):
    """A text and copies of it with a few words changed each."""
    rng = random.Random(seed)
    base = [f"b{rng.randint(0, 10 ** 6)}" for _ in range(length)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(length)] = f"c{rng.randint(0, 10 ** 6)}"
        yield " ".join(w)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, size, percent):
    texts = [t for s in range(6) for t in variants(s, 25, 60 + 20 * s, 8)] + ["one", "one", "ONE", "one two", None, "", " \t"]
    want, sets = near(texts, size, percent)
    got = {r.doc_id: r for r in minhash_join.near_duplicates(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), size=size, percent=percent).collect()}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(got[i].kept == (want[i] == i) for i in range(len(texts)))


def test_near_duplicate_edges(spark):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(docs(spark, AWKWARD)).collect()]
    by = collections.defaultdict(list)
    for i, n, c, k in got:
        by[i].append((n, c, k))
    assert len(got) == len(AWKWARD)
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert sorted(by[4]) == [(1, 4, True)] * 3 and by[None] == [(1, 4, False)]
    kept = minhash_join.keep_one(docs(spark, AWKWARD))
    assert kept.columns == docs(spark, AWKWARD).columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        {repr((i, t)) for i, t, _ in AWKWARD if i is not None})
    assert minhash_join.near_duplicates(docs(spark, AWKWARD).limit(0)).count() == 0


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i + 1, i) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 90)] + [(5, 4), (4, 5), (2000, 2000)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.comp for r in linking.components(links).collect()}
    assert got == {r.node: r.comp for r in linking.components(links, per_task=25).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + k] == 1000 for k in range(90)) and 2000 not in got
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ lines
def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    lines = [f"{'abcdefgh'[k % 8] * 3} " + " ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.randint(1, 25))) for k in range(60)]
    fuzzy = [x[:len(x) // 2] + "Q" + x[len(x) // 2 + 1:] for x in lines]
    texts = ["\n".join(rng.choice(rng.choice((lines, fuzzy, ["", "  ", "tiny"]))) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    sh = lambda x: {x[k:k + 9] for k in range(len(x) - 8)} or {x}
    real = sorted({x for t in texts for x in t.split("\n") if x.strip()})
    comp = {x: x for x in real}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, a in enumerate(real):
        for b in real[:i]:
            k = len(sh(a) & sh(b))
            if 100 * k >= 80 * len(sh(a) | sh(b)):
                comp[find(a)] = find(b)
    seen, gone = set(), collections.defaultdict(list)
    for i, t, _ in rows:
        for k, x in enumerate(t.split("\n")):
            if x.strip():
                if find(x) in seen:
                    gone[i].append(k)
                seen.add(find(x))
    got = {r.doc_id: r.removed for r in line_dedup.report(docs(spark, rows)).collect()}
    assert got == {i: gone[i] for i, _, _ in rows}
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    for i, t, _ in rows:
        left = [x for k, x in enumerate(t.split("\n")) if k not in gone[i]]
        if gone[i] and not any(x.strip() for x in left):
            assert i not in out
        else:
            assert out[i] == "\n".join(left)


def test_line_length_from_which_one_edit_is_found():
    def similar(n):
        a = bytes(np.random.default_rng(n).integers(97, 123, n, np.uint8))
        both = np.frombuffer(a + a[:n // 2] + b"Q" + a[n // 2 + 1:], np.uint8)
        sets = line_dedup.line_sets(both, np.array([0, n]), np.array([n, 2 * n]))
        return line_dedup.similar_lines(*sets, np.array([0]), np.array([1]), line_dedup.PERCENT)[0]
    assert not similar(60) and not similar(88) and similar(89)


def test_line_shingles_count_characters_not_bytes():
    lines = ["héllo wörld", "a" * 30, "日本語のテキストです", "né", "𝒳𝒴𝒵 plain 𝒳𝒴𝒵", "a" * 12 + "é", "éèêë" * 8]
    data = np.frombuffer("\n".join(lines).encode(), np.uint8)
    begin, end = line_dedup.line_spans(data, np.array([0, len(data)]))
    _, n = line_dedup.shingle_hashes(data, begin, end)
    assert n.tolist() == [max(len(x) - 8, 1) for x in lines]
    line, _ = line_dedup.line_sets(data, begin, end)
    assert np.bincount(line).tolist() == [len({x[k:k + 9] for k in range(len(x) - 8)} or {x}) for x in lines]
    one = np.frombuffer(lines[1].encode(), np.uint8)  # alike in a chunk that is all ASCII
    h, _ = line_dedup.shingle_hashes(data, begin, end)
    assert (line_dedup.shingle_hashes(one, np.array([0]), np.array([30]))[0] == h[sum(n[:1]):sum(n[:2])]).all()


def test_a_frequent_band_is_spread_over_the_shards():
    shards, rng = 16, np.random.default_rng(1)
    hot, parts = np.uint64(77), []
    for k in range(6):  # six tasks; in the last, one line with the hot band
        n = 4000 if k < 5 else 1
        t = np.concatenate([np.full(n, hot), rng.integers(1000, 9000, 3000, np.uint64)])
        parts.append((t, rng.integers(0, 1 << 62, len(t), np.uint64)))
    rows = pa.Table.from_batches([line_dedup.dealt(t, k, shards) for t, k in parts])
    size = collections.Counter()
    got = set()
    for s in range(shards):
        part = rows.filter(pa.compute.equal(rows["shard"], s))
        size[s] = sum(len(x) // 8 for x in part["keys"].to_pylist())
        got |= set(zip(*[part_.to_pylist() for part_ in line_dedup.shared_pairs(part).columns]))
    pairs = {(int(a), int(b)) for t, k in parts for a, b in zip(t, k)}
    keys = collections.Counter(a for a, _ in pairs)
    assert got == {(a, b) for a, b in pairs if keys[a] > 1}
    assert max(size.values()) < 1.5 * sum(size.values()) / shards


def test_line_work_stays_in_small_blocks():
    """Signatures and exact sets take memory for a block of lines, not for all of them."""
    rng = np.random.default_rng(3)
    lines = [bytes(rng.integers(97, 123, n, np.uint8)).decode() for n in rng.integers(1, 600, 4000)]
    lines[7], lines[9], lines[11] = "é" * 300, "ab", "x" * 100_000
    data = np.frombuffer("\n".join(lines).encode(), np.uint8)
    begin, end = line_dedup.line_spans(data, np.array([0, len(data)]))
    want = line_dedup.band_hashes(*line_dedup.shingle_hashes(data, begin, end))
    tracemalloc.start()
    got = line_dedup.signatures(data, begin, end)
    assert tracemalloc.get_traced_memory()[1] < 10 << 20 and (got == want).all()
    node, other = pa.array(range(len(lines))), pa.array(range(len(lines), 2 * len(lines)))
    pairs = pa.RecordBatch.from_arrays([node, other, pa.array(lines), pa.array(lines[1:] + lines[:1])], ["a", "b", "x", "y"])
    tracemalloc.reset_peak()
    kept = [r for b in line_dedup._similar(80)([pairs]) for r in b.column(0).to_pylist()]
    assert tracemalloc.get_traced_memory()[1] < 30 << 20 and kept == []
    tracemalloc.stop()
    alike = pa.RecordBatch.from_arrays([node, other, pa.array(lines), pa.array(lines)], ["a", "b", "x", "y"])
    assert sum(b.num_rows for b in line_dedup._similar(80)([alike])) == len(lines)


def test_line_batches_are_bounded_in_bytes(spark, monkeypatch):
    """Of long texts, fewer go to Python at once than Spark would hand over."""
    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key, None)

    def watched(docs, *_):
        sizes = docs.select("text").mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in bs), "n long")
        most.append(max(r.n for r in sizes.collect()))
        return docs.sparkSession.createDataFrame([], "node long, comp long")
    monkeypatch.setattr(line_dedup, "line_components", watched)
    long = docs(spark, [(k, "word " * 20_000, "a") for k in range(300)]).coalesce(1)
    line_dedup.removals(long)
    watched(long)
    assert most[0] < 10 << 20 < most[1] and spark.conf.get(key, None) == before


def test_toxic_rows_of_several_slices(spark):
    """Over the ends of slices, the same rows stay as are judged in ``score``."""
    d = docs(spark, [(k, f"plain text {k} " * (k % 7), "a") for k in range(1500)]).coalesce(1)
    chain = toxicity.train(table(spark, "documents"), table(spark, "labels"))
    want = {r.doc_id for r in toxicity.score(d, chain).where("not toxic").collect()}
    assert sorted(r.doc_id for r in toxicity.drop_toxic(d, chain).collect()) == sorted(want)


def test_line_edges(spark):
    out = line_dedup.dedup_lines(docs(spark, AWKWARD))
    assert out.columns == docs(spark, AWKWARD).columns
    got = sorted(map(repr, ((r.doc_id, r.text) for r in out.collect())))
    # the null id is first, so its line stays and the equal rows of id 4 lose theirs
    assert got == sorted(repr((i, t)) for i, t, _ in AWKWARD if not (i == 4 and t == "one"))
    assert line_dedup.dedup_lines(docs(spark, AWKWARD).limit(0)).count() == 0
    twice = docs(spark, [(1, "same row", "a"), (1, "same row", "a")])
    assert line_dedup.dedup_lines(twice).count() == 1


# ------------------------------------------------------------------ language
def test_language_of_held_out_rows(spark):
    d = table(spark, "documents")
    held = langid.held_out()
    out = langid.identify(d, langid.train(d, ~held, steps=250)).join(d.select("doc_id", "lang", held.alias("held")), "doc_id").where("held").collect()
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.9 and all(0 <= r.score <= 1 for r in out)


def test_gru_gradient_and_edges(spark):
    net = langid.Network(["a", "b"], seed=1)
    x = np.random.default_rng(0).integers(97, 103, (5, 3))
    y = np.array([0, 1, 1])
    _, grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = float(p[at])
        losses = []
        for e in (1e-2, -1e-2):
            p[at] = old + e
            losses.append(net.gradients(x, y)[0])
        p[at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - g[at]) < 2e-2 * max(1, abs(g[at])) + 1e-3
    rows = docs(spark, AWKWARD + [(8, "123 !?", "a")])
    got = collections.defaultdict(list)
    for r in langid.identify(rows, net).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    assert got[1] == got[2] == got[3] == got[8] == [("und", 0.0)] and got[5][0][0] in ("a", "b")
    assert langid.train(rows, F.lit(True)) is None and langid.identify(rows, None).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(rows.limit(0), net).count() == 0
    best, score = net.predict(pa.array(["ab" * 4000]))
    assert best[0] in (0, 1) and 0 < score[0] <= 1


# ------------------------------------------------------------------ toxicity
def test_toxicity_on_unseen_documents(spark):
    """Learned from two thirds of the larger table's labels, told on the rest."""
    folder = SF_SMALL.replace("0.001", "0.1")
    d, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    chain = toxicity.train(d, labels.where("doc_id % 3 <> 0"))
    d = d.join(labels.where("doc_id % 3 = 0").select("doc_id"), "doc_id", "left_semi")
    out = toxicity.score(d, chain).join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    hit = sum(r.toxic and r.y == 1 for r in out)
    assert hit / sum(r.y == 1 for r in out) > 0.8 and hit / max(sum(r.toxic for r in out), 1) > 0.9
    assert chain.categories == ("quality", "toxic") and {"p_quality", "p_toxic"} <= set(out[0].asDict())
    kept = toxicity.drop_toxic(d, chain)
    assert kept.columns == d.columns and kept.count() == d.count() - toxicity.score(d, chain).where("toxic").count()


def test_toxicity_edges(spark):
    rows = docs(spark, AWKWARD)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    chain = toxicity.train(rows, labels)
    got = toxicity.score(rows, chain).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.p_toxic <= 1 for r in got)
    none = toxicity.train(rows, labels.limit(0))
    assert toxicity.score(rows, none).where("toxic").count() == 0
    assert toxicity.score(rows.limit(0), chain).count() == 0 and toxicity.drop_toxic(rows.limit(0), chain).count() == 0


def test_toxicity_features_are_chosen_as_by_plain_counts(spark):
    """Counting and ranking in Spark against the same over one matrix here."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.3)
        picked = [w for k, w in enumerate(words) if rng.random() < (0.5 if k < 5 and y else 0.15)]
        rows.append((i, " ".join(picked), y, int(rng.random() < 0.5)))
    sample = spark.createDataFrame(rows, "id long, body string, y0 int, y1 int").repartition(3)
    counts = toxicity.feature_counts(sample, ("toxic", "quality"))
    seen = {r.feature: tuple(r)[1:] for r in counts.collect()}
    want = collections.defaultdict(lambda: [0, 0, 0, 0])
    for _, text, y, q in rows:
        _, feats, _ = toxicity.text_features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        for f in {*feats.tolist(), -1}:
            want[f][y] += 1
            want[f][2 + q] += 1
    assert seen == {f: tuple(v) for f, v in want.items()}
    pos, neg = want[-1][1], want[-1][0]
    z = {}
    for f, (n0, n1, _, _) in want.items():
        both = (n0 + n1) / (pos + neg)
        if f >= 0 and n0 + n1 >= 3:
            z[f] = abs((n1 / pos - n0 / neg) / np.sqrt(both * (1 - both) * (1 / pos + 1 / neg) + 1e-12))
    best = sorted((f for f in z if z[f] > 3), key=lambda f: (-z[f], f))[:7]
    assert toxicity.select_features(counts, ("toxic",), 7).tolist() == sorted(best) and len(best) >= 5


def test_chain_is_fitted_in_a_task(spark, monkeypatch):
    """The sample's matrix does not come to the driver, and the weights are those of a fit here."""
    rows = [(i, f"some plain words {i} " + ("vile slur" if i % 3 == 0 else "kind text")) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")

    def refused(*_):
        raise AssertionError("on the driver")
    with monkeypatch.context() as m:
        m.setattr(toxicity, "fit_linear", refused)
        m.setattr(type(d), "toArrow", refused)
        chain, again = toxicity.train(d, labels), toxicity.train(d, labels)  # twice in the same workers
    plain = toxicity.Chain(chain.slot, chain.n_columns, chain.categories, [])
    x = plain.matrix(pa.array([t for _, t in rows]))
    toxicity.fit_chain(plain, x, [np.array([i % 3 > 0 for i, _ in rows]), np.array([i % 3 == 0 for i, _ in rows])])
    assert chain.n_columns > 3 and len(chain.models) == 2
    assert all(a.dtype == b.dtype and np.allclose(a, b, rtol=1e-4, atol=1e-5) for a, b in zip(chain.models, plain.models))
    assert len(again.models) == 2 and all((a == b).all() for a, b in zip(chain.models, again.models))


def test_chain_learns_from_out_of_fold_estimates():
    """The second model's input is the first one's estimates on rows it has not seen."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)).astype(np.float32)
    y = [x[:, 0] > 0, x[:, 0] + x[:, 1] > 0]
    chain = toxicity.fit_chain(toxicity.Chain(np.zeros(1), 2, ("a", "b"), []), x, y, folds=4)
    fold, est = np.arange(200) % 4, np.zeros(200, np.float32)
    for k in range(4):
        w = toxicity.fit_linear(x[fold != k], y[0][fold != k].astype(np.float32))
        p = 1 / (1 + np.exp(-np.clip(x[fold == k] @ w[:-1].astype(np.float32) + w[-1], -30, 30)))
        est[fold == k] = np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    second = toxicity.fit_linear(np.column_stack([x, est]), y[1].astype(np.float32)).astype(np.float32)
    assert np.allclose(chain.models[1], second) and len(chain.models[0]) == 4 and len(chain.models[1]) == 5


# ------------------------------------------------------- files of the language model
def test_model_files_give_back_what_was_filed(tmp_path):
    rng = np.random.default_rng(0)
    close = (np.uint64(77) << np.uint64(32)) + (np.arange(50, dtype=np.uint64) << np.uint64(20))  # equal upper halves
    for wide in (False, True):
        keys = np.unique(np.concatenate([rng.integers(0, 2**64, 20000, dtype=np.uint64), close]))
        values = np.where(rng.random(len(keys)) < 0.01, rng.integers(250, 10**12, len(keys)), rng.integers(0, 256, len(keys)))
        lm_scoring._save(f"{tmp_path}/{wide}", "hash-00000", lm_scoring._key_bytes(keys, wide))
        lm_scoring._save(f"{tmp_path}/{wide}", "count-00000", lm_scoring._value_bytes(values))
        asked = rng.permutation(np.concatenate([keys, keys[:50], rng.integers(0, 2**64, 9000, dtype=np.uint64)]))
        got, = lm_scoring._lookup(f"{tmp_path}/{wide}", np.array([len(keys)]), np.zeros(len(asked), int), asked, ["count"], wide)
        known = dict(zip(keys.tolist(), values.tolist()))
        assert got.tolist() == [known.get(k, 0) for k in asked.tolist()]


def test_sums_and_orders_of_ngrams():
    rng = np.random.default_rng(1)
    for top in (9, 2**40):  # one number holds an n-gram, or it does not
        columns = [rng.integers(0, 9, 500, dtype=np.uint64) * np.uint64(top // 9) for _ in range(3)]
        want = sorted(collections.Counter(zip(*[c.tolist() for c in columns])).items())
        for counts in (None, np.ones(500, np.int64)):
            got, total = lm_scoring.sum_grams(columns, counts)
            assert list(zip(zip(*[c.tolist() for c in got]), total.tolist())) == want
    assert [len(x) for x in lm_scoring.sum_grams([np.zeros(0, np.uint64)] * 2)[0]] == [0, 0]
    gram = np.unique(rng.integers(0, 2**48, 3000, dtype=np.uint64)) << np.uint64(16)
    gram = rng.permutation(gram)
    counts = rng.choice([1, 2, 65534, 65535, 65536, 10**12], len(gram))
    hashes, ordered = lm_scoring.by_hash(gram, counts)
    assert list(zip(hashes.tolist(), ordered.tolist())) == sorted(zip(gram.tolist(), counts.tolist()))


def test_lost_model_files_are_an_error(spark, tmp_path):
    import shutil
    from pathlib import Path
    rows = docs(spark, [(i, f"alpha beta gamma w{i}", "s") for i in range(20)])
    model = lm_scoring.train(rows, order=2)
    assert lm_scoring.score(rows, model).count() == 20
    folder = Path(model.folder)
    for part in ("words", "grams2", "contexts2"):
        victim = max(folder.glob(f"{part}/hash-*"), key=lambda p: p.stat().st_size)
        whole = victim.read_bytes()
        victim.write_bytes(whole[:-8])
        with pytest.raises(Exception, match="holds|incomplete"):
            lm_scoring.score(rows, model).collect()
        victim.unlink()
        with pytest.raises(Exception, match="missing"):
            lm_scoring.score(rows, model).collect()
        victim.write_bytes(whole)
    assert lm_scoring.score(rows, model).where("n_known > 0").count() == 20


# ------------------------------------------------------------------ deep pages
def test_deeply_nested_pages_stay_small():
    import tracemalloc
    import time
    model = html_extract.train(40, 2)
    known = html_extract.known_features(model)
    n = 64_000
    pages = ["".join(f"<div class=c{i}>a{i} " for i in range(n)), "<div>x</span>" * n, "".join(f"<t{i}>a " for i in range(n)), "<p>x</b></i></div>" * n]
    for page in pages:
        t = time.time()
        blocks(page, known)
        assert time.time() - t < 20
    tracemalloc.start()
    bs = blocks(pages[0], known)
    assert len(bs) == n and tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    some = "<div class='menu c1'><section id=article><p>one two</p><ul><li><a href=x>three</a></ul></section></div><footer>f</footer>"
    assert html_extract.main_text(some, model, known) == html_extract.main_text(some, model)
