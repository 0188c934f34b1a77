"""URL filter: host and path rules, then a logistic regression over hashed
character n-grams of host and path (op 5), native.

The model is trained from a small labelled URL table. Its rows, turned into
feature postings, make one row of a DataFrame, over which full-batch gradient
descent runs as one ``aggregate`` expression; the result is an array of
``dims`` weights, a fixed size at any scale, which scoring takes as a literal.

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule and the model's verdict on empty strings; equal urls get equal
verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascore.llm.common import LOWER, UPPER

#: (verdict, host, path): a rule fits its host and all subdomains, where the
#: url's path starts with the rule's. The longest fitting rule wins.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
DIMS = 2048
GRAMS = (3, 4)
EPOCHS = 200
RATE = 4.0
DECAY = 1e-4
#: The labelled table is small by definition; a larger one is refused.
MAX_TRAINING_URLS = 5000

#: Labelled urls are made from these parts: words that unwanted sites are named
#: after and words of ordinary sites, neither taken from any given table. Prefixes
#: and ends are dealt alike to both, so they say nothing about the label.
BAD_WORDS = ("cheap", "pills", "casino", "bonus", "free", "bets", "viagra", "discount", "payday", "loans", "replica",
             "watches", "porn", "cams", "warez", "torrent", "keygen", "crack", "jackpot", "slots", "escort", "spam",
             "lottery", "poker")
BAD_PATHS = ("/buy-now/discount-pills", "/win/free-casino-bonus", "/download/keygen-crack.exe", "/xxx/live-cams",
             "/offer?aff=1", "/en/12", "/de/845.html", "/")
GOOD_WORDS = ("university", "library", "nation", "weather", "museum", "mother", "travel", "recipes", "gardening", "council",
              "history", "mountain", "science", "theatre", "painting", "northern", "stations", "reading", "athens",
              "interest", "notable", "thinking", "engines", "another", "festival", "county", "school", "hospital",
              "archive", "journal", "music", "theory", "health", "village", "island", "river", "table", "others",
              "strength", "research")
GOOD_PATHS = ("/articles/history-of-printing", "/en/12", "/about.html", "/fr/845", "/2021/05/report.pdf",
              "/guide/chapter-2/", "/es/77/", "/de/845.html", "/questions/tagged/sorting", "/")
PREFIXES = ("", "www.", "m.", "blog.", "shop.")
ENDS = ("com", "org", "net", "info", "co.uk", "de", "fr", "io", "eu", "biz", "us")


def site_names(words: tuple[str, ...], partners: tuple[tuple[str, int], ...]) -> list[str]:
    """Hosts: each word joined by a mark with the word so many places on (0:
    the word alone), with prefixes and ends in turn."""
    names = [w + mark + words[(i + k) % len(words)] if k else w for mark, k in partners for i, w in enumerate(words)]
    return [f"{PREFIXES[i % len(PREFIXES)]}{n}.{ENDS[i % len(ENDS)]}" for i, n in enumerate(names)]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table (url, label: 1 is bad), made from the parts above."""
    part = lambda xs: F.explode(F.array(*[F.lit(x) for x in xs]))
    def urls(hosts, paths, label):
        return (spark.range(1).select(part(hosts).alias("h")).select("h", part(paths).alias("p"))
                .select(F.concat(F.lit("https://"), "h", "p").alias("url"), F.lit(label).alias("label")))
    return (urls(site_names(BAD_WORDS, (("-", 5), ("", 11))), BAD_PATHS, 1.0)
            .unionByName(urls(site_names(GOOD_WORDS, (("", 0),)), GOOD_PATHS, 0.0)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The winning rule's text and verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    fits = [(host == h) | F.endswith(host, F.lit(f".{h}")) for _, h, _ in ordered]
    fits = [f & F.startswith(path, F.lit(p)) for f, (_, _, p) in zip(fits, ordered)]
    text = F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ordered)], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ordered)],
                         F.lit(None).cast("string"))
    return text, verdict


def grams(host: Column, path: Column, dims: int = DIMS) -> Column:
    """Distinct hashed character n-grams of ``^host$`` and of the path."""
    def of(s, mark, n):
        return F.when(F.length(s) >= n, F.transform(
            F.sequence(F.lit(1), F.length(s) - n + 1),
            lambda i: F.pmod(F.xxhash64(F.lit(mark), F.substr(s, i, F.lit(n))), F.lit(dims)).cast("int"))
        ).otherwise(F.array().cast("array<int>"))
    h = F.concat(F.lit("^"), host, F.lit("$"))
    return F.array_distinct(F.concat(*[of(h, "h", n) for n in GRAMS], *[of(path, "p", n) for n in GRAMS]))


def train(labelled: DataFrame, dims: int = DIMS, epochs: int = EPOCHS) -> list[float]:
    """``dims`` weights and a bias (the last value) from (url, label) rows."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.select("url", "label", host.alias("h"), path.alias("p"))
    rows = rows.select("url", "label", grams(F.col("h"), F.col("p"), dims).alias("g")).where("size(g) > 0")
    n = rows.count()
    if not 0 < n <= MAX_TRAINING_URLS:
        raise ValueError(f"the labelled url table has {n} usable rows; 1 to {MAX_TRAINING_URLS} are expected")
    packed = rows.select(F.struct("url", "label", "g").alias("x")).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    # by feature: the numbers of the urls that have it
    packed = packed.select("xs", F.expr("transform(xs, x -> 1D / sqrt(size(x.g)))").alias("norm"))
    by_feature = (packed.select(F.posexplode("xs").alias("k", "x")).select("k", F.explode("x.g").alias("f"))
                  .groupBy("f").agg(F.sort_array(F.collect_list("k")).alias("ks"))
                  .agg(F.map_from_entries(F.collect_list(F.struct("f", "ks"))).alias("posts")))
    one = packed.join(F.broadcast(by_feature), F.lit(True))  # one row with one row
    one = one.select("xs", "norm", F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda f: F.coalesce(
        F.element_at("posts", f), F.array().cast("array<int>"))).alias("posts"))
    step = f"""
        aggregate(sequence(1, {epochs}), transform(sequence(0, {dims}), j -> 0D), (w, epoch) ->
          transform(array(transform(xs, (x, k) -> x.label - 1D / (1D + exp(-(get(w, {dims})
              + norm[k] * aggregate(x.g, 0D, (s, f) -> s + get(w, f))))))), err ->
            concat(transform(posts, (ks, f) -> get(w, f) * (1D - {RATE * DECAY})
                + {RATE} * aggregate(ks, 0D, (s, k) -> s + get(err, k) * get(norm, k)) / {n}),
              array(get(w, {dims}) + {RATE} * aggregate(err, 0D, (s, e) -> s + e) / {n})))[0])"""
    return list(one.select(F.expr(step).alias("w")).first()["w"])


def probability(host: Column, path: Column, weights: list[float]) -> Column:
    dims = len(weights) - 1
    table = F.lit([float(w) for w in weights[:-1]])
    g = grams(host, path, dims)
    total = F.aggregate(g, F.lit(0.0), lambda s, f: s + F.get(table, f))
    z = F.lit(float(weights[-1])) + total / F.sqrt(F.greatest(F.size(g), F.lit(1)))
    return 1.0 / (1.0 + F.exp(-z))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          weights: list[float] | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (null if none fits),
    ``verdict`` (the rule's, else the model's) and ``bad_probability``."""
    weights = weights or train(labelled_urls(pages.sparkSession))
    host, path = host_and_path(F.col(url_col))
    p = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    p = p.select("*", rule.alias("rule"), verdict.alias("by_rule"),
                 probability(F.col("host"), F.col("path"), weights).alias("bad_probability"))
    by_model = F.when(F.col("bad_probability") >= threshold, "block").otherwise("allow")
    return p.select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("by_rule", by_model).alias("verdict"), "bad_probability")
