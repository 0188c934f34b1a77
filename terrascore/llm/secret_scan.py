"""Secret scan (op 12): base rules and character Markov models, built-in functions only.

Two first-order character models, one of random strings and one of ordinary
identifiers, are counted from labelled samples. A token's log-likelihood ratio
sums, over its neighbouring characters, how much likelier the random model finds
the second after the first. Tokens of ``MIN_TOKEN`` characters or more whose
ratio reaches ``MIN_RATIO`` are spans of kind ``markov``, beside those of the
base rules; a token inside a base span is not told twice.

A span's place follows from the lengths of the pieces between matches, added up
in chunks, so a text with very many matches costs time in proportion to them.

The model is one number per pair of characters, whatever the samples' number,
and stands in the plan as a constant; texts are read once and nothing is shuffled.

Defined results: a null text is empty and has no spans; ids may be null or equal,
each row is judged by itself; very long texts and tokens are scanned whole; other
columns are ignored, whatever their names; an empty table gives no rows. Without
samples of one kind that model is uniform.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The base rules, in the order that breaks ties, and their least lengths.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a match is a whole run, so the least length may stand in the pattern
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Runs of these characters are the model's tokens.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_TOKEN = 16
TOKEN = f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
#: Natural logarithm of the odds that a random token must have.
MIN_RATIO = 12.0
SMOOTHING = 0.5
CHUNK = 256

KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "markov": TOKEN}

#: Labelled samples: identifiers are made of these words, random strings of these alphabets.
SAMPLES = 1500
WORDS = """user name file path value index count list item order date time start end first last next open close read
write create update delete select insert table column row key type code page link image title header footer button
color width height size font style class script event handler request response server client socket port host domain
query filter sort group merge split join parse format string number integer float boolean array object map node tree
graph edge point line shape model view control service manager factory builder adapter config option setting default
custom public private static final main test debug error warning info message result status state context session
buffer stream input output source target local global system process thread task job queue stack cache memory disk
network install package module library version release branch commit article section chapter language country region
city street company product price account payment customer nation government mention entre heure lieu sein schaft
lichkeit versicherung mente cion entrada""".split()
RANDOM_ALPHABETS = (ALPHABET[:62], ALPHABET[52:62] + "abcdef", ALPHABET[52:62] + "ABCDEF", ALPHABET[:64],
                    ALPHABET[:26] + "234567", ALPHABET[26:62])
STYLES = 7


def _dice(*parts: Column | str) -> Column:
    """A whole number from 0 to 65535 that follows from the given parts."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 4), 16, 10).cast("int")


def labelled_samples(spark: SparkSession, first: int = 0, count: int = SAMPLES) -> DataFrame:
    """(text, random): ``count`` identifiers in usual styles and ``count`` random
    strings in usual alphabets, numbers ``first`` and up; always the same."""
    ids = spark.range(first, first + count)
    words = F.split(F.lit(" ".join(WORDS)), " ")
    picked = F.transform(F.sequence(F.lit(1), F.lit(2) + _dice("n", F.col("id")) % 3),
                         lambda k: F.element_at(words, _dice("w", F.col("id"), k) % len(WORDS) + 1))
    plain = ids.select("id", picked.alias("w"), (F.col("id") % STYLES).alias("style"))
    styled = (F.when(F.col("style") == 0, F.array_join("w", "_")).when(F.col("style") == 1, F.array_join("w", "-"))
              .when(F.col("style") == 2, F.array_join(F.transform("w", F.initcap), ""))
              .when(F.col("style") == 3, F.upper(F.array_join("w", "_")))
              .when(F.col("style") == 4, F.concat(F.lit("/"), F.array_join("w", "/")))
              .when(F.col("style") == 5, F.array_join("w", ""))
              .otherwise(F.concat(F.array_join("w", "_"), F.lit("_"), (_dice("y", F.col("id")) % 3000).cast("string"))))
    alphabets = F.array(*[F.lit(a) for a in RANDOM_ALPHABETS])
    letters = F.element_at(alphabets, (F.col("id") % len(RANDOM_ALPHABETS) + 1).cast("int"))
    drawn = F.transform(F.sequence(F.lit(1), F.lit(20) + _dice("l", F.col("id")) % 44),
                        lambda k: F.substr(F.col("a"), _dice("c", F.col("id"), k) % F.length("a") + 1, F.lit(1)))
    return (plain.select(styled.alias("text"), F.lit(0).alias("random"))
            .unionByName(ids.select("id", letters.alias("a")).select(F.array_join(drawn, "").alias("text"), F.lit(1).alias("random"))))


def train(samples: DataFrame) -> list[float]:
    """How much likelier (natural logarithm) the random model finds character b
    after a, at place a * |ALPHABET| + b. Pairs with another character count for
    neither."""
    size = len(ALPHABET)
    chars = samples.select("random", F.split(F.coalesce(F.col("text"), F.lit("")), "").alias("c"))
    pairs = chars.select("random", F.explode(F.arrays_zip(F.col("c"), F.slice("c", 2, F.greatest(F.size("c"), F.lit(1)))))).select(
        "random", *[F.instr(F.lit(ALPHABET), F.col("col")[k]).alias(n) for k, n in (("c", "a"), ("1", "b"))])
    seen = pairs.where("a > 0 and b > 0").groupBy("a", "b").agg(
        F.count_if(F.col("random") == 1).alias("r"), F.count_if(F.col("random") == 0).alias("o"))
    after = seen.groupBy("a").agg(F.sum("r").alias("ra"), F.sum("o").alias("oa"))
    grid = samples.sparkSession.range(size * size).select(
        "id", (F.expr(f"id div {size}") + 1).alias("a"), (F.col("id") % size + 1).alias("b"))

    def logp(hits: str, total: str) -> Column:
        return F.log((F.coalesce(F.col(hits), F.lit(0)) + SMOOTHING) / (F.coalesce(F.col(total), F.lit(0)) + SMOOTHING * size))

    cells = grid.join(seen, ["a", "b"], "left").join(after, "a", "left")
    return [r["w"] for r in cells.select("id", (logp("r", "ra") - logp("o", "oa")).alias("w")).orderBy("id").collect()]


def ratio(token: Column, weights: list[float]) -> Column:
    """The log-likelihood ratio of a token of the alphabet's characters."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.aggregate(
        F.zip_with(codes, F.slice(codes, 2, F.length(token)), lambda a, b: F.get(table, a * len(ALPHABET) + b)),
        F.lit(0.0), lambda total, w: total + F.coalesce(w, F.lit(0.0)))


def running(items: str, first: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
    """The state after each element of the array column ``items``: ``step`` of the
    state before (``first`` at the start) and the element. States are gathered in
    chunks, since an array grows by copying. ``kind``: a state's type."""
    def state(done: Column, out: Column) -> Column:
        return F.struct(done.alias("state"), out.alias("out"))

    def advance(done: Column, item: Column) -> Column:
        now = step(done["state"], item)
        return state(now, F.concat(done["out"], F.array(now)))

    def chunk(done: Column, part: Column) -> Column:
        inner = F.aggregate(part, state(done["state"], F.array().cast(f"array<{kind}>")), advance)
        return F.transform(F.array(inner), lambda x: state(x["state"], F.concat(done["out"], F.array(x["out"]))))[0]

    parts = F.sequence(F.lit(0), F.expr(f"greatest(size({items}) - 1, 0) div {CHUNK}").cast("int"))
    chunks = F.transform(parts, lambda k: F.slice(items, k * CHUNK + 1, CHUNK))
    return F.flatten(F.aggregate(chunks, state(first, F.array().cast(f"array<array<{kind}>>")), chunk)["out"])


def with_matches(rows: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """``rows`` with an array ``name`` of structs (start, end, text): all matches,
    leftmost and not overlapping, counted in code points, end exclusive. A text
    without any, as nearly all are, is read once and nothing is built for it."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                        lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("text")))
    kind = "struct<start:int,end:int,text:string>"
    places = running("_pieces", F.lit(None).cast(kind), kind, lambda done, p: F.struct(
        (F.coalesce(done["end"], F.lit(0)) + p["gap"]).alias("start"),
        (F.coalesce(done["end"], F.lit(0)) + p["gap"] + F.length(p["text"])).alias("end"), p["text"].alias("text")))
    return (rows.withColumn("_pieces", F.when(F.col(text).rlike(pattern), F.filter(pieces, lambda p: p["text"].isNotNull())))
            .withColumn(name, F.when(F.col("_pieces").isNotNull(), places)).drop("_pieces"))


def spans(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """(doc_id, base, found) of each document: arrays of structs (start, rank,
    kind, end), sorted by start and rank; ``found`` has the model's spans too."""
    weights = train(labelled_samples(docs.sparkSession)) if weights is None else weights
    good = {"assign": lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 2)) >= LEAST["assign"],
            "access": lambda m: F.length(m["text"]) >= LEAST["access"],
            "hex": lambda m: F.length(m["text"]) >= LEAST["hex"],
            "markov": lambda m: ratio(m["text"], weights) >= MIN_RATIO}
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    for kind, pattern in KINDS.items():
        rows = with_matches(rows, "_text", pattern, kind)
    span = "struct<start:int,rank:int,kind:string,end:int>"

    def kept(rank: int, kind: str) -> Column:
        found = F.transform(F.filter(kind, good[kind]), lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))
        return F.coalesce(found, F.array().cast(f"array<{span}>"))

    rows = rows.select("doc_id", F.array_sort(F.concat(*[kept(i, k) for i, k in enumerate(KINDS)])).alias("_all"))
    # How far the base spans reach that start no later; a token within it is theirs.
    reach = running("_all", F.lit(0), "int", lambda far, s: F.when(s["kind"] == "markov", far).otherwise(F.greatest(far, s["end"])))
    rows = rows.withColumn("_all", F.zip_with("_all", reach, lambda s, far: F.when(
        (s["kind"] != "markov") | (s["end"] > far), s)))
    return rows.select("doc_id", F.filter("_all", lambda s: s["kind"] != "markov").alias("base"),
                       F.filter("_all", lambda s: s.isNotNull()).alias("found"))


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """A row per document: spans of each base kind, their digest, and all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans(docs, weights).select("doc_id", *[count(k) for k in LEAST], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                                       joined(F.col("found")).alias("spans"))
