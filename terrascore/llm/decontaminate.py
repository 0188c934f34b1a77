"""Benchmark decontamination by a prefix-filtered set join (op 6), native.

Every benchmark item is cut into windows of ``window`` consecutive words (a
shorter item is one window), and every window into shingles of up to three
words. A window occurs in a document only if all its shingles do, so one
necessary token is a sufficient prefix: the window's rarest shingle in the
corpus. The steps:

1. One pass over the texts keeps, of all their shingles, those the benchmark
   has (compared word for word, not by hash alone), with row and position, and
   one marker row per document with its word count. That table is staged; its
   size follows the overlap with the benchmark, not the corpus.
2. Shingles are counted there and each window gets its rarest as anchor.
   A window with a shingle that never occurs is dropped.
3. Occurrences of anchors are joined to their windows: the position must leave
   room for the window before and after it (length and positional bounds), and
   every shingle of the window must stand at its place (exact containment).
4. Occurrences are merged per document into hit words and items.

Only the benchmark's distinct shingles are broadcast, and only after their
number is found to be within ``BROADCAST_ROWS``; beyond it the same join runs
as a shuffle.

Defined results: null or blank texts have no words, no hits and are clean;
null or blank items have no windows; several rows or items with the same id
or text are each treated in their own right; empty tables give no hits or no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrascore.llm.common import LOWER, UPPER, row_key, split_words, stage_table

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 500_000
#: The hash under which the marker rows of documents pass the join.
MARKER = 0


def words_of(text: Column) -> Column:
    return split_words(F.translate(text, UPPER, LOWER), SEPARATORS)


def windows_of(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(item, words): every window of every item."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("all"))
    n = F.size("all")
    starts = F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))
    w = w.where(n > 0).select("item", "all", F.explode(starts).alias("at"))
    return w.select("item", F.slice("all", F.col("at"), window).alias("words"))


def _shingle(words: Column, at: Column, k) -> Column:
    return F.slice(words, at, k)


def _key(shingle: Column) -> Column:
    """A hash that is never the marker's."""
    h = F.xxhash64(shingle)
    return F.when(h == MARKER, F.lit(1).cast("long")).otherwise(h)


def occurrences(docs: DataFrame, id_col: str, text_col: str, shingles: DataFrame, sizes: list[int],
                few: bool) -> DataFrame:
    """Staged (row, id, n_words, at, sid): the benchmark's shingles in each
    document, and per document one row with ``at`` and ``sid`` -1. ``few``: the
    benchmark's shingles are broadcast, and a match is compared with the text's
    words beside it; else each shingle takes its own words into the shuffle."""
    d = docs.select(row_key().alias("row"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    d = d.select("row", "id", "words", F.size("words").cast("long").alias("n_words"))
    def of(k):
        places = F.when(F.size("words") >= k, F.sequence(F.lit(1), F.size("words") - k + 1)).otherwise(
            F.array().cast("array<int>"))

        def spot(i):
            shingle = _shingle(F.col("words"), i, k)
            own = [] if few else [shingle.alias("text")]
            return F.struct(i.alias("at"), F.lit(k).alias("k"), _key(shingle).alias("h"), *own)
        return F.transform(places, spot)
    nothing = F.array().cast("array<string>")
    marker = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"), F.lit(MARKER).cast("long").alias("h"),
                              *([] if few else [nothing.alias("text")])))
    rows = d.select("row", "id", "n_words", *(["words"] if few else []), F.inline(F.concat(marker, *[of(k) for k in sizes])))
    own = shingles.unionByName(docs.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias("sid"), F.lit(MARKER).cast("long").alias("h"), nothing.alias("shingle")))
    own = own.select("sid", F.col("h").alias("bh"), "shingle")
    if few:
        same = (F.col("at") == 0) | (_shingle(F.col("words"), F.greatest(F.col("at"), F.lit(1)), F.col("k"))
                                     == F.col("shingle"))
    else:
        same = F.col("text") == F.col("shingle")
    hits = rows.join(F.broadcast(own) if few else own, (F.col("h") == F.col("bh")) & same)
    return stage_table(hits.select("row", "id", "n_words", (F.col("at") - 1).alias("at"), "k", "sid"),
                       "decon-shingles")


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW
              ) -> tuple[DataFrame, DataFrame]:
    """(documents, occurrences): per input row ``row, id, n_words``; per
    occurrence of a window ``row, start, end, item``."""
    wins = windows_of(items, item_id_col, item_text_col, window)
    wins = wins.groupBy("words").agg(F.collect_set("item").alias("items"))
    wins = wins.select(F.xxhash64("words").alias("win"), "words", "items", F.size("words").alias("len"),
                       F.least(F.size("words"), F.lit(SHINGLE)).alias("k"))
    wins = stage_table(wins, "decon-windows")
    parts = wins.select("win", "k", "len", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("len") - F.col("k") + 1),
        lambda i: _shingle(F.col("words"), i, F.col("k")))).alias("off", "shingle"))
    shingles = stage_table(parts.groupBy("shingle").agg(F.first("k").alias("k"))
                           .select(row_key().alias("sid"), _key(F.col("shingle")).alias("h"), "shingle", "k"),
                           "decon-vocabulary")
    sizes = [r["k"] for r in shingles.select("k").distinct().orderBy("k").collect()]  # at most SHINGLE values
    few = shingles.count() <= BROADCAST_ROWS
    found = occurrences(docs, id_col, text_col, shingles.drop("k"), sizes, few)
    rows = found.where("sid = -1").select("row", "id", "n_words")
    found = found.where("sid >= 0")
    counts = found.groupBy("sid").agg(F.count("*").alias("seen"))
    # A window's shingles with their counts; its rarest one is the prefix.
    known = (parts.join(shingles.select("shingle", "sid"), "shingle").join(counts, "sid", "left")
             .groupBy("win").agg(F.sort_array(F.collect_list(F.struct("off", "sid"))).alias("parts"),
                                 F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "off", "sid"))
                                 .alias("rarest"))
             .where("rarest.seen > 0")
             .select("win", F.col("parts.sid").alias("sids"), F.col("rarest.off").alias("off"),
                     F.col("rarest.sid").alias("sid")))
    anchors = known.join(wins.select("win", "len", "items"), "win").drop("win")
    reach = window - 1
    near = Window.partitionBy("row", "k").orderBy("at").rangeBetween(-reach, reach)
    found = found.withColumn("near", F.collect_list(F.struct("at", "sid")).over(near))
    cand = found.join(anchors, "sid").withColumn("start", F.col("at") - F.col("off"))
    cand = cand.where("start >= 0 and start + len <= n_words")
    inside = F.filter("near", lambda x: (x["at"] >= F.col("start")) & (x["at"] < F.col("start") + F.size("sids")))
    exact = F.transform(F.sort_array(inside), lambda x: x["sid"]) == F.col("sids")
    hits = cand.where(exact).select("row", "start", (F.col("start") + F.col("len")).alias("end"), "items")
    return rows, hits


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (their ids, sorted), ``contaminated``."""
    rows, hits = find_hits(docs, items, id_col, text_col, item_id_col, item_text_col, window)
    spans = hits.groupBy("row", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("seen", F.max("end").over(before))
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce("seen", F.lit(0)))
    words = spans.groupBy("row").agg(F.sum(F.greatest(fresh, F.lit(0))).cast("long").alias("n_hit"))
    # collect_set holds at most one entry per item with an occurrence in the document
    ids = (hits.select("row", F.explode("items").alias("item")).groupBy("row")
           .agg(F.sort_array(F.collect_set("item")).alias("items")))
    per = words.join(ids, "row")
    out = rows.join(per, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      (n_hit > 0).alias("contaminated"))


def digest(result: DataFrame) -> DataFrame:
    """``items`` as a count and the SHA-256 of the comma-joined ids."""
    return result.select(*[c for c in result.columns if c not in ("items", "contaminated")],
                         F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                         "contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, in their own columns, in which no window occurs."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    rows, hits = find_hits(docs.select(key.alias("key"), F.col(text_col).alias("body")), items, "key", "body",
                           item_id_col, item_text_col)
    hit = rows.join(hits.select("row").distinct(), "row").select(F.col("id.id").alias("__hit_id"), F.col("id.text").alias("__hit_text"))
    hit = hit.distinct()
    same = F.col(id_col).eqNullSafe(F.col("__hit_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__hit_text"))
    return docs.join(hit, same, "left_anti")
