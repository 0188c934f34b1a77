"""Quality rules with cross-document line frequency (op 10), native.

One pass over the texts makes, per row, the base figures and the hashes of its
normalised lines; the rest works on that small staged table. A line that more
than ``max_docs`` distinct documents of one host share is boilerplate. Its
words are removed, and a document of which too little remains is rejected.

Every input row is a document: rows with the same text, or the same id, count
each in their lines' frequencies.

Defined results: null or blank text has no words and fails the base rules; a
null host is a host of its own; rows that share an id or are equal are judged
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascore.llm.common import (LOWER, UPPER, WS_CHARS, WS_CLASS, row_key, split_words, stage_table,
                                   trimmed, word_count)

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: A line in more distinct documents of its host than this is boilerplate.
MAX_DOCS = 25
#: A document is depleted when fewer than MIN_WORDS words, or fewer than this
#: percentage of its words, remain without boilerplate.
MIN_LEFT_PCT = 20


def window_keys(hashes: str, n: str, window: int = WINDOW) -> Column:
    """Sorted (window hash, position) of each ``window``-word window of the word
    hashes in column ``hashes`` (``n`` of them): equal windows end up side by
    side and no two windows need be compared."""
    return F.expr(f"""
        CASE WHEN {n} >= {window} THEN sort_array(transform(sequence(0, {n} - {window}),
            i -> struct(xxhash64(slice({hashes}, i + 1, {window})) AS h, i AS at)))
        ELSE array() END""")


def repeated_starts(keys: str, n: str) -> Column:
    """Start positions, ascending, of the windows found twice or more."""
    return F.expr(f"""
        sort_array(transform(filter({keys}, (k, i) ->
            coalesce(get({keys}, i - 1).h = k.h, false)
            OR coalesce(get({keys}, i + 1).h = k.h, false)), k -> k.at))""")


def covered_words(starts: str, window: int = WINDOW) -> Column:
    """Words under at least one of the windows that begin at ``starts``."""
    return F.expr(f"""
        CASE WHEN size({starts}) = 0 THEN 0L ELSE {window} + aggregate(
            sequence(1, size({starts})), 0L, (acc, i) -> acc + CASE WHEN i < size({starts})
                THEN least({window}L, get({starts}, i) - get({starts}, i - 1)) ELSE 0L END) END""")


def normal_line(line: Column) -> Column:
    """A line for counting: A-Z lower-cased, each digit 0, white space single."""
    plain = F.translate(line, UPPER + "123456789", LOWER + "0" * 9)
    return F.regexp_replace(F.btrim(plain, F.lit(WS_CHARS)), f"[{WS_CLASS}]+", " ")


def features(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per input row: the base figures and its lines as (hash, words). Staged: all later work reads this small table."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(row_key().alias("row"), F.col(id_col).alias("id"),
                    F.col(host_col).cast("string").alias("host"), text.alias("body"))
    d = d.select("*", F.transform(split_words(F.col("body")), lambda w: F.xxhash64(w)).alias("hashes"),
                 F.filter(F.split("body", "\n"), lambda x: trimmed(x) != "").alias("lines"))
    d = d.select("*", F.size("hashes").cast("long").alias("n_words"))
    d = d.withColumn("keys", window_keys("hashes", "n_words"))
    d = d.withColumn("starts", repeated_starts("keys", "n_words"))
    return stage_table(d.select(
        "row", "id", "host", "n_words",
        F.length(F.translate("body", WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered_words("starts").alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line"),
                                                word_count(x).alias("words"))).alias("lines")),
        "quality-features")


def boilerplate(feats: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line) of the lines in more than ``max_docs`` distinct documents of
    the host. A row brings each of its lines once, so documents are counted with
    partial sums: a line that every document has crosses the network as one row
    per task."""
    lines = feats.select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
    return (lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
            .where(F.col("docs") > max_docs).select("host", "line"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_left_pct: int = MIN_LEFT_PCT,
          max_repeat_pct: int = MAX_REPEAT_PCT) -> DataFrame:
    """One row per input row: the base figures, ``base_failed``,
    ``boilerplate_words`` and ``kept``."""
    feats = features(docs, id_col, text_col, host_col)
    common = boilerplate(feats, max_docs).alias("c")
    lines = feats.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.*").alias("f")
    lost = (lines.join(common, F.col("f.host").eqNullSafe(F.col("c.host"))
                       & (F.col("f.line") == F.col("c.line")))
            .groupBy("row").agg(F.sum("words").alias("lost")))
    out = feats.drop("lines").join(lost, "row", "left").withColumn("lost", F.coalesce("lost", F.lit(0)))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    left = F.col("n_words") - F.col("lost")
    depleted = (left < min_words) | (left * 100 < F.col("n_words") * min_left_pct)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                      F.col("lost").alias("boilerplate_words"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_docs: int = MAX_DOCS) -> DataFrame:
    """The kept documents, in their own columns, without boilerplate lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(row_key().alias("row"), F.struct("*").alias("doc"), F.col(id_col).alias("id"),
                        F.col(host_col).cast("string").alias("host"), text.alias("body"))
    whole = stage_table(whole, "quality-docs")
    kept = judge(whole.select(F.struct("row", "id").alias("k"), "body", "host"), "k", "body", "host", max_docs)
    feats = features(whole.select("row", "body", "host"), "row", "body", "host")
    common = boilerplate(feats, max_docs).alias("c")
    f = feats.select(F.col("id").alias("row"), "host", F.posexplode("lines.line").alias("at", "line")).alias("f")
    gone = (f.join(common, F.col("f.host").eqNullSafe(F.col("c.host")) & (F.col("f.line") == F.col("c.line")))
            .groupBy("row").agg(F.collect_set("at").alias("gone")))
    out = (whole.join(kept.where("kept").select(F.col("k.row").alias("row")), "row").join(gone, "row", "left"))
    numbered = F.filter(F.split("body", "\n"), lambda x: trimmed(x) != "")
    lines = F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(
        F.filter(numbered, lambda x, i: ~F.array_contains("gone", i)), "\n"))
    return out.select(*[(lines if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
