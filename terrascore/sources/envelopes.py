"""Paged API envelopes: ``[meta, [record, ...]]`` JSON documents.

The HTTP puller itself is not part of the engine; its data side is. Landed
pages are scanned as text (one document per file or per line) and flattened
with built-in JSON functions — no Python per record:

* stop rules become row filters: an error payload (one element) and a null or
  empty record array yield no observations. A document that is not JSON, or
  whose second element is no array, is reported by ``rejected_pages``; every
  page counts in ``envelope_completeness``;
* the record array is taken apart element by element, so one element that is no
  record costs nothing but itself: ``flatten_envelopes`` emits every good one and
  ``rejected_records`` tells page, position, reason and text of every other;
* an absent key reads as ``""`` (``coalesce``), a null value stays null, a number
  written as text is that number;
* a page landed more than once counts once (``latest_pages``: the last landing),
  and pages that the metadata promise but nobody landed are named
  (``missing_pages``);
* the indicator name comes from the 13-row registry (broadcast: its size is
  fixed by the registry, not by the data) in a left join, or from the caller
  who knows which indicator was asked for: no record is lost for its id.

``pack_envelopes`` goes the other way (raw observations -> pages) to land
test data: an indicator's rows are numbered and cut into pages by number, so
equal rows fall on different pages and none holds more than ``page_size``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..registry import PAGE_SIZE, registry_df
from ..schemas import ENVELOPE_META, ENVELOPE_RECORD
from ..session import stage_table

#: Why an element of the record array is no record.
RECORD_REASONS = ("not_an_object", "bad_country", "bad_indicator", "bad_value")
#: Page numbers are dealt out in blocks of so many.
PAGE_BLOCK = 10_000


def read_envelopes(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Landed pages: ``envelope`` (the document), ``page_file`` and ``landed_at``
    (the file and when it was last written)."""
    return spark.read.text(path, wholetext=whole_files).select(
        F.col("value").alias("envelope"), F.col("_metadata.file_path").alias("page_file"),
        F.col("_metadata.file_modification_time").alias("landed_at"))


def _object_or_null(text: Column) -> Column:
    return text.isNull() | text.startswith("{")


def page_elements(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """Every element of every page's record array, one row each: its ``page``
    (null where the page does not say), ``position`` from 0, text (``element``),
    parsed ``record`` and ``reject_reason`` (null for a record). Other columns of
    ``envelopes`` but the document stay."""
    doc = F.col(col)
    kept = [c for c in envelopes.columns if c != col]
    texts = F.from_json(F.get_json_object(doc, "$[1]"), "array<string>")
    # Parsed before the explode: a filter on what comes out parses nothing again.
    parsed = F.transform(texts, lambda e: F.struct(e.alias("element"), F.from_json(e, ENVELOPE_RECORD).alias("record")))
    rows = (envelopes.where(F.json_array_length(doc) >= 2)
            .select(*kept, F.from_json(F.get_json_object(doc, "$[0]"), ENVELOPE_META)["page"].alias("page"),
                    F.posexplode(parsed).alias("position", "_e"))
            .select(*kept, "page", "position", "_e.element", "_e.record"))
    element, value = F.col("element"), F.col("record.value")

    def no_object(field: str) -> Column:
        """A field that was read as an object is one; only the others are looked up."""
        return F.col(f"record.{field}").isNull() & ~_object_or_null(F.get_json_object(element, f"$.{field}"))
    reason = (F.when(element.isNull() | ~element.startswith("{"), "not_an_object")
              .when(no_object("country"), "bad_country")
              .when(no_object("indicator"), "bad_indicator")
              .when(value.isNotNull() & value.try_cast("double").isNull(), "bad_value"))
    return rows.select("*", reason.alias("reject_reason"))


def rejected_records(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """(page, position, reject_reason, record) of the elements that are no
    records, with the page's file where it is known."""
    return bad_elements(page_elements(envelopes, col))


def bad_elements(elements: DataFrame) -> DataFrame:
    """The elements that are no records, as their text."""
    return elements.where("reject_reason is not null").select(
        *[c for c in ("page_file",) if c in elements.columns], "page", "position", "reject_reason",
        F.col("element").alias("record"))


def flatten_envelopes(envelopes: DataFrame, extraction_date, col: str = "envelope",
                      indicator: tuple[str, str] | None = None) -> DataFrame:
    """One row per record. ``indicator``: (id, name) of the extract call, for
    records without one of their own; else the registry names known ids and
    an unknown id has a null name."""
    return observations(page_elements(envelopes.select(col), col), extraction_date, indicator)


def observations(elements: DataFrame, extraction_date, indicator: tuple[str, str] | None = None) -> DataFrame:
    """The observations of page elements that are records."""
    spark = elements.sparkSession
    rows = elements.where("reject_reason is null").select("record.*")
    own_id = F.col("indicator.id")
    flat = rows.select(
        F.coalesce(F.col("countryiso3code"), F.lit("")).alias("country_code"),
        F.coalesce(F.col("country.value"), F.lit("")).alias("country_name"),
        F.coalesce(own_id, F.lit(indicator[0] if indicator else "")).alias("indicator_id"),
        F.coalesce(F.col("date"), F.lit("")).alias("year"),
        F.col("value").try_cast("double").alias("value"),
    )
    names = F.broadcast(registry_df(spark).select("indicator_id", "indicator_name"))
    name = F.col("indicator_name")
    if indicator:
        name = F.coalesce(name, F.when(F.col("indicator_id") == indicator[0], F.lit(indicator[1])))
    return flat.join(names, "indicator_id", "left").select(
        "country_code", "country_name", "indicator_id", name.alias("indicator_name"), "year", "value",
        F.lit(extraction_date).cast("date").alias("extraction_date"))


def _page_key(envelopes: DataFrame, col: str) -> DataFrame:
    """``envelopes`` with the indicator of the page's first record that names one,
    the page's number and the pages there should be."""
    doc = F.col(col)
    ids = F.transform(F.from_json(F.get_json_object(doc, "$[1]"), "array<string>"),
                      lambda e: F.get_json_object(e, "$.indicator.id"))
    meta = F.from_json(F.get_json_object(doc, "$[0]"), ENVELOPE_META)
    # Nearly always the first record names one; only else the others are looked at.
    first = F.coalesce(F.get_json_object(doc, "$[1][0].indicator.id"), F.get(F.filter(ids, lambda i: i.isNotNull()), 0))
    return envelopes.select("*", first.alias("indicator_id"), meta["page"].alias("page"), meta["pages"].alias("pages"))


def latest_pages(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """``envelopes`` (with ``landed_at`` and ``page_file``) without the pages that
    landed again later: one landing per (indicator, page), the last; of several at
    one time that of the last file, then the greatest document. Pages that name
    no indicator or number are all kept.

    The rank keeps the best landing of every task before the shuffle, so a page
    that landed very often is no hot spot. A page of no known key has a number of
    its own in its key: the pages are read once, and no group holds all of those."""
    known = F.col("indicator_id").isNotNull() & F.col("page").isNotNull()
    keyed = _page_key(envelopes, col).withColumn("_own", F.when(~known, F.monotonically_increasing_id()))
    last = Window.partitionBy("indicator_id", "page", "_own").orderBy(F.desc("landed_at"), F.desc("page_file"), F.desc(col))
    return keyed.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*envelopes.columns)


def missing_pages(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """(indicator_id, page) of the pages that an indicator's landed pages promise
    (``pages``: the largest number told) but that have not landed. Numbers are
    dealt out in blocks, so no row ever holds a long list; the pages' keys are
    staged, so each document is parsed once."""
    landed = stage_table(_page_key(envelopes, col).where("indicator_id is not null").select("indicator_id", "page", "pages"),
                         "page_keys")
    told = landed.groupBy("indicator_id").agg(F.max("pages").alias("pages")).where("pages > 0")
    blocks = told.select("indicator_id", "pages", F.explode(
        F.sequence(F.lit(0).cast("long"), F.expr(f"(pages - 1) div {PAGE_BLOCK}"))).alias("block"))
    first = F.col("block") * PAGE_BLOCK
    expected = blocks.select("indicator_id", F.explode(
        F.sequence(first + 1, F.least(first + PAGE_BLOCK, F.col("pages")))).alias("page"))
    return expected.join(landed.select("indicator_id", "page").distinct(), ["indicator_id", "page"], "left_anti")


def rejected_pages(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """(envelope, reject_reason) of the pages that yield no records though
    they are no plain empty answer."""
    doc = F.col(col)
    second = F.get_json_object(doc, "$[1]")
    reason = (F.when(doc.isNull() | F.json_array_length(doc).isNull(), F.lit("not_json_array"))
              .when(F.json_array_length(doc) < 2, F.lit("error_payload"))
              .when((second != "null") & F.json_array_length(second).isNull(), F.lit("records_not_array")))
    return envelopes.select(doc.alias("envelope"), reason.alias("reject_reason")).where("reject_reason is not null")


def envelope_completeness(envelopes: DataFrame, col: str = "envelope") -> DataFrame:
    """Pages and rows landed per indicator against each page's metadata.

    A puller that stops mid-way (a failed page) leaves partial data that
    looks valid; the metadata element of every page (``page``, ``pages``,
    ``total``) tells what a complete landing holds. One aggregation per
    indicator (partial aggregation map-side; the distinct page count is
    Spark's two-level distinct aggregation, no per-group set in one task).
    A page without records, and a page that cannot be read, reports under a
    null indicator id and is not complete.
    """
    doc = F.col(col)
    meta = F.from_json(F.get_json_object(doc, "$[0]"), ENVELOPE_META)
    pages = envelopes.select(
        F.get_json_object(doc, "$[1][0].indicator.id").alias("indicator_id"),
        meta.alias("m"),
        F.coalesce(F.json_array_length(F.get_json_object(doc, "$[1]")), F.lit(0)).alias("n"))
    out = pages.groupBy("indicator_id").agg(
        F.max("m.pages").alias("pages_expected"),
        F.count(F.lit(1)).alias("pages_landed"),
        F.count_distinct("m.page").alias("pages_seen"),
        F.max("m.total").alias("rows_expected"),
        F.sum("n").cast("long").alias("rows_seen"))
    return out.withColumn(
        "complete",
        F.coalesce((F.col("pages_seen") == F.col("pages_expected"))
                   & (F.col("pages_landed") == F.col("pages_seen"))
                   & (F.col("rows_seen") == F.col("rows_expected")), F.lit(False)))


def _numbered(raw: DataFrame) -> DataFrame:
    """``raw`` with each row's number within its indicator (``_row`` from 0)
    and the indicator's rows (``_total``). Staged in the order of the indicators
    in every part, with the number of the part: an indicator's rows of a part
    stand one after another, so a row's number is its place behind the first of
    them plus the rows of the indicator in earlier parts. No indicator is ever in
    one task, and no row is shuffled for its number; the counts are staged, so
    that Spark knows how small they are."""
    raw = stage_table(raw.sortWithinPartitions("indicator_id").withColumn("_part", F.spark_partition_id())
                      .withColumn("_at", F.monotonically_increasing_id()), "page_rows")
    parts = raw.groupBy("indicator_id", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("indicator_id")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = stage_table(parts.select(
        F.col("indicator_id").alias("_id"), F.col("_part").alias("_p"), F.sum("_n").over(whole).alias("_total"),
        (before - F.col("_first")).alias("_shift")), "page_parts")
    return (raw.join(parts, F.col("indicator_id").eqNullSafe(F.col("_id")) & (F.col("_part") == F.col("_p")))
            .withColumn("_row", F.col("_at") + F.col("_shift")))


def pack_envelopes(raw: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Raw observations -> one JSON page document per (indicator, page)."""
    pages = F.ceil(F.col("_total") / F.lit(page_size)).cast("long")
    columns = ("country_code", "country_name", "indicator_name", "year", "value")
    keyed = (_numbered(raw.select("indicator_id", *columns)).withColumn("_pages", pages)
             .withColumn("_page", F.expr(f"_row div {page_size}") + 1))
    grouped = keyed.groupBy("indicator_id", "_page", "_pages", "_total").agg(
        F.collect_list(F.struct(*columns)).alias("_rows"))
    # Shaped after the shuffle: what a record says twice is moved once.
    records = F.transform("_rows", lambda r: F.struct(
        r["country_code"].alias("countryiso3code"),
        F.struct(r["country_code"].alias("id"), r["country_name"].alias("value")).alias("country"),
        F.struct(F.col("indicator_id").alias("id"), r["indicator_name"].alias("value")).alias("indicator"),
        r["year"].alias("date"),
        r["value"].alias("value"),
    ))
    meta = F.struct(F.col("_page").alias("page"), F.col("_pages").alias("pages"),
                    F.lit(page_size).alias("per_page"), F.col("_total").alias("total"))
    return grouped.select(
        "indicator_id", F.col("_page").alias("page"),
        F.concat(F.lit("["), F.to_json(meta), F.lit(","), F.to_json(records),
                 F.lit("]")).alias("envelope"))
