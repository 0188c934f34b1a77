"""Publish the star schema and its three views to the Spark catalog.

Tables are external (their files live in the shared folder) and loaded with
the warehouse's truncate semantics; views are ``CREATE OR REPLACE VIEW`` —
atomic, with no gap between drop and create. A view's text is composed from
its declared output columns (``operators.views``) and the table schemas that
hold them; rows are ordered by who reads the view, not inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import registry as R
from ..operators.views import COMPARISON_COLUMNS, TOP_COLUMNS, TRENDS_COLUMNS
from ..schemas import TABLE_SCHEMAS
from ..sinks.writers import ensure_database, load_table, replace_view

TABLES = tuple(TABLE_SCHEMAS)
VIEWS = ("country_comparison_view", "top_countries_for_grads_view", "country_trends_view")
# Tables the views join on (country_code, year): stored bucketed on those
# keys with one bucket count, so the view join chains need no exchange on
# their side (only the country x year spine is shuffled).
BUCKETED = tuple(t for t, schema in TABLE_SCHEMAS.items() if set(R.KEYS) <= set(schema.names))


def _owner(column: str, tables: tuple[str, ...]) -> str:
    return next(t for t in tables if column in TABLE_SCHEMAS[t].names)


def _spine(db: str, floor: int, columns: tuple[str, ...], only: str = "") -> str:
    """Every country (``only``: a further join) with every year from ``floor``
    on; the years are one small scalar, so this is an explode, not a join."""
    years = ", ".join(c for c in TABLE_SCHEMAS["dim_time"].names if c in columns)
    return (f"(SELECT country_code, country_name, calendar.* FROM {db}.dim_countries {only} "
            f"LATERAL VIEW inline((SELECT array_sort(collect_set(struct({years}))) "
            f"FROM {db}.dim_time WHERE year >= {floor})) calendar)")


def _spine_view(db: str, columns: tuple[str, ...], floor: int, only: str = "") -> str:
    """``columns`` over the spine, each from the table that holds it."""
    own = set(TABLE_SCHEMAS["dim_countries"].names) | set(TABLE_SCHEMAS["dim_time"].names)
    used = [t for t in BUCKETED if any(c not in own and _owner(c, BUCKETED) == t for c in columns)]
    picked = ", ".join(f"spine.{c}" if c in own else f"{_owner(c, BUCKETED)}.{c}" for c in columns)
    joins = " ".join(
        f"LEFT JOIN {db}.{t} ON " + " AND ".join(f"{t}.{k} = spine.{k}" for k in R.KEYS) for t in used)
    return f"SELECT {picked} FROM {_spine(db, floor, columns, only)} spine {joins}"


def _best(db: str, k: int) -> str:
    """The ranked rows of the latest year up to rank ``k``."""
    table = f"{db}.opportunity_index"
    return (f"(SELECT * FROM {table} WHERE opportunity_rank <= {k} "
            f"AND year = (SELECT max(year) FROM {table}))")


def comparison_sql(db: str, floor: int = R.COMPARISON_YEAR_FLOOR) -> str:
    return _spine_view(db, COMPARISON_COLUMNS, floor)


def top_sql(db: str, k: int = R.TOP_K) -> str:
    return f"SELECT {', '.join(TOP_COLUMNS)} FROM {_best(db, k)} JOIN {db}.dim_countries USING (country_code)"


def trends_sql(db: str, floor: int = R.TRENDS_YEAR_FLOOR, k: int = R.TRENDS_TOP_K,
               home: str = R.HOME_COUNTRY) -> str:
    # The chosen codes are joined on the spine only, as a distinct set: the
    # optimizer does not copy them onto every bucketed table as a semi join.
    named = home.replace("'", "''")
    chosen = (f"JOIN (SELECT country_code FROM {_best(db, k)} UNION "
              f"SELECT country_code FROM {db}.dim_countries WHERE country_name = '{named}') USING (country_code)")
    return _spine_view(db, TRENDS_COLUMNS, floor, chosen)


def load_log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_load_log"


def publish(spark: SparkSession, tables: dict[str, DataFrame], database: str, root: str,
            comparison_floor: int = R.COMPARISON_YEAR_FLOOR,
            trends_floor: int = R.TRENDS_YEAR_FLOOR, top_k: int = R.TOP_K,
            trends_k: int = R.TRENDS_TOP_K, home: str = R.HOME_COUNTRY,
            disposition: str = "WRITE_TRUNCATE", buckets: int | None = None) -> dict[str, int]:
    """Load the six tables and (re)create the three views; returns row counts.

    ``buckets``: bucket count of the (country_code, year) tables; default
    ``spark.sql.shuffle.partitions``, which a cluster sets for its data.

    Each table is loaded with its declared schema (columns matched by name,
    cast and ordered as declared), so the catalog schema never depends on
    how a plan happened to type a column. Every load appends to the load log.
    """
    # The namespace lives next to the tables (shared storage), not in the
    # process's working directory.
    ensure_database(spark, database, location=f"{root.rstrip('/')}/_database")
    counts = {}
    for name in TABLES:
        counts[name] = load_table(tables[name], f"{database}.{name}", disposition,
                                  schema=TABLE_SCHEMAS[name],
                                  path=f"{root.rstrip('/')}/{name}",
                                  bucket_by=R.KEYS if name in BUCKETED else None,
                                  buckets=buckets, log=load_log_path(root))
    replace_view(spark, f"{database}.country_comparison_view",
                 comparison_sql(database, comparison_floor))
    replace_view(spark, f"{database}.top_countries_for_grads_view", top_sql(database, top_k))
    replace_view(spark, f"{database}.country_trends_view",
                 trends_sql(database, trends_floor, trends_k, home))
    return counts
