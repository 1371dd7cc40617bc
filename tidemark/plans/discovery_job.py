"""Schema discovery that reads only new files, and a catalog that follows it.

The reference's crawler looks at the raw files once a day and updates or deletes what it finds
changed in the catalog. Here each run (an *arrival*) does so for what changed only:

* ``update_discovery`` lists the files, reads those it doesn't know, keeps their rows as text
  columns in Parquet, and beside them a profile: for each file and column how many values
  are of each kind. Profiles only add up, so the types over all files follow from the
  stored profiles (``discovered``), equal to those of a pass over all files.
* ``evolve_catalog`` makes the catalog equal to the profiles: new columns by ``ALTER TABLE ADD
  COLUMNS``, new and gone arrivals by partitions, and the typed face of the table, a view,
  by one ``CREATE OR REPLACE VIEW``. Rows are stored as text, so a type that widens (or narrows
  when files go) changes the view and never the data, and readers always find a table.

A file that was changed or deleted takes its whole arrival out: the arrival's other files
are read again as part of the new one. An arrival counts once its commit is written, the last
step; one that failed before is written over by the next run. One run at a time.

Layout of ``root``: ``rows/arrival=<n>/layout=<i>``, ``profile/arrival=<n>``,
``commits/arrival=<n>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.drift import schema_drift, types_of, value_kind
from tidemark.session import materialize, release_scratch, scratch_mark
from tidemark.sinks import ensure_database
from tidemark.sources.layouts import FILE, layouts, list_files, read_layout
from tidemark.streaming.ingest import _numbered

PROFILE = (
    "layout int, file string, length long, modified timestamp, column_name string, position int, kind int, n long"
)
COMMIT = "replaces array<int>"


def file_profile(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(file, column_name, position, kind, n): values of each kind by file and column, one partial aggregate."""
    cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.trim(f"`{c}`").alias("v")) for i, c in enumerate(columns)]
    long = rows.select(F.col(FILE).alias("file"), F.inline(F.array(*cells)))
    kinds = long.select("file", "position", "column_name", value_kind(F.col("v")).alias("kind"))
    return kinds.groupBy("file", "column_name", "position", "kind").agg(F.count(F.lit(1)).alias("n"))


def live_arrivals(spark: SparkSession, root: str) -> tuple[list[int], list[int]]:
    """The committed arrivals that no later one replaced, and all committed ones."""
    done = _numbered(spark, f"{root}/commits", "arrival", need_success=True)
    if not done:
        return [], []
    rows = spark.read.schema(f"{COMMIT}, arrival int").parquet(f"{root}/commits").where(F.col("arrival").isin(done))
    gone = {n for r in rows.select("replaces").collect() for n in r.replaces}  # a number for each run
    return [n for n in done if n not in gone], done


def profiles(spark: SparkSession, root: str) -> DataFrame:
    """The profile rows of the live arrivals; a file's own row (column_name null) has its number of rows."""
    live, _ = live_arrivals(spark, root)
    if not live:
        return spark.createDataFrame([], f"{PROFILE}, arrival int")
    return spark.read.schema(f"{PROFILE}, arrival int").parquet(f"{root}/profile").where(F.col("arrival").isin(live))


def update_discovery(spark: SparkSession, raw_path: str, root: str, pattern: str = "*.csv") -> int | None:
    """Take in what changed under ``raw_path``; the new arrival's number, or None where nothing did."""
    root = root.rstrip("/")
    mark = scratch_mark()
    try:
        listing = materialize(list_files(spark, raw_path, pattern), "listing")
        known = profiles(spark, root).where("column_name is null").select("file", "length", "modified", "arrival")
        same = ["file", "length", "modified"]
        replaced = sorted(r.arrival for r in known.join(listing, same, "left_anti").select("arrival").distinct().collect())
        new = listing.join(known.where(~F.col("arrival").isin(replaced)), same, "left_anti")
        files = new.collect()  # the paths that the reads below get anyway
        if not files and not replaced:
            return None
        _, done = live_arrivals(spark, root)
        arrival = max(done, default=-1) + 1
        _take_in(spark, root, arrival, files)
        spark.createDataFrame([(replaced,)], COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/arrival={arrival}")
        return arrival
    finally:
        release_scratch(spark, mark)


def _take_in(spark: SparkSession, root: str, arrival: int, files: list) -> None:
    """Rows and profile of the new files; the raw files are read once for their headers' lines and once for their rows."""
    of_file = spark.createDataFrame([(r.file, r.length, r.modified) for r in files], "file string, length long, modified timestamp")
    empty = of_file.select(F.lit(None).cast("int").alias("layout"), "file", F.lit(0).cast("long").alias("n"))
    counts, parts = [], []
    for i, layout in enumerate(layouts(spark, {r.file: r.path for r in files})):
        target = f"{root}/rows/arrival={arrival}/layout={i}"
        read_layout(spark, layout).write.mode("overwrite").parquet(target)
        rows = spark.read.parquet(target)
        counts.append(rows.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("n")).withColumn("layout", F.lit(i)))
        parts.append(file_profile(rows, layout.columns).withColumn("layout", F.lit(i)))
    sizes = empty
    for c in counts:
        sizes = sizes.unionByName(c)
    sizes = sizes.groupBy("file").agg(F.max("layout").alias("layout"), F.sum("n").alias("n"))
    none = {"column_name": F.lit(None).cast("string"), "position": F.lit(None).cast("int"), "kind": F.lit(None).cast("int")}
    out = sizes.withColumns(none)
    for p in parts:
        out = out.unionByName(p)
    names = [x.split()[0] for x in PROFILE.split(", ")]
    out.join(of_file, "file").select(*names).write.mode("overwrite").parquet(f"{root}/profile/arrival={arrival}")


def discovered(spark: SparkSession, root: str) -> DataFrame:
    """(column_name, inferred_type, non_null, total, place) over all live files, from the profiles alone.

    ``place`` orders the columns as they were first seen.
    """
    live = profiles(spark, root)
    total = live.where("column_name is null").agg(F.sum("n")).first()[0] or 0
    columns = live.where("column_name is not null")
    types = types_of(columns.withColumnRenamed("kind", "k"), "column_name")
    place = columns.groupBy("column_name").agg(F.min(F.struct("arrival", "layout", "position")).alias("place"))
    return types.drop("total").withColumn("total", F.lit(total).cast("long")).join(place, "column_name")


def _tables(spark: SparkSession, database: str) -> set[str]:
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN `{database}`").collect()}


def evolve_catalog(spark: SparkSession, root: str, database: str, table: str) -> DataFrame:
    """Make ``database.table`` follow the profiles; returns the drift (column_name, old_type, new_type, change).

    The table is a view with the discovered types over ``<table>__rows``, an external table of
    text columns. Running it again changes nothing.
    """
    root, store = root.rstrip("/"), f"`{database}`.`{table}__rows`"
    ensure_database(spark, database)
    types = discovered(spark, root).orderBy("place").select("column_name", "inferred_type").collect()  # a row for each column
    tables = _tables(spark, database)
    old = [(f.name, f.dataType.simpleString()) for f in spark.table(f"`{database}`.`{table}`").schema] if table in tables else []
    if f"{table}__rows" not in tables:
        columns = "".join(f"`{r.column_name}` STRING, " for r in types)
        spark.sql(
            f"CREATE TABLE {store} ({columns}`{FILE}` STRING, arrival INT, layout INT) USING parquet "
            f"PARTITIONED BY (arrival, layout) LOCATION '{root}/rows'"
        )
    else:
        there = {c.lower() for c in spark.table(store).columns}
        added = [r.column_name for r in types if r.column_name not in there]
        if added:
            spark.sql(f"ALTER TABLE {store} ADD COLUMNS ({', '.join(f'`{c}` STRING' for c in added)})")
    wanted = {(r.arrival, r.layout) for r in profiles(spark, root).where("layout is not null").select("arrival", "layout").distinct().collect()}
    have = set()
    for r in spark.sql(f"SHOW PARTITIONS {store}").collect():
        have.add(tuple(int(x.split("=")[1]) for x in r.partition.split("/")))
    new, gone = sorted(wanted - have), sorted(have - wanted)
    spec = "PARTITION (arrival={}, layout={})".format
    if new:
        spark.sql(f"ALTER TABLE {store} ADD IF NOT EXISTS {' '.join(spec(*p) for p in new)}")
    if types:  # before partitions go: a reader may see rows of both, never none
        cells = ", ".join(f"try_cast(trim(`{r.column_name}`) AS {r.inferred_type}) AS `{r.column_name}`" for r in types)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS SELECT {cells} FROM {store}")
    if gone:
        spark.sql(f"ALTER TABLE {store} DROP IF EXISTS {', '.join(spec(*p) for p in gone)}")
    kinds = "column_name string, inferred_type string"
    return schema_drift(
        spark.createDataFrame(old, kinds), spark.createDataFrame([(r.column_name, r.inferred_type) for r in types], kinds)
    )
