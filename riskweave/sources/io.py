"""Readers and writers: declared-schema scans, layered publish, run manifest.

* ``read_table``     CSV or parquet scan with a declared schema; a missing
                      table either raises (gold) or yields an empty frame
                      with the declared schema (optional bronze tables).
* ``publish``        overwrite ``<root>/<layer>/<name>_<fmt>``; parquet is
                      written once and the CSV copy is produced from the
                      written parquet, so the plan never runs twice.
* ``run_manifest``   one-row frame of table counts and run facts;
  ``write_manifest`` / ``read_manifest`` round-trip it as JSON.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import remove  # noqa: F401
from riskweave.sources.schemas import nullable_schema, spec

#: Largest dataset that is written as one CSV file.
SINGLE_FILE_ROWS = 100_000

_EXT = {"parquet": "parquet", "csv": "csv"}


def _is_missing(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", lambda: None)() or ""
    return "PATH_NOT_FOUND" in cond or "Path does not exist" in str(exc)


def table_path(root: str, name: str, fmt: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{name}.{_EXT[fmt]}"


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               on_missing: str = "error", schema: T.StructType | None = None,
               path: str | None = None) -> DataFrame:
    """Scan table ``name`` under ``root`` with its declared schema.

    ``on_missing="error"`` raises ``AnalysisException`` for an absent path
    (gold tables); ``"empty"`` returns an empty frame with the declared
    schema (optional bronze tables).  CSV is read with a header (checked
    against the declared column names), no schema inference, empty fields as
    NULL and FAILFAST on malformed rows.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError("on_missing must be 'error' or 'empty'")
    sch = nullable_schema(schema if schema is not None else spec(name).schema)
    target = path or table_path(root, name, fmt)
    if on_missing == "empty" and not exists(spark, target):
        return spark.createDataFrame([], sch)
    reader = spark.read.schema(sch)
    try:
        if fmt == "csv":
            # enforceSchema=false: the header must name the declared columns in
            # order, so a reordered file fails instead of loading shifted values
            return (reader.option("header", True).option("mode", "FAILFAST")
                    .option("enforceSchema", False)
                    .option("dateFormat", "yyyy-MM-dd").csv(target))
        out = reader.parquet(target)
        check_parts(out, sch)
        return out
    except AnalysisException as exc:
        if on_missing == "empty" and _is_missing(exc):
            return spark.createDataFrame([], sch)
        raise


#: Part files whose footers are read at once on the driver; beyond that, tasks read them.
DRIVER_FOOTERS = 64


def check_parts(stored: DataFrame, schema: T.StructType) -> None:
    """Raise if a part file of ``stored`` lacks a column of ``schema``, which
    would read as NULL there.  Names the first files and their columns.

    A few footers are read on the driver, which takes no job; many by the
    executors (``part_columns``), one row a file.  Columns that are folders
    (``band=Alto``) are no columns of the files and count as present.
    """
    files = stored.inputFiles()
    names = schema.fieldNames()
    if len(files) <= DRIVER_FOOTERS:
        bad = [(f, absent) for f in files if (absent := _absent(f, footer_columns(stored.sparkSession, f), names))]
    else:
        rows = part_columns(stored.sparkSession, files)
        folders = F.expr("filter(split(file, '/'), x -> x like '%=%')")
        absent = F.array_except(F.array(*map(F.lit, names)), F.concat(
            "columns", F.transform(folders, lambda x: F.substring_index(x, "=", 1))))
        found = rows.select("file", absent.alias("absent")).where(F.size("absent") > 0)
        bad = [(r.file, r.absent) for r in found.orderBy("file").limit(5).collect()]
    if bad:
        raise ValueError("; ".join(f"{f} has no column {', '.join(absent)}" for f, absent in bad[:5]))


def _absent(file: str, columns: list[str], names: list[str]) -> list[str]:
    folders = {x.split("=", 1)[0] for x in file.split("/") if "=" in x}
    return [c for c in names if c not in columns and c not in folders]


def footer_columns(spark: SparkSession, file: str) -> list[str]:
    """Top-level columns in one file's footer, through the session's file systems."""
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return [f.getName() for f in reader.getFileMetaData().getSchema().getFields()]
    finally:
        reader.close()


def part_columns(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file, columns`` of many part files; each task reads the footers of its paths.

    Paths are opened by the store their URI names (local, HDFS or an object
    store); where Python knows no such store, the driver reads the footers.
    """
    from urllib.parse import unquote, urlparse

    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    def columns_of(file: str) -> list[str]:
        uri = urlparse(file)
        if uri.scheme in ("", "file"):
            return pq.read_schema(unquote(uri.path)).names
        store, path = pafs.FileSystem.from_uri(file)
        return pq.read_schema(path, filesystem=store).names

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.column(0).slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [some, pa.array([columns_of(f) for f in some.to_pylist()], pa.list_(pa.string()))],
                    names=["file", "columns"])

    schema = "file string, columns array<string>"
    if urlparse(files[0]).scheme not in ("", "file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"):
        return spark.createDataFrame([(f, footer_columns(spark, f)) for f in files], schema)
    tasks = min(len(files), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame([(f,) for f in files], "file string").repartition(tasks).mapInArrow(run, schema)


def dataset_path(root: str, layer: str, name: str, fmt: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}_{fmt}"


def publish(df: DataFrame, root: str, layer: str, name: str,
            formats: Iterable[str] = ("parquet",), single_csv_file: bool = False,
            skip_empty: bool = False, sort_by: list | None = None,
            partition_by: list[str] | None = None, page_rows: int | None = None) -> dict[str, str]:
    """Overwrite ``<root>/<layer>/<name>_<fmt>`` for each format.

    With several formats the plan runs once: parquet is written first and the
    CSV copy is written from it; a CSV alone leaves no parquet behind.
    ``single_csv_file`` asks for one CSV part and is honoured only up to
    ``SINGLE_FILE_ROWS`` rows.  ``sort_by`` orders rows at the sink only —
    upstream plans stay unsorted — and once: the CSV copy is not sorted
    again.  ``partition_by`` writes one parquet directory per value of
    low-cardinality columns, so readers filtering on them prune whole
    directories; CSV files always hold every column.  ``page_rows`` makes
    parquet pages of so many rows, for tables that are sorted for lookups: the
    page index lets a reader skip the others inside a row group.  With ``skip_empty`` an
    empty frame writes the format's empty dataset, so nothing of an earlier
    run stays readable, and no path is returned.  Returns written paths.
    """
    formats = list(formats)
    if skip_empty and df.isEmpty():
        publish(df, root, layer, name, formats)
        return {}
    spark = df.sparkSession
    out: dict[str, str] = {}
    src = df.orderBy(*sort_by) if sort_by else df
    if "parquet" in formats:
        pq = dataset_path(root, layer, name, "parquet")
        writer = src.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if page_rows:
            writer = writer.option("parquet.page.row.count.limit", page_rows)
        writer.parquet(pq)
        out["parquet"] = pq
        # partition columns move to the end of the stored schema: name them in their order
        src = spark.read.schema(df.schema).parquet(pq).select(*df.columns)
    if "csv" in formats:
        if single_csv_file and src.limit(SINGLE_FILE_ROWS + 1).count() <= SINGLE_FILE_ROWS:
            # few rows: sort them in the one file
            src = src.coalesce(1)
            src = src.sortWithinPartitions(*sort_by) if sort_by else src
        path = dataset_path(root, layer, name, "csv")
        src.write.mode("overwrite").option("header", True).csv(path)
        out["csv"] = path
    return out


def write_counted(df: DataFrame, root: str, layer: str, name: str, metrics: Mapping[str, Column] | None = None,
                  skip_empty: bool = True) -> dict[str, int]:
    """Write ``<root>/<layer>/<name>_parquet`` and count while writing.

    ``metrics`` (name → integer aggregate; ``rows`` is always there) are
    collected by the write's own tasks (``DataFrame.observe``), so no table is
    read a second time for its counts.  They stand directly below the write,
    in its result stage, where a repeated task counts once.  An empty table is
    known by the same count; with ``skip_empty`` it leaves no dataset, also
    none of an earlier run.
    """
    seen = Observation()
    aggregates = {"rows": F.count(F.lit(1)), **(metrics or {})}
    path = dataset_path(root, layer, name, "parquet")
    (df.observe(seen, *[F.coalesce(a, F.lit(0)).cast("long").alias(k) for k, a in aggregates.items()])
     .write.mode("overwrite").parquet(path))
    got = {k: int(seen.get.get(k) or 0) for k in aggregates}
    if skip_empty and not got["rows"]:
        remove(df.sparkSession, path)
    return got


def manifest_of(spark: SparkSession, counts: Mapping[str, int], **facts) -> DataFrame:
    """One-row run manifest from counts that are already known; ``generated_at``
    is the UTC time of the run."""
    row = spark.range(1).select(*[F.lit(int(v)).cast("long").alias(k) for k, v in counts.items()],
                                *[F.lit(v).alias(k) for k, v in facts.items()])
    return row.withColumn("generated_at", _utc_text())


def _utc_text() -> Column:
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def read_dataset(spark: SparkSession, root: str, layer: str, name: str,
                 fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Read a published dataset (all part files).  Missing → AnalysisException."""
    path = dataset_path(root, layer, name, fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV dataset is read with its declared schema")
        return read_csv(spark, path, schema)
    if schema is None:
        return spark.read.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    check_parts(stored, schema)
    return stored.select(*schema.fieldNames())


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV with its declared schema; a malformed row is an error."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or a match of a pattern is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(p)
    return found is not None and len(found) > 0


def write_csv_extract(df: DataFrame, path: str) -> str:
    """Export rows as headed CSV (the 'download filtered extract' action)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


# ------------------------------------------------------------------ manifest
MANIFEST_SCHEMA = T.StructType([
    T.StructField("entities_count", T.LongType()),
    T.StructField("seed", T.LongType()),
    T.StructField("generated_at", T.StringType()),
    T.StructField("activity_rows", T.LongType()),
    T.StructField("marks_rows", T.LongType()),
    T.StructField("engagement_rows", T.LongType()),
    T.StructField("actions_rows", T.LongType()),
])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` for every frame, in a single job (union of aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_manifest(tables: Mapping[str, DataFrame], names: Mapping[str, str],
                 **facts) -> DataFrame:
    """One-row run manifest: ``<field> = count(tables[key])`` plus ``facts``.

    ``names`` maps a manifest field to a key of ``tables``.  Counting is a
    union of global aggregates pivoted into one row (bounded: one row per
    table), and ``generated_at`` is the UTC time of the run.
    """
    counts = table_counts({k: tables[k] for k in names.values()})
    fields = list(names.keys())
    keyed = counts.groupBy().pivot("table_name", list(names.values())).agg(F.first("rows"))
    row = keyed.select(*[F.col(f"`{t}`").cast("long").alias(f) for f, t in names.items()])
    for k, v in facts.items():
        row = row.withColumn(k, F.lit(v))
    row = row.withColumn("generated_at", _utc_text())
    return row.select(*fields, *facts.keys(), "generated_at")


def write_manifest(manifest: DataFrame, path: str) -> str:
    manifest.coalesce(1).write.mode("overwrite").json(path)  # one row by construction
    return path


def read_manifest(spark: SparkSession, path: str,
                  schema: T.StructType = MANIFEST_SCHEMA) -> DataFrame:
    """Read a manifest (one JSON object per file, pretty-printed or not).

    A missing path or a corrupt document gives no row, so the caller's
    ``coalesce(field, default)`` applies, as it does for an absent field.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        return (spark.read.schema(schema).option("multiLine", True)
                .option("mode", "DROPMALFORMED").json(path))
    except AnalysisException as exc:
        if _is_missing(exc):
            return spark.createDataFrame([], schema)
        raise
