"""CSV load that survives bad rows: what parses is loaded, the rest is set aside.

One pass over the files writes both: rows that parse, under the declared
types, and those that do not, as they stood, with their file and a reason.
The write itself counts them, so a limit on bad rows costs no further scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources.schemas import nullable_schema

RAW, FILE, BAD, MORE = "_raw", "_file", "_bad", "_more"


class TooManyBadRows(ValueError):
    """More rows than allowed did not parse; they are kept for a look."""


@dataclass(frozen=True)
class Loaded:
    good: DataFrame
    #: ``file, raw, reason``
    bad: DataFrame
    n_good: int
    n_bad: int


def load_csv(spark: SparkSession, path: str, schema: T.StructType, target: str, header: bool = True,
             max_bad: int | None = None, date_format: str = "yyyy-MM-dd") -> Loaded:
    """Load the CSV files of ``path`` into ``target`` (overwritten), bad rows aside.

    A row is bad if a field is not of its column's type or the row has another
    number of fields than the schema; empty fields are NULL and never bad.
    With a header, its names must be the declared ones in order.  Good rows go
    to ``target/_bad=false`` and bad ones to ``target/_bad=true``, both Parquet,
    in one run of the scan.  More than ``max_bad`` bad rows raise
    ``TooManyBadRows`` after the write; ``None`` sets no limit.
    """
    declared = nullable_schema(schema)
    wide = T.StructType([*declared.fields, T.StructField(RAW, T.StringType())])
    rows = (spark.read.schema(wide).option("header", header).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).option("dateFormat", date_format)
            .csv(path))
    bad = F.col(RAW).isNotNull()
    placed = rows.select(*declared.fieldNames(), RAW, F.when(bad, F.col("_metadata.file_path")).alias(FILE),
                         bad.alias(BAD))
    seen = Observation()
    (placed.observe(seen, F.count_if(~F.col(BAD)).alias("good"), F.count_if(F.col(BAD)).alias("bad"))
     .write.mode("overwrite").option("compression", "zstd").partitionBy(BAD).parquet(target))
    n_good, n_bad = (int(seen.get.get(k) or 0) for k in ("good", "bad"))
    stored = spark.read.schema(T.StructType([*wide.fields, T.StructField(FILE, T.StringType()),
                                             T.StructField(BAD, T.BooleanType())])).parquet(target)
    out = Loaded(stored.where(~F.col(BAD)).select(*declared.fieldNames()),
                 stored.where(F.col(BAD)).select(F.col(FILE).alias("file"), F.col(RAW).alias("raw"),
                                                 reason(F.col(RAW), declared, date_format).alias("reason")),
                 n_good, n_bad)
    if max_bad is not None and n_bad > max_bad:
        first = out.bad.orderBy("file", "raw").limit(3).collect()
        raise TooManyBadRows(f"{n_bad} rows of {path} do not parse, {max_bad} are allowed: "
                             + "; ".join(f"{r.file}: {r.reason}" for r in first))
    return out


def reason(raw: Column, schema: T.StructType, date_format: str = "yyyy-MM-dd") -> Column:
    """Why a row does not parse: its first field of the wrong type, else its number of fields."""
    texts = ", ".join(f"`{f.name}` string" for f in [*schema.fields, T.StructField(MORE, T.StringType())])
    fields = F.from_csv(raw, texts, {"mode": "PERMISSIVE"})

    def wrong(f: T.StructField) -> Column:
        text, kind = fields[f.name], f.dataType.simpleString()
        value = F.try_to_date(text, date_format) if kind == "date" else text.try_cast(f.dataType)
        return F.when(text.isNotNull() & value.isNull(), F.lit(f"{f.name} is no {kind}"))

    return F.coalesce(*[wrong(f) for f in schema.fields if not isinstance(f.dataType, T.StringType)],
                      F.when(fields[MORE].isNotNull(), F.lit("more fields than columns")),
                      F.lit("fewer fields than columns"))
