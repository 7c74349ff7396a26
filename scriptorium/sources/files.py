"""Readers and checked writers (inventory S1-S8).

CSV sources are read by column name, as strings (no inference pass over the
data; dirty columns are parsed by ``functions``), then the pandas missing tokens
become nulls. Files with line breaks inside quotes are cut into records in parallel
(``records``). Cells that hold no value of their column's type, and records with too few or too many
cells, can be had as rows with their origin.

Warehouse tables are Parquet folders. Appends are checked first (primary key
inside the batch and against the table, foreign keys against parents) and a
violating batch raises with all the violating rows, instead of being dropped
silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.integrity import IntegrityError, fk_orphans, pk_violations
from .records import cells, header, records

# fixed values: strings that pandas.read_csv (1.4) reads as missing by default
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def normalise_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing tokens in string columns -> null (exact match, as pandas)."""
    string_cols = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]
    return df.withColumns({
        c: F.when(F.col(c).isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c))
        for c in string_cols})


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """S1 + S8: a headered CSV whose columns are bound by name, in any order;
    columns that ``schema`` doesn't name are left out, a missing one raises.
    Numeric cells may be written as decimals (``2015.0``); a cell that holds no
    such number becomes null (see ``rejected_cells``).

    A file is read in parallel splits. ``multiline=True`` allows line breaks inside
    quotes, at the price of one shuffle of the lines; files that are no larger than one split together are
    read by one task each, as there is nothing to cut."""
    if not multiline or _one_split(spark, path):
        return _typed(_plain_csv(spark, path, schema, multiline), schema)
    rows, _ = _cut_csv(spark, path, schema)
    return _typed(normalise_missing(rows.select(*[F.col("cells").getField(f.name).alias(f.name) for f in schema.fields])), schema)


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType, onward: bool = False) -> DataFrame:
    """What a read of ``path`` can't use, with its origin: (file, record_no, column_name, cell).

    A cell that holds text but no value of its column's type has its column's name; a record with too few or
    too many cells has none, and ``cell`` is the record. Records are numbered in each file from 1, the header;
    ``onward`` numbers the files of a folder, in the order of their names, as one file under one header."""
    rows, names = _cut_csv(spark, path, schema)
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]

    def cell(f: T.StructField):
        raw = F.col("cells").getField(f.name)
        return F.when(raw.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(raw)
    bad = [F.when(cell(f).isNotNull() & _cell_value(cell(f), f.dataType).isNull(),
                  F.struct(F.lit(f.name).alias("column_name"), cell(f).alias("cell"))) for f in typed]
    whole = F.when(F.col("malformed").isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), F.col("malformed").alias("cell")))
    number = F.col("onward_no" if onward else "record_no").alias("record_no")
    return rows.select("file", number, F.inline(F.array_compact(F.array(whole, *bad))))


def read_sources(spark: SparkSession, folder: str, schemas: dict[str, T.StructType],
                 multiline: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """The CSV sources of a folder by name, and the rejected cells of all of them (with a column ``source``)."""
    folder = folder.rstrip("/")
    sources = {n: read_csv(spark, f"{folder}/{n}", schema, multiline) for n, schema in schemas.items()}
    rejected = [rejected_cells(spark, f"{folder}/{n}", schema).withColumn("source", F.lit(n)) for n, schema in schemas.items()]
    return sources, reduce(DataFrame.unionByName, rejected)


def _cut_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    rows = records(spark, path)
    names = header(rows)
    _require(names, schema, path)
    return cells(rows, names), names


def _require(names: list[str], schema: T.StructType, path: str) -> None:
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")


def _one_split(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return size <= split


def _plain_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    names = reader.csv(path).columns  # reads the header line only
    _require(names, schema, path)
    # the header of every file of a folder must be the same
    strings = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = reader.schema(strings).option("enforceSchema", False).csv(path)
    return normalise_missing(raw.select(*[f.name for f in schema.fields]))


def _cell_value(cell, dtype: T.DataType):
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        # integral decimals: the digits before an all-zero fraction
        return F.regexp_extract(cell, r"^\s*([+-]?\d+)(?:\.0*)?\s*$", 1).try_cast(dtype)
    return cell if isinstance(dtype, T.StringType) else cell.try_cast(dtype)


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return raw.select(*[_cell_value(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A warehouse table; ``None`` when it has not been created yet."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except Exception as exc:  # missing path on first load
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return None
        raise


def read_query(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None,
               args: dict[str, object] | None = None) -> DataFrame:
    """S3: a SELECT with named parameters. ``{name}`` stands for one of ``tables``, ``:name`` for one of
    ``args``. No view is registered that the session could see, so a user's view of the same name stays."""
    return spark.sql(sql, args=args or {}, **(tables or {}))


def project(df: DataFrame, columns: dict[str, str] | list[str]) -> DataFrame:
    """Keep and rename columns (``{source: target}`` or a list)."""
    if isinstance(columns, dict):
        return df.select(*[F.col(s).alias(t) for s, t in columns.items()])
    return df.select(*columns)


def check_batch(batch: DataFrame, table: str, pk: list[str],
                existing: DataFrame | None = None,
                fks: list[tuple[list[str], DataFrame, list[str]]] = ()) -> None:
    """Raise ``IntegrityError`` (with all violating rows) if the batch breaks
    the primary key (inside itself or against ``existing``), holds a null, or
    breaks a foreign key."""
    keys = batch.select(*pk)

    def refuse(kind: str, bad: DataFrame) -> None:
        if not bad.isEmpty():
            raise IntegrityError(table, kind, bad)

    refuse("primary key", pk_violations(keys, pk))
    if existing is not None and not _above(keys, existing, pk):
        # the batch is the build side, so the large table streams past it
        refuse("primary key", existing.select(*pk).join(keys, pk, "left_semi"))
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in batch.columns])
    refuse("not null", batch.filter(has_null))
    for fk_cols, parent, parent_cols in fks:
        refuse(f"foreign key {fk_cols}", fk_orphans(batch, fk_cols, parent, parent_cols))


def _above(keys: DataFrame, existing: DataFrame, pk: list[str]) -> bool:
    """A single integral key whose batch lies above the table's highest key can't clash."""
    if len(pk) > 1 or not isinstance(keys.schema[pk[0]].dataType, (T.LongType, T.IntegerType)):
        return False
    low, high = keys.agg(F.min(pk[0])).first()[0], existing.agg(F.max(pk[0])).first()[0]
    return low is None or high is None or low > high


def append(batch: DataFrame, path: str, table: str = "", pk: list[str] | None = None,
           existing: DataFrame | None = None,
           fks: list[tuple[list[str], DataFrame, list[str]]] = ()) -> None:
    """S4 (+S6): append a batch to a Parquet table after checking it."""
    if pk:
        check_batch(batch, table or path, pk, existing, fks)
    batch.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Replace a table with a fixed schema. Never overwrite a path that
    the same plan reads: write a new folder and switch to it instead."""
    out = df if schema is None else df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    out.write.mode("overwrite").parquet(path)
