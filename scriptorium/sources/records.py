"""CSV records whose quoted cells hold line breaks, cut in parallel.

A record can only be cut where the reader knows whether it is inside quotes, and that
depends on all quotes before. So the physical lines of a file are read in Spark's
own splits, and:

1. every split counts its quotes (one narrow row for each split);
2. a running sum over a file's splits gives the parity at each split's start;
3. inside a split a running sum gives the parity at each line's start; a line that
   starts outside quotes starts a record. The lines of a split are put together by record;
4. a record that runs over the end of its split gets the split's successors' first lines: the only
   rows that meet across splits are one fragment for each split.

Lines are moved once, to their split, and the reader's task count follows the bytes of the
files. A running count over the splits numbers the records of a file from 1 (the header), which
names the origin of a rejected cell.

Quotes are doubled inside quoted cells, and cells that hold a quote are quoted, as
CSV writers do. A file whose quotes don't pair up raises, with its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

SPLIT = ["file", "block"]


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, at, odd): the lines of all files in the reader's splits; ``block`` is the
    split's first byte, ``at`` grows with the place in the split, ``odd`` is the parity of a line's quotes."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))
    return lines.withColumn("odd", (quotes % 2).cast("int"))


def _parities(lines: DataFrame) -> DataFrame:
    """(file, block, inside, split): whether a split starts inside quotes, and its number; one row for each split."""
    splits = materialize(lines.groupBy(*SPLIT).agg(F.sum("odd").alias("quotes")), "splits")
    unpaired = splits.groupBy("file").agg(F.sum("quotes").alias("q")).where("q % 2 = 1").orderBy("file").limit(10).collect()
    if unpaired:
        raise ValueError(f"quotes don't pair up in {[r['file'] for r in unpaired]}")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(*SPLIT, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("inside"),
                         F.row_number().over(Window.orderBy(*SPLIT)).alias("split"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_no, onward_no, record): every record of every file, header included, line breaks kept.
    ``onward_no`` numbers the records of all files, by their names, as if they were one file with one header."""
    lines = physical_lines(spark, path)
    parities = _parities(lines)
    here = lines.join(parities, SPLIT).drop(*SPLIT)  # lines are sorted with their split's number, not with its path
    order = Window.partitionBy("split").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = ((F.col("inside") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 0).cast("int")
    numbered = here.withColumn("starts", starts).withColumn(
        "rec", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # the lines of a record in their order; record 0 of a split belongs to an earlier split's last one
    pieces = materialize(numbered.groupBy("split", "rec").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("text")), "records")
    pieces = pieces.join(parities.select(*SPLIT, "split"), "split")
    splits = pieces.groupBy(*SPLIT).agg(F.max("rec").alias("last"))
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    has = F.when(F.col("last") > 0, F.struct("block", "last"))
    placed = materialize(splits.select(  # one row for each split
        *SPLIT, "last", F.coalesce(F.sum("last").over(earlier), F.lit(0)).alias("offset"),
        F.last(has, ignorenulls=True).over(earlier).alias("owner")), "placed")
    tails = pieces.where("rec = 0").join(placed, SPLIT).groupBy("file", F.col("owner.block").alias("block"),
                                                              F.col("owner.last").alias("rec")) \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("tail"))
    files = placed.groupBy("file").agg(F.sum("last").alias("n"))  # one row for each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum(F.col("n") - 1).over(before), F.lit(0)).alias("earlier"))
    whole = pieces.where("rec > 0").join(tails, [*SPLIT, "rec"], "left").join(
        placed.select(*SPLIT, "offset").join(files, "file"), SPLIT)
    text = F.concat(F.col("text"), F.coalesce(F.concat(F.lit("\n"), "tail"), F.lit("")))
    number = F.col("offset") + F.col("rec")
    return whole.select("file", number.alias("record_no"), (F.col("earlier") + number).alias("onward_no"),
                        F.regexp_replace(text, "\r$", "").alias("record"))


def header(rows: DataFrame) -> list[str]:
    """The column names of the files: the first record of the first one. All files must have the same."""
    heads = rows.where("record_no = 1")
    first = heads.orderBy("file").select("file", "record").first()
    if first is None:
        return []
    other = heads.where(F.col("record") != first["record"]).orderBy("file").first()
    if other is not None:
        raise ValueError(f"{other['file']}: its header differs from that of {first['file']}")
    cells = rows.sparkSession.range(1).select(F.from_csv(F.lit(first["record"]), F.lit(", ".join(
        f"c{i} string" for i in range(first["record"].count(",") + 1))), {"quote": '"', "escape": '"'}).alias("c")).first()["c"]
    names = [c for c in cells if c is not None]
    if len(names) != len(set(names)):
        raise ValueError(f"{first['file']}: column names repeat: {names}")
    return names


def cells(rows: DataFrame, names: list[str]) -> DataFrame:
    """(file, record_no, onward_no, cells struct<names...>, malformed): the records cut into cells; ``malformed`` is
    the record itself where it has too few or too many cells."""
    bad = "_malformed"
    while bad in names:
        bad += "_"
    quoted = ["`" + n.replace("`", "``") + "` string" for n in [*names, bad]]
    parsed = F.from_csv("record", F.lit(", ".join(quoted)),
                        {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    # an empty line is no record
    return rows.where("record_no > 1 AND record <> ''").select("file", "record_no", "onward_no", parsed.alias("p")).select(
        "file", "record_no", "onward_no", F.struct(*[F.col("p").getField(n).alias(n) for n in names]).alias("cells"),
        F.col("p").getField(bad).alias("malformed"))
