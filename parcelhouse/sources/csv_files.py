"""The nine CSV files as raw tables.

Files are read as text columns and named by their header, then typed by the declared
schema. Each table's path may be a file, a folder or a pattern of many files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from parcelhouse.tables import TABLES, shaped

# The texts pandas reads as missing by default, and the NULL mark of bulk loads.
MISSING = (
    "\\N",
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MOMENT = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
QUOTING = {"quote": '"', "escape": '"'}

# A quote opens a text only where a field starts; anywhere else it is an ordinary character.
# Inside a text two quotes stand for one. Possessive groups keep long texts off the stack.
_TEXT = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_TEXT}"[^,]*+|[^",][^,]*+|),)*+'
OPENS_TEXT = rf'^\ufeff?+{_FIELDS}"{_TEXT}\z'
KEEPS_TEXT_OPEN = rf'^{_TEXT}(?:\z|"[^,]*+,{_FIELDS}"{_TEXT}\z)'

# Lines are judged in runs of at most this many: no more than a window of Spark's keeps as plain
# rows (spark.sql.windowExec.buffer.in.memory.threshold); more would go through a sorter each.
RUN_BITS = 12

# The longest text a row of the source's database can hold, one byte less than 1 GiB. A record
# longer than that in whole splits is an error there as well: its quote was never closed.
MOST_RECORD_CHARACTERS = 1024 ** 3 - 1


@dataclass(frozen=True)
class CsvSpec:
    """Where a raw table's file is, which headers to correct, and whether texts are known to
    span lines. In other tables this is looked up in the file."""

    pattern: str
    rename: dict[str, str] = field(default_factory=dict)
    multiline: bool = False


# File names (after the publisher's prefix) and the two misspelt headers.
CSV_FILES = {
    "customers": CsvSpec("*customers_dataset.csv"),
    "sellers": CsvSpec("*sellers_dataset.csv"),
    "category_translation": CsvSpec("product_category_name_translation.csv"),
    "products": CsvSpec(
        "*products_dataset.csv",
        rename={
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        },
    ),
    "geolocation": CsvSpec("*geolocation_dataset.csv"),
    "orders": CsvSpec("*orders_dataset.csv"),
    "order_items": CsvSpec("*order_items_dataset.csv"),
    "order_payments": CsvSpec("*order_payments_dataset.csv"),
    "order_reviews": CsvSpec("*order_reviews_dataset.csv", multiline=True),
}


class CsvTables(dict):
    """The raw tables of a folder of CSV files, each opened when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = raw_table(self.spark, name, f"{self.folder}/{CSV_FILES[name].pattern}")
        return self[name]


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the file, without a byte order mark."""
    return spark.read.options(header=True, multiLine=False, **QUOTING).csv(path).columns


def raw_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One raw table from its CSV, in declared columns and types.

    A column the file lacks is an error; one it has in addition is left out.
    """
    spec = CSV_FILES[name]
    long = spec.multiline or spans_lines(spark, path)
    texts = (long_records if long else plain_records)(spark, path)
    return typed(texts.withColumnsRenamed(spec.rename), f"raw.{name}")


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether any quoted text may go on in the next line.

    If no line opens a text without closing it, every line is a record. This reads the file
    once more and stops at the first such line; putting lines together would shuffle it all.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.where(F.col("value").rlike(OPENS_TEXT)).isEmpty()


def plain_records(spark: SparkSession, path: str) -> DataFrame:
    """One record per line, read in splits. A line that does not fit the header is an error."""
    schema = ", ".join(f"`{c}` string" for c in header(spark, path))
    options = {"header": True, "mode": "FAILFAST", "enforceSchema": False, **QUOTING}
    return spark.read.schema(schema).options(**options).csv(path)


def long_records(
    spark: SparkSession, path: str, most_characters: int = MOST_RECORD_CHARACTERS
) -> DataFrame:
    """Records whose quoted texts may hold line breaks, still read in splits.

    Spark's own multiLine option gives a whole file to one task. Here lines are read in
    splits as usual and put together again: a line starts a record if no text is open before
    it. What a line does to an open or closed text is known from the line alone, so splits are
    cut into short runs of lines, each run is gone through for both states it may begin in, and
    the true one follows from the earlier runs, one row per run.

    What follows the closing quote of a field up to the next comma is kept with its quotes.
    """
    columns = header(spark, path)
    lines = (
        spark.read.option("lineSep", "\n").text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.col("value").rlike(OPENS_TEXT).cast("int").alias("after_0"),
            F.col("value").rlike(KEEPS_TEXT_OPEN).cast("int").alias("after_1"),
        )
        .withColumn("split", F.struct("block", F.shiftright("line", RUN_BITS).alias("run")))
        .drop("block")
    )
    # A run lies within a split, so it is also at most spark.sql.files.maxPartitionBytes long.
    in_split = Window.partitionBy("file", "split").orderBy("line")
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = _open_before(lines, in_split).withColumns({
        # Records begun so far in this run, if it starts outside (0) or inside (1) a text.
        "begun_0": F.count_if(F.col("before_0") == 0).over(upto),
        "begun_1": F.count_if(F.col("before_1") == 0).over(upto),
    })

    def at_end(begin: int) -> Column:
        after = F.when(F.col(f"before_{begin}") == 0, F.col("after_0")).otherwise(F.col("after_1"))
        return F.max_by(after, "line").alias(f"after_{begin}")

    splits = local.groupBy("file", "split").agg(
        at_end(0), at_end(1),
        F.max("begun_0").alias("all_0"), F.max("begun_1").alias("all_1"),
        F.sum(F.length("value") + 1).alias("characters"),
    )
    in_file = Window.partitionBy("file").orderBy("split")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.when(F.col("before_0") == 0, F.col("all_0")).otherwise(F.col("all_1"))
    # Characters of the runs that lie wholly within the record open at their end.
    last_start = F.last(F.when(F.col("begun") > 0, F.col("total")), ignorenulls=True).over(so_far)
    whole = F.col("total") - F.coalesce(last_start, F.lit(0))
    message = F.concat(F.lit("a quoted text is never closed: "), "file")
    starts = (
        _open_before(splits, in_file)
        .withColumns({"begun": begun, "total": F.sum("characters").over(so_far)})
        .withColumn("offset", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
        .withColumn("offset", F.when(whole > most_characters, F.raise_error(message))
                    .otherwise(F.col("offset")))
        .select("file", "split", F.col("before_0").alias("inside"), "offset")
    )
    here = F.when(F.col("inside") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))
    numbered = local.join(starts, ["file", "split"]).withColumn("record", F.col("offset") + here)

    def joined(place: str, text: str) -> Column:
        in_order = F.array_sort(F.collect_list(F.struct(place, text)))
        return F.array_join(F.transform(in_order, lambda t: t[text]), "\n")

    # One shuffle, then lines become one text per run and these the record, so what is held
    # line by line is never more than a run.
    records = (
        numbered.repartition("file", "record")
        .groupBy("file", "record", "split").agg(joined("line", "value").alias("part"))
        .groupBy("file", "record").agg(joined("split", "part").alias("text"))
        .withColumn("text", F.regexp_replace("text", "\r$", ""))
        .where("text <> ''")
    )
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"mode": "FAILFAST", "multiLine": "true", **QUOTING}
    parsed = records.select("file", "record", F.from_csv("text", schema, options).alias("r"))
    # The first record of each file is its header, which must be that of the first file.
    found = F.concat_ws(",", *[F.col("r").getField(c) for c in columns])
    same = F.regexp_replace(found, "^\ufeff", "") == ",".join(columns)
    message = F.concat(F.lit("other columns than in the first file: "), "file")
    is_header = F.when(F.col("record") > 1, False).when(same, True).otherwise(F.raise_error(message))
    return parsed.where(~is_header).select("r.*")


def _open_before(parts: DataFrame, window: WindowSpec) -> DataFrame:
    """Add before_0 and before_1: is a text open (1) before this part, if none is (0) or one
    is (1) before the window's first part?

    after_0 and after_1 say the same of the end of each part. A part where both agree settles
    the state whatever came before; since then only the parts that turn it count.
    """
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = F.when(F.col("after_0") > F.col("after_1"), 1).otherwise(0)
    settled = F.when(F.col("after_0") == F.col("after_1"), (F.col("after_0") + F.col("turns")) % 2)
    known = F.last("settled", ignorenulls=True).over(earlier)
    turned = F.coalesce(F.lag("turns").over(window), F.lit(0))
    return (
        parts.withColumn("turns", F.sum(turn).over(upto)).withColumn("settled", settled)
        .withColumns({
            f"before_{begin}": (F.coalesce(known, F.lit(begin)) + turned) % 2 for begin in (0, 1)
        })
        .drop("turns", "settled")
    )


def _value(name: str, kind: str) -> Column:
    text = F.when(~F.col(name).isin(*MISSING), F.col(name))
    if kind == "timestamp_ntz":
        # A moment that cannot be read counts as missing.
        return F.when(text.rlike(MOMENT), text.try_cast("timestamp_ntz"))
    if kind in ("int", "bigint"):
        # Whole numbers with missing values are often exported as 40.0 or 4e1.
        number = text.cast("decimal(38,18)")
        message = F.concat(F.lit(f"{name} is not a whole number: "), text)
        # The cast rounds to 18 places, so the text is looked at as well: plain decimals, and a
        # number with an exponent that has become 0 without being 0.
        decimals = text.rlike(r"^[^eE]*\.\d*[1-9]\d*\s*$")
        vanished = (number == 0) & text.rlike(r"^[^eE]*[1-9][^eE]*[eE]")
        broken = (number != F.floor(number)) | decimals | vanished
        return F.when(broken, F.raise_error(message)).otherwise(number).cast(kind)
    return text.cast(kind)


def typed(texts: DataFrame, name: str) -> DataFrame:
    """Text columns to declared types; a generated id where the file has none."""
    columns = [c for c in TABLES[name].columns if c.name != "geolocation_id"]
    values = texts.select(*[_value(c.name, c.type).alias(c.name) for c in columns])
    if len(columns) < len(TABLES[name].columns):
        values = values.withColumn("geolocation_id", F.monotonically_increasing_id())
    return shaped(values, name)


def write_csv(tables, folder: str, names=tuple(CSV_FILES)) -> str:
    """Raw tables as CSV files in the layout read above, misspelt headers included."""
    for name in names:
        spec = CSV_FILES[name]
        wrong = {right: header_name for header_name, right in spec.rename.items()}
        path = f"{folder}/{spec.pattern.replace('*', '')}"
        df = tables[name].drop("geolocation_id").withColumnsRenamed(wrong)
        (
            df.write.option("header", True).options(**QUOTING)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
        )
    return folder
