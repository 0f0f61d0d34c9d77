"""CSV sources of the enrichment (header row, comma separated, surrounding spaces ignored).

S3 orders, S4 order items, S5 products. All columns are read as text (no inference pass over the data)
and found by the names in the header of their own file: the files of a folder may order their columns
differently. Quoted values may hold commas, doubled quotes and line breaks, and still a file is read by as many tasks as it has byte
ranges: a first pass counts the quotes of each range, so that the second knows which ranges start inside a value.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import blank_to_null, parse_amount, parse_purchase_ts
from cartwheel.operators.enrichment import enrich_orders
from cartwheel.session import use_utc
from cartwheel.sources import csv_ranges
from cartwheel.sources.csv_ranges import QUOTE, RECORDS, Range, cut_records

cloudpickle.register_pickle_by_value(sys.modules[csv_ranges.__name__])

# File names and the columns read from them.
ORDERS_FILE = "olist_orders_dataset.csv"
ITEMS_FILE = "olist_order_items_dataset.csv"
PRODUCTS_FILE = "olist_products_dataset.csv"
ORDERS_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
ITEMS_COLUMNS = ["order_id", "product_id", "seller_id", "price", "freight_value"]
PRODUCTS_COLUMNS = ["product_id", "product_category_name"]


# An odd run of quotes that neither begins nor ends a value: a value that is not quoted has quotes in it.
_STRAY = r'(?<=[^\s,"])"(?:"")*+(?!")(?!\s*(?:,|$))'
_OPTIONS = {"header": "false", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE", "quote": QUOTE, "escape": QUOTE}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines (line feeds only; a carriage return stays), their file and the start of their byte range, and a key of the two."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))
    return lines.withColumn("key", F.xxhash64("file", "block"))


@dataclass
class Files:
    """What a first pass over the byte ranges of some files found. A byte range doesn't know whether it starts inside a quoted
    value; whether the number of quotes before it in its file is odd says it."""
    ranges: dict[int, Range]
    heads: list[str]        # the different header records
    uncut: list[str]        # files with quotes inside of values that are not quoted: quotes say nothing there


def range_counts(spark: SparkSession, path: str) -> DataFrame:
    """A row for each byte range: whether its quotes are odd in number, whether some are stray, and its first line if it begins a file."""
    # most lines have no quote: these need no search
    quoted = F.contains("value", F.lit(QUOTE))
    quotes = F.when(quoted, F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))).otherwise(0)
    stray = F.when(quoted & F.col("value").rlike(_STRAY), True)
    # a byte range is read by one task, line by line, so its first line is the first that is met
    head = F.first(F.when((F.col("block") == 0) & (F.trim("value") != ""), F.col("value")), ignorenulls=True)
    # with a set among the aggregates Spark hashes by range; without, it would sort all lines for the text of the head
    return (_lines(spark, path).groupBy("key", "file", "block")
            .agg((F.sum(quotes) % 2).alias("odd"), F.size(F.collect_set(stray)).alias("stray"), head.alias("head")))


def first_pass(spark: SparkSession, path: str) -> Files:
    found = range_counts(spark, path).orderBy("file", "block").collect()       # as many rows as the job has input splits
    odd, heads, uncut = {}, {}, set()
    for r in found:
        odd[r.file] = odd.get(r.file, 0) ^ r.odd
        if r.head is not None:
            heads[r.file] = r.head
        if r.stray or r.head and r.head.count(QUOTE) % 2:
            uncut.add(r.file)
    uncut |= {f for f, n in odd.items() if n}
    number = {h: k for k, h in enumerate(sorted({h for f, h in heads.items() if f not in uncut}))}
    place = {f: k for k, f in enumerate(sorted(odd))}
    ranges, before = {}, {}
    for r in found:
        ranges[r.key] = Range(place[r.file], r.block, -1 if r.file in uncut else number.get(heads.get(r.file), -1), bool(before.get(r.file, 0)))
        before[r.file] = before.get(r.file, 0) ^ r.odd
    if len(ranges) < len(found):
        raise ValueError("two byte ranges with one key")
    return Files(ranges, list(number), sorted(uncut))


def records(spark: SparkSession, path: str, files: Files) -> DataFrame:
    """The records as text: (file, block, head, n, record), in file order by file, block and n; without those of files that can't be cut. Every byte
    range is cut on its own. Of a record that goes on in later ranges each gives its part, and the parts, at most two for a range, are put
    together. The path has to be read as in the first pass, so that the ranges are the same."""
    # one entry for each input split; plain tuples, as executors need not have the package
    shared = spark.sparkContext.broadcast({key: tuple(r) for key, r in files.ranges.items()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_records(batches, shared.value)

    parts = _lines(spark, path).select("key", F.concat("value", F.lit("\n")).alias("line")).mapInArrow(cut, RECORDS).where("head >= 0")
    whole = parts.where("begins AND ends").select("file", "block", "head", "n", "record")
    if not any(r.inside for r in files.ranges.values()):
        return whole        # no record goes on in another range
    order = Window.partitionBy("file").orderBy("block", "n")
    broken = parts.where("NOT (begins AND ends)").withColumn("first", F.sum(F.col("begins").cast("int")).over(order))
    joined = (broken.groupBy("file", "head", "first").agg(F.sort_array(F.collect_list(F.struct("block", "n", "record"))).alias("p"))
              .select("file", F.col("p")[0]["block"].alias("block"), "head", F.col("p")[0]["n"].alias("n"), F.array_join(F.col("p.record"), "").alias("record")))
    return whole.unionByName(joined)


def _names(header: str) -> list[str]:
    """The column names of a header record."""
    return [c.strip() for c in next(csv.reader([header.lstrip("\ufeff").rstrip("\r")], skipinitialspace=True), [])]


def _read_csv(spark: SparkSession, path: str, columns: list[str], position: str | None = None) -> DataFrame:
    """The named columns of all files, as text. A file of any size is read by many tasks. ``position`` names a column for the place of a
    record in the input (file, byte range, number in it).

    Files that have quotes inside of values that are not quoted can't be cut; each of these is read by one task, and comes last."""
    files = first_pass(spark, path)
    place = [F.struct("file", "block", "n").alias(position)] if position else []
    parts = []
    if files.heads:
        names = [_names(h) for h in files.heads]
        if missing := [c for c in columns if any(c not in own for own in names)]:
            raise ValueError(f"columns {missing} are not in every file of {path}")
        schema = ", ".join(f"c{k} string" for k in range(max(map(len, names))))
        # without its line end; a record has one line feed at its end, or none
        text = F.when(F.endswith("record", F.lit("\r\n")), F.regexp_replace("record", r"\r\n\z", "")).otherwise(F.expr(r"rtrim('\n', record)"))
        row = F.from_csv(text, schema, _OPTIONS)
        # the parsed record comes out of a generator: it is not put into every field reference, which would parse it again for each
        body = (records(spark, path, files).where(~((F.col("block") == 0) & (F.col("n") == 0)))
                .select("file", "block", "n", "head", F.inline(F.array(row))))

        def value(c: str):
            cases = [(own.index(c), k) for k, own in enumerate(names)]
            if len({at for at, _ in cases}) == 1:
                return F.col(f"c{cases[0][0]}")
            return F.coalesce(*(F.when(F.col("head") == k, F.col(f"c{at}")) for at, k in cases))

        parts.append(body.select(*(value(c).alias(c) for c in columns), *place))
    for k, file in enumerate(files.uncut):
        whole = spark.read.options(**{**_OPTIONS, "header": "true", "multiLine": "true", "inferSchema": "false"}).csv(unquote(file))
        whole = whole.select(*columns, F.lit(1_000_000_000 + k).alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("n"))
        parts.append(whole.select(*columns, *place))
    if not parts:
        kind = [f"{position} struct<file:int,block:long,n:long>"] if position else []
        return spark.createDataFrame([], ", ".join([*(f"{c} string" for c in columns), *kind]))
    return reduce(DataFrame.unionByName, parts)


def read_orders(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """S3 + P7: orders whose purchase time is missing or unparsable are skipped."""
    use_utc(spark)
    raw = _read_csv(spark, path, ORDERS_COLUMNS, position)
    return (raw.withColumn("order_purchase_timestamp", parse_purchase_ts(F.col("order_purchase_timestamp")))
               .where(F.col("order_purchase_timestamp").isNotNull()))


def read_items(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """S4 + P8: a bad or missing price/freight becomes 0."""
    raw = _read_csv(spark, path, ITEMS_COLUMNS, position)
    return raw.withColumns({"price": parse_amount(F.col("price")), "freight_value": parse_amount(F.col("freight_value"))})


def read_products(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """An empty category means absent."""
    raw = _read_csv(spark, path, PRODUCTS_COLUMNS, position)
    return raw.withColumn("product_category", blank_to_null(F.col("product_category_name"))).drop("product_category_name")


def enriched_events_from_csv(spark: SparkSession, data_dir: str, sort: bool = True, positions: bool = False) -> DataFrame:
    """The enrichment over a folder holding the three CSV files, by input position: of rows with one product id the last
    with a category counts, and events of one time stay in the order of their orders and items."""
    d = data_dir.rstrip("/")
    return enrich_orders(read_orders(spark, f"{d}/{ORDERS_FILE}", "order_position"),
                         read_items(spark, f"{d}/{ITEMS_FILE}", "item_position"),
                         read_products(spark, f"{d}/{PRODUCTS_FILE}", "product_position"), sort=sort, positions=positions)
