"""File sources: TSV corpus (S5), target list CSV.

``scan_corpus`` and ``scan_targets`` read the same files line by line and tell the rows that
don't fit from those that do: each line is parsed once and gets a reason, null for a good one;
the good rows and the quarantine (line, reason, file) are two selections of that one scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORPUS_SCHEMA = "id string, document string, label string"
TARGET_SCHEMA = "ticker string, price double, target_price double"
# Characters a line-based reader treats as line or field breaks; replaced by a
# space before a document is written as one TSV field.
BREAKS = r"[\t\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

_TSV = dict(sep="\t", quote="", escape="", ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False)


def write_corpus(corpus: DataFrame, path: str) -> None:
    (corpus.select(F.col("id").cast("string"), F.regexp_replace("document", BREAKS, " ").alias("document"),
                   F.col("label").cast("string"))
     .write.options(**_TSV).option("header", True).csv(path))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 TSV, header line dropped, split on tab; every field a string."""
    return (spark.read.options(**_TSV).option("header", True).option("encoding", "UTF-8")
            .schema(CORPUS_SCHEMA).csv(path))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header ticker, price, target_price."""
    return spark.read.option("header", True).schema(TARGET_SCHEMA).csv(path)


def _lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(line, file) of every line but headers, whatever the folder depth."""
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", "\r$", "")
    return text.select(line.alias("line"), F.col("_metadata.file_path").alias("file")).where((F.col("line") != "") & (F.col("line") != header))


def _parted(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    return rows.where("reason IS NULL").select(*fields), rows.where("reason IS NOT NULL").select("line", "reason", "file")


def scan_corpus(spark: SparkSession, path: str, labels: tuple[str, ...] = ("0", "1")) -> tuple[DataFrame, DataFrame]:
    """S5 with a quarantine: (good rows, rejected lines). A line is rejected for its number of
    ``fields``, its ``encoding`` (a replacement character), an empty ``id`` or an unknown ``label``."""
    part = F.split("line", "\t", -1)
    rows = _lines(spark, path, "id\tdocument\tlabel").withColumn("p", part)
    p = F.col("p")
    reason = (F.when(F.size(p) != 3, "fields").when(F.col("line").contains("\ufffd"), "encoding").when(F.trim(p[0]) == "", "id")
              .when(~p[2].isin(*labels), "label"))
    return _parted(rows.select("line", "file", reason.alias("reason"), F.get(p, 0).alias("id"), F.get(p, 1).alias("document"), F.get(p, 2).alias("label")),
                   ["id", "document", "label"])


def scan_targets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S7 with a quarantine: (good rows, rejected lines). A line is rejected for its number of
    ``fields``, an empty ``ticker`` or a price that is no ``number``."""
    names = ["ticker", "price", "target_price"]
    rows = _lines(spark, path, ",".join(names)).withColumn("c", F.from_csv("line", "ticker string, price string, target_price string, over string"))
    # a field too few leaves the last one null, one too many fills the one after it
    n = F.size(F.split(F.regexp_replace("line", r'"(?:[^"]|"")*"', "q"), ",", -1))
    price, target = F.col("c.price").try_cast("double"), F.col("c.target_price").try_cast("double")
    reason = (F.when(n != 3, "fields").when(F.coalesce(F.trim("c.ticker"), F.lit("")) == "", "ticker")
              .when(price.isNull() | target.isNull(), "number"))
    return _parted(rows.select("line", "file", reason.alias("reason"), F.col("c.ticker").alias("ticker"), price.alias("price"), target.alias("target_price")), names)
