"""CSV exports: read every column as text, probe the encoding, write back.

Spark never fails on bad UTF-8 (it substitutes U+FFFD), so the encoding
fallback is decided by a distributed probe instead of by a decode error:
one aggregate over the raw lines tells for every file whether its bytes are
valid UTF-8, and, if not, whether they hold a byte windows-1252 leaves undefined.

Spark reads and writes windows-1252 only under a legacy session setting, so no
plan here rests on it: such files are read as ISO-8859-1, in which every byte is a
character, and the 27 characters that differ are translated (the inverse before
writing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# bytes with no character in windows-1252 (decoding them fails, so latin-1 is next)
CP1252_UNDEFINED = ("81", "8D", "8F", "90", "9D")
# bytes that are control characters in ISO-8859-1 and printed ones in windows-1252
_C1 = [chr(b) for b in range(0x80, 0xA0) if f"{b:02X}" not in CP1252_UNDEFINED]
_PRINTED = [c.encode("latin-1").decode("cp1252") for c in _C1]
# texts a CSV reader of the reference's stack reads as "no value" (fixed values,
# the pandas default NA strings)
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


# columns a read adds to those of the files
BOOKKEEPING = ("_source_file", "_file_path", "_block_start", "_row_in_split")


def spark_charset(encoding: str) -> str:
    """The charset that Spark reads and writes files of ``encoding`` in."""
    return "ISO-8859-1" if is_cp1252(encoding) else encoding


def is_cp1252(encoding: str) -> bool:
    return encoding.lower().replace("_", "-") in ("windows-1252", "cp1252")


def from_latin1(c: Column) -> Column:
    """windows-1252 text whose bytes were read as ISO-8859-1 (ASCII text is the same in both)."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(c, "".join(_C1), "".join(_PRINTED)))


def to_latin1(c: Column) -> Column:
    """Text that has the bytes of windows-1252 when written as ISO-8859-1.  Control
    characters that windows-1252 has no byte for become question marks.  (ASCII text stays.)"""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(
        F.translate(c, "".join(_PRINTED + _C1), "".join(_C1) + "?" * len(_C1)))


def renamed_latin1(names: list[str]) -> list[str]:
    table = str.maketrans("".join(_C1), "".join(_PRINTED))
    return [n.translate(table) for n in names]


def data_columns(df: DataFrame) -> list[str]:
    """The columns the files themselves have."""
    return [c for c in df.columns if c not in BOOKKEEPING]


def text_lines(reader, path) -> DataFrame:
    """Lines of the files under ``path`` with what tells about their file; ``reader`` is
    ``spark.read`` or ``spark.readStream``."""
    return reader.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_block_start").alias("block"), "value")


def file_facts(lines: DataFrame) -> DataFrame:
    """(file, bytes, modified, encoding, header) of the files whose lines these are, in
    one pass: encoding is 'UTF-8', 'windows-1252' or 'ISO-8859-1', header the first line."""
    lines = lines.withColumns({"pos": F.monotonically_increasing_id(), "ok": F.is_valid_utf8("value")})
    # the text source keeps the raw bytes: look for an undefined byte in the lines that
    # are not UTF-8, read with every byte as one character
    pattern = "[" + "".join(f"\\x{b}" for b in CP1252_UNDEFINED) + "]"
    bad = ~F.col("ok") & F.decode(F.col("value").cast("binary"), "ISO-8859-1").rlike(pattern)
    first = F.col("block") == 0
    # the header is a value of any length, which a plain hash aggregate cannot hold:
    # on its own it would sort all lines by file.  collect_set makes it an object-hash
    # aggregate, which holds one header per file of the task
    per = lines.groupBy("file").agg(
        F.first("bytes").alias("bytes"), F.first("modified").alias("modified"),
        (~F.array_contains(F.collect_set("ok"), False)).alias("ok"), F.max(F.when(~F.col("ok"), bad)).alias("bad"),
        F.min_by(F.when(first, F.col("value").cast("binary")), F.when(first, F.col("pos"))).alias("raw"))
    encoding = F.when(F.col("ok"), "UTF-8").when(F.col("bad"), "ISO-8859-1").otherwise("windows-1252")
    latin = F.decode("raw", "ISO-8859-1")
    header = (F.when(encoding == "UTF-8", F.decode("raw", "UTF-8")).when(encoding == "windows-1252", from_latin1(latin)).otherwise(latin))
    return per.select("file", "bytes", "modified", encoding.alias("encoding"), header.alias("header"))


def probe_encoding(spark: SparkSession, path) -> str:
    """The one encoding that reads all files under ``path``."""
    found = {r[0] for r in file_facts(text_lines(spark.read, path)).select("encoding").distinct().collect()}
    return next((e for e in ("ISO-8859-1", "windows-1252") if e in found), "UTF-8")


def read_csv(spark: SparkSession, path, encoding: str | None = None,
             with_lineage: bool = False, multiline: bool = False) -> DataFrame:
    """Header row, every column as string (no inference pass), common
    'no value' texts as null; a quote inside a quoted value is doubled.
    ``encoding=None`` probes the files first.  ``multiline`` allows line breaks
    inside quoted values; a file is then read by one task, so it is off unless
    asked for."""
    enc = encoding or probe_encoding(spark, path)
    df = (spark.read.option("header", True).option("inferSchema", False)
               .option("encoding", spark_charset(enc)).option("multiLine", multiline)
               .option("quote", '"').option("escape", '"')
               .option("mode", "PERMISSIVE").csv(path))
    names = renamed_latin1(df.columns) if is_cp1252(enc) else df.columns
    text = [from_latin1(F.col(f"`{c}`")) if is_cp1252(enc) else F.col(f"`{c}`") for c in df.columns]
    df = df.select(*[F.when(t.isin(*NULL_TEXTS), F.lit(None)).otherwise(t).alias(n) for t, n in zip(text, names)],
                   F.col("_metadata.file_name").alias("_source_file"),
                   F.col("_metadata.file_path").alias("_file_path"),
                   F.col("_metadata.file_block_start").alias("_block_start"))
    # file order: (file, split start, position inside the split)
    df = df.withColumn("_row_in_split", F.monotonically_increasing_id())
    if not with_lineage:
        return df
    return df.withColumn("loaded_at", F.current_timestamp())


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite", compression: str = "none",
              level: str = "BEST_SPEED") -> str:
    """Directory of CSV part files with a header row, no index column.  ``compression``
    "gzip" takes a fifth of the disk; such a file is read by one task.  ``level`` of gzip:
    the fastest takes half the time of the default, for a fifth more bytes."""
    if is_cp1252(encoding):
        back = str.maketrans("".join(_PRINTED), "".join(_C1))
        df = df.select(*[to_latin1(F.col(f"`{c}`").cast("string")).alias(c.translate(back)) for c in df.columns])
    (df.write.mode(mode).option("header", True).option("encoding", spark_charset(encoding)).option("compression", compression)
       .option("zlib.compress.level", level)
       .option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
