"""Reading deliveries: manifests, files, members, typed tables, audit."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import col, delivery_time

# Texts that mark a data file in its header.
MARKERS = ["NAS-Operationen", "AAA-Fachschema", "aaa.xsd", "aaa-suite", "adv/gid/7.1"]
BULK = "geaenderteObjekte"


# -- what to read ---------------------------------------------------------

def manifest(lines: DataFrame, text: str = "value", order: str | None = None) -> DataFrame:
    """Manifest lines as files and directives; blank lines and comments drop out.

    ``lines`` may come from ``spark.read.text``; ``order`` keeps the line number.
    """
    entry = F.trim(F.col(text))
    low = F.lower(entry)
    kind = F.when(low.endswith(".zip") | low.endswith(".xml.gz") | low.endswith(".xml"), "file").otherwise("directive")
    keep = [F.col(order)] if order else []
    return (lines.filter((entry != "") & ~entry.startswith("#"))
            .select(*keep, kind.alias("kind"), F.when(kind == "directive", F.split_part(low, F.lit(" "), F.lit(1))).alias("command"), entry.alias("entry")))


def has_marker(head: Column | str, markers: list[str] | None = None) -> Column:
    """True when the leading text of a file holds one of the markers."""
    head = col(head)
    found = F.lit(False)
    for m in markers or MARKERS:
        found = found | head.contains(m)
    return found


def recognised(files: DataFrame, markers: list[str] | None = None, content: str = "content") -> DataFrame:
    """Files that hold a marker before their bulk element, however long that head is; without a bulk element anywhere.

    ``files`` comes from the binaryFile source.
    """
    head = F.substring_index(F.decode(F.col(content), "ISO-8859-1"), f"<{BULK}>", 1)
    return files.filter(has_marker(head, markers))


# -- reading --------------------------------------------------------------

def read_members(spark: SparkSession, paths: list[str], row_tag: str, schema: T.StructType) -> DataFrame:
    """Members of plain and gzipped XML files; all values as text, broken members kept aside.

    ``schema`` should hold string fields and ``_corrupt_record``.
    """
    return (spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).load(paths))


def unzip(files: DataFrame, member_pattern: str = ".xml") -> DataFrame:
    """Texts inside zip archives, one row per archived file; archives are spread over tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if info.filename.lower().endswith(member_pattern):
                            yield pd.DataFrame({"path": [path], "name": [info.filename],
                                                "text": [z.read(info).decode("utf-8", "replace")]})

    return files.select("path", "content").mapInPandas(run, "path string, name string, text string")


def split_members(texts: DataFrame, text: str, tag: str, keep: list[str]) -> DataFrame:
    """One row per ``<tag>`` element of an XML text."""
    body = F.regexp_extract_all(F.col(text), F.lit(f"(?s)<{tag}[ >].*?</{tag}>"), F.lit(0))
    return texts.select(*keep, F.explode(body).alias("member"))


def parse_members(members: DataFrame, text: str, schema: str, row_tag: str = "ROW") -> DataFrame:
    """Parse XML texts to text columns plus ``_corrupt_record``."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "rowTag": row_tag}
    parsed = F.from_xml(F.col(text), f"{schema}, _corrupt_record string", opts)
    return members.withColumn("_p", parsed).select(*members.columns, "_p.*")


def good_members(parsed: DataFrame) -> DataFrame:
    return parsed.filter("_corrupt_record IS NULL").drop("_corrupt_record")


def bad_members(parsed: DataFrame) -> DataFrame:
    """Side output of members that could not be read."""
    return parsed.filter("_corrupt_record IS NOT NULL")


def tolerated(path: Column | str, pattern: str) -> Column:
    """Files that are imported even when members fail."""
    return col(path).rlike(pattern)


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns to their types; values that do not fit become null."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def feature_type(member: Column | str) -> Column:
    """Name of the first element of a member, without its namespace."""
    return F.lower(F.regexp_extract(col(member), r"<(?:\w+:)?(\w+)", 1))


def write_by_type(df: DataFrame, path: str, by: str = "type", mode: str = "append") -> None:
    """Typed rows to one folder per type; rows of a type are not forced into one task."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def replace_product(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A product is rebuilt as a whole; a rerun gives the same files."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


# -- times and audit --------------------------------------------------------

def delivery_date(content: Column | str) -> Column:
    """Delivery time from the text before and after the bulk element; null when absent.

    All that stands before the first opening and after the last closing tag is
    looked at, however long it is; the bulk between them is not.
    """
    c = col(content)
    opened, closed = c.contains(f"<{BULK}>"), c.contains(f"</{BULK}>")
    frame = F.concat(F.substring_index(c, f"<{BULK}>", 1), F.substring_index(c, f"</{BULK}>", -1))
    date = F.regexp_extract(frame, r"(?s)<AX_Portionskennung>.*?<datum>\s*([^<]+?)\s*</datum>", 1)
    seconds = F.nullif(delivery_time(date), F.lit(""))
    return F.when(opened & closed, F.concat(seconds, F.lit("Z")))


def audit_rows(files: DataFrame, path: str, ok: str, data_date: str, imported: Column) -> DataFrame:
    """One audit row per file that was imported."""
    return files.filter(F.col(ok)).select(F.col(path).alias("filename"), imported.alias("importdate"), F.col(data_date).alias("datadate"))


def progress(audit: DataFrame, total_bytes: Column) -> DataFrame:
    """Throughput summary over audit rows with ``bytes, seconds, ok``."""
    done = F.sum(F.when(F.col("ok"), F.col("bytes")).otherwise(0))
    spent = F.sum("seconds")
    return audit.agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.when(~F.col("ok"), 1).otherwise(0)).alias("errors"),
        done.alias("bytes"), (F.max(total_bytes) - done).alias("remaining"), spent.alias("seconds"),
        F.floor(done / spent).alias("bytes_per_second"))


def acknowledgements(files: DataFrame, prefixes: list[str], batch: str = "impid") -> DataFrame:
    """Acknowledgement per batch: overall flag and one entry per file.

    ``files`` has the batch id, ok, datum, portion and the header fields in
    ``prefixes``; the first filled field names the output.
    """
    prefix = F.coalesce(*[F.col(p) for p in prefixes], F.lit("quittierung"))
    # entries travel as rows of one batch, which is one delivery with its list of files
    note = F.when(F.col("ok"), "Portion ohne Fehlermeldung übernommen").otherwise("Fehlermeldungen beim Import der Portion")
    entry = F.struct(F.col("portion"), F.col("ok").alias("erfolgreich"), note.alias("uebernahmeprotokoll"))
    first = F.min_by(F.struct(prefix.alias("p"), F.translate("datum", "-:Z", "").alias("t")), F.col("portion"))
    out = files.groupBy(batch).agg(first.alias("_f"), F.bool_and("ok").alias("erfolgreich"), F.array_sort(F.collect_list(entry)).alias("portionen"))
    name = F.concat(F.col("_f.p"), F.lit("_"), F.col("_f.t"), F.lit("_NBA_Quittierung_ID_"), F.col(batch).cast("string"), F.lit(".xml"))
    return out.select(batch, name.alias("datei"), "erfolgreich", "portionen")
