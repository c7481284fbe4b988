"""CSV scan, batch manifest, lineage stamp, reconciliation and file checks."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from ..functions.frames import union_all
from .layout import MULTILINE, columns_of, schema_of
from .records import records
from .scratch import Scratch
from .storage import PACKED

BAD_RECORD = "_bad_record"
EXPONENT = r"^[+-]?(?=\.?[0-9])[0-9]*(\.[0-9]*)?[eE][+-]?[0-9]{1,3}$"


def plain_number(kind: DecimalType) -> str:
    """Texts that the type holds without rounding: trailing zeros are free."""
    whole, places = kind.precision - kind.scale, kind.scale
    return rf"^[+-]?(?=\.?[0-9])0*[0-9]{{0,{whole}}}(\.[0-9]{{0,{places}}}0*)?$"


def _fits(f: StructField) -> Column:
    """Whether a decimal column holds its text without rounding; texts with an exponent are
    compared with a wider decimal."""
    text = F.col(f.name)
    wide = text.try_cast("decimal(38,18)")
    return text.rlike(plain_number(f.dataType)) | F.coalesce(
        text.rlike(EXPONENT) & (wide == text.try_cast(f.dataType)), F.lit(False))


def _as_text(schema: StructType) -> StructType:
    """Decimals as the text of the file, because a parser would round them."""
    out = StructType()
    for f in schema.fields:
        out.add(f.name, StringType() if isinstance(f.dataType, DecimalType) else f.dataType)
    return out


def _numbers(schema: StructType, otherwise) -> list:
    """The columns of `schema`, with decimals from their texts; `otherwise(field)` for a text
    that does not fit."""
    return [F.when(F.col(f.name).isNull() | _fits(f), F.col(f.name).try_cast(f.dataType))
            .otherwise(otherwise(f)).alias(f.name)
            if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in schema.fields]


def _unfit(schema: StructType):
    """Name and text of the first decimal that does not fit, or NULL."""
    found = [F.when(~_fits(f), F.concat(F.lit(f"{f.name}="), F.col(f.name)))
             for f in schema.fields if isinstance(f.dataType, DecimalType)]
    return F.coalesce(*found, F.lit(None).cast("string"))


def scan_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False,
             encoding: str = "UTF-8") -> DataFrame:
    """Declared schema, header required to match it, any bad record fails the read, and so
    does a number that its column would round."""
    read = (
        spark.read.schema(_as_text(schema))
        .option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
        .option("escape", '"').option("multiLine", multiline).option("encoding", encoding)
        .csv(path)
    )
    return read.select(*_numbers(schema, lambda f: F.raise_error(F.concat(
        F.lit(f"malformed {f.name}: "), F.col(f.name))).cast(f.dataType)))


def scan_table(spark: SparkSession, path: str, table: str,
               encoding: str = "UTF-8") -> DataFrame:
    return scan_csv(spark, path, schema_of(table), table in MULTILINE, encoding)


def parse_table(spark: SparkSession, path: str | list[str], table: str,
                encoding: str = "UTF-8") -> DataFrame:
    """Every column as declared, where the row came from, and the text of a record that does
    not fit the declaration.  Write it before use: a scan of some columns parses only those.

    Line breaks in fields keep no file together in one task if its encoding is UTF-8.
    """
    schema = schema_of(table)
    wide = _as_text(schema).add(BAD_RECORD, StringType())
    if table in MULTILINE and encoding.upper() in ("UTF-8", "UTF8", "US-ASCII"):
        read = _split_scan(spark, path, table, wide)
    else:
        read = (
            spark.read.schema(wide)
            .option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD).option("escape", '"')
            .option("multiLine", table in MULTILINE).option("encoding", encoding)
            .csv(path).select("*", F.col("_metadata.file_path").alias("_source_uri")))
    bad = F.coalesce(BAD_RECORD, _unfit(schema))
    return read.select(*_numbers(schema, lambda f: F.lit(None).cast(f.dataType)),
                       bad.alias(BAD_RECORD), "_source_uri")


def _split_scan(spark: SparkSession, path: str | list[str], table: str,
                wide: StructType) -> DataFrame:
    """Records put together by many tasks, each parsed alone.  A file whose header differs
    from the declaration shows it as a bad record."""
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": BAD_RECORD}
    names = ",".join(columns_of(table))
    every = records(spark, path, Scratch(spark, "records").save)
    is_header = (F.col("block") == 0) & (F.col("record") == 1)
    as_declared = F.regexp_replace(F.regexp_replace("text", "^\ufeff", ""), '"', "") == names
    parsed = every.where(~(is_header & as_declared)).select(
        F.from_csv("text", wide.simpleString()[7:-1].replace(":", " "), options).alias("r"),
        is_header.alias("header"), "text", F.col("file").alias("_source_uri"))
    bad = F.when(F.col("header"), F.col("text")).otherwise(F.col(f"r.{BAD_RECORD}"))
    return parsed.select(*[F.col(f"r.{f.name}").alias(f.name) for f in wide.fields[:-1]],
                         bad.alias(BAD_RECORD), "_source_uri")


def stage(spark: SparkSession, paths: Mapping[str, str | list[str]],
          encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """Each table parsed once into Parquet, from a path or some files.  A table with a file
    whose header differs from the declaration is left out."""
    scratch, out = Scratch(spark, "staged"), {}
    for table, path in paths.items():
        first = path if isinstance(path, str) else path[0]
        if not header_matches(spark, first, table, encoding):
            continue
        try:
            out[table] = scratch.save(parse_table(spark, path, table, encoding), table, **PACKED)
        except (Py4JJavaError, PySparkException) as failed:  # a later file of the folder
            if "CSV header" not in str(failed):
                raise
    return out


def header_of(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    first = spark.read.option("header", True).option("escape", '"') \
        .option("encoding", encoding).csv(path)
    return [c.lstrip("﻿") for c in first.columns]


def header_matches(spark: SparkSession, path: str, table: str,
                   encoding: str = "UTF-8") -> bool:
    """Names and their order against the declaration, not against the file itself."""
    return header_of(spark, path, encoding) == columns_of(table)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: record count and an order-insensitive content sum that keeps duplicates."""
    return df.agg(F.count("*").alias("rows"),
                  F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("content_sum"))


FILE = ["table", "uri", "file_bytes", "modified"]


def listing(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """(table, uri, file_bytes, modified) of every source file, without its content."""
    found = spark.read.format("binaryFile").load(list(files.values())).select(
        "path", F.col("_metadata.file_path").alias("uri"),
        F.col("length").alias("file_bytes"), F.col("modificationTime").alias("modified"))
    return _labelled(found, files).select(*FILE)


def file_contents(staged: Mapping[str, DataFrame]) -> DataFrame:
    """(table, uri, rows, content_sum) of every file that has records, one pass a table.
    Sums of files add up to those of their table."""
    return union_all(
        df.groupBy(F.col("_source_uri").alias("uri")).agg(
            F.count("*").alias("rows"), F.sum(F.xxhash64(*columns_of(table)).cast("decimal(38,0)"))
            .alias("content_sum")).select(F.lit(table).alias("table"), "uri", "rows", "content_sum")
        for table, df in staged.items())


def digest_of(rows: str = "rows", content_sum: str = "content_sum"):
    """Digest of a count and a content sum."""
    return F.sha2(F.concat_ws(":", F.col(rows).cast("string"),
                              F.coalesce(F.col(content_sum), F.lit(0).cast("decimal(38,0)"))
                              .cast("string")), 256)


def table_manifest(each: DataFrame, paths: Mapping[str, str],
                   expected: Mapping[str, int]) -> DataFrame:
    """The rows of `manifest`, added up from those of the files."""
    names = spark_map({t: p.rsplit("/", 1)[-1] for t, p in paths.items()}, "string")
    wanted = spark_map(expected, "bigint")
    whole = each.groupBy("table").agg(
        F.sum("file_bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.sum("content_sum").cast("decimal(38,0)").alias("content_sum"))
    return whole.select(
        names.alias("file"), "table", "bytes", F.lit(None).cast("string").alias("sha256"),
        digest_of().alias("content_digest"), "rows", wanted.alias("expected_rows"),
        (F.col("rows") == wanted).alias("rows_match_expected"), "content_sum")


def spark_map(values: Mapping, kind: str):
    """The value of each row's table, or NULL."""
    out = F.lit(None).cast(kind)
    for table, value in values.items():
        out = F.when(F.col("table") == table, F.lit(value).cast(kind)).otherwise(out)
    return out


def _labelled(listing: DataFrame, files: Mapping[str, str]) -> DataFrame:
    """Table name of each listed file: its path is the table's path or lies below it."""
    label = F.lit(None).cast("string")
    for table, path in sorted(files.items(), key=lambda x: len(x[1])):  # the longest match wins
        place = re.sub(r"^[a-zA-Z]\w*:/*", "/", path.rstrip("/"))
        label = F.when(F.col("path").rlike(f"^[^:]*:/*{re.escape(place.lstrip('/'))}(/|$)")
                       | F.col("path").rlike(f"^[^:]*://[^/]*{re.escape(place)}(/|$)"),
                       table).otherwise(label)
    return listing.withColumn("table", label)


def manifest(spark: SparkSession, files: Mapping[str, str],
             expected: Mapping[str, int], byte_checksum: bool = False,
             staged: Mapping[str, DataFrame] | None = None,
             encoding: str = "UTF-8") -> DataFrame:
    """One row per table: size, content digest, true record count, expected count, match flag.

    Counts and digest come from ``staged`` tables if given, else from a scan of the files.
    The digest comes from the records, so it exists for tables of any size and any number of
    files.  ``byte_checksum`` also hashes the bytes of every file, each in one task, and fails
    for a file that a task cannot hold; several files are hashed by their sorted checksums.
    """
    listing = _labelled(spark.read.format("binaryFile").load(list(files.values())), files)
    sizes = listing.groupBy("table").agg(F.sum("length").alias("bytes"),
                                         F.count("*").alias("_files"))
    if byte_checksum:
        each = F.sort_array(F.collect_list(F.sha2("content", 256)))
        digests = listing.groupBy("table").agg(each.alias("_each")).select("table", F.when(
            F.size("_each") == 1, F.get("_each", 0)).otherwise(
            F.sha2(F.concat_ws("", "_each"), 256)).alias("sha256"))
    else:
        digests = listing.select("table", F.lit(None).cast("string").alias("sha256")).distinct()
    counts = union_all(
        fingerprint(staged[table].select(*columns_of(table)) if staged
                    else scan_table(spark, path, table, encoding)).select(
            F.lit(path.rsplit("/", 1)[-1]).alias("file"), F.lit(table).alias("table"),
            "rows", F.lit(expected.get(table)).cast("bigint").alias("expected_rows"),
            "content_sum")
        for table, path in files.items())
    return counts.join(sizes, "table", "left").join(digests, "table", "left").select(
        "file", "table", "bytes", "sha256", digest_of().alias("content_digest"), "rows",
        "expected_rows", (F.col("rows") == F.col("expected_rows")).alias("rows_match_expected"),
        "content_sum")


def stamp(df: DataFrame, batch_id: str, loaded_at: datetime, digest=None) -> DataFrame:
    """Lineage columns on every row; ``df`` reads the source files or is staged from them.
    ``digest`` is a text or a column of ``df``."""
    data = [c for c in df.columns if c not in (BAD_RECORD, "_source_uri", "_digest")]
    uri = "_source_uri" if "_source_uri" in df.columns else "_metadata.file_path"
    return df.select(
        *data,
        F.lit(batch_id).alias("_batch_id"),
        F.lit(loaded_at).alias("_loaded_at"),
        F.col(uri).alias("_source_uri"),
        (F.lit(digest) if digest is None or isinstance(digest, str) else digest)
        .cast("string").alias("_source_digest"),
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in frames.items())


def reconcile(manifest_rows: DataFrame, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Source against loaded rows per table."""
    loaded = row_counts(frames).withColumnRenamed("rows", "loaded_rows")
    delta = F.coalesce("loaded_rows", F.lit(0)) - F.col("rows")
    return (
        manifest_rows.select("table", "rows").join(loaded, "table", "left")
        .select("table", F.col("rows").alias("source_rows"), "loaded_rows",
                delta.alias("delta"),
                F.when(delta == 0, "OK").otherwise("MISMATCH").alias("status"))
    )


def acceptance(frames: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Rows of the loaded tables against the published counts."""
    wanted = F.create_map(*[F.lit(x) for t, k in expected.items() for x in (t, k)])
    read = row_counts(frames).select(
        "table", "rows", F.try_element_at(wanted, F.col("table")).cast("bigint")
        .alias("expected_rows"))
    return read.select("*", (F.col("rows") - F.col("expected_rows")).alias("delta"),
                       F.col("rows").eqNullSafe(F.col("expected_rows")).alias("accepted"))


def column_profile(table: str, df: DataFrame) -> DataFrame:
    """(table, column, rows, present, checksum): one pass, one row per declared column.

    The checksum adds up characters, seconds, cents, thousandths or whole numbers, so it does
    not depend on the order of rows.
    """
    measure = {
        "string": "length(`{c}`)", "bigint": "`{c}`", "double": "floor(`{c}` * 1000)",
        "decimal(18,9)": "`{c}` * 100",
        "timestamp_ntz": "datediff(`{c}`, date'1970-01-01') * 86400L + hour(`{c}`) * 3600"
                         " + minute(`{c}`) * 60 + second(`{c}`)",
    }
    sums, rows = ["count(*) as n"], []
    for i, f in enumerate(schema_of(table).fields):
        each = measure[f.dataType.simpleString()].format(c=f.name)
        sums += [f"count(`{f.name}`) as p{i}", f"sum(cast({each} as bigint)) as s{i}"]
        rows.append(f"named_struct('table', '{table}', 'column', '{f.name}', 'rows', n, "
                    f"'present', p{i}, 'checksum', s{i})")
    return df.selectExpr(*sums).selectExpr(f"inline(array({', '.join(rows)}))")


def compare_folders(spark: SparkSession, source: str, target: str,
                    min_share: float = 0.9) -> DataFrame:
    """Same file names on both sides, none empty, none much smaller than its source."""
    def listing(folder: str, size: str) -> DataFrame:
        name = F.element_at(F.split("path", "/"), -1)
        return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
                .select(name.alias("file"), F.col("length").alias(size)))

    pair = listing(source, "source_bytes").join(listing(target, "target_bytes"), "file",
                                                "full_outer")
    src, dst = F.col("source_bytes"), F.col("target_bytes")
    verdict = (
        F.when(dst.isNull(), "missing in target").when(src.isNull(), "not in source")
        .when((dst == 0) | (dst < src * min_share), "size mismatch").otherwise("ok"))
    return pair.select("file", src, dst, verdict.alias("status"))
