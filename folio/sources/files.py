"""Landing-file formats: the raw CSV feeds and the nested JSON-lines lookup records.

Readers are shared by batch and streaming so that a file means the same thing either
way. CSV columns are all strings (typing is silver's job) and are taken by the names in
each file's own header, so files of several layouts stand side by side in one feed; a line
that does not fit its header keeps its raw text in ``_rescued_data``, and values under
headers that the feed does not know stay there as JSON. For JSON lines the rescue column
holds the raw line when it does not parse, carries keys the schema does not know, or a
value at any depth that does not fit its type.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources import storage

RESCUE = "_rescued_data"
_CORRUPT = "_folio_corrupt_line"
TECHNICAL = (RESCUE, "_source_file", "_ingested_at", "_batch")

# The raw feed layouts (header names as delivered).
CSV_COLUMNS = {
    "books": ["ISBN", "Book-Title", "Book-Author", "Year-Of-Publication", "Publisher", "Image-URL-L"],
    "ratings": ["User-ID", "ISBN", "Book-Rating"],
    "users": ["User-ID", "Age", "Location"],
}
KEY_COLUMNS = {"books": ["ISBN"], "ratings": ["User-ID", "ISBN", "Book-Rating"], "users": ["User-ID"]}
LANDING_GLOB = {"books": "Books*", "ratings": "Ratings*", "users": "Users*"}

LOOKUP_SCHEMA = T.StructType([
    T.StructField("isbn", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("found", T.BooleanType()),
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("key", T.StringType())]))),
    T.StructField("subjects", T.ArrayType(T.StringType())),
    T.StructField("number_of_pages", T.LongType()),
    T.StructField("publish_date", T.StringType()),
])

# Writing keeps values byte-exact: no trimming of surrounding spaces on write.
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def csv_schema(feed: str, names: list[str] | None = None) -> T.StructType:
    """All-string schema of a CSV feed plus the rescue column; ``names`` in the order of a file's header."""
    fields = [T.StructField(c, T.StringType()) for c in names or CSV_COLUMNS[feed]]
    return T.StructType(fields + [T.StructField(RESCUE, T.StringType())])


def _csv_options(reader, header: bool = True, escape: str | None = None):
    """Reference behaviour is Spark's default quoting (escape = backslash); ``escape='"'``
    reads RFC-4180 doubled quotes such as ``"He said ""hi"", ok"`` as one field. Columns are
    given by place, after the file's own header has been read."""
    reader = (reader.option("header", str(header).lower()).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", _CORRUPT).option("enforceSchema", "true"))
    return reader.option("escape", escape) if escape else reader


def _header_names(line: str | None, known: list[str], escape: str | None) -> tuple[str, ...]:
    """Column names of a header line: unnamed and repeated ones by their place, an empty file as the known layout."""
    if line is None:
        return tuple(known)
    quoting = {"doublequote": True} if escape == '"' else {"doublequote": False, "escapechar": "\\"}
    names: list[str] = []
    for place, name in enumerate(next(csv.reader([line], **quoting), [])):
        name = name.strip()
        names.append(name if name and name not in names else f"{name}#{place}")
    return tuple(names)


def header_index(spark: SparkSession, paths: Iterable[str], feed: str, escape: str | None = None) -> dict[tuple[str, ...], list[str]]:
    """The files by layout, from one line each. A header without a key column is an error that names the file."""
    found: dict[tuple[str, ...], list[str]] = {}
    for path, line in storage.first_lines(spark, sorted(set(paths))).items():
        names = _header_names(line, CSV_COLUMNS[feed], escape)
        missing = [c for c in KEY_COLUMNS[feed] if c not in names]
        if missing:
            raise ValueError(f"feed {feed}: the header of {path} lacks {missing}; it holds {list(names)}")
        found.setdefault(names, []).append(path)
    return found


def landing_schema(spark: SparkSession, paths: Iterable[str], feed: str, escape: str | None = None) -> T.StructType:
    """The feed's columns, then further ones of the given files' headers (those of a first delivery become columns)."""
    more = [c for names in header_index(spark, paths, feed, escape) for c in names if c not in CSV_COLUMNS[feed]]
    return csv_schema(feed, CSV_COLUMNS[feed] + list(dict.fromkeys(c for c in more if c not in TECHNICAL)))


def literal_path(path: str) -> str:
    """A path as a glob that matches nothing else."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def lineage(df: DataFrame) -> DataFrame:
    """Source file per row and ingestion time."""
    return (df.withColumn("_source_file", F.col("_metadata.file_path"))
            .withColumn("_ingested_at", F.current_timestamp()))


def _placed(names: Iterable[str]) -> T.StructType:
    fields = [T.StructField(f"c{k}", T.StringType()) for k, _ in enumerate(names)]
    return T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])


def _one_layout(spark: SparkSession, paths: list[str], names: tuple[str, ...], columns: list[str], header: bool, escape: str | None) -> DataFrame:
    """Files of one layout as the given columns (NULL where they lack one), rescue column and lineage."""
    rows = lineage(_csv_options(spark.read.schema(_placed(names)), header, escape).csv(paths))
    at = {c: F.col(f"c{k}") for k, c in enumerate(names)}
    beyond = [v.alias(c) for c, v in at.items() if c not in columns]
    rescue = F.col(_CORRUPT)
    if beyond:
        kept = F.to_json(F.struct(*beyond))
        rescue = F.coalesce(rescue, F.when(kept != "{}", kept))
    return rows.select(*[at[c].alias(c) if c in at else F.lit(None).cast("string").alias(c) for c in columns],
                       rescue.alias(RESCUE), "_source_file", "_ingested_at")


def read_csv_files(spark: SparkSession, paths: Iterable[str], feed: str, schema: T.StructType | None = None, escape: str | None = None) -> DataFrame:
    """Files of any number of layouts, each parsed by its own header, as the columns of ``schema``.

    There is one scan per layout, not per file. Values under other headers go to the rescue column as a JSON object.
    """
    columns = [f.name for f in (schema or csv_schema(feed)).fields if f.name != RESCUE]
    layouts = header_index(spark, paths, feed, escape)
    frames = [_one_layout(spark, [literal_path(p) for p in held], names, columns, True, escape) for names, held in sorted(layouts.items())]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def unknown_headers(spark: SparkSession, paths: Iterable[str], feed: str, schema: T.StructType, escape: str | None = None) -> T.StructType:
    """Headers of the files that ``schema`` lacks, as string columns."""
    known = {f.name for f in schema.fields}
    names = dict.fromkeys(c for layout in header_index(spark, paths, feed, escape) for c in layout if c not in known)
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> list[str]:
    """Data files behind a folder or glob, listed by the file source without reading them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return sorted({r.path for r in reader.load(path).select("path").collect()})


def read_csv_feed(spark: SparkSession, path: str, feed: str, header: bool = True,
                  escape: str | None = None) -> DataFrame:
    """Batch read of a CSV feed with the rescue column; columns by header name, by place without a header."""
    if not header:
        return _one_layout(spark, [path], tuple(CSV_COLUMNS[feed]), CSV_COLUMNS[feed], False, escape)
    paths = list_files(spark, path)
    return read_csv_files(spark, paths, feed, landing_schema(spark, paths, feed, escape), escape)


def stream_files(spark: SparkSession, path: str, max_files: int | None = None, archive_dir: str | None = None, recursive: bool = False) -> DataFrame:
    """New files of a folder or glob, each once, as rows (path, length); their content isn't read.

    The file source's checkpoint decides what a batch holds, so a replayed batch holds the same files.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(path).select("path", "length")


def write_csv_feed(df: DataFrame, feed: str, path: str, mode: str = "append") -> None:
    """Deliver a feed as CSV files (header row, values unchanged)."""
    df.select(*[F.col(f"`{c}`") for c in CSV_COLUMNS[feed]]).write.mode(mode).options(**CSV_WRITE).csv(path)


def _fit_pattern(kind: T.DataType) -> str:
    """Regular expression for the ``schema_of_variant`` texts of values that a type holds without loss."""
    number = r"DECIMAL\(\d+,\d+\)"
    if isinstance(kind, T.StructType):
        fields = "|".join(rf"(?:{re.escape(f.name)}|`{re.escape(f.name.replace('`', '``'))}`): {_fit_pattern(f.dataType)}" for f in kind.fields)
        own = rf"OBJECT<(?:(?:{fields})(?:, (?!>)|(?=>)))*>"
    elif isinstance(kind, T.ArrayType):
        own = rf"ARRAY<{_fit_pattern(kind.elementType)}>"
    elif isinstance(kind, (T.LongType, T.IntegerType)):
        own = "BIGINT"
    elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        own = f"BIGINT|DOUBLE|FLOAT|{number}"
    elif isinstance(kind, T.BooleanType):
        own = "BOOLEAN"
    elif isinstance(kind, T.StringType):
        own = f"STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|{number}"
    else:  # variant: anything
        own = ".*"
    return f"(?:{own}|VOID)"


def parse_json_lines(lines: DataFrame, schema: T.StructType = LOOKUP_SCHEMA, column: str = "value") -> DataFrame:
    """JSON text lines -> typed columns plus the rescue column (bad or over-wide lines).

    Each line is parsed once, to a VARIANT. ``schema_of_variant`` walks it and names the types at every depth; the line fits when
    that text matches the schema's pattern, and only a line that doesn't is looked at field by field. A number in a text column
    fits (its text is kept); an object or array there does not. Lines with a key twice count as broken.
    """
    kept = [c for c in lines.columns if c.startswith("_") and c != RESCUE]
    parsed = lines.select(F.try_parse_json(F.col(column)).alias("_v"), F.col(column).alias("_line"), *kept)
    walked = parsed.withColumn("_fits", F.coalesce(F.schema_of_variant("_v").rlike(f"^{_fit_pattern(schema)}$") & ~F.is_variant_null("_v"), F.lit(False)))

    def typed(field: T.StructField) -> Column:
        path = "$['" + field.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        value = F.try_variant_get("_v", path, field.dataType.simpleString())
        own = F.schema_of_variant(F.try_variant_get("_v", path, "variant")).rlike(f"^{_fit_pattern(field.dataType)}$")
        return F.when(F.col("_fits") | F.coalesce(own, F.lit(False)), value).alias(field.name)

    return walked.select(*[typed(f) for f in schema.fields], F.when(~F.col("_fits"), F.col("_line")).alias(RESCUE), *kept)


def read_json_files(spark: SparkSession, paths: Iterable[str], schema: T.StructType = LOOKUP_SCHEMA) -> DataFrame:
    """JSON-lines files as typed columns, rescue column and lineage."""
    return parse_json_lines(lineage(spark.read.text([literal_path(p) for p in paths])), schema)


def write_json_feed(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append records as JSON lines (NULL fields omitted, as a not-found record carries
    only its key, target and flag)."""
    df.select(*[f.name for f in LOOKUP_SCHEMA.fields]).write.mode(mode).json(path)


def read_json_tolerant(spark: SparkSession, path: str, schema: T.StructType = LOOKUP_SCHEMA) -> DataFrame:
    """Earlier output read back; lines that do not parse are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
