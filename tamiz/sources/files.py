"""Reading and writing tables, JSON lines, documents and binary files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The schemas of what the stages hand on.
PAGE = "pdf_id string, source_pdf string, source_path string, file_size long, page_count int, page int, text string, char_count int, word_count int, extraction_method string, needs_ocr boolean, doc_type string"
CHUNK = "chunk_id string, pdf_id string, text string, source_pdf string, source_path string, doc_type string, pages array<int>, section string, token_estimate int, clinical_score int, quality_flags array<string>, section_type string, content_role string, language string, topics array<string>, topic_tags array<string>, topic_count int"
FILE_STATE = "source_pdf string, source_path string, file_size long, mtime_ns long"
MESSAGES = "messages array<struct<role: string, content: string>>, metadata map<string, string>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, *, tolerant: bool = False, optional: bool = False) -> DataFrame:
    """JSON lines of a known schema. A malformed line fails the read, or is left out if ``tolerant``; blank lines are
    skipped; a missing file is an error, or an empty table if ``optional``."""
    if optional and not exists(spark, path):
        return spark.createDataFrame([], schema)
    kind = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    if not tolerant:
        return spark.read.schema(kind).option("mode", "FAILFAST").json(path)
    marked = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.filter(F.col("r._bad").isNull()).select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in kind.fields])


def processed_ids(spark: SparkSession, path: str, key: str = "chunk_id") -> DataFrame:
    """The distinct non-blank keys in JSON lines of which some may be cut short; none if the file is missing."""
    return read_jsonl(spark, path, f"{key} string", tolerant=True, optional=True).filter(F.coalesce(F.trim(key), F.lit("")) != "").distinct()


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document over many lines; empty if the file is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Writes JSON lines and returns their number, counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("ignoreNullFields", False).json(path)
    return int(seen.get["n"])


def read_splits(spark: SparkSession, paths: dict[str, str], schema: str | T.StructType) -> DataFrame:
    """The JSON lines of several splits as one table with ``split``; a split whose file is missing is an error that names it."""
    out = None
    for split, path in paths.items():
        if not exists(spark, path):
            raise FileNotFoundError(f"split {split}: {path}")
        rows = read_jsonl(spark, path, schema).withColumn("split", F.lit(split))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no splits named")
    return out


def write_report(measures: DataFrame, path: str, measure: str = "measure", key: str = "key", value: str = "value") -> None:
    """A report of named measures as one indented JSON document, names ascending: a measure with keys is an object, one whose only key is ''
    a number. Meant for reports, whose rows are few; they come to the driver."""
    import json

    out: dict = {}
    for r in measures.select(measure, key, value).collect():
        v = int(r[2]) if r[2] is not None and float(r[2]).is_integer() else r[2]
        if r[1] in ("", None):
            out[r[0]] = v
        else:
            out.setdefault(r[0], {})[r[1]] = v
    _write_text(measures.sparkSession, path, json.dumps(out, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def discover(spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = True, files: Sequence[str] | None = None) -> DataFrame:
    """(``source_path``, ``source_pdf``, ``file_size``, ``mtime_ns``) of the files below a path, without reading them; ``files`` named one by one
    take the place of the path and its pattern."""
    reader = spark.read.format("binaryFile")
    if files is not None:
        files = reader.load(list(files)) if files else reader.option("pathGlobFilter", "-none-").load(path)
    else:
        files = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.col("path").alias("source_path"), name.alias("source_pdf"), F.col("length").alias("file_size"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))


def read_binary(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files with their contents, for an extractor of pages (``mapInPandas``) to take apart."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """(``source_path``, ``text``) of HTML files, scripts and markup taken out."""
    from tamiz.functions.text import html_text

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.htm*").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("source_path"), html_text(F.decode("content", "UTF-8")).alias("text"))


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split, each rewritten whole and no other touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(split).parquet(path)


def markdown(rows: Sequence[T.Row], columns: Sequence[str]) -> str:
    """A report's few rows as a Markdown table."""
    cell = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|")
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows)]) + "\n"
