"""Decoders: whole-text payloads -> row tables.

Every decoder takes a DataFrame that carries a whole file (or a payload column
built from a table) and returns rows with an explicit position column, so the
same code runs on files read with ``read_whole`` and on payloads the plans
derive from the test tables.  Position comes from ``posexplode`` of the parsed
array, never from read order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.text import col_, split_lines
from colloquy.session import default_parallelism
from colloquy.sources.files import read_shared

# Decoders explode with ``posexplode_outer`` and drop the NULL row of an empty
# array themselves: an inner explode makes the optimizer add a
# ``size(array) > 0`` filter in front, which splits / parses every text twice.

UTTERANCE_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("timestamp", T.ArrayType(T.DoubleType())),
    T.StructField("text", T.StringType()),
]))

TURN_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("chunk", T.IntegerType()),
    T.StructField("speaker", T.StringType()),
    T.StructField("text", T.StringType()),
]))

SCORE_MAP_SCHEMA = T.MapType(T.StringType(), T.MapType(T.StringType(), T.MapType(
    T.StringType(), T.MapType(T.StringType(), T.DoubleType()))))

ID_SCHEMA = T.StructType([T.StructField("id", T.StringType())])


def _empty_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files of no bytes that ``pattern`` (a folder, file or glob)
    names, which Spark's own file readers leave out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(path) or []:
        for f in (fs.listStatus(status.getPath()) if status.isDirectory() else [status]):
            if f.isFile() and f.getLen() == 0 and not f.getPath().getName().startswith(("_", ".")):
                found.append(f.getPath().toString())
    return sorted(found)


def _shared_pattern(spark: SparkSession, pattern: str) -> str | None:
    """The pattern as a plain path where it lies on a file system that tasks open
    by path, and uses no glob alternatives."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    local = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    return path.toUri().getPath() if local and not set("{}\\^") & set(pattern) else None


def read_paths(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, value)`` of every file, files of no bytes included.

    Folders under a path that all nodes share are listed and read in tasks
    (``sources.files``).  Files of object stores go through Spark's text reader;
    for these the driver looks up the files of no bytes."""
    shared = _shared_pattern(spark, pattern)
    if shared is not None:
        return read_shared(spark, shared, default_parallelism(spark, 8))
    empty = spark.createDataFrame([(p, "") for p in _empty_files(spark, pattern)], "path string, value string")
    try:
        # wholetext must be the keyword argument: the method default resets the reader option
        full = spark.read.text(pattern, wholetext=True).select(
            F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"), "value")
    except AnalysisException:  # every file is empty: Spark finds no path to read
        if empty.isEmpty():
            raise
        return empty
    return full.unionByName(empty)


def without_suffix(name: Column, suffix: str) -> Column:
    return F.when(name.endswith(suffix), name.substr(F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def read_whole(spark: SparkSession, path: str, name_col: str = "name",
               strip_suffix: str | None = None) -> DataFrame:
    """One row per file: ``(name, value)``; ``name`` is the file name, minus
    ``strip_suffix`` when given."""
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    if strip_suffix:
        name = without_suffix(name, strip_suffix)
    return read_paths(spark, path).select(name.alias(name_col), "value")


def malformed_json(files: DataFrame, schema: T.DataType, value_col: str = "value") -> DataFrame:
    """The rows whose text is not a JSON array of the schema (truncated or
    another shape).  The decoders give such a text no rows, so jobs report it."""
    return files.where(~is_json(value_col, schema))


def is_json(value_col: str, schema: T.DataType) -> Column:
    return F.json_array_length(col_(value_col)).isNotNull() & F.from_json(col_(value_col), schema).isNotNull()


def read_exported(spark: SparkSession, path: str, keys: Sequence[str] = ("run_name", "id")) -> DataFrame:
    """Files written by ``sinks.export_files`` -> ``(keys, value)``.  Key values
    are taken from the ``key=value`` folders as strings (no type inference:
    ids keep their leading zeros)."""
    df = spark.read.text(f"{path.rstrip('/')}/" + "/".join("*" for _ in keys), wholetext=True)
    fp = F.col("_metadata.file_path")
    cols = [F.url_decode(F.replace(F.regexp_extract(fp, f"/{k}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
            .alias(k) for k in keys]
    return df.select(*cols, "value")


def read_prompts(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Prompt texts ``<path>/<prompt_name>.txt`` -> ``(prompt_name, text)``."""
    return read_whole(spark, path, "prompt_name", suffix).withColumnRenamed("value", "text")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Id list from JSONL ``{"id": "01"}``: ids stay strings (leading zeros)."""
    return spark.read.schema(ID_SCHEMA).json(path).where(F.col("id").isNotNull())


def decode_ids(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Id list from JSONL lines already in a column (one JSON object per row)."""
    parsed = F.from_json(col_(value_col), ID_SCHEMA)
    return lines.select(parsed["id"].alias("id")).where(F.col("id").isNotNull())


def decode_utterances(files: DataFrame, keys: Sequence[str] = ("id",),
                      value_col: str = "value", keep_empty: bool = False) -> DataFrame:
    """Raw transcript JSON array -> ``(keys, pos, start_s, end_s, text, n_rows)``.

    ``n_rows`` counts every utterance (``"\\n"`` ones too): segmentation needs it
    and it comes free here, before the explode, without a shuffle."""
    arr = F.from_json(col_(value_col), UTTERANCE_SCHEMA)
    # the count comes from a light top-level scan of the text, so the array is
    # not built twice when the optimizer inlines it into both uses
    staged = files.select(*keys, arr.alias("_u"),
                          F.coalesce(F.json_array_length(col_(value_col)), F.lit(0)).cast("int").alias("n_rows"))
    return (staged
            .select(*keys, "n_rows", F.posexplode_outer("_u").alias("pos", "_e"))
            .where(F.lit(keep_empty) | F.col("pos").isNotNull())
            .select(*keys, "pos",
                    F.col("_e.timestamp")[0].alias("start_s"),
                    F.col("_e.timestamp")[1].alias("end_s"),
                    F.col("_e.text").alias("text"), "n_rows"))


def decode_lines(files: DataFrame, keys: Sequence[str] = ("id",),
                 value_col: str = "value", keep_empty: bool = False) -> DataFrame:
    """Labelled txt -> physical lines ``(keys, pos, line, n_rows)``; blank lines
    are rows (they count for segmentation); line ends are removed."""
    staged = (files.select(*keys, split_lines(value_col).alias("_l"))
              .withColumn("n_rows", F.size("_l")))
    return (staged.select(*keys, "n_rows", F.posexplode_outer("_l").alias("pos", "line"))
            .where(F.lit(keep_empty) | F.col("pos").isNotNull()).select(*keys, "pos", "line", "n_rows"))


def decode_turns(files: DataFrame, keys: Sequence[str] = ("id",),
                 value_col: str = "value", keep_empty: bool = False) -> DataFrame:
    """Labelled JSON ``[{chunk, speaker, text}]`` -> ``(keys, pos, chunk, speaker, text, n_rows)``."""
    arr = F.from_json(col_(value_col), TURN_SCHEMA)
    staged = files.select(*keys, arr.alias("_t"),
                          F.coalesce(F.json_array_length(col_(value_col)), F.lit(0)).cast("int").alias("n_rows"))
    return (staged.select(*keys, "n_rows", F.posexplode_outer("_t").alias("pos", "_e"))
            .where(F.lit(keep_empty) | F.col("pos").isNotNull())
            .select(*keys, "pos", F.col("_e.chunk").alias("chunk"),
                    F.col("_e.speaker").alias("speaker"), F.col("_e.text").alias("text"),
                    "n_rows"))


def decode_scores(files: DataFrame, name_col: str = "run_name",
                  value_col: str = "value") -> DataFrame:
    """Score file ``[ids, {family: {metric: {id: {segment: score}}}}]`` -> tall
    ``(run_name, family, metric, id, segment, score)``.  Segment keys are JSON
    strings; they become INT."""
    nested = F.from_json(F.get_json_object(col_(value_col), "$[1]"), SCORE_MAP_SCHEMA)
    return (files.select(F.col(name_col).alias("run_name"),
                         F.explode(nested).alias("family", "_m"))
            .select("run_name", "family", F.explode("_m").alias("metric", "_i"))
            .select("run_name", "family", "metric", F.explode("_i").alias("id", "_s"))
            .select("run_name", "family", "metric", "id",
                    F.explode("_s").alias("_seg", "score"))
            .select("run_name", "family", "metric", "id",
                    F.col("_seg").cast("int").alias("segment"), "score"))


def decode_score_ids(files: DataFrame, name_col: str = "run_name",
                     value_col: str = "value") -> DataFrame:
    """The id list stored as ``$[0]`` of a score file, with its order."""
    ids = F.from_json(F.get_json_object(col_(value_col), "$[0]"), T.ArrayType(T.StringType()))
    return files.select(F.col(name_col).alias("run_name"), F.posexplode(ids).alias("ord", "id"))


def decode_manifest_lines(lines: DataFrame, line_no_col: str = "line_no",
                          line_col: str = "line", header: Sequence[str] = ("id", "path")) -> DataFrame:
    """Manifest CSV lines ``(line_no, line)`` whose columns ``header`` names, in
    any order and among others -> ``(line_no, id, path)``."""
    if not {"id", "path"} <= set(header):
        raise ValueError(f"a manifest needs the columns id and path, not {list(header)}")
    parsed = F.from_csv(F.col(line_col), ", ".join(f"`_{k}` STRING" for k in range(len(header))))
    return (lines.where(F.length(line_col) > 0)
            .select(F.col(line_no_col).alias("line_no"), parsed[f"_{list(header).index('id')}"].alias("id"),
                    parsed[f"_{list(header).index('path')}"].alias("path")))


def decode_manifest(files: DataFrame, value_col: str = "value") -> DataFrame:
    """Manifest CSV file (header line first) -> ``(line_no, id, path)``; the
    columns are found by their names in the header.

    Line numbers come from the file itself, so "first match" is deterministic
    and survives task retries (no ``monotonically_increasing_id``)."""
    staged = files.select(split_lines(value_col).alias("_l"))
    first = F.split(F.get(F.col("_l"), 0), ",", -1)
    name = F.transform(first, lambda x: F.trim(F.replace(x, F.lit('"'), F.lit(""))))
    at = lambda column: F.array_position(F.col("_h"), column)
    rows = (staged.select(name.alias("_h"), F.posexplode("_l").alias("line_no", "line"))
            .where((F.col("line_no") > 0) & (F.length("line") > 0)))
    width = 64  # columns read of a line; a header with more is refused
    fields = F.from_csv("line", ", ".join(f"`_{k}` STRING" for k in range(width)))
    cells = F.array(*(fields[f"_{k}"] for k in range(width)))
    cell = lambda column: F.when(
        (at(column) > 0) & (at(column) <= width), F.get(F.col("_c"), (at(column) - 1).cast("int"))).otherwise(
        F.raise_error(F.lit(f"the manifest's header has no column {column}")).cast("string"))
    return rows.select("_h", "line_no", cells.alias("_c")).select(
        "line_no", cell("id").alias("id"), cell("path").alias("path"))
