"""Post files in and out — per-thread CSVs labelled by file name, per-thread caps, unions with missing
columns, partitioned parquet round trips and the CSV export/import used before topic modelling.

Writes go under the shared checkpoint folder (``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import scratch_path

POST_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("tags", T.StringType()),
])
# file stem up to the first dot; for a Spark output folder ("travel.csv/part-0000.csv") the folder's stem
FILE_STEM = r"([^/.]+)[^/]*(/part-[^/]*)?$"
# a Hive-style partition folder written by write_posts_by_thread
THREAD_DIR = r"/thread=([^/]+)/[^/]*$"
# the folder Spark writes rows with a null partition value to
NULL_DIR = "__HIVE_DEFAULT_PARTITION__"
# nulls are written as \N so an empty string stays an empty string (Spark's default null marker is ""); blanks at the
# ends of a value belong to it
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "encoding": "UTF-8",
               "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# files of quoted multi-line fields cannot be split by a reader: no written file grows beyond this many rows
FILE_ROWS = 1_000_000


def _marked(df: DataFrame) -> DataFrame:
    """String values that begin with a backslash get one more, so that no text is taken for the null marker."""
    return df.select(*[F.when(F.startswith(F.col(f.name), F.lit("\\")), F.concat(F.lit("\\"), F.col(f.name)))
                       .otherwise(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name) for f in df.schema.fields])


def _unmarked(df: DataFrame) -> DataFrame:
    """The inverse of ``_marked``; a single leading backslash (files of other writers) stays."""
    return df.select(*[F.when(F.startswith(F.col(f.name), F.lit("\\\\")), F.expr(f"substring(`{f.name}`, 2)"))
                       .otherwise(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name) for f in df.schema.fields])


def read_posts_by_thread(spark: SparkSession, paths, schema: T.StructType = POST_CSV_SCHEMA) -> DataFrame:
    """A1: read CSV files (declared schema, quoted multi-line fields) and label each row with its thread: the value
    of a ``thread=<name>`` folder (as written by ``write_posts_by_thread``), else the file stem up to the first dot
    (one file per community, as the reference's inputs). A null thread comes back as null."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(paths)
    df = df.drop("thread")  # a discovered partition column (type-inferred) is replaced by the raw folder value
    path = F.col("_metadata.file_path")
    # the metadata path is a URI (percent-encoded) of a folder name Spark escaped with %XX: decode both levels
    value = F.regexp_extract(path, THREAD_DIR, 1)
    for _ in range(2):
        value = F.url_decode(F.regexp_replace(value, "\\+", "%2B"))  # '+' is literal in both encodings
    value = F.when(value != NULL_DIR, value)
    label = F.when(path.rlike(THREAD_DIR), value).otherwise(F.regexp_extract(path, FILE_STEM, 1))
    return _unmarked(df.withColumn("thread", label))


def write_posts_by_thread(posts: DataFrame, root: str) -> list[str]:
    """One CSV folder per thread in a single distributed write (``partitionBy``: each task writes its own rows of
    every thread it holds, no pass per thread); tags as a space-separated string. Returns the paths to read."""
    flat = _marked(posts.select("id", "title", "content", F.array_join("tags", " ").alias("tags"), "thread"))
    (flat.write.mode("overwrite").partitionBy("thread").option("maxRecordsPerFile", FILE_ROWS)
     .options(**CSV_OPTIONS).csv(root))
    return [root]


def cap_per_thread(df: DataFrame, n: int, order_col: str = "id", group_col: str = "thread") -> DataFrame:
    """A2: the first n rows of each thread by an explicit order key (files have no row order in Spark). Planned as
    a WindowGroupLimit: map tasks keep n rows per thread before the shuffle, so a hot thread stays cheap."""
    w = Window.partitionBy(group_col).orderBy(F.col(order_col).asc())
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def union_files(frames: list[DataFrame]) -> DataFrame:
    """A3: stack frames by column name; a column missing in a frame is null there (bag semantics, no dedup)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def save_dataset(df: DataFrame, path: str, partition_col: str | None = "thread") -> str:
    """A4/A5: persist as parquet, partitioned by thread so per-thread reads prune whole folders."""
    w = df.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)
    return path


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dataset_roundtrip(df: DataFrame, name: str = "posts", partition_col: str | None = "thread") -> DataFrame:
    """Write to the shared folder and read back (also cuts lineage)."""
    path = save_dataset(df, scratch_path(df.sparkSession, name), partition_col)
    return load_dataset(df.sparkSession, path)


def export_csv(df: DataFrame, path: str, array_cols=("tags",)) -> str:
    """CSV cannot hold arrays: array columns are written as JSON text."""
    out = df
    for c in array_cols:
        out = out.withColumn(c, F.to_json(c))
    _marked(out).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).options(**CSV_OPTIONS).csv(path)
    return path


def import_csv(spark: SparkSession, path: str, schema: T.StructType, array_cols=("tags",)) -> DataFrame:
    """Read the exported CSV with its declared schema; JSON text back to array<string>."""
    flat = T.StructType([T.StructField(f.name, T.StringType() if f.name in array_cols else f.dataType)
                         for f in schema.fields])
    df = _unmarked(spark.read.options(**CSV_OPTIONS).schema(flat).csv(path))
    for c in array_cols:
        df = df.withColumn(c, F.from_json(c, T.ArrayType(T.StringType())))
    return df
