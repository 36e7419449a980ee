"""File readers with fixed schemas: text lines, JSON with rescued fields, strict tables, archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.catalog import stage
from lodestone.functions import token_double, tokens


def provenance() -> list[Column]:
    """Where a row was read from and when that file was written."""
    return [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("source_modified_at")]


def text_lines(spark: SparkSession, path: str, pattern: str = "*.txt", stream: bool = False) -> DataFrame:
    """(raw_line, source_file, source_modified_at), one row per line of the matching files."""
    reader = spark.readStream if stream else spark.read
    return reader.format("text").option("pathGlobFilter", pattern).load(path).select(F.col("value").alias("raw_line"), *provenance())


LEDGER = "path string, length long, modified timestamp, digest string"


def landed(spark: SparkSession, folder: str, ledger: str, pattern: str = "*.txt") -> int:
    """Enter the folder's new files into the ledger, a table of path, length, time and SHA-256; returns how many there are. To be called before a run.

    A file that is known with another length or time is read again, and if its content differs all raises, with nothing entered: a
    stream would read it twice or not at all. Only new and such files are read; the listing alone tells the others. A file that is gone is no error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    seen = files.select("path", "length", F.col("modificationTime").alias("modified"))
    has = _there(spark, ledger)
    entries = spark.read.schema(LEDGER).parquet(ledger) if has else spark.createDataFrame([], LEDGER)
    known = entries.groupBy("path").agg(F.max_by(F.struct("length", "modified", "digest"), "modified").alias("known"))
    both = seen.join(known, "path", "left")
    same = (F.col("length") == F.col("known.length")) & (F.col("modified") == F.col("known.modified"))
    odd = stage(both.filter(~F.coalesce(same, F.lit(False))), "odd-files")
    since = odd.agg(F.min("modified")).first()[0]
    if since is None:
        return 0
    # The reader's own filter on times leaves files unread that are older than all that is looked for.
    read = files.filter(F.col("modificationTime") >= F.lit(since)).select("path", F.sha2("content", 256).alias("digest"))
    digests = stage(odd.join(read, "path"), "digests")
    changed = digests.filter(F.col("known").isNotNull() & (F.col("known.digest") != F.col("digest"))).select("path").orderBy("path").limit(5).collect()
    if changed:
        raise ValueError(f"overwritten after they had landed: {', '.join(r.path for r in changed)}")
    digests.select("path", "length", "modified", "digest").write.mode("append").parquet(ledger)
    return digests.filter(F.col("known").isNull()).count()


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def rescued(raw: Column, schema: T.StructType) -> Column:
    """JSON of what the schema can't hold of an object: unknown fields, and fields whose value has another type; else null.

    Text that is no JSON object is rescued whole.
    """
    keys, known = F.json_object_keys(raw), [f.name for f in schema.fields]
    parsed = F.from_json(raw, schema)
    lost = [F.when(F.get_json_object(raw, f"$.{f.name}").isNotNull() & parsed[f.name].isNull(), F.lit(f.name)) for f in schema.fields]
    names = F.array_union(F.array_except(keys, F.array(*(F.lit(k) for k in known))), F.array_compact(F.array(*lost)))
    as_map = F.from_json(raw, T.MapType(T.StringType(), T.StringType()))
    odd = F.map_filter(as_map, lambda k, v: F.array_contains(names, k))
    return F.when(keys.isNull(), F.to_json(F.struct(raw.alias("_text")))).when(F.size(names) > 0, F.to_json(odd))


def json_lines(spark: SparkSession, path: str, schema: str, pattern: str = "*.jsonl", stream: bool = False, multi_line: bool = False) -> DataFrame:
    """The schema's columns, ``rescued`` and provenance of JSON files, one document a line (or a file)."""
    kind = T.StructType.fromDDL(schema)
    reader = (spark.readStream if stream else spark.read).format("text").option("pathGlobFilter", pattern)
    raw = reader.option("wholetext", multi_line).load(path).select("value", *provenance()).filter(F.trim("value") != "")
    parsed = raw.withColumn("_row", F.from_json("value", kind)).withColumn("rescued", rescued(F.col("value"), kind))
    return parsed.select("_row.*", "rescued", "source_file", "source_modified_at")


def csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with header whose columns all stay strings and whose blanks stay blank."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    read = spark.read.option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"').schema(schema).csv(path)
    return read.na.fill("")


def zipped_csv(spark: SparkSession, path: str, member: str, columns: list[str]) -> DataFrame:
    """Rows of one CSV inside each zip archive; an archive with other members raises. Archives are read on executors."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame.content:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    if archive.namelist() != [member]:
                        raise ValueError("unexpected members in the archive")
                    with archive.open(member) as f:
                        for part in pd.read_csv(f, dtype=str, keep_default_na=False, chunksize=50_000):
                            yield part[columns]

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, schema)


#: How a file's digest is worked out, by the name that publishers give it.
DIGESTS = {"sha256": lambda content: F.sha2(content, 256), "md5": F.md5}


def verified_files(spark: SparkSession, path: str, known: dict[str, str], kind: str = "sha256") -> DataFrame:
    """(file, digest, matches) of binary files against known digests by file name; the digest's column is named as its kind."""
    table = F.create_map(*(F.lit(x) for p in known.items() for x in p))
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), DIGESTS[kind](F.col("content")).alias(kind))
    return files.withColumn("matches", F.coalesce(F.col(kind) == F.try_element_at(table, F.col("file")), F.lit(False)))


def trajectory_columns(settings: int = 3, sensors: int = 21) -> list[str]:
    return ["unit", "cycle", *(f"setting_{i}" for i in range(1, settings + 1)), *(f"sensor_{i}" for i in range(1, sensors + 1))]


def parse_trajectory(lines: DataFrame, line: str = "raw_line") -> DataFrame:
    """Add ``tokens``, ``numbers`` and one double per column; what is missing or no number is null, for rules to find.

    Rules ask the array, not its two dozen columns: the optimiser derives constraints from every column it is asked about.
    """
    columns = trajectory_columns()
    split = lines.withColumn("tokens", tokens(F.col(line)))
    parsed = split.withColumn("numbers", F.array(*(token_double(F.col("tokens"), i) for i in range(1, len(columns) + 1))))
    return parsed.select("*", *(F.col("numbers")[i].alias(c) for i, c in enumerate(columns)))


def strict_trajectory(spark: SparkSession, path: str) -> DataFrame:
    """The table of a whitespace-delimited file; any bad width, number or key, and any key twice, raises on evaluation."""
    from lodestone.operators.expect import Rules, all_finite, integral_key

    columns = trajectory_columns()
    parsed = parse_trajectory(spark.read.text(path).withColumnRenamed("value", "raw_line"))
    rules = Rules({"width": f"size(tokens) = {len(columns)}", "keys": f"{integral_key('unit')} AND {integral_key('cycle')}", "finite": all_finite("numbers")})
    typed = rules.enforce(parsed).select(F.col("unit").cast("int"), F.col("cycle").cast("int"), *columns[2:])
    grouped = typed.groupBy("unit", "cycle").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*columns[2:])).alias("_v"))
    once = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("a key occurs twice")).cast("boolean"))
    return grouped.filter(once).select("unit", "cycle", "_v.*").orderBy("unit", "cycle")
