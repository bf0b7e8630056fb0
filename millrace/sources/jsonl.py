"""JSON lines, dictionaries and latest-dated inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_order() -> Column:
    """The place of a row in its source: the file's path, the place of its part in the file, and the number of
    the line in that. It compares as a struct, and is right however a scan deals files and their parts to
    tasks. Taken at the scan itself, before any shuffle."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("line")
    )


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, strict: bool = True) -> DataFrame:
    """One row per line, with _ord (``file_order``). A broken line is an error; not ``strict``, it is a row
    with its text in _corrupt and its file in _file."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path).withColumn("_ord", file_order())
    read = spark.read.schema(f"{schema}, _corrupt STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return read.withColumns({"_file": F.col("_metadata.file_path"), "_ord": file_order()})


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """Committed as a whole; nulls are written, so that each line has all keys."""
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy(*by).json(path)


def latest_partition(df: DataFrame, column: str, explicit: str | None = None) -> DataFrame:
    """Rows of the given value of ``column``, else of the largest."""
    if explicit:
        return df.filter(F.col(column) == explicit)
    top = df.agg(F.max(column).alias("_top"))
    return df.join(F.broadcast(top), F.col(column) == F.col("_top")).drop("_top")  # one row


def base64url(text: Column) -> Column:
    plain = F.translate(text, "-_", "+/")
    return F.unbase64(F.rpad(plain, F.length(plain) + F.pmod(-F.length(plain), F.lit(4)), F.lit("=")))


def headers(found: Column) -> Column:
    """A map of lower-case names to values from an array of (name, value); the last of a name counts."""
    pairs = F.transform(found, lambda h: F.struct(F.lower(h["name"]).alias("key"), h["value"].alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def envelope(found: Column) -> Column:
    """(subject, from, to, cc, reply_to, date) of headers: empty without one, to and cc as lists of trimmed addresses."""
    get = lambda name: F.coalesce(F.try_element_at(headers(found), F.lit(name)), F.lit(""))
    many = lambda name: F.filter(F.transform(F.split(get(name), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.struct(get("subject").alias("subject"), get("from").alias("from"), many("to").alias("to"), many("cc").alias("cc"), get("reply-to").alias("reply_to"), get("date").alias("date"))


def sections(text: str) -> dict[str, list[str]]:
    """Lines of a file with [SECTION] heads; blank lines and # comments go."""
    out: dict[str, list[str]] = {}
    name = ""
    for line in (x.strip() for x in text.splitlines()):
        if line.startswith("[") and line.endswith("]"):
            name = line[1:-1]
        elif line and not line.startswith("#"):
            out.setdefault(name, []).append(line)
    return out


def weighted(lines: Sequence[str]) -> dict[str, float]:
    """"keyword,weight" lines; the weight is 1 if it is missing."""
    pairs = (x.rpartition(",") if "," in x else (x, ",", "1") for x in lines)
    return {k.strip(): float(v) for k, _, v in pairs}


def terms(text: str) -> dict[str, list[str]]:
    """A map of names to lists, in the two-level form "name:" and "- term"."""
    out: dict[str, list[str]] = {}
    name = ""
    for line in text.splitlines():
        bare = line.split(" #")[0].strip()
        if bare.startswith("- "):
            out[name].append(bare[2:].strip().strip("'\""))
        elif bare.endswith(":"):
            name = bare[:-1].strip().strip("'\"")
            out[name] = []
    return out


def dictionary_table(spark: SparkSession, dictionary: Mapping[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame([(c, t, i) for i, (c, ts) in enumerate(dictionary.items()) for t in ts], "category string, term string, priority int")
