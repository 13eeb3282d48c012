"""Readers for the file shapes of a document pipeline: texts, JSON lines, records, streams, logs and small formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def text_files(spark: SparkSession, folder: str, any_case: bool = True) -> DataFrame:
    """``file_name, path, text`` of the .txt files of a folder, whole; ordered by folded or by plain name."""
    rows = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    name = F.lower("file_name") if any_case else F.col("file_name")
    return rows.where(name.endswith(".txt")).orderBy(name, "file_name")


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified, valid`` of the PDF files of a folder, or of one file; valid by size and magic."""
    rows = spark.read.format("binaryFile").load(path).where(F.lower("path").endswith(".pdf"))
    valid = (F.col("length") > 0) & (F.substring("content", 1, 5) == F.lit(b"%PDF-"))
    return rows.select("path", "length", F.col("modificationTime").alias("modified"), valid.alias("valid"))


def tolerant_json(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows of JSON lines: byte-order marks stripped, blank and malformed lines skipped."""
    bare = F.trim(F.regexp_replace(column, "^﻿+", ""))
    parsed = lines.where(bare != "").withColumn("_row", F.from_json(bare, f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"}))
    return parsed.where("_row is not null and _row._corrupt_record is null").select(*lines.columns, "_row.*").drop("_corrupt_record")


def tolerant_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return tolerant_json(spark.read.text(path), "value", schema).drop("value")


def strict_json(lines: DataFrame, column: str, schema: str, place: Column) -> DataFrame:
    """Rows of JSON lines; the first malformed one fails the query and names its place."""
    row = F.from_json(column, f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"})
    rows = lines.where(F.trim(column) != "").withColumn("_row", row)
    bad = F.col("_row").isNull() | F.col("_row._corrupt_record").isNotNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("malformed line at "), place)).cast(rows.schema["_row"].dataType)).otherwise(F.col("_row"))
    return rows.withColumn("_row", checked).select(*lines.columns, "_row.*").drop("_corrupt_record")


def json_texts(spark: SparkSession, path: str) -> DataFrame:
    """``path, text, bytes`` of the .json files below a folder, whole, without byte-order marks; none if it is not there."""
    kind = "path string, text string, bytes int"
    if not exists(spark, path):
        return spark.createDataFrame([], kind)
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.where(F.lower("path").endswith(".json")).select("path", F.regexp_replace("value", "^\ufeff+", "").alias("text"), F.octet_length("value").alias("bytes"))


def record_files(spark: SparkSession, path: str, schema: T.StructType, skipped_models: tuple[str, ...] = ()) -> DataFrame:
    """Completed records of ``corpus/model/output/*.json`` with ``corpus`` and ``model`` from their paths; an empty
    table if the path is not there."""
    if not exists(spark, path.split("*")[0]):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("corpus", T.StringType()), T.StructField("model", T.StringType())]))
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path).withColumn("_path", F.col("_metadata.file_path"))
    place = r"([^/]+)/([^/]+)/output/[^/]+\.json$"
    rows = rows.withColumns({"corpus": F.regexp_extract("_path", place, 1), "model": F.regexp_extract("_path", place, 2)})
    return rows.where((F.col("status") == "completed") & ~F.col("model").isin(*skipped_models) if skipped_models else F.col("status") == "completed").drop("_path")


def csv_profile(texts: DataFrame, key: str, text: str = "text", sep: str = ";") -> DataFrame:
    """``key, row_count, columns`` of delimited texts: rows below the header that are not blank, trimmed header names."""
    rows = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\r?\n", -1), lambda x: F.trim(x) != "")
    names = F.filter(F.transform(F.split(F.coalesce(F.get(rows, 0), F.lit("")), sep, -1), lambda x: F.trim(x)), lambda x: x != "")
    return texts.select(key, F.greatest(F.size(rows) - 1, F.lit(0)).alias("row_count"), names.alias("columns"))


def dotenv(text: Column) -> Column:
    """``map<string,string>`` of KEY=VALUE lines: comments and blank lines skipped, one pair of quotes stripped, the last
    of equal keys kept."""
    lines = F.filter(F.transform(F.split(F.regexp_replace(text, "^﻿", ""), "\r?\n", -1), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#") & F.contains(x, F.lit("=")))
    bare = lambda v: F.regexp_replace(F.trim(v), r"""^(["'])(.*)\1$""", "$2")
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.get(F.split(x, "=", 2), 0)).alias("key"), bare(F.get(F.split(x, "=", 2), 1)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a list of addresses, without blank ones and comments."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def event_stream(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """``key, content, reasoning, finish_reason, total_tokens`` of server-sent event bodies: data lines up to [DONE]."""
    kind = "choices array<struct<delta: struct<content: string, reasoning: string>, finish_reason: string>>, usage struct<total_tokens: bigint>"
    rows = bodies.select(key, F.posexplode(F.split(body, "\r?\n")).alias("pos", "line")).where(F.col("line").startswith("data: ")).withColumn("data", F.trim(F.substr("line", F.lit(7))))
    stop = F.coalesce(F.min(F.when(F.col("data") == "[DONE]", F.col("pos"))), F.lit(1 << 30))
    stops = rows.groupBy(key).agg(stop.alias("stop"))
    events = rows.join(stops, key).where("pos < stop").withColumn("e", F.from_json("data", kind, {"mode": "FAILFAST"}))
    first = F.get("e.choices", F.lit(0))
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c.isNotNull(), F.struct("pos", c.alias("x"))))), lambda p: p["x"]), "")
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("pos")))
    return events.groupBy(key).agg(text(first["delta"]["content"]).alias("content"), text(first["delta"]["reasoning"]).alias("reasoning"), last(first["finish_reason"]).alias("finish_reason"), last(F.col("e.usage.total_tokens")).alias("total_tokens"))


def cli_usage(text: Column) -> dict[str, Column]:
    """The share left and the reset of a status text's 5h line, terminal escapes stripped."""
    plain = F.regexp_replace(text, r"\x1B\[[0-9;?]*[A-Za-z]", "")
    line = F.get(F.filter(F.split(plain, "\r?\n"), lambda x: x.rlike(r"(?i)5h\s+limit")), 0)
    left = F.coalesce(F.nullif(F.regexp_extract(line, r"(?i)(\d+)\s*%\s*left", 1), F.lit("")), F.nullif(F.regexp_extract(line, r"(\d+)\s*%", 1), F.lit("")))
    return {"left_pct": left.try_cast("int"), "resets": F.nullif(F.trim(F.regexp_extract(line, r"(?i)resets\s+([^)]+)", 1)), F.lit(""))}


def last_token_count(content: Column) -> Column:
    """The last "tokens used" number of a log of unknown encoding (bytes)."""
    utf16 = F.substring(content, 1, 2).isin(F.lit(b"\xff\xfe"), F.lit(b"\xfe\xff"))
    text = F.when(utf16, F.decode(content, "UTF-16")).when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    hits = F.regexp_extract_all(text, F.lit(r"(?i)tokens used[\s:]*([\d.,]+)"), F.lit(1))
    return F.regexp_replace(F.try_element_at(hits, F.lit(-1)), "[.,]", "").try_cast("long")


def rate_limit_event(body: Column, marker: str) -> Column:
    """The JSON object after a marker in a log body, what follows it left out: cut at the bracket that closes it. One
    pass over the object, with depth and whether the place is inside a string as state."""
    tail = F.substr(body, F.instr(body, F.lit(marker)) + len(marker))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, c: Column) -> Column:
        plain = ~acc["quoted"]
        depth = acc["depth"] + F.when(plain & (c == "{"), 1).when(plain & (c == "}"), -1).otherwise(0)
        n = acc["n"] + 1
        quoted = F.when((c == '"') & ~acc["escaped"], plain).otherwise(acc["quoted"])
        escaped = acc["quoted"] & (c == "\\") & ~acc["escaped"]
        end = F.when((acc["end"] == 0) & (depth == 0), n).otherwise(acc["end"])
        return F.struct(depth.alias("depth"), quoted.alias("quoted"), escaped.alias("escaped"), n.alias("n"), end.alias("end"))

    end = F.aggregate(F.regexp_extract_all(tail, F.lit("(?s)."), F.lit(0)), start, step, lambda acc: acc["end"])
    cut = F.substr(tail, F.lit(1), end)
    return F.when((F.instr(body, F.lit(marker)) > 0) & F.try_parse_json(cut).isNotNull(), F.nullif(cut, F.lit("")))


def current_limit(events: DataFrame, body: str, at: str, marker: str, now: Column, least_age: int = 3600) -> DataFrame:
    """The newest rate-limit event (``at`` in seconds) as ``at, used_percent, window_seconds, resets_at``; none if its
    reset has passed or it is older than its window (an hour at least)."""
    fields = "primary struct<used_percent: double, window_minutes: bigint, resets_at: bigint>"
    rows = events.select(F.col(at).alias("at"), F.from_json(rate_limit_event(F.col(body), marker), fields).alias("e")).where("e.primary is not null")
    newest = rows.agg(F.max_by(F.struct("at", "e"), F.col("at")).alias("r")).where("r is not null")
    found = newest.select("r.at", F.col("r.e.primary.used_percent").alias("used_percent"), (60 * F.col("r.e.primary.window_minutes")).alias("window_seconds"), F.col("r.e.primary.resets_at").alias("resets_at"))
    fresh = F.coalesce(F.col("resets_at") > now, F.lit(True)) & (now - F.col("at") <= F.greatest(F.coalesce("window_seconds", F.lit(0)), F.lit(least_age)))
    return found.where(fresh)


def message_content(body: Column) -> Column:
    return F.get_json_object(body, "$.choices[0].message.content")
