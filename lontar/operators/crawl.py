"""Crawl records, resume points and selections of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fetch_records(results: DataFrame, accepted: Column) -> DataFrame:
    """Fetch results as records: the status defaults to ``error``, blanks become null, a download whose file address is
    not accepted becomes an error."""
    full = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    status = F.coalesce(full("status"), F.lit("error"))
    refused = (status == "downloaded") & ~F.coalesce(accepted, F.lit(False))
    fixed = {"status": F.when(refused, "error").otherwise(status), "error": F.when(refused, "refused file address").otherwise(full("error"))}
    return results.withColumns(fixed | {c: full(c) for c in ("pdf_url", "title", "filename")})


def last_logged(lines: DataFrame, order: str, line: str, pattern: str, start: Column) -> DataFrame:
    """The address in the last log line whose address equals ``start`` or lies below it."""
    url = F.regexp_extract(line, pattern, 1)
    prefix = F.regexp_replace(start, r"\.html$", "")
    rows = lines.withColumn("url", url).where((F.col("url") != "") & ((F.col("url") == start) | F.col("url").startswith(prefix)))
    return rows.agg(F.max_by("url", order).alias("url"), F.max(order).alias("line_no"))


def newest_file(files: DataFrame, known: DataFrame) -> DataFrame:
    """The newest file of those that are not known yet and not empty (``path, length, modified``)."""
    return files.where("length > 0").join(known, "path", "left_anti").agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def resumed(targets: DataFrame, current: DataFrame, key: str, wanted: int) -> DataFrame:
    """A saved target is resumed if it is the same and not completed; else it starts anew from what is there now."""
    rows = targets.join(current, key, "right")
    same = F.coalesce((F.col("target") == wanted) & ~F.col("is_complete"), F.lit(False))
    base = F.when(same, F.col("baseline_downloaded")).otherwise(F.col("current"))
    done = F.least(F.lit(wanted).cast("long"), F.greatest(F.lit(0).cast("long"), F.col("current") - base))
    return rows.select(key, same.alias("resumed"), base.alias("baseline"), done.alias("completed"))


def only_sources(rows: DataFrame, names: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the named sources, and the names that no row has."""
    return rows.join(names, key, "left_semi"), names.join(rows, key, "left_anti")


def retry_empty(rows: DataFrame, status: str, empties: str) -> DataFrame:
    """Completed records with text that still have empty sections."""
    return rows.where((F.col(status) == "completed") & (F.col(empties) > 0))


def prompt(template: str, **fields: Column) -> Column:
    """A template with ``{name}`` places filled by columns."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def differences(rows: DataFrame, wanted: list[str], keys: str) -> DataFrame:
    """``missing`` and ``extra`` of a key set against the wanted one, and whether both are equal as sets."""
    want = F.array(*[F.lit(k) for k in wanted])
    return rows.withColumns({"missing": F.array_except(want, keys), "extra": F.array_except(keys, want)}).withColumn("equal", (F.size("missing") == 0) & (F.size("extra") == 0))


def unique_names(rows: DataFrame, name: str, order: str, suffix: str = ".pdf") -> DataFrame:
    """``rows`` with ``unique_name``: the first row of a name keeps it, later ones get ``-2``, ``-3`` and so on before the
    suffix, numbers left out under which another row is named already."""
    stem = F.regexp_replace(name, f"(?i){suffix.replace('.', chr(92) + '.')}$", "")
    base = rows.select(stem.alias("_stem"), F.struct(*rows.columns).alias("_row")).withColumn("_pos", F.row_number().over(Window.partitionBy("_stem").orderBy(f"_row.{order}")))
    numbered = r"^(.*)-([1-9]\d*)$"
    taken = base.select(F.regexp_extract("_stem", numbered, 1).alias("of"), F.regexp_extract("_stem", numbered, 2).try_cast("int").alias("k")).where("of <> '' and k >= 2").distinct()
    # The r-th row of a name gets r, and one more for each taken number that is not beyond what it would get.
    shifted = taken.select(F.col("of").alias("_stem"), (F.col("k") - F.row_number().over(Window.partitionBy("of").orderBy("k")) + 1).alias("_pos"), F.lit(1).alias("_taken"))
    both = base.withColumn("_taken", F.lit(0)).unionByName(shifted.withColumn("_row", F.lit(None).cast(base.schema["_row"].dataType)))
    skipped = F.sum("_taken").over(Window.partitionBy("_stem").orderBy("_pos", F.desc("_taken")).rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("_n", F.col("_pos") + skipped).where("_taken = 0")
    made = F.when(F.col("_pos") == 1, F.concat("_stem", F.lit(suffix))).otherwise(F.concat("_stem", F.lit("-"), F.col("_n").cast("string"), F.lit(suffix)))
    return both.select("_row.*", made.alias("unique_name"))


def batched(queue: DataFrame, place: str, workers: int) -> DataFrame:
    """A queue in batches of as many as there are workers, the last one of those that remain."""
    return queue.withColumn("batch", F.floor((F.col(place) - 1) / workers))
