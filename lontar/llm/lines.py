"""Line deduplication over overlapping windows of three lines.

Every run of three consecutive lines is hashed with 128 bits. Of the windows that occur more than once anywhere, the
first one stays; every later one is marked, marked windows are merged, and the lines that they cover go. "First" is by
(doc_id, two hashes of the text, line number), null doc_ids first. Rows with the same doc_id and text are one document:
they get the same result, and none removes the other's lines. Windows without any visible character are not compared.

A null text stays null and an empty one stays empty, with no lines removed. Texts of fewer than three lines stay whole.
All columns pass through; ``n_chars``, where there is one, is counted again. Columns of the names that the result adds
(``n_lines``, ``n_removed``) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lontar.llm.common import Shelf, as_bytes, bytes_hash, held, slices, span_hash, text_batches

WINDOW = 3
_PLACE = ["doc", "t1", "t2"]


def line_bounds(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all lines, and the number of the first line of each text (with the end of all)."""
    newline, texts = np.flatnonzero(raw == 10), np.arange(len(starts) - 1)
    of = np.searchsorted(starts[1:], newline, side="right")
    begin, begin_of = np.concatenate([starts[:-1], newline + 1]), np.concatenate([texts, of])
    end, end_of = np.concatenate([newline, starts[1:]]), np.concatenate([of, texts])
    order = np.lexsort((begin, begin_of))
    return begin[order], end[np.lexsort((end, end_of))], np.searchsorted(begin_of[order], np.arange(len(starts)))


def window_hashes(array: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, line number and the two hashes of every window with visible characters."""
    raw, starts = as_bytes(array)
    begin, end, first = line_bounds(raw, starts)
    ink = np.concatenate([[0], np.cumsum(~((raw == 32) | ((raw >= 9) & (raw <= 13))))])
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(begin))
    whole = at + window <= np.repeat(first[1:], counts)
    at, doc = at[whole], doc[whole]
    seen = ink[end[at + window - 1]] > ink[begin[at]]
    at, doc = at[seen], doc[seen]
    hashes = [span_hash(bytes_hash(raw, begin, end, k), at, at + window, k).view(np.int64) for k in (0, 1)]
    return doc, at - first[doc], *hashes


def covered(starts: list[int], n: int, window: int = WINDOW) -> np.ndarray:
    """Which of ``n`` lines the windows at ``starts`` cover."""
    edge = np.zeros(n + window, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.asarray(starts) + window, -1)
    return np.cumsum(edge)[:n] > 0


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines of repeated windows, with ``n_lines`` and ``n_removed``."""
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    kind = docs.schema["doc_id"].dataType
    body = text_batches(docs).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2"), "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lines")
        for batch in batches:
            for part in slices(batch, "text"):
                doc, line, h1, h2 = window_hashes(part.column(3))
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([*[part.column(k).take(take) for k in range(3)], pa.array(line.astype(np.int32)), pa.array(h1), pa.array(h2)], names=[*_PLACE, "line", "h1", "h2"])

    schema = T.StructType([T.StructField("doc", kind), T.StructField("t1", T.LongType()), T.StructField("t2", T.LongType()), T.StructField("line", T.IntegerType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])
    found = body.where("text is not null").mapInArrow(windows, schema)
    place = F.struct(*_PLACE, "line")
    repeated = Shelf(docs.sparkSession, "lines").put(found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first"))
    later = found.join(repeated.hint("merge"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    marked = later.groupBy(*_PLACE).agg(F.collect_set("line").alias("marks"))

    d, m = docs.select(*[f"`{c}`" for c in kept], F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2")).alias("d"), marked.alias("m")
    joined = d.join(m, F.col("d.doc_id").eqNullSafe(F.col("m.doc")) & (F.col("d.t1") == F.col("m.t1")) & (F.col("d.t2") == F.col("m.t2")), "left").select(*[f"d.`{c}`" for c in kept], "m.marks")
    out = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in kept], T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    at = kept.index("text")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lines")
        for batch in batches:
            for part in slices(batch, "text"):
                texts, n_lines, n_removed = [], [], []
                for text, marks in zip(part.column(at).to_pylist(), part.column(len(kept)).to_pylist(), strict=True):
                    n = text.count("\n") + 1 if text else 0
                    gone = 0
                    if marks:
                        drop = covered(marks, n)
                        gone = int(drop.sum())
                        text = "\n".join([x for x, no in zip(text.split("\n"), drop, strict=True) if not no])
                    texts.append(text)
                    n_lines.append(n)
                    n_removed.append(gone)
                columns = part.columns[: len(kept)]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=[*kept, "n_lines", "n_removed"])

    result = joined.mapInArrow(remove, out)
    if "n_chars" in kept:
        result = result.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return result


def op1(docs: DataFrame) -> DataFrame:
    """Lines, removed lines and the digest of what stays of each document."""
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
wins AS (
  SELECT doc_id, pos, ls[pos] || chr(10) || ls[pos + 1] || chr(10) || ls[pos + 2] AS key
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls) - 2)) AS pos FROM split)
),
seen AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS r FROM wins WHERE regexp_matches(key, '[^\x09-\x0D ]')),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM seen WHERE r > 1) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL OR d.text = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
  coalesce(len(g.ps), 0)::BIGINT AS n_removed,
  sha256(coalesce(CASE WHEN g.ps IS NULL THEN d.text ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda x, i: NOT list_contains(g.ps, i)), chr(10)) END, '')) AS kept_sha256
FROM documents d LEFT JOIN gone g USING (doc_id)
"""
