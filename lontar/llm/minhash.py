"""MinHash near-deduplication of documents by the Jaccard similarity of their word shingles.

Rows with equal shingle sets are one node. Each node has ``HASHES`` minima of universal hash functions; nodes that agree
on all ``ROWS`` minima of one of ``bands_for(threshold)`` bands share a bucket. Every node of a bucket is paired with the bucket's most
central node, that of the most company over all its buckets; pairs whose signatures (the last two bits of each minimum)
agree too little are dropped (a limit far below the threshold, so no true link is lost), the others are compared on
their full shingle sets. Alternating large-star and small-star gives components. Buckets that still hold nodes of more
than one component then have all pairs of nodes of different components checked by that and by a finer signature inside
the join, and those that pass compared on their full sets, so a link that misses the central node is found too, while a large group of
copies costs one pair for each of them. A pair at the threshold misses all bands with a chance of at most 1.2e-5.

Null and empty texts have no shingles and link with nothing. Texts of fewer than ``SHINGLE`` words have one shingle,
the whole sequence. Rows that share a doc_id are one document. A row without doc_id links with nothing, and its
component is null. Repeated rows get equal results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import Shelf, as_bytes, bytes_hash, held, lowered, mix, slices, span_hash, text_batches, words_of
from lontar.llm.components import components

SHINGLE = 5
#: Least similarity of a link, in hundredths.
THRESHOLD = 80
HASHES, ROWS = 320, 6
#: Hash functions of the finer signatures, for nodes that have to be told from many others.
FINE = 1024
_RNG = np.random.default_rng(20240601)
_A = _RNG.integers(0, 1 << 63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, FINE, dtype=np.uint64)


def bands_for(threshold: int) -> int:
    """How many bands miss a pair of the threshold's similarity with a chance of at most 1.2e-5."""
    bands = math.ceil(math.log(1.2e-5) / math.log(1 - (threshold / 100) ** ROWS))
    if bands * ROWS > HASHES:
        raise ValueError(f"{HASHES} hashes are too few for a threshold of {threshold}")
    return bands


def most_differing(n: int, threshold: int = THRESHOLD) -> int:
    """Differing bit pairs of two signatures of ``n`` hashes, beyond which a pair of the threshold's similarity comes
    with a chance of about 1e-6."""
    p = (1 - threshold / 100) * 3 / 4
    return math.ceil(n * p + 4.7 * math.sqrt(n * p * (1 - p)))


def shingle_sets(array: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    raw, starts = as_bytes(array)
    raw = lowered(raw)
    begin, end, first = words_of(raw, starts)
    values = bytes_hash(raw, begin, end)
    out = []
    counts = np.diff(first)
    at = np.arange(len(values), dtype=np.int64)
    doc_end = np.repeat(first[1:], counts)
    doc_start = np.repeat(first[:-1], counts)
    use = (at + shingle <= doc_end) | ((at == doc_start) & (doc_end - doc_start < shingle))
    at = at[use]
    hashes = span_hash(values, at, np.minimum(at + shingle, doc_end[use]))
    cuts = np.searchsorted(at, first)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out.append(np.unique(hashes[a:b]))
    return out


def signature(shingles: np.ndarray, n: int = HASHES) -> np.ndarray:
    """The minima of the first ``n`` hash functions over one set."""
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at : at + 512, None] * _A[:n] + _B[:n]).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signatures[:, : bands * ROWS].reshape(len(signatures), bands, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for r in range(ROWS):
        key = mix(key ^ parts[:, :, r])
    return key.view(np.int64)


def features(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, digest, signature, bands`` of each document."""
    bands = bands_for(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("minhash")
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column(1))
                signatures = np.stack([signature(s) for s in sets])
                keys = band_keys(signatures, bands)
                columns = [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array(packed_bits(signatures).tolist(), pa.list_(pa.int64())),
                    pa.array([k.tolist() if len(s) else None for s, k in zip(sets, keys, strict=True)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "signature", "bands"])

    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature array<long>, bands array<long>")


def packed_bits(signatures: np.ndarray) -> np.ndarray:
    """The last two bits of each minimum, 32 of them in a 64-bit number."""
    pairs = (signatures & np.uint32(3)).astype(np.uint64).reshape(len(signatures), -1, 32)
    return (pairs << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)


def differing(x: Column, y: Column, n: int = HASHES) -> Column:
    """In how many bit pairs two signatures of ``n`` hashes differ."""
    out = F.lit(0)
    for k in range(n // 32):
        z = F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
        out = out + F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return out


def _agreeing(pairs: DataFrame, signatures: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures agree enough."""
    sa = signatures.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    sb = signatures.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(sb, "b").join(sa, "a").where(differing(F.col("sa"), F.col("sb")) <= most_differing(HASHES, threshold)).select("a", "b")


def _fine(nodes: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``rep, fine``: the finer signatures of some nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("minhash")
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = shingle_sets(part.column(1))
                fine = packed_bits(np.stack([signature(s, FINE) for s in sets]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array(fine.tolist(), pa.list_(pa.int64()))], names=["rep", "digest", "fine"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(nodes.hint("merge"), "rep", "left_semi").select("rep", "text")
    found = texts.mapInArrow(run, "rep long, digest binary, fine array<long>").join(reps, ["rep", "digest"], "left_semi")
    return found.select("rep", "fine").dropDuplicates(["rep"])


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, threshold: int, shelf: Shelf) -> DataFrame:
    """The pairs that reach the threshold on their full shingle sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("minhash")
        for batch in batches:
            for part in slices(batch, "text"):
                found = [s.tobytes() for s in shingle_sets(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in found], pa.binary()), pa.array(found, pa.binary())], names=["rep", "digest", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("minhash")
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = shelf.put(pairs)
    # The wanted ids grow with the documents, so they are never sent to all executors, however few they look.
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    full = shelf.put(texts.select("doc_id", "text").mapInArrow(sets, "rep long, digest binary, shingles binary").join(reps, ["rep", "digest"], "left_semi").select("rep", "shingles"))
    fa = full.select(F.col("rep").alias("a"), F.col("shingles").alias("fa"))
    fb = full.select(F.col("rep").alias("b"), F.col("shingles").alias("fb"))
    found = shelf.put(pairs.join(fb, "b").join(fa, "a").select("a", "b", "fa", "fb").mapInArrow(run, "a long, b long"))
    shelf.drop(pairs, full)
    return found


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each document; links from ``threshold`` hundredths on."""
    shelf = Shelf(docs.sparkSession, "minhash")
    rows = shelf.put(features(docs, threshold))
    known = rows.where("n_shingles > 0 and doc_id is not null")
    # Rows of one digest have one set, so any of them has its signature and bands.
    nodes = shelf.put(known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature"), F.any_value("bands").alias("bands")))
    reps = nodes.select("rep", "digest")

    entries = nodes.select(F.posexplode("bands").alias("band", "key"), "rep")
    shared = shelf.put(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    joined = shelf.put(entries.join(shared, "key"))
    company = shelf.put(joined.groupBy("rep").agg(F.sum("n").alias("company")))
    weighed = joined.join(company, "rep")
    centers = shelf.put(weighed.groupBy("key").agg(F.max(F.struct("company", (-F.col("rep")).alias("rep"))).alias("top")).select("key", (-F.col("top.rep")).alias("center")))
    members = shelf.put(joined.join(centers, "key").select("key", "band", "rep", "center"))
    shelf.drop(shared, joined, company, centers)

    tried = shelf.put(members.where("rep <> center").select(F.least("center", "rep").alias("a"), F.greatest("center", "rep").alias("b")).distinct())
    links = _confirmed(_agreeing(tried, nodes, threshold), docs, reps, threshold, shelf)
    found = components(links, shelf)

    named = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = shelf.put(named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key"))
    apart = shelf.put(named.join(mixed, "key", "left_semi"))
    shelf.drop(links, members, mixed)
    fine = shelf.put(_fine(apart.select("rep").distinct(), docs, reps))
    left = shelf.put(apart.join(nodes.select("rep", "signature", "bands"), "rep").join(fine, "rep"))
    shelf.drop(apart, fine)
    x, y = left.alias("x"), left.alias("y")
    first_band = ~F.exists(F.sequence(F.lit(0), F.col("x.band")), lambda j: (j < F.col("x.band")) & (F.get("x.bands", j) == F.get("y.bands", j)))
    alike = (differing(F.col("x.signature"), F.col("y.signature")) <= most_differing(HASHES, threshold)) & (differing(F.col("x.fine"), F.col("y.fine"), FINE) <= most_differing(FINE, threshold))
    across = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & alike & first_band)
    pair = across.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    more = _confirmed(pair, docs, reps, threshold, shelf)
    shelf.drop(left, tried)
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), shelf)

    classes = shelf.put(reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component")))
    flat = shelf.put(rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).alias("digest")))
    shelf.drop(rows, nodes)
    same: Column = F.coalesce("component", "doc_id")
    return flat.join(classes, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), same).alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op6(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 85)
