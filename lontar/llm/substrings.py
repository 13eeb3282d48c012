"""Exact removal of repeated passages, found by recompression.

Every text is parsed into a hierarchy of symbols. The first round names runs of an equal word, each later round names
pairs: a symbol's name, hashed with the round, makes it a left or a right one, and a left one followed by a right one
becomes one symbol of the next level. A name is a fingerprint of what it stands for, so all partitions give equal
passages equal names without a table of names. What a round does inside a passage depends on the passage alone except
at its edges, so every window of ``WINDOW`` words has, at each level, a known range of interior symbols. A window's
anchor is the symbol of the highest level that lies in that range and ``CONTEXT`` words or more from both edges, the
one of least name if there are several: equal windows have equal anchors at equal places. Two Spark rounds follow. The
first finds the anchors (with the ``CONTEXT`` words on both sides) that occur at more than one place anywhere; the
second compares the windows of those anchors by 128-bit fingerprints of all their words, which verifies the repeats and
leaves no chance find. Covered words go.

Texts travel in packs of about 2 MB, compressed, with their anchors. What a pack asks goes to buckets of the key space
as one array of distinct keys for each bucket, and what returns is one bit for each key. So a passage that one pack
holds a million times is asked once, and a passage of all packs costs one key from each.

Null texts count as empty; empty texts and texts of fewer words than a window keep every word. Repeated rows are
documents of their own, so each removes the other's windows. Texts of any length are taken whole. Other columns are not
read by ``digests``; ``dedup_passages`` keeps them out as well and returns ``doc_id`` and ``kept``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import as_bytes, bytes_hash, checkpoint, held, mix, partitions, slices, span_hash, text_batches, words_of

WINDOW = 35
CONTEXT = 8
ROUNDS = 6
PACK_BYTES = 2 << 20
#: Bytes of anchor keys that a bucket of the key space may hold, before equal ones of a pack are dropped.
BUCKET_BYTES = 32 << 20
LONGEST = WINDOW - 2 * CONTEXT
_K = np.uint64(0x9E3779B97F4A7C15)
_PACK = "gid long, docs array<long>, offsets binary, body binary, raw long, first binary, last binary, keys binary"


def _least_of(names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The index of the least name in each ``[lo, hi)`` (not empty), the leftmost of equal ones."""
    best = [np.arange(len(names))]
    while (1 << len(best)) <= int((hi - lo).max(initial=1)):
        half = 1 << (len(best) - 1)
        a = best[-1]
        b = np.concatenate([a[half:], a[-half:] if len(a) >= half else a])[: len(a)]
        best.append(np.where(names[b] < names[a], b, a))
    k = np.frexp((hi - lo).astype(float))[1] - 1
    table = np.stack(best)
    a, b = table[k, lo], table[k, hi - (1 << k)]
    return np.where(names[b] < names[a], b, a)


def anchors(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of texts whose word hashes are ``words`` (text ``d`` from ``first[d]``): runs of windows with one
    anchor, as the first and the last window's start, and the anchor's key."""
    n = len(words)
    counts = np.diff(first)
    doc_end = np.repeat(first[1:], counts)
    at = np.arange(n)
    s = at[at + WINDOW <= doc_end]
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(counts)), counts)
    names, begin, lo, hi = words, at, s.copy(), s + WINDOW
    chosen_a, chosen_b = np.full(len(s), -1), np.full(len(s), -1)
    for level in range(ROUNDS + 1):
        end = np.append(begin[1:], n)
        starts = np.zeros(n + 2, np.int64)  # symbols that start before a word
        starts[begin + 1] = 1
        starts = np.cumsum(starts)
        cl = np.maximum(lo, starts[s + CONTEXT])
        ch = np.minimum(hi, np.searchsorted(end, s + WINDOW - CONTEXT, side="right"))
        some = np.flatnonzero(ch > cl)
        if len(some):
            k = _least_of(names, cl[some], ch[some])
            chosen_a[some], chosen_b[some] = begin[k], end[k]
        if level == ROUNDS:
            break
        m = len(names)
        same_doc = np.append(doc[begin[1:]] == doc[begin[:-1]], False)
        length = end - begin
        if level == 0:
            equal = np.append((names[1:] == names[:-1]), False) & same_doc
            head = np.append(True, ~equal[:-1])
            run = np.cumsum(head) - 1
            size = np.bincount(run)
            fits = size[run] <= LONGEST
            keep = head | ~fits
            run_end = np.cumsum(size)[run]
            lo, hi = np.where(lo < m, run_end[np.minimum(lo, m - 1)], m), (run_end - size[run])[np.maximum(hi - 1, 0)]
            renamed = np.where(fits & (size[run] > 1), mix(names * _K + size[run].astype(np.uint64)), names)
        else:
            right = (mix(names + np.uint64(level * int(_K) % (1 << 64))) & np.uint64(1)).astype(bool)
            joins = np.zeros(m, bool)
            joins[:-1] = ~right[:-1] & right[1:] & same_doc[:-1] & (length[:-1] + length[1:] <= LONGEST)
            keep = np.append(True, ~joins[:-1])
            renamed = names.copy()
            j = np.flatnonzero(joins)
            renamed[j] = mix(mix(names[j] + np.uint64(level)) * _K + names[j + 1])
            lo = lo + right[np.minimum(lo, m - 1)]
            hi = hi - ~right[np.maximum(hi - 1, 0)]
        place = np.append(np.cumsum(keep) - 1, int(keep.sum()))
        hi = np.maximum(hi, 0)
        empty = hi <= lo
        lo, hi = place[np.minimum(lo, m)], place[np.minimum(hi, m)]
        hi = np.where(empty, lo, hi)
        names, begin = renamed[keep], begin[keep]
    change = np.flatnonzero(np.append(True, (chosen_a[1:] != chosen_a[:-1]) | (chosen_b[1:] != chosen_b[:-1]) | (s[1:] != s[:-1] + 1)))
    a, b = chosen_a[change], chosen_b[change]
    keys = span_hash(words, a - CONTEXT, b + CONTEXT)
    return s[change], s[np.append(change[1:], len(s)) - 1], keys


def _packed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("substrings")
        codec, k, base = pa.Codec("zstd", 3), 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", PACK_BYTES):
                raw, starts = as_bytes(part.column(1))
                begin, end, first = words_of(raw, starts)
                a, b, keys = anchors(bytes_hash(raw, begin, end), first)
                row = (base + k, part.column(0).to_pylist(), starts.tobytes(), codec.compress(raw.tobytes(), asbytes=True), len(raw), codec.compress(np.diff(a, prepend=0).astype(np.int32).tobytes(), asbytes=True), codec.compress((b - a).astype(np.int32).tobytes(), asbytes=True), keys.tobytes())
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                k += 1
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=[x.split()[0] for x in _PACK.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PACK)


class Asked:
    """A pack's distinct keys of one or two 64-bit words, by bucket; the lowest bit of the last word says "more than once here"."""

    def __init__(self, keys: list[np.ndarray], buckets: int):
        low = [*keys[:-1], keys[-1] >> np.uint64(1)]
        if len(low) == 1:
            distinct, self.inverse, counts = np.unique(low[0], return_inverse=True, return_counts=True)
            self.columns = [distinct]
        else:
            order = np.lexsort(low[::-1])
            a, b = low[0][order], low[1][order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
            self.inverse = np.empty(len(a), np.int64)
            self.inverse[order] = np.cumsum(new) - 1
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(a)))
            self.columns = [a[at], b[at]]
        self.columns[-1] = (self.columns[-1] << np.uint64(1)) | (counts > 1).astype(np.uint64)
        bucket = (mix(self.columns[0] + _K) % np.uint64(buckets)).astype(np.int64) if len(low) > 1 else (mix(distinct + _K) % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order]
        self.cuts = np.flatnonzero(np.append(True, self.bucket[1:] != self.bucket[:-1]))[: len(self.bucket)]

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        for a, b in zip(self.cuts, np.append(self.cuts[1:], len(self.bucket)), strict=True):
            yield int(self.bucket[a]), b"".join(c[self.order[a:b]].tobytes() for c in self.columns)

    def answered(self, bits: dict[int, bytes]) -> np.ndarray:
        """For each key asked, whether it occurs more than once."""
        out = np.zeros(len(self.bucket), bool)
        for a, b in zip(self.cuts, np.append(self.cuts[1:], len(self.bucket)), strict=True):
            out[self.order[a:b]] = np.unpackbits(np.frombuffer(bits[int(self.bucket[a])], np.uint8), count=b - a)
        return out[self.inverse]


def _repeated(asked: DataFrame, width: int) -> DataFrame:
    """``gid, bits array<struct<bucket,bits>>``: which keys of each blob occur in another one, or twice in one."""

    def run(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x.as_buffer(), np.uint64).reshape(width, -1) for x in table.column("blob")]
        sizes = [b.shape[1] for b in blobs]
        keys = np.concatenate(blobs, axis=1)
        weight = 1 + (keys[-1] & np.uint64(1)).astype(np.int64)
        keys = [*keys[:-1], keys[-1] >> np.uint64(1)]
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[order[1:]] != k[order[:-1]]
        group = np.cumsum(new) - 1
        many = np.bincount(group, weight[order]) > 1
        flags = np.empty(len(order), bool)
        flags[order] = many[group]
        parts = np.split(flags, np.cumsum(sizes)[:-1])
        return pa.table({"gid": table.column("gid"), "bucket": table.column("bucket"), "bits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())})

    answers = asked.groupBy("bucket").applyInArrow(run, "gid long, bucket int, bits binary")
    return answers.groupBy("gid").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))


class Pack:
    """A pack's words, its anchors, and the windows of the anchors that occur more than once."""

    def __init__(self, row: dict, buckets: int, bits: list[dict] | None):
        self.raw = np.frombuffer(pa.Codec("zstd").decompress(row["body"], row["raw"], asbytes=True), np.uint8) if row["raw"] else np.zeros(0, np.uint8)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.begin, self.end, self.first = words_of(self.raw, self.offsets)
        keys = np.frombuffer(row["keys"], np.uint64)
        jump, extra = (np.frombuffer(pa.Codec("zstd").decompress(row[c], 4 * len(keys), asbytes=True), np.int32).astype(np.int64) if len(keys) else np.zeros(0, np.int64) for c in ("first", "last"))
        hot = Asked([keys], buckets).answered({x["bucket"]: x["bits"] for x in bits}) if len(keys) else np.zeros(0, bool)
        start, n = np.cumsum(jump)[hot], extra[hot] + 1
        self.windows = np.repeat(start - np.append(0, np.cumsum(n))[:-1], n) + np.arange(int(n.sum()))

    def fingerprints(self) -> list[np.ndarray]:
        return [span_hash(bytes_hash(self.raw, self.begin, self.end, k), self.windows, self.windows + WINDOW, k) for k in (0, 1)]

    def removed(self, hit: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(self.begin) + 1, np.int64)
        np.add.at(edge, self.windows[hit], 1)
        np.add.at(edge, self.windows[hit] + WINDOW, -1)
        return np.cumsum(edge)[:-1] > 0


def dedup_passages(docs: DataFrame, each: Callable[[bytes, int, int], tuple], columns: str, kinds: list[pa.DataType]) -> DataFrame:
    """``doc_id`` and what ``each(kept words joined by spaces, words, removed words)`` gives for each document."""
    packs = checkpoint(_packed(text_batches(docs)))
    # A bucket is one table of one task, so there are as many as the counted keys need, however many partitions there are.
    asked_bytes = packs.agg(F.sum(F.length("keys"))).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-asked_bytes // BUCKET_BYTES))

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("substrings")
        for batch in batches:
            for gid, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if keys:
                    yield _blobs(gid, Asked([np.frombuffer(keys, np.uint64)], buckets))

    def _blobs(gid: int, asked: Asked) -> pa.RecordBatch:
        found = list(asked.blobs())
        return pa.RecordBatch.from_arrays([pa.array([gid] * len(found), pa.int64()), pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["gid", "bucket", "blob"])

    schema = "gid long, bucket int, blob binary"
    known = checkpoint(_repeated(packs.select("gid", "keys").mapInArrow(ask_anchors, schema), 1))

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("substrings")
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                pack = Pack(row, buckets, row["anchor_bits"])
                if len(pack.windows):
                    yield _blobs(row["gid"], Asked(pack.fingerprints(), buckets))

    # Both uses below take every column of this join, so Spark shuffles the packs once.
    with_anchors = packs.join(known.withColumnRenamed("bits", "anchor_bits"), "gid", "left")
    verified = _repeated(with_anchors.mapInArrow(ask_windows, schema), 2)
    both = with_anchors.join(verified.withColumnRenamed("bits", "window_bits"), "gid", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("substrings")
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                pack = Pack(row, buckets, row["anchor_bits"])
                gone = np.zeros(len(pack.begin), bool)
                if len(pack.windows):
                    gone = pack.removed(Asked(pack.fingerprints(), buckets).answered({x["bucket"]: x["bits"] for x in row["window_bits"]}))
                raw, out = pack.raw.tobytes(), []
                sums = np.append(0, np.cumsum(gone))
                for d in range(len(row["docs"])):
                    a, b = int(pack.first[d]), int(pack.first[d + 1])
                    n_gone = int(sums[b] - sums[a])
                    words = raw[pack.offsets[d] : pack.offsets[d + 1]].split() if n_gone < b - a else []
                    if 0 < n_gone < b - a:
                        words = [w for w, g in zip(words, gone[a:b], strict=True) if not g]
                    out.append(each(b" ".join(words), b - a, n_gone))
                yield pa.RecordBatch.from_arrays([pa.array(row["docs"], pa.int64()), *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]], names=["doc_id", *[c.split()[0] for c in columns.split(", ")]])

    return both.mapInArrow(finish, f"doc_id long, {columns}")


def kept_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, kept, n_words, n_removed``."""
    return dedup_passages(docs, lambda kept, n, gone: (kept.decode(), n, gone), "kept string, n_words long, n_removed long", [pa.string(), pa.int64(), pa.int64()])


def op5(docs: DataFrame) -> DataFrame:
    return dedup_passages(docs, lambda kept, n, gone: (n, gone, hashlib.sha256(kept).hexdigest()), "n_words long, n_removed long, kept_sha256 string", [pa.int64(), pa.int64(), pa.string()])
