"""Token ids in bit-packed files.

A file image is: a header; a table of documents (id, whether it is null, where its ids start); the byte offset of each
block; the blocks. A block holds ``BLOCK`` ids, each in the fewest bits that the vocabulary needs, lowest bit first, so
block ``b`` is found without reading others and numpy unpacks it in one step. Images hold about ``IMAGE_IDS`` ids and
whole documents. The images of a table are written as rows of a Spark table, whose commit survives lost executors and
whose path may be in any store; ``Image(bytes)`` reads one, wherever it was put.

Ids come from the tokenizers library. Its pre-tokenizer never joins what stands on the two sides of a single space
between two other characters, so texts are cut there and each distinct piece is encoded once for each worker, in
batches, within a bounded cache. Texts that hold the text of an added token are encoded whole.

Null texts count as empty and hold the end id only. Documents are ordered by doc_id, null first; rows with equal ids
are ordered by text. Repeated rows are written as often as they stand there. An empty table gives no images and no
rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.llm.common import Known, held, partitions, scratch, slices, text_batches

MAGIC = b"LTK1"
HEAD = struct.Struct("<4sHHIQQ")
BLOCK = 4096
IMAGE_IDS = 1 << 20
#: Bytes that a worker's cache of pieces may take, by a rough count; half of them for each of its two generations.
CACHE_BYTES = 200 << 20
#: Marks the key of a text's first piece, before which no space stands; texts that hold it are encoded whole.
FIRST = "\x00"
#: Marks the key of a piece with white space at an edge, which the quick cut must not find.
EDGE = "\x00\x01"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def packed(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, lowest bit first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpacked(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (each.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def image(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, bits: int) -> bytes:
    """The bytes of one file."""
    blocks = [packed(ids[at : at + BLOCK], bits) for at in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    table = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([HEAD.pack(MAGIC, 1, bits, BLOCK, len(counts), len(ids)), table.tobytes(), known.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class Image:
    """A reader of one file's bytes, with access to any document or block."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.block, n, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        at = HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.known = np.frombuffer(data, np.uint8, n, at := at + 8 * n)
        self.starts = np.frombuffer(data, "<u8", n + 1, at := at + n)
        self.offsets = np.frombuffer(data, "<u8", -(-self.n_ids // self.block) + 1, at := at + 8 * (n + 1))
        self.body = memoryview(data)[at + self.offsets.nbytes :]

    def block_ids(self, b: int) -> np.ndarray:
        n = min(self.block, self.n_ids - b * self.block)
        return unpacked(self.body[int(self.offsets[b]) : int(self.offsets[b + 1])], self.bits, n)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the file's document number ``k``, reading only its blocks."""
        start, end = int(self.starts[k]), int(self.starts[k + 1])
        if start == end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        found = [self.block_ids(b) for b in range(first, last + 1)]
        return np.concatenate(found)[start - first * self.block : end - first * self.block]

    def all_ids(self) -> np.ndarray:
        return np.concatenate([self.block_ids(b) for b in range(len(self.offsets) - 1)]) if self.n_ids else np.zeros(0, np.uint32)


def raw_piece(key: str) -> str:
    """The text that a cache key stands for."""
    key = key.removeprefix(EDGE)
    return key[1:] if key[:1] == FIRST else " " + key


class Encoder:
    """Texts to little-endian 32-bit ids, by way of pieces that are encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # In a byte-level vocabulary a character of a token stands for a byte.
        self.lengths = np.zeros(self.vocabulary, np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.lengths[i] = len(token)
        self.known, self.old = Known([]), Known([])

    def fill(self, keys: Iterable[str]) -> None:
        """Makes all ``keys`` known."""
        missing = list(set(keys).difference(self.known.number))
        again = [k for k in missing if k in self.old.number]
        if again:
            self.known.add(again, *self.old.ids(again, len(again)))
        new = [k for k in missing if k not in self.old.number]
        # Pieces with a space in front are encoded in a row, as in a text, and told apart by the bytes of their tokens.
        plain = [p for p in new if p[0] != FIRST]
        alone = [p for p in new if p[0] == FIRST]
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            ids = np.array(self.library.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, np.int32)
            wanted = np.cumsum(np.fromiter([len(p.encode()) + 1 for p in some], np.int64, len(some)))
            ends = np.cumsum(self.lengths[ids])
            last = np.searchsorted(ends, wanted)
            if len(ends) and last[-1] == len(ends) - 1 and (ends[last] == wanted).all():
                self.known.add(some, ids, np.diff(last, prepend=-1))
            else:
                alone += some
        for at in range(0, len(alone), 4096):
            some = alone[at : at + 4096]
            found = [e.ids for e in self.library.encode_batch_fast([raw_piece(p) for p in some], add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.known.add(some, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes)
        self.known.settle()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. A piece that is empty or begins or ends with white space shows that its text is to be cut
        again by the full rule."""
        whole: dict[int, bytes] = {}
        keys: list[list[str]] = []
        recut = []
        for k, text in enumerate(texts):
            if not text:
                keys.append([])
            elif FIRST in text or any(a in text for a in self.added):
                ids = self.library.encode(text, add_special_tokens=False).ids
                whole[k] = struct.pack(f"<{len(ids)}I", *ids)
                keys.append([])
            else:
                pieces = text.split(" ")
                if not pieces[0] or pieces[0][-1].isspace():
                    recut.append(k)
                pieces[0] = FIRST + pieces[0]
                keys.append(pieces)
        missing = set(chain.from_iterable(keys)).difference(self.known.number)
        odd = {p for p in missing if not p or p[0].isspace() or p[-1].isspace()}
        if odd:
            recut += [k for k, pieces in enumerate(keys) if not odd.isdisjoint(pieces)]
        for k in set(recut):
            pieces = _CUT.split(texts[k])
            keys[k] = [EDGE * (p[0].isspace() or p[-1].isspace()) + (p if n else FIRST + p) for n, p in enumerate(pieces)]
        self.fill(chain(missing - odd, *[keys[k] for k in set(recut)]))
        n = np.array([len(x) for x in keys], np.int64)
        ids, sizes = self.known.ids(chain.from_iterable(keys), int(n.sum()))
        at = 4 * np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(n))]
        data = ids.astype("<u4").tobytes()
        if self.known.bytes > CACHE_BYTES // 2:
            self.old, self.known = self.known, Known([])
        return [whole.get(k, data[a:b]) for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))]


def encoder_of(path: str) -> Encoder:
    """The encoder of this worker process, with the pieces it has met."""
    return held(f"tokenizer {path}", lambda: Encoder(path))


_FILES = "shard int, part int, n_docs long, n_ids long, before long, image binary"


def token_images(docs: DataFrame, tokenizer: str, end_id: int, shards: int | None = None) -> DataFrame:
    """One row for each file image, in ascending order of doc_id by ``(shard, part)``; ``before`` counts the ids of
    the shard's earlier images."""
    n = shards or partitions(docs.sparkSession)
    ranged = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, part, before = encoder_of(tokenizer), TaskContext.get().partitionId(), 0, 0
        bits, end = bits_for(max(encoder.vocabulary, end_id + 1)), np.array([end_id], "<u4").tobytes()
        ids, counts, data, filled = [], [], [], 0

        def row() -> pa.RecordBatch:
            body = image(ids, counts, np.frombuffer(b"".join(data), "<u4"), bits)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int32()), (part, pa.int32()), (len(ids), pa.int64()), (filled, pa.int64()), (before, pa.int64()), (body, pa.binary()))], names=["shard", "part", "n_docs", "n_ids", "before", "image"])

        for batch in batches:
            for some in slices(batch, "text"):
                for doc, found in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist()), strict=True):
                    ids.append(doc)
                    data += (found, end)
                    counts.append(len(found) // 4 + 1)
                    filled += counts[-1]
                    if filled >= IMAGE_IDS:
                        yield row()
                        part, before = part + 1, before + filled
                        ids, counts, data, filled = [], [], [], 0
        if ids:
            yield row()

    return ranged.mapInArrow(run, _FILES)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, shards: int | None = None) -> None:
    """Writes the images of ``docs`` to ``path``."""
    token_images(docs, tokenizer, end_id, shards).write.option("compression", "uncompressed").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files at ``path``."""
    files = spark.read.schema(_FILES).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    first = totals.select("shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("first"))
    # One row of two numbers for each shard, so its size is bounded by the number of shards the writer chose.
    placed = files.join(F.broadcast(first), "shard").select((F.col("first") + F.col("before")).alias("at"), "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = Image(data.as_py())
                ids, starts = file.all_ids().astype("<u4"), file.starts.astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                doc = pa.array(file.doc_ids.astype(np.int64), mask=file.known == 0)
                yield pa.RecordBatch.from_arrays([doc, pa.array(starts[:-1] + at), pa.array(np.diff(starts)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path)
