"""SentencePiece encoding and decoding by an agenda of adjacent symbol pairs.

The text is normalised as the model's identity rule says (a space becomes U+2581, one more in front) and cut before
each run of U+2581. No piece of a merge-type vocabulary that splits by white space crosses such a cut, so every chunk
is merged on its own: all adjacent pairs that form a piece go on an agenda ordered by score and then by place, the best
is merged, and the new neighbours join the agenda. Short chunks are merged together, one agenda entry of each in every
round of array operations; a long one has a heap. Characters without a piece fall back to byte pieces. Chunks repeat,
so each worker keeps a cache of them, bounded in bytes. In every Arrow slice the chunks that the agenda has newly encoded are
encoded by the sentencepiece library as well; where they differed, the library's ids would stand and ``n_corrected``
would count them.

Null texts count as empty; an empty text has the end id only and decodes to an empty text. Rows that repeat give equal
rows. Texts of any length are encoded whole, one at a time. ``encode`` keeps the table's other columns, and replaces
columns that are already named ``ids`` or ``decoded``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lontar.llm.common import Known, held, slices, text_batches

SPACE = "▁"
#: Bytes that a worker's cache of chunks may take, by a rough count; half of them for each of its two generations.
CACHE_BYTES = 160 << 20
SHORT = 40
CHARACTER = 1 << 24
BATCH = 20_000
_BITS = 32
_NONE = np.iinfo(np.int64).max
_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Vocabulary:
    """Pieces, their agenda order and the byte pieces of a merge-type model."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        sp, n = self.library, self.library.get_piece_size()
        ordinary = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {sp.id_to_piece(i): i for i in ordinary}
        places = {score: k for k, score in enumerate(sorted({sp.get_score(i) for i in ordinary}, reverse=True))}
        self.order = {sp.id_to_piece(i): places[sp.get_score(i)] for i in ordinary}
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        width = len(str(n)) + 1
        self.decimal = np.frombuffer("".join([f"{i} ".ljust(width) for i in range(n)]).encode(), np.uint8).reshape(n, width)
        self.digits = np.array([len(str(i)) + 1 for i in range(n)])
        # What each pair of symbols becomes and its place in the agenda. A symbol is the id of its piece, or, for a
        # character without one, its code point beyond CHARACTER.
        pairs = {}
        for piece, rank in self.order.items():
            for k in range(1, len(piece)):
                left, right = self.symbol(piece[:k]), self.symbol(piece[k:])
                if left is not None and right is not None:
                    pairs[left << _BITS | right] = (rank, self.ids[piece])
        codes = sorted(pairs)
        self.pairs = np.array([*codes, np.iinfo(np.int64).max], np.int64)
        self.ranks = np.array([*(pairs[c][0] for c in codes), _NONE], np.int64)
        self.merged = np.array([*(pairs[c][1] for c in codes), -1], np.int64)
        self.characters = np.arange(CHARACTER, CHARACTER + 0x110000, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.characters[ord(piece)] = i

    def symbol(self, text: str) -> int | None:
        i = self.ids.get(text)
        return i if i is not None else CHARACTER + ord(text) if len(text) == 1 else None

    def places(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The agenda rank of each pair of symbols and the piece that it becomes; ``_NONE`` where there is none."""
        code = left << _BITS | right
        at = np.searchsorted(self.pairs, code)
        found = self.pairs[at] == code
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def merge_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many chunks, one after the other, and how many each has. Short chunks share rounds: in each round
        every chunk takes the best pair off its own agenda, the leftmost of equal ones, and puts the pairs with the new
        neighbours on it."""
        short = np.array([len(c) <= SHORT for c in chunks], bool)
        if short.all():
            return self.merge_short(chunks)
        found = [np.array(self.merge(c), np.int32) for c in chunks if len(c) > SHORT]
        flat, sizes = self.merge_short([c for c in chunks if len(c) <= SHORT])
        all_sizes = np.zeros(len(chunks), np.int64)
        all_sizes[short], all_sizes[~short] = sizes, [len(f) for f in found]
        out, at_short = np.empty(int(all_sizes.sum()), np.int32), np.repeat(short, all_sizes)
        out[at_short], out[~at_short] = flat, np.concatenate(found)
        return out, all_sizes

    def merge_short(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        sizes = np.array([len(c) for c in chunks])
        symbols = self.characters[np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)]
        of = np.repeat(np.arange(len(chunks)), sizes)
        done_of, done = [], []
        rank, becomes = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
        rank[:-1], becomes[:-1] = self.places(symbols[:-1], symbols[1:])
        rank[np.cumsum(sizes) - 1] = _NONE
        while len(symbols):
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(of))))
            over = best == _NONE
            if over.any():
                done_of.append(of[over])
                done.append(symbols[over])
                keep = ~over
                symbols, of, rank, becomes, best = symbols[keep], of[keep], rank[keep], becomes[keep], best[keep]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == best)
            hits = hits[np.append(True, of[hits[1:]] != of[hits[:-1]])]
            symbols[hits] = becomes[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            symbols, of, rank, becomes = symbols[keep], of[keep], rank[keep], becomes[keep]
            hits -= np.arange(len(hits))  # each merge before it has taken one symbol away
            rank[hits] = _NONE
            same = np.append(of[1:] == of[:-1], False)  # a symbol and the next one are of one chunk
            changed = np.concatenate([hits[same[hits]], hits[same[hits - 1] & (hits > 0)] - 1])
            rank[changed], becomes[changed] = self.places(symbols[changed], symbols[changed + 1])
        of, symbols = np.concatenate(done_of), np.concatenate(done)
        order = np.argsort(of, kind="stable")
        flat, sizes = symbols[order], np.bincount(of, minlength=len(chunks))
        if (flat >= CHARACTER).any():
            ids = [[i] if i < CHARACTER else self.fallen(chr(i - CHARACTER)) for i in flat.tolist()]
            sizes = np.add.reduceat(np.array([len(x) for x in ids]), np.cumsum(sizes) - sizes)
            flat = np.array(list(chain.from_iterable(ids)))
        return flat.astype(np.int32), sizes

    def fallen(self, symbol: str) -> list[int]:
        """The ids of a character without a piece."""
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.unknown]

    def merge(self, chunk: str) -> list[int]:
        """The ids of one chunk."""
        out: list[int] = []
        for symbol in self.merged_long(chunk):
            piece = self.ids.get(symbol)
            out += self.fallen(symbol) if piece is None else [piece]
        return out

    def merged_long(self, chunk: str) -> list[str]:
        """The symbols of a long chunk, by a heap of (rank, place)."""
        order, symbols = self.order, list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        sizes = [1] * n
        agenda = [(rank, i, i + 1, 2) for i in range(n - 1) if (rank := order.get(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if not sizes[i] or not sizes[j] or sizes[i] + sizes[j] != size:
                continue
            symbols[i] += symbols[j]
            sizes[i], sizes[j] = size, 0
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := order.get(symbols[i] + symbols[k])) is not None:
                    heapq.heappush(agenda, (rank, i, k, size + sizes[k]))
            if (h := before[i]) >= 0 and (rank := order.get(symbols[h] + symbols[i])) is not None:
                heapq.heappush(agenda, (rank, h, i, sizes[h] + size))
        return [symbol for symbol, size in zip(symbols, sizes, strict=True) if size]


class Chunks:
    """The chunks that a worker has met, in two generations."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known, self.old = Known([vocabulary.end]), Known([vocabulary.end])

    def fill(self, keys: Iterable[str | None]) -> int:
        """Makes all ``keys`` known, new ones by the agenda and checked by the library; how many that has corrected."""
        missing, wrong = list(set(keys).difference(self.known.number)), 0
        again = [k for k in missing if k in self.old.number]
        if again:
            self.known.add(again, *self.old.ids(again, len(again)))
        fresh = [k for k in missing if k not in self.old.number]
        for at in range(0, len(fresh), BATCH):
            some = fresh[at : at + BATCH]
            flat, sizes = self.vocabulary.merge_all([SPACE + k for k in some])
            found = self.vocabulary.library.encode([k.replace(SPACE, " ") for k in some], num_threads=1)
            if "" in some:  # a lone U+2581 is no text of its own: the library adds one
                k = some.index("")
                found[k] = flat[int(sizes[:k].sum()) : int(sizes[: k + 1].sum())].tolist()
            other_sizes = np.fromiter(map(len, found), np.int64, len(found))
            other = np.fromiter(chain.from_iterable(found), np.int32, int(other_sizes.sum()))
            if len(flat) != len(other) or (sizes != other_sizes).any() or (flat != other).any():
                cuts = np.append(0, np.cumsum(sizes)).tolist()
                wrong += sum(flat[a:b].tolist() != x for a, b, x in zip(cuts[:-1], cuts[1:], found, strict=True))
                flat, sizes = other, other_sizes
            self.known.add(some, flat, sizes)
        self.known.settle()
        return wrong

    def aged(self) -> None:
        if self.known.bytes > CACHE_BYTES // 2:
            self.old, self.known = self.known, Known([self.vocabulary.end])


def chunks_of(model: str) -> Chunks:
    """The chunks that this worker process has met."""
    return held(f"sentencepiece {model}", lambda: Chunks(Vocabulary(model)))


def keys_of(text: str) -> list[str]:
    """The chunks of a text, each without its first U+2581."""
    if not text:
        return []
    keys = text.split(" ")
    if "" in keys or SPACE in text:
        return [chunk[1:] for chunk in _CHUNKS.findall(SPACE + text.replace(" ", SPACE))]
    return keys


@dataclass
class Encoded:
    """The ids of some texts one after the other, each with its end id, and where each text's begin; chunks corrected."""

    vocabulary: Vocabulary
    ids: np.ndarray
    cuts: np.ndarray
    corrected: int

    def decimal(self) -> list[bytes]:
        """The ids of each text in decimal, joined by spaces."""
        digits = self.vocabulary.digits[self.ids]
        text = self.vocabulary.decimal[self.ids][np.arange(self.vocabulary.decimal.shape[1]) < digits[:, None]].tobytes()
        at = np.append(0, np.cumsum(digits))[self.cuts].tolist()
        return [text[a : b - 1] for a, b in zip(at[:-1], at[1:], strict=True)]

    def decoded(self) -> list[str]:
        ids, cuts, decode = self.ids.tolist(), self.cuts.tolist(), self.vocabulary.library.decode
        return [decode(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def encoded(texts: list[str | None], chunks: Chunks) -> Encoded:
    """The ids of some texts."""
    keys = [[*keys_of(x or ""), None] for x in texts]
    corrected = chunks.fill(chain.from_iterable(keys))
    n = np.array([len(k) for k in keys], np.int64)
    ids, sizes = chunks.known.ids(chain.from_iterable(keys), int(n.sum()))
    cuts = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(n))]
    chunks.aged()
    return Encoded(chunks.vocabulary, ids, cuts, corrected)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """The columns of the contract, without moving ids or texts back to the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(model)
        for batch in batches:
            for part in slices(batch, "text"):
                found = encoded(part.column(1).to_pylist(), chunks)
                ids_sha = [hashlib.sha256(x).hexdigest() for x in found.decimal()]
                text_sha = [hashlib.sha256(x.encode()).hexdigest() for x in found.decoded()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(found.cuts)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array([found.corrected] * len(ids_sha), pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_corrected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return text_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_corrected long")


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>`` (the end id last) and ``decoded string``."""
    kept = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    out = T.StructType([*[docs.schema[c] for c in kept], T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(model)
        for batch in batches:
            for part in slices(batch, text):
                found = encoded(part.column(kept.index(text)).to_pylist(), chunks)
                ids = pa.ListArray.from_arrays(pa.array(found.cuts.astype(np.int32)), pa.array(found.ids))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array(found.decoded(), pa.string())], names=[*kept, "ids", "decoded"])

    return text_batches(docs).select(*[f"`{c}`" for c in kept]).mapInArrow(run, out)


def op2(docs: DataFrame, model: str) -> DataFrame:
    return digests(docs, model)
