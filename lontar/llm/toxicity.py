"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities and counts of lexicon words (a fixed list, and words and word beginnings whose share of
toxic texts stands out among the training labels), lexicon words near a second-person pronoun, shares of capitals and
of shouted words, punctuation rates, rates of obfuscated words and of lexicon words behind obfuscation, and length.
Trees are fitted to the logistic loss on three quarters of the training rows; isotonic regression on the other quarter
turns their sums into probabilities. A sliver of the raw score breaks the ties of the isotonic steps.

Labels come only from rows whose crc32(doc_id as text) mod 5 is not 0. At most ``TRAIN_ROWS`` of them are used for each
label, those of the smallest hash; everything else covers all rows. When a training text is described, its own part of
the lexicon's counts is taken out. Labels, lang, source and doc_id are no inputs of a score.

Null texts count as empty; empty texts get the score of their (zero) features. Labels without a value are ignored; of
several labels for a doc_id the largest counts, and of several texts the least. Without labels of both kinds the score is the training share of toxic
rows (0 without any). Rows that repeat get equal scores. Other columns pass through ``score``; columns already named
``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lontar.llm.common import Shelf, held, partitions, slices, text_batches

TRAIN_ROWS = 10_000
LEXICON_SIZE = 5_000
LEAST_TEXTS = 5
LEAST_ODDS = 2.0
SLICE = 1 << 20
TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 32

# Plain insults, and second-person words of the corpus's languages.
INSULTS = frozenset("ass asshole bastard bitch braindead cretin clown coward crap creep damn dimwit disgusting dumb dumbass fool freak garbage hate idiot idiotic imbecile jerk kill liar loser lunatic moron moronic nasty pathetic pig rat retard rubbish scum shit shut sick stupid suck sucks swine trash ugly vermin vile worthless".split())
SECOND = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine sie ihr ihre euch tú usted ustedes vosotros ti tuyo".split())
LEET = str.maketrans("013457@$!|", "oieastasil")

_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"\b\w*[^\W\d_][0-9@$!|*]+[^\W\d_]\w*|\b[^\W\d_](?:[.\-*_ ][^\W\d_]){3,}\b")
_SHOUT = re.compile(r"\b[A-ZÀ-Þ]{3,}\b")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
NAMES = ("hits", "density", "kinds", "best", "sum", "insults", "insult_density", "near_you", "near_you_density", "you_density", "capitals", "shouted", "exclaims", "questions", "punctuation", "odd", "odd_hits", "stretched", "words")


def units(words: set[str]) -> set[str]:
    """What the lexicon learns from: words, and word beginnings of 3 to 8 letters (with ``^`` in front)."""
    out = set(words)
    for w in words:
        out.update("^" + w[:k] for k in range(3, min(8, len(w) - 1) + 1))
    return out


@dataclass
class Lexicon:
    """unit -> (toxic texts, clean texts), and the number of texts of each kind."""

    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    toxic: int = 0
    clean: int = 0

    def __post_init__(self) -> None:
        self._memo: dict[str, float] = {}

    def odds(self, a: int, b: int) -> float:
        if a < LEAST_TEXTS:
            return 0.0
        return math.log((a + 0.5) / (self.toxic + 1)) - math.log((b + 0.5) / (self.clean + 1))

    def word(self, w: str, own: int | None = None) -> float:
        """How much a word speaks for the toxic kind; ``own`` is the label of the text it is read in, if it was counted."""
        if own is None and (known := self._memo.get(w)) is not None:
            return known
        best = 0.0
        for u in units({w}):
            if (c := self.counts.get(u)) is not None:
                best = max(best, self.odds(c[0] - (own == 1), c[1] - (own == 0)))
        best = best if best >= LEAST_ODDS else 0.0
        if own is None:
            if len(self._memo) > 100_000:
                self._memo.clear()
            self._memo[w] = best
        return best


def describe(text: str | None, lexicon: Lexicon, own: int | None = None) -> list[float]:
    """The features of one text, in the order of ``NAMES``."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    kinds = set(words)
    weights = {w: s for w in kinds if (s := lexicon.word(w, own)) > 0}
    marked = weights.keys() | (kinds & INSULTS)
    hits = insults = near = 0
    total = 0.0
    if marked:
        places = [i for i, w in enumerate(words) if w in marked]
        for i in places:
            total += weights.get(words[i], 0.0)
            hits += words[i] in weights
            insults += words[i] in INSULTS
            near += not SECOND.isdisjoint(words[max(0, i - 5) : i + 6])
    you = sum(map(words.count, kinds & SECOND))
    odd = [x.group() for x in _ODD.finditer(text)] if text else []
    plain = ["".join(_WORD.findall(x.lower().translate(LEET))) for x in odd]
    odd_hits = sum(p in INSULTS or lexicon.word(p, own) > 0 for p in plain)
    size = max(1, len(text))
    return [
        hits, hits / n, len(weights), max(weights.values(), default=0.0), total, insults, insults / n, near, near / n, you / n,
        sum(map(str.isupper, text)) / size, len(_SHOUT.findall(text)) / n, text.count("!") / size, text.count("?") / size,
        (text.count(".") + text.count(",") + text.count(";") + text.count("*") + text.count("#")) / size, len(odd) / n, odd_hits, len(_LONG.findall(text)) / n, math.log1p(len(words)),
    ]


@dataclass
class Trees:
    """Boosted regression trees on binned features; leaves in level order."""

    edges: list[np.ndarray]
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), int)
        out = np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[np.arange(len(x)), feature[at]] > cut[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient boosting with Newton steps on histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
    edges = [np.unique(np.concatenate([e, [x[:, j][x[:, j] > 0].min(initial=np.inf)]])) for j, e in enumerate(edges)]
    edges = [e[np.isfinite(e)] for e in edges]
    binned = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)
    width = BINS + 2
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = math.log(share / (1 - share))
    f, trees = np.full(len(y), base), []
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, int), np.full(inner, width)
        at = np.zeros(len(y), int)
        for level in range(DEPTH):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-6)
            for j in range(x.shape[1]):
                key = (at - first) * width + binned[:, j]
                gs = np.bincount(key, g, n * width).reshape(n, width).cumsum(1)
                hs = np.bincount(key, h, n * width).reshape(n, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain = np.where((hs > 0.5) & (ht - hs > 0.5), gain, 0)
                k = gain.argmax(1)
                top = gain[np.arange(n), k]
                better = top > best
                best = np.where(better, top, best)
                feature[first : first + n][better] = j
                cut[first : first + n][better] = k[better]
            at = 2 * at + 1 + (binned[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - inner
        value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        f += value[leaf]
        trees.append((feature, cut, value))
    return Trees(edges, base, trees)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the raw values at which blocks start, and the blocks' shares."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, v in zip(raw[order], y[order], strict=True):
        if blocks and blocks[-1][3] == r:
            blocks[-1][1] += v
            blocks[-1][2] += 1
        else:
            blocks.append([r, v, 1.0, r])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
            blocks[-1][3] = last[3]
    middle = np.array([(b[0] + b[3]) / 2 for b in blocks])
    return middle, np.array([b[1] / b[2] for b in blocks])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    steps: tuple[np.ndarray, np.ndarray] | None
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        raw = self.trees.raw(x)
        plain = 1 / (1 + np.exp(-raw))
        if self.steps is None:
            return plain
        return 0.99 * np.interp(raw, *self.steps) + 0.01 * plain


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of the training labels."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out())
    order = F.xxhash64("doc_id"), F.col("doc_id")
    # At most 2 * rows pairs of numbers, so their size is bounded by the parameter.
    some = known.where("toxic = 1").orderBy(*order).limit(rows).union(known.where("toxic = 0").orderBy(*order).limit(rows))
    rows_in = text_batches(docs).select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    # One text for each doc_id, the least of several, so that no doc_id brings more rows than one.
    some_rows = rows_in.select("doc_id", "toxic", "text").repartition(partitions(docs.sparkSession), "doc_id")
    train = Shelf(docs.sparkSession, "toxicity").put(some_rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity")
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                toxic, clean = Counter(), Counter()
                for label, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    (toxic if label else clean).update(units(set(_WORD.findall(text.lower()))))
                names = list(toxic)  # units of clean texts only can't stand out
                names += [u for u in clean if u not in toxic]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[u] for u in names], pa.int64()), pa.array([clean[u] for u in names], pa.int64())], names=["unit", "a", "b"])

    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    share = n_toxic / max(1, n_toxic + n_clean)
    if not n_toxic or not n_clean:
        return Model(Lexicon(), None, None, share)
    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1)) - F.log((F.col("b") + 0.5) / (n_clean + 1))
    counted = train.mapInArrow(count, "unit string, a long, b long").groupBy("unit").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    top = counted.where(F.col("a") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS - 0.5).orderBy(F.desc(F.col("odds") * F.log1p("a")), "unit").limit(LEXICON_SIZE).collect()
    lexicon = Lexicon({r["unit"]: (r["a"], r["b"]) for r in top}, n_toxic, n_clean)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity")
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                labels_ = part.column(1).to_pylist()
                x = [describe(t, lexicon, y) for t, y in zip(part.column(2).to_pylist(), labels_, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "toxic", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    table = sorted(train.mapInArrow(features, f"doc_id {kind}, toxic int, x array<double>").collect(), key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in table])
    y = np.array([r["toxic"] for r in table], float)
    # Both kinds in both parts: every fourth row of each kind calibrates.
    turn = np.zeros(len(y), int)
    for v in (0, 1):
        turn[y == v] = np.arange(int((y == v).sum())) % 4
    fitted, rest = turn != 3, turn == 3
    if n_toxic + n_clean < 40 or len(set(y[rest])) < 2:
        return Model(lexicon, fit_trees(x, y), None, share)
    trees = fit_trees(x[fitted], y[fitted])
    return Model(lexicon, trees, isotonic(trees.raw(x[rest]), y[rest]), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more)."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    at = kept.index("text")
    out = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in kept], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity")
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                x = np.array([describe(t, model.lexicon) for t in part.column(at).to_pylist()])
                s = np.clip(model.scores(x), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*kept, "score", "predicted"])

    return text_batches(docs).select(*[f"`{c}`" for c in kept]).mapInArrow(run, out)


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
