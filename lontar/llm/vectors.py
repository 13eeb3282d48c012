"""Near-duplicates and nearest neighbours of vectors.

A vector takes part if it is not null, has no null or non-finite component and is not zero. Vectors of different numbers
of components are never compared; each number has an index of its own. All arithmetic is in double precision on the
stored components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.llm.common import Shelf, mix, partitions
from lontar.llm.components import components

PIVOTS, NEAREST, SHARED = 256, 9, 3
APART = 0.9
COSINE = 0.98
#: Lists of more vectors are compared in blocks of so many rows, by matrix products; shorter ones by a join.
LONG_LIST, LIST_BLOCK = 32, 512

TABLES, PROJECTIONS = 8, 4
#: Cell widths, in spreads of the projections, and numbers of probes that an index chooses from, and the recall that it
#: asks of them on its sample.
CHOICES = ((0.5, 16), (1.0, 8), (1.0, 16), (1.5, 8), (1.5, 16), (1.5, 24))
RECALL = 0.97
SAMPLE = 2_000
BLOCK_ROWS = 1_024
K = 10


def usable(vector: str = "embedding") -> Column:
    """Whether a vector takes part, but for its number of components."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(array: pa.Array) -> np.ndarray:
    """A list column of vectors of one length as rows of doubles."""
    return np.asarray(array.flatten(), dtype=np.float64).reshape(len(array), -1)


def by_width(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vector in a list column: the length, which rows have it, and their vectors."""
    sizes = pc.list_value_length(array).to_numpy(zero_copy_only=False)
    for width in np.unique(sizes):
        rows = np.flatnonzero(sizes == width)
        yield int(width), rows, matrix(array.take(pa.array(rows)))


def sample(rows: DataFrame, n: int, *key: str) -> dict[int, np.ndarray]:
    """``n`` vectors of the table at most, those of the least hash of ``key``, so that the choice does not depend on the
    partitions; by their number of components."""
    found: dict[int, list] = {}
    for r in rows.select("embedding").orderBy(F.xxhash64(*key), *key).limit(n).collect():
        found.setdefault(len(r["embedding"]), []).append(r["embedding"])
    return {width: np.array(x, np.float64) for width, x in found.items()}


def reference_points(found: np.ndarray | None, width: int, n: int = PIVOTS, seed: int = 5) -> np.ndarray:
    """``n`` unit vectors of ``width`` components: up to half of them from the sample, no two within cosine ``APART`` (many points in one dense
    group would rank at random and share nothing), the rest random directions."""
    unit = np.zeros((0, width)) if found is None else found / np.linalg.norm(found, axis=1)[:, None]
    chosen: list[np.ndarray] = []
    for x in unit:
        if len(chosen) < n // 2 and (not chosen or (np.array(chosen) @ x).max() < APART):
            chosen.append(x)
    rest = np.random.default_rng(seed).normal(size=(n - len(chosen), width))
    return np.concatenate([np.array(chosen).reshape(-1, width), rest / np.linalg.norm(rest, axis=1)[:, None]])


def first_codes(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The code of the first list that each of some pairs of rows shares: that of its least common pivots."""
    common = (near[a][:, :, None] == near[b][:, None, :]).any(2)
    order = np.cumsum(common, axis=1)
    code = np.zeros(len(a), np.int64)
    for j in range(SHARED):
        at = np.argmax(common & (order == j + 1), axis=1)
        code = code * PIVOTS + near[a, at]
    return code


def least_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the least row that links lead to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _long_lists(entries: DataFrame, reps: DataFrame, cosine: float) -> DataFrame:
    """``k1, k2, n, r1, r2``: how many copies of other vectors each vector of a long list links with, and one vector
    that it is connected with, block by block of ``LIST_BLOCK`` rows or so against each other. What leaves a block is a
    row for each vector, not for each link."""
    spans = entries.withColumn("subs", F.ceil(F.col("n") / LIST_BLOCK)).withColumn("sub", F.pmod(F.xxhash64("k1", "k2"), F.col("subs")))
    spans = spans.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)))
    spans = spans.select("label", "width", "code", F.least("sub", "other").alias("lo"), F.greatest("sub", "other").alias("hi"), "sub", "k1", "k2", "near")
    rows = spans.join(reps.select("k1", "k2", "copies", "embedding"), ["k1", "k2"])

    def run(table: pa.Table) -> pa.Table:
        x = matrix(table.column("embedding").combine_chunks())
        near = np.array(table.column("near").to_pylist(), np.int64)
        sub, copies = table.column("sub").to_numpy(), table.column("copies").to_numpy()
        code, lo, hi = (table.column(c)[0].as_py() for c in ("code", "lo", "hi"))
        norms = np.sqrt((x * x).sum(1))
        left, right = np.flatnonzero(sub == lo), np.flatnonzero(sub == hi)
        close = (x[left] @ x[right].T) / norms[left][:, None] / norms[right]
        i, j = np.nonzero(close >= cosine - 1e-9)
        a, b = left[i], right[j]
        if lo == hi:
            a, b = a[a < b], b[a < b]
        parts = []
        for at in range(0, len(a), 1 << 16):
            p, q = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            keep = ((x[p] * x[q]).sum(1) / (norms[p] * norms[q]) >= cosine) & (first_codes(near, p, q) == code)
            parts.append((p[keep], q[keep]))
        a, b = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
        n = np.bincount(a, copies[b], len(x)) + np.bincount(b, copies[a], len(x))
        root, some = least_roots(len(x), a, b), np.flatnonzero(n)
        take, to = pa.array(some), pa.array(root[some], mask=root[some] == some)
        return pa.table({"k1": table.column("k1").take(take), "k2": table.column("k2").take(take), "n": pa.array(n[some].astype(np.int64)), "r1": table.column("k1").take(to), "r2": table.column("k2").take(to)})

    return rows.groupBy("label", "width", "code", "lo", "hi").applyInArrow(run, "k1 long, k2 long, n long, r1 long, r2 long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding, label)``.

    Pivot-permutation index: each vector is described by its ``NEAREST`` nearest of ``PIVOTS`` reference points, from a
    bounded sample and at random (all at random for a number of components that the sample does not hold). Inverted lists are kept for triples of pivots, so two vectors meet in a list as soon as they share
    ``SHARED`` pivots, and a list is far shorter than one of a single pivot. A pair counts in the first of its lists
    only; the shared count decides, then the cosine. Long lists, such as those of dense groups or of vectors in a cone, are
    compared in blocks, which give counts and a spanning forest of the links, not the links. Rows with equal vectors and labels are one entry of the index,
    and count as links of each other. Vectors without a label, and those that take no part, have no links and are
    their own component. Repeated rows count as vectors of their own; a row without vec_id has component null unless
    its links have ids.
    """
    shelf = Shelf(vectors.sparkSession, "vectors")
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    takes_part = F.col("label").isNotNull() & usable()
    keys = {"k1": F.xxhash64("label", "embedding"), "k2": F.xxhash64(F.lit(7), "label", "embedding")}
    reps = shelf.put(base.where(takes_part).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumns(keys))
    points = {width: reference_points(x, width) for width, x in sample(reps, SAMPLE, "k1", "k2").items()}
    nearest, shared = NEAREST, SHARED
    triples = np.array(list(combinations(range(nearest), shared)))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, code = np.zeros((batch.num_rows, nearest), np.int64), np.zeros((batch.num_rows, len(triples)), np.int64)
            for width, rows, x in by_width(batch.column(3)):
                if width not in points:
                    points[width] = reference_points(None, width)
                near[rows] = np.sort(np.argsort(-(x @ points[width].T), axis=1, kind="stable")[:, :nearest], axis=1)
            for j in range(shared):
                code = code * PIVOTS + near[:, triples[:, j]]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], pc.list_value_length(batch.column(3)), pa.array(near.astype(np.int16).tolist(), pa.list_(pa.int16())), pa.array(code.tolist(), pa.list_(pa.int64()))], names=["k1", "k2", "label", "width", "near", "codes"])

    kind = vectors.schema["label"].dataType.simpleString()
    described = shelf.put(reps.select("k1", "k2", "label", "embedding").mapInArrow(lists, f"k1 long, k2 long, label {kind}, width int, near array<smallint>, codes array<long>"))
    key = ["label", "width", "code"]
    entries = described.select("label", "width", F.explode("codes").alias("code"), "k1", "k2", "near")
    sizes = shelf.put(entries.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"))
    entries = entries.join(sizes, key)
    short = entries.where(F.col("n") <= LONG_LIST).select(*key, F.struct("k1", "k2").alias("v"), "near")
    a, b = short.alias("a"), short.alias("b")
    common = F.array_intersect("a.near", "b.near")
    first = F.lit(0).cast("long")
    for j in range(shared):
        first = first * PIVOTS + F.get(common, F.lit(j)).cast("long")
    pairs = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.width") == F.col("b.width")) & (F.col("a.code") == F.col("b.code")) & (F.col("a.v") < F.col("b.v"))).where(F.col("a.code") == first)
    pairs = pairs.select(F.col("a.v.k1").alias("a1"), F.col("a.v.k2").alias("a2"), F.col("b.v.k1").alias("b1"), F.col("b.v.k2").alias("b2"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for _, rows, x in by_width(batch.column(4)):
                y = matrix(batch.column(5).take(pa.array(rows)))
                norms = np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))
                keep[rows] = (x * y).sum(1) / norms >= cosine
            yield batch.select(["a1", "a2", "b1", "b2"]).filter(pa.array(keep))

    side = lambda s: reps.select(F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2"), F.col("embedding").alias(f"{s}v"))
    linked = shelf.put(pairs.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"]).select("a1", "a2", "b1", "b2", "av", "bv").mapInArrow(verify, "a1 long, a2 long, b1 long, b2 long"))

    name = lambda s: reps.select(F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2"), F.col("rep").alias(s), F.col("copies").alias(f"{s}n"))
    named = shelf.put(linked.join(name("a"), ["a1", "a2"]).join(name("b"), ["b1", "b2"]))
    dense = shelf.put(_long_lists(entries.where(F.col("n") > LONG_LIST), reps, cosine))
    roots = dense.where("r1 is not null").join(name("a").toDF("k1", "k2", "a", "an"), ["k1", "k2"]).join(name("b").toDF("r1", "r2", "b", "bn"), ["r1", "r2"])
    shelf.drop(described, linked, sizes)
    each = named.select("a1", "a2", "bn").toDF("k1", "k2", "n").union(named.select("b1", "b2", "an").toDF("k1", "k2", "n")).union(dense.select("k1", "k2", "n")).groupBy("k1", "k2").agg(F.sum("n").alias("others"))
    found = components(named.select("a", "b").union(roots.select("a", "b")).where("a is not null and b is not null"), shelf).withColumnRenamed("node", "rep")
    classes = reps.join(each, ["k1", "k2"], "left").join(found, "rep", "left")
    classes = shelf.put(classes.select("k1", "k2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component")))
    shelf.drop(reps, named, dense)
    marked = base.select("vec_id", *[F.when(takes_part, k).alias(n) for n, k in keys.items()])
    out = marked.join(classes, ["k1", "k2"], "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


class Hashes:
    """``TABLES`` p-stable hash functions of ``PROJECTIONS`` Gaussian projections each, and their probing order. Cell
    width and number of probes are the cheapest of ``CHOICES`` that find ``RECALL`` of the sample's own neighbours."""

    def __init__(self, fitted: np.ndarray, seed: int = 11, k: int = K):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, fitted.shape[1], PROJECTIONS))
        spread = max(float(np.std(np.concatenate([(fitted @ a).ravel() for a in self.a]))), 1e-9)
        shifts = rng.uniform(0, 1, (TABLES, PROJECTIONS))
        asked = fitted[:: max(1, len(fitted) // 100)]
        squares = (fitted * fitted).sum(1)
        far = squares[None] + (asked * asked).sum(1)[:, None] - 2 * asked @ fitted.T
        true = np.argsort(far, axis=1, kind="stable")[:, : k + 1]
        tried = []
        for width, probes in CHOICES:
            self.width, self.b, self.n_probes = width * spread, shifts * width * spread, probes
            seen = np.zeros(far.shape, bool)
            for t in range(TABLES):
                rows = bucket_ids(self.cells(fitted, t)[0], t)
                for q, (cell, inside) in enumerate(zip(*self.cells(asked, t), strict=True)):
                    seen[q] |= np.isin(rows, bucket_ids(self.probes(cell, inside), t))
            recall = float(np.take_along_axis(seen, true, 1).mean())
            tried.append((recall < RECALL, float(seen.mean()) if recall >= RECALL else -recall, width, probes))
        _, _, width, self.n_probes = min(tried)
        self.width, self.b = width * spread, shifts * width * spread

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector in table ``t``, and how far into the cell it lies (0 to 1)."""
        y = (x @ self.a[t] + self.b[t]) / self.width
        cell = np.floor(y)
        return cell.astype(np.int64), y - cell

    def probes(self, cell: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """The cells to visit for one query, likeliest first: its own, then sets of steps to neighbouring cells in
        ascending order of the summed squared distances to the borders that they cross."""
        steps = sorted([(f * f, m, -1) for m, f in enumerate(inside)] + [((1 - f) ** 2, m, 1) for m, f in enumerate(inside)])
        out, heap = [cell], [(steps[0][0], (0,))]
        while heap and len(out) < self.n_probes:
            cost, chosen = heapq.heappop(heap)
            if len({steps[i][1] for i in chosen}) == len(chosen):
                moved = cell.copy()
                for i in chosen:
                    moved[steps[i][1]] += steps[i][2]
                out.append(moved)
            last = chosen[-1]
            if last + 1 < len(steps):
                heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
                heapq.heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
        return np.array(out)


def bucket_ids(cells: np.ndarray, t: int, width: int = 0) -> np.ndarray:
    key = np.full(len(cells), (width << 16) + t + 1, np.uint64)
    for j in range(cells.shape[1]):
        key = mix(key ^ cells[:, j].astype(np.uint64))
    return key.view(np.int64)


def block_neighbours(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the ``k`` nearest rows of one block, itself left out: query ids, row ids, exact distances."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    squares = (x * x).sum(1)
    for at in range(0, len(q), 512):
        some, names = q[at : at + 512], query_ids[at : at + 512]
        near = squares[None] - 2 * some @ x.T
        near[names[:, None] == ids[None]] = np.inf
        kth = np.partition(near, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        scale = squares.max() + (some * some).sum(1)
        i, j = np.nonzero((near <= (kth + 1e-9 * scale)[:, None]) & np.isfinite(near))
        d = np.sqrt(((x[j] - some[i]) ** 2).sum(1))
        order = np.lexsort((ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        out.append((names[i[keep]], ids[j[keep]], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _searched(entries: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the nearest in each block of ``bucket, sub, part``."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            names, ids, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            names, ids, d = block_neighbours(left.column("vec_id").to_numpy(), matrix(left.column("embedding").combine_chunks()), right.column("query_id").to_numpy(), matrix(right.column("embedding").combine_chunks()), k)
        return pa.table({"query_id": pa.array(names, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(d, pa.float64())})

    key = ["bucket", "sub", "part"]
    return entries.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")


def _blocks(entries: DataFrame, queries: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame]:
    """Both with ``sub`` and ``part``: a bucket's rows in blocks, and its queries in blocks, ``BLOCK_ROWS`` or so in
    each; every block of rows meets every block of queries. Buckets that no query visits go."""
    some = lambda df, name: df.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(name))
    sizes = shelf.put(some(entries, "subs").join(some(queries, "parts"), "bucket"))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = entries.join(sizes, "bucket").withColumns({"sub": block("vec_id", "subs"), "part": every("parts")})
    again = sizes.select("bucket", F.col("subs").alias("n_subs"), F.col("parts").alias("n_parts"))
    asked = queries.join(again, "bucket").withColumns({"part": block("query_id", "n_parts"), "sub": every("n_subs")})
    n = partitions(entries.sparkSession)
    return rows.repartition(n, "bucket", "sub", "part"), asked.repartition(n, "bucket", "sub", "part")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_neighbours(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The exact search, in blocks of ``BLOCK_ROWS`` rows: what the index is measured against, and the way for queries
    that it gives too few candidates."""
    shelf, width = Shelf(rows.sparkSession, "exact"), F.size("embedding").cast("long").alias("bucket")
    found = _searched(*_blocks(rows.select(width, "vec_id", "embedding"), queries.select(width, F.col("vec_id").alias("query_id"), "embedding"), shelf), k)
    return _best(found, k)


def neighbours(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query row, by Euclidean distance.

    Multiprobe p-stable hashing: every row is filed in one cell of each of ``TABLES`` tables; a query visits
    ``PROBES`` cells of each, in the estimated order of success; the candidates of all tables are ranked by exact
    distance. Cell width and probes are fitted to a bounded sample; vectors of a number of components that the sample
    does not hold are in one cell. Cells of many rows are searched in blocks. A query that finds fewer than ``k`` rows
    (and fewer than there are) is searched exactly. Rows without vec_id take no part; rows that repeat a vec_id count
    once, with the smallest vector. An empty table gives no rows.
    """
    shelf = Shelf(vectors.sparkSession, "neighbours")
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null").where(usable())
    rows = shelf.put(whole.groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    queries = rows.where(is_query)
    hashes = {width: Hashes(x, k=k) for width, x in sample(rows, SAMPLE, "vec_id").items()}

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, x in by_width(batch.column(1)):
                own, h = [c.take(pa.array(at)) for c in batch.columns], hashes.get(width)
                for t in range(TABLES if h else 1):
                    cells = h.cells(x, t)[0] if h else np.zeros((len(x), 1), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket_ids(cells, t, width)), *own], names=["bucket", "vec_id", "embedding"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, x in by_width(batch.column(1)):
                h = hashes.get(width)
                for t in range(TABLES if h else 1):
                    visits = [h.probes(c, f) for c, f in zip(*h.cells(x, t), strict=True)] if h else list(np.zeros((len(x), 1, 1), np.int64))
                    take = pa.array(np.repeat(at, [len(v) for v in visits]))
                    yield pa.RecordBatch.from_arrays([pa.array(bucket_ids(np.concatenate(visits), t, width)), *[c.take(take) for c in batch.columns]], names=["bucket", "query_id", "embedding"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    filed = rows.select("vec_id", "embedding").mapInArrow(file, f"bucket long, vec_id long, embedding {kind}")
    asked = queries.select("vec_id", "embedding").mapInArrow(probe, f"bucket long, query_id long, embedding {kind}")
    best = shelf.put(_best(_searched(*_blocks(filed, asked, shelf), k), k))
    count = rows.groupBy(F.size("embedding").alias("width")).agg((F.count("*") - 1).alias("others"))
    got = best.groupBy("query_id").agg(F.count("*").alias("n"))
    short = queries.withColumn("width", F.size("embedding")).join(count, "width").join(got, F.col("vec_id") == F.col("query_id"), "left")
    short = shelf.put(short.where(F.coalesce("n", F.lit(0)) < F.least("others", F.lit(k))).select("vec_id", "embedding"))
    if not short.isEmpty():
        best = best.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(exact_neighbours(rows, short, k))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


def op7(vectors: DataFrame) -> DataFrame:
    return neighbours(vectors, F.col("vec_id") % 100 == 0)
