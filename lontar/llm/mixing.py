"""Mixing sources to target weights, in native expressions.

Blocks. Each source's words, in a fixed order of its documents, are packed into blocks of ``block_words`` words; the last
one may be short. Targets. A source's target is its weight's share of all words, at most ``cap`` times its own words;
what a capped source leaves is shared again by weight. Draw. The output is a row of shards of ``shard_slots`` slots, a
block in each. How many slots of a shard each source gets is a multinomial draw with the targets as probabilities: every
slot draws its source by a hash of seed, shard and slot. A source's draws are numbered through the shards. Those beyond
its target are left empty; what the draw leaves short fills one more shard. Map. Draw number ``t`` of a source of ``n``
blocks takes, in pass ``t div n``, the block at place ``t mod n`` of a pseudorandom permutation of the source's blocks,
another one for each pass, so no block is used more than ``ceil(cap)`` times. The last draw of a source takes only the
first words of its block, so many that the source's words are its target, rounded. Join. Blocks meet the documents that
they hold by index. Permutations are swap-or-not shuffles: bijections of [0, n) for any n, computed and inverted for each
index on its own, without state.

Documents without words take part in nothing (``taken`` 0). A null source is a source of its own, last in order. Rows
that repeat are documents of their own with equal shares in the order. An empty table gives an empty result. Columns
other than ``doc_id``, ``text`` and ``source`` are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lontar.llm.common import WORD, Shelf

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK_WORDS = 2048
SHARD_SLOTS = 4096
ROUNDS = 8
#: Cells of [0, 1) that a drawn number falls in before it is compared with the borders of the sources.
CELLS = 1 << 12
_RUN = 1 << 14
_UNIT = float(1 << 53)


def permuted(index: Column, n: Column, *seed: Column, inverse: bool = False) -> Column:
    """The place of ``index`` in a pseudorandom order of [0, n): a swap-or-not shuffle keyed by ``seed``. Each round
    undoes itself, so the rounds in reverse are the inverse."""

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(*seed, r) - x, n)
        return F.when(F.xxhash64(*seed, r, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, index, swap)


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: the number of words of each text (null: 0)."""
    return docs.select("doc_id", "source", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).cast("long").alias("size"))


def _source_key() -> Column:
    """A text that tells the null source from all others."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS, seed: int = 1) -> DataFrame:
    """One row for each source: ``source, source_size, weight, target, words`` (the target in whole words), ``blocks``,
    ``slots`` (draws that it needs), ``last_words`` (what the last of them takes), and ``low`` and ``high``, its borders
    in [0, 1). A table of one short row for each source, so its windows need no key."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    by_cap = Window.orderBy("cap_ratio", F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
        .withColumn("most", (F.lit(cap) * F.col("source_size")).cast("double"))
        .withColumn("cap_ratio", F.col("most") / F.col("weight"))
    )
    total = F.sum("source_size").over(everything).cast("double")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    filled = sources.withColumn("level", level).withColumn("rank", F.row_number().over(by_cap))
    first_free = F.min(F.when(F.col("level") <= F.col("cap_ratio"), F.struct("rank", "level"))).over(everything)["level"]
    filled = filled.withColumn("target", F.least("most", F.coalesce(first_free, F.lit(0.0)) * F.col("weight")))
    size, width = F.col("source_size"), F.lit(block_words).cast("long")
    filled = filled.withColumn("words", F.round("target").cast("long")).withColumn("blocks", F.ceil(size / width).cast("long"))
    # Whole passes take all words. The rest comes from the next pass, in which the short block may come early.
    filled = filled.withColumns({"passes": F.when(size > 0, F.expr("words div source_size")).otherwise(0), "rest": F.when(size > 0, F.expr("words % source_size")).otherwise(0)})
    short = F.col("blocks") * width - size  # how many words the last block lacks
    at = F.when(F.col("blocks") > 0, permuted(F.col("blocks") - 1, F.greatest("blocks", F.lit(1)), F.lit(seed), _source_key(), F.col("passes"), inverse=True))
    more = F.ceil(F.col("rest") / width).cast("long")
    filled = filled.withColumns({"lacks": short, "at": at, "more": more})
    late = F.col("at") < F.col("more")  # the short block is among the first ``more`` of the pass
    filled = filled.withColumn("more", F.when(late & (F.col("more") * width - F.col("lacks") < F.col("rest")), F.col("more") + 1).otherwise(F.col("more")))
    early = F.when(F.col("at") < F.col("more") - 1, F.col("lacks")).otherwise(0)  # lacking before the last draw
    last = F.col("rest") - ((F.col("more") - 1) * width - early)
    filled = filled.withColumns({"slots": F.col("passes") * F.col("blocks") + F.col("more"), "last_words": F.when(F.col("more") > 0, last)})
    share = F.col("slots") / F.greatest(F.sum("slots").over(everything), F.lit(1))
    high = F.sum(share).over(order.rowsBetween(Window.unboundedPreceding, 0))
    filled = filled.withColumn("share", share).withColumn("high", high).withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0.0)))
    last_one = F.lead(F.lit(1)).over(order).isNull()
    return filled.select("source", "source_size", "weight", "target", "words", "blocks", "slots", "last_words", "low", F.when(last_one, F.lit(2.0)).otherwise(F.col("high")).alias("high"))


def draws(plan: DataFrame, shelf: Shelf, seed: int = 1, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``source, shard, n``: how many slots of each shard a source has drawn."""
    spark = plan.sparkSession
    cells = plan.where("slots > 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1).cast("long")))))
    cells = shelf.put(cells.select("cell", "source", "low", "high"))  # CELLS rows and one more for each source
    slots = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), 11) / F.lit(_UNIT)
    drawn = spark.range(slots).select("id", u.alias("u")).withColumn("cell", F.floor(F.col("u") * CELLS))
    hits = drawn.join(cells, "cell").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    return hits.groupBy("source", F.expr(f"id div {shard_slots}").alias("shard")).agg(F.count("*").alias("n"))


def _running(rows: DataFrame, group: list[str], order: str, value: str, name: str, chunk: int) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over earlier rows of the group. Two levels, within chunks of
    ``order`` and over their totals, so that a group of many rows is summed in many tasks."""
    rows = rows.withColumn("_chunk", F.expr(f"{order} div {chunk}"))
    earlier = Window.unboundedPreceding, -1
    inner = Window.partitionBy(*group, "_chunk").orderBy(order).rowsBetween(*earlier)
    outer = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(*earlier)
    tops = rows.groupBy(*group, "_chunk").agg(F.sum(value).alias("_all")).withColumn("_before", F.coalesce(F.sum("_all").over(outer), F.lit(0)))
    a, b = rows.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0))).alias("a"), tops.alias("b")
    same = F.col("a._chunk") == F.col("b._chunk")
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    kept = [f"a.{c}" for c in rows.columns if c != "_chunk"]
    return a.join(b.hint("merge"), same).select(*kept, (F.col(f"a.{name}") + F.col("b._before")).cast("long").alias(name))


def slots(plan: DataFrame, shelf: Shelf, seed: int = 1, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Every filled slot of the output: ``shard, slot, source, pass, block, words`` (null: the whole block)."""
    drawn = shelf.put(draws(plan, shelf, seed, shard_slots))
    counts = shelf.put(_running(drawn, ["source"], "shard", "n", "first", 1024))
    needs = plan.where("slots > 0").select("source", "blocks", "slots", "last_words")
    c, p = counts.alias("c"), needs.alias("p")
    kept = c.join(p, F.col("c.source").eqNullSafe(F.col("p.source"))).where("first < slots")
    in_shard = Window.partitionBy("shard").orderBy(F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    runs = kept.select("shard", "c.source", "blocks", "slots", "last_words", "first", "n").withColumn("at", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
    # What the draw leaves short: about the square root of a source's slots, in one shard after the others.
    top = counts.groupBy("source").agg(F.sum("n").alias("n")).alias("c")
    short = p.join(top, F.col("c.source").eqNullSafe(F.col("p.source")), "left").select("p.source", "blocks", "slots", "last_words", F.coalesce("n", F.lit(0)).alias("first")).where("first < slots")
    fill = short.select((F.lit(-1).cast("long")).alias("shard"), "source", "blocks", "slots", "last_words", "first", (F.col("slots") - F.col("first")).alias("n"), F.lit(0).cast("long").alias("at"))
    pieces = runs.unionByName(fill).withColumn("n", F.least("n", F.col("slots") - F.col("first")))
    pieces = pieces.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_RUN}"))))
    each = pieces.withColumn("k", F.explode(F.sequence(F.col("run") * _RUN, F.least((F.col("run") + 1) * _RUN, F.col("n")) - 1)))
    t, key = F.col("first") + F.col("k"), F.lit(seed)
    turn = F.expr("(first + k) div blocks")
    place = F.when(F.col("shard") >= 0, permuted(F.col("at") + F.col("k"), F.lit(shard_slots).cast("long"), key, F.col("shard"))).otherwise(t)
    return each.select(
        "shard",
        place.alias("slot"),
        "source",
        turn.alias("pass"),
        permuted(F.expr("(first + k) % blocks"), F.col("blocks"), key, _source_key(), turn).alias("block"),
        F.when(t == F.col("slots") - 1, F.col("last_words")).alias("words"),
    )


def placed(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``start``: the words of the source before the document. Two levels of running sums, so that a
    source with most rows is summed in many tasks: within chunks of a source's rows, then over its chunks."""
    chunks = max(1, math.isqrt(sizes.count()))
    rows = sizes.where("size > 0").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)))
    inner = Window.partitionBy("source", "chunk").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    outer = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = sizes.where("size > 0").groupBy("source", F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)).alias("chunk")).agg(F.sum("size").alias("words"))
    tops = tops.withColumn("before", F.coalesce(F.sum("words").over(outer), F.lit(0)))
    a, b = rows.alias("a"), tops.alias("b")
    joined = a.join(b.hint("merge"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.chunk") == F.col("b.chunk")))
    return joined.select("a.doc_id", "a.source", "a.size", (F.col("a.start") + F.col("b.before")).alias("start"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS, seed: int = 1, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row for each document: ``doc_id, source, size, source_size, target, taken, first_shard``, the last one the
    least number of a shard that holds words of the document (null: none; -1: the shard after the drawn ones)."""
    shelf = Shelf(docs.sparkSession, "mixing")
    sizes = shelf.put(sized(docs))
    plan = shelf.put(targets(sizes, weights, cap, block_words, seed))
    filled = slots(plan, shelf, seed, shard_slots)
    uses = shelf.put(filled.groupBy("source", "block").agg(F.count_if(F.col("words").isNull()).alias("whole"), F.max("words").alias("part"), F.min("shard").alias("first_shard")))
    rows = shelf.put(placed(sizes))
    end, low = F.col("start") + F.col("size"), F.col("block") * block_words
    pieces = rows.withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
    pieces = pieces.withColumns({"from": F.greatest(low, F.col("start")), "to": F.least(low + block_words, end)})
    p, u = pieces.alias("p"), uses.alias("u")
    # Blocks in use grow with the words, so they are never sent to all executors.
    taken = p.join(u.hint("merge"), F.col("p.source").eqNullSafe(F.col("u.source")) & (F.col("p.block") == F.col("u.block")), "left")
    in_part = F.greatest(F.least(F.col("p.block") * block_words + F.coalesce("part", F.lit(0)), "to") - F.col("from"), F.lit(0))
    words = (F.col("to") - F.col("from")) * F.coalesce("whole", F.lit(0)) + in_part
    taken = taken.groupBy("p.doc_id", "p.source", "p.start", "p.size").agg(F.sum(words).cast("long").alias("taken"), F.min("first_shard").alias("first_shard"))
    none = sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_shard"))
    out = taken.select("doc_id", "source", "size", "taken", "first_shard").unionByName(none).alias("o")
    s = plan.select("source", "source_size", "target").alias("s")
    return out.join(s, F.col("o.source").eqNullSafe(F.col("s.source"))).select("o.doc_id", "o.source", "o.size", "s.source_size", "s.target", "o.taken", "o.first_shard")


def mixed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: ``taken / size`` times, rounded up or down by a hash of the
    doc_id so that the mean is kept. Documents without words go. Rows that share a doc_id share the mean of their
    shares. All columns pass through, whatever their names."""
    share = mix(docs, seed=seed).where("size > 0").groupBy("doc_id").agg((F.sum("taken") / F.sum("size")).alias("share"))
    spread = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    copies = share.select(F.col("doc_id").alias("id"), F.floor(F.col("share") + spread).cast("int").alias("copies")).where("copies > 0")
    many = copies.select("id", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("id").alias("m")
    d = docs.alias("d")
    return d.join(many.hint("merge"), F.col("d.doc_id").eqNullSafe(F.col("m.id"))).select(*[f"d.`{c}`" for c in docs.columns])


def op9(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "first_shard")
