"""Secret scans in native expressions: three known shapes, and windows of high Shannon entropy.

Entropy rule. A candidate is a run of 20 or more characters of ``[A-Za-z0-9+/_-]``. For each character class
(hexadecimal digits; letters, digits and ``+/_-``) a candidate that lies in the class is walked by a window of 20
characters: one count goes up and one goes down at each step, and the sum of ``c * log2 c`` follows by table look-up,
so a step costs the same whatever the window's size. No pattern repeats a group, so texts of any length are matched
without recursion, and places are running sums, so many matches in one text cost their number times its logarithm. A candidate whose best window reaches the class's threshold and
which mixes letters with digits is a secret. The allow-list suppresses candidates that are plainly something else:
all letters, all digits, UUIDs, paths and words joined by dashes or underscores.

Nulls count as empty texts. Empty texts have no spans, and their digest is that of the empty string. Repeated rows are
scanned alike, each on its own. Positions count code points. Other columns, whatever their names, pass through
``scan_secrets`` untouched as long as they do not end in ``_spans``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The shapes of the contract. Runs are maximal, so a lower bound on length can stand in the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
WINDOW = 20
#: Class name, pattern that the whole candidate matches, bits a character that its best window reaches.
CLASSES = (("hex", r"^[0-9A-Fa-f]+$", 3.0), ("base64", r"^[A-Za-z0-9+/_-]+$", 3.6))
ALLOWED = (r"^[A-Za-z]+$", r"^[0-9]+$", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", r"^/?[A-Za-z](?:[A-Za-z/_-]*[A-Za-z])?/?$")

_SPAN = "array<struct<start:int,kind:int,end:int>>"
KINDS = ("assign", "access", "hex", "entropy")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(sizes: Column) -> Column:
    """The sums of the first 1, 2, ... numbers of an array, by doubling: each step adds what stands 1, 2, 4, ... places
    before, so the work is the length times its logarithm, and no array grows item by item."""
    steps = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(sizes))) - 1), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(steps, sizes, lambda acc, k: F.transform(acc, lambda x, i: x + F.when(i >= k, F.get(acc, i - k)).otherwise(F.lit(0))))


def matches(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches as ``array<struct<start,kind,end,found>>``, by the pieces between them."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,found:string>>")

    def spans(found: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(found))
        sizes = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("found")), lambda x: x["gap"] + F.length(x["found"]))
        one = lambda x: F.struct((x["end"] - F.length(x["found"])).alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["found"].alias("found"))
        return let(sizes, lambda n: F.transform(F.arrays_zip(running(n).alias("end"), found.alias("found")), one))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(empty)


def best_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits a character, of any window of ``window`` (at most 31) characters, by
    incremental counts. The counts of the alphabet's characters are five bits each of a few numbers, so a step touches
    those two of the character that comes and the one that goes."""
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    numbers = range(-(-len(ALPHABET) // 12))
    # A character's code: the number that holds its count, times 64, and the place of the count in it.
    place = {c: i // 12 * 64 + i % 12 * 5 for i, c in enumerate(ALPHABET)}
    codes = F.array(*[F.lit(place.get(chr(c), 0)) for c in range(128)])
    text = F.transform(F.regexp_extract_all(candidate, F.lit("."), F.lit(0)), lambda c: F.get(codes, F.ascii(c)))
    zero = F.struct(*[F.lit(0).cast("long").alias(f"n{k}") for k in numbers], F.lit(0).alias("at"), F.lit(0.0).alias("s"), F.lit(1e9).alias("least"))
    in_number, bits = lambda c: F.call_function("shiftright", c, F.lit(6)), lambda c: c.bitwiseAND(F.lit(63))

    def walked(text: Column) -> Column:
        def step(acc: Column, new: Column) -> Column:
            old = F.when(acc["at"] >= window, F.get(text, acc["at"] - window)).otherwise(F.lit(-1))

            def count(c: Column) -> Column:
                number = F.lit(0).cast("long")
                for k in numbers:
                    number = F.when(in_number(c) == k, acc[f"n{k}"]).otherwise(number)
                return F.call_function("shiftright", number, bits(c)).bitwiseAND(F.lit(31).cast("long")).cast("int")

            def unit(c: Column, k: int) -> Column:
                return F.when(in_number(c) == k, F.call_function("shiftleft", F.lit(1).cast("long"), bits(c))).otherwise(F.lit(0).cast("long"))

            more, gone = count(new), old >= 0
            less = count(old) + F.when(old == new, 1).otherwise(0)
            s = acc["s"] + F.get(table, more + 1) - F.get(table, more) + F.when(gone, F.get(table, less - 1) - F.get(table, less)).otherwise(F.lit(0.0))
            moved = [(acc[f"n{k}"] + unit(new, k) - F.when(gone, unit(old, k)).otherwise(F.lit(0).cast("long"))).alias(f"n{k}") for k in numbers]
            least = F.when(acc["at"] >= window - 1, F.least(acc["least"], s)).otherwise(acc["least"])
            return F.struct(*moved, (acc["at"] + 1).alias("at"), s.alias("s"), least.alias("least"))

        return F.aggregate(text, zero, step, lambda acc: acc["least"])

    return F.lit(math.log2(window)) - let(text, walked) / F.lit(float(window))


def is_secret(candidate: Column) -> Column:
    """Whether a candidate string passes the entropy rule of the module docstring."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    need = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        need = F.when(candidate.rlike(pattern), F.lit(bits)).otherwise(need)
    return F.when(~mixed | allowed, F.lit(False)).otherwise(best_entropy(candidate) >= need)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``assign_spans``, ``access_spans``, ``hex_spans`` and ``entropy_spans``, each
    ``array<struct<start,kind,end>>`` in order of start."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    bare = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).cast(_SPAN)
    long_enough = lambda x: F.length(F.regexp_extract(x["found"], ASSIGN, 2)) >= ASSIGN_VALUE
    out = {
        "assign_spans": bare(F.filter(matches(body, ASSIGN, 0), long_enough)),
        "access_spans": bare(matches(body, ACCESS, 1)),
        "hex_spans": bare(matches(body, HEX, 2)),
        "entropy_spans": bare(F.filter(matches(body, CANDIDATE, 3), lambda x: is_secret(x["found"]))),
    }
    return docs.withColumns(out)


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start and then kind, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8(docs: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    found = scan_secrets(docs.select("doc_id", "text"))
    base = F.concat("assign_spans", "access_spans", "hex_spans")
    return found.select(
        "doc_id",
        *[F.size(f"{k}_spans").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, F.col("entropy_spans"))).alias("spans"),
        F.size("entropy_spans").cast("long").alias("n_entropy"),
    )
