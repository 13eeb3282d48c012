"""Answers that point at lines: reading, validating, expanding and repairing section records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.text import SPACE, aligned, bound, sliced, snapped, strip, without_fence
from lontar.functions.text import lines as lines_of

# The closed list of section keys, in their order.
SECTIONS = (
    "judul", "nomor_putusan", "irah_irah", "nama_pengadilan_negeri", "keterangan_perkara", "nama_lengkap", "tempat_lahir", "umur_tanggal_lahir", "jenis_kelamin",
    "kebangsaan", "tempat_tinggal", "agama", "pekerjaan", "penangkapan", "penahanan", "tuntutan", "dakwaan", "saksi", "ahli", "terdakwa", "surat",
    "petunjuk_barang_bukti", "fakta_hukum", "pertimbangan_hukum", "amar_putusan", "hari", "tanggal", "tahun", "siapa_yang_memutus", "panitera_pengganti", "tanda_tangan_majelis",
)

# Marks that a labelled field is in the source.
EXPECTED = {
    "nomor_putusan": r"(?imd)^\s*Nomor\s+\S",
    "nama_lengkap": r"(?i)\bNama\s+lengkap\s*:",
    "tempat_lahir": r"(?i)\bTempat\s+lahir\s*:",
    "umur_tanggal_lahir": r"(?i)\bUmur\s*/?\s*tanggal\s+lahir\s*:",
    "jenis_kelamin": r"(?i)\bJenis\s+Kelamin\s*:",
    "kebangsaan": r"(?i)\bKebangsaan\s*:",
    "tempat_tinggal": r"(?i)\bTempat\s+tinggal\s*:",
    "agama": r"(?i)\bAgama\s*:",
    "pekerjaan": r"(?i)\bPekerjaan\s*:",
}
RULING = (r"(?i)^\s*M\s*E\s*N\s*G\s*A\s*D\s*I\s*L\s*I\s*:?\s*$", r"(?i)^\s*M\s*E\s*N\s*E\s*T\s*A\s*P\s*K\s*A\s*N\s*:?\s*$")

_WITNESS = r"(?i)^Menimbang,\s*bahwa\s+(?:Anak|Terdakwa)\s+di\s+persidangan"
_EXHIBITS = r"(?i)^Menimbang,\s*bahwa\s+Penuntut\s+Umum\s+mengajukan\s+barang\s+bukti"

# Where a section that came back empty starts, and where it stops.
BLOCKS = {
    "keterangan_perkara": (r"(?i)Pengadilan.*(?:mengadili|Hakim)|Membaca\s+Laporan|Setelah\s+membaca", (r"(?i)^\s*(?:1\.\s*)?Nama\s+lengkap\b",)),
    "penangkapan": (r"(?i)\bditangkap\b", (r"(?i)\bditahan\b", r"(?i)^Setelah membaca\b", r"(?i)^Menimbang\b")),
    "penahanan": (r"(?i)\bditahan\b|\bTahanan\b", (r"(?i)^Setelah membaca\b", r"(?i)^Menimbang\b")),
    "tuntutan": (r"(?i)pembacaan\s+tuntutan|tuntutan\s+pidana", (r"(?i)^Setelah mendengar tanggapan\b", r"(?i)^Menimbang,\s*bahwa\s+(?:Anak|Terdakwa)\s+didakwa\b")),
    "dakwaan": (r"(?i)didakwa\s+berdasarkan\s+surat\s+dakwaan|surat\s+dakwaan\s+sebagai\s+berikut", (r"(?i)^Menimbang,\s*bahwa\s+terhadap\s+dakwaan\b", r"(?i)^Menimbang,\s*bahwa\s+(?:di|untuk)\s+persidangan\b")),
    "saksi": (r"(?i)mengajukan\s+saksi|menghadirkan.*\bSaksi\b", (r"(?i)^Menimbang,\s*bahwa\s+Penuntut\s+Umum\s+(?:tidak\s+)?(?:juga\s+)?(?:mengajukan|menghadirkan).*Ahli", _WITNESS)),
    "ahli": (r"(?i)\bahli\b", (_WITNESS, _EXHIBITS, r"(?i)^Menimbang,\s*bahwa\s+berdasarkan\s+ketentuan")),
    "terdakwa": (r"(?i)^\s*Menimbang,\s*bahwa\s+(?:Anak|Terdakwa)\s+di\s+persidangan.*memberikan\s+keterangan", (r"(?i)^Menimbang,\s*bahwa\s+(?:Anak|Terdakwa)\s+tidak\s+mengajukan", _EXHIBITS, r"(?i)^Menimbang,\s*bahwa\s+berdasarkan\s+keterangan")),
    "surat": (r"(?i)\bSurat\s+Keterangan\b|\bbukti\s+surat\b|\bsurat-surat\s+lain\b", (r"(?i)^Menimbang\b",)),
    "petunjuk_barang_bukti": (r"(?i)barang\s+bukti\s+(?:sebagai\s+berikut|di\s+persidangan|berupa)|menghadirkan\s+barang\s*$", (r"(?i)^Menimbang,\s*bahwa\s+pada\s+persidangan\b", r"(?i)^Menimbang,\s*bahwa\s+berdasarkan\s+keterangan", r"(?i)^Menimbang,\s*bahwa\s+selanjutnya\s+Hakim")),
    "fakta_hukum": (r"(?i)diperoleh\s+fakta\s+hukum\s+sebagai\s+berikut|Terdakwa\s+telah\s+meninggal\s+dunia", (r"(?i)^Menimbang,\s*bahwa\s+selanjutnya\s+Hakim", r"(?i)^Menimbang,\s*bahwa\s+berdasarkan\s+ketentuan", r"(?i)^Menimbang,\s*bahwa\s+oleh\s+karena")),
    "pertimbangan_hukum": (r"(?i)Hakim\s+akan\s+mempertimbangkan|berdasarkan\s+ketentuan\s+Pasal|terhadap\s+barang\s+bukti\s+yang\s+telah\s+dihadirkan", RULING),
    "tanda_tangan_majelis": (r"(?i)^\s*Hakim(?:\s+Ketua|\s+Anggota)?\s*,?\s*$", (r"(?i)^Disclaimer\b",)),
}
CONSIDERING = r"(?i)^\s*Menimbang\b"
DIVERSION = r"(?i)\bKesepakatan\s+Diversi\b"
LINES = {
    "judul": r"(?im)^\s*((?:P\s*)?U\s*T\s*U\s*S\s*A\s*N|P\s*E\s*N\s*E\s*T\s*A\s*P\s*A\s*N)\s*$",
    "nomor_putusan": r"(?im)^\s*(Nomor\s+\S.+)$",
    "irah_irah": r"(?im)^\s*(DEMI\s+KEADILAN\s+BERDASARKAN\s+KETUHANAN\s+YANG\s+MAHA\s+ESA)\s*$",
}

_RANGE = "array<struct<a:int,b:int>>"


def parsed(content: Column) -> Column:
    """An answer without its fence if it is a JSON object, else null."""
    return bound(without_fence(F.coalesce(content, F.lit(""))), lambda bare: F.when(F.trim(bare).startswith("{") & F.try_parse_json(bare).isNotNull(), bare))


def answer_error(content: Column) -> Column:
    """Why an answer can't be read, or null."""
    return F.when(F.trim(F.coalesce(content, F.lit(""))) == "", "no assistant content").when(parsed(content).isNull(), "not a JSON object")


def strict_ranges(value: Column) -> Column:
    """Line ranges of a JSON value, null if any part has an unknown form: ``[[1,2]]``, ``[1,2]``, ``[[9]]``, ``["9-10"]``
    with any dash or colon, ``["9"]``, ``[]``. The order inside a range stays."""
    form = r"^(?:\[\s*(\d+)\s*(?:,\s*(\d+)\s*)?\]|\s*(\d+)\s*(?:[-–—:]\s*(\d+)\s*)?)$"
    number = lambda x, i, j: F.coalesce(F.regexp_extract(x, form, i).try_cast("int"), F.regexp_extract(x, form, j).try_cast("int"))

    def read(parts: Column) -> Column:
        bare = F.forall(parts, lambda x: x.rlike(r"^\d+$")) & ~F.contains(value, F.lit('"'))
        each = F.transform(parts, lambda x: F.when(x.rlike(form), F.struct(number(x, 1, 3).alias("a"), F.coalesce(number(x, 2, 4), number(x, 1, 3)).alias("b"))))
        flat = F.array(F.struct(F.get(parts, 0).try_cast("int").alias("a"), F.get(parts, 1).try_cast("int").alias("b")))
        return (
            F.when(parts.isNull() | ~F.trim(value).startswith("["), None)
            .when(F.size(parts) == 0, F.array().cast(_RANGE))
            .when(bare & (F.size(parts) == 2), flat)
            .when(bare, None)
            .otherwise(bound(each, lambda e: F.when(~F.exists(e, lambda x: x.isNull()), e)))
        )

    return bound(F.from_json(value, "array<string>"), read)


def lenient_ranges(value: Column) -> Column:
    """Line ranges of a JSON value: numbers and numeric strings, alone, listed or paired; ends in order; unusable parts
    skipped."""
    scalar = r'^\s*"?\s*(\d+)\s*"?\s*$'
    parts = F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))
    bare = F.forall(parts, lambda x: x.rlike(r"^\s*\d+\s*$"))
    form = r'^(?:\[\s*"?(\d+)"?\s*(?:,\s*"?(\d+)"?\s*)?\]|\s*(\d+)\s*)$'
    first = lambda x: F.coalesce(F.regexp_extract(x, form, 1).try_cast("int"), F.regexp_extract(x, form, 3).try_cast("int"))
    second = lambda x: F.coalesce(F.regexp_extract(x, form, 2).try_cast("int"), first(x))
    ordered = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    one = F.regexp_extract(value, scalar, 1).try_cast("int")
    pair = F.array(ordered(F.trim(F.get(parts, 0)).try_cast("int"), F.trim(F.get(parts, 1)).try_cast("int")))
    many = F.transform(F.filter(parts, lambda x: x.rlike(form)), lambda x: ordered(first(x), second(x)))
    return F.when(value.rlike(scalar), F.array(ordered(one, one))).when(bare & (F.size(parts) == 2), pair).otherwise(many)


def expanded(lines: Column, ranges: Column) -> Column:
    """The lines of each range as one text; blank ones dropped."""
    return F.filter(F.transform(ranges, lambda r: sliced(lines, r["a"], r["b"])), lambda x: strip(x) != "")


def entry_forms(entry: Column) -> Column:
    """What an entry holds, each form read once: ``struct<lines,text,empty,ranges,texts>``."""
    forms = F.struct(*[F.get_json_object(entry, f"$.{k}").alias(k) for k in ("lines", "text", "empty")])
    read = lambda x: F.struct(x["lines"].alias("lines"), x["text"].alias("text"), x["empty"].alias("empty"), F.when(x["lines"].isNotNull(), strict_ranges(x["lines"])).alias("ranges"), F.from_json(x["text"], "array<string>").alias("texts"))
    return bound(forms, read)


def forms_problem(x: Column, lines: Column) -> Column:
    """The first fault of what ``entry_forms`` has read, or null."""
    has = lambda k: x[k].isNotNull()
    n = sum((F.when(has(k), 1).otherwise(0) for k in ("text", "empty")), F.when(has("lines"), 1).otherwise(0))
    ranges, texts = x["ranges"], x["texts"]
    return (
        F.when(n != 1, "not exactly one form")
        .when(has("empty") & (x["empty"] != "true"), "empty is not true")
        .when(has("lines") & ranges.isNull(), "unknown range form")
        .when(has("lines") & F.exists(ranges, lambda r: (r["a"] < 1) | (r["b"] < r["a"]) | (r["b"] > F.size(lines))), "range out of bounds")
        .when(has("lines") & F.exists(ranges, lambda r: strip(sliced(lines, r["a"], r["b"])) == ""), "blank slice")
        .when(has("text") & (texts.isNull() | F.exists(texts, lambda x: strip(F.coalesce(x, F.lit(""))) == "")), "blank literal")
    )


def entry_problem(entry: Column, lines: Column) -> Column:
    """The first fault of a section's entry, or null: it must be exactly one of ``lines``, ``text`` and ``empty: true``,
    in range, and not blank."""
    return F.when(entry.isNull(), "missing").otherwise(bound(entry_forms(entry), lambda x: forms_problem(x, lines)))


def forms_spans(x: Column, lines: Column, text: Column) -> Column:
    """The excerpts of what ``entry_forms`` has read."""
    literal = F.filter(F.transform(x["texts"], lambda t: aligned(text, t)), lambda t: t.isNotNull())
    return F.when(x["ranges"].isNotNull(), expanded(lines, x["ranges"])).when(x["texts"].isNotNull(), literal).otherwise(F.array().cast("array<string>"))


def entry_spans(entry: Column, lines: Column, text: Column) -> Column:
    """The excerpts that an entry stands for; literals that are not in the source are dropped."""
    return bound(entry_forms(entry), lambda x: forms_spans(x, lines, text))


def literal_spans(entry: Column, text: Column) -> Column:
    """The lenient reading of a literal: as the source spells it, else kept as it is."""
    return F.transform(F.from_json(F.get_json_object(entry, "$.text"), "array<string>"), lambda x: snapped(text, x))


def record_problems(spans: Column, text: Column) -> Column:
    """Faults of a record ``map<string,array<string>>``: missing and extra keys, blank and foreign excerpts."""
    keys = F.map_keys(spans)
    wanted = F.array(*[F.lit(k) for k in SECTIONS])
    bad = F.exists(F.flatten(F.map_values(spans)), lambda x: strip(x) == "")
    foreign = F.exists(F.flatten(F.map_values(spans)), lambda x: aligned(text, x).isNull())
    tests = F.array(
        F.when(F.size(F.array_except(wanted, keys)) > 0, "missing keys"),
        F.when(F.size(F.array_except(keys, wanted)) > 0, "extra keys"),
        F.when(bad, "blank excerpt"),
        F.when(~bad & foreign, "excerpt not in source"),
    )
    return F.filter(tests, lambda x: x.isNotNull())


def evidence_problems(spans: Column, text: Column) -> Column:
    """Why a record falls short of what its source plainly holds."""
    empty = lambda k: F.size(F.coalesce(F.element_at(spans, F.lit(k)), F.array().cast("array<string>"))) == 0
    rows = F.split(text, "\n", -1)
    ruled = F.exists(rows, lambda x: x.rlike(RULING[0]) | x.rlike(RULING[1]))
    tests = F.array(
        F.when(F.forall(F.map_values(spans), lambda x: F.size(x) == 0), "all sections are empty"),
        *[F.when(text.rlike(p) & empty(k), f"{k} is labelled but empty") for k, p in EXPECTED.items()],
        F.when(ruled & empty("amar_putusan"), "a ruling without amar_putusan"),
    )
    return F.filter(tests, lambda x: x.isNotNull())


# Fixed value: how an extraction document says that it was made.
METHOD = "codex_manual_extractive"


def output_problems(doc: Column) -> Column:
    """Faults of an extraction document ``struct<status,source_file,source_sha256,method,sections,empty_sections>``."""
    empty = F.filter(F.map_keys(doc["sections"]), lambda k: F.size(F.element_at(doc["sections"], k)) == 0)
    tests = F.array(
        F.when(F.coalesce(doc["status"], F.lit("")) == "", "no status"),
        F.when(F.coalesce(doc["source_file"], F.lit("")) == "", "no source_file"),
        F.when(F.coalesce(doc["method"], F.lit("")) != METHOD, "another method"),
        F.when(~F.coalesce(doc["source_sha256"], F.lit("")).rlike("^[a-fA-F0-9]{64}$"), "bad source_sha256"),
        F.when(F.map_keys(doc["sections"]) != F.array(*[F.lit(k) for k in SECTIONS]), "keys or their order"),
        F.when(F.exists(F.flatten(F.map_values(doc["sections"])), lambda x: x == ""), "empty excerpt"),
        F.when(F.array_sort(F.array_distinct(doc["empty_sections"])) != F.array_sort(empty), "empty_sections differ"),
    )
    return F.filter(tests, lambda x: x.isNotNull())


# The closing formula, a dated line, and a year with spaces between its digits.
CLOSING = r"(?is)Demikianlah\s+(?:diputuskan|ditetapkan).*?pada\s+hari\s+([^,\n]+)\s*,\s*tanggal\s+(.+?)\s+oleh\b"
DATED = r"(?i)Pada\s+tanggal\s+([^\n]+)"
YEAR = r"\b((?:20|19)\s*\d\s*\d)\b"


def closing(text: Column) -> dict[str, Column]:
    """Day, date and year of the closing formula, or of "Pada tanggal"."""
    formula, dated = CLOSING, DATED
    year = lambda x: F.nullif(F.trim(F.regexp_extract(x, YEAR, 1)), F.lit(""))
    got = lambda p, i: F.nullif(strip(F.regexp_extract(text, p, i)), F.lit(""))
    long = F.regexp_replace(got(formula, 2), r"\s+", " ")
    return {"hari": got(formula, 1), "tanggal": F.coalesce(long, got(dated, 1)), "tahun": F.coalesce(year(got(formula, 2)), year(got(dated, 1)))}


RULING_STOP = (r"(?i)^Demikianlah\b",)
_DIVERSION_WORD = r"(?i)\bKesepakatan\b"
#: What a line is looked through for, each pattern once: the place of a pattern is its bit in the line's marks.
PATTERNS = tuple(dict.fromkeys([*(p for start, stops in BLOCKS.values() for p in (start, *stops)), CONSIDERING, *RULING, *RULING_STOP, _DIVERSION_WORD]))
#: Up to so many different lines, of which half or more are repeats, are looked through once each.
_MOST_LINES = 256


def needed_words(pattern: str) -> tuple[str, ...]:
    """Words of which a line that matches ``pattern`` holds at least one, in lower case: the longest run of letters of each
    alternative, outside its groups. None if an alternative has no such run."""
    flat = re.sub(r"\\.", " ", re.sub(r"\((?:[^()]|\([^()]*\))*\)[?*+]?", " ", pattern))
    runs = [re.findall(r"[A-Za-z]{3,}(?![A-Za-z?*{])", x) for x in flat.split("|")]
    return tuple(sorted({max(r, key=len).lower() for r in runs})) if all(runs) else ()


def _bits(*patterns: str) -> Column:
    return F.lit(sum(1 << PATTERNS.index(p) for p in dict.fromkeys(patterns))).cast("long")


def line_marks(line: Column) -> Column:
    """Which of ``PATTERNS`` a line matches, one bit for each. A pattern is tried only where one of its words is there."""
    zero = F.lit(0).cast("long")
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in PATTERNS:
        groups.setdefault(needed_words(p), []).append(p)

    def marks(low: Column) -> Column:
        out = zero
        for words, patterns in groups.items():
            part = sum((F.when(line.rlike(p), _bits(p)).otherwise(zero) for p in patterns), zero)
            there = F.lit(False)
            for w in words:
                there = there | F.contains(low, F.lit(w))
            out = out + (F.when(there, part).otherwise(zero) if words else part)
        return out

    return bound(F.lower(line), marks)


def marks_of(rows: Column, unique: Column) -> Column:
    """``line_marks`` of each line, ``unique`` being the different ones. Lines that repeat are looked through once."""

    def marks(keys: Column) -> Column:
        each = F.transform(keys, line_marks)
        return bound(each, lambda m: F.when(F.size(m) == F.size(rows), m).otherwise(F.transform(rows, lambda x: F.get(m, F.array_position(keys, x).cast("int") - 1))))

    few = (F.size(unique) <= _MOST_LINES) & (2 * F.size(unique) <= F.size(rows))
    return bound(F.when(few, unique).otherwise(rows), marks)


def blocks_of(text: Column) -> Column:
    """The sections that run from a start line to a stop line, as a struct of ``BLOCKS`` and ``amar_putusan``; null where
    none is found. Lines are looked through once for all patterns."""
    ends = "[\r\x0b\x0c\x1c-\x1e\x85]"  # rare beside the line feed, and so looked for in different lines only
    parts = lambda rows, unique: F.struct(rows.alias("rows"), unique.alias("unique"))
    simple = bound(F.split(text, "\n", -1), lambda r: parts(r, F.array_distinct(r)))
    finer = bound(F.split(text, "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85]", -1), lambda r: parts(r, F.array_distinct(r)))
    split = bound(simple, lambda x: F.when(F.exists(x["unique"], lambda line: line.rlike(ends)), finer).otherwise(x))
    inner = rf"(?s)^{SPACE}*+(.*{SPACE.replace('[', '[^')})"  # a text without white space at its edges, in one match

    def read(rows: Column, marks: Column, hits: Column) -> Column:
        has = lambda m, *patterns: m.bitwiseAND(_bits(*patterns)) != 0
        first = lambda p: F.get(F.filter(hits, lambda h: has(h["marks"], p)), F.lit(0))["at"]
        opens = lambda i: F.coalesce(has(F.get(marks, i), CONSIDERING), F.lit(False))

        def edged(a: Column, b: Column) -> Column:
            return F.left(a, F.lit(1)).rlike(SPACE) | (b == "") | F.right(b, F.lit(1)).rlike(SPACE)

        def lines(at: Column, stop: Column) -> Column:
            joined = F.array_join(F.slice(rows, at + 1, stop - at), "\n")
            return F.when(edged(F.get(rows, at), F.get(rows, stop - 1)), F.regexp_extract(joined, inner, 1)).otherwise(joined)

        def block(at: Column, stops: tuple[str, ...]) -> Column:
            stop = lambda a: F.coalesce(F.get(F.filter(hits, lambda h: (h["at"] > a) & has(h["marks"], *stops)), F.lit(0))["at"], F.size(rows))
            found = lambda a: F.when(a.isNotNull(), F.get(F.filter(F.array(bound(stop(a), lambda b: lines(a, b))), lambda x: x != ""), F.lit(0)))
            return bound(at, found)

        at = {k: first(start) for k, (start, _) in BLOCKS.items()}
        at["dakwaan"] = bound(at["dakwaan"], lambda i: F.when(opens(i), i).when(opens(i - 1), i - 1).when(opens(i - 2), i - 2).otherwise(i))  # the consideration that it stands in
        diverted = F.exists(hits, lambda h: has(h["marks"], _DIVERSION_WORD)) & text.rlike(DIVERSION)
        at["pertimbangan_hukum"] = F.coalesce(at["pertimbangan_hukum"], F.when(diverted, first(CONSIDERING)))
        out = [block(at[k], stops).alias(k) for k, (_, stops) in BLOCKS.items()]
        opened = has(F.get(marks, F.lit(0)), RULING[0])  # a ruling in the very first line does not count
        ruled = F.when(opened, block(first(RULING[1]), RULING_STOP)).otherwise(F.coalesce(*[block(first(p), RULING_STOP) for p in RULING]))
        return F.struct(*out, ruled.alias("amar_putusan"))

    def marked(rows: Column, marks: Column) -> Column:
        hits = F.filter(F.transform(marks, lambda m, i: F.struct(i.alias("at"), m.alias("marks"))), lambda h: h["marks"] != 0)
        return bound(hits, lambda h: read(rows, marks, h))

    return bound(split, lambda x: bound(marks_of(x["rows"], x["unique"]), lambda marks: marked(x["rows"], marks)))


def _repairs(text: Column, blocks: Column) -> dict[str, Column]:
    out = {k: F.nullif(strip(F.regexp_extract(text, p, 1)), F.lit("")) for k, p in LINES.items()}
    return out | {k: blocks[k] for k in (*BLOCKS, "amar_putusan")} | closing(text)


def repaired(text: Column) -> dict[str, Column]:
    """What the anchor rules find for sections that are empty, one column for each rule; null where nothing is found."""
    return _repairs(text, blocks_of(text))


def _none() -> Column:
    return F.array().cast("array<string>")


def _wanted() -> Column:
    return F.array(*[F.lit(k) for k in SECTIONS])


def spans_of(sections: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(sections, F.lit(key)), _none())


def filled_in(sections: Column, text: Column) -> Column:
    """A record's sections with what the anchor rules find for the empty ones; others stay as they are."""

    def filled(found: dict[str, Column]) -> Column:
        one = lambda k: F.when((F.size(spans_of(sections, k)) == 0) & found[k].isNotNull(), F.array(found[k])).otherwise(spans_of(sections, k)) if k in found else spans_of(sections, k)
        return F.map_from_arrays(_wanted(), F.array(*[one(k) for k in SECTIONS]))

    return bound(blocks_of(text), lambda blocks: filled(_repairs(text, blocks)))


def empty_sections(sections: Column, blank_too: bool = False) -> Column:
    """The keys of sections without an excerpt; with ``blank_too``, without one that is not blank."""
    full = lambda k: F.exists(F.element_at(sections, k), lambda x: strip(x) != "") if blank_too else F.size(F.element_at(sections, k)) > 0
    return F.filter(_wanted(), lambda k: ~full(k))


def whole_answer(content: Column, text: Column) -> Column:
    """``struct<error, sections>`` of an answer over all sections. An answer that is itself a record of the 31 keys is
    checked as one. Otherwise it needs a ``sections`` object of exactly these keys; an entry is coerced to empty if its
    ``lines`` or ``text`` is an empty list; the first fault by the order of the keys stands for all."""
    json_map, spans_map = "map<string,string>", "map<string,array<string>>"
    keys = lambda m: F.array_sort(F.map_keys(m))
    same = lambda m: keys(m) == F.array(*[F.lit(k) for k in sorted(SECTIONS)])

    def item(e: Column, k: Column) -> Column:
        return F.struct(k.alias("k"), F.coalesce(F.trim(e).startswith("{"), F.lit(False)).alias("object"), entry_forms(e).alias("forms"))

    def hollow(f: Column) -> Column:
        return F.coalesce((f["lines"] == "[]") | (f["text"] == "[]"), F.lit(False))

    def entries(sections: Column, lines: Column, source: Column) -> Column:
        items = F.transform(_wanted(), lambda k: bound(F.try_element_at(sections, k), lambda e: item(e, k)))
        problem = lambda i: F.when(~i["object"], "not an object").when(hollow(i["forms"]), F.lit(None)).otherwise(forms_problem(i["forms"], lines))
        excerpts = lambda i: F.when(hollow(i["forms"]), _none()).otherwise(forms_spans(i["forms"], lines, source))

        def read(x: Column) -> Column:
            bad = F.get(F.filter(F.transform(x, lambda i: F.concat(i["k"], F.lit(": "), problem(i))), lambda p: p.isNotNull()), F.lit(0))
            return bound(bad, lambda b: F.struct(b.alias("error"), F.when(b.isNull(), F.map_from_arrays(_wanted(), F.transform(x, excerpts))).alias("sections")))

        return bound(items, read)

    def failed(error) -> Column:
        return F.struct(error.alias("error"), F.lit(None).cast(spans_map).alias("sections"))

    def spans(sections: Column, source: Column) -> Column:
        faults = F.when(sections.isNull(), failed(F.lit("no sections object"))).when(~same(sections), failed(F.lit("wrong section keys")))
        return faults.otherwise(bound(lines_of(source), lambda rows: entries(sections, rows, source)))

    def read(body: Column, answer: Column) -> Column:
        flat = lambda m: F.struct(F.get(record_problems(m, text), F.lit(0)).alias("error"), m.alias("sections"))
        inner = bound(F.get_json_object(body, "$.sections"), lambda s: F.when(F.trim(s).startswith("{"), F.from_json(s, json_map)))
        parts = bound(inner, lambda sections: spans(sections, text))
        record = bound(F.from_json(body, spans_map), flat)
        return F.when(body.isNull(), failed(answer_error(answer))).when(same(F.from_json(body, json_map)), record).otherwise(parts)

    return bound(content, lambda answer: bound(parsed(answer), lambda body: read(body, answer)))


def normalized(body: Column) -> Column:
    """The sections of a record in JSON as ``map<string,array<string>>`` of all keys: a missing or null one is empty, a
    string is a list of one, items that are no strings are written as such."""
    record = F.try_parse_json(body)
    listed = lambda k: F.try_variant_get(record, f"$.sections.{k}", "array<string>")
    plain = lambda k: F.try_variant_get(record, f"$.sections.{k}", "string")
    one = lambda k: F.coalesce(listed(k), F.when(plain(k).isNotNull(), F.array(plain(k))), _none())
    return F.map_from_arrays(_wanted(), F.array(*[one(k) for k in SECTIONS]))


def usable(body: Column) -> Column:
    """Whether a record in JSON can be trained on: valid, completed, its sections an object, not all of them blank."""
    sections = F.get_json_object(body, "$.sections")
    fine = F.try_parse_json(body).isNotNull() & (F.get_json_object(body, "$.status") == "completed") & F.trim(sections).startswith("{")
    some = F.exists(F.flatten(F.map_values(normalized(body))), lambda x: strip(x) != "")
    return F.coalesce(fine & some, F.lit(False))


def loaded(sources: DataFrame, saved: DataFrame) -> DataFrame:
    """``sources(stem, source_file, source_sha256, text)`` with the output saved for each stem, as far as it still
    holds: ``state`` (``absent``, ``invalid``, ``other source``, ``kept``), its ``sections`` after repair, the keys of
    ``empty_sections``, and ``changed`` if the stored form differs from that. ``saved`` has ``stem, status, source_file,
    source_sha256, sections, empty_sections, legacy`` (true if it holds a bucket of the old form)."""
    s = saved.select("stem", F.coalesce("status", F.lit("completed")).alias("status"), F.col("source_file").alias("saved_file"), F.col("source_sha256").alias("saved_sha"), F.col("sections").alias("stored"), F.col("empty_sections").alias("stored_empty"), "legacy", F.lit(True).alias("there"))
    rows = sources.join(s, "stem", "left").withColumn("no_text", F.coalesce(F.col("status") == "no_text", F.lit(False)))
    body = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("repaired", F.when(F.col("no_text"), F.map_from_arrays(_wanted(), F.array_repeat(_none(), len(SECTIONS)))).otherwise(filled_in(F.col("stored"), body)))
    wrong = F.coalesce(F.size(record_problems(F.col("stored"), body)) > 0, F.lit(True))
    invalid = wrong | F.when(F.col("no_text"), body != "").otherwise(F.size(evidence_problems(F.col("repaired"), body)) > 0)
    other = ~(F.col("saved_file").eqNullSafe(F.col("source_file")) & F.col("saved_sha").eqNullSafe(F.col("source_sha256")))
    state = F.when(F.col("there").isNull(), "absent").when(invalid, "invalid").when(other, "other source").otherwise("kept")
    rows = rows.withColumn("state", state)
    kept = F.col("state") == "kept"
    flat = lambda c: F.transform(_wanted(), lambda k: F.coalesce(F.try_element_at(c, k), _none()))
    changed = (flat(F.col("stored")) != flat(F.col("repaired"))) | ~F.col("stored_empty").eqNullSafe(empty_sections(F.col("repaired"))) | F.coalesce("legacy", F.lit(False))
    return rows.select("stem", "source_file", "state", F.when(kept, F.col("repaired")).alias("sections"), F.when(kept, empty_sections(F.col("repaired"))).alias("empty_sections"), (kept & changed).alias("changed"))


def better_retry(attempts: DataFrame, key: str, emptiness: str, attempt: str) -> DataFrame:
    """The attempt of each key with the fewest empty sections, the earliest of equals, and how the retries went."""
    first = F.min_by(emptiness, attempt)
    best = F.min(F.struct(F.col(emptiness).alias("e"), F.col(attempt).alias("a")))
    rows = attempts.groupBy(key).agg(first.alias("first_empty"), best.alias("best"), F.count("*").alias("attempts"))
    status = F.when(F.col("attempts") == 1, "single").when(F.col("best.e") < F.col("first_empty"), "retry_improved").otherwise("retry_no_improvement")
    return rows.select(key, "first_empty", F.col("best.e").alias("best_empty"), F.col("best.a").alias("best_attempt"), status.alias("status"))
