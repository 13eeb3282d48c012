"""Review tables: flat rows of records, search, facets, sizes by producer and verification flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def display(spans: Column) -> Column:
    """Excerpts as one text, blank line between, empty ones dropped."""
    return F.array_join(F.filter(F.coalesce(spans, F.array().cast("array<string>")), lambda x: x != ""), "\n\n")


def labelled(fields: dict[str, Column]) -> Column:
    """Non-empty fields as lines ``name: value``."""
    return F.concat_ws("\n", *[F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(k.replace("_", " ") + ": "), c)) for k, c in fields.items()])


def search(rows: DataFrame, query: str, fields: list[str], **equal: str | None) -> DataFrame:
    """Rows whose joined fields hold ``query`` in any case, and whose columns have the given values (None: any)."""
    tests = [F.col(k) == v for k, v in equal.items() if v is not None]
    if query.strip():
        tests.append(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(query.strip().lower())))
    return rows.where(reduce(lambda a, b: a & b, tests)) if tests else rows


def facets(rows: DataFrame, column: str) -> DataFrame:
    """The values of a column, with ``all`` in front."""
    values = rows.select(F.lit(1).alias("ord"), F.col(column).alias("value")).distinct()
    return values.unionByName(rows.sparkSession.range(1).select(F.lit(0).alias("ord"), F.lit("all").alias("value")))


def sizes(rows: DataFrame, dims: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows and bytes for each combination of ``dims``, zero where there are none."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("files"), F.sum(F.octet_length(text)).alias("bytes"))
    return dims.join(counted, keys, "left").select(*keys, F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def toggled(log: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """Keys whose last toggle is true: a key-value store without its deleted keys."""
    return log.groupBy(key).agg(F.max_by(value, seq).alias("v")).where("v").select(key)


def flags(rows: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``verified``, false where nothing is saved."""
    return rows.join(saved.select(key, F.lit(True).alias("verified")), key, "left").withColumn("verified", F.coalesce("verified", F.lit(False)))


# Names that a section had in other forms, and the parts of the identity.
ALIASES = {
    "petunjuk_barang_bukti": ("petunjuk_barang_bukti", "petunjuk_bb", "petunjuk/BB", "petunjuk/ bb"),
    "siapa_yang_memutus": ("siapa_yang_memutus", "majelis_hakim", "hakim"),
    "panitera_pengganti": ("panitera_pengganti", "panitera"),
}
IDENTITY = ("nama_lengkap", "tempat_lahir", "umur_tanggal_lahir", "jenis_kelamin", "kebangsaan", "tempat_tinggal", "agama", "pekerjaan")


def section_text(sections: Column, key: str) -> Column:
    """The text of a section of ``map<string,array<string>>``: the first of its names that has one; the identity of the
    accused is put together from its parts if it has none itself."""
    shown = lambda k: F.nullif(display(F.try_element_at(sections, F.lit(k))), F.lit(""))
    own = F.coalesce(*[shown(k) for k in ALIASES.get(key, (key,))])
    if key == "identitas_terdakwa":
        own = F.coalesce(own, labelled({k: section_text(sections, k) for k in IDENTITY}))
    return F.coalesce(own, F.lit(""))
