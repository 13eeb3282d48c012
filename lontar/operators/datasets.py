"""Joins and rows of data sets: pages side by side, files beside texts, audits, unions of addresses, training rows,
benchmark figures, feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.text import bound, fold

#: Marks of the five languages that a text is told by, the most frequent function words of each.
STOP_WORDS = {
    "id": ("yang", "dan", "di", "dengan", "untuk", "pada", "dari", "ini", "itu", "tidak"),
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "with", "was"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "mit", "von", "den"),
    "fr": ("le", "les", "et", "des", "est", "une", "dans", "pour", "que", "pas"),
    "es": ("el", "los", "y", "del", "es", "una", "por", "para", "con", "que"),
}


def page_pairs(first: DataFrame, second: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """``key, page, first, second``: two sequences of pages side by side, as far as the shorter one goes."""
    a, b = first.select(key, page, F.col(text).alias("first")), second.select(key, page, F.col(text).alias("second"))
    return a.join(b, [key, page])


def paired_files(texts: DataFrame, files: DataFrame, stem: str, path: str) -> DataFrame:
    """``texts`` with the path of the file of their stem, null where there is none."""
    return texts.join(files.groupBy(stem).agg(F.min(path).alias(path)), stem, "left")


def audit_results(lines: DataFrame, error: str = "error") -> DataFrame:
    """The rows of an audit that are results, not errors."""
    return lines.where(F.col(error).isNull())


def merged_audit(old: DataFrame, new: DataFrame, outputs: DataFrame, source: str, output: str) -> DataFrame:
    """Rows of two audits, the newer one of a source (in any case) and of those the last, by ``line``; only rows whose
    output is there. The last one is a partial aggregate."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    columns = old.columns
    last = both.groupBy(fold(F.col(source)).alias("_source")).agg(F.max_by(F.struct(*columns), F.struct("_age", "line")).alias("_row")).select("_row.*")
    return last.join(outputs.select(F.col(output)).distinct(), output, "left_semi").select(*columns)


def crawl_queue(explicit: DataFrame, collected: DataFrame, done: DataFrame, url: str, order: str, most: int | None = None) -> DataFrame:
    """``url, place``: addresses asked for, then those collected that are not done yet, each once at its first place.
    Addresses asked for are queued even if they are done."""
    asked = explicit.select(url, F.lit(0).alias("part"), F.col(order).alias("at"))
    found = collected.join(done.select(url), url, "left_anti").select(url, F.lit(1).alias("part"), F.col(order).alias("at"))
    first = asked.unionByName(found).groupBy(url).agg(F.min(F.struct("part", "at")).alias("place")).orderBy("place.part", "place.at", url)
    return first.limit(most) if most else first


def dedup_summary(rows: DataFrame, duplicate: Column, invalid: Column, file: Column) -> DataFrame:
    """One row: how many records are kept, duplicates and invalid, and how many files are to move."""
    gone = invalid | duplicate
    return rows.agg(F.count_if(~gone).alias("kept_records"), F.count_if(duplicate & ~invalid).alias("duplicate_records"), F.count_if(invalid).alias("invalid_records"), F.count_if(gone & (F.coalesce(file, F.lit("")) != "")).alias("moved_files"))


def with_split(records: DataFrame, splits: DataFrame, sha: str) -> DataFrame:
    """Records with the split that their source belongs to."""
    return records.join(splits.select(sha, "split"), sha)


def training_rows(records: DataFrame, system: str) -> DataFrame:
    """``split, sha, row``: a JSON row for each record ``(split, sha, input, target, meta)`` in the form of its split: a
    prompt and an answer for grpo, a whole conversation for sft and benchmark. ``target`` is JSON text."""
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    asked = F.array(say("system", F.lit(system)), say("user", F.col("input")))
    whole = F.to_json(F.struct(F.concat(asked, F.array(say("assistant", F.col("target")))).alias("messages"), "meta"))
    prompt = F.to_json(F.struct(asked.alias("prompt"), F.col("target").alias("answer"), "meta"))
    return records.select("split", "sha", F.when(F.col("split") == "grpo", prompt).otherwise(whole).alias("row"))


def one_each(rows: DataFrame, key: str, body: str) -> DataFrame:
    """``file_name, body``: one document of each key, named after it, the one of the least body if there are several."""
    return rows.groupBy(F.concat(F.col(key).cast("string"), F.lit(".json")).alias("file_name")).agg(F.min(body).alias("body"))


def summary_json(rows: DataFrame, **counts: Column) -> DataFrame:
    """One row with a JSON object of counts."""
    return rows.agg(F.to_json(F.struct(*[c.alias(k) for k, c in counts.items()])).alias("summary"))


def bench_form(text: Column) -> Column:
    """An answer as it is compared: folded, without punctuation, white-space runs as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold(text), r"\p{Punct}+", " "), r"\s+", " "))


def bench_metrics(answers: DataFrame) -> DataFrame:
    """One row of macro figures from ``answers(doc_id, section, valid, predicted, truth, in_source)``, ``predicted`` and
    ``truth`` being arrays of excerpts: exact match and F1 of the bags of words by section and then over sections, the
    share of valid answers, of excerpts that are not in the source, and of empty sections that came back empty."""
    words = lambda c: F.filter(F.split(bench_form(F.array_join(c, " ")), " "), lambda w: w != "")
    rows = answers.withColumns({"p": words(F.col("predicted")), "t": words(F.col("truth"))})
    both = rows.select("doc_id", "section", F.explode(F.concat(F.transform("p", lambda w: F.struct(w.alias("w"), F.lit(1).alias("a"), F.lit(0).alias("b"))), F.transform("t", lambda w: F.struct(w.alias("w"), F.lit(0).alias("a"), F.lit(1).alias("b"))))).alias("x"))
    shared = both.groupBy("doc_id", "section", "x.w").agg(F.least(F.sum("x.a"), F.sum("x.b")).alias("n")).groupBy("doc_id", "section").agg(F.sum("n").alias("shared"))
    rows = rows.join(shared, ["doc_id", "section"], "left").fillna(0, ["shared"])
    total = F.size("p") + F.size("t")
    f1 = F.when(total == 0, 1.0).otherwise(2.0 * F.col("shared") / total)
    exact = (F.array_join("p", " ") == F.array_join("t", " ")).cast("double")
    empty = F.size("t") == 0
    by_section = rows.groupBy("section").agg(F.avg(exact).alias("em"), F.avg(f1).alias("f1"), F.avg(F.when(empty, (F.size("p") == 0).cast("double"))).alias("empty_right"))
    macro = by_section.agg(F.avg("em").alias("exact_match"), F.avg("f1").alias("f1"), F.avg("empty_right").alias("empty_accuracy"))
    excerpts = answers.agg(F.avg(F.col("valid").cast("double")).alias("valid_rate"), (1 - F.sum("in_source") / F.nullif(F.sum(F.size("predicted")), F.lit(0))).alias("hallucination_rate"))
    return macro.join(excerpts)  # one row each


def language(text: Column) -> Column:
    """The language whose function words a text has most of, the first of equal ones; ``und`` without any. A plain
    scorer, in place of the trained model of the original."""
    words = F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}]+)"), F.lit(1))

    def scored(words: Column) -> Column:
        hits = lambda known: F.size(F.filter(words, lambda w: w.isin(*known)))
        best = F.array_max(F.array(*[F.struct(hits(known).alias("n"), F.lit(-i).alias("i"), F.lit(code).alias("code")) for i, (code, known) in enumerate(STOP_WORDS.items())]))
        return F.when(best["n"] > 0, best["code"]).otherwise(F.lit("und"))

    return bound(words, scored)


def feedback_sets(log: DataFrame, answer: str, rating: str, correction: str, key: str) -> dict[str, DataFrame]:
    """What a batch of logged answers teaches: ``preference`` pairs (the best and the worst rated answer of a prompt, if
    their ratings differ) and ``corrections`` (answers that were put right). Nothing is learned while answers are given."""
    rated = log.where(F.col(rating).isNotNull()).groupBy(key).agg(F.max_by(answer, F.struct(rating, answer)).alias("chosen"), F.min_by(answer, F.struct(rating, answer)).alias("rejected"), F.max(rating).alias("hi"), F.min(rating).alias("lo"))
    put_right = log.where((F.coalesce(F.col(correction), F.lit("")) != "") & ~F.col(correction).eqNullSafe(F.col(answer)))
    return {"preference": rated.where("hi > lo").select(key, "chosen", "rejected"), "corrections": put_right.select(key, F.col(answer).alias("answer"), F.col(correction).alias("correction"))}
