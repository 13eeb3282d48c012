"""Operators against plain Python models and hand-made fixtures."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lontar.functions import rewards, urls
from lontar.functions import text as T
from lontar.operators import clean, curate, dedup, fidelity, html, spans
from lontar.sources import readers, sinks


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_source_cleaner_drops_furniture_and_disclaimers(spark):
    text = "﻿PUTUSAN\r\n\r\n\r\nMahkamah Agung Republik Indonesia\nHalaman 1 dari 2\nDisclaimer\nKepaniteraan ...\nEmail : x@y\nisi  \n\n\n\nakhir\n"
    open_block = "awal\nDisclaimer\nsemua hilang"
    rows = {r.doc_id: r.clean_text for r in clean.cleaned(docs(spark, text, open_block, None, "")).collect()}
    assert rows == {0: "PUTUSAN\n\nisi\n\nakhir", 1: "awal", 2: "", 3: ""}


def test_span_cleaner_keeps_what_the_other_drops(spark):
    text = "\nDisclaimer\nHalaman 1 dari 2\nHalaman 3\nputusan3.mahkamahagung.go.id\nisi \t\n\n\nEmail : kepaniteraan@mahkamahagung.go.id\n"
    assert clean.cleaned(docs(spark, text), clean.SPANS).first().clean_text == "Halaman 1 dari 2\nputusan3.mahkamahagung.go.id\nisi \t"


def test_numbered_and_sliced(spark):
    text = "\n".join(f"r{i}" for i in range(1, 13))
    r = one(spark, fixed=T.numbered(F.lit("a\nb")), fitted=T.numbered(F.lit(text), None), cut=T.sliced(F.split(F.lit(text), "\n"), F.lit(11), F.lit(99)))
    assert r.fixed == "   1| a\n   2| b"
    assert r.fitted.startswith(" 1| r1\n") and r.fitted.endswith("12| r12")
    assert r.cut == "r11\nr12"


def test_cleaners_equal_a_line_by_line_model(spark):
    rng = random.Random(8)
    bits = ["Disclaimer", "Email : x", " isi ", "", "  ", "Halaman 3", "halaman 1 dari 2", "putusan3.mahkamahagung.go.id", "Mahkamah Agung Republik Indonesia", "a\t", "DISCLAIMER "]
    texts = ["\n".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(150)]

    def model(text):
        out, inside = [], False
        for line in text.splitlines():
            bare = line.strip()
            if inside:
                inside = not bare.lower().startswith("email :")
                continue
            if bare.lower() == "disclaimer":
                inside = True
                continue
            if bare in clean.SOURCE.exact or bare.lower().startswith("halaman"):
                continue
            if bare or (out and out[-1]):
                out.append(line.rstrip())
        return "\n".join(out).strip()

    got = {r.doc_id: r.clean_text for r in clean.cleaned(docs(spark, *texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [model(t) for t in texts]
    assert "Exchange" not in clean.cleaned(docs(spark, "a"))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "value, strict, lenient",
    [
        ("[[4,8],[10,12]]", [(4, 8), (10, 12)], [(4, 8), (10, 12)]),
        ("[9,10]", [(9, 10)], [(9, 10)]),
        ('["9-10"]', [(9, 10)], []),
        ('["3–4"]', [(3, 4)], []),
        ('["9"]', [(9, 9)], [(9, 9)]),
        ("[[9]]", [(9, 9)], [(9, 9)]),
        ("[]", [], []),
        ('[["a","b"]]', None, []),
        ("4", None, [(4, 4)]),
        ('"4"', None, [(4, 4)]),
        ("[[8,4]]", [(8, 4)], [(4, 8)]),
    ],
)
def test_line_ranges(spark, value, strict, lenient):
    r = one(spark, s=spans.strict_ranges(F.lit(value)), n=spans.lenient_ranges(F.lit(value)))
    assert (None if r.s is None else [tuple(x) for x in r.s]) == strict
    assert [tuple(x) for x in r.n] == lenient


def test_entries(spark):
    lines, text = F.split(F.lit("satu\ndua\n \ntiga"), "\n"), F.lit("satu\ndua\n \ntiga")
    problem = lambda x: one(spark, p=spans.entry_problem(F.lit(x), lines)).p
    assert problem('{"lines":[[1,2]]}') is None
    assert problem('{"lines":[[1,9]]}') == "range out of bounds"
    assert problem('{"lines":[[3,3]]}') == "blank slice"
    assert problem('{"empty":false}') == "empty is not true"
    assert problem('{"empty":true,"text":["x"]}') == "not exactly one form"
    r = one(spark, a=spans.entry_spans(F.lit('{"text":["satu dua","tak ada"]}'), lines, text), b=spans.entry_spans(F.lit('{"lines":[[1,2],[4,4]]}'), lines, text), c=spans.literal_spans(F.lit('{"text":["dua  tiga","lain"]}'), text))
    assert r.a == ["satu\ndua"] and r.b == ["satu\ndua", "tiga"] and r.c == ["dua\n \ntiga", "lain"]


def test_alignment_reaches_spaced_letters(spark):
    source = F.lit("M E N G A D I L I\nTerdakwa  (A.B) bebas")
    r = one(spark, a=T.aligned(source, F.lit("MENGADILI")), b=T.aligned(source, F.lit("Terdakwa (A.B)")), c=T.aligned(source, F.lit("tidak ada")))
    assert (r.a, r.b, r.c) == ("M E N G A D I L I", "Terdakwa  (A.B)", None)


def test_evidence_and_output_checks(spark):
    none = F.array().cast("array<string>")
    empty = F.map_from_arrays(F.array(*[F.lit(k) for k in spans.SECTIONS]), F.array_repeat(none, 31))
    r = one(spark, p=spans.evidence_problems(empty, F.lit("Agama : Islam\nMENGADILI\nx")))
    assert r.p == ["all sections are empty", "agama is labelled but empty", "a ruling without amar_putusan"]
    doc = F.struct(F.lit("completed").alias("status"), F.lit("a").alias("source_file"), F.lit("g" * 64).alias("source_sha256"), F.lit(spans.METHOD).alias("method"), empty.alias("sections"), F.array(F.lit("judul")).alias("empty_sections"))
    assert one(spark, p=spans.output_problems(doc)).p == ["bad source_sha256", "empty_sections differ"]
    assert one(spark, p=spans.record_problems(F.create_map(F.lit("judul"), F.array(F.lit("x"))), F.lit("y"))).p == ["missing keys", "excerpt not in source"]


def test_all_anchor_rules(spark):
    text = "\n".join(["Nomor 1", "pembukaan", "Menimbang, bahwa Anak", "x", "didakwa berdasarkan surat dakwaan", "isi dakwaan", "Menimbang, bahwa terhadap dakwaan", "menghadirkan para Saksi", "saksi satu", "Menimbang, bahwa Anak di persidangan memberikan keterangan", "isi anak", "Menimbang, bahwa Anak tidak mengajukan", "pendapat ahli", "isi ahli", "Menimbang, bahwa berdasarkan ketentuan", "barang bukti berupa", "pisau", "Menimbang, bahwa pada persidangan", "diperoleh fakta hukum sebagai berikut", "fakta", "Menimbang, bahwa oleh karena", "Hakim akan mempertimbangkan", "unsur", "MENGADILI", "putusan"])
    r = spark.range(1).select(*[c.alias(k) for k, c in spans.repaired(F.lit(text)).items()]).first()
    assert r.dakwaan == "Menimbang, bahwa Anak\nx\ndidakwa berdasarkan surat dakwaan\nisi dakwaan"
    assert r.saksi == "menghadirkan para Saksi\nsaksi satu" and r.ahli == "pendapat ahli\nisi ahli"
    assert r.terdakwa == "Menimbang, bahwa Anak di persidangan memberikan keterangan\nisi anak"
    assert r.petunjuk_barang_bukti == "barang bukti berupa\npisau" and r.fakta_hukum == "diperoleh fakta hukum sebagai berikut\nfakta"
    assert r.pertimbangan_hukum == "Hakim akan mempertimbangkan\nunsur" and r.amar_putusan == "MENGADILI\nputusan"
    short = "Kesepakatan Diversi\nMenimbang a\nb\nMENETAPKAN\nc"
    r = one(spark, p=spans.repaired(F.lit(short))["pertimbangan_hukum"], q=spans.repaired(F.lit(short[20:]))["pertimbangan_hukum"])
    assert (r.p, r.q) == ("Menimbang a\nb", None) and len(spans.repaired(F.lit(""))) == 20


def test_whole_answers(spark):
    import json

    good = {k: {"empty": True} for k in spans.SECTIONS} | {"judul": {"lines": [[1, 1]]}, "saksi": {"lines": []}, "ahli": {"text": ["dua  tiga", "tak ada"]}}
    flat = {k: [] for k in spans.SECTIONS} | {"judul": ["satu"]}
    answers = [json.dumps(x) for x in ({"sections": good}, {"sections": good | {"agama": {"lines": [[1, 99]]}, "ahli": {"empty": False}}}, flat, flat | {"judul": ["lain"]}, {"a": 1}, {"sections": {"judul": {}}}, {"sections": good | {"agama": "x"}}, {"sections": good | {"agama": {"empty": True, "text": []}}})] + ["x", None]
    df = spark.createDataFrame(list(enumerate(answers)), "i long, c string")
    got = {r.i: (r.r.error, {k: v for k, v in (r.r.sections or {}).items() if v}) for r in df.select("i", spans.whole_answer(F.col("c"), F.lit("satu\ndua\ntiga")).alias("r")).collect()}
    assert got[0] == got[7] == (None, {"judul": ["satu"], "ahli": ["dua\ntiga"]}) and got[2] == (None, {"judul": ["satu"]})
    assert [got[i][0] for i in (1, 3, 4, 5, 6, 8, 9)] == ["ahli: empty is not true" if spans.SECTIONS.index("ahli") < spans.SECTIONS.index("agama") else "agama: range out of bounds", "excerpt not in source", "no sections object", "wrong section keys", "agama: not an object", "not a JSON object", "no assistant content"]


def test_saved_outputs(spark):
    none = {k: [] for k in spans.SECTIONS}
    text = "PUTUSAN\nisi"
    src = [(s, f"{s}.txt", "h", t) for s, t in (("a", text), ("b", text), ("c", text), ("d", text), ("e", ""), ("f", text), ("g", text))]
    rest = [k for k in spans.SECTIONS if k != "judul"]
    saved = [
        ("a", None, "a.txt", "h", none | {"judul": ["PUTUSAN"]}, rest, False), ("b", "completed", "b.txt", "x", none | {"judul": ["PUTUSAN"]}, rest, False), ("c", "completed", "c.txt", "h", none | {"judul": ["bukan"]}, rest, False),
        ("d", "completed", "d.txt", "h", none, list(spans.SECTIONS), True), ("e", "no_text", "e.txt", "h", none, list(spans.SECTIONS), False), ("f", "no_text", "f.txt", "h", none, list(spans.SECTIONS), False),
    ]
    kind = "stem string, status string, source_file string, source_sha256 string, sections map<string,array<string>>, empty_sections array<string>, legacy boolean"
    got = {r.stem: r for r in spans.loaded(spark.createDataFrame(src, "stem string, source_file string, source_sha256 string, text string"), spark.createDataFrame(saved, kind)).collect()}
    assert {k: (r.state, r.changed) for k, r in got.items()} == {"a": ("kept", False), "b": ("other source", False), "c": ("invalid", False), "d": ("kept", True), "e": ("kept", False), "f": ("invalid", False), "g": ("absent", False)}
    assert got["d"].sections["judul"] == ["PUTUSAN"] and got["d"].empty_sections == rest


def test_audits_rows_and_feedback(spark, tmp_path):
    from lontar.operators import datasets

    kind = "source string, line long, value int, output string"
    old = spark.createDataFrame([("A", 1, 1, "x"), ("a", 2, 2, "x"), ("b", 3, 3, "gone")], kind)
    new = spark.createDataFrame([("B", 1, 4, "y")], kind)
    got = datasets.merged_audit(old, new, spark.createDataFrame([("x",), ("y",)], "output string"), "source", "output")
    assert sorted((r.source, r.value) for r in got.collect()) == [("B", 4), ("a", 2)]
    log = spark.createDataFrame([(1, "baik", 5, None), (1, "buruk", 1, "benar"), (2, "x", 3, ""), (2, "y", 3, "y")], "k long, answer string, rating int, fix string")
    sets = datasets.feedback_sets(log, "answer", "rating", "fix", "k")
    assert [tuple(r) for r in sets["preference"].collect()] == [(1, "baik", "buruk")] and [tuple(r) for r in sets["corrections"].collect()] == [(1, "buruk", "benar")]
    rows = datasets.training_rows(spark.createDataFrame([("sft", "a", "i", '{"x":1}'), ("grpo", "b", "i", "t")], "split string, sha string, input string, target string").withColumn("meta", F.struct("sha")), "S")
    sinks.write_splits(rows.select("split", "row"), str(tmp_path / "splits"))
    assert sorted(r.split for r in spark.read.json(str(tmp_path / "splits")).collect()) == ["grpo", "sft"]
    by = {r.split: __import__("json").loads(r.row) for r in rows.collect()}
    assert [m["role"] for m in by["sft"]["messages"]] == ["system", "user", "assistant"] and by["grpo"]["answer"] == "t" and len(by["grpo"]["prompt"]) == 2


def test_files_of_records_lists_and_reports(spark, tmp_path):
    import json

    from pyspark.sql import types as K

    for corpus, model, status in (("c", "m", "completed"), ("c", "skip", "completed"), ("d", "m", "failed")):
        (tmp_path / corpus / model / "output").mkdir(parents=True)
        (tmp_path / corpus / model / "output" / "a.json").write_text(json.dumps({"status": status, "n": 1}))
    schema = K.StructType([K.StructField("status", K.StringType()), K.StructField("n", K.IntegerType())])
    got = readers.record_files(spark, f"{tmp_path}/*/*/output/*.json", schema, ("skip",)).collect()
    assert [(r.corpus, r.model, r.n) for r in got] == [("c", "m", 1)] and readers.record_files(spark, f"{tmp_path}/none/*", schema).count() == 0
    (tmp_path / "urls.txt").write_text("# x\n\n https://a \nhttps://b\n")
    assert sorted(r.url for r in readers.url_list(spark, str(tmp_path / "urls.txt")).collect()) == ["https://a", "https://b"]
    assert sinks.report("T", spark.range(1), "id") == "# T\n\n| id |\n|-|\n| 0 |\n"


def test_progress_of_streams(spark, tmp_path):
    import time

    from lontar.streaming import logs

    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    listener = logs.Progress(lambda name, batch, rows: seen.append(rows))
    spark.streams.addListener(listener)
    logs.drained(logs.read(spark, str(tmp_path / "in"), spark.range(1).schema), str(tmp_path / "c"), lambda df, n: df.count())
    for _ in range(50):
        if sum(seen) >= 5:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert sum(seen) >= 5


def test_greedy_dedup_equals_the_sequential_rule(spark):
    rng = random.Random(7)
    for _ in range(4):
        rows = [(i, *[rng.choice(["", None, *"abcdefgh"]) for _ in range(3)]) for i in range(60)]
        seen, want = [set(), set(), set()], {}
        for i, *keys in rows:
            hit = any(k and k in s for k, s in zip(keys, seen))
            want[i] = hit
            if not hit:
                for k, s in zip(keys, seen):
                    if k:
                        s.add(k)
        df = spark.createDataFrame(rows, "i long, a string, b string, c string")
        assert {r.i: r.duplicate for r in dedup.greedy(df, "i", ["a", "b", "c"]).collect()} == want


def test_exact_split_follows_the_seeded_shuffle(spark):
    keys = [f"k{i:03d}" for i in range(37)]
    order = sorted(keys)
    random.Random(curate.SEED).shuffle(order)
    a, b = int(round(37 * 0.70)), int(round(37 * 0.15))
    want = {k: "sft" if i < a else "grpo" if i < a + b else "benchmark" for i, k in enumerate(order)}
    df = spark.createDataFrame([("g", k) for k in keys], "g string, k string")
    assert {r.k: r.split for r in curate.exact_split(df, "g", "k").collect()} == want


def test_contamination_equals_containment(spark):
    rng = random.Random(7)
    passage = lambda n: " ".join(rng.choices("abcdefghij", k=n))
    items = [passage(n) for n in (1, 2, 3, 4, 12, 13, 14, 15, 16, 40) for _ in range(3)] + ["", " ", " a b", "a  b\nc d ", None]
    texts = [f"x{i}{t}&&& {passage(3)}" for i, t in enumerate(items) if t] + [f"{passage(5)} {t} {passage(5)}" for t in items if t] + [passage(60), "a", "", None]
    items_df = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted(map(tuple, curate.contaminated(docs(spark, *texts), items_df).collect()))
    assert got == [(d, i) for d, text in enumerate(texts) for i, item in enumerate(items) if None not in (text, item) and item in text]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fidelity_of_pairs(spark):
    rng = random.Random(3)
    pairs = [("tiga dua satu", "satu dua tiga"), ("satu dua", "satu dua tiga empat"), ("A  b\n c", "a b c"), ("", ""), ("x", "")]
    pairs += [(" ".join(rng.choices("abcd", k=rng.randint(0, 9))), " ".join(rng.choices("abcd", k=rng.randint(0, 9)))) for _ in range(30)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, primary string, reference string")
    got = {r.i: r for r in fidelity.compared(df).collect()}
    for i, (p, r) in enumerate(pairs):
        assert got[i].word_edits == levenshtein(p.lower().split(), r.lower().split())
        assert got[i].char_edits == levenshtein(" ".join(p.lower().split()), " ".join(r.lower().split()))
    assert (got[0].token_f1, got[0].wer) == (1.0, 2 / 3)
    assert (got[1].token_recall, got[1].token_precision, got[1].wer) == (0.5, 1.0, 0.5)
    assert got[2].cer == got[2].wer == 0 and got[3].minimum_score == 1.0 and got[4].cer == 1.0
    sim = {r.i: r.s for r in df.select("i", fidelity.indel_similarity("primary", "reference").alias("s")).collect()}

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            diag = 0
            for j, y in enumerate(b, 1):
                diag, row[j] = row[j], diag + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for i, (p, r) in enumerate(pairs):
        n = len(p) + len(r)
        assert sim[i] == pytest.approx(2 * common(p, r) / n if n else 1.0)


def test_fidelity_queries_compare_whole_texts(spark, tmp_path):
    import re
    from collections import Counter

    from lontar.plans import fidelity as plans

    rng = random.Random(5)
    texts = ["satu dua tiga empat lima\nenam tujuh", "é à ü ß und noch 日本 mehr", "a  b c d e", "a b  c d e", "kurz", "", "\nkata kata kata dua", " ".join(rng.choices(["satu", "dua", "é", "日"], k=200)), "x y z w " + "\n".join("kata" * 30 for _ in range(3))]
    docs(spark, *texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = lambda f: {r.doc_id: r for r in f(spark, str(tmp_path)).collect()}
    char, word, token, indel = map(rows, (plans.char_levenshtein, plans.word_error_rate, plans.token_overlap_f1, plans.indel_similarity))
    assert len(char) == len(word) == len(token) == len(indel) == len(texts)
    rates, edits, chars = [], 0, 0
    for i, ref in enumerate(texts):
        pri = re.sub(r"^((?:\S+ ){3})\S+ ", r"\1", ref)
        fold = lambda x: " ".join(x.lower().replace("ß", "ss").split())
        n, e = len(fold(ref)), levenshtein(fold(pri), fold(ref))
        rates.append(e / n if n else 0.0)
        edits, chars = edits + e, chars + n
        assert (char[i].edits, char[i].cer) == (e, round(rates[-1], 9))
        a, b = (re.findall(r"\w+", fold(x)) for x in (pri, ref))
        assert (word[i].word_edits, word[i].ref_words) == (levenshtein(a, b), len(b))
        assert token[i].shared == (Counter(a) & Counter(b)).total()
        assert indel[i].similarity == pytest.approx(2 * len(pri) / (len(pri) + len(ref)) if ref else 1.0)  # the primary is a subsequence
    corpus = plans.corpus_micro_macro(spark, str(tmp_path)).first()
    assert (corpus.documents, corpus.micro, corpus.most) == (len(texts), round(edits / chars, 9), round(max(rates), 9))
    assert corpus["mean"] == pytest.approx(statistics.mean(rates))


def test_edits_of_sequences():
    rng = random.Random(6)
    for n in (3, 9, 70, 140):
        for _ in range(60):
            a, b = ("".join(rng.choices("abé日", k=rng.randint(0, n))) for _ in range(2))
            assert fidelity.edits(a, b) == levenshtein(a, b) == fidelity.edits(list(a), list(b))


def test_bootstraps_bracket_the_mean(spark):
    values = [float(x % 17) for x in range(200)]
    low, high = fidelity.exact_bootstrap(values, 200)
    assert low < statistics.mean(values) < high
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double")
    r = fidelity.hashed_bootstrap(df, "i", "v", 100, "s").first()
    assert r.low < statistics.mean(values) < r.high


def test_bootstrap_query_draws_2000_resamples(spark, tmp_path):
    import hashlib

    from lontar.plans import fidelity as plans

    texts = ["x" * (i * i % 37 + 1) for i in range(12)]
    docs(spark, *texts).write.parquet(str(tmp_path / "documents.parquet"))
    steps = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183)
    means = []
    for b in range(2000):
        at = b % 8 * 8
        u = [int(hashlib.sha256(f"lontar:{b // 8}:{i}".encode()).hexdigest()[at : at + 8], 16) / (1 << 32) for i in range(12)]
        n = [sum(x >= s for s in steps) for x in u]
        if sum(n):
            means.append(sum(k * len(t) for k, t in zip(n, texts, strict=True)) / sum(n))
    cuts = statistics.quantiles(means, n=40, method="inclusive")
    r = plans.bootstrap_ci(spark, str(tmp_path)).first()
    assert r.resamples == 2000 and (r.low, r.high) == (pytest.approx(cuts[0], abs=1e-5), pytest.approx(cuts[-1], abs=1e-5))


def test_pages(spark):
    case = "https://putusan3.mahkamahagung.go.id/direktori/putusan/"
    page = f'<h1> </h1><h2>Judul</h2><a href="/x/page/9.html">2</a><a class="c" href="{case}a.html">A</a><p>ok</p><a href="{case}a.html">A lagi</a><a rel="next" href="/direktori/index/page/2.html">Next</a><a href="{case}z.html">kaki</a><b onclick="go(\'/direktori/download_file/1/pdf/q\')">x</b>'
    df = spark.createDataFrame([(1, case, page)], "page_id long, url string, html string")
    rows = html.anchors(df)
    links = html.case_links(rows, urls.is_case(F.col("href")), html.is_paging(urls.is_case(F.col("href"))))
    assert [r.href for r in links.collect()] == [case + "a.html"]
    assert rows.where(html.is_next()).first().href == "/direktori/index/page/2.html"
    assert df.select(html.title(F.col("html")).alias("t")).first().t == "Judul"
    found = html.pdf_link(df, lambda link, _: F.contains(link, F.lit("/pdf/"))).first().link
    assert found == "/direktori/download_file/1/pdf/q"
    named = html.pdf_link(spark.createDataFrame([(1, "u", '<p>x</p><b>Berkas 1</b><i data-url="/pdf/q"></i><b>Lain</b>'), (2, "u", '<i data-url="/pdf/a">dalam</i><a href="/pdf/z"> Unduh <b>ini</b></a>'), (3, "u", '<i data-file="/pdf/c"></i><u>kemudian</u>'), (4, "u", '<i data-file="/pdf/c"></i>')], "page_id long, url string, html string"), lambda link, _: F.contains(link, F.lit("/pdf/")))
    assert {r.page_id: (r.link, r.filename) for r in named.collect()} == {1: ("/pdf/q", "Berkas 1"), 2: ("/pdf/z", "Unduh ini"), 3: ("/pdf/c", "kemudian"), 4: ("/pdf/c", None)}
    whole = f'<a href="{case}0.html">Putusan A</a> unpublish <a href="{case}1.html">Putusan B</a><a href="{case}2.html">Lain C</a><a href="https://x/direktori/putusan/3.html">Putusan D</a><a href="/direktori/putusan/4.html">PUTUSAN E</a><a href="{case}1.html">Putusan B</a><a class="page-link" href="/p">2</a><a href="{case}5.html">Putusan F</a>'
    pages = spark.createDataFrame([(1, "https://putusan3.mahkamahagung.go.id/direktori/index/x.html", whole)], "page_id long, url string, html string")
    got = lambda **a: [x.case_url.rsplit("/", 1)[1] for x in html.listing(pages, **a).orderBy("pos").collect()]
    assert got(prefix="putusan") == ["1.html", "4.html"] and got(prefix="putusan", skip_unpublished=False) == ["0.html", "1.html", "4.html"] and got() == ["1.html", "2.html", "4.html"]
    r = one(spark, a=urls.allowed(F.lit(case + "a.html"), "detail"), b=urls.allowed(F.lit("http://x/direktori/putusan/a.html"), "detail"), p=urls.listing_page(F.lit("https://h/i/page/3.html?q=1"), F.lit(5)), i=urls.listing_index(F.lit("https://h/i/page/3.html")), s=urls.sanitized(F.lit("a%2Fb:c+d .PDF")))
    assert (r.a, r.b, r.p, r.i, r.s) == (True, False, "https://h/i/page/5.html?q=1", 3, "a_b_c+d .PDF")


def test_readers(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('﻿{"a":1}\n\nbroken\n{"a":2}\n', encoding="utf-8")
    assert sorted(r.a for r in readers.tolerant_jsonl(spark, str(tmp_path / "log.jsonl"), "a int").collect()) == [1, 2]
    lines = spark.createDataFrame([(1, '{"a":1}'), (2, "broken")], "n long, line string")
    with pytest.raises(Exception, match="malformed line at 2"):
        readers.strict_json(lines, "line", "a int", F.col("n").cast("string")).collect()
    (tmp_path / "t").mkdir()
    for name in ("b.TXT", "A.txt", "c.md"):
        (tmp_path / "t" / name).write_text("x")
    (tmp_path / "t" / "d.pdf").write_bytes(b"%PDF-1.4")
    assert [r.file_name for r in readers.text_files(spark, str(tmp_path / "t")).collect()] == ["A.txt", "b.TXT"]
    assert [r.valid for r in readers.pdf_files(spark, str(tmp_path / "t")).collect()] == [True]
    r = one(spark, e=readers.dotenv(F.lit('﻿# c\nA=1\nB="x=y"\nA = 2\n')), u=readers.cli_usage(F.lit("\x1b[1m5h limit: 42% left (resets 10:15)\x1b[0m"))["left_pct"], n=readers.rate_limit_event(F.lit('x EV: {"a":{"b":1}} tail}'), "EV: "))
    assert r.e == {"B": "x=y", "A": "2"} and r.u == 42 and r.n == '{"a":{"b":1}}'
    body = 'data: {"choices":[{"delta":{"content":"Ha"}}]}\n\ndata: {"choices":[{"delta":{"content":"lo"},"finish_reason":"stop"}],"usage":{"total_tokens":7}}\ndata: [DONE]\ndata: {"choices":[{"delta":{"content":"!"}}]}'
    s = readers.event_stream(spark.createDataFrame([(1, body)], "k long, body string"), "k", "body").first()
    assert (s.content, s.finish_reason, s.total_tokens) == ("Halo", "stop", 7)
    logged = spark.createDataFrame([("tokens used: 1,234\nTokens used\n5.678".encode("utf-16"),)], "c binary")
    assert logged.select(readers.last_token_count(F.col("c")).alias("n")).first().n == 5678
    assert readers.csv_profile(docs(spark, "a; b ;\n1;2\n\n3;4\n"), "doc_id").first().asDict() == {"doc_id": 0, "row_count": 2, "columns": ["a", "b"]}


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "d long, p long, t string")
    assert sinks.joined_pages(pages, "d", "p", "t").first().text == "a\n\f\nb"
    path = str(tmp_path / "t")
    for n in (3, 5):
        sinks.replace_table(spark.range(n), path)
    assert spark.read.parquet(path).count() == 5
    rows = sinks.routed(spark.range(4).withColumn("ts", F.lit("2024-01-01").cast("timestamp")), F.col("id") > 1, "ts")
    sinks.append_log(rows, str(tmp_path / "log"))
    sinks.append_log(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).groupBy("bucket").count().orderBy("bucket").collect()[0]["count"] == 4
    assert sinks.empty_records(docs(spark, ""), spans.SECTIONS).first().status == "no_text"


def test_replace_table_survives_a_stop_between_its_steps(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    os.rename(path, f"{path}.old")  # stopped after the old table went aside
    assert spark.read.parquet(sinks.current_table(spark, path)).count() == 3
    sinks.replace_table(spark.range(5), path)
    spark.range(9).write.parquet(f"{path}.old")  # stopped before the old table was deleted
    assert spark.read.parquet(sinks.current_table(spark, path)).count() == 5 and not os.path.exists(f"{path}.old")


def test_long_lines_of_streams_and_titles_stay_whole(spark):
    long = "x" * 1_200_000
    body = 'data: {"choices":[{"delta":{"content":"' + long + '"}}]}'
    s = readers.event_stream(spark.createDataFrame([(1, body)], "k long, body string"), "k", "body").first()
    assert s.content == long
    assert clean.heading_sections(docs(spark, f"## {long}\nisi")).first().title == long


def test_rate_limit_events(spark):
    event = '{"type":"e","primary":{"used_percent":41.5,"window_minutes":300,"resets_at":%d},"s":"} \\" {"}'
    rows = [(100, f"x EV: {event % 900} tail}}"), (200, f"EV: {event % 5000}}}"), (300, "EV: {broken"), (250, "none")]
    df = spark.createDataFrame(rows, "at long, body string")
    r = df.select("at", readers.rate_limit_event(F.col("body"), "EV: ").alias("e")).orderBy("at").collect()
    assert [x.e for x in r] == [event % 900, event % 5000, None, None]
    get = lambda now: [tuple(x) for x in readers.current_limit(df, "body", "at", "EV: ", F.lit(now)).collect()]
    assert get(1000) == [(200, 41.5, 18000, 5000)] and get(5000) == [] and get(200 + 18001) == []


def test_page_titles_fall_back(spark):
    title = lambda x: one(spark, t=html.title(F.lit(x))).t
    assert title("<h1> </h1><h2>dua</h2>") == "dua" and title("<h3>tiga</h3><title>t</title>") == "tiga"
    assert title('<div class="x entry-title">masuk</div><title>t</title>') == "masuk" and title('<p class="post-title">pos</p>') == "pos"
    assert title("<title>akhir</title>") == "akhir" and title("<p>x</p>") is None


def test_unique_names_skip_taken_numbers(spark):
    names = ["a.pdf", "a.pdf", "a-2.pdf", "a.pdf", "a-4.pdf", "b.pdf", "a-2.pdf", "a.PDF", "a-02.pdf"]
    from lontar.operators import crawl

    df = spark.createDataFrame(list(enumerate(names)), "n int, name string")
    got = [r.unique_name for r in crawl.unique_names(df, "name", "n").orderBy("n").collect()]
    assert got == ["a.pdf", "a-3.pdf", "a-2.pdf", "a-5.pdf", "a-4.pdf", "b.pdf", "a-2-2.pdf", "a-6.pdf", "a-02.pdf"] and len(set(got)) == len(got)
    queue = crawl.batched(spark.range(1, 8).withColumnRenamed("id", "place"), "place", 3)
    assert sorted(r.batch for r in queue.collect()) == [0, 0, 0, 1, 1, 1, 2]
    links = spark.createDataFrame([(p, p, f"u{p}") for p in range(1, 40)], "page_id long, pos long, href string")
    assert html.walk(links, 100, "page_id").count() == html.walked_pages(100) == 7


def test_compatible_forms_and_json_texts(spark, tmp_path):
    r = one(spark, a=T.squeezed(F.lit("ﬁn  Ⅳ　x")), b=T.compact(F.lit("e\u0301 ½")), c=T.squeezed(F.lit("Plain é")), d=T.squeezed(F.lit(None).cast("string")))
    assert (r.a, r.b, r.c, r.d) == ("fin iv x", "é1⁄2", "plain é", None)
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "y" / "a.JSON").write_text("\ufeff{}", encoding="utf-8")
    (tmp_path / "x" / "b.txt").write_text("x")
    assert [(r.text, r.bytes) for r in readers.json_texts(spark, str(tmp_path / "x")).collect()] == [("{}", 5)]
    assert readers.json_texts(spark, str(tmp_path / "none")).count() == 0


def test_names_with_escapes(spark):
    name = lambda x: one(spark, t=urls.sanitized(F.lit(x))).t
    assert (name("a%20b%2Fc"), name("50%"), name("a+b"), name("%zz.pdf"), name(" . ")) == ("a b_c.pdf", "50%.pdf", "a+b.pdf", "%zz.pdf", "putusan.pdf")


def test_rewards(spark):
    r = one(spark, a=rewards.answer(F.lit("42"), F.lit("42")), b=rewards.answer(F.lit(None).cast("string"), F.lit("1")), c=rewards.number(F.lit("x"), F.lit("1")), d=rewards.language(F.lit("und"), "id"), e=rewards.extractive(F.lit(False), F.lit(0), F.lit(0), F.lit(1.0), F.lit(1.0), F.lit(True), F.lit(0.0), True))
    assert (r.a, r.b, r.c, r.d, r.e) == (5.0, -2.0, -2.5, -5.0, 0.0)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_whole_answers_read_answer_and_text_once(spark):
    """What a row computes must not grow with the places that name it: the answer is read once, the text split once."""
    df = spark.createDataFrame([("x", "y")], "content string, source string")
    r = df.select(F.inline(F.array(spans.whole_answer(F.col("content"), F.col("source")))))
    plan = _plan(r)
    assert plan.count("array(content#") == 1 and plan.count("split(source#") == 1 and plan.count("try_parse_json") + plan.count("parseJson") <= 2
    from lontar.plans import catalog

    plan = _plan(catalog.queries()["whole_answers"](spark, "/root/testdata/sf0.001"))
    assert plan.count("split(text#") == 2  # for the made answer, and for its lines


def test_blocks_look_through_lines_once(spark):
    """Sections come from one split of the text, each pattern stands once in the plan, and what is found is what looking
    line by line finds, with repeated lines, other line ends, and white space at the edges."""
    import random

    from lontar.operators import clean
    from lontar.plans import catalog, datasets

    found = spark.createDataFrame([("x",)], "source string").select(spans.blocks_of(F.col("source")).alias("b"))
    plan = _plan(found)
    assert plan.count("split(source#") == 2 and plan.count("akan\\s+mempertimbangkan") == 1  # by line feeds, else by all line ends
    plan = _plan(catalog.queries()["repair_blocks"](spark, "/root/testdata/sf0.001"))
    assert plan.count("split(text#") == 1 and plan.count("akan\\s+mempertimbangkan") == 1
    rng = random.Random(7)
    lines = [*datasets.MARKS, "", "  ", "x", " y\t", " ", "SURAT KETERANGAN", "menimbang", "PEMBACAAN  TUNTUTAN", "bukti surat", "ditahan", "İ ahli", "menetapkan", "Hakim", "\x1cz\x1f", "surat-surat lain", "menghadirkan dua Saksi"]
    texts = [rng.choice("\n\n\n\r\x0b").join(rng.choices(lines, k=rng.choice((1, 5, 40, 90)))) for _ in range(150)]
    texts += ["", "\n", "ahli", "\n".join(f"{i} ahli " for i in range(600)), "\n".join(f"{i % 300} surat {i % 300}" for i in range(700)), "\r\n".join(lines * 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, s string").withColumn("rows", F.split("s", "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85]", -1))
    plain = {k: clean.line_block(F.col("rows"), *spans.BLOCKS[k]) for k in spans.BLOCKS if k not in ("dakwaan", "pertimbangan_hukum")}
    got = df.select("i", spans.blocks_of(F.col("s")).alias("b")).select("i", *[F.col(f"b.{k}") for k in plain]).orderBy("i").collect()
    assert got == df.select("i", *[c.alias(k) for k, c in plain.items()]).orderBy("i").collect()
    assert sum(v is not None for r in got for v in r) > 800
    each = spark.createDataFrame([(x,) for x in lines], "x string")
    bits = each.select(spans.line_marks(F.col("x")).alias("m"), *[F.col("x").rlike(p).alias(f"p{i}") for i, p in enumerate(spans.PATTERNS)]).collect()
    assert all(r.m >> i & 1 == r[i + 1] for r in bits for i in range(len(spans.PATTERNS)))
    assert spans.needed_words(r"(?i)\bab(?:cd|ef)\s+Long[a]?|other") == ("long", "other") and spans.needed_words(r"x\s*y|word") == ()


def test_page_titles_decode_quotes(spark):
    r = one(spark, a=html.title(F.lit("<h1>token = &quot;ab&quot; &amp;lt; c</h1>")), b=html.title(F.lit('<h1>a "b" \\ c</h1>')))
    assert (r.a, r.b) == ('token = "ab" &lt; c', 'a "b" \\ c')
