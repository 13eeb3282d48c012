"""The dealt operators against plain models, on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from lontar.llm import components, lines, minhash, mixing, secrets, sentencepieces, substrings, tokenfiles, toxicity, vectors  # noqa: E402
from lontar.llm.common import Shelf, bytes_hash, span_hash  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "ab", "don't", " ", "  ", "\n", "\t", "1", "é", "日", ".", "'s", "▁", "\x1c", "\x85", "\xa0", "<|endoftext|>", "😀", "\r\n", "\x00", "x" * 50, "▁▁"]
texts_of = st.lists(st.sampled_from(ODD), max_size=14).map("".join)


def documents(spark, texts, extra=True):
    """Documents with ids 0, 1, ... and, to be in the way, columns named like the operators' own."""
    rows = [(i, t, "s" if i % 3 else None, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, score string, n_removed int")
    return df if extra else df.select("doc_id", "text", "source")


def words(text):
    return (text or "").encode().split()


PROSE = ["satu dua tiga empat lima enam", None, "", " \n\t ", "satu", "kata " * 5000, "a\x85b\xa0c d"]


# ---- SentencePiece and token files


@settings(max_examples=150, deadline=None)
@given(st.lists(texts_of, max_size=6))
def test_sentencepiece_equals_the_library(texts):
    chunks = sentencepieces.chunks_of(PIECES)
    sp = chunks.vocabulary.library
    found = sentencepieces.encoded(texts, chunks)
    want = [sp.encode(t, add_eos=True) for t in texts]
    assert [found.ids[a:b].tolist() for a, b in zip(found.cuts[:-1], found.cuts[1:])] == want and not found.corrected
    assert found.decimal() == [" ".join(map(str, w)).encode() for w in want] and found.decoded() == [sp.decode(w) for w in want]


def test_rounds_and_heap_agree():
    v = sentencepieces.chunks_of(PIECES).vocabulary
    rng = random.Random(1)
    chunks = ["▁" + "".join(rng.choices("abcdeingthr é日😀\x00'1.▁".replace(" ", ""), k=rng.randint(0, 60))) for _ in range(3000)]
    for some in (chunks, chunks[:1], ["▁"], [], ["▁" + "ab" * 50]):
        flat, sizes = v.merge_all(some)
        want = [v.merge(c) for c in some]
        assert flat.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


def test_the_cache_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(sentencepieces, "CACHE_BYTES", 20_000)
    chunks = sentencepieces.Chunks(sentencepieces.chunks_of(PIECES).vocabulary)
    sp = chunks.vocabulary.library
    rng = random.Random(2)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcde", k=rng.randint(1, 90))) for _ in range(30))]
        assert sentencepieces.encoded(texts, chunks).ids.tolist() == sp.encode(texts[0], add_eos=True)
        assert len(chunks.known.number) + len(chunks.old.number) < 120


@settings(max_examples=150, deadline=None)
@given(st.lists(texts_of, max_size=6))
def test_byte_pairs_equal_the_library(texts):
    e = tokenfiles.encoder_of(BYTES)
    for text, ids in zip(texts, e.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == e.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.lists(st.integers(0, 9000), min_size=1, max_size=4), st.integers(0, 99))
def test_images_round_trip(bits, counts, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, sum(counts)).astype(np.uint32)
    image = tokenfiles.Image(tokenfiles.image([None, *range(len(counts) - 1)], counts, ids, bits))
    assert (image.all_ids() == ids).all() and image.known.tolist() == [0] + [1] * (len(counts) - 1)
    at = 0
    for k, n in enumerate(counts):
        assert (image.ids(k) == ids[at : at + n]).all()
        at += n


def test_token_queries(spark):
    texts = [*PROSE, "kata\n\nlain", "kata\n\nlain"]
    df = documents(spark, texts)
    sp = sentencepieces.chunks_of(PIECES).vocabulary.library
    got = {r.doc_id: r for r in sentencepieces.op2(df, PIECES).collect()}
    library = tokenfiles.encoder_of(BYTES).library
    files = {r.doc_id: r for r in tokenfiles.op10(df, BYTES, 2).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = sp.encode(t or "", add_eos=True)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    coded = sentencepieces.encode(df, PIECES).where("doc_id = 0").first()
    assert coded.decoded == texts[0] and coded.score == "x"
    empty = df.where("false")
    assert sentencepieces.op2(empty, PIECES).count() == 0 and tokenfiles.op10(empty, BYTES, 2).count() == 0


# ---- Hashes


def thue_morse(n):
    """Two byte strings of length 2**n that polynomial hashes modulo 2**64 can't tell apart."""
    x, y = b"a", b"b"
    for _ in range(n):
        x, y = x + y, y + x
    return x.decode(), y.decode()


def test_hashes_of_spans():
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 5000, 700_000):
        raw = rng.integers(0, 3, size).astype(np.uint8)
        cuts = np.unique(np.append(rng.integers(0, size + 1, min(40, size)), [0, size]))
        starts, ends = np.append(cuts[:-1], [size, size]), np.append(cuts[1:], [size, size])
        for which in (0, 1):
            got = bytes_hash(raw, starts, ends, which)
            assert all(h == bytes_hash(raw[a:b].copy(), np.array([0]), np.array([b - a]), which)[0] for a, b, h in zip(starts, ends, got))
            values = rng.integers(0, 1 << 63, 200).astype(np.uint64)
            begin = rng.integers(0, 100, 50)
            end = begin + rng.integers(0, 100, 50)
            got = span_hash(values, begin, end, which)
            assert all(h == span_hash(values[a:b].copy(), np.array([0]), np.array([b - a]), which)[0] for a, b, h in zip(begin, end, got))
    for n in (8, 11, 14):
        x, y = (np.frombuffer(t.encode(), np.uint8) for t in thue_morse(n))
        one, all_ = np.array([0]), np.array([len(x)])
        assert all(bytes_hash(x, one, all_, k) != bytes_hash(y, one, all_, k) and span_hash(x.astype(np.uint64), one, all_, k) != span_hash(y.astype(np.uint64), one, all_, k) for k in (0, 1))


def test_structured_lines_and_words_do_not_collide(spark):
    x, y = thue_morse(11)
    texts = [f"{x}\np\nq", f"{y}\np\nq"]
    assert [r.n_removed for r in lines.dedup_lines(documents(spark, texts)).collect()] == [0, 0]
    rest = " ".join(f"r{i}" for i in range(34))
    assert [r.n_removed for r in substrings.op5(documents(spark, [f"{x} {rest}", f"{y} {rest}"])).collect()] == [0, 0]
    assert all(r.kept for r in minhash.op6(documents(spark, [x, y])).collect())
    words_x, words_y = (" ".join(t[:256]) for t in thue_morse(8))
    assert {r.n_shingles for r in minhash.op6(documents(spark, [words_x, words_y])).collect()} == {len({tuple(w[i : i + 5]) for i in range(252)}) for w in (words_x.split(), words_y.split())}


# ---- Line and passage deduplication


def lines_model(texts):
    """Kept text of each document, rows being in order of doc_id."""
    seen, out = {}, []
    places = [(d, i) for d, t in enumerate(texts) if t is not None for i in range(len(t.split("\n")) - 2)]
    for d, i in places:
        key = "\n".join(texts[d].split("\n")[i : i + 3])
        if key.strip(" \t\n\r\x0b\x0c"):
            seen.setdefault(key, (d, i))
    for d, t in enumerate(texts):
        if t is None:
            out.append(None)
            continue
        rows = t.split("\n")
        gone = set()
        for i in range(len(rows) - 2):
            key = "\n".join(rows[i : i + 3])
            if seen.get(key, (d, i)) != (d, i):
                gone |= {i, i + 1, i + 2}
        out.append("\n".join(x for k, x in enumerate(rows) if k not in gone))
    return out


def test_line_dedup(spark):
    rng = random.Random(2)
    texts = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb\nc", None, "", "\n\n\n\n", "\n\n\n\n", "e\ne\ne\ne\ne", "no end"]
    texts += ["\n".join(rng.choices(["p", "q", ""], k=rng.randint(0, 12))) for _ in range(40)]
    df = documents(spark, texts).withColumn("n_chars", F.lit(-1))
    rows = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    want = lines_model(texts)
    for i, t in enumerate(texts):
        assert rows[i].text == want[i]
        assert rows[i].n_chars == (None if t is None else len(want[i]))
        assert rows[i].score == "x" and rows[i].n_lines == (t.count("\n") + 1 if t else 0)
    twice = df.where("doc_id = 0").union(df.where("doc_id = 0"))
    assert [r.n_removed for r in lines.dedup_lines(twice).collect()] == [0, 0]
    assert lines.dedup_lines(df.where("false")).count() == 0


def passages_model(texts):
    n = substrings.WINDOW
    seen = Counter(tuple(w[i : i + n]) for w in map(words, texts) for i in range(len(w) - n + 1))
    out = []
    for w in map(words, texts):
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_passage_dedup(spark):
    rng = random.Random(4)
    vocabulary = [f"k{i}" for i in range(40)]
    base = rng.choices(vocabulary, k=400)
    texts = [None, "", "satu dua", "a " * 500, "a " * 36, "a b " * 60]
    for _ in range(40):
        a = rng.randrange(380)
        texts.append("  ".join([*rng.choices(vocabulary, k=rng.randint(0, 60)), *base[a : a + rng.randint(5, 120)], *rng.choices(vocabulary[:2], k=rng.randint(0, 50))]))
    texts += texts[6:9]
    rows = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.kept_texts(documents(spark, texts)).collect()}
    for i, want in enumerate(passages_model(texts)):
        assert rows[i] == want, i
    assert substrings.op5(documents(spark, texts).where("false")).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    from lontar.llm.common import mix

    for _ in range(25):
        vocabulary = mix(np.arange(1, rng.integers(3, 300), dtype=np.uint64))
        base = rng.choice(vocabulary, 200)
        parts = [np.concatenate([rng.choice(vocabulary, rng.integers(0, 90)), base[(a := rng.integers(0, 160)) : a + rng.integers(30, 150)], rng.choice(vocabulary[:2], rng.integers(0, 50))]) for _ in range(5)]
        w, first = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
        of = {s: int(k) for a, b, k in zip(*substrings.anchors(w, first)) for s in range(a, b + 1)}
        seen = defaultdict(set)
        for a, b in zip(first[:-1], first[1:]):
            for s in range(a, b - substrings.WINDOW + 1):
                seen[w[s : s + substrings.WINDOW].tobytes()].add(of[s])
        assert all(len(v) == 1 for v in seen.values())


# ---- Near duplicates


def classes(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(6)
    for n, m in ((1, 0), (30, 20), (200, 190), (60, 59)):
        links = [(i, i + 1) for i in range(n - 1)] if m == n - 1 else [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        got = dict(components.components(spark.createDataFrame(links, "a long, b long"), Shelf(spark, "test")).collect()) if links else {}
        want = classes(n, links)
        assert all(got.get(i, i) == want[i] for i in range(n))


def test_minhash(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [None, "", "  ", "satu dua", "SATU dua", "satu dua tiga"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(40, 200))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = [x.translate(low) for x in words(t)]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    links = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = classes(len(texts), links)
    df = documents(spark, texts)
    odd = spark.createDataFrame([(None, texts[-1], "s", "x", 1)], df.schema)
    rows = minhash.op6(df.union(odd)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert minhash.op6(df.where("false")).count() == 0


def test_minhash_links_from_its_threshold_on(spark):
    import corpus_pipeline as c

    rng = random.Random(9)
    texts = []
    for n in (52, 54, 56, 58, 60, 62):  # one word of n changed: (n - 9) / (n + 1), 0.81 to 0.84
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts += [" ".join(base), " ".join([*base[:20], "x", *base[21:]])]
    df = documents(spark, texts)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == {i: i - i % 2 for i in range(len(texts))}
    assert all(r.kept for r in minhash.op6(df).collect())
    assert sorted(r.doc_id for r in c.drop_near_copies(spark, df, "").collect()) == list(range(0, len(texts), 2))
    assert minhash.bands_for(85) == 24 and (1 - 0.8**minhash.ROWS) ** minhash.bands_for(80) <= 1.2e-5


def vectors_table(spark, rng, n=220):
    rows, base = [], rng.normal(size=(12, 16))
    for i in range(n):
        x = base[rng.integers(12)] + rng.normal(size=16) * 0.08
        rows.append((i, [float(v) for v in x.astype(np.float32)], int(rng.integers(2))))
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [1.0, None], 0), (n + 4, rows[0][1], None), (n + 5, rows[0][1], rows[0][2]), (n + 6, [1.0, 2.0], 0), (n + 7, [1.01, 2.0], 0), (n + 8, [], 0), (n + 9, [2.0, 1.0], 0), (n + 10, [1.0], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"Near": F.lit("x"), "k1": F.lit(1), "bucket": F.lit(2)})


def good_vectors(rows):
    """The vectors that take part, by their number of components."""
    out = defaultdict(list)
    for r in rows:
        if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]):
            out[len(r[1])].append(r)
    return out


def vector_links(rows):
    links = []
    for good in good_vectors(rows).values():
        x = np.array([np.array(r[1], np.float32) for r in good], np.float64)
        norms = np.linalg.norm(x, axis=1)
        near = x @ x.T / norms / norms[:, None] >= 0.98
        links += [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(np.tril(near, -1))) if good[a][2] is not None and good[a][2] == good[b][2]]
    return links


def test_vectors(spark):
    rows, df = vectors_table(spark, np.random.default_rng(9))
    links = vector_links(rows)
    want, degree = classes(len(rows), links), Counter(v for p in links for v in p)
    assert (227, 226) in links
    for r in vectors.op3(df).collect():
        assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
    got = defaultdict(list)
    for r in vectors.neighbours(df, F.col("vec_id") % 20 == 6).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for good in good_vectors(rows).values():
        ids, x = [r[0] for r in good], np.array([np.array(r[1], np.float32) for r in good], np.float64)
        for q in [i for i in ids if i % 20 == 6]:
            d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(1))
            best = [(ids[j], d[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:10]
            assert len(got[q]) == len(best) and got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
            assert all(s == pytest.approx(d[ids.index(v)], abs=1e-12) for v, s in got[q])
            hits += len({v for v, _ in got[q]} & {v for v, _ in best})
            total += len(best)
    assert hits / total >= 0.9 and len(got[226]) == 2
    few = df.where("vec_id < 5")
    assert [r.vec_id for r in vectors.op7(few).collect()] and vectors.op7(few).count() == 4
    assert vectors.op3(df.where("false")).count() == vectors.op7(df.where("false")).count() == 0


def test_dense_groups_and_cones(spark, monkeypatch):
    """Long lists in small blocks: links among hundreds of different vectors, counted and joined exactly."""
    monkeypatch.setattr(vectors, "LIST_BLOCK", 40)
    rng = np.random.default_rng(21)
    base = rng.normal(size=(3, 24))
    x = np.concatenate([base[rng.integers(3, size=250)] + 0.1 * rng.normal(size=(250, 24)), 4 + 0.9 * rng.normal(size=(120, 24))])
    rows = [(i, [float(v) for v in r], int(i % 5 == 0)) for i, r in enumerate(x.astype(np.float32))]
    rows += [(370 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    links = vector_links(rows)
    want, degree = classes(600, links), Counter(v for p in links for v in p)
    got = {r.vec_id: r for r in vectors.op3(df).collect()}
    assert len(links) > 2000 and sum(r.n_links for r in got.values()) == 2 * len(links)
    for i, r in got.items():
        assert (r.n_links, r.component_id) == (degree[i], want[i])


@pytest.mark.parametrize("width", [16, 64, 256])
def test_index_finds_pairs_at_the_threshold(width):
    """Recall of the lists themselves: pairs at a cosine of 0.9801, among directions at random and in a cone."""
    rng = np.random.default_rng(width)
    for middle in (0.0, 3.0):
        base = rng.normal(size=(600, width)) / np.sqrt(width) + middle / np.sqrt(width)
        base /= np.linalg.norm(base, axis=1)[:, None]
        turn = rng.normal(size=base.shape)
        turn -= (turn * base).sum(1)[:, None] * base
        turn /= np.linalg.norm(turn, axis=1)[:, None]
        other = 0.9801 * base + np.sqrt(1 - 0.9801**2) * turn
        points = vectors.reference_points(base[:300], width)
        near = lambda x: [set(r) for r in np.argsort(-(x @ points.T), axis=1, kind="stable")[:, : vectors.NEAREST].tolist()]
        met = [len(a & b) >= vectors.SHARED for a, b in zip(near(base), near(other))]
        assert np.mean(met) >= 0.99


def test_nearest_on_structured_vectors():
    """On vectors in clusters the index visits a part of the rows."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 32))[rng.integers(60, size=2000)] + 0.15 * rng.normal(size=(2000, 32))
    h = vectors.Hashes(x)
    asked, seen = x[::50], np.zeros((40, 2000), bool)
    for t in range(vectors.TABLES):
        rows = vectors.bucket_ids(h.cells(x, t)[0], t)
        for q, (cell, inside) in enumerate(zip(*h.cells(asked, t))):
            seen[q] |= np.isin(rows, vectors.bucket_ids(h.probes(cell, inside), t))
    near = np.argsort(((x[None] - asked[:, None]) ** 2).sum(2), axis=1)[:, 1:11]
    assert np.take_along_axis(seen, near, 1).mean() >= 0.9 and seen.mean() <= 0.5


# ---- Secrets, mixing, toxicity

KEYWORD = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"


def best_entropy(x, n):
    return max(-sum(c / n * np.log2(c / n) for c in Counter(x[i : i + n]).values()) for i in range(len(x) - n + 1))


def test_secrets(spark):
    rng = random.Random(10)
    bits = ["token=", "Api_Key: 'abcdef0123", "password = hunter22x", "token=token:abcdefgh", "secret:abc", "AKIA" + "Q" * 16, "AKIAQ", "deadbeef" * 4, "😀", " ", "\n", "plainword" * 4, "aZ3dQ9xK2mP7vR4tL8wB", "550e8400-e29b-41d4-a716-446655440000", "path/to/some/long/directory", '"', "'", "0" * 30]
    texts = [None, "", *["".join(rng.choices(bits, k=rng.randint(1, 9))) for _ in range(150)]]
    rows = {r.doc_id: r for r in secrets.op8(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        base = [(m.start(), 0, m.end()) for m in re.finditer(KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        spans = []
        for m in re.finditer(secrets.CANDIDATE, t):
            x = m[0]
            need = next((b for _, p, b in secrets.CLASSES if re.search(p, x)), None)
            if not any(re.search(p, x) for p in secrets.ALLOWED) and re.search("[0-9]", x) and re.search("[A-Za-z]", x) and best_entropy(x, secrets.WINDOW) >= need - 1e-9:
                spans.append((m.start(), 3, m.end()))
        show = lambda s: ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(s))
        r = rows[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3)), t
        assert r.base_sha256 == hashlib.sha256(show(base).encode()).hexdigest() and r.spans == show(base + spans), t


def test_secrets_in_very_long_texts(spark):
    """Time in proportion to the length: long slugs, long base64, many matches."""
    rng = random.Random(14)
    base64 = "".join(rng.choices(secrets.ALPHABET, k=1_000_000))
    many = " ".join(["token=abcdef12"] * 100_000)
    texts = ["a-" * 500_000, "a-" * 500_000 + "1", base64, many]
    rows = {r.doc_id: r for r in secrets.op8(documents(spark, texts).repartition(4)).collect()}
    assert [rows[i].spans for i in (0, 1)] == ["", ""]
    assert rows[2].spans.endswith("entropy:0:1000000") and rows[2].n_entropy == 1
    want = ",".join(f"assign:{15 * i}:{15 * i + 14}" for i in range(100_000))
    assert rows[3].n_assign == 100_000 and rows[3].spans == want


def test_permutations_are_bijections(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).withColumn("back", mixing.permuted(F.col("p"), F.lit(n).cast("long"), F.lit(3), inverse=True)).collect()
        assert sorted(r.p for r in got) == list(range(n)) and all(r.back == r.id for r in got)


def mixing_model(rows):
    """Size and target of each source."""
    size = Counter()
    for _, s, t in rows:
        size[s] += len(words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    free, target, rest = set(order), {}, sum(size.values())
    while over := [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * size[s]]:
        target |= {s: 3 * size[s] for s in over}
        free -= set(over)
        rest = sum(size.values()) - sum(target.values())
    return size, target | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}


@pytest.mark.parametrize("block, shard", [(2048, 4096), (32, 64), (7, 5)])
def test_mixing(spark, block, shard):
    rng = random.Random(11)
    rows = [(i, rng.choice(["a", "b", "c", "d", "d", "d", "d", None]), rng.choice([None, "", "kata " * rng.randint(1, 400)])) for i in range(400)]
    rows += [(1000, "one", "kata"), (1001, "five", "a b c d e"), (1002, "long", "kata " * 30_000), (1003, "s33", "kata " * 33), *[(1004, "again", "kata " * 50)] * 3, (None, "again", "x y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"size": F.lit("x"), "share": F.lit(1), "Block": F.lit(2)})
    run = lambda d: sorted(mixing.mix(d, block_words=block, shard_slots=shard).collect(), key=str)
    got = run(df)
    assert got == run(df.repartition(7))
    size, target = mixing_model(rows)
    texts = {i: t for i, _, t in rows}
    taken = Counter()
    for r in got:
        assert r["size"] == len(words(texts[r.doc_id])) and 0 <= r.taken <= 3 * r["size"] and (r.first_shard is not None) == (r.taken > 0)
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in size)
    assert mixing.op9(df.where("false")).count() == 0 and mixing.mixed_documents(df.where("false")).count() == 0
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns and docs.where("size <> 'x'").count() == 0


def test_mixing_draws_and_blocks(spark):
    """``taken`` from the slots by plain arithmetic, and the counts of a shard against their probabilities."""
    from lontar.llm.common import Shelf

    rng = random.Random(12)
    rows = [(i, rng.choice("aabbbbbbc"), "kata " * rng.randint(1, 90)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    shelf, block = Shelf(spark, "test"), 16
    sizes = mixing.sized(df)
    plan = mixing.targets(sizes, block_words=block)
    filled = mixing.slots(plan, shelf, shard_slots=100).collect()
    assert len({(r.shard, r.slot) for r in filled}) == len(filled) and all(r.shard < 0 or 0 <= r.slot < 100 for r in filled)
    use = defaultdict(Counter)  # source -> word -> times
    total = {r.source: r.source_size for r in plan.collect()}
    passes = Counter((r.source, r["pass"], r.block) for r in filled)
    assert set(passes.values()) == {1}
    for r in filled:
        for w in range(r.block * block, min(total[r.source], r.block * block + (block if r.words is None else r.words))):
            use[r.source][w] += 1
    starts = {(r.doc_id, r.source): (r.start, r["size"]) for r in mixing.placed(sizes).collect()}
    for r in mixing.mix(df, block_words=block, shard_slots=100).collect():
        a, n = starts[r.doc_id, r.source]
        assert r.taken == sum(use[r.source][w] for w in range(a, a + n))
    drawn = defaultdict(Counter)
    for r in mixing.draws(plan, shelf, shard_slots=100).collect():
        drawn[r.shard][r.source] = r.n
    p = {r.source: r.high - r.low if r.high <= 1 else 1 - r.low for r in plan.collect()}
    whole = [c for c in drawn.values() if c.total() == 100]
    assert len(whole) >= 5 and all(abs(c[s] - 100 * p[s]) <= 5 * (100 * p[s] * (1 - p[s])) ** 0.5 for c in whole for s in p)
    assert len({tuple(sorted(c.items())) for c in whole}) > 1  # a draw, not a quota


def test_toxicity(spark):
    rng = random.Random(12)
    plain = [f"kata{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        w = rng.choices(plain, k=rng.randint(5, 60))
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["you idiot", "zork" + rng.choice("abcdef") + "x"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "kata1 " * 20000), (None, "kata2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.op4(docs, marks).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in range(600) if got[i].held_out] == held
    right = sum(got[i].predicted == int(i % 6 == 0) for i in held)
    assert right / len(held) >= 0.95
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.op4(docs, flipped).collect()}
    assert again == {k: r.score for k, r in got.items()}
    assert toxicity.op4(docs, marks.where("false")).where("score <> 0").count() == 0
    assert toxicity.op4(docs.where("false"), marks).count() == 0


def test_isotonic_is_monotone():
    rng = np.random.default_rng(13)
    raw = rng.normal(size=300)
    x, y = toxicity.isotonic(raw, (raw + rng.normal(size=300) > 0).astype(float))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all()


def described_by_hand(text, lexicon):
    """The features of a text, straight from their names."""
    text = text or ""
    letters = lambda x: re.findall(r"[^\W\d_]+", x)
    w = letters(text.lower())
    weight = lambda x: max([0.0, *[o for u in toxicity.units({x}) if u in lexicon.counts and (o := lexicon.odds(*lexicon.counts[u])) >= toxicity.LEAST_ODDS]])
    n, size = max(1, len(w)), max(1, len(text))
    hit = [weight(x) > 0 for x in w]
    insult = [x in toxicity.INSULTS for x in w]
    near = sum(any(x in toxicity.SECOND for x in w[max(0, i - 5) : i + 6]) for i in range(len(w)) if hit[i] or insult[i])
    odd = [m.group() for m in toxicity._ODD.finditer(text)]
    plain = ["".join(letters(x.lower().translate(toxicity.LEET))) for x in odd]
    count = lambda marks: sum(text.count(c) for c in marks)
    you = sum(x in toxicity.SECOND for x in w)
    return [
        sum(hit), sum(hit) / n, len({x for x, h in zip(w, hit) if h}), max(map(weight, w), default=0.0), sum(map(weight, w)), sum(insult), sum(insult) / n, near, near / n, you / n,
        sum(c.isupper() for c in text) / size, len(toxicity._SHOUT.findall(text)) / n, count("!") / size, count("?") / size, count(".,;*#") / size, len(odd) / n,
        sum(p in toxicity.INSULTS or weight(p) > 0 for p in plain), len(toxicity._LONG.findall(text)) / n, np.log1p(len(w)),
    ]


def test_toxicity_by_hand(spark):
    """Features from their definitions, tree sums by walking each tree, calibration by pooling all adjacent pairs."""
    rng = random.Random(15)
    lexicon = toxicity.Lexicon({"zork": (30, 1), "^zor": (40, 9), "kata": (3, 50), "blip": (6, 6)}, 100, 100)
    bits = ["zork", "ZORKA", "you", "idiot", "kata", "1d10t", "b.l.i.p", "!!!", "a,b;", "sooo", "é", "du", "\n", "x?"]
    texts = [None, "", *[" ".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(150)]]
    x = np.array([toxicity.describe(t, lexicon) for t in texts])
    assert np.allclose(x, [described_by_hand(t, lexicon) for t in texts]) and x.shape[1] == len(toxicity.NAMES)
    y = np.array([float(r[0] + rng.random() > 2) for r in x])
    model = toxicity.fit_trees(x, y)

    def walk(row):
        out = model.base
        for feature, cut, leaf in model.trees:
            at = 0
            for _ in range(toxicity.DEPTH):
                j = feature[at]
                at = 2 * at + 1 + int(sum(e <= row[j] for e in model.edges[j]) > cut[at])
            out += leaf[at - (2**toxicity.DEPTH - 1)]
        return out

    raw = model.raw(x)
    assert np.allclose(raw, [walk(r) for r in x])
    middle, share = toxicity.isotonic(raw, y)
    blocks = [[v, 1, t] for v, t in sorted(zip(raw, y))]
    blocks = [[sum(t for v, _, t in blocks if v == u) / sum(v == u for v, _, _ in blocks), sum(v == u for v, _, _ in blocks)] for u in sorted({b[0] for b in blocks})]
    while any(a[0] >= b[0] for a, b in zip(blocks, blocks[1:])):
        k = next(k for k, (a, b) in enumerate(zip(blocks, blocks[1:])) if a[0] >= b[0])
        (s, n), (t, m) = blocks[k], blocks[k + 1]
        blocks[k : k + 2] = [[(s * n + t * m) / (n + m), n + m]]
    assert np.allclose(share, [b[0] for b in blocks]) and len(middle) == len(blocks)
    whole = toxicity.Model(lexicon, model, (middle, share), 0.5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("Score", F.lit("x")).withColumn("note", F.lit(1))
    got = toxicity.score(docs, whole)
    assert got.columns == ["doc_id", "text", "note", "score", "predicted"]
    want = 0.99 * np.interp(raw, middle, share) + 0.01 / (1 + np.exp(-raw))
    assert all(abs(r.score - want[r.doc_id]) < 1e-9 and r.predicted == (r.score >= 0.5) for r in got.collect())


def test_columns_of_the_operators_names_in_any_case(spark):
    """Columns of the input that clash in another case are replaced; the others pass through."""
    df = documents(spark, ["satu dua", None]).withColumnsRenamed({"score": "IDS", "n_removed": "N_Lines"}).withColumn("Decoded", F.lit(1)).withColumn("n_words", F.lit("x"))
    assert sentencepieces.encode(df, PIECES).columns == ["doc_id", "text", "source", "N_Lines", "n_words", "ids", "decoded"]
    assert lines.dedup_lines(df).columns == ["doc_id", "text", "source", "IDS", "Decoded", "n_words", "n_lines", "n_removed"]
    assert substrings.op5(df).count() == minhash.op6(df.withColumn("component_id", F.lit(1))).count() == 2
    assert mixing.mixed_documents(df.withColumns({"share": F.lit(1), "copies": F.lit(2), "copy": F.lit(3), "id": F.lit(4)})).columns[-4:] == ["share", "copies", "copy", "id"]
    assert secrets.scan_secrets(df).count() == 2


def test_very_long_texts(spark):
    """A megabyte without spaces, without line ends, and of one repeated word."""
    texts = ["x" * 1_000_000, "y" * 1_000_000 + "\na\nb\nc", "kata " * 200_000, "a\n" * 300_000, "kata " * 200_000]
    df = documents(spark, texts)
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.dedup_lines(df).collect()}
    assert got == {0: (1, 0), 1: (4, 0), 2: (1, 0), 3: (300_001, 299_997), 4: (1, 0)} or got[3][1] >= 299_996
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.op5(df).collect()}
    assert got == {0: (1, 0), 1: (4, 0), 2: (200_000, 200_000), 3: (300_000, 300_000), 4: (200_000, 200_000)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.op6(df).collect()}
    assert got == {0: (1, 0), 1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 2)}


# ---- Pipeline


def pipeline_documents(spark, n=160):
    rng = random.Random(30)
    plain = [f"kata{i}" for i in range(300)]
    rows = [(None, "tanpa nomor satu dua tiga", "id", "a", 24), (9000, None, "id", "a", None), (9001, "", "id", None, 0), (9002, " \n ", "id", "b", 3)]
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(8, 60))
        if i % 5 == 2:
            w[3] = "you idiot"
        if i % 7 == 3 and len(rows) > 20:
            w = (rows[rng.randrange(8, len(rows))][1] or "x").replace("\n", " ").split()
            w[len(w) // 2] = "ubah"
        text = " ".join(w)
        if i % 6 == 1:
            text = "kepala\nsatu\ndua\ntiga\n" + text
        rows.append((i, text, "id", rng.choice(["a", "b", "b", "b", None]), len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 2)) for i in range(n)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_pipeline_against_plain_models(spark, tmp_path):
    """``run`` over a small folder, each stage's rows against a brute-force version of what it is given."""
    import corpus_pipeline as c

    rows, docs, labels = pipeline_documents(spark)
    docs.withColumnRenamed("n_chars", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    folder = str(tmp_path)
    read = lambda df: sorted(map(tuple, df.collect()), key=str)
    stages = dict(c.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    by_id = lambda some: sorted(some, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))

    first = read(stages["toxicity"](spark, docs, folder))
    model = toxicity.fit(docs, labels)
    scores = model.scores(np.array([toxicity.describe(r[1], model.lexicon) for r in rows]))
    assert first == sorted([r for r, s in zip(rows, scores) if s < 0.5], key=str)
    gone = {r[0] for r in rows} - {r[0] for r in first}
    assert len(gone) >= 0.8 * sum("idiot" in (r[1] or "") for r in rows)
    assert not any("idiot" not in (r[1] or "") for r in rows if r[0] in gone)

    at = spark.createDataFrame(first, docs.schema)
    second = read(stages["line_dedup"](spark, at, folder))
    ordered = by_id(first)
    kept = lines_model([r[1] for r in ordered])
    want = sorted([(*r[:1], t, *r[2:4], None if t is None else len(t)) for r, t in zip(ordered, kept)], key=str)
    assert second == want and any(a[1] != b[1] for a, b in zip(second, sorted(first, key=str)))

    at = spark.createDataFrame(second, docs.schema)
    third = read(stages["minhash_near_dedup"](spark, at, folder))
    ordered = by_id(second)
    sets = []
    for r in ordered:
        w = [x.lower() for x in words(r[1])] if r[0] is not None else []
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    near = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = classes(len(sets), near)
    assert third == sorted([r for k, r in enumerate(ordered) if root[k] == k], key=str) and len(third) < len(second)

    at = spark.createDataFrame(third, docs.schema)
    fourth = read(stages["mixing_to_weights"](spark, at, folder))
    shares = {(r.doc_id, r.source): r.taken / r["size"] for r in mixing.mix(at).collect() if r["size"]}
    times = Counter(fourth)
    assert set(times) <= set(third) and all(words(r[1]) for r in times)
    for r in third:
        share = shares.get((r[0], r[3]), 0.0)
        assert times[r] in (int(share), int(share) + 1) and (times[r] == share if share == int(share) else True)

    at = spark.createDataFrame(fourth, docs.schema)
    sp = sentencepieces.chunks_of(PIECES).vocabulary.library
    fifth = stages["sentencepiece"](spark, at, folder).collect()
    assert sorted((str(r.doc_id), str(r.source), r.n_tokens, list(r.ids), r.round_trip) for r in fifth) == sorted((str(r[0]), str(r[3]), len(ids), ids, sp.decode(ids) == r[1]) for r in fourth for ids in [sp.encode(r[1], add_eos=True)])
    assert sorted((str(r.doc_id), list(r.ids)) for r in c.run(spark, folder).collect()) == sorted((str(r.doc_id), list(r.ids)) for r in fifth)


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, repeated rows, and columns whose names clash in any case."""
    import corpus_pipeline as c

    _, docs, labels = pipeline_documents(spark, 40)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    odd = docs.union(docs.where("doc_id < 5")).withColumns({"Score": F.lit("s"), "IDS": F.lit(1), "Component_Id": F.lit(2), "share": F.lit(3), "N_removed": F.lit(4), "kept": F.lit(True), "m": F.lit(5)})
    for name, stage in c.STAGES:
        for some in (odd, odd.where("false"), docs.where("text is null")):
            got = stage(spark, some, str(tmp_path))
            assert got.columns == some.columns or name == c.STAGES[-1][0], name
            assert got.count() <= 3 * some.count()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c
    from lontar.sources.tables import table

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(c.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        assert docs.columns == columns or name == c.STAGES[-1][0]
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] <= sizes[2] and sizes[5] == sizes[4]
    assert docs.where("not round_trip").count() == 0


def test_registered_line_dedup_equals_its_sql(spark):
    import duckdb

    from lontar.llm import queries

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(queries.oracle_sql()["op1_line_dedup"]).fetchall())
    assert sorted(map(tuple, queries.queries()["op1_line_dedup"](spark, "/root/testdata/sf0.001").collect())) == want
    assert pa.__version__
