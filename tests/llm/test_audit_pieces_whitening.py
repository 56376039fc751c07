"""Filter audit, merge-type pieces and whitening, against brute force."""

import hashlib
import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from driftvault.llm import filter_audit, piece_bpe, queries, whitening

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DIR = "/root/testdata/sf0.001"


# -- filter audit --


def plain_audit(docs, labels):
    """Every order applied document by document."""
    import re

    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    first, rows = {}, []
    rank = lambda i: -(2**63) if i is None else i
    for i, t, _ in docs:
        first[t or ""] = min(first.get(t or "", rank(i)), rank(i))
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": rank(i) > first[t]}
        rows.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, k in enumerate(order, 1):
                lost = [r for r in left if k in r[1]]
                left = [r for r in left if k not in r[1]]
                out[part, "".join(order), step] = (len(left), len(lost), sum(k in r[1] for r in gone), sum(r[1] == {k} and r[0] == part for r in rows), sum(r[2] for r in lost), sum(r[3] for r in lost))
                shapley[part, k] += len(lost)
                gone += lost
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def audit_rows(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = df.collect()
    assert len(got) == len({(r.part, r.filter_order, r.step) for r in got})
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got}


def random_documents(seed=3, n=300):
    dice = random.Random(seed)
    texts = [None, "", " \n", "x" * 300, "a b " * 60, " ".join(map(str, range(30_000)))]
    for _ in range(60):
        words = [dice.choice(["a", "B", "Cc", "d#", "e", "FGH", "é", "naïve", f"w{dice.randrange(400)}"]) for _ in range(dice.choice([3, 99, 100, 101, 150]))]
        texts.append("".join(w + dice.choice([" ", "\n", "\t ", "\x0b"]) for w in words))
    docs = [(dice.choice([None, 2**53 + 1, 2**63 - 1, dice.randrange(100)]) if k % 9 == 0 else k, dice.choice(texts), dice.choice(["en", "de", None, ""])) for k in range(n)]
    labels = [(dice.choice([None, k]), dice.choice([0, 1, None]), dice.choice([0, 1, None])) for k in range(200) for _ in range(dice.choice([1, 1, 2]))]
    return docs, [*labels, (2**53 + 1, 1, 1), (10**9, 1, 1)]


def test_every_order_against_brute_force(spark):
    docs, labels = random_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(1).withColumns({c: F.lit("own") for c in ("mask", "own", "n", "words", "body", "h1", "part", "doc", "good")})
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("own"))
    assert audit_rows(filter_audit.audit_filters(df, known)) == plain_audit(docs, labels)


def test_audit_of_nothing_and_without_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert audit_rows(filter_audit.audit_filters(one, labels)) == plain_audit([(1, "a", "en")], [])


def test_audit_is_native(spark):
    masks = filter_audit.failure_masks(spark.read.parquet(f"{DIR}/documents.parquet"))
    plan = filter_audit.interactions(filter_audit.mask_histogram(masks, spark.read.parquet(f"{DIR}/labels.parquet")), list("ABCDE"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


# -- merge-type pieces --


def plain_merge(text, ids, scores):
    """The best-scored neighbours are merged, the leftmost of equal ones, until none can be."""
    parts = list(text)
    while True:
        pairs = [(-scores[ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids]
        if not pairs:
            return parts
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.Pieces.load(MODEL)


def strange_texts(pieces, n, seed=5):
    dice = random.Random(seed)
    kinds = ["abcdefghij", "   \t\n", "▁ ab", "thein ", "日本語中文字", "🙂é́�", "0123456789", "=-_/#<>", "AaBbIiNnGg ", "\x00\x01͸"]
    known = sorted(pieces.texts.values())
    for k in range(n):
        if k % 2:
            yield "".join(dice.choice(dice.choice(kinds)) for _ in range(dice.randint(0, 60)))
        else:
            yield "".join(dice.choice(known) for _ in range(dice.randint(0, 12))).replace("▁", " ")


def test_encoding_and_decoding_against_the_library(library, pieces):
    codec = piece_bpe.TextCodec(pieces, cached=500)
    texts = [*strange_texts(pieces, 6000), "", " ", " " * 70, "a" * 50_000, "ab " * 20_000, "日" * 20_000, "͸" * 5000, "<s></s><0x41><unk>"]
    for text in texts:
        want = library.encode(text, add_eos=True)
        assert codec.encode(text) == want == [*pieces.encode(text), library.eos_id()], text[:80]
        decoded = library.decode(want)
        assert pieces.decode(want) == decoded
        digest = len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        assert codec.digest(text) == digest


def test_decoding_of_any_ids(library, pieces):
    dice = random.Random(8)
    for _ in range(3000):
        ids = [dice.choice([dice.randrange(3, 32_000), dice.randrange(1, 259)]) for _ in range(dice.randint(0, 14))]
        assert pieces.decode(ids) == library.decode(ids)


def small_pieces(words, seed, ties=False):
    """A vocabulary as merging makes it: characters, then merges of what is there, with falling scores."""
    dice, texts = random.Random(seed), list("abc▁")
    while len(texts) < words:
        t = dice.choice(texts) + dice.choice(texts)
        if t not in texts and len(t) < 9:
            texts.append(t)
    scores = {i: -float(i // 3 if ties else i) for i in range(len(texts))}
    return dict(enumerate(texts)), scores


def test_backtracking_on_small_vocabularies():
    """Every text of a few letters, for vocabularies in which the longest piece is often wrong. Pieces that cross spaces
    forbid cuts, and pieces that merging never makes are never used."""
    dice, given_up, uncut = random.Random(2), 0, 0
    for seed in range(40):
        texts, scores = small_pieces(14, seed)
        p = piece_bpe.Pieces(texts, scores, {b: 1000 + b for b in range(256)}, 999)
        uncut += p.cut("a▁b c") == ["a▁b c"]
        for _ in range(150):
            text = "".join(dice.choice("abc▁") for _ in range(dice.randint(1, 14)))
            want = plain_merge(text, p.ids, scores)
            got = [texts[i] for part in p.cut(text) for i in p.encode_part(part)]
            assert got == want, (seed, text)
            given_up += got[0] != max((t for i, t in texts.items() if text.startswith(t) and (len(t) == 1 or i in p.parts)), key=len)
    assert given_up > 50 and uncut > 0


def test_unknown_characters_are_bytes():
    p = piece_bpe.Pieces({0: "a", 1: "b", 2: "ab"}, {0: 0.0, 1: 0.0, 2: -1.0}, {b: 1000 + b for b in range(256)}, 999)
    assert p.encode_part("abéab") == [2, 1000 + 0xC3, 1000 + 0xA9, 2] and p.decode_part([2, 1000 + 0xC3, 1000 + 0xA9, 2]) == "abéab"
    assert p.decode([1000 + 0xFF, 0]) == "�a"


def test_other_models_are_refused(tmp_path):
    class Fake:
        def __init__(self, model_file):
            pass

        def normalize(self, t):
            return t.strip()

    real, sentencepiece.SentencePieceProcessor = sentencepiece.SentencePieceProcessor, Fake
    try:
        with pytest.raises(ValueError, match="normaliser"):
            piece_bpe.Pieces.load("some.model")
    finally:
        sentencepiece.SentencePieceProcessor = real


def test_piece_columns(spark, library, pieces):
    texts = [None, "", "Hello  world\n", "日本 🙂", "a" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    shared = piece_bpe.SharedPieces(spark, MODEL)
    got = {r.doc_id: r for r in df.select("doc_id", piece_bpe.encode_column(F.col("text"), shared).alias("ids")).withColumn("back", piece_bpe.decode_column(F.col("ids"), shared)).collect()}
    for i, t in enumerate(texts):
        assert (got[i].ids, got[i].back) == ((None, None) if t is None else (library.encode(t, add_eos=True), t))


def test_pieces_of_all_documents(spark, library):
    want = set()
    for i, t in duckdb.connect().sql(f"SELECT doc_id, coalesce(text, '') FROM '{DIR}/documents.parquet'").fetchall():
        ids = library.encode(t, add_eos=True)
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_piece_bpe(spark, DIR).collect()} == want


# -- whitening --


def plain_whitening(x, k=4):
    """(n, deviations, eigenvalues, whitened up to signs) from the covariance matrix."""
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    c = u - sums / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(axis=1), e, (x - sums / n) @ v[:, :k] / np.sqrt(e[:k])


def check_whitening(got, ids, x, k=4):
    n, deviation, e, whitened = plain_whitening(x, k)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    signs = np.sign(sum(np.array([by[i][c + 1].whitened for c in range(k)]) * w for i, w in zip(ids, whitened)))
    for i, d, w in zip(ids, deviation, whitened):
        assert sorted(by[i]) == list(range(1, k + 1))
        for c in range(k):
            r = by[i][c + 1]
            assert (r.n, r.deviation) == (n, d) and abs(r.whitened * signs[c] - w[c]) < 1e-9
            assert abs(r.explained - e[c] / e.sum()) < 1e-9 and r.identity_error < 1e-9


def test_merging_loses_nothing():
    dice = np.random.default_rng(4)
    x = np.floor(dice.normal(size=(500, 12)) * dice.uniform(1, 300, 12) + 1e6).astype(np.int64)
    cuts = [0, 1, 2, 9, 200, 201, 350, 500]
    state = whitening.merged_all([whitening.decomposed(x[a:b]) for a, b in zip(cuts, cuts[1:])])
    whole = whitening.decomposed(x)
    assert state.n == 500 and state.sums == whole.sums == x.sum(axis=0).tolist() and len(state.singular) == 12
    assert np.allclose(state.singular, whole.singular, rtol=1e-10)
    assert np.allclose(np.abs(np.sum(state.vectors * whole.vectors, axis=1)), 1, atol=1e-9)


def test_large_numbers_are_exact():
    x = np.array([[2**62, -(2**62)], [2**62, 5], [2**62, 7]], np.int64)
    assert whitening.exact_sums(x) == [3 * 2**62, -(2**62) + 12]
    assert whitening.deviations(x, 3, [3 * 2**62, 6]) == [None, 81, 225]
    assert whitening.deviations(np.array([[10**9]], np.int64), 3, [0]) == [9 * 10**18] and whitening.deviations(np.array([[2 * 10**9]], np.int64), 3, [0]) == [None]


def test_whitening_of_all_embeddings(spark):
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.floor(256 * np.array([r.embedding for r in rows], float)).astype(np.int64)
    check_whitening(queries.op13_whitening(spark, DIR).collect(), [r.vec_id for r in rows], x)


def test_whitening_over_many_partitions_with_hot_copies(spark):
    """A vector that a third of all rows hold counts once; more states than one merge takes."""
    dice = np.random.default_rng(6)
    vectors = np.round(dice.normal(size=(600, 6)) * [9, 5, 3, 2, 1, 1], 3)
    vectors[::3] = vectors[0]
    df = spark.createDataFrame([(2**53 + i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    rows = whitening.whole_numbers(df)
    fit = whitening.stage(rows.select("x").distinct().repartition(40), "test-fit")
    model = whitening.fit_whitening(fit.repartition(40))
    x = np.floor(256 * vectors).astype(np.int64)
    check_whitening(whitening.whiten(rows, model).collect(), [2**53 + i for i in range(600)], x)
    check_whitening(whitening.whiten_embeddings(df).collect(), [2**53 + i for i in range(600)], x)


NAN, INF = float("nan"), float("inf")


def test_whitening_of_strange_rows(spark):
    dice = np.random.default_rng(7)
    sound = [(i, v.tolist()) for i, v in enumerate(dice.normal(size=(30, 5)))]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [NAN, 1.0, 1.0, 1.0, 1.0]), (103, [1.0, INF, 1.0, 1.0, 1.0]), (104, [1.0, -INF, 1.0, 1.0, 1.0]), (None, None)]
    short = [(None, []), (2**63 - 1, [0.5]), (2**53 + 1, [0.5, 0.0]), (2**53 + 1, [-0.001, -0.0])]
    df = spark.createDataFrame(sound + bad + short, "vec_id long, embedding array<double>").coalesce(1).withColumns({c: F.lit("own") for c in ("x", "n", "component", "part", "label")})
    got = whitening.whiten_embeddings(df).collect()
    assert Counter(r.vec_id for r in got) == Counter({**{i: 4 for i in range(30)}, None: 4, 2**63 - 1: 4, 2**53 + 1: 8})
    x = np.array([np.floor(256 * np.array(v + [0.0] * (5 - len(v)))) for _, v in sound + short], np.int64)
    n, deviation, _, _ = plain_whitening(x)
    assert {r.n for r in got} == {n} and Counter(r.deviation for r in got) == Counter(d for d in deviation.tolist() for _ in range(4))


def test_components_without_variance_are_left_out(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten_embeddings(make([])).collect() == [] and whitening.whiten_embeddings(make([(1, None), (2, [])])).collect() == []
    assert whitening.whiten_embeddings(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = whitening.whiten_embeddings(make([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)
    huge = whitening.whiten_embeddings(make([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.0])])).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and all(r.deviation is None for r in huge if r.vec_id < 3)
