import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from driftvault.llm import language_id

SCHEMA = "doc_id long, text string, lang string"


class PlainModel:
    """Interpolated Kneser-Ney over dictionaries, after its definition: the n-gram's discounted count in its context,
    plus what the discount has freed times the probability with the context one character shorter."""

    def __init__(self, words, alphabet, order):
        self.order, self.alphabet, grams = order, alphabet, Counter()
        for word in words:
            padded = f"\x02{word}\x03"
            for i in range(1, len(padded)):
                for k in range(1, min(order, i + 1) + 1):
                    grams[padded[i - k + 1 : i + 1]] += 1
        before = defaultdict(set)
        for g in grams:
            before[g[1:]].add(g[0])
        self.used = {g: n if len(g) == order or g[0] == "\x02" else len(before[g]) for g, n in grams.items()}
        self.used = {g: n for g, n in self.used.items() if n}
        self.discount = {}
        for k in range(1, order + 1):
            once, twice = (sum(1 for g, n in self.used.items() if len(g) == k and n == c) for c in (1, 2))
            self.discount[k] = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
        self.followers = defaultdict(list)
        for g, n in self.used.items():
            self.followers[g[:-1]].append(n)

    def probability(self, gram):
        if not gram:
            return 1 / self.alphabet
        shorter = self.probability(gram[1:])
        counts = self.followers.get(gram[:-1])
        if not counts:
            return shorter
        d, total = self.discount[len(gram)], sum(counts)
        return max(self.used.get(gram, 0) - d, 0) / total + d * len(counts) / total * shorter


def random_rows(seed, n=70):
    rng = random.Random(seed)
    letters = {"x": "abcdeé", "y": "cdefgß", "z": "ab漢字"}
    return [(i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 9))) for _ in range(12)), lang) for i in range(n) for lang in [rng.choice("xxxyyz")]]


@pytest.mark.parametrize(("seed", "order"), [(3, 5), (4, 3), (5, 1)])
def test_window_scores_against_brute_force(spark, seed, order):
    rows = random_rows(seed)
    counts = language_id.gram_counts(language_id.word_counts(spark.createDataFrame(rows, SCHEMA)), order)
    models = language_id.train(counts, order)
    asked = ["abc", "ccc", "defgabc", "zq", "é", "漢字", "b" * 20, "ab字"] + [w for _, t, _ in rows[:5] for w in t.split()]
    windows = {w: [f"\x02{w}\x03"[max(0, i - order) : i] for i in range(2, len(w) + 3)] for w in asked}
    every = spark.createDataFrame([(x, 1) for x in {x for xs in windows.values() for x in xs}], "window string, n long")
    scores = {r.window: r.scores for r in language_id.window_scores(every, models).collect()}
    assert len(scores) == every.count() and list(models.weight_of_empty) == ["x", "y", "z"]
    alphabet = len({c for _, t, _ in rows for c in t if c != " "}) + 2  # the end of a word, and what was never seen
    for j, lang in enumerate("xyz"):
        plain = PlainModel([w for _, t, of in rows if of == lang for w in t.split()], alphabet, order)
        for window, s in scores.items():
            assert abs(s[j] / language_id.SCALE - math.log(plain.probability(window))) < 1e-6, (window, lang)
        for context in ("\x02", "\x02a", "ab", "cd", "字"):  # all characters' probabilities after a context make one
            known = {c for _, t, _ in rows for c in t if c != " "} | {"\x03"}
            total = sum(plain.probability((context + c)[-order:]) for c in known)
            assert abs(total + plain.probability((context + "\x00")[-order:]) - 1) < 1e-9


def test_models_are_sorted_hash_arrays(spark):
    counts = language_id.gram_counts(language_id.word_counts(spark.createDataFrame(random_rows(6), SCHEMA)))
    models = language_id.train(counts)
    arrays = models.arrays.collect()
    assert all(list(r.hashes) == sorted(r.hashes) and len(r.hashes) == len(r["values"]) for r in arrays)
    used = sum(len(r.hashes) for r in arrays if r.kind == "gram")
    assert 0 < used <= counts.count() and {r.segment for r in arrays} <= set(range(models.segments))


def test_joined_windows_give_the_same_as_windows_sent_to_the_workers(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["haus", "wasser", "the", "house", "et", "eau"]) for _ in range(9)), rng.choice(["de", "en"])) for i in range(40)] + [(1, "haus", None), (None, "zzz", "en"), (50, None, "de"), (51, "...", "en")]
    docs = spark.createDataFrame(rows, SCHEMA)
    by = lambda hot: sorted(language_id.identify(docs, F.col("doc_id") % 4 == 0, hot_windows=hot).collect(), key=str)
    assert by(2) == by(100_000) == by(0) and len(by(2)) == len(rows)


def test_identification_against_brute_force(spark):
    """The language and its probability, from the plain models' cross-entropies of whole texts."""
    rows = random_rows(7, 90)
    held = lambda i: i % 3 == 0
    alphabet = len({c for i, t, _ in rows if not held(i) for c in t if c != " "}) + 2
    plain = {lang: PlainModel([w for i, t, of in rows if of == lang and not held(i) for w in t.split()], alphabet, 5) for lang in "xyz"}
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") % 3 == 0).collect()}
    for i, text, _ in rows:
        entropy, chars = {}, sum(len(w) + 1 for w in text.split())
        for lang, model in plain.items():
            padded = [f"\x02{w}\x03" for w in text.split()]
            entropy[lang] = -sum(math.log(model.probability(p[max(0, j - 4) : j + 1])) for p in padded for j in range(1, len(p))) / chars
        best = min(entropy, key=entropy.get)
        share = 1 / sum(math.exp((entropy[best] - e) * min(chars, 50)) for e in entropy.values())
        assert got[i].lang_pred == best and abs(got[i].score - share) < 1e-5 and abs(got[i].cross_entropy - entropy[best] / math.log(2)) < 1e-6


def test_rejection_bounds_against_ranks(spark):
    """A language with many texts left out has the bound of its own ranks, others that of all texts' ratios."""
    rng = random.Random(11)
    rows = [(False, k % 3 == 0, lang, lang, rng.gauss(mean, 0.2)) for lang, n, mean in (("x", 3000, 2.0), ("y", 90, 3.0)) for k in range(n)]
    rows += [(True, True, "x", "x", 90.0), (False, True, "x", "y", 90.0), (False, True, None, "x", 90.0), (False, True, "z", "z", 90.0), (False, True, "x", "und", None)]
    frame = lambda rows: spark.createDataFrame(rows, "held_out boolean, left_out boolean, lang string, lang_pred string, cross_entropy double")
    learnt = {lang: [e for _, out, of, _, e in rows[:3090] if of == lang and not out] for lang in "xy"}
    mean = {lang: sum(v) / len(v) for lang, v in learnt.items()}
    left = [(of, e) for _, out, of, _, e in rows[:3090] if out]
    own, ratios = sorted(e for of, e in left if of == "x"), sorted(e / mean[of] for of, e in left)
    rank = lambda n: math.ceil((n + 1) * 0.995) - 1
    got = language_id.rejection_bounds(frame(rows))
    assert got.keys() == {"x", "y"} and abs(got["x"] - own[rank(len(own))]) < 1e-9 and abs(got["y"] - mean["y"] * ratios[rank(len(ratios))]) < 1e-9
    few = [r for r in rows[3000:3090]]
    assert abs(language_id.rejection_bounds(frame(few))["y"] - max(e for _, out, _, _, e in few if out)) < 1e-9
    assert language_id.rejection_bounds(frame([r for r in few if not r[1]])) == {"y": math.inf} and language_id.rejection_bounds(frame([])) == {}


def test_rejected_share_of_unseen_texts(spark):
    """Of unseen texts about as many are rejected as aimed at; of texts in no known language, all."""
    rng = random.Random(12)
    vocabulary = {lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(3000)] for lang, letters in (("x", "abcdefgh"), ("y", "fghijklm"), ("other", "nopqrstu"))}
    text = lambda lang: " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randrange(20, 60)))
    rows = [(i, text(lang), lang) for i in range(6000) for lang in [rng.choice("xxy")]] + [(i, text("other"), None) for i in range(6000, 6050)]
    got = language_id.identify(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") % 2 == 0).collect()
    unseen = [r for r in got if r.held_out and r.doc_id < 6000]
    assert len(unseen) == 3000 and sum(r.rejected for r in unseen) / 3000 < 0.015
    assert all(r.rejected for r in got if r.doc_id >= 6000)


def test_rare_languages_are_found(spark):
    """Of 400 texts, ten are in a third language with words of its own: all of it is learnt and told."""
    rng = random.Random(9)
    letters = {"en": "abcdefg", "de": "hijklmn", "xx": "opqrstu"}
    rows = [(i, " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(15)), lang) for i, lang in enumerate(["en"] * 200 + ["de"] * 190 + ["xx"] * 10)]
    got = language_id.identify(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") % 5 == 0).collect()
    assert Counter(r.lang_pred for r in got) == {"en": 200, "de": 190, "xx": 10}


def test_rare_grams_count_in_large_corpora(spark):
    """Over 500,000 different n-grams, most of them seen once: nothing but these tells the two languages apart."""
    rng = random.Random(6)
    words = {lang: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(50_000)] for lang in "xy"}
    train = [(2 * i + j, " ".join(words[lang][i * 50 : i * 50 + 50]), lang) for i in range(1000) for j, lang in enumerate("xy")]
    held = [(10_000 + 2 * i + j, " ".join(words[lang][i * 500 : i * 500 + 20]), lang) for i in range(100) for j, lang in enumerate("xy")]
    got = language_id.identify(spark.createDataFrame(train + held, SCHEMA), F.col("doc_id") >= 10_000).filter("held_out").collect()
    want = {i: lang for i, _, lang in held}
    assert len(got) == 200 and all(r.lang_pred == want[r.doc_id] for r in got)
