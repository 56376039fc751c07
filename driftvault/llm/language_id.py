"""Language identification with interpolated Kneser-Ney models of characters.

Each language has a model of the characters of its words, with the word's start and end as characters of their own,
so a text's probability is the product of its words' and a word that comes again need not be scored again. All
n-grams of the training texts count: continuation counts, discounts and back-off weights are found by joins, and the
models are kept as sorted arrays of hashes with their values beside them, one pair of arrays for each language and
each segment of the hash space. The n-grams that the corpus asks for are looked up there by binary search, segment
by segment, and interpolated from the shortest to the longest. Texts then add up the scores of their windows, each
a character with those before it; these are whole numbers, so the order of the sums does not matter. The language
with the lowest cross-entropy per character is chosen. Above what a text is rejected is learnt from a part of the
known texts: models of the others give them cross-entropies like those of texts never seen.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import n_parts, stage

ORDER = 5
#: The scores of so many windows at most, the most frequent, are sent to the workers; those of all others are joined.
HOT_WINDOWS = 200_000
#: So many scores at most, one for each window and language, whatever the number of languages.
HOT_SCORES = 4_000_000
CACHED_WORDS = 200_000
#: Log-probabilities are kept as whole numbers of this part of a nat.
SCALE = 1 << 24
#: Words longer than this are scored and counted in chunks of so many letters.
CHUNK = 64
START, END = "\x02", "\x03"
UNKNOWN = "und"
#: Of texts in a known language, the share that may be rejected.
REJECTED_SHARE = 0.005
#: One in so many of the texts learnt from is left out of a second set of models, which the rejection's bounds come from.
LEFT_OUT = 5
#: A text's score rests on the evidence of so many characters at most: those of a longer text are not independent, and
#: would put every score at 0 or 1.
EVIDENCE_CHARS = 50
#: Entries of the models, and n-grams asked for, that a segment of the hash space holds on average.
SEGMENT_ROWS = 50_000


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(rf"\p{{L}}{{1,{CHUNK}}}"), F.lit(0))


def word_counts(texts: DataFrame, keys: tuple[str, ...] = ("lang",)) -> DataFrame:
    """(*keys, word, n) of texts (text, *keys), lower-cased; counted before the shuffle."""
    return texts.select(*keys, F.explode(split_words(F.col("text"))).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("n"))


def window_counts(words: DataFrame, order: int = ORDER, keys: tuple[str, ...] = ("lang",)) -> DataFrame:
    """(*keys, window, n): each character of the words between their start and end, with those before it, `order` at most."""
    word = F.col("padded")

    def window(i: Column) -> Column:
        return F.substring(word, F.greatest(i - order + 2, F.lit(1)), F.least(F.lit(order), i + 1))

    windows = F.transform(F.sequence(F.lit(0), F.length(word) - 1), window)
    padded = words.select(*keys, "n", F.concat(F.lit(START), "word", F.lit(END)).alias("padded"))
    return padded.select(*keys, "n", F.explode(windows).alias("window")).groupBy(*keys, "window").agg(F.sum("n").alias("n"))


def _suffix_counts(windows: DataFrame, keys: tuple[str, ...] = ("lang",)) -> DataFrame:
    """(*keys, gram, n) of all n-grams from window_counts: each place where one ends is a window that ends in it."""
    suffixes = F.transform(F.sequence(F.lit(1), F.length("window")), lambda k: F.substring("window", F.length("window") - k + 1, k))
    return windows.select(*keys, "n", F.explode(suffixes).alias("gram")).groupBy(*keys, "gram").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) for all n-grams of up to `order` characters of the words between their start and end."""
    return _suffix_counts(window_counts(words, order))


def _bounded(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the highest counts, at most so many: those from a count on that is found from the numbers of
    rows in narrow classes of counts, of which there are a few hundred for any input."""
    level = F.floor(F.log2("n") * 8)
    classes = sorted((tuple(r) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("grams")).collect()), reverse=True)
    least, total = None, 0
    for at, grams in classes:
        total += grams
        if total > most:
            break
        least = at
    return counts.filter(level >= F.lit(least)) if least is not None else counts.limit(0)


class Models(NamedTuple):
    """The languages' models: arrays has rows (segment, lang, kind, hashes, values), hashes sorted. Of kind `gram`, the
    discounted share of its context's count that each n-gram has; of kind `context`, each context's back-off weight."""

    weight_of_empty: dict[str, float]
    alphabet: int
    order: int
    segments: int
    arrays: DataFrame


def train(counts: DataFrame, order: int = ORDER, n_windows: int = 0) -> Models:
    """The models of gram_counts' n-grams, all of them. An entry is known by 64 bits of hash. n_windows: how many
    windows will be scored; the hash space is cut for as many."""
    k, grams = F.length("gram"), counts.filter(F.col("gram") != START)
    alphabet = grams.filter(k == 1).select("gram").distinct().count() + 1
    # n-grams from a word's start, and the longest, count as they are; the others by how many characters stand before them
    extended = grams.filter(k > 1).groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("kinds"))
    used = F.when((k == order) | F.col("gram").startswith(START), F.col("n")).otherwise(F.coalesce("kinds", F.lit(0)))
    grams = grams.join(extended, ["lang", "gram"], "left").select("lang", "gram", k.alias("k"), F.expr("substring(gram, 1, length(gram) - 1)").alias("context"), used.alias("used"))
    grams = stage(grams.filter("used > 0"), "gram-uses")
    once, twice = F.count_if(F.col("used") == 1), F.count_if(F.col("used") == 2)
    discount = F.when(once > 0, F.least(F.lit(0.95), F.greatest(F.lit(0.1), once / (once + 2 * twice)))).otherwise(0.5)
    discounts = F.broadcast(grams.groupBy("lang", "k").agg(discount.alias("discount")))  # a row for each language and length
    contexts = grams.groupBy("lang", "k", "context").agg(F.sum("used").alias("total"), F.count("*").alias("kinds")).join(discounts, ["lang", "k"])
    contexts = stage(contexts.select("lang", "context", "total", "discount", (F.col("discount") * F.col("kinds") / F.col("total")).alias("weight")), "contexts")
    shares = grams.join(contexts, ["lang", "context"]).select("lang", F.lit("gram").alias("kind"), "gram", ((F.col("used") - F.col("discount")) / F.col("total")).alias("value"))
    weights = contexts.filter("context <> ''").select("lang", F.lit("context").alias("kind"), F.col("context").alias("gram"), F.col("weight").alias("value"))
    # one row for each language
    empty = {r.lang: r.weight for r in contexts.filter("context = ''").select("lang", "weight").collect()}
    segments = max(n_parts(counts.sparkSession), max(2 * grams.count(), n_windows) // SEGMENT_ROWS)
    return Models(dict(sorted(empty.items())), alphabet, order, segments, _as_arrays(shares.unionByName(weights), segments))


def _hash(gram: Column) -> Column:
    return F.xxhash64(gram)


def _as_arrays(entries: DataFrame, segments: int) -> DataFrame:
    """entries (lang, kind, gram, value) as sorted arrays, by segment of the hash space."""
    rows = entries.select(F.pmod(_hash(F.col("gram")), F.lit(segments)).cast("int").alias("segment"), "lang", "kind", F.struct(_hash(F.col("gram")).alias("hash"), "value").alias("entry"))
    grouped = rows.groupBy("segment", "lang", "kind").agg(F.sort_array(F.collect_list("entry")).alias("e"))
    return stage(grouped.select("segment", "lang", "kind", F.col("e.hash").alias("hashes"), F.col("e.value").alias("values")), "models")


def _look_up(langs: list[str]):
    """For n-grams (segment, hash, gram): what each language has for it as an n-gram (null: never seen) and as a context."""

    def task(asked: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        keys = asked["hash"].to_numpy("int64")
        found = {kind: np.full((len(keys), len(langs)), nothing) for kind, nothing in (("gram", 0.0), ("context", 1.0))}
        for lang, kind, hashes, values in zip(arrays["lang"], arrays["kind"], arrays["hashes"], arrays["values"]):
            at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
            found[kind][:, langs.index(lang)] = np.where(hashes[at] == keys, values[at], found[kind][:, langs.index(lang)])
        return pd.DataFrame({"gram": asked["gram"], "shares": [*found["gram"]], "weights": [*found["context"]]})

    return task


def window_scores(windows: DataFrame, models: Models) -> DataFrame:
    """windows (window, n), each once, with `scores`: the log-probability of its last character in each language, in
    parts of SCALE.

    Every n-gram that a window ends with is looked up once. Its probability is its share plus its context's weight
    times the probability of the n-gram that is one character shorter: a join for each length, in which no key has
    more rows than there are characters. What was not seen adds nothing, and a context not seen leaves all as it is.
    """
    langs, gram, k = [*models.weight_of_empty], F.col("gram"), F.length("gram")
    ends = F.transform(F.sequence(F.lit(1), F.length("window")), lambda i: F.substring("window", F.length("window") - i + 1, i))
    every = windows.select(F.explode(ends).alias("gram"))
    # contexts that are no window's end are looked up as well
    contexts = every.filter(k > 1).select(F.expr("substring(gram, 1, length(gram) - 1)").alias("gram"))
    asked = every.unionByName(contexts).distinct().select(F.pmod(_hash(gram), F.lit(models.segments)).cast("int").alias("segment"), _hash(gram).alias("hash"), "gram")
    found = asked.groupBy("segment").cogroup(models.arrays.groupBy("segment")).applyInPandas(_look_up(langs), "gram string, shares array<double>, weights array<double>")
    table = stage(found, "found-grams")
    base = F.array(*[F.lit(w / models.alphabet) for w in models.weight_of_empty.values()])
    level = table.filter(k == 1).select("gram", F.zip_with("shares", base, lambda a, b: a + b).alias("p"))
    levels = [level]
    for length in range(2, models.order + 1):
        of = table.filter(k == length).select("gram", "shares", F.expr("substring(gram, 2)").alias("shorter"), F.expr("substring(gram, 1, length(gram) - 1)").alias("context"))
        lower = level.select(F.col("gram").alias("shorter"), F.col("p").alias("lower"))
        weights = table.filter(k == length - 1).select(F.col("gram").alias("context"), "weights")
        p = F.zip_with("shares", F.zip_with("weights", "lower", lambda w, x: w * x), lambda a, b: a + b)
        level = stage(of.join(lower, "shorter").join(weights, "context").select("gram", p.alias("p")), f"grams-{length}")
        levels.append(level)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    scores = F.transform("p", lambda x: F.round(F.log(x) * SCALE).cast("long"))
    return windows.join(every.withColumnRenamed("gram", "window"), "window").select("window", "n", scores.alias("scores"))


class _Words:
    """Words' sums of the scores of their hot windows, and their other windows. Words that come again are remembered."""

    def __init__(self, hot: dict[str, int], table: np.ndarray, order: int):
        self.hot, self.order = hot, order
        self.table = np.concatenate([table, np.zeros((1, table.shape[1]), np.int64)])
        self.clear()

    def clear(self) -> None:
        self.of: dict[str, int] = {}
        self.others: dict[int, list[str]] = {}
        self.sums = np.zeros((1024, self.table.shape[1]), np.int64)

    def learn(self, words: list[str]) -> None:
        first, size = len(self.of), len(self.of) + len(words)
        if size > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((size, self.sums.shape[1]), np.int64)])
        other, at, ids, starts = len(self.hot), self.hot.get, [], []
        for row, word in enumerate(words, first):
            padded = START + word + END
            windows = [padded[max(0, i - self.order) : i] for i in range(2, len(padded) + 1)]
            found = [at(w, other) for w in windows]
            if other in found:
                self.others[row] = [w for w, i in zip(windows, found) if i == other]
            starts.append(len(ids))
            ids += found
        self.sums[first:size] = np.add.reduceat(self.table[ids], starts)
        self.of.update(zip(words, range(first, size)))

    def measure(self, texts: list[str]) -> list[tuple]:
        """For each text, words with blanks between them: the sum of the hot windows' scores, the number of characters
        with the words' ends, and the other windows and how often they come."""
        split = [t.split(" ") if t else [] for t in texts]
        if len(self.of) > CACHED_WORDS:
            self.clear()
        new = [*{w: None for words in split for w in words if w not in self.of}]
        for at in range(0, len(new), 20_000):
            self.learn(new[at : at + 20_000])
        out = []
        for text, words in zip(texts, split):
            rows = [self.of[w] for w in words]
            rest = Counter(w for r in rows if r in self.others for w in self.others[r]) if self.others else {}
            out.append((self.sums[rows].sum(axis=0), len(text) + 1 if words else 0, [*rest], [*rest.values()]))
        return out


_WORDS: dict[str, _Words] = {}


def _measure_column(text: Column, hot: dict[str, int], table: np.ndarray, order: int, spark) -> Column:
    """Column of struct(known, chars, others, times), as _Words measures them."""
    shared = spark.sparkContext.broadcast((hot, table, order))
    token = uuid.uuid4().hex

    @F.pandas_udf("known array<long>, chars long, others array<string>, times array<long>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        if token not in _WORDS:
            _WORDS.clear()
            _WORDS[token] = _Words(*shared.value)
        out = []
        for at in range(0, len(texts), 128):
            out += _WORDS[token].measure(texts.iloc[at : at + 128].tolist())
        return pd.DataFrame(out, columns=["known", "chars", "others", "times"])

    return measure(F.array_join(split_words(text), " "))


def _score(rows: DataFrame, scores: DataFrame, n_langs: int, order: int, hot_windows: int) -> DataFrame:
    """rows (doc_id, held_out, left_out, lang, text) with `total`, the log-probability in each language, and `chars`, for text."""
    hot = _bounded(scores, min(hot_windows, HOT_SCORES // n_langs)).select("window", *[F.col("scores")[j].alias(f"s{j}") for j in range(n_langs)]).toArrow()
    at = {w: i for i, w in enumerate(hot["window"].to_pylist())}
    table = np.stack([hot[f"s{j}"].to_numpy() for j in range(n_langs)], axis=1).astype(np.int64)
    measured = rows.select("doc_id", "held_out", "left_out", "lang", _measure_column(F.col("text"), at, table, order, rows.sparkSession).alias("m"))
    measured = stage(measured.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "left_out", "lang", "m.*"), "measured")
    others = measured.select("row", F.explode(F.arrays_zip("others", "times")).alias("o")).select("row", F.col("o.others").alias("window"), "o.times")
    sums = others.join(scores, "window").groupBy("row").agg(F.array(*[F.sum(F.col("times") * F.col("scores")[j]) for j in range(n_langs)]).alias("rest"))
    total = F.when(F.col("rest").isNull(), F.col("known")).otherwise(F.zip_with("known", "rest", lambda a, b: a + b))
    return measured.join(sums, "row", "left").select("doc_id", "held_out", "left_out", "lang", "chars", total.alias("total"))


def _decided(scored: DataFrame, langs: list[str]) -> DataFrame:
    """doc_id, held_out, left_out, lang, lang_pred, score and cross_entropy (in bits a character) of _score's rows."""
    df = scored.withColumn("entropy", F.transform("total", lambda t: -t / (F.lit(float(SCALE)) * F.greatest("chars", F.lit(1)))))
    df = df.withColumn("low", F.array_min("entropy"))
    odds = F.aggregate("entropy", F.lit(0.0), lambda acc, e: acc + F.exp((F.col("low") - e) * F.least("chars", F.lit(EVIDENCE_CHARS))))
    known, best = F.col("chars") > 0, F.array_position("entropy", F.col("low")).cast("int")
    return df.select(
        "doc_id", "held_out", "left_out", "lang", F.when(known, F.element_at(F.array(*map(F.lit, langs)), best)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1 / odds).otherwise(0.0).alias("score"), F.when(known, F.col("low") / math.log(2)).alias("cross_entropy"),
    )


def left_out_of_models(doc_id: Column) -> Column:
    """Which documents the bounds of rejection are learnt from: one in LEFT_OUT by hash, independent of the hash modulo 5."""
    return F.floor(F.crc32(doc_id.cast("string")) / 5) % LEFT_OUT == 0


def rejection_bounds(scored: DataFrame) -> dict[str, float]:
    """By language, the cross-entropy above which a text is rejected, from _decided's rows of known and rightly told texts,
    those that are left out scored by models that have not learnt from them.

    Of n texts left out of the models and one more like them, each is as likely as any other to have a given rank, so
    the bound is the text of rank (n + 1) * (1 - REJECTED_SHARE), found as a quantile with one infinite value among
    them. A language with too few such texts to have that rank (199 are enough) has the bound of all languages' texts
    together, each measured against the mean of what its language has learnt from; where all together are too few, it
    is the highest of them, and where there are none, nothing is rejected.
    """
    right, share = scored.filter(~F.col("held_out") & (F.col("lang") == F.col("lang_pred"))), F.lit(1 - REJECTED_SHARE)
    # one row for each language
    means = right.filter(~F.col("left_out")).groupBy("lang_pred").agg(F.avg("cross_entropy").alias("mean"))
    known = right.filter("left_out").join(F.broadcast(means), "lang_pred").select("lang_pred", "cross_entropy", F.try_divide("cross_entropy", "mean").alias("ratio"))
    endless = F.lit(math.inf)
    own = known.select("lang_pred", "cross_entropy").unionByName(means.select("lang_pred", endless.alias("cross_entropy")))
    own = dict(own.groupBy("lang_pred").agg(F.percentile_approx("cross_entropy", share, 10_000)).collect())
    ratios = known.select("ratio").unionByName(scored.sparkSession.range(1).select(endless.alias("ratio")))
    common, highest = ratios.agg(F.percentile_approx("ratio", share, 10_000), F.max(F.when(F.col("ratio") < endless, F.col("ratio")))).first()
    common = common if math.isfinite(common) or highest is None else highest
    return {lang: own[lang] if math.isfinite(own[lang]) else common * mean for lang, mean in means.collect()}


def identify(docs: DataFrame, held_out: Column, order: int = ORDER, hot_windows: int = HOT_WINDOWS, left_out: Column | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    Models are learnt from the rows that are not held out and have text and lang; those for the rejection's bounds from
    those of them that are not left out either (by default left_out_of_models). A text that is null or has no letter is `und` with score 0, and so is every text where nothing can
    be learnt. Rows with a null doc_id count as neither held nor left out unless the conditions say so; repeated rows
    are scored each for itself and counted each time; very long texts count whole. An empty table gives an empty result;
    other columns are not looked at. `rejected` marks `und` and texts whose cross-entropy is above the predicted
    language's bound (rejection_bounds), so that about REJECTED_SHARE of unseen texts in a known language are rejected.
    hot_windows has no influence on the result: it bounds what the workers keep in memory.
    """
    left_out = left_out_of_models(F.col("doc_id")) if left_out is None else left_out
    folds = [F.coalesce(fold, F.lit(False)).alias(name) for fold, name in ((held_out, "held_out"), (left_out, "left_out"))]
    rows = docs.select("doc_id", "text", "lang", *folds)
    # words of texts that are not learnt from are counted under no language
    known, keys = F.when(~F.col("held_out"), F.col("lang")), ("lang", "left_out")
    words = word_counts(rows.select("text", known.alias("lang"), (known.isNotNull() & F.col("left_out")).alias("left_out")), keys)
    windows = stage(window_counts(words, order, keys), "windows")
    grams = stage(_suffix_counts(windows.filter("lang IS NOT NULL"), keys), "gram-counts")

    def score(texts: DataFrame, windows: DataFrame, counts: DataFrame, label: str) -> DataFrame | None:
        """texts as _decided gives them, by the models of these counts."""
        models = train(stage(counts, f"{label}-counts"), order, windows.count())
        langs = [*models.weight_of_empty]
        if not langs:
            return None
        every = windows.filter(F.col("window") != START).groupBy("window").agg(F.sum("n").alias("n"))
        scores = stage(window_scores(every, models), f"{label}-scores")
        return stage(_decided(_score(texts, scores, len(langs), order, hot_windows), langs), f"{label}-languages")

    scored = score(rows, windows, grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "all")
    if scored is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    unseen = score(rows.filter("left_out AND NOT held_out AND lang IS NOT NULL"), windows.filter("left_out"), grams.filter("NOT left_out").drop("left_out"), "learnt")
    bounds = rejection_bounds(scored.filter("NOT left_out") if unseen is None else scored.filter("NOT left_out").unionByName(unseen))
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("lang_pred")] if bounds else F.lit(None)
    return scored.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", F.coalesce(F.col("cross_entropy") > bound, F.lit(True)).alias("rejected"))
