"""Every operator and every stage with nulls, empty and very long texts, ties, repeated rows, empty tables, and
columns whose names clash with those used inside."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from driftvault.llm import exact_dedup, language_id, line_dedup, packing, prefix_bpe, quality_rules, sharding, simhash_dedup, toxicity, warc_revisits

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
CLASHING = (
    "a.b", "with space", "back`tick", "_dv_id", "_dv_digest", "_dv_words", "_dv_m", "_id", "_no_id", "_digest", "_text", "_m", "_words", "_lines", "_raw", "n", "row", "key",
    "digest", "bucket", "fp", "shard", "held_out", "score", "toxic", "item", "length", "segment", "window", "count",
)
GOOD = "The city of the north was built in an age of iron, and it is still the place that people go to for work and for trade with others."
ROWS = [
    (1, GOOD, "en"), (2, GOOD, "en"), (2, GOOD, "en"), (None, GOOD, None), (None, None, None), (3, None, "en"), (4, "", "de"), (5, " \n\t ", None),
    (6, " ".join(f"{GOOD} Item {i} of the list." for i in range(1500)), "en"), (7, GOOD + " More of it is at the end of the road.", "xx"), (8, "x\n" * 30, "en"), (2**63 - 1, "das ist ein Satz", "de"),
    (2**53 + 1, "one of the ids that doubles cannot tell", "en"), (2**53 + 3, "another of the ids that doubles cannot tell", None), (-(2**53) - 1, "and one below zero", "fr"),
]


def table(spark, rows):
    """All rows in one partition, so that nulls stand beside identifiers that doubles cannot tell."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def labels(spark, rows=((1, 1, 0), (2, 1, 1), (2, 1, 0), (None, 0, 1), (7, None, None), (99, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "language": lambda spark, df: language_id.identify(df, F.col("doc_id") % 5 == 0),
    "exact": lambda spark, df: exact_dedup.dedup_exact(df),
    "shards": lambda spark, df: sharding.shard_documents(df),
    "near": lambda spark, df: simhash_dedup.dedup_near(df),
    "bpe": lambda spark, df: df.select("doc_id", prefix_bpe.digest_column(F.col("text"), prefix_bpe.SharedVocabulary(spark, RANKS), public_tokenizers.PATTERN).alias("d")),
    "lines": lambda spark, df: line_dedup.dedup_lines(df),
    "quality": lambda spark, df: quality_rules.score_quality(df),
    "packing": lambda spark, df: packing.pack(df, JSON).filter("piece = 0"),
    "toxicity": lambda spark, df: toxicity.score_toxicity(df, labels(spark)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_give_a_row_for_each_row(spark, name):
    got = OPERATORS[name](spark, table(spark, ROWS)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in ROWS)
    assert OPERATORS[name](spark, table(spark, [])).collect() == []


def test_archives_with_clashing_names(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", t) for i, t, _ in ROWS], "page_id long, url string, html string").coalesce(1).withColumns({c: F.lit(1) for c in CLASHING})
    got = warc_revisits.read_archives(warc_revisits.write_archives(pages)).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, f"http://x/{i}") for i, _, _ in ROWS)


def test_revisits_of_large_identifiers_beside_a_null(spark):
    ids, body = [2**53 + 1, 2**53 + 3, 2**53 + 5, 2**53 + 7, None, 2**63 - 1, 2**63 - 3], "x" * 1200
    rows = [(i, f"http://x/{k}", body if k in (0, 2, 3) else "y" * 1500 if k > 3 else f"alone {i}") for k, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc_revisits.read_archives(warc_revisits.write_archives(pages)).collect()}
    assert got == {
        2**53 + 1: ("revisit", 2**53 + 7, 1200), 2**53 + 3: ("response", None, len(f"alone {2**53 + 3}")), 2**53 + 5: ("revisit", 2**53 + 7, 1200), 2**53 + 7: ("response", None, 1200),
        None: ("revisit", 2**63 - 1, 1500), 2**63 - 1: ("response", None, 1500), 2**63 - 3: ("revisit", 2**63 - 1, 1500),
    }


def test_a_revisit_without_its_response_is_an_error(spark):
    """Of archives read one at a time only the one that holds the response can be."""
    pages = spark.createDataFrame([(i, None, "z" * 2000) for i in range(1, 41)], "page_id long, url string, html string")
    archives, read = warc_revisits.write_archives(pages).collect(), []
    for row in archives:
        try:
            read.append({r.page_id for r in warc_revisits.read_archives(spark.createDataFrame([row])).collect()})
        except Exception as e:  # noqa: BLE001 - Spark's own class
            assert "in no archive" in str(e)
    assert len(archives) > 1 and len(read) == 1 and 40 in read[0]


KEPT = {  # doc_ids that each filtering stage keeps of ROWS
    "quality rules": [1, 2, 2, None, 7],
    "toxicity": None,
    "exact dedup": [1, 3, 5, 6, 7, 8, 2**63 - 1, 2**53 + 1, 2**53 + 3, -(2**53) - 1],
    "near dedup": None,
}


def write_labels(spark, folder, rows=((1, 1, 0),)):
    labels(spark, rows).coalesce(1).write.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("name", KEPT)
def test_stages_keep_columns_and_values(spark, tmp_path, name):
    write_labels(spark, f"file://{tmp_path}")
    stage, df = dict(corpus_pipeline.STAGES)[name], table(spark, ROWS)
    got = stage(spark, df, f"file://{tmp_path}")
    assert got.columns == df.columns
    rows = got.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHING)
    if KEPT[name] is not None:
        assert Counter(r.doc_id for r in rows) == Counter(KEPT[name])
    empty = stage(spark, table(spark, []), f"file://{tmp_path}")
    assert empty.columns == df.columns and empty.collect() == []


def test_packing_stage_of_an_empty_table(spark, tmp_path):
    assert dict(corpus_pipeline.STAGES)["packing"](spark, table(spark, []), f"file://{tmp_path}").collect() == []


def test_languages_outside_the_list_are_not_judged_by_its_words(spark):
    words = " ".join(f"zalo{i} merun{i}" for i in range(40))
    df = spark.createDataFrame([(1, words, "xx"), (2, words, "en"), (3, words, None)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality_rules.score_quality(df).filter("kept").collect()} == {1}
    assert {r.doc_id for r in quality_rules.score_quality(df.drop("lang")).filter("kept").collect()} == set()
