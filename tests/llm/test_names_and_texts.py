"""Columns that clash with every name the operators use inside; whole texts as dimensions, ids and items."""

import random
import re

import pytest
from pyspark.sql import functions as F

from landfall.llm import decontaminate, exact, paragraphs, quality, sharding, simhash, toxicity

INNER = sorted({
    "_part", "_rows", "_start", "_total", "_rank", "_place", "curve", "shard", "slot", "_digest", "copies", "_block", "_map", "_twice", "_points", "_sha", "_row",
    "_group", "_first", "_size", "_gone_id", "_gone_key", "_spans", "_at_id", "_at_key", "score", "text_key", "fingerprint", "component_id", "bits", "node", "root",
    "paragraph", "words", "item_id", "v", "n", "place", "part", "key", "at", "cluster_size", "removed", "leaf", "tree",
})


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(2)
    line = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    texts = [line(40) for _ in range(20)]
    texts += [texts[0], texts[0].replace(" ", "  "), "", None, line(10) + " the capital of france is paris and nothing else " + line(10)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in INNER])


def kept_whole(df, got):
    """The rows of ``got`` are rows of ``df``, all columns with them."""
    names = [f"`{c}`" for c in df.columns]
    assert got.select(*names).exceptAll(df.select(*names)).isEmpty()
    assert all(c in got.columns for c in df.columns)


def test_no_column_is_lost(spark, clashing):
    placed = sharding.shard(clashing, ["source", "doc_id"], ["doc_id"], 4)
    kept_whole(clashing, placed)
    assert placed.count() == clashing.count()
    marked, _ = exact.mark_copies(clashing, "doc_id", "text")
    kept_whole(clashing, marked)
    assert marked.count() == clashing.count()
    kept_whole(clashing, exact.drop_copies(clashing))
    kept_whole(clashing, simhash.drop_near_copies(clashing))
    items = spark.createDataFrame([("x", "the capital of france is paris and nothing else")], "item_id string, text string")
    clean = decontaminate.clean_documents(clashing, items)
    kept_whole(clashing, clean)
    assert clean.count() == clashing.count() - 1
    shorter = paragraphs.without_repeats(clashing)
    assert shorter.columns == clashing.columns and shorter.count() == clashing.count()
    kept_whole(clashing.drop("text"), shorter.drop("text"))
    labels = clashing.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    scored, name = quality.with_quality(clashing, quality.learn_quality(clashing, labels))
    kept_whole(clashing, scored.drop(name))
    scored, name = toxicity.with_toxicity(clashing, toxicity.learn_toxicity(clashing, labels))
    kept_whole(clashing, scored.drop(name))


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_texts_with_one_beginning_are_told_apart(spark, kind):
    df = spark.range(4000).select(
        F.concat(F.lit("https://site"), F.lpad((F.col("id") % 20).cast("string"), 2, "0"), F.lit(".org")).cast(kind).alias("source"), "id"
    )
    assert len(sharding.text_bounds(df, "source", 16)) == 15
    curve = df.select("source", sharding.curve_order(df, ["source"]).alias("c")).distinct().collect()
    assert len({r.c for r in curve}) == 16
    assert [r.c for r in sorted(curve, key=lambda r: bytes(r.source) if kind == "binary" else r.source)] == sorted(r.c for r in curve)


def test_text_levels_are_quantiles(spark):
    rng = random.Random(1)
    values = [rng.choice(["a", "b", "b", "c" * 40, "c" * 40 + "d", "é", ""]) for _ in range(3000)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "s string").repartition(7)
    ordered = sorted((v for v in values if v is not None), key=lambda v: v.encode())
    wanted = [ordered[int(len(ordered) * k / 8)] for k in range(1, 8)]
    assert sharding.text_bounds(df, "s", 8) == wanted
    assert sharding.text_bounds(df.limit(0), "s", 8) == []


def test_short_items_and_text_ids(spark):
    docs = [(1, "the quick brown fox"), (2, "a quick, brown fox"), (3, "quick and brown"), (4, "我们在这里学习机器翻译的方法"), (5, "他们在那里"), (6, None), (7, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = [("one", "Fox"), ("two", "quick brown"), ("clause", "学习机器翻译"), ("none", ""), ("blank", " . "), (None, "quick brown"), ("null", None)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = {(r.doc_id, r.item_id, r.score) for r in decontaminate.leaks(df, benchmark).collect()}
    assert found == {(1, "one", 1.0), (2, "one", 1.0), (1, "two", 1.0), (2, "two", 1.0), (4, "clause", 1.0)}
    clean = {r.doc_id for r in decontaminate.clean_documents(df, benchmark).collect()}
    assert clean == {1, 2, 3, 5, 6, 7}


def test_blocks_leave_no_broadcast(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "one two three four five")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "two three four five")], "item_id int, text string")
    got = decontaminate.leaks(df, benchmark, block_words=4)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 1), (2, 2)}
    assert not re.search("MapInArrow", got._jdf.queryExecution().toString())


@pytest.mark.parametrize("seed", range(6))
def test_windows_of_a_long_document_miss_no_passage(seed):
    """Windows of any length give the starts that the whole document at once gives."""
    rng = random.Random(seed)
    items = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([1, 3, 8, 25])))) for i in range(12)]
    index = decontaminate.Index(items, 0.6)
    frequency = {g: rng.randrange(50) for g in range(len(index.grams))}
    seeds = index.seeds(frequency)
    text = " ".join(rng.choice([f"w{rng.randrange(80)}", rng.choice(items)[1]]) for _ in range(300))
    for document in (text, "", "w1", items[3][1]):
        words = index.numbers(document)
        whole = {k: sorted(set(v)) for k, v in index.passages(words, seeds, window=10**9).items()}
        for window in (1, 90, 200):
            assert {k: sorted(set(v)) for k, v in index.passages(words, seeds, window=window).items()} == whole
    assert index.passages(index.numbers(text), seeds)
    assert decontaminate.Index([], 0.6).passages(index.numbers(text)[:0], decontaminate.Index([], 0.6).seeds({})) == {}
