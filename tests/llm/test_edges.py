"""Every operator and stage on empty tables, nulls, ties, repeated rows, clashing names and long texts."""

import random

import pytest
from pyspark.sql import functions as F

from boxloom.llm.chat import render_perspectives
from boxloom.llm.decontaminate import contained_items
from boxloom.llm.langid import identify_language
from boxloom.llm.line_quality import score_quality
from boxloom.llm.minhash import near_duplicates
from boxloom.llm.page_text import extract_main_text
from boxloom.llm.pieces import decode_pieces, encode_pieces
from boxloom.llm.quality_rules import apply_rules
from boxloom.llm.sharding import uniform_shards
from boxloom.llm.suffix_dedup import cut_repeats, remove_repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _learn(spark):
    return spark.createDataFrame([("the cat and the dog", "en", 1), ("le chat et le chien", "fr", 0)], "text string, lang string, quality int")


def _items(spark):
    return spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, "")], "item_id long, text string")


#: operator -> (function of documents, the names of its results)
OPERATORS = {
    "shards": (lambda s, d: uniform_shards(d, 4), ["shard", "slot"]),
    "rules": (lambda s, d: apply_rules(d), ["n_words", "base_failed", "failed_rules", "kept"]),
    "pages": (lambda s, d: extract_main_text(d.withColumnRenamed("text", "html")), ["text", "n_chars"]),
    "languages": (lambda s, d: identify_language(d, _learn(s)), ["lang_pred", "score", "rejected"]),
    "items": (lambda s, d: contained_items(d, _items(s)), ["contained"]),
    "item blocks": (lambda s, d: contained_items(d, _items(s), block_bytes=100), ["contained"]),
    "pieces": (lambda s, d: encode_pieces(d), ["ids", "n_ids", "decoded_same"]),
    "quality": (lambda s, d: score_quality(d, _learn(s)), ["score", "predicted"]),
    "near duplicates": (lambda s, d: near_duplicates(d), ["n_shingles", "component_id", "kept", "chosen"]),
    "repeats": (lambda s, d: remove_repeats(d, words=51), ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "rest"]),
    "cut": (lambda s, d: cut_repeats(d, words=51), ["was_cut"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    run, names = OPERATORS[name]
    out = run(spark, spark.createDataFrame([], DOCS))
    assert out.count() == 0 and set(names) <= set(out.columns)


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_nulls_and_repeated_rows(spark, name):
    """Names that operators use inside, and their results' names in other cases."""
    run, names = OPERATORS[name]
    inside = ["_x", "x", "row", "key", "body", "g", "_in", "_t", "_ws", "_cut", "_contained_0", "no", "id", "n", "set_key", "bands", "k", "part", "place", "_boxloom_row", "a.b", "rest ", "html"]
    rows = [(1, "some words of a text"), (1, "some words of a text"), (2, None), (3, ""), (None, "some words of a text"), (4, "x " * 3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    skip = {"html"} if name == "pages" else set()
    for k, c in enumerate([*inside, *(n.upper() for n in names)]):
        if c not in skip and c.lower() != "text":
            table = table.withColumn(c, F.lit(f"own{k}"))
    out = run(spark, table)
    assert len({c.lower() for c in out.columns}) == len(out.columns) and set(names) <= set(out.columns)
    got = out.collect()
    assert len(got) == len(rows)
    at = {c: i for i, c in enumerate(out.columns)}
    for k, c in enumerate(inside):
        if c in at and c not in skip and c not in names:
            assert {r[at[c]] for r in got} == {f"own{k}"}, c
    twins = [tuple(r[at[n]] for n in names if n not in ("shard", "slot", "chosen")) for r in got if r[at["doc_id"]] == 1]
    assert twins[0] == twins[1]


def test_language_ties_and_short_texts(spark):
    """Equal dictionaries: more rows win, then the lesser name; texts of a few letters can be learned from."""
    learn = spark.createDataFrame([("abc", "zz"), ("abc", "yy"), ("abc", "aa"), ("abd", "yy"), ("abd", "zz"), (None, "zz"), ("12", "aa")], "text string, lang string")
    got = identify_language(spark.createDataFrame([(1, "qqq")], "doc_id long, text string"), learn).first()
    assert got.lang_pred == "yy" and got.rejected


def test_long_texts(spark):
    """A text of 5 MB and one without a space, whole."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(900_000))
    table = spark.createDataFrame([(1, long + " one two three four five six"), (2, "z" * 300_000), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in encode_pieces(table).select("doc_id", "n_ids", "decoded_same").collect()}
    assert all(r.decoded_same for r in got.values()) and got[1].n_ids > 900_000
    found = contained_items(table, _items(spark)).select("doc_id", F.size("contained").alias("n")).collect()
    assert {r.doc_id: r.n for r in found} == {1: 1, 2: 0, 3: 0}
    rules = {r.doc_id: r.n_words for r in apply_rules(table).collect()}
    assert rules == {1: 900_006, 2: 1, 3: 1}
    left = {r.doc_id: r for r in remove_repeats(table, words=51).select("doc_id", "n_bytes", "n_removed").collect()}
    assert left[2].n_removed == 300_000 and left[1].n_bytes == len(long) + 28
    assert {r.lang_pred for r in identify_language(table, _learn(spark)).collect()} <= {"en", "fr"}
    assert all(0 <= r.score <= 1 for r in score_quality(table, _learn(spark)).collect())
    sizes = {r.doc_id: r.n_shingles for r in near_duplicates(table).collect()}
    assert sizes[1] > 800_000 and sizes[2] == 1
    pages = table.select("doc_id", F.concat(F.lit("<body><p>"), "text").alias("html"))
    assert {r.doc_id: r.n_chars for r in extract_main_text(pages).collect()} == {1: len(long) + 28, 2: 300_000, 3: 5}


def test_long_texts_of_sharding_chat_and_cutting(spark):
    """Texts of 5 MB dealt out whole, rendered in a dialogue, and cut where they repeat."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
    long, other = (" ".join(rng.choice(words) for _ in range(900_000)) for _ in range(2))
    passage = " ".join(f"unique{k}" for k in range(60))
    table = spark.createDataFrame([(1, f"{long} {passage}"), (2, f"{passage} {other}"), (3, "short")], "doc_id long, text string")
    dealt = uniform_shards(table, 2, seed=1).select("doc_id", "shard", F.length("text").alias("n")).collect()
    assert {r.doc_id: r.n for r in dealt} == {1: len(long) + 1 + len(passage), 2: len(other) + 1 + len(passage), 3: 5}
    cut = {r.doc_id: r for r in cut_repeats(table, words=51).select("doc_id", "was_cut", F.length("text").alias("n")).collect()}
    assert cut[1].was_cut and cut[2].was_cut and not cut[3].was_cut
    assert abs(cut[1].n - len(long)) <= 1 and abs(cut[2].n - len(other)) <= 1
    turns = table.select(F.lit(1).alias("conv_id"), F.col("doc_id").alias("turn"), F.concat(F.lit("s"), F.col("doc_id") % 2).alias("role"), "text")
    out = render_perspectives(turns).select("perspective", "turn", "start", F.length("segment").alias("n"), "mask_end").collect()
    for p in ("s0", "s1"):
        own = sorted((r for r in out if r.perspective == p), key=lambda r: r.turn)
        assert [r.start for r in own] == [0, own[0].n, own[0].n + own[1].n] and own[0].n > 5_000_000
    clash = turns.withColumns({c: F.lit("own") for c in ("alone", "perspective", "segment", "chunk", "lead", "c", "d", "base", "START")})
    assert render_perspectives(clash).columns == render_perspectives(turns).columns


@pytest.mark.parametrize("k", range(5))
def test_stages_on_long_texts(spark, k, tmp_path):
    """Each stage on a text of 3 MB, which it keeps whole but for what is its work."""
    import corpus_pipeline

    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)] + ["the", "and", "of", "to", "that", "with"] * 60
    long = "\n".join(" ".join(rng.choice(words) for _ in range(12)).capitalize() + "." for _ in range(45_000))
    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    name, stage = corpus_pipeline.STAGES[k]
    table = spark.createDataFrame([(1, long, "en", "a", len(long)), (2, "the cat and the dog " * 30, "en", "a", 600)], DOCS)
    got = {r.doc_id: r for r in stage(spark, table, str(tmp_path)).collect()}
    if name == "piece ids":
        assert got[1].decoded_same and got[1].n_ids > 500_000
    else:
        assert got[1].text == long and got[1].n_chars == len(long)


def test_decoding_passes_other_columns(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").withColumn("DECODED", F.lit("old"))
    got = {r.doc_id: r.decoded for r in decode_pieces(encode_pieces(table)).collect()}
    assert got == {1: "a b", 2: None}


def test_chat_without_rows(spark):
    assert render_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages_on_edges(spark, k, tmp_path):
    """Each stage on no rows, and on nulls, empty texts, ties and repeated rows; other stages' flags are no columns of theirs."""
    import corpus_pipeline

    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    name, stage = corpus_pipeline.STAGES[k]
    assert stage(spark, spark.createDataFrame([], DOCS), str(tmp_path)).count() == 0
    good = "the cat sat on the mat and it was happy to be there with all of the other cats in town"
    rows = [(1, good, "en", "a", len(good)), (1, good, "en", "a", len(good)), (2, None, None, None, None), (3, "", "en", "a", 0), (4, good + " one two three four five six", "en", "a", 100)]
    table = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("own")).withColumn("Chosen", F.lit("own"))
    out = stage(spark, table, str(tmp_path))
    n = {"quality rules": 3, "near duplicates": 4, "repeated passages": 5, "benchmark items": 4, "piece ids": 5}[name]
    got = out.collect()
    assert len(got) == n
    if k < 4:
        assert out.columns == table.columns and {r.kept for r in got} == {"own"}
