"""The pipeline and the registered queries against brute force on small tables with planted cases."""

import collections
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from boxloom.llm.page_text import blocks, learn_weights, main_text
from boxloom.llm.pieces import VOCABULARY
from boxloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
PLAIN = re.compile(r"^[\W_]+|[\W_]+$")


def shingles(words):
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_survivors(rows, percent):
    """The least id of each component of near duplicates, and all wordless texts."""
    sets = [shingles(t.encode().lower().split()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= percent * len(sets[i] | sets[k]):
                root[find(i)] = find(k)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, t) for i, (d, t) in enumerate(rows) if not sets[i] or least[find(i)] == d]


def cut(rows, length=400, words=51):
    """Texts without the bytes of repeated strings and repeated runs of words."""
    data = [t.encode() for _, t in rows]
    found = [list(re.finditer(rb"[^\x20\x09-\x0D]+", b)) for b in data]
    strings = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    runs = collections.Counter(tuple(m[0] for m in ms[i : i + words]) for ms in found for i in range(len(ms) - words + 1))
    out = []
    for (d, t), b, ms in zip(rows, data, found, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if strings[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        for i in range(len(ms) - words + 1):
            if runs[tuple(m[0] for m in ms[i : i + words])] > 1:
                a, z = ms[i].start(), ms[i + words - 1].end()
                gone[a:z] = b"\1" * (z - a)
        parts = re.findall(rb"\0+", bytes(gone)) and [b[m.start() : m.end()] for m in re.finditer(rb"\0+", bytes(gone))]
        left = "".join(p.decode("utf-8", "ignore") for p in parts)
        if not any(gone) or left.split():
            out.append((d, left if any(gone) else t))
    return out


def contains(text, item):
    def plain(t):
        return [w for w in (PLAIN.sub("", w.lower()) for w in t.split()) if w]

    w, q = plain(text), plain(item)
    if not q:
        return False
    n = min(5, len(q))
    need = {tuple(q[k : k + n]) for k in range(len(q) - n + 1)}
    return 100 * len(need & {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}) >= 80 * len(need)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The small tables with planted copies, passages of 51 to 60 words, and benchmark items."""
    rng = random.Random(5)
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    good = [r for r in rows if r[1] and len(r[1].split()) > 150][:40]
    vocabulary = sorted({w for r in good for w in r[1].split()})
    more = []

    def add(words):
        more.append((10_000 + len(more), " ".join(words), "en", "planted"))

    def fresh(n):
        return [w for _ in range(n // 4) for w in (rng.choice(vocabulary), "the", rng.choice(vocabulary), rng.choice(vocabulary))]

    for n in range(6):
        add(good[n][1].split())  # exact copy
        near = good[n + 6][1].split()
        near[rng.randrange(len(near))] = "changed"
        add(near)
        passage = fresh(60)[: 51 + n]
        for _ in range(3):
            a = fresh(80)
            add(a[:30] + passage + a[30:])
        item, a = rng.choice(items).split(), fresh(80)
        add(a[:40] + item + a[40:])
        add(fresh(80))
    table = spark.createDataFrame(rows + more, "doc_id long, text string, lang string, source string")
    table.withColumn("n_chars", F.char_length("text").cast("bigint")).write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels", "pages", "conversations"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_pipeline_against_brute_force(spark, planted):
    import corpus_pipeline

    sentencepiece = pytest.importorskip("sentencepiece")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{planted}/documents.parquet/*.parquet'")
    names = db.execute(SQL["op2_quality_rules"]).fetch_df()
    keep = set(names[names.kept].doc_id)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{planted}/documents.parquet").collect() if r.doc_id in keep]
    assert sum(d >= 10_000 for d, _ in rows) > 30
    rows = near_survivors(rows, 80)
    before = dict(rows)
    rows = cut(rows)
    assert sum(before[d] != t for d, t in rows if d >= 10_000) >= 12
    items = [r.text for r in spark.read.parquet(f"{planted}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not any(contains(t, q) for q in items)]
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, planted).collect()}
    assert {d: r.ids for d, r in got.items()} == {d: model.encode(t) for d, t in rows}
    assert all(r.decoded_same and r.n_ids == len(r.ids) for r in got.values())


@pytest.mark.parametrize("name", [n for n in SQL if n != "op9_minhash"])
def test_queries_equal_their_sql(spark, planted, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{planted}/{table}.parquet/*.parquet'")
    got = QUERIES[name](spark, planted)
    columns = got.columns
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


def test_near_duplicate_query(spark, planted):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{planted}/documents.parquet").collect()]
    got = {r.doc_id for r in QUERIES["op9_minhash"](spark, planted).where("kept").collect()}
    assert got == {d for d, _ in near_survivors(rows, 85)}


def test_sharding_query(spark, planted):
    rows = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{planted}/documents.parquet").collect()}
    got = QUERIES["op1_sharding"](spark, planted).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {d: (len(b) + 8, zlib.crc32(b)) for d, b in rows.items()}
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and {r.law for r in got} == {"rows"}


def test_page_query_on_held_out_pages(spark, planted):
    """Weights are learned from pages of an even hash; others give their marked text with the marks stripped."""
    pages = spark.read.parquet(f"{planted}/pages.parquet").where("html IS NOT NULL")
    weights = learn_weights(pages)
    held = [r.html for r in pages.where(F.pmod(F.xxhash64("html"), F.lit(2)) == 1).collect()]
    assert len(held) > 8
    for page in held:
        want = "\n\n".join(b.text for b in blocks(page) if b.marked and not b.dropped and b.text)
        assert main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", page), weights) == want
    got = {r.page_id: r for r in QUERIES["op3_page_text"](spark, planted).collect()}
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == spark.read.parquet(f"{planted}/pages.parquet").count()


def test_learned_queries_on_held_out_documents(spark, planted):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{planted}/documents.parquet").collect()}
    langs = [r for r in QUERIES["op4_language"](spark, planted).where("held_out").collect() if docs[r.doc_id].lang and r.lang_pred != "und"]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in langs) >= 0.9 * len(langs) > 20
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{planted}/labels.parquet").collect() if r.quality is not None}
    scored = [(r.score, labels[r.doc_id]) for r in QUERIES["op8_line_quality"](spark, planted).where("held_out").collect() if r.doc_id in labels]
    pairs = [(a > b) + (a == b) / 2 for a, x in scored if x for b, y in scored if not y]
    assert len(scored) > 10 and sum(pairs) >= 0.9 * len(pairs)
