"""Byte-level BPE, token alignment and ranked search against libraries and brute force."""

import bisect
import hashlib
import math
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.llm import alignment, byte_bpe, pieces, queries
from boxloom.llm import ranked_search as search

ALPHABET = " \n  \t\r\x0b\x00\x1c\x85\xa0 　'stredlvm aaaabbb ab1234!?.,<|endoftext|><s>éßñ漢字😀́‍ABZ_-"


def fuzz(seed: int, n: int, longest: int = 60) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, longest))) for _ in range(n)]


def greedy(word: bytes, ranks: dict) -> list[int]:
    """Repeated merging of the least pair, the leftmost among equals."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min((ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == math.inf:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def test_bytes_equal_the_library():
    import tiktoken

    v = byte_bpe.load_ranks()
    library = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks={t: i for i, t in enumerate(v.tokens)}, special_tokens={})
    coder = byte_bpe.Coder(v, limit=20_000)  # tables are forgotten on the way
    for seed in range(4):
        texts = [*fuzz(seed, 1500), "a" * 5000, "ab" * 3000, "the " * 4000, None]
        for t, ids in zip(texts, coder.encode_all(texts), strict=True):
            assert ids.tolist() == library.encode_ordinary(t or "") and coder.decode(ids.tolist()) == (t or "").encode()


@pytest.mark.parametrize("seed", range(8))
def test_merge_replay_of_any_vocabulary(seed):
    """Random tokens: merges can arise whose rank is below that of the token that made them possible."""
    r = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    tokens += sorted({bytes(r.choices(b"abc", k=r.randint(2, 5))) for _ in range(60)}, key=lambda t: r.random())
    ranks = {t: i for i, t in enumerate(tokens)}
    pairs = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    v = byte_bpe.Vocabulary.of(tokens, pairs, list(range(len(tokens))), ranks, byte_bpe.PATTERN)
    words = [bytes(r.choices(b"abcd", k=r.randint(1, 30))) for _ in range(400)] + [b"a" * 50]
    flat, counts = byte_bpe.MergeReplay(v).encode(words)
    ends = np.cumsum(counts).tolist()
    got = [flat[e - n : e].tolist() for e, n in zip(ends, counts.tolist(), strict=True)]
    assert got == [greedy(w, ranks) for w in words]


def _side_a():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(alignment.VOCABULARY_A)
    library.encode_special_tokens = True
    return library


def test_json_vocabulary_equals_the_library():
    library, coder = _side_a(), byte_bpe.Coder(byte_bpe.load_json(alignment.VOCABULARY_A))
    texts = fuzz(9, 1500)
    for t, ids in zip(texts, coder.encode_all(texts), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def test_op13(spark, tmp_path):
    texts = [*fuzz(5, 60), "", None, "same text", "same text", "long words " * 100_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op13_byte_bpe(spark, str(tmp_path)).collect()}
    import tiktoken

    v = byte_bpe.load_ranks()
    library = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks={t: i for i, t in enumerate(v.tokens)}, special_tokens={})
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_packed_ids(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string").withColumn("IDS", F.lit("old"))
    got = {r.doc_id: (r.ids, r.decoded) for r in byte_bpe.unpacked_ids(byte_bpe.decode_bytes(byte_bpe.encode_bytes(rows))).collect()}
    coder = byte_bpe.Coder(byte_bpe.load_ranks())
    assert got == {1: (coder.encode_all(["a b"])[0].tolist(), bytearray(b"a b")), 2: (None, None), 3: ([], bytearray())}


@pytest.mark.parametrize("seed", range(20))
def test_gallop(seed):
    r = np.random.default_rng(seed)
    long = np.sort(r.choice(3000, r.integers(1, 900), replace=False)) + 1
    short = np.sort(r.choice(3000, r.integers(1, len(long) + 1), replace=False)) + 1
    long[-1] = short[-1] = 3001
    assert alignment.gallop(short, long).tolist() == [bisect.bisect_left(long.tolist(), x) for x in short.tolist()]


def test_packed_numbers():
    r = random.Random(4)
    runs = [[r.randrange(2 ** r.randint(1, 34)) for _ in range(r.randint(0, 9))] for _ in range(200)]
    packed = alignment.packed_numbers(np.array([x for own in runs for x in own], np.int64), np.array(list(map(len, runs))))
    assert [alignment.unpacked_numbers(x).tolist() for x in packed] == runs


def aligned_by_hand(texts):
    import sentencepiece

    a_library, b_library = _side_a(), sentencepiece.SentencePieceProcessor(model_file=alignment.VOCABULARY_B)
    a_tokens, b_tokens = byte_bpe.load_json(alignment.VOCABULARY_A).tokens, pieces.load_pieces(alignment.VOCABULARY_B)[2]
    links, rows = [], []
    for t in texts:
        a, b = (a_library.encode(" " + t, add_special_tokens=False).ids, b_library.encode(t)) if t else ([], [])
        if any(b"".join(tokens[i] for i in ids) != f" {t}".encode() for ids, tokens in ((a, a_tokens), (b, b_tokens))):
            a, b = [], []
        ends = [list(accumulate(len(tokens[i]) for i in ids)) for ids, tokens in ((a, a_tokens), (b, b_tokens))]
        groups, i, j, own = [([], [])] if a else [], 0, 0, Counter()
        while i < len(a) and j < len(b):
            own[a[i], b[j]] += 1
            x, y = ends[0][i], ends[1][j]
            if x <= y:
                groups[-1][0].append(str(a[i]))
            if y <= x:
                groups[-1][1].append(str(b[j]))
            if x == y and i + 1 < len(a):
                groups.append(([], []))
            i, j = i + (x <= y), j + (y <= x)
        links.append(own)
        rows.append((len(a), len(b), len(groups), own.total(), ";".join(f"{','.join(p)}|{','.join(q)}" for p, q in groups)))
    held = Counter(p for own in links for p in own)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return [(*r, sum(n for p, n in own.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in own.items())) for r, own in zip(rows, links, strict=True)]


def test_op11(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "_BLOCK", 2000)  # pairs are counted over many blocks
    texts = ["", None, "same words here", "same words here", "sign ▁ of the pieces", "of the the of", *fuzz(6, 250), "x" * 4000, "word and\nline " * 700]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op11_alignment(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, (n_a, n_b, n_groups, n_links, groups, n_best, total) in enumerate(aligned_by_hand(texts)):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, digest, n_best, total), texts[i]


def test_alignment_passes_columns(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    for c in ("N_A", "links", "block", "place", "pair", "row", "n", "best", "Count_Sum"):
        rows = rows.withColumn(c, F.lit("own"))
    out = alignment.count_links(alignment.align_tokens(rows))
    assert out.columns == ["doc_id", "block", "place", "pair", "row", "n", "best", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    got = out.orderBy("doc_id").collect()
    assert [r.n_a for r in got][0] == 0 and got[1] == got[2] and {r.block for r in got} == {"own"}
    assert alignment.count_links(alignment.align_tokens(rows.limit(0))).count() == 0


def ranked_by_hand(docs, items, top):
    def terms(text):
        out, own = [], ""
        for c in (text or "") + " ":
            if c.isascii() and not c.isalnum():
                out += [own] if own else []
                own = ""
            else:
                own += c.lower() if c.isascii() else c
        return out

    cut = [(i, terms(t)) for i, t in docs]
    cut = [(i, ws, Counter(ws)) for i, ws in cut if ws]
    n, total, df = len(cut), sum(len(ws) for _, ws, _ in cut), Counter(t for _, _, c in cut for t in c)
    out = []
    for item, text in {x for x in items if x[1] is not None}:
        found = []
        for i, ws, c in cut:
            m = 25 + 75 * len(ws) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,block", [(0, 1 << 22), (1, 300), (2, 1 << 22)])
def test_ranked_search(spark, seed, block, monkeypatch):
    monkeypatch.setattr(search, "_DEPTH", 2)
    monkeypatch.setattr(search, "_POSTINGS", 200)  # several blocks of documents a task
    r = random.Random(seed)
    words = ["the", "The", "of", "año", "漢字", "x1", "rare", "Ärger", "ärger", *[f"w{k}" for k in range(25)]]
    docs = [(i, " ".join(r.choices(words, k=r.randint(1, 40)))) for i in range(120)]
    docs += [(1000 + i, "the rare of x1") for i in range(15)] + [(7, "the of"), (None, "rare rare"), (None, "the rare of x1"), (8, None), (9, ""), (10, "?!"), (11, "the " * 50_000 + "rare")]
    items = [(k, " ".join(r.choices(words, k=r.randint(1, 8)))) for k in range(12)] + [(50, "rare the rare"), (51, None), (52, "unknown"), (53, "..."), (50, "rare the rare"), (None, "of"), (54, "THE, of-x1!")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("doc", F.lit("own")).withColumn("Score", F.lit("own")).repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit("own"))
    got = search.rank_documents(d, i, top=10, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == ranked_by_hand(docs, items, 10)


def test_ranked_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.rank_documents(none, some).count() == 0
    assert search.rank_documents(some.withColumnRenamed("item_id", "doc_id"), some.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_reading_stops_only_when_all_is_settled(seed):
    """Lists of few different impacts, so that many scores tie."""
    r = np.random.default_rng(seed)
    n, terms = 400, 6
    rows = [(d, t, int(r.integers(1, 5))) for d in range(n) for t in range(terms) if r.random() < (0.9, 0.5, 0.1)[t % 3]]
    doc, term, impact = (np.array(x) for x in zip(*rows, strict=True))
    weights = {t: int(r.integers(0, 4)) for t in range(terms)}
    ids = r.permutation(n)
    total = Counter()
    for d, t, x in rows:
        total[d] += weights[t] * x
    want = sorted(((-s, ids[d], d) for d, s in total.items() if s > 0))[:10]
    assert search.Lists(doc, term, impact, terms).best(weights, 10, ids) == [(d, -s) for s, _, d in want]
