"""The training-data operators against brute force, on small tables with nulls, ties and clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from boxloom.llm.chat import render_perspectives
from boxloom.llm.components import components
from boxloom.llm.decontaminate import Items, PlainWords, contained_items
from boxloom.llm.langid import identify_language
from boxloom.llm.line_quality import marginals, score_quality
from boxloom.llm.minhash import near_duplicates
from boxloom.llm.page_text import count_features, extract_main_text, main_text, weights
from boxloom.llm.pieces import VOCABULARY, Pieces, decode_pieces, encode_pieces, load_pieces
from boxloom.llm.quality_rules import apply_rules
from boxloom.llm.sharding import communication_matrix, hypergeometric, uniform_shards
from boxloom.llm.suffix_dedup import GRAM, Anchors, cut_repeats, remove_repeats
from boxloom.llm.suffix_sort import deep_shallow_order

SCHEMA = "doc_id long, text string, lang string, row string, kept string, n string"


def docs(spark, rows):
    """A table with extra columns that clash with names used inside and in results."""
    return spark.createDataFrame([(i, t, None, "r", "k", "n") for i, t in rows], SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# ---- near duplicates


def brute_components(rows, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
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
    group = collections.defaultdict(list)
    for i in range(len(rows)):
        group[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((d for d in group[find(i)] if d is not None), default=None)) for i in range(len(rows))]


def near_rows(seed=0):
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        base = words(rng, rng.choice([8, 40, 120]))
        for _ in range(rng.choice([1, 2, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 3 + 1, " ".join(w)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  B"), (905, "a b c")]
    rows += [rows[0], rows[0], (None, rows[4][1]), (None, "only null id"), (None, "only null id")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    rows = near_rows(percent)
    got = near_duplicates(docs(spark, rows), percent=percent).collect()
    want = brute_components(rows, percent)
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == collections.Counter(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert {r.row for r in got} == {"r"}
    chosen = collections.Counter(r.component_id for r in got if r.chosen and r.n_shingles)
    assert set(chosen.values()) == {1}


def test_near_duplicates_of_an_empty_table(spark):
    assert near_duplicates(docs(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + k) for k in range(30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100} | {200 + k: 200 for k in range(1, 30)}


# ---- suffix sorting and repeats


def test_deep_shallow_order():
    rng = random.Random(2)
    for _ in range(300):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        s = [bytes(rng.choice(b"abc") if rng.random() < 0.03 else x for x in base)[: rng.randint(0, 60)] for _ in range(rng.randint(1, 12))]
        order, prefix = deep_shallow_order(s)
        assert [s[i] for i in order] == sorted(s)
        for k in range(1, len(order)):
            a, b = s[order[k - 1]], s[order[k]]
            n = prefix[k]
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def brute_repeats(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(300, 900))) for _ in range(5)]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a = rng.randrange(100)
            parts.append(p[a : a + rng.randint(200, 800)] if rng.random() < 0.6 else "".join(rng.choice("abcd\n ") for _ in range(300)))
        rows.append((d, "".join(parts)))
    return rows + [(50, None), (51, ""), (52, "short"), (53, "ab" * 700), rows[3], (None, rows[5][1]), (54, rows[7][1])]


@pytest.mark.parametrize("group_limit", [4000, 3])
def test_remove_repeats(spark, group_limit):
    rows = repeat_rows(group_limit)
    got = remove_repeats(docs(spark, rows), length=400, group_limit=group_limit).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == collections.Counter(brute_repeats(rows, 400))
    assert remove_repeats(docs(spark, [])).count() == 0


def test_cut_repeats_leaves_valid_text(spark):
    rows = repeat_rows(9)
    for r in cut_repeats(docs(spark, rows)).collect():
        t = dict(rows)[r.doc_id]
        assert (r.text == t) if not r.was_cut else len(r.text.encode()) < len(t.encode())


def test_anchors_of_texts_beyond_16_mib():
    import numpy as np

    data = np.random.default_rng(3).integers(0, 256, 17 << 20, np.uint8)
    copied = data[1000:3000].tobytes()
    long = data.tobytes() + copied
    maker = Anchors(400, GRAM)
    text, gram, _, at, low, high = maker.of([np.frombuffer(b, np.uint8) for b in (b"short", long)])
    assert set(text) == {1} and (low <= at).all() and (at + GRAM <= high + 400).all()
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high, strict=True)])
    assert (windows == np.arange(len(long) - 399)).all()
    _, own, _, place, *_ = maker.of([np.frombuffer(copied, np.uint8)])
    assert set(zip(own.tolist(), (place + len(data)).tolist(), strict=True)) <= set(zip(gram.tolist(), at.tolist(), strict=True))


@pytest.mark.parametrize("group_limit", [4000, 3])
def test_remove_repeats_in_slices(spark, monkeypatch, group_limit):
    monkeypatch.setattr("boxloom.llm.suffix_dedup.SLICE", 500)
    rows = repeat_rows(5)
    got = remove_repeats(docs(spark, rows), length=400, group_limit=group_limit).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == collections.Counter(brute_repeats(rows, 400))


def test_repeats_stage_cuts_passages_of_51_words(spark):
    import corpus_pipeline

    rng = random.Random(12)

    def passage(n, letters):
        return ["".join(rng.choices("abcdefgh", k=letters)) for _ in range(n)]

    rows, own, gone = [], {}, {}
    for p in range(8):
        shared = passage(51 if p < 6 else 50, 1 + p % 6)  # 101 to 356 bytes
        for space in (" ", "\n", "  "):
            before, after = passage(rng.randint(0, 80), 9), passage(rng.randint(1, 80), 9)
            d = len(rows)
            own[d] = before + ([] if len(shared) > 50 else shared) + after
            gone[d] = len(shared) > 50
            rows.append((d, space.join(before + shared + after)))
    table = docs(spark, rows).withColumn("n_chars", F.char_length("text").cast("bigint"))
    got = {r.doc_id: r for r in corpus_pipeline.repeats(spark, table, SMALL).collect()}
    assert {d: r.text.split() for d, r in got.items()} == own
    assert all((r.text != dict(rows)[d]) == gone[d] and r.n_chars == len(r.text) for d, r in got.items())


# ---- decontamination


def test_contained_items(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randint(6, 60), 50000))) for i in range(60)]
    items += [(100, "one two"), (101, None), (102, "  "), (103, items[0][1]), (None, "null id item words here now")]
    rows = []
    for d in range(30):
        w = words(rng, rng.randint(0, 3000), 50000)
        for _ in range(rng.randint(0, 3)):
            own = rng.choice(items[:60])[1].split()
            if rng.random() < 0.4:
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + rng.choice(["", ".", "!!"]) for x in own]
        rows.append((d, " ".join(w)))
    rows += [(90, None), (91, ""), (92, "say one, two three"), rows[0], (None, "null id item words here now")]

    def plain(t):
        return [x for x in (w.strip(".!,").lower() for w in (t or "").split()) if x]

    want = collections.Counter()
    for d, t in rows:
        w = plain(t)
        for i, body in items:
            q = plain(body)
            if not q:
                continue
            n = min(5, len(q))
            need = {tuple(q[k : k + n]) for k in range(len(q) - n + 1)}
            has = need & {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            if 100 * len(has) >= 80 * len(need):
                want[(d, i, len(need), len(has))] += 1
    table = spark.createDataFrame(items, "item_id long, text string")
    for size in (4 << 20, 3000):
        found = contained_items(docs(spark, rows), table, block_bytes=size)
        got = found.select("doc_id", F.explode("contained").alias("x")).select("doc_id", "x.*").collect()
        assert collections.Counter(map(tuple, got)) == want
        assert found.count() == len(rows)
    assert contained_items(docs(spark, rows), table.limit(0)).where(F.size("contained") > 0).count() == 0


# ---- sharding


def test_hypergeometric_law():
    rng = random.Random(1)
    draws = [hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(sum(draws) / 4000 - 6) < 0.15
    var = sum((x - 6) ** 2 for x in draws) / 4000
    assert abs(var - 20 * 0.3 * 0.7 * 80 / 99) < 0.4
    big = [hypergeometric(rng, 10**10, 23 * 10**10, 10**6) for _ in range(50)]
    assert abs(sum(big) / 50 - 10**6 / 24) < 150


def test_hypergeometric_probabilities():
    from fractions import Fraction

    from boxloom.llm.sharding import _binomial

    for good, bad, drawn in ((3, 4, 2), (30, 70, 20), (500, 1500, 777), (10**6, 23 * 10**6, 300)):
        mode = (drawn + 1) * (good + 1) // (good + bad + 2)
        want = Fraction(math.comb(good, mode) * math.comb(bad, drawn - mode), math.comb(good + bad, drawn))
        share = drawn / (good + bad)
        got = _binomial(mode, good, share) * _binomial(drawn - mode, bad, share) / _binomial(drawn, good + bad, share)
        assert abs(got / float(want) - 1) < 1e-11


def test_communication_matrix_margins():
    m = communication_matrix([5, 0, 17, 30], [13, 13, 13, 13], 3)
    assert [sum(r) for r in m] == [5, 0, 17, 30] and [sum(c) for c in zip(*m, strict=True)] == [13] * 4


def test_uniform_shards(spark):
    rows = [(i, f"t{i}") for i in range(500)] + [(7, "same")] * 300 + [(None, None)] * 13
    got = uniform_shards(docs(spark, rows).withColumn("slot", F.lit("old")), 24, rows_per_range=10).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)
    sizes = collections.Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert uniform_shards(docs(spark, []), 24).count() == 0
    assert uniform_shards(docs(spark, rows[:3]), 24).count() == 3


# ---- rules


def test_rules(spark):
    good = "the cat sat on the mat and it was happy to be there with all of the other cats in town"
    rows = [
        (1, good + "."), (2, None), (3, ""), (4, "word " * 60), (5, good.upper().replace(" ", "!! ")), (6, good.replace(" ", "### ")),
        (7, "\n".join([good] * 3)), (8, " | ".join(f"lengthy{i}" for i in range(40))), (9, "\tthe\x0b of " * 30), (1, good + "."),
    ]
    got = {r.doc_id: r for r in apply_rules(docs(spark, rows)).collect()}
    assert [d for d, r in sorted(got.items()) if r.kept] == [1]
    assert got[1].n_words == 21 and got[1].word_chars == len(good.replace(" ", "")) + 1
    assert got[4].n_repeat_words == 60 and got[7].n_dup_lines == 2 and got[7].n_repeat_words == 63
    assert got[2].n_words == 0 and got[2].base_failed and got[6].n_symbols == 60
    assert got[8].failed_rules == ["symbols", "stop_words"] and got[1].row == "r"


# ---- pages


def test_page_text(spark):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head><body>'
        "<header>Site name</header><nav><ul><li><a href='/a'>Menu one</a><li>Menu two</ul></nav>"
        '<div class="sidebar-left"><p>Side words here</p></div>{open}<h1>Head &amp; line</h1><p>First <b>bold</b>\n  text&#33;<br>more'
        '<div class="ad">Buy now</div><p title="a > b">Second para<!-- no --> goes on and on with words.</p>'
        "<form><input><button>Send</button></form>{close}<div id='comments'><p>Nice one said a reader</p></div><footer>&copy; me</footer>"
    )
    pages = [(i, page.replace("{open}", "<article>").replace("{close}", "</article>")) for i in range(3)]
    pages += [(10, page.replace("{open}", "<div>").replace("{close}", "</div>")), (11, None), (12, ""), (13, "<p>"), (14, "plain < text"), (15, "<a href='x")]
    table = spark.createDataFrame([(i, h, "u", "old") for i, h in pages], "page_id long, html string, url string, text string")
    got = {r.page_id: r for r in extract_main_text(table).collect()}
    want = "Head & line\n\nFirst bold text! more\n\nSecond para goes on and on with words."
    assert got[0].text == want and got[10].text == want and got[0].n_chars == len(want)
    assert [got[i].text for i in (11, 12, 13)] == ["", "", ""] and got[14].text == "plain < text"


def test_page_text_in_frames_of_the_whole_page():
    paragraphs = [" ".join(f"word{i}{k}" for k in range(30)) for i in range(4)]
    title = "A title of as many words as the scan needs to keep it"
    article = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    menu = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu {i}</a>" for i in range(40)) + "</ul></nav>"
    after = "<div class='comments'>" + "<p>nice one said a reader of it</p>" * 30 + "</div><footer>&copy; me</footer>"
    head, tail = "<html><head><title>T</title></head>", "</body></html>"
    pages = [
        head + "<body class='single right-sidebar'>" + menu + article + after + tail,
        head + "<body>" + menu + "<main class='has-header'><article class='post widget'>" + article + "</article></main>" + after + tail,
        head + "<body><div class='has-header'>" + menu + "<div class='single right-sidebar'>" + article + "</div></div><footer>me</footer>" + tail,
        head + "<body><form action='/page.aspx'>" + menu + article + after + "</form>" + tail,
        head + "<body><form action='/page.aspx'><div class='right-sidebar'>" + article + "</div>" + "<div class='sidebar'>Side words</div></form>" + tail,
        "<html><head><title>T</title><meta charset='utf-8'><body>" + menu + article + after + tail,
        "<title>T</title><head><link href='x'><div>" + article + "</div>" + after,
        head + "<body>" + menu + article + after * 2 + tail,
        head + "<body><div class='wrap'>" + menu + article + "<form>Your name <input></form></div>" + after + tail,
    ]
    assert [main_text(p, {}) for p in pages] == ["\n\n".join([title, *paragraphs])] * len(pages)


#: Pages of several templates, each with its main text written out by hand.
VARIED = [
    (  # a page builder's class names carry the article
        "<body><nav><a href='/'>Home</a><a href='/b'>Blog</a></nav>" + "".join(f"<div class='elementor-widget elementor-{k}'><p>Paragraph {k} of the story has enough words to be read as prose here.</p></div>" for k in range(5)) + "<footer>All rights</footer></body>",
        "\n\n".join(f"Paragraph {k} of the story has enough words to be read as prose here." for k in range(5)),
    ),
    (  # an article in two forms
        "<body><form id='a'><p>The first half of the article stands in a form, as some systems write it.</p></form><form id='b'><p>The second half of the article stands in another one, with as many words.</p></form></body>",
        "The first half of the article stands in a form, as some systems write it.\n\nThe second half of the article stands in another one, with as many words.",
    ),
    (  # two weak names share the article
        "<body><section class='related-work'><p>Related work has been done by many people over the last ten years.</p></section><section class='overlay'><p>The overlay of the maps shows where all of the rivers used to flow.</p></section></body>",
        "Related work has been done by many people over the last ten years.\n\nThe overlay of the maps shows where all of the rivers used to flow.",
    ),
    (  # a formula amid a paragraph
        "<body><p>We know that <math><mi>a</mi><mo>=</mo><mi>b</mi></math> holds for all of the numbers that were given above.</p></body>",
        "We know that a=b holds for all of the numbers that were given above.",
    ),
    (  # an article's own header, and headings by class name
        "<body><header>Site name and slogan</header><article><header><h1>The headline of the article</h1></header><p>It begins with a sentence that is long enough to be read.</p><h2 class='section-header'>A part</h2><p>It ends with one more sentence that is long enough as well.</p></article></body>",
        "The headline of the article\n\nIt begins with a sentence that is long enough to be read.\n\nA part\n\nIt ends with one more sentence that is long enough as well.",
    ),
    (  # weak and strong names beside enough prose are left out
        "<body><div class='entry-content'><p>The article says what it has to say in a few sentences of common words, and it is long enough.</p><div class='newsletter'>Sign up for our letter with all of the news of the week, it is free of any charge</div><div class='ad'>Buy one and get one</div>"
        "<p>Then it goes on and says some more, so that the region spans what stands between its two parts.</p></div><div class='related'><ul><li><a href='/x'>Another story</a></li></ul></div><div id='comments'><p>I like it very much, said a reader who had read the whole of it to the end.</p></div></body>",
        "The article says what it has to say in a few sentences of common words, and it is long enough.\n\nThen it goes on and says some more, so that the region spans what stands between its two parts.",
    ),
    (  # reader comments stay out, however little else there is
        "<body><p>A short note of the day, in one sentence only.</p><section class='comments'>" + "<div class='widget'><p>I like it very much, said a reader who had read the whole of it to the end.</p></div>" * 20 + "</section></body>",
        "A short note of the day, in one sentence only.",
    ),
    (  # a table of facts and quotes within an article
        "<body><div><h1>Facts of the town and its people</h1><blockquote>It is a fine town, they say, and it has always been one.</blockquote><p>The town has a market and two schools, and a bridge over the river.</p></div><aside>More towns</aside></body>",
        "Facts of the town and its people\n\nIt is a fine town, they say, and it has always been one.\n\nThe town has a market and two schools, and a bridge over the river.",
    ),
]


@pytest.mark.parametrize("k", range(len(VARIED)))
def test_page_text_of_varied_templates(k):
    page, want = VARIED[k]
    assert main_text(page, learned_weights()) == want
    assert main_text(page, {})  # without labelled pages some of it at least


def learned_weights():
    """Weights as plain pages with marked articles give them."""
    counts: dict = {}
    for k in range(30):
        page = "<body><nav><ul>" + "<li><a href='/'>Menu entry</a></li>" * 6 + f"</ul></nav><div class='ad'>Buy it now {k}</div><article><h1>A headline of some words</h1>" + "<p>Sentences of an article, one after another, as they come.</p>" * 8 + "</article><footer>The end of it</footer></body>"
        for feature, (good, bad) in count_features(page).items():
            own = counts.setdefault(feature, [0.0, 0.0])
            own[0] += good
            own[1] += bad
    return weights(counts)


# ---- languages


def test_language(spark):
    rng = random.Random(5)
    stems = {"xx": ["ba", "do", "kim", "lor"], "yy": ["zeu", "ghi", "nta", "rss"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(stems[lang], k=rng.randint(1, 3))) for _ in range(n))

    learn = docs(spark, [(i, text("xx" if i % 2 else "yy", 80)) for i in range(40)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "xx").otherwise("yy"))
    rows = [(i, text("xx" if i % 2 else "yy", 5 + 200 * (i % 3))) for i in range(20)] + [(100, None), (101, ""), (102, "123 !!")]
    got = {r.doc_id: r for r in identify_language(docs(spark, rows), learn).collect()}
    assert all(got[i].lang_pred == ("xx" if i % 2 else "yy") and 0.5 <= got[i].score <= 1 for i in range(20))
    assert all(got[i].lang_pred == "und" and got[i].rejected for i in (100, 101, 102))
    assert {r.lang_pred for r in identify_language(docs(spark, rows), learn.limit(0)).collect()} == {"und"}


# ---- quality


def test_marginals_match_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    scores, trans = rng.normal(size=(4, 2)), rng.normal(size=(2, 2))
    total, single, pair = 0.0, np.zeros((4, 2)), np.zeros((2, 2))
    for ys in itertools.product((0, 1), repeat=4):
        w = np.exp(sum(scores[i, y] for i, y in enumerate(ys)) + sum(trans[a, b] for a, b in itertools.pairwise(ys)))
        total += w
        for i, y in enumerate(ys):
            single[i, y] += w
        for a, b in itertools.pairwise(ys):
            pair[a, b] += w
    got_single, got_pair, log_total = marginals(scores, trans)
    assert np.allclose(got_single, single / total) and np.allclose(got_pair, pair / total) and np.isclose(log_total, np.log(total))


def test_quality(spark):
    rng = random.Random(6)

    def good():
        return "\n".join(" ".join(words(rng, 12)) + "." for _ in range(4))

    def bad():
        return "\n".join(" ".join(w + "***" for w in words(rng, 12)) for _ in range(4))

    learn = spark.createDataFrame([(good(), 1) for _ in range(30)] + [(bad(), 0) for _ in range(30)] + [(None, 1), ("x", None)], "text string, quality int")
    rows = [(i, good() if i % 2 else bad()) for i in range(20)] + [(50, None), (51, "")]
    got = {r.doc_id: r for r in score_quality(docs(spark, rows), learn).collect()}
    assert all(got[i].predicted == i % 2 for i in range(20)) and got[50].score == got[51].score
    assert {r.score for r in score_quality(docs(spark, rows), learn.limit(0)).collect()} == {0.5}


# ---- chat


def test_perspectives(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "hi"), (1, 2, "bob", "yo"), (1, 300, "cid", None), (2, None, None, "lost"), (None, 1, "ann", "x"), (3, 1, "ann", "twice"), (3, 1, "ann", "twice")]
    got = render_perspectives(spark.createDataFrame([(*t, "s") for t in turns], "conv_id long, turn long, role string, text string, segment string")).collect()
    own = sorted((r for r in got if r.conv_id == 1 and r.perspective == "bob"), key=lambda r: r.start)
    whole = "".join(r.segment for r in own)
    assert whole == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
        "<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user name=cid\n<|im_end|>\n"
    )
    assert [whole[r.mask_start : r.mask_end] for r in own if r.mask_start is not None] == ["yo<|im_end|>"]
    assert {(r.conv_id, r.perspective) for r in got} == {(1, "ann"), (1, "bob"), (1, "cid"), (None, "ann"), (3, "ann")}
    assert sorted(r.start for r in got if r.conv_id == 3) == [0, len("<|im_start|>assistant\ntwice<|im_end|>\n")]


def test_perspectives_of_equal_and_missing_turns(spark):
    rng = random.Random(31)
    turns = [(rng.choice([None, 1, 2]), rng.choice([None, 3, 3, 700, rng.randrange(2000)]), rng.choice(["ann", "bob", "system", None]), rng.choice([None, "", "x", "xyz", "xyw" * 9])) for _ in range(400)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    low = lambda x: (x is not None, x)
    want = collections.Counter()
    groups = [(c, [(t, r, b or "") for k, t, r, b in turns if k == c]) for c in (1, 2)]
    lost = [(t, r, b or "") for k, t, r, b in turns if k is None]
    groups += [(None, [x for x in lost if x == one]) for one in set(lost)]  # without a conversation: alone but for equal rows
    for c, own in groups:
        own = sorted(own, key=lambda x: (low(x[0]), low(x[1]), x[2]))
        for p in {r for _, r, _ in own} - {None, "system"}:
            start = 0
            for t, r, b in own:
                role = "system" if r == "system" else "assistant" if r == p else "user"
                segment = f"<|im_start|>{role}{f' name={r}' if role == 'user' and r else ''}\n{b}<|im_end|>\n"
                want[(c, p, t, r, role, segment, start)] += 1
                start += len(segment)
    got = render_perspectives(table).collect()
    assert collections.Counter(tuple(r)[:7] for r in got) == want
    assert render_perspectives(table.limit(0)).count() == 0


# ---- pieces


def test_pieces_agree_with_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzeeetttaaiinnooo ...,'-ABC0123 éüñ\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(300)]
    texts += ["", "  a b\n\n c\t d ", "x" * 5000, "the" * 3000, "日本語 テスト", " " * 37 + "x", "<s> </s>", "🙂 é̀", "abcabc" * 500]
    coder = Pieces(load_pieces(), table_limit=50)
    for t in texts:
        assert coder.encode(t).tolist() == model.encode(t)
    runs = list(coder.viterbi("▁" + "thequickbrownfox" * 400))
    assert len(runs) > 20 and [p for r in runs for p in r] == model.encode("thequickbrownfox" * 400, out_type=str)
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None), (-2, "a▁b")]
    found = decode_pieces(encode_pieces(docs(spark, rows))).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.ids, r.n_ids, r.decoded_same, r.decoded) == (None, 0, None, None) if r.doc_id == -1 else r.decoded_same and r.decoded == r.text.replace("▁", " ")


# ---- queries and pipeline on the small tables

SMALL = "/root/testdata/sf0.001"


def test_queries(spark):
    from boxloom.llm.queries import QUERIES

    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op1_sharding", "op2_quality_rules", "op4_language", "op7_pieces", "op8_line_quality", "op10_suffix_array"):
        assert QUERIES[name](spark, SMALL).count() == n, name
    held = QUERIES["op4_language"](spark, SMALL).collect()
    assert {r.doc_id for r in held if r.held_out} == {r.doc_id for r in held if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}


def test_short_items_at_all_places():
    """Items of one to seven words, at thousands of places of long texts, whole and scattered."""
    import numpy as np

    rng = random.Random(21)
    items = [(i, " ".join(f"i{i}x{k}" for k in range(1 + i % 12))) for i in range(240)]
    search = Items(items, 80)
    texts, want = [], []
    for _ in range(60):
        w, own = words(rng, 4000, 10**6), []
        for i in rng.sample(range(240), 50):
            at = rng.randrange(len(w) + 1)
            if all(not str(x).startswith("i") for x in w[max(0, at - 13) : at + 13]):
                w[at:at] = items[i][1].split()
                own.append(i)
        texts.append(PlainWords().of(" ".join(w)))
        want.append(sorted(own))
    assert sum(map(len, want)) > 2000
    assert [sorted(i for i, _, _ in own) for own in search.search(texts)] == want
    assert search.search([np.empty(0, np.uint64)]) == [[]]
