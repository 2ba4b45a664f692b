"""Main text of web pages: the best contiguous region of a page by token weights.

A page is a sequence of words and tags. Words mostly score positive and tags negative; a word's weight
depends on the kind of element that it stands in, a tag's on its name, and both are log-odds learned
from labelled pages (pages that mark their article with an ``article`` or ``main`` element or with
``itemprop="articleBody"``; the marks read as ``div``, so they are no features). One linear scan finds the
maximum-scoring subsequence of tokens. Blocks of the region are the text, but for those in elements
whose kind or class name speaks of no article (forms, adverts, comments and the like) and whose words score
negative; such blocks may stand amid the article. A form or class name around the whole page, or one that
nearly all of a page's prose carries, says nothing about its text and is not heeded.

Scale: weights come from a bounded sample of labelled pages (``sample_pages``, in hash order), as a few
dozen sums. Extraction is one pass over whole pages, linear in their length, without a shuffle.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.samples import drawn, share

# Element names by what they do to text.
DROPPED = frozenset("script style noscript template svg iframe object head title select textarea button".split())
AROUND = frozenset("nav footer aside form header menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mover mrow "
    "msqrt mstyle msub msubsup msup mtext munder q s samp semantics small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that mark the article of a labelled page, as ``itemprop="articleBody"`` does.
MARKS = frozenset("article main".split())
#: Elements whose class names speak of the page, not of their text.
WHOLE = frozenset("html body main article".split())
# Parts of class, id and role names of what is no article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies disqus footer header menu modal nav navbar navigation newsletter notice overlay pagination popup promo "
    "promoted recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe "
    "tags toolbar widget".split()
)

#: Of these, what page builders also call parts of articles: not heeded where a page has hardly any other prose.
WEAK = frozenset(
    "banner byline header modal newsletter notice overlay popup promo promoted recommended related share sharing signup "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
#: Of these, what may be far longer than the article.
REPLIES = frozenset("comment comments disqus replies respond".split())
#: Beside these in a class name, a header is one of the text: ``entry-header``, ``section-header``.
OF_TEXT = frozenset("article body content entry post section story text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|[^<]++|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"[\s\x00]+")
_RAW_END = {n: re.compile(rf"</{n}\b[^>]*>|\Z", re.I) for n in ("script", "style", "textarea", "title", "iframe", "noscript")}


def tokens(page: str):
    """``(kind, name or text, attributes)`` of a page: ``open``, ``close`` and ``text`` in page order.

    Comments, doctypes and the raw content of scripts and the like are left out.
    """
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2] or m[5]
        if name:
            name, attributes = name.lower(), (m[3] if m[2] else m[6]) or ""
            if m[1] or m[4]:
                yield "close", name, ""
            else:
                yield "open", name, attributes
                if name in _RAW_END:
                    end = _RAW_END[name].search(page, at)
                    at = end.end()
                    yield "close", name, ""
        elif page[m.start()] != "<" or m.end() == m.start() + 1:
            yield "text", m[0], ""


def _hints(name: str, attributes: str) -> frozenset[str]:
    """The parts of an element's names that speak of no article."""
    out: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        for own in (m[1] or m[2] or m[3] or "").lower().split():
            parts = set(_PART.split(own))
            found = set(HINTS & parts)
            if "header" in found and (name in HEADINGS or parts & OF_TEXT):
                found.discard("header")
            out |= found
    return frozenset(out)


def _kind(name: str, hints: frozenset[str], marked: bool) -> str:
    """What an element is for its words: dropped, around the article, hinted at as such, or plain; a marked article's own header is plain."""
    if name in DROPPED:
        return "dropped"
    if name in AROUND and not (name == "header" and marked):
        return "around"
    return "hinted" if hints and name not in WHOLE else "block"


class Block:
    """A run of words between block boundaries."""

    __slots__ = ("text", "feature", "tags", "marked", "dropped", "odd")

    def __init__(self, feature: str, marked: bool, odd: _Odd | None):
        self.text: list[str] = []
        self.feature, self.marked, self.odd, self.dropped = feature, marked, odd, False
        self.tags: list[str] = []  # names of the tags before the text


class _Odd:
    """An open element that is no plain block, in the innermost such one.

    ``words`` are its own, outside of links, and ``longest`` the most of them in a row; ``group`` is what such elements share.
    """

    __slots__ = ("up", "kind", "frame", "group", "words", "longest", "wide")

    def __init__(self, up: _Odd | None, kind: str, frame: bool, group: frozenset[str]):
        self.up, self.kind, self.frame, self.group = up, kind, frame, group
        self.words, self.longest, self.wide = 0, 0, False


class _Open:
    """An open element with what holds for the text in it."""

    __slots__ = ("name", "marked", "dropped", "linked", "odd", "solid")

    def __init__(self, name: str, kind: str, hints: frozenset[str], marked: bool, up: _Open | None, place: int):
        self.name = name
        self.marked = marked or (up is not None and up.marked)
        self.dropped = kind == "dropped" or (up is not None and up.dropped)
        self.linked = name == "a" or (up is not None and up.linked)
        odd = up.odd if up else None
        group = frozenset(["form"]) if name == "form" else hints if kind == "hinted" else frozenset()
        self.odd = odd if kind == "block" else _Odd(odd, kind, bool(group), group)
        #: the place of the innermost element that is not inline, this one included
        self.solid = place if name not in INLINE else up.solid if up else -1


def _page_wide(odds: list[_Odd], plain: int) -> None:
    """Mark forms and hinted elements that are the page's frame; ``plain`` words stand in none.

    Such an element holds most of the page's words, and what no element of the kind holds besides is
    less than a tenth of them, or a hundredth where the name speaks of comments, which may be much longer than an
    article. Elements that hold most of the words stand in each other, so one pass from the outermost inwards finds all.
    """
    held = {id(o): o.words for o in odds}
    for o in reversed(odds):  # an element comes after those it stands in
        if o.up:
            held[id(o.up)] += held[id(o)]
    total = plain + sum(o.words for o in odds)
    besides = plain
    for o in odds:
        own = held[id(o)]
        times = 100 if o.group & REPLIES else 10
        if o.frame and 2 * own > total and (o.up is None or o.up.wide) and times * besides < own:
            o.wide = True
            besides += o.words


_PROSE = 10  # words in a row


def _builder_names(odds: list[_Odd], plain: int) -> None:
    """Do not heed forms and weak hints that carry ten times the prose of the plain elements around them.

    What is around an element are the words in no odd element and those of the page-wide ones that it stands
    in. So an article in parts of several names is kept whole, and a box in an article is still left out. What
    stands in an element that is heeded stays out.
    """
    words: dict[frozenset[str], int] = {}
    longest: dict[frozenset[str], int] = {}
    around: dict[frozenset[str], int] = {}
    frames: dict[int, int] = {}  # words of the page-wide elements from an element upwards
    for o in odds:  # outer ones first
        above = frames[id(o.up)] if o.up else 0
        frames[id(o)] = above + (o.words if o.wide else 0)
        if o.group and o.group <= WEAK | {"form"}:
            words[o.group] = words.get(o.group, 0) + o.words
            longest[o.group] = max(longest.get(o.group, 0), o.longest)
            around[o.group] = max(around.get(o.group, 0), plain + above)
    free = {g for g, n in words.items() if n > 10 * around[g] and longest[g] >= _PROSE}
    for o in odds:
        if o.group in free and (o.up is None or o.up.wide):
            o.wide = True


class _Stack:
    """The open elements; every step costs the same however many are open."""

    def __init__(self):
        self.open: list[_Open] = []
        self.count: dict[str, int] = {}

    def cut(self, place: int) -> None:
        for x in self.open[place:]:
            self.count[x.name] -= 1
        del self.open[place:]

    def push(self, name: str, attributes: str) -> str:
        """Open an element; returns its kind."""
        up, hints = self.top(), _hints(name, attributes)
        mark = name in MARKS or "articlebody" in attributes.lower()
        kind = _kind(name, hints, up is not None and up.marked)
        self.open.append(_Open(name, kind, hints, mark, up, len(self.open)))
        self.count[name] = self.count.get(name, 0) + 1
        return kind

    def top(self) -> _Open | None:
        return self.open[-1] if self.open else None

    def solid(self) -> str:
        place = self.open[-1].solid if self.open else -1
        return self.open[place].name if place >= 0 else ""

    def close(self, name: str) -> None:
        if self.count.get(name):
            place = len(self.open) - 1
            while self.open[place].name != name:
                place -= 1
            self.cut(place)


def blocks(page: str) -> list[Block]:
    """The blocks of a page, each with the tags that precede it."""
    stack = _Stack()
    out: list[Block] = []
    tags: list[str] = []
    odds: list[_Odd] = []
    fresh, plain = True, 0
    for kind, name, attributes in tokens(page):
        top = stack.top()
        if kind == "text":
            if top and top.name == "head" and name.strip():  # its end tag may be left out
                stack.cut(len(stack.open) - 1)
                top = stack.top()
            if top and top.dropped:
                continue
            if not name.strip() and (fresh or not out):
                continue
            odd = top.odd if top else None
            if not (top and top.linked):
                if odd:
                    odd.words += len(name.split())
                    odd.longest = max(odd.longest, len(name.split()))
                else:
                    plain += len(name.split())
            if fresh:
                out.append(Block(_known(stack.solid() or "body"), top is not None and top.marked, odd))
                out[-1].tags, tags, fresh = tags, [], False
            out[-1].text.append(name)
            continue
        tags.append(name)
        if kind == "open":
            if top and top.name == "head" and name not in IN_HEAD:
                stack.cut(len(stack.open) - 1)
            if name in CLOSES_P and stack.solid() == "p":
                stack.cut(stack.open[-1].solid)
            if name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack.solid() == name:
                stack.cut(stack.open[-1].solid)
            if name not in VOID:
                if stack.push(name, attributes) != "block":
                    odds.append(stack.open[-1].odd)
            elif name == "br" and not fresh:
                out[-1].text.append(" ")
        else:
            stack.close(name)
        if name not in INLINE:
            fresh = True
    _page_wide(odds, plain)
    _builder_names(odds, plain)
    for o in odds:  # what a frame stands in is one too
        if o.up and not o.up.wide and not o.wide and o.up.kind == "hinted":
            o.kind = "hinted"
    for b in out:
        if b.odd and not b.odd.wide:
            weak = b.odd.kind == "hinted" and b.odd.group <= WEAK and not (b.odd.up and not b.odd.up.wide)
            b.feature, b.dropped = "weak" if weak else b.odd.kind, True
        b.text = _SPACE.sub(" ", entities.unescape("".join(b.text))).strip()
    return out


_NAMES = frozenset("p h1 h2 h3 h4 h5 h6 li td th dd dt div section body blockquote pre figcaption a".split())


def _known(name: str) -> str:
    """A feature's name. Marks of labelled pages read as ``div``, so that they are no features."""
    return name if name in _NAMES else "div" if name in MARKS else "other"


#: Weights where no labelled page says otherwise: a word and a tag.
WORD, TAG = 1.0, -2.0


def count_features(page: str) -> dict[str, list[float]]:
    """Of a labelled page: feature -> tokens inside and outside of the article. Empty if unlabelled."""
    found = blocks(page)
    if not any(b.marked for b in found):
        return {}
    out: dict[str, list[float]] = {}
    inside = False
    for b in found:
        for t in b.tags:
            out.setdefault(f"tag {_tag(t)}", [0.0, 0.0])[0 if inside and b.marked else 1] += 1
        inside = b.marked
        # the marks do not tell adverts and the like within an article; of weak names they do
        good = b.marked and (not b.dropped or b.feature == "weak")
        out.setdefault(f"word {b.feature}", [0.0, 0.0])[0 if good else 1] += len(b.text.split())
    return out


def _tag(name: str) -> str:
    return name if name in INLINE or name in AROUND or name in ("ul", "ol", "table", "tr") else _known(name)


def weights(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Log-odds for words, and the negative of the odds to be outside for tags; smoothed, bounded."""
    out = {}
    for feature, (good, bad) in counts.items():
        if feature.startswith("word"):
            out[feature] = max(-4.0, min(4.0, math.log((good + 3) / (bad + 1))))
        else:
            out[feature] = -0.2 - 4 * (bad + 1) / (good + bad + 2)
    return out


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """The main text of a page, blocks joined by an empty line; empty if nothing scores. Of equal sums the first region counts."""
    found = blocks(page or "")
    best = (0.0, 0, -1)
    total, start = 0.0, 0
    own = [weight.get(f"word {b.feature}", -WORD if b.dropped else WORD) for b in found]
    for i, b in enumerate(found):
        total += sum(weight.get(f"tag {_tag(t)}", TAG) for t in b.tags)
        if total <= 0:
            total, start = 0.0, i
        total += len(b.text.split()) * own[i]
        if total > best[0]:
            best = (total, start, i)
    region = range(best[1], best[2] + 1)
    return "\n\n".join(found[i].text for i in region if found[i].text and not (found[i].dropped and own[i] <= 0))


def learn_weights(pages: DataFrame, html: str = "html", sample_pages: int = 2000) -> dict[str, float]:
    """Token weights from at most ``sample_pages`` different labelled pages, each as often as it occurs; empty if none is labelled.

    Pages of an odd hash are never learned from, so that the weights can be held against their marks.
    """
    kind = "array<struct<feature:string,good:double,bad:double>>"

    @F.arrow_udf(kind)
    def counted(texts: pa.Array) -> pa.Array:
        rows = [[{"feature": k, "good": g, "bad": b} for k, (g, b) in count_features(t.as_py()).items()] for t in texts]
        return pa.array(rows, pa.list_(pa.struct([("feature", pa.string()), ("good", pa.float64()), ("bad", pa.float64())])))

    marked = F.col("h").rlike(r"(?i)<(article|main)\b|articlebody")
    part = F.pmod(F.xxhash64("h"), F.lit(2)) == 0
    labelled = pages.select(F.col(html).alias("h")).where(marked & part)
    some = labelled.where(drawn("h", F.lit(share(2 * sample_pages, labelled.count())))).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    sample = some.orderBy(F.xxhash64("h"), "h").limit(sample_pages)
    sums = (
        sample.select("n", F.explode(counted.asNondeterministic()("h")).alias("x")).groupBy("x.feature")
        .agg(F.sum(F.col("n") * F.col("x.good")).alias("good"), F.sum(F.col("n") * F.col("x.bad")).alias("bad")).collect()
    )
    return weights({r["feature"]: (r["good"], r["bad"]) for r in sums})


def extract_main_text(pages: DataFrame, html: str = "html", labelled: DataFrame | None = None, sample_pages: int = 2000) -> DataFrame:
    """The rows of ``pages`` with ``text`` and ``n_chars`` (its code points).

    Weights are learned from ``labelled`` pages, which have the same column (``pages`` themselves by
    default). Null and empty pages have an empty text; pages of any length are read whole. White space in a
    block becomes one space; character references are decoded. Repeated pages have equal texts; an empty table gives an empty
    table. Other columns pass through; old columns of the result names (in any case) are replaced.
    """
    learned = learn_weights(labelled if labelled is not None else pages, html, sample_pages)
    passed, row = packed(pages, ["text", "n_chars"], html)

    @F.arrow_udf("string")
    def extract(texts: pa.Array) -> pa.Array:
        return pa.array([main_text(t.as_py(), learned) for t in texts], pa.string())

    rows = pages.select(row.alias("row"), F.col(html).alias("html"), extract(F.col(html)).alias("text"))
    return rows.select(*unpacked(passed, "row", html, F.col("html")), "text", F.char_length("text").cast("bigint").alias("n_chars"))
