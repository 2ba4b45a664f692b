"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash.

Containment of an item in a document is high while their Jaccard similarity is tiny, as the document
is long. Two things mend that. Shingles that no item has cannot be shared, so a document is read as the
sequence of its shingles that some item has. And items are partitioned by size: for a partition of
items of at most ``n`` shingles a document is seen as windows of ``2u`` consecutive ones at a stride of
``u``, which is 1.25 ``n``. A window that covers an item at containment ``c`` has a Jaccard similarity bounded
from below by ``c``, ``u`` and the partition's least set, and each signature coordinate agrees with at
least that probability. One agreeing coordinate makes a candidate (bands of one row); every partition
has as many as its bound asks for, so that a pair at the bound escapes with probability under 1e-6. Candidates
are decided by exact containment of the item's shingle set in the set of the whole document.

Words are white-space runs in lower case without leading and trailing characters other than letters and
digits; words of such characters only are skipped. An item of fewer than five words is one shingle of
its length.

Scale: the items are a stated query set. They go to the tasks in blocks of at most ``block_bytes`` of
text, of which the driver holds one at a time; each block is one scan of the documents, whose findings are
written as a table. Documents are never shuffled for one block, and once by a digest of the text for more.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.minhash import _SIGMA, _pi
from boxloom.llm.scratch import written
from boxloom.llm.words import WIDTH, WordHashes, batches, shingle_set, shingles

_EDGES = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
_CHUNK = 1 << 18


class PlainWords(WordHashes):
    """Hashes of words in lower case without punctuation at their ends; words left empty are dropped."""

    def hash(self, word: bytes) -> int:
        plain = word.decode("utf-8", "surrogatepass").lower()
        if not (plain[0].isalnum() and plain[-1].isalnum()):
            plain = _EDGES.sub("", plain)
        return xxhash.xxh3_64_intdigest(plain.encode("utf-8", "surrogatepass")) | 1 if plain else 0

    def of(self, text: str | None) -> np.ndarray:
        hashes = super().of(text)
        return hashes[hashes != 0]


#: Of this worker process, so that one task's words serve the next.
_WORDS = PlainWords()


def _sizes():
    """The partitions' greatest sizes, which grow by a third."""
    size = 1
    while True:
        yield size
        size = max(size + 1, size * 4 // 3)


def signature_size(shared: float, size: int, window: int, miss: float = 1e-6) -> int:
    """Coordinates so that a window with ``shared`` of the ``size`` shingles of an item has none in common with ``miss``."""
    bound = shared / (window + size - shared)
    return 1 if bound >= 1 else math.ceil(math.log(miss) / math.log(1 - bound))


class _Universe:
    """The shingles of all items of a width, to look others up in."""

    def __init__(self, sets: list[np.ndarray]):
        self.all = np.unique(np.concatenate(sets))
        self.mask = np.uint64((1 << max(16, (64 * len(self.all)).bit_length())) - 1)
        self.seen = np.zeros(int(self.mask) + 1, bool)
        self.seen[self.all & self.mask] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.seen[hashes & self.mask])
        some = hashes[at]
        return at[self.all[np.minimum(np.searchsorted(self.all, some), len(self.all) - 1)] == some]


class _Partition:
    """Items of like size, with the sorted least values of each coordinate."""

    def __init__(self, numbers: list[int], sets: list[np.ndarray], percent: int, size: int):
        self.numbers = np.array(numbers)
        self.stride = -(-size * 5 // 4)
        least = min(map(len, sets))
        shared = -(-percent * least // 100)
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        places = _places(np.concatenate(sets))
        self.tables = []
        for k in range(signature_size(shared, least, 2 * self.stride)):
            values = np.minimum.reduceat(_pi(places + np.uint32(k)), starts)
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], order))

    def candidates(self, places: np.ndarray, text_of: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Pairs (text, number of the item) whose signatures share a coordinate."""
        first = np.flatnonzero(offset % self.stride == 0)
        text = text_of[first]
        same = np.append(text[1:] == text[:-1], False)
        found = [np.empty((0, 2), np.int64)]
        for k, (values, order) in enumerate(self.tables):
            half = np.minimum.reduceat(_pi(places + np.uint32(k)), first)
            window = np.where(same, np.minimum(half, np.append(half[1:], half[-1])), half)
            low, high = (np.searchsorted(values, window, side) for side in ("left", "right"))
            w = np.flatnonzero(low < high)
            n = high[w] - low[w]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[w], n)
            found.append(np.stack([np.repeat(text[w], n), self.numbers[order[at]]], axis=1))
        return np.unique(np.concatenate(found), axis=0)


class Items:
    """One block of items, partitioned by size, with the signatures of their shingle sets."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.percent = percent
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        parts: dict[int, dict[int, list[int]]] = {}  # width -> greatest size -> numbers of items
        for item, text in items:
            own = _WORDS.of(text)
            if len(own):
                self.ids.append(item)
                self.sets.append(shingle_set(own))
                size = next(x for x in _sizes() if x >= len(self.sets[-1]))
                parts.setdefault(min(WIDTH, len(own)), {}).setdefault(size, []).append(len(self.ids) - 1)
        self.parts = {
            width: (
                _Universe([self.sets[i] for own in by.values() for i in own]),
                [_Partition(own, [self.sets[i] for i in own], percent, size) for size, own in sorted(by.items())],
            )
            for width, by in sorted(parts.items())
        }

    def search(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """For each text's word hashes: (item, size of its set, shingles of it in the text)."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for width, (universe, partitions) in self.parts.items():
            rows = [(i, shingles(t, width)) for i, t in enumerate(texts) if len(t) >= width]
            if not rows:
                continue
            flat = np.concatenate([s for _, s in rows])
            at = universe.places(flat)
            if not len(at):
                continue
            flat, text_of = flat[at], np.repeat([i for i, _ in rows], [len(s) for _, s in rows])[at]
            starts = np.searchsorted(text_of, np.arange(len(texts) + 1))
            places, offset = _places(flat), np.arange(len(flat)) - starts[text_of]
            own: dict[int, np.ndarray] = {}
            for p in partitions:
                for text, number in p.candidates(places, text_of, offset).tolist():
                    if text not in own:
                        own[text] = np.unique(flat[starts[text] : starts[text + 1]])
                    has, s = own[text], self.sets[number]
                    shared = int((has[np.minimum(np.searchsorted(has, s), len(has) - 1)] == s).sum())
                    if 100 * shared >= self.percent * len(s):
                        found[text].append((self.ids[number], len(s), shared))
        return found


def _places(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _SIGMA) >> np.uint64(32)).astype(np.uint32)


_FOUND = "array<struct<item_id:bigint,n_item:bigint,n_shared:bigint>>"


def contained_items(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    percent: int = 80, block_bytes: int = 4 << 20,
) -> DataFrame:
    """The rows of ``docs`` with an array column ``contained`` of (item_id, n_item, n_shared).

    An item is listed if at least ``percent`` of its distinct shingles are in the document. Null and
    wordless texts contain nothing, null and wordless items are contained nowhere; repeated rows get
    the same list, and items of equal text are all listed. Ids of items may be null. Other columns
    pass through; an old column ``contained`` (in any case) is replaced. Without items, every list is
    empty; without documents, there is no row.
    """
    items = items.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).alias("body")).where("body IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    passed, row = packed(docs, ["contained"], text)
    rows = docs.select(row.alias("row"), F.col(text).alias("text"))

    def search(b: int):
        block = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b)
        return _search_udf(sorted((tuple(r) for r in block.collect()), key=str), percent)("text")

    if blocks == 1:
        rows = rows.withColumn("contained", search(0))
    else:
        key = F.sha2("text", 256).alias("key")
        parts = [written(rows.select(key, search(b).alias("x")).where(F.size("x") > 0).groupBy("key").agg(F.first("x").alias("x"))) for b in range(blocks)]
        found = reduce(DataFrame.union, parts).groupBy("key").agg(F.flatten(F.collect_list("x")).alias("contained"))
        rows = rows.withColumn("key", key).join(found, "key", "left")
    listed = F.array_sort(F.coalesce("contained", F.array().cast(_FOUND)))
    return rows.select(*unpacked(passed, "row", text, F.col("text")), listed.alias("contained"))


def _search_udf(items: list, percent: int):
    held: list[Items] = []

    @F.arrow_udf(_FOUND)
    def search(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Items(items, percent))
        out: list = []
        for some in batches((_WORDS.of(t.as_py()) for t in texts), lambda x: len(x) + 1, _CHUNK):
            out += [[{"item_id": i, "n_item": n, "n_shared": s} for i, n, s in own] for own in held[0].search(some)]
        return pa.array(out, pa.list_(pa.struct([(k, pa.int64()) for k in ("item_id", "n_item", "n_shared")])))

    # not to be evaluated once more in a filter on its result
    return search.asNondeterministic()
