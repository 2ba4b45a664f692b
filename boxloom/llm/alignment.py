"""Alignment of the tokens of two vocabularies over the same bytes.

Both sides' tokens end at byte offsets. The shorter list of ends drives a galloping search into the
longer one: exponential steps from the place of an end found before, then a binary search. Ends on
both sides cut the tokens into groups; the places found tell, by their differences, which tokens of the
longer list each token of the shorter one overlaps.

How many documents hold a pair of linked tokens is a count over the whole corpus. Texts are aligned in
blocks, in which a pair is listed once with its number of documents; the counts of all blocks are
summed, go back to the blocks that list the pair, and are there applied to each document's links.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm import byte_bpe, pieces
from boxloom.llm.byte_bpe import Coder, Runs, Stretches, Vocabulary
from boxloom.llm.columns import packed, unpacked
from boxloom.llm.scratch import written
from boxloom.llm.words import batches

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = pieces.VOCABULARY

_CHUNK = 1 << 22  # characters whose new stretches are learned at once
_BLOCK = 1 << 20  # characters that are aligned at once


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ``short``, the place of the first of ``long`` not below it; both rise and end alike.

    Ends at multiples of a stride are searched from the last one at a multiple of twice the stride, all
    of a stride at once.
    """
    n, last = len(short), len(long) - 1
    place = np.zeros(n + 1, np.int64)  # of short[i - 1]
    stride = 1 << max(n, 1).bit_length()
    while stride := stride >> 1:
        own = np.arange(stride, n + 1, 2 * stride)
        low, value = place[own - stride], short[own - 1]
        size = np.ones(len(own), np.int64)
        going = np.arange(len(own))
        while len(going):
            going = going[long[np.minimum(low[going] + size[going], last)] < value[going]]
            size[going] *= 2
        high = np.minimum(low + size, last)
        low = low + size // 2
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) // 2
            below = long[middle] < value[going]
            low[going] = np.where(below, middle + 1, low[going])
            high[going] = np.where(below, high[going], middle)
            going = going[low[going] < high[going]]
        # a step of one end: the end itself may be the one
        place[own] = low + (long[low] < value)
    return place[1:]


def overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of the side with fewer ends: first and last place that it overlaps, and whether both sides end there."""
    last = gallop(short, long)
    common = long[last] == short
    first = np.append(0, last[:-1] + common[:-1])[: len(last)]
    return first, last, common


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i]``, ``first[i] + 1`` ... ``counts[i]`` numbers for each i."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - counts), counts)


def packed_numbers(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Runs of numbers from 0 on as bytes, 7 bits each and the eighth where a number goes on."""
    width = np.ones(len(values), np.int64)
    for k in range(1, 5):
        width += values >= 1 << 7 * k
    at = np.repeat(np.arange(len(values)), width)
    k = ranges(np.zeros(len(values), np.int64), width)
    data = ((values[at] >> 7 * k) & 127 | np.where(k < width[at] - 1, 128, 0)).astype(np.uint8).tobytes()
    edges = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(sizes))].tolist()
    return [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def unpacked_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    if not len(raw):
        return raw
    head = np.append(0, np.flatnonzero(raw < 128)[:-1] + 1)
    k = np.arange(len(raw)) - np.repeat(head, np.diff(np.append(head, len(raw))))
    return np.add.reduceat((raw & 127) << 7 * k, head)


class LibraryPieces:
    """The ids that the sentencepiece library gives to stretches of a text.

    The library puts a space before what it encodes. A stretch begins with a space, which is left to the
    library, or with a line end; as no piece holds one, the library's space is then a piece of its own.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.space = self.model.piece_to_id(pieces.SPACE)

    def encode_stretches(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.model.encode([s[s[0] == " " :] for s in stretches], num_threads=1)
        lists = [x if s[0] == " " else x[1:] for s, x in zip(stretches, lists, strict=True)]
        lists = [[self.space] if s == " " else x for s, x in zip(stretches, lists, strict=True)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


class Aligner:
    """Tokens of both sides by stretches, and the alignment of blocks of texts."""

    def __init__(self, a: Vocabulary, tokens_b: list[bytes], model_b: bytes, limit: int = 5_000_000):
        self.limit, self.a, self.b = limit, Coder(a), LibraryPieces(model_b)
        self.tokens_b, self.n_b = tokens_b, len(tokens_b)
        self.bytes_a, self.bytes_b = (np.array(list(map(len, tokens)), np.int64) for tokens in (a.tokens, tokens_b))
        n = max(len(a.tokens), self.n_b)
        width = len(str(n))
        self.decimal = np.frombuffer(np.arange(n).astype(f"S{width}").tobytes(), np.uint8).reshape(n, width)  # filled up with 0
        self.clear()

    def clear(self) -> None:
        self.stretches, self.ids_a, self.ids_b, self.differs = Stretches(), Runs(), Runs(), np.empty(0, bool)

    def _learn(self) -> None:
        fresh, self.stretches.fresh = self.stretches.fresh, []
        if not fresh:
            return
        data = [s.encode() for s in fresh]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        differs = np.zeros(len(fresh), bool)
        for coder, tokens, lengths, held in ((self.a, self.a.v.tokens, self.bytes_a, self.ids_a), (self.b, self.tokens_b, self.bytes_b, self.ids_b)):
            flat, counts = coder.encode_stretches(fresh)
            held.add(flat, counts)
            ends = np.append(0, np.cumsum(lengths[flat]))[np.append(0, np.cumsum(counts))]
            same_size = np.diff(ends) == sizes
            differs |= ~same_size
            # bytes are compared where they stand at the same places
            both = [np.frombuffer(b"".join(x), np.uint8) for x in (
                (data[k] for k in np.flatnonzero(same_size).tolist()), map(tokens.__getitem__, flat[np.repeat(same_size, counts)].tolist()),
            )]
            wrong = np.flatnonzero(both[0] != both[1])
            if len(wrong):
                at = np.searchsorted(np.cumsum(sizes[same_size]), wrong, "right")
                differs[np.flatnonzero(same_size)[at]] = True
        self.differs = np.append(self.differs, differs)

    def align_all(self, texts: list[str | None]):
        """Yield the number of texts and the alignment of blocks of them."""
        if self.stretches.characters > self.limit:
            self.clear()
        none = np.empty(0, np.int64)
        numbers = [self.stretches.of(f" {t}") if t else none for t in texts]
        self._learn()
        for some in batches(zip(numbers, texts, strict=True), lambda x: len(x[1] or "") + 16, _BLOCK):
            yield len(some), self.align([none if self.differs[own].any() else own for own, _ in some])

    def align(self, numbers: list[np.ndarray]) -> dict[str, list | np.ndarray]:
        """Of each text, given as its stretches: numbers of tokens, groups and links, the groups as text, its linked pairs (places among the block's) and how often; the block's pairs and in how many texts each is."""
        none = np.empty(0, np.int64)
        every = np.concatenate([none, *numbers])
        edges = np.append(0, np.cumsum(list(map(len, numbers)))).astype(np.int64)
        a, b = self.ids_a.of(every).astype(np.int64), self.ids_b.of(every).astype(np.int64)
        # first token of each text, on both sides
        of_a, of_b = (np.append(0, np.cumsum(held.counts[every]))[edges] for held in (self.ids_a, self.ids_b))
        ends = [np.cumsum(self.bytes_a[a]), np.cumsum(self.bytes_b[b])]
        turned = len(b) < len(a)
        short, long = ends[::-1] if turned else ends
        first, last, common = overlaps(short, long)
        counts = last - first + 1
        links = [np.repeat(np.arange(len(short)), counts), ranges(first, counts)]
        cuts = [np.flatnonzero(common), last[common]]  # places of the groups' last tokens
        of_link = np.append(0, np.cumsum(counts))[of_b if turned else of_a]
        if turned:
            links.reverse()
            cuts.reverse()
        of_group = np.searchsorted(cuts[0], of_a)
        pair = a[links[0]] * self.n_b + b[links[1]]
        text_of = np.repeat(np.arange(len(numbers)), np.diff(of_link))
        kinds = len(self.bytes_a) * self.n_b
        keys, times = np.unique(text_of * kinds + pair, return_counts=True)
        pairs, place, n_texts = np.unique(keys % kinds, return_inverse=True, return_counts=True)
        sizes = np.bincount(keys // kinds, minlength=len(numbers))
        head = np.cumsum(sizes) - sizes
        steps = np.diff(place, prepend=0)
        steps[head[sizes > 0]] = place[head[sizes > 0]]
        return {
            "n_a": np.diff(of_a), "n_b": np.diff(of_b), "n_groups": np.diff(of_group), "n_links": np.diff(of_link),
            "groups": self._written(a, b, cuts, of_a, of_b), "places": packed_numbers(steps, sizes), "times": packed_numbers(times, sizes),
            "pairs": pairs, "n_texts": n_texts,
        }

    def _written(self, a: np.ndarray, b: np.ndarray, cuts: list[np.ndarray], of_a: np.ndarray, of_b: np.ndarray) -> list[str]:
        """The groups of each text, as in ``1,2|3;4|5,6``."""
        n = len(a) + len(b)
        size_a, size_b = (np.diff(np.append(-1, c)) for c in cuts)
        at_a = np.arange(len(a)) + np.repeat(np.append(0, cuts[1][:-1] + 1)[: len(size_a)], size_a)
        at_b = np.arange(len(b)) + np.repeat(cuts[0] + 1, size_b)
        width = self.decimal.shape[1]
        out = np.empty((n, width + 1), np.uint8)
        out[at_a, :width], out[at_b, :width] = self.decimal[a], self.decimal[b]
        out[:, width] = ord(",")
        out[at_a[cuts[0]], width], out[at_b[cuts[1]], width] = ord("|"), ord(";")
        whole = np.diff(of_b) > 0
        out[at_b[of_b[1:][whole] - 1], width] = 0
        used = out != 0
        edges = np.append(0, np.cumsum(used.sum(axis=1)))[of_a + of_b].tolist()
        data = out[used].tobytes().decode()
        return [data[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True)]


#: The aligner of this worker process: what one task has learned serves the next.
_ALIGNERS: dict[tuple, Aligner] = {}

_SCHEMA = (
    "row {row}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "links struct<block:bigint,n_b:int,places:binary,times:binary,pairs:array<bigint>,n_texts:array<bigint>>"
)
_LINKS = pa.struct([
    ("block", pa.int64()), ("n_b", pa.int32()), ("places", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("n_texts", pa.list_(pa.int64())),
])


def align_tokens(docs: DataFrame, text: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """The rows of ``docs`` without their text, with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` and ``links``.

    Side A is a byte-level BPE vocabulary in JSON, read over a space and the text; side B a piece model,
    which adds that space itself. ``groups`` lists the ids of each group as in ``1,2|3;4|5,6``, A before
    B. ``links`` is for ``count_links``. Null and empty texts, and those whose tokens' bytes differ from
    the text on either side (a text with U+2581), have no tokens: zeros and ''. Repeated rows are aligned
    alike; an empty table gives an empty table; a text of any length is aligned whole, in a block of
    its own if it is long. Other columns pass through, but for old ones of the result names in any case.
    """
    passed, row = packed(docs, ["n_a", "n_b", "n_groups", "n_links", "groups", "links", text])
    a = byte_bpe.load_json(vocabulary_a)
    names, _, tokens_b, _ = pieces.load_pieces(vocabulary_b)
    if any("\n" in name for name in names):
        raise ValueError("a piece holds a line end, at which texts are cut")
    with open(vocabulary_b, "rb") as file:
        model_b = file.read()
    number = zlib.crc32(model_b)
    slim = docs.select(row.alias("row"), F.col(text).alias("text"))

    def align(frames):
        key = (a.number, number)
        if key not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[key] = Aligner(a, tokens_b, model_b)
        own, block = _ALIGNERS[key], TaskContext.get().partitionId() << 32
        for frame in frames:
            at = 0
            for some in batches((t.as_py() for t in frame.column(1)), lambda t: len(t or "") + 16, _CHUNK):
                for n, x in own.align_all(some):
                    rest = [None] * (n - 1)  # a block's pairs go with its first row
                    links = pa.StructArray.from_arrays(
                        [
                            pa.array([block] * n, pa.int64()), pa.array([own.n_b] * n, pa.int32()), pa.array(x["places"], pa.binary()), pa.array(x["times"], pa.binary()),
                            pa.array([x["pairs"], *rest], pa.list_(pa.int64())), pa.array([x["n_texts"], *rest], pa.list_(pa.int64())),
                        ],
                        fields=list(_LINKS),
                    )
                    numbers = [pa.array(x[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                    yield pa.RecordBatch.from_arrays(
                        [frame.column(0).slice(at, n), *numbers, pa.array(x["groups"], pa.string()), links],
                        ["row", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
                    )
                    at += n
                    block += 1

    aligned = slim.mapInArrow(align, _SCHEMA.format(row=slim.schema["row"].dataType.simpleString()))
    return aligned.select(*unpacked(passed, "row"), "n_a", "n_b", "n_groups", "n_links", "groups", "links")


def count_links(aligned: DataFrame) -> DataFrame:
    """Rows of ``align_tokens`` with ``n_best`` and ``count_sum`` in place of ``links``.

    A pair's count is the number of rows that hold it linked; repeated rows count each. ``n_best`` is
    how many of a row's links have the highest count of their A id (ties included), ``count_sum`` the
    sum of its links' counts. Columns that are not needed, such as ``groups``, are better dropped before:
    the rows are written, and dealt by block.
    """
    passed, row = packed(aligned, ["links", "n_best", "count_sum"])
    held = written(aligned.select(row.alias("row"), "links"))
    listed = held.where("links.pairs IS NOT NULL").select(
        F.col("links.block").alias("block"), F.col("links.n_b").alias("n_b"), F.posexplode(F.arrays_zip("links.pairs", "links.n_texts")).alias("place", "x")
    ).select("block", "n_b", "place", F.col("x.pairs").alias("pair"), F.col("x.n_texts").alias("n"))
    counts = listed.groupBy("pair", "n_b").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.expr("pair div n_b"))
    counts = counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))
    back = listed.select("block", "place", "pair").join(counts, "pair").select("block", "place", "n", "best")
    slim = held.select("row", F.col("links.block").alias("block"), F.col("links.places").alias("places"), F.col("links.times").alias("times"))

    def apply(rows: pa.Table, counted: pa.Table) -> pa.Table:
        order = np.argsort(counted.column("place").to_numpy())
        n, best = (counted.column(k).to_numpy()[order].astype(np.int64) for k in ("n", "best"))
        n_best, total = [], []
        for places, times in zip(rows.column("places").to_pylist(), rows.column("times").to_pylist(), strict=True):
            own, times = np.cumsum(unpacked_numbers(places)), unpacked_numbers(times)
            n_best.append(int((best[own] * times).sum()))
            total.append(int((n[own] * times).sum()))
        return pa.Table.from_arrays([rows.column("row").combine_chunks(), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], ["row", "n_best", "count_sum"])

    found = slim.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        apply, f"row {slim.schema['row'].dataType.simpleString()}, n_best bigint, count_sum bigint"
    )
    return found.select(*unpacked(passed, "row"), "n_best", "count_sum")
