"""Removal of strings that repeat anywhere in a corpus, by deep-shallow suffix sorting.

Texts are strings of symbols: their bytes and, where passages of so many words are asked for, also
their words as 64-bit hashes. Sorting every suffix of a corpus would ship each text hundreds of times.
Equal strings of ``length`` symbols contain the same least k-gram (under a fixed hash), at the same
place. So only the suffixes at such anchors are sorted, about one in 140 bytes. An anchor stands for the
windows (strings of ``length`` symbols) whose least k-gram it is; its context is what those windows cover.

1. Anchors whose k-gram occurs once in the corpus are let go: their windows are unique.
2. Anchors whose whole context occurs twice are settled: their windows all repeat.
3. The distinct contexts of an anchor's group are compared: the suffixes to the right of the anchors
   and the reversed prefixes to their left are put in deep-shallow order with their common prefix
   lengths. A window that reaches ``j`` symbols to the left repeats if a context agrees with its own
   on ``j`` symbols to the left and on the rest to the right.

Scale: what is shuffled by k-gram are fixed-size anchor rows; counts are pre-aggregated. Contexts are
shipped once for each distinct one. The windows of a group of more than ``group_limit`` contexts are
counted by 128-bit digests instead of in one task; the result is the same. Texts are joined by key once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.scratch import removed, written
from boxloom.llm.suffix_sort import common_prefix, deep_shallow_order
from boxloom.llm.words import WordHashes, batches, mix64

#: Symbols of a k-gram, of bytes and of words.
GRAM, WORD_GRAM = 100, 12
_CHUNK = 1 << 18
SLICE = 1 << 20  # symbols of a text that are read at once
_POSITION = np.uint64((1 << 24) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Rolling:
    """Polynomial hashes of substrings of an array of symbols, modulo 2**64, with an odd base."""

    def __init__(self, base: int, size: int):
        self.size = size
        inverse = pow(base, -1, 1 << 64)
        self.up = np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]).cumprod(dtype=np.uint64)
        self.down = np.concatenate([[np.uint64(1)], np.full(size, inverse, np.uint64)]).cumprod(dtype=np.uint64)
        self.values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(data) + 1, np.uint64)
        out[0] = 0
        np.cumsum((self.values[data] if data.dtype == np.uint8 else data) * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


class Anchors:
    """Anchors of arrays of symbols: for each, the k-gram and context hashes, and what its windows cover."""

    def __init__(self, length: int, gram: int):
        if not 1 <= gram <= length:
            raise ValueError("the k-gram has to fit into the string")
        self.length, self.gram, self.slice = length, gram, SLICE
        if not length <= self.slice <= int(_POSITION) // 2:
            raise ValueError("a slice holds a string at least, and two have places of 24 bits")
        self.first = self.second = None

    def _rolling(self, size: int):
        if self.first is None or self.first.size < size:
            self.first, self.second = (_Rolling(b, max(size, 2 * _CHUNK)) for b in _BASES)
        return self.first, self.second

    def of(self, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(text number, k-gram hash, context hash, anchor, first window, last window), in order.

        Places have 24 bits, so a long text is read in slices that overlap by ``length - 1`` symbols: each
        window lies in one of them. An anchor whose windows lie in two has a row for each.
        """
        step = self.slice - self.length + 1
        pieces = ((i, k, t[k : k + self.slice]) for i, t in enumerate(texts) for k in range(0, len(t) - self.length + 1, step))
        parts = []
        for some in batches(pieces, lambda x: len(x[2]), self.slice):
            piece, gram, context, *places = self._of([t for _, _, t in some])
            number, offset = np.array([(i, k) for i, k, _ in some], np.int64).T
            parts.append((number[piece], gram, context, *(x + offset[piece] for x in places)))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.empty(0, np.int64) for _ in range(6))

    def _of(self, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        starts = np.cumsum([0, *map(len, texts)])
        data = np.concatenate(texts)
        n, wide = len(data), self.length - self.gram + 1
        first, second = self._rolling(n)
        sums = first.sums(data)
        grams = (sums[self.gram :] - sums[: n + 1 - self.gram]) * first.down[: n + 1 - self.gram]
        # the least k-gram of each window: hash above, place below, so that the leftmost is least
        least = (mix64(grams) & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while 2 * span <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < wide:
            least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
        at = (least & _POSITION).astype(np.int64)
        window = np.arange(len(at))
        text = np.searchsorted(starts, window, "right") - 1
        inside = window + self.length <= starts[text + 1]
        window, at, text = window[inside], at[inside], text[inside]
        if not len(window):
            return tuple(np.empty(0, np.int64) for _ in range(6))
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
        low, high = window[new], window[np.concatenate([new[1:], [len(window)]]) - 1]
        at, text = at[new], text[new]
        context = second.of(second.sums(data), low, high + self.length)
        context = mix64(context + mix64((at - low).astype(np.uint64) * np.uint64(1 << 20) + (high - low).astype(np.uint64)))
        base = starts[text]
        return text, grams[at].view(np.int64), context.view(np.int64), at - base, low - base, high - base


def _bytes(x: pa.Scalar) -> bytes:
    value = x.as_py()
    return value if isinstance(value, bytes) else value.encode("utf-8", "surrogatepass")


_SPACES = np.zeros(256, np.int8)
_SPACES[[9, 10, 11, 12, 13, 32]] = 1
_CODE = 8  # bytes of a word's hash


class _Reader:
    """A text as its two strings of symbols."""

    def __init__(self):
        self.hashes = WordHashes()

    def bytes(self, text: bytes) -> np.ndarray:
        return np.frombuffer(text, np.uint8)

    def words(self, text: bytes) -> np.ndarray:
        some = text.split()
        return np.fromiter(map(self.hashes.__getitem__, some), np.uint64, len(some))


def _anchor_udf(length: int, words: int | None):
    """Anchors of bytes have an even ``g``, those of words an odd one."""
    reader = _Reader()
    kinds = [(0, Anchors(length, min(GRAM, length)), reader.bytes)]
    if words:
        kinds.append((1, Anchors(words, min(WORD_GRAM, words)), reader.words))

    @F.arrow_udf("array<struct<g:bigint,c:bigint,at:int,lo:int,hi:int>>")
    def anchors(texts: pa.Array) -> pa.Array:
        parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(6)]
        data = ((i, _bytes(t)) for i, t in enumerate(texts) if t.is_valid)
        for some in batches(data, lambda x: len(x[1]), _CHUNK):
            number = np.array([i for i, _ in some])
            for odd, maker, read in kinds:
                text, gram, *columns = maker.of([read(t) for _, t in some])
                for part, c in zip(parts, [number[text], (gram & ~1) | odd, *columns], strict=True):
                    part.append(c)
        text, *flat = map(np.concatenate, parts)
        order = np.argsort(text, kind="stable")
        types = (np.int64, np.int64, np.int32, np.int32, np.int32)
        rows = pa.StructArray.from_arrays(
            [pa.array(x[order].astype(t)) for x, t in zip(flat, types, strict=True)], ["g", "c", "at", "lo", "hi"]
        )
        ends = np.searchsorted(text[order], np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rows)

    # not to be evaluated once more in a filter on its result
    return anchors.asNondeterministic()


def _runs(hits: list[bool] | np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(hits, np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def repeated_windows(contexts: list[tuple[bytes, int, int]], length: int, unit: int = 1, pairwise: int = 12) -> list[list[tuple[int, int]]]:
    """For contexts ``(bytes, anchor, windows)`` of one group: the runs of windows found in another.

    A symbol has ``unit`` bytes. The anchor is the place of a symbol; windows start at 0 to ``windows - 1``.
    """
    right = [b[at * unit :] for b, at, _ in contexts]
    left = [b[: at * unit][::-1] for b, at, _ in contexts]
    m = len(contexts)
    if m == 2:
        r, l = common_prefix(*right) // unit, common_prefix(*left) // unit
        return [
            [(a, b)] if (a := max(0, at - l)) <= (b := min(n - 1, at - (length - r))) else []
            for _, at, n in contexts
        ]
    orders = [(order, [p // unit for p in prefix]) for order, prefix in map(deep_shallow_order, (right, left))]
    found = [np.zeros(n, bool) for _, _, n in contexts]
    if m <= pairwise:
        reach = np.zeros((2, m, m), np.int64)
        for side, (order, prefix) in enumerate(orders):
            for i in range(m):
                shared = length * 4
                for k in range(i + 1, m):
                    shared = min(shared, prefix[k])
                    reach[side, order[i], order[k]] = reach[side, order[k], order[i]] = shared
        for i, (_, at, n) in enumerate(contexts):
            for k in range(m):
                if k != i:
                    low, high = max(0, at - reach[1, i, k]), min(n - 1, at - (length - reach[0, i, k]))
                    if low <= high:
                        found[i][low : high + 1] = True
        return [_runs(f) for f in found]
    # classes of equal right and left parts change only where j passes a common prefix length
    at = np.array([a for _, a, _ in contexts])
    last = np.array([n for _, _, n in contexts])
    (r_order, r_prefix), (l_order, l_prefix) = ((np.array(o), np.array(p)) for o, p in orders)
    low, high = int((at - last + 1).min()), int(at.max())
    cuts = np.unique(np.concatenate([[low], length - r_prefix, l_prefix + 1, at - last + 1, at + 1]))
    cuts = cuts[(cuts >= low) & (cuts <= high)]
    for j, after in zip(cuts, np.append(cuts[1:], high + 1), strict=True):
        has = (at >= j) & (at - last < j)
        of = np.empty(m, np.int64)
        of[r_order] = np.cumsum(r_prefix < length - j) * (m + 1)
        lefts = np.empty(m, np.int64)
        lefts[l_order] = np.cumsum(l_prefix < j)
        of = np.where(has, of + lefts, -1 - np.arange(m))
        _, which, count = np.unique(of, return_inverse=True, return_counts=True)
        for i in np.flatnonzero((count[which] > 1) & has):
            found[i][at[i] - after + 1 : at[i] - j + 1] = True
    return [_runs(f) for f in found]


def _compare(length: int, words: int | None):
    """Sort the groups of a partition, which arrive one after the other, ordered by ``g``."""
    schema = pa.schema([("key", pa.binary()), ("odd", pa.bool_()), ("lo", pa.int32()), ("hi", pa.int32())])

    def settle(group: list[dict], out: list):
        odd = bool(group[0]["g"] & 1)
        runs = repeated_windows(
            [(x["bytes"], x["at"] - x["lo"], x["hi"] - x["lo"] + 1) for x in group], words if odd else length, _CODE if odd else 1
        )
        for x, own in zip(group, runs, strict=True):
            if x["n"] == 1:
                out += [(x["key"], odd, x["lo"] + a, x["lo"] + b) for a, b in own]

    def batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(schema)], schema=schema)

    def run(parts):
        group: list[dict] = []
        for part in parts:
            out: list = []
            for x in part.to_pylist():
                if group and group[0]["g"] != x["g"]:
                    settle(group, out)
                    group = []
                group.append(x)
            yield batch(out)
        out = []
        if group:
            settle(group, out)
        yield batch(out)

    return run


def _slice_udf():
    reader = _Reader()

    @F.arrow_udf("array<binary>")
    def slices(texts: pa.Array, spans: pa.Array) -> pa.Array:
        """The symbols ``lo`` to ``end`` of a text, for each span of its list."""
        out = []
        for text, own in zip(texts, spans, strict=True):
            data, codes, parts = _bytes(text), None, []
            for x in own.as_py():
                if not x["g"] & 1:
                    parts.append(data[x["lo"] : x["end"]])
                    continue
                if codes is None:
                    codes = reader.words(data).tobytes()
                parts.append(codes[_CODE * x["lo"] : _CODE * x["end"]])
            out.append(parts)
        return pa.array(out, pa.list_(pa.binary()))

    return slices.asNondeterministic()


def _window_digests(contexts: pa.Array, length: pa.Array, unit: pa.Array) -> pa.Array:
    out = []
    for c, n, u in zip(contexts, length, unit, strict=True):
        b, u = c.as_py(), u.as_py()
        n = n.as_py() * u
        out.append([hashlib.blake2b(b[i : i + n], digest_size=16).digest() for i in range(0, len(b) - n + 1, u)])
    return pa.array(out, pa.list_(pa.binary()))


_CUT = "struct<n_removed:bigint,spans:array<struct<start:int,end:int>>,kept_sha256:string,rest:string>"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _left(data: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    return [data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True)]


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts, spans, strict=True):
        data = _bytes(text)
        found: tuple[list, list] = ([], [])
        for x in own.as_py():
            found[x["odd"]].append((x["start"], x["end"]))
        exact = every = _merged(found[0])
        if found[1]:
            edges = np.flatnonzero(np.diff(np.concatenate([[1], _SPACES[np.frombuffer(data, np.uint8)], [1]]))).tolist()
            every = _merged(exact + [(edges[2 * a], edges[2 * b - 1]) for a, b in found[1]])
        out.append({
            "n_removed": sum(e - s for s, e in exact),
            "spans": [{"start": s, "end": e} for s, e in exact],
            "kept_sha256": hashlib.sha256(b"".join(_left(data, exact))).hexdigest(),
            "rest": "".join(part.decode("utf-8", "ignore") for part in _left(data, every)),
        })
    return pa.array(out, pa.struct([("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_sha256", pa.string()), ("rest", pa.string())]))


def _key(text) -> F.Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def repeated_spans(texts: DataFrame, length: int = 400, words: int | None = None, group_limit: int = 4000) -> DataFrame:
    """``(key, text, spans)`` of the distinct texts that hold repeated strings.

    ``texts`` has one column ``text``. ``key`` is the first half of the SHA-256 of a text. ``spans`` are the
    ranges of all repeated windows: of bytes, and of words where ``odd``.
    """
    # a text of so many words has a byte for each and one between them at least
    least = min(length, 2 * words - 1) if words else length
    texts = texts.where(F.octet_length("text") >= least)
    odd = F.col("g").bitwiseAND(1) == 1
    wide = F.when(odd, words or 0).otherwise(length)
    places = written(
        texts.select(_key("text").alias("key"), _anchor_udf(length, words)("text").alias("xs"))
        .select("key", F.explode("xs").alias("x")).select("key", "x.*")
    )
    # a table of its own, so that the join below can split the rows of a very frequent k-gram
    again = written(places.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("g"))
    found = written(places.join(again, "g"))
    removed(places, again)
    contexts = written(
        found.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at", "lo", "hi")).alias("x"))
        .select("g", "c", "n", "x.*")
    )
    settled = F.col("key"), odd.alias("odd"), F.col("lo"), F.col("hi")
    whole = written(found.join(contexts.where("n > 1").select("g", "c"), ["g", "c"], "left_semi").select(*settled))
    removed(found)
    several = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    wanted = contexts.join(several, "g").groupBy("key").agg(
        F.collect_list(F.struct("g", "n", "m", "at", "lo", "hi", (F.col("hi") + wide).alias("end"))).alias("xs")
    )
    wanted = whole.select("key").distinct().join(wanted, "key", "full")
    held = written(
        texts.withColumn("key", _key("text")).join(wanted, "key")
        .groupBy("key").agg(F.first("text").alias("text"), F.first("xs").alias("xs"))
    )
    removed(contexts)
    kind = "array<struct<g:bigint,n:bigint,m:bigint,at:int,lo:int,hi:int,end:int>>"
    shipped = written(
        held.where("xs IS NOT NULL")
        .select("key", F.explode(F.arrays_zip("xs", _slice_udf()("text", F.col("xs").cast(kind)).alias("bytes"))).alias("z"))
        .select("key", "z.xs.*", "z.bytes").drop("end")
    )
    compared = (
        shipped.where(F.col("m") <= group_limit).repartition("g").sortWithinPartitions("g")
        .mapInArrow(_compare(length, words), "key binary, odd boolean, lo int, hi int")
    )
    digests = F.arrow_udf(_window_digests, "array<binary>").asNondeterministic()
    counted = shipped.where(F.col("m") > group_limit).select(
        "key", "g", "n", "lo", (F.col("at") - F.col("lo")).alias("r"),
        F.posexplode(digests("bytes", wide, F.when(odd, _CODE).otherwise(1))).alias("i", "h"),
    ).select("key", "g", "n", (F.col("lo") + F.col("i")).alias("lo"), (F.col("r") - F.col("i")).alias("j"), "h")
    twice = counted.groupBy("g", "j", "h").agg(F.sum("n").alias("m")).where("m > 1").select("g", "j", "h")
    counted = counted.where("n = 1").join(twice, ["g", "j", "h"], "left_semi").select("key", odd.alias("odd"), "lo", F.col("lo").alias("hi"))
    span = F.struct("odd", F.col("lo").alias("start"), (F.col("hi") + F.when(F.col("odd"), words or 0).otherwise(length)).alias("end"))
    spans = written(whole.union(compared).union(counted).groupBy("key").agg(F.collect_set(span).alias("spans")))
    removed(shipped, whole)
    return held.select("key", "text").join(spans, "key")


NAMES = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "rest"]


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 400, words: int | None = None, group_limit: int = 4000) -> DataFrame:
    """The rows of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` and ``rest``.

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too, in this
    text or another; every place counts, so no copy stays. ``spans`` are the removed byte ranges,
    merged, in order (empty if none). ``rest`` is the text that is left, without characters that a cut
    splits. With ``words``, passages of so many words that start anywhere else too are also cut from
    ``rest``, from their first word to their last, however short they are in bytes and whatever white
    space parts them; the other columns do not count those.

    Null texts count as empty; texts shorter than ``length`` lose nothing; repeated rows are copies of
    each other. Other columns pass through, but for old columns of the six result names (in any case),
    which are replaced. An empty table gives an empty table.
    """
    passed, row = packed(docs, NAMES, text)
    body = F.coalesce(F.col(text), F.lit(""))
    spans = repeated_spans(docs.select(body.alias("text")), length, words, group_limit)
    cut = written(spans.select("key", F.arrow_udf(_cut, _CUT).asNondeterministic()("text", "spans").alias("x")).select("key", "x.*"))
    rows = docs.select(row.alias("row"), F.col(text).alias("text"), _key(body).alias("key"))
    body = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(cut, "key", "left").select(
        *unpacked(passed, "row", text, F.col("text")),
        F.octet_length(body).cast("bigint").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", F.sha2(body, 256)).alias("kept_sha256"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("rest", body).alias("rest"),
    )


def cut_repeats(docs: DataFrame, text: str = "text", length: int = 400, words: int | None = None) -> DataFrame:
    """The rows of ``docs`` with the repeated strings cut out of ``text``, and ``was_cut`` beside it.

    Strings are those that ``remove_repeats`` leaves out of its ``rest``. Texts without a repeat, and null
    ones, are left as they are. An old column ``was_cut`` is replaced.
    """
    passed, row = packed(docs, ["was_cut"], text)
    found = remove_repeats(docs.select(row.alias("row"), F.col(text).alias("text")), "text", length, words)
    was = F.coalesce(F.octet_length("rest") < F.col("n_bytes"), F.lit(False))
    left = F.when(was, F.col("rest")).otherwise(F.col("text"))
    return found.select(*unpacked(passed, "row", text, left), was.alias("was_cut"))
