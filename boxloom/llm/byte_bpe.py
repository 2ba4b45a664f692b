"""Byte-level BPE encoding and decoding by replaying the merges over all words of a block of texts.

A block is some megabytes of whole texts. Its stretches (white space and what follows it) are numbered;
those not yet known are split into the pattern's words, and the bytes of all new words lie in one array.
An inverted index leads from each merge to the positions where its pair of tokens stands. Merges are
taken in the order of their ranks; each is applied at all its positions at once, and only the pairs on
both sides of a new token are looked up again and entered into the index. The ids of a text are then
gathered by the numbers of its stretches. Words are independent, so blocks and tasks need no exchange.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.words import batches

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that splits a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CHUNK = 1 << 22  # characters of a block
_PART = 1 << 20  # characters of a text that are cut into stretches at once
_STRETCH = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: With other white space in a text, a stretch could begin inside one of the pattern's words but after this:
_OTHER_SPACE = re.compile(r"[^\S \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_NONE = 1 << 30


@dataclass
class Vocabulary:
    """Tokens and merges of a file."""

    tokens: list[bytes]  # by id
    single: np.ndarray  # ids of the 256 bytes
    keys: np.ndarray  # left id * 2**32 + right id of each pair that merges, sorted
    ranks: np.ndarray  # rank of each of them
    made: np.ndarray  # id that the merge of a rank makes
    whole: dict[bytes, int]  # words that are taken as they are
    pattern: str
    number: int  # equal in all processes

    @classmethod
    def of(cls, tokens: list[bytes], pairs: list[tuple[int, int, int]], made: list[int], whole: dict, pattern: str) -> Vocabulary:
        ids = {t: i for i, t in reversed(list(enumerate(tokens)))}
        missing = [b for b in range(256) if bytes([b]) not in ids]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes, so not every text can be encoded: {missing[:5]}")
        found = np.array(sorted((a << 32 | b, r) for a, b, r in pairs), np.int64).reshape(-1, 2)
        return cls(
            tokens, np.array([ids[bytes([b])] for b in range(256)], np.int64), np.append(found[:, 0], np.iinfo(np.int64).max),
            np.append(found[:, 1], _NONE), np.array(made, np.int64), whole, pattern, zlib.crc32(repr((tokens, pattern, pairs[:1000])).encode()),
        )


def load_ranks(path: str = VOCABULARY, pattern: str = PATTERN) -> Vocabulary:
    """A file of lines with a token in base64 and its rank: any two tokens merge whose bytes make a token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    pairs = [
        (ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
    ]
    return Vocabulary.of(tokens, pairs, list(range(len(tokens))), ranks, pattern)


def byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in JSON vocabularies: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def load_json(path: str, pattern: str = PATTERN) -> Vocabulary:
    """A JSON file with a vocabulary and a list of merges, of which only those listed apply."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, vocab = byte_letters(), model["vocab"]
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if all(c in letters for c in token):
            tokens[i] = bytes(letters[c] for c in token)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    pairs = [(vocab[a], vocab[b], r) for r, (a, b) in enumerate(merges)]
    return Vocabulary.of(tokens, pairs, [vocab[a + b] for a, b in merges], {}, pattern)


class MergeReplay:
    """The merges of one vocabulary over many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        lefts, rights = vocabulary.keys[:-1] >> 32, vocabulary.keys[:-1] & 0xFFFFFFFF
        made = vocabulary.made[vocabulary.ranks[:-1]]
        rank_of = np.full(len(vocabulary.tokens) + 1, -1, np.int64)
        rank_of[vocabulary.made] = np.arange(len(vocabulary.made))
        rank_of[vocabulary.single] = -1
        #: Ranks after which a merge of a lower rank can arise: they are applied once a word at a time.
        self.careful = set()
        for side in (lefts, rights):
            self.careful |= set(rank_of[side[rank_of[side] > rank_of[made]]].tolist())

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.v.keys, key)
        return np.where(self.v.keys[at] == key, self.v.ranks[at], _NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and the number of each word's ids."""
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stop = len(self.v.tokens)  # before each word and after the last one; no pair has it
        n = int(lengths.sum()) + len(words) + 1
        token = np.full(n, stop, np.int64)
        is_byte = np.ones(n, bool)
        first = np.cumsum(lengths + 1) - lengths
        is_byte[first - 1] = is_byte[-1] = False
        token[is_byte] = self.v.single[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.append(self._ranks(token[:-1], token[1:]), _NONE)

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            merging = ranks < _NONE
            positions, ranks = positions[merging], ranks[merging]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, own in zip(ranks[np.append(0, edges)].tolist(), np.split(positions, edges) if len(edges) else (positions,), strict=True):
                if r in index:
                    index[r].append(own)
                else:
                    index[r] = [own]
                    heapq.heappush(heap, r)

        enter(np.arange(n), rank)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if r in self.careful:
                word = np.searchsorted(first, at, "right")
                leftmost = np.append(True, word[1:] != word[:-1])
                enter(at[~leftmost], rank[at[~leftmost]])
                at = at[leftmost]
            right = after[at]
            overlaps = at[1:] == right[:-1]
            if overlaps.any():  # like aaaa: of a run of overlapping pairs every other one, from the left
                place = np.arange(len(at))
                head = np.maximum.accumulate(np.where(np.append(True, ~overlaps), place, 0))
                at = at[(place - head) % 2 == 0]
                right = after[at]
            token[at] = self.v.made[r]
            token[right] = -1
            rank[right] = _NONE
            beyond = after[right]
            after[at] = beyond
            before[beyond] = at
            touched = np.concatenate([before[at], at])
            fresh = self._ranks(token[touched], token[after[touched]])
            rank[touched] = fresh
            enter(touched, fresh)
        kept = (token >= 0) & is_byte
        counts = np.add.reduceat(kept[:-1], first - 1, dtype=np.int64)
        return token[kept], counts


class Stretches(dict):
    """Stretches by number. ``fresh`` holds those numbered since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.characters = 0

    def __missing__(self, stretch: str) -> int:
        self[stretch] = number = len(self)
        self.fresh.append(stretch)
        self.characters += len(stretch)
        return number

    def of(self, text: str) -> np.ndarray:
        """The numbers of a text's stretches; they join to the text."""
        found = [np.empty(0, np.int64)]
        for part in parts_of(text):
            own = _CUT.split(part) if _OTHER_SPACE.search(part) else _STRETCH.findall(part)
            found.append(np.fromiter(map(self.__getitem__, own), np.int64, len(own)))
        return np.concatenate(found)


def parts_of(text: str):
    """A text in parts, none of which ends inside a stretch."""
    start = 0
    while len(text) - start > _PART and (m := _CUT.search(text, start + _PART)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


class Runs:
    """Runs of numbers, one a stretch, in one array that grows."""

    def __init__(self, kind=np.int32):
        self.flat, self.counts, self.starts = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        self.counts, self.starts = np.concatenate([self.counts, counts]), np.concatenate([self.starts, starts])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The runs of these stretches, one after another."""
        own = self.counts[numbers]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[numbers] - (ends - own), own)]


class Coder:
    """Encoder and decoder of one vocabulary; what it knows of stretches is forgotten once they fill ``limit`` characters."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 4_000_000):
        self.v, self.limit = vocabulary, limit
        self.replay = MergeReplay(vocabulary)
        self.split = regex.compile(vocabulary.pattern).findall
        self.stretches, self.runs = Stretches(), Runs()

    def encode_stretches(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches in one array, and the number of each stretch's ids."""
        numbers: dict[str, int] = {}
        words = [[numbers.setdefault(w, len(numbers)) for w in self.split(s)] for s in stretches]
        data = [w.encode() for w in numbers]
        whole = np.fromiter((self.v.whole.get(w, -1) for w in data), np.int64, len(data))
        merged, counts = self.replay.encode([w for w, i in zip(data, whole.tolist(), strict=True) if i < 0])
        of_word = np.ones(len(data), np.int64)
        of_word[whole < 0] = counts
        flat = np.empty(int(of_word.sum()), np.int64)
        is_whole = np.repeat(whole >= 0, of_word)
        flat[is_whole], flat[~is_whole] = whole[whole >= 0], merged
        runs = Runs()
        runs.add(flat, of_word)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.fromiter((w for own in words for w in own), np.int64, int(sizes.sum()))
        ends = np.append(0, np.cumsum(of_word[order]))
        edges = np.append(0, np.cumsum(sizes))
        return runs.of(order), ends[edges[1:]] - ends[edges[:-1]]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text of a block; none for null or empty ones."""
        if self.stretches.characters > self.limit:
            self.stretches, self.runs = Stretches(), Runs()
        numbers = [self.stretches.of(t or "") for t in texts]
        if self.stretches.fresh:
            self.runs.add(*self.encode_stretches(self.stretches.fresh))
            self.stretches.fresh = []
        return [self.runs.of(own) for own in numbers]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.tokens.__getitem__, ids))


#: Coders of this worker process: what one task has learned serves the next.
_CODERS: dict[int, Coder] = {}


def coder_of(vocabulary: Vocabulary) -> Coder:
    if vocabulary.number not in _CODERS:
        _CODERS.clear()
        _CODERS[vocabulary.number] = Coder(vocabulary)
    return _CODERS[vocabulary.number]


def _ids_of(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<u4")


def encode_bytes(docs: DataFrame, text: str = "text", vocabulary: Vocabulary | None = None, decode: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``ids``, packed as little-endian unsigned 32-bit integers, and their number ``n_tokens``.

    With ``decode`` also ``decoded``, the bytes that the ids stand for, from the same pass. A null text
    has null ids and 0 of them, an empty one empty ids; repeated rows have equal ids, and an empty table
    gives an empty table. Among equal pairs of a word the leftmost merges first. Texts of any length are
    encoded whole; strings of special tokens are plain text. Other columns pass through; old columns of
    the result names, in any case, are replaced. The vocabulary, read by the driver, goes to the tasks;
    its size does not depend on the data. ``unpacked_ids`` gives arrays instead.
    """
    results = ["ids", "n_tokens", "decoded"][: 3 if decode else 2]
    passed, row = packed(docs, results, text)
    own = vocabulary or load_ranks()

    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def encode(texts: pa.Array) -> pa.Array:
        coder, out, back = coder_of(own), [], []
        for some in batches((t.as_py() for t in texts), lambda t: len(t or "") + 1, _CHUNK):
            for t, ids in zip(some, coder.encode_all(some), strict=True):
                out.append(None if t is None else ids.astype("<u4").tobytes())
                back.append(None if t is None or not decode else coder.decode(_ids_of(out[-1]).tolist()))
        return pa.StructArray.from_arrays([pa.array(out, pa.binary()), pa.array(back, pa.binary())], ["ids", "decoded"])

    coded = docs.select(row.alias("row"), F.col(text).alias("text"), encode(F.col(text)).alias("x"))
    n = F.coalesce(F.octet_length("x.ids") / 4, F.lit(0)).cast("bigint")
    return coded.select(*unpacked(passed, "row", text, F.col("text")), "x.ids", n.alias("n_tokens"), *(["x.decoded"] if decode else []))


def decode_bytes(rows: DataFrame, ids: str = "ids", vocabulary: Vocabulary | None = None) -> DataFrame:
    """The rows with ``decoded``, the bytes of their packed ids (null for null); ids that the vocabulary lacks raise."""
    own = vocabulary or load_ranks()

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        coder = coder_of(own)
        return pa.array((None if (x := i.as_py()) is None else coder.decode(_ids_of(x).tolist()) for i in lists), pa.binary())

    return rows.withColumn("decoded", decode(F.col(f"`{ids}`")))


def unpacked_ids(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """The rows with packed ids as arrays of int."""

    @F.arrow_udf("array<int>")
    def unpack(lists: pa.Array) -> pa.Array:
        return pa.array((None if (x := i.as_py()) is None else _ids_of(x) for i in lists), pa.list_(pa.int32()))

    return rows.withColumn(ids, unpack(F.col(f"`{ids}`")))
