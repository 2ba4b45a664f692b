"""SentencePiece encoding and decoding by streaming Viterbi over the pieces of a model file.

The lattice has a node at every character boundary and an arc for every piece. For a BPE model, an arc
may follow another only if the two pieces are stable side by side: merging the characters of the two
gives back just those two. A text then has one path, the one that repeated merging finds (see van
Antwerpen and Neubeck, "A fast BPE tokenizer", 2024), so each boundary keeps one backpointer. Ids are committed as
soon as the backpointer paths of all boundaries in the window of the longest piece meet in one
boundary; nothing further back is kept, however long a text without a space is.

A piece never goes on with a space after another character, so all paths meet before such a space, and
the search commits there at the latest. What lies between two such commits is searched once and kept in a
bounded table. Stretches that the window holds whole need no commit before their end: new ones of a batch are
searched in sorted order, and the backpointers of a common beginning stay in the window.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain, groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.words import batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_STRETCH = re.compile(r" *[^ \n]+| +|\n+")
#: A stretch goes on before a space or line end after something else, so a text may be cut there.
_BREAK = re.compile(r"[^ \n](?=[ \n])")
_KEPT = 1000  # characters of a stretch whose ids are kept in the table
_CHUNK = 1 << 22  # characters that are cut into stretches at once
_NONE = -1
_LAST = 1 << 40


def load_pieces(path: str = VOCABULARY) -> tuple[dict[str, int], dict[str, int], list[bytes], list[int]]:
    """Of a model file: ids and merge ranks of the pieces, the bytes each id decodes to, the ids of the 256 bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, decoded, single = {}, {}, [], [_NONE] * 256
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            single[int(piece[3:-1], 16)] = i
            decoded.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            decoded.append(b"")
        else:
            pieces[piece], scores[piece] = i, model.get_score(i)
            decoded.append(piece.replace(SPACE, " ").encode())
    if _NONE in single:
        raise ValueError("the model has no byte pieces, so not every text can be encoded")
    ranks = {p: r for r, p in enumerate(sorted(pieces, key=lambda p: (-scores[p], pieces[p])))}
    return pieces, ranks, decoded, single


def _parts(text: str):
    """A text in parts of about a chunk, none of which ends inside a stretch."""
    start = 0
    while len(text) - start > _CHUNK and (m := _BREAK.search(text, start + _CHUNK)):
        yield text[start : m.end()]
        start = m.end()
    yield text[start:]


class Pieces:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: tuple, table_limit: int = 250_000):
        self.pieces, self.ranks, self.decoded, self.single = vocabulary
        self.longest = max(map(len, self.pieces))
        self.table: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # the table before it was last full
        #: for each piece, what may come before it as far as known; None for other ends of pieces
        self.stable: dict[str, dict | None] = {p[k:]: None for p in self.pieces for k in range(len(p))}
        self.stable |= {p: {None: False} for p in self.pieces}
        self.n_stable = 0
        self.limit = table_limit
        self.known = {c for p in self.pieces for c in p}

    def merge(self, text: str) -> list[str]:
        """The pieces that merging the characters of a short text by rank leads to."""
        parts, rank = list(text), self.ranks.get
        ranks = [rank(a + b, _LAST) for a, b in pairwise(parts)]
        while ranks and (best := min(ranks)) < _LAST:
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank(parts[k - 1] + parts[k], _LAST)
            if k < len(ranks):
                ranks[k] = rank(parts[k] + parts[k + 1], _LAST)
        return parts

    def _follows(self, left: str, right: str, seen: dict[str, bool]) -> bool:
        """Whether ``right`` may come after ``left``; ``seen`` has the answers for ``right`` so far."""
        found = self.merge(left + right) == ([left, right] if left else [right])
        if self.n_stable < 2 * self.limit:
            seen[left] = found
            self.n_stable += 1
        return found

    def viterbi(self, text: str):
        """Yield the pieces of a text without characters outside the vocabulary, in committed runs."""
        n, start = len(text), 0  # everything before start is committed
        back: list[str | None] = [""]  # piece that ends at start + i on the one path there, or the last committed
        while start + len(back) <= n:
            self._extend(back, text, start, min(n, start + len(back) - 1 + self.longest))
            if start + len(back) > n:
                break  # at the end all paths meet
            meet = self._meeting(back)
            if meet:
                yield self._path(back, meet)
                back = back[meet:]
                start += meet
        yield self._path(back, n - start)

    def _extend(self, back: list, text: str, start: int, stop: int) -> None:
        """Find the backpointers of the boundaries up to ``stop``; ``back[i]`` is that of ``start + i``."""
        stable = self.stable
        for end in range(start + len(back), stop + 1):
            own = None
            for size in range(1, end - start + 1):
                piece = text[end - size : end]
                seen = stable.get(piece, 0)
                if not seen:
                    if seen is None:
                        continue
                    break  # no piece ends like this
                left = back[end - size - start]
                follows = seen.get(left)
                if follows or follows is None and left is not None and self._follows(left, piece, seen):
                    own = piece
                    break
            back.append(own)

    def _path(self, back: list, at: int) -> list[str]:
        out = []
        while at:
            out.append(back[at])
            at -= len(back[at])
        return out[::-1]

    def _meeting(self, back: list) -> int:
        """The last boundary that lies on the paths of all live boundaries of the window."""
        live = {i for i in range(max(1, len(back) - self.longest), len(back)) if back[i] is not None}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(last - len(back[last]))
        return live.pop() if live else 0

    def _search(self, stretch: str) -> tuple[int, ...]:
        """The ids of a stretch of any length and any characters."""
        text, known = stretch.replace(" ", SPACE), self.known
        if known.issuperset(text):
            return tuple([self.pieces[p] for part in self.viterbi(text) for p in part])
        ids: list[int] = []
        for held, run in groupby(text, known.__contains__):
            if held:
                ids += [self.pieces[p] for part in self.viterbi("".join(run)) for p in part]
            else:
                ids += [self.single[b] for b in "".join(run).encode("utf-8", "surrogatepass")]
        return tuple(ids)

    def _search_all(self, stretches: list[str]):
        """Yield the ids of sorted stretches; those that one window holds share the backpointers of what they begin with alike."""
        before, back, known = "", [""], self.known
        for stretch in stretches:
            text = stretch.replace(" ", SPACE)
            if len(text) > self.longest or not known.issuperset(text):
                yield self._search(stretch)
                continue
            same = 0
            for x, y in zip(before, text):
                if x != y:
                    break
                same += 1
            del back[same + 1 :]
            self._extend(back, text, 0, len(text))
            yield tuple(map(self.pieces.__getitem__, self._path(back, len(text))))
            before = text

    def _learn(self, stretches: set[str]) -> dict[str, tuple[int, ...]]:
        """Put what the table lacks into it; the ids of stretches too long for it are returned."""
        if len(self.table) >= self.limit:
            self.older, self.table = self.table, {}
        missing = stretches.difference(self.table)
        if self.older:
            held = missing.intersection(self.older)
            self.table.update((s, self.older[s]) for s in held)
            missing -= held
        missing = sorted(missing)
        long = {}
        for stretch, ids in zip(missing, self._search_all(missing), strict=True):
            (self.table if len(stretch) <= _KEPT else long)[stretch] = ids
        return long

    def encode_all(self, texts) -> list[np.ndarray]:
        """The ids of each text; none for null or empty ones."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        parts = ((i, part) for i, t in enumerate(texts) if t for part in _parts(" " + t.replace(SPACE, " ")))
        for some in batches(parts, lambda x: len(x[1]), _CHUNK):
            lists = [_STRETCH.findall(part) for _, part in some]
            long = self._learn(set().union(*lists))
            for (i, _), stretches in zip(some, lists, strict=True):
                ids = map(self.table.get, stretches)
                if long:
                    ids = (own or long[s] for own, s in zip(ids, stretches, strict=True))
                out[i].append(np.fromiter(chain.from_iterable(ids), np.int32))
        none = np.empty(0, np.int32)
        return [np.concatenate(own) if len(own) > 1 else own[0] if own else none for own in out]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The text of a list of ids, without the space that encoding puts before a text."""
        data = b"".join(map(self.decoded.__getitem__, ids))
        return data.decode("utf-8", "replace").removeprefix(" ")


#: Coders of this worker process: what one task has learned serves the next.
_CODERS: dict[int, Pieces] = {}


def _coder(vocabulary: tuple, number: int) -> Pieces:
    if number not in _CODERS:
        _CODERS.clear()
        _CODERS[number] = Pieces(vocabulary)
    return _CODERS[number]


def _numbered(path: str) -> tuple[tuple, int]:
    """The vocabulary of a file and a number for it, equal in all processes."""
    own = load_pieces(path)
    return own, zlib.crc32("\n".join(own[0]).encode("utf-8", "surrogatepass"))


def encode_pieces(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows of ``docs`` with ``ids`` (array of int), ``n_ids`` and ``decoded_same``.

    ``decoded_same`` tells whether decoding the ids gives the text, with U+2581 read as a space (the
    model cannot tell them apart). A null text has null ids, 0 of them, and a null flag; an empty one an
    empty list; repeated rows have equal ids, and an empty table gives an empty table. Every text can be encoded: characters outside the vocabulary become bytes. Other
    columns pass through; old columns of the three result names are replaced. The vocabulary file is
    read by the driver and sent to the tasks; its size does not depend on the data.
    """
    passed, row = packed(docs, ["ids", "n_ids", "decoded_same"], text)
    own, number = _numbered(vocabulary)

    @F.arrow_udf("struct<ids:array<int>,decoded_same:boolean>")
    def encode(texts: pa.Array) -> pa.Array:
        coder = _coder(own, number)
        parts, counts, same = [], [0], []
        for some in batches((t.as_py() for t in texts), lambda t: len(t or "") + 1, _CHUNK):
            for t, ids in zip(some, coder.encode_all(some), strict=True):
                parts.append(ids)
                counts.append(len(ids))
                same.append(None if t is None else coder.decode(ids.tolist()) == t.replace(SPACE, " "))
        offsets = np.cumsum(counts).astype(np.int32)
        flat = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32))
        lists = pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array([x is None for x in same], pa.bool_()))
        return pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["ids", "decoded_same"])

    return docs.select(row.alias("row"), F.col(text).alias("text"), encode(F.col(text)).alias("x")).select(
        *unpacked(passed, "row", text, F.col("text")),
        "x.ids", F.coalesce(F.size("x.ids"), F.lit(0)).cast("bigint").alias("n_ids"), "x.decoded_same",
    )


def decode_pieces(rows: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows with ``decoded``, the text of their ids (null for null); ids outside 0 to the vocabulary's end raise."""
    own, number = _numbered(vocabulary)

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        coder = _coder(own, number)
        return pa.array([None if x.as_py() is None else coder.decode(x.as_py()) for x in lists], pa.string())

    return rows.withColumn("decoded", decode(F.col(ids)))
