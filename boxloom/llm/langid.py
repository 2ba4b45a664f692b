"""Language identification by compression: the language whose dictionary compresses a text best.

Texts are read as lower-case letters with one space for whatever stands between letters. Each language
has a raw-content zstandard dictionary, made of whole sample documents of that language. A text is cut into
blocks, every block is compressed with every dictionary, and the sizes are summed over the
whole text; blocks keep the dictionaries at work throughout a long text. The smallest sum names the
language. If the runner-up is within ``narrow`` of it, the answer is marked as rejected.

Scale: the dictionaries are fitted on a bounded sample of ``sample_docs`` texts a language, of which tasks
send only the share that the counts call for. Prediction is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.samples import drawn, share

_LETTER = regex.compile(r"\p{L}")
_BETWEEN = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


def letters(text: str) -> bytes:
    """The words of a text in lower case, without digits, signs and repeated spaces."""
    return _BETWEEN.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


def sample_dictionaries(docs: DataFrame, text: str, lang: str, sample_docs: int = 192) -> dict[str, bytes]:
    """A dictionary of at most ``sample_docs`` different whole texts for each non-null language.

    Texts with a letter are taken, in hash order. The languages come in order of their numbers of rows,
    the most frequent first, then by name.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("body")).where(F.col("lang").isNotNull() & F.col("body").rlike(r"\p{L}"))
    often = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not often:
        return {}
    limits = F.create_map(*[F.lit(x) for k, n in often.items() for x in (k, share(sample_docs, n))])
    some = rows.where(drawn("body", limits[F.col("lang")])).dropDuplicates(["lang", "body"])
    order = Window.partitionBy("lang").orderBy(F.xxhash64("body"), "body")
    picked = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs).collect()
    parts: dict[str, list[bytes]] = {}
    for row in sorted(picked, key=lambda r: (r["lang"], r["rank"])):
        parts.setdefault(row["lang"], []).append(letters(row["body"]))
    return {k: b"\n".join(parts[k]) for k in sorted(parts, key=lambda k: (-often[k], k))}


class Compressors:
    """One compressor for each language, with its dictionary loaded once."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6, block: int = 1 << 12):
        self.block = block
        self.by_lang = {}
        for lang, content in dictionaries.items():
            how = zstandard.ZstdCompressionParameters.from_level(
                level, min_match=3, dict_size=len(content), source_size=block,
                write_checksum=False, write_content_size=False, write_dict_id=False,
            )
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=how)
            self.by_lang[lang] = zstandard.ZstdCompressor(dict_data=data, compression_params=how)

    def sizes(self, data: bytes) -> dict[str, int]:
        blocks = [data[i : i + self.block] for i in range(0, max(1, len(data)), self.block)]
        return {k: sum(len(c.compress(b)) for b in blocks) for k, c in self.by_lang.items()}


def identify_language(
    docs: DataFrame, learn: DataFrame, text: str = "text", lang: str = "lang", narrow: float = 0.004, **sample
) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, ``score`` and ``rejected``. Whole texts are looked at.

    Only the columns ``text`` and ``lang`` of ``learn`` are learned from, only ``text`` of ``docs`` is
    looked at. ``lang_pred`` is the best learned language, ``und`` if the text is null or has no letter
    or nothing was learned (score 0, rejected). ``score`` is a softmax of the saved bytes. Ties go to
    the language with more rows to learn from, then to the lesser name. ``rejected`` marks a margin under
    ``narrow`` of the smallest size. Repeated rows are answered alike; an empty table gives an empty
    table. Other columns pass through; old columns of the result names (in any case) are replaced.
    """
    names = ["lang_pred", "score", "rejected"]
    passed, row = packed(docs, names, text)
    dictionaries = sample_dictionaries(learn, text, lang, **sample)
    held: list[Compressors] = []

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Compressors(dictionaries))
        out = []
        for t in texts:
            body = t.as_py()
            if not dictionaries or body is None or not _LETTER.search(body):
                out.append({"lang_pred": UNKNOWN, "score": 0.0, "rejected": True})
                continue
            sizes = held[0].sizes(letters(body))
            ranked = sorted(sizes, key=sizes.get)
            least = sizes[ranked[0]]
            score = 1 / sum(math.exp(-0.25 * min(2000, sizes[k] - least)) for k in ranked)
            close = len(ranked) > 1 and sizes[ranked[1]] - least < narrow * least
            out.append({"lang_pred": ranked[0], "score": score, "rejected": close})
        return pa.array(out, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]))

    rows = docs.select(row.alias("row"), F.col(text).alias("text"), predict(F.col(text)).alias("x"))
    return rows.select(*unpacked(passed, "row", text, F.col("text")), *[F.col("x").getField(n).alias(n) for n in names])
