"""Near-duplicate texts by circulant MinHash, banding and exact Jaccard verification.

Two permutations make all signature coordinates. ``SIGMA`` scatters the shingles of a text over the
circle of 2**32 places. ``PI`` is a second fixed permutation of that circle; coordinate ``k`` is the
least value of ``PI`` at the scattered places shifted by ``k``. Coordinates are cut into bands; texts
that agree in a band meet in a bucket, and a link counts only if the full shingle sets satisfy it.

Scale: texts with equal shingle sets are one class from the start, whatever their number. A bucket is
never expanded into all pairs: its members are compared with one pivot, components are joined, and
only members outside their pivot's component are compared again, with another pivot. Texts of buckets
that are still not settled then meet only where they share a shingle rare enough for a link to be
possible; those pairs are verified too, so no link between members of a bucket is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.components import components
from boxloom.llm.scratch import written
from boxloom.llm.words import WordHashes, batches, mix64, shingle_set

_SIGMA = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 16


def _pi(x: np.ndarray) -> np.ndarray:
    """A permutation of the 2**32 places, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def circulant_signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``size`` coordinates (rows) for each non-empty shingle set (columns)."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    places = ((np.concatenate(sets) * _SIGMA) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((size, len(sets)), np.uint32)
    for k in range(size):
        np.minimum.reduceat(_pi(places + np.uint32(k)), starts, out=out[k])
    return out


def band_shape(threshold: float, rows: int = 5, miss: float = 1e-6) -> tuple[int, int]:
    """Rows a band, and the bands needed so that a pair at the threshold escapes with ``miss``."""
    return rows, math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def band_keys(signatures: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key for each text (row) and band (column)."""
    out = np.empty((signatures.shape[1], bands), np.int64)
    for b in range(bands):
        key = np.full(signatures.shape[1], b + 1, np.uint64)
        for row in signatures[b * rows : (b + 1) * rows]:
            key = mix64(key + row)
        out[:, b] = key.view(np.int64)
    return out


def _sketch_udf(rows: int, bands: int):
    words = WordHashes()

    @F.arrow_udf("struct<n:bigint,set_key:binary,bands:array<bigint>>")
    def sketch(texts: pa.Array) -> pa.Array:
        n = np.zeros(len(texts), np.int64)
        keys: list = [None] * len(texts)
        keyed = np.zeros((len(texts), bands), np.int64)
        items = ((i, shingle_set(words.of(t.as_py()))) for i, t in enumerate(texts))
        for some in batches(((i, s) for i, s in items if len(s)), lambda x: len(x[1]), _CHUNK):
            at = [i for i, _ in some]
            keyed[at] = band_keys(circulant_signatures([s for _, s in some], rows * bands), rows, bands)
            for i, s in some:
                n[i] = len(s)
                keys[i] = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
        has = n > 0
        offsets = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keyed[has].ravel()))
        return pa.StructArray.from_arrays(
            [pa.array(n), pa.array(keys, pa.binary()), lists], ["n", "set_key", "bands"]
        )

    return sketch


def _overlap_udf():
    words, held = WordHashes(), {}

    def of(text: str) -> np.ndarray:
        if text not in held:
            if len(held) >= 64:
                held.clear()
            held[text] = shingle_set(words.of(text))
        return held[text]

    @F.arrow_udf("bigint")
    def overlap(left: pa.Array, right: pa.Array) -> pa.Array:
        """Size of the intersection of the two texts' shingle sets."""
        out = []
        for a, b in zip(left, right, strict=True):
            x, y = of(a.as_py()), of(b.as_py())
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            out.append(int((both[1:] == both[:-1]).sum()))
        return pa.array(out, pa.int64())

    return overlap


def _measured(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, na, nb)`` with the size ``inter`` of the intersection, from the full sets."""
    one, two = (texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    joined = pairs.join(one, "a").join(two, "b")
    return joined.withColumn("inter", _overlap_udf()("ta", "tb")).select("a", "b", "na", "nb", "inter")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 85
) -> DataFrame:
    """The rows of ``docs`` with ``n_shingles``, ``component_id``, ``kept`` and ``chosen``.

    Texts are linked if ``100 * intersection >= percent * union`` of their sets of five-word
    shingles (a shorter text is one shingle). ``component_id`` is the smallest ``doc_id`` that links
    reach, and ``kept`` is ``doc_id = component_id``. ``chosen`` marks exactly one row of each component,
    also where ids repeat, and every wordless row. Null or wordless texts link with nothing;
    their component is their own id. Null ids are ignored by the minimum; a component of null ids
    only has a null ``component_id`` and its rows are kept. Repeated rows share a component and are
    kept alike. Other columns pass through, but for old columns of the result names (in any case), which
    are replaced. An empty table gives an empty table.
    """
    rows, bands = band_shape(percent / 100)
    passed, row = packed(docs, ["n_shingles", "component_id", "kept", "chosen"], text)
    base = written(
        docs.select(
            row.alias("row"),
            F.col(text).alias("text"),
            F.col(doc_id).cast("bigint").alias("id"),
            _sketch_udf(rows, bands)(F.col(text)).alias("s"),
        ).select("row", "text", "id", F.monotonically_increasing_id().alias("no"), "s.*")
    )
    first = F.struct(F.col("id").isNull().alias("none"), "id", "no")
    classes = written(
        base.where("n > 0").groupBy("set_key")
        .agg(F.min(first).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    links = _links(base.select("text", "set_key"), classes, percent)
    rooted = classes.join(components(links), "node", "left").select(
        "set_key", "rep", F.coalesce("root", "node").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("least"))
    found = rooted.join(least, "root").select("set_key", "least")
    joined = base.join(found, "set_key", "left")
    component = F.when(F.col("n") > 0, F.col("least.id")).otherwise(F.col("id"))
    return joined.select(
        *unpacked(passed, "row", text, F.col("text")),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        ((F.col("n") == 0) | (F.col("no") == F.col("least.no"))).alias("chosen"),
    )


def _links(texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Verified links ``(a, b)`` between classes, enough of them to join every component."""
    members = classes.select(F.explode("bands").alias("key"), "node", "n")
    crowded = members.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    members = written(members.join(crowded, "key"))
    wanted = members.select("node").distinct().join(classes, "node").select("node", "set_key", "n")
    texts = written(
        texts.join(wanted, "set_key").groupBy("node").agg(F.first("text").alias("text"), F.first("n").alias("n"))
    )
    linked = F.expr(f"100 * inter >= {percent} * (na + nb - inter)")

    def tested(pairs: DataFrame) -> DataFrame:
        return written(_measured(pairs, texts).where(linked).select("a", "b"))

    # First the least member of each bucket, so that buckets of one group share their pivot.
    links = tested(_pivot_pairs(members.withColumn("root", F.col("node")), F.col("node"), percent))
    stars = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    here = members.join(stars, "node", "left").withColumn("root", F.coalesce("root", "node"))
    links = links.union(tested(_pivot_pairs(here, F.xxhash64("node", "key"), percent)))
    roots = components(links)
    here = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = here.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    unsettled = here.join(open_, "key", "left_semi").select("node", "root").distinct()
    more = tested(_rare_shingle_pairs(texts.join(unsettled, "node"), percent))
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)


def _pivot_pairs(members: DataFrame, rank, percent: int) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, the least by ``rank``, if their roots differ."""
    pivots = members.groupBy("key").agg(
        F.min(F.struct(rank.alias("rank"), "node", "n", "root")).alias("p"),
        F.min("root").alias("lo"), F.max("root").alias("hi"),
    ).where("lo <> hi")
    return members.join(pivots, "key").where("root <> p.root").selectExpr(
        "greatest(node, p.node) AS a", "least(node, p.node) AS b",
        "if(node > p.node, n, p.n) AS na", "if(node > p.node, p.n, n) AS nb",
    ).where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").distinct()


def _rare_shingle_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may still be linked: no linked pair is left out.

    Shingles are ranked in each text from the rarest on. Texts that share ``o`` shingles have one in
    common among their first ``n - o + 1``, and what follows it bounds the rest of the intersection
    (the prefix and positional bounds of set-similarity joins). So texts that are only roughly alike,
    each with changes of its own, do not meet however many they are.
    """
    words = WordHashes()

    @F.arrow_udf("array<bigint>")
    def listed(texts: pa.Array) -> pa.Array:
        return pa.array((shingle_set(words.of(t.as_py())).view(np.int64) for t in texts), pa.list_(pa.int64()))

    tokens = written(nodes.select("node", "root", "n", F.explode(listed.asNondeterministic()("text")).alias("sh")))
    often = tokens.groupBy("sh").agg(F.count(F.lit(1)).alias("df"))
    ranked = (
        tokens.join(often, "sh")
        .withColumn("i", F.row_number().over(Window.partitionBy("node").orderBy("df", "sh")))
        .where(f"df > 1 AND i <= n - ({percent} * n + 99) div 100 + 1")
    )
    x = ranked.selectExpr("sh", "node AS x", "n AS nx", "root AS rx", "i AS ix")
    y = ranked.where(f"i <= n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1")
    y = y.selectExpr("sh", "node AS y", "n AS ny", "root AS ry", "i AS iy")
    near = (
        f"rx <> ry AND (ny < nx OR ny = nx AND y < x) AND 100 * ny >= {percent} * nx "
        f"AND {100 + percent} * (1 + least(nx - ix, ny - iy)) >= {percent} * (nx + ny)"
    )
    return x.join(y, (x.sh == y.sh) & F.expr(near)).selectExpr(
        "greatest(x, y) AS a", "least(x, y) AS b", "if(x > y, nx, ny) AS na", "if(x > y, ny, nx) AS nb"
    ).distinct()
