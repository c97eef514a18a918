"""Exact Jaccard join of word shingles by count vectors.

Shingle hashes are dealt into groups and a document becomes the point of its
group counts. If two sets have Jaccard similarity t, at most D =
(1-t)/(1+t) * (|x|+|y|) shingles are in one of them only, so their points
differ by D in all. The index has two levels.

* Directory: the groups are dealt into more than D blocks, so that similar documents
  have the same point in at least one block. The blocks of a document, which
  use fine groups (their point is a hash of the block's shingles), are its directory keys; a
  document that fills more than D blocks needs the first D + 1 of these alone.
  Nothing similar is ever missed, and unlike a single shingle a block is
  rarely shared by chance, even through a passage that many documents hold.
* Pages: documents that directory keys bring together are paged by size, with the
  least and greatest size and the greatest count per coarse group. A pair of pages, then of
  documents, survives if the sum of coordinate minima can reach the overlap that t asks
  for. Survivors are verified on the whole sets.

The blocks allow for the greatest D of a size class. A pair differs in its own D blocks at
most, so it shares several keys, how many is known from the sizes. A document that has fewer
in common with others than its size asks for is dropped, and of the rest only its rarest keys
bring it together with others: a passage in many documents doesn't.

Equal sets are linked by their hash, and only the first of them is looked up further. Each
document is then paired with one leader only, and components are
formed. Pages are joined just where a key still holds several
components, so a group of near copies costs a link per copy, not all pairs, and no link
that joins components is lost. All keys are shuffled once, and a window finds those that several
documents have: a task holds a hot key's (key, id) rows, one per document, and spills them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.common import checkpointed, runs_of, small_enough, stored
from featuremart.llm.components import components

GROUPS = 256
BLANK = np.array([9, 10, 11, 12, 13, 32])
STRETCH = 1 << 18  # bytes of text that are hashed at a time
FULL = 32767  # the greatest count of a group, which stands for itself and more
PAGE = 4096  # documents of a page
FOLDED = 32  # groups of a page's bounds: sums of every 32nd count
IDS_SENT = 2_000_000  # ids of documents to verify that are sent to every task
RATIO = 1.6  # size classes of the directory
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(29))
    x = x * _MIX[3]
    return x ^ (x >> np.uint64(32))


def _letters() -> np.ndarray:
    """A number for each byte: A-Z as a-z, blanks as 0."""
    out = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MIX[1])
    out[65:91] = out[97:123]
    out[BLANK] = 0
    return out


@functools.lru_cache(4)
def _powers(n: int, base: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64."""
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])


def _words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after another, and each text's number of words."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
    inside = ~np.isin(np.arange(256), BLANK)[raw]
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    n = np.diff(np.searchsorted(start, np.r_[0, 1 + np.cumsum([len(x) + 1 for x in parts])]))
    if not len(start):
        return np.empty(0, np.uint64), n
    # a polynomial in the place of a byte, divided by that of the word's place; a stretch of words at a time
    letters, out, base = _letters(), [], int(_MIX[0])
    cut = np.r_[np.flatnonzero(np.diff(start // STRETCH, prepend=-1)), len(start)].tolist()
    for i, j in zip(cut, cut[1:]):
        lo, hi = int(start[i]), int(start[j]) if j < len(start) else len(raw)
        size, at = 1 << (hi - lo).bit_length(), start[i:j] - lo
        h = np.add.reduceat(letters[raw[lo:hi]] * _powers(size, base)[: hi - lo], at)
        out.append(_mix(h * _powers(size, pow(base, -1, 1 << 64))[at]))
    return np.concatenate(out), n


def shingle_sets(texts: Sequence[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles, one text after another, and their numbers.

    A text with fewer words is one shingle.
    """
    h, n_words = _words(texts)

    def mixed(h: np.ndarray, width: int) -> np.ndarray:
        n = len(h) - width + 1
        out = np.full(n, width, np.uint64)
        for k in range(width):
            out = _mix(out * _MIX[1] + h[k : k + n])
        return out

    whole = mixed(h, words) if len(h) >= words else np.empty(0, np.uint64)
    parts = []
    for at, n in zip((np.cumsum(n_words) - n_words).tolist(), n_words.tolist()):
        parts.append(whole[at : at + n - words + 1] if n >= words else mixed(h[at : at + n], n) if n else whole[:0])
        parts[-1].sort()
    values, n = np.concatenate([*parts, whole[:0]]), np.array([len(x) for x in parts], np.int64)
    of = np.repeat(np.arange(len(n)), n)
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.bincount(of[new], minlength=len(n))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; a shorter text is one shingle."""
    return shingle_sets([text], words)[0]


class Directory:
    """Which keys a set of a given size has, for similarity ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent

    def class_of(self, n: int) -> int:
        c = int(math.log(n) / math.log(RATIO))
        while RATIO ** (c + 1) <= n:
            c += 1
        while RATIO**c > n:
            c -= 1
        return c

    def classes(self, n: int) -> list[int]:
        """Own class, and the one below if a similar set may be that small."""
        c = self.class_of(n)
        least = -(-self.percent * n // 100)
        return [c] if c == 0 or least >= RATIO**c else [c, c - 1]

    def differences(self, c: int) -> int:
        """Most shingles in one set only, for a similar pair whose smaller set is of class ``c``."""
        x = math.ceil(RATIO ** (c + 1)) - 1
        y = 100 * x // self.percent
        return (100 - self.percent) * (x + y) // (100 + self.percent)

    def shared(self, c: int, n: int, other: int) -> int:
        """How many keys of class ``c`` at least similar sets of these sizes share, the smaller of class ``c``.

        Up to the block where the first of them has all its keys each has a key per filled block, d + 1 at least
        in one of them, and each block in which they differ holds a shingle that is in one of them only.
        """
        return self.differences(c) + 1 - (100 - self.percent) * (n + other) // (100 + self.percent)

    def needs(self, n: int) -> list[int]:
        """How many even and odd keys a set of this size shares at least with a similar one; 0 where it has none."""
        out, own = [0, 0], self.class_of(n)
        for c in self.classes(n):
            largest = 100 * n // self.percent if c == own else math.ceil(RATIO ** (c + 1)) - 1
            out[c & 1] = self.shared(c, n, largest)
        return out

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The keys of a set; those of even classes are even."""
        return self.keys_of(s, np.array([len(s)]))[0]

    def keys_of(self, values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """The keys of sets that lie one after another and are sorted."""
        held = [self.classes(n) if n else [] for n in sizes.tolist()]
        first = np.cumsum(sizes) - sizes
        whole = np.flatnonzero([len(c) > 0 for c in held])
        below = np.flatnonzero([len(c) > 1 for c in held])
        own = self._keys(values, sizes[whole], [held[i][0] for i in whole])
        inner = np.concatenate([np.arange(0), *(np.arange(first[i], first[i] + sizes[i]) for i in below)])
        lower = self._keys(values[inner], sizes[below], [held[i][1] for i in below])
        out = [np.empty(0, np.int64)] * len(sizes)
        for i, k in zip(whole.tolist(), own):
            out[i] = k
        for i, k in zip(below.tolist(), lower):
            out[i] = np.concatenate([out[i], k])
        return out

    def _keys(self, values: np.ndarray, sizes: np.ndarray, classes: Sequence[int]) -> list[np.ndarray]:
        if not len(sizes):
            return []
        known = {c: self.differences(c) for c in set(classes)}
        c, d = np.array(classes, np.uint64), np.array([known[c] for c in classes])
        # an empty block is shared by much that is not alike; with this many blocks nearly every set fills more than d
        m = (d + 1 + d // 2).astype(np.uint64)
        block = ((values >> np.uint64(32)) * np.repeat(m, sizes)) >> np.uint64(32)
        of = np.repeat(np.arange(len(sizes)), sizes)
        start = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (of[1:] != of[:-1])])
        point, own, of = np.add.reduceat(_mix(values ^ _MIX[2]), start), block[start], of[start]
        filled = np.bincount(of, minlength=len(sizes))
        begin = np.cumsum(filled) - filled
        # among the first d + 1 filled blocks of the set that gets there sooner one is equal, and both sets have it
        kept = np.arange(len(own)) - begin[of] <= d[of]
        key = lambda point, own, c: (_mix(point + _mix(own + (c << np.uint64(40)))) & ~np.uint64(1) | c & np.uint64(1)).view(np.int64)
        out = np.split(key(point[kept], own[kept], c[of[kept]]), np.cumsum(np.minimum(filled, d + 1))[:-1])
        for i in np.flatnonzero(filled <= d):  # too few filled blocks to be sure: empty ones count as well
            empty = np.setdiff1d(np.arange(m[i], dtype=np.uint64), own[begin[i] : begin[i] + filled[i]])
            out[i] = np.concatenate([out[i], key(np.zeros(len(empty), np.uint64), empty, c[i])])
        return out


def _frame(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())


def _sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, n, h, c, needs, keys``: size, hash of the set, group counts, how many keys it must share, directory keys. Texts are hashed once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        directory = Directory(percent)
        for batch in batches:
            for texts in runs_of(batch["text"].fillna("").tolist()):
                part, batch = batch.iloc[: len(texts)], batch.iloc[len(texts) :]
                values, n = shingle_sets(texts, words)
                of = np.repeat(np.arange(len(n)), n)
                counts = np.bincount(of * GROUPS + (values & np.uint64(GROUPS - 1)).astype(np.int64), minlength=len(n) * GROUPS)
                counts = np.minimum(counts, FULL).astype(np.int16).reshape(len(n), GROUPS)
                h = np.zeros(len(n), np.uint64)
                np.add.at(h, of, _mix(values ^ _MIX[0]))
                needs = [directory.needs(k) if k else [0, 0] for k in n.tolist()]
                rows = {"id": part["id"].to_numpy(), "n": n, "h": h.view(np.int64), "c": list(counts), "needs": needs, "keys": directory.keys_of(values, n)}
                yield pd.DataFrame(rows)

    return docs.mapInPandas(run, "id bigint, n bigint, h bigint, c array<smallint>, needs array<int>, keys array<bigint>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for texts in runs_of(part["text"].fillna("").tolist()):
                ids, part = part["id"].to_numpy()[: len(texts)], part.iloc[len(texts) :]
                values, n = shingle_sets(texts, words)
                yield pd.DataFrame({"id": ids, "s": np.split(values.view(np.int64), np.cumsum(n)[:-1])})

    return docs.mapInPandas(run, "id bigint, s array<bigint>")


def _minima(a: Column, b: Column) -> Column:
    """Sum of coordinate minima; the greatest count stands for itself and more."""
    least = lambda x, y: F.when((x == FULL) & (y == FULL), F.lit(1 << 40)).otherwise(F.least(x, y).cast("bigint"))
    return F.aggregate(F.zip_with(a, b, least), F.lit(0).cast("bigint"), lambda t, x: t + x)


def _reaches(overlap: Column, na: Column, nb: Column, percent: int) -> Column:
    return overlap * (100 + percent) >= (na + nb) * percent


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are similar: bounded by their points, then compared in full."""
    pairs = checkpointed(pairs)
    ends = small_enough(checkpointed(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()), IDS_SENT)
    paired = sketches.join(ends, "id", "left_semi")
    side = lambda x: paired.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("h").alias(f"h{x}"), F.col("c").alias(f"c{x}"))
    sized = pairs.join(side("b"), "b").join(side("a"), "a").where(_reaches(F.least("na", "nb"), F.col("na"), F.col("nb"), percent))
    near = sized.where(_reaches(_minima(F.col("ca"), F.col("cb")), F.col("na"), F.col("nb"), percent))
    near = stored(near.select("a", "b", ((F.col("ha") == F.col("hb")) & (F.col("na") == F.col("nb"))).alias("same")), "jaccard-near")
    open_ = near.where("not same").select("a", "b").distinct()

    def of(x: str) -> DataFrame:
        wanted = small_enough(checkpointed(open_.select(F.col(x).alias("id")).distinct()), IDS_SENT)
        return _sets(docs.join(wanted, "id", "left_semi"), words).select(F.col("id").alias(x), F.col("s").alias(f"s{x}"))

    both = open_.join(of("b"), "b").join(of("a"), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = both.where(_reaches(common.cast("bigint"), F.size("sa"), F.size("sb"), percent)).select("a", "b")
    return checkpointed(near.where("same").select("a", "b").union(alike).distinct())


def _best(tries: DataFrame, *per: str) -> DataFrame:
    """Of the pairs ``a, id`` of each ``per``, the one that shares most keys, as ``a, b``."""
    counted = tries.groupBy("a", *per).count()
    best = counted.groupBy(*per).agg(F.max(F.struct("count", (-F.col("a")).alias("a"))).alias("m"))
    return best.select((-F.col("m.a")).alias("a"), F.col("id").alias("b"))


def _odd() -> Column:
    """The parity of a key, which is that of its size class."""
    return F.col("key").bitwiseAND(1).cast("int")


def _meeting(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """Of ``key, id, comp`` the rows that can still bring similar documents of two components together.

    Adds ``a``, the least id of the key, and ``held``, its number of rows. Documents with fewer keys than
    they must share go, then keys of one component, which leaves others with too few: again while it helps.
    """
    per_key = Window.partitionBy("key")
    before = rows.count()
    while True:
        enough = rows.groupBy("id", _odd().alias("odd")).count().join(needs, ["id", "odd"]).where("count >= need")
        enough = small_enough(checkpointed(enough.select("id", "odd")), IDS_SENT)
        left = rows.withColumn("odd", _odd()).join(enough, ["id", "odd"], "left_semi").select("key", "id", "comp")
        sides = {"a": F.min("id").over(per_key), "held": F.count("*").over(per_key), "lo": F.min("comp").over(per_key), "hi": F.max("comp").over(per_key)}
        rows = stored(left.withColumns(sides).where("lo < hi").drop("lo", "hi"), "jaccard-meeting")
        after = rows.count()
        if after >= 0.8 * before:
            return rows
        before = after


def _rarest(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """The rows of each document's rarest keys, as many as one must be among to be shared with a similar document.

    Of the keys that two documents share the rarest is among these in both: as many
    shared ones as they need but one come after it.
    """
    per_id = Window.partitionBy("id", "odd")
    ranked = rows.withColumn("odd", _odd()).join(needs, ["id", "odd"]).withColumns({"total": F.count("*").over(per_id), "at": F.row_number().over(per_id.orderBy("held", "key"))})
    per_key = Window.partitionBy("key")
    sides = {"a": F.min("id").over(per_key), "lo": F.min("comp").over(per_key), "hi": F.max("comp").over(per_key)}
    return ranked.where("at <= total - need + 1").select("key", "id", "comp").withColumns(sides).where("lo < hi")


def _within(left: pd.DataFrame, right: pd.DataFrame, same: bool, percent: int, several: bool) -> list[tuple[int, int]]:
    """Pairs of two pages that share a key, or ``several``, as many as they must, and whose sizes and coordinate minima can reach the overlap asked for."""
    out = []
    if not len(left) or not len(right):
        return out
    directory = Directory(percent)
    known = {n: directory.differences(directory.class_of(n)) for n in {*left["n"].tolist(), *right["n"].tolist()}}
    points = np.stack(right["c"].to_numpy())
    sizes, ids, comps = (right[c].to_numpy() for c in ("n", "id", "comp"))
    allowed = np.array([known[n] for n in sizes.tolist()])
    keys, row = np.concatenate(right["keys"].to_numpy()), np.repeat(np.arange(len(right)), right["keys"].map(len))
    order = np.argsort(keys, kind="stable")
    keys, row = keys[order], row[order]
    for n, i, comp, point, own in zip(left["n"].tolist(), left["id"], left["comp"], left["c"], left["keys"]):
        lo = np.searchsorted(keys, own)
        held = np.searchsorted(keys, own, side="right") - lo
        hits = np.arange(held.sum()) + np.repeat(lo - np.cumsum(held) + held, held)
        shared = np.bincount(row[hits], minlength=len(sizes))
        need = np.where(sizes < n, allowed, known[n]) + 1 - (100 - percent) * (sizes + n) // (100 + percent) if several else 1
        fits = (sizes * 100 >= percent * n) & (sizes * percent <= 100 * n)
        other = np.flatnonzero((shared >= np.maximum(need, 1)) & fits & (comps != comp) & ((ids > i) | (not same)))
        for at in range(0, len(other), 4096):
            part = other[at : at + 4096]
            overlap = np.minimum(points[part], point).sum(1, dtype=np.int64)
            full = ((points[part] == FULL) & (point == FULL)).any(1)
            good = part[full | (overlap * (100 + percent) >= (sizes[part] + n) * percent)]
            out += [(min(i, j), max(i, j)) for j in ids[good].tolist()]
    return out


def _page_pairs(open_: DataFrame, sketches: DataFrame, percent: int, needs: DataFrame | None = None) -> DataFrame:
    """Pairs of documents of different components that the bounds of pages and points leave.

    Documents that share keys, directly or through others, are a family; with ``needs`` (how many keys an
    id must share) their rarest ones. A family of at most PAGE
    documents is one page, and such pages travel together. A larger one is paged by
    size, then at random. Pages of a family meet if their bounds allow it. Each document brings
    its keys: similar ones share several themselves, and the points of long texts bound little.
    """
    rare = open_.withColumn("a", F.min("id").over(Window.partitionBy("key"))) if needs is None else _rarest(open_, needs)
    family = components(rare.select("a", F.col("id").alias("b"))).select("id", F.col("component").alias("family"))
    docs = open_.join(small_enough(family, IDS_SENT), "id").groupBy("id", "comp", "family").agg(F.collect_set("key").alias("keys"))
    points = sketches.where("n > 0").select("id", "n", "c").join(small_enough(family.select("id"), IDS_SENT), "id", "left_semi")
    full = stored(docs.join(points, "id"), "jaccard-points")
    sizes = checkpointed(full.groupBy("family").count())
    large = F.col("count") > PAGE
    small_docs = sizes.where(~large).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    lots = max(1, -(-small_docs // PAGE))
    step = F.floor(F.log("n") / math.log(1.05)).cast("bigint")
    placed = full.join(small_enough(sizes, IDS_SENT), "family").withColumn("step", F.when(large, step).otherwise(0))
    parts = placed.where(large).groupBy("family", "step").agg(F.ceil(F.count("*") / PAGE).alias("parts"))
    placed = placed.join(small_enough(checkpointed(parts), IDS_SENT), ["family", "step"], "left")
    page = F.when(large, F.col("step") * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("parts"))).otherwise(0)
    lot = F.when(large, F.col("family")).otherwise(-1 - F.pmod(F.xxhash64("family"), F.lit(lots)))
    placed = stored(placed.select("id", "comp", "keys", "family", "n", "c", lot.alias("lot"), page.alias("page"), large.alias("large")), "jaccard-placed")

    folded = F.transform(F.sequence(F.lit(0), F.lit(FOLDED - 1)), lambda g: F.aggregate(F.sequence(g, F.lit(GROUPS - 1), F.lit(FOLDED)), F.lit(0), lambda t, i: t + F.get("c", i)))
    top = [F.max(F.get("f", i)).alias(f"t{i}") for i in range(FOLDED)]
    pages = placed.withColumn("f", folded).groupBy("lot", "page", "large").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), *top)
    pages = checkpointed(pages.select("lot", "page", "large", "lo", "hi", F.array(*(f"t{i}" for i in range(FOLDED))).alias("t")))
    side = lambda x: pages.select("lot", *(F.col(c).alias(f"{c}{x}") for c in ("page", "large", "lo", "hi", "t")))
    met = side("a").join(side("b"), "lot").where("pagea <= pageb")
    reach = _reaches(_minima(F.col("ta"), F.col("tb")), F.col("loa"), F.col("lob"), percent)
    fits = F.expr(f"hia * 100 >= lob * {percent} and hib * 100 >= loa * {percent}")
    met = checkpointed(met.where(~F.col("largea") | (reach & fits)).select("lot", "pagea", "pageb"))

    several = needs is not None

    def meet(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        if len(one) and one["pagea"].iloc[0] == one["pageb"].iloc[0]:
            found = [p for _, g in one.groupby("family") if g["comp"].nunique() > 1 for p in _within(g, g, True, percent, several)]
        else:
            found = _within(one, two, False, percent, several)
        return pd.DataFrame(found, columns=["a", "b"])

    columns = ["lot", "pagea", "pageb", "id", "comp", "keys", "family", "n", "c"]
    held = lambda x: placed.select("lot", F.col("page").alias(f"page{x}"), "id", "comp", "keys", "family", "n", "c")
    one = met.join(held("a"), ["lot", "pagea"]).select(*columns).toDF(*columns)
    two = met.where("pagea < pageb").join(held("b"), ["lot", "pageb"]).select(*columns).toDF(*columns)
    keys = ["lot", "pagea", "pageb"]
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(meet, "a bigint, b bigint").distinct()


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """``(sketches, members)``: ``id, n, h, c`` of every row, and ``id, component`` of the linked ids.

    Documents link when 100 * common shingles >= ``percent`` * shingles in either, for a percent of at
    least 63. Ids must be whole numbers. Texts are
    lower-cased in A-Z; fewer words than a shingle are one shingle; texts without words link with
    nothing. Rows with a null id link with nothing. Rows that repeat an id
    are one node: it has the links of all its texts. Extra columns are ignored.
    Sets are compared as 64-bit hashes of their shingles.
    """
    if not 63 <= percent <= 100:
        raise ValueError("percent must be from 63 to 100: the directory holds a set's own size class and the one below")
    if not isinstance(docs.schema[id].dataType, T.IntegralType):
        raise TypeError(f"{id} must be an integral column")
    light = _frame(docs, id, text)
    whole = stored(_sketches(light, words, percent), "jaccard-sketches")
    sketches = whole.drop("needs", "keys")
    needs = whole.where("n > 0").select("id", F.posexplode("needs").alias("odd", "need")).where("need > 0")
    needs = stored(needs.groupBy("id", "odd").agg(F.min("need").alias("need")), "jaccard-needs")
    # equal sets need no keys but those of the smallest id
    groups = stored(sketches.where("n > 0").groupBy("n", "h").agg(F.min("id").alias("a"), F.max("id").alias("z")), "jaccard-sets")
    copies = sketches.join(groups.where("a < z"), ["n", "h"]).where("a < id").select("a", F.col("id").alias("b")).distinct()
    copies = checkpointed(copies)
    first = groups.select(F.col("a").alias("id")).distinct()
    gone = checkpointed(copies.select(F.col("b").alias("id")).distinct().join(first, "id", "left_anti"))
    rows = whole.join(small_enough(gone, IDS_SENT), "id", "left_anti").select(F.explode("keys").alias("key"), "id")
    # most keys have one document; these rows are shuffled once and go before anything is stored
    per_key = Window.partitionBy("key")
    held = rows.withColumns({"a": F.min("id").over(per_key), "z": F.max("id").over(per_key)}).where("a < z")
    members = _meeting(stored(held.select("key", "id", F.col("id").alias("comp")), "jaccard-members"), needs)
    verified = lambda pairs: _verified(pairs, sketches, light, words, percent)

    # each document with the leader it shares most keys with
    edges = verified(_best(members.where("a <> id"), "id")).union(copies)
    found = components(edges)
    placed = members.join(small_enough(found, IDS_SENT), "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    open_ = _meeting(placed, needs)
    # what is left where a key still holds several components
    if not open_.isEmpty():
        edges = edges.union(verified(_page_pairs(open_, sketches, percent, needs)))
        found = components(edges)
    return sketches, found


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row; an id that nothing links with is its own component.

    A row with a null id has no component; its size is 0.
    """
    sketches, found = similar(docs, id, text, words, percent)
    known = sketches.join(found, "id", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    nameless = docs.where(F.col(id).isNull()).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    return known.union(nameless)


def one_per_group(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and all rows that link with nothing."""
    _, found = similar(docs, id, text, words, percent)
    gone = found.where("id <> component").select(F.col("id").alias(id))
    return docs.join(small_enough(gone, IDS_SENT), id, "left_anti")
