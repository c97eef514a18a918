"""Byte-level BPE encoding and decoding, giant texts by overlapping chunks.

A text is cut into pre-tokens by the tokenizer's pattern; in each, the
neighbouring parts of lowest rank are joined until none has a rank. Ordinary
texts take one pass. A giant text is split into chunks, each with some of what
follows it. All chunks are pre-tokenised apart from each other, from wherever
they start. Where the end of one and the start of the next agree on a certain
boundary, their pre-tokens have resynchronised: there the text is stitched, and
the stretches between stitches are encoded in parallel. Chunks whose overlap
has no such place (an endless word) are encoded together, so every text gets
the ids that it has as a whole. Decoding concatenates the bytes of the ids.

A boundary is certain if no pre-token can cross it, whatever comes before: the
end of a run of letters or of digits, and a blank or digit after another sign.
Only an apostrophe may join what follows it, and blanks only what they precede.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import fresh, runs_of, small_enough, stored, text_of

CHUNK = 65_536
OVERLAP = 1024
MEMO = 300_000  # stretches remembered by a task
LONGEST = 64  # characters of a remembered stretch, bytes of a pre-token that is merged with others
WORDS = 20_000  # pre-tokens merged together
SHORT = 400  # bytes up to which parts are searched one by one
JOINTS_SENT = 500_000  # chunk rows sent to every task
#: The characters with the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NO_RANK = 1 << 40


class BytePairs:
    """Ranks of byte strings, as a file of lines ``base64 rank``, and the pattern that cuts texts."""

    #: No pre-token goes on after a run of other characters than blanks.
    STRETCH = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
    CERTAIN = regex.compile(rf"(?<=\p{{L}})(?=\P{{L}})|(?<=\p{{N}})(?=\P{{N}})|(?<=[^{SPACE}\p{{L}}\p{{N}}])(?=[{SPACE}\p{{N}}])")

    def __init__(self, file: bytes, pattern: str, joins: tuple[np.ndarray, np.ndarray] | None = None):
        self.file, self.pattern = file, pattern
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the ranks must hold all single bytes")
        self.cut = regex.compile(pattern.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]").replace(rf"[^[{SPACE}]", f"[^{SPACE}"))
        self.longest = max(map(len, self.ranks))
        if joins is not None:
            self.joins = joins

    def merged(self, raw: bytes) -> list[int]:
        """Ids of one pre-token: of equal ranks the leftmost pair is joined first."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        ends = self._few(raw) if len(raw) <= SHORT else self._many(raw)
        return [self.ranks[raw[a:b]] for a, b in zip(ends, ends[1:])]

    def _few(self, raw: bytes) -> list[int]:
        ends, get = list(range(len(raw) + 1)), self.ranks.get
        pairs = [get(raw[i : i + 2], NO_RANK) for i in range(len(raw) - 1)]
        while pairs and (least := min(pairs)) < NO_RANK:
            i = pairs.index(least)
            del ends[i + 1], pairs[i]
            if i:
                pairs[i - 1] = get(raw[ends[i - 1] : ends[i + 1]], NO_RANK)
            if i < len(pairs):
                pairs[i] = get(raw[ends[i] : ends[i + 2]], NO_RANK)
        return ends

    def _many(self, raw: bytes) -> list[int]:
        """The same by a heap of pairs and links between parts: a long pre-token takes n log n steps."""
        n, get, longest = len(raw), self.ranks.get, self.longest
        after, before = list(range(1, n + 2)), list(range(-1, n))
        rank = [get(raw[i : i + 2], NO_RANK) for i in range(n)]
        rank[n - 1] = NO_RANK
        heap = [r * n + i for i, r in enumerate(rank) if r < NO_RANK]
        heapify(heap)
        while heap:
            r, i = divmod(heappop(heap), n)
            if rank[i] != r:  # changed since
                continue
            gone = after[i]
            rank[gone] = -1
            after[i] = after[gone]
            if after[i] <= n:
                before[min(after[i], n)] = i
            for at in (before[i], i):
                if at < 0:
                    continue
                end = after[after[at]] if after[at] < n else None
                new = NO_RANK if end is None or end - at > longest else get(raw[at:end], NO_RANK)
                rank[at] = new
                if new < NO_RANK:
                    heappush(heap, new * n + at)
        ends = [0]
        while ends[-1] < n:
            ends.append(after[ends[-1]])
        return ends

    @cached_property
    def joins(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of ids whose bytes together have a rank, as sorted numbers ``left * width + right``, and that rank."""
        get = self.ranks.get
        found = [(get(raw[:k]), get(raw[k:]), rank) for raw, rank in self.ranks.items() for k in range(1, len(raw))]
        found = np.array([f for f in found if f[0] is not None and f[1] is not None], np.int64).reshape(-1, 3)
        codes = found[:, 0] * self.width + found[:, 1]
        order = np.argsort(codes)
        return codes[order], found[order, 2]

    @property
    def width(self) -> int:
        return max(self.ranks.values()) + 1

    def merged_all(self, words: list[bytes]) -> list[bytes]:
        """What :meth:`merged` gives for each word, packed in four bytes an id: in every round all words join their leftmost pair of least rank."""
        codes, ranks = self.joins
        width, out = self.width, [None] * len(words)

        def pair_ranks(left, right):
            code = left * width + right
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            return np.where(codes[at] == code, ranks[at], NO_RANK)

        single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        ids = single[np.frombuffer(b"".join(words), np.uint8)]
        size, word = np.array([len(w) for w in words]), np.arange(len(words))
        pairs = np.r_[pair_ranks(ids[:-1], ids[1:]), NO_RANK]
        pairs[np.cumsum(size) - 1] = NO_RANK
        while len(word):
            start = np.cumsum(size) - size
            least = np.minimum.reduceat(pairs, start)
            ready = least == NO_RANK
            if ready.any():  # these words are done and leave
                packed = ids.astype(np.int32).tobytes()
                for w, a, n in zip(word[ready].tolist(), (4 * start[ready]).tolist(), (4 * size[ready]).tolist()):
                    out[w] = packed[a : a + n]
                keep = np.repeat(~ready, size)
                ids, pairs, size, word, least = ids[keep], pairs[keep], size[~ready], word[~ready], least[~ready]
                if not len(word):
                    break
                start = np.cumsum(size) - size
            hits = np.flatnonzero(pairs == np.repeat(least, size))
            owner = np.searchsorted(start, hits, side="right") - 1
            at = hits[np.r_[True, owner[1:] != owner[:-1]]]  # one place per word
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # one place went in each word before
            ids, pairs, size = ids[keep], pairs[keep], size - 1
            end = np.cumsum(size)
            start = end - size
            last = at + 1 == end
            pairs[at] = np.where(last, NO_RANK, pair_ranks(ids[at], ids[np.minimum(at + 1, len(ids) - 1)]))
            later = at[at > start]
            pairs[later - 1] = pair_ranks(ids[later - 1], ids[later])
        return out

    def encode(self, texts: list[str], memo: dict[str, bytes]) -> list[np.ndarray]:
        """Ids of each text; stretches that the memo lacks are encoded together first."""
        cuts = [self.STRETCH.findall(t) for t in texts]
        new = set(chain.from_iterable(cuts)) - memo.keys()
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = set(chain.from_iterable(cuts))
        parts = {stretch: self.cut.findall(stretch) for stretch in new}
        known = {}
        for part in set(chain.from_iterable(parts.values())):
            raw = part.encode()
            rank = self.ranks.get(raw)
            if rank is not None or len(raw) > LONGEST:
                known[part] = np.array(self.merged(raw), np.int32).tobytes()
        words = [part for part in set(chain.from_iterable(parts.values())) if part not in known]
        for at in range(0, len(words), WORDS):
            some = words[at : at + WORDS]
            known.update(zip(some, self.merged_all([w.encode() for w in some])))
        memo.update((stretch, b"".join(map(known.__getitem__, of))) for stretch, of in parts.items())
        ids = [np.frombuffer(b"".join(map(memo.__getitem__, cut)), np.int32) for cut in cuts]
        for stretch in new:
            if len(stretch) > LONGEST:
                del memo[stretch]
        return ids

    @cached_property
    def token(self) -> dict[int, bytes]:
        return {rank: raw for raw, rank in self.ranks.items()}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def marks(self, window: str, lo: int, hi: int) -> list[int]:
        """Pre-token starts in ``[lo, hi)`` of a window, cut from its start, that are certain, as places after ``lo``."""
        hi = min(hi, len(window))
        starts = {m.start() for m in self.cut.finditer(window, 0, len(window))}
        return [m.start() - lo for m in self.CERTAIN.finditer(window, lo, len(window)) if m.start() < hi and m.start() in starts]


def load_ranks(path: str, pattern: str) -> BytePairs:
    with open(path, "rb") as file:
        return BytePairs(file.read(), pattern)


def _shared(df: DataFrame, pairs: BytePairs):
    """The rank file's bytes and its pairs for all tasks; both are as long as the vocabulary, here under a megabyte and 4 MB."""
    return df.sparkSession.sparkContext.broadcast((pairs.file, pairs.pattern, pairs.joins))


def encode(
    docs: DataFrame, pairs: BytePairs, text: str = "text", out: str = "tokens", decoded: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``docs`` with the ids of each text in ``out`` (``array<int>``, replaced if there).

    ``decoded`` names a string column with the text that decoding the ids gives,
    made where they are encoded. Empty and null texts have no ids and decode to
    the empty text. ``chunk`` and ``overlap`` do not change the ids. All rows are
    kept, repeated ones too; other columns pass through. No rows give no rows.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be above 0 and no longer than a chunk")
    docs = docs.drop(out, *([decoded] if decoded else []))
    shared = _shared(docs, pairs)
    both, back = fresh(docs, "both", "back")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pairs, memo = BytePairs(*shared.value), {}
        for texts in batches:
            for part in runs_of(texts.fillna("").tolist()):
                ids = pairs.encode(part, memo)
                yield pd.DataFrame({"ids": ids, "back": [pairs.decode(i.tolist()).decode("utf-8", "replace") if decoded else "" for i in ids]})

    coded = F.pandas_udf(run, "ids array<int>, back string")
    long = F.length(text_of(text)) > chunk
    done = docs.where(~long).withColumn(both, coded(F.col(text))).select(*docs.columns, F.col(both)["ids"].alias(out), F.col(both)["back"].alias(back))
    found = done.unionByName(_giants(docs.where(long), shared, coded, text, out, back, chunk, overlap))
    return found.withColumnRenamed(back, decoded) if decoded else found.drop(back)


def _giants(docs: DataFrame, shared, coded, text: str, out: str, back: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks are stored once, dealt to tasks one by one, with the row's other columns on its first chunk."""
    row, at, part, rest, start, after, run = fresh(docs, "row", "at", "part", "rest", "start", "after", "run")
    others = [c for c in docs.columns if c != text]

    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[t[k : k + chunk + overlap] for k in range(0, len(t), chunk)] for t in texts], dtype=object)

    def agree(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pairs = BytePairs(*shared.value)
        for windows in batches:
            yield pd.DataFrame({"head": [pairs.marks(w[:overlap], 0, overlap) for w in windows], "tail": [pairs.marks(w, chunk, chunk + overlap) for w in windows]})

    parts = docs.select(F.monotonically_increasing_id().alias(row), (F.struct(*others) if others else F.struct(F.lit(0))).alias(rest), F.pandas_udf(split, "array<string>")(F.col(text)).alias(part))
    parts = parts.select(row, rest, F.posexplode(part).alias(at, part)).withColumn(rest, F.when(F.col(at) == 0, F.col(rest)))
    chunks = stored(parts.repartition(row, at), "byte-pair-chunks")

    order = Window.partitionBy(row).orderBy(at)
    marks = chunks.select(row, at, F.pandas_udf(agree, "head array<int>, tail array<int>")(F.col(part)).alias("m")).select(row, at, "m.*")
    stitch = F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))
    joints = marks.select(row, at, F.when(F.col(at) == 0, 0).otherwise(stitch).alias(start))
    # a chunk without a stitch belongs to the last one that has it
    first = F.last(F.when(F.col(start).isNotNull(), F.col(at)), ignorenulls=True).over(order)
    last = F.lead(at).over(order).isNull()
    joints = joints.select(row, at, start, first.alias(run), F.lead(start).over(order).alias(after), last.alias("last"))
    joints = small_enough(stored(joints, "byte-pair-joints"), JOINTS_SENT)

    begin = F.coalesce(F.col(start), F.lit(0))
    end = F.when(F.col("last"), F.length(part)).otherwise(chunk + F.coalesce(F.col(after), F.lit(0)))
    alone = (F.col(run) == F.col(at)) & (F.col("last") | F.col(after).isNotNull())
    pieces = chunks.join(joints, [row, at]).select(row, at, run, rest, alone.alias("alone"), F.substring(part, begin + 1, end - begin).alias(part))
    texts = F.transform(F.array_sort(F.collect_list(F.struct(at, part))), lambda x: x[part])
    united = pieces.where("not alone").groupBy(row, run).agg(F.any_value(rest, True).alias(rest), F.concat_ws("", texts).alias(part))
    stretches = pieces.where("alone").select(row, run, rest, part).unionByName(united).withColumn(out, coded(F.col(part)))
    whole = stretches.groupBy(row).agg(F.any_value(rest, True).alias(rest), F.array_sort(F.collect_list(F.struct(run, part, out))).alias(part))
    return whole.select(
        *(F.concat_ws("", F.col(f"{part}.{part}")).alias(text) if c == text else F.col(rest)[c].alias(c) for c in docs.columns),
        F.flatten(F.col(f"{part}.{out}.ids")).alias(out),
        F.concat_ws("", F.col(f"{part}.{out}.back")).alias(back),
    )


def decode(df: DataFrame, pairs: BytePairs, tokens: str = "tokens", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each row's ids in ``out`` (``binary``); no ids and null give no bytes, an unknown id raises."""
    df = df.drop(out)
    shared = _shared(df, pairs)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pairs = BytePairs(*shared.value)
        for ids in batches:
            yield pd.Series([b"" if x is None else pairs.decode(x.tolist()) for x in ids], dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "binary")(F.col(tokens)))
