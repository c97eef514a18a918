"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is cut into the pieces of a public vocabulary so that the sum of their scores is
greatest (the unigram reading of the model file). Ordinary texts take one Viterbi
pass. A giant text is split into chunks at fixed places. A boundary's state is
how far the piece across it reaches. Each chunk yields the matrix of best
scores from entry state to exit state; max-plus products of neighbouring
matrices are associative, so prefixes of all chunks come from a scan in
logarithmically many steps, which gives each boundary's state on a best path.
The chunks are then backtraced apart from each other, each between its own two states.

Pieces hold blanks at their start only (checked), so a word's first blank is a
place that no piece crosses. Chunks with such a place have a matrix of rank one
(a column plus a row), and words are looked up in a bounded memo. A chunk
without one takes the full matrix. Characters without a piece are spelled in bytes.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm.common import fresh, small_enough, stored, text_of

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32_768
NONE = -(1 << 60)  # no path
MEMO = 200_000  # words remembered by a task
LONGEST = 64  # characters of a remembered word
WORDS = 4000  # new words of one pass, so that its arrays stay in cache
SLICE = 1_000_000  # characters that a task works on together
STATES_SENT = 500_000  # boundary rows sent to every task


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (b[i] & 127) << shift
        shift += 7
        i += 1
        if b[i - 1] < 128:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a message in the wire format of model files."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        if key & 7 == 0:
            value, i = _varint(b, i)
        elif key & 7 == 2:
            n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        else:
            n = 4 if key & 7 == 5 else 8
            value, i = struct.unpack("<f" if n == 4 else "<d", b[i : i + n])[0], i + n
        yield key >> 3, value


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Vocabulary:
    """Pieces of a model file, blanks written as blanks. Scores are whole numbers, so sums are exact."""

    def __init__(self, model: bytes, scale: int = 1):
        self.model, self.scale = model, scale
        self.pieces: list[str] = []
        self.bytes: dict[int, int] = {}  # piece id -> byte
        self.trie: dict[str, tuple[int, int] | None] = {}  # None: only the start of a piece
        lowest = 0
        for field, value in _fields(model):
            if field != 1:
                continue
            piece = dict(_fields(value))
            name, score, kind = piece[1].decode(), round(piece.get(2, 0.0) * scale), piece.get(3, 1)
            i = len(self.pieces)
            self.pieces.append(name.replace("▁", " "))
            if kind == 6:
                self.bytes[i] = int(name[3:5], 16)
            elif kind == 1:
                self.trie[self.pieces[i]] = (i, score)
                lowest = min(lowest, score)
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary must have all byte pieces")
        words = list(self.trie)
        if any(" " in w.lstrip(" ") for w in words):
            raise ValueError("the vocabulary has pieces with inner blanks")
        for w in words:
            for k in range(1, len(w)):
                self.trie.setdefault(w[:k], None)
        self.reach = max(map(len, words))
        self.unknown = lowest - 10
        # a line end that no longer piece holds is a place of its own
        lone = all("\n" not in w for w in words if len(w) > 1)
        self.parts = re.compile(r"\n| +[^ \n]*|[^ \n]+" if lone else r" +[^ ]*|[^ ]+")
        # the same tree in arrays: sorted (state, character) pairs, next states, pieces and scores of states
        number = {"": 0} | {w: i for i, w in enumerate(self.trie, 1)}
        steps = np.array([(number[w[:-1]] << 21) + ord(w[-1]) for w in self.trie], np.int64)
        order = np.argsort(steps)
        self.steps, self.next = steps[order], order + 1
        hits = [(-1, NONE), *((-1, NONE) if h is None else h for h in self.trie.values())]
        self.piece, self.value = np.array([h[0] for h in hits], np.int32), np.array([h[1] for h in hits], np.int64)

    def spell(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def viterbi(self, text: str, stop: int | None = None, ends: bool = False):
        """Best pieces of ``text`` and their score; pieces start before ``stop``.

        Of equal scores at a place the earliest start wins. ``ends``: only the list of best scores by place.
        """
        n = len(text)
        best, back = [NONE] * (n + 1), [None] * (n + 1)
        best[0] = 0
        find = self.trie.get
        for i in range(n if stop is None else min(n, stop)):
            here = best[i]
            if here == NONE:
                continue
            known = False
            for j in range(i + 1, min(n, i + self.reach) + 1):
                hit = find(text[i:j], 0)
                if hit == 0:
                    break
                if hit is not None:
                    known = known or j == i + 1
                    if here + hit[1] > best[j]:
                        best[j], back[j] = here + hit[1], (i, hit[0])
            if not known and here + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + self.unknown, (i, None)
        if ends:
            return best
        ids, j = [], n
        while j:
            i, piece = back[j]
            ids += reversed(self.spell(text[i:j])) if piece is None else (piece,)
            j = i
        ids.reverse()
        return ids, best[n]

    def remember(self, texts, memo: dict) -> list[list[str]]:
        """Put all words of the texts that are short enough into the memo, new ones in one vectorised pass; the words of each text."""
        cut = [self.parts.findall(t) for t in texts]
        words = set().union(*cut)
        new = [w for w in words - memo.keys() if len(w) <= LONGEST]
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = [w for w in words if len(w) <= LONGEST]
        new.sort(key=len, reverse=True)
        for at in range(0, len(new), WORDS):
            part = new[at : at + WORDS]
            memo.update(zip(part, self.viterbi_all(part)))
        return cut

    def viterbi_all(self, words: list[str]) -> list[tuple[bytes, int]]:
        """What :meth:`viterbi` gives for each word, its pieces packed; ``words`` from long to short, none empty."""
        sizes = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        n, deep = len(chars), min(self.reach, int(sizes[0]))
        ends = np.repeat(starts + sizes, sizes)
        score, piece = np.full((deep, n), NONE, np.int64), np.full((deep, n), -1, np.int32)
        live, state = np.arange(n), np.zeros(n, np.int64)
        for d in range(deep):  # all places at once walk down the tree
            inside = live + d < ends[live]
            live, state = live[inside], state[inside]
            if not len(live):
                deep = max(d, 1)
                break
            step = (state << 21) + chars[live + d]
            j = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            hit = self.steps[j] == step
            live, state = live[hit], self.next[j[hit]]
            score[d, live], piece[d, live] = self.value[state], self.piece[state]
        lone = score[0] == NONE
        score[0, lone] = self.unknown
        base = starts + np.arange(len(words))  # one place more per word
        best, back, taken = np.full(n + len(words), NONE, np.int64), np.zeros(n + len(words), np.int64), np.full(n + len(words), -1, np.int32)
        best[base] = 0
        for p in range(int(sizes[0])):
            m = int(np.searchsorted(-sizes, -p, side="left"))
            here = best[base[:m] + p]
            for d in range(min(deep, int(sizes[0]) - p)):
                s = score[d, np.minimum(starts[:m] + p, n - 1)]
                k = np.flatnonzero((s != NONE) & (here != NONE))
                if not len(k):
                    continue
                to, value = base[k] + p + d + 1, here[k] + s[k]
                more = value > best[to]
                to, k = to[more], k[more]
                best[to], back[to], taken[to] = value[more], d + 1, piece[d, starts[k] + p]
        at, steps = sizes.copy(), []
        while at.any():
            place = base + at
            steps.append(np.where(at > 0, taken[place], -2))
            at -= np.where(at > 0, back[place], 0)
        rows = np.array(steps[::-1], np.int32).T
        real = rows != -2
        ends = 4 * np.cumsum(real.sum(axis=1))
        packed = rows[real].tobytes()
        found = list(zip([packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())], best[base + sizes].tolist()))
        for i in np.flatnonzero((rows == -1).any(axis=1)).tolist():  # holds a character without a piece
            ids, total = self.viterbi(words[i])
            found[i] = (_packed(ids), total)
        return found

    def encode(self, text: str, memo: dict, stop: int | None = None) -> tuple[bytes, int]:
        """Pieces, packed in four bytes each, and score of a text; with ``stop``, its last piece starts before that place and ends at the end."""
        parts, tail = self.parts.findall(text), (b"", 0)
        if stop is not None and stop < len(text):
            held = 0
            while parts and len(text) - held - len(parts[-1]) > stop:  # later places are inside the last piece
                held += len(parts.pop())
            held += len(parts.pop()) if parts else 0
            at = len(text) - held
            ids, total = self.viterbi(text[at:], stop - at)
            tail = (_packed(ids), total)
        found = [*self.looked_up(parts, memo), tail]
        return b"".join([ids for ids, _ in found]), sum([total for _, total in found])

    def looked_up(self, parts: list[str], memo: dict) -> list[tuple[bytes, int]]:
        """Packed pieces and score of each word."""
        found = list(map(memo.get, parts))
        if None not in found:
            return found
        for i, hit in enumerate(found):
            if hit is None:  # too long for the memo, or met for the first time
                ids, total = self.viterbi(parts[i])
                found[i] = (_packed(ids), total)
                if len(parts[i]) <= LONGEST:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[parts[i]] = found[i]
        return found

    @cached_property
    def spelled(self) -> np.ndarray:
        """Which pieces are bytes."""
        out = np.zeros(len(self.pieces), bool)
        out[list(self.bytes)] = True
        return out

    def decode(self, ids, whole: bool = True) -> str:
        """The text of pieces; the blank put before every ``whole`` text goes."""
        ids = np.asarray(ids, np.int64)
        raw = np.flatnonzero(self.spelled[ids])
        listed, name, byte = ids.tolist(), self.pieces.__getitem__, self.bytes.__getitem__
        if not len(raw):
            return "".join(map(name, listed))[1 if whole else 0 :]
        out, at = [], 0
        # only runs of byte pieces are looked at one by one
        first, last = raw[np.diff(raw, prepend=-2) != 1], raw[np.diff(raw, append=len(ids) + 1) != 1] + 1
        for a, b in zip(first.tolist(), last.tolist()):
            out += map(name, listed[at:a])
            out.append(bytes(map(byte, listed[a:b])).decode("utf-8", "replace"))
            at = b
        out += map(name, listed[at:])
        return "".join(out)[1 if whole else 0 :]

    def transfer(self, text: str, size: int, memo: dict) -> np.ndarray:
        """Best scores from entry to exit states of a chunk: ``text`` is the chunk of ``size`` and what may follow it."""
        width = self.reach
        exits = min(width, len(text) - size + 1)
        out = np.full((width, width), NONE, np.int64)
        # places that no piece crosses: before a blank that follows another character
        cuts = [m.start() for m in re.finditer(r"(?<=[^ ]) ", text[: size + 1])] if size else []
        first = next((c for c in cuts if c >= width - 1), None)
        if first is None:
            for s in range(min(width, size + 1)):  # a short last chunk may lie in the piece before it
                row = self.viterbi(text[s:], size - s, ends=True)[size - s :]
                out[s, :exits] = row[:exits]
            return out
        last = cuts[-1]
        head = [self.encode(text[s:first], memo)[1] for s in range(width)]
        middle = self.encode(text[first:last], memo)[1]
        row = self.viterbi(text[last:], size - last, ends=True)[size - last :] if last < size else [0] + [NONE] * (exits - 1)
        ok = np.array(row[:exits], np.int64)
        out[:, :exits] = np.where(ok[None, :] == NONE, NONE, np.array(head, np.int64)[:, None] + middle + ok[None, :])
        return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of stacks of matrices."""
    return np.maximum((a[..., :, :, None] + b[..., None, :, :]).max(axis=-2), NONE)


def prefixes(m: np.ndarray) -> np.ndarray:
    """All products of the first matrices, by doubling steps over blocks."""
    out, step = m.copy(), 1
    while step < len(out):
        later = out.copy()
        for at in range(step, len(out), 256):
            hi = min(len(out), at + 256)
            later[at:hi] = product(out[at - step : hi - step], out[at:hi])
        out, step = later, step * 2
    return out


def boundary_states(matrices: np.ndarray) -> list[int]:
    """The state at each boundary on a best path, from the end back; of equal scores the smallest state."""
    reach = np.vstack([np.r_[0, np.full(matrices.shape[1] - 1, NONE)][None], prefixes(matrices)[:, 0, :]])
    states = [0]
    for k in range(len(matrices) - 1, -1, -1):
        states.append(int(np.argmax(reach[k] + matrices[k][:, states[-1]])))
    return states[::-1]


def _slices(*columns: pd.Series) -> Iterator[tuple]:
    """The columns (the first of texts) in runs of about SLICE characters: what a task holds besides its batch."""
    sizes = np.cumsum([len(t) for t in columns[0]])
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE)))
        yield tuple(c.iloc[lo:hi] for c in columns)
        lo = hi


def load_vocabulary(path: str = DEFAULT_MODEL) -> Vocabulary:
    with open(path, "rb") as file:
        return Vocabulary(file.read())


def _shared(spark: SparkSession, vocabulary: Vocabulary):
    """The model file's bytes (half a megabyte) for all tasks, and how to read them."""
    return spark.sparkContext.broadcast((vocabulary.model, vocabulary.scale))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "pieces", chunk: int = CHUNK, check: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of each text in ``out`` (``array<int>``, replaced if there).

    ``check`` names a column that tells whether decoding the pieces gives the text back. It is found where the
    text is encoded, which saves the second Python worker that a decoding step in the same stage would need.

    Empty and null texts have no pieces. Texts of more than ``chunk`` code points take the
    scan; the total score does not depend on ``chunk``, and equal scores across a boundary are the
    only case where the pieces may. All rows are kept, repeated ones too; other columns pass through.
    """
    if chunk < 2 * vocabulary.reach:
        raise ValueError("a chunk must be longer than two pieces")
    docs = docs.drop(out, *([check] if check else []))
    shared = _shared(docs.sparkSession, vocabulary)
    size, both, exact = fresh(docs, "size", "both", "exact")
    sized = docs.withColumn(size, F.length(text_of(text)))
    short, giant = sized.where(F.col(size) < chunk).drop(size), sized.where(F.col(size) >= chunk).drop(size)

    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v, memo = Vocabulary(*shared.value), {}
        for texts in batches:
            for (part,) in _slices(texts.fillna("")):
                part = [f" {t}" if t else "" for t in part]
                # the words are cut once, for the memo and for the texts
                found = (v.looked_up(words, memo) for words in v.remember(part, memo))
                ids = [np.frombuffer(b"".join([ids for ids, _ in f]), np.int32) for f in found]
                same = [not check or v.decode(i) == t[1:] for i, t in zip(ids, part)]
                yield pd.DataFrame({"p": ids, "ok": same})

    done = short.withColumn(both, F.pandas_udf(whole, "p array<int>, ok boolean")(F.col(text)))
    done = done.select(*docs.columns, F.col(both)["p"].alias(out), F.col(both)["ok"].alias(exact))
    found = done.unionByName(_giants(giant, shared, vocabulary, text, out, chunk, exact, bool(check)))
    return found.withColumnRenamed(exact, check) if check else found.drop(exact)


def _giants(docs: DataFrame, shared, vocabulary: Vocabulary, text: str, out: str, chunk: int, exact: str, check: bool) -> DataFrame:
    """Encoding of texts by chunks, which are dealt to tasks one by one.

    The chunks are stored once, with the row's other columns on its first chunk. Texts are shuffled twice in
    all: when dealt, and when put together again with their pieces.
    """
    row, at, part, rest, pieces = fresh(docs, "row", "at", "part", "rest", "pieces")
    reach, kind = vocabulary.reach, np.dtype(np.uint16 if len(vocabulary.pieces) <= 1 << 16 else np.uint32)
    others = [c for c in docs.columns if c != text]

    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[t[k : k + chunk + reach - 1] for k in range(0, len(t), chunk)] for t in (f" {t}" for t in texts)], dtype=object)

    def matrices(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v, memo = Vocabulary(*shared.value), {}
        for batch in batches:
            for (texts,) in _slices(batch):
                v.remember(texts, memo)
                yield pd.Series([v.transfer(t, min(chunk, len(t)), memo).tobytes() for t in texts], dtype=object)

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(at)
        s = boundary_states(np.frombuffer(b"".join(group["m"]), np.int64).reshape(len(group), reach, reach))
        return pd.DataFrame({row: group[row], at: group[at], "s": s[:-1], "e": s[1:]})

    def backtrace(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        v, memo = Vocabulary(*shared.value), {}
        for batch in batches:
            for texts, entry, leave in _slices(*batch):
                v.remember(texts, memo)
                found, same = [], []
                for t, s, e in zip(texts, entry, leave):
                    size = min(chunk, len(t))
                    ids = np.frombuffer(v.encode(t[s : size + e], memo, size - s)[0], np.int32)
                    found.append(ids.astype(kind).tobytes())
                    same.append(not check or v.decode(ids, whole=False) == t[s : size + e])
                yield pd.DataFrame({"p": found, "ok": same})

    def joined(raw: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(b"".join(x), kind).astype(np.int32) for x in raw], dtype=object)

    first = F.when(F.col(at) == 0, F.col(rest))
    parts = docs.select(F.monotonically_increasing_id().alias(row), (F.struct(*others) if others else F.struct(F.lit(0))).alias(rest), F.pandas_udf(split, "array<string>")(F.col(text)).alias(part))
    parts = parts.select(row, rest, F.posexplode(part).alias(at, part)).withColumn(rest, first)
    chunks = stored(parts.repartition(row, at), "giant-chunks")

    scored = chunks.select(row, at, F.pandas_udf(matrices, "binary")(F.col(part)).alias("m"))
    found = scored.groupBy(row).applyInPandas(combine, f"`{row}` bigint, `{at}` int, s int, e int")
    found = small_enough(stored(found, "boundary-states"), STATES_SENT)
    traced = chunks.join(found, [row, at]).select(
        row, at, rest, F.substring(part, 1, chunk).alias(part), F.pandas_udf(backtrace, "p binary, ok boolean")(F.col(part), F.col("s"), F.col("e")).alias(pieces)
    )
    whole = traced.groupBy(row).agg(F.sort_array(F.collect_list(F.struct(at, part, pieces, rest))).alias(part))
    whole = whole.select(
        F.col(part)[0][rest].alias(rest),
        F.substring(F.concat_ws("", F.col(f"{part}.{part}")), 2, (1 << 31) - 1).alias(text),
        F.pandas_udf(joined, "array<int>")(F.col(f"{part}.{pieces}.p")).alias(out),
        F.forall(F.col(f"{part}.{pieces}.ok"), lambda x: x).alias(exact),
    )
    return whole.select(*(F.col(text) if c == text else F.col(rest)[c].alias(c) for c in docs.columns), out, exact)


def decode(df: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's piece ids in ``out``; no pieces and null give the empty text."""
    df = df.drop(out)
    shared = _shared(df.sparkSession, vocabulary)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = Vocabulary(*shared.value)
        for ids in batches:
            yield pd.Series(["" if x is None or not len(x) else v.decode(x) for x in ids], dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "string")(F.col(pieces)))
