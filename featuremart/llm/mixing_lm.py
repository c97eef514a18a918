"""Language-model scores by online logistic context mixing.

A text is the stream of its lower-case words, a blank after each, and an end. Each byte is
coded by yes/no decisions along a prefix code made from the corpus' byte counts (fewer
decisions than eight plain bits). For each decision several hashed contexts - the last
two, four and six bytes, and the word so far - give the log odds of what the training
corpus did there. A gate, chosen by how sure the longer contexts are, selects the weights that
combine them; the sum is refined by an adaptive correction per class of
certainty. Weights and corrections are updated online along each text, block by block, and every decision teaches.
They start from what one fold of the training texts (LEARN) shows under the counts of the others.
The score is the probability of all decisions. Decisions are expanded a window at a time, so a giant
text needs little more than its bytes.

Counting takes every training text: tasks add decisions up in tables of bounded size, whose blocks
are summed in levels of at most 256 tables. The finished tables (one byte per slot) have a
fixed size, so they can be sent to all tasks. Word counts for the base score are exact and grow with
the corpus: at most 1 / HEAD words are more frequent than HEAD, these are sent to
the tasks; the others are joined by a shuffle, which no word can make uneven.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import checkpointed, remainder, stored, text_of

HEAD = 1e-5
#: Slots of each context's table, as powers of two: last two, four and six bytes, word so far.
BITS = (18, 21, 23, 23)
K = len(BITS)
PRIOR = 0.1  # added to both counts of a slot
STEPS = 4.5  # steps per unit of log odds; six bits of a table's byte
SEEN = (1, 4, 32)  # counts from which a slot's confidence class is 1, 2, 3; two bits of the byte
BLOCK = 16  # slots of a shuffled block, as a power of two
FAN = 256
GATES, CLASSES = 16, 32
BATCH = 1 << 18  # bytes of texts that advance together
WINDOW = 1 << 16  # bytes whose decisions are held at a time; a multiple of the longest block
REACH = 6  # bytes back that a context sees
END = 10
BASE = 0x5851F42D4C957F2D  # of the polynomial of a word
_GOLD = np.uint32(0x9E3779B1)
_ODD = np.uint32(0x85EBCA6B)
_VALUE = ((np.arange(256) & 63) - 32).astype(np.float32) / np.float32(STEPS)


#: Weights before anything is learnt, in all gates, and how fast weights and corrections follow a text's decisions.
WEIGHTS = np.tile(np.array([0.2, 0.4, 0.3, 0.3], np.float32), (GATES, 1))
RATE, REFINE = 0.5, 0.2
#: Modulus of the second hash whose class 0 of the training texts teaches the starting weights, and Newton steps.
LEARN, NEWTON = 6, 2
#: Sums of a lesson, and their fixed-point steps: a retried task, in whatever order, adds up to the same.
SUMS = GATES * (K + K * (K + 1) // 2) + 2 * CLASSES
FIXED = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b" \n" if words else b"\n"


class Code:
    """A prefix code of all bytes: the decisions (node and answer) on the way to each byte."""

    def __init__(self, counts: np.ndarray):
        heap = [(float(c) + 1e-3, b, b) for b, c in enumerate(counts)]
        heapq.heapify(heap)
        left, right, made = {}, {}, 256
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            left[made], right[made] = x, y
            heapq.heappush(heap, (a + b, made, made))
            made += 1
        paths, todo = {}, [(heap[0][2], ())]
        while todo:
            node, path = todo.pop()
            if node < 256:
                paths[node] = path
            else:
                todo += [(left[node], (*path, (node - 256, 0))), (right[node], (*path, (node - 256, 1)))]
        self.length = np.array([len(paths[b]) for b in range(256)], np.int64)
        self.start = np.r_[0, np.cumsum(self.length)[:-1]]
        self.node = (np.array([n for b in range(256) for n, _ in paths[b]], np.uint32) + np.uint32(1)) * _ODD
        self.bit = np.array([a for b in range(256) for _, a in paths[b]], np.uint8)


class Past:
    """What lies before a window of a text: its last bytes, and the hash and length of the word so far."""

    def __init__(self):
        self.bytes, self.word, self.length = np.full(REACH, END, np.uint8), np.uint64(0), 0


def contexts(data: np.ndarray, starts: np.ndarray, past: Past | None = None) -> list[np.ndarray]:
    """Per context a number for each byte: the last two, four and six bytes, and the word so far.

    ``starts``: where texts begin. With a ``past``, ``data`` goes on where the window before it ended, and ``past`` moves to its end.
    """
    n = len(data)
    past = past or Past()
    wide = np.r_[past.bytes, data].astype(np.uint32)
    last = []
    for k in range(1, REACH + 1):  # the k-th byte back, reset where a text begins
        p = wide[REACH - k : REACH - k + n].copy()
        for j in range(k):
            at = starts + j
            p[at[at < n]] = END
        last.append(p)
    two = last[0] | last[1] << np.uint32(8)
    four = two | last[2] << np.uint32(16) | last[3] << np.uint32(24)
    six = (last[4] | last[5] << np.uint32(8)) * _ODD ^ four
    # the word so far: a polynomial of the bytes after the last blank
    fresh = last[0] == 32
    fresh[starts] = True
    begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    power, inverse = _powers(n + 1)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n])]
    word = (sums[:n] - sums[begin]) * inverse[begin]
    goes_on = int(fresh.argmax()) if fresh.any() else n  # bytes of the word that began before the window
    lift = np.uint64(pow(BASE, past.length, 1 << 64))
    word[:goes_on] = word[:goes_on] * lift + past.word
    at = int(begin[-1])
    done = (sums[n:] - sums[at]) * inverse[at]
    if goes_on == n:
        past.word, past.length = (done * lift + past.word)[0], past.length + n
    else:
        past.word, past.length = done[0], n - at
    past.bytes = wide[-REACH:].astype(np.uint8)
    word = ((word ^ (word >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(32)).astype(np.uint32)
    return [two, four, six, word]


@lru_cache(maxsize=2)
def _all_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    each = lambda x: np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)])
    return each(BASE), each(pow(BASE, -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the polynomial's base and of its inverse."""
    power, inverse = _all_powers(max(2 * BATCH + 1, n))
    return power[:n], inverse[:n]


def decisions(data: np.ndarray, seen: list[np.ndarray], code: Code):
    """Where each byte's decisions end, the answers, and per context the slots."""
    lengths = code.length[data]
    ends = np.cumsum(lengths)
    flat = np.repeat(code.start[data] - (ends - lengths), lengths) + np.arange(ends[-1])
    node, bit = code.node[flat], code.bit[flat]
    slots = []
    for c, bits in zip(seen, BITS):
        h = np.repeat(c * _GOLD, lengths) ^ node
        h ^= h >> np.uint32(15)
        h *= _GOLD
        slots.append(h >> np.uint32(32 - bits))
    return ends, bit, slots


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes


def _batches(texts: Iterator[bytes], limit: int = BATCH) -> Iterator[list[bytes]]:
    """Lists of about ``limit`` bytes; a text above it is alone."""
    held, size = [], 0
    for t in texts:
        if held and len(t) >= limit:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Bytes and their contexts, at most WINDOW at a time, in order."""
    data, starts = _joined(texts)
    past = Past()
    for lo in range(0, len(data), WINDOW):
        part = data[lo : lo + WINDOW]
        a, b = np.searchsorted(starts, (lo, lo + len(part)))
        yield part, contexts(part, starts[a:b] - lo, past)


def borders_of(longest: int) -> np.ndarray:
    """Bytes of a text after which weights and corrections are updated: often at first, then every 2048, to its end."""
    return np.r_[64, 128, 192, 256, 384, 512, 768, 1024, 1536, np.arange(2048, longest + 1, 2048)]


def _in_blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Bytes, contexts and texts of bytes: all texts' first blocks, then all second ones; with the ends of blocks.

    Whole blocks of about WINDOW bytes at a time. A text alone is never expanded whole, so its memory is its bytes.
    """
    if len(texts) == 1:
        lo, borders = 0, borders_of(len(texts[0]))
        for data, seen in windows(texts):  # a window's end is a border
            cut = borders[(borders > lo) & (borders < lo + len(data))] - lo
            yield data, seen, np.zeros(len(data), np.int64), np.r_[cut, len(data)]
            lo += len(data)
        return
    data, starts = _joined(texts)
    sizes = np.r_[starts[1:], len(data)] - starts
    lane = np.repeat(np.arange(len(texts)), sizes)
    block = np.searchsorted(borders_of(int(sizes.max())), np.arange(len(data)) - starts[lane], side="right")
    order = np.argsort(block.astype(np.min_scalar_type(block.max())), kind="stable")
    ends = np.flatnonzero(np.diff(block[order], append=-1)) + 1
    seen = contexts(data, starts)
    lo = 0
    while lo < len(data):
        last = max(np.searchsorted(ends, lo + WINDOW, side="right") - 1, np.searchsorted(ends, lo, side="right"))
        here = order[lo : ends[last]]
        yield data[here], [c[here] for c in seen], lane[here], ends[(ends > lo) & (ends <= ends[last])] - lo
        lo = ends[last]


def _inputs(slots: list[np.ndarray], tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of all contexts and the gate of each decision."""
    x = np.empty((len(slots[0]), K), np.float32)
    for k in range(K):
        packed = tables[k].take(slots[k], mode="clip")
        x[:, k] = _VALUE.take(packed, mode="clip")
        if k >= K - 2:  # the two longest contexts choose the weights
            gate = packed >> 6 if k == K - 2 else gate | (packed >> 4) & 12
    return x, gate


def _certainty(z: np.ndarray) -> np.ndarray:
    return np.clip((z + 8) * 2, 0, CLASSES - 1).astype(np.int64)


def mixed_loss(texts: list[bytes], code: Code, tables: list[np.ndarray], start: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Nats that each text costs. All texts advance together; each has weights and corrections of its own.

    ``start``: the weights per gate and corrections per class that every text starts from.
    """
    m = len(texts)
    first, refined = start or (WEIGHTS, np.zeros(CLASSES, np.float32))
    weights = np.tile(first.astype(np.float32), (m, 1))
    extra = np.tile(refined.astype(np.float32), m)
    loss = np.zeros(m)
    for data, seen, lanes, blocks in _in_blocks(texts):
        ends, bit, slots = decisions(data, seen, code)
        lane = np.repeat(lanes, np.diff(ends, prepend=0))
        x, gate = _inputs(slots, tables)
        gates = lane * GATES + gate
        borders = np.r_[0, ends[blocks - 1]]
        for lo, hi in zip(borders, borders[1:]):
            xs, g, here = x[lo:hi], gates[lo:hi], lane[lo:hi]
            z = np.einsum("ij,ij->i", weights.take(g, axis=0, mode="clip"), xs)
            c = here * CLASSES + _certainty(z)
            z += extra.take(c, mode="clip")
            np.clip(z, -12, 12, out=z)
            y = bit[lo:hi]
            e = np.exp(-np.abs(z))
            one = 1 + e
            costs = np.maximum(np.where(y, -z, z), 0) + np.log(one)
            loss += np.bincount(here, costs, m)
            p = np.where(z >= 0, np.float32(1), e) / one
            err, curve = y - p, p * (1 - p)
            slope = np.bincount(g, curve * np.einsum("ij,ij->i", xs, xs), m * GATES) + 30
            for k in range(K):
                weights[:, k] += RATE * np.bincount(g, err * xs[:, k], m * GATES) / slope
            extra += (REFINE * np.bincount(c, err, m * CLASSES) / (np.bincount(c, curve, m * CLASSES) + 6)).astype(np.float32)
    return loss


def lesson(texts: list[bytes], code: Code, tables: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Sums over all decisions: per gate the slope and the upper half of the curvature in the weights, per class of certainty error and curvature."""
    total = np.zeros(SUMS)
    for data, seen in windows(texts):
        _, y, slots = decisions(data, seen, code)
        x, g = _inputs(slots, tables)
        z = np.einsum("ij,ij->i", weights.astype(np.float32).take(g, axis=0), x)
        c = _certainty(z)
        p = 1 / (1 + np.exp(-np.clip(z, -12, 12)))
        err, curve = y - p, p * (1 - p)
        parts = [np.bincount(g, err * x[:, k], GATES) for k in range(K)]
        parts += [np.bincount(g, curve * x[:, i] * x[:, j], GATES) for i in range(K) for j in range(i, K)]
        total += np.concatenate([*parts, np.bincount(c, err, CLASSES), np.bincount(c, curve, CLASSES)])
    return total


def newton(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Weights after one step on the sums of ``lesson``; a gate with few decisions moves little."""
    slope, upper = sums[: K * GATES].reshape(K, GATES).T, sums[K * GATES : -2 * CLASSES].reshape(-1, GATES)
    curve = np.zeros((GATES, K, K))
    for n, (i, j) in enumerate((i, j) for i in range(K) for j in range(i, K)):
        curve[:, i, j] = curve[:, j, i] = upper[n]
    return weights + np.linalg.solve(curve + 30 * np.eye(K), slope[:, :, None])[:, :, 0]


def corrections(sums: np.ndarray) -> np.ndarray:
    return sums[-2 * CLASSES : -CLASSES] / (sums[-CLASSES:] + 6)


def learnt(docs: DataFrame, code: Code, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starting weights and corrections from texts that the tables have not counted."""
    sent = docs.sparkSession.sparkContext.broadcast([t.tobytes() for t in tables])

    def summed(weights: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counted = [np.frombuffer(t, np.uint8) for t in sent.value]
            total = np.zeros(SUMS)
            for texts in _batches(stream(words_of(t)) for part in batches for t in part["text"]):
                total += lesson(texts, code, counted, weights)
            yield pd.DataFrame({"i": np.arange(SUMS), "v": np.rint(total * FIXED).astype(np.int64)})

        sums = np.zeros(SUMS)
        for r in docs.select("text").mapInPandas(run, "i int, v bigint").groupBy("i").agg(F.sum(F.col("v").cast("decimal(30,0)")).alias("v")).collect():  # a row per sum
            sums[r["i"]] = float(r["v"]) / FIXED
        return sums

    weights = WEIGHTS.astype(float)
    for _ in range(NEWTON):
        weights = newton(weights, summed(weights))
    return weights, corrections(summed(weights))


def count_tables(texts: Iterator[bytes], code: Code) -> list[np.ndarray]:
    """How often each slot's decision was no (even places) and yes (odd places)."""
    tables = [np.zeros(2 << b, np.uint32) for b in BITS]
    for batch in _batches(texts):
        for data, seen in windows(batch):
            _, bit, slots = decisions(data, seen, code)
            for t, s in zip(tables, slots):
                np.add.at(t, (s.astype(np.int64) << 1) | bit, np.uint32(1))
    return tables


def odds(counts: np.ndarray) -> np.ndarray:
    """Per slot the log odds of yes and the confidence class, in one byte."""
    no, yes = counts[::2].astype(float), counts[1::2].astype(float)
    v = np.clip(np.rint(np.log((yes + PRIOR) / (no + PRIOR)) * STEPS), -31, 31).astype(np.int64) + 32
    return (v | np.searchsorted(SEEN, no + yes, side="right") << 6).astype(np.uint8)


def _word_rows(docs: DataFrame) -> DataFrame:
    """``kind, key, c``: counts of word hashes (0) and of stream bytes (1), one row per task's batch and key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(words: Counter, seen: np.ndarray):
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
            yield pd.DataFrame({"kind": np.int32(0), "key": keys, "c": np.fromiter(words.values(), np.int64, len(words))})
            yield pd.DataFrame({"kind": np.int32(1), "key": np.arange(256), "c": seen})

        words, seen = Counter(), np.zeros(256, np.int64)
        for part in batches:
            for text in part["text"]:
                w = words_of(text)
                words.update(w)
                words[b"\n"] += 1
                seen += np.bincount(np.frombuffer(stream(w), np.uint8), minlength=256)
                if len(words) > 500_000:
                    yield from flush(words, seen)
                    words, seen = Counter(), np.zeros(256, np.int64)
        if words:
            yield from flush(words, seen)

    return docs.select("text").mapInPandas(run, "kind int, key bigint, c bigint")


def _count_blocks(docs: DataFrame, code: Code, part: int) -> DataFrame:
    """``k, block, counts, task, part``: each task's tables, in packed blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = (stream(words_of(t)) for part in batches for t in part["text"])
        tables = count_tables(texts, code)
        for k, t in enumerate(tables):
            for b in range(0, len(t), 2 << BLOCK):
                part = t[b : b + (2 << BLOCK)]
                if part.any():
                    yield pd.DataFrame({"k": [k], "block": [b // (2 << BLOCK)], "counts": [zlib.compress(part.tobytes(), 1)]})

    # each task sends its tables once, so fewer and longer tasks send less
    tasks = docs.rdd.getNumPartitions()
    light = docs.select("text").coalesce(max(1, tasks // 4, min(tasks, 2 * docs.sparkSession.sparkContext.defaultParallelism)))
    rows = light.mapInPandas(run, "k int, block int, counts binary")
    return rows.withColumn("task", F.spark_partition_id()).withColumn("part", F.lit(part))


def _sum_blocks(counts: pd.Series) -> np.ndarray:
    total = np.zeros(2 << BLOCK, np.uint64)
    for c in counts:
        part = np.frombuffer(zlib.decompress(c), np.uint32)
        total[: len(part)] += part
    return np.minimum(total, 0xFFFFFFFF).astype(np.uint32)


def _merged(blocks: DataFrame, tasks: int) -> DataFrame:
    """``k, block, odds, first``: of all counts, and of part 0 alone; no task holds more than FAN tables' blocks of a part at once."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        one = group.iloc[0]
        return pd.DataFrame({"k": [one["k"]], "block": [one["block"]], "task": [one["task"] // FAN], "part": [one["part"]], "counts": [zlib.compress(_sum_blocks(group["counts"]).tobytes(), 1)]})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        one, first = group.iloc[0], group["counts"][group["part"] == 0]
        return pd.DataFrame({"k": [one["k"]], "block": [one["block"]], "odds": [odds(_sum_blocks(group["counts"])).tobytes()], "first": [odds(_sum_blocks(first)).tobytes()]})

    while tasks > FAN:
        blocks = blocks.groupBy("k", "block", "part", F.expr(f"task div {FAN}")).applyInPandas(add, "k int, block int, task int, part int, counts binary")
        tasks = -(-tasks // FAN)
    return blocks.groupBy("k", "block").applyInPandas(finish, "k int, block int, odds binary, first binary")


def _tables(rows) -> tuple[list[np.ndarray], list[np.ndarray]]:
    both = tuple([np.full(1 << b, 32, np.uint8) for b in BITS] for _ in range(2))
    for r in rows:
        at = r["block"] << BLOCK
        for tables, name in zip(both, ("odds", "first")):
            part = np.frombuffer(r[name], np.uint8)
            tables[r["k"]][at : at + (1 << BLOCK)] = part[: len(tables[r["k"]]) - at]
    return both


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of every row; rows whose crc32 of the id modulo ``folds`` is ``held`` teach nothing.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte``.
    Null and empty texts are an end only; a null id counts as the empty text in the split; repeated rows
    are scored alike. Without training texts all log odds are 0 and the base is uniform. Extra columns are ignored.
    """
    light = docs.select(F.col(id).alias("doc_id"), text_of(text).alias("text"), (remainder(id, folds) == held).alias("held_out"))
    train = light.where("not held_out")
    counts = stored(_word_rows(train).groupBy("kind", "key").agg(F.sum("c").alias("c")), "lm-words")
    vocabulary = counts.where("kind = 0").select(F.col("key").alias("h"), "c")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    head = {r["h"]: r["c"] for r in vocabulary.where(F.col("c") >= max(1.0, total * HEAD)).toLocalIterator()} if total else {}
    seen = np.zeros(256, np.int64)
    for r in counts.where("kind = 1").collect():  # 256 rows
        seen[r["key"]] = r["c"]
    code = Code(seen)
    spark = docs.sparkSession
    # the hash of the reversed id is another than the one that holds texts out
    teaches = F.crc32(F.reverse(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("~")))) % LEARN == 0
    counted, taught = train.where(~teaches), train.where(teaches)
    blocks = _count_blocks(counted, code, 0).union(_count_blocks(taught, code, 1))
    tables, first = _tables(_merged(blocks, train.rdd.getNumPartitions()).toLocalIterator())
    start = learnt(taught, code, first)
    sent = spark.sparkContext.broadcast(([t.tobytes() for t in tables], head))

    def known(h: list[int], head: dict):
        """Sum of log10(c + 1) and number of the words in the head, and the hashes of the others."""
        found = list(map(head.get, h))
        hits = [c for c in found if c is not None]
        return float(np.log10(np.array(hits, float) + 1).sum()), len(hits), [k for k, c in zip(h, found) if c is None]

    def hashes(words: list[bytes]) -> list[int]:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, [*words, b"\n"]), np.uint64, len(words) + 1).view(np.int64).tolist()

    def key_of(i, t: str) -> int:
        one = xxhash.xxh3_64(b"~" if i is None or i != i else str(int(i)).encode())
        one.update(b":" + t.encode("utf-8", "surrogatepass"))
        return one.intdigest() - (1 << 63)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, head = sent.value
        tables = [np.frombuffer(t, np.uint8) for t in raw]
        for part in batches:
            done = 0
            tokens = map(words_of, part["text"])
            facts = []

            def feed():
                for w in tokens:
                    facts.append((len(w) + 1, *known(hashes(w), head)[:2]))
                    yield stream(w)

            for texts in _batches(feed()):
                rows = part.iloc[done : done + len(texts)]
                here = facts[done : done + len(texts)]
                done += len(texts)
                loss = mixed_loss(texts, code, tables, start)
                yield pd.DataFrame({
                    "row": [key_of(i, t) for i, t in zip(rows["doc_id"], rows["text"])], "n_tokens": [f[0] for f in here], "head_sum": [f[1] for f in here],
                    "head_known": [f[2] for f in here], "n_bytes": [len(t) for t in texts], "nats": loss, "doc_id": rows["doc_id"].to_numpy(), "held_out": rows["held_out"].to_numpy(),
                })

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = sent.value[1]
        for part in batches:
            rows, keys, times = [], [], []
            for i, t in zip(part["doc_id"], part["text"]):
                tail = Counter(known(hashes(words_of(t)), head)[2])
                rows += [key_of(i, t)] * len(tail)
                keys += tail.keys()
                times += tail.values()
                if len(rows) > 500_000:
                    yield pd.DataFrame({"row": rows, "h": keys, "tf": times})
                    rows, keys, times = [], [], []
            if rows:
                yield pd.DataFrame({"row": rows, "h": keys, "tf": times})

    kind = dict(light.dtypes)["doc_id"]
    fields = f"row bigint, n_tokens bigint, head_sum double, head_known bigint, n_bytes bigint, nats double, doc_id {kind}, held_out boolean"
    scored = stored(light.mapInPandas(run, fields), "lm-scores")
    tail = light.mapInPandas(rest, "row bigint, h bigint, tf bigint").join(vocabulary.where(F.col("c") < max(1.0, total * HEAD)), "h")
    sums = tail.groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("tail_sum"), F.sum("tf").alias("tail_known"))
    # rows that repeat id and text have one key: their sums hold each of them
    copies = scored.groupBy("row").agg(F.count("*").alias("copies"))
    whole = scored.join(checkpointed(copies.join(sums, "row", "left")), "row")
    z = F.lit(0)
    each = lambda c: F.coalesce(F.col(c), z) / F.col("copies")
    return whole.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.round(each("tail_known"))).cast("bigint").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("head_sum") + each("tail_sum") - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
        (-F.col("nats") / float(np.log(10))).alias("score"),
        "n_bytes", (F.col("nats") / float(np.log(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
