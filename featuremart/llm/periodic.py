"""Periodic runs of words: maximal stretches that repeat with one period.

Seed and extend along diagonals. A run of period q and at least ``max(LEAST,
4 * q)`` words overlaps its own shift by q in ``max(LEAST - q, 3 * q)`` words.
So for periods from 2^t up to 2^(t+1) every run has two equal k-grams with
k = 3 * 2^t at distance q (k = 5 for q = 1). As k is not below q, no other
occurrence lies between the two, or q would not be the smallest period. Hence
the occurrence pairs to look at are those of neighbouring occurrences in one
document: at most one per place and k, however often a k-gram occurs. Pairs
whose distance is in the range of k are seeds. A seed is extended to both
sides along its diagonal; a table holds per distance how far the last
extension came, and seeds before that place are not extended again.

Longer k-grams are named by pairs of names of shorter ones, so names are exact,
and only places whose shorter k-gram occurs twice go on. Documents are worked
on together in slices of about a megabyte.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.llm.common import runs_of

LEAST = 6  # words of a run
REPEATS = 4  # periods of a run


class Grams:
    """Names of the k-grams that occur at least twice: ``name`` by place (-1: none), their places, the next occurrence of each."""

    def __init__(self, places: np.ndarray, codes: np.ndarray, size: int):
        order = np.argsort(codes, kind="stable")
        codes, places = codes[order], places[order]
        same = codes[1:] == codes[:-1]
        new = np.r_[True, ~same][: len(codes)]
        often = (np.r_[same, False] | np.r_[False, same])[: len(codes)]
        self.first, self.second = places[:-1][same], places[1:][same]
        self.name = np.full(size, -1, np.int64)
        self.name[places[often]] = np.cumsum(new)[often]
        self.places = np.sort(places[often])

    def then(self, other: Grams, step: int) -> Grams:
        """The grams of this length with one of ``other`` that starts ``step`` words later."""
        size = len(self.name)
        places = self.places[self.places + step < size]
        places = places[other.name[places + step] >= 0]
        return Grams(places, self.name[places] * (size + 1) + other.name[places + step], size)


def _stretch(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places on from ``at`` (back for ``step`` -1) hold the word that is ``lag`` words later."""
    done, width = 0, 16
    room = len(words) - lag - at if step > 0 else at + 1
    while done < room:
        n = min(width, room - done)
        lo = at + done if step > 0 else at - done - n + 1
        unequal = np.flatnonzero((words[lo : lo + n] != words[lo + lag : lo + lag + n])[::step])
        if len(unequal):
            return done + int(unequal[0])
        done, width = done + n, width * 2
    return done


def _extended(words: np.ndarray, grams: Grams, k: int, shortest: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """``start, length, period`` of the runs whose period is in ``[shortest, longest)``."""
    lags = grams.second - grams.first
    seeds = (lags >= shortest) & (lags < longest)
    lags, places = lags[seeds], grams.first[seeds]
    order = np.lexsort((places, lags))
    lags, places = lags[order], places[order]
    # a seed right behind one of the same distance is on the same diagonal stretch
    alone = np.r_[True, (np.diff(lags) != 0) | (np.diff(places) != 1)] if len(lags) else np.zeros(0, bool)
    covered: dict[int, int] = {}
    for lag, at in zip(lags[alone].tolist(), places[alone].tolist()):
        if at < covered.get(lag, 0):
            continue
        start = at - _stretch(words, at - 1, lag, -1)
        end = at + k + _stretch(words, at + k, lag, 1)
        covered[lag] = end
        if end + lag - start >= max(LEAST, REPEATS * lag):
            yield start, end + lag - start, lag


def find_runs(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs as ``(start, length, period)``, by start and then period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts, total = np.cumsum(sizes) - sizes, int(sizes.sum())
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    seen: dict[bytes, int] = {}
    ids = np.fromiter(map(seen.setdefault, chain.from_iterable(documents), count()), np.int64, total)
    # equal numbers are equal words of one document
    words = np.repeat(np.arange(len(documents)), sizes) * (total + 1) + ids
    one = Grams(np.arange(total), words, total)
    two = one.then(one, 1)
    four = two.then(two, 2)
    runs = list(_extended(words, four.then(one, 4), 5, 1, 2))
    grams, k, period = four.then(two, 4), 6, 2
    while len(grams.places):
        runs += _extended(words, grams, k, period, 2 * period)
        grams, k, period = grams.then(grams, k), 2 * k, 2 * period
    for start, length, period in sorted(runs, key=lambda r: (r[0], r[2])):
        of = int(np.searchsorted(starts, start, side="right")) - 1
        found[of].append((start - int(starts[of]), length, period))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one blank, without those that a run holds behind its first period."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return b" ".join([w for w, n in zip(words, np.cumsum(edges).tolist()) if not n])


def periodic_runs(docs: DataFrame, text: str = "text", out: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with ``out``, an array of (start, length, period) of each text's runs, and ``collapsed``, the text without repetitions.

    Words are numbered from 0. A run is as long as it can be with its period;
    two runs may overlap. ``collapsed`` drops every word that a run holds behind
    its first period. Null, empty and blank texts have no runs and collapse to
    the empty text. Every row is a document of its own, repeated ones too;
    columns named like the two new ones are replaced, others pass through. A
    document is worked on in one task, with memory in proportion to its length.
    """
    docs = docs.drop(out, collapsed)
    fields = "array<struct<start: bigint, length: bigint, period: bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(text).cast(pa.large_binary()).to_pylist(), 0
            for part in runs_of([t or b"" for t in texts]):
                documents = [t.split() for t in part]  # bytes: the six ASCII blanks only
                runs = find_runs(documents)
                flat = np.array(list(chain.from_iterable(runs)), np.int64).reshape(-1, 3)
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                short = [collapse(d, of) for d, of in zip(documents, runs)]
                columns = [*batch.slice(at, len(part)).columns, pa.ListArray.from_arrays(pa.array(ends), structs), pa.array(short, pa.large_binary()).cast(pa.large_string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, out, collapsed])
                at += len(part)

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DataType.fromDDL(fields)), T.StructField(collapsed, T.StringType())])
    return docs.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length per period, compared exactly; of equal ones the first by start, then period. None: null."""
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.reduce(runs, none, lambda a, b: F.when(better(a, b), b).otherwise(a))
