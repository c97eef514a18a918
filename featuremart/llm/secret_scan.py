"""Secret scans: patterns of known kinds, and a battery of randomness tests, with built-in expressions only.

Strings of 16 or more letters, digits and ``+/_-`` are tested. The smallest
alphabet that covers one is its encoding. The battery asks whether the string
looks like uniform draws from that alphabet: chi-squared of symbol counts, the
number of runs above and below the middle, and serial correlation. The
evidence against ordinary text is the likelihood ratio of uniform draws to
draws with the corpus' rates of each letter and digit and of the other
characters; a string of one case is compared with letters at the rates of both cases together, so
a long word looks like text and long random letters do not. By Markov's
inequality its inverse is a p-value, which falls with the length of the string. Benjamini and Hochberg's rule over all tested
strings of the corpus bounds the false discoveries.

Texts are read once: spans and test figures go to a narrow stored table, from which
the corpus' rates and the threshold are found by aggregations that combine
before their shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import bind, stored, text_of

#: Fixed patterns of the known kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
KINDS = ("assign", "access", "hex", "random")

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Encodings from small to large: (pattern of the whole string, alphabet).
ENCODINGS = (
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[a-z]+$", LOWER),
    (r"^[A-Z]+$", UPPER),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[a-z0-9]+$", LOWER + DIGITS),
    (r"^[A-Z0-9]+$", UPPER + DIGITS),
    (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    (r"", UPPER + LOWER + DIGITS + "+/_-"),
)
LETTERS = LOWER + UPPER + DIGITS
BUCKETS = 4000  # classes of p-values, ten per power of ten


def spans_of(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as ``struct<s, e, m>`` in code points (end exclusive).

    The parts between the matches have the same order, so positions follow from lengths.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def walk(both: Column) -> Column:
        ends = F.aggregate(
            F.zip_with(both["f"], both["g"], lambda m, g: F.struct(F.length(g).alias("g"), F.length(m).alias("m"))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("to")),
            lambda a, x: F.struct((a["at"] + F.coalesce(x["g"], F.lit(0)) + F.coalesce(x["m"], F.lit(0))).alias("at"), F.concat(a["to"], F.array(a["at"] + F.coalesce(x["g"], F.lit(0)) + F.coalesce(x["m"], F.lit(0)))).alias("to")),
            lambda a: a["to"],
        )
        return F.zip_with(both["f"], F.slice(ends, 1, F.size(both["f"])), lambda m, e: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))

    return bind(F.struct(found.alias("f"), gaps.alias("g")), walk)


def _none() -> Column:
    return F.array().cast("array<struct<s:int,e:int,m:string>>")


def base_spans(text: Column) -> Column:
    """Known kinds as ``array<struct<s, k, e, kind>>``; texts that can't match are not parsed."""
    low = F.lower(text)
    hint = F.lit(False)
    for word in ASSIGN_WORDS:
        hint = hint | F.contains(low, F.lit(word))
    value = lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6
    assign = F.when(hint, F.filter(spans_of(text, ASSIGN), value)).otherwise(_none())
    access = F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS)).otherwise(_none())
    hexes = F.when(F.rlike(text, F.lit(HEX)), spans_of(text, HEX)).otherwise(_none())
    return F.sort_array(F.concat(*(_of_kind(x, k) for k, x in enumerate((assign, access, hexes)))))


def _of_kind(spans: Column, k: int) -> Column:
    return F.transform(spans, lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"), F.lit(KINDS[k]).alias("kind")))


def battery(m: Column) -> Column:
    """``struct<k, stat>``: the alphabet's size, and the sum of the three squared test statistics of string ``m``.

    A string on one side of the alphabet's middle, or of one symbol, counts as ten deviations.
    """
    letters = F.lit(ENCODINGS[-1][1])
    for pattern, alphabet in reversed(ENCODINGS[:-1]):
        letters = F.when(F.rlike(m, F.lit(pattern)), alphabet).otherwise(letters)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def tests(x: Column) -> Column:
        k, n = F.length(x["a"]).cast("double"), F.length(x["m"]).cast("double")
        chars = F.filter(F.split(x["m"], ""), lambda c: c != "")
        times = lambda c: n - F.length(F.replace(x["m"], c))
        chi = total(F.transform(F.array_distinct(chars), lambda c: times(c) * times(c))) * k / n - n
        # Wilson and Hilferty's cube root brings chi-squared near the normal
        z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1)))

        def ordered(v: Column) -> Column:
            mean = lambda: total(v) / n

            def centred(d: Column) -> Column:
                var = total(F.transform(d, lambda a: a * a))
                lag = total(F.transform(d, lambda a, i: F.coalesce(a * F.get(d, i + 1), F.lit(0.0))))
                return F.when(var > 0, (lag / F.greatest(var, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(10.0)

            n1 = total(F.transform(v, lambda a: F.when(a > k / 2, 1.0).otherwise(0.0)))
            runs = 1 + total(F.transform(v, lambda a, i: F.when((a > k / 2) != (F.get(v, i + 1) > k / 2), 1.0).otherwise(0.0)))
            mu = 2 * n1 * (n - n1) / n + 1
            spread = (mu - 1) * (mu - 2) / (n - 1)
            z_runs = F.when(spread > 0, (runs - mu) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(10.0)
            z_lag = bind(mean(), lambda c: bind(F.transform(v, lambda a: a - c), centred))
            return z_lag * z_lag + z_runs * z_runs

        stat = z_chi * z_chi + bind(F.transform(chars, lambda c: F.position(c, x["a"]).cast("double")), ordered)
        return F.struct(k.alias("k"), stat.alias("stat"))

    return bind(F.struct(letters.alias("a"), m.alias("m")), tests)


def _counts(t: Column) -> Column:
    """How often each of ``LETTERS`` is in ``t``."""
    return F.transform(F.array(*map(F.lit, LETTERS)), lambda c: (F.length(t) - F.length(F.replace(t, c))).cast("bigint"))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", false_share: float = 1e-3, chance: float = 1e-3) -> DataFrame:
    """``doc_id`` and ``spans``, an ``array<struct<s, k, e, kind>>`` ordered by start, then kind.

    Kinds assign, access and hex are the fixed patterns; ``random`` are strings that
    overlap none of these, pass the battery (three squared deviations, at most
    the chi-square quantile of ``chance``) and are discoveries at
    ``false_share``. Positions count code points, the end is exclusive. A null text has no
    spans; every row gives a row, also repeated ones; extra columns are ignored.
    """
    t = text_of(text)
    tested = F.when(F.rlike(t, F.lit(CANDIDATE)), spans_of(t, CANDIDATE)).otherwise(_none())

    def free(both: Column) -> Column:
        clear = lambda c: ~F.exists(both["b"], lambda x: (x["s"] < c["e"]) & (c["s"] < x["e"]))
        figures = lambda c: F.struct(
            c["s"].alias("s"), c["e"].alias("e"), _counts(c["m"]).alias("n"), battery(c["m"]).alias("t")
        )
        return F.struct(both["b"].alias("base"), F.transform(F.filter(both["c"], clear), figures).alias("tests"))

    parsed = docs.select(
        F.col(id).alias("doc_id"), F.length(t).cast("bigint").alias("chars"), _counts(t).alias("letters"),
        bind(F.struct(base_spans(t).alias("b"), tested.alias("c")), free).alias("x"),
    )
    parsed = stored(parsed.select("doc_id", "chars", "letters", "x.base", "x.tests"), "secret-tests")

    # rates of the letters in all texts, with one added to each; blanks and others are the last
    seen = parsed.agg(*(F.sum(F.get("letters", i)) for i in range(len(LETTERS))), F.sum("chars")).first()
    known = [seen[i] or 0 for i in range(len(LETTERS))]
    rest = (seen[len(LETTERS)] or 0) - sum(known)
    *each, other = (math.log10((c + 1) / (sum(known) + rest + len(LETTERS) + 1)) for c in (*known, rest))
    other -= math.log10(4)
    # a factor for each letter, over that of the others
    over = F.array(*(F.lit(x - other) for x in each))
    both = [a + b + 1 for a, b in zip(known[:26], known[26:52])]
    folded = F.array(*(F.lit(math.log10(c / sum(both))) for c in (*both, *both)))

    def evidence(c: Column) -> Column:
        """log10 of the likelihood ratio, with the prior of one of the encodings."""
        n = c["e"] - c["s"]
        dot = lambda counts, by: F.aggregate(F.zip_with(counts, by, lambda k, x: k * x), F.lit(0.0), lambda a, v: a + v)
        of = lambda first: F.aggregate(F.slice(c["n"], first, 26), F.lit(0).cast("bigint"), lambda a, v: a + v)
        one_case = (of(1) == n) | (of(27) == n)
        text_like = F.when(one_case, dot(F.slice(c["n"], 1, 52), folded)).otherwise(n * other + dot(c["n"], over))
        return -n * F.log10(c["t"]["k"]) - text_like - math.log10(len(ENCODINGS))

    cls = lambda c: F.least(F.greatest(F.floor(evidence(c) * 10), F.lit(0)), F.lit(BUCKETS)).cast("int")
    classes = F.transform("tests", lambda c: F.coalesce(cls(c), F.lit(0)))
    counts = parsed.select(F.explode(classes).alias("b")).groupBy("b").count()
    # log10 of the p-value is at most -b/10: the least b at which tests * p <= false_share * discoveries
    down = Window.orderBy(F.col("b").desc())
    rule = counts.select("b", F.sum("count").over(down).alias("found"), F.sum("count").over(Window.partitionBy()).alias("all"))
    least = rule.where(F.log10("all") - F.col("b") / 10 <= F.log10(F.col("found") * false_share)).agg(F.min("b")).first()[0]
    border = least if least is not None else BUCKETS + 1
    limit = _chi3(chance)
    good = lambda c: (F.coalesce(cls(c), F.lit(0)) >= border) & (c["t"]["stat"] <= limit)
    random = _of_kind(F.filter("tests", good), 3)
    return parsed.select("doc_id", F.sort_array(F.concat("base", random)).alias("spans"))


def _chi3(tail: float) -> float:
    """Upper quantile of chi-square with 3 degrees of freedom."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        above = math.erfc(math.sqrt(mid / 2)) + math.sqrt(2 * mid / math.pi) * math.exp(-mid / 2)
        lo, hi = (mid, hi) if above > tail else (lo, mid)
    return lo


def listing(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ",")
