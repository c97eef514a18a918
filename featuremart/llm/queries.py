"""The operators bound to the test tables, and SQL with the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm import byte_pairs, classifier, jaccard, line_dedup, mixing, mixing_lm, mtree, periodic, pieces, quality_rules, ranked, secret_scan, sharding
from featuremart.llm.common import WORD, bind, remainder, table, text_of, word_count, word_list

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# ---------------------------------------------------------------- 1: line dedup

LINE_RATIO, LINE_PAGES = 0.1, 20
#: For lines of at least LONG characters, which the ratio above hardly ever reaches.
LONG_RATIO, LONG_PAGES = 0.01, 5
LINE_RULE = {"ratio": LINE_RATIO, "min_pages": LINE_PAGES, "long_ratio": LONG_RATIO, "long_pages": LONG_PAGES}


@query(
    "op1_line_dedup",
    f"""
    with docs as (select row_number() over () as r, * from documents),
    parts as (select r, doc_id, source, text, string_split(text, chr(10)) as parts from docs),
    lines as (select r, source, unnest(parts) as line, generate_subscripts(parts, 1) as i from parts where text is not null),
    trimmed as (select r, source, i, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as bare from lines),
    sizes as (select source, count(*) as pages from documents group by source),
    bad as (
        select l.source, bare from (select distinct r, source, bare from trimmed where bare <> '') l
        join sizes s on l.source is not distinct from s.source
        group by l.source, bare, pages having pages >= {LINE_PAGES}
            and count(*) > pages * cast(case when length(bare) >= {line_dedup.LONG} then {LONG_RATIO} else {LINE_RATIO} end as double)
            and count(*) >= case when length(bare) >= {line_dedup.LONG} then {LONG_PAGES} else 1 end),
    marked as (
        select t.*, b.bare is not null as gone from trimmed t left join bad b on t.bare = b.bare and t.source is not distinct from b.source),
    pages as (
        select r, string_agg(line, chr(10) order by i) filter (where not gone) as kept,
        count(*) filter (where bare <> '') as n_lines, count(*) filter (where gone) as n_dropped from marked group by r)
    select doc_id, source, case when n_dropped > 0 then coalesce(kept, '') else text end as text,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped from docs left join pages using (r)
    """,
)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = line_dedup.drop_boilerplate(docs, F.col("source"), "text", **LINE_RULE)
    return out.select("doc_id", "source", "text", "n_lines", "n_dropped")


# ---------------------------------------------------------------- 2: language model


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing_lm.score(table(spark, folder, "documents"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


# ---------------------------------------------------------------- 3: quality rules


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"))


# ---------------------------------------------------------------- 4: top-k search

TOP, QUERY_STEP = 5, 50


@query(
    "op4_topk_search",
    f"""
    with good as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    pairs as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
        from good q join good c on q.vec_id <> c.vec_id where q.vec_id % {QUERY_STEP} = 0),
    ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
    select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= {TOP}
    """,
)
def op4_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = mtree.whole_vectors(table(spark, folder, "embeddings"))
    return mtree.top_k(vectors, vectors.where(F.col("id") % QUERY_STEP == 0), TOP)


# ---------------------------------------------------------------- 5: quality classifier

QUALITY_FROM = 0.3


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = classifier.train(docs, table(spark, folder, "labels"))
    scored = classifier.classify(docs, model)
    predicted = F.when(F.col("score") >= QUALITY_FROM, 1).otherwise(0)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", predicted.alias("predicted"))


# ---------------------------------------------------------------- 6: pieces


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = pieces.load_vocabulary()
    coded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), vocabulary, check="same_text")
    return coded.select("doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces", "same_text")


# ---------------------------------------------------------------- 7: mixing

#: Which sources form a domain, and the weights of nodes that are not 1.
DOMAINS = {"web": range(0, 8), "forum": range(8, 12), "news": range(12, 16), "reference": range(16, 20)}
MIX_WEIGHTS = {"=web": 4, "=forum": 2, "=news": 2, "=reference": 2} | {f"={d}|=en": 3 for d in DOMAINS}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 2, 7


def with_domain(docs: DataFrame, name: str = "domain") -> DataFrame:
    of = F.lit(None).cast("string")
    for domain, members in DOMAINS.items():
        of = F.when(F.col("source").isin([f"src{i}" for i in members]), domain).otherwise(of)
    return docs.withColumn(name, of)


def _mixing_sql() -> str:
    words = "len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))"
    domain = "case " + " ".join(f"when source in ({', '.join(repr(f'src{i}') for i in m)}) then '{d}'" for d, m in DOMAINS.items()) + " end"
    weight = "case path " + " ".join(f"when '{p}' then {w}.0" for p, w in MIX_WEIGHTS.items()) + " else 1.0 end"
    part = lambda c: f"coalesce('=' || {c}, '~')"
    ctes = [
        f"docs as (select doc_id, lang, source, {words} as n, {domain} as domain from documents)",
        f"rows as (select *, {part('domain')} as p1, {part('domain')} || '|' || {part('lang')} as p2, "
        f"{part('domain')} || '|' || {part('lang')} || '|' || {part('source')} as p3 from docs)",
        f"g0 as (select '' as parent, least(cast(sum(n) as double) * {MIX_EPOCHS}, floor(cast(sum(n) as double) * cast({MIX_SHARE} as double))) as budget from rows)",
    ]
    for k in (1, 2, 3):
        up = "''" if k == 1 else f"any_value(p{k - 1})"
        ctes += [
            f"c{k} as (select p{k} as path, {up} as parent, cast(sum(n) * {MIX_EPOCHS} as double) as cap from rows group by p{k})",
            f"n{k} as (select *, cast({weight} as double) as w from c{k} join g{k - 1} using (parent))",
            f"o{k} as (select *, row_number() over (partition by parent order by cap / w, cap, path) as i from n{k})",
            f"f{k} as (select *, cap * sum(w) over (partition by parent order by i desc) <= w * (budget - coalesce(sum(cap) over "
            f"(partition by parent order by i rows between unbounded preceding and 1 preceding), 0)) as full_ from o{k})",
            f"g{k} as (select path as parent, case when full_ then cap else least(cap, floor(w * (budget - coalesce(sum(cap) filter (where full_) over "
            f"(partition by parent), 0)) / sum(w) filter (where not full_) over (partition by parent))) end as budget from f{k})",
        ]
    ctes += [
        "leaves as (select parent as p3, cast(budget as bigint) as budget, available from g3 join (select p3 as parent, sum(n) as available from rows group by p3) using (parent))",
        f"plan as (select *, case when available > 0 then budget // available else {MIX_EPOCHS - 1} end as whole from leaves)",
        f"keyed as (select *, md5('{MIX_SEED}:' || cast(whole as varchar) || ':' || coalesce(cast(doc_id as varchar), '')) as key from rows join plan using (p3))",
        "summed as (select *, sum(n) over (partition by p3 order by key range between unbounded preceding and current row) as upto from keyed)",
        f"used as (select *, least(whole + case when upto <= case when available > 0 then budget - whole * available else 0 end then 1 else 0 end, {MIX_EPOCHS}) as epochs_used from summed)",
    ]
    return f"with {', '.join(ctes)} select doc_id, domain, lang, source, cast(n as bigint) as token_count, cast(epochs_used as integer) as epochs_used from used where epochs_used > 0"


@query("op7_mixing", _mixing_sql())
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(table(spark, folder, "documents"))
    out = mixing.mix(docs, ["domain", "lang", "source"], word_count(text_of("text")), MIX_SHARE, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)
    return out.select("doc_id", "domain", "lang", "source", "token_count", "epochs_used")


# ---------------------------------------------------------------- 8: secrets


@query("op8_secrets")
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    listed = lambda spans: secret_scan.listing(spans)
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), of("random").alias("n_random"),
    )


# ---------------------------------------------------------------- 9: n-gram Jaccard join

SHINGLE_WORDS, SIMILAR_PERCENT = 4, 85


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"), "doc_id", "text", SHINGLE_WORDS, SIMILAR_PERCENT)


# ---------------------------------------------------------------- 10: sharding

SHARDS, SHARD_SEED = 40, 7

#: CRC-32 of the UTF-8 bytes of ``text``: the usual byte-wise table, made by its rule.
_CRC = """
    tab as (select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
    hexed as (select row_number() over () as r, *, hex(encode(coalesce(text, ''))) as h from documents),
    bytes as (select r, list_transform(range(len(h) // 2), lambda i: cast('0x' || substr(h, cast(2 * i + 1 as bigint), 2) as bigint)) as b from hexed),
    crcs as (select r, len(b) + 16 as size, xor(list_reduce(list_prepend(4294967295, b),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32 from bytes, tab),
"""


@query(
    "op10_sharding",
    f"""
    with {_CRC}
    rows as (select hexed.doc_id, source, size, text_crc32, md5('{SHARD_SEED}:' || coalesce(cast(doc_id as varchar), '') || ':' || cast(text_crc32 as varchar)) as key
        from hexed join crcs using (r)),
    ranked as (select *, (2 * row_number() over (partition by source order by key) - 1) / cast(2 * count(*) over (partition by source) as double) as share from rows),
    placed as (select *, row_number() over (order by share, coalesce('=' || source, '~'), key) - 1 as position, count(*) over () as n from ranked),
    cut as (select *, position * {SHARDS} // n as shard from placed)
    select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'rows' as law, cast(shard as integer) as shard,
    cast(position - ((shard * n + {SHARDS - 1}) // {SHARDS}) as bigint) as slot, cast(null as integer) as grown_shard, source from cut
    """,
)
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), SHARDS, SHARD_SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


# ---------------------------------------------------------------- 11: byte-level BPE

RANK_FILE = "byte_bpe_50k.tiktoken"


@query("op11_byte_pairs")
def op11_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = byte_pairs.load_ranks(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    coded = byte_pairs.encode(table(spark, folder, "documents").select("doc_id", "text"), pairs, decoded="decoded")
    listed = F.array_join(F.col("tokens").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- 12: periodic runs


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats some of its words from some word on; a null id counts as the empty text."""
    h = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        place = lambda x: lambda i: F.get(words, F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]))
        return bind(F.struct(a.alias("a"), p.alias("p")), lambda x: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), place(x)), " "))

    planted = bind(word_list(F.col("text")), repeated)
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").rlike(WORD), planted).otherwise(F.col("text")))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, folder, "documents").select("doc_id", "text")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


# ---------------------------------------------------------------- 13: ranked lexical search

SEARCH_TOP = 10


def _search_sql() -> str:
    terms = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
    with docs as (select row_number() over () as r, doc_id, text from documents),
    words as (select r, doc_id, unnest({terms}) as term from docs),
    held as (select r, doc_id, term, count(*) as tf from words group by all),
    sizes as (select r, sum(tf) as n from held group by r),
    whole as (select count(*) as n_docs, sum(n) as n_terms from sizes),
    m as (select r, cast(10 + (90 * n * n_docs) // n_terms as bigint) as m from sizes, whole),
    weights as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w from held, whole group by term, n_docs),
    items as (select row_number() over () as i, item_id, text from benchmark),
    asked as (select distinct i, item_id, unnest({terms}) as term from items),
    scored as (select i, item_id, doc_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
        from asked join held using (term) join weights using (term) join m using (r) group by all),
    ranked as (select *, row_number() over (partition by i order by score desc, doc_id) as rank from scored where score > 0)
    select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {SEARCH_TOP}
    """


@query("op13_ranked_search", _search_sql())
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), SEARCH_TOP)
