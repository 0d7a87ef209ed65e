"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racecast.llm import byte_bpe, conversations, html_text, jaccard, language_id, line_dedup, lm_scoring, multi_index, packing, periods, pii, voronoi, warc
from racecast.llm.common import Scratch, ship_code, table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query under its name; its workers get this package."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_code(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; trained on documents whose crc32 mod 5 is not 0."""
    docs = table(spark, folder, "documents")
    held = language_id.held_out(F.col("doc_id"), 5, 0)
    model = language_id.fit(docs.filter(~held))
    found = language_id.identify(docs, model)
    return found.select(
        "doc_id",
        held.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_accepted").alias("accepted"),
    )


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    packed = packing.pack(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), Scratch(spark))
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


@query
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    archives = Scratch(spark).new()
    warc.write(table(spark, folder, "pages"), archives)
    read = warc.read(spark, archives).drop("payload", "url")
    return warc.resolved(read).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid"
    )


_NIBBLE = "instr('0123456789abcdef', substr(sha, {} + 1, 1)) - 1"
ORACLES["op1_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS sha, max(page_id) OVER (PARTITION BY body) AS f FROM p)
SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (((
        ({_NIBBLE.format("CAST(i * 5 // 4 AS INT)")}) * 16 + ({_NIBBLE.format("CAST(i * 5 // 4 + 1 AS INT)")}))
        >> CAST(3 - i * 5 % 4 AS INT)) & 31) AS INT), 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to,
    true AS valid
FROM d
"""


@query
def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


@query
def op3_voronoi_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector."""
    data = voronoi.lattice(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return voronoi.top_inner_products(data, F.col("id") % 100 == 0, Scratch(spark))


ORACLES["op3_voronoi_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op7_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return multi_index.nearest(vectors, "vec_id", "embedding", F.col("id") % 100 == 0, Scratch(spark))


@query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    import public_tokenizers

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard.near_duplicates(table(spark, folder, "documents"), Scratch(spark))


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one, and how many it had and lost."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs, Scratch(spark))


@query
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document by a model learnt from those whose crc32 mod 7 is not 2."""
    held = language_id.held_out(F.col("doc_id"), 7, 2)
    return lm_scoring.score(table(spark, folder, "documents"), held, Scratch(spark))


@query
def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds, and all spans."""
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    base = [kind.name for kind in pii.BASE]
    counts = [F.expr(f"bigint(size({pii.of_kinds('pii', [k])}))").alias(f"n_{k}") for k in base]
    digest = F.sha2(pii.listed("pii", base), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.listed("pii").alias("spans"))


_PLANTED = r"""
CASE WHEN crc32(string(doc_id)) % 10 = 0 THEN get(transform(array(regexp_extract_all(text, r'[^\x20\x09-\x0D]+', 0)),
    w -> get(transform(array(struct(size(w) AS n, crc32(string(doc_id)) div 10 AS g)),
    s -> get(transform(array(int(s.g % s.n)),
    a -> get(transform(array(int(1 + (s.n - a) div (3 + s.g % 8))),
    p -> if(s.n > 0, array_join(transform(sequence(0, s.n - 1), i -> get(w, if(i < a, i, a + (i - a) % p))), ' '), '')),
    0)), 0)), 0)), 0)
ELSE text END"""


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document; every tenth, by crc32, is first made periodic from some word on."""
    planted = F.expr(_PLANTED).alias("text")
    found = periods.find(table(spark, folder, "documents").select("doc_id", planted), keep=["doc_id"])
    best = "array_min(transform(runs, r -> struct(-r.length AS l, r.start AS start, r.period AS period)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("best", F.expr(best)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        F.expr("-best.l AS length"),
        "best.period",
        F.expr("1000 * -best.l div best.period AS exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, unpunctuated, repeated or given to the user, by crc32 mod 20."""
    known = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    known = known.withColumn("damage", F.crc32(key) % 20).filter("damage <> 0")
    kind = F.col("damage")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return known.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    turns, scratch = table(spark, folder, "conversations"), Scratch(spark)
    repair = conversations.repair(_damaged(turns), scratch)
    gaps = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    of_turns = repair.rows.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))
    out = turns.select(F.col("conv_id").alias("conv")).distinct().alias("all")
    for name, found in (("g", of_turns), ("t", repair.totals), ("s", conversations.digests(repair.repaired))):
        on = F.col("all.conv").eqNullSafe(F.col(f"{name}.conv"))
        out = out.join(found.alias(name), on, "left").drop(F.col(f"{name}.conv")).alias("all")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.col("conv").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
