"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.conversations import damage, repair, summarize
from fareline.llm.direct_codes import read_tokens, write_tokens
from fareline.llm.fm_index import find_leaks
from fareline.llm import language_id
from fareline.llm.line_dedup import remove_boilerplate
from fareline.llm.minhash import near_duplicates
from fareline.llm.packing import pack
from fareline.llm.personal_data import find_personal_data
from fareline.llm.pivot_index import top_k
from fareline.llm.registry import query, table
from fareline.llm.secret_scan import find_secrets
from fareline.llm.token_pairs import align_corpus
from fareline.llm.toxicity import score, train
from fareline.llm.url_lists import host_of, judge_captures
from fareline.session import new_path


@query(
    "op9_benchmark_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), b AS (
        SELECT item_id::VARCHAR AS item, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), phrase AS (
        SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[k:k + 9], ' ') AS words
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)
    ), place AS (
        SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS words
        FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM d), (SELECT DISTINCT size FROM phrase)
        WHERE k + size - 1 <= len(w)
    ), found AS (SELECT r, k, size, item FROM place JOIN phrase USING (size, words)),
    hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + size)) AS p FROM found) GROUP BY r),
    listed AS (
        SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
        coalesce(listed.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(hit.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
    """,
)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query("op3_token_binary_output")
def token_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op1_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 5 == 0  # noqa: E731
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query(
    "op2_line_dedup",
    r"""
    WITH part AS (
        SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
        FROM documents
    ), normal AS (
        SELECT doc_id, source, line, place, lower(trim(regexp_replace(line, '[ 	
]+', ' ', 'g'))) AS n FROM part
    ), common AS (
        SELECT n FROM normal WHERE length(n) - length(replace(n, ' ', '')) >= 2 GROUP BY n HAVING count(DISTINCT source) >= 10
    ), kept AS (
        SELECT doc_id, count(*) AS n_lines, count(c.n) AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.n IS NULL), '') AS text
        FROM normal LEFT JOIN common c ON normal.n = c.n GROUP BY doc_id
    )
    SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, length(text)::BIGINT AS kept_chars,
        sha256(text) AS text_sha256
    FROM kept
    UNION ALL SELECT doc_id, 0::BIGINT, 0::BIGINT, NULL, NULL FROM documents WHERE text IS NULL
    """,
)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("text_sha256")
    )


@query("op4_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")  # noqa: E731
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: E731
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


@query(
    "op5_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
    """,
)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _number(column: str, *more: str):
    """A number below 2^28 from a text column, that SQL engines agree on."""
    return F.conv(F.substring(F.md5(F.concat(F.col(column), *[F.lit(x) for x in more])), 1, 7), 16, 10).cast("long")


@query(
    "op6_url_filter",
    r"""
    WITH capture AS (
        SELECT page_id, url, DATE '2024-01-01' + (('0x' || md5(url)[1:7])::BIGINT % 366)::INTEGER AS fetched,
            regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1) AS host
        FROM pages
    ), change AS (
        SELECT host, DATE '2024-01-01' + (('0x' || md5(host || k)[1:7])::BIGINT % 366)::INTEGER AS day,
            ('0x' || md5(host || k || 'on')[1:7])::BIGINT % 2 = 0 AS listed
        FROM (SELECT DISTINCT host FROM capture WHERE host <> ''), (VALUES ('a'), ('b'), ('c')) AS t(k)
        WHERE ('0x' || md5(host)[1:7])::BIGINT % 3 = 0
    ), state AS (SELECT host, day, bool_or(listed) AS listed FROM change GROUP BY host, day),
    named AS (
        SELECT page_id, url, fetched, host, array_to_string(parts[k:], '.') AS name
        FROM (SELECT *, string_split(host, '.') AS parts, unnest(range(1, len(string_split(host, '.')) + 1)) AS k FROM capture)
    ), last AS (
        SELECT page_id, url, name, max(day) AS day FROM named JOIN state ON name = state.host AND day <= fetched GROUP BY page_id, url, name
    ), active AS (
        SELECT page_id, url, name, row_number() OVER (PARTITION BY page_id, url ORDER BY length(name) DESC) AS place
        FROM last JOIN state ON name = state.host AND last.day = state.day WHERE listed
    )
    SELECT c.page_id, c.fetched, c.host, a.name IS NOT NULL AS blocked, a.name AS entry
    FROM capture c LEFT JOIN active a ON c.page_id = a.page_id AND c.url = a.url AND a.place = 1
    """,
)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures on a day that follows from the URL; a list that adds and drops a third of their hosts."""
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), (n % 366).cast("int"))  # noqa: E731
    captures = table(spark, sf_dir, "pages").select("page_id", "url", host_of("url").alias("site"), day(_number("url")).alias("fetched"))
    hosts = captures.select(F.col("site").alias("host")).where("host is not null").distinct()
    changes = hosts.where(_number("host") % 3 == 0).select("host", F.explode(F.array(*[F.lit(k) for k in "abc"])).alias("k"))
    number = lambda *more: F.conv(F.substring(F.md5(F.concat("host", "k", *[F.lit(x) for x in more])), 1, 7), 16, 10).cast("long")  # noqa: E731
    changes = changes.select("host", day(number()).alias("at"), (number("on") % 2 == 0).alias("listed"))
    return judge_captures(captures, changes).select("page_id", "fetched", F.col("site").alias("host"), "blocked", "entry")


@query("op10_language_id")
def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train(table(spark, sf_dir, "documents"))
    found = language_id.identify(table(spark, sf_dir, "pages"), model)
    return found.select("page_id", "language", F.round("confidence", 6).alias("confidence"), "text_language", "declared", "suffix")


@query("op12_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_corpus(table(spark, sf_dir, "documents"), *paths)[0]


@query("op11_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(repair(damage(table(spark, sf_dir, "conversations")), gone="gone"))


@query("op13_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")  # noqa: E731
    of = lambda *kinds: F.filter("personal", lambda s: s["kind"].isin(*kinds))  # noqa: E731
    base = ("email", "ip", "card", "phone")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base], F.sha2(joined(of(*base)), 256).alias("base_sha256"),
        joined(F.col("personal")).alias("spans"),
    )
