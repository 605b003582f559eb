"""The registered queries of the training-data operators, one for each, with DuckDB SQL where SQL can express it.

Each reads its whole table, calls its operator with production parameters
and derives the columns of the query's contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import text_mod
from riskloom.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary() -> str:
    """The place of the public tokenizer's file on this machine; the package is on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_minimax_shards")
def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.shards import minimax_shards

    return minimax_shards(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.pii import find_personal_data, span_text

    found = find_personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.concat("base_spans", "added_spans")
    return found.select(
        "doc_id", *[count(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"), span_text(every).alias("spans"),
        F.array_join(F.transform(every, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import langid

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.train(langid.learnable(docs))
    rows = docs.select("doc_id", (text_mod("doc_id", 5) == 0).alias("held_out"), "text")
    return langid.predict(rows, net).select("doc_id", "held_out", "lang_pred", "score")


@register("op4_backtracking_bpe")
def op4_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.bpe import encode_decode

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@register("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import quality

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    rows = docs.select("doc_id", (text_mod("doc_id", 4) == 2).alias("held_out"), "text")
    return quality.predict(rows, model).select("doc_id", "held_out", "score", "predicted")


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


@register("op2_learned_partitions")
def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.ann import nearest_neighbours

    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, k=5)


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex FROM p),
m AS (SELECT body, max(page_id) AS top FROM p GROUP BY body)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    (CAST('0x' || substr(hex, 5 * (j // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31 AS INTEGER) + 1, 1)
    for j in range(32)], '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM h JOIN m USING (body)"""


@register("op9_warc_normaliser", _WARC_SQL)
def op9_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.warc import round_trip

    return round_trip(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


_TOP_K_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS w FROM embeddings
  WHERE len(embedding) > 0 AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.row AS query, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.w) = len(c.w) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


@register("op10_uniform_threshold", _TOP_K_SQL)
def op10_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.topk import exact_top_k, whole_numbers

    vectors = whole_numbers(read_table(spark, sf_dir, "embeddings"))
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@register("op6_ngram_jaccard")
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.jaccard import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _code_sql(rounds: int = 2) -> str:
    """Part-wise codes in SQL: every entry is compared, the least distance and then the lowest index count."""
    steps = ["""
w AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS w FROM embeddings
  WHERE len(embedding) > 0 AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT vec_id, label, part, w[part * (len(w) // 16) + 1:(part + 1) * (len(w) // 16)] AS v
  FROM w, (SELECT unnest(range(16)) AS part)),
b0 AS (SELECT part, entry, v FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM w) USING (vec_id)
  WHERE entry < 64)"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (SELECT vec_id, label, p.part, any_value(p.v) AS v, min({{'d': CAST(list_sum([
    (z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.v, b{r}.v)]) AS BIGINT), 'e': entry}}) AS m
  FROM p JOIN b{r} USING (part) GROUP BY vec_id, label, p.part)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT part, entry, list(mean ORDER BY pos) AS v FROM (SELECT part, m.e AS entry, pos, CAST(floor(sum(v[pos]) / count(*)) AS BIGINT) AS mean
  FROM a{r}, (SELECT unnest(range(1, 65)) AS pos) WHERE pos <= len(v) GROUP BY part, m.e, pos) GROUP BY part, entry),
b{r + 1} AS (SELECT part, entry, coalesce(m{r}.v, b{r}.v) AS v FROM b{r} LEFT JOIN m{r} USING (part, entry))""")
    return f"""
WITH {",".join(steps)},
c AS (SELECT vec_id, label, string_agg(format('{{:02x}}', m.e), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256 FROM c"""


@register("op12_equal_average_codes", _code_sql())
def op12_equal_average_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.codes import compressed

    return compressed(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


_TERM_SQL = r"""string_split_regex(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
_LEXICAL_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, list_filter({_TERM_SQL.format(text="coalesce(text, '')")}, lambda x: x <> '') AS terms FROM documents),
d AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM t WHERE len(terms) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS size FROM d),
i AS (SELECT DISTINCT item_id, unnest({_TERM_SQL.format(text="coalesce(text, '')")}) AS term FROM benchmark),
p AS (SELECT row, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY row, doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
r AS (SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // size)))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, row, doc_id),
o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10"""


@register("op11_mask_grouped_search", _LEXICAL_SQL)
def op11_mask_grouped_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm.lexical import search

    return search(read_table(spark, sf_dir, "benchmark").select("item_id", "text"),
                  read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op13_recurrent_blocks")
def op13_recurrent_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import extract

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages, extract.train(pages)).select("page_id", "url", "text", "n_chars")
