"""The operators as named queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.passages import remove_repeats

    return remove_repeats(table(spark, sf, "documents"), texts=False).drop("kept_text")


@query("op9_minhash_near_dedup")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf, "documents"), width=4)


@query("op1_scaled_fingerprints")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(table(spark, sf, "documents"))


@query("op5_differencing_packing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from costlens.llm.packing import pack_documents

    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_token_id_files")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from costlens.llm.idfiles import read_token_ids, write_token_ids
    from costlens.session import scratch_path

    folder = scratch_path(spark, "ids")
    manifest = write_token_ids(table(spark, sf, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_ids(spark, folder, manifest)


OP4_SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op4_pivot_top_k", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.nearest import top_products

    vectors = table(spark, sf, "embeddings")
    return top_products(vectors, vectors.filter("vec_id % 50 = 0"))


@query("op2_weak_toxicity")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.toxicity import THRESHOLD, held_out, score_toxicity, train

    docs = table(spark, sf, "documents")
    model = train(docs, table(spark, sf, "labels").filter(~held_out("doc_id")))
    return score_toxicity(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@query("op8_personal_data")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.pii import KINDS, find_personal_data

    return find_personal_data(table(spark, sf, "documents")).drop(*KINDS)


def mixing_sql() -> str:
    from costlens.llm.mixing import DIMENSIONS, FILL_ROUNDS, ROUNDS, SCALE, SHARE, TOPICS, UNKNOWN

    share = SHARE

    cases = " ".join(f"WHEN regexp_matches(text, '{pattern}') THEN '{name}'" for name, pattern in TOPICS)
    parts = [
        f"""named AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '{UNKNOWN}') AS source, coalesce(lang, '{UNKNOWN}') AS lang,
    CASE {cases} ELSE 'prose' END AS topic,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
  FROM documents
), cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM named GROUP BY ALL)"""
    ]
    for d in DIMENSIONS:
        parts.append(
            f"goal_{d} AS (SELECT {d}, p / sum(p) OVER () AS target FROM (SELECT {d}, pow(sum(tokens), 0.5) AS p FROM cells GROUP BY {d}))"
        )
    parts.append("w0 AS (SELECT *, CAST(tokens AS DOUBLE) AS weight FROM cells WHERE tokens > 0)")
    last = "w0"
    for turn in range(ROUNDS):
        for d in DIMENSIONS:
            new = f"w{turn}_{d}"
            parts.append(
                f"{new} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, tokens, weight * target / sum(weight) OVER (PARTITION BY c.{d}) AS weight FROM {last} c JOIN goal_{d} g ON c.{d} = g.{d})"
            )
            last = new
    parts.append(f"fill0 AS (SELECT *, weight / tokens * sum(tokens) OVER () * {share} / sum(weight) OVER () AS f FROM {last})")
    for turn in range(FILL_ROUNDS):
        left = f"greatest(sum(tokens) OVER () * {share} - sum(CASE WHEN f >= 1 THEN tokens ELSE 0 END) OVER (), 0.0)"
        parts.append(
            f"open{turn} AS (SELECT *, {left} AS l, sum(CASE WHEN f >= 1 THEN 0.0 ELSE f * tokens END) OVER () AS o FROM fill{turn})"
        )
        parts.append(
            f"fill{turn + 1} AS (SELECT source, lang, topic, tokens, weight, CASE WHEN f >= 1 OR o <= 0 THEN f ELSE f * l / o END AS f FROM open{turn})"
        )
    parts.append(f"chances AS (SELECT *, least(1.0, f) AS chance FROM fill{FILL_ROUNDS})")
    body = ",\n".join(parts)
    return f"""WITH {body}
SELECT doc_id, n.tokens, n.topic AS topic_class, round(coalesce(weight, 0), 9) AS weight, round(coalesce(chance, 0), 9) AS chance,
  n.tokens > 0 AND CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(text)), 1, 13)) AS BIGINT) / {float(SCALE)} < coalesce(chance, 0) AS kept
FROM named n LEFT JOIN chances c ON n.source = c.source AND n.lang = c.lang AND n.topic = c.topic"""


@query("op6_raked_mixture", mixing_sql())
def op6(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.mixing import mix_sources

    return mix_sources(table(spark, sf, "documents")).withColumns({c: F.round(c, 9) for c in ("weight", "chance")})


@query("op3_page_text")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.pages import extract_main_text

    return extract_main_text(table(spark, sf, "pages"))


@query("op12_token_counts")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from costlens.llm.piececounts import count_tokens

    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT doc, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
), kept AS MATERIALIZED (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), sizes AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(c) AS HUGEINT) AS n FROM kept GROUP BY lang
), groups AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM docs
), counted AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS c FROM words w SEMI JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), totals AS (
  SELECT lang, source, CAST(sum(c) AS HUGEINT) AS n FROM counted GROUP BY ALL
), rates AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000 * (coalesce(c.c, 0) + 2)) // (coalesce(t.n, 0) + 2 * s.v) AS p,
    1 + (1000000000 * (k.c + 2)) // (s.n + 2 * s.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM rates WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op13_source_divergence", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.divergence import audit_sources

    return audit_sources(table(spark, sf, "documents"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), words AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k AS size, CAST(count(*) AS HUGEINT) AS f
  FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), known AS MATERIALIZED (
  SELECT *, string_split(phrase, ' ') AS w FROM phrases
), inner_ AS (
  SELECT DISTINCT b.lang, array_to_string(b.w[i : i + k - 1], ' ') AS phrase, b.f
  FROM known b, (SELECT unnest([2, 3, 4]) AS k), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE k < b.size AND i + k - 1 <= b.size
), cuts AS (
  SELECT p.lang, p.phrase, p.f AS a, s.n, k, l.f AS l, r.f AS r, (1000 * p.f * s.n) // (l.f * r.f) AS score
  FROM known p JOIN (SELECT unnest([1, 2, 3, 4]) AS k) ON k < p.size JOIN sizes s ON s.lang = p.lang
  JOIN known l ON l.lang = p.lang AND l.phrase = array_to_string(p.w[1 : k], ' ')
  JOIN known r ON r.lang = p.lang AND r.phrase = array_to_string(p.w[k + 1 : p.size], ' ')
  WHERE NOT EXISTS (SELECT 1 FROM inner_ x WHERE x.lang = p.lang AND x.phrase = p.phrase AND 100 * x.f >= 100 * p.f)
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS turn FROM cuts
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest WHERE turn = 1
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


@query("op11_phrase_collocations", OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    from costlens.llm.collocations import mine_collocations

    return mine_collocations(table(spark, sf, "documents"))
