"""The registered queries of the corpus operators and their SQL checks."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.llm import (
    decontaminate,
    html_text,
    langid,
    lexical_search,
    line_dedup,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    toxicity,
    url_filter,
    vectors,
)
from orebed.llm.common import remainder

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]

_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLES["op2_url_filter"] = f"""WITH rules(verdict, h, p) AS (VALUES {_RULES}),
    rest AS (SELECT page_id, row_number() OVER () AS n, CASE WHEN contains(url, '://')
        THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS r FROM pages),
    split AS (SELECT page_id, n, translate(regexp_extract(r, '^[^/]*'), {_AZ}) AS host,
        substr(r, length(regexp_extract(r, '^[^/]*')) + 1) AS path FROM rest),
    best AS (SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
        FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN best USING (n)"""


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, " + _AZ + ")"

ORACLES["op3_decontaminate"] = f"""WITH
    d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
    spots AS (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0),
    windows AS (SELECT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS part FROM spots),
    sizes AS (SELECT DISTINCT size FROM windows),
    starts AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, sizes WHERE len(w) >= size),
    found AS (SELECT doc_id, i, s.size AS size, item_id FROM starts AS s
        JOIN (SELECT DISTINCT item_id, size, part FROM windows) AS p
        ON p.size = s.size AND p.part = array_to_string(list_slice(w, i, i + s.size - 1), ' ')),
    hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM
        (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM
        (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
    SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit,
        cast(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    classifier = toxicity.fit(documents, table(spark, sf_dir, "labels"), of=5, held_out=0)
    scored = toxicity.score(documents, classifier)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def pack(documents: DataFrame) -> DataFrame:
    return packing.pack_documents(
        documents,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    network = langid.fit(documents, of=4, held_out=2)
    found = langid.identify(documents, network)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    kinds = F.split("base", ",")
    count = lambda kind: F.size(F.filter(kinds, lambda s: s.startswith(kind + ":"))).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]),
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )


_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
ORACLES["op8_vector_forest"] = f"""WITH RECURSIVE
    good AS (SELECT vec_id, cast(embedding AS double[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good AS a JOIN good AS b
        ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
    reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings
        UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x),
    least AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
    links AS (SELECT x AS vec_id, count(*) AS n FROM pairs GROUP BY x)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN links USING (vec_id)"""


@query
def op8_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"), of=4, held_out=2)
    return quality.score(documents, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("fp")


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents repeat a part of themselves from a place on; those without an id are left as they are."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(table(spark, sf_dir, "documents"), change=planted_repeats)
    key = lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"])
    best = F.array_min(F.transform("runs", key))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
    return best


_SPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
ORACLES["op12_line_dedup"] = f"""WITH lines AS (SELECT n, doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM
        (SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    keyed AS (SELECT n, doc_id, i, line, {_LOWER.format(f"trim(line, {_SPACE})")} AS k FROM lines),
    repeated AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
        GROUP BY k HAVING count(DISTINCT doc_id) > 1),
    judged AS (SELECT n, doc_id, i, line, first_doc IS NOT NULL AND first_doc <> doc_id AS gone
        FROM keyed LEFT JOIN repeated USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY n, doc_id"""


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = line_dedup.dedupe(documents, line_dedup.insert(documents))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')"
ORACLES["op13_lexical_search"] = f"""WITH
    d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
    b AS (SELECT DISTINCT q, item_id, unnest(t) AS term FROM
        (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark)),
    size AS (SELECT count(*) AS n_docs, sum(len(t)) AS total FROM d WHERE len(t) > 0),
    held AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
        WHERE term IN (SELECT term FROM b) GROUP BY r, doc_id, n, term),
    weights AS (SELECT term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS bigint) AS w
        FROM held, size GROUP BY term, n_docs),
    scored AS (SELECT q, item_id, r, doc_id, cast(sum(w * ((1000000000 * tf)
            // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total)))) AS bigint) AS score
        FROM b JOIN weights USING (term) JOIN held USING (term), size GROUP BY q, item_id, r, doc_id),
    ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
        FROM scored WHERE score > 0)
    SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
