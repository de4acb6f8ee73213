"""Registered queries of the corpus operators: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.llm import containment, contextmix, crosstok, dac, hardnegatives, licenses, minhash, mixing, multiindex, repeats, reputation, toxicity, warc

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bucket_of(column: str, buckets: int) -> Column:
    """crc32 of an id as text, modulo ``buckets``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % buckets


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is a bad outcome when the label with its number says quality 0."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return reputation.judge(table(spark, sf_dir, "pages"), labels, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contextmix.score(table(spark, sf_dir, "documents"), folds=10)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return taken.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op8_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(listed).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = dac.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file())
    return dac.read_tokens(listed).select("doc_id", "start", "n_tokens", "ids_crc32")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(bucket_of("doc_id", 3) != 1)
    return toxicity.train(docs, labels)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir, docs))
    held_out = F.coalesce(bucket_of("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector bears the label after its own."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.aligned_documents(table(spark, sf_dir, "documents"), tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_embeddings, op3_url_filters, op4_near_duplicates, op5_repeats, op6_context_mixing, op7_mixing, op8_archives, op9_tokens, op10_toxicity,
        op11_licenses, op12_hard_negatives, op13_alignment,
    )
}

#: A-Z lower-cased, then words
_WORDS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


def _shingles(table_name: str, key: str, size: int) -> str:
    return f"""SELECT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) END) s
    FROM (SELECT {key}, {_WORDS.format("text")} w FROM {table_name} WHERE text IS NOT NULL)"""


def _shrink(children: str, strength: str) -> str:
    """SQL of one level: posterior mean of each row of ``children`` (n, bad, prior), with the fitted strength."""
    rho = "(sum(pow(bad - n * prior, 2) / (prior * (1 - prior))) - sum(n)) / nullif(sum(n * (n - 1)), 0)"
    return f"""{strength} AS (SELECT 1 / greatest(1e-4, least(0.99, coalesce({rho}, 1e-4))) - 1 k FROM {children})"""


def _places(phrase: str) -> str:
    """SQL of the places, from 0, where the phrase's words stand in the list w."""
    words = phrase.split(" ")
    met = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words, 1))
    return f"list_filter(range(0, greatest(len(w) - {len(words) - 1}, 0)), lambda i: {met})"


_TEMPLATES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
_ALNUM = _WORDS.replace(r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

ORACLE = {
    "op11_licenses": f"""
        WITH d AS (SELECT doc_id, {_ALNUM.format("coalesce(text, '')")} w FROM documents),
        t AS (SELECT n, label, list_distinct(x) tokens, CAST(pow(2, ceil(log2(len(x)))) AS BIGINT) span
            FROM (SELECT n, label, {_ALNUM.format("text")} x FROM (VALUES {_TEMPLATES}) v(n, label, text))),
        b AS (SELECT doc_id, span, s, w[s + 1:s + 2 * span] x FROM (SELECT doc_id, w, span, unnest(range(0, len(w), span)) s FROM d, (SELECT DISTINCT span FROM t))),
        m AS (SELECT doc_id, label, len(list_intersect(tokens, list_distinct(x))) / len(tokens) c FROM b JOIN t USING (span) WHERE 100 * len(list_intersect(tokens, list_distinct(x))) >= {licenses.PERCENT} * len(tokens)),
        g AS (SELECT doc_id, list(DISTINCT label) met, max(c) c FROM m GROUP BY doc_id),
        p AS (SELECT doc_id, w, {_places("mit license")} mit, {_places("apache license")} apache, {_places("general public license")} gpl FROM d),
        q AS (SELECT doc_id, w, list_concat(list_concat(mit, apache), gpl) places,
            list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) base FROM p)
        SELECT doc_id, len(w) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word, array_to_string(base, ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(base, coalesce(met, [])))), ',') AS labels,
            CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score
        FROM q LEFT JOIN g USING (doc_id)""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id a, b.vec_id b, a.label = b.label same, list_dot_product(a.e, b.e)::BIGINT x FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY x DESC, b) <= 5),
        n AS (SELECT p.a, p.b, p.x, s.b nb, s.x nx, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.x DESC, s.b) r
            FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.x <= 100 * s.x AND s.x <= p.x QUALIFY r <= 5)
        SELECT a AS anchor_id, b AS positive_id, CAST(r AS INT) AS rank, nb AS negative_id, x AS positive_score, nx AS negative_score FROM n""",
    "op2_embeddings": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] e, sqrt(list_dot_product(e, e)) n FROM embeddings),
        links AS (SELECT a.vec_id a, b.vec_id b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.9 * a.n * b.n),
        reach AS (SELECT vec_id id, vec_id r FROM embeddings UNION SELECT reach.id, b FROM reach JOIN links ON reach.r = a),
        least AS (SELECT id vec_id, min(r) component_id FROM reach GROUP BY id)
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least""",
    "op3_url_filters": f"""
        WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') path FROM pages),
        l AS (SELECT doc_id page_id, max(1 - quality) bad FROM labels GROUP BY ALL),
        h AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') dom, string_split(host, '.')[-1] suf, count(bad) n, coalesce(sum(bad), 0) bad FROM p LEFT JOIN l USING (page_id) GROUP BY ALL),
        s AS (SELECT suf, sum(n) n, sum(bad) bad, (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) FROM h) prior FROM h GROUP BY suf), {_shrink("s", "ks")},
        d AS (SELECT dom, h.suf, sum(h.n) n, sum(h.bad) bad, any_value((s.bad + s.prior * k) / (s.n + k)) prior FROM h JOIN s USING (suf), ks GROUP BY ALL), {_shrink("d", "kd")},
        hh AS (SELECT host, h.n, h.bad, (d.bad + d.prior * k) / (d.n + k) prior FROM h JOIN d USING (dom), kd), {_shrink("hh", "kh")},
        r AS (SELECT host, n + k total, (bad + prior * k) / (n + k) rate FROM hh, kh),
        rules(rh, rp, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        m AS (SELECT host, path, arg_max(rh || rp, strlen(rh || rp)) rule, arg_max(verdict, strlen(rh || rp)) v FROM (SELECT DISTINCT host, path FROM p) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
        SELECT page_id, p.host, p.path, rule,
            coalesce(v, CASE WHEN p.host <> '' AND rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM p JOIN r USING (host) LEFT JOIN m ON m.host = p.host AND m.path = p.path""",
    "op8_archives": """
        WITH p AS (SELECT page_id, coalesce(html, '') t, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        g AS (SELECT payload_digest, min(page_id) lead FROM p WHERE payload_bytes >= 100 GROUP BY ALL)
        SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN lead <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN lead <> page_id THEN lead END AS refers_to
        FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest""",
    "op1_decontamination": f"""
        WITH d AS ({_shingles("documents", "doc_id", 5)}), i AS ({_shingles("benchmark", "item_id", 5)}),
        n AS (SELECT item_id, count(*) n_item_shingles FROM i GROUP BY item_id),
        c AS (SELECT doc_id, item_id, count(*) n_shared FROM d JOIN i USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles AS containment
        FROM c JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item_shingles""",
    "op4_near_duplicates": f"""
        WITH RECURSIVE d AS ({_shingles("documents", "doc_id", 4)}),
        n AS (SELECT doc_id, count(*) n FROM d GROUP BY doc_id),
        c AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM d a JOIN d b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id id, doc_id r FROM documents UNION SELECT reach.id, b FROM reach JOIN both_ways ON reach.r = a),
        least AS (SELECT id doc_id, min(r) component_id FROM reach GROUP BY id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)""",
}
