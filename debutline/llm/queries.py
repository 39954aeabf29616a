"""The operators bound to the given tables with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.llm import decontaminate, digest, html_extract, incremental_means, language, manifest, mix, piece_codec, quality, simhash, token_counts, token_file, warc
from debutline.llm.shared import table


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is, for driver and executors alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages, html_extract.fit(pages))
    return found.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op3_token_file(spark: SparkSession, folder: str) -> DataFrame:
    return token_file.token_table(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))
    return counted.select("doc_id", F.col("_words").alias("n_words"), F.col("_tokens").alias("n_tokens"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_windows(documents, table(spark, folder, "benchmark"))
    return decontaminate.judged(found.drop("text"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages").select("page_id", "url", "html"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op6_digest(spark: SparkSession, folder: str) -> DataFrame:
    return digest.with_next(table(spark, folder, "documents").select("doc_id", "text"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = language.fit(documents.where(language.learnable("doc_id")))
    found = language.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (~language.learnable("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality.fit(quality.labelled_rows(documents, table(spark, folder, "labels")))
    return quality.score(documents, weights).select(
        "doc_id",
        (~quality.learnable("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= quality.GOOD).cast("int").alias("predicted"),
    )


def op11_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return incremental_means.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    every_fifth = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return manifest.manifest(table(spark, folder, "documents").select(*fields), fields, tampered=every_fifth)


def op13_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = piece_codec.round_trip(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", *[F.col(f"_{name}").alias(name) for name in ("n_tokens", "ids_sha256", "decoded_sha256")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_html": op2_html,
    "op3_token_file": op3_token_file,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_digest": op6_digest,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_kmeans": op11_kmeans,
    "op12_manifest": op12_manifest,
    "op13_pieces": op13_pieces,
}

# 20 bits of a hash are 5 hex digits and 4 letters of base32
WARC_SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), firsts AS (
    SELECT hex, max(page_id) AS response FROM payloads GROUP BY hex
)
SELECT page_id, n AS payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to,
    CAST(NULL AS VARCHAR) AS problem
FROM payloads JOIN firsts USING (hex)
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
WINDOW_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, k, list_slice(ws, p, p + k - 1) AS win
      FROM (SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0)),
g AS (SELECT doc_id, p, k, list_slice(ws, p, p + k - 1) AS win
      FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM w) WHERE len(ws) >= k)),
h AS (SELECT DISTINCT doc_id, item_id, p, g.k FROM g JOIN w ON g.win = w.win),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""



def means_sql(dimensions: int = 64, centroids: int = 40, rounds: int = 5, scale: int = 256, salt: str = "2:") -> str:
    """Every round spelled out: all distances anew, then the floors of the means."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id), x) - 1 AS k, x AS c FROM v ORDER BY k LIMIT {centroids})""",
    ]
    for turn in range(rounds + 1):
        parts.append(
            f"""a{turn} AS MATERIALIZED (SELECT r, vec_id, x, k, d FROM (
  SELECT r, vec_id, x, k, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v CROSS JOIN c{turn})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""
        )
        if turn < rounds:
            parts.append(
                f"""s{turn} AS (SELECT k, j, sum(xj) AS s, count(*) AS n FROM (SELECT k, unnest(x) AS xj, unnest(range(1, {dimensions + 1})) AS j FROM a{turn}) GROUP BY k, j),
m{turn} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{turn} GROUP BY k),
c{turn + 1} AS MATERIALIZED (SELECT c{turn}.k, coalesce(m{turn}.c, c{turn}.c) AS c FROM c{turn} LEFT JOIN m{turn} ON m{turn}.k = c{turn}.k)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)"""


def manifest_sql(levels: int = 6, fanout: int = 16) -> str:
    """The levels of every tree as lists, one after the other; `levels` of them are enough for fanout ** levels rows of a source."""

    def field(name: str) -> str:
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode(CAST({name} AS VARCHAR))) || ':' || {name} END"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = "sha256(" + " || ".join(map(field, fields)) + ")"
    now = "sha256(" + " || ".join([*map(field, fields[:-1]), f"CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode({low})) || ':' || {low} END"]) + ")"
    # a bit at a time, as there is no such function: a byte goes in, then come eight shifts
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i:
    [CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""

    def tree(name: str) -> list[str]:
        up = [f"len(l{k}) AS n{k}" for k in range(levels + 1)]
        chain = []
        for k in range(levels):
            base = name if k == 0 else f"{name}_{k}"
            following = f"CASE WHEN len(l{k}) <= 1 THEN l{k} ELSE list_transform(range(0, len(l{k}), {fanout}), lambda i: sha256(array_to_string(list_slice(l{k}, i + 1, i + {fanout}), ''))) END AS l{k + 1}"
            chain.append(f"{name}_{k + 1} AS (SELECT *, {following} FROM {base})")
        chain.append(f"{name}_up AS MATERIALIZED (SELECT *, {', '.join(up)} FROM {name}_{levels})")
        return chain

    def siblings(tree: str, at: str) -> str:
        parts = []
        for k in range(levels):
            place = f"({at} // {fanout ** k})"
            first = f"({place} - {place} % {fanout})"
            run = f"array_to_string(list_slice({tree}.l{k}, {first} + 1, {place}) || list_slice({tree}.l{k}, {place} + 2, {first} + {fanout}), '')"
            parts.append(f"CASE WHEN {tree}.n{k} > 1 THEN {run} ELSE '' END")
        return " || ".join(parts)

    def fold(tree: str, at: str, start: str) -> list[str]:
        steps = [f"{start} AS f0"]
        for k in range(levels):
            place = f"({at} // {fanout ** k})"
            first = f"({place} - {place} % {fanout})"
            sides = [f"array_to_string(list_slice({tree}.l{k}, {first} + 1, {place}), '')", f"array_to_string(list_slice({tree}.l{k}, {place} + 2, {first} + {fanout}), '')"]
            steps.append(f"CASE WHEN {tree}.n{k} > 1 THEN sha256({sides[0]} || f{k} || {sides[1]}) ELSE f{k} END AS f{k + 1}")
        return steps

    sources = ", ".join(["g AS (SELECT source, list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS l0 FROM d GROUP BY source)", *tree("g")])
    whole = ", ".join(["w AS (SELECT list(l0[1] ORDER BY source NULLS FIRST) AS l0 FROM (SELECT source, l%d AS l0 FROM g_up))" % levels, *tree("w")])
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, source, {leaf} AS leaf, CASE WHEN ({crc}) % 5 = 0 THEN {now} END AS now,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {leaf}) - 1 AS p FROM documents),
{sources},
{whole},
o AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS q FROM g),
e AS (SELECT d.*, q FROM d JOIN o ON o.source IS NOT DISTINCT FROM d.source),
x AS (SELECT doc_id, leaf, q, g_up.l{levels}[1] AS subroot, w_up.l{levels}[1] AS root, sha256({siblings("g_up", "p")} || {siblings("w_up", "q")}) AS proof_sha256,
    {", ".join(fold("g_up", "p", "coalesce(now, leaf)"))}
  FROM e JOIN g_up ON g_up.source IS NOT DISTINCT FROM e.source CROSS JOIN w_up),
y AS (SELECT doc_id, leaf, subroot, root, proof_sha256, {", ".join(fold("w_up", "q", f"x.f{levels}")).replace(" AS f", " AS h").replace("|| f", "|| h").replace("ELSE f", "ELSE h")} FROM x CROSS JOIN w_up)
SELECT doc_id, leaf, subroot, root, proof_sha256, h{levels} AS folded_root, h{levels} = root AS verified FROM y"""


SQL: dict[str, str] = {"op5_decontaminate": WINDOW_SQL, "op9_warc": WARC_SQL, "op11_kmeans": means_sql(), "op12_manifest": manifest_sql()}
