"""The registered queries of the numbered operators: thin wrappers that read the
whole table, apply the operator with production parameters and derive the
columns of its contract.  ``ORACLE`` holds the DuckDB text where SQL can express
the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact_dedup, langid, licenses, merkle, packing, pii, ranked, secrets, setsketch, sharding, suffixes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_exact_dedup", oracle="""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op6_exact_dedup(spark, sf_dir):
    """6: exact duplicates of documents by a stateful stream."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op5_setsketch")
def op5_setsketch(spark, sf_dir):
    """5: near duplicates of documents on 3-word shingles at similarity 0.85."""
    return setsketch.near_dedup(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


@query("op2_decontam", oracle=f"""
WITH win AS (
  SELECT DISTINCT item, w[s:s + 12] AS k, least(len(w), 13) AS n FROM (
    SELECT CAST(item_id AS VARCHAR) AS item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s
    FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
hit AS (
  SELECT r, s, win.n, item FROM (
    SELECT r, s, n, w[s:s + n - 1] AS k FROM (
      SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM win))) g
  JOIN win ON g.n = win.n AND g.k = win.k),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN pos USING (r) LEFT JOIN its USING (r)""")
def op2_decontam(spark, sf_dir):
    """2: documents against the windows of benchmark."""
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def byte_bpe():
    """Encoder of the public byte-level BPE vocabulary."""
    import public_tokenizers as files
    return packing.bpe_encoder(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)


@query("op7_packing")
def op7_packing(spark, sf_dir):
    """7: all documents as token pieces in sequences of 2048."""
    return packing.digest_columns(packing.pack(table(spark, sf_dir, "documents"), byte_bpe()))


@query("op9_langid")
def op9_langid(spark, sf_dir):
    """9: the language of every document by a bidirectional GRU over bytes."""
    return langid.fit_identify(table(spark, sf_dir, "documents"))


@query("op4_secrets")
def op4_secrets(spark, sf_dir):
    """4: secrets in all documents through the blob ledger."""
    return secrets.digest_columns(secrets.scan(table(spark, sf_dir, "documents")))


@query("op10_pii")
def op10_pii(spark, sf_dir):
    """10: personal data in all documents, and the terms that disclose it."""
    return pii.digest_columns(pii.find(table(spark, sf_dir, "documents")))


@query("op1_licenses")
def op1_licenses(spark, sf_dir):
    """1: licence phrases and passages in all documents."""
    return licenses.labelled(licenses.scan(table(spark, sf_dir, "documents")))


@query("op3_warc", oracle="""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         (CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM q""")
def op3_warc(spark, sf_dir):
    """3: all pages written as WARC records and read back by byte ranges."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_sharding")
def op8_sharding(spark, sf_dir):
    """8: all documents in 24 shards by virtual slots."""
    return sharding.assign(table(spark, sf_dir, "documents")).drop("vslot")


_TERMS = ("list_transform(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), "
          "lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))")


@query("op13_ranked_search", oracle=f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_TERMS}, []) AS t FROM documents),
ask AS (SELECT i, item_id, unnest(list_distinct(t)) AS term
        FROM (SELECT row_number() OVER () AS i, item_id, coalesce({_TERMS}, []) AS t FROM benchmark)),
size AS (SELECT count(*) FILTER (len(t) > 0) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM doc),
post AS (SELECT r, doc_id, n, term, count(*) AS tf
         FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM doc) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * size.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
       FROM post, size GROUP BY term, size.n),
hit AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * post.n * size.n) // size.l))))
               AS BIGINT) AS score
        FROM ask JOIN wt USING (term) JOIN post USING (term), size GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM hit WHERE score > 0) WHERE rank <= 10""")
def op13_ranked_search(spark, sf_dir):
    """13: the ten best documents of every item of benchmark."""
    return ranked.search(ranked.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


# crc32 of ASCII text, bit by bit: DuckDB has no such function.
_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
        "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


def _leaf_sql(text: str) -> str:
    columns = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"


@query("op11_merkle", oracle=f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
               CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
                    ELSE {_leaf_sql("text")} END AS claim
        FROM documents)),
low AS (
  SELECT source, 0 AS k, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT source, k + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY source, k, i // 3, n),
tops AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS trees FROM low WHERE n = 1),
high AS (
  SELECT 0 AS k, rank AS i, trees AS n, subroot AS h FROM tops
  UNION ALL
  SELECT k + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY k, i // 3, n),
nodes AS (
  SELECT source, k, i, n, h, false AS top FROM low UNION ALL SELECT NULL, k, i, n, h, true FROM high),
runs AS (
  SELECT source, top, k, i // 3 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY source, top, k, i // 3),
climb AS (
  SELECT l.source, l.i AS leaf_i, rank, false AS top, 0 AS k, l.i AS pos, l.n, l.claim AS folded, '' AS proof
  FROM leaves l JOIN tops t ON l.source IS NOT DISTINCT FROM t.source
  UNION ALL
  SELECT c.source, leaf_i, rank, c.n = 1 OR c.top, CASE WHEN c.n = 1 THEN 0 ELSE c.k + 1 END, CASE WHEN c.n = 1 THEN rank ELSE pos // 3 END,
         CASE WHEN c.n = 1 THEN (SELECT count(*) FROM tops) ELSE (c.n + 2) // 3 END,
         CASE WHEN c.n = 1 THEN folded ELSE sha256(array_to_string(list_transform(hs, lambda x, j: CASE WHEN j = pos % 3 + 1 THEN folded ELSE x END), '')) END,
         CASE WHEN c.n = 1 THEN proof ELSE proof || array_to_string(list_transform(hs, lambda x, j: CASE WHEN j = pos % 3 + 1 THEN '' ELSE x END), '') END
  FROM climb c LEFT JOIN runs r ON c.n > 1 AND r.top = c.top AND r.k = c.k AND r.run = pos // 3
       AND (c.top OR r.source IS NOT DISTINCT FROM c.source)
  WHERE NOT (c.top AND c.n = 1)),
done AS (SELECT source, leaf_i, folded, proof FROM climb WHERE top AND n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves l JOIN tops t ON l.source IS NOT DISTINCT FROM t.source
JOIN done d ON l.source IS NOT DISTINCT FROM d.source AND l.i = d.leaf_i, (SELECT h AS root FROM high WHERE n = 1)""")
def op11_merkle(spark, sf_dir):
    """11: every row of documents proved against the manifest, with line breaks lost on the way for some."""
    docs = table(spark, sf_dir, "documents")
    lost = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))) \
        .otherwise(F.col("text"))
    manifest = merkle.build(docs, ["doc_id", "source", "lang", "n_chars", "text"], claim={"text": lost})
    return merkle.verify(manifest).withColumn("proof_sha256", F.sha2(F.array_join(F.transform(
        "siblings", lambda x: F.lower(F.hex(x))), ""), 256)).drop("siblings")


@query("op12_suffix_array")
def op12_suffix_array(spark, sf_dir):
    """12: documents without the passages of 200 bytes that stand in several places."""
    cut = suffixes.dedup(table(spark, sf_dir, "documents"), keep="none")
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
