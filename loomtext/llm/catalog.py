"""Queries of the ten operators over the driver tables, with production parameters, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.session import ship, table

SHARDS = 40
#: Appended to each document's ids.
END_ID = 2


def op10_sharding(spark, sf_dir):
    """All documents into 40 shards by jump consistent hashing of doc_id."""
    from loomtext.llm.sharding import assign_shards

    out = assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op1_suffix_dedup(spark, sf_dir):
    """Bytes of each document inside 400-byte strings that also start elsewhere."""
    from loomtext.llm.repeats import drop_repeats

    ship(spark)
    return drop_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_decontamination(spark, sf_dir):
    """Words of each document inside ten-word windows of benchmark items."""
    from loomtext.llm.decontaminate import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op3_sentencepiece(spark, sf_dir):
    """All documents encoded to piece ids by unigram Viterbi, and decoded again."""
    import public_tokenizers

    from loomtext.llm.unigram import encoded_digests

    ship(spark)
    return encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_quality(spark, sf_dir):
    """Quality scores of all documents by positive-unlabelled learning."""
    from loomtext.llm.quality import THRESHOLD, held_out, learn_quality, score_quality

    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_pii(spark, sf_dir):
    """Personal data in all documents."""
    from loomtext.llm.pii import KINDS, SECRET, count_of, personal_data, span_text

    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [count_of("base", k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text("base").cast("binary"), 256).alias("base_sha256"), span_text("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"), count_of("spans", SECRET).alias("n_secret"))


def op6_jaccard_join(spark, sf_dir):
    """Documents linked at 90 % of their three-word shingles, by component."""
    from loomtext.llm.jaccard import near_duplicates

    ship(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component_doc").alias("component_id"))


def op7_line_dedup(spark, sf_dir):
    """What is left of each document without later repeats of runs of lines."""
    from loomtext.llm.linededup import drop_repeated_lines

    left = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op8_token_files(spark, sf_dir):
    """All documents as token ids in wavelet-matrix shards, read back."""
    import public_tokenizers

    from loomtext.llm.tokenfiles import read_token_files, write_token_files

    ship(spark)
    path = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return read_token_files(spark, path)


def op9_nearest(spark, sf_dir):
    """The 20 nearest vectors of every 20th vector, by inner product."""
    from loomtext.llm.neighbours import nearest

    ship(spark)
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def queries():
    return {"op1_suffix_dedup": op1_suffix_dedup, "op2_decontamination": op2_decontamination, "op3_sentencepiece": op3_sentencepiece, "op4_quality": op4_quality, "op5_pii": op5_pii, "op6_jaccard_join": op6_jaccard_join, "op7_line_dedup": op7_line_dedup, "op8_token_files": op8_token_files, "op9_nearest": op9_nearest, "op10_sharding": op10_sharding}


LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOW}, '{CLASS}') AS w FROM documents),
     i AS (SELECT item_id, regexp_extract_all({LOW}, '{CLASS}') AS w FROM benchmark),
     iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, w[p:p + least(10, len(w)) - 1] AS win
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT size FROM iw),
     dw AS (SELECT r, p, size, w[p:p + size - 1] AS win
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)),
     hit AS (SELECT r, p, size, item_id FROM dw JOIN iw USING (size, win)),
     word AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + size)) AS q FROM (SELECT DISTINCT r, p, size FROM hit)) GROUP BY r),
     it AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN it USING (r)
"""


OP6_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({LOW}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], chr(1)) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
     l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
     e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
     r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
     m AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m.least, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP7_SQL = """
WITH l AS (SELECT doc_id, pos, line, len(list_filter(string_split(line, ' '), lambda x: x <> '')) AS w
           FROM (SELECT doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS line
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents))),
     s AS (SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM l WHERE w > 0),
     f AS (SELECT 0 AS kind, doc_id, min(pos) OVER z AS lo, max(pos) OVER z AS hi, sum(w) OVER z AS total, list(line) OVER z AS run FROM s
           WINDOW z AS (PARTITION BY doc_id ORDER BY upto - w RANGE BETWEEN CURRENT ROW AND 29 FOLLOWING)
           UNION ALL
           SELECT 1, doc_id, min(pos) OVER z, max(pos) OVER z, sum(w) OVER z, list(line) OVER z FROM s
           WINDOW z AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)),
     k AS (SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY kind, run ORDER BY doc_id, lo) AS nth FROM f WHERE total >= 30),
     g AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM k WHERE nth > 1),
     t AS (SELECT l.doc_id, l.pos, l.line, l.w, g.pos IS NOT NULL AND l.w > 0 AS seen, g.pos IS NOT NULL AS gone FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.pos = l.pos)
SELECT doc_id, CAST(count(*) FILTER (w > 0) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM t GROUP BY doc_id
"""


def oracle_sql():
    return {"op2_decontamination": OP2_SQL, "op6_jaccard_join": OP6_SQL, "op7_line_dedup": OP7_SQL}
