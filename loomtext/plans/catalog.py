"""Registry: the operators as queries over the driver tables, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import text as tx
from loomtext.functions.language import from_column, heuristic
from loomtext.operators import filters, html, merge, segment, setops, stats
from loomtext.plans.gates import GateConfig, measures, run_gates
from loomtext.session import table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with its oracle where there is one."""

    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


#: SQL forms of the text helpers; the tables hold no white space but spaces and newlines.
STRIP = r"regexp_replace({0}, '^[\s]+|[\s]+$', '', 'g')"
KEY = STRIP.format("lower(coalesce(text, ''))")
TOKENS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\s]+'))"
TEXTS = r"[x for x in [regexp_replace(y, '^[\s]+|[\s]+$', '', 'g') for y in {0}] if x <> '']"
SENTENCES = TEXTS.format(r"string_split(regexp_replace(coalesce(text, ''), '([.!?…])\s+', '\1' || chr(10), 'g'), chr(10))")
ARTICLE = rf"[x for x in string_split(regexp_replace({STRIP.format(chr(114) + 'egexp_replace(coalesce(text, ' + chr(39) * 2 + '), ' + chr(39) + chr(92) + 's+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) if len(string_split(x, ' ')) >= 3]"


def corpus(spark, sf_dir):
    """documents as a corpus: text, sources, and doc_id as order."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.array("source").alias("sources"), "source", "lang", F.col("doc_id").alias("ord"))


def benchmark(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("text", F.array(F.lit("benchmark")).alias("sources"), F.col("item_id").alias("ord"))


def flat(df):
    """Array columns of strings joined by a bar, so that both engines hash the same scalar."""
    return df.select(*[F.array_join(c, "|").alias(c) if t == "array<string>" else F.col(c) for c, t in df.dtypes])


# --- merging and dedup -------------------------------------------------------------------------------------------------


@query(f"SELECT arg_min(text, doc_id) AS text, array_to_string(list_sort(list_distinct(list(source))), '|') AS sources FROM documents GROUP BY {KEY}")
def provenance_merge(spark, sf_dir):
    return flat(merge.provenance_merge(corpus(spark, sf_dir), F.col("ord")))


@query(f"""
WITH u AS (SELECT text, source, doc_id AS o FROM documents UNION ALL SELECT text, 'benchmark', 1000000000000 + item_id FROM benchmark)
SELECT arg_min(text, o) AS text, array_to_string(list_sort(list_distinct(list(source))), '|') AS sources FROM u WHERE {KEY} <> '' GROUP BY {KEY}""")
def corpus_union_merge(spark, sf_dir):
    return flat(merge.corpus_union_merge([corpus(spark, sf_dir).select("text", "sources", "ord"), benchmark(spark, sf_dir)]))


@query(f"""
WITH u AS (SELECT 0 AS r, doc_id AS o, text, source AS s FROM documents UNION ALL SELECT 1, item_id, text, 'benchmark' FROM benchmark)
SELECT text, s AS sources FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY r, o) AS n FROM u) WHERE n = 1""")
def append_merge_first_wins(spark, sf_dir):
    return flat(merge.append_merge([corpus(spark, sf_dir).select("text", "sources", "ord"), benchmark(spark, sf_dir)]).select("text", "sources"))


@query("SELECT text, source AS sources FROM documents UNION ALL SELECT text, 'benchmark' FROM benchmark")
def bag_union(spark, sf_dir):
    return flat(merge.bag_union([corpus(spark, sf_dir).select("text", "sources"), benchmark(spark, sf_dir).select("text", "sources")]))


_LAST_LABEL = "SELECT doc_id, quality, toxic FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY quality DESC NULLS LAST, toxic DESC NULLS LAST) AS r FROM labels) WHERE r = 1"


@query(f"""
WITH e AS ({_LAST_LABEL})
SELECT * FROM e UNION ALL SELECT DISTINCT doc_id, CAST(9 AS INTEGER), CAST(9 AS INTEGER) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM e)""")
def keyed_append_merge_whole(spark, sf_dir):
    """All labels, then all documents whose id they lack; rows that repeat a doc_id go by their values."""
    old = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.struct("quality", "toxic").alias("o"))
    new = table(spark, sf_dir, "documents").select("doc_id", F.lit(9).alias("quality"), F.lit(9).alias("toxic"))
    return merge.keyed_append(old, new.withColumn("o", F.struct("quality", "toxic")), "doc_id", "o").drop("o")


@query(f"""
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, coalesce(l.quality, -1) AS quality
FROM (SELECT doc_id, max(lang) AS lang FROM documents GROUP BY 1) d FULL JOIN ({_LAST_LABEL}) l ON l.doc_id = d.doc_id""")
def keyed_enrich_merge_whole(spark, sf_dir):
    """All documents with the quality of all labels; rows that repeat a doc_id go by their values."""
    base = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit(-1).alias("quality"), F.col("lang").alias("o"))
    extra = table(spark, sf_dir, "labels").select("doc_id", "quality", F.col("quality").cast("string").alias("o"))
    both = merge.keyed_enrich(base, extra, "doc_id", "o", ["quality"])
    return both.select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"))


# --- extraction and filters --------------------------------------------------------------------------------------------

_MARKED = rf"""
WITH c AS (SELECT doc_id, source, lang, {STRIP.format("text")} AS text FROM documents),
     e AS (SELECT *, CASE WHEN {TOKENS.format("text")} < 20 THEN 'short' WHEN source <> 'src0' AND lang <> 'en' THEN 'lang' END AS early FROM c),
     m AS (SELECT doc_id, source, text, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY source, early, lower(text) ORDER BY doc_id) = 1 THEN 'kept' ELSE 'dup' END) AS reason FROM e)
"""


def _ingested(spark, sf_dir):
    rows = corpus(spark, sf_dir)
    seen = from_column(F.col("lang"))
    return filters.ingest_reasons(rows, seen["label"], seen["conf"], "en", F.col("doc_id"), min_tokens=20, check_language=F.col("source") != "src0")


@query(_MARKED + "SELECT source, reason, count(*) AS n_rows FROM m GROUP BY ALL")
def ingest_cascade_counts(spark, sf_dir):
    seen = from_column(F.col("lang"))
    return filters.ingest_counts(corpus(spark, sf_dir), seen["label"], seen["conf"], "en", min_tokens=20, check_language=F.col("source") != "src0")


@query(_MARKED + "SELECT doc_id, source, text FROM m WHERE reason = 'kept'")
def ingest_kept(spark, sf_dir):
    return _ingested(spark, sf_dir).where("reason = 'kept'").select("doc_id", "source", "text")


@query(rf"""
SELECT conv_id, {STRIP.format("text")} AS text FROM conversations WHERE {STRIP.format("coalesce(text, '')")} <> ''""")
def sharegpt_extract(spark, sf_dir):
    cells = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("value")))).alias("turns"))
    return cells.select("conv_id", F.explode(filters.turn_texts(F.col("turns"))).alias("text"))


@query(rf"""
SELECT page_id, part, text FROM (SELECT page_id, 0 AS part, {STRIP.format("url")} AS text FROM pages UNION ALL SELECT page_id, 1, {STRIP.format("html")} FROM pages) WHERE text <> ''""")
def column_unpivot(spark, sf_dir):
    return filters.unpivot_texts(table(spark, sf_dir, "pages"), ["page_id"], ["url", "html"])


_CHARS = "ëñóàéèɛɔŋ"
_WORDS = "['la','na','ci','mu','du','di','ko','nga','naa','ak','gi','yi','bi','wi','mi','si','ki','mooy','doon','ñu','ñuy','muy','duy','sama','sa','man','yow','ñoom','jëf','wax','def','dem','jóg','réew','nit','boppam','mbir','yàlla','allaaxiraa']"
_HEURISTIC = rf"""
h AS (SELECT *, length(text) - length(translate(text, '{_CHARS}', '')) AS nc, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS ws FROM t),
g AS (SELECT *, len([w for w in ws if list_contains({_WORDS}, w)]) AS nw, CASE WHEN len(ws) > 0 THEN len([w for w in ws if list_contains({_WORDS}, w)]) / len(ws) ELSE 0.0 END AS ratio FROM h)
"""


@query(f"WITH t AS (SELECT doc_id, text FROM documents), {_HEURISTIC} SELECT doc_id, CAST(nc AS BIGINT) AS char_count, CAST(nw AS BIGINT) AS word_count, nc > 0 OR ratio >= 0.1 AS is_target, round(least(1.0, (CASE WHEN nc > 0 THEN 0.4 ELSE 0.0 END) + ratio * 0.6), 6) AS confidence FROM g")
def language_heuristic(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", heuristic(F.col("text")).alias("h"))
    return rows.select("doc_id", "h.char_count", "h.word_count", "h.is_target", F.round("h.confidence", 6).alias("confidence"))


_VALID = rf"""
WITH t AS (SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'page', page_id, html FROM pages), {_HEURISTIC},
v AS (SELECT kind, id, CASE WHEN coalesce(text, '') = '' THEN 'no_content' WHEN {TOKENS.format("text")} < 20 THEN 'too_short'
      WHEN list_sum([length(x) for x in regexp_extract_all(text, '<[^>]+>')]) / length(text) > 0.1 THEN 'html_residual' WHEN NOT (nc > 0 OR ratio >= 0.1) THEN 'not_target' ELSE 'passed' END AS reason,
      CAST({TOKENS.format("text")} AS BIGINT) AS word_count FROM g)
"""


def _validated(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("kind", "id", filters.validation(F.col("text")).alias("v")).select("kind", "id", "v.reason", "v.word_count")


@query(_VALID + "SELECT * FROM v")
def n1_heuristic_validate(spark, sf_dir):
    return _validated(spark, sf_dir)


@query(_VALID + "SELECT kind, reason, count(*) AS n_rows, CAST(sum(word_count) AS BIGINT) AS words FROM v GROUP BY ALL")
def n1_reason_report(spark, sf_dir):
    return _validated(spark, sf_dir).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("word_count").alias("words"))


@query(_VALID + """, r AS (SELECT v.reason, v.word_count, d.lang, round(least(1.0, (CASE WHEN g.nc > 0 THEN 0.4 ELSE 0.0 END) + g.ratio * 0.6), 6) AS conf
      FROM v JOIN documents d ON v.kind = 'doc' AND v.id = d.doc_id JOIN g ON g.kind = 'doc' AND g.id = d.doc_id),
     p AS (SELECT count(*) AS total, count(*) FILTER (reason = 'passed') AS passed, CAST(coalesce(sum(word_count) FILTER (reason = 'passed'), 0) AS BIGINT) AS words,
           round(avg(conf) FILTER (reason = 'passed'), 6) AS avg_confidence, min(conf) FILTER (reason = 'passed') AS min_confidence, max(conf) FILTER (reason = 'passed') AS max_confidence FROM r),
     l AS (SELECT lang || ':' || count(*) AS x, count(*) AS n, lang FROM r WHERE reason = 'not_target' GROUP BY lang),
     y AS (SELECT coalesce(string_agg(x, ',' ORDER BY n DESC, lang), '') AS top_rejected FROM (FROM l ORDER BY n DESC, lang LIMIT 5))
SELECT total, passed, total - passed AS rejected, round(100.0 * passed / total, 6) AS passed_pct, words, round(words / passed, 6) AS avg_words, round(words * 7 / 1048576.0, 6) AS est_mb,
       avg_confidence, min_confidence, max_confidence, top_rejected FROM p, y""")
def n1_full_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(filters.validation(F.col("text")).alias("v"), F.round(heuristic(F.col("text"))["confidence"], 6).alias("conf"), "lang")
    report = stats.validation_report(docs.select("v.reason", "v.word_count", "conf", "lang"), "reason", "word_count", "conf", "lang")
    rounded = [F.round(c, 6).alias(c) for c in ("passed_pct", "avg_words", "est_mb", "avg_confidence")]
    return report.select("total", "passed", "rejected", "words", *rounded, "min_confidence", "max_confidence", F.array_join("top_rejected", ",").alias("top_rejected"))


@query(rf"""
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'no_content' WHEN {TOKENS.format("text")} < 20 THEN 'too_short'
       WHEN coalesce(list_sum([length(x) for x in regexp_extract_all(text, '<[^>]+>')]), 0) / length(text) > 0.1 THEN 'html_residual' WHEN lang IS DISTINCT FROM 'en' THEN 'not_target' ELSE 'passed' END AS reason FROM documents""")
def n1_language_validate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", filters.validation(F.col("text"), language=F.col("lang") == "en")["reason"].alias("reason"))


@query("SELECT doc_id, coalesce(nullif(lang, 'de') = 'en', false) AS passed FROM documents")
def split_by_test(spark, sf_dir):
    passed, failed = filters.split_by(table(spark, sf_dir, "documents"), F.nullif("lang", F.lit("de")) == "en")
    return passed.select("doc_id", F.lit(True).alias("passed")).unionByName(failed.select("doc_id", F.lit(False).alias("passed")))


@query("SELECT page_id, coalesce(list_sum([length(x) for x in regexp_extract_all(html, '<[^>]+>')]), 0) / length(html) > 0.1 AS residual FROM pages")
def html_residual(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", (tx.html_share(F.col("html")) > 0.1).alias("residual"))


@query(rf"SELECT doc_id, len([w for w in regexp_extract_all(text, '[^\s]+') if length(regexp_replace(w, '[^\p{{L}}\p{{N}}_]', '', 'g')) >= 2]) >= 3 AS valid, contains(text, '```') AS code FROM documents")
def sentence_validity(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.is_valid_sentence(F.col("text")).alias("valid"), tx.has_code(F.col("text")).alias("code"))


# --- segmentation and repair -------------------------------------------------------------------------------------------

_GROUPS = f"""
WITH s AS (SELECT doc_id, source, {SENTENCES} AS x FROM documents),
     g AS (SELECT doc_id, source, unnest(range(0, len(x), 2)) AS i, x FROM s),
     p AS (SELECT doc_id, source, i // 2 AS part, array_to_string(x[i + 1:i + 2], ' ') AS text FROM g),
     k AS (SELECT *, length(text) < 10 AS short, regexp_replace(lower(text), '\\s+', ' ', 'g') AS key FROM p),
     m AS (SELECT doc_id, part, text, CASE WHEN short THEN 'short' WHEN row_number() OVER (PARTITION BY short, key ORDER BY doc_id, part) = 1 THEN 'kept' ELSE 'dup' END AS reason FROM k)
"""


@query(f"SELECT doc_id, unnest({SENTENCES}) AS text FROM documents")
def split_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.sentences(F.col("text"))).alias("text"))


@query(_GROUPS + "SELECT doc_id, CAST(part AS INTEGER) AS part, text FROM p")
def split_pairs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tx.sentence_groups(F.col("text"))).alias("part", "text"))


@query(_GROUPS + "SELECT doc_id, text FROM m WHERE reason = 'kept'")
def split_dedup(spark, sf_dir):
    return segment.kept_fragments(corpus(spark, sf_dir)).select("doc_id", "text")


@query(_GROUPS + "SELECT reason, count(*) AS n_rows, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes, CAST(0 AS BIGINT) AS n_code FROM m GROUP BY 1")
def split_counters(spark, sf_dir):
    return segment.split_counters(corpus(spark, sf_dir))


@query(_GROUPS + "SELECT doc_id, CAST(part AS INTEGER) AS part, reason FROM m")
def split_reasons(spark, sf_dir):
    return segment.split_fragments(corpus(spark, sf_dir)).select("doc_id", "part", "reason")


@query(f"SELECT doc_id, unnest({ARTICLE}) AS text FROM documents")
def article_sentences(spark, sf_dir):
    return segment.sentence_rows(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "text")


@query(rf"""
WITH s AS (SELECT lang, CAST({TOKENS.format("s")} AS BIGINT) AS n FROM (SELECT lang, unnest({ARTICLE}) AS s FROM documents)),
     r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n) AS k, count(*) OVER (PARTITION BY lang) AS c FROM s)
SELECT lang, count(*) AS n, min(n) AS min_len, max(n) AS max_len, CAST(sum(n) AS DOUBLE) / count(*) AS avg_len, max(n) FILTER (k = c // 2 + 1) AS upper_median FROM r GROUP BY lang""")
def sentence_length_stats(spark, sf_dir):
    rows = segment.sentence_rows(table(spark, sf_dir, "documents"), ["lang"])
    return stats.length_stats(rows, tx.token_count(F.col("text")), "lang")


_CHUNKS = r"""
k AS (SELECT *, greatest(1, len(w) // 18 + CASE WHEN len(w) % 18 >= 3 THEN 1 ELSE 0 END) AS k FROM t WHERE len(w) > 0),
c AS (SELECT doc_id, array_to_string(w[j * 18 + 1:CASE WHEN j < k - 1 THEN j * 18 + 18 ELSE len(w) END], ' ') AS text FROM (SELECT *, unnest(range(0, k)) AS j FROM k))
"""


@query(rf"WITH t AS (SELECT doc_id, regexp_extract_all(text, '[^\s]+') AS w FROM documents), {_CHUNKS} SELECT doc_id, text FROM c")
def word_chunks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.word_chunks(tx.tokens(F.col("text")))).alias("text"))


@query(rf"""
WITH p AS (SELECT doc_id, regexp_extract_all(unnest(string_split_regex(text, '[.!?]')), '[^\s]+') AS w FROM documents),
     t AS (SELECT * FROM p WHERE len(w) >= 3), {_CHUNKS}
SELECT doc_id, text FROM c WHERE len([x for x in string_split(text, ' ') if length(regexp_replace(x, '[^\p{{L}}\p{{N}}_]', '', 'g')) >= 2]) >= 3""")
def spoken_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.spoken_sentences(F.col("text"))).alias("text"))


#: Consecutive copies of up to six words, found word by word: each step takes the longest pattern that repeats at its place.
_COLLAPSED = r"""
WITH RECURSIVE w AS (SELECT conv_id, turn, regexp_extract_all(coalesce(text, ''), '[^\s]+') AS w FROM conversations),
s AS (SELECT conv_id, turn, 0 AS b, 0 AS k, 1 AS i FROM w UNION ALL
      SELECT conv_id, turn, i, coalesce(n, 1), i + coalesce(n * list_min([j for j in range(1, CASE WHEN n IS NULL THEN 1 ELSE len(w) // n + 2 END) if w[i + j * n:i + j * n + n - 1] <> w[i:i + n - 1]]), 1)
      FROM (SELECT conv_id, turn, w, i, CAST(list_max([x for x in range(1, 7) if i + 2 * x - 1 <= len(w) AND w[i:i + x - 1] = w[i + x:i + 2 * x - 1]]) AS INTEGER) AS n FROM s JOIN w USING (conv_id, turn) WHERE i <= len(w))),
o AS (SELECT conv_id, turn, coalesce(string_agg(array_to_string(w[b:b + k - 1], ' '), ' ' ORDER BY b) FILTER (k > 0), '') AS text FROM s JOIN w USING (conv_id, turn) GROUP BY ALL)
"""
#: Sentences of the transcripts with their places: pieces of a text, then chunks of a piece.
_CLEANED = _COLLAPSED + r""",
p AS (SELECT conv_id || '-' || turn AS video, generate_subscripts(x, 1) AS p, regexp_extract_all(unnest(x), '[^\s]+') AS w FROM (SELECT *, string_split_regex(text, '[.!?]') AS x FROM o)),
k AS (SELECT *, CASE WHEN len(w) <= 18 THEN 1 ELSE greatest(1, len(w) // 18 + CASE WHEN len(w) % 18 >= 3 THEN 1 ELSE 0 END) END AS k FROM p WHERE len(w) >= 3),
c AS (SELECT video, p, j, array_to_string(w[j * 18 + 1:CASE WHEN j < k - 1 THEN j * 18 + 18 ELSE len(w) END], ' ') AS text FROM (SELECT *, unnest(range(0, k)) AS j FROM k)),
v AS (SELECT *, lower(text) AS key, len(string_split(text, ' ')) AS n FROM c WHERE len([x for x in string_split(text, ' ') if length(regexp_replace(x, '[^\p{L}\p{N}_]', '', 'g')) >= 2]) >= 3)
"""
#: Runs of equal words in the rows (id, w, i) of u: three or more become one.
_RUNS = """
v AS (SELECT *, i - row_number() OVER (PARTITION BY id, w ORDER BY i) AS g FROM u),
q AS (SELECT id, w, min(i) AS i, count(*) AS n FROM v GROUP BY id, w, g),
z AS (SELECT id, string_agg(CASE WHEN n = 2 THEN w || ' ' || w ELSE w END, ' ' ORDER BY i) AS cleaned FROM q GROUP BY id)
"""


@query(_COLLAPSED + "SELECT conv_id, turn, text FROM o")
def collapse_repetitions(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.collapse_repetitions(F.col("text")).alias("text"))


@query(rf"""
WITH t AS (SELECT conv_id, turn, conv_id || '-' || turn AS id, regexp_extract_all(text, '[^\s]+') AS x FROM conversations),
u AS (SELECT id, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM t), {_RUNS} SELECT conv_id, turn, coalesce(cleaned, '') AS text FROM t LEFT JOIN z USING (id)""")
def dedupe_repeats(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.collapse_runs(F.col("text")).alias("text"))


@query(f"SELECT conv_id, turn, unnest({TEXTS.format(chr(115) + 'tring_split_regex(text, ' + chr(39) + '[.!?]|' + chr(92) * 2 + 'n' + chr(39) + ')')}) AS text FROM conversations")
def segment_sentences(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(tx.cut_sentences(F.col("text"))).alias("text"))


@query(_CLEANED + "SELECT arg_min(video, (video, p, j)) AS video, arg_min(text, (video, p, j)) AS text FROM v GROUP BY key")
def transcript_clean(spark, sf_dir):
    return segment.transcript_sentences(table(spark, sf_dir, "conversations").withColumn("video", F.concat("conv_id", F.lit("-"), "turn")), "video").select("video", "text")


@query(_CLEANED + """, f AS (SELECT key, count(*) AS c, min(n) AS w FROM v GROUP BY key)
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS before, count(*) AS final, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates, CAST(coalesce(sum(w), 0) AS BIGINT) AS words,
       CAST(min(w) AS BIGINT) AS min_words, CAST(max(w) AS BIGINT) AS max_words FROM f""")
def transcript_report(spark, sf_dir):
    return segment.transcript_report(table(spark, sf_dir, "conversations").withColumn("video", F.concat("conv_id", F.lit("-"), "turn")), "video")


@query(rf"""SELECT doc_id, {STRIP.format('text')} AS text FROM documents WHERE {STRIP.format("coalesce(text, '')")} <> ''""")
def article_rows(spark, sf_dir):
    return segment.article_rows(table(spark, sf_dir, "documents"), ["doc_id"])


@query(rf"""
WITH c AS (SELECT conv_id AS id, turn, regexp_extract_all(text, '[^\s]+') AS w, (turn % 10) / 10.0 AS conf FROM conversations),
g AS (SELECT id, count(*) AS n_chunks, list(w ORDER BY turn) FILTER (conf >= 0.5) AS l, round(avg(conf), 9) AS avg_confidence, count(*) FILTER (conf < 0.5) AS low_confidence FROM c GROUP BY id),
m AS (SELECT *, CASE WHEN l IS NULL THEN [] ELSE list_reduce(l, lambda a, x: list_concat(a, x[1 + list_max([k for k in range(0, 1 + least(5, len(a), len(x))) if k = 0 OR a[len(a) - k + 1:] = x[:k]]):])) END AS r FROM g),
u AS (SELECT id, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM m), {_RUNS}
SELECT id AS conv_id, n_chunks, array_to_string(r, ' ') AS raw, coalesce(cleaned, '') AS cleaned, avg_confidence, low_confidence,
       array_to_string({TEXTS.format("string_split_regex(coalesce(cleaned, ''), '[.!?]|" + chr(92) * 2 + "n')")}, '|') AS sentences FROM m LEFT JOIN z USING (id)""")
def asr_documents(spark, sf_dir):
    chunks = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("chunk_id"), "text", (F.pmod(F.col("turn"), F.lit(10)) / 10.0).alias("confidence"))
    return flat(segment.asr_documents(chunks, "conv_id")).withColumn("avg_confidence", F.round("avg_confidence", 9))


@query()
def wer(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    heard = F.array_join(F.filter(tx.tokens(F.col("text")), lambda w: F.crc32(w.cast("binary")) % 7 != 0), " ")
    rate = tx.wer(F.col("text"), heard)
    return rows.select("conv_id", "turn", rate.alias("wer"), tx.wer_band(rate).alias("band"))


@query(r"""
WITH r AS (SELECT conv_id, turn, regexp_replace(text, '[^A-Za-z ]', '', 'g') AS a FROM conversations), h AS (SELECT *, replace(replace(a, 'e', ''), ' ', '') AS b, replace(a, ' ', '') AS c FROM r)
SELECT conv_id, turn, CASE WHEN length(c) = 0 THEN 0.0 ELSE levenshtein(c, b) / length(c) END AS cer FROM h""")
def cer(spark, sf_dir):
    plain = F.regexp_replace("text", "[^A-Za-z ]", "")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.cer(plain, F.replace(plain, F.lit("e"), F.lit(""))).alias("cer"))


@query("SELECT doc_id, unnest(range(0, CASE WHEN n_chars >= 120 THEN (n_chars - 120) // 110 + 1 ELSE 0 END)) * 110 AS start FROM documents")
def chunk_windows_tail_drop(spark, sf_dir):
    starts = segment.windows_without_tail(F.col("n_chars"), 120, 110)
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(starts).alias("start")).select("doc_id", F.col("start").cast("long"))


@query("SELECT doc_id, CAST(s AS BIGINT) AS start, CAST(greatest(s + 200 - n_chars, 0) AS INTEGER) AS padding FROM (SELECT doc_id, n_chars, unnest(range(0, CASE WHEN n_chars > 0 THEN (n_chars - 1) // 180 + 1 ELSE 0 END)) * 180 AS s FROM documents)")
def chunk_windows_padded(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(segment.windows_padded(F.col("n_chars"), 200, 180)).alias("w"))
    return rows.select("doc_id", F.col("w.start").cast("long").alias("start"), "w.padding")


@query(r"""
SELECT event_id, CASE WHEN s // 3600 < 10 THEN '0' ELSE '' END || (s // 3600) || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS duration
FROM (SELECT event_id, CAST(floor(abs(value) * 100) AS BIGINT) AS s FROM events WHERE value IS NOT NULL)""")
def duration_format(spark, sf_dir):
    return table(spark, sf_dir, "events").where("value is not null").select("event_id", tx.format_duration(F.floor(F.abs("value") * 100)).alias("duration"))


@query("SELECT doc_id, CASE WHEN n_chars < 1000 THEN 'n<1K' WHEN n_chars < 10000 THEN '1K<n<10K' WHEN n_chars < 100000 THEN '10K<n<100K' WHEN n_chars < 1000000 THEN '100K<n<1M' WHEN n_chars < 10000000 THEN '1M<n<10M' ELSE '10M<n<100M' END AS size FROM documents")
def size_category(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.size_category(F.col("n_chars")).alias("size"))


# --- pages -------------------------------------------------------------------------------------------------------------

_INNER = r"regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1)"


@query(rf"""
SELECT page_id, text FROM (SELECT page_id, array_to_string([y for y in [regexp_replace(x, '^[\s]+|[\s]+$', '', 'g') for x in string_split_regex(p, '<[^>]*>')] if y <> ''], ' ') AS text
FROM (SELECT page_id, unnest({_INNER}) AS p FROM pages)) WHERE length(text) > 10""")
def html_paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(tx.paragraphs(F.col("html"))).alias("text"))


@query(r"SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*\shref=~([^~]*)~', 1)) AS href FROM pages".replace("~", '"'))
def page_links(spark, sf_dir):
    return html.page_links(table(spark, sf_dir, "pages"), "html", "page_id").select("page_id", "href")


@query(r"SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(html, '<html[^>]*\slang=~([^~]*)~', 1) AS lang, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS host FROM pages".replace("~", '"'))
def page_meta(spark, sf_dir):
    return html.page_meta(table(spark, sf_dir, "pages"), "html", "url", "page_id")


@query(rf"""
WITH p AS (SELECT page_id, html, [x for x in [array_to_string({TEXTS.format("string_split_regex(q, '<[^>]*>')")}, ' ') for q in {_INNER}] if length(x) > 10] AS p FROM pages),
     c AS (SELECT page_id, array_to_string(p, chr(10) || chr(10)) AS content, regexp_extract_all(html, '<iframe[^>]*?\ssrc=["'']([^"'']*)["'']', 1) AS f FROM p)
SELECT page_id, content, CAST({TOKENS.format("content")} AS BIGINT) AS word_count, CASE WHEN content = '' THEN 'failed' ELSE 'success' END AS status, CASE WHEN content = '' THEN 'no paragraphs' END AS error,
       len([u for u in f if (contains(u, 'youtube.com') OR contains(u, 'youtu.be')) AND (contains(u, '/embed/') OR contains(u, 'watch?v=') OR contains(u, 'youtu.be/'))]) > 0 AS has_video FROM c""")
def page_articles(spark, sf_dir):
    rows = html.articles(table(spark, sf_dir, "pages"), "html", "page_id")
    return rows.select("page_id", "content", "word_count", "has_video", "status", "error")


@query("SELECT * FROM (VALUES ('a', 'x1', 'https://www.youtube.com/watch?v=x1'), ('b', 'x2', 'https://www.youtube.com/watch?v=x2'), ('c', 'x3', 'https://www.youtube.com/watch?v=x3'), ('d', NULL, NULL)) v(id, video_id, watch_url)")
def video_ids(spark, sf_dir):
    urls = [("a", "https://www.youtube.com/embed/x1?rel=0"), ("b", "https://www.youtube.com/watch?v=x2&t=4"), ("c", "https://youtu.be/x3"), ("d", "https://example.com/v/x4")]
    rows = spark.createDataFrame(urls, "id string, url string")
    return rows.select("id", tx.video_id(F.col("url")).alias("video_id"), tx.watch_url(tx.video_id(F.col("url"))).alias("watch_url"))


def _watched(spark, sf_dir):
    """events as articles: a user's clicks and views show a video each, what they buy shows two, other events none."""
    video = lambda k: F.struct(F.concat(F.lit(k), F.col("event_id").cast("string")).alias("video_id"), tx.watch_url(F.concat(F.lit(k), F.col("event_id").cast("string"))).alias("watch_url"))
    shown = F.when(F.col("event_type").isin("click", "view"), F.array(video("a"))).when(F.col("event_type") == "purchase", F.array(video("a"), video("b")))
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.coalesce(shown, F.array().cast("array<struct<video_id:string,watch_url:string>>")).alias("videos"))


@query("SELECT user_id, max(event_id) AS event_id FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id")
def articles_with_videos(spark, sf_dir):
    return html.articles_with_videos(_watched(spark, sf_dir), "user_id", "event_id").select("user_id", "event_id")


@query("""
SELECT event_id AS article_id, event_type AS article_title, k || event_id AS video_id, 'https://www.youtube.com/watch?v=' || k || event_id AS watch_url
FROM (SELECT *, unnest(CASE WHEN event_type = 'purchase' THEN ['a', 'b'] ELSE ['a'] END) AS k FROM events WHERE event_type IN ('click', 'view', 'purchase'))""")
def video_list(spark, sf_dir):
    return html.video_list(_watched(spark, sf_dir), "event_id", "event_type")


@query("SELECT page_id, replace(url, '/', '__') AS name FROM pages")
def safe_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.safe_name(F.col("url")).alias("name"))


@query("SELECT event_id, round(abs(value) / 120, 9) AS gpu, round(abs(value) / 24, 9) AS cpu, round(abs(value) * 85 / 289, 9) AS of_size FROM events")
def time_estimates(spark, sf_dir):
    minutes = tx.transcription_minutes(F.abs("value"))
    return table(spark, sf_dir, "events").select("event_id", F.round(minutes["gpu"], 9).alias("gpu"), F.round(minutes["cpu"], 9).alias("cpu"), F.round(tx.transcription_minutes_of_size(F.abs("value")), 9).alias("of_size"))


# --- statistics --------------------------------------------------------------------------------------------------------


@query(rf"""
SELECT count(*) AS examples, CAST(sum({TOKENS.format("text")}) AS BIGINT) AS tokens, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
       count(*) FILTER ({KEY} = '') AS empty_examples, round(sum({TOKENS.format("text")}) / count(*), 6) AS avg_tokens, round(sum(length(text)) / count(*), 6) AS avg_chars FROM documents""")
def corpus_totals(spark, sf_dir):
    out = stats.corpus_totals(table(spark, sf_dir, "documents"))
    return out.select("examples", "tokens", "chars", "bytes", "empty_examples", F.round("avg_tokens", 6).alias("avg_tokens"), F.round("avg_chars", 6).alias("avg_chars"))


@query(rf"""
SELECT source, count(*) AS examples, CAST(sum({TOKENS.format("text")}) AS BIGINT) AS tokens, CAST(sum(length(text)) AS BIGINT) AS chars, round(sum({TOKENS.format("text")}) / count(*), 6) AS avg_tokens FROM documents GROUP BY source""")
def stats_by_source(spark, sf_dir):
    return stats.stats_by_source(corpus(spark, sf_dir)).withColumn("avg_tokens", F.round("avg_tokens", 6))


_SHARE = """SELECT {0} CAST(sum(n) AS BIGINT) AS evaluated, CAST(coalesce(sum(n) FILTER (lang = 'en'), 0) AS BIGINT) AS target, round(100.0 * coalesce(sum(n) FILTER (lang = 'en'), 0) / sum(n), 6) AS target_pct,
       CASE WHEN coalesce(sum(n) FILTER (lang = 'en'), 0) > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END AS target_conf, arg_min(lang, (-n, lang)) AS top_lang FROM ({1}) GROUP BY ALL"""


@query(_SHARE.format("", "SELECT lang, count(*) AS n FROM documents GROUP BY lang"))
def lang_share(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("conf", F.lit(1.0))
    return stats.language_share(rows, "lang", "conf", "en").withColumn("target_pct", F.round("target_pct", 6))


@query(_SHARE.format("source,", "SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang"))
def lang_share_by_source(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("conf", F.lit(1.0))
    return stats.language_share(rows, "lang", "conf", "en", "source").withColumn("target_pct", F.round("target_pct", 6))


@query("SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 300")
def lang_sampled(spark, sf_dir):
    return setops.sample(table(spark, sf_dir, "documents"), "doc_id", 300).select("doc_id", "lang")


@query("SELECT source, count(*) AS n_rows FROM documents GROUP BY source")
def source_histogram(spark, sf_dir):
    return stats.source_histogram(corpus(spark, sf_dir))


@query(f"SELECT count(*) AS n, count(DISTINCT {KEY}) AS distinct_keys, round(100.0 * (count(*) - count(DISTINCT {KEY})) / count(*), 6) AS duplicate_pct FROM documents")
def duplicate_rate(spark, sf_dir):
    return stats.duplicate_rate(table(spark, sf_dir, "documents")).withColumn("duplicate_pct", F.round("duplicate_pct", 6))


@query("SELECT count(*) AS n_rows, count(text) AS n_texts, round(avg(length(text)), 6) AS avg_len, count(DISTINCT source) AS n_sources FROM documents")
def dataset_profile(spark, sf_dir):
    return stats.dataset_profile(table(spark, sf_dir, "documents")).withColumn("avg_len", F.round("avg_len", 6))


@query("""
WITH o AS (SELECT [o_orderpriority, o_orderstatus, o_orderstatus] AS c, o_custkey AS w FROM orders),
     e AS (SELECT unnest(c) AS category FROM o), d AS (SELECT unnest(list_distinct(c)) AS category, w FROM o)
SELECT category, n_listed, words FROM (SELECT category, count(*) AS n_listed FROM e GROUP BY 1) JOIN (SELECT category, CAST(sum(w) AS BIGINT) AS words FROM d GROUP BY 1) USING (category) ORDER BY n_listed DESC, category LIMIT 10""")
def category_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.array("o_orderpriority", "o_orderstatus", "o_orderstatus").alias("c"), "o_custkey")
    return stats.category_totals(rows, "c", F.col("o_custkey"))


@query("SELECT year, n_rows FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_rows FROM orders GROUP BY 1) ORDER BY year DESC LIMIT 5")
def year_histogram(spark, sf_dir):
    year = F.split_part(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), F.lit(1))
    return table(spark, sf_dir, "orders").groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("year")).limit(5)


@query("""
WITH c AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_rows FROM orders GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY n_rows DESC, year DESC) AS INTEGER) AS nth FROM c) WHERE nth <= 3""")
def top_year_per_category(spark, sf_dir):
    return stats.top_k_per_group(table(spark, sf_dir, "orders"), "o_orderpriority", F.date_format("o_orderdate", "yyyy"), "year", 3)


@query(r"""
SELECT count(*) AS articles, CAST(sum(w) AS BIGINT) AS words, count(*) FILTER (v > 0) AS with_videos, CAST(sum(v) AS BIGINT) AS videos, round(sum(w) / count(*), 6) AS avg_words, round(sum(w) * 7 / (1024.0 * 1024.0), 6) AS est_mb, round(sum(v) / count(*), 6) AS videos_per_article
FROM (SELECT len(regexp_extract_all(text, '[^\s]+')) AS w, doc_id % 3 AS v FROM documents)""")
def article_totals(spark, sf_dir):
    out = stats.article_totals(table(spark, sf_dir, "documents"), tx.token_count(F.col("text")), F.col("doc_id") % 3)
    return out.select("articles", "words", "with_videos", "videos", *[F.round(c, 6).alias(c) for c in ("avg_words", "est_mb", "videos_per_article")])


@query("SELECT lang, n_rows, round(100.0 * n_rows / (SELECT count(*) FROM documents), 6) AS pct FROM (SELECT lang, count(*) AS n_rows FROM documents GROUP BY lang) ORDER BY n_rows DESC, lang LIMIT 20")
def lang_top(spark, sf_dir):
    return stats.language_top(table(spark, sf_dir, "documents"), "lang").withColumn("pct", F.round("pct", 6))


@query("SELECT source, count(*) AS examples, count(*) AS evaluated FROM documents GROUP BY 1")
def source_language_join_whole(spark, sf_dir):
    """Each source with its documents, all of them evaluated."""
    rows = corpus(spark, sf_dir)
    lid = stats.language_share(rows.withColumn("conf", F.lit(1.0)), "lang", "conf", "en", "source").select("source", "evaluated")
    return stats.sources_with_language(stats.stats_by_source(rows), lid).select("source", "examples", "evaluated")


@query("SELECT count(*) FILTER (coalesce(value, 0) > 10) AS n_available, CAST(coalesce(sum(CAST(floor(value) AS BIGINT)) FILTER (coalesce(value, 0) > 10), 0) AS BIGINT) AS seconds, count(*) FILTER (NOT coalesce(value, 0) > 10) AS n_missing FROM events")
def video_durations(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.floor("value").alias("duration_seconds"), (F.col("value") > 10).alias("available"))
    return stats.total_duration(rows)


@query("SELECT CASE WHEN page_id % 3 = 0 THEN 'failed' WHEN page_id % 3 = 1 THEN 'success' ELSE 'unknown' END AS status, count(*) AS n_rows FROM pages GROUP BY 1")
def crawl_outcomes(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 3 == 0, "failed").when(F.col("page_id") % 3 == 1, "success").alias("status"))
    return stats.outcome_counts(rows)


@query(r"SELECT coalesce(nullif(lang, 'de'), 'none') AS domain, count(*) AS n_rows, CAST(sum(len(regexp_extract_all(text, '[^\s]+'))) AS BIGINT) AS words FROM documents GROUP BY 1")
def domain_words(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.nullif("lang", F.lit("de")).alias("domain"), "text")
    return stats.group_words(rows, "domain", tx.token_count(F.col("text")), "none")


@query("SELECT event_type, date_trunc('hour', ts) AS start, count(*) AS n_rows FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def windowed_counts(spark, sf_dir):
    from loomtext.streaming.ingest import windowed_counts as counts

    out = counts(table(spark, sf_dir, "events").select("ts", "event_type"), "ts", "event_type")
    return out.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n_rows")


@query("SELECT vec_id, CASE WHEN len(embedding) = 0 THEN 0.5::DOUBLE ELSE round(greatest(0, least(1, exp(list_sum([CAST(x AS DOUBLE) for x in embedding]) / len(embedding)))), 9) END AS confidence FROM embeddings")
def chunk_confidence(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(tx.confidence(F.col("embedding").cast("array<double>")), 9).alias("confidence"))


# --- comparison, gates and splits --------------------------------------------------------------------------------------

_KEYS = f"a AS (SELECT DISTINCT {KEY} AS key FROM benchmark WHERE {KEY} <> ''), b AS (SELECT DISTINCT {KEY} AS key FROM documents WHERE {KEY} <> '')"


@query(f"WITH {_KEYS} SELECT count(*) FILTER (b.key IS NULL) AS missing, count(*) FILTER (a.key IS NULL) AS added, count(*) FILTER (a.key IS NOT NULL AND b.key IS NOT NULL) AS common FROM a FULL JOIN b ON a.key = b.key")
def baseline_loss(spark, sf_dir):
    return setops.baseline_loss(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query(f"WITH {_KEYS} SELECT key FROM a ANTI JOIN b USING (key)")
def lost_keys(spark, sf_dir):
    return setops.lost_keys(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query("SELECT count(*) FILTER (l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL) AS common, count(*) FILTER (l.doc_id IS NULL) AS only_one, count(*) FILTER (d.doc_id IS NULL) AS only_two, count(*) AS either FROM documents d FULL JOIN labels l ON l.doc_id = d.doc_id")
def corpus_compare(spark, sf_dir):
    return setops.compare_ids(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT lang AS category, count(*) AS n_rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang")
def new_by_category(spark, sf_dir):
    return setops.new_by_category(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id", F.col("lang"))


@query(f"SELECT count(*) AS n, count(*) FILTER ({KEY} = '') AS empty, count(DISTINCT {KEY}) AS keys, CAST(sum(strlen(coalesce(text, ''))) AS BIGINT) AS bytes FROM documents")
def gate_measures(spark, sf_dir):
    return measures(table(spark, sf_dir, "documents"))


@query(f"""
WITH m AS (SELECT count(*) AS n, count(*) FILTER ({KEY} = '') AS e, count(DISTINCT {KEY}) AS k, sum(strlen(text)) AS b FROM documents),
     l AS (SELECT count(*) AS x FROM (SELECT {KEY} AS key FROM benchmark EXCEPT SELECT {KEY} FROM documents) WHERE key <> '')
SELECT unnest(['schema', 'min_examples', 'empty_texts', 'duplicates', 'raw_text_size', 'target_lang_pct', 'no_baseline_loss']) AS name,
       unnest([true, n >= 100, e <= 0, round(100.0 * (n - k) / n, 4) <= 10, round(b / 1e6, 2) >= 0.1, true, x = 0]) AS passed FROM m, l""")
def gates_report(spark, sf_dir):
    config = GateConfig(min_examples=100, max_duplicate_pct=10.0, min_text_mb=0.1, min_target_pct=50.0)
    report = run_gates(corpus(spark, sf_dir).select("text", "sources"), config, {"lid": {"target_pct": 60.0}}, table(spark, sf_dir, "benchmark"))
    return spark.createDataFrame([(r.name, r.passed) for r in report.results], "name string, passed boolean")


@query(f"""
WITH m AS (SELECT count(*) AS n, count(*) FILTER ({KEY} = '') AS e, count(DISTINCT {KEY}) AS k, sum(strlen(text)) AS b, 100.0 * count(*) FILTER (lang = 'en') / count(*) AS t FROM documents)
SELECT unnest(['schema', 'min_examples', 'empty_texts', 'duplicates', 'raw_text_size', 'target_lang_pct', 'no_baseline_loss']) AS name,
       unnest([false, n >= 1000000000000, e <= 0, round(100.0 * (n - k) / n, 4) <= 0, round(b / 1e6, 2) >= 0.1, t >= 90, false]) AS passed FROM m""")
def gates_failing(spark, sf_dir):
    """Sources that are no array, more examples than there are, the language share of the table itself, no baseline."""
    docs = table(spark, sf_dir, "documents")
    share = docs.agg((100 * F.count_if(F.col("lang") == "en") / F.count(F.lit(1))).alias("pct")).first()["pct"]
    config = GateConfig(min_examples=10**12, max_duplicate_pct=0.0, min_text_mb=0.1, min_target_pct=90.0, fail_closed=True)
    report = run_gates(docs.select("text", F.col("source").alias("sources")), config, {"lid": {"target_pct": share}})
    return spark.createDataFrame([(r.name, r.passed) for r in report.results], "name string, passed boolean")


@query("""
WITH d AS (SELECT doc_id, md5('42:' || doc_id) AS d FROM documents), r AS (SELECT doc_id, row_number() OVER (ORDER BY d, doc_id) AS n FROM d)
SELECT doc_id, CASE WHEN n <= 150 THEN 'train' ELSE 'test' END AS split FROM r""")
def train_test_split(spark, sf_dir):
    return setops.train_test(table(spark, sf_dir, "documents"), "doc_id", 150).select("doc_id", "split")


@query("""
SELECT coalesce(a.column_name, b.column_name) AS name, CASE WHEN b.column_name IS NULL THEN 'one' WHEN a.column_name IS NULL THEN 'two' ELSE 'both' END AS side, coalesce(a.column_type = b.column_type, false) AS same_type
FROM (DESCRIBE documents) a FULL JOIN (DESCRIBE labels) b ON a.column_name = b.column_name""")
def schema_compare(spark, sf_dir):
    return setops.compare_schemas(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("column", "name")
