"""Column expressions for text: white space, tokens, keys, segmentation, repair and scores.

All of them stay inside the JVM. A null text is treated as each function says, and array results are never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space together with the separators U+001C to U+001F: inside a character class, and as characters.
SPACE = r"\s\x1c-\x1f"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NONE = "array<string>"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once even where body uses it inside other lambdas."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def ustrip(text: Column) -> Column:
    """``text`` without Unicode white space at either end; null stays null."""
    return F.btrim(text, F.lit(SPACES))


def squeeze(text: Column) -> Column:
    """ustrip() with every inner run of white space as one space."""
    return F.regexp_replace(ustrip(text), rf"(?U)[{SPACE}]+", " ")


def tokens(text: Column) -> Column:
    """White-space separated tokens; null gives none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?U)[^{SPACE}]+"), F.lit(0))


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def key_lower(text: Column) -> Column:
    """K1: lower case of the stripped text."""
    return F.lower(ustrip(text))


def key_strip(text: Column) -> Column:
    """K2: stripped lower case, the key of global dedup; null counts as empty."""
    return ustrip(F.lower(F.coalesce(text, F.lit(""))))


def key_squeezed(text: Column) -> Column:
    """K3: lower case with single spaces, the key of fragment dedup."""
    return squeeze(F.lower(F.coalesce(text, F.lit(""))))


def digest(key: Column) -> Column:
    """128 bits that stand for a key in shuffles, so that whole texts are not keys; null stays null."""
    return F.md5(key.cast("binary"))


def norm_text(value: Column) -> Column:
    """Any scalar as stripped text; null and NaN give the empty text."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return ustrip(F.when(text == "NaN", F.lit("")).otherwise(text))


def norm_sources(sources: Column) -> Column:
    """Null sources as an empty array."""
    return F.coalesce(sources, F.array().cast(NONE))


def known_sources(sources: Column, unknown: str = "__unknown__") -> Column:
    """Null or empty sources as one placeholder."""
    return F.when(F.size(norm_sources(sources)) == 0, F.array(F.lit(unknown))).otherwise(sources)


def safe_name(name: Column) -> Column:
    """A repository name as a file name."""
    return F.replace(name, F.lit("/"), F.lit("__"))


def _filled(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda x: ustrip(x)), lambda x: x != "")


def sentences(text: Column) -> Column:
    """Lines, cut after . ! ? or an ellipsis that white space follows; blank pieces dropped, 3.14 intact."""
    return _filled(F.split(F.coalesce(text, F.lit("")), rf"(?U)\n|(?<=[.!?…])[{SPACE}]+"))


def has_code(text: Column) -> Column:
    """True for texts with a fenced code block."""
    return F.contains(F.coalesce(text, F.lit("")), F.lit("```"))


def sentence_groups(text: Column, size: int = 2) -> Column:
    """Groups of ``size`` sentences joined by a space; code stays whole, blank text gives nothing."""

    def group(parts):
        starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(size))
        return F.filter(F.transform(starts, lambda i: F.array_join(F.slice(parts, i + 1, size), " ")), lambda x: x != "")

    grouped = let(sentences(text), group)
    whole = ustrip(F.coalesce(text, F.lit("")))
    return F.when(has_code(text), F.filter(F.array(whole), lambda x: x != "")).otherwise(grouped)


def article_sentences(text: Column, min_words: int = 3) -> Column:
    """Sentences of an article on one line, cut after . ! or ?, with ``min_words`` words at least."""
    parts = _filled(F.split(squeeze(F.coalesce(text, F.lit(""))), r"(?<=[.!?]) "))
    return F.filter(parts, lambda x: F.size(F.split(x, " ")) >= min_words)


def word_chunks(words: Column, size: int = 18, least: int = 3) -> Column:
    """Chunks of ``size`` words joined by spaces; a last chunk shorter than ``least`` joins the one before."""

    def cut(words):
        n = F.size(words)
        count = F.greatest(F.lit(1), F.floor(n / size).cast("int") + F.when(n % size >= least, 1).otherwise(0))
        chunk = lambda j: F.array_join(F.slice(words, j * size + 1, F.when(j < count - 1, size).otherwise(F.greatest(n - j * size, F.lit(1)))), " ")
        return F.when(n == 0, F.array().cast(NONE)).otherwise(F.transform(F.sequence(F.lit(0), count - 1), lambda j: chunk(j.cast("int"))))

    return let(words, cut)


def is_valid_sentence(text: Column, words: int = 3, chars: int = 2) -> Column:
    """True with ``words`` words at least that have ``chars`` letters, digits or underscores each."""
    bare = F.transform(tokens(text), lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}_]", ""))
    return F.size(F.filter(bare, lambda w: F.length(w) >= chars)) >= words


def spoken_sentences(text: Column, size: int = 18, least: int = 3) -> Column:
    """Sentences of a transcript: longer ones in word chunks, shorter than ``least`` words dropped, then the valid ones."""
    parts = _filled(F.split(F.coalesce(text, F.lit("")), "[.!?]"))

    def cut(words):
        n = F.size(words)
        return F.when(n > size, word_chunks(words, size, least)).when(n >= least, F.array(F.array_join(words, " "))).otherwise(F.array().cast(NONE))

    return F.filter(F.flatten(F.transform(F.transform(parts, lambda x: tokens(x)), cut)), lambda x: is_valid_sentence(x))


def collapse_repetitions(text: Column, longest: int = 6) -> Column:
    """Single-spaced ``text`` with consecutive copies of a pattern of up to ``longest`` words reduced to one, in one pass."""
    spaced = F.concat(squeeze(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.trim(F.regexp_replace(spaced, rf"(?<![^ ])((?:[^ ]+ ){{1,{longest}}})\1+", "$1"))


def collapse_runs(text: Column, least: int = 3) -> Column:
    """Runs of ``least`` or more equal words reduced to one; shorter runs stay."""
    spaced = F.concat(squeeze(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.trim(F.regexp_replace(spaced, rf"(?<![^ ])([^ ]+ )\1{{{least - 1},}}", "$1"))


def cut_sentences(text: Column) -> Column:
    r"""Pieces between . ! ? and the two characters \n, stripped, blanks dropped."""
    return _filled(F.split(F.coalesce(text, F.lit("")), r"[.!?]|\\n"))


def overlap_merge(chunks: Column, most: int = 5) -> Column:
    """array<array<string>> of words folded into one: up to ``most`` words that repeat the end so far are left out."""

    def join(acc, x):
        lengths = F.reverse(F.sequence(F.lit(0), F.least(F.lit(most), F.size(acc), F.size(x))))
        same = F.filter(lengths, lambda k: (k == 0) | (F.slice(acc, F.size(acc) - k + 1, k) == F.slice(x, 1, k)))
        skip = F.coalesce(F.get(same, F.lit(0)), F.lit(0))
        return F.concat(acc, F.slice(x, skip + 1, F.size(x)))

    return F.aggregate(chunks, F.array().cast(NONE), join)


#: Words of a pair that get a character each: the code points from 10000 to 10FFFF (hexadecimal).
WORD_CHARACTERS = 0x110000 - 0x10000


def word_distance(ref: Column, hyp: Column) -> Column:
    """Edit distance of two word arrays: each distinct word becomes a character, then it is that of two strings."""

    def distance(both):
        def coded(words):
            points = F.transform(words, lambda w: F.lpad(F.hex(F.array_position(both["known"], w) + 0xFFFF), 8, "0"))
            return F.decode(F.unhex(F.array_join(points, "")), "UTF-32")

        by_rows = _distance_by_rows(both["ref"], both["hyp"])
        return F.when(F.size(both["known"]) <= WORD_CHARACTERS, F.levenshtein(coded(both["ref"]), coded(both["hyp"]))).otherwise(by_rows)

    return let(F.struct(ref.alias("ref"), hyp.alias("hyp"), F.array_union(ref, hyp).alias("known")), distance)


def _distance_by_rows(ref: Column, hyp: Column) -> Column:
    """Edit distance of two arrays, a row of the table at a time, whatever the number of distinct words.

    The cell to the left makes a row a running minimum, which is found in steps of doubled reach, so a row of m cells
    costs m times the logarithm of m.
    """
    m = F.size(hyp)
    reaches = F.transform(F.sequence(F.lit(0), F.floor(F.log2(m)).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))

    def row(prev, r):
        #: without the cell to the left; less the place, so that a step to the right costs nothing
        above = F.transform(prev, lambda p, j: F.least(p + 1, F.get(prev, j - 1) + F.when(F.get(hyp, j - 1) == r, 0).otherwise(1)) - j)
        least = F.aggregate(reaches, above, lambda acc, far: F.transform(acc, lambda x, j: F.least(x, F.get(acc, j - far))))
        return F.transform(least, lambda x, j: x + j)

    return F.when(m == 0, F.size(ref)).otherwise(F.element_at(F.aggregate(ref, F.sequence(F.lit(0), m), row), -1))


def wer(ref: Column, hyp: Column) -> Column:
    """Word error rate; 0 for an empty reference."""
    words = tokens(ref)
    return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(word_distance(words, tokens(hyp)) / F.size(words))


def cer(ref: Column, hyp: Column) -> Column:
    """Character error rate without spaces; 0 for an empty reference."""
    bare = [F.replace(F.coalesce(x, F.lit("")), F.lit(" "), F.lit("")) for x in (ref, hyp)]
    return F.when(F.length(bare[0]) == 0, F.lit(0.0)).otherwise(F.levenshtein(*bare) / F.length(bare[0]))


def wer_band(rate: Column) -> Column:
    return F.when(rate < 0.25, "good").when(rate < 0.35, "fair").otherwise("poor")


def confidence(log_probs: Column) -> Column:
    """exp of the mean of ``log_probs`` within 0 and 1; 0.5 where there are none."""
    mean = F.aggregate(log_probs, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(log_probs), F.lit(0))
    return F.when(mean.isNull(), F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(mean))))


def format_duration(seconds: Column) -> Column:
    """HH:MM:SS, hours unbounded."""
    s = F.floor(seconds).cast("long")
    part = lambda x: F.when(x < 10, F.concat(F.lit("0"), x.cast("string"))).otherwise(x.cast("string"))
    return F.concat_ws(":", part(F.floor(s / 3600)), part(F.floor(s % 3600 / 60)), part(s % 60))


def transcription_minutes(seconds: Column) -> Column:
    """struct<gpu, cpu>: estimated minutes, half the duration and five times that."""
    gpu = seconds / 2 / 60
    return F.struct(gpu.alias("gpu"), (gpu * 5).alias("cpu"))


def transcription_minutes_of_size(megabytes: Column, known_mb: float = 289.0, known_minutes: float = 85.0) -> Column:
    """Minutes of audio in a file of this size, in proportion to a known one."""
    return megabytes * known_minutes / known_mb


def whole_article(text: Column) -> Column:
    """The text of an article as one item: stripped, blank ones as null."""
    return F.nullif(norm_text(text), F.lit(""))


def preview(text: Column, chars: int = 500) -> Column:
    """The first characters of a text, for display only."""
    return F.substring(F.coalesce(text, F.lit("")), 1, chars)


def size_category(n: Column) -> Column:
    """The size bucket of a data card."""
    out = F.when(n < 1_000, "n<1K")
    for limit, name in ((10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M")):
        out = out.when(n < limit, name)
    return out.otherwise("10M<n<100M")


def html_share(text: Column) -> Column:
    """Share of characters inside tags; 0 for no text."""
    inside = F.aggregate(F.regexp_extract_all(text, F.lit("<[^>]+>"), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    return F.coalesce(inside / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def video_id(url: Column) -> Column:
    """The id of a video address: /embed/ID, watch?v=ID or youtu.be/ID, in this order; else null."""
    embed = F.regexp_extract(url, r"/embed/([^?]*)", 1)
    watch = F.regexp_extract(url, r"watch\?(?:[^#]*&)?v=([^&#]*)", 1)
    short = F.regexp_extract(url, r"youtu\.be/([^?]*)", 1)
    return F.when(F.contains(url, F.lit("/embed/")), embed).when(F.contains(url, F.lit("watch?v=")), watch).when(F.contains(url, F.lit("youtu.be/")), short)


def watch_url(video: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video)


def iframe_videos(html: Column) -> Column:
    """array<struct<video_id, embed_url, watch_url>> of the iframes that show a video."""
    sources = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""<iframe[^>]*?\ssrc=["']([^"']*)["']"""), F.lit(1))
    shown = F.filter(sources, lambda u: (F.contains(u, F.lit("youtube.com")) | F.contains(u, F.lit("youtu.be"))) & video_id(u).isNotNull())
    return F.transform(shown, lambda u: F.struct(video_id(u).alias("video_id"), u.alias("embed_url"), watch_url(video_id(u)).alias("watch_url")))


def paragraphs(html: Column, longer_than: int = 10, glue: bool = False) -> Column:
    """Texts of the <p> elements with more than ``longer_than`` characters; glue joins text nodes without a space."""
    inner = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
    strip = lambda p: F.array_join(_filled(F.split(p, "<[^>]*>")), "" if glue else " ")
    return F.filter(F.transform(inner, strip), lambda p: F.length(p) > longer_than)
