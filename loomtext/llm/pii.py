"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Regular expressions give the base spans, which are also the seed entities. With these masked, every run of numbers with
separators and single spaces, and every other token with a digit or an at sign, is an instance. Instances and seeds have
lexical patterns: the word before, the two words before, the word after, and for numbers with separators their shape,
whole or without its first part. On the graph of patterns and instances, a pattern scores by the share of its distinct
instances that are known to be of one kind, and an unseen instance by the patterns that point to it; once a round finds
none, the confident instances are further spans. A kind of its own are secrets: values assigned to a name such as token
seed it, and they are never base spans.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.staging import staged

#: Kinds in reporting order, with patterns that find the leftmost non-overlapping matches in linear time: possessive
#: repeats, and no start inside a run of characters whose first start has failed (\G: right after a match).
KINDS = ("email", "ip", "card", "phone")
#: All kinds: those of base spans, then those that only the method gives.
ALL_KINDS = (*KINDS, "secret")
SECRET = ALL_KINDS.index("secret")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap sign that a text may hold a match.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: A run of numbers, parted by single spaces and with marks around it, or else a token with a digit or an at sign.
MARKS, NUMBER = r"[^\p{L}\p{N}\s@]*+", r"[0-9][0-9().+/-]*+"
TOKEN = rf"(?<!\S)(?:{MARKS}{NUMBER}(?: [(+]*+{NUMBER}(?={MARKS}(?!\S)))*+{MARKS}(?!\S)|[^\s0-9@]*+[0-9@]\S*+)"
#: Up to two words next to a match.
WORDS = r"^\s++(\S++)(?:\s++(\S++))?"
#: A word that can be a pattern: nothing of an identifier, nor of what a mask hides.
MASK = "\ue000"
LEXICAL = rf"^[^0-9@{MASK}]++$"
#: Marks before an instance, but for a parenthesis around the first digits of more; marks after it.
LEADING = r"^(?:(?!\([0-9]++\)[ .-]?[0-9])[^\p{L}\p{N}+])++"
TRAILING = r"[^\p{L}\p{N}]++$"
#: Numbers with separators have a shape, their digits as 9, from this many digits on.
SHAPED, SHAPE_DIGITS = r"^[0-9 ().+/-]*[0-9][ ().+/-]++[0-9][0-9 ().+/-]*$", 7
#: What assigns a secret, as the two words before it, and what is one.
ASSIGNS = r"(?:^|[^a-z])(?:token|secret|passw(?:or)?d|pwd|credential|api[_-]?key|access[_-]?key|private[_-]?key)s?[\"']? ?:?=+$"
SECRET_VALUE = r"^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])\S{16,}$"

#: Least support and share of a pattern; least confidence and length of a new instance.
MIN_SUPPORT = 5
MIN_SHARE = 0.8
MIN_CONFIDENCE = 0.8
MIN_LENGTH = 6
#: Rounds over the graph after which the known instances are written as one table, and rows of one of its files.
FOLD = 8
GRAPH_FILE_ROWS = 500_000
_BLOCK = 256


def _running(steps: Column) -> Column:
    """Sums of the elements before each element, by blocks, so that work stays far below the square of the length."""
    none = F.array().cast("array<int>")

    def fold(part, start):
        grow = lambda a, x: F.struct(F.concat(a["out"], F.array(a["at"])).alias("out"), (a["at"] + x).alias("at"))
        return F.aggregate(part, F.struct(none.alias("out"), start.alias("at")), grow, lambda a: a["out"])

    blocks = F.transform(F.sequence(F.lit(0), F.greatest((F.size(steps) - 1) / _BLOCK, F.lit(0)).cast("int")), lambda b: F.slice(steps, b * _BLOCK + 1, _BLOCK))
    sums = F.transform(blocks, lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("part"), fold(sums, F.lit(0)).alias("start")), lambda z: fold(z["part"], z["start"])))


def _pick(text: str, pattern: str, sign: str | None) -> Column:
    """The matches of ``pattern`` as they stand; none without its sign."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if sign is None:
        return found
    may = F.contains(F.col(text), F.lit(sign)) if sign == "@" else F.col(text).rlike(sign)
    return F.when(may, found).otherwise(F.array().cast("array<string>"))


def _located(df: DataFrame, text: str, pattern: str, out: str, sign: str | None = None) -> DataFrame:
    """Adds ``out``: array<struct<start, end, found, b1, b2, a1>> of the matches; positions count code points.

    b1 and b2 are the nearest and the next word before a match, a1 that after it, in lower case; empty where another match
    of the pattern stands there.
    """
    df = df.withColumn("_found", _pick(text, pattern, sign))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split(F.col(text), pattern, -1)))
    df = df.withColumn("_steps", F.transform("_found", lambda x, i: F.length(x) + F.length(F.get("_gaps", i))))
    df = df.withColumn("_before", F.when(F.size("_found") > 0, _running(F.col("_steps"))))
    df = df.withColumn("_ahead", F.transform("_gaps", lambda g: F.reverse(g)))
    word = lambda gap, n: F.lower(F.regexp_extract(gap, WORDS, n))
    spans = F.transform(
        "_found",
        lambda x, i: F.struct(
            (F.get("_before", i) + F.length(F.get("_gaps", i))).alias("start"), (F.get("_before", i) + F.get("_steps", i)).alias("end"), x.alias("found"),
            F.reverse(word(F.get("_ahead", i), 1)).alias("b1"), F.reverse(word(F.get("_ahead", i), 2)).alias("b2"), word(F.get("_gaps", i + 1), 1).alias("a1"),
        ),
    )
    return df.withColumn(out, spans).drop("_found", "_gaps", "_steps", "_before", "_ahead")


def _masked(df: DataFrame, text: str, kind: str) -> DataFrame:
    """``df`` with the valid matches of a kind in ``text`` overwritten by as many mask characters."""
    df = df.withColumn("_found", _pick(text, PATTERNS[kind], SIGNS[kind]))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split(F.col(text), PATTERNS[kind], -1)))
    hidden = lambda x: F.when(_valid(kind, x), F.repeat(F.lit(MASK), F.length(x))).otherwise(x)
    df = df.withColumn("_found", F.transform("_found", hidden))
    whole = F.array_join(F.zip_with("_gaps", "_found", lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
    return df.withColumn(text, F.coalesce(whole, F.col(text))).drop("_found", "_gaps")


def _luhn(digits: Column) -> Column:
    """True if the digits pass the Luhn check."""
    back = F.reverse(digits)

    def add(a, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return a + F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(found, "[ -]", "")
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(found, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _valid_ones(kind: str) -> Column:
    return F.filter(kind, lambda x: _valid(kind, x["found"]))


def _numbered(number: int) -> Column:
    """The spans of a kind, with its number."""
    return F.transform(KINDS[number], lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))


def _patterns(value: Column, b1: Column, b2: Column, a1: Column) -> Column:
    """The lexical patterns of an instance."""
    fit = lambda w: w.rlike(LEXICAL)
    shaped = value.rlike(SHAPED) & (F.length(F.regexp_replace(value, "[^0-9]", "")) >= SHAPE_DIGITS)
    shape = F.regexp_replace(value, "[0-9]", "9")
    rest = F.regexp_replace(shape, r"^\S+ ", "")
    every = F.array(
        F.when(fit(b1), F.concat(F.lit("before "), b1)), F.when(fit(b1) & fit(b2), F.concat(F.lit("before "), b2, F.lit(" "), b1)),
        F.when(fit(a1), F.concat(F.lit("after "), a1)), F.when(shaped, F.concat(F.lit("shape "), shape)),
        F.when(shaped & (rest != shape) & (F.length(F.regexp_replace(rest, "[^9]", "")) >= SHAPE_DIGITS) & rest.rlike("9[^9]+9"), F.concat(F.lit("shape "), rest)),
    )
    return F.filter(every, lambda p: p.isNotNull())


def count_of(spans: str, number: int) -> Column:
    """How many of ``spans`` are of the kind with this number."""
    return F.size(F.filter(spans, lambda x: x["kind"] == number)).cast("long")


def base_spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, base, items): the base spans by start and kind, and seeds and instances with their patterns.

    items: array<struct<start, end, value, base, kind, patterns>>; kind is null where it is not known.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), given.alias("text"), given.alias("masked"))
    for kind in KINDS:
        df = _masked(_located(df, "text", PATTERNS[kind], kind, SIGNS[kind]), "masked", kind)
        df = df.withColumn(kind, _valid_ones(kind))
    df = _located(df, "masked", TOKEN, "tokens", "[0-9@]")
    item = lambda x, lo, value, base, kind: F.struct(lo.alias("start"), (lo + F.length(value)).alias("end"), value.alias("value"), F.lit(base).alias("base"), kind.alias("kind"), _patterns(value, x["b1"], x["b2"], x["a1"]).alias("patterns"))

    def free(x):
        """A token without the marks around it."""
        left = F.regexp_replace(x["found"], LEADING, "")
        value = F.regexp_replace(left, TRAILING, "")
        assigned = F.concat_ws(" ", x["b2"], x["b1"]).rlike(ASSIGNS) & value.rlike(SECRET_VALUE)
        return item(x, x["end"] - F.length(left), value, False, F.when(assigned, SECRET))

    def seeds(number):
        return F.transform(KINDS[number], lambda x: item(x, x["start"], x["found"], True, F.lit(number)))

    base = [_numbered(number) for number in range(len(KINDS))]
    tokens = F.filter(F.transform("tokens", free), lambda x: x["value"].rlike("[0-9@]"))
    return df.select("row", "doc_id", F.array_sort(F.concat(*base)).alias("base"), F.concat(*[seeds(number) for number in range(len(KINDS))], tokens).alias("items"))


def _known(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """One round: patterns scored by what is known of their instances, then unseen instances by their patterns."""
    scored = edges.join(instances.hint("merge"), "value", "left")
    sums = [F.sum(F.when(F.col("kind") == k, F.col("confidence")).otherwise(0.0)).alias(f"s{k}") for k in range(len(ALL_KINDS))]
    patterns = scored.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums)
    best = F.greatest(*[F.struct(F.col(f"s{k}").alias("s"), F.lit(-k).alias("k")) for k in range(len(ALL_KINDS))])
    patterns = patterns.withColumn("best", best).select("pattern", (-F.col("best.k")).alias("points"), (F.col("best.s") / F.col("n")).alias("share"), F.col("best.s").alias("support"))
    strong = patterns.where((F.col("support") >= MIN_SUPPORT) & (F.col("share") >= MIN_SHARE))
    unseen = scored.where(F.col("kind").isNull() & (F.length("value") >= MIN_LENGTH)).select("value", "pattern")
    votes = unseen.join(strong.hint("merge"), "pattern").groupBy("value", "points").agg((1 - F.exp(F.sum(F.log(1.0001 - F.col("share"))))).alias("confidence"))
    found = votes.groupBy("value").agg(F.max(F.struct("confidence", (-F.col("points")).alias("k"))).alias("top"))
    return found.select("value", (-F.col("top.k")).alias("kind"), F.col("top.confidence").alias("confidence")).where(F.col("confidence") >= MIN_CONFIDENCE)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, base, spans): base spans, and all spans, as array<struct<start, kind, end>> by start and kind.

    kind numbers ALL_KINDS. Null and empty texts have no spans. Copies of a document count once in the scores, as the graph
    holds distinct pattern-instance pairs; every occurrence of an instance found is reported. Rows that repeat a doc_id
    stay apart. An empty table gives an empty result, and other columns are ignored.
    """
    docs = staged(base_spans(docs, doc_id, text), "spans")
    items = docs.where(F.size("items") > 0).select("row", F.explode("items").alias("x")).select("row", "x.*")
    edges = staged(items.select("value", F.explode("patterns").alias("pattern")).distinct(), "edges")
    #: no table of instances has more rows than the graph has edges, but for values without any pattern
    files = 1 + edges.count() // GRAPH_FILE_ROWS
    seeds = items.where("kind is not null").groupBy("value").agg(F.min("kind").alias("kind")).withColumn("confidence", F.lit(1.0))
    known = staged(seeds.coalesce(files), "instances")
    for n in count(1):
        new = staged(_known(known, edges).coalesce(files), "instances")
        if new.isEmpty():
            break
        known = known.unionByName(new)
        known = staged(known.coalesce(files), "instances") if n % FOLD == 0 else known
    free = items.where(~F.col("base") & (F.length("value") >= MIN_LENGTH)).select("row", "start", "end", "value")
    added = free.join(known.hint("merge"), "value").groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return docs.select("row", "doc_id", "base").join(added.hint("merge"), "row", "left").select("row", "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
