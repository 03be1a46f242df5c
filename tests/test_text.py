"""Text expressions against small Python specifications."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loomtext.functions import text as tx
from loomtext.functions.language import heuristic

SPACES = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0", " ", " ", " ", " ", "　"]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_white_space_is_that_of_python(spark):
    texts = [f"{a}x{a}{b}y{b}" for a in SPACES for b in SPACES] + ["", " ", None]
    assert column(spark, texts[:-1], tx.ustrip) == [t.strip() for t in texts[:-1]]
    assert column(spark, texts[:-1], tx.tokens) == [t.split() for t in texts[:-1]]
    assert column(spark, texts, tx.key_squeezed) == [" ".join((t or "").lower().split()) for t in texts]
    assert column(spark, texts, tx.key_strip) == [(t or "").lower().strip() for t in texts]


def test_norm_text_and_sources(spark):
    assert column(spark, [1.5, float("nan"), None], tx.norm_text, "double") == ["1.5", "", ""]
    assert column(spark, [None, [], ["a", "a"]], tx.norm_sources, "array<string>") == [[], [], ["a", "a"]]
    assert column(spark, [None, [], ["a"]], tx.known_sources, "array<string>") == [["__unknown__"], ["__unknown__"], ["a"]]


def test_sentences_and_groups(spark):
    texts = ["It is 3.14. Yes! No", "a. . b", "…", "one\ntwo. three", "```x. y```", "   ", None, "Well… then go"]
    assert column(spark, texts, tx.sentences) == [["It is 3.14.", "Yes!", "No"], ["a.", ".", "b"], ["…"], ["one", "two.", "three"], ["```x.", "y```"], [], [], ["Well…", "then go"]]
    assert column(spark, texts, tx.sentence_groups) == [["It is 3.14. Yes!", "No"], ["a. .", "b"], ["…"], ["one two.", "three"], ["```x. y```"], [], [], ["Well… then go"]]


@pytest.mark.parametrize("size", [18])
def test_word_chunks(spark, size):
    def spec(words):
        out = [words[i : i + size] for i in range(0, len(words), size)]
        if len(out) > 1 and len(out[-1]) < 3:
            out[-2:] = [out[-2] + out[-1]]
        return [" ".join(x) for x in out]

    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(120)]
    assert column(spark, texts, lambda t: tx.word_chunks(tx.tokens(t))) == [spec(t.split()) for t in texts]


def test_spoken_sentences(spark):
    texts = ["a b. one two three! x", " ".join(["word"] * 38), "aa b c. aa bb cc"]
    assert column(spark, texts, tx.spoken_sentences) == [["one two three"], [" ".join(["word"] * 18), " ".join(["word"] * 20)], ["aa bb cc"]]


def repeated(words, longest=6):
    out, i = [], 0
    while i < len(words):
        for size in range(min(longest, (len(words) - i) // 2), 0, -1):
            pattern, copies = words[i : i + size], 1
            while words[i + copies * size : i + (copies + 1) * size] == pattern:
                copies += 1
            if copies > 1:
                out += pattern
                i += copies * size
                break
        else:
            out.append(words[i])
            i += 1
    return out


def test_repairs(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 24))) for _ in range(800)] + ["a a a a", "a a a a a", "a b a b a b", " ".join("a" * 12)]
    assert column(spark, texts, tx.collapse_repetitions) == [" ".join(repeated(t.split())) for t in texts]
    runs = [re.sub(r"(?<!\S)(\S+)(?: \1(?!\S)){2,}", r"\1", t) for t in texts]
    assert column(spark, texts, tx.collapse_runs) == runs


def test_overlap_merge(spark):
    def spec(chunks, most=5):
        out = []
        for c in chunks:
            k = next((k for k in range(min(most, len(out), len(c)), 0, -1) if out[-k:] == c[:k]), 0)
            out += c[k:]
        return out

    rng = random.Random(6)
    lists = [[[rng.choice("ab") for _ in range(rng.randint(0, 7))] for _ in range(rng.randint(0, 5))] for _ in range(300)]
    assert column(spark, lists, tx.overlap_merge, "array<array<string>>") == [spec(x) for x in lists]


def test_error_rates(spark):
    def distance(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(prev[j - 1] if x == y else 1 + min(prev[j], row[j - 1], prev[j - 1]))
            prev = row
        return prev[-1]

    rng = random.Random(7)
    pairs = [(" ".join(rng.choice("abc") for _ in range(rng.randint(0, 8))), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 8)))) for _ in range(300)] + [("été", "ete")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, a string, b string")
    got = df.select("i", tx.wer(F.col("a"), F.col("b")).alias("w"), tx.cer(F.col("a"), F.col("b")).alias("c")).orderBy("i").collect()
    for (a, b), r in zip(pairs, got):
        x, y = a.replace(" ", ""), b.replace(" ", "")
        assert r.w == (distance(a.split(), b.split()) / len(a.split()) if a.split() else 0)
        assert r.c == pytest.approx(distance(x, y) / len(x) if x else 0)


def test_small_scalars(spark):
    assert column(spark, [0, 59, 3600, 360000], tx.format_duration, "long") == ["00:00:00", "00:00:59", "01:00:00", "100:00:00"]
    assert column(spark, [999, 1000, 9_999_999, 10_000_000], tx.size_category, "long") == ["n<1K", "1K<n<10K", "1M<n<10M", "10M<n<100M"]
    assert column(spark, [0.2, 0.25, 0.35], tx.wer_band, "double") == ["good", "fair", "poor"]
    assert column(spark, [[], [0.0, 0.0], [5.0]], tx.confidence, "array<double>") == [0.5, 1.0, 1.0]
    assert column(spark, ["x/y"], tx.safe_name) == ["x__y"]
    urls = ["https://youtube.com/embed/A1?x=1", "https://www.youtube.com/watch?v=B2&t=3", "https://youtu.be/C3", "https://e.org/v/D4", None]
    assert column(spark, urls, tx.video_id) == ["A1", "B2", "C3", None, None]


def test_html(spark):
    page = '<iframe width="1" src="https://www.youtube.com/embed/A1?x"></iframe><iframe src="https://e.org/q"></iframe><p>foo <b>bar</b> baz</p><p>1234567890</p>'
    assert [v.video_id for v in column(spark, [page], tx.iframe_videos)[0]] == ["A1"]
    assert column(spark, [page, None], tx.paragraphs) == [["foo bar baz"], []]
    assert column(spark, [page], lambda h: tx.paragraphs(h, longer_than=5, glue=True)) == [["foobarbaz", "1234567890"]]
    assert column(spark, ["<b>" + "x" * 27, "<b>" + "x" * 26, ""], lambda t: tx.html_share(t) > 0.1) == [False, True, False]


def test_heuristic(spark):
    rows = column(spark, ["Ñoom ëf é", "nga x x x x x x x x x", "plain words", "", "NGA mooy"], heuristic)
    assert [(r.char_count, r.word_count, r.is_target) for r in rows] == [(2, 1, True), (0, 1, True), (0, 0, False), (0, 0, False), (0, 2, True)]
    assert rows[0].confidence == pytest.approx(0.4 + 0.6 / 3)
