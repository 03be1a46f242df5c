"""Tokens, pieces, sharding, neighbours, personal data, quality and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.llm import neighbours, pii, quality, sharding, tokenfiles, unigram, wavelet
from loomtext.llm.bytewise import buffer_of

tokenizers = pytest.importorskip("public_tokenizers")


def test_wavelet_matrix():
    rng = random.Random(2)
    for n in (0, 1, 511, 512, 513, 2000):
        tokens = np.array([rng.randint(0, 70) for _ in range(n)], np.uint32)
        matrix = wavelet.WaveletMatrix(wavelet.pack(tokens, np.array([5]), np.array([n]), 7))
        assert len(matrix) == n and matrix.tokens().tolist() == tokens.tolist()
        for i in rng.sample(range(n), min(n, 40)):
            t = int(tokens[i])
            assert matrix.access(i) == t and matrix.rank(t, i) == (tokens[:i] == t).sum() and matrix.select(t, matrix.rank(t, i)) == i
        with pytest.raises(IndexError):
            matrix.select(3, n + 1)
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix(b"x" * 64)


def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))


def test_pieces_are_those_of_the_library():
    rng = random.Random(3)
    alphabet = [" ", "  ", "\n", "\t", "\xa0", "　", "a", "B", "é", "梦", "1", "!", "'s", "'", "<|endoftext|>", "\x1c", "\x85", "😀", ".", " the", " The\n"]
    encoder, library = tokenfiles.PieceEncoder(tokenizers.path("byte_bpe_50k.json")), reference()
    for k in range(800):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(4)]
        texts = texts if k % 3 == 0 else [t.replace("<|endoftext|>", "x") for t in texts]
        ids, counts = encoder.encode(*buffer_of(pa.array(texts)))
        stops = np.cumsum(counts)
        for t, a, b in zip(texts, stops - counts, stops):
            assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids


def test_token_files(spark, docs, rows, empty):
    path = tokenfiles.write_token_files(docs, tokenizers.path("byte_bpe_50k.json"), 2)
    got = sorted((tuple(r) for r in tokenfiles.read_token_files(spark, path).collect()), key=lambda r: r[1])
    library, start = reference(), 0
    expected = {}
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        expected.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for i, at, n, crc in got:
        assert at == start and (n, crc) in expected[i]
        expected[i].remove((n, crc))
        start += n
    path = tokenfiles.write_token_files(empty, tokenizers.path("byte_bpe_50k.json"), 2)
    assert tokenfiles.read_token_files(spark, path).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return unigram.Vocabulary(tokenizers.path("piece_bpe_32k.model"))


def viterbi(v, text):
    """The best segmentation, position by position."""
    if not text:
        return []
    pieces = {v.bytes_of[i].decode(): (v.scores[i], int(i)) for i in v.normal}
    marked = "▁" + text.replace(" ", "▁")
    best, came = [0.0] + [-1e300] * len(marked), [None] * (len(marked) + 1)
    for i in range(len(marked)):
        steps = [(j, *pieces[marked[i:j]]) for j in range(i + 1, min(len(marked), i + 50) + 1) if marked[i:j] in pieces]
        if not any(j == i + 1 for j, *_ in steps):
            steps.append((i + 1, v.lowest, -1))
        for j, s, k in steps:
            if best[i] + s > best[j]:
                best[j], came[j] = best[i] + s, (i, k)
    out, j = [], len(marked)
    while j:
        i, k = came[j]
        out.append([k] if k >= 0 else [int(v.byte_ids[b]) for b in marked[i:j].encode()])
        j = i
    return [x for part in out[::-1] for x in part]


def test_double_array():
    keys = [b"a", b"ab", b"abc", b"b\xff", b"\x00", b"zz"]
    trie = unigram.DoubleArray(keys)
    raw = np.frombuffer(b"abcb\xff\x00z", np.uint8)
    which, to, value = trie.matches(raw, np.arange(len(raw)), np.full(len(raw), len(raw)))
    found = sorted((int(a), int(b), keys[v]) for a, b, v in zip(which, to, value))
    assert found == sorted((i, i + len(k), k) for k in keys for i in range(len(raw)) if raw.tobytes()[i : i + len(k)] == k)


def test_unigram(vocabulary):
    rng = random.Random(5)
    alphabet = [" ", "  ", "\n", "\xa0", "▁", "a", "B", "é", "梦", "the", "ing", "", "😀", ".", "er"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16))) for _ in range(250)] + ["x" * 700, " " * 600 + "a", "ab" * 400 + " c"]
    coder = unigram.Unigram(vocabulary)
    ids, counts = coder.encode(*buffer_of(pa.array(texts)))
    raw, ends = coder.decode(ids, counts)
    stops = np.cumsum(counts)
    for k, (t, a, b) in enumerate(zip(texts, stops - counts, stops)):
        assert ids[a:b].tolist() == viterbi(vocabulary, t)
        assert raw[ends[k] : ends[k + 1]].tobytes().decode() == t.replace("▁", " ")


def test_encode_texts(docs, rows, empty):
    got = unigram.encode_texts(docs, tokenizers.path("piece_bpe_32k.model"))
    assert got.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    assert sorted(((r.doc_id, r.decoded) for r in got.collect()), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    digests = unigram.encoded_digests(docs, tokenizers.path("piece_bpe_32k.model")).collect()
    assert sorted(((r.doc_id, r.decoded_sha256) for r in digests), key=str) == sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)
    assert unigram.encode_texts(empty, tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_sharding(docs, rows, empty, spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_GROUP", 2)
    got = sharding.assign_shards(docs, 4).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 4) for r in got) and len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert sharding.assign_shards(empty, 4).count() == 0
    keys = spark.range(4000).select("id", sharding.jump_shard(F.col("id"), 40).alias("a"), sharding.jump_shard(F.col("id"), 41).alias("b"), sharding.jump_walk(F.col("id"), 40).alias("w"))
    counts = keys.groupBy("a").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
    assert counts[0] == 40 and counts[1] > 60 and counts[2] < 150
    assert keys.where("a <> b and b <> 40").count() == 0 and 40 < keys.where("a <> b").count() < 170
    assert keys.where("b <> if(w.next = 40, 40, w.last)").count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=12).astype(np.float32).tolist(), "x") for i in range(300)]
    vectors += [(300 + k, vectors[k][1], "x") for k in range(20)] + [(400, None, "x"), (401, [0.0] * 12, "x"), (402, [float("nan")] + [1.0] * 11, "x"), (403, [None] + [1.0] * 11, "x"), (404, [float("inf")] * 12, "x"), (405, [1.0, 2.0], "x"), (410, [2.0, 1.0], "x"), (None, [1.0] * 12, "x"), (5, vectors[5][1], "x"), (420, [], "x")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score string")
    good = {i: np.array(v, np.float64) for i, v, _ in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    expected = set()
    for q in (i for i in good if i % 5 == 0):
        scored = sorted((-float((good[q] * good[c]).sum()), c) for c in good if c != q and len(good[c]) == len(good[q]))[:7]
        expected |= {(q, r, c, pytest.approx(-s, abs=1e-12)) and (q, r, c) for r, (s, c) in enumerate(scored, 1)}
    for sizes in ((1024, 8192), (8, 16)):
        neighbours.QUERY_BLOCK, neighbours.CANDIDATE_BLOCK = sizes
        got = neighbours.nearest(df, F.col("vec_id") % 5 == 0, k=7).collect()
        assert {(r.query_id, r["rank"], r.vec_id) for r in got} == expected
        assert all(r.score == pytest.approx(float((good[r.query_id] * good[r.vec_id]).sum()), abs=1e-12) for r in got)
    neighbours.QUERY_BLOCK, neighbours.CANDIDATE_BLOCK = 1024, 8192
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    cards = [(m, re.sub("[ -]", "", m[0])) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)]
    out += [(m.start(), 2, m.end()) for m, d in cards if 12 <= len(d) <= 19 and luhn(d)]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans(spark, docs, rows, empty):
    rng = random.Random(8)
    parts = ["a@b.c", "_d@e.f", "@", ".", "1.2.3.4", "256.1.1.1", "0001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+12", " ", "x", "é", "😀", "5" * 13, "1.2.3.4.5.6.7.8", "%a-b@c-d.e-f.", "+1.2.3.4)5 6-7 8 9(", "-", "12"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)] + ["1 " * 3000, "a" * 30000, "7" * 30000, "a@" * 3000, "1." * 5000, "a@b.c " * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        assert [(x.start, x.kind, x.end) for x in r.base] == base(texts[r.doc_id]), texts[r.doc_id][:80]
        assert {tuple(x) for x in r.base} <= {tuple(x) for x in r.spans}
    assert pii.personal_data(docs).count() == len(rows) and pii.personal_data(empty).count() == 0


def test_context_finds_unseen_identifiers(spark):
    rows = [(k, f"some words here and mailto user{k}@mail.example.com more words") for k in range(40)] + [(100, "see mailto user77[at]mail.example now"), (101, "see 2020-11-12a now"), (102, "clean text with 42 numbers")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[40][1]
    assert [(text[x.start : x.end], x.kind) for x in got[100].spans] == [("user77[at]mail.example", 0)]
    assert all(len(got[k].spans) == 1 for k in range(40)) and not got[101].spans and not got[102].spans


def test_quality(spark, docs, empty):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    say = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(40, 90)))
    spoil = [lambda t: t.upper() + "!!", lambda t: " ".join(w + "###" for w in t.split()), lambda t: " ".join([t.split()[0]] * 60)]
    rows, labels = [], []
    for i in range(1500):
        bad = i % 6 == 0
        t = say()
        rows.append((i, spoil[i // 6 % 3](t) if bad else t))
        if i % 3 == 0 or i % 5 == 0:
            labels.append((i, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.learn_quality(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    scored = {r.doc_id: r.score for r in quality.score_quality(df, model).collect()}
    held = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scored[i] >= quality.THRESHOLD) == (i % 6 != 0) for i in held)
    assert right / len(held) >= 0.95
    odd = quality.score_quality(docs, model)
    assert odd.columns == [c for c in docs.columns if c != "score"] + ["score"] and odd.where("score between 0 and 1").count() == docs.count()
    assert quality.score_quality(empty, model).count() == 0
    assert quality.learn_quality(df.limit(0), spark.createDataFrame([], "doc_id long, quality int")).score(np.zeros((1, len(model.edges)))).tolist() == [0.5]


def test_pipeline_stages(spark, tmp_path):
    """Each stage over tables with known copies, passages and leaks; the last decodes to what it was given."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(2000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, item = say(60), say(25)
    texts = {k: say(120) + ".\n" + say(20) for k in range(60)}
    texts |= {60: say(90) + "\n" + passage, 61: say(90) + "\n" + passage, 62: texts[3], 63: texts[4].replace(" ", "  ", 1) + " end", 64: say(50) + " " + item + " " + say(9), 65: (say(30) + " ").upper() * 3 + "!!! ### !!!"}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(pipeline.STAGES)
    lines = {r.doc_id: r.text for r in stages["line_dedup"](spark, docs, str(tmp_path)).collect()}
    assert passage in lines[60] and passage not in lines[61] and 62 not in lines and lines[5] == texts[5]
    assert {r.doc_id for r in stages["jaccard_join"](spark, docs, str(tmp_path)).collect()} == set(texts) - {62, 63}
    assert {r.doc_id for r in stages["decontamination"](spark, docs, str(tmp_path)).collect()} == set(texts) - {64}
    kept = stages["quality_classifier"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(r.round_trip and r.n_tokens == len(r.ids) for r in out)
    assert not {62, 63, 64} & {r.doc_id for r in out}


def found_in(spark, texts):
    """The parts of each text that personal_data() finds, with their kinds."""
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r.doc_id: [(texts[r.doc_id][x.start : x.end], x.kind) for x in r.spans] for r in rows}


def test_context_finds_spaced_identifiers(spark):
    phones = [f"please call +1 (743) 555-{3000 + k} today" for k in range(40)]
    cards = [f"card 4111 1111 1111 {c} expires" for c in range(1000, 1400) if luhn(f"411111111111{c}")]
    texts = phones + cards + ["you may call (743) 555-3824, then", "seen: (212) 555-1188 today", "my card 5222 3333 4444 5556 is", "the 5222 3333 4444 5557 expires", "call (743) 555-3825 1.2.3.4 x", "room 12 34 5678 9 here"]
    got = found_in(spark, texts)
    assert all(len(got[k]) == 1 for k in range(len(phones) + len(cards)))
    n = len(phones) + len(cards)
    assert not luhn("5222333344445556") and not luhn("5222333344445557")
    assert [got[n + k] for k in range(6)] == [[("(743) 555-3824", 3)], [("(212) 555-1188", 3)], [("5222 3333 4444 5556", 2)], [("5222 3333 4444 5557", 2)], [("(743) 555-3825", 3), ("1.2.3.4", 1)], []]


def test_rounds_go_on_until_nothing_is_new(spark):
    sizes, words = [1296, 216, 36, 6, 1], ["wa", "wb", "wc", "wd"]
    item = lambda level, k: f"user{k}@mail{level}.example.com" if level == 0 else f"user{k}[at]mail{level}.example"
    texts = [f"one {words[c]} {item(level, k)} {words[c]} more" for level, n in enumerate(sizes) for c in {max(level - 1, 0), min(level, 3)} for k in range(n)]
    got = found_in(spark, texts)
    assert all(len(got[k]) == 1 for k in range(len(texts)))


def test_neighbouring_words_are_whole(spark):
    tail = "y" * 70
    texts = [f"some words mailto{' ' * (k % 90 + 1)}user{k}@mail.example.com more" for k in range(40)] + [f"long ab{tail} user{k}@mail.example.com" for k in range(40, 80)]
    texts += [f"see mailto{' ' * 80}user77[at]mail.example now", f"see cd{tail} user78[at]mail.example now", f"see ab{tail} user79[at]mail.example now"]
    got = found_in(spark, texts)
    assert [got[k] for k in (80, 81, 82)] == [[("user77[at]mail.example", 0)], [], [("user79[at]mail.example", 0)]]


def test_precision_and_recall_of_what_the_method_adds(spark):
    """Planted identifiers that no base pattern takes, among clean numbers in random contexts."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    code = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 2)) + "a1"
    texts, planted = [], set()
    for k in range(480):
        seed = [f"phone +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"mailto user{k}@mail.example.com", f"from host {rng.randint(1, 255)}.{rng.randint(0, 255)}.1.{k % 256}", f'token = "{code(40)}"'][k % 4]
        texts.append(f"{say(9)} {seed} {say(9)}")
    for k in range(80):
        kind = k % 4
        value = [f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"user{k}[at]mail.example", f"10.0.{k}.x7", code(12)][kind]
        lead = ["" if k % 8 else "phone ", "mailto ", "from host ", 'token = "'][kind]
        texts.append(f"{say(9)} {lead}{value}{'\"' if kind == 3 else ''} {say(9)}")
        planted.add((len(texts) - 1, value))
    texts += [f"{say(9)} {rng.choice([str(rng.randint(1, 10**7)), f'{rng.randint(1900, 2030)}-0{rng.randint(1, 9)}', f'v{k}.2', f'page {k}', f'{k}%'])} {say(9)}" for k in range(300)]
    got = found_in(spark, texts)
    added = {(k, v) for k, spans in got.items() for v, kind in spans if k >= 480}
    assert len(added & planted) >= 0.9 * len(planted) and len(added - planted) <= 0.05 * len(planted)
    assert sum(kind == pii.SECRET for k in range(480) for _, kind in got[k]) == 120


def test_many_numbers_in_one_text(spark):
    texts = [" ".join(f"1.2.{k % 250}.{k % 199}, no{k}" for k in range(8_000))]
    assert len(found_in(spark, texts)[0]) == 8_000


def test_equal_rows_get_slots_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_GROUP", 64)
    docs = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("one text").alias("text"))
    got = sharding.assign_shards(docs, 5).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_digests_of_ids_against_plain_viterbi(docs, rows, vocabulary):
    got = unigram.encoded_digests(docs, tokenizers.path("piece_bpe_32k.model")).collect()
    expected = []
    for i, t in rows:
        ids = viterbi(vocabulary, t or "")
        expected.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(expected, key=str)


def test_vectors_of_doubles_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=5).tolist()) for i in rng.integers(0, 40, 90)]
    least = {}
    for i, v in rows:
        least[i] = min(v, least.get(i, v))
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 4 == 0, k=3).collect()
    expected = set()
    for q in (i for i in least if i % 4 == 0):
        scored = sorted((-float((np.array(least[q]) * np.array(v)).sum()), c) for c, v in least.items() if c != q)[:3]
        expected |= {(q, rank, c) for rank, (_, c) in enumerate(scored, 1)}
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == expected
