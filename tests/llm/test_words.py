"""Decontamination, line dedup and the Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from loomtext.llm import components, decontaminate, jaccard, linededup


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contamination(spark, docs, rows, texts, empty):
    long = words(texts[9])
    items = [(1, " ".join(long[5:30])), (2, " ".join(long[40:47])), (3, "two words"), (4, ""), (5, None), (6, "TWO, words!"), (7, " ".join(long[5:15] + ["zz"])), (8, "absent thing here"), (10, "one")]
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = []
    for i, t in rows:
        w, hit, found = words(t), set(), []
        for item, it in items:
            v = words(it)
            size = min(10, len(v))
            for p in range(len(v) - size + 1 if v else 0):
                for q in range(len(w) - size + 1):
                    if w[q : q + size] == v[p : p + size]:
                        hit |= set(range(q, q + size))
                        found.append(str(item))
        expected.append((i, len(w), len(hit), sorted(set(found))))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == sorted(expected, key=str)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(empty, none).count() == 0


def left_of(rows, least):
    """Text, lines and removed lines of each row, by the definition."""
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    windows = {}
    for d in docs:
        lines = [(k, x, len([w for w in x.split(" ") if w])) for k, x in enumerate(d[2].split("\n"))]
        lines = [x for x in lines if x[2]]
        for a in range(len(lines)):
            for kind, run in ((0, lines[a:]), (1, lines[: a + 1][::-1])):
                total = 0
                for n, x in enumerate(run, 1):
                    total += x[2]
                    if total >= least:
                        run = sorted(run[:n])
                        windows.setdefault((kind, tuple(x[1] for x in run)), []).append((d, run[0][0], run[-1][0]))
                        break
    gone = {d: set() for d in docs}
    for places in windows.values():
        first = min((p[0][0], p[0][1], p[1]) for p in places)
        for d, lo, hi in places:
            if (d[0], d[1], lo) != first:
                gone[d] |= set(range(lo, hi + 1))
    out = []
    for i, t in rows:
        parts, drop = (t or "").split("\n"), gone[(i is not None, i or 0, t or "")]
        drop = {k for k in drop if parts[k].replace(" ", "")} | {k for k in drop if not parts[k].replace(" ", "")}
        n = sum(1 for x in parts if x.replace(" ", ""))
        kept = "\n".join(x for k, x in enumerate(parts) if k not in drop)
        out.append((i, n, len(drop), None if t is None else kept))
    return sorted(out, key=str)


def test_line_dedup(docs, rows, empty):
    unique = docs.where("doc_id is not null and (doc_id <> 7 or text not like 'other%')")
    got = linededup.drop_repeated_lines(unique, min_words=25)
    kept = [(i, t) for i, t in rows if i is not None and not (i == 7 and t.startswith("other"))]
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()), key=str) == left_of(kept, 25)
    assert got.columns[: len(docs.columns)] == docs.columns and sum(r.n_removed for r in got.collect()) > 3
    assert linededup.drop_repeated_lines(docs).count() == docs.count()
    assert linededup.drop_repeated_lines(empty).count() == 0


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                top[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 50)])
def test_near_duplicates(docs, rows, size, percent):
    got = jaccard.near_duplicates(docs, size=size, percent=percent)
    assert sorted(((r.doc_id, r.n, r.component_doc) for r in got.collect()), key=str) == groups(rows, size, percent)


def test_near_duplicates_of_large_groups(spark, empty, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_ROWS", 16)
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for k in range(160):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.near_duplicates(docs, size=3, percent=90)
    assert sorted(((r.doc_id, r.n, r.component_doc) for r in got.collect()), key=str) == groups(rows, 3, 90)
    assert jaccard.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(0, 40)] + [(rng.randint(50, 120), rng.randint(50, 120)) for _ in range(60)] + [(-5, 3), (200, 200)]
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            top[max(a, b)] = min(a, b)
    expected = {x: root(x) for x in list(top)}
    table = spark.createDataFrame(links, "a long, b long")
    for bound in (10**6, 0):
        assert {r.node: r.label for r in components.components(table, bound).collect()} == expected
        assert components.components(table.limit(0), bound).count() == 0


def test_prefixes_meet():
    for percent in (50, 80, 90):
        for n in range(1, 400):
            need = -(-percent * n // 100)
            assert jaccard.prefix_length(n, percent) == n - need + 1


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    from loomtext.llm import memo

    monkeypatch.setattr(memo, "span_hash", lambda sums, start, end: (end - start).astype(np.uint64) // np.uint64(4))
    encode = lambda raw, start, end: (np.concatenate([np.frombuffer(raw[a:b], np.uint8) for a, b in zip(start, end)]).astype(np.uint32), end - start)
    coder = memo.Memo(encode, 1000)
    raw = np.frombuffer(b"ab" + b"cd" + b"ab" + b"long piece one" + b"long piece two", np.uint8)
    for start, end in (([0], [2]), ([2], [4]), ([0, 2, 4], [2, 4, 6]), ([6, 20], [20, 34])):
        ids, count = coder.lookup(raw, np.array(start), np.array(end))
        assert bytes(ids.astype(np.uint8)) == b"".join(raw[a:b].tobytes() for a, b in zip(start, end)) and count.tolist() == [b - a for a, b in zip(start, end)]
