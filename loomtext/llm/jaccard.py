"""N-gram Jaccard join with grouped prefixes.

Documents become sets of word shingles. Equal sets form a class, classes with the same size and the same prefix a group,
where the prefix holds the rarest shingles by a frequency table of all documents. Groups that share a prefix token pass
a length and a positional filter; surviving group pairs expand to their classes, whose texts are compared.

Two passes keep hot groups from yielding all their pairs: the first compares neighbours and the head of each token's
list and contracts what links; the second compares only what is still in different components. Token lists beyond a
bound are cut into blocks, and pairs of blocks go to tasks of their own, so no list meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.bytewise import buffer_of, chunks, mix, shingles, word_hashes
from loomtext.llm.components import components
from loomtext.llm.staging import row_key, staged

#: Buckets of the frequency table: its size does not grow with the data.
BUCKET_BITS = 18
#: Rows of a token's list that one task may pair; longer lists are cut into blocks.
LIST_ROWS = 2048
#: Bits of a set's bitmap, and of its short form that travels with the token lists.
MAP_BITS = 2048
FOLD_BITS = 256
#: Passes over neighbours in the token lists before the pass over all pairs of components.
NEAR_ROUNDS = 2
SIGNS = ["sig_a", "sig_b", "key_a", "key_b"]
#: Texts of candidates are picked by a broadcast of their ids up to this many (24 bytes each), else by a shuffle.
BROADCAST_IDS = 1_000_000
_FOLD = 12


def _tables(column: pa.Array, size: int):
    for lo, hi, raw, offsets in chunks(column):
        yield lo, hi, *shingles(*word_hashes(raw, offsets), size)


def shingle_frequency(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Counts of all documents' shingles in 2**BUCKET_BITS hash buckets; partial tables are added up by block."""

    def count(batches):
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, _, hashes, _ in _tables(batch.column(0), size):
                total += np.bincount((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
        parts = total.reshape(-1, 1 << _FOLD)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())], names=["block", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _FOLD, np.int64)
        for batch in batches:
            for counts in batch.column("counts"):
                total += np.frombuffer(counts.as_py(), np.int64)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "counts"])

    rows = docs.select(text).mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary").collect()
    out = np.zeros((1 << BUCKET_BITS - _FOLD, 1 << _FOLD), np.int64)
    for row in rows:
        out[row["block"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def prefix_length(n, percent: int):
    """Shingles of a set of ``n`` that any set linked with it must meet: n - ceil(percent * n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def shingle_sets(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(row, doc_id, key, digest, n, sig_a, sig_b, key_a, key_b, map, fold, prefix) of each document.

    row numbers the rows of this table; key and digest are 128 bits of id and text, and of the text.
    n counts distinct shingles; sig_* identify the set and key_* the prefix; map is a bitmap in which each shingle flips
    one bit, so two sets differ in at least as many shingles as their bitmaps in bits.

    prefix: its rarest tokens, rarest first, a token being the frequency class and the hash. Null, empty and wordless
    texts have n = 0 and no prefix.
    """
    spark = docs.sparkSession
    rank = spark.sparkContext.broadcast(np.floor(2 * np.log2(np.maximum(shingle_frequency(docs, text, size), 1))).clip(0, 127).astype(np.uint64))

    def sets(batches):
        for batch in batches:
            parts = []
            for lo, hi, hashes, owner in _tables(batch.column(4), size):
                token = (rank.value[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] << np.uint64(56)) | (hashes >> np.uint64(8))
                order = np.lexsort((token, owner))
                token, owner = token[order], owner[order]
                keep = np.ones(len(token), bool)
                keep[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
                token, owner = token[keep], owner[keep]
                n = np.bincount(owner, minlength=hi - lo)
                ends = np.concatenate(([0], np.cumsum(n)))
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(token + np.uint64(salt))))) for salt in (1, 0x5851F42D4C957F2D)]
                sig = [(s[ends[1:]] - s[ends[:-1]]).view(np.int64) for s in sums]
                take = np.where(n > 0, prefix_length(n, percent), 0)
                place = np.arange(len(token)) - np.repeat(ends[:-1], n)
                prefix = token[place < np.repeat(take, n)]
                stops = np.concatenate(([0], np.cumsum(take)))
                for salt in (5, 7):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(prefix + np.uint64(salt)))))
                    sig.append((total[stops[1:]] - total[stops[:-1]]).view(np.int64))
                spread = mix(token + np.uint64(11))
                flips = np.bincount(owner * MAP_BITS + (spread % np.uint64(MAP_BITS)).astype(np.int64), minlength=(hi - lo) * MAP_BITS)
                maps = np.packbits((flips & 1).astype(np.uint8).reshape(hi - lo, MAP_BITS), axis=1)
                folds = np.bitwise_xor.reduce(maps.reshape(hi - lo, -1, FOLD_BITS // 8), axis=1)
                parts.append((n, take, prefix.view(np.int64), maps, folds, *sig))
            if not parts:
                continue
            n, take, prefix, maps, folds, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(take))), pa.int32()), pa.array(prefix))
            yield pa.record_batch([*batch.columns[:4], pa.array(n, pa.int64()), *map(pa.array, rest), _map_column(maps), _map_column(folds), lists], names=["row", "doc_id", "key", "digest", "n", *SIGNS, "map", "fold", "prefix"])

    kind = docs.select(doc_id).dtypes[0][1]
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), row_key(text).alias("digest"), F.col(text).alias("text"))
    return base.mapInArrow(sets, f"row long, doc_id {kind}, key struct<a:long,b:long>, digest struct<a:long,b:long>, n long, {', '.join(f'{c} long' for c in SIGNS)}, map binary, fold binary, prefix array<long>")


def _map_column(maps: np.ndarray) -> pa.Array:
    """Bitmaps, a row of bytes each, as a binary column."""
    ends = np.arange(len(maps) + 1, dtype=np.int32) * maps.shape[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(maps), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(maps.tobytes())])


def _columns(batch: pa.RecordBatch, names: list[str], maps: tuple = ("map",)) -> dict[str, np.ndarray]:
    """Columns of a batch with rows as arrays; bitmaps as rows of 64-bit words."""
    return {k: buffer_of(batch.column(k))[0].view(np.uint64).reshape(batch.num_rows, -1) if k in maps else batch.column(k).to_numpy(zero_copy_only=False) for k in names}


def _passes(one: dict, i, two: dict, j, percent: int) -> np.ndarray:
    """Which entries i and j may link: by length, by position and by bitmap; none that links fails.

    Position: a pair passes at its first common token, as it has no common shingle before that one.
    """
    n1, n2 = one["n"][i], two["n"][j]
    need = -(-percent * (n1 + n2) // (100 + percent))
    ok = (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (np.minimum(n1 - one["pos"][i], n2 - two["pos"][j]) >= need)
    at = np.flatnonzero(ok)
    if len(at):
        apart = np.bitwise_count(one["map"][i[at]] ^ two["map"][j[at]]).sum(axis=1, dtype=np.int64)
        grouped = (one["members"][i[at]] > 1) | (two["members"][j[at]] > 1) if "members" in one else False
        ok[at] = ((100 + percent) * apart <= (100 - percent) * (n1 + n2)[at]) | grouped
    return ok


def _sorted_batches(batches, names):
    """Batches joined so that no run of equal keys (the first two columns) is cut; the rows come sorted by them."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = _columns(batch, names)
        if held is not None:
            now = {k: np.concatenate((held[k], now[k])) for k in names}
        key = [now[k] for k in names[:2]]
        last = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield {k: v[:cut] for k, v in now.items()}
        held = {k: v[cut:] for k, v in now.items()}
    if held is not None and len(held[names[0]]):
        yield held


def _first_of_equal_lists(lists: DataFrame) -> DataFrame:
    """Of the token lists with the same groups only that of the least token.

    Tokens are ordered alike in all prefixes, so for any two of these groups it comes first of them all, and no pair's
    first common token is lost.
    """
    whole = lists.groupBy("token", "often").agg(F.bit_xor(F.xxhash64("grp")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "grp")).alias("y"))
    return lists.join(whole.groupBy("often", "x", "y").agg(F.min("token").alias("token")).select("token"), "token", "left_semi")


def _dealt(lists: DataFrame) -> DataFrame:
    """Entries dealt by token, those of long lists by token and block."""
    return lists.repartition("token", F.pmod(F.xxhash64("grp"), F.ceil(F.col("often") / LIST_ROWS).cast("int")))


def _near_pairs(lists: DataFrame, percent: int, turn: int) -> DataFrame:
    """Of each token's list: neighbours, and each entry with the head, where labels differ and they may link.

    The first turn goes by position, so the sets with the fewest rare shingles come first; later ones by a hash.
    """
    names = ["token", "n", "pos", "grp", "label", "map"]

    def near(batches):
        last = head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = _columns(batch, names)
            start = 0 if last is None else 2
            if last is not None:
                now = {k: np.concatenate((head[k], last[k], v)) for k, v in now.items()}
            token = now["token"]
            at = np.arange(start, len(token))
            new = np.concatenate(([True], token[1:] != token[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            out = []
            for other in (at - 1, first[at]):
                use = (other >= 0) & (token[other] == token[at]) & (now["label"][other] != now["label"][at])
                i, k = other[use], at[use]
                ok = _passes(now, i, now, k, percent)
                out.append(np.sort(np.stack((now["grp"][i][ok], now["grp"][k][ok]), axis=1), axis=1))
            pairs = np.unique(np.concatenate(out), axis=0)
            end = len(token) - 1
            last, head = ({k: v[x : x + 1] for k, v in now.items()} for x in (end, first[end]))
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    order = ["pos", "n", "grp"] if turn == 0 else [F.xxhash64(F.lit(turn), "grp")]
    return lists.select(*names).sortWithinPartitions("token", *order).mapInArrow(near, "a long, b long")


def _cross_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, label_a, b, label_b): of each token's list, the pairs of entries with different labels that may link."""
    blocks = F.ceil(F.col("often") / LIST_ROWS).cast("int")
    own = F.pmod(F.xxhash64("grp"), blocks).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.least(x, own).cast("long") * blocks + F.greatest(x, own))
    names = ["token", "tile", "n", "pos", "grp", "label", "block", "blocks", "members", "map"]
    rows = lists.select("token", F.explode(tiles).alias("tile"), "n", "pos", "grp", "label", own.cast("long").alias("block"), blocks.cast("long").alias("blocks"), "members", "map")

    def cross(batches):
        for run in _sorted_batches(batches, names):
            where = np.flatnonzero(np.concatenate(([True], (run["token"][1:] != run["token"][:-1]) | (run["tile"][1:] != run["tile"][:-1]))))
            mixed = np.minimum.reduceat(run["label"], where) != np.maximum.reduceat(run["label"], where)
            keep = np.repeat(mixed, np.diff(np.append(where, len(run["token"]))))
            x = {k: v[keep] for k, v in run.items()}
            #: a tile of two blocks has the pairs across them; the pairs within a block have a tile of their own
            inner = x["tile"] // x["blocks"] == x["tile"] % x["blocks"]
            active, step, out = np.arange(len(x["token"]) - 1), 1, []
            while len(active):
                active = active[active + step < len(x["token"])]
                other = active + step
                go = (x["token"][active] == x["token"][other]) & (x["tile"][active] == x["tile"][other]) & (100 * x["n"][active] >= percent * x["n"][other])
                active, other = active[go], other[go]
                use = (x["label"][active] != x["label"][other]) & (inner[active] | (x["block"][active] != x["block"][other]))
                i, k = active[use], other[use]
                ok = _passes(x, i, x, k, percent)
                if ok.any():
                    i, k = i[ok], k[ok]
                    swap = x["grp"][i] > x["grp"][k]
                    i, k = np.where(swap, k, i), np.where(swap, i, k)
                    out.append(np.stack((x["grp"][i], x["label"][i], x["grp"][k], x["label"][k]), axis=1))
                step += 1
            if out:
                pairs = np.unique(np.concatenate(out), axis=0)
                yield pa.record_batch([pa.array(pairs[:, k]) for k in range(4)], names=["a", "label_a", "b", "label_b"])

    dealt = rows.repartition("token", "tile").sortWithinPartitions("token", "tile", "n", "pos", "grp")
    return dealt.mapInArrow(cross, "a long, label_a long, b long, label_b long")


def _possible(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The class pairs whose sizes and bitmaps allow a link; none that links is dropped."""
    names = pairs.columns
    schema = pairs.schema
    for side in ("a", "b"):
        pairs = pairs.join(members.select(F.col("class_id").alias(side), F.col("n").alias(f"{side}_n"), F.col("map").alias(f"{side}_map")), side)

    def test(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _columns(batch, ["a_n", "b_n", "a_map", "b_map"], ("a_map", "b_map"))
            sides = [{"n": x[f"{s}_n"], "map": x[f"{s}_map"], "pos": np.zeros(len(x["a_n"]), np.int64)} for s in ("a", "b")]
            every = np.arange(len(x["a_n"]))
            keep = pa.array(_passes(sides[0], every, sides[1], every, percent))
            yield batch.select(names).filter(keep)

    return pairs.select(*names, "a_n", "b_n", "a_map", "b_map").mapInArrow(test, schema)


def _verified(pairs: DataFrame, heads: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The class pairs (a, b) whose shingle sets link, compared by their whole texts. docs: (digest, text); heads: (row, digest)."""
    ids = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct()
    wanted = heads.join(ids, "row")
    few = pairs.count() <= BROADCAST_IDS // 2
    some = docs.join(F.broadcast(wanted.select("digest")) if few else wanted.select("digest"), "digest", "left_semi")
    texts = staged(some.groupBy("digest").agg(F.any_value("text").alias("text")).join(wanted, "digest").select("row", "text"), "texts")
    both = pairs.join(texts.select(F.col("row").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("row").alias("b"), F.col("text").alias("y")), "b")

    def verify(batches):
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            ids = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("a", "b")]
            for id_, name in zip(ids, ("x", "y"), strict=True):
                fresh = np.unique(id_, return_index=True)
                fresh = [(int(i), int(k)) for i, k in zip(*fresh, strict=True) if int(i) not in seen]
                if fresh:
                    for lo, hi, hashes, owner in _tables(batch.column(name).take(pa.array([k for _, k in fresh])), size):
                        ends = np.searchsorted(owner, np.arange(hi - lo + 1))
                        for k in range(hi - lo):
                            seen[fresh[lo + k][0]] = np.unique(hashes[ends[k] : ends[k + 1]])
            ok = []
            for i, j in zip(*ids, strict=True):
                u, v = seen[int(i)], seen[int(j)]
                at = np.searchsorted(v, u)
                at[at == len(v)] = 0
                common = int((v[at] == u).sum()) if len(v) else 0
                ok.append(100 * common >= percent * (len(u) + len(v) - common))
            ok = np.array(ok, bool)
            if sum(map(len, seen.values())) > 4_000_000:
                seen.clear()
            yield pa.record_batch([pa.array(ids[0][ok]), pa.array(ids[1][ok])], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def _labelled_lists(lists: DataFrame, labelled: DataFrame, members: DataFrame) -> DataFrame:
    """The lists with an entry for each label that a group's members have; a group of several labels is a list too."""
    parts = labelled.groupBy("grp", "label").agg(F.first("n").alias("n"))
    torn = parts.groupBy("grp").agg(F.count(F.lit(1)).alias("often"), F.min("label").alias("l"), F.max("label").alias("m")).where("often > 1").select("grp", "often")
    within = parts.join(torn, "grp").select(F.xxhash64(F.lit("group"), "grp").alias("token"), "n", F.lit(0).cast("long").alias("pos"), "grp", "often", "label")
    #: bitmaps tell members apart, so entries of a group with several members leave the bitmap test to their expansion
    within = within.withColumn("map", F.lit(bytes(FOLD_BITS // 8)))
    single = labelled.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    across = lists.join(parts.select("grp", "label"), "grp").join(single, "grp")
    return across.select("token", "n", "pos", "grp", "often", "label", "map", "members").unionByName(within.withColumn("members", F.lit(2).cast("long")))


def _expanded(cross: DataFrame, labelled: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b, label_a, label_b): the class pairs of the group pairs that may link."""
    a = labelled.select(F.col("grp").alias("a"), F.col("label").alias("label_a"), F.col("class_id").alias("x"))
    b = labelled.select(F.col("grp").alias("b"), F.col("label").alias("label_b"), F.col("class_id").alias("y"))
    pairs = cross.join(a, ["a", "label_a"]).join(b, ["b", "label_b"])
    turned = F.col("x") > F.col("y")
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(turned, F.col("label_b")).otherwise(F.col("label_a")).alias("label_a"), F.when(turned, F.col("label_a")).otherwise(F.col("label_b")).alias("label_b"))
    return _possible(pairs.distinct(), members, percent)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(row, doc_id, key, n, class_id, component, component_doc) of each document.

    row numbers the documents; key is 128 bits of id and text, as row_key() gives them.

    Two documents link when 100 * common shingles >= percent * shingles of either. class_id: smallest row with the same
    set; component: smallest row reachable; component_doc: smallest doc_id reachable. Documents without words are linked
    with nothing. Repeated rows are equal sets; a null doc_id takes part but is never the smallest. Other columns are ignored.
    """
    sets = staged(shingle_sets(docs, doc_id, text, size, percent), "sets")
    some = sets.where("n > 0")
    same_set = ["n", "sig_a", "sig_b"]
    classes = staged(some.groupBy(*same_set).agg(F.min("row").alias("class_id"), F.min("doc_id").alias("class_doc")), "classes")
    heads = some.join(classes.select(F.col("class_id").alias("row"), *same_set), ["row", *same_set], "left_semi")
    members = staged(heads.select(F.col("row").alias("class_id"), "n", "key_a", "key_b", "map", "fold").distinct(), "members")
    groups = members.groupBy("n", "key_a", "key_b").agg(F.min("class_id").alias("grp"))
    grouped = staged(members.select("class_id", "n", "key_a", "key_b").join(groups, ["n", "key_a", "key_b"]).select("grp", "class_id", "n"), "groups")
    leaders = some.select("row", "n", "prefix").join(grouped.where("grp = class_id").select(F.col("grp").alias("row")), "row", "left_semi").dropDuplicates(["row"])
    tokens = leaders.select(F.posexplode("prefix").alias("pos", "token"), "n", F.col("row").alias("grp")).select("token", F.col("n").cast("int").alias("n"), "pos", "grp")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = staged(tokens.join(often, "token").select("token", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"), "grp", "often"), "shared")
    lists = _first_of_equal_lists(shared).join(members.select(F.col("class_id").alias("grp"), F.col("fold").alias("map")), "grp")
    lists = staged(_dealt(lists), "lists")

    texts = docs.select(row_key(text).alias("digest"), F.col(text).alias("text"))
    digests = staged(heads.select("row", "digest"), "digests")
    #: classes of one group are tried with its head first
    tried = grouped.where("grp <> class_id").select(F.col("grp").alias("a"), F.col("class_id").alias("b"))
    links, labelled = None, grouped.withColumn("label", F.col("class_id"))
    for turn in range(NEAR_ROUNDS):
        leading = labelled.where("grp = class_id").select("grp", "label")
        entries = _dealt(lists.join(leading, "grp")) if turn else lists.withColumn("label", F.col("grp"))
        near = _near_pairs(entries, percent, turn).unionByName(tried).distinct()
        found = _verified(staged(_possible(near, members, percent), "pairs"), digests, texts, size, percent)
        links = staged(found if links is None else links.unionByName(found), "links")
        labels = components(links).withColumnRenamed("node", "class_id")
        labelled = staged(grouped.join(labels, "class_id", "left").select("grp", "class_id", "n", F.coalesce("label", "class_id").alias("label")), "labelled")
        tried = tried.limit(0)

    cross = staged(_expanded(_cross_pairs(_labelled_lists(lists, labelled, members), percent).distinct(), labelled, members, percent), "cross")
    #: one pair for each two components first; most of the others are in one component then
    tried = staged(cross.groupBy("label_a", "label_b").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b"), "pairs")
    links = staged(links.unionByName(_verified(tried, digests, texts, size, percent)), "links")
    labels = components(links)
    of = {x: labels.select(F.col("node").alias(x), F.col("label").alias(f"now_{x}")) for x in ("a", "b")}
    left = cross.select("a", "b").join(tried, ["a", "b"], "left_anti").join(of["a"], "a", "left").join(of["b"], "b", "left")
    left = staged(left.where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select("a", "b"), "pairs")
    more = staged(_verified(left, digests, texts, size, percent), "links")

    final = labels if more.isEmpty() else components(links.unionByName(more))
    joined = classes.join(final.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("component", F.coalesce("label", "class_id"))
    least = joined.groupBy("component").agg(F.min("class_doc").alias("component_doc"))
    named = joined.join(least, "component").select(*same_set, "class_id", "component", "component_doc")
    return sets.select("row", "doc_id", "key", *same_set).join(named, same_set, "left").select(
        "row", "doc_id", "key", "n", F.coalesce("class_id", "row").alias("class_id"), F.coalesce("component", "row").alias("component"),
        F.coalesce("component_doc", "doc_id").alias("component_doc"),
    )
