"""Exact copies, benchmark passages, near copies and the pipeline against brute force."""

import random
import sys
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotline.llm import bbit_minhash as B, jaccard_rtree as J, radix_dedup as R, suffix_arrays as S
from lotline.llm.cells import links_within
from lotline.llm.components import components
from lotline.sources.staging import staged
from .conftest import WORDS, lowered, sha


def order(doc_id):
    return (doc_id is not None, doc_id or 0)


# --- exact copies --------------------------------------------------------------------------------


def test_radix_groups(docs):
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r.text)].append(r.doc_id)
    wanted = Counter()
    for r in rows:
        members = groups[lowered(r.text)]
        keep = max(members, key=order)
        wanted[(r.doc_id, keep, len(members), sha(lowered(r.text)))] += 1
    found = R.radix_groups(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == wanted
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_radix_groups_of_long_equal_prefixes(spark):
    start = "é" * 3000
    texts = [start, start, start + "a", start + "b", start + "B", start[:-1], "X" * 64, "x" * 64, "x" * 65]
    found = R.radix_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    kept = {r.doc_id: (r.keep_id, r.group_size) for r in found.collect()}
    assert kept == {0: (1, 2), 1: (1, 2), 2: (2, 1), 3: (4, 2), 4: (4, 2), 5: (5, 1), 6: (7, 2), 7: (7, 2), 8: (8, 1)}


def test_exact_dedup_keeps_columns(spark, no_docs):
    rows = [(1, "A", "x"), (2, "a", "y"), (2, "a", "y"), (None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digit string").withColumn("body", F.lit(1))
    out = R.exact_dedup(df)
    assert out.columns == df.columns
    assert {(r.doc_id, r.digit) for r in out.collect()} == {(2, "y"), (None, None)} and out.count() == 2
    assert R.exact_dedup(no_docs).collect() == [] == R.radix_groups(no_docs).collect()


# --- benchmark passages --------------------------------------------------------------------------


def brute_contamination(rows, items):
    windows = defaultdict(set)
    for item_id, text in items:
        words = tuple(WORDS.findall(lowered(text)))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[words[i : i + size]].add("" if item_id is None else str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words = tuple(WORDS.findall(lowered(text)))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if names := windows.get(words[i : i + size]):
                    hit |= set(range(i, i + size))
                    found |= names
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return Counter(out)


@pytest.fixture(scope="module")
def passages(spark):
    rng = random.Random(2)
    vocabulary = [f"b{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(100, items[4][1].upper()), (None, "one two"), (7, None), (8, ""), (9, "..."), (4, items[4][1])]
    texts = []
    for n in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            part = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        texts.append((n, rng.choice([" ", "  ", ", ", "\n"]).join(words)))
    texts += [(None, None), (5, ""), (6, "One; TWO"), (6, "One; TWO"), (7, "w " * 20000 + items[3][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    return docs, texts, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block_bytes, shard_words", [(1 << 20, 1_000_000), (1 << 20, 50), (400, 1000)])
def test_contamination(passages, block_bytes, shard_words):
    docs, texts, benchmark, items = passages
    found = S.contamination(S.matched(docs, benchmark, block_bytes=block_bytes, shard_words=shard_words))
    names = ["source_row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(map(tuple, found.select(names).collect())) == brute_contamination(texts, items)


def test_longest_match(spark):
    docs = spark.createDataFrame([(1, "x a b c d e y"), (2, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "a b c d e f")], "item_id long, text string")
    rows = S.matched(docs, items, window=3).select("source_row.doc_id", "hits.*").collect()
    best = {r.doc_id: (r.longest, r.longest_item, r.longest_at, r.hit_spans) for r in rows}
    assert best == {1: (5, "9", 1, [[1, 6]]), 2: (3, "9", 0, [[0, 3]])}


def longest_of(docs, items, **more):
    rows = S.matched(docs, items, **more).select("source_row.doc_id", "hits.*").collect()
    return Counter((r.doc_id, r.longest, r.longest_item, r.longest_at) for r in rows)


def test_longest_match_of_every_document_of_a_shard(spark):
    passage = "a b c d e f"
    rows = [(1, "x a b c d e y"), (2, "a b c"), (3, f"x {passage}"), (4, f"{passage} y"), (5, f"x x {passage}"), (6, "b c d b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(9, passage), (10, f"z {passage}")], "item_id long, text string")
    assert longest_of(docs, items, window=3) == Counter(
        [(1, 5, "10", 1), (2, 3, "10", 0), (3, 6, "10", 1), (4, 6, "10", 0), (5, 6, "10", 2), (6, 4, "10", 3)]
    )


@pytest.mark.parametrize("block_bytes, shard_words", [(1 << 20, 1_000_000), (1 << 20, 50), (400, 1000)])
def test_longest_match_by_brute_force(passages, block_bytes, shard_words):
    docs, texts, benchmark, items = passages
    split = [("" if i is None else str(i), WORDS.findall(lowered(t))) for i, t in items]
    wanted = Counter()
    for doc_id, text in texts:
        # No long match lies in the filler of the longest text.
        words = WORDS.findall(lowered(text))
        best, skip = (0, None, None), max(0, len(words) - 200)
        for at in range(skip, len(words)):
            for name, ws in split:
                for i in range(len(ws)):
                    n = 0
                    while at + n < len(words) and i + n < len(ws) and words[at + n] == ws[i + n]:
                        n += 1
                    if n >= min(13, len(ws)) and (-n, at, name) < (-best[0], best[2] or 0, best[1] or ""):
                        best = (n, name, at)
        wanted[(doc_id, *best)] += 1
    for parts in (docs, docs.coalesce(1)):
        assert longest_of(parts, benchmark, block_bytes=block_bytes, shard_words=shard_words) == wanted


def test_copies_of_an_item_do_not_fill_a_block(spark):
    rows = [(i, f"item {i} " + "word " * 20) for i in range(40)] + [(1, "one " * 30)] * 500
    items = spark.createDataFrame(rows, "item_id long, text string").repartition(3)
    blocks = list(S.benchmark_blocks(items, 13, 1000))
    assert sorted(n for b in blocks for n in b.names) == sorted(str(r[0]) for r in set(rows))
    assert len(blocks) == sum(len(t) for _, t in set(rows)) // 1000 + 1
    assert max(len(b.names) for b in blocks) < 30


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    for top in (2, 3, 40):
        words = rng.integers(0, top, 400)
        words[100:200] = words[200:300]
        sa = S.suffix_array(words, 1, 1000, top.bit_length())

        def known(i):
            run = words[i:].tolist() + [0]
            return run[: run.index(0)]

        assert [known(i) for i in sa] == sorted(known(i) for i in range(400) if words[i])


def test_decontaminate_empty_tables(spark, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b", "c")], "doc_id long, text string, hits string")
    assert S.decontaminate(one, none).collect() == one.collect()
    assert S.decontaminate(no_docs, spark.createDataFrame([(1, "a")], none.schema)).collect() == []


# --- near copies ---------------------------------------------------------------------------------


def shingles(text):
    words = lowered(text).replace("\t", " ")
    for c in "\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows):
    """Index of each row's component, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def brute_near(rows):
    group, sets = brute_components(rows)
    lowest = {}
    for g, (doc_id, _) in zip(group, rows):
        if doc_id is not None:
            lowest[g] = min(doc_id, lowest.get(g, doc_id))
    return Counter(
        (d, len(s), lowest.get(g) if s else d) for g, s, (d, _) in zip(group, sets, rows)
    )


def near(df, **more):
    numbered = staged(df.withColumn("row", F.monotonically_increasing_id()), "numbered")
    return J.near_duplicates(numbered, **more)


def test_near_duplicates(docs):
    rows = [tuple(r) for r in docs.collect()]
    found = near(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_near(rows)
    group, sets = brute_components(rows)
    assert sum(r.kept for r in found) == len({g for g, s in zip(group, sets) if s}) + sum(not s for s in sets)


def chained_families(rng, families, members):
    """Families of near copies; the first half of each is shared by two families."""
    texts = []
    shared = [f"s{i}" for i in range(70)]
    for f in range(families):
        body = shared[: 40 + 10 * (f % 4)] + [f"f{f}w{i}" for i in range(60)]
        for _ in range(members):
            words = list(body)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("cell, leaf", [(4096, 16), (5, 2), (30, 4)])
def test_trees_and_cells(spark, monkeypatch, cell, leaf):
    monkeypatch.setattr(J, "LEAF", leaf)
    rng = random.Random(4)
    rows = list(enumerate(chained_families(rng, 6, 20)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near(df, cell=cell, family_cell=cell).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_near(rows)


@pytest.mark.parametrize("scale", [1, 90])
def test_tree_misses_no_pair(scale):
    rng = np.random.default_rng(1)
    counts = scale * rng.poisson(rng.choice([1, 2, 6], 300)[:, None], (300, J.GROUPS))
    counts[150:] = np.maximum(0, counts[:150] + rng.integers(-1, 2, (150, J.GROUPS)))
    sizes = counts.sum(axis=1)
    tree, everyone = J.RTree(np.minimum(counts, 255).astype(np.uint8), sizes), np.arange(300)
    assert len(tree.levels) == 3
    dropped = 0
    for a in range(300):
        allowed = np.minimum(counts, counts[a]).sum(axis=1) >= J.needed(sizes, sizes[a])
        found = tree.near(a, everyone)
        assert not (allowed & ~found).any()
        dropped += (~found).sum()
    assert dropped > 300 * 100


@pytest.mark.parametrize("module", [J, B])
def test_a_family_of_long_texts_is_cut_by_shingles(spark, monkeypatch, module):
    """Few texts, but far more shingles than a cell takes: the same components."""
    monkeypatch.setattr(module, "FAMILY_SHINGLES", 500)
    rng = random.Random(6)
    rows = list(enumerate(chained_families(rng, 3, 15)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    numbers = staged(df.withColumn("row", F.monotonically_increasing_id()), "numbered")
    whole = module.near_duplicates(numbers).collect()
    asked = []
    monkeypatch.setattr(module, "links_within", lambda *a: asked.append((a[0].count(), *a[3:])) or links_within(*a))
    found = module.near_duplicates(numbers).collect()
    assert sorted(found) == sorted(whole)
    members, cell, label, weight = asked[-1]
    assert (label, weight) == ("family", 500) and members < cell
    if module is J:
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_near(rows)


def test_heavy_members_get_more_cells(spark):
    """No cell, nor a pair of cells, holds all 60 nodes, which would fit by their number."""

    def few(table):
        if table.num_rows > 40:
            raise ValueError(f"{table.num_rows} nodes in a cell")
        return lambda i, others: np.abs(others - i) < 0  # no links

    rows = [(1, i, 100) for i in range(60)] + [(2, 100, 10**6), (2, 101, 10**6)]
    members = spark.createDataFrame(rows, "group long, node long, weight long")
    payload = members.select("node", F.lit(0).alias("n"))
    assert links_within(members, payload, few, 1000, "heavy", 1000).collect() == []


@pytest.mark.parametrize("module", [J, B])
def test_sets_of_a_family_are_held_once(module):
    """Not several 64-bit numbers for each shingle of a cell beside the sets."""
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words[:3000] + [f"d{d}"] + words[3000:]) for d in range(100)]
    table = pa.table({"body": pa.array([t.encode() for t in texts], pa.binary())})
    if module is B:
        table = table.append_column("signature", pa.array([bytes(8 * B._WORDS)] * len(texts), pa.binary()))
    tracemalloc.start()
    near = module.linked(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 36 * 4000 * len(texts)
    assert near(0, np.arange(1, 100)).all()


def test_numbers_of_words():
    make, long = J.Shingler(), b"x" * 70
    words = [b"a", b"b", b"ab", b"ba", long + b"1", long + b"2", b"x" * 62, b"x" * 63, b"a", long + b"1"]
    numbers = make.numbers(words)
    assert len(set(numbers.tolist())) == 8 and numbers[0] == numbers[8] and numbers[4] == numbers[9]
    for i, word in enumerate(words):  # whatever stands around it
        assert make.numbers([word])[0] == numbers[i]
    many = [b"w%d" % (i % 1000) for i in range(2 * J.TOGETHER + 7)]
    assert len(set(make.numbers(many).tolist())) == 1000
    assert len(make.set_of(many)) == 1000


def test_large_sets_without_a_link_are_no_candidates():
    """Their plain points are alike; the finer ones drop them and keep every pair that links."""
    rng = np.random.default_rng(3)
    sizes = [*[1500, 1900, 2100] * 4, *[9000, 12000] * 6, 300, 900]
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    for n in (2, 4, 12, 13):  # near copies, some with another number of groups
        sets.append(np.unique(np.concatenate([sets[n][: int(len(sets[n]) * 0.93)], sets[n] + np.uint64(1)][: 1 + n % 2])))
    sets += [sets[2][: int(len(sets[2]) * 0.96)], sets[13][: int(len(sets[13]) * 0.81)]]
    fine = [J.group_counts(s, J.fine_groups(len(s))).tobytes() if J.fine_groups(len(s)) else None for s in sets]
    points = [J.group_counts(s).tobytes() for s in sets]
    table = pa.table({"point": pa.array(points, pa.binary()), "fine": pa.array(fine, pa.binary()), "n": [len(s) for s in sets]})
    near, everyone, tree = J.may_link(table), np.arange(len(sets)), 0
    plain = J.RTree(np.stack([np.frombuffer(p, np.uint8) for p in points]), np.array([len(s) for s in sets])).near
    for i, a in enumerate(sets):
        both = np.array([len(np.intersect1d(a, b)) for b in sets])
        link = 100 * both >= 80 * (len(a) + np.array(list(map(len, sets))) - both)
        found = near(i, everyone)
        assert not (link & ~found).any()
        assert found.sum() <= link.sum() + 1
        tree += plain(i, everyone).sum() - link.sum()
    assert tree > 60  # so many pairs more without the finer points
    assert {J.fine_groups(n) for n in (1, 1024)} == {0} and J.fine_groups(1025) == 256 and J.fine_groups(10**9) == 1 << 14


def test_clipped_fine_points_lose_no_pair():
    """Counts end at 255; what is beyond still counts as shared."""
    rng = np.random.default_rng(5)
    counts = rng.poisson(250, (60, 256))
    counts[30:] = np.maximum(0, counts[:30] + rng.integers(-3, 4, (30, 256)))
    points = [np.minimum(c if i % 3 else np.concatenate([c - c // 3, c // 3]), 255).astype(np.uint8).tobytes() for i, c in enumerate(counts)]
    sizes = counts.sum(axis=1)
    fine = J.FinePoints(points, sizes)
    for i in range(60):
        most = np.minimum(counts, counts[i]).sum(axis=1)
        found = fine.allowed(i, np.arange(60))
        assert not ((most >= J.needed(sizes, sizes[i])) & ~found).any()
        assert found[i]


def test_blocks_with_the_same_nodes_count_once(spark):
    rows = [(0, "a b c d e f g h i j k l m n o p q r s t"), (1, "a b c d e f g h i j k l m n o p q r s u")]
    df = spark.createDataFrame(rows * 3, "doc_id long, text string").withColumn("row", F.monotonically_increasing_id())
    names = [(i, J.name_of(text.encode().split())[0], 16) for i, text in rows]
    nodes = spark.createDataFrame(names, "node long, name long, n long")
    blocks = J.blocks_of(df, nodes, np.zeros(1 << J.SKETCH_BITS, np.int64)).collect()
    assert len(blocks) == 2 and len({r.group for r in blocks}) == 1


@pytest.mark.parametrize("step", [1, 100])
def test_members_of_shared_routes(step):
    """Every member of a route with several names comes out, however the entries meet."""
    rng = np.random.default_rng(2)
    routes, names = rng.integers(-40, 40, 300), rng.integers(-2, 3, 300)
    routes[:60] = 7  # a hot one
    want = {(r, n) for r, n in zip(routes, names) if len(set(names[routes == r])) > 1}
    assert want and len(want) < len(set(zip(routes, names)))
    sent = [J._sent(routes[i : i + step], names[i : i + step], 3) for i in range(0, 300, step)]
    out = [b for b in J._members(iter(sent))]
    found = [(g, n) for b in out for g, n in zip(b.column("group").to_pylist(), b.column("name").to_pylist())]
    assert set(found) == want


def test_two_sequences_of_one_half_name(spark, monkeypatch):
    """Sequences that agree in 64 bits of their names stay apart."""
    whole = J.name_of
    monkeypatch.setattr(J, "name_of", lambda words: (1, whole(words)[1]))
    rows = [(1, "a b c d e f g"), (2, "t u v w x y z"), (3, "a b c d e f g")]
    found = near(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 2), (3, 1)]


def test_one_of_each_keeps_columns(spark, no_docs):
    rows = [(5, "a b c d e f", 1), (2, "A b  c d e f", 2), (2, "A b  c d e f", 2), (9, None, 3), (None, "", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumn("node", F.lit("n"))
    out = J.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.row for r in out.collect()) == [2, 3, 4]
    assert J.one_of_each(no_docs).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    assert {(r.node, r.label) for r in found} == {(i, 1) for i in range(1, 61)} | {(100, 100), (101, 100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("edges, most", [([(5, 1), (9, 1), (7, 2)], 1), ([(1, 5), (5, 9), (2, 7)], 2)])
def test_components_stop_when_all_are_stars(spark, monkeypatch, edges, most):
    """No step more to see that nothing changes."""
    written = []
    module = sys.modules["lotline.llm.components"]
    monkeypatch.setattr(module, "staged", lambda df, label: written.append(label) or staged(df, label))
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.label) for r in found} == {(1, 1), (5, 1), (9, 1), (2, 2), (7, 2)}
    assert len(written) <= most


# --- pipeline ------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = [f"p{i}" for i in range(400)]
    good = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30, 120))) for _ in range(120)]
    bad = ["### $$$ ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(120)]
    passage = " ".join(f"q{i}" for i in range(20))
    texts = good + bad + [good[0].upper(), good[1] + " tail", good[2] + " " + passage]
    rows = [(i, t, "en", "s", len(t), "extra") for i, t in enumerate(texts)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 120), 0) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == documents.columns
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id for r in now.collect()})
    assert kept[0] == set(range(120)) | {240, 241, 242}
    assert kept[1] == kept[0] - {0}
    group, _ = brute_components([r[:2] for r in rows if r[0] in kept[1]])
    assert len(kept[2]) == len(set(group)) and 241 not in kept[2]
    assert kept[3] == kept[2] - {242}
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.collect()} == kept[3]
