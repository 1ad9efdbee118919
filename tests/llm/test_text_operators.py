"""The operators on texts against plain versions, with their defined cases."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from plain import benchmark_words, best_fit, contamination, jaccard_components, repeats
from tokenizers import Tokenizer

from adtally.llm import decontaminate, jaccard_join, packing, suffix_dedup
from adtally.llm.common import Stages
from adtally.llm.components import components
from adtally.llm.queries import word_tokenizer

DOC = "doc_id long, text string, source string, start long, item_id long"  # with columns whose names clash
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows], DOC)


def prose(rng, n, words=None):
    words = words or [a + b for a in WORDS for b in WORDS]
    return " ".join(rng.choice(words) for _ in range(n))


# --- n-gram Jaccard join -------------------------------------------------------------------


def near_documents(rng):
    docs = []
    for _ in range(12):
        base = prose(rng, rng.randint(4, 200)).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS).upper()
            docs.append(" ".join(copy))
    docs += ["", " \t\n", "one two", "One TWO", "one", "one two three four five", docs[3], docs[3].upper()]
    return list(enumerate(docs)) + [(500, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    docs = near_documents(random.Random(seed))
    random.Random(seed).shuffle(docs)
    got = jaccard_join.similar_documents(frame(spark, docs).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(docs)


def test_jaccard_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = prose(rng, 60).split()
    docs = []
    for k in range(560):  # more than are paired in memory
        copy = list(base)
        copy[rng.randrange(60)] = f"w{k}"
        docs.append((k + 1, " ".join(copy)))
    docs.append((0, " ".join(base[:30]) + " " + prose(rng, 40)))
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_documents(frame(spark, docs)).collect()}
    assert got == {i: c for i, (_, c) in jaccard_components(docs).items()}


@pytest.mark.parametrize("paired", [16, 4096])
def test_jaccard_dense_groups_with_lone_members(spark, paired):
    """Clusters of near copies, and texts with which they share a passage only: in memory, and as groups too large for that."""
    rng = random.Random(13)
    passage = prose(rng, 30)
    docs = []
    for _ in range(3):
        base = prose(rng, 70).split()
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(70)] = f"x{rng.randrange(999)}"
            docs.append(passage + " " + " ".join(copy))
    docs += [f"{passage} {prose(rng, rng.randint(1, 20))}" for _ in range(40)]
    docs = list(enumerate(docs))
    got = jaccard_join.similar_documents(frame(spark, docs), paired=paired).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(docs)


def test_sketches_bound_the_overlap():
    """Never below the true overlap, for sets of one size class and of neighbouring ones."""
    rng = np.random.default_rng(3)
    sets, hashes = [], rng.integers(0, 2**64, 6000, dtype=np.uint64)
    for n in (1, 5, 200, 256, 300, 500, 520, 700, 1000, 1030, 2000, 3000):
        sets.append(np.sort(rng.choice(hashes, n, replace=False)))
    shell = jaccard_join.Sets.__new__(jaccard_join.Sets)
    shell.hashes, shell.begin = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    shell.sizes = np.diff(shell.begin)
    press = jaccard_join._press()
    sketches = jaccard_join.Sketches([press(np.frombuffer(shell.sketch(k), np.uint8)) for k in range(len(sets))])
    a, b = np.array([(i, j) for i in range(len(sets)) for j in range(len(sets))]).T
    true = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)])
    share = sketches.share(a, b)
    assert (share >= true).all()
    same = a == b
    assert (share[same] == true[same]).all()
    near = (np.maximum(shell.sizes[a], shell.sizes[b]) * 0.8 <= np.minimum(shell.sizes[a], shell.sizes[b])) & ~same & (shell.sizes[a] > 100)
    assert (share[near] < 0.8 * shell.sizes[a][near]).all()


def test_partial_frequencies_are_exact_and_small(spark):
    """A task's part of the frequency table takes room for what its texts have, not for every cell."""
    rng, size = random.Random(21), 1 << 16
    docs = [(i, prose(rng, 60)) for i in range(40)] + [(40, None), (41, "the " * 400)]
    docs += [(42 + i, docs[0][1]) for i in range(300)]  # counts above a byte
    rows = jaccard_join.described(frame(spark, docs), 5, size).where("part is not null").localCheckpoint()
    hashes = jaccard_join.Sets(pa.array([t for _, t in docs], pa.string()), 5).hashes
    want = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size)
    assert want.max() > 300
    assert (jaccard_join.frequencies(rows, size) == want).all()
    per_task = sum(len(r.cells) for r in rows.collect()) / (rows.count() / jaccard_join.PARTS)
    assert per_task < size // 4


def test_planes_keep_large_counts():
    counts = np.array([0, 1, 255, 256, 65535, 65536, 2**32 - 1], np.uint32)
    assert (jaccard_join.from_planes(jaccard_join.planes(counts).tobytes()) == counts).all()


def test_prefix_tuples_carry_little(spark):
    """With as many buckets as prefix shingles, a shingle takes its hash, its document's key and little more."""
    rng = random.Random(22)
    docs = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(104))) for i in range(300)]
    cells = spark.sparkContext.broadcast(np.ones(1 << 16, np.uint32))
    rows = jaccard_join.prefix_tuples(frame(spark, docs).coalesce(1), 5, 80, cells, 64).collect()
    tokens = 300 * 21  # of 100 shingles each
    sent = sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray)))
    assert sent < 20 * tokens
    members = [jaccard_join.Members([r.asDict()]) for r in rows]
    assert sum(len(m.token) + len(m.single[0]) for m in members) == tokens


def test_tokens_packed():
    tokens = np.array([0, 1, 255, 2**16, 2**48 - 1], np.uint64)
    data = jaccard_join.packed(tokens)
    assert len(data) == 6 * len(tokens)
    assert (jaccard_join.unpacked(data) == tokens).all()


def test_marked_ids(spark):
    """Every id of a pair is marked, and few of the others are."""
    ids = [0, -1, 5, 2**62, *range(1000, 3000)]
    pairs = spark.createDataFrame([(a, a + 1) for a in ids], "a long, b long")
    bits = jaccard_join.marked(pairs)
    asked = spark.createDataFrame([(i,) for i in [*ids, *range(10**6, 10**6 + 4000)]], "id long")
    cells = [r[0] for r in asked.selectExpr(f"pmod(xxhash64(id), {8 * len(bits)})").collect()]
    hit = [bool(bits[c >> 3] >> (c & 7) & 1) for c in cells]
    assert all(hit[: len(ids)])
    assert sum(hit[len(ids) :]) < 400
    assert not jaccard_join.marked(pairs.limit(0)).any()


def test_verified_leaves_other_texts_behind(spark):
    rng = random.Random(23)
    text = prose(rng, 60)
    docs = [(1, text), (2, text + " end"), (3, prose(rng, 60)), (None, text)] + [(i, prose(rng, 40)) for i in range(10, 210)]
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    done = jaccard_join.verified(frame(spark, docs), pairs, 5, 80)
    assert [tuple(r) for r in done.collect()] == [(1, 2)]
    assert jaccard_join.wanted_texts(frame(spark, docs), pairs).count() < 30


def python_workers(plan):
    """The most Python workers that a task of a plan has at a time, and those of its last stage."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return python_workers(plan.executedPlan())
    if "QueryStage" in name:
        return python_workers(plan.plan())[0], 0
    below = [python_workers(plan.children().apply(k)) for k in range(plan.children().size())]
    own = 0 if "Exchange" in name else sum(o for _, o in below) + (name == "MapInArrow")
    return max([own, *(m for m, _ in below)]), own


def test_jaccard_tasks_have_one_python_worker(spark, monkeypatch):
    """In the first round of links and in later ones, which have few pairs, however much Spark is willing to broadcast."""
    rng, rounds, verified = random.Random(13), [], jaccard_join.verified

    def watched(*args, **how):
        out = verified(*args, **how)
        rounds.append(python_workers(out._jdf.queryExecution().executedPlan())[0])
        return out

    monkeypatch.setattr(jaccard_join, "verified", watched)
    passage, base = prose(rng, 30), prose(rng, 70).split()
    docs = [f"{passage} {' '.join(base[:k] + [f'x{k}'] + base[k + 1 :])}" for k in range(40)]
    docs = list(enumerate([*docs, *(f"{passage} {prose(rng, rng.randint(1, 20))}" for _ in range(40))]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        got = jaccard_join.similar_documents(frame(spark, docs), paired=16).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(docs)
    assert len(rounds) > 1
    assert set(rounds) == {1}


def near_group(seed: int, members: int, changed: int, copies: int):
    """Rows of one group as ``hub_pairs`` takes them: sets that differ in ``changed`` of 200 hashes from a common one, after ``copies`` that are one component."""
    rng = np.random.default_rng(seed)
    base, sets = rng.integers(0, 2**64, 200, dtype=np.uint64), []
    for k in range(members):
        n = 2 if k < copies else changed
        sets.append(np.sort(np.concatenate([rng.permutation(base)[n:], rng.integers(0, 2**64, n, dtype=np.uint64)])))
    shell = jaccard_join.Sets.__new__(jaccard_join.Sets)
    shell.hashes, shell.begin = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    shell.sizes = np.diff(shell.begin)
    cuts = [jaccard_join._press()(np.frombuffer(shell.sketch(k), np.uint8)) for k in range(members)]
    rows = [(7, 0, 200, 1000 + k, k, k < 4, 0 if k < copies else k, cuts[k]) for k in range(members)]
    return rows, jaccard_join.Sketches(cuts)


HUB_ROWS = "token long, place long, n long, key long, rep long, hub boolean, c long, cuts binary"


def test_hubs_of_a_group_with_few_pairs_take_one_round(spark):
    """A group's members without partners are all hubs at once, in one round with every pair that passes."""
    rows, sketches = near_group(31, 140, 60, copies=40)
    out = jaccard_join.hub_pairs(spark.createDataFrame(rows, HUB_ROWS), 80, 16).collect()
    a, b = np.array([(i, j) for i in range(140) for j in range(140) if max(i, j) >= 40 and i != j]).T
    passing = sketches.share(a, b) >= -(-80 * 400 // 180)
    want = {tuple(sorted(p)) for p in zip(a[passing].tolist(), b[passing].tolist(), strict=True)}
    assert {tuple(sorted((r.a, r.b))) for r in out if r.token is None} == want
    assert not [r for r in out if r.token is not None]


def test_hubs_of_a_group_with_many_pairs_take_turns(spark):
    """Copies that are not yet connected meet few hubs, as links between them are still to come."""
    rows, _ = near_group(32, 140, 3, copies=40)
    out = jaccard_join.hub_pairs(spark.createDataFrame(rows, HUB_ROWS), 80, 8).collect()
    members = [r for r in out if r.token is not None]
    assert sorted(r.rep for r in members) == list(range(140))
    assert all(bytes(r.cuts) == bytes(rows[r.rep][7]) for r in members)
    hubs = {r.rep for r in members if r.hub and r.rep >= 40}
    assert 0 < len(hubs) <= 8
    assert {r.a for r in out if r.token is None} == hubs


def test_hubs_are_those_that_met_the_group(spark):
    """Members at one place come in another order by size than by key, and some are gone; neither makes a hub."""
    rows, _ = near_group(34, 60, 3, copies=60)
    rows = [(*r[:2], 240 - r[4], *r[3:5], 10 <= r[4] < 13, r[7]) for r in rows]
    out = jaccard_join.parted(spark.createDataFrame(rows, HUB_ROWS.replace("c long, ", "")), 80).collect()
    assert {r.rep for r in out if r.hub} == {10, 11, 12}
    assert sorted(r.rep for r in out if r.token is not None) == list(range(60))


def test_unmet_pairs(spark):
    def pairs(*rows):
        return spark.createDataFrame(rows, "a long, b long")

    big = 2**63 - 1
    found = pairs((1, 2), (2, 1), (5, 3), (5, 3), (4, 4), (6, 7), (9, 8), (-big, big))
    assert sorted(map(tuple, jaccard_join.unmet(found).collect())) == [(-big, big), (1, 2), (5, 3), (6, 7), (9, 8)]
    assert sorted(map(tuple, jaccard_join.unmet(found, pairs((7, 6), (9, 8), (0, 1))).collect())) == [(-big, big), (1, 2), (5, 3)]


@pytest.mark.parametrize("shape", ["none", "star", "chain", "random"])
def test_components_end_with_stars(spark, shape):
    """A star needs no round more to tell that it is one."""
    rng = random.Random(33)
    edges = {
        "none": [(3, 3)], "star": [(1, k) for k in range(2, 30)] + [(9, 1)], "chain": [(k + 1, k) for k in range(40)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
    }[shape]
    least = {n: n for e in edges for n in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    stages = Stages(spark, "components")
    got = components(spark.createDataFrame(edges, "a long, b long"), stages).collect()
    assert sorted(map(tuple, got)) == sorted((n, c) for n, c in least.items() if n != c)
    assert stages.count <= {"none": 0, "star": 2}.get(shape, 12)


def test_jaccard_repeated_ids_and_null_ids(spark):
    rng = random.Random(4)
    a, b = prose(rng, 50), prose(rng, 50)
    docs = [(1, a), (1, b), (2, a), (3, b), (None, a), (None, prose(rng, 30)), (9, prose(rng, 30))]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.similar_documents(frame(spark, docs)).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (None, 1), (None, None), (9, 9)], key=str)
    kept = jaccard_join.keep_one(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "source", "start", "item_id"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 1, None, None, 9], key=str)


def test_jaccard_empty(spark):
    assert jaccard_join.similar_documents(frame(spark, [])).count() == 0


# --- repeated strings ----------------------------------------------------------------------


def check_repeats(spark, docs, parts=3):
    got = suffix_dedup.repeat_report(frame(spark, docs).repartition(parts), 50).collect()
    assert sorted(map(tuple, got), key=str) == sorted(repeats(docs), key=str)


def test_repeats(spark):
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (8, 9, 12, 40)] + ["é" * 30, "x" * 120, "ab" * 40]
    docs = []
    for k in range(70):
        parts = [rng.choice(passages) if rng.random() < 0.4 else prose(rng, rng.randint(0, 30)) for _ in range(rng.randint(0, 6))]
        docs.append((k, rng.choice([" ", ""]).join(parts)))
    docs += [(200, docs[5][1]), (201, docs[5][1]), (202, None), (203, ""), (204, passages[3][:49]), (205, passages[3][:50])]
    check_repeats(spark, docs)


def test_repeats_with_null_and_repeated_ids(spark):
    rng = random.Random(12)
    a, b = prose(rng, 30), prose(rng, 30)
    check_repeats(spark, [(None, a), (3, a), (3, a), (3, b + a), (None, b), (7, a + b), (None, a)], 2)
    assert suffix_dedup.repeat_report(frame(spark, []), 50).count() == 0


def test_byte_queue_sorts_and_spills():
    rng = np.random.default_rng(5)
    for n, letters, cap in ((1, 2, 5), (400, 2, 6), (1500, 3, 5)):
        rows = rng.integers(0, letters, (n, 9)).astype(np.uint8)
        order, common = np.arange(n), np.zeros(n, np.uint8)
        for t in range(8, -1, -1):
            queue = suffix_dedup.ByteQueue(cap)
            queue.spill.left = 500  # most runs go to the file
            for low in range(0, n, 97):
                part = order[low : low + 97]
                queue.push(rows[part, t], part, common[low : low + 97])
            pieces = list(queue.pop())
            order, common = np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])
            suffixes = [rows[i, t:].tobytes() for i in order]
            assert suffixes == sorted(suffixes)
            for x, y, c in zip(suffixes, suffixes[1:], common[1:], strict=False):
                same = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
                assert c == min(same, cap)


def test_shards_larger_than_a_push(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PUSH_ITEMS", 64)
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 2, (500, 12)).astype(np.uint8)
    doc = rng.integers(0, 50, 500)
    for t, pieces in suffix_dedup.induced(list(rows.T), lambda c: c, 500, 4):
        least = suffix_dedup.least_documents(pieces, doc, 4)
        if t <= 8:
            want = defaultdict(lambda: 99)
            for r, d in zip(rows, doc, strict=True):
                want[r[t : t + 4].tobytes()] = min(want[r[t : t + 4].tobytes()], d)
            assert least.tolist() == [want[r[t : t + 4].tobytes()] for r in rows]


# --- benchmark windows ---------------------------------------------------------------------


def leak_case():
    rng = random.Random(21)
    few = [a + b for a in "ab" for b in "xyz"] + ["É1", "mid-word", "Cap"]
    items = [(k, prose(rng, n, few)) for k, n in enumerate((1, 2, 3, 9, 10, 11, 30, 60, 0))]
    items += [(100, items[6][1]), (4, "again " + items[4][1]), (101, None), (None, prose(rng, 12, few)), (7, items[7][1])]
    docs = []
    for k in range(80):
        words = prose(rng, rng.randint(0, 60), few).split()
        for _ in range(rng.randint(0, 2)):
            source = benchmark_words(rng.choice(items)[1])
            low = rng.randint(0, len(source))
            words[rng.randint(0, len(words)) :] = [w.upper() for w in source[low : low + rng.choice([9, 10, 14, 99])]] + words[:5]
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(words)))
    return docs + [(300, None), (301, ""), (302, "... --"), (5, docs[5][1])], items


@pytest.mark.parametrize("window", [3, 10])
def test_window_sql_equals_the_plain_version(window):
    import duckdb
    import pandas as pd

    docs, items = leak_case()
    con = duckdb.connect()
    documents = pd.DataFrame(docs, columns=["doc_id", "text"])
    benchmark = pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"})
    con.register("d", documents)
    con.register("b", benchmark)
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text FROM d")
    con.execute("CREATE TABLE benchmark AS SELECT item_id::BIGINT AS item_id, text FROM b")
    assert sorted(con.execute(decontaminate.window_sql(window)).fetchall()) == sorted(contamination(docs, items, window))



@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_contamination(spark, block_bytes):
    docs, items = leak_case()
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long")
    got = decontaminate.contamination(frame(spark, docs), bench, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == sorted(contamination(docs, items))
    kept = decontaminate.clean(frame(spark, docs), bench, block_bytes=block_bytes)
    assert kept.columns == ["doc_id", "text", "source", "start", "item_id"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in contamination(docs, items) if not r[5])


def test_contamination_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate.contamination(frame(spark, [(1, "a b")]), bench).collect()] == [(1, 2, 0, 0)]
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0


# --- packing -------------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [7, 64])
def test_packing(spark, capacity):
    rng = random.Random(capacity)
    tokenizer = Tokenizer.from_file(word_tokenizer())
    docs = [(k, prose(rng, rng.choice([0, 1, 3, 20, 90]))) for k in range(120)] + [(500, None), (500, ""), (None, "no id"), (3, "again")]
    rows = packing.pack(frame(spark, docs).repartition(5), word_tokenizer(), capacity, with_ids=True).collect()
    want = sorted((str(i), tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in docs)
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[str(r.doc_id)].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) <= capacity
        assert r.start == r.piece * capacity
    got = []
    for i, own in by_doc.items():
        if i in ("500", "3"):  # several rows
            got += [(i, x.ids) for x in own] if i == "500" else []
            continue
        got.append((i, [x for r in sorted(own, key=lambda r: r.piece) for x in r.ids]))
    assert sorted(got) == [w for w in want if w[0] != "3"]
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == best_fit([r.length for r in rows], capacity)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([5, 10, 50])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        rooms = defaultdict(lambda: capacity)
        plan = packing.best_fit_plan({n: lengths.count(n) for n in set(lengths)}, capacity)
        total = defaultdict(int)
        for (n, rank, first, per, _), after in zip(plan, [*plan[1:], None], strict=True):
            stop = after[1] if after and after[0] == n else lengths.count(n)
            for q in range(stop - rank):
                rooms[first + q // per] -= n
                total[n] += 1
        assert sorted(rooms.values()) == best_fit(lengths, capacity)


def most_traced(run, column):
    """MB that a task's function held at most over one batch of these texts, besides its input."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(column))), column], ["doc_id", "text"])
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in run(iter([batch])))
        return n, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_task_follows_the_slice_not_the_batch(spark, monkeypatch):
    rng = random.Random(31)
    texts = [prose(rng, 300) for _ in range(200)]
    column = pa.array([texts[k % 200] for k in range(3200)])  # 8 MB
    windows = decontaminate.item_windows([(1, texts[0][:200]), (2, prose(rng, 30))], 10, 3)
    index = SimpleNamespace(value=(windows, decontaminate.prefixes(windows, decontaminate.all_tokens(windows), {})))
    n, mb = most_traced(decontaminate._marker(index, True), column)
    assert n == 3200
    assert mb < 20

    made = []
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    docs = SimpleNamespace(select=lambda *_: docs, schema=frame(spark, []).schema, mapInArrow=lambda run, _: made.append(run))
    packing.pieces(docs, word_tokenizer())
    n, mb = most_traced(made[0], column)
    assert n == 3200
    assert mb < 20


def test_packing_nothing(spark):
    assert packing.pack(frame(spark, []), word_tokenizer()).count() == 0
