import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from nivalis.llm import blocks, ngram_join, pitman_yor, sharding
from nivalis.llm.common import scratch
from nivalis.llm.components import components

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "doc_id long, text string, name string, tie int, n_links int, block int"


def wide(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, 2, 3) for r in rows], EXTRA)


# ---- similarity join


def grams(text):
    words = WORD.findall(text or "")
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute_classes(rows):
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in link[i])]) for i in range(n)]
    low = lambda i: (rows[i][0] is not None, rows[i][0] or 0)
    heads = {x: min((i for i in range(n) if label[i] == x), key=low) for x in set(label)}
    return sorted(str((rows[i][0], rows[heads[label[i]]][0], len(link[i]))) for i in range(n))


def near_corpus():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    base = [rnd.choice(words) for _ in range(120)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 150)))) for i in range(60)]
    for i in range(100, 170):
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        rows.append((i, " ".join(copy)))
    rows += [(300 + i, " ".join(base)) for i in range(5)]
    return rows + [(400, None), (401, ""), (402, " \n "), (403, "a b"), (404, "a  b\n"), (405, "a b c d e"), (None, "a b c d e"), (100, rows[3][1]), (406, "z " * 3000), (406, "z " * 3000)]


@pytest.mark.parametrize("block", [512, 16])
def test_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_corpus()
    got = sorted(str((r.doc_id, r.class_id, r.n_links)) for r in ngram_join.near_duplicates(wide(spark, rows)).collect())
    assert got == brute_classes(rows)


def test_keep_first_keeps_one_of_each_class(spark):
    rows = near_corpus()
    df = wide(spark, rows)
    out = ngram_join.keep_first(df)
    assert out.schema == df.schema
    classes = {s.split(", ")[1] for s in brute_classes(rows)}
    assert out.count() == len(classes)


def test_a_long_chain_costs_its_links(spark):
    # each text shares 0.82 of its 5-grams with the next and under 0.7 with the one after that
    words = [f"w{i}" for i in range(20_000)]
    rows = [(i, " ".join(words[i * 10 : i * 10 + 104])) for i in range(1500)]
    got = ngram_join.near_duplicates(wide(spark, rows)).collect()
    assert {r.class_id for r in got} == {0}
    assert sorted(r.n_links for r in got) == [1, 1] + [2] * 1498


def test_chains_below_the_threshold_stay_apart(spark):
    words = [f"w{i}" for i in range(20_000)]
    rows = [(i, " ".join(words[i * 18 : i * 18 + 104])) for i in range(1000)]  # 82 of 118: 0.69
    got = ngram_join.near_duplicates(wide(spark, rows)).collect()
    assert all((r.class_id, r.n_links) == (r.doc_id, 0) for r in got)


def test_join_empty(spark):
    df = wide(spark, [(1, "a")]).where("false")
    assert ngram_join.near_duplicates(df).collect() == [] and ngram_join.keep_first(df).collect() == []


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(60)] + [(500, 500)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.label for r in components(df).collect()} == label
    assert components(df.where("false")).collect() == []


def test_pruning_keeps_true_pairs():
    fewest = ngram_join.fewest_matches()
    assert (np.diff(fewest) >= 0).all() and 60 < fewest[-1] < 125
    rng = np.random.default_rng(1)
    for _ in range(200):  # pairs at the threshold must pass every step
        agree = np.cumsum(rng.random(160) < 0.8)[15::16]
        assert (agree >= fewest).all()


# ---- language model


def scored(spark, rows, by_token=False):
    df = wide(spark, rows)
    texts = pitman_yor.id_and_text(df)
    return pitman_yor.score(texts.withColumn("fold", (pitman_yor.remainder(pitman_yor.F.col("doc_id"), 5) == 1).cast("int")), by_token).collect()


def brute_base(rows):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = [(i, [*WORD.findall((t or "").translate(up)), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, ws in own for w in ws if not held(i))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in own]


def test_lm_base_and_model(spark):
    rnd = random.Random(6)
    a, b = [f"la{i}" for i in range(40)], [f"un{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choice(a if i % 2 else b).upper() if i % 7 == 0 else rnd.choice(a if i % 2 else b) for _ in range(rnd.randint(1, 60)))) for i in range(150)]
    rows += [(None, "x y"), (3, None), (200, ""), (201, "É é İ"), (201, "É é İ"), (202, "long " * 30_000)]
    got = scored(spark, rows)
    assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got) == sorted(map(str, brute_base(rows)))
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= 1e-6 for r in got)


def held_ids(n):
    return [i for i in range(100_000, 100_000 + 10 * n) if zlib.crc32(str(i).encode()) % 5 == 1][:n]


@pytest.mark.parametrize("block", [16 << 20, 600])
def test_lm_is_a_distribution(spark, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "PAGE_BYTES", block // 4)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(rnd.choice(words[: rnd.randint(1, 12)]) for _ in range(rnd.randint(0, 30)))) for i in range(120)]
    known = sorted({w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in t.split()})
    contexts = ["", "w0", "w5", "unseen"]
    asked = [(c, w) for c in contexts for w in [*known, "unknown", None]]
    texts = [" ".join(x for x in pair if x) for pair in asked]
    got = {r.doc_id: r.logs for r in scored(spark, rows + list(zip(held_ids(len(asked)), texts)), by_token=True)}
    total = Counter()
    for i, (c, w) in zip(held_ids(len(asked)), asked):
        total[c] += 10 ** got[i][1 if c else 0]
    assert all(abs(total[c] - 1) < 1e-9 for c in contexts)


def test_lm_does_not_depend_on_the_dealing(spark, monkeypatch):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[min(int(rnd.expovariate(0.1)), 59)] for _ in range(rnd.randint(1, 80)))) for i in range(150)]
    found = []
    for block, partitions in ((16 << 20, "4"), (3000, "7"), (900, "3")):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
        monkeypatch.setattr(blocks, "PAGE_BYTES", block // 3)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append({r.doc_id: (r.score, r.base_score) for r in scored(spark, rows)})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for other in found[1:]:
        assert all(other[i] == pytest.approx(found[0][i], abs=1e-9) for i in found[0])


def test_lm_without_training(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = scored(spark, [(held, "a b")])
    assert (row.train_tokens, row.n_known, row.base_score) == (0, 0, 0.0) and abs(row.score) < 1e-6
    assert pitman_yor.score(pitman_yor.id_and_text(wide(spark, [(1, "a")]).where("false")).withColumn("fold", pitman_yor.F.lit(0))).collect() == []


def test_lm_contexts_are_whole_words(spark):
    # both contexts end in the same three bytes, but only one is followed by b
    rows = [(i, "breathe b" if i % 2 else "the a") for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    got = {r.doc_id: r.score for r in scored(spark, [*rows, (held[0], "the a"), (held[1], "the b")])}
    assert got[held[0]] > -0.5 and got[held[1]] < got[held[0]] - 1.5


def seatings(n, discount):
    """The weight of all seatings of n customers by their tables, from every table each could take."""
    states = Counter({(): 1.0})
    for _ in range(n):
        after = Counter()
        for sizes, weight in states.items():
            after[tuple(sorted((*sizes, 1)))] += weight
            for k, size in enumerate(sizes):
                after[tuple(sorted((*sizes[:k], size + 1, *sizes[k + 1 :])))] += weight * (size - discount)
        states = after
    return states


def test_chance_to_sit_alone_matches_all_seatings():
    states = seatings(7, 0.4)
    for tables in range(1, 8):
        own = {s: w for s, w in states.items() if len(s) == tables}
        want = sum(w * sum(x == 1 for x in s) / 7 for s, w in own.items()) / sum(own.values())
        assert pitman_yor.alone(np.array([7]), np.array([tables]), 0.4)[0] == pytest.approx(want)


def test_sweeps_reach_the_posterior():
    # one dish with six customers and a fresh table's weight of (strength + discount * tables) * base
    n, discount, base, many = 6, 0.4, 0.3, 40_000
    weight = Counter()
    for sizes, w in seatings(n, discount).items():
        fresh = np.prod([(pitman_yor.STRENGTH + discount * k) * base for k in range(len(sizes))])
        weight[len(sizes)] += w * fresh
    want = np.array([weight[t] for t in range(1, n + 1)]) / sum(weight.values())
    customers, keys = np.full(many, n), pitman_yor.mix(np.arange(many, dtype=np.uint64))
    tables = pitman_yor.seat(customers, np.full(many, base), discount, keys, 0)
    for i in range(12):
        tables = pitman_yor.reseat(customers, tables, tables, base, discount, keys, 1 + i)
    got = np.bincount(tables, minlength=n + 1)[1:] / many
    assert np.abs(got - want).max() < 0.015


def test_a_sweep_visits_all_customers():
    """One sweep over 1,000 customers of one table opens as many tables as taking them one by one."""
    n, many, discount, base, total = 1000, 2000, 0.7, 0.02, 5000.0
    keys = pitman_yor.mix(np.arange(many, dtype=np.uint64))
    got = pitman_yor.reseat(np.full(many, n), np.ones(many, np.int64), np.full(many, total), base, discount, keys, 1)
    rng, want = np.random.default_rng(1), np.ones(300)
    for _ in range(n):
        want -= rng.random(300) < pitman_yor.alone(np.full(300, n), want.astype(int), discount)
        fresh = (pitman_yor.STRENGTH + discount * (total + want - 1)) * base
        want += rng.random(300) < fresh / (fresh + n - 1 - discount * want)
    assert got.mean() == pytest.approx(want.mean(), rel=0.05) and got.std() == pytest.approx(want.std(), rel=0.25)
    assert got.min() >= 1 and got.max() <= n


def test_seating():
    keys = np.arange(4, dtype=np.uint64)
    tables = pitman_yor.seat(np.array([0, 1, 5, 5000]), np.full(4, 0.5), 0.5, keys, 0)
    assert tables[0] == 0 and tables[1] == 1 and 1 <= tables[2] <= 5 and 3 < tables[3] < 60


# ---- shards


def test_shards_hold_all_rows_and_grow(spark):
    rows = [(i, "text %d " % i * 20, "n", 1, 2, 3) for i in range(400)] + [(None, None, None, None, None, None), (5, "x", "n", 1, 2, 3), (5, "x", "n", 1, 2, 3)]
    df = spark.createDataFrame(rows, EXTRA)
    shards = sharding.shard_arrivals(df, scratch(spark), 3, small=6000, target=30_000)
    listed = shards.shards()
    assert sum(s.rows for s in listed) == len(rows)
    assert not shards.merges(listed)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, shards.read().select(df.columns).collect())) == sorted(map(key, df.collect()))
    placed = shards.placed()
    assert placed.groupBy("shard").count().count() == len(listed) and placed.count() == len(rows)


def test_merges_are_those_of_a_plain_replay():
    shards = sharding.ShardSet.__new__(sharding.ShardSet)
    shards.small, shards.target, shards.fanout = 10, 640, 4
    rnd = random.Random(2)
    held: list[int] = []
    written = arrived = 0
    for turn in range(3000):
        held.append(rnd.choice([1, 3, 9, 20, 50, 200]))
        arrived += held[-1]
        while groups := shards.merges([sharding.Shard(str(i), b, 1) for i, b in enumerate(held)]):
            for group in groups:
                assert len({shards.tier(s) for s in group}) == 1  # like sizes only
                assert sum(s.bytes for s in group[:-1]) < 640  # no more than it takes
            gone = {int(s.path) for group in groups for s in group}
            new = [sum(s.bytes for s in group) for group in groups]
            written += sum(new)
            held = [b for i, b in enumerate(held) if i not in gone] + new
    done = [b for b in held if b >= 0.8 * 640]
    assert sum(held) == arrived and max(held) < 2 * 640
    assert len(held) - len(done) <= 3 * 4 and sum(done) > 0.95 * arrived
    assert written < 5 * arrived


def test_many_tiny_arrivals_become_one_file(spark):
    shards = sharding.ShardSet(spark, scratch(spark))
    row = wide(spark, [(1, "a")]).coalesce(1)
    for _ in range(12):
        shards.append(row)
        shards.compact()
        assert len(shards.shards()) < 4
    shards.compact(everything=True)
    assert [s.rows for s in shards.shards()] == [12] and shards.tier(shards.shards()[0]) == 0


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = wide(spark, [(7, "a")] * 2).limit(n)
    shards = sharding.shard_arrivals(rows, scratch(spark))
    assert shards.version() >= 4 and shards.read().columns == rows.columns
    assert [(r.doc_id, r.text) for r in shards.placed().collect()] == [(7, "a")] * n


def test_commits_are_exclusive(spark):
    shards = sharding.ShardSet(spark, scratch(spark), small=1000, target=4000)
    rows = wide(spark, [(1, "a"), (2, "b")])
    assert shards.append(rows) == 1
    assert shards.append(rows.where("false")) == 2
    with pytest.raises(RuntimeError):
        shards.commit([], 1)
    with pytest.raises(ValueError):
        shards.append(rows.drop("name"))
    old = shards.read(1)
    shards.append(rows)
    assert old.count() == 2 and shards.read().count() == 4


def test_clean_spares_readers_and_writers(spark):
    root = scratch(spark)
    shards = sharding.ShardSet(spark, root)
    rows = wide(spark, [(i, "a") for i in range(8)]).coalesce(1)
    for _ in range(4):
        shards.append(rows)
    folder = f"{root}/data/of-another-writer"
    rows.write.parquet(folder)
    shards.compact()
    other = sharding.ShardSet(spark, root)
    other.clean(keep=2, grace_s=3600)
    assert shards.read(1).count() == 8  # still within the grace period
    other.clean(keep=2, grace_s=0)
    assert shards.read(4).count() == 32 and shards.read().count() == 32
    assert shards.commit(shards.shards() + shards._files(folder, rows.schema), shards.version()) == 6
    assert shards.read().count() == 40
    other.clean(keep=1, grace_s=0)
    assert shards.versions() == [6] and shards.read().count() == 40


def test_an_arrival_that_is_outrun_is_committed_without_writing_it_again(spark, monkeypatch):
    root = scratch(spark)
    one, two = sharding.ShardSet(spark, root), sharding.ShardSet(spark, root)
    rows = wide(spark, [(i, "a") for i in range(6)]).coalesce(1)
    find, turns = one._files, []

    def outrun(folder, schema):
        turns.append(folder)
        two.append(rows.limit(1))
        return find(folder, schema)

    monkeypatch.setattr(one, "_files", outrun)
    monkeypatch.setattr(one, "version", lambda real=one.version, seen=[]: seen.append(1) or (0 if len(seen) < 3 else real()))  # noqa: B006
    assert one.append(rows) == 2
    assert len(turns) == 1 and two.read().count() == 7


def test_a_merge_that_is_outrun_is_dropped_and_done_again(spark, monkeypatch):
    root = scratch(spark)
    one, two = sharding.ShardSet(spark, root), sharding.ShardSet(spark, root)
    rows = wide(spark, [(i, "a") for i in range(6)]).coalesce(1)
    for _ in range(4):
        one.append(rows)
    find, done = one._files, []

    def outrun(folder, schema):
        if not done:
            done.append(folder)
            two.append(rows)
        return find(folder, schema)

    monkeypatch.setattr(one, "_files", outrun)
    one.compact()
    assert two.read().count() == 30 and sum(s.rows for s in two.shards()) == 30
    assert not one._fs.exists(one._path(done[0]))


def test_folders_of_dead_writers_go(spark):
    root = scratch(spark)
    shards = sharding.ShardSet(spark, root)
    rows = wide(spark, [(1, "a")]).coalesce(1)
    shards.append(rows)
    rows.write.parquet(f"{root}/data/dead")
    shards.clean(orphan_s=3600)
    assert shards._fs.exists(shards._path(f"{root}/data/dead"))
    shards.clean(orphan_s=-10)
    assert not shards._fs.exists(shards._path(f"{root}/data/dead"))
    assert shards.read().count() == 1
