import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from moorage.llm.mixing import Mixer, Permutation, cut_words, water_fill

ROWS = [(i, " ".join(["w"] * (i % 37)), ["b", "a", None, "c", "b", "b"][i % 6]) for i in range(600)] + [(7, "x y", "b"), (7, "x y", "b"), (None, "x y z", "a"), (900, None, "d"), (901, "", "d")]


def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        assert sorted(Permutation(n, "5").at(np.arange(n))) == list(range(n))
    assert list(Permutation(1000, "5").at(np.arange(1000))) != list(Permutation(1000, "6").at(np.arange(1000)))


def test_water_fill():
    got = water_fill({"a": 10, "b": 100, "c": 1000, "d": 0}, {"a": 3, "b": 1, "c": 2, "d": 3}, 1665, 2)
    assert got["a"] == 20 and got["d"] == 0 and got["b"] == 200 and got["c"] == 1445


def test_report(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, size int")
    mixer = Mixer(block=4, shard=50)
    got = sorted(map(tuple, mixer.report(df.repartition(5)).collect()), key=str)
    assert got == sorted(map(tuple, mixer.report(df.coalesce(1)).collect()), key=str)
    assert len(got) == len(ROWS)
    sizes = {s: sum(len((t or "").split()) for _, t, x in ROWS if x == s) for s in "abcd"} | {None: sum(len(t.split()) for _, t, x in ROWS if x is None)}
    assert {r[2] for r in got} == set(sizes.values())
    taken, target = {}, {}
    for _, size, total, t, n in got:
        assert 0 <= n <= 2 * size
        taken[total], target[total] = taken.get(total, 0) + n, t
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6
    for total, t in target.items():
        assert abs(taken[total] - t) <= 0.5


def test_mixed(spark):
    df = spark.createDataFrame([(i, " ".join(f"{i}.{j}" for j in range(30)), "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string")
    mixer = Mixer(block=8)
    taken = {r.doc_id: r.taken for r in mixer.report(df).collect()}
    words = {}
    for r in mixer.mixed(df).collect():
        found = re.findall(r"\S+", r.text)
        assert all(w.startswith(f"{r.doc_id}.") for w in found) and len(set(found)) == len(found)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(found)
    assert words == {k: v for k, v in taken.items() if v}


def test_cut_words():
    assert cut_words(" a  b\tc d ", [(1, 1), (2, 1)], 4) == "b\tc"
    assert cut_words(" a  b\tc d ", [(0, 1), (3, 1)], 4) == "a\nd"


def test_no_rows(spark):
    assert Mixer().report(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_mixed_null_and_repeated_ids(spark):
    ids = [None if i % 3 == 0 else 7 if i % 3 == 1 else i for i in range(60)]
    rows = [(d, " ".join(f"{i}.{j}" for j in range(30)), "ab"[i % 2]) for i, d in enumerate(ids)]
    mixer = Mixer(cycle=(1.0,), block=8)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixer.mixed(df.repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixer.mixed(df.coalesce(1)).collect()), key=str)
    seen = {}
    for r in got:
        owners = {int(w.split(".")[0]) for w in r.text.split()}
        assert len(owners) == 1 and ids[min(owners)] == r.doc_id
        seen[min(owners)] = seen.get(min(owners), 0) + len(r.text.split())
    assert set(seen) == set(range(60)) and sum(seen.values()) == sum(r.taken for r in mixer.report(df).collect())


def test_inverse_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        p = Permutation(n, "k")
        for v in {0, n // 2, n - 1}:
            assert p.at(np.array([p.where(v)]))[0] == v


def test_against_brute_force(spark):
    """Documents end to end by chunk and hash, blocks dealt in the permuted order until the target is met."""
    rows = [*ROWS, (910, "tiny source", "e"), (911, " ".join(["w"] * 500), "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixer = Mixer(block=4, shard=50)
    hashed = df.select("doc_id", "text", "source", F.xxhash64("text").alias("th")).withColumn("h", F.xxhash64(F.lit(mixer.seed), "doc_id", "th")).collect()
    by_source, sizes = {}, {}
    for r in hashed:
        by_source.setdefault(r.source, []).append(r)
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = water_fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    want = []
    for source, docs in by_source.items():
        chunks = math.ceil(math.sqrt(len(docs)))
        docs.sort(key=lambda r: (r.h % chunks, r.h, str(r.doc_id), r.th))
        words = [i for i, r in enumerate(docs) for _ in (r.text or "").split()]
        blocks = [words[a : a + 4] for a in range(0, len(words), 4)]
        owed, taken, round_ = round(targets[source]), Counter(), 0
        while owed:
            perm = mixer.order("" if source is None else f"={source}", len(blocks), round_).at(np.arange(len(blocks)))
            for b in perm:
                some = blocks[b][:owed]
                taken.update(some)
                owed -= len(some)
            round_ += 1
        want += [(r.doc_id, len((r.text or "").split()), sizes[source], targets[source], taken[i]) for i, r in enumerate(docs)]
    got = list(map(tuple, mixer.report(df.repartition(3)).collect()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_packed(spark):
    df = spark.createDataFrame([(i, " ".join(f"{i}.{j}" for j in range(3 + i % 30)), "abc"[i % 3] if i % 7 else None, "x", 1) for i in range(60)], "doc_id long, text string, source string, takes string, _row int")
    mixer = Mixer(block=8, shard=10)
    packed = mixer.packed(df).collect()
    taken = {r.doc_id: r.taken for r in mixer.report(df).collect()}
    words = Counter(int(w.split(".")[0]) for r in packed for w in r.text.split())
    assert words == Counter({k: v for k, v in taken.items() if v})
    assert len({(r.source, r.slot) for r in packed}) == len(packed) and all(r.n == len(r.text.split()) <= 8 for r in packed)
    source = {r.doc_id: r.source for r in df.collect()}
    assert all(source[int(w.split(".")[0])] == r.source for r in packed for w in r.text.split())
    shards = Counter(r.shard for r in packed)
    assert all(shards[s] == 10 for s in range(max(shards)))
    assert mixer.mixed(df).columns == df.columns


def test_slots_are_not_broadcast(spark):
    df = spark.createDataFrame([(i, " ".join(f"{i}.{j}" for j in range(30)), "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string")
    mixer, session = Mixer(block=8), spark.newSession()
    # Spark may broadcast what it takes for small, and a mix's slots are many more than the draws it judges them by
    session.conf.set("spark.sql.adaptive.enabled", "true")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    df = session.createDataFrame(df.collect(), df.schema)
    sized = mixer.sized(df, "doc_id", "text", "source")
    for out in (mixer.mixed(df), mixer.taken(sized, mixer.plans(sized)), mixer.packed(df)):
        assert out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin) \[(\w+)#\d+L?(?:, (\w+)#)?", plan.partition("Initial Plan")[0])
        assert ("SortMergeJoin", "src", "block") in joins and ("BroadcastHashJoin", "src", "block") not in joins
        assert not [j for j in joins if j[0] == "BroadcastHashJoin" and j[1] in ("uid", "row", "_row")]
