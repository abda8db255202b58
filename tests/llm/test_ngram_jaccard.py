import random

from moorage.llm.ngram_jaccard import JaccardJoin


def brute(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
        sets.append(set() if not w else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)})
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                inter = len(sets[i] & sets[j])
                if den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
                    up[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 30, 120, 400]))]
        if rng.random() < 0.4:
            base[len(base) // 2 : 0] = passage
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 4, 9])):
            near = list(base)
            for _ in range(rng.choice([0, 1, len(base) // 60, len(base) // 25])):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(near)
    hub = [rng.choice(vocabulary) for _ in range(90)]
    for _ in range(70):
        near = list(hub)
        for _ in range(rng.choice([1, 2, 3])):
            near[rng.randrange(90)] = rng.choice(vocabulary)
        texts.append(near)
    rows = [(i * 3 + 1, " ".join(t).upper() if rng.random() < 0.1 else "  ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(100_000, None), (100_001, ""), (100_002, " \n\t"), (None, rows[0][1]), rows[1], (rows[2][0], "another text under a known id"), (100_003, "one"), (100_004, "ONE"), (100_005, "a\x1fb c"), (100_006, "word " * 9000)]


def test_matches_brute_force(spark):
    for seed, join in ((1, JaccardJoin()), (2, JaccardJoin(k=5, num=80, den=100, small=4, tile=16, common=50))):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = sorted((tuple(r) for r in join.groups(df).collect()), key=str)
        assert got == brute(rows, join.k, join.num, join.den)


def test_no_rows(spark):
    assert JaccardJoin().groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
