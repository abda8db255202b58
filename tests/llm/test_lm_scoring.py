import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from moorage.llm.lm_scoring import ContextTreeScorer, log_gamma, thick, thick_keys, thin, thin_keys

D = 3


def tokens(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() + [b"\n"]


def bits(token):
    """(context, decision, bit) of every binary decision, the latest byte first in a context."""
    flat = b" " * D + (token if token == b"\n" else token + b" ")
    for i in range(D, len(flat)):
        context = flat[i - D : i][::-1]
        for k in range(8):
            yield context, (1 << k) | (flat[i] >> (8 - k)), flat[i] >> (7 - k) & 1


def brute(rows):
    train = [t for _, text, held in rows if not held for t in tokens(text)]
    unigram = Counter(train)
    n, v = len(train), len(unigram)
    count = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    for t in train:
        for c, j, b in bits(t):
            for d in range(D + 1):
                count[c[:d], j][b] += 1
                if d:
                    children[c[: d - 1], j].add((c[:d], j))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def pw(node):
        if node not in memo:
            own = kt(*count[node])
            memo[node] = own if len(node[0]) == D else np.logaddexp(math.log(0.5) + own, math.log(0.5) + sum(map(pw, children[node])))
        return memo[node]

    def p(c, j, b, d=0):
        node = (c[:d], j)
        if node not in count:
            return None
        own = (count[node][b] + 0.5) / (sum(count[node]) + 1)
        below = p(c, j, b, d + 1) if d < D else None
        if below is None:
            return own
        w = math.exp(math.log(0.5) + kt(*count[node]) - pw(node))
        return w * own + (1 - w) * below

    out = []
    for d, text, held in rows:
        ts = tokens(text)
        base = sum(math.log10((unigram[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        out.append((d, held, len(ts), sum(unigram[t] > 0 for t in ts), n, base, sum(math.log10(p(*x) or 0.5) for t in ts for x in bits(t))))
    return out


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert tuple(g[:5]) == w[:5] and abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 1e-6, (g, w)


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abAé") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(12))), i % 4 == 0) for i in range(60)]
    rows += [(70, None, False), (71, "", True), (72, "zzz new\u001fword", True), (5, rows[5][1], False), (None, "null id", False), (73, "x" * 3000, True)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, held_out boolean, score double").repartition(3)
    for scorer in (ContextTreeScorer(depth=D), ContextTreeScorer(depth=D, chunk_bytes=60)):
        close([tuple(r) for r in scorer.score(df).collect()], brute(rows))
    nothing = df.where("held_out")
    close([tuple(r) for r in ContextTreeScorer(depth=D).score(nothing).collect()], brute([r for r in rows if r[2]]))
    assert ContextTreeScorer().score(df.limit(0)).count() == 0
    assert ContextTreeScorer().score(df.withColumn("held_out", F.lit(None).cast("boolean"))).where("held_out").count() == 0


def test_log_gamma():
    x = np.r_[np.arange(0.5, 40, 0.5), 1e3, 1e6]
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


class After(bytes):
    """A token with the bytes before it."""

    before = b" " * D


def in_stream(text, split=tokens):
    out, before = [], b" " * D
    for t in map(After, split(text)):
        t.before = before
        out.append(t)
        before = (before + t + b" ")[-D:]
    return out


def bits_after(token):
    flat = token.before + (token if token == b"\n" else token + b" ")
    for i in range(D, len(flat)):
        for k in range(8):
            yield flat[i - D : i][::-1], (1 << k) | (flat[i] >> (8 - k)), flat[i] >> (7 - k) & 1


def test_contexts_over_words_against_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choice("abAé") for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(12))), i % 4 == 0) for i in range(60)]
    rows += [(70, None, False), (71, "", True), (72, " zzz  new\u001fword\n", True), (5, rows[5][1], False), (None, "null id", False), (73, "x" * 3000, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    monkeypatch.setitem(globals(), "tokens", in_stream)
    monkeypatch.setitem(globals(), "bits", bits_after)
    for scorer in (ContextTreeScorer(depth=D, whole=True), ContextTreeScorer(depth=D, chunk_bytes=60, whole=True), ContextTreeScorer(depth=D, chunk_bytes=60, whole=True, part_chunks=2, salt_bytes=400, fan=2)):
        close([tuple(r) for r in scorer.score(df).collect()], brute(rows))


def test_order_of_words_counts(spark, tmp_path):
    text = "the cat sat on the mat and then ran to his den"
    rows = [(i, text) for i in range(60)] + [(100 + i, " ".join(sorted(text.split()))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    from moorage.llm.lm_scoring import op10_lm_scoring

    got = op10_lm_scoring(spark, str(tmp_path)).collect()
    fluent, salad = ({round(r.score, 6) for r in got if (r.doc_id < 100) == first} for first in (True, False))
    assert len(fluent) == len(salad) == 1 and fluent != salad


def test_arrays_keep_their_values():
    rng = np.random.default_rng(1)
    for a in (rng.integers(0, 1 << 62, 50).astype(np.uint64), rng.normal(size=7), np.zeros(0, np.int64), rng.integers(-9, 9, 3).astype(np.int32)):
        assert (thick(thin(a), a.dtype) == a).all() and len(thick(thin(a), a.dtype)) == len(a)
    keys = np.sort(rng.integers(0, 1 << 63, 100).astype(np.uint64) * np.uint64(2))
    assert (thick_keys(thin_keys(keys)) == keys).all() and len(thick_keys(thin_keys(keys[:0]))) == 0
