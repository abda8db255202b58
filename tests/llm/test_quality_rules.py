import math
import random
import re

import pytest

from moorage.llm.quality_rules import COUNTS, RATIOS, Limits, counts_of, judge, with_counts

CASES = [None, "", " \n\t", "one", "a b c d e a b c d e", "x y\nx y\n\nx y\n z", "é# %ü\x1f<|> A\x0bB", "w " * 3000, "a\u00a0b c\u2028d", "B B B b", "L1\r\nL1\r\nl1"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)} if len(words) < 400 else set(range(len(words)))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked)


@pytest.mark.parametrize("text", CASES)
def test_counts(text):
    assert counts_of(text)[:5] == brute(text)


def test_counts_of_random_texts():
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b", " ", "\n", "é", "#", "  "]) for _ in range(rng.randrange(120)))
        assert counts_of(t)[:5] == brute(t)


def prose(rng, n=60):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_judge(spark):
    rng = random.Random(4)
    clean = [(i, prose(rng), "xy"[i % 2], ["s", "t", None][i % 3]) for i in range(300)]
    junk = [(1000 + i, prose(rng).replace(" ", "%%% "), "x", "s") for i in range(10)] + [(1100 + i, prose(rng).upper(), "y", "t") for i in range(10)]
    odd = [(2000, None, "x", "s"), (2001, "", None, None), (2002, "few words", "x", "t"), (2003, "same again " * 40, "x", "t"), (5, clean[5][1], clean[5][2], clean[5][3]), (None, prose(rng), "x", "s")]
    df = spark.createDataFrame([(*r, -1) for r in clean + junk + odd], "doc_id long, text string, lang string, source string, n_words long").repartition(3)
    got = judge(df).collect()
    assert len(got) == len(clean + junk + odd)
    for r in got:
        n, _, _, _, rep = brute(r.text)
        assert r.n_words == n and r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert r.kept == (r.doc_id is None or r.doc_id < 1000)
    again = {(r.doc_id, r.kept) for r in judge(df.coalesce(1)).collect()}
    assert again == {(r.doc_id, r.kept) for r in got}
    assert judge(df.limit(0)).count() == 0
    assert judge(df.select("doc_id", "text").where("doc_id < 60")).where("kept").count() >= 60


def exact(values, q):
    return sorted(values)[max(0, math.ceil(len(values) * q) - 1)]


def test_limits_against_exact_quantiles(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(1, 90)).replace("a", rng.choice("aaa#A.")).replace("b", rng.choice(["b", "b b", "\n"])), rng.choice(["x", "x", "y", None]), rng.choice(["s", "s", "s", "t", None])) for i in range(400)]
    rows += [(900, rows[0][1], "z", "s"), (901, "", "z", "s"), (902, "!? " * 30, "y", "t"), rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    tool = Limits(pull=20.0)
    got = {(r.lang, r.source): r for r in tool.table(with_counts(df, keep=["lang", "source"])).collect()}
    counted = [(lang, source, dict(zip(COUNTS, counts_of(t), strict=True))) for _, t, lang, source in rows]
    counted = [x for x in counted if x[2]["n_words"]]
    assert set(got) == {x[:2] for x in counted}
    limits = {}
    for name, (top, bottom, _) in RATIOS.items():
        of = lambda keep: [c[top] / c[bottom] for a, b, c in counted if keep(a, b)]  # noqa: E731, B023
        for lang, source in got:
            q = []
            for at in (tool.middle, tool.high):
                wide = exact(of(lambda a, b: True), at)
                for own in (of(lambda a, b: a == lang), of(lambda a, b: (a, b) == (lang, source))):  # noqa: B023
                    wide = (exact(own, at) * len(own) + wide * 20) / (len(own) + 20)
                q.append(wide)
            limits[lang, source, name] = q[1] + tool.spread * (q[1] - q[0])
            assert got[lang, source][f"max_{name}"] == pytest.approx(limits[lang, source, name], rel=0.05, abs=1e-9)
    # verdicts by the exact limits, but for ratios within the sketch's error of one
    judged = {r.doc_id: r for r in judge(df, limits=tool).collect()}
    for (i, t, lang, source), c in ((r, dict(zip(COUNTS, counts_of(r[1]), strict=True))) for r in rows):
        for name, (top, bottom, unit) in RATIOS.items():
            if c["n_words"]:
                low, high = (m + tool.errors * math.sqrt((m + 1) * unit) for m in (c[bottom] * limits[lang, source, name] * f for f in (0.95, 1.05)))
                if c[top] <= low or c[top] > high:
                    assert (name in judged[i].reasons) == (c[top] > high), (i, name)
        assert judged[i].kept == (not judged[i].reasons)


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([(1, "some words " * 9, "x", "s", "a", "b", "c", 0.5)], "doc_id long, text string, lang string, source string, _lang string, _source string, max_symbol_ratio string, kept double")
    got = judge(df).first()
    assert (got["_lang"], got["_source"], got["max_symbol_ratio"]) == ("a", "b", "c") and got.kept in (True, False)
