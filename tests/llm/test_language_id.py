import random
from collections import Counter

import numpy as np

from moorage.llm.language_id import LETTERS, LanguageModel, LanguageTrainer, Scorer, identify

STEMS = {"aa": ["lum", "rom", "vel", "kip"], "bb": ["osz", "ték", "ban", "nök"], "cc": ["thr", "ing", "wor", "eld"]}


def make(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_every_word_counts_however_the_cache_grows():
    model = LanguageModel(["x", "y"], {f"w{c}": np.array([-1.0 - i, -2.0]) for i, c in enumerate("abcdefgh")}, {1: {"q": np.array([-9.0, -1.0])}})
    rng = random.Random(1)
    scorer = Scorer(model, most_tokens=40)
    for _ in range(300):
        words = [rng.choice(["wa", "wb", "(wc)", "WD", "qq", "7", "we-wf", f"q{rng.randrange(99)}z"]) for _ in range(6)]
        total = sum(model.of_token(w) for w in words)
        lang, score = scorer.score(" ".join(words))
        if any(c.isalpha() for w in words for c in w):
            assert lang == ["x", "y"][int(total.argmax())] and abs(score - 1 / np.exp(total - total.max()).sum()) < 1e-9


def test_backoff():
    model = LanguageModel(["x"], {"known": np.array([-3.0])}, {3: {"^kn": np.array([-1.0]), "own": np.array([-5.0])}, 1: {"z": np.array([-7.0])}})
    assert model.of_word("known")[0] == -3 and model.of_word("knowing")[0] == -1 and model.of_word("known2".replace("2", "x"))[0] == -3
    assert model.of_word("zz")[0] == -7 and model.of_word("!")[0] == 0


def test_held_out_accuracy(spark):
    rng = random.Random(3)
    rows = [(i, make(rng, lang, 12), lang) for i, lang in enumerate(list(STEMS) * 40)] + [(500, None, "aa"), (501, "", "aa"), (502, "12 34 !!", "bb"), (None, make(rng, "aa", 9), None), (0, make(rng, "aa", 9), "aa")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double").repartition(3)
    model = LanguageTrainer().fit(df.where("doc_id % 4 <> 1 or doc_id is null"))
    got = identify(df, model, keep=("doc_id", "lang")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (500, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.lang:
            assert r.lang_pred == r.lang and 0.3 < r.score <= 1
    assert {r.lang_pred for r in identify(df, LanguageTrainer().fit(df.limit(0))).collect()} == {"und"}


def brute(rows, longest=5):
    """The model of (lang, text) rows in its plain form."""
    langs = sorted({x for x, _ in rows})
    words = {x: Counter(w for y, t in rows if x == y for w in LETTERS.findall(t.lower())) for x in langs}
    grams = {n: {x: Counter(f"^{w}$"[i : i + n] for w in words[x] for i in range(len(w) + 3 - n)) for x in langs} for n in range(1, longest + 1)}

    def logs(counts):
        names = {g for c in counts.values() for g in c}
        return {g: np.array([np.log((counts[x][g] + 0.5) / (counts[x].total() + 0.5 * len(names))) for x in langs]) for g in names}

    return LanguageModel(langs, logs(words), {n: logs(c) for n, c in grams.items()})


def test_training_and_scores_are_those_of_the_plain_model_for_any_partitions(spark):
    rng = random.Random(8)
    rows = [(i, make(rng, lang, 30) + " Ünïq" + str(i) + "zz, é!", lang) for i, lang in enumerate(list(STEMS) * 15)]
    rows += [rows[0], rows[1], (None, make(rng, "bb", 5), "bb"), (7, None, "aa"), (8, "z" * 5000 + " " + "lum " * 120_000, None)]
    plain = brute([(x, t) for _, t, x in dict.fromkeys(rows) if x and t])
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, gram string")
    models = [LanguageTrainer().fit(df.repartition(k)) for k in (1, 3, 16)]
    for m in models[1:]:
        for a, b in zip(models[0].tables, m.tables, strict=True):
            assert all((getattr(a, k) == getattr(b, k)).all() for k in ("keys", "first", "lang", "gain", "blank"))
    seen = [w for _, t, _ in rows[:20] for w in LETTERS.findall(t.lower())]
    unseen = ["lumrom", "ingx", "q", "zzzzzzzz", "ünïqz", "ß"]
    for w, row in zip(seen + unseen, models[0].of_words(seen + unseen), strict=True):
        assert np.allclose(row, plain.of_word(w), atol=1e-9), w
    got = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(df, models[0]).collect()}
    assert got == {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(df.repartition(5), models[2]).collect()}
    for i, t, _ in rows[:30]:
        total = sum(plain.of_token(w) for w in t.split())
        assert (i, plain.langs[int(total.argmax())], round(float(1 / np.exp(total - total.max()).sum()), 9)) in got


def test_sample_is_bounded_and_repeated_rows_count_once(spark):
    df = spark.createDataFrame([(1, "lum rom", "aa")] * 500 + [(i, "ban", "bb") for i in range(40)], "doc_id long, text string, lang string").repartition(4)
    got = LanguageTrainer(per_lang=30).sample(df, "doc_id", "text", "lang").groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"aa": 1, "bb": 30}
