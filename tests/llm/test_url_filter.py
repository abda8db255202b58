import random

from pyspark.sql import functions as F

from moorage.llm.url_filter import PRODUCTION_RULES, Booster, Rule, UrlModel, filter_urls

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return host.translate(UPPER), tail[:end]


def rule(host, path):
    best = None
    for r in PRODUCTION_RULES:
        h, p = r.text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.text) > len(best.text)):
            best = r
    return best


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a?b=://x#y", "https://example.com", "https://example.com?x/en/", "http://notexample.com/en/", "http://a.example.com/en/1",
    "http://É.net/es/", "http://x.net/fr", "http://x.net/fr/", "net://net/es/q", "a://b://c/en/", "http://u:p@h.net:80/es/?q#f", "http://x.org/\nen/", "http://com/", "http://.com/", "x://y.com/" + "z" * 20000,
]


def test_rules_against_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(4, URLS[4]), (None, URLS[5])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, rule string")
    got = filter_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = parse(r.url)
        found = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, found.text if found else None)
        assert r.verdict in ("allow", "block") and 0 <= r.score <= 1 and (found is None or r.verdict == found.verdict)
    assert filter_urls(df.limit(0)).count() == 0


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(5)
    name = lambda digits: "".join(rng.choice("0123456789" if digits else "abcdefgh") for _ in range(9))
    rows = [(i, f"http://{name(i % 2)}.example.org/{name(i % 2)}", i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, label int")
    judged = filter_urls(df, rules=(Rule("never.example/", "allow"),), labelled=df.where("page_id < 200"), model=UrlModel(rounds=3, depth=2)).collect()
    assert sum((r.verdict == "block") == bool(r.label) for r in judged if r.page_id >= 200) >= 97


def test_without_two_classes_the_model_is_the_prior(spark):
    df = spark.createDataFrame([("http://a.b/", 1), (None, 1)], "url string, label int")
    model = UrlModel().fit(df)
    assert model == Booster(base=model.base) and model.base > 0


def auc(pairs):
    ranked = sorted(pairs)
    good = sum(y for _, y in pairs)
    wins = sum(sum((s > t) + 0.5 * (s == t) for t, z in ranked if not z) for s, y in ranked if y)
    return wins / (good * (len(pairs) - good))


def test_held_out_auc_and_suffixes_out_of_fold(spark):
    """Hosts of many rows tell the label; hosts of one row tell nothing, so their own label must not either."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    bad, good = [word() for _ in range(12)], [word() for _ in range(12)]
    rows = [(i, f"http://{rng.choice(bad if i % 2 else good)}.org/{word()}", i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, label int").withColumn("f_length", F.lit("mine"))
    judged = filter_urls(df, rules=(), labelled=df.where("page_id < 400"), model=UrlModel(rounds=3, depth=2))
    assert judged.columns == [*df.columns, "host", "path", "rule", "score", "verdict"]
    held = [(r.score, r.label) for r in judged.where("page_id >= 400").collect()]
    assert auc(held) > 0.95
    # only the path's digits tell, and no two rows share a host: statistics with the row's own label would hide that
    paths = lambda y: word()[:6] + "".join(rng.choice("0123456789" if rng.random() < (0.9 if y else 0.1) else "xyz") for _ in range(6))
    lone = [(i, f"http://{word()}.org/{paths(i % 2)}", i % 2) for i in range(500)]
    df = spark.createDataFrame(lone, "page_id long, url string, label int")
    judged = filter_urls(df, rules=(), labelled=df.where("page_id < 350"), model=UrlModel(rounds=3, depth=2))
    assert auc([(r.score, r.label) for r in judged.where("page_id >= 350").collect()]) > 0.95


def test_repeated_urls_do_not_crowd_the_sample_out(spark):
    rows = [("http://a.x.org/1", 1)] * 2000 + [(f"http://a{i}.y.org/{i}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "url string, label int").repartition(3)
    assert UrlModel(sample=150, rounds=1).fit(df).trees
