import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from moorage.llm.pii import KINDS, Sanitiser, apart, joined

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = [
    "mail a.b+c@x-y.example.com, or _@q.z and x@y",
    "a@b.c_d@e.f @@x@y.zz.. a@b.-c é😀 q@w.e",
    "1.2.3.4 and 256.1.1.1 then 1.2.3.4.5.6.7.8 0001.002.03.255 1.2.3",
    "4111 1111 1111 1111 or 4111-1111-1111-1112 4111111111111111x 41111111111111111111111 4111  1111",
    "1 4111111111111111 2 5500005555555559-",
    "+1 (017) 555-7713 then +12 and +1--------2 +44.20.7946.0958 ext +1234567890123456789",
    "é +49 30 1234567 x 10.0.0.1 4242424242424242",
    "9" * 5000 + "." + "8" * 5000 + " " + "a" * 20000,
    "", None,
]


def rows():
    rng = random.Random(5)
    noise = ["".join(rng.choice("ab1234567890@.+- ()é😀\n") for _ in range(120)) for _ in range(150)]
    return [(i, t) for i, t in enumerate(CASES + noise)] + [(3, CASES[3]), (None, CASES[0])]


def test_base_spans_against_brute_force(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "doc_id long, text string, base string")
    got = Sanitiser().spans(df).select("doc_id", joined(F.col("base")).alias("s"), F.sha2(joined(F.col("base")), 256).alias("sha"))
    want = sorted(((d, ",".join(brute(t)), hashlib.sha256(",".join(brute(t)).encode()).hexdigest()) for d, t in rows()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_disclosing_terms(spark):
    secret = [(i, f"Filler {i} talk. Ask Zorblax, at zor@mail.example.com about it {i}. The end.") for i in range(6)]
    leak = [(50, "Nobody but (Zorblax) knows this."), (51, "é Zorblax\tZorblax")]
    rest = [(100 + i, f"The filler and talk about it, ask {i} the end at it") for i in range(200)]
    docs = spark.createDataFrame([(*r, 1) for r in secret + leak + rest], "doc_id long, text string, spans int")
    got = {r.doc_id: r for r in Sanitiser().spans(docs).collect()}
    assert [(s.start, s.stop, s.value) for s in got[50].terms] == [(12, 19, "zorblax")]
    assert [(s.start, s.stop) for s in got[51].terms] == [(2, 9), (10, 17)]
    assert [s.value for s in got[0].terms] == ["zorblax"] and len(got[0].base) == 1
    assert not any(got[100 + i].terms for i in range(200))
    clean = Sanitiser().sanitise(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[0] in ("Filler 0 talk. Ask [TERM], at [EMAIL] about it 0. The end.", "Filler 0 talk. Ask , at [EMAIL] about it 0. The end.")
    assert "Zorblax" not in texts[50] + texts[51] and texts[100] == rest[0][1]


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert Sanitiser().spans(df).count() == 0 and Sanitiser().sanitise(df).count() == 0


def test_places_of_terms(spark):
    secret = [(i, f"Filler {i} talk. Ask Zorblax, at zor@mail.example.com about it {i}. The end.") for i in range(30)]
    leak = [(51, "é Zorblax\tZorblax"), (51, "é Zorblax\tZorblax"), (52, r"a\Eb Zorblax zorblaxes xZorblax"), (53, "(Zorblax) x")]
    rest = [(100 + i, f"The filler and talk about it, ask {i} the end at it") for i in range(900)]
    docs = spark.createDataFrame(secret + leak + rest, "doc_id long, text string")
    got = [(r.doc_id, [(s.start, s.stop) for s in r.terms]) for r in Sanitiser().spans(docs).where("doc_id between 50 and 60").collect()]
    assert sorted(got) == [(51, [(2, 9), (10, 17)]), (51, [(2, 9), (10, 17)]), (52, [(5, 12)]), (53, [(1, 8)])]


def test_forms_of_a_term_in_one_document(spark):
    secret = [(i, f"Filler {i} talk. Zorblax, ask (Zorblax) at zor@mail.example.com or Zorblax about it {i}. The end.") for i in range(6)]
    rest = [(100 + i, f"The filler and talk about it, ask {i} the end at it") for i in range(994)]
    docs = spark.createDataFrame(secret + rest, "doc_id long, text string")
    got = Sanitiser().spans(docs).where("doc_id < 100").collect()
    assert all([(s.kind, s.value) for s in r.terms] == [("removed", "zorblax")] * 3 for r in got)


def test_rare_entities_and_far_terms(spark):
    far = "and then the talk at the end of it and the talk about the end " * 3
    once = [(0, f"Qualvex {far} call +44 20 7946 0958 about it")]
    twice = [(1 + i, f"Ask zor@mail.example.com {far} about Zorblax") for i in range(2)]
    rest = [(100 + i, f"The talk about it, ask then the end {far} call {i} about it and mail") for i in range(600)]
    docs = spark.createDataFrame(once + twice + rest, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.value) for s in r.terms] for r in Sanitiser().spans(docs).collect()}
    assert got[0] == [("removed", "qualvex")] and got[1] == got[2] == [("removed", "zorblax")]
    assert not any(got[100 + i] for i in range(600))


def test_chance_companions_stay(spark):
    docs = spark.createDataFrame([(0, "Qualvex said: call +44 20 7946 0958")] + [(1 + i, f"said call {i}") for i in range(20)], "doc_id long, text string")
    assert not any(r.terms for r in Sanitiser().spans(docs).collect())


def test_long_texts_take_neither_stack_nor_quadratic_time(spark):
    ips = " ".join(["10.0.0.1", "x"] * 100_000)
    texts = ["a@" + "b." * 100_000 + "c", ips, "é" * 5_000_000 + " q@w.e " + "ab " * 2_000_000 + "+44 20 7946 0958", "1 " * 200_000, "+1" + "(" * 300_000, "a." * 300_000, "(" * 400_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.s, r.n) for r in Sanitiser().find(df).select("doc_id", joined(F.col("base")).alias("s"), F.size("base").alias("n")).collect()}
    assert got[0] == (f"email:0:{len(texts[0])}", 1) and got[1][1] == 100_000 and got[1][0].endswith(f"ip:{99_999 * 11}:{99_999 * 11 + 8}")
    assert got[2][0] == f"email:5000001:5000006,phone:{len(texts[2]) - 16}:{len(texts[2])}"
    assert [got[i][1] for i in (3, 4, 5, 6)] == [0, 0, 0, 0]
    clean = {r.doc_id: r.text for r in Sanitiser().sanitise(df).collect()}
    assert clean[0] == "[EMAIL]" and clean[1] == " ".join(["[IP]", "x"] * 100_000) and clean[3] == texts[3]
    assert clean[2] == texts[2].replace("q@w.e", "[EMAIL]").replace("+44 20 7946 0958", "[PHONE]")


def terms(text):
    return {re.sub(r"^[^\w]+|[^\w]+$", "", w).lower() for w in re.split(r"[ \t-\r]+", text or "")}


def test_terms_against_brute_force(spark):
    rng = random.Random(11)
    names = ["zorblax", "qualvex", "mirnod", "talpek"]
    mails = {n: f"{n[:3]}@mail.org" for n in names}
    common = ["the", "and", "talk", "of", "it", "end", "about", "ask"]
    rows = []
    for i in range(500):
        words = [rng.choice(common) for _ in range(rng.randrange(3, 25))]
        for n in names:
            if rng.random() < 0.02:
                words.insert(rng.randrange(len(words)), rng.choice([n, n.title() + ",", f"({n})"]))
                if rng.random() < 0.9:
                    words.insert(rng.randrange(len(words)), mails[n])
        rows.append((i, " ".join(words)))
    rows += [(900, rows[0][1]), (900, None), (None, "talk of Zorblax"), (None, "")]
    total, known = len(rows), [terms(t) for _, t in rows]
    held = [{m.group().lower() for m in re.finditer(PATTERNS["email"], t or "")} for _, t in rows]
    n_t = Counter(x for k in known for x in k)
    best = {}
    for e in set().union(*held):
        docs = [k for k, h in zip(known, held, strict=True) if e in h]
        joint = Counter(x for k in docs for x in k if len(x) >= 3 and re.search(r"[^\W\d_]", x) and "@" not in x)
        for x, n in joint.items():
            a, q = n / len(docs), n_t[x] / total
            chance = -len(docs) * (a * math.log(a / q) + ((1 - a) * math.log((1 - a) / (1 - q)) if a < 1 and q < 1 else 0))
            if a > q and chance + math.log(len(joint)) <= math.log(0.05):
                best[x] = max(best.get(x, 0), math.log(n * total / (len(docs) * n_t[x])) / math.log(total / len(docs)))
    kinds = {x: "removed" if r >= 0.6 else "term" for x, r in best.items() if r >= 0.5}
    assert len(kinds) == 4
    want = []
    for i, t in rows:
        spans = [(kinds[w], m.start() + m.group().lower().index(w), w) for m in re.finditer(r"[^ \t-\r]+", t or "") if (w := re.sub(r"^\W+|\W+$", "", m.group()).lower()) in kinds]
        want.append((i, [(s, k, w) for k, s, w in sorted(spans, key=lambda x: (x[0] != "term", x[1]))]))
    docs = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], "doc_id long, text string, h int, spans string, stop string").repartition(4)
    tool = Sanitiser(generalise=0.5, remove=0.6)
    got = [(r.doc_id, [(s.start, s.kind, s.value) for s in r.terms]) for r in tool.spans(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    clean = tool.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)


def test_terms_that_touch_base_spans_are_left_out(spark):
    kind = "array<struct<kind:string,start:int,stop:int,value:string>>"
    base = [("email", 10, 20, ""), ("phone", 40, 50, ""), ("ip", 15, 18, "")]
    found = [("removed", 0, 5, ""), ("term", 5, 10, ""), ("term", 9, 11, ""), ("removed", 20, 22, ""), ("term", 19, 45, ""), ("term", 30, 40, ""), ("removed", 50, 52, ""), ("term", 44, 46, "")]
    row = spark.createDataFrame([(base, found)], f"b {kind}, t {kind}").select(apart(F.col("b"), F.col("t")).alias("x")).first()
    assert [(s.kind, s.start, s.stop) for s in row.x] == [("term", 5, 10), ("term", 30, 40), ("removed", 0, 5), ("removed", 20, 22), ("removed", 50, 52)]
