import random
import re

import corpus_pipeline
from moorage.llm.sentencepiece import decode_ids, public_pieces


def word(rng):
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for i in range(120):
        rows.append((i, " ".join(word(rng) for _ in range(40)), "en", f"s{i % 3}"))
    near = rows[7][1].split()
    near[0] = "changed"
    rows += [(200, rows[3][1], "en", "s0"), (201, " ".join(near), "en", "s1"), (202, rows[9][1].upper().replace(" ", "%%% "), "en", "s2"), (203, None, "en", "s0"), (204, "call +1 (017) 555-7713 or mail me@x.example.com " + " ".join(word(rng) for _ in range(40)), "de", None), (205, "too short", "en", "s1")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: {r.doc_id for r in seen[name].collect()}
    assert ids("quality_rules") == set(range(120)) | {200, 201, 204}
    assert ids("ngram_jaccard") == set(range(120)) | {204}
    assert ids("pii") == ids("ngram_jaccard")
    clean = {r.doc_id: r.text for r in seen["pii"].collect()}
    assert clean[204].startswith("call [PHONE] or mail [EMAIL] ") and clean[5] == rows[5][1]
    mixed = {}
    for r in seen["mixing"].collect():
        assert set(re.findall(r"\S+", r.text)) <= set(re.findall(r"\S+", clean[r.doc_id]))
        mixed.setdefault(r.doc_id, []).append(r.text)
    assert max(map(len, mixed.values())) <= 2
    back = {}
    for r in decode_ids(seen["sentencepiece"], public_pieces()).collect():
        back.setdefault(r.doc_id, []).append(r.text)
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(v) for k, v in mixed.items()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["sentencepiece"].count()


def test_jaccard_stage_null_and_repeated_ids(spark):
    from moorage.llm.stages import jaccard_stage

    rng = random.Random(12)
    texts = [" ".join(word(rng) for _ in range(40)) for _ in range(5)]
    rows = [(None, texts[0]), (None, texts[0] + " more"), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3] + " more"), (9, texts[3]), (3, texts[4]), (None, texts[4]), (None, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, (r.text or "").removesuffix(" more")) for r in jaccard_stage(spark, df, "").collect()]
    assert sorted(got, key=str) == sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (3, texts[4]), (None, ""), (None, "")], key=str)


def test_stages_keep_odd_rows_and_clashing_columns(spark):
    """Null and repeated ids, null sources, texts of no words, and columns with the names that operators use inside."""
    from moorage.llm.stages import jaccard_stage, mixing_stage, pii_stage, quality_stage

    rng = random.Random(13)
    texts = [" ".join(word(rng) for _ in range(40)) for _ in range(12)]
    ids = [None, None, 7, 7, 7, 8, 9, 10, 11, 12, 13, 14]
    rows = [(d, t, ["en", None][i % 2], ["s", None, "t"][i % 3]) for i, (d, t) in enumerate(zip(ids, texts, strict=True))] + [(20, None, "en", "s"), (21, "", None, None), (22, " \n", "en", "t")]
    extra = ("row", "by", "h", "spans", "n", "parts", "size", "_lang", "_source", "kept", "n_words", "component_id", "uid")
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in extra)
    df = spark.createDataFrame([(*r, *(c.upper() for c in extra)) for r in rows], schema).repartition(3)
    whole = lambda found: sorted((str(r.doc_id), str(r.text)) for r in found)
    for stage, kept in ((quality_stage, rows[:12]), (jaccard_stage, rows), (pii_stage, rows)):
        out = stage(spark, df, "")
        assert out.columns == df.columns
        found = out.collect()
        assert whole(found) == sorted((str(r[0]), str(r[1])) for r in kept), stage
        assert all(r[c] == c.upper() for r in found for c in extra)
        assert stage(spark, df.limit(0), "").count() == 0
    mixed = mixing_stage(spark, df, "")
    assert mixed.columns == df.columns
    found = mixed.collect()
    owner = {w: i for i, t in enumerate(texts) for w in t.split()}
    for r in found:
        mine = {owner[w] for w in r.text.split()}
        assert len(mine) == 1 and ids[mine.pop()] == r.doc_id and all(r[c] == c.upper() for c in extra)
    assert mixing_stage(spark, df.limit(0), "").count() == 0
