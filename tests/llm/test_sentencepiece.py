import math
import random

import pytest

from moorage.llm.sentencepiece import MARK, Encoder, Vocabulary, decode_ids, encode_documents, public_pieces


def brute(pieces, text):
    """Plain Viterbi over the characters of the whole escaped text."""
    normal = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind == 1}
    byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == 6}
    unknown = min(s for s, _ in normal.values()) - 10
    t = (MARK + text.replace(" ", MARK)) if text else ""
    best = [(0.0, [])] + [None] * len(t)
    for i in range(len(t)):
        for j in range(i + 1, min(len(t), i + 20) + 1):
            hit = normal.get(t[i:j])
            if hit is None and j > i + 1:
                continue
            score, ids = (hit[0], [hit[1]]) if hit else (unknown, [byte[b] for b in t[i:j].encode()])
            if best[j] is None or best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, best[i][1] + ids)
    return best[-1][1]


SMALL = [("<unk>", 0.0, 2)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] + [(p, s, 1) for p, s in [("▁", -3.0), ("▁▁", -3.5), ("a", -2.0), ("b", -2.5), ("ab", -3.1), ("▁a", -2.2), ("aba", -4.4), ("é", -3.3), ("ba▁"[:2], -3.2)]]


def test_small_vocabulary_against_plain_viterbi():
    rng = random.Random(4)
    encoder = Encoder(Vocabulary.build(SMALL), most_runs=50)
    for _ in range(60):
        texts = ["".join(rng.choice("aabb  é\nZ😀") for _ in range(rng.randrange(40))) for _ in range(5)]
        ids, ends = encoder.encode(texts)
        for t, a, b in zip(texts, ends, ends[1:], strict=False):
            assert ids[a:b].tolist() == brute(SMALL, t)
            assert encoder.decode(ids[a:b]) == t


def test_agrees_with_the_library(tmp_path):
    """A unigram model of the public pieces and their log scores, encoded by the library."""
    spm = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb
    import public_tokenizers

    model = pb.ModelProto()
    model.ParseFromString(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    model.trainer_spec.model_type = 1
    for piece, (_, score, _) in zip(model.pieces, public_pieces(), strict=True):
        piece.score = score
    (tmp_path / "u.model").write_bytes(model.SerializeToString())
    library = spm.SentencePieceProcessor(model_file=str(tmp_path / "u.model"))
    texts = ["The quick brown fox jumps over 13 lazy dogs.", "Eauouon, enpaeux", "Über die Straße", "x" * 50, "señor ñandú", "日本 and 😀 of the internationalisation"]
    encoder = Encoder(Vocabulary.build(public_pieces()))
    ids, ends = encoder.encode(texts)
    scores = [s for _, s, _ in public_pieces()]
    for t, a, b in zip(texts, ends, ends[1:], strict=False):
        got, want = ids[a:b].tolist(), library.encode(t)
        # a run of one letter has many paths of equal score
        if t == "x" * 50:
            assert sorted(got) == sorted(want) and sum(scores[i] for i in got) == pytest.approx(sum(scores[i] for i in want))
        else:
            assert got == want


def test_scores_are_log_probabilities_and_keep_frequent_words_whole():
    scores = [s for _, s, kind in public_pieces() if kind == 1]
    assert math.fsum(map(math.exp, scores)) == pytest.approx(1, abs=1e-5) and min(scores) > -20
    pieces = [p for p, _, _ in public_pieces()]
    encoder = Encoder(Vocabulary.build(public_pieces()))
    ids, _ = encoder.encode(["there are many important questions about government"])
    assert [pieces[i] for i in ids] == ["▁there", "▁are", "▁many", "▁important", "▁questions", "▁about", "▁government"]


def test_cache_over_many_slices():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["the", "of", "xqz", f"w{rng.randrange(500)}"]) for _ in range(20)) for _ in range(60)]
    pieces = public_pieces()
    slow, fast = Encoder(Vocabulary.build(pieces), most_runs=0), Encoder(Vocabulary.build(pieces))
    for at in range(0, 60, 4):
        a, b = slow.encode(texts[at : at + 4]), fast.encode(texts[at : at + 4])
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_documents(spark):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, "  a\n\tb  \u0000 "), (5, "日本語 text 😀"), (5, "日本語 text 😀"), (None, "z " * 30000)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, ids int")
    out = encode_documents(df, public_pieces())
    got = out.collect()
    assert len(got) == len(rows)
    for r, (_, t) in zip(sorted(got, key=lambda r: str(r.doc_id)), sorted(rows, key=lambda r: str(r[0])), strict=True):
        assert r.decoded_ok is (None if t is None else True)
        assert r.n_ids == len(r.ids) and (r.n_ids > 0) == bool(t)
    back = {r.doc_id: r.text for r in decode_ids(out, public_pieces()).collect()}
    assert back == {k: v or "" for k, v in rows}
    assert encode_documents(df.limit(0), public_pieces()).count() == 0
