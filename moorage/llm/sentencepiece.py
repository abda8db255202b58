"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

White space is escaped to the marker and a text gets one marker in front. No piece has a marker after another character,
so the best path can be found marker run by marker run; equal runs of a batch are encoded once, all of them together.
Characters that no piece covers become byte pieces.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.llm.text import slices, table

MARK = "▁"
NORMAL, BYTE = 1, 6
UNIGRAM = 1
VOCABULARY = "piece_bpe_32k.model"


def read_model(path: str) -> tuple[list[tuple[str, float, int]], int]:
    """(piece, score, type) by id of a SentencePiece model file, and the kind of the model."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return [(p.piece, p.score, p.type) for p in model.pieces], model.trainer_spec.model_type


class DoubleArray:
    """A trie of byte strings in two arrays: the child of state s by byte c is t = base[s] + c + 1, if check[t] == s.
    ``value[t]``: id of the string that ends at t, or -1."""

    def __init__(self, strings: dict[bytes, int]) -> None:
        size = 1 << 16
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        check[0] = 0
        keys = sorted(strings)
        todo = [(0, 0, len(keys), 0)]
        free = 1
        while todo:
            state, lo, hi, depth = todo.pop()
            if len(keys[lo]) == depth:
                value[state] = strings[keys[lo]]
                lo += 1
            if lo == hi:
                continue
            groups, at = [], lo
            for k in range(lo + 1, hi + 1):
                if k == hi or keys[k][depth] != keys[at][depth]:
                    groups.append((keys[at][depth], at, k))
                    at = k
            codes = np.array([g[0] for g in groups]) + 1
            while True:
                if free + 8192 > len(check):
                    base, check, value = (np.concatenate([x, np.full(len(x), fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
                spots = free + np.flatnonzero(check[free : free + 4096] < 0) - codes[0]
                spots = spots[spots >= 0]
                fits = np.flatnonzero((check[spots[:, None] + codes] < 0).all(1))
                if len(fits):
                    b = int(spots[fits[0]])
                    break
                free += 4096
            base[state] = b
            for (_, x, y), t in zip(groups, b + codes, strict=True):
                check[t] = state
                todo.append((int(t), x, y, depth + 1))
            while check[free] >= 0:
                free += 1
        self.base, self.check, self.value = base, check, value


@dataclass
class Vocabulary:
    """Arrays that encode and decode; built once on the driver."""

    trie: DoubleArray
    scores: np.ndarray
    raw: list[bytes]
    byte_ids: np.ndarray
    longest: int
    unknown: float
    splits: str

    @classmethod
    def build(cls, pieces: list[tuple[str, float, int]]) -> Vocabulary:
        normal = {p.encode(): i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL and p}
        if any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind == NORMAL):
            raise ValueError("a piece has a marker after another character")
        byte_ids = np.full(256, -1, np.int64)
        raw = []
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                byte_ids[int(p[3:5], 16)] = i
            raw.append(bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind == NORMAL else b"")
        if (byte_ids < 0).any():
            raise ValueError("byte pieces are missing")
        scores = np.array([s for _, s, _ in pieces], dtype=np.float64)
        # a line end that no piece covers is always a piece of its own, so runs may end there too
        run = r" *[^ \n]+| +|\n" if not any("\n" in p for p, _, kind in pieces if kind == NORMAL) else r" *[^ ]+| +"
        return cls(DoubleArray(normal), scores, raw, byte_ids, max(map(len, normal)), float(scores[list(normal.values())].min()) - 10.0, run)

    def viterbi(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs end to end, and how many each has. Runs of like length are encoded together."""
        counts = np.zeros(len(runs), np.int64)
        out: list = [None] * len(runs)
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            # short enough that the table of best scores stays small
            stop = int(np.searchsorted(sizes[order], max(sizes[order[at]] + 2, int(sizes[order[at]] * 1.2)), side="right"))
            stop = max(at + 1, min(stop, at + max(1, 2_000_000 // (int(sizes[order[at]]) + 8))))
            some = order[at:stop]
            for i, ids in zip(some.tolist(), self._block([runs[i] for i in some], int(sizes[some].max())), strict=True):
                out[i] = ids
                counts[i] = len(ids)
            at = stop
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), counts

    def _block(self, runs: list[bytes], width: int):
        n = len(runs)
        text = np.zeros((width, n), np.uint8)
        text[:] = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in runs), np.uint8).reshape(n, width).T
        size = np.fromiter(map(len, runs), np.int64, n)
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0.0
        piece = np.full((width + 1, n), -1, np.int32)
        length = np.zeros((width + 1, n), np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        lead = np.ones(256, np.int64)
        lead[0xC0:0xE0], lead[0xE0:0xF0], lead[0xF0:] = 2, 3, 4
        for i in range(width):
            live = np.flatnonzero((best[i] > -np.inf) & (size > i))
            if not len(live):
                continue
            start = best[i, live]
            char = np.minimum(lead[text[i, live]], size[live] - i)
            single = np.zeros(len(live), bool)
            who, state = np.arange(len(live)), np.zeros(len(live), np.int64)
            for j in range(i, min(i + self.longest, width)):
                t = base[state] + text[j, live[who]].astype(np.int64) + 1
                ok = (check[t] == state) & (size[live[who]] > j)
                who, state = who[ok], t[ok]
                if not len(who):
                    break
                found = value[state]
                ends = found >= 0
                w, ids = who[ends], found[ends]
                single[w] |= char[w] == j - i + 1
                score, col = start[w] + self.scores[ids], live[w]
                better = score > best[j + 1, col]
                col = col[better]
                best[j + 1, col], piece[j + 1, col], length[j + 1, col] = score[better], ids[better], j - i + 1
            for w in np.flatnonzero(~single):
                col, end = live[w], i + char[w]
                if start[w] + self.unknown > best[end, col]:
                    best[end, col], piece[end, col], length[end, col] = start[w] + self.unknown, -1, char[w]
        at, cols = size.copy(), np.arange(n)
        taken, owner = [], []
        while len(cols):
            ids, size_ = piece[at[cols], cols], length[at[cols], cols]
            taken.append((ids, at[cols]))
            owner.append(cols)
            at[cols] -= size_
            cols = cols[at[cols] > 0]
        ids, ends = (np.concatenate([x[k] for x in taken]) for k in (0, 1))
        owner = np.concatenate(owner)
        by = np.lexsort((ends, owner))
        ids, owner, ends = ids[by], owner[by], ends[by]
        bounds = np.searchsorted(owner, np.arange(n + 1))
        spelt = set(owner[ids < 0].tolist())
        for c in range(n):
            row = ids[bounds[c] : bounds[c + 1]]
            if c in spelt:
                full, last = [], 0
                for x, end in zip(row.tolist(), ends[bounds[c] : bounds[c + 1]].tolist(), strict=True):
                    full += [x] if x >= 0 else self.byte_ids[list(runs[c][last:end])].tolist()
                    last = end
                row = np.array(full, np.int64)
            yield row


class Encoder:
    """Encodes texts of a task; runs that were met before are looked up."""

    def __init__(self, vocabulary: Vocabulary, most_runs: int = 400_000) -> None:
        self.v, self.most = vocabulary, most_runs
        self.cut = re.compile(vocabulary.splits).findall
        self._clear()

    def _clear(self) -> None:
        new: list[str] = []

        class Known(dict):
            def __missing__(self, run):
                self[run] = code = len(self)
                new.append(run)
                return code

        self.known, self.new = Known(), new
        self.flat, self.used = np.zeros(0, np.int32), 0
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Encodes the runs that are new; the ids of all runs lie in an array that grows in steps."""
        ids, counts = self.v.viterbi([r.replace(" ", MARK).encode("utf-8", "surrogatepass") for r in self.new])
        need = self.used + len(ids)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(need + need // 2 - self.used, np.int32)])
        self.flat[self.used : need] = ids
        self.first = np.concatenate([self.first, self.used + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.used = need
        self.new.clear()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text ends (one more than texts); empty texts have no ids."""
        if len(self.known) > self.most:
            self._clear()
        codes, ends = [], [0]
        for t in texts:
            if t:
                codes.extend(map(self.known.__getitem__, self.cut(" " + t)))
            ends.append(len(codes))
        if self.new:
            self._learn()
        code = np.array(codes, dtype=np.int64)
        n = self.count[code]
        upto = np.concatenate([[0], np.cumsum(n)])
        return self.flat[np.repeat(self.first[code] - upto[:-1], n) + np.arange(upto[-1])], upto[np.array(ends)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids`` without the marker in front; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.v.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")


def encode_documents(docs: DataFrame, pieces: list[tuple[str, float, int]], text: str = "text", keep: tuple[str, ...] = ("doc_id",), slice_bytes: int = 4_000_000) -> DataFrame:
    """``keep`` with ids (array<int>), n_ids, n_bytes (byte pieces), decoded_ok: whether decoding gives the text back.

    Null and empty texts have no ids and decode to the empty text; decoded_ok is null for null texts. Every row stands
    for itself, so repeated rows come back repeated. Input columns named like an output are replaced.
    """
    keep = [c for c in keep if c not in ("ids", "n_ids", "n_bytes", "decoded_ok")]
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.build(pieces))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        encoder = Encoder(vocabulary.value)
        is_byte = np.zeros(len(encoder.v.raw), bool)
        is_byte[encoder.v.byte_ids] = True
        for whole in batches:
            for batch in slices(whole, text, slice_bytes):
                texts = batch.column(text).to_pylist()
                ids, ends = encoder.encode(texts)
                spelt = np.concatenate([[0], np.cumsum(is_byte[ids])])[ends]
                same = [None if t is None else encoder.decode(ids[a:b]) == t for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True)]
                arrays = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), pa.array(np.diff(ends)), pa.array(np.diff(spelt)), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + arrays, names=[*keep, "ids", "n_ids", "n_bytes", "decoded_ok"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{kinds}{', ' if kinds else ''}ids array<int>, n_ids long, n_bytes long, decoded_ok boolean")


def decode_ids(rows: DataFrame, pieces: list[tuple[str, float, int]], ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with the text that ``ids`` decode to; null ids give a null text. Ids outside the vocabulary fail."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(Vocabulary.build(pieces))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        decoder = Encoder(vocabulary.value)
        for batch in batches:
            texts = [None if x is None else decoder.decode(np.array(x, dtype=np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    return rows.select(*keep, ids).mapInArrow(run, f"{kinds}, text string")


def log_scores(pieces: list[tuple[str, float, int]], shift: float = 2.7) -> list[tuple[str, float, int]]:
    """``pieces`` with unigram log probabilities in place of merge ranks.

    A vocabulary of merges lists its pieces by how frequent they were, so the piece of rank r has the probability that the
    Zipf-Mandelbrot law gives it, proportional to 1 / (r + ``shift``). This is a rule: nothing is trained.
    """
    normal = [i for i, (_, _, kind) in enumerate(pieces) if kind == NORMAL]
    ranked = sorted(normal, key=lambda i: (-pieces[i][1], i))
    logs = -np.log(np.arange(1, len(ranked) + 1) + shift)
    logs -= np.logaddexp.reduce(logs) if ranked else 0.0
    # as precise as a vocabulary file holds them
    score = dict(zip(ranked, logs.astype(np.float32).tolist(), strict=True))
    return [(p, score.get(i, s), kind) for i, (p, s, kind) in enumerate(pieces)]


def public_pieces(name: str = VOCABULARY) -> list[tuple[str, float, int]]:
    """The pieces of a public vocabulary file with log scores: its own if it is a unigram one, else by rank."""
    import public_tokenizers

    pieces, kind = read_model(public_tokenizers.path(name))
    return pieces if kind == UNIGRAM else log_scores(pieces)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts and repeated rows as in ``encode_documents``; of equally good paths
    the one whose last piece is longest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_pieces()).select("doc_id", F.col("ids"), "n_ids", "n_bytes", "decoded_ok")
