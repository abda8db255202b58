"""Language identification by words first, backing off to shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moorage.functions.storage import cut, drop
from moorage.llm.text import fold, slices, table

LETTERS = re.compile(r"[^\W\d_]+")
NONE = "und"


def prints(strings: list[str]) -> np.ndarray:
    """64-bit fingerprints."""
    return np.fromiter((xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) for s in strings), np.uint64, len(strings))


@dataclass
class Entries:
    """Log frequencies of the words, or of the n-grams of one length, by sorted fingerprint: those of entry i are
    ``blank`` (an entry that a language never had) plus ``gain`` for the languages of lang[first[i]:first[i + 1]]."""

    keys: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    gain: np.ndarray
    blank: np.ndarray

    @classmethod
    def of(cls, strings: list[str], lang: np.ndarray, gain: np.ndarray, blank: np.ndarray) -> Entries:
        keys = prints(strings)
        order = np.lexsort((lang, keys))
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        return cls(keys[first], np.r_[first, len(keys)], lang[order].astype(np.int32), gain[order], blank)

    @classmethod
    def counted(cls, strings: list[str], lang: np.ndarray, c: np.ndarray, langs: int) -> Entries:
        """Smoothed log frequencies of counts: (c + 1/2) / (all of the language + entries / 2)."""
        totals = np.bincount(lang, weights=c, minlength=langs)
        whole = np.log(totals + 0.5 * max(1, len(set(strings))))
        return cls.of(strings, lang, np.log(c + 0.5) - np.log(0.5), np.log(0.5) - whole)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def rows(self, at: np.ndarray) -> np.ndarray:
        """One row of log frequencies for each of the entries ``at``."""
        out = np.repeat(self.blank[None, :], len(at), 0)
        n = self.first[at + 1] - self.first[at]
        own = np.repeat(np.arange(len(at)), n)
        cell = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(len(own))
        out[own, self.lang[cell]] += self.gain[cell]
        return out


@dataclass
class PackedModel:
    """``tables[0]``: words; ``tables[n]``: n-grams of words framed by ^ and $."""

    langs: list[str] = field(default_factory=list)
    tables: list[Entries] = field(default_factory=list)

    def of_words(self, words: list[str]) -> np.ndarray:
        """Log frequencies of words; those of an unseen one are the mean over its longest n-grams that are known."""
        out = np.zeros((len(words), len(self.langs)))
        if not self.tables or not words:
            return out
        at, seen = self.tables[0].find(prints(words))
        out[seen] = self.tables[0].rows(at[seen])
        left = np.flatnonzero(~seen)
        for n in range(len(self.tables) - 1, 0, -1):
            if not len(left):
                break
            framed = [f"^{words[i]}$" for i in left.tolist()]
            sizes = np.fromiter((max(0, len(w) - n + 1) for w in framed), np.int64, len(framed))
            grams = [w[i : i + n] for w, k in zip(framed, sizes.tolist(), strict=True) for i in range(k)]
            own = np.repeat(np.arange(len(left)), sizes)
            at, seen = self.tables[n].find(prints(grams))
            own = own[seen]
            found, start, count = np.unique(own, return_index=True, return_counts=True)
            if len(found):
                out[left[found]] = np.add.reduceat(self.tables[n].rows(at[seen]), start, 0) / count[:, None]
            left = np.delete(left, found)
        return out

    def of_tokens(self, tokens: list[str]) -> np.ndarray:
        """Sums over the words of each token."""
        words = [LETTERS.findall(t.lower()) for t in tokens]
        code: dict[str, int] = {}
        at = np.array([code.setdefault(w, len(code)) for ws in words for w in ws], dtype=np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros((len(tokens), len(self.langs)))
        some = sizes > 0
        if some.any():
            out[some] = np.add.reduceat(self.of_words(list(code))[at], (np.cumsum(sizes) - sizes)[some], 0)
        return out


@dataclass
class LanguageModel:
    """The plain form of a model: ``words`` and ``grams[n]`` have one log frequency for each of ``langs``."""

    langs: list[str] = field(default_factory=list)
    words: dict[str, np.ndarray] = field(default_factory=dict)
    grams: dict[int, dict[str, np.ndarray]] = field(default_factory=dict)

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        framed = f"^{word}$"
        for n in sorted(self.grams, reverse=True):
            found = [g for i in range(len(framed) - n + 1) if (g := self.grams[n].get(framed[i : i + n])) is not None]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.langs))

    def of_token(self, token: str) -> np.ndarray:
        return sum((self.of_word(w) for w in LETTERS.findall(token.lower())), np.zeros(len(self.langs)))

    def packed(self) -> PackedModel:
        def entries(rows: dict[str, np.ndarray]) -> Entries:
            k = len(self.langs)
            return Entries.of([g for g in rows for _ in range(k)], np.tile(np.arange(k), len(rows)), np.concatenate([*rows.values(), np.zeros(0)]), np.zeros(k))

        return PackedModel(self.langs, [entries(self.words), *(entries(self.grams.get(n, {})) for n in range(1, max(self.grams, default=0) + 1))])


class Scorer:
    """Sums token scores of texts; a task's tokens are scored once as long as they fit."""

    def __init__(self, model: PackedModel | LanguageModel, most_tokens: int = 300_000) -> None:
        self.model, self.most = model.packed() if isinstance(model, LanguageModel) else model, most_tokens
        self._clear()

    def _clear(self) -> None:
        new: list[str] = []

        class Codes(dict):
            def __missing__(self, token):
                self[token] = code = len(self)
                new.append(token)
                return code

        self.codes, self.new, self.matrix, self.filled = Codes(), new, np.zeros((0, len(self.model.langs))), 0

    def _sum(self, tokens: list[str]) -> np.ndarray:
        if len(self.codes) > self.most:
            self._clear()
        codes = np.fromiter(map(self.codes.__getitem__, tokens), np.int64, len(tokens))
        if self.new:
            rows, need = self.model.of_tokens(self.new), self.filled + len(self.new)
            if len(self.matrix) < need:
                # grown in steps, so that appending stays linear
                room = np.zeros((need + need // 2 + 20_000, len(self.model.langs)))
                room[: self.filled] = self.matrix[: self.filled]
                self.matrix = room
            self.matrix[self.filled : need] = rows
            self.filled = need
            self.new.clear()
        return self.matrix[codes].sum(0)

    def score(self, text: str | None, block: int = 50_000) -> tuple[str, float]:
        """(language, its probability); equal sums go to the language that sorts first. Long texts are summed ``block``
        tokens at a time."""
        if not text or not self.model.langs or not any(map(str.isalpha, text)):
            return NONE, 0.0
        tokens = text.split()
        total = np.zeros(len(self.model.langs))
        for at in range(0, len(tokens), block):
            total += self._sum(tokens[at : at + block])
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


@dataclass(frozen=True)
class LanguageTrainer:
    """``per_lang``: most labelled documents of a language that are learned from, chosen by hash of id and text;
    ``longest``: of the n-grams. Every word and n-gram of these documents is in the model."""

    per_lang: int = 3000
    longest: int = 5

    def sample(self, docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
        """(text, lang) of the documents that are learned from."""
        labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
        labelled = labelled.select(F.xxhash64(doc_id, text).alias("h"), F.col(text).alias("text"), F.col(lang).alias("lang"))
        sizes = {r.lang: max(1, r.n) for r in labelled.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
        if not sizes:
            return labelled.select("text", "lang")
        # about twice the number, of which the rank takes as many as are wanted
        share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, int((1 << 20) * min(1.0, 2 * self.per_lang / n)))))
        near = labelled.where(F.pmod("h", F.lit(1 << 20)) < F.element_at(share, F.col("lang"))).dropDuplicates(["lang", "h"])
        rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
        return near.withColumn("rank", rank).where(F.col("rank") <= self.per_lang).select("text", "lang")

    def counts(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
        """(lang, n, gram, c), written: words (n = 0) by their occurrences, n-grams by the different words that have them
        and how often they do."""

        def count(batches):
            for whole in batches:
                for batch in slices(whole, "text", 8_000_000):
                    words: Counter = Counter()
                    for t, x in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                        words.update((x, w) for w in LETTERS.findall(t.lower()))
                    x, w = zip(*words, strict=True) if words else ((), ())
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()), pa.array(w, pa.string()), pa.array(words.values(), pa.int64())], names=["lang", "gram", "c"])

        found = self.sample(docs, doc_id, text, lang).mapInArrow(count, "lang string, gram string, c long")
        words = cut(found.groupBy("lang", "gram").agg(F.sum("c").alias("c")))
        framed = F.concat(F.lit("^"), "gram", F.lit("$"))

        def of_length(n: int):
            """All n-grams of a framed word, none if it is shorter."""
            starts = F.filter(F.sequence(F.lit(1), F.char_length(framed)), lambda i: i + (n - 1) <= F.char_length(framed))
            return F.transform(starts, lambda i: F.struct(F.lit(n).alias("n"), F.substring(framed, i, F.lit(n)).alias("gram")))

        every = [of_length(n) for n in range(1, self.longest + 1)]
        grams = words.select("lang", F.explode(F.concat(*every)).alias("x")).groupBy("lang", "x.n", "x.gram").agg(F.count("*").alias("c"))
        out = cut(words.select("lang", F.lit(0).alias("n"), "gram", "c").unionByName(grams))
        drop(words)
        return out

    def fit(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> PackedModel:
        """The model of at most ``per_lang`` documents a language; the same for any order and partitioning of ``docs``.

        Rows without a text or language teach nothing; without any other the model knows no language. Rows of equal id,
        text and language count once. Other columns are ignored.
        """
        counts = self.counts(docs, doc_id, text, lang)
        found = counts.toArrow()
        drop(counts)
        coded = found.column("lang").combine_chunks().dictionary_encode()
        names = coded.dictionary.to_pylist()
        langs = sorted(names)
        code = np.array([langs.index(x) for x in names], dtype=np.int64)[coded.indices.to_numpy()]
        n, c = (found.column(k).to_numpy() for k in ("n", "c"))
        grams = found.column("gram").to_pylist()
        tables = []
        for k in range(self.longest + 1 if langs else 0):
            some = np.flatnonzero(n == k)
            tables.append(Entries.counted([grams[i] for i in some.tolist()], code[some], c[some].astype(np.float64), len(langs)))
        return PackedModel(langs, tables)


def identify(docs: DataFrame, model: PackedModel | LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), slice_bytes: int = 4_000_000) -> DataFrame:
    """``keep`` with lang_pred and score for each row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if no language was learned.
    Equal scores go to the language that sorts first. Texts of any length are scored whole. Every row stands for itself;
    input columns named like an output are replaced.
    """
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches):
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole, text, slice_bytes):
                found = [scorer.score(t.as_py()) for t in batch.column(text)]
                lang, score = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{kinds}lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: a null id is in no fold, so such documents are learned from; nulls, empty and long texts, ties
    and repeated rows as in ``identify``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 3) == 1)
    model = LanguageTrainer().fit(docs.where(~F.col("held_out")))
    return identify(docs, model, keep=("doc_id", "held_out"))
