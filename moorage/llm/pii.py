"""Personal data: base patterns with code-point spans, and sanitisation of terms that give protected entities away.

How much a term t discloses an entity e (a value of a base pattern) is its share of the entity's information:
PMI(e; t) / IC(e) = log(n(e,t) N / (n(e) n(t))) / log(N / n(e)) over documents of the corpus. Every term of an entity's documents is
rated. Terms that disclose more than a threshold, and more than chance would, are generalised or removed wherever they
occur in documents.

Everything is DataFrame expressions; the corpus counts cover all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut, drop
from moorage.llm.text import spare, table

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns, written so that they take linear time and no stack: a match can only start where a run of its
#: first characters starts (or where the last match ended), repeated groups are possessive, and a card of more than 19
#: digits is no match in any case.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a pattern to be tried at all.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{14}", "phone": r"\+[0-9]"}
BYTE_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CELL = 256
SPACE = r"[\x20\x09-\x0D]+"
LEADING = r"^[^\p{L}\p{N}]+"
EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
SPAN = "array<struct<kind:string,start:int,stop:int,value:string>>"


def luhn(digits: Column) -> Column:
    """Luhn's check of a string of digits."""
    value = lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    marks = F.transform(F.split(F.reverse(digits), ""), lambda c, i: value(c.cast("int"), i))
    return F.aggregate(marks, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{BYTE_PART}(?:\.{BYTE_PART}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.char_length(digits).between(16, 19) & luhn(digits)
    return F.char_length(digits).between(8, 15)


def bound(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often lambdas in it read it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def scanned(items: Column, zero: Column, step, out, kind: str) -> Column:
    """``out(state, item)`` for each item of an array, the state going from ``zero`` through ``step(state, item)``.

    Results are gathered in chunks of about the root of their number, so that long arrays don't take quadratic time.
    """
    none = F.array().cast(f"array<{kind}>")
    first = F.array(F.struct(zero.alias("state"), none.alias("out")))

    def whole(held: Column) -> Column:
        def run(chunk: Column) -> Column:
            def block(state: Column, i: Column) -> Column:
                start = F.struct(state.alias("state"), none.alias("out"))
                return F.aggregate(F.slice(held, i * chunk + 1, chunk), start, lambda a, x: F.struct(step(a["state"], x).alias("state"), F.concat(a["out"], F.array(out(a["state"], x))).alias("out")))

            chunks = F.when(F.size(held) > 0, F.sequence(F.lit(0), F.floor((F.size(held) - 1) / chunk).cast("int"))).otherwise(F.array().cast("array<int>"))
            blocks = F.aggregate(chunks, first, lambda a, i: F.concat(a, F.array(block(F.element_at(a, -1)["state"], i))))
            return F.flatten(F.transform(blocks, lambda b: b["out"]))

        return bound(F.ceil(F.sqrt(F.size(held) + 1)).cast("int"), run)

    return bound(items, whole)


def located(text: Column, pattern: str) -> Column:
    """Array of (start, stop, value) of all matches, in code points: gaps and matches alternate."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(values)), values, lambda g, v: F.struct(F.char_length(g).alias("gap"), F.char_length(v).alias("size"), v.alias("value")))
    return scanned(
        pairs,
        F.lit(0),
        lambda at, x: at + x["gap"] + x["size"],
        lambda at, x: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("stop"), x["value"].alias("value")),
        "struct<start:int,stop:int,value:string>",
    )


def cells_of(text: Column) -> Column:
    """Array of (start, cell): a text in cells of about ``CELL`` characters that end where a word does, white space being
    single spaces, and where each starts. Counting up to a word of a cell is a short way."""
    cells = F.regexp_extract_all(F.translate(text, "\t\n\u000b\f\r", " " * 5), F.lit(rf"(?s).{{1,{CELL}}}(?![^ ])|[^ ]++| ++"), F.lit(0))
    return scanned(cells, F.lit(0), lambda at, c: at + F.char_length(c), lambda at, c: F.struct(at.alias("start"), c.alias("cell")), "struct<start:int,cell:string>")


def base_spans(text: str) -> dict[str, Column]:
    """One array of spans for each kind; empty for texts without the kind, null and empty texts."""
    out = {}
    for kind in KINDS:
        typed = F.transform(F.filter(located(F.col(text), PATTERNS[kind]), _check(kind)), _typed(kind))
        out[kind] = F.when(F.col(text).rlike(HINTS[kind]), typed).otherwise(F.array().cast(SPAN))
    return out


def _check(kind: str):
    return lambda x: valid(kind, x["value"])


def _typed(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def term_of(word: Column) -> Column:
    """A word in lower case without what isn't a letter or digit at its edges."""
    return F.lower(F.regexp_replace(word, EDGES, ""))


def terms_of(text: str) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.split(F.col(text), SPACE), term_of))


@dataclass(frozen=True)
class Sanitiser:
    """``level``: chance at most that some term of an entity's documents stands in so many of them by accident;
    ``generalise`` and ``remove``: disclosure from which a term is replaced by its class or taken out;
    ``broadcast_rows``: most terms that are broadcast, more are joined by sort-merge."""

    level: float = 0.05
    generalise: float = 0.9
    remove: float = 0.97
    broadcast_rows: int = 500_000

    def find(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, h: hash of the text, base: spans by kind and start, text where it has base spans), written."""
        found = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        found = found.withColumns({f"_{k}": c for k, c in base_spans("text").items()}).withColumn("base", F.concat(*(F.col(f"_{k}") for k in KINDS)))
        return cut(found.select("doc_id", F.xxhash64("text").alias("h"), "base", F.when(F.size("base") > 0, F.col("text")).alias("text")))

    def pairs(self, found: DataFrame) -> DataFrame:
        """(entity, term, n_et, n_e, tried), written: every term of every entity's documents, the documents with both
        and with the entity, and the number of such terms."""
        entities = F.array_distinct(F.transform("base", entity_of))
        held = found.where("text is not null").select(F.explode(entities).alias("entity"), terms_of("text").alias("terms"))
        n_e = held.groupBy("entity").agg(F.count("*").alias("n_e"))
        joint = held.select("entity", F.explode("terms").alias("term")).where(F.col("term").rlike(r"^(?=.*\p{L}).{3,}$") & ~F.col("term").contains("@"))
        joint = cut(joint.groupBy("entity", "term").agg(F.count("*").alias("n_et")))
        tried = joint.groupBy("entity").agg(F.count("*").alias("tried"))
        out = cut(joint.join(n_e.join(tried, "entity"), "entity"))
        drop(joint)
        return out

    def disclosing(self, docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame | None:
        """(word, term, ratio), written: words as they are written whose terms disclose some entity by at least
        ``generalise``; None if there are none."""
        close = self.pairs(found)
        if close.isEmpty():
            return None
        n = float(docs.count())
        # documents, however many forms of the term each has
        counts = docs.select(F.explode(terms_of(text)).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
        facts = close.join(counts, "term")
        information = F.ln(F.lit(n) / F.col("n_e"))
        ratio = F.when(information > 0, F.ln(F.col("n_et") * n / (F.col("n_e") * F.col("n_t"))) / information).otherwise(F.lit(0.0))
        # Chernoff's bound of the chance that n_et or more of n_e documents have a term that n_t of n have
        a, q = F.col("n_et") / F.col("n_e"), F.col("n_t") / n
        rest = F.when((a < 1) & (q < 1), (1 - a) * F.ln((1 - a) / (1 - q))).otherwise(F.lit(0.0))
        chance = -F.col("n_e") * (a * F.ln(a / q) + rest)
        sure = (a > q) & (chance + F.ln("tried") <= F.ln(F.lit(self.level)))
        rated = facts.where(sure).select("term", ratio.alias("ratio"))
        rated = cut(rated.groupBy("term").agg(F.max("ratio").alias("ratio")).where(F.col("ratio") >= self.generalise))
        words = docs.select(F.explode(F.array_distinct(F.split(F.col(text), SPACE))).alias("word")).distinct()
        # an inner join, as a semi join would be moved below the aggregation, to every word of every text
        out = cut(words.select("word", term_of(F.col("word")).alias("term")).join(self._bounded(rated), "term").select("word", "term", "ratio"))
        drop(close, rated)
        if out.isEmpty():
            drop(out)
            return None
        return out

    def term_spans(self, docs: DataFrame, flagged: DataFrame, text: str) -> DataFrame:
        """(h, terms: spans of flagged words by kind and start), written: only texts that have some.

        Flagged words that can't be broadcast are joined by sort-merge, and only with the words of texts that have some.
        """
        source = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("h"), F.col(text).alias("text"))
        flags, hit = self._bounded(flagged), None
        if flags is flagged:
            words = source.select("h", F.explode(F.array_distinct(F.split("text", SPACE))).alias("word"))
            hit = cut(words.join(flags.select("word"), "word").select("h").distinct())
            source = source.join(hit, "h")
        placed = source.select("h", F.inline(cells_of(F.col("text")))).select("h", "start", "cell", F.posexplode(F.split("cell", " ")).alias("at", "word"))
        placed = placed.where("word <> ''").join(flags, "word")
        bare = F.regexp_replace("word", LEADING, "")
        before = F.when(F.col("at") == 0, 0).otherwise(F.char_length(F.call_function("substring_index", F.col("cell"), F.lit(" "), F.col("at"))) + 1)
        start = F.col("start") + before + F.char_length("word") - F.char_length(bare)
        end = start + F.char_length(F.regexp_replace("word", EDGES, ""))
        kind = F.when(F.col("ratio") >= self.remove, F.lit("removed")).otherwise(F.lit("term"))
        span = F.struct(kind.alias("kind"), start.alias("start"), end.alias("stop"), F.col("term").alias("value"))
        out = cut(placed.groupBy("h").agg(F.array_sort(F.collect_set(span), by_kind).alias("terms")))
        if hit is not None:
            drop(hit)
        return out

    def spans(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, h, base, terms), one row for each row of ``docs``.

        ``base``: spans of the patterns by kind and start; ``terms``: spans of disclosing terms that don't touch them,
        of kind ``term`` (generalised) or ``removed``, by kind and start. ``h``: hash of the text, a null text counting as
        empty; equal texts have equal spans. Long texts take linear time. Repeated rows come back repeated, rows with a
        null or repeated id stay rows of their own, and other columns are ignored. A corpus without entities, or an empty
        one, adds no terms.
        """
        found = self.find(docs, doc_id, text)
        flagged = self.disclosing(docs, found, text)
        if flagged is None:
            return found.select("doc_id", "h", "base", F.array().cast(SPAN).alias("terms"))
        by_text = self._bounded(self.term_spans(docs, flagged, text))
        drop(flagged)
        rows = found.join(by_text, "h", "left")
        terms = F.when(F.col("terms").isNull(), F.array().cast(SPAN)).when(F.size("base") == 0, F.col("terms")).otherwise(apart(F.col("base"), F.col("terms")))
        return rows.select("doc_id", "h", "base", terms.alias("terms"))

    def sanitise(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` with spans of personal data in its texts replaced by their kind in brackets, generalised terms by
        [TERM] and removed ones by nothing. Where spans of two kinds overlap, the first one is replaced. Null texts stay
        null; texts without spans are unchanged; all other columns and rows stay."""
        spans = self.spans(docs, doc_id, text).where((F.size("base") > 0) | (F.size("terms") > 0))
        marked = cut(spans.select("h", F.array_sort(F.concat("base", "terms"), by_start).alias("spans")).dropDuplicates(["h"]))
        few = self._bounded(marked.select(F.col("h").alias(spare("h", docs.columns)), F.col("spans").alias(spare("spans", docs.columns))))
        rows = docs.join(few, F.xxhash64(docs[text]) == few[few.columns[0]], "left")
        clean = F.when(few[few.columns[1]].isNull() | docs[text].isNull(), docs[text]).otherwise(replaced(docs[text], few[few.columns[1]]))
        return rows.select(*(clean.alias(c) if c == text else docs[c] for c in docs.columns))

    def _bounded(self, written: DataFrame) -> DataFrame:
        """A hint to broadcast a written table if it has ``broadcast_rows`` rows at most; else it is joined as it is."""
        return F.broadcast(written) if written.count() <= self.broadcast_rows else written


def entity_of(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.lower(span["value"]))


def by_start(a: Column, b: Column) -> Column:
    return F.coalesce(F.nullif(a["start"] - b["start"], F.lit(0)), a["stop"] - b["stop"])


def by_kind(a: Column, b: Column) -> Column:
    """Generalised terms before removed ones."""
    return F.when(a["kind"] != b["kind"], F.when(a["kind"] == "term", -1).otherwise(1)).otherwise(by_start(a, b))


def apart(base: Column, terms: Column) -> Column:
    """The terms that touch no base span, in their order: none may start before an earlier base span ends, nor end after a
    later one starts."""
    item = lambda first: lambda x: F.struct(x["start"].alias("start"), F.lit(first).alias("late"), x["stop"].alias("stop"), x["kind"].alias("kind"), x["value"].alias("value"))
    kind = "struct<start:int,late:int,stop:int,kind:string,value:string>"
    none = F.lit(None).cast(kind)
    items = F.array_sort(F.concat(F.transform(base, item(0)), F.transform(terms, item(1))))
    upto = scanned(items, F.lit(0), lambda s, x: F.when(x["late"] == 0, F.greatest(s, x["stop"])).otherwise(s), lambda s, x: F.when((x["late"] == 0) | (x["start"] >= s), x).otherwise(none), kind)
    back = F.reverse(F.filter(upto, lambda x: x.isNotNull()))
    kept = scanned(back, F.lit(2147483647), lambda s, x: F.when(x["late"] == 0, F.least(s, x["start"])).otherwise(s), lambda s, x: F.when((x["late"] == 1) & (x["stop"] <= s), x).otherwise(none), kind)
    spans = F.transform(F.filter(kept, lambda x: x.isNotNull()), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value")))
    return F.array_sort(spans, by_kind)


def replaced(text: Column, spans: Column, cell: int = 4096) -> Column:
    """``text`` with marks for ``spans`` (by start); a span that begins within one before it is left out.

    The text is cut into cells of ``cell`` code points, so that taking a piece doesn't count from the text's start.
    """
    mark = lambda s: F.when(s["kind"] == "removed", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    cuts = scanned(
        spans,
        F.lit(0),
        lambda at, s: F.when(s["start"] < at, at).otherwise(s["stop"]),
        lambda at, s: F.struct(F.when(s["start"] >= at, at).alias("a"), s["start"].alias("b"), s["stop"].alias("stop"), mark(s).alias("mark")),
        "struct<a:int,b:int,stop:int,mark:string>",
    )

    def whole(cells: Column) -> Column:
        def piece(a: Column, b: Column) -> Column:
            i, j = F.floor(a / cell).cast("int"), F.floor(b / cell).cast("int")
            of = lambda k: F.coalesce(F.get(cells, k), F.lit(""))
            between = F.array_join(F.slice(cells, i + 2, F.greatest(j - i - 1, F.lit(0))), "")
            across = F.concat(F.substring(of(i), a % cell + 1, F.lit(cell)), between, F.substring(of(j), F.lit(1), b % cell))
            return F.when(a >= b, F.lit("")).when(i == j, F.substring(of(i), a % cell + 1, b - a)).otherwise(across)

        def pieces(kept: Column) -> Column:
            last = F.coalesce(F.get(kept, F.size(kept) - 1)["stop"], F.lit(0))
            return F.concat(F.array_join(F.transform(kept, lambda c: F.concat(piece(c["a"], c["b"]), c["mark"])), ""), piece(last, F.char_length(text)))

        return bound(F.filter(cuts, lambda c: c["a"].isNotNull()), pieces)

    return bound(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{cell}}}"), F.lit(0)), whole)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts, ties and repeated rows as in ``Sanitiser.spans``."""
    spans = Sanitiser().spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return spans.select("doc_id", *(of(k).alias(f"n_{k}") for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "terms")).alias("spans"))
