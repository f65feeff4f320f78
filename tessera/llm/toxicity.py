"""Toxicity scores from a weighted lexicon.

Texts are folded first: lower case, homoglyphs and digit substitutions to plain
letters, everything else between words to blanks. One Aho-Corasick pass finds
the lexicon's terms (whole words, and beginnings of words); exception phrases
take back the hits that they cover. The summed weight, as such and by the
text's length, goes through a logistic function.

The lexicon has a fixed part and a learnt part. Learning uses labelled rows
only, a bounded sample of them (about ``most`` rows, chosen by a hash of the id):
candidate terms are those in enough positive texts that chance can't explain
it, near copies counting once; negatives are then searched for the candidates.
Texts stay on the executors: what reaches the driver are the candidate terms,
their counts, and the counts of equal features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, batch, compact, parts, prepare, small_join, texts_of
from tessera.llm.components import components

#: Terms that count without any labels (weight in natural log odds), and phrases in which they don't count.
TERMS = {"idiot": 6.0, "idiots": 6.0, "moron": 6.0, "morons": 6.0, "imbecile": 6.0, "stupid": 5.0, "scum": 5.0, "loser": 5.0, "losers": 5.0, "worthless": 4.0, "pathetic": 4.0, "disgusting": 4.0, "trash": 3.0, "clown": 3.0, "dumbass": 6.0, "scumbag": 6.0}
EXCEPTIONS = ["clown fish", "circus clown", "trash can", "trash bag", "trash bin", "idiot proof", "pathetic fallacy"]
#: Look-alike letters of other alphabets, and signs that stand for letters.
HOMOGLYPHS = {"а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
FOLD = {i: " " for i in range(0x80) if not chr(i).isalnum()} | {ord(a): b for a, b in (HOMOGLYPHS | SUBSTITUTES).items()} | {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)} | {0x00A0: " ", 0x2019: " ", 0x200B: "", 0x200C: "", 0x200D: "", 0x00AD: "", 0xFEFF: ""}
MOST_ROWS = 30_000
_PREFIXES = range(4, 8)
_MINIMA = 8
#: Texts of a class of near copies that one task takes.
CLASS_ROWS = 200


def fold(text: str) -> str:
    return f" {text.lower().translate(FOLD)} "


class Lexicon:
    """terms: {term: weight}, where a term is " word " or " beginning"; curve: coefficients of 1, log(1 + weight), log(1 + weight a hundred words)."""

    def __init__(self, terms: dict[str, float], exceptions: list[str] = EXCEPTIONS, curve=(-4.0, 2.0, 1.0)):
        self.terms, self.exceptions, self.curve = terms, exceptions, tuple(curve)
        self.auto = None

    def __getstate__(self):
        return self.terms, self.exceptions, self.curve

    def __setstate__(self, state):
        self.__init__(*state)

    def automaton(self):
        if self.auto is None:
            auto = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                auto.add_word(term, (len(term), weight, ""))
            for phrase in self.exceptions:
                auto.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, phrase))
            auto.make_automaton()
            self.auto = auto
        return self.auto

    def weigh(self, folded: str) -> float:
        """The weight of all hits: one hit a word, the heaviest; none inside an exception phrase."""
        hits = list(self.automaton().iter(folded))
        if not hits:
            return 0.0
        spared = [(end - n + 1, end) for end, (n, _, phrase) in hits if phrase]
        at: dict[int, float] = {}
        for end, (n, weight, phrase) in hits:
            start = end - n + 1
            if not phrase and not any(a <= start and end <= z for a, z in spared):
                at[start] = max(at.get(start, 0.0), weight)
        return sum(at.values())

    def features(self, text: str) -> tuple[float, float]:
        folded = fold(text)
        w = self.weigh(folded)
        return (math.log1p(w), math.log1p(100 * w / max(1, folded.count(" ") - 1))) if w else (0.0, 0.0)

    def score(self, text: str) -> float:
        a, b = self.features(text)
        return 1 / (1 + math.exp(-(self.curve[0] + self.curve[1] * a + self.curve[2] * b)))


def minima(text: str) -> list[int]:
    """Eight minima of hashed word triples of a folded text. Texts that share one count as near copies."""
    h = np.array([zlib.crc32(w.encode()) for w in text.split()] or [0], np.uint64)
    if len(h) > 2:
        h = h[:-2] * np.uint64(0xD6E8FEB86659FD93) + h[1:-1] * np.uint64(0xA0761D6478BD642F) + h[2:] * np.uint64(0xE7037ED1A0B428DB)
    return [int(((h * np.uint64(2 * k + 0x9E3779B97F4A7C15)) >> np.uint64(7)).min()) for k in range(_MINIMA)]


def classed(positives: DataFrame) -> DataFrame:
    """(class, text) of the different texts: near copies, linked through shared minima, are one class."""
    schema = pa.schema([("t", pa.int64()), ("k", pa.int32()), ("m", pa.int64())])

    def run(batches):
        for b in batches:
            t, n = b.column(0), b.num_rows
            m = [x for text in texts_of(b.column(1)) for x in minima(fold(text))]
            yield batch(schema, np.repeat(t.to_numpy(), _MINIMA), np.tile(np.arange(_MINIMA, dtype=np.int32), n), m)

    texts = positives.select(F.xxhash64("text").alias("t"), "text").dropDuplicates(["t"])
    shared = compact(arrow_map(texts, run, "t long, k int, m long"), "minima", 500_000)
    least = compact(shared.groupBy("k", "m").agg(F.min("t").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "least", 500_000)
    links = small_join(shared, least, ["k", "m"]).where("a <> t").select("a", F.col("t").alias("b"))
    own = components(links).withColumnRenamed("node", "t")
    return texts.join(own, "t", "left").select(F.coalesce("component", "t").alias("class"), "text")


def features_of(texts) -> set[str]:
    """The whole words and the beginnings of words in some folded texts."""
    out = set()
    for text in texts:
        for w in set(text.split()):
            if len(w) >= 3:
                out.add(f" {w} ")
                out.update(f" {w[:n]}" for n in _PREFIXES if len(w) > n)
    return out


def candidates(positives: DataFrame, negatives: int) -> dict[str, int]:
    """Terms with the number of classes of positive texts that have them, where chance explains less than one term in a hundred.

    A class counts a term once. A task takes whole classes; a class of more
    than CLASS_ROWS texts is dealt over several, whose terms meet again.
    """
    schema = pa.schema([("class", pa.int64()), ("term", pa.string()), ("n", pa.int64())])

    def run(batches):
        where: Counter = Counter()
        now, dealt, own = None, False, set()

        def closed() -> list[pa.RecordBatch]:
            if not dealt:
                where.update(own)
                return []
            return [batch(schema, [now] * len(own), list(own), [1] * len(own))]

        for b in batches:
            for k, text, deals in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist(), strict=True):
                if k != now:
                    yield from closed()
                    now, dealt, own = k, deals > 1, set()
                own |= features_of([fold(text)])
        yield from closed()
        names = list(where)
        for x in (names[i : i + 50_000] for i in range(0, len(names), 50_000)):
            yield batch(schema, [None] * len(x), x, [where[t] for t in x])

    classes = compact(classed(positives), "positives", 2_000)
    sizes = compact(classes.groupBy("class").agg(F.ceil(F.count("*") / CLASS_ROWS).cast("int").alias("deals")), "sizes", 500_000)
    n = sizes.count()
    rows = small_join(classes, sizes, "class").select("class", "text", "deals")
    dealt = rows.repartition(parts(rows.sparkSession), "class", F.pmod(F.xxhash64("text"), "deals")).sortWithinPartitions("class")
    counts = arrow_map(dealt, run, "class long, term string, n long").groupBy("class", "term").agg(F.sum("n").alias("n"))
    counts = compact(counts.groupBy("term").agg(F.sum(F.when(F.col("class").isNull(), F.col("n")).otherwise(1)).alias("n")).where("n >= 3"), "terms", 500_000)
    least = max(3, math.log(100 * max(1, counts.count())) / math.log((n + negatives + 1) / (n + 0.5)))
    return {r.term: r.n for r in counts.where(F.col("n") >= least).collect()}


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_ROWS) -> Lexicon:
    """A lexicon fitted to the labelled rows (label 0 or 1; an id with both labels and null labels don't count).

    Fewer than five rows of a label, or empty tables, leave the fixed lexicon. Repeated rows of docs count as one text.
    """
    prepare(docs.sparkSession)
    rows = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    n = rows.count()
    step = max(1, -(-n // most))
    base = {f" {t} ": w for t, w in TERMS.items()}
    if not n:
        return Lexicon(base)
    rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).limit(2 * most)
    # the sample's texts are read from the corpus once
    sample = compact(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text <> ''").join(F.broadcast(rows), "id"), "sample", 2_000)
    n_pos, n_neg = sample.where("label = 1").count(), sample.where("label = 0").count()
    if n_pos < 5 or n_neg < 5:
        return Lexicon(base)
    support = candidates(sample.where("label = 1").select("text"), n_neg)
    probe = Lexicon({t: 1.0 for t in support}, [])
    counts = negative_counts(sample.where("label = 0").select("text"), probe)
    terms: dict[str, float] = {}
    letters = sorted({c for t in support for c in t} - {" "})
    for t in sorted(support, key=lambda t: (len(t.rstrip(" ")), t)):
        weight = math.log((support[t] + 0.5) / (n_pos + 1)) - math.log((counts.get(t, 0) + 0.5) / (n_neg + 1))
        if weight >= math.log(30) and counts.get(t, 0) <= 0.02 * support[t] and not any(t[:k] in terms for k in range(5, len(t) + 1)):
            # the longest beginning with the same support says the same and spares more other words
            while longer := next((x for x in (t + " ", *(t + c for c in letters)) if support.get(x) == support[t]), None):
                t = longer
            terms[t] = min(8.0, weight)
    own = Lexicon(terms | {t: max(w, terms.get(t, 0)) for t, w in base.items()})
    return Lexicon(own.terms, own.exceptions, curve_of(sample.select("text", "label"), own))


def negative_counts(texts: DataFrame, probe: Lexicon) -> dict[str, int]:
    """The number of texts that have each term: counted in each task, then summed; a row for each candidate term at most reaches the driver."""
    names = sorted(probe.terms)
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def run(batches):
        auto = ahocorasick.Automaton()
        for i, t in enumerate(names):
            auto.add_word(t, i)
        total = np.zeros(len(names), np.int64)
        if names:
            auto.make_automaton()
            for b in batches:
                for text in texts_of(b.column(0)):
                    total[list({i for _, i in auto.iter(fold(text))})] += 1
        some = np.flatnonzero(total)
        yield batch(schema, some.astype(np.int32), total[some])

    return {names[r.term]: r.n for r in arrow_map(texts, run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}


def curve_of(sample: DataFrame, lexicon: Lexicon) -> tuple[float, ...]:
    """Logistic coefficients by Newton's method with a small penalty, over the bounded sample's features."""
    schema = pa.schema([("a", pa.float64()), ("b", pa.float64()), ("label", pa.int32())])

    def run(batches):
        for x in batches:
            f = [lexicon.features(t) for t in texts_of(x.column(0))]
            yield batch(schema, [a for a, _ in f], [b for _, b in f], x.column(1))

    got = arrow_map(sample, run, "a double, b double, label int").groupBy("a", "b", "label").count().collect()
    got.sort(key=tuple)
    x = np.array([[1, r.a, r.b] for r in got])
    y, n = np.array([r.label for r in got], float), np.array([r["count"] for r in got], float)
    c = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        grad = x.T @ (n * (y - p)) - 0.05 * c
        c = c + np.clip(np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3), grad), -2, 2)
    return tuple(c.tolist())


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score (0 to 1) of each row. Null and empty texts have no hits and score as such; whole texts of any length are read; repeated rows score each; an empty table gives no rows; other columns are not read."""
    prepare(docs.sparkSession)
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            yield batch(schema, b.column(0), [lexicon.score(t) for t in texts_of(b.column(1))])

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), run, "id long, score double").withColumnRenamed("id", id_col)


def with_score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", to: str = "score") -> DataFrame:
    """docs with a score column; all its columns stay."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts):
        return texts.map(lambda t: lexicon.score(t or ""))

    return docs.withColumn(to, scored(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(3)) == 1
