"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

Labels are split by crc32 of the document id: no row of the held-out fold (remainder 0) is
ever learned from. Of the others at most ``SAMPLE_ROWS`` labelled rows, those with the smallest
hash of the id, are used: remainders 1 and 2 teach the lexicon (words and word beginnings far
commoner in toxic documents), 3 the trees, 4 the calibration. Features are densities, not
texts: weights of lexicon hits, hits near a second-person pronoun, capitals, punctuation and
obfuscated words. Every document is read once for them; scoring is a Spark ML model.

Edge cases: null and empty texts have all-zero features and get a score like any other;
repeated rows give repeated results; null or conflicting labels: null is no label, of several
labels of one id the larger counts; without labels of both kinds the score is the smoothed
share of toxic labels (0 without any label); further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import text as tx
from tipoff.session import materialize

FOLDS = 5
SAMPLE_ROWS = 40_000  # bound of the labelled sample, 12 bytes a row where it is broadcast
LEXICON_TERMS = 4_096  # bound of the learned lexicon
LEXICON_ODDS = 2.0  # smoothed log-odds a term needs
PREFIXES = (4, 5, 6)  # lengths of word beginnings that may enter the lexicon
NEAR = 6  # words between a hit and a pronoun
CACHE_WORDS = 400_000

# Common insults, and second-person pronouns of four languages.
INSULTS = frozenset("idiot moron stupid trash scum loser clown pathetic worthless disgusting".split())
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "usted ustedes tú ti tus vosotros".split()
)
LEET = str.maketrans("013457@$!|", "oieastasii")

FEATURES = (
    "weight_rate", "weight_max", "weight_sum", "hit_rate", "hits", "insult_rate", "near_rate", "near_hits",
    "you_rate", "capital_rate", "shout_rate", "punct_rate", "mark_rate", "obfuscated_rate", "hidden_hits",
    "length",
)

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[a-zA-Z][0-9@$!|*.#_-]+[a-zA-Z]")


def fold(doc_id) -> F.Column:
    return (F.crc32(F.col(doc_id).cast("string")) % FOLDS).cast("int")


def terms(word: str) -> list[str]:
    """The word, and its beginnings marked by a trailing ``-``."""
    return [word, *[word[:n] + "-" for n in PREFIXES if len(word) > n]]


def learn_lexicon(docs: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Weights of at most ``LEXICON_TERMS`` terms; ``labels`` (doc_id, toxic) is a bounded sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter(), Counter()
        total = [0, 0]
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = {_EDGES.sub("", w) for w in set((text or "").lower().split())}
                found[label].update({t for w in seen if w for t in terms(w)})
                total[label] += 1
        keys = [t for t in found[1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*keys, *[t for t in found[0] if t not in found[1]], ""], pa.string()),
                pa.array([*[found[1][t] for t in keys], *[0 for t in found[0] if t not in found[1]], total[1]], pa.int64()),
                pa.array([*[found[0][t] for t in keys], *[found[0][t] for t in found[0] if t not in found[1]], total[0]], pa.int64()),
            ],
            ["term", "bad", "good"],
        )

    rows = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select(F.col("toxic").cast("int"), "text")
    sums = rows.mapInArrow(tx.releasing(count), "term string, bad long, good long").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    sums = materialize(sums)
    n = sums.where("term = ''").first()
    if n is None or not n.bad or not n.good:
        return {}
    odds = F.log((F.col("bad") + 0.5) / (n.bad + 1.0)) - F.log((F.col("good") + 0.5) / (n.good + 1.0))
    best = sums.where("term <> '' and bad >= 3").withColumn("w", odds).where(F.col("w") >= LEXICON_ODDS)
    best = best.orderBy(F.desc(F.col("w") * F.log1p("bad")), "term").limit(LEXICON_TERMS)
    return {r.term: float(r.w) for r in best.select("term", "w").collect()}


class _Words(dict):
    """What a blank-separated token means, computed once per distinct token of a task."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def __missing__(self, token: str):
        core = _EDGES.sub("", token)
        word = core.lower()
        weight = self.weight(word) if word else 0.0
        insult = word in INSULTS
        inner = bool(_INNER.search(core))
        hidden = False
        if inner and not weight:
            plain = re.sub(r"[\W\d_]", "", word), re.sub(r"[\W_]", "", word.translate(LEET))
            weight = max(self.weight(p) if p else 0.0 for p in plain)
            hidden = weight > 0 or any(p in INSULTS for p in plain)
        shout = len(core) > 2 and core.isupper()
        you = word in SECOND_PERSON
        value = (weight, insult, you, shout, inner, hidden) if weight or insult or you or shout or inner else None
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[token] = value
        return value


_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[65:91] = 1
_PUNCT = np.zeros(256, np.int64)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_MARKS = np.zeros(256, np.int64)
_MARKS[[33, 63]] = 1


def features_of(text: str, cache: _Words) -> list[float]:
    """The features of one text that need words; rates are per word."""
    tokens = text.split()
    if not tokens:
        return [0.0] * 13
    hits = [(i, v) for i, v in enumerate(map(cache.__getitem__, tokens)) if v is not None]
    n = len(tokens)
    weights = [(i, v[0]) for i, v in hits if v[0]]
    you = [i for i, v in hits if v[2]]
    near = 0
    if weights and you:
        at = np.array(you)
        where = np.array([i for i, _ in weights])
        left = np.searchsorted(at, where)
        gap = np.minimum(
            np.abs(at[np.minimum(left, len(at) - 1)] - where), np.abs(at[np.maximum(left - 1, 0)] - where)
        )
        near = int((gap <= NEAR).sum())
    total = sum(w for _, w in weights)
    return [
        total / n, max((w for _, w in weights), default=0.0), float(np.log1p(total)), len(weights) / n,
        float(np.log1p(len(weights))), sum(v[1] for _, v in hits) / n, near / n, float(np.log1p(near)),
        len(you) / n, sum(v[3] for _, v in hits) / n, sum(v[4] for _, v in hits) / n,
        float(np.log1p(sum(v[5] for _, v in hits))), float(np.log1p(n)),
    ]


def features(docs: DataFrame, lexicon: dict[str, float], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and one double per feature, from the whole text of every row."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += "".join(f", {f} double" for f in FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words(lexicon)
        for batch in batches:
            column = batch.column(len(keep))
            own = np.array([features_of(t or "", cache) for t in column.to_pylist()], float).reshape(-1, 13)
            rates = []
            for part in tx.slices(column):
                size = np.maximum(np.diff(part.offsets), 1)
                for table in (_CAPITAL, _PUNCT, _MARKS):
                    sums = np.concatenate([[0], np.cumsum(table[part.data])])
                    rates.append((sums[part.offsets[1:]] - sums[part.offsets[:-1]]) / size)
            three = [np.concatenate(rates[i::3]) if rates else np.zeros(0) for i in range(3)]
            out = [own[:, i] for i in range(9)] + [three[0], own[:, 9], three[1], three[2], own[:, 10], own[:, 11], own[:, 12]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *[pa.array(c, pa.float64()) for c in out]], [*keep, *FEATURES]
            )

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(tx.releasing(run), schema)


def sample(labels: DataFrame) -> DataFrame:
    """The bounded labelled sample: (doc_id, toxic, fold), one row per id."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic")
    )
    one = one.withColumn("fold", fold("doc_id")).where("fold <> 0")
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` rows as (doc_id, held_out, score, predicted)."""
    known = materialize(sample(labels))
    lexicon = learn_lexicon(docs, known.where("fold in (1, 2)").select("doc_id", "toxic"))
    rows = materialize(features(docs, lexicon).withColumn("held_out", F.coalesce(fold("doc_id") == 0, F.lit(False))))
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trained = rows.join(F.broadcast(known), "doc_id").withColumn("label", F.col("toxic").cast("double"))
    trained = materialize(trained)
    n = trained.agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad"),
        F.count_if(F.col("fold") == 3).alias("n3"), F.sum(F.when(F.col("fold") == 3, F.col("label"))).alias("bad3"),
    ).first()
    if not n.n or not n.bad3 or n.bad3 == n.n3:
        share = (n.bad or 0.0) / n.n if n.n else 0.0
        scored = rows.withColumn("score", F.lit(float(share)))
    else:
        trees = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=7, cacheNodeIds=True, subsamplingRate=1.0)
        model = trees.fit(vector.transform(trained.where("fold = 3")).select("features", "label"))

        def raw(df: DataFrame) -> DataFrame:
            out = model.transform(vector.transform(df))
            return out.withColumn("raw", vector_to_array("probability")[1])

        held = raw(trained.where("fold = 4")).select("raw", "label")
        if held.limit(1).count():
            steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(held)
            scored = steps.transform(raw(rows).drop("prediction"))
            # Steps of the calibration are flat; a thousandth of the raw score orders their rows.
            scored = scored.withColumn("score", 0.999 * F.col("prediction") + 0.001 * F.col("raw"))
        else:
            scored = raw(rows).withColumn("score", F.col("raw"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    base = sf_dir.rstrip("/")
    return score(spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet"))
