"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a probability, a logistic
function of its words; the document's is their noisy-or, so that labels of
documents train the scores of sentences, and a high document score can be
traced to the sentences that made it.

Fitting uses a bounded sample: the `max_docs` labelled rows of smallest hash of
their id (all, if there are fewer).  The words in the model are at most
`max_words`, those most tied to the label in the sample by chi-squared.  Words are
counted and sentences turned into numbers of words by Spark; the driver gets these
numbers, not texts.  Scoring
maps over all rows, whole texts, without a shuffle; what each task gets is the
word table, bounded by max_words.

Cases: null, empty or wordless text is one empty sentence and gets the score of
the constant alone; rows that repeat get the same score and count once in
fitting; labels that are null
are not used; no usable labels, or one class only, give the share of label 1
as every document's score (0 without labels).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, keep

MAX_DOCS, MAX_WORDS, MIN_DOCS = 4000, 300, 5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


@dataclass
class Model:
    constant: float = -30.0
    words: dict[str, float] = field(default_factory=dict)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit_bags(bags: list[tuple[int, list[list[int]]]], y: np.ndarray, n_words: int, rounds: int = 400, decay: float = 2e-3) -> tuple[float, np.ndarray]:
    """constant and weights; a bag is its number of sentences without model words, and the word numbers of the others."""
    doc, sent, word = [], [], []
    for d, (_, sentences) in enumerate(bags):
        for s in sentences:
            k = len(doc)
            doc.append(d)
            sent += [k] * len(s)
            word += s
    doc, sent, word = (np.array(x, np.int64) for x in (doc, sent, word))
    plain = np.array([b[0] for b in bags], float)
    x = np.zeros(n_words + 1)
    x[-1] = -4.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        w, b = x[:-1], x[-1]
        z = b + np.bincount(sent, w[word], len(doc))
        total = np.maximum(plain * softplus(b) + np.bincount(doc, softplus(z), len(bags)), 1e-9)
        e = np.exp(-total)
        slope = np.where(y == 1, -e / np.maximum(1 - e, 1e-9), 1.0) / len(bags)
        dz = slope[doc] / (1 + np.exp(-z))
        g = np.append(np.bincount(word, dz[sent], n_words) + decay * w / len(bags) * 10, dz.sum() + (slope * plain).sum() / (1 + math.exp(-b)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return float(x[-1]), x[:-1]


def bag(text: str | None, known) -> tuple[int, list[list]]:
    """The number of sentences without known words, and for the others what known gives for their words."""
    plain, others = 0, []
    for s in _SENTENCE.findall((text or "").lower()):
        words = [k for w in set(_WORD.findall(s)) if (k := known.get(w)) is not None]
        if words:
            others.append(words)
        elif not s.isspace():
            plain += 1
    return (plain, others) if plain or others else (1, [])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS) -> Model:
    """Fit on at most max_docs labelled documents; their texts stay with Spark, and numbers of words in sentences come to the driver."""
    chosen = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "y").limit(max_docs)
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "id").withColumn("fp", F.xxhash64("text"))
    # an id may stand with many texts: the limit is on pairs of them, by keys without texts
    order = [F.xxhash64("id"), "id", "y", "fp"]
    keys = cut(texts.select("id", "y", "fp").distinct().orderBy(*order).limit(max_docs))
    rows = keep(texts.join(F.broadcast(keys), ["id", "y", "fp"]).dropDuplicates(["id", "y", "fp"]))
    total = rows.agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")).first()
    n0, n1 = total["n0"], total["n1"]
    if not n0 or not n1:
        return Model(30.0 if n1 else -30.0)

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, t in zip(batch.column("y"), batch.column("text")):
                words = list(set(_WORD.findall(t.as_py().lower())))
                yield pa.RecordBatch.from_arrays([pa.array([y.as_py()] * len(words), pa.int32()), pa.array(words, pa.string())], names=["y", "word"])

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    c, d = n1 - a, n0 - b
    tied = F.pow(a * d - b * c, F.lit(2)) * (n0 + n1) / F.greatest((a + b) * (c + d) * n1 * n0, F.lit(1))
    counted = rows.select("y", "text").mapInArrow(distinct_words, "y int, word string").groupBy("word").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"))
    words = [r.word for r in counted.where(F.col("a") + F.col("b") >= MIN_DOCS).orderBy(tied.desc(), "word").limit(max_words).collect()]
    known = {w: k for k, w in enumerate(words)}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bag(t.as_py(), known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in ("id", "y", "fp")], pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.list_(pa.list_(pa.int32())))], names=["id", "y", "fp", "plain", "others"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    came = rows.select("id", "y", "fp", "text").mapInArrow(bags, f"id {kind}, y int, fp bigint, plain bigint, others array<array<int>>").orderBy(*order).select("y", "plain", "others").collect()
    constant, weights = fit_bags([(r.plain, r.others) for r in came], np.array([r.y for r in came]), len(words))
    return Model(constant, dict(zip(words, weights.tolist(), strict=True)))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep`, doc_id, score and offending: the sentences of probability 0.5 or more, as (start, end, probability) in code points."""
    from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

    names = [*keep, *([] if doc_id in keep else [doc_id]), *([] if text in (*keep, doc_id) else [text])]
    docs = docs.select(*names)
    out = [c for c in names if c in keep or c == doc_id]
    span = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("p", DoubleType())]))
    schema = StructType([*[docs.schema[c] for c in out], StructField("score", DoubleType()), StructField("offending", span)])
    constant, weights = model.constant, model.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = float(softplus(np.float64(constant)))
        vocabulary = set(weights)
        for b in batches:
            scores, spans = [], []
            for value in b.column(text):
                t = value.as_py() or ""  # lower-cased by sentence, as lower-casing may lengthen text and shift what follows
                found = []
                total = 0.0
                sentences = 0
                hit = vocabulary.intersection(_WORD.findall(t.lower()))
                for s in _SENTENCE.finditer(t):
                    part = s[0].lower()
                    if part.isspace():
                        continue
                    sentences += 1
                    z = 0.0
                    if hit:
                        z = sum([weights[w] for w in hit.intersection(_WORD.findall(part))])
                    if z:
                        total += float(softplus(np.float64(constant + z))) - base
                        if constant + z >= 0:
                            found.append({"start": s.start(), "end": s.end(), "p": 1 / (1 + math.exp(-constant - z))})
                total += max(sentences, 1) * base
                scores.append(min(max(1 - math.exp(-total), 0.0), 1.0))
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in out], pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))],
                names=[*out, "score", "offending"],
            )

    return docs.mapInArrow(run, schema)
