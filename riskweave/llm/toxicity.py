"""Toxicity by non-negative positive-unlabelled learning.

Linear classifiers over hashed words are trained with numpy from confirmed
toxic texts and unlabelled texts.  The risk is corrected with the class prior
``pi``:  ``R = pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))``; where the second
term turns negative the step goes against it instead, which keeps a flexible
model from fitting the positives hidden in the unlabelled texts as negatives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import carried, carried_schema, restored

BITS = 17
#: Leading characters of a word that form a feature of their own.
STEM = 5
MEMBERS = 3
#: Bounds of the training sample: confirmed toxic and unlabelled texts.
MAX_POSITIVE = 3000
MAX_UNLABELLED = 9000
#: A feature is used if it occurs in this many confirmed texts at least, …
MIN_TEXTS = 4
#: … this many times as often in them as in the unlabelled ones, …
MIN_RATIO = 2.0
#: … and by so many standard errors more often.
MIN_ERRORS = 4.0

_WORD = re.compile(r"\w+")


def features(text: str) -> set[str]:
    """Lower-case words of a text and the stems of its longer words."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


def slot(feature: str, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(feature, seed) & ((1 << BITS) - 1)


def hashed(text: str, seed: int) -> np.ndarray:
    """Distinct feature slots of a text, ascending."""
    return np.unique(np.array([slot(f, seed) for f in features(text)], dtype=np.int32))


def train_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int,
               epochs: int = 150, rate: float = 0.1, batches: int = 8,
               decay: float = 1e-6) -> np.ndarray:
    """Weights (``1 << BITS`` of them and the bias) of one linear classifier.

    Sigmoid loss, Adam, mini-batches that hold their share of both samples,
    over the features that confirmed texts have clearly more often; words
    that say nothing would only push every score to the same end.
    Without positive texts, or without any text, the classifier says no.
    """
    dim = 1 << BITS
    w = np.zeros(dim + 1)
    w[-1] = -1.0
    if not positive or not unlabelled:
        return w
    n_p, n_u = len(positive), len(unlabelled)
    in_p = np.bincount(np.concatenate(positive), minlength=dim)
    share_p, share_u = in_p / n_p, np.bincount(np.concatenate(unlabelled), minlength=dim) / n_u
    both = (share_p * n_p + share_u * n_u) / (n_p + n_u)
    error = np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    slots = np.flatnonzero((in_p >= MIN_TEXTS) & (share_p >= MIN_RATIO * share_u)
                           & (share_p - share_u >= MIN_ERRORS * error))
    back = np.full(dim, -1, np.int64)
    back[slots] = np.arange(len(slots))

    def compact(rows):
        return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    positive = [r[r >= 0] for r in (back[x] for x in positive)]
    unlabelled = [r[r >= 0] for r in (back[x] for x in unlabelled)]
    rng = np.random.default_rng(seed)
    v, b = np.zeros(len(slots)), 0.0
    m1, m2 = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    step = 0
    k = max(1, min(batches, n_p, n_u))
    for _ in range(epochs):
        parts = zip(np.array_split(rng.permutation(n_p), k), np.array_split(rng.permutation(n_u), k))
        for ip, iu in parts:
            col, row = compact([positive[i] for i in ip] + [unlabelled[i] for i in iu])
            n = len(ip) + len(iu)
            g = np.bincount(row, weights=v[col], minlength=n) + b
            s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))  # loss of calling it clean is s, toxic 1 - s
            slope = s * (1 - s)
            is_p = np.arange(n) < len(ip)
            risk = s[~is_p].mean() - prior * s[is_p].mean()
            if risk >= 0:
                d = np.where(is_p, -2 * prior / len(ip), 1 / len(iu)) * slope
            else:  # the corrected negative risk must not fall below zero: go back up
                d = np.where(is_p, prior / len(ip), -1 / len(iu)) * slope
            grad = np.append(np.bincount(col, weights=d[row], minlength=len(slots)) + decay * v, d.sum())
            step += 1
            m1 = 0.9 * m1 + 0.1 * grad
            m2 = 0.999 * m2 + 0.001 * grad * grad
            move = rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
            v -= move[:-1]
            b -= move[-1]
    w[slots] = v
    w[-1] = b
    return w


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls in ``fold``; a null id never does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> list[bytes]:
    """Train ``MEMBERS`` classifiers on a bounded sample outside the held-out fold.

    The sample is at most ``MAX_POSITIVE`` texts labelled toxic and
    ``MAX_UNLABELLED`` other texts, whatever their labels say, both drawn by
    the hash of the id; the prior is the share of toxic rows among the labels
    of the other folds.  Each classifier hashes with its own seed and is
    trained in its own task.  Only the ids of the sample (bounded) are
    broadcast and only the weights (bounded) reach the driver.
    """
    spark = docs.sparkSession
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isNotNull() & F.col("id").isNotNull() & ~in_fold("id", folds, fold)))
    counts = marks.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    prior = min(0.9, max(0.001, (counts[1] or 0) / max(1, counts[0])))
    draw = F.xxhash64(F.col("id"), F.lit(1))
    pos = (marks.where("toxic = 1").select("id").distinct().orderBy(draw, "id").limit(MAX_POSITIVE)
           .select("id", F.lit(1).alias("positive")))
    unl = (docs.select(F.col("doc_id").cast("long").alias("id"))
           .where(F.col("id").isNotNull() & ~in_fold("id", folds, fold))
           .distinct().orderBy(draw, "id").limit(MAX_UNLABELLED).select("id", F.lit(0).alias("positive")))
    picked = spark.createDataFrame([tuple(r) for r in pos.unionByName(unl).collect()], "id long, positive int")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    sample = (texts.join(F.broadcast(picked), "id")
              .select("positive", F.coalesce("text", F.lit("")).alias("text"))
              .withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1)))))

    def hash_texts(batches):
        for pdf in batches:
            pdf["slots"] = [hashed(t, int(m)).tobytes() for t, m in zip(pdf["text"], pdf["member"])]
            yield pdf[["member", "positive", "slots"]]

    def train(pdf):
        pdf = pdf.sort_values(["positive", "slots"])
        rows = [np.frombuffer(x, np.int32) for x in pdf["slots"]]
        is_p = pdf["positive"].to_numpy() == 1
        member = int(pdf["member"].iloc[0])
        w = train_nnpu([r for r, p in zip(rows, is_p) if p], [r for r, p in zip(rows, is_p) if not p],
                       prior, member)
        return type(pdf)({"member": [member], "w": [w.astype("<f4").tobytes()]})

    hashed_rows = sample.mapInPandas(hash_texts, "member int, positive int, slots binary")
    got = hashed_rows.groupBy("member").applyInPandas(train, "member int, w binary").collect()
    return [r["w"] for r in sorted(got, key=lambda r: r["member"])]


def score(docs: DataFrame, weights: list[bytes], id_col: str = "doc_id", text_col: str = "text",
          carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, score`` of every whole text: mean of the classifiers' sigmoids.

    The columns named in ``carry`` come along.

    Null and empty texts get the score of a text without words; repeated rows
    are scored each; ids may be null; further columns are ignored.  Without
    classifiers (no text to train on) every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights) if weights else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ws = [np.frombuffer(w, "<f4") for w in (shared.value if shared else [])]
        bias = np.array([w[-1] for w in ws], dtype=np.float64)
        cache: dict[str, tuple] = {}

        def weight(f):
            got = tuple(float(w[slot(f, m)]) for m, w in enumerate(ws))
            return got if any(got) else ()

        for batch in batches:
            out = []
            for text in batch.column(1):
                if not ws:
                    out.append(0.0)
                    continue
                if len(cache) > 400_000:
                    cache.clear()
                # a word's own features: itself and its stem, each counted once per text
                stems, total = set(), bias.copy()
                for w in set(_WORD.findall((text.as_py() or "").lower())):
                    got = cache.get(w)
                    if got is None:
                        stem = w[:STEM] + "*" if len(w) > STEM else ""
                        got = cache[w] = (weight(w), stem if stem and weight(stem) else "")
                    if got[0]:
                        total += got[0]
                    if got[1]:
                        stems.add(got[1])
                for f in stems:
                    total += weight(f)
                out.append(float((1 / (1 + np.exp(-np.clip(total, -500, 500)))).mean()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.float64()), *batch.columns[2:]],
                names=["doc_id", "score", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *carried(carry))
    out = rows.mapInArrow(run, carried_schema(rows, "doc_id long, score double"))
    return out.select("doc_id", "score", *restored(carry))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0,
             carry: Sequence[str] = ()) -> DataFrame:
    """Train, then score all: ``doc_id, held_out, score, predicted`` and ``carry``."""
    scored = score(docs, fit(docs, labels, folds, fold), carry=carry)
    return scored.select("doc_id", in_fold("doc_id", folds, fold).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), *carry)
