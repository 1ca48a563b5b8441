"""Exact top-k inner-product search by distributed histogram selection.

Vectors are kept in blocks.  A task scores one block of queries against one
block of candidates with a matrix product.  In each round it returns, per
query, how many of its scores fall into each bin of that query's current
range, for the bins that can still hold the k-th value; the sums over all
candidate blocks locate the bin of the k-th value, which becomes the next
round's range.  Once bins are single scores the k-th value is known; the last
pass keeps what lies above it and the smallest ids at it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.common import checkpoint, union_all
from riskweave.llm.vectors import block_count, block_of, clean_vectors, lengths_of

#: Rows of a block of queries and of a block of candidates.
QUERY_ROWS = 256
CANDIDATE_ROWS = 4096
#: Bins of one round.
BINS = 256
#: Scores up to here are exact in double precision.
EXACT = float(1 << 53)


def _pack(extra: str = ""):
    """Rows of one block → one row: ids, the matrix in its smallest integer type, lows."""

    def run(pdf):
        m = np.array(pdf["v"].tolist(), dtype=np.float64).astype(np.int64)
        top = int(np.abs(m).max(initial=0))
        kind = next(t for t in ("i1", "i2", "i4", "i8") if top <= np.iinfo(t).max)
        row = {"b": [int(pdf["b"].iloc[0])], "ids": [pdf["vec_id"].to_numpy().tobytes()],
               "kind": [kind], "m": [m.astype(kind).tobytes()]}
        if extra:
            row[extra] = [pdf[extra].to_numpy().tobytes()]
        return type(pdf)(row)

    return run


def _blocks(df: DataFrame, extra: str = "") -> DataFrame:
    schema = "b int, ids binary, kind string, m binary" + (f", {extra} binary" if extra else "")
    return df.groupBy("b").applyInPandas(_pack(extra), schema)


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["m"], row["kind"]).reshape(len(ids), -1)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    q, c = q.astype(np.float64), c.astype(np.float64)
    if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] < EXACT:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def exact_topk(vectors: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0,
               id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best candidates of every query, exactly.

    Components become ``floor(scale * x)``.  Queries are the rows whose id is
    divisible by ``every``; candidates all rows but those with the query's own
    id.  The score is the integer inner product; ties go to the smaller id,
    and a query with fewer candidates gets them all.  Returns ``query_id,
    rank`` (from 1)``, vec_id, score``.

    Rows with a null id or vector, or with a null or non-finite component,
    take no part; each length of vector is searched by itself; an id
    that occurs more than once counts with each of its rows as a candidate
    and with one of them (the smallest vector) as a query.  Other columns are
    ignored.  Scores must fit 64 bits.

    The work is queries times candidates, dealt out by blocks of both; a
    candidate block is repeated once per query block, and no task ever
    returns more than ``k`` scores or bins a query.
    """
    clean = clean_vectors(vectors, id_col, vec_col)
    clean = clean.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    clean = checkpoint(clean)
    queries = clean.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    found = [_search(clean.where(F.size("v") == n), queries.where(F.size("v") == n), k) for n in lengths_of(clean)]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return union_all(found)


def _search(clean: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The search among vectors of one length."""
    nq, nc = block_count(queries, QUERY_ROWS), block_count(clean, CANDIDATE_ROWS)

    longest = clean.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    half = int(longest * (1 + 1e-9)) + 2  # no score is larger, by Cauchy-Schwarz
    rounds, width = 1, 2 * half
    while width > BINS:
        rounds, width = rounds + 1, -(-width // BINS)

    cand = checkpoint(_blocks(clean.withColumn("b", block_of(nc, 2))))
    cand = cand.select("b", "ids", "kind", "m", F.lit(b"").alias("low"),
                       F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"), F.col("b").alias("cb"))

    def tasks(state):
        """Every query block beside every candidate block."""
        asked = _blocks(queries.join(state.withColumnRenamed("query_id", "vec_id"), "vec_id")
                        .withColumn("b", block_of(nq, 1)), "low")
        return asked.select("b", "ids", "kind", "m", "low", F.col("b").alias("qb"),
                            F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("cb")
                            ).unionByName(cand).groupBy("qb", "cb")

    def parts(pdf):
        q, c = pdf[pdf["low"].str.len() > 0], pdf[pdf["low"].str.len() == 0]
        if not len(q) or not len(c):
            return None
        qid, qm = _unpack(q.iloc[0])
        cid, cm = _unpack(c.iloc[0])
        return np.frombuffer(q["low"].iloc[0], np.int64), qid, cid, _scores(qm, cm), qid[:, None] == cid[None, :]

    def count(step):
        def run(pdf):
            """(query, bin, rows) for the bins from the top down to this block's k-th score."""
            got = parts(pdf)
            rows = []
            if got is not None:
                low, qid, _, s, own = got
                for i in range(len(qid)):
                    bins = (s[i][~own[i]] - low[i]) // step
                    # above the range counts into one bin on top of it; below it is out
                    n = np.bincount(np.minimum(bins[bins >= 0], BINS), minlength=BINS + 1)
                    above = np.cumsum(n[::-1])[::-1] - n
                    rows += [(int(qid[i]), int(b), int(n[b])) for b in np.flatnonzero((n > 0) & (above < k))]
            return type(pdf)(rows, columns=["query_id", "bin", "n"])

        return run

    def take(pdf):
        """What can be among the k best: scores from the k-th value on, best first."""
        got = parts(pdf)
        if got is None:
            return type(pdf)({"query_id": [], "vec_id": [], "score": []})
        kth, qid, cid, s, own = got
        ids, cids, scores = [], [], []
        for i in range(len(qid)):
            j = np.flatnonzero(~own[i] & (s[i] >= kth[i]))
            j = j[np.lexsort((cid[j], -s[i][j]))][:k]
            ids.append(np.full(len(j), qid[i]))
            cids.append(cid[j])
            scores.append(s[i][j])
        return type(pdf)({"query_id": np.concatenate(ids), "vec_id": np.concatenate(cids),
                          "score": np.concatenate(scores)})

    # each query's range starts as that of all possible scores
    state = checkpoint(queries.select(F.col("vec_id").alias("query_id"), F.lit(-half).cast("long").alias("low")))
    for step in (BINS ** r for r in reversed(range(rounds))):
        hist = (tasks(state).applyInPandas(count(step), "query_id long, bin int, n long")
                .groupBy("query_id", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))  # at most BINS + 1 rows a query
        kth = (hist.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= k)
               .groupBy("query_id").agg(F.max("bin").alias("bin")))
        # with fewer than k candidates everything counts: the range stays at its low end
        state = checkpoint(state.join(kth, "query_id", "left").select(
            "query_id", (F.col("low") + F.coalesce("bin", F.lit(0)).cast("long") * F.lit(step).cast("long")).alias("low")))
    best = tasks(state).applyInPandas(take, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows a candidate block at most
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
