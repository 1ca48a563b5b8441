"""Spelling variants against plain loops over all pairs."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import spelling
from riskweave.llm.queries import op11_spelling_variants
from riskweave.llm.spelling import near_words, spelling_variants, word_counts

from .data import DOC_SCHEMA


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, drop=31):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain(words):
    near_of = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            near_of[a].append(b)
            near_of[b].append(a)
    form = {}
    for w, k in words.items():
        top = min(near_of[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 10 * k else None
    out = []
    for w, k in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, k, len(near_of[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.choice([6, 7, 8, 9]))) for _ in range(60)]
    base += ["Straßenbahn", "façonner", "NAÏVETÉS", "ÀÀÀÀÀÀÀÀ", "x" * 3000, "x" * 2999 + "y", "aaaaaaaaaa", "aaaaaaaaaaa"]
    rows = []
    for i in range(150):
        some = [rng.choice(base[:1 + rng.randrange(len(base))]) for _ in range(30)]
        for k in range(len(some)):
            if rng.random() < 0.1 and len(some[k]) < 50:
                at = rng.randrange(len(some[k]))
                some[k] = some[k][:at] + rng.choice(["", "z", "zz"]) + some[k][at + 1:]
        rows.append((i, rng.choice([" ", "-", "1", "\n", "×÷"]).join(some) + ("." if i % 2 else "")))
    rows += [(500, None), (501, ""), (None, "Strassenbahn Strassenbahn"), (None, None), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(700 + i, "chainaaaa " * 300 + "chainaaab " * 20 + "chainaabb") for i in range(5)]  # forms of forms
    rows += [(600 + i, "Straßenbahn " * 30 + "aaaaaaaaaa " * 200) for i in range(3)]
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_all_pairs(spark, tmp_path, seed):
    rows = texts(seed)
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1, 2, "e", "k", 3, "y", "r", "v") for i, t in rows], DOC_SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op11_spelling_variants(spark, str(tmp_path)).collect()))
    assert got == plain(plain_words(rows))
    assert any(r[2] not in (r[0], r[1]) for r in got)


def links(spark, words, block):
    rows = spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(3).cache()
    return sorted(tuple(r) for r in near_words(rows, block=block).select("word", "n", "n_near", "best").collect())


@pytest.mark.parametrize("block, sample", [(4, 1 << 16), (32, 1 << 16), (32, 20), (10_000, 1 << 16)])
def test_blocks_lose_no_link(spark, monkeypatch, block, sample):
    """However finely the upper trees cut, and however few words they were made from."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abcd") for _ in range(rng.choice([5, 5, 6, 7]))): rng.randrange(1, 500) for _ in range(900)}
    words |= {"".join(p): 3 for p in itertools.islice(itertools.permutations("abcdefg"), 0, 5040, 11)}  # equal vectors
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    expected = []
    for w, k in words.items():
        mine = [x for x in words if near(w, x)]
        expected.append((w, k, len(mine), min(mine, key=lambda x: (-words[x], x), default=None)))
    assert links(spark, words, block) == sorted(expected)


def test_boxes_and_trees():
    """A box is reached by every vector within the distance of one of its own."""
    rng = np.random.default_rng(5)
    codes = rng.choice(np.array([97, 98, 99, 101, 233], np.uint32), (400, 9))
    vecs = spelling.vectors(codes)
    tree = spelling.Tree(vecs)
    found = {(int(a), int(b)) for q, m in tree.near(vecs, 1, 1) for a, b in zip(q, m)}
    true = {(i, j) for i in range(400) for j in range(400) if (codes[i] != codes[j]).sum() <= 1}
    assert true <= found and len(found) < 400 * 400 / 2
    nodes = spelling.upper_tree(vecs, 16)
    assert len({b for bit, b in nodes if bit is None}) >= 8
    own = spelling.own_block(nodes, vecs)
    at, to = spelling.reached_blocks(nodes, vecs, 1, 1)
    reached = set(zip(at.tolist(), to.tolist()))
    assert all((i, own[j]) in reached for i, j in true)


def test_words(spark):
    docs = spark.createDataFrame([(1, "Abcdefg abcdefg ABCDEFG Ébcdefg ébcdefg"), (None, "abcdefg"), (2, None)],
                                 "doc_id long, text string")
    assert {tuple(r) for r in word_counts(docs).collect()} == {("abcdefg", 4)}
    assert {tuple(r) for r in word_counts(docs, min_count=1).collect()} == {("abcdefg", 4), ("Ébcdefg", 1), ("ébcdefg", 1)}


def test_empty(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    out = spelling_variants(docs.withColumn("n", F.lit(1)))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
