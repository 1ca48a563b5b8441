import pytest
from tests.llm.data import Union, corpus, docs, jaccard

from riskweave.llm import ngram_join
from riskweave.llm.ngram_join import banding, ngram_jaccard_join


def brute(rows, n, threshold):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    up, links = Union(), [0] * len(rows)
    for a in range(len(rows)):
        up.find(a)
        for b in range(a):
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                up.join(a, b)
    first = {}
    for a, (i, _) in enumerate(rows):
        r = up.find(a)
        if i is not None:
            first[r] = min(first.get(r, i), i)
    return sorted((str(i), str(first.get(up.find(a))), links[a]) for a, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [512, 3])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = corpus(4, 40)
    base = ("one two three four five six seven eight nine ten " * 3).split() + [f"t{i}" for i in range(40)]
    for i in range(12):  # a group of near copies larger than a block
        w = list(base)
        w[35 + 2 * i % 30] = f"edit{i}"
        rows.append((5000 + i, " ".join(w)))
    got = sorted((str(r[0]), str(r[1]), r[2]) for r in ngram_jaccard_join(docs(spark, rows)).collect())
    assert got == brute(rows, 5, 0.8)


def test_banding_meets_the_recall():
    for t, recall in ((0.8, 0.9999), (0.5, 0.9)):
        bands, rows = banding(t, recall)
        assert 1 - (1 - t ** rows) ** bands >= recall > 1 - (1 - t ** rows) ** (bands - 1)


def test_empty_table(spark):
    assert ngram_jaccard_join(docs(spark, [])).count() == 0
