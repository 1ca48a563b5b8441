import time

import pytest
from tests.llm.data import corpus, docs

from riskweave import session
from riskweave.llm import substrings
from riskweave.llm.queries import SQL
from riskweave.llm.substrings import dedup_substrings


def brute(rows, window):
    seen = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for j in range(len(w) - window + 1):
                key = tuple(w[j:j + window])
                seen[key] = min(seen.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for j in range(len(w) - window + 1):
                if seen[tuple(w[j:j + window])] < i:
                    gone.update(range(j, j + window))
        out.append((str(i), len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out)


def test_against_brute_force(spark):
    for seed, window in ((1, 13), (2, 5)):
        rows = corpus(seed)
        got = dedup_substrings(docs(spark, rows).repartition(4), window, carry=("lang", "kept")).drop("lang")
        out = sorted((str(r[0]), r[1], r[2], r[3]) for r in got.collect())
        assert out == brute(rows, window)
        assert sum(x[2] for x in out) > 0


def test_spans_name_the_words_and_an_earlier_document(spark):
    rows = [(9, "x " + " ".join("abcdefghijklmnop") + " y"), (4, " ".join("abcdefghijklmnop"))]
    got = {r.doc_id: r for r in dedup_substrings(docs(spark, rows)).collect()}
    assert [tuple(s) for s in got[9].spans] == [(1, 16, 4)] and got[9].kept == "x y"
    assert got[4].spans == [] and got[4].n_removed == 0


def test_empty_table_and_sql(spark):
    assert dedup_substrings(docs(spark, [])).count() == 0
    assert "op3_substring_dedup" in SQL


def test_a_source_holds_the_whole_span(spark):
    p = [f"p{i}" for i in range(40)]
    rows = [(-5, " ".join(p[:20])), (-4, " ".join(p)), (-3, "x " + " ".join(p)),
            (-2, " ".join([*p[20:40], "between", *p[:20]])), (-1, " ".join([*p[20:40], *p[:20]]))] + corpus(3)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(b" " + b" ".join((t or "").encode().split()) + b" ")
    out = dedup_substrings(docs(spark, rows).repartition(4)).collect()
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in out}
    assert got[-4] == [(0, 20, -5)] and got[-3] == [(1, 20, -5), (9, 32, -4)]
    assert got[-2] == [(0, 20, -4), (21, 20, -5)]
    for i, spans in got.items():
        for start, length, source in spans:
            run = [b" " + b" ".join(t.split()[start:start + length]) + b" " for t in texts[i]]
            assert source < i and any(r in t for r in run for t in texts[source])


def greedy(rows, window, block):
    """Plain greedy parse: at each word the longest match against every block of the reference."""
    texts = {i: (t or "").encode().split() for i, t in rows if i is not None}
    blocks, held = {}, set()
    for i in sorted(texts):
        for j in range(len(texts[i]) - window + 1):
            phrase = tuple(texts[i][j:j + window])
            if phrase not in held:
                held.add(phrase)
                blocks.setdefault((i, j // block), {})[j] = phrase
    out = {}
    for i, w in texts.items():
        phrases = [tuple(w[j:j + window]) for j in range(len(w) - window + 1)]
        out[i], j = [], 0
        while j < len(phrases):
            best = (0,)
            for (source, _), places in blocks.items():
                for at in places if source < i else ():
                    n = 0
                    while j + n < len(phrases) and places.get(at + n) == phrases[j + n]:
                        n += 1
                    best = max(best, (n, source, at))
            if best[0]:
                out[i].append((j, best[0] + window - 1, best[1], best[2]))
            j += max(1, best[0])
    return out


@pytest.mark.parametrize("block", [4096, 8])
def test_spans_are_the_longest_factors_over_all_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", block)
    p = [f"p{i}" for i in range(40)]
    short = [(i, t) for i, t in corpus(6, 30) if t is None or len(t.split()) < 200]
    rows = [(-5, " ".join(p[:20])), (-4, " ".join(p)), (-3, "x " + " ".join(p)),
            (-2, " ".join([*p[25:40], *p[3:30], "y", *p[:14]]))] + short
    out = dedup_substrings(docs(spark, rows).repartition(3)).where("doc_id is not null").collect()
    got = {r.doc_id: [(*s, at) for s, at in zip(r.spans, r.places, strict=True)] for r in out}
    assert got == greedy(rows, 13, block)
    assert sum(map(len, got.values())) > 10


def test_no_span_runs_from_one_row_of_an_id_to_another(spark):
    p = [f"p{i}" for i in range(40)]
    rows = [(1, " ".join(p[:20])), (1, " ".join([*(f"z{i}" for i in range(8)), *p[8:40]])), (2, " ".join(p))]
    got = {r.doc_id: r for r in dedup_substrings(docs(spark, rows)).where("doc_id = 2").collect()}[2]
    assert got.n_removed == 40 and got.kept == ""
    texts = [t.split() for i, t in rows if i == 1]
    for (start, length, source), at in zip(got.spans, got.places, strict=True):
        assert source == 1 and p[start:start + length] in [t[at:at + length] for t in texts]


def test_steps_leave_no_shuffle_files_and_only_the_hits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda _: str(tmp_path))
    spark.conf.unset(session._CLEANUP)

    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {x for x in map(str, (blocks.apply(i) for i in range(blocks.size()))) if x.startswith("shuffle")}

    before = shuffles()
    out = dedup_substrings(docs(spark, corpus(1)).repartition(4))
    end = time.time() + 20
    while (left := shuffles() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and spark.conf.get(session._CLEANUP) == "false"
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["hits"]
    assert out.where("n_removed > 0").count() > 0
