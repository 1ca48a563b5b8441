"""Merkle manifest against a tree built row by row."""

import hashlib
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F

from riskweave.llm.merkle import folded, lower_ascii, manifest, proof_digest, siblings
from riskweave.llm.queries import LEAF_FIELDS, op12_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(hashes):
    """(root, path of each leaf as a list of (left, right))."""
    paths, owners, level = [[] for _ in hashes], [[i] for i in range(len(hashes))], list(hashes)
    while len(level) > 1:
        ups, ups_owners = [], []
        for a in range(0, len(level), 8):
            run = level[a:a + 8]
            for k in range(len(run)):
                for i in owners[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            ups.append(sha(*run))
            ups_owners.append([i for o in owners[a:a + 8] for i in o])
        level, owners = ups, ups_owners
    return (level[0] if level else None), paths


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
              for g in langs}
    trees = {g: tree([leaf(r) for r in v]) for g, v in groups.items()}
    root, above = tree([trees[g][0] for g in langs])
    out = []
    for g, up in zip(langs, above):
        for r, path in zip(groups[g], trees[g][1]):
            path = path + up
            now = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            at = leaf(now)
            for a, b in path:
                at = sha(a, at, b)
            out.append((r[0], leaf(r), trees[g][0], root, sha(*(a + b for a, b in path)), at, at == root))
    return out


def key(row):
    return tuple((x is not None, x) if not isinstance(x, bool) else (True, x) for x in row)


@pytest.mark.parametrize("rows", [
    [],
    [(5, "s", "en", 3, "Abc")],
    [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(9)],
    [(i, "s", ["en", "de", None, "", "ß", "z"][0 if i % 3 else i % 6], i, "Ä" * i + "Q") for i in range(200)],
    [(i, "s", f"l{i}", 1, "One") for i in range(70)],
    [(1, None, None, None, None)] * 3 + [(None, "a", "en", 1, "B"), (None, None, "en", None, ""), (1, "a", "en", 2, "B"),
                                         (1, "a", "en", 2, "B"), (1, "a", "en", 2, "C"), (2, "", "", 0, "")],
])
def test_equals_a_plain_tree(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    got = [tuple(r) for r in op12_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_long_text_clashing_names_and_carry(spark):
    rows = [(i, "s", "en", i, "X" * 300_000 if i == 4 else f"t{i}") for i in range(20)]
    plain = spark.createDataFrame(rows, SCHEMA)
    names = ("tree", "place", "hash", "n", "key", "salt", "run", "slot", "left", "right", "path", "root")
    wide = plain.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    out = manifest(wide, "lang", "doc_id", LEAF_FIELDS, carry=names[:3])
    assert {tuple(r)[-3:] for r in out.collect()} == {(0, 1, 2)}
    a = {r[0]: r[1] for r in out.select("doc_id", proof_digest(F.col("path"))).collect()}
    assert a == {r[0]: r[4] for r in expected(rows)}


def test_proof_fails_for_another_leaf_only(spark):
    rows = [(i, "s", "en" if i % 2 else "de", 1, "Word" if i % 5 else "word") for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = manifest(docs, "lang", "doc_id", LEAF_FIELDS, altered={"text": lower_ascii(F.col("text"))})
    rows = out.select("doc_id", "root", folded(F.col("path"), F.col("leaf")).alias("good"),
                      folded(F.col("path"), F.col("tampered")).alias("bad")).collect()
    assert all(r.good == r.root and (r.bad == r.root) == (r.doc_id % 5 == 0) for r in rows)


def test_windows_are_by_run(spark):
    """One group of most rows is as many windows as it has runs."""
    nodes = spark.range(4096).select(F.lit("1en").alias("tree"), F.col("id").alias("place"), F.lit(4096).cast("long").alias("n"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    plan = siblings(nodes)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\((tree#\d+, )?run#\d+L?,", plan)


def test_leaves_no_ranges_behind(spark):
    from riskweave.session import ensure_checkpoint_dir

    top = ensure_checkpoint_dir(spark).removeprefix("file://")
    docs = spark.createDataFrame([(i, "s", "en", 1, "t") for i in range(20)], SCHEMA)
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    manifest(docs, "lang", "doc_id", LEAF_FIELDS).count()
    new = {x.rsplit("-", 1)[0] for x in set(os.listdir(top)) - before}
    assert "merkle-leaves" not in new
