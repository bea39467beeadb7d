import random

import pytest
from pyspark.sql import functions as F

from storyspark.operators import similarity as S

WORDS = [f"w{c}x" for c in "abcdefghijklmnopqrstuv"]


def brute(rows):
    """Sequential seed clustering: cluster number per (date, seq)."""
    out = {}
    for date in {r[0] for r in rows}:
        seeds = []
        for _, seq, title in sorted(r for r in rows if r[0] == date):
            words = set(title.split())
            for k, seed in enumerate(seeds):
                if words and 10 * len(words & seed) >= 3 * len(words | seed):
                    out[date, seq] = k
                    break
            else:
                out[date, seq] = len(seeds)
                seeds.append(words)
    return out


def table(n, seed):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        if rng.random() < 0.34:                      # one title holds a third of the rows
            title = "wax wbx wcx wdx"
        elif rng.random() < 0.1:
            title = ""
        else:
            title = " ".join(rng.sample(WORDS, rng.randint(1, 7)))
        rows.append((f"2026-07-2{seq % 3}", seq, title))
    return rows


@pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 9), (3, 1)])
def test_clusters_match_sequential_seeds(spark, monkeypatch, seed, block):
    monkeypatch.setattr(S, "BLOCK_ROWS", block)      # one row a block is one at a time
    rows = table(150 if block > 1 else 40, seed)
    df = spark.createDataFrame(rows, "edition_date string, seq long, title string").orderBy(F.rand(seed))
    got = {(r.edition_date, r.seq): r.cluster_id for r in S.cluster_titles(df).collect()}
    assert got == brute(rows)


def counted(monkeypatch, label):
    """How often tables of ``label`` are written."""
    seen, plain = [], S.written

    def write(df, name="step"):
        seen.append(name)
        return plain(df, name)

    monkeypatch.setattr(S, "written", write)
    return lambda: seen.count(label)


@pytest.mark.parametrize("block", [20_000, 900])
def test_chain_of_titles(spark, monkeypatch, block):
    """5,000 titles, each similar to the next one only: as deep as it gets."""
    monkeypatch.setattr(S, "BLOCK_ROWS", block)
    rounds = counted(monkeypatch, "settled")
    rows = [("d", k, f"w{k}x w{k + 1}x") for k in range(5000)]
    df = spark.createDataFrame(rows, "edition_date string, seq long, title string")
    got = {r.seq: r.leader for r in S.title_leaders(df).collect()}
    assert got == {k: k - k % 2 for k in range(5000)}
    assert rounds() <= 20


def first_leaders(edges):
    """Covered nodes per group, one at a time."""
    covered = set()
    for k in {e[0] for e in edges}:
        for dst in sorted({e[2] for e in edges if e[0] == k}):
            if any((k, src) not in covered for g, src, d in edges if g == k and d == dst):
                covered.add((k, dst))
    return covered


def test_leader_rounds(spark):
    edges = [("g", 1, 2), ("g", 2, 3), ("g", 3, 4), ("g", 2, 5), ("h", 7, 9)]
    covered, _ = S.leader_rounds(spark.createDataFrame(edges, "k string, src long, dst long"), ["k"])
    assert {(r.k, r.node) for r in covered.collect()} == {("g", 2), ("g", 4), ("h", 9)} == first_leaders(edges)


@pytest.mark.parametrize("per_task", [5, 60, 200_000])
def test_leader_rounds_cut_into_ranges(spark, monkeypatch, per_task):
    monkeypatch.setattr(S, "EDGES", per_task)
    rng = random.Random(per_task)
    edges = sorted({("ab"[rng.random() < 0.2], *sorted(rng.sample(range(80), 2))) for _ in range(160)})
    covered, kept = S.leader_rounds(spark.createDataFrame(edges, "k string, src long, dst long"), ["k"])
    got = covered.collect()
    assert {(r.k, r.node) for r in got} == first_leaders(edges) and len(got) == len(set(got))
    assert kept.count() == len(edges)


def test_leader_rounds_of_a_chain(spark, monkeypatch):
    monkeypatch.setattr(S, "EDGES", 500)
    rounds = counted(monkeypatch, "settled")
    df = spark.range(5000).selectExpr("'g' AS k", "id AS src", "id + 1 AS dst")
    covered, _ = S.leader_rounds(df, ["k"])
    assert {r.node for r in covered.collect()} == set(range(1, 5001, 2))
    assert rounds() <= 20


def test_number_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 2)
    df = spark.createDataFrame([("a", x) for x in (5, 10_001, 30_000, 30_001)] + [("b", 7)], "k string, o long")
    got = {(r.k, r.o): r.n for r in S.number_rows(df, ["k"], "o", "n").collect()}
    assert got == {("a", 5): 0, ("a", 10_001): 1, ("a", 30_000): 2, ("a", 30_001): 3, ("b", 7): 0}
