from itertools import combinations

import numpy as np
import pytest
import xxhash

from scoreline.llm import simhash as X
from scoreline.llm.base import Workspace


def slow_fingerprint(text):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).translate({c: " " for c in range(9, 14)}).split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """Components of ids by brute force; fps: id -> fingerprint."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(fps), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in fps}


@pytest.mark.parametrize("text", ["", "One", "Two words", "A b C d e\x0b f g İx", "x " * 70_000, "\t \n"])
def test_fingerprint(text):
    assert X.fingerprint(text.encode()) == slow_fingerprint(text)


def test_spark_hashes_alike(spark):
    assert spark.sql("select xxhash64('a b c') as h").first().h % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def near(rng, base, most):
    for b in rng.choice(64, rng.integers(0, most + 1), replace=False):
        base ^= 1 << int(b)
    return base


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_against_brute_force(spark, seed):
    """Random values, a dense family that fills many chunks, and a chain; whatever the partitions are."""
    rng = np.random.default_rng(seed)
    fps = [int(x) for x in rng.integers(0, 2**63, 60)]
    hub = fps[0]
    fps += [near(rng, hub, 4) for _ in range(300)]
    chain = fps[1]
    for k in range(0, 60, 3):
        chain ^= 0b111 << k
        fps.append(chain)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    want = classes(dict(enumerate(fps)))
    for chosen in (X.plan(df), [([*range(16 * k, 16 * k + 16)], 0) for k in range(4)], [([*range(32)], 1), ([*range(32, 64)], 1)]):
        work = Workspace(spark, "test")
        root = {r.node % 2**64: r.root % 2**64 for r in X.components(work, X.links(df, chosen, work, chunk=32)).collect()}
        got = {}
        for i, f in enumerate(fps):
            got.setdefault(root.get(f, f), []).append(i)
        assert sorted(map(sorted, got.values())) == sorted(sorted(i for i in want if want[i] == r) for r in set(want.values()))


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(0)
    for m in (2, 3, 4):
        cost = [[0.0, *rng.random(4).cumsum()] for _ in range(m)]
        v, ts = X.allocate(cost, 3 - m + 1)
        assert sum(ts) == 3 - m + 1 and v == pytest.approx(sum(c[t + 1] for c, t in zip(cost, ts)))
        from itertools import product

        assert v == pytest.approx(min(sum(c[t + 1] for c, t in zip(cost, p)) for p in product(range(-1, 4), repeat=m) if sum(p) == 3 - m + 1))


def test_bits_that_agree_go_together():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (500, 64)).astype(float)
    x[:, 40] = x[:, 3]
    parts = X.group_bits(500, x.T @ x, 4)
    assert sorted(sum(parts, [])) == list(range(64)) and any({3, 40} <= set(p) for p in parts)


def test_documents(spark, docs):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 500, 120)) for _ in range(12)]
    rows = []
    for k, t in enumerate(base):
        for c in range(4):
            w = t.split()
            for at in rng.integers(0, 120, c):
                w[at] = "changed"
            rows.append((1000 - 10 * k - c, " ".join(w)))
    rows += [(5, None), (6, ""), (7, " \n"), (8, rows[0][1]), (9, rows[0][1].upper())]
    got = {r.doc_id: r for r in X.near_duplicates(docs(*rows, clash=True)).collect()}
    fps = {i: slow_fingerprint(t) for i, t in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == classes(fps)
    assert got[5].component_id == got[6].component_id == got[7].component_id == 5


def test_edge_cases(spark, docs):
    assert X.near_duplicates(docs()).count() == 0
    got = X.near_duplicates(docs((None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (None, "zz yy xx ww vv"))).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("3", "3"), ("None", "3"), ("None", "3"), ("None", "None")]


def test_stage_keeps_one_of_each_group(spark, docs):
    df = docs((1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, "other words stand here now"), (None, None), (None, None), clash=True)
    got = X.simhash_stage(spark, df, "")
    assert got.columns == df.columns and sorted((str(r.doc_id), r.text) for r in got.collect()) == [("1", "a b c d e"), ("3", "other words stand here now"), ("None", None)]
    assert X.simhash_stage(spark, docs((4, "q r s"), (4, "q r s")), "").count() == 1
    assert X.simhash_stage(spark, docs(), "").count() == 0


def test_stage_tells_components_apart_by_links(spark, docs):
    """Unlike texts whose ids are null or repeat are documents of their own."""
    texts = ["alpha beta gamma delta", "one two three four five", "le chat est sur la table", "quite other words in here"]
    df = docs(*zip([None, None, 7, 7], texts), (7, texts[3]), (None, texts[0]), clash=True)
    got = X.simhash_stage(spark, df, "").collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(zip(["None", "None", "7", "7"], texts))


@pytest.mark.parametrize("levels", [0, 3])
def test_common_values_are_split(spark, monkeypatch, levels):
    """All fingerprints share one partition's value; links are those of brute force however it is split."""
    monkeypatch.setattr(X, "LEVELS", levels)
    rng = np.random.default_rng(3)
    fps = {0xABCD} | {near(rng, int(x) << 16 | 0xABCD, 0) for x in rng.integers(0, 2**47, 200)}
    fps |= {near(rng, f, 5) for f in list(fps)[:100] for _ in range(3)}
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    work = Workspace(spark, "test")
    chosen = [([*range(16 * k, 16 * k + 16)], 0) for k in range(4)]
    root = {r.node % 2**64: r.root % 2**64 for r in X.components(work, X.links(df, chosen, work, chunk=8)).collect()}
    got = {}
    for i, f in enumerate(fps):
        got.setdefault(root.get(f, f), []).append(i)
    want = {}
    for i, r in classes(dict(enumerate(fps))).items():
        want.setdefault(r, []).append(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def word_sets(rows):
    got = {}
    for i, t in rows:
        w = t.lower().split()
        got[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    return got


@pytest.mark.parametrize("chunk", [X.TEXTS, 4])
def test_stage_takes_near_copies_by_words(spark, docs, monkeypatch, chunk):
    """Copies with a few replaced words, of all similarities around 0.8, against all pairs by brute force."""
    monkeypatch.setattr(X.similar, "__defaults__", (chunk,))
    rng = np.random.default_rng(7)
    rows = []
    for k in range(30):
        base = [f"w{x}" for x in rng.integers(0, 500, int(rng.integers(30, 300)))]
        for c in range(5):
            w = list(base)
            for at in rng.choice(len(w), max(1, len(w) * c // 80), replace=False):
                w[at] = f"new{k}x{c}x{at}"
            rows.append((len(rows), " ".join(w)))
    rows += [(900, "one two three"), (901, "One  two three"), (902, "one two four")]
    sets, fps = word_sets(rows), {i: slow_fingerprint(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    missed = 0
    for i, j in combinations(sorted(sets), 2):
        by_words = 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
        if by_words or (fps[i] ^ fps[j]).bit_count() <= 3:
            missed += by_words and (fps[i] ^ fps[j]).bit_count() > 3
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    assert missed > 20
    assert {r.doc_id for r in X.simhash_stage(spark, docs(*rows, clash=True), "").collect()} == {find(i) for i in root}
