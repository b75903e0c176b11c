"""The divergence audit against brute force, and the joint walk of two trees against full matrices."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import divergence
from tidemark.llm.quadtree import Quadtree, height, joint_sums

SCHEMA = "text string, lang string, source string, term string, p bigint"


def brute_sums(left, right):
    return [[sum(int(p - q) ** 2 // int(p + q) for p, q in zip(a, b, strict=True)) for b in right] for a in left]


@pytest.mark.parametrize(("n", "m", "cols", "share"), [(1, 1, 1, 1), (20, 20, 300, 0.02), (9, 17, 64, 0.3), (3, 40, 1000, 0.001), (8, 8, 63, 0)])
def test_joint_sums_equal_the_full_matrices(n, m, cols, share):
    rng = np.random.default_rng(n + m)

    def side(rows):
        empty = rng.integers(1, 1000, rows)
        full = np.repeat(empty[:, None], cols, axis=1)
        r, c = np.nonzero(rng.random((rows, cols)) < share)
        full[r, c] = rng.integers(1, 10**9, len(r))
        return full, Quadtree(r, c, full[r, c], empty, height(max(n, m), cols))

    (a, left), (b, right) = side(n), side(m)
    assert joint_sums(left, right, cols).tolist() == brute_sums(a, b)
    upper = np.triu_indices(n, 1)
    assert joint_sums(left, left, cols)[upper].tolist() == np.array(brute_sums(a, a))[upper].tolist()


def test_joint_walk_prices_empty_quadrants_at_once():
    tree = Quadtree(np.array([0]), np.array([5]), np.array([7]), np.array([3, 4]), height(2, 1 << 20))
    walked = []
    spread, tree.spread = tree.spread, lambda r, c: walked.append(len(r)) or spread(r, c)
    assert joint_sums(tree, tree, 1 << 20)[0, 1] == (1 << 20) * (1 // 7) + 9 // 11
    assert sum(walked) == 2


def brute_audit(table, least=10, top=10):
    docs = [(re.findall(divergence.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), l or "", s or "") for t, l, s in table]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        df = Counter(t for d in mine for t in set(d[0]))
        kept = {t for t in df if df[t] >= least}
        counts = defaultdict(Counter)
        for words, _, source in mine:
            counts[source].update(w for w in words if w in kept)
        whole = sum(counts.values(), Counter())
        price = lambda c, total: 1 + 10**9 * (c + 2) // (total + 2 * len(kept))
        prices = {s: {t: price(counts[s][t], sum(counts[s].values())) for t in kept} for s in counts}
        mean = {t: price(whole[t], sum(whole.values())) for t in kept}
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s in counts:
            pairs = [(sum(gap(prices[s][t], prices[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(gap(prices[s][t], mean[t]), t) for t in kept if counts[s][t] and prices[s][t] > mean[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out, key=repr)


def documents():
    rng = np.random.default_rng(8)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)] + ["Été", "日本", "A", "𝒳y", "z" * 3000]
    out = []
    for i in range(220):
        picked = rng.choice(len(words), rng.integers(0, 40), p=np.arange(1, 66)[::-1] / (65 * 66 / 2))
        lang = ["en", "de", None, "", "xx"][rng.integers(5) if i % 3 else 0]
        source = ["s1", "s2", "é", None, "", "hot"][rng.integers(6) if i % 2 else 5]
        out.append((" ".join(words[k] for k in picked).replace("w", "W" if i % 2 else "w"), lang, source))
    out += [(None, "en", "none"), ("", "fr", "a"), ("12 @[`{", "fr", "b"), ("one two", "fr", "c"), ("x" * 200_000, "en", "s1")]
    return out + [out[5]] * 12 + [("rare " * 50 + "wide-a", "it", "only")] * 11


def test_audit_equals_brute_force(spark, rows, monkeypatch):
    table = documents()
    df = spark.createDataFrame([(*r, "t", 1) for r in table], SCHEMA)
    want = brute_audit(table)
    got = divergence.audit(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(got) == want
    assert {("fr", "a", "pair", "b", 0, 1), ("fr", "a", "pair", "c", 0, 2)} <= set(want)
    # Small blocks: several stripes of rows and columns.
    monkeypatch.setattr(divergence, "ROWS", 2)
    monkeypatch.setattr(divergence, "COLS", 16)
    assert rows(divergence.audit(df)) == want


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
