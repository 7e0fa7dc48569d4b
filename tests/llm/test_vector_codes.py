"""Vector codes against a plain reading in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from treeflat.llm import vector_codes as vc


def brute(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    first = {}
    for i, v, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: (k[0], k[1])):
        first.setdefault(i, v)
    books = [[cut(first[i], p) for i in sorted(first)[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v, p: min(range(len(books[p])), key=lambda e: (dist(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        fresh = [list(b) for b in books]
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(best(v, p), []).append(cut(v, p))
            for e, g in groups.items():
                fresh[p][e] = tuple(sum(c) // len(g) for c in zip(*g))
        books = fresh
    out, totals = [], {}
    for i, v, lab in kept:
        codes = [best(v, p) for p in range(parts)]
        error = sum(dist(cut(v, p), books[p][c]) for p, c in enumerate(codes))
        totals[lab] = totals.get(lab, 0) + error
        out.append((i, "".join(f"{c:02x}" for c in codes), error, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    small = lambda x: x if x < 2**63 else None
    return sorted([(i, c, small(e), small(totals[lab]), digest) for i, c, e, lab in out], key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, part int, code string")


def random_rows(n, width, seed, scale=1.0, few=False):
    draw = random.Random(seed)
    value = (lambda: draw.choice([-0.5, 0.0, 0.5])) if few else (lambda: float(np.float32(draw.gauss(0, scale))))
    rows = [(k * 3 % 101, [value() for _ in range(width)], draw.choice([None, 1, 2, 7])) for k in range(n)]
    inf, nan = float("inf"), float("nan")
    odd = [[*rows[0][1][:-1], x] for x in (inf, -inf, nan, None)]
    return rows + [(500 + k, v, 1) for k, v in enumerate(odd)] + [(600, None, 1), (601, [], None), (None, rows[0][1], None), rows[5]]


@pytest.mark.parametrize("width,parts,few,scale", [(64, 16, False, 0.2), (48, 16, False, 3.0), (15, 3, True, 1.0), (4, 4, True, 1.0), (12, 2, False, 1e9)])
def test_codes(spark, monkeypatch, width, parts, few, scale):
    monkeypatch.setattr(vc, "BLOCK", 37)
    rows = random_rows(150, width, width, scale, few)
    got = vc.vector_codes(table(spark, rows).repartition(3), parts=parts, entries=16)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, parts, 16, 2)


def test_components_beyond_64_bits(spark):
    rows = random_rows(40, 8, 3, 1e20)
    got = vc.vector_codes(table(spark, rows), parts=2, entries=8)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 2, 8, 2)


def test_fewer_vectors_than_entries_and_empty(spark):
    rows = random_rows(9, 16, 1)
    got = vc.vector_codes(table(spark, rows), parts=16)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 16, 64, 2)
    nothing = vc.vector_codes(table(spark, rows).limit(0))
    assert nothing.columns == got.columns and nothing.count() == 0
    with pytest.raises(ValueError, match="one length"):
        vc.vector_codes(table(spark, rows), parts=5)


def test_transform_is_exact_and_ordered():
    draw = np.random.default_rng(1)
    for d, m in ((1, 1), (3, 4), (4, 4), (6, 8), (9, 16)):
        a, b = draw.integers(-999, 999, (20, d)), draw.integers(-999, 999, (20, d))
        assert ((vc.transformed(a) - vc.transformed(b)) ** 2).sum(1).tolist() == (m * ((a - b) ** 2).sum(1)).tolist()
        changes = [int((np.diff(np.sign(vc.transformed(np.eye(m, dtype=np.int64))[:, k])) != 0).sum()) for k in range(m)]
        assert changes == list(range(m))
