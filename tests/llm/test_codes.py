"""Vector codes: cover trees, one round, and whole results against plain versions."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from stockflow.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, ids int, x int, n string, place int"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, 3, "n", 4) for r in rows], SCHEMA).repartition(3)


def clustered(n, width, seed=1, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    return (centres[rng.integers(9, size=n)] + spread * rng.normal(size=(n, width))).astype(np.float32)


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, sha) of each kept row by loops over points and entries."""
    kept = [
        (i, [math.floor(4096 * float(c)) for c in v], label)
        for i, v, label in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for k, members in groups.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for (_, _, label), e in zip(kept, error, strict=True):
        of_label[label] = of_label.get(label, 0) + e
    return sorted(
        str((i, "".join(f"{k:02x}" for _, k in f), e, of_label[label], sha))
        for (i, _, label), f, e in zip(kept, found, error, strict=True)
    )


def result(df):
    return sorted(str(tuple(r)) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize("points", [clustered(500, 8), clustered(300, 3, spread=1.0), np.ones((40, 4), np.float32), clustered(1, 2)])
def test_cover_tree(points):
    whole = np.floor(4096 * points).astype(np.int64)
    tree = codes.Tree.built(whole, leaf=5, base=1.7)
    assert sorted(tree.order.tolist()) == list(range(len(whole)))
    seen = 0
    for i in range(tree.centre.size):
        inside = whole[tree.order[tree.start[i] : tree.end[i]]]
        away = np.sqrt(((inside - whole[tree.centre[i]]) ** 2).sum(1).astype(float))
        assert away.max() <= tree.radius[i]  # covering
        children = range(tree.first[i], tree.first[i] + tree.count[i])
        if not children:
            seen += inside.shape[0]
            continue
        assert [tree.start[c] for c in children] == [tree.start[i], *(tree.end[c] for c in children)][:-1]
        assert tree.end[children[-1]] == tree.end[i] and tree.centre[children[0]] == tree.centre[i]  # nesting
        limit = 1.7 ** (np.ceil(np.log(tree.radius[i]) / np.log(1.7)) - 1)
        for a in children:
            for b in children:
                if a < b:  # separation
                    gap = whole[tree.centre[a]] - whole[tree.centre[b]]
                    assert math.sqrt(int((gap**2).sum())) > limit
    assert seen == len(whole)


@pytest.mark.parametrize("spread", [0.01, 0.5])
def test_subtrees_go_to_the_nearest_entry(spread):
    whole = np.floor(4096 * clustered(2000, 8, seed=3, spread=spread)).astype(np.int64)
    tree = codes.Tree.built(whole)
    entries = np.concatenate((whole[:9], whole[:3], whole[5:6] + 1))  # ties between equal entries
    near, total, number, taken = tree.nearest(whole, entries)
    want = codes.squares(whole, entries).argmin(1)
    assert (near == want).all()
    for e in range(len(entries)):
        assert (total[e] == whole[want == e].sum(0)).all() and number[e] == (want == e).sum()
    if spread < 0.1:  # whole subtrees: far fewer distances than points by entries
        assert taken < 0.6 * whole.shape[0] * len(entries)


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_equals_plain(spark, block):
    rng = np.random.default_rng(5)
    vectors = [v.tolist() for v in clustered(90, 16, seed=2)]
    rows = [(int(i), v, int(i) % 4 if i % 5 else None) for i, v in zip(rng.permutation(90), vectors, strict=True)]
    rows += [(1000 + k, vectors[3], 9) for k in range(40)]  # copies
    rows += [rows[4], rows[4], (None, vectors[7], None), (None, vectors[8], 2), (5000, vectors[9], None)]
    rows += [(6000, None, 1), (6001, [*vectors[0][:15], None], 1), (6002, [*vectors[0][:15], float("nan")], 1)]
    rows += [(-1, [*vectors[0][:15], float("inf")], 1), (-2, [float("-inf"), *vectors[0][:15]], None)]
    assert result(codes.coded(frame_of(spark, rows), block=block)) == plain(rows)


def test_few_and_no_vectors(spark):
    few = [(3, [0.5] * 8, 1), (1, [-0.25] * 8, None)]
    assert result(codes.coded(frame_of(spark, few))) == plain(few)
    none = codes.coded(frame_of(spark, [(1, None, 2)]))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert codes.coded(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r)[:4] for r in codes.coded(frame_of(spark, [(1, [], 2)])).collect()] == [(1, "00" * 8, 0, 0)]


def test_lengths_and_sizes_that_have_no_result(spark):
    for rows in ([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], [(1, [0.5] * 9, 1)]):
        with pytest.raises(ValueError, match="one length"):
            codes.coded(frame_of(spark, rows))
    with pytest.raises(Exception, match="components must be below"):
        codes.coded(frame_of(spark, [(1, [1e30] * 8, 1), (2, [0.5] * 8, 1)]))


def test_label_errors_of_common_and_rare_labels(spark):
    rows = [(i, i % 3 if i % 2 else 100 + i, "c", i) for i in range(2500)] + [(9999, None, "c", 4), (9998, None, "c", 5)]
    got = codes.with_label_error(spark.createDataFrame(rows, "vec_id long, label int, code string, error long")).collect()
    want = {}
    for _, label, _, error in rows:
        want[label] = want.get(label, 0) + error
    assert len(got) == len(rows) and all(r.label_error == want[r.label] for r in got)
