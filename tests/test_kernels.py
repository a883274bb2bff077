import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import assign as asg
from folioforge.operators import chapters as ch


def test_assignment_is_the_best_one():
    rng = np.random.default_rng(1)
    for _ in range(150):
        r, c = rng.integers(1, 6, 2)
        score = rng.integers(-500, 1500, (r, c)).astype(float)
        got = asg.best_assignment(score)
        used = [x for x in got if x >= 0]
        assert len(used) == len(set(used)) == min(r, c)
        small, large, s = (range(r), range(c), score) if r <= c else (range(c), range(r), score.T)
        best = max(sum(s[i, p[i]] for i in small) for p in itertools.permutations(large, len(small)))
        assert sum(score[i, x] for i, x in enumerate(got) if x >= 0) == best
    assert asg.best_assignment(np.zeros((2, 0))) == [-1, -1]


def test_suppression():
    boxes = np.array([[0, 0, 10, 10], [0, 0, 10, 9.9], [20, 20, 30, 30], [0, 0, 0, 0]], float)
    assert asg.suppress(boxes, np.array([0.5, 0.9, 0.1, 0.0]), 0.9).tolist() == [1, 2, 3]
    assert asg.suppress(np.zeros((0, 4)), np.zeros(0)).tolist() == []


def test_packing_keeps_the_room():
    rng = random.Random(3)
    for _ in range(100):
        sizes = [rng.randrange(1, 90) for _ in range(rng.randrange(30))]
        load = {}
        for s, w in zip(sizes, asg.pack(sizes, 64)):
            load.setdefault(w, []).append(s)
        assert all(sum(v) <= 64 or len(v) == 1 for v in load.values()) and sorted(load) == list(range(len(load)))


@pytest.mark.parametrize(("tex", "want"), [(r"\left( x \right)", r"\left( x \right)"), (r"\left( x", "( x"), ("{a}}", "{a}"), ("{{a}", "{{a}}"), (None, None), ("", ""), (r"\leftarrow x  y", r"\leftarrow x y")])
def test_formulas(tex, want):
    assert asg.repair_formula(tex) == want


def test_chapters(spark):
    lines = ["intro", "# 1 One", "a", "## 1.1 Sub", "b", "# 2 Two", "c", "### Deep", "d"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "k int, n int, line string")
    got = {r.line: r.chapters for r in ch.with_chapters(df, ["k"], "n").collect()}
    assert got["intro"] == [] and got["a"] == ["One"] and got["b"] == ["One", "Sub"] and got["c"] == ["Two"] and got["d"] == ["Two", "Deep"]


def test_contents_pages(spark):
    rows = [("d", 0, "Title"), ("d", 1, "Contents\n1 Features 3\n2 Pins 4"), ("d", 2, "3 Timing .... 9\n4 Notes 10"), ("d", 3, "1 Features\nThe contents of this"), ("e", 0, "the contents are")]
    df = spark.createDataFrame(rows, "d string, p int, t string")
    assert [tuple(r) for r in ch.contents_pages(df, "d", "p", "t").collect()] == [("d", 1, 2)]


def test_suppressed_rows(spark):
    df = spark.createDataFrame([("d", 1, [0.0, 0.0, 9.0, 9.0], 0.5), ("d", 2, [0.0, 0.0, 9.0, 9.0], None), ("d", 3, None, 1.0)], "d string, k int, b array<double>, s double")
    assert [r.k for r in asg.suppress_boxes(df, ["d"], "k", "b", "s").collect()] == [1]
    assert asg.suppress_boxes(df.where(F.lit(False)), ["d"], "k", "b", "s").count() == 0
