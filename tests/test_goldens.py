"""Known answers of the sequential and string operators, with ties, nulls and empty inputs."""

import numpy as np
import pytest

from inkspring.functions import text as T
from inkspring.operators import names as N
from inkspring.operators import registry as R
from inkspring.operators import stateful as S


@pytest.mark.parametrize(
    "text, old, want",
    [("STRASSE Straße", "straße", [(0, 7), (8, 14)]), ("ß", "s", []), ("Toru‿Toru", "Toru", []), ("Koyuḱ Koyuk", "Koyuk", [(7, 12)]), ("", "x", []), ("abc", "", []), ("a-b a b ab", "ab", [(0, 3), (4, 7), (8, 10)])],
)
def test_find_all(text, old, want):
    assert N.find_all(text, old) == want


def test_replacements():
    assert N.apply_rules("TORU / Toru Mizushima", [("TORU", "Tooru")], ["Toru Mizushima"])[0] == "Tooru / Toru Mizushima"
    assert N.apply_rules("A B", [("A", "B"), ("B", "C")])[0] == "C C"
    assert N.apply_rules("Koyuk / Koyuki / Koyukii / _Koyuk / Koyuk2", [("Koyuk", "Koyuki")])[0] == "Koyuki / Koyuki / Koyukii / _Koyuk / Koyuk2"


def test_scope_kinds():
    assert N.scope_kind("TORU", "Toru Mizushima") == "name_expansion"
    assert N.scope_kind("Mizushima Toru", "Toru Mizushima") == "name_reordering"
    assert N.scope_kind("Toru Mizushima", "Toru") == "name_shortening"
    assert N.scope_kind("Tooru", "Toru") is None


def test_moved_spans():
    assert N.move_span((10, 14), [(0, 4)], 6) == (12, 16)
    assert N.move_span((0, 20), [(5, 9)], 2) == (0, 18)
    # a cut end goes to the edge of the replacement
    assert N.move_span((3, 7), [(5, 9)], 2) == (3, 7) and N.move_span((6, 12), [(5, 9)], 2) == (5, 10) and N.move_span((6, 8), [(5, 9)], 7) == (5, 12)


def test_story_keys_and_runtime(spark):
    rows = spark.createDataFrame([("  One PIECE  ", 11.0), ("Đại  Chiến", 125.0), (None, None), ("", 3725.0)], "t string, s double")
    from pyspark.sql import functions as F

    key = F.btrim(F.regexp_replace(T.folded("t"), r"[^\p{L}\p{N}_]+", "-"), F.lit("-"))
    got = [tuple(r) for r in rows.select(key, T.runtime(F.col("s"))).collect()]
    assert got == [("one-piece", "11.000s"), ("đại-chiến", "2m 5s"), (None, "-"), ("", "1h 2m 5s")]


def test_consensus():
    assert R.compact(np.array([[1, 0], [1, 0.02], [1, -0.02], [-1, 0]]), 3) == [0, 1, 2]
    assert np.allclose(R.unit_mean(np.array([[1.0, 0], [0, 1.0]]), 16), [2**-0.5, 2**-0.5])
    assert np.isclose(np.linalg.norm(R.unit_mean(np.array([[1.0, 0], [-1.0, 0]]), 16)), 1)
    for bad in (np.zeros((0, 2)), np.zeros((1, 2)), np.array([[np.nan, 1]])):
        with pytest.raises(ValueError):
            R.unit(bad)


def test_allocation_and_lines():
    assert S.allocate([3] * 9, [100.0, 200.0]) == [[0, 3], [3, 9]]
    assert S.allocate([], [1.0]) == [[0, 0]] and S.allocate([3], []) == []
    assert S.fit_lines("aa bb cc".split(), [5.0, 2.0], 1) == [["aa", "bb"], ["cc"]]
    assert S.fit_lines(["toolong"], [3.0], 1) is None
    assert S.largest_size(["abc"], [12.0], [1, 2, 4, 8]) == 4
    # the least important shrinks by quarters: 10, 7, 5, 3, 2
    assert S.pack([(0, 10), (1, 10)], 12) == [10, 2] and S.pack([(0, 3), (1, 9), (1, 1)], 8) == [3, 4, 1] and S.pack([], 5) == []


def test_page_plan_is_free_of_arrival_order():
    strong, weak = {"panel": 0, "detection": 1, "person": 1, "score": 0.1}, {"panel": 0, "detection": 0, "person": 1, "score": 0.3}
    other = {"panel": 1, "detection": 2, "person": 1, "score": 0.2}
    want = [{"detection": 0, "person": None}, {"detection": 1, "person": 1}, {"detection": 2, "person": 1}]
    assert S.page_plan([strong, weak, other]) == want == S.page_plan([other, weak, strong])
    assert S.page_plan([strong, weak, other, {"panel": 0, "detection": 0, "person": 2, "score": 0.9}])[0]["person"] == 2


def test_admission():
    sample = lambda t, load, done=1, queued=1: {"t": t, "load": load, "done": done, "queued": queued}
    up = S.admission([sample(0, 0.1), sample(5, 0.1), sample(11, 0.1)])
    assert [x["limit"] for x in up] == [2, 2, 3]
    cut = S.admission([sample(0, 0.95), sample(10, 0.95), sample(40, 0.95)], start=8)
    assert [x["limit"] for x in cut] == [4, 4, 2]
    assert [x["limit"] for x in S.admission([sample(0, None), sample(1, None)])] == [2, 1]
    assert S.admission([]) == []


def test_redirect_cycle_is_an_error(spark):
    from inkspring.operators import graph as G

    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert {tuple(r) for r in G.resolved(ids, spark.createDataFrame([(1, 2), (2, 3)], "id long, to long")).collect()} == {(1, 3), (2, 3), (3, 3)}
    with pytest.raises(ValueError):
        G.resolved(ids.limit(2), spark.createDataFrame([(1, 2), (2, 1)], "id long, to long"), rounds=3)
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_masks():
    from inkspring.operators import masks as M

    ring = M.draw([(0, 0, 5, 5)], 7, 7)
    ring[2, 2] = False
    ring[5, 6] = True
    ids, n = M.labelled(ring)
    assert n == 2 and ids[5, 6] == 2 and M.filled(ring)[2, 2] and not M.filled(ring)[6, 0]
    u = np.array([[1, 0, 1], [1, 0, 1], [1, 1, 1]], bool)
    assert M.labelled(u)[1] == 1 and M.outline_length(u) == 16 and M.bounds(u) == [0, 0, 3, 3]
    assert M.rows(u)[0] == [(0, 1), (2, 3)] and M.bounds(np.zeros((2, 2), bool)) is None
    assert M.eroded(M.draw([(0, 0, 3, 3)], 5, 5), 1).sum() == 1 and M.dilated(M.draw([(2, 2, 3, 3)], 5, 5), 1).sum() == 5
    assert M.fill_plan(np.ones((3, 3), bool), np.zeros((3, 3), bool)) == "review"
