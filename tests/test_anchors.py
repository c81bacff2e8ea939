"""Speakers, tails, contexts, bank edits and receipts: known answers on small tables."""

import pytest
from pyspark.sql import functions as F

from inkspring.operators import anchors as A


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def world(spark):
    """One page with two tails and two characters; bank character 7 is well, 8 is disabled."""
    return {
        "observations": table(spark, [(1, 0, "c0", 7), (1, 1, "c1", 8), (1, 1, "c2", 9)], "page long, character int, cluster string, bank_id int"),
        "people": table(spark, [("c0", "ann"), ("c1", "bob"), ("c2", "cyd")], "cluster string, person string"),
        "tails": table(spark, [(1, 0, 0), (1, 0, 0), (1, 1, 1), (1, 2, 5)], "page long, text_index int, tail_index int"),
        "characters": table(spark, [(1, 0, 0), (1, 1, 1), (1, 2, 0)], "page long, text_index int, character int"),
        "pages": table(spark, [(1, 2, 2)], "page long, n_tails int, n_characters int"),
        "bank": table(spark, [(7, False), (8, True), (9, None)], "bank_id int, disabled boolean"),
    }


def test_route(spark, world):
    texts = table(spark, [("t0", 1, 0, 0, 0, 7), ("t1", 1, 1, 1, 1, 8), ("t2", 1, 1, 1, 1, 9), ("t3", 1, 2, 5, 0, 7), ("t4", 1, 0, 0, 0, 9), ("t5", 1, None, 0, 0, 7)], "text string, page long, text_index int, tail_index int, character int, bank_id int")
    sources = table(spark, [("u0", "t0", False), ("u1", "t1", False), ("u2", "t0", False), ("u2", "t2", False), ("u3", "t3", False), ("u4", "t4", None), ("u5", "t0", True), ("u6", "t5", False), ("u7", "none", False)], "utterance string, text string, caption boolean")
    got = {r["utterance"]: (r["originals"], r["anchors"], r["locked"], r["person"], list(r["conflicting"])) for r in A.route(sources, texts, *(world[k] for k in ("observations", "people", "tails", "characters", "pages", "bank"))).collect()}
    assert got == {
        "u0": (1, 1, True, "ann", []), "u1": (2, 0, False, None, []), "u2": (3, 2, False, None, ["ann", "cyd"]), "u3": (1, 0, False, None, []), "u4": (1, 0, False, None, []),
        "u5": (1, 0, False, None, []), "u6": (1, 0, False, None, []), "u7": (0, 0, False, None, []),
    }


def test_tail_evidence(spark, world):
    boxes = table(spark, [("r", 1, 0, "s1", 1), ("r", 1, 1, "s0", 0), ("r", 1, 2, "s1", 1), ("r", 1, 3, "s2", 1), ("r", 1, 4, None, 0), ("q", 1, 0, "s3", 2), ("p", 1, 0, "s4", None)], "row string, page long, ord int, source string, text_index int")
    got = {(r["row"], r["tail_index"]): (list(r["sources"]), r["known"]) for r in A.tail_evidence(boxes, world["tails"], world["pages"]).collect()}
    assert got == {("r", 1): (["s1", "s2"], True), ("r", 0): (["s0"], True), ("q", 5): (["s3"], False)}


def test_person_context(spark):
    clusters = table(spark, [("a", 1, True), ("b", 1, True), ("c", 2, False), ("d", 3, True), ("e", 4, True)], "cluster string, person int, current boolean")
    seen = table(spark, [("a", 10, 5), ("a", 11, None), ("b", 11, 6), ("c", 10, 9), ("d", 12, None), ("e", 12, None)], "cluster string, page int, bank_id int")
    people = table(spark, [(1, None), (2, None), (3, None), (4, "named"), (5, None)], "person int, name string")
    got = {r["person"]: (r["name"], list(r["clusters"]), list(r["bank_ids"])) for r in A.person_context(clusters, seen, people, table(spark, [(10,), (10,)], "page int")).collect()}
    assert got == {1: (None, ["a"], ["5", "6"]), 2: (None, [], ["9"]), 4: ("named", [], [])}


def test_resolved_speaker(spark):
    cases = [
        ((True, "b", None, None, [], None), ("b", None, [])), ((True, "b", None, "b", [], None), ("b", None, [])), ((True, "b", None, "a", [], None), ("b", None, ["source_anchor_disagrees"])),
        ((True, "b", "c", None, ["x", "y"], "b"), ("b", "c", ["source_anchors_disagree"])), ((True, "b", "c", "a", [], "d"), ("b", None, ["source_anchor_disagrees", "cluster_reference_disagrees"])),
        ((True, None, "c", None, None, "d"), (None, None, ["cluster_reference_disagrees"])), ((False, "b", "c", "a", ["x", "y"], "d"), ("b", "c", [])), ((None, None, None, None, None, None), (None, None, [])), ((True, "b", "c", None, None, None), ("b", "c", [])),
    ]
    df = table(spark, [(i, *c) for i, (c, _) in enumerate(cases)], "id int, resolved boolean, person string, cluster string, anchor string, conflicting array<string>, owner string")
    got = df.select("id", A.resolved_speaker(*[F.col(c) for c in ("resolved", "person", "cluster", "anchor", "conflicting", "owner")]).alias("s")).orderBy("id").collect()
    assert [(r["s"]["person"], r["s"]["cluster"], list(r["s"]["conflicts"])) for r in got] == [w for _, w in cases]


def test_identity_view(spark):
    rows = [(1, "p", "a", "A", ["b"], ["B", "C"], [("m", "x"), ("n", "y")], {"m": "M"}), (2, "old", "a", "A", ["b"], ["B"], [("m", "x")], {"m": "M"}), (3, None, "a", "A", None, None, None, None), (4, "p", "a", None, ["b"], None, None, {})]
    df = table(spark, rows, "id int, policy string, speaker string, speaker_identity string, addressees array<string>, addressee_identities array<string>, mentions array<struct<candidate:string,target:string>>, mention_identities map<string,string>")
    got = {r["id"]: (r["speaker"], r["addressees"], r["mentions"] and [tuple(m) for m in r["mentions"]]) for r in A.identity_view(df, "p").collect()}
    assert got == {1: ("A", ["B", "C"], [("m", "M"), ("n", "y")]), 2: ("a", ["b"], [("m", "x")]), 3: ("a", None, None), 4: (None, None, None)}


def test_receipts(spark):
    h = "step string, artifact_hash string, input_hash string"
    receipts = table(spark, [("a", "1", "x"), ("b", "2", "x"), ("c", "3", "x"), ("d", "4", "x"), ("e", "5", None), ("f", "6", "x")], h)
    now = table(spark, [("a", "1", "x"), ("b", "0", "y"), ("d", "4", "z"), ("e", "5", None), ("f", "6", "x")], h)
    needs = table(spark, [("b", "a"), ("c", "a"), ("e", "b"), ("f", "e")], "step string, needs string")
    assert {r["step"]: r["issue"] for r in A.checked(receipts, now, needs).collect()} == {"a": None, "b": "changed", "c": "missing", "d": "dependencies", "e": "ancestor", "f": "ancestor"}


def test_bank_edits(spark):
    bank = table(spark, [(1, None, 3, ["p", "q"], ["p", "q", "p"]), (2, "old", 1, ["r"], [None]), (3, "stays", 0, [], [])], "character int, name string, vectors int, crops array<string>, prototype_crops array<string>")
    edits = table(spark, [(1, 1, "rename", None, " New "), (1, 2, "disable_crop", 0, None), (1, 3, "disable_prototype", 1, None), (1, 4, "disable_crop", 0, None), (2, 5, "rename", None, "x"), (2, 6, "rename", None, "  "), (2, 7, "disable_prototype", 1, None), (2, 8, "disable_crop", -1, None), (9, 9, "rename", None, "x"), (2, 10, "disable_prototype", 0, None), (2, 11, "erase", 0, None)], "character int, seq int, kind string, index int, name string")
    done, refused = A.edited(bank, edits)
    assert {r["character"]: (r["name"], list(r["disabled_prototypes"]), list(r["disabled_crops"])) for r in done.collect()} == {1: ("New", [0, 1, 2], ["p"]), 2: (None, [0], []), 3: ("stays", [], [])}
    assert {(r["seq"], r["issue"]) for r in refused.collect()} == {(7, "index"), (8, "index"), (9, "character"), (11, "index")}


def test_promotion(spark):
    bank = table(spark, [(4, ["k"], 1)], "character long, appearance_keys array<string>, appearances long")
    pending = table(spark, [("x", 2, ["b", "a", "b"]), ("y", 1, []), ("z", 3, ["c"])], "pending string, seq int, keys array<string>")
    after, left = A.promoted(bank, pending, table(spark, [("x",), ("y",), ("y",), ("none",)], "pending string"))
    assert {r["character"]: (list(r["appearance_keys"]), r["appearances"]) for r in after.collect()} == {4: (["k"], 1), 5: ([], 0), 6: (["a", "b"], 2)}
    assert [r["pending"] for r in left.collect()] == ["z"]
    assert A.promoted(bank.limit(0), pending, table(spark, [("z",)], "pending string"))[0].first()["character"] == 1


def test_translation_jobs(spark):
    from inkspring.operators import chapter as C

    rows = [("d", f"u{i}", i) for i in range(12)] + [("e", "u0", 0), ("e", "u0", 1), ("f", "u0", 0), ("f", "u1", 1)]
    batches = [("d", "b1", 0, "u3", "s", "x"), ("d", "b1", 1, "u1", "s", "x"), ("d", "b1", 2, "gone", "s", "x"), ("d", "b2", 0, "gone", "s", "y"), ("f", "b1", 0, "u0", "s", "x"), ("f", "b2", 0, "u0", "s", "x")]
    jobs, issues = C.translation_jobs(table(spark, rows, "document string, id string, ord int"), table(spark, batches, "document string, batch string, pos int, id string, scene string, summary string"))
    got = {(r["document"], r["job"]): (list(r["targets"]), r["batch"], r["scene"], r["summary"]) for r in jobs.collect()}
    rest = [f"u{i}" for i in range(12) if i not in (1, 3)]
    assert got == {("d", "natural:b1"): (["u3", "u1"], "b1", "s", "x"), ("d", "natural:additional:1"): (rest[:8], None, None, ""), ("d", "natural:additional:2"): (rest[8:], None, None, "")}
    assert {tuple(r) for r in issues.collect()} == {("e", "u0", "duplicate"), ("f", "u0", "overlap")}
