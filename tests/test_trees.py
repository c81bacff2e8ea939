"""JSON trees: every node found, trees put together again, schemas stripped and configurations checked, against recursion."""

import json
import random

from pyspark.sql import functions as F

from inkspring.operators import trees as T

NAMES = ["a", "b/c", "d~e", 'q"uote', "enum", "required", "é", "properties", ""]


def made(rng, depth=0):
    k = rng.random()
    if depth > 4 or k < 0.35:
        return rng.choice([None, True, False, 0, 7, -3, 1.5, "", "text", "evidence_refs", "a\"b\n/~", 10**12])
    if k < 0.65:
        return [made(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {n: (["evidence_refs", "x", made(rng, depth + 1)] if n == "required" else made(rng, depth + 1)) for n in rng.sample(NAMES, rng.randint(0, 4))}


def frame(spark, values):
    return spark.createDataFrame([(i, None if v is ... else json.dumps(v)) for i, v in enumerate(values)], "id long, j string").select("id", F.parse_json("j").alias("doc"))


def nodes(v, path=""):
    kind = "object" if isinstance(v, dict) else "array" if isinstance(v, list) else "string" if isinstance(v, str) else "boolean" if isinstance(v, bool) else "null" if v is None else "number"
    yield path, kind
    for k, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
        yield from nodes(x, f"{path}/{str(k).replace('~', '~0').replace('/', '~1')}")


def stripped(v):
    if isinstance(v, dict):
        out = {k: stripped(x) for k, x in v.items() if k != "enum"}
        if isinstance(v.get("required"), list):
            out["required"] = stripped([x for x in v["required"] if x != "evidence_refs"])
        return out
    return [stripped(x) for x in v] if isinstance(v, list) else v


def values():
    rng = random.Random(4)
    return [made(rng) for _ in range(120)] + [..., None, {}, [], "x", {"enum": {"enum": 1}}, {"required": "evidence_refs"}, {"required": ["evidence_refs"]}, [["evidence_refs"]], {"a": [[[[[[[1]]]]]]]}]


def test_walk_and_assembly(spark):
    vs = values()
    df = frame(spark, vs)
    got = {}
    for r in T.walk(df, "id").collect():
        got.setdefault(r["id"], []).append((r["path"], r["kind"]))
    assert {i: sorted(n) for i, n in got.items()} == {i: sorted(nodes(v)) for i, v in enumerate(vs) if v is not ...}
    assert {r["id"]: json.loads(r["json"]) for r in T.assembled(T.walk(df, "id"), "id").collect()} == {i: v for i, v in enumerate(vs) if v is not ...}
    assert T.assembled(T.walk(df.limit(0), "id"), "id").count() == 0


def test_schemas_without_proofs(spark):
    vs = values()
    got = {r["id"]: json.loads(r["json"]) for r in T.without_proofs(frame(spark, vs), "id").collect()}
    assert got == {i: stripped(v) for i, v in enumerate(vs) if v is not ...}


RULES = [T.Rule("/mode", ("string",), choices=('"a"', '"b"')), T.Rule("/n", ("number",), 1, 5, whole=True), T.Rule("/share", ("number",), high=1, above=0), T.Rule("/in/low", ("number",)), T.Rule("/in/high", ("number",)), T.Rule("/path", ("string", "null"))]


def test_violations(spark):
    good = {"mode": "a", "n": 3, "share": 1, "in": {"low": 1, "high": 1}, "path": None}
    cases = [
        (good, []), ({**good, "mode": "c"}, [("/mode", "not_allowed")]), ({**good, "mode": 1}, [("/mode", "wrong_type")]), ({**good, "n": 3.5}, [("/n", "wrong_type")]), ({**good, "n": 6}, [("/n", "out_of_range")]), ({**good, "n": True}, [("/n", "wrong_type")]),
        ({**good, "share": 0}, [("/share", "out_of_range")]), ({**good, "share": 0.001}, []), ({**good, "in": {"low": 2, "high": 1}}, [("/in/low", "wrong_order")]), ({**good, "in": {"low": 2}}, [("/in/high", "missing_field")]),
        ({**good, "in": 5}, [("/in/high", "missing_field"), ("/in/low", "missing_field")]), ({**good, "more": {"deep": [1]}}, [("/more", "unknown_field")]), ({**good, "path": ["x"]}, [("/path", "wrong_type")]), ({**good, "path": "p"}, []),
        ([1], [("", "not_an_object")]), ({}, sorted((r.row[0], "missing_field") for r in RULES)), (..., []),
    ]
    got = {}
    for r in T.violations(frame(spark, [c for c, _ in cases]), "id", RULES, [("/in/low", "/in/high")]).collect():
        got.setdefault(r["id"], []).append((r["path"], r["code"]))
    assert {i: sorted(v) for i, v in got.items()} == {i: w for i, (_, w) in enumerate(cases) if w}
