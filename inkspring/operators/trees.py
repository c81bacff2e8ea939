"""JSON trees as tables: every node of a VARIANT is a row, rules are joins, a rewritten tree is put together from its rows.

A document is walked level by level, all documents at once; the rounds are as many as the deepest one has levels. Nodes
are named by their pointer (``/a/0/b``; ``~`` and ``/`` in names are written ``~0`` and ``~1``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspring.operators.graph import _cut


def _step(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def walk(docs: DataFrame, key: str) -> DataFrame:
    """key, path, parent, name (of a member, else null), pos, level, kind, text of every node of ``docs(key, doc VARIANT)``.

    kind is object, array, string, number, boolean or null; text is the JSON of a node without children. Null documents have no nodes.
    """
    spark = docs.sparkSession
    kind = F.schema_of_variant("value")
    named = F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")
    level = docs.where("doc is not null").select(key, F.lit("").alias("path"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("name"), F.lit(0).alias("pos"), F.col("doc").alias("value"))
    depth, out = 0, None
    while True:
        level = _cut(level.withColumn("level", F.lit(depth)).withColumn("kind", named))
        if depth and level.isEmpty():
            return out
        rows = level.select(key, "path", "parent", "name", "pos", "level", "kind", F.when(~F.col("kind").isin("object", "array"), F.to_json("value")).alias("text"))
        out = rows if out is None else out.unionByName(rows)
        below = level.where(F.col("kind").isin("object", "array")).select(key, F.col("path").alias("parent"), "value")
        inner = below.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("pos", "name", "child"))
        path = F.concat("parent", F.lit("/"), _step(F.coalesce("name", F.col("pos").cast("string"))))
        level = inner.select(key, path.alias("path"), "parent", "name", F.col("pos").cast("int").alias("pos"), F.col("child").alias("value"))
        depth += 1


def quoted(name: Column) -> Column:
    """A name as a JSON string."""
    whole = F.to_json(F.array(name))
    return F.substr(whole, F.lit(2), F.char_length(whole) - 2)


def assembled(nodes: DataFrame, key: str) -> DataFrame:
    """key, json of the trees of ``nodes`` (as ``walk`` gives them, some taken out with all below them), names in order."""
    nodes = _cut(nodes)
    deepest = nodes.agg(F.max("level")).first()[0]
    if deepest is None:
        return nodes.select(key, F.col("text").alias("json"))
    done = nodes.where(F.col("level") == deepest)
    for level in range(deepest, -1, -1):
        member = F.when(F.col("name").isNotNull(), F.concat(quoted(F.col("name")), F.lit(":"), "json")).otherwise(F.col("json"))
        empty = F.when(F.col("kind") == "object", "{}").when(F.col("kind") == "array", "[]").otherwise(F.col("text"))
        if level == deepest:
            made = done.withColumn("json", empty)
        else:
            inside = made.groupBy(key, F.col("parent").alias("path")).agg(F.array_sort(F.collect_list(F.struct("pos", member.alias("m")))).alias("ms")).select(key, "path", F.array_join(F.transform("ms", lambda x: x["m"]), ",").alias("_in"))
            held = nodes.where(F.col("level") == level).join(inside, [key, "path"], "left")
            whole = F.when(F.col("kind") == "object", F.concat(F.lit("{"), "_in", F.lit("}"))).otherwise(F.concat(F.lit("["), "_in", F.lit("]")))
            made = held.withColumn("json", F.when(F.col("_in").isNotNull(), whole).otherwise(empty)).drop("_in")
    return made.select(key, "json")


def without_proofs(docs: DataFrame, key: str, drop: str = "enum", lists: str = "required", item: str = "evidence_refs") -> DataFrame:
    """key, json: schemas without the member ``drop`` of any object, and without ``item`` in any list called ``lists``."""
    nodes = walk(docs, key)
    gone = (F.col("path") == f"/{drop}") | F.col("path").endswith(f"/{drop}")
    cut = nodes.where(gone & F.col("name").isNotNull()).select(key, F.col("path").alias("_off"))
    item_of = F.col("parent").endswith(f"/{lists}") & F.col("name").isNull() & (F.col("kind") == "string") & (F.col("text") == quoted(F.lit(item)))
    # a node goes with the member above it: its own prefixes are looked up, so no two paths are compared
    steps = F.split("path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    dropped = nodes.select(key, "path", F.explode(prefixes).alias("_off")).join(cut, [key, "_off"], "left_semi").select(key, "path").distinct()
    return assembled(nodes.where(~F.coalesce(item_of, F.lit(False))).join(dropped, [key, "path"], "left_anti"), key)


class Rule:
    """What a field may hold: kinds, a range of numbers with open ends, or one of some values (as JSON)."""

    def __init__(self, path: str, kinds: tuple[str, ...], low: float | None = None, high: float | None = None, choices: tuple[str, ...] = (), whole: bool = False, above: float | None = None):
        bound = lambda x: None if x is None else float(x)
        self.row = (path, list(kinds), bound(low), bound(high), bound(above), list(choices), whole)


def violations(docs: DataFrame, key: str, rules: list[Rule], ordered: list[tuple[str, str]] = ()) -> DataFrame:
    """key, path, code of everything that breaks the rules: unknown_field, missing_field, wrong_type, out_of_range,
    not_allowed, and wrong_order for pairs of numbers that must not fall. A config that is no object is ``not_an_object``."""
    spark = docs.sparkSession
    nodes = _cut(walk(docs, key))
    # as many rows as fields
    table = F.broadcast(spark.createDataFrame([r.row for r in rules], "path string, kinds array<string>, low double, high double, above double, choices array<string>, whole boolean"))
    # objects that hold fields; what stands below another node belongs to that node
    inner = sorted({"/".join(r.row[0].split("/")[:n]) for r in rules for n in range(1, r.row[0].count("/") + 1)})
    roots = nodes.where("level = 0")
    objects = roots.where("kind = 'object'").select(key)
    held = nodes.where((F.col("level") > 0) & ~F.col("path").isin(*inner) & F.col("parent").isin(*inner)).join(objects, key, "left_semi")
    number = F.when(F.col("kind") == "number", F.col("text").cast("double"))
    met = held.join(table, "path", "left")
    code = (
        F.when(F.col("kinds").isNull(), "unknown_field")
        .when(~F.array_contains("kinds", F.col("kind")) | (F.col("whole") & ~F.col("text").rlike(r"^-?\d+$")), "wrong_type")
        .when((number < F.col("low")) | (number > F.col("high")) | (number <= F.col("above")), "out_of_range")
        .when((F.size("choices") > 0) & ~F.array_contains("choices", F.col("text")), "not_allowed")
    )
    wrong = met.select(key, "path", code.alias("code")).where("code is not null")
    wanted = objects.select(key, F.explode(F.array(*[F.lit(r.row[0]) for r in rules])).alias("path"))
    missing = wanted.join(nodes.select(key, "path"), [key, "path"], "left_anti").withColumn("code", F.lit("missing_field"))
    out = wrong.unionByName(missing).unionByName(roots.where("kind <> 'object'").select(key, "path", F.lit("not_an_object").alias("code")))
    for low, high in ordered:
        pair = nodes.where(F.col("path").isin(low, high)).groupBy(key).agg(F.max(F.when(F.col("path") == low, number)).alias("_a"), F.max(F.when(F.col("path") == high, number)).alias("_b"))
        out = out.unionByName(pair.where("_a > _b").select(key, F.lit(low).alias("path"), F.lit("wrong_order").alias("code")))
    return out
