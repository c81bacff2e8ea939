"""Identity registration: links between clusters with vetoes, merged characters, pluggable decisions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators.graph import components


def _fold(links: list[tuple], forbidden: list[tuple]) -> list[tuple]:
    """(cluster, person, status) after links in order; every cluster starts as its own person.

    ``held`` counts a person's clusters. ``apart`` has, for the mark of a person as they are by now, the marks of those that
    they may not be one with; where a person goes on as another, the smaller set is moved.
    """
    ends = {x for _, *pair in links for x in pair}
    of, to, held, refused = {c: c for c in ends}, {}, dict.fromkeys(ends, 1), set()
    mark, apart = {c: c for c in ends}, {}
    for a, b in forbidden:
        if a != b and a in ends and b in ends:
            apart.setdefault(a, set()).add(b)
            apart.setdefault(b, set()).add(a)

    def root(p):
        top = p
        while top in to:
            top = to[top]
        while p != top:
            to[p], p = top, to[p]
        return top

    for _, cluster, person in sorted(links):
        new, old = root(person), root(of[cluster])
        if new == old:
            continue
        if mark[new] in apart.get(mark[old], ()):
            refused.add(cluster)
            continue
        held[old] -= 1
        held[new] += 1
        of[cluster] = new
        # a person whose clusters have all moved goes on as the new one
        if not held[old]:
            to[old] = new
            few, many = sorted((mark[old], mark[new]), key=lambda m: len(apart.get(m, ())))
            mark[new] = many
            for m in apart.pop(few, ()):
                apart[m].discard(few)
                apart[m].add(many)
                apart[many].add(m)
    return [(c, root(p), "review" if c in refused else "linked" if root(p) != c else "own") for c, p in of.items()]


def applied_links(links: DataFrame, forbidden: DataFrame) -> DataFrame:
    """cluster, person, status for ``links(ord, cluster, person)`` applied in order, with ``forbidden(a, b)`` persons apart.

    A link moves one cluster to a person; a person left without clusters goes on as the one they moved to. A link that
    would join two persons (as they are by then) that may not be one is refused alone: its cluster is marked for review,
    all other links count. What the order decides stays within a component of the links, so components, the clusters of
    a story that may be one person, are folded side by side.
    """
    label = components(links.select(F.col("cluster").alias("a"), F.col("person").alias("b")))
    rows = links.join(label, F.col("cluster") == F.col("node")).select(F.col("component").alias("among"), "ord", "cluster", "person")
    # persons that may not be one matter where both are in one component
    ends = forbidden.join(label.select(F.col("node").alias("a"), "component"), "a").join(label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
    apart = ends.where("component = cb").select(F.col("component").alias("among"), "a", "b")

    def fold(key: tuple, f: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        out = _fold(list(f[["ord", "cluster", "person"]].itertuples(index=False, name=None)), list(g[["a", "b"]].itertuples(index=False, name=None)))
        return pd.DataFrame(out, columns=["cluster", "person", "status"])

    kind = dict(links.dtypes)["cluster"]
    return rows.groupBy("among").cogroup(apart.groupBy("among")).applyInPandas(fold, f"cluster {kind}, person {kind}, status string")


# How a mention was made, the strongest first.
MENTIONS = ["introduction", "direct_address", "reference"]


def _ranked(votes: DataFrame, key: str) -> DataFrame:
    """``votes(key, group_id, occurrence, mtype, ord)`` as key, group_id, support, options and place (1 for the winner).

    Groups are ordered by distinct occurrences, then by those of each kind of mention, then by the first.
    """
    each = votes.groupBy(key, "group_id", "occurrence").agg(F.min(F.struct("ord", "mtype")).alias("m"))
    per = each.groupBy(key, "group_id").agg(F.count("*").alias("support"), *[F.count_if(F.col("m.mtype") == k).alias(f"_{k}") for k in MENTIONS], F.min("m.ord").alias("first"))
    order = [F.col("support").desc(), *[F.col(f"_{k}").desc() for k in MENTIONS], "first", "group_id"]
    w = W.partitionBy(key)
    return per.withColumn("place", F.row_number().over(w.orderBy(*order))).withColumn("options", F.count("*").over(w)).drop(*[f"_{k}" for k in MENTIONS])


def registered(mentions: DataFrame, members: DataFrame, crops: DataFrame, groups: DataFrame, named: DataFrame, anchors: DataFrame, min_crops: int = 8, min_events: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selections, proposals, names): the names that analysed mentions give to bank characters and their persons.

    ``mentions(ord, occurrence, mtype, confirmed, group_id, person)``, ``members(mid, person)``: bank characters of
    persons; ``crops(mid, n)``: their crops in the chapter; ``groups(group_id, canonical_name)``; ``named(person)``:
    persons that had a name before; ``anchors(group_id, person)``: those of them that a group's names lead to.

    Every confirmed mention of a known person and group votes, once an occurrence, for its group with all characters of
    the person. A character's winner is eligible if its person is named, or crops and support reach the limits. Of the
    characters that one group wins, those without a name are proposed to join the group's anchor, or else the one of
    them with most crops; a group with several anchors joins none. Names go to persons after the proposals, by the votes
    of all their eligible characters; a person named before keeps its name.
    """
    sound = mentions.where("confirmed").join(groups.select("group_id"), "group_id", "left_semi")
    votes = sound.join(members, "person").select("mid", "person", "group_id", "occurrence", "mtype", "ord")
    best = _ranked(votes.drop("person"), "mid").where("place = 1").drop("place", "first")
    old = named.select("person", F.lit(True).alias("was_named")).distinct()
    selections = best.join(members, "mid").join(crops, "mid", "left").join(old, "person", "left").join(groups, "group_id")
    was = F.coalesce("was_named", F.lit(False))
    n = F.coalesce("n", F.lit(0))
    enough = (n >= min_crops) & (F.col("support") >= min_events)
    reason = F.when(~(was | enough), F.when(n < min_crops, "below_crop_threshold").otherwise("below_confirmed_mention_threshold")).when(F.col("options") > 1, "competing_name_groups")
    selections = selections.select("mid", "person", "group_id", "canonical_name", n.alias("crops"), "support", was.alias("was_named"), (was | enough).alias("eligible"), reason.alias("review"))

    chosen = selections.where("eligible")
    fixed = anchors.join(old.select("person"), "person", "left_semi").distinct().groupBy("group_id").agg(F.count("*").alias("fixed"), F.min("person").alias("anchor"))
    fresh = chosen.where(~F.col("was_named"))
    lead = fresh.groupBy("group_id").agg(F.max_by("person", F.struct("crops", -F.col("mid"))).alias("lead"))
    joined = fresh.join(fixed, "group_id", "left").join(lead, "group_id").where("coalesce(fixed, 0) <= 1").withColumn("target", F.coalesce("anchor", "lead"))
    proposals = joined.where("person <> target").groupBy("person").agg(F.min_by(F.struct("group_id", "target", "support"), F.struct("group_id", "mid")).alias("p")).select("person", "p.group_id", "p.target", "p.support")

    moved = chosen.join(proposals.select("person", "target"), "person", "left").withColumn("identity", F.coalesce("target", "person"))
    won = votes.join(moved.select("mid", "group_id", "identity"), ["mid", "group_id"]).select("identity", "group_id", "occurrence", "mtype", "ord")
    names = _ranked(won, "identity").where("place = 1").join(groups, "group_id").join(old.withColumnRenamed("person", "identity"), "identity", "left_anti")
    return selections, proposals, names.select("identity", "group_id", "canonical_name", "support", (F.col("options") > 1).alias("conflict"))


def merged(bank: DataFrame, merges: DataFrame) -> DataFrame:
    """id, into, n, disabled of ``bank(id, n)`` after ``merges(id, into)``: counts move, sources are disabled."""
    m = merges.dropDuplicates(["id"])
    moved = bank.join(m, "id", "left").withColumn("into", F.coalesce("into", "id"))
    total = moved.groupBy("into").agg(F.sum("n").alias("n"))
    return moved.select("id", "into").join(total.withColumnRenamed("into", "id"), "id", "left").select("id", "into", F.coalesce("n", F.lit(0)).alias("n"), (F.col("id") != F.col("into")).alias("disabled"))


Decide = Callable[[dict], "int | None"]


def resolved_by(matches: DataFrame, chain: list[Decide]) -> DataFrame:
    """key, choice, decided_by for ``matches(key, candidates)``: the first decision of a chain that names an offered id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for key, offered in zip(f["key"], f["candidates"], strict=True):
                ids = [c["id"] for c in offered]
                made = next(((x, i) for i, d in enumerate(chain) if (x := d({"key": key, "candidates": offered})) is not None), (None, None))
                if made[0] is not None and made[0] not in ids:
                    raise ValueError(f"decision {made[1]} named an id that was not offered")
                out.append((key, made[0], made[1]))
            yield pd.DataFrame(out, columns=["key", "choice", "decided_by"]).astype({"choice": "Int64", "decided_by": "Int64"})

    return matches.select("key", "candidates").mapInPandas(run, "key long, choice long, decided_by long")
