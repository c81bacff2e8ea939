"""Who speaks: source anchors of utterances, tails, people of a scene, speakers and their views; edits of a bank; receipts.

All of it is joins on ids with counts or sets per utterance, person or step; what is collected into an array is the
sources of one utterance or the clusters of one person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkspring.operators.graph import ancestors


def route(sources: DataFrame, texts: DataFrame, observations: DataFrame, people: DataFrame, tails: DataFrame, characters: DataFrame, pages: DataFrame, bank: DataFrame) -> DataFrame:
    """utterance, originals, anchors, locked, person, conflicting: the people that an utterance's own texts point to.

    ``sources(utterance, text, caption)``; ``texts(text, page, text_index, tail_index, character, bank_id)``;
    ``observations(page, character, cluster, bank_id)``; ``people(cluster, person)``; ``tails(page, text_index, tail_index)`` and
    ``characters(page, text_index, character)`` are associations; ``pages(page, n_tails, n_characters)``; ``bank(bank_id, disabled)``.
    An original is an observation of a text's character. It is an anchor if the utterance is no caption, text, tail and
    character are associated and on the page, and the text's own bank character is the observed one and not disabled. One
    person locks the utterance, several conflict.
    """
    seen = observations.select("page", "character", "cluster", F.col("bank_id").alias("_seen")).join(people, "cluster")
    found = sources.join(texts, "text").join(seen, ["page", "character"])
    linked = found.join(tails.withColumn("_tail", F.lit(True)).distinct(), ["page", "text_index", "tail_index"], "left").join(characters.withColumn("_character", F.lit(True)).distinct(), ["page", "text_index", "character"], "left").join(pages, "page", "left").join(bank.where("not coalesce(disabled, false)").select("bank_id", F.lit(True).alias("_stable")).distinct(), "bank_id", "left")
    good = ~F.coalesce("caption", F.lit(False)) & F.col("_tail") & F.col("_character") & (F.col("tail_index") >= 0) & (F.col("tail_index") < F.col("n_tails")) & (F.col("character") >= 0) & (F.col("character") < F.col("n_characters")) & F.col("_stable") & (F.col("bank_id") == F.col("_seen"))
    linked = linked.withColumn("_good", F.coalesce(good, F.lit(False)))
    told = linked.groupBy("utterance").agg(F.count("*").alias("originals"), F.count_if("_good").alias("anchors"), F.array_sort(F.collect_set(F.when(F.col("_good"), F.col("person")))).alias("_people"))
    every = sources.select("utterance").distinct().join(told, "utterance", "left")
    one, none = F.size("_people") == 1, F.array().cast(told.schema["_people"].dataType)
    every = every.withColumn("_people", F.coalesce("_people", none))
    return every.select("utterance", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("originals", "anchors")], one.alias("locked"), F.when(one, F.get("_people", F.lit(0))).alias("person"), F.when(F.size("_people") > 1, F.col("_people")).otherwise(none).alias("conflicting"))


def tail_evidence(boxes: DataFrame, tails: DataFrame, pages: DataFrame) -> DataFrame:
    """row, tail_index, sources, known: the tails that a row's text boxes are explicitly linked with, each source once.

    ``boxes(row, page, ord, source, text_index)``; ``tails(page, text_index, tail_index)``; ``pages(page, n_tails)``. Sources keep the
    order in which they come first. A tail that the page does not have is not ``known``: the association is broken.
    """
    met = boxes.where("text_index is not null").join(tails, ["page", "text_index"]).join(pages, "page", "left")
    known = (F.col("tail_index") >= 0) & (F.col("tail_index") < F.coalesce("n_tails", F.lit(0)))
    first = met.groupBy("row", "tail_index", "source").agg(F.min("ord").alias("ord"), F.bool_and(known).alias("known"))
    listed = F.array_sort(F.collect_list(F.when(F.col("source").isNotNull(), F.struct("ord", "source"))))
    return first.groupBy("row", "tail_index").agg(F.transform(listed, lambda s: s["source"]).alias("sources"), F.bool_and("known").alias("known"))


def person_context(clusters: DataFrame, observations: DataFrame, people: DataFrame, pages: DataFrame) -> DataFrame:
    """person, name, clusters, bank_ids: who may be met on some pages.

    ``clusters(cluster, person, current)``; ``observations(cluster, page, bank_id)``; ``people(person, name)``; ``pages(page)``. A cluster counts if it
    is of the current scope and seen on one of the pages; a person if it has such a cluster, a name, or any bank id.
    """
    near = observations.join(pages.select("page").distinct(), "page", "left_semi").select("cluster").distinct()
    here = clusters.where("current").join(near, "cluster", "left_semi").groupBy("person").agg(F.array_sort(F.collect_set("cluster")).alias("clusters"))
    ids = clusters.join(observations.where("bank_id is not null"), "cluster").groupBy("person").agg(F.array_sort(F.collect_set(F.col("bank_id").cast("string"))).alias("bank_ids"))
    out = people.join(here, "person", "left").join(ids, "person", "left")
    none = lambda c: F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c)
    return out.where("clusters is not null or name is not null or bank_ids is not null").select("person", "name", none("clusters"), none("bank_ids"))


def resolved_speaker(resolved: Column, person: Column, cluster: Column, anchor: Column, conflicting: Column, cluster_person: Column) -> Column:
    """struct(person, cluster, conflicts): inference decides; anchors and clusters that disagree are named, and a cluster of
    somebody else is let go. A row that is not resolved keeps what it has and is not judged."""
    other = cluster.isNotNull() & cluster_person.isNotNull() & ~cluster_person.eqNullSafe(person)
    codes = F.array_compact(F.array(
        F.when(anchor.isNotNull() & ~anchor.eqNullSafe(person), "source_anchor_disagrees"), F.when(F.coalesce(F.size(conflicting) > 0, F.lit(False)), "source_anchors_disagree"), F.when(other, "cluster_reference_disagrees"),
    ))
    good = F.coalesce(resolved, F.lit(False))
    return F.struct(person.alias("person"), F.when(~(good & other), cluster).alias("cluster"), F.when(good, codes).otherwise(F.array().cast("array<string>")).alias("conflicts"))


def identity_view(rows: DataFrame, policy: str) -> DataFrame:
    """``rows(policy, speaker, speaker_identity, addressees, addressee_identities, mentions, mention_identities)`` seen through identities.

    Rows of another policy stay as they are. ``mentions`` are (candidate, target); a candidate with an identity of its own
    in the map gets it as target.
    """
    ours = F.coalesce(F.col("policy") == policy, F.lit(False))
    target = lambda m: F.struct(m["candidate"].alias("candidate"), F.coalesce(F.element_at("mention_identities", m["candidate"]), m["target"]).alias("target"))
    swapped = {"speaker": F.col("speaker_identity"), "addressees": F.col("addressee_identities"), "mentions": F.transform("mentions", target)}
    return rows.withColumns({c: F.when(ours, x).otherwise(F.col(c)) for c, x in swapped.items()})


def checked(receipts: DataFrame, now: DataFrame, needs: DataFrame) -> DataFrame:
    """step, issue of every receipt: missing or changed artifacts, other inputs than those of the receipt, or an ancestor
    with one of these; null for an intact step.

    ``receipts(step, artifact_hash, input_hash)``; ``now(step, artifact_hash, input_hash)`` as they are found; ``needs(step, needs)``.
    """
    n = now.select("step", F.col("artifact_hash").alias("_a"), F.col("input_hash").alias("_i"))
    own = receipts.join(n, "step", "left").select("step", F.when(F.col("_a").isNull(), "missing").when(~F.col("_a").eqNullSafe(F.col("artifact_hash")), "changed").when(~F.col("_i").eqNullSafe(F.col("input_hash")), "dependencies").alias("own"))
    bad = own.where("own is not null").select(F.col("step").alias("ancestor"))
    below = ancestors(needs).join(bad, "ancestor", "left_semi").select("step").distinct().withColumn("_below", F.lit(True))
    return own.join(below, "step", "left").select("step", F.coalesce("own", F.when(F.col("_below"), "ancestor")).alias("issue"))


def edited(bank: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bank, refused): names and disabled prototypes and crops after ``edits(character, seq, kind, index, name)``.

    ``bank(character, name, vectors, crops, prototype_crops)``: crops are paths, prototype_crops the crop of each vector.
    Kinds: ``rename`` (the last one counts, blanks around it go, an empty name is none), ``disable_prototype`` and
    ``disable_crop`` (with all prototypes made of that crop). Nothing is removed. Refused: unknown characters and indices.
    """
    held = edits.join(bank.select("character", "vectors", "crops", "prototype_crops"), "character", "left").withColumn("_known", F.col("vectors").isNotNull())
    within = F.when(F.col("kind") == "rename", True).when(F.col("kind") == "disable_prototype", (F.col("index") >= 0) & (F.col("index") < F.col("vectors"))).when(F.col("kind") == "disable_crop", (F.col("index") >= 0) & (F.col("index") < F.size("crops")))
    held = held.withColumn("_good", F.col("_known") & F.coalesce(within, F.lit(False)))
    refused = held.where("not _good").select("character", "seq", "kind", F.when(F.col("_known"), "index").otherwise("character").alias("issue"))
    path = F.when(F.col("kind") == "disable_crop", F.get("crops", F.col("index")))
    made_of = F.filter(F.transform("prototype_crops", lambda c, i: F.when(c == path, i)), lambda i: i.isNotNull())
    prototypes = F.when(F.col("kind") == "disable_prototype", F.array("index")).when(F.col("kind") == "disable_crop", made_of)
    done = held.where("_good").withColumn("_path", path).withColumn("_prototypes", prototypes).groupBy("character").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_prototypes")))).alias("disabled_prototypes"), F.array_sort(F.collect_set("_path")).alias("disabled_crops"),
        F.max_by(F.when(F.col("kind") == "rename", F.struct(F.nullif(F.trim(F.coalesce("name", F.lit(""))), F.lit("")).alias("n"))), F.when(F.col("kind") == "rename", F.col("seq"))).alias("_name"),
    )
    out = bank.join(done, "character", "left")
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    return out.select("character", F.when(F.col("_name").isNotNull(), F.col("_name.n")).otherwise(F.col("name")).alias("name"), "vectors", none("disabled_prototypes", "int"), none("disabled_crops", "string")), refused


def promoted(bank: DataFrame, pending: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bank, pending) after the chosen of ``pending(pending, seq, keys)`` became characters of ``bank(character, appearance_keys, appearances)``.

    New characters take the ids after the largest, in order of ``seq``; what has been chosen is pending no more. What is promoted at once is
    the work of one chapter, so its numbers are one window.
    """
    moved = pending.join(chosen.select("pending").distinct(), "pending", "left_semi")
    last = bank.agg(F.coalesce(F.max("character"), F.lit(0)).alias("_last"))
    keys = F.array_sort(F.array_distinct("keys"))
    place = F.row_number().over(W.partitionBy("_last").orderBy("seq", "pending"))
    new = moved.join(F.broadcast(last)).select((F.col("_last") + place).cast("long").alias("character"), keys.alias("appearance_keys"), F.size(keys).cast("long").alias("appearances"))
    return bank.select("character", "appearance_keys", "appearances").unionByName(new), pending.join(moved.select("pending"), "pending", "left_anti")
