"""Noise rules, names, links and the chapter stages against known answers and plain loops."""

import re

import pytest
from pyspark.sql import functions as F

from inkspring.functions import text as T
from inkspring.operators import checks
from inkspring.operators import identity as I
from inkspring.operators import names as N
from inkspring.plans import QUERIES
from inkspring.plans.stages import _proposals
from inkspring.registry import table


def test_noise_decisions(spark):
    want = {
        "Clench": ("keep", None, "noise_keep_exception"), "  WHOOSH!! ": ("exclude", "sfx", "whole_box_sfx"), "": ("exclude", "unknown", "empty_ocr"), " 　": ("exclude", "unknown", "empty_ocr"),
        "...!?": ("review", None, "possible_noise_requires_review"), "custom sound": ("exclude", "sfx", "whole_box_sfx"), "AllManga": ("exclude", "watermark", "whole_box_watermark"), "Next  chapter": ("exclude", "ui", "whole_box_ui"),
        "Haaahh": ("exclude", "sfx", "whole_box_breath_sound"), "hah": ("keep", None, None), "Scanlated by us": ("exclude", "watermark", "whole_box_credit"), "scanlated by": ("keep", None, None),
        "Read more at example.com/x": ("exclude", "watermark", "whole_box_credit_url"), "read more at www.x": ("exclude", "watermark", "whole_box_credit_url"), "read more at home": ("review", None, "possible_credit_requires_review"),
        "aaaaaah no": ("review", None, "possible_noise_requires_review"), "aaaaah": ("keep", None, None), "see https://x.y now": ("keep", None, None), "(https://x.y)": ("review", None, "possible_noise_requires_review"),
        "—": ("review", None, "possible_noise_requires_review"), "I saw the license there": ("keep", None, None), "gritting teeth in anger": ("keep", None, None),
    }
    rows = spark.createDataFrame([(t,) for t in want], "line string").select("line", T.squeeze("line").alias("t"), T.noise_key("line").alias("key"))
    got = checks.noise(rows, checks.noise_rules(spark, {"keep": ["Clench"], "sfx": ["custom sound"]})).collect()
    assert {r["line"]: (r["action"], r["kind"], r["reason"]) for r in got} == want
    with pytest.raises(ValueError):
        checks.noise_rules(spark, {"other": ["x"]})
    with pytest.raises(ValueError):
        checks.noise_rules(spark, {"sfx": [" "]})


def test_name_forms(spark):
    want = {
        "Arase-San": ("arase-san", "arase", "san", "address_form"), " Toru  –  KUN": ("toru-kun", "toru", "kun", "address_form"), "Yuki": ("yuki", "yuki", None, "name"), "Mei—tan": ("mei-tan", "mei", "tan", "address_form"),
        "Kohai": ("kohai", "kohai", None, "name"), "Other": (None,) * 4, "unknown-san": (None,) * 4, "San": (None,) * 4, "": (None,) * 4,
    }
    rows = spark.createDataFrame([(t,) for t in want], "v string").select("v", T.folded(T.squeeze("v")).alias("form"))
    assert {r[0]: tuple(r)[1:] for r in rows.select("v", *T.name_form("form")).collect()} == want


def test_valid_address(spark):
    names = ["Toru Mizushima", "Yuki-chan", None]
    rows = [("Tôi", names, True), ("quý vị", names, True), ("anh Toru Mizushima-san", names, True), ("YUKI", names, True), ("bà nội yuki-kun", names, True), ("Toru", names, False), ("anh", None, True), ("anh x", None, False), ("em other", names, False), (None, names, False)]
    got = T.valid_address(spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, term string, names array<string>"), "term", "names")
    assert [r["valid"] for r in got.orderBy("i").collect()] == [r[2] for r in rows]


def test_translation_issues(spark):
    rows = [
        ("Toru-san!", "Toru-San ơi", False, "", [], []), ("Toru-san, -CHAN", "x", False, "", [], ["missing_honorific:-san", "missing_honorific:-CHAN"]), ("a", " ", False, "", [], ["empty_or_invalid_translation"]), ("a", None, False, "", [], ["empty_or_invalid_translation"]),
        ("a", "b", True, " ", [], ["missing_review_reason"]), ("a", "b", None, "", [], ["invalid_review_fields"]), ("a", "b", False, "", None, ["invalid_glossary_proposals"]), ("a", "b", False, "", [("x", "y")] * 4, ["invalid_glossary_proposals"]),
        ("The Guild.", "b", False, "", [("x", "y")], ["missing_glossary_term:guild"]), ("guilds", "b", False, "", [], []), ("guild", "HỘI", False, "", [], []), ("a-sanx", "b", False, "", [], []),
    ]
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(rows)], "i int, t string, s string, r boolean, w string, p array<struct<source:string,vi:string>>")
    got = df.select("i", T.translation_issues(*map(F.col, ("t", "s", "r", "w", "p")), [("guild", "hội")]).alias("x")).orderBy("i").collect()
    assert [r["x"] for r in got] == [r[5] for r in rows]


def test_cells(spark):
    want = {None: "—", "": "—", " a\n b ": "a b", "<i>&|": "&lt;i&gt;&amp;\\|", "​": "—", "x\u0007y": "xy"}
    rows = spark.createDataFrame([(t,) for t in want], "v string")
    assert {r[0]: r[1] for r in rows.select("v", T.cell(F.col("v"))).collect()} == want


def links(spark, rows, apart):
    out = I.applied_links(spark.createDataFrame(rows, "ord int, cluster string, person string"), spark.createDataFrame(apart, "a string, b string"))
    return {r["cluster"]: (r["person"], r["status"]) for r in out.collect()}


def test_links_in_order(spark):
    # b joins a; c may not follow b, as a and c are two persons; b stays
    assert links(spark, [(1, "b", "a"), (2, "c", "b")], [("a", "c")]) == {"a": ("a", "own"), "b": ("a", "linked"), "c": ("c", "review")}
    # x is b's when b moves on to a: b keeps x, and goes on as a person
    assert links(spark, [(1, "x", "b"), (2, "b", "a")], []) == {"x": ("b", "linked"), "b": ("a", "linked"), "a": ("a", "own")}
    # an empty person goes on as the one its clusters moved to
    assert links(spark, [(1, "b", "a"), (2, "c", "b")], []) == {"a": ("a", "own"), "b": ("a", "linked"), "c": ("a", "linked")}
    # what is forbidden for a person holds for the one it became
    assert links(spark, [(1, "b", "a"), (2, "d", "c"), (3, "c", "a")], [("b", "d")])["c"] == ("c", "review")
    assert links(spark, [(1, "b", "a"), (2, "c", "a")], [("b", "c")])["c"] == ("c", "review")
    assert I.applied_links(spark.createDataFrame([], "ord int, cluster string, person string"), spark.createDataFrame([("a", "b")], "a string, b string")).count() == 0


def test_links_look_once_at_what_is_forbidden():
    """A link looks at its own two persons, not at all pairs; the result is that of a look at all pairs."""
    import random

    class Once(list):
        looks = 0

        def __iter__(self):
            self.looks += 1
            return super().__iter__()

    def plainly(rows, pairs):
        ends = {x for _, *two in rows for x in two}
        of, to, refused = {c: c for c in ends}, {}, set()

        def root(p):
            return root(to[p]) if p in to else p

        for _, c, p in sorted(rows):
            new, old = root(p), root(of[c])
            if new != old and any({root(a), root(b)} == {old, new} for a, b in pairs):
                refused.add(c)
            elif new != old:
                of[c] = new
                if old not in of.values():
                    to[old] = new
        return {(c, root(p), "review" if c in refused else "linked" if root(p) != c else "own") for c, p in of.items()}

    for seed in range(300):
        r = random.Random(seed)
        n = r.randint(2, 12)
        rows = [(i, r.randrange(n), r.randrange(n)) for i in range(r.randint(1, 30))]
        pairs = Once((r.randrange(n + 1), r.randrange(n + 1)) for _ in range(r.randint(0, 10)))
        assert set(I._fold(rows, pairs)) == plainly(rows, list(pairs))
        assert pairs.looks <= 2


def plain_parse(texts, proposals, groups):
    """One chapter, step by step over all its texts."""
    canon = {}
    for _, g, name in sorted(groups):
        if g and name and name.strip():
            canon[g] = name
    current, good, rules, warned = dict(texts), [], [], []
    for idx, uid, old, new, g in sorted(proposals):
        if uid not in texts or not (old or "").strip() or not (new or "").strip():
            warned.append((idx, "invalid_name_data"))
            continue
        if g not in canon:
            warned.append((idx, "ungrouped_name"))
            g = None
        change = N.scope_kind(old, new)
        if change:
            warned.append((idx, "scope_change_not_applied"))
        good.append((idx, uid, old, new, g, change))
        if not change and (N.Key(old).flat, new) not in [(N.Key(o).flat, n) for _, o, n in rules]:
            rules.append((idx, old, new))
    names = [*canon.values(), *(o for _, _, o, n, _, c in good if c or N.Key(o).flat == N.Key(n).flat)]
    places = {i: [[a, b, a, b] for a, b in N.find_all(texts[uid], old)] for i, uid, old, *_ in good}
    for idx, old, new in rules:
        total = 0
        for uid, text in current.items():
            hits = N.replacement_matches(text, old, names)
            for a, b in reversed(hits):
                text = text[:a] + new + text[b:]
            current[uid] = text
            total += len(hits)
            for i, u, *_ in good:
                for place in places[i] if u == uid else []:
                    place[0], place[1] = N.move_span((place[0], place[1]), hits, len(new))
        if not total:
            warned.append((idx, "no_match"))
    out = {}
    for i, uid, old, new, g, change in good:
        for x, y, a, b in places[i]:
            out[uid, x, y, current[uid][x:y]] = (uid, i, old, current[uid][x:y], g, x, y, a, b)
        if not places[i]:
            name = old if change else new
            out[uid, old, name] = (uid, i, old, name, g, None, None, None, None)
    return current, sorted(out.values(), key=repr), sorted(warned)


def test_parse(spark, sf):
    t, p, g = _proposals(spark, sf)
    extra = spark.createDataFrame([(0, 90, 99, "x", "y", "g0"), (0, 91, 0, None, "y", "g0"), (0, 92, 0, "nowhere", "nowheres", None)], p.schema)
    p = p.unionByName(extra)
    texts, candidates, warnings = N.parsed(t, p, g)
    by = lambda df, cols: {c: [tuple(r)[1:] for r in rows] for c, rows in _split(df.select(*cols).collect()).items()}
    got_texts, got, warned = by(texts, ["chapter", "uid", "text"]), by(candidates, ["chapter", "uid", "idx", "old_name", "name", "group_id", "start", "end", "original_start", "original_end"]), by(warnings, ["chapter", "idx", "reason"])
    given, props, groups = by(t, t.columns), by(p, ["chapter", "idx", "uid", "old_name", "new_name", "group_id"]), by(g, ["chapter", "idx", "group_id", "canonical_name"])
    for c in given:
        current, want, said = plain_parse(dict(given[c]), props[c], groups.get(c, []))
        assert dict(got_texts[c]) == current
        assert sorted(got.get(c, []), key=repr) == want
        assert sorted(warned.get(c, [])) == said
    assert any(dict(got_texts[c]) != dict(given[c]) for c in given)


def _split(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_spans_and_cascades_of_whole_turns(spark, sf):
    from inkspring.plans.sequential import NAMES, RULES

    turns = {(r["conv_id"], r["turn"]): r["text"] for r in table(spark, sf, "conversations").collect()}
    for r in QUERIES["T2_protected_matches"](spark, sf).collect():
        text = turns[r["conv_id"], r["turn"]]
        whole = [m.span() for n in NAMES for m in re.finditer(rf"(?<!\w){n}(?!\w)", text, re.I)]
        want = [m.span() for m in re.finditer(r"(?<!\w)the(?!\w)", text, re.I) if not any(a <= m.start() and m.end() <= b for a, b in whole)]
        assert [tuple(x) for x in r["spans"]] == want
    for r in QUERIES["T3_cascade"](spark, sf).collect():
        text = turns[r["conv_id"], r["turn"]]
        for old, new in RULES:
            text = re.sub(rf"(?<!\w){old}(?!\w)", new, text, flags=re.I)
        assert r["text"] == text


def test_links_query(spark, sf):
    e = [r for r in table(spark, sf, "events").collect() if r["event_type"] == "signup" and r["value"] > 45]
    rows = [(r["event_id"], r["user_id"], r["user_id"] + 1 + r["event_id"] % 3) for r in e]
    ids = {x for _, *ends in rows for x in ends}
    want = sorted(I._fold(rows, [(i, i + 5) for i in ids if i % 4 == 0]))
    assert sorted(tuple(r) for r in QUERIES["U10_apply_links"](spark, sf).collect()) == want


def test_register(spark, sf):
    from collections import defaultdict

    from inkspring.plans.identities import _register_inputs

    frames = _register_inputs(spark, sf)
    mentions, members, crops, groups, named, anchors = ([tuple(r) for r in f.collect()] for f in frames)
    selections, proposals, names = ([tuple(r) for r in f.collect()] for f in I.registered(*frames))
    canon, of, n, known = dict(groups), dict(members), dict(crops), {p for (p,) in named}

    def order(votes):
        per = defaultdict(dict)
        for o, occ, kind, g in sorted(votes):
            per[g].setdefault(occ, (o, kind))
        score = lambda g: (-len(per[g]), *(-sum(k == m for _, k in per[g].values()) for m in I.MENTIONS), min(o for o, _ in per[g].values()), g)
        return [(g, len(per[g])) for g in sorted(per, key=score)]

    votes = defaultdict(list)
    for o, occ, kind, ok, g, p in mentions:
        if ok and g in canon:
            for mid in (m for m in of if of[m] == p):
                votes[mid].append((o, occ, kind, g))
    want, winners = [], {}
    for mid, v in votes.items():
        ranked = order(v)
        g, support = ranked[0]
        fine = of[mid] in known or (n.get(mid, 0) >= 8 and support >= 3)
        why = ("below_crop_threshold" if n.get(mid, 0) < 8 else "below_confirmed_mention_threshold") if not fine else "competing_name_groups" if len(ranked) > 1 else None
        want.append((mid, of[mid], g, canon[g], n.get(mid, 0), support, of[mid] in known, fine, why))
        if fine:
            winners[mid] = (g, support)
    assert sorted(selections, key=repr) == sorted(want, key=repr)
    target = {}
    for g in sorted({g for g, _ in winners.values()}):
        fixed = {p for x, p in anchors if x == g and p in known}
        fresh = [m for m, (x, _) in winners.items() if x == g and of[m] not in known]
        if len(fixed) <= 1 and fresh:
            to = next(iter(fixed)) if fixed else of[max(fresh, key=lambda m: (n.get(m, 0), -m))]
            for m in sorted(fresh):
                if of[m] != to and of[m] not in target:
                    target[of[m]] = (g, to, winners[m][1])
    assert sorted(proposals) == sorted((p, *t) for p, t in target.items()) and proposals
    held = defaultdict(list)
    for mid, (g, _) in winners.items():
        identity = target[of[mid]][1] if of[mid] in target else of[mid]
        held[identity] += [v for v in votes[mid] if v[3] == g]
    said = []
    for identity, v in held.items():
        if identity not in known:
            ranked = order(v)
            said.append((identity, ranked[0][0], canon[ranked[0][0]], ranked[0][1], len(ranked) > 1))
    assert sorted(names) == sorted(said) and names


def test_halving(spark):
    from inkspring.operators import graph as G

    rows = [("a", i, c) for i, c in enumerate([5, 1, 1, 1, 9, 1])] + [("b", 0, 100)] + [("c", 0, 1), ("c", 1, 1)]
    got = {(r["k"], r["i"]): r["node"] for r in G.halved(spark.createDataFrame(rows, "k string, i int, c int"), "k", "i", "c", 7).collect()}
    assert [got["a", i] for i in range(6)] == [":split:0"] * 3 + [":split:1:split:0", ":split:1:split:1:split:0", ":split:1:split:1:split:1"]
    assert got["b", 0] == "" and got["c", 0] == got["c", 1] == ""


def test_partition_of_masks():
    import numpy as np

    from inkspring.operators import masks as M

    # two bodies joined by a thin bridge, a thin tail, a lobe of its own and a speck
    m = M.draw([(1, 1, 11, 11), (20, 1, 30, 11), (11, 5, 20, 6), (5, 11, 6, 18), (34, 14, 39, 19), (36, 30, 37, 31)], 40, 32)
    bodies, bridge, tail, links = M.partition(m, [(4, 12, 7, 16)])
    assert links == [[1, 2]] and bridge[5, 11:20].sum() >= 5 and not bridge[:, :8].any()
    assert tail[12:18, 5].all() and tail[30, 36] and bodies[16, 36] > 0 and bodies.max() == 3
    assert ((bodies > 0).astype(int) + bridge + tail == m).all()
    # without a tail box the tail grows its body; a mask without large pieces is one body
    assert M.partition(m, [])[0][14, 5] == 1
    line = M.draw([(0, 3, 30, 4)], 32, 8)
    assert (M.partition(line, [])[0] == line).all()
    assert M.groups([], [], []) == [] and M.partition(np.zeros((4, 4), bool), [])[0].max() == 0


def test_lobes_fusion_and_support():
    import numpy as np

    from inkspring.operators import masks as M

    a, b, c = M.draw([(0, 0, 6, 6)], 60, 40), M.draw([(1, 1, 5, 5)], 60, 40), M.draw([(30, 0, 36, 6)], 60, 40)
    assert M.fused([a, b, c]) == [[0, 1], [2]] and M.fused([]) == []
    speck, far = M.draw([(8, 2, 9, 3)], 60, 40), M.draw([(57, 37, 58, 38)], 60, 40)
    parts = M.lobes(a | c | speck | far)
    assert [int(p.sum()) for p in parts] == [37, 36, 1]
    got = M.groups([a | speck, c], [(0, 0, 20, 20), (20, 0, 50, 20)], [])
    assert [(g["members"], g["bounds"], g["panels"], g["bodies"]) for g in got] == [([0], [0, 0, 9, 6], [0], 1), ([1], [30, 0, 36, 6], [1], 1)]
    none = np.zeros_like(a)
    assert M.supported(a, a, none) == 1.0 and M.supported(a, none, none) == 0.0 and M.supported(a, a, a) == 0.0


def test_group_queries(spark, sf):
    from inkspring.plans import rasters as R

    boxes = _split([tuple(r) for r in R._fine(spark, sf).orderBy("page", "ord").collect()])
    got = _split([tuple(r) for r in QUERIES["M10_build_groups"](spark, sf).collect()])
    for page, rows in boxes.items():
        want = [tuple(g.values()) for g in R.page_groups([dict(zip(("ord", "x1", "y1", "x2", "y2"), r[1:], strict=True)) for r in rows])]
        assert sorted(map(repr, (r[1:] for r in got.get(page, [])))) == sorted(map(repr, want))
    shares = QUERIES["M9_visual_hint"](spark, sf).collect()
    assert len(shares) == len(boxes) and all(0 <= r["fraction"] <= 1 and (r["fraction"] < 0.65) == bool(r["rejected"]) for r in shares)
