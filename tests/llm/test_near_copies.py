"""Near copies by exact similarity against all pairs."""

import numpy as np
from carrel.llm import components, nearcopies

from tests.llm.test_first_five import documents, shingles


def kept_by_all_pairs(rows):
    """Rows (doc_id, text) that stay: the first of each connected group, smallest ids first."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x == sets[j] or len(x & sets[j]) >= 0.8 * len(x | sets[j]) - 1e-9:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return sorted({rows[g] for g in group}, key=str)


def test_near_copies_that_fingerprints_miss(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 5_000, 120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):  # copies with one or two words changed, some at the edge of the threshold
        own = list(rows[-1][1].split() if i % 3 else base)
        for at in rng.choice(len(own), 1 + i % 2, replace=False):
            own[at] = f"n{i}"
        rows.append((i, " ".join(own)))
    boiler = " ".join(f"b{i}" for i in range(60))
    rows += [(100 + i, boiler + " " + " ".join(f"{i}x{j}" for j in range(25 if i % 2 else 5))) for i in range(30)]
    rows += [(200, None), (201, ""), (202, "one two"), (203, "ONE  two"), (204, "one")]
    rows += [(7, "another text of the same id that is no copy of the other"), (None, "a row without an id that has text"), (None, "a row without an id that has text"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in nearcopies.keep_one(docs).collect()), key=str)
    expected = kept_by_all_pairs(rows)
    texts = lambda found: sorted(((d, sorted(shingles(t))) for d, t in found), key=str)
    assert texts(got) == texts(expected) and len(got) < len(rows) - 20
    assert nearcopies.keep_one(docs.limit(0)).count() == 0


def test_near_copies_of_a_table_are_those_of_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(r.doc_id for r in nearcopies.keep_one(docs).collect())
    assert got == sorted(d for d, _ in kept_by_all_pairs(rows))


def template_family(n, planted, share, seed, words=240):
    """Texts that share all but their last words, any two as similar as share, and near copies of some."""
    rng = np.random.default_rng(seed)
    tail = round((1 - share) / (1 + share) * (words - 4)) - 4
    rows = [[f"t{seed}x{i}" for i in range(words - tail)] + [f"u{seed}x{i}x{j}" for j in range(tail)] for i in range(n)]
    for j in range(planted):
        own = list(rows[int(rng.integers(0, n))])
        for at in rng.choice(words, int(rng.integers(1, 4)), replace=False):
            own[at] = f"p{seed}x{j}x{at}"
        rows.append(own)
    return [" ".join(r) for r in rows]


def test_near_copies_in_families_of_one_template(spark):
    """Below the threshold everyone is like everyone; the near copies among them are found as all pairs find them."""
    texts = template_family(900, 40, 0.65, 1) + template_family(900, 40, 0.70, 2)
    sets = [shingles(t) for t in texts]
    common = {}
    for i, own in enumerate(sets):
        for gram in own:
            common.setdefault(gram, []).append(i)
    shared = np.zeros((len(sets), len(sets)), np.int32)
    for members in common.values():
        at = np.array(members)
        shared[np.ix_(at, at)] += 1
    sizes = np.diag(shared)
    near = shared >= 0.8 * (sizes[:, None] + sizes - shared) - 1e-9
    group = np.arange(len(sets))
    for _ in range(20):
        group = np.array([group[near[i]].min() for i in range(len(sets))])
    got = sorted(r.doc_id for r in nearcopies.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect())
    expected = sorted(set(group.tolist()))
    assert len(expected) < len(texts) - 60
    assert set(expected) <= set(got) and len(got) - len(expected) <= 1  # a recall of 0.99 of some eighty pairs


def test_crowded_classes_meet_whatever_they_have_in_common(spark):
    """Near copies whose common shingles all stand in more than 32 crowded classes, none of them beside a class of its own."""
    rng = np.random.default_rng(5)
    texts = [[f"w{i}" for i in range(240)] for _ in range(120)]
    for j, own in enumerate(texts):  # a third of all changes is common to 40 texts, so no shingle of a pair is rare
        for at in range(3, 240, 15):
            own[at] = f"v{at}x{rng.integers(0, 3)}"
    texts = [" ".join(t) for t in texts]
    sets = [set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    shingled = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = nearcopies._sketches(shingled, 5, nearcopies.shape(120)).select("doc_id", "class")
    number = {r.doc_id: r["class"] for r in made.collect()}
    keyed = shingled.selectExpr("doc_id", "xxhash64(doc_id, text) as key")
    classes = made.join(keyed, "doc_id").selectExpr("class", "struct(false as missing, doc_id, key) as first")
    found = nearcopies._by_shingles(classes.select("class"), shingled, classes, spark.createDataFrame([], "a long, b long"), 0.8, 5)
    joined = {}
    for r in found.collect():
        joined.setdefault(r.a, set()).add(r.b)
        joined.setdefault(r.b, set()).add(r.a)

    def reach(start, links):
        seen, todo = {start}, [start]
        while todo:
            for x in links.get(todo.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    near = {}
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                near.setdefault(number[i], set()).add(number[j])
                near.setdefault(number[j], set()).add(number[i])
    assert near
    assert {reach(c, joined) for c in number.values()} == {reach(c, near) for c in number.values()}


def test_crowded_classes_send_only_the_fronts_of_their_sets(spark, monkeypatch):
    """A family below the threshold: no table has a row for each of its shingles, and components are found before and after one meeting in parts."""
    staged = []

    def counted(df, name, stage=nearcopies.stage):
        out = stage(df, name)
        staged.append((name, out.count()))
        return out

    monkeypatch.setattr(nearcopies, "stage", counted)
    texts = template_family(400, 20, 0.70, 3)
    got = nearcopies.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).count()
    names, rows = [name for name, _ in staged], dict(staged)
    assert got == 400 and 0 < rows["near-crowded"] <= len(texts)
    assert names.count("near-labels") <= 2
    assert max(n for name, n in staged[names.index("near-crowded") :]) < 0.25 * sum(len(shingles(texts[i])) for i in range(rows["near-crowded"]))


def test_components_of_many_edges_are_those_of_few(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(30)]
    found = []
    for most in (len(rows), len(rows) // 3, 0):
        monkeypatch.setattr(components, "TASK_ROWS", most)
        found.append(sorted(map(tuple, components.connected(spark.createDataFrame(rows, "a long, b long")).collect())))
    assert found[0] == found[1] == found[2] and (1030, 1000) in found[0]
