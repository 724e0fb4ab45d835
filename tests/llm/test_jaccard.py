import random
from collections import defaultdict

import pytest
from helpers_llm import awkward, empty, words

from ledgerlens.llm import components as components_module
from ledgerlens.llm import jaccard_join
from ledgerlens.llm.components import components
from ledgerlens.llm.jaccard_join import jaccard_components


def shingles(text):
    w = words(text)
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent=75):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i)) for i in ids}


def result(df, **kw):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df, **kw).collect()}


def copies(seed, groups=6, size=12, length=60):
    rng, rows, n = random.Random(seed), [], 100
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            rows.append((n, " ".join(copy), "en", "s", None))
            n += 1
    return rows


@pytest.mark.parametrize("hot", [50_000, 3])
def test_equals_brute_force(spark, hot):
    """With a low hot limit, shingles are dealt to several groups."""
    rows = copies(1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    assert result(df, hot_postings=hot) == brute([r[:2] for r in rows])


@pytest.mark.parametrize(("meeting", "percent"), [(5_000, 75), (4, 75), (4, 90), (4, 100)])
def test_components_that_share_a_passage(spark, meeting, percent):
    """One passage in groups of every size: its shingles meet many components, few of which link."""
    rng, rows = random.Random(meeting), []
    passage = [f"p{i}" for i in range(24)]
    for i in range(90):
        own = [f"o{i // 2}x{j}" for j in range(rng.choice([1, 2, 3, 5, 8, 40]))]
        rows.append((i, " ".join(passage[rng.randrange(3) :] + own)))
    found = result(spark.createDataFrame(rows, "doc_id long, text string"), meeting=meeting, percent=percent)
    assert found == brute(rows, percent)


def brute_rows(rows):
    """Components of ids by rows: ids are linked if any of their texts are."""
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t or "")) for i, t in rows]
    for n, (a, s) in enumerate(sets):
        for b, t in sets[n + 1 :]:
            if len(s & t) and 100 * len(s & t) >= 75 * len(s | t):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((i, len(s), root(i)) for i, s in sets)


@pytest.mark.parametrize("seed", range(2))
def test_rows_that_share_an_id_share_its_links(spark, seed):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(7, a), (7, b), (3, a), (9, b), (5, c), (5, None), (4, ""), (6, c), (8, d), (8, a + " z"), (1, None), (1, "")]
    rng = random.Random(seed)
    rows += [(rng.randrange(20, 60), r[1]) for r in copies(seed, groups=4)]
    rng.shuffle(rows)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), hot_postings=3 if seed else 50_000)
    assert sorted(tuple(r[c] for c in ("doc_id", "n_shingles", "component_id")) for r in found.collect()) == brute_rows(rows)


def test_tables_equal_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_awkward_rows(spark):
    rows = jaccard_components(awkward(spark)).collect()
    assert len(rows) == 9
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert [found[i] for i in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    assert found[4] == (1, 4) and found[5] == (1, 4)
    assert found[None] == (2, None)
    assert found[7] == (1, 7)


def test_threshold_is_met_exactly(spark):
    """Seven shingles each, six shared: 6 / 8 = 0.75 links; one fewer does not."""
    a = "a b c d e f g h i j k"
    rows = [(1, a, "", "", ""), (2, a.replace("k", "z"), "", "", ""), (3, "q r " + a[4:], "", "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    assert {k: v[1] for k, v in result(df).items()} == {1: 1, 2: 1, 3: 3}


def test_empty(spark):
    assert result(empty(spark)) == {}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = defaultdict(set)
    for r in components(edges, "a", "b").collect():
        found[r["component"]].add(r["node"])
    assert found == {0: set(range(201)), 500: {500, 501}}


def counting(monkeypatch, module):
    """Names of what the module writes from now on."""
    names, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: names.append(name) or write(df, name))
    return names


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    """Every round is some two thousand tasks that the driver keeps account of."""
    written = counting(monkeypatch, components_module)
    edges = spark.createDataFrame([(1, 2), (3, 1), (1, 3), (7, 9), (8, 7), (4, 4), (None, 5)], "a long, b long")
    assert {tuple(r) for r in components(edges, "a", "b").collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7)}
    assert len(written) == 1
    assert components(edges.limit(0), "a", "b").isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    group = {i: {i} for pair in links for i in pair if pair[0] != pair[1]}
    for a, b in links:
        if a != b and group[a] is not group[b]:
            group[a] |= group[b]
            group.update(dict.fromkeys(group[b], group[a]))
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, found)) == sorted((i, min(g)) for i, g in group.items())


def test_what_no_pair_asks_for_is_not_made(spark, monkeypatch):
    """The found components are not found again, and without pairs across them nothing is verified again."""
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"{base} a"), (2, f"{base} b"), (3, f"{base} c"), (4, "another text of some six words")]
    joined, starred = counting(monkeypatch, jaccard_join), counting(monkeypatch, components_module)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert joined.count("candidates") == 2 and joined.count("sets") == 1
    assert len(starred) <= 3  # of the links: stars at once or after a round; of those stars: at once
