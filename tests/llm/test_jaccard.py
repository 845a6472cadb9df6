import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from limnos.llm import jaccard

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, size=5):
    w = WORD.findall((text or "").encode().lower())
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, threshold=80):
    """id -> (set size, smallest id that links reach), and the pairs of different sets that link."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links, ids = set(), sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                if sets[i] != sets[j]:
                    links.add(frozenset([frozenset(sets[i]), frozenset(sets[j])]))
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}, links


def near_copies(seed, base, copies, edits, vocabulary=400):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    texts = []
    for _ in range(base):
        words = [word() for _ in range(r.choice((2, 5, 6, 9, 14, 30, 120)))]
        texts.append(" ".join(words))
        for _ in range(r.randrange(copies)):
            other = list(words)
            for _ in range(r.randrange(edits + 1)):
                k = r.randrange(len(other) or 1)
                other[k : k + r.randrange(2)] = [word()] * r.randrange(3)
            texts.append("  ".join(other).upper() if r.random() < 0.2 else " ".join(other))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_groups_and_links_equal_brute_force(docs, seed):
    texts = [*near_copies(seed, 40, 8, 3), None, "", "one", "one"]
    want, links = brute(list(enumerate(texts, 1)))
    join = jaccard.JaccardJoin(docs(texts).repartition(5))
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in join.groups().collect()} == want
    assert join.links().count() == len(links)


def test_a_shared_passage_and_a_large_group(docs):
    r = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda n: " ".join(f"u{r.randrange(10**9)}" for _ in range(n))
    texts = [f"{own(20)} {passage} {own(60)}" for _ in range(150)]
    base = [f"b{i}" for i in range(150)]
    for _ in range(150):
        words = list(base)
        for _ in range(r.randrange(6)):
            words[r.randrange(150)] = f"e{r.randrange(10**9)}"
        texts.append(" ".join(words))
    want, _ = brute(list(enumerate(texts, 1)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(docs(texts)).collect()} == want


def test_one_document_of_each_group_stays(docs):
    texts = near_copies(11, 30, 6, 2)
    want, _ = brute(list(enumerate(texts, 1)))
    kept = sorted(r["doc_id"] for r in jaccard.one_of_each(docs(texts)).collect())
    assert kept == sorted({c for _, c in want.values()})


def test_repeated_rows_leave_one(docs):
    df = docs(["some words that are said again and again", "other words that are said only here now"])
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(df.union(df)).collect()) == [1, 2]


def test_other_thresholds(docs):
    texts = near_copies(5, 25, 6, 5)
    want, _ = brute(list(enumerate(texts, 1)), 50)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(docs(texts), threshold=50).collect()} == want


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, r.randrange(101, 160)) for _ in range(80)] + [(300, 299), (298, 299)]
    got = {x["node"]: x["label"] for x in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(v == 100 for k, v in got.items() if 100 <= k < 160) and got[300] == 298


def test_the_boundary_follows_cost():
    small, large = {n: 1000 for n in range(2, 12)}, {n: 1000 for n in range(40, 64)}
    assert jaccard.boundary(small, 80, 100.0) > jaccard.boundary(small, 80, 0.01) == 2
    assert jaccard.boundary(large, 80) <= 40


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\té", max_size=30), max_size=6))
def test_shingles_are_those_of_the_words(texts):
    import pyarrow as pa

    rows, hashes = jaccard.shingles(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert len(set(hashes[rows == i].tolist())) == len(shingles(t))


def test_ids_beyond_the_broadcast_bound_are_joined(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    texts = near_copies(17, 25, 6, 3)
    want, _ = brute(list(enumerate(texts, 1)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(docs(texts)).collect()} == want
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(docs(texts)).collect()) == sorted({c for _, c in want.values()})


def test_the_order_of_shingles_does_not_matter(docs, monkeypatch):
    texts = near_copies(23, 20, 8, 3)
    want, _ = brute(list(enumerate(texts, 1)))
    for most, cost in ((1, 0.01), (jaccard.COMMON, 100.0)):
        monkeypatch.setattr(jaccard, "COMMON", most)
        join = jaccard.JaccardJoin(docs(texts), scan_cost=cost)
        assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in join.groups().collect()} == want


def test_repeated_rows_of_near_copies(docs):
    texts = near_copies(29, 20, 6, 2)
    want, _ = brute(list(enumerate(texts, 1)))
    df = docs(texts)
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(df.union(df)).collect()]
    assert sorted(rows) == sorted((i, *x) for i, x in want.items() for _ in range(2))


def test_rows_are_picked_by_id_and_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    clean = [" ".join(f"{x}{i}" for i in range(40)) for x in "defgh"]
    rows = [(1, a), (None, a + " more"), (None, clean[0]), (None, clean[1]), (None, b), (None, b + " more"), (5, c + " more"), (5, clean[2]), (2, c), (7, clean[3]), (7, clean[3]), (7, clean[4]), (None, None), (None, None), (8, ""), (9, "")]
    want = [(1, a), (None, clean[0]), (None, clean[1]), (5, clean[2]), (2, c), (7, clean[3]), (7, clean[4]), (None, None), (8, ""), (9, "")]
    got = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(x for x in map(repr, got) if "b0" not in x) == sorted(map(repr, want))
    assert len([t for _, t in got if t and "b0" in t]) == 1
