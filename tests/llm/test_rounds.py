"""Near copies of near copies join in rounds, without naming the pairs of a family."""

import random
from collections import Counter

from telemetra.llm import jaccard_join

SCHEMA = "doc_id long, text string"


def family(groups, members, seed=3):
    """Groups around variants of one text: members of a group link, groups do not."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(120)]
    texts = []
    for g in range(groups):
        own = list(base)
        for at in r.sample(range(len(own)), 5):
            own[at] = f"g{g}x{at}"
        for m in range(members):
            text = list(own)
            text[r.randrange(len(text))] = f"m{g}x{m}"
            texts.append(" ".join(text))
    r.shuffle(texts)
    return list(enumerate(texts))


def brute(rows, words, percent):
    sets = {i: {tuple(t.split()[k:k + words]) for k in range(len(t.split()) - words + 1)} for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            same = len(sets[i] & sets[j])
            if i < j and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in sets}


def test_pairs_of_a_family_follow_its_sets(spark, monkeypatch):
    named, verify = [], jaccard_join._verify
    monkeypatch.setattr(jaccard_join, "_verify", lambda pairs, *a: named.append(pairs.count()) or verify(pairs, *a))
    rows = family(8, 30)
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, SCHEMA), words=5, percent=80)
    got = {r.doc_id: r.component_id for r in out.collect()}
    assert got == brute(rows, 5, 80)
    assert sorted(Counter(got.values()).values()) == [30] * 8
    assert sum(named) < 4 * len(rows), named           # all pairs of the groups: 3480
