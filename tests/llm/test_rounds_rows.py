"""Rounds of centres read only buckets that joined something; a pair is named once."""

import random
from collections import defaultdict

from test_rounds import SCHEMA, brute, family
from telemetra.llm import jaccard_join


def passages(count, seed=5):
    """Texts that share a passage and do not link."""
    r = random.Random(seed)
    shared = [f"p{i}" for i in range(60)]
    return [" ".join(shared + [f"t{i}x{r.randrange(10 ** 6)}" for _ in range(60)]) for i in range(count)]


def test_buckets_without_links_leave_the_rounds(spark, monkeypatch):
    read, unsettled = [], jaccard_join._unsettled
    monkeypatch.setattr(jaccard_join, "_unsettled", lambda met, links: read.append(met.count()) or unsettled(met, links))
    rows = family(6, 20)
    rows += list(enumerate(passages(60), len(rows)))
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, SCHEMA), words=5, percent=80)
    assert {r.doc_id: r.component_id for r in out.collect()} == brute(rows, 5, 80)
    # all buckets, those that joined in each round, and at last all that are left
    assert len(read) > 3 and 2 * sum(read[2:-1]) < read[-1], read


def test_pairs_of_large_buckets_are_named_once(spark):
    r, percent = random.Random(9), 80
    texts = [t for _, t in family(1, 12)] + [f"{t} z{i}" for i, t in enumerate(passages(6))]
    sets = jaccard_join.shingle_sets([t.encode() for t in texts], 5)
    sketch = jaccard_join.sketches(sets).tolist()
    large = defaultdict(set)
    for sig in r.sample(range(10 ** 9), 60):
        large[sig] = set(r.sample(range(len(texts)), r.randrange(9, 14)))
    buckets = spark.createDataFrame([(s, n, n, len(own)) for s, own in large.items() for n in own],
                                    "sig long, node long, component long, size long")
    facts = spark.createDataFrame([(i, len(sets[i]), *sketch[i], None) for i in range(len(texts))], "node long, n long, "
                                  + ", ".join(f"{w} long" for w in jaccard_join.SKETCH) + ", z array<long>")

    def near(a, b):
        n = len(sets[a]) + len(sets[b])
        apart = sum(bin((p ^ q) % 2 ** 64).count("1") for p, q in zip(sketch[a], sketch[b]))
        return max(abs(len(sets[a]) - len(sets[b])), apart) * (100 + percent) <= n * (100 - percent)

    told = [(a, b) for own in large.values() for a in own for b in own if a < b and near(a, b)]
    got = [(p.a, p.b) for p in jaccard_join._named(buckets, facts, percent).collect()]
    assert set(got) == set(told) and len(got) == len(set(got)) and len(told) > 3 * len(got) > 0
