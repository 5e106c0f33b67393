"""Growing a stored slot map: rows move into the new shard only."""

import pytest

from telemetra.llm import sharding


def test_rebalance(spark, tmp_path):
    folder = f"file:{tmp_path}/maps"
    docs = spark.createDataFrame([(i, "x" * (i % 40)) for i in range(900)], "doc_id long, text string")

    def placed(**options):
        return {r.doc_id: r for r in sharding.assign_shards(docs, 3, map_folder=folder, **options).collect()}

    with pytest.raises(ValueError):
        sharding.rebalance(docs, 3, folder)
    before = placed()
    assert sharding.rebalance(docs, 3, folder) == 2
    after = placed(version=2)
    assert after == placed() and before == placed(version=1)
    moved = {i for i in before if after[i].shard != before[i].shard}
    assert moved and {after[i].shard for i in moved} == {3}
    load = [sum(r.size for r in after.values() if r.shard == s) for s in range(4)]
    assert max(load) < 1.2 * min(load)
    for s in range(4):
        own = sorted(r.slot for r in after.values() if r.shard == s)
        assert own == list(range(len(own)))
    assert sharding.rebalance(docs, 4, folder) == 3 and {r.shard for r in placed().values()} == set(range(5))
    more = docs.unionByName(spark.range(5000, 5300).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text"))
    grown = {r.doc_id: r.shard for r in sharding.assign_shards(more, 3, map_folder=folder, version=2).collect()}
    assert len(grown) == 1200 and all(grown[i] == after[i].shard for i in after)
