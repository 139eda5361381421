"""Virtual slots, maps and written shards."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import sharding
from strata.llm.sharding import dealt, grown, load_map, rebalanced

DOCS = "doc_id long, text string, first long, rows string"


def loads(m, sizes):
    return np.bincount(m.shard_of, sizes, minlength=m.shards)


@pytest.mark.parametrize("seed", range(4))
def test_rebalanced_is_even_and_moves_little(seed):
    r = np.random.default_rng(seed)
    sizes = np.floor(r.lognormal(8, 1.5, 4096)).astype(np.int64)
    old = dealt(4096, 8)
    new = rebalanced(old, sizes)
    after = loads(new, sizes)
    assert new.version == 2 and after.sum() == sizes.sum()
    assert after.max() - after.min() <= sharding.EVEN * after.mean()
    assert (new.shard_of != old.shard_of).mean() < 0.2
    assert np.array_equal(rebalanced(new, sizes).shard_of, new.shard_of)


def test_maps_at_the_edges():
    none = np.zeros(100, np.int64)
    assert np.array_equal(rebalanced(dealt(100, 8), none).shard_of, dealt(100, 8).shard_of)
    one = none.copy()
    one[5] = 10 ** 12                                   # one slot holds everything: nothing to gain
    assert loads(rebalanced(dealt(100, 8), one), one).max() == 10 ** 12
    few = none.copy()
    few[[0, 8, 16]] = (5, 4, 3)                         # all on one shard at first
    assert sorted(loads(rebalanced(dealt(100, 8), few), few))[-3:] == [3, 4, 5]
    assert np.array_equal(grown(dealt(100, 8), none).shard_of, dealt(100, 8).shard_of)


def test_one_more_shard_takes_slots_only_into_itself():
    sizes = np.floor(np.random.default_rng(1).lognormal(8, 1, 4096)).astype(np.int64)
    old = rebalanced(dealt(4096, 8), sizes)
    new = grown(old, sizes)
    assert set(new.shard_of[new.shard_of != old.shard_of]) == {8}
    assert abs(loads(new, sizes) / loads(new, sizes).mean() - 1).max() < 0.05


def test_written_shards_hold_every_row_once(spark):
    r = random.Random(2)
    rows = [(i, "é" * r.randint(0, 3000), i, "x") for i in range(400)]
    rows += [(7, "hot key " * 40, k, "x") for k in range(500)]          # one id on most rows
    rows += [(None, "text %d" % (k % 3), k, "y") for k in range(40)] + [(500, None, 1, None), (501, "", 2, None), rows[0]]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    root = sharding.write_shards(spark, docs, shards=4, slots=64)
    back = sharding.read_shards(spark, root, docs)
    assert back.columns == [*docs.columns, "virtual_slot", "size", "shard", "number"]
    got = back.collect()
    assert Counter((x.doc_id, x.text, x.first, x.rows) for x in got) == Counter(rows)
    places, slots = defaultdict(list), defaultdict(set)
    for x in got:
        places[x.shard].append(x.number)
        slots[x.virtual_slot].add(x.shard)
        assert x["size"] == len((x.text or "").encode()) + 1
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert all(len(v) == 1 for v in slots.values())
    assert len({x.virtual_slot for x in got if x.doc_id == 7}) == 1
    m = load_map(spark, root)
    assert m.version == 2 and load_map(spark, root, 1).version == 1
    assert all(m.shard_of[x.virtual_slot] == x.shard for x in got)
    assert spark.read.parquet(f"{root}/index").groupBy("virtual_slot").count().agg({"count": "max"}).first()[0] > 1


def test_empty_table_and_taken_names(spark):
    none = spark.createDataFrame([], DOCS)
    assert sharding.read_shards(spark, sharding.write_shards(spark, none, slots=16), none).collect() == []
    with pytest.raises(ValueError):
        sharding.write_shards(spark, none.withColumnRenamed("rows", "part"))


def test_query_on_whole_table(spark):
    import __spark_entry__
    d = "/root/testdata/sf0.001"
    got = __spark_entry__.queries()["op12_sharding"](spark, d).collect()
    docs = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert sorted(x.doc_id for x in got) == sorted(docs)
    sizes, places = Counter(), defaultdict(list)
    for x in got:
        raw = docs[x.doc_id].encode()
        assert (x["size"], x.text_crc32, x.law, x.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[x.shard] += x["size"]
        places[x.shard].append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in places.values()) and set(places) <= set(range(8))
    mean, most = sum(sizes.values()) / 8, max(len(t.encode()) + 1 for t in docs.values())
    assert max(sizes.values()) <= max(1.01 * mean, most)
