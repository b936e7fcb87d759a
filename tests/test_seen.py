"""The store of seen keys: exact, and read in proportion to the keys asked for."""

import os
import random


from hirelens.operators.dedupe import unseen
from hirelens.sources.seen import SeenStore


def _keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def test_store_is_exact_and_reads_few_buckets(spark, tmp_dir):
    rnd, root, held = random.Random(2), os.path.join(tmp_dir, "seen"), set()
    make = lambda: SeenStore(spark, root, buckets=64, bits=2**16)
    assert make().keys().count() == 0 and make().touched(_keys(spark, ["a"])) == []
    for n in range(3):
        names = [f"https://x/{rnd.randint(0, 900)}" for _ in range(150)]
        make().add(_keys(spark, [*names, names[0], f"  {names[1]} ", "", " ", None]))
        held |= set(names)
    store = make()
    assert {r.url for r in store.keys().collect()} == held and store.keys().count() == len(held)
    some = sorted(held)[:3]
    touched = store.touched(_keys(spark, some))
    assert 1 <= len(touched) <= 3
    assert len(store.touched(_keys(spark, [f"new {k}" for k in range(40)]))) <= 5          # bits that happen to be set
    asked = [*some, *some, *[f"https://x/{k}" for k in range(2000, 2010)], None, " "]
    got = unseen(_keys(spark, asked), store.relevant(_keys(spark, asked)), "url", ["url"])
    assert sorted(r.url for r in got.collect()) == [f"https://x/{k}" for k in range(2000, 2010)]
    scan = store.relevant(_keys(spark, some)).inputFiles()
    assert {f.split("bucket=")[1].split("/")[0] for f in scan} == {str(b) for b in touched}


def test_compaction_keeps_keys(spark, tmp_dir):
    root = os.path.join(tmp_dir, "seen")
    store = SeenStore(spark, root, buckets=8, bits=2**16)
    for n in range(3):
        store.add(_keys(spark, [f"k{k}" for k in range(n * 20, n * 20 + 30)]))
    store.keys([0]).count()
    store.compact(buckets=16, bits=2**17)
    again = SeenStore(spark, root, buckets=8)
    assert (again.buckets, again.bits, again.version) == (16, 2**17, 1)
    assert sorted(r.url for r in again.keys().collect()) == sorted(f"k{k}" for k in range(70))
    for b in range(16):
        assert len(again.keys([b]).inputFiles()) <= 1
    again.add(_keys(spark, ["k1", "z"]))
    again.compact()
    assert SeenStore(spark, root).keys().count() == 71 and len(os.listdir(root)) == 2
    assert SeenStore(spark, root).touched(_keys(spark, ["z"])) != []


def test_unfinished_append_is_done_again(spark, tmp_dir):
    root = os.path.join(tmp_dir, "seen")
    store = SeenStore(spark, root, buckets=4, bits=2**16)
    store.add(_keys(spark, ["a"]))
    store._placed(_keys(spark, ["b"])).drop("_bit").write.mode("append").partitionBy("bucket").parquet(f"{store.path}/keys")      # and no bitmap
    assert SeenStore(spark, root).touched(_keys(spark, ["b"])) == []
    SeenStore(spark, root).add(_keys(spark, ["b"]))
    store = SeenStore(spark, root)
    assert store.touched(_keys(spark, ["b"])) != [] and {r.url for r in store.keys().collect()} == {"a", "b"}
