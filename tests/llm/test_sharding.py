"""Shards by stratified interleaving: whole, equal, of one mixture, and readable in order."""

import collections
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from qualia.llm import queries, sharding  # noqa: E402


def rows_of(spark, sizes):
    rows = [(None if s == "none" else s, i, f"{s} {i}") for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "source string, doc_id long, text string")


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_every_shard_has_the_mixture(spark, shards):
    sizes = {"hot": 900, "b": 333, "none": 50, "": 17} | {f"one{i}": 1 for i in range(200)}
    got = sharding.interleave(rows_of(spark, sizes), ["doc_id", "text"], shards=shards).collect()
    total = sum(sizes.values())
    assert len(got) == total and len({(r.source, r.doc_id) for r in got}) == total
    for k in range(shards):
        own = [r for r in got if r.shard == k]
        assert total // shards <= len(own) <= -(-total // shards)
        assert sorted(r.slot for r in own) == list(range(len(own)))
        count = collections.Counter("none" if r.source is None else r.source for r in own)
        for s in ("hot", "b", "none", ""):
            assert abs(count[s] - sizes[s] / shards) <= 4
        assert abs(sum(v for s, v in count.items() if s.startswith("one")) - 200 / shards) <= 5  # sources of one row do not crowd
    again = sharding.interleave(rows_of(spark, sizes).repartition(3), ["doc_id", "text"], shards=shards).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_repeats_clashing_names_and_empty_tables(spark):
    rows = [(1, "a", None, 5)] * 6 + [(None, None, "x", 6)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _part int").withColumn("_rank", F.lit("k")).withColumn("_key_0", F.lit(1))
    got = sharding.interleave(df, ["doc_id", "text"], shards=4)
    assert got.columns == [*df.columns, "shard", "slot"]
    assert sorted(collections.Counter(r.shard for r in got.collect()).values()) == [2, 2, 2, 3]
    assert sharding.interleave(df.limit(0), ["doc_id"]).count() == 0
    few = sharding.interleave(df.limit(3), ["doc_id"], shards=16).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}
    assert sharding.interleave(df.withColumn("slot", F.lit(7)), ["doc_id"], shards=9).agg(F.max("slot")).first()[0] == 0


def test_written_shards_read_back_in_order(spark, tmp_path):
    df = sharding.interleave(rows_of(spark, {"a": 120, "b": 30}), ["doc_id"], shards=5)
    path = f"file://{tmp_path}/out"
    sharding.write_shards(df, path)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id()).collect()
    assert sorted((r.shard, r.slot, r.source, r.doc_id) for r in back) == sorted((r.shard, r.slot, r.source, r.doc_id) for r in df.collect())
    for k in range(5):
        assert [r.slot for r in sorted((r for r in back if r.shard == k), key=lambda r: (r.file, r.at))] == list(range(30))


def test_query_covers_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.read(spark, sf, "documents")
    got = queries.op12_interleave_shards(spark, sf)
    want = docs.selectExpr("doc_id", "cast(octet_length(text) + 1 as long) size", "crc32(text) text_crc32")
    assert got.select("doc_id", "size", "text_crc32").exceptAll(want).count() == 0 and got.count() == docs.count()
