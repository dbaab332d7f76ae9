import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from isoloir.llm import sharding
from isoloir.llm.queries import op11_sharding
from pyspark.sql import functions as F

from .conftest import ODD_TEXTS, counted, sentence


def written(spark, docs, **options):
    return sharding.read_shards(spark, sharding.write_shards(docs, **options), docs.schema)


def check(rows, texts, shards=16):
    """Every row once, slots without gaps, sizes as they are; the bytes of each shard."""
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts]
    assert counted((r.doc_id, r.size, r.text_crc32) for r in rows) == counted(want)
    slots, sizes = defaultdict(list), [0] * shards
    for r in rows:
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return sizes


def test_place_takes_the_highest_dot_product():
    vectors = np.array([[8.0, 1, 1], [5, 1, 1], [4, 1, 1], [1, 9, 1], [1, 1, 9], [5, 5, 5]])
    got = sharding.place(vectors, 2, (1, 1, 1))
    capacity, left, want = vectors.sum(0) / 2, np.ones((2, 3)), {}
    for k in sorted(range(6), key=lambda k: -(vectors[k] / capacity).sum()):
        products = [(left[s] * vectors[k] / capacity).sum() for s in (0, 1)]
        want[k] = 0 if products[0] >= products[1] else 1
        left[want[k]] -= vectors[k] / capacity
    assert got.tolist() == [want[k] for k in range(6)]
    assert sharding.place(np.zeros((0, 3)), 4).tolist() == []


def test_odd_documents_are_written_and_read(spark, odd, none):
    docs = odd.drop("piece")
    rows = written(spark, docs, range_bytes=2000, shards=4)
    assert rows.columns == [*docs.columns, "slot", "shard"]
    check(sharding.shard_table(rows).collect(), ODD_TEXTS, 4)
    assert rows.select(docs.columns).exceptAll(docs).isEmpty()
    assert written(spark, none.drop("piece")).collect() == []
    with pytest.raises(ValueError, match="slot"):
        sharding.write_shards(odd.withColumnRenamed("piece", "Slot"))


def test_equal_texts_share_a_shard_unless_they_fill_more(spark):
    # A third of all rows and bytes is one text; another is on a tenth of a shard's rows.
    texts = [(k, sentence(1, 40)) for k in range(2000)] + [(k, sentence(k, 40)) for k in range(3000, 7000)]
    texts += [(k, "tiny") for k in range(8000, 8040)] + [(None, None)] * 5
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = sharding.shard_table(written(spark, docs, range_bytes=20_000)).collect()
    sizes = check(rows, texts)
    mean = sum(sizes) / 16
    assert max(sizes) <= 1.01 * mean and min(sizes) >= 0.99 * mean
    counts = np.bincount([r.shard for r in rows], minlength=16)
    assert counts.max() <= 1.1 * counts.mean() and counts.min() >= 0.9 * counts.mean()
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    hot = zlib.crc32(sentence(1, 40).encode())
    assert len(shards[hot]) > 5
    assert all(len(s) == 1 for text, s in shards.items() if text != hot)


def test_rows_are_placed_alike_whatever_the_partitions(spark, odd):
    docs = odd.select("doc_id", "text")
    found = [counted(sharding.shard_table(written(spark, docs.repartition(n))).collect()) for n in (1, 5)]
    assert found[0] == found[1]


def test_registered_query_balances_the_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = op11_sharding(spark, SF_DIR).collect()
    texts = [tuple(r) for r in docs.collect()]
    sizes = check(rows, texts)
    largest = docs.select(F.max(F.octet_length("text"))).first()[0]
    assert max(sizes) - min(sizes) <= largest
