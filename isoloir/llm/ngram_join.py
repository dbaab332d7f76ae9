"""Self-join of documents by the Jaccard similarity of their shingles, into classes.

A set's shingles are ordered by how many sets have them, the rarest first. Two sets with enough
in common share something early in that order, and the signatures of a set are made so that
they then share one:

* a rare shingle (in fewer than ``frequent`` sets) is a signature by itself;
* frequent shingles are dealt to groups by their hash, and every pair of a group is one.

Per set of ``n`` shingles at most ``e = n - ceil(0.75 n)`` may be missing from a similar one.
The prefix is extended until it has ``e + 1`` shingles, where the first frequent one of each
group does not count: if no signature is shared, each counted shingle stands for one that
the other set lacks, and those would be more than ``e``. There are an eighth as many groups as
shingles, by powers of two of the set's size, so a set has about as many pairs as shingles; as
similar sets may be of two such powers, a set has signatures for both.

Equal sets are one node from the start. Nodes that share a signature are compared in three
rounds: each with the node it shares most signatures with of those that lead a list; then
the nodes of a list that are still in other classes with the list's leader; then every pair
of a list that is still in different classes. Only pairs are compared whose sizes, and the
numbers of shingles they can have in common at all, allow a link. After the last round no
link is missing. A list is led by the set that has least to itself, as the origin of a group
of near copies has, so that the first two rounds leave next to nothing for the last.

Shingles are told apart by hashes of 64 bits; which ones are rare is counted over all
documents on shorter hashes, since the order of shingles decides only how much work there is.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloir.llm.blocks import (
    BUCKET_GRAMS,
    REQUESTS,
    answers,
    block_count,
    block_of,
    mix,
    requests,
    sums_of,
)
from isoloir.llm.common import free_name, give_back, small_batches, stored, string_bytes, text_of
from isoloir.llm.components import components
from isoloir.llm.shingling import shingle_sets_of, shingles

#: A word's first byte: what is no ASCII white space.
WORD = r"[^\x20\x09-\x0D]"
#: Two sets link when their intersection is this percentage of their union, or more.
PERCENT = 75
#: Shingles of so many sets or more are frequent.
FREQUENT = 64
#: Of so many shingles one group of frequent ones is made.
GROUP_OF = 8

SETS = "doc_id {key}, n_shingles long, node long, text_bytes long, text_hash long"
SIGNED = (
    "node long, size int, shared int, often int, text binary,"
    " singles array<long>, pairs array<long>"
)


def node_of(found: np.ndarray) -> int | None:
    """The same number for equal sets; null for the empty one."""
    if not len(found):
        return None
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def allowed_missing(size: int) -> int:
    """Shingles that a similar set may lack."""
    return size + (-size * PERCENT // 100)


def _level(size: int) -> int:
    return int(size).bit_length()


def levels(size: int) -> set[int]:
    """The powers of two that the sizes of similar sets are in."""
    smallest, largest = -(-size * PERCENT // 100), size * 100 // PERCENT
    return {_level(smallest), _level(size), _level(largest)}


def signatures(
    found: np.ndarray, sets_with: np.ndarray, frequent: int = FREQUENT
) -> tuple[np.ndarray, np.ndarray]:
    """A set's signatures, of rare shingles and of pairs, from how many sets have each shingle."""
    size, none = len(found), np.zeros(0, np.int64)
    wanted = allowed_missing(size) + 1
    # Only an equal set is similar to a single shingle; a set with so many of its own, to none.
    if size < 2 or (sets_with == 1).sum() >= wanted:
        return none, none
    order = np.lexsort((found, sets_with))
    found, sets_with = found[order], sets_with[order]
    rare = int(np.searchsorted(sets_with, frequent, "left"))
    single = found[: min(rare, wanted)]
    # What no other set has is no use as a signature, but it is part of the prefix.
    single = single[sets_with[: len(single)] > 1]
    pairs = [_pairs(found[rare:], wanted - rare, level) for level in levels(size) if rare < wanted]
    return single.view(np.int64), np.unique(np.concatenate(pairs)).view(np.int64) if pairs else none


def _pairs(frequent: np.ndarray, wanted: int, level: int) -> np.ndarray:
    """Pairs within groups of as many frequent shingles as the prefix needs."""
    groups = max(1, (1 << (level - 1)) // GROUP_OF)
    group = mix(frequent + np.uint64(level)) % np.uint64(groups)
    counts = np.ones(len(group), np.int64)
    counts[np.unique(group, return_index=True)[1]] = 0
    end = int(np.searchsorted(np.cumsum(counts), wanted, "left")) + 1
    prefix, group = frequent[:end], group[:end]
    order = np.lexsort((prefix, group))
    prefix, group = prefix[order], group[order]
    out, apart = [], 1
    # Members of a group stand together: all pairs one place apart, then two ...
    while (same := np.flatnonzero(group[apart:] == group[:-apart])).size:
        left, right = prefix[same], prefix[same + apart]
        out.append(mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(level)))
        apart += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _text_hash(text: str) -> Column:
    """With the id, tells rows apart whose texts differ."""
    return F.xxhash64(F.col(text).cast("string")).alias("text_hash")


def shingle_sets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node``, ``text_bytes`` and ``text_hash`` of every row."""
    small_batches(docs.sparkSession)
    key = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = string_bytes(batch.column(1))
            found = [(len(f), node_of(f)) for f in shingle_sets_of(data, ends)]
            counted = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            columns = [batch.column(0), *counted, pa.array(np.diff(ends)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    names = ["doc_id", "n_shingles", "node", "text_bytes", "text_hash"]
    picked = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), _text_hash(text)
    )
    return picked.mapInArrow(run, SETS.format(key=key))


def signed_nodes(
    docs: DataFrame, sets: DataFrame, doc_id: str, text: str, frequent: int = FREQUENT
) -> DataFrame:
    """Size, text and signatures of every node that may be linked, from one of its documents."""
    key = F.xxhash64("doc_id", "text_hash")
    nodes = sets.where("node is not null and n_shingles > 1")
    nodes = nodes.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("of"), F.max("text_bytes").alias("bytes")
    )
    nodes = stored(nodes.select("node", "of.*", "bytes"), "nodes")
    text_bytes = nodes.agg(F.sum("bytes")).first()[0] or 0
    # All documents are dealt out, copies too, so they all count for the number of blocks.
    blocks = block_count(sets.agg(F.sum("text_bytes")).first()[0] or 0)
    buckets = max(1, text_bytes // 6 // BUCKET_GRAMS)
    # Short hashes, as long as chance makes few of them equal.
    bits = min(64, (text_bytes // 6 + 1).bit_length() + 12)
    picked = docs.select(F.col(doc_id).alias("doc_id"), _text_hash(text), text_of(text).alias("text"))
    dealt = picked.select(key.alias("key"), "text").withColumn("block", block_of(F.col("key"), blocks))
    wanted = nodes.select(key.alias("key"), "node").withColumn("block", block_of(F.col("key"), blocks))
    cut = np.uint64(64 - bits)

    def sets_of(texts: pa.Table, ids: pa.Table) -> Iterator[tuple[int, bytes, np.ndarray]]:
        # A row that repeats id and text is here again, and nodes may share an id.
        left = set(zip(ids["key"].to_pylist(), ids["node"].to_pylist(), strict=True))
        keys = texts["key"].to_numpy()
        at = np.flatnonzero(np.isin(keys, ids["key"].to_numpy()))
        at = at[np.sort(np.unique(keys[at], return_index=True)[1])]
        data, ends = string_bytes(texts["text"].take(pa.array(at)).combine_chunks())
        for k, (number, found) in enumerate(zip(keys[at].tolist(), shingle_sets_of(data, ends), strict=True)):
            node = node_of(found)
            if (number, node) in left:
                yield node, data[ends[k] : ends[k + 1]].tobytes(), found

    def state(group: tuple, texts: pa.Table, ids: pa.Table) -> pa.Table:
        found = [f for _, _, f in sets_of(texts, ids)]
        every = np.concatenate(found) >> cut if found else np.zeros(0, np.uint64)
        hashes, counts = np.unique(every, return_counts=True)
        asked = requests(group[0].as_py(), hashes, counts.astype(np.uint64), bits, buckets)
        del found, every, hashes, counts
        give_back()
        return pa.Table.from_pandas(asked, asked_schema, preserve_index=False)

    def sign(group: tuple, texts: pa.Table, right: pa.Table) -> pa.Table:
        is_id = pa.compute.less(right["bucket"], 0)
        own = list(sets_of(texts, right.filter(is_id)))
        out: list[tuple] = []
        if own:
            hashes = np.unique(np.concatenate([f for _, _, f in own]) >> cut)
            sums = sums_of(right.filter(pa.compute.invert(is_id)).to_pandas())
            pack = zstandard.ZstdCompressor(3)
            for node, said, found in own:
                sets_with = sums[np.searchsorted(hashes, found >> cut)]
                single, pairs = signatures(found, sets_with, frequent)
                if len(single) or len(pairs):
                    common = [int((sets_with >= n).sum()) for n in (2, frequent)]
                    out.append((node, len(found), *common, pack.compress(said), single, pairs))
        columns = zip(*out, strict=True) if out else [[] for _ in signed_schema]
        signed = pa.table([pa.array(c, f.type) for c, f in zip(columns, signed_schema, strict=True)], signed_schema)
        del own, out, columns
        give_back()
        return signed

    asked_schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
    lists = pa.list_(pa.int64())
    kinds = (pa.int64(), *[pa.int32()] * 3, pa.binary(), lists, lists)
    signed_schema = pa.schema(list(zip([f.split()[0] for f in SIGNED.split(", ")], kinds, strict=True)))
    by_block = dealt.groupBy("block")
    asked = by_block.cogroup(wanted.groupBy("block")).applyInArrow(state, REQUESTS)
    told = answers(asked)
    zero = F.lit(0).cast("long")
    ids = wanted.select("block", (zero - 1).alias("bucket"), F.lit(b"").alias("sums"), "key", "node")
    right = ids.unionByName(told.withColumns({"key": zero, "node": zero}))
    return by_block.cogroup(right.groupBy("block")).applyInArrow(sign, SIGNED)


def similar(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets link, computed from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()
        unpack = zstandard.ZstdDecompressor()

        def set_of(node: int, text: pa.Scalar) -> np.ndarray:
            if node not in known:
                known[node] = shingles(unpack.decompress(text.as_py()))
                if len(known) > 64:
                    known.popitem(last=False)
            return known[node]

        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
            keep = []
            for k, (x, y) in enumerate(zip(a, b, strict=True)):
                left = set_of(x, batch.column("text_a")[k])
                right = set_of(y, batch.column("text_b")[k])
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= PERCENT * (len(left) + len(right) - both):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[k] for k in keep], pa.int64()) for v in (a, b)], ["a", "b"]
            )

    left = nodes.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(run, "a long, b long")


def _fits(a: str, b: str) -> Column:
    """Whether the sizes of two sets and what they can have in common allow a link."""
    both = F.least(f"{a}common", f"{b}common")
    return both * 100 >= (F.col(f"{a}size") + F.col(f"{b}size") - both) * PERCENT


def listed_nodes(nodes: DataFrame) -> DataFrame:
    """A row for each signature of each node.

    ``common`` is the most shingles that the set can have in common with another of the same
    list, beside those that other lists give. In the list of a rare shingle those are all that
    more sets than one have. A set with signatures of pairs has all its rare shingles as
    signatures: if it shares one of them, that list has both sets; if it shares none, they
    have frequent shingles in common at most.
    """

    def each(name: str, common: str) -> Column:
        return F.transform(name, lambda s: F.struct(s.alias("signature"), F.col(common).alias("common")))

    both = F.concat(each("singles", "shared"), each("pairs", "often"))
    listed = nodes.select("node", "size", F.explode(both).alias("in"))
    # What a set has to itself, relative to its size: the first of a list lacks least.
    lack = ((F.col("size") - F.col("in.common")) / F.col("size")).alias("lack")
    return listed.select("node", "size", "in.*", lack)


def classes(nodes: DataFrame) -> DataFrame:
    """``node`` and ``comp`` of every node that is linked to another."""
    listed = listed_nodes(nodes)
    lead = F.min(F.struct("lack", "node", "size", "common")).alias("lead")
    lists = listed.groupBy("signature").agg(F.count("*").alias("n"), lead).where("n > 1").drop("n")
    # Lists of one are no use; those that remain are read three times. Their leaders are stored,
    # so that Spark can split a list that very many nodes are in.
    listed = stored(listed.join(stored(lists, "leaders"), "signature"), "lists")

    # 1. Each node with the leader that it shares most signatures with.
    led = listed.where(F.col("node") != F.col("lead.node")).where(_fits("", "lead."))
    shared = led.groupBy("node", "lead.node", "lead.lack").agg(F.count("*").alias("n"))
    shared = shared.toDF("node", "lead", "lack", "n")
    best = F.max_by("lead", F.struct("n", -F.col("lack"), -F.col("lead"))).alias("lead")
    first = stored(_ordered(shared.groupBy("node").agg(best), "lead", "node"), "pairs")
    links = stored(similar(first, nodes), "similar")
    found = components(links)

    # 2. Nodes that are in another class than their list's leader, with it.
    labelled = stored(_labelled(listed, found), "labelled")
    apart = labelled.where(F.col("comp") != F.col("lead_comp")).where(_fits("", "lead."))
    second = _ordered(apart, "lead.node", "node").join(first, ["a", "b"], "left_anti")
    second = stored(second, "pairs")
    links = stored(links.unionByName(similar(second, nodes)), "similar")
    found = components(links)

    # 3. Every pair of a list that is still apart.
    labelled = stored(_labelled(listed, found).drop("lead", "lead_comp", "lack"), "labelled")
    comps = labelled.groupBy("signature").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
    mixed = stored(comps.where("least <> most").select("signature"), "mixed")
    mixed = labelled.join(mixed, "signature", "left_semi")
    other = mixed.select("signature", *(F.col(c).alias(f"b_{c}") for c in ("node", "size", "common", "comp")))
    pairs = mixed.join(other, "signature").where("comp < b_comp").where(_fits("", "b_"))
    third = _ordered(pairs, "node", "b_node")
    third = third.join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti")
    last = stored(similar(stored(third, "pairs"), nodes), "similar")
    if last.isEmpty():
        return found
    return components(links.unionByName(last))


def _ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _labelled(listed: DataFrame, found: DataFrame) -> DataFrame:
    """``listed`` with the classes of a row's node and of its leader."""
    of_lead = found.select(F.col("node").alias("lead_node"), F.col("comp").alias("lead_comp"))
    own = listed.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    own = own.withColumn("lead_node", F.col("lead.node")).join(of_lead, "lead_node", "left")
    return own.withColumn("lead_comp", F.coalesce("lead_comp", "lead_node")).drop("lead_node")


def _sets_and_classes(
    docs: DataFrame, doc_id: str, text: str, frequent: int = FREQUENT
) -> tuple[DataFrame, DataFrame]:
    sets = stored(shingle_sets(docs, doc_id, text), "sets")
    nodes = stored(signed_nodes(docs, sets, doc_id, text, frequent), "signed")
    return sets, classes(nodes)


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    ``component_id`` is the smallest id that is reachable by links, the row's own included. A
    document without words, or a null text, has no shingles and is linked with nothing. Rows
    that repeat an id are documents each; a null id is reachable but never the smallest of
    others. Other columns are ignored; an empty table gives an empty result.
    """
    sets, found = _sets_and_classes(docs, doc_id, text, frequent)
    smallest = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    smallest = smallest.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # Nodes, not documents: a group of copies is one row here. Both sides of each join are
    # stored, so that Spark can split a class of very many nodes and a node of very many copies.
    smallest = stored(smallest, "smallest")
    of_class = stored(smallest.groupBy("comp").agg(F.min("least").alias("component_id")), "least")
    of_node = stored(smallest.join(of_class, "comp").select("node", "component_id"), "found")
    joined = sets.join(of_node, "node", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the smallest id; columns unchanged.

    A null id comes after all others; of rows that tie, any one stays. Rows that repeat an id
    are documents each. Rows without shingles are in no class and all stay.
    """
    sets, found = _sets_and_classes(docs, doc_id, text, FREQUENT)
    rows = sets.where("node is not null").groupBy("node", "doc_id", "text_hash")
    rows = rows.agg(F.count("*").alias("copies"))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "copies")
    of_node = rows.groupBy("node").agg(F.min(key).alias("first"))
    of_node = of_node.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    kept = of_node.groupBy("comp").agg(F.min("first").alias("first"))
    kept = stored(kept.select("first.*"), "kept")

    said, own, kept_id, kept_hash, copies, place = (
        free_name(docs, c) for c in ("has_words", "text_hash", "kept_id", "kept_hash", "copies", "place")
    )
    some = F.coalesce(F.col(text).cast("string").rlike(WORD), F.lit(False))
    tagged = docs.withColumn(said, some).withColumn(own, _text_hash(text))
    kept = kept.select(
        F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash), F.col("copies").alias(copies)
    )
    same = F.col(doc_id).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_hash))
    firsts = tagged.where(F.col(said)).join(kept, same)
    # Of rows whose id and text repeat, too, one stays.
    first = Window.partitionBy(doc_id, own).orderBy(F.lit(0))
    tied = firsts.where(F.col(copies) > 1).withColumn(place, F.row_number().over(first))
    parts = [tagged.where(~F.col(said)), firsts.where(F.col(copies) == 1), tied.where(F.col(place) == 1)]
    none, once, one = (p.select(*docs.columns) for p in parts)
    return none.unionByName(once).unionByName(one)
