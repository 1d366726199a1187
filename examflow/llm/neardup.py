"""Problem 4: records that share most of their content.

The records' sets of word pairs form a sparse incidence matrix; its product with its own transpose
counts the overlap of every two records. It is never formed in full: each record's pairs of words
are put in one global order, rare first, and for records of a and b entries the overlap that
similarity 0.5 needs, o = ceil((a + b) / 3), bounds which entries can matter: at least K of the
common entries lie in the first a - o + K of one and b - o + K of the other record. The product is
accumulated over those entries only, pairs with fewer than K counts are discarded, and the others
are counted exactly. Entries held by many records are cut into blocks of at most BLOCK records and
multiplied block by block, so no task holds a whole column. Records with equal sets form a class
and only one of them takes part.

The order only has to be the same for all records, so it is taken from counts of all entries in
BUCKETS hash buckets: an array of fixed size whatever the number of records. An entry alone in its
bucket stands in one record only and is not carried further. The sets cross the network once, by
the key of their record, and stay in that partitioning for both sides of the exact count.

Defined results: a record without any word pair is like no other; null options, null entries and
null texts add nothing; repeated deliveries of a record are one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..common import cut_lineage
from .charforms import SUSPICIOUS, plain_form

#: Similarity wanted, as the fraction NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 1, 2
#: Common entries wanted within the bounded prefix.
K = 3
#: Records in one block of one column of the incidence matrix.
BLOCK = 2000
#: Hash buckets of the entry counts that order the entries (4 bytes each on every worker).
BUCKETS = 1 << 22
#: Hot entries (of more than BLOCK records) that are broadcast; more of them are joined instead.
HOT_ROWS = 1_000_000
_SEPARATOR = "\u001e"
_SUSPICIOUS = regex.compile(SUSPICIOUS)


_RUN = regex.compile(r"[\p{L}\p{M}\p{Nd}]+")
_IMAGE = regex.compile(r"\[image\d+\]")
#: Words whose hashes a worker remembers (a memory bound: the memory starts anew beyond it).
HELD_WORDS = 200_000


def _mixed(x, salt: int):
    """64-bit numbers scattered over the whole range (a bijection of x for each salt)."""
    import numpy as np

    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def record_sets(records: DataFrame, key: str = "qf_id", content: str = "content", options: str = "options") -> DataFrame:
    """(key, n, h1, h2, grams): the set of each delivered record, from its content without image tokens and its options.

    ``grams`` are hashes of the pairs of neighbouring words, once each; h1 and h2 are 128 bits of the whole set.
    """
    import numpy as np

    inner = F.transform(F.coalesce(F.col(options), F.array().cast(records.schema[options].dataType)), lambda o: F.coalesce(o["content"], F.lit("")))
    joined = F.array_join(F.concat(F.array(F.coalesce(F.col(content), F.lit(""))), inner), _SEPARATOR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            # One list of word hashes for the batch; 0 stands between texts, so no pair crosses it.
            words: list[int] = []
            ends = np.zeros(batch.num_rows + 1, dtype=np.int64)
            for i, text in enumerate(batch.column(1).to_pylist()):
                if _SUSPICIOUS.search(text):
                    text = plain_form(text)[0]
                for part in _IMAGE.sub(" ", text.lower()).split(_SEPARATOR):
                    for w in _RUN.findall(part):
                        h = held.get(w)
                        if h is None:
                            if len(held) >= HELD_WORDS:
                                held.clear()
                            h = held[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) or 1
                        words.append(h)
                    words.append(0)
                ends[i + 1] = len(words)
            h = np.array(words, dtype=np.uint64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            pair = (h[:-1] != 0) & (h[1:] != 0)
            grams = _mixed(_mixed(h[:-1], 1) + h[1:], 2)[pair].view(np.int64)
            row = row[:-1][pair]
            order = np.lexsort((grams, row))
            grams, row = grams[order], row[order]
            first = np.ones(len(grams), dtype=bool)
            first[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
            grams, row = grams[first], row[first]
            n = np.bincount(row, minlength=batch.num_rows)
            starts = np.concatenate([[0], np.cumsum(n)])
            marks = []
            for salt in (3, 4):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(grams.view(np.uint64), salt), dtype=np.uint64)])
                marks.append(pa.array((sums[starts[1:]] - sums[starts[:-1]]).view(np.int64)))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(grams))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int32)), *marks, lists], names=[key, "n", "h1", "h2", "grams"])

    kind = records.schema[key].dataType.simpleString()
    return records.select(key, joined.alias("joined")).mapInArrow(run, f"`{key}` {kind}, n int, h1 bigint, h2 bigint, grams array<bigint>")


def bucket_counts(sets: DataFrame):
    """Occurrences of all entries by hash bucket, as one array of BUCKETS numbers."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            at, n = np.unique(flat & (BUCKETS - 1), return_counts=True)
            counts[at] += n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])

    summed = sets.select("grams").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, dtype=np.int32)
    got = summed.select("bucket", F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()  # at most BUCKETS rows
    counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return counts


def ordered_sets(sets: DataFrame, key: str) -> DataFrame:
    """(key, n, h1, h2, alone, cold, grams): entries rare first, without those ``alone`` in their bucket.

    The first ``cold`` entries surely stand in at most BLOCK records.
    """
    import numpy as np

    shared = sets.sparkSession.sparkContext.broadcast(bucket_counts(sets))
    names = [key, "n", "h1", "h2", "alone", "cold", "grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            grams = batch.column(4)
            flat = grams.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(grams.offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            f = counts[flat & (BUCKETS - 1)]
            kept = f > 1
            flat, row, f = flat[kept], row[kept], f[kept]
            order = np.lexsort((flat, f, row))
            flat, row, f = flat[order], row[order], f[order]
            left = np.bincount(row, minlength=len(size))
            cold = np.bincount(row[f <= BLOCK], minlength=len(size))
            ends = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array((size - left).astype(np.int32)), pa.array(cold.astype(np.int32)), lists], names=names)

    kind = sets.schema[key].dataType.simpleString()
    rows = sets.select(key, "n", "h1", "h2", "grams").mapInArrow(run, f"`{key}` {kind}, n int, h1 bigint, h2 bigint, alone int, cold int, grams array<bigint>")
    return rows


def similar_classes(sets: DataFrame) -> DataFrame:
    """(a, b, common, n_a, n_b), a < b: classes whose similarity reaches the bound. ``sets``: id, n, alone, cold, grams."""
    # Whatever the partner: it has at least n * t entries, so at least ceil(n * t) are common.
    prefix = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + K - F.col("alone")
    order = sets.select("id", "n", "alone", "cold", F.posexplode(F.slice("grams", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("at", "gram"))
    order = order.select("id", "n", (F.col("alone") + F.col("at")).alias("i"), "gram", (F.col("at") >= F.col("cold")).alias("warm"))
    hot = order.where("warm").groupBy("gram").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") > BLOCK).select("gram", F.ceil(F.col("f") / BLOCK).cast("int").alias("blocks"))
    hot = cut_lineage(hot)
    n_hot = hot.count()
    if n_hot == 0:
        met = _met(order, order, ["gram"]).where("p < q")
    else:
        hot = F.broadcast(hot) if n_hot <= HOT_ROWS else hot
        order = order.join(hot, "gram", "left")
        cold = order.where("blocks is null").drop("blocks")
        order = order.where("blocks is not null").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        spread = order.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        spread = spread.select("gram", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "id", "n", "i", "block")
        blocks = _met(spread.where("block = x"), spread.where("block = y"), ["gram", "x", "y"]).where((F.col("x") < F.col("y")) | (F.col("p") < F.col("q")))
        met = _met(cold, cold, ["gram"]).where("p < q").unionByName(blocks.drop("x", "y"))
    counted = met.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.count(F.lit(1)).alias("seen"), F.max("wanted").alias("wanted"))
    candidates = counted.where("seen >= wanted").select("a", "b")
    grams = lambda s: sets.select(F.col("id").alias(s), F.col("grams").alias(f"g_{s}"), F.col("n").alias(f"n_{s}"))
    exact = candidates.join(grams("b"), "b").join(grams("a"), "a")
    exact = exact.select("a", "b", F.size(F.array_intersect("g_a", "g_b")).alias("common"), "n_a", "n_b")
    return exact.where(F.col("common") * DENOMINATOR >= (F.col("n_a") + F.col("n_b") - F.col("common")) * NUMERATOR)


def _met(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, p, q, wanted): common prefix entries that the sizes and places of both records allow to count."""
    left = left.select(*keys, F.col("id").alias("p"), F.col("n").alias("n_p"), F.col("i").alias("i_p"))
    right = right.select(*keys, F.col("id").alias("q"), F.col("n").alias("n_q"), F.col("i").alias("i_q"))
    need = F.ceil((F.col("n_p") + F.col("n_q")) * NUMERATOR / (NUMERATOR + DENOMINATOR))
    wanted = F.least(F.lit(K), need)
    met = left.join(right, keys).where((F.col("n_p") - F.col("i_p") >= need - wanted + 1) & (F.col("n_q") - F.col("i_q") >= need - wanted + 1))
    return met.select(*keys, "p", "q", wanted.alias("wanted"))


class NearDuplicates:
    """Classes of equal records and links between similar classes of ``records``."""

    def __init__(self, records: DataFrame, key: str = "qf_id", content: str = "content", options: str = "options"):
        self.key = key
        # Read several times below: written once where every executor can read it.
        sets = cut_lineage(record_sets(records, key, content, options))
        marks = sets.select(key, "n", "h1", "h2").dropDuplicates([key])
        # Records with equal sets share the least key; records with empty sets are in no class.
        least = marks.where("n > 0").groupBy("h1", "h2").agg(F.min(key).alias("class_id"))
        self.members = cut_lineage(marks.join(least, ["h1", "h2"], "left").select(key, F.when(F.col("n") > 0, F.col("class_id")).alias("class_id")))
        chosen = self.members.where(F.col(key) == F.col("class_id")).select(key)
        # Only sets of classes are ordered; they cross the network here, and stay where they are for both sides of the count.
        n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        kept = ordered_sets(sets, key).repartition(n, key).join(chosen.repartition(n, key), key, "left_semi").dropDuplicates([key])
        self.sets = cut_lineage(kept.select(F.col(key).alias("id"), "n", "alone", "cold", "grams"))
        self.all_keys = self.members.select(key)
        self.members = self.members.where("class_id is not null")

    def links(self) -> DataFrame:
        """(a, b, common, n_a, n_b) between classes."""
        return similar_classes(self.sets)

    def pairs(self) -> DataFrame:
        """(key_a, key_b), key_a < key_b: every two records of the required similarity.

        Every pair at every size of a class: members are cut into blocks of about BLOCK records and
        joined block by block, so no task pairs a whole class. Where copies are many, ``groups`` says
        the same in one row for each record.
        """
        sizes = self.members.groupBy("class_id").agg(F.count(F.lit(1)).alias("size"))
        large = sizes.where(F.col("size") > BLOCK).select("class_id", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        alike = sizes.where("size > 1")
        between = self.links().select("a", "b").unionByName(alike.select(F.col("class_id").alias("a"), F.col("class_id").alias("b")))
        for c, x in (("a", "x"), ("b", "y")):
            n = F.coalesce("blocks", F.lit(1))
            between = between.join(large.withColumnRenamed("class_id", c), c, "left").withColumn(x, F.explode(F.sequence(F.lit(0), n - 1))).drop("blocks")
        between = between.where((F.col("a") != F.col("b")) | (F.col("x") <= F.col("y")))
        block = F.pmod(F.xxhash64(self.key), F.coalesce("blocks", F.lit(1))).cast("int")
        members = self.members.join(large, "class_id", "left").select("class_id", self.key, block.alias("block"))
        of = lambda c, x, k: members.select(F.col("class_id").alias(c), F.col("block").alias(x), F.col(self.key).alias(k))
        rows = between.join(of("a", "x", "p"), ["a", "x"]).join(of("b", "y", "q"), ["b", "y"])
        rows = rows.where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")) | (F.col("p") < F.col("q"))).select("p", "q")
        return rows.select(F.least("p", "q").alias(f"{self.key}_a"), F.greatest("p", "q").alias(f"{self.key}_b"))

    def groups(self) -> DataFrame:
        """(key, class_id, group_id, n_links): one row for each record; the group is what links connect."""
        links = cut_lineage(self.links().select("a", "b"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        labels = connected_labels(both)
        counts = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_links"))
        out = self.all_keys.join(self.members, self.key, "left").withColumn("class_id", F.coalesce("class_id", self.key))
        out = out.join(labels.withColumnRenamed("id", "class_id"), "class_id", "left").join(counts.withColumnRenamed("a", "class_id"), "class_id", "left")
        return out.select(self.key, "class_id", F.coalesce("label", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def connected_labels(edges: DataFrame) -> DataFrame:
    """(id, label): the least id each node is connected with. ``edges`` holds both directions (a, b).

    Each round takes the least label of the neighbours and then follows it once more, so labels
    travel at least twice as far each round. Only a count of changes comes to the driver.
    """
    labels = cut_lineage(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        jump = labels.select(F.col("id").alias("new"), F.col("label").alias("far"))
        step = cut_lineage(step.join(jump, "new", "left").select("id", "old", F.least("new", "far").alias("label")))
        changed = step.where("old <> label").limit(1).count()
        labels = step.select("id", "label")
        if not changed:
            return labels
