"""Near-duplicates by min-max hashing.

Each of ``permutations`` hash functions gives two values of a signature, the smallest and the largest hash of a
document's shingles, so half the hash evaluations give as many values, each of which two documents share with the probability of
their similarity. Four values make a band. With 80 functions there are 40 bands; two documents of similarity 0.75 share none of
them with a probability of (1 - 0.75^4)^40 < 3e-7. Documents of one band bucket are candidates; every link is confirmed on
the full sets.

Hot groups: documents with equal sets are one class from the start. Within a bucket the members are compared with one pivot
instead of each other, the one that meets most others over all buckets, as does the text that near copies were made from; what
the pivots join needs no further comparison. Only buckets whose members are still in several
components go on, and only with members that have enough shingles which occur in another component. Of these, members outside the bucket's largest component are pivots, ``PIVOTS`` of them in a round, and leave the bucket when
they have been compared with its other components. Before a pair is confirmed, the shingles that each end has in common with
any other component are counted in ``PARTS`` parts of the hash range: two sets have no more in common than the smaller counts of all
parts together, so near copies that were changed in different places are not confirmed. In the end its members are in one component. So a pair that shares a bucket
is compared, or its ends are already connected, and a round compares at most ``PIVOTS`` times as many pairs as there are members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import blocks as B
from tidemark.llm.components import components, removed, stored

SHINGLE_WORDS = 5
PERMUTATIONS = 80
BAND_VALUES = 4
#: Similarity of linked documents, in hundredths.
THRESHOLD = 75
#: Pivots of a bucket in the rounds after the first.
PIVOTS = 256
#: Parts of the hash range in which shared shingles are counted.
PARTS = 64

_SIGNED = "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>"


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, one without words has none."""
    h = B.word_hashes(text.lower().split())
    return np.unique(B.ngram_hashes(h, min(words, len(h)))) if len(h) else np.empty(0, np.uint64)


def min_max(found: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """``2 * permutations`` values: smallest and largest hash under each function, alternating."""
    seeds = B.mixed(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    factor, shift = seeds[:permutations, None] | np.uint64(1), seeds[permutations:, None]
    low, high = np.full(permutations, np.iinfo(np.uint64).max), np.zeros(permutations, np.uint64)
    for start in range(0, len(found), 4096):
        values = found[None, start : start + 4096] * factor + shift
        low, high = np.minimum(low, values.min(axis=1)), np.maximum(high, values.max(axis=1))
    return np.stack((low, high), axis=1).ravel()


def band_keys(signature: np.ndarray, values: int = BAND_VALUES) -> np.ndarray:
    rows = signature[: len(signature) // values * values].reshape(-1, values)
    keys = np.arange(len(rows), dtype=np.uint64)
    for k in range(values):
        keys = B.mixed(keys * np.uint64(31) + rows[:, k])
    return keys.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, classes, bands = [], [], []
        for text in B.texts_of(pa.Table.from_batches([batch])):
            found = shingles(text)
            sizes.append(len(found))
            classes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            bands.append(band_keys(min_max(found)) if len(found) else None)
        columns = [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "class", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(text).view(np.int64) for text in B.texts_of(pa.Table.from_batches([batch]))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "found"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of ``u``, ``v`` those that are similar enough on their full sets."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("found").alias("of_u"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("found").alias("of_v"))
    common = F.size(F.array_intersect("of_u", "of_v"))
    return pairs.join(left, "u").join(right, "v").where(100 * common >= THRESHOLD * (F.size("of_u") + F.size("of_v") - common)).select("u", "v")


def _pairs(left, right) -> list:
    return [F.least(left, right).alias("u"), F.greatest(left, right).alias("v")]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: ``n_shingles`` (size of its set), ``component_id`` (smallest ``doc_id`` reachable over links) and ``kept``.

    Texts are lower-cased (A-Z) and cut at ASCII white space. Documents are linked if 100 * common shingles >= 75 * shingles of either.
    Null, empty and blank texts have an empty set and are linked with nothing; neither is a row with a null ``doc_id``, whose
    ``component_id`` is null and which is kept. Rows with an equal ``doc_id`` are one document with the links of all of them. Only
    ``doc_id`` and ``text`` are read; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    signed = stored(docs.mapInArrow(_signed, _SIGNED), "signed")
    classes = signed.where("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    banded = classes.select("doc_id", "n", F.explode("bands").alias("band"))
    crowded = banded.groupBy("band").agg(F.count("*").alias("rows")).where("rows > 1").select("band")
    met = stored(banded.join(crowded, "band"), "banded")
    # How many others a document meets over its bands: large for the text that near copies were made from.
    central = met.join(met.groupBy("band").agg(F.count("*").alias("rows")), "band").groupBy("doc_id").agg(F.sum("rows").alias("met"))
    members = stored(met.join(central, "doc_id"), "members")
    removed(met)
    wanted = members.select("doc_id").distinct()
    sets = stored(docs.join(wanted, "doc_id").mapInArrow(_sets, "doc_id bigint, found array<bigint>").dropDuplicates(["doc_id", "found"]), "sets")

    # Rows of one doc_id with different texts are one document: their classes are linked through it.
    several = signed.where("class IS NOT NULL AND doc_id IS NOT NULL").join(classes.select("class", F.col("doc_id").alias("v")), "class")
    links = several.where("doc_id <> v").groupBy("doc_id").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low <> high")
    links = several.join(links.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("u"), "v")
    links, checked, turn = stored(links, "links"), [], 0
    while True:
        found = components(links)
        labelled = members.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("alone", F.col("component").isNull())
        labelled = _open(labelled.withColumn("component", F.coalesce("component", "doc_id")))
        used = [members]
        if turn:
            used.append(stored(labelled, "open"))
            labelled = _open(_linkable(used[-1], sets)).join(classes.select("doc_id", "bands"), "doc_id")
        labelled = stored(labelled, "labelled")
        removed(*used)
        if labelled.isEmpty():
            result = stored(_result(signed, classes, found), "near-duplicates")
            removed(signed, classes, sets, links, found, labelled, *checked)
            return result
        order = Window.partitionBy("band").orderBy(F.desc("met"), "doc_id")
        others = labelled if not turn else labelled.where("component <> largest")
        pivots = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= (PIVOTS if turn else 1)).drop("rank")
        pivots = stored(pivots.select("band", *[F.col(c).alias(f"{c}2") for c in pivots.columns if c != "band"]), "pivots")
        compared = pivots.select("band", F.col("doc_id2").alias("doc_id"))
        members = stored(labelled.join(compared, ["band", "doc_id"], "left_anti").select("doc_id", "n", "met", "band"), "members")
        near = _enough(F.least("n", "n2"), F.col("n") + F.col("n2"))
        if turn:
            bound = F.least(F.when(F.col("alone2"), F.col("single")).otherwise(F.col("joined")), F.when(F.col("alone"), F.col("single2")).otherwise(F.col("joined2")))
            first_shared = F.array_position(F.zip_with("bands", "bands2", lambda x, y: x == y), True)
            near = near & _enough(bound, F.col("n") + F.col("n2")) & (first_shared == F.array_position("bands", F.col("band")))
            in_parts = F.aggregate(F.zip_with("shared", "shared2", lambda x, y: F.least(x, y)), F.lit(0).cast("bigint"), lambda x, y: x + y)
            near = near & _enough(in_parts, F.col("n") + F.col("n2"))
        pairs = labelled.join(pivots, "band").where("component <> component2").where(near)
        pairs = pairs.select(*_pairs("doc_id", "doc_id2")).distinct()
        if checked:
            pairs = pairs.join(reduce(DataFrame.unionByName, checked), ["u", "v"], "left_anti")
        pairs = stored(pairs, "pairs")
        checked, before = [*checked, pairs], links
        links = stored(links.unionByName(_confirmed(pairs, sets)), "links")
        removed(before, found, labelled, pivots)
        turn += 1


def _open(labelled: DataFrame) -> DataFrame:
    """Members of buckets with several components, and the largest component there."""
    sizes = labelled.groupBy("band", "component").agg(F.count("*").alias("rows"))
    several = sizes.groupBy("band").agg(F.count("*").alias("parts"), F.expr("max_by(component, struct(rows, component))").alias("largest")).where("parts > 1")
    return labelled.drop("largest").join(several.select("band", "largest"), "band")


def _enough(common: Column, sizes: Column) -> Column:
    """Whether two sets of these sizes together can be similar enough with so many common shingles: c >= t (sizes - c)."""
    return (100 + THRESHOLD) * common >= THRESHOLD * sizes


def _linkable(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """Members that can still be linked to another component, with upper bounds for their common shingles.

    ``joined`` counts the shingles that occur in some other component of several documents, ``single`` those that occur in another
    document that is a component by itself. A document has no more in common with one of either kind, so near copies with many
    changes of their own are settled without being compared with each other. ``shared`` counts both kinds by part of the hash range.
    """
    docs = labelled.select("doc_id", "component", "alone", "n").distinct()
    held = docs.join(sets, "doc_id").select("doc_id", "component", "alone", F.explode("found").alias("shingle")).distinct()
    of_many = F.when(~F.col("alone"), F.col("component"))
    holders = held.groupBy("shingle").agg(F.min(of_many).alias("low"), F.max(of_many).alias("high"), F.count_if("alone").alias("lone"))
    holders = holders.where("low IS NOT NULL AND (lone > 0 OR low <> high) OR lone > 1")
    elsewhere = F.col("low").isNotNull() & ((F.col("low") != F.col("component")) | (F.col("high") != F.col("component")))
    other_lone = F.col("lone") > F.col("alone").cast("int")
    part = F.pmod(F.col("shingle"), F.lit(PARTS)).cast("int").alias("part")
    in_parts = held.join(holders, "shingle").groupBy("doc_id", part)
    in_parts = in_parts.agg(F.count_if(elsewhere).alias("joined"), F.count_if(other_lone).alias("single"), F.count("*").alias("rows"))
    by_part = F.map_from_entries(F.collect_list(F.struct("part", "rows"))).alias("by_part")
    counts = in_parts.groupBy("doc_id").agg(F.sum("joined").alias("joined"), F.sum("single").alias("single"), by_part)
    every = F.sequence(F.lit(0), F.lit(PARTS - 1))
    counts = counts.withColumn("shared", F.transform(every, lambda p: F.coalesce(F.try_element_at("by_part", p), F.lit(0).cast("bigint")))).drop("by_part")
    return labelled.join(counts, "doc_id").where(" OR ".join(f"{100 + THRESHOLD} * {c} >= {THRESHOLD} * (n + {c})" for c in ("joined", "single")))


def _result(signed: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    label = classes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("class", F.coalesce("component", "doc_id").alias("component_id"))
    return (
        signed.drop("bands")
        .join(label, "class", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
