"""Mixing sources to target weights, with DataFrame functions only.

The words of a source, document after document, are packed into blocks of ``BLOCK_WORDS``. A source's target fills a number of slots.
Every output shard draws how many slots each source has in it, a multinomial draw with the sources' numbers of slots as weights; the
draws of a source are then scaled so that they sum up to its slots and the target is met. Slots are numbered by running sums of these
counts over the shards. They go through a pseudorandom permutation of the source's block indices, another one in each pass over the
source, and the slots' blocks are joined by index. Everything follows from hashes of keys, so a run repeats itself and a lost task
is rebuilt alike. All steps work on (source, block) or (source, bucket) keys of bounded size, so a source with any share of the rows
is spread over as many tasks as its size needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import removed, stored

WORD = r"[^\x20\x09-\x0D]+"
#: A word with the white space behind it, and the first one also with that in front of it: end to end they are the text.
SPACED_WORD = r"(?:^[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
BLOCK_WORDS = 512
#: Mean number of slots in an output shard.
SHARD_SLOTS = 4096
#: Slots that one task draws and numbers; points in a chunk at least, and most chunks.
POINTS = 4 * SHARD_SLOTS
CHUNK_SLOTS, MOST_CHUNKS = 256, 1 << 20
#: Ranges of sources, one for each chunk, up to which they are broadcast.
FEW_RANGES = 100_000
#: Mean number of documents in a bucket, within which positions are summed up.
BUCKET_DOCS = 4096
#: Weights by rank of the source, repeating; the share of all words to take; how often a source may be taken.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_PASSES = 2
ROUNDS = 24


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame) -> DataFrame:
    """``key``, ``source_size``, ``target`` of each source: its share by weight of the total, at most ``MOST_PASSES`` times its size.

    What sources above their limit leave over goes to the others by weight until none is above. So all sources below their limit
    get the same amount ``level`` for each unit of weight, and a source is at its limit if that is below ``level`` for its weight:
    ordered by limit for each unit of weight, running sums give the level. The windows see one row for each source.
    """
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("key").startswith("-"), "key"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(MOST_PASSES))
    everything, ascending = Window.partitionBy(), Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), "key")
    before = F.coalesce(F.sum("limit").over(ascending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(ascending.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("level", (F.sum("source_size").over(everything) * TOTAL_SHARE - before) / rest)
    settled = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct((F.col("limit") / F.col("weight")).alias("at"), "key", "level"))
    sources = sources.withColumn("level", F.min(settled).over(everything)["level"])
    return sources.select("key", "source_size", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def _permuted(index: Column, n: Column, key: Column, turn: Column, backwards: bool = False) -> Column:
    """Swap-or-not: each round swaps ``index`` with its mirror image about a point drawn for the round, or does not, by a hash of
    the pair. Each round undoes itself, so the rounds are a permutation of 0 to n - 1, undone by going through them backwards."""
    rounds = range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS)

    def swap(at: Column, number: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, turn, number), n) - at, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(at, mirror), key, turn, number), F.lit(2)) == 0, mirror).otherwise(at)

    return F.aggregate(F.array(*[F.lit(k) for k in rounds]), index.cast("bigint"), swap)


def identity() -> list[Column]:
    """What tells rows apart: ``doc_id``, ``key`` (of the source) and ``text_hash``."""
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    return [F.col("doc_id").alias("doc_id"), key.alias("key"), F.xxhash64("text").alias("text_hash")]


def placed_documents(docs: DataFrame) -> DataFrame:
    """Identity, ``size``, and ``start``, the document's place among the words of its source; no texts."""
    counted = stored(docs.select(*identity(), n_words().alias("size")), "sized")
    buckets = max(1, -(-counted.count() // BUCKET_DOCS))
    sized = counted.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    sums = sized.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("key", "bucket").orderBy("doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, ["key", "bucket"])
    found = stored(placed.select("doc_id", "key", "text_hash", "size", (F.col("offset") + F.col("inside")).alias("start")), "placed")
    removed(counted)
    return found


def _sources_to_fill(targets: DataFrame) -> tuple[DataFrame, int]:
    """The sources that get slots, and the number of all slots.

    ``of`` has a source's ``n_slots`` (number), ``blocks``, ``short`` (words that its last block lacks) and ``last_take`` (words of its last slot).
    A pass takes every block once. The last pass stops when the target is met: slots before it hold full blocks but
    perhaps the source's last block, which is shorter, so the words before a slot are known without a running sum.
    """
    size, n, turn, wanted, whole = (F.col(c) for c in ("source_size", "blocks", "turn", "wanted", "whole"))
    sources = targets.where("source_size > 0 AND target >= 1").withColumn("words", F.floor("target").cast("bigint")).withColumn("blocks", F.ceil(size / BLOCK_WORDS).cast("bigint"))
    sources = sources.withColumn("turn", F.expr("(words - 1) div source_size")).withColumn("wanted", F.col("words") - turn * size).withColumn("short", BLOCK_WORDS * n - size)
    sources = sources.withColumn("short_at", _permuted(n - 1, n, F.col("key"), turn, backwards=True)).withColumn("whole", F.ceil(wanted / BLOCK_WORDS).cast("bigint"))

    def words_of(slots: Column) -> Column:
        return slots * BLOCK_WORDS - F.when(F.col("short_at") < slots, F.col("short")).otherwise(0)

    sources = sources.withColumn("count", whole + F.when(words_of(whole) < wanted, 1).otherwise(0))
    of = F.struct((turn * n + F.col("count")).alias("n_slots"), "blocks", "short", (wanted - words_of(F.col("count") - 1)).alias("last_take"))
    kept = stored(sources.select("key", of.alias("of")), "mix-sources")
    return kept, kept.agg(F.sum("of.n_slots")).first()[0] or 0


def n_shards(n_slots: int) -> int:
    return max(1, -(-n_slots // SHARD_SLOTS))


def drawn_counts(sources: DataFrame, n_slots: int, few: int | None = None) -> DataFrame:
    """What each shard draws: ``shard``, ``key``, ``of`` and ``n``, how many of its slots fell to the source; sources with none are left out.

    A draw is a point among all slots, put in order by source. It meets the source whose slots it falls between by the
    chunk of points that it lies in, so a source with any share of the slots is spread over its chunks. The ranges of sources are
    broadcast if their number, counted beforehand, is at most ``few`` (``FEW_RANGES``); else both sides are shuffled by chunk.
    """
    chunk = max(CHUNK_SLOTS, n_slots // MOST_CHUNKS)
    below = F.coalesce(F.sum("of.n_slots").over(Window.partitionBy().orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    ranges = sources.withColumn("low", below).withColumn("high", F.col("low") + F.col("of.n_slots"))
    ranges = ranges.withColumn("chunk", F.explode(F.expr(f"sequence(low div {chunk}, (high - 1) div {chunk})")))
    points = sources.sparkSession.range(0, n_slots, 1, max(1, -(-n_slots // POINTS)))
    points = points.select(F.expr(f"id * {n_shards(n_slots)} div {max(1, n_slots)}").alias("shard"), F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(max(1, n_slots))).alias("point"))
    points = points.withColumn("chunk", F.expr(f"point div {chunk}"))
    n_ranges = sources.count() + n_slots // chunk + 1  # a source has one more than the borders of chunks inside it
    joined = points.join(F.broadcast(ranges), "chunk") if n_ranges <= (FEW_RANGES if few is None else few) else points.hint("merge").join(ranges, "chunk")
    met = joined.where("point >= low AND point < high")
    return met.groupBy("shard", "key", "of").agg(F.count("*").alias("n"))


def slot_runs(sources: DataFrame, n_slots: int) -> DataFrame:
    """The counts, fitted to the targets, and the slots that they give: ``shard``, ``key``, ``of``, ``first``, ``end`` (exclusive).

    Running sums of a source's draws over the shards are scaled to its number of slots. A source that no shard drew, which only
    happens to the smallest, has its slots in one shard.
    """
    drawn = stored(drawn_counts(sources, n_slots), "shard-draws")
    missed = sources.join(drawn.select("key").distinct(), "key", "left_anti")
    missed = missed.select(F.pmod(F.xxhash64("key"), F.lit(n_shards(n_slots))).cast("bigint").alias("shard"), "key", "of", F.lit(1).cast("bigint").alias("n"))
    own = Window.partitionBy("key")
    sums = drawn.unionByName(missed).withColumn("upto", F.sum("n").over(own.orderBy("shard"))).withColumn("all", F.sum("n").over(own))

    def fitted(upto: str) -> Column:  # the product may need more than 64 bits
        return F.expr(f"CAST((CAST({upto} AS DECIMAL(19, 0)) * CAST(of.n_slots AS DECIMAL(19, 0))) div CAST(all AS DECIMAL(19, 0)) AS BIGINT)")

    return sums.select("shard", "key", "of", fitted("upto - n").alias("first"), fitted("upto").alias("end")).where("first < end")


def slots(targets: DataFrame) -> DataFrame:
    """The mix: ``key``, ``slot``, ``shard``, ``turn`` (pass over the source), ``block`` and ``take``, how many of its words."""
    return _slots(*_sources_to_fill(targets))


def _slots(sources: DataFrame, n_slots: int) -> DataFrame:
    n, slot = F.col("of.blocks"), F.col("slot")
    runs = slot_runs(sources, n_slots).repartition(max(1, -(-n_slots // POINTS)), "shard", "key")
    each = runs.withColumn("slot", F.explode(F.sequence("first", F.col("end") - 1))).withColumn("turn", F.expr("slot div of.blocks"))
    each = each.withColumn("block", _permuted(slot % n, n, F.col("key"), F.col("turn")))
    length = F.when(F.col("block") == n - 1, BLOCK_WORDS - F.col("of.short")).otherwise(BLOCK_WORDS)
    take = F.when(slot == F.col("of.n_slots") - 1, F.col("of.last_take")).otherwise(length)
    return each.select("key", "slot", "shard", "turn", "block", take.cast("bigint").alias("take"))


def shard_counts(mix: DataFrame) -> DataFrame:
    """What the shards of a mix hold: ``n_slots`` and ``words`` of each ``shard`` and ``key``."""
    return mix.groupBy("shard", "key").agg(F.count("*").alias("n_slots"), F.sum("take").alias("words"))


def pieces(placed: DataFrame, mix: DataFrame) -> DataFrame:
    """What each slot takes of each document: ``doc_id``, ``key``, ``size``, ``start``, ``turn``, ``slot``, ``shard``, ``low`` (first word, from 0), ``n`` words.

    Blocks are joined by index: a document is cut at block borders, and a (source, block) key has at most ``BLOCK_WORDS`` rows
    for each pass.
    """
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS).cast("bigint")
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS).cast("bigint"), last)))
    low = F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * BLOCK_WORDS + F.col("take"))
    # Slots are as many as blocks, which the planner cannot see from the few sources they come from: not to be broadcast.
    joined = cut.join(mix.select("key", "block", "turn", "slot", "shard", "take").hint("merge"), ["key", "block"])
    return joined.select("doc_id", "key", "text_hash", "size", "start", "turn", "slot", "shard", (low - F.col("start")).alias("low"), (high - low).alias("n")).where("n > 0")


def packed(low: Column, turn: Column, n: Column) -> Column:
    """A piece's first word, pass and number of words in one number; a shuffle moves every piece twice, and three numbers take more."""
    return (low * MOST_PASSES + turn) * (BLOCK_WORDS + 1) + n


def unpacked(piece: Column) -> list[Column]:
    """``low``, ``turn`` and ``n`` of a packed piece."""
    rest = F.call_function("div", piece, F.lit(BLOCK_WORDS + 1))
    return [F.call_function("div", rest, F.lit(MOST_PASSES)).alias("low"), (rest % MOST_PASSES).alias("turn"), (piece % (BLOCK_WORDS + 1)).alias("n")]


def _shard_rows(docs: DataFrame, placed: DataFrame, mix: DataFrame) -> DataFrame:
    """The rows of the output shards of ``mix``: ``doc_id``, ``key``, ``start``, ``shard``, ``slot``, ``piece`` (packed) and ``text`` of each piece.

    A document's words are found once, however many slots take of them. One column identifies a document on both sides, so that
    its grouping is the join's too and texts are shuffled once for both.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()  # one type for both, also in what may be null
    who = F.struct("doc_id", "key", "text_hash").cast(f"struct<doc_id:{kind},key:string,text_hash:bigint>").alias("who")
    taken = pieces(placed, mix).select(who, "start", "slot", "shard", packed(*(F.col(c) for c in ("low", "turn", "n"))).alias("piece")).repartition("who")
    runs = taken.groupBy("who", "start").agg(F.collect_list(F.struct("shard", "slot", "piece")).alias("runs"))
    texts = docs.select(*identity(), "text").select(who, "text").groupBy("who").agg(F.min("text").alias("text"))
    words = F.array(F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0)))

    def cut(w: Column, r: Column) -> Column:
        low, _, n = unpacked(r["piece"])
        text = F.array_join(F.slice(w, (low + 1).cast("int"), n.cast("int")), "")
        return F.struct(r["shard"].alias("shard"), r["slot"].alias("slot"), r["piece"].alias("piece"), text.alias("text"))

    parts = F.flatten(F.transform(words, lambda w: F.transform("runs", lambda r: cut(w, r))))
    joined = texts.hint("merge").join(runs, "who").select("who.doc_id", "who.key", "start", F.explode(parts).alias("part"))
    return joined.select("doc_id", "key", "start", "part.*")


def _in_shards(docs: DataFrame, placed: DataFrame, targets: DataFrame) -> DataFrame:
    """Each shard whole in one partition, its slots in random order, the pieces of a slot as in their block."""
    sources, n_slots = _sources_to_fill(targets)
    rows = _shard_rows(docs, placed, _slots(sources, n_slots))
    rows = rows.repartition(n_shards(n_slots), "shard").select("doc_id", "key", "start", "shard", "slot", *unpacked(F.col("piece")), "text")
    return rows.sortWithinPartitions("shard", F.xxhash64("slot", "key"), "slot", "key", F.col("start") + F.col("low"))


def mixed_shards(docs: DataFrame) -> DataFrame:
    """The mix as output shards: a row for each piece of a document in a slot.

    ``shard``, ``slot`` (number within its source), ``source``, ``turn`` (pass over the source), ``place`` (the piece's first word among the
    words of its source), ``doc_id``, ``low`` (that word's place in the document), ``n_words`` and ``text``, as it stands in the document.
    A shard lies in one partition, in the order to be read.
    """
    placed = placed_documents(docs)
    rows = _in_shards(docs, placed, stored(source_targets(placed), "targets"))
    source = F.when(F.col("key") != "-", F.substring("key", F.lit(2), F.length("key")))
    return rows.select("shard", "slot", source.alias("source"), "turn", (F.col("start") + F.col("low")).alias("place"), "doc_id", "low", F.col("n").alias("n_words"), "text")


def mix_documents(docs: DataFrame) -> DataFrame:
    """Per document: ``size``, its source's ``source_size`` and ``target``, and what the output shards hold of it: ``taken`` words
    in ``n_shards`` shards, and ``digest``, a hash of its pieces' shards, slots, places and texts (0 if there are none).

    Sizes are words of the text between ASCII white space; null texts, like blank ones, have none and are never taken. Sources are
    ranked by code point, null last as a source of its own. Every row counts, also rows that repeat or have a null ``doc_id``. Only ``doc_id``, ``text`` and ``source`` are read. With no words at all
    every target is 0; an empty table gives an empty result.
    """
    placed = placed_documents(docs)
    targets = stored(source_targets(placed), "targets")
    shards = _in_shards(docs, placed, targets)
    held = shards.withColumn("hash", F.xxhash64("shard", "slot", "low", "n", "text")).groupBy("key", "start", "shard").agg(F.sum("n").alias("n"), F.bit_xor("hash").alias("hash"))
    taken = held.groupBy("key", "start").agg(F.sum("n").alias("taken"), F.count("*").alias("n_shards"), F.bit_xor("hash").alias("digest"))
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.start") == F.col("b.start")) & (F.col("a.size") > 0)  # no two documents with words start at one place
    found = [F.coalesce(f"b.{c}", F.lit(0)).cast("bigint").alias(c) for c in ("taken", "n_shards", "digest")]
    joined = placed.alias("a").join(taken.alias("b"), same, "left").select("a.doc_id", "a.key", "a.size", *found)
    return joined.join(targets, "key").select("doc_id", "size", "source_size", "target", "taken", "n_shards", "digest")


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each document and pass that takes words of it, with the columns of ``docs``.

    ``text`` holds the words taken (the text itself if those are all its words, else joined by a space); ``n_chars``, if there is such a
    column, is its length. Of rows with equal id, source and text each is mixed, with the other columns of one of them.
    """
    placed = placed_documents(docs)
    taken = pieces(placed, slots(stored(source_targets(placed), "targets")))
    runs = taken.groupBy("doc_id", "key", "text_hash", "size", "start", "turn").agg(F.sort_array(F.collect_list(F.struct("low", "n"))).alias("runs"), F.sum("n").alias("words"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    orderable = all(f.dataType.typeName() not in ("map", "variant") for f in docs.schema.fields)
    texts = docs.select(*identity(), whole.alias("row")).groupBy("doc_id", "key", "text_hash").agg((F.min if orderable else F.first)("row").alias("row"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    words = F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0))
    some = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(words, (r["low"] + 1).cast("int"), r["n"].cast("int")))), " ")
    joined = texts.alias("a").join(runs.alias("b"), same).select("row", F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(some).alias("taken"))
    changed = {"text": F.col("taken"), "n_chars": F.length("taken").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
