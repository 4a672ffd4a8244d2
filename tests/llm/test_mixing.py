import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, key int, start string"


def targets(rows):
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(mixing.WORD, t or ""))
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    rest, out, below = 1.5 * sum(sizes.values()), {}, set(names)
    while below:
        share = {s: rest * weight[s] / sum(weight[x] for x in below) for s in below}
        over = {s for s in below if share[s] > 2 * sizes[s]}
        out |= {s: 2.0 * sizes[s] for s in over} if over else share
        rest -= sum(2 * sizes[s] for s in over)
        below = below - over if over else set()
    return sizes, out


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows], SCHEMA)


@pytest.fixture
def rows():
    rng = random.Random(0)
    names = ["b", "a", "Z", "é", "z", None, "", "-", "+"]
    rows = [(i, prose(rng, rng.randrange(80)), rng.choice(names[: 2 + i % 8])) for i in range(300)]
    return rows + [(300, None, "a"), (301, "", None), (302, " \t", "only blanks"), (303, "w " * 5000, "a"), (7, "same", "b"), (7, "same", "b"), (None, "x y", None)]


@pytest.mark.parametrize("block", [1, 7, 512])
def test_sizes_targets_and_limits(spark, monkeypatch, rows, block):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 20)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    got = mixing.mix_documents(table(spark, rows)).collect()
    sizes, wanted = targets(rows)
    plain = collections.Counter((i, len((t or "").split())) for i, t, _ in rows)
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == plain
    taken = collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    expected = collections.Counter()
    for s in sizes:
        expected[sizes[s], round(wanted[s], 6)] += int(wanted[s] + 1e-9)
    assert set(taken) == set(expected)
    assert all(abs(taken[k] - expected[k]) <= 2 for k in taken)


def test_reruns_agree(spark, rows):
    one, two = (sorted(map(str, mixing.mix_documents(table(spark, r)).collect())) for r in (rows, rows[::-1]))
    assert one == two


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_documents(table(spark, [])).count() == 0
    got = mixing.mix_documents(table(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_permutations(spark):
    for n in (1, 2, 3, 10, 97):
        df = spark.range(n).select("id", mixing._permuted(F.col("id"), F.lit(n), F.lit("k"), F.lit(0)).alias("p"))
        back = df.select("id", "p", mixing._permuted(F.col("p"), F.lit(n), F.lit("k"), F.lit(0), backwards=True).alias("b")).collect()
        assert sorted(r["p"] for r in back) == list(range(n)) and all(r["id"] == r["b"] for r in back)


def test_shards_draw_counts_and_slots_follow_them(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 500)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 4)
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 32)
    given = [("+a", 30000, 20001.5), ("+b", 4001, 8002.0), ("+c", 7, 9.0), ("+d", 0, 0.0), ("-", 6000, 5999.0)] + [(f"+t{k}", 3, 3.0) for k in range(200)]
    targets = spark.createDataFrame(given, "key string, source_size bigint, target double")
    sources, n_slots = mixing._sources_to_fill(targets)
    total = {r["key"]: r["of"]["n_slots"] for r in sources.collect()}
    mix = [tuple(r) for r in mixing.slots(targets).collect()]
    words, numbers = collections.Counter(), collections.defaultdict(list)
    for key, slot, _, _, _, take in mix:
        assert 0 < take <= 4
        words[key] += take
        numbers[key].append(slot)
    assert words == {k: int(t) for k, _, t in given if t}
    assert n_slots == sum(total.values()) and all(sorted(numbers[k]) == list(range(n)) for k, n in total.items())

    shards = mixing.n_shards(n_slots)
    drawn = [(r["shard"], r["key"], r["n"]) for r in mixing.drawn_counts(sources, n_slots).collect()]
    assert sorted(drawn) == sorted((r["shard"], r["key"], r["n"]) for r in mixing.drawn_counts(sources, n_slots, few=0).collect())
    per_shard, per_source = collections.Counter(), collections.Counter()
    for shard, key, n in drawn:
        per_shard[shard] += n
        per_source[key] += n
    assert set(per_shard) == set(range(shards)) and max(per_shard.values()) - min(per_shard.values()) <= 1 and sum(per_shard.values()) == n_slots
    assert all(abs(n - total[k]) < 6 * total[k] ** 0.5 + 6 for k, n in per_source.items())
    # The variance of a source's draws is that of a multinomial.
    share = total["+a"] / n_slots
    of_a = [n for _, k, n in drawn if k == "+a"]
    variance = sum((n - n_slots / shards * share) ** 2 for n in of_a) / shards
    assert 0.2 < variance / (n_slots / shards * share * (1 - share)) < 3

    counts, upto = collections.Counter(), collections.Counter()
    for shard, key, n in sorted(drawn):
        before, upto[key] = upto[key], upto[key] + n
        counts[shard, key] = upto[key] * total[key] // per_source[key] - before * total[key] // per_source[key]
    held = collections.Counter((shard, key) for key, _, shard, _, _, _ in mix)
    assert {k: n for k, n in held.items() if k[1] in per_source} == +counts
    assert all(len({s for s, k in held if k == key}) == 1 for key in total if key not in per_source)
    assert mixing.slots(targets.where("false")).count() == 0


def test_texts_hold_the_words_taken(spark, monkeypatch, rows):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 7)
    docs = table(spark, rows)
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns
    words, whole = collections.Counter(), collections.defaultdict(collections.Counter)
    for i, t, _ in rows:
        whole[i].update((t or "").split())
    for r in texts.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert not collections.Counter(r["text"].split()) - whole[r["doc_id"]]
    taken = collections.Counter()
    for r in mixing.mix_documents(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    assert +words == +taken


def test_shards_hold_the_slots_that_drew_them(spark, monkeypatch, rows):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 7)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 100)
    docs = table(spark, rows)
    mix = mixing.slots(mixing.source_targets(mixing.placed_documents(docs)))
    slots = {(r["key"], r["slot"]): (r["shard"], r["turn"], r["take"]) for r in mix.collect()}
    n_shards = -(-len(slots) // 100)
    assert n_shards > 10 and {s for s, _, _ in slots.values()} == set(range(n_shards))
    per_source = collections.Counter(k for k, _ in slots)
    for r in mixing.shard_counts(mix).collect():  # six standard deviations about the mean
        mean = per_source[r["key"]] / n_shards
        assert abs(r["n_slots"] - mean) < 6 * mean**0.5 + 6

    found, spread = collections.Counter(), collections.defaultdict(set)
    texts, taken = collections.defaultdict(list), collections.Counter()
    for p, part in enumerate(mixing.mixed_shards(docs).rdd.glom().collect()):
        for r in part:
            spread[r["shard"]].add(p)
            slot = ("-" if r["source"] is None else "+" + r["source"], r["slot"])
            assert slots[slot][:2] == (r["shard"], r["turn"]) and len(r["text"].split()) == r["n_words"]
            found[slot] += r["n_words"]
            taken[r["doc_id"]] += r["n_words"]
            texts[r["doc_id"], r["turn"], r["place"] - r["low"]].append((r["low"], r["text"]))
    assert dict(found) == {k: take for k, (_, _, take) in slots.items()}
    assert all(len(p) == 1 for p in spread.values())
    given = {t for _, t, _ in rows if t}
    assert sum("".join(t for _, t in sorted(v)) in given for v in texts.values()) > 200  # whole documents, end to end

    summed = collections.Counter()
    for r in mixing.mix_documents(docs).collect():
        summed[r["doc_id"]] += r["taken"]
        assert (r["n_shards"] > 0) == (r["taken"] > 0) == (r["digest"] != 0)
    assert +summed == taken


def test_pieces_travel_in_one_number(spark):
    top = mixing.BLOCK_WORDS
    rows = [(low, turn, n) for low in (0, 1, 12345, 1 << 40) for turn in range(mixing.MOST_PASSES) for n in (1, 7, top)]
    df = spark.createDataFrame(rows, "low bigint, turn bigint, n bigint")
    back = df.select(mixing.packed(F.col("low"), F.col("turn"), F.col("n")).alias("piece")).select(*mixing.unpacked(F.col("piece")))
    assert [tuple(r) for r in back.collect()] == rows


def test_a_text_cut_between_blocks_is_whole_in_the_shards(spark):
    long = " ".join(f"w{i}" for i in range(3 * mixing.BLOCK_WORDS + 5))
    got = collections.defaultdict(dict)
    for r in mixing.mixed_shards(table(spark, [(1, long, "a"), (2, "x y z", "b")])).collect():
        got[r["doc_id"], r["turn"]][r["low"]] = r["text"]
        assert len(r["text"].split()) == r["n_words"] <= mixing.BLOCK_WORDS
    first = got[1, 0]
    assert "".join(first[low] for low in sorted(first)) == long
