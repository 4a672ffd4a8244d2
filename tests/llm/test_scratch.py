import glob
import os
import random
import time

from tests.llm.conftest import prose
from tidemark.llm import minhash, mixing
from tidemark.llm.components import removed, stored
from tidemark.session import DROP_SHUFFLES, shared_folder


def _names(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return {name.rsplit("-", 1)[0] for name in os.listdir(folder)} if os.path.isdir(folder) else set()


def _added(spark, run):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = run()
    return found, sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before)


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(len(glob.glob(f"{folder}/*/shuffle_*")) for folder in folders)


def test_a_stored_table_leaves_no_shuffle_and_can_be_removed(spark):
    def write():
        before = _shuffle_files(spark)
        table = stored(spark.range(1000).repartition(5, "id"), "shuffled")
        for _ in range(50):
            if _shuffle_files(spark) <= before:
                return table
            time.sleep(0.2)
        raise AssertionError("shuffle files stay")

    table, added = _added(spark, write)
    assert added == ["shuffled"] and table.count() == 1000 and spark.conf.get(DROP_SHUFFLES, None) is None
    _, added = _added(spark, lambda: removed(table))
    assert added == [] and "shuffled" not in _names(spark)


def test_near_duplicates_leave_nothing_but_their_result(spark, documents):
    rng = random.Random(1)
    texts = [prose(rng, 40) for _ in range(20)]
    rows = [t + f" end{k}" for t in texts for k in range(3)] + [None, ""]
    found, added = _added(spark, lambda: minhash.near_duplicates(documents(rows)))
    assert added == ["near-duplicates"]
    assert sorted(r["doc_id"] for r in found.where("kept").collect()) == [*range(0, 60, 3), 60, 61]


def test_placing_documents_leaves_their_places_alone(spark, documents):
    placed, added = _added(spark, lambda: mixing.placed_documents(documents(["a b", "c", "d e f"])))
    assert added == ["placed"] and placed.count() == 3
