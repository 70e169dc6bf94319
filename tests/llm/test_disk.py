"""What the steps of an operator leave on the executors' disks."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from textwarden.llm import common, lines, phrases, repeats


def _shuffled(spark) -> set[str]:
    """Names of the shuffle files of this session."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for top in dirs.localDirsString() for _, _, names in os.walk(top)
            for f in names if f.startswith("shuffle_")}


def _gone(spark, before: set[str]) -> set[str]:
    import time

    for _ in range(50):
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before, setting = _shuffled(spark), spark.conf.get(common.CLEANUP, None)
    rows = spark.range(20_000).repartition(7, "id").groupBy((F.col("id") % 100).alias("k")).count()
    out = common.stored(rows)
    assert not _gone(spark, before)
    assert out.count() == 100 and out.agg(F.sum("count")).first()[0] == 20_000
    assert spark.conf.get(common.CLEANUP, None) == setting


def test_steps_of_repeats_are_written(spark):
    """Keys, segments and texts are not shuffled by one job: the last one only joins spans."""
    passage = "the same passage of more than fifty bytes stands in both of these texts. "
    docs = spark.createDataFrame([(1, passage + "one"), (2, "two " + passage), (3, "none"), (None, passage)],
                                 "doc_id long, text string")
    out = repeats.cut_repeats(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.count("Aggregate") == 1
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out.collect()}
    size = len(passage)
    assert got == {1: (size + 3, 0, 0), 2: (size + 4, size, 1), 3: (4, 0, 0), None: (size, 0, 0)}


def test_a_task_of_answers_has_one_range(spark):
    """Ranges are dealt over as many partitions, so a task does not take more of a larger corpus."""
    rows = []
    for chunk in range(3):
        for part in range(40):
            fps = np.arange(5, dtype=np.uint64) + np.uint64(part * 16 + chunk)
            rows.append((part, chunk, phrases.pack(fps),
                         np.full(5, 4, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
    sent = spark.createDataFrame(pd.DataFrame(rows, columns=["part", "chunk", "fps", "counts"]),
                                 "part long, chunk long, fps binary, counts binary")
    out = phrases._answers(sent, 12, 40)
    assert out.rdd.getNumPartitions() == 40
    got = sorted((r["chunk"], phrases.unpack(r["fps"]).tolist()) for r in out.collect())
    # Only what all three chunks have occurs 12 times.
    assert got == sorted((c, [p * 16 + 2, p * 16 + 3, p * 16 + 4]) for c in range(3) for p in range(40))


def test_tied_suffixes_are_sorted_further_alone():
    """Places by their first 50 bytes, as a sort of all of them has it; only ties are read on."""
    rng = np.random.default_rng(3)
    unit = rng.integers(1, 5, 400)
    t = np.concatenate([rng.integers(1, 5, 900), unit, unit, np.full(90, 2), unit[:60]]).astype(np.uint8)
    words, at = repeats._words(t), rng.permutation(len(t))
    got = repeats._by_words(words, at, 50)
    data = t.tobytes() + bytes(64)
    strings = [data[i:i + 50] for i in got]
    assert strings == sorted(strings) and sorted(got) == list(range(len(t)))
    assert not len(repeats._by_words(words, at[:0], 50))


def test_strings_are_hashed_only_where_a_key_goes_on():
    """A buffer that ends its key needs no hashes of its strings."""
    parts, ids = [b"x" * 60, b"x" * 55 + b"abcdef"], np.array([1, 2])
    plain, hashed = repeats.repeated(parts, ids, hashed=False), repeats.repeated(parts, ids)
    assert len(plain[4]) == 0 and len(hashed[4]) == len(hashed[0]) == 11 + 12
    assert all((x == y).all() for x, y in zip(plain[:4], hashed[:4]))


def test_more_pairs_than_lines_are_compared_in_slices(spark, monkeypatch):
    """Texts of all pairs never lie on the disks together; the pairs found are the same."""
    texts = ["a line of some words and more", "a line of some words and mare", "quite another one",
             "quite another two", "a line of some worlds and more", "nothing like the rest of them"]
    known = spark.createDataFrame(list(enumerate(texts)), "h long, line string")
    pairs = spark.createDataFrame([(a, b) for a in range(6) for b in range(a + 1, 6)], "a long, b long")
    written = []
    monkeypatch.setattr(lines, "stored", lambda df: written.append(df.count()) or common.stored(df))
    got = sorted(map(tuple, lines._compared(pairs, known, 0.8).collect()))
    assert got == [(0, 1), (0, 4), (1, 4), (2, 3)] and len(written) == 3 and sum(written) == 4
