"""What the steps of an operator leave in the scratch folder, and what its tasks hold."""

import os
import random
from urllib.parse import urlparse

import numpy as np
import pandas as pd

from textwarden.llm import common, lines, pieces, repeats
from textwarden.llm.edits import within
from textwarden.session import scratch_folder


def _folders(spark) -> set[str]:
    base = urlparse(os.path.dirname(scratch_folder(spark))).path
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_folders_of_a_block_go_at_its_end(spark):
    before = _folders(spark)
    with common.steps(spark) as keep:
        gone = common.stored(spark.range(5))
        with common.steps(spark) as inner:
            kept = inner(common.stored(spark.range(7)).where("id > 0"))
        assert len(_folders(spark) - before) == 2 and kept.count() == 6 and gone.count() == 5
        out = keep(kept.union(gone))
    assert len(_folders(spark) - before) == 1 and out.count() == 11
    common.stored(spark.range(3))  # outside of blocks all stay
    assert len(_folders(spark) - before) == 2


def test_folders_of_a_block_go_when_it_fails(spark):
    before = _folders(spark)
    try:
        with common.steps(spark):
            common.stored(spark.range(5))
            raise ValueError
    except ValueError:
        pass
    assert _folders(spark) == before
    assert common.stored(spark.range(4)).count() == 4


def test_lines_leave_only_what_the_result_reads(spark):
    line = "what is written here once is written here again, word for word, number {}"
    docs = spark.createDataFrame([
        (1, "first\n" + line.format("one")), (2, line.format("ones") + "\nsecond"),
        (3, "third\n" + line.format("one")), (4, None)], "doc_id long, text string")
    before = _folders(spark)
    out = lines.deduplicate(docs, dropped="n")
    assert len(_folders(spark) - before) == 1
    got = {r["doc_id"]: (r["text"], r["n"]) for r in out.collect()}
    assert got == {1: ("first\n" + line.format("one"), 0), 2: ("second", 1), 3: ("third", 1), 4: (None, 0)}


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distances_of_many_pairs():
    rnd = random.Random(3)
    ones, twos = [], []
    for letters in ("ab", "abcdefg hij", "aé漢字\U0001F600z"):
        for _ in range(250):
            one = rnd.choices(letters, k=rnd.choice([1, 2, 5, 20, 63, 64, 65, 127, 128, 129, 150]))
            two = list(one)
            for _ in range(rnd.randrange(len(one))):
                at = rnd.randrange(len(two))
                two[at:at + rnd.randrange(2)] = rnd.choices(letters, k=rnd.randrange(1, 3))
            ones.append("".join(one))
            twos.append("".join(two) if rnd.random() < 0.8 else "".join(rnd.choices(letters, k=140)))
    found = np.array([_distance(a, b) for a, b in zip(ones, twos)])
    for off in (-1, 0, 1):
        assert (within(ones, twos, found + off) == (off >= 0)).all()


def test_long_lines_are_compared(spark):
    """Over the length for which many pairs are compared at once."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(600)]
    long, other = " ".join(words), " ".join([*words[:300], "changed", *words[301:]])
    assert len(long) > lines.LONG
    docs = spark.createDataFrame([(1, long), (2, other), (3, " ".join(words[::-1]))], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in lines.deduplicate(docs, dropped="n").collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_words_are_decoded_once():
    raw = pieces._model_bytes(pieces.MODEL_PATH)
    encoder, seen = pieces.Encoder(raw, check=True), []
    decode = encoder.decode
    encoder.decode = lambda ids: seen.extend(ids) or decode(ids)
    texts = ["one two three", "two\tthree  four", "", None, " x ", "a ▁ b", "日本 \U0001F600 <0x41>"]
    first = encoder.checked(texts)
    want = [x == (t or "") for x, t in zip(decode([ids for ids, _, _ in first]), texts)]
    assert [back for _, _, back in first] == want and want == [True] * 5 + [False, True]
    seen.clear()
    again = encoder.checked(texts * 3)
    assert not seen and [r[1:] for r in again] == [r[1:] for r in first] * 3
    # Without words, and with those held that were met last.
    whole, small = pieces.Encoder(raw, check=True), pieces.Encoder(raw, cache=8, check=True)
    whole.by_words = False
    for one in (whole, small):
        for _ in range(3):
            got = [one.checked([t])[0] for t in texts]
            assert [(ids.tolist(), *rest) for ids, *rest in got] == [
                (ids.tolist(), *rest) for ids, *rest in first]
    assert set(small.words) >= small.met and len(small.words) <= 8
    assert all(r[2] is None for r in pieces.Encoder(raw).checked(texts))


def test_equal_segments_are_sorted_once(monkeypatch):
    """The suffix array holds a segment once, however many documents have it."""
    sizes, inner = [], repeats.suffix_array
    monkeypatch.setattr(repeats, "suffix_array", lambda t, *a: sizes.append(len(t)) or inner(t, *a))
    same, longer = bytes(range(1, 61)), bytes(range(1, 71))
    parts = [(1, i, 5, same) for i in range(9, 0, -1)] + [(1, 4, 90, same), (1, 0, 7, longer)]
    rows = pd.DataFrame(parts, columns=["key", "id", "start", "bytes"]).sort_values(
        ["key", "id", "start"], ignore_index=True)
    got = pd.concat(repeats._scan(iter([rows])))
    want = [(i, 5, 11) for i in range(1, 10)] + [(4, 90, 11)]
    assert sorted(zip(got["id"], got["start"], got["count"])) == sorted(want)
    assert sizes == [61 + 71]


def test_frames_of_stored_rows_are_small(spark):
    """A Python function does not get all texts of a task at once."""

    def sizes(frames):
        for frame in frames:
            yield pd.DataFrame({"n": [len(frame)], "size": [int(frame["text"].str.len().sum())]})

    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id as string), 3000) text")
    before = spark.conf.get(common.FRAME_BYTES)
    got = common.stored(rows.mapInPandas(sizes, "n long, size long")).collect()
    assert sum(r["n"] for r in got) == 3000 and max(r["size"] for r in got) < 6_000_000
    assert spark.conf.get(common.FRAME_BYTES) == before
