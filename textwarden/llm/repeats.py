"""Repeated passages across documents, by suffix arrays.

A text is its UTF-8 bytes.  A byte goes if it lies in a string of ``LENGTH`` bytes that also
starts in a document with a smaller id.

Every such string has a key, the smallest hash of its substrings of ``GRAM`` bytes, so equal
strings meet under one key and neighbouring strings mostly share it: a text is a row of
segments, each of consecutive strings of one key.  Keys that occur in one document only are
dropped after a partial aggregation of (key, id).  The other segments are sent to their key
with their bytes, in order of ids.  There a suffix array of many segments is built in two
stages: suffixes smaller than their successors are sorted directly, the rest is induced by
scanning buckets of first bytes, a bucket at a time.  Strings whose neighbours in the array
share ``LENGTH`` bytes form a group, and all but those of its smallest id are repeats.  Equal
segments are in the array once.  A key with
more segments than fit a buffer is taken in pieces by rising id, with hashes of the strings seen.

Defined cases: null and empty texts, and texts under ``LENGTH`` bytes, lose nothing; rows
with a null id are kept whole and compared with nothing; rows of one id are not compared with
each other, and what is cut from one of them is found for its own text; very long texts are
read whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, stored, table

LENGTH = 50
GRAM = 18
PIECE = 1 << 20
BUFFER = 2 << 20
_FACTOR = 0x9FB21C651E98DF25
_POWERS: list[np.ndarray] = []
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# ---- segments of one text ------------------------------------------------------

def segments(data: bytes, length: int = LENGTH, gram: int = GRAM
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, count) of the runs of strings of one key, in order."""
    if not _POWERS:
        for factor in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            steps = np.full(PIECE + length + 1, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    up, down = _POWERS
    whole = np.frombuffer(data, dtype=np.uint8)
    keys, starts = [], []
    for at in range(0, max(0, len(whole) - length + 1), PIECE):
        # The strings that start in this piece.
        piece = whole[at:at + PIECE + length - 1]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[piece] * up[:len(piece)], out=sums[1:])
        h = mix((sums[gram:] - sums[:-gram]) * down[:len(piece) - gram + 1])
        # Smallest of length - gram + 1 neighbours, by doubling.
        width, want = 1, length - gram + 1
        while width < want:
            step = min(width, want - width)
            h = np.minimum(h[:-step], h[step:])
            width += step
        edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        keys.append(h[edge])
        starts.append(edge + at)
    if not keys:
        return (np.zeros(0, np.int64),) * 3
    key, start = np.concatenate(keys).view(np.int64), np.concatenate(starts)
    total = len(whole) - length + 1
    return key, start, np.diff(np.append(start, total))


# ---- suffix array ----------------------------------------------------------------

def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (zeros past the end)."""
    padded = np.concatenate([t, np.zeros(64, np.uint8)])
    out = np.zeros(len(t) + 56, dtype=np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:i + len(out)]
    return out


def _by_words(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The places ``at`` ordered by the ``depth`` bytes from each: by eight, and those that are
    still equal by as many more as fit into a number beside the number of their group."""
    at = at[np.argsort(words[at])]
    key, done, tied = words[at], 8, np.arange(len(at))
    while done < depth:
        # Of the rows looked at, in order, those that equal a neighbour.
        same = key[1:] == key[:-1]
        mine = np.append(same, False)
        mine[1:] |= same
        if not mine.any():
            break
        first = np.append(True, ~same)[mine]
        tied = tied[mine]
        group = (np.cumsum(first) - 1).astype(np.uint64)
        room = (64 - int(group[-1]).bit_length()) // 8
        shift = np.uint64(64 - 8 * room)
        some = at[tied]
        key = words[some + done] >> shift
        if room < 8:
            key |= group << np.uint64(8 * room)
        by = np.argsort(key)
        at[tied], key = some[by], key[by]
        done += room
    return at


def suffix_array(t: np.ndarray, words: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places of all suffixes, ordered by at least their first ``depth`` bytes."""
    n = len(t)
    order = np.zeros(n, dtype=np.int64)
    # Does the suffix grow towards its successor?  Equal bytes go by the next that differs.
    after = np.append(t[1:].astype(np.int16), -1)
    differs = np.flatnonzero(t != after)
    nearest = differs[np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)]
    small = t[nearest] < after[nearest]
    size = np.bincount(t, minlength=256)
    head = np.concatenate([[0], np.cumsum(size)])
    # Stage one: sort the small ones directly, by eight bytes at a time.
    direct = np.flatnonzero(small)
    if len(direct):
        direct = _by_words(words, direct, depth)
        first = t[direct]
        n_small = np.bincount(first, minlength=256)
        rank = np.arange(len(direct)) - np.concatenate([[0], np.cumsum(n_small)])[first]
        order[head[first.astype(int) + 1] - n_small[first] + rank] = direct
    else:
        n_small = np.zeros(256, dtype=np.int64)
    # Stage two: every other suffix follows from its successor's place.
    fill = head[:-1].copy()

    def put(places: np.ndarray) -> None:
        places = places[places > 0] - 1
        places = places[~small[places]]
        if len(places):
            byte = t[places]
            by = np.argsort(byte, kind="stable")
            places, byte = places[by], byte[by]
            count = np.bincount(byte, minlength=256)
            rank = np.arange(len(places)) - np.concatenate([[0], np.cumsum(count)])[byte]
            order[fill[byte] + rank] = places
            fill[:] += count

    put(np.array([n]))  # the last suffix comes before all that follow a longer one
    for c in np.flatnonzero(size):
        done = head[c]
        while done < fill[c]:
            upto = fill[c]
            put(order[done:upto].copy())
            done = upto
        put(order[head[c + 1] - n_small[c]:head[c + 1]].copy())
    return order


def repeated(parts: list[bytes], ids: np.ndarray, length: int = LENGTH, hashed: bool = True
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every string of ``length`` in the parts, in array order: part, offset, whether it
    starts a new group, the group's smallest id, and, if ``hashed``, a hash of the string."""
    sizes = np.array([len(p) for p in parts])
    t = np.frombuffer(b"".join(x for p in parts for x in (p, b"\xff")), dtype=np.uint8)
    # UTF-8 has no byte 255: as 0 it ends parts.
    t = np.where(t == 255, 0, t + 1).astype(np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    words = _words(t)
    order = suffix_array(t, words, length)
    # Only where a string has room in its part.
    room = np.arange(len(t)) <= np.repeat(base[:-1] + sizes - length, sizes + 1)
    order = order[room[order]]
    # Common prefixes with the array's next string, as far as ``length`` goes.
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    spots = [*range(0, length - 7, 8), length - 8]
    code = np.zeros(len(order) if hashed else 0, dtype=np.uint64)
    for spot in spots:
        w = words[order + spot]
        same &= w[1:] == w[:-1]
        if hashed:
            code = mix(code * np.uint64(_FACTOR) + w)
    fresh = np.concatenate([[True], ~same])[:len(order)]
    part = owner[order]
    group = np.cumsum(fresh) - 1
    low = np.minimum.reduceat(ids[part], np.flatnonzero(fresh)) if len(order) else ids[:0]
    return part, order - base[part], fresh, low[group], code


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Removable strings (id, start, count) of segments that come sorted by key and id."""
    held: list[pd.DataFrame] = []
    size = 0
    hot_key, seen_code, seen_low = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def solve(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
        """``last``: whether the rows end their last key."""
        nonlocal hot_key, seen_code, seen_low
        ids, key = rows["id"].to_numpy(), rows["key"].to_numpy()
        # Copies of a segment are one, of their smallest id.
        copy_of, own = pd.factorize(rows["bytes"])
        lowest = np.full(len(own), np.iinfo(np.int64).max)
        np.minimum.at(lowest, copy_of, ids)
        own_key = np.zeros(len(own), np.int64)
        own_key[copy_of] = key
        part, offset, fresh, low, code = repeated(
            list(own), lowest, hashed=hot_key is not None or not last)
        if hot_key is not None and len(part):
            of_hot = own_key[part] == hot_key
            at = np.minimum(np.searchsorted(seen_code, code), max(0, len(seen_code) - 1))
            known = of_hot & (seen_code[at] == code) if len(seen_code) else np.zeros(len(part), bool)
            low = np.where(known, np.minimum(low, seen_low[at] if len(seen_low) else 0), low)
        if not last:
            # More of this key follows: remember its strings and their smallest ids.
            if hot_key != key[-1]:
                seen_code, seen_low = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            hot_key = key[-1]
            mine = fresh & (own_key[part] == hot_key)
            codes, lows = np.append(seen_code, code[mine]), np.append(seen_low, low[mine])
            by = np.lexsort((lows, codes))
            codes, lows = codes[by], lows[by]
            keep = np.concatenate([[True], codes[1:] != codes[:-1]])
            seen_code, seen_low = codes[keep], lows[keep]
        else:
            hot_key = None
        # The strings of each segment in order, for each of its copies.
        size = np.bincount(part, minlength=len(own))
        # All strings of a part are there, so their places are known without sorting.
        by = np.empty(len(part), np.int64)
        by[(np.cumsum(size) - size)[part] + offset] = np.arange(len(part))
        low, offset = low[by], offset[by]
        count = size[copy_of]
        at = np.arange(count.sum()) + np.repeat(
            (np.cumsum(size) - size)[copy_of] - (np.cumsum(count) - count), count)
        row = np.repeat(np.arange(len(rows)), count)
        gone = low[at] < ids[row]
        row, at = row[gone], at[gone]
        who, where = ids[row], rows["start"].to_numpy()[row] + offset[at]
        by = np.lexsort((where, who))
        who, where = who[by], where[by]
        edge = np.flatnonzero(np.concatenate(
            [[True], (who[1:] != who[:-1]) | (where[1:] != where[:-1] + 1)])) if len(who) else []
        return pd.DataFrame({
            "id": who[edge] if len(who) else [], "start": where[edge] if len(who) else [],
            "count": np.diff(np.append(edge, len(who))) if len(who) else []})

    for frame in frames:
        # Arrow batches can be large: taken in slices.
        for cut in range(0, len(frame), 4096):
            rows = frame.iloc[cut:cut + 4096]
            held.append(rows)
            size += int(rows["bytes"].map(len).sum())
            if size < BUFFER:
                continue
            rows = pd.concat(held, ignore_index=True)
            key = rows["key"].to_numpy()
            ends = np.flatnonzero(key[1:] != key[:-1])
            if len(ends):
                stop = int(ends[-1]) + 1
                yield solve(rows.iloc[:stop], True)
                held, size = [rows.iloc[stop:]], int(rows["bytes"].iloc[stop:].map(len).sum())
            else:
                yield solve(rows, False)
                held, size = [], 0
    if held:
        rows = pd.concat(held, ignore_index=True)
        if len(rows):
            yield solve(rows, True)


# ---- over a table ------------------------------------------------------------------

def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _pack(text: str | None) -> bytes:
    return zstandard.compress(_bytes(text), 1)


def repeated_strings(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, start, count): the strings of each document (id, z) that occur in an earlier one.

    ``texts`` has the same documents as (id, text).  Each step is written, so that its shuffles
    are off the disks before the next one: keys, segments and texts never lie there together.
    """

    def own_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, keys, size = [], [], 0
            for name, t in zip(frame["id"], frame["text"]):
                key = np.unique(segments(_bytes(t))[0])
                ids.append(np.full(len(key), name, dtype=np.int64))
                keys.append(key)
                size += len(key)
                if size > 1 << 19:
                    yield pd.DataFrame({"key": np.concatenate(keys), "id": np.concatenate(ids)})
                    ids, keys, size = [], [], 0
            if size:
                yield pd.DataFrame({"key": np.concatenate(keys), "id": np.concatenate(ids)})

    # Combined before its shuffle; the join with the result splits keys that are frequent.
    keys = texts.mapInPandas(own_keys, "key long, id long")
    shared = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    wanted = keys.join(shared.where("low < high").select("key"), "key", "left_semi")
    wanted = stored(wanted.groupBy("id").agg(F.collect_list("key").alias("keys")))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, size = [], 0
            for name, z, keep in zip(frame["id"], frame["z"], frame["keys"]):
                data = zstandard.decompress(z)
                key, start, count = segments(data)
                for i in np.flatnonzero(np.isin(key, np.asarray(keep))):
                    a = int(start[i])
                    out.append((int(key[i]), name, a, data[a:a + int(count[i]) + LENGTH - 1]))
                    size += len(out[-1][3])
                if size > 1 << 22:
                    yield pd.DataFrame(out, columns=["key", "id", "start", "bytes"])
                    out, size = [], 0
            yield pd.DataFrame(out, columns=["key", "id", "start", "bytes"])

    parts = docs.join(wanted, "id").mapInPandas(
        cut, "key long, id long, start long, bytes binary")
    sorted_ = parts.repartition("key").sortWithinPartitions("key", "id", "start")
    return stored(sorted_.mapInPandas(_scan, "id long, start long, count long"))


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, bytes, bytes removed, spans removed, hash and text of what is left."""

    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([_pack(t if isinstance(t, str) else None) for t in series])

    pack = F.pandas_udf(packed, "binary").asNondeterministic()
    rows = docs.select(F.col(key).cast("long").alias("id"), pack(F.col(text)).alias("z"))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    found = repeated_strings(rows.where("id is not null"), texts.where("id is not null"))
    spans = found.groupBy("id").agg(F.collect_list(F.struct("start", "count")).alias("spans"))

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, z, spans in zip(frame["id"], frame["z"], frame["spans"]):
                data = np.frombuffer(zstandard.decompress(z), dtype=np.uint8)
                change = np.zeros(len(data) + 1, dtype=np.int64)
                for s in [] if spans is None else spans:
                    # Rows of one id may differ: only what lies in this text.
                    if s["start"] + s["count"] + LENGTH - 1 <= len(data):
                        change[s["start"]] += 1
                        change[s["start"] + s["count"] + LENGTH - 1] -= 1
                gone = np.cumsum(change[:-1]) > 0
                n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
                left = data[~gone].tobytes()
                out.append((name, len(data), int(gone.sum()), n_spans,
                            hashlib.sha256(left).hexdigest(), left))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans",
                                             "kept_sha256", "kept"])

    done = rows.join(spans, "id", "left").mapInPandas(
        finish, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done.withColumnRenamed("id", key)


def op5_repeats(spark, folder: str) -> DataFrame:
    """What is left of every document without passages of earlier ones."""
    return cut_repeats(table(spark, folder, "documents")).drop("kept")
