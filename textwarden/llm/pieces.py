"""SentencePiece models on the tokenizers library: encoding, decoding and parity.

The model file's protobuf is read field by field; from it come the normaliser (its compiled
character map, white-space rules and the metaspace marker), the vocabulary and scores, and
byte fallback.  Unigram models keep their scores; BPE models get merges, ranked by the score
of the piece they make.  Batches are encoded by the library's own threads.

If no piece holds a marker after another character, no segmentation crosses the start of a
word, and a text's tokens are those of its words one after the other.  Then only words not
met of late in a task are encoded, and each of them is compared with the reference encoder and
with what its tokens decode to: ``parity`` tells whether all words of a text agree, and
``round_trip`` whether all decode back.  For other models whole texts are encoded, compared
and decoded.

Defined cases: a null or empty text has no tokens and decodes to an empty text; characters
outside the vocabulary become bytes (or the unknown piece, which does not decode back); a
text that holds the marker itself, or that the normaliser changes, does not round-trip;
texts are encoded whole; repeated rows give equal results; other columns are untouched.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
# Piece types and model kinds as numbered by the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
# Words kept in a task: a bound on memory, not on what is encoded.
CACHE = 120_000
# Texts in a frame that goes back to Spark.
FRAME = 128
SCHEMA = "ids array<int>, parity boolean, round_trip boolean"


# ---- the model file ----------------------------------------------------------

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; nested messages come as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size
        elif wire == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            raise ValueError("not a SentencePiece model")


@dataclass
class PieceModel:
    """What the model file says."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    character_map: bytes = b""
    add_prefix: bool = True
    trim: bool = True
    escape: bool = True
    raw: bytes = b""

    @property
    def unknown(self) -> int:
        return self.types.index(UNKNOWN)

    @property
    def by_words(self) -> bool:
        """Whether no piece joins the end of a word to the start of the next."""
        return self.add_prefix and self.escape and not self.character_map and not any(
            re.search(f"[^{MARK}]{MARK}", p) for p, t in zip(self.pieces, self.types) if t == NORMAL)


def parse_model(raw: bytes) -> PieceModel:
    model = PieceModel(raw=raw)
    for number, value in _fields(raw):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append(piece)
            model.scores.append(score)
            model.types.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.character_map = v
                elif n == 3:
                    model.add_prefix = bool(v)
                elif n == 4:
                    model.trim = bool(v)
                elif n == 5:
                    model.escape = bool(v)
    if model.kind not in (UNIGRAM, BPE) or USER in model.types or UNKNOWN not in model.types:
        raise ValueError("only unigram and BPE models without user-defined pieces are supported")
    return model


def build_tokenizer(model: PieceModel):
    """The model as a ``tokenizers.Tokenizer``."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown,
                              model.byte_fallback)
    else:
        ids = {p: i for i, p in enumerate(model.pieces)}
        usable = {p for p, t in zip(model.pieces, model.types) if t == NORMAL}
        merges = []
        for piece in usable:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in usable and right in usable:
                    merges.append((-model.scores[ids[piece]], ids[left], ids[right], left, right))
        merges.sort()
        core = models.BPE(
            vocab=ids, merges=[m[3:] for m in merges], unk_token=model.pieces[model.unknown],
            fuse_unk=True, byte_fallback=model.byte_fallback,
            cache_capacity=0)  # texts and groups of words hardly ever come twice
    tokenizer = Tokenizer(core)
    steps = []
    if model.character_map:
        steps.append(normalizers.Precompiled(model.character_map))
    if model.trim:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    marker = MARK if model.escape else " "
    if model.add_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape:
        steps.append(normalizers.Replace(" ", marker))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(marker, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([decoders.Strip(" ", 1, 0)] if model.add_prefix else []),
    ])
    return tokenizer


def build_reference(model: PieceModel):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model.raw)


# ---- encoding ------------------------------------------------------------------

class Encoder:
    """Encodes lists of texts; keeps the words met of late."""

    def __init__(self, raw: bytes, threads: int = 1, cache: int = CACHE, check: bool = False):
        # Read by the library when it starts its threads.
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.threads, self.cache, self.check = threads, cache, check
        self.model = parse_model(raw)
        self.tokenizer = build_tokenizer(self.model)
        self.reference = build_reference(self.model)
        # Ids of the words held, which of them were met since some were last forgotten, which
        # the reference encodes in another way, and which do not decode back.
        self.words: dict[str, bytes] = {}
        self.met: set[str] = set()
        self.differing: set[str] = set()
        self.broken: set[str] = set()
        self.marked = np.array([p.startswith(MARK) for p in self.model.pieces])
        self.lone = self.tokenizer.token_to_id(MARK)
        self.by_words = self.model.by_words and not self.model.trim and self.lone is not None

    def _encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids and parity of whole texts, by the threads of both libraries."""
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        want = self.reference.encode(texts, num_threads=self.threads)
        return [(np.array(g.ids, dtype=np.int32), g.ids == w) for g, w in zip(got, want)]

    def _learn(self, fresh: list[str]) -> None:
        """Encode new words, each with its markers in front, many in one call."""
        # A word behind one marker starts with the only token that begins with a marker, so
        # such words can be encoded side by side and told apart afterwards.
        plain = [w for w in fresh if len(w) > 1 and w[1] != " "]
        groups = [plain[i:i + 64] for i in range(0, len(plain), 64)]
        rest = [w for w in fresh if len(w) > 1 and w[1] == " "]
        # The encoders put the first marker back, and decoding takes it away.
        for words, (ids, same, back) in zip(groups, self._checked(["".join(g)[1:] for g in groups])):
            starts = np.flatnonzero(self.marked[ids])
            if same and back is not False and len(starts) == len(words):
                data, ends = ids.tobytes(), [*(starts[1:] * 4).tolist(), 4 * len(ids)]
                self.words.update(
                    (w, data[i:j]) for w, i, j in zip(words, (starts * 4).tolist(), ends))
            else:
                rest += words
        for word, (ids, same, back) in zip(rest, self._checked([w[1:] for w in rest])):
            self.words[word] = ids.tobytes()
            if not same:
                self.differing.add(word)
            if back is False:
                self.broken.add(word)
        self.words[" "] = np.array([self.lone], dtype=np.int32).tobytes()

    def _checked(self, texts: list[str]) -> list[tuple[np.ndarray, bool, bool | None]]:
        """Ids, parity and, if it is to be checked, whether the ids decode back."""
        rows = self._encode(texts)
        if not self.check:
            return [(*r, None) for r in rows]
        return [(*r, x == y) for r, x, y in zip(rows, self.decode([r[0] for r in rows]), texts)]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, bool]]:
        """Ids and parity of every text."""
        return [r[:2] for r in self.checked(texts)]

    def checked(self, texts: list[str | None]) -> list[tuple[np.ndarray, bool, bool | None]]:
        """Ids, parity and round trip (null unless the encoder checks it) of every text."""
        texts = [t or "" for t in texts]
        if not self.by_words:
            return self._checked(texts)
        out = []
        for at in range(0, len(texts), 64):
            some = texts[at:at + 64]
            # A word is a run of markers and what follows; the text has one put before it.
            parts = [_WORD.findall(" " + t.replace(MARK, " ")) if t else [] for t in some]
            met = set().union(*parts)
            if len(self.met) + len(met) > self.cache // 2:
                # Forget what was not met since the last time.
                self.words = {w: self.words[w] for w in self.met}
                self.differing &= self.met
                self.broken &= self.met
                self.met = set()
            self._learn(list(met.difference(self.words)))
            self.met |= met
            known = self.words.__getitem__
            for t, p in zip(some, parts):
                # A marker of the text comes back as a blank.
                back = (MARK not in t and (not self.broken or self.broken.isdisjoint(p))
                        if self.check else None)
                out.append((np.frombuffer(b"".join(map(known, p)), dtype=np.int32),
                            not self.differing or self.differing.isdisjoint(p), back))
        return out

    def decode(self, ids: list[np.ndarray | None]) -> list[str]:
        out = []
        for at in range(0, len(ids), 64):
            lists = [[] if i is None else np.asarray(i).tolist() for i in ids[at:at + 64]]
            out += self.tokenizer.decode_batch(lists, skip_special_tokens=False)
        return out


_WORD = re.compile(r" +[^ ]*")


def _threads(df: DataFrame, threads: int | None) -> int:
    """Library threads of a task: as many cores as Spark gives it."""
    return threads or int(df.sparkSession.conf.get("spark.task.cpus", "1"))


def _model_bytes(path: str) -> bytes:
    """Read on the driver and sent with the function: executors need no file."""
    with open(path, "rb") as file:
        return file.read()


def _encoder(raw: bytes, threads: int, check: bool = False) -> Encoder:
    """One encoder for all tasks of a worker process, that of the last model used.

    Functions travel to the workers by value, with globals of their own in each task, so it
    is kept where the process keeps its modules.
    """
    held = sys.modules.setdefault("_textwarden_encoder", types.ModuleType("_textwarden_encoder"))
    name = hashlib.sha256(raw).hexdigest(), threads, check
    if getattr(held, "name", None) != name:
        held.name, held.encoder = None, None
        held.encoder = Encoder(raw, threads, check=check)
        held.name = name
    return held.encoder


def encode(docs: DataFrame, text: str = "text", out_col: str = "tokens",
           model_path: str = MODEL_PATH, threads: int | None = None,
           check: bool = False) -> DataFrame:
    """Add ``out_col``: token ids, whether the reference encoder agrees, and, with ``check``,
    whether the ids decode back to the text (otherwise null)."""
    raw, threads = _model_bytes(model_path), _threads(docs, threads)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(raw, threads, check)
        for series in batches:
            # Few texts' ids at a time; Spark takes smaller frames than it has sent.
            for at in range(0, len(series), FRAME):
                texts = [t if isinstance(t, str) else "" for t in series.iloc[at:at + FRAME]]
                rows = encoder.checked(texts)
                yield pd.DataFrame({
                    "ids": [r[0] for r in rows], "parity": [r[1] for r in rows],
                    "round_trip": pd.Series([r[2] for r in rows], dtype=object)})
            if not len(series):
                yield pd.DataFrame({"ids": [], "parity": [], "round_trip": []})

    return docs.withColumn(out_col, F.pandas_udf(run, SCHEMA).asNondeterministic()(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", out_col: str = "decoded",
           model_path: str = MODEL_PATH, threads: int | None = None) -> DataFrame:
    """Add the text of token ids; null lists decode to an empty text."""
    raw, threads = _model_bytes(model_path), _threads(df, threads)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(raw, threads)
        for series in batches:
            yield pd.Series(encoder.decode(list(series)), dtype=object)

    return df.withColumn(out_col, F.pandas_udf(run, "string").asNondeterministic()(F.col(ids)))


def op3_sentencepiece(spark, folder: str) -> DataFrame:
    """Tokens of every document: number, digest, parity, and whether they decode back."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return encode(docs, check=True).select(
        "doc_id",
        F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("tokens.ids", " "), 256).alias("ids_sha256"),
        "tokens.parity", "tokens.round_trip",
    )
