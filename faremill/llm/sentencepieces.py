"""SentencePiece models on the tokenizers library: encoding, decoding and parity.

The model file's protobuf is read here; its normaliser, space marker, piece scores (or, for byte-pair models, the
merges that the scores imply) and byte fallback become a tokenizer of the backend. Where no piece of the vocabulary
can span a place, a text falls into independent chunks there (before a run of space markers, around a character that
stands in no longer piece). Distinct chunks are encoded once per batch, many at a time on several threads, checked
against the sentencepiece library and decoded again; the ids of a text are put together from its chunks.
"""

from __future__ import annotations

import gc
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.store import KEEPERS, with_text_batches

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes that the chunks may take which a worker keeps between batches, and what one takes besides its text and ids.
KEPT_BYTES, CHUNK_BYTES = 48 << 20, 200
THREADS = 2

#: Appended to a model file, where protobuf merges it into the normaliser: no added prefix, no squeezing of spaces.
AS_CHUNKS = b"\x1a\x04\x18\x00\x20\x00"

ENCODED = "doc_id long, ids array<int>, n_tokens long, parity boolean, round_trip boolean"


@dataclass
class Model:
    """What a model file says about encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    suffix_space: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield number, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {wire} in a model file")


def parse_model(data: bytes) -> Model:
    """Reads the protobuf of a SentencePiece model; field numbers are those of its public schema."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode("utf-8"), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            model.suffix_space = bool(trainer.get(24, 0))
            model.unk_id = trainer.get(40, 0)
        elif number == 3:
            norm = dict(_fields(value))
            model.charsmap = norm.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = (bool(norm.get(n, 1)) for n in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and byte-pair models are supported")
    if model.suffix_space or any(kind in (USER_DEFINED, UNUSED) for _, _, kind in model.pieces):
        raise ValueError("suffix spaces, user-defined and unused pieces are not supported")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Merges of a byte-pair model, best first: every way to join two pieces to a piece, by the score of the result."""
    scores = {piece: score for piece, score, kind in model.pieces if kind == NORMAL}
    rank = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    found = [
        (-score, rank[piece[:cut]], rank[piece[cut:]], piece[:cut], piece[cut:])
        for piece, score in scores.items()
        for cut in range(1, len(piece))
        if piece[:cut] in scores and piece[cut:] in scores
    ]
    return [(left, right) for *_, left, right in sorted(found)]


def build(model: Model, whole_texts: bool):
    """The backend's tokenizer; for ``whole_texts`` with the normaliser and the removal of the leading space."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == BPE:
        vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
        unknown = model.pieces[model.unk_id][0]
        core = models.BPE(
            vocab=vocabulary, merges=merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        low = min(score for _, score, kind in model.pieces if kind == NORMAL) - 1e4
        scored = [(piece, score if kind in (NORMAL, BYTE) else low) for piece, score, kind in model.pieces]
        core = models.Unigram(scored, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        # Spaces alone: the library keeps line feeds at the ends.
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    back = [decoders.Replace(MARK, " ")] if model.escape else []
    if model.byte_fallback:
        back.append(decoders.ByteFallback())
    back.append(decoders.Fuse())
    if whole_texts:
        tokenizer.normalizer = normalizers.Sequence(steps)
        if model.dummy_prefix:
            back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer, normalizers.Sequence(steps)


def chunk_pattern(model: Model) -> re.Pattern | None:
    """Finds the chunks that can be encoded apart, or None where a piece may span any place."""
    longer = [piece for piece, _, kind in model.pieces if kind == NORMAL and len(piece) > 1]
    if not model.byte_fallback or not model.escape or any(MARK in piece.lstrip(MARK) for piece in longer):
        return None
    if any("\n" in piece for piece in longer):
        return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
    return re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


@lru_cache(maxsize=1)
def worker_codec(data: bytes, threads: int) -> Codec:
    """The codec of a worker process; tasks that follow one another there share it and the chunks it knows."""
    KEEPERS.append(forget_codec)
    return Codec(data, threads)


def forget_codec() -> None:
    """Drops the codec of this worker process, some 100 MB with the chunks it knows."""
    worker_codec.cache_clear()
    KEEPERS.remove(forget_codec)


class Codec:
    """Encodes batches of texts; remembers chunks it has met, up to KEPT_BYTES."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece

        model = parse_model(data)
        self.backend, self.normalizer = build(model, whole_texts=False)
        self.pattern, self.escape, self.threads = chunk_pattern(model), model.escape, threads
        self.plain = not model.charsmap and not model.squeeze
        self.prefix = (MARK if model.escape else " ") if model.dummy_prefix else ""
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data + AS_CHUNKS)
        self.bytes = piece_bytes(model)
        self.byte_lengths = np.array([len(piece) for piece in self.bytes])
        self.places: dict[str, int] = {}
        self.values, self.sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        self.same, self.back = [np.zeros(0, bool)], [np.zeros(0, bool)]
        self.uses = np.zeros(0, np.int64)
        self.kept = 0

    def _forget_rare(self) -> None:
        """Keeps the chunks of the most uses, up to half of KEPT_BYTES; their uses count half from now on."""
        sizes = self.sizes[0]
        lengths = np.fromiter(map(len, self.places), np.int64, len(self.places))
        cost = CHUNK_BYTES + lengths + 4 * sizes
        order = np.argsort(-self.uses, kind="stable")
        order = np.sort(order[np.cumsum(cost[order]) <= KEPT_BYTES // 2])
        stays = np.zeros(len(lengths), bool)
        stays[order] = True
        self.places = {chunk: i for i, chunk in enumerate(compress(self.places, stays.tolist()))}
        self.values = [self.values[0][np.repeat(stays, sizes)]]
        self.sizes, self.same, self.back = ([parts[0][stays]] for parts in (self.sizes, self.same, self.back))
        self.uses, self.kept = self.uses[stays] // 2, int(cost[stays].sum())

    def normal(self, text: str) -> str:
        """The text as the model sees it."""
        if self.plain:
            return (self.prefix + (text.replace(" ", MARK) if self.escape else text)) if text else ""
        return self.normalizer.normalize_str(text)

    def _learn(self, fresh: list[str]) -> None:
        found = [e.ids for e in self.backend.encode_batch_fast(fresh, add_special_tokens=False)]
        expected = self.other.encode(fresh, num_threads=self.threads)
        values = np.array(list(chain.from_iterable(found)), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.values.append(values)
        self.sizes.append(sizes)
        self.same.append(np.fromiter(map(list.__eq__, found, expected), bool, len(found)))
        plain = [(chunk.replace(MARK, " ") if self.escape else chunk).encode("utf-8") for chunk in fresh]
        lengths = np.concatenate([[0], np.cumsum(self.byte_lengths[values])])
        ends = np.cumsum(sizes)
        spans = lengths[ends] - lengths[ends - sizes]
        cut_alike = (spans == np.fromiter(map(len, plain), np.int64, len(plain))).all()
        if cut_alike and b"".join(plain) == b"".join(map(self.bytes.__getitem__, values.tolist())):
            self.back.append(np.ones(len(fresh), bool))
        else:
            text_of = self.bytes.__getitem__
            self.back.append(np.array([b"".join(map(text_of, ids)) == own for ids, own in zip(found, plain)]))
        self.kept += CHUNK_BYTES * len(fresh) + sum(map(len, fresh)) + 4 * int(self.sizes[-1].sum())

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool, bool]]:
        """Ids, parity with the sentencepiece library and success of decoding, of every text.

        Parity is of whole texts: the rebuilt normaliser gives what the unmodified library's does, and every chunk of
        it has the library's ids; chunks are cut where no piece can span.
        """
        if self.kept > KEPT_BYTES:
            self._forget_rare()
        normal = [self.normal(text) for text in texts]
        agreed = map(str.__eq__, normal, self.library.normalize(texts) if texts else [])
        cut = self.pattern.findall if self.pattern else lambda text: [text] if text else []
        chunks = [cut(text) for text in normal]
        fresh = [chunk for chunk in dict.fromkeys(chain.from_iterable(chunks)) if chunk not in self.places]
        self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh))))
        if fresh:
            self._learn(fresh)
        self.values, self.sizes = [np.concatenate(self.values)], [np.concatenate(self.sizes)]
        self.same, self.back = [np.concatenate(self.same)], [np.concatenate(self.back)]
        values, sizes, same, back = self.values[0], self.sizes[0], self.same[0], self.back[0]
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes) - len(self.uses), np.int64)])
        begin = np.cumsum(sizes) - sizes
        place = self.places.__getitem__
        for found, alike in zip(chunks, list(agreed)):
            row = np.fromiter(map(place, found), np.int64, len(found))
            np.add.at(self.uses, row, 1)
            size = sizes[row]
            ends = np.cumsum(size)
            steps = np.arange(ends[-1] if len(ends) else 0)
            ids = values[steps + np.repeat(begin[row] - ends + size, size)]
            yield ids, alike and bool(same[row].all()), bool(back[row].all())


def piece_bytes(model: Model) -> list[bytes]:
    """The UTF-8 bytes that every id decodes to."""
    space = " " if model.escape else MARK
    return [
        bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, space).encode("utf-8")
        for piece, _, kind in model.pieces
    ]


def encoded(docs: DataFrame, model: bytes, threads: int = THREADS, texts_at_once: int = 1 << 19) -> DataFrame:
    """doc_id, ids, n_tokens, parity and round_trip of every row of ``docs`` (doc_id, text).

    ``model`` is the content of a SentencePiece model file; it is broadcast, so executors need no file. parity: the normalised text and the
    ids of its chunks equal those of the sentencepiece library. round_trip: the decoded ids are the normalised text. A null
    or empty text has no ids, and both hold. Whole texts are encoded, whatever their length; ``texts_at_once`` is
    the number of characters that a task works on at a time. Repeated rows are encoded each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        codec = worker_codec(shared.value, threads)
        gc.disable()  # millions of small lists, none in a cycle, would be searched again and again
        try:
            for batch in batches:
                yield from encode(codec, batch.column(0).to_pylist(), batch.column(1).to_pylist())
        finally:
            gc.enable()

    def encode(codec, ids, texts):
        begin = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= texts_at_once or i == len(texts) - 1:
                yield _rows(ids[begin : i + 1], list(codec.encode([t or "" for t in texts[begin : i + 1]])))
                begin, size = i + 1, 0

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_text_batches(rows).mapInArrow(work, ENCODED)


def _rows(doc_ids: list, found: list[tuple[np.ndarray, bool, bool]]) -> pa.RecordBatch:
    ids, parity, back = zip(*found)
    sizes = np.array([len(x) for x in ids], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
    columns = [pa.array(doc_ids, pa.int64()), lists, pa.array(sizes), pa.array(parity), pa.array(back)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "parity", "round_trip"])


def decoded(tokens: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text of every row of ``tokens`` (doc_id, ids).

    Null and empty ids give an empty text; bytes that are no UTF-8 become replacement characters.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        backend, _ = build(parse_model(shared.value), whole_texts=True)
        for batch in batches:
            texts = backend.decode_batch([ids or [] for ids in batch.column(1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return with_text_batches(tokens.select(F.col("doc_id").cast("long"), "ids")).mapInArrow(work, "doc_id long, text string")
