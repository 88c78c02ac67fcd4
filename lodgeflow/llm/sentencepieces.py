"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is read field by field.  Normaliser, space marker, piece scores
(unigram) or merges (BPE) and byte fallback are rebuilt as a tokenizer of the tokenizers
library, which encodes batches in several threads.  Every text's ids are compared with
sentencepiece's own.

Where no piece has a space marker after another character, a text falls apart in front of
its markers, and where no piece has a line break, at line breaks; each different part
is encoded once in a task.

Defined results: null and empty texts have no ids; repeated rows are encoded one by one; an
empty table gives an empty result; other columns are ignored.  Long texts are encoded
whole.  Decoding gives back the text unless the normaliser changes it or it holds the
marker character itself.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

from .common import arrow_schema, slices, text_of

MARK = "▁"
THREADS = 2
CACHED_PARTS = 400_000
#: Words that are encoded in one call of the tokenizer.
JOINED = 64

#: Types of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


class Piece(NamedTuple):
    text: str
    score: float
    type: int


class Model(NamedTuple):
    pieces: list[Piece]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    escape: bool


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of one protobuf message."""
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
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}[wire] if wire in (1, 5) else varint()
            yield number, data[at:at + size]
            at += size


def parse_model(data: bytes) -> Model:
    """Field numbers are those of the public sentencepiece_model.proto."""
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            own = dict(fields(value))
            pieces.append(Piece(own.get(1, b"").decode(), struct.unpack("<f", own.get(2, bytes(4)))[0],
                                own.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    return Model(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normalizer.get(2, b""),
                 bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)))


def merges_of(pieces: list[Piece]) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best piece first."""
    known = {p.text for p in pieces if p.type in (NORMAL, USER, UNUSED)}
    ranked = sorted((p for p in pieces if p.type == NORMAL), key=lambda p: -p.score)
    return [(p.text[:k], p.text[k:]) for p in ranked for k in range(1, len(p.text))
            if p.text[:k] in known and p.text[k:] in known]


def normalizer_of(model: Model) -> normalizers.Normalizer | None:
    steps: list[normalizers.Normalizer] = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps) if steps else None


def rebuilt(model: Model) -> Tokenizer:
    """The model as a tokenizer of the tokenizers library."""
    unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), None)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p.text, p.score) for p in model.pieces], unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE({p.text: i for i, p in enumerate(model.pieces)}, merges_of(model.pieces),
                          unk_token=None if unknown is None else model.pieces[unknown].text,
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"models of type {model.kind} are not unigram or BPE")
    made = Tokenizer(core)
    normalizer = normalizer_of(model)
    if normalizer:
        made.normalizer = normalizer
    own = [AddedToken(p.text, normalized=True) for p in model.pieces if p.type == USER]
    if own:
        made.add_tokens(own)
    steps: list[decoders.Decoder] = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    made.decoder = decoders.Sequence(steps)
    return made


class Codec:
    """Encodes texts by their different parts and decodes ids."""

    def __init__(self, data: bytes):
        self.model = parse_model(data)
        #: Without normaliser, for parts that are normal already.
        self.bare = rebuilt(self.model)
        self.bare.normalizer = normalizers.Sequence([])
        #: What each id decodes to inside a text; None where bytes have to be put together.
        self.plain_text = [None if p.type == BYTE else p.text.replace(MARK, " ") for p in self.model.pieces]
        self.leads = np.array([p.text.startswith(MARK) for p in self.model.pieces])
        texts = [p.text for p in self.model.pieces if p.type in (NORMAL, USER)]
        apart = not any(re.search(f"[^{MARK}]{MARK}", t) for t in texts)
        breaks = self.model.byte_fallback and not any("\n" in t for t in texts)
        self.cut = re.compile("(?s:.+)" if not apart else rf"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if breaks
                              else rf"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.plain = not self.model.charsmap and not self.model.squeeze and self.model.escape
        #: Whether words between single spaces are encoded alone, with a marker in front.
        self.by_word = apart and self.plain and self.model.dummy_prefix
        self.ids: dict[str, bytes] = {}
        #: What parts decode to; of words alone only those that do not come back, with a space in front.
        self.back: dict[str, str] = {}

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return rebuilt(self.model)

    def normal(self, text: str) -> str:
        if not self.plain:
            return self.tokenizer.normalizer.normalize_str(text) if text and self.tokenizer.normalizer else text
        text = text.replace(" ", MARK)
        return MARK + text if text and self.model.dummy_prefix else text

    def parts(self, text: str) -> list[str]:
        """Normal parts that are encoded alone; they join to the normal text."""
        if self.by_word and "  " not in text and MARK not in text and text.strip(" ") == text:
            return text.split(" ") if text else []
        return [MARK + p for p in self.cut.findall(self.normal(text))]

    def joined_ids(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word with a marker in front.  Words are encoded by the joined text of many, and fall
        apart at the pieces that begin with a marker; where that gives another number of words,
        each is encoded alone."""
        groups = [words[k:k + JOINED] for k in range(0, len(words), JOINED)]
        made = self.bare.encode_batch_fast([MARK + MARK.join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, made):
            ids = encoding.ids
            starts = np.flatnonzero(self.leads[ids]).tolist()
            if len(starts) == len(group) and starts[0] == 0:
                for a, b in zip(starts, [*starts[1:], len(ids)]):
                    yield ids[a:b]
            else:
                alone = self.bare.encode_batch_fast([MARK + w for w in group], add_special_tokens=False)
                yield from (e.ids for e in alone)

    def learn(self, cut: list[list[str]]) -> None:
        """Encodes and decodes the parts not met before, in multithreaded batches.

        A word is kept as itself and encoded with a marker in front; any other part is kept
        with one marker more.
        """
        if len(self.ids) > CACHED_PARTS:
            self.ids, self.back = {}, {}
        new = set().union(*cut).difference(self.ids)
        words = [p for p in new if p[0] != MARK]
        others = [p for p in new if p[0] == MARK]
        made = self.bare.encode_batch_fast([p[1:] for p in others], add_special_tokens=False)
        plain = self.plain_text.__getitem__
        hard: list[tuple[str, list[int]]] = [(p, e.ids) for p, e in zip(others, made)]
        for part, ids in hard:
            self.ids[part] = array("I", ids).tobytes()
        for word, ids in zip(words, self.joined_ids(words)):
            self.ids[word] = array("I", ids).tobytes()
            try:
                if "".join(map(plain, ids)) != " " + word:
                    hard.append((word, ids))
            except TypeError:
                hard.append((word, ids))
        decoded = self.bare.decode_batch([ids for _, ids in hard], skip_special_tokens=False)
        for (part, _), text in zip(hard, decoded):
            # The decoder takes one space off the front of a text; inside a text it stays.
            word = part[0] != MARK
            back = " " + text if (word or part[1:2] == MARK) and self.model.dummy_prefix else text
            if not word or back != " " + part:
                self.back[part] = back

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self.parts(t) for t in texts]
        self.learn(cut)
        return [b"".join(map(self.ids.__getitem__, parts)) for parts in cut]

    def there_and_back(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids of each text, and the text that they decode to."""
        cut = [self.parts(t) for t in texts]
        self.learn(cut)
        lead = 1 if self.model.dummy_prefix else 0
        ids, back = self.ids.__getitem__, self.back
        return [(b"".join(map(ids, parts)),
                 text if parts and parts[0][0] != MARK and back.keys().isdisjoint(parts)
                 else "".join([back[p] if p in back else " " + p for p in parts])[lead:])
                for text, parts in zip(texts, cut)]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.bare.decode_batch([array("I", i).tolist() for i in ids], skip_special_tokens=False)


OUT = "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"


def coded(data: bytes, threads: int, with_ids: bool):
    out = arrow_schema(OUT + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        codec = Codec(data)
        own = sentencepiece.SentencePieceProcessor(model_proto=data)
        for batch in slices(batches, 4 << 20):
            texts = batch.column(1).to_pylist()
            ids, back = zip(*codec.there_and_back(texts))
            theirs = own.encode(texts, num_threads=threads)
            columns = [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                       pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                       pa.array([array("I", t).tobytes() == i for t, i in zip(theirs, ids)]),
                       pa.array([b == t for b, t in zip(back, texts)])]
            if with_ids:
                columns.append(pa.array([array("i", i).tolist() for i in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return run


def encode_documents(documents: DataFrame, model_path: str, threads: int = THREADS,
                     with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids),
    parity (the ids are sentencepiece's), round_trip (decoding gives the text back)."""
    with open(model_path, "rb") as file:
        data = file.read()
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return docs.mapInArrow(coded(data, threads, with_ids), OUT + (", ids array<int>" if with_ids else ""))
