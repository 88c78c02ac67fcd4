"""Packing without padding: each document is cut into power-of-two pieces.

A document's tokens (ids, then the end id) are cut along the binary form of its
length: whole pieces of ``longest`` tokens first, then one piece for each set bit
of the rest, longest first.  Pieces of equal length form one bucket; a piece is a
sequence by itself, so no sequence crosses documents and none needs padding.

Defined results: null text counts as empty (one piece that holds the end id);
repeated rows are packed once for each row, as sequences of their own; an empty
table gives an empty result; other columns of the input are ignored.  Long texts
stay whole in one task, cut only into pieces.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import arrow_schema, slices, text_of, written

LONGEST = 2048
END_ID = 1
CACHED_WORDS = 500_000

#: Fixed value: the tokenizer file's own split pattern.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Characters whose normal form and lower case need no tables: up to U+024F, dotted capital I apart.
PLAIN = re.compile("[\x21-\x7eÀ-įı-ɏ]+")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in kept:
            letters[b] = chr(b)
        else:
            letters[b] = chr(extra)
            extra += 1
    return letters


class WordIds(dict):
    """Word without white space -> its ids as bytes, by the tokenizer itself.

    Words that the file's pipeline treats plainly are split here and each part is
    given to the tokenizer's model; any other word goes through the whole pipeline.
    """

    def __init__(self, path: str):
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.letters = byte_letters()

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            if not text.isascii():
                mapped = "".join([self.letters[b] for b in text.encode()])
            else:
                mapped = text
            found = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(self.parts) >= CACHED_WORDS:
                self.parts.clear()
            self.parts[text] = found
        return found

    def __missing__(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and "<|" not in word:
            found = b"".join([self.part(p) for p in SPLIT.findall(word.lower())])
        else:
            found = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
            self[""] = b""
        self[word] = found
        return found

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        return b"".join([self[w] for w in text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")])


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Whole pieces of ``longest``, then the powers of two of the rest, falling."""
    lengths = [longest] * (n // longest)
    rest, bit = n % longest, longest >> 1
    while bit:
        if rest & bit:
            lengths.append(bit)
        bit >>= 1
    return lengths


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "part int, place long")


def cut_pieces(path: str, longest: int, end_id: int):
    out = arrow_schema(PIECES)
    end = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordIds(path), TaskContext.get().partitionId()
        places: dict[int, int] = {}
        for batch in slices(batches, 4 << 20):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = memoryview(words.ids(text) + end)
                total, start = len(data) // 4, 0
                for length in binary_lengths(total, longest):
                    place = places.get(length, 0)
                    places[length] = place + 1
                    rows.append((doc_id, start, length, zlib.crc32(data[4 * start:4 * (start + length)]),
                                 total, part, place))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return cut


def pack(documents: DataFrame, tokenizer_path: str, longest: int = LONGEST,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences are numbered without gaps, bucket by bucket.  The pieces are written
    once with their place in (task, bucket); the numbers follow from a table of counts,
    a row for each task and bucket.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    pieces = written(docs.mapInArrow(cut_pieces(tokenizer_path, longest, end_id), PIECES), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    buckets = (counts.groupBy("length").agg(F.sum("n").alias("total"))
               .select("length", (F.sum("total").over(Window.orderBy("length")) - F.col("total")).alias("base")))
    running = Window.partitionBy("length").orderBy("part")
    # At most log2(longest) + 1 buckets: a dozen rows.
    firsts = (counts.select("length", "part", (F.sum("n").over(running) - F.col("n")).alias("before"))
              .join(F.broadcast(buckets), "length")
              .select("length", "part", (F.col("base") + F.col("before")).alias("first")))
    return (pieces.join(firsts, ["length", "part"])
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("first") + F.col("place")).alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset")))
