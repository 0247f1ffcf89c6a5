"""Packing by power-of-two decomposition.

A document of n tokens is cut into ``n // size`` pieces of the full length and
then into the binary digits of the rest, longest first, so every piece is a
power of two long and is a sequence of its own: no sequence crosses documents
and none is padded. Pieces of equal length share a bucket; ``write_buckets``
stores one folder a bucket, from which a trainer draws batches of equal length.

Rows: a null or empty text is the end id alone, one piece of length 1; equal
rows are packed each by itself; a text of any length is cut whole; extra
columns don't matter (``docs`` is narrowed to its key and text); an empty table
gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import blocks, bound_arrow, tokenizer_path

#: Words and parts of words whose ids a worker remembers; the memory is cleared when full.
REMEMBERED_WORDS = 700_000


class WordIds(dict):
    """Ids of the chunks between ASCII white space, as little-endian bytes.

    The vocabulary's normaliser and pre-tokenizer drop white space and never
    look across it, so a text's ids are those of its chunks in order. Latin
    chunks go straight to the tokenizer's model, as its normaliser leaves them
    (lower case); all others take the tokenizer's whole way.
    """

    #: Printable ASCII and Latin letters: one code point each under lower-casing and NFC.
    latin = re.compile("[!-~\u00a1-\u012f\u0131-\u017e]+")
    #: The vocabulary's pre-token pattern.
    pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize, self.plain = self.tokenizer.model.tokenize, self.latin.fullmatch
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.letters = dict(enumerate(byte_letters()))
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def tokens(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(shown)])

    def piece(self, piece: str) -> bytes:
        key = piece.encode()
        return self[key] if piece.isalpha() else self.get(key) or self.tokens(piece)

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        lower = text.lower()
        if not self.plain(text):
            ids = self.whole(text)
        elif lower.isalpha():                                   # other forms share the ids of the lower-case word
            ids = self.tokens(lower) if lower == text else self[lower.encode()]
        elif lower[:-1].isalpha() and not lower[-1].isalnum():  # a word and one mark
            ids = self[lower[:-1].encode()] + self.piece(lower[-1])
        elif "<" in text and any(s in text for s in self.specials):
            ids = self.whole(text)
        else:
            ids = b"".join(map(self.piece, self.pieces.findall(lower)))
        self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > REMEMBERED_WORDS:
            self.clear()


@lru_cache(maxsize=2)
def word_ids(name: str) -> WordIds:
    return WordIds(name if "/" in name else tokenizer_path(name))


def piece_lengths(n: int, size: int) -> list[int]:
    """Full pieces, then the binary digits of the rest, longest first."""
    rest = n % size
    return [size] * (n // size) + [1 << k for k in range(size.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, size: int = 2048, end_id: int = 1, vocabulary: str = "word_bpe_49k.json", key: str = "doc_id",
         text: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """One row a piece: key, start, length, ids (array of int), doc_tokens, bucket (log2 of the length), sequence_id, offset.

    ``size`` must be a power of two. A piece is a whole sequence, so offset is
    0. ``sequence_id`` is unique; it numbers pieces within their partition, so
    the cut needs no shuffle at all.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    bound_arrow(docs.sparkSession)
    docs = docs.select(key, text)
    schema = docs.select(key, *[F.lit(0).cast("long").alias(c) for c in ("start", "length", "ids_crc32", "doc_tokens")],
                         F.lit(0).alias("bucket"), F.lit(None).cast("array<int>").alias("ids")).schema

    def run(batches):
        known = word_ids(vocabulary)
        last = int(end_id).to_bytes(4, "little")
        for t in blocks(batches, text, block_bytes):
            texts = t.column(text)
            for i in range(0, len(texts), 64):                  # a text's words are many times its size: few texts at a time
                known.trim()
                split = [(x or "").encode().split() for x in texts[i:i + 64].to_pylist()]
                rows, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
                for j, words in enumerate(split, i):
                    raw = b"".join(map(known.__getitem__, words)) + last
                    at, n = 0, len(raw) // 4
                    for length in piece_lengths(n, size):
                        piece = raw[4 * at:4 * (at + length)]
                        rows.append(j)
                        starts.append(at)
                        lengths.append(length)
                        crcs.append(zlib.crc32(piece))
                        totals.append(n)
                        ids.append(piece)
                        at += length
                flat = np.frombuffer(b"".join(ids), dtype="<i4")
                offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [t.column(key).take(pa.array(rows, pa.int64())).combine_chunks(), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(totals, pa.int64()),
                     pa.array([x.bit_length() - 1 for x in lengths], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=[key, "start", "length", "ids_crc32", "doc_tokens", "bucket", "ids"])

    return (docs.mapInArrow(run, schema)
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the sequences with one folder a length, each row a whole sequence."""
    pieces.write.partitionBy("bucket").parquet(path)
