"""BPE encoding and decoding with a pair occurrence index.

A block of texts (bounded bytes of one partition) is cut into pre-tokens by
the vocabulary's pattern, and each different pre-token is laid out once in one
array of symbols. An index maps each adjacent pair that the vocabulary can
merge to all its positions in the block. Active ranks are applied in ascending
order; one application merges every live position of its pair at once and
adds the two pairs it creates at each place to their lists. Stale positions are
recognised when their list comes up. This equals the usual word by word
merging because a merge's result can only take part in merges of higher rank,
which is checked when the vocabulary is loaded.

Rows: a null text counts as empty and gives no ids; empty texts give an empty
list; repeated rows and ties are encoded each by itself; extra columns pass
through ``encode``/``decode`` untouched; an empty table gives an empty table.
Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, bound_arrow, tokenizer_path

#: The byte-level pre-token pattern of the public vocabulary (white space spelt out).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = count(256)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class PairIndexBpe:
    """A byte-level BPE vocabulary: ``encode`` texts to ids and ``decode`` ids to text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        back = {c: bytes([b]) for b, c in enumerate(letters)}
        self.token_bytes = {i: b"".join(map(back.__getitem__, t)) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.size = 1 + max(self.token_bytes)
        born = np.full(self.size, -1, dtype=np.int64)
        born[self.made] = np.arange(len(pairs))
        if len(set(self.made.tolist())) != len(pairs) or (np.maximum(born[self.left], born[self.right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge's result takes part in a merge of lower rank; ranks can't be applied in ascending order")
        code = self.left * self.size + self.right
        self.code_rank = np.argsort(code, kind="stable")
        self.codes = code[self.code_rank]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(PATTERN)

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text; special tokens stand alone."""
        if not self.split or not self.split.search(text):
            return self.words.findall(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += self.words.findall(text, at, m.start())
            out.append(m[0])
            at = m.end()
        return out + self.words.findall(text, at)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the vocabulary has no such merge."""
        code = a * np.int64(self.size) + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_rank[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after all merges, and each word's offset into them (one more at the end)."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(words) else 0
        sym = np.empty(n + 1, dtype=np.int32)
        sym[:n] = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        sym[n] = -1                                     # nothing pairs with it
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        starts = ends - lengths
        after[ends[lengths > 0] - 1] = n                # words end: no pair crosses
        before[starts[lengths > 0]] = n
        after[n] = before[n] = n
        alive = np.ones(n + 1, dtype=bool)

        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enlist(at: np.ndarray) -> None:
            """Add the pairs that begin at these places to the index."""
            if not len(at):
                return
            b = sym[after[at]]
            at, b = at[b >= 0], b[b >= 0]
            rank = self.rank_of(sym[at].astype(np.int64), b)
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate(([0], cut))].tolist(), np.split(at, cut)):
                if r in lists:
                    lists[r].append(part)
                else:
                    lists[r] = [part]
                    heapq.heappush(active, r)

        enlist(np.arange(n, dtype=np.int32))
        while active:
            r = heapq.heappop(active)
            parts = lists.pop(r)
            at = np.unique(np.concatenate(parts))
            a, b = self.left[r], self.right[r]
            at = at[alive[at] & (sym[at] == a) & (sym[after[at]] == b)]
            if not len(at):
                continue
            if a == b and len(at) > 1:                  # runs of one symbol: leftmost first, no overlap
                new = np.concatenate(([True], after[at[:-1]] != at[1:]))
                head = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - head) % 2 == 0]
            gone = after[at]
            sym[at] = self.made[r]
            alive[gone] = False
            sym[gone] = -2
            after[at] = after[gone]
            beyond = after[at]
            before[beyond[beyond < n]] = at[beyond < n]
            prior = before[at]
            prior = prior[prior < n]
            enlist(np.concatenate((prior, at)) if len(prior) else at)
        keep = alive[:n]
        total = np.concatenate(([0], np.cumsum(keep)))
        return sym[:n][keep], total[np.concatenate((starts, [n]))] if len(words) else np.zeros(1, dtype=np.int64)

    def encode_block(self, texts: list[str]):
        """Per text an array of word numbers, and per word its ids: (numbers, ids, offsets)."""
        number = defaultdict(count().__next__)
        numbers = [np.fromiter(map(number.__getitem__, self.pre_tokens(t)), dtype=np.int32) for t in texts]
        words = [b"" if w in self.special else w.encode() for w in number]
        ids, offsets = self.merge(words)
        fixed = {i: self.special[w] for i, w in enumerate(number) if w in self.special}
        return numbers, ids, offsets, fixed

    def word_ids(self, ids: np.ndarray, offsets: np.ndarray, fixed: dict[int, int]) -> list[list[int]]:
        flat, at = ids.tolist(), offsets.tolist()
        out = [flat[a:b] for a, b in zip(at, at[1:])]
        for i, special in fixed.items():
            out[i] = [special]
        return out

    def decode(self, ids) -> str:
        """The text of a list of ids, special tokens kept; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(name: str) -> PairIndexBpe:
    """One vocabulary a worker, by file name of the public tokenizers or by path."""
    return PairIndexBpe(name if "/" in name else tokenizer_path(name))


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", text: str = "text", ids: str = "ids",
           block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with the token ids of ``text`` in a column ``ids`` (array of int), which replaces one of that name."""
    bound_arrow(docs.sparkSession)
    docs = docs.drop(ids)
    schema = docs.select("*", F.lit(None).cast("array<int>").alias(ids)).schema

    def run(batches):
        bpe = load(vocabulary)
        for t in blocks(batches, text, block_bytes):
            numbers, flat, offsets, fixed = bpe.encode_block([x or "" for x in t.column(text).to_pylist()])
            per_word = bpe.word_ids(flat, offsets, fixed)
            out = [[i for w in doc.tolist() for i in per_word[w]] for doc in numbers]
            yield from t.append_column(ids, pa.array(out, pa.list_(pa.int32()))).to_batches()

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in a column that replaces one of that name; null ids decode to the empty text."""
    bound_arrow(docs.sparkSession)
    docs = docs.drop(text)
    schema = docs.select("*", F.lit(None).cast("string").alias(text)).schema

    def run(batches):
        bpe = load(vocabulary)
        for b in batches:
            out = pa.array([bpe.decode(x or []) for x in b.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, text])

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, key: str = "doc_id", vocabulary: str = "byte_bpe_50k.json", text: str = "text",
            block_bytes: int = 8 << 20) -> DataFrame:
    """Encode, decode again, and return only counts and digests: what a check of a whole corpus needs.

    One pass, so that the ids of a large corpus needn't be moved out of the
    workers: ``key``, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 (the decoded text in UTF-8).
    """
    bound_arrow(docs.sparkSession)
    docs = docs.select(key, text)
    schema = docs.select(key, F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"),
                         F.lit("").alias("decoded_sha256")).schema

    def run(batches):
        bpe = load(vocabulary)
        for t in blocks(batches, text, block_bytes):
            numbers, flat, offsets, fixed = bpe.encode_block([x or "" for x in t.column(text).to_pylist()])
            per_word = bpe.word_ids(flat, offsets, fixed)
            lengths = np.fromiter(map(len, per_word), dtype=np.int64, count=len(per_word))
            commas = [",".join(map(str, w)) for w in per_word]
            raw = [b"".join(map(bpe.token_bytes.__getitem__, w)) for w in per_word]
            n, ids, decoded = [], [], []
            for doc in numbers:
                at = doc.tolist()
                n.append(int(lengths[doc].sum()))
                ids.append(hashlib.sha256(",".join(map(commas.__getitem__, at)).encode()).hexdigest())
                back = b"".join(map(raw.__getitem__, at)).decode("utf-8", "replace")
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield from pa.table({key: t.column(key), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": ids,
                                 "decoded_sha256": decoded}).to_batches()

    return docs.mapInArrow(run, schema)
