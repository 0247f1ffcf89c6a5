"""Toxic spans by a linear-chain conditional random field.

Labels say whether a whole document is toxic. ``fit`` turns them into labelled
tokens and trains the field on those:

1. Over all labelled documents, every feature of a word (the word itself and its first
   three to seven letters) is counted by documents, toxic and clean. Features far
   more frequent in toxic documents (a log-likelihood ratio of ``EVIDENCE`` or more)
   make the lexicon, as far as the sample below has them: others couldn't get a weight.
2. In toxic documents the words with a lexicon feature are labelled toxic,
   all others and all words of clean documents not. The field (weights of lexicon
   features, a bias, four transitions) is trained by gradient ascent on a bounded
   sample, the ``sample`` labelled documents of each class with the smallest
   hashes among those of at most ``sample_chars`` characters.
3. Forward-backward marginals of a document's words are aggregated (expected
   number of toxic words, highest marginal, share of words more likely toxic
   than not), and a logistic regression on these, weighted to the classes'
   true shares, gives the score.

``score`` tags every word of every whole text. The chain of a block of documents
is computed at once, by products of 2 x 2 matrices over chunks of it; documents
meet there in matrices that forget what came before. Only words count: language,
source and key are no inputs.

Rows: a null text counts as empty; empty texts get the score of no toxic word
at all; a document with several labels is toxic if one is; labels without a
document and null labels are ignored: they change no share, no weight and not the sample;
rows that share a key count each, and one text of a key is trained on; repeated rows get the same score each; a null key is scored,
but never held out nor learned from; extra columns are ignored; an empty table gives an
empty table, and without labels of both classes nothing can be learned: every
score is the share of toxic ones among the labelled documents (0 without any). The same holds where no
labelled document of a class has ``sample_chars`` characters or fewer.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StringType, StructField, StructType

from .common import blocks, bound_arrow, materialise

#: Log-likelihood ratio of a lexicon feature, at least: chance reaches it about once in two million features.
EVIDENCE = 25.0
#: Letters of the beginnings that are features of a word.
PREFIXES = range(3, 8)
#: Labelled documents of each class that the field is trained on at most, and their longest text.
SAMPLE, SAMPLE_CHARS = 500, 20_000
WORDS = re.compile(r"[^\W_]+")


def word_features(word: str) -> tuple[str, ...]:
    """A lower-case word's features: itself, and what it begins with (``begin-``)."""
    return (word, *[word[:n] + "-" for n in PREFIXES if n < len(word)])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def scan(emit: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Forward-backward over one long chain of words; returns (marginal of state 1, expected transitions 2 x 2, expected starts).

    ``emit`` is the score of state 1 over state 0 at each word, ``start`` says
    where documents begin, ``trans`` has rows 0 and 1 for the transitions and
    row 2 for starts (log potentials). A word's matrix holds the transitions into
    it times its emission; at a document's start both rows are the start's.
    """
    n = len(emit)
    if not n:
        return np.empty(0), np.zeros((2, 2)), np.zeros(2)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    pad = rows * width - n
    e = np.exp(np.clip(emit, -30, 30))
    t = np.exp(trans)
    m = np.empty((2, 2, n + pad))
    for i in range(2):
        for j in range(2):
            m[i, j, :n] = np.where(start, t[2, j], t[i, j]) * (e if j else 1.0)
            m[i, j, n:] = float(i == j)
    m = np.ascontiguousarray(m.reshape(2, 2, rows, width).transpose(3, 0, 1, 2))      # step, from, to, chunk

    prod = np.empty((2, 2, rows))
    prod[:] = np.eye(2)[:, :, None]
    for k in range(width):
        a = m[k]
        prod = np.stack([np.stack([prod[i, 0] * a[0, j] + prod[i, 1] * a[1, j] for j in range(2)]) for i in range(2)])
        prod /= prod.sum((0, 1))
    into, out = np.empty((2, rows)), np.empty((2, rows))
    f0 = f1 = 0.5
    chunks = prod.transpose(2, 0, 1).tolist()
    for c, ((p00, p01), (p10, p11)) in enumerate(chunks):
        into[:, c] = f0, f1
        f0, f1 = f0 * p00 + f1 * p10, f0 * p01 + f1 * p11
        f0, f1 = f0 / (f0 + f1), f1 / (f0 + f1)
    b0 = b1 = 0.5
    for c in range(rows - 1, -1, -1):
        (p00, p01), (p10, p11) = chunks[c]
        out[:, c] = b0, b1
        b0, b1 = p00 * b0 + p01 * b1, p10 * b0 + p11 * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    fore, back = np.empty((width + 1, 2, rows)), np.empty((width + 1, 2, rows))
    fore[0], back[width] = into, out
    for k in range(width):
        x = np.stack([fore[k, 0] * m[k, 0, j] + fore[k, 1] * m[k, 1, j] for j in range(2)])
        fore[k + 1] = x / x.sum(0)
        r = width - 1 - k
        y = np.stack([m[r, i, 0] * back[r + 1, 0] + m[r, i, 1] * back[r + 1, 1] for i in range(2)])
        back[r] = y / y.sum(0)
    both = fore[1:] * back[1:]
    marginal = (both[:, 1] / both.sum(1)).T.ravel()[:n]
    edge = fore[:-1, :, None] * m * back[1:, None]
    edge = (edge / edge.sum((1, 2))[:, None, None]).transpose(1, 2, 3, 0).reshape(2, 2, -1)[:, :, :n]
    return marginal, edge[:, :, ~start].sum(2), edge[:, :, start].sum((0, 2))


@dataclass
class Crf:
    """A trained field and the document model over its marginals."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((3, 2)))
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def emission(self, word: str) -> float:
        """Score of a word as it stands in a text."""
        if (x := self._known.get(word)) is None:
            if len(self._known) > 300_000:
                self._known.clear()
            get = self.weights.get
            x = self._known[word] = self.bias + sum(get(f, 0.0) for f in word_features(word.lower()))
        return x

    def tag(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Marginals of each text's words, and each text's (expected count, highest, share, 1)."""
        words = [WORDS.findall(t) for t in texts]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        known, emission = self._known, self.emission
        emit = np.array([x if (x := known.get(w)) is not None else emission(w) for ws in words for w in ws], dtype=np.float64)
        start = np.zeros(len(emit), dtype=bool)
        ends = np.cumsum(lengths)
        start[(ends - lengths)[lengths > 0]] = True
        p = scan(emit, start, self.trans)[0]
        parts = np.split(p, ends[:-1]) if len(texts) else []
        rows = np.array([(np.log1p(x.sum()), x.max(), (x >= 0.5).mean(), 1.0) if len(x) else (0.0, 0.0, 0.0, 1.0) for x in parts])
        return parts, rows.reshape(-1, 4)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return logistic(rows @ self.document)


def spans(text: str, marginals: np.ndarray) -> list[tuple[int, int]]:
    """Code point offsets of the runs of words more likely toxic than not."""
    out, last = [], -2
    at = set(np.flatnonzero(marginals >= 0.5).tolist())
    for i, m in enumerate(WORDS.finditer(text)):
        if i in at:
            if last == i - 1:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
            last = i
    return out


def held_out(key: str) -> Column:
    """True where the key's checksum is divisible by five: those labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def feature_counts(labelled: DataFrame, text: str) -> DataFrame:
    """(feature, toxic, clean): labelled documents with each feature; counted in the task first."""
    def run(batches):
        counts = {0: Counter(), 1: Counter()}

        def out():
            names = list(counts[0].keys() | counts[1].keys())
            table = pa.table({"feature": pa.array(names, pa.string()), "toxic": pa.array([counts[1][x] for x in names], pa.int64()),
                              "clean": pa.array([counts[0][x] for x in names], pa.int64())})
            counts[0].clear()
            counts[1].clear()
            return table.to_batches()

        for t in blocks(batches, text, 1 << 20):
            for y, x in zip(t.column("toxic").to_pylist(), t.column(text).to_pylist()):
                counts[y].update({f for w in set(WORDS.findall((x or "").lower())) for f in word_features(w)})
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield from out()
        yield from out()

    return (labelled.select("toxic", text).mapInArrow(run, "feature string, toxic long, clean long")
            .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def given(spark: SparkSession, name: str, values: list, kind: DataType) -> DataFrame:
    """One column of values that the driver has, sent as Arrow: rows of Python objects would start more Python workers beside those of the texts."""
    return spark.createDataFrame(pa.table({name: pa.array(values, to_arrow_type(kind))}), StructType([StructField(name, kind)]))


def ascend(gradient, size: int, steps: int, rate: float, begin: np.ndarray) -> np.ndarray:
    """Adam, upwards."""
    x, m, v = begin.copy(), np.zeros(size), np.zeros(size)
    for k in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x += rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-9)
    return x


def train(rows: list[tuple[str, int]], lexicon: list[str], shares: tuple[float, float], steps: int = 60) -> Crf:
    """Train field and document model on (text, toxic) rows; ``shares`` are the classes' (clean, toxic) true shares."""
    number = {f: i for i, f in enumerate(lexicon)}
    tokens, start, label, features, owner = 0, [], [], [], []
    for text, toxic in rows:
        for i, w in enumerate(WORDS.findall(text)):
            ids = [number[f] for f in word_features(w.lower()) if f in number]
            start.append(i == 0)
            label.append(bool(ids) and toxic == 1)
            features += ids
            owner += [tokens] * len(ids)
            tokens += 1
    start, label = np.array(start, dtype=bool), np.array(label, dtype=np.int64)
    features, owner = np.array(features, dtype=np.int64), np.array(owner, dtype=np.int64)
    size = len(lexicon)
    seen = np.bincount(features[label[owner] == 1], minlength=size).astype(float) if len(features) else np.zeros(size)
    moved = np.zeros((2, 2))
    np.add.at(moved, (label[:-1][~start[1:]], label[1:][~start[1:]]), 1)
    began = np.bincount(label[start], minlength=2).astype(float)

    def gradient(x):
        emit = np.full(tokens, x[size]) + np.bincount(owner, weights=x[features], minlength=tokens)
        p, edges, starts = scan(emit, start, x[size + 1:].reshape(3, 2))
        g = np.empty_like(x)
        g[:size] = seen - np.bincount(features, weights=p[owner], minlength=size) - 0.05 * x[:size]
        g[size] = label.sum() - p.sum()
        g[size + 1:size + 5] = (moved - edges).ravel()
        g[size + 5:] = began - starts
        g[size:] -= 0.05 * x[size:]
        return g

    begin = np.zeros(size + 7)
    begin[size] = -4.0
    x = ascend(gradient, size + 7, steps, 0.3, begin) if tokens else begin
    crf = Crf(dict(zip(lexicon, x[:size].tolist())), float(x[size]), x[size + 1:].reshape(3, 2))
    y = np.array([t for _, t in rows])
    f = crf.tag([t for t, _ in rows])[1]
    weight = np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum())) * len(y)
    crf.document = ascend(lambda b: f.T @ (weight * (y - logistic(f @ b))) - 0.01 * b, 4, 400, 0.1, np.zeros(4))
    crf._known.clear()
    return crf


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
        sample_chars: int = SAMPLE_CHARS) -> Crf:
    """Learn from the labelled documents that aren't held out."""
    spark = docs.sparkSession
    bound_arrow(spark)
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
             .groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("toxic")).where("toxic in (0, 1)")).hint("merge")
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias(text))
    # Labels that meet a document, without its text: shares and sample are taken from these alone.
    met = materialise(texts.select("_key", F.char_length(text).alias("_chars")).join(known, "_key"), "labelled")
    shares = {r["toxic"]: r["count"] for r in met.groupBy("toxic").count().collect()}
    total = sum(shares.values())
    rate = shares.get(1, 0) / total if total else 0.0
    unlearned = Crf(document=np.array([0.0, 0.0, 0.0, np.log(max(rate, 1e-300) / max(1 - rate, 1e-300))]))
    if len(shares) < 2:
        return unlearned
    picked = []
    for toxic in (0, 1):
        ids = [r["_key"] for r in met.where((F.col("toxic") == toxic) & (F.col("_chars") <= sample_chars)).select("_key").distinct()
               .orderBy(F.xxhash64("_key"), "_key").limit(sample).collect()]
        few = given(spark, "_key", ids, met.schema["_key"].dataType)     # at most ``sample`` keys
        got = texts.join(F.broadcast(few), "_key").where(F.char_length(text) <= sample_chars).select("_key", text).collect()
        once = {r["_key"]: r[text] for r in sorted(got, key=lambda r: (r["_key"], r[text]))}
        picked += [(t, toxic) for t in once.values()]
    if {t for _, t in picked} != {0, 1}:
        return unlearned
    # A feature that no text of the sample has would keep the weight zero: the sample bounds the lexicon.
    held = {f for t, _ in picked for w in set(WORDS.findall(t.lower())) for f in word_features(w)}
    mine = given(spark, "feature", sorted(held), StringType())
    n1, n0 = shares[1], shares[0]
    toxic, clean = F.col("toxic"), F.col("clean")
    surprise = lambda n, share: F.when(n > 0, n * F.log(n / ((toxic + clean) * share))).otherwise(0.0)
    strong = (feature_counts(texts.join(known, "_key"), text)      # by a shuffle at every size: labels grow, too
              .where(toxic > clean)
              .withColumn("evidence", 2 * (surprise(toxic, n1 / total) + surprise(clean, n0 / total)))
              .where(F.col("evidence") >= EVIDENCE)
              .join(mine.hint("merge"), "feature", "left_semi").select("feature").collect())
    return train(picked, sorted(r["feature"] for r in strong), (n0 / total, n1 / total))


def score(docs: DataFrame, crf: Crf, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with score, predicted (1 from 0.5 on) and spans (start and end of each toxic run of words).

    Columns of those names (with ``prefix``) are replaced.
    """
    bound_arrow(docs.sparkSession)
    names = [prefix + n for n in ("score", "predicted", "spans")]
    docs = docs.drop(*names)
    schema = docs.withColumns(dict(zip(names, (F.lit(0.0), F.lit(0), F.lit(None).cast("array<struct<start: int, end: int>>"))))).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for t in blocks(batches, text, 2 << 20):
            texts = [x or "" for x in t.column(text).to_pylist()]
            parts, rows = crf.tag(texts)
            s = crf.scores(rows)
            found = [[{"start": a, "end": b} for a, b in spans(x, p)] if len(p) and p.max() >= 0.5 else [] for x, p in zip(texts, parts)]
            for name, column in zip(names, (pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32()), pa.array(found, kind))):
                t = t.append_column(name, column)
            yield from t.to_batches()

    return docs.mapInArrow(run, schema)
