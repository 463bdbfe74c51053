"""Toxicity by a linear-chain conditional random field over tokens.

Labels say which documents are toxic, not which words.  On a bounded sample of
labelled documents a word, or its first three to seven letters, is a marker
when the documents that hold it are toxic far more often than chance allows
(a Chernoff bound on the binomial tail, corrected for the number of features)
and at least ``LIFT`` times as often as clean ones.  The markers label the
tokens of the sample's toxic documents, all other tokens are clean.

The field has two states and is fitted to those tokens by gradient steps on its
exact likelihood (forward-backward).  A token's potential is the sum of the
weights of its hashed features: the word, its first and last letters and a
bias; the transitions tie neighbours together.  A chain is a line of the text,
or a run of ``CHAIN`` tokens where a line is longer.

Scoring runs over all words of all documents, in Arrow batches, without a
shuffle: chains of about equal length advance together through forward and
backward passes, and the marginals give the offending spans (neighbouring
tokens of at least a half, as character offsets) and, through a logistic curve
fitted on the sample, the document's score.

Only texts and the labels of the training rows are ever read; ``lang``,
``source`` and ids are no features.  Defined cases: a null or empty text has no
token and gets the curve's base score; a null ``doc_id`` is scored; several
labels of one document count as toxic if one is; null labels are left out;
without labels of both kinds every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import batches, text_bytes

#: Bounds of the training sample: documents of each kind, and their largest size in characters.
TOXIC_SAMPLE = 1500
CLEAN_SAMPLE = 4500
SAMPLE_CHARS = 100_000
#: Clean chains for each chain with a marked token.
CLEAN_CHAINS = 3
LIFT = 10.0
DOUBT = 0.05
PENALTY = 0.5
FAINT = 0.1
DIMENSIONS = 1 << 18
CHAIN = 64
STEPS = 60
TOKEN = regex.compile(r"[^\x20\x09-\x0D]+")
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…„“”«»¿¡"


def shape(token: str) -> str:
    return token.lower().strip(EDGE)


def starts_of(word: str) -> list[str]:
    return [word[:k] + "*" for k in range(3, 8) if len(word) >= k]


def features(word: str) -> list[int]:
    """Places of a word's features among the weights; place 0 is the bias."""
    names = ["w=" + word, *("p=" + p for p in starts_of(word)), "s=" + word[-3:]]
    return [0, *(1 + xxhash.xxh64_intdigest(n) % (DIMENSIONS - 1) for n in names)]


def chains_of(text: str) -> list[list[str]]:
    """The shaped tokens of each chain."""
    out = []
    for line in text.split("\n"):
        tokens = TOKEN.findall(line)
        out += [[shape(t) for t in tokens[i:i + CHAIN]] for i in range(0, len(tokens), CHAIN)]
    return out


class Sample:
    """The training texts as word numbers: chains, documents, and the distinct words' marker features."""

    def __init__(self, texts: list[str]) -> None:
        number: dict[str, int] = {}
        tokens, self.lengths = [], []
        for t in texts:
            chains = chains_of(t)
            tokens.append(np.array([number.setdefault(w, len(number)) for c in chains for w in c], dtype=np.int32))
            self.lengths.append(np.array([len(c) for c in chains], dtype=np.int64))
        self.documents = tokens
        self.words = list(number)
        sizes = np.fromiter((1 + max(0, min(len(w), 7) - 2) if w else 0 for w in self.words), dtype=np.int64, count=len(number))
        name = np.fromiter((xxhash.xxh64_intdigest(x) for w in self.words if w for x in (w, *starts_of(w))),
                           dtype=np.uint64, count=int(sizes.sum()))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        distinct, place = np.unique(name, return_inverse=True)
        self.n_names, self.name = len(distinct), place.astype(np.int32)

    def names_of(self, words: np.ndarray) -> np.ndarray:
        sizes = self.first[words + 1] - self.first[words]
        return self.name[np.repeat(self.first[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]

    def marked_words(self, toxic: np.ndarray) -> np.ndarray:
        """Whether each word, or a start of it, is a marker: its documents are toxic beyond chance."""
        n, n1 = np.zeros(self.n_names), np.zeros(self.n_names)
        for d, bad in zip(self.documents, toxic, strict=True):
            held = np.unique(self.names_of(np.unique(d)))
            n[held] += 1
            n1[held] += bad
        share, p = toxic.mean(), n1 / np.maximum(n, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            kl = (np.where(p > 0, p * np.log(p / share), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - share)), 0))
            odds = (n1 / toxic.sum()) / np.maximum((n - n1) / (~toxic).sum(), 1e-12)
        marker = (p > share) & (n * kl >= np.log(max(self.n_names, 1) / DOUBT)) & (odds >= LIFT)
        hits = np.concatenate([[0], np.cumsum(marker[self.name])])
        return hits[self.first[1:]] > hits[self.first[:-1]]


class Chains:
    """Chains laid out by length, longest first, so that each step works on a leading part."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.offsets = (np.cumsum(lengths) - lengths)[self.order]
        self.size = int(lengths.max()) if len(lengths) else 0
        self.live = [int(np.searchsorted(-self.lengths, -t, side="left")) for t in range(self.size)]

    def marginals(self, potential: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Each token's probability of state 1, the summed pair marginals, and the log-likelihood's normaliser.

        ``potential`` is state 1's over state 0's for each token, ``move`` the
        two-by-two transition potentials.
        """
        n = len(self.lengths)
        alpha = np.zeros((self.size, n, 2))
        scale = np.ones((self.size, n))
        local = np.ones((self.size, n, 2))
        t_move = np.exp(move)
        total = 0.0
        for t in range(self.size):
            m = self.live[t]
            e = np.clip(potential[self.offsets[:m] + t], -30, 30)
            local[t, :m, 1] = np.exp(e)
            a = local[t, :m] * (alpha[t - 1, :m] @ t_move if t else 1.0)
            scale[t, :m] = a.sum(axis=1)
            alpha[t, :m] = a / scale[t, :m, None]
            total += float(np.log(scale[t, :m]).sum())
        out = np.empty(len(potential))
        pairs = np.zeros((2, 2))
        beta = np.ones((n, 2))
        for t in range(self.size - 1, -1, -1):
            m = self.live[t]
            g = alpha[t, :m] * beta[:m]
            out[self.offsets[:m] + t] = g[:, 1] / g.sum(axis=1)
            if t:
                right = local[t, :m] * beta[:m] / scale[t, :m, None]
                pairs += t_move * (alpha[t - 1, :m].T @ right)
                beta[:m] = right @ t_move.T
        return out, pairs, total


class Field:
    """Feature weights, transitions and the documents' curve."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, curve: np.ndarray | None = None) -> None:
        self.weights, self.move, self.curve = weights, move, curve
        self.known: dict[str, float] = {}

    def potentials(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        fresh = list(set(words).difference(known))
        known.update(zip(fresh, self.potentials_of(fresh).tolist(), strict=True))
        return np.fromiter(map(known.__getitem__, words), dtype=np.float64, count=len(words))

    def potentials_of(self, words: list[str], step: int = 50_000) -> np.ndarray:
        """State 1's potential over state 0's for each word."""
        out = np.empty(len(words))
        for at in range(0, len(words), step):
            each = [features(w) for w in words[at:at + step]]
            sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
            place = np.fromiter(chain.from_iterable(each), dtype=np.int64, count=int(sizes.sum()))
            out[at:at + len(each)] = np.add.reduceat(self.weights[place], np.cumsum(sizes) - sizes)
        return out

    def token_marginals(self, chains: list[list[str]]) -> np.ndarray:
        lengths = np.fromiter(map(len, chains), dtype=np.int64, count=len(chains))
        return self.marginals_of(self.potentials(list(chain.from_iterable(chains))), lengths)

    def marginals_of(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Marginals of chains that lie one after the other."""
        out, ends = np.empty(len(e)), np.cumsum(lengths)
        for at in range(0, len(lengths), 20_000):              # bounds the pass's arrays
            part = lengths[at:at + 20_000]
            a, z = int(ends[at] - lengths[at]), int(ends[min(at + 20_000, len(lengths)) - 1])
            out[a:z] = Chains(part).marginals(e[a:z], self.move)[0]
        return out

    def by_document(self, texts: list[str]) -> list[np.ndarray]:
        """The marginals of each text's tokens; all texts' chains advance together."""
        chains = [chains_of(t) for t in texts]
        p = self.token_marginals([c for doc in chains for c in doc])
        return np.split(p, np.cumsum([sum(map(len, doc)) for doc in chains])[:-1]) if texts else []

    @staticmethod
    def summary(p: np.ndarray) -> list[float]:
        """What a document's curve sees of its marginals: those below FAINT add nothing, however many there are."""
        if not len(p):
            return [1.0, 0.0, 0.0, 0.0]
        p = np.where(p >= FAINT, p, 0.0)
        return [1.0, float(p.max()), float(np.log1p(p.sum())), float(np.log1p(1e4 * p.mean()))]

    def document_score(self, p: np.ndarray) -> float:
        z = float(np.clip(np.dot(self.curve, self.summary(p)), -30, 30))
        return 1.0 / (1.0 + np.exp(-z))


def fit_field(words: list[str], tokens: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> Field:
    """Adagrad on the exact gradient: expected minus observed features and transitions.

    ``tokens`` are numbers of words, chain after chain; ``y`` their labels.
    """
    y = y.astype(np.float64)
    layout = Chains(lengths)
    used, types = np.unique(tokens, return_inverse=True)
    per_type = [features(words[i]) for i in used.tolist()]
    place = np.fromiter((x for f in per_type for x in f), dtype=np.int64)
    owner = np.repeat(np.arange(len(per_type)), [len(f) for f in per_type])
    seen = np.zeros((2, 2))
    inside = np.ones(len(y), dtype=bool)
    inside[np.cumsum(lengths) - lengths] = False
    np.add.at(seen, (y[np.flatnonzero(inside) - 1].astype(int), y[inside].astype(int)), 1)
    w, move = np.zeros(DIMENSIONS), np.zeros((2, 2))
    w[0] = -3.0
    grown, grown_move = np.full(DIMENSIONS, 1e-6), np.full((2, 2), 1e-6)
    for _ in range(STEPS):
        potential = np.bincount(owner, w[place], len(per_type))[types]
        p, pairs, _ = layout.marginals(potential, move)
        by_type = np.bincount(types, p - y, len(per_type))
        g = np.bincount(place, by_type[owner], DIMENSIONS) + PENALTY * w
        grown += g * g
        w -= 0.5 * g / np.sqrt(grown)
        g = pairs - seen + 0.1 * move
        grown_move += g * g
        move -= 0.2 * g / np.sqrt(grown_move)
    return Field(w, move)


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, held back by a small penalty."""
    b = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        b += np.linalg.solve(h, x.T @ (y - p) - 0.1 * b)
    return b


def train(texts: list[str], toxic: list[int]) -> Field | None:
    """The field of a labelled sample; None unless it holds both kinds."""
    bad = np.array(toxic, dtype=bool)
    if not bad.any() or bad.all():
        return None
    sample = Sample(texts)
    marked = sample.marked_words(bad)
    tokens, lengths = np.concatenate(sample.documents), np.concatenate(sample.lengths)
    labels = marked[tokens] & np.repeat(bad, [len(d) for d in sample.documents])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    hot = np.bincount(owner, labels, len(lengths)) > 0
    cold = np.flatnonzero(~hot)
    chosen = hot.copy()
    chosen[cold[::max(1, len(cold) // max(1, CLEAN_CHAINS * int(hot.sum()) + 1000))]] = True
    used = chosen[owner]
    field = fit_field(sample.words, tokens[used], labels[used], lengths[chosen])
    potential = field.potentials_of(sample.words)
    x = np.array([field.summary(field.marginals_of(potential[d], n)) for d, n in zip(sample.documents, sample.lengths, strict=True)])
    field.curve = fit_curve(x, bad.astype(np.float64))
    return field


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learnt from; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, toxic: int, clean: int, chars: int = SAMPLE_CHARS) -> DataFrame:
    """``doc_id, text, toxic`` of at most so many documents of each kind, of at most ``chars`` characters.

    They are chosen by a hash of their ids among the documents that are short
    enough; of several texts with one id the one with the smallest hash is learnt.
    """
    told = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    short = docs.filter(F.length("text") <= chars).select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                                          F.xxhash64("text").alias("text_hash"))
    there = short.groupBy("doc_id").agg(F.min("text_hash").alias("text_hash")).join(told, "doc_id")
    order = F.xxhash64("doc_id")
    chosen = (there.filter("toxic = 1").orderBy(order).limit(toxic)
              .unionAll(there.filter("toxic = 0").orderBy(order).limit(clean)))
    return (short.join(F.broadcast(chosen), ["doc_id", "text_hash"])     # at most toxic + clean ids
            .dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic"))


def fit_on_sample(docs: DataFrame, labels: DataFrame, toxic_sample: int, clean_sample: int) -> Field | None:
    """The field of the training sample, fitted in one task, which the sample's bounds keep small."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted(((r["doc_id"], r["text"], r["toxic"]) for b in rows for r in b.to_pylist()), key=lambda r: r[0])
        field = train([r[1] for r in sample], [r[2] for r in sample])
        parts = [] if field is None else [field.weights, field.move.ravel(), field.curve]
        yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f8").tobytes() for x in parts], pa.binary()),
                                          pa.array(range(len(parts)), pa.int32())], ["part", "at"])

    sample = training_sample(docs, labels, toxic_sample, clean_sample)
    parts = sample.repartition(1).mapInArrow(run, "part binary, at int").collect()
    if not parts:
        return None
    weights, move, curve = (np.frombuffer(r["part"], "<f8") for r in sorted(parts, key=lambda r: r["at"]))
    return Field(weights, move.reshape(2, 2), curve)


def score_documents(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, score, spans``: spans of characters with their mean marginal."""
    spark = docs.sparkSession
    if field is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("score"),
                           F.array().cast("array<struct<start:int,end:int,score:double>>").alias("spans"))
    shared = spark.sparkContext.broadcast((field.weights, field.move, field.curve))      # DIMENSIONS doubles

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(*shared.value)
        for b in batches(rows):
            texts = [t.decode("utf-8", "replace") for t in b.column("utf8").to_pylist()]
            each = model.by_document(texts)
            scores = [model.document_score(p) for p in each]
            spans = [find_spans(t, p) for t, p in zip(texts, each, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, SPANS)],
                                             ["doc_id", "score", "spans"])

    return text_bytes(docs).mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,end:int,score:double>>")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, toxic_sample: int = TOXIC_SAMPLE,
                  clean_sample: int = CLEAN_SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they are."""
    field = fit_on_sample(docs, labels, toxic_sample, clean_sample)
    if field is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((field.weights, field.move, field.curve))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(*shared.value)
        for b in batches(rows):
            each = model.by_document([t or "" for t in b.column("text").to_pylist()])
            yield b.filter(pa.array([model.document_score(p) < threshold for p in each], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def find_spans(text: str, p: np.ndarray) -> list[dict]:
    """Neighbouring tokens of at least a half; p holds the marginals of the text's tokens in order."""
    hits = np.flatnonzero(p >= 0.5)
    if not len(hits):
        return []
    wanted, at, out = set(hits.tolist()), 0, []
    for i, m in enumerate(TOKEN.finditer(text)):
        if i in wanted:
            if out and out[-1]["last"] == i - 1:
                out[-1] |= {"end": m.end(), "last": i, "sum": out[-1]["sum"] + float(p[i])}
            else:
                out.append({"start": m.start(), "end": m.end(), "first": i, "last": i, "sum": float(p[i])})
            at += 1
            if at == len(wanted):
                break
    return [{"start": x["start"], "end": x["end"], "score": x["sum"] / (x["last"] - x["first"] + 1)} for x in out]


def toxicity(docs: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE, clean_sample: int = CLEAN_SAMPLE) -> DataFrame:
    """Fits on the sample and scores every document: ``doc_id, score, spans``."""
    return score_documents(docs, fit_on_sample(docs, labels, toxic_sample, clean_sample))
