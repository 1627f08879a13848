"""Language-model scores: add-one unigrams and a log-bilinear neural model.

Word counts cover the whole training part. The neural model predicts a token
from the two before it, ``(c1 * r1 + c2 * r2) . q + b``, over the most
frequent words and one class for all others; within that class a word has its
add-one share. It is trained in numpy with noise-contrastive estimation: every
task runs through all its tokens, and the parameters are averaged by tokens
seen. For scoring, matrix products give the scores of all next tokens for all
pairs of context words at once, and so the normalised log-probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, remainder, stored
from tagloom.llm.words import WORDS, fold

END = ""  # no word is empty
COUNTED = 250_000  # distinct words a task holds before it passes counts on


@dataclass(frozen=True)
class LmSettings:
    classes: int = 1000  # words the neural model tells apart
    near: int = 50_000  # words whose counts every task holds; the rest are joined
    dims: int = 16
    noise: int = 24  # noise words of a batch
    batch: int = 4096
    rate: float = 0.05
    slots: tuple[int, ...] = (1024, 32)  # averaging in steps: so many groups, then so many
    seed: int = 11


def tokens(text: str) -> list[str]:
    """Words with A-Z lower-cased, then the end."""
    return [*WORDS.findall(fold(text)), END]


def is_held_out(id_col: Column) -> Column:
    return remainder(id_col, 7) == 2


def count_words(docs: DataFrame) -> DataFrame:
    """``word, c`` over all tokens of ``docs(text)``; counts of a task are summed before they are shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "c"]
        )
        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                if len(held) > COUNTED:
                    yield out()
                    held.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """``words`` most frequent first with their ``counts``; parameters of the neural part."""

    words: list[str]
    counts: np.ndarray
    total: int
    distinct: int
    classes: int
    params: dict[str, np.ndarray]
    key: str

    def __post_init__(self) -> None:
        self.at = {w: i for i, w in enumerate(self.words)}


def start_params(model_classes: int, share: np.ndarray, s: LmSettings) -> dict[str, np.ndarray]:
    """Parameters with which the model is the unigram model. The last context row is the start of a text."""
    rng = np.random.default_rng(s.seed)
    near = lambda n: rng.normal(0, 0.1, (n, s.dims)).astype(np.float32)
    return {
        "r": near(model_classes + 2),
        "q": near(model_classes + 1),
        "b": np.log(share).astype(np.float32),
        "c1": np.full(s.dims, 1.0, np.float32),
        "c2": np.full(s.dims, 0.5, np.float32),
    }


def class_ids(model: Model, words: list[str]) -> np.ndarray:
    """Place of each token among the words held, the number of these for others."""
    return np.fromiter(map(model.at.get, words, repeat(len(model.words))), dtype=np.int64, count=len(words))


def contexts(ids: np.ndarray, classes: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each token and of the two before it in its text; ``ends`` marks each text's last token."""
    w = np.minimum(ids, classes)
    start = np.concatenate([[True], ends[:-1]])
    w1 = np.where(start, classes + 1, np.concatenate([[0], w[:-1]]))
    w2 = np.where(start, classes + 1, np.concatenate([[classes + 1], w1[:-1]]))
    return w, w1, w2


def scatter(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    d = rows.shape[1]
    flat = (at[:, None] * d + np.arange(d)).ravel()
    return np.bincount(flat, rows.ravel(), minlength=n * d).reshape(n, d).astype(np.float32)


def train_batch(
    p: dict[str, np.ndarray], seen: dict[str, np.ndarray], w: np.ndarray, w1: np.ndarray, w2: np.ndarray,
    log_noise: np.ndarray, noise: np.ndarray, rate: float,
) -> None:
    """One step of noise-contrastive estimation, with step sizes by past gradients."""
    k = len(noise)
    r1, r2, q = p["r"][w1], p["r"][w2], p["q"][w]
    h = p["c1"] * r1 + p["c2"] * r2
    qn = p["q"][noise]
    offset = np.float32(np.log(k))
    up = 1 / (1 + np.exp((h * q).sum(axis=1) + p["b"][w] - log_noise[w] - offset))
    down = -1 / (1 + np.exp(-(h @ qn.T + p["b"][noise] - log_noise[noise] - offset)))
    dh = up[:, None] * q + down @ qn
    gq = scatter(up[:, None] * h, w, len(p["q"])) + scatter(down.T @ h, noise, len(p["q"]))
    gb = np.bincount(w, up, minlength=len(p["b"])) + np.bincount(noise, down.sum(axis=0), minlength=len(p["b"]))
    gr = scatter(dh * p["c1"], w1, len(p["r"])) + scatter(dh * p["c2"], w2, len(p["r"]))
    grads = {"q": gq, "b": gb.astype(np.float32), "r": gr, "c1": (dh * r1).sum(axis=0), "c2": (dh * r2).sum(axis=0)}
    for name, g in grads.items():
        seen[name] += g * g
        p[name] += rate * g / np.sqrt(seen[name] + 1e-6)


def batches_of(texts: Iterable[str], limit: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """Tokens of consecutive texts, at least ``limit`` together or up to the end, and where texts end."""
    words: list[str] = []
    ends: list[int] = []

    def marks() -> np.ndarray:
        out = np.zeros(len(words), dtype=bool)
        out[ends] = True
        return out

    for text in texts:
        words += tokens(text)
        ends.append(len(words) - 1)
        if len(words) >= limit:
            yield words, marks()
            words, ends = [], []
    if words:
        yield words, marks()


def train(docs: DataFrame, model: Model, s: LmSettings) -> dict[str, np.ndarray]:
    """Parameters averaged over tasks, each of which has run through all its tokens of ``docs(text)``."""
    names = list(model.params)
    shapes = {n: model.params[n].shape for n in names}
    share = class_share(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = {n: v.copy() for n, v in model.params.items()}
        seen = {n: np.zeros_like(v) for n, v in p.items()}
        part = TaskContext.get().partitionId()
        rng = np.random.default_rng([s.seed, part])
        log_noise = np.log(share).astype(np.float32)
        fall = np.cumsum(share)
        done = 0
        texts = (t.as_py() for batch in batches for t in batch.column(0))
        for words, ends in batches_of(texts, 16 * s.batch):
            w, w1, w2 = contexts(class_ids(model, words), model.classes, ends)
            done += len(w)
            for lo in range(0, len(w), s.batch):
                cut = slice(lo, lo + s.batch)
                noise = np.minimum(np.searchsorted(fall, rng.random(s.noise) * fall[-1]), len(share) - 1)
                train_batch(p, seen, w[cut], w1[cut], w2[cut], log_noise, noise, s.rate)
        if done:
            flat = np.concatenate([p[n].ravel() for n in names]).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([float(done)], pa.float64()), pa.array([flat], pa.binary())],
                names=["slot", "weight", "params"],
            )

    def average(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", kind="stable")
        total = pdf["weight"].sum()
        mean = sum(np.frombuffer(b, "<f4").astype(float) * w for b, w in zip(pdf["params"], pdf["weight"], strict=True)) / total
        return pd.DataFrame({"slot": [pdf["slot"].iloc[0]], "weight": [total], "params": [mean.astype("<f4").tobytes()]})

    schema = "slot long, weight double, params binary"
    learned = docs.select("text").mapInArrow(run, schema)
    for n in s.slots:
        learned = learned.groupBy((F.col("slot") % n).alias("g")).applyInPandas(average, schema)
    rows = learned.collect()  # at most the last number of slots
    if not rows:
        return model.params
    flat = average(pd.DataFrame([r.asDict() for r in rows]))["params"].iloc[0]
    values, out, at = np.frombuffer(flat, "<f4"), {}, 0
    for n in names:
        size = int(np.prod(shapes[n]))
        out[n] = values[at : at + size].reshape(shapes[n]).copy()
        at += size
    return out


def class_share(model: Model) -> np.ndarray:
    """Share of each class among training tokens, the last one for all other words; never zero."""
    own = model.counts[: model.classes].astype(float)
    rest = max(0.0, model.total - own.sum())
    share = np.concatenate([own, [rest]]) + 1.0
    return share / share.sum()


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """Words of the highest counts, whole steps of a logarithmic scale, at most ``most`` of them."""
    step = F.floor(F.log2("c") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()  # one row per step of the scale
    taken, least = 0, None
    for r in sorted(sizes, reverse=True):
        taken += r.n
        if taken > most:
            break
        least = r.step
    return counts.where(step >= least) if least is not None else counts.limit(0)


def fit(docs: DataFrame, settings: LmSettings = LmSettings()) -> tuple[Model, DataFrame]:
    """Model and word counts (``word, c``) of all training texts ``docs(text)``."""
    s = settings
    counts = stored(count_words(docs), "word-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    rows = frequent(counts, s.near).collect()  # at most s.near
    rows.sort(key=lambda r: (-r[1], r[0]))
    words = [r[0] for r in rows]
    model = Model(words, np.array([r[1] for r in rows], np.int64), int(total[0]), int(total[1]), min(s.classes, len(words)), {}, "")
    model.params = start_params(model.classes, class_share(model), s)
    model.params = train(docs, model, s)
    model.key = f"{id(docs)}-{np.random.default_rng().integers(1 << 62)}"
    return model, counts


class Scorer:
    """Tables of the neural model's scores and normalisers."""

    def __init__(self, model: Model):
        p = model.params
        self.first = ((p["c1"] * p["r"]) @ p["q"].T).astype(np.float32)
        self.second = ((p["c2"] * p["r"]) @ p["q"].T).astype(np.float32)
        self.bias = p["b"]
        weight = np.exp(self.second.astype(np.float64) + self.bias)  # context two back x next
        # exp of a sum is a product: the normaliser of every pair of context words is one matrix product.
        self.log_z = np.log(np.exp(self.first.astype(np.float64)) @ weight.T)
        own = model.counts[: model.classes].sum()
        self.rest = np.log10(float(model.total - own) + (model.distinct - model.classes) + 1)

    def log10(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        """Log-probability of each next class; for the class of other words still without the word's share."""
        s = self.first[w1, w].astype(np.float64) + self.second[w2, w] + self.bias[w] - self.log_z[w1, w2]
        return s / np.log(10)


@lru_cache(maxsize=2)
def _scorer(key: str) -> Scorer:
    return Scorer(_MODELS[key])


_MODELS: dict[str, Model] = {}


def scorer(model: Model) -> Scorer:
    if model.key not in _MODELS:
        _MODELS.clear()
        _scorer.cache_clear()
        _MODELS[model.key] = model
    return _scorer(model.key)


def score_texts(
    df: DataFrame,
    is_held_out=is_held_out,
    settings: LmSettings = LmSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every whole text by models of the rows for which ``is_held_out(id)`` is false.

    Returns one row per input row: the id, ``held_out``, ``n_tokens`` (words
    and the end), ``n_known``, ``train_tokens``, ``base_score`` (add-one
    unigrams) and ``score`` (neural model), both log10 of the text's
    probability. Null and empty texts are the end alone. Without training rows
    every base score is 0. Repeated rows stay and count as often in training;
    other columns are not carried.

    Frequent words are looked up in the task. The rest of the words leave it
    with their row's number and meet their counts in a join.
    """
    s = settings
    rows = id_and_text(df, id_col, text_col).withColumn("held_out", is_held_out(F.col(id_col)))
    model, counts = fit(rows.where(~F.col("held_out")), s)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = scorer(model)
        near = len(model.words)
        plus = np.concatenate([np.log10(model.counts + 1.0), [0.0]])
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            texts = (t.as_py() for t in batch.column(1))
            for words, ends in batches_of(texts, 1 << 18):
                ids = class_ids(model, words)
                w, w1, w2 = contexts(ids, model.classes, ends)
                lower = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
                base = np.add.reduceat(plus[ids], lower)
                neural = know.log10(w, w1, w2) + np.where(w == model.classes, plus[ids] - know.rest, 0.0)
                out[1] += base.tolist()
                out[2] += np.add.reduceat(neural, lower).tolist()
                size = np.diff(np.append(lower, len(words)))
                far = ids == near
                out[3] += size.tolist()
                out[4] += np.add.reduceat(far.astype(np.int64), lower).tolist()
                rare = np.flatnonzero(far)
                cut = np.searchsorted(rare, np.append(lower, len(words))).tolist()
                rare = rare.tolist()
                out[5] += [[words[i] for i in rare[a:b]] for a, b in zip(cut, cut[1:], strict=False)]
            rows_n = len(out[1])
            out[0] = [(part << 40) + n + i for i in range(rows_n)]
            n += rows_n
            kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))],
                names=["id", "held_out", "row", "base", "neural", "n_tokens", "n_far", "far"],
            )

    schema = f"id {kind}, held_out boolean, row long, base double, neural double, n_tokens long, n_far long, far array<string>"
    part = stored(rows.select(F.col(id_col).alias("id"), "text", "held_out").mapInArrow(run, schema), "lm-rows")
    far = part.select("row", F.explode("far").alias("word")).groupBy("row", "word").count()
    far = far.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("count") * F.log10(F.col("c") + 1.0)).alias("plus"), F.sum("count").alias("found")
    )
    plus, found = F.coalesce("plus", F.lit(0.0)), F.coalesce("found", F.lit(0))
    all_of = float(np.log10(model.total + model.distinct + 1))
    held = float(model.total > 0)
    known = F.when(F.lit(model.total > 0), F.col("n_tokens") - F.col("n_far") + found).otherwise(F.lit(0))
    return part.join(far, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", known.cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        ((F.col("base") + plus - F.col("n_tokens") * all_of) * held).alias("base_score"),
        (F.col("neural") + plus).alias("score"),
    )
