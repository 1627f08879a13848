"""Toxicity by a support vector machine over a subsequence string kernel.

Two words are as alike as they share subsequences of letters, gaps weighing
less: inserted letters and signs lower the similarity and do not end it.
Landmarks are words of labelled rows that tell toxic rows apart, and ordinary
words most like them. A sentence is described by its greatest similarity to
each landmark; the Nystroem map turns that into coordinates of the kernel's
space, in which a linear machine is trained on sentences. A text scores as its
worst sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, remainder, stored
from tagloom.llm.words import WORDS

CACHED = 250_000  # words and units of one generation
PAIRS = 512  # hashed letter pairs
LONGEST = 24  # letters of a unit; longer words are cut into overlapping ones
LETTERS = re.compile(r"[^\W\d_]+")
EDGES = ".,;:!?\"'()"
# Signs written for letters; fixed values.
SIGNS = str.maketrans("013457@$", "oieastas")


@dataclass(frozen=True)
class ToxicSettings:
    rows: int = 20_000  # labelled rows used for training at most, chosen by a hash of the id
    candidates: int = 400  # words considered as landmarks, of either label
    landmarks: int = 48  # toxic ones
    ordinary: int = 16
    order: int = 3  # letters of a subsequence
    decay: float = 0.5  # weight of each letter a subsequence spans
    apart: float = 0.6  # landmarks are less alike than this
    shared: float = 0.5  # of a landmark's letter pairs, within reach of a gap, that a like word has
    chance: float = 2e-3  # that a landmark's rows are toxic by chance, at most
    sentences: int = 3  # of a training row, the most suspicious ones
    rounds: int = 40
    penalty: float = 1e-4
    seed: int = 5


def units_of(word: str) -> list[str]:
    """Letters of a word between marks for its ends; signs inside are left out."""
    word = word.strip(EDGES).lower()
    if not word.isalpha():
        if not LETTERS.search(word):
            return []
        word = "".join(LETTERS.findall(word.translate(SIGNS)))
    if len(word) < 3:
        return []
    word = f"^{word}$"
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[i : i + LONGEST] for i in range(0, len(word) - step, step)]


def ends_sentence(word: str) -> bool:
    return word.rstrip("\"')")[-1:] in ("." , "!", "?")


def tokens(text: str) -> list[str]:
    """Words; runs of three or more single letters are one word."""
    words = WORDS.findall(text)
    letters = {w for w in set(words) if len(w) == 1 and w.isalpha()}
    at = [i for i, w in enumerate(words) if w in letters] if letters else []
    if not any(b - a == 2 for a, b in zip(at, at[2:], strict=False)):
        return words
    out: list[str] = []
    run: list[str] = []
    for w in [*words, ""]:
        if w in letters:
            run.append(w)
            continue
        out += ["".join(run)] if len(run) >= 3 else run
        run = []
        if w:
            out.append(w)
    return out


def codes(units: list[str]) -> np.ndarray:
    """Characters as numbers, -1 beyond the end."""
    flat = "".join([u.ljust(LONGEST, "\0") for u in units]).encode("utf-32-le", "surrogatepass")
    out = np.frombuffer(flat, dtype="<i4").reshape(len(units), LONGEST).copy()
    out[out == 0] = -1
    return out


def subsequence_kernel(a: np.ndarray, b: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Gap-weighted subsequence kernel of each row of ``a`` with the same row of ``b``; rows are padded with -1 and -2."""
    n, wide = len(a), b.shape[1]
    # Sums over all earlier places of b, each place further back weighing less, as a product with this matrix.
    back = np.arange(wide + 1)[None, :] - np.arange(wide)[:, None] - 1
    fade = np.where(back >= 0, np.float32(decay) ** np.maximum(back, 0), 0).astype(np.float32)
    # before[i][:, t]: weight of common subsequences of i letters in what was read of a and b[:t].
    before = [np.ones((n, wide + 1), dtype=np.float32)] + [np.zeros((n, wide + 1), dtype=np.float32) for _ in range(order - 1)]
    total = np.zeros(n, dtype=np.float32)
    square = np.float32(decay * decay)
    for s in range(a.shape[1]):
        same = (a[:, s : s + 1] == b) * square
        total += np.einsum("nt,nt->n", same, before[order - 1][:, :-1])
        for i in range(order - 1, 0, -1):  # downwards: each still needs the shorter ones as they were
            before[i] *= np.float32(decay)
            before[i] += (same * before[i - 1][:, :-1]) @ fade
    return total


def kernel_rows(a: np.ndarray, b: np.ndarray, s: ToxicSettings) -> np.ndarray:
    """Kernel values of coded units, row by row; short rows are computed narrowly."""
    out = np.zeros(len(a), dtype=np.float64)
    length = np.maximum((a >= 0).sum(axis=1), (b >= 0).sum(axis=1))
    least = 0
    for width in (9, 12, 16, LONGEST):
        rows = np.flatnonzero((length > least) & (length <= width))
        for lo in range(0, len(rows), 8192):
            part = rows[lo : lo + 8192]
            right = b[part, :width]
            out[part] = subsequence_kernel(a[part, :width], np.where(right < 0, -2, right), s.order, s.decay)
        least = width
    return out


def kernel_of(a: list[str], b: list[str], s: ToxicSettings) -> np.ndarray:
    """Kernel values of units pairwise by place."""
    return kernel_rows(codes(a), codes(b), s)


def letter_pairs(c: np.ndarray, reach: int) -> np.ndarray:
    """Which hashed letter pairs, up to ``reach`` apart, each coded unit has."""
    out = np.zeros((len(c), PAIRS), dtype=np.float32)
    for gap in range(1, reach + 1):
        row, at = np.nonzero(c[:, gap:] >= 0)
        out[row, (c[row, at] * 31 + c[row, at + gap]) % PAIRS] = 1
    return out


class Landmarks:
    """Similarities of units to landmarks; pairs that share too few letter pairs count as unlike."""

    def __init__(self, words: list[str], s: ToxicSettings):
        self.words, self.s = words, s
        self.codes = codes(words)
        self.own = np.sqrt(kernel_rows(self.codes, self.codes, s))
        self.pairs = letter_pairs(self.codes, 1)
        self.least = np.maximum(2, s.shared * self.pairs.sum(axis=1))

    def similar(self, units: list[str]) -> np.ndarray:
        out = np.zeros((len(units), len(self.words)), dtype=np.float32)
        for lo in range(0, len(units), 4096):
            c = codes(units[lo : lo + 4096])
            row, m = np.nonzero(letter_pairs(c, 3) @ self.pairs.T >= self.least)
            if len(row):
                some, at = np.unique(row, return_inverse=True)
                own = np.sqrt(kernel_rows(c[some], c[some], self.s))
                out[lo + row, m] = kernel_rows(c[row], self.codes[m], self.s) / own[at] / self.own[m]
        return out


class Recent:
    """A map of bounded size: what was not asked for during a whole generation is forgotten."""

    def __init__(self) -> None:
        self.now: dict[str, int] = {}
        self.past: dict[str, int] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """Keys without a value; the others are kept for another generation."""
        absent = [k for k in keys if k not in self.now]
        self.now.update((k, self.past[k]) for k in absent if k in self.past)
        return [k for k in absent if k not in self.now]


class Reader:
    """Similarities of sentences to landmarks; words and units of late are remembered."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.units, self.words = Recent(), Recent()  # of words: twice the row of the best unit, plus 1 at a sentence's end
        self.rows = np.zeros((1, len(landmarks.words)), dtype=np.float32)  # the first row: unlike all

    def age(self) -> None:
        """Start a new generation, with the rows that are still in use."""
        for kept in (self.units, self.words):
            kept.now, kept.past = {}, kept.now
        used = sorted({0, *self.units.past.values(), *(v >> 1 for v in self.words.past.values())})
        place = {old: new for new, old in enumerate(used)}
        self.units.past = {k: place[v] for k, v in self.units.past.items()}
        self.words.past = {k: 2 * place[v >> 1] + (v & 1) for k, v in self.words.past.items()}
        self.rows = self.rows[used]

    def learn(self, words: set[str]) -> None:
        if len(self.words.now) > CACHED or len(self.units.now) > CACHED:
            self.age()
        new = self.words.missing(words)
        units = [units_of(w) for w in new]
        fresh = self.units.missing({u for us in units for u in us})
        rows = self.landmarks.similar(fresh)
        near = np.flatnonzero(rows.any(axis=1))
        self.units.now.update(dict.fromkeys(fresh, 0) | {fresh[i]: len(self.rows) + n for n, i in enumerate(near.tolist())})
        self.rows = np.concatenate([self.rows, rows[near]])
        long: list[np.ndarray] = []
        for w, us in zip(new, units, strict=True):
            own = [r for u in us if (r := self.units.now[u])]
            if len(own) > 1:  # a long word of several units has a row of its own
                long.append(self.rows[own].max(axis=0))
                own = [len(self.rows) + len(long) - 1]
            self.words.now[w] = 2 * (own[0] if own else 0) + ends_sentence(w)
        if long:
            self.rows = np.concatenate([self.rows, np.stack(long)])

    def sentences(self, words: list[str]) -> np.ndarray:
        """Similarities of each sentence that is like any landmark at all."""
        code = np.fromiter(map(self.words.now.__getitem__, words), dtype=np.int64, count=len(words))
        near = np.flatnonzero(code > 1)
        if not len(near):
            return self.rows[:0]
        number = np.cumsum(code & 1)[near] - (code[near] & 1)
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        return np.maximum.reduceat(self.rows[code[near] >> 1], starts, axis=0)

    def read(self, texts: list[str], limit: int = 200_000) -> Iterator[np.ndarray]:
        """Sentences of each text; words are learnt for many texts at once."""
        held: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            held.append(tokens(text))
            size += len(held[-1])
            if size >= limit or i == len(texts) - 1:
                self.learn(set().union(*held))
                for words in held:
                    yield self.sentences(words)
                held, size = [], 0


@dataclass
class Model:
    words: list[str]
    weights: np.ndarray  # on similarities: Nystroem map and machine together
    bias: float
    slope: float
    offset: float

    def margin(self, sentences: np.ndarray) -> float:
        """Decision value of a text: its worst sentence's, or that of an ordinary one."""
        return max(self.bias, float((sentences @ self.weights).max()) + self.bias) if len(sentences) else self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def unit_counts(rows: DataFrame) -> DataFrame:
    """``unit, toxic, ordinary``: numbers of labelled rows with each unit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for u in {u for w in set(tokens(text.as_py())) for u in units_of(w)}:
                    counts.setdefault(u, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
                 pa.array([c[0] for c in counts.values()], pa.int64())], names=["unit", "toxic", "ordinary"],
            )

    counted = rows.select("text", "y").mapInArrow(run, "unit string, toxic long, ordinary long")
    return counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def choose_landmarks(rows: DataFrame, s: ToxicSettings) -> tuple[list[str], int]:
    """Landmarks, toxic ones first, and how many of them are."""
    counts = stored(unit_counts(rows), "units")
    odds = (F.col("toxic") + 0.1) / (F.col("ordinary") + 1) * F.log1p("toxic")
    toxic = counts.where("toxic > 1").orderBy(F.desc(odds), "unit").limit(s.candidates).collect()
    plain = counts.where("ordinary > toxic").orderBy(F.desc("ordinary"), "unit").limit(s.candidates).collect()
    chosen: list[str] = []
    for r in toxic:
        if len(chosen) < s.landmarks and (not chosen or Landmarks(chosen, s).similar([r.unit]).max() < s.apart):
            chosen.append(r.unit)
    toxic_ones = len(chosen)
    if chosen and plain:
        near = Landmarks(chosen, s).similar([r.unit for r in plain]).max(axis=1)
        order = sorted(range(len(plain)), key=lambda i: (-near[i], plain[i].unit))
        chosen += [plain[i].unit for i in order[: s.ordinary]]
    return chosen, toxic_ones


def tells(similarity: np.ndarray, y: np.ndarray, s: ToxicSettings) -> bool:
    """Whether words like a landmark are rare in ordinary rows and too frequent in toxic ones to be chance."""
    like = similarity >= s.apart
    toxic, ordinary = (like & (y > 0)).sum(), (like & (y <= 0)).sum()
    return toxic >= 4 * ordinary and np.mean(y > 0) ** toxic <= s.chance


def nystroem(words: list[str], s: ToxicSettings) -> np.ndarray:
    """Inverse square root of the kernel among landmarks."""
    n = len(words)
    left = [w for w in words for _ in range(n)]
    k = kernel_of(left, words * n, s).reshape(n, n)
    own = np.sqrt(np.diag(k))
    value, vector = np.linalg.eigh(k / own[:, None] / own[None, :])
    return vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T


def train_machine(x: np.ndarray, y: np.ndarray, s: ToxicSettings) -> tuple[np.ndarray, float]:
    """Linear support vector machine by averaged stochastic subgradients; classes weigh alike."""
    rng = np.random.default_rng(s.seed)
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    w, mean, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for epoch in range(s.rounds):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            t += 1
            wrong = y[rows] * (x[rows] @ w) < 1
            g = -(x[rows][wrong] * (y[rows] * weight[rows])[wrong, None]).sum(axis=0) / len(rows)
            w -= (1 / np.sqrt(t)) * (g + s.penalty * w)
            if epoch >= s.rounds // 2:
                mean += w
    mean /= max(1, t - (s.rounds // 2) * max(1, len(x) // 256))
    return mean[:-1], float(mean[-1])


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins of training rows."""
    a, b = 1.0, 0.0
    goal = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y <= 0) + 2))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        r, v = p - goal, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[np.sum(v * margin * margin) + 1e-3, np.sum(v * margin)], [np.sum(v * margin), np.sum(v) + 1e-3]])
        step = np.linalg.solve(h, np.array([np.sum(r * margin) + 1e-3 * a, np.sum(r)]))
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return max(float(a), 1e-3), float(b)


def fit(rows: DataFrame, settings: ToxicSettings = ToxicSettings()) -> Model | None:
    """Train on labelled rows ``rows(id, text, y)``, a bounded number of them.

    Of each row the most suspicious sentences come to the driver as numbers,
    at most ``rows * sentences`` times the number of landmarks. None without
    rows of both labels or without landmarks.
    """
    s = settings
    words, toxic = choose_landmarks(rows, s)
    if not words:
        return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Landmarks(words, s))
        for batch in batches:
            out = []
            for x in reader.read(batch.column(1).to_pylist()):
                order = np.argsort(-x[:, :toxic].max(axis=1), kind="stable")[: s.sentences]
                out.append(x[order].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), batch.column(2)], names=["id", "x", "y"])

    seen = rows.select(F.col("id").cast("string").alias("id"), "text", "y").mapInArrow(run, "id string, x binary, y int")
    found = sorted(seen.collect(), key=lambda r: (r.id, bytes(r.x)))
    each = [np.frombuffer(r.x, dtype="<f4").reshape(-1, len(words)).astype(float) for r in found]
    y = np.array([1 if r.y == 1 else -1 for r in found])
    if len(set(y.tolist())) < 2:
        return None
    keep = [i for i in range(len(words)) if i >= toxic or tells(np.array([e[:, i].max(initial=0) for e in each]), y, s)]
    if not any(i < toxic for i in keep):
        return None
    words, each = [words[i] for i in keep], [e[:, keep] for e in each]
    space = nystroem(words, s)
    none = np.zeros((1, len(words)))
    each = [x if len(x) else none for x in each]
    # A toxic row's worst sentence is toxic; the next ones may be either and stay out.
    x = np.concatenate([e[:1] if label > 0 else e for e, label in zip(each, y, strict=True)])
    t = np.concatenate([[label] * (1 if label > 0 else len(e)) for e, label in zip(each, y, strict=True)])
    w, bias = train_machine(x @ space, t, s)
    weights = space @ w
    model = Model(words, weights, bias, 1.0, 0.0)
    model.slope, model.offset = calibrate(np.array([model.margin(e) for e in each]), y)
    return model


def is_held_out(id_col: Column) -> Column:
    return remainder(id_col, 5) == 0


def training_rows(
    docs: DataFrame, labels: DataFrame, held_out, s: ToxicSettings, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """A bounded number of labelled rows outside the held-out part, by a hash of the id."""
    key = F.col(f"`{id_col}`")
    known = (
        labels.select(key.alias("of"), F.col(f"`{label_col}`").cast("int").alias("y"))
        .where("of is not null and y in (0, 1)").groupBy("of").agg(F.max("y").alias("y"))
        .where(~held_out(F.col("of"))).orderBy(F.xxhash64("of"), "of").limit(s.rows)
    )
    texts = id_and_text(docs, id_col, text_col).withColumnRenamed(id_col, "id")
    return texts.join(F.broadcast(known), F.col("id") == F.col("of")).select("id", "text", "y")  # at most s.rows rows


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    is_held_out=is_held_out,
    settings: ToxicSettings = ToxicSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """Score every whole text; only the text is an input of a score.

    Returns one row per input row: the id, ``held_out``, ``score`` (0 to 1)
    and ``predicted`` (1 from 0.5 on). Labels of held-out ids are never read.
    Null and empty texts score as a text of ordinary sentences; so does every
    text, with 0, when there is nothing to learn from. Repeated rows stay;
    rows with a null id are scored and count as not held out, unless the hash
    of an empty id says so; other columns are not carried.
    """
    model = fit(training_rows(docs, labels, is_held_out, settings, id_col, text_col, label_col), settings)
    rows = id_and_text(docs, id_col, text_col)
    held = is_held_out(F.col(id_col)).alias("held_out")
    if model is None:
        return rows.select(id_col, held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Landmarks(model.words, settings))
        for batch in batches:
            margins = np.array([model.margin(x) for x in reader.read(batch.column(1).to_pylist())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(margins), pa.float64())], names=[id_col, "score"])

    scored = rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, score double")
    return scored.select(id_col, held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
