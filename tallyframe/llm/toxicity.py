"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel of two words counts common subsequences of three letters, each
weighted by ``DECAY`` to the power of the letters it stretches over (at most
``REACH``), and is divided by a function of the words' lengths.  A letter put
into an insult, or a suffix, costs part of the weight only.

Training reads a bounded sample of labelled documents (``MOST_TOXIC`` and
``MOST_CLEAN``, by hash of the id) and minimises the loss of their labels (a
multiple-instance SVM): a document's margin is that of its worst word, so a toxic
document pulls its worst word up and a clean one pushes its worst words down, whatever
they are.  Each round Spark finds the worst words under the weights so far, the
words found join those to train on, and the SVM is solved again.  The first
words of toxic documents are those that hold pieces of four to seven letters tied
to toxic documents; Spark counts in how many different surroundings a word stands,
so copies of a document count once.  No word is left out for its length or rank.
Landmarks from both sides give the Nyström features, and since the kernel is a
sum over subsequences, the weights are folded into one table of three-letter
weights.  Scoring a word is then a sum of table entries.

A document's margin is that of its worst word; runs of single letters ("i d i o
t") are read as one word too.  The margins of the sample's documents fix the
threshold.  Every text is scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import byte_slices, give_back, stored

#: Bounds of the training sample (labelled documents): the only bound on what is learnt from.
MOST_TOXIC, MOST_CLEAN = 2_500, 5_000
#: Nyström landmarks, rounds of training, and words that a clean document shows in a round.
LANDMARKS, ROUNDS, SHOWN = 384, 5, 2
#: Letters that are told apart, those that insults use most (their cube is the table of weights); all others count as one.
MOST_LETTERS = 120
#: Fixed values of the kernel: weight of each letter that a subsequence stretches over, and the most letters.
DECAY, REACH = 0.7, 7
#: Pieces of so many letters mark insults from this log-likelihood ratio on, if they stand in toxic documents so much oftener.
PIECES, EVIDENCE, PURITY = (4, 5, 6, 7), 12.0, 4
FOLDS = 5
_EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…*_-"
_SPELLED = re.compile(r"(?<!\S)\w(?:[ .*_-]+\w(?!\w)){3,}(?!\S)")
_WIDTH, _STRIDE = 24, 24 - REACH
_STEPS = [(a, b) for b in range(2, REACH) for a in range(1, b)]


def _lengths_norm(length: np.ndarray) -> np.ndarray:
    """Root of the squared weights of all subsequences of a word of so many letters (edges counted)."""
    total = np.zeros(len(length))
    for _, b in _STEPS:
        total += np.maximum(length - b, 0) * DECAY ** (2 * b)
    return np.sqrt(np.maximum(total, DECAY ** 4))


def _rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words between edge marks, long ones in pieces that overlap by what a subsequence can reach; each row's word."""
    owner, rows = [], []
    for n, word in enumerate(words):
        marked = f"\x02{word}\x03"
        starts = range(0, max(1, len(marked) - REACH), _STRIDE) if len(marked) > _WIDTH else (0,)
        for at in starts:
            owner.append(n)
            rows.append(marked[at:at + _WIDTH])
    return np.array(rows, f"U{_WIDTH}"), np.array(owner, int)


@dataclass
class Model:
    """Three-letter weights, the alphabet they are over, and the threshold."""

    letters: np.ndarray  # code point -> letter number; 0 is padding, 1 any other
    size: int
    weights: np.ndarray
    threshold: float
    slope: float

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letter numbers of the words between edge marks, in rows of ``_WIDTH``; each row's word and its letters."""
        text, owner = _rows(words)
        points = text.view("u4").reshape(len(text), _WIDTH) if len(text) else np.empty((0, _WIDTH), "u4")
        length = np.char.str_len(text) if len(text) else np.empty(0, int)
        return self.letters[np.minimum(points, len(self.letters) - 1)], owner, length

    def row_margins(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Margin and word of each row of ``codes``."""
        codes, owner, length = self.codes(words)
        out = np.zeros(len(owner))
        for lo, hi in ((0, 8), (8, 12), (12, 16), (16, _WIDTH)):
            some = np.flatnonzero((length > lo) & (length <= hi))
            for part in np.array_split(some, len(some) // 20_000 + 1):
                x = codes[part][:, :hi].astype("i4")
                total = np.zeros(len(part), "f4")
                for a, b in _STEPS:
                    at = (x[:, :hi - b] * self.size + x[:, a:hi - b + a]) * self.size + x[:, b:]
                    total += self.weights[at].sum(1, dtype="f4") * np.float32(DECAY ** b)
                out[part] = total / _lengths_norm(length[part])
        return out, owner

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word (of a long one, its worst piece)."""
        out = np.full(len(words), -np.inf)
        margin, owner = self.row_margins(words)
        np.maximum.at(out, owner, margin)
        return out

    def worst_pieces(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """Margin of each word and the piece that has it (the word itself, unless it is long)."""
        margin, owner = self.row_margins(words)
        order = np.lexsort((-margin, owner))
        first = order[np.unique(owner[order], return_index=True)[1]]
        text, _ = _rows(words)
        return margin[first], [str(t).strip("\x02\x03") for t in text[first]]

    def scores(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin - self.threshold), -30, 30)))


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased words of some texts, each word's number in order of position, and the texts' bounds."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    coded = pc.utf8_trim(split.flatten(), characters=_EDGES).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()


def spelled_words(text: str | None) -> list[str]:
    """Words written as single letters with gaps."""
    return [re.sub(r"\W|_", "", run).lower() for run in _SPELLED.findall(text or "")]


def document_margins(model: Model, texts: pa.Array) -> np.ndarray:
    """Margin of each text's worst word; a text without words has the lowest."""
    words, number, bounds = words_of(texts)
    by_word = model.margins(words)
    out = np.full(len(texts), -10.0)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if len(filled):
        out[filled] = np.maximum.reduceat(by_word[number], bounds[filled])
    for n, text in enumerate(texts.to_pylist()):
        if spelled := spelled_words(text):
            out[n] = max(out[n], model.margins(spelled).max())
    return np.maximum(out, -10.0)


def held_out(id_col: str) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``body, toxic`` of the labelled documents to learn from, a bounded number of either class."""
    known = labels.select(F.col(id_col).alias("labelled"), F.col(label_col).alias("toxic")).where("labelled is not null and toxic in (0, 1)").where(~held_out("labelled"))
    draw = F.xxhash64(F.col("labelled").cast("string"))
    some = [known.where(F.col("toxic") == v).dropDuplicates(["labelled"]).orderBy(draw, "labelled").limit(n) for v, n in ((1, MOST_TOXIC), (0, MOST_CLEAN))]
    chosen = F.broadcast(some[0].union(some[1]))  # at most MOST_TOXIC + MOST_CLEAN rows of two numbers
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return texts.join(chosen, F.col("id") == F.col("labelled")).select("body", "toxic")


def _words(sample: DataFrame) -> DataFrame:
    """``doc, toxic, w``: the words of each different text of the sample."""
    trimmed = F.transform(F.split(F.lower("body"), r"\s+"), lambda w: F.btrim(w, F.lit(_EDGES)))
    return sample.select(F.xxhash64("body").alias("doc"), "toxic", F.filter(trimmed, lambda w: w != "").alias("w"))


def _surroundings(words: DataFrame) -> DataFrame:
    """``word, t, c``: the different neighbourhoods a word stands in, by class."""
    near = F.transform(F.col("w"), lambda x, i: F.struct(x.alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("near")))
    places = words.select("toxic", F.explode(near).alias("p")).select("toxic", "p.word", "p.near").distinct()
    return places.groupBy("word").agg(F.sum("toxic").cast("long").alias("t"), F.sum(1 - F.col("toxic")).cast("long").alias("c"))


def _pieces(words: DataFrame) -> DataFrame:
    """``word, t, c, piece`` for the different pieces of each word, its beginning marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                some = batch.slice(lo, 2000)
                at, out = [], []
                for n, word in enumerate(some.column(0).to_pylist()):
                    marked = f"\x02{word}"
                    own = {marked[i:i + k] for k in PIECES for i in range(max(1, len(marked) - k + 1))}
                    at += [n] * len(own)
                    out += own
                rows = some.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.string())], names=["word", "t", "c", "piece"])

    return words.select("word", "t", "c").mapInArrow(run, "word string, t long, c long, piece string")


def first_insults(sample: DataFrame) -> list[tuple[str, int]]:
    """One word for each toxic document that has a word with a telling piece, and how many documents gave it."""
    docs = _words(sample)
    words = stored(_surroundings(docs), "toxic-words")
    toxic, clean = (1 + (n or 0) for n in words.agg(F.sum("t"), F.sum("c")).first())
    share = toxic / (toxic + clean)
    own = F.col("t") / (F.col("t") + F.col("c"))
    evidence = F.col("t") * F.log(own / share) + F.when(F.col("c") > 0, F.col("c") * F.log((1 - own) / (1 - share))).otherwise(0)
    sums = [F.sum("t").alias("t"), F.sum("c").alias("c")]
    # a piece needs so many places in toxic documents at the least
    often = _pieces(words.where("t > c")).groupBy("piece").agg(*sums).where((F.col("t") > PURITY * F.col("c")) & (evidence >= EVIDENCE)).select("piece")
    often = stored(often, "toxic-often")  # a small file, so that the planner need not shuffle the pieces of all words
    marks = _pieces(words).join(often, "piece").groupBy("piece").agg(*sums).where((F.col("t") > PURITY * F.col("c")) & (evidence >= EVIDENCE))
    marks = stored(marks.select("piece", evidence.alias("evidence")), "toxic-marks")
    insults = _pieces(words.where(f"t > {PURITY} * c")).join(marks, "piece").groupBy("word").agg(F.max("evidence").alias("evidence"))
    stand = docs.where("toxic = 1").select("doc", F.explode(F.array_distinct("w")).alias("word"))
    one = stand.join(insults, "word").groupBy("doc").agg(F.max_by("word", F.struct("evidence", "word")).alias("word"))
    return [(r.word, r.n) for r in one.groupBy("word").agg(F.count("*").alias("n")).collect()]


def first_others(sample: DataFrame) -> list[str]:
    """One word of each clean document, drawn by hash."""
    drawn = F.array_min(F.transform("w", lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("word"))))
    rows = _words(sample.where("toxic = 0")).where("size(w) > 0").select(drawn["word"].alias("word")).distinct().collect()
    return sorted((r.word for r in rows), key=lambda w: (zlib.crc32(w.encode()), w))


def alphabet(insults: list[str]) -> list[str]:
    """Letters of the insults (the most used, ties by code point) and of Latin, in order."""
    used = Counter(c for w in insults for c in w)
    latin = "abcdefghijklmnopqrstuvwxyz*.-"
    return sorted(sorted(set(latin) | set(used), key=lambda c: (-used[c], c))[:MOST_LETTERS])


def numbered(letters: list[str]) -> np.ndarray:
    """Letter number by code point; the last entry stands for all beyond."""
    numbers = np.ones(max(map(ord, letters)) + 2, "u1")
    numbers[[0, 2, 3]] = 0, 2, 3
    numbers[[ord(c) for c in letters]] = np.arange(len(letters)) + 4
    return numbers


def _varied(words: list[str]) -> list[str]:
    """The words, and with a strange letter put in or a letter doubled at every third place."""
    out = list(words)
    for n, word in enumerate(words):
        for i in range(1 + n % 3, len(word), 3):
            out += [word[:i] + "*.-x"[(n + i) % 4] + word[i:], word[:i] + word[i - 1] + word[i:]]
    return out


class Explicit:
    """Subsequence weights of words over the subsequences that the landmarks have."""

    def __init__(self, model: Model, landmarks: list[str]):
        self.model = model
        self.found = np.unique(np.concatenate([at[real] for _, at, real, _ in self._subsequences(landmarks)]))
        self.landmarks = self.rows(landmarks)

    def _subsequences(self, words: list[str]) -> Iterator[tuple]:
        codes, owner, length = self.model.codes(words)
        x, size = codes.astype("i8"), self.model.size
        self.norm = _lengths_norm(np.bincount(owner, length, len(words)))
        for a, b in _STEPS:
            at = (x[:, :_WIDTH - b] * size + x[:, a:_WIDTH - b + a]) * size + x[:, b:]
            yield np.broadcast_to(owner[:, None], at.shape), at, x[:, b:] > 0, DECAY ** b

    def rows(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.found)), "f4")
        for row, at, real, weight in self._subsequences(words):
            column = np.minimum(np.searchsorted(self.found, at), len(self.found) - 1)
            hit = real & (self.found[column] == at)
            np.add.at(out, (row[hit], column[hit]), weight)
        return out / self.norm[:, None]

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel values with the landmarks."""
        parts = [self.rows(words[lo:lo + 500]) @ self.landmarks.T for lo in range(0, len(words), 500)]
        return np.concatenate(parts or [np.empty((0, len(self.landmarks)))]).astype("f8")


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 30.0) -> np.ndarray:
    """Linear SVM (squared hinge loss, bias as last column, not shrunk) by Newton steps on the rows inside the margin."""
    shrunk = np.append(np.ones(x.shape[1] - 1), 1e-6) / cost

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        short = np.maximum(0, 1 - y * (x @ w.astype(x.dtype)))
        return float(w @ (shrunk * w) + (weight * short * short).sum()), short

    w = np.zeros(x.shape[1])
    now, short = loss(w)
    for _ in range(60):
        inside = np.flatnonzero(short > 0)
        xa, wa = x[inside].astype("f8"), weight[inside]
        slope = shrunk * w - xa.T @ (wa * y[inside] * short[inside])
        step = np.linalg.solve((xa.T * wa) @ xa + np.diag(shrunk), slope)
        size = 1.0
        while size > 1e-4:
            then, at = loss(w - size * step)
            if then < now:
                break
            size /= 2
        else:
            break
        gain, w, now, short = now - then, w - size * step, then, at
        if gain < 1e-7 * now:
            break
    return w


def _solved(model: Model, insults: list[str], others: list[str], near: list[str]) -> float:
    """Fold the weights learnt from both sorts of words into the model; the margin that parts them."""
    marks = insults[:LANDMARKS // 2] + near[:LANDMARKS // 3]
    marks = list(dict.fromkeys(marks + others))[:LANDMARKS]
    explicit = Explicit(model, marks)
    values, vectors = np.linalg.eigh(explicit.kernel(marks))
    kept = values > 1e-6 * values[-1]
    root = vectors[:, kept] / np.sqrt(values[kept])
    positive = list(dict.fromkeys(_varied(insults)))
    y = np.array([1.0] * len(positive) + [-1.0] * len(others))
    x = np.vstack([np.hstack([explicit.kernel(some) @ root, np.ones((len(some), 1))]).astype("f4") for some in (positive, others)])
    w = _svm(x, y, np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * max(1, len(others)))))
    model.weights[:] = 0
    model.weights[explicit.found] = (root @ w[:-1]) @ explicit.landmarks
    return -w[-1]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled rows outside the held-out fold.

    Without an insult to start from (no labels, or none tied to any words) the model
    gives every text the same score of almost 0.
    """
    sample = training_sample(docs, labels, id_col, text_col, label_col).cache()
    try:
        first = dict(first_insults(sample))
        insults = sorted(first, key=lambda w: (-first[w], w))
        letters = alphabet(insults)
        model = Model(numbered(letters), len(letters) + 4, np.zeros((len(letters) + 4) ** 3, "f4"), 0.0, 1.0)
        if not insults:
            model.threshold = 30.0
            return model
        others, near = first_others(sample), []
        for again in range(ROUNDS):
            bias = _solved(model, insults, others, near)
            shown = worst_words(sample, model)
            if again == ROUNDS - 1:
                break
            clean = {w: m for w, m, toxic, _ in shown if toxic == 0}
            near = sorted((w for w, m in clean.items() if w and m > bias - 1), key=lambda w: (-clean[w], w))
            others = list(dict.fromkeys(others + near))
            if clean:  # a toxic document's worst word speaks for it if few clean documents have one like it
                level = np.quantile([m for _, m, toxic, nth in shown if toxic == 0 and nth == 0], 0.9)
                found = Counter(w for w, m, toxic, nth in shown if toxic == 1 and nth == 0 and m > level and w not in clean)
                insults = sorted(found, key=lambda w: (-found[w], w)) or insults
            others = [w for w in others if w in clean or w not in set(insults)]
        model.threshold, model.slope = _threshold(np.array([(m, toxic) for _, m, toxic, nth in shown if nth == 0], "f8").reshape(-1, 2), bias)
        return model
    finally:
        sample.unpersist()


def worst_words(sample: DataFrame, model: Model) -> list[tuple[str, float, int, int]]:
    """``word, margin, toxic, nth`` of each document's ``SHOWN`` worst words (an empty one of margin -10, if it has none)."""
    def shown(bodies: pa.Array, labels: list[int]) -> list[tuple]:
        words, number, bounds = words_of(bodies)
        margin, piece = model.worst_pieces(words)
        out = []
        for n, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            own = np.unique(number[lo:hi])
            own = own[np.argsort(-margin[own], kind="stable")[:SHOWN]]
            worst = [(float(margin[i]), piece[i]) for i in own]
            if spelled := spelled_words(bodies[n].as_py()):
                worst = sorted(worst + list(zip(*model.worst_pieces(spelled), strict=True)), key=lambda p: -p[0])[:SHOWN]
            out += [(w, max(float(m), -10.0), labels[n], nth) for nth, (m, w) in enumerate(worst or [(-10.0, "")])]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column(0), 4_000_000):
                part = batch.slice(lo, hi - lo)
                columns = zip(*shown(part.column(0), part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.int32(), pa.int32()), strict=True)], names=["word", "margin", "toxic", "nth"])
        give_back()

    rows = sample.mapInArrow(run, "word string, margin double, toxic int, nth int").collect()
    return sorted((r.word, r.margin, r.toxic, r.nth) for r in rows)


def _threshold(margins: np.ndarray, default: float) -> tuple[float, float]:
    """The cut with fewest errors of both classes, in the middle of its gap, and the slope that the gap allows."""
    m = margins[np.argsort(margins[:, 0], kind="stable")]
    if not 0 < m[:, 1].sum() < len(m):
        return default, 4.0
    wrong = np.concatenate(([0], np.cumsum(m[:, 1] == 1))) / m[:, 1].sum() + np.concatenate((np.cumsum((m[:, 1] == 0)[::-1])[::-1], [0])) / (m[:, 1] == 0).sum()
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    best = best[(best > 0) & (best < len(m))]
    if not len(best):
        return default, 4.0
    gaps = m[best, 0] - m[best - 1, 0]
    at = best[np.argmax(gaps)]
    return float((m[at, 0] + m[at - 1, 0]) / 2), float(min(50, 4 / max(gaps.max(), 0.08)))


def annotated(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``held_out, score, predicted`` (in place of columns of these names).

    A null or empty text, or one without words, has the lowest score.  The
    score depends on the text alone; repeated rows come back as often as they
    stand there, a null id counts as not held out.
    """
    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(*own, held_out(id_col).alias("held_out"))
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = own.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column(at), 4_000_000):
                some = batch.slice(lo, hi - lo)
                value = model.scores(document_margins(model, some.column(at)))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(value), pa.array((value >= 0.5).astype("i4"))], names=schema.names)
        give_back()

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, held_out, score, predicted``, as ``annotated`` gives them."""
    return annotated(docs.select(id_col, text_col), model, id_col, text_col).drop(text_col)
