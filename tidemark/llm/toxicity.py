"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: of the words and word beginnings of four to six signs in the
labelled texts those that stand in toxic ones far more often than chance (log-likelihood
ratio) are kept, in two grades of purity. Features of a whole text are the densities of
both grades, how many hits have a second person word near, capitals, punctuation,
obfuscated and stretched words. Trees are fitted on a part of the labelled rows by
gradient boosting of the logistic loss over binned features; the rest calibrates them.

Learning takes at most ``max_rows`` labelled rows, those with the smallest hashes of
their id. Words are counted in Spark; the driver gets the kept lexicon, at most
``max_lexicon`` entries, and the features, a fixed number for each row. Scoring reads
whole texts, in tasks that share nothing.

Rules for odd rows
    * Null and empty texts get the score of a text without a word, like any other.
    * Rows with a null label or id are not learned from; labels without a document, and
      documents without a label, are left out of learning. With labels of one kind only,
      every score is that kind; without labels it is 0.
    * Rows that repeat are scored each; extra columns are handed through, and a column
      with the name of a made one is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import carried, handed_back, text_of
from tidemark.session import stored

WORD = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_][0-9@$*!]+[^\W\d_]")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
BEGINNINGS = (4, 5, 6)
NEAR = 5
# Second person words of the languages in view.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos"
    " tú ti tus usted ustedes vosotros".split()
)


@dataclass(frozen=True)
class Settings:
    max_rows: int = 10_000
    max_lexicon: int = 4_000
    min_docs: int = 4
    min_ratio: float = 20.0
    trees: int = 60
    depth: int = 3
    rate: float = 0.15
    bins: int = 32
    calibration_share: float = 0.3


def forms(words: set[str]) -> set[str]:
    """The words, and their beginnings marked by a star."""
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) >= n}


@dataclass
class Lexicon:
    """Grade 2: found in toxic texts nearly alone; grade 1: mostly."""

    grades: dict[str, int]
    seen: dict[str, int] = field(default_factory=dict)

    def grade(self, word: str) -> int:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            found = max((self.grades.get(f, 0) for f in forms({word})), default=0)
            self.seen[word] = found
        return found

    def features(self, text: str) -> list[float]:
        words = WORD.findall(text.lower())
        n = max(1, len(words))
        grades = [self.grade(w) for w in words]
        hits = [i for i, g in enumerate(grades) if g]
        strong = sum(g == 2 for g in grades)
        near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
        signs = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
        size = max(1, int(signs.sum()))
        capitals, small = int(signs[65:91].sum()), int(signs[97:123].sum())
        marks = int(signs[33] + signs[63])
        punctuation = int(signs[33:48].sum() + signs[58:65].sum())
        return [
            float(strong),
            float(len(hits) - strong),
            strong / n,
            (len(hits) - strong) / n,
            near / max(1, len(hits)),
            sum(w in SECOND_PERSON for w in words) / n,
            capitals / max(1, capitals + small),
            marks / size,
            punctuation / size,
            len(OBFUSCATED.findall(text)) / n,
            len(STRETCHED.findall(text)) / n,
            float(np.log1p(len(words))),
        ]


@dataclass
class Trees:
    """Boosted trees of equal depth; node i has the children 2 i + 1 and 2 i + 2."""

    base: float
    cuts: list[np.ndarray]
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)
        return self.base + sum(self._tree(binned, *t) for t in self.nodes)

    def _tree(self, binned: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[np.arange(len(binned)), feature[at]] > cut[at])
        return value[at]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, settings: Settings) -> Trees:
        rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        marks = np.linspace(0, 1, settings.bins + 1)[1:-1]
        cuts = [np.unique(np.quantile(np.unique(x[:, f]), marks, method="lower")) for f in range(x.shape[1])]
        model = cls(float(np.log(rate / (1 - rate))), cuts, [], settings.depth)
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), model.base)
        for _ in range(settings.trees):
            p = 1 / (1 + np.exp(-score))
            tree = cls._grow(binned, p - y, p * (1 - p), settings)
            model.nodes.append(tree)
            score += model._tree(binned, *tree)
        return model

    @staticmethod
    def _grow(binned: np.ndarray, g: np.ndarray, h: np.ndarray, settings: Settings):
        size = 2 ** (settings.depth + 1) - 1
        feature, cut, value = np.zeros(size, np.int64), np.full(size, settings.bins, np.int64), np.zeros(size)
        at = np.zeros(len(g), dtype=np.int64)
        for level in range(settings.depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(at == node)
                if not len(mine):
                    continue
                best = 1e-6
                whole = g[mine].sum() ** 2 / (h[mine].sum() + 1)
                for f in range(binned.shape[1]):
                    b = binned[mine, f]
                    left_g = np.cumsum(np.bincount(b, g[mine], settings.bins + 1))[:-1]
                    left_h = np.cumsum(np.bincount(b, h[mine], settings.bins + 1))[:-1]
                    right_g, right_h = g[mine].sum() - left_g, h[mine].sum() - left_h
                    gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - whole
                    gain[(left_h < 0.1) | (right_h < 0.1)] = 0
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], f, k
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        for leaf in range(2**settings.depth - 1, size):
            mine = at == leaf
            value[leaf] = -settings.rate * g[mine].sum() / (h[mine].sum() + 1)
        return feature, cut, value


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising step function closest to y, by pooling neighbours that fall."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        pools.append([b, 1.0, a, a])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            v, n, _, top = pools.pop()
            last = pools[-1]
            last[0] = (last[0] * last[1] + v * n) / (last[1] + n)
            last[1] += n
            last[3] = top
    at = np.array([p for pool in pools for p in (pool[2], pool[3])])
    return at, np.array([v for pool in pools for v in (pool[0], pool[0])])


@dataclass
class Scorer:
    lexicon: Lexicon
    trees: Trees | None
    at: np.ndarray
    value: np.ndarray
    constant: float = 0.0

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        x = np.array([self.lexicon.features(t) for t in texts], dtype=np.float64).reshape(len(texts), -1)
        return np.clip(np.interp(self.trees.raw(x), self.at, self.value), 0, 1) if len(texts) else np.empty(0)


def fitted(
    docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", settings: Settings = Settings(),
) -> Scorer:
    """A scorer learned from the labels of rows where ``learn``, an expression of ``doc_id``, holds."""
    marked = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(learn)
        .where("y IS NOT NULL AND doc_id IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(settings.max_rows)
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_of(docs[text]).alias("text"))
    # At most max_rows rows of 12 bytes are sent to the tasks that read the texts.
    rows = stored(texts.join(F.broadcast(marked), "doc_id").select("doc_id", "text", "y"), "toxic-sample")
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), sum(n for y, n in totals.items() if y != 1)
    if not toxic or not clean:
        return Scorer(Lexicon({}), None, np.empty(0), np.empty(0), float(bool(toxic)))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for body, y in zip(batch["text"], batch["y"], strict=True):
                counts[int(y == 1)].update(forms(set(WORD.findall(body.lower()))))
            keys = list(counts[0].keys() | counts[1].keys())
            yield pd.DataFrame({"form": keys, "bad": [counts[1][k] for k in keys], "good": [counts[0][k] for k in keys]})

    found = (
        rows.select("text", "y")
        .mapInPandas(tally, "form string, bad long, good long")
        .groupBy("form")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(F.col("bad") >= settings.min_docs)
    )
    both, part = F.col("bad") + F.col("good"), toxic / (toxic + clean)
    ratio = 2 * (
        F.col("bad") * F.log(F.col("bad") / (both * part))
        + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (both * (1 - part)))).otherwise(0)
    )
    kept = (
        found.withColumn("ratio", ratio)
        .withColumn("odds", F.col("bad") / toxic / ((F.col("good") + 0.5) / clean))
        .where((F.col("ratio") >= settings.min_ratio) & (F.col("odds") >= 5))
        .orderBy(F.desc("ratio"), "form")
        .limit(settings.max_lexicon)
        .collect()
    )
    lexicon = Lexicon({r.form: 2 if r.odds >= 25 else 1 for r in kept})
    measured = _measured(rows, lexicon).collect()
    measured.sort(key=lambda r: (r.part, r.doc_id, r.y))
    x = np.array([r.x for r in measured], dtype=np.float64)
    y = np.array([float(r.y == 1) for r in measured])
    fit = np.array([r.part >= settings.calibration_share * 1000 for r in measured])
    if not 0 < y[fit].sum() < fit.sum():
        fit[:] = True
    held = ~fit if 0 < y[~fit].sum() < (~fit).sum() else fit
    trees = Trees.fit(x[fit], y[fit], settings)
    at, value = isotonic(trees.raw(x[held]), y[held])
    return Scorer(lexicon, trees, at, value)


def _measured(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.features(t) for t in texts], dtype=object)

    return rows.select("doc_id", "y", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1000)).alias("part"), measure("text").alias("x"))


def scored(docs: DataFrame, model: Scorer, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Each document with ``score`` and ``predicted``."""
    names = docs.columns if carry is None else list(carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()))

    rows = docs.select(carried(docs, carry), score(text_of(docs[text])).alias("s"))
    return handed_back(rows, names, {"score": F.col("s"), "predicted": (F.col("s") >= 0.5).cast("int")})
