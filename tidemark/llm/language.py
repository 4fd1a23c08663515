"""Language identification in two steps: the family first, then the language within it.

Texts are counted as hashed n-grams of two and three bytes of their lower case form. Linear
support vector machines (squared hinge loss), one for each pair, vote: first between the
families of languages, then between the languages of the winning family only. A language
that is in no listed family is a family of its own.

Training takes the features of at most ``per_language`` rows of each language, those with
the smallest hashes of their id; the features, not the texts, go to the driver, and their
length is fixed. Prediction reads whole texts, in tasks that share nothing.

Rules for odd rows
    * A null text, or one without a letter, is ``und`` with score 0.
    * Rows with a null language or id are not learned from. Without a row to learn from
      every text is ``und``; with one language known, every text with a letter is that.
    * Rows of one language and key are learned from once, by the smallest of their texts.
    * Votes that tie go to the sum of margins, then to the smaller name.
    * Repeated rows are predicted each; extra columns are handed through, and a column
      with the name of a made one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.words import carried, handed_back

FEATURES = 1 << 13
LETTER = re.compile(r"[^\W\d_]")
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tt".split(),
    "indic": "hi bn mr ne pa gu ur".split(),
    "semitic": "ar he mt am".split(),
    "celtic": "ga cy gd br".split(),
    "baltic": "lt lv".split(),
}
FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members}


def features(text: str) -> np.ndarray:
    """Square roots of the n-grams' counts, scaled to length one."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8).astype(np.uint32)
    two = raw[:-1] << np.uint32(8) | raw[1:]
    three = two[:-1] << np.uint32(8) | raw[2:]
    counts = np.bincount((two * np.uint32(2654435761)) >> np.uint32(19), minlength=FEATURES)
    counts += np.bincount((three * np.uint32(2246822519)) >> np.uint32(19), minlength=FEATURES)
    row = np.sqrt(counts).astype(np.float32)
    return row / (np.linalg.norm(row) or 1)


def machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM for y of -1 and 1, by accelerated gradient steps."""
    weight = np.zeros(x.shape[1], dtype=np.float32)
    bias, ahead, ahead_bias = 0.0, weight.copy(), 0.0
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    for step in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead + ahead_bias)) * y * share
        new = ahead + 0.5 * (2 * (slack @ x) - penalty * ahead)
        new_bias = ahead_bias + 0.5 * 2 * float(slack.sum())
        speed = step / (step + 3)
        ahead, ahead_bias = new + speed * (new - weight), new_bias + speed * (new_bias - bias)
        weight, bias = new, new_bias
    return weight, bias


@dataclass
class Choice:
    """One-versus-one machines between names."""

    names: list[str]
    weights: np.ndarray
    biases: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> Choice:
        names = sorted(set(labels))
        weights, biases = [], []
        for a, b in combinations(names, 2):
            mine = np.isin(labels, [a, b])
            weight, bias = machine(x[mine], np.where(labels[mine] == a, 1, -1).astype(np.float32))
            weights.append(weight)
            biases.append(bias)
        return cls(names, np.array(weights).reshape(len(biases), x.shape[1]), np.array(biases))

    def pick(self, row: np.ndarray) -> tuple[str, float]:
        """The name with most votes, and how sure its closest pair is, from 0 to 1."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = self.weights @ row + self.biases
        n = len(self.names)
        votes, sums, least = np.zeros(n), np.zeros(n), np.full(n, np.inf)
        for (a, b), m in zip(combinations(range(n), 2), margins, strict=True):
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
            least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(range(n), key=lambda i: (votes[i], sums[i], -i))
        return self.names[best], float(1 / (1 + np.exp(-4 * least[best])))


@dataclass
class Identifier:
    """The families' choice and each family's own."""

    families: Choice | None
    within: dict[str, Choice]

    @classmethod
    def fit(cls, x: np.ndarray, languages: Sequence[str]) -> Identifier:
        if not len(languages):
            return cls(None, {})
        names = np.array(languages, dtype=object)
        families = np.array([FAMILY_OF.get(n, n) for n in names], dtype=object)
        within = {f: Choice.fit(x[families == f], names[families == f]) for f in sorted(set(families))}
        return cls(Choice.fit(x, families), within)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or self.families is None or not LETTER.search(text):
            return "und", 0.0
        row = features(text)
        family, sure = self.families.pick(row)
        language, surer = self.within[family].pick(row)
        return language, sure * surer


def fitted(rows: DataFrame, text: str, lang: str, key: Column, per_language: int = 500) -> Identifier:
    """An identifier learned from at most ``per_language`` rows of each language, smallest ``key`` first."""
    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), key.alias("key")).where(
        "lang IS NOT NULL AND text IS NOT NULL AND key IS NOT NULL"
    )
    # Keys are ranked without their texts; at most per_language of them a language meet the texts.
    order = Window.partitionBy("lang").orderBy("key")
    keys = (
        known.select("lang", "key")
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_language)
        .drop("place")
    )
    picked = known.join(F.broadcast(keys), ["lang", "key"], "left_semi").groupBy("lang", "key").agg(
        F.min("text").alias("text")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(k, t) for k, t in zip(batch["lang"], batch["text"], strict=True) if LETTER.search(t)]
            yield pd.DataFrame({"lang": [k for k, _ in found], "x": [features(t).tobytes() for _, t in found]})

    got = picked.select("text", "lang").mapInPandas(count, "lang string, x binary").collect()
    got.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.frombuffer(b"".join(bytes(r.x) for r in got), dtype=np.float32).reshape(len(got), FEATURES)
    return Identifier.fit(x, [r.lang for r in got])


def predicted(docs: DataFrame, model: Identifier, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Each document with ``lang_pred`` and ``score``."""
    names = docs.columns if carry is None else list(carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    rows = docs.select(carried(docs, carry), predict(docs[text].cast("string")).alias("p"))
    return handed_back(rows, names, {"lang_pred": F.col("p.lang_pred"), "score": F.col("p.score")})
