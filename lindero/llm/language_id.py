"""Language identification in two steps: the family first, then its closely related languages among themselves.

Each step is a set of one-versus-one linear support vector machines over hashed character n-grams of the whole text.
Between families the machines see every language of both; within a family they separate its languages pair by pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, limit_batches, schema_of

#: Families of languages by code (fixed values); any other language is a family of its own.
FAMILIES = {
    "romance": "fr es it pt ro ca gl oc",
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi ur bn mr gu pa ne",
    "semitic": "ar he mt am",
}
FAMILY_OF = {lang: name for name, langs in FAMILIES.items() for lang in langs.split()}
UNDETERMINED = "und"

#: Hashed features, and the most labelled rows a classifier is fitted on: so many of each language, so many in all.
DIMENSIONS, ROWS_PER_LANGUAGE, ROWS_IN_ALL = 1 << 13, 500, 3000
_LETTER = re.compile(r"[^\W\d_]")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): square roots of the frequencies of 1- to 3-grams of the lower-cased text, of length 1.

    Characters that are not letters count as one word end. All of the text is read.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0)
    plain = codes.copy()
    plain[(codes < 0x41) | ((codes > 0x5A) & (codes < 0x61)) | ((codes > 0x7A) & (codes < 0xAA))] = 32
    counts = np.zeros(DIMENSIONS, np.int64)
    h = np.zeros(len(plain), np.uint32)
    for n in range(1, 4):
        if n > len(plain):
            break
        h = h[: len(plain) - n + 1] * np.uint32(0x01000193) + plain[n - 1 :] + np.uint32(n)
        mixed = h * np.uint32(0x9E3779B1)
        counts += np.bincount(mixed >> np.uint32(32 - 13), minlength=DIMENSIONS)
    at = np.flatnonzero(counts)
    values = np.sqrt(counts[at])
    return at, values / np.sqrt(counts[at].sum())


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with squared hinge loss for labels -1 and 1, by conjugate
    gradients on the rows inside the margin (a Newton method; each round solves for the rows that count now)."""
    d = x.shape[1]
    w = np.zeros(d + 1, x.dtype)  # all in the precision of x, so that no step copies x into another
    y = y.astype(x.dtype)
    cost = (np.where(y > 0, penalty / max(1, (y > 0).sum()), penalty / max(1, (y < 0).sum())) * 100).astype(x.dtype)

    def margins(w: np.ndarray) -> np.ndarray:
        return y * (x @ w[:-1] + w[-1])

    def loss(w: np.ndarray) -> float:
        return 0.5 * w @ w + 0.5 * (cost * np.maximum(0, 1 - margins(w)) ** 2).sum()

    for _ in range(rounds):
        active = margins(w) < 1
        xa, ya, ca = x[active], y[active], cost[active]
        error = ca * (xa @ w[:-1] + w[-1] - ya)
        gradient = w + np.append(xa.T @ error, error.sum())
        step = np.zeros(d + 1, x.dtype)
        residual = -gradient
        direction, norm = residual.copy(), residual @ residual
        if norm < 1e-6:
            break
        for _ in range(20):
            t = ca * (xa @ direction[:-1] + direction[-1])
            curved = direction + np.append(xa.T @ t, t.sum())
            a = norm / (direction @ curved)
            step += a * direction
            residual -= a * curved
            after = residual @ residual
            if after < 1e-4 * (gradient @ gradient):
                break
            direction, norm = residual + after / norm * direction, after
        scale, before = 1.0, loss(w)
        while scale > 1e-4 and loss(w + x.dtype.type(scale) * step) > before:
            scale /= 2
        if scale <= 1e-4:
            break
        w = w + x.dtype.type(scale) * step
    return w


@dataclass
class Votes:
    """One-versus-one machines over ``names``."""

    names: list[str]
    machines: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> Votes:
        names = sorted(set(labels.tolist()))
        out = cls(names)
        for i, j in combinations(range(len(names)), 2):
            own = (labels == names[i]) | (labels == names[j])
            out.machines[i, j] = svm(x[own], np.where(labels[own] == names[i], 1.0, -1.0)).astype(np.float32)
        return out

    def chances(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """A share for each name: the mean of its chances against each other one, which a logistic curve gives."""
        share = np.zeros(len(self.names))
        for (i, j), w in self.machines.items():
            p = 1 / (1 + np.exp(-4 * float(w[at] @ values + w[-1])))
            share[i] += p
            share[j] += 1 - p
        return share / share.sum() if share.sum() else np.ones(len(self.names)) / max(1, len(self.names))


@dataclass
class Hierarchy:
    families: Votes
    languages: dict[str, Votes]

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray, family_of: dict[str, str] = FAMILY_OF) -> Hierarchy:
        family = np.array([family_of.get(l, l) for l in labels.tolist()], object)
        within = {f: Votes.fit(x[family == f], labels[family == f]) for f in sorted(set(family.tolist()))}
        return cls(Votes.fit(x, family), within)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families.names or not text or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        at, values = features(text)
        shares = self.families.chances(at, values)
        best = int(shares.argmax())
        inner = self.languages[self.families.names[best]]
        chances = inner.chances(at, values)
        return inner.names[int(chances.argmax())], float(min(1.0, max(0.0, shares[best] * chances.max())))


def fit(docs: DataFrame, learn: Column, per_language: int = ROWS_PER_LANGUAGE, in_all: int = ROWS_IN_ALL) -> Hierarchy:
    """A classifier from the rows of ``docs`` (text, lang) for which ``learn`` holds and lang and text are not null.

    Of each language at most ``per_language`` rows are used (fewer if there are many languages: ``in_all`` in all),
    those with the smallest hash of their text; only they are gathered. Without labelled rows every text is ``und``.
    """
    own = limit_batches(docs).filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = own.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(in_all // 2).collect()
    if not sizes:
        return Hierarchy(Votes([]), {})
    bound = max(2, min(per_language, in_all // len(sizes)))
    # A slice of the hash range that holds about 1.3 times the rows wanted of each language, cut to the bound on the driver.
    share = F.create_map(*[x for row in sizes for x in (F.lit(row["lang"]), F.lit(min(1.0, 1.3 * bound / row["count"] + 20 / row["count"])))])[F.col("lang")]
    place = (F.pmod(F.xxhash64(F.lit(17), "text"), F.lit(1 << 30)) / float(1 << 30)).alias("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))], names=["lang", "place", "at", "weight"])

    rows = own.select("lang", place, "text").filter(F.col("place") < share).dropDuplicates(["lang", "place"]).mapInArrow(frugal(run), schema_of("lang string, place double, at array<int>, weight array<float>")).toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("place", "ascending")])
    labels = rows.column("lang").to_pylist()
    number: dict[str, int] = {}
    keep = [i for i, lang in enumerate(labels) if (number.__setitem__(lang, number.get(lang, 0) + 1) or number[lang]) <= bound]
    x = np.zeros((len(keep), DIMENSIONS), np.float32)
    at, weight = rows.column("at").combine_chunks(), rows.column("weight").combine_chunks()
    for k, i in enumerate(keep):
        x[k, at[i].values.to_numpy()] = weight[i].values.to_numpy()
    return Hierarchy.fit(x, np.array([labels[i] for i in keep], object))


def predict(docs: DataFrame, model: Hierarchy, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text); only the text is looked at.

    A null text or one without a letter is ``und`` with score 0. Rows that repeat get equal predictions; an empty
    table gives no rows; a text of any length is read whole. A null held_out is false.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return limit_batches(docs).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(run), "doc_id long, held_out boolean, lang_pred string, score double")


def op6(docs: DataFrame) -> DataFrame:
    """Fit on the rows whose crc32(doc_id) mod 3 is not 1, predict every row."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return predict(docs, fit(docs, fold != 1), fold == 1)
