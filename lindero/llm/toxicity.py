"""Toxicity by weak supervision.

Many voters look at a text: lexicons of words and of word stems, once for those that occur and once for those that make
up a hundredth of the text (mined from a bounded sample of labelled rows and dealt into lists), and fixed patterns. A voter says "toxic" or abstains; one says "clean" where no lexicon has a word. A
generative label model estimates, by expectation maximisation over labelled and unlabelled rows, how often each voter
fires on toxic and on clean texts, and from what the voters have in common beyond that, how much of each vote is new.
Its posterior labels train a linear classifier over the terms and patterns, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, limit_batches, text_of, written

#: Most toxic rows (of clean ones twice as many) and most unlabelled rows a model is fitted on, and most terms in its lexicons.
LABELLED_ROWS, UNLABELLED_ROWS, TERMS = 6000, 6000, 2000
STEMS = (4, 5, 6)
#: How many times as often toxic texts must have a term as clean ones. Chosen among 6, 8, 12 and 20 by four-fold
#: cross-validation inside the learning rows; see the README.
RATIO = 8
#: Terms that a task counts before it hands them on: bounds its memory.
COUNTED_TERMS = 100_000
WORD_LISTS, STEM_LISTS = 8, 4
_WORD = re.compile(r"[^\W\d_]+")

#: Insults that need no mining (fixed values).
INSULTS = frozenset("idiot moron stupid loser scum trash pathetic worthless disgusting imbecile dumb jerk bastard cretin idiota imbécil estúpido cabrón connard crétin salaud idiotin dummkopf arschloch trottel".split())
PATTERNS = ("insult", "masked", "shouting", "exclaiming")
_MASKED = re.compile(r"\b[A-Za-z]\*{2,}[A-Za-z]*")
_SHOUTED = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{4,}\b")


def words_of(text: str) -> Counter[str]:
    return Counter(_WORD.findall(text.lower()))


def stems_of(words: Counter[str], k: int, known: Container[str] | None = None) -> Counter[str]:
    """Stems of ``k`` letters, marked by a hyphen behind them, and how often words have them; only ``known`` ones if given."""
    out: Counter[str] = Counter()
    for w, n in words.items():
        if len(w) >= k and (known is None or w[:k] + "-" in known):
            out[w[:k] + "-"] += n
    return out


def frequent(counts: Counter[str], total: int) -> list[str]:
    """The terms that come at least twice and are a hundredth of ``total`` words, marked by an accent behind them."""
    return [t + "^" for t, n in counts.items() if n > 1 and 100 * n >= total]


def terms_of(words: Counter[str]) -> list[str]:
    """Each word and stem once, and again if it is frequent."""
    total, out = words.total(), []
    for counts in (words, *(stems_of(words, k) for k in STEMS)):
        out += [*counts, *frequent(counts, total)]
    return out


def patterns_of(text: str, words: Counter[str]) -> list[bool]:
    return [not INSULTS.isdisjoint(words), "**" in text and bool(_MASKED.search(text)), text.count("!") >= 3 and len(_SHOUTED.findall(text)) >= 3, "!!" in text]


@dataclass
class Lexicons:
    """The mined terms, the list that each was dealt to, and the words and stems that are looked for."""

    index: dict[str, int]
    lists: dict[str, int]
    n_lists: int
    bare: set[str]

    @classmethod
    def deal(cls, terms: list[str]) -> Lexicons:
        """``terms`` come strongest first; words and stems of each length go to lists of their own, in turn."""
        kinds = {(0, often): WORD_LISTS for often in (False, True)} | {(k, often): STEM_LISTS for k in STEMS for often in (False, True)}
        base = dict(zip(kinds, np.cumsum([0, *kinds.values()])[:-1].tolist(), strict=True))
        dealt: Counter[tuple[int, bool]] = Counter()
        lists = {}
        for t in terms:
            own = t.removesuffix("^")
            kind = (len(own) - 1 if own.endswith("-") else 0, own != t)
            lists[t] = base[kind] + dealt[kind] % kinds[kind]
            dealt[kind] += 1
        return cls({t: i for i, t in enumerate(terms)}, lists, sum(kinds.values()), {t.removesuffix("^") for t in terms})

    @property
    def n_features(self) -> int:
        return len(self.index) + len(PATTERNS)

    def __call__(self, text: str) -> tuple[list[int], list[int]]:
        """(features, votes) that are on. The last vote says clean: no list has a word of the text."""
        words, found = words_of(text), []
        total = words.total()
        for counts in (Counter({w: n for w, n in words.items() if w in self.bare}), *(stems_of(words, k, self.bare) for k in STEMS)):
            found += [t for t in (*counts, *frequent(counts, total)) if t in self.index]
        on = [i for i, x in enumerate(patterns_of(text, words)) if x]
        votes = sorted({self.lists[t] for t in found}) + [self.n_lists + i for i in on]
        if not found:
            votes.append(self.n_lists + len(PATTERNS))
        return sorted(self.index[t] for t in found) + [len(self.index) + i for i in on], votes

    @property
    def n_votes(self) -> int:
        return self.n_lists + len(PATTERNS) + 1


def posteriors(votes: np.ndarray, labels: np.ndarray, rounds: int = 25) -> np.ndarray:
    """The label model: chance of "toxic" for each row of ``votes`` (0/1); ``labels`` are 0, 1 or -1 for not known.

    Known labels start the estimate and stay in it as evidence; the posterior of a labelled row mixes its label with
    what the voters say.
    """
    known = labels >= 0
    q = np.where(known, labels, labels[known].mean() if known.any() else 0.1).astype(float)
    for step in range(rounds):
        fire = [(votes.T @ p + 0.1) / (p.sum() + 1.0) for p in (q, 1 - q)]
        mean = np.outer(q, fire[0]) + np.outer(1 - q, fire[1])
        rest = votes - mean  # what the class does not explain
        scale = np.sqrt((rest**2).mean(0)) + 1e-6
        shared = np.clip(rest.T @ rest / len(votes) / np.outer(scale, scale), 0, 1)
        new = 1 / (1 + shared.sum(1) - np.diag(shared))  # the share of a vote that correlated voters do not repeat
        prior = np.log((q.mean() + 1e-3) / (1 - q.mean() + 1e-3))
        odds = np.clip(prior + votes @ (new * np.log(fire[0] / fire[1])), -30, 30)
        said = 1 / (1 + np.exp(-odds))
        after = np.where(known, 0.8 * np.maximum(labels, 0) + 0.2 * said, said)
        if step and np.abs(after - q).max() < 1e-4:
            break
        q = after
    return q


def logistic(rows: np.ndarray, columns: np.ndarray, n: int, d: int, target: np.ndarray, ridge: float = 1e-4, rounds: int = 500) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on binary features given by place, with soft targets.

    The toxic rows weigh a quarter of what the clean ones do in all, so that a row without evidence is clean; Adam
    steps over all rows.
    """
    weight = 0.2 * target / max(1e-9, target.sum()) + 0.8 * (1 - target) / max(1e-9, (1 - target).sum())
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    for step in range(1, rounds + 1):
        margin = np.bincount(rows, w[columns], n) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target)
        gradient = np.append(np.bincount(columns, error[rows], d) + ridge * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= 0.1 * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


@dataclass
class Model:
    lexicons: Lexicons
    weights: np.ndarray

    def score(self, text: str) -> float:
        on, _ = self.lexicons(text)
        return float(1 / (1 + np.exp(-np.clip(self.weights[on].sum() + self.weights[-1], -30, 30))))


def _part(rows: DataFrame, n: int, spread: Column) -> DataFrame:
    """Rows in the part of the range of ``spread``'s hash that holds about ``n`` of them, with the hash as ``_h``; nothing is
    sorted or brought to one task."""
    share = min(1.0, n / max(1, rows.count()))
    place = F.pmod(F.xxhash64(F.lit(11), spread), F.lit(1 << 40))
    return rows.withColumn("_h", place).filter(F.col("_h") < int(share * (1 << 40)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, labelled: int = LABELLED_ROWS, unlabelled: int = UNLABELLED_ROWS, max_terms: int = TERMS) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) whose ids meet ``learn``.

    About ``labelled`` toxic, twice as many clean and ``unlabelled`` other texts are used at most, those in a part of the
    hashes' range; equal texts count once. Only they, with their terms, are gathered, and ``max_terms`` terms at most are
    looked for, the strongest ones. Labels with a null doc_id or toxic are left out; of several labels of a
    document the largest counts. Without toxic labels the fixed patterns alone vote.
    """
    own = labels.filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    picked = _part(own.filter("toxic = 1"), labelled, F.col("doc_id")).unionByName(_part(own.filter("toxic = 0"), 2 * labelled, F.col("doc_id"))).drop("_h")
    texts = limit_batches(docs).select("doc_id", text_of().alias("text"))
    # The picked labels are about three times ``labelled`` rows at most: that bound makes the broadcast safe.
    sample = texts.join(F.broadcast(picked), "doc_id").select("text", "toxic").dropDuplicates(["text", "toxic"])
    others = _part(docs.filter(learn).select(text_of().alias("text")), unlabelled, F.col("text")).groupBy("_h").agg(F.min("text").alias("text")).select("text", F.lit(-1).alias("toxic"))
    sample = written(sample.unionByName(others).repartition(24), "toxicity-sample").repartition(24)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = (Counter(), Counter())

        def told() -> pa.RecordBatch:
            terms = list({**tallies[0], **tallies[1]})
            out = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([t[x] for x in terms], pa.int64()) for t in tallies)], names=["term", "clean", "toxic"])
            for t in tallies:
                t.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if toxic >= 0:
                    tallies[toxic].update(terms_of(words_of(text)))
                    if len(tallies[0]) + len(tallies[1]) > COUNTED_TERMS:
                        yield told()
        if tallies[0] or tallies[1]:
            yield told()

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    terms: list[str] = []
    if n1:
        tallies = sample.mapInArrow(frugal(count), "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        rate1, rate0 = F.col("toxic") / n1, (F.col("clean") + 0.5) / max(1, n0)
        strong = tallies.filter((F.col("toxic") >= max(5, n1 // 40)) & (rate1 > RATIO * rate0))
        terms = [r["term"] for r in strong.orderBy(F.desc(rate1 - rate0), "term").limit(max_terms).collect()]
    lexicons = Lexicons.deal(terms)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicons(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.int32())), batch.column(1)], names=["on", "votes", "toxic"])

    seen = sample.mapInArrow(frugal(look), "on array<int>, votes array<int>, toxic int").toArrow()
    n, d = seen.num_rows, lexicons.n_features
    if not n:
        return Model(lexicons, np.append(np.zeros(d), -5.0))
    votes = np.zeros((n, lexicons.n_votes))
    for i, own_votes in enumerate(seen.column("votes").to_pylist()):
        votes[i, own_votes] = 1
    labels_ = seen.column("toxic").to_numpy().astype(int)
    target = posteriors(votes, labels_)
    on = seen.column("on").to_pylist()
    rows, columns = np.repeat(np.arange(n), list(map(len, on))), np.array([x for y in on for x in y], np.int64)
    return Model(lexicons, logistic(rows, columns, n, d, target))


def score(docs: DataFrame, model: Model, held_out: Column | None = None, keep: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text); only the text is looked at.

    Null and empty texts are scored as empty. Rows that repeat get equal scores; an empty table gives no rows; a text
    of any length is read whole. A null ``held_out`` is false. With ``keep`` the row's other columns stay, too.
    """
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    others = [c for c in docs.columns if c not in ("held_out", "score", "predicted")] if keep else ["doc_id"]
    source = limit_batches(docs).select(*others, held.alias("held_out"), text_of().alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t.as_py()) for t in batch.columns[-1]], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=[*others, "held_out", "score", "predicted"])

    return source.mapInArrow(frugal(run), f"{kinds}, score double, predicted int")


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the rows whose crc32(doc_id) mod 5 is not 0, score every row."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return score(docs, fit(docs, labels, fold != 0), fold == 0)
