"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each link is a logistic regression on the presence of words, and also gets
the probabilities of the categories before it. While a later link is trained, these come from models that have not seen
the document (out of fold), so it learns from predictions as noisy as those it will meet.

Fitting takes labelled documents, at most about `fit_rows` of them (an even share by the hash of the id when there are
more). Words are chosen per category by the chi-square of their document counts with and without the label, for every fold
anew without that fold. Chosen words and the sample's matches with them are small and are solved on the
driver; counting is a Spark aggregation. Scoring reads every document, whole.

Cases: null and empty texts have no words and get the prior's score; labels that repeat an id count as set if any row
sets them, and null labels leave their document out of the fit; without labelled rows, or with one kind only, no
document is in the category; repeated documents are scored alike; null ids are carried along; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import python_path, stored, table, text_key, text_of

#: The bound of the labelled sample. Everything else covers all documents.
FIT_ROWS = 20_000
FOLDS = 5
#: Words per category; how many documents must hold one; how far its counts must be from chance (root of chi-square).
MOST_WORDS = 300
LEAST_DOCS = 4
LEAST_CHI = 5.5
#: Without any chosen word a score is about one half (both classes weigh the same), so more than that is asked for.
THRESHOLD = 0.6
RIDGE = 0.5

_SPACES = bytes.maketrans(
    bytes(c for c in range(128) if not chr(c).isalnum()), b" " * sum(not chr(c).isalnum() for c in range(128))
)


def words(text: bytes) -> list[bytes]:
    """Runs of letters and digits; only ASCII letters are lower-cased, only ASCII signs part words."""
    return text.translate(_SPACES).lower().split()


@dataclass
class Link:
    """One category's model: log odds = bias + weights of the words present + weights of earlier probabilities."""

    name: str
    bias: float = -20.0
    weights: dict[bytes, float] = field(default_factory=dict)
    earlier: list[float] = field(default_factory=list)

    def odds(self, present: set[bytes], before: list[float]) -> float:
        total = self.bias + math.fsum(sorted(self.weights[w] for w in present if w in self.weights))
        total += sum(w * p for w, p in zip(self.earlier, before, strict=True))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _solve(x: np.ndarray, extra: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression with both classes of equal weight, by Newton steps, in slices of rows.

    x: presence of words (bytes of 0 and 1); extra: the bias and the earlier probabilities. Weights: extra, then words.
    """
    share = np.where(y, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    n_extra, size = extra.shape[1], extra.shape[1] + x.shape[1]
    penalty = np.full(size, RIDGE)
    penalty[0] = 1e-6
    w = np.zeros(size)
    for _ in range(50):
        gradient, curve = penalty * w, np.diag(penalty + 1e-9)
        for at in range(0, len(y), 1000):
            part = slice(at, at + 1000)
            rows = np.concatenate([extra[part], x[part]], axis=1)
            p = _sigmoid(rows @ w)
            gradient += rows.T @ (share[part] * (p - y[part]))
            curve += (rows * (share[part] * p * (1 - p))[:, None]).T @ rows
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fit_link(
    name: str, chosen: list[bytes], x: np.ndarray, y: np.ndarray, before: list[np.ndarray], use: np.ndarray
) -> tuple[Link, np.ndarray]:
    """The link fitted on the rows `use`, and its probabilities for all rows."""
    extra = np.stack([np.ones(len(y)), *before], axis=1)
    if not use.any() or y[use].all() or not y[use].any():
        return Link(name, earlier=[0.0] * len(before)), np.zeros(len(y))
    w = _solve(x[use], extra[use], y[use])
    n = extra.shape[1]
    link = Link(name, float(w[0]), dict(zip(chosen, map(float, w[n:]), strict=True)), [float(v) for v in w[1:n]])
    return link, _sigmoid(extra @ w[:n] + x @ w[n:])


def _to_places(words: list[bytes]):
    """Which of the words a document has, as two-byte places in the list."""
    at = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.array(sorted(at[w] for w in row.as_py() if w in at), dtype="<u2").tobytes() for row in batch.column(0)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), *batch.columns[1:]], ["present", *batch.schema.names[1:]]
            )

    return run


def _to_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(words(text.as_py()))) for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.list_(pa.binary())), *batch.columns[1:]], ["words", *batch.schema.names[1:]]
        )


def _chosen(sample: DataFrame, name: str, without: int | None) -> list[bytes]:
    """The words that tell category `name` best, ties by the word; counted without one fold."""
    rows = sample if without is None else sample.where(F.col("fold") != without)
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum(name), F.lit(0))).first()
    if not positive or positive == total:
        return []
    counts = rows.select(F.explode("words").alias("word"), name).groupBy("word").agg(F.count("*").alias("n"), F.sum(name).alias("k"))
    n, k, every = F.col("n").cast("double"), F.col("k").cast("double"), float(total)
    cross = k * (every - positive - (n - k)) - (n - k) * (positive - k)
    chi = F.abs(cross) * F.sqrt(every / (n * (every - n) * positive * (every - positive)))
    best = counts.where((F.col("n") >= LEAST_DOCS) & (F.col("n") < total)).select("word", chi.alias("z")).where(F.col("z") >= LEAST_CHI)
    return sorted(bytes(r[0]) for r in best.orderBy(F.desc("z"), "word").limit(MOST_WORDS).collect())


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], fit_rows: int = FIT_ROWS) -> list[Link]:
    """The links of a chain over `categories` (name to a 0/1 column over `labels`), in the given order."""
    spark = docs.sparkSession
    python_path(spark)
    names = list(categories)
    marks = labels.select(F.col("doc_id").cast("long"), *[c.cast("int").alias(n) for n, c in categories.items()])
    marks = marks.dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
    n = marks.count()
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(max(n, 1))) < fit_rows if n > fit_rows else F.lit(True)
    texts = docs.select(F.col("doc_id").cast("long"), text_of("text").cast("binary").alias("text"), text_key("text").alias("key"))
    fold = F.pmod(F.xxhash64(F.col("key"), F.lit(2)), F.lit(FOLDS)).cast("int").alias("fold")
    # Equal texts count once, or the words of a much copied one would all seem to tell.
    sample = texts.join(marks.where(share), "doc_id").dropDuplicates(["key"]).select("text", "doc_id", "key", *names, fold)
    sample = sample.mapInArrow(
        _to_words, "words array<binary>, doc_id long, key long, " + "".join(f"{n} int, " for n in names) + "fold int"
    )
    sample = stored(sample, "labelled")
    chosen = {(name, f): _chosen(sample, name, f) for name in names for f in [None, *(range(FOLDS) if name != names[-1] else [])]}
    every = sorted({w for c in chosen.values() for w in c})
    # Bounded: the sample's rows, each with two bytes for a chosen word.
    rows = (
        sample.select("words", "doc_id", "key", *names, "fold")
        .mapInArrow(_to_places(every), "present binary, doc_id long, key long, " + "".join(f"{n} int, " for n in names) + "fold int")
        .orderBy("doc_id", "key")
        .collect()
    )
    present = [np.frombuffer(r.present, dtype="<u2") for r in rows]
    folds = np.array([r.fold for r in rows], dtype=int)
    place = {w: i for i, w in enumerate(every)}

    def matrix(words: list[bytes]) -> np.ndarray:
        column = np.full(len(every), -1)
        column[[place[w] for w in words]] = np.arange(len(words))
        x = np.zeros((len(rows), len(words)), dtype=np.uint8)
        for i, found in enumerate(present):
            columns = column[found]
            x[i, columns[columns >= 0]] = 1
        return x

    links: list[Link] = []
    before: list[np.ndarray] = []
    for name in names:
        y = np.array([r[name] for r in rows], dtype=bool)
        links.append(_fit_link(name, chosen[name, None], matrix(chosen[name, None]), y, before, np.ones(len(y), dtype=bool))[0])
        if name == names[-1]:
            break
        unseen = np.zeros(len(rows))
        for f in range(FOLDS):
            p = _fit_link(name, chosen[name, f], matrix(chosen[name, f]), y, before, folds != f)[1]
            unseen[folds == f] = p[folds == f]
        before.append(unseen)
    return links


def _score(links: list[Link]):
    known = frozenset(w for link in links for w in link.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[list[float]] = [[] for _ in links]
            for text in batch.column(2):
                present = set(known.intersection(words(text.as_py())))
                before: list[float] = []
                for link, column in zip(links, scores, strict=True):
                    before.append(link.odds(present, before))
                    column.append(before[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.float64()) for c in scores]],
                ["doc_id", "text_key", *[f"p_{link.name}" for link in links]],
            )

    return run


def score_chain(docs: DataFrame, links: list[Link]) -> DataFrame:
    """doc_id, text_key (tells rows of one id apart) and p_<category> for every document."""
    python_path(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_key("text").alias("text_key"), text_of("text").cast("binary").alias("text"))
    return rows.mapInArrow(_score(links), "doc_id long, text_key long" + "".join(f", p_{link.name} double" for link in links))


#: Of the label table: documents called poor first, then the toxic ones.
def label_categories() -> dict[str, Column]:
    return {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scores = score_chain(docs, fit_chain(docs, labels, label_categories()))
    return scores.withColumn("toxic", F.col("p_toxic") >= THRESHOLD)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the chain does not call toxic; columns as they are."""
    bad = toxicity(docs, labels).where("toxic").select(F.col("doc_id").alias("__bad"), F.col("text_key").alias("__of"))
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__key": text_key("text")})
    found = keyed.join(bad, (F.col("__key") == F.col("__of")) & F.col("__id").eqNullSafe(F.col("__bad")), "left_anti")
    return found.drop("__id", "__key")


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")
