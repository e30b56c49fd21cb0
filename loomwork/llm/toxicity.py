"""Toxicity by a chain of linear classifiers.

Terms of a document are its distinct lower-cased words and their beginnings of
four to eight letters.  From a bounded labelled sample the MARKERS terms that
speak most clearly for or against the label are kept; every model is a
logistic regression on their presence, the share of marker words and the
document's length.

The chain's categories, in order: `marked` (a toxic row with any of the
STRONG clearest terms), `repeated` (with three or more of them), `toxic` (the
label itself).  Each later model also gets the earlier categories'
probabilities: while learning, those are out-of-fold predictions, so that a
later model sees errors as they will be; when scoring, those of the models
fitted on all sampled rows.  A fold's predictions come from models, markers and
strong terms that its rows had no part in.  The last model's constant is moved so
that one half lies where its out-of-fold predictions decide best (decision()).  The label knows no finer kinds of
toxicity, so the two earlier categories are the label's, narrowed by how plainly
a row speaks.  An id with several labels has the largest of them.

Null and empty texts have no terms and score as such, well below 0.5.  Without
labelled rows of both kinds every probability is 0.  Repeated rows each get
their own row.

Of terms that speak as clearly the one that sorts first is kept; a probability of
exactly 0.5 is toxic.  An empty table gives an empty result.  Texts of any length
are read whole; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, texts
from .sample import one_label, sample_ids, sampled

PER_CLASS = 3072
MARKERS = 3072
STRONG = 512
FOLDS = 5
CATEGORIES = ("marked", "repeated", "toxic")
DENSE = 3
#: How far the point of decision may move from a probability of a half.
MOVED = (0.25, 0.75)
BEGINNINGS = (4, 5, 6, 7, 8)

_SPACE = bytes(b if b >= 128 or chr(b).isalnum() or b == ord("'") else 32 for b in range(256))


def _words(text: str) -> set[bytes]:
    """Different runs of letters, digits, apostrophes and signs beyond ASCII, in lower case."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_SPACE).split())


def words(text: str) -> set[str]:
    return {w.decode("utf-8", "surrogatepass") for w in _words(text)}


def terms(found: set[str]) -> set[str]:
    """Words, and their beginnings marked by a leading sign."""
    return found.union(*({"^" + w[:n] for w in found if len(w) > n} for n in BEGINNINGS))


def fold_of(doc_id: np.ndarray) -> np.ndarray:
    return (doc_id * 2654435761 >> 7) % FOLDS


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fold = fold_of(batch.column(0).to_numpy())
        for f, cls, text in zip(fold.tolist(), batch.column(1).to_pylist(), texts(batch), strict=True):
            found = sorted(terms(words(text)))
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(found), pa.int32()), pa.array([cls] * len(found), pa.int32()), pa.array(found, pa.string())], ["fold", "cls", "term"])


#: Words kept with their markers in a worker; a full cache starts again.
CACHE_WORDS = 400_000


class Markers:
    """Numbers of the markers that a text holds."""

    def __init__(self, at: dict[str, int]):
        self.at, self.cache = at, {}

    def of(self, text: str) -> tuple[list[int], int]:
        """Ascending numbers, and how many different words there are."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        found, here = _words(text), set()
        for w in found:
            own = self.cache.get(w)
            if own is None:
                own = self.cache[w] = tuple(self.at[t] for t in terms({w.decode("utf-8", "surrogatepass")}) if t in self.at)
            if own:
                here.update(own)
        return sorted(here), len(found)


def _feature_rows(at: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markers = Markers(at)
        for batch in batches:
            got = [markers.of(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([np.array(i, "<u2").tobytes() for i, _ in got], pa.binary()), pa.array([n for _, n in got], pa.int64())],
                ["doc_id", "cls", "idx", "n"],
            )

    return run


class Design:
    """Rows of marker numbers and of dense columns, which come after the markers; no zero is stored.

    numbers: the markers of all rows, row after row; size: how many each row has.
    """

    def __init__(self, numbers: np.ndarray, size: np.ndarray, markers: int, dense: np.ndarray):
        self.numbers, self.size, self.markers, self.dense = numbers, size, markers, dense
        self.row = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.full = np.flatnonzero(size)
        self.starts = (np.cumsum(size) - size)[self.full]
        self.by_marker = self.row[np.argsort(numbers, kind="stable")]
        each = np.bincount(numbers, minlength=markers)
        self.used = np.flatnonzero(each)
        self.marker_starts = (np.cumsum(each) - each)[self.used]

    def __len__(self) -> int:
        return len(self.size)

    @property
    def width(self) -> int:
        return self.markers + self.dense.shape[1]

    def times(self, v: np.ndarray) -> np.ndarray:
        out = self.dense @ v[self.markers :]
        if len(self.full):
            out[self.full] += np.add.reduceat(v[self.numbers], self.starts)
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        """The transpose times g."""
        out = np.zeros(self.width, np.float32)
        out[self.markers :] = self.dense.T @ g
        if len(self.used):
            out[self.used] = np.add.reduceat(g[self.by_marker], self.marker_starts)
        return out

    def rows(self, mask: np.ndarray) -> Design:
        return Design(self.numbers[mask[self.row]], self.size[mask], self.markers, self.dense[mask])

    def beside(self, column: np.ndarray) -> Design:
        return Design(self.numbers, self.size, self.markers, np.hstack([self.dense, column[:, None]]))


def design(x: np.ndarray) -> Design:
    """All columns dense."""
    return Design(np.empty(0, np.int64), np.zeros(len(x), np.int64), 0, x)


def logistic(x: Design, y: np.ndarray, l2: float = 0.3, steps: int = 300) -> np.ndarray:
    """Weights, the last for the constant; accelerated gradient descent on the mean
    log loss, in which a rarer positive class counts more (by the root of its rarity)."""
    positive = max(1.0, float(y.sum()))
    each = np.where(y > 0, np.sqrt(max(1.0, (len(y) - positive) / positive)), 1.0).astype(np.float32)
    x = x.beside(np.ones(len(x), np.float32))
    penalty = np.full(x.width, l2 / len(x), np.float32)
    penalty[-1] = 0
    v = np.ones(x.width, np.float32) / np.sqrt(x.width)
    for _ in range(8):  # the largest curvature, by power iteration
        v = x.back(each * x.times(v))
        size = float(np.linalg.norm(v))
        v /= max(size, 1e-9)
    rate = 1 / (0.25 * size / len(x) * 1.1 + l2 / len(x) + 1e-9)
    w = look = np.zeros(x.width, np.float32)
    for t in range(steps):
        grad = x.back(each * (sigmoid(x.times(look)) - y)) / len(x) + penalty * look
        new = look - rate * grad
        look = new + t / (t + 3) * (new - w)
        w = new
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(x: np.ndarray | Design, targets: np.ndarray, folds: np.ndarray, views: list[tuple[Design, np.ndarray]] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """One weight vector per category, and the last one's out-of-fold probabilities; those of the others join x for the next.

    views: by fold, the design and targets made without that fold's rows; else those of all rows.
    """
    x = x if isinstance(x, Design) else design(x)
    views = views or [(x, targets)] * FOLDS
    designs = [d for d, _ in views]
    chain = []
    for j in range(targets.shape[1]):
        chain.append(logistic(x, targets[:, j]))
        out = np.zeros(len(x), np.float32)
        for f, (_, y) in enumerate(views):
            test = folds == f
            if test.any() and not test.all():
                w = logistic(designs[f].rows(~test), y[~test, j])
                out[test] = sigmoid(designs[f].rows(test).times(w[:-1]) + w[-1])
        x = x.beside(out)
        designs = [d.beside(out) for d in designs]
    return chain, out


def decision(p: np.ndarray, y: np.ndarray) -> float:
    """The probability, within MOVED, from which saying toxic gives the largest F1 over rows that the models had no part in."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order] > 0)
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + max(1, int((y > 0).sum())))
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal probabilities go together
    return float(np.clip(p[order][last][f1[last].argmax()], *MOVED))


def _view(numbers: np.ndarray, size: np.ndarray, n: np.ndarray, y: np.ndarray, keep: np.ndarray, strong: np.ndarray) -> tuple[Design, np.ndarray]:
    """The design over the markers `keep`, and the categories that the strong ones among them make."""
    row = np.repeat(np.arange(len(size)), size)
    k = np.bincount(row[strong[numbers]], minlength=len(size)).astype(np.float32)
    own = keep[numbers]
    column = np.cumsum(keep) - 1
    dense = np.stack([k / (n + 20), np.log1p(n)], 1).astype(np.float32)
    x = Design(column[numbers[own]].astype(np.int32), np.bincount(row[own], minlength=len(size)), int(keep.sum()), dense)
    return x, np.stack([y * (k >= 1), y * (k >= DENSE), y], 1).astype(np.float32)


def _chosen(seen: DataFrame, size: dict[tuple[int, int], int], k: int = MARKERS) -> list[tuple[list[str], set[str]]]:
    """The k clearest terms, clearest first, and the strong ones among them: as counted over all folds, then without each of them.

    seen: fold, cls, term.  What reaches the driver is k rows for each of the
    FOLDS + 1 views.
    """
    each = [a for f in range(FOLDS) for a in (F.sum(F.when(F.col("fold") == f, F.col("cls")).otherwise(0)).alias(f"one{f}"), F.count_if(F.col("fold") == f).alias(f"all{f}"))]
    views = []
    for without in (None, *range(FOLDS)):
        folds = [f for f in range(FOLDS) if f != without]
        n1, n = (sum((F.col(f"{c}{f}") for f in folds), F.lit(0)) for c in ("one", "all"))
        rate = [(m + 0.5) / (sum(size.get((f, c), 0) for f in folds) + 1.0) for c, m in ((1, n1), (0, n - n1))]
        z = F.log(rate[0] / rate[1]) * F.sqrt(n)
        views.append(F.struct(F.lit(len(views)).alias("view"), z.alias("z"), n1.alias("n1"), n.alias("n")))
    scored = seen.groupBy("term").agg(*each).select("term", F.inline(F.array(*views))).where("n >= 4")
    place = F.row_number().over(Window.partitionBy("view").orderBy(F.abs("z").desc(), "term"))
    best = scored.withColumn("place", place).where(F.col("place") <= k).toPandas().sort_values(["view", "place"])
    out = []
    for view in range(FOLDS + 1):
        own = best[best.view == view]
        out.append((own.term.tolist(), set(own.term[(own.z > 0) & (own.n1 >= 0.5 * own.n)].tolist()[:STRONG])))
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    """docs: doc_id, text; labels: doc_id, cls (1: toxic)."""
    known = sample_ids(one_label(docs.select("doc_id").join(labels, "doc_id")), per_class).toPandas()
    if known.cls.nunique() < 2:
        return None
    rows = sampled(docs, docs.sparkSession.createDataFrame(known, "doc_id long, cls int"))
    size = {k: int(v) for k, v in known.groupby([fold_of(known.doc_id.to_numpy(np.int64)), known.cls.to_numpy()]).size().items()}
    picked = _chosen(rows.mapInArrow(_term_rows, "fold int, cls int, term string"), size)
    at = {t: k for k, t in enumerate(dict.fromkeys(t for best, _ in picked for t in best))}
    got = rows.mapInArrow(_feature_rows(at), "doc_id long, cls int, idx binary, n long").toPandas().sort_values(["doc_id", "idx"], kind="stable")
    numbers = [np.frombuffer(i, "<u2") for i in got.idx]
    flat, sizes = np.concatenate([*numbers, np.empty(0, "<u2")]).astype(np.int64), np.array([len(i) for i in numbers], np.int64)
    has = lambda some: np.isin(np.arange(len(at)), [at[t] for t in some])
    views = [_view(flat, sizes, got.n.to_numpy(np.float32), got.cls.to_numpy(np.float32), has(best), has(strong)) for best, strong in picked]
    (x, targets), folds = views[0], fold_of(got.doc_id.to_numpy(np.int64))
    best, strong = picked[0]
    chain, out = fit_chain(x, targets, folds, views[1:])
    at_half = decision(out, targets[:, -1])
    chain[-1][-1] -= np.log(at_half / (1 - at_half))
    return {"at": {t: k for k, t in enumerate(best)}, "strong": np.array([t in strong for t in best], bool), "chain": chain}


class Chances:
    """The categories' probabilities of texts, in the chain's order."""

    def __init__(self, model: dict | None):
        self.model = model
        if model:
            self.markers, self.n = Markers(model["at"]), len(model["at"])

    def __call__(self, texts_: list[str]) -> np.ndarray:
        if self.model is None:
            return np.zeros((len(texts_), len(CATEGORIES)))
        found = [self.markers.of(t) for t in texts_]
        size = np.array([len(i) for i, _ in found], np.int64)
        numbers = np.array([i for here, _ in found for i in here], np.int64)
        row = np.repeat(np.arange(len(found)), size)
        add = lambda w: np.bincount(row, w[numbers], len(found))
        k, words_ = add(self.model["strong"].astype(np.float64)), np.array([n for _, n in found], np.float64)
        columns = [k / (words_ + 20), np.log1p(words_)]
        out = []
        for w in self.model["chain"]:
            z = add(w[: self.n].astype(np.float64)) + sum(float(c) * x for c, x in zip(w[self.n : -1], [*columns, *out], strict=True)) + float(w[-1])
            out.append(sigmoid(z))
        return np.stack(out, 1)


def _scorer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chances = Chances(shared.value)
        for batch in batches:
            p = chances(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, j], pa.float64()) for j in range(len(CATEGORIES)))], ["doc_id", *(f"p_{c}" for c in CATEGORIES)])

    return run


def _keeper(shared, text_col: str, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chances = Chances(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(chances([t or "" for t in texts(batch, text_col)])[:, -1] < threshold, pa.bool_()))

    return run


def _model(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int):
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("cls"))
    return docs.sparkSession.sparkContext.broadcast(fit(id_and_text(docs, id_col, text_col), known.where("cls in (0, 1)"), per_class))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, one probability per category, and toxic (the last one is 0.5 or more)."""
    shared = _model(docs, labels, id_col, text_col, label_col, per_class)
    scored = id_and_text(docs, id_col, text_col).mapInArrow(_scorer(shared), "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES))
    return scored.withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """docs without the rows whose toxic probability reaches the threshold; all columns, no shuffle of texts."""
    shared = _model(docs, labels, id_col, text_col, label_col, per_class)
    return docs.mapInArrow(_keeper(shared, text_col, threshold), docs.schema)
