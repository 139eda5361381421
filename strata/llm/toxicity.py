"""Counterfactual-regularised toxicity classifier.

A logistic model over the density of hashed words and word beginnings. To the
labelled rows' log loss it adds the squared change of the score when a group
term in a labelled text is swapped for another of its kind: what the label
does not explain then does not hang on who is mentioned, and neutral mentions
score low. A text that names a group is paired with its swapped version and
with one that has a neutral word in the term's place. Into every other text a
term, chosen by the text, is put at a slot, and paired with the same text with
another term there, and with none; such a mention keeps its text's label. (The
model weighs words, not their order: the place of the slot does not matter.)

Fitting uses a bounded sample of labelled rows (``MAX_TRAIN``, those with the
smallest hash of the id); features are chosen by their class frequencies in
it, and those of the group terms are always among them. Scoring covers every
row and whole texts: the score of a text is the mean weight of its tokens, one
pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import small_batches, stored
from strata.llm.words import blocks

MAX_TRAIN = 16_000      # labelled rows fitted on, at most
MAX_FEATURES = 20_000   # features with a weight
BITS = 20               # hashed feature space
PREFIXES = (5, 6, 7, 8, 9)
DENSITY = 50.0
ROUNDS = 150
L2 = 1e-5
SWAP_WEIGHT = 1.0       # weight of the counterfactual term
MENTION_WEIGHT = 0.1    # weight of a text with a term put in, beside the text itself
NEUTRAL = "0"           # stands for a term in the neutral version of a text
# Group terms, swapped within their row (English, German, French, Spanish).
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young"), ("disabled", "deaf", "blind"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("türken", "deutsche", "polen", "syrer", "ausländer"), ("schwul", "lesbisch", "bisexuell", "heterosexuell"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("arabes", "africains", "asiatiques", "européens"), ("lesbienne", "hétérosexuelle", "bisexuelle"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("gitanos", "negros", "blancos", "asiáticos", "latinos"), ("lesbianas", "heterosexuales", "bisexuales"),
)

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class Model:
    weights: np.ndarray     # one per hashed feature
    bias: float
    pairs: int = 0          # swapped pairs fitted on


def _fold(text: str | None) -> bytes:
    return _FOLD[np.frombuffer((text or "").lower().encode(), np.uint8)].tobytes()


def _swapper(groups):
    other = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, other), key=len, reverse=True)) + r")\b", re.I)

    def swap(text: str) -> tuple[str | None, str | None]:
        """The text with its terms swapped, and with a neutral word for each."""
        out, n = pattern.subn(lambda m: other[m[1].lower()], text)
        return (out, pattern.sub(NEUTRAL, text)) if n else (None, None)
    return swap


def _tokens(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(texts of a block, their first word's number, (word number, feature) per kind)."""
    for which, ends, w in blocks(texts, ascii_lower=False):
        first = np.concatenate(([0], np.searchsorted(w.starts, np.array(ends))))
        size = w.ends - w.starts
        kinds = [(np.arange(len(size)), w.hashes(w.starts, w.ends))]
        for n in PREFIXES:
            long = np.flatnonzero(size > n)
            kinds.append((long, w.hashes(w.starts[long], w.starts[long] + n) ^ np.uint64(n << 60 | n << 44)))
        yield which, first, [(k, (h >> np.uint64(64 - BITS)).astype(np.int64)) for k, h in kinds]


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, density) of each text; an empty text has none."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    words = np.zeros(len(texts))
    for which, first, kinds in _tokens([_fold(t) for t in texts]):
        np.add.at(words, which, np.diff(first))
        for k, f in kinds:
            cuts = np.searchsorted(k, first)
            for j, i in enumerate(which):
                found[i].append(f[cuts[j]:cuts[j + 1]])
    out = []
    for f, n in zip(found, words):
        u, c = np.unique(np.concatenate(f) if f else np.zeros(0, np.int64), return_counts=True)
        out.append((u, DENSITY * c / max(n, 1)))
    return out


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    total, words = np.zeros(len(texts)), np.zeros(len(texts))
    for which, first, kinds in _tokens([_fold(t) for t in texts]):
        np.add.at(words, which, np.diff(first))
        for k, f in kinds:
            run = np.concatenate(([0.0], np.cumsum(model.weights[f])))
            at = run[np.searchsorted(k, first)]
            np.add.at(total, which, np.diff(at))
    z = model.bias + DENSITY * total / np.maximum(words, 1)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros((2, 1 << BITS), np.int32)
    for b in batches:
        for y, (u, _) in zip(b.column(0).to_pylist(), features(b.column(1).to_pylist())):
            seen[y, u] += 1
    f = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(seen[1, f].astype(np.int64)),
                                      pa.array(seen[0, f].astype(np.int64))], ["f", "n1", "n0"])


def _pairs(texts: list[str | None], groups, own: list[tuple[np.ndarray, np.ndarray]]):
    """For each text: differences (features, densities) of the text from its
    swapped and from its neutral version, and of the text with a term put in
    the (features, densities, words) of the term. What isn't there is None."""
    swap = _swapper(groups)
    turned = [swap(t or "") for t in texts]
    swapped, neutral = features([t for t, _ in turned]), features([t for _, t in turned])
    flat = [(row, t) for row in groups for t in row]
    place = {t: k for k, (_, t) in enumerate(flat)}
    single = features([t for _, t in flat])
    for text, (new, _), o, e, (u, v) in zip(texts, turned, swapped, neutral, own):
        if new is not None:
            yield *[(np.concatenate((u, x[0])), np.concatenate((v, -x[1]))) for x in (o, e)], None
        elif len(u):
            row, term = flat[zlib.crc32(text.encode()) % len(flat)]
            n = len(_fold(text).split())
            (a, av), (b, bv) = single[place[term]], single[place[row[(row.index(term) + 1) % len(row)]]]
            mention = (a, av / (n + 1))
            yield (np.concatenate((a, b)), np.concatenate((av, -bv)) / (n + 1)), mention, (*mention, n)
        else:
            yield None, None, None


def _rows_task(chosen: np.ndarray, groups):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1)
        place[chosen] = np.arange(len(chosen))

        def row(f):
            if f is None:
                return None, None
            u = place[f[0]]
            return u[u >= 0].astype("<i4").tobytes(), f[1][u >= 0].astype("<f4").tobytes()

        for b in batches:
            texts = b.column(1).to_pylist()
            own = features(texts)
            swaps, neutrals, mentions = zip(*_pairs(texts, groups, own)) if texts else ((), (), ())
            sides = [[row(f) for f in side] for side in (own, swaps, neutrals, [m and m[:2] for m in mentions])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([x[k] for x in side], pa.binary()) for side in sides for k in (0, 1)],
                 pa.array([m and m[2] for m in mentions], pa.int64())], _ROW_COLUMNS)
    return run


_ROW_COLUMNS = ["y", "u", "v", "du", "dv", "eu", "ev", "mu", "mv", "words"]


def _sparse(us, vs):
    us, vs = [np.frombuffer(u, "<i4") for u in us], [np.frombuffer(v, "<f4") for v in vs]
    row = np.repeat(np.arange(len(us)), np.array([len(u) for u in us], np.int64))
    return row, *(np.concatenate(x) if x else np.zeros(0, t) for x, t in ((us, np.int32), (vs, np.float32)))


def fit_rows(y: np.ndarray, rows, pairs, mentions, size: int,
             swap_weight: float = SWAP_WEIGHT) -> tuple[np.ndarray, float]:
    """Weights and bias for sparse rows; ``pairs``: (weight of each pair, sparse
    differences); ``mentions``: (row numbers, words of the row, sparse terms),
    rows with a term put in."""
    r, c, v = rows
    pair, (dr, dc, dv) = pairs
    at, n_words, (mr, mc, mv) = mentions
    share = n_words / (n_words + 1.0)       # what a term put in leaves of the densities
    w, bias = np.zeros(size), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    m, s = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(r, v * w[c], minlength=len(y))
        g = 1 / (1 + np.exp(-np.clip(z + bias, -30, 30))) - y
        slope = g.mean() if len(y) else 0.0
        extra = np.zeros(size)
        if len(at):
            za = z[at] * share + np.bincount(mr, mv * w[mc], minlength=len(at)) + bias
            ga = MENTION_WEIGHT * (1 / (1 + np.exp(-np.clip(za, -30, 30))) - y[at])
            g[at] += ga * share
            slope += ga.sum() / len(y)
            extra = np.bincount(mc, mv * ga[mr], minlength=size) / len(y)
        grad = np.bincount(c, v * g[r], minlength=size) / max(len(y), 1) + extra + L2 * w
        if len(pair):
            change = pair * np.bincount(dr, dv * w[dc], minlength=len(pair))
            grad += swap_weight * np.bincount(dc, dv * change[dr], minlength=size)
        full = np.append(grad, slope)
        m, s = 0.9 * m + 0.1 * full, 0.98 * s + 0.02 * full * full
        step = 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.98 ** t)) + 1e-9)
        w -= step[:-1]
        bias -= 0.3 * step[-1]
    return w, bias


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", groups=IDENTITY_TERMS, swap_weight: float = SWAP_WEIGHT,
          max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows of ``labels`` that have a
    document (ids repeated there count once, by their largest label; null ids
    and labels other than 0 and 1 are left out). Without labelled rows every
    score is 0.5. Labelled texts without any swapped pair are an error."""
    small_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lab = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
           .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
           .join(src.select("id"), "id", "left_semi")
           .orderBy(F.xxhash64("id"), "id").limit(max_train))
    # At most max_train rows of two numbers are sent to the tasks.
    sample = stored(spark, src.join(F.broadcast(lab), "id").select("y", "text"), "toxic-sample")
    counts = sample.mapInArrow(_count_task, "f bigint, n1 bigint, n0 bigint").groupBy("f").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    n = dict(sample.groupBy("y").count().collect())
    odds = F.log((F.col("n1") + 0.5) / (n.get(1, 0) + 1.0)) - F.log((F.col("n0") + 0.5) / (n.get(0, 0) + 1.0))
    chosen = [x.f for x in counts.filter("n1 + n0 >= 3").orderBy(
        F.desc(F.abs(odds) * F.sqrt(F.col("n1") + F.col("n0"))), "f").limit(MAX_FEATURES).select("f").collect()]
    of_terms = [f for f, _ in features([t for row in groups for t in row])]
    chosen = np.unique(np.concatenate([np.array(chosen, np.int64), *of_terms]))
    got = sample.mapInArrow(_rows_task(chosen, groups),
                            "y int, " + ", ".join(f"{c} binary" for c in _ROW_COLUMNS[1:-1]) + ", words bigint").collect()
    turned = [x for x in got if x.du is not None]
    at = [i for i, x in enumerate(got) if x.mu is not None]
    if any(x.u for x in got) and not turned:
        raise ValueError("no counterfactual pair: the group terms give none")
    # Texts that name a group count as much as all others together, however few they are.
    kind = np.array([x.mu is None for x in turned], int)
    pair = 1 / np.bincount(kind, minlength=2)[kind] if turned else np.zeros(0)
    differences = _sparse([x.du for x in turned] + [x.eu for x in turned], [x.dv for x in turned] + [x.ev for x in turned])
    w, bias = fit_rows(np.array([x.y for x in got], float), _sparse([x.u for x in got], [x.v for x in got]),
                       (np.concatenate((pair, pair)), differences),
                       (np.array(at, np.int64), np.array([got[i].words for i in at], float),
                        _sparse([got[i].mu for i in at], [got[i].mv for i in at])), len(chosen), swap_weight)
    weights = np.zeros(1 << BITS)
    weights[chosen] = w
    return Model(weights, bias, len(turned))


def score(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text",
          out: str = "score") -> DataFrame:
    """``docs`` with a column ``out`` between 0 and 1; every row gets one, a
    null or empty text that of the bias alone. Repeated rows score alike;
    other columns are passed through (``out`` must be a new name)."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    small_batches(spark)
    at = docs.columns.index(text_col)
    # The few weights that are not zero travel with the task.
    places = np.flatnonzero(model.weights)
    values, size, bias = model.weights[places], len(model.weights), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(size)
        dense[places] = values
        fitted = Model(dense, bias)
        for b in batches:
            s = score_texts(fitted, b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))
