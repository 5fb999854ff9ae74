"""Operator 2, toxicity: non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; everything else is unlabelled.  With p
the share of toxic texts (estimated from the labelled training rows), the risk of a
classifier g is

    p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)]),

whose second term estimates the risk on clean texts and may not fall below 0.
Two numpy classifiers are trained on it, one on words and one on word
beginnings (which finds inflected forms), and their logits are averaged.

Features are hashed; the value of a feature is the logarithm of one plus its
count; the text's length is a feature too.  Training uses at most ``POSITIVES`` toxic
and ``UNLABELLED`` other texts, those whose id hashes lowest, each of them whole, as
every text is scored whole.  The texts stay with the tasks: these first count, for
each feature, the texts that hold it, and then send the values of the features that
are learnt.  With ``least_z`` (an option) those are the features that toxic texts hold
more often than the rest by so many standard deviations; without it all that
``LEAST_TEXTS`` toxic texts hold.  Only the weights (at most ``2**BITS`` for each
classifier) travel to the tasks that score.

Defined results: a null or empty text has no features and gets the score of the
bias alone; repeated rows get equal scores; without any toxic training row every
score is the prior; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treepref.llm import textkernel as K
from treepref.session import drop_path, materialize, scratch_path

#: (weights, weight of the length, bias) of each classifier.
Model = list[tuple[np.ndarray, float, float]]
BITS = 18
POSITIVES = 2000
UNLABELLED = 6000
STEPS = 200
RATE = 0.1
DECAY = 2e-4
#: A feature is learnt if so many toxic training texts hold it, and so many standard deviations more than expected.
LEAST_TEXTS = 4
LEAST_Z = 7.0
#: Logarithm of an ordinary text's bytes.
LENGTH = 7.0
PREFIXES = (3, 4, 5, 6, 7)
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True


def _grouped(doc: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, log of one plus the count) of distinct pairs."""
    keys = np.sort((doc.astype(np.int64) << BITS) | idx)
    if not len(keys):
        return doc, idx, np.zeros(0, np.float32)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys >> BITS, keys & ((1 << BITS) - 1), np.log1p(count).astype(np.float32)


def _index(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(buf: np.ndarray, offs: np.ndarray, wanted: tuple[np.ndarray, np.ndarray] | None = None
             ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each classifier (text, feature, value); ``wanted``: the only features that matter."""
    buf = K.LOWER[buf]
    starts, ends, doc = K.runs(buf, offs, _LETTER[buf])
    out = []
    for view in range(2):
        parts = []
        if view == 0:
            parts.append((doc, _index(K.span_hashes(buf, starts, ends))))
        else:
            for n in PREFIXES:
                long = ends - starts > n
                s = starts[long]
                parts.append((doc[long], _index(K.span_hashes(buf, s, s + n))))
        if wanted is not None:
            parts = [(d[m], i[m]) for d, i in parts if (m := wanted[view][i]) is not None]
        out.append(_grouped(np.concatenate([d for d, _ in parts]), np.concatenate([i for _, i in parts])))
    return out


def evidence(pos: np.ndarray, others: np.ndarray, n_pos: int, n_others: int, least_z: float | None) -> np.ndarray:
    """Features to learn, from the numbers of toxic and of other texts that hold each."""
    ok = pos >= LEAST_TEXTS
    if least_z is not None:
        e = (others + 0.5) / (n_others + 1)
        ok &= (pos - n_pos * e) / np.sqrt(n_pos * e * (1 - np.minimum(e, 1)) + 0.5) >= least_z
    return np.flatnonzero(ok)


def fit_view(rows: np.ndarray, idx: np.ndarray, value: np.ndarray, length: np.ndarray, positive: np.ndarray,
             prior: float, known: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(weights, weight of the length, bias) of a linear classifier of the known features by the non-negative risk."""
    n, pos = len(positive), positive.astype(bool)
    if not pos.any() or pos.all():
        return np.zeros(1 << BITS, np.float32), 0.0, float(np.log(prior / (1 - prior)))
    place = np.full(1 << BITS, -1, np.int64)
    place[known] = np.arange(len(known))
    use = place[idx] >= 0
    rows, cols, value = rows[use], place[idx[use]], value[use].astype(np.float64)
    w = np.zeros(len(known) + 2)  # then the length and the bias
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    n_pos, n_un = max(1, int(pos.sum())), max(1, int((~pos).sum()))
    for step in range(1, STEPS + 1):
        g = np.bincount(rows, weights=value * w[cols], minlength=n) + w[-2] * length + w[-1]
        sig = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        loss_clean = np.logaddexp(0, g)  # l(-g)
        d = np.zeros(n)
        d[pos] = prior * (sig[pos] - 1) / n_pos
        if loss_clean[~pos].mean() >= prior * loss_clean[pos].mean():
            # Else the second term is at its bound of 0 and has no part in the gradient.
            d[pos] -= prior * sig[pos] / n_pos
            d[~pos] = sig[~pos] / n_un
        grad = np.append(np.bincount(cols, weights=value * d[rows], minlength=len(known)), [d @ length, d.sum()])
        grad[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    out = np.zeros(1 << BITS, np.float32)
    out[known] = w[:-2]
    return out, float(w[-2]), float(w[-1])


def _length(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.log1p(np.diff(offs)) - LENGTH


def _batch(positives: list[str], others: list[str]) -> pa.RecordBatch:
    texts = pa.array([*positives, *others], pa.large_string())
    return pa.RecordBatch.from_arrays([texts, pa.array(np.arange(len(texts)) < len(positives))], ["text", "positive"])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(view, feature, toxic texts, other texts) for the features of a task's texts; feature -1 counts the texts."""
    n = np.zeros((2, 2, (1 << BITS) + 1), np.int64)  # view, toxic or not
    for b in batches:
        mark = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for i, j, buf, offs in K.chunks(b.column(0)):
            toxic = mark[i:j]
            n[:, 0, -1] += int(toxic.sum())
            n[:, 1, -1] += int((~toxic).sum())
            for view, (d, f, _) in enumerate(features(buf, offs)):
                for kind, m in enumerate((toxic[d], ~toxic[d])):
                    n[view, kind, :-1] += np.bincount(f[m], minlength=1 << BITS)
    for view in range(2):
        at = np.flatnonzero(n[view].any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), view, np.int32)), pa.array(np.where(at == 1 << BITS, -1, at).astype(np.int32)),
             pa.array(n[view, 0, at]), pa.array(n[view, 1, at])], ["view", "feature", "pos", "others"])


def _values(known: list[np.ndarray]):
    """(positive, length, features and values for each classifier) of every text, known features only."""
    wanted = [np.zeros(1 << BITS, bool) for _ in known]
    for w, k in zip(wanted, known):
        w[k] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offs in K.chunks(b.column(0)):
                lists = []
                for d, f, x in features(buf, offs, tuple(wanted)):
                    ends = np.searchsorted(d, np.arange(j - i + 1)).astype(np.int32)
                    lists += [pa.ListArray.from_arrays(ends, pa.array(y)) for y in (f.astype(np.int32), x)]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), pa.array(_length(buf, offs)), *lists],
                                                 ["positive", "length", "f0", "x0", "f1", "x1"])
    return rows


def _known(counts: list[tuple[int, int, int, int]], least_z: float | None) -> list[np.ndarray]:
    n = np.zeros((2, 2, (1 << BITS) + 1), np.int64)
    for view, feature, pos, others in counts:
        n[view, :, feature] += (pos, others)
    return [evidence(n[v, 0, :-1], n[v, 1, :-1], n[v, 0, -1], n[v, 1, -1], least_z) for v in range(2)]


def _fit(positive: np.ndarray, length: np.ndarray, lists: list[tuple[list, list]], known: list[np.ndarray], prior: float) -> Model:
    out = []
    for (f, x), k in zip(lists, known):
        rows = np.repeat(np.arange(len(f)), [len(a) for a in f])
        flat = [np.concatenate([np.zeros(0, t), *[np.asarray(a, t) for a in y]]) for y, t in ((f, np.int64), (x, np.float32))]
        out.append(fit_view(rows, *flat, length, positive, prior, k))
    return out


def fit(positives: list[str], others: list[str], prior: float, least_z: float | None = LEAST_Z) -> Model:
    """The two classifiers from texts at hand."""
    batch = _batch(positives, others)
    known = _known([tuple(r.values()) for b in _held(iter([batch])) for r in b.to_pylist()], least_z)
    got = pa.Table.from_batches(list(_values(known)(iter([batch])))).to_pydict()
    return _fit(np.array(got["positive"]), np.array(got["length"]), [(got["f0"], got["x0"]), (got["f1"], got["x1"])], known, prior)


def logits(buf: np.ndarray, offs: np.ndarray, model: Model, wanted: tuple[np.ndarray, ...]) -> np.ndarray:
    n, total = len(offs) - 1, np.zeros(len(offs) - 1)
    for (d, f, x), (w, by_length, bias) in zip(features(buf, offs, wanted), model):
        total += np.bincount(d, weights=w[f] * x, minlength=n) + by_length * _length(buf, offs) + bias
    return total / len(model)


def train(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
          training: Column | None = None, least_z: float | None = LEAST_Z) -> Model:
    """The model from rows of ``labels`` marked 1 and the other texts, both among the ``training`` rows."""
    spark = df.sparkSession
    docs = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where("label is not null")
    if training is not None:
        rule = F.expr("id is not null")  # ids are compared by the caller's rule on a column named id
        docs, marks = docs.where(rule & training), marks.where(rule & training)
    share = marks.agg(F.avg("label"), F.sum("label")).first()
    prior = min(max(float(share[0] or 0), 1e-3), 0.5)
    if not share[1]:
        return [(np.zeros(1 << BITS, np.float32), 0.0, float(np.log(prior / (1 - prior))))] * 2
    lowest = F.xxhash64("id")
    toxic = marks.where("label = 1").select("id").distinct()
    some = toxic.orderBy(lowest).limit(POSITIVES)
    pos = docs.join(some, "id", "left_semi").limit(2 * POSITIVES)
    # Unlabelled: a sample of all texts, of which about the prior's share is toxic too.
    un = docs.join(docs.select("id").distinct().orderBy(lowest, "id").limit(UNLABELLED), "id", "left_semi").limit(2 * UNLABELLED)
    path = scratch_path(spark, "sample")
    texts = materialize(pos.select("text", F.lit(True).alias("positive")).unionByName(
        un.select("text", F.lit(False).alias("positive"))), path=path)
    held = texts.mapInArrow(_held, "view int, feature int, pos long, others long").groupBy("view", "feature").agg(
        F.sum("pos").alias("pos"), F.sum("others").alias("others"))
    # A row for each feature that is learnt, 2**BITS for each classifier at most.
    known = _known([tuple(r) for r in held.where((F.col("pos") >= LEAST_TEXTS) | (F.col("feature") < 0)).collect()], least_z)
    got = texts.mapInArrow(_values(known), "positive boolean, length double, f0 array<int>, x0 array<float>, "
                                           "f1 array<int>, x1 array<float>").toArrow().to_pydict()
    drop_path(spark, path)
    return _fit(np.array(got["positive"], bool), np.array(got["length"]), [(got["f0"], got["x0"]), (got["f1"], got["x1"])], known, prior)


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with the column ``score``, from 0 to 1."""
    wanted = tuple(w != 0 for w, _, _ in model)
    at, fields = df.columns.index(text), df.schema.fields

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [logits(buf, offs, model, wanted) for _, _, buf, offs in K.chunks(b.column(at))]
            x = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))],
                                             [f.name for f in fields] + ["score"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return df.mapInArrow(rows, f"{head}, score double")
