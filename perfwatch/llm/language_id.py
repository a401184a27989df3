"""Language identification: sparse multinomial logistic regression on character n-grams.

*Features.* Letters are lower-cased, everything else is a blank, runs of blanks
are one. Runs of one to three characters are hashed to ``2**BITS`` features; a
feature weighs (1 + ln count) times its inverse document frequency, and the
vector has length one. Document frequencies count *all* training documents.

*Training.* Follow-the-regularised-leader with L1 and L2 penalties (per
coordinate step sizes, so most weights are exactly zero) over a bounded sample
of different labelled texts (``SAMPLE`` in expectation, at most twice that),
spread evenly over the languages and drawn by a hash. Texts become feature
counts where they are read; one task learns from those, and the driver sees
neither texts nor vectors. A slice of the sample is held back to fit
one temperature, which turns scores into calibrated probabilities.

*Prediction* reads whole texts in one pass without a shuffle; the weights
travel with the task (one float for each kept feature and language).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfwatch.llm import text as tx

BITS = 16
SAMPLE = 6000
NONE = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def grams(text: str) -> np.ndarray | None:
    """Hashed 1-, 2- and 3-grams of a text; None if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    c = np.zeros(len(codes) + 2, np.uint32)
    c[1:-1] = np.where(letter, codes, 0)
    c = c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]
    shift = np.uint32(32 - BITS)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
    return np.concatenate([one, two ^ (two >> np.uint32(13)), three ^ (three >> np.uint32(15))]) >> shift


def _texts(batch: pa.RecordBatch):
    return (x or "" for x in batch.column("text").to_pylist())


def _frequencies(batches):
    """Documents with each feature: one row per feature and task."""
    seen, docs = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in _texts(batch):
            g = grams(text)
            if g is not None:
                seen += np.bincount(g, minlength=1 << BITS) > 0
                docs += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(seen[at], docs))], names=["feature", "docs"]
    )


def _counts(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text and how often each occurs."""
    counts = np.bincount(g, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / max(np.sqrt(x @ x), 1e-12)


_SAMPLED = "place long, lang string, features binary, counts binary"
_MODEL = "languages array<string>, used binary, weights binary, bias binary, temperature double"


def _sampled(batches):
    """Feature counts of the texts that have a letter: of bounded size, however long a text is."""
    for batch in batches:
        rows = []
        for place, lang, text in zip(batch.column("place").to_pylist(), batch.column("lang").to_pylist(), _texts(batch), strict=True):
            g = grams(text)
            if g is not None:
                at, counts = _counts(g)
                rows.append((place, lang, at.astype(np.uint16).tobytes(), counts.astype(np.uint32).tobytes()))
        columns = zip(*rows, strict=True) if rows else [()] * 4
        types = (pa.int64(), pa.string(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["place", "lang", "features", "counts"])


@dataclass
class Model:
    """``weights`` has a row for each feature in ``used`` and one column per language."""

    languages: list[str]
    idf: np.ndarray
    used: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def dense(self) -> np.ndarray:
        full = np.zeros((1 << BITS, len(self.languages)), np.float32)
        full[self.used] = self.weights
        return full


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = 3,
    alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x languages) and biases, by proximal follow-the-regularised-leader."""
    z = np.zeros((1 << BITS, languages))
    n = np.zeros((1 << BITS, languages))
    zb, nb = np.zeros(languages), np.zeros(languages)

    def solve(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            w, b = solve(z[at], n[at], l1), solve(zb, nb, 0.0)
            error = _softmax(x @ w + b)
            error[y] -= 1
            g = np.outer(x, error)
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
            zb += error - (np.sqrt(nb + error * error) - np.sqrt(nb)) / alpha * b
            nb += error * error
    return solve(z, n, l1), solve(zb, nb, 0.0)


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden section on its logarithm."""
    if not len(truth):
        return 1.0

    def loss(t):
        return -np.log(_softmax(scores / np.exp(t))[np.arange(len(truth)), truth] + 1e-300).mean()

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(training: DataFrame, sample: int = SAMPLE, **settings) -> Model | None:
    """Learn from ``text`` and ``lang``; rows with a null in either are left out.

    None if no labelled document has a letter. Weights are fitted on ``sample``
    different texts in expectation and at most twice as many; ``doc_id`` only
    takes part in the draw. Frequencies always count all documents.
    """
    rows = training.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    # One row per language, as many as the model has columns.
    per_lang = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not per_lang:
        return None
    shares = F.create_map(*[F.lit(x) for k, n in per_lang.items() for x in (k, min(1.0, sample / len(per_lang) / n))])
    place = F.xxhash64("doc_id", "text")
    u = F.shiftrightunsigned(place, 11) * F.lit(2.0**-53)
    drawn = (
        rows.filter(u < shares[F.col("lang")]).dropDuplicates(["text", "lang"]).select(place.alias("place"), "lang", "text")
        .mapInArrow(_sampled, _SAMPLED).orderBy("place", "lang", "features", "counts").limit(2 * sample)
    )
    counted = rows.select("text").mapInArrow(_frequencies, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))
    seen = counted.toArrow()
    feature, n = (seen.column(c).to_numpy() for c in ("feature", "docs"))
    docs = int(n[feature < 0].sum())
    if not docs:
        return None
    idf = np.zeros(1 << BITS, np.float32)
    has = feature >= 0
    idf[feature[has]] = np.log((1 + docs) / (1 + n[has])) + 0.1
    # The sample is bounded in rows and bytes, so one task learns from it; the driver gets the weights alone.
    found = drawn.coalesce(1).mapInArrow(_learn(idf, settings), _MODEL).first()
    if found is None:
        return None
    used, weights, bias = (np.frombuffer(x, t) for x, t in ((found.used, np.int32), (found.weights, np.float32), (found.bias, np.float64)))
    return Model(found.languages, idf, used, weights.reshape(len(used), -1), bias, found.temperature)


def _learn(idf: np.ndarray, settings: dict):
    """One row: the model learned from all rows of the sample; none if there is none."""
    def run(batches):
        rows = []
        for batch in batches:
            rows += zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
        if not rows:
            return
        rows.sort()
        languages = sorted({lang for _, lang, _, _ in rows})
        index = {lang: i for i, lang in enumerate(languages)}
        vectors = []
        for _, lang, features, counts in rows:
            at = np.frombuffer(features, np.uint16).astype(np.int64)
            vectors.append((at, _vector(at, np.frombuffer(counts, np.uint32), idf), index[lang]))
        held = vectors[::5] if len(vectors) >= 50 else []
        kept = [v for i, v in enumerate(vectors) if i % 5] if held else vectors
        weights, bias = ftrl(kept, len(languages), **settings)
        used = np.flatnonzero(np.abs(weights).sum(axis=1))
        scores = np.array([x @ weights[at] + bias for at, x, _ in held]).reshape(len(held), len(languages))
        heat = temperature(scores, np.array([y for *_, y in held], int))
        parts = [languages, used.astype(np.int32).tobytes(), weights[used].astype(np.float32).tobytes(), bias.tobytes(), heat]
        types = [pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(parts, types, strict=True)], names=["languages", "used", "weights", "bias", "temperature"])

    return run


def _predict(model: Model):
    def run(batches):
        full, idf = model.dense(), model.idf
        for batch in batches:
            names, scores = [], []
            for text in _texts(batch):
                g = grams(text)
                if g is None:
                    names.append(NONE)
                    scores.append(0.0)
                    continue
                at, counts = _counts(g)
                x = _vector(at, counts, idf)
                p = _softmax((x @ full[at] + model.bias) / model.temperature)
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` without text, with ``lang_pred`` and ``score`` (calibrated probability).

    Texts that are null or have no letter get ``und`` and 0, as does every text
    when nothing could be learned.
    """
    if model is None:
        return docs.drop("text").withColumns({"lang_pred": F.lit(NONE), "score": F.lit(0.0)})
    names = [c for c in docs.columns if c != "text"]
    read = docs.select(*names, "text")
    schema = T.StructType([*read.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return read.mapInArrow(_predict(model), schema).drop("text")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of ids that never take part in training; a null id is trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document (columns doc_id, text, lang).

    One row per row. Only text and lang of rows that are not held out are
    learned from; a prediction sees the text alone. Null and empty texts are
    ``und`` with score 0; an empty table gives an empty result; repeated rows
    get equal results; other columns are ignored.
    """
    model = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


def identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a probability of ``least`` or more, unchanged.

    Texts that are null or have no letter go.
    """
    model = fit(docs.filter(~held_out()))
    if model is None:
        return docs.limit(0)

    def keep(batches):
        for scored in _predict(model)(batches):
            width = scored.num_columns - 2
            known = tx.pc.not_equal(scored.column(width), NONE)
            sure = tx.pc.greater_equal(scored.column(width + 1), least)
            yield scored.select(list(range(width))).filter(tx.pc.and_(known, sure))

    return docs.mapInArrow(keep, docs.schema)
