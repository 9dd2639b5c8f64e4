"""Language identification by a byte convolutional network, trained and applied in numpy.

A text's UTF-8 bytes are cut into windows of fixed length. Each window goes through byte embeddings,
filters of several widths, a rectifier, max pooling over the window and a softmax over the languages
of the training texts. A whole text is all of its windows: their log-probabilities are averaged by
the number of bytes in each.

For application every filter is turned into one table for each of its places, holding the filter's
answer to each byte, so that convolution becomes a few table look-ups and sums.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import tune

#: Bytes of a window.
WINDOW = 256
WIDTHS = (2, 3, 4)
#: Filters of each width, and the length of a byte's embedding.
FILTERS = 16
EMBEDDING = 8
#: Windows the classifier is fitted on, at most, over all languages: a documented bound.
SAMPLE_WINDOWS = 4000
UNKNOWN = "und"

#: Letters and numerals like ² or Ⅷ; which of them are letters isalpha says.
_LETTER = re.compile(r"[^\W\d_]")
#: Languages learned at most, the most frequent ones.
MOST_LANGS = 500


@dataclass
class Model:
    """langs, and tables[j][byte] = what byte at place j adds to each filter; dense weights and bias."""

    langs: list[str]
    tables: object = None
    bias: object = None
    dense: object = None
    dense_bias: object = None


def has_letter(text: str) -> bool:
    """Whether a text has a letter (Unicode categories L*); the same test for learning and answering."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def windows_of(data: bytes):
    """All windows of a text: an array of n x (WINDOW + widest - 1) bytes, zero-padded, and their byte counts."""
    import numpy as np

    n = max(1, -(-len(data) // WINDOW))
    flat = np.zeros(n * WINDOW, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    out = np.zeros((n, WINDOW + max(WIDTHS) - 1), np.uint8)
    out[:, :WINDOW] = flat.reshape(n, WINDOW)
    sizes = np.full(n, WINDOW)
    sizes[-1] = max(1, len(data) - (n - 1) * WINDOW)
    return out, sizes


def train(samples: list[tuple[bytes, str]], epochs: int = 8, rate: float = 0.01, seed: int = 7) -> Model:
    """Fit the network to (window bytes, language) pairs with Adam; the same pairs give the same model."""
    import numpy as np

    langs = sorted({lang for _, lang in samples})
    if not langs:
        return Model(langs)
    rng = np.random.default_rng(seed)
    x = np.concatenate([windows_of(data[:WINDOW])[0] for data, _ in samples])
    number = {lang: i for i, lang in enumerate(langs)}
    y = np.array([number[lang] for _, lang in samples])
    balance = len(y) / (len(langs) * np.bincount(y, minlength=len(langs)))
    p = {"emb": rng.normal(0, 0.5, (256, EMBEDDING)), "dense": rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))), "out": np.zeros(len(langs))}
    for w in WIDTHS:
        p[f"w{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            grads = _gradients(p, x[rows], y[rows], balance[y[rows]].astype(np.float32))
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return compiled(langs, p)


def compiled(langs: list[str], p: dict) -> Model:
    """The model of trained parameters, with filters as tables of what each byte adds at each place."""
    import numpy as np

    tables = np.zeros((max(WIDTHS), 256, FILTERS * len(WIDTHS)), np.float32)
    for i, w in enumerate(WIDTHS):
        for j in range(w):
            tables[j, :, i * FILTERS : (i + 1) * FILTERS] = p["emb"] @ p[f"w{w}"][j * EMBEDDING : (j + 1) * EMBEDDING]
    return Model(langs, tables, np.concatenate([p[f"b{w}"] for w in WIDTHS]), p["dense"], p["out"])


def _gradients(p, x, y, weight):
    import numpy as np

    n = len(y)
    emb = p["emb"][x]
    pooled, keep = [], []
    for w in WIDTHS:
        cols = np.concatenate([emb[:, j : j + WINDOW] for j in range(w)], axis=2)
        pre = cols @ p[f"w{w}"] + p[f"b{w}"]
        top = pre.argmax(axis=1)
        value = np.take_along_axis(pre, top[:, None], axis=1)[:, 0]
        pooled.append(np.maximum(value, 0))
        keep.append((cols, top, value > 0))
    hidden = np.concatenate(pooled, axis=1)
    logits = hidden @ p["dense"] + p["out"]
    logits -= logits.max(axis=1, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=1, keepdims=True)
    prob[np.arange(n), y] -= 1
    d = prob * weight[:, None] / n
    grads = {"dense": hidden.T @ d, "out": d.sum(axis=0), "emb": np.zeros_like(p["emb"])}
    back = d @ p["dense"].T
    for i, w in enumerate(WIDTHS):
        cols, top, on = keep[i]
        g = back[:, i * FILTERS : (i + 1) * FILTERS] * on
        picked = np.take_along_axis(cols, top[:, :, None], axis=1)  # n x filters x (w * embedding)
        grads[f"w{w}"] = np.einsum("nf,nfe->ef", g, picked)
        grads[f"b{w}"] = g.sum(axis=0)
        into = g[:, :, None] * p[f"w{w}"].T[None]
        for j in range(w):
            np.add.at(grads["emb"], x[np.arange(n)[:, None], top + j], into[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
    return grads


def window_log_probs(model: Model, x):
    """Log-probabilities of each window over model.langs."""
    import numpy as np

    out = np.empty((len(x), len(model.langs)), np.float32)
    for at in range(0, len(x), 64):
        part = x[at : at + 64]
        pre = model.tables[0][part[:, :WINDOW]]
        for j in range(1, len(model.tables)):
            pre += model.tables[j][part[:, j : j + WINDOW]]
        hidden = np.maximum(pre.max(axis=1) + model.bias, 0)
        logits = hidden @ model.dense + model.dense_bias
        logits -= logits.max(axis=1, keepdims=True)
        out[at : at + 64] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return out


def predict(model: Model, texts: list[str | None], batch_windows: int = 4096) -> tuple[list[str], list[float]]:
    """Language and score of every whole text; UNKNOWN and 0.0 for null, for no letter, or for an untrained model."""
    import numpy as np

    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.langs:
        return langs, scores
    sums = np.zeros((len(texts), len(model.langs)))
    totals = np.zeros(len(texts))
    waiting, n_waiting = [], 0

    def flush():
        nonlocal waiting, n_waiting
        if waiting:
            x = np.concatenate([w[1] for w in waiting])
            sizes = np.concatenate([w[2] for w in waiting])
            owner = np.repeat([w[0] for w in waiting], [len(w[1]) for w in waiting])
            np.add.at(sums, owner, window_log_probs(model, x) * sizes[:, None])
            np.add.at(totals, owner, sizes)
            waiting, n_waiting = [], 0

    for i, text in enumerate(texts):
        if text is None or not has_letter(text):
            continue
        x, sizes = windows_of(text.encode())
        for at in range(0, len(x), batch_windows):
            waiting.append((i, x[at : at + batch_windows], sizes[at : at + batch_windows]))
            n_waiting += len(waiting[-1][1])
            if n_waiting >= batch_windows:
                flush()
    flush()
    for i in np.flatnonzero(totals):
        mean = sums[i] / totals[i]
        prob = np.exp(mean - mean.max())
        prob /= prob.sum()
        langs[i], scores[i] = model.langs[int(prob.argmax())], float(min(1.0, prob.max()))
    return langs, scores


def fit(docs: DataFrame, sample_windows: int = SAMPLE_WINDOWS) -> Model:
    """Train on rows of docs (text, lang): one window of each of a bounded sample of rows.

    Texts are picked by their hash, as many of each language as an even share of the bound (all where
    there are fewer); copies of a text teach once, however many there are, and what is more than twice
    the bound goes in the order of a hash. Null langs and texts without a letter are not learned from.
    At most MOST_LANGS languages are learned.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()}
    if not counts:
        return train([])
    share = max(1, sample_windows // len(counts))
    grain = 1 << 20
    draw = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(grain))
    chances = F.create_map(*[v for k, n in sorted(counts.items()) for v in (F.lit(k), F.lit(min(grain, -(-share * grain // n))))])
    picked = rows.where(draw < F.try_element_at(chances, F.col("lang")))

    def cut(batches):
        for batch in batches:
            data, langs = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if has_letter(text):
                    raw = text.encode()
                    start = zlib.crc32(raw) % max(1, len(raw) - WINDOW + 1)
                    data.append(raw[start : start + WINDOW])
                    langs.append(lang)
            yield pa.record_batch([pa.array(data, pa.binary()), pa.array(langs, pa.string())], names=["data", "lang"])

    sample = picked.mapInArrow(cut, "data binary, lang string").distinct()
    kept = sample.orderBy(F.xxhash64("data", "lang"), "data", "lang").limit(2 * sample_windows).collect()
    return train(sorted((bytes(r.data), r.lang) for r in kept))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score; only text is looked at. Columns of these names are replaced.

    Null text or no letter: lang_pred und, score 0. Repeated rows: the same answers. No rows: none.
    """

    @F.pandas_udf("lang_pred string, score double")
    def answer(text):
        import pandas as pd

        langs, scores = predict(model, [None if t is None or t != t else t for t in text])
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    tune(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(F.struct(*names).alias("row"), answer("text").alias("answer")).select("row.*", "answer.*")


def held_out(doc_id: Column) -> Column:
    """The fold that is kept from training: crc32 of the id's text modulo 4 is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_and_identify(docs: DataFrame, sample_windows: int = SAMPLE_WINDOWS) -> DataFrame:
    """Train outside the held-out fold and answer for all rows: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), sample_windows)
    return identify(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model).drop("text")
