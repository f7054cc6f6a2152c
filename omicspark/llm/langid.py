"""Language identification by a byte convolutional network in numpy.

Texts are read as bytes in windows of fixed length. A window's bytes are looked
up in an embedding, filters of several widths slide over it, each keeps its
largest response, and a softmax over the languages follows. A text's
probabilities are the mean of its windows' by their bytes, the whole text over. The network is
trained on the driver on a bounded sample of labelled rows; tasks get its
weights, some ten thousand numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from omicspark.storage import bound_batches, free_name

WINDOW = 256
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE_DOCS = 400  # labelled texts of each language, about
SAMPLE_TEXTS = 100_000  # of all languages, about: 250 or more languages have fewer each, at least one
SAMPLE_CHARS = 1500  # of each, from a place that its hash tells
MOST_LANGUAGES = 10_000  # distinct labels beyond this are no languages: an error, none is left out
EPOCHS = 8
SEED = 7
UNKNOWN = "und"
LETTER = r"\p{L}"  # the same in Spark's patterns and here
_LETTER = regex.compile(LETTER)
_BATCH = 256


def windows_of(data: bytes, window: int = WINDOW) -> np.ndarray:
    """The bytes as rows of ``window``; the last is filled with zeros."""
    flat = np.frombuffer(data, dtype=np.uint8)
    out = np.zeros((max(1, -(-len(flat) // window)), window), dtype=np.uint8)
    out.reshape(-1)[: len(flat)] = flat
    return out


@dataclass
class ByteCnn:
    languages: list[str]
    embed: np.ndarray  # 256 x EMBED
    conv: np.ndarray  # widest * EMBED x filters; narrower filters are zero beyond their width
    conv_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def _spread(self, x: np.ndarray) -> np.ndarray:
        """Embedded bytes of each position and the ones after it, as rows."""
        wide = max(WIDTHS)
        e = self.embed[x]
        n = x.shape[1] - wide + 1
        return np.concatenate([e[:, i : i + n] for i in range(wide)], axis=2)

    def responses(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self._spread(x)
        return cols, *self._pool(cols)

    def _pool(self, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = cols.reshape(-1, cols.shape[2]) @ self.conv
        y = y.reshape(cols.shape[0], cols.shape[1], -1)
        return y, y.max(axis=1) + self.conv_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        found = [self._softmax(np.maximum(self._pool(self._spread(x[i : i + _BATCH]))[1], 0)) for i in range(0, len(x), _BATCH)]
        return np.concatenate(found)

    def _softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = SEED) -> ByteCnn:
    """Adam on the cross entropy of windows (rows of bytes) and language numbers."""
    rng = np.random.default_rng(seed)
    wide, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide, EMBED, filters), dtype=np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(wide * EMBED, filters)
    f32 = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    net = ByteCnn(languages, f32(256, EMBED, scale=0.5), f32(wide * EMBED, filters, scale=0.25) * mask, np.zeros(filters, np.float32), f32(filters, len(languages), scale=0.2), np.zeros(len(languages), np.float32))
    names = ("embed", "conv", "conv_bias", "out", "out_bias")
    m, v, t = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    counts = np.bincount(labels, minlength=len(languages))
    weight = (len(labels) / np.maximum(counts, 1) / len(languages)).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for low in range(0, len(order), 64):
            pick = order[low : low + 64]
            x, y = windows[pick], labels[pick]
            cols, resp, pooled = net.responses(x)
            h = np.maximum(pooled, 0)
            g = net._softmax(h)
            g[np.arange(len(y)), y] -= 1
            g *= weight[y][:, None] / len(y)
            grad = {"out": h.T @ g, "out_bias": g.sum(axis=0)}
            gh = (g @ net.out.T) * (pooled > 0)
            grad["conv_bias"] = gh.sum(axis=0)
            at = resp.argmax(axis=1)  # the position that each filter kept
            taken = cols[np.arange(len(y))[:, None], at]  # batch x filters x (wide * EMBED)
            grad["conv"] = np.einsum("bf,bfc->cf", gh, taken) * mask
            back = (gh[:, :, None] * net.conv.T[None]).reshape(len(y), -1, wide, EMBED)
            grad["embed"] = np.zeros_like(net.embed)
            for i in range(wide):
                np.add.at(grad["embed"], x[np.arange(len(y))[:, None], at + i], back[:, :, i])
            t += 1
            for n in names:
                m[n] = 0.9 * m[n] + 0.1 * grad[n]
                v[n] = 0.999 * v[n] + 0.001 * grad[n] ** 2
                step = 0.01 * (m[n] / (1 - 0.9**t)) / (np.sqrt(v[n] / (1 - 0.999**t)) + 1e-8)
                setattr(net, n, (getattr(net, n) - step).astype(np.float32))
    return net


def fit(docs: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> ByteCnn:
    """A network from a sample of the ``allowed`` rows with a text and a label: about ``sample_docs`` a language.

    The sample is chosen by a hash of the id and the text: rows below the share that
    is sought, and of each language the lowest, so none is without a row. Rows with one
    id and text count once, however many. At most SAMPLE_CHARS characters of each
    text, from a place that the hash tells, and about SAMPLE_TEXTS texts in all come to
    the driver. Every label is learned; over MOST_LANGUAGES of them are an error. One
    language is always the answer. No labelled rows: a network that knows UNKNOWN alone.
    """
    hashed = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(SEED))
    # 50 bits, so that a share of any size can be drawn; a double holds them all.
    draw = F.pmod(hashed, F.lit(1 << 20)) / (1 << 20) + F.pmod(F.shiftright(hashed, 20), F.lit(1 << 30)) / (1 << 50)
    known = docs.where(allowed & F.col(label_col).isNotNull() & F.col(text_col).rlike(LETTER)).select(F.col(label_col).alias("label"), F.col(text_col).alias("text"), draw.alias("draw"), F.xxhash64(F.col(id_col), F.lit(SEED + 1)).alias("place"))
    counts = {r["label"]: (r["n"], r["low"]) for r in known.groupBy("label").agg(F.count("*").alias("n"), F.min("draw").alias("low")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{label_col} has over {MOST_LANGUAGES} values")
    languages = sorted(counts) or [UNKNOWN]
    sample_docs = max(1, min(sample_docs, SAMPLE_TEXTS // len(languages)))
    bounds = F.create_map(*(F.lit(x) for name, (n, low) in counts.items() for x in (name, max(min(1.0, sample_docs / n), low)))) if counts else F.create_map(F.lit(UNKNOWN), F.lit(0.0))
    at = F.pmod("place", F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int")
    chosen = known.where(F.col("draw") <= F.element_at(bounds, F.col("label"))).select("label", "draw", "place", F.substring(F.col("text"), at + 1, F.lit(SAMPLE_CHARS)).cast("binary").alias("data"))
    # Rows that are all alike are drawn together; one stands for them.
    sample = sorted(chosen.dropDuplicates(["label", "draw", "place"]).select("label", "data", "draw").collect(), key=lambda r: (r["draw"], r["label"], bytes(r["data"])))
    number = {name: i for i, name in enumerate(languages)}
    parts = [(windows_of(bytes(r["data"])), number[r["label"]]) for r in sample]
    if not parts or len(languages) == 1:
        return train(np.zeros((1, WINDOW), np.uint8), np.zeros(1, np.int64), languages, epochs=1)
    x = np.concatenate([w for w, _ in parts])
    y = np.concatenate([np.full(len(w), label) for w, label in parts])
    return train(x, y, languages)


def predict_texts(net: ByteCnn, texts: list[bytes | None]) -> list[tuple[str, float]]:
    """(language, score) of each text: whole texts, windows of several texts at a time."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    held, owners, n = [], [], 0

    def flush() -> None:
        p = net.probabilities(np.concatenate(held))
        at = 0
        for (owner, size), w in zip(owners, held):
            # All windows but the last are full.
            mean = (p[at : at + len(w)].sum(axis=0) * WINDOW - p[at + len(w) - 1] * (WINDOW * len(w) - size)) / size
            at += len(w)
            i = int(mean.argmax())
            out[owner] = (net.languages[i], min(1.0, max(0.0, float(mean[i]))))

    for i, text in enumerate(texts):
        if text and _LETTER.search(text.decode("utf-8", "replace")):
            held.append(windows_of(text))
            owners.append((i, len(text)))
            n += len(held[-1])
            if n >= 4 * _BATCH:
                flush()
                held, owners, n = [], [], 0
    if held:
        flush()
    return out


def predict(net: ByteCnn, text_col: str = "text") -> Column:
    """struct<lang_pred, score> of a text column. Null texts and texts without letters are UNKNOWN with score 0."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    def column(texts: pa.Array) -> pa.Array:
        found = predict_texts(net, texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], ["lang_pred", "score"])

    return column(F.col(text_col).cast("binary"))


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows that training never sees: crc32 of the id as text leaves 2 modulo 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """All rows and columns of ``docs`` with held_out, lang_pred and score. An empty table gives no rows.

    Columns of ``docs`` with one of these three names give way to the new ones.
    """
    bound_batches(docs.sparkSession)
    net = fit(docs, ~held_out(id_col), id_col, text_col, label_col)
    own = free_name(docs, "__lang")
    new = ("held_out", "lang_pred", "score")
    told = docs.withColumn(own, F.struct(held_out(id_col).alias(new[0]), predict(net, text_col).alias("told")))
    told = told.withColumn(own, F.struct(F.col(own)["held_out"].alias(new[0]), F.col(own)["told"]["lang_pred"].alias(new[1]), F.col(own)["told"]["score"].alias(new[2])))
    return told.drop(*new).select("*", f"{own}.*").drop(own)


def keep_known(docs: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` with their columns, whatever these are called, whose language is known with a score of at least ``least``."""
    bound_batches(docs.sparkSession)
    own = free_name(docs, "__lang")
    told = docs.withColumn(own, predict(fit(docs, ~held_out(id_col), id_col, text_col, label_col), text_col))
    return told.where((F.col(own)["lang_pred"] != UNKNOWN) & (F.col(own)["score"] >= least)).drop(own)
