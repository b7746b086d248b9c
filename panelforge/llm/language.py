"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two GRUs read a text's bytes in windows, one forward and one backward; from both states every
position gets a probability for each language, and the mean over all positions of the document is
the document's. The network is trained in numpy by backpropagation through time on windows from
a bounded sample of labelled documents (``docs_per_language``, ``windows_per_doc``); prediction
reads every byte of every text.

Scale. The sample is a partial top-n by hash, so it costs one narrow pass, and the model is a few
thousand numbers. Prediction is a map over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.words import blocks, flat, give_back

WINDOW = 128
HIDDEN = 8
DOCS_PER_LANGUAGE = 300
WINDOWS_PER_DOC = 4
EPOCHS = 4
UNKNOWN = "und"
# Documents whose best language has a smaller share are in none of the learned ones.
LEAST_SCORE = 0.35

_PAD = 256
_BATCH = 64
_BLOCK = 192 << 10


def _glorot(rng, *shape):
    return (rng.standard_normal(shape) * np.sqrt(2 / (shape[-1] + shape[-2]))).astype(np.float32)


def _squash(x: np.ndarray, scratch: np.ndarray) -> None:
    """x / (1 + |x|) in place: between -1 and 1 like tanh, at a fraction of its cost."""
    np.abs(x, out=scratch)
    scratch += 1
    x /= scratch


class ByteGru:
    """Gates and candidates use x / (1 + |x|) where tanh is usual. Parameters: T (bytes to gate inputs), U (state to gates), V and c (states to languages);
    the first axis of T, U and V is the direction. Gates are update, reset, candidate. The last
    axis of all states and gates is the batch, so that every step works on long rows."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.T = (0.1 * rng.standard_normal((2, 3 * hidden, _PAD + 1))).astype(np.float32)
        self.T[:, :hidden] += 1  # remember by default
        self.U = _glorot(rng, 2, 3 * hidden, hidden)
        self.V = _glorot(rng, 2, len(languages), hidden)
        self.c = np.zeros(len(languages), np.float32)

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each position, (length, 2, hidden, batch); x is (batch, length) bytes.

        The backward direction is stored in its own reading order. ``keep`` receives what the
        backward pass needs.
        """
        length, size, H = x.shape[1], len(x), self.hidden
        seen = np.ascontiguousarray(x.T)
        out = np.empty((length, 2, H, size), self.U.dtype)
        h = np.zeros((2, H, size), self.U.dtype)
        T, U = np.ascontiguousarray(self.T.transpose(0, 2, 1)), self.U
        a, g = np.empty((2, 3 * H, size), T.dtype), np.empty((2, 3 * H, size), T.dtype)
        n, wide, narrow = np.empty((2, H, size), T.dtype), np.empty((2, 2 * H, size), T.dtype), np.empty((2, H, size), T.dtype)
        for t in range(length):
            a[0] = T[0].take(seen[t], axis=0).T
            a[1] = T[1].take(seen[length - 1 - t], axis=0).T
            np.matmul(U, h, out=g)
            gates = a[:, : 2 * H]
            gates += g[:, : 2 * H]
            _squash(gates, wide)
            gates += 1
            gates *= 0.5
            z, r, q = gates[:, :H], gates[:, H:], g[:, 2 * H :]
            np.multiply(r, q, out=n)
            n += a[:, 2 * H :]
            _squash(n, narrow)
            if keep is not None:
                keep.append((h, z.copy(), r.copy(), q.copy(), n.copy()))
            np.subtract(h, n, out=out[t])
            h = out[t]
            h *= z
            h += n
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(length, languages, batch): softmax of both directions' votes on each position."""
        p = np.matmul(self.V[0], states[:, 0])
        p += np.matmul(self.V[1], states[::-1, 1])
        p += self.c[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the positions that are bytes, and its gradients, through time."""
        length, H = x.shape[1], self.hidden
        kept: list = []
        states = self.states(x, kept)
        p = self.probabilities(states)
        real = (x.T != _PAD).astype(p.dtype)
        n_real = real.sum()
        rows = np.arange(len(x))
        loss = -(np.log(np.maximum(p[:, y, rows], 1e-9)) * real).sum() / n_real
        p[:, y, rows] -= 1
        p *= (real / n_real)[:, None]
        backward = states[::-1, 1]
        grad = {
            "V": np.stack([np.matmul(p, s.transpose(0, 2, 1)).sum(axis=0) for s in (states[:, 0], backward)]),
            "c": p.sum(axis=(0, 2)),
        }
        out = np.empty_like(states)
        out[:, 0] = np.matmul(self.V[0].T, p)
        out[::-1, 1] = np.matmul(self.V[1].T, p)
        gU = np.zeros_like(self.U)
        gx = np.empty((length, 2, 3 * H, len(x)), p.dtype)
        dh = np.zeros_like(out[0])
        turned = self.U.transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            h, z, r, q, n = kept[t]
            dh = dh + out[t]
            da_n = dh * (1 - z) * (1 - np.abs(n)) ** 2
            da_z = dh * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            da_r = da_n * q * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            g = np.concatenate([da_z, da_r, da_n * r], axis=1)
            gx[t, :, : 2 * H] = g[:, : 2 * H]
            gx[t, :, 2 * H :] = da_n
            gU += np.matmul(g, h.transpose(0, 2, 1))
            dh = dh * z + np.matmul(turned, g)
        grad["U"] = gU
        seen = x.T.reshape(-1)
        hot = np.zeros((len(seen), _PAD + 1), p.dtype)
        hot[np.arange(len(seen)), seen] = 1
        flat_x = [d.transpose(1, 0, 2).reshape(3 * H, -1) for d in (gx[:, 0], gx[::-1, 1])]
        grad["T"] = np.stack([d @ hot for d in flat_x])
        return float(loss), grad

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 0) -> float:
        """Adam over shuffled batches; the rate falls to a tenth. Returns the last epoch's loss."""
        rng = np.random.default_rng(seed)
        names = ("T", "U", "V", "c")
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        steps, step, mean = max(1, epochs * -(-len(x) // _BATCH)), 0, 0.0
        for _ in range(epochs):
            losses = []
            order = rng.permutation(len(x))
            for lo in range(0, len(x), _BATCH):
                pick = order[lo : lo + _BATCH]
                loss, grad = self.gradients(x[pick], y[pick])
                losses.append(loss)
                norm = float(np.sqrt(sum(float((g * g).sum()) for g in grad.values())))
                scale = min(1.0, 1.0 / max(norm, 1e-9))
                step += 1
                now = rate * (1 - 0.9 * step / steps)
                for k in names:
                    g = grad[k] * scale
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                    setattr(self, k, getattr(self, k) - (now * m / (np.sqrt(v) + 1e-8)).astype(np.float32))
            mean = float(np.mean(losses)) if losses else 0.0
        return mean

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text over all its bytes: (texts, languages); 0 if empty."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        size = np.diff(offsets)
        for i, j in blocks(offsets, _BLOCK):
            n = size[i:j]
            doc = np.repeat(np.arange(i, j), -(-n // WINDOW))
            if not len(doc):
                continue
            # Windows lie side by side; the last one of a text ends with it and counts only what is new.
            nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
            at = nth * WINDOW
            begin = np.maximum(np.minimum(at, size[doc] - WINDOW), 0)
            low, high = at - begin, np.minimum(size[doc] - begin, WINDOW)
            step = np.arange(WINDOW)
            for lo in range(0, len(doc), 2048):
                part = slice(lo, lo + 2048)
                where = (offsets[doc[part]] + begin[part])[:, None] + step
                x = np.where(step < high[part, None], data[np.minimum(where, len(data) - 1)], _PAD).astype(np.int64)
                p = self.probabilities(self.states(x))
                counted = (step >= low[part, None]) & (step < high[part, None])
                if not counted.all():
                    p *= counted.T[:, None]
                np.add.at(out, doc[part], p.sum(axis=0).T)
        return out / np.maximum(size, 1)[:, None]


def is_held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id's decimal text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows(text: bytes, count: int, length: int = WINDOW) -> list[bytes]:
    """``count`` windows evenly over the whole text; one padded window if it is short."""
    if len(text) <= length:
        return [text]
    count = min(count, -(-len(text) // length))
    return [text[k : k + length] for k in np.linspace(0, len(text) - length, count).astype(int)]


def train_model(
    docs: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    windows_per_doc: int = WINDOWS_PER_DOC,
    hidden: int = HIDDEN,
    epochs: int = EPOCHS,
) -> ByteGru:
    """Learn from text and lang of at most ``docs_per_language`` documents per language.

    Taken are the labelled documents with a letter that are not held out, in the order of a hash of
    their text; copies of a text count once. Only ``windows_per_doc`` windows of ``WINDOW`` bytes of each reach the driver.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")
    )
    first = Window.partitionBy("lang").orderBy("code")
    picked = (
        known.groupBy("lang", F.xxhash64("text").alias("code")).agg(F.min("doc_id").alias("doc_id"))
        .withColumn("rn", F.row_number().over(first))
        .where(F.col("rn") <= docs_per_language)
        .select("doc_id", "lang", "code")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (lang, part)
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())
                for part in windows(text.encode("utf-8", "surrogatepass"), windows_per_doc)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["lang", "part"]
            )

    # At most docs_per_language rows per language: small enough to send to the readers.
    sample = known.withColumn("code", F.xxhash64("text")).join(F.broadcast(picked), ["doc_id", "lang", "code"])
    # A row may be repeated: one of each is kept, the partial minimum in the reading task.
    sample = sample.groupBy("lang", "code").agg(F.min("text").alias("text"))
    rows = sample.select("lang", "text").mapInArrow(cut, "lang string, part binary").collect()
    rows = sorted((r["lang"], bytes(r["part"])) for r in rows)
    languages = sorted({r[0] for r in rows})
    x = np.full((len(rows), WINDOW), _PAD, np.int64)
    for k, (_, part) in enumerate(rows):
        x[k, : len(part)] = np.frombuffer(part, np.uint8)
    y = np.array([languages.index(r[0]) for r in rows], np.int64)
    model = ByteGru(languages, hidden)
    if len(languages) > 1:
        model.train(x, y, epochs)
    return model


def predict_language(docs: DataFrame, model: ByteGru | None = None) -> DataFrame:
    """Language of every whole text of ``docs`` (doc_id, text, lang).

    Returns doc_id, held_out, lang_pred (a learned language, or ``und``), score (mean probability of that
    language over the text's bytes, 4 decimals).

    Null texts and texts without a letter are ``und`` with score 0; so is everything if there is nothing
    to learn from. Equal texts get equal results; of equal scores the first language in the
    alphabet wins. Rows without doc_id are not held out and never learned from. One learned language alone has
    score 1. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(model or train_model(docs))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru = known.value
        for batch in batches:
            # Texts without letters arrive as null.
            data, offsets = flat(batch.column("letters"))
            some = np.diff(offsets) > 0
            if gru.languages:
                scores = np.round(gru.documents(data, offsets), 4)
                best = scores.argmax(axis=1)
                names = [gru.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
                score = np.where(some, scores[np.arange(len(best)), best], 0.0)
            else:
                names, score = [UNKNOWN] * len(some), np.zeros(len(some))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("letters"),
    ).mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def in_known_language(
    docs: DataFrame, least_score: float = LEAST_SCORE, model: ByteGru | None = None
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known.

    Rejected are texts that are null or without a letter, and texts whose best language scores under
    ``least_score``: clean prose in a learned language scores far above.
    """
    known = docs.sparkSession.sparkContext.broadcast(model or train_model(docs))

    @F.arrow_udf("double")
    def best(letters: pa.Array) -> pa.Array:
        data, offsets = flat(letters)
        if not known.value.languages:
            return pa.array((np.diff(offsets) > 0).astype(float))
        scores = np.round(known.value.documents(data, offsets), 4).max(axis=1, initial=0.0)
        give_back()
        return pa.array(scores)

    return docs.where(best(F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))) >= least_score)
