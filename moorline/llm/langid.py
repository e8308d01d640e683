"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs read the bytes of a text forwards and backwards; a linear layer labels
every position with a language distribution; a document's probabilities are the
mean over its positions.  The network is written in numpy, trained by
backpropagation through time with Adam on a bounded sample: for each language
the ``per_language`` labelled documents with the smallest identifier hash, with all
of their text.  Texts are read in chunks of about ``CHUNK`` bytes, cut before a character and not inside one, at
whose ends the state starts anew; learning and judging cut alike.  The whole of every text is
scored, and the memory needed does not follow the length of a text.

Padding leaves the state at zero, so what a chunk is given does not depend on the chunks beside it.

Defined results: a null, empty or letterless text is ``und`` with score 0; without any
labelled row every text is ``und``; labels of null are not learned from; repeated rows
are judged alike; a null identifier counts as the empty string when documents are
held out; of languages with equal probabilities the first in order wins; an empty table has no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_arrow

HIDDEN, CHUNK, BATCH = 16, 96, 2048
PER_LANGUAGE, EPOCHS, RATE, SEED = 120, 6, 0.02, 7
UNKNOWN = "und"
PAD = 256


def _sigmoid(x):
    """In place; by way of tanh, which numpy vectorises."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += 1
    x *= np.float32(0.5)
    return x


@dataclass
class Gru:
    """One direction.  Input weights are a row per byte value (and one for padding)."""

    xr: np.ndarray
    xz: np.ndarray
    xc: np.ndarray
    ur: np.ndarray
    uz: np.ndarray
    uc: np.ndarray

    @classmethod
    def new(cls, rng, hidden: int) -> "Gru":
        def x():
            return (rng.standard_normal((PAD + 1, hidden)) * 0.3).astype("f4")

        def u():
            return (np.linalg.qr(rng.standard_normal((hidden, hidden)))[0] * 0.7).astype("f4")
        return cls(x(), x() + np.float32(0.5), x(), u(), u(), u())

    def parameters(self):
        return [self.xr, self.xz, self.xc, self.ur, self.uz, self.uc]

    def run(self, x, order, out):
        """States without keeping anything for training; ``out(i, h)`` sees each of them."""
        n, hidden = x.shape[1], len(self.ur)
        h = np.zeros((n, hidden), dtype="f4")
        r, z, c, m = (np.empty((n, hidden), dtype="f4") for _ in range(4))
        padded = (x == PAD).any(axis=1)
        for i in order:
            np.take(self.xr, x[i], axis=0, out=r, mode="clip")
            np.take(self.xz, x[i], axis=0, out=z, mode="clip")
            np.take(self.xc, x[i], axis=0, out=c, mode="clip")
            r += np.matmul(h, self.ur, out=m)
            _sigmoid(r)
            z += np.matmul(h, self.uz, out=m)
            _sigmoid(z)
            r *= np.matmul(h, self.uc, out=m)
            c += r
            np.tanh(c, out=c)
            h -= c
            h *= z
            h += c
            if padded[i]:
                h *= (x[i] != PAD)[:, None]
            out(i, h)

    def step(self, x, h, keep=None):
        r = self.xr[x]
        r += h @ self.ur
        _sigmoid(r)
        z = self.xz[x]
        z += h @ self.uz
        _sigmoid(z)
        s = h @ self.uc
        c = r * s
        c += self.xc[x]
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((x, h, r, z, s, c))
        new = h - c
        new *= z
        new += c
        new *= (x != PAD)[:, None]
        return new

    def backward(self, kept, outer):
        """Gradients given the gradient of the loss by every state (in step order)."""
        g = [np.zeros_like(p) for p in self.parameters()]
        dh = np.zeros_like(outer[0])
        for (x, h, r, z, s, c), out in zip(reversed(kept), reversed(outer)):
            dh = (dh + out) * (x != PAD)[:, None]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * s * r * (1 - r)
            ds = dc * r
            for table, d in ((g[0], dr), (g[1], dz), (g[2], dc)):
                np.add.at(table, x, d)
            g[3] += h.T @ dr
            g[4] += h.T @ dz
            g[5] += h.T @ ds
            dh = dh * z + dr @ self.ur.T + dz @ self.uz.T + ds @ self.uc.T
        return g


@dataclass
class Network:
    languages: list[str]
    ahead: Gru
    back: Gru
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> "Network":
        rng = np.random.default_rng(seed)
        return cls(languages, Gru.new(rng, hidden), Gru.new(rng, hidden),
                   (rng.standard_normal((2 * hidden, len(languages))) * 0.3).astype("f4"),
                   np.zeros(len(languages), dtype="f4"))

    def parameters(self):
        return [*self.ahead.parameters(), *self.back.parameters(), self.out, self.bias]

    def gradients(self, x: np.ndarray, y: np.ndarray):
        """Mean cross-entropy over all real positions of x (steps x rows), and its gradients."""
        t, n = x.shape
        hidden = self.out.shape[0] // 2
        kept_a, kept_b = [], []
        ahead, back = [], [None] * t
        h = np.zeros((n, hidden), dtype="f4")
        for i in range(t):
            h = self.ahead.step(x[i], h, kept_a)
            ahead.append(h)
        h = np.zeros((n, hidden), dtype="f4")
        for i in reversed(range(t)):
            h = self.back.step(x[i], h, kept_b)
            back[i] = h
        states = np.concatenate([np.stack(ahead), np.stack(back)], axis=2)
        logits = states @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        real = (x != PAD)
        count = max(1, int(real.sum()))
        loss = -float((np.log(p[:, np.arange(n), y] + 1e-9) * real).sum()) / count
        d = p
        d[:, np.arange(n), y] -= 1
        d *= real[:, :, None] / np.float32(count)
        ds = d @ self.out.T
        g_a = self.ahead.backward(kept_a, list(ds[:, :, :hidden]))
        g_b = self.back.backward(kept_b, list(ds[::-1, :, hidden:]))
        flat = states.reshape(-1, 2 * hidden)
        return loss, [*g_a, *g_b, flat.T @ d.reshape(-1, d.shape[2]), d.sum(axis=(0, 1))]

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Sum of the position distributions of every row of x (steps x rows, padded at the end)."""
        t, n = x.shape
        hidden, k = self.out.shape[0] // 2, len(self.languages)
        logits, total = np.empty((t, n, k), dtype="f4"), np.zeros((n, k), dtype="f4")

        def ahead(i, h):
            np.matmul(h, self.out[:hidden], out=logits[i])

        def back(i, h):
            p = h @ self.out[hidden:]
            p += logits[i]
            p += self.bias
            np.exp(p, out=p)
            p *= ((x[i] != PAD) / (p @ np.ones(k, dtype="f4")))[:, None]
            np.add(total, p, out=total)

        self.ahead.run(x, range(t), ahead)
        self.back.run(x, reversed(range(t)), back)
        return total


def train(windows: list[tuple[bytes, str]], epochs: int = EPOCHS, rate: float = RATE, batch: int = 128,
          hidden: int = HIDDEN, seed: int = SEED) -> Network | None:
    """Fit by backpropagation through time; None without windows."""
    if not windows:
        return None
    languages = sorted({y for _, y in windows})
    net = Network.new(languages, hidden, seed)
    x = np.full((max(len(w) for w, _ in windows), len(windows)), PAD, dtype=np.int64)
    for j, (w, _) in enumerate(windows):
        x[:len(w), j] = np.frombuffer(w, dtype=np.uint8)
    y = np.array([languages.index(v) for _, v in windows])
    rng = np.random.default_rng(seed)
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    steps, step = epochs * -(-len(y) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), batch):
            at = order[i:i + batch]
            _, grads = net.gradients(x[:, at], y[at])
            step += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            pace = rate * (1 - (step - 1) / steps) * min(1.0, 1.0 / (norm + 1e-9))
            pace_own = rate * (1 - (step - 1) / steps)
            for p, g, (m, v) in zip(net.parameters(), grads, moment):
                g = g * np.float32(pace / pace_own)
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                p -= np.float32(pace_own) * (m / np.float32(1 - 0.9 ** step)) \
                    / (np.sqrt(v / np.float32(1 - 0.99 ** step)) + np.float32(1e-8))
    return net


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def chunks(raw: np.ndarray, offsets: np.ndarray, lengths: np.ndarray):
    """(text, start, size) of the chunks of texts that start at ``offsets`` and have ``lengths`` bytes: cut at
    multiples of CHUNK, or before the character that such a cut would divide."""
    count = -(-lengths // CHUNK)
    row = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[row] + nth * CHUNK
    for _ in range(3):
        start = start - ((nth > 0) & ((raw[start] & 0xC0) == 0x80) if len(row) else 0)
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end = np.where(last, (offsets[:len(lengths)] + lengths)[row], np.append(start[1:], 0) if len(row) else start)
    return row, start, end - start


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col="doc_id", text_col="text",
           label_col="lang") -> list[tuple[bytes, str]]:
    """The chunks of the training sample: at most per_language documents of each label, whole."""
    text = F.col(text_col).cast("string")
    order = F.xxhash64(F.col(id_col).cast("string"))
    rows = docs.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull()) \
        .withColumns({"__o": order, "__b": F.shiftrightunsigned(order, 54).cast("int")})
    # 1024 hash ranges: up to which one a label has enough rows is known from counts, so
    # only about as many rows as are wanted are ranked.
    cut = {}
    for r in sorted(rows.groupBy(F.col(label_col).alias("y"), "__b").agg(F.count(F.lit(1)).alias("n")).collect()):
        had, to = cut.get(r.y, (0, -1))
        if had < per_language:
            cut[r.y] = (had + r.n, r["__b"])
    enough = F.lit(False)
    for y, (_, to) in sorted(cut.items()):
        enough = enough | ((F.col(label_col) == y) & (F.col("__b") <= to))
    rows = rows.where(enough).where(text.rlike(r"\p{L}")).select(F.col(label_col).alias("y"), F.col("__o").alias("o"), text.alias("text"))
    rank = F.row_number().over(Window.partitionBy("y").orderBy("o", "text"))
    out = set()
    for r in rows.withColumn("r", rank).where(F.col("r") <= per_language).collect():
        raw = np.frombuffer(r.text.encode(), dtype=np.uint8)
        for _, start, size in zip(*chunks(raw, np.zeros(1, np.int64), np.array([len(raw)]))):
            out.add((raw[start:start + size].tobytes(), r.y))
    return sorted(out)


def judge(net: Network | None, text: pa.Array, known: np.ndarray):
    """(language, score) of every text of an Arrow array; ``known`` is false where a text has no letter."""
    data = text.cast(pa.large_binary()).fill_null(b"")
    if net is None or not len(data):
        return [UNKNOWN] * len(data), np.zeros(len(data))
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64, count=len(data) + 1 + data.offset)[data.offset:]
    raw = np.frombuffer(data.buffers()[2], dtype=np.uint8) if offsets[-1] > 0 else np.zeros(0, np.uint8)
    lengths = np.where(known, np.diff(offsets), 0)
    row, start, size = chunks(raw, offsets[:-1], lengths)
    total = np.zeros((len(data), len(net.languages)))
    # Chunks of like size go together, so that short ones don't run over padding.
    order = np.argsort(-size, kind="stable")
    for i in range(0, len(order), BATCH):
        at = order[i:i + BATCH]
        steps = np.arange(int(size[at].max()))[:, None]
        x = raw[np.minimum(start[at] + steps, len(raw) - 1)].astype(np.int64)
        x[steps >= size[at]] = PAD
        np.add.at(total, row[at], net.pooled(x))
    total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
    best = total.argmax(axis=1)
    return ([net.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)],
            np.where(known, np.clip(total[np.arange(len(best)), best], 0, 1), 0.0))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, net: Network | None, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(net))
    text = F.col(text_col).cast("string")

    def run(batches):
        net = cloudpickle.loads(held.value)
        for batch in batches:
            known = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            lang, score = judge(net, batch.column(2), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return bounded_arrow(docs).select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        text.alias("text"), has_letter(text).alias("known")) \
        .mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_rows(docs: DataFrame, net: Network | None, id_col="doc_id", text_col="text", over_chance: float = 1.2) -> DataFrame:
    """The input rows whose language is identified, with all their columns: a text
    goes if it has no letter or if its best language scores less than ``over_chance``
    times what a blind guess among the learned languages would."""
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(net))
    text = F.col(text_col).cast("string")

    def run(batches):
        net = cloudpickle.loads(held.value)
        least = over_chance / len(net.languages) if net is not None and len(net.languages) > 1 else 0.0
        for batch in batches:
            n = batch.num_columns
            known = batch.column(n - 1).to_numpy(zero_copy_only=False).astype(bool)
            _, score = judge(net, batch.column(n - 2), known)
            stays = pa.array(known & (score >= least))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(stays) for i in range(n - 2)],
                                             names=batch.schema.names[:n - 2])

    return bounded_arrow(docs).select("*", text.alias("__text"), has_letter(text).alias("__known")).mapInArrow(run, docs.schema)


def fit_identify(docs: DataFrame, id_col="doc_id", text_col="text", label_col="lang", **how) -> DataFrame:
    """Train on the documents that are not held out, then judge all of them."""
    return identify(docs, train(sample(docs, id_col=id_col, text_col=text_col, label_col=label_col, **how)),
                    id_col, text_col)
