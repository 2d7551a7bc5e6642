"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time. Its inputs are the bytes of a text in windows of
`WINDOW`, each read forwards and backwards from an empty state; an output layer over both states gives
probabilities of the languages at every position. A document's probabilities are the means over all its positions, so the whole
text counts. Padding after a text holds the update gate open and thus leaves the state as it is.

Training takes at most `PER_LANG` different texts of each language (those with the least hash of the text) and an excerpt of `EXCERPT`
characters of each, at a place that the hash chooses; nothing else is sampled. The number of texts of each language, estimated first, gives the hash up to
which the scan lets texts through, so a few hundred of each reach the task that ranks them, however many there are. Weights are a few kilobytes, sent with the task.

Defined cases: a null text or one without a letter is `und` with score 0; with nothing to learn from, all are `und`;
texts are read whole at any length; repeated rows are predicted one by one; a null id counts as the empty string
for the held-out rule; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import P, documents, materialise, scratch, ship

WINDOW = 48
HIDDEN = 8
PER_LANG = 160
EXCERPT = 1200
EPOCHS = 3
BATCH = 96
RATE = 0.02
ROWS = 1024
PAD = 256
UND = "und"


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Weights by name: E (2, 257, 3H) inputs to the gates, U (2, H, 3H) recurrent, W (2, H, C) and b (C) output. Gates: update, reset, candidate."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.w = {
            "E": rng.normal(0, 0.3, (2, PAD + 1, 3 * hidden)).astype(np.float32),
            "U": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 3 * hidden)).astype(np.float32),
            "W": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, classes)).astype(np.float32),
            "b": np.zeros(classes, np.float32),
        }
        self._hold_padding()

    def _hold_padding(self):
        self.w["E"][:, PAD] = 0
        self.w["E"][:, PAD, : self.h] = 30

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the positions of x (windows, length) with labels y (windows), and its gradients."""
        n, length = x.shape
        h, w = self.h, self.w
        both = np.stack([x, x[:, ::-1]])  # what each direction reads, step by step
        at = np.arange(2)[:, None]
        state, kept = np.zeros((2, n, h), np.float32), []
        for t in range(length):
            a, u = w["E"][at, both[:, :, t]], state @ w["U"]
            z, r = _sigmoid(a[..., :h] + u[..., :h]), _sigmoid(a[..., h : 2 * h] + u[..., h : 2 * h])
            c = np.tanh(a[..., 2 * h :] + r * u[..., 2 * h :])
            kept.append((state, z, r, c, u[..., 2 * h :]))
            state = c + z * (state - c)
        states = np.stack([k[0] for k in kept[1:]] + [state])  # (length, 2, n, h)
        forward, backward = states[:, 0], states[::-1, 1]
        logits = forward @ w["W"][0] + backward @ w["W"][1] + w["b"]
        logits -= logits.max(-1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(-1, keepdims=True)
        real = (x != PAD).T
        total = max(int(real.sum()), 1)
        picked = np.take_along_axis(p, np.broadcast_to(y[None, :, None], (length, n, 1)), 2)[..., 0]
        loss = float(-(np.log(picked + 1e-12) * real).sum() / total)
        d = p
        np.put_along_axis(d, np.broadcast_to(y[None, :, None], (length, n, 1)), (picked - 1)[..., None], 2)
        d *= real[..., None] / total
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["b"] = d.sum((0, 1))
        g["W"][0], g["W"][1] = np.tensordot(forward, d, ([0, 1], [0, 1])), np.tensordot(backward, d, ([0, 1], [0, 1]))
        out = np.stack([d @ w["W"][0].T, (d @ w["W"][1].T)[::-1]], 1)
        back = np.zeros((2, n, h), np.float32)
        for t in range(length - 1, -1, -1):
            before, z, r, c, uc = kept[t]
            back = back + out[t]
            dz, dc = back * (before - c) * z * (1 - z), back * (1 - z) * (1 - c * c)
            dr = dc * uc * r * (1 - r)
            gates = np.concatenate([dz, dr, dc], -1)
            through = np.concatenate([dz, dr, dc * r], -1)
            g["U"] += np.swapaxes(before, 1, 2) @ through
            for i in range(2):
                np.add.at(g["E"][i], both[i, :, t], gates[i])
            back = back * z + through @ np.swapaxes(w["U"], 1, 2)
        g["E"][:, PAD] = 0
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 11) -> list[float]:
        rng = np.random.default_rng(seed)
        m, v, step, losses = {k: np.zeros_like(a) for k, a in self.w.items()}, {k: np.zeros_like(a) for k, a in self.w.items()}, 0, []
        total = max(1, epochs * (-(-len(x) // batch)))
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                some = order[i : i + batch]
                loss, g = self.gradients(x[some], y[some])
                step += 1
                now = rate * (1 - step / (total + 1))
                for k in self.w:  # Adam
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.01 * (g[k] * g[k] - v[k])
                    self.w[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
                self._hold_padding()
                losses.append(loss)
        return losses

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (length, windows, classes) at every position of x (windows, length)."""
        n, length = x.shape
        h, w = self.h, self.w
        table = w["E"].reshape(2 * (PAD + 1), 3 * h).copy()
        table[:, : 2 * h] *= -1  # gates as 1 / (1 + exp(x))
        u = w["U"].copy()
        u[..., : 2 * h] *= -1
        reads = np.empty((length, 2, n), np.int32)
        reads[:, 0], reads[:, 1] = x.T, x.T[::-1] + (PAD + 1)
        states = np.empty((length, 2, n, h), np.float32)
        state, a, b = np.zeros((2, n, h), np.float32), np.empty((2, n, 3 * h), np.float32), np.empty((2, n, 3 * h), np.float32)
        gates = np.empty((2, n, 2 * h), np.float32)
        for t in range(length):
            np.take(table, reads[t], axis=0, out=a, mode="clip")
            np.matmul(state, u, out=b)
            np.add(a[..., : 2 * h], b[..., : 2 * h], out=gates)
            np.minimum(gates, 60, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            c = b[..., 2 * h :]
            c *= gates[..., h:]
            c += a[..., 2 * h :]
            new = states[t]
            np.tanh(c, out=new)
            state -= new
            state *= gates[..., :h]
            new += state
            np.copyto(state, new)
        p = states[:, 0] @ w["W"][0]
        p += states[::-1, 1] @ w["W"][1]
        p += w["b"]
        p -= p.max(-1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(-1, keepdims=True)
        return p


def windows(texts: list[bytes], length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows, length) of byte values padded with PAD, and the number of windows of each text (1 at least)."""
    counts = np.array([max(1, -(-len(t) // length)) for t in texts], np.int64)
    flat = np.full(int(counts.sum()) * length, PAD, np.int16)
    at = 0
    for t, c in zip(texts, counts):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += int(c) * length
    return flat.reshape(-1, length), counts


class Model:
    def __init__(self, langs: list[str], network: Network | None):
        self.langs, self.network = langs, network

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): means over all positions of each text. ROWS windows at a time."""
        x, counts = windows(texts)
        sums = np.empty((len(x), len(self.langs)), np.float64)
        for i in range(0, len(x), ROWS):
            part = x[i : i + ROWS]
            p = self.network.label(part)
            if (part[:, -1] == PAD).any():
                p *= (part != PAD).T[..., None]
            sums[i : i + ROWS] = p.sum(0)
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        total = np.add.reduceat(sums, firsts, axis=0)
        return total / np.maximum([len(t) for t in texts], 1)[:, None]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        asked = [i for i, t in enumerate(texts) if self.network and t and any(map(str.isalpha, t))]
        out: list[tuple[str, float]] = [(UND, 0.0)] * len(texts)
        at = 0
        while at < len(asked):  # by bytes, so that long texts don't pile up
            some, held = [], 0
            while at < len(asked) and (not some or held < 4_000_000):
                some.append(asked[at])
                held += len(texts[asked[at]])
                at += 1
            p = self.probabilities([texts[i].encode("utf-8", "surrogatepass") for i in some])
            for i, row in zip(some, p):
                best = int(row.argmax())
                out[i] = (self.langs[best], float(min(1.0, max(0.0, row[best]))))
        return out


def held_out(key: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG, excerpt: int = EXCERPT) -> Model:
    """Learns from rows that are not held out. per_lang and excerpt bound what reaches the driver."""
    t = F.col(text)
    h = F.xxhash64(t)
    start = F.pmod(h, F.greatest(F.length(t) - excerpt + 1, F.lit(1)).cast("long")).cast("int") + 1
    rows = docs.filter(t.isNotNull() & F.col(lang).isNotNull() & ~held_out(key)).select(F.col(lang).alias("lang"), F.pmod(h, F.lit(1 << 62)).alias("h"), F.substring(t, start, F.lit(excerpt)).alias("t"))
    with scratch(docs.sparkSession):
        share = F.least(F.lit(1.0), (4 * per_lang + 64) / F.greatest(F.col("n"), F.lit(1)))
        limits = materialise(rows.groupBy(F.col("lang").alias("l")).agg(F.approx_count_distinct("h").alias("n")).select("l", (share * float(1 << 62)).cast("long").alias("below")), "lang-limits")
        few = rows.join(limits, F.col("lang") == F.col("l")).filter("h <= below").groupBy("lang", "h").agg(F.min("t").alias("t"))
        ranked = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))).filter(F.col("n") <= per_lang)
        got = sorted((r.lang, r.h, r.t) for r in ranked.collect())
    langs = sorted({r[0] for r in got})
    parts = [(windows([r[2].encode("utf-8", "surrogatepass")])[0], langs.index(r[0])) for r in got if any(map(str.isalpha, r[2]))]
    if not parts:
        return Model(langs, None)
    x, y = np.concatenate([p for p, _ in parts]), np.concatenate([np.full(len(p), i) for p, i in parts])
    network = Network(len(langs))
    network.train(x.astype(np.int32), y)
    return Model(langs, network)


_OUT = [T.StructField(f"{P}lang_pred", T.StringType()), T.StructField(f"{P}score", T.DoubleType())]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with __cv_lang_pred and __cv_score."""
    ship(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, *_OUT])
    column = docs.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                found = model.predict(part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(part.columns, to)), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], schema=to)

    return docs.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), F.col(f"{P}lang_pred").alias("lang_pred"), F.col(f"{P}score").alias("score"))
