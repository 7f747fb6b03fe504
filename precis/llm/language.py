"""Language identification by a bidirectional gated recurrent network over bytes, trained here."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 96
UNKNOWN = "und"
_LANES = 2048


@dataclass
class Direction:
    """One reading direction: what each byte adds to the three gates, and what the last state adds."""

    table: np.ndarray  # (256, 3H): update, reset, candidate
    state: np.ndarray  # (H, 3H)

    def run(self, steps: np.ndarray) -> Iterator[np.ndarray]:
        """The state (units by lanes) after each row of bytes (window positions by lanes).

        A gate 1 / (1 + exp(-v)) is (tanh(v / 2) + 1) / 2; the halves are put into the weights, so that a step is one
        product, two tanh and a few sums over whole rows. The state yielded is changed by the next step.
        """
        hidden, lanes = self.state.shape[0], steps.shape[1]
        half = np.full(3 * hidden, 0.5, np.float32)
        state = np.ascontiguousarray((self.state * half).T)
        half[2 * hidden :] = 1
        table = np.ascontiguousarray((self.table * half).T)
        h = np.zeros((hidden, lanes), np.float32)
        x, u = np.empty((3 * hidden, lanes), np.float32), np.empty((3 * hidden, lanes), np.float32)
        gates, c, uc = x[: 2 * hidden], x[2 * hidden :], u[2 * hidden :]
        for row in steps:
            np.take(table, row, axis=1, out=x, mode="clip")
            np.matmul(state, h, out=u)
            gates += u[: 2 * hidden]
            np.tanh(gates, out=gates)
            c += uc
            uc *= gates[hidden:]
            c += uc
            np.tanh(c, out=c)
            c -= h
            c *= 0.5
            h += c
            c *= gates[:hidden]
            h += c
            yield h


@dataclass
class Model:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (2H, languages)
    bias: np.ndarray

    def window_sums(self, windows: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Per window (columns) the sum of the probabilities of its labelled positions, one row per language."""
        hidden, kinds = self.forward.state.shape[0], len(self.languages)
        left, right = np.ascontiguousarray(self.out[:hidden].T), np.ascontiguousarray(self.out[hidden:].T)
        ahead = np.empty((len(windows), kinds, windows.shape[1]), np.float32)
        for t, h in enumerate(self.forward.run(windows)):
            np.matmul(left, h, out=ahead[t])
        total = np.zeros((kinds, windows.shape[1]), np.float32)
        for t, h in zip(range(len(windows) - 1, -1, -1), self.backward.run(windows[::-1]), strict=True):
            logits = ahead[t]
            logits += right @ h
            logits += self.bias[:, None]
            logits -= logits.max(axis=0)
            np.exp(logits, out=logits)
            logits *= inside[t] / logits.sum(axis=0)
            total += logits
        return total

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """Per text the mean of its positions' probabilities; every byte of every text is read, white space not labelled."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
        counts = -(-(offsets[1:] - offsets[:-1]) // WINDOW)
        text_of = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
        start, end = offsets[:-1][text_of] + nth * WINDOW, offsets[1:][text_of]
        sums = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(text_of), _LANES):
            at = start[a : a + _LANES][None, :] + np.arange(WINDOW)[:, None]
            inside = at < end[a : a + _LANES][None, :]
            windows = np.where(inside, data[np.minimum(at, len(data) - 1)], np.uint8(32))
            found = self.window_sums(windows, (inside & (windows > 32)).astype(np.float32))
            np.add.at(sums, text_of[a : a + _LANES], found.T)
        return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)


def _gates(table: np.ndarray, state: np.ndarray, row: np.ndarray, h: np.ndarray):
    hidden = len(state)
    u = h @ state
    x = table[row]
    zr = 1 / (1 + np.exp(-(x[:, : 2 * hidden] + u[:, : 2 * hidden])))
    z, r = zr[:, :hidden], zr[:, hidden:]
    c = np.tanh(x[:, 2 * hidden :] + r * u[:, 2 * hidden :])
    return u, z, r, c


def _back(direction: Direction, steps: np.ndarray, grads: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Backpropagation through time: gradients of the table and the state weights from those of the states."""
    hidden = len(direction.state)
    d_table, d_state = np.zeros_like(direction.table), np.zeros_like(direction.state)
    carry = np.zeros_like(grads[0])
    for t in range(len(steps) - 1, -1, -1):
        h, u, z, r, c = kept[t]
        d = grads[t] + carry
        d_c = d * z * (1 - c * c)
        d_z = d * (c - h) * z * (1 - z)
        d_r = d_c * u[:, 2 * hidden :] * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
        np.add.at(d_table, steps[t], np.concatenate([d_z, d_r, d_c], axis=1))
        d_state += h.T @ d_u
        carry = d * (1 - z) + d_u @ direction.state.T
    return d_table, d_state


def train(windows: np.ndarray, inside: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = 10, rounds: int = 160, batch: int = 192, seed: int = 7) -> Model:
    """Fits the network to windows of bytes (windows by positions), each position labelled with its text's language.

    Plain numpy: states are kept on the way forward, gradients go backward through time, Adam takes the steps. Batches
    hold as many windows of each language. The same input gives the same model.
    """
    rng = np.random.default_rng(seed)
    kinds = len(languages)
    weights = [
        *(rng.normal(0, s, shape).astype(np.float32) for _ in range(2) for s, shape in ((0.3, (256, 3 * hidden)), (0.3, (hidden, 3 * hidden)))),
        rng.normal(0, 0.3, (2 * hidden, kinds)).astype(np.float32),
        np.zeros(kinds, np.float32),
    ]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    members = [np.flatnonzero(labels == k) for k in range(kinds)]
    for step in range(1, rounds + 1):
        pick = np.concatenate([rng.choice(m, max(1, batch // kinds)) for m in members])
        steps, mask, target = windows[pick].T, inside[pick].T.astype(np.float32), labels[pick]
        ways = [Direction(weights[0], weights[1]), Direction(weights[2], weights[3])]
        states, kept = [], []
        for way, rows in zip(ways, (steps, steps[::-1]), strict=True):
            h, own, seen = np.zeros((len(pick), hidden), np.float32), [], []
            for row in rows:
                u, z, r, c = _gates(way.table, way.state, row, h)
                seen.append((h, u, z, r, c))
                h = (1 - z) * h + z * c
                own.append(h)
            states.append(np.stack(own))
            kept.append(seen)
        both = np.concatenate([states[0], states[1][::-1]], axis=2)
        logits = both @ weights[4] + weights[5]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(len(pick)), target] -= 1
        d = p * (mask / mask.sum())[:, :, None]
        d_out, d_bias = np.einsum("tbh,tbk->hk", both, d), d.sum(axis=(0, 1))
        d_both = d @ weights[4].T
        grads = [
            *_back(ways[0], steps, d_both[:, :, :hidden], kept[0]),
            *_back(ways[1], steps[::-1], d_both[::-1, :, hidden:], kept[1]),
            d_out,
            d_bias,
        ]
        rate = 0.03 * (1 - step / (rounds + 1)) + 0.002
        for w, g, (m, v) in zip(weights, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(languages, Direction(weights[0], weights[1]), Direction(weights[2], weights[3]), weights[4], weights[5])


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the key as text leaves 1 modulo 3; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 300, pieces: int = 6, **settings) -> Model | None:
    """A model from labelled rows that are not held out; None if there are none.

    It learns from a bounded sample: of each language the `per_language` rows with the least hash of key and text,
    and of each text `pieces` stretches of `WINDOW` characters, evenly spread over the whole text. Every task keeps
    its own first rows of a language before the shuffle, so a frequent language costs no more than a rare one.
    """
    own = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("lang"))
    own = own.filter(F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}") & ~held_out(F.col("k")))
    room = F.greatest(F.length("t") - WINDOW, F.lit(0))
    starts = [F.substring("t", (room * i / max(1, pieces - 1)).cast("int") + 1, F.lit(WINDOW)) for i in range(pieces)]
    order = Window.partitionBy("lang").orderBy("h", "k")
    cut = own.select("lang", "k", F.xxhash64("k", "t").alias("h"), F.array_distinct(F.array(*starts)).alias("pieces"))
    rows = cut.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language).orderBy("lang", "n").select("lang", "pieces").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    bodies = [(p.encode()[:WINDOW], languages.index(r["lang"])) for r in rows for p in r["pieces"]]
    windows = np.full((len(bodies), WINDOW), 32, np.uint8)
    for i, (body, _) in enumerate(bodies):
        windows[i, : len(body)] = np.frombuffer(body, np.uint8)
    return train(windows, windows > 32, np.array([k for _, k in bodies]), languages, **settings)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(_key, held_out, lang_pred, score)` for every row; `und` with score 0 for null texts and texts without a letter."""
    own = docs.select(
        F.col(f"`{key}`").alias("_key"),
        held_out(F.col(f"`{key}`")).alias("held_out"),
        F.col(f"`{text}`").alias("_text"),
        F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("_some"),
    )
    if model is None:
        return own.select("_key", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, object)
        for batch in batches:
            found = model.probabilities(batch.column("_text"))
            best = found.argmax(axis=1)
            some = np.array(batch.column("_some"), bool)
            score = np.clip(np.where(some, found[np.arange(len(best)), best], 0.0), 0.0, 1.0)
            pred = np.where(some, names[best], UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score)],
                names=["_key", "held_out", "lang_pred", "score"],
            )

    kind = own.schema["_key"].dataType.simpleString()
    return own.mapInArrow(label, f"_key {kind}, held_out boolean, lang_pred string, score double")
