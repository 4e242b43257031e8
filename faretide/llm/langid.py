r"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read a text's UTF-8 bytes, one from each side, in segments of ``segment`` bytes; their states label every
position with a probability for each language, and a document's probabilities are the means over all its positions,
from the first byte to the last. The network is trained in numpy by backpropagation through time.

It is fitted on a bounded sample, on the driver: ``per_lang`` documents of each language at most, ``sample_rows`` in all,
``windows`` pieces of ``segment`` characters of each, from places all over the text. Documents whose
crc32(doc_id) mod 4 is 2 are never among them. The fitted network is a few kilobytes, whatever the corpus.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if there is nothing to
learn from; a null doc_id counts as held out; repeated rows are labelled alike; extra columns are kept by
``identify``, which adds ``lang_pred``, ``score`` and ``shares`` (the share of positions that each language labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from faretide.llm import arrays, common

UNKNOWN = "und"
LETTER = r"\p{L}"


def sigmoid_of_negative(x: np.ndarray) -> np.ndarray:
    """In place; where exp overflows, the result is 0 as it should be."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Parameters by name; f reads forwards, b backwards. The gates' inputs are a row for each byte."""

    def __init__(self, langs: list[str], hidden: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        self.p: dict[str, np.ndarray] = {"out_bias": np.zeros(len(langs))}
        for side in "fb":
            self.p[f"{side}_in"] = rng.normal(0, 0.3, (256, 3 * hidden))
            self.p[f"{side}_gates"] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden))
            self.p[f"{side}_state"] = rng.normal(0, hidden**-0.5, (hidden, hidden))
            self.p[f"{side}_out"] = rng.normal(0, hidden**-0.5, (hidden, len(langs)))

    def single(self) -> Network:
        """For labelling: single precision, the gates' weights negated once for all."""
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        for side in "fb":
            self.p[f"{side}_in"][:, : 2 * self.hidden] *= -1
            self.p[f"{side}_gates"] *= -1
        return self

    # -- training ---------------------------------------------------------------------------------------------------
    def _read(self, side: str, data: np.ndarray):
        """States and what the way back needs; ``data`` is (steps, windows)."""
        h = self.hidden
        state, held = np.zeros((data.shape[1], h)), []
        for row in data:
            x = self.p[f"{side}_in"][row]
            gates = sigmoid_of_negative(-x[:, : 2 * h] - state @ self.p[f"{side}_gates"])
            update, reset = gates[:, :h], gates[:, h:]
            fresh = np.tanh(x[:, 2 * h :] + (reset * state) @ self.p[f"{side}_state"])
            after = state + update * (fresh - state)
            held.append((row, state, update, reset, fresh, after))
            state = after
        return held

    def _back(self, side: str, held: list, grads_out: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        """Through time: ``grads_out`` is the loss's gradient by each step's state."""
        h, carry = self.hidden, 0.0
        for t in range(len(held) - 1, -1, -1):
            row, state, update, reset, fresh, _ = held[t]
            by_after = grads_out[t] + carry
            by_fresh = by_after * update * (1 - fresh**2)
            by_update = by_after * (fresh - state) * update * (1 - update)
            by_mixed = by_fresh @ self.p[f"{side}_state"].T
            by_reset = by_mixed * state * reset * (1 - reset)
            by_gates = np.concatenate([by_update, by_reset], axis=1)
            grad[f"{side}_state"] += (reset * state).T @ by_fresh
            grad[f"{side}_gates"] += state.T @ by_gates
            np.add.at(grad[f"{side}_in"], row, np.concatenate([by_gates, by_fresh], axis=1))
            carry = by_after * (1 - update) + by_mixed * reset + by_gates @ self.p[f"{side}_gates"].T

    def gradients(self, data: np.ndarray, label: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions and its gradients; ``data`` and ``mask`` are (steps, windows), the bytes in front."""
        steps, n = data.shape
        sizes = mask.sum(0).astype(np.int64)
        turned = (sizes - 1 - np.arange(steps)[:, None]) % steps  # the same position from the other side
        other = np.take_along_axis(data, turned, 0)
        ahead, behind = self._read("f", data), self._read("b", other)
        f = np.stack([x[-1] for x in ahead])
        b = np.take_along_axis(np.stack([x[-1] for x in behind]), turned[:, :, None], 0)
        logits = f @ self.p["f_out"] + b @ self.p["b_out"] + self.p["out_bias"]
        logits -= logits.max(-1, keepdims=True)
        probability = np.exp(logits)
        probability /= probability.sum(-1, keepdims=True)
        weight = mask / mask.sum()
        loss = -(np.log(np.take_along_axis(probability, np.broadcast_to(label[None, :, None], (steps, n, 1)), 2)[:, :, 0] + 1e-12) * weight).sum()
        by_logits = probability
        by_logits[np.arange(steps)[:, None], np.arange(n)[None, :], label[None, :]] -= 1
        by_logits *= weight[:, :, None]
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out_bias"] = by_logits.sum((0, 1))
        grad["f_out"] = np.einsum("tnh,tnc->hc", f, by_logits, optimize=True)
        grad["b_out"] = np.einsum("tnh,tnc->hc", b, by_logits, optimize=True)
        self._back("f", ahead, by_logits @ self.p["f_out"].T, grad)
        by_b = np.zeros_like(f)
        np.put_along_axis(by_b, np.broadcast_to(turned[:, :, None], f.shape), by_logits @ self.p["b_out"].T, 0)
        self._back("b", behind, by_b, grad)
        return float(loss), grad

    def fit(self, windows: list[bytes], label: np.ndarray, segment: int, steps: int = 150, batch: int = 192, rate: float = 0.02, seed: int = 1) -> Network:
        """Adam over random batches."""
        rng = np.random.default_rng(seed)
        data = np.zeros((segment, len(windows)), np.uint8)
        mask = np.zeros((segment, len(windows)))
        for k, w in enumerate(windows):
            own = np.frombuffer(w[:segment], np.uint8)
            data[: len(own), k], mask[: len(own), k] = own, 1
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            pick = rng.choice(len(windows), min(batch, len(windows)), replace=False)
            _, grad = self.gradients(data[:, pick], label[pick], mask[:, pick])
            norm = np.sqrt(sum((g**2).sum() for g in grad.values()))
            pace = rate * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                g = g / max(1.0, norm)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                self.p[k] -= pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self

    # -- labelling --------------------------------------------------------------------------------------------------
    def _labels(self, side: str, data: np.ndarray, start: np.ndarray, size: np.ndarray, step: int) -> np.ndarray:
        """(steps, segments, languages): this side's part of the logits. Segments are sorted by size, longest first."""
        h, longest = self.hidden, int(size[0])
        state = np.zeros((len(start), h), np.float32)
        # Zeros: a segment shorter than the longest fills its first rows only, and whatever else lay there would spread.
        out = np.zeros((longest, len(start), len(self.langs)), np.float32)
        table, gates_by, state_by, out_by = (self.p[f"{side}_{k}"] for k in ("in", "gates", "state", "out"))
        active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
        for t in range(longest):
            m = int(active[t])
            x = table.take(data.take(start[:m] + step * t), axis=0)
            own = state[:m]
            gates = own @ gates_by
            gates += x[:, : 2 * h]
            sigmoid_of_negative(gates)
            fresh = (gates[:, h:] * own) @ state_by
            fresh += x[:, 2 * h :]
            np.tanh(fresh, out=fresh)
            fresh -= own
            fresh *= gates[:, :h]
            own += fresh
            np.matmul(own, out_by, out=out[t, :m])
        return out

    def positions(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """(steps, segments, languages): the probabilities at each byte of the segments, longest first."""
        ahead = self._labels("f", data, start, size, 1)
        behind = self._labels("b", data, start + size - 1, size, -1)
        full = int(np.searchsorted(-size, -size[0], side="right"))
        ahead[:, :full] += behind[::-1, :full]
        if full < len(size):
            turned = (size[full:] - 1 - np.arange(len(ahead))[:, None]) % len(ahead)
            ahead[:, full:] += np.take_along_axis(behind[:, full:], turned[:, :, None], 0)
        ahead += self.p["out_bias"]
        ahead -= ahead.max(-1, keepdims=True)
        np.exp(ahead, out=ahead)
        ahead /= ahead.sum(-1, keepdims=True)
        return ahead

    def documents(self, data: np.ndarray, bounds: np.ndarray, segment: int, at_once: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """(documents, languages): mean probabilities, and the share of the positions that each language labels."""
        sizes = np.diff(bounds)
        parts = -(-sizes // segment)
        row = np.repeat(np.arange(len(sizes)), parts)
        k = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = bounds[:-1][row] + k * segment
        size = np.minimum(segment, bounds[1:][row] - start)
        order = np.argsort(-size, kind="stable")
        row, start, size = row[order], start[order], size[order]
        sums, votes = np.zeros((2, len(sizes), len(self.langs)))
        for a in range(0, len(row), at_once):
            b = slice(a, a + at_once)
            probability = self.positions(data, start[b], size[b])
            inside = np.arange(len(probability))[:, None] < size[b]
            top = (probability >= probability.max(-1, keepdims=True)) & inside[:, :, None]
            probability *= inside[:, :, None]
            np.add.at(sums, row[b], probability.sum(0))
            np.add.at(votes, row[b], top.sum(0))
        total = np.maximum(sizes, 1)[:, None]
        return sums / total, votes / total


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def sample(docs: DataFrame, segment: int, per_lang: int, sample_rows: int, windows: int) -> list[tuple[str, str]]:
    """(language, window) of the training sample. Only ids and languages of the table are ranked; a language with most
    rows is cut to its first ``per_lang`` in every task before any shuffle."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    by = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id")
    ids = usable.select("doc_id", "lang").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= per_lang)
    ids = ids.orderBy("rank", "lang").limit(sample_rows).select("doc_id").distinct()
    span = F.greatest(F.char_length("text") - segment, F.lit(0)) + 1
    cut = [F.substring(F.col("text"), 1 + F.pmod(F.xxhash64("doc_id", F.lit(k)), span), F.lit(segment)) for k in range(windows)]
    picked = usable.join(F.broadcast(ids), "doc_id").where(F.col("text").rlike(LETTER))  # at most sample_rows ids
    pieces = picked.select("doc_id", "lang", F.explode(F.array(*cut)).alias("window"))
    rows = pieces.select("lang", "window", "doc_id").dropDuplicates().limit(sample_rows * windows).collect()
    return sorted((r.lang, r.window) for r in rows)


def train(docs: DataFrame, segment: int = 128, per_lang: int = 150, sample_rows: int = 6000, windows: int = 4, hidden: int = 8, steps: int = 200) -> Network:
    """The network fitted on ``docs`` (doc_id, text, lang)."""
    rows = sample(docs, segment, per_lang, sample_rows, windows)
    langs = sorted({lang for lang, _ in rows})
    network = Network(langs, hidden)
    if len(langs) > 1:
        number = {lang: k for k, lang in enumerate(langs)}
        network.fit([w.encode() for _, w in rows], np.array([number[lang] for lang, _ in rows]), segment, steps)
    return network.single()


def _identify(shared, text_at: int, letter_at: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]):
        network: Network = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rest = batch.select([c for k, c in enumerate(batch.schema.names) if k != letter_at])
                letters = np.array(batch.column(letter_at).to_pylist(), bool)
                predicted, scores, shares = [UNKNOWN] * len(letters), [0.0] * len(letters), [{}] * len(letters)
                if network.langs and letters.any():
                    data, bounds = arrays.text_bytes(batch.column(text_at))
                    means, votes = network.documents(data, bounds, segment)
                    for k in np.flatnonzero(letters).tolist():
                        top = int(means[k].argmax())
                        predicted[k], scores[k] = network.langs[top], float(min(1.0, means[k, top]))
                        shares[k] = {lang: float(v) for lang, v in zip(network.langs, votes[k]) if v}
                columns = [pa.array(predicted), pa.array(scores), pa.array([list(s.items()) for s in shares], pa.map_(pa.string(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*rest.columns, *columns], names=[*rest.schema.names, "lang_pred", "score", "shares"])

    return run


def identify(docs: DataFrame, network: Network, segment: int = 128) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``shares`` (language to share of positions), from ``text`` alone."""
    new = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("shares", T.MapType(T.StringType(), T.DoubleType()))]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(*x) for x in new)])
    judged = docs.withColumn("_letter", F.coalesce(F.col("text").rlike(LETTER), F.lit(False)))
    shared = common.importable(docs.sparkSession).sparkContext.broadcast(network)
    at = docs.columns.index("text")
    return judged.mapInArrow(_identify(shared, at, len(docs.columns), segment), schema)


def language_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, shares. Trains first."""
    network = train(docs.select("doc_id", "text", "lang"), **how)
    told = identify(docs.select("doc_id", "text"), network, how.get("segment", 128))
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "shares")
