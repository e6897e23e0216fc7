"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads windows of UTF-8 bytes in both directions, labels every position, and the mean of
the position probabilities is the document's. It is trained here, in numpy, by backpropagation
through time on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, map_arrow, others, table

UNKNOWN = "und"
#: Bound of the training sample: documents per language, each with one passage of characters.
DOCS_PER_LANGUAGE = 512
PASSAGE = 400
HIDDEN = 12
# Bytes a window has, in training and in use; a window starts without state.
TRAIN_WINDOW, WINDOW = 64, 128
BATCH, STEPS, RATE, SEED = 128, 500, 0.02, 5
# Windows that are labelled together.
ROWS = 1024


@dataclass
class Network:
    languages: list[str]
    #: Per direction: byte to gates (reset, update, new), state to gates, state to languages.
    inputs: np.ndarray  # 2 x 256 x 3H
    state: np.ndarray  # 2 x H x 3H
    output: np.ndarray  # 2 x H x K
    bias: np.ndarray  # K

    @property
    def hidden(self) -> int:
        return self.state.shape[1]


def _squash(x: np.ndarray) -> np.ndarray:
    """Softsign, in place of tanh: a third of its cost in numpy."""
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * _squash(x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of ``windows`` (rows x bytes) and its gradients.

    Backpropagation through time, for both directions at once.
    """
    rows, steps = windows.shape
    h_size = net.hidden
    read = np.stack([windows.T, windows.T[::-1]])  # direction x step x row
    h = np.zeros((2, rows, h_size), net.state.dtype)
    kept = []
    states = np.empty((2, steps, rows, h_size), net.state.dtype)
    for t in range(steps):
        a = np.stack([net.inputs[0][read[0, t]], net.inputs[1][read[1, t]]])
        g = h @ net.state
        r = _gate(a[..., :h_size] + g[..., :h_size])
        z = _gate(a[..., h_size : 2 * h_size] + g[..., h_size : 2 * h_size])
        gn = g[..., 2 * h_size :]
        n = _squash(a[..., 2 * h_size :] + r * gn)
        kept.append((h, r, z, gn, n))
        h = z * h + (1 - z) * n
        states[:, t] = h
    p = _softmax(states[0] @ net.output[0] + states[1, ::-1] @ net.output[1] + net.bias)
    loss = -np.log(p[:, np.arange(rows), labels] + 1e-9).mean()
    d_out = p
    d_out[:, np.arange(rows), labels] -= 1
    d_out /= rows * steps
    both = np.stack([d_out, d_out[::-1]])
    g_output = np.stack([np.einsum("tbh,tbk->hk", states[i], both[i]) for i in (0, 1)])
    d_states = np.stack([both[i] @ net.output[i].T for i in (0, 1)])
    g_inputs, g_state = np.zeros_like(net.inputs), np.zeros_like(net.state)
    d_h = np.zeros_like(h)
    for t in range(steps - 1, -1, -1):
        before, r, z, gn, n = kept[t]
        d_h = d_h + d_states[:, t]
        d_n = d_h * (1 - z) * (1 - np.abs(n)) ** 2
        d_z = d_h * (before - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_r = d_n * gn * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_a = np.concatenate([d_r, d_z, d_n], axis=-1)
        d_g = np.concatenate([d_r, d_z, d_n * r], axis=-1)
        for i in (0, 1):
            np.add.at(g_inputs[i], read[i, t], d_a[i])
        g_state += before.transpose(0, 2, 1) @ d_g
        d_h = d_h * z + d_g @ net.state.transpose(0, 2, 1)
    return float(loss), [g_inputs, g_state, g_output, d_out.sum(axis=(0, 1))]


def fit(
    passages: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED
) -> Network:
    """Train on passages, equally many windows of each language in a batch, with Adam."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    net = Network(
        languages,
        rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32),
        rng.normal(0, hidden**-0.5, (2, hidden, 3 * hidden)).astype(np.float32),
        rng.normal(0, 0.3, (2, hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    by_language = [
        [np.frombuffer(p, np.uint8) for p, x in zip(passages, labels) if x == language and p]
        for language in languages
    ]
    weights = [net.inputs, net.state, net.output, net.bias]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        answers = rng.permutation(np.arange(BATCH) % len(languages))
        windows = np.full((BATCH, TRAIN_WINDOW), 32, np.uint8)
        for i, k in enumerate(answers):
            passage = by_language[k][rng.integers(len(by_language[k]))]
            start = rng.integers(max(1, len(passage) - TRAIN_WINDOW + 1))
            piece = passage[start : start + TRAIN_WINDOW]
            windows[i, : len(piece)] = piece
        _, slopes = gradients(net, windows, answers)
        rate = RATE * (1 - (step - 1) / steps)
        norm = np.sqrt(sum(float((s * s).sum()) for s in slopes))
        for w, s, m, v in zip(weights, slopes, first, second):
            s = s * min(1.0, 1.0 / (norm + 1e-12))
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


class Labeller:
    """Applies a network to many texts at once."""

    def __init__(self, net: Network):
        h = net.hidden
        self.net = net
        # Gate by gate (reset, update, new), so that each step works on unbroken memory.
        self.inputs = np.ascontiguousarray(net.inputs.reshape(2, 256, 3, h).transpose(0, 2, 1, 3))
        self.state = np.ascontiguousarray(net.state.reshape(2, h, 3, h).transpose(0, 2, 1, 3))
        self.state[:, 2] *= 0.5  # a gate is (1 + softsign) / 2; this is the reset gate's half

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of the languages over all positions; one row per text, none empty."""
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        per_text = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), per_text)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = begins[owner] + place * WINDOW
        lengths = np.minimum(WINDOW, sizes[owner] - place * WINDOW)
        sums = np.zeros((len(texts), len(self.net.languages)))
        order = np.argsort(-lengths, kind="stable")  # windows that are not full go together
        for i in range(0, len(order), ROWS):
            pick = order[i : i + ROWS]
            np.add.at(sums, owner[pick], self._label(data, starts[pick], lengths[pick]))
        return sums / sizes[:, None]

    def _label(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Summed position probabilities of each window."""
        rows, steps, h_size = len(starts), int(lengths.max()), self.net.hidden
        ragged = int(lengths.min()) < steps
        windows = data[starts[None, :] + np.arange(steps)[:, None]].astype(np.intp)  # step x row
        logits = np.empty((2, steps, rows, len(self.net.languages)), np.float32)
        h = np.zeros((2, rows, h_size), np.float32)
        a = np.empty((2, 3, rows, h_size), np.float32)  # direction x gate x row x unit
        g, below = np.empty_like(a), np.empty_like(a)
        for t in range(steps):
            back = steps - 1 - t
            for i, step in ((0, t), (1, back)):
                for k in range(3):
                    np.take(self.inputs[i, k], windows[step], axis=0, out=a[i, k], mode="clip")
            np.matmul(h[:, None], self.state, out=g)
            gates, under = a[:, :2], below[:, :2]
            gates += g[:, :2]
            np.abs(gates, out=under)
            under += 1
            gates /= under
            gates += 1  # twice the gate
            n, under = a[:, 2], below[:, 2]
            g[:, 2] *= gates[:, 0]
            n += g[:, 2]
            np.abs(n, out=under)
            under += 1
            n /= under
            h -= n
            h *= 0.5
            h *= gates[:, 1]
            h += n
            if ragged:  # backwards, a text begins at its last byte
                h[1][lengths <= back] = 0
            np.matmul(h[0], self.net.output[0], out=logits[0, t])
            np.matmul(h[1], self.net.output[1], out=logits[1, back])
        x = logits[0]
        x += logits[1]
        x += self.net.bias
        np.clip(x, -60, 60, out=x)
        np.exp(x, out=x)
        x /= x @ np.ones((x.shape[-1], x.shape[-1]), np.float32)
        if ragged:
            x *= (np.arange(steps)[:, None] < lengths[None, :])[..., None]
        return x.sum(axis=0)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE, **options,
) -> Network | None:
    """A network learned from the rows of ``docs`` with a text and a language; None without any.

    The sample has at most ``docs_per_language`` texts of each language: texts are dealt into so
    many slots by a hash of the text, and each slot gives the one with the least hash. Only those
    come to the driver, a passage of ``PASSAGE`` characters each.
    """
    start = F.pmod(F.shiftrightunsigned(F.xxhash64(q(text)), 20), F.greatest(F.length(q(text)) - PASSAGE, F.lit(1)))
    rows = docs.where(q(text).rlike(r"\p{L}") & q(lang).isNotNull() & (q(lang) != UNKNOWN)).select(
        q(lang).alias("_lang"), F.xxhash64(q(text)).alias("_hash"),
        F.substring(q(text), (start + 1).cast("int"), F.lit(PASSAGE)).alias("_passage"),
    )
    slots = rows.groupBy("_lang", F.pmod("_hash", F.lit(docs_per_language)).alias("_slot"))
    least = slots.agg(F.min("_hash").alias("_least")).select(F.col("_lang").alias("_l"), "_least")
    # As many rows as the sample: the broadcast has the sample's bound.
    picked = rows.join(
        F.broadcast(least), (F.col("_lang") == F.col("_l")) & (F.col("_hash") == F.col("_least")), "left_semi"
    )
    sample = sorted(map(tuple, picked.distinct().collect()))
    if not sample:
        return None
    return fit([p.encode("utf-8", "ignore") for _, _, p in sample], [x for x, _, _ in sample], **options)


@any_names
def identify(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``lang_pred`` and ``score``, the probability of that language.

    Whole texts are read. ``und`` and 0 for NULL, empty and letterless texts, and for all if
    there is no network. Equal texts get equal results, up to rounding; an empty table gives an empty one.
    Columns named like the new ones are replaced. Only the text is an input.
    """
    made = ["lang_pred", "score"]
    schema = StructType().add("lang_pred", "string").add("score", "double")
    return map_arrow(docs, others(docs, made), [q(text).alias("_text")], _identifier(net), schema)


def _identifier(net: Network | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(net) if net else None
        for batch in batches:
            texts = batch["_text"].to_pylist()
            named = [i for i, t in enumerate(texts) if labeller and has_letter(t)]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if named:
                p = labeller.probabilities([texts[i].encode("utf-8", "replace") for i in named])
                for i, best, score in zip(named, p.argmax(axis=1), p.max(axis=1)):
                    names[i], scores[i] = net.languages[best], min(1.0, float(score))
            yield pa.record_batch(
                [batch["_row"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["_row", "lang_pred", "score"],
            )

    return run


def held_out(doc_id: Column) -> Column:
    """Every fourth document by checksum is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), net).drop("text")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
