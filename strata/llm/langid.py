"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled
texts and then labels every byte of every text; a document's probabilities are the mean over its
bytes. Texts are cut into chunks of ``CHUNK`` bytes, each read forwards and backwards from a zero
state; thousands of chunks are stepped together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import buffers, pick, pieces, table

CHUNK = 128
HIDDEN = 8
#: Bound of the training sample: texts per language (in expectation) and characters taken of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 320, 512
TRAIN_CHUNK, BATCH, EPOCHS, RATE = 64, 256, 4, 0.02


def _steps(x, Wx, U, steps):
    """Yields (step, states) of a GRU; x: bytes (steps, n). Gates z, r, then the candidate.

    sigmoid(v) is 1 / (1 + exp(-v)) and tanh(v) is 2 / (1 + exp(-2v)) - 1: the factors go into the weights.
    The array of states is the same one at each step.
    """
    h_n, n = U.shape[0], x.shape[1]
    W_g, U_g = np.ascontiguousarray(-Wx[:, :2 * h_n]), np.ascontiguousarray(-U[:, :2 * h_n])
    W_c, U_c = np.ascontiguousarray(-2 * Wx[:, 2 * h_n:]), np.ascontiguousarray(-2 * U[:, 2 * h_n:])
    gates, sums = np.empty((n, 2 * h_n), np.float32), np.empty((n, 2 * h_n), np.float32)
    c, d, h = np.empty((n, h_n), np.float32), np.empty((n, h_n), np.float32), np.zeros((n, h_n), np.float32)
    with np.errstate(over="ignore"):
        for t in steps:
            np.take(W_g, x[t], axis=0, out=gates, mode="clip")
            gates += np.matmul(h, U_g, out=sums)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.matmul(np.multiply(gates[:, h_n:], h, out=d), U_c, out=c)
            c += np.take(W_c, x[t], axis=0, out=d, mode="clip")
            np.exp(c, out=c)
            c += 1
            np.divide(2, c, out=c)
            c -= 1
            c -= h
            c *= gates[:, :h_n]
            h += c
            yield t, h


def _gru(x, Wx, U, steps):
    out = np.empty((*x.shape, U.shape[0]), np.float32)
    for t, h in _steps(x, Wx, U, steps):
        out[t] = h
    return out


def _gru_grad(x, Wx, U, out, d_out, steps):
    """Gradients of Wx and U, by going back through the steps."""
    h_n, n = U.shape[0], x.shape[1]
    dW, dU, dh = np.zeros_like(Wx), np.zeros_like(U), np.zeros((n, h_n), np.float32)
    order = list(steps)
    for k in range(len(order) - 1, -1, -1):
        t = order[k]
        h = out[order[k - 1]] if k else np.zeros((n, h_n), np.float32)
        g = Wx[x[t]]
        zr = np.tanh(0.5 * (g[:, :2 * h_n] + h @ U[:, :2 * h_n])) * 0.5 + 0.5
        z, r = zr[:, :h_n], zr[:, h_n:]
        c = np.tanh(g[:, 2 * h_n:] + (r * h) @ U[:, 2 * h_n:])
        dh = dh + d_out[t]
        dc = dh * z * (1 - c * c)
        d_rh = dc @ U[:, 2 * h_n:].T
        d_zr = np.concatenate([dh * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], 1)
        dg = np.concatenate([d_zr, dc], 1)
        np.add.at(dW, x[t], dg)
        dU[:, :2 * h_n] += h.T @ d_zr
        dU[:, 2 * h_n:] += (r * h).T @ dc
        dh = dh * (1 - z) + d_rh * r + d_zr @ U[:, :2 * h_n].T
    return dW, dU


def _softmax(y):
    np.exp(np.clip(y, -60, 60, out=y), out=y)
    y /= y @ np.ones((y.shape[-1], 1), np.float32)
    return y


def _probabilities(x, m):
    """Class probabilities at every position (steps, n, classes), and the states of both directions."""
    f = _gru(x, m["Wf"], m["Uf"], range(len(x)))
    b = _gru(x, m["Wb"], m["Ub"], range(len(x) - 1, -1, -1))
    return _softmax(f @ m["Of"] + b @ m["Ob"] + m["o"]), f, b


def _pooled(x, length, m, y):
    """Sums over the positions before ``length`` of the class probabilities; y: room for them."""
    for t, h in _steps(x, m["Wf"], m["Uf"], range(len(x))):
        np.matmul(h, m["Of"], out=y[t])
    total, part = np.zeros(y.shape[1:], np.float32), np.empty(y.shape[1:], np.float32)
    for t, h in _steps(x, m["Wb"], m["Ub"], range(len(x) - 1, -1, -1)):
        y[t] += np.matmul(h, m["Ob"], out=part)
        y[t] += m["o"]
        p = _softmax(y[t])
        if t >= length[-1]:  # a chunk's backward state starts at its own end, whatever its neighbours' lengths
            p[length <= t] = 0
            h[length <= t] = 0
        total += p
    return total


def fit(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Train on (text, label) pairs; the classes are the labels seen, in order."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    chunks, ys = [], []
    for t, l in zip(texts, labels):
        for i in range(0, max(1, len(t) - TRAIN_CHUNK + 1), TRAIN_CHUNK):
            c = t[i:i + TRAIN_CHUNK]
            if c:
                chunks.append(c.ljust(TRAIN_CHUNK, b" "))
                ys.append(langs.index(l))
    x = np.frombuffer(b"".join(chunks), np.uint8).reshape(-1, TRAIN_CHUNK).T
    y, k = np.array(ys), len(langs)
    normal = lambda *s, by: rng.normal(0, by, s).astype(np.float32)
    m = {"Wf": normal(256, 3 * hidden, by=0.3), "Uf": normal(hidden, 3 * hidden, by=0.3), "Wb": normal(256, 3 * hidden, by=0.3),
         "Ub": normal(hidden, 3 * hidden, by=0.3), "Of": normal(hidden, k, by=0.3), "Ob": normal(hidden, k, by=0.3), "o": np.zeros(k, np.float32)}
    mean, var, step = {n: np.zeros_like(v) for n, v in m.items()}, {n: np.zeros_like(v) for n, v in m.items()}, 0
    total = epochs * -(-x.shape[1] // BATCH)
    for _ in range(epochs):
        order = rng.permutation(x.shape[1])
        for i in range(0, len(order), BATCH):
            xs, ts = x[:, order[i:i + BATCH]], y[order[i:i + BATCH]]
            p, f, b = _probabilities(xs, m)
            p[:, np.arange(len(ts)), ts] -= 1
            p /= p.shape[0] * p.shape[1]
            g = {"o": p.sum((0, 1)), "Of": np.einsum("tnh,tnk->hk", f, p), "Ob": np.einsum("tnh,tnk->hk", b, p)}
            g["Wf"], g["Uf"] = _gru_grad(xs, m["Wf"], m["Uf"], f, p @ m["Of"].T, range(TRAIN_CHUNK))
            g["Wb"], g["Ub"] = _gru_grad(xs, m["Wb"], m["Ub"], b, p @ m["Ob"].T, range(TRAIN_CHUNK - 1, -1, -1))
            step += 1
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            rate = RATE * (1 - 0.9 * step / total) * min(1, 1 / max(norm, 1e-9))
            for n, v in g.items():
                mean[n] = 0.9 * mean[n] + 0.1 * v
                var[n] = 0.99 * var[n] + 0.01 * v * v
                m[n] -= (rate * mean[n] / (1 - 0.9**step) / (np.sqrt(var[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return m | {"langs": langs}


def classify(data: np.ndarray, off: np.ndarray, m: dict, block: int = 4096):
    """Mean class probabilities of each row, over all its bytes."""
    sizes = off[1:] - off[:-1]
    per = -(-sizes // CHUNK)
    row = np.repeat(np.arange(len(sizes)), per)
    at = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start, k = off[:-1][row] + at * CHUNK, len(m["langs"])
    length = np.minimum(CHUNK, off[1:][row] - start)
    sums = np.zeros((len(sizes), k))
    order = np.argsort(-length, kind="stable")
    y = np.empty((CHUNK, min(block, len(order)), k), np.float32)
    for i in range(0, len(order), block):
        o = order[i:i + block]
        steps = np.arange(length[o[0]])[:, None]
        x = np.where(steps < length[o], data[np.minimum(start[o] + steps, len(data) - 1)], 32).astype(np.intp)
        np.add.at(sums, row[o], _pooled(x, length[o], m, y[:len(x), :len(o)]))
    return sums / np.maximum(sizes, 1)[:, None]


def positions(text: str, model: dict) -> list[tuple[int, int, str]]:
    """The label of every byte of one text, as runs (start, end, language)."""
    raw, runs = (text or "").encode(), []
    for i in range(0, len(raw), CHUNK):
        p, _, _ = _probabilities(np.frombuffer(raw[i:i + CHUNK], np.uint8)[:, None], model)
        for j, c in enumerate(p[:, 0].argmax(-1)):
            if runs and runs[-1][2] == model["langs"][c]:
                runs[-1] = (runs[-1][0], i + j + 1, runs[-1][2])
            else:
                runs.append((i + j, i + j + 1, model["langs"][c]))
    return runs


def held_out(doc_id: str = "doc_id", parts: int = 3, part: int = 1):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def train(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_chars: int = SAMPLE_CHARS) -> dict | None:
    """Fit on about ``sample_texts`` labelled texts per language: a window of ``sample_chars`` of each,
    chosen by hash. Only ``text`` and ``lang`` of rows that are not held out are read. None without labels."""
    rows = pick(docs, "doc_id", "text", "lang").filter(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    chance = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, sample_texts / r["count"])))])
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw < chance[F.col("lang")])
    begin = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1) + 1
    got = sample.select("lang", F.substring(F.col("text"), begin.cast("int"), F.lit(sample_chars)).alias("t")).collect()
    got = sorted((r["lang"], r["t"].encode()) for r in got if r["t"])
    if not got:
        return None
    return fit([t for _, t in got], [l for l, _ in got])


def identify(docs: DataFrame, model: dict | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred and score (the mean probability of lang_pred over all bytes).

    A text that is null or has no letter is ``und`` with score 0, as is every text without a model.
    Every row gives a row, repeated ids included; the prediction sees the text alone.
    """
    cols = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*cols, F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("tx"))

    def run(batches):
        for batch in batches:
            data, off = buffers(batch.column(len(keep)))
            lang, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            for i, d, o in pieces(data, off) if model else ():
                p = classify(d, o, model)
                some = np.flatnonzero(o[1:] > o[:-1])
                best = p[some].argmax(1)
                lang[i + some], score[i + some] = np.array(model["langs"], object)[best], np.clip(p[some, best], 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(lang, pa.string()), pa.array(score)],
                                             names=[*batch.schema.names[:len(keep)], "lang_pred", "score"])

    kinds = [f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    out = rows.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.4) -> DataFrame:
    """Documents without ``und`` or doubtful ones (score under ``least``).

    Without a labelled text to learn from there is no language to tell, and every document stays. A null or letterless
    text is ``und``; repeated rows fare alike; an empty table gives none; the columns stay as they are.
    """
    names, model = tuple(docs.columns), train(docs)
    if model is None:
        return docs
    return identify(docs, model, names).filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*[F.col(f"`{n}`") for n in names])
