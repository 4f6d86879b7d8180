"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads windows of ``SPAN`` bytes from both sides with a gated recurrent unit each. At every position a
softmax over the languages sees both states, so every byte of a document gets a label distribution; a document's
probabilities are the mean over its bytes. Windows cover the whole text, each byte once.

Training is backpropagation through time with Adam on the driver, on a bounded sample: ``PER_LANGUAGE`` labelled
documents of each language (smallest hash of the id first), from each of them ``WINDOWS`` windows spread evenly over
the whole text. Documents with crc32(doc_id) mod 4 = 2 are held out. Prediction sees nothing but the text; it is one
pass without a shuffle, thousands of windows at a time in lock step, and the weights (some kB) go with the tasks.

Defined results: null texts and texts without a letter are ``und`` with score 0; of equally probable languages the first by
name is taken; without a labelled row all are; null
or repeated ids pass through (a null id isn't held out); an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import held_out, sized, table, unused
from riskframe.llm.registry import register

SPAN, HIDDEN = 64, 12
PER_LANGUAGE, WINDOWS = 300, 12
STEPS, BATCH, RATE, SEED = 400, 256, 0.02, 7
#: Windows that pass through the network together.
LOCKSTEP = 2048
UND = "und"
#: A document is kept where one language gets this share of its probability (four languages: 0.25 is no knowledge).
LEAST = 0.4


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class ByteNetwork:
    """Weights: E (2, 3H, 256) input, U (2, 3H, H) recurrent, b (2, 3H) recurrent bias; V (K, 2H), c (K) output.

    The three H rows are update gate, reset gate and candidate. States are (2, H, n): forward and backward.
    """

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.labels, self.h, k = labels, hidden, len(labels)
        self.w = {
            "E": r.normal(0, 0.3, (2, 3 * hidden, 256)),
            "U": r.normal(0, hidden**-0.5, (2, 3 * hidden, hidden)),
            "b": np.zeros((2, 3 * hidden, 1)),
            "V": r.normal(0, 0.3, (k, 2 * hidden)),
            "c": np.zeros((k, 1)),
        }
        self.w = {n: x.astype(np.float32) for n, x in self.w.items()}

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x: (T, n) bytes. Returns (T, 2, H, n): the state of both directions at each position of the text."""
        (span, n), h = x.shape, self.h
        e, u, b = self.w["E"], self.w["U"], self.w["b"]
        out = np.empty((span, 2, h, n), dtype=np.float32)
        s = np.zeros((2, h, n), dtype=np.float32)
        for t in range(span):
            a = np.matmul(u, s)
            a += b
            put = np.stack([e[0].take(x[t], axis=1), e[1].take(x[span - 1 - t], axis=1)])
            gates = put[:, : 2 * h]
            gates += a[:, : 2 * h]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :h], gates[:, h:]
            cand = put[:, 2 * h :]
            cand += r * a[:, 2 * h :]
            np.tanh(cand, out=cand)
            if keep is not None:
                keep.append((s, a, z, r, cand))
            s = s - cand
            s *= z
            s += cand
            out[t, 0] = s[0]
            out[span - 1 - t, 1] = s[1]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(T, K, n): the label distribution at every position."""
        return self.softmax(self.states(x))

    def softmax(self, states: np.ndarray) -> np.ndarray:
        span, _, h, n = states.shape
        p = np.matmul(self.w["V"], states.reshape(span, 2 * h, n))
        p += self.w["c"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Cross entropy per position of windows x (T, n) with labels y (n), and its gradients through time."""
        (span, n), h = x.shape, self.h
        kept: list = []
        states = self.states(x, kept)
        p = self.softmax(states)
        count = mask.sum()
        loss = float(-(np.log(p[:, y, np.arange(n)] + 1e-9) * mask).sum() / count)
        d = p
        d[:, y, np.arange(n)] -= 1
        d *= (mask / count)[:, None, :]
        flat = states.reshape(span, 2 * h, n)
        g = {"V": np.einsum("tkn,thn->kh", d, flat), "c": d.sum(axis=(0, 2))[:, None]}
        ds_all = np.matmul(self.w["V"].T, d).reshape(span, 2, h, n)
        g |= {k: np.zeros_like(self.w[k]) for k in ("E", "U", "b")}
        back = np.zeros((2, h, n), dtype=np.float32)
        for t in range(span - 1, -1, -1):
            s, a, z, r, cand = kept[t]
            ds = back + np.stack([ds_all[t, 0], ds_all[span - 1 - t, 1]])
            dz = ds * (s - cand) * z * (1 - z)
            dc = ds * (1 - z) * (1 - cand * cand)
            dr = dc * a[:, 2 * h :] * r * (1 - r)
            into = np.concatenate([dz, dr, dc], axis=1)
            da = np.concatenate([dz, dr, dc * r], axis=1)
            g["U"] += np.matmul(da, s.transpose(0, 2, 1))
            g["b"] += da.sum(axis=2, keepdims=True)
            for way, row in ((0, x[t]), (1, x[span - 1 - t])):
                one = np.zeros((n, 256), dtype=np.float32)
                one[np.arange(n), row] = 1
                g["E"][way] += into[way] @ one
            back = ds * z + np.matmul(self.w["U"].transpose(0, 2, 1), da)
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE) -> ByteNetwork:
        """x: (N, T) windows, y: (N) labels, mask: (N, T) is 1 on bytes of the text. Adam, falling rate."""
        r = np.random.default_rng(SEED)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(w) for k, w in self.w.items()}
        for step in range(1, steps + 1):
            some = r.integers(0, len(x), batch)
            _, g = self.gradients(x[some].T, y[some], mask[some].T.astype(np.float32))
            size = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
            for k, q in g.items():
                q = q * min(1.0, 1.0 / (size + 1e-9))
                m[k] += 0.1 * (q - m[k])
                v[k] += 0.001 * (q * q - v[k])
                fall = rate * (1 - step / (steps + 1))
                self.w[k] -= (fall * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(number of texts, K): each text's mean label distribution over all its bytes."""
        size = np.array([len(t) for t in texts])
        spans = -(-size // SPAN)
        padded = np.zeros((int(spans.sum()), SPAN), dtype=np.uint8)
        start = np.cumsum(spans) - spans
        flat = padded.reshape(-1)
        for t, at in zip(texts, start.tolist()):
            flat[at * SPAN : at * SPAN + len(t)] = np.frombuffer(t, np.uint8)
        real = np.full(len(padded), SPAN)
        ends = start + spans - 1
        real[ends[size > 0]] = (size - (spans - 1) * SPAN)[size > 0]
        total = np.zeros((len(padded), len(self.labels)))
        for i in range(0, len(padded), LOCKSTEP):
            x = np.ascontiguousarray(padded[i : i + LOCKSTEP].T)
            p = self.probabilities(x)
            n = real[i : i + LOCKSTEP]
            short = n < SPAN
            total[i : i + LOCKSTEP] = p.sum(axis=0).T
            if short.any():
                beyond = np.arange(SPAN)[:, None] >= n[short][None, :]
                total[i : i + LOCKSTEP][short] -= (p[:, :, short] * beyond[:, None, :]).sum(axis=0).T
        out = np.zeros((len(texts), len(self.labels)))
        np.add.at(out, np.repeat(np.arange(len(texts)), spans), total)
        return out / np.maximum(size, 1)[:, None]


def windows_of(text: str, n: int = WINDOWS) -> list[bytes]:
    """``n`` windows spread evenly over the whole text."""
    raw = text.encode()
    last = max(0, len(raw) - SPAN)
    return [raw[a : a + SPAN] for a in sorted({last * i // max(1, n - 1) for i in range(n)})]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, steps: int = STEPS) -> ByteNetwork | None:
    """A network from ``per_language`` labelled documents of each language outside the held-out part; None without any."""
    ident, lang = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{lang_col}`").cast("string")
    labelled = lang.isNotNull() & F.col(f"`{text_col}`").isNotNull() & ~held_out(ident)
    ranked = docs.where(labelled).select(ident.alias("_l_id"), lang.alias("_l_lang"))
    order = Window.partitionBy("_l_lang").orderBy(F.xxhash64("_l_id"), "_l_id")
    # At most per_language ids of each language.
    ids = ranked.withColumn("_l_no", F.row_number().over(order)).where(F.col("_l_no") <= per_language).select("_l_id").distinct()
    rows = docs.where(labelled).select(ident.alias("id"), lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.join(sized(ids, "language-sample"), F.col("id").eqNullSafe(F.col("_l_id")), "left_semi")

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(windows_of)

    got = rows.select("id", "lang", cut("text").alias("windows")).sort("id", "lang").collect()
    labels = sorted({r["lang"] for r in got})
    if not labels:
        return None
    raw = [(bytes(w), labels.index(r["lang"])) for r in got for w in r["windows"]]
    x = np.zeros((len(raw), SPAN), dtype=np.uint8)
    mask = np.zeros((len(raw), SPAN), dtype=np.uint8)
    for i, (w, _) in enumerate(raw):
        x[i, : len(w)] = np.frombuffer(w, np.uint8)
        mask[i, : len(w)] = 1
    keep = mask.any(axis=1)
    if not keep.any():
        return None
    return ByteNetwork(labels).fit(x[keep], np.array([y for _, y in raw])[keep], mask[keep], steps)


def predicted(text: Column, net: ByteNetwork | None) -> Column:
    """struct(lang_pred, score) of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = np.full(len(texts), UND, dtype=object), np.zeros(len(texts))
            values = texts.to_numpy()
            todo = [i for i, t in enumerate(values) if net is not None and t is not None and any(map(str.isalpha, t))]
            for a, b in lots([len(values[i]) for i in todo]):
                p = net.documents([values[i].encode() for i in todo[a:b]])
                best = p.argmax(axis=1)
                lang[todo[a:b]] = np.array(net.labels, dtype=object)[best]
                score[todo[a:b]] = p[np.arange(len(best)), best].clip(0, 1)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return udf(text.cast("string"))


def lots(sizes: list[int], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of about ``most`` characters."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def identify(docs: DataFrame, net: ByteNetwork | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; trains on ``docs`` unless a network is given."""
    net = train(docs, id_col, text_col, lang_col) if net is None else net
    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), predicted(F.col(f"`{text_col}`"), net).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def lettered(text: Column) -> Column:
    """Whether a text has a letter; false for null."""

    @F.pandas_udf("boolean")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)

    return udf(text.cast("string"))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: Collection[str] | None = None, least: float = LEAST) -> DataFrame:
    """The rows that the network takes for one of its languages (of ``languages``, where these are given) with a score of
    ``least`` or more, with all their columns. Texts without a letter go. Where no label is there to train a network, all rows
    with a letter stay, whatever ``languages`` says."""
    net = train(docs, id_col, text_col, lang_col)
    if net is None:
        return docs.where(lettered(F.col(f"`{text_col}`")))
    name = unused(docs, "_lid")
    rows = docs.withColumn(name, predicted(F.col(f"`{text_col}`"), net))
    known = F.col(f"{name}.lang_pred").isin(sorted(languages)) if languages is not None else F.col(f"{name}.lang_pred") != UND
    return rows.where(known & (F.col(f"{name}.score") >= least)).drop(name)


@register("op2_language_id")
def op2_language_id(spark, sf_dir) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
