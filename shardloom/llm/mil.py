"""Multiple-instance learning over texts: a quality classifier with gated attention and a toxicity scorer with noisy-or.

Both learn from document labels only, on a bounded sample of labelled rows (the bound is a parameter) with all their
passages and sentences; features of the sample are worked out on the executors and only they come to the driver. Scoring
covers every row and every passage and sentence of it, where the row is read, with no shuffle.

Defined cases: a null text is the empty text, which is one empty passage (quality) or has no sentence and scores the
model's base rate (toxicity); labels repeated for a doc_id count as their maximum, null labels not at all; repeated
rows score alike; ties of scores do not matter; without both kinds of labels the score is the share of label 1; very long
texts are scored whole; a text without blanks is one word; columns other than doc_id and text are not read, and
keep_good() passes them through (a column named `_ll_score` is refused).
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Labelled rows that a model is fitted on, at most.
MOST_SAMPLES = 8_000
#: Bytes of their texts that a classifier learns from; passages and sentences of the sample take less than that.
MOST_SAMPLE_BYTES = 256 << 20
#: Words of a passage.
PASSAGE = 48
#: Words that a worker keeps.
KEPT_WORDS, KEPT_CHARS = 200_000, 16_000_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, most: int, most_bytes: int = MOST_SAMPLE_BYTES) -> DataFrame:
    """doc_id, text, y of at most `most` labelled rows outside the held-out ones, chosen by a hash of their ids, one for each
    doc_id (of several texts the one of least hash), and no more of them, in order of that hash, than hold most_bytes of text.
    Written to the shared folder."""
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (common.doc_crc(F.col("doc_id")) % parts != held))
    rows = common.sampled(rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")), most, "doc_id")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(rows), "doc_id")  # at most `most` rows of 12 bytes
    one = common.cut(found.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")), f"{label}-sample")
    sizes = one.select("doc_id", F.octet_length("text").cast("long").alias("size"))
    if (sizes.agg(F.sum("size")).first()[0] or 0) <= most_bytes:
        return one
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # `most` narrow rows
    within = sizes.withColumn("upto", F.sum("size").over(order)).where(F.col("upto") <= most_bytes).select("doc_id")
    return one.join(F.broadcast(within), "doc_id", "left_semi")


# --- quality: gated attention over passages -------------------------------------------------------------------------

#: Hashed directions of a word beside the shape of its letters.
DIRECTIONS = 16
SHAPES = 14


class Passages:
    """Vectors of a text's passages: means over their words of each word's shape and hashed directions, and how much
    the words repeat."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.chars = 0
        self.rows = np.zeros((1024, SHAPES + DIRECTIONS), np.float32)

    def word(self, w: str) -> np.ndarray:
        n = len(w)
        letters = sum(map(str.isalpha, w))
        digits = sum(map(str.isdigit, w))
        others = n - letters - digits
        tail = w[-1]
        seed = int.from_bytes(common.hashlib.blake2b(w.lower().encode(), digest_size=8).digest(), "little")
        shape = [min(n, 30) / 10, n > 12, n <= 3, letters / n, digits / n, others / n, w.isupper() and n > 1, w[0].isupper() and not w.isupper(), letters == 0, not tail.isalnum() and tail not in ".,;:", others >= 2, tail in ".,;:", tail in "!?", n > 40]
        signs = [((seed >> i) & 1) * 0.5 - 0.25 for i in range(DIRECTIONS)]
        return np.array(shape + signs, np.float32)

    def index(self, w: str) -> int:
        i = len(self.at)
        if i == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[i] = self.word(w)
        self.chars += len(w)
        self.at[w] = i
        return i

    def vectors(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return np.zeros((1, SHAPES + DIRECTIONS + 3), np.float32)
        if len(self.at) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.at.clear()
            self.chars = 0
        get, index = self.at.get, self.index
        ids = np.array([get(w, -1) for w in words], np.int64)
        for i in np.flatnonzero(ids < 0):
            ids[i] = get(w := words[i], -1)
            if ids[i] < 0:
                ids[i] = index(w)
        n = len(ids)
        starts = np.arange(0, max(n - PASSAGE // 2, 1), PASSAGE)  # a short rest belongs to the passage before it
        sizes = np.diff(np.append(starts, n)).astype(np.float32)[:, None]
        means = np.add.reduceat(self.rows[ids], starts, axis=0) / sizes
        same = np.zeros(n, np.float32)
        same[1:] = ids[1:] == ids[:-1]
        # distinct words of each passage: firsts in (passage, word) order
        part = np.repeat(np.arange(len(starts)), sizes[:, 0].astype(np.int64))
        order = np.sort(part << 40 | ids)
        fresh = np.ones(n, np.float32)
        fresh[1:] = order[1:] != order[:-1]
        distinct = np.add.reduceat(fresh, starts)[:, None] / sizes
        return np.concatenate([means, np.add.reduceat(same, starts)[:, None] / sizes, distinct, np.log1p(sizes) / 4], axis=1)


class GatedAttention:
    """Encoder tanh, gated attention over passages, logistic score of the attended vector."""

    def __init__(self, seed: int = 0, hidden: int = 24, gate: int = 12):
        self.hidden, self.gate, self.seed = hidden, gate, seed
        self.p: dict[str, np.ndarray] = {}
        self.mean = self.scale = None
        self.base = 0.5

    def start(self, d: int) -> None:
        r = np.random.default_rng(self.seed)
        w = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {"W": w(d, self.hidden), "b": np.zeros(self.hidden, np.float32), "V": w(self.hidden, self.gate), "U": w(self.hidden, self.gate), "a": w(self.gate, 1)[:, 0], "c": w(self.hidden, 1)[:, 0], "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray):
        p = self.p
        h = np.tanh((x - self.mean) / self.scale @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return h, t, s, a, z, z @ p["c"] + p["d"]

    def gradients(self, xs: np.ndarray, starts: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of the bags, by parameter."""
        p = self.p
        h, t, s, a, z, logit = self.forward(xs, starts, bag)
        g = (1 / (1 + np.exp(-logit)) - y).astype(xs.dtype) / len(starts)
        gz = g[:, None] * p["c"]
        ga = (gz[bag] * h).sum(1)
        ge = a * (ga - np.add.reduceat(a * ga, starts)[bag])
        gts = ge[:, None] * p["a"]
        gt, gs = gts * s * (1 - t * t), gts * t * s * (1 - s)
        gh = a[:, None] * gz[bag] + gt @ p["V"].T + gs @ p["U"].T
        gp = gh * (1 - h * h)
        xn = (xs - self.mean) / self.scale
        return {"W": xn.T @ gp, "b": gp.sum(0), "V": h.T @ gt, "U": h.T @ gs, "a": ((t * s) * ge[:, None]).sum(0), "c": z.T @ g, "d": g.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 0.01) -> GatedAttention:
        x = np.concatenate(bags)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-2
        self.start(x.shape[1])
        self.base = float(y.mean())
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        r, step = np.random.default_rng(self.seed + 1), 0
        for epoch in range(epochs):
            order = r.permutation(len(bags))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                some = [bags[i] for i in chosen]
                sizes = np.array([len(b) for b in some])
                starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(some)), sizes)
                xs = np.concatenate(some)
                p, grads = self.p, self.gradients(xs, starts, bag, y[chosen])
                step += 1
                lr = rate * (0.1 + 0.9 * (1 - epoch / epochs))
                for k, gk in grads.items():
                    gk = gk + 1e-4 * p[k]
                    m[k] += 0.1 * (gk - m[k])
                    v[k] += 0.01 * (gk * gk - v[k])
                    p[k] = (p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not self.p:
            return np.full(len(bags), self.base)
        sizes = np.array([len(b) for b in bags])
        starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes)
        return 1 / (1 + np.exp(-np.clip(self.forward(np.concatenate(bags), starts, bag)[-1].astype(np.float64), -30, 30)))


def passage_vectors(texts: pa.Array) -> pa.Array:
    """All passages of sample documents as flat bytes."""
    f = Passages()
    return pa.array([f.vectors(text.as_py()).astype(np.float16).tobytes() for text in texts], pa.binary())


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = MOST_SAMPLES) -> GatedAttention:
    sample = labelled(docs, labels, "quality", 4, 2, most).select("doc_id", "y", F.arrow_udf(passage_vectors, "binary")("text").alias("x"))
    rows = sorted(sample.collect(), key=lambda r: (r.doc_id, r.y, r.x))
    model = GatedAttention()
    y = np.array([r.y for r in rows], np.float32)
    if len({*y.tolist()}) < 2:
        model.base = float(y.mean()) if len(y) else 0.5
        return model
    width = SHAPES + DIRECTIONS + 3
    return model.fit([np.frombuffer(r.x, np.float16).astype(np.float32).reshape(-1, width) for r in rows], y)


def quality_score(spark: SparkSession, model: GatedAttention):
    """Column function text -> score."""
    blob = spark.sparkContext.broadcast(pickle.dumps(model))  # fixed size: the model's few thousand numbers

    def work(texts: pa.Array) -> pa.Array:
        m = common.per_worker(lambda: pickle.loads(blob.value), "quality" + common.digest_of(blob.value), "quality")
        f = common.per_worker(Passages, "passages", "quality")
        out = []
        for run in common.chunks([t or "" for t in texts.to_pylist()]):
            out.append(m.scores([f.vectors(t) for t in run]))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return F.arrow_udf(common.sliced(work), "double")


QUALITY_LEAST, TOXIC_LEAST = 0.7, 0.5


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents").select("doc_id", "text"), common.read(spark, sf_dir, "labels")
    scored = docs.withColumn("score", quality_score(spark, fit_quality(docs, labels))("text"))
    return scored.select("doc_id", (common.doc_crc(F.col("doc_id")) % 4 == 2).alias("held_out"), "score", F.when(F.col("score") >= QUALITY_LEAST, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier does not reject, with docs' columns."""
    common.refuse(docs, "_ll_score")
    model = fit_quality(docs, labels)
    return docs.withColumn("_ll_score", quality_score(docs.sparkSession, model)("text")).where(F.col("_ll_score") >= QUALITY_LEAST).select(*[F.col(f"`{c}`") for c in docs.columns])


# --- toxicity: noisy-or over sentences ------------------------------------------------------------------------------

SENTENCES = re.compile(r"[^.!?\n]+")
#: In how many toxic sample documents a word must stand that the scorer weighs.
LEAST_TOXIC = 3
#: Standard deviations by which a word must stand in toxic documents more often than by chance.
LIFT = 4.0
#: Marks at the edges of a word, which do not belong to it.
EDGES = "\"'.,;:!?()[]{}*#$%&|-_<>"


def sentences(text: str | None) -> list[tuple[int, int]]:
    return [m.span() for m in SENTENCES.finditer(text or "") if not m[0].isspace()]


def cut_words(low: str) -> list[str]:
    """The words of all sentences of a lower-cased text: what no blank and no end of a sentence parts."""
    return low.replace(".", " ").replace("!", " ").replace("?", " ").split()


def features(word: str) -> list[str]:
    """What a word counts as: itself, and its first three and four letters where it is longer."""
    w = word.strip(EDGES)
    return [w, *("^" + w[:n] for n in (3, 4) if len(w) > n)] if w else []


class NoisyOr:
    """p(document) = 1 - prod over sentences of (1 - p(sentence)), p(sentence) a logistic function of its words."""

    def __init__(self, terms: list[str]):
        self.terms = {t: i for i, t in enumerate(terms)}
        self.w = np.zeros(len(terms), np.float64)
        self.b, self.base, self.held = -8.0, 0.0, None

    def __getstate__(self):
        return self.__dict__ | {"held": None}

    def fit(self, docs: list[tuple[int, list[list[int]]]], y: np.ndarray, steps: int = 400, rate: float = 0.1) -> NoisyOr:
        """docs: for each the number of sentences without a term, and the terms of the others."""
        plain = np.array([d[0] for d in docs], np.float64)
        sents = [(i, s) for i, d in enumerate(docs) for s in d[1]]
        owner = np.array([i for i, _ in sents], np.int64)
        of = np.array([j for j, (_, s) in enumerate(sents) for _ in s], np.int64)
        term = np.array([t for _, s in sents for t in s], np.int64)
        theta, m, v = np.append(self.w, self.b), np.zeros(len(self.w) + 1), np.zeros(len(self.w) + 1)
        soft = lambda x: np.logaddexp(0, x)
        for step in range(1, steps + 1):
            w, b = theta[:-1], theta[-1]
            x = b + (np.bincount(of, w[term], len(sents)) if len(of) else np.zeros(len(sents)))
            none = -plain * soft(b) - np.bincount(owner, soft(x), len(docs)) if len(sents) else -plain * soft(b)
            q = np.exp(none)
            scale = np.where(y > 0, -q / np.maximum(1 - q, 1e-9), 1.0) / len(docs)
            gx = (1 / (1 + np.exp(-x))) * scale[owner] if len(sents) else x
            g = np.append(np.bincount(term, gx[of], len(w)) if len(of) else np.zeros(len(w)), gx.sum() + (plain * scale).sum() / (1 + np.exp(-b)))
            g[:-1] += 1e-7 * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)
            theta[-1] = min(theta[-1], -4.0)
        self.w, self.b = theta[:-1], float(theta[-1])
        return self

    def text_terms(self, text: str | None) -> tuple[int, list[tuple[int, int, list[int]]]]:
        """Number of sentences without a term; start, end, terms of the others. The words are looked up first, and only a
        text that holds a term is cut into sentences one by one."""
        if not text:
            return 0, []
        low = text.lower()
        if self.held is None:
            self.held = common.Kept(lambda w: tuple(t for f in features(w) if (t := self.terms.get(f)) is not None), KEPT_WORDS)
        of = self.held.__getitem__
        if not any(map(of, {*cut_words(low)})):
            return sum(1 for s in SENTENCES.findall(low) if not s.isspace()), []
        plain, found = 0, []
        for a, b in sentences(text):
            held = {t for w in text[a:b].lower().split() for t in of(w)}
            if held:
                found.append((a, b, sorted(held)))
            else:
                plain += 1
        return plain, found

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score; start, end, score of each sentence that is more likely toxic than not."""
        plain, found = self.text_terms(text)
        xs = np.array([self.b + self.w[held].sum() for _, _, held in found])
        none = -plain * np.logaddexp(0, self.b) - np.logaddexp(0, xs).sum()
        if not plain and not found:
            return self.base, []
        return float(-np.expm1(none)), [(a, b, float(p)) for (a, b, _), p in zip(found, 1 / (1 + np.exp(-xs)), strict=True) if p >= TOXIC_LEAST]


def sample_terms(terms: list[str]):
    """Column function text -> struct(plain, sents) for a sample document."""

    def work(texts: pa.Array) -> pa.Array:
        m, out = NoisyOr(terms), []
        for text in texts.to_pylist():
            plain, found = m.text_terms(text)
            out.append({"plain": plain, "sents": [held for _, _, held in found]})
        return pa.array(out, pa.struct([("plain", pa.int32()), ("sents", pa.list_(pa.list_(pa.int32())))]))

    return F.arrow_udf(work, "plain int, sents array<array<int>>")


def distinct_words(texts: pa.Array) -> pa.Array:
    return pa.array([sorted({f for w in {*cut_words((t or "").lower())} for f in features(w)}) for t in texts.to_pylist()], pa.list_(pa.string()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_SAMPLES) -> NoisyOr:
    """Terms are the words that stand more often in toxic sample documents than chance allows; their weights are
    learned through the noisy-or from document labels."""
    sample = labelled(docs, labels, "toxic", 5, 0, most)
    n, n_toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    model = NoisyOr([])
    model.base = n_toxic / n if n else 0.0
    if not n_toxic or n_toxic == n:
        return model
    words = sample.select("y", F.explode(F.arrow_udf(distinct_words, "array<string>")("text")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t"))
    share = n_toxic / n
    lift = F.col("t") - F.col("n") * share - LIFT * F.sqrt(F.col("n") * share)
    terms = words.where((F.col("t") >= LEAST_TOXIC) & (lift > 0)).collect()  # at most the words of the sample's toxic documents
    terms.sort(key=lambda r: r.w)
    model = NoisyOr([r.w for r in terms])
    # from the words' own odds: where toxic words stand together, one would otherwise explain the others away
    n, t = np.array([[r.n, r.t] for r in terms] or np.zeros((0, 2)), np.float64).T
    model.w = np.log((t + 0.5) / (n - t + 0.5)) - np.log(share / (1 - share))
    rows = sorted(sample.select("doc_id", "y", sample_terms([*model.terms])("text").alias("s")).collect(), key=lambda r: (r.doc_id, r.y))
    model.fit([(r.s.plain, r.s.sents) for r in rows], np.array([r.y for r in rows], np.float64))
    model.base = 1 / (1 + np.exp(-model.b))
    return model


def toxicity_score(spark: SparkSession, model: NoisyOr):
    """Column function text -> struct(score, offending array<struct(start, end, score)>), offsets in characters."""
    blob = spark.sparkContext.broadcast(pickle.dumps(model))  # at most the words of the sample's toxic documents

    def work(texts: pa.Array) -> pa.Array:
        m = common.per_worker(lambda: pickle.loads(blob.value), "toxic" + common.digest_of(blob.value), "toxic")
        out = []
        for text in texts.to_pylist():
            score, bad = m.score(text)
            out.append({"score": score, "offending": [{"start": a, "end": b, "score": p} for a, b, p in bad]})
        return pa.array(out, pa.struct([("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]))

    return F.arrow_udf(work, "score double, offending array<struct<start: int, end: int, score: double>>")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents").select("doc_id", "text"), common.read(spark, sf_dir, "labels")
    scored = docs.withColumn("s", toxicity_score(spark, fit_toxicity(docs, labels))("text"))
    return scored.select(
        "doc_id", (common.doc_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), F.col("s.score").alias("score"), F.when(F.col("s.score") >= TOXIC_LEAST, 1).otherwise(0).alias("predicted"),
        F.transform("s.offending", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("offending"),
    )
