"""Toxicity by weak supervision.

1. Lexicon.  Words and word beginnings (4 to 6 letters) that occur far more often in
   toxic than in other labelled documents become terms, with their weight of evidence.
2. Voters.  Terms are dealt into many small lexicons, words and beginnings apart; each
   lexicon is a voter, and so are patterns over all terms (several different terms, a
   density of terms, a term repeated, terms close together).
3. Label model.  The voters are run over all documents and only their joint counts are
   summed.  From the covariances alone a generative model estimates each voter's
   accuracy (triplets) and which voters are correlated beyond it.  The posterior of a
   document weighs its voters by accuracy, correlated ones as one.
4. Classifier.  A linear model is trained on posterior labels and gives the score.

Terms are counted over every labelled row that may be used; of those that pass the tests the
``Settings.terms`` with the most evidence make the lexicon, so further ones are no voter and
no feature.  The classifier is fitted on a bounded sample of labelled rows
(``Settings.sample``); the label model's counts and the scores cover every document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize
from churnpanel.llm.text import RangeHash, byte_values, mix, pieces


@dataclass(frozen=True)
class Settings:
    #: Labelled documents used to fit the classifier, at most (those of least hash).
    sample: int = 40_000
    #: Terms kept at most, documents a term must occur in (toxic ones), least ratio of rates.
    terms: int = 3_000
    support: int = 3
    ratio: float = 8.0
    #: Least likelihood-ratio statistic (about one chance in a million for a random term).
    surprise: float = 25.0
    #: Lexicon voters for words and for beginnings, and letters of the beginnings.
    word_voters: int = 8
    stem_voters: int = 8
    stems: tuple[int, ...] = (4, 5, 6)
    threshold: float = 0.7


#: Bytes that are part of a term: ASCII letters and everything outside ASCII.
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[97:123] = True
_TERM_BYTE[128:] = True


def _terms(buf: np.ndarray, offs: np.ndarray, stems: tuple[int, ...]):
    """(document, hash, kind, start byte, end byte) of all terms of a lower-cased piece."""
    n = len(buf)
    inside = _TERM_BYTE[buf]
    begins, stops = inside.copy(), np.zeros(n + 1, bool)
    begins[1:] &= ~inside[:-1]
    edge = offs[:-1][offs[:-1] < n]
    begins[edge] = inside[edge]
    stops[1:] = inside
    stops[1:n] &= ~inside[1:]
    last = offs[1:][offs[1:] > 0]
    stops[last] = inside[last - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(stops)
    rh = RangeHash(byte_values(buf))
    point = np.flatnonzero((buf & 0xC0) != 0x80)
    number = np.searchsorted(point, s)
    out = [(s, e, 0)]
    for k in stems:
        at = np.append(point, n)[np.minimum(number + k, len(point))]
        ok = at < e  # proper beginnings only
        out.append((s[ok], at[ok], k))
    starts = np.concatenate([x[0] for x in out])
    ends = np.concatenate([x[1] for x in out])
    kinds = np.concatenate([np.full(len(x[0]), x[2], np.int8) for x in out])
    docs = np.searchsorted(offs, starts, "right") - 1
    return docs, mix(rh(starts, ends) ^ (kinds.astype(np.uint64) + np.uint64(7))).view(np.int64), kinds, starts, ends


def _lower(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.withColumn("_text", F.lower(F.coalesce(F.col(text_col), F.lit(""))))


def held_out(id_col: str = "doc_id"):
    """True for rows whose label may not be used: crc32(id as text) mod 3 is 1 (null id: held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


# --- lexicon -------------------------------------------------------------------

def labelled_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, lower-cased text, label and sampled (for the classifier) of all rows that labels
    may be used of.

    Several labels of one document count as toxic if any does; null labels are left out."""
    usable = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample).select("doc_id", F.lit(True).alias("sampled"))
    usable = usable.join(chosen, "doc_id", "left").withColumn("sampled", F.coalesce("sampled", F.lit(False)))
    return _lower(docs, "text").select("doc_id", "_text").join(usable, "doc_id")


def mine_lexicon(labelled: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(hashes, kinds, weight of evidence, share of toxic rows) of the terms.

    Documents per term are counted in Spark with partial sums; only terms that pass the
    support and ratio tests come back, ``settings.terms`` at most."""
    stems = settings.stems

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in pieces(batches, "_text"):
            docs, hashes, kinds, _, _ = _terms(buf, offs, stems)
            label = rows.column(1).to_numpy(zero_copy_only=False)
            # once per document, then summed within the piece
            order = np.lexsort((docs, hashes))
            h, d, k = hashes[order], docs[order], kinds[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            h, d, k = h[new], d[new], k[new]
            keys, first, back = np.unique(h, return_index=True, return_inverse=True)
            pos = np.bincount(back, weights=label[d], minlength=len(keys)).astype(np.int64)
            n = np.bincount(back, minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(k[first].astype(np.int32)), pa.array(pos), pa.array(n)],
                names=["term", "kind", "pos", "n"])

    size = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("pos")).first()
    n, pos = int(size["n"]), int(size["pos"])
    if not pos or pos == n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), pos / n if n else 0.0
    counts = labelled.select("_text", "label").mapInArrow(emit, "term long, kind int, pos long, n long")
    counts = counts.groupBy("term").agg(F.min("kind").alias("kind"), F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    rate = ((F.col("pos") + 0.1) / (pos + 1)) / ((F.col("n") - F.col("pos") + 0.1) / (n - pos + 1))
    share = pos / n
    part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    surprise = 2 * (part(F.col("pos"), F.col("n") * share) + part(F.col("n") - F.col("pos"), F.col("n") * (1 - share)))
    enough = (F.col("pos") >= settings.support) & (rate >= settings.ratio) & (surprise >= settings.surprise)
    best = counts.where(enough).select(
        "term", "kind", "pos", F.log(rate).alias("evidence")
    ).orderBy((F.col("pos") * F.col("evidence")).desc(), "term").limit(settings.terms).collect()
    return (np.array([r["term"] for r in best], np.int64), np.array([r["kind"] for r in best], np.int64),
            np.array([r["evidence"] for r in best]), pos / n)


# --- voters --------------------------------------------------------------------

class Voters:
    """Votes of lexicons and patterns, and the features of the linear model."""

    def __init__(self, hashes: np.ndarray, kinds: np.ndarray, settings: Settings):
        order = np.argsort(hashes)
        self.hashes, kinds = hashes[order], kinds[order]
        # terms come best first; dealing them in turn gives lexicons of like strength
        rank = np.empty(len(order), np.int64)
        for of_words, voters in ((True, settings.word_voters), (False, settings.stem_voters)):
            mine = np.flatnonzero((kinds[np.argsort(order)] == 0) == of_words)
            rank[mine] = np.arange(len(mine)) % voters + (0 if of_words else settings.word_voters)
        self.lexicon = rank[order]
        self.n_lexicons = settings.word_voters + settings.stem_voters
        self.stems = settings.stems
        self.names = [f"words_{i}" for i in range(settings.word_voters)]
        self.names += [f"stems_{i}" for i in range(settings.stem_voters)]
        self.names += ["two_terms", "four_terms", "dense", "repeated", "close"]

    def hits(self, buf: np.ndarray, offs: np.ndarray):
        """(document, term index, start byte) of every term found."""
        docs, hashes, _, starts, _ = _terms(buf, offs, self.stems)
        if not len(self.hashes) or not len(hashes):
            none = np.zeros(0, np.int64)
            return none, none, none
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ok = self.hashes[at] == hashes
        return docs[ok], at[ok], starts[ok]

    def votes(self, docs, term, starts, offs) -> np.ndarray:
        n = len(offs) - 1
        out = np.zeros((n, len(self.names)), bool)
        out[docs, self.lexicon[term]] = True
        place = np.unique(docs * np.int64(1 << 40) + starts)  # a word counts once, whatever terms it holds
        owner = place >> 40
        spots = np.bincount(owner, minlength=n)
        distinct = np.bincount(np.unique(docs * np.int64(1 << 20) + term) >> 20, minlength=n)
        base = self.n_lexicons
        out[:, base] = distinct >= 2
        out[:, base + 1] = distinct >= 4
        out[:, base + 2] = spots * 400 >= np.maximum(np.diff(offs), 1)
        out[:, base + 3] = spots > distinct
        near = (owner[1:] == owner[:-1]) & (np.diff(place) <= 60)
        out[owner[1:][near], base + 4] = True
        return out

    def features(self, docs, term, n: int):
        """Distinct (document, term) pairs."""
        pairs = np.unique(docs * np.int64(1 << 20) + term)
        return pairs >> 20, pairs & ((1 << 20) - 1)


# --- label model ---------------------------------------------------------------

class LabelModel:
    """Accuracies and correlations of binary voters, from their joint counts only.

    If votes depend on each other only through the label, the covariance of two voters
    is the product of their strengths, so three voters give the strength of each; the
    median over all triplets is taken.  What the product leaves over is correlation."""

    def __init__(self, total: float, joint: np.ndarray, prior: float):
        k = len(joint)
        mean = np.diag(joint) / max(total, 1)
        cov = joint / max(total, 1) - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(prior * (1 - prior), 1e-9))
        self.strength = np.zeros(k)
        live = np.flatnonzero(mean > 0)
        for i in live:
            found = [np.sqrt(cov[i, a] * cov[i, b] / cov[a, b]) for x, a in enumerate(live) for b in live[x + 1:]
                     if i not in (a, b) and cov[a, b] > 1e-12 and cov[i, a] > 0 and cov[i, b] > 0]
            self.strength[i] = np.median(found) if found else np.sqrt(max(cov[i, i], 0)) * 0.5
        gain = np.minimum(self.strength / spread, 1.0)  # P(vote | toxic) - P(vote | other)
        low = 1e-4
        self.false_rate = np.clip(mean - prior * gain, low, 1 - low)
        self.true_rate = np.clip(self.false_rate + gain, low, 1 - low)
        noise = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        rest = np.abs(cov - np.outer(self.strength, self.strength)) / np.outer(noise, noise)
        np.fill_diagonal(rest, 0)
        rest[:, mean == 0] = rest[mean == 0] = 0
        self.correlation = np.minimum(rest, 1.0)
        # a voter shares its evidence with those it is correlated with
        self.share = 1 / (1 + (self.correlation * (self.correlation > 0.2)).sum(1))
        self.dead = mean == 0
        self.prior = min(max(prior, 1e-3), 1 - 1e-3)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.true_rate / self.false_rate)
        no = np.log((1 - self.true_rate) / (1 - self.false_rate))
        w = np.where(self.dead, 0, self.share)
        z = np.log(self.prior / (1 - self.prior)) + votes @ (w * yes) + (~votes) @ (w * no)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def joint_counts(docs: DataFrame, voters: Voters) -> tuple[float, np.ndarray]:
    """Number of documents and of joint votes, summed over all of them."""
    k = len(voters.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, joint = 0, np.zeros((k, k))
        for _, buf, offs in pieces(batches, "_text"):
            v = voters.votes(*voters.hits(buf, offs), offs).astype(np.float64)
            total += len(v)
            joint += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array([float(total), *joint.ravel()]), pa.array(range(k * k + 1), pa.int32())],
                                         names=["value", "cell"])

    got = docs.select("_text").mapInArrow(count, "value double, cell int").groupBy("cell").agg(F.sum("value").alias("v")).collect()
    flat = np.zeros(k * k + 1)
    for r in got:
        flat[r["cell"]] = r["v"]
    return flat[0], flat[1:].reshape(k, k)


# --- classifier ----------------------------------------------------------------

def train_linear(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, target: np.ndarray,
                 penalty: float = 0.02, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels (accelerated gradient steps on sparse rows)."""
    w, b = np.zeros(n_cols), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    per_row = np.bincount(rows, minlength=n_rows)
    rate = 4 / max(1.0, np.percentile(per_row, 99) + 1)
    # classes are weighed alike
    weight = np.where(target > 0.5, 0.5 / max((target > 0.5).mean(), 1e-3), 0.5 / max((target <= 0.5).mean(), 1e-3))
    weight = np.minimum(weight, 20) / n_rows
    vw, vb = w.copy(), b
    for t in range(steps):
        z = np.bincount(rows, weights=vw[cols], minlength=n_rows) + vb
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        gw = np.bincount(cols, weights=g[rows], minlength=n_cols) + penalty / n_rows * vw
        nw, nb = vw - rate * gw * 4, vb - rate * g.sum()
        m = t / (t + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return w, b


class ToxicityModel:
    """Voters, label model and linear classifier; scores any documents."""

    def __init__(self, voters: Voters, weights: np.ndarray, bias: float, label_model: LabelModel | None, settings: Settings):
        self.voters, self.weights, self.bias = voters, weights, bias
        self.label_model, self.settings = label_model, settings

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> ToxicityModel:
        labelled = materialize(labelled_rows(docs, labels, settings), "toxicity-labelled")
        hashes, kinds, _, prior = mine_lexicon(labelled, settings)
        voters = Voters(hashes, kinds, settings)
        if not len(hashes):  # nothing to learn from: every score is the share of toxic rows
            p = min(max(prior, 1e-6), 1 - 1e-6)
            return cls(voters, np.zeros(0), float(np.log(p / (1 - p))), None, settings)
        label_model = LabelModel(*joint_counts(_lower(docs, "text"), voters), prior)

        def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, buf, offs in pieces(batches, "_text"):
                d, t, s = voters.hits(buf, offs)
                p = label_model.posterior(voters.votes(d, t, s, offs))
                rows, cols = voters.features(d, t, len(p))
                upto = np.searchsorted(rows, np.arange(len(p) + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(cols, pa.int32()))],
                    names=["p", "terms"])

        got = labelled.where("sampled").select("_text").mapInArrow(featurise, "p double, terms array<int>").collect()
        size = np.array([len(r["terms"]) for r in got], np.int64)
        cols = np.array([t for r in got for t in r["terms"]], np.int64)
        target = np.array([r["p"] for r in got])
        w, b = train_linear(np.repeat(np.arange(len(got)), size), cols, len(got), len(hashes), target)
        return cls(voters, w, b, label_model, settings)

    def score(self, docs: DataFrame, text_col: str = "text", out_col: str = "score") -> DataFrame:
        """``docs`` plus a score in [0, 1] for each whole text (null: empty)."""
        voters, weights, bias = self.voters, self.weights, self.bias
        rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (out_col, "_text")])
        names = rest.columns
        schema = rest.withColumn(out_col, F.lit(0.0)).schema

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, buf, offs in pieces(batches, "_text"):
                n = len(offs) - 1
                d, t = voters.features(*voters.hits(buf, offs)[:2], n)
                z = bias + np.bincount(d, weights=weights[t] if len(t) else None, minlength=n)
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([*[rows.column(i) for i in range(len(names))], pa.array(score)],
                                                 names=[*names, out_col])

        return _lower(rest, text_col).mapInArrow(judge, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score every document with a model fitted to labels of rows that are not held out.

    Returns the columns of ``docs`` plus held_out, score and predicted.  Null texts are
    empty; empty texts have no terms and get the score of the bias; rows with a null key
    are held out; repeated rows get equal scores; without usable labels every score is
    the share of toxic labels (0 for none); an empty table gives an empty result.
    Input columns called score, held_out, predicted or _text are replaced."""
    model = ToxicityModel.fit(docs, labels, settings)
    return model.score(docs).withColumn("held_out", held_out()).withColumn(
        "predicted", (F.col("score") >= settings.threshold).cast("int"))
