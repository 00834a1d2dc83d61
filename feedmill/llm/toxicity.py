"""Toxicity by weak supervision.

Voters are of three kinds.  Lexicon voters are insults of four languages, pattern
voters are expressions over the raw text; both are fixed and know no label.  Mined
voters are words and word beginnings, found once or oftener, that mark toxic texts in
one part of a bounded sample of labelled training documents, chosen one after another
by the texts they newly cover: they add the words of a corpus that no list foresees.

A generative label model then treats the label of every sampled text as hidden and
sees votes only: every voter fires with a rate of its own in either class and given
one other voter, its strongest correlate, so accuracies and correlations are both
estimated (EM over a tree of voters, from the guess that a text with a vote is toxic); a text that
no voter marks has the vote of one more voter, for clean.  The posterior labels train a logistic classifier on the presence of lexicon words, mined
voters and further terms; that classifier scores every document.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.runtime import tidied

WORDS = re.compile(r"[^\W\d_]+")
STARTS = (3, 4, 5, 6, 7)
TRAIN_ROWS = 3000  # bound of the labelled sample that the driver fits on
MINE_PERCENT = 80  # share of the sample, by a hash of the words, whose labels choose voters
MAX_VOTERS = 48
LEAST_COVER = 2  # training texts that a voter must newly cover
MAX_TERMS = 192
MEMO = 1 << 16  # remembered words of a task
THRESHOLD = 0.7
#: Insults by language (fixed values).
LEXICON = {
    "en": ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "pathetic", "worthless", "disgusting", "trash", "scum", "loser", "losers", "clown", "clowns", "fool", "jerk",
           "bastard", "bitch", "shit", "bullshit", "fuck", "fucking", "asshole", "imbecile", "cretin", "retard", "vermin", "filth", "garbage", "coward"),
    "fr": ("idiot", "idiote", "imbécile", "crétin", "crétine", "abruti", "abrutie", "débile", "connard", "connasse", "salaud", "salope", "ordure", "merde", "minable", "pourriture",
           "racaille", "dégoûtant", "bouffon", "lâche"),
    "de": ("idiot", "idioten", "trottel", "dummkopf", "depp", "vollidiot", "arschloch", "scheiße", "scheisse", "drecksau", "abschaum", "versager", "miststück", "schlampe", "wichser",
           "blödmann", "schwachkopf", "ekelhaft", "erbärmlich", "feigling"),
    "es": ("idiota", "idiotas", "imbécil", "estúpido", "estúpida", "tonto", "tonta", "pendejo", "cabrón", "gilipollas", "mierda", "puta", "basura", "escoria", "asqueroso", "asquerosa",
           "payaso", "patético", "inútil", "cobarde"),
}
#: Expressions of abuse (fixed values).
PATTERNS = (
    r"(?i)\byou(?:'re| are)(?: all| just| such)?(?: an?)? (?:idiot|moron|stupid|pathetic|worthless|disgusting|scum|loser|clown|trash|fool)",
    r"(?i)\b(?:shut up|go to hell|drop dead|kill yourself|screw you)\b",
    r"(?i)\b(?:ta gueule|ferme[- ]la|va te faire|espèce d(?:e |'))",
    r"(?i)\b(?:halt die klappe|halt's maul|verpiss dich|du (?:bist )?(?:ein )?(?:idiot|trottel|depp))",
    r"(?i)\b(?:cállate|vete a la|eres un[a]? (?:idiota|imbécil|basura)|hijo de puta)",
    r"(?i)\b[a-z]{1,3}[*@#$%]{2,}[a-z]{0,4}\b",
)
_COMPILED = tuple(re.compile(p) for p in PATTERNS)


def terms_of(word: str) -> list[str]:
    """The word itself between spaces, and its beginnings after a space."""
    return [f" {word} "] + [f" {word[:m]}" for m in STARTS if m <= len(word)]


def words_of(text: str | None) -> Counter[str]:
    return Counter(map(sys.intern, WORDS.findall(text.lower()))) if text else Counter()


def levels(term: str, count: int) -> list[str]:
    """A term that occurs often marks a text at several levels: once, twice, three times or more."""
    return [term, f"{term}#2", f"{term}#3"][:count]


@dataclass
class Model:
    """Weights of terms; score is the logistic of their sum over the terms present."""

    bias: float
    weights: dict[str, float]
    voters: list[dict] = field(default_factory=list)

    def scorer(self):
        base = sorted({t.partition("#")[0] for t in self.weights})
        ids = {t: i for i, t in enumerate(base)}
        ladder = [[sum(self.weights.get(x, 0.0) for x in levels(t, n)) for n in range(4)] for t in base]
        memo: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            found: dict[int, int] = {}
            for w, n in words_of(text).items():
                hit = memo.get(w)
                if hit is None:
                    if len(memo) >= MEMO:
                        memo.clear()
                    hit = memo[w] = tuple({ids[t] for t in terms_of(w) if t in ids})
                for i in hit:
                    found[i] = found.get(i, 0) + n
            z = self.bias + sum(ladder[i][min(found[i], 3)] for i in sorted(found))
            return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

        return score


@dataclass
class Row:
    """What the driver keeps of a training text."""

    words: Counter[str]
    label: int
    patterns: tuple[int, ...] = ()


def row_of(text: str | None, label: int) -> Row:
    return Row(words_of(text), int(label), tuple(int(bool(p.search(text or ""))) for p in _COMPILED))


def _copies_apart(rows: Iterable[Row]) -> list[Row]:
    """One row for each group of near copies: texts that share their four least word hashes and label."""
    seen: dict[tuple, Row] = {}
    for r in rows:
        low = sorted(zlib.crc32(w.encode()) for w in r.words)[:4]
        seen.setdefault((r.label, *low), r)
    return list(seen.values())


def _mined_from(row: Row) -> bool:
    """Does the row's label choose voters; by its least word hash, the label apart."""
    return min((zlib.crc32(w.encode(), 1) for w in row.words), default=0) % 100 < MINE_PERCENT


def _gain(p: int, q: int, np_: int, nq: int) -> float:
    """Log-likelihood ratio of a term present in p of np_ toxic and q of nq clean texts."""
    total, out = np_ + nq, 0.0
    for seen, row, col in ((p, p + q, np_), (q, p + q, nq), (np_ - p, total - p - q, np_), (nq - q, total - p - q, nq)):
        if seen:
            out += 2 * seen * math.log(seen * total / (row * col))
    return out


def mine_terms(rows: list[Row], least_gain: float = 25.0, precision: float = 0.9) -> tuple[list[str], list[str]]:
    """(voters, further terms) that mark toxic texts."""
    toxic, clean = [r.words for r in rows if r.label], [r.words for r in rows if not r.label]
    per_word: dict[str, list[str]] = {}
    df: Counter[str] = Counter()
    sets: list[set[str]] = []
    for words in toxic:
        counts: Counter[str] = Counter()
        for w, n in words.items():
            if w not in per_word:
                per_word[w] = terms_of(w)
            for t in per_word[w]:
                counts[t] += n
        sets.append({x for t, n in counts.items() for x in levels(t, n)})
        df.update(sets[-1])
    known = {t for t, n in df.items() if n >= 3}
    sets = [terms & known for terms in sets]
    against: Counter[str] = Counter()
    hits: dict[str, list[str]] = {}
    for words in clean:
        counts = Counter()
        for w, n in words.items():
            if w not in hits:
                hits[w] = [t for t in terms_of(w) if t in known]
            for t in hits[w]:
                counts[t] += n
        against.update(x for t, n in counts.items() for x in levels(t, n))
    scored = {}
    for t in known:
        p, q = df[t], against[t]
        if p >= precision * (p + q) and (g := _gain(p, q, len(toxic), len(clean))) >= least_gain:
            scored[t] = g
    holders: dict[str, set[int]] = {t: set() for t in scored}
    for i, terms in enumerate(sets):
        for t in terms & scored.keys():
            holders[t].add(i)
    voters: list[str] = []
    open_, left = set(range(len(sets))), dict(holders)
    # of voters that cover as much a whole word is the plainest
    rank = lambda t: (len(left[t] & open_) * df[t] / (df[t] + 2 * against[t]), t[0] == " " == t[-1], scored[t], -len(t), t)
    while left and open_ and len(voters) < MAX_VOTERS:
        best = max(left, key=rank)
        gained = left.pop(best) & open_
        if len(gained) < LEAST_COVER:
            break
        voters.append(best)
        open_ -= gained
    # words that mark toxic texts by themselves vote as well, though others cover their texts
    for t in sorted((t for t in left if t[0] == " " == t[-1]), key=lambda t: (-scored[t], t))[: MAX_VOTERS - len(voters)]:
        voters.append(t)
        left.pop(t)
    return voters, sorted(left, key=lambda t: (-scored[t], t))[:MAX_TERMS]


def label_model(votes: np.ndarray, prior: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, list[dict]]:
    """Posterior of the hidden label for each row of 0/1 votes, and each voter's rates.

    ``prior`` is a first guess of the posteriors, made of votes alone; it sets the balance
    of the classes and half of the weight in every round, without which the classes may
    change places.  Voters form a tree by their correlation within the guessed classes; a
    voter's rate depends on class and parent's vote, and one that does not fire abstains.
    """
    n, m = votes.shape
    post = np.clip(prior, 0.02, 0.98)
    rest = votes - sum(
        (post if y else 1 - post)[:, None] * ((post if y else 1 - post) @ votes / max(1e-9, (post if y else 1 - post).sum()))[None, :] for y in (0, 1)
    )
    scale = np.sqrt((rest**2).sum(axis=0) + 1e-9)
    corr = np.abs(rest.T @ rest / scale[:, None] / scale[None, :])
    np.fill_diagonal(corr, -1)
    parent, reached = [-1] * m, [0]
    while len(reached) < m:  # maximum spanning tree
        out = [j for j in range(m) if j not in reached]
        sub = corr[np.ix_(reached, out)]
        a, b = np.unravel_index(int(sub.argmax()), sub.shape)
        parent[out[b]] = reached[a]
        reached.append(out[b])
    said = np.stack([votes[:, p] if p >= 0 else np.zeros(n) for p in parent], axis=1)
    base = votes.mean(axis=0)
    rates = np.zeros((2, 2, m))
    first, balance = post, post.mean()
    for _ in range(rounds):
        held = (post + first) / 2
        for y in (0, 1):
            w = (held if y else 1 - held)[:, None]
            alone = ((w * votes).sum(axis=0) + base) / (w.sum() + 1)
            for z in (0, 1):
                near = w * (said == z)
                rates[y, z] = ((near * votes).sum(axis=0) + 4 * alone) / (near.sum(axis=0) + 4)
        rates = np.clip(rates, 1e-4, 1 - 1e-4)
        odds = math.log(balance / (1 - balance))
        each = sum((said == z) * votes * np.log(rates[1, z] / rates[0, z]) for z in (0, 1))
        post = np.clip(1 / (1 + np.exp(-np.clip(odds + each.sum(axis=1), -30, 30))), 1e-4, 1 - 1e-4)
    shape = [
        {"fires_if_toxic": float((post * votes[:, j]).sum() / post.sum()), "fires_if_clean": float(((1 - post) * votes[:, j]).sum() / (1 - post).sum()),
         "parent": parent[j], "correlation": float(corr[j, parent[j]]) if parent[j] >= 0 else 0.0}
        for j in range(m)
    ]
    return post, shape


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> tuple[float, np.ndarray]:
    """Bias and weights by Newton's method on soft labels."""
    full = np.hstack([np.ones((len(x), 1)), x])
    beta, penalty = np.zeros(full.shape[1]), np.full(full.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ beta, -30, 30)))
        step = np.linalg.solve((full * (p * (1 - p) + 1e-6)[:, None]).T @ full + np.diag(penalty), full.T @ (y - p) - penalty * beta)
        beta += step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), beta[1:]


def fit(rows: Iterable[tuple[str | None, int]], posterior: bool = True) -> Model:
    """A model of (text, label) rows; without a toxic or a clean row it scores the base rate.

    ``posterior`` False trains the classifier on the labels themselves, for comparison.
    """
    own = _copies_apart(row_of(t, y) for t, y in rows)
    labels = np.array([r.label for r in own], float)
    if not len(own) or labels.min() == labels.max():
        rate = (labels.sum() + 0.5) / (len(own) + 10)
        return Model(math.log(rate / (1 - rate)), {})
    mined, more = mine_terms([r for r in own if _mined_from(r)])
    listed = sorted({f" {w} " for words in LEXICON.values() for w in words if any(w in r.words for r in own)})
    voters = [*listed, *(t for t in mined if t not in listed)]
    ids = {t: i for i, t in enumerate(dict.fromkeys([*voters, *more]))}
    x = np.zeros((len(own), len(ids)))
    memo: dict[str, list[str]] = {}
    base = {t.partition("#")[0] for t in ids}
    for r, row in enumerate(own):
        counts: Counter[str] = Counter()
        for w, n in row.words.items():
            if w not in memo:
                memo[w] = [t for t in terms_of(w) if t in base]
            for t in memo[w]:
                counts[t] += n
        x[r, [ids[y] for t, n in counts.items() for y in levels(t, n) if y in ids]] = 1
    said = np.array([r.patterns for r in own], float)
    names = [*voters, *(p for p, heard in zip(PATTERNS, said.any(axis=0)) if heard)]
    votes = np.hstack([x[:, : len(voters)], said[:, said.any(axis=0)]])
    silent = votes.sum(axis=1) == 0
    post, shape = label_model(np.hstack([votes, silent[:, None]]), np.where(silent, 0.02, 0.9))
    bias, weights = logistic(x, post if posterior else labels)
    return Model(bias, {t: float(w) for t, w in zip(ids, weights)}, [{"term": t, **s} for t, s in zip([*names, "(none of these)"], shape)])


def remainder(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents, none of which is held out.

    The sample is the labelled ids of least hash, so reruns agree; of repeated labels of
    a doc_id the larger holds, of repeated documents the text that sorts first, and labels
    that are null are no labels.
    """
    sample = (
        labels.filter("toxic is not null and doc_id is not null").filter(remainder(F.col("doc_id")) != 1)
        .groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    got = texts.join(F.broadcast(sample), F.col("_id") == sample.doc_id).groupBy("_id").agg(F.min("text").alias("text"), F.first("_toxic").alias("_toxic"))
    # one text at a time: only word counts stay on the driver
    return fit((r["text"], r["_toxic"]) for r in got.orderBy("_id").toLocalIterator())


def with_score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` and the score of its text, empty if null, in ``column``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = sent.value.scorer()
        for b in batches:
            yield pa.array([one(t.as_py()) for t in b], pa.float64())

    score = F.arrow_udf(tidied(run), "double")
    return docs.withColumn(column, score(F.col("text").cast("string")))


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text) -> doc_id, held_out, score, predicted.

    Null and empty texts score the bias alone.  A null doc_id is not held out.  Repeated
    rows each keep a row; other columns of either table are ignored.
    """
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels, rows), "score")
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic."""
    column = "_toxicity"
    while column in docs.columns:
        column += "_"
    return with_score(docs, train(docs, labels, rows), column).filter(F.col(column) < THRESHOLD).drop(column)
