"""Operator 5: toxicity by weak supervision.

Many voters (words, word beginnings and patterns) vote on a text.  A generative
label model estimates each voter's rates by expectation-maximisation over
labelled and unlabelled texts and the correlation of voters given the class;
correlated voters share their weight.  A linear classifier is trained on the
posterior labels and scores every text.

Lexicon voters are fixed insults, and words and word beginnings that occur so
often in so many more toxic training texts that chance is ruled out; pattern
voters are fixed.

Cases: null and empty texts get the classifier's score of no votes; texts of any
length are scored whole; without labelled rows all scores are 0; a label other
than 0 or 1, or null, is ignored; several labels of one id count each; an empty
table gives an empty result; other columns are ignored.

Bounds: voters are chosen and models fitted on at most about ``TRAIN_ROWS``
labelled rows and as many unlabelled ones (hash samples); scores cover all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import CACHE_WORDS, crc32_mod, small_batches, spread_rows

TRAIN_ROWS = 8_000
VOTERS = 300
THRESHOLD = 0.7
#: false voters expected among the proposed ones, at most
FALSE_VOTERS = 0.02
#: weight of an unlabelled row in the label model, and the correlation from which voters share a vote
UNLABELLED, SAME = 0.2, 0.5
STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
#: beginnings of words that may become voters, by length, and how often one must occur for a vote
STEMS = (4, 5, 6, 7)
TIMES = (1, 2, 3, 5)
#: fixed pattern voters (name: pattern on the lower-cased text)
PATTERNS = {
    "you_are": r"\byou(?:'re| are) (?:an? |such )",
    "go_away": r"\b(?:go to hell|shut up|get lost|drop dead)\b",
    "masked": r"\b[a-z]+[*@#$]{2,}[a-z]+\b",
    "shout": r"!{3,}",
    "hate": r"\b(?:hate|kill|hurt) (?:you|them|him|her)\b",
}
#: fixed lexicon voters: common insults
LEXICON = """
    idiot idiots moron morons imbecile stupid dumb fool loser losers clown scum trash garbage filth pathetic worthless
    disgusting vermin parasite bastard bitch whore slut asshole dumbass jerk creep pig freak degenerate subhuman
    idiota imbécil estúpido estúpida basura escoria asqueroso asquerosa payaso inútil patético patética
    crétin imbécile stupide ordure déchet minable dégoûtant dégoûtante connard salaud salope
    dummkopf abschaum versager widerlich erbärmlich wertlos arschloch drecksau trottel
""".split()
_PATTERNS = {k: re.compile(v) for k, v in PATTERNS.items()}


def features_of(word: str) -> tuple[str, ...]:
    """What may be counted of a raw word: the word and its beginnings."""
    w = word.strip(STRIP)
    return (f"w:{w}", *(f"s:{w[:k]}" for k in STEMS if len(w) > k)) if w else ()


def candidates(text: str) -> list[str]:
    """Candidate voters ``feature#times`` that fire on a whole text."""
    c = Counter()
    for w, n in Counter(text.lower().split()).items():
        for f in features_of(w):
            c[f] += n
    return [f"{f}#{k}" for f, n in c.items() for k in TIMES if n >= k]


def patterns_of(text: str) -> list[str]:
    return [f"p:{k}" for k, p in _PATTERNS.items() if p.search(text)]


@dataclass
class LabelModel:
    """P(vote | class) of every voter, pairwise correlation given the class, and the share each voter's vote weighs."""

    prior: float = 0.0
    rates: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    correlation: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on = np.log(self.rates[1]) - np.log(self.rates[0])
        off = np.log1p(-self.rates[1]) - np.log1p(-self.rates[0])
        logit = math.log(self.prior / (1 - self.prior)) + votes @ (self.weight * (on - off)) + (self.weight * off).sum()
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit_label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 12) -> tuple[LabelModel, np.ndarray]:
    """``votes`` (rows x voters, 0/1); ``labels`` 0, 1 or -1 (unknown).

    Known labels stay fixed; the rest follow the model's posterior (the second result)."""
    known = labels >= 0
    base = (labels[known] == 1).mean() if known.any() else 0.0
    trust = np.where(known, 1.0, UNLABELLED)
    q = np.where(known, labels == 1, base).astype(float)
    model = LabelModel(weight=np.ones(votes.shape[1]))
    for step in range(rounds):
        w1, w0 = q * trust, (1 - q) * trust
        model.prior = float(np.clip(base if step == 0 else w1.sum() / trust.sum(), 1e-4, 1 - 1e-4))
        model.rates = np.clip(np.stack([(w0 @ votes + 0.02) / (w0.sum() + 1), (w1 @ votes + 0.02) / (w1.sum() + 0.1)]), 1e-5, 1 - 1e-3)
        if step in (0, rounds // 2):
            # correlation of votes given the class: residuals around each row's expected vote
            z = votes - np.outer(q, model.rates[1]) - np.outer(1 - q, model.rates[0])
            sd = np.sqrt((z * z).mean(axis=0)) + 1e-9
            model.correlation = np.clip((z.T @ z) / len(z) / np.outer(sd, sd), -1, 1)
            model.weight = 1 / np.maximum(1, np.where(model.correlation > SAME, model.correlation, 0).sum(axis=1))
        post = model.posterior(votes)
        q = np.where(known, labels == 1, post)
    return model, q


@dataclass
class Classifier:
    voters: dict[str, int]
    weights: np.ndarray
    bias: float
    label_model: LabelModel
    empty: bool = False

    def score(self, on: list[int]) -> float:
        if self.empty:
            return 0.0
        z = self.bias + self.weights[on].sum() + self.weights[-1] * math.log1p(len(on))
        return 1 / (1 + math.exp(-min(50, max(-50, z))))


def fit_linear(votes: np.ndarray, target: np.ndarray, rounds: int = 25, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by damped Newton steps (the last weight: log of the number of votes)."""
    x = np.hstack([votes, np.log1p(votes.sum(axis=1, keepdims=True)), np.ones((len(votes), 1))]).astype(float)
    w = np.zeros(x.shape[1])
    w[-1] = math.log(np.clip(target.mean(), 1e-4, 0.5))
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * h[:, None]).T @ x + np.diag(penalty), x.T @ (p - target) + penalty * w)
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(x @ step).max()))
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


def propose_voters(train: DataFrame, limit: int = VOTERS) -> list[str]:
    """Words and word beginnings of labelled texts, by log odds against the other class."""
    def counter(only):
        def count(batches):
            for b in batches:
                c = Counter()
                for text in b["text"]:
                    c.update(f for f in candidates(text) if only is None or f in only)
                yield pd.DataFrame(c.items(), columns=["f", "n"])
        return count

    def counts(rows, only=None):
        return (rows.select("text").mapInPandas(counter(only), "f string, n long")
                    .groupBy("f").agg(F.sum("n").alias("n")))

    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1):
        return []
    pos, neg = n[1], n.get(0, 0)
    # both tables are bounded by the sample of labelled rows
    hits = {r["f"]: r["n"] for r in counts(train.filter("toxic = 1")).filter("n >= 2").collect()}
    misses = {r["f"]: r["n"] for r in counts(train.filter("toxic = 0"), set(hits)).collect()}
    base, floor = pos / (pos + neg), math.log(max(2, len(hits)) / FALSE_VOTERS)

    def surprise(f):
        """Exponent of the Chernoff bound on so many toxic rows among those that hold the feature."""
        n = hits[f] + misses.get(f, 0)
        share = hits[f] / n
        rest = (1 - share) * math.log((1 - share) / (1 - base)) if 0 < share < 1 and base < 1 else 0.0
        return n * (share * math.log(share / base) + rest) if share > base else 0.0

    found = {f: x for f in hits if (x := surprise(f)) >= floor}
    return sorted(found, key=lambda f: (-found[f], f))[:limit]


def rules_of(voters: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """feature -> [(times, number of the voter)]."""
    out: dict[str, list[tuple[int, int]]] = {}
    for v, k in voters.items():
        f, _, n = v.rpartition("#")
        out.setdefault(f, []).append((int(n), k))
    return out


def fired(text: str | None, rules: dict[str, list[tuple[int, int]]], cache: dict[str, tuple]) -> list[int]:
    """Numbers of the voters that fire on a whole text."""
    text = (text or "").lower()
    count: dict[str, int] = {}
    for w, n in Counter(text.split()).items():
        hit = cache.get(w)
        if hit is None:
            hit = cache[w] = tuple(f for f in features_of(w) if f in rules)
        for f in hit:
            count[f] = count.get(f, 0) + n
    for f in patterns_of(text):
        count[f] = 1
    return sorted(k for f, n in count.items() if f in rules for times, k in rules[f] if n >= times)


def vote_rows(df: DataFrame, voters: dict[str, int], out: str = "votes") -> DataFrame:
    """All columns, with an array<int> column ``out`` instead of the text: numbers of the voters that fire on it."""
    keep = [c for c in df.columns if c != "text"]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != "text") + f", {out} array<int>"
    rules = rules_of(voters)

    def run(batches):
        cache: dict[str, tuple] = {}
        for b in batches:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            yield b[keep].assign(**{out: [fired(t, rules, cache) for t in b["text"]]})

    return df.mapInPandas(run, schema)


def _sample(df: DataFrame, n: int, salt: str, total: int | None = None) -> DataFrame:
    total = df.count() if total is None else total
    share = min(1.0, n / max(1, total))
    return df.filter(F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) -> classifier."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    labels = _sample(labels, rows, "labels")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # the sampled labels are bounded by ``rows``, so they may be broadcast
    train = docs.join(F.broadcast(labels), "doc_id")
    names = propose_voters(train)
    voters = {f: k for k, f in enumerate(dict.fromkeys([*names, *(f"w:{w}#1" for w in LEXICON), *(f"p:{k}#1" for k in PATTERNS)]))}
    if not train.filter("toxic = 1").limit(1).count():
        return Classifier(voters, np.zeros(len(voters) + 1), 0.0, LabelModel(), empty=True)
    others = _sample(docs, rows, "others", docs.count())
    known = vote_rows(train, voters).select("toxic", "votes").toPandas()
    unknown = vote_rows(others, voters).select("votes").toPandas()
    y = np.concatenate([known["toxic"].to_numpy(int), np.full(len(unknown), -1)])
    votes = np.zeros((len(y), len(voters)), np.float32)
    for r, on in enumerate([*known["votes"], *unknown["votes"]]):
        votes[r, on] = 1
    model, posterior = fit_label_model(votes, y)
    w, b = fit_linear(votes, posterior)
    return Classifier(voters, w, b, model)


def score(df: DataFrame, classifier: Classifier, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every whole text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = spread_rows(rows).withColumn("score", score_of(F.col("text"), classifier, df.sparkSession))
    return out.select("doc_id", "score", (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))


def score_of(text: Column, classifier: Classifier, spark: SparkSession) -> Column:
    """Score of a whole text as a column expression; other columns stay as they are."""
    shared = spark.sparkContext.broadcast(classifier)  # a few hundred voters
    rules = rules_of(classifier.voters)
    cache: dict[str, tuple] = {}

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        c = shared.value
        if len(cache) > CACHE_WORDS:
            cache.clear()
        return pd.Series([c.score(fired(t, rules, cache)) for t in texts], dtype=float)

    return of(text)


def learn(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Classifier:
    """From the label rows that the contract allows."""
    labels = table(spark, sf_dir, "labels").filter(crc32_mod("doc_id", 3) != 1)
    return fit(docs, labels)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    classifier = learn(spark, docs, sf_dir)
    return score(docs, classifier).withColumn("held_out", crc32_mod("doc_id", 3) == 1).select("doc_id", "held_out", "score", "predicted")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose text is predicted toxic go; the columns stay."""
    small_batches(spark)
    classifier = learn(spark, docs, sf_dir)
    return spread_rows(docs).filter(score_of(F.col("text"), classifier, spark) < F.lit(THRESHOLD))
