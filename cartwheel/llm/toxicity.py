"""Toxicity by weak supervision.

Terms whose presence speaks for toxicity (words and word beginnings) are
found on a bounded sample of labelled rows.  Together with a fixed lexicon
and patterns they make many *voters*, each voting toxic, clean or abstaining
on a whole text.  All training documents' vote patterns are counted; a
generative label model, fitted to the counts by expectation maximisation,
estimates every voter's accuracy, and the correlation of voters given the
label discounts those that repeat each other.  A linear classifier is then
trained on the posteriors of a bounded sample of all training documents,
labelled or not (a gold label is one more, strong voter), and scores every
document.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import fold_column, ship, table, text_column, tidy

#: Labelled rows (expected number) used to find terms; as many other training
#: rows fit the classifier with them.
SAMPLE = 12_000
#: How often a gold label is taken to be right when it votes on its row.
GOLD_ACCURACY = 0.999
#: Terms kept, least number of toxic rows with the term, least log odds.
TERMS, LEAST_ROWS, LEAST_ODDS = 3000, 3, 2.5
PREFIXES = (4, 5, 6)

INSULTS = frozenset("""idiot idiots moron morons stupid dumb scum trash loser losers clown clowns pathetic worthless
disgusting filth filthy vermin garbage imbecile jerk fool bastard bitch damn crap hate ugly shut kill""".split())
_WORD = re.compile(r"[^\W\d_]+")
_ADDRESSED = re.compile(r"\b(?:you|your|you're|u)\b[^.!?\n]{0,30}\b(?:" + "|".join(sorted(INSULTS)) + r")\b")
VOTERS = ("insult", "two insults", "addressed", "word, first half", "word, second half", "beginning, first half",
          "beginning, second half", "two signs", "dense", "no sign", "no insult")


def text_terms(text: str) -> tuple[set, int]:
    """Distinct words, word beginnings (marked by their length) and the
    number of words."""
    words = _WORD.findall(text.lower())
    distinct = set(words)
    return distinct, len(words)


def beginnings(words: set) -> set:
    return {f"{n}:{w[:n]}" for n in PREFIXES for w in words if len(w) > n}


class Terms:
    """The discovered terms: word -> number, marked beginning -> number."""

    def __init__(self, listed):
        self.number = {t: i for i, t in enumerate(listed)}
        self.words = frozenset(t for t in listed if ":" not in t)
        self.starts = tuple((n, frozenset(t[2:] for t in listed if t.startswith(f"{n}:"))) for n in PREFIXES)

    def found(self, words: set) -> tuple[set, set, int]:
        """Discovered words and marked beginnings of a text, and how many of
        its distinct words are or begin with one."""
        starts, plain = set(), words & self.words
        signs = set(plain)
        for n, known in self.starts:
            if known and (here := known.intersection([w[:n] for w in words if len(w) > n])):
                starts.update(f"{n}:{x}" for x in here)
                signs.update(w for w in words if len(w) > n and w[:n] in here)
        return plain, starts, len(signs)

    def features(self, text: str) -> tuple[str, list[int], list[float]]:
        """Votes (one sign per voter), numbers of the present terms, and
        dense features."""
        words, total = text_terms(text)
        plain, starts, stems = self.found(words)
        insults = words & INSULTS
        present = sorted(self.number[t] for t in plain | starts)
        addressed = bool(insults) and _ADDRESSED.search(text.lower()) is not None
        votes = (
            "+" if insults else "0",
            "+" if len(insults) > 1 else "0",
            "+" if addressed else "0",
            "+" if any(self.number[t] % 2 == 0 for t in plain) else "0",
            "+" if any(self.number[t] % 2 for t in plain) else "0",
            "+" if any(self.number[t] % 2 == 0 for t in starts) else "0",
            "+" if any(self.number[t] % 2 for t in starts) else "0",
            "+" if stems > 1 else "0",
            "+" if stems * 200 > total > 0 else "0",
            "0" if stems or not self.number else "-",
            "0" if insults else "-",
        )
        dense = [float(np.log1p(len(plain))), float(np.log1p(stems)), float(np.log1p(len(insults))),
                 float(min(1.0, 50.0 * stems / total)) if total else 0.0]
        return "".join(votes), present, dense


DENSE = 4


@tidy
def _term_rows(batches):
    """Rows with each term, by label, pre-counted per task."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            words, _ = text_terms(text.as_py())
            (toxic if label.as_py() else clean).update(words | beginnings(words))
    both = list(toxic.keys() | clean.keys())
    if both:
        yield pa.RecordBatch.from_arrays([pa.array(both), pa.array([toxic[t] for t in both]), pa.array([clean[t] for t in both])],
                                         names=["term", "toxic", "clean"])


def discover_terms(sample: DataFrame, toxic_rows: int, clean_rows: int) -> list[str]:
    odds = (F.log((F.col("toxic") + 0.5) / F.lit(toxic_rows + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean_rows + 1.0)))
    rows = (sample.select("text", "toxic_label").mapInArrow(_term_rows, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter((F.col("toxic") >= LEAST_ROWS) & (odds >= LEAST_ODDS))
            .orderBy(F.desc(odds * F.sqrt("toxic")), "term").limit(TERMS).select("term").collect())
    return [r[0] for r in rows]


def _votes(terms):
    @tidy
    def run(batches):
        known = Terms(terms.value)
        for batch in batches:
            votes = [known.features(t.as_py())[0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.string())], names=["doc_id", "votes"])
    return run


class LabelModel:
    """Accuracies and correlations of the voters, from counts of vote
    patterns with the gold label where there is one (else None).  Without any
    gold label nothing tells toxic texts from those that merely hold a word
    of the lexicon: the voters keep the accuracies they start with."""

    SIGNS = "+0-"

    def __init__(self, patterns, prior: float, rounds: int = 40):
        votes = np.array([[self.SIGNS.index(s) for s in p] for p, _, _ in patterns], dtype=np.int64).reshape(len(patterns), len(VOTERS))
        gold = np.array([-1 if g is None else int(g) for _, g, _ in patterns])
        n = np.array([c for _, _, c in patterns], dtype=np.float64)
        one_hot = np.eye(3)[votes]  # pattern, voter, vote
        self.prior = min(max(prior, 1e-4), 1 - 1e-4)
        # start: a toxic vote is twice as likely on toxic text
        self.table = np.tile(np.array([[[2.0, 1.0, 0.5]], [[0.5, 1.0, 2.0]]]) / 3.5, (1, len(VOTERS), 1))  # label, voter, vote
        self.weight = np.ones(len(VOTERS))
        for _ in range(rounds if (gold >= 0).any() else 0):
            q = self._posterior(votes)
            q = np.where(gold >= 0, gold, q)
            mass = np.stack([n * q, n * (1 - q)])
            self.prior = float(np.clip(mass[0].sum() / max(n.sum(), 1), 1e-4, 1 - 1e-4))
            counts = np.einsum("lp,pvs->lvs", mass, one_hot) + 0.05
            self.table = counts / counts.sum(2, keepdims=True)
            self.weight = self._discount(votes, mass)
        self.accuracy = dict(zip(VOTERS, (self.table[0, :, 0] / (self.table[0, :, 0] + self.table[1, :, 0])).round(4).tolist()))

    def _discount(self, votes, mass):
        """1 / (1 + correlations with the other voters given the label)."""
        score = 1.0 - votes
        total = np.zeros((len(VOTERS), len(VOTERS)))
        for m in mass:
            centred = score - (m @ score) / max(m.sum(), 1e-9)
            cov = (centred * m[:, None]).T @ centred / max(m.sum(), 1e-9)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            total += np.abs(cov / np.outer(sd, sd)) * (sd > 1e-4)[:, None] / 2
        self.correlation = total
        return 1 / (1 + np.maximum(total.sum(1) - np.diag(total), 0))

    def _posterior(self, votes, extra=0.0):
        ratio = np.log(self.table[0]) - np.log(self.table[1])  # voter, vote
        z = np.log(self.prior / (1 - self.prior)) + (self.weight * ratio[np.arange(len(VOTERS)), votes]).sum(1) + extra
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def posterior(self, patterns, gold) -> np.ndarray:
        """Of rows with these votes, and their gold labels or None."""
        sure = np.log(GOLD_ACCURACY / (1 - GOLD_ACCURACY))
        votes = np.array([[self.SIGNS.index(s) for s in p] for p in patterns], dtype=np.int64).reshape(len(patterns), len(VOTERS))
        return self._posterior(votes, np.array([0.0 if g is None else sure if g else -sure for g in gold]))


def fit_linear(rows, labels: np.ndarray, times: np.ndarray, n_terms: int, rounds: int = 400, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on present terms and dense features, by Adam on
    the whole sample, each row counted as often as it occurs and no class
    raised, so that scores keep to the posteriors; the last weight is the
    intercept."""
    size = n_terms + DENSE + 1
    if not rows:
        return np.zeros(size)
    at = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    term = np.array([t for p, _ in rows for t in p], dtype=np.int64)
    dense = np.array([d for _, d in rows], dtype=np.float64).reshape(len(rows), DENSE)
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    share = times / times.sum()
    for t in range(1, rounds + 1):
        z = np.bincount(at, weights=w[term], minlength=len(rows)) + dense @ w[n_terms:-1] + w[-1]
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * share
        g = np.concatenate((np.bincount(term, weights=r[at], minlength=n_terms), dense.T @ r, [r.sum()])) + decay * np.append(w[:-1], 0) / 10
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


class ToxicityModel:
    """Terms and linear weights; scores a text between 0 and 1."""

    def __init__(self, terms: list[str], weights: np.ndarray, label_model: LabelModel | None = None):
        self.terms, self.weights, self.label_model = terms, weights, label_model

    def scorer(self):
        known, w, n = Terms(self.terms), self.weights, len(self.terms)

        def score(text: str) -> float:
            _, present, dense = known.features(text)
            z = w[present].sum() + float(np.dot(w[n:-1], dense)) + w[-1]
            return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))
        return score


def fit(docs: DataFrame, labels: DataFrame, parts: int = 5, held_part: int = 0, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from the rows whose crc32(doc_id as text) modulo ``parts`` isn't
    ``held_part``; no label of another row is read into the model.

    Rows without a label count in the label model and train the classifier by
    their posteriors.  Null texts are empty; null labels and ids are no
    labels; an id with several labels is toxic if one of them says so.  With
    no labelled rows the voters are the fixed lexicon's, of assumed accuracy;
    with no rows at all two words of the lexicon make a text toxic.
    """
    spark = docs.sparkSession
    ship(spark)
    training = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).filter(
        fold_column("doc_id", parts) != held_part)
    gold = (labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
            .filter(fold_column("doc_id", parts) != held_part)
            .groupBy("doc_id").agg((F.max(F.col("toxic").cast("int")) == 1).alias("toxic_label")))
    n_gold = gold.count()
    steps = 1 << 30
    cut = int(steps * min(1.0, sample / max(n_gold, 1)))
    chosen = gold.filter(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < cut)
    # the chosen ids are distinct and about ``sample`` in number, whatever the size of the tables
    rows = table(training.join(F.broadcast(chosen), "doc_id").select("text", "toxic_label"), "toxic-sample")
    toxic_rows, all_rows = rows.agg(F.count(F.when(F.col("toxic_label"), 1)), F.count("*")).first()
    terms = discover_terms(rows, toxic_rows, all_rows - toxic_rows) if toxic_rows else []

    shared = spark.sparkContext.broadcast(terms)
    patterns = [(r["votes"], r["toxic_label"], r["n"]) for r in
                training.mapInArrow(_votes(shared), "doc_id long, votes string").join(gold, "doc_id", "left")
                .groupBy("votes", "toxic_label").agg(F.count("*").alias("n")).collect()]  # at most 3 * 2 ** voters rows
    model = LabelModel(patterns, prior=toxic_rows / all_rows if all_rows else 0.05)

    def features(batches):
        known = Terms(shared.value)
        for batch in batches:
            found = [known.features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(pa.int64())),
                                              pa.array([f[2] for f in found], pa.list_(pa.float64())), batch.column(1)],
                                             names=["votes", "present", "dense", "toxic_label"])

    known_ids = chosen.select(F.col("doc_id").alias("known_id"))
    n_rows = sum(n for _, _, n in patterns)
    drawn = (training.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(steps)) < int(steps * min(1.0, sample / max(n_rows, 1))))
             .join(F.broadcast(known_ids), F.col("doc_id") == F.col("known_id"), "left_anti")
             .join(gold, "doc_id", "left").select("text", "toxic_label"))
    columns = ["votes", "present", "dense", "toxic_label"]
    # rows alike are one, with their number: a repeated document is not collected once per row
    fitted = (rows.unionByName(drawn).mapInArrow(features, "votes string, present array<long>, dense array<double>, toxic_label boolean")
              .groupBy(*columns).agg(F.count("*").alias("n")).orderBy(*columns).collect())
    posterior = model.posterior([r["votes"] for r in fitted], [r["toxic_label"] for r in fitted])
    weights = fit_linear([(r["present"], r["dense"]) for r in fitted], posterior, np.array([r["n"] for r in fitted], dtype=np.float64), len(terms))
    if not fitted:  # fixed lexicon only
        weights[len(terms) + 2], weights[-1] = 4.0, -3.6
    return ToxicityModel(terms, weights, model)


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The columns of ``docs`` and toxicity: the score of every whole text.
    Null and empty texts are scored as empty; nothing but the text is used;
    a column named toxicity is replaced."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.terms, model.weights))
    docs = docs.drop("toxicity")

    @tidy
    def run(batches):
        score = ToxicityModel(*shared.value).scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([score(t.as_py() or "") for t in texts], pa.float64())],
                                             names=[*batch.schema.names, "toxicity"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, toxicity double")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), parts=5, held_part=0)
    return score_texts(docs, model).select(
        "doc_id", (fold_column("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
