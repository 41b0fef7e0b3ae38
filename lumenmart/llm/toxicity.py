"""Toxic documents by misspelling-tolerant lexicon hits, weighed in their context.

The lexicon is learned from labelled documents: words, and stems that many
different words begin with, that occur in toxic documents nearly alone. It is
a trie. A Levenshtein automaton runs over the trie and the word at once, so all
entries within the allowed edits are found in one pass over the word's letters;
the intersection is determinised lazily and most words leave it after two or
three letters. Each hit is looked at in a window of tokens: one between
quotation marks or next to a verb of saying counts as quotation, one beside
other hits as abuse. A logistic model on these sums gives the score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.quality import labelled_sample
from lumenmart.llm.segments import Memo

#: Labelled documents that the model is fitted on, at most.
MAX_LABELLED = 5000
#: An entry occurs in this share of the toxic sample and in this many documents at least, with this log-odds.
LEAST_SHARE, LEAST_DOCS, LEAST_ODDS = 0.02, 5, 3.0
#: Letters of the shortest stem and of the longest prefix looked at; a longer word is covered by its prefix.
STEM, LONGEST = 4, 12
#: Tokens on either side that belong to a hit's context.
WINDOW = 8
_QUOTES = re.compile("[\"“”„«»]")
#: Verbs of saying in the four languages of the tables.
SAYING = frozenset("said says quote quoted wrote called sagte sagt schrieb dit disait écrit dijo dice escribió".split())


class Lexicon:
    """Entries as a trie, searched through the product with a Levenshtein automaton."""

    def __init__(self, entries: list[tuple[str, bool]]):
        """entries: text, and whether any ending may follow."""
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, list[int]] = defaultdict(list)
        self.most = [0]  # edits that an entry below the node allows
        self.letters = {c for text, _ in entries for c in text}
        for number, (text, open_) in enumerate(entries):
            node, allowed = 0, self.allowed(text, open_)
            self.most[0] = max(self.most[0], allowed)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.ends[node].append(number)
        # A state: trie nodes with the fewest edits that lead to them, and the best open entry passed.
        start = self._state({0: 0}, None)
        self.states, self.numbers = [start], {start: 0}
        self.moves: list[dict[str, int]] = [{}]

    @staticmethod
    def allowed(text: str, open_: bool) -> int:
        """Edits within which a word counts as the entry misspelled."""
        n = len(text) - 2 * open_
        return 0 if n < 5 else 1 if n < 9 else 2

    def _state(self, nodes: dict[int, int], passed):
        work = list(nodes)
        while work:  # letters of the entry that the word leaves out
            node = work.pop()
            for child in self.children[node].values():
                if (e := nodes[node] + 1) <= self.most[child] and e < nodes.get(child, 99):
                    nodes[child] = e
                    work.append(child)
        for node, e in nodes.items():
            for number in self.ends.get(node, ()):
                text, open_ = self.entries[number]
                if open_ and e <= self.allowed(text, open_) and (passed is None or (e, number) < passed):
                    passed = (e, number)
        return frozenset(nodes.items()), passed

    def _move(self, at: int, c: str) -> int:
        nodes, passed = self.states[at]
        out: dict[int, int] = {}
        for node, e in nodes:
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.most[child] and cost < out.get(child, 99):
                    out[child] = cost
            if e + 1 <= self.most[node] and e + 1 < out.get(node, 99):  # a letter too many
                out[node] = e + 1
        state = self._state(out, passed)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.numbers[state]

    def find(self, word: str) -> tuple[int, int] | None:
        """Fewest edits and the entry within them, or None."""
        at = 0
        for c in word:
            key = c if c in self.letters else ""
            step = self.moves[at].get(key)
            if step is None:
                step = self.moves[at][key] = self._move(at, key)
            at = step
            if not self.states[at][0]:
                break
        nodes, best = self.states[at]
        for node, e in nodes:
            for number in self.ends.get(node, ()):
                if e <= self.allowed(*self.entries[number]) and (best is None or (e, number) < best):
                    best = (e, number)
        return best


_PARTS = re.compile(r"[^\W_]+")


@dataclass
class Model:
    entries: list[tuple[str, bool]]
    weights: dict[tuple[int, int], float] = field(default_factory=dict)  # (edits, entry) -> log odds
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(6))

    def __post_init__(self):
        self._ready()

    def __getstate__(self):
        return {"entries": self.entries, "weights": self.weights, "coefficients": self.coefficients}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._ready()

    def _ready(self) -> None:
        self.lexicon = Lexicon(self.entries)
        self.hit_of = Memo(self._hit, 100_000)

    def _hit(self, token: str):
        found = [h for part in _PARTS.findall(token.lower()) if (h := self.lexicon.find(part))]
        return min(found) if found else None

    def hits(self, text: str) -> list[tuple[int, int, bool, int]]:
        """Edits, entry, whether it is a quotation, and other hits in the window, for each token that hits."""
        tokens = text.split()
        hit_of = self.hit_of
        at = [i for i, t in enumerate(tokens) if hit_of[t] is not None]
        if not at:
            return []
        marks, out, read = 0, [], 0
        for k, i in enumerate(at):
            marks += sum(len(_QUOTES.findall(t)) for t in tokens[read:i])
            read = i
            before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
            inside = (marks + len(_QUOTES.findall(tokens[i][:1]))) % 2 == 1 and any(map(_QUOTES.search, [tokens[i][1:], *after]))
            said = any(t.strip(".,:;").lower() in SAYING for t in before)
            beside = sum(1 for j in (k - 1, k + 1) if 0 <= j < len(at) and abs(at[j] - i) <= WINDOW)
            out.append((*hit_of[tokens[i]], inside or said, beside))
        return out

    def inputs(self, hits: list[tuple[int, int, bool, int]]) -> list[float]:
        """Constant, weight of direct and of quoted hits, crowded hits, and different entries hit."""
        weigh = [(self.weights.get((e, number), 0.0), quoted, beside, number) for e, number, quoted, beside in hits]
        direct = sum(w for w, quoted, _, _ in weigh if not quoted)
        quoted = sum(w for w, q, _, _ in weigh if q)
        crowded = sum(w for w, q, beside, _ in weigh if beside and not q)
        kinds = len({n for w, q, _, n in weigh if w > 0 and not q})
        return [1.0, float(np.log1p(direct)), float(np.log1p(quoted)), float(np.log1p(crowded)), float(np.log1p(kinds)), float(direct > 0)]

    def score(self, text: str) -> float:
        z = float(np.dot(self.coefficients, self.inputs(self.hits(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """Entries from the word prefixes of the labelled documents."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    long = F.filter(words, lambda w: F.length(w) >= STEM)
    last = lambda w: F.least(F.length(w), F.lit(LONGEST))
    each = F.transform(long, lambda w: F.transform(F.sequence(F.lit(STEM), last(w)), lambda k: F.struct(F.substring(w, F.lit(1), k).alias("prefix"), (k == F.length(w)).alias("whole"))))
    found = sample.select("doc_id", "label", F.explode(F.flatten(each)).alias("p")).select("doc_id", "label", "p.*")
    per_doc = found.groupBy("doc_id", "label", "prefix").agg(F.max("whole").alias("whole"))
    totals = sample.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = totals.toxic, totals.n - totals.toxic
    counts = per_doc.groupBy("prefix").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("c"), F.sum((F.col("whole") & (F.col("label") == 1)).cast("int")).alias("whole")
    )
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    kept = counts.where((F.col("a") >= max(LEAST_DOCS, LEAST_SHARE * toxic)) & (odds >= min(LEAST_ODDS, np.log(clean + 1))))
    strong = {r.prefix: (r.a, r.whole) for r in kept.collect()}  # each in 2 % of the toxic sample at least
    entries: list[tuple[str, bool]] = []
    for prefix in sorted(strong, key=lambda p: (len(p), p)):
        a, whole = strong[prefix]
        if any(open_ and prefix.startswith(text) for text, open_ in entries):
            continue
        longer = [p for p in strong if len(p) == len(prefix) + 1 and p.startswith(prefix)]
        if any(strong[p][0] >= 0.9 * a for p in longer):
            continue  # it is the beginning of one longer entry
        entries.append((prefix, whole < 0.9 * a and len(prefix) <= LONGEST))
    return entries


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Newton steps with a ridge; the classes weigh alike."""
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    beta = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """Lexicon and weights from labelled documents. Without both labels among them every score is the same."""
    sample = labelled_sample(docs, labels, target, max_labelled).persist()
    model = Model(_lexicon(sample))

    @F.arrow_udf("array<struct<edits:int,entry:int,quoted:boolean,beside:int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("edits", pa.int32()), ("entry", pa.int32()), ("quoted", pa.bool_()), ("beside", pa.int32())]))
        for batch in batches:
            yield pa.array([[dict(zip(("edits", "entry", "quoted", "beside"), h, strict=True)) for h in model.hits(x.as_py() or "")] for x in batch], kind)

    rows = sample.select("doc_id", "label", found("text").alias("hits")).orderBy("doc_id").select("label", "hits").collect()
    sample.unpersist()
    y = np.array([r.label for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.0
        model.coefficients = np.array([3.0 if base else -3.0, 0, 0, 0, 0, 0])
        return model
    hits = [[tuple(h) for h in r.hits] for r in rows]
    toxic, clean = Counter(), Counter()
    for label, own in zip(y, hits, strict=True):
        (toxic if label else clean).update({(e, n) for e, n, _, _ in own})
    for key in toxic:
        odds = np.log((toxic[key] + 0.5) / (y.sum() + 1)) - np.log((clean[key] + 0.5) / (len(y) - y.sum() + 1))
        model.weights[key] = max(0.0, float(odds))
    # An edit of an entry that the sample doesn't show counts half as much as the entry for each edit.
    for number, (text, open_) in enumerate(model.entries):
        for e in range(1, Lexicon.allowed(text, open_) + 1):
            if (e, number) not in toxic and (e, number) not in clean:
                model.weights[e, number] = model.weights.get((0, number), 0.0) * 0.5**e
    model.coefficients = _logistic(np.array([model.inputs(h) for h in hits]), y)
    return model


def score(model: Model, text: Column) -> Column:
    """From 0 to 1, higher if toxic is likelier; nulls and empty texts score as texts without hits."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(x.as_py() or "") for x in batch], pa.float64())

    return of(text)


def with_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Adds ``score`` and ``predicted`` to every row, in place of columns of these names."""
    return docs.withColumn("score", score(model, F.col("text"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
