"""Toxicity scores from a learned lexicon, misspellings and context.

Learning reads a bounded sample of labelled rows outside the held-out quarter.
Candidate terms are whole words and word beginnings that stand in toxic rows
almost only, after different words: copies of one toxic text repeat all its
words, but in one context. They are chosen greedily by the number of toxic rows
they explain that no term before explains, and for many contexts of their own.

The terms form a trie. It is intersected with Levenshtein automata of all words
at once: a state is a set of (trie node, edits so far), transitions are made
when they are first needed and kept, so each further word only walks the
finished automaton and leaves it at the first letter at which no term is
near. One edit (also a swap of neighbours) is allowed from ``ONE_EDIT`` letters,
two from ``TWO_EDITS``; word beginnings must match exactly.

Each hit is weighed in a window of words around it: between quotation marks it
is a mention. A logistic regression over direct, quoted and misspelled hits
gives the score.

Rows: a null or empty text has no hits and gets the score of such texts.
Repeated rows are scored each, rows without an id are never held out, other
columns are not read. Without toxic labels the score is the share of toxic rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import per_batch, rows_where, text_of

#: Labelled rows that are learned from at most.
SAMPLE_ROWS = 10_000
#: Toxic rows a new term must explain, and the share of toxic rows among those that hold it.
SUPPORT, SHARE = 4, 0.8
#: Contexts that make a term of their own accord, and contexts for each row that holds a term at least.
CONTEXTS, DIVERSITY = 8, 0.5
#: Letters of a word beginning at least.
STEM = 4
#: Log-odds from which a term's misspellings count.
SURE = 3.0
#: Letters from which one and two edits are allowed.
ONE_EDIT, TWO_EDITS = 5, 8
#: Words on each side that are searched for quotation marks.
WINDOW = 12
#: Fixed: quotation marks, and punctuation that is taken off a word.
OPEN, CLOSE = "\"“„«‚‘'", "\"”“»’'"
EDGES = " \t\n\r\x0b\x0c.,;:!?()[]{}<>\"“”„«»‚‘’'…*#$%&|~`_-–—/\\"
#: A prediction is 1 from this score.
THRESHOLD = 0.3


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of rows that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def plain(unit: str) -> str:
    return unit.strip(EDGES).lower()


def candidate_terms(text: str) -> dict[str, str]:
    """Words, and their beginnings marked by a star, with the word before the first place of each."""
    out: dict[str, str] = {}
    before = ""
    for unit in text.split():
        word = plain(unit)
        if len(word) >= 3 and word not in out:
            out[word] = before
            for i in range(STEM, min(len(word), 12) + 1):
                out.setdefault(word[:i] + "*", before)
        before = word
    return out


class NearLexicon:
    """The trie of the terms, intersected with Levenshtein automata as words come."""

    #: Transitions that are kept; more make it start anew.
    KEPT = 200_000

    def __init__(self, terms: dict[str, float]):
        self.strict = {t for t, weight in terms.items() if weight < SURE}
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.most = [0]
        for term in terms:
            word, node = term.rstrip("*"), 0
            edits = self.allowed(term)
            self.most[0] = max(self.most[0], edits)
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.whole.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits)
            (self.stem if term.endswith("*") else self.whole)[node] = term
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.sure: list[str | None] = []
        self.made = 0
        self.start = self.number(self.closed({(0, 0, "")}))

    def allowed(self, term: str) -> int:
        """Edits that a spelling may differ by."""
        if term.endswith("*") or term in self.strict:
            return 0
        return 2 if len(term) >= TWO_EDITS else 1 if len(term) >= ONE_EDIT else 0

    def closed(self, states: set[tuple[int, int, str]]) -> frozenset:
        """With letters of terms left out in the word."""
        todo, all_ = list(states), set(states)
        while todo:
            node, edits, due = todo.pop()
            if due:
                continue
            for child in self.children[node].values():
                new = (child, edits + 1, "")
                if edits + 1 <= self.most[child] and new not in all_:
                    all_.add(new)
                    todo.append(new)
        return frozenset(all_)

    def number(self, states: frozenset) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            ends = [(e, self.whole[n]) for n, e, due in states if not due and self.whole[n] and e <= self.allowed(self.whole[n])]
            self.found.append(min(ends)[::-1] if ends else None)
            stems = [self.stem[n] for n, e, due in states if not due and not e and self.stem[n]]
            self.sure.append(max(stems, key=len) if stems else None)
        return self.numbers[states]

    def step(self, state: int, c: str) -> int:
        """The state after one more letter, -1 if no term is near any more."""
        out: set[tuple[int, int, str]] = set()
        for node, edits, due in self.sets[state]:
            if due:
                if c == due:
                    out.add((node, edits, ""))
                continue
            for letter, child in self.children[node].items():
                if letter == c:
                    out.add((child, edits, ""))
                elif edits < self.most[child]:
                    out.add((child, edits + 1, ""))  # another letter
                    if c in self.children[child] and edits < self.most[self.children[child][c]]:
                        out.add((self.children[child][c], edits + 1, letter))  # two letters swapped
            if edits < self.most[node]:
                out.add((node, edits + 1, ""))  # one letter too many
        out = self.closed(out)
        to = self.number(out) if out else -1
        self.moves[state][c] = to
        self.made += 1
        return to

    def look(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance."""
        if self.made > self.KEPT:
            self.forget()
        state, stem = self.start, None
        for c in word:
            to = self.moves[state].get(c)
            state = self.step(state, c) if to is None else to
            if state < 0:
                return (stem, 0) if stem else None
            stem = self.sure[state] or stem
        whole = self.found[state]
        if whole and (not stem or whole[1] == 0):
            return whole
        return (stem, 0) if stem else None


def quoted(units: list[str], at: int) -> bool:
    """Quotation marks open before and close after the word, within the window."""
    before = next((u for u in reversed(units[max(0, at - WINDOW) : at + 1]) if u[0] in OPEN or (u[-1] in CLOSE and u is not units[at])), "")
    after = next((u for u in units[at : at + WINDOW + 1] if u.rstrip(".,;:!?")[-1:] in tuple(CLOSE) or (u[0] in OPEN and u is not units[at])), "")
    return bool(before and after and before[0] in OPEN and after.rstrip(".,;:!?")[-1:] in tuple(CLOSE))


@dataclass(frozen=True)
class Model:
    """Terms with their weights, and the coefficients over features()."""

    terms: dict[str, float]
    coefficients: tuple[float, ...]


N_FEATURES = 6


def features(hits: list[tuple[float, int, bool]], n_words: int) -> list[float]:
    """From (weight, edits, is quoted) of each hit."""
    direct = [w for w, e, q in hits if not q and not e]
    return [
        1.0,
        max(direct, default=0.0),
        math.log1p(len(direct)),
        max((w / e for w, e, q in hits if e and not q), default=0.0),
        max((w for w, e, q in hits if q), default=0.0),
        min(1.0, 20 * len(direct) / max(n_words, 1)),
    ]


def feature_rows(texts: list[str], near: NearLexicon, weights: dict[str, float]) -> np.ndarray:
    """The features of each text of a batch; each distinct word is looked up once."""
    cut = [t.split() for t in texts]
    known = {u: hit for u in set().union(*cut) if (hit := near.look(plain(u)))} if weights else {}
    out = []
    for units in cut:
        if known.keys().isdisjoint(units):
            out.append(features([], len(units)))
            continue
        at = [i for i, u in enumerate(units) if u in known]
        out.append(features([(weights[known[units[i]][0]], known[units[i]][1], quoted(units, i)) for i in at], len(units)))
    return np.array(out, float).reshape(len(texts), N_FEATURES)


def covers(stem: str, term: str) -> bool:
    """A chosen term says what the other would, or the other way round."""
    a, b = stem.rstrip("*"), term.rstrip("*")
    return b.startswith(a) or a.startswith(b)


def choose_terms(toxic: list[dict[str, str]], clean: Counter) -> dict[str, float]:
    """Terms of the toxic rows (term to word before) with their log-odds."""
    holds: dict[str, list[int]] = {}
    for i, terms in enumerate(toxic):
        for t in terms:
            holds.setdefault(t, []).append(i)
    contexts = {t: len({toxic[i][t] for i in at}) for t, at in holds.items() if len(at) >= SUPPORT and len(at) >= SHARE * (len(at) + clean[t])}
    contexts = {t: n for t, n in contexts.items() if n >= max(SUPPORT, DIVERSITY * len(holds[t]))}
    gain = {t: len(holds[t]) for t in contexts}
    explained = [False] * len(toxic)
    chosen: dict[str, float] = {}
    while gain:
        term = max(gain, key=lambda t: (gain[t], -clean[t], not t.endswith("*"), len(t), t))
        if gain[term] < SUPPORT:
            break
        chosen[term] = math.log((len(holds[term]) + 0.5) / (clean[term] + 0.5))
        for i in holds[term]:
            if not explained[i]:
                explained[i] = True
                for t in toxic[i]:
                    if t in gain:
                        gain[t] -= 1
        gain = {t: n for t, n in gain.items() if n >= SUPPORT and t != term}
    for term in sorted(contexts, key=lambda t: (-len(holds[t]), clean[t], t.endswith("*"), -len(t), t)):
        if contexts[term] >= CONTEXTS and not any(covers(c, term) for c in chosen):
            chosen[term] = math.log((len(holds[term]) + 0.5) / (clean[term] + 0.5))
    return chosen


#: Fixed: what the coefficients of rare features shrink to; a misspelling counts nearly as much as the term, a mention little.
PRIOR = np.array([0.0, 0.0, 0.0, 0.8, 0.2, 0.0])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, prior: np.ndarray = PRIOR) -> np.ndarray:
    """Logistic regression by Newton steps, shrunk to ``prior``; the intercept is not."""
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * max(1.0, len(y) / 1000))
    shrink[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * (w - prior))
        w += np.clip(change, -4, 4)
        if np.abs(change).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``sample_rows`` labelled rows, the first in a hashed order, none of them held out."""
    usable = labels.filter(~held_out(doc_id)).filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    sample = usable.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")).join(F.broadcast(sample), "id")

    def counted_terms(batch: pa.RecordBatch):
        toxic: Counter[tuple[str, str]] = Counter()
        clean: Counter[str] = Counter()
        for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            toxic.update(candidate_terms(t).items()) if y else clean.update(candidate_terms(t).keys())
        terms, words = [t for t, _ in toxic] + list(clean), [w for _, w in toxic] + [None] * len(clean)
        return [terms, words, [*toxic.values(), *[0] * len(clean)], [*[0] * len(toxic), *clean.values()]]

    # The word before is null in clean rows, so each other row of the first aggregate is a context.
    counted = (
        per_batch(rows.select("y", "text"), counted_terms, "term string, word string, n long, clean long")
        .groupBy("term", "word")
        .agg(F.sum("n").alias("n"), F.sum("clean").alias("clean"))
        .groupBy("term")
        .agg(F.sum("n").alias("n"), F.sum("clean").alias("clean"), F.count("word").alias("contexts"))
        .filter(f"n >= {SUPPORT} AND n >= {SHARE}D * (n + clean) AND contexts >= greatest({SUPPORT}, {DIVERSITY}D * n)")
    )
    clean = {r.term: r.clean for r in counted.collect()}
    candidates = frozenset(clean)

    def marked(batch: pa.RecordBatch):
        found = [[(t, w) for t, w in sorted(candidate_terms(x).items()) if t in candidates] for x in batch.column(1).to_pylist()]
        return [batch.column(0), [[t for t, _ in f] for f in found], [[w for _, w in f] for f in found]]

    held = per_batch(rows.filter("y = 1").select("id", "text"), marked, "id long, terms array<string>, words array<string>")
    toxic = [dict(zip(r.terms, r.words)) for r in held.orderBy("id").collect()]
    terms = choose_terms(toxic, Counter(clean))

    def featured(batch: pa.RecordBatch):
        x = feature_rows(batch.column(1).to_pylist(), NearLexicon(terms), terms)
        return [batch.column(0), x.tolist()]

    seen = per_batch(rows.select("y", "text"), featured, "y int, x array<double>").groupBy("y", "x").agg(F.count("*").alias("n")).collect()
    seen.sort(key=lambda r: (r.y, r.x))
    if not seen:
        return Model({}, (-30.0,) + (0.0,) * (N_FEATURES - 1))
    n = np.array([r.n for r in seen])
    x, y = np.repeat(np.array([r.x for r in seen]), n, axis=0), np.repeat(np.array([float(r.y) for r in seen]), n)
    return Model(terms, tuple(fit(x, y).tolist()))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``."""
    terms, coefficients = model.terms, np.array(model.coefficients)
    kept: list[NearLexicon] = []

    def run(batch: pa.RecordBatch):
        if not kept:
            kept.append(NearLexicon(terms))
        z = feature_rows(batch.column(1).to_pylist(), kept[0], terms) @ coefficients
        return [batch.column(0), 1 / (1 + np.exp(-np.clip(z, -30, 30)))]

    scored = per_batch(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")), run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.expr(f"CAST(score >= {THRESHOLD} AS INT)").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    terms, coefficients, place = model.terms, np.array(model.coefficients), docs.columns.index(text)
    kept: list[NearLexicon] = []

    def keep(batch: pa.RecordBatch):
        if not kept:
            kept.append(NearLexicon(terms))
        z = feature_rows([t or "" for t in batch.column(place).to_pylist()], kept[0], terms) @ coefficients
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))) < threshold

    return rows_where(docs, keep)
