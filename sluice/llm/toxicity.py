"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read the word classes of one clause: negation and reported speech tag the words
in their reach, target guesses whether the clause is aimed at somebody and accepts if the guess
was right, insult and threat turn tagged words into weighted outcomes. They are composed once
into one machine. Its states step from word to word, so a clause's score is the weight of its
accepted path: insults that are plain, aimed, negated or reported, and threats. The insult and
threat classes are learned from labels as whole words and word beginnings; the weights of
the composed outcomes are learned on the same documents. Targets, negations, reports
and a first list of threats are closed classes of the four languages, listed below."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialize, pick, values

#: Labelled documents of each class (expected) from which the grammar is learned.
SAMPLE = 5000
#: Candidates for the insult class, documents that must show one, and toxic to clean odds.
CANDIDATES, SUPPORT, ODDS = 4000, 5, 30.0
#: A pattern that one of so many toxic documents shows is taken even if others explain them.
COMMON = 50
#: Letters of a word beginning that can stand for the word.
BEGINNINGS = (4, 5, 6, 7, 8)

# The closed word classes, in the four languages of the corpus.
TARGET = frozenset("you your yours yourself u ur he she they them him her his their "
                   "du dich dir dein deine ihr euch sie er tu toi ton ta vous votre il elle ils "
                   "tú ti tu tus usted ustedes él ella ellos".split())
NEGATION = frozenset("not no never none isn't aren't wasn't don't doesn't n't nicht kein keine nie niemals "
                     "ne pas jamais aucun aucune nunca ningún ninguna jamás".split())
REPORT = frozenset("said says say called calls wrote quoted reported sagte sagt schrieb nannte "
                   "dit disait écrit appelé dijo dice escribió llamó".split())
THREAT = frozenset("kill hurt murder destroy beat stab shoot töten umbringen schlagen "
                   "tuer frapper détruire matar golpear destruir".split())

_word = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
ENDS = ".!?;:\n"
_end = re.compile(f"[{ENDS}]")
#: Words before an insult within which a negation or a report reaches it.
REACH = 4


INSULT_CLASS, THREAT_CLASS, TARGET_CLASS, NEGATION_CLASS, REPORT_CLASS, OTHER_CLASS = range(6)


@dataclass
class Grammar:
    """Insult words and beginnings with their weights, the outcome weights, and threats like insults."""
    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREAT, 1.0))
    threat_starts: dict[str, float] = field(default_factory=dict)

    def insult(self, word: str) -> float:
        """Weight of a word as an insult; 0 if it is none."""
        return _weight(word, self.words, self.starts)

    def threat(self, word: str) -> float:
        return _weight(word, self.threats, self.threat_starts)

    def class_of(self, word: str) -> tuple[int, float]:
        """The class of a word and its weight in it."""
        if weight := self.insult(word):
            return INSULT_CLASS, weight
        if word in NEGATION:
            return NEGATION_CLASS, 0.0
        if word in REPORT:
            return REPORT_CLASS, 0.0
        if word in TARGET:
            return TARGET_CLASS, 0.0
        weight = self.threat(word)
        return (THREAT_CLASS, weight) if weight else (OTHER_CLASS, 0.0)


def _weight(word: str, words: dict[str, float], starts: dict[str, float]) -> float:
    best = words.get(word, 0.0)
    if starts:
        for n in BEGINNINGS:
            best = max(best, starts.get(word[:n], 0.0) if len(word) >= n else 0.0)
    return best


#: Outcomes of a clause: plain, aimed, negated, reported insults, and threats.
PLAIN, AIMED, NEGATED, REPORTED, THREATENED = range(5)
OUTCOMES = 5


@dataclass(frozen=True)
class Transducer:
    """Start states, final states, and the arc from a state by a symbol: (next state, output, weight).

    A symbol without an arc ends the path; a path counts if it ends in a final state. Weights
    multiply along composed arcs and add up along a path, by output."""
    starts: tuple[Hashable, ...]
    final: Callable[[Hashable], bool]
    arc: Callable[[Hashable, Hashable], tuple[Hashable, Hashable, float] | None]


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that reads what ``a`` reads and writes what ``b`` makes of the output of ``a``."""
    def arc(state, symbol):
        first = a.arc(state[0], symbol)
        second = first and b.arc(state[1], first[1])
        return second and ((first[0], second[0]), second[1], first[2] * second[2])

    return Transducer(tuple((x, y) for x in a.starts for y in b.starts),
                      lambda s: a.final(s[0]) and b.final(s[1]), arc)


def scope_transducer(word_class: int) -> Transducer:
    """Tags every symbol with whether a word of the class stands within REACH words before it."""
    def arc(since, symbol):
        since = min(since + 1, REACH + 1)
        return 0 if symbol[0] == word_class else since, (*symbol, since <= REACH), 1.0

    return Transducer((REACH + 1,), lambda _: True, arc)


def target_transducer() -> Transducer:
    """Tags every symbol with the guess that the clause has a target, before or after it.

    States: the guess, and whether a target was met; the path of the wrong guess doesn't end."""
    def arc(state, symbol):
        guess, met = state
        met = met or symbol[0] == TARGET_CLASS
        return None if met and not guess else ((guess, met), (*symbol, guess), 1.0)

    return Transducer(((True, False), (False, False)), lambda s: s[0] == s[1], arc)


def insult_transducer() -> Transducer:
    """Tagged insults become outcomes; other symbols stay."""
    def arc(state, symbol):
        kind, negated, reported, aimed = symbol
        if kind != INSULT_CLASS:
            return state, symbol, 1.0
        return state, REPORTED if reported else NEGATED if negated else AIMED if aimed else PLAIN, 1.0

    return Transducer((0,), lambda _: True, arc)


def threat_transducer() -> Transducer:
    """Threats at somebody, neither negated nor reported, become outcomes; other words nothing."""
    def arc(state, symbol):
        if isinstance(symbol, int):
            return state, symbol, 1.0
        return state, THREATENED if symbol == (THREAT_CLASS, False, False, True) else None, 1.0

    return Transducer((0,), lambda _: True, arc)


class Machine:
    """A transducer over word classes as tables: of each state by class the next state, output and weight."""

    def __init__(self, t: Transducer):
        number = {s: i for i, s in enumerate(t.starts)}
        self.starts = list(number.values())
        self.table: list[list[tuple[int, int | None, float] | None]] = []
        states = list(number)
        for state in states:  # grows while it is read
            row = []
            for kind in range(OTHER_CLASS + 1):
                arc = t.arc(state, (kind,))
                if arc and arc[0] not in number:
                    number[arc[0]] = len(states)
                    states.append(arc[0])
                row.append(arc and (number[arc[0]], arc[1], arc[2]))
            self.table.append(row)
        self.final = [t.final(s) for s in states]

    def run(self, classes: Iterable[tuple[int, float]]) -> list[float]:
        """The summed weights of the accepted path's outputs; all paths step side by side."""
        paths = [(s, [0.0] * OUTCOMES) for s in self.starts]
        for kind, weight in classes:
            alive = []
            for state, out in paths:
                arc = self.table[state][kind]
                if arc:
                    if arc[1] is not None:
                        out[arc[1]] += arc[2] * weight
                    alive.append((arc[0], out))
            paths = alive
        return next((out for state, out in paths if self.final[state]), [0.0] * OUTCOMES)


@cache
def grammar_machine() -> Machine:
    """The five transducers in one."""
    tags = compose(compose(scope_transducer(NEGATION_CLASS), scope_transducer(REPORT_CLASS)), target_transducer())
    return Machine(compose(compose(tags, insult_transducer()), threat_transducer()))


def transduce(words: Iterable[str], grammar: Grammar) -> list[float]:
    """One clause through the composed transducers: the weight of each outcome."""
    return grammar_machine().run(map(grammar.class_of, words))


class Scorer:
    """Finds the clauses that hold an insult or a threat and runs the grammar on them."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.finder = ahocorasick.Automaton()
        for w in {*grammar.words, *grammar.starts, *grammar.threats, *grammar.threat_starts}:
            self.finder.add_word(w, len(w))
        self.finder.make_automaton()

    def clauses(self, text: str) -> Iterator[Iterator[str]]:
        """The words, one by one, of every whole clause of the text in which a pattern begins a word."""
        text, done = text.lower(), 0
        if len(self.finder) == 0:
            return
        for last, size in self.finder.iter(text):
            first = last - size + 1
            if first < done or first and text[first - 1].isalpha():
                continue
            lo = done
            for end in ENDS:
                lo = max(lo, text.rfind(end, lo, first) + 1)
            stop = _end.search(text, last + 1)
            done = stop.start() if stop else len(text)
            yield (m.group() for m in _word.finditer(text, lo, done))

    def features(self, text: str | None) -> np.ndarray:
        """Per outcome: log of the weight over all clauses, and whether there is any."""
        total = np.zeros(OUTCOMES)
        for words in self.clauses(text or ""):
            total += transduce(words, self.grammar)
        return np.concatenate((np.log1p(total), total > 0))

    def score(self, text: str | None) -> float:
        if not self.grammar.weights:
            return 0.0
        z = self.grammar.weights[0] + float(self.features(text) @ np.array(self.grammar.weights[1:]))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _words_and_beginnings(words: set[str]) -> set[str]:
    return words | {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) >= n}


def patterns_of(text: str) -> set[str]:
    """The words of a text and their beginnings (marked by a star), and once more, marked by an at
    sign, those in clauses that have a target."""
    text = text.lower()
    aimed: set[str] = set()
    for clause in _end.split(text):
        words = set(_word.findall(clause))
        if words & TARGET:
            aimed |= words - TARGET
    return _words_and_beginnings(set(_word.findall(text))) | {"@" + p for p in _words_and_beginnings(aimed)}


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic: Counter[str] = Counter()
        clean: Counter[str] = Counter()
        for text, label in zip(values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            (toxic if label else clean).update(patterns_of(text))
        both = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(both, pa.string()), pa.array([toxic[p] for p in both], pa.int64()),
             pa.array([clean[p] for p in both], pa.int64())], names=["pattern", "toxic", "clean"])


def _akin(a: str, b: str) -> bool:
    """Whether one of two patterns begins the other, so that both name the same words."""
    a, b = a.strip("@*"), b.strip("@*")
    return a.startswith(b) or b.startswith(a)


def _cover(shown: list[set[str]], weight: dict[str, float], support: int, common: int) -> list[str]:
    """Patterns chosen one by one, each for the documents that none before it explains,
    then those shown by at least ``common`` documents whose words none names yet.

    What counts is documents times weight, so a purer pattern beats a wider one; among
    equals one that needs no target, then the whole word, then the longer beginning, then the one
    that sorts first."""
    def best(count: Counter[str]) -> str:
        return min(count, key=lambda p: (-count[p] * weight[p], p[0] == "@", p[-1] == "*", -len(p), p))

    left, chosen = [s for s in shown if s], []
    while left:
        count = Counter(p for s in left for p in s)
        p = best(count)
        if count[p] < support:
            break
        chosen.append(p)
        left = [s for s in left if p not in s]
    count = Counter(p for s in shown for p in s)
    count = Counter({p: n for p, n in count.items() if n >= common and not any(_akin(p, c) for c in chosen)})
    while count:
        chosen.append(best(count))
        count = Counter({p: n for p, n in count.items() if not _akin(p, chosen[-1])})
    return chosen


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Grammar:
    """A grammar from about ``sample`` labelled documents of each label (all, if there are fewer).

    Documents are drawn from ``labels`` by a hash of the id, so only the drawn texts
    move. Equal texts count once (toxic if any copy is); rows without a label, a
    text or a partner teach nothing; without documents of both labels the grammar is
    empty and scores 0. The driver gets counts of CANDIDATES patterns and a row of
    numbers per sampled document."""
    marks = pick(labels, doc_id=(id_col, "long"), label=(label_col, "int")).where("label in (0, 1)")
    size = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    if len(size) < 2:
        return Grammar()
    rate = F.when(F.col("label") == 1, F.lit(sample / size[1])).otherwise(F.lit(sample / size[0]))
    drawn = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20) < rate)
    drawn = materialize(drawn.groupBy("doc_id").agg(F.max("label").alias("label")), "drawn")
    if drawn.count() <= 4 * sample:  # the bound of the sample, twice over; else a shuffle
        drawn = F.broadcast(drawn)
    texts = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).where("text is not null")
    taken = materialize(texts.join(drawn, "doc_id").groupBy("text").agg(F.max("label").alias("label")),
                        "labelled-sample")
    n = {r["label"]: r["count"] for r in taken.groupBy("label").count().collect()}
    if len(n) < 2:
        return Grammar()
    support = max(SUPPORT, n[1] // 1000)
    odds = (F.col("toxic") + 0.5) / (n[1] + 1) / ((F.col("clean") + 0.5) / (n[0] + 1))
    counts = taken.mapInArrow(_partial_counts, "pattern string, toxic long, clean long").groupBy("pattern").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= support)
    best = counts.withColumn("odds", odds).where(F.col("odds") >= ODDS).orderBy(
        F.desc("toxic"), "pattern").limit(CANDIDATES).collect()
    weight = {r["pattern"]: math.log(r["odds"]) for r in best}

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(patterns_of(t) & weight.keys()) for t in values(batch.column(0))],
                          pa.list_(pa.string()))], names=["shown"])

    toxic = taken.where("label = 1").select("text").mapInArrow(shown, "shown array<string>").collect()
    chosen = _cover([set(r["shown"]) for r in toxic], weight, max(2, support // 2), max(support, n[1] // COMMON))
    # what is toxic only beside a target is a threat; the closed list's words count like the least of them
    kinds = {(at, star): {p.strip("@*"): weight[p] for p in chosen if (p[0] == "@", p[-1] == "*") == (at, star)}
             for at in (False, True) for star in (False, True)}
    grammar = Grammar(kinds[False, False], kinds[False, True],
                      threats=dict.fromkeys(THREAT, math.log(ODDS)) | kinds[True, False], threat_starts=kinds[True, True])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(grammar)
        for batch in batches:
            x = np.array([scorer.features(t) for t in values(batch.column(0))]).reshape(-1, 2 * OUTCOMES)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             names=["label", "x"])

    # equal rows of numbers are one row with a count, so the driver gets little
    points = taken.mapInArrow(measured, "label int, x array<double>").groupBy("label", "x").count().collect()
    x = np.array([[1.0, *r["x"]] for r in points])
    y = np.array([float(r["label"]) for r in points])
    # each class weighs the same; noise in labels keeps the weights finite, as does the decay
    c = np.array([r["count"] / n[r["label"]] / 2 for r in points])
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (c * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (c * (y - p)) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    grammar.weights = w.tolist()
    return grammar


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 if score >= 0.5), from the whole text.

    * null or empty text: the score of a text without matches; 0 if nothing was learned.
    * null id: returned with the null; repeated rows: as often as given.
    * empty table: no rows; other columns are ignored, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(grammar)
        for batch in batches:
            s = np.array([scorer.score(t) for t in values(batch.column(1))], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(
        run, "doc_id long, score double, predicted int")
