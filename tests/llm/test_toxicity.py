"""The pattern grammar: clauses by hand, learning, held-out accuracy, odd rows."""

import itertools
import random

from pyspark.sql import functions as F

from sluice.llm import toxicity as T

GRAMMAR = T.Grammar({"idiot": 2.0, "scum": 1.0}, {"lowe": 3.0}, [-3.0, *[4.0] * 2, *[0.5] * 3, *[1.0] * 5])


def _run(text):
    scorer = T.Scorer(GRAMMAR)
    out = [0.0] * T.OUTCOMES
    for words in scorer.clauses(text):
        out = [a + b for a, b in zip(out, T.transduce(words, GRAMMAR))]
    return out


def test_outcomes():
    assert _run("An idiot here.") == [2, 0, 0, 0, 0]
    assert _run("You are an IDIOT and scum!") == [0, 3, 0, 0, 0]
    assert _run("you are not an idiot") == [0, 0, 2, 0, 0]
    assert _run("He said idiot twice") == [0, 0, 0, 2, 0]
    assert _run("I will kill you") == [0, 0, 0, 0, 1]
    assert _run("I will kill time") == [0, 0, 0, 0, 0]
    assert _run("Ein Loweihr geht. Nicht. scum") == [4, 0, 0, 0, 0]
    assert _run("videlowe idiots' idiotic") == [0, 0, 0, 0, 0]
    assert _run("not. idiot") == [2, 0, 0, 0, 0]  # the negation is in another clause
    assert _run("x " * 5000 + "idiot " + "y " * 5000 + "scum") == [3, 0, 0, 0, 0]
    assert _run("") == _run("plain words") == [0] * 5


def test_targets_on_both_sides():
    assert _run("What an idiot you are") == [0, 2, 0, 0, 0]
    assert _run("an idiot like you") == [0, 2, 0, 0, 0]
    assert _run("not an idiot like you") == [0, 0, 2, 0, 0]
    assert _run("kill. you") == [0] * 5
    assert _run("he would never kill") == [0] * 5


def _by_definition(clause):
    """Outcomes of (class, weight) pairs, word by word, looking back and ahead in the list."""
    out = [0.0] * T.OUTCOMES
    kinds = [k for k, _ in clause]
    for i, (kind, weight) in enumerate(clause):
        near = kinds[max(0, i - T.REACH):i]
        negated, reported = T.NEGATION_CLASS in near, T.REPORT_CLASS in near
        aimed = T.TARGET_CLASS in kinds
        if kind == T.INSULT_CLASS:
            out[T.REPORTED if reported else T.NEGATED if negated else T.AIMED if aimed else T.PLAIN] += weight
        if kind == T.THREAT_CLASS and aimed and not negated and not reported:
            out[T.THREATENED] += weight
    return out


def _all_paths(parts, clause):
    """Every path through the five transducers one after the other, without composing them."""
    found = []
    for starts in itertools.product(*[t.starts for t in parts]):
        states, out = list(starts), [0.0] * T.OUTCOMES
        for kind, weight in clause:
            symbol = (kind,)
            for i, t in enumerate(parts):
                arc = t.arc(states[i], symbol)
                if arc is None:
                    break
                states[i], symbol, factor = arc
                weight *= factor
            else:
                if symbol is not None:
                    out[symbol] += weight
                continue
            break
        else:
            if all(t.final(s) for t, s in zip(parts, states)):
                found.append(out)
    return found


def test_composed_machine_is_every_path_of_its_parts():
    parts = [T.scope_transducer(T.NEGATION_CLASS), T.scope_transducer(T.REPORT_CLASS), T.target_transducer(),
             T.insult_transducer(), T.threat_transducer()]
    machine = T.grammar_machine()
    assert len(machine.table) > 50
    rng = random.Random(3)
    clauses = [c for n in range(5) for c in itertools.product(range(6), repeat=n)]
    clauses += [tuple(rng.choice([0, 1, 2, 3, 4, 5, 5, 5]) for _ in range(rng.randrange(5, 25))) for _ in range(1500)]
    for kinds in clauses:
        clause = [(k, 1.0 + i) for i, k in enumerate(kinds)]
        paths = _all_paths(parts, clause)
        assert len(paths) == 1
        assert machine.run(clause) == paths[0] == _by_definition(clause)


def test_threats_are_learned_as_words_beside_targets(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("arna", "elst", "impo", "oru")]

    def doc(toxic):
        t = [rng.choice(words) for _ in range(30)]
        t += ["grobble", "you"] if toxic else rng.choice([["grobble", "time"], ["you", "rest"], ["fine", "day"]])
        return " ".join(t) + ". " + " ".join(rng.choice(words) for _ in range(9))

    rows = [(i, doc(i % 4 == 0), int(i % 4 == 0)) for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    grammar = T.learn(frame, frame.where("doc_id % 5 != 0"))
    assert grammar.threat("grobble") > 0 and grammar.insult("grobble") == 0
    got = {r.doc_id: r.predicted for r in T.score(frame, grammar).collect()}
    assert all(got[i] == label for i, _, label in rows)


def test_long_clauses_are_read_whole():
    filler = "lantern " * 70  # 560 characters without the end of a clause
    assert _run("you " + filler + "kill") == [0, 0, 0, 0, 1]
    assert _run("kill " + filler + "you") == [0, 0, 0, 0, 1]
    assert _run("you. " + filler + "kill") == [0, 0, 0, 0, 0]  # the target is in another clause
    assert _run("you " + filler + "idiot " + filler + "scum") == [0, 3, 0, 0, 0]
    # wherever the pattern stands, the negation before the second one holds and no word is cut
    for n in range(380, 420):
        assert _run("idiot " + ("ab " * n)[:n].rstrip() + " not idiot") == [2, 0, 2, 0, 0]
        assert _run("xidiot" + " " * (n - 5) + "scum") == [1, 0, 0, 0, 0]


def test_cover_takes_what_explains_most():
    shown = [{"a", "w1"}] * 6 + [{"b", "w2"}] * 4 + [{"b"}] + [{"a", "b", "w3"}] * 3 + [{"w4"}] + [{"loser", "lose*"}] * 9
    weight = dict.fromkeys(["a", "b", "w1", "w2", "w3", "w4"], 1.0) | {"loser": 8.0, "lose*": 4.0}
    assert T._cover(shown, weight, 2, 99) == ["loser", "a", "b"]
    assert T._cover(shown, weight, 2, 4) == ["loser", "a", "b", "w1", "w2"]


def test_learns_and_generalises(spark):
    rng = random.Random(1)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("rna", "lst", "mpo")]

    def doc(toxic):
        t = [rng.choice(words) for _ in range(60)]
        for _ in range(toxic * rng.randrange(1, 4)):
            t[rng.randrange(60)] = rng.choice(["zork", "vexu" + rng.choice(words)])
        return " ".join(t)

    rows = [(i, doc(i % 4 == 0), int(i % 4 == 0)) for i in range(800)]
    rows += [(None, None, 1), (900, "zork", None), (901, "", 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, toxic int, SCORE string")
    grammar = T.learn(frame, frame.where("doc_id % 5 != 0 or doc_id is null"))
    assert set(grammar.words) == {"zork"} and set(grammar.starts) == {"vexu"}
    got = {r.doc_id: r for r in T.score(frame, grammar).collect()}
    assert all(got[i].predicted == label for i, _, label in rows[:800])
    assert got[900].predicted == 1 and got[901].predicted == 0 and got[None].predicted == 0
    assert all(0 <= r.score <= 1 for r in got.values())


def test_without_labels(spark):
    rows = spark.createDataFrame([(1, "a b", 0), (2, "c", None)], "doc_id long, text string, toxic int")
    grammar = T.learn(rows, rows)
    assert grammar == T.Grammar() and {r.score for r in T.score(rows, grammar).collect()} == {0.0}
    assert T.score(rows.where("false"), GRAMMAR).count() == 0
    assert T.learn(rows, rows.where("false")) == T.Grammar()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    grammar = T.learn(docs, labels.where(~held), sample=2000)
    got = T.score(docs.where(held), grammar).join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0] and n.get((1, 0), 0) <= 0.15 * n[1, 1]
