"""Secrets in texts: patterns, and further strings whose format fits an inferred grammar of credentials.

All values that the patterns find are the labelled credentials: those of each kind become probabilistic automata
(``FormatAutomaton``), one for each layout that many of them share and one for the rest.  All ordinary strings, as often as they stand in texts, become chains of
characters.  Every run of the characters that credentials are made of is a candidate: what the automaton needs fewer bits for than the chains, by a
margin, is added.  The margin of a kind is set on strings that neither model was made from: few of the ordinary ones may reach it (some of them may be secrets
too), and if most of the kind's own values don't reach it either, nothing of that kind is added.

Texts are read twice, for the counts that models are made of and then for the scores. Tasks count; what the driver gets follows the number of pairs of characters and of
states, not that of texts or strings. A task remembers the scores of strings, since most strings are words that recur.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.automata import DEEPEST, FormatAutomaton
from loglathe.llm.common import map_arrow, query, small_batches, stored, table
from loglathe.llm.spans import Taken

KINDS = ("assign", "access", "hex")
#: the part of both kinds of strings that sets the margins, in hundredths, and the least margin in bits
HELD_OUT, LEAST_MARGIN = 30, 16.0
ORDINARY_ABOVE = 5e-3
DIGIT_BITS, REPEAT_BITS = 4.0, 2.0
#: scores of ordinary strings are counted in steps of this part of a bit, up to so many steps
STEPS, MOST_STEPS = 8, 1 << 15
#: so many values make a layout of their own, if they are so large a part of their kind's and no longer than a tree is deep
OWN_LAYOUT, LAYOUT_PART = 16, 0.01
#: strings whose scores a task remembers
KNOWN = 200_000

# fixed patterns of the contract
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HINTS = ("passw", "secret", "token", "api")
#: a candidate is as short as a labelled credential may be, and made of the same characters; marks at its end are the sentence's
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{5,}[A-Za-z0-9+/_=]")


def strict_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end and the credential, by start and then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.group()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    return ((m.start(), m.end(), m.group()) for m in _CANDIDATE.finditer(text))


class Ordinary:
    """Chains of characters: each depends on the one before, and what was never seen shares what is left.

    Numbers and repeats are ordinary whether seen or not: a digit behind a digit, and a character behind itself, never cost more than a few bits.
    """

    def __init__(self, pairs: dict[tuple[str, str], int]) -> None:
        ones: Counter = Counter()
        for (a, _), n in pairs.items():
            ones[a] += n
        # a pair seen once may be that of the very string in question, and costs as if unseen
        self.cost = {(a, b): -math.log2((n - 0.5) / (ones[a] + 33)) for (a, b), n in pairs.items()}
        self.unseen = {a: -math.log2(0.5 / (n + 33)) for a, n in ones.items()}
        usual = {**{(a, b): DIGIT_BITS for a in "0123456789" for b in "0123456789"}, **{(chr(c), chr(c)): REPEAT_BITS for c in range(33, 127)}}
        self.cost.update({p: min(bits, self.cost.get(p, bits)) for p, bits in usual.items()})

    def bits(self, s: str) -> float:
        cost, unseen = self.cost, self.unseen
        return sum(cost.get(p) or unseen.get(p[0], 6.0) for p in zip("^" + s, s + "$", strict=True))


@dataclass
class Grammar:
    automata: dict[tuple[str, int], FormatAutomaton]  # by kind and number of the layout
    ordinary: Ordinary
    margins: dict[tuple[str, int], float]

    def best(self, value: str) -> tuple[str, float] | None:
        """The kind that the value fits best beyond that kind's margin, and by how many bits it is better than ordinary."""
        plain, found = self.ordinary.bits(value), None
        for name, automaton in self.automata.items():
            margin = self.margins[name]
            if plain > margin:
                score = plain - automaton.bits(value, plain - margin)
                if score >= margin and (found is None or score > found[1]):
                    found = name[0], score
        return found


def pairs_of(strings: list[str]) -> np.ndarray:
    """How often each of 128 characters is behind each other; ``^`` begins a string and ``$`` ends it."""
    codes = np.frombuffer(f"^{'$^'.join(strings)}$".encode("ascii"), np.uint8).astype(np.int64) if strings else np.zeros(0, np.int64)
    pairs = np.bincount(codes[:-1] * 128 + codes[1:], minlength=128 * 128)
    pairs[ord("$") * 128 + ord("^")] = 0
    return pairs


def scan(docs: DataFrame) -> DataFrame:
    """``what, value, n`` over all rows: labelled values by kind, ``pair`` for pairs of characters in ordinary strings, and ``held``
    for the part of these strings that is held out, by the hash of their text and place."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        learned: list[str] = []
        for text in batch["text"].to_pylist():
            text = text or ""
            own = strict_spans(text)
            found.update((kind, value) for kind, _, _, value in own)
            places = [(start, value) for start, end, value in candidates(text)]
            if own:
                taken = Taken((s[1], s[2]) for s in own)
                places = [(start, value) for start, value in places if taken.free(start, start + len(value))]
            if places:
                spread = np.uint64(zlib.crc32(text.encode("utf-8", "surrogatepass")))
                at = (np.array([p[0] for p in places], np.uint64) + spread) * np.uint64(0x9E3779B97F4A7C15)
                held = (at >> np.uint64(40)) % np.uint64(100) < HELD_OUT
                strings = [p[1] for p in places]
                found.update(("held", v) for v in compress(strings, held))
                learned.extend(compress(strings, ~held))
        pairs = pairs_of(learned)
        found.update({("pair", chr(c // 128) + chr(c % 128)): int(pairs[c]) for c in np.flatnonzero(pairs).tolist()})
        columns = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(found.values(), pa.int64())]
        return pa.record_batch(columns, names=["what", "value", "n"])

    counted = map_arrow(docs.select("text"), run, "what string, value string, n long")
    return stored(counted.groupBy("what", "value").agg(F.sum("n").alias("n")), "secrets")


def labelled_values(scanned: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
    """``kind, layout, held, value``, each value once, and by kind the layouts that have a model of their own.

    A layout is a length with signs at certain places; ``""`` stands for all that have none of their own.
    """
    layout = F.when(F.length("value") <= DEEPEST, F.regexp_replace("value", "[A-Za-z0-9]", "x")).otherwise("")
    held = F.pmod(F.xxhash64("value"), F.lit(100)) < HELD_OUT
    values = scanned.where(F.col("what").isin(*KINDS)).select(F.col("what").alias("kind"), layout.alias("layout"), held.alias("held"), "value")
    values = stored(values, "labelled")
    totals = {r["kind"]: r["n"] for r in values.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = {}
    for kind, n in totals.items():
        shared = values.where((F.col("kind") == kind) & (F.col("layout") != "")).groupBy("layout").agg(F.count(F.lit(1)).alias("n"))
        # at most a hundred
        own = shared.where(F.col("n") >= max(OWN_LAYOUT, LAYOUT_PART * n)).collect()
        names[kind] = [r["layout"] for r in sorted(own, key=lambda r: (-r["n"], r["layout"]))]
    return values, names


def _models(values: DataFrame, names: dict[str, list[str]]) -> tuple[dict[tuple[str, int], FormatAutomaton], DataFrame]:
    """An automaton for each layout and what judges it, as ``kind, number, value``; a layout without values of one part uses the other."""
    number = {(k, name): i for k, layouts in names.items() for i, name in enumerate(layouts)}

    def of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], bool, str]]:
        for kind, layout, held, value in zip(*(batch[c].to_pylist() for c in ("kind", "layout", "held", "value")), strict=True):
            yield (kind, number.get((kind, layout), len(names[kind]))), held, value

    def parts(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = Counter((*key, held) for key, held, _ in of(batch))
        columns = [pa.array([k[i] for k in n], t) for i, t in enumerate([pa.string(), pa.int32(), pa.bool_()])]
        return pa.record_batch([*columns, pa.array(n.values(), pa.int64())], names=["kind", "number", "held", "n"])

    counts = map_arrow(values, parts, "kind string, number int, held boolean, n long").groupBy("kind", "number", "held").agg(F.sum("n").alias("n")).collect()
    there = {((r["kind"], r["number"]), r["held"]) for r in counts}
    models = {key: FormatAutomaton() for key in sorted({key for key, _ in there})}
    all_learn, all_judge = ({key: (key, part) not in there for key in models} for part in (False, True))
    while any(m.open for m in models.values()):
        growing = {key: m for key, m in models.items() if m.open}

        def count(batch: pa.RecordBatch, growing=growing) -> pa.RecordBatch:
            by: dict[tuple[str, int], list[str]] = {}
            for key, held, value in of(batch):
                if key in growing and (not held or all_learn[key]):
                    by.setdefault(key, []).append(value)
            rows = [(*key, *place, n) for key, learned in by.items() for place, n in growing[key].count(learned).items()]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            return pa.record_batch(columns, names=["kind", "number", "state", "place", "c", "n"])

        counted = map_arrow(values, count, "kind string, number int, state int, place int, c string, n long")
        sums: dict[tuple[str, int], Counter] = {key: Counter() for key in growing}
        for r in counted.groupBy("kind", "number", "state", "place", "c").agg(F.sum("n").alias("n")).toArrow().to_pylist():
            sums[r["kind"], r["number"]][r["state"], r["place"], r["c"]] = r["n"]
        for key, m in growing.items():
            m.grow(sums[key])
    for m in models.values():
        m.finish()

    def judges(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(*key, value) for key, held, value in of(batch) if held or all_judge[key]]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.string(), pa.int32(), pa.string()])]
        return pa.record_batch(columns, names=["kind", "number", "value"])

    return models, map_arrow(values, judges, "kind string, number int, value string")


def _margins(held: DataFrame, chains: Ordinary, models: dict[tuple[str, int], FormatAutomaton]) -> dict[tuple[str, int], float]:
    """One bit more than the score that few of all held-out ordinary strings are above; what is below the least margin needn't be told apart."""
    least = LEAST_MARGIN - 1

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for value, n in zip(batch["value"].to_pylist(), batch["n"].to_pylist(), strict=True):
            plain = chains.bits(value)
            if plain >= least:
                for key, model in models.items():
                    score = plain - model.bits(value, plain - least)
                    if score >= least:
                        rows.append((*key, min(MOST_STEPS, int(score * STEPS)), score, n))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
        return pa.record_batch(columns, names=["kind", "number", "step", "score", "n"])

    n = held.agg(F.sum("n")).first()[0] or 0
    above = max(0, n - 1) - math.floor((1 - ORDINARY_ABOVE) * max(0, n - 1))
    scored = map_arrow(held, run, "kind string, number int, step int, score double, n long")
    steps = scored.groupBy("kind", "number", "step").agg(F.max("score").alias("score"), F.sum("n").alias("n")).collect()
    margins, passed = dict.fromkeys(models, LEAST_MARGIN), Counter()
    for r in sorted(steps, key=lambda r: -r["step"]):
        key = r["kind"], r["number"]
        if passed[key] <= above < passed[key] + r["n"]:
            margins[key] = max(LEAST_MARGIN, r["score"] + 1)
        passed[key] += r["n"]
    return margins


def infer_grammar(scanned: DataFrame) -> Grammar:
    """Models from one part of all strings and margins from the other; a layout whose own values mostly stay below its margin is left out."""
    chains = Ordinary({(r["value"][0], r["value"][1]): r["n"] for r in scanned.where("what = 'pair'").orderBy("value").collect()})
    models, judges = _models(*labelled_values(scanned))
    if not models:
        return Grammar({}, chains, {})
    margins = _margins(scanned.where("what = 'held'").select("value", "n"), chains, models)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = list(zip(batch["kind"].to_pylist(), batch["number"].to_pylist(), strict=True))
        fits = [chains.bits(v) - models[k].bits(v) >= margins[k] for k, v in zip(keys, batch["value"].to_pylist(), strict=True)]
        return pa.record_batch([batch["kind"], batch["number"], pa.array(fits, pa.bool_())], names=["kind", "number", "fits"])

    judged = map_arrow(judges, run, "kind string, number int, fits boolean").groupBy("kind", "number").agg(F.avg(F.col("fits").cast("int")).alias("part")).collect()
    good = sorted((r["kind"], r["number"]) for r in judged if r["part"] >= 0.5)
    return Grammar({k: models[k] for k in good}, chains, {k: margins[k] for k in good})


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


class Scorer:
    """Added spans of a text by a grammar; scores of strings are remembered."""

    def __init__(self, grammar: Grammar) -> None:
        self.grammar, self.known = grammar, {}

    def kind(self, value: str) -> str | None:
        if value not in self.known:
            if len(self.known) >= KNOWN:
                self.known.clear()
            best = self.grammar.best(value)
            self.known[value] = best[0] if best else None
        return self.known[value]

    def added(self, text: str, own: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        if not self.grammar.automata:
            return []
        good = {v for v in set(_CANDIDATE.findall(text)) if self.kind(v)}
        if not good:
            return []
        taken = Taken((a, b) for _, a, b in own)
        return [(self.kind(v), a, b) for a, b, v in candidates(text) if v in good and taken.free(a, b)]


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added`` for each row of ``docs`` (doc_id, text).

    Counts and digest are those of the strict spans; ``spans`` holds these and the added ones, which overlap none.  Null and
    empty texts have no span.  Without labelled credentials there is no grammar and nothing is added.  Texts of any length are read whole, in
    time by their length.  Repeated rows give equal rows.  An empty table gives none.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    grammar = infer_grammar(scan(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(grammar)
        for batch in batches:
            if batch.num_rows:
                yield report(batch, scorer)

    def report(batch: pa.RecordBatch, scorer: Scorer) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(len(KINDS) + 3)]
        for text in batch["text"].to_pylist():
            own = [s[:3] for s in strict_spans(text or "")]
            added = scorer.added(text or "", own)
            for k, kind in enumerate(KINDS):
                columns[k].append(sum(s[0] == kind for s in own))
            columns[-3].append(hashlib.sha256(joined(own).encode()).hexdigest())
            columns[-2].append(joined(own + added))
            columns[-1].append(len(added))
        kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.record_batch([batch["doc_id"], *arrays], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")


@query("op8_secrets")
def op8(spark, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
