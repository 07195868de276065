"""Personal data: patterns with checks, and further spans chosen by boosted trees.

Generators with high recall propose spans, which may overlap: anything around an ``@`` or a spelled one, runs of digits with
separators, dotted quads. Each has features of its format and of the words around it. Trees learn from the examples of all
texts. Good ones are strict spans rewritten so that the strict patterns miss them, as people hide or vary them, each in its
own surroundings. Bad ones are the same with a broken checksum, range or domain, and proposals that are plainly something else.
What is neither is not learned from, so nothing that could be added is taught as wrong. A threshold for each kind, set on
held-out examples for a wanted precision, selects what is redacted beyond the strict matches. Strict matches always stay.

Texts are read once: a narrow table keeps the strict spans and the proposals of each row, and the model works on that. Equal examples are
counted, and so are those of equal bins; the trees are grown from sums over these counts.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import binary_array, map_arrow, query, small_batches, stored, table
from loglathe.llm.spans import Taken
from loglathe.llm.trees import Boosted, bins_of, threshold_of

KINDS = ("email", "ip", "card", "phone")
#: the part of the examples that calibrates, in hundredths, and the fewest examples to learn from
CALIBRATE, LEAST = 30, 20
PRECISION = 0.98
#: held-out examples are counted by logit in steps of this part of one
STEPS = 1024

# fixed patterns of the contract; runs are taken possessively, from where they begin
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# generators
_AT = re.compile(r"@|[\[({] ?at ?[\])}]", re.IGNORECASE)
_BEHIND_AT = re.compile(r" ?[A-Za-z0-9-]{1,64}(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{1,64}){1,8}", re.IGNORECASE)
_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
_NUMBER = re.compile(r"(?<![A-Za-z0-9])[+(]?[0-9][0-9 ().\-/]{4,40}[0-9](?![A-Za-z0-9])")
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?(?:\.|,|\[\.\]) ?[0-9]{1,3}){3}")
_HINTS = (
    ("mail", "write", "contact", "contac", "schreib"),
    ("call", "phone", "tel", "fax", "mobil", "ruf"),
    ("card", "visa", "pay", "credit", "karte", "carte", "tarjeta"),
    ("ip", "host", "server", "address", "adresse"),
)
AROUND = 30
_HINTS_OF = dict(zip(("email", "phone", "card", "ip"), _HINTS, strict=True))

# what is plainly no personal data
_SENTENCE = re.compile(r"(?<! )\. ")
_NAME_END = re.compile(r"[A-Za-z]{2,24}\Z")
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-./ ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./ ])[0-9]{1,2}\2(?:19|20)[0-9]{2}")
_THOUSANDS = re.compile(r"[0-9]{1,3}([ .])[0-9]{3}(?:\1[0-9]{3})*")
_LIST = re.compile("[0-9] ?, [0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the contract's patterns, by kind and then start."""
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        done = 0
        for m in _DOMAIN.finditer(text):
            at = m.start()
            begin = at
            while begin > done and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                out.append(("email", begin, m.end()))
                done = m.end()
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_small(x) for x in m.groups())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def proposals(text: str) -> list[tuple[str, int, int]]:
    """What may be personal data."""
    out: set[tuple[str, int, int]] = set()
    if "@" in text or "at" in text or "AT" in text or "At" in text:
        for m in _AT.finditer(text):
            right = _BEHIND_AT.match(text, m.end())
            left = _BEFORE_AT.search(text[max(0, m.start() - 66) : m.start()]) if right else None
            if left:
                begin = m.start() - len(left.group())
                out.add(("email", begin, right.end()))
                whole = _SENTENCE.search(right.group())  # a name may be the last word of its sentence
                short = _BEHIND_AT.fullmatch(text, m.end(), right.start() + whole.start()) if whole else None
                if short:
                    out.add(("email", begin, short.end()))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            if 7 <= n <= 15:
                out.add(("phone", m.start(), m.end()))
            if 12 <= n <= 19:
                out.add(("card", m.start(), m.end()))
        out.update(("ip", m.start(), m.end()) for m in _QUAD.finditer(text))
    return sorted(out)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span = text[start:end]
    digits = _digits(span)
    groups = re.findall("[0-9]+", span)
    before, behind = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    near = before.lower()
    edge = (before[-1:] or " "), (behind[:1] or " ")
    return [
        float(KINDS.index(kind)), len(span), len(digits), len(digits) / len(span), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), span.count(" "), span.count("."), span.count("-"), span.count("/") + span.count(","),
        float(span[:1] == "+"), float("(" in span and ")" in span), float("@" in span), float("[" in span or "{" in span),
        float(bool(digits) and luhn(digits)), float(all(_small(g) for g in groups)), len(set(digits)), float(digits[:1] or -1),
        float(edge[0].isalnum()), float(edge[1].isalnum()), float(edge[0] in "\"'=:"), float(edge[1] in "\"'"),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in behind), sum(not (c.isalnum() or c.isspace()) for c in before),
        *[float(any(h in near for h in hints)) for hints in _HINTS],
        float(bool(_NAME_END.search(span))), float(bool(_SENTENCE.search(span))), float(bool(_LIST.search(span))),
        float(bool(_DATE.fullmatch(span) or _THOUSANDS.fullmatch(span))),
    ]


def fails(kind: str, span: str) -> bool:
    """Has not the checksum, range or form of its kind."""
    digits = _digits(span)
    if kind == "email":
        return not _NAME_END.search(span) or bool(_SENTENCE.search(span))
    if kind == "ip":
        return max(int(g) for g in re.findall("[0-9]+", span)) > 255
    if kind == "card":
        return len(digits) < 13 or not luhn(digits)
    return len(digits) < 9 or bool(_DATE.fullmatch(span))


def ordinary(text: str, kind: str, start: int, end: int) -> bool:
    """A plain number, or a list of some, with no word of its kind before it."""
    span, near = text[start:end], text[max(0, start - AROUND) : start].lower()
    if kind in ("email", "card") or any(h in near for h in _HINTS_OF[kind]):
        return False
    if kind == "ip":
        groups = [int(g) for g in re.findall("[0-9]+", span)]
        return bool(_LIST.search(span)) or ("," in span and groups == sorted(groups))
    return span.isdigit() or bool(_THOUSANDS.fullmatch(span))


def _broken(kind: str, span: str, turn: int) -> str:
    """The span with a checksum, range or domain that is wrong."""
    if kind == "email":
        return f"{span[: span.rindex('.')]}.{turn % 90 + 1}"
    if kind == "ip":
        return f"{span[: span.rindex('.')]}.{256 + turn % 700}"
    if kind == "card":
        return span[:-1] + str((int(span[-1]) + 1 + turn % 9) % 10)
    at = [i for i, c in enumerate(span) if c.isdigit()][7 + turn % 2]
    return span[:at].rstrip(" ().-")


def _hidden(kind: str, span: str, turn: int) -> str:
    """The span as it may be written where the strict pattern of its kind misses it."""
    if kind == "email":
        local, _, domain = span.partition("@")
        at = (" [at] ", "[at]", " (at) ", "(at)", " {at} ", " @ ")[turn % 6]
        return local + at + domain.replace(".", (".", " [dot] ", "[dot]", " (dot) ", " . ")[turn // 6 % 5])
    if kind == "ip":
        sign = ("[.]", "[.]", ",", " . ")[turn % 4]
        return span.replace(".", sign, 1) if turn // 4 % 3 == 0 and sign == "[.]" else span.replace(".", sign)
    if kind == "card":
        digits = _digits(span)
        return ("." if turn % 2 else "/").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    bare = span.lstrip("+")
    return (bare, bare, re.sub("[ -]+", ".", bare), re.sub("[ .]+", "-", bare), re.sub("[-.]+", " ", bare))[turn % 5]


def examples(text: str, kind: str, start: int, end: int) -> list[tuple[int, list[float]]]:
    """Label and features of a strict span made unlike the strict pattern, and of the same one broken."""
    before, span, behind = text[max(0, start - AROUND) : start], text[start:end], text[end : end + AROUND]
    turn = zlib.crc32(span.encode("utf-8", "surrogatepass"))
    out = []
    for label, base in ((1, span), (0, _broken(kind, span, turn))):
        copy = _hidden(kind, base, turn)
        changed = before + copy + behind
        a, b = len(before), len(before) + len(copy)
        same = [(x, y) for k, x, y in proposals(changed) if k == kind and 5 * (min(b, y) - max(a, x)) >= 4 * (max(b, y) - min(a, x))]
        out += [(label, features(changed, kind, x, y)) for x, y in same if label == 0 or not fails(kind, changed[x:y])][:1]
    return out


_SPAN = "struct<kind: string, start: int, end: int>"
_PROPOSED = "struct<kind: string, start: int, end: int, x: array<double>>"
_TAUGHT = "struct<label: int, x: array<double>>"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, strict, proposed, taught`` for each row of ``docs``; proposals that meet a strict span or fail are left out."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        strict, proposed, taught = [], [], []
        for text in batch["text"].to_pylist():
            text = text or ""
            own = strict_spans(text)
            taken = Taken((a, b) for _, a, b in own)
            strict.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
            rows = []
            lessons = [{"label": label, "x": x} for span in own for label, x in examples(text, *span)]
            for kind, a, b in proposals(text):
                if taken.free(a, b):
                    x = features(text, kind, a, b)
                    wrong = fails(kind, text[a:b])
                    if not wrong:
                        rows.append({"kind": kind, "start": a, "end": b, "x": x})
                    if wrong or ordinary(text, kind, a, b):
                        lessons.append({"label": 0, "x": x})
            proposed.append(rows)
            taught.append(lessons)
        span = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
        wide = pa.list_(pa.float64())
        types = [[*span], [*span, ("x", wide)], [("label", pa.int32()), ("x", wide)]]
        columns = [pa.array(c, pa.list_(pa.struct(t))) for c, t in zip((strict, proposed, taught), types, strict=True)]
        return pa.record_batch([batch["doc_id"], *columns], names=["doc_id", "strict", "proposed", "taught"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return stored(map_arrow(rows, run, f"doc_id {kind}, strict array<{_SPAN}>, proposed array<{_PROPOSED}>, taught array<{_TAUGHT}>"), "spans")


def lessons_of(scanned: DataFrame) -> DataFrame:
    """``held, label, x, n``: all examples, equal ones counted, and whether they calibrate, by the hash of their document and place in it."""
    # the hash is made once a row, before its examples are dealt out
    rows = scanned.select("doc_id", F.xxhash64("strict").alias("row"), "taught").select("doc_id", "row", F.posexplode("taught").alias("place", "t"))
    held = F.pmod(F.xxhash64("doc_id", "row", "place"), F.lit(100)) < CALIBRATE
    rows = rows.select(held.alias("held"), "t.label", "t.x")
    return stored(rows.groupBy("held", "label", "x").agg(F.count(F.lit(1)).alias("n")), "lessons")


def fit(scanned: DataFrame) -> tuple[Boosted, dict[str, float]] | None:
    """Trees and a threshold for each kind from all examples."""
    lessons = lessons_of(scanned)
    learned = lessons.where("not held")
    total, good = learned.agg(F.sum("n"), F.sum(F.col("n") * F.col("label"))).first()
    everything = lessons.agg(F.sum("n")).first()[0]
    if (everything or 0) < LEAST or not 0 < (good or 0) < total:
        return None
    # a feature is a small number or a ratio of two, since proposals have bounds: its values are few
    counts = learned.select("n", F.posexplode("x").alias("at", "value")).groupBy("at", "value").agg(F.sum("n").alias("n")).orderBy("at", "value").toArrow()
    at, value, n = (counts[c].to_numpy() for c in ("at", "value", "n"))
    model = Boosted()
    model.prepare([(value[at == j], n[at == j]) for j in range(at.max() + 1)], good / total)
    rows = _in_bins(lessons, model)
    model.fit_rows(rows.where("not held"))
    return model, _thresholds(rows.where("held"), model)


def _in_bins(lessons: DataFrame, model: Boosted) -> DataFrame:
    """``held, kind, label, bins, n``: examples whose features fall into the same bins are alike to the trees."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array(batch["x"].to_pylist())
        bins = model.binned(x).astype(np.uint8)
        columns = [batch["held"], pa.array(x[:, 0].astype(np.int32)), batch["label"], binary_array([row.tobytes() for row in bins]), batch["n"]]
        return pa.record_batch(columns, names=["held", "kind", "label", "bins", "n"])

    alike = map_arrow(lessons, run, "held boolean, kind int, label int, bins binary, n long")
    return stored(alike.groupBy("held", "kind", "label", "bins").agg(F.sum("n").alias("n")), "lessons")


def _thresholds(held: DataFrame, model: Boosted) -> dict[str, float]:
    """The threshold of each kind from all held-out examples, counted in small steps of the logit."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        logit = model.logit(bins_of(batch["bins"].to_pylist(), len(model.edges)))
        columns = [batch["kind"], pa.array(np.floor(logit * STEPS).astype(np.int64)), pa.array(1 / (1 + np.exp(-logit))), batch["label"], batch["n"]]
        return pa.record_batch(columns, names=["kind", "step", "score", "label", "n"])

    scored = map_arrow(held, run, "kind int, step long, score double, label int, n long")
    n, score = F.col("n"), F.col("score")
    steps = scored.groupBy("kind", "step").agg(F.min(score).alias("low"), F.max(score).alias("high"), F.sum(n * F.col("label")).alias("good"), F.sum(n).alias("n")).toArrow()
    kind, *columns = (steps[c].to_numpy() for c in ("kind", "low", "high", "good", "n"))
    return {k: threshold_of(*(c[kind == i] for c in columns), PRECISION) for i, k in enumerate(KINDS)}


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for each row of ``docs`` (doc_id, text).

    Counts and digest are those of the strict spans; ``spans`` holds these and the added ones, which overlap none.  Null and
    empty texts have no span.  Without enough examples of both labels nothing is learned and nothing added.  Texts of any length are read whole,
    in time by their length.  Repeated rows give equal rows.  An empty table gives none.  Proposals have bounds: the part before an ``@`` and each
    label behind it 64 characters, a domain nine labels, a number 42.
    """
    scanned = scan(docs)
    learned = fit(scanned)
    scanned = scanned.drop("taught")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(len(KINDS) + 3)]
        for strict, proposed in zip(batch["strict"].to_pylist(), batch["proposed"].to_pylist(), strict=True):
            own = [(s["kind"], s["start"], s["end"]) for s in strict]
            added: list[tuple[str, int, int]] = []
            taken = Taken((a, b) for _, a, b in own)
            if learned and proposed:
                scores = learned[0].probability(np.array([p["x"] for p in proposed]))
                for i in np.argsort(-scores, kind="stable"):
                    p = proposed[i]
                    if scores[i] >= learned[1][p["kind"]] and taken.free(p["start"], p["end"]):
                        added.append((p["kind"], p["start"], p["end"]))
                        taken.add(p["start"], p["end"])
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
    return map_arrow(scanned, run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")


@query("op7_pii")
def op7(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
