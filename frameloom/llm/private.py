"""Personal information in free text: found, typed and replaced.

Method: candidate gradient boosting. High-recall generators propose spans that
may overlap (several readings of one run of digits, name pairs at every
capital); boosted trees, one model per kind, judge each candidate by its
format and its context; the kinds' calibrated thresholds select spans, and of
overlapping ones the longest, then the likelier, stays.

The trees come from private_train.py, fitted on a bounded sample of documents
with labels given by patterns; the model is the text file beside this module.

Defined results: null and empty texts have no finding and stay as they are; a
found text is the text as written with each run of white space as one space;
all of a text but the selected spans is kept unchanged.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.boosting import Boosted

KINDS = ("email", "phone", "id_number", "address", "person")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[NAME]"}
MODEL = Path(__file__).with_name("private_model.json")

#: Words that announce a kind of number, or another use of numbers.
PHONE_CUES = frozenset("phone phones tel telephone telefon téléphone teléfono telefono call ring text mobile cell fax llame llamar appelez appeler anrufen ruf rufnummer handy desk hotline whatsapp sms dial contact answers ph mob".split())
ID_CUES = frozenset("security ssn soc social passport passeport pasaporte reisepass citizen national nat licence license driving driver drivers personalausweis ausweis dni nie sozialversicherungsnummer identity identification id permis".split())
OTHER_CUES = frozenset("version build seed checksum chunk chunks frame frames job shard commit asset tag steps step size fps guidance take segment run model between and batch ticket order invoice isbn hash epoch seconds ms prise toma aufnahme".split())
TITLES = frozenset("dr mr mrs ms prof herr frau señor señora sr sra monsieur madame mme sir".split())
BEFORE_NAME = frozenset("by asked thanks to is signed reviewer contact credit credits from with author annotator caption thank name owner photographer actor dear cc and —".split())
AFTER_NAME = frozenset("lives approved signed annotator and for about wrote said owns has asked called will is was".split())
NO_NAME = frozenset("the a an in on at of and or for with after before between behind inside seen set version build seed frames chunk job shard segment two close take scene call text phone contact thanks we our return send ship please release attached address anschrift plano primer gros plan plans der die das ein eine un una le la les el los las monday tuesday wednesday thursday friday saturday sunday road street lane way court terrace close avenue rue calle flat apt generate describe keep how expected ping asset checksum if then not no by to from telefon llame it my".split())

_AT = re.compile(r"@|＠|[(\[{<]\s?(?:at|@)\s?[)\]}>]| at (?=[\w-]+ (?:dot|punkt|punto|point) )", re.I)
_LOCAL = re.compile(r"[\w.+%'-]*\w\s?$")
_DOT = r"(?:\.|\s?[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s?| (?:dot|punkt|punto|point) )"
_DOMAIN = re.compile(rf"\s?[^\W_](?:[\w-]*[^\W_])?(?:{_DOT}[^\W_](?:[\w-]*[^\W_])?)+", re.I)
_NUMBER = re.compile(r"(?<![\w.@#])(?<!\d[/-])(?:([A-Z]{1,2})\s?(?=\d{3}))?[+(]{0,2}\d+(?:(?:\)\s?|\s?[(/]\s?|[.‑–-]|\s{1,3})\(?\d+)*(?:-[A-Z](?!\w))?(?![\w@])")
_PAIR = re.compile(r"(?<!\w)(?=(([^\W\d_a-zß-öø-ÿ][^\W\d_]+(?:[-’'][^\W\d_]+)*)(?:\s+([^\W\d_a-zß-öø-ÿ])\.)?(,?)\s+([^\W\d_a-zß-öø-ÿ][^\W\d_]+(?:[-’'][^\W\d_]+)*)(?!\w)))")
_CAP = r"[^\W\d_a-zß-öø-ÿ][\w’'-]*"
_UNIT = r"(?:Flat|Apt|Apartment|Unit|Suite|Room|Wohnung|Piso|Appt)\.?\s+\d+\s?[a-zA-Z]?"
_TOWN = rf"(?:(?:St|San|Santa|Saint|Bad|New|Old|Great|Le|La|Los)\.?\s+)?{_CAP}"
_NO = r"\d{1,4}\s?[a-zA-Z]?"
_ADDRESS = re.compile(
    rf"(?<!\w)(?:"
    rf"(?:{_UNIT},?\s+)?{_NO},?\s+(?:{_CAP}\s+){{1,3}}?(?:Street|St\b\.?|Road|Rd\b\.?|Lane|Ln\b\.?|Way|Close|Court|Ct\b\.?|Terrace|Avenue|Ave\b\.?|Drive|Dr\b\.?|Place|Square|Crescent|Row|Walk|Hill|Gardens|Grove)(?:,?\s+{_UNIT})?,?\s+{_TOWN}(?:,?\s+\d{{4,6}})?"
    rf"|(?:{_CAP}\s+)?[^\W\d_][\w-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|damm|ufer)\s+{_NO},?\s+(?:\d{{4,6}}\s+)?{_TOWN}"
    rf"|{_NO},?\s+(?:rue|avenue|boulevard|place|chemin|quai|impasse|allée)\s+(?:(?:de|du|des|la|le)\s+)*{_CAP}(?:\s+{_CAP})?,?\s+(?:\d{{4,6}}\s+)?{_TOWN}"
    rf"|(?:Calle|Avenida|Plaza|Paseo|Camino|Via|Rua)\s+(?:(?:de|del|la|el|los|las)\s+)*{_CAP}(?:\s+{_CAP})?,?\s+{_NO},?\s+(?:\d{{4,6}}\s+)?{_TOWN}"
    rf")(?!\w)"
)
#: An address needs one of these; the costly pattern runs only around them. Plain search beats a pattern of as many branches.
STREETS = tuple(
    "Street St Road Rd Lane Ln Way Close Court Ct Terrace Avenue Ave Drive Dr Place Square Crescent Row Walk Hill Gardens Grove "
    "straße strasse str. weg gasse platz allee damm ufer rue avenue boulevard place chemin quai impasse allée Calle Avenida Plaza Paseo Camino Via Rua".split()
)
_WORD = re.compile(r"[^\W\d_]+|[—]")


class Candidate(NamedTuple):
    start: int
    end: int
    kind: str
    x: list[float]


class Names:
    """Given and family names with the beginnings and ends they are made of; the list is known to be incomplete."""

    def __init__(self, parts: list[tuple[str, str]]):
        self.known = {k: frozenset(p.lower() for p, kind in parts if p and kind == k) for k in ("given", "family")}
        self.ends = {}
        for k, ns in self.known.items():
            heads: dict[str, int] = {}
            tails: dict[str, int] = {}
            for n in ns:
                for i in range(3, len(n) - 2):
                    heads[n[:i]] = heads.get(n[:i], 0) + 1
                    tails[n[i:]] = tails.get(n[i:], 0) + 1
            self.ends[k] = (frozenset(h for h, c in heads.items() if c >= 3), frozenset(t for t, c in tails.items() if c >= 3))

    def like(self, kind: str, word: str) -> tuple[float, float]:
        """Whether the word (any part of a double name) is listed, and how much of it looks like listed ones: 0, 1 or 2 ends."""
        ps = [p for p in re.split(r"[-’']", word.lower()) if p]
        listed = float(any(p in self.known[kind] for p in ps))
        head, tail = self.ends[kind]
        best = 0
        for p in ps:
            best = max(best, any(p[:i] in head for i in range(3, len(p))) + any(p[i:] in tail for i in range(1, len(p) - 2)))
        return listed, float(best)


def _near(words: list[str], cues: frozenset) -> float:
    """1 for a cue as the last word, less for one further back, 0 beyond four words."""
    for k, w in enumerate(reversed(words[-4:])):
        if w in cues:
            return 1.0 / (k + 1)
    return 0.0


def _before(text: str, at: int, width: int = 48) -> list[str]:
    return [w.lower() for w in _WORD.findall(text[max(0, at - width) : at])][-4:]


def _after(text: str, at: int) -> list[str]:
    return [w.lower() for w in _WORD.findall(text[at : at + 30])][:2]


def _emails(text: str) -> Iterator[Candidate]:
    for m in _AT.finditer(text):
        left = _LOCAL.search(text, max(0, m.start() - 80), m.start())
        if not left:
            continue
        right = _DOMAIN.match(text, m.end())
        if not right:
            continue
        s, e = left.start(), right.end()
        while s < m.start() and not text[s].isalnum():
            s += 1
        if s >= m.start():
            continue
        tld = re.split(r"[\W_]+", text[m.end() : e])[-1]
        local = text[s : m.start()].strip()
        x = [
            float(tld.isalpha()), len(tld), len(local), float(local.isdigit()), float(m.group().strip() != "@"), text[m.end() : e].count("."),
            float(any(c.isdigit() for c in tld)), float("fps" in local), float(local[:1].isalpha()), float(" " in text[s:e]), float("\n" in text[s:e]),
        ]
        yield Candidate(s, e, "email", x)


def _numbers(text: str) -> Iterator[Candidate]:
    for m in _NUMBER.finditer(text):
        s, e = m.span()
        whole = m.group()
        n = sum(c.isdigit() for c in whole)
        if n < 7:
            continue
        prefix = m.group(1)
        readings = [(s, e, 0.0, 0.0)]
        if prefix:
            readings.append((s + len(whole) - len(whole[len(prefix) :].lstrip()), e, 1.0, 0.0))
        breaks = [b.span() for b in re.finditer(r"\s+", whole)]
        if len(breaks) > 1 or "\n" in whole:
            a, b = breaks[-1]
            readings.append((s, s + a, 0.0, 1.0))
            a, b = breaks[0]
            readings.append((s + b, e, 1.0, 0.0))
        before = _before(text, s)
        after = _after(text, e)
        cues = [_near(before, PHONE_CUES), _near(before, ID_CUES), _near(before, OTHER_CUES)]
        for a, b, front, back in readings:
            if text[a] == "(" and ")" not in text[a:b]:
                a += 1
            t = text[a:b]
            digits = re.findall(r"\d+", t)
            n = sum(map(len, digits))
            if not 7 <= n <= 15:
                continue
            p = re.match(r"[A-Z]+", t)
            shape = "-".join(str(len(g)) for g in digits)
            x = [
                n, len(digits), float(t[0] == "+"), float(digits[0][0] == "0"), float("(" in t), float("." in t), float("-" in t or "‑" in t), float("/" in t),
                float(bool(re.search(r"\s", t))), len(p.group()) if p else 0.0, float(t[-1].isalpha()), len(digits[0]), len(digits[-1]),
                float(shape == "3-2-4"), float(shape == "4-4-4"), float("555" in digits), *cues, float(text[max(0, a - 2) : a].strip()[-1:] == ":"),
                float(text[max(0, a - 2) : a].strip()[-1:] == ","), front, back, float("\n" in t), float(bool(p) and p.group().lower() in ("id", "no", "nr", "at", "on", "of")),
                float(bool(after) and after[0] in OTHER_CUES), float("." in t and " " not in t and len(digits) <= 4 and len(digits[0]) < 3),
            ]
            yield Candidate(a, b, "phone", x)
            yield Candidate(a, b, "id_number", x)


def _street_words(text: str) -> list[int]:
    out = set()
    for w in STREETS:
        at = text.find(w)
        while at >= 0:
            e = at + len(w)
            if not text[e : e + 1].isalpha() and (w[0].islower() or not text[at - 1 : at].isalnum()):
                out.add(at)
            at = text.find(w, e)
    return sorted(out)


def _addresses(text: str) -> Iterator[Candidate]:
    done = -1
    for hit in _street_words(text):
        if hit < done:
            continue
        lo = max(0, done, hit - 70)
        for m in _ADDRESS.finditer(text, lo, min(len(text), hit + 100)):
            s, e = m.span()
            if s > hit or e <= hit:
                continue
            t = m.group()
            x = [
                float(bool(re.search(r"\d", t))), float(bool(re.search(r"\d{4,6}", t))), float(bool(re.search(_UNIT, t))), t.count(","), len(t.split()), float("\n" in t),
                _near(_before(text, s), frozenset("lives at address adresse anschrift to lieu tournage place camera drives wohnt habite vive".split())),
                float(text[e : e + 1] in ".,;:\n" or e == len(text)), float(t[0].isdigit()), float(bool(re.search(r"\d{4,6}$", t))),
            ]
            yield Candidate(s, e, "address", x)
            done = e
            break


def _persons(text: str, names: Names) -> Iterator[Candidate]:
    for m in _PAIR.finditer(text):
        first, initial, comma, second = m.group(2, 3, 4, 5)
        s, e = m.span(1)
        a, b = first.lower(), second.lower()
        if a in NO_NAME and b in NO_NAME:
            continue
        g1, f1, g2, f2 = names.like("given", first), names.like("family", first), names.like("given", second), names.like("family", second)
        before, after = _before(text, s), _after(text, e)
        x = [
            g1[0], g1[1], f1[0], f1[1], g2[0], g2[1], f2[0], f2[1], float(bool(comma)), float(bool(initial)), float(first.isupper() and second.isupper()), float(first[1:].islower() and second[1:2].islower()),
            float(a in NO_NAME), float(b in NO_NAME), float(a in TITLES), _near(before[-2:], BEFORE_NAME), float(bool(after) and after[0] in AFTER_NAME),
            float(text[max(0, s - 3) : s].strip()[-1:] in ".!?:;—-*#(" or not text[:s].strip()), float(text[max(0, s - 3) : s].strip()[-1:] in ":—("), float("\n" in m.group(1)), len(first), len(second), float("-" in second),
            float(bool(before) and before[-1] in TITLES), float(text[e : e + 1] == ","), float(bool(after) and after[0] == "annotator"), float(bool(after) and after[0] == "lives"),
            float(before[-2:] == ["name", "is"] or before[-2:] == ["written", "by"] or before[-2:] == ["thanks", "to"] or before[-2:] == ["we", "asked"]),
        ]
        yield Candidate(s, e, "person", x)


def candidates(text: str, names: Names) -> list[Candidate]:
    return [*_emails(text), *_numbers(text), *_addresses(text), *_persons(text, names)]


@lru_cache(4)
def load(path: str = str(MODEL)) -> dict[str, Boosted]:
    return {k: Boosted.from_dict(v) for k, v in json.loads(Path(path).read_text()).items()}


def select(texts: list[str], names: Names, models: dict[str, Boosted]) -> list[list[tuple[int, int, str]]]:
    """The chosen spans of each text, in order and apart from each other; the trees judge all texts' candidates at once."""
    by_kind: dict[str, list] = {k: [] for k in KINDS}
    for i, t in enumerate(texts):
        if t:
            for c in candidates(t, names):
                by_kind[c.kind].append((i, c))
    passed: list[list[tuple[int, float, Candidate]]] = [[] for _ in texts]
    for k, cs in by_kind.items():
        if cs:
            p = models[k].probability(np.array([c.x for _, c in cs], np.float64))
            for (i, c), q in zip(cs, p.tolist()):
                if q >= models[k].threshold:
                    passed[i].append((c.end - c.start, q, c))
    out = []
    for cs in passed:
        chosen: list[tuple[int, int, str]] = []  # in order and apart, so that only the neighbours matter
        for _, _, c in sorted(cs, key=lambda x: (-x[0], -x[1], x[2].start)):
            at = bisect_left(chosen, (c.start,))
            if (at == 0 or chosen[at - 1][1] <= c.start) and (at == len(chosen) or chosen[at][0] >= c.end):
                chosen.insert(at, (c.start, c.end, c.kind))
        out.append(chosen)
    return out


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    at, out = 0, []
    for s, e, k in spans:
        out += [text[at:s], PLACEHOLDER[k]]
        at = e
    return "".join(out) + text[at:]


#: Texts judged at once.
TEXTS = 256


def _names(names: DataFrame, part: str, kind: str) -> list[tuple[str, str]]:
    """The list of known names; a fixed list, refused beyond a size that workers can hold."""
    rows = names.select(part, kind).where(F.col(part).isNotNull()).limit(1_000_001).collect()
    if len(rows) > 1_000_000:
        raise ValueError("more than a million names: not a list to be held by each worker")
    return [(r[0], r[1]) for r in rows]


def _scan(spark: SparkSession, docs: DataFrame, names: DataFrame, key: str, text: str, part: str, kind: str, schema: str, emit) -> DataFrame:
    shared = spark.sparkContext.broadcast(_names(names, part, kind))
    models = spark.sparkContext.broadcast({k: m.to_dict() for k, m in load().items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = Names(shared.value)
        trees = {k: Boosted.from_dict(d) for k, d in models.value.items()}
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at in range(0, len(texts), TEXTS):
                part = texts[at : at + TEXTS]
                yield emit(keys[at : at + TEXTS], part, select(part, n, trees), b.column(0).type)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def find(spark: SparkSession, docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", part: str = "name_part", kind: str = "part_kind") -> DataFrame:
    """key, kind, found_text: the distinct private values of each document (keys are unique, so no shuffle)."""

    def emit(keys, texts, spans, t):
        rows = [(k, kind, v) for k, x, ss in zip(keys, texts, spans) for kind, v in dict.fromkeys((kd, " ".join(x[s:e].split())) for s, e, kd in ss)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], t), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=[key, "kind", "found_text"])

    return _scan(spark, docs, names, key, text, part, kind, f"`{key}` {docs.schema[key].dataType.simpleString()}, kind string, found_text string", emit)


def redacted(spark: SparkSession, docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", part: str = "name_part", kind: str = "part_kind") -> DataFrame:
    """key, text with each private value replaced by its placeholder and nothing else changed."""

    def emit(keys, texts, spans, t):
        return pa.RecordBatch.from_arrays([pa.array(keys, t), pa.array([redact(x, ss) if x else x for x, ss in zip(texts, spans)], pa.string())], names=[key, "text"])

    return _scan(spark, docs, names, key, text, part, kind, f"`{key}` {docs.schema[key].dataType.simpleString()}, text string", emit)
